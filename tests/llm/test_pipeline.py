"""Stages of the pipeline, each against its operator's decisions."""

from __future__ import annotations

import random

import corpus_pipeline
from runlens.llm import langid, near_dedup, pii
from tests.llm.test_operators import brute_removal, shingles

SF_DIR = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns = docs.columns
    for name, work in corpus_pipeline.STAGES[:-1]:
        kept = work(spark, docs, SF_DIR)
        assert kept.columns == columns, name
        kept = spark.createDataFrame(kept.toPandas(), docs.schema)
        assert 0 < kept.count() <= docs.count()
        docs = kept
    anchors = pii.automaton()
    assert not any(pii.spans(r.text or "", anchors) for r in docs.select("text").collect())
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR).collect()
    assert {r.doc_id for r in last} == {r.doc_id for r in docs.collect()}


def test_stages_like_plain_python(spark):
    """Each stage on nulls, empty and very long texts, ties, repeated rows and columns with the operators' own names."""
    rng = random.Random(21)
    vocabulary = {"en": ["the", "of", "and", "thing", "stand", "other", "with"], "de": ["der", "und", "schung", "keit", "nicht", "eine", "bei"]}
    prose = lambda lang, n: " ".join("".join(rng.choices(vocabulary[lang], k=2)) for _ in range(n))
    passage, base = prose("en", 60), prose("de", 200)
    mail = f"write to a.b@c.org or token = 9c8bd01dcc7ec1a7e0cdc9f3b2a45e6d {prose('en', 30)}"
    texts = [prose(lang, 50) for lang in ("en", "de") * 40]
    rows = [(i, t, ("en", "de")[i % 2]) for i, t in enumerate(texts)]
    rows += [(100, f"{passage} {prose('en', 80)}", "en"), (101, f"{prose('en', 80)} {passage}", None), (102, base, "de"), (103, base + " mehr und", "de"), (104, base, None), (105, mail, "en"), (105, mail, "en")]
    rows += [(106, prose("en", 9000), "en"), (107, None, "en"), (108, "", "en"), (109, "½ 12 --", "de"), (None, base, "de"), (None, passage, "en"), (110, "the", None)]
    made = spark.createDataFrame([(i, t, lang, "s", None if t is None else len(t), "r", 1, 2) for i, t, lang in rows], "doc_id long, text string, lang string, source string, n_chars long, `row` string, spans int, id long").repartition(3)
    columns, docs = made.columns, made

    def step(k):
        kept = corpus_pipeline.STAGES[k][1](spark, docs, SF_DIR)
        assert kept.columns == columns
        out = spark.createDataFrame(kept.collect(), docs.schema)
        texts = lambda df: sorted(((r.doc_id, r.text) for r in df.collect()), key=str)
        return out, texts(docs), texts(out)

    docs, before, after = step(0)
    told = {r["row"]["text"]: r.rejected for r in langid.predict(made, langid.fit(made.where(~langid.held_out()))).collect()}
    assert after == [r for r in before if not told[r[1]]] and {i for i, _ in before} - {i for i, _ in after} >= {107, 108, 109} and len(after) > 80
    docs, before, after = step(1)
    sets = [(i, t, shingles(t)) for i, t in before]
    gone = {i for i, _, a in sets if i is not None and any(j is not None and j < i and 5 * len(a & b) >= 4 * len(a | b) for j, _, b in sets)}
    kept = {r for r in before if r[0] is not None and r[0] not in gone}
    assert gone >= {103, 104} and after == sorted([*kept, *(r for r in before if r[0] is None)], key=str)
    docs, before, after = step(2)
    want = brute_removal([(i, t) for i, t in before])
    lengths = sorted(((i, n - removed) for i, n, removed, _, _ in want), key=str)
    assert sorted(((i, len(t.encode())) for i, t in after), key=str) == lengths and any(removed for _, _, removed, _, _ in want)
    docs, before, after = step(3)
    anchors = pii.automaton()
    assert after == sorted(((i, pii.cleaned(t, pii.spans(t, anchors), anchors)) for i, t in before), key=str)
    assert sum("[email]" in t and "[secret]" in t for _, t in after) == 1 and {r.n_chars == len(r.text) for r in docs.collect()} == {True}
    packed = corpus_pipeline.STAGES[4][1](spark, docs, SF_DIR).collect()
    assert sorted({str(r.doc_id) for r in packed}) == sorted({str(i) for i, _ in after}) and sum(r.piece == 0 for r in packed) == len(after)


def test_empty(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(0)
    for _, work in corpus_pipeline.STAGES:
        assert work(spark, docs, SF_DIR).count() == 0


def test_near_duplicates_from_80_percent(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    text = [" ".join(random.Random(k).choices([f"w{i}x" for i in range(400)], k=100)).split() for k in range(8)]
    # 100 words have 96 shingles; the first n words share n - 4 of them
    made = [(10**9 + 100 * k + n, " ".join(text[k][:n])) for k in range(8) for n in (100, (79, 80, 81, 82, 83, 84, 85, 86)[k])]
    rows = docs.select("doc_id", "text").collect() + made
    kinds = docs.schema
    whole = docs.unionByName(spark.createDataFrame(made, "doc_id long, text string").select("doc_id", "text"), allowMissingColumns=True).select(*kinds.names)
    known = [(i, shingles(t)) for i, t in rows if i is not None]
    root = {i: i for i, _ in known}
    find = lambda i: i if root[i] == i else find(root[i])
    for at, (i, a) in enumerate(known):
        for j, b in known[:at]:
            if a and b and 5 * min(len(a), len(b)) >= 4 * max(len(a), len(b)) and 5 * len(a & b) >= 4 * len(a | b):
                x, y = sorted((find(i), find(j)))
                root[y] = x
    kept = {r.doc_id for r in corpus_pipeline.near_duplicates(spark, whole, SF_DIR).select("doc_id").collect()}
    assert kept == {i for i in root if find(i) == i} | {i for i, _ in rows if i is None}
    assert sum(i >= 10**9 for i in kept) == 10  # those of 79 and 80 words stay


def test_bands_for_a_percentage():
    assert near_dedup.halves(85) == 10 and near_dedup.halves(80) == 14

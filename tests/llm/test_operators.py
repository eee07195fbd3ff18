"""Each operator against brute force or a round trip, with nulls, empty and long texts, ties, repeats and empty tables."""

from __future__ import annotations

import hashlib
import io
import math
import random
import re
import zipfile
import zlib
from collections import Counter
from functools import cache

import numpy as np
import pytest
from pyspark.sql import functions as F

from runlens.llm import collocations, components, infill, langid, licenses, near_dedup, packing, pieces, pii, quality, queries, suffix_array, suffix_dedup, topk, url_templates, warc
from tests.check_oracles import compare, duck

public_tokenizers = pytest.importorskip("public_tokenizers")
SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, `row` string, spans int"  # names that operators use themselves
PASSAGE = "the quick brown fox jumps over the lazy dog and then it runs away into the deep dark forest again "


def words(n: int, seed: int) -> str:
    return " ".join(random.Random(seed).choices([f"w{i}x" for i in range(400)], k=n))


DOCS = [
    (0, None, None, "r", 1), (1, "", "en", "r", 1), (2, " \n\t ", "en", "r", 1), (3, "one two", "en", "r", 1), (3, "one two", "en", "r", 1),
    (4, PASSAGE + words(80, 1), "en", None, 1), (5, words(60, 2) + " " + PASSAGE + "ü€", "de", "r", None), (6, PASSAGE + words(80, 1), "en", "r", 1),
    (7, words(200, 3), "fr", "r", 1), (8, words(200, 3) + " more", "fr", "r", 1), (9, words(30000, 4), "en", "r", 1), (None, words(40, 5), "en", "r", 1),
    (10, "mail a.b@c.org or x@y, 10.0.0.255 999.1.1.1 +49 (30) 1234-567, 4111 1111 1111 1111", "en", "r", 1), (11, "ONE  two", None, "r", 1), (12, "x" * 3000, "en", "r", 1),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(DOCS, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_sql(spark, con, name):
    assert compare(queries.QUERIES[name](spark, SF_DIR), con, queries.ORACLES[name]) is None


# ---- 1


def test_packages_round_trip(spark):
    big, other = "ü" * 700, "z" * 1000
    rows = [(1, "http://a/x y", big), (2, None, big), (3, "u", "small"), (4, "u", "small"), (5, "u", None), (None, "u", big), (6, "u", other), (6, "u", other), (7, "u", "a" * 5_000_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(2)
    got = Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.round_trip(pages).collect())
    sha = lambda t: hashlib.sha1((t or "").encode()).hexdigest()
    size = lambda t: len((t or "").encode())
    want = Counter((i, size(t), sha(t), "revisit" if t == big and i != 2 else "response", 2 if t == big and i != 2 else None) for i, _, t in rows)
    assert got == want
    assert warc.round_trip(pages.limit(0)).count() == 0


def test_packages_hold_every_record_of_a_batch(spark, tmp_path):
    pages = spark.createDataFrame([(i, "u", None if i == 3 else "é" * 300_000 * (i % 2)) for i in range(8)], "page_id long, url string, html string").coalesce(1)
    made = warc.write_packages(warc.revisits(pages, pages.page_id, pages.html, url=pages.url).coalesce(1), str(tmp_path), 3).collect()
    assert sorted(m.records for m in made) == [2, 3, 3]


def test_zip_directory_with_zip64(monkeypatch):
    for limit in (None, 10):
        if limit:
            monkeypatch.setattr(zipfile, "ZIP64_LIMIT", limit)
            monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 1)
        file = io.BytesIO()
        with zipfile.ZipFile(file, "w", zipfile.ZIP_STORED) as z:
            z.writestr("archive/data.warc.gz", b"0123456789" * 5)
            z.writestr("indexes/é.txt", b"abc")
            z.comment = b"PK\x05\x06 in a comment"
        raw = file.getvalue()
        found = warc.directory(lambda a, n: raw[a : a + n], len(raw))  # noqa: B023
        assert [(m.name, raw[m.offset : m.offset + m.size]) for m in found] == [("archive/data.warc.gz", b"0123456789" * 5), ("indexes/é.txt", b"abc")]
    with pytest.raises(ValueError, match="not a ZIP"):
        warc.directory(lambda a, n: b"x" * n, 100)


def test_members_without_index():
    import gzip

    records = [gzip.compress(warc.record(i, "u", b"p" * i, None, False), mtime=0) for i in range(5)]
    raw = b"".join(records)
    places = list(warc.walk(lambda a, n: raw[a : a + n], warc.Member("archive/x", 0, len(raw))))
    assert [raw[a : a + n] for a, n in places] == records


# ---- 2


def test_url_rules_and_templates(spark):
    host = [f"http://Shop.example.com/de/{i}" for i in range(40)] + [f"http://shop.example.com/item/{i}/x" for i in range(30)]
    odd = [None, "", "no scheme", "x://", "x://H", "x://h?a/b", "x://a.net", "x://a.net/", "x://example.net/en/a", "x://badnet/", "x://o.org/fr/1", "x://o.org/1/2/3/4/5/6"]
    rows = list(enumerate(host + odd + odd))
    pages = spark.createDataFrame([*rows, (None, "x://a.net/")], "page_id long, url string")
    got = {r.page_id: r for r in url_templates.judge(pages, queries.URL_RULES).collect()}
    assert len(got) == len(rows) + 1
    want = {"x://a.net": None, "x://a.net/": "net/", "x://example.net/en/a": "example.net/en/", "x://badnet/": None, "x://o.org/fr/1": "org/fr/"}
    for i, u in rows:
        if u in want:
            assert got[i].rule == want[u]
    assert got[0].template == "/de/*" and got[0].verdict == "block" and got[45].template == "/item/*/x"
    assert got[len(host)].host == got[len(host)].path == "" and got[len(host) + 11].template == "/*/*/*/*/*/*"
    assert url_templates.judge(pages.limit(0), queries.URL_RULES).count() == 0


def brute_urls(pages: list[tuple], rules: list[tuple]) -> list[tuple]:
    """The method in plain Python: one tree per host, levels from the top."""
    split = []
    for i, u in pages:
        m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", u or "")
        split.append((i, "".join(c.lower() if c.isascii() else c for c in m[1]) if m else "", m[2] if m else ""))
    verdicts = {}
    for h, p in {(h, p) for _, h, p in split}:
        fits = [(len(a + b), a + b, act) for a, b, act in rules if (h == a or h.endswith("." + a)) and p.startswith(b)]
        verdicts[h, p] = max(fits)[1:] if fits else (None, None)
    n = Counter((h, p) for _, h, p in split)
    tree = {u: ([x for x in u[1].split("/") if x], [], []) for u in n}  # segments, parts, blanks
    depth = 0
    while any(len(t[0]) > depth for t in tree.values()):
        children: dict = {}
        for (h, p), (segments, parts, _) in tree.items():
            if len(segments) > depth:
                children.setdefault((h, tuple(parts)), Counter())[segments[depth]] += n[h, p]
        told = {k: c.copy() for k, c in children.items()}
        for (h, p), (segments, parts, blanks) in tree.items():
            if len(segments) > depth:
                c, seg = told[h, tuple(parts)], segments[depth]
                wild = re.search(url_templates._ID.replace(r"\z", r"\Z"), seg) or (len(c) >= url_templates.MANY and c[seg] * url_templates.MANY < sum(c.values()))
                parts.append("/*" if wild else "/" + seg)
                blanks.append("/*" if wild else "/+")
        depth += 1
    each: dict = {}
    for (h, p), (_, parts, blanks) in tree.items():
        t = "".join(parts)
        e = each.setdefault((h, t), {"shape": "".join(blanks), "parts": parts, "bad": 0, "known": 0, "lengths": [], "digits": []})
        e["bad"] += n[h, p] * (verdicts[h, p][1] == "block")
        e["known"] += n[h, p] * (verdicts[h, p][1] is not None)
        count = lambda x: sum(c in "0123456789" for c in x)
        e["lengths"].append(len(p) - len(t))
        e["digits"].append(count(p) - count(t))
    least, z = url_templates.LEAST_KNOWN, url_templates.Z_SQUARED
    by_shape: dict = {}
    for (h, t), e in each.items():
        by_shape.setdefault((h, e["shape"]), []).append((t, e))
    group = {}
    for (h, shape), members in by_shape.items():
        many = [e for _, e in members if e["known"] >= least]
        share = sum(e["bad"] for e in many) / sum(e["known"] for e in many) if many else None
        alike = lambda e: share is not None and (e["bad"] - e["known"] * share) ** 2 <= z * e["known"] * share * (1 - share)
        core = [e for e in many if alike(e)]

        def near(e, stat):
            x, y = e[stat], [v for c in core for v in c[stat]]
            within = (sum(v * v for v in x) - sum(x) ** 2 / len(x) + sum(v * v for v in y) - sum(y) ** 2 / len(y)) / (len(x) + len(y))
            return (sum(x) / len(x) - sum(y) / len(y)) ** 2 <= z * within * (1 / len(x) + 1 / len(y)) + 1e-9

        for t, e in members:
            group[h, t] = "=" + shape if alike(e) and core and (e["known"] >= least or (near(e, "lengths") and near(e, "digits"))) else t
    below: dict = {}
    for (h, _), e in each.items():
        for k in range(len(e["parts"]) + 1):
            below.setdefault((h, "".join(e["parts"][:k])), []).append(e)
    sums = lambda es: (sum(e["bad"] for e in es), sum(e["known"] for e in es))
    bad, known = sums(each.values())
    purity = {}
    for (h, t), e in each.items():
        together = [x for (g, u), x in each.items() if g == h and group[g, u] == group[h, t]]
        chain = [sums(below[h, "".join(e["parts"][:k])]) for k in range(len(e["parts"]) + 1)] + [(e["bad"], e["known"])]
        if len(together) > 1:
            chain = [chain[0], sums(together)]
        s = bad / known if known else 0.0
        for (b, k), (b2, k2) in zip(chain, [*chain[1:], (0, 0)], strict=True):
            s = (b - b2 + url_templates.WEIGHT * s) / (k - k2 + url_templates.WEIGHT)
        purity[h, t] = s
    out = []
    for i, h, p in split:
        t = "".join(tree[h, p][1])
        rule, act = verdicts[h, p]
        out.append((i, h, p, rule, act or ("block" if purity[h, t] * 100 >= url_templates.REJECT_PERCENT else "allow"), t, f"{purity[h, t]:.9f}"))
    return out


def test_urls_like_brute_force(spark):
    rng = random.Random(2)
    hosts = ["a.net", "bad.example.com", "example.net", "o.org", "x.info", "EXAMPLE.com"]
    parts = ["de", "fr", "en", "item", "2024", "ab12cd34ef", "p.html", "12.html", "ü"]
    made = [f"http://{rng.choice(hosts)}/" + "/".join(rng.choice(parts) if rng.random() < 0.8 else f"{rng.choice('xyz')}{rng.randint(0, 60)}" for _ in range(rng.choice([0, 1, 2, 2, 3, 6]))) + rng.choice(["", "?q=/x", "/", "#f"]) for _ in range(1500)]
    deep = ["http://x.info/" + "/".join(f"s{k}" for k in range(300)) + end for end in ("", "/a", "/b", "/7")] + ["http://x.info//d//e/" + "y" * 5000]
    pages = list(enumerate([*made, *made[:50], *deep, None, "", "no scheme", "://", "a://", "http://h?x", None]))
    given = [(r.page_id, r.url) for r in spark.read.parquet(f"{SF_DIR}/pages.parquet").select("page_id", "url").collect()]
    for rows in (pages, given):
        df = spark.createDataFrame([(*r, "clash", 1) for r in rows], "page_id long, url string, template string, n int").repartition(3)
        got = url_templates.judge(df, queries.URL_RULES).select("page_id", "host", "path", "rule", "verdict", "template", F.format_string("%.9f", "purity").alias("p")).collect()
        assert Counter(map(tuple, got)) == Counter(brute_urls(rows, queries.URL_RULES))


def test_url_evidence_flows_to_branches_without_rules(spark):
    urls = [f"x://bad.example.com/de/{i}" for i in range(100, 160)]
    urls += [f"x://bad.example.com/fr/{i}" for i in range(300, 303)]  # same shape and statistics: merged
    urls += [f"x://bad.example.com/en/{i}{i}{i}/about" for i in range(400, 403)]  # another shape: the host's share
    urls += [f"x://good.example.org/fr/{i}" for i in range(100, 180)] + [f"x://good.example.org/de/{i}" for i in range(300, 303)]
    urls += [f"x://mixed.net/en/{i}" for i in range(100, 120)] + ["x://alone.info/de/101"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {urls[r.page_id]: r for r in url_templates.judge(pages, queries.URL_RULES).collect()}
    p = 80 / 160
    share = lambda s, bad, known: (bad + 8 * s) / (known + 8)
    assert got["x://alone.info/de/101"].purity == p and got["x://alone.info/de/101"].verdict == "allow"
    beside = got["x://bad.example.com/fr/300"]
    assert beside.rule is None and beside.verdict == "block" and beside.purity == pytest.approx(share(p, 60, 60))
    assert beside.purity == got["x://bad.example.com/de/100"].purity
    other = got["x://bad.example.com/en/400400400/about"]
    assert other.rule is None and other.verdict == "block" and other.purity == pytest.approx(share(p, 60, 60))
    near = got["x://good.example.org/de/300"]
    assert near.rule is None and near.verdict == "allow" and near.purity == pytest.approx(share(p, 0, 80))


def test_url_evidence_counts_once(spark):
    rows = [("h", f"/a/b/c/{i}x", 1, 1, 0) for i in range(5)] + [("h", "/a/b/d", 1, 0, 0), ("h", "/a/e", 1, 0, 3), ("i", "/", 1, 1, 1)]
    found = url_templates.templates(spark.createDataFrame(rows, "host string, path string, n long, bad long, good long"))
    got = {(r.host, r.template): r.purity for r in url_templates.purity(found).collect()}
    share = lambda s, bad, known: (bad + 8 * s) / (known + 8)
    p = 6 / 10
    assert got["h", "/a/b/d"] == pytest.approx(share(share(p, 0, 3), 5, 5))  # /a/e at /a, /a/b/c at /a/b
    assert got["h", "/a/b/c/0x"] == pytest.approx(share(share(share(p, 0, 3), 4, 4), 1, 1))


# ---- 3


def test_packing(spark, docs, nothing):
    from tokenizers import Tokenizer

    path = str(public_tokenizers.path("word_bpe_49k.json"))
    plain = Tokenizer.from_file(path)
    got = packing.pack(packing.pieces(docs, path, keep=["doc_id"])).select("row.doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset").collect()
    want = []
    for i, t, *_ in DOCS:
        ids = np.array([*plain.encode(t or "", add_special_tokens=False).ids, 1], dtype="<u4")
        want += [(i, k // 4096, k, len(p := ids[k : k + 4096]), zlib.crc32(p.tobytes())) for k in range(0, len(ids), 4096)]
    assert Counter(tuple(r)[:5] for r in got) == Counter(want)
    held: dict = {}
    for r in got:
        held.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in held.values():
        places.sort()
        assert [a for a, _ in places] == [sum(n for _, n in places[:k]) for k in range(len(places))] and sum(n for _, n in places) <= 4096
    assert packing.pack(packing.pieces(nothing, path, keep=["doc_id"])).count() == 0


def test_encoder_equals_tokenizer():
    from tokenizers import Tokenizer

    path = str(public_tokenizers.path("word_bpe_49k.json"))
    texts = ["", "don't we'll I'D x's", "ÀÉß ÿŸ Ĳ ŀ ¼ ² ™ ΣΑΣ", "a\x1cb\x85c\u00a0d", "<|endoftext|> a", "50% *** a_b 1234", "e\u0301 日本語 😀", "ŉ ſ İ ı"]
    plain = Tokenizer.from_file(path)
    assert packing.Encoder(path)(texts) == [np.array(plain.encode(t, add_special_tokens=False).ids, dtype="<u4").tobytes() for t in texts]


def test_sum_of_squares_rule():
    rng = np.random.default_rng(1)
    lengths = rng.integers(1, 65, 300)
    bins, offsets = packing.place(lengths, 64)
    gaps: list[int] = []
    for s, b in zip(lengths.tolist(), bins.tolist(), strict=True):
        squares = lambda g: sum(v * v for k, v in Counter(g).items() if k)
        options = {g: squares([*[x for i, x in enumerate(gaps) if i != gaps.index(g)], g - s]) for g in set(gaps) if g >= s and g}
        fresh = squares([*gaps, 64 - s])
        gap = gaps[b] if b < len(gaps) else None
        assert (options[gap] if gap is not None else fresh) == min([*options.values(), fresh])
        if gap is None:
            gaps.append(64 - s)
        else:
            gaps[b] -= s
    assert all(offsets[i] == sum(lengths[j] for j in range(i) if bins[j] == bins[i]) for i in range(300))


# ---- 4


def brute_counts(t: str) -> tuple:
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    at: dict = {}
    for k in range(len(w) - 7):
        at.setdefault(tuple(w[k : k + 8]), []).append(k)
    covered = {k + j for v in at.values() if len(v) > 1 for k in v for j in range(8)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered)


def test_quality(spark, docs, nothing):
    extra = [(20, "a b c d e f g h " * 5, "", "", 0), (21, "x\nx\n \n#*$%&|<> x\r\nx\r\n", "", "", 0), (22, "\u00a0a\u2003b 😀", "", "", 0)]
    rows = docs.union(spark.createDataFrame(extra, SCHEMA))
    labels = spark.createDataFrame([(7, 1), (7, 1), (8, 0), (9, None), (None, 1), (99, 1)], "doc_id long, quality int")
    got = quality.judge(rows, labels, F.col("quality") == 1).collect()
    texts = [(i, t or "") for i, t, *_ in DOCS + extra]
    assert Counter(tuple(r)[:6] for r in got) == Counter((i, *brute_counts(t)) for i, t in texts)
    assert all(r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words) and not (r.base_failed and r.kept) for r in got)
    assert quality.judge(nothing, labels, F.col("quality") == 1).count() == 0
    unlabelled = quality.judge(rows, labels.limit(0), F.col("quality") == 1).collect()
    assert {r.score for r in unlabelled} == {0.0}


def test_likelihood_ratio(spark):
    rows = spark.createDataFrame([(1, "good words here"), (2, "bad bad"), (3, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1)], "doc_id long, quality int")
    ratios = quality.ratios(rows, labels, F.col("quality") == 1, buckets=8).first()["ratios"]
    grams = {r.doc_id: r.g for r in rows.select("doc_id", quality.words(F.col("text")).alias("words")).select("doc_id", quality.grams(8).alias("g")).collect()}
    raw, good = Counter(x for g in grams.values() for x in g), Counter(grams[1])
    want = [round(1e6 * (math.log((good[b] + 1) / (good.total() + 8)) - math.log((raw[b] + 1) / (raw.total() + 8)))) for b in range(8)]
    assert all(abs(a - b) <= 1 for a, b in zip(ratios, want, strict=True)) and grams[3] == []


def brute_quality(rows: list[tuple], good: set) -> list[tuple]:
    """Scores from both multinomials in plain Python, with the hashes that the engine has."""
    import xxhash

    signed = lambda h: h - (1 << 64) if h >> 63 else h
    first = cache(lambda w: xxhash.xxh64_intdigest(w.encode(), 42))
    place = lambda h: signed(h) % quality.BUCKETS

    def grams(t):
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        return [place(first(x)) for x in w] + [place(xxhash.xxh64_intdigest(b.encode(), first(a))) for a, b in zip(w, w[1:], strict=False)]

    told = [(i, t or "", grams(t)) for i, t in rows]
    raw, trusted = Counter(), Counter()
    for i, _, g in told:
        raw.update(g)
        if i is not None and i in good:
            trusted.update(g)
    raws, goods = raw.total() + quality.BUCKETS, trusted.total() + quality.BUCKETS
    ratio = cache(lambda b: math.log((trusted[b] + 1) / goods) - math.log((raw[b] + 1) / raws) if trusted else 0.0)
    out = []
    for i, t, g in told:
        n_words, *_, repeated = brute_counts(t)
        score = sum(map(ratio, g)) / len(g) if g else 0.0
        out.append((i, n_words < 20 or 100 * repeated > 30 * n_words, score))
    return out


def test_quality_scores_like_brute_force(spark, docs):
    given = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    good = {r.doc_id for r in labels.where("quality = 1").collect()}
    for rows in (given, docs.withColumn("doc_id", F.col("doc_id") + 1).withColumn("score", F.lit("clash")).withColumn("kept", F.lit(1))):
        got = sorted(((r.doc_id, r.base_failed, r.score, r.kept) for r in quality.judge(rows, labels, F.col("quality") == 1).collect()), key=str)
        want = sorted(brute_quality([(r.doc_id, r.text) for r in rows.collect()], good), key=str)
        near = quality.THRESHOLD / quality.SCALE
        assert len(got) == len(want) > 10
        for (i, failed, score, kept), (j, w_failed, w_score) in zip(sorted(got, key=lambda r: (str(r[0]), r[1])), sorted(want, key=lambda r: (str(r[0]), r[1])), strict=True):
            assert (i, failed) == (j, w_failed) and score == pytest.approx(w_score, abs=3e-6)
            assert kept == (not failed and w_score >= near) or abs(w_score - near) < 3e-6


# ---- 5


def brute_removal(rows: list[tuple]) -> list[tuple]:
    first: dict[bytes, int] = {}
    for i, t, *_ in rows:
        b = (t or "").encode()
        for k in range(len(b) - 49):
            if i is not None:
                first[b[k : k + 50]] = min(i, first.get(b[k : k + 50], i))
    out = []
    for i, t, *_ in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for k in range(len(b) - 49):
            if i is not None and first[b[k : k + 50]] < i:
                gone[k : k + 50] = b"\1" * 50
        spans = len(re.findall(b"\1+", bytes(gone)))
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(bytes(x for x, g in zip(b, gone, strict=True) if not g)).hexdigest()))
    return out


@pytest.mark.parametrize("part_bytes", [1 << 20, 2000])
def test_suffix_dedup(spark, docs, nothing, part_bytes, monkeypatch):
    got = suffix_dedup.remove_repeats(docs, keep=["doc_id"], part_bytes=part_bytes).select("row.doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()
    assert Counter(map(tuple, got)) == Counter(brute_removal(DOCS))
    assert suffix_dedup.remove_repeats(nothing).count() == 0


def test_blocks_merge_like_one():
    rng = np.random.default_rng(3)
    for trial in range(4):
        base = rng.integers(97, 100 if trial % 2 else 123, 400, dtype=np.uint8).tobytes()
        parts = [base[(a := int(rng.integers(0, 300))) : a + int(rng.integers(50, 100))] if rng.random() < 0.8 else b"a" * int(rng.integers(50, 100)) for _ in range(60)]
        owner = rng.integers(0, 40, 60)
        least: dict = {}
        for s, o in zip(parts, owner, strict=True):
            for k in range(len(s) - 49):
                least[s[k : k + 50]] = min(o, least.get(s[k : k + 50], 99))
        want = [o > least[s[k : k + 50]] for s, o in zip(parts, owner, strict=True) for k in range(len(s) - 49)]
        for cuts in ((0, 60), (0, 20, 45, 60)):
            blocks = []
            for a, b in zip(cuts, cuts[1:], strict=False):
                length = np.array([len(s) for s in parts[a:b]])
                blocks.append(suffix_array.Block(np.frombuffer(b"".join(parts[a:b]), dtype=np.uint8), np.cumsum(length) - length, length - 49, owner[a:b]))
            suffix_array.merge(blocks)
            assert np.concatenate([b.covered() for b in blocks]).tolist() == want


# ---- 6

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def brute_spans(t: str) -> list[tuple]:
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, t):
            digits = re.sub("[^0-9]", "", m[0])
            good = {"email": True, "ip": all(int(x) <= 255 for x in m[0].split(".")) if kind == "ip" else False, "card": 16 <= len(digits) <= 19 and pii.luhn(digits), "phone": 8 <= len(digits) <= 15}
            if good[kind]:
                out.append((kind, m.start(), m.end()))
    return out


def test_pii_spans_equal_patterns():
    rng = random.Random(5)
    anchors = pii.automaton()
    for _ in range(4000):
        t = "".join(rng.choices(["@", ".", "a", "B-", "+", " ", "1", "25", "0", "-", "(", ")", "é", "4111111111111111", "x@y.z", "1.2.3.4", "://", "_"], k=rng.randint(0, 25)))
        assert [s for s in pii.spans(t, anchors) if s[0] in pii.BASE] == brute_spans(t), t


def test_pii_values_some_way_after_their_cue():
    anchors = pii.automaton()
    told = lambda t: [(k, t[a:b]) for k, a, b in pii.spans(t, anchors) if k not in pii.BASE]
    hexes = "9c8bd01dcc7ec1a7e0cdc9f3b2a45e6d7f8091a2"
    assert told(f'token = "{hexes}" of') == [("secret", hexes)]
    assert told(f'TOKEN### =%%% "{hexes.upper()}"!!') == [("secret", hexes.upper())]
    assert told("the API key: AbCd0123EfGh4567IjKl, then") == [("secret", "AbCd0123EfGh4567IjKl")]
    assert told("password is hunter2!, PASSWORD='xY9#kk' and Pwd=abc12345") == [("secret", "hunter2!"), ("secret", "xY9#kk"), ("secret", "abc12345")]
    assert told("IBAN is DE89 3704 0044 0532 0130 00 and more text here") == [("iban", "DE89 3704 0044 0532 0130 00")]
    assert told("account of X: DE89370400440532013000.") == [("iban", "DE89370400440532013000")]
    assert told("ssn is 123-45-6789, ssn of the holder 219-09-9999") == [("ssn", "123-45-6789"), ("ssn", "219-09-9999")]
    prose = ["a token of thanks is given to aaaaaaaaaaaaaaaaaaaaaaaa", "password is required.", "secret\n" + hexes, "token " + "x" * 45 + " " + hexes, "ssn 000-12-3456", "the key to internationalization1", "passwords are long: really", hexes]
    assert [told(t) for t in prose] == [[]] * len(prose)


def test_pii_cleaning_leaves_nothing():
    anchors = pii.automaton()
    t = "call +1 (826) 555-4081 10.1.2.3 now"  # the address's digits make the number too long at first
    assert [k for k, _, _ in pii.spans(t, anchors)] == ["ip"]
    assert pii.cleaned(t, pii.spans(t, anchors), anchors) == "call [phone] [ip] now"


def test_pii_added_kinds_and_tables(docs, nothing):
    t = "IBAN: DE89 3704 0044 0532 0130 00, ssn 123-45-6789, http://me:pw@host/ account DE00 3704 0044 0532 0130 00"
    found = pii.spans(t, pii.automaton())
    assert [(k, t[a:b]) for k, a, b in found if k not in pii.BASE] == [("iban", "DE89 3704 0044 0532 0130 00"), ("login", "me:pw"), ("ssn", "123-45-6789")]
    rows = pii.find_pii(docs)
    by = {r["row"]["doc_id"]: r for r in rows.collect()}
    assert by[0]["clean"] is None and by[1]["clean"] == "" and by[10]["clean"] == "mail [email] or x@y, [ip] 999.1.1.1 [phone], [card]"
    assert rows.count() == len(DOCS) and pii.find_pii(nothing).count() == 0


# ---- 7


def test_pieces_equal_sentencepiece(spark, docs, nothing):
    import sentencepiece

    file = str(public_tokenizers.path("piece_bpe_32k.model"))
    model = sentencepiece.SentencePieceProcessor(model_file=file)
    some = docs.where("doc_id is null or doc_id <> 9").union(spark.createDataFrame([(30, "  two  blanks ", "", "", 0), (31, "a\nb ü 中 😀", "", "", 0), (32, " ", "", "", 0)], SCHEMA))
    table = pieces.piece_table(spark, file)
    encoded = pieces.encode(some, table)
    back = pieces.decode(encoded, [model.id_to_piece(i) for i in range(model.vocab_size())])
    got = Counter((r["row"]["doc_id"], tuple(r["row"]["ids"]), r["text"]) for r in back.collect())
    texts = [(r.doc_id, r.text or "") for r in some.collect()]
    assert got == Counter((i, tuple(model.encode(t)), t) for i, t in texts)
    assert pieces.encode(nothing, table).count() == 0


def test_viterbi_fold(spark):
    table = spark.createDataFrame([("▁", 300, -5.0), ("a", 301, -3.0), ("▁a", 302, -4.0), ("ab", 303, -3.5), ("b", 304, -2.0), ("▁ab", 305, -7.0)], "piece string, piece_id int, score double")
    scores = {r.piece: (r.score, r.piece_id) for r in table.collect()}
    texts = ["ab", "abab", "b", "aab", "abé"]
    got = {r.doc_id: r.ids for r in pieces.encode(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), table, fold="viterbi").collect()}
    for i, t in enumerate(texts):
        w = "▁" + t
        best = {0: (0.0, [])}
        for e in range(1, len(w) + 1):
            options = [(best[s][0] + scores[w[s:e]][0], best[s][1] + [scores[w[s:e]][1]]) for s in range(e) if w[s:e] in scores]
            options += [(best[e - 1][0] - 1e6, best[e - 1][1] + [3 + c for c in w[e - 1].encode()])] if w[e - 1] not in scores else []
            best[e] = max(options, key=lambda x: x[0])
        assert got[i] == best[len(w)][1]


def test_both_folds_decode_to_the_text(spark):
    merged, best = ({r.doc_id: r for r in query(spark, SF_DIR).collect()} for query in (queries.op7_pieces, queries.op7_pieces_viterbi))
    assert merged.keys() == best.keys() and all(merged[i].text_sha256 == best[i].text_sha256 for i in merged)
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    assert all(best[i].text_sha256 == hashlib.sha256((t or "").encode()).hexdigest() for i, t in texts.items())


# ---- 8


@pytest.mark.parametrize("shard_rows", [10_000, 60])
def test_top_k(spark, shard_rows):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=6).astype("f4").tolist(), 0) for i in range(400)]
    rows += [(i, rows[3][1], 0) for i in range(400, 460)]  # ties
    odd = [(500, None, 0), (600, [1.0, None] * 3, 0), (700, [float("nan")] * 6, 0), (800, [float("inf")] * 6, 0), (None, rows[1][1], 0), (900, [1.0, 2.0], 0), (901, [], 0), (100, rows[100][1], 0)]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>, score int")
    got = [tuple(r) for r in topk.top_k(topk.quantised(df), F.col("vec_id") % 100 == 0, shard_rows=shard_rows, query_block=3).collect()]
    v = {i: np.floor(1024 * np.array(x, dtype=float)).astype(int) for i, x, _ in rows}
    want = [(q, k + 1, -j, int(s)) for q in v if q % 100 == 0 for k, (s, j) in enumerate(sorted(((int(v[q] @ v[c]), -c) for c in v if c != q), reverse=True)[:10])]
    assert sorted(got) == sorted(want)
    assert topk.top_k(topk.quantised(df.limit(0)), F.col("vec_id") % 100 == 0).count() == 0


def test_regions_and_what_reaches_them(spark, monkeypatch):
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(12, 5)) * 40
    rows = [(i, (centres[i % 12] + rng.normal(size=5)).tolist()) for i in range(3000)] + [(3000 + i, centres[0].tolist()) for i in range(700)]
    df = topk.quantised(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).withColumn("dim", F.size("v"))
    placed = topk._placed(df, 3700, 24, 150)
    sizes = {r.shard: r["count"] for r in placed.groupBy("shard").count().collect()}
    assert sum(sizes.values()) == 3700 and max(sizes.values()) <= 600 and len(sizes) >= 15
    pairs = []
    search = topk._search
    monkeypatch.setattr(topk, "_search", lambda points, targets, *more: (pairs.append(targets.select("query_id", "shard").distinct().count()), search(points, targets, *more))[1])
    got = [tuple(r) for r in topk.top_k(df.drop("dim"), F.col("vec_id") % 100 == 0, shard_rows=150, query_block=5).collect()]
    v = {i: np.floor(1024 * np.array(x)).astype(int) for i, x in rows}
    want = [(q, k + 1, -j, int(s)) for q in v if q % 100 == 0 for k, (s, j) in enumerate(sorted(((int(v[q] @ v[c]), -c) for c in v if c != q), reverse=True)[:10])]
    assert sorted(got) == sorted(want)
    assert sum(pairs) < 37 * len(sizes) / 2  # far from all queries meet all shards


# ---- 9


def test_language(spark, docs, nothing):
    stems = {"en": ["the", "of", "ing", "th"], "de": ["der", "ung", "sch", "ein"], "fr": ["le", "eau", "oux", "ment"]}
    rng = random.Random(9)
    make = lambda lang, n: " ".join("".join(rng.choices(stems[lang], k=2)) for _ in range(n))
    rows = [(i, make(lang, 60), lang) for i, lang in enumerate(["en", "de", "fr"] * 60)]
    learned = langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    tests = [(i, make(lang, 40), lang) for i, lang in enumerate(["en", "de", "fr"] * 20)] + [(100, None, "x"), (101, "12 ! 3", "x"), (102, "", "x")]
    got = langid.predict(spark.createDataFrame(tests, "doc_id long, text string, lang string"), learned).select("row.lang", "lang_pred", "score", "rejected").collect()
    assert all(r.lang_pred == (r.lang if r.lang != "x" else "und") and 0 <= r.score <= 1 and r.rejected == (r.lang == "x") for r in got)
    odd = spark.createDataFrame([(1, "½ ² ① ½ Ⅷ ٣", "x"), (2, "١٢٣ ¾", "x"), (3, "½ der", "x"), (4, "中", "x")], "doc_id long, text string, lang string")
    assert {r.doc_id: (r.lang_pred == "und", r.rejected) for r in langid.predict(odd, learned).select("row.doc_id", "lang_pred", "rejected").collect()}.items() >= {1: (True, True), 2: (True, True)}.items()
    assert {r.lang_pred for r in langid.predict(odd.where("doc_id > 2"), learned).collect()} & {"de"} and "und" not in {r.lang_pred for r in langid.predict(odd.where("doc_id > 2"), learned).collect()}
    assert langid.fit(nothing) == {} and {r.lang_pred for r in langid.predict(docs, {}).collect()} == {"und"}
    assert langid.predict(nothing, learned).count() == 0


def test_language_sample_fills_the_dictionary(spark):
    rng = random.Random(90)
    texts = ["".join(rng.choices("abcdefgh ", k=rng.choice([40, 500, 3000]))) for _ in range(3000)]
    rows = [(i, t, "aa" if i % 3 else "bb") for i, t in enumerate(texts + texts[:1000])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(7)
    found = langid.fit(docs, docs_per_language=50, dictionary_bytes=50 * 60)
    assert {k: len(v) > 2000 for k, v in found.items()} == {"aa": True, "bb": True} and all(len(v) <= 3000 for v in found.values())
    assert found == langid.fit(docs.repartition(3), docs_per_language=50, dictionary_bytes=50 * 60)
    begins = [langid.letters(t)[:20] for t in texts if len(t) == 3000]
    assert sum(b in found["aa"] for b in begins) < 10  # slices come from anywhere


def test_held_out_accuracy(spark):
    got = queries.op9_langid(spark, SF_DIR).join(spark.read.parquet(f"{SF_DIR}/documents.parquet"), "doc_id").where("held_out")
    right, total = got.where("lang_pred = lang").count(), got.count()
    assert right >= 0.95 * total


# ---- 10


def shingles(t: str | None) -> set:
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if c.isascii() else c for c in t or ""))
    return {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()


def test_near_duplicates(spark, docs, nothing):
    base = words(120, 11).split()
    family = [(100 + k, " ".join(base[: 100 + k]), "en", "r", 1) for k in range(0, 20, 2)]  # a chain: neighbours are linked
    rows = DOCS + family
    got = near_dedup.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    ids = sorted({r[0] for r in rows if r[0] is not None})
    root = {i: i for i in ids}
    find = lambda i: i if root[i] == i else find(root[i])
    known = [(i, shingles(t)) for i, t, *_ in rows if i is not None]
    for i, a in known:
        for j, b in known:
            if a and b and 100 * len(a & b) >= 85 * len(a | b):
                x, y = sorted((find(i), find(j)))
                root[y] = x
    want = Counter((i, len(shingles(t)), find(i) if i is not None else None, i is None or find(i) == i) for i, t, *_ in rows)
    assert Counter(map(tuple, got)) == want
    assert near_dedup.near_duplicates(nothing).count() == 0


def test_components(spark):
    edges = [(i + 1, i) for i in range(40)] + [(100, 101), (101, 102), (7, 7), (None, 3), (200, 199)]
    got = {r.node: r.component for r in components.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 102: 100, 199: 199, 200: 199}


# ---- 11


def brute_infill(i: int | None, t: str | None, seed: int = 1) -> tuple:
    t = t or ""
    units = re.findall("[A-Za-z]+|[^A-Za-z]", t)
    h = hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * k : 8 * k + 8], 16) for k in range(4))
    a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    pre, mid, suf = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not t or any(m in t for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return i, len(units), "plain", t, None, None
    if h4 % 100 < 20:
        return i, len(units), "spm", f"<S>{suf}<P>{pre}<M>{mid}", len(pre), len(mid)
    return i, len(units), "psm", f"<P>{pre}<S>{suf}<M>{mid}", len(pre), len(mid)


def test_infill(spark, docs, nothing):
    rng = random.Random(11)
    odd = [(100 + k, "".join(rng.choices(["a", "Zz", "<", ">", "P", "<P", "S>", "<M>", "\n", "\r", "\u2028", "é", "😀", "$1", "\\", " ", "日", "\x00"], k=rng.randint(0, 12))), "", "", 0) for k in range(300)]
    extra = [*odd, (500, "ab 😀" * 400_000, "", "", 0), (501, "x" * 2_000_000, "", "", 0), (-7, "negative id here", "", "", 0)]
    rows = docs.union(spark.createDataFrame(extra, SCHEMA))
    for seed in (1, 5):
        made = infill.fill_in_middle(rows, seed=seed)
        got = Counter((r["row"]["doc_id"], r.n, r.form, r.output, r.prefix_chars, r.middle_chars) for r in made.collect())
        assert got == Counter(brute_infill(i, t, seed) for i, t, *_ in DOCS + extra)
        assert made.where(infill.restore(F.col("output"), F.col("form")) != F.coalesce("row.text", F.lit(""))).count() == 0
    assert {r.form for r in made.select("form").distinct().collect()} == {"plain", "psm", "spm"} and made.schema["row"].dataType == rows.schema
    assert infill.fill_in_middle(nothing).count() == 0


# ---- 12


def brute_licenses(rows: list[tuple]) -> list[tuple]:
    told = [(i, re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))) for i, t, *_ in rows]
    notices = [t.notice.split() for t in licenses.TEMPLATES]
    held = Counter(w for _, words in told for w in set(words))
    rare = [set(sorted(set(n), key=lambda w: (held[w], w))[: licenses.INDEX_WORDS]) for n in notices]
    out = []
    for i, words in told:
        base = sorted((k, label) for phrase, label in licenses.PHRASES.items() for k in range(len(words)) if words[k : k + len(phrase.split())] == phrase.split())
        labels, score = {x for _, x in base}, 1.0 if base else 0.0
        for t, template in enumerate(licenses.TEMPLATES):
            n = notices[t]
            for at in {k - p for k, w in enumerate(words) if w in rare[t] for p, v in enumerate(n) if v == w}:
                agree = [p for p, v in enumerate(n) if 0 <= at + p < len(words) and words[at + p] == v]
                near = f" {' '.join(words[max(at - licenses.SLACK, 0) : max(0, at + len(n) + licenses.SLACK)])} "
                if sum(n[p] in rare[t] for p in agree) >= licenses.MIN_AGREEING and len(agree) / len(n) >= licenses.MIN_SHARE and all(f" {key} " in near for key in template.keys):
                    labels.add(template.label)
                    score = max(score, len(agree) / len(n))
        out.append((i, len(words), len(base), base[0][0] if base else None, base[-1][0] if base else None, ",".join(sorted({x for _, x in base})), ",".join(sorted(labels)), score))
    return out


def test_licenses(spark, docs, nothing):
    rng = random.Random(12)
    parts = [*licenses.PHRASES, *[t.notice for t in licenses.TEMPLATES], "the", "license", "version 3", "gnu", "x", "under", "Lésser"]
    mixed = [(100 + k, rng.choice([" ", "-", ",\n"]).join(rng.sample(parts, rng.randint(1, 6))).title(), "", "", 0) for k in range(120)]
    shaken = [(300 + k, " ".join(w for w in rng.choice(licenses.TEMPLATES).notice.split() if rng.random() < 0.9), "", "", 0) for k in range(120)]
    extra = [*mixed, *shaken, (500, words(50000, 9) + " Under the MIT License! " + words(50000, 10), "", "", 0), (501, "license " * 20000, "", "", 0)]
    rows = docs.union(spark.createDataFrame(extra, SCHEMA))
    joined = lambda c: F.array_join(c, ",").alias(c)
    found = licenses.scan(rows)
    got = found.select("row.doc_id", "n_words", "n_base", "first_word", "last_word", joined("base_labels"), joined("labels"), "score").collect()
    assert Counter(map(tuple, got)) == Counter(brute_licenses(DOCS + extra))
    assert len({r.labels for r in got}) > 20 and found.schema["row"].dataType == rows.schema
    assert licenses.scan(nothing).count() == 0
    assert {r.n_base for r in licenses.scan(rows, templates=(), phrases={}).collect()} == {0}


def test_licence_plan_is_native(spark):
    plan = licenses.scan(queries.table(spark, SF_DIR, "documents"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


# ---- 13


def brute_collocations(rows: list[tuple], least: int, top: int, max_words: int, absorb: int) -> list[tuple]:
    f: dict = {}
    for _, t, lang, *_ in rows:
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")):
            w = [x for x in re.split("[ \t]+", piece) if x]
            for k in range(1, max_words + 1):
                f.setdefault(lang if lang is not None else "und", Counter()).update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, c in f.items():
        n = sum(a for p, a in c.items() if len(p) == 1)
        outer: Counter = Counter()
        for p, a in c.items():
            for k in range(2, len(p) if a >= least else 0):
                for i in range(len(p) - k + 1):
                    outer[p[i : i + k]] = max(outer[p[i : i + k]], a)
        kept = []
        for p, a in c.items():
            if len(p) > 1 and a >= least and not 100 * outer[p] >= absorb * a:
                score, k = min((1000 * a * n // (c[p[:k]] * c[p[k:]]), k) for k in range(1, len(p)))
                kept.append((-score, -a, " ".join(p).encode(), c[p[:k]], c[p[k:]]))
        out += [(lang, i + 1, p.decode(), -a, x, y, n, -s) for i, (s, a, p, x, y) in enumerate(sorted(kept)[:top])]
    return out


PROSE = [
    (200 + k, "".join(random.Random(k).choices(["New York", " ", " ", "of the", "\t", "San ", "A", "b", ", ", ".", "\n", "\x0b", "é\u00a0É", "ÄB", " x x x ", "\u2028", "\x00 ", "the end of the day"], k=60)), ["en", "de", None][k % 3], "", 0)
    for k in range(60)
]


@pytest.mark.parametrize(("least", "top", "max_words", "absorb", "size"), [(2, 50, 5, 100, 700), (3, 1000, 4, 80, 1 << 20), (20, 7, 2, 100, 100), (5, 30, 3, 60, 3000)])
def test_collocations(spark, docs, nothing, least, top, max_words, absorb, size):
    repeated = [(900 + k, "Copies stand in many places of the corpus. Copies stand in many places", "en", "", 0) for k in range(40)]
    extra = [*PROSE, *PROSE[:9], *repeated, (990, "no-end " * 3000, "en", "", 0), (991, "one, two! " * 500, "xx", "", 0)]
    rows = docs.where("doc_id is null or doc_id <> 9").union(spark.createDataFrame(extra, SCHEMA)).repartition(5)
    got = collocations.collocations(rows, least=least, top=top, max_words=max_words, absorb_percent=absorb, shard_bytes=size).collect()
    want = brute_collocations([r for r in DOCS if r[0] != 9] + extra, least, top, max_words, absorb)
    assert sorted(map(tuple, got)) == sorted(want) and len(want) > 5


def test_collocations_without_text(spark, docs, nothing):
    assert collocations.collocations(nothing).count() == 0
    assert collocations.collocations(docs, least=10**6).count() == 0


def test_wide_products(spark):
    rows = spark.createDataFrame([([10**15, 3], [10**15, 7], 10**15, 2 * 10**15)], "firsts array<long>, lasts array<long>, a long, every long")
    got = rows.select(collocations._score(2, F.col("every")).alias("c")).first()["c"]
    assert (got.score, got.l, got.r) == (1000 * 10**15 * 2 * 10**15 // (10**15 * 10**15), 10**15, 10**15)


def test_index_extends_both_ways():
    rng = np.random.default_rng(4)
    ids = rng.integers(0, 5, 400).astype(np.int32)
    seq = collocations.frequent_sequence(ids, np.array([1, 2, 3, 4]))
    plain = seq.tolist()
    sides = [collocations.Side(collocations.transform(s, 4)) for s in (seq, seq[::-1].copy())]
    n = np.bincount(seq, minlength=5)
    start = (np.cumsum(n) - n)[1:]
    phrases, lo, rlo, count = [(s,) for s in range(1, 5)], start, start, n[1:]
    for depth in range(2, 6):
        at, (a, b) = (1, (rlo, lo)) if depth % 2 == 0 else (0, (lo, rlo))
        owner, here, there, count = sides[at].extend(a, b, count)
        lo, rlo = (there, here) if at else (here, there)
        want = Counter(tuple(plain[i : i + depth]) for i in range(len(plain) - depth + 1) if 0 not in plain[i : i + depth])
        symbols = np.repeat(np.arange(len(n)), n)
        grown = [(phrases[o] + (int(symbols_r),) if at else (int(symbols_r),) + phrases[o]) for o, symbols_r in zip(owner, symbols[here], strict=True)]
        assert Counter(dict(zip(grown, count.tolist(), strict=True))) == want
        assert len(set(lo.tolist())) == len(lo) == len(set(rlo.tolist()))
        phrases = grown


def test_hashing_windows_takes_bounded_memory():
    import tracemalloc

    import numpy as np

    made = np.random.default_rng(1).integers(97, 123, (1000, 2000), dtype=np.uint8)
    texts = [(i, 0, row.tobytes()) for i, row in enumerate(made)]
    tracemalloc.start()
    runs = sum(int(count.sum()) for *_, count, _ in suffix_dedup.windows(texts))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert runs == 1000 * (2000 - 49) and peak < 64 << 20


def test_ids_of_words_are_kept_as_machine_integers():
    from array import array

    from runlens.llm import pieces

    segments = {"ab": array("i", [5, 6]), "c": array("i", [7])}
    ids = pieces._by_word(segments, "(?<=b)", lambda x: [ord(x)])
    assert [list(ids(w)) for w in ("ab", "abc", "abd", "abc")] == [[5, 6], [5, 6, 7], [5, 6, 100], [5, 6, 7]]
    assert all(isinstance(ids(w), array) for w in ("ab", "abc")) and ids("ab") is segments["ab"]


def test_words_merge_together_as_each_does_alone():
    import random
    import zlib

    import numpy as np
    import pyarrow as pa
    from pyspark.sql import Row

    from runlens.llm import pieces

    draw = random.Random(7)
    for shared in (False, True) * 20:
        signs = "ab中😀c"[: draw.randint(2, 5)]
        table = sorted({"".join(draw.choices(signs, k=draw.randint(1, 5))) for _ in range(20)})
        rows = [Row(piece=p, piece_id=300 + 3 * i, score=float(draw.randint(-6, 0))) for i, p in enumerate(table)]
        known, merging = {r.piece: r.piece_id for r in rows}, pieces.Merging(rows, 3)
        words = sorted({"".join(draw.choices(signs, k=draw.choice([1, 2, 5, 9, 30, pieces.LONG + 30]))) for _ in range(30)})
        edges = [(i, a, known[w[a : a + n]]) for i, w in enumerate(words) for a in range(len(w)) for n in range(2, 6) if a + n <= len(w) and w[a : a + n] in known]
        draw.shuffle(edges)
        one = {w: merging.word(w, [(a, x) for j, a, x in edges if j == i]) for i, w in enumerate(words)}
        place = [(a << 32) | x for _, a, x in edges]
        crc = [zlib.crc32(words[i].encode()) for i, _, _ in edges]
        found = merging.table(words, pa.table({"crc": pa.array(crc, pa.int64()), "place": pa.array(place, pa.int64())}))
        assert {w: list(x) for w, x in found} == one
        if shared:  # all words share one checksum
            real, zlib.crc32 = zlib.crc32, lambda data: 5
            try:
                found = dict(merging.placed(words, np.full(len(edges), 5, np.int64), np.array(place, np.int64)))
            finally:
                zlib.crc32 = real
            assert {w: list(x) for w, x in found.items()} == one


def test_pieces_send_no_word_per_edge(spark):
    table = spark.createDataFrame([("▁a", 300, -1.0), ("ab", 301, -2.0), ("b", 302, -3.0)], "piece string, piece_id int, score double")
    words = spark.createDataFrame([(0, "▁ab"), (0, "b")], "part int, word string")
    got = pieces.folded(words, table, ["part"], 2, "merge", 3)
    assert got.columns == ["part", "crc", "place"]
    assert sorted((r.place >> 32, r.place & 0xFFFFFFFF) for r in got.collect()) == [(0, 300), (1, 301)]


def test_decoding_runs_in_no_python_worker(spark):
    encoded = spark.createDataFrame([(1, [1, 2, 198, 191, 300]), (2, None), (3, [1, 3 + 0xC3])], "doc_id int, ids array<int>")
    names = ["<unk>", "▁", "a", *[f"<0x{i:02X}>" for i in range(256)], *["x"] * 41, "▁b"]
    back = pieces.decode(encoded, names)
    assert "Arrow" not in back._jdf.queryExecution().executedPlan().toString()
    got = {r["row"]["doc_id"]: r["text"] for r in back.collect()}
    assert got == {1: "aü b".replace("aü", "a" + bytes([195, 188]).decode()), 2: "", 3: "�"}

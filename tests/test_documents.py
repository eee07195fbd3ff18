from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F

from runlens.operators import nested as N

QC = {"flagstat_qc": {"rep1": {"read1": 100, "read2": 200}, "rep2": {"read1": 300, "read2": 400}}, "rep": 1}


def _docs(spark, docs):
    rows = [(i, json.dumps(d)) for i, d in enumerate(docs)]
    return spark.createDataFrame(rows, "i int, t string").select("i", F.parse_json("t").alias("doc"))


def _back(df):
    return {r.i: json.loads(r.doc) for r in df.collect()}


def _random_doc(rng, depth=0, empty=False):
    keys = rng.sample(["a", "b", 'q"uote', "é", "x y", "z{"], rng.randint(0 if empty else 1, 4))
    out = {}
    for k in keys:
        kind = rng.random()
        if kind < 0.45 and depth < 4:
            out[k] = _random_doc(rng, depth + 1, empty)
        else:
            out[k] = rng.choice([1, "s", 'a"b', "{}", None, True, [], [1, {"k": [2]}], [{}], 2.5])
    return out


def test_flatten_golden(spark):
    flat = N.flatten_doc(_docs(spark, [QC]), keep=["i"]).collect()
    assert {(tuple(r.path), r.value) for r in flat} == {
        (("flagstat_qc", "rep1", "read1"), "100"),
        (("flagstat_qc", "rep1", "read2"), "200"),
        (("flagstat_qc", "rep2", "read1"), "300"),
        (("flagstat_qc", "rep2", "read2"), "400"),
        (("rep",), "1"),
    }


def test_unflatten_inverts_flatten(spark):
    rng = random.Random(11)
    docs = [QC] + [_random_doc(rng) for _ in range(150)]
    flat = N.flatten_doc(_docs(spark, docs), keep=["i"], keep_empty=True)
    assert _back(N.unflatten_doc(flat, ["i"])) == dict(enumerate(docs))


def _prune(doc):
    out = {k: _prune(v) if isinstance(v, dict) else v for k, v in doc.items()}
    return {k: v for k, v in out.items() if v != {}}


def test_empty_objects_vanish_or_stay(spark):
    rng = random.Random(12)
    docs = [_random_doc(rng, empty=True) for _ in range(150)]
    kept = N.unflatten_doc(N.flatten_doc(_docs(spark, docs), keep=["i"], keep_empty=True), ["i"])
    assert _back(kept) == dict(enumerate(docs))
    without = _back(N.unflatten_doc(N.flatten_doc(_docs(spark, docs), keep=["i"]), ["i"]))
    assert without == {i: _prune(d) for i, d in enumerate(docs) if _prune(d)}


def _merge(a, b):
    out = dict(a)
    for k, v in b.items():
        out[k] = _merge(out[k], v) if isinstance(out.get(k), dict) and isinstance(v, dict) else v
    return out


def test_merge_equals_a_fold(spark):
    rng = random.Random(13)
    triples = [[_random_doc(rng, empty=True) for _ in range(3)] for _ in range(150)]
    want = {i: _merge(_merge(a, b), c) for i, (a, b, c) in enumerate(triples)}
    rows = [(i, j, json.dumps(d)) for i, t in enumerate(triples) for j, d in enumerate(t)]
    layers = spark.createDataFrame(rows, "i int, layer int, t string").withColumn("doc", F.parse_json("t"))
    got = _back(N.merge_docs(layers, "i", "layer"))
    assert got == {i: d for i, d in want.items() if d}


def test_split_golden(spark):
    doc = {
        "flagstat_qc": QC["flagstat_qc"],
        "etc": {"samstat_qc": {"rep1": {"unmapped": 500, "mapped": 600}, "rep2": {"unmapped": 700, "mapped": 800}}},
        "idr_qc": {"qc_test1": 900},
    }
    out = N.split_docs(_docs(spark, [doc]), [("replicate", r"^rep\d+$")], keep=["i"])
    assert {r.key: json.loads(r.doc) for r in out.collect()} == {
        None: {"idr_qc": {"qc_test1": 900}},
        "rep1": {"flagstat_qc": {"read1": 100, "read2": 200}, "etc": {"samstat_qc": {"unmapped": 500, "mapped": 600}}, "replicate": "rep1"},
        "rep2": {"flagstat_qc": {"read1": 300, "read2": 400}, "etc": {"samstat_qc": {"unmapped": 700, "mapped": 800}}, "replicate": "rep2"},
    }


def _leaves(value):
    if isinstance(value, dict):
        for v in value.values():
            yield from _leaves(v)
    elif isinstance(value, list):
        for v in value:
            yield from _leaves(v)
    else:
        yield json.dumps(value, ensure_ascii=False)


def test_leaf_walk(spark):
    rng = random.Random(14)
    docs = [_random_doc(rng, empty=True) for _ in range(100)]
    got: dict[int, list[str]] = {}
    for r in N.leaf_values(_docs(spark, docs), keep=["i"]).collect():
        got.setdefault(r.i, []).append(r.json)
    assert {i: sorted(v) for i, v in got.items()} == {i: sorted(_leaves(d)) for i, d in enumerate(docs) if list(_leaves(d))}
    order = N.leaf_values(_docs(spark, [{"l": list(range(12))}]), keep=["i"]).orderBy("pos").collect()
    assert [r.value for r in order] == [str(i) for i in range(12)]


def test_any_depth_whatever_is_unrolled(spark):
    deep = [1, {"z": None, "a": "{["}, []]
    for i in range(30):
        deep = {f"k{i}": deep, "other": {}, "n": i} if i % 3 else [deep, i]
    docs = _docs(spark, [{"a": {"b": {"c": [1]}}}, {"top": deep}])
    for walk in (N.leaf_values, N.flatten_doc):
        rows = [sorted(map(str, walk(docs, keep=["i"], levels=n).collect())) for n in (0, 2, 40)]
        assert rows[0] == rows[1] == rows[2]
    assert max(len(r.path) for r in N.leaf_values(docs, keep=["i"]).collect()) == 33

from __future__ import annotations

import fnmatch
import os
import random

import pytest
from pyspark.sql import functions as F

from runlens.functions import ids as I, includes as N, labels as L, sizes as Z, uris as U
from runlens.operators import jobs


def _map(spark, values, fn):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r.out for r in df.select("i", fn(F.col("v")).alias("out")).orderBy("i").collect()]


UUIDS = {
    "asldkhjlkasdf289jisdl;sladkjasdflksd": False,
    "engine-f9c26f2e-f550-4748-a650-5d0d4cab9f3a": False,
    "f9c26f2e-f550-4748-a650-5d0d4c": False,
    "f9c26f2e-f550-4748-a650-5d0d4cab9f3a": True,
    "F9C26f2e-F550-4748-A650-5D0D4cab9f3a": False,
    "f9c26f2e": False,
    "": False,
    None: False,
    "f9c26f2ef5504748a6505d0d4cab9f3a": True,
    "{f9c26f2e-f550-4748-a650-5d0d4cab9f3a}": True,
    "11111111-1111-1111-1111-111111111111": False,
}


def test_uuid(spark):
    assert _map(spark, UUIDS, I.is_valid_uuid) == list(UUIDS.values())
    assert [I.uuid_ok(v) for v in UUIDS] == list(UUIDS.values())
    assert not I.uuid_ok([])


def test_has_wildcard(spark):
    for value in ("?????", "*", "?", ("*", "?"), ["a", ["b*"]]):
        assert I.has_wildcard(value)
    for value in (("lskadfj", "sdkfjaslf"), ":", ("_", "-", "x"), [], (), None):
        assert not I.has_wildcard(value)
    assert _map(spark, ["a*", "b", None], I.has_wildcard) == [True, False, False]


def test_wildcard_match_like_the_standard_matcher(spark):
    rng = random.Random(7)
    texts = ["".join(rng.choice("ab.-[]*\n\\^") for _ in range(rng.randint(0, 5))) for _ in range(300)]
    patterns = ["*", "a*", "*b", "?", "a?b*", "[ab]*", "[!a]*", "[]]*", "[!]]*", "a[", "[a-b]?", "[b-a]*", "[!b-a]", "[\\^]*", "[-a]*", ".*", "a", ""]
    for pattern in patterns:
        want = [fnmatch.fnmatchcase(t, pattern) for t in texts]
        assert _map(spark, texts, lambda v: I.wildcard_match(v, pattern)) == want, pattern


def test_sizes(spark):
    sizes = {
        "3.75 GB": 3_750_000_000, "512 MiB": 512 << 20, "1024": 1024, "5 bytes": 5, "1k": 1000, "2 gigabytes": 2 * 10**9,
        "2 gibibytes": 2 << 30, "10.5": 10, "GB": None, "5 xx": None, "5 GB 3": None, None: None, " 7 TB ": 7 * 10**12,
    }
    assert _map(spark, sizes, Z.parse_size) == list(sizes.values())
    disks = {"local-disk 10 HDD": 10 << 30, "local-disk 375 SSD, x 5": 375 << 30, "HDD": None, None: None}
    assert _map(spark, disks, Z.parse_disk) == list(disks.values())


def test_uris(spark):
    paths = ["/a/b.txt", "/a/.rc", "a", "/x", "gs://b/c.d.e", "/a/b/", "/..x", "/a..x", "/", "/a//b"]
    assert _map(spark, paths, U.basename_wo_ext) == [os.path.splitext(os.path.basename(p))[0] for p in paths]
    assert _map(spark, paths, U.extension) == [os.path.splitext(os.path.basename(p))[1] for p in paths]
    assert _map(spark, paths, U.path_dirname) == [os.path.dirname(p) for p in paths]
    assert _map(spark, paths, U.dirname) == ["/".join(p.split("/")[:-1]) for p in paths]
    schemes = {"gs://a": "gs", "s3://a": "s3", "http://a": "http", "https://a": "http", "/a": "local", "a": None, None: None}
    assert _map(spark, schemes, U.uri_scheme) == list(schemes.values())
    messy = ["/a/./b/../c", "/../a//b", "/a/b/../../../c"]
    assert _map(spark, messy, U.normalise_path) == [os.path.normpath(p) for p in messy]


def test_labels(spark):
    assert _map(spark, ["my:str?label*", "ok"], L.clean_label) == ["my_str_label_", "ok"]
    assert _map(spark, ["my:str?label*", "ok"], L.label_changed) == [True, False]
    assert L.Naming("acme").image_keys("conda") == ["default_conda", "default_conda_env", "acme_conda", "acme_conda_env"]


CONFIG = """\
include required(classpath("application"))
include required(file("application"))
include required(url("application"))
include required("application.conf")
level1 {
  include file("/srv/test.conf")
  level2 {
    include url("http://ok.com/test.conf")
    level3 {
      include classpath("test")
      level4 {
        include "test.conf"
        level5 {
          include "test.hocon"
        }
      }
    }
  }
}"""


def test_includes(spark):
    statements = _map(spark, [CONFIG], N.all_statements)[0]
    assert len(statements) == 9 and statements[-1] == 'include "test.hocon"'
    wrapped = _map(spark, [CONFIG], N.wrap_includes)
    assert "include \\\"test.hocon\\\"" in wrapped[0] and wrapped[0].count("HOCONSTRING_INCLUDE_") == 9
    assert _map(spark, wrapped, N.restore_includes) == [CONFIG]
    stripped = _map(spark, wrapped, N.strip_includes)[0]
    assert "include" not in stripped.lower() and stripped.count("level") == 5


def test_host_port(spark):
    got = _map(spark, ["h:80\n", "h", "a:b:c", "h:x", None], jobs.parse_host_port)
    assert [tuple(g) if g else None for g in got] == [("h", 80), None, None, None, None]


@pytest.mark.parametrize("seconds, alive", [(1, True), (5, True), (5.001, False)])
def test_alive(spark, seconds, alive):
    beats = spark.sql("SELECT 's' server, 'h:1' text, timestamp'2024-01-01 00:00:00' ts UNION ALL SELECT 's', 'h:0', timestamp'2023-01-01 00:00:00'")
    now = F.timestamp_micros(F.unix_micros(F.lit("2024-01-01").cast("timestamp")) + int(seconds * 1e6))
    row = jobs.alive(beats, now, 5000).first()
    assert (row.host, row.port, row.alive) == ("h", 1, alive)


def test_leader_jobs(spark):
    lines = spark.createDataFrame([(0, "JOBID NAME"), (1, "1 RUN_x"), (2, "2 other")], "line_no int, line string")
    assert [r.line_no for r in jobs.leader_jobs(lines).collect()] == [0, 1]

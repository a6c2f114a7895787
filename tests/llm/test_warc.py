import hashlib

import pytest
from pyspark.sql import functions as F

from podium.llm import warc
from podium.llm.common import arrow_uri, scratch_path, task_uri

BIG = "<p>é" + "x" * 200
ROWS = [
    (5, "https://www.Example.com/a?q=1#f", BIG), (2, "http://b.org/x", BIG), (9, "http://b.org/x", BIG), (2, "http://b.org/y", BIG),
    (3, "http://b.org/small", "s" * 99), (4, "http://b.org/small2", "s" * 99), (6, None, None), (7, "no scheme", ""),
    (None, "http://c.org/\r\nX: y\t", BIG), (8, "http://b.org/x", "other" * 50), (10, "http://n.org/", "\r\n\r\n" + "q" * 120),
]


def archive(spark, rows):
    pages = spark.createDataFrame([(*r, "z") for r in rows], "page_id long, url string, html string, digest string")
    folder = scratch_path(spark, "test-warc")
    return warc.build_index(warc.write(pages, folder), folder)


def test_round_trip(spark, monkeypatch):
    monkeypatch.setattr(warc, "BLOCK_LINES", 2)
    monkeypatch.setattr(warc, "SHARD_LINES", 4)
    shards = archive(spark, ROWS)
    got = warc.read_all(shards, payload=True).collect()
    assert len(got) == len(ROWS)
    want = sorted(
        (
            -1 if p is None else p, len((h or "").encode()), hashlib.sha256((h or "").encode()).hexdigest(),
            "revisit" if h == BIG and p != 2 else "response", 2 if h == BIG and p != 2 else -1, "" if h == BIG and p != 2 else h or "",
        )
        for p, _, h in ROWS
    )
    assert sorted((-1 if r.page_id is None else r.page_id, r.payload_bytes, r.payload_digest, r.record_type, -1 if r.refers_to is None else r.refers_to, r.payload or "") for r in got) == want
    # keys over several blocks and shards are found whole
    asked = spark.createDataFrame([("http://b.org/x",), ("https://WWW.example.com/a?q=1",), ("http://nowhere/",), ("http://b.org/",)], "url string")
    found = [(r.asked, r.page_id) for r in warc.lookup(shards, asked).collect()]
    assert sorted(found) == [("http://b.org/x", 2), ("http://b.org/x", 8), ("http://b.org/x", 9), ("https://WWW.example.com/a?q=1", 5)]


def test_lookup_equals_scan(spark, monkeypatch):
    monkeypatch.setattr(warc, "BLOCK_LINES", 3)
    rows = [(i, f"http://h{i % 7}.org/{i % 11}", f"page {i} " * 30) for i in range(200)]
    shards = archive(spark, rows)
    urls = sorted({u for _, u, _ in rows})
    got = warc.lookup(shards, spark.createDataFrame([(u,) for u in urls], "url string")).collect()
    assert sorted((r.asked, r.page_id) for r in got) == sorted((u, i) for i, u, _ in rows)


def test_empty(spark):
    shards = archive(spark, [])
    assert warc.read_all(shards).collect() == []
    assert warc.lookup(shards, spark.createDataFrame([("http://a/",)], "url string")).collect() == []


def test_lookup_at_size_equals_the_scan(spark, monkeypatch):
    """100,000 captures over many shards and blocks, a third of them under one url."""
    monkeypatch.setattr(warc, "SHARD_LINES", 4096)
    hot = F.pmod("id", F.lit(3)) == 0
    url = F.when(hot, "http://hot.org/x").when(F.pmod("id", F.lit(1000)) != 1, F.concat(F.lit("http://h"), F.pmod("id", F.lit(977)), F.lit(".org/"), F.col("id")))
    pages = spark.range(100_000).select(F.col("id").alias("page_id"), url.alias("url"), F.concat(F.lit("page "), F.col("id")).alias("html"))
    folder = scratch_path(spark, "test-warc")
    shards = warc.build_index(warc.write(pages, folder), folder)
    assert shards.count() > 20
    found = warc.find(shards, pages.select(warc.url_key(F.col("url")).alias("key")).distinct())
    scan = warc.entries(shards)
    assert found.count() == scan.count() == 100_000
    assert found.exceptAll(scan).isEmpty() and scan.exceptAll(found).isEmpty()
    got = warc._records(shards, found, payload=False)
    assert got.select("page_id").distinct().count() == 100_000
    some = spark.createDataFrame([("http://hot.org/x",), ("http://h5.org/982",), ("http://h5.org/983",)], "url string")
    assert {(r.asked, r["count"]) for r in warc.lookup(shards, some).groupBy("asked").count().collect()} == {("http://hot.org/x", 33334), ("http://h5.org/982", 1)}


def test_records_are_read_by_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(warc, "TASK_BYTES", 2000)
    pages = spark.range(400).select(F.col("id").alias("page_id"), F.concat(F.lit("http://a.org/"), "id").alias("url"), F.sha2(F.col("id").cast("string"), 512).alias("html"))
    folder = scratch_path(spark, "test-warc")
    shards = warc.build_index(warc.write(pages, folder), folder)
    tasks = warc.read_all(shards).select(F.spark_partition_id().alias("p")).distinct().count()
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true" and tasks > 10


def test_paths_for_tasks(spark, tmp_path):
    assert arrow_uri("file:/a b/c") == arrow_uri("file:///a b/c") == "file:///a b/c"
    assert arrow_uri("s3a://bucket/x") == "s3://bucket/x"
    assert arrow_uri("hdfs://name:8020/x") == "hdfs://name:8020/x"
    for bad in ("viewfs://c/x", "/no/scheme"):
        with pytest.raises(ValueError, match="pyarrow"):
            arrow_uri(bad)
    assert task_uri(spark, str(tmp_path)) == f"file://{tmp_path}"
    # a path without a scheme goes to the default file system, not to each machine's own
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    was = conf.get("fs.defaultFS")
    conf.set("fs.defaultFS", "viewfs://cluster/")
    conf.set("fs.viewfs.mounttable.cluster.link./shared", f"file://{tmp_path}")
    try:
        with pytest.raises(ValueError, match="viewfs://cluster/shared/x"):
            task_uri(spark, "/shared/x")
        assert task_uri(spark, f"file:{tmp_path}") == f"file://{tmp_path}"
    finally:
        conf.set("fs.defaultFS", was)

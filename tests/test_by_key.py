"""Reads by key: few files, also behind a compaction and a replay."""

import os

from pyspark.sql import functions as F

from viewtally.sinks import by_key as BK
from viewtally.sinks import snapshot

DAY = 86_400_000
SCHEMA = "bucket_ms bigint, video string, n bigint"
KEYS = ["bucket_ms", "video"]


def batch(spark, b, days=2, videos=40):
    return spark.createDataFrame([(d * DAY + (b + k) % 7 * 60_000, f"v{k:02}", b * 100 + k)
                                  for d in range(days) for k in range(videos)], SCHEMA)


def lookup(spark, root, video, **kw):
    return {(r.bucket_ms, r.n) for r in BK.lookup(spark, root, "video", video, KEYS, SCHEMA, **kw).collect()}


def test_a_key_opens_its_own_files(spark, tmp):
    root = os.path.join(tmp, "t")
    assert lookup(spark, root, "v01") == set()
    for b in range(6):
        BK.write(batch(spark, b), root, b, "video", "bucket_ms")
    BK.write(batch(spark, 5), root, 5, "video", "bucket_ms")        # a replay
    everything = snapshot.latest(spark, root, KEYS)
    files = [f for d, _s, names in os.walk(root) if "_keys" not in d for f in names if f.endswith(".parquet")]
    for video in ("v00", "v17", "v39", "v99"):
        want = {(r.bucket_ms, r.n) for r in everything.where(F.col("video") == video).collect()}
        assert lookup(spark, root, video) == want
        # one file for each (day, batch) at most, of four
        assert len(BK.files_of(spark, root, video)) <= 6 * 2 <= len(files) / 2
    assert len(BK.files_of(spark, root, "v17", ["1970-01-02"])) <= 6
    assert lookup(spark, root, "v17", days=["1970-01-02"]) == {x for x in lookup(spark, root, "v17") if x[0] >= DAY}


def test_the_index_survives_compaction(spark, tmp):
    root, want = os.path.join(tmp, "t"), {}
    for b in range(13):
        BK.write(batch(spark, b), root, b, "video", "bucket_ms")
        want |= {(r.bucket_ms, r.video): r.n for r in batch(spark, b).collect()}
        if b and b % 4 == 0:
            BK.compact(spark, root, KEYS, "video", b - 1, 4)
        assert lookup(spark, root, "v17") == {(t, n) for (t, v), n in want.items() if v == "v17"}
    paths = BK.files_of(spark, root, "v17")
    assert all(os.path.exists(p.removeprefix("file:").replace("///", "/")) for p in paths)
    folders = sum(n.startswith("batch_id=") for d in snapshot.names(spark, root) if d.startswith("day=")
                  for n in snapshot.names(spark, f"{root}/{d}"))
    assert folders < 26 and len(paths) <= 2 * folders


def test_bloom_filters_are_written(spark, tmp):
    root = os.path.join(tmp, "t")
    BK.write(batch(spark, 0), root, 0, "video", "bucket_ms")
    [one, *_] = BK.files_of(spark, root, "v17")
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(one)
    source = jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(path, spark._jsc.hadoopConfiguration())
    reader = jvm.org.apache.parquet.hadoop.ParquetFileReader.open(source)
    try:
        columns = [c for b in reader.getFooter().getBlocks() for c in b.getColumns() if "video" in c.getPath().toString()]
        assert columns and all(reader.readBloomFilter(c) is not None for c in columns)
    finally:
        reader.close()

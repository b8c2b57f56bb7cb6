"""The topic: partitions by key, order, visibility, failed tasks, repeated batches, racing writers."""

import collections
import json
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from shelfwise.sources import sinks
from shelfwise.sources import topic as TP


@pytest.fixture(scope="module", autouse=True)
def registered(spark):
    TP.register(spark)


def messages(spark, path):
    return spark.read.format(TP.FORMAT).option("path", path).load()


def test_events_are_written_by_key_and_keep_their_order(spark, tmp_path):
    rows = [(f"{n}", "click", f"http://x/{n % 7}" if n % 5 else "", f"{n}") for n in range(400)]
    events = spark.createDataFrame(rows, "event_uuid string, event_type string, url string, payload string").coalesce(1)
    for _ in range(2):
        sinks.write_topic(events, TP.FORMAT, path=f"{tmp_path}/t", partitions="5")
    got = messages(spark, f"{tmp_path}/t").collect()
    assert len(got) == 800 and all(r.partition == TP.partition_of(r.key, 5) for r in got)
    for p in range(5):
        mine = sorted((r.offset, json.loads(r.value)["payload"]) for r in got if r.partition == p)
        assert [o for o, _ in mine] == list(range(len(mine)))
        half = len(mine) // 2
        assert [int(v) for _, v in mine[:half]] == sorted(int(v) for _, v in mine[:half]) and [v for _, v in mine[half:]] == [v for _, v in mine[:half]]
    assert TP.partition_of("1001", 1 << 32) == 597150807  # as the hash of shards


def test_a_failed_task_leaves_nothing(spark, tmp_path):
    path = f"{tmp_path}/t"
    good = spark.range(50).select(F.col("id").cast("string").alias("key"), F.lit("v").alias("value"))
    good.write.format(TP.FORMAT).option("path", path).mode("append").save()
    bad = spark.range(0, 100, 1, 4).select(F.col("id").cast("string").alias("key"), F.when(F.col("id") == 99, F.raise_error(F.lit("down"))).otherwise("v").alias("value"))
    with pytest.raises(Exception):
        bad.write.format(TP.FORMAT).option("path", path).mode("append").save()
    assert messages(spark, path).count() == 50
    assert messages(spark, f"{tmp_path}/none").count() == 0
    with pytest.raises(Exception):
        good.write.format(TP.FORMAT).option("path", path).mode("overwrite").save()


def test_streams_into_and_out_of_a_topic(spark, tmp_path):
    path = f"{tmp_path}/t"
    spark.range(30).select(F.col("id").cast("string").alias("key"), F.concat(F.lit("v"), "id").alias("value")).repartition(3).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema("key string, value string").option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    write = lambda s, **o: s.writeStream.format(TP.FORMAT).options(path=path, **o).option("checkpointLocation", f"{tmp_path}/ck").trigger(availableNow=True).start().awaitTermination()
    write(stream, run="a")
    write(stream, run="a")  # nothing new
    assert collections.Counter(r.key for r in messages(spark, path).collect()) == {str(k): 1 for k in range(30)}
    topic = TP.Topic(path)
    before = topic.entries()
    topic.commit([], before[0]["batch"])  # a batch that is committed again
    assert topic.entries() == before and len(before) == 3
    out = spark.readStream.format(TP.FORMAT).option("path", path).load()
    got = []
    for _ in range(2):
        out.writeStream.foreachBatch(lambda b, n: got.extend(b.collect())).option("checkpointLocation", f"{tmp_path}/ck2").trigger(processingTime="0 seconds").start().processAllAvailable()
        for q in spark.streams.active:
            q.stop()
    assert sorted(int(r.key) for r in got) == list(range(30))


def test_racing_writers_take_different_numbers(tmp_path):
    topic = TP.Topic(str(tmp_path / "t"))
    segment = lambda n: [{"partition": 0, "task": 0, "number": 0, "name": f"s{n}", "count": 10}]
    with ThreadPoolExecutor(8) as pool:
        list(pool.map(lambda n: TP.Topic(topic.root).commit(segment(n)), range(24)))
    entries = topic.entries()
    assert len(entries) == 24 and {e["segments"][0]["name"] for e in entries} == {f"s{n}" for n in range(24)}
    assert [e["segments"][0]["first"] for e in entries] == [10 * k for k in range(24)]

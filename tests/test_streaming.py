"""Keyed state, idempotent appends with their index, and joins of streams."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from shelfwise.sources import files
from shelfwise.streaming import events as ST
from shelfwise.streaming import latest as L
from shelfwise.streaming import token_index as TI


def test_latest_is_kept_over_a_restart_and_state_grows_with_the_batch(spark, tmp_path):
    rows = [(k % 50 if k < 100 else k % 3, k, f"{k}") for k in range(130)]  # a hundred rows, then thirty of three keys
    df = spark.createDataFrame(rows, "k long, v long, t string")
    for n, part in enumerate((df.where("v < 100"), df.where("v >= 100 and v < 115"), df.where("v >= 115"))):
        part.coalesce(1).write.parquet(f"{tmp_path}/in{n}")
    df.limit(0).write.parquet(f"{tmp_path}/live")
    one = ST.read_stream(spark, f"{tmp_path}/live", df.schema)
    updated = []
    for n in range(3):  # a new run for every file
        spark.read.parquet(f"{tmp_path}/in{n}").coalesce(1).write.mode("append").parquet(f"{tmp_path}/live")
        q = L.keep_latest(one, ["k"], ["v"], f"{tmp_path}/ck")
        q.awaitTermination()
        updated.append(max(p.stateOperators[0].numRowsUpdated for p in q.recentProgress if p.stateOperators))
        want = {k: str(v) for k, v, _ in rows[: (100, 115, 130)[n]]}
        assert {r.k: r.t for r in L.read_latest(spark, f"{tmp_path}/ck").collect()} == want
    assert updated == [50, 3, 3]
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass", None) is None


def test_appends_are_once_and_read_no_more_files_as_they_grow(spark, tmp_path):
    path = f"{tmp_path}/once"
    add = TI.append_once(path, "t", "t", every=4, bucket_tokens=2)
    reads = []
    for n in range(17):
        batch = spark.createDataFrame([(f"{k}",) for k in range(n * 5, n * 5 + 8)], "t string")  # three of the batch after
        tokens = batch.select(F.sha2("t", 256).alias("token"))
        reads.append(len(TI.seen_tokens(spark, path, tokens).inputFiles()))
        add(batch, n)
        if n % 5 == 0:
            add(batch, n)  # handed over again
    got = sorted(int(r.t) for r in TI.read_appended(spark, path).collect())
    assert got == list(range(88))
    upto, digits = TI.covered(spark, path)
    assert upto >= 12 and 16**digits * 2 >= 88
    assert max(reads[9:]) <= max(8 + 4 * 4, max(reads[:9]) + 8)  # own buckets and at most four appends
    buckets = files.names(spark, f"{path}-tokens/digits={digits}")
    assert all(len([v for v in files.names(spark, f"{path}-tokens/digits={digits}/{b}") if v.startswith("upto=")]) == 1 for b in buckets if b.startswith("bucket="))


def test_interrupted_append_and_lost_index(spark, tmp_path):
    path = f"{tmp_path}/once"
    add = TI.append_once(path, "t", "t", every=2)
    batch = lambda *v: spark.createDataFrame([(x,) for x in v], "t string")
    add(batch("a", "b", "a"), 0)
    batch("c").withColumn("token", F.lit("x")).write.parquet(f"{path}/append=1")
    files.delete(spark, f"{path}/append=1/_SUCCESS")  # as if the driver had been lost before the end
    assert TI.appends(spark, path) == [0]
    add(batch("b", "c"), 1)
    files.delete(spark, f"{path}-tokens")
    add(batch("a", "c", "d"), 2)
    add(batch(), 3)
    assert sorted(r.t for r in TI.read_appended(spark, path).collect()) == ["a", "b", "c", "d"]


def test_details_of_two_streams_come_out_once(spark, tmp_path):
    at = lambda m: datetime(2026, 1, 1) + timedelta(minutes=m)
    left = [(1, at(0), "l1"), (2, at(1), "l2"), (4, at(30), "l4"), (None, at(31), "l0"), (99, at(6000), "end")]
    right = [(1, at(3), "r1"), (3, at(2), "r3"), (4, at(90), "r4"), (99, at(6000), "end")]
    for name, rows, c in (("l", left, "a"), ("r", right, "b")):
        for n, (low, high) in enumerate(((0, 20), (20, 100), (100, 9000))):
            part = [r for r in rows if low <= (r[1] - at(0)).total_seconds() / 60 < high]
            spark.createDataFrame(part, f"code long, ts timestamp, {c} string").coalesce(1).write.mode("append").parquet(f"{tmp_path}/{name}")
    read = lambda name: ST.read_stream(spark, f"{tmp_path}/{name}", spark.read.parquet(f"{tmp_path}/{name}").schema)
    got = []
    both = ST.join_details(read("l"), read("r"), "code", "ts", "10 minutes", "5 minutes")
    ST.publish(both, lambda batch, n: got.extend(batch.collect()), f"{tmp_path}/ck").awaitTermination()
    rows = sorted(((r.code, r.a, r.b) for r in got if r.code != 99), key=str)
    assert rows == sorted([(1, "l1", "r1"), (2, "l2", None), (3, None, "r3"), (4, "l4", None), (4, None, "r4"), (None, "l0", None)], key=str)


@pytest.mark.parametrize("scheme", ["", "file://"])
def test_one_of_many_creates_a_file(spark, tmp_path, scheme):
    from concurrent.futures import ThreadPoolExecutor

    path = f"{scheme}{tmp_path}/a b/marker"
    with ThreadPoolExecutor(8) as pool:
        made = list(pool.map(lambda n: files.create_once(spark, path, f"{n}"), range(8)))
    assert made.count(True) == 1 and files.read_text(spark, path) == str(made.index(True))
    assert files.names(spark, f"{scheme}{tmp_path}/a b") == ["marker"]

"""The newest row of every key of a stream, as keyed state.

The state is a streaming aggregate in RocksDB: a batch reads and writes the keys it brings, and a checkpoint adds a log
of those changes, whatever the history.  It stays inside the JVM, which a state processor in Python would not.  The
table is the state itself: readers ask the checkpoint for it, as of the last batch that was committed.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


@contextmanager
def keyed_state(spark: SparkSession):
    """Queries that start inside keep their state in RocksDB and log its changes."""
    before = {k: spark.conf.get(k, None) for k in STATE}
    for k, v in STATE.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def latest_rows(stream: DataFrame, keys: list[str], version: list[str]) -> DataFrame:
    """One row a key: the other columns of the row with the largest version."""
    rest = [c for c in stream.columns if c not in keys]
    return stream.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*version)).alias("latest"))


def keep_latest(stream: DataFrame, keys: list[str], version: list[str], checkpoint: str, *, once: bool = True) -> StreamingQuery:
    """Fold a stream into the state of its checkpoint, from where the last run of it ended."""
    writer = latest_rows(stream, keys, version).writeStream.outputMode("update").format("noop").option("checkpointLocation", checkpoint)
    with keyed_state(stream.sparkSession):
        return (writer.trigger(availableNow=True) if once else writer).start()


def read_latest(spark: SparkSession, checkpoint: str, batch: int | None = None) -> DataFrame:
    """The newest row of every key after the last batch, or after an earlier one that is still kept."""
    reader = spark.read.format("statestore")
    with keyed_state(spark):
        state = (reader if batch is None else reader.option("batchId", batch)).load(checkpoint)
    buffer = next(f.name for f in state.schema["value"].dataType.fields if f.name.startswith("valueWith"))
    return state.select("key.*", f"value.{buffer}.*")

"""Streams run over the files that are there."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager, nullcontext

from pyspark.sql import DataFrame, SparkSession

PROVIDER_CONF = "spark.sql.streaming.stateStore.providerClass"
CHANGELOG_CONF = "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled"
ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def rocksdb_state(spark: SparkSession) -> Iterator[None]:
    """Keep the state of streams started inside in RocksDB, with changes as checkpoints."""
    wanted = {PROVIDER_CONF: ROCKSDB_PROVIDER, CHANGELOG_CONF: "true"}
    before = {name: spark.conf.get(name, None) for name in wanted}
    for name, value in wanted.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def run_to_end(spark: SparkSession, stream: DataFrame, out: str, checkpoint: str,
               rocksdb: bool = True) -> DataFrame:
    """Process all files that are there in micro-batches and read all that was ever written to ``out``.

    With the same folders again, only new files are read and state goes on from the last batch. Without
    ``rocksdb`` state is kept as the session says.
    """
    with rocksdb_state(spark) if rocksdb else nullcontext():
        running = (
            stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
            .outputMode("append").trigger(availableNow=True).start()
        )
        running.awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)

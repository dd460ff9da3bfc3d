"""Incremental ingestion: new bundles since the last run go into the store."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from figloom.operators.store import Store
from figloom.session import prepare
from figloom.sources.bundles import index_bundles

_FILE = "path string, modificationTime timestamp, length long, content binary"


def ingest(spark: SparkSession, raw: str, store: Store, checkpoint: str, force: bool = False) -> None:
    """Reads every archive that the checkpoint hasn't seen, then stops. A batch that is repeated after a failure changes nothing."""
    store.create()

    def upsert(batch: DataFrame, _: int) -> None:
        store.upsert("docs", index_bundles(batch, store.read("docs"), force))

    stream = prepare(spark).readStream.format("binaryFile").schema(_FILE).option("recursiveFileLookup", "true").option("pathGlobFilter", "*.{zip,ZIP}").load(raw)
    stream.writeStream.foreachBatch(upsert).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()

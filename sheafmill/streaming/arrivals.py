"""New files as a stream: read once each, parsed where they lie, written as elements and errors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..sources import files

BINARY = "path string, modificationTime timestamp, length bigint, content binary"


def arriving(spark: SparkSession, folder: str, parsers: dict | None = None, per_trigger: int = 1000) -> DataFrame:
    """A streaming element table of the files that appear under a folder."""
    found = spark.readStream.format("binaryFile").schema(BINARY).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", per_trigger).load(folder)
    return files.parse_files(found, parsers)


def ingest(spark: SparkSession, folder: str, target: str, checkpoint: str, parsers: dict | None = None, available_now: bool = True) -> StreamingQuery:
    """Append the elements of new files under ``target``: ``elements`` and ``errors``. The checkpoint knows what was read."""

    def write(batch: DataFrame, number: int) -> None:
        batch.persist()
        files.good(batch).write.mode("append").parquet(f"{target}/elements")
        files.errors(batch).write.mode("append").parquet(f"{target}/errors")
        batch.unpersist()

    writer = arriving(spark, folder, parsers).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()

"""Incremental ingest of a landing folder with Structured Streaming.

The batch chain re-reads every file on each run. Here new per-entity files in
a landing folder are picked up incrementally: a file source (schema fixed up
front, one header layout per stream) feeds an append-only Parquet sink whose
commit log makes each file land exactly once, even if the job is killed and
restarted. ``availableNow`` processes what has arrived and stops, so the same
code runs as a scheduled batch or as a continuously running stream.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.text import entity_from_filename, header_name, header_name_dictionary


def bronze_stream(spark: SparkSession, landing: str, header: Sequence[str], pattern: str = "*.csv",
                  header_rule: str = "generic", entity_from: str = "file",
                  max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming bronze rows: text columns named by the header rule, plus
    ``source_file`` and ``ticker`` from the file (or its folder) name."""
    rename = header_name if header_rule == "generic" else header_name_dictionary
    schema = StructType([StructField(rename(h), StringType()) for h in header])
    reader = (spark.readStream.schema(schema).option("header", True)
              .option("pathGlobFilter", pattern).option("recursiveFileLookup", "true"))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    rows = reader.csv(landing)
    if entity_from == "directory":
        name = F.regexp_extract(F.col("_metadata.file_path"), r"([^/=]+)/[^/]*$", 1)
    else:
        name = F.col("_metadata.file_name")
    return rows.withColumn("source_file", name).withColumn("ticker", entity_from_filename(F.col("source_file")))


def start_ingest(stream: DataFrame, target: str, checkpoint: str | None = None,
                 available_now: bool = True, processing_time: str | None = None) -> StreamingQuery:
    """Append the stream to a Parquet folder; the checkpoint records which files landed.
    It lies beside the target unless named, so that a restarted job, in whatever
    session, finds it."""
    checkpoint = checkpoint or f"{target.rstrip('/')}.checkpoint"
    w = stream.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint)
    w = w.outputMode("append")
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.start()


def ingest_available(spark: SparkSession, landing: str, header: Sequence[str], target: str,
                     checkpoint: str | None = None, **kw) -> DataFrame:
    """Run one ``availableNow`` pass and return the bronze table as it now stands."""
    q = start_ingest(bronze_stream(spark, landing, header, **kw), target, checkpoint)
    q.awaitTermination()
    return spark.read.parquet(target)

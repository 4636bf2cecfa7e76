"""Deliveries as a stream: quality counts per period with late rows, and repeated rows dropped as they come."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.quality import exclusion_reason
from ..session import Scratch, count_rows
from ..sources.readers import or_empty


def read_deliveries(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """A Parquet file or folder as a stream of its files, with the schema it has now."""
    r = spark.readStream.schema(spark.read.parquet(path).schema)
    # a pattern that fits this name alone, as a stream's path may not name a single file
    folder, _, name = path.rstrip("/").rpartition("/")
    return (r.option("maxFilesPerTrigger", files_per_batch) if files_per_batch else r).parquet(f"{folder}/[{name[0]}]{name[1:]}")


def first_deliveries(stream: DataFrame, keys: list[str], at: str = "loaded_at", lateness: str = "30 days") -> DataFrame:
    """Rows whose keys were not seen within the watermark; state older than that is forgotten."""
    return stream.withColumn(at, F.col(at).cast("timestamp")).withWatermark(at, lateness).dropDuplicatesWithinWatermark(keys)


def reason_counts(stream: DataFrame, at: str = "loaded_at", period: str = "7 days", lateness: str = "30 days") -> DataFrame:
    """(period_start, reason, n) of deliveries by event time; a period closes once the watermark has passed its end, and rows that come later drop out."""
    timed = stream.withColumn(at, F.col(at).cast("timestamp")).withWatermark(at, lateness)
    return timed.groupBy(F.window(at, period).alias("w"), F.coalesce(exclusion_reason(), F.lit("kept")).alias("reason")).agg(count_rows().alias("n")).select(F.col("w.start").alias("period_start"), "reason", "n")


def run_available(result: DataFrame, name: str, mode: str = "complete") -> DataFrame:
    """Runs a stream over what is there now and gives its result as a table; checkpoint and output lie in the shared folder.

    complete mode gives the last batch's whole result, append mode the rows of all batches; late rows are then dropped.
    """
    spark = result.sparkSession
    s = Scratch(spark, name)
    out = f"{s.folder}/out"

    def keep(batch: DataFrame, n: int) -> None:
        # a batch that is tried again replaces what it wrote
        batch.write.mode("overwrite").parquet(out if mode == "complete" else f"{out}/batch={n}")

    result.writeStream.foreachBatch(keep).outputMode(mode).option("checkpointLocation", f"{s.folder}/state").trigger(availableNow=True).start().awaitTermination()
    return or_empty(spark, out, result.schema, lambda p: spark.read.schema(result.schema).parquet(p).select(result.columns))

"""Daily roll-ups of a stream of legacy posts, as they arrive.

Posts that come later than the watermark allows are left out and counted. Each micro-batch writes the days that it changed into a
folder of its own number, so a batch that is run again after a failure replaces itself, and a restart from the checkpoint adds nothing twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.window import Window

LATENESS = "2 days"
DAYS = "day date, kind string, posts bigint, total double, values bigint, batch bigint"


def read_events(spark: SparkSession, path: str, schema, files_per_batch: int | None = None) -> DataFrame:
    """A stream of the Parquet files that match ``path``, oldest first, a few at a time if that is asked for."""
    reader = spark.readStream.schema(schema)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def daily(events: DataFrame, time: str, kind: str, value: str, lateness: str | None = LATENESS) -> DataFrame:
    """Posts, total and number of values per day and kind. The same plan for a stream and, without ``lateness``, for a table.

    Posts without a time are in no day.
    """
    rows = events.select(F.col(time).cast("timestamp").alias("at"), F.col(kind).alias("kind"), F.col(value).cast("double").alias("value"))
    rows = rows.filter("at IS NOT NULL")
    rows = rows if lateness is None else rows.withWatermark("at", lateness)
    days = rows.groupBy(F.window("at", "1 day"), "kind").agg(
        F.count(F.lit(1)).alias("posts"), F.sum("value").alias("total"), F.count("value").alias("values")
    )
    return days.select(F.col("window.start").cast("date").alias("day"), "kind", "posts", "total", "values")


def run_available(days: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Works off what there is and stops. Returns the finished query; `late_rows` reads its progress."""
    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={number}")

    query = (
        days.writeStream.outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True)
        .foreachBatch(write).start()
    )
    query.awaitTermination()
    return query


def late_rows(query: StreamingQuery) -> int:
    """Rows, partly aggregated ones, that came too late in this run."""
    return sum(state.numRowsDroppedByWatermark for p in query.recentProgress for state in p.stateOperators)


def latest(spark: SparkSession, out: str) -> DataFrame:
    """The days as the last batch that changed them left them."""
    rows = spark.read.schema(DAYS).parquet(out)
    newest = Window.partitionBy("day", "kind").orderBy(F.desc("batch"))
    return rows.withColumn("n", F.row_number().over(newest)).filter("n = 1").drop("n", "batch")

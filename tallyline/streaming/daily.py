"""Daily sales kept current from a stream of rows."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import DecimalType

from tallyline.session import cut_lineage

PARTIAL = "order_date date, order_key string, units bigint, revenue decimal(32,2)"


def _per_order(rows: DataFrame, ts: str, order_key: str, amount: str, quantity: str | None) -> DataFrame:
    units = F.lit(1) if quantity is None else F.col(quantity)
    return rows.groupBy(F.col(ts).cast("date").alias("order_date"), F.col(order_key).cast("string").alias("order_key")).agg(
        F.sum(units.cast("bigint")).alias("units"), F.sum(amount).cast(DecimalType(32, 2)).alias("revenue"))


def _per_day(per_order: DataFrame) -> DataFrame:
    """Two combinable steps give the exact count of distinct orders: (day, order), then day."""
    once = per_order.groupBy("order_date", "order_key").agg(F.sum("units").alias("units"), F.sum("revenue").alias("revenue"))
    return once.groupBy("order_date").agg(
        F.count(F.lit(1)).alias("order_count"), F.sum("units").alias("units_sold"),
        F.sum("revenue").cast(DecimalType(32, 2)).alias("revenue"))


def daily_sales(rows: DataFrame, ts: str, order_key: str, amount: str, quantity: str | None = None) -> DataFrame:
    """Per day: distinct orders, units and revenue of a batch of rows."""
    return _per_day(_per_order(rows, ts, order_key, amount, quantity))


def stream_daily_sales(stream: DataFrame, out: str, checkpoint: str, ts: str, order_key: str,
                       amount: str, quantity: str | None = None) -> StreamingQuery:
    """Store the sums per day and order of each micro-batch in a folder of its own.

    A replayed batch overwrites its folder, and rows of any day, however late, count: the
    days are added up on reading (`read_daily_sales`), so nothing waits for a watermark and
    no state is kept. Runs over what is available and stops.
    """
    def store(batch: DataFrame, batch_id: int) -> None:
        _per_order(batch, ts, order_key, amount, quantity).write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    return (stream.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def read_daily_sales(spark: SparkSession, out: str) -> DataFrame:
    """Every day of the stream so far."""
    return _per_day(spark.read.schema(PARTIAL).parquet(out))


# --- tumbling days with a watermark: open days are state, closed days are merged -----

CLOCK = "clock date"
_SUMS = ["order_date", "order_key", "units", "revenue"]


def _path(spark: SparkSession, name: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def _stored(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    path, files = _path(spark, folder)
    return spark.read.schema(schema).parquet(folder) if files.exists(path) else spark.createDataFrame([], schema)


def _clock(spark: SparkSession, out: str, batch_id: int) -> date | None:
    """The latest day up to a batch."""
    return _stored(spark, f"{out}/clock/batch={batch_id}", CLOCK).agg(F.max("clock")).first()[0]


def stream_daily_windows(stream: DataFrame, out: str, checkpoint: str, ts: str, order_key: str, amount: str,
                         quantity: str | None = None, delay_days: int = 2) -> StreamingQuery:
    """Daily sums with event-time state: a day is open until the watermark passes it.

    The watermark of a batch is the latest day of earlier batches less `delay_days`. Rows of
    that day and later are the state: sums per day and order in `open/order_date=<day>/batch=<n>`.
    When the watermark passes a day, its sums are merged into `closed/order_date=<day>`, once,
    and a later batch deletes its open folder. Rows that come for a closed day are not
    dropped: their sums go to `late/batch=<n>` with the number of rows, and
    `read_daily_windows` counts them in. So a read opens merged days, the few open ones and
    what was late, not the history of batches.

    Every folder is written by one batch alone, from its rows, from earlier batches and from
    the clock that the batch before stored, so a batch repeated after a failure writes the
    same again. Rows without an event time count as late, with a null day.
    """
    def store(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        clock = _clock(spark, out, batch_id - 1)
        since = None if clock is None else clock - timedelta(days=delay_days)
        day = F.col("order_date")
        late = day.isNull() if since is None else day.isNull() | (day < F.lit(since))
        units = F.lit(1) if quantity is None else F.col(quantity)
        kept = cut_lineage(batch.groupBy(F.col(ts).cast("date").alias("order_date"), F.col(order_key).cast("string").alias("order_key"))
                           .agg(F.sum(units.cast("bigint")).alias("units"), F.sum(amount).cast(DecimalType(32, 2)).alias("revenue"),
                                F.count(F.lit(1)).alias("n_rows")).withColumn("is_late", late))
        (kept.where(~F.col("is_late")).select(*_SUMS, F.lit(batch_id).alias("batch")).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("order_date", "batch").parquet(f"{out}/open"))
        kept.where("is_late").select(*_SUMS, "n_rows").write.mode("overwrite").parquet(f"{out}/late/batch={batch_id}")
        days = [d for d in (clock, kept.agg(F.max("order_date")).first()[0]) if d is not None]
        now = max(days, default=None)
        spark.createDataFrame([(now,)], CLOCK).coalesce(1).write.mode("overwrite").parquet(f"{out}/clock/batch={batch_id}")
        if now is not None:
            _close(spark, out, since, now - timedelta(days=delay_days))

    return (stream.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def _open_days(spark: SparkSession, out: str) -> list[date]:
    """Days that have an open folder: names only."""
    path, files = _path(spark, f"{out}/open/order_date=*")
    return sorted(date.fromisoformat(str(f.getPath().getName()).split("=")[1]) for f in files.globStatus(path) or [])


def _close(spark: SparkSession, out: str, since: date | None, until: date) -> None:
    """Merge the open days before `until` into a folder each, and delete the open folders of
    the days before `since`: an earlier batch, which no failure can repeat any more, merged those."""
    for day in _open_days(spark, out):
        if since is not None and day < since:
            path, files = _path(spark, f"{out}/open/order_date={day}")
            files.delete(path, True)
    rows = _stored(spark, f"{out}/open", PARTIAL).where(F.col("order_date") < F.lit(until))
    if since is not None:
        rows = rows.where(F.col("order_date") >= F.lit(since))
    merged = rows.groupBy("order_date", "order_key").agg(
        F.sum("units").alias("units"), F.sum("revenue").cast(DecimalType(32, 2)).alias("revenue"))
    # a folder per day; the hint lets a day with very many orders have several files
    (merged.hint("rebalance", "order_date").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("order_date").parquet(f"{out}/closed"))


def read_daily_windows(spark: SparkSession, out: str, delay_days: int = 2) -> DataFrame:
    """`daily_sales` of every day so far, and `late_rows`, how many rows came after it closed."""
    clock = _stored(spark, f"{out}/clock", CLOCK).agg(F.max("clock")).first()[0]
    closed, still = (_stored(spark, f"{out}/{name}", PARTIAL) for name in ("closed", "open"))
    if clock is not None:
        still = still.where(F.col("order_date") >= F.lit(clock - timedelta(days=delay_days)))
    late = _stored(spark, f"{out}/late", f"{PARTIAL}, n_rows bigint").select(*_SUMS, "n_rows")
    none = F.lit(0).cast("bigint").alias("n_rows")
    once = (closed.select(*_SUMS, none).unionByName(still.select(*_SUMS, none)).unionByName(late)
            .groupBy("order_date", "order_key")
            .agg(F.sum("units").alias("units"), F.sum("revenue").alias("revenue"), F.sum("n_rows").alias("n_rows")))
    return once.groupBy("order_date").agg(
        F.count(F.lit(1)).alias("order_count"), F.sum("units").alias("units_sold"),
        F.sum("revenue").cast(DecimalType(32, 2)).alias("revenue"), F.sum("n_rows").alias("late_rows"))

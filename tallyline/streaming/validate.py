"""Row guard: good rows go on, bad rows go to quarantine with a reason."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery


def item_rules() -> dict[str, Column]:
    """Reasons to reject an order line."""
    return {"negative revenue": F.col("line_revenue") < 0,
            "non-positive quantity": F.col("quantity") <= 0}


def with_reason(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Add `reason`: the first rule that rejects the row, null for a good row."""
    return df.withColumn("reason", F.coalesce(*[F.when(bad, F.lit(name)) for name, bad in rules.items()]))


def validate_split(df: DataFrame, rules: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """The accepted rows, and the rejected ones with their reason. Batch or stream."""
    judged = with_reason(df, rules)
    return (judged.where(F.col("reason").isNull()).drop("reason"),
            judged.where(F.col("reason").isNotNull()))


def stream_validate(stream: DataFrame, out: str, quarantine: str, checkpoint: str,
                    rules: dict[str, Column]) -> StreamingQuery:
    """Write both sides of every micro-batch. A batch has its own folder that a retry
    overwrites, so a batch repeated after a failure is stored once."""
    def write(batch: DataFrame, batch_id: int) -> None:
        kept = batch.persist()          # read once for the two writes
        good, bad = validate_split(kept, rules)
        good.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")
        bad.write.mode("overwrite").parquet(f"{quarantine}/batch={batch_id}")
        kept.unpersist()

    return (stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())

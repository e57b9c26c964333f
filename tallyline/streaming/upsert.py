"""Upserts from a stream: append the latest version of each key and merge on read, or rewrite the
buckets that a batch touches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tallyline.operators.dimensions import touch
from tallyline.session import cut_lineage


def latest_rows(df: DataFrame, key: str, version: str) -> DataFrame:
    """The row with the highest version of each key.

    An aggregate rather than a window: every task keeps one candidate per key, so a key
    with very many versions never gathers in one task.
    """
    others = [c for c in df.columns if c != version]
    newest = df.groupBy(F.col(key).alias("_k")).agg(F.max(F.struct(version, *others)).alias("_r"))
    return newest.select(*[F.col(f"_r.{c}").alias(c) for c in df.columns])


def stream_upsert(stream: DataFrame, out: str, checkpoint: str, key: str, version: str) -> StreamingQuery:
    """Store the newest version per key of every micro-batch with its change time.

    Writing costs the size of the batch, not of the table. A batch folder is overwritten
    when the batch is repeated after a failure.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        touch(latest_rows(batch, key, version)).write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    return (stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def read_upserted(spark: SparkSession, out: str, key: str, version: str) -> DataFrame:
    """Current row of every key over all stored batches."""
    return latest_rows(spark.read.parquet(out).drop("batch"), key, version)


def compact_upserts(spark: SparkSession, out: str, compacted: str, key: str, version: str) -> None:
    """Write the current rows as a new table, so that reads have one version to merge."""
    read_upserted(spark, out, key, version).write.mode("overwrite").parquet(f"{compacted}/batch=-1")


# --- a table kept current by rewriting the buckets that a batch touches --------------

def _bucket(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(buckets)).cast("int")


def _newest_folders(spark: SparkSession, out: str, below: int | None = None) -> dict[int, int]:
    """Per bucket the highest version that is complete, of those `below` a version if given.

    Only folder names are listed: buckets times the versions that are kept.
    """
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(f"{out}/version=*/_SUCCESS")
    found = hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(hadoop)
    versions = sorted(int(str(f.getPath().getParent().getName()).split("=")[1]) for f in (found or []))
    newest: dict[int, int] = {}
    for v in versions:
        if below is None or v < below:
            listed = spark._jvm.org.apache.hadoop.fs.Path(f"{out}/version={v}/bucket=*")
            for f in listed.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(listed):
                newest[int(str(f.getPath().getName()).split("=")[1])] = v
    return newest


def _read_folders(spark: SparkSession, out: str, folders: dict[int, int], schema) -> DataFrame:
    if not folders:
        return spark.createDataFrame([], schema)
    paths = [f"{out}/version={v}/bucket={b}" for b, v in sorted(folders.items())]
    return spark.read.schema(schema).parquet(*paths)


def stream_upsert_buckets(stream: DataFrame, out: str, checkpoint: str, key: str, version: str,
                          buckets: int = 64) -> StreamingQuery:
    """Keep one row per key, the one with the highest `version`, in folders by hash of the key.

    A batch rewrites only the buckets that its keys fall into: it merges them with their
    rows so far and writes `version=<batch>/bucket=<n>`. Nothing is overwritten in place, so
    readers see whole folders, and a batch that is repeated after a failure reads what was
    there before it and writes the same folder again. Choose `buckets` so that one holds some
    hundred MB; it must stay the same for a table. Rows with a null key have no place.
    """
    schema = touch(stream).schema

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        fresh = cut_lineage(touch(latest_rows(batch.where(F.col(key).isNotNull()), key, version))
                            .withColumn("bucket", _bucket(key, buckets)))
        touched = {r["bucket"] for r in fresh.select("bucket").distinct().collect()}
        if not touched:
            return
        standing = {b: v for b, v in _newest_folders(spark, out, batch_id).items() if b in touched}
        before = _read_folders(spark, out, standing, schema).withColumn("bucket", _bucket(key, buckets))
        merged = latest_rows(before.unionByName(fresh), key, version)
        (merged.repartition(len(touched), "bucket").write.mode("overwrite").partitionBy("bucket")
         .parquet(f"{out}/version={batch_id}"))

    return (stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def read_buckets(spark: SparkSession, out: str, schema) -> DataFrame:
    """The current row of every key: one folder per bucket is read, and nothing is merged."""
    return _read_folders(spark, out, _newest_folders(spark, out), touch(spark.createDataFrame([], schema)).schema)


def vacuum_buckets(spark: SparkSession, out: str, keep: int = 2) -> int:
    """Delete bucket folders that `keep` newer versions of the bucket have replaced; returns how many.

    With `keep` of 2 or more the state before the last batch stays, which a repeat of it needs.
    """
    spans = spark._jvm.org.apache.hadoop.fs.Path(f"{out}/version=*/bucket=*")
    files = spans.getFileSystem(spark._jsc.hadoopConfiguration())
    by_bucket: dict[str, list[tuple[int, object]]] = {}
    for f in files.globStatus(spans) or []:
        path = f.getPath()
        by_bucket.setdefault(str(path.getName()), []).append((int(str(path.getParent().getName()).split("=")[1]), path))
    old = [path for listed in by_bucket.values() for _, path in sorted(listed, key=lambda x: -x[0])[keep:]]
    for path in old:
        files.delete(path, True)
    return len(old)

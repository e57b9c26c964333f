"""Writers: tables, year partitions, report blocks, statistics, models."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyline.functions.columns import report_edge
from tallyline.session import cut_lineage
from tallyline.sources.readers import CORRUPT, Tables, read_checked, row_counts, source_rows
from tallyline.sources.schemas import TABLE_NAMES

DEFAULT_PARTITION = "default"


def write_table(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Overwrite `path` with Parquet, or with gzip CSV and a header."""
    writer = df.write.mode("overwrite")
    if fmt == "csv":
        writer.option("header", True).option("compression", "gzip").csv(path)
    elif fmt == "parquet":
        writer.parquet(path)
    else:
        raise ValueError(f"unknown table format: {fmt}")


def land(tables: Mapping[str, DataFrame], out: str) -> DataFrame:
    """Write every table as Parquet under `out`, dimensions first, and count what landed."""
    first = next(iter(tables.values()))
    order = [t for t in TABLE_NAMES if t in tables] + [t for t in tables if t not in TABLE_NAMES]
    base = out.rstrip("/")
    for name in order:
        write_table(tables[name], f"{base}/{name}")
    landed = {name: first.sparkSession.read.parquet(f"{base}/{name}") for name in order}
    return row_counts(landed)


def landed(tables: Tables, out: str, names: Sequence[str]) -> Tables:
    """The same tables, of which the named ones are written as Parquet under `out` and read again:
    for tables that are joined or grouped from others and read many times."""
    frames, base = dict(tables), out.rstrip("/")
    for name in names:
        df = frames[name]
        write_table(df, f"{base}/{name}")
        frames[name] = df.sparkSession.read.schema(df.schema).parquet(f"{base}/{name}")
    return Tables(frames, profile=tables.profile)


def land_checked(spark: SparkSession, directory: str, names: Sequence[str], out: str) -> DataFrame:
    """Land CSV tables as Parquet and account for every source row, per table: `source_rows`,
    `landed`, `quarantined`, `reconciled` (they add up).

    A row that does not fit the declared types would otherwise be read with nulls and go
    unnoticed. It goes to `out/_quarantine/<name>` as its source text; the rest lands in
    `out/<name>`. Each file is parsed once: both sides come from stored rows.
    """
    base, parts = out.rstrip("/"), []
    for name in names:
        rows = cut_lineage(read_checked(spark, directory, name))
        write_table(rows.where(F.col(CORRUPT).isNull()).drop(CORRUPT), f"{base}/{name}")
        write_table(rows.where(F.col(CORRUPT).isNotNull()).select(F.col(CORRUPT).alias("record")), f"{base}/_quarantine/{name}")
        landed, bad = (spark.read.parquet(f"{base}/{folder}").agg(F.count(F.lit(1))).scalar()
                       for folder in (name, f"_quarantine/{name}"))
        parts.append(source_rows(spark, directory, name).select(
            F.lit(name).alias("table_name"), F.col("n_rows").alias("source_rows"), landed.alias("landed"), bad.alias("quarantined")))
    counts = reduce(DataFrame.unionByName, parts)
    return counts.withColumn("reconciled", F.col("source_rows") == F.col("landed") + F.col("quarantined"))


def with_year_partition(df: DataFrame, date_col: str, first_year: int | None = None,
                        last_year: int | None = None) -> DataFrame:
    """Add `order_year`; null dates and years outside the range fall in "default"."""
    year = F.year(date_col)
    inside = year.isNotNull()
    if first_year is not None:
        inside = inside & (year >= first_year)
    if last_year is not None:
        inside = inside & (year <= last_year)
    return df.withColumn("order_year", F.when(inside, year.cast("string")).otherwise(DEFAULT_PARTITION))


def write_partitioned(df: DataFrame, path: str, date_col: str, first_year: int | None = None,
                      last_year: int | None = None, sort_by: str | None = None) -> None:
    """Parquet partitioned by year.

    The rebalance hint lets AQE split a large year over many tasks and merge small ones,
    so neither one task nor a flood of files holds a hot year. Filter on `order_year`
    together with the date: only the former prunes directories.
    """
    rows = with_year_partition(df, date_col, first_year, last_year).hint("rebalance", "order_year")
    if sort_by:
        rows = rows.sortWithinPartitions("order_year", sort_by)
    rows.write.mode("overwrite").partitionBy("order_year").parquet(path)


def analyze(spark: SparkSession, table: str) -> None:
    """Column statistics of a catalog table for the cost-based optimizer."""
    spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS FOR ALL COLUMNS")


def write_report(blocks: Mapping[str, DataFrame], directory: str) -> None:
    """One JSON dataset per block: NaN and null as null, dates as ISO text."""
    base = directory.rstrip("/")
    for name, block in blocks.items():
        report_edge(block).write.mode("overwrite").option("ignoreNullFields", False).json(f"{base}/{name}")


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


__all__ = ["Tables", "analyze", "land", "land_checked", "load_model", "save_model", "with_year_partition",
           "write_partitioned", "write_report", "write_table"]

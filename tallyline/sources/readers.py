"""Typed table loading, and the lazy table set the operators work on."""

from __future__ import annotations

import warnings
from collections.abc import Iterator, Mapping
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyline.sources.schemas import FILE_HEADERS, TABLE_NAMES, file_schema_of


class Tables(Mapping):
    """Table name -> lazy DataFrame."""

    def __init__(self, frames: dict[str, DataFrame], profile: str = "full"):
        self._frames = dict(frames)
        self.profile = profile

    def __getitem__(self, name: str) -> DataFrame:
        return self._frames[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._frames)

    def __len__(self) -> int:
        return len(self._frames)


def conform(df: DataFrame, name: str) -> DataFrame:
    """Canonical names for the columns whose file header differs."""
    return df.withColumnsRenamed(FILE_HEADERS.get(name, {}))


def read_table(spark: SparkSession, directory: str, name: str, fmt: str = "csv") -> DataFrame:
    """One table with its declared types.

    `csv` reads `<name>.csv.gz` and checks the header against the declared columns. A gzip
    file is a single task, so land the tables as Parquet once and read that (`land`).
    """
    base = directory.rstrip("/")
    if fmt == "csv":
        raw = (spark.read.schema(file_schema_of(name)).option("header", True)
               .option("enforceSchema", False).csv(f"{base}/{name}.csv.gz"))
        return conform(raw, name)
    if fmt == "parquet":
        return conform(spark.read.parquet(f"{base}/{name}"), name)
    raise ValueError(f"unknown table format: {fmt}")


def load_tables(spark: SparkSession, directory: str, fmt: str = "csv",
                names: tuple[str, ...] = TABLE_NAMES, profile: str | None = None) -> Tables:
    """Every table present in `directory`; an absent one is skipped with a warning."""
    frames = {}
    for name in names:
        try:
            frames[name] = read_table(spark, directory, name, fmt)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            warnings.warn(f"table {name} not found in {directory}; skipped", stacklevel=2)
    label = profile or directory.rstrip("/").rsplit("/", 1)[-1]
    return Tables(frames, profile=label)


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per table in one plan."""
    parts = [df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
             for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def run_meta(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row: number of tables, rows scanned, data profile, and when it was asked for."""
    return row_counts(tables).agg(
        F.count(F.lit(1)).alias("tables_loaded"), F.sum("n_rows").alias("rows_scanned"),
    ).withColumns({"profile": F.lit(getattr(tables, "profile", "full")), "generated_at": F.current_timestamp()})


CORRUPT = "_corrupt_record"


def read_checked(spark: SparkSession, directory: str, name: str) -> DataFrame:
    """A CSV table with its declared types and `_corrupt_record`: the text of a row that does
    not fit them (a field of another type, too few or too many fields), else null."""
    schema = file_schema_of(name).add(CORRUPT, "string")
    raw = (spark.read.schema(schema).option("header", True).option("enforceSchema", False).option("mode", "PERMISSIVE")
           .option("columnNameOfCorruptRecord", CORRUPT).csv(f"{directory.rstrip('/')}/{name}.csv.gz"))
    return conform(raw, name)


def source_rows(spark: SparkSession, directory: str, name: str) -> DataFrame:
    """One row `n_rows`: lines of the files less a header each, counted as text. Fields must
    not hold line feeds."""
    text = spark.read.text(f"{directory.rstrip('/')}/{name}.csv.gz").where(F.col("value") != "")
    per_file = text.groupBy(F.input_file_name().alias("file")).agg((F.count(F.lit(1)) - 1).alias("n"))
    return per_file.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"))

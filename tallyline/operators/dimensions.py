"""Dimension upkeep: surrogate keys, audit time, and type-2 history."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tallyline.operators.ordering import prefix_scan
from tallyline.session import cut_lineage


def with_surrogate_key(df: DataFrame, natural_key: str | Sequence[str], name: str = "sk") -> DataFrame:
    """64-bit hash of the natural key: the same on every run and needs no shuffle.

    Two keys can share a hash: among a billion keys the chance is about 3%. `duplicate_keys`
    over the distinct natural keys finds such pairs.
    """
    keys = [natural_key] if isinstance(natural_key, str) else list(natural_key)
    return df.withColumn(name, F.xxhash64(*keys))


def touch(df: DataFrame, name: str = "updated_at") -> DataFrame:
    return df.withColumn(name, F.current_timestamp())


def scd2_open(df: DataFrame, effective: str) -> DataFrame:
    """First version of every row, valid from `effective` with no end."""
    return df.withColumns({"effective_date": F.to_date(F.lit(effective)),
                           "expiry_date": F.lit(None).cast("date"),
                           "is_current": F.lit(True)})


def scd2_apply(dim: DataFrame, updates: DataFrame, key: str, tracked: Sequence[str],
               eff_date: str) -> DataFrame:
    """Close changed current rows at `eff_date` and open their new version.

    `updates` holds one full row per key. Closed versions pass through untouched, a
    current row without a tracked change stays, an unseen key opens its first version.
    One full outer join; each match emits one or two rows.
    """
    attributes = [c for c in dim.columns if c not in ("effective_date", "expiry_date", "is_current")]
    day = F.to_date(F.lit(eff_date))
    old, new = dim.where("is_current").alias("o"), updates.alias("u")
    known, given = F.col(f"o.{key}").isNotNull(), F.col(f"u.{key}").isNotNull()
    changed = F.lit(False)
    for c in tracked:
        changed = changed | ~F.col(f"o.{c}").eqNullSafe(F.col(f"u.{c}"))

    def version(side, start, end, current):
        return F.struct(*[F.col(f"{side}.{c}").cast(dim.schema[c].dataType).alias(c) for c in attributes],
                        start.alias("effective_date"), end.cast("date").alias("expiry_date"),
                        F.lit(current).alias("is_current"))

    kept = version("o", F.col("o.effective_date"), F.col("o.expiry_date"), True)
    closed = version("o", F.col("o.effective_date"), day, False)
    opened = version("u", day, F.lit(None), True)
    versions = (F.when(known & given & changed, F.array(closed, opened))
                .when(known, F.array(kept))
                .otherwise(F.array(opened)))
    merged = (old.join(new, F.col(f"o.{key}") == F.col(f"u.{key}"), "full_outer")
              .select(F.explode(versions).alias("v")).select("v.*"))
    return dim.where(~F.col("is_current")).unionByName(merged.select(*dim.columns))


_AT, _FACT, _BUCKET, _KEY = "_at", "_is_fact", "_bucket", "_key"


def scd2_asof(fact: DataFrame, dim: DataFrame, key: str, date_col: str,
              attributes: Sequence[str]) -> DataFrame:
    """Attach the dimension attributes valid on the fact's date; unmatched facts stay.

    A sweep instead of a join on a range of dates: facts and versions are sorted together by
    key and date, and the last version at or before a fact is carried forward to it. The rows
    are cut into ranges of (key, date, row hash), so a key with any number of facts and
    versions spreads over many tasks; a version that must reach the next range travels there
    as a carry, at most one per border. Versions of a key must not overlap, as `scd2_apply`
    leaves them; facts with a null key or date match nothing.
    """
    version = F.struct("expiry_date", *attributes)
    stands = F.struct(F.col("effective_date").alias("day"), F.col("expiry_date").isNull().alias("open"), F.col("expiry_date").alias("until"))
    none = F.lit(None).cast(f"struct<day:{dim.schema['effective_date'].dataType.simpleString()},open:boolean,"
                            f"until:{dim.schema['expiry_date'].dataType.simpleString()}>")
    starts = dim.where(F.col(key).isNotNull()).select(
        F.col(key).alias(_KEY), F.col("effective_date").alias(_AT), F.lit(False).alias(_FACT), F.lit(0).cast("bigint").alias("_mix"),
        stands.alias("_stands"), version.alias("_version"), F.lit(None).cast(fact.schema.simpleString()).alias("_row"))
    seen = fact.select(
        F.col(key).cast(dim.schema[key].dataType).alias(_KEY), F.col(date_col).alias(_AT), F.lit(True).alias(_FACT),
        F.xxhash64(*fact.columns).alias("_mix"), none.alias("_stands"),
        F.lit(None).cast(starts.schema["_version"].dataType).alias("_version"), F.struct(*fact.columns).alias("_row"))
    order = [_KEY, _AT, _FACT, "_stands", "_mix"]
    # stored once, so that the ranges are the same ones in both uses below
    ranged = cut_lineage(starts.unionByName(seen).repartitionByRange(*order).withColumn(_BUCKET, F.spark_partition_id()))

    here = Window.partitionBy(_BUCKET, _KEY).orderBy(*order[1:]).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    swept = ranged.withColumn("_last", F.last("_version", ignorenulls=True).over(here)).where(_FACT)
    ends = ranged.groupBy(_BUCKET, _KEY).agg(F.max_by("_version", F.when(~F.col(_FACT), F.struct(_AT, "_stands"))).alias("_end"))
    earlier = Window.partitionBy(_KEY).orderBy(_BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    carries = ends.withColumn("_carry", F.last("_end", ignorenulls=True).over(earlier)).where(
        F.col("_carry").isNotNull()).select(_BUCKET, _KEY, "_carry")
    found = swept.join(carries, [_BUCKET, _KEY], "left").withColumn("_v", F.coalesce("_last", "_carry"))
    valid = F.col("_v.expiry_date").isNull() | (F.col(_AT) < F.col("_v.expiry_date"))
    return found.select("_row.*", *[F.when(valid, F.col(f"_v.{c}")).alias(c) for c in attributes])


def extend_key_map(known: DataFrame | None, df: DataFrame, natural_key: str, name: str = "sk") -> DataFrame:
    """The key map (`natural_key`, `name`) with an entry for every key of `df` it lacks.

    Keys are dense: new ones are numbered from behind the largest known one, in the order of
    the natural key, by a distributed prefix scan; known ones keep their number. A null
    natural key gets none. Store the result and pass it to the next load.
    """
    keys = df.where(F.col(natural_key).isNotNull()).select(natural_key).distinct()
    if known is None:
        return _numbered(keys, natural_key, name, F.lit(0))
    last = known.agg(F.coalesce(F.max(name), F.lit(0))).scalar()
    return known.select(natural_key, name).unionByName(
        _numbered(keys.join(known, natural_key, "left_anti"), natural_key, name, last))


def _numbered(keys: DataFrame, natural_key: str, name: str, behind: Column) -> DataFrame:
    return prefix_scan(keys, natural_key, natural_key).select(
        natural_key, (behind + F.col("row_number")).cast("bigint").alias(name))


def store_key_map(spark: SparkSession, folder: str, df: DataFrame, natural_key: str, name: str = "sk",
                  load: int = 0) -> DataFrame:
    """Extend the map in `folder` by a load and return all of it.

    A load appends only its new keys, in `load=<n>`, numbered behind those of earlier loads;
    a repeated load overwrites its own folder with the same entries.
    """
    kind = df.schema[natural_key].dataType.simpleString()
    schema = f"`{natural_key}` {kind}, `{name}` bigint, load int"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    exists = path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)
    stored = spark.read.schema(schema).parquet(folder) if exists else spark.createDataFrame([], schema)
    known = stored.where(F.col("load") < load).select(natural_key, name)
    keys = df.where(F.col(natural_key).isNotNull()).select(natural_key).distinct().join(known, natural_key, "left_anti")
    last = known.agg(F.coalesce(F.max(name), F.lit(0))).scalar()
    _numbered(keys, natural_key, name, last).write.mode("overwrite").parquet(f"{folder}/load={load}")
    return spark.read.schema(schema).parquet(folder).where(F.col("load") <= load).select(natural_key, name)


def with_dense_key(df: DataFrame, key_map: DataFrame, natural_key: str) -> DataFrame:
    """`df` with the dense key of the map; rows with a null or unmapped key stay, with a null one."""
    return df.join(key_map, natural_key, "left")

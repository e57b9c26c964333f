"""Session settings, the one place where lineage is cut, and join sides that grow."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Settings the plans rely on. All but the time zone are Spark defaults; they are
# written out so that a cluster profile that turned them off is noticed.
RECOMMENDED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join side even where that costs one more exchange afterwards.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Checkpoint files go when the frame that they hold is no longer used.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # No call-site lookup on every column call: plans build several times faster.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app_name: str = "tallyline", master: str | None = None,
                  conf: dict[str, str] | None = None) -> SparkSession:
    """A session with the recommended settings; `conf` wins over them."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**RECOMMENDED_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: the one `spark.checkpoint.dir` names, else a
    folder in the warehouse. On a cluster a warehouse on a machine's own disk is an error."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named and (current := spark.sparkContext.getCheckpointDir()):
        return current.rstrip("/")
    if not named:
        warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
        if warehouse.startswith(("file:", "/")) and not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors reach")
        named = f"{warehouse}/_checkpoints"
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(named)
    return named.rstrip("/")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise `df` reliably so that several passes over it cost one computation."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def never_broadcast(df: DataFrame) -> DataFrame:
    """`df` as a side of an equi-join that is sorted in tasks, whatever the size of its files.

    The optimizer compares a share of the compressed bytes of the files with its limit. Millions of
    rows of a few narrow columns pass it, and the driver builds a hash table of them for every
    join. For tables that grow with the data; small ones cost one more exchange.
    """
    return df.hint("merge")

"""Document fingerprints: I-Match with randomised lexicons, in DataFrame operations only.

Document frequencies of all terms are counted over all documents. The lexicon is the terms
within a band of inverse document frequency: very rare terms are noise, very frequent ones
say nothing. It is split into several random subsets, and a document's fingerprint is, for
each subset, a hash of the set of its terms there. Two texts are alike in the share of
subsets, among those that either has terms of, whose hashes are equal.

The band's lower end bounds the lexicon: a term in `least_share` of the documents or more
can only be one of (mean distinct terms of a document / least_share). Its size is counted
all the same before it is broadcast; a larger one is joined by a shuffle.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyline.session import cut_lineage

_ALWAYS = 0            # stands for the document itself, so that one without any term keeps a row
_SUBSET_BITS = 0xFFF   # of an entry; the rest is hash
_NO_TERM = 0xFFF       # subset of a text's stand-in for missing lexicon terms


def terms(text: Column) -> Column:
    """Hashes of the distinct lower-case words (letters and digits) of a text."""
    words = F.split(F.lower(text), r"[^\p{L}\p{N}]+")
    return F.array_distinct(F.transform(F.filter(words, lambda w: w != ""), lambda w: F.xxhash64(w)))


def lexicon(docs: DataFrame, least_share: float, most_share: float, text: str = "text") -> DataFrame:
    """`term` (its hash) for the terms that between the two shares of all documents hold."""
    n = docs.count()
    low, high = max(1, math.ceil(least_share * n)), math.floor(most_share * n)
    counted = (docs.select(F.explode(terms(F.coalesce(F.col(text), F.lit("")))).alias("term"))
               .groupBy("term").agg(F.count("*").alias("n")))
    return counted.where(F.col("n").between(low, high)).select("term")


def fingerprints(texts: DataFrame, band: DataFrame, keys: list[str], carried: list[str] | None = None,
                 subsets: int = 64, max_broadcast: int = 4_000_000, text: str = "text") -> DataFrame:
    """`keys`, `carried` and `print` per distinct `keys` of `texts`, where `carried` depends on
    the keys. A print is an array of 64-bit entries, of which the low 12 bits are the subset
    and the others the hash of its terms.

    The hash of a subset combines its distinct terms by exclusive or, which is what sorting
    them first is for: it does not depend on their order. A text without a term of the band
    is printed by its characters, so equal texts always have equal prints.
    """
    carried = carried or []
    rows = texts.select(*keys, *carried, F.xxhash64(text).alias("_whole"), F.explode(
        F.concat(F.array(F.lit(_ALWAYS).cast("bigint")), terms(F.col(text)))).alias("term"))
    known = band.unionByName(band.sparkSession.sql(f"SELECT CAST({_ALWAYS} AS BIGINT) AS term"))
    if band.count() <= max_broadcast:
        known = F.broadcast(known)
    itself = F.col("term") == _ALWAYS
    subset = F.when(~itself, F.pmod(F.xxhash64("term", F.lit("subset")), F.lit(subsets)))
    once = [F.max(F.when(itself, F.col(c))).alias(c) for c in ["_whole", *carried]]
    hashes = [F.bit_xor(F.when(F.col("_subset") == j, F.col("term"))).alias(f"_{j}") for j in range(subsets)]
    hashed = (rows.join(known, "term", "left_semi").withColumn("_subset", subset)
              .groupBy(*keys).agg(*once, *hashes))
    entries = F.array_compact(F.array(*[_entry(F.xxhash64(f"_{j}"), j, F.col(f"_{j}").isNotNull()) for j in range(subsets)]))
    own = F.when(F.size(entries) > 0, entries).otherwise(F.array(_entry(F.col("_whole"), _NO_TERM, F.lit(True))))
    return hashed.select(*keys, *carried, own.alias("print"))


def _entry(value: Column, subset: int, present: Column) -> Column:
    return F.when(present, value.bitwiseAND(F.lit(~_SUBSET_BITS)).bitwiseOR(F.lit(subset).cast("bigint")))


def _subset_of(entry: Column) -> Column:
    return entry.bitwiseAND(F.lit(_SUBSET_BITS))


def likeness(a: Column, b: Column) -> Column:
    """Equal hashes over subsets that either print has, 0 to 1; 0 if one print is missing."""
    either = F.array_union(F.transform(a, _subset_of), F.transform(b, _subset_of))
    return F.coalesce(F.size(F.array_intersect(a, b)) / F.size(either), F.lit(0.0)).cast("double")


def as_text(p: Column) -> Column:
    return F.array_join(F.transform(p, lambda e: F.hex(e)), ",")


def links(docs: DataFrame, id: str, chars: str) -> DataFrame:
    """`id`, `prev_id`, `prev_chars` per distinct id: which id comes before it (before the
    first: the last), and the largest `chars` of that id's rows.

    Ids are range partitioned and compared in their partition; the neighbour across a
    border comes from a table of one row per partition.
    """
    parts = max(2, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ids = docs.groupBy(id).agg(F.max(chars).alias("chars")).select(F.struct(id, "chars").alias("at"))
    placed = cut_lineage(ids.repartitionByRange(parts, "at").withColumn("part", F.spark_partition_id()))
    borders = placed.groupBy("part").agg(F.max("at").alias("last"))
    every = Window.partitionBy(F.lit(0))                       # one row per partition
    borders = borders.select("part", F.lag("last").over(every.orderBy("part")).alias("before"),
                             F.first("last").over(every.orderBy(F.desc("part"))).alias("end"))
    here = F.lag("at").over(Window.partitionBy("part").orderBy("at"))
    prev = F.coalesce("here", "before", "end")
    joined = placed.withColumn("here", here).join(F.broadcast(borders), "part")
    return joined.select(F.col("at")[id].alias(id), prev[id].alias("prev_id"), prev["chars"].alias("prev_chars"))


def edited_pairs(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """`id`, `prev_id` (whose next document this is), `text` and `edited`: the text with its
    last quarter replaced by the start of the next document. Both ids are structs of one
    field, which compare equal also if it is null.

    Rows equal in id and text are one document. Where several rows share an id, each has
    the least text of the next greater id as its successor. The only document is its own
    successor.
    """
    docs = docs.select(F.struct(F.col(id).alias("id")).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    linked = (docs.join(links(docs.withColumn("chars", F.length("text")), "id", "chars"), "id")
              .select("id", "prev_id", "prev_chars", "text"))
    starts = (linked.withColumn("start", F.expr("substring(text, 1, cast(prev_chars div 4 as int))"))
              .groupBy("prev_id").agg(F.min("start").alias("start")).withColumnRenamed("prev_id", "id"))
    cut = F.expr("cast(length(text) div 4 as int)")
    edited = F.concat(F.expr("substring(text, 1, length(text) - cast(length(text) div 4 as int))"),
                      F.substring(F.col("start"), F.lit(1), cut))
    return linked.join(starts, "id").select("id", "prev_id", "text", edited.alias("edited"))


def compare_edited(docs: DataFrame, id: str = "doc_id", text: str = "text", least_share: float = 0.01,
                   most_share: float = 0.2, subsets: int = 64) -> DataFrame:
    """Fingerprints of every document and of its edited text, and their likeness.

    Columns: `id`, `n_chars`, `edited_sha256`, `fingerprint`, `edited_fingerprint`,
    `near_edited`, `near_next`. A null text is an empty one. No documents give no rows. Where
    several documents share an id, `near_next` compares with the least key of the next id.
    """
    band = cut_lineage(lexicon(docs, least_share, most_share, text))
    carried = ["prev_id", "n_chars", "edited_sha256"]
    both = edited_pairs(docs, id, text).select(
        "id", "prev_id", F.xxhash64("text").alias("key"), F.length("text").cast("bigint").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        F.explode(F.array(F.struct(F.lit(False).alias("is_edited"), F.col("text")),
                          F.struct(F.lit(True).alias("is_edited"), F.col("edited").alias("text")))).alias("side"))
    prints = fingerprints(both.select("id", "key", *carried, "side.is_edited", "side.text"), band,
                          ["id", "key", "is_edited"], carried, subsets)

    def side(edited: bool) -> Column:
        return F.first(F.when(F.col("is_edited") == edited, F.col("print")), ignorenulls=True)

    each = cut_lineage(prints.groupBy("id", "key", *carried).agg(side(False).alias("own"), side(True).alias("other")))
    following = (each.groupBy("prev_id").agg(F.min_by("own", F.struct("id", "key")).alias("next"))
                 .withColumnRenamed("prev_id", "id"))
    return (each.join(following, "id", "left")
            .select(F.col("id.id").alias(id), "n_chars", "edited_sha256", as_text(F.col("own")).alias("fingerprint"),
                    as_text(F.col("other")).alias("edited_fingerprint"),
                    likeness(F.col("own"), F.col("other")).alias("near_edited"),
                    likeness(F.col("own"), F.col("next")).alias("near_next")))

"""Spelling variants by PartEnum signatures over letter multisets.

A word is the set of its (letter, occurrence) pairs, a binary vector. One replaced letter
changes two of its entries, one letter more or less changes one, so words one edit apart are
within a Hamming distance of two (words of one length) or one (lengths that differ by one).
The letters are divided into parts. Two vectors within distance d agree on all parts but d
at most, so each word enumerates every choice of all parts but d, and the letters it has in
the chosen parts are a signature: near words share one. Sizes are exact here: a signature
names the length of the shorter word.

Short alphabets make multisets alike, so a signature also holds what an edit leaves in place:
an edit at or behind the middle of the shorter word keeps the letters before the middle, any
other keeps those behind it, in order. Each signature comes with either half.

Words that share a signature are candidates, by an equi-join on its hash; the edit distance
decides. A pair that shares several signatures counts at the first of them only, which both
words tell by themselves, so nothing is deduplicated afterwards.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tallyline.session import cut_lineage

_RUN = re.compile("[A-Za-zÀ-ÿ]+")
_WORDS_PER_CHUNK = 200_000
# (letters changed, parts): two entries differ between words of one length, else one
_SAME, _LONGER = (2, 4), (1, 3)


def words(df: DataFrame, id: str = "doc_id", text: str = "text", every: int = 31, least_length: int = 7,
          least_count: int = 2) -> DataFrame:
    """`word`, `n`: the distinct words of at least `least_length` code points that occur
    `least_count` times or more in all texts.

    Runs of Latin letters (U+0041-5A, 61-7A, C0-FF), A-Z in lower case. With h the CRC-32 of
    `<id>:<run>`, a run whose h is a multiple of `every` lacks its letter at h modulo its
    length. A row with a null id changes nothing; a null text has no words.
    """
    schema = pa.schema([("word", pa.string()), ("n", pa.int64())])

    def rows(found: dict[str, int]) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_arrays([pa.array(found.keys(), pa.string()), pa.array(found.values(), pa.int64())], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, int] = {}
        for batch in batches:
            for key, value in zip(batch.column(0), batch.column(1)):
                if not (value := value.as_py()):
                    continue
                key = key.as_py()
                start = None if key is None else zlib.crc32(f"{key}:".encode())
                lower = value.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")
                for word, n in Counter(_RUN.findall(lower)).items():
                    if start is not None and (h := zlib.crc32(word.encode(), start)) % every == 0:
                        at = h % len(word)
                        word = word[:at] + word[at + 1:]
                    if len(word) >= least_length:
                        found[word] = found.get(word, 0) + n
                if len(found) >= _WORDS_PER_CHUNK:
                    yield from rows(found)
                    found = {}
        yield from rows(found)

    counted = df.select(F.col(id).cast("string"), text).mapInArrow(run, "word string, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def _letters(word: Column) -> Column:
    return F.sort_array(F.split(word, ""))


def _part(letters: Column, part: int, parts: int) -> Column:
    """Those of the sorted letters that lie in a part of the alphabet."""
    return F.array_join(F.filter(letters, lambda c: (c != "") & (F.pmod(F.ascii(c), F.lit(parts)) == part)), "")


def _choices(distance: int, parts: int) -> list[tuple[int, ...]]:
    return list(combinations(range(parts), parts - distance))


def _halves(word: Column, shorter: Column) -> list[Column]:
    """What an edit leaves: the letters before the middle of the shorter word, and those behind it."""
    middle = F.floor(shorter / 2).cast("int")
    return [F.substring(word, F.lit(1), middle), F.substring(word, F.length(word) - (shorter - middle) + 1, shorter - middle)]


def signatures(counted: DataFrame) -> DataFrame:
    """`slot` (which signature), `longer` (the word is the longer one of its pairs),
    `signature` (64-bit hash), `word`, `n`. A word has one entry per slot and side."""
    length = F.length("word")
    entries = []
    for base, (distance, parts), sides in ((0, _SAME, (False,)), (100, _LONGER, (False, True))):
        held = [f"_{parts}_{p}" for p in range(parts)]
        for side in sides:
            shorter = length - int(side)
            halves = _halves(F.col("word"), shorter)
            for i, chosen in enumerate(_choices(distance, parts)):
                for j, half in enumerate(halves):
                    slot = base + 2 * i + j
                    entries.append(F.struct(
                        F.lit(slot).alias("slot"), F.lit(side).alias("longer"),
                        F.xxhash64(F.lit(slot), shorter, half, *[F.col(held[p]) for p in chosen]).alias("signature")))
    parts = {f"_{k}_{p}": _part(F.col("_letters"), p, k) for _, k in (_SAME, _LONGER) for p in range(k)}
    return (counted.withColumn("_letters", _letters(F.col("word"))).withColumns(parts).select("word", "n", F.explode(F.array(*entries)).alias("e"))
            .select("e.slot", "e.longer", "e.signature", "word", "n"))


def _first_slot(a: Column, b: Column, a_letters: Column, b_letters: Column) -> Column:
    """The first slot that near words `a` and `b` (the longer one, if one is) share."""
    shorter = F.length(a)
    left_half = F.when(_halves(a, shorter)[0] == _halves(b, shorter)[0], 0).otherwise(1)

    def first(base: int, distance: int, parts: int) -> Column:
        agree = [_part(a_letters, p, parts) == _part(b_letters, p, parts) for p in range(parts)]
        shared = F.lit(-1)
        for i, chosen in reversed(list(enumerate(_choices(distance, parts)))):
            both = agree[chosen[0]]
            for p in chosen[1:]:
                both = both & agree[p]
            shared = F.when(both, base + 2 * i).otherwise(shared)
        return shared

    return F.when(F.length(a) == F.length(b), first(0, *_SAME)).otherwise(first(100, *_LONGER)) + left_half


def _one_edit(a: Column, b: Column) -> Column:
    """Words exactly one edit apart; `b` is as long as `a` or longer. Long words are compared behind
    their first difference, as the time of the edit distance grows with the square of the length."""
    differs = F.array_position(F.zip_with(F.split(a, ""), F.split(b, ""), lambda x, y: ~x.eqNullSafe(y)), True).cast("int")
    longer = F.length(b) - F.length(a)
    rest = F.substring(a, differs + 1, F.length(a)) == F.substring(b, differs + 1, F.length(b))
    without = F.substring(a, differs, F.length(a)) == F.substring(b, differs + 1, F.length(b))
    behind = F.when(differs == 0, False).when(longer == 0, rest).when(longer == 1, without).otherwise(False)
    return F.when(F.length(b) > 64, behind).otherwise(F.levenshtein(a, b, 1) == 1)


def near_words(counted: DataFrame) -> DataFrame:
    """`word`, `near`, `near_n`: each pair of words exactly one edit apart, in both directions."""
    entries = signatures(counted)
    a, b = entries.alias("a"), entries.alias("b")
    candidates = a.join(b, (F.col("a.signature") == F.col("b.signature")) & (F.col("a.slot") == F.col("b.slot"))
                        & ~F.col("a.longer") & ((F.col("b.slot") < 100) & (F.col("a.word") < F.col("b.word"))
                                                | F.col("b.longer")))
    close = candidates.where(_one_edit(F.col("a.word"), F.col("b.word"))).select(
        F.col("a.slot").alias("slot"), F.col("a.word").alias("x"), F.col("a.n").alias("x_n"),
        F.col("b.word").alias("y"), F.col("b.n").alias("y_n"))
    lettered = close.withColumns({"x_letters": _letters(F.col("x")), "y_letters": _letters(F.col("y"))})
    once = lettered.where(F.col("slot") == _first_slot(*map(F.col, ("x", "y", "x_letters", "y_letters"))))
    both = F.array(F.struct(F.col("x").alias("word"), F.col("y").alias("near"), F.col("y_n").alias("near_n")),
                   F.struct(F.col("y").alias("word"), F.col("x").alias("near"), F.col("x_n").alias("near_n")))
    return once.select(F.explode(both).alias("p")).select("p.*")


def roots(forms: DataFrame) -> DataFrame:
    """`word`, `root`: from `word`, `form` (which may be null) follow the forms to the last.

    Each round doubles the way that is known, and forms grow tenfold in count, so few rounds do.
    """
    step = cut_lineage(forms.where(F.col("form").isNotNull()).select("word", F.col("form").alias("root")))
    while True:
        ahead = step.select(F.col("word").alias("root"), F.col("root").alias("far"))
        moved = cut_lineage(step.join(ahead, "root", "left").select("word", "far", F.coalesce("far", "root").alias("root")))
        step = moved.select("word", "root")
        if moved.where(F.col("far").isNotNull()).isEmpty():
            return step


def group_variants(counted: DataFrame, factor: int = 10) -> DataFrame:
    """`word`, `n`, `n_near`, `form`, `form_n`, `root` per row of `counted` (`word`, `n`).

    `n_near` counts the words one insertion, deletion or replacement away. `form` is the one
    with the largest n (ties: the smallest in code-point order) if that is at least `factor`
    times the word's own, else null. `root` is the end of the chain of forms, the word itself
    if it has none. Words must be distinct; an empty table gives no rows.
    """
    counted = cut_lineage(counted)
    best = near_words(counted).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    enough = -F.col("best.less") >= factor * F.col("n")
    formed = cut_lineage(counted.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(enough, F.col("best.near")).alias("form"),
        F.when(enough, -F.col("best.less")).alias("form_n")))
    return formed.join(roots(formed), "word", "left").withColumn("root", F.coalesce("root", "word"))


def variants(df: DataFrame, id: str = "doc_id", text: str = "text", factor: int = 10) -> DataFrame:
    """`group_variants` of the `words` of all texts."""
    return group_variants(words(df, id, text), factor)

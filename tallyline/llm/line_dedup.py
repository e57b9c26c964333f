"""Line dedup by a deletion-neighbourhood join.

A line is a sequence of words (white space between them and ASCII case do not count). Two
lines are alike if they are equal, or if one word changed, came or went between them and
both have at least `min_words` words. Each line emits the hashes of itself and of all its
variants with one word left out. Equal hashes join:

* variants that lack the word at the same place differ in that word only (one change);
* a whole line and a variant of another differ by the word left out (one insertion);
* equal whole lines are equal.

Whether the edit distance is within the bound thus follows from the places, which travel
with the hashes; variants at different places (a moved word) are no match. A line goes if
any alike line stands earlier, in the order of document and line number, whether or not
that one stays. So per hash only the earliest line of each place matters to the others: a
chunk of documents sends no more than that, and a task never holds a group of copies.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import IntegralType

from tallyline.llm.packed import (
    U, by_bucket, expand, expand_sorted, in_batches, mix, releasing, releasing_groups, squeeze, squeeze_sorted, words)
from tallyline.operators.ordering import prefix_scan
from tallyline.session import cut_lineage

_BASE = U(0x9E3779B97F4A7C15)                       # odd, so it has an inverse modulo 2**64
_INVERSE = U(pow(int(_BASE), -1, 1 << 64))
_EXACT_ONLY = U(0x5851F42D4C957F2D)
_WHOLE = 0                                          # place of a whole line; others count from 1
_WORDS_PER_CHUNK = 900_000
_WORDS_PER_BUCKET = 1_000_000
_ROWS_AT_ONCE = 64
_NULL_ID = -(1 << 63)
_SETTLED = -1                                       # bucket of lines that a chunk itself decides

_SCHEMA = pa.schema([("bucket", pa.int32()), ("keys", pa.binary()), ("owners", pa.binary()), ("places", pa.binary()),
                     ("docs", pa.binary()), ("lines", pa.binary())])


def _positions(words_per_line: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each word its line and its place in it, from 0."""
    line = np.repeat(np.arange(len(words_per_line), dtype=np.int32), words_per_line)
    starts = (np.cumsum(words_per_line) - words_per_line).astype(np.int32)
    return line, np.arange(len(line), dtype=np.int32) - starts[line]


def neighbourhood(words: np.ndarray, words_per_line: np.ndarray, min_words: int
                  ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(key, line, place) of all lines and of the variants of those with `min_words` words.

    A sequence w of m words has the value sum(w[i] * base**i), which does not change its
    other terms when a word is left out but for one factor; its key mixes in m.
    """
    line, at = _positions(words_per_line)
    powers = np.cumprod(np.concatenate([[U(1)], np.full(int(words_per_line.max(initial=1)), _BASE)]), dtype=np.uint64)
    terms = powers[at]
    terms *= words
    through = np.cumsum(terms, dtype=np.uint64)
    ends = np.cumsum(words_per_line)
    before_line = np.concatenate([[U(0)], through])[ends - words_per_line]
    whole = np.concatenate([[U(0)], through])[ends] - before_line
    lengths = words_per_line.astype(np.uint64)
    keys = mix(whole + mix(lengths) + np.where(words_per_line < min_words, _EXACT_ONLY, U(0)))

    long_enough = words_per_line[line] >= min_words
    of, place = line[long_enough], at[long_enough]
    upto = through[long_enough] - before_line[of]
    del line, at, through
    variants = (whole[of] - upto) * _INVERSE
    upto -= terms[long_enough]
    variants += upto
    del upto, terms
    variants += mix(lengths - U(1))[of]
    variants = mix(variants)
    some = words_per_line > 0
    return (np.concatenate([keys[some], variants]), np.concatenate([np.flatnonzero(some).astype(np.int32), of]),
            np.concatenate([np.zeros(some.sum(), np.int32), place + 1]))


def _repeated(keys: np.ndarray) -> np.ndarray:
    """Which of the sorted keys occur more than once."""
    same = keys[1:] == keys[:-1]
    out = np.zeros(len(keys), bool)
    out[1:] = same
    out[:-1] |= same
    return out


def _lines(places: Sequence[int], texts: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of texts the hashes of their words, and per line the number of words, its text's place and its number."""
    joined = b"\n".join(texts)
    hashes, starts = words(joined)
    ends = np.append(np.flatnonzero(np.frombuffer(joined, np.uint8) == ord("\n")), len(joined))
    text, numbers = _positions(np.array([t.count(b"\n") + 1 for t in texts]))
    return hashes, np.diff(np.searchsorted(starts, ends), prepend=0), np.array(places, np.int64)[text], numbers


def _emit(chunk: list, buckets: int, min_words: int) -> Iterator[pa.RecordBatch]:
    """The rows of one chunk: what others must know, and the lines that go already."""
    words = np.concatenate([c[0] for c in chunk])
    counts = np.concatenate([c[1] for c in chunk])
    docs = np.concatenate([c[2] for c in chunk])
    numbers = np.concatenate([c[3] for c in chunk])
    chunk.clear()                                    # or everything would be held twice
    order = np.lexsort((numbers, docs))              # lines by standing
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))

    # Of equal lines only the earliest has a neighbourhood.
    line, at = _positions(counts)
    starts = np.cumsum(counts) - counts
    prints = np.add.reduceat(mix(words + mix(np.arange(counts.max(initial=1), dtype=np.uint64))[at]), starts[counts > 0]) if len(words) else words
    del at
    filled = np.flatnonzero(counts > 0)
    by_print = np.lexsort((rank[filled], prints))
    fresh = np.ones(len(filled), bool)
    fresh[1:] = prints[by_print][1:] != prints[by_print][:-1]
    earliest = filled[by_print[fresh]]
    gone = np.zeros(len(counts), bool)
    repeats = filled[by_print[~fresh]]
    first_of = filled[by_print[np.maximum.accumulate(np.where(fresh, np.arange(len(fresh)), 0))]][~fresh]
    gone[repeats] = (docs[repeats] != docs[first_of]) | (numbers[repeats] != numbers[first_of])

    chosen = np.zeros(len(counts), bool)
    chosen[earliest] = True
    lines = np.flatnonzero(chosen)
    words = words[chosen[line]]
    del line
    keys, owner, place = neighbourhood(words, counts[lines], min_words)
    owner = lines.astype(np.int32)[owner]
    by_key = np.argsort(keys)
    keys, owner, place = keys[by_key], owner[by_key], place[by_key]
    shared = np.flatnonzero(_repeated(keys))          # most keys are alone
    by_key = shared[np.lexsort((rank[owner[shared]], place[shared], keys[shared]))]
    owner[shared], place[shared] = owner[by_key], place[by_key]
    first = np.ones(len(keys), bool)
    first[1:] = (keys[1:] != keys[:-1]) | (place[1:] != place[:-1])
    ahead = owner[np.maximum.accumulate(np.where(first, np.arange(len(first)), 0))]
    gone[owner[(docs[owner] != docs[ahead]) | (numbers[owner] != numbers[ahead])]] = True
    keys, owner, place = keys[first], owner[first], place[first]
    del by_key, shared, first, ahead, prints, words

    rows = []
    if gone.any():
        out = np.flatnonzero(gone)
        rows.append((_SETTLED, b"", b"", b"", squeeze(docs[out]), squeeze(numbers[out].astype(np.uint32))))
    for bucket, at, rest in by_bucket(keys, buckets):
        used, local = np.unique(rank[owner[at]], return_inverse=True)
        used = order[used]
        rows.append((bucket, squeeze_sorted(rest), squeeze(local.astype(np.uint32)),
                     squeeze(place[at].astype(np.uint32)), squeeze_sorted(docs[used].astype(np.int64)),
                     squeeze(numbers[used].astype(np.uint32))))
    yield from in_batches(rows, _SCHEMA)


def _join(table: pa.Table) -> pa.Table:
    """`doc`, `line` of the lines in a bucket that an alike line stands before."""
    rows = table.to_pylist()
    if rows and rows[0]["bucket"] == _SETTLED:
        docs = np.concatenate([expand(r["docs"], np.int64) for r in rows])
        numbers = np.concatenate([expand(r["lines"], np.uint32) for r in rows])
        return pa.table({"doc": docs, "line": numbers.astype(np.int32)})
    keys = np.concatenate([expand_sorted(r["keys"], np.uint64) for r in rows])
    owners = [expand(r["owners"], np.uint32) for r in rows]
    places = np.concatenate([expand(r["places"], np.uint32) for r in rows])
    docs = [expand_sorted(r["docs"], np.int64) for r in rows]
    numbers = [expand(r["lines"], np.uint32) for r in rows]

    # Only hashes with two entries or more can join.
    order = np.argsort(keys)
    shared = order[_repeated(keys[order])]
    keys, places = keys[shared], places[shared]
    # only their lines are looked up
    first = np.cumsum([0] + [len(d) for d in docs[:-1]])
    line = np.concatenate([o + np.uint32(f) for o, f in zip(owners, first)])[shared]
    docs, numbers = np.concatenate(docs)[line], np.concatenate(numbers)[line]
    del owners, line
    order = np.lexsort((numbers, docs, places, keys))
    keys, places, docs, numbers = keys[order], places[order], docs[order], numbers[order]
    n = len(keys)
    new_key = np.ones(n, bool)
    new_key[1:] = keys[1:] != keys[:-1]
    new_place = new_key.copy()
    new_place[1:] |= places[1:] != places[:-1]
    key_start = np.maximum.accumulate(np.where(new_key, np.arange(n), 0))
    place_start = np.maximum.accumulate(np.where(new_place, np.arange(n), 0))

    def earlier(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return (docs[a] < docs[b]) | ((docs[a] == docs[b]) & (numbers[a] < numbers[b]))

    every = np.arange(n)
    gone = earlier(place_start, every)                       # an earlier line at its own place
    has_whole = places[key_start] == _WHOLE                  # whole lines come first in a key
    gone |= has_whole & earlier(key_start, every)            # a whole line before a variant
    by_standing = np.lexsort((numbers, docs, keys))          # and the other way round
    first_of_key = by_standing[np.flatnonzero(new_key)] if n else by_standing
    first = first_of_key[np.cumsum(new_key) - 1] if n else by_standing
    gone |= (places == _WHOLE) & earlier(first, every)
    return pa.table({"doc": docs[gone], "line": numbers[gone].astype(np.int32)})


def repeated_lines(df: DataFrame, min_words: int = 8, id: str = "doc_id", text: str = "text") -> DataFrame:
    """`id` and `repeated` (ascending numbers, from 0, of its lines that go) per document that has any.

    Lines end at a line feed. Lines without words never go. A null text has no lines. Rows
    that repeat an id stand at the same place: line by line they do not remove each other,
    and what goes at a place goes in each of them; so do rows with a null id, which stand
    first. Ids that are no integers stand in their own order, as numbered by a prefix scan.
    """
    if not isinstance(df.schema[id].dataType, IntegralType):
        named = df.select(F.col(id).alias("_id"), F.col(text).alias("_text"))
        places = cut_lineage(prefix_scan(named.select("_id").where(F.col("_id").isNotNull()).distinct(), "_id", "_id")
                             .select("_id", F.col("row_number").alias("_number")))
        gone = repeated_lines(named.join(places, "_id", "left"), min_words, "_number", "_text")
        return gone.join(places, "_number", "left").select(F.col("_id").alias(id), "repeated")
    words = df.agg(F.sum(F.length(text))).first()[0] or 0
    buckets = max(4 * df.sparkSession.sparkContext.defaultParallelism, -(-words // (5 * _WORDS_PER_BUCKET)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, held = [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, _ROWS_AT_ONCE):
                piece = batch.slice(at, _ROWS_AT_ONCE)
                listed = [(_NULL_ID if p is None else p, t) for p, t in
                          zip(piece.column(0).to_pylist(), piece.column(1).cast(pa.binary()).to_pylist()) if t]
                if not listed:
                    continue
                chunk.append(_lines(*zip(*listed)))
                held += len(chunk[-1][0]) + len(chunk[-1][1])
                if held >= _WORDS_PER_CHUNK:
                    yield from _emit(chunk, buckets, min_words)
                    chunk, held = [], 0
        if chunk:
            yield from _emit(chunk, buckets, min_words)

    packed = df.select(F.col(id).cast("bigint").alias("id"), F.col(text).alias("text")).mapInArrow(
        releasing(run), "bucket int, keys binary, owners binary, places binary, docs binary, lines binary")
    # What the chunks decided stays spread; a bucket's rows meet in one task.
    salt = F.when(F.col("bucket") == _SETTLED, F.xxhash64("docs", "lines"))
    gone = (packed.withColumn("salt", salt).groupBy("bucket", "salt")
            .applyInArrow(releasing_groups(_join), "doc bigint, line int"))
    return (gone.groupBy("doc").agg(F.sort_array(F.collect_set("line")).alias("repeated"))
            .select(F.when(F.col("doc") != _NULL_ID, F.col("doc")).cast(df.schema[id].dataType).alias(id), "repeated"))


def drop_repeated(df: DataFrame, min_words: int = 8, id: str = "doc_id", text: str = "text") -> DataFrame:
    """`df` with the repeated lines taken out of its text, columns and rows as before.

    A document all of whose lines go keeps an empty text; null stays null.
    """
    taken, free = set(df.columns), "_gone"
    while free in taken or f"{free}_id" in taken:
        free += "_"
    gone = repeated_lines(df, min_words, id, text).select(F.col(id).alias(f"{free}_id"), F.col("repeated").alias(free))
    lines = F.split(F.col(text), "\n", -1)
    stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(free))
    kept = F.array_join(F.transform(stay, lambda i: F.get(lines, i)), "\n")
    joined = df.join(gone, F.col(id).eqNullSafe(F.col(f"{free}_id")), "left")
    return joined.select(*[F.when(F.col(free).isNull() | F.col(c).isNull(), F.col(c)).otherwise(kept).alias(c)
                           if c == text else F.col(c) for c in df.columns])

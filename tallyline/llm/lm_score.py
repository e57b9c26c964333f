"""Stupid-backoff scores from n-gram counts of the whole corpus.

Documents are dealt into chunks by a hash. A chunk explodes its texts into n-grams of every
order and sends each distinct one, with its count, to the count table's partition for its
hash. There the counts of all chunks are summed and joined back to the chunks that asked;
the chunk looks its n-grams up and sums the scores of each document. The exchange is packed
by bucket (see `packed`), a row per chunk and bucket: a frequent n-gram is one entry per
chunk, however often it occurs.

A document does not vouch for itself: its own occurrences are taken off every count it is
scored with, so that only what the rest of the corpus says counts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tallyline.llm.packed import U, by_bucket, expand, expand_sorted, in_parts, mix, squeeze, squeeze_sorted, words_of

_BASE = U(0x9E3779B97F4A7C15)
_TOKENS = U(1)                                    # stands for the number of tokens
_CHARS_PER_CHUNK = 7_000_000
_KEY_BITS = 56
_KEYS_PER_BUCKET = 1_000_000


def ngrams(texts: list[bytes | None], order: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """(tokens per text, per order the key of the n-gram that ends at each token; 0 where the
    text begins later). Words end at ASCII white space; ASCII case does not count."""
    parts = [words_of(part) for part in in_parts(t or b"" for t in texts)]
    words = np.concatenate([np.zeros(0, np.uint64), *(p[0] for p in parts)])
    counts = np.concatenate([np.zeros(0, np.int64), *(p[1] for p in parts)])
    at = np.arange(len(words)) - np.repeat(np.cumsum(counts) - counts, counts)
    keys, value = [], np.zeros(len(words), np.uint64)
    for n in range(1, order + 1):
        value[1:] = value[:-1] * _BASE               # of the words before, the last n - 1
        value[:1] = 0
        value += words
        key = mix(value + mix(np.array([n], np.uint64))) >> U(64 - _KEY_BITS)
        keys.append(np.where(at >= n - 1, key | U(2), U(0)))
    return counts, keys


def _distinct(keys: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys of all orders with their counts, and the number of tokens."""
    listed = np.sort(np.concatenate(keys))
    starts = np.flatnonzero(_fresh(listed))
    found, counts = listed[starts], np.diff(np.append(starts, len(listed)))
    real = found > _TOKENS
    return np.append(_TOKENS, found[real]), np.append(len(keys[0]), counts[real])


def _fresh(values: np.ndarray) -> np.ndarray:
    """Which values differ from the one before."""
    out = np.ones(len(values), bool)
    out[1:] = values[1:] != values[:-1]
    return out


def _ask(table: pa.Table, order: int, buckets: int) -> pa.Table:
    _, keys = ngrams(table.column("text").cast(pa.binary()).to_pylist(), order)
    distinct, counts = _distinct(keys)
    chunk = table.column("chunk")[0].as_py()
    rows = [(bucket, chunk, squeeze_sorted(rest), squeeze(counts[at].astype(np.uint32)))
            for bucket, at, rest in by_bucket(distinct, buckets)]
    columns = list(zip(*rows))
    return pa.table({"bucket": pa.array(columns[0], pa.int32()), "chunk": pa.array(columns[1], pa.int32()),
                     "keys": pa.array(columns[2], pa.binary()), "counts": pa.array(columns[3], pa.binary())})


def _count(table: pa.Table) -> pa.Table:
    """The counts of a bucket summed over chunks, in the order in which each chunk asked."""
    asked = [expand_sorted(k, np.uint64) for k in table.column("keys").to_pylist()]
    counts = np.concatenate([expand(c, np.uint32) for c in table.column("counts").to_pylist()])
    keys = np.concatenate(asked)
    order = np.argsort(keys)
    starts = np.flatnonzero(_fresh(keys[order]))
    totals = np.empty(len(keys), np.uint64)
    totals[order] = np.repeat(np.add.reduceat(counts[order].astype(np.uint64), starts), np.diff(np.append(starts, len(keys))))
    ends = np.cumsum([len(a) for a in asked])
    return pa.table({"bucket": table.column("bucket"), "chunk": table.column("chunk"),
                     "totals": pa.array([squeeze(t) for t in np.split(totals, ends[:-1])], pa.binary())})


def _others(counts: np.ndarray, keys: list[np.ndarray], totals: np.ndarray) -> list[np.ndarray]:
    """Per order how often each n-gram occurs outside of its text; 0 without an n-gram.

    One sort brings equal n-grams together, those of a text side by side. `totals` are those of
    `_distinct`."""
    listed = np.concatenate(keys)
    order = np.argsort(listed, kind="stable")
    listed = listed[order]
    fresh = _fresh(listed)
    place = np.cumsum(fresh) - (1 if len(listed) and listed[0] == 0 else 0)      # totals[0] is of no n-gram
    own = np.tile(np.repeat(np.arange(len(counts)), counts), len(keys))[order]
    runs = np.flatnonzero(fresh | _fresh(own))
    lengths = np.diff(np.append(runs, len(listed)))
    elsewhere = np.where(listed[runs] == 0, 0, totals[place[runs]].astype(np.int64) - lengths)
    out = np.empty(len(listed), np.int64)
    out[order] = np.repeat(elsewhere, lengths)
    return np.split(out, len(keys))


def stupid_backoff(counts: np.ndarray, keys: list[np.ndarray], totals: np.ndarray, discount: float
                   ) -> tuple[np.ndarray, np.ndarray]:
    """(sum of log scores, tokens found at the highest order) per text.

    The score of a token is the share of its context's occurrences that it follows, at the
    longest context where that is not zero, times `discount` for each word of context given
    up; a word that occurs nowhere else counts as one of one more occurrence.
    """
    doc = np.repeat(np.arange(len(counts)), counts)
    others = _others(counts, keys, totals)
    rest = np.maximum(totals[0].astype(np.int64) - counts, 0)[doc].astype(np.float64)
    score = np.where(others[0] > 0, others[0], 1.0) / np.where(others[0] > 0, np.maximum(rest, 1), rest + 1)
    first = np.concatenate([[True], doc[1:] != doc[:-1]]) if len(doc) else np.zeros(0, bool)
    for n in range(1, len(keys)):
        context = np.concatenate([[0], others[n - 1][:-1]]) if len(doc) else others[n - 1]
        context = np.where(first, 0, context)
        has_context = keys[n] != 0
        seen = has_context & (others[n] > 0) & (context > 0)
        share = others[n] / np.maximum(context, 1)
        score = np.where(seen, np.minimum(share, 1.0), np.where(has_context, discount * score, score))
    top = (others[-1] > 0).astype(np.float64)
    return (np.bincount(doc, np.log(score), len(counts)), np.bincount(doc, top, len(counts)).astype(np.int64))


def _answer(docs: pa.Table, replies: pa.Table, order: int, buckets: int, discount: float) -> pa.Table:
    counts, keys = ngrams(docs.column("text").cast(pa.binary()).to_pylist(), order)
    if docs.num_rows:
        distinct, _ = _distinct(keys)
        totals = np.zeros(len(distinct), np.uint64)
        by = {b: t for b, t in zip(replies.column("bucket").to_pylist(), replies.column("totals").to_pylist())}
        for bucket, at, _ in by_bucket(distinct, buckets):
            totals[at] = expand(by[bucket], np.uint64)
        logs, found = stupid_backoff(counts, keys, totals, discount)
    else:
        logs, found = np.zeros(0), np.zeros(0, np.int64)
    return pa.table({"id": docs.column("id"), "n_tokens": counts, "n_found": found, "log_score": logs,
                     "mean_log_score": np.where(counts > 0, logs / np.maximum(counts, 1), 0.0)})


def score(docs: DataFrame, id: str = "doc_id", text: str = "text", order: int = 3, discount: float = 0.4) -> DataFrame:
    """`id`, `n_tokens`, `n_found` (tokens whose longest n-gram occurs elsewhere), `log_score`
    and `mean_log_score` per row of `docs`.

    A null or empty text has no tokens and scores 0. Rows that repeat a text support each
    other: only the row itself is left out of its counts. An empty table gives no rows.
    """
    spread = 4 * docs.sparkSession.sparkContext.defaultParallelism
    chars = docs.agg(F.sum(F.length(text))).first()[0] or 0
    chunks = max(spread, -(-chars // _CHARS_PER_CHUNK))
    buckets = max(spread, -(-chars * order // (6 * _KEYS_PER_BUCKET)))
    placed = docs.select(F.col(id).alias("id"), F.col(text).alias("text"),
                         F.pmod(F.xxhash64(id, text), F.lit(chunks)).cast("int").alias("chunk"))
    kind = docs.schema[id].dataType.simpleString()

    def ask(table: pa.Table) -> pa.Table:
        return _ask(table, order, buckets)

    def answer(key: tuple, asking: pa.Table, replies: pa.Table) -> pa.Table:
        return _answer(asking, replies, order, buckets, discount)

    asked = placed.groupBy("chunk").applyInArrow(ask, "bucket int, chunk int, keys binary, counts binary")
    counted = asked.groupBy("bucket").applyInArrow(_count, "bucket int, chunk int, totals binary")
    scored = placed.groupBy("chunk").cogroup(counted.groupBy("chunk")).applyInArrow(
        answer, f"id {kind}, n_tokens bigint, n_found bigint, log_score double, mean_log_score double")
    return scored.withColumnRenamed("id", id)

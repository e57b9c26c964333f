"""Many small hashed entries in few rows: sorted columns, cut into hash buckets, compressed.

A join of very many 64-bit keys, most of which occur once, is dear as one row per key. Here
a task sorts the keys of a chunk of its rows, cuts them into buckets, and sends one row per
bucket, whose columns are delta-coded and compressed. Buckets are as many as the data need
for each to fit a task many times over.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard

U = np.uint64


class WordHashes(dict):
    """64-bit hashes by word; emptied when full, so memory does not depend on the input."""

    full = 300_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.full:
            self.clear()
        value = xxhash.xxh3_64_intdigest(word)
        if len(word) <= 64:
            self[word] = value
        return value


# One table per Python worker, for all operators.
WORDS = WordHashes()

_HELD: dict[str, Callable[[], None]] = {}


def claim(name: str, forget: Callable[[], None]) -> None:
    """An operator is about to use its memo: memos of other operators are emptied.

    Workers outlive their stage, so what one operator remembered would stay in memory while
    the next one works."""
    for other in [n for n in _HELD if n != name]:
        _HELD.pop(other)()
    _HELD[name] = forget


# Where the C library keeps freed memory for itself, it can be told to give it back.
_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)


def release() -> None:
    """Empties all memos and gives freed memory back, so that a worker that waits holds little."""
    while _HELD:
        _HELD.popitem()[1]()
    pa.default_memory_pool().release_unused()
    if _trim:
        _trim(0)


def releasing(run: Callable) -> Callable:
    """A function over batches that ends with `release`: its worker outlives it, beside the next tasks."""
    def released(batches):
        try:
            yield from run(batches)
        finally:
            release()
    return released


def releasing_groups(join: Callable) -> Callable:
    """The same for a function of one group."""
    def released(table):
        out = join(table)
        release()
        return out
    return released


def word_hashes(words: Iterable[bytes], n: int) -> np.ndarray:
    """The 64-bit hashes of `n` words."""
    claim("words", WORDS.clear)
    return np.fromiter(map(WORDS.__getitem__, words), np.uint64, n)


_SPACES = np.isin(np.arange(256), list(b" \t\n\v\f\r"))
_FIRST_BYTES = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
_SHORT_WORD = 32


def words(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes and first bytes of the words of a text, in its order.

    Words end at ASCII white space; ASCII case does not count. Eight bytes of all words are
    mixed in at a time; the few long words are hashed one by one.
    """
    size = len(text)
    text = text.lower() + bytes(8)
    outside = np.ones(size + 2, bool)
    outside[1:-1] = _SPACES[np.frombuffer(text, np.uint8)[:size]]
    edges = np.flatnonzero(outside[1:] != outside[:-1])
    starts, lengths = edges[::2], edges[1::2] - edges[::2]
    eight = np.ndarray(size + 1, "<u8", text, strides=(1,))        # the eight bytes from each place on
    out = mix(mix(lengths.astype(np.uint64)) ^ (eight[starts] & _FIRST_BYTES[np.minimum(lengths, 8)]))
    long = lengths > _SHORT_WORD
    at = np.flatnonzero((lengths > 8) & ~long)
    for done in range(8, _SHORT_WORD, 8):
        left = lengths[at] - done
        out[at] = mix(out[at] * U(0x9E3779B97F4A7C15) + (eight[starts[at] + done] & _FIRST_BYTES[np.minimum(left, 8)]))
        at = at[left > 8]
    if long.any():
        out[long] = word_hashes((text[b:b + n] for b, n in zip(starts[long].tolist(), lengths[long].tolist())), int(long.sum()))
    return out, starts


def words_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of the words of all texts, and the number of words of each."""
    hashes, starts = words(b"\n".join(texts))
    ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)
    return hashes, np.diff(np.searchsorted(starts, ends), prepend=0)


def in_parts(texts: Iterable[bytes], size: int = 1 << 18) -> Iterator[list[bytes]]:
    """The texts in lists of about `size` bytes."""
    part, held = [], 0
    for text in texts:
        part.append(text)
        held += len(text) + 1
        if held >= size:
            yield part
            part, held = [], 0
    if part:
        yield part


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective mixing of unsigned 64-bit integers (splitmix64 finaliser)."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def squeeze(values: np.ndarray) -> bytes:
    """Bytes of equal weight side by side, compressed."""
    return zstandard.compress(np.ascontiguousarray(values.view(np.uint8).reshape(len(values), -1).T).tobytes(), 1)


def expand(data: bytes, kind: type) -> np.ndarray:
    raw = np.frombuffer(zstandard.decompress(data), np.uint8)
    return np.ascontiguousarray(raw.reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


def squeeze_sorted(values: np.ndarray) -> bytes:
    return squeeze(np.diff(values, prepend=values.dtype.type(0)))


def expand_sorted(data: bytes, kind: type) -> np.ndarray:
    return np.cumsum(expand(data, kind), dtype=kind)


def by_bucket(keys: np.ndarray, buckets: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(bucket, positions of its keys in ascending order, the keys without the bucket) for
    each bucket that has any."""
    order = np.argsort(keys)
    bucket = (keys[order] % U(buckets)).astype(np.uint16 if buckets <= 1 << 16 else np.int64)   # radix sort of 16 bits
    order = order[np.argsort(bucket, kind="stable")]
    ends = np.concatenate([[0], np.cumsum(np.bincount(bucket, minlength=buckets))])
    for b in np.flatnonzero(np.diff(ends)):
        at = order[ends[b]:ends[b + 1]]
        yield int(b), at, keys[at] // U(buckets)


def in_batches(rows: list[tuple], schema: pa.Schema, size: int = 64) -> Iterator[pa.RecordBatch]:
    for at in range(0, len(rows), size):
        yield pa.RecordBatch.from_pylist([dict(zip(schema.names, row)) for row in rows[at:at + size]], schema)

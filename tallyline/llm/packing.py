"""Packing by power-of-two decomposition.

A document of n ids is cut by the binary digits of n: as many pieces of `max_length` as
fit, then one piece per remaining binary digit, longest first. Pieces of equal length form
a bucket, and each piece is one sequence of that bucket, so no sequence crosses documents
and none is padded.

Whether a piece exists depends on its document alone, so packing is one narrow pass:
nothing is shuffled, however long a document or frequent a length is.
"""

from __future__ import annotations

import string
import struct
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tallyline.llm.packed import claim, releasing

_MEMO_CHARS = 64
_AFTER_LATIN = "\u0250"     # letters before it are composed, and lower-cased one by one


class WordIds(dict):
    """Ids of a `tokenizers` file (little-endian unsigned 32-bit integers), remembered per word.

    The tokenizer drops white space and never looks across it, so a text is cut at spaces
    and line ends and each distinct word is tokenized once. It also never joins punctuation
    to a letter or digit before it, so what follows the last of them is cut off first. What is
    left is often one run of Latin letters in either case: lower-cased, it is one unit, which
    goes to the merges of the file as its bytes are spelled there. The memo is emptied at
    `max_memo` entries, so memory does not depend on the input.
    """

    def __init__(self, path: str, max_memo: int = 300_000):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        super().__init__()
        self._tokenizer = Tokenizer.from_file(path)
        self._merges = self._tokenizer.model
        spelled = ByteLevel(add_prefix_space=False, use_regex=False)
        self._spelled = {c: spelled.pre_tokenize_str(chr(c))[0][0] for c in range(128, ord(_AFTER_LATIN)) if chr(c).isalpha()}
        # an apostrophe may begin a unit of its own, and an added token is one whatever it holds
        added = "".join(t.content for t in self._tokenizer.get_added_tokens_decoder().values())
        self._ends = "".join(c for c in string.punctuation if c not in "'" + added)
        self.max_memo = max_memo

    def encode(self, text: str) -> bytes:
        return b"".join(map(self.__getitem__, text.replace("\n", " ").split(" ")))

    def __missing__(self, word: str) -> bytes:
        core, tail = word, ""
        if not word.isalpha():
            core = word.rstrip(self._ends)
            tail = word[len(core):]
        lower = core.lower()
        if not lower or not lower[-1].isalnum():             # a capital dotted I ends in a mark
            ids = self._whole(word)
        elif lower.isalpha() and (lower.isascii() or max(lower) < _AFTER_LATIN):
            if lower == word:
                ids = _packed([t.id for t in self._merges.tokenize(word if word.isascii() else word.translate(self._spelled))])
            else:
                ids = self[lower] + self[tail] if tail else self[lower]
        else:
            ids = self[core] + self[tail] if tail else self._whole(word)
        if len(word) <= _MEMO_CHARS:
            if len(self) >= self.max_memo:
                self.clear()
            self[word] = ids
        return ids

    def _whole(self, word: str) -> bytes:
        return _packed(self._tokenizer.encode_batch_fast([word], add_special_tokens=False)[0].ids)


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


@lru_cache(maxsize=2)
def _shared(path: str) -> WordIds:
    """One coder per Python worker, for all tasks that it runs."""
    return WordIds(path)


def binary_pieces(n: int, max_length: int) -> Iterator[tuple[int, int]]:
    """(start, length) of the pieces of n ids; `max_length` is a power of two."""
    start, length = 0, max_length
    while start < n:
        while length > n - start:
            length >>= 1
        yield start, length
        start += length


PIECE = "start bigint, length bigint, ids binary, doc_tokens bigint"


def pieces(df: DataFrame, path: str, end_id: int | None = 1, max_length: int = 2048,
           id: str = "doc_id", text: str = "text") -> DataFrame:
    """`id`, `start`, `length`, `ids`, `doc_tokens` per piece of every row of `df`.

    A null text is an empty one; with `end_id` (appended to every document) it has one
    piece, without it none. Repeated rows are packed as often as they occur. Columns other
    than `id` and `text` are not read.
    """
    if max_length & (max_length - 1) or max_length < 1:
        raise ValueError("max_length must be a power of two")
    end = b"" if end_id is None else end_id.to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _shared(path)
        claim("ids", coder.clear)
        for batch in batches:
            rows, starts, lengths, cut, totals = [], [], [], [], []
            for row, t in enumerate(batch.column(1)):
                ids = coder.encode(t.as_py() or "") + end
                n = len(ids) // 4
                for start, length in binary_pieces(n, max_length):
                    rows.append(row)
                    starts.append(start)
                    lengths.append(length)
                    cut.append(ids[4 * start:4 * (start + length)])
                    totals.append(n)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(starts, pa.int64()),
                 pa.array(lengths, pa.int64()), pa.array(cut, pa.binary()), pa.array(totals, pa.int64())],
                [id, "start", "length", "ids", "doc_tokens"])

    kind = df.schema[id].dataType.simpleString()
    return df.select(id, text).mapInArrow(releasing(run), f"`{id}` {kind}, {PIECE}")


def pack(df: DataFrame, path: str, end_id: int | None = 1, max_length: int = 2048,
         id: str = "doc_id", text: str = "text") -> DataFrame:
    """`pieces` with `sequence_id`, `offset` (always 0) and `bucket` (log2 of the length).

    Sequence ids are unique and their remainder modulo 64 is the bucket, so
    `pack(...).write.partitionBy("bucket")` gives one folder per length. Empty input gives
    no sequences.
    """
    found = pieces(df, path, end_id, max_length, id, text)
    bucket = F.round(F.log2("length")).cast("int")
    return (found.withColumn("bucket", bucket)
            .withColumn("sequence_id", F.monotonically_increasing_id() * 64 + F.col("bucket"))
            .withColumn("offset", F.lit(0).cast("bigint")))

"""Byte-level BPE by a lazily determinised transducer, and a streaming decoder.

A token sequence is the BPE encoding of its bytes exactly if every two neighbours are a
*stable pair*: no merge ever crosses the seam between them. That gives a nondeterministic
transducer over bytes. A configuration is (pending tokens, last token, trie node): reading
a byte walks down the trie of the vocabulary; where a token ends and is stable behind the
last one, a second configuration starts the next token. Every prefix has one encoding, so
one configuration per token boundary is alive.

`MergeTransducer` determinises this machine while it reads. A state is the set of live
configurations; the tokens that all of them share are emitted on the transition, the
others wait. A configuration whose partial token has no continuation dies, so the wait is
bounded by the longest token. Transitions are computed when they are first taken and kept;
the table is emptied when it reaches `max_transitions`, and so is the memo of whole matches
at `max_memo`, so memory does not depend on the input.

`Utf8Stream` decodes ids piece by piece: a state machine over byte classes knows how many
bytes of a character are outstanding and holds them back until it is complete.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import sys
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

_ROOT = 0
_NEVER = 1 << 40
_PAIR = 20  # bits of a token id in a pair key
_MEMO_CHARS = 64


def read_ranks(path: str) -> list[bytes]:
    """The tokens of a `.tiktoken` file by id. Ids must be 0..n-1."""
    with open(path, "rb") as lines:
        pairs = [line.split() for line in lines if line.strip()]
    tokens = [b""] * len(pairs)
    for token, rank in pairs:
        tokens[int(rank)] = base64.b64decode(token)
    return tokens


class MergeTransducer:
    """Encodes byte strings by the ranks of `tokens` (index = id = merge priority)."""

    def __init__(self, tokens: list[bytes], max_transitions: int = 600_000, max_memo: int = 200_000):
        self.tokens = tokens
        self.max_transitions, self.max_memo = max_transitions, max_memo
        self._id = {t: i for i, t in enumerate(tokens)}
        self._merge: dict[int, int] = {}      # left, right -> id of the concatenation
        self._right: dict[int, tuple] = {}    # id -> ((right-edge token, rank of the merge that takes it), ...)
        self._left: dict[int, tuple] = {}
        self._stable: dict[int, bool] = {}
        self._learn_seams()
        self._grow_trie()
        self._reset()
        self._memo: dict[str, bytes] = {}

    # -- the nondeterministic machine --

    def _learn_seams(self) -> None:
        ids, merge = self._id, self._merge
        self.reachable = bytearray(len(self.tokens))
        for t, word in enumerate(self.tokens):
            if len(word) == 1:
                self._right[t] = self._left[t] = ((t, _NEVER),)
                self.reachable[t] = 1
                continue
            parts = None
            for cut in range(1, len(word)):
                a, b = ids.get(word[:cut]), ids.get(word[cut:])
                if a is None or b is None or a >= t or b >= t or not (self.reachable[a] and self.reachable[b]):
                    continue
                if parts is None and self._holds(a, b):  # before the pair itself is known as a merge
                    parts = a, b
                merge[a << _PAIR | b] = t
            if parts:
                a, b = parts
                self._right[t] = ((t, _NEVER), *((x, t if r == _NEVER else r) for x, r in self._right[b]))
                self._left[t] = ((t, _NEVER), *((x, t if r == _NEVER else r) for x, r in self._left[a]))
                self.reachable[t] = 1

    def _holds(self, a: int, b: int) -> bool:
        """No merge crosses the seam: a pair of edge tokens would merge only before either is
        taken by its own side; of equal merges the left one goes first."""
        merge = self._merge
        for x, x_taken in self._right[a]:
            for y, y_taken in self._left[b]:
                r = merge.get(x << _PAIR | y)
                if r is not None and r < x_taken and r <= y_taken:
                    return False
        return True

    def stable(self, a: int, b: int) -> bool:
        key = a << _PAIR | b
        known = self._stable.get(key)
        if known is None:
            if len(self._stable) >= self.max_transitions:
                self._stable.clear()
            known = self._stable[key] = self._holds(a, b)
        return known

    def _grow_trie(self) -> None:
        self._child: dict[int, int] = {}
        self._ends: dict[int, int] = {}
        nodes = 1
        for t, word in enumerate(self.tokens):
            if not self.reachable[t]:
                continue
            at = _ROOT
            for byte in word:
                key = at << 8 | byte
                below = self._child.get(key)
                if below is None:
                    below = self._child[key] = nodes
                    nodes += 1
                at = below
            self._ends[at] = t

    # -- its lazy determinisation --

    def _reset(self) -> None:
        self._next: dict[int, tuple[int, bytes]] = {}
        self._state_of: dict[tuple, int] = {}
        self._states: list[tuple] = []
        self._closing: list[bytes | None] = []
        self._state((((), -1, _ROOT),))

    def _state(self, configurations: tuple) -> int:
        known = self._state_of.get(configurations)
        if known is None:
            known = self._state_of[configurations] = len(self._states)
            self._states.append(configurations)
            self._closing.append(None)
        return known

    def _step(self, state: int, byte: int) -> tuple[int, bytes]:
        alive = []
        child, ends = self._child, self._ends
        for waiting, last, node in self._states[state]:
            below = child.get(node << 8 | byte)
            if below is None:
                continue
            alive.append((waiting, last, below))
            t = ends.get(below)
            if t is not None and (last < 0 or self.stable(last, t)):
                alive.append(((*waiting, t), t, _ROOT))
        shortest = min(alive, key=lambda c: len(c[0]))[0]
        shared = 0
        while shared < len(shortest) and all(c[0][shared] == shortest[shared] for c in alive):
            shared += 1
        out = struct.pack(f"<{shared}I", *shortest[:shared])
        if shared:
            alive = [(c[0][shared:], c[1], c[2]) for c in alive]
        taken = self._next[state << 8 | byte] = self._state(tuple(alive)), out
        return taken

    def _close(self, state: int) -> bytes:
        waiting = next(c[0] for c in self._states[state] if c[2] == _ROOT)
        out = self._closing[state] = struct.pack(f"<{len(waiting)}I", *waiting)
        return out

    def run(self, data: bytes) -> bytes:
        """Ids of one match as little-endian unsigned 32-bit integers."""
        whole = self._id.get(data)
        if whole is not None:
            return struct.pack("<I", whole)
        if not data:
            return b""
        table, state, out = self._next, 0, []
        for byte in data:
            taken = table.get(state << 8 | byte)
            if taken is None:
                if len(table) >= self.max_transitions:    # also amid a match: only the state is carried over
                    here = self._states[state]
                    self._reset()
                    table, state = self._next, self._state(here)
                taken = self._step(state, byte)
            state = taken[0]
            if taken[1]:
                out.append(taken[1])
        out.append(self._closing[state] or self._close(state))
        return b"".join(out)

    def match(self, match: str) -> bytes:
        """`run` on a match of the split pattern, remembered if short."""
        ids = self._memo.get(match)
        if ids is None:
            ids = self.run(match.encode())
            if len(match) <= _MEMO_CHARS:
                if len(self._memo) >= self.max_memo:
                    self._memo.clear()
                self._memo[match] = ids
        return ids


class ByteBpe:
    """Text to ids and back for a vocabulary file and a split pattern.

    Words between single spaces are remembered with their ids: the pattern never joins a
    word to what precedes the one space before it. A text in which a space touches other
    white space is split by the pattern as a whole.
    """

    def __init__(self, path: str, pattern: str, max_memo: int = 400_000):
        self._split = regex.compile(pattern).findall
        self.machine = MergeTransducer(read_ranks(path), max_memo=max_memo // 2)
        self.tokens = self.machine.tokens
        self.max_memo = max_memo
        self._words: dict[str, bytes] = {}

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        words = text.split(" ")
        first = words[0]
        if not first or first[-1].isspace():
            return self._whole(text)
        ids = list(map(self._words.get, words))
        ids[0] = self._whole(first)
        for i, known in enumerate(ids):
            if known is None:
                word = words[i]
                if not word or word[0].isspace() or word[-1].isspace():
                    return self._whole(text)
                ids[i] = known = self._whole(" " + word)
                if len(word) <= _MEMO_CHARS:
                    if len(self._words) >= self.max_memo:
                        self._words.clear()
                    self._words[word] = known
        return b"".join(ids)

    def _whole(self, text: str) -> bytes:
        return b"".join(map(self.machine.match, self._split(text)))

    def decode(self, ids: bytes, piece: int = 4096) -> Iterator[str]:
        """The text of the ids, `piece` ids at a time."""
        stream = Utf8Stream()
        tokens = self.tokens
        numbers = memoryview(ids).cast("I") if sys.byteorder == "little" else struct.unpack(f"<{len(ids) // 4}I", ids)
        for at in range(0, len(numbers), piece):
            yield stream.feed(b"".join(map(tokens.__getitem__, numbers[at:at + piece])))
        yield stream.end()


class Utf8Stream:
    """Incremental UTF-8 decoding: `feed` returns the text of all characters that are complete.

    The state is the bytes of an unfinished character (at most three). Ill-formed sequences
    become U+FFFD, as in `bytes.decode(errors="replace")` over the whole input.
    """

    # Outstanding bytes after a lead byte, by its class (RFC 3629).
    _NEEDS = bytes([0] * 0xC2 + [1] * 30 + [2] * 16 + [3] * 5 + [0] * 11)

    def __init__(self) -> None:
        self.held = b""

    def feed(self, data: bytes) -> str:
        data = self.held + data if self.held else data
        self.held = data[len(data) - self._unfinished(data):]
        return (data[:-len(self.held)] if self.held else data).decode("utf-8", "replace")

    def end(self) -> str:
        rest, self.held = self.held, b""
        return rest.decode("utf-8", "replace")

    def _unfinished(self, data: bytes) -> int:
        for back in range(1, min(3, len(data)) + 1):
            byte = data[-back]
            if byte & 0xC0 != 0x80:
                if self._NEEDS[byte] < back:
                    return 0
                try:  # what can no longer become a character is not held back
                    data[-back:].decode("utf-8")
                except UnicodeDecodeError as e:
                    return back if e.reason == "unexpected end of data" else 0
                return 0
        return 0


@lru_cache(maxsize=2)
def _shared(path: str, pattern: str) -> ByteBpe:
    """One coder per Python worker: its tables serve all tasks that the worker runs."""
    return ByteBpe(path, pattern)


ENCODED = "ids binary, n_tokens bigint"


def encode(df: DataFrame, path: str, pattern: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """`id`, `ids` (little-endian unsigned 32-bit), `n_tokens` per row of `df`, in one narrow pass.

    A null or empty text has no ids. Equal rows give equal rows. Other columns are not read.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _shared(path, pattern)
        for batch in batches:
            ids = [coder.encode(t or "") for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(ids, pa.binary()), pa.array([len(i) // 4 for i in ids], pa.int64())],
                [id, "ids", "n_tokens"])

    kind = df.schema[id].dataType.simpleString()
    return df.select(id, text).mapInArrow(run, f"`{id}` {kind}, {ENCODED}")


def decode(df: DataFrame, path: str, pattern: str, id: str = "doc_id", ids: str = "ids") -> DataFrame:
    """`id` and `decoded`, the text of the ids. Null ids decode to the empty text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _shared(path, pattern)
        for batch in batches:
            texts = ["".join(coder.decode(i or b"")) for i in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], [id, "decoded"])

    kind = df.schema[id].dataType.simpleString()
    return df.select(id, ids).mapInArrow(run, f"`{id}` {kind}, decoded string")


def round_trip(df: DataFrame, path: str, pattern: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Digests of the ids and of the text decoded from them, without keeping either.

    Per row: `id`, `n_tokens`, `ids_sha256`, `decoded_sha256`. Ids are encoded and decoded
    inside one task, so only the digests leave it.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _shared(path, pattern)
        for batch in batches:
            counts, before, after = [], [], []
            for t in batch.column(1):
                ids = coder.encode(t.as_py() or "")
                digest = hashlib.sha256()
                for part in coder.decode(ids):
                    digest.update(part.encode())
                counts.append(len(ids) // 4)
                before.append(hashlib.sha256(ids).hexdigest())
                after.append(digest.hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(before, pa.string()),
                 pa.array(after, pa.string())], [id, "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = df.schema[id].dataType.simpleString()
    return df.select(id, text).mapInArrow(
        run, f"`{id}` {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")

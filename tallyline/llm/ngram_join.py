"""Exact n-gram Jaccard join by PartEnum signatures, and its connected components.

Two sets with Jaccard similarity of at least g differ in at most (1-g)/(1+g) of the sum of
their sizes. Sizes are cut into bands of ratio 1/g, so similar sets lie in one band or in
neighbouring ones, and each pair of neighbouring bands is one instance with a bound k on
the difference. An instance divides the domain of shingles into more than k parts, so at
least one part has no difference: with the hash of each of its parts (here one subset is
enumerated per part) as signatures, similar sets share one.

How the domain is divided is free, and which parts are signed too, as long as all sets rank
them alike. There are many more parts than the bound k, so a part holds few shingles. Two similar
sets have different hashes in at most k parts, so of the parts of each that are not empty, ranked by
how few sets hold their rarest shingle, the first k + 1 are enough: the first part that both
have is among them. How many sets hold a shingle is counted over all texts, by a hash of 40 bits; where hashes
meet, a count is too high, which costs a candidate and never a link. A shingle that one set alone holds
differs from every other set, so a part with one is not sent, and a set with more of them than
similar sets may differ in sends nothing: most texts of a corpus that are near to no other.
A set with no more than k parts that are not empty is signed by each single shingle besides.

Texts are dealt into chunks. A chunk asks for the counts of its shingles, which come back to it
packed in the order in which it asked; then the texts are described and signed.

Signatures travel packed by hash bucket, sorted and compressed, because most occur once.
Sets that share one are candidates. Equal sets are one class throughout, and candidate
groups are not expanded into all pairs: the members of a group are compared with its center,
the one that shares most signatures, linked ones are merged, and a group that is one component
is done. In the rest, members of different components are compared pair by pair inside tasks: small
groups whole, large ones, those with most members in one component together, in blocks of members. All such pairs are
looked at, so no link is lost. A task gives only pairs that may be similar: whether the numbers of their shingles
in a few hash cells are odd bounds the difference from below, which settles nearly all unlike pairs. These go on to be
compared in full.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, functions as F

from tallyline.llm.packed import (
    U, by_bucket, expand, expand_sorted, in_batches, mix, release, releasing, releasing_groups, squeeze, squeeze_sorted, words as word_hashes)
from tallyline.session import cut_lineage

_BASE = U(0x9E3779B97F4A7C15)
_MASK = np.uint64(0xFFFFFFFFFFFF)             # signatures are 48 bits
_BYTES_PER_CHUNK = 7_000_000
_KEY_BITS = 40                                # of the hashes by which shingles are counted
_ENTRIES_PER_BUCKET = 2_000_000
_CLASS_BYTES = 12
_PARTS = 8                                    # for each difference that similar sets may have
_MAX_BROADCAST = 300_000
_MAX_SKETCH_BYTES = 16_000_000
_EDGES_PER_SALT = 10_000
_MAX_SKETCH_BITS = 17
_SMALL_GROUP = 256
_MEMBERS_PER_BUCKET = 100_000
_LEAST_BLOCK = 256
_BLOCK = 4096
_PAIRS_AT_ONCE = 500_000


def shingles(text: str | None, words: int) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct `words`-word shingles of a text.

    ASCII letters are lower-cased and words end at ASCII white space. With fewer words the
    whole sequence is the only shingle; without words there is none.
    """
    hashes, _ = word_hashes(text.encode("utf-8", "surrogatepass") if text else b"")
    if not len(hashes):
        return np.zeros(0, np.uint64)
    width = min(words, len(hashes))
    n = len(hashes) - width + 1
    out = np.zeros(n, np.uint64)
    for i in range(width):
        out = out * _BASE + hashes[i:i + n]
    out = np.sort(mix(out + U(width)))
    fresh = np.ones(n, bool)
    fresh[1:] = out[1:] != out[:-1]
    return out[fresh]


class Bands:
    """Size bands and, per instance, the bound on the difference and the number of parts."""

    def __init__(self, similarity: Fraction, largest: int = 1 << 44):
        self.similarity = similarity
        self.starts = [1]
        while self.starts[-1] <= largest:
            self.starts.append(int(self.starts[-1] / similarity) + 1)

    def band(self, size: int) -> int:
        return bisect_right(self.starts, size) - 1

    def difference(self, instance: int) -> int:
        """Instance i compares sets of the bands i-1 and i."""
        return int((1 - self.similarity) / (1 + self.similarity) * 2 * (self.starts[instance + 1] - 1))

    def parts(self, instance: int) -> int:
        return _PARTS * (self.difference(instance) + 1)


def _part_hashes(elements: np.ndarray, held: np.ndarray, parts: int, seed: np.uint64) -> tuple[np.ndarray, np.ndarray]:
    """Of each part that has elements their hash, and the least of their counts."""
    dealt = mix(elements ^ seed)
    value = mix(dealt + seed)
    part = (dealt % U(parts)).astype(np.int64)
    low = np.bincount(part, value & U(0xFFFFFFFF), parts).astype(np.uint64)
    high = np.bincount(part, value >> U(32), parts).astype(np.uint64)
    least = np.full(parts, np.iinfo(np.int64).max)
    np.minimum.at(least, part, held)
    filled = np.flatnonzero(least < np.iinfo(np.int64).max)
    return mix(mix((low + (high << U(32)))[filled] ^ seed) + filled.astype(np.uint64)), least[filled]


def signatures(elements: np.ndarray, bands: Bands, frequent: np.ndarray | None = None, held: np.ndarray | None = None) -> np.ndarray:
    """The 48-bit signatures of a set of shingle hashes.

    `held` says of each element how many sets hold it, at least, or what ranks them alike for
    all sets; 1 is for one that no other set holds. Without it, those in the sorted array
    `frequent` come last."""
    size = len(elements)
    if held is None:
        held = np.full(size, 2)
        if size and frequent is not None and len(frequent):
            held += frequent[np.minimum(np.searchsorted(frequent, elements), len(frequent) - 1)] == elements
    alone = int(np.count_nonzero(held == 1))
    # similar sets have at least this share of either in common
    if not size or alone > int((1 - bands.similarity) * size):
        return np.zeros(0, np.uint64)
    out = [np.zeros(0, np.uint64)]
    for instance in (bands.band(size), bands.band(size) + 1):
        # the union with a similar set is at most size / similarity
        most = min(bands.difference(instance), int((1 - bands.similarity) / bands.similarity * size))
        if most == 0:                         # only equal sets are similar
            continue
        seed = mix(np.array([2 * instance + 1, 2 * instance + 2], np.uint64))
        signed, least = _part_hashes(elements, held, bands.parts(instance), seed[0])
        first = np.lexsort((signed, least))[:most + 1]
        out.append(signed[first[least[first] > 1]])
        if len(signed) <= most:
            out.append(mix(mix(elements[held > 1] + seed[1]) ^ seed[1]))
    return np.unique(np.concatenate(out) & _MASK)


def _class(elements: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(elements.tobytes())[:_CLASS_BYTES]


def sketch(elements: np.ndarray) -> bytes:
    """A bit for each of a power of two of hash cells: whether the number of its elements is odd."""
    cells = 1 << min(max(9, (4 * len(elements)).bit_length()), _MAX_SKETCH_BITS)
    counts = np.bincount((elements & U(cells - 1)).astype(np.int64), minlength=cells)
    return np.packbits((counts & 1).astype(np.uint8)).tobytes()


def _folded(cells: np.ndarray, n: int) -> np.ndarray:
    """Sketches, one a row, as if they had been made with `n` times 64 cells."""
    return np.bitwise_xor.reduce(cells.reshape(len(cells), -1, n), axis=1)


def _least_difference(a: bytes, b: bytes) -> int:
    """No more than the number of elements that only one of two sets has."""
    x, y = np.frombuffer(a, np.uint64)[None], np.frombuffer(b, np.uint64)[None]
    n = min(x.size, y.size)
    return int(np.bitwise_count(_folded(x, n) ^ _folded(y, n)).sum())


def _possible(first: np.ndarray, second: np.ndarray, sizes: np.ndarray, sketches: list[bytes], similarity: Fraction) -> np.ndarray:
    """Which pairs (`first`, `second`) of sets are not ruled out by their sizes and sketches."""
    num, den = similarity.numerator, similarity.denominator
    kept = den * np.minimum(sizes[first], sizes[second]) >= num * np.maximum(sizes[first], sizes[second])
    lengths = np.array([len(x) // 8 for x in sketches], np.int64)
    place, cells = np.zeros(len(sketches), np.int64), {}
    for n in np.unique(lengths).tolist():
        at = np.flatnonzero(lengths == n)
        place[at] = np.arange(len(at))
        cells[n] = np.frombuffer(b"".join(sketches[i] for i in at), np.uint64).reshape(-1, n)
    at = np.flatnonzero(kept)
    both = np.column_stack([lengths[first[at]], lengths[second[at]]])
    for m, n in np.unique(both, axis=0).tolist():
        alike = at[(both == (m, n)).all(axis=1)]
        step = max(1, 500_000 // max(m, n))
        for i in range(0, len(alike), step):
            part = alike[i:i + step]
            a, b, least = first[part], second[part], min(m, n)
            differ = np.bitwise_count(_folded(cells[m][place[a]], least) ^ _folded(cells[n][place[b]], least)).sum(axis=1, dtype=np.int64)
            kept[part] = (den + num) * differ <= (den - num) * (sizes[a] + sizes[b])
    return kept


def _keys(sets: list[np.ndarray]) -> np.ndarray:
    """The hashes by which the elements of all sets are counted."""
    return np.concatenate([np.zeros(0, np.uint64), *sets]) >> U(64 - _KEY_BITS)


def _classes(texts: pa.ChunkedArray, words: int) -> tuple[list[bytes], dict[bytes, np.ndarray]]:
    """The class of each text, and the distinct sets by class."""
    names, sets = [], {}
    for t in texts:
        elements = shingles(t.as_py(), words)
        names.append(_class(elements))
        sets.setdefault(names[-1], elements)
    return names, sets


def _ask(table: pa.Table, words: int, buckets: int) -> pa.Table:
    """Per bucket the keys of a chunk, and how many of its sets hold each."""
    distinct, counts = np.unique(_keys(list(_classes(table["text"], words)[1].values())), return_counts=True)
    rows = [(bucket, squeeze_sorted(rest), squeeze(counts[at].astype(np.uint32))) for bucket, at, rest in by_bucket(distinct, buckets)]
    found = list(zip(*rows)) or [(), (), ()]
    return pa.table({"bucket": pa.array(found[0], pa.int32()), "chunk": pa.array([table["chunk"][0].as_py()] * len(rows), pa.int32()),
                     "keys": pa.array(found[1], pa.binary()), "counts": pa.array(found[2], pa.binary())})


def _levels(totals: np.ndarray) -> np.ndarray:
    """A byte that grows with a count: up to 100 the count, then ten steps each time it doubles."""
    return np.where(totals <= 100, totals, np.minimum(100 + 10 * np.log2(np.maximum(totals, 100) / 100), 255)).astype(np.uint8)


def _count(table: pa.Table) -> pa.Table:
    """The levels of the sums over all chunks, in the order in which each chunk asked."""
    asked = [expand_sorted(k, np.uint64) for k in table["keys"].to_pylist()]
    counts = np.concatenate([expand(c, np.uint32) for c in table["counts"].to_pylist()])
    keys = np.concatenate(asked)
    order = np.argsort(keys)
    ranked = keys[order]
    starts = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]]))
    levels = np.empty(len(keys), np.uint8)
    levels[order] = np.repeat(_levels(np.add.reduceat(counts[order].astype(np.int64), starts)), np.diff(np.append(starts, len(keys))))
    ends = np.cumsum([len(a) for a in asked])
    return pa.table({"bucket": table["bucket"], "chunk": table["chunk"],
                     "levels": pa.array([squeeze(x) for x in np.split(levels, ends[:-1])], pa.binary())})


def _sign(table: pa.Table, replies: pa.Table, words: int, bands: Bands, buckets: int) -> pa.Table:
    """Rows of two kinds, dealt over `bucket`: `_id`, `n_shingles`, `class` (96-bit hash of the
    set), `sketch` of each row; and the signatures of a chunk of texts that fall into the
    bucket, with their classes."""
    names, sets = _classes(table["text"], words)
    keys = _keys(list(sets.values()))
    order = np.argsort(keys)
    ranked = keys[order]
    starts = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]])) if len(keys) else np.zeros(0, np.int64)
    levels = np.zeros(len(starts), np.uint8)
    by = dict(zip(replies["bucket"].to_pylist(), replies["levels"].to_pylist()))
    for bucket, at, _ in by_bucket(ranked[starts], buckets):
        levels[at] = expand(by[bucket], np.uint8)
    held = np.empty(len(keys), np.int64)
    held[order] = np.repeat(levels, np.diff(np.append(starts, len(keys))))
    ends = np.cumsum([len(s) for s in sets.values()])
    signed = {name: signatures(s, bands, held=held[end - len(s):end]) for (name, s), end in zip(sets.items(), ends.tolist())}
    sketches = {name: sketch(s) for name, s in sets.items()}
    listed = [name for name, s in signed.items() if len(s)]
    owner = np.repeat(np.arange(len(listed), dtype=np.uint32), [len(signed[name]) for name in listed])
    packed = []
    for bucket, at, rest in by_bucket(np.concatenate([np.zeros(0, np.uint64), *(signed[name] for name in listed)]), buckets):
        used, local = np.unique(owner[at], return_inverse=True)
        packed.append((bucket, squeeze_sorted(rest), squeeze(local.astype(np.uint32)), b"".join(listed[i] for i in used)))
    n, more = len(names), len(packed)
    bucket, marks, owners, members = list(zip(*packed)) or [(), (), (), ()]

    def column(own: list, others: list, kind: pa.DataType) -> pa.Array:
        return pa.array([*own, *others], kind)

    none, blank = [None] * n, [None] * more
    ids = table["id"].combine_chunks()
    return pa.table({
        "_id": pa.concat_arrays([ids, pa.nulls(more, ids.type)]),
        "bucket": column((np.arange(n) % buckets).tolist(), bucket, pa.int32()),
        "n_shingles": column([len(sets[name]) for name in names], blank, pa.int64()),
        "class": column(names, blank, pa.binary()), "sketch": column([sketches[name] for name in names], blank, pa.binary()),
        "signatures": column(none, marks, pa.binary()), "owners": column(none, owners, pa.binary()), "classes": column(none, members, pa.binary())})


def _scan(df: DataFrame, id: str, text: str, words: int, bands: Bands, chunks: int, buckets: int) -> DataFrame:
    """The rows of `_sign` of all chunks."""
    placed = df.select(F.col(id).alias("id"), F.col(text).alias("text"), F.pmod(F.xxhash64(id, text), F.lit(chunks)).cast("int").alias("chunk"))
    kind = df.schema[id].dataType.simpleString()

    def ask(table: pa.Table) -> pa.Table:
        return _ask(table, words, buckets)

    def sign(key: tuple, table: pa.Table, replies: pa.Table) -> pa.Table:
        out = _sign(table, replies, words, bands, buckets)
        release()
        return out

    asked = placed.groupBy("chunk").applyInArrow(releasing_groups(ask), "bucket int, chunk int, keys binary, counts binary")
    counted = asked.groupBy("bucket").applyInArrow(releasing_groups(_count), "bucket int, chunk int, levels binary")
    return placed.groupBy("chunk").cogroup(counted.groupBy("chunk")).applyInArrow(
        sign, f"_id {kind}, bucket int, n_shingles bigint, class binary, sketch binary, signatures binary, owners binary, classes binary")


def scan(docs: DataFrame, id: str, text: str, words: int, bands: Bands) -> tuple[DataFrame, DataFrame]:
    """`id`, `n_shingles`, `class`, `sketch` per row; and the `group`s of classes that share a
    signature, see `_shared`."""
    size = docs.agg(F.sum(F.octet_length(F.col(text)))).first()[0] or 0
    spread = 4 * docs.sparkSession.sparkContext.defaultParallelism
    # a word and the space behind it are rarely less than four bytes
    buckets = max(spread, -(-size // (4 * _ENTRIES_PER_BUCKET)))
    found = _scan(docs, id, text, words, bands, max(spread, -(-size // _BYTES_PER_CHUNK)), buckets)

    def join(table: pa.Table) -> pa.Table:
        signed = table.filter(pc.is_valid(table["signatures"]))
        rows = table.filter(pc.is_null(table["signatures"])).select(["_id", "n_shingles", "class", "sketch"])
        rows = rows.append_column("group", pa.nulls(len(rows), pa.int64())).append_column("center", pa.nulls(len(rows), pa.binary()))
        if not len(signed):
            return rows
        groups = _shared(signed)
        for name in ("_id", "n_shingles", "sketch"):
            groups = groups.append_column(name, pa.nulls(len(groups), rows.schema.field(name).type))
        return pa.concat_tables([rows, groups.select(rows.column_names)])

    kind = docs.schema[id].dataType.simpleString()
    both = cut_lineage(found.repartition(buckets, "bucket").groupBy("bucket").applyInArrow(
        releasing_groups(join), f"_id {kind}, n_shingles bigint, class binary, sketch binary, group bigint, center binary"))
    return (both.where(F.col("group").isNull()).select(F.col("_id").alias(id), "n_shingles", "class", "sketch"),
            both.where(F.col("group").isNotNull()).select("group", "center", "class"))


def _shared(table: pa.Table) -> pa.Table:
    """`group` (a hash of its members), `center` and `class` for each distinct group of classes
    that share a signature.

    The center is the member that shares most signatures in the bucket; of equal ones that
    with the smallest name. Of many copies of a text, each changed elsewhere, only the text
    itself is near to all; it shares its signature in every part, and a copy in those parts
    that it left alone. So centers are few and near to many.
    """
    signed, member, names = [], [], {}
    for row in table.to_pylist():
        listed = row["classes"]
        numbers = np.array([names.setdefault(listed[i:i + _CLASS_BYTES], len(names)) for i in range(0, len(listed), _CLASS_BYTES)], np.int64)
        signed.append(expand_sorted(row["signatures"], np.uint64))
        member.append(numbers[expand(row["owners"], np.uint32)])
    signed, member = np.concatenate(signed), np.concatenate(member)
    order = np.argsort(signed, kind="stable")
    signed, member = signed[order], member[order]
    same = signed[1:] == signed[:-1]
    held = np.zeros(len(signed), bool)             # most signatures have one owner
    held[1:] |= same
    held[:-1] |= same
    signed, member = signed[held], member[held]
    order = np.lexsort((member, signed))
    signed, member = signed[order], member[order]
    fresh = np.ones(len(signed), bool)             # the same class of another chunk counts once
    fresh[1:] = (signed[1:] != signed[:-1]) | (member[1:] != member[:-1])
    signed, member = signed[fresh], member[fresh]
    starts = np.flatnonzero(np.concatenate([[True], signed[1:] != signed[:-1]])) if len(signed) else np.zeros(0, np.int64)
    sizes = np.diff(np.append(starts, len(signed)))
    keys = np.frombuffer(b"".join(names), np.uint8).reshape(-1, _CLASS_BYTES)[:, :8].copy().view(np.uint64).ravel()
    shares = np.bincount(member, np.repeat((sizes > 1).astype(float), sizes), len(names))
    prints = np.add.reduceat(mix(keys[member]), starts) if len(starts) else np.zeros(0, np.uint64)
    several = np.flatnonzero(sizes > 1)
    several = several[np.unique(prints[several], return_index=True)[1]]
    sizes = sizes[several]
    ends = np.cumsum(sizes)
    group = np.repeat(np.arange(len(several)), sizes)
    listed = member[np.repeat(starts[several], sizes) + np.arange(len(group)) - np.repeat(ends - sizes, sizes)]
    best = np.lexsort((keys[listed], -shares[listed], group))
    center = listed[best[ends - sizes]] if len(several) else listed
    named = pa.array(list(names), pa.binary())
    return pa.table({"group": np.repeat(mix(prints[several] + sizes.astype(np.uint64)).view(np.int64), sizes),
                     "center": named.take(pa.array(np.repeat(center, sizes))), "class": named.take(pa.array(listed))})


def _pairs_inside(groups: DataFrame, similarity: Fraction) -> DataFrame:
    """`a` < `b`, distinct: classes of different labels that are in one group of `groups`
    (`group`, `class`, `label`, `n_shingles`, `sketch`), where sizes and sketches do not rule out
    that they are similar. Groups are small and dealt over buckets; a bucket looks at a
    pair once, however many of its groups hold both."""
    buckets = max(4 * groups.sparkSession.sparkContext.defaultParallelism, -(-groups.count() // _MEMBERS_PER_BUCKET))

    def pairs(table: pa.Table) -> pa.Table:
        listed, member, sizes, sketches = _members(table)
        label = table["label"].combine_chunks().dictionary_encode().indices.to_numpy()
        order = np.lexsort((member, table["group"].to_numpy()))
        group, member, label = table["group"].to_numpy()[order], member[order], label[order]
        starts = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
        lengths = np.diff(np.append(starts, len(group)))
        found = np.zeros(0, np.int64)
        waiting, held = [], 0
        for size in np.unique(lengths):
            first, second = np.triu_indices(size, 1)
            alike = starts[lengths == size]
            step = max(1, _PAIRS_AT_ONCE // max(len(first), 1))
            for at in range(0, len(alike), step):
                places = alike[at:at + step, None] + np.arange(size)
                m, n = member[places], label[places]
                apart = n[:, first] != n[:, second]
                waiting.append(np.unique(m[:, first][apart] * len(listed) + m[:, second][apart]))
                held += len(waiting[-1])
                if held > _PAIRS_AT_ONCE:
                    found, waiting, held = np.unique(np.concatenate([found, *waiting])), [], 0
        found = np.unique(np.concatenate([found, *waiting]))
        a, b = found // len(listed), found % len(listed)
        return _named(listed, a, b, _possible(a, b, sizes, sketches, similarity))

    return (groups.withColumn("bucket", F.pmod(F.xxhash64("group"), F.lit(buckets)).cast("int")).repartition(buckets, "bucket")
            .groupBy("bucket").applyInArrow(releasing_groups(pairs), "a binary, b binary").distinct())


def _members(table: pa.Table) -> tuple[list[bytes], np.ndarray, np.ndarray, list[bytes]]:
    """The distinct classes of a table in order; the number of each row's class among them; sizes
    and sketches of the classes."""
    names = table["class"].combine_chunks().dictionary_encode()
    listed, codes = names.dictionary.to_pylist(), names.indices.to_numpy()
    ranked = np.array(sorted(range(len(listed)), key=listed.__getitem__), np.int64)
    rank = np.empty(len(listed), np.int64)
    rank[ranked] = np.arange(len(listed))
    row = np.empty(len(listed), np.int64)
    row[rank[codes]] = np.arange(len(codes))
    return ([listed[i] for i in ranked], rank[codes], table["n_shingles"].to_numpy()[row],
            table["sketch"].combine_chunks().take(pa.array(row)).to_pylist())


def _named(listed: list[bytes], a: np.ndarray, b: np.ndarray, kept: np.ndarray) -> pa.Table:
    names = pa.array(listed, pa.binary())
    return pa.table({"a": names.take(pa.array(a[kept])), "b": names.take(pa.array(b[kept]))})


def _pairs_across(clusters: DataFrame, similarity: Fraction) -> DataFrame:
    """The same as `_pairs_inside` for clusters of any size (`cluster`, `class`, `label`, `n_shingles`,
    `sketch`; a class once a cluster). Members are dealt over blocks, and each pair of blocks is a task
    of its own, so no task holds a whole cluster; what travels is a member once per block."""
    counted = clusters.groupBy("cluster").agg(F.count(F.lit(1)).alias("n")).select("cluster", F.greatest(
        F.ceil(F.col("n") / _BLOCK), F.least(F.lit(16), F.ceil(F.col("n") / _LEAST_BLOCK))).cast("int").alias("blocks"))
    dealt = (clusters.join(counted.hint("merge"), "cluster").withColumn("own", F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("cluster", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "own",
                     "class", "label", "n_shingles", "sketch"))

    def pairs(table: pa.Table) -> pa.Table:
        listed, member, sizes, sketches = _members(table)
        label = np.empty(len(listed), np.int64)
        label[member] = table["label"].combine_chunks().dictionary_encode().indices.to_numpy()
        upper = np.empty(len(listed), bool)
        upper[member] = table["own"].to_numpy() == table["high"].to_numpy()
        inside = table["low"][0] == table["high"][0]
        right = np.flatnonzero(upper)
        left = right if inside else np.flatnonzero(~upper)
        out, step = [np.zeros((0, 2), np.int64)], max(1, _PAIRS_AT_ONCE // max(len(right), 1))
        for at in range(0, len(left), step):
            first, second = (x.ravel() for x in np.meshgrid(left[at:at + step], right, indexing="ij"))
            first, second = np.minimum(first, second), np.maximum(first, second)
            apart = label[first] != label[second]
            if inside:
                apart &= np.repeat(left[at:at + step], len(right)) == first      # each pair once
            first, second = first[apart], second[apart]
            kept = _possible(first, second, sizes, sketches, similarity)
            out.append(np.column_stack([first[kept], second[kept]]))
        found = np.concatenate(out)
        return _named(listed, found[:, 0], found[:, 1], np.ones(len(found), bool))

    return dealt.groupBy("cluster", "low", "high").applyInArrow(releasing_groups(pairs), "a binary, b binary").distinct()


def _compact(elements: np.ndarray) -> bytes:
    """A set for comparing: the upper 48 bits of its hashes. Two of its shingles, or of another
    set's, share these bits with a chance of one in 10**14 a pair."""
    return squeeze_sorted(elements >> U(16))


def _sets(docs: DataFrame, edges: DataFrame, classes: DataFrame, id: str, text: str, words: int) -> DataFrame:
    """`a`, `salt`, `b`, `elements`: of each edge (`a`, `b`) the whole set of `b`, and of each
    `a`, in rows without `b`, its own set, once per salt.

    The edges of an `a` are dealt over salts by their number, so one that a third of all
    classes meet does not end in one task. A set is made from the text of one row that has the
    class, where that text is read; a class that only rows without an id have is found by
    hashing those rows again."""
    salts = edges.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / _EDGES_PER_SALT).cast("int").alias("salts"))
    ends = edges.join(salts.hint("merge"), "a").select(
        F.col("b").alias("class"), F.col("a").alias("other"), F.pmod(F.xxhash64("b"), F.col("salts")).cast("int").alias("salt"))
    own = salts.select(F.col("a").alias("class"), F.lit(None).cast("binary").alias("other"),
                       F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"))
    uses = ends.unionByName(own).groupBy("class").agg(F.collect_list(F.struct("other", "salt")).alias("uses"))
    wanted = _small(uses.join(classes.select("class", id).hint("merge"), "class"))
    schema = pa.schema([("a", pa.binary()), ("salt", pa.int32()), ("b", pa.binary()), ("elements", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, t, uses in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                elements = shingles(t.as_py(), words)
                if _class(elements) == name:           # not another text that shares the id
                    held = _compact(elements)
                    yield from in_batches([(u["other"] or name, u["salt"], u["other"] and name, held) for u in uses.as_py()], schema)

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = {_class(e): _compact(e) for t in batch.column(0) if len(e := shingles(t.as_py(), words))}
            yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.binary()), pa.array(list(found.values()), pa.binary())],
                                             ["class", "elements"])

    kinds = "a binary, salt int, b binary, elements binary"
    texts = docs.select(id, F.col(text).alias("_text")).join(wanted, id).select("class", "_text", "uses")
    found = texts.mapInArrow(releasing(run), kinds)
    nameless = wanted.where(F.col(id).isNull()).select("class", F.explode("uses").alias("u"))
    again = docs.where(F.col(id).isNull()).select(text).mapInArrow(releasing(named), "class binary, elements binary")
    return found.unionByName(again.join(nameless, "class").select(
        F.coalesce("u.other", "class").alias("a"), "u.salt", F.when(F.col("u.other").isNotNull(), F.col("class")).alias("b"), "elements"))


def _near_enough(edges: DataFrame, classes: DataFrame, similarity: Fraction) -> DataFrame:
    """The edges (`a`, `b`) whose sizes and sketches do not rule out that they are similar."""
    num, den = similarity.numerator, similarity.denominator

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            for m, n, x, y in zip(*(batch.column(i).to_pylist() for i in range(2, 6))):
                kept.append(den * min(m, n) >= num * max(m, n)
                            and (den + num) * _least_difference(x, y) <= (den - num) * (m + n))
            yield batch.filter(pa.array(kept, pa.bool_())).select(["a", "b"])

    def side(name: str, n: str, x: str) -> DataFrame:
        return classes.select(F.col("class").alias(name), F.col("n_shingles").alias(n), F.col("sketch").alias(x))

    # there are few centers, so mostly their sketches can go to the edges
    centers = cut_lineage(side("a", "m", "x").join(edges.select("a").distinct(), "a", "left_semi"))
    held = centers.agg(F.coalesce(F.sum(F.length("x") + 40), F.lit(0))).first()[0]
    centers = F.broadcast(centers) if held <= _MAX_SKETCH_BYTES else centers
    return (edges.join(side("b", "n", "y").hint("merge"), "b").join(centers, "a").select("a", "b", "m", "n", "x", "y")
            .mapInArrow(releasing(run), "a binary, b binary"))


def _links(docs: DataFrame, edges: DataFrame, classes: DataFrame, id: str, text: str, words: int,
           similarity: Fraction) -> DataFrame:
    """The edges (`a`, `b`) whose sets are similar. Sets travel once, to the edge's `a`."""
    num, den = similarity.numerator, similarity.denominator

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, known = None, np.zeros(0, np.uint64)
        for batch in batches:
            kept = []
            for a, b, elements in zip(batch.column(0), batch.column(1), batch.column(2)):
                other = expand_sorted(elements.as_py(), np.uint64)
                if not b.is_valid:
                    name, known = a.as_py(), other     # the set of `a` comes before those of its edges
                    kept.append(False)
                else:
                    assert a.as_py() == name
                    both = len(np.intersect1d(known, other, assume_unique=True))
                    kept.append(den * both >= num * (len(known) + len(other) - both))
            yield batch.filter(pa.array(kept, pa.bool_())).select(["a", "b"])

    sets = _sets(docs, edges, classes, id, text, words)
    return (sets.repartition("a", "salt").sortWithinPartitions("a", "salt", F.asc_nulls_first("b"))
            .select("a", "b", "elements").mapInArrow(releasing(run), "a binary, b binary").distinct())


def components(links: DataFrame) -> DataFrame:
    """`node`, `label` for every end of the links (`a`, `b`): the least node it is connected to.

    Each round takes the least label among the neighbours and then the label of that label,
    so a path of length n needs about log n rounds.
    """
    both = cut_lineage(links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = cut_lineage(both.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("label")))
    while True:
        # merge joins: a broadcast in every round would pass through the driver
        seen = both.join(labels.withColumnRenamed("node", "b").hint("merge"), "b").groupBy(F.col("a").alias("node")).agg(
            F.min("label").alias("near"))
        nearer = labels.join(seen.hint("merge"), "node").select(
            "node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        jumped = nearer.join(labels.select(F.col("node").alias("label"), F.col("label").alias("far")).hint("merge"), "label", "left")
        fresh = cut_lineage(jumped.select("node", "old", F.least("label", F.coalesce("far", "label")).alias("label")))
        labels = fresh.select("node", "label")
        if fresh.where(F.col("old") != F.col("label")).isEmpty():
            return labels


def _verified(docs: DataFrame, edges: DataFrame, classes: DataFrame, id: str, text: str, words: int,
              similarity: Fraction) -> DataFrame:
    """Those of the distinct edges (`a`, `b`) that are links."""
    edges = cut_lineage(_near_enough(edges, classes, similarity))
    return cut_lineage(_links(docs, edges, classes, id, text, words, similarity))


def _labelled(df: DataFrame, labels: DataFrame, column: str, name: str) -> DataFrame:
    """`df` with the label of the class in `column`, the class itself if it has none."""
    known = labels.select(F.col("node").alias(column), F.col("label").alias(name))
    return df.join(known.hint("merge"), column, "left").withColumn(name, F.coalesce(name, column))


def linked_classes(docs: DataFrame, described: DataFrame, groups: DataFrame, id: str, text: str, words: int,
                   similarity: Fraction) -> DataFrame:
    """`node`, `label`: the classes that are linked with another, and their component.

    First every class is compared with the centers of its groups. A group whose members are all
    in the component of its center is done. In the rest, members of different components are
    compared.
    """
    classes = cut_lineage(described.groupBy("class").agg(F.min(id).alias(id), F.first("n_shingles").alias("n_shingles"),
                                                         F.first("sketch").alias("sketch")))
    star = cut_lineage(groups.where(F.col("class") != F.col("center")).select(F.col("center").alias("a"), F.col("class").alias("b")).distinct())

    def verified(edges: DataFrame) -> DataFrame:
        return _verified(docs, edges.select("a", "b"), classes, id, text, words, similarity)

    links = verified(star)
    labels = components(links)
    apart = cut_lineage(_labelled(_labelled(star, labels, "a", "a_label"), labels, "b", "b_label")
                        .where(F.col("a_label") != F.col("b_label")).select("a", "b"))
    open_groups = groups.join(_small(apart.select(F.col("a").alias("center"), F.col("b").alias("class"))), ["center", "class"],
                              "left_semi").select("group").distinct()
    groups = cut_lineage(groups.join(_small(open_groups), "group", "left_semi").select("group", "class").distinct())
    labelled = _labelled(groups, labels, "class", "label")
    facts = labelled.groupBy("group").agg(F.count(F.lit(1)).alias("n"), F.min("label").alias("low"), F.max("label").alias("high"))
    facts = cut_lineage(facts.where(F.col("low") != F.col("high")).select("group", "n"))
    kinds = classes.select("class", "n_shingles", "sketch").hint("merge")
    small = cut_lineage(labelled.join(facts.where(F.col("n") <= _SMALL_GROUP), "group", "left_semi").join(kinds, "class"))
    # large groups of one text are many, with nearly the same members, most of them linked
    large = cut_lineage(labelled.join(facts.where(F.col("n") > _SMALL_GROUP), "group", "left_semi"))
    most = large.groupBy("group", "label").agg(F.count(F.lit(1)).alias("n"))
    whole = most.groupBy("group").agg(F.max(F.struct("n", "label")).alias("m")).select("group", F.col("m.label").alias("cluster"))
    clusters = cut_lineage(large.join(whole, "group").select("cluster", "class", "label").distinct().join(kinds, "class"))
    found = verified(_pairs_inside(small, similarity).unionByName(_pairs_across(clusters, similarity)).distinct())
    return labels if found.isEmpty() else components(cut_lineage(links.unionByName(found)))


def near_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text", words: int = 5,
                    similarity: Fraction = Fraction(3, 4)) -> DataFrame:
    """`id`, `n_shingles`, `component_id` per row of `docs`.

    Rows link when the Jaccard similarity of their sets of `words`-word shingles reaches
    `similarity`; `component_id` is the smallest id reachable by links. A row without words
    has no shingles and links with nothing; rows with equal sets are linked. Among rows that
    repeat an id each has the component of its own text. Null ids have no order: a component
    of null ids only is null. An empty table gives no rows.
    """
    described, classes = _grouped(docs, id, text, words, similarity)
    least = classes.groupBy("label").agg(F.min("first").alias("component_id"))
    named = classes.select("class", "label").join(least, "label").select("class", "component_id")
    placed = described.where(F.col("n_shingles") > 0).join(named, "class").select(id, "n_shingles", "component_id")
    alone = described.where(F.col("n_shingles") == 0).select(id, "n_shingles", F.col(id).alias("component_id"))
    return placed.unionByName(alone)


def _grouped(docs: DataFrame, id: str, text: str, words: int, similarity: Fraction) -> tuple[DataFrame, DataFrame]:
    """What `scan` says of all rows, and per class `first` (its smallest id) and `label` (its component)."""
    described, groups = scan(docs, id, text, words, Bands(similarity))
    some = described.where(F.col("n_shingles") > 0)
    labels = linked_classes(docs, some, groups, id, text, words, similarity)
    classes = (some.groupBy("class").agg(F.min(id).alias("first"))
               .join(labels.withColumnRenamed("node", "class"), "class", "left")
               .withColumn("label", F.coalesce("label", "class")))
    return described, cut_lineage(classes)


def _small(df: DataFrame) -> DataFrame:
    """The frame, to be broadcast if a count shows that it is small; some tens of bytes a row."""
    df = cut_lineage(df)
    return F.broadcast(df) if df.count() <= _MAX_BROADCAST else df


def keep_one(docs: DataFrame, id: str = "doc_id", text: str = "text", words: int = 5,
             similarity: Fraction = Fraction(3, 4)) -> DataFrame:
    """`docs` with one row of each component of near duplicates, columns as they were.

    It is the row with the smallest id (null ids come last), then the smallest class. Rows are
    told apart by their id and their set of shingles, so a row stays or goes for its own text
    even where ids repeat or are null; of rows alike in both, one stays. Rows without words
    link with nothing and all stay, repeated ones too. Rows whose id no other row has, nearly
    all, are decided by the id; the texts of the others are hashed again.
    """
    described, classes = _grouped(docs, id, text, words, similarity)
    members = described.where(F.col("n_shingles") > 0).join(classes.select("class", "label"), "class").select(
        F.struct(F.col(id).isNull().alias("nameless"), F.col(id).alias("id"), "class").alias("m"), "label")
    chosen = members.groupBy("label").agg(F.min("m").alias("chosen"))
    # a component of one row loses nothing, so only its larger ones are joined
    gone = (members.join(chosen, "label").where(F.col("m") != F.col("chosen"))
            .select("m.nameless", F.col("m.id").alias("_gone"), F.col("m.class").alias("_class")).distinct())
    gone = cut_lineage(gone)
    several = described.groupBy(id).agg(F.count(F.lit(1)).alias("n")).where((F.col("n") > 1) | F.col(id).isNull())
    several = _small(several.select(F.col(id).alias("_several"), F.col(id).isNull().alias("_nameless")))
    repeated = F.col(id) == F.col("_several")
    once = docs.where(F.col(id).isNotNull()).join(several.where(~F.col("_nameless")), repeated, "left_anti")
    once = once.join(_small(gone.where(~F.col("nameless")).select("_gone").distinct()), F.col(id) == F.col("_gone"), "left_anti")
    again = docs.where(F.col(id).isNotNull()).join(several.where(~F.col("_nameless")), repeated, "left_semi").unionByName(
        docs.where(F.col(id).isNull()))

    def classed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingles(t.as_py(), words) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([_class(s) if len(s) else None for s in sets], pa.binary())],
                ["row", "id", "class"])

    packed = again.select(F.struct(*docs.columns).alias("row"), F.col(id).alias("id"), F.col(text).alias("text"))
    kind = docs.schema[id].dataType.simpleString()
    found = packed.mapInArrow(releasing(classed), f"row {packed.schema['row'].dataType.simpleString()}, id {kind}, class binary")
    lost = (F.col("class") == F.col("_class")) & F.col("id").eqNullSafe(F.col("_gone"))
    stays = found.join(gone, lost, "left_anti")
    worded = (stays.where(F.col("class").isNotNull()).groupBy("id", "class")
              .agg(F.min_by("row", F.xxhash64("row")).alias("row")).select("row.*"))
    return once.unionByName(stays.where(F.col("class").isNull()).select("row.*")).unionByName(worded)

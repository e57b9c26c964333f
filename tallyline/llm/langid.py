"""Language identification by nearest centroid.

A text is a normalised TF-IDF vector of hashed character n-grams (one to three letters,
with word boundaries). Each language has several centroids, found by spherical k-means on a
bounded sample of its labelled texts, so that a language with several kinds of text is not
one blur. A text gets the language of the centroid with the highest cosine, and is rejected
if even that one is too far away. How far is too far depends on the language and on the
length of the text: a short text has few n-grams and so a low cosine. Both come from the
cosines of the labelled sample, each half of it measured with centroids of the other half.

Document frequencies are counted over all training rows. Only the sample that the centroids
are fitted on is bounded: `sample_rows` per language, those with the lowest hash of the id.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyline.llm.packed import release, releasing, releasing_groups

_BITS = 14
_SIZE = 1 << _BITS
_LENGTHS = 40          # powers of two of the number of n-grams of a text
# Which cosine of the known texts of about a length, and which share of it, a text must reach.
# Known texts that mostly hold a licence line or the like are far at any length, so no floor is above the ceiling.
_QUANTILE, _SHARE, _CEILING = 0.01, 0.6, 0.2
_MIX = (np.uint32(0x9E3779B1), np.uint32(0x85EBCA77), np.uint32(0xC2B2AE3D))


def _letter_table() -> np.ndarray:
    """Code point -> lower-case letter, 0 for anything that is not a letter."""
    table = np.zeros(0x110000, np.uint32)
    for c in range(0x32400):                        # letters end before it
        if 0xD800 <= c < 0xE000:
            continue
        letter = chr(c)
        if letter.isalpha():
            lower = letter.lower()
            table[c] = ord(lower[0])
    return table


_LETTERS: np.ndarray | None = None
_PIECE = 1 << 20


def grams(text: str | None) -> tuple[np.ndarray, np.ndarray] | None:
    """Hashed n-grams that occur and how often; None without a letter.

    Works on pieces of bounded size that overlap by two letters, so a long text needs no
    more memory than a piece.
    """
    global _LETTERS
    if not text:
        return None
    if _LETTERS is None:
        _LETTERS = _letter_table()
    counts = np.zeros(_SIZE, np.int64)
    before = np.zeros(1, np.uint32)
    seen = False
    for at in range(0, len(text), _PIECE):
        points = np.frombuffer(text[at:at + _PIECE].encode("utf-32-le", "replace"), np.uint32)
        here = _LETTERS[points]
        last = at + _PIECE >= len(text)
        letters = np.concatenate([before, here, np.zeros(1, np.uint32)] if last else [before, here])
        # One boundary between words, however many other characters stand there.
        keep = np.ones(len(letters), bool)
        keep[1:] = (letters[1:] != 0) | (letters[:-1] != 0)
        letters = letters[keep]
        seen = seen or bool(here.any())
        new = max(len(before) - 1, 0)              # pairs and triples inside `before` are counted already
        one = letters * _MIX[0]
        two = (one[:-1] ^ (letters[1:] + np.uint32(1))) * _MIX[1]
        three = (two[:-1] ^ (letters[2:] + np.uint32(3))) * _MIX[2]
        inside = letters[len(before):] if at else letters[1:]
        for hashed in ((inside[inside != 0] * _MIX[0]), two[new:], three[max(new - 1, 0):]):
            counts += np.bincount(hashed >> np.uint32(32 - _BITS), minlength=_SIZE)
        before = letters[-2:]
    if not seen:
        return None
    at = np.flatnonzero(counts)
    return at, counts[at]


@dataclass
class Model:
    """What a prediction needs: a few dozen centroids over a fixed number of hashed n-grams."""

    idf: np.ndarray                # (_SIZE,)
    centroids: np.ndarray          # (_SIZE, number of centroids)
    languages: list[str]           # of each centroid
    floors: np.ndarray | None = None    # (number of centroids, _LENGTHS): least cosine of a text that is not rejected

    def vector(self, text: str | None) -> tuple[np.ndarray, np.ndarray] | None:
        found = grams(text)
        if found is None:
            return None
        return found[0], self._unit(*found)

    def _unit(self, at: np.ndarray, counts: np.ndarray) -> np.ndarray:
        weights = (1 + np.log(counts)) * self.idf[at]
        norm = np.sqrt((weights**2).sum())
        return weights / norm if norm else weights

    def nearest(self, text: str | None) -> tuple[str | None, float, float]:
        """(language, cosine, least cosine to be accepted); (None, 0, 0) without a letter. Of equal
        cosines the first centroid."""
        found = grams(text)
        if found is None or not self.languages:
            return None, 0.0, 0.0
        at, counts = found
        cosines = self._unit(at, counts) @ self.centroids[at]
        best = int(np.argmax(cosines))
        floor = float(self.floors[best, length_class(counts)]) if self.floors is not None else 0.0
        return self.languages[best], float(min(1.0, max(0.0, cosines[best]))), floor


def length_class(counts: np.ndarray) -> int:
    """Power of two of the number of n-grams of a text."""
    return min(_LENGTHS - 1, int(counts.sum()).bit_length() - 1)


def floors(lengths: np.ndarray, cosines: np.ndarray, fewest: int = 20) -> np.ndarray:
    """Least accepted cosine per length class, from the length classes and cosines of known texts.

    A class takes a low quantile over the nearest `fewest` texts by length, or all of its own
    and its two neighbours if they are more. It never exceeds that of a longer class. Below the
    shortest known text it falls with the root of the length, as a cosine of few n-grams does.
    """
    out = np.zeros(_LENGTHS)
    if not len(lengths):
        return out
    for k in range(_LENGTHS):
        away = np.abs(lengths - k)
        reach = max(1, np.sort(away)[min(fewest, len(away)) - 1])
        # Texts that are longer than the class have higher cosines: only what is needed of them counts.
        out[k] = np.quantile(cosines[away <= reach], _QUANTILE, method="lower") * _SHARE
    out = np.minimum(out, _CEILING)
    out = np.minimum.accumulate(out[::-1])[::-1]
    short = int(lengths.min())
    out[:short] = out[short] * np.sqrt(2.0) ** (np.arange(short) - short)
    return out


def spherical_means(rows: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """At most k unit centroids of unit rows. Starts are spread out greedily, so it is deterministic."""
    starts = [int(np.argmax(rows @ rows.mean(axis=0)))]
    nearest = rows @ rows[starts[0]]
    while len(starts) < min(k, len(rows)):
        far = int(np.argmin(nearest))
        if nearest[far] > 1 - 1e-6:                # only copies are left
            break
        starts.append(far)
        nearest = np.maximum(nearest, rows @ rows[far])
    centers = rows[starts].copy()
    for _ in range(rounds):
        owner = np.argmax(rows @ centers.T, axis=1)
        for c in range(len(centers)):
            if (owner == c).any():
                mean = rows[owner == c].mean(axis=0)
                centers[c] = mean / max(np.linalg.norm(mean), 1e-12)
    return centers


def fit(training: DataFrame, id: str = "doc_id", text: str = "text", lang: str = "lang",
        centroids: int = 4, sample_rows: int = 200) -> Model:
    """Fit on rows with a label; rows with a null label or no letter teach nothing.

    The driver receives the document frequencies (a fixed number) and the centroids
    (`centroids` per language). No training row gives a model that knows no language.
    """
    known = training.where(F.col(lang).isNotNull()).select(
        F.col(id).alias("id"), F.col(text).alias("text"), F.col(lang).alias("lang"))

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, rows = np.zeros(_SIZE, np.int64), 0
        for batch in batches:
            for t in batch.column(0):
                found = grams(t.as_py())
                if found is not None:
                    total[found[0]] += 1
                    rows += 1
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(at, -1), pa.int32()), pa.array(np.append(total[at], rows), pa.int64())], ["at", "n"])

    counted = (known.select("text").mapInArrow(releasing(frequencies), "at int, n bigint")
               .groupBy("at").agg(F.sum("n").alias("n")).toPandas())
    rows = int(counted.loc[counted["at"] == -1, "n"].sum())
    df = np.zeros(_SIZE)
    terms = counted[counted["at"] >= 0]
    df[terms["at"]] = terms["n"]
    idf = np.log((1 + rows) / (1 + df)) + 1

    order = Window.partitionBy("lang").orderBy(F.xxhash64(F.col("id").cast("string")), "id")
    usable = known.where(F.col("text").rlike(r"\p{L}"))
    picked = (usable.select("id", "lang").withColumn("at", F.row_number().over(order))
              .where(F.col("at") <= sample_rows).select("id", "lang"))
    # At most `sample_rows` ids per language.
    sample = usable.join(F.broadcast(picked.distinct()), ["id", "lang"], "left_semi")

    def cluster(group: pd.DataFrame) -> pd.DataFrame:
        model = Model(idf, np.zeros((_SIZE, 0)), [])
        group = group.sort_values(["id", "text"], kind="stable").head(sample_rows)
        found = [g for g in map(grams, group["text"]) if g is not None]
        dense = np.zeros((len(found), _SIZE), np.float32)
        for row, (at, counts) in enumerate(found):
            dense[row, at] = model._unit(at, counts)
        centers = spherical_means(dense, centroids) if len(dense) else dense
        cosines = np.zeros(len(dense))
        for half in (0, 1):
            if len(dense) > 1:
                others = spherical_means(dense[1 - half::2], centroids)
                cosines[half::2] = (dense[half::2] @ others.T).max(axis=1)
        least = floors(np.array([length_class(counts) for _, counts in found], int), cosines)
        return pd.DataFrame({"lang": [group["lang"].iloc[0]] * len(centers), "part": range(len(centers)),
                             "center": [c.astype("<f4").tobytes() for c in centers],
                             "least": [least.tolist()] * len(centers)})

    fitted = sample.groupBy("lang").applyInPandas(releasing_groups(cluster), "lang string, part int, center binary, least array<double>").collect()
    fitted = sorted(fitted, key=lambda r: (r["lang"], r["part"]))
    centers = [np.frombuffer(r["center"], "<f4") for r in fitted]
    matrix = np.stack(centers, axis=1).astype(np.float64) if centers else np.zeros((_SIZE, 0))
    least = np.array([r["least"] for r in fitted]) if fitted else np.zeros((0, _LENGTHS))
    return Model(idf, matrix, [r["lang"] for r in fitted], least)


def predict(df: DataFrame, model: Model, text: str = "text", min_score: float = 0.05) -> DataFrame:
    """`df` with `lang_pred`, `score` (cosine, 0 to 1) and `rejected`. Its other columns stay
    (one of these three names is replaced).

    A null text, or one without a letter, is `und` with score 0 and rejected. A text further
    from every centroid than the fitted floor of its nearest language and its length, or than
    cosine `min_score`, keeps its nearest language and is rejected.
    """
    spark = df.sparkSession
    shared = spark.sparkContext.broadcast(model)    # a fixed number of values per centroid

    @F.pandas_udf("lang_pred string, score double, far boolean")
    def nearest(texts: pd.Series) -> pd.DataFrame:
        found = [shared.value.nearest(t) for t in texts]
        release()
        return pd.DataFrame({"lang_pred": [lang if lang is not None else "und" for lang, _, _ in found],
                             "score": [score for _, score, _ in found],
                             "far": [score < max(floor, min_score) for _, score, floor in found]})

    name = "_near"
    while name in df.columns:
        name += "_"
    found = df.withColumn(name, nearest(F.col(text)))
    near = F.col(name)
    return found.withColumns({
        "lang_pred": near["lang_pred"], "score": near["score"],
        "rejected": (near["lang_pred"] == "und") | near["far"]}).drop(name)


def held_out(id: str = "doc_id", folds: int = 4, fold: int = 2) -> Column:
    """Whether a row is kept out of training: by the checksum of its id as text."""
    return F.coalesce(F.crc32(F.col(id).cast("string")) % folds == fold, F.lit(False))

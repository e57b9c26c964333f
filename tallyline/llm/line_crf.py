"""Quality rules over whole texts: a linear-chain conditional random field labels lines.

Each line with a word is content or boilerplate. Its features are yes-no questions about the
characters, words and repetitions of the line; none names a word, so none depends on a
language. The chain adds a weight per pair of neighbouring labels. Viterbi decoding gives
the labels of a text, and the share of its words that lie in content lines decides whether
it is kept.

Documents are labelled, lines are not. So the field is fitted in turns: at first every line
has the label of its document, and the field is fitted without the chain, which would only
learn that the lines of a document agree; then, in documents of poor quality, the lines that
the field itself takes for content become content, except that the worst line of each stays
boilerplate; then the whole field is fitted, and once more after such a change. It learns from a bounded sample of labelled
documents; everything else runs over all rows, each by itself, with no shuffle.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

_SPACE, _LOWER, _UPPER, _DIGIT, _SYMBOL, _STOP, _PUNCTUATION, _OTHER, _LETTER, _REST = range(10)
SYMBOLS = b"#*$%&|<>"
WINDOW = 8                                          # words of a window that may repeat
_PIECE = 1 << 20                                    # bytes counted at once
_SHARES = (0.02, 0.08, 0.2, 0.4, 0.7)               # a share is coded by the bounds it exceeds
_WORDS = (1, 3, 7, 15, 40)
_WORD_LENGTHS = (2.5, 3.5, 5.0, 7.0, 10.0)


def _byte_classes() -> np.ndarray:
    """Class of each byte; bytes after the first of a character are `_REST`."""
    table = np.full(256, _OTHER, np.uint8)
    for kind, members in ((_SPACE, b" \t\n\v\f\r"), (_LOWER, bytes(range(97, 123))), (_UPPER, bytes(range(65, 91))),
                          (_DIGIT, bytes(range(48, 58))), (_SYMBOL, SYMBOLS), (_STOP, b".?"),
                          (_PUNCTUATION, b",;:'\"()-"), (_REST, bytes(range(128, 192))), (_LETTER, bytes(range(192, 256)))):
        table[list(members)] = kind
    return table


_CLASS = _byte_classes()


@dataclass
class Measured:
    """Counts of one text, and the features of its lines that have a word."""
    n_words: int
    word_chars: int
    n_symbols: int
    n_dup_lines: int
    n_repeat_words: int
    lines: np.ndarray                               # number of each line that has a word
    words: np.ndarray                               # its words
    features: np.ndarray                            # (line, feature), 0 or 1

    @property
    def base_failed(self) -> bool:
        return self.n_words < 20 or 100 * self.n_repeat_words > 30 * self.n_words


def _class_counts(data: bytes, lines: int) -> np.ndarray:
    """(line, class): how many bytes of each class a line has, its line feed included."""
    counts, line = np.zeros((lines, 10), np.int64), 0
    for at in range(0, len(data), _PIECE):
        piece = np.frombuffer(data, np.uint8, min(_PIECE, len(data) - at), at)
        feeds = piece == 10
        of = np.cumsum(feeds) - feeds
        last = int(of[-1]) + 1
        counts[line:line + last] += np.bincount(of * 10 + _CLASS[piece], minlength=last * 10).reshape(last, 10)
        line += int(feeds.sum())
    return counts


def _repeated(words: np.ndarray, window: int) -> np.ndarray:
    """Which words lie in a window that occurs twice or more; `words` are numbers. Windows are
    numbered exactly, by doubling their length (`window` is a power of two)."""
    width, numbers = 1, words
    while width < window and len(numbers) > width:
        pairs = numbers[:-width] * (int(numbers.max(initial=0)) + 1) + numbers[width:]
        numbers, width = np.unique(pairs, return_inverse=True)[1], 2 * width
    covered = np.zeros(len(words), bool)
    if width == window and len(numbers):
        again = np.flatnonzero(np.bincount(numbers)[numbers] > 1)
        steps = np.zeros(len(words) + 1, np.int64)
        np.add.at(steps, again, 1)
        np.add.at(steps, again + window, -1)
        covered = np.cumsum(steps[:-1]) > 0
    return covered


def _over(values: np.ndarray, bounds: tuple) -> np.ndarray:
    return values[:, None] > np.array(bounds)


def measure(text: str | None) -> Measured:
    """Null is a text without lines. Words end at ASCII white space, lines at a line feed."""
    data = text.encode("utf-8", "surrogatepass") if text else b""
    whole = data.split(b"\n")
    per_line = np.fromiter((len(line.split()) for line in whole), np.int64, len(whole))
    counts = _class_counts(data, len(whole))
    found = data.split()
    number = dict(zip(dict.fromkeys(found), range(len(found))))
    words = np.fromiter(map(number.__getitem__, found), np.int64, len(found))
    covered = _repeated(words, WINDOW)
    lines = np.flatnonzero(per_line)
    n = per_line[lines]
    times = Counter(whole[i] for i in lines)
    bins = counts[lines]
    letters = bins[:, [_LOWER, _UPPER, _LETTER]].sum(axis=1)
    chars = letters + bins[:, [_DIGIT, _SYMBOL, _STOP, _PUNCTUATION, _OTHER]].sum(axis=1)
    starts = np.cumsum(n) - n
    again = np.add.reduceat(covered, starts, dtype=np.int64) if len(lines) else n
    same = np.append(words[1:] == words[:-1], False)          # the word that follows, also over a line's end
    stutter = np.add.reduceat(same[:len(words)], starts, dtype=np.int64) if len(lines) else n
    bare = [whole[i].strip() for i in lines]
    first = np.fromiter((line[0] for line in bare), np.uint8, len(bare))
    last = np.fromiter((line[-1] for line in bare), np.uint8, len(bare))
    size = np.maximum(chars, 1)
    features = np.concatenate([
        np.ones((len(lines), 1), bool),
        *(_over(bins[:, k] / size, _SHARES) for k in (_SYMBOL, _OTHER, _DIGIT, _PUNCTUATION, _STOP)),
        _over(bins[:, _UPPER] / np.maximum(letters, 1), _SHARES), _over(1 - letters / size, _SHARES),
        _over(again / np.maximum(n, 1), _SHARES), _over(stutter / np.maximum(n, 1), _SHARES), _over(n, _WORDS), _over(chars / np.maximum(n, 1), _WORD_LENGTHS),
        np.stack([np.array([times[whole[i]] > 1 for i in lines], bool), _CLASS[first] == _UPPER,
                  _CLASS[last] == _STOP, _CLASS[last] == _OTHER, lines == lines.min(initial=0),
                  lines == lines.max(initial=0)], axis=1).reshape(len(lines), 6)], axis=1)
    return Measured(len(words), int(len(text or "") - counts[:, _SPACE].sum()), int(counts[:, _SYMBOL].sum()),
                    int(len(lines) - len(times)), int(covered.sum()), lines, n, features)


@dataclass
class Field:
    """Weights of the field; label 1 is content, 0 boilerplate."""
    weights: np.ndarray                             # of each feature, for content
    moves: np.ndarray                               # (label, next label)

    def decode(self, features: np.ndarray) -> np.ndarray:
        """The likeliest labels of the lines of one text (Viterbi); ties go to content."""
        scores = (features @ self.weights).tolist()
        if not scores:
            return np.zeros(0, bool)
        (bb, bc), (cb, cc) = self.moves.tolist()
        bad, good, from_good_to_bad, from_good_to_good = 0.0, scores[0], [], []
        for score in scores[1:]:
            to_bad, to_good = good + cb >= bad + bb, good + cc >= bad + bc
            bad, good = (good + cb if to_bad else bad + bb), score + (good + cc if to_good else bad + bc)
            from_good_to_bad.append(to_bad)
            from_good_to_good.append(to_good)
        label = good >= bad
        out = [label]
        for to_bad, to_good in zip(reversed(from_good_to_bad), reversed(from_good_to_good)):
            label = to_good if label else to_bad
            out.append(label)
        return np.array(out[::-1], bool)


def marginals(scores: np.ndarray, moves: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Probability of content (text, line) and expected label pairs (2, 2), by forward-backward.

    `scores` is (text, line) for content over boilerplate; `sizes`, the lines of each text, descend.
    """
    texts, length = scores.shape
    emit = np.stack([np.ones_like(scores), np.exp(np.clip(scores, -30, 30))], axis=2)
    move = np.exp(moves)
    open_ = [int(np.searchsorted(-sizes, -t, side="left")) for t in range(length + 1)]   # texts longer than t
    ahead, scale = np.ones((texts, length, 2)), np.ones((texts, length))
    ahead[:, 0] = emit[:, 0] / emit[:, 0].sum(axis=1, keepdims=True)
    for t in range(1, length):
        on = slice(0, open_[t])
        step = (ahead[on, t - 1] @ move) * emit[on, t]
        scale[on, t] = step.sum(axis=1)
        ahead[on, t] = step / scale[on, t, None]
    back, pairs = np.ones((texts, length, 2)), np.zeros((2, 2))
    for t in range(length - 1, 0, -1):
        on = slice(0, open_[t])
        seen = emit[on, t] * back[on, t] / scale[on, t, None]
        pairs += move * (ahead[on, t - 1].T @ seen)
        back[on, t - 1] = seen @ move.T
    both = ahead * back
    return both[:, :, 1] / both.sum(axis=2), pairs


def train(features: list[np.ndarray], labels: list[np.ndarray], steps: int = 150, penalty: float = 1.0,
          chain: bool = True) -> Field:
    """Maximum likelihood with a quadratic penalty, by gradient steps of adaptive length;
    without the `chain` neighbouring labels are independent."""
    order = sorted(range(len(features)), key=lambda i: -len(features[i]))
    sizes = np.array([len(features[i]) for i in order])
    x = np.concatenate([features[i] for i in order]).astype(float)
    y = np.concatenate([labels[i] for i in order]).astype(int)
    text = np.repeat(np.arange(len(order)), sizes)
    line = np.arange(len(x)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    width = x.shape[1]
    seen, seen_pairs = y @ x, np.zeros((2, 2))
    inside = np.flatnonzero(line)
    np.add.at(seen_pairs, (y[inside - 1], y[inside]), 1)
    theta, mean, square = np.zeros(width + 4), np.zeros(width + 4), np.zeros(width + 4)
    scores = np.zeros((len(order), int(sizes[0])))
    for step in range(1, steps + 1):
        scores[text, line] = x @ theta[:width]
        p, pairs = marginals(scores, theta[width:].reshape(2, 2), sizes)
        gradient = np.concatenate([seen - p[text, line] @ x, (seen_pairs - pairs).ravel()]) - penalty * theta
        if not chain:
            gradient[width:] = 0
        mean, square = 0.9 * mean + 0.1 * gradient, 0.99 * square + 0.01 * gradient ** 2
        theta = theta + 0.1 * (mean / (1 - 0.9 ** step)) / (np.sqrt(square / (1 - 0.99 ** step)) + 1e-8)
    return Field(theta[:width], theta[width:].reshape(2, 2))


def fit(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", quality: str = "quality",
        sample_docs: int = 400, sample_lines: int = 200, turns: int = 3) -> Field | None:
    """A field learned from at most `sample_docs` documents of each quality (1 good, 0 poor),
    taken by a hash of their id from those with at most `sample_lines` lines. An id labelled
    both ways counts as poor. None if a quality has no document with a word."""
    marked = labels.where(F.col(id).isNotNull() & F.col(quality).isin(0, 1)).groupBy(F.col(id).alias("label_id")).agg(
        F.min(quality).alias("label_quality"))
    usable = docs.where(F.size(F.split(text, "\n", -1)) <= sample_lines).select(F.col(id).alias("label_id"), F.col(text).alias("label_text"))
    # more ids than are needed, as some have no usable text; both counts are parameters, so the list is bounded
    dice = F.xxhash64("label_id")
    chosen = [marked.where(F.col("label_quality") == q).orderBy(dice, "label_id").limit(4 * sample_docs) for q in (0, 1)]
    rows = usable.join(F.broadcast(chosen[0].unionByName(chosen[1])), "label_id")
    picked = [rows.where(F.col("label_quality") == q).orderBy(dice, "label_id", "label_text").limit(sample_docs) for q in (0, 1)]
    width = len(measure("a").features[0])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [measure(t.as_py()).features for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array([np.packbits(f).tobytes() for f in found], pa.binary()),
                                              pa.array([len(f) for f in found], pa.int32())], ["quality", "features", "lines"])

    sample = picked[0].unionByName(picked[1]).select("label_text", F.col("label_quality").cast("int"))
    got = [(r["quality"], np.unpackbits(np.frombuffer(r["features"], np.uint8), count=r["lines"] * width).reshape(-1, width))
           for r in sample.mapInArrow(run, "quality int, features binary, lines int").collect() if r["lines"]]
    if len({q for q, _ in got}) < 2:
        return None
    got.sort(key=lambda r: (r[0], r[1].tobytes()))     # the same field whatever the order of the rows
    features = [f for _, f in got]
    lines = [np.full(len(f), q) for q, f in got]
    for turn in range(turns - 1):
        field = train(features, lines, chain=turn > 0)
        for i, (q, f) in enumerate(got):
            if q == 0:
                lines[i] = field.decode(f).astype(int)
                lines[i][np.argmin(f @ field.weights)] = 0
    return train(features, lines)


def _verdict(found: Measured, field: Field | None, least_share: float) -> tuple[np.ndarray, float, bool]:
    """Content or not per line with a word, the share of words in content, kept or not."""
    content = field.decode(found.features) if field else np.ones(len(found.lines), bool)
    share = int(found.words[content].sum()) / found.n_words if found.n_words else 0.0
    return content, share, not found.base_failed and share >= least_share


def rate(df: DataFrame, field: Field | None, least_share: float = 0.5, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of `df`: `id`, `n_words`, `word_chars`, `n_symbols`, `n_dup_lines`,
    `n_repeat_words`, `base_failed`, `content_lines` (numbers, from 0), `content_share`, `kept`.

    Words end at ASCII white space. `base_failed`: fewer than 20 words, or more than 30 % of
    the words in windows of 8 that occur twice. A row that has not failed is kept if at least
    `least_share` of its words lie in content lines. A null or empty text has no words, so it
    fails. Ties between labelings go to content. Without a field every line is content. Rows
    do not touch each other, so repeated rows and null ids are rated like any other; other
    columns, whatever their names, are not read.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for t in batch.column(1):
                m = measure(t.as_py())
                content, share, kept = _verdict(m, field, least_share)
                out.append((m.n_words, m.word_chars, m.n_symbols, m.n_dup_lines, m.n_repeat_words, m.base_failed,
                            m.lines[content].tolist(), share, kept))
            columns = list(zip(*out)) if out else [()] * len(kinds)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds))], names)

    kinds = [pa.int64()] * 5 + [pa.bool_(), pa.list_(pa.int64()), pa.float64(), pa.bool_()]
    names = [id, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
             "content_lines", "content_share", "kept"]
    return df.select(id, text).mapInArrow(run, (
        f"`{id}` {df.schema[id].dataType.simpleString()}, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
        "n_repeat_words bigint, base_failed boolean, content_lines array<bigint>, content_share double, kept boolean"))


def keep(df: DataFrame, field: Field | None, least_share: float = 0.5, text: str = "text") -> DataFrame:
    """The rows of `df` that `rate` keeps, with all their columns."""
    at = df.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = [_verdict(measure(t.as_py()), field, least_share)[2] for t in batch.column(at)]
            yield batch.filter(pa.array(kept, pa.bool_()))

    return df.mapInArrow(run, df.schema)

"""Centroid clustering, spelling variants and line quality against brute force."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyline.llm import kmeans, line_crf, spelling

VECTORS = "vec_id long, embedding array<float>, cluster string, v int, id string"


def brute_clusters(rows, k, rounds, dims, scale=64):
    kept = [(i, [math.floor(scale * float(np.float32(x))) for x in v]) for i, v in rows
            if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    seeds = sorted((hashlib.sha256(f"1:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)[:k]
    centroids = [list(v) for _, v in seeds]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centroids))

    for _ in range(rounds):
        members = {}
        for _, v in kept:
            members.setdefault(nearest(v)[1], []).append(v)
        for n, vs in members.items():
            centroids[n] = [sum(col) // len(vs) for col in zip(*vs)]
    return sorted(((i, nearest(v)[1], nearest(v)[0]) for i, v in kept), key=repr), centroids


@pytest.mark.parametrize("seed", [1, 2])
def test_clusters_equal_brute_force(spark, seed):
    rng = random.Random(seed)
    rows = [(i, [rng.gauss(i % 3, 0.5) for _ in range(8)]) for i in range(200)]
    rows += [(i, [rng.choice([0.0, 0.5]) for _ in range(8)]) for i in range(200, 300)]      # ties
    rows += [(7, [0.25] * 8), (7, [0.25] * 8), (None, [0.1] * 8), (400, None), (401, [1.0] * 7), (402, []),
             (403, [None] + [1.0] * 7), (404, [float("nan")] + [1.0] * 7), (405, [float("-inf")] + [1.0] * 7)]
    df = spark.createDataFrame([(i, v, "x", 1, "y") for i, v in rows], VECTORS).repartition(5)
    assigned, centroids = kmeans.cluster(df, k=6, rounds=3, dims=8)
    want, want_centroids = brute_clusters(rows, 6, 3, 8)
    assert sorted((tuple(r) for r in assigned.collect()), key=repr) == want
    assert [r.centroid for r in centroids.orderBy("cluster").collect()] == want_centroids
    facts = kmeans.with_inertia(assigned, centroids).collect()
    total = sum(d for _, _, d in want)
    for r in facts:
        assert r.inertia == total and r.cluster_inertia == sum(d for _, c, d in want if c == r.cluster)
        assert r.centroid_sha256 == hashlib.sha256(",".join(map(str, want_centroids[r.cluster])).encode()).hexdigest()
    assert len(facts) == len(want)


def test_search_passes_centroids_over_and_breaks_ties_by_number():
    rng = np.random.default_rng(3)
    rows = rng.integers(-50, 50, (40, 16)).tolist()
    rows[30] = rows[5]
    found = kmeans.Centroids(rows)
    x = np.concatenate([rng.integers(-60, 60, (500, 16)), np.array([rows[30]])])
    number, distance = found.nearest(x)
    every = ((x[:, None, :] - np.array(rows)[None]) ** 2).sum(axis=2)
    assert (number == every.argmin(axis=1)).all() and (distance == every.min(axis=1)).all() and number[-1] == 5


def test_clusters_of_little_data(spark):
    empty, none = kmeans.cluster(spark.createDataFrame([], VECTORS))
    assert empty.columns == ["vec_id", "cluster", "distance"] and empty.count() == none.count() == 0
    one = spark.createDataFrame([(5, [1.0] * 64, "x", 1, "y")], VECTORS)
    got = kmeans.with_inertia(*kmeans.cluster(one)).collect()
    assert [(r.vec_id, r.cluster, r.distance, r.inertia) for r in got] == [(5, 0, 0, 0)]
    huge = spark.createDataFrame([(1, [1e30] * 64, "x", 1, "y"), (2, [-1e30] * 64, "x", 1, "y")], VECTORS)
    with pytest.raises(Exception, match="do not fit 64 bits"):
        kmeans.cluster(huge)[0].collect()


def edits(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1:] == short for i in range(len(long)))


def brute_words(rows):
    counts = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            word = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{i}:{word}".encode())
            if i is not None and h % 31 == 0:
                word = word[:h % len(word)] + word[h % len(word) + 1:]
            counts[word] += 1
    return {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}


def brute_variants(counts):
    near = {w: [o for o in counts if edits(w, o)] for w in counts}
    form = {}
    for w, n in counts.items():
        best = min(near[w], key=lambda o: (-counts[o], o), default=None)
        form[w] = best if best and counts[best] >= 10 * n else None

    def root(w):
        return root(form[w]) if form[w] else w
    return {w: (n, len(near[w]), form[w], counts.get(form[w]), root(w)) for w, n in counts.items()}


def test_variants_equal_brute_force(spark):
    rng = random.Random(5)
    base = ["".join(rng.choice("abcde") for _ in range(rng.randint(7, 9))) for _ in range(60)] + ["Élévation", "übermäßig", "naïvement"]
    counts = {}
    for w in base:
        counts[w] = rng.choice([2, 30, 400, 9000])
        for _ in range(4):
            at = rng.randrange(len(w))
            for changed in (w[:at] + w[at + 1:], w[:at] + rng.choice("abcdeéÿ") + w[at + 1:], w[:at] + rng.choice("abc") + w[at:]):
                if len(changed) >= 7:
                    counts.setdefault(changed, rng.randint(2, 60))
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    got = spelling.group_variants(df).collect()
    want = brute_variants(counts)
    assert len(got) == len(want) and sum(v[1] for v in want.values()) > 400
    assert {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in got} == want


def test_longest_chain_and_ties(spark):
    counts = {"abcdefgh": 2, "abcdefgx": 20, "abcdefyx": 200, "abcdezyx": 2000, "abcdefga": 20, "abcdefg": 3, "zzzzzzzz": 5}
    got = {r.word: r for r in spelling.group_variants(spark.createDataFrame(list(counts.items()), "word string, n long")).collect()}
    assert got["abcdefgh"].form == "abcdefga" and got["abcdefgx"].root == "abcdezyx" and got["zzzzzzzz"].root == "zzzzzzzz"
    assert {w: (r.n, r.n_near, r.form, r.form_n, r.root) for w, r in got.items()} == brute_variants(counts)


def test_long_words_one_edit_apart(spark):
    rng = random.Random(2)
    base = ["".join(rng.choice("abé") for _ in range(n)) for n in (63, 64, 65, 70, 5000)]
    counts = {}
    for w in base:
        for at in (0, 1, len(w) // 2, len(w) - 1):
            for v in (w, w[:at] + w[at + 1:], w[:at] + "ü" + w[at + 1:], w[:at] + "a" + w[at:], w + "b", w[::-1]):
                counts[v] = rng.randint(2, 90)
    got = spelling.group_variants(spark.createDataFrame(list(counts.items()), "word string, n long")).collect()
    assert {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in got} == brute_variants(counts)


def test_words_of_odd_documents(spark):
    rng = random.Random(9)
    long = "x" * 300_000
    rows = [(i, " ".join(rng.choice(["Wonderful", "wonderfuL", "übertragen", "marvellous-thing", "short"]) for _ in range(40))) for i in range(60)]
    rows += [(3, None), (4, ""), (5, "\n"), (None, "wonderful wonderful"), (6, f"{long} {long}"), (6, rows[6][1]), (6, rows[6][1])]
    df = spark.createDataFrame([(i, t, 1, "w") for i, t in rows], "doc_id long, text string, n int, word string").repartition(4)
    got = {r.word: r.n for r in spelling.words(df).collect()}
    assert got == brute_words(rows)
    assert spelling.variants(df).count() == len(got)
    assert spelling.variants(df.limit(0)).collect() == []


def brute_base(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
    covered = {j for i in range(len(words) - 7) if windows[tuple(words[i:i + 8])] > 1 for j in range(i, i + 8)}
    lines = [line for line in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    return (len(words), sum(map(len, words)), sum((text or "").count(c) for c in "#*$%&|<>"),
            sum(line in lines[:i] for i, line in enumerate(lines)), len(covered),
            len(words) < 20 or 100 * len(covered) > 30 * len(words))


def prose(rng, n):
    return " ".join(rng.choice("one river moves along stones while birds sing over quiet fields".split()) + str(rng.randint(0, 99)) * rng.randint(0, 1) for _ in range(n)) + "."


def noise(rng, n):
    return " ".join(rng.choice(["|", "BUY", "###", "***", "NOW!!"]) + rng.choice("ABCDEFGH") * rng.randint(1, 5) for _ in range(n))


def test_base_counts_equal_brute_force(spark):
    rng = random.Random(4)
    texts = [None, "", "\n \n", "a", " x y z ", "é # ü\n\té # ü\n", "w " * 7, "w " * 8, "w " * 9, "a b c d e f g h\n" * 3 + "z"]
    texts += ["\n".join(rng.choice([prose, noise])(rng, rng.randint(1, 30)) for _ in range(rng.randint(1, 6))) for _ in range(40)]
    texts += [" ".join(rng.choice("ab") for _ in range(60)) for _ in range(10)] + ["long <b> line\u000b\n" * 1_000]
    df = spark.createDataFrame([(i % 50, t, "x", True) for i, t in enumerate(texts)], "doc_id long, text string, n_words string, kept boolean")
    got = line_crf.rate(df, None).collect()
    assert Counter((r.doc_id, *r[1:7]) for r in got) == Counter((i % 50, *brute_base(t)) for i, t in enumerate(texts))
    assert all(r.kept == (not r.base_failed) for r in got)


def test_decoder_and_marginals_equal_brute_force():
    rng = np.random.default_rng(8)
    field = line_crf.Field(rng.normal(size=4), rng.normal(size=(2, 2)))
    for size in (1, 2, 5):
        features = rng.integers(0, 2, (size, 4))
        score = {labels: sum(l * float(f @ field.weights) for l, f in zip(labels, features))
                 + sum(field.moves[a, b] for a, b in zip(labels, labels[1:])) for labels in itertools.product((0, 1), repeat=size)}
        assert score[tuple(field.decode(features).astype(int))] == pytest.approx(max(score.values()))
        p, pairs = line_crf.marginals((features @ field.weights)[None], field.moves, np.array([size]))
        total = sum(map(math.exp, score.values()))
        for t in range(size):
            assert p[0, t] == pytest.approx(sum(math.exp(v) for labels, v in score.items() if labels[t]) / total)
        for a, b in itertools.product((0, 1), repeat=2):
            want = sum(math.exp(v) * sum((x, y) == (a, b) for x, y in zip(labels, labels[1:])) for labels, v in score.items())
            assert pairs[a, b] == pytest.approx(want / total)
    assert list(line_crf.Field(np.zeros(4), np.zeros((2, 2))).decode(features)) == [True] * size


def test_field_learns_lines_from_labelled_documents(spark):
    rng = random.Random(6)
    rows, labels = [], []
    for i in range(160):
        poor = i % 4 == 0
        parts = [prose(rng, rng.randint(20, 40)) for _ in range(1 if poor else 4)] + [noise(rng, 40) for _ in range(3 if poor else 0)]
        rows.append((i, "\n".join(parts), "x"))
        if i < 120:
            labels.append((i, 0 if poor else 1))
    labels += [(None, 1), (500, None), (0, 1)]
    docs = spark.createDataFrame(rows + [(300, None, "x"), (301, "", "x")], "doc_id long, text string, label_text string")
    marks = spark.createDataFrame(labels, "doc_id long, quality int")
    field = line_crf.fit(docs, marks)
    got = {r.doc_id: r for r in line_crf.rate(docs, field).collect()}
    assert all(got[i].kept == bool(i % 4) for i in range(160)) and not got[300].kept and got[301].content_share == 0.0
    assert all(got[i].content_lines == [0] for i in range(0, 160, 4))
    again = line_crf.fit(docs.repartition(7), marks.repartition(3))
    assert np.allclose(again.weights, field.weights)
    kept = line_crf.keep(docs, field)
    assert kept.schema == docs.schema and {r.doc_id for r in kept.collect()} == {i for i, r in got.items() if r.kept}
    assert line_crf.fit(docs, marks.where("quality = 1")) is None
    assert line_crf.rate(docs.limit(0), field).count() == 0 and line_crf.fit(docs.limit(0), marks) is None

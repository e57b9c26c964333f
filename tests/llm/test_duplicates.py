"""Shingle join, line dedup and n-gram scores against brute force."""

import collections
import math
import random
from fractions import Fraction

import numpy as np
import pytest

from tallyline.llm import line_dedup, lm_score, ngram_join, packed


def near_copies(rng, n, words, vocabulary):
    docs, base = [], []
    for i in range(n):
        if base and rng.random() < 0.7:
            text = list(rng.choice(base))
            for _ in range(rng.choice([0, 0, 1, 2, 4])):
                k = rng.randrange(len(text) + 1)
                text[k:k + rng.choice([0, 1])] = rng.choice([[], [rng.choice(vocabulary)]])
        else:
            text = [rng.choice(vocabulary) for _ in range(rng.randint(0, words))]
        base.append(text)
        docs.append((i, " ".join(text)))
    return docs


def shingle_sets(docs, n=5):
    out = {}
    for d, t in docs:
        w = (t or "").encode().lower().split()
        out[d] = {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())
    return out


def brute_components(docs):
    sets = shingle_sets(docs)
    root = {d: d for d in sets}

    def find(a):
        while root[a] != a:
            a = root[a]
        return a
    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {d: (len(sets[d]), find(d)) for d in ids}


@pytest.mark.parametrize("words, vocabulary", [(12, "ab"), (60, "abcdefgh"), (300, [f"w{i}" for i in range(90)])])
def test_components_equal_brute_force(spark, words, vocabulary):
    docs = near_copies(random.Random(words), 160, words, vocabulary)
    docs += [(1000, None), (1001, ""), (1002, " \n "), (1003, "One two"), (1004, "one  TWO"), (1005, "one two three")]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.near_duplicates(df).collect()}
    assert got == brute_components(docs)


def test_similar_sets_share_a_signature():
    rng = np.random.default_rng(4)
    bands = ngram_join.Bands(Fraction(3, 4))
    for size in list(range(1, 40)) + [75, 133, 500, 2000]:
        for _ in range(20):
            pool = rng.integers(0, 2**63, 3 * size + 8, dtype=np.uint64)
            least = math.ceil(0.75 * size)
            kept = rng.integers(least, size + 1)
            a, b = pool[:size], np.concatenate([pool[:kept], pool[size:size + max(0, int(kept / 0.75) - size)]])
            both = len(np.intersect1d(a, b))
            if 4 * both < 3 * (len(a) + len(b) - both) or set(a) == set(b):
                continue
            frequent = np.sort(rng.choice(np.union1d(a, b), rng.integers(0, len(a) + 1), replace=False)) if len(a) > 1 else a[:0]
            common = np.intersect1d(*(ngram_join.signatures(np.sort(s), bands, frequent) for s in (a, b)))
            assert len(common), size
            assert ngram_join._least_difference(ngram_join.sketch(np.sort(a)), ngram_join.sketch(np.sort(b))) <= len(np.setxor1d(a, b))


def test_long_paths_are_one_component(spark):
    links = spark.createDataFrame([(bytes([i]), bytes([i + 1])) for i in range(60)] + [(b"x", b"y")], "a binary, b binary")
    got = {bytes(r.node): bytes(r.label) for r in ngram_join.components(links).collect()}
    assert all(got[bytes([i])] == bytes([0]) for i in range(61)) and got[b"y"] == b"x"


def test_repeated_ids_nulls_and_empty_tables(spark):
    same = "one two three four five six seven"
    df = spark.createDataFrame([(5, same, "c"), (3, same, "c"), (5, "other words that are here now", "c"), (None, "q w e r t y", "c")],
                               "doc_id long, text string, component_id string")
    got = sorted((str(r.doc_id), r.component_id) for r in ngram_join.near_duplicates(df).collect())
    assert got == [("3", 3), ("5", 3), ("5", 5), ("None", None)]
    assert ngram_join.near_duplicates(df.limit(0)).count() == 0


@pytest.mark.parametrize("id", [None, 9])
def test_a_set_that_only_rows_without_an_id_have_still_links(spark, id):
    base = " ".join(f"w{i}" for i in range(60))
    df = spark.createDataFrame([(id, base, 1), (5, base + " word", 2), (7, "word " + base, 3)], "doc_id long, text string, n int")
    got = {r.doc_id: r.component_id for r in ngram_join.near_duplicates(df).collect()}
    assert got == {id: 5, 5: 5, 7: 5}


def test_changed_copies_of_one_text_meet_at_the_text(spark):
    """Copies that are near to the text but not to each other are one component."""
    rng = random.Random(20)
    words = [f"w{i}" for i in range(200)]
    docs = [(0, " ".join(words))]
    for i in range(1, 60):
        copy = list(words)
        for at in rng.sample(range(5, 195), 5):
            copy[at] = f"x{i}-{at}"
        docs.append((i, " ".join(copy)))
    want = brute_components(docs)
    assert {c for _, c in want.values()} == {0}
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.near_duplicates(df).collect()} == want


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) <= 1
    a, b = sorted((a, b), key=len)
    i = next((i for i in range(len(a)) if a[i] != b[i]), len(a))
    return len(b) - len(a) == 1 and a[i:] == b[i + 1:]


def brute_lines(docs, least):
    lines = [(d, i, line.split()) for d, t in sorted(docs, key=lambda r: r[0]) if t for i, line in enumerate(t.encode().lower().split(b"\n"))]
    out = collections.defaultdict(list)
    for j, (d, i, w) in enumerate(lines):
        if w and any((d2, i2) < (d, i) and (w == w2 or (min(len(w), len(w2)) >= least and one_edit(w, w2)))
                     for d2, i2, w2 in lines[:j]):
            out[d].append(i)
    return dict(out)


@pytest.mark.parametrize("per_chunk, partitions", [(2_000_000, 1), (40, 3)])
def test_lines_equal_brute_force(spark, monkeypatch, per_chunk, partitions):
    rng = random.Random(per_chunk)
    docs = [(d, "\n".join(" ".join(rng.choice("abA") for _ in range(rng.randint(0, 7))) for _ in range(rng.randint(0, 6)))) for d in range(100)]
    docs.append((200, None))
    keys = [line_dedup._emit, line_dedup]
    monkeypatch.setattr(keys[1], "_WORDS_PER_CHUNK", per_chunk)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(partitions)
    got = {r.doc_id: r.repeated for r in line_dedup.repeated_lines(df, 4).collect()}
    assert got == brute_lines(docs, 4)


@pytest.mark.parametrize("partitions", [1, 3])
def test_lines_of_rows_with_one_id_do_not_remove_each_other(spark, partitions):
    a, b = "this line has eight words or rather more", "this line has eight words or even more"
    df = spark.createDataFrame([(1, a), (1, b), (2, a + "\nnew")], "doc_id long, text string").repartition(partitions)
    got = sorted((r.doc_id, r.text) for r in line_dedup.drop_repeated(df).collect())
    assert got == sorted([(1, a), (1, b), (2, "new")])


def test_string_ids_stand_in_their_order(spark):
    line = "this line has eight words or rather more"
    df = spark.createDataFrame([("b", line), ("a", line + "\nx"), (None, "x"), ("c", None)], "doc_id string, text string")
    got = {r.doc_id: r.text for r in line_dedup.drop_repeated(df).collect()}
    assert got == {"a": line + "\n", "b": "", None: "x", "c": None} or got == {"a": line, "b": "", None: "x", "c": None}


def test_neighbourhood_hashes_leave_one_word_out():
    words = np.array([11, 22, 33, 44, 11, 33, 44], np.uint64)
    keys, line, place = line_dedup.neighbourhood(words, np.array([4, 3]), 2)
    at = {(int(li), int(p)): k for k, li, p in zip(keys, line, place)}
    assert at[0, 2] == at[1, 0] and len(set(keys)) == len(keys) - 1


def test_dropping_lines_keeps_columns_and_other_texts(spark):
    df = spark.createDataFrame([(1, "Keep this line, it is the first of its kind\n\nb", "s", 1), (2, "keep this line, it is the best of its kind\nnew", "s", 2),
                                (3, None, "s", 3), (4, "b", "s", 4), (None, "b\nz", "s", 5)], "doc_id long, text string, _gone string, _gone_id int")
    out = line_dedup.drop_repeated(df)
    assert out.columns == df.columns
    got = {r._gone_id: r.text for r in out.collect()}
    assert got == {1: "Keep this line, it is the first of its kind\n", 2: "new", 3: None, 4: "", 5: "b\nz"}
    assert line_dedup.drop_repeated(df.limit(0)).count() == 0


def test_scores_equal_brute_force(spark):
    rng = random.Random(2)
    docs = [(i, " ".join(rng.choice("abcdA") for _ in range(rng.randint(0, 30)))) for i in range(40)] + [(90, None), (91, "zz"), (92, docs_text := "a b a b c")]
    docs.append((93, docs_text))
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumnRenamed("text", "body")
    got = {r.doc_id: r for r in lm_score.score(df, text="body").collect()}
    words = {d: (t or "").lower().split() for d, t in docs}

    def grams(w):
        return collections.Counter(tuple(w[i:i + n]) for n in (1, 2, 3) for i in range(len(w) - n + 1))
    every = sum((grams(w) for w in words.values()), collections.Counter())
    total = sum(map(len, words.values()))
    for d, w in words.items():
        own = grams(w)

        def share(context, word):
            count = every[context + (word,)] - own[context + (word,)]
            if not context:
                rest = total - len(w)
                return count / rest if count else 1 / (rest + 1)
            before = every[context] - own[context]
            return min(1.0, count / before) if count and before else 0.4 * share(context[1:], word)
        want = sum(math.log(share(tuple(w[max(0, i - 2):i]), x)) for i, x in enumerate(w))
        assert got[d].n_tokens == len(w) and got[d].log_score == pytest.approx(want, abs=1e-9)
    assert lm_score.score(df.limit(0), text="body").count() == 0


def test_sets_sign_no_more_parts_than_they_must():
    rng = np.random.default_rng(5)
    bands = ngram_join.Bands(Fraction(3, 4))
    for size in (40, 300, 2000):
        elements = np.unique(rng.integers(0, 2**63, size, dtype=np.uint64))
        least = sum(bands.difference(bands.band(size) + i) + 1 for i in (0, 1))
        assert len(ngram_join.signatures(elements, bands, elements[:0])) <= least


@pytest.mark.parametrize("small, at_once", [(256, 50), (2, 1_000_000)])
def test_small_and_large_groups_lose_no_link(spark, monkeypatch, small, at_once):
    monkeypatch.setattr(ngram_join, "_SMALL_GROUP", small, raising=False)
    monkeypatch.setattr(ngram_join, "_PAIRS_AT_ONCE", at_once, raising=False)
    docs = near_copies(random.Random(8), 200, 60, "abcdefgh")
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.near_duplicates(df).collect()} == brute_components(docs)


def test_a_finished_task_leaves_no_memo():
    packed.word_hashes([b"a"], 1)
    assert packed.WORDS and list(packed.releasing(iter)([1, 2])) == [1, 2]
    assert not packed.WORDS
    packed.word_hashes([b"a"], 1)
    assert packed.releasing_groups(len)([1]) == 1 and not packed.WORDS


def test_words_of_a_text_are_hashed_without_a_call_a_word(monkeypatch):
    """Short words, nearly all, are no Python objects; equal words and only they have equal hashes."""
    rng = random.Random(5)
    letters = [b"a", b"B", b"\xc3\xa9", b"\x00", b"z", b" ", b"\n", b"\x0b", b"\xff"]
    text = b"".join(rng.choice(letters) for _ in range(4000)) + b" " + b"x" * 33 + b" " + b"X" * 33 + b" y" + b"x" * 33
    asked = []
    known = packed.word_hashes
    monkeypatch.setattr(packed, "word_hashes", lambda words, n: known(asked.extend(words) or asked, n))
    hashes, starts = packed.words(text)
    split = text.lower().split()
    assert [text[s:s + len(w)].lower() for s, w in zip(starts.tolist(), split)] == split and len(split) == len(hashes)
    assert len(set(hashes.tolist())) == len(set(zip(hashes.tolist(), split))) == len(set(split))
    assert asked == [w for w in split if len(w) > 32]
    for empty in (b"", b" \t\r\n"):
        assert not len(packed.words(empty)[0])
    assert [list(x) for x in packed.words_of([b"", b"a b", b" ", b"c"])[1:]] == [[0, 2, 0, 1]]


def test_lines_of_joined_texts_keep_their_places():
    texts = [b"a b\n\nc", b"\n", b"d"]
    hashes, counts, places, numbers = line_dedup._lines([7, 3, 9], texts)
    assert list(counts) == [2, 0, 1, 0, 0, 1] and list(places) == [7, 7, 7, 3, 3, 9] and list(numbers) == [0, 1, 2, 0, 1, 0]
    assert list(hashes) == list(packed.words(b"a b c d")[0])


def test_one_sort_finds_what_other_texts_hold():
    rng = random.Random(9)
    texts = [None, b"", b"one"] + [" ".join(rng.choices("abcd", k=rng.randrange(12))).encode() for _ in range(40)]
    counts, keys = lm_score.ngrams(texts, 3)
    distinct, totals = lm_score._distinct(keys)
    split = [(t or b"").split() for t in texts]
    held = [[collections.Counter(tuple(w[i:i + n]) for i in range(len(w) - n + 1)) for w in split] for n in (1, 2, 3)]
    others = lm_score._others(counts, keys, totals.astype(np.uint64))
    for n, (found, per_text) in enumerate(zip(others, held), 1):
        everywhere = sum(per_text, collections.Counter())
        expected = [everywhere[g] - own[g] if len(g := tuple(w[max(i - n + 1, 0):i + 1])) == n else 0
                    for w, own in zip(split, per_text) for i in range(len(w))]
        assert list(found) == expected
    assert list(counts) == [len(w) for w in split] and len(distinct) == 1 + sum(len(sum(h, collections.Counter())) for h in held)


def test_a_chunk_of_lines_is_not_held_twice():
    hashes, counts = np.arange(1, 31, dtype=np.uint64), np.full(3, 10)
    chunk = [(hashes, counts, np.zeros(3, np.int64), np.arange(3))]
    rows = list(line_dedup._emit(chunk, 50, 8))
    assert not chunk and sum(r.num_rows for r in rows)
    keys, line, place = line_dedup.neighbourhood(hashes, counts, 8)
    assert len(keys) == 33 and line.itemsize == place.itemsize == 4


def test_shingles_need_no_memo_of_words():
    packed.WORDS.clear()
    a, b, c = (ngram_join.shingles(t, 5) for t in ("One two three four five six", " one\ttwo three four FIVE\nsix ", "one two three four six five"))
    assert not packed.WORDS and len(a) == 2 and list(a) == list(b) and not set(a.tolist()) & set(c.tolist())
    assert len(ngram_join.shingles("a " * 40, 5)) == 1 and len(ngram_join.shingles("a b", 5)) == 1 and not len(ngram_join.shingles(" \n", 5))


def test_texts_that_share_a_passage_are_no_candidates(spark):
    passage = " ".join(f"p{i}" for i in range(60))
    docs = [(d, passage + " " + " ".join(f"w{d}-{i}" for i in range(60))) for d in range(30)]
    docs += [(100, docs[0][1] + " end"), (101, "other words that no text has")]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    described, groups = ngram_join.scan(df, "doc_id", "text", 5, ngram_join.Bands(Fraction(3, 4)))
    pair = {bytes(r["class"]) for r in described.where("doc_id in (0, 100)").collect()}
    assert described.count() == 32 and {bytes(r["class"]) for r in groups.collect()} == pair


def test_blocks_of_a_large_group_give_only_pairs_that_may_be_similar(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "_LEAST_BLOCK", 4)
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**63, 120, dtype=np.uint64)
    sets = [np.sort(np.concatenate([base[:120 - n], rng.integers(0, 2**63, n, dtype=np.uint64)])) for n in rng.integers(2, 60, 30)]
    rows = [(0, bytes([i]), bytes([i % 7]), len(s), ngram_join.sketch(s)) for i, s in enumerate(sets)]
    df = spark.createDataFrame(rows, "cluster int, class binary, label binary, n_shingles long, sketch binary")
    got = [(bytes(r.a)[0], bytes(r.b)[0]) for r in ngram_join._pairs_across(df, Fraction(3, 4)).collect()]
    apart = [(i, j) for j in range(30) for i in range(j) if i % 7 != j % 7]
    similar = {(i, j) for i, j in apart if 7 * len(np.setxor1d(sets[i], sets[j])) <= len(sets[i]) + len(sets[j])}
    possible = {(i, j) for i, j in apart if 7 * ngram_join._least_difference(rows[i][4], rows[j][4]) <= len(sets[i]) + len(sets[j])}
    assert sorted(got) == sorted(possible) and similar <= possible and len(possible) < len(apart) / 2

"""Byte BPE and packing against the tokenizer libraries."""

import base64
import hashlib
import random
import struct
import zlib

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tallyline.llm import bpe, packing

RANKS, WORDS = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.path("word_bpe_49k.json")
TRICKY = ["", " ", "a  b", " \n a", "a　 b", "x\x1c y \x1cz", "it's 's I'll  don't\t\n\n x", "日本語 テスト 🎉👩‍👩‍👧 é",
          "a" * 3000, " " * 300 + "b", "-" * 200, "\n\n\n", "a\n b", "٠١ ½²", "<|endoftext|>. a<|startoftext|>b.,",
          "Straße ΣΑΣ. İ, é, a​b 're 5. ½, ２.", "...", ",,a.. ,a", "Ana. ANA, ana"]


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(3)
    return TRICKY + ["".join(rng.choice("ab'sr1.,\n\t é́E<|> ") for _ in range(40)) for _ in range(300)]


@pytest.fixture(scope="module")
def reference():
    with open(RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def coder():
    return bpe.ByteBpe(RANKS, public_tokenizers.PATTERN)


def little(ids):
    return struct.pack(f"<{len(ids)}I", *ids)


def test_encodes_as_the_library(coder, reference, texts):
    for t in texts:
        ids = coder.encode(t)
        assert ids == little(reference.encode_ordinary(t)), t
        assert "".join(coder.decode(ids, 3)) == t


def test_small_tables_give_the_same_ids(reference, texts):
    small = bpe.ByteBpe(RANKS, public_tokenizers.PATTERN, max_memo=4)
    small.machine.max_transitions = 50
    assert all(small.encode(t) == little(reference.encode_ordinary(t)) for t in texts[:120])


def test_the_table_is_bounded_inside_a_match(reference):
    small = bpe.ByteBpe(RANKS, public_tokenizers.PATTERN)
    small.machine.max_transitions = 500
    text = "".join(random.Random(1).choice("abcdefghijklmnopqrstuvwxyz") for _ in range(20_000))
    assert small.encode(text) == little(reference.encode_ordinary(text))
    assert len(small.machine._next) <= 500 and len(small.machine._states) <= 501


def test_stream_holds_back_unfinished_characters():
    data = "aé€🎉z".encode() + b"\xff\xe2\x82" + "é".encode() + b"\xf0\x9f"
    for size in (1, 2, 3, 5):
        stream = bpe.Utf8Stream()
        got = "".join(stream.feed(data[i:i + size]) for i in range(0, len(data), size)) + stream.end()
        assert got == data.decode("utf-8", "replace")
    stream = bpe.Utf8Stream()
    assert stream.feed("é".encode()[:1]) == "" and stream.feed("é".encode()[1:]) == "é"


def test_bpe_frames(spark, coder):
    df = spark.createDataFrame([(1, "Hello wörld", "x"), (2, None, "x"), (3, "", "y"), (1, "Hello wörld", "x"), (None, "a", "z")],
                               "doc_id long, text string, n_tokens string")
    got = {(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.round_trip(df, RANKS, public_tokenizers.PATTERN).collect()}
    want = set()
    for d, t in [(1, "Hello wörld"), (2, ""), (3, ""), (None, "a")]:
        ids = coder.encode(t)
        want.add((d, len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(t.encode()).hexdigest()))
    assert got == want
    encoded = bpe.encode(df, RANKS, public_tokenizers.PATTERN)
    assert {r.decoded for r in bpe.decode(encoded, RANKS, public_tokenizers.PATTERN).collect()} == {"Hello wörld", "", "a"}
    assert bpe.round_trip(df.limit(0), RANKS, public_tokenizers.PATTERN).count() == 0


def test_word_ids_as_the_library(texts):
    reference, coder = Tokenizer.from_file(WORDS), packing.WordIds(WORDS)
    for t in texts * 2:
        assert coder.encode(t) == little(reference.encode(t, add_special_tokens=False).ids), t
    small = packing.WordIds(WORDS, max_memo=3)
    assert all(small.encode(t) == coder.encode(t) for t in texts)


@pytest.mark.parametrize("n", [0, 1, 2, 3, 2047, 2048, 2049, 5000, 8192])
def test_binary_pieces(n):
    cut = list(packing.binary_pieces(n, 2048))
    assert sum(length for _, length in cut) == n and all(length & (length - 1) == 0 for _, length in cut)
    assert [s for s, _ in cut] == [sum(length for _, length in cut[:i]) for i in range(len(cut))]
    assert len([1 for _, length in cut if length < 2048]) == bin(n % 2048).count("1")


def test_pack(spark):
    long = "word " * 3000
    df = spark.createDataFrame([(1, long, "s"), (2, None, "s"), (2, None, "s"), (3, "A b.", "s")], "doc_id long, text string, bucket string")
    rows = packing.pack(df, WORDS).withColumn("crc", F.crc32("ids")).collect()
    reference = Tokenizer.from_file(WORDS)
    for d, t, times in ((1, long, 1), (2, "", 2), (3, "A b.", 1)):
        ids = reference.encode(t, add_special_tokens=False).ids + [1]
        own = sorted((r.start, r.length, r.crc, r.doc_tokens) for r in rows if r.doc_id == d)
        want = [(s, n, zlib.crc32(little(ids[s:s + n])), len(ids)) for s, n in packing.binary_pieces(len(ids), 2048)]
        assert own == sorted(want * times)
    assert len({r.sequence_id for r in rows}) == len(rows) and {r.offset for r in rows} == {0}
    assert all(2 ** r.bucket == r.length and r.sequence_id % 64 == r.bucket for r in rows)
    assert packing.pack(df.limit(0), WORDS).count() == 0 and packing.pieces(df.where("doc_id = 2"), WORDS, None).count() == 0
    with pytest.raises(ValueError):
        packing.pieces(df, WORDS, max_length=1000)


def test_word_ids_of_words_with_punctuation_or_a_dotted_capital():
    """A word that is one capital dotted I lost its lower case; the others are cut at their end."""
    reference, coder = Tokenizer.from_file(WORDS), packing.WordIds(WORDS)
    for t in ["\u0130", "X\u0130 A\u0130.", "ab%%% ab*** ab## 12%, 3!?", "a<|endoftext|>", "<|endoftext|>!", "it's! its' 's* ab'", "\u00c9T\u00c9; \u00e9t\u00e9--",
              "a\u0301% \u00bd$ x_ _x \u0149=", "(ab) [AB] \"ab\"", "ab\u00ad% \u01c5! \u212a? \u024f"]:
        assert coder.encode(t) == little(reference.encode(t, add_special_tokens=False).ids), t


def test_word_memo_is_bounded():
    coder = packing.WordIds(WORDS, max_memo=50)
    for i in range(400):
        coder.encode(f"w{i} W{i}. abc{'de' * i}")
        assert len(coder) <= 50

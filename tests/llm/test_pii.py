"""Personal data spans against plain regular expressions, and disguised identifiers."""

import hashlib
import random
import re

import pytest

from tallyline.llm import pii

PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def brute(text):
    out = {}
    for kind, pattern in PLAIN.items():
        out[kind] = []
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            bad = {"email": False, "ip": kind == "ip" and any(int(p) > 255 for p in m.group().split(".")),
                   "card": not (13 <= len(digits) <= 19 and pii.luhn(digits)), "phone": not 9 <= len(digits) <= 15}
            if not bad[kind]:
                out[kind].append(m.span())
    return out


def test_plain_spans_equal_plain_patterns():
    rng = random.Random(1)
    for alphabet in ("a1@._+- (2)3%", "0123456789. -+", "ab@.c"):
        for _ in range(3000):
            text = "".join(rng.choice(alphabet) for _ in range(50))
            assert pii.plain_spans(text) == brute(text), text


def test_hostile_texts_take_linear_time():
    for text in ("1" * 200_000, "a" * 200_000, "1." * 100_000, "+1" * 100_000, "a@" * 100_000, "@" * 100_000, "one " * 50_000):
        pii.find(text)


def test_luhn():
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112")


@pytest.mark.parametrize("text, kind, found", [
    ("mail bob [at] example [dot] com now", "email", "bob [at] example [dot] com"),
    ("write to bob at example dot com please", "email", "bob at example dot com"),
    ("bоb@exаmple.com", "email", "bоb@exаmple.com"),
    ("b​ob@exa­mple.com!", "email", "b​ob@exa­mple.com"),
    ("call plus one two three four five six seven eight nine zero ok", "phone",
     "plus one two three four five six seven eight nine zero"),
    ("host １９２.168.０.1 up", "ip", "１９２.168.０.1"),
    ("pay four one one one 1111 1111 1111", "card", "four one one one 1111 1111 1111")])
def test_disguises_map_back_to_source(text, kind, found):
    plain, spans = pii.find(text)
    assert plain[kind] == [] and [text[s:e] for s, e in spans[kind]] == [found]
    assert pii.mask(text) == text.replace(found, f"<{kind}>")


@pytest.mark.parametrize("text", ["look at the dot on it", "Ada at home, one of two", "one nine", "éàü ñ ß", "dot dot dot"])
def test_clean_texts_stay_clean(text):
    plain, spans = pii.find(text)
    assert not any(spans.values()) and pii.mask(text) == text


def test_mask_covers_overlaps():
    assert pii.mask("x 1.2.3.4@x.com y") == "x <email> y"
    assert pii.mask(None) is None and pii.mask("") == ""


def test_frames(spark):
    df = spark.createDataFrame([(1, "a@b.co 1.2.3.4", "k"), (2, None, "k"), (3, "", "k"), (3, "", "k")], "doc_id long, text string, spans string")
    got = sorted((r.doc_id, r.n_email, r.n_ip, r.base_sha256, r.spans) for r in pii.detect(df).collect())
    none = hashlib.sha256(b"").hexdigest()
    listed = "email:0:6,ip:7:14"
    assert got == [(1, 1, 1, hashlib.sha256(listed.encode()).hexdigest(), listed), (2, 0, 0, none, ""), (3, 0, 0, none, ""), (3, 0, 0, none, "")]
    masked = pii.redact(df)
    assert masked.columns == df.columns
    assert sorted((r.doc_id, r.text) for r in masked.collect() if r.text) == [(1, "<email> <ip>")]
    assert masked.where("text is null").count() == 1 and pii.detect(df.limit(0)).count() == 0


@pytest.mark.parametrize("address", [
    "bob at example.com", "bob@example dot com", "bob at mail.example dot com", "bob at mail dot example.com",
    "bob [at] example dot com", "bob at example [dot] com", "bob@example(dot)com", "bob at example dot app",
    "bob at example dot me", "bob at example dot ru", "bob at example dot cn", "bob@example dot museum",
    "Bob.Ray at example.ru", "bob at example dot co dot uk", "bob at example dot to"])
def test_written_separators_and_all_endings(address):
    text = f"write to {address} please"
    plain, spans = pii.find(text)
    assert plain["email"] == [] and [text[s:e] for s, e in spans["email"]] == [address]
    assert pii.mask(text) == "write to <email> please"


@pytest.mark.parametrize("address", ["b" * 65 + " at example dot com", "b" * 5000 + " at example dot com", "bob at " + "q." * 9 + "b dot com",
                                     "bob at " + "q dot " * 12 + "com", "bob at " + "x" * 70 + " dot com", "bob at example dot " + "y" * 70])
def test_parts_have_no_greatest_length(address):
    text = f"write to {address} please"
    assert [text[s:e] for s, e in pii.find(text)[1]["email"]] == [address]


@pytest.mark.parametrize("text", ["stare at red dot on screen", "look at the dot in it", "look at index.html first",
                                  "He was at home.Then he left", "pay at 10.30 or at 11.15", "see the dot com boom at work"])
def test_running_text_is_no_address(text):
    assert pii.mask(text) == text

"""Personal data: plain patterns, and an offset-preserving pass over disguised text.

Plain identifiers are matched in the text as it is. A text that holds a disguise is then
rewritten by a transducer: lookalike letters and digits become ASCII, invisible characters
go, spelled digits become digits, and written-out `at`, `dot` and `plus` become signs. The
transducer records for each output piece the source characters it came from, so what the
same patterns find in its output is mapped back to source offsets. Such a span is added if
a disguise lies in it and it overlaps no plain span of its kind.

Every pattern is matched from the first character of its run only, which finds the same
spans in linear time also in hostile texts.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StringType

KINDS = ("email", "ip", "card", "phone")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")

Span = tuple[int, int]


def _emails(text: str) -> Iterator[Span]:
    done = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            done = domain.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


def _ips(text: str) -> Iterator[Span]:
    at = 0
    while found := _IP.search(text, at):
        at = found.end()
        if all(len(p := part.lstrip("0")) <= 3 and int(p or 0) <= 255 for part in found.group().split(".")):
            yield found.span()


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def _cards(text: str) -> Iterator[Span]:
    for found in _CARD.finditer(text):
        if found.end() - found.start() >= 13:
            digits = _NOT_DIGIT.sub("", found.group())
            if 13 <= len(digits) <= 19 and luhn(digits):
                yield found.span()


def _phones(text: str) -> Iterator[Span]:
    for found in _PHONE.finditer(text):
        if 9 <= len(_NOT_DIGIT.sub("", found.group())) <= 15:
            yield found.span()


_FINDERS = {"email": _emails, "ip": _ips, "card": _cards, "phone": _phones}


def plain_spans(text: str) -> dict[str, list[Span]]:
    """Leftmost, non-overlapping spans per kind, in code points, end exclusive."""
    return {kind: list(_FINDERS[kind](text)) for kind in KINDS}


# Characters that look like an ASCII letter, digit or sign.
_LOOKALIKES = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ј": "j", "ѕ": "s",
    "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T",
    "Х": "X", "ο": "o", "α": "a", "ν": "v", "ι": "i", "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H",
    "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Χ": "X", "․": ".", "。": ".",
    "﹫": "@", "‐": "-", "‑": "-", "‒": "-", "–": "-", "−": "-", "\u00a0": " ", "\u202f": " ",
}
# Full-width forms are a fixed distance from ASCII; other decimal digits follow their zero.
_LOOKALIKES |= {chr(c + 0xFEE0): chr(c) for c in range(0x21, 0x7F)}
_LOOKALIKES |= {chr(zero + d): str(d) for zero in (0x660, 0x6F0, 0x966, 0x1D7CE, 0x1D7D8, 0x1D7E2, 0x1D7EC, 0x1D7F6)
                for d in range(10)}
_INVISIBLE = "\u00ad\u200b\u200c\u200d\u2060\ufeff"
# Digit words.
_DIGIT_WORDS = {"zero": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5",
                "six": "6", "seven": "7", "eight": "8", "nine": "9"}
_SIGN_WORDS = {"at": "@", "dot": ".", "plus": "+"}
# Endings that an address needs whose `at` is a word and whose dots are all signs, as a
# sentence may have a file name or a missing space there: the country codes and common generic endings.
_ENDINGS = "|".join("""
    ac ad ae af ag ai al am ao aq ar as at au aw ax az ba bb bd be bf bg bh bi bj bm bn bo br bs bt bw by bz ca cc cd
    cf cg ch ci ck cl cm cn co cr cu cv cw cx cy cz de dj dk dm do dz ec ee eg er es et eu fi fj fk fm fo fr ga gd ge
    gf gg gh gi gl gm gn gp gq gr gs gt gu gw gy hk hm hn hr ht hu id ie il im in io iq ir is it je jm jo jp ke kg kh
    ki km kn kp kr kw ky kz la lb lc li lk lr ls lt lu lv ly ma mc md me mg mh mk ml mm mn mo mp mq mr ms mt mu mv mw
    mx my mz na nc ne nf ng ni nl no np nr nu nz om pa pe pf pg ph pk pl pm pn pr ps pt pw py qa re ro rs ru rw sa sb
    sc sd se sg sh si sk sl sm sn so sr ss st su sv sx sy sz tc td tf tg th tj tk tl tm tn to tr tt tv tw tz ua ug uk
    us uy uz va vc ve vg vi vn vu wf ws ye yt za zm zw
    com org net edu gov mil int info biz name pro aero asia cat coop jobs mobi museum post tel travel app art blog
    cloud club company design dev digital email expert global group health host legal life link live ltd mail media
    network news online page pub shop site social software space store studio systems tech today top vip website wiki
    work works world xyz zone test example invalid""".split())
# Words of running text that name no host, and that no address ends with.
_NO_HOST = "the|a|an|this|that|these|those|each|every|any|some|my|your|his|her|its|our|their|it|them|him"
_NO_ENDING = "on|and|or|of|the|with|for|from|but|if|was|were|are|that|which|when|then|dot"

_WORD = "|".join(_DIGIT_WORDS)
# A digit word counts only beside another digit word or a digit, a bare `at` or `dot` only
# between word characters of an address. Each separator of an address is a sign or a word,
# bare or in brackets, and one at least is a word.
_SPELLED = rf"(?<![a-z])(?:{_WORD})(?:[\x20.-]{{1,2}}(?:{_WORD}|[0-9](?![a-z])))+(?![a-z])"
_BRACKETED = r"\x20?[\[({<]\x20?(?:at|dot|plus)\x20?[\])}>]\x20?"
_AT, _DOT = (rf"(?:\x20{word}\x20|\x20?[\[({{<]\x20?{word}\x20?[\])}}>]\x20?)" for word in ("at", "dot"))
# Parts have no greatest length: no part can end in what the next one starts with, so a run is
# taken whole and never tried again.
_LABEL = r"[a-z0-9-]++"
_ADDRESS = (r"(?<![a-z0-9._%+-])[a-z0-9._%+-]++"
            rf"(?:(?:{_AT}(?!(?:{_NO_HOST})\x20dot\x20)|@){_LABEL}(?:\.{_LABEL})*{_DOT}"
            rf"(?:{_LABEL}(?:{_DOT}|\.))*(?!(?:{_NO_ENDING})(?![a-z0-9-]))[a-z]{{2,}}"
            rf"|{_AT}{_LABEL}(?:\.{_LABEL})*\.(?:{_ENDINGS}))(?![a-z0-9])")
_PLUS = rf"(?<![a-z])plus\x20(?=[0-9]|{_WORD})"
_ONE_CHARACTER = "[" + re.escape("".join(_LOOKALIKES)) + "]|[" + _INVISIBLE + "]"
_DISGUISE = re.compile(_ONE_CHARACTER)
_WRITTEN = re.compile(f"{_BRACKETED}|{_ADDRESS}|{_PLUS}|{_SPELLED}", re.IGNORECASE)
_HINT = re.compile(rf"\b(?:at|dot|plus|{_WORD})\b", re.IGNORECASE)
_INSIDE = {"bracketed": re.compile(r"[a-z]+", re.IGNORECASE),
           "address": re.compile(rf"{_AT}|{_DOT}", re.IGNORECASE),
           "digit": re.compile(rf"({_WORD})|[0-9]", re.IGNORECASE)}


class Rewritten:
    """Text with pieces replaced; knows the source span of each of its characters."""

    def __init__(self, text: str, edits: list[tuple[int, int, str]]):
        self._at, self._source = [0], [0]      # output offset -> source offset, where they diverge
        self._edits: list[Span] = []           # output spans that a disguise produced
        parts, length, done = [], 0, 0
        for start, end, new in edits:
            if start < done:
                continue
            parts += [text[done:start], new]
            length += start - done
            self._at.append(length)
            self._source.append(start)
            self._edits.append((length, length + len(new)))
            length += len(new)
            self._at.append(length)
            self._source.append(end)
            done = end
        parts.append(text[done:])
        self.text = "".join(parts)

    def source(self, offset: int, end: bool = False) -> int:
        """Source offset of an output offset; inside a replaced piece its start or its end."""
        i = bisect_right(self._at, offset - end) - 1
        if i % 2:                              # a replaced piece
            return self._source[i + 1] if end else self._source[i]
        return self._source[i] + offset - self._at[i]

    def disguised(self, start: int, end: int) -> bool:
        i = bisect_right(self._edits, (end, -1)) - 1
        return i >= 0 and self._edits[i][1] >= start and self._edits[i][0] < end and (
            self._edits[i][1] > start or self._edits[i][0] >= start)


def _written_edits(text: str) -> list[tuple[int, int, str]]:
    edits = []
    for found in _WRITTEN.finditer(text):
        piece, start = found.group(), found.start()
        lower = piece.lower()
        if lower.lstrip(" ")[:1] in "[({<":        # an address starts with its local part
            edits.append((start, found.end(), _SIGN_WORDS[_INSIDE["bracketed"].search(lower).group()]))
        elif lower == "plus ":
            edits.append((start, found.end(), "+"))
        elif _INSIDE["address"].search(piece):
            edits += [(start + m.start(), start + m.end(), "@" if "a" in m.group().lower() else ".")
                      for m in _INSIDE["address"].finditer(piece)]
        else:
            last = start
            for m in _INSIDE["digit"].finditer(piece):
                # A word goes with the separator before it, but dots stay.
                before = start + m.start()
                digit = _DIGIT_WORDS.get(m.group().lower(), m.group())
                keep = "." if "." in text[last:before] else ""
                edits.append((last, start + m.end(), keep + digit))
                last = start + m.end()
    return edits


def added_spans(text: str, plain: dict[str, list[Span]]) -> dict[str, list[Span]]:
    """Source spans of identifiers that only the rewritten text shows, per kind."""
    characters = not text.isascii() and _DISGUISE.search(text)
    if not characters and not _HINT.search(text):
        return {}
    first = Rewritten(text, [(m.start(), m.end(), _LOOKALIKES.get(m.group(), ""))
                             for m in _DISGUISE.finditer(text)] if characters else [])
    second = Rewritten(first.text, _written_edits(first.text))
    if second.text == text:
        return {}
    added = {}
    for kind, spans in plain_spans(second.text).items():
        taken, new = plain[kind], []
        for start, end in spans:
            inner = second.source(start), second.source(end, True)
            if not (second.disguised(start, end) or first.disguised(*inner)):
                continue
            source = first.source(inner[0]), first.source(inner[1], True)
            i = bisect_right(taken, (source[1], -1))
            if (i == 0 or taken[i - 1][1] <= source[0]) and (not new or new[-1][1] <= source[0]):
                new.append(source)
        if new:
            added[kind] = new
    return added


def _listed(spans: dict[str, list[Span]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind in KINDS for start, end in spans.get(kind, ()))


def find(text: str | None) -> tuple[dict[str, list[Span]], dict[str, list[Span]]]:
    """(plain spans, all spans) per kind, each sorted by start. Null and empty have none."""
    plain = plain_spans(text or "")
    added = added_spans(text, plain) if text else {}
    return plain, {kind: sorted(plain[kind] + added.get(kind, [])) for kind in KINDS} if added else plain


def detect(df: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Spans per row of `df`: `id`, `n_<kind>` (plain spans), `base_sha256`, `spans`, `n_added`.

    One narrow pass over whole texts. A null or empty text has no spans; equal texts have
    equal spans; only `id` and `text` are read.
    """
    names = [id, *(f"n_{kind}" for kind in KINDS), "base_sha256", "spans", "n_added"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, digests, listed, extra = [[] for _ in KINDS], [], [], []
            for t in batch.column(1):
                plain, spans = find(t.as_py())
                for column, kind in zip(counts, KINDS):
                    column.append(len(plain[kind]))
                digests.append(hashlib.sha256(_listed(plain).encode()).hexdigest())
                listed.append(_listed(spans))
                extra.append(sum(map(len, spans.values())) - sum(map(len, plain.values())))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, pa.int64()) for c in counts), pa.array(digests, pa.string()),
                 pa.array(listed, pa.string()), pa.array(extra, pa.int64())], names)

    kind = df.schema[id].dataType.simpleString()
    counts = ", ".join(f"n_{k} bigint" for k in KINDS)
    return df.select(id, text).mapInArrow(
        run, f"`{id}` {kind}, {counts}, base_sha256 string, spans string, n_added bigint")


def mask(text: str | None) -> str | None:
    """The text with every span replaced by `<kind>`; of overlapping spans the first, then the longest."""
    if not text:
        return text
    _, spans = find(text)
    flat = sorted((start, -end, kind) for kind in KINDS for start, end in spans[kind])
    if not flat:
        return text
    parts, done = [], 0
    for start, end, kind in flat:
        if start >= done:
            parts += [text[done:start], f"<{kind}>"]
            done = -end
        elif -end > done:                      # the rest of an overlapping span goes too
            done = -end
    parts.append(text[done:])
    return "".join(parts)


@F.pandas_udf(StringType())
def _masked(texts: pd.Series) -> pd.Series:
    return texts.map(mask, na_action="ignore")


def redact(df: DataFrame, text: str = "text", into: str | None = None) -> DataFrame:
    """`df` with its text masked, in place or in column `into`. Rows, order of columns and
    all other columns stay; null stays null."""
    return df.withColumn(into or text, _masked(F.col(text)))

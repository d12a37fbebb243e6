"""Personal data in texts, also behind disguises, at its place in the source.

The base rules find e-mail addresses, IP addresses, card and phone numbers as
they are written. A chain of small transducers then rewrites a text into the
form the writer had in mind: look-alike characters become the ones they look
like, invisible ones vanish, spelled digits become digits, ``(at)`` and
``dot`` become signs. Every rewriting carries, for each character of its
output, the stretch of the source that it stands for, so what the same rules
find in the normalised text is mapped back to source offsets. Texts without
any trace of a disguise skip the chain.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import hidden

KINDS = ("email", "ip", "card", "phone")

# ---------------------------------------------------------------- base rules
# The patterns are the contract's; possessive runs and borders only keep them linear on long runs.
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_LOCAL_END = re.compile(r"[^A-Za-z0-9._%+-]")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")

Span = tuple[str, int, int]


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Around every ``@``: the run of local characters before it, and a domain behind it."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and not _LOCAL_END.match(text, start - 1):
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            free = domain.end()
        at = text.find("@", max(at + 1, free))


def _luhn(digits: str) -> bool:
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)) % 10 == 0


def _digits(text: str, start: int, end: int) -> str:
    return re.sub(r"[^0-9]", "", text[start:end])


def plain_spans(text: str) -> list[Span]:
    """What the base rules find, by kind as listed, then by start."""
    out: list[Span] = []
    if "@" in text:
        out += [("email", a, b) for a, b in _emails(text)]
    if not _DIGIT.search(text):
        return out
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) < 4 and int(p) <= 255 for p in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = _digits(text, *m.span())
            if 16 <= len(digits) <= 19 and _luhn(digits):
                out.append(("card", *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= len(_digits(text, *m.span())) <= 15:
                out.append(("phone", *m.span()))
    return out


# ---------------------------------------------------------------- transducers

# Cyrillic, Greek and other letters that look like an ASCII one.
_LOOKALIKES = dict(zip(
    "аеорсухіјѕԁһԛԝӏвкмнтАВЕКМНОРСТУХІЈЅαορνικτυχΑΒΕΖΗΙΚΜΝΟΡΤΥΧıɡ",
    "aeopcyxijsdhqwlbkmhtABEKMHOPCTYXIJSaopvikTuxABEZHIKMNOPTYXig".replace("T", "t", 1), strict=True))
_INVISIBLE = "­​‌‍‎‏⁠⁡⁢⁣⁤﻿᠎"
_MARKS = {"‐": "-", "‑": "-", "‒": "-", "–": "-", "—": "-", "−": "-", "－": "-",
          " ": " ", " ": " ", " ": " ", " ": " ", " ": " ", "　": " ",
          "․": ".", "。": ".", "．": ".", "·": ".", "＠": "@", "﹫": "@", "＋": "+"}
_LETTERS = re.compile("[" + "".join(map(re.escape, [*_LOOKALIKES, *_MARKS])) + _INVISIBLE
                      + "٠-٩۰-۹०-९⁰¹²³⁴-⁹₀-₉"
                      + "①-⑨０-９Ａ-Ｚａ-ｚ＿\U0001d400-\U0001d7ff]")

# Digits in words (English, German, French, Spanish), and signs in words.
_SPELLED = {w: str(d) for words in (
    "zero one two three four five six seven eight nine", "null eins zwei drei vier fünf sechs sieben acht neun",
    "zéro un deux trois quatre cinq six sept huit neuf", "cero uno dos tres cuatro cinco seis siete ocho nueve")
    for d, w in enumerate(words.split())} | {"oh": "0", "nought": "0", "zwo": "2", "zero": "0", "six": "6"}
_NUMBER = "(?:" + "|".join(sorted(_SPELLED, key=len, reverse=True)) + ")"
_DOT_WORDS, _AT_WORDS = "dot|punkt|point|punto", "at|arobase|arroba"
_GAP = r"(?:[\x20\t]{1,3}|\n)"  # between the words of an address
_ITEM = rf"(?:{_NUMBER}|[0-9]+|{_DOT_WORDS})"
# a run of digits in words: seven items at least, so that prose about one or two stays as it is
_COUNTING = "0123456789" + "9876543210"
_SPELLED_RUN = re.compile(rf"(?i)\b(?:plus[\s-]+)?{_ITEM}(?:[\s,-]+{_ITEM}){{6,}}\b")
_BRACKETED = re.compile(
    rf"(?i)[\x20]?[\[({{<]\s?(?:(?P<at>{_AT_WORDS}|@)|(?:{_DOT_WORDS}|\.))\s?[\])}}>][\x20]?"
    rf"|[_*~-](?:(?P<at2>{_AT_WORDS})|(?:{_DOT_WORDS}))[_*~-]|(?P<at3>&\#64;|&\#x40;|&commat;)|&\#46;|&\#x2e;|&period;")
# an address in words is looked for from its at sign outwards, so no run of names is walked twice
_SIGN = re.compile(rf"(?i){_GAP}(?P<sign>{_AT_WORDS}|@){_GAP}|@")
_HOST = re.compile(rf"(?i)[A-Za-z0-9-]{{1,63}}+(?:(?:\.|{_GAP}(?:{_DOT_WORDS}){_GAP})[A-Za-z0-9-]{{1,63}}+){{1,8}}+")
_DOT_BETWEEN = re.compile(rf"(?i){_GAP}(?P<dot>{_DOT_WORDS}){_GAP}")
_DOT_BEFORE = re.compile(rf"(?i)[A-Za-z0-9_%+-]{_GAP}(?:{_DOT_WORDS}){_GAP}$")
_NAME_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# Last labels that a spoken address ends in (those that are everyday words are left out),
# and everyday English words around "at" that are neither a name nor a host.
_ENDINGS = frozenset(
    "com org net edu gov mil info biz name pro dev app io ai eu de fr es uk ch nl pl cz se dk fi pt gr ru ua cn jp kr br mx ar "
    "cl ca au nz za ie lu hu ro bg hr sk si ee lv lt tr il sg hk tw".split())
_EVERYDAY = frozenset(
    "a an the this that these those one some any every each no all both another what which whose my your his her its our their "
    "i you he she it we they me him us them here there where when once only just not now then still and or but as than so if "
    "is are was were be been being am do does did has have had look looks looked looking arrive arrives arrived arriving stay "
    "stays stayed live lives lived work works worked working stop stops stopped start starts started point points pointed aim "
    "aimed stare stared glance glanced sold buy bought found find see saw seen held meet met visit visited available based "
    "best least last first most".split())
_DOTTED_IP = re.compile(rf"(?i)(?<![0-9.])[0-9]{{1,3}}(?:\s?(?:\.|\b(?:{_DOT_WORDS})\b)\s?[0-9]{{1,3}}){{3}}(?![0-9])")
_GROUPED = re.compile(r"(?<![0-9])[0-9]{4}([._/|])[0-9]{4}(?:\1[0-9]{4}){2}(?![0-9])")
_CONFUSED = re.compile(r"(?<![A-Za-z0-9])(?=[A-Za-z\x20-]{0,19}[0-9])[0-9OoQlI](?:[\x20-]?[0-9OoQlI]){14,22}(?![A-Za-z0-9])")
_TRACE = re.compile(
    rf"(?i)[\[({{<]\s?(?:{_AT_WORDS}|{_DOT_WORDS}|@|\.)\s?[\])}}>]|{_GAP}(?:{_DOT_WORDS}){_GAP}[A-Za-z0-9]"
    rf"|{_GAP}(?:{_AT_WORDS}|@){_GAP}[A-Za-z0-9-]+\.[A-Za-z0-9]|[_*~-](?:{_DOT_WORDS})[_*~-]|&(?:\#64|\#x40|commat|\#46|\#x2e|period);")
_COUNTED = frozenset(_SPELLED) | frozenset(_DOT_WORDS.split("|"))
_BETWEEN = str.maketrans("-,", "  ")


@dataclass
class Rewritten:
    """A text and, per character, the stretch of the source that it stands for."""

    text: str
    start: np.ndarray
    end: np.ndarray
    changed: np.ndarray

    @classmethod
    def source(cls, text: str) -> Rewritten:
        at = np.arange(len(text) + 1)
        return cls(text, at[:-1], at[1:], np.zeros(len(text), bool))

    def rewrite(self, pattern: re.Pattern, to) -> Rewritten:
        """Every match becomes ``to(match)``; its characters stand for the whole match."""
        return self.replace((*m.span(), to(m)) for m in pattern.finditer(self.text))

    def replace(self, places: Iterable[tuple[int, int, str | None]]) -> Rewritten:
        """Every ``(start, end, out)``, in order and apart, becomes ``out`` (None: stays)."""
        parts, starts, ends, changed, last = [], [], [], [], 0
        for a, b, out in places:
            if out is None or out == self.text[a:b]:
                continue
            parts += (self.text[last:a], out)
            starts += (self.start[last:a], np.full(len(out), self.start[a]))
            ends += (self.end[last:a], np.full(len(out), self.end[b - 1]))
            changed += (self.changed[last:a], np.ones(len(out), bool))
            last = b
        if not parts:
            return self
        parts.append(self.text[last:])
        return Rewritten("".join(parts), np.concatenate([*starts, self.start[last:]]),
                         np.concatenate([*ends, self.end[last:]]), np.concatenate([*changed, self.changed[last:]]))


def _letter(m: re.Match) -> str:
    c = m[0]
    if c in _INVISIBLE:
        return ""
    known = _LOOKALIKES.get(c) or _MARKS.get(c)
    if known:
        return known
    digit = unicodedata.digit(c, None)
    plain = str(digit) if digit is not None else unicodedata.normalize("NFKC", c)
    return _LOOKALIKES.get(plain, plain) if len(plain) == 1 else c


def _bracket(m: re.Match) -> str:
    return "@" if m["at"] or m["at2"] or m["at3"] else "."


def _name_start(text: str, end: int, free: int) -> int:
    """Where the name before an at sign begins: pieces joined by a dot or a dot in words, nine at most."""
    start = end
    for _ in range(9):
        run = start
        while run > free and text[run - 1] in _NAME_CHARS:
            run -= 1
        while run < start and text[run] == ".":
            run += 1
        if run == start:
            break
        start = run
        before = _DOT_BEFORE.search(text, max(free, start - 16), start)
        if not before:
            return start
        end, start = start, before.start() + 1
    return start if start < end and text[start:start + 1] in _NAME_CHARS else end


def _addresses(text: str) -> Iterator[tuple[int, int, str]]:
    """Addresses in words, ``name at host dot com``, as places with what they stand for.

    ``at`` and ``dot`` are everyday words, so both in words count only before
    an ending that spoken addresses have, and not between everyday words
    ("look at this dot com bubble"); "point" and "punto" need a sign that
    isn't everyday ("at some point we ..."). With plain dots the name must
    look like one ("look at example.com").
    """
    free = 0
    for sign in _SIGN.finditer(text):
        if sign.start() < free:
            continue
        host = _HOST.match(text, sign.end())
        if not host:
            continue
        start = _name_start(text, sign.start(), free)
        if start == sign.start():
            continue
        name, word = text[start:sign.start()], (sign["sign"] or "@").lower()
        in_host = {m["dot"].lower() for m in _DOT_BETWEEN.finditer(host[0])}
        in_words = in_host | {m["dot"].lower() for m in _DOT_BETWEEN.finditer(name)}
        if not in_words and sign[0] == "@":
            continue  # as written
        ends = re.split(rf"(?i)\.|{_GAP}(?:{_DOT_WORDS}){_GAP}", host[0])
        if in_host and ends[-1].lower() not in _ENDINGS:
            continue
        if word == "at":
            if in_words & {"point", "punto"}:
                continue
            if in_host and (name.lower() in _EVERYDAY or ends[0].lower() in _EVERYDAY) or not in_host and not re.search(r"[0-9._]", name):
                continue
        elif word != "@" and not in_host and not re.search(r"[0-9._]", name):
            continue
        free = host.end()
        yield start, free, f"{_DOT_BETWEEN.sub('.', name)}@{_DOT_BETWEEN.sub('.', host[0])}"


def _spelled(m: re.Match) -> str:
    def item(x: re.Match) -> str:
        w = x[0].lower()
        return _SPELLED.get(w, "." if re.fullmatch(_DOT_WORDS, w) else "+" if w == "plus" else w)
    digits = re.sub(r"[\s,-]+", "", re.sub(r"(?i)[a-zéü]+", item, m[0]))
    # a number written out in words is one to call, unless it counts up or down or repeats a word
    if digits.isdigit() and 8 <= len(digits) <= 15 and len(set(digits)) >= 3 and not _DIGIT.search(m[0]) and digits not in _COUNTING:
        return "+" + digits
    return digits


def _dotted(m: re.Match) -> str:
    return re.sub(rf"(?i)\s?(?:\.|\b(?:{_DOT_WORDS})\b)\s?", ".", m[0])


def _unconfused(m: re.Match) -> str | None:
    if 2 * len(_DIGIT.findall(m[0])) < len(re.sub(r"[\x20-]", "", m[0])):
        return None
    return m[0].translate(str.maketrans("OoQlI", "00011"))


def normalise(text: str) -> Rewritten:
    r = Rewritten.source(text).rewrite(_LETTERS, _letter)
    r = r.rewrite(_SPELLED_RUN, _spelled).rewrite(_BRACKETED, _bracket)
    r = r.replace(_addresses(r.text))
    r = r.rewrite(_DOTTED_IP, _dotted).rewrite(_GROUPED, lambda m: m[0].replace(m[1], " "))
    return r.rewrite(_CONFUSED, _unconfused)


def _counts_in_words(text: str, part: int = 1 << 20, overlap: int = 256) -> bool:
    """Whether seven numbers follow each other, three of them as words; in overlapping parts of the text."""
    return any(_run_of_numbers(text[at:at + part + overlap]) for at in range(0, len(text), part))


def _run_of_numbers(text: str) -> bool:
    words = text.lower().translate(_BETWEEN).split()
    if _COUNTED.isdisjoint(words):
        return False
    run = spelled = 0
    for w in words:
        w = w.strip(".;:!?()")
        if w in _COUNTED or w.isdigit():
            run, spelled = run + 1, spelled + (w in _COUNTED)
            if run >= 7 and spelled >= 3:
                return True
        else:
            run = spelled = 0
    return False


def _disguised(text: str) -> bool:
    return bool(_TRACE.search(text) or _LETTERS.search(text) or _DIGIT.search(text) and (_CONFUSED.search(text) or _GROUPED.search(text))
                or _counts_in_words(text))


def spans(text: str | None) -> tuple[list[Span], list[Span]]:
    """``(base, all)`` spans in code points, end exclusive, by kind as listed, then by place (null: none)."""
    text = text or ""
    base = plain_spans(text)
    if not _disguised(text):
        return base, base
    r = normalise(text)
    found = list(base)
    for kind, a, b in plain_spans(r.text) if r.text != text else ():
        start, end = int(r.start[a]), int(r.end[b - 1])
        if not r.changed[a:b].any() and end - start == b - a:
            continue  # as written: the base rules have had their say
        if any(s <= start and end <= e for _, s, e in found):
            continue
        found.append((kind, start, end))
    return base, sorted(found, key=lambda s: (KINDS.index(s[0]), s[1], s[2]))


def redacted(text: str | None) -> str | None:
    """The text with a ``[KIND]`` mark for every stretch of spans that touch or overlap."""
    if not text:
        return text
    out, last = [], 0
    for start, end, kind in sorted((a, b, k) for k, a, b in spans(text)[1]):
        if start < last:  # goes on in the stretch before
            last = max(last, end)
            continue
        out += (text[last:start], f"[{kind.upper()}]")
        last = end
    return "".join([*out, text[last:]]) if out else text


# ---------------------------------------------------------------- on tables

_FOUND_DDL = ("doc_id long, base array<struct<kind:string,start:long,end:long>>, "
              "spans array<struct<kind:string,start:long,end:long>>")
_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def _rows(found: list[list[Span]]) -> pa.Array:
    return pa.array([[{"kind": k, "start": a, "end": b} for k, a, b in f] for f in found], _SPANS)


def find_private_data(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, base, spans)`` per document: what the base rules find, and that with what was disguised.

    One pass over the texts, no shuffle. Null and empty texts have no spans.
    Null and repeated keys are ordinary rows; an empty table gives none;
    further columns are not read.
    """
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = [spans(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), _rows([b for b, _ in both]), _rows([a for _, a in both])],
                names=["doc_id", "base", "spans"])
    return docs.select(F.col(key).cast("long").alias("doc_id"), text).mapInArrow(run, _FOUND_DDL)


def redact(docs: DataFrame, text: str = "text", n_chars: str = "n_chars") -> DataFrame:
    """``docs`` with personal data marked in the text, and ``n_chars`` (if there is one) of the new text."""
    mask = F.pandas_udf(lambda s: s.map(redacted, na_action="ignore"), "string")
    mine = hidden(docs, stem="masked")
    out = docs.withColumn(mine, mask(F.col(f"`{text}`")))
    columns = []
    for c in docs.columns:
        if c == text:
            columns.append(F.col(mine).alias(c))
        elif c == n_chars:
            columns.append(F.length(mine).cast(docs.schema[c].dataType).alias(c))
        else:
            columns.append(F.col(f"`{c}`"))
    return out.select(*columns)


def op9(docs: DataFrame) -> DataFrame:
    found = find_private_data(docs)
    line = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *map(count, KINDS), F.sha2(line("base"), 256).alias("base_sha256"),
                        line("spans").alias("spans"))

"""Personal data in texts, plain and disguised, with spans in the source text.

Plain finders read the text as it is.  A transducer rewrites disguises (look-alike
letters, spelled digits, ``at`` and ``dot`` in words or brackets, invisible
characters) and records, for each character it writes, the source characters it
stands for; the same finders read its output and their spans are mapped back.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from flowvec.llm.common import in_chunks, text_of

KINDS = ("email", "ip", "card", "phone")
Span = tuple[int, int, int]  # rank of the kind, start, end

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# Starting inside a run of digits cannot succeed where its start has failed.
ADDRESS = re.compile(r"(?<![0-9])([0-9]+)\.([0-9]+)\.([0-9]+)\.([0-9]+)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
NOT_DIGIT = re.compile(r"[^0-9]+")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Around each ``@``: the longest run before it, the domain after it."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        found = DOMAIN.match(text, at + 1) if start < at else None
        free = found.end() if found else at + 1
        if found:
            yield start, free
        at = text.find("@", free)


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def plain_spans(text: str) -> list[Span]:
    """Spans of all kinds, by kind and start."""
    spans = [(0, a, b) for a, b in emails(text)]
    for m in ADDRESS.finditer(text):
        if all(len(part.lstrip("0")) <= 3 and int(part) <= 255 for part in m.groups()):
            spans.append((1, *m.span()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 13 and 13 <= len(digits := NOT_DIGIT.sub("", m[0])) <= 19 and luhn(digits):
            spans.append((2, *m.span()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= len(NOT_DIGIT.sub("", m[0])) <= 15:
                spans.append((3, *m.span()))
    return spans


# Letters of other scripts that look like Latin ones.
LOOKALIKES = dict(
    zip(
        "аеорсухіјѕԁһԛԝοναρικ"
        "АВЕКМНОРСТХІЈЅΑΒΕΗΙΚΜΝΟΡΤΧ",
        "aeopcyxijsdhqwovapikABEKMHOPCTXIJSABEHIKMNOPTX",
        strict=True,
    )
)
INVISIBLE = "​‌‍⁠﻿­"
DIGITS = {w: str(d) for d, w in enumerate("zero one two three four five six seven eight nine".split())} | {"oh": "0"}
WORD = "(?:" + "|".join(DIGITS) + ")"
OPEN, SHUT = r"[\[({{<]\x20*", r"\x20*[\])}}>]"
OPEN, SHUT = OPEN.replace("{{", "{"), SHUT.replace("}}", "}")
AT = rf"\x20*{OPEN}(?:at|@){SHUT}\x20*|(?<=[a-z0-9])\x20+at\x20+(?=[a-z0-9-]+(?:\x20+dot\x20+|\x20*{OPEN}(?:dot|\.){SHUT}\x20*|\.)[a-z0-9-])"
DOT = rf"\x20*{OPEN}(?:dot|\.){SHUT}\x20*|(?<=[a-z0-9])\x20+dot\x20+(?=[a-z0-9])"
SEP = r"[\x20,-]+"
POINT = rf"\x20*{OPEN}(?:dot|\.){SHUT}\x20*|\x20+dot\x20+"
NUMBER = rf"\b(?:{WORD}|[0-9]++)\b"
# A whole run of spelled and plain digits; spelled_run() decides what of it is rewritten.
SPELLED = rf"(?:\bplus[\x20-]+|\+\x20*)?{NUMBER}(?:(?:{POINT}|\.|{SEP}){NUMBER})*"
FOREIGN = "".join(LOOKALIKES) + INVISIBLE + "！-～\U0001d400-\U0001d7ff"
RULES = re.compile(rf"(?P<spelled>{SPELLED})|(?P<at>{AT})|(?P<dot>{DOT})|(?P<glyph>[{FOREIGN}])", re.I)
GLYPH = re.compile(f"[{FOREIGN}]")
# Read on the case-folded text: something of whatever RULES rewrites, so that no text with a disguise is passed by.
HINT = re.compile(
    rf"dot|[\[({{<]\x20*(?:at|@|\.)\x20*[\])}}>]|\x20at\x20+[a-z0-9-]+\.[a-z0-9-]|{WORD}(?:{SEP}{WORD}){{6}}"
    rf"|{WORD}(?:\.{WORD}|(?:\.|{SEP})[0-9])|[0-9](?:\.|{SEP}){WORD}"
)
RUN_PART = re.compile(rf"(?P<plus>\A(?:plus[\x20-]+|\+\x20*))|(?P<word>{WORD})|(?P<number>[0-9]+)|(?P<dot>{POINT}|\.)|(?P<sep>{SEP})", re.I)
LONE_WORD = re.compile(rf"{SEP}{WORD}|{WORD}{SEP}", re.I)


@lru_cache(maxsize=4096)
def plain_glyph(c: str) -> str:
    """The ASCII character that ``c`` looks like; invisible ones vanish, others stay."""
    if c in INVISIBLE:
        return ""
    form = LOOKALIKES.get(c) or unicodedata.normalize("NFKC", c)
    return LOOKALIKES.get(form, form) if len(form) == 1 else c


def spelled_run(run: str) -> list[tuple[str, int, int]]:
    """What a run of spelled and plain digits stands for, with source spans; empty if it stays.

    Spelled digits count where a plus, a point or plain digits join them, or
    seven stand in a row; fewer alone are numbers in prose.
    """
    found = [(m.lastgroup, *m.span()) for m in RUN_PART.finditer(run)]
    kinds = [kind for kind, _, _ in found]
    words = kinds.count("word")
    if words < 7 and not {"plus", "dot", "number"} & set(kinds):
        return []
    if not words and not any(kind == "dot" and y - x > 1 for kind, x, y in found):
        return []
    out = []
    for i, (kind, x, y) in enumerate(found):
        if kind == "word":
            out.append((DIGITS[run[x:y].casefold()], x, y))
        elif kind == "dot":
            out.append((".", x, y))
        elif kind == "plus" and words:
            out.append(("+", x, x + len(run[x:y].rstrip(" -"))))
        elif kind != "sep" or "word" not in kinds[i - 1 : i + 2]:
            out += [(run[c], c, c + 1) for c in range(x, y)]
    return out


def transduce(text: str) -> tuple[str, list[int], list[int]] | None:
    """The text without disguises, with the source start and end of each of its characters.

    None if nothing is disguised.
    """
    glyphs = None if text.isascii() else GLYPH.search(text)
    if not glyphs and not HINT.search(text.casefold()):
        return None
    if glyphs:
        # Letters first, so that a disguised word is still a word for the rules below.
        out, starts, ends = [], [], []
        for i, c in enumerate(text):
            for p in plain_glyph(c) if c in LOOKALIKES or GLYPH.match(c) else c:
                out.append(p)
                starts.append(i)
                ends.append(i + 1)
        text = "".join(out)
    else:
        starts, ends = list(range(len(text))), list(range(1, len(text) + 1))
    out, first, last, done, changed = [], [], [], 0, bool(glyphs)
    for m in RULES.finditer(text):
        a, b = m.span()
        if m["spelled"]:
            parts = [(p, a + x, a + y) for p, x, y in spelled_run(m[0])]
            if not parts:
                continue
        elif m["at"] or m["dot"]:
            parts = [("@" if m["at"] else ".", a, b)]
        else:
            continue
        changed = True
        out.append(text[done:a])
        first += starts[done:a]
        last += ends[done:a]
        for p, x, y in parts:
            out.append(p)
            first.append(starts[x])
            last.append(ends[y - 1])
        done = b
    if not changed:
        return None
    out.append(text[done:])
    return "".join(out), first + starts[done:], last + ends[done:]


def all_spans(text: str) -> tuple[list[Span], list[Span]]:
    """Plain spans, and those that only the text without disguises shows."""
    base = plain_spans(text)
    rewritten = transduce(text)
    if rewritten is None:
        return base, []
    plain, starts, ends = rewritten
    known = {}
    for kind, a, b in base:
        known.setdefault(kind, []).append((a, b))
    more = []
    for kind, a, b in plain_spans(plain):
        source = starts[a], ends[b - 1]
        if text[source[0] : source[1]] == plain[a:b]:
            continue  # as in the source: the plain finders have judged it
        near = known.get(kind, ())
        if any(x <= source[0] and source[1] <= y for x, y in near):
            continue
        # A whole number beside a lone digit word ("+49 30 1234567 one of us") ends before the word.
        if any(source[0] <= x and y <= source[1] and LONE_WORD.fullmatch(text[source[0] : x] + text[y : source[1]]) for x, y in near):
            continue
        more.append((kind, *source))
    return base, more


def listed(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans))


SCHEMA = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, n_disguised long, base_sha256 string, spans string"


def _report(rows: pa.Table) -> pa.Table:
    out = []
    for doc_id, text in zip(rows["doc_id"].to_pylist(), rows["text"].to_pylist(), strict=True):
        base, more = all_spans(text)
        counts = [sum(k == rank for k, _, _ in base) for rank in range(len(KINDS))]
        sha = hashlib.sha256(listed(base).encode()).hexdigest()
        out.append((doc_id, *counts, len(more), sha, listed(base + more)))
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    kinds = [pa.int64()] * 6 + [pa.string()] * 2
    columns = list(zip(*out, strict=True)) or [[] for _ in names]
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def find_personal(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs`` with counts and spans of personal data.

    Counts and ``base_sha256`` cover the plain spans, ``n_disguised`` the added
    ones, ``spans`` all, as ``kind:start:end`` by kind and start in code points
    of the source, the end exclusive.  Null text counts as empty and has no
    spans; a null id stays null; repeated rows are read one by one.  Other
    columns are not read.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    return rows.mapInArrow(in_chunks(_report), SCHEMA)


def masked(text: str) -> str:
    """The text with each personal span replaced by the name of its kind."""
    base, more = all_spans(text)
    out, done = [], 0
    for kind, a, b in sorted(base + more, key=lambda s: (s[1], -s[2])):
        if b <= done:
            continue
        out.append(text[done : max(a, done)])
        out.append(f"<{KINDS[kind].upper()}>")
        done = b
    return "".join(out) + text[done:] if done else text


def mask_personal(docs: DataFrame, text_col: str = "text", length_col: str = "n_chars") -> DataFrame:
    """``docs`` with personal data masked in the text; a null text stays null.

    ``length_col``, if there is one of whole numbers, follows the new text; of
    another type it stays as it is, like all other columns.  Empty texts and ids,
    null or repeated, stay too; an empty table gives an empty result.
    """
    schema = docs.schema
    counted = length_col in docs.columns and isinstance(schema[length_col].dataType, IntegralType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(text_col)
            texts = [t if t is None else masked(t) for t in batch.column(at).to_pylist()]
            columns = list(batch.columns)
            columns[at] = pa.array(texts, batch.schema.field(at).type)
            if counted:
                n = batch.schema.get_field_index(length_col)
                lengths = [None if t is None else len(t) for t in texts]
                columns[n] = pa.array(lengths, batch.schema.field(n).type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return docs.mapInArrow(run, schema)

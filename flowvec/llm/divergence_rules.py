"""Quality rules: counts of a text, and its divergence from its language.

References come from the whole table: for each language the histogram of
character classes and of its most common words.  A document is compared with its
language by the Jensen-Shannon divergence (base 2, so 0 to 1) of both
histograms; short documents are not, since their histograms say little.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowvec.llm.common import BLANKS, in_chunks, text_of, write_table

BLANK = re.compile(BLANKS)
SYMBOLS = "#*$%&|<>"
CLASSES = ("blank", "lower", "upper", "digit", "stop", "mark", "symbol", "accented", "other")
# References kept for the largest languages only, so that their size is bounded;
# documents of any further language are compared with the whole table.
LANGUAGES = 256


@dataclass(frozen=True)
class Limits:
    """Guards and thresholds of the rules."""

    least_words: int = 20
    repeated_percent: int = 30
    # Below these lengths no histogram is compared.
    least_chars: int = 300
    least_compared_words: int = 60
    char_divergence: float = 0.1
    word_divergence: float = 0.3


@dataclass(frozen=True)
class References:
    """Shares by language: character classes, common words with the share of the rest last."""

    chars: dict[str, np.ndarray]
    words: dict[str, dict[str, int]]
    shares: dict[str, np.ndarray] = field(default_factory=dict)


def class_table() -> np.ndarray:
    """The class of each code point below 65,536; all above are ``other``."""
    kinds = np.full(65536, CLASSES.index("other"), np.uint8)
    for code in range(65536):
        c = chr(code)
        if c in " \t\n\v\f\r":
            kind = "blank"
        elif c.isalpha():
            if code > 127:
                kind = "accented" if code < 0x250 else "other"
            else:
                kind = "lower" if c.islower() else "upper"
        elif c in "0123456789":
            kind = "digit"
        elif c in ".,":
            kind = "stop"
        elif c in SYMBOLS:
            kind = "symbol"
        elif code < 128 and c.isprintable():
            kind = "mark"
        else:
            continue
        kinds[code] = CLASSES.index(kind)
    return kinds


_TABLE: list[np.ndarray] = []


def class_counts(text: str) -> np.ndarray:
    if not _TABLE:
        _TABLE.append(class_table())
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.bincount(_TABLE[0][np.minimum(codes, 65535)], minlength=len(CLASSES))


def divergence(p: np.ndarray, q: np.ndarray) -> float:
    """Jensen-Shannon divergence of two histograms, in bits."""
    p, q = p / max(p.sum(), 1e-300), q / max(q.sum(), 1e-300)
    m = (p + q) / 2

    def to_middle(a: np.ndarray) -> float:
        there = a > 0
        return float((a[there] * np.log2(a[there] / m[there])).sum())

    return (to_middle(p) + to_middle(q)) / 2


def _class_sums(rows: pa.Table) -> pa.Table:
    sums: dict[str, np.ndarray] = {}
    for lang, text in zip(rows["lang"].to_pylist(), rows["text"].to_pylist(), strict=True):
        sums[lang] = sums.get(lang, 0) + class_counts(text)
    langs = [lang for lang in sums for _ in CLASSES]
    counts = [int(n) for lang in sums for n in sums[lang]]
    return pa.table({"lang": langs, "class": pa.array([*range(len(CLASSES))] * len(sums), pa.int32()), "n": pa.array(counts, pa.int64())})


def references(rows: DataFrame, common: int) -> References:
    """Histograms over all rows of ``lang, text``, at most ``LANGUAGES`` languages and the whole table (``None``)."""
    sums = rows.mapInArrow(in_chunks(_class_sums), "lang string, class int, n long")
    sums = write_table(sums.groupBy("lang", "class").agg(F.sum("n").alias("n")), "char-classes")
    large = sums.groupBy("lang").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "lang").limit(LANGUAGES).select("lang")
    words = rows.select("lang", F.explode(F.split(F.lower("text"), BLANKS)).alias("word")).where("word <> ''")
    counts = write_table(words.groupBy("lang", "word").agg(F.count(F.lit(1)).alias("n")), "word-counts")
    best = Window.partitionBy("lang").orderBy(F.desc("n"), "word")
    kept = counts.join(F.broadcast(large), "lang").withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= common)
    whole = counts.groupBy("word").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "word").limit(common)
    totals = {r["lang"]: r["n"] for r in counts.groupBy("lang").agg(F.sum("n").alias("n")).join(F.broadcast(large), "lang").collect()}
    totals[None] = (counts.agg(F.sum("n")).first() or [0])[0] or 0
    chars = {r["lang"]: np.zeros(len(CLASSES)) for r in large.collect()} | {None: np.zeros(len(CLASSES))}
    for r in sums.join(F.broadcast(large), "lang").collect():
        chars[r["lang"]][r["class"]] = r["n"]
    for r in sums.groupBy("class").agg(F.sum("n").alias("n")).collect():
        chars[None][r["class"]] = r["n"]
    found: dict = {}
    for r in kept.select("lang", "word", "n").collect():
        found.setdefault(r["lang"], []).append((r["n"], r["word"]))
    found[None] = [(r["n"], r["word"]) for r in whole.collect()]
    index, shares = {}, {}
    for lang, pairs in found.items():
        pairs.sort(key=lambda p: (-p[0], p[1]))
        index[lang] = {w: i for i, (_, w) in enumerate(pairs)}
        n = np.array([p[0] for p in pairs], float)
        shares[lang] = np.append(n, totals.get(lang, n.sum()) - n.sum())
    return References(chars, index, shares)


def repeated_words(words: list[str]) -> int:
    """Words inside windows of eight words that occur twice or more.

    Windows are named exactly by doubling: pairs of words, pairs of pairs, and
    pairs of those get whole numbers.
    """
    if len(words) < 9:
        return 0
    ids: dict[str, int] = {}
    names = np.array([ids.setdefault(w, len(ids)) for w in words], np.int64)
    for width in (1, 2, 4):
        names = names[:-width] * (int(names.max()) + 1) + names[width:]
        _, names, counts = np.unique(names, return_inverse=True, return_counts=True)
        if counts.max() == 1:
            return 0
    starts = np.flatnonzero(counts[names] > 1)
    edges = np.zeros(len(words) + 1, np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + 8, -1)
    return int((np.cumsum(edges)[:-1] > 0).sum())


def judge(text: str, lang: str, refs: References, limits: Limits) -> tuple:
    """Counts, divergences (None where guarded) and verdicts of one text."""
    words = [w for w in BLANK.split(text) if w]
    classes = class_counts(text)
    lines = [line for line in text.split("\n") if BLANK.sub("", line)]
    repeated = repeated_words(words)
    failed = len(words) < limits.least_words or 100 * repeated > limits.repeated_percent * len(words)
    lang = lang if lang in refs.words else None
    by_chars = by_words = None
    if len(text) >= limits.least_chars and len(words) >= limits.least_compared_words:
        by_chars = divergence(classes, refs.chars[lang])
        index = refs.words[lang]
        seen = np.zeros(len(index) + 1)
        for w in words:
            seen[index.get(w.lower(), -1)] += 1
        by_words = divergence(seen, refs.shares[lang])
    strange = by_chars is not None and (by_chars > limits.char_divergence or by_words > limits.word_divergence)
    return (
        len(words), len(text) - int(classes[0]), int(classes[CLASSES.index("symbol")]), len(lines) - len(set(lines)),
        repeated, by_chars, by_words, failed, not (failed or strange),
    )


VERDICT = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "char_divergence double, word_divergence double, base_failed boolean, kept boolean"
)
_TYPES = [pa.int64()] * 5 + [pa.float64()] * 2 + [pa.bool_()] * 2


def _judged(refs: References, limits: Limits):
    def work(rows: pa.Table) -> pa.Table:
        found = [
            judge(text, lang, refs, limits)
            for lang, text in zip(rows["lang"].to_pylist(), rows["text"].to_pylist(), strict=True)
        ]
        columns = list(zip(*found, strict=True)) or [[] for _ in _TYPES]
        out = rows.drop_columns(["lang", "text"])
        for name, kind, column in zip(VERDICT.split(", "), _TYPES, columns, strict=True):
            out = out.append_column(name.split()[0], pa.array(column, kind))
        return out

    return work


def quality(docs: DataFrame, common: int = 64, limits: Limits = Limits()) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, the counts, both divergences and the verdicts.

    Null text has no words and fails; a null language is one of its own.  An
    empty table gives an empty result.  Repeated rows are judged one by one.
    Other columns are not read.
    """
    lang = F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("lang")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), lang, text_of().alias("text"))
    refs = references(rows.select("lang", "text"), common)
    return rows.mapInArrow(in_chunks(_judged(refs, limits)), f"doc_id long, {VERDICT}")


def keep_good(docs: DataFrame, common: int = 64, limits: Limits = Limits()) -> DataFrame:
    """The rows of ``docs`` that pass, all columns unchanged.

    A null text counts as empty and fails, as it has too few words; a null
    language is one of its own.  Repeated rows are judged one by one, ids are not
    read; an empty table gives an empty result.
    """
    lang = F.coalesce(F.col("lang").cast("string"), F.lit(""))
    refs = references(docs.select(lang.alias("lang"), text_of().alias("text")), common)

    def run(batches):
        for batch in batches:
            langs = batch.column(batch.schema.get_field_index("lang")).to_pylist()
            texts = batch.column(batch.schema.get_field_index("text")).to_pylist()
            kept = [judge(t or "", lang or "", refs, limits)[-1] for lang, t in zip(langs, texts, strict=True)]
            yield batch.filter(pa.array(kept, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)

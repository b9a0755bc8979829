"""Alignment of two tokenizers by products of sparse incidence matrices.

A token occurrence is a row, a byte of the text a column.  The product of the
first tokenizer's matrix with the transpose of the second's, row by row after
Gustavson, holds for each pair of occurrences how many bytes they share: the
overlap links.  Where both tokenizers end a token at one byte the text is cut
into groups; with a column per group instead of one per byte the same product
gives the pairs that share a group.  Links that end together are the overlap
links whose last bytes are one.

Both tokenizers end a token before each space that follows a character other
than a blank, so the words between such spaces are aligned on their own, each
distinct word once while it is remembered, and a text is put together of them.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowvec.llm.byte_backtrack import ByteEncoder, word_pattern
from flowvec.llm.common import in_chunks, no_collector, text_of, write_table
from flowvec.llm.word_transducer import ragged

# Bytes of text whose pairs of ids are counted together, bytes aligned at once, and nonzeros multiplied at once.
PIECE_BYTES = 8_000_000
BYTES_AT_ONCE = 1_000_000
NONZEROS = 1_000_000
# Words remembered by a process, and their bytes.
REMEMBERED_WORDS = 300_000
REMEMBERED_BYTES = 16_000_000
KINDS = ("end", "overlap", "group")


def vocabulary_paths() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@dataclass(frozen=True)
class Csr:
    """A sparse matrix: the nonzeros of row ``i`` stand at ``start[i] : start[i + 1]``."""

    start: np.ndarray
    column: np.ndarray
    value: np.ndarray
    width: int

    @property
    def rows(self) -> int:
        return len(self.start) - 1

    def transpose(self) -> Csr:
        order = np.argsort(self.column, kind="stable")
        counts = np.bincount(self.column, minlength=self.width)
        row = np.repeat(np.arange(self.rows), np.diff(self.start))
        return Csr(np.append(0, np.cumsum(counts)), row[order], self.value[order], self.rows)

    def sizes_times(self, other: Csr) -> np.ndarray:
        """Terms that each row of the product is summed from."""
        upto = np.append(0, np.cumsum(np.diff(other.start)[self.column]))
        return upto[self.start[1:]] - upto[self.start[:-1]]

    def times(self, other: Csr, terms: int = NONZEROS) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Row, column and value of the nonzeros of the product, some rows at a time.

        A row is the sum of the rows of ``other`` that its nonzeros name
        (Gustavson); rows are taken together while they have ``terms`` terms.
        """
        upto = np.append(0, np.cumsum(self.sizes_times(other)))
        first = 0
        while first < self.rows:
            last = max(first + 1, int(np.searchsorted(upto, upto[first] + terms, "right")) - 1)
            span = slice(self.start[first], self.start[last])
            named = self.column[span]
            size = np.diff(other.start)[named]
            row = np.repeat(np.repeat(np.arange(first, last), np.diff(self.start[first : last + 1])), size)
            at = np.repeat(other.start[named] - np.append(0, np.cumsum(size)[:-1]), size) + np.arange(size.sum())
            column, value = other.column[at], np.repeat(self.value[span], size) * other.value[at]
            key = row * other.width + column
            if len(key) and (np.diff(key) < 0).any():
                order = np.argsort(key, kind="stable")
                key, row, column, value = key[order], row[order], column[order], value[order]
            new = np.flatnonzero(np.append(True, np.diff(key) != 0)) if len(key) else np.zeros(0, np.int64)
            yield row[new], column[new], np.add.reduceat(value, new) if len(new) else value
            first = last


def byte_incidence(sizes: np.ndarray) -> Csr:
    """Tokens by bytes, for tokens that cover a text one after the other."""
    ends = np.append(0, np.cumsum(sizes))
    total = int(ends[-1])
    return Csr(ends, np.arange(total), np.ones(total, np.int64), total)


def group_incidence(group: np.ndarray, groups: int) -> Csr:
    """Tokens by groups: one nonzero a row."""
    return Csr(np.arange(len(group) + 1), group, np.ones(len(group), np.int64), groups)


@dataclass(frozen=True)
class Alignment:
    """Tokens of both sides over the same bytes, and the group of each."""

    a: np.ndarray
    b: np.ndarray
    a_size: np.ndarray
    b_size: np.ndarray

    def __post_init__(self) -> None:
        a_end, b_end = np.cumsum(self.a_size), np.cumsum(self.b_size)
        total = int(a_end[-1]) if len(a_end) else 0
        of_a, of_b = np.zeros(total + 1, bool), np.zeros(total + 1, bool)
        of_a[a_end] = True
        of_b[b_end] = True
        a_cut, b_cut = of_b[a_end], of_a[b_end]
        set_ = object.__setattr__
        set_(self, "a_end", a_end)
        set_(self, "b_end", b_end)
        set_(self, "a_group", np.cumsum(a_cut) - a_cut)
        set_(self, "b_group", np.cumsum(b_cut) - b_cut)
        set_(self, "groups", int(a_cut.sum()))

    def links(self, kind: str = "end") -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Positions of both tokens and the value of each link: shared bytes, or shared groups of ``group``."""
        if kind == "group":
            yield from group_incidence(self.a_group, self.groups).times(group_incidence(self.b_group, self.groups).transpose())
            return
        for a, b, shared in byte_incidence(self.a_size).times(byte_incidence(self.b_size).transpose()):
            if kind == "end":
                kept = self.a_end[a] == self.b_end[b]
                a, b, shared = a[kept], b[kept], shared[kept]
            yield a, b, shared

    def codes(self, width: int) -> np.ndarray:
        """Both sides as one sequence, group by group: id, plus ``width`` where a group starts and twice that where its second side does."""
        count_a, count_b = np.bincount(self.a_group, minlength=self.groups), np.bincount(self.b_group, minlength=self.groups)
        found = np.empty(len(self.a) + len(self.b), np.int64)
        first_a = np.diff(self.a_group, prepend=-1) > 0
        first_b = np.diff(self.b_group, prepend=-1) > 0
        found[np.arange(len(self.a)) + (np.cumsum(count_b) - count_b)[self.a_group]] = self.a + width * first_a
        found[np.arange(len(self.b)) + np.cumsum(count_a)[self.b_group]] = self.b + 2 * width * first_b
        return found


def read_byte_vocabulary(path: str) -> dict[bytes, int]:
    """Bytes and ids of a byte-level BPE file whose ids follow its merges."""
    with open(path, encoding="utf-8") as file:
        model = json.load(file)["model"]
    # Printable bytes stand for themselves, the others for the characters from 256 on.
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    byte = {**{chr(b): b for b in plain}, **{chr(256 + i): b for i, b in enumerate(others)}}
    merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    merged = [model["vocab"]["".join(m)] for m in merges]
    if merged != sorted(merged):
        raise ValueError("the ids do not follow the merges")
    names = {name for name in model["vocab"] if len(name) == 1} | {"".join(m) for m in merges}
    return {bytes(byte[c] for c in name): model["vocab"][name] for name in names}


class Pair:
    """Both tokenizers of a process."""

    def __init__(self, a_path: str, b_path: str, pattern: str):
        self.a = ByteEncoder(read_byte_vocabulary(a_path), pattern)
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        self.b_width = self.b.get_piece_size()
        self.width = max(self.a.last, self.b_width)
        self.b_token = [bytes([int(self.b.id_to_piece(i)[3:-1], 16)]) if self.b.is_byte(i) else self.b.id_to_piece(i).replace("▁", " ").encode() for i in range(self.b_width)]
        self.a_size, self.b_size = np.zeros(self.width, np.int64), np.zeros(self.width, np.int64)
        self.a_size[list(self.a.size)] = list(self.a.size.values())
        self.b_size[: self.b_width] = [len(t) for t in self.b_token]
        self.written = [mark + str(i) for mark in ",;|" for i in range(self.width)]

    def tokens(self, texts: list[str]) -> list[tuple[list[int], list[int]] | None]:
        """Ids of both sides of each text; none where the second side does not give the text back.

        The first side always does: its tokens are cut from the bytes of the text.
        """
        found: list[tuple[list[int], list[int]] | None] = []
        token = self.b_token.__getitem__
        for text, b in zip(texts, self.b.encode(texts, num_threads=1), strict=True):
            whole = " " + text
            if text and b"".join(map(token, b)) == whole.encode():
                found.append((self.a.encode(whole), b))
            else:
                found.append(None)
        return found

    def align(self, texts: list[str]) -> tuple[Alignment, np.ndarray, np.ndarray]:
        """One alignment of all ``texts`` one after the other, and how many tokens of each side each has."""
        pairs = [found or ((), ()) for found in self.tokens(texts)]
        n_a = np.fromiter((len(a) for a, _ in pairs), np.int64, len(pairs))
        n_b = np.fromiter((len(b) for _, b in pairs), np.int64, len(pairs))
        a = np.fromiter(chain.from_iterable(a for a, _ in pairs), np.int64, int(n_a.sum()))
        b = np.fromiter(chain.from_iterable(b for _, b in pairs), np.int64, int(n_b.sum()))
        return Alignment(a, b, self.a_size[a], self.b_size[b]), n_a, n_b


class Words(dict):
    """Numbers of words; new ones are numbered and noted."""

    def __init__(self) -> None:
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        self[word] = number = len(self)
        self.new.append(word)
        return number


COUNTS = ("n_a", "n_b", "n_groups", "n_links", "n_overlaps", "n_shared")
# Blanks here are at least those of the pattern, so a cut is one for both tokenizers.
CUT = re.compile(r"(?<=\S) ")
BLANK_BEFORE = re.compile(r"(?:\A|\s) ")


class Aligner:
    """Alignments of texts, put together of those of their words."""

    def __init__(self, pair: Pair):
        self.pair = pair
        # Cuts hold where no token of the second side goes on behind a space and blanks stay as they are.
        self.cuts = not any(re.search("[^▁]▁", pair.b.id_to_piece(i)) for i in range(pair.b_width)) and pair.tokens(["a  b "]) != [None]
        self._forget()

    def _forget(self) -> None:
        self.words, self.bytes = Words(), 0
        self.good = np.zeros(0, bool)
        self.counts = np.zeros((0, len(COUNTS)), np.int64)
        self.link_start, self.keys = np.zeros(1, np.int64), np.zeros(0, np.int64)
        self.groups: list[str] = []

    def split(self, text: str) -> list[str]:
        if not self.cuts:
            return [text]
        return CUT.split(text) if BLANK_BEFORE.search(text) else text.split(" ")

    def _learn(self) -> None:
        """Align the new words, one after the other in one matrix."""
        new, self.words.new = self.words.new, []
        if not new:
            return
        pair = self.pair
        self.bytes += sum(map(len, new))
        found, n_a, n_b = pair.align(new)
        word = np.repeat(np.arange(len(new)), n_a)
        per = lambda rows, weights=None: np.bincount(word[rows], weights, len(new)).astype(np.int64)
        overlaps, links, keys = np.zeros(len(new), np.int64), np.zeros(len(new), np.int64), [np.zeros(0, np.int64)]
        for a, b, _ in found.links("overlap"):
            together = found.a_end[a] == found.b_end[b]
            overlaps += per(a)
            links += per(a[together])
            keys.append(found.a[a[together]] * pair.b_width + found.b[b[together]])
        shared = group_incidence(found.a_group, found.groups).sizes_times(group_incidence(found.b_group, found.groups).transpose())
        groups = per(np.flatnonzero(np.diff(found.a_group, prepend=-1) > 0))
        counts = np.stack([n_a, n_b, groups, links, overlaps, per(slice(None), shared)], 1)
        codes, upto = found.codes(pair.width), np.append(0, np.cumsum(n_a + n_b)).tolist()
        written = list(map(pair.written.__getitem__, codes.tolist()))
        self.groups += ["".join(written[upto[i] : upto[i + 1]])[1:] for i in range(len(new))]
        self.good = np.append(self.good, n_a > 0)
        self.counts = np.concatenate([self.counts, counts])
        self.link_start = np.append(self.link_start, self.link_start[-1] + np.cumsum(links))
        self.keys = np.concatenate([self.keys, *keys])

    def align(self, texts: list[str]) -> tuple[np.ndarray, list[str], list[np.ndarray]]:
        """Counts, written groups and pairs of ids of each text; texts that a side does not give back have none.

        A text with a word that is not given back is tried once more as a whole.
        """
        if len(self.words) >= REMEMBERED_WORDS or self.bytes >= REMEMBERED_BYTES:
            self._forget()
        numbers = []
        for text in texts:
            parts = self.split(text)
            numbers.append(np.fromiter(map(self.words.__getitem__, parts), np.int64, len(parts)))
        self._learn()
        for i, text in enumerate(texts):
            if not self.good[numbers[i]].all():
                numbers[i] = np.array([self.words[text]], np.int64)
        self._learn()
        counts, groups, keys = np.zeros((len(texts), len(COUNTS)), np.int64), [], []
        for i, number in enumerate(numbers):
            counts[i] = self.counts[number].sum(0)
            groups.append(";".join(map(self.groups.__getitem__, number.tolist())))
            start = self.link_start[number]
            keys.append(ragged(self.keys, start, self.link_start[number + 1] - start))
        return counts, groups, keys


_OPEN: dict[tuple[str, str, str], Aligner] = {}


def aligner(a_path: str, b_path: str, pattern: str) -> Aligner:
    """The aligner of this process for two tokenizers."""
    key = (a_path, b_path, pattern)
    if key not in _OPEN:
        _OPEN.clear()
        _OPEN[key] = Aligner(Pair(*key))
    return _OPEN[key]


def _blocks(table: pa.Table) -> Iterator[tuple[list, list[str]]]:
    """Ids and texts of a table, some bytes at a time: a long text alone."""
    ids, texts, size = [], [], 0
    for doc_id, text in zip(table["doc_id"].to_pylist(), table["text"].to_pylist(), strict=True):
        ids.append(doc_id)
        texts.append(text)
        size += len(text)
        if size >= BYTES_AT_ONCE:
            yield ids, texts
            ids, texts, size = [], [], 0
    if ids:
        yield ids, texts


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))


LINKS = "doc_id long, a_pos long, b_pos long, a_id int, b_id int, shared long"


def token_links(docs: DataFrame, kind: str = "end", a_path: str | None = None, b_path: str | None = None, pattern: str | None = None) -> DataFrame:
    """One row per link of each text: positions and ids of both tokens, shared bytes (groups of kind ``group``).

    ``kind``: ``end`` (tokens that end at one byte), ``overlap`` (that share a
    byte), ``group`` (that share a group).  Null and empty texts, and texts that a
    side does not give back byte by byte, have no links.  A null id stays null,
    repeated rows are linked one by one, other columns are not read, an empty
    table gives an empty result.
    """
    if kind not in KINDS:
        raise ValueError(f"kind must be one of {KINDS}")
    default = vocabulary_paths()
    paths = (a_path or default[0], b_path or default[1], pattern or word_pattern())

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = aligner(*paths).pair
        for batch in batches:
            for ids, texts in _blocks(pa.Table.from_batches([batch])):
                found, n_a, n_b = pair.align(texts)
                a_upto, b_upto = np.append(0, np.cumsum(n_a)), np.append(0, np.cumsum(n_b))
                for a, b, shared in found.links(kind):
                    doc = np.searchsorted(a_upto, a, "right") - 1
                    named = pa.array(ids, pa.int64()).take(pa.array(doc))
                    columns = [named, pa.array(a - a_upto[doc]), pa.array(b - b_upto[doc]), pa.array(found.a[a].astype(np.int32)), pa.array(found.b[b].astype(np.int32)), pa.array(shared)]
                    yield pa.RecordBatch.from_arrays(columns, ["doc_id", "a_pos", "b_pos", "a_id", "b_id", "shared"])

    return _rows(docs).mapInArrow(work, LINKS)


ALIGNED = pa.schema(
    [("piece", pa.int64()), ("doc_id", pa.int64()), *((c, pa.int64()) for c in COUNTS), ("groups_sha256", pa.string()), ("links", pa.binary()), ("pairs", pa.list_(pa.int64())), ("times", pa.list_(pa.int64()))]
)
ALIGNED_DDL = "piece long, doc_id long, " + ", ".join(f"{c} long" for c in COUNTS) + ", groups_sha256 string, links binary, pairs array<long>, times array<long>"


def _aligned(docs: DataFrame, paths: tuple[str, str, str], piece_bytes: int) -> DataFrame:
    """One row per text with its counts, and one per piece of input with its distinct id pairs.

    ``links`` of a text are places in the sorted ``pairs`` of its piece.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = aligner(*paths)
        partition, done = TaskContext.get().partitionId(), 0

        def piece(table: pa.Table) -> pa.Table:
            nonlocal done
            out = {name: [] for name in ALIGNED.names}
            counts, keys = [], []
            for ids, texts in _blocks(table):
                with no_collector():
                    of_texts, groups, found = own.align(texts)
                out["doc_id"] += ids
                out["groups_sha256"] += [hashlib.sha256(g.encode()).hexdigest() if g else "" for g in groups]
                counts.append(of_texts)
                keys += found
            distinct, place, times = np.unique(np.concatenate(keys), return_inverse=True, return_counts=True)
            place, upto = place.astype("<u4"), np.append(0, np.cumsum(list(map(len, keys)))).tolist()
            out["links"] = [place[upto[i] : upto[i + 1]].tobytes() for i in range(table.num_rows)]
            for name, values in zip(COUNTS, np.concatenate(counts).T, strict=True):
                out[name] = values.tolist()
            none = [None] * table.num_rows
            out["piece"] = [(partition << 33) + done] * (table.num_rows + 1)
            out["pairs"], out["times"] = [*none, distinct], [*none, times]
            for name in ("doc_id", *COUNTS, "groups_sha256", "links"):
                out[name].append(None)
            done += 1
            return pa.table(out, ALIGNED)

        yield from in_chunks(piece, chars=piece_bytes)(batches)

    return write_table(_rows(docs).mapInArrow(work, ALIGNED_DDL), "aligned")


REPORT = "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS) + ", n_best long, count_sum long, groups_sha256 string"


def alignment_report(
    docs: DataFrame, a_path: str | None = None, b_path: str | None = None, pattern: str | None = None, piece_bytes: int = PIECE_BYTES
) -> DataFrame:
    """One row per row of ``docs``: tokens, groups and links, and how common its linked id pairs are in all texts.

    ``n_best`` counts the links whose pair is the most frequent one of its second
    id, ``count_sum`` adds the frequencies up.  Pairs are counted once a piece of
    input, summed over all pieces by a shuffle, and go back to the pieces that
    hold them: a row for each piece and distinct pair, so a pair that is in every
    text costs a row a piece.  Awkward rows are as in ``token_links``; here texts
    without links have zeros and an empty digest.
    """
    default = vocabulary_paths()
    paths = (a_path or default[0], b_path or default[1], pattern or word_pattern())
    width = aligner(*paths).pair.b_width
    aligned = _aligned(docs, paths, piece_bytes)
    held = aligned.where("pairs is not null").select("piece", F.explode(F.arrays_zip("pairs", "times")).alias("_p")).select("piece", F.col("_p.pairs").alias("pair"), F.col("_p.times").alias("n"))
    totals = write_table(held.groupBy("pair").agg(F.sum("n").alias("n")), "pair_counts")
    second = (F.col("pair") % width).alias("b")
    # As many rows as the second vocabulary has ids, whatever the texts.
    top = F.broadcast(totals.groupBy(second).agg(F.max("n").alias("top")))
    marked = totals.select("pair", "n", second).join(top, "b").select("pair", "n", (F.col("n") == F.col("top")).alias("best"))
    answers = held.select(F.col("piece").alias("of_piece"), "pair").join(marked, "pair").select("of_piece", "pair", "n", "best")
    texts = aligned.where("pairs is null").select("piece", "doc_id", *COUNTS, "groups_sha256", "links")

    def answer(left: pa.Table, right: pa.Table) -> pa.Table:
        order = np.argsort(right["pair"].to_numpy())
        n, best = right["n"].to_numpy()[order], right["best"].to_numpy(zero_copy_only=False)[order]
        n_best, count_sum = [], []
        for links in left["links"].to_pylist():
            place = np.frombuffer(links, "<u4")
            n_best.append(int(best[place].sum()))
            count_sum.append(int(n[place].sum()))
        kept = left.select(["doc_id", *COUNTS])
        return kept.append_column("n_best", pa.array(n_best, pa.int64())).append_column("count_sum", pa.array(count_sum, pa.int64())).append_column("groups_sha256", left["groups_sha256"])

    return texts.groupBy("piece").cogroup(answers.groupBy("of_piece")).applyInArrow(answer, REPORT)

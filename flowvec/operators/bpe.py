"""Pair merges learned from token counts, and texts encoded with them.

Training iterates over distinct tokens only.  A pass counts all pairs, takes as
many of the most frequent ones as a bounded number of tokens holds, fetches those
tokens, and merges among them in the usual order for as long as no pair left
outside could come first.  The index from pairs to tokens makes a merge recount
the tokens it touches, no others.  Where already the first pair is in more tokens
than that, the pass merges this pair alone, in place.
"""

from __future__ import annotations

import heapq
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import pairwise

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowvec.operators.text import SPECIAL_TOKENS
from flowvec.session import checkpoint

Pair = tuple[str, str]

# Tokens that a pass fetches at most, and pairs that it looks at.
TOKENS_AT_ONCE = 100_000
PAIRS_AT_ONCE = 4_096
# Tokens whose symbols a task remembers while it encodes.
REMEMBERED = 200_000


def merged(symbols: list[str], left: str, right: str) -> list[str]:
    """All occurrences of the pair made one symbol, from the left."""
    out, i = [], 0
    while i < len(symbols):
        if symbols[i] == left and i + 1 < len(symbols) and symbols[i + 1] == right:
            out.append(left + right)
            i += 2
        else:
            out.append(symbols[i])
            i += 1
    return out


def ranked_symbols(symbols: list[str], ranks: dict[Pair, int]) -> list[str]:
    """Merge the pair of least rank until none is left that has one."""
    while len(symbols) > 1:
        best = min(pairwise(symbols), key=lambda pair: ranks.get(pair, len(ranks)))
        if best not in ranks:
            break
        symbols = merged(symbols, *best)
    return symbols


class PairIndex:
    """Symbols of some tokens, counts of their pairs, and the tokens each pair is in.

    ``known`` pairs are counted in full: all their tokens are here.  So are the
    pairs of a symbol that is made here and was nowhere before.
    """

    def __init__(self, tokens: list[tuple[list[str], int]], known: set[Pair]):
        self.symbols = [list(s) for s, _ in tokens]
        self.n = [n for _, n in tokens]
        self.counts: Counter[Pair] = Counter()
        self.places: dict[Pair, set[int]] = defaultdict(set)
        self.known, self.made = known, set()
        for i in range(len(tokens)):
            self._count(i, 1)
        self.heap = [(-n, pair) for pair, n in self.counts.items() if pair in known]
        heapq.heapify(self.heap)

    def _count(self, i: int, sign: int) -> set[Pair]:
        found = set(pairwise(self.symbols[i]))
        for pair in pairwise(self.symbols[i]):
            self.counts[pair] += sign * self.n[i]
        for pair in found:
            if sign > 0:
                self.places[pair].add(i)
            else:
                self.places[pair].discard(i)
        return found

    def best(self) -> tuple[int, Pair] | None:
        """The most frequent pair that is counted in full, the smallest on ties, as ``(-count, pair)``."""
        while self.heap:
            negative, pair = self.heap[0]
            if self.counts[pair] == -negative:
                return negative, pair
            heapq.heappop(self.heap)
        return None

    def merge(self, pair: Pair) -> None:
        self.made.add(pair[0] + pair[1])
        changed: set[Pair] = set()
        for i in list(self.places[pair]):
            changed |= self._count(i, -1)
            self.symbols[i] = merged(self.symbols[i], *pair)
            changed |= self._count(i, 1)
        for other in changed:
            if self.counts[other] > 0 and (other in self.known or other[0] in self.made or other[1] in self.made):
                heapq.heappush(self.heap, (-self.counts[other], other))


def _pair_counts(state: DataFrame) -> DataFrame:
    """``a, b, n, tokens``: occurrences of each pair and the tokens it is in; counted in the task first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, tokens = Counter(), Counter()
            for symbols, n in zip(batch.column("s").to_pylist(), batch.column("n").to_pylist(), strict=True):
                for pair in pairwise(symbols):
                    counts[pair] += n
                tokens.update(set(pairwise(symbols)))
            columns = [[a for a, _ in counts], [b for _, b in counts], list(counts.values()), [tokens[p] for p in counts]]
            kinds = (pa.string(), pa.string(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["a", "b", "n", "tokens"])

    parts = state.select("s", "n").mapInArrow(count, "a string, b string, n long, tokens long")
    return parts.groupBy("a", "b").agg(F.sum("n").alias("n"), F.sum("tokens").alias("tokens"))


def _holding(state: DataFrame, pairs: set[Pair]) -> list[tuple[list[str], int]]:
    """The tokens that hold one of the pairs."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array([not pairs.isdisjoint(pairwise(s)) for s in batch.column("s").to_pylist()], pa.bool_()))

    found = state.select("s", "n").mapInArrow(keep, "s array<string>, n long").toArrow()
    return list(zip(found["s"].to_pylist(), found["n"].to_pylist(), strict=True))


def _merge_in_place(state: DataFrame, merges: list[Pair]) -> DataFrame:
    """The tokens after ``merges``, one after the other."""
    ranks = {pair: i for i, pair in enumerate(merges)}

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            symbols = [ranked_symbols(s, ranks) for s in batch.column("s").to_pylist()]
            at = batch.schema.get_field_index("s")
            yield batch.set_column(at, batch.schema.field(at), pa.array(symbols, batch.schema.field(at).type))

    return state.mapInArrow(apply, state.schema)


@dataclass(frozen=True)
class Merges:
    """Special tokens, single characters and merges in their order; ids follow this order."""

    alphabet: list[str]
    merges: list[Pair]
    special: list[str] = field(default_factory=lambda: list(SPECIAL_TOKENS))

    @property
    def ranks(self) -> dict[Pair, int]:
        return {pair: i for i, pair in enumerate(self.merges)}

    @property
    def ids(self) -> dict[str, int]:
        """The id of each token; a symbol that two merges make has the first one's."""
        found: dict[str, int] = {}
        for token in (*self.special, *self.alphabet, *(a + b for a, b in self.merges)):
            found.setdefault(token, len(found))
        return found


def train(
    tokens: DataFrame, vocabulary: int | None = None, min_count: int = 2, tokens_at_once: int = TOKENS_AT_ONCE
) -> tuple[Merges, DataFrame]:
    """Learn merges from ``token, n`` until no pair occurs ``min_count`` times.

    The most frequent pair goes first, the smallest on ties.  With ``vocabulary``
    training also ends once special tokens, characters and merges are that many.
    Returns the merges and the tokens with their final symbols ``s``.
    """
    state = checkpoint(tokens.where("token <> ''").select("token", F.col("n").cast("long").alias("n"), F.split("token", "(?!^)(?!$)").alias("s")))
    # As many rows as the texts have different characters.
    alphabet = sorted(r[0] for r in state.select(F.explode("s")).distinct().collect())
    made, existing = [], set(alphabet)
    most = float("inf") if vocabulary is None else vocabulary - len(SPECIAL_TOKENS) - len(alphabet)
    while len(made) < most:
        ordered = _pair_counts(state).where(F.col("n") >= min_count).orderBy(F.desc("n"), "a", "b").limit(PAIRS_AT_ONCE + 1)
        top = [((r["a"], r["b"]), r["n"], r["tokens"]) for r in checkpoint(ordered).collect()]
        top.sort(key=lambda r: (-r[1], r[0]))
        if not top:
            break
        size = taken = 0
        while taken < min(len(top), PAIRS_AT_ONCE) and size + top[taken][2] <= tokens_at_once:
            size += top[taken][2]
            taken += 1
        batch: list[Pair] = []
        if not taken:
            batch.append(top[0][0])
        else:
            known = {pair for pair, _, _ in top[:taken]}
            index = PairIndex(_holding(state, known), known)
            # The best pair outside comes next as soon as no pair inside goes before it.
            outside = (-top[taken][1], top[taken][0]) if taken < len(top) else (1 - min_count, ("", ""))
            while len(made) + len(batch) < most and (best := index.best()) is not None and best < outside:
                batch.append(best[1])
                symbol = best[1][0] + best[1][1]
                if symbol in existing:
                    # Pairs of this symbol are in other tokens too: they must be counted anew.
                    break
                index.merge(best[1])
        made += batch
        existing |= {a + b for a, b in batch}
        state = checkpoint(_merge_in_place(state, batch))
    return Merges(alphabet, made), state


def encode(df: DataFrame, pieces: Column, model: Merges, length: int | None = None) -> DataFrame:
    """Add ``tokens`` and ``ids``: the pieces of a row by ranked merges between ``[CLS]`` and ``[SEP]``.

    A character that training has not seen is ``[UNK]``.  With ``length`` rows are
    cut and padded to it, the last token kept being ``[SEP]``.  Null pieces give
    the two marks only.
    """
    ranks, ids = model.ranks, model.ids
    pad, unknown, start, end = model.special[0], model.special[1], model.special[2], model.special[3]
    alphabet = set(model.alphabet)
    kept = list(df.columns)
    names = [*kept, "tokens", "ids"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo: dict[str, list[str]] = {}

        def symbols(piece: str) -> list[str]:
            if piece not in memo:
                if len(memo) >= REMEMBERED:
                    memo.clear()
                memo[piece] = [s if s in ids else unknown for s in ranked_symbols([c if c in alphabet else unknown for c in piece], ranks)]
            return memo[piece]

        for batch in batches:
            rows = []
            for found in batch.column("_pieces").to_pylist():
                body = [s for piece in found or () for s in symbols(piece)]
                if length is not None:
                    body = body[: max(0, length - 2)]
                row = [start, *body, end]
                rows.append(row if length is None else row + [pad] * (length - len(row)))
            plain = [batch.column(c) for c in kept]
            tokens = pa.array(rows, pa.list_(pa.string()))
            numbers = pa.array([[ids[s] for s in row] for row in rows], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([*plain, tokens, numbers], names=names)

    schema = df.withColumns({"tokens": F.array().cast("array<string>"), "ids": F.array().cast("array<int>")}).schema
    return df.withColumn("_pieces", pieces).mapInArrow(run, schema)

"""Byte-level BPE by backtracking: longest tokens first, undone where neighbours cannot stand together.

A token sequence is the one that merging by rank gives if and only if every two
neighbours are: the bytes of the two, merged on their own, come out as these two.
So no merge has to be carried out on the text.  The longest token at a place is
taken from an Aho-Corasick automaton over the tokens, whose bytes are written as
Latin-1 characters; where it does not go with the token before it, shorter ones
are tried, and if none does the token before is given up.  A place given up once
is never entered again, so the work is linear in the text.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator
from itertools import batched, chain, pairwise

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowvec.llm.common import in_chunks, text_of

# Words and pairs of tokens remembered by a process, and the longest word among them.
REMEMBERED_WORDS = 300_000
REMEMBERED_PAIRS = 1_000_000
LONGEST_WORD = 64
# Words of a text that are held at once, and texts beyond which they are found one by one.
WORDS_AT_ONCE = 65_536
LONG_TEXT = 500_000


def ranks_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def word_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def read_ranks(path: str) -> dict[bytes, int]:
    """Tokens and their ranks, one base64 token and its rank a line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


class _Words(dict):
    """Ids of words, found once and kept while they fit."""

    def __init__(self, encoder: ByteEncoder):
        self.encoder = encoder

    def __missing__(self, word: str) -> tuple[int, ...]:
        ids = tuple(self.encoder.word(word.encode()))
        if len(word) <= LONGEST_WORD:
            if len(self) >= REMEMBERED_WORDS:
                self.clear()
            self[word] = ids
        return ids


class ByteEncoder:
    """Encodes texts by ranks, each match of the pattern on its own, and decodes ids.

    Every byte must be a token, else there are texts without an encoding.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        missing = [b for b in range(256) if bytes([b]) not in ranks]
        if missing:
            raise ValueError(f"{len(missing)} bytes are no tokens, the first is {missing[0]}")
        self.ranks = ranks
        self.token = {rank: token for token, rank in ranks.items()}
        self.last = max(self.token) + 1
        # Blanks are those of Unicode; the pattern library counts four control characters among them.
        self.pattern = regex.compile(pattern.replace(r"\S", r"\P{White_Space}").replace(r"\s", r"\p{White_Space}"))
        self.automaton = ahocorasick.Automaton()
        for token, rank in ranks.items():
            self.automaton.add_word(token.decode("latin-1"), rank)
        self.automaton.make_automaton()
        self.size = {rank: len(token) for token, rank in ranks.items()}
        self.widest = max(map(len, ranks))
        self.shorter = {rank: self._prefix(token) for token, rank in ranks.items()}
        self.splits: dict[int, tuple[int, int] | None] = {}
        self.pairs: dict[tuple[int, int], bool] = {}
        self.words = _Words(self)

    def _prefix(self, token: bytes) -> int | None:
        """The longest token that ``token`` starts with, itself apart."""
        for end in range(len(token) - 1, 0, -1):
            if token[:end] in self.ranks:
                return self.ranks[token[:end]]
        return None

    def split(self, token: int) -> tuple[int, int] | None:
        """The two tokens that the last merge made ``token`` of; none where merging does not give it."""
        if token not in self.splits:
            data, ranks = self.token[token], self.ranks
            parts = [data[i : i + 1] for i in range(len(data))]
            while len(parts) > 2:
                found = [ranks.get(a + b, token) for a, b in pairwise(parts)]
                least = min(found)
                if least == token:
                    break
                at = found.index(least)
                parts[at : at + 2] = [parts[at] + parts[at + 1]]
            self.splits[token] = (ranks[parts[0]], ranks[parts[1]]) if len(parts) == 2 else None
        return self.splits[token]

    def together(self, left: int, right: int) -> bool:
        """Whether two tokens may be neighbours: merged on their own, their bytes come out as these two."""
        known = self.pairs.get((left, right))
        if known is None:
            known = self._together(left, right)
            if len(self.pairs) >= REMEMBERED_PAIRS:
                self.pairs.clear()
            self.pairs[left, right] = known
        return known

    def _together(self, left: int, right: int) -> bool:
        """Undo the merges of both tokens, last one first, and look for an earlier one across the border.

        Of merges of one rank the leftmost is the first, so one inside the left
        token goes before one across the border, one inside the right token after it.
        """
        token, size = self.token, self.size
        if any(size[t] > 1 and self.split(t) is None for t in (left, right)):
            return False
        before = self.last
        while True:
            across = self.ranks.get(token[left] + token[right])
            if across is not None and across < before:
                return False
            if size[left] > 1 and (size[right] == 1 or left > right):
                before = left
                left = self.split(left)[1]
            elif size[right] > 1:
                before = right + 1
                right = self.split(right)[0]
            else:
                return True

    def word(self, data: bytes) -> list[int]:
        """Ids of one match of the pattern."""
        if data in self.ranks:
            return [self.ranks[data]]
        text, end = data.decode("latin-1"), len(data)
        known, together = self.pairs, self.together
        # The longest tokens one after the other; as far as neighbours go together they stand.
        greedy = [token for _, token in self.automaton.iter_long(text)]
        last, good = -1, 0
        for token in greedy:
            if last >= 0:
                fits = known.get((last, token))
                if not (together(last, token) if fits is None else fits):
                    break
            last = token
            good += 1
        if good == len(greedy):
            return greedy
        return self._backtrack(text, end, greedy[:good], greedy[good])

    def _backtrack(self, text: str, end: int, ids: list[int], token: int | None) -> list[int]:
        """Go on from ``ids``, where ``token`` is the next to try."""
        # Only as much of the text as the widest token is handed over: the library copies what it gets.
        longest, size, shorter, widest = self.automaton.iter_long, self.size, self.shorter, self.widest
        entered = bytearray(b"\1") * (end + 1)
        at = sum(map(size.__getitem__, ids))
        known, last = self.pairs, ids[-1] if ids else -1
        while token is not None:
            stop = at + size[token]
            if entered[stop]:
                fits = True if last < 0 else known.get((last, token))
                if fits is None:
                    fits = self.together(last, token)
                if fits:
                    ids.append(token)
                    at, last = stop, token
                    token = next(longest(text[at : at + widest]))[1] if at < end else None
                    continue
            token = shorter[token]
            if token is None:
                # Nothing goes on from here: the token before ends at a place that is given up.
                entered[at] = 0
                token = ids.pop()
                at -= size[token]
                last = ids[-1] if ids else -1
        return ids

    def parts(self, text: str) -> Iterator[list[int]]:
        """Ids of a text, some thousand words at a time."""
        if len(text) <= LONG_TEXT:
            groups: Iterable = (self.pattern.findall(text),)
        else:
            groups = batched((match.group() for match in self.pattern.finditer(text)), WORDS_AT_ONCE)
        for some in groups:
            yield list(chain.from_iterable(map(self.words.__getitem__, some)))

    def encode(self, text: str | None) -> list[int]:
        if text is not None and len(text) <= LONG_TEXT:
            return list(chain.from_iterable(map(self.words.__getitem__, self.pattern.findall(text))))
        return list(chain.from_iterable(self.parts(text or "")))

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.token.__getitem__, ids))


_OPEN: dict[tuple[str, str], ByteEncoder] = {}


def byte_encoder(path: str | None = None, pattern: str | None = None) -> ByteEncoder:
    """The encoder of this process for a file of ranks."""
    key = (path or ranks_path(), pattern or word_pattern())
    if key not in _OPEN:
        _OPEN.clear()
        _OPEN[key] = ByteEncoder(read_ranks(key[0]), key[1])
    return _OPEN[key]


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))


def byte_ids(docs: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """``doc_id, ids``: the token ids of every whole text, one row per row of ``docs``.

    Null and empty texts have no ids.  A null id stays null, repeated rows are
    encoded one by one, other columns are not read, an empty table gives an empty
    result.  A text is encoded some thousand words at a time.
    """
    path, pattern = path or ranks_path(), pattern or word_pattern()

    def work(table: pa.Table) -> pa.Table:
        own = byte_encoder(path, pattern)
        ids = pa.array([own.encode(text) for text in table["text"].to_pylist()], pa.list_(pa.int32()))
        return pa.table({"doc_id": table["doc_id"], "ids": ids})

    return _rows(docs).mapInArrow(in_chunks(work), "doc_id long, ids array<int>")


def byte_texts(rows: DataFrame, path: str | None = None) -> DataFrame:
    """``doc_id, data``: the bytes that ``ids`` stand for; null ids count as none, an unknown id fails."""
    path = path or ranks_path()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = byte_encoder(path)
        for batch in batches:
            data = [own.decode(ids or ()) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(data, pa.binary())], ["doc_id", "data"])

    return rows.select(F.col("doc_id").cast("long").alias("doc_id"), "ids").mapInArrow(work, "doc_id long, data binary")


DIGESTS = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def byte_digests(docs: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """Number of ids and digests of ids and decoded bytes, one row per row of ``docs``.

    Rows and awkward values are as in ``byte_ids``; here the ids of a text are
    never held whole, so memory follows the text alone.
    """
    path, pattern = path or ranks_path(), pattern or word_pattern()

    def work(table: pa.Table) -> pa.Table:
        own = byte_encoder(path, pattern)
        number = {i: str(i) for i in own.token}
        counts, ids_sha, text_sha = [], [], []
        for text in table["text"].to_pylist():
            n, of_ids, of_text = 0, hashlib.sha256(), hashlib.sha256()
            for ids in own.parts(text):
                of_ids.update((" " * (n > 0) + " ".join(map(number.__getitem__, ids))).encode())
                of_text.update(own.decode(ids))
                n += len(ids)
            counts.append(n)
            ids_sha.append(of_ids.hexdigest())
            text_sha.append(of_text.hexdigest())
        return pa.table({"doc_id": table["doc_id"], "n_tokens": pa.array(counts, pa.int64()), "ids_sha256": pa.array(ids_sha, pa.string()), "decoded_sha256": pa.array(text_sha, pa.string())})

    return _rows(docs).mapInArrow(in_chunks(work), DIGESTS)

"""Byte-pair encoding of words through a minimal acyclic transducer.

The most frequent words of the corpus are compiled into an automaton that shares
prefixes and suffixes; numbers on its edges add up to the number of a word, and
that number finds its token ids.  Its arrays lie in one file that workers map
into memory.  Words it does not hold are merged exactly, many at a time: in each
round every word applies its lowest-ranked merge, the leftmost of equals.  Words
and parts of words that a process has met are found in arrays, not merged again.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
import uuid
from collections.abc import Iterable, Sequence

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowvec.llm.common import BLANKS, in_chunks, text_of
from flowvec.llm.wordhash import BLANK, in_groups
from flowvec.session import shared_dir

TOKENIZER = "word_bpe_49k.json"
# Words compiled into the transducer, and the longest of them in bytes.
LEXICON_WORDS = 65_536
LONGEST_WORD = 64
# Words, and parts of words, that a process remembers; then it keeps those it met again, at most half as many.
REMEMBERED = 600_000
# Bytes of text whose words are looked up together.
TEXT_BYTES = 4_000_000
# Pieces of more symbols than this are merged on their own.
LONG_PIECE = 512
NEVER = np.int32(2**31 - 1)


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {b: chr(b) for b in plain}
    rest = (b for b in range(256) if b not in letters)
    return letters | {b: chr(256 + i) for i, b in enumerate(rest)}


def _classes() -> tuple[str, str]:
    """Letters and numbers of the Latin blocks, as parts of a character class."""
    kinds = {c: unicodedata.category(c)[0] for c in map(chr, range(0xA1, 0x250))}
    pick = lambda k: "".join(re.escape(c) for c, kind in kinds.items() if kind == k)
    return "a-z" + pick("L"), "0-9" + pick("N")


LETTERS, NUMBERS = _classes()
# Words of these characters are their own normal form and need no library call.
LATIN = re.compile("[!-~¡-ɏ]+")
SPLIT = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[{NUMBERS}]|[^\\s{LETTERS}{NUMBERS}]+")
# Letters are 1, numbers 2, other characters of the Latin blocks 3; a part of a word has one kind.
_KIND = np.array([1 if re.match(f"[{LETTERS}]", c) else 2 if re.match(f"[{NUMBERS}]", c) else 3 for c in map(chr, range(0x250))], np.uint8)
_KIND[ord("\n")] = 0


class Pairs:
    """Ranks and results of merges, looked up for many pairs at once by open addressing."""

    def __init__(self, left: np.ndarray, right: np.ndarray, merged: np.ndarray):
        self.bits = max(4, int(len(left) * 8).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.rank = np.full(1 << self.bits, NEVER, np.int32)
        self.merged = np.zeros(1 << self.bits, np.int32)
        keys = (left.astype(np.int64) << 20) | right
        _, first = np.unique(keys, return_index=True)
        todo, slot = first, self._slot(keys[first])
        while len(todo):
            # Of those that want a free slot the last written gets it; the rest move on.
            free = self.keys[slot] < 0
            self.keys[slot[free]] = keys[todo[free]]
            won = self.keys[slot] == keys[todo]
            self.rank[slot[won]], self.merged[slot[won]] = todo[won], merged[todo[won]]
            todo, slot = todo[~won], (slot[~won] + 1) & (len(self.keys) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The slot of each pair, 0 or more, or -1 where the pair has no merge."""
        keys = (left.astype(np.int64) << 20) | right
        slot = self._slot(keys)
        out = np.full(len(keys), -1, np.int64)
        rest = np.arange(len(keys))
        while len(rest):
            there = self.keys[slot]
            hit = there == keys
            out[rest[hit]] = slot[hit]
            more = ~hit & (there >= 0)
            rest, keys, slot = rest[more], keys[more], (slot[more] + 1) & (len(self.keys) - 1)
        return out

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        slot = self.find(left.ravel(), right.ravel())
        return np.where(slot >= 0, self.rank[slot], NEVER).reshape(left.shape)


class Transducer:
    """A minimal acyclic automaton over bytes whose edge numbers add up to a word's number."""

    FIELDS = (("keys", np.int64), ("target", np.int32), ("add", np.int32), ("final", np.uint8), ("start", np.int32), ("ids", np.uint16))

    def __init__(self, arrays: dict[str, np.ndarray]):
        self.__dict__.update(arrays)

    @classmethod
    def build(cls, words: Sequence[bytes], ids: Sequence[Sequence[int]]) -> Transducer:
        """From distinct words in byte order and their ids.

        Equal subtrees are joined as soon as no later word can change them.
        """
        # A state is [final, {byte: state}]; a finished one is known by its content.
        known: dict[tuple, int] = {}
        finished: list[tuple[bool, tuple[tuple[int, int], ...]]] = []

        def finish(node: list) -> int:
            content = (node[0], tuple(node[1].items()))
            if content not in known:
                known[content] = len(finished)
                finished.append(content)
            return known[content]

        def close(path: list, depth: int) -> None:
            while len(path) > depth + 1:
                node = path.pop()
                path[-1][1][node[2]] = finish(node)

        path, last = [[False, {}, None]], b""
        for word in words:
            shared = 0
            while shared < min(len(last), len(word)) and last[shared] == word[shared]:
                shared += 1
            close(path, shared)
            for b in word[shared:]:
                path.append([False, {}, b])
            path[-1][0] = True
            last = word
        close(path, 0)
        root = finish(path[0])
        below: list[int] = []
        for final, edges in finished:
            below.append(int(final) + sum(below[t] for _, t in edges))
        keys, target, add = [], [], []
        # The root gets number 0, so that a walk starts there.
        number = {root: 0} | {s: i + 1 for i, s in enumerate(x for x in range(len(finished)) if x != root)}
        for state, (final, edges) in enumerate(finished):
            before = int(final)
            for b, t in edges:
                keys.append((number[state] << 8) | b)
                target.append(number[t])
                add.append(before)
                before += below[t]
        order = np.argsort(np.array(keys, np.int64))
        final = np.zeros(len(finished), np.uint8)
        final[[number[s] for s in range(len(finished))]] = [f for f, _ in finished]
        return cls(
            {
                "keys": np.array(keys, np.int64)[order],
                "target": np.array(target, np.int32)[order],
                "add": np.array(add, np.int32)[order],
                "final": final,
                "start": np.cumsum([0, *map(len, ids)]).astype(np.int32),
                "ids": np.array([i for word in ids for i in word], np.uint16),
            }
        )

    def to_bytes(self) -> bytes:
        sizes = [len(getattr(self, name)) for name, _ in self.FIELDS]
        parts = [np.array(sizes, np.int64).tobytes()]
        for name, kind in self.FIELDS:
            data = getattr(self, name).astype(kind).tobytes()
            parts.append(data + b"\0" * (-len(data) % 8))
        return b"".join(parts)

    @classmethod
    def open(cls, path: str) -> Transducer:
        """Map a file of ``to_bytes`` into memory."""
        raw = np.memmap(path, np.uint8, "r")
        sizes, at, arrays = raw[: 8 * len(cls.FIELDS)].view(np.int64), 8 * len(cls.FIELDS), {}
        for size, (name, kind) in zip(sizes, cls.FIELDS, strict=True):
            n = int(size) * np.dtype(kind).itemsize
            arrays[name] = raw[at : at + n].view(kind)
            at += n + -n % 8
        return cls(arrays)

    def numbers(self, words: Sequence[bytes]) -> np.ndarray:
        """The number of each word, -1 for words that are not held; all walk side by side."""
        out = np.full(len(words), -1, np.int64)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        walk = np.flatnonzero(lengths <= LONGEST_WORD)
        if not len(walk) or not len(self.keys):
            return out
        starts = np.cumsum(lengths) - lengths
        flat = np.frombuffer(b"".join(words) + b"\0", np.uint8)
        state, total = np.zeros(len(walk), np.int64), np.zeros(len(walk), np.int64)
        for column in range(LONGEST_WORD + 1):
            ended = lengths[walk] == column
            accept = ended & (self.final[state] > 0)
            out[walk[accept]] = total[accept]
            walk, state, total = walk[~ended], state[~ended], total[~ended]
            if not len(walk):
                break
            key = (state << 8) | flat[starts[walk] + column]
            edge = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            there = self.keys[edge] == key
            walk, edge = walk[there], edge[there]
            state, total = self.target[edge].astype(np.int64), total[there] + self.add[edge]
        return out


# Masks of the first n bytes of eight.
_FIRST = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


class Memory:
    """Ids of words, which are numbered many at once by open addressing.

    A word is 16 bytes, with zeros behind it.  Longer words, and such with a
    zero, are numbered behind all others until ``drop``.
    """

    def __init__(self) -> None:
        self.keys = np.zeros((0, 2), np.uint64)
        self.table = np.full(1 << 12, -1, np.int32)
        self.start, self.ids = np.zeros(1, np.int64), np.zeros(0, np.uint16)
        self.uses = np.zeros(0, np.int64)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        x = keys[:, 0] * np.uint64(0x9E3779B97F4A7C15)
        x = ((x ^ (x >> np.uint64(29))) + keys[:, 1]) * np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(32)
        return ((x * np.uint64(0x94D049BB133111EB)) >> np.uint64(65 - len(self.table).bit_length())).astype(np.int64)

    def _find(self, keys: np.ndarray) -> np.ndarray:
        """The number of each word, -1 for those that are not held."""
        slot = self._slot(keys)
        out = self.table[slot]
        rest = np.flatnonzero(out >= 0)
        rest = rest[(self.keys[out[rest]] != keys[rest]).any(axis=1)]
        slot = slot[rest]
        while len(rest):
            slot = (slot + 1) & (len(self.table) - 1)
            out[rest] = there = self.table[slot]
            more = np.flatnonzero(there >= 0)
            more = more[(self.keys[there[more]] != keys[rest[more]]).any(axis=1)]
            rest, slot = rest[more], slot[more]
        return out.astype(np.int64)

    def _hold(self, keys: np.ndarray) -> None:
        """Give the next numbers to words that are distinct and not held."""
        first = len(self.keys)
        self.keys = np.concatenate([self.keys, keys])
        if 2 * len(self.keys) > len(self.table):
            self.table = np.full(1 << (2 * len(self.keys)).bit_length(), -1, np.int32)
            first = 0
        todo = np.arange(first, len(self.keys), dtype=np.int32)
        slot = self._slot(self.keys[first:])
        while len(todo):
            # Of those that want a free slot the last written gets it; the rest move on.
            free = self.table[slot] < 0
            self.table[slot[free]] = todo[free]
            lost = self.table[slot] != todo
            todo, slot = todo[lost], (slot[lost] + 1) & (len(self.table) - 1)

    def number(self, joined: bytes, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
        """The number of each word ``joined[start:end]``, and the new words in the order of their numbers, which wait for ``add``.

        Words come in the order of the bytes, behind which 16 more lie that are not looked at.
        """
        raw = np.frombuffer(joined, np.uint8)
        size = ends - starts
        # Eight bytes from any place on.
        eight = np.ndarray((len(raw) - 7,), "<u8", buffer=raw, strides=(1,))
        keys = np.empty((len(starts), 2), np.uint64)
        keys[:, 0] = eight[starts] & _FIRST[np.minimum(size, 8)]
        keys[:, 1] = eight[starts + 8] & _FIRST[np.clip(size - 8, 0, 8)]
        apart = np.flatnonzero(size > 16)
        if len(zero := np.flatnonzero(raw[:-16] == 0)):
            apart = np.union1d(apart, np.searchsorted(starts, zero, "right") - 1)
        found = self._find(keys)
        found[apart] = 0
        new = np.flatnonzero(found < 0)
        new = new[np.lexsort(keys[new].T)]
        first = np.append(True, (keys[new[1:]] != keys[new[:-1]]).any(axis=1))[: len(new)]
        found[new] = len(self.keys) - 1 + np.cumsum(first)
        fresh = keys[new[first]]
        self._hold(fresh)
        uses = np.bincount(np.delete(found, apart) if len(apart) else found, minlength=len(self.keys))
        uses[: len(self.uses)] += self.uses
        self.uses = uses
        distinct: dict[bytes, int] = {}
        if len(apart):
            found[apart] = [len(self.keys) + distinct.setdefault(joined[starts[i] : ends[i]], len(distinct)) for i in apart.tolist()]
        lines = np.full((len(fresh), 17), ord("\n"), np.uint8)
        lines[:, :16] = fresh.view(np.uint8).reshape(-1, 16)
        return found, [*lines[lines > 0].tobytes().split(b"\n")[:-1], *distinct]

    def add(self, ids: np.ndarray, sizes: np.ndarray) -> None:
        """The ids of the new words, one after the other."""
        self.start = np.append(self.start, self.start[-1] + np.cumsum(sizes))
        self.ids = np.append(self.ids, ids)

    def sizes(self, numbers: np.ndarray) -> np.ndarray:
        return self.start[numbers + 1] - self.start[numbers]

    def get(self, numbers: np.ndarray) -> np.ndarray:
        return ragged(self.ids, self.start[numbers], self.sizes(numbers))

    def drop(self) -> None:
        """Without the words that do not fit; of more than ``REMEMBERED`` others at most half that many stay, in use
        more than once, twice, four times ... since this was last done."""
        self.start = self.start[: len(self.keys) + 1]
        self.ids = self.ids[: self.start[-1]]
        if len(self.keys) <= REMEMBERED:
            return
        often = 1
        while 2 * np.count_nonzero(self.uses > often) > REMEMBERED:
            often *= 2
        kept = np.flatnonzero(self.uses > often)
        ids, sizes = self.get(kept), self.sizes(kept)
        self.start, self.ids = np.append(0, np.cumsum(sizes)), ids
        self.uses = np.zeros(len(kept), np.int64)
        keys, self.keys = self.keys[kept], self.keys[:0]
        self.table[:] = -1
        self._hold(keys)


def ragged(values: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The runs ``values[start:start + size]`` one after the other."""
    place = np.cumsum(size) - size
    return values[np.repeat(start - place, size) + np.arange(int(size.sum()))]


class Encoder:
    """Ids of texts, exactly as the tokenizer file says (no special tokens added)."""

    def __init__(self, tokenizer: str, lexicon: str | None = None):
        from tokenizers import Tokenizer

        with open(tokenizer, encoding="utf-8") as f:
            spec = json.load(f)
        self.library = Tokenizer.from_file(tokenizer)
        vocab: dict[str, int] = spec["model"]["vocab"]
        merges = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        ids = np.array([[vocab[a], vocab[b], vocab[a + b]] for a, b in merges], np.int64).reshape(-1, 3)
        self.pairs = Pairs(ids[:, 0], ids[:, 1], ids[:, 2])
        letters = byte_letters()
        self.bytes_of = {c: b for b, c in letters.items()}
        suffix = spec["model"]["end_of_word_suffix"] or ""
        self.inner = np.array([vocab[letters[b]] for b in range(256)], np.int32)
        self.last = np.array([vocab[letters[b] + suffix] for b in range(256)], np.int32)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.cut = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.names = [""] * (1 + max([*vocab.values(), *self.special.values()]))
        for token, i in [*vocab.items(), *self.special.items()]:
            self.names[i] = token
        self.lexicon = Transducer.open(lexicon) if lexicon else None
        self.words, self.parts = Memory(), Memory()

    def pieces(self, word: bytes) -> list[bytes]:
        """The parts of a word that are merged on their own; for a special token 0xFF, which no text has, and its id."""
        text = word.decode("utf-8", "replace")
        if LATIN.fullmatch(lower := text.lower()) and "<|" not in text:
            return [p.encode() for p in SPLIT.findall(lower)]
        out: list[bytes] = []
        for part in self.cut.split(text) if self.cut else [text]:
            if part in self.special:
                out.append(b"\xff%d" % self.special[part])
            elif part:
                plain = self.library.normalizer.normalize_str(part)
                split = self.library.pre_tokenizer.pre_tokenize_str(plain)
                out += [bytes(self.bytes_of[c] for c in piece) for piece, _ in split]
        return out

    def merge(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all pieces in one array, with the start and number of each piece's ids."""
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        starts = np.cumsum(lengths) - lengths
        ids, sizes = np.zeros(int(lengths.sum()), np.uint16), np.zeros(len(pieces), np.int64)
        order = np.argsort(lengths, kind="stable")
        ordered = lengths[order]
        at = 0
        while at < len(order):
            width = int(ordered[at])
            if width > LONG_PIECE:
                i = order[at]
                found = self._merge_long(pieces[i])
                sizes[i] = len(found)
                ids[starts[i] : starts[i] + len(found)] = found
                at += 1
                continue
            # Pieces of about one length share a matrix.
            end = int(np.searchsorted(ordered, min(LONG_PIECE, width + 1), "right"))
            rows = order[at:end]
            for some in np.array_split(rows, max(1, len(rows) * (width + 1) // 200_000)):
                if len(some):
                    self._merge_rows([pieces[i] for i in some], lengths[some], starts[some], some, ids, sizes)
            at = end
        return ids, starts, sizes

    def _merge_rows(
        self, pieces: list[bytes], n: np.ndarray, starts: np.ndarray, rows: np.ndarray, ids: np.ndarray, sizes: np.ndarray
    ) -> None:
        wide = int(n.max())
        raw = np.frombuffer(b"".join([p.ljust(wide, b"\0") for p in pieces]), np.uint8).reshape(len(rows), wide)
        r = np.arange(len(rows))
        symbols = self.inner[raw]
        symbols[r, n - 1] = self.last[raw[r, n - 1]]
        columns = np.arange(wide)
        ranks = np.full((len(rows), wide), NEVER, np.int32)
        if wide > 1:
            x, y = np.nonzero(columns[1:] < n[:, None])
            ranks[x, y] = self.pairs.ranks(symbols[x, y], symbols[x, y + 1])
        while len(rows):
            best = ranks.argmin(axis=1)
            go = ranks[np.arange(len(rows)), best] < NEVER
            done = np.flatnonzero(~go)
            if len(done):
                x, y = np.nonzero(columns < n[done, None])
                ids[starts[done[x]] + y] = symbols[done[x], y]
                sizes[rows[done]] = n[done]
            rows, starts, symbols, ranks, n, best = rows[go], starts[go], symbols[go], ranks[go], n[go] - 1, best[go]
            r = np.arange(len(rows))
            slot = self.pairs.find(symbols[r, best], symbols[r, best + 1])
            after = columns[:-1] > best[:, None]
            symbols[:, :-1] = np.where(after, symbols[:, 1:], symbols[:, :-1])
            ranks[:, :-1] = np.where(after, ranks[:, 1:], ranks[:, :-1])
            symbols[r, best] = self.pairs.merged[slot]
            ranks[r, best] = NEVER
            for a in (best - 1, best):
                ok = np.flatnonzero((a >= 0) & (a + 1 < n))
                ranks[ok, a[ok]] = self.pairs.ranks(symbols[ok, a[ok]], symbols[ok, a[ok] + 1])

    def _merge_long(self, piece: bytes) -> np.ndarray:
        """One long piece: a queue of pairs by rank and place, over a linked list of symbols."""
        import heapq

        symbols = self.inner[np.frombuffer(piece, np.uint8)].tolist()
        symbols[-1] = int(self.last[piece[-1]])
        following, before = [*range(1, len(symbols)), -1], [*range(-1, len(symbols) - 1)]
        known: dict[tuple[int, int], tuple[int, int]] = {}

        def rank(i: int) -> tuple[int, int] | None:
            pair = symbols[i], symbols[following[i]]
            if pair not in known:
                slot = int(self.pairs.find(np.array([pair[0]]), np.array([pair[1]]))[0])
                known[pair] = (int(self.pairs.rank[slot]), int(self.pairs.merged[slot])) if slot >= 0 else (-1, -1)
            return known[pair] if known[pair][0] >= 0 else None

        queue = [(r[0], i) for i in range(len(symbols) - 1) if (r := rank(i))]
        heapq.heapify(queue)
        while queue:
            score, i = heapq.heappop(queue)
            if symbols[i] < 0 or following[i] < 0 or not (r := rank(i)) or r[0] != score:
                continue
            j = following[i]
            symbols[i], symbols[j], following[i] = r[1], -1, following[j]
            if following[i] >= 0:
                before[following[i]] = i
            for k in (before[i], i):
                if k >= 0 and following[k] >= 0 and (r := rank(k)):
                    heapq.heappush(queue, (r[0], k))
        return np.array([s for s in symbols if s >= 0], np.uint16)

    def _split(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
        """The numbers of the parts of all words, how many there are of each word, and the new parts."""
        # A word holds no blank, so all words are split at once, a line each.
        lines = b"\n".join([*words, b""]).decode("utf-8", "replace").lower()
        codes = np.frombuffer(lines.encode("utf-32-le"), "<u4")
        # Parts like 's are found one by one, and what is not Latin by the library.
        odd = (codes > 0x24F) | (codes > 0x7E) & (codes < 0xA1) | (codes < 0x21) & (codes != 10) | (codes == ord("'"))
        odd[:-1] |= (codes[:-1] == ord("<")) & (codes[1:] == ord("|"))
        slow = np.unique(np.searchsorted(np.flatnonzero(codes == 10), np.flatnonzero(odd))).tolist()
        split = [self.pieces(words[i]) for i in slow]
        if slow:
            apart = lines.split("\n")
            for i in slow:
                apart[i] = ""
            lines = "\n".join(apart)
            codes = np.frombuffer(lines.encode("utf-32-le"), "<u4")
        flat = lines.encode()
        kind = np.append(0, _KIND[codes])
        turn = (kind[1:] != kind[:-1]) | (kind[1:] == 2)
        raw = np.frombuffer(flat, np.uint8)
        # Where characters begin; the last one is the end of a line.
        char = np.flatnonzero((raw & 0xC0) != 0x80)
        turns = np.flatnonzero(turn)
        part = kind[1 + turns] > 0
        starts, ends = char[turns[part]], char[turns[1:][part[:-1]]]
        word = np.searchsorted(np.flatnonzero(codes == 10), turns[part])
        more = [p for parts in split for p in parts]
        size = np.fromiter(map(len, more), np.int64, len(more))
        upto = len(flat) + np.cumsum(size)
        flat += b"".join(more) + b"\0" * 16
        found, new = self.parts.number(flat, np.append(starts, upto - size), np.append(ends, upto))
        word = np.append(word, np.repeat(np.array(slow, np.int64), [len(parts) for parts in split]))
        return found[np.argsort(word, kind="stable")], np.bincount(word, minlength=len(words)), new

    def _learn(self, words: list[bytes]) -> None:
        """Add the ids of the words that the memory has just numbered."""
        number = self.lexicon.numbers(words) if self.lexicon else np.full(len(words), -1, np.int64)
        unknown = np.flatnonzero(number < 0)
        found, counts, new = self._split([words[i] for i in unknown.tolist()])
        ids, starts, sizes = self.merge(new)
        for i, p in enumerate(new):
            if p[0] == 0xFF:
                ids[starts[i]], sizes[i] = int(p[1:]), 1
        self.parts.add(ragged(ids, starts, sizes), sizes)
        merged = self.parts.get(found)
        ends = np.append(0, np.cumsum(self.parts.sizes(found)))
        upto = np.cumsum(counts)
        first, size = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        first[unknown], size[unknown] = ends[upto - counts], ends[upto] - ends[upto - counts]
        source = merged
        if self.lexicon:
            held = np.flatnonzero(number >= 0)
            at = self.lexicon.start[number[held]]
            size[held] = self.lexicon.start[number[held] + 1] - at
            first[held] = len(merged) + at
            source = np.concatenate([merged, self.lexicon.ids])
        self.words.add(ragged(source, first, size), size)
        self.parts.drop()

    def encode(self, texts: Iterable[bytes | None]) -> Iterable[np.ndarray]:
        """Ids of each text (UTF-8 bytes; null counts as empty), in order."""
        for group in in_groups(texts, TEXT_BYTES):
            yield from self._encode(group)

    def _encode(self, texts: list[bytes]) -> Iterable[np.ndarray]:
        joined = b"\n".join([b"", *texts, b"\0" * 16])
        blank = BLANK[np.frombuffer(joined, np.uint8)[:-16]]
        starts = np.flatnonzero(blank[:-1] & ~blank[1:]) + 1
        found, new = self.words.number(joined, starts, np.flatnonzero(~blank[:-1] & blank[1:]) + 1)
        if new:
            self._learn(new)
        ids = self.words.get(found)
        begin = np.searchsorted(starts, np.cumsum([0, *(len(t) + 1 for t in texts)]))
        upto = np.append(0, np.cumsum(self.words.sizes(found)))[begin].tolist()
        self.words.drop()
        for a, b in zip(upto, upto[1:], strict=False):
            yield ids[a:b]

    def decode(self, ids: np.ndarray) -> str:
        """The tokens joined by spaces, which is what a tokenizer without a decoder gives."""
        return " ".join(map(self.names.__getitem__, ids.tolist()))


_OPEN: dict[tuple, Encoder] = {}


def encoder(tokenizer: str, lexicon: str | None = None) -> Encoder:
    """The encoder of this process for a tokenizer file and a shipped lexicon."""
    if (tokenizer, lexicon) not in _OPEN:
        _OPEN.clear()
        _OPEN[tokenizer, lexicon] = Encoder(tokenizer, SparkFiles.get(lexicon) if lexicon else None)
    return _OPEN[tokenizer, lexicon]


def frequent_words(rows: DataFrame, words: int = LEXICON_WORDS) -> list[bytes]:
    """The most frequent words of the whole table, in byte order."""
    each = rows.select(F.explode(F.split("text", BLANKS)).alias("word"))
    counts = each.where("word <> ''").groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    best = counts.where(F.octet_length("word") <= LONGEST_WORD).orderBy(F.desc("n"), "word").limit(words)
    return sorted(r["word"].encode() for r in best.select("word").collect())


def ship(spark: SparkSession, data: bytes, name: str) -> str:
    """Put a small file into the shared folder and have every executor fetch it; gives its name there."""
    name = f"{name}-{uuid.uuid4().hex}"
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark).rstrip('/')}/flowvec/{name}")
    out = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(path)
    out.write(data)
    out.close()
    spark.sparkContext.addFile(path.toString())
    return name


def compile_lexicon(rows: DataFrame, tokenizer: str, words: int = LEXICON_WORDS) -> str:
    """Compile the frequent words of ``rows`` and ship the transducer."""
    own = Encoder(tokenizer)
    best = frequent_words(rows, words)
    ids = list(own.encode(best))
    return ship(rows.sparkSession, Transducer.build(best, [i.tolist() for i in ids]).to_bytes(), "lexicon")


SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def encode_documents(docs: DataFrame, tokenizer: str | None = None, words: int = LEXICON_WORDS) -> DataFrame:
    """One row per row of ``docs``: number of ids, digests of the ids and of the decoded text.

    Null and empty texts have no ids.  A null id stays null; repeated rows are
    encoded one by one; other columns are not read.  An empty table gives an
    empty result.
    """
    tokenizer = tokenizer or tokenizer_path()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    lexicon = compile_lexicon(rows, tokenizer, words)

    def work(table: pa.Table) -> pa.Table:
        own = encoder(tokenizer, lexicon)
        n, ids_sha, text_sha = [], [], []
        numbers = [str(i) for i in range(len(own.names))]
        for ids in own.encode(table["text"].cast(pa.binary()).to_pylist()):
            n.append(len(ids))
            ids_sha.append(hashlib.sha256(" ".join(map(numbers.__getitem__, ids.tolist())).encode()).hexdigest())
            text_sha.append(hashlib.sha256(own.decode(ids).encode()).hexdigest())
        return pa.table({"doc_id": table["doc_id"], "n_tokens": pa.array(n, pa.int64()), "ids_sha256": pa.array(ids_sha, pa.string()), "decoded_sha256": pa.array(text_sha, pa.string())})

    return rows.mapInArrow(in_chunks(work), SCHEMA)

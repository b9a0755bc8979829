"""Near duplicates by word n-grams: a prefix-tree join of globally ordered n-gram sets.

The sets of a task are sorted by how rare their n-grams are there, which is one
order for all.  The join inserts them into a tree of shared runs; a probe enters
the branches that share one of its rarest n-grams, carries the overlap found so
far down the tree, so that sets with a common run share the work, and leaves a
branch once the n-grams that remain cannot lift the overlap to the threshold.

Sets that may be similar meet in one task by signatures that lose no pair: two
sets at Jaccard ``t`` differ in at most ``d`` n-grams, so if the n-grams are dealt
to ``d + 1`` or more parts by hash, some part is the same in both.  The parts of
a set are its signatures.  Groups connected by signatures may be large, since
texts that share some passages are chained by them.  Of a group too large for one
task, sets go no further whose n-grams are mostly in no other set of the group;
what stays is grouped again, and what is still too large is joined in blocks.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from functools import cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowvec.llm.common import free_name, in_chunks, keyed, per_group, write_table
from flowvec.llm.components import components
from flowvec.llm.wordhash import hash_words, in_groups, mix

WORDS, PERCENT = 4, 85
# Parts beyond those that may differ, against parts that are empty, and the mean
# number of empty parts from which on a size class gets more.
SPARE = 3
FEW_EMPTY = 6
# Signatures of a task that looks for equal ones, and sets of a task that joins.
BUCKET_SIGNATURES = 1_000_000
# Buckets of signatures for each part of the documents whose edges are brought together.
PART_BUCKETS = 8
# What a task tells signatures of a bucket apart by; those that agree by chance only connect too much.
SIGNATURE_BITS = np.uint64(2**40 - 1)
# Buckets of n-grams in which those that most members of a large group have are looked for, and n-grams of one.
GRAM_BUCKETS, BUCKET_GRAMS = 16, 1_000_000
# Bytes of sets of large groups whose n-grams are sent together, and n-grams of a bucket that counts them.
SET_BYTES, MARKS = 8_000_000, 2_000_000
# Bytes of text whose words a task hashes together.
TEXT_BYTES = 6_000_000
BLOCK = 512
# N-grams of a block of a large group, and the least sets of a block.
BLOCK_GRAMS, BLOCK_SETS = 1_000_000, 64
# Bits of the filter that keeps most documents without a partner out of the join.
FILTER_BITS = 2**25
# N-grams of a run that a probe meets before it goes on; the steps widen from there.
HEAD = 32
# Tells the second half of a set's 128-bit hash from the first.
SECOND = np.uint64(0x94D049BB133111EB)


def shingle_sets(texts: Iterable[bytes | None], words: int = WORDS) -> Iterator[np.ndarray]:
    """The sorted distinct n-gram hashes of each text; with fewer words the whole sequence is one."""
    for group in in_groups(texts):
        flat, first, _, _ = hash_words([t.lower() for t in group])
        # All n-grams of the group at once; those that cross from text to text are left out below.
        grams = flat[: max(0, len(flat) - words + 1)]
        for k in range(1, words):
            grams = mix(grams) + flat[k : k + len(grams)]
        grams = mix(grams)
        for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
            if b - a >= words:
                yield distinct(grams[a : b - words + 1])
            elif b > a:
                whole = np.array([b - a], np.uint64)
                for x in flat[a:b]:
                    whole = mix(whole + x)
                yield whole
            else:
                yield flat[:0]


def distinct(x: np.ndarray) -> np.ndarray:
    x = np.sort(x)
    return x[np.append(True, x[1:] != x[:-1])]


def size_classes(percent: int, most: int = 2**40) -> np.ndarray:
    """Upper ends of size classes: similar sets lie in the same class or in neighbouring ones."""
    ends = [1]
    while ends[-1] < most:
        ends.append(max(ends[-1] + 1, ends[-1] * 100 // percent))
    return np.array(ends, np.int64)


@cache
def class_parts(percent: int, size_class: int) -> tuple[int, int, bool]:
    """Parts of a size class, how many of its empty parts need no signature, and whether more give one signature.

    Small classes have few empty parts and sign their choices.  The choices would
    grow with a power of the size; large classes get so many spare parts that a
    set with more empty ones is rare, and such sets share one signature.
    """
    ends = size_classes(percent)
    differing = (100 - percent) * 2 * int(ends[size_class]) // (100 + percent)
    least = int(ends[size_class - 2]) + 1 if size_class > 1 else 1
    empty = lambda parts: parts * math.exp(-least / parts)
    spare = SPARE
    if not differing or empty(differing + spare + 1) <= FEW_EMPTY:
        return differing and differing + spare + 1, spare, False
    for _ in range(8):
        mean = empty(differing + spare + 1)
        spare = SPARE + math.ceil(mean + 6 * math.sqrt(mean))
    return differing + spare + 1, spare, True


def signatures(grams: np.ndarray, ends: np.ndarray, percent: int) -> np.ndarray:
    """Signatures of one set, under its own size class and the next.

    Sets a and b with 100 |a & b| >= percent |a | b| differ in at most
    (100 - percent) (|a| + |b|) / (100 + percent) n-grams.  Of ``parts`` =
    differing + spare + 1, more than ``spare`` parts are equal; if more than
    ``spare`` of them are empty in a set, its empty parts are signatures too.
    """
    own = int(np.searchsorted(ends, len(grams)))
    found = []
    spread = mix(grams)
    for size_class in (own, own + 1):
        parts, spare, shared = class_parts(percent, size_class)
        if not parts:
            continue
        part = ((grams >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
        order = np.argsort(part, kind="stable")
        part = part[order]
        first = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
        sums = np.add.reduceat(spread[order], first)
        salt = mix(np.array([size_class], np.uint64))
        found.append(mix(sums + salt + mix(part[first] + salt)))
        if parts - len(first) > spare:
            if shared:
                found.append(mix(salt))
                continue
            empty = np.setdiff1d(np.arange(parts), part[first].astype(np.int64))
            chosen = np.array(list(combinations(empty.tolist(), spare + 1)), np.uint64)
            code = np.full(len(chosen), salt[0], np.uint64)
            for column in chosen.T:
                code = mix(code + column)
            found.append(code)
    return np.concatenate(found) if found else np.zeros(0, np.uint64)


class Tree:
    """A prefix tree of sorted sets; a node holds a run of n-grams and the sizes of the sets below it."""

    __slots__ = ("run", "children", "members", "least", "most", "flat", "sets", "heads")

    def __init__(self, run: np.ndarray):
        self.run, self.children, self.members, self.flat = run, {}, [], None
        self.least, self.most = 2**62, 0
        self.sets, self.heads = [], None

    def insert(self, grams: np.ndarray, member: int) -> None:
        node, at = self, 0
        self.sets.append(grams)
        while True:
            node.least, node.most = min(node.least, len(grams)), max(node.most, len(grams))
            if at == len(grams):
                node.members.append(member)
                return
            child = node.children.get(int(grams[at]))
            if child is None:
                child = Tree(grams[at:])
                child.least = child.most = len(grams)
                child.members.append(member)
                node.children[int(grams[at])] = child
                return
            width = min(len(child.run), len(grams) - at)
            differ = np.flatnonzero(child.run[:width] != grams[at : at + width])
            shared = int(differ[0]) if len(differ) else width
            if shared < len(child.run):
                upper = Tree(child.run[:shared])
                upper.least, upper.most = child.least, child.most
                child.run = child.run[shared:]
                upper.children[int(child.run[0])] = child
                node.children[int(grams[at])] = upper
                child = upper
            node, at = child, at + shared

    def similar(self, grams: np.ndarray, percent: int) -> list[int]:
        """Members whose set has the threshold's similarity to ``grams``; the tree must be complete."""
        found, n = [], len(grams)
        # Node, n-grams of the probe that are behind, depth in the tree, overlap so far.
        stack = [(self, 0, 0, 0)]
        while stack:
            node, behind, depth, overlap = stack.pop()
            if node.members and 100 * overlap >= percent * (n + depth - overlap):
                found += node.members
            if not node.children:
                continue
            # All branches at once, by the heads of their runs first: most are left there.
            branches, runs, starts, sizes, least, most = node.branches()
            left = grams[behind:]
            alive = self.entered(grams, percent) if node is self else np.arange(len(branches))
            # The sizes below a branch alone may rule it out.
            alive = alive[(100 + percent) * (overlap + np.minimum(len(left), most[alive] - depth)) >= percent * (n + least[alive])]
            width = HEAD
            while len(alive):
                take = np.minimum(sizes[alive], width)
                ends = np.cumsum(take)
                run = runs[np.repeat(starts[alive] - ends + take, take) + np.arange(ends[-1])]
                place = np.searchsorted(left, run)
                hit = np.zeros(len(run) + 1, np.int64)
                inside = place < len(left)
                np.cumsum(inside & (left[np.minimum(place, len(left) - 1)] == run) if len(left) else inside, out=hit[1:])
                common = overlap + hit[ends] - hit[ends - take]
                passed = behind + place[ends - 1] + (hit[ends] - hit[ends - 1])
                below = depth + take
                best = common + np.minimum(n - passed, most[alive] - below)
                # The overlap that the smallest set below would need.
                go = np.flatnonzero((100 + percent) * best >= percent * (n + np.maximum(least[alive], below)))
                done = (take == sizes[alive])[go]
                stack += [(branches[alive[i]], int(passed[i]), int(below[i]), int(common[i])) for i in go[done]]
                alive = alive[go[~done]]
                width *= 4
        return found

    def entered(self, grams: np.ndarray, percent: int) -> np.ndarray:
        """Branches of the root that may hold a similar set.

        Similar sets share one of the first n - ceil(t n) + 1 n-grams of each, in
        the order of the tree.
        """
        if self.heads is None:
            heads = [g[: prefix(len(g), percent)] for g in self.sets if len(g)]
            first = np.repeat(np.array([h[0] for h in heads], np.uint64), [len(h) for h in heads])
            gram = np.concatenate(heads)
            order = np.argsort(gram, kind="stable")
            keys = np.fromiter(self.children, np.uint64, len(self.children))
            at = np.argsort(keys)
            self.heads = gram[order], at[np.searchsorted(keys[at], first[order])]
        gram, branch = self.heads
        mine = grams[: prefix(len(grams), percent)]
        low, high = np.searchsorted(gram, mine, "left"), np.searchsorted(gram, mine, "right")
        n = high - low
        return np.unique(branch[np.repeat(low - np.cumsum(n) + n, n) + np.arange(n.sum())])

    def branches(self) -> tuple:
        """The children, their runs one after the other, and the sizes below them."""
        if self.flat is None:
            kids = list(self.children.values())
            sizes = np.array([len(k.run) for k in kids])
            self.flat = (
                kids, np.concatenate([k.run for k in kids]), np.cumsum(sizes) - sizes, sizes,
                np.array([k.least for k in kids]), np.array([k.most for k in kids]),
            )
        return self.flat


def prefix(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def by_rarity(sets: list[np.ndarray]) -> list[np.ndarray]:
    """The sets as sorted ranks of their n-grams, the rarest of all the sets first."""
    if not sets:
        return []
    grams, at, n = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    rank = np.empty(len(grams), np.uint64)
    rank[np.argsort(n, kind="stable")] = np.arange(len(grams), dtype=np.uint64)
    return [np.sort(s) for s in np.split(rank[at], np.cumsum([len(s) for s in sets])[:-1])]


def join_sets(sets: list[np.ndarray], percent: int) -> list[int]:
    """For each set the first set of its component, sets being linked at the threshold."""
    parent = list(range(len(sets)))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    tree, sets = Tree(np.zeros(0, np.uint64)), by_rarity(sets)
    for i, grams in enumerate(sets):
        tree.insert(grams, i)
    for i, grams in enumerate(sets):
        for j in tree.similar(grams, percent):
            a, b = root(i), root(j)
            parent[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(sets))]


def _sizes(words: int):
    def work(table: pa.Table) -> pa.Table:
        n, first, second = [], [], []
        for grams in shingle_sets(table["text"].cast(pa.binary()).to_pylist(), words):
            n.append(len(grams))
            first.append(int(mix(grams).sum(dtype=np.uint64).astype(np.int64)))
            second.append(int(mix(grams ^ SECOND).sum(dtype=np.uint64).astype(np.int64)))
        out = table.drop_columns(["text"])
        for name, column in (("n", n), ("first", first), ("second", second)):
            out = out.append_column(name, pa.array(column, pa.int64()))
        return out

    return work


def _signature_blocks(buckets: int, words: int, percent: int):
    """Signatures of texts, or of sets that are at hand, and what they connect here, by bucket."""
    ends = size_classes(percent)

    def work(table: pa.Table) -> pa.Table:
        sigs, counts = [], []
        if "text" in table.column_names:
            keys, sets = table["key"].to_numpy(), shingle_sets(table["text"].cast(pa.binary()).to_pylist(), words)
        else:
            keys, sets = table["node"].to_numpy(), (np.frombuffer(g, np.uint64) for g in table["grams"].to_pylist())
        for grams in sets:
            found = signatures(grams, ends, percent) if len(grams) else grams
            sigs.append(found)
            counts.append(len(found))
        sig = np.concatenate(sigs) if sigs else np.zeros(0, np.uint64)
        key = np.repeat(keys, counts)
        order = np.lexsort((key, sig))
        sig, key = sig[order], key[order]
        new = np.append(True, sig[1:] != sig[:-1])[: len(sig)]
        # Of equal signatures one goes on, under the first document that its own is connected with right here.
        hub = key[np.maximum.accumulate(np.where(new, np.arange(len(sig)), 0))] if len(sig) else key
        a, b = forest(key[~new], hub[~new])
        key = _renamed(key, a, b)
        edge_bucket = -1 - (mix(a.astype(np.uint64)) % np.uint64(buckets)).astype(np.int64)
        spread = mix(sig[new])
        bucket = (((spread >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)).astype(np.int64)
        left = spread & SIGNATURE_BITS
        named, place = np.unique(key[new], return_inverse=True)
        order = np.argsort(bucket.astype(np.uint64) << np.uint64(40) | left)
        rows = [(x, *_packed(sig, at, named)) for x, sig, at in _by_bucket(bucket, order, left, place)]
        order = np.argsort(edge_bucket, kind="stable")
        rows += [(x, one.tobytes(), other.tobytes(), b"") for x, one, other in _by_bucket(edge_bucket, order, a, b)]
        columns = list(zip(*rows, strict=True)) or [[] for _ in range(4)]
        return pa.table([pa.array(c, k) for c, k in zip(columns, [pa.int64()] + [pa.binary()] * 3, strict=True)], names=["bucket", "left", "right", "place"])

    return work


def _by_bucket(bucket: np.ndarray, order: np.ndarray, *columns: np.ndarray) -> Iterator[tuple]:
    bucket, columns = bucket[order], [c[order] for c in columns]
    cuts = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])[: len(bucket)])
    for x, y in zip(cuts, np.append(cuts[1:], len(bucket))[: len(cuts)], strict=True):
        yield int(bucket[x]), *(c[x:y] for c in columns)


def _packed(left: np.ndarray, place: np.ndarray, keys: np.ndarray) -> tuple[bytes, bytes, bytes]:
    """Sorted numbers of 40 bits, low bytes first and the highest of all behind them, and each one's key by its place among those that occur."""
    used = np.bincount(place, minlength=len(keys)) > 0
    keys, place = keys[used], (np.cumsum(used) - 1)[place]
    place = place.astype(np.uint16 if len(keys) <= 2**16 else np.uint32)
    return left.astype(np.uint32).tobytes() + (left >> np.uint64(32)).astype(np.uint8).tobytes(), keys.tobytes(), place.tobytes()


def _unpacked(left: bytes, keys: bytes, place: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = len(left) // 5
    value = np.frombuffer(left, np.uint32, n).astype(np.int64) | np.frombuffer(left, np.uint8, n, 4 * n).astype(np.int64) << 32
    return value, np.frombuffer(keys, np.int64)[np.frombuffer(place, np.uint16 if len(place) == 2 * n else np.uint32)]


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the numbers that the pairs connect, each with the least of its component; the least ones are left out."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    label = np.arange(len(nodes))
    while (apart := label[x] != label[y]).any():
        x, y = x[apart], y[apart]
        left, right = label[x], label[y]
        np.minimum.at(label, np.maximum(left, right), np.minimum(left, right))
        while ((up := label[label]) != label).any():
            label = up
    moved = label != np.arange(len(nodes))
    return nodes[moved], nodes[label[moved]]


def _renamed(key: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``key`` with each of ``a``, which is sorted, replaced by its ``b``."""
    if not len(a):
        return key
    at = np.minimum(np.searchsorted(a, key), len(a) - 1)
    return np.where(a[at] == key, b[at], key)


def _equal_signatures(parts: int):
    """What the signatures of a bucket connect: a row for each part of the documents."""

    def work(table: pa.Table) -> pa.Table:
        found = zip(*(table[c].to_pylist() for c in ("left", "right", "place")), strict=True)
        signed = table["bucket"][0].as_py() >= 0
        sides = [_unpacked(*row) if signed else tuple(np.frombuffer(b, np.int64) for b in row[:2]) for row in found]
        left, right = (np.concatenate(c) for c in zip(*sides, strict=True))
        if signed:
            order = np.lexsort((right, left))
            left, right = left[order], right[order]
            new = np.append(True, left[1:] != left[:-1])
            hub = right[np.maximum.accumulate(np.where(new, np.arange(len(left)), 0))]
            left, right = right[~new], hub[~new]
        a, b = forest(left, right)
        part = (mix(a.astype(np.uint64)) % np.uint64(parts)).astype(np.int64)
        rows = [(x, one.tobytes(), other.tobytes()) for x, one, other in _by_bucket(part, np.argsort(part, kind="stable"), a, b)]
        columns = list(zip(*rows, strict=True)) or [[] for _ in range(3)]
        return pa.table([pa.array(c, k) for c, k in zip(columns, [pa.int64(), pa.binary(), pa.binary()], strict=True)], names=["part", "a", "b"])

    return work


def _connected(table: pa.Table) -> pa.Table:
    """Edges that connect what all those of a part connect: documents meet in many buckets."""
    a, b = forest(*(np.frombuffer(b"".join(table[c].to_pylist()), np.int64) for c in ("a", "b")))
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def candidate_edges(rows: DataFrame, grams: int, words: int, percent: int) -> DataFrame:
    """``a, b``: edges that connect the documents that equal signatures connect, once for each part of the documents."""
    per_gram = 2.5 * (100 - percent) / (100 + percent) * 2
    buckets = max(1, int(grams * per_gram) // BUCKET_SIGNATURES + 1)
    text, size = ("text", TEXT_BYTES) if "text" in rows.columns else ("grams", SET_BYTES)
    work = in_chunks(_signature_blocks(buckets, words, percent), text, size)
    blocks = rows.select("key" if text == "text" else "node", text).mapInArrow(work, "bucket long, left binary, right binary, place binary")
    parts = buckets // PART_BUCKETS + 1
    found = blocks.groupBy("bucket").applyInArrow(per_group(_equal_signatures(parts)), "part long, a binary, b binary")
    return found.groupBy("part").applyInArrow(per_group(_connected), "a long, b long")


def _gram_marks(bits, buckets: int, words: int):
    """The n-grams of the sets of a batch: a row for each bucket of n-grams, with how many each set has there and 32
    bits of each; and one row with the sets themselves and their sizes, which no bucket has to look at.
    """

    def work(table: pa.Table) -> pa.Table:
        table = _in_bits(table, bits.value)
        node = table["key"].to_numpy()
        kinds, names = [pa.int64()] * 3 + [pa.binary()] * 3, ["bucket", "batch", "sets", "nodes", "n", "marks"]
        if not len(node):
            return pa.table([pa.array([], k) for k in kinds], names=names)
        sets = list(shingle_sets(table["text"].cast(pa.binary()).to_pylist(), words))
        width = np.array([len(x) for x in sets], np.uint32)
        owner = np.repeat(np.arange(len(sets)), width)
        spread = mix(np.concatenate(sets))
        bucket = (((spread >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        edges = np.searchsorted(bucket[order], np.arange(buckets + 1))
        rows = [(-1 - int(node[0]) % buckets, int(node[0]), len(sets), node.tobytes(), _small(width), b"")]
        for b, (x, y) in enumerate(zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)):
            if y > x:
                here = order[x:y]
                n = np.bincount(owner[here], minlength=len(sets)).astype(np.uint32)
                rows.append((b, int(node[0]), len(sets), b"", _small(n), spread[here].astype(np.uint32).tobytes()))
        return pa.table([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    return work


def _small(n: np.ndarray) -> bytes:
    return pa.compress(n.astype(np.uint32).tobytes(), codec="zstd", asbytes=True)


def _counts(table: pa.Table) -> list[np.ndarray]:
    rows = zip(table["n"].to_pylist(), table["sets"].to_pylist(), strict=True)
    return [np.frombuffer(pa.decompress(n, 4 * sets, codec="zstd", asbytes=True), np.uint32).astype(np.int64) for n, sets in rows]


def _shared_marks(table: pa.Table) -> pa.Table:
    """How many n-grams of a bucket each set shares with another; those with equal bits count as equal."""
    names = ["batch", "sets", "nodes", "n"]
    if table["bucket"][0].as_py() < 0:
        return table.select(names)
    counts = _counts(table)
    marks = np.frombuffer(b"".join(table["marks"].to_pylist()), np.uint32)
    order = np.argsort(marks)
    equal = marks[order[1:]] == marks[order[:-1]]
    shared = np.zeros(len(marks), bool)
    shared[order] = np.append(False, equal) | np.append(equal, False)
    so_far = np.append(0, np.cumsum(shared))
    ends = np.cumsum(np.concatenate(counts))
    n = so_far[ends] - so_far[ends - np.concatenate(counts)]
    cuts = np.cumsum([len(c) for c in counts])[:-1]
    found = pa.array([_small(x) for x in np.split(n, cuts)], pa.binary())
    return table.select(names).set_column(3, "n", found)


def _supported(percent: int):
    """The sets of a batch that share enough n-grams to be similar to any other."""

    def work(table: pa.Table) -> pa.Table:
        named = np.array([len(b) > 0 for b in table["nodes"].to_pylist()])
        counts = _counts(table)
        first = int(np.flatnonzero(named)[0])
        node, size = np.frombuffer(table["nodes"][first].as_py(), np.int64), counts[first]
        shared = sum((c for c, own in zip(counts, named, strict=True) if not own), np.zeros(len(node), np.int64))
        return pa.table({"node": pa.array(node[100 * shared >= percent * size], pa.int64())})

    return work


def supported(rows: DataFrame, groups: DataFrame, words: int, percent: int) -> DataFrame:
    """``node``: documents of ``groups`` that may have a similar one among them.

    Two similar sets share at least ``percent`` of the n-grams of each, so a set
    with fewer n-grams that any other has cannot be in a pair.  N-grams are told
    apart by bucket and 32 bits; equal bits of different ones keep a set too many.
    """
    bits = rows.sparkSession.sparkContext.broadcast(_filter_of(groups))
    grams = groups.agg(F.sum("n")).first()[0] or 0
    buckets = max(GRAM_BUCKETS, grams // MARKS)
    shape = "bucket long, batch long, sets long, nodes binary, n binary, marks binary"
    marks = _hashed(rows).mapInArrow(in_chunks(_gram_marks(bits, buckets, words), chars=TEXT_BYTES), shape)
    shared = marks.groupBy("bucket").applyInArrow(per_group(_shared_marks), "batch long, sets long, nodes binary, n binary")
    return write_table(shared.groupBy("batch").applyInArrow(_supported(percent), "node long"), "supported")


def _filter_of(keys: DataFrame) -> np.ndarray:
    """A bit for each hash of a key; a fixed number of bits whatever the number of keys."""
    at = F.pmod(F.xxhash64("node"), F.lit(FILTER_BITS))
    maps = keys.groupBy(F.floor(at / 32768).alias("part")).agg(F.bitmap_construct_agg((at % 32768).cast("int")).alias("bits"))
    out = np.zeros(FILTER_BITS // 8, np.uint8)
    for r in maps.collect():
        out[r["part"] * 4096 : (r["part"] + 1) * 4096] = np.frombuffer(r["bits"], np.uint8)
    return out


def _hashed(rows: DataFrame) -> DataFrame:
    return rows.select("key", F.pmod(F.xxhash64("key"), F.lit(FILTER_BITS)).alias("at"), "text")


def _in_bits(table: pa.Table, bits: np.ndarray) -> pa.Table:
    at = table["at"].to_numpy()
    return table.filter(pa.array(((bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1).astype(bool)))


def candidate_sets(rows: DataFrame, groups: DataFrame, words: int) -> DataFrame:
    """The rows of ``groups`` with the ``grams`` of their documents."""
    bits = rows.sparkSession.sparkContext.broadcast(_filter_of(groups))

    def work(table: pa.Table) -> pa.Table:
        table = _in_bits(table, bits.value)
        grams = [g.tobytes() for g in shingle_sets(table["text"].cast(pa.binary()).to_pylist(), words)]
        return pa.table({"node": table["key"], "grams": pa.array(grams, pa.binary())})

    sets = _hashed(rows).mapInArrow(in_chunks(work, chars=TEXT_BYTES), "node long, grams binary")
    return groups.join(sets, "node")


def _joined(percent: int):
    """Joins the groups of a bucket, one after the other."""

    def work(table: pa.Table) -> pa.Table:
        table = table.sort_by([("component", "ascending"), ("node", "ascending")])
        component, node = table["component"].to_numpy(), table["node"].to_numpy()
        grams = table["grams"].to_pylist()
        cuts = np.flatnonzero(np.append(True, component[1:] != component[:-1])[: len(component)])
        label = np.zeros(len(node), np.int64)
        for x, y in zip(cuts, np.append(cuts[1:], len(node))[: len(cuts)], strict=True):
            first = join_sets([np.frombuffer(g, np.uint64) for g in grams[x:y]], percent)
            label[x:y] = node[x:y][first]
        return pa.table({"a": pa.array(node, pa.int64()), "b": pa.array(label, pa.int64())})

    return work


def _cell_links(percent: int):
    """Joins a block of outsiders with a block of members: links between documents not yet connected."""

    def work(table: pa.Table) -> pa.Table:
        side, node, star = (table[c].to_pylist() for c in ("side", "node", "star"))
        tree, linked = Tree(np.zeros(0, np.uint64)), []
        sets = by_rarity([np.frombuffer(g, np.uint64) for g in table["grams"].to_pylist()]) if 0 < sum(side) < len(side) else []
        for i, grams in enumerate(sets):
            if side[i] == 0:
                tree.insert(grams, i)
        for i, grams in enumerate(sets):
            if side[i] == 1:
                seen = {star[i]}
                for j in tree.similar(grams, percent):
                    if star[j] not in seen:
                        seen.add(star[j])
                        linked.append((node[i], node[j]))
        a, b = zip(*linked, strict=True) if linked else ([], [])
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return work


def _overlaps(percent: int):
    """The similarity of each row's set to another set in the row, whether they are linked, and whether they are
    so far apart that no set linked with the other can be linked with this one (null counts as the empty set).
    """

    def run(batches):
        for batch in batches:
            score, linked, far = [], [], []
            for x, y in zip(batch.column("grams").to_pylist(), batch.column("other").to_pylist(), strict=True):
                a, b = np.frombuffer(x, np.uint64), np.frombuffer(y or b"", np.uint64)
                o = len(np.intersect1d(a, b, assume_unique=True))
                union = len(a) + len(b) - o
                score.append(o / max(1, union))
                linked.append(100 * o >= percent * union)
                # The Jaccard distance is a metric: beyond twice the distance of a link.
                far.append(100 * o < (2 * percent - 100) * union)
            kept = [batch.column(c) for c in ("component", "node", "grams")]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(score, pa.float64()), pa.array(linked, pa.bool_()), pa.array(far, pa.bool_())],
                names=["component", "node", "grams", "score", "linked", "far"],
            )

    return run


def _gram_blocks(buckets: int):
    """Members of each component that have an n-gram, counted within the batch: a row for each component and bucket of n-grams."""

    def run(batches):
        for batch in batches:
            sets = [np.frombuffer(g, np.int64) for g in batch.column("grams").to_pylist()]
            component = np.repeat(batch.column("component").to_numpy(), [len(s) for s in sets])
            gram = np.concatenate(sets) if sets else np.zeros(0, np.int64)
            bucket = (gram.view(np.uint64) % np.uint64(buckets)).astype(np.int64)
            order = np.lexsort((gram, bucket, component))
            component, gram, bucket = component[order], gram[order], bucket[order]
            block = np.append(True, (np.diff(component) != 0) | (np.diff(bucket) != 0))[: len(gram)]
            new = np.flatnonzero(block | np.append(True, np.diff(gram) != 0)[: len(gram)])
            times = np.diff(np.append(new, len(gram)))
            first = np.flatnonzero(block[new])
            last = np.append(first[1:], len(new))[: len(first)]
            grams = gram[new]
            columns = [
                pa.array(component[new][first], pa.int64()), pa.array(bucket[new][first], pa.int64()),
                pa.array([grams[i:j].tobytes() for i, j in zip(first, last, strict=True)], pa.binary()),
                pa.array([times[i:j].tobytes() for i, j in zip(first, last, strict=True)], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["component", "bucket", "grams", "times"])

    return run


def _most_have(table: pa.Table) -> pa.Table:
    """The n-grams of a bucket that more than half of the members have."""
    grams = np.frombuffer(b"".join(table["grams"].to_pylist()), np.int64)
    times = np.frombuffer(b"".join(table["times"].to_pylist()), np.int64)
    distinct, place = np.unique(grams, return_inverse=True)
    n = np.bincount(place, times, len(distinct)).astype(np.int64)
    common = distinct[2 * n > table["members"][0].as_py()]
    return pa.table({"component": pa.array(np.full(len(common), table["component"][0].as_py()), pa.int64()), "gram": pa.array(common, pa.int64())})


def large_group_links(sets: DataFrame, percent: int) -> DataFrame:
    """``a, b``: links that connect the groups too large for one task.

    A group's centre is the member nearest to the n-grams that most members
    have; members linked with it are one star.  What is outside the star meets
    itself in blocks, and the star unless it is too far from the centre for a
    link.  Every other pair that is not connected by the star is compared, so no
    link is lost.  Without n-grams that most members have any member is the centre.
    """
    sets = sets.select("component", "node", "grams")
    shape = "component long, node long, grams binary, score double, linked boolean, far boolean"
    grams = sets.agg(F.sum(F.octet_length("grams"))).first()[0] or 0
    buckets = max(GRAM_BUCKETS, grams // 8 // BUCKET_GRAMS)
    blocks = sets.mapInArrow(_gram_blocks(buckets), "component long, bucket long, grams binary, times binary")
    sizes = sets.groupBy("component").agg(F.count(F.lit(1)).alias("members"))
    counted = blocks.join(sizes, "component").groupBy("component", "bucket")
    common = counted.applyInArrow(per_group(_most_have), "component long, gram long")

    def pack(table: pa.Table) -> pa.Table:
        grams = np.sort(table["gram"].to_numpy().view(np.uint64))
        return pa.table({"component": pa.array([table["component"][0].as_py()], pa.int64()), "other": pa.array([grams.tobytes()], pa.binary())})

    # The n-grams that most members have are fewer than twice the mean set.
    shared = write_table(common.groupBy("component").applyInArrow(pack, "component long, other binary"), "common-grams")
    near = sets.join(shared, "component", "left").mapInArrow(_overlaps(percent), shape)
    order = F.struct(F.col("score"), -F.col("node"), F.col("grams"))
    centre = write_table(
        near.groupBy("component").agg(F.max(order).alias("c")).select("component", (-F.col("c.col2")).alias("centre"), F.col("c.grams").alias("other")),
        "centres",
    )
    starred = sets.join(centre.select("component", "other"), "component").mapInArrow(_overlaps(percent), shape)
    starred = starred.join(centre.select("component", "centre"), "component")
    starred = write_table(
        starred.select("component", "node", "grams", F.when(F.col("linked"), F.col("centre")).otherwise(F.col("node")).alias("star"), "linked", "far"),
        "stars",
    )
    # Similar sets are of one size class or of neighbouring ones.  In a class, blocks by
    # hash.  A block of outsiders meets the star's blocks of its class and the two beside
    # it, and the outsiders of its class and the next, where both sides are the same kind.
    ends = F.array(*[F.lit(int(e)) for e in size_classes(percent)])
    placed = starred.withColumn("class", F.size(F.filter(ends, lambda e: e < F.octet_length("grams") / 8)))
    placed = placed.withColumn("h", F.pmod(F.xxhash64("node"), F.lit(2**40))).withColumn("star_side", F.col("linked"))
    steps = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), n - 1))
    near_classes = [F.struct(F.lit(True).alias("s"), (F.col("class") + i).alias("c")) for i in (-1, 0, 1)]
    own_classes = [F.struct(F.lit(False).alias("s"), (F.col("class") + i).alias("c")) for i in (0, 1)]
    meets = F.explode(F.when(F.col("far"), F.array(*own_classes)).otherwise(F.array(*near_classes, *own_classes)))
    probes = placed.where("not linked").withColumn("meets", meets)
    probes = probes.withColumn("class", F.col("meets.c")).withColumn("star_side", F.col("meets.s"))
    place = ["component", "star_side", "class"]
    # The larger the sets of a class, the fewer a block holds.
    held = F.greatest(F.lit(BLOCK_SETS), F.floor(F.lit(BLOCK_GRAMS) / F.get(ends, F.col("class"))))
    blocks = placed.groupBy(*place).agg(F.count(F.lit(1)).alias("n")).withColumn("blocks", F.floor(F.col("n") / held) + 1).drop("n")
    outer = probes.groupBy(*place).agg(F.count(F.lit(1)).alias("n")).withColumn("outer", F.floor(F.col("n") / held) + 1).drop("n")
    per_class = write_table(blocks.join(outer, place), "class-blocks")
    tasks = int(sets.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tasks = max(tasks, per_class.agg(F.coalesce(F.sum(F.col("blocks") * F.col("outer")), F.lit(0))).first()[0] // 4)
    cell = [*place, "node", "grams", "star"]
    members = placed.join(per_class, place).select(*cell, F.lit(0).alias("side"), (F.col("h") % F.col("blocks")).alias("x"), steps(F.col("outer")).alias("y"))
    outside = probes.join(per_class, place).select(*cell, F.lit(1).alias("side"), steps(F.col("blocks")).alias("x"), (F.col("h") % F.col("outer")).alias("y"))
    # By number, so that small but slow cells are not put together in few tasks.
    met = members.unionByName(outside).repartition(int(tasks), *place, "x", "y")
    cells = met.groupBy(*place, "x", "y").applyInArrow(per_group(_cell_links(percent)), "a long, b long")
    return starred.where("linked").select(F.col("node").alias("a"), F.col("star").alias("b")).unionByName(cells)


def _with_members(groups: DataFrame) -> DataFrame:
    """``groups`` with the size of each component."""
    groups = write_table(groups, "groups")
    sizes = groups.groupBy("component").agg(F.count(F.lit(1)).alias("members"))
    return write_table(groups.join(sizes, "component").select("node", "component", "members"), "group-sizes")


def near_duplicates(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, block: int = BLOCK) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_shingles, component_id``.

    Two documents are linked if their sets of ``words``-word shingles have a
    Jaccard similarity of ``percent`` / 100 or more; a component is named by its
    smallest ``doc_id``.  A text without words, empty or null, is linked with
    nothing.  Rows with repeated or null ids are documents of their own (a null
    id names a component only if it has no other).  Other columns are not read.
    Shingles are told apart by 64-bit hashes, whole sets by 128 bits.
    """
    rows = keyed(docs)
    slim = write_table(rows.mapInArrow(in_chunks(_sizes(words), chars=TEXT_BYTES), "key long, doc_id long, n long, first long, second long"), "set-sizes")
    # Equal sets are one node from here on.
    alike = [F.col(c) for c in ("n", "first", "second")]
    reps = write_table(slim.where("n > 0").groupBy(*alike).agg(F.min("key").alias("rep")), "representatives")
    named = slim.join(reps, ["n", "first", "second"], "left").select("key", "doc_id", "n", F.coalesce("rep", "key").alias("rep"))
    named = write_table(named, "named")
    grams = slim.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    edges = write_table(candidate_edges(rows, grams, words, percent), "candidate-edges")
    rep = named.select("key", "rep")
    edges = edges.join(rep.select(F.col("key").alias("a"), F.col("rep").alias("ra")), "a").join(rep.select(F.col("key").alias("b"), F.col("rep").alias("rb")), "b")
    edges = write_table(edges.select(F.col("ra").alias("a"), F.col("rb").alias("b")).where("a <> b").distinct(), "representative-edges")
    label = None
    if edges.limit(1).count():
        groups = _with_members(components(edges))
        small, large = groups.where(F.col("members") <= block), None
        if groups.where(F.col("members") > block).limit(1).count():
            chained = groups.where(F.col("members") > block).join(named.select(F.col("key").alias("node"), "n"), "node")
            kept = groups.join(supported(rows, chained, words, percent), "node", "left_semi").where(F.col("members") > block)
            sets = write_table(candidate_sets(rows, small.unionByName(kept), words), "sets")
            kept = sets.where(F.col("members") > block).select("node", "grams")
            grams = (kept.agg(F.sum(F.octet_length("grams"))).first()[0] or 0) // 8
            edges = write_table(candidate_edges(kept, grams, words, percent), "supported-edges")
            # Without the others most of what stays is in small groups.
            groups = _with_members(components(edges))
            regrouped = write_table(kept.join(groups, "node").select(*sets.columns), "regrouped")
            small = sets.where(F.col("members") <= block).unionByName(regrouped.where(F.col("members") <= block))
            if groups.where(F.col("members") > block).limit(1).count():
                large = regrouped.where(F.col("members") > block)
        else:
            small = write_table(candidate_sets(rows, small, words), "sets")
        tasks = max(1, small.count() // (2 * block) + 1)
        small = small.withColumn("bucket", F.pmod(F.xxhash64("component"), F.lit(tasks)))
        label = small.select("bucket", "component", "node", "grams").groupBy("bucket").applyInArrow(per_group(_joined(percent)), "a long, b long")
        if large is not None:
            links = large_group_links(large, percent)
            found = components(links).select(F.col("node").alias("a"), F.col("component").alias("b"))
            label = label.unionByName(found)
        label = write_table(label, "labels").select(F.col("a").alias("rep"), F.col("b").alias("least"))
        named = named.join(label, "rep", "left")
    else:
        named = named.withColumn("least", F.lit(None).cast("long"))
    least = F.coalesce("least", "rep")
    ids = named.where(F.col("key") == least).select(F.col("key").alias("least"), F.col("doc_id").alias("component_id"))
    out = named.select("doc_id", F.col("n").alias("n_shingles"), least.alias("least"))
    return out.join(ids, "least").select("doc_id", "n_shingles", "component_id")


def drop_near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one document, the smallest id, of each group of near duplicates; all columns unchanged.

    Texts without words stay.  Rows that share an id stay together; a null id stays.
    Other columns may have any names.
    """
    found = near_duplicates(docs, words, percent)
    name = free_name(docs, "_dropped")
    dropped = found.where("component_id <> doc_id").select(F.col("doc_id").alias(name)).distinct()
    dropped = write_table(dropped, "dropped")
    return docs.join(dropped, docs["doc_id"] == dropped[name], "left_anti")

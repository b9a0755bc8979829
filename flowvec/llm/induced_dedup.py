"""Removal of repeated byte strings, by induced sorting spread over the cluster.

Suffixes are not sorted one by one.  A sample is sorted first and the others are
induced from it: in every string of ``length`` bytes one place stands out by its
content alone (the least hash of ``GRAM`` bytes, the leftmost of equals), so equal
strings have the same sampled place and lie at the same distance from it.

1. The sampled places of all documents are sorted by their content; places whose
   content occurs once carry no repeat and go no further.
2. The runs of strings that a repeated place stands for are sorted by the hashes
   of their contexts.  All but the first of equal contexts are repeats as a whole.
3. Only places with different contexts send those contexts themselves, each from
   where it occurs first.  The strings that they share are induced: each is found at
   its distance from the place, and all but the first repeat.

The shuffle's sort, which spills to disk, is the queue that carries the tuples.
A place that very many documents share is not gathered in one task: its strings
are spread by their own hashes, and each task sends the first of equals only.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowvec.llm.common import in_chunks, keyed, per_group, write_table
from flowvec.llm.wordhash import BASE, BYTE, INVERSE, mix, powers

LENGTH = 100
GRAM = 24
# Bytes that are hashed together.
SEGMENT = 1_000_000
# Places of a sorting task, and bytes of contexts of a comparing task.
PLACES = 1_000_000
CONTEXT_BYTES = 12_000_000
# Bytes of text and strings that a task holds at once.
PIECE = 8_000_000
STRINGS = 500_000
# Bytes of text whose documents' repeats are brought together.
PART_BYTES = 32_000_000
# Of compression: what is shuffled fills the disk.
LEVEL = 6
# Slices of the filters of places with several contexts and of the first of each, as a power of two.
SLICES = 7
# Bits that places and contexts are told apart by: 88 together.
PLACE_BITS, CONTEXT_BITS = np.uint64((2**40 - 1) << 24), np.uint64((2**48 - 1) << 16)
# Bits of the filter of repeated places.  It only saves traffic: a place that
# passes by chance is found to be alone later.
FILTER_BITS = 26
# Occurrences from which on a place's strings are spread by their own hashes.
HOT = 512


def gram_hashes(codes: np.ndarray) -> np.ndarray:
    """Hashes of ``GRAM`` (24) bytes at each place, by doubling."""
    h, width = codes, 1
    parts = {}
    while width <= GRAM:
        parts[width] = h
        if 2 * width > GRAM:
            break
        h = mix(h[:-width] * BASE + h[width:]) if width == 4 else h[:-width] * BASE + h[width:]
        width *= 2
    out, done = parts[width], width
    rest = GRAM - done
    while rest:
        width = 1 << (rest.bit_length() - 1)
        n = len(codes) - done - width + 1
        out = out[:n] * BASE + parts[width][done : done + n]
        done, rest = done + width, rest - width
    return mix(out)


def sampled(codes: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of strings with one sampled place: place, first and last start, hash of the place."""
    value = gram_hashes(codes)
    place = np.arange(len(value))
    own = value
    window, width = length - GRAM + 1, 1

    def join(value, place, step, n):
        right = value[step : step + n] < value[:n]
        return np.where(right, value[step : step + n], value[:n]), np.where(right, place[step : step + n], place[:n])

    while 2 * width <= window:
        value, place = join(value, place, width, len(value) - width)
        width *= 2
    if window > width:
        value, place = join(value, place, window - width, len(value) - (window - width))
    first = np.flatnonzero(np.append(True, place[1:] != place[:-1]))
    last = np.append(first[1:], len(place)) - 1
    return place[first], first, last, own[place[first]]


def runs_of(texts: list[bytes], length: int) -> Iterator[tuple[int, int, bytes, tuple]]:
    """Row, offset, bytes and runs of each text that is long enough; long texts in overlapping segments."""
    for row, text in enumerate(texts):
        for at in range(0, max(0, len(text) - length + 1), SEGMENT):
            part = text[at : at + SEGMENT + length - 1]
            *found, place = sampled(BYTE[np.frombuffer(part, np.uint8)], length)
            yield row, at, part, (*found, place & PLACE_BITS)


def _bucket_rows(bucket: np.ndarray, *columns: np.ndarray) -> Iterator[tuple]:
    order = np.argsort(bucket, kind="stable")
    bucket = bucket[order]
    cuts = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])[: len(bucket)])
    for x, y in zip(cuts, np.append(cuts[1:], len(bucket))[: len(cuts)], strict=True):
        yield int(bucket[x]), order[x:y], [c[order[x:y]] for c in columns]


def _places(bits: int, length: int):
    """The sampled places of a piece of input with their numbers, by bucket."""

    def work(table: pa.Table) -> pa.Table:
        found = [runs[3] for _, _, _, runs in runs_of(table["text"].cast(pa.binary()).to_pylist(), length)]
        place, n = np.unique(np.concatenate(found) if found else np.zeros(0, np.uint64), return_counts=True)
        bucket = (place >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(place), np.int64)
        rows = [(b, p.tobytes(), c.tobytes()) for b, _, (p, c) in _bucket_rows(bucket, place, np.minimum(n, 65535).astype(np.uint16))]
        columns = list(zip(*rows, strict=True)) or [[], [], []]
        return pa.table([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.binary()), pa.array(columns[2], pa.binary())], names=["bucket", "places", "counts"])

    return work


def _repeated(bits: int):
    """The slice of the filters that a bucket's repeated places set: one for all, one for hot ones."""

    def work(table: pa.Table) -> pa.Table:
        place = np.concatenate([np.frombuffer(b, np.uint64) for b in table["places"].to_pylist()])
        n = np.concatenate([np.frombuffer(b, np.uint16) for b in table["counts"].to_pylist()]).astype(np.int64)
        order = np.argsort(place, kind="stable")
        place, n = place[order], n[order]
        first = np.flatnonzero(np.append(True, place[1:] != place[:-1]))
        total, place = np.add.reduceat(n, first), place[first]
        size = 1 << (FILTER_BITS - bits)
        at = ((place >> np.uint64(64 - FILTER_BITS)) & np.uint64(size - 1)).astype(np.int64)
        maps = []
        for least in (2, HOT):
            flags = np.zeros(size, np.uint8)
            flags[at[total >= least]] = 1
            maps.append(np.packbits(flags).tobytes())
        return pa.table({"bucket": [table["bucket"][0].as_py()], "repeated": pa.array(maps[:1], pa.binary()), "hot": pa.array(maps[1:], pa.binary()), "n": [int(total[total >= 2].sum())]})

    return work


def place_filter(rows: DataFrame, n_bytes: int, length: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Filters of repeated and of hot places, of a fixed size, and how often repeated places occur."""
    per_place = (length - GRAM + 2) / 2
    bits = min(FILTER_BITS - 6, max(0, int(n_bytes / per_place / PLACES).bit_length()))
    places = rows.select("text").mapInArrow(in_chunks(_squeezed(_places(bits, length)), chars=PIECE), "bucket long, places binary, counts binary")
    maps = places.groupBy("bucket").applyInArrow(_restored(_repeated(bits)), "bucket long, repeated binary, hot binary, n long")
    width = (1 << (FILTER_BITS - bits)) // 8
    repeated, hot, n = np.zeros((1 << FILTER_BITS) // 8, np.uint8), np.zeros((1 << FILTER_BITS) // 8, np.uint8), 0
    for r in maps.collect():
        here = slice(r["bucket"] * width, (r["bucket"] + 1) * width)
        repeated[here], hot[here] = np.frombuffer(r["repeated"], np.uint8), np.frombuffer(r["hot"], np.uint8)
        n += r["n"]
    return repeated, hot, n


def _in_filter(flags: np.ndarray, place: np.ndarray) -> np.ndarray:
    at = (place >> np.uint64(64 - FILTER_BITS)).astype(np.int64)
    return ((flags[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1).astype(bool)


def span_hashes(codes: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the bytes from ``start`` to ``end``; equal strings have equal hashes wherever they lie."""
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(codes * powers(BASE, len(codes)), dtype=np.uint64)])
    raw = (sums[end] - sums[start]) * powers(INVERSE, len(codes) + 1)[start]
    return mix(raw ^ mix((end - start).astype(np.uint64)))


def _all_but_first(*columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted by all columns, grouped by the first two: the row numbers of each group's first, and of the others."""
    order = np.lexsort(columns[::-1])
    a, b = columns[0][order], columns[1][order]
    first = np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1]))[: len(order)]
    return order[first], order[~first]


_TUPLES = "bucket long, kind int, place binary, hash binary, key binary, start binary, size binary, context binary"


def _tuple_table(rows: list[tuple]) -> pa.Table:
    kinds = [pa.int64(), pa.int32()] + [pa.binary()] * 6
    columns = list(zip(*rows, strict=True)) or [[] for _ in kinds]
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=[c.split()[0] for c in _TUPLES.split(", ")])


# Binary columns with the bytes of one of their entries.
_ENTRIES = {"place": 8, "hash": 8, "key": 8, "start": 8, "size": 1, "context": 1, "places": 8, "counts": 2, "marks": 8, "keys": 8, "widths": 8, "runs": 16}


def _changed(table: pa.Table, change) -> pa.Table:
    for at, name in enumerate(table.column_names):
        if name in _ENTRIES:
            table = table.set_column(at, name, pa.array([change(b, _ENTRIES[name]) if b else b for b in table[name].to_pylist()], pa.binary()))
    return table


def _turned(blob: bytes, rows: int) -> bytes:
    return np.frombuffer(blob, np.uint8).reshape(rows, -1).T.tobytes()


def _codec() -> pa.Codec:
    return pa.Codec("zstd", compression_level=LEVEL)


def _squeezed(work):
    """What ``work`` makes with its binary columns compressed, the first bytes of all numbers first: most numbers are
    small or sorted, and contexts overlap.
    """

    def small(blob: bytes, width: int) -> bytes:
        return len(blob).to_bytes(8, "little") + _codec().compress(_turned(blob, len(blob) // width), asbytes=True)

    return lambda table: _changed(work(table), small)


def _restored(work):
    """``work`` on a table whose binary columns are compressed."""

    def whole(blob: bytes, width: int) -> bytes:
        return _turned(pa.decompress(blob[8:], int.from_bytes(blob[:8], "little"), codec="zstd", asbytes=True), width)

    return lambda table: work(_changed(table, whole))


def _mark(place: np.ndarray, key: np.ndarray, start: np.ndarray) -> np.ndarray:
    """A hash of an occurrence of a place, in the slice of the place."""
    own = mix(place ^ mix(mix(key.astype(np.uint64)) + start.astype(np.uint64)))
    left = np.uint64(64 - SLICES)
    return (place >> left << left) | (own >> np.uint64(SLICES))


def _contexts(repeated, hot, several, buckets: int, length: int, firsts=None):
    """Of a piece of input, the first of equal ones of: contexts of repeated places (kind 0) and strings of hot ones
    (1); repeats found here (2).  With ``several``, contexts of its places only, in full; with ``firsts`` only
    occurrences in that filter.
    """

    def work(table: pa.Table) -> pa.Table:
        keys = table["key"].to_numpy()
        kept: dict[int, list] = {0: [], 1: []}
        text = []
        for row, at, part, (_, first, last, place) in runs_of(table["text"].cast(pa.binary()).to_pylist(), length):
            hit = _in_filter((repeated if several is None else several).value, place)
            if firsts is not None:
                hit[hit] = _in_filter(firsts.value, _mark(place[hit], np.full(hit.sum(), keys[row]), at + first[hit]))
            if not hit.any():
                continue
            first, last, place = first[hit], last[hit], place[hit]
            codes = BYTE[np.frombuffer(part, np.uint8)]
            warm = _in_filter(hot.value, place)
            a, b, p = first[~warm], last[~warm], place[~warm]
            if len(a):
                kept[0].append((p, span_hashes(codes, a, b + length) & CONTEXT_BITS, np.full(len(a), keys[row]), at + a, b - a + 1))
                if several is not None:
                    text += [part[x : y + length] for x, y in zip(a.tolist(), b.tolist(), strict=True)]
            a, b, p = first[warm], last[warm], place[warm]
            if len(a) and several is None:
                n = b - a + 1
                start = np.repeat(a - np.cumsum(n) + n, n) + np.arange(n.sum())
                kept[1].append((np.repeat(p, n), span_hashes(codes, start, start + length) & CONTEXT_BITS, np.full(len(start), keys[row]), at + start, np.ones(len(start), np.int64)))
        rows, dropped = [], []
        for kind, found in kept.items():
            if not found:
                continue
            place, digest, key, start, size = (np.concatenate(c) for c in zip(*found, strict=True))
            # In the order of the text, in which keys, starts and overlapping contexts compress best.
            first, others = map(np.sort, _all_but_first(place, digest, key, start))
            if several is None:
                dropped.append((key[others], start[others], size[others]))
            by = place if kind == 0 else digest
            bucket = (mix(by[first]) % np.uint64(buckets)).astype(np.int64)
            for b, at, columns in _bucket_rows(bucket, place[first], digest[first], key[first], start[first], size[first].astype(np.uint8)):
                context = b"".join([text[i] for i in first[at]]) if several is not None else b""
                rows.append((b, kind, *(c.tobytes() for c in columns), context))
        for key, start, size in dropped:
            bucket = -1 - (mix(key.astype(np.uint64)) % np.uint64(buckets)).astype(np.int64)
            rows += [(b, 2, b"", b"", *(c.tobytes() for c in columns), b"") for b, _, columns in _bucket_rows(bucket, key, start, size)]
        return _tuple_table(rows)

    return work


_FOUND = "key long, runs binary, slice long, places binary, marks binary"


def _read(part: pa.Table, name: str, kind: type) -> np.ndarray:
    return np.concatenate([np.frombuffer(b, kind) for b in part[name].to_pylist()])


def _runs_table(found: list[tuple], places: np.ndarray, marks: np.ndarray) -> pa.Table:
    """Runs by document; places, and marks of their contexts, by slice of their filters."""
    key, start, size = (np.concatenate(c) for c in zip(*found, strict=True))
    rows = [(k, np.stack(c, 1).tobytes(), None, None, None) for k, _, c in _bucket_rows(key, start, size)]
    by = [(x >> np.uint64(64 - SLICES)).astype(np.int64) for x in (places, marks)]
    # Every place has marks, in its own slice.
    both = zip(_bucket_rows(by[0], places), _bucket_rows(by[1], marks), strict=True)
    rows += [(None, None, k, c[0].tobytes(), m[0].tobytes()) for (k, _, c), (_, _, m) in both]
    kinds = [pa.int64(), pa.binary()] * 2 + [pa.binary()]
    columns = list(zip(*rows, strict=True)) or [[] for _ in kinds]
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=[c.split()[0] for c in _FOUND.split(", ")])


_PACKED = "part long, keys binary, widths binary, runs binary, slice long, places binary, marks binary"


def _by_part(work, parts: int):
    """The runs that ``work`` finds in a row for each part of the documents, not for each document."""

    def run(table: pa.Table) -> pa.Table:
        found = work(table)
        mine = found.filter(pa.compute.is_valid(found["key"]))
        key, runs = mine["key"].to_numpy(), mine["runs"].to_pylist()
        part = (mix(key.astype(np.uint64)) % np.uint64(parts)).astype(np.int64)
        width = np.array([len(r) // 16 for r in runs], np.int64)
        rows = [(p, k.tobytes(), n.tobytes(), b"".join([runs[i] for i in at])) for p, at, (k, n) in _bucket_rows(part, key, width)]
        columns = list(zip(*rows, strict=True)) or [[] for _ in range(4)]
        rest = found.filter(pa.compute.is_null(found["key"])).select(["slice", "places", "marks"])
        kinds = [pa.int64()] + [pa.binary()] * 3
        packed = pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["part", "keys", "widths", "runs"])
        return pa.concat_tables([packed, rest], promote_options="default").select([c.split()[0] for c in _PACKED.split(", ")])

    return run


def _by_document(table: pa.Table) -> pa.Table:
    """The runs of each document of a part, those that touch as one."""
    key = np.repeat(_read(table, "keys", np.int64), _read(table, "widths", np.int64))
    start, size = _read(table, "runs", np.int64).reshape(-1, 2).T
    order = np.lexsort((start, key))
    key, start, end = key[order], start[order], (start + size)[order]
    # Documents one after the other on one line, so that the ends so far can be taken over all of them at once.
    new = np.append(True, key[1:] != key[:-1])[: len(key)]
    base = (np.cumsum(new) - 1) * (int(end.max(initial=0)) + 1)
    far = np.maximum.accumulate(base + end)
    head = np.flatnonzero(new | (base + start > np.append(0, far[:-1])[: len(key)]))
    last = np.append(head[1:], len(key))[: len(head)] - 1
    runs = np.stack([start[head], (far - base)[last] - start[head]], 1)
    cuts = np.flatnonzero(new[head])
    ends = np.append(cuts[1:], len(head))[: len(cuts)]
    blobs = [[runs[x:y].tobytes()] for x, y in zip(cuts, ends, strict=True)]
    return pa.table({"key": pa.array(key[head][cuts], pa.int64()), "runs": pa.array(blobs, pa.list_(pa.binary()))})


def _repeats(table: pa.Table) -> pa.Table:
    """Repeated contexts and strings of a bucket, the places whose contexts differ, and where each of these is first."""
    found, places, marks = [], [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)]
    for kind in (0, 1, 2):
        part = table.filter(pa.compute.equal(table["kind"], kind))
        if not part.num_rows:
            continue
        key, start = _read(part, "key", np.int64), _read(part, "start", np.int64)
        size = _read(part, "size", np.int64 if kind == 2 else np.uint8).astype(np.int64)
        if kind == 2:
            found.append((key, start, size))
            continue
        place = _read(part, "place", np.uint64)
        first, others = _all_but_first(place, _read(part, "hash", np.uint64), key, start)
        found.append((key[others], start[others], size[others]))
        if kind == 0:
            first = _several(place, first)
            places.append(np.unique(place[first]))
            marks.append(_mark(place[first], key[first], start[first]))
    return _runs_table(found, np.concatenate(places), np.concatenate(marks))


def _several(place: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Of rows sorted by place those whose place has more than one."""
    same = np.append(False, place[first][1:] == place[first][:-1])[: len(first)]
    return first[same | np.append(same[1:], False)[: len(first)]]


def _slice_bits(table: pa.Table) -> pa.Table:
    """The slices of the filters that the places and marks set."""
    size = 1 << (FILTER_BITS - SLICES)
    out = {"slice": table["slice"].slice(0, 1)}
    for name, of in (("bits", "places"), ("firsts", "marks")):
        if of in table.column_names:
            flags = np.zeros(size, np.uint8)
            flags[((_read(table, of, np.uint64) >> np.uint64(64 - FILTER_BITS)) & np.uint64(size - 1)).astype(np.int64)] = 1
            out[name] = pa.array([np.packbits(flags).tobytes()], pa.binary())
    return pa.table(out)


def _shared_strings(length: int):
    """Repeated strings of a bucket's places with several contexts."""

    def work(table: pa.Table) -> pa.Table:
        key, start = _read(table, "key", np.int64), _read(table, "start", np.int64)
        size, place = _read(table, "size", np.uint8).astype(np.int64), _read(table, "place", np.uint64)
        first, _ = _all_but_first(place, _read(table, "hash", np.uint64), key, start)
        several = _several(place, first)
        contexts = b"".join(table["context"].to_pylist())
        return _runs_table([_induced(place, key, start, size, several, contexts, length)], place[:0], place[:0])

    return work


def _induced(place, key, start, size, several, contexts: bytes, length: int):
    """Strings shared by different contexts of a place; all but the first of equals."""
    if not len(several):
        return key[:0], start[:0], size[:0]
    width = size + length - 1
    begin = np.cumsum(width) - width
    # In groups of places, so that few strings are at hand at once.
    out = []
    several = several[np.argsort(place[several], kind="stable")]
    cut = np.flatnonzero(np.append(True, place[several][1:] != place[several][:-1]))
    weight = np.add.reduceat(size[several], cut)
    group = np.cumsum(weight) // STRINGS
    raw = np.frombuffer(contexts, np.uint8)
    ends = np.append(cut[1:], len(several))
    for g in np.unique(group):
        mine = np.flatnonzero(group == g)
        rows = several[cut[mine[0]] : ends[mine[-1]]]
        n, wide = size[rows], width[rows]
        local = np.cumsum(wide) - wide
        codes = BYTE[raw[np.repeat(begin[rows] - local, wide) + np.arange(wide.sum())]]
        step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        at = np.repeat(local, n) + step
        digest = span_hashes(codes, at, at + length)
        k, s = np.repeat(key[rows], n), np.repeat(start[rows], n) + step
        _, others = _all_but_first(np.repeat(place[rows], n), digest, k, s)
        others.sort()
        # Neighbouring starts of one document as one run.
        k, s = k[others], s[others]
        new = np.append(True, (k[1:] != k[:-1]) | (s[1:] != s[:-1] + 1))[: len(k)]
        head = np.flatnonzero(new)
        out.append((k[head], s[head], np.diff(np.append(head, len(k)))))
    return tuple(np.concatenate(c) for c in zip(*out, strict=True))


def removed(runs: list[bytes], length: int) -> list[tuple[int, int]]:
    """Maximal removed spans of a document from the runs of its repeated strings."""
    each = np.concatenate([np.frombuffer(r, np.int64).reshape(-1, 2) for r in runs])
    each = each[np.argsort(each[:, 0], kind="stable")]
    start, end = each[:, 0], np.maximum.accumulate(each.sum(1) - 1 + length)
    new = np.append(True, start[1:] > end[:-1])
    return list(zip(start[new].tolist(), end[np.append(new[1:], True)].tolist(), strict=True))


FILTER_KEYS = 2**25


def _key_filter(keys: DataFrame) -> np.ndarray:
    at = F.pmod(F.xxhash64("key"), F.lit(FILTER_KEYS))
    maps = keys.groupBy(F.floor(at / 32768).alias("part")).agg(F.bitmap_construct_agg((at % 32768).cast("int")).alias("bits"))
    out = np.zeros(FILTER_KEYS // 8, np.uint8)
    for r in maps.collect():
        out[r["part"] * 4096 : (r["part"] + 1) * 4096] = np.frombuffer(r["bits"], np.uint8)
    return out


RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _cut(table: pa.Table, length: int) -> pa.Table:
    out = []
    for doc_id, n, sha, text, runs in zip(*(table[c].to_pylist() for c in ("doc_id", "n_bytes", "sha", "text", "runs")), strict=True):
        spans = []
        if runs:
            text = pa.decompress(text, n, codec="zstd", asbytes=True)
            spans, done, digest = removed(runs, length), 0, hashlib.sha256()
            for a, b in spans:
                digest.update(text[done:a])
                done = b
            digest.update(text[done:])
            sha = digest.hexdigest()
        out.append((doc_id, n, sum(b - a for a, b in spans), len(spans), sha))
    columns = list(zip(*out, strict=True)) or [[] for _ in range(5)]
    kinds = [pa.int64()] * 4 + [pa.string()]
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=[c.split()[0] for c in RESULT.split(", ")])


def repeated_runs(rows: DataFrame, n_bytes: int, length: int) -> DataFrame:
    """``key, runs``: for each document with repeats the runs of starts of its repeated strings."""
    repeated, hot, n = place_filter(rows, n_bytes, length)
    ship = rows.sparkSession.sparkContext.broadcast
    buckets = int(n * (length - GRAM + 2 + length) // 2 // CONTEXT_BYTES + 1)
    parts = int(n_bytes // PART_BYTES + 1)
    texts, repeated, hot = rows.select("key", "text"), ship(repeated), ship(hot)
    tuples = texts.mapInArrow(in_chunks(_squeezed(_contexts(repeated, hot, None, buckets, length)), chars=PIECE), _TUPLES)
    whole = write_table(tuples.groupBy("bucket").applyInArrow(per_group(_squeezed(_by_part(_restored(_repeats), parts))), _PACKED), "repeated-contexts")
    slices = whole.where("slice is not null").select("slice", "places", "marks").groupBy("slice").applyInArrow(_restored(_slice_bits), "slice long, bits binary, firsts binary")
    width = (1 << (FILTER_BITS - SLICES)) // 8
    several, firsts = np.zeros((1 << FILTER_BITS) // 8, np.uint8), np.zeros((1 << FILTER_BITS) // 8, np.uint8)
    for r in slices.collect():
        here = slice(r["slice"] * width, (r["slice"] + 1) * width)
        several[here], firsts[here] = np.frombuffer(r["bits"], np.uint8), np.frombuffer(r["firsts"], np.uint8)
    tuples = texts.mapInArrow(in_chunks(_squeezed(_contexts(repeated, hot, ship(several), buckets, length, ship(firsts))), chars=PIECE), _TUPLES)
    shared = tuples.groupBy("bucket").applyInArrow(per_group(_squeezed(_by_part(_restored(_shared_strings(length)), parts))), _PACKED)
    found = whole.where("part is not null").unionByName(shared).select("part", "keys", "widths", "runs")
    return found.groupBy("part").applyInArrow(_restored(_by_document), "key long, runs array<binary>")


def remove_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_bytes, n_removed, n_spans, kept_sha256``.

    A byte is removed if a string of ``length`` bytes that covers it also starts
    earlier, in a smaller ``doc_id`` or further left in the same document.
    Null counts as empty; texts shorter than ``length`` lose nothing.  Rows with
    repeated or null ids are documents of their own, null last.  Other columns
    are not read; an empty table gives an empty result.  Strings are told apart
    by two hashes, 48 or 64 bits of the string and 40 bits of its sampled place.
    """
    if length < 2 * GRAM:
        raise ValueError(f"length must be at least {2 * GRAM}")
    rows = keyed(docs)
    n_bytes = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    runs = write_table(repeated_runs(rows, n_bytes, length), "repeats")
    flags = rows.sparkSession.sparkContext.broadcast(_key_filter(runs.select("key")))

    def read(table: pa.Table) -> pa.Table:
        at = table["at"].to_numpy()
        hit = ((flags.value[at >> 3] >> (at & 7).astype(np.uint8)) & 1).astype(bool)
        texts = table["text"].cast(pa.binary()).to_pylist()
        return pa.table(
            {
                "key": table["key"],
                "doc_id": table["doc_id"],
                "n_bytes": pa.array([len(t) for t in texts], pa.int64()),
                "sha": pa.array([None if h else hashlib.sha256(t).hexdigest() for t, h in zip(texts, hit, strict=True)], pa.string()),
                "text": pa.array([_codec().compress(t, asbytes=True) if h else None for t, h in zip(texts, hit, strict=True)], pa.binary()),
            }
        )

    hashed = rows.select("key", "doc_id", F.pmod(F.xxhash64("key"), F.lit(FILTER_KEYS)).alias("at"), "text")
    shown = hashed.mapInArrow(in_chunks(read), "key long, doc_id long, n_bytes long, sha string, text binary")
    joined = shown.join(runs, "key", "left")

    def finish(batches):
        for batch in batches:
            table = pa.Table.from_batches([batch])
            columns = (table[c].to_pylist() for c in ("sha", "text", "n_bytes", "runs"))
            sha = [hashlib.sha256(pa.decompress(t, n, codec="zstd", asbytes=True)).hexdigest() if s is None and not r else s for s, t, n, r in zip(*columns, strict=True)]
            table = table.set_column(table.schema.get_field_index("sha"), "sha", pa.array(sha, pa.string()))
            yield from _cut(table, length).to_batches()

    return joined.mapInArrow(finish, RESULT)

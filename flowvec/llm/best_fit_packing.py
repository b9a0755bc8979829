"""Token matrices packed by best fit decreasing, written with segment lengths and position resets.

Every task packs the documents it reads, so no token is shuffled.  Documents
longer than a row are cut into full rows and a rest; rests go, longest first,
to the row with the least room that still takes them, found in a segment tree
over capacities.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowvec.llm.common import in_chunks, text_of, write_table
from flowvec.llm.word_transducer import encoder, tokenizer_path

ROW = 4096
END = 2


class RoomTree:
    """Rows by room: which room of at least a given size is the smallest there is."""

    def __init__(self, most: int):
        self.size = 1 << most.bit_length()
        self.count = np.zeros(2 * self.size, np.int64).tolist()
        self.rows: list[list[int]] = [[] for _ in range(most + 1)]

    def _add(self, room: int, n: int) -> None:
        i = room + self.size
        while i:
            self.count[i] += n
            i >>= 1

    def put(self, room: int, row: int) -> None:
        self.rows[room].append(row)
        self._add(room, 1)

    def take(self, least: int) -> tuple[int, int] | None:
        """Room and number of a row with the smallest room of ``least`` or more."""
        i = least + self.size
        if not self.count[i]:
            # Up until a right neighbour has rows, then down to its leftmost.
            while i > 1 and (i & 1 or not self.count[i + 1]):
                i >>= 1
            if i <= 1:
                return None
            i += 1
            while i < self.size:
                i = 2 * i if self.count[2 * i] else 2 * i + 1
        room = i - self.size
        self._add(room, -1)
        return room, self.rows[room].pop()


def best_fit(lengths: np.ndarray, row: int = ROW) -> list[list[int]]:
    """Items (each at most ``row`` long) in rows, each row a list of item numbers in the order they were put."""
    tree, rows = RoomTree(row), []
    for item in np.argsort(-lengths, kind="stable").tolist():
        need = int(lengths[item])
        found = tree.take(need)
        if found is None:
            found = row, len(rows)
            rows.append([])
        room, at = found
        rows[at].append(item)
        if room > need:
            tree.put(room - need, at)
    return rows


def cut(lengths: np.ndarray, row: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Documents as items of at most ``row`` tokens: document, start, length."""
    pieces = -(-lengths // row)
    doc = np.repeat(np.arange(len(lengths)), pieces)
    number = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    start = number * row
    return doc, start, np.minimum(row, lengths[doc] - start)


MATRIX = (
    "sequence_id long, n_tokens int, ids binary, cu_seqlens array<int>, position_resets array<int>, "
    "doc_ids array<long>, doc_starts array<long>, doc_tokens array<long>"
)
_TYPES = [pa.int64(), pa.int32(), pa.binary()] + [pa.list_(pa.int32())] * 2 + [pa.list_(pa.int64())] * 3


def pack_documents(docs: DataFrame, tokenizer: str | None = None, row: int = ROW, end: int = END) -> DataFrame:
    """Packed rows of token ids: one line per sequence.

    ``ids`` are little-endian unsigned 16-bit, padded with ``end`` to ``row``;
    ``cu_seqlens`` the cumulative segment lengths from 0 to ``n_tokens``;
    ``position_resets`` the offsets at which positions start from 0 again.
    Each document is its ids and one ``end``; null and empty texts are just
    ``end``; ids may be null or repeated.  An empty table gives no rows.
    """
    tokenizer = tokenizer or tokenizer_path()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))

    def start_task():
        state = {"next": 0}

        def work(table: pa.Table) -> pa.Table:
            found = encoder(tokenizer).encode(table["text"].cast(pa.binary()).to_pylist())
            tokens = [np.append(ids, np.uint16(end)) for ids in found]
            ids = table["doc_id"].to_pylist()
            lengths = np.fromiter(map(len, tokens), np.int64, len(tokens))
            doc, start, size = cut(lengths, row)
            out = []
            base = TaskContext.get().partitionId() << 32
            for items in best_fit(size, row):
                parts = [tokens[doc[i]][start[i] : start[i] + size[i]] for i in items]
                ends = np.cumsum([0, *(size[i] for i in items)]).astype(np.int32)
                line = np.full(row, end, "<u2")
                line[: ends[-1]] = np.concatenate(parts)
                out.append(
                    (
                        base + state["next"], int(ends[-1]), line.tobytes(), ends.tolist(), ends[:-1].tolist(),
                        [ids[doc[i]] for i in items], [int(start[i]) for i in items], [int(lengths[doc[i]]) for i in items],
                    )
                )
                state["next"] += 1
            columns = list(zip(*out, strict=True)) or [[] for _ in _TYPES]
            names = [c.split()[0] for c in MATRIX.split(", ")]
            return pa.table([pa.array(c, k) for c, k in zip(columns, _TYPES, strict=True)], names=names)

        return work

    def run(batches):
        yield from in_chunks(start_task())(batches)

    return rows.mapInArrow(run, MATRIX)


PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, sequence_tokens long"


def pieces(matrix: DataFrame) -> DataFrame:
    """The segments of packed rows, each with the checksum of its ids as 32-bit numbers."""

    def run(batches):
        names = [c.split()[0] for c in PIECES.split(", ")]
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                ids = np.frombuffer(r["ids"], "<u2").astype("<u4")
                ends = r["cu_seqlens"]
                for a, b, doc, start, n in zip(ends, ends[1:], r["doc_ids"], r["doc_starts"], r["doc_tokens"], strict=False):
                    out.append((doc, start, b - a, zlib.crc32(ids[a:b].tobytes()), n, r["sequence_id"], a, r["n_tokens"]))
            columns = list(zip(*out, strict=True)) or [[] for _ in names]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)

    return matrix.mapInArrow(run, PIECES)


def packed_pieces(docs: DataFrame, tokenizer: str | None = None, row: int = ROW, end: int = END) -> DataFrame:
    """Pack, write the matrices to the shared folder, and list the segments as they were written."""
    return pieces(write_table(pack_documents(docs, tokenizer, row, end), "packed"))

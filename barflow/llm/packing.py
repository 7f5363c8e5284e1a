"""Sum-of-squares packing of token ids into sequences of a fixed length.

Every task packs the documents it reads, in one pass. A document goes, whole,
into the open window that keeps the sum of squared counts of open windows per
fill level smallest; the counts stand in an array by level. What is still open
at the end, or when too many windows are open, is closed without padding:
windows are filled up with pieces cut from the emptiest ones, and the last one
is cut into sequences whose lengths are powers of two.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barflow.llm.tokens import default_path, encoder

CAPACITY, END_ID = 4096, 2
#: Open windows a task holds (16 KB of ids each).
MAX_OPEN = 1024

_FIELDS = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


class Packer:
    """Windows are lists of pieces ``[doc, start, ids, doc_tokens]``, ids as bytes."""

    def __init__(self, capacity: int = CAPACITY, max_open: int = MAX_OPEN):
        self.capacity, self.max_open = capacity, max_open
        self.levels = np.zeros(capacity + 1, np.int64)
        self.windows: list[list[list]] = [[] for _ in self.levels]
        self.open = 0
        self.done: list[list] = []

    def add(self, doc, ids: bytes) -> None:
        total, at = len(ids) // 4, 0
        while total - at >= self.capacity:
            self.done.append([[doc, at, ids[4 * at:4 * (at + self.capacity)], total]])
            at += self.capacity
        if at < total:
            self._place([doc, at, ids[4 * at:], total], total - at)

    def _place(self, piece: list, size: int) -> None:
        """Moving a window from level h to k changes the sum of squared counts N
        by 2 (N[k] - N[h]) + 2, opening one by 2 N[k] + 1, filling one by 1 - 2 N[h]."""
        n, last = self.levels, self.capacity - size
        best, cost = 0, 2 * n[size] + 1
        if last:
            here = n[1:last + 1]
            change = np.where(here > 0, 2 * (n[1 + size:] - here) + 2, np.iinfo(np.int64).max)
            if here[-1]:
                change[-1] = 1 - 2 * here[-1]
            k = last - 1 - int(np.argmin(change[::-1]))  # the fullest on ties
            if change[k] <= cost:
                best = k + 1
        pieces = []
        if best:
            pieces = self.windows[best].pop()
            n[best] -= 1
            self.open -= 1
        pieces.append(piece)
        if best + size == self.capacity:
            self.done.append(pieces)
            return
        self.windows[best + size].append(pieces)
        n[best + size] += 1
        self.open += 1
        if self.open > self.max_open:
            self.close()

    def close(self) -> None:
        """Close all open windows; only one can be left short, and it is cut at powers of two."""
        todo = [(fill, w) for fill, level in enumerate(self.windows) for w in level]
        self.levels[:] = 0
        self.windows = [[] for _ in self.levels]
        self.open = 0
        low, high = 0, len(todo) - 1
        while low < high:
            fill, pieces = todo[high]
            gap = self.capacity - fill
            if not gap:
                self.done.append(pieces)
                high -= 1
                continue
            left, donor = todo[low]
            moved = _take(donor, min(gap, left))
            todo[high] = (fill + min(gap, left), pieces + moved)
            todo[low] = (left - min(gap, left), donor)
            low += left <= gap
        if todo:
            fill, pieces = todo[high]
            if fill == self.capacity:
                self.done.append(pieces)
                return
            for bit in range(fill.bit_length() - 1, -1, -1):
                if fill >> bit & 1:
                    self.done.append(_take(pieces, 1 << bit))


def _take(pieces: list, size: int) -> list:
    """Cut ``size`` tokens off the end of ``pieces``."""
    out = []
    while size:
        doc, start, ids, total = pieces.pop()
        n = len(ids) // 4
        if n > size:
            pieces.append([doc, start, ids[:4 * (n - size)], total])
            start, ids, n = start + n - size, ids[4 * (n - size):], size
        out.append([doc, start, ids, total])
        size -= n
    return out[::-1]


def _pack(path: str, capacity: int, end_id: int):
    end = np.array([end_id], "<u4").tobytes()

    def rows(packer: Packer, first: int) -> pa.RecordBatch:
        cols: list[list] = [[] for _ in _FIELDS]
        for i, pieces in enumerate(packer.done):
            offset = 0
            for doc, start, ids, total in pieces:
                n = len(ids) // 4
                for col, x in zip(cols, (doc, start, n, zlib.crc32(ids), total, first + i, offset)):
                    col.append(x)
                offset += n
        packer.done = []
        return pa.record_batch([pa.array(c, pa.int64()) for c in cols], names=list(_FIELDS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # sequence ids: the task's number, then a count
        encode, packer, at = encoder(path).encode_all, Packer(capacity), TaskContext.get().partitionId() << 40
        for b in batches:
            for doc, ids in zip(b.column(0).to_pylist(), encode(b.column(1).to_pylist())):
                packer.add(doc, ids + end)
                if len(packer.done) >= 512:
                    n = len(packer.done)
                    yield rows(packer, at)
                    at += n
        packer.close()
        if packer.done:
            yield rows(packer, at)
        encoder(path).forget()
    return run


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
         tokenizer: str | None = None, end_id: int = END_ID) -> DataFrame:
    """One row per piece: ``doc_id``, ``start``, ``length``, ``ids_crc32``,
    ``doc_tokens``, ``sequence_id``, ``offset``.

    A document is its ids and ``end_id``. Documents of ``capacity`` tokens or
    more are cut into full sequences and a rest; a rest is cut only to close
    windows. No sequence is padded: each is full or a power of two long.

    Null or empty text is the end id alone; a null id stays null; repeated rows
    are packed each; an empty table gives no rows; other columns are ignored."""
    from barflow.llm.common import ARROW
    for key, value in ARROW.items():
        docs.sparkSession.conf.set(key, value)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(_pack(tokenizer or default_path(), capacity, end_id), ", ".join(f"{f} long" for f in _FIELDS))

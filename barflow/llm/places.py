"""Places in texts as longs, shared by the operators that remove repeats.

A place is one long: the first position above 11 bits of the number of window
starts. It belongs to a row's ``(id, key)``, see :func:`keyed`.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barflow.llm.common import row_id

LENGTH = 11
MOST = (1 << LENGTH) - 1


def keyed(docs: DataFrame, id_col: str, text_col: str, carry: tuple[str, ...] = ()) -> DataFrame:
    """``(id, key, text, _carry_0, ...)``. ``key`` parts rows that share an id, or
    have none, by a 64-bit hash of their texts. Where each id has one text, which
    one pass over the rows tells, it is zero and takes no room."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    own = F.xxhash64(text)
    several = (docs.select(row_id(id_col).alias("id"), own.alias("key")).groupBy("id")
               .agg(F.min("key").alias("low"), F.max("key").alias("high")).filter("low <> high"))
    key = F.lit(0).cast("long") if several.isEmpty() else own
    return docs.select(row_id(id_col).alias("id"), key.alias("key"), text.alias("text"),
                       *[F.col(c).alias(f"_carry_{i}") for i, c in enumerate(carry)])


def place(first: np.ndarray, length: np.ndarray | int) -> np.ndarray:
    return (first.astype(np.int64) << LENGTH) | length


def joined(at: np.ndarray) -> np.ndarray:
    """Places of ascending window starts, neighbours joined."""
    if not len(at):
        return np.zeros(0, np.int64)
    new = np.concatenate([[True], np.diff(at) != 1])
    head = np.flatnonzero(new)
    run = np.arange(len(at)) - np.repeat(head, np.diff(np.concatenate([head, [len(at)]])))
    head = np.flatnonzero(run % MOST == 0)
    return place(at[head], np.diff(np.concatenate([head, [len(at)]])))


def ranges(places: np.ndarray) -> np.ndarray:
    """``(first, length)`` of the places, ascending."""
    p = np.sort(places)
    return np.stack([p >> LENGTH, p & MOST], 1)


def covered(places: pa.Scalar, width: int) -> list[dict]:
    """Maximal spans that the windows of ``width`` at these places cover."""
    found: list[dict] = []
    if places.is_valid:
        for first, length in ranges(np.asarray(places.values)).tolist():
            start, stop = first, first + length - 1 + width
            if found and start <= found[-1]["stop"]:
                found[-1]["stop"] = max(found[-1]["stop"], stop)
            else:
                found.append({"start": start, "stop": stop})
    return found


SPANS = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))


def texts(b: pa.RecordBatch):
    """``(id, key, text as UTF-8)`` of a batch's first three columns."""
    for key, part, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).cast(pa.binary()).to_pylist()):
        yield key, part, data or b""


def longs(parts: list[np.ndarray]) -> pa.Array:
    x = np.concatenate(parts) if parts else np.zeros(0, np.int64)
    return pa.array(x.view(np.int64))


def by_row(places: DataFrame) -> DataFrame:
    return places.groupBy("id", "key").agg(F.collect_list("at").alias("places"))


def first_in_text(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """True where a pair stands for the first time."""
    order = np.lexsort((np.arange(len(left)), right, left))
    a, b = left[order], right[order]
    out = np.ones(len(left), bool)
    out[order[1:]] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    return out

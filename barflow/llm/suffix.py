"""Removal of repeated byte strings by hashed anchors and one doubling step.

Ranks name the strings of a length: equal strings, equal ranks. They are hashes
of the strings, not ranks from rounds of prefix doubling: strings of half the
threshold are hashed on a sample of positions that every repeated string must
hit, and positions go as soon as their rank is unique; what is left is ranked
once more, at the full threshold, by the pair of hashes at offset zero and at
half the threshold. Spark deals and groups the rank rows of both steps.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barflow.llm.common import Scratch, bit_test, keep_bits, scratch
from barflow.llm.places import LENGTH, MOST, SPANS, by_row, covered, keyed, longs, place, ranges, texts
from barflow.llm.rolling import BYTE_CODES, mix, pairs_at, runs, span_ranks

#: Bits of the filters that spare the shuffle rows that can't match (16 MB; more rows only weaken them).
FILTER_BITS = 27
#: Windows of one run are compared in so many blocks of common core before one by one.
CORES = 4
Batches = Iterator[pa.RecordBatch]


def _first_ranks(threshold: int):
    """Round one: a row per run of windows, ranked by its sampled position's first half."""
    def run(batches: Batches) -> Batches:
        for b in batches:
            gram, span = [], []
            for _, _, data in texts(b):
                r = runs(np.frombuffer(data, np.uint8), threshold, threshold // 2, BYTE_CODES)
                gram.append(r.gram)
                span.append(r.span)
            yield pa.record_batch([longs(gram), longs(span)], names=["g", "s"])
    return run


def _blocks(threshold: int) -> list[tuple[int, int]]:
    """The offsets a window's anchor can have, in CORES ranges."""
    widest = threshold - threshold // 2
    step = -(-(widest + 1) // CORES)
    return [(k * step, min((k + 1) * step - 1, widest)) for k in range(CORES)]


def _cores(text: np.ndarray, r, threshold: int) -> list[np.ndarray]:
    """Per block of window offsets, the rank of the bytes that all windows of
    the block hold; zero where the run has no window of the block."""
    near, far = r.anchor - r.last, r.anchor - r.first
    out = []
    for k, (lo, hi) in enumerate(_blocks(threshold)):
        have = (near <= hi) & (far >= lo)
        start, stop = r.anchor[have] - lo, r.anchor[have] - hi + threshold
        # 32 bits: cores only rule windows out, and an odd number is never the zero of a missing one
        out.append(np.zeros(len(near), np.int32))
        out[-1][have] = (mix(span_ranks(text, start, stop, BYTE_CODES) + np.uint64(k + 1)).astype(np.uint32) | np.uint32(1)).view(np.int32)
    return out


def _recurring_runs(threshold: int, bits):
    """The runs whose first rank recurs, with all that later rounds compare."""
    names = ["g", "s", "id", "key", "at", "near", *[f"c{k}" for k in range(CORES)]]

    def run(batches: Batches) -> Batches:
        for b in batches:
            cols: list[list[np.ndarray]] = [[] for _ in names]
            for key, part, data in texts(b):
                text = np.frombuffer(data, np.uint8)
                r = runs(text, threshold, threshold // 2, BYTE_CODES)
                keep = bit_test(bits.value, FILTER_BITS, r.gram) if len(r.gram) else np.zeros(0, bool)
                if not keep.any():
                    continue
                r = type(r)(r.gram[keep], r.span[keep], r.first[keep], r.last[keep], r.anchor[keep])
                at = place(r.first, r.last - r.first + 1)
                own = [r.gram, r.span, np.full(len(at), key, np.int64), np.full(len(at), part, np.int64), at, r.anchor - r.last]
                for col, x in zip(cols, own + _cores(text, r, threshold)):
                    col.append(x)
            if cols[0]:
                yield pa.record_batch([longs(c) for c in cols[:6]] + [pa.array(np.concatenate(c)) for c in cols[6:]], names=names)
    return run


def _window_pairs(threshold: int):
    """Round two: rank pairs of every window that is still open."""
    def run(batches: Batches) -> Batches:
        for b in batches:
            cols: list[list[np.ndarray]] = [[], [], [], [], []]
            for (key, part, data), places in zip(texts(b), b.column(3)):
                open_ = ranges(np.asarray(places.values))
                at = np.unique(np.concatenate([np.arange(f, f + n) for f, n in open_])) if len(open_) else np.zeros(0, int)
                if not len(at):
                    continue
                left, right = pairs_at(np.frombuffer(data, np.uint8), threshold, at, BYTE_CODES)
                # 96 bits tell windows apart
                for col, x in zip(cols, (left, right.astype(np.uint32).view(np.int32), np.full(len(at), key, np.int64),
                                         np.full(len(at), part, np.int64), place(at, 1))):
                    col.append(x)
            if cols[0]:
                yield pa.record_batch([longs(cols[0]), pa.array(np.concatenate(cols[1])), *map(longs, cols[2:])],
                                      names=["r1", "r2", "id", "key", "at"])
    return run


def _cut(threshold: int, as_text: bool):
    """Remove what the marked windows cover."""
    def run(batches: Batches) -> Batches:
        for b in batches:
            n_bytes, n_removed, cuts, kept = [], [], [], []
            for (_, _, data), places in zip(texts(b), b.column(3)):
                found = covered(places, threshold)
                edges = [0, *[x for c in found for x in (c["start"], c["stop"])], len(data)]
                n_bytes.append(len(data))
                n_removed.append(sum(c["stop"] - c["start"] for c in found))
                cuts.append(found)
                kept.append(b"".join(data[i:j] for i, j in zip(edges[::2], edges[1::2])))
            yield pa.record_batch([*[b.column(i) for i in range(4, b.num_columns)], pa.array(n_bytes, pa.int64()),
                                   pa.array(n_removed, pa.int64()), pa.array(cuts, SPANS),
                                   pa.array([x.decode("utf-8", "ignore") for x in kept], pa.string()) if as_text
                                   else pa.array(kept, pa.binary())],
                                  names=[*b.schema.names[4:], "n_bytes", "n_removed", "spans", "kept"])
    return run


def _marks(found: DataFrame, threshold: int, s: Scratch) -> tuple[DataFrame, DataFrame]:
    """From the recurring runs: places whose windows all start earlier too, and
    places whose windows are still open.

    Runs with equal spans hold the same windows, so all but the earliest are
    marked. The earliest of each span stays open where its rank has other spans
    and the core of its windows recurs among them."""
    where = F.struct("id", "key", "at")
    earliest = s.table(found.groupBy("g", "s").agg(
        F.min(where).alias("first"), F.count(F.lit(1)).alias("n"), F.min("near").alias("near"),
        *[F.min(f"c{k}").alias(f"c{k}") for k in range(CORES)]), "spans")
    later = (found.join(earliest.filter("n > 1").select("g", "s", "first"), ["g", "s"])
             .filter(where != F.col("first")).select("id", "key", "at"))
    at, length = F.col("first.at"), F.col("first.at").bitwiseAND(F.lit(MOST))
    cores = earliest.select("first", F.explode(F.array(*[
        F.struct(F.lit(k).alias("k"), F.col(f"c{k}").alias("c"),
                 F.greatest(F.lit(lo), "near").alias("lo"), F.least(F.lit(hi), F.col("near") + length - 1).alias("hi"))
        for k, (lo, hi) in enumerate(_blocks(threshold))])).alias("x"), at.alias("at"),
        (length - 1 + F.col("near")).alias("anchor")).filter("x.c <> 0").select(
        F.col("first.id").alias("id"), F.col("first.key").alias("key"), "x.k", "x.c",
        # the block's windows: their first is anchor - hi, counted from the run's first
        (F.expr(f"at - (at & {MOST})") + (F.col("anchor") - F.col("x.hi")) * F.lit(1 << LENGTH)
         + F.col("x.hi") - F.col("x.lo") + 1).alias("at"))
    cores = s.table(cores, "cores")
    again = cores.groupBy("k", "c").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("k", "c")
    return later, cores.join(again, ["k", "c"]).select("id", "key", "at")


def remove_repeats(docs: DataFrame, threshold: int = 100, id_col: str = "doc_id", text_col: str = "text",
                   carry: tuple[str, ...] = (), as_text: bool = False) -> DataFrame:
    """Cut from every text each byte covered by a string of ``threshold`` bytes
    that also starts earlier: in a text of a smaller id or earlier in the same
    text. Strings are judged on the input and never cross texts.

    Returns the id, the ``carry`` columns, ``n_bytes``, ``n_removed``, ``spans``
    (maximal removed runs, byte offsets) and ``kept``: the remaining bytes, which
    may lack part of a character, or with ``as_text`` the text they make without
    such characters. One row per row of ``docs``.

    Null text counts as empty. A null id counts as the smallest. Rows with one
    id, or none, and different texts are ordered by a 64-bit hash of their text; rows with one id
    and one text are one document, and each gets its result. An empty table
    gives no rows; other columns are ignored."""
    spark = docs.sparkSession
    if not 8 <= threshold < 1 << LENGTH:
        raise ValueError(f"threshold must be from 8 to {MOST}")
    with scratch(spark) as s:
        whole = keyed(docs, id_col, text_col, (id_col, *carry))
        rows = whole.select("id", "key", "text")
        first = rows.mapInArrow(_first_ranks(threshold), "g long, s long")
        again = s.table(first.groupBy("g").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("g"), "ranks")
        bits = spark.sparkContext.broadcast(keep_bits(again, "g", FILTER_BITS))
        kinds = "g long, s long, id long, key long, at long, near long, " + ", ".join(f"c{k} int" for k in range(CORES))
        found = s.table(rows.mapInArrow(_recurring_runs(threshold, bits), kinds).join(again, "g"), "runs")
        later, open_ = _marks(found, threshold, s)
        later = s.table(later, "later")
        s.drop(found, again)
        wanted = by_row(open_)
        pairs = s.table(rows.join(wanted, ["id", "key"]).select("id", "key", "text", "places")
                        .mapInArrow(_window_pairs(threshold), "r1 long, r2 int, id long, key long, at long"), "pairs")
        where = F.struct("id", "key", "at")
        low = pairs.groupBy("r1", "r2").agg(F.min(where).alias("first"), F.count(F.lit(1)).alias("n")
                                            ).filter("n > 1").select("r1", "r2", "first")
        low = s.table(low, "low")
        marked = pairs.join(low, ["r1", "r2"]).filter(where != F.col("first")).select("id", "key", "at")
        places = s.table(by_row(later.unionByName(marked)), "places")
        s.drop(pairs, low, later)
        joined = whole.join(places, ["id", "key"], "left").select(
            "id", "key", "text", "places", *[f"_carry_{i}" for i in range(len(carry) + 1)])
        schema = ", ".join([*[f"_carry_{i} {docs.schema[c].dataType.simpleString()}" for i, c in enumerate((id_col, *carry))],
                            "n_bytes long", "n_removed long", "spans array<struct<start:long,stop:long>>",
                            f"kept {'string' if as_text else 'binary'}"])
        out = joined.mapInArrow(_cut(threshold, as_text), schema)
        return out.withColumnsRenamed({f"_carry_{i}": c for i, c in enumerate((id_col, *carry))})

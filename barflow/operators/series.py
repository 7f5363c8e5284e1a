"""Ordered series without one-task-per-series windows.

A series is all rows of one key (``epic``) ordered by ``(time, seq)``. The
reference shifts rows positionally (a weekend gap is one step), so the
operators here are row frames. A plain ``Window.partitionBy(epic)`` puts a
whole instrument into one task; one hot instrument may hold a third of all
rows, so the helpers below always split every series into bounded pieces:

* :func:`with_row_index` -- position of each row in its series. Rows are
  counted per ``(key, chunk)`` (partial aggregation), an exclusive prefix
  sum runs over the small chunk table, and each row adds its rank inside its
  chunk. Only the chunk table is windowed per key.
* :func:`ordered_window` -- evaluates any row frame of bounded size exactly:
  rows go to blocks of ``block_rows`` consecutive positions, the ``lookback``
  rows before and ``lookahead`` rows after a block are copied into it as halo,
  the window runs per ``(key, block)`` and the halo copies are dropped.
* :func:`running_sum` -- prefix sums: running sum inside each block plus the
  exclusive prefix of block totals.

A chunk is a time bucket, cut at splitter rows: the rows whose order columns
hash to zero modulo the chunk size. A busy bucket, also a burst at one instant,
has splitters and so falls into pieces of about that size; a quiet one has none.
Chunks are a function of the rows alone, so nothing is measured while a query is
built. Null keys and null times are groups like any other (nulls first), and
every join back is null-safe: the result equals the plain window, row by row.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

IDX = "_idx"
DEFAULT_CHUNK_SECONDS = 86_400
DEFAULT_BLOCK_ROWS = 1_000_000


def _as_list(x) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def null_safe_join(left: DataFrame, right: DataFrame, cols: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on equal or both-null columns; they appear once, from the left."""
    named = {c: f"_rhs_{i}" for i, c in enumerate(cols)}
    right = right.withColumnsRenamed(named)
    on = F.lit(True)
    for c, r in named.items():
        on = on & left[c].eqNullSafe(right[r])
    return left.join(right, on, how).drop(*named.values())


def _at_or_below(cuts: str, at: Column) -> Column:
    """How many entries of the ascending array ``cuts`` are at or below ``at``
    (0 without an array), by binary search."""
    size = F.size(cuts)
    steps = F.sequence(F.lit(0), F.floor(F.log2(size)).cast("int"))

    def halve(s: Column, _: Column) -> Column:
        lo, hi = s["lo"], s["hi"]
        mid = F.shiftright(lo + hi, 1)
        below = F.get(F.col(cuts), mid) <= at
        return F.when(lo >= hi, s).otherwise(F.struct(F.when(below, mid + 1).otherwise(lo).alias("lo"),
                                                      F.when(below, hi).otherwise(mid).alias("hi")))
    whole = F.struct(F.lit(0).alias("lo"), size.alias("hi"))
    return F.when(F.coalesce(size, F.lit(0)) > 0, F.aggregate(steps, whole, halve)["lo"]).otherwise(F.lit(0))


def _chunked(df: DataFrame, keys: list[str], order: list[str], time_col: str, chunk_seconds: int,
             chunk_rows: int) -> DataFrame:
    """Add ``_bucket``, ``_branch`` and ``_piece``: the time bucket, and the
    row's place in its tree of splitters (the piece's number tells the branch too). Splitters are one row in
    ``chunk_rows``, so their table is that much smaller than the input. A
    bucket's n splitters fall into about sqrt(n) branches of sqrt(n) each: a row
    meets the branches' first splitters, then those of its own branch, and is
    placed by binary search in either, so no row carries or scans all of them."""
    bucket = F.floor(F.unix_micros(F.col(time_col).cast("timestamp")) / F.lit(chunk_seconds * 1_000_000))
    base = df.withColumn("_bucket", bucket)
    at = F.struct(*order)
    # not the hash that places rows in shuffle partitions: that one is correlated with the keys
    splitters = (base.filter(F.pmod(F.xxhash64(F.lit("splitter"), *order), F.lit(chunk_rows)) == 0)
                 .groupBy(*keys, "_bucket").agg(F.sort_array(F.collect_set(at)).alias("_cuts"))
                 .withColumn("_width", F.ceil(F.sqrt(F.size("_cuts"))).cast("int")))
    firsts = F.sequence(F.lit(1), F.size("_cuts"), F.col("_width"))
    tops = splitters.select(*keys, "_bucket", F.transform(firsts, lambda i: F.element_at("_cuts", i)).alias("_tops"))
    # branch 0 lies before the first splitter and has none
    leaves = splitters.select(
        *keys, "_bucket", F.posexplode(F.transform(firsts, lambda i: F.slice("_cuts", i, F.col("_width")))).alias("_at", "_leaf"))
    leaves = leaves.select(*keys, "_bucket", (F.col("_at") + 1).alias("_branch"), "_leaf")
    placed = (null_safe_join(base, tops, [*keys, "_bucket"], "left")
              .withColumn("_branch", _at_or_below("_tops", at)).drop("_tops"))
    return (null_safe_join(placed, leaves, [*keys, "_bucket", "_branch"], "left")
            .withColumn("_piece", F.shiftleft(F.col("_branch").cast("long"), 32) + _at_or_below("_leaf", at)).drop("_leaf"))


def with_row_index(df: DataFrame, keys: Sequence[str] | str, order: Sequence[str] | str,
                   time_col: str | None = None, chunk_seconds: int = DEFAULT_CHUNK_SECONDS,
                   with_size: bool = False, block_rows: int = DEFAULT_BLOCK_ROWS) -> DataFrame:
    """Add ``_idx`` (0-based position inside its key, ascending ``order``).

    ``time_col`` (default: first ``order`` column, a timestamp) defines the
    buckets of ``chunk_seconds``; pieces have about ``block_rows / 8`` rows.
    ``with_size`` also adds ``_n``, the number of rows of the key.
    """
    keys, order = _as_list(keys), _as_list(order)
    chunk = ["_bucket", "_branch", "_piece"]
    chunked = _chunked(df, keys, order, time_col or order[0], chunk_seconds, max(1, block_rows // 8))
    counts = chunked.groupBy(*keys, *chunk).agg(F.count(F.lit(1)).alias("_cnt"))
    per_key = Window.partitionBy(*keys).orderBy(*chunk)
    offsets = counts.select(
        *keys, *chunk,
        F.coalesce(F.sum("_cnt").over(per_key.rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias("_off"),
        *([F.sum("_cnt").over(Window.partitionBy(*keys)).alias("_n")] if with_size else []),
    )
    in_chunk = Window.partitionBy(*keys, *chunk).orderBy(*order)
    return (null_safe_join(chunked, offsets, [*keys, *chunk])
            .withColumn(IDX, F.col("_off") + F.row_number().over(in_chunk) - 1)
            .drop(*chunk, "_off"))


def ordered_window(df: DataFrame, keys: Sequence[str] | str, order: Sequence[str] | str,
                   build: Callable[[Window], list[Column]], lookback: int = 0, lookahead: int = 0,
                   block_rows: int = DEFAULT_BLOCK_ROWS, chunk_seconds: int = DEFAULT_CHUNK_SECONDS,
                   indexed: bool = False, keep_index: bool = False) -> DataFrame:
    """Evaluate row-frame window columns per key, split into halo blocks.

    ``build(w)`` receives the window spec (partitioned by key and block,
    ordered by position) and returns the columns to add. Frames may reach at
    most ``lookback`` rows back and ``lookahead`` rows ahead; within that the
    result equals the plain per-key window exactly.
    """
    keys, order = _as_list(keys), _as_list(order)
    if lookback > block_rows or lookahead > block_rows:
        raise ValueError("frame reaches beyond one block; raise block_rows")
    base = df if indexed else with_row_index(df, keys, order, chunk_seconds=chunk_seconds, block_rows=block_rows)
    blk = F.floor(F.col(IDX) / block_rows)
    pos = F.col(IDX) % block_rows
    targets = [blk]
    if lookback:
        targets.append(F.when(pos >= block_rows - lookback, blk + 1))
    if lookahead:
        targets.append(F.when(pos < lookahead, blk - 1))
    spread = (base.withColumn("_home", blk)
              .withColumn("_blk", F.explode(F.array(*targets)))
              .filter(F.col("_blk").isNotNull() & (F.col("_blk") >= 0)))
    w = Window.partitionBy(*keys, "_blk").orderBy(IDX)
    out = (spread.select("*", *build(w))
           .filter(F.col("_blk") == F.col("_home"))
           .drop("_blk", "_home"))
    return out if keep_index else out.drop(IDX)


def running_sum(df: DataFrame, keys: Sequence[str] | str, order: Sequence[str] | str,
                value: str, alias: str, skip_nulls_in_place: bool = True,
                block_rows: int = DEFAULT_BLOCK_ROWS, chunk_seconds: int = DEFAULT_CHUNK_SECONDS,
                indexed: bool = False, keep_index: bool = False) -> DataFrame:
    """Cumulative sum of ``value`` per key in ``order``, via block prefix sums.

    Nulls are skipped by the sum; with ``skip_nulls_in_place`` a null input row
    keeps a null result (pandas ``cumsum``), otherwise it carries the total.
    """
    keys, order = _as_list(keys), _as_list(order)
    base = df if indexed else with_row_index(df, keys, order, chunk_seconds=chunk_seconds, block_rows=block_rows)
    base = base.withColumn("_blk", F.floor(F.col(IDX) / block_rows))
    before = Window.partitionBy(*keys).orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    prefix = (base.groupBy(*keys, "_blk")
              .agg(F.sum(value).alias("_bt"), F.count(value).alias("_bc"))
              .select(*keys, "_blk",
                      F.coalesce(F.sum("_bt").over(before), F.lit(0)).alias("_bp"),
                      F.coalesce(F.sum("_bc").over(before), F.lit(0)).alias("_bpc")))
    inner = Window.partitionBy(*keys, "_blk").orderBy(IDX).rowsBetween(Window.unboundedPreceding, 0)
    seen = F.col("_bpc") + F.count(value).over(inner)
    total = F.col("_bp") + F.coalesce(F.sum(value).over(inner), F.lit(0))
    out = null_safe_join(base, prefix, [*keys, "_blk"]).withColumn(alias, F.when(seen > 0, total))
    if skip_nulls_in_place:
        out = out.withColumn(alias, F.when(F.col(value).isNotNull(), F.col(alias)))
    out = out.drop("_blk", "_bp", "_bpc")
    return out if keep_index else out.drop(IDX)

"""Promotion of shadow models: is a shadow model's profit above the deployed one's by more than chance?

Both models' profits on the same trades form one series of differences. Neighbouring trades
depend on one another, so whole blocks are drawn: a replicate joins random blocks of ``block`` consecutive
differences (overlapping blocks, the last one cut) to a series as long as the
given one. The share of replicates whose mean isn't above zero, and the lower bound of
the mean, decide.

Sums of blocks come from prefix sums: a block is two points of the running sum, so a
replicate costs two joined rows per block however long the blocks are, and no task holds a series.
The first row of each block is a hash of seed, replicate and block number, so
a retried task draws the same. The pairs and their running sums are written once, in the shared folder.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barflow.operators import series
from barflow.session import materialize


def block_start(seed: int, replicate: Column, number: Column, starts: Column) -> Column:
    """A number below ``starts``: the first 15 hexadecimal digits of an md5, modulo ``starts``."""
    text = F.concat_ws(":", F.lit(str(seed)), replicate.cast("string"), number.cast("string"))
    return F.pmod(F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long"), starts)


def paired_block_bootstrap(trades: DataFrame, keys: Sequence[str], order: Sequence[str], deployed: str, shadow: str,
                           block: int = 20, replicates: int = 200, seed: int = 1, level: float = 0.95, scale: int = 2) -> DataFrame:
    """One row per series ``keys``: ``n`` pairs, ``mean_gain`` of the shadow model over the deployed one, ``lower`` (the
    ``1 - level`` quantile of the replicates' means), ``p_value`` (share of replicates not above zero) and ``promote``
    (``lower`` above zero).

    ``order`` starts with a timestamp and must order a series' trades uniquely. A trade without one of the profits is no
    pair. A series shorter than a block is one block. Profits are summed as decimals of ``scale`` places, so
    sums don't depend on their order; the driver sees nothing."""
    keys, order = list(keys), list(order)
    gain = (F.col(shadow).cast(f"decimal(28,{scale})") - F.col(deployed).cast(f"decimal(28,{scale})")).cast(f"decimal(28,{scale})")
    # the pairs feed the index, the blocks' totals and the sizes; the sums both ends of every block
    pairs = materialize(trades.select(*keys, *order, gain.alias("_gain")).filter(F.col("_gain").isNotNull()), "pairs")
    sums = materialize(series.running_sum(pairs, keys, order, "_gain", "_sum", keep_index=True).select(
        *keys, F.col(series.IDX).cast("long").alias("_at"), "_sum"), "sums")
    sizes = pairs.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.sum("_gain").alias("_total"))
    size = F.least(F.lit(block).cast("long"), F.col("n"))
    drawn = (sizes.select(*keys, "n", F.explode(F.sequence(F.lit(0), F.lit(replicates - 1))).alias("_rep"))
             .repartition(*keys, "_rep")
             .select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / size).cast("long"))).alias("_no")))
    first = block_start(seed, F.col("_rep"), F.col("_no"), F.col("n") - size + 1)
    last = first + F.least(size, F.col("n") - F.col("_no") * size) - 1
    ends = F.array(F.struct(last.alias("_at"), F.lit(1).alias("_sign")), F.struct((first - 1).alias("_at"), F.lit(-1).alias("_sign")))
    points = drawn.select(*keys, "n", "_rep", F.explode(ends).alias("_p")).select(*keys, "n", "_rep", "_p._at", "_p._sign").filter("_at >= 0")
    means = (series.null_safe_join(points, sums, [*keys, "_at"]).groupBy(*keys, "n", "_rep")
             .agg((F.sum(F.col("_sum") * F.col("_sign")).cast("double") / F.col("n")).alias("_mean")))
    # a number of replicates per series that is a parameter
    found = means.groupBy(*keys).agg(F.percentile("_mean", F.lit(1 - level)).alias("lower"),
                                     F.avg((F.col("_mean") <= 0).cast("double")).alias("p_value"))
    out = series.null_safe_join(sizes, found, keys)
    return out.select(*keys, "n", (F.col("_total").cast("double") / F.col("n")).alias("mean_gain"), "lower", "p_value",
                      (F.col("lower") > 0).alias("promote"))

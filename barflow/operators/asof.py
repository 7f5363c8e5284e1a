"""Forward as-of join: for each left row, the first right row (same key) at or
after its time.

No pairs are formed and no window covers a whole key:

1. Left and right rows are unioned and cut into (key, chunk) groups; inside a
   chunk, a growing frame read backwards gives each left row the next right row
   of the chunk. A chunk is a time bucket cut at splitter rows (see
   :mod:`barflow.operators.series`), so a hot day of one key is many groups.
2. Left rows with no later right row in their chunk take the first right row
   of a later chunk: a window over the small chunk table of each key carries it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barflow.operators import series


def asof_forward(left: DataFrame, right: DataFrame, keys: Sequence[str], left_time: str, right_time: str,
                 right_cols: Sequence[str], left_id: str, bucket_seconds: int = 86_400,
                 prefix: str = "", block_rows: int = series.DEFAULT_BLOCK_ROWS) -> DataFrame:
    """``left`` plus ``{prefix}{right_time}`` and ``{prefix}{c}`` for ``c`` in
    ``right_cols`` from the first right row with ``right_time >= left_time``
    (ties on time: the smallest right values win); nulls when none exists.
    ``left_id`` must be unique in ``left``."""
    keys = list(keys)
    right_cols = list(right_cols)
    r = right.select(*keys, F.col(right_time).cast("timestamp").alias("_t"), *right_cols)
    # one payload struct per right row; ordering on (time, payload) makes ties deterministic
    r = r.select(*keys, "_t", F.struct("_t", *right_cols).alias("_p"), F.lit(1).alias("_side"))
    lft = left.withColumn("_lid", F.col(left_id))
    ll = lft.select(*keys, F.col(left_time).cast("timestamp").alias("_t"),
                    F.lit(None).cast(r.schema["_p"].dataType).alias("_p"), F.lit(0).alias("_side"), "_lid")
    both = r.withColumn("_lid", F.lit(None).cast(ll.schema["_lid"].dataType)).unionByName(ll).na.drop("any", subset=[*keys, "_t"])
    chunk = [*keys, "_bucket", "_piece"]
    both = series._chunked(both, keys, ["_t", "_side", "_p"], "_t", bucket_seconds, max(1, block_rows // 8))
    # left rows sort before right rows at equal time, so the frame of a left row
    # includes right rows at the same instant ("at or after"); read backwards, a
    # growing frame costs one step per row, a shrinking one would start anew for each
    w = (Window.partitionBy(*chunk).orderBy(F.desc("_t"), F.desc("_side"), F.desc("_p"))
         .rowsBetween(Window.unboundedPreceding, 0))
    inside = (both.withColumn("_m", F.last("_p", ignorenulls=True).over(w))
              .filter(F.col("_side") == 0).select("_lid", *chunk, "_m"))
    later = (Window.partitionBy(*keys).orderBy(F.desc("_bucket"), F.desc("_piece"))
             .rowsBetween(Window.unboundedPreceding, -1))
    firsts = both.groupBy(*chunk).agg(F.min("_p").alias("_f"))
    nxt = firsts.select(*chunk, F.last("_f", ignorenulls=True).over(later).alias("_n"))
    matched = inside.join(nxt, chunk).select("_lid", F.coalesce("_m", "_n").alias("_hit"))
    out = lft.join(matched, "_lid", "left")
    return out.select(*[c for c in left.columns],
                      F.col("_hit._t").alias(f"{prefix}{right_time}"),
                      *[F.col(f"_hit.{c}").alias(f"{prefix}{c}") for c in right_cols])

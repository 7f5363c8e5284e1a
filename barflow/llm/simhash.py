"""SimHash near-duplicate groups by pigeonhole blocks."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barflow.llm.common import NULL_ID, Scratch, row_id, scratch
from barflow.llm.components import components

BITS = 64
SEED = 42
#: Buckets up to this size are compared pair by pair, larger ones by shared centres.
PAIRWISE = 24


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """SimHash of the word shingles of ``text``: ASCII capitals lowered, words
    parted by space or characters 9 to 13, XXH64 per space-joined shingle, a bit
    set where over half the hashes have it. No words: zero."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    stops = list(accumulate(len(w) + 1 for w in words))
    starts = [0, *stops[:-1]]
    digest = xxhash.xxh64_intdigest
    hashes = [digest(joined[a:b - 1], SEED) for a, b in zip(starts, stops[min(shingle, len(words)) - 1:])]
    ones, total = np.zeros(BITS, np.int64), len(hashes)
    for at in range(0, total, 1 << 15):
        part = np.array(hashes[at:at + (1 << 15)], np.uint64)
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(((ones * 2 > total).astype(np.uint64) << np.arange(BITS, dtype=np.uint64)).sum())


def _fingerprints(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            prints = np.array([fingerprint(t, shingle) for t in b.column(1).to_pylist()], np.uint64)
            yield pa.record_batch([b.column(0), pa.array(prints.view(np.int64))], names=["id", "fp"])
    return run


def _keys(distance: int, blocks: int):
    """Arrays of each block choice: fingerprints at most ``distance`` bits apart
    agree on ``blocks - distance`` of the blocks."""
    edges = [round(i * BITS / blocks) for i in range(blocks + 1)]
    masks = []
    for chosen in combinations(range(blocks), blocks - distance):
        m = sum(((1 << edges[i + 1]) - 1) ^ ((1 << edges[i]) - 1) for i in chosen)
        masks.append(m - (1 << 64) if m >> 63 else m)
    return masks


def _links(classes: DataFrame, distance: int, blocks: int, s: Scratch) -> DataFrame:
    """Edges between fingerprints at most ``distance`` bits apart; every such
    pair is linked, if need be through others.

    A bucket of one block choice holds the fingerprints that agree on those
    blocks. Small buckets are joined pair by pair and verified; a large one (an
    unbounded group) is linked through the points near its members instead."""
    masks = _keys(distance, blocks)
    keyed = classes.select("fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in masks]))
                           .alias("k", "key"))
    sizes = keyed.groupBy("k", "key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    met = s.table(keyed.join(sizes, ["k", "key"]), "buckets")
    small = met.filter(F.col("n") <= PAIRWISE)
    a, b = small.alias("a"), small.alias("b")
    near = F.bit_count(F.col("a.fp").bitwiseXOR(F.col("b.fp"))) <= distance
    pairs = (a.join(b, (F.col("a.k") == F.col("b.k")) & (F.col("a.key") == F.col("b.key"))
                    & (F.col("a.fp") < F.col("b.fp")) & near)
             .select(F.col("b.fp").alias("u"), F.col("a.fp").alias("v")))
    large = met.filter(F.col("n") > PAIRWISE).select("fp").distinct()
    return pairs.unionByName(_links_by_centre(large, distance))


def _links_by_centre(large: DataFrame, distance: int) -> DataFrame:
    """Two fingerprints are at most two bits apart exactly if some point is at
    most one bit from both. So each is linked to the smallest fingerprint around
    every point in its reach: 65 rows each, however many share a bucket. One bit
    apart: a point in the reach is the other itself."""
    if distance > 2:
        raise ValueError("large buckets are linked for distances up to 2")
    if distance == 0:
        return large.select(F.col("fp").alias("u"), F.col("fp").alias("v")).limit(0)
    ball = [0] + [1 << i if i < 63 else -(1 << 63) for i in range(BITS)]
    around = large.select("fp", F.explode(F.array(*[F.col("fp").bitwiseXOR(F.lit(m)) for m in ball])).alias("c"))
    low = (large.select(F.col("fp").alias("c"), F.col("fp").alias("v")) if distance == 1
           else around.groupBy("c").agg(F.min("fp").alias("v"), F.count(F.lit(1)).alias("n")).filter("n > 1"))
    return around.join(low, "c").filter("fp <> v").select(F.col("fp").alias("u"), "v")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                    distance: int = 2, blocks: int = 4) -> DataFrame:
    """``(doc_id, fingerprint, component_id)``, one row per row of ``docs``.

    Documents whose fingerprints differ in at most ``distance`` bits are linked;
    ``component_id`` is the smallest id reachable. Equal fingerprints form one
    class, represented by its smallest id, and only classes are compared.

    Null or empty text has the zero fingerprint and is linked like any other;
    rows that repeat an id each get a row; a null id keeps a null id and counts
    as the smallest; an empty table gives no rows; other columns are ignored."""
    spark = docs.sparkSession
    with scratch(spark) as s:
        rows = docs.select(row_id(id_col).alias("id"), F.col(text_col).alias("text"))
        prints = s.table(rows.mapInArrow(_fingerprints(shingle), "id long, fp long"), "prints")
        classes = s.table(prints.groupBy("fp").agg(F.min("id").alias("rep")), "classes")
        roots = s.table(components(_links(classes, distance, blocks, s), s), "roots")
        named = classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
            "fp", "rep", F.coalesce("root", "fp").alias("root"))
        least = named.groupBy("root").agg(F.min("rep").alias("least"))
        named = s.table(named.join(least, "root").select("fp", "least"), "named")
        null = lambda c: F.when(F.col(c) != NULL_ID, F.col(c))
        return (prints.join(named, "fp").select(
            null("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
            null("least").alias("component_id")))

"""Benchmark decontamination by template canonicalisation, built-in functions only.

Numbers, names and units become typed tokens that keep their surface. Windows
of templates (tokens without surfaces) are hashed and joined; the matches of a
benchmark item in a document are then held together by their shift, and an
alignment counts if it covers enough of the item and its slots are consistent:
each surface of the item stands for one surface of the document and the other
way round. So a question asked again with other numbers or names is found.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barflow.llm.common import NULL_ID, Scratch, row_id, scratch

#: Unit words that become a typed token after a number.
UNITS = ("mm cm m km in inch inches ft foot feet yd yard yards mi mile miles mg g kg t oz lb lbs pound pounds "
         "ml cl l litre litres liter liters s sec second seconds min minute minutes h hr hour hours day days week weeks "
         "month months year years cent cents dollar dollars euro euros percent degrees kmh mph").split()
WINDOW, MIN_COVER = 6, 0.4
#: Items a window may stand in and still tell them apart.
SHARED = 5
#: Rows of the filter that keeps texts without an alignment from a shuffle, at most.
SLOTS = 1 << 20
#: A letter of a script without spaces between words is a token.
UNSPACED = r"[\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}&&\p{L}]"
#: Whether a text may have such letters (all lie beyond U+0E00).
BEYOND = r"[\x{0E00}-\x{10FFFF}]"
#: Benchmark windows joined by broadcast at most (32 bytes each); more go by a shuffle.
BROADCAST_WINDOWS = 1_000_000


def tokens(text: Column) -> Column:
    """Lower-case words; ``#surface`` for a number, ``@surface`` for a unit after
    a number, ``~surface`` for capitalised words inside a sentence. A letter of a
    script without spaces is a word. Null: none.

    No pattern repeats a group, and a run of digits is entered at its start only,
    so the time is linear in the text and the stack stays flat."""
    text = F.coalesce(text, F.lit(""))
    t = F.regexp_replace(text, "[#@~]+", " ")
    t = F.when(text.rlike(BEYOND), F.regexp_replace(t, UNSPACED, " $0 ")).otherwise(t)
    name = r"([\p{Ll}\p{N},;:] +)(\p{Lu}[\p{L}]*)(?: +(\p{Lu}[\p{L}]*))?(?: +(\p{Lu}[\p{L}]*))?"
    t = F.regexp_replace(t, name, "$1~$2$3$4")
    t = F.regexp_replace(t, r"(\p{N})[.,](?=\p{N})", "$1_")
    # a number before a unit; then numbers that are left
    t = F.regexp_replace(t, r"(?<![\p{N}_])(\p{N}[\p{N}_]*+) *(" + "|".join(sorted(UNITS, key=lambda u: (-len(u), u))) + r")(?=[^\p{L}]|$)",
                         "$1 @$2")
    t = F.regexp_replace(F.lower(t), r"(\p{N}[\p{N}_]*+)", " #$1 ")
    return F.filter(F.split(t, r"[^\p{L}#@~_\p{N}]+"), lambda w: w != "")


def _windows(rows: DataFrame, keys: list[str], lengths: list[int]) -> DataFrame:
    """``(*keys, n, place, w, dense)``: a hash for every window of ``n`` templates;
    ``n`` is a column or, where there is none, each of ``lengths``. A window of
    which over half are slots (``dense``) would match too much, so its hash takes
    the surfaces in."""
    kind = "CASE WHEN ascii(t) IN (35, 64, 126) THEN cast(ascii(t) AS bigint) ELSE xxhash64(t) END"

    def hashes(size: int) -> str:
        grams, surfaces = (", ".join(f"get({x}, i + {k})" for k in range(size)) for x in ("h", "_tokens"))
        slots = " + ".join(f"cast(get(h, i + {k}) IN (35L, 64L, 126L) AS int)" for k in range(size))
        return (f"WHEN {size} THEN transform(sequence(0, size(h) - {size}), i -> CASE WHEN {slots} > {size // 2} THEN "
                f"struct(xxhash64({surfaces}) AS w, true AS dense) ELSE struct(xxhash64({grams}) AS w, false AS dense) END)")
    if not lengths:
        lengths = [WINDOW]
    rows = rows.select(*keys, "_tokens", F.expr(f"transform(_tokens, t -> {kind})").alias("h"),
                       F.col("n") if "n" in rows.columns else F.explode(F.array(*map(F.lit, lengths))).alias("n"))
    return (rows.select(*keys, "n", F.posexplode(F.expr(f"CASE WHEN size(h) >= n THEN CASE n {' '.join(map(hashes, lengths))} END END"))
                        .alias("place", "x")).select(*keys, "n", "place", "x.w", "x.dense"))


def _own_windows(windows: DataFrame) -> DataFrame:
    """The windows that tell an item from others: those that at most ``SHARED``
    item texts hold, or, where an item has none, its rarest. A beginning that all
    items share thus matches none of them, and no document meets all items."""
    held = windows.groupBy("n", "w").agg(F.countDistinct("item_key").alias("held"))
    rare = windows.join(held, ["n", "w"])
    least = rare.groupBy("item", "item_key").agg(F.greatest(F.min("held"), F.lit(SHARED)).alias("most"))
    return rare.join(least, ["item", "item_key"]).filter("held <= most").drop("held", "most")


def _aligned_slots(found: DataFrame, docs: DataFrame, items: DataFrame) -> DataFrame:
    """Surfaces that the alignments ``(doc, doc_key, item, item_key, shift)`` set against each other."""
    side = found.select("doc", "doc_key", "item", "item_key", "shift", "lo", "hi")
    item = items.select("item", "item_key", F.col("_tokens").alias("item_tokens"))
    both = side.join(item, ["item", "item_key"]).join(docs, ["doc", "doc_key"])
    pairs = F.expr("transform(sequence(lo, hi), i -> struct(get(item_tokens, i) AS a, get(_tokens, i + shift) AS b))")
    return (both.select("doc", "doc_key", "item", "item_key", "shift", F.explode(pairs).alias("x"))
            .select("doc", "doc_key", "item", "item_key", "shift", "x.a", "x.b")
            .filter("ascii(a) IN (35, 64, 126)").distinct())


def text_key(column: str) -> Column:
    """Parts the rows that share an id, or have none, by their texts."""
    return F.xxhash64(F.coalesce(F.col(column), F.lit("")))


def leaking_texts(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  window: int = WINDOW, min_cover: float = MIN_COVER, broadcast_windows: int = BROADCAST_WINDOWS,
                  least_tokens: int = 1) -> DataFrame:
    """``(doc, doc_key, item, b)``: the best alignment of each item in each text,
    known by its row's :func:`row_id` and :func:`text_key`. Items of fewer than
    ``least_tokens`` tokens aren't sought."""
    with scratch(docs.sparkSession) as s:
        # an item's first words are names after some text: the item is also sought as it reads there
        own = benchmark.select(row_id("item_id").alias("item"), "text").distinct()
        inside = tokens(F.concat(F.lit("x "), F.ltrim("text")))
        items = s.table(own.select("item", F.explode(F.array(tokens(F.col("text")), F.slice(inside, 2, F.greatest(F.size(inside) - 1, F.lit(0)))))
                                   .alias("_tokens")).distinct()
                        .withColumn("item_key", F.xxhash64("_tokens")).withColumn("n", F.least(F.size("_tokens"), F.lit(window)))
                        .filter(F.size("_tokens") >= max(1, least_tokens)), "items")
        lengths = sorted(r["n"] for r in items.select("n").distinct().collect())  # at most ``window``
        theirs = s.table(_own_windows(_windows(items, ["item", "item_key"], lengths)).withColumnRenamed("place", "item_place"), "item-windows")
        many = theirs.count()
        wanted = F.broadcast(theirs) if many <= broadcast_windows else theirs
        rows = docs.select(row_id(id_col).alias("doc"), text_key(text_col).alias("doc_key"), tokens(F.col(text_col)).alias("_tokens"))
        hits = s.table(_windows(rows, ["doc", "doc_key"], lengths).drop("dense").join(wanted, ["n", "w"])
                       .select("doc", "doc_key", "item", "item_key", "n", "place", "item_place", "dense"), "hits")
        plain = F.when(~F.col("dense"), F.col("item_place"))
        sizes = theirs.groupBy("item", "item_key").agg(F.countDistinct("item_place").alias("of"), F.countDistinct(plain).alias("of_plain"))
        found = (hits.withColumn("shift", F.col("place") - F.col("item_place")).groupBy("doc", "doc_key", "item", "item_key", "shift")
                 .agg(F.countDistinct("item_place").alias("n_windows"), F.countDistinct(plain).alias("n_plain"),
                      F.min("item_place").alias("lo"), (F.max(F.col("item_place") + F.col("n")) - 1).alias("hi"))
                 .join(sizes, ["item", "item_key"]).withColumn("cover", F.greatest(F.col("n_windows") / F.col("of"), F.try_divide("n_plain", "of_plain")))
                 .filter(F.col("cover") >= min_cover))
        found = s.table(found, "alignments")
        # few texts are aligned: the others are kept from the shuffle by a filter of at most SLOTS rows
        slot = F.pmod(F.xxhash64("doc", "doc_key"), F.lit(SLOTS))
        texts = (docs.select(row_id(id_col).alias("doc"), text_key(text_col).alias("doc_key"), F.col(text_col).alias("_text"))
                 .withColumn("_slot", slot).join(F.broadcast(found.select(slot.alias("_slot")).distinct()), "_slot", "left_semi").drop("_slot")
                 .join(found.select("doc", "doc_key").distinct(), ["doc", "doc_key"], "left_semi").distinct()
                 .select("doc", "doc_key", tokens(F.col("_text")).alias("_tokens")))
        slots = s.table(_aligned_slots(found, texts, items), "slots")
        key = ["doc", "doc_key", "item", "item_key", "shift"]
        clash = (slots.groupBy(*key, "a").agg(F.countDistinct("b").alias("n")).filter("n > 1").select(*key)
                 .unionByName(slots.groupBy(*key, "b").agg(F.countDistinct("a").alias("n")).filter("n > 1").select(*key)).distinct())
        changed = slots.filter("a <> b").select(*key, F.lit(True).alias("changed")).distinct()
        good = found.join(clash, key, "left_anti").join(changed, key, "left")
        return good.groupBy("doc", "doc_key", "item").agg(
            F.max(F.struct("cover", "n_windows", F.col("changed").isNull().alias("same_slots"))).alias("b"))


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          window: int = WINDOW, min_cover: float = MIN_COVER, broadcast_windows: int = BROADCAST_WINDOWS) -> DataFrame:
    """``(doc_id, item_id, n_windows, cover, same_slots)``: the benchmark items
    found in each document, one row per pair.

    ``cover`` is the largest share of the item's template windows that one
    alignment matches, of all or of those that aren't mostly slots (mostly slots
    match by their surfaces only), ``n_windows`` the number of all it matches;
    ``same_slots`` tells whether that alignment has the item's own numbers, names
    and units.

    Null or empty texts and items match nothing; items shorter than a window
    are one window of their length, sought in every document; repeated rows
    count once; texts that share an id, or have none, are aligned each by itself,
    and the id has the best of them; empty tables give no rows. ``benchmark``
    windows are sent to every task only up to ``broadcast_windows`` of them;
    above, the join shuffles."""
    best = leaking_texts(docs, benchmark, id_col, text_col, window, min_cover, broadcast_windows).groupBy("doc", "item").agg(
        F.max("b").alias("b"))
    return best.select(F.when(F.col("doc") != NULL_ID, F.col("doc")).alias(id_col),
                       F.when(F.col("item") != NULL_ID, F.col("item")).alias("item_id"),
                       F.col("b.n_windows").alias("n_windows"), F.col("b.cover").alias("cover"),
                       F.col("b.same_slots").alias("same_slots"))

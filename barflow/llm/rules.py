"""Quality rules: text statistics and a learned decision list over them.

The list is learned by sequential covering: each rule is grown on two thirds of
the labelled rows by adding the threshold condition with the best information
gain, pruned on the other third, and what it covers is set aside. Counting is
done by Spark; the driver sees only counts per feature and bin. The result is
an ordered conditional expression, evaluated with built-in functions only.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barflow.llm.common import Scratch, row_id, scratch

GAP = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"
MIN_WORDS, REPEAT_PERCENT = 50, 50
#: Labelled rows the list is learned from, at most (the smallest by a hash of the id).
SAMPLE_ROWS = 20_000
FEATURES = {
    "words": "cast(n_words as double)",
    "word_length": "word_chars / n_words",
    "symbols_per_word": "n_symbols / n_words",
    "repeat_lines_per_word": "n_dup_lines / n_words",
    "repeat_words_per_word": "n_repeat_words / n_words",
}
QUANTILES, MAX_RULES, MAX_CONDITIONS, MIN_PRECISION = 24, 8, 4, 0.8


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """Per row: the id, the ``carry`` columns, ``n_words``, ``word_chars``,
    ``n_symbols``, ``n_dup_lines`` and ``n_repeat_words``. Null text: all zero."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    keep = [F.col(c).alias(f"_carry_{i}") for i, c in enumerate((id_col, *carry))]
    # array columns are computed once, in their own projection, and read by position
    d = docs.select(*keep, text.alias("_t"))
    d = d.withColumn("_w", F.filter(F.split("_t", GAP), lambda w: w != ""))
    d = d.withColumn("_n", F.size("_w"))
    d = d.withColumn("_l", F.filter(F.split("_t", "\n"), lambda x: F.regexp_replace(x, GAP, "") != ""))
    d = d.withColumn("_h", F.expr("CASE WHEN _n < 3 THEN array() ELSE transform(sequence(0, _n - 3), "
                                  "i -> xxhash64(_w[i], _w[i + 1], _w[i + 2])) END"))
    d = d.select(*[f"_carry_{i}" for i in range(len(keep))], "_n", "_h",
                 F.length(F.array_join("_w", "")).cast("long").alias("word_chars"),
                 (F.length("_t") - F.length(F.regexp_replace("_t", SYMBOLS, ""))).cast("long").alias("n_symbols"),
                 (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"))
    # windows found again: sort (window, place), keep those with an equal neighbour, and measure what their places cover
    d = d.withColumn("_s", F.expr("CASE WHEN size(array_distinct(_h)) < size(_h) "
                                  "THEN array_sort(transform(_h, (h, i) -> struct(h, i))) END"))
    d = d.withColumn("_p", F.expr("array_sort(transform(filter(_s, (x, j) -> x.h = get(_s, j - 1).h "
                                  "OR x.h = get(_s, j + 1).h), x -> x.i))"))
    covered = F.expr("coalesce(aggregate(transform(_p, (p, j) -> least(3, coalesce(get(_p, j + 1) - p, 3))), 0L, "
                     "(a, x) -> a + x), 0L)")
    return d.select(*[F.col(f"_carry_{i}").alias(c) for i, c in enumerate((id_col, *carry))],
                    F.col("_n").cast("long").alias("n_words"), "word_chars", "n_symbols", "n_dup_lines",
                    covered.alias("n_repeat_words"))


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    cut: float

    def __str__(self) -> str:
        return f"({FEATURES[self.feature]}) {'>' if self.above else '<='} {self.cut!r}D"


@dataclass(frozen=True)
class Rule:
    """A conjunction; rows that meet it are rejected."""
    conditions: tuple[Condition, ...]

    def __str__(self) -> str:
        return " AND ".join(map(str, self.conditions))


def rejected(rules: list[Rule]) -> Column:
    """The decision list as one conditional expression: the number of the first
    rule that a row meets, or null."""
    if not rules:
        return F.lit(None).cast("int")
    return F.expr("CASE " + " ".join(f"WHEN {r} THEN {i}" for i, r in enumerate(rules, 1)) + " END")


def _cuts(rows: DataFrame) -> dict[str, list[float]]:
    """Candidate thresholds: midpoints between neighbouring quantiles of either class."""
    shares = [i / QUANTILES for i in range(QUANTILES + 1)]
    found = rows.groupBy("bad").agg(*[F.percentile(F.expr(e), shares).alias(f) for f, e in FEATURES.items()]).collect()
    out = {}
    for f in FEATURES:
        values = sorted({v for r in found for v in (r[f] or ())})
        out[f] = [(a + b) / 2 for a, b in zip(values, values[1:])]
    return out


def _counts(rows: DataFrame, cuts: dict[str, list[float]]) -> dict[Condition, tuple[int, int]]:
    """(bad, good) rows that meet each candidate condition, from one grouped pass."""
    bins = [F.struct(F.lit(f).alias("f"), F.expr(f"size(filter(array({', '.join(f'{x!r}D' for x in c)}), t -> t < {e}))").alias("b"))
            for f, e in FEATURES.items() if (c := cuts[f])]
    if not bins:
        return {}
    got = (rows.select("bad", F.explode(F.array(*bins)).alias("x")).groupBy("x.f", "x.b")
           .agg(F.sum("bad").alias("bad"), F.sum(1 - F.col("bad")).alias("good")).collect())
    out = {}
    for f, c in cuts.items():
        mine = {r["b"]: (r["bad"], r["good"]) for r in got if r["f"] == f}
        total = [sum(v[k] for v in mine.values()) for k in (0, 1)]
        below = [0, 0]
        for i, cut in enumerate(c):  # bin i: above i cuts
            below = [below[k] + mine.get(i, (0, 0))[k] for k in (0, 1)]
            out[Condition(f, False, cut)] = tuple(below)
            out[Condition(f, True, cut)] = (total[0] - below[0], total[1] - below[1])
    return out


def _gain(p0: int, n0: int, p: int, n: int) -> float:
    return p * (log2(p / (p + n)) - log2(p0 / (p0 + n0))) if p else 0.0


def learn(labelled: DataFrame, s: Scratch) -> list[Rule]:
    """The decision list from ``labelled``: statistics and ``bad`` (1 or 0).
    At most :data:`SAMPLE_ROWS` rows are used, the first by a hash of the id.
    Ties go to the first feature and the lower cut, so the list is a function
    of the rows. No rows, or one class: no rules."""
    sample = labelled.orderBy(F.xxhash64("doc_id"), "doc_id", *sorted(set(labelled.columns) - {"doc_id"})).limit(SAMPLE_ROWS)
    sample = s.table(sample.withColumn("grow", F.pmod(F.xxhash64(F.lit("grow"), "doc_id"), F.lit(3)) > 0), "labelled")
    grow, prune, rules = sample.filter("grow"), sample.filter("NOT grow"), []
    cuts = _cuts(sample)

    def covered(rows: DataFrame, conditions) -> DataFrame:
        return rows.filter(str(Rule(tuple(conditions)))) if conditions else rows

    def size(rows: DataFrame) -> tuple[int, int]:
        r = rows.agg(F.coalesce(F.sum("bad"), F.lit(0)), F.coalesce(F.sum(1 - F.col("bad")), F.lit(0))).first()
        return int(r[0]), int(r[1])

    while len(rules) < MAX_RULES:
        conditions: list[Condition] = []
        p, n = size(grow)
        if p < 2:
            break
        while n and len(conditions) < MAX_CONDITIONS:
            counts = _counts(covered(grow, conditions), cuts)
            best = max(counts, key=lambda c: _gain(p, n, *counts[c]), default=None)
            if best is None or _gain(p, n, *counts[best]) <= 1e-9:
                break
            conditions.append(best)
            p, n = counts[best]
        if not conditions:
            break
        # prune: the shortest beginning of the conjunction that does best on rows it wasn't grown on
        worth = []
        for k in range(1, len(conditions) + 1):
            a, b = size(covered(prune, conditions[:k]))
            worth.append(((a - b) / (a + b) if a + b else -1.0, -k, a, b))
        value, k, a, b = max(worth)
        rule = Rule(tuple(conditions[:-k]))
        if a + b == 0 or a / (a + b) < MIN_PRECISION:
            break
        rules.append(rule)
        grow, prune = (x.filter(f"NOT coalesce({rule}, false)") for x in (grow, prune))
    return rules


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          carry: tuple[str, ...] = ()) -> DataFrame:
    """Statistics of every row with ``base_failed``, ``rule`` (number of the
    decision list's rule that rejects it, or null) and ``kept``.

    ``labels`` has ``doc_id`` and ``quality`` (0: bad); rows that fail the base
    rule are left out of learning, since the list never decides them. Null text
    has no words and fails the base rule; a null id stays null; repeated rows
    each get a row; null labels are ignored and an id with several labels takes
    the lowest; without usable labels only the base rule decides."""
    with scratch(docs.sparkSession) as s:
        stats = s.table(statistics(docs, id_col, text_col, carry), "statistics")
        named = labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
            F.min("quality").alias("quality"))
        known = (stats.select(row_id(id_col).alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
                 .filter(~base_failed()).join(named, "doc_id")
                 .withColumn("bad", F.when(F.col("quality") == 0, 1).otherwise(0)).drop("quality"))
        rules = learn(known, s)
    out = stats.withColumn("base_failed", base_failed())
    out = out.withColumn("rule", F.when(~F.col("base_failed"), rejected(rules)))
    return out.withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull())

"""Spelling variants: words one edit apart, found level by level in a trie.

The trie is an edge table ``(depth, parent, ch, child)``. A frontier row
``(word, position, node, edits)`` says that the first ``position`` characters of
a word lead to ``node`` with that many edits. Words that begin alike share
their rows: ``word`` is the trie node of their common beginning, so there are
as many rows as near pairs of beginnings, not as words times branches. Rows
without an edit are the trie's own nodes (``word = node``). One edit makes a row
of two siblings (a replaced character) or of a node and its child (an inserted
one); from there both sides follow equal characters, a join with the edge table
on either side for each level. A row with two whole words at its ends is a pair
of neighbours.

Every pair is met once: siblings in one order, and a character inserted into a
run of itself stands at the run's end.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barflow.llm.common import Scratch, scratch

#: Words counted by a worker before it hands them on; code points of text scanned at once.
HELD, PART = 400_000, 1 << 20
#: Longer words are compared by what is left of them without one character, so
#: that the number of levels (jobs) is bounded.
LEVELS = 40
LETTERS = "A-Za-zÀ-ÿ"
_LETTER = re.compile(f"[{LETTERS}]")
_BLANK = re.compile(f"[^{LETTERS}]")


def _parts(text: str) -> Iterator[str]:
    """``text`` in parts that end outside runs, ASCII capitals lowered."""
    at = 0
    while at < len(text):
        gap = _BLANK.search(text, at + PART)
        stop = gap.start() if gap else len(text)
        yield text[at:stop].encode("utf-8", "replace").lower().decode("utf-8")
        at = stop


def _runs(least: int, typo: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = re.compile(f"[{LETTERS}]{{{least},}}")
        total: Counter[str] = Counter()

        def flush() -> pa.RecordBatch:
            out = pa.record_batch([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())],
                                  names=["word", "n"])
            total.clear()
            return out
        for b in batches:
            for key, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                seed = zlib.crc32(f"{'' if key is None else key}:".encode())
                for part in _parts(text or ""):
                    for w, n in Counter(found.findall(part)).items():
                        h = zlib.crc32(w.encode(), seed)
                        if h % typo == 0:
                            at = h % len(w)
                            w = w[:at] + w[at + 1:]
                            if len(w) < least:
                                continue
                        total[w] += n
                if len(total) > HELD:
                    yield flush()
        yield flush()
    return run


def count_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 7, occurrences: int = 2,
                typo: int = 31) -> DataFrame:
    """``(word, n)``: maximal runs of Latin letters, ASCII capitals lowered, of
    which one in ``typo`` loses a character picked by its checksum."""
    rows = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"))
    return (rows.mapInArrow(_runs(least, typo), "word string, n long")
            .groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= occurrences))


def trie_edges(words: DataFrame) -> DataFrame:
    """``(depth, parent, ch, child, word, n)`` of the words' trie: a row per
    distinct beginning, named by its hash; ``word`` where the word ends there."""
    steps = words.select("word", "n", F.explode(F.sequence(F.lit(1), F.length("word"))).alias("depth"))
    ends = F.col("depth") == F.length("word")
    head = lambda n: F.xxhash64(F.substring("word", F.lit(1), n))
    return (steps.select("depth", head(F.col("depth") - 1).alias("parent"),
                         F.substring("word", F.col("depth"), F.lit(1)).alias("ch"), head(F.col("depth")).alias("child"),
                         F.when(ends, F.struct("word", "n")).alias("end"))
            .groupBy("depth", "parent", "ch", "child").agg(F.max("end").alias("end"))
            .select("depth", "parent", "ch", "child", F.col("end.word").alias("word"), F.col("end.n").alias("n")))


#: A frontier row; ``barred`` is the character that may not follow (a run's end),
#: ``left`` and ``right`` are the words that end here, if both do.
FRONTIER = ["position", "word", "node", "edits", "barred", "left", "left_n", "right", "right_n"]


def _state(position: Column, word: str, node: str, barred: Column, a: str, b: str) -> list[Column]:
    both = F.col(f"{a}.word").isNotNull() & F.col(f"{b}.word").isNotNull()
    end = lambda c, name: F.when(both, F.col(c)).alias(name)
    return [position.cast("int").alias("position"), F.col(word).alias("word"), F.col(node).alias("node"),
            F.lit(1).alias("edits"), barred.alias("barred"), end(f"{a}.word", "left"), end(f"{a}.n", "left_n"),
            end(f"{b}.word", "right"), end(f"{b}.n", "right_n")]


def first_edits(edges: DataFrame) -> DataFrame:
    """Frontier rows that take their one edit here: siblings (at most one per
    two letters of the alphabet) and nodes with their children."""
    a, b = edges.alias("a"), edges.alias("b")
    none = F.lit(None).cast("string")
    replaced = a.join(b, (F.col("a.parent") == F.col("b.parent")) & (F.col("a.ch") < F.col("b.ch")))
    inserted = a.join(b, F.col("a.child") == F.col("b.parent"))
    root = edges.filter("depth = 1").select(F.lit(0).alias("position"), F.col("parent").alias("word"), F.col("child").alias("node"),
                                            F.lit(1).alias("edits"), F.col("ch").alias("barred"), none.alias("left"),
                                            F.lit(None).cast("long").alias("left_n"), none.alias("right"),
                                            F.lit(None).cast("long").alias("right_n"))
    return (replaced.select(_state(F.col("a.depth"), "a.child", "b.child", none, "a", "b"))
            .unionByName(inserted.select(_state(F.col("a.depth"), "a.child", "b.child", F.col("b.ch"), "a", "b")))
            .unionByName(root))


def advance(frontier: DataFrame, edges: DataFrame, below: DataFrame) -> DataFrame:
    """The frontier one level on: the word's next character leads from its
    place (``edges``) and, equal, from the node (``below``: this level's edges
    for replacements, the next one's for insertions)."""
    s, a, b = frontier.alias("s"), edges.alias("a"), below.alias("b")
    return (s.join(a, F.col("s.word") == F.col("a.parent"))
            .filter(F.col("s.barred").isNull() | (F.col("s.barred") != F.col("a.ch")))
            .join(b, (F.col("s.node") == F.col("b.parent")) & (F.col("a.ch") == F.col("b.ch")))
            .select(_state(F.col("a.depth"), "a.child", "b.child", F.lit(None).cast("string"), "a", "b")))


def _trie_pairs(words: DataFrame, s: Scratch) -> DataFrame:
    """``(left, left_n, right, right_n)``, every pair of words one edit apart once."""
    edges = s.table(trie_edges(words).hint("rebalance", "depth"), "edges", by="depth")
    fresh = s.table(first_edits(edges).hint("rebalance", "position"), "edits", by="position")
    deepest = edges.agg(F.max("depth")).first()[0] or 0
    frontier = None
    for depth in range(1, deepest + 1):
        start = fresh.filter(F.col("position") == depth - 1).select(FRONTIER)
        start = start if frontier is None else start.unionByName(frontier.select(FRONTIER))
        at = edges.filter(F.col("depth") == depth)
        frontier = s.table(advance(start, at, edges.filter(F.col("depth").isin(depth, depth + 1))), "frontier")
    ends = ["left", "left_n", "right", "right_n"]
    pairs = fresh.filter("left is not null").select(ends)
    return pairs if frontier is None else pairs.unionByName(s.tables(frontier, "frontier").filter("left is not null").select(ends))


def _around(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What stands around each character of a word and around each gap between
    two: words that differ by a replaced character share the first at one
    place, an inserted character shares its surroundings with the gap."""
    from barflow.llm.rolling import mix, prefix, spans
    for b in batches:
        for name, word in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            codes = np.frombuffer(word.encode("utf-32-le"), "<u4").astype(np.uint64)
            sums, n = prefix(mix(codes + np.uint64(1)) | np.uint64(1)), len(codes)
            for gap in (0, 1):
                for at in range(0, n + gap, PART):
                    place = np.arange(at, min(at + PART, n + gap))
                    zero, end = np.zeros_like(place), np.full_like(place, n)
                    key = mix(spans(sums, zero, place) + mix(spans(sums, place + 1 - gap, end) + place.astype(np.uint64)))
                    yield pa.record_batch([pa.array(np.full(len(place), name, np.int64)), pa.array(key.view(np.int64)),
                                           pa.array(np.full(len(place), bool(gap)))], names=["name", "key", "gap"])


def _long_pairs(words: DataFrame, levels: int, s: Scratch) -> DataFrame:
    """The pairs in which a word has more than ``levels`` characters, in time
    linear in the words' lengths."""
    named = s.table(words.filter(F.length("word") >= levels).select(F.xxhash64("word").alias("name"), "word", "n"), "long")
    keys = s.table(named.select("name", "word").mapInArrow(_around, "name long, key long, gap boolean"), "around")
    a, b = keys.filter("not gap").alias("a"), keys.alias("b")
    pairs = (a.join(b, (F.col("a.key") == F.col("b.key")) & (F.col("a.name") != F.col("b.name"))
                    & (F.col("b.gap") | (F.col("a.name") < F.col("b.name"))))
             .select(F.col("a.name").alias("l"), F.col("b.name").alias("r")).distinct())
    left = named.select(F.col("name").alias("l"), F.col("word").alias("left"), F.col("n").alias("left_n"))
    right = named.select(F.col("name").alias("r"), F.col("word").alias("right"), F.col("n").alias("right_n"))
    return (pairs.join(left, "l").join(right, "r").filter(F.greatest(F.length("left"), F.length("right")) > levels)
            .select("left", "left_n", "right", "right_n"))


def near_words(words: DataFrame, s: Scratch, levels: int = LEVELS) -> DataFrame:
    """``(left, left_n, right, right_n)``: each pair of ``words(word, n)`` that
    differ by one inserted, deleted or replaced code point, once."""
    pairs = _trie_pairs(words.filter((F.length("word") <= levels)), s)
    if not words.filter(F.length("word") > levels).isEmpty():
        pairs = pairs.unionByName(_long_pairs(words, levels, s))
    return pairs.filter(F.levenshtein("left", "right", 1) == 1)  # beginnings are named by hashes


def _roots(forms: DataFrame, hops: int, s: Scratch) -> DataFrame:
    """``(word, root)`` of ``forms(word, form)`` by pointer doubling; no chain
    has more than ``hops`` steps."""
    to = s.table(forms.select("word", F.col("form").alias("root")), "roots")
    reach = 1
    while reach < hops:
        onward = to.select(F.col("word").alias("root"), F.col("root").alias("next"))
        to = s.table(to.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root")), "roots")
        reach *= 2
    return to


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 7, occurrences: int = 2,
             typo: int = 31, ratio: int = 10, levels: int = LEVELS) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)``, one row per distinct word of at
    least ``least`` code points and ``occurrences`` occurrences.

    ``form`` is the near word with the largest count (of equal counts the first
    in code-point order) if that is at least ``ratio`` times the word's own;
    ``root`` is where the forms lead. Every near pair counts. A null text has no
    words; a null id stands as an empty string in the checksum; rows that
    repeat an id count each; an empty table gives no rows; other columns are
    ignored. Of the words only counts reach the driver."""
    if ratio < 2:
        raise ValueError("forms must grow by a ratio of 2 or more")
    with scratch(docs.sparkSession) as s:
        words = s.table(count_words(docs, id_col, text_col, least, occurrences, typo), "words")
        pairs = near_words(words, s, levels)
        both = pairs.select(F.col("left").alias("word"), F.col("left_n").alias("n"), F.struct(
            (-F.col("right_n")).alias("less"), F.col("right").alias("near")).alias("near")).unionByName(
            pairs.select(F.col("right").alias("word"), F.col("right_n").alias("n"), F.struct(
                (-F.col("left_n")).alias("less"), F.col("left").alias("near")).alias("near")))
        best = both.groupBy("word", "n").agg(F.count(F.lit(1)).alias("n_near"), F.min("near").alias("best"))
        is_form = -F.col("best.less") >= ratio * F.col("n")
        near = s.table(best.select("word", "n_near", F.when(is_form, F.col("best.near")).alias("form"),
                                   F.when(is_form, -F.col("best.less")).alias("form_n")), "near")
        most, hops = words.agg(F.max("n")).first()[0] or 0, 1
        while most >= ratio:  # each step of a chain multiplies the count by the ratio at least
            most, hops = most // ratio, hops + 1
        roots = _roots(near.filter("form is not null"), hops, s)
        return (words.join(near, "word", "left").join(roots, "word", "left")
                .select("word", "form", F.coalesce("root", "word").alias("root"), "n",
                        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n"))

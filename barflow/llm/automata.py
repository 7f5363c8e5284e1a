"""Removal of repeated passages with automata of recurring phrases.

Spark finds the phrases that recur: every window of words samples one phrase,
and phrases seen twice anywhere are confirmed. The documents are then streamed
through Aho-Corasick automata, one per shard of documents, compiled from the
confirmed phrases that the shard's documents sampled; they locate every
occurrence. Windows around occurrences are compared across the corpus by the
fingerprints of their halves, and all but the earliest are removed.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barflow.llm.common import bit_test, keep_bits, scratch
from barflow.llm.places import MOST, SPANS, by_row, covered, first_in_text, joined, keyed, longs, place, ranges, texts
from barflow.llm.rolling import pairs_at, runs, word_bounds, word_codes

WINDOW, PHRASE = 20, 8
FILTER_BITS = 27
#: Text of one shard, and phrases of one automaton (about 60 nodes each).
SHARD_BYTES, SHARD_PHRASES = 1 << 20, 8_192
Batches = Iterator[pa.RecordBatch]


def _words(data: bytes):
    text = np.frombuffer(data, np.uint8)
    start, stop = word_bounds(text)
    return text, start, stop


def _sampled(window: int, phrase: int):
    def run(batches: Batches) -> Batches:
        for b in batches:
            grams = []
            for _, _, data in texts(b):
                grams.append(runs(word_codes(*_words(data)), window, phrase).gram)
            yield pa.record_batch([longs(grams)], names=["g"])
    return run


def _sampled_places(window: int, phrase: int, bits):
    def run(batches: Batches) -> Batches:
        for b in batches:
            cols: list[list] = [[], [], [], []]
            for key, part, data in texts(b):
                r = runs(word_codes(*_words(data)), window, phrase)
                keep = bit_test(bits.value, FILTER_BITS, r.gram)
                if keep.any():
                    at = place(r.anchor[keep], 1)
                    for col, x in zip(cols, (r.gram[keep], np.full(len(at), key, np.int64), np.full(len(at), part, np.int64), at)):
                        col.append(x)
            if cols[0]:
                yield pa.record_batch([longs(c) for c in cols], names=["g", "id", "key", "at"])
    return run


class _Text:
    """A text as its words parted by single blanks, one character a byte."""

    def __init__(self, key: int, part: int, data: bytes, places: pa.Scalar, phrase: int):
        text, start, stop = _words(data)
        words = data.split()
        self.key, self.part, self.size = key, part, len(words)
        self.codes = word_codes(text, start, stop)
        self.line = " " + b" ".join(words).decode("latin-1") + " "
        self.starts = np.concatenate([[1], 1 + np.cumsum(stop - start + 1)])
        at = ranges(np.asarray(places.values))[:, 0]
        self.phrases = {self.line[self.starts[a] - 1:self.starts[a + phrase]] for a in at.tolist()}

    def occurrences(self, automaton) -> list[int]:
        """Starts of the phrases' occurrences, as character offsets of the blank before."""
        return [end - n for end, n in automaton.iter(self.line)]


def _located(window: int, phrase: int):
    """Stream the documents, shard by shard, and emit a row per window that
    holds an occurrence: the first of its kind in its text, with its rank pair,
    or a place of windows that the text itself holds before (no ranks)."""
    def shards(b: pa.RecordBatch):
        shard, size = [], 0
        for (key, part, data), places in zip(texts(b), b.column(3)):
            shard.append(_Text(key, part, data, places, phrase))
            size += len(data)
            if size >= SHARD_BYTES:
                yield shard
                shard, size = [], 0
        if shard:
            yield shard

    def run(batches: Batches) -> Batches:
        for b in batches:
            for shard in shards(b):
                todo = sorted(set().union(*(t.phrases for t in shard)))
                found: list[list[int]] = [[] for _ in shard]
                for at in range(0, len(todo), SHARD_PHRASES):
                    automaton = ahocorasick.Automaton()
                    for p in todo[at:at + SHARD_PHRASES]:
                        automaton.add_word(p, len(p) - 1)
                    automaton.make_automaton()
                    for t, f in zip(shard, found):
                        f.extend(t.occurrences(automaton))
                cols: list[list] = [[], [], [], [], []]
                for t, f in zip(shard, found):
                    first = np.searchsorted(t.starts, np.array(sorted(f), np.int64) + 1)
                    edge = np.zeros(t.size + 2, np.int64)  # windows that hold a phrase at a: a - (window - phrase) to a
                    np.add.at(edge, np.maximum(first - (window - phrase), 0), 1)
                    np.add.at(edge, first + 1, -1)
                    at = np.flatnonzero(np.cumsum(edge)[:max(0, t.size - window + 1)])
                    left, right = pairs_at(t.codes, window, at)
                    new = first_in_text(left, right)
                    again = joined(at[~new])
                    cols[0] += [left[new].view(np.int64), np.zeros(len(again), np.int64)]
                    # 96 bits tell windows apart; fewer would not, more cost disk
                    cols[1] += [right[new].astype(np.uint32).view(np.int32), np.zeros(len(again), np.int32)]
                    cols[2] += [place(at[new], 1), again]
                    for col, x in ((cols[3], t.key), (cols[4], t.part)):
                        col.append(np.full(int(new.sum()) + len(again), x, np.int64))
                yield pa.record_batch([longs(cols[0]), pa.array(np.concatenate(cols[1])), *map(longs, cols[2:])],
                                      names=["r1", "r2", "at", "id", "key"])
    return run


def _cut(window: int):
    def run(batches: Batches) -> Batches:
        for b in batches:
            n_words, n_removed, cuts, kept = [], [], [], []
            for (_, _, data), places in zip(texts(b), b.column(3)):
                words = data.split()
                found = covered(places, window)
                edges = [0, *[x for c in found for x in (c["start"], c["stop"])], len(words)]
                n_words.append(len(words))
                n_removed.append(sum(c["stop"] - c["start"] for c in found))
                cuts.append(found)
                kept.append(b" ".join([w for i, j in zip(edges[::2], edges[1::2]) for w in words[i:j]]))
            yield pa.record_batch([*[b.column(i) for i in range(4, b.num_columns)], pa.array(n_words, pa.int64()),
                                   pa.array(n_removed, pa.int64()), pa.array(cuts, SPANS),
                                   pa.array(kept, pa.binary()).cast(pa.string())],
                                  names=[*b.schema.names[4:], "n_words", "n_removed", "spans", "kept"])
    return run


def remove_passages(docs: DataFrame, window: int = WINDOW, phrase: int = PHRASE, id_col: str = "doc_id",
                    text_col: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """Cut from every text each word covered by a window of ``window`` words
    whose sequence also starts earlier: in a text of a smaller id or earlier in
    the same text. Windows are judged on the input and never cross texts.

    Returns the id, the ``carry`` columns, ``n_words``, ``n_removed``, ``spans``
    (maximal removed runs, word offsets) and ``kept`` (kept words joined by one
    space). One row per row of ``docs``.

    Null text has no words. A null id counts as the smallest. Rows that share an
    id aren't earlier than one another, and equal ones get the same result. An
    empty table gives no rows; other columns are ignored."""
    spark = docs.sparkSession
    if not 2 <= phrase <= window <= MOST:
        raise ValueError(f"2 <= phrase <= window <= {MOST} is asked for")
    with scratch(spark) as s:
        whole = keyed(docs, id_col, text_col, (id_col, *carry))
        rows = whole.select("id", "key", "text")
        seen = rows.mapInArrow(_sampled(window, phrase), "g long")
        phrases = s.table(seen.groupBy("g").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("g"), "phrases")
        bits = spark.sparkContext.broadcast(keep_bits(phrases, "g", FILTER_BITS))
        sampled = rows.mapInArrow(_sampled_places(window, phrase, bits), "g long, id long, key long, at long")
        wanted = s.table(by_row(sampled.join(phrases, "g").select("id", "key", "at")), "sampled")
        located = s.table(rows.join(wanted, ["id", "key"]).select("id", "key", "text", "places")
                          .mapInArrow(_located(window, phrase), "r1 long, r2 int, at long, id long, key long"), "located")
        s.drop(phrases, wanted)
        ranked = located.filter("r1 <> 0 OR r2 <> 0")
        low = s.table(ranked.groupBy("r1", "r2").agg(F.min("id").alias("least"), F.max("id").alias("most"))
                      .filter("most > least").select("r1", "r2", "least"), "low")
        marks = (ranked.join(low, ["r1", "r2"]).filter("id > least").select("id", "key", "at")
                 .unionByName(located.filter("r1 = 0 AND r2 = 0").select("id", "key", "at")))
        places = s.table(by_row(marks), "places")
        s.drop(located, low)
        joined_ = whole.join(places, ["id", "key"], "left")
        fields = [f"_carry_{i} {docs.schema[c].dataType.simpleString()}" for i, c in enumerate((id_col, *carry))]
        out = joined_.select("id", "key", "text", "places", *[f"_carry_{i}" for i in range(len(carry) + 1)]).mapInArrow(
            _cut(window), ", ".join([*fields, "n_words long, n_removed long, spans array<struct<start:long,stop:long>>, kept string"]))
        return out.withColumnsRenamed({f"_carry_{i}": c for i, c in enumerate((id_col, *carry))})

import hashlib
import random

import pytest

from barflow.llm import automata, queries, rolling, simhash, suffix
from brute import groups, passages
from brute import simhash as brute_simhash
from brute import suffix as brute_suffix

DOCS = "doc_id long, text string, lang string"


def made(seed=3):
    r = random.Random(seed)
    words = ["".join(r.choice("abcdeé") for _ in range(r.randint(1, 6))) for _ in range(60)]
    line = lambda n: " ".join(r.choice(words) for _ in range(n))
    passages = [line(40) for _ in range(4)]
    docs = []
    for i in range(60):
        t = line(r.randint(0, 80))
        if r.random() < .5:
            t += "\n" + r.choice(passages)[r.randint(0, 20):] + "\n" + line(r.randint(0, 30))
        if r.random() < .2 and docs:
            t = r.choice(docs)[1]
        docs.append((i, t))
    docs += [(60, None), (61, ""), (62, "a" * 500), (63, "ab" * 300), (64, docs[5][1]), (65, "ab " * 400),
             (66, " \t\n"), (67, "A b \x0b c"), (68, "x y " * 60 + passages[0])]
    return docs


def test_simhash_against_brute(spark):
    docs = made()
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in
           simhash.near_duplicates(spark.createDataFrame([(*d, "x") for d in docs], DOCS)).collect()}
    prints = [brute_simhash(t) for _, t in docs]
    want = groups([d for d, _ in docs], prints)
    assert got == {d: (f"{p:016x}", g) for (d, _), p, g in zip(docs, prints, want)}


@pytest.mark.parametrize("distance", [1, 2])
def test_large_buckets_link_the_same(spark, monkeypatch, distance):
    r = random.Random(1)
    base = [r.getrandbits(64) for _ in range(6)]
    prints = sorted({b ^ sum(1 << r.randrange(64) for _ in range(r.randint(0, 3))) & (2**64 - 1) for b in base * 12})
    rows = [(p - (1 << 64) if p >> 63 else p, i) for i, p in enumerate(prints)]
    classes = spark.createDataFrame(rows, "fp long, rep long")
    from barflow.llm.common import scratch
    from barflow.llm.components import components
    want = groups(list(range(len(prints))), prints, distance)
    for most in (0, 3, 1000):
        monkeypatch.setattr(simhash, "PAIRWISE", most)
        with scratch(spark) as s:
            roots = {x.node: x.root for x in components(simhash._links(classes, distance, 4, s), s).collect()}
        parts, mine = {}, {}
        for (fp, i) in rows:
            parts.setdefault(roots.get(fp, fp), []).append(i)
            mine.setdefault(want[i], []).append(i)
        assert sorted(parts.values()) == sorted(mine.values())


def digests(df):
    return {r.doc_id: (r.n_bytes, r.n_removed, len(r.spans), hashlib.sha256(r.kept).hexdigest()) for r in df.collect()}


@pytest.mark.parametrize("block", [1 << 17, 64])
def test_suffix_against_brute(spark, monkeypatch, block):
    monkeypatch.setattr(rolling, "BLOCK", block)
    docs = made()
    df = spark.createDataFrame([(*d, "x") for d in docs], DOCS)
    for width in (100, 31):
        assert digests(suffix.remove_repeats(df, width)) == brute_suffix(docs, width)


def test_a_cut_inside_a_character(spark):
    a, b = "é" * 80 + "x", "ê" + "é" * 79 + "ë"  # é, ê and ë share their first byte
    got = {r.doc_id: r for r in suffix.remove_repeats(spark.createDataFrame([(1, a, ""), (2, b, "")], DOCS)).collect()}
    text = {r.doc_id: r.kept for r in suffix.remove_repeats(spark.createDataFrame([(1, a, ""), (2, b, "")], DOCS), as_text=True).collect()}
    want = brute_suffix([(1, a), (2, b)])
    assert {i: (r.n_bytes, r.n_removed, len(r.spans), hashlib.sha256(r.kept).hexdigest()) for i, r in got.items()} == want
    assert text == {i: bytes(r.kept).decode("utf-8", "ignore") for i, r in got.items()} and got[2].n_removed % 2 == 1


def test_odd_rows(spark):
    empty = spark.createDataFrame([], DOCS)
    assert simhash.near_duplicates(empty).count() == 0 and suffix.remove_repeats(empty).count() == 0
    long_ = "".join(chr(97 + (i * i) % 23) for i in range(300_000))
    rows = [(None, None, "x"), (None, "abc", "x"), (7, "one two", "x"), (7, "one two", "x"), (7, "three", None),
            (8, long_, "x"), (9, long_[1000:], "y")]
    df = spark.createDataFrame(rows, DOCS).withColumnsRenamed({"lang": "fp"})
    out = simhash.near_duplicates(df).collect()
    assert len(out) == 7 and sum(r.doc_id is None for r in out) == 2
    assert len({r.component_id for r in out if r.doc_id == 7 and r.fingerprint == f"{brute_simhash('one two'):016x}"}) == 1
    kept = suffix.remove_repeats(df, carry=("fp",)).collect()
    assert len(kept) == 7 and {r.n_removed for r in kept if r.doc_id == 9} == {len(long_) - 1000}
    assert [r.n_removed for r in kept if r.doc_id == 7] == [0, 0, 0] and "fp" in kept[0].asDict()


def test_registered(spark):
    d = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in queries.table(spark, d, "documents").collect()]
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in queries.op4_suffix_dedup(spark, d).collect()}
    assert got == brute_suffix(docs)
    prints = [brute_simhash(t) for _, t in docs]
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in queries.op2_simhash(spark, d).collect()} == {
        i: (f"{p:016x}", g) for (i, _), p, g in zip(docs, prints, groups([i for i, _ in docs], prints))}


def test_rows_of_one_id_are_told_apart(spark):
    """However many texts share an id, or have none, each is cut at its own places only."""
    r = random.Random(11)
    texts = [" ".join("".join(r.choice("abcdefgh") for _ in range(6)) for _ in range(60)) for _ in range(1200)]
    rows = [(1, texts[5], "x")] + [(7, t, "x") for t in texts]
    df = spark.createDataFrame(rows, DOCS)
    for out, whole in ((suffix.remove_repeats(df), len(texts[5])), (automata.remove_passages(df), 60)):
        assert sorted(x.n_removed for x in out.collect()) == [0] * 1200 + [whole]
    alone = spark.createDataFrame([(None, t, "x") for t in texts], DOCS)
    for out in (suffix.remove_repeats(alone), automata.remove_passages(alone)):
        assert {x.n_removed for x in out.collect()} == {0}


def kept_words(df):
    return {r.doc_id: (r.n_words, r.n_removed, hashlib.sha256(r.kept.encode()).hexdigest()) for r in df.collect()}


@pytest.mark.parametrize("window, phrase", [(20, 8), (6, 3), (7, 7)])
def test_passages_against_brute(spark, window, phrase):
    docs = made(9)
    df = spark.createDataFrame([(*d, "x") for d in docs], DOCS)
    assert kept_words(automata.remove_passages(df, window, phrase)) == passages(docs, window)


def test_passages_odd_rows(spark):
    assert automata.remove_passages(spark.createDataFrame([], DOCS)).count() == 0
    text = " ".join(f"w{i * i % 977}" for i in range(60_000))
    rows = [(None, None, "x"), (None, "abc", "x"), (7, text, "x"), (7, text, "x"), (8, text, "x"), (9, "q " * 50_000, "x")]
    out = automata.remove_passages(spark.createDataFrame(rows, DOCS).withColumnsRenamed({"lang": "g"}), carry=("g",)).collect()
    want = passages([(7, text)])[7]
    assert len(out) == 6 and [r.n_removed for r in out if r.doc_id == 7] == [want[1]] * 2
    assert [(r.n_removed, r.kept) for r in out if r.doc_id == 8] == [(60_000, "")]
    assert [r.n_removed for r in out if r.doc_id == 9] == [49_999] and "g" in out[0].asDict()


def test_registered_passages(spark):
    d = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in queries.table(spark, d, "documents").collect()]
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in queries.op7_passage_automata(spark, d).collect()} == passages(docs)


def test_blocks_only_cut_runs(monkeypatch):
    """Whatever the block, windows keep their anchors and rank pairs."""
    import numpy as np
    text = np.frombuffer((made()[3][1] * 40 + "ab" * 300).encode(), np.uint8)

    def by_window():
        r = rolling.runs(text, 60, 30, rolling.BYTE_CODES)
        at = np.arange(len(text) - 59)
        gram = [(int(g), int(a)) for g, a, n in zip(r.gram, r.anchor, r.last - r.first + 1) for _ in range(n)]
        return gram, [x.tolist() for x in rolling.pairs_at(text, 60, at, rolling.BYTE_CODES)]
    whole = by_window()
    monkeypatch.setattr(rolling, "BLOCK", 101)
    assert by_window() == whole and len(whole[0]) == len(text) - 59

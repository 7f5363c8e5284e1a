import random

import pytest

from barflow.llm import queries, spelling
from brute import spelling as brute_spelling

DOCS = "doc_id long, text string, n long, word string"


def got(df, **how):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in spelling.variants(df, **how).collect()}


def frame(spark, docs):
    return spark.createDataFrame([(*d, 1, "x") for d in docs], DOCS)


def noisy(seed, letters="abé", words=40, size=(5, 14), docs=50):
    r = random.Random(seed)
    stock = ["".join(r.choice(letters) for _ in range(r.randint(*size))) for _ in range(words)]

    def typed(w):
        if r.random() < .3:
            i = r.randrange(len(w))
            w = r.choice([w[:i] + w[i + 1:], w[:i] + r.choice(letters) + w[i + 1:], w[:i] + r.choice(letters) + w[i:]])
        return w.upper() if r.random() < .1 else w
    return [(i, " ".join(typed(stock[min(r.randrange(words), r.randrange(words))]) for _ in range(60))) for i in range(docs)]


@pytest.mark.parametrize("levels", [40, 8])
def test_against_brute(spark, levels):
    """Few letters, so that words are dense; with 8 levels most words go by what is left without a character."""
    docs = noisy(levels) + [(100, None), (101, ""), (None, "aaaaaaab aaaaaaab"), (None, "aaaaaaa aaaaaaa"), (7, "ÉÉÉÉÉÉÉ×÷ ÉÉÉÉÉÉÉ×÷")]
    want = brute_spelling(docs)
    assert sum(f is not None for f, *_ in want.values()) > 10 and sum(w[3] for w in want.values()) > 100
    assert got(frame(spark, docs), levels=levels) == want


def test_runs_of_one_letter_and_chains(spark):
    words = {"a" * n: 2 for n in range(7, 30)} | {"baaaaaaaa": 30, "bbaaaaaaa": 300, "bbbaaaaaa": 3000}
    docs = [(i, " ".join([w] * n)) for i, (w, n) in enumerate(words.items())]
    have = got(frame(spark, docs), typo=10**12)
    assert have == brute_spelling(docs, typo=10**12)
    assert have["baaaaaaaa"][:2] == ("bbaaaaaaa", "bbbaaaaaa") and have["a" * 9][1] == "bbbaaaaaa"


def test_long_words_and_texts(spark):
    long_ = "".join(chr(97 + (i * i) % 23) for i in range(60_000))
    docs = [(1, long_ + " " + long_), (2, long_[:777] + long_[778:]), (3, long_[:777] + long_[778:]), (4, long_[:-1] + "Z"),
            (5, long_[:-1] + "z"), (6, "lettres " * 300_000), (7, "lettres"), (8, "lettre " * 3)]
    have = got(frame(spark, docs), typo=10**12)
    assert {(len(w), x[2], x[3]) for w, x in have.items()} == {
        (60_000, 2, 2), (59_999, 2, 1), (7, 300_001, 0), (60_000, 2, 1)}


def test_empty(spark):
    assert got(frame(spark, [])) == {} and got(frame(spark, [(1, "no such"), (None, None)])) == {}


def test_registered(spark):
    d = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in queries.table(spark, d, "documents").collect()]
    rows = queries.op11_spelling(spark, d).collect()
    want = brute_spelling(docs)
    assert len(rows) == len(want) and {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows} == want

import random

from barflow.llm import queries, rules
from barflow.llm.common import scratch
from brute import statistics

DOCS = "doc_id long, text string, n_words string"
COLUMNS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def test_statistics_against_brute(spark):
    r = random.Random(2)
    texts = [None, "", " \n\t", "a", "a b", "a b c a b c", "x " * 200, "é|ß #*$ %&<>\n\né|ß #*$ %&<>\n ", "a\xa0b c\x1cd",
             "l\nl\n l\nl \n\n\n", "x\r\nx\ry\x0bz\x0c"]
    texts += ["".join(r.choice("ab \n|é") for _ in range(r.randint(0, 400))) for _ in range(60)]
    df = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)], DOCS)
    got = {x.doc_id: tuple(x[c] for c in COLUMNS) for x in rules.statistics(df).collect()}
    assert got == {i: statistics(t) for i, t in enumerate(texts)}


def test_list_separates_planted_classes(spark):
    r = random.Random(4)
    rows = []
    for i in range(600):
        n, bad = r.randint(50, 900), 0
        chars, symbols = int(n * r.uniform(4, 6)), r.choice([0, 0, 0, 1])
        kind = r.random()
        if kind < .15:
            symbols, bad = int(n * r.uniform(.3, 2)), 1
        elif kind < .25:
            chars, bad = int(n * r.uniform(9, 12)), 1
        rows.append((i, n, chars, symbols, 0, 0, bad))
    df = spark.createDataFrame(rows, "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
                                     "n_repeat_words long, bad int")
    with scratch(spark) as s:
        found = rules.learn(df, s)
    wrong = df.filter((rules.rejected(found).isNotNull()).cast("int") != df.bad).count()
    assert 2 <= len(found) <= rules.MAX_RULES and wrong <= 3
    assert all(rules.rejected([x]) is not None and " AND " in f"{x} AND " for x in found)


def test_registered_keeps_clean_and_drops_junk(spark):
    d = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in queries.op9_quality_rules(spark, d).collect()}
    docs = {r.doc_id: r.text for r in queries.table(spark, d, "documents").collect()}
    assert set(got) == set(docs)
    assert all(tuple(got[i][c] for c in COLUMNS) == statistics(t) for i, t in docs.items() if len(t) < 4000)
    assert all(r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words) for r in got.values())
    known = [r for r in queries.table(spark, d, "labels").collect() if not got[r.doc_id].base_failed]
    assert sum((got[r.doc_id].kept) != (r.quality == 1) for r in known) <= 0.01 * len(known)


def test_odd_rows(spark):
    empty = spark.createDataFrame([], DOCS)
    labels = spark.createDataFrame([(1, 0, None), (1, 1, 0), (None, 1, 0), (5, None, 1)], "doc_id long, quality int, toxic int")
    assert rules.judge(empty, labels).count() == 0
    df = spark.createDataFrame([(None, None, None), (1, "w " * 60, "x"), (1, "w " * 60, "x"), (2, "ab " + " ".join(map(str, range(99))), "x"),
                                (3, "word" * 200_000, "x")], DOCS)
    out = rules.judge(df, labels).collect()
    assert [r.kept for r in sorted(out, key=lambda r: (r.doc_id or 0, r.n_words))] == [False, False, False, True, False]
    assert rules.judge(df, labels.limit(0)).count() == 5

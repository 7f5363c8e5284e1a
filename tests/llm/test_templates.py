from pyspark.sql import functions as F

import corpus_pipeline
from barflow.llm import queries, templates

DOCS = "doc_id long, text string, lang string"
ITEMS = [(1, "A train leaves Paris at 60 km per hour and after 3 hours meets Anna who drove 60 km from the other town."),
         (2, "How many apples remain when the farmer gives away half of the basket to all the neighbours?"), (3, None), (4, ""),
         (5, "Two plus two")]


def found(spark, rows, **more):
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], DOCS)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    return {(r.doc_id, r.item_id): r for r in templates.leaks(docs, items, **more).collect()}


def test_reparameterised_and_inconsistent(spark):
    a = ITEMS[0][1]
    rows = [(10, "Some words first. " + a + " And after."),
            (11, "Intro here. " + a.replace("60", "75").replace("Paris", "London").replace("Anna", "Tom")),
            (12, "Intro here. " + a.replace("60", "75", 1)),          # 60 stands for two numbers
            (13, "Intro here. " + a.replace("3 hours", "60 hours")),  # two numbers become one
            (14, "Nothing of the kind is said in this text at all, it only talks of apples and trains."),
            (15, None), (16, ""), (None, ITEMS[1][1]), (17, "x " * 3000 + ITEMS[1][1].upper().lower() + " y" * 3000),
            (17, "x " * 3000 + ITEMS[1][1].upper().lower() + " y" * 3000), (18, "She said two plus two is four")]
    for many in (10**6, 0):
        got = found(spark, rows, broadcast_windows=many)
        assert set(got) == {(10, 1), (11, 1), (None, 2), (17, 2), (18, 5)}  # three words are sought inside texts too
        assert got[10, 1].same_slots and not got[11, 1].same_slots and got[17, 2].cover == 1


def test_items_of_numbers(spark):
    """Windows that are mostly slots match by their surfaces and count in the cover."""
    items = [(1, "Compute 12 + 37 * 4 - 9 + 15"), (2, "Given 8 and 9 and 10 and 11 add 1 2 3 4 5 6 and say how large the whole sum is")]
    rows = [(20, "Here is one. Compute 12 + 37 * 4 - 9 + 15 and say why."), (21, "Here is one. Compute 13 + 37 * 4 - 9 + 15 and say why."),
            (22, "Now. " + items[1][1]), (23, "Now. " + items[1][1].replace("8", "18").replace("2", "22"))]
    docs = spark.createDataFrame([(*r, "x") for r in rows], DOCS)
    got = {(r.doc_id, r.item_id): r for r in templates.leaks(docs, spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert set(got) == {(20, 1), (22, 2), (23, 2)}
    assert got[20, 1].cover == 1 and got[22, 2].cover == 1 and got[22, 2].same_slots and not got[23, 2].same_slots
    n = len("given 8 and 9 and 10 and 11 add 1 2 3 4 5 6 and say how large the whole sum is".split())
    assert got[22, 2].n_windows == n - 5


def test_short_items_inside_documents(spark):
    items = [(1, "Two plus two"), (2, "Explain how the water cycle works"), (3, "三加四等于几"), (4, "Why"), (5, "Is 7 prime or not")]
    rows = [(30, "Nobody knew that two plus two is four."), (31, "We say please Explain how the water cycle works in a text."),
            (32, "请问三加四等于几呢我不知道这个问题的答案是什么"), (33, "nothing of them"), (34, "so tell me Is 11 prime or not my friend"),
            (35, "two plus"), (36, "tell me why it is so")]
    docs = spark.createDataFrame([(*r, "x") for r in rows], DOCS)
    for many in (10**6, 0):
        got = {(r.doc_id, r.item_id): r for r in templates.leaks(
            docs, spark.createDataFrame(items, "item_id long, text string"), broadcast_windows=many).collect()}
        assert set(got) == {(30, 1), (31, 2), (32, 3), (34, 5), (36, 4)}
        assert all(r.cover == 1 and r.n_windows == 1 for r in got.values()) and not got[34, 5].same_slots


def test_texts_that_share_an_id(spark, tmp_path):
    a = ITEMS[0][1]
    clean = "Nothing of the kind is said in this text at all, it only talks of apples and of trains and of rain."
    leaked = ["Intro here. " + a.replace("60", "75"), "Other start of it. " + a.replace("60", "85").replace("Anna", "Tom")]
    rows = [(k, t) for k in (None, 7) for t in [*leaked, clean]]
    assert set(found(spark, rows)) == {(None, 1), (7, 1)}
    spark.createDataFrame(ITEMS, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], DOCS)
    left = corpus_pipeline.decontaminated(spark, docs, str(tmp_path)).collect()
    assert sorted((r.doc_id or 0, r.text) for r in left) == [(0, clean), (7, clean)]


def test_lists_of_digits(spark):
    """A long run of digits neither fills the stack nor takes quadratic time."""
    a = ITEMS[0][1]
    got = found(spark, [(1, "1," * 500_000 + " " + a), (2, "7" * 500_000), (3, "1.5 km, 2,000 kg")])
    assert set(got) == {(1, 1)}
    row = spark.range(1).select(templates.tokens(F.lit("Run 1,000.5 km or 3kg in 7 kmx")).alias("t")).first().t
    assert row == ["run", "#1_000_5", "@km", "or", "#3", "@kg", "in", "#7", "kmx"]


def test_a_shared_beginning_is_no_leak(spark):
    """Items that begin alike don't all match a text that has only that beginning; an item's own rest does."""
    start = "Read the following text with care and then answer the question that is asked below in full"
    rest = lambda i: " ".join(f"w{chr(97 + i % 26)}{chr(97 + i // 26)}{chr(97 + k)}" for k in range(14))
    items = [(i, f"{start} {rest(i)}") for i in range(60)] + [(None, "an item that has no id of its own but eleven words")]
    rows = [(100 + i, f"so {start} please do it", "x") for i in range(50)] + [
        (1, f"it says {items[7][1]} end", "x"), (2, f"only {rest(9)} here", "x"), (3, "see " + items[-1][1] + " there", "x")]
    out = templates.leaks(spark.createDataFrame(rows, DOCS), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id) for r in out} == {(1, 7), (2, 9), (3, None)}


def test_empty_tables(spark):
    assert found(spark, []) == {}
    docs = spark.createDataFrame([(1, "a b c d e f g", "x")], DOCS)
    assert templates.leaks(docs, spark.createDataFrame([], "item_id long, text string")).count() == 0


def test_registered_finds_planted_passages(spark):
    d = "/root/testdata/sf0.01"
    items = [(r.item_id, r.text) for r in queries.table(spark, d, "benchmark").collect()]
    docs = [(r.doc_id, r.text) for r in queries.table(spark, d, "documents").collect()]
    whole = {(i, k) for i, t in docs for k, x in items if x in t}
    got = {(r.doc_id, r.item_id) for r in queries.op5_template_decontamination(spark, d).collect()}
    assert whole <= got
    words = [(i, " ".join(t.split())) for i, t in docs]
    grams = lambda t: {tuple(t.split()[j:j + 6]) for j in range(len(t.split()) - 5)}
    for i, k in got - whole:
        a, b = grams(dict(words)[i]), grams(dict(items)[k])
        assert len(a & b) >= 0.3 * len(b)

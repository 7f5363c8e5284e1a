import zlib

import corpus_pipeline
import numpy as np
from tokenizers import Tokenizer

from barflow.llm import queries, tokens
from brute import groups, simhash, suffix

SMALL = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, n_words string, kept string"


def cut(docs, width=100):
    """Texts without the strings that start earlier, for documents in id order."""
    seen, out = set(), []
    for d, text in sorted(docs):
        b = text.encode()
        dead = bytearray(len(b))
        for i in range(len(b) - width + 1):
            if b[i:i + width] in seen:
                dead[i:i + width] = b"\1" * width
            seen.add(b[i:i + width])
        rest = bytes(x for x, k in zip(b, dead) if not k).decode("utf-8", "ignore")
        if rest or not any(dead):
            out.append((d, rest))
    return out


def test_stages_one_after_the_other(spark):
    docs = {r.doc_id: r.text for r in queries.table(spark, SMALL, "documents").collect()}
    kept = {r.doc_id for r in queries.op9_quality_rules(spark, SMALL).filter("kept").collect()}
    docs = sorted((i, t) for i, t in docs.items() if i in kept)
    least = groups([i for i, _ in docs], [simhash(t) for _, t in docs])
    docs = [(i, t) for (i, t), g in zip(docs, least) if i == g]
    docs = cut(docs)
    items = [" ".join(r.text.split()) for r in queries.table(spark, SMALL, "benchmark").collect()]
    whole = {i for i, t in docs if any(x in " ".join(t.split()) for x in items)}
    assert whole
    t = Tokenizer.from_file(tokens.default_path())
    got = corpus_pipeline.run(spark, SMALL).collect()
    left = {r.doc_id for r in got}
    assert left <= {i for i, _ in docs} - whole and len(left) >= 0.95 * (len(docs) - len(whole))
    for i, text in docs:
        if i in left:
            ids, at = t.encode(text, add_special_tokens=False).ids + [2], 0
            for p in sorted((r for r in got if r.doc_id == i), key=lambda r: r.start):
                assert p.start == at and p.ids_crc32 == zlib.crc32(np.array(ids[at:at + p.length], "<u4").tobytes())
                at += p.length
            assert at == len(ids)


def test_every_stage_takes_odd_rows(spark):
    good = " ".join(f"word{i * i % 83}" for i in range(120))
    rows = [(None, None, None, None, None, None, None), (None, good, "x", None, 5, "a", "b"), (1, "", None, "s", None, None, None),
            (2, good + " and more", "x", "s", 1, "a", "b"), (2, good + " and more", "x", "s", 1, "a", "b"),
            (3, " ".join(f"other{i}" for i in range(300_000)), "x", "s", None, None, "b")]
    df = spark.createDataFrame(rows, DOCS)
    for name, stage in corpus_pipeline.STAGES:
        for frame in (df, df.limit(0)):
            out = stage(spark, frame, SMALL)
            if stage is not corpus_pipeline.packed:
                assert out.columns == df.columns, name
            n = out.count()
            assert n == 0 if frame is not df else n > 0, name


def test_clean_documents_stay(spark):
    docs = queries.table(spark, SMALL, "documents")
    for name, stage in corpus_pipeline.STAGES[:1] + corpus_pipeline.STAGES[3:4]:
        out = {r.doc_id for r in stage(spark, docs, SMALL).collect()}
        assert len(out) >= 0.7 * docs.count(), name
    texts = {r.doc_id: r.text for r in docs.collect()}
    after = {r.doc_id: r.text for r in corpus_pipeline.repeats(spark, docs, SMALL).collect()}
    digest = suffix(list(texts.items()))
    assert all(after[i] == t for i, t in texts.items() if digest[i][1] == 0)


def test_near_duplicates_of_rows_that_share_an_id(spark):
    a, b, c = ("one two three four five six", "seven eight nine ten eleven twelve", "red green blue white black brown")
    rows = [(3, a), (7, a), (7, b), (None, c), (None, c), (None, a), (9, c), (9, b), (10, None), (11, "")]
    docs = spark.createDataFrame([(i, t, "x", "y", 0, "p", "q") for i, t in rows], DOCS)
    left = corpus_pipeline.near_duplicates(spark, docs, SMALL)
    assert left.columns == docs.columns
    # the smallest id of each group, no id below all: both rows of its text stay
    assert sorted((str(r.doc_id), str(r.text)) for r in left.collect()) == sorted(
        [("None", c), ("None", c), ("None", a), ("7", b), ("10", "None")])


def test_short_items_leave_documents_alone(spark, tmp_path):
    spark.createDataFrame([(1, "Why"), (2, "Tell me why it is so cold")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = [(1, "nobody knows why"), (2, "please tell me why it is so cold today"), (3, "Why")]
    docs = spark.createDataFrame([(i, t, "x", "y", 0, "p", "q") for i, t in rows], DOCS)
    assert sorted(r.doc_id for r in corpus_pipeline.decontaminated(spark, docs, str(tmp_path)).collect()) == [1, 3]

import hashlib
import random

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from barflow.llm import align, queries
from brute import aligned
from test_bpe import texts as odd_texts

A_PATH, B_PATH = align.default_paths()


@pytest.fixture(scope="module")
def plain():
    """Both tokenizers as the libraries give them, and their tokens' bytes."""
    a = Tokenizer.from_file(A_PATH)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=B_PATH)
    stands = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(x): x for x in stands} | {chr(256 + i): x for i, x in enumerate(x for x in range(256) if x not in stands)}
    a_bytes = {i: bytes(letters[c] for c in t) for t, i in a.get_vocab().items() if t != "<|endoftext|>"}
    b_bytes = {}
    for i in range(b.vocab_size()):
        t = b.id_to_piece(i)
        b_bytes[i] = bytes([int(t[3:5], 16)]) if t.startswith("<0x") and len(t) == 6 else t.replace("▁", " ").encode()

    def run(texts):
        return aligned(texts, [a.encode(" " + (t or ""), add_special_tokens=False).ids for t in texts], a_bytes,
                       [b.encode(t or "") for t in texts], b_bytes)
    return run


FIELDS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]


@pytest.mark.parametrize("size", [4 << 20, 300])
def test_against_brute(spark, plain, monkeypatch, size):
    monkeypatch.setattr(align, "BATCH", size)
    texts = odd_texts(3) + [None, "a▁b", "<s> </s> <unk> <0x41>", "same text", "same text", "日" * 400, "　 x"]
    df = spark.createDataFrame([(i if i % 7 else None, t, i) for i, t in enumerate(texts)], "doc_id long, text string, n_a long").repartition(3)
    want = sorted((str(i if i % 7 else None), *w) for i, w in enumerate(plain(texts)))
    rows = align.align(df).collect()
    assert sorted((str(r.doc_id), *(r[f] for f in FIELDS)) for r in rows) == want
    assert sum(w[3] == 0 for w in want) > 2 and max(w[4] for w in want) > 100


def test_blocks_and_answers_stay_small(spark, plain, monkeypatch):
    """Python aligns a few texts of a batch at a time, whose narrow numbers stay; no aggregate or row in Spark holds a batch's answers."""
    from types import SimpleNamespace

    import pyarrow as pa
    from pyspark.sql import functions as F

    from barflow.llm.common import Scratch

    r = random.Random(5)
    texts = [" ".join(r.choice(["alpha", "Beta,", "gamma9", "été"]) for _ in range(r.randrange(300))) for _ in range(300)] + ["long " * 100_000]
    sizes, batch = [], align.Batch
    monkeypatch.setattr(align, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 0)))
    monkeypatch.setattr(align, "Batch", lambda tool, x: sizes.append(sum(map(len, x))) or batch(tool, x))
    rows = pa.record_batch([pa.array(range(301)), pa.array(texts)], names=["id", "text"])
    stored, = align._batches((A_PATH, B_PATH), True)(iter([rows]))
    assert sum(sizes) == sum(map(len, texts)) and max(sizes) < (1 << 18) + 500_001 and len(sizes) > 1
    assert stored.column("id")[0].as_py() == list(range(301))
    pairs = sum(stored.column("n_pairs")[0].as_py())
    assert len(stored.column("place")[0].as_py()) <= 2 * pairs

    monkeypatch.undo()
    made, table = [], Scratch.table
    monkeypatch.setattr(Scratch, "table", lambda s, t, *a: made.append(t) or table(s, t, *a))
    df = spark.createDataFrame(list(enumerate(texts[:40])), "doc_id long, text string")
    got = align.align(df)
    assert not any("collect_list" in x._jdf.queryExecution().toString() for x in [*made, got])
    assert got.select(F.sum("n_links")).first()[0] == sum(w[3] for w in plain(texts[:40]))


def test_pointers_reach_the_terminal():
    r = random.Random(2)
    for _ in range(200):
        n = r.randint(1, 300)
        ends = [np.array(sorted({*r.sample(range(1, n + 1), r.randint(0, n // r.randint(1, 9))), n})) for _ in range(2)]
        to, *_ = align.terminals(*ends)
        both = np.intersect1d(*ends)
        want = [int(np.searchsorted(ends[0], both[np.searchsorted(both, e)])) for side in ends for e in side]
        assert to.tolist() == want
    # one group of 2 * 50,000 tokens that overlap in a chain
    a, b = np.arange(2, 100_001, 2), np.append(np.arange(1, 100_000, 2), 100_000)
    assert set(align.terminals(a, b)[0].tolist()) == {len(a) - 1}


def test_rows(spark, plain):
    text = "café " * 3000
    df = spark.createDataFrame([(1, text), (1, "b"), (1, "b"), (None, None)], "doc_id long, text string").withColumnsRenamed({"text": "t"})
    rows = align.align(df, text_col="t").collect()
    assert sorted(tuple(r[f] for f in FIELDS) for r in rows) == sorted(plain([text, "b", "b", None]))
    assert align.align(df.limit(0), text_col="t").count() == 0
    long_ = align.align(spark.createDataFrame([(1, "one " * 400_000)], "doc_id long, text string")).first()
    assert (long_.n_a, long_.n_b, long_.n_groups, long_.n_links, long_.n_best) == (400_001, 400_001, 400_001, 400_001, 400_001)


def test_registered(spark, plain):
    d = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in queries.table(spark, d, "documents").collect()]
    want = {i: (*w[:-1], hashlib.sha256(w[-1].encode()).hexdigest() if w[-1] else "") for (i, _), w in zip(docs, plain([t for _, t in docs]))}
    names = [*FIELDS[:-1], "groups_sha256"]
    assert {r.doc_id: tuple(r[f] for f in names) for r in queries.op13_align(spark, d).collect()} == want

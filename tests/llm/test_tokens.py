import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from barflow.llm import packing, queries, tokens, tokenstore
from barflow.llm.common import Scratch

DOCS = "doc_id long, text string, start string"
SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def plain():
    t = Tokenizer.from_file(tokens.default_path())
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


def u32(ids):
    return np.array(ids, "<u4").tobytes()


def test_words_give_the_ids_of_the_text(plain, monkeypatch):
    r = random.Random(5)
    alphabet = list("abzABZ.,;:'\"!?-_ \n\t\x0b\x0c\r0123éÉßüçñİıŉΣσςǅ|<>~²½ªº·") + [
        "<|endoftext|>", "<|startoftext|>", "é", "́", "क़", " ", "\xa0", "가", "中", "😀", "'s", "'LL", "don't", "\x1c", "\x85"]
    encoder = tokens.Encoder(tokens.default_path())
    assert encoder.by_word
    monkeypatch.setattr(tokens, "REMEMBERED", 400)
    for _ in range(3000):
        text = "".join(r.choice(alphabet) for _ in range(r.randint(0, 60)))
        assert encoder.encode(text) == u32(plain(text)), repr(text)
    import public_tokenizers
    other = tokens.Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    assert not other.by_word and other.encode("a  b\n c") == u32(other._ids("a  b\n c"))


def test_a_known_word_is_looked_up_once_and_a_new_one_encoded_once(plain, monkeypatch):
    encoder = tokens.Encoder(tokens.default_path())
    assert encoder.direct
    asked, batches = [], []
    encode_words, batch = encoder._encode_words, encoder.tokenizer.encode_batch_fast

    class Batches:
        def encode_batch_fast(self, texts, **kw):
            batches.extend(texts)
            return batch(texts, **kw)
    monkeypatch.setattr(encoder, "tokenizer", Batches())
    monkeypatch.setattr(encoder, "_encode_words", lambda words: asked.append(sorted(words)) or encode_words(words))
    texts = ["One two three two", "two zwölf one.", None, "three ONE"]
    for _ in range(2):
        assert list(encoder.encode_all(texts)) == [u32(plain(t)) for t in texts]
    assert asked[0] == sorted("one two three zwölf .".encode().split()) and not any(asked[1:])
    assert sorted(batches) == [".", "zwölf"]  # words of a to z are not normalised and split again
    monkeypatch.setattr(tokens, "REMEMBERED", 3)
    for _ in range(3):
        assert list(encoder.encode_all([*texts, "four", "one five"])) == [u32(plain(t)) for t in [*texts, "four", "one five"]]


def test_packing_is_gapless_and_unpadded(spark, plain):
    docs = [(r.doc_id, r.text) for r in queries.table(spark, SMALL, "documents").collect()]
    docs += [(-1, None), (-2, ""), (-3, "x " * 30_000), (-4, "y " * 4095), (-5, "y " * 4096)]
    df = spark.createDataFrame([(i, t, "clash") for i, t in docs], DOCS).repartition(3)
    rows = packing.pack(df).collect()
    pieces, windows = {}, {}
    for r in rows:
        pieces.setdefault(r.doc_id, []).append(r)
        windows.setdefault(r.sequence_id, []).append(r)
    for i, t in docs:
        ids, at = plain(t) + [2], 0
        for p in sorted(pieces[i], key=lambda p: p.start):
            assert p.start == at and p.doc_tokens == len(ids)
            assert p.ids_crc32 == zlib.crc32(u32(ids[at:at + p.length]))
            at += p.length
        assert at == len(ids)
    for w in windows.values():
        at = 0
        for p in sorted(w, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= 4096 and at & (at - 1) == 0
    whole = sum(len(p) == 1 for i, p in pieces.items() if p[0].doc_tokens <= 4096)
    assert whole >= 0.8 * sum(p[0].doc_tokens <= 4096 for p in pieces.values())


def test_packer_chooses_the_least_sum_of_squares():
    r = random.Random(6)
    p = packing.Packer(capacity=64, max_open=10**9)
    for k in range(3000):
        n, size = p.levels.copy(), r.randint(1, 40)
        costs = {}
        for h in range(64):
            if (h == 0 or n[h]) and h + size <= 64:
                m = n.copy()
                if h:
                    m[h] -= 1
                if h + size < 64:
                    m[h + size] += 1
                costs[h] = int((m.astype(int) ** 2).sum())
        p.add(k, u32(range(size)))
        assert int((p.levels.astype(int) ** 2).sum()) == min(costs.values())
    assert p.open == p.levels.sum() <= 64
    p.close()
    sizes = [sum(len(x[2]) // 4 for x in w) for w in p.done]
    assert all(s & (s - 1) == 0 for s in sizes) and sum(s < 64 for s in sizes) <= 6


def test_store_round_trip(spark, plain):
    docs = [(r.doc_id, r.text) for r in queries.table(spark, SMALL, "documents").collect()] + [(-7, None), (None, "none"), (5000, "x" * 100_000)]
    folder = f"{Scratch(spark).root}/store"
    tokenstore.write(spark.createDataFrame([(i, t, "clash") for i, t in docs], DOCS).repartition(5), folder)
    got = {r.doc_id: (r.start, r.n_tokens, bytes(r.ids)) for r in tokenstore.read(spark, folder).collect()}
    at = 0
    for i, t in sorted(docs, key=lambda d: (d[0] is not None, d[0])):
        ids = plain(t) + [2]
        assert got.pop(i) == (at, len(ids), u32(ids))
        at += len(ids)
    assert not got
    two = tokenstore.read(spark, folder, only=[-7, 20]).collect()
    assert {r.doc_id for r in two} == {-7, 20} and {r.start for r in two} >= {len(plain("none")) + 1}
    stored = spark.read.parquet(f"{folder}/dictionary").first()
    assert len(stored.data) > 1000


def test_empty_and_repeated(spark):
    empty = spark.createDataFrame([], DOCS)
    folder = f"{Scratch(spark).root}/empty"
    tokenstore.write(empty, folder)
    assert tokenstore.read(spark, folder).count() == 0 and packing.pack(empty).count() == 0
    df = spark.createDataFrame([(1, "a b", None), (1, "a b", None), (1, "c", "x"), (None, None, None)], DOCS)
    folder = f"{Scratch(spark).root}/few"
    tokenstore.write(df, folder)
    assert sorted(r.start for r in tokenstore.read(spark, folder).collect()) in ([0, 1, 3, 6], [0, 1, 4, 6], [0, 1, 3, 5])
    assert packing.pack(df).agg({"length": "sum"}).first()[0] == 9


def test_registered(spark, plain):
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in queries.op3_token_files(spark, SMALL).collect()}
    at = 0
    for r in queries.table(spark, SMALL, "documents").orderBy("doc_id").collect():
        ids = plain(r.text) + [2]
        assert got[r.doc_id] == (at, len(ids), zlib.crc32(u32(ids)))
        at += len(ids)
    assert queries.op6_packing(spark, SMALL).agg({"length": "sum"}).first()[0] == at

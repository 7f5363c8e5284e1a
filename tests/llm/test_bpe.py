import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from barflow.llm import bpe, queries, tokens

ODD = ["", " ", "a", "It's we'll I'VE 'S", "<|endoftext|>", "x<|startoftext|>y <|endoftext|>z<|endo", "<|ENDOFTEXT|>", "İstanbul ΣΑΣ ς ß",
       "é ́x ẛ̣", "a b c\x85d\x1ce", "日本語 テスト 한국어 العربية", "👩‍👩‍👧 🇫🇷!!", "\x00\x01", "½ ² ௧ 12345",
       "a\tb\nc\r\nd\x0be\x0cf", "......!!??--''\"\"", "﻿bom", "q" * 3000, "ab" * 2000, "x'" * 50, "fi ﬁ ǅ ŉ"]


def texts(seed):
    r = random.Random(seed)
    pool = "abcdeéßİσς'.,<|>0123 \n\t日한е́👍_-/\\"
    return ODD + ["".join(r.choice(pool) for _ in range(r.randint(1, 80))) for _ in range(300)] + [
        " ".join("".join(r.choice("etaoinshr") for _ in range(r.randint(1, 25))) for _ in range(50)) for _ in range(50)]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_as_the_library(name):
    path = public_tokenizers.path(name)
    mine, theirs = bpe.Codec(path), Tokenizer.from_file(path)
    assert mine.by_word == mine.by_class == (name == "word_bpe_49k.json")
    for t in texts(1):
        want = theirs.encode(t, add_special_tokens=False).ids
        ids = mine.encode(t)
        assert np.frombuffer(ids, "<u4").tolist() == want, t
        assert mine.decode(ids) == theirs.decode(want, skip_special_tokens=False), t
    strange = [5, 10**6, 7, 49407]
    assert mine.decode(np.array(strange, "<u4").tobytes()) == theirs.decode(strange, skip_special_tokens=False)


def test_small_memory_and_parts(monkeypatch):
    codec = bpe.Codec(bpe.default_path())
    want = [codec.encode(t) for t in texts(2)]
    for name, value in (("REMEMBERED", 7), ("PART", 40), ("WORD_BYTES", 3)):
        monkeypatch.setattr(bpe, name, value)
    monkeypatch.setattr(tokens, "_PART", 40)
    small = bpe.Codec(bpe.default_path())
    for t, ids in zip(texts(2), want):
        assert small.encode(t) == ids and small.decode(ids) == codec.decode(ids)
        small.forget()


def test_stale_entries_are_skipped():
    """The queue alone gives the merge order: the plain method, rank by rank, agrees."""
    codec = bpe.Codec(bpe.default_path())

    def plain(unit):
        ids = [codec.vocabulary[c] for c in [*unit[:-1], unit[-1] + codec.suffix]]
        while True:
            found = [(r, i) for i in range(len(ids) - 1) if (r := codec.rank.get(ids[i] * codec.width + ids[i + 1])) is not None]
            if not found:
                return ids
            rank, at = min(found)
            ids[at:at + 2] = [codec.together[rank]]
    r = random.Random(5)
    for _ in range(500):
        unit = "".join(r.choice("etaoinshrdlu") for _ in range(r.randint(1, 40)))
        assert codec.merged(unit) == plain(unit)


def test_rows(spark):
    rows = [(None, None, 1), (1, "", 2), (1, "Two words", None), (1, "Two words", 3), (2, "long " * 400_000, 4)]
    df = spark.createDataFrame(rows, "doc_id long, ids string, decoded long").withColumnRenamed("ids", "text")
    out = {(r.doc_id, r.decoded): r.ids for r in bpe.encode(df).collect()}
    theirs = Tokenizer.from_file(bpe.default_path())
    assert {k: len(v) // 4 for k, v in out.items()} == {(None, 1): 0, (1, 2): 0, (1, None): 2, (1, 3): 2, (2, 4): 400_000}
    assert np.frombuffer(out[1, 3], "<u4").tolist() == theirs.encode("Two words").ids
    back = bpe.decode(bpe.encode(df).withColumnRenamed("decoded", "text"), to="said").collect()
    assert sorted(r.said[:20] for r in back) == ["", "", "long</w> long</w> lo", "two</w> words</w>", "two</w> words</w>"]
    clash = df.withColumn("ids", df.decoded)
    assert bpe.encode(clash).columns == ["doc_id", "decoded", "ids"]
    assert bpe.decode(bpe.encode(df.limit(0))).count() == 0


def test_registered(spark):
    d = "/root/testdata/sf0.001"
    theirs = Tokenizer.from_file(bpe.default_path())
    want = {}
    for r in queries.table(spark, d, "documents").collect():
        ids = theirs.encode(r.text or "", add_special_tokens=False).ids
        want[r.doc_id] = (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                          hashlib.sha256(theirs.decode(ids, skip_special_tokens=False).encode()).hexdigest())
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in queries.op12_bpe(spark, d).collect()} == want

"""Alignment of two tokenizers' tokens over the bytes of each text.

Tokens are byte ranges. Each token points to the token that reaches farthest to
the right among itself and those of the other tokenizer it overlaps (of equals
the first tokenizer's). Doubling the pointers, for all texts of a batch at once,
takes every token to its group's last one in a logarithmic number of passes;
the tokens that end up at one terminal are a group.

Counts of linked id pairs are summed over the corpus. Texts stay in the batches
they were aligned in: a batch asks for the counts of its distinct pairs once,
by a join, and its texts look them up in the answers, which are grouped by batch
in Python's memory only. A batch is aligned in blocks, of which the figures stay.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barflow.llm.bpe import _byte_of
from barflow.llm.common import scratch
from barflow.llm.pitman_yor import _small, _wide

#: Bytes of text of a batch, and of those aligned at once; a longer text goes alone.
BATCH, BLOCK = 4 << 20, 1 << 18
#: Texts of other characters are encoded by the tokenizer file's own library, so that tables of character classes agree.
_ODD = re.compile("[^\\x00-\\x7f\xa0-ɏͰ-ԯ‐-‧€一-龥가-힣]")


def default_paths() -> tuple[str, str]:
    import public_tokenizers as p
    return p.path("byte_bpe_50k.json"), p.path("piece_bpe_32k.model")


class ByteLevel:
    """A byte-level tokenizer file; ordinary texts are encoded by a faster
    library from the same vocabulary, if its merges are in the order of its ids."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.slow = Tokenizer.from_file(path)
        self.slow.encode_special_tokens = True
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        byte, vocab = _byte_of(), file["model"]["vocab"]
        self.bytes: list[bytes] = [b""] * (self.slow.get_vocab_size() + 1)
        for t, i in self.slow.get_vocab().items():
            self.bytes[i] = t.encode()
        for t, i in vocab.items():
            if all(c in byte for c in t):
                self.bytes[i] = bytes(byte[c] for c in t)
        self.fast = None
        merges = [m if isinstance(m, list) else m.split(" ") for m in file["model"]["merges"]]
        ids = [vocab.get(a + b, -1) for a, b in merges]
        splits = file["pre_tokenizer"] or {}
        plain = file["normalizer"] is None and not any(file["model"].get(k) for k in (
            "dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
        if plain and splits.get("type") == "ByteLevel" and splits.get("use_regex") and not splits.get("add_prefix_space"):
            ranks = {self.bytes[i]: i for i in vocab.values() if len(self.bytes[i]) == 1}
            if len(ranks) == 256 and ids == sorted(set(ids)) and ids[0] > max(ranks.values()):
                import public_tokenizers
                import tiktoken
                ranks |= {self.bytes[i]: i for i in ids}
                self.fast = tiktoken.Encoding("file", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, texts: list[str]) -> list[list[int]]:
        if self.fast is None:
            return [e.ids for e in self.slow.encode_batch_fast(texts, add_special_tokens=False)]
        return [self.slow.encode(t, add_special_tokens=False).ids if not t.isascii() and _ODD.search(t)
                else self.fast.encode_ordinary(t) for t in texts]


class Pieces:
    """A sentencepiece model; it puts a space before the text itself."""

    def __init__(self, path: str):
        import sentencepiece
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [self.model.id_to_piece(i) for i in range(self.model.vocab_size())]
        self.bytes = [bytes([int(t[3:5], 16)]) if re.fullmatch("<0x[0-9A-Fa-f]{2}>", t)
                      else t.replace("▁", " ").encode() for t in names]

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


class Aligner:
    def __init__(self, a_path: str, b_path: str):
        self.a, self.b = ByteLevel(a_path), Pieces(b_path)
        self.size = [np.array([len(t) for t in side.bytes], np.int64) for side in (self.a, self.b)]
        #: each id's decimal before another of its side, and before the other side or group
        self.names = [f"{i}{c}" for side, ends in ((self.a, ",|"), (self.b, ",;")) for i in range(len(side.bytes)) for c in ends]

    def tokens(self, texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray]:
        """Both sides' ids of each text (none where its bytes aren't given back), and the texts' bytes."""
        spaced = [" " + t for t in texts]
        sides = [[], []]
        sizes = np.zeros(len(texts), np.int64)
        for k, (text, a, b) in enumerate(zip(spaced, self.a.encode(spaced), self.b.encode(texts))):
            data = text.encode("utf-8")
            if len(data) == 1 or any(b"".join(map(s.bytes.__getitem__, ids)) != data for s, ids in ((self.a, a), (self.b, b))):
                a = b = []
            else:
                sizes[k] = len(data)
            sides[0].append(np.array(a, np.int64))
            sides[1].append(np.array(b, np.int64))
        return sides[0], sides[1], sizes


@lru_cache(maxsize=2)
def aligner(a_path: str, b_path: str) -> Aligner:
    return Aligner(a_path, b_path)


def terminals(a_end: np.ndarray, b_end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For every token of both sides (first side first) the place of its group's
    terminal token, and for every byte the token of either side it lies in. The
    ends ascend and the last ones are equal."""
    n, m = len(a_end), len(b_end)
    a_at = np.repeat(np.arange(n), np.diff(a_end, prepend=0))
    b_at = np.repeat(np.arange(m), np.diff(b_end, prepend=0))
    over_b, over_a = b_at[a_end - 1], a_at[b_end - 1]  # the other side's token at each token's last byte
    to = np.concatenate([np.where(b_end[over_b] > a_end, over_b + n, np.arange(n)), over_a])
    while True:
        onward = to[to]
        if np.array_equal(onward, to):
            return to, a_at, b_at
        to = onward


class Batch:
    """The alignment of some texts, in arrays over all of them."""

    def __init__(self, tool: Aligner, texts: list[str]):
        self.tool = tool
        a, b, sizes = tool.tokens(texts)
        self.n_a, self.n_b = (np.array([len(x) for x in side], np.int64) for side in (a, b))
        self.a, self.b = (np.concatenate([np.zeros(0, np.int64), *side]) for side in (a, b))
        self.text_end = np.cumsum(sizes)
        a_end, b_end = (np.cumsum(size[ids]) for size, ids in zip(tool.size, (self.a, self.b)))
        to, a_at, b_at = terminals(a_end, b_end)
        last = np.flatnonzero(to[:len(a_end)] == np.arange(len(a_end)))  # terminals, ascending
        group = np.searchsorted(last, to)
        self.a_group, self.b_group = group[:len(a_end)], group[len(a_end):]
        self.n_groups = np.diff(np.searchsorted(a_end[last], self.text_end, "right"), prepend=0)
        # between two neighbouring ends lies one token of either side: a link
        cut = np.zeros(len(a_at) + 1, bool)
        cut[a_end] = cut[b_end] = True
        cut[0] = False
        ends = np.flatnonzero(cut)
        self.pair = (self.a[a_at[ends - 1]] << 32) | self.b[b_at[ends - 1]]
        self.n_links = np.diff(np.searchsorted(ends, self.text_end, "right"), prepend=0)

    def groups(self) -> list[str]:
        """``a1,a2|b1;a3|b2`` of each text."""
        a_in, b_in = (np.bincount(g, minlength=int(self.n_groups.sum())) for g in (self.a_group, self.b_group))
        a_to, b_to = np.cumsum(a_in), np.cumsum(b_in)
        a_last, b_last = (np.append(np.diff(g) > 0, np.ones(min(1, len(g)), bool)) for g in (self.a_group, self.b_group))
        codes = np.empty(len(self.a) + len(self.b), np.int64)
        codes[np.arange(len(self.a)) + (b_to - b_in)[self.a_group]] = self.a * 2 + a_last
        codes[np.arange(len(self.b)) + a_to[self.b_group]] = (self.b + len(self.tool.size[0])) * 2 + b_last
        stops = np.cumsum(self.n_a + self.n_b)
        name = self.tool.names.__getitem__
        return ["".join(map(name, codes[start:stop].tolist()))[:-1] for start, stop in zip([0, *stops[:-1]], stops)]


#: A batch of texts: per text its figures, per (text, pair) the pair's place in the batch's list and its links as narrow
#: numbers, per pair of the batch in how many of its texts it is linked.
STORED = ("batch long, id array<long>, known array<boolean>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, "
          "groups array<string>, n_pairs array<int>, place binary, links binary, pair array<long>, texts array<int>")


def _batches(paths: tuple[str, str], digest: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = aligner(*paths)
        number = TaskContext.get().partitionId() << 32
        for b in batches:
            ids, blocks, texts, size, whole = [], [], [], 0, 0
            for key, text in zip(b.column(0), b.column(1)):
                ids.append(key.as_py())
                texts.append(text.as_py() or "")
                size += len(texts[-1].encode("utf-8"))
                if size > BLOCK or whole + size > BATCH:
                    blocks.append(_block(Batch(tool, texts), digest))
                    texts, size, whole = [], 0, whole + size
                if whole > BATCH:
                    yield _stored(number, ids, blocks)
                    number, ids, blocks, whole = number + 1, [], [], 0
            if texts:
                blocks.append(_block(Batch(tool, texts), digest))
            if blocks:
                yield _stored(number, ids, blocks)
                number += 1
    return run


def _block(x: Batch, digest: bool) -> tuple[list[np.ndarray], list[str]]:
    """Per text the figures and its number of pairs, per (text, pair) the pair and its links; the texts' groups."""
    text = np.repeat(np.arange(len(x.n_links)), x.n_links)
    order = np.lexsort((x.pair, text))
    pair, text = x.pair[order], text[order]
    head = np.flatnonzero(np.append(np.ones(min(1, len(pair)), bool), (pair[1:] != pair[:-1]) | (text[1:] != text[:-1])))
    links = np.diff(np.append(head, len(pair)))
    groups = x.groups()
    if digest:
        groups = [hashlib.sha256(g.encode()).hexdigest() if g else "" for g in groups]
    return [x.n_a, x.n_b, x.n_groups, x.n_links, np.bincount(text[head], minlength=len(x.n_links)), pair[head], links], groups


def _stored(number: int, ids: list, blocks: list[tuple]) -> pa.RecordBatch:
    *figures, n_pairs, pair, links = (np.concatenate(x) for x in zip(*[b for b, _ in blocks]))
    distinct, place, texts = np.unique(pair, return_inverse=True, return_counts=True)
    one = lambda v, kind: pa.array([v], pa.list_(kind))
    columns = [pa.array([number], pa.int64()), one([k or 0 for k in ids], pa.int64()), one([k is not None for k in ids], pa.bool_())]
    columns += [one(v, pa.int64()) for v in figures]
    columns += [one([g for _, groups in blocks for g in groups], pa.string()), one(n_pairs, pa.int32()),
                *(pa.array([_small(v)], pa.binary()) for v in (place, links)), one(distinct, pa.int64()), one(texts, pa.int32())]
    return pa.record_batch(columns, names=[c.split()[0] for c in STORED.split(", ")])


RESULT = ("id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups string")


def _scored(batch: pa.Table, answers: pa.Table) -> pa.Table:
    """The rows of a batch's texts by the answers for its pairs."""
    get = lambda name: batch.column(name)[0].values
    n_pairs = get("n_pairs").to_numpy()
    place, links = (_wide(batch.column(name)[0].as_py(), int(n_pairs.sum())) for name in ("place", "links"))
    order = np.argsort(answers.column("place").to_numpy())
    count, best = (answers.column(name).to_numpy()[order] for name in ("count", "best"))
    stops = np.concatenate([[0], np.cumsum(n_pairs)])
    per_text = [np.concatenate([[0], np.cumsum(v)]) for v in (links * best[place], links * count[place])]
    n_best, total = (v[stops[1:]] - v[stops[:-1]] for v in per_text)
    ids = pa.array(get("id").to_numpy(), pa.int64(), mask=~get("known").to_numpy(zero_copy_only=False))
    return pa.table([ids, *(get(c) for c in ("n_a", "n_b", "n_groups", "n_links")), pa.array(n_best, pa.int64()),
                     pa.array(total, pa.int64()), get("groups")], names=[c.split()[0] for c in RESULT.split(", ")])


def align(docs: DataFrame, paths: tuple[str, str] | None = None, id_col: str = "doc_id", text_col: str = "text",
          digest: bool = False) -> DataFrame:
    """One row per row of ``docs``: its id, ``n_a``, ``n_b`` (tokens of either
    side), ``n_groups``, ``n_links`` (overlapping tokens), ``n_best`` (links
    whose pair's count is the highest of its first id), ``count_sum`` and
    ``groups`` (``a1,a2|b1;a3|b2``, or its SHA-256 with ``digest``). A pair's
    count is the number of rows that hold it linked.

    A text that is null, empty or not given back byte by byte by both
    tokenizers has no tokens: zeros and an empty string. Rows that repeat an id
    count each; null ids stay null; an empty table gives no rows; other
    columns are ignored. A batch has the texts of one task up to 4 MB, or one
    longer text, so no row or group grows with the corpus."""
    with scratch(docs.sparkSession) as s:
        rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
        stored = s.table(rows.mapInArrow(_batches(paths or default_paths(), digest), STORED), "aligned")
        met = stored.select(F.explode(F.arrays_zip("pair", "texts")).alias("x")).select("x.pair", "x.texts")
        counts = s.table(met.groupBy("pair").agg(F.sum("texts").alias("count"))
                         .withColumn("first_id", F.shiftrightunsigned("pair", 32)), "counts")
        highest = counts.groupBy("first_id").agg(F.max("count").alias("highest"))  # a row per id of the vocabulary at most
        judged = counts.join(F.broadcast(highest), "first_id").select(
            "pair", "count", (F.col("count") == F.col("highest")).alias("best"))
        asked = stored.select("batch", F.posexplode("pair").alias("place", "pair"))
        answers = s.table(asked.join(judged, "pair").select("batch", "place", "count", "best"), "answers")
        out = stored.drop("pair", "texts").groupBy("batch").cogroup(answers.groupBy("batch")).applyInArrow(_scored, RESULT)
        return out.withColumnRenamed("id", id_col)

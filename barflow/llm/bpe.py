"""Byte-pair encoding by a queue of merges, and decoding by concatenation.

A unit of text (what the tokenizer's own normaliser and splitter make of it) is a
doubly linked list of symbols. A priority queue holds the merges of neighbours by
rank, then place. The first is taken off, skipped if it is stale (its place was
merged away, or the pair there no longer makes its symbol), else the right
symbol is unlinked and the two new neighbourhoods are queued.

Where a tokenizer parts texts at white space, a text's ids are its words' ids in
a row, and a worker remembers the words it met lately; where it also parts
letters, digits and marks and lowers capitals, it remembers those instead.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barflow.llm.tokens import _ODD, Encoder, default_path

#: Words remembered in each of two generations, the longest one in bytes, and
#: bytes of text (ids, when decoding) handled at once.
REMEMBERED, WORD_BYTES, PART = 200_000, 64, 1 << 20
#: Odd rows (a text of a huge single word) don't fill a batch past this many bytes.
BATCH = 4 << 20
_PLACE = (1 << 40) - 1


class Codec:
    """What a tokenizer file fixes: symbols, merges, special strings, splitting."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        model = file["model"]
        if model["type"] != "BPE" or any(model.get(k) for k in (
                "dropout", "unk_token", "continuing_subword_prefix", "byte_fallback", "ignore_merges")):
            raise ValueError(f"{path}: not a plain byte-pair encoding")
        if any(t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in file["added_tokens"]):
            raise ValueError(f"{path}: added tokens that take in what surrounds them")
        self.decoder = (file["decoder"] or {}).get("type")
        if self.decoder not in (None, "ByteLevel"):
            raise ValueError(f"{path}: decoder {self.decoder}")
        self.vocabulary: dict[str, int] = model["vocab"]
        self.suffix = model.get("end_of_word_suffix") or ""
        self.width = max(self.vocabulary.values()) + 1
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.rank = {self.vocabulary[a] * self.width + self.vocabulary[b]: r for r, (a, b) in enumerate(pairs)}
        self.together = [self.vocabulary[a + b] for a, b in pairs]
        self.special = {t["content"]: t["id"] for t in file["added_tokens"]}
        self.strings: list[str | None] = [None] * (max(self.width, *self.special.values(), 0) + 1)
        for text, i in (self.vocabulary | self.special).items():
            self.strings[i] = text
        self.parted = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) or "(?!)")
        library = Tokenizer.from_file(path)
        self.normalizer, self.splitter = library.normalizer, library.pre_tokenizer
        self.by_word = self._splits()
        self.by_class = self.by_word and self._classes()
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    def units(self, text: str) -> list[str]:
        if self.normalizer:
            text = self.normalizer.normalize_str(text)
        return [u for u, _ in self.splitter.pre_tokenize_str(text)] if self.splitter else [text]

    def _splits(self) -> bool:
        parts = ["One", "two,", "x.y", "it's", "Été", "7a"]
        return all(self.units(f" {a}{gap}{b}\n") == self.units(a) + self.units(b)
                   for a in parts for b in parts for gap in (" ", "\t", "\n", "\x0b", "\x0c", "\r", "  "))

    def _classes(self) -> bool:
        """Whether a plain text's units are its lower-case letters, digits and marks."""
        said = "One two,three... x.y 7a a77 Été_d'ou, (b)c -- 'S 'it's Ärger’s <|x|> Привет, 中文字 한국"
        return self.units(said) == [u for units in Encoder._units(said.encode(), True) for w in units for u in self.units(w.decode())] and all(
            self.units(w) == [self.spelled(w.encode())] for w in ("one", "été", "привет"))

    @staticmethod
    def spelled(word: bytes) -> str:
        """Bytes in the byte-level alphabet."""
        return "".join(map(_letter_of().__getitem__, word))

    def merged(self, unit: str) -> list[int]:
        """The ids of one unit."""
        marked = [*unit[:-1], unit[-1:] + self.suffix] if unit else []
        ids = [i for c in marked if (i := self.vocabulary.get(c)) is not None]
        n, width, rank_of, together = len(ids), self.width, self.rank.get, self.together
        if n < 2:
            return ids
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        # an entry is one number: the rank above, the place of the left symbol below
        queue = [r << 40 | i for i, (a, b) in enumerate(zip(ids, ids[1:])) if (r := rank_of(a * width + b)) is not None]
        heapify(queue)
        while queue:
            entry = heappop(queue)
            rank, i = entry >> 40, entry & _PLACE
            j = after[i]
            if ids[i] < 0 or j < 0:
                continue
            new = together[rank]
            r = rank_of(ids[i] * width + ids[j])
            if r != rank and (r is None or together[r] != new):
                continue
            ids[i], ids[j] = new, -1
            after[i] = k = after[j]
            if k >= 0:
                before[k] = i
                if (r := rank_of(new * width + ids[k])) is not None:
                    heappush(queue, r << 40 | i)
            h = before[i]
            if h >= 0 and (r := rank_of(ids[h] * width + new)) is not None:
                heappush(queue, r << 40 | h)
        return [i for i in ids if i >= 0]

    def _fresh(self, text: str) -> bytes:
        if self.by_class and text.isalpha() and max(text) < "İ" and text.islower():
            return np.array(self.merged(self.spelled(text.encode())), "<u4").tobytes()
        ids: list[int] = []
        at = 0
        for found in self.parted.finditer(text):  # special strings are taken out of the text as it stands
            ids += [i for u in self.units(text[at:found.start()]) for i in self.merged(u)]
            ids.append(self.special[found.group()])
            at = found.end()
        ids += [i for u in self.units(text[at:]) for i in self.merged(u)]
        return np.array(ids, "<u4").tobytes()

    def _known(self, words: list[bytes]) -> list[bytes]:
        missing = set(words).difference(self.young)
        if len(self.young) + len(missing) > REMEMBERED:
            self.old, self.young = self.young, {}
            missing = set(words)
        extra = {}
        for w in missing:
            ids = self.old.get(w) or self._fresh(w.decode("utf-8"))
            (self.young if len(w) <= WORD_BYTES else extra)[w] = ids
        young = self.young
        return [young[w] if w in young else extra[w] for w in words] if extra else list(map(young.__getitem__, words))

    def encode(self, text: str | None) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        text = text or ""
        if not self.by_word:
            return self._fresh(text)
        data, plain = text.encode("utf-8"), self.by_class and (text.isascii() or not _ODD.search(text))
        return b"".join([ids for words in Encoder._units(data, plain) for ids in self._known(words)])

    def forget(self) -> None:
        self.old = {}

    def decode(self, ids: bytes) -> str:
        """The vocabulary strings in a row, unknown ids left out: parted by
        spaces, or, with a byte-level decoder, read as bytes."""
        numbers = np.frombuffer(ids, "<u4")
        strings, size = self.strings, len(self.strings)
        said = (s for at in range(0, len(numbers), PART) for i in numbers[at:at + PART].tolist()
                if i < size and (s := strings[i]) is not None)
        if self.decoder is None:
            return " ".join(said)
        table = _byte_of()
        return b"".join(bytes(table[c] for c in s) if all(c in table for c in s) else s.encode() for s in said).decode("utf-8", "replace")


@lru_cache(maxsize=1)
def _byte_of() -> dict[str, int]:
    """The byte each letter of the byte-level alphabet stands for: printable
    bytes stand for themselves, the others are numbered from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


@lru_cache(maxsize=1)
def _letter_of() -> list[str]:
    return [c for _, c in sorted((b, c) for c, b in _byte_of().items())]


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    return Codec(path)


def _sized(rows: Iterable[tuple[int, object]]) -> Iterator[list[tuple[int, object]]]:
    """Runs of ``(row, value)`` whose values have about ``BATCH`` bytes."""
    held, size = [], 0
    for at, value in rows:
        held.append((at, value))
        size += len(value)
        if size > BATCH:
            yield held
            held, size = [], 0
    if held:
        yield held


def _column(name: str, kind: pa.DataType, work):
    """Each batch's first column turned into a last column ``name``; the others follow along."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = None
        for b in batches:
            tool = tool or work()
            rest = pa.RecordBatch.from_arrays(b.columns[1:], names=b.schema.names[1:])
            for part in _sized((i, tool[0](v.as_py())) for i, v in enumerate(b.column(0))):
                yield rest.slice(part[0][0], len(part)).append_column(name, pa.array([v for _, v in part], kind))
        if tool:
            tool[1]()
    return run


def encode(docs: DataFrame, path: str | None = None, text_col: str = "text", to: str = "ids") -> DataFrame:
    """``docs`` with its text column replaced by ``to``, the ids as binary
    (little-endian unsigned 32-bit integers), as the tokenizer at ``path`` gives
    them without adding special tokens; special strings in a text are found.

    A null or empty text has no ids; rows may repeat; other columns are kept; an
    empty table gives no rows. Long texts are encoded part by part, whole."""
    path = path or default_path()
    rest = [c for c in docs.columns if c not in (text_col, to)]

    def work():
        return codec(path).encode, codec(path).forget
    rows = docs.select(F.col(text_col).cast("string"), *rest)
    schema = docs.select(*rest, F.lit(b"").alias(to)).schema
    return rows.mapInArrow(_column(to, pa.binary(), work), schema)


def decode(rows: DataFrame, path: str | None = None, ids_col: str = "ids", to: str = "decoded") -> DataFrame:
    """``rows`` and a column ``to``: the text of the ids; null ids give an empty text."""
    path = path or default_path()
    rest = [c for c in rows.columns if c != to]

    def work():
        return (lambda ids: codec(path).decode(ids or b"")), (lambda: None)
    schema = rows.select(*rest, F.lit("").alias(to)).schema
    return rows.select(F.col(ids_col).alias("_ids"), *rest).mapInArrow(_column(to, pa.string(), work), schema)

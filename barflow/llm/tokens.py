"""Token ids of texts with a public tokenizer, one word at a time.

A tokenizer that drops white space and never looks across it gives a text's ids
as its words' ids in a row, and words recur. So ids are looked up per word, and
the library encodes only words it has not met lately. A tokenizer without that
property encodes whole texts.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np

#: Words a worker remembers, in each of two generations.
REMEMBERED = 250_000
#: Words encoded at once, and bytes of text looked up at once.
_CHUNK, _PART = 2_000, 1 << 20
#: Runs of letters, single digits, runs of marks, in texts that have beyond ASCII only letters which stay one letter
#: when normalised and lowered (Latin, Cyrillic, Han, Hangul).
_UNITS = re.compile(rb"[A-Za-z\x80-\xff]+|[0-9]|[^A-Za-z0-9\x80-\xff\x20\x09-\x0D]+")
#: Texts of letters, blanks, and points and commas that stand alone.
_PROSE = bytes(range(65, 91)) + bytes(range(97, 123)) + bytes(range(128, 256)) + b" \t\n\x0b\x0c\r.,"
_PAIRS = (b"..", b",,", b".,", b",.")
_ODD = re.compile("[^\\x00-\\x7fªµºÀ-ÖØ-öø-įı-ɏЀ-ҁ一-龥가-힣]")


def default_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


#: Stands for the ids of a word that isn't known yet (ids have four bytes each).
_UNKNOWN = b"?"


class _Words(dict):
    """Ids by word. A word met before the last change of generations comes over from ``old``; one
    that isn't known is noted in ``missing``."""

    def __init__(self, old: dict[bytes, bytes]):
        super().__init__()
        self.old, self.missing = old, []

    def __missing__(self, word: bytes) -> bytes:
        ids = self.old.get(word)
        if ids is None:
            self.missing.append(word)
            return _UNKNOWN
        self[word] = ids
        return ids


class Encoder:
    """``encode`` gives ids as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.size = self.tokenizer.get_vocab_size()
        vocab = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        self.ends[[i for t, i in vocab.items() if t.endswith("</w>")]] = True
        self.by_word = self._splits()
        self.model = self.tokenizer.model
        self.direct = self._plainly()
        self.young = _Words({})

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _splits(self) -> bool:
        parts = ["One", "two,", "x.y", "it's", "Été", "7a"]
        return bool(self.ends.any()) and all(
            self._ids(f" {a}{gap}{b}\n") == self._ids(a) + self._ids(b)
            for a in parts for b in parts for gap in (" ", "\t", "\n", "\x0b", "\x0c", "\r", "  "))

    def _plainly(self) -> bool:
        """Whether the model by itself has the ids of a word of a to z."""
        words = ["a", "one", "zebra", "xqzjkv", "indistinguishable", "abcdefghijklmnopqrstuvwxyz"]
        return self.by_word and all(self._word(w) == np.array(self._ids(w), "<u4").tobytes() for w in words)

    def _word(self, word: str) -> bytes:
        ids = [t.id for t in self.model.tokenize(word)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def encode(self, text: str | None) -> bytes:
        return next(self.encode_all([text]))

    def encode_all(self, texts: Iterable[str | None]) -> Iterator[bytes]:
        """The ids of each text, in order."""
        if not self.by_word:
            for t in texts:
                yield np.array(self._ids(t or ""), "<u4").tobytes()
            return
        held: list[list[tuple[list[bytes], list[bytes]] | bytes]] = []
        size = 0
        for t in texts:
            data = (t or "").encode("utf-8", "replace")
            plain = not t or t.isascii() or not _ODD.search(t)
            if len(data) > _PART:  # alone, and part by part
                yield from self._completed(held)
                held, size = [], 0
                yield b"".join(x for units in self._units(data, plain) for x in self._completed([[self._looked_up(units)]]))
                continue
            held.append([self._looked_up(units) for units in self._units(data, plain)])
            size += len(data)
            if size > _PART:
                yield from self._completed(held)
                held, size = [], 0
        yield from self._completed(held)

    def forget(self) -> None:
        """Drop the older generation of words: workers outlive their tasks."""
        self.young.old = {}

    def _looked_up(self, units: list[bytes]) -> bytes | tuple[list[bytes], list[bytes]]:
        """The units' ids; the units and the ids of each, if one isn't known yet."""
        before = len(self.young.missing)
        ids = list(map(self.young.__getitem__, units))
        return b"".join(ids) if len(self.young.missing) == before else (units, ids)

    def _completed(self, held: list[list[bytes | tuple[list[bytes], list[bytes]]]]) -> Iterator[bytes]:
        """The ids of each text; the words that were missing are encoded together."""
        missing = list(dict.fromkeys(self.young.missing))
        if len(self.young) + len(missing) > REMEMBERED:
            self.young = _Words(dict(self.young))
        self.young.missing = []
        self.young.update(self._encode_words(missing))
        ids_of = self.young.__getitem__
        for text in held:
            for k, part in enumerate(text):
                if isinstance(part, tuple):
                    units, ids = part
                    at = -1
                    for _ in range(ids.count(_UNKNOWN)):
                        at = ids.index(_UNKNOWN, at + 1)
                        ids[at] = ids_of(units[at])
                    text[k] = b"".join(ids)
            yield b"".join(text)

    @staticmethod
    def _units(data: bytes, plain: bool) -> Iterator[list[bytes]]:
        """What is looked up: letters, digits and marks apart, as the tokenizer
        parts them; it lowers capitals too. A word with an apostrophe (part of
        some units) or the beginning of a control string stays whole, and so
        does any word of a text that isn't ``plain``."""
        if not plain:
            words = data.split()
            for at in range(0, len(words), 1 << 16):
                yield words[at:at + (1 << 16)]
            return
        if b"'" not in data and b"<|" not in data:
            if len(data) < _PART:
                if data.translate(None, _PROSE) or any(pair in data for pair in _PAIRS):
                    yield _UNITS.findall(data.lower())
                else:  # the same units, found faster
                    yield data.lower().replace(b".", b" . ").replace(b",", b" , ").split()
                return
            words = data.split()
            for at in range(0, len(words), 1 << 16):
                yield _UNITS.findall(b" ".join(words[at:at + (1 << 16)]).lower())
            return
        words = data.split()
        for at in range(0, len(words), 1 << 16):
            yield [u for w in words[at:at + (1 << 16)]
                   for u in ((w,) if b"'" in w or b"<|" in w else _UNITS.findall(w.lower()))]

    def _encode_words(self, words: list[bytes]) -> dict[bytes, bytes]:
        """Letters below U+0130 make one unit each. Words of a to z go to the model as they are, if it
        allows that; other such words are encoded in a row and parted at the ids that end a unit. All
        others go one by one."""
        out: dict[bytes, bytes] = {}
        texts = {w: w.decode("utf-8", "replace") for w in words}
        row = [w for w, t in texts.items() if t.isalpha() and (t.isascii() or max(t) < "İ")]
        if self.direct:
            out.update((w, self._word(texts[w])) for w in row if w.isascii() and w.islower())
            row = [w for w in row if w not in out]
        for at in range(0, len(row), _CHUNK):
            part = row[at:at + _CHUNK]
            whole = self.tokenizer.encode_batch_fast([" ".join(texts[w] for w in part)], add_special_tokens=False)
            ids = np.array(whole[0].ids, "<u4")
            ends = np.flatnonzero(self.ends[ids]) + 1
            if len(ends) == len(part):
                data, stops = ids.tobytes(), (ends * 4).tolist()
                out.update(zip(part, (data[a:b] for a, b in zip([0, *stops], stops))))
        rest = [w for w in words if w not in out]
        for at in range(0, len(rest), _CHUNK):
            part = rest[at:at + _CHUNK]
            for w, e in zip(part, self.tokenizer.encode_batch_fast([texts[w] for w in part], add_special_tokens=False)):
                out[w] = np.array(e.ids, "<u4").tobytes()
        return out


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """The worker's encoder; Spark's Python workers keep it from task to task."""
    import os
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    return Encoder(path)

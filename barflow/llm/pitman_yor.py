"""Hierarchical Pitman-Yor language model, trained and applied by Spark.

Restaurants: one for all words, and one for every context (the word before)
seen in training. A customer is a token; the tables that a word has in a context
restaurant are customers of the common parent. The parent's base is diffuse:
each known word has one table there, and what a new table would get goes to the
one event "unknown word". A context that training never saw passes everything
to the parent.

Seating is sampled by Gibbs sweeps. Given the numbers of tables per context and
the customers per word in the parent, a sweep draws the number of tables of each
pair of word and context from its conditional distribution. A pair seen once
always has one table, so only the others are swept. Predictive probabilities are
averaged over sweeps.

Texts are read in groups of bounded size. Groups, buckets of pairs (a part of all
words with a part of all contexts) and shards of words are the keys of shuffles;
what they send each other is packed: codes, then narrow numbers. A group sends
its pairs and words once, in the order of code; the answers are numbers in the
same order, without codes. In a sweep, buckets send sums per word and context to
the shards, and get customers and tables back. So no table has a row per pair.
"""

from __future__ import annotations

import math
import zlib
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barflow.llm.common import NULL_ID, Scratch, row_id, scratch
from barflow.llm.rolling import mix, word_bounds, word_codes

#: Sweeps that are thrown away, and sweeps whose predictions are averaged.
BURN_IN, SAMPLES = 1, 2
#: Strengths of the context restaurants and of their parent.
STRENGTH, PARENT_STRENGTH = 1.0, 1.0
#: Text scored by one task at a time.
GROUP_BYTES = 16 << 20
#: Groups are scored in so many turns: the texts and answers of one turn are shuffled at a time.
TURNS = 6
#: Up to so many customers of one word in one context the conditional is taken from a table of seatings, above from an integral.
EXACT = 1024
#: The integral: nodes on half of its path, and how near to zero this comes at least. Numbers of a draw at a time.
NODES, NEAREST, CELLS = 40, 6.5, 1 << 18
#: Pairs whose tables are drawn at once.
CHUNK = 1 << 15
#: Code of the end of a text, and of the place before its first word.
END = np.uint64(0x5851F42D4C957F2D)


def _codes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The codes of the texts' words, ASCII capitals lowered, each text with its end; and how many codes each has."""
    codes, sizes = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    ends = np.cumsum([len(x) + 1 for x in texts])
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + (1 << 20), "right")))
        text = np.frombuffer(b" ".join(texts[at:to]).lower(), np.uint8)
        start, stop = word_bounds(text)
        n = np.diff(np.searchsorted(start, ends[at:to] - (ends[at - 1] if at else 0)), prepend=0)
        out = np.full(len(start) + len(n), END)
        out[np.arange(len(start)) + np.repeat(np.arange(len(n)), n)] = word_codes(text, start, stop)
        codes.append(out)
        sizes.append(n + 1)
        at = to
    return np.concatenate(codes), np.concatenate(sizes)


def held_out(doc_id) -> bool:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 10 == 0


def _binary(column) -> list[bytes]:
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def _heads(*ascending: np.ndarray) -> np.ndarray:
    """Where a run of equal values begins."""
    new = np.ones(len(ascending[0]), bool)
    new[1:] = np.logical_or.reduce([x[1:] != x[:-1] for x in ascending])
    return np.flatnonzero(new)


def _order(x: np.ndarray, top: int) -> np.ndarray:
    """The order of numbers below ``top``, equal ones as they stand (numbers that hold their place are sorted faster)."""
    bits = len(x).bit_length()
    if top << bits < 1 << 63:
        return np.sort(x << bits | np.arange(len(x))) & ((1 << bits) - 1)
    return np.argsort(x, kind="stable")


def _shard(codes: np.ndarray, shards: int) -> np.ndarray:
    """The shard of a word; it ascends with the code."""
    return ((codes >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)


def _small(x: np.ndarray) -> bytes:
    """Numbers from zero on in the narrowest type that holds them all."""
    top = int(x.max()) if len(x) else 0
    return x.astype(next(k for k in ("u1", "<u2", "<u4", "<u8") if top < 256 ** np.dtype(k).itemsize)).tobytes()


def _wide(data: bytes, n: int) -> np.ndarray:
    return np.frombuffer(data, f"<u{len(data) // n}").astype(np.int64) if n else np.zeros(0, np.int64)


def _thin(x: np.ndarray) -> bytes:
    """Numbers from zero on, mostly small: a byte each, and after these the numbers of 255 and more."""
    return np.minimum(x, 255).astype(np.uint8).tobytes() + x[x >= 255].astype("<i8").tobytes()


def _thick(data: bytes, n: int) -> np.ndarray:
    out = np.frombuffer(data, np.uint8, n).astype(np.int64)
    out[out == 255] = np.frombuffer(data, "<i8", offset=n)
    return out


def _pack(w: np.ndarray, u: np.ndarray, c: np.ndarray, t: np.ndarray) -> list[bytes]:
    """Pairs ordered by word: the words, the number of pairs of each, the contexts (each once, if that is shorter, and then
    the place of each pair's), and two numbers a pair."""
    head = _heads(w)
    context, place = np.unique(u, return_inverse=True)
    place = _small(place)
    if 8 * len(context) + len(place) >= 8 * len(u):
        context, place = u, b""
    return [w[head].astype("<u8").tobytes(), _thin(np.diff(np.append(head, len(w)))), context.astype("<u8").tobytes(), place, _thin(c), _thin(t)]


def _places(words: bytes, n: bytes, contexts: bytes, place: bytes) -> tuple[np.ndarray, ...]:
    """The words, the contexts, and the places of each pair's word and context among them."""
    words, contexts = np.frombuffer(words, "<u8"), np.frombuffer(contexts, "<u8")
    w = np.repeat(np.arange(len(words)), _thick(n, len(words)))
    return words, contexts, w, _wide(place, len(w)) if place else np.arange(len(w))


def _unpack(words: bytes, n: bytes, contexts: bytes, place: bytes, c: bytes, t: bytes) -> tuple[np.ndarray, ...]:
    words, contexts, w, u = _places(words, n, contexts, place)
    return words[w], contexts[u], _thick(c, len(w)), _thick(t, len(w))


#: What groups of texts, buckets of pairs and shards of words send to ``key``: a bucket, or a shard after all buckets (answers: a group).
_SENT = "key long, kind int, peer long, stats array<long>, parts array<binary>"
_KINDS = [pa.int64(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.binary())]
#: Pairs and words of a group; a bucket's pairs seen often, and what groups may ask of all its pairs; a shard's words; seats less
#: tables of a bucket's words or contexts; the answers, customers or tables; a shard's customers and tables; a bucket's tables.
PAIRS, WORDS, OFTEN, TOLD, KNOWN, SUMS, REPLY, VALUES, TABLES = range(9)


def _sent(rows: list[tuple]) -> pa.Table:
    columns = zip(*rows) if rows else [[] for _ in _KINDS]
    return pa.table([pa.array(list(x), kind) for x, kind in zip(columns, _KINDS)], names=[x.split()[0] for x in _SENT.split(", ")])


def _received(table: pa.Table) -> dict[int, list[tuple]]:
    """The rows ``(peer, stats, parts)`` of each kind, by peer."""
    out: dict[int, list[tuple]] = {k: [] for k in range(TABLES + 1)}
    for kind, *row in zip(*(table.column(k).to_pylist() for k in ("kind", "peer", "stats", "parts"))):
        out[kind].append(tuple(row))
    return {k: sorted(x, key=lambda r: r[0]) for k, x in out.items()}


class Tokens:
    """The words and pairs of a group's texts. Pairs are in the order of their buckets, then of word and context; a bucket
    holds the pairs of a ``side``-th part of all words with such a part of all contexts."""

    def __init__(self, texts: list[bytes], side: int):
        codes, self.sizes = _codes(texts)
        found = pa.array(codes).dictionary_encode()
        words = np.asarray(found.dictionary)
        order = np.argsort(words)
        self.words, rank = words[order], np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        self.word = rank[np.asarray(found.indices)]
        # before a text's first word stands the end of the text before
        self.context = np.append(np.searchsorted(self.words, END), self.word[:-1])
        part = _shard(self.words, side * side) // side
        self.side, self.first = side, np.searchsorted(part, np.arange(side))
        place = np.arange(len(part)) - self.first[part]
        self.top = int(place.max()) + 1
        self.key = ((part * side * self.top + place) * self.top)[self.word] + (part * self.top ** 2 + place)[self.context]

    def split(self, key: np.ndarray) -> tuple[np.ndarray, ...]:
        """The bucket, word and context of each key."""
        rest, context = np.divmod(key, self.top)
        bucket, word = np.divmod(rest, self.top)
        return bucket, self.first[bucket // self.side] + word, self.first[bucket % self.side] + context


def _ask(side: int):
    """Per bucket the group's pairs of word and context, with their counts in training texts and whether held-out texts have
    them; per shard its words with their counts in training texts."""
    def run(key, table):
        x = Tokens(_binary(table.column("text")), side)
        held = np.repeat(np.asarray(table.column("held_out")), x.sizes)
        count = np.bincount(x.word[~held], minlength=len(x.words))
        pairs = np.sort(x.key << 1 | held)
        head = _heads(pairs >> 1)
        bucket, w, u = x.split(pairs[head] >> 1)
        c, out = np.add.reduceat(1 - (pairs & 1), head), pairs[np.append(head[1:], len(pairs)) - 1] & 1
        cut, group, rows = [*_heads(bucket).tolist(), len(bucket)], key[0].as_py(), []
        for a, b in zip(cut, cut[1:]):
            rows.append((int(bucket[a]), PAIRS, group, [], _pack(x.words[w[a:b]], x.words[u[a:b]], c[a:b], out[a:b])))
        shard = _shard(x.words, side * side)
        cut = [*_heads(shard).tolist(), len(shard)]
        for a, b in zip(cut, cut[1:]):
            rows.append((side * side + int(shard[a]), WORDS, group, [], [x.words[a:b].astype("<u8").tobytes(), _thin(count[a:b])]))
        return _sent(rows)
    return run


def _all(parts: list[np.ndarray], kind=np.int64) -> np.ndarray:
    return np.concatenate([np.zeros(0, kind), *parts])


def _merge(buckets: int):
    """What all groups know of a bucket's pairs or a shard's words: counts, and the groups that have them."""
    def run(key, table):
        key, got = key[0].as_py(), _received(table)
        return _sent(_merge_words(key, got[WORDS]) if key >= buckets else _merge_pairs(key, got[PAIRS], buckets))
    return run


def _merge_words(key: int, got: list[tuple]) -> list[tuple]:
    codes = [np.frombuffer(parts[0], "<u8") for _, _, parts in got]
    words = np.unique(_all(codes, np.uint64))
    at = np.searchsorted(words, _all(codes, np.uint64))
    order = _order(at, len(words))
    head = _heads(at[order])
    asker = np.repeat([g for g, _, _ in got], [len(x) for x in codes])[order]
    c = np.add.reduceat(_all([_thick(parts[1], len(x)) for x, (_, _, parts) in zip(codes, got)])[order], head)
    stats = [int(c.sum()), *(int(np.count_nonzero(x)) for x in (c, c == 1, c == 2))]
    return [(key, KNOWN, 0, stats, [words.tobytes(), _thin(c), _thin(np.diff(np.append(head, len(at)))), _small(asker)])]


def _merge_pairs(key: int, got: list[tuple], buckets: int) -> list[tuple]:
    rows = [_places(*parts[:4]) for _, _, parts in got]
    words, contexts = (np.unique(_all([r[k] for r in rows], np.uint64)) for k in (0, 1))
    place = _all([np.searchsorted(words, r[0])[r[2]] * len(contexts) + np.searchsorted(contexts, r[1])[r[3]] for r in rows])
    size = [len(r[2]) for r in rows]
    c = _all([_thick(parts[4], n) for n, (_, _, parts) in zip(size, got)])
    del rows
    order = _order(place, len(words) * len(contexts))
    place = place[order]
    head = _heads(place)
    c = np.add.reduceat(c[order], head)
    asker = np.repeat([g for g, _, _ in got], size)[order]
    often = c > 1
    out = [(key, TOLD, 0, [int((c == 1).sum()), int((c == 2).sum()), len(c)], [_thin(c), _thin(np.diff(np.append(head, len(place)))), _small(asker)])]
    if often.any():
        w, u = np.divmod(place[head[often]], len(contexts))
        *pack, n, _ = _pack(words[w], contexts[u], c[often], c[often])
        out.append((key, OFTEN, 0, [], [*pack, n]))
        out += _sums(key, *_places(*pack), c[often] - 1, buckets)
    return out


def _sums(key: int, words, contexts, w, u, less: np.ndarray, buckets: int) -> list[tuple]:
    """To the shards: by how much the tables of each word and each context are fewer than its seats."""
    out = []
    for side, (codes, place) in enumerate(((words, w), (contexts, u))):
        if side:
            codes, at = np.unique(codes, return_inverse=True)
            place = at[place]
        total = np.bincount(place, less, len(codes)).astype(np.int64)
        shard = _shard(codes, buckets)
        cut = [*_heads(shard).tolist(), len(shard)]
        out += [(buckets + int(shard[a]), SUMS, key, [side], [codes[a:b].astype("<u8").tobytes(), _thin(total[a:b])]) for a, b in zip(cut, cut[1:])]
    return out


def _seat(number: int):
    """A shard's customers in the parent (each pair seen once has one table, so they are the word's seats less what the buckets
    tell) and its tables as contexts. A word follows one word and is followed by one, the end by the place before the first:
    a word's count is its seats as a context too."""
    def run(key, table):
        key, got = key[0].as_py(), _received(table)
        (_, _, parts), = got[KNOWN]
        words = np.frombuffer(parts[0], "<u8")
        count = _thick(parts[1], len(words))
        now, places = [count.copy(), count.copy()], []
        for bucket, (side,), (codes, less) in got[SUMS]:
            at = np.searchsorted(words, np.frombuffer(codes, "<u8"))
            now[side][at] -= _thick(less, len(at))
            places.append((bucket, side, at))
        rows = [(bucket, REPLY, key, [side, len(at)], [_thin(now[side][at])]) for bucket, side, at in places]
        return _sent([*rows, (key, VALUES, number, [int(now[0].sum())], [_thin(x) for x in now])])
    return run


def _answer(buckets: int):
    """Per group what is known of its pairs in this bucket, or of its words in this shard, in the group's order."""
    def run(key, table):
        key, got = key[0].as_py(), _received(table)
        (_, _, parts), = got[KNOWN] or got[TOLD]
        if key >= buckets:
            n = len(parts[0]) // 8
            values = [_thick(parts[1], n), *(_thick(x, n) for k in range(2) for _, _, y in got[VALUES] for x in y[k:k + 1])]
            parts = parts[2:]
        else:
            n = len(parts[0]) - 8 * parts[0].count(b"\xff") if False else got[TOLD][0][1][2]
            c = _thick(parts[0], n)
            t = np.full(n, SAMPLES, np.int64)
            if (c > 1).any():
                t[c > 1] = _thick(got[TABLES][0][2][1], int((c > 1).sum()))
            values, parts = [c, t], parts[1:]
        size = _thick(parts[0], n)
        asker = _wide(parts[1], int(size.sum()))
        order = _order(asker, int(asker.max(initial=0)) + 1)
        row, asker = np.repeat(np.arange(n), size)[order], asker[order]
        cut = [*_heads(asker).tolist(), len(asker)]
        return _sent([(int(asker[a]), TOLD, key, [b - a], [_thin(x[row[a:b]]) for x in values]) for a, b in zip(cut, cut[1:])])
    return run


def _find(sorted_codes: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Place of each code, or -1."""
    if not len(sorted_codes):
        return np.full(len(codes), -1, np.int64)
    at = np.minimum(np.searchsorted(sorted_codes, codes), len(sorted_codes) - 1)
    return np.where(sorted_codes[at] == codes, at, -1)


@lru_cache(maxsize=1)
def _stirling(discount: float) -> np.ndarray:
    """log S(c, t): seatings of c customers at t tables, weighted by their discounts."""
    s = np.full((EXACT + 1, EXACT + 1), -np.inf)
    s[1, 1] = 0.0
    for c in range(1, EXACT):
        t = np.arange(1, c + 2)
        with np.errstate(divide="ignore", invalid="ignore"):
            stay = s[c, 1:c + 2] + np.log(np.maximum(c - discount * t, 1e-300))
        s[c + 1, 1:c + 2] = np.logaddexp(s[c, 0:c + 1], stay)
    return s


def _log_gamma(x: np.ndarray) -> np.ndarray:
    y = x + 8
    z = 1 / (y * y)
    below = np.log(np.multiply.reduce([x + k for k in range(8)]))
    return (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + (1 / 12 - z * (1 / 360 - z * (1 / 1260 - z / 1680))) / y - below


@np.errstate(divide="ignore", over="ignore", invalid="ignore")
def _log_sums(c: np.ndarray, t: np.ndarray, discount: float) -> np.ndarray:
    """log of S(c, t) t! discount**t / c!, which is the coefficient of x**c in (1 - (1 - x)**discount)**t, for t < c. With
    x = exp(-s / c) it is an integral of exp(s) around the negative numbers, taken along a parabola through the saddle point
    (to 1e-7 and better)."""
    low, end = np.log(NEAREST / c), np.full(len(c), np.log(60.0))

    def rising(log_w):
        w = np.exp(log_w)
        return c >= t * discount * np.exp(-w) * (-np.expm1(-w)) ** (discount - 1) / -np.expm1(discount * np.log1p(-np.exp(-w)))
    least, most = low, end
    for _ in range(24):
        middle = (least + most) / 2
        up = rising(middle)
        least, most = np.where(up, least, middle), np.where(up, middle, most)
    at = np.where(rising(low), NEAREST, c * np.exp((least + most) / 2))

    def along(u):
        """s, and the log of the power, as real and imaginary parts."""
        real, imag = at * (1 - u * u), 2 * at * u
        x = np.exp(-real / c)
        re, im = -np.expm1(-real / c) + 2 * x * np.sin(imag / (2 * c)) ** 2, x * np.sin(imag / c)
        log, turn = discount / 2 * np.log(re * re + im * im), discount * np.arctan2(im, re)
        if (far := x < 0.5).any():
            log = np.where(far, discount / 2 * np.log1p(x * x - 2 * x * np.cos(imag / c)), log)
        size = np.exp(log)
        re, im = size * np.cos(turn), -size * np.sin(turn)
        less, re = size * size - 2 * re, 1 - re
        if far.any():
            re = np.where(far, -np.expm1(log) + 2 * size * np.sin(turn / 2) ** 2, re)
        log = np.where(far, np.log(re * re + im * im), np.log1p(np.where(far, 0, less)))
        return real, imag, t / 2 * log, t * np.arctan2(im, re)
    start = along(np.zeros(len(c)))[2]
    least, most = -np.log(at) / 2, np.log(np.minimum(40, np.pi * c / (2 * at)))
    for _ in range(8):  # the place on the path where it has fallen by exp(-32)
        middle = (least + most) / 2
        real, _, log, _ = along(np.exp(middle))
        up = real + log < at + start - 32
        least, most = np.where(up, least, middle), np.where(up, middle, most)
    step = np.exp(most) / NODES
    less, whole = start > -1, np.zeros(len(c))  # one less everywhere has the same integral
    for k in range(NODES):
        u = (k + 0.5) * step
        real, imag, log, turn = along(u)
        log, off = np.where(less, np.minimum(log, 32), log - start), np.where(less, np.exp(real - at), 0)
        size, turn = np.exp(real - at + log), imag + turn
        re, im = size * np.cos(turn) - off * np.cos(imag), size * np.sin(turn) - off * np.sin(imag)
        whole += re - u * im
    out, near = np.log(whole * step * 2 * at / (np.pi * c)) + at + np.where(less, 0, start), c - t <= 16
    if near.any():  # along a line, by which the whole circle is run through
        n, m, w = c[near], t[near], (at / c)[near] + 1j * np.pi * (np.arange(64)[:, None] + 0.5) / 64
        x = np.exp(-w)
        log = np.log1p(np.abs(x) ** 2 - 2 * x.real) / 2 + 1j * np.arctan2(-x.imag, 1 - x.real)
        power = m * np.log(-np.expm1(discount * log))
        top = at[near] + power[0].real
        out[near] = np.log(np.exp(n * w + power - top).real.mean(0)) + top
    return out


def _log_chances(c: np.ndarray, t: np.ndarray, others, above, total, discount, parent_discount) -> np.ndarray:
    """log of the conditional probability of t tables, but for a number of each pair."""
    cells, place = np.unique((c << 32) | t, return_inverse=True)
    a, b = (cells >> 32).astype(float), (cells & 0xFFFFFFFF).astype(float)
    sums = np.empty(len(cells))
    for k in range(0, len(cells), 1 << 13):
        part = slice(k, k + (1 << 13))
        full = b[part] == a[part]  # each customer at a table
        sums[part] = np.where(full, a[part] * math.log(discount), _log_sums(a[part], np.where(full, 1, b[part]), discount))
    sums -= _log_gamma(b + 1) + b * math.log(PARENT_STRENGTH + total)
    return sums[place] + _log_gamma(STRENGTH / discount + others + t) + _log_gamma(above + t - parent_discount)


def _draw_often(c, others, above, total, discount, parent_discount, uniform) -> np.ndarray:
    """Numbers of tables for pairs of any number of customers: probabilities of all numbers around the likeliest, out to
    where they are below exp(-28) of it on both sides."""
    t, seated = np.ones(len(c)), np.ones(len(c))
    while (seated < c).any():  # about as many as will be likely
        to = np.minimum(2 * seated, c)
        a = (STRENGTH + discount * (others + t)) * np.maximum(above + t - parent_discount, 1 - parent_discount) / (PARENT_STRENGTH + total)
        t = np.clip(t + a * np.log((a + to) / (a + seated)), 1, to)
        seated = to
    few = np.ones(len(c))
    for _ in range(20):  # by the discount, large tables make others less likely than one customer after the other would
        few = np.minimum(t, np.maximum(1, (STRENGTH + discount * (others + few)) * (above + few) / (PARENT_STRENGTH + total) / discount))
    t = few

    def chances(rows, t):
        return _log_chances(c[rows], t, others[rows], above[rows], total, discount, parent_discount)
    every = np.arange(len(c))
    start = np.rint(t).astype(np.int64)
    best, edges = chances(every, start), []
    for way in (-1, 1):
        edge, rows, step = start.copy(), every, 1
        while len(rows := rows[edge[rows] != (1 if way < 0 else c[rows])]):
            edge[rows] = np.clip(start[rows] + way * step, 1, c[rows])
            now = chances(rows, edge[rows])
            best[rows], step = np.maximum(best[rows], now), 2 * step
            rows = rows[now > best[rows] - 28]
        edges.append(edge)
    low, n = edges[0], edges[1] - edges[0] + 1
    out, cut = np.empty(len(c), np.int64), 0
    ends = np.cumsum(n)
    while cut < len(c):
        to = max(cut + 1, int(np.searchsorted(ends, ends[cut] - n[cut] + CELLS, "right")))
        row = np.repeat(np.arange(cut, to), n[cut:to])
        first = ends[cut:to] - n[cut:to] - (ends[cut] - n[cut])
        log = chances(row, low[row] + np.arange(len(row)) - np.repeat(first, n[cut:to]))
        weight = np.exp(log - np.repeat(np.maximum.reduceat(log, first), n[cut:to]))
        upto, whole = np.cumsum(weight), np.add.reduceat(weight, first)
        before = upto[first] - weight[first]
        out[cut:to] = low[cut:to] + np.add.reduceat(upto - np.repeat(before, n[cut:to]) < np.repeat(uniform[cut:to] * whole, n[cut:to]), first, dtype=np.int64)
        cut = to
    return np.minimum(out, edges[1])


def _uniform(word: np.ndarray, context: np.ndarray, salt: int) -> np.ndarray:
    """Random numbers as a function of word, context and salt: a retried task draws the same."""
    h = mix(mix(word ^ np.uint64(salt) * np.uint64(0xD1342543DE82EF95)) + context.astype(np.uint64))
    return (h >> np.uint64(11)).astype(np.float64) / float(1 << 53)


def draw_tables(word, context, c, t, tables, customers, total, discount, parent_discount, stirling, salt):
    """New numbers of tables for pairs with ``c`` customers at ``t`` tables: the
    context has ``tables`` in all, the word ``customers`` in the parent, which
    has ``total``. Drawn from the conditional given everything else, whatever the
    number of customers: up to ``EXACT`` by the table of seatings, above by
    :func:`_draw_often`."""
    new = np.ones(len(c), np.int64)
    uniform = _uniform(word, context, salt)
    others, above = (tables - t).astype(float), (customers - t).astype(float)
    first = np.minimum(c, EXACT + 1).astype(np.uint16)
    order = np.argsort(first, kind="stable")
    cut = np.searchsorted(first[order], np.arange(2, EXACT + 2))
    for n, a, b in zip(range(2, EXACT + 1), cut, cut[1:]):
        for rows in (order[k:min(b, k + 1 + CELLS // n)] for k in range(a, b, 1 + CELLS // n)):
            j = np.arange(n)
            own = STRENGTH + discount * (others[rows, None] + j)
            parent = np.maximum(above[rows, None] + j - parent_discount, 1 - parent_discount) / (PARENT_STRENGTH + total)
            weight = stirling[n, 1:n + 1] + np.cumsum(np.log(own * parent), 1)
            weight = np.cumsum(np.exp(weight - weight.max(1, keepdims=True)), 1)
            new[rows] = 1 + (weight < uniform[rows, None] * weight[:, -1:]).sum(1)
    if len(rows := order[cut[-1]:]):
        new[rows] = _draw_often(c[rows], others[rows], above[rows], total, discount, parent_discount, uniform[rows])
    return new


def _sweep(model: dict, number: int, buckets: int):
    """One Gibbs sweep over a bucket's pairs with the tables of their contexts and the customers of their words; after the
    burn-in, tables are summed."""
    def run(key, table):
        key, got, stirling = key[0].as_py(), _received(table), _stirling(model["discount"])
        (_, _, parts), = got[OFTEN]
        words, contexts, w, u = _places(*parts[:4])
        c = _thick(parts[4], len(w))
        t, tsum = (_thick(x, len(w)) for x in got[TABLES][0][2]) if got[TABLES] else (np.ones(len(w), np.int64), np.zeros(len(w), np.int64))
        customers, tables = (_all([_thick(parts[0], n) for _, (k, n), parts in got[REPLY] if k == side]) for side in range(2))
        tables = tables[np.unique(contexts, return_inverse=True)[1]]
        new = [draw_tables(words[w[i]], contexts[u[i]], c[i], t[i], tables[u[i]], customers[w[i]], model["total"], model["discount"],
                           model["parent_discount"], stirling, number) for i in (slice(k, k + CHUNK) for k in range(0, len(w), CHUNK))]
        t = np.concatenate(new)
        if number >= BURN_IN:
            tsum = tsum + t
        return _sent([(key, TABLES, 0, [], [_thin(t), _thin(tsum)]), *_sums(key, words, contexts, w, u, c - t, buckets)])
    return run


HEAD = 2 + SAMPLES


def _unpacked(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All integers of a packed column in a row, and where each word's begin."""
    if not len(column):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], np.int32)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(buffers[2], np.uint8)[offsets[0]:offsets[-1]]
    return np.frombuffer(data.tobytes(), "<i8"), (offsets[:-1] - offsets[0]) // 8


_SCORES = "id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def _chances(parent: np.ndarray, passed: np.ndarray, unknown: np.ndarray, w: np.ndarray, u: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Probabilities of the words at ``w`` after the contexts at ``u`` (-1: not seen in training). ``own``: the context
    restaurant's part; ``passed``: what a context passes to its parent, per sample."""
    prob = np.zeros(len(w))
    for k in range(SAMPLES):
        p = np.where(w >= 0, parent[w, k], unknown[k]) if len(parent) else np.full(len(w), unknown[k])
        if passed.shape[1]:
            p = np.where(u >= 0, p * passed[k][u], p)
        prob += p / SAMPLES
    return prob + own


def _parents(model: dict, customers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per sample the parent's probabilities of words with so many customers, and of the unknown word."""
    totals = PARENT_STRENGTH + np.array(model["totals"], np.float64)
    return (customers - model["parent_discount"]) / totals, (PARENT_STRENGTH + model["parent_discount"] * model["types"]) / totals


def _passed(model: dict, tables: np.ndarray, seats: np.ndarray) -> np.ndarray:
    return (STRENGTH + model["discount"] * tables) / (STRENGTH + seats)


def _base(model: dict, count: np.ndarray) -> np.ndarray:
    return np.log10((count + 0.1) / (model["tokens"] + 0.1 * (model["types"] + 1)))


class Lookup:
    """A model at hand, to score any texts: of each word its count, number of contexts, customers per sample, then contexts,
    counts and summed tables, as 64-bit integers."""

    def __init__(self, words: np.ndarray, packed: list[pa.Array], model: dict):
        parts = [_unpacked(x) for x in packed] or [_unpacked(pa.array([], pa.binary()))]
        data = np.concatenate([x for x, _ in parts])
        base = np.cumsum([0, *[len(x) for x, _ in parts[:-1]]])
        start = np.concatenate([s + b for (_, s), b in zip(parts, base)])
        order = np.argsort(words)
        self.words, self.model, start = words[order], model, start[order]
        self.count = data[start].astype(np.float64)
        self.parent, self.unknown = _parents(model, np.stack([data[start + 2 + k] for k in range(SAMPLES)], 1).astype(np.float64))
        n = data[start + 1]
        row = np.repeat(np.arange(len(start)), n)
        at = start[row] + HEAD + np.arange(len(row)) - np.concatenate([[0], np.cumsum(n)])[row]
        u, c, t = (data[at + k * n[row]] for k in range(3))
        self.contexts = len(model["contexts"])
        key = row * max(1, self.contexts) + u
        order = np.argsort(key)
        self.pairs = key[order]
        self.own = ((c - model["discount"] * t / SAMPLES) / (STRENGTH + model["seats"])[u])[order]
        self.passed = _passed(model, np.array(model["passed"], np.float64), model["seats"])

    def score(self, texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per text: known tokens, base score and score."""
        codes = np.concatenate(texts)
        starts = np.cumsum([0, *map(len, texts[:-1])])
        w = _find(self.words, codes)
        before = np.concatenate([[END], codes[:-1]])
        before[starts] = END
        u = _find(self.model["contexts"], before)
        place = _find(self.pairs, w * self.contexts + u)
        own = np.where((w >= 0) & (u >= 0) & (place >= 0), self.own[place] if len(self.own) else 0.0, 0.0)
        count = np.where(w >= 0, self.count[w] if len(self.count) else 0.0, 0.0)
        total = np.add.reduceat
        return (total((w >= 0).astype(np.int64), starts), total(_base(self.model, count), starts),
                total(np.log10(_chances(self.parent, self.passed, self.unknown, w, u, own)), starts))


def _score_group(model: dict, side: int):
    """Texts are scored by what buckets and shards answer about the group's pairs and words, in the group's order."""
    def run(key, docs, found):
        x, got = Tokens(_binary(docs.column("text")), side), _received(found)[TOLD]
        of = lambda rows, columns: [_all([_thick(parts[k], n) for _, (n,), parts in rows]) for k in range(columns)]
        c, t = of([r for r in got if r[0] < side * side], 2)
        count, *more = of([r for r in got if r[0] >= side * side], 1 + 2 * SAMPLES)
        order = _order(x.key, (side * x.top) ** 2)
        head = _heads(x.key[order])
        if len(head) != len(c) or len(x.words) != len(count):
            raise ValueError("the texts of a group changed between two reads of the table")
        pair = np.empty(len(order), np.int32)
        pair[order] = np.repeat(np.arange(len(head), dtype=np.int32), np.diff(np.append(head, len(order))))
        w, u = x.word[order[head]], x.context[order[head]]
        del order
        seats = count.astype(np.float64)
        parent, unknown = _parents(model, np.column_stack(more[:SAMPLES]).astype(np.float64))
        own = np.where(c > 0, (c - model["discount"] * t / SAMPLES) / (STRENGTH + seats[u]), 0.0)
        known, never = count > 0, np.int64(-1)
        chances = _chances(parent, _passed(model, np.array(more[SAMPLES:], np.float64), seats), unknown,
                           np.where(known[w], w, never), np.where(known[u], u, never), own)
        starts = np.cumsum(x.sizes) - x.sizes
        sums = [np.add.reduceat(values[at], starts) for values, at in
                ((known.astype(np.int64), x.word), (_base(model, seats), x.word), (np.log10(chances), pair))]
        return pa.table([docs.column("id"), docs.column("held_out"), pa.array(x.sizes), pa.array(sums[0]),
                         pa.array(np.full(len(starts), model["tokens"], np.int64)), *map(pa.array, sums[1:])],
                        names=[k.split()[0] for k in _SCORES.split(", ")])
    return run


def _discount(ones: int, twos: int) -> float:
    """The share of mass that leave-one-out estimation takes from each table."""
    return min(0.95, max(0.05, ones / (ones + 2 * twos))) if ones else 0.5


def _step(s: Scratch, df: DataFrame, run, name: str, *kinds: int) -> list[DataFrame]:
    """What ``run`` makes of all rows with the same key (the first column), a table for each kind."""
    made = s.table(df.groupBy(df.columns[0]).applyInArrow(run, _SENT).withColumn("folder", F.col("kind")), name, "folder")
    return [s.part(made, f"folder={k}") for k in kinds]


def _together(*kinds: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, kinds)


def _stats(df: DataFrame, n: int) -> list[int]:
    """Sums of the first numbers of ``stats``."""
    return [x or 0 for x in df.agg(*[F.sum(F.col("stats")[k]) for k in range(n)]).first()]


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: the id, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``,
    ``base_score`` (additive unigrams) and ``score``, log10 probabilities of the
    whole text with its end. Training texts are those whose id, as text, has a
    crc32 not divisible by ten.

    Null text has the end alone. A null id reads as the empty string, so it is held out.
    Repeated rows count each. Without training texts every event is the unknown
    word, with probability one. An empty table gives no rows; other columns are
    ignored."""
    spark = docs.sparkSession
    with scratch(spark) as s:
        name = F.coalesce(F.col(id_col).cast("long").cast("string"), F.lit(""))
        rows = docs.select(row_id(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"),
                           (F.crc32(name.cast("binary")) % 10 == 0).alias("held_out"))
        size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        groups = 1 + size // GROUP_BYTES
        side = math.isqrt(groups - 1) + 1
        buckets = side * side
        rows = rows.withColumn("grp", F.pmod(F.xxhash64("id", F.length("text")), F.lit(groups)))

        asked = rows.select("grp", "text", "held_out").groupBy("grp").applyInArrow(_ask(side), _SENT)
        often, told, known, sums = _step(s, asked, _merge(buckets), "merged", OFTEN, TOLD, KNOWN, SUMS)
        tokens, types, ones, twos = _stats(known, 4)
        model = {"tokens": tokens, "types": types, "parent_discount": _discount(ones, twos), "discount": _discount(*_stats(told, 2))}
        tables, values, totals = [], [], []
        for number in range(BURN_IN + SAMPLES + 1):
            reply, now = _step(s, _together(known, sums), _seat(number), "seated", REPLY, VALUES)
            s.drop(sums)
            total, = _stats(now, 1)
            if number > BURN_IN:
                values.append(now)
                totals.append(total)
            else:
                s.drop(now)
            if number < BURN_IN + SAMPLES:
                run = _sweep({**model, "total": total}, number, buckets)
                swept, sums = _step(s, _together(often, reply, *tables), run, "swept", TABLES, SUMS)
                s.drop(*tables)
                tables = [swept]
            s.drop(reply)
        s.drop(often)
        model["totals"] = totals
        turn = F.pmod("key", F.lit(TURNS)).alias("turn")
        answers = s.table(_together(told, known, *tables, *values).groupBy("key").applyInArrow(_answer(buckets), _SENT).select("*", turn),
                          "answers", "turn")
        s.drop(told, known, *tables, *values)
        for k in range(min(TURNS, groups)):
            found = s.part(answers, f"turn={k}")
            scored = s.table(rows.filter(F.pmod("grp", F.lit(TURNS)) == k).groupBy("grp").cogroup(found.groupBy("key"))
                             .applyInArrow(_score_group(model, side), _SCORES), "scores")
            s.drop(found)
        out = s.tables(scored, "scores")
    return out.select(F.when(F.col("id") != NULL_ID, F.col("id")).alias(id_col), *[x.split()[0] for x in _SCORES.split(", ")[1:]])

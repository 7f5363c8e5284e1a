"""Window fingerprints over sequences of codes, in numpy.

A sequence (bytes of a text, or hashes of its words) gets prefix sums of
``code * R**i`` modulo 2**64; any window's fingerprint is then two lookups.
:func:`runs` groups a sequence's windows by the anchor they share, so that
equal windows, wherever they stand, fall under the same anchor fingerprint.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

_R = 0x9E3779B97F4A7C15
_RI = pow(_R, -1, 1 << 64)
_POW = np.ones(1, np.uint64)
_INV = np.ones(1, np.uint64)
_LOW = np.uint64((1 << 20) - 1)
#: Windows handled at once; longer sequences go block by block.
BLOCK = 1 << 17


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _POW, _INV
    if len(_POW) < n:
        size = 1 << n.bit_length()
        for name, base in (("_POW", _R), ("_INV", _RI)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            globals()[name] = np.cumprod(steps, dtype=np.uint64)
    return _POW, _INV


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


BYTE_CODES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_R)) | np.uint64(1)


def prefix(codes: np.ndarray) -> np.ndarray:
    power, _ = _powers(len(codes) + 1)
    out = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(codes * power[:len(codes)], out=out[1:])
    return out


def spans(sums: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Fingerprints of the half-open spans, wherever in the sequence they stand."""
    _, inverse = _powers(len(sums))
    return mix((sums[stop] - sums[start]) * inverse[start])


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    n, step, out = len(x) - width + 1, 1, x
    while step * 2 <= width:
        out = np.minimum(out[:-step], out[step:])
        step *= 2
    return np.minimum(out[:n], out[width - step:width - step + n]) if step < width else out[:n]


@dataclass
class Runs:
    """Consecutive windows ``first..last`` that share the anchor at ``anchor``."""
    gram: np.ndarray    # fingerprint of the anchor's codes
    span: np.ndarray    # fingerprint of all codes the run's windows cover, and where the anchor lies in them
    first: np.ndarray
    last: np.ndarray
    anchor: np.ndarray


def runs(codes: np.ndarray, width: int, gram: int, table: np.ndarray | None = None) -> Runs:
    """Group all windows of ``width`` codes by anchor.

    The anchor of a window is its sub-window of ``gram`` codes with the smallest
    fingerprint, the rightmost on ties, so it depends on the window's content
    alone: equal windows have equal anchors at equal places. Blocks only cut
    runs in two, which changes no window's anchor. With ``table``, ``codes`` are
    indices into it, looked up block by block."""
    parts: list[Runs] = []
    width_keys = width - gram + 1
    for at in range(0, max(0, len(codes) - width + 1), BLOCK):
        x = _looked_up(codes[at:at + BLOCK + width - 1], table)
        sums = prefix(x)
        n = len(x) - gram + 1
        _, inverse = _powers(len(x) + 1)
        h = mix((sums[gram:] - sums[:-gram]) * inverse[:n])
        place = np.arange(n, dtype=np.uint64)
        low = _sliding_min((h & ~_LOW) | (_LOW - place), width_keys)
        anchor = (_LOW - (low & _LOW)).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
        last = np.concatenate([first[1:], [len(anchor)]]) - 1
        a = anchor[first]
        shape = ((a - first) << 20 | (last - first)).astype(np.uint64)
        span = mix(spans(sums, first, last + width) + shape * np.uint64(_R))
        parts.append(Runs(h[a], span, first + at, last + at, a + at))
    if not parts:
        e = np.zeros(0, np.int64)
        return Runs(np.zeros(0, np.uint64), np.zeros(0, np.uint64), e, e, e)
    if len(parts) == 1:
        return parts[0]
    return Runs(*(np.concatenate([getattr(p, f) for p in parts]) for f in ("gram", "span", "first", "last", "anchor")))


def _looked_up(codes: np.ndarray, table: np.ndarray | None) -> np.ndarray:
    return codes if table is None else table[codes]


def span_ranks(codes: np.ndarray, start: np.ndarray, stop: np.ndarray, table: np.ndarray | None = None) -> np.ndarray:
    """Fingerprints of short spans with ascending starts, block by block."""
    out, lo = np.zeros(len(start), np.uint64), 0
    while lo < len(start):
        base = start[lo]
        hi = max(lo + 1, int(np.searchsorted(start, base + BLOCK)))
        sums = prefix(_looked_up(codes[base:stop[lo:hi].max()], table))
        out[lo:hi] = spans(sums, start[lo:hi] - base, stop[lo:hi] - base)
        lo = hi
    return out


def pairs_at(codes: np.ndarray, width: int, wanted: np.ndarray, table: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Rank pairs of the windows that start at ``wanted`` (ascending): the
    fingerprints of each window's first and second half."""
    half = wanted + width // 2
    return span_ranks(codes, wanted, half, table), span_ranks(codes, half, wanted + width, table)


def word_bounds(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and stops of the words (runs of bytes other than space and 9 to 13)."""
    gap = (text == 32) | ((text >= 9) & (text <= 13))
    edge = np.flatnonzero(np.diff(np.concatenate([[True], gap, [True]]).view(np.int8)))
    return edge[::2], edge[1::2]


def word_codes(text: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """A 64-bit code of each word's bytes."""
    out = np.zeros(len(start), np.uint64)
    lo = 0
    while lo < len(start):
        hi = max(lo + 1, int(np.searchsorted(stop, start[lo] + (BLOCK << 1), "right")))
        at = start[lo]
        sums = prefix(BYTE_CODES[text[at:stop[hi - 1]]])
        out[lo:hi] = spans(sums, start[lo:hi] - at, stop[lo:hi] - at)
        lo = hi
    return out

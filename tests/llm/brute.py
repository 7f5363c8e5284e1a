"""Plain versions of the operators for small fixtures."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def ascii_lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def simhash(text):
    words = WORD.findall(ascii_lower(text or ""))
    if not words:
        return 0
    grams = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(ids, prints, distance=2):
    root = {i: i for i in range(len(ids))}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(ids)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= distance:
                root[find(i)] = find(j)
    least = {}
    for i, d in enumerate(ids):
        least[find(i)] = min(least.get(find(i), d), d)
    return [least[find(i)] for i in range(len(ids))]


def suffix(docs, width=100):
    seen, out = set(), {}
    for d, text in sorted(docs):
        b = (text or "").encode()
        dead = bytearray(len(b))
        for i in range(len(b) - width + 1):
            w = b[i:i + width]
            if w in seen:
                dead[i:i + width] = b"\1" * width
            seen.add(w)
        kept = bytes(x for x, k in zip(b, dead) if not k)
        runs = len(re.findall(b"\1+", bytes(dead)))
        out[d] = (len(b), sum(dead), runs, hashlib.sha256(kept).hexdigest())
    return out


def statistics(text):
    text = text or ""
    words = WORD.findall(text)
    n = len(words)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    grams = [tuple(words[i:i + 3]) for i in range(n - 2)]
    inside = {j for i, g in enumerate(grams) if grams.count(g) > 1 for j in (i, i + 1, i + 2)}
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(inside))


def passages(docs, window=20):
    seen, out = set(), {}
    for d, text in sorted(docs):
        words = WORD.findall(text or "")
        dead = [False] * len(words)
        for i in range(len(words) - window + 1):
            w = tuple(words[i:i + window])
            if w in seen:
                dead[i:i + window] = [True] * window
            seen.add(w)
        kept = " ".join(w for w, k in zip(words, dead) if not k)
        out[d] = (len(words), sum(dead), hashlib.sha256(kept.encode()).hexdigest())
    return out


def spelling(docs, least=7, occurrences=2, typo=31, ratio=10):
    """``{word: (form, root, n, n_near, form_n)}``"""
    count = Counter()
    for d, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = ascii_lower(run)
            h = zlib.crc32(f"{'' if d is None else d}:{w}".encode())
            if h % typo == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            count[w] += 1
    words = {w: n for w, n in count.items() if len(w) >= least and n >= occurrences}
    around = defaultdict(set)  # what is left without one character -> words
    for w in words:
        for i in range(len(w)):
            around[w[:i] + w[i + 1:]].add(w)

    def one_edit(a, b):
        if len(a) > len(b):
            a, b = b, a
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        return len(b) - len(a) == 1 and any(a == b[:i] + b[i + 1:] for i in range(len(b)))
    near = {w: {v for v in set().union(around[w], *(around[w[:i] + w[i + 1:]] | {w[:i] + w[i + 1:]} for i in range(len(w))))
                if v in words and v != w and one_edit(v, w)} for w in words}
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        if best is not None and words[best] >= ratio * n:
            form[w] = best
    out = {}
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        out[w] = (form.get(w), root, n, len(near[w]), words[form[w]] if w in form else None)
    return out


def aligned(texts, a_ids, a_bytes, b_ids, b_bytes):
    """Per text ``(n_a, n_b, n_groups, n_links, n_best, count_sum, groups)``."""
    done = []
    for text, a, b in zip(texts, a_ids, b_ids):
        whole = (" " + (text or "")).encode()
        if not text or b"".join(a_bytes[i] for i in a) != whole or b"".join(b_bytes[i] for i in b) != whole:
            done.append(([], []))
            continue
        spans = []
        for ids, size in ((a, a_bytes), (b, b_bytes)):
            at, side = 0, []
            for i in ids:
                side.append((at, at + len(size[i]), i))
                at += len(size[i])
            spans.append(side)
        links, j = [], 0
        for s, e, i in spans[0]:
            while spans[1][j][1] <= s:
                j += 1
            k = j
            while k < len(spans[1]) and spans[1][k][0] < e:
                links.append((i, spans[1][k][2]))
                k += 1
        ends = sorted({e for _, e, _ in spans[0]} & {e for _, e, _ in spans[1]})
        groups, start = [], 0
        for stop in ends:
            groups.append("|".join(",".join(str(i) for s, e, i in side if start <= s and e <= stop) for side in spans))
            start = stop
        done.append((links, groups))
    count = Counter(p for links, _ in done for p in set(links))
    top = defaultdict(int)
    for (a, _), n in count.items():
        top[a] = max(top[a], n)
    out = []
    for (links, groups), a, b in zip(done, a_ids, b_ids):
        out.append((len(a) if groups else 0, len(b) if groups else 0, len(groups), len(links),
                    sum(count[p] == top[p[0]] for p in links), sum(count[p] for p in links), ";".join(groups)))
    return out

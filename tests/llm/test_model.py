import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from barflow.llm import pitman_yor as py
from barflow.llm import queries
from brute import WORD, ascii_lower

DOCS = "doc_id long, text string, w string"


def expected(rows):
    """Counts and base scores by the contract, and texts as token lists."""
    texts = [(i, WORD.findall(ascii_lower(t or "")) + [None]) for i, t in rows]
    held = [zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0 for i, _ in rows]
    counts = Counter(w for (_, x), h in zip(texts, held) if not h for w in x)
    n, v = sum(counts.values()), len(counts)
    out = []
    for (i, x), h in zip(texts, held):
        base = sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in x)
        out.append((i, h, len(x), sum(counts[w] > 0 for w in x), n, base))
    return out


def check(rows, got):
    key = lambda r: (r[0] is not None, r[0] or 0, r[2], r[5])
    want, have = sorted(expected(rows), key=key), sorted([tuple(r)[:6] for r in got], key=key)
    assert [w[:5] for w in want] == [h[:5] for h in have]
    assert all(math.isclose(w[5], h[5], rel_tol=1e-9, abs_tol=1e-9) for w, h in zip(want, have))
    assert all(math.isfinite(r.score) and r.score <= 1e-9 for r in got)


def test_registered(spark):
    d = "/root/testdata/sf0.01"
    rows = [(r.doc_id, r.text) for r in queries.table(spark, d, "documents").collect()]
    got = queries.op8_pitman_yor(spark, d).collect()
    check(rows, got)
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held) + 0.1 * sum(r.n_tokens for r in held)
    again = queries.op8_pitman_yor(spark, d).collect()
    assert {(r.doc_id, r.score) for r in got} == {(r.doc_id, r.score) for r in again}


def test_odd_rows(spark):
    rows = [(None, None), (None, "a b"), (3, "a b a b"), (3, "a b a b"), (4, ""), (5, "long " * 200_000), (6, "É é A")]
    df = spark.createDataFrame([(*r, "x") for r in rows], DOCS)
    got = py.score(df).collect()
    assert len(got) == len(rows)
    check([(i, t) if i is not None else (None, t) for i, t in rows], got)
    assert py.score(df.limit(0)).count() == 0
    untrained = [i for i in range(200) if zlib.crc32(str(i).encode()) % 10 == 0][:3]
    got = py.score(spark.createDataFrame([(i, "x y", "z") for i in untrained], DOCS)).collect()
    assert [(r.n_known, r.train_tokens, r.base_score, r.score) for r in got] == [(0, 0, 0.0, 0.0)] * 3


def test_probabilities_sum_to_one():
    """Over all words and the unknown one, after every context and after none."""
    r = np.random.default_rng(3)
    words = np.sort(r.integers(1, 2**63, 40).astype(np.uint64))
    contexts, d, pd = np.sort(words[[3, 7]]), 0.6, 0.7
    pairs = {(u, w): int(c) for u in range(2) for w, c in zip(r.choice(40, 15, replace=False), r.integers(1, 9, 15))}
    direct = r.integers(1, 6, 40)
    tables = [{k: int(r.integers(1, c + 1)) for k, c in pairs.items()} for _ in range(py.SAMPLES)]
    seats = np.array([sum(c for (x, _), c in pairs.items() if x == u) for u in range(2)], float)
    customers = [[int(direct[w]) + sum(t.get((u, w), 0) for u in range(2)) for w in range(40)] for t in tables]
    model = {"contexts": contexts, "tokens": 1000, "types": 40, "parent_discount": pd, "discount": d, "seats": seats,
             "totals": [sum(c) for c in customers], "passed": [[sum(t[k] for k in t if k[0] == u) for u in range(2)] for t in tables]}
    packed = []
    for w in range(40):
        mine = sorted((u, pairs[u, w], sum(t[u, w] for t in tables)) for u in range(2) if (u, w) in pairs)
        packed.append(np.array([9, len(mine), *[c[w] for c in customers], *[x for k in range(3) for x in (m[k] for m in mine)]], "<u8").tobytes())
    import pyarrow as pa
    look = py.Lookup(words, [pa.array(packed[:7], pa.binary()), pa.array(packed[7:], pa.binary())], model)
    for before in (contexts[0], contexts[1], words[0]):
        def after(w):
            both, one = look.score([np.array([before, w], np.uint64), np.array([before], np.uint64)])[2]
            return 10 ** (both - one)
        assert abs(sum(after(w) for w in words) + after(np.uint64(5)) - 1) < 1e-9


def test_tables_are_drawn_from_the_conditional():
    """Against all seatings of six customers at tables, weighted one by one."""
    c, d, pd, others, above, total = 6, 0.5, 0.6, 4, 3, 50

    def weights():
        out = Counter()

        def seat(sizes, k, weight):
            if k == c:
                parent = math.prod((above + j - pd) / (py.PARENT_STRENGTH + total) for j in range(len(sizes)))
                out[len(sizes)] += weight * parent
                return
            for i, n in enumerate(sizes):
                seat(sizes[:i] + [n + 1] + sizes[i + 1:], k + 1, weight * (n - d))
            seat(sizes + [1], k + 1, weight * (py.STRENGTH + d * (others + len(sizes))))
        seat([], 0, 1.0)
        whole = sum(out.values())
        return {t: x / whole for t, x in out.items()}
    n = 40_000
    one = np.ones(n, np.int64)
    got = py.draw_tables(np.arange(n, dtype=np.uint64), one, one * c, one * 2, one * (others + 2), one * (above + 2), total, d, pd,
                         py._stirling(d), 1)
    for t, p in weights().items():
        assert abs((got == t).mean() - p) < 0.012
    many = py.draw_tables(np.arange(n, dtype=np.uint64), one, one * 5000, one, one * 100, one * 50, 10**6, d, pd, py._stirling(d), 2)
    r, seated = random.Random(1), []
    for _ in range(300):  # one by one
        t = 1
        for k in range(1, 5000):
            a = (py.STRENGTH + d * (99 + t)) * (49 + t - pd) / (py.PARENT_STRENGTH + 10**6)
            t += r.random() < a / (a + k - d * t)
        seated.append(t)
    assert abs(many.mean() - np.mean(seated)) < 0.5 and (many >= 1).all()


@pytest.mark.parametrize("c", [60, 700, 1500])
@pytest.mark.parametrize(("d", "others", "above", "total"), [(0.5, 400, 30_000, 10**6), (0.75, 900, 50_000, 10**6), (0.95, 50_000, 9_000, 10**6), (0.1, 3, 0, 10**4)])
def test_any_number_of_customers_is_drawn_from_the_conditional(c, d, others, above, total):
    """Against the weights of all numbers of tables, built up customer by customer."""
    pd, n = 0.6, 5_000
    logs = np.array([0.0])  # of 1.. tables
    for k in range(1, c):
        with np.errstate(divide="ignore"):
            stay = np.append(logs + np.log(k - d * np.arange(1, k + 1)), -np.inf)
        logs = np.logaddexp(np.append(-np.inf, logs), stay)
    j = np.arange(c)
    logs += np.cumsum(np.log(py.STRENGTH + d * (others + j)) + np.log(np.maximum(above + j - pd, 1 - pd) / (py.PARENT_STRENGTH + total)))
    upto = np.cumsum(np.exp(logs - logs.max()))
    one = np.ones(n, np.int64)
    got = py.draw_tables(np.arange(n, dtype=np.uint64), one, one * c, one, one * (others + 1), one * (above + 1), total, d, pd, py._stirling(d), 3)
    assert got.min() >= 1 and got.max() <= c
    share = np.cumsum(np.bincount(got, minlength=c + 1)[1:]) / n
    assert np.abs(share - upto / upto[-1]).max() < 0.03


def test_rare_contexts_have_restaurants(spark):
    """A word of fewer than a thousandth of all tokens tells what follows it."""
    r = random.Random(4)
    train = [i for i in range(400) if zlib.crc32(str(i).encode()) % 10][:300]
    held = [i for i in range(400) if zlib.crc32(str(i).encode()) % 10 == 0][:2]
    rows = [(i, " ".join(f"w{r.randrange(300)}" for _ in range(40))) for i in train]
    for k in range(4):  # each 4 of some 12,000 tokens
        rows[k] = (rows[k][0], "alpha beta " + rows[k][1])
        rows[-1 - k] = (rows[-1 - k][0], "delta gamma " + rows[-1 - k][1])
    rows += [(held[0], "alpha beta"), (held[1], "alpha gamma")]
    got = {x.doc_id: x.score for x in py.score(spark.createDataFrame([(*x, "z") for x in rows], DOCS)).collect()}
    assert got[held[0]] > got[held[1]] + 1


def test_no_table_has_a_row_for_every_pair(spark, monkeypatch):
    """Pairs seen once stay with their text, groups change nothing, and what groups send takes few bytes a pair."""
    r = random.Random(8)
    rows = [(i, " ".join(f"w{r.randrange(400)}" for _ in range(300)) + " often said") for i in range(60)]
    pairs = len({p for _, t in rows for w in [t.split()] for p in zip(w, w[1:])})
    df, written, table = spark.createDataFrame([(*x, "z") for x in rows], DOCS), [], py.Scratch.table
    monkeypatch.setattr(py.Scratch, "table", lambda s, d, *a: written.append((a[0], (t := table(s, d, *a)).count())) or t)
    whole = {x.doc_id: x.score for x in py.score(df).collect()}
    assert max(n for _, n in written) < pairs / 2
    monkeypatch.setattr(py, "GROUP_BYTES", 20_000)
    got = py.score(df).collect()
    check(rows, got)
    assert all(math.isclose(whole[x.doc_id], x.score, rel_tol=1e-12) for x in got)
    w = np.sort(np.repeat(np.arange(1000, dtype=np.uint64) * np.uint64(977), 20))
    u, c, t = np.arange(len(w), dtype=np.uint64), np.arange(len(w)) % 300, np.arange(len(w)) % 2
    packed = py._pack(w, u, c, t)
    assert sum(map(len, packed)) < 12 * len(w)
    assert all((a == b).all() for a, b in zip(py._unpack(*packed), (w, u, c, t)))


def test_groups_are_scored_in_turns(spark, monkeypatch):
    """The texts and answers of all groups are never shuffled at once, and the turns change no score."""
    from barflow.llm.common import Scratch
    r = random.Random(4)
    rows = [(i, " ".join(r.choice(["a", "b", "c", f"w{r.randrange(60)}"]) for _ in range(r.randint(0, 30))), "x") for i in range(120)]
    df = spark.createDataFrame(rows, DOCS)
    monkeypatch.setattr(py, "GROUP_BYTES", 600)
    made, table = [], Scratch.table
    monkeypatch.setattr(Scratch, "table", lambda self, t, name, by=None: made.append((name, x := table(self, t, name, by))) or x)
    got = sorted(tuple(x) for x in py.score(df).collect())
    sizes = [t.count() for name, t in made if name == "scores"]
    assert sum(sizes) == len(rows) and max(sizes) <= len(rows) // 2
    check([x[:2] for x in rows], py.score(df).collect())
    monkeypatch.setattr(py, "TURNS", 1)
    assert got == sorted(tuple(x) for x in py.score(df).collect())


def test_packed_steps_equal_a_plain_sampler(spark, monkeypatch):
    """Scores as from all pairs in one place, while tables between the steps have a few rows a bucket, none a pair."""
    from barflow.llm.common import Scratch
    r = random.Random(6)
    rows = [(i, " ".join(r.choice(["The", "of", f"w{r.randrange(40)}", f"v{r.randrange(900)}"]) for _ in range(r.randrange(400))))
            for i in range(150)] + [(200, None), (200, "the The of"), (201, "the of " * 400)]
    texts = [[int(x) for x in py._codes([(t or "").encode()])[0]] for _, t in rows]
    train = [zlib.crc32(str(i).encode()) % 10 > 0 for i, _ in rows]
    events = lambda x: list(zip(x, [int(py.END), *x]))
    pairs = Counter(e for x, k in zip(texts, train) if k for e in events(x))
    count = Counter(w for x, k in zip(texts, train) if k for w in x)
    share = lambda c: py._discount(*(sum(n == k for n in c.values()) for k in (1, 2)))
    d, pd, often = share(pairs), share(count), [p for p, c in pairs.items() if c > 1]
    assert len(often) > 500
    tables, samples = dict.fromkeys(pairs, 1), []
    for number in range(py.BURN_IN + py.SAMPLES):
        of = [Counter(), Counter()]
        for p, t in tables.items():
            for k in range(2):
                of[k][p[k]] += t
        w, u = (np.array([p[k] for p in often], np.uint64) for k in range(2))
        c, t, under, above = (np.array(x) for x in ([pairs[p] for p in often], [tables[p] for p in often],
                                                    [of[1][p[1]] for p in often], [of[0][p[0]] for p in often]))
        new = py.draw_tables(w, u, c, t, under, above, sum(of[0].values()), d, pd, py._stirling(d), number)
        tables |= {p: int(t) for p, t in zip(often, new)}
        if number >= py.BURN_IN:
            samples.append(dict(tables))
    seated = [[Counter(), Counter()] for _ in samples]
    for s, t in zip(seated, samples):
        for p, x in t.items():
            s[0][p[0]] += x
            s[1][p[1]] += x

    def chance(w, u):
        out = 0.0
        for s, t in zip(seated, samples):
            whole = py.PARENT_STRENGTH + sum(s[0].values())
            p = (s[0][w] - pd) / whole if w in count else (py.PARENT_STRENGTH + pd * len(count)) / whole
            if u in count:
                p = (max(0, pairs[w, u] - d * t.get((w, u), 0)) + (py.STRENGTH + d * s[1][u]) * p) / (py.STRENGTH + count[u])
            out += p / py.SAMPLES
        return out
    want = sorted((i, sum(math.log10(chance(*e)) for e in events(x))) for (i, _), x in zip(rows, texts))
    df, sizes, table = spark.createDataFrame([(*x, "z") for x in rows], DOCS), [], Scratch.table
    monkeypatch.setattr(Scratch, "table", lambda s, t, name, by=None: (x := table(s, t, name, by), name == "scores" or sizes.append(x.count()))[0])
    for size, most in ((py.GROUP_BYTES, 20), (30_000, 400)):
        monkeypatch.setattr(py, "GROUP_BYTES", size)
        got = sorted((x.doc_id, x.score) for x in py.score(df).collect())
        assert all(a[0] == b[0] and math.isclose(a[1], b[1], rel_tol=1e-9) for a, b in zip(got, want, strict=True))
        assert sizes and max(sizes) <= most
        sizes.clear()

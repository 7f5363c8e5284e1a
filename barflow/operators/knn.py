"""Exact k-nearest neighbours (Euclidean) between a query set and a training set.

The training rows are indexed by a metric tree of two levels. Its pivots are
training vectors, the first by a hash; there is one per ``LEAF_ROWS`` rows, so
their number grows with the data up to ``MAX_DOUBLES`` numbers in all (32 MB; only
they reach the driver). The first sqrt of them are the upper nodes, each other
pivot belongs to the nearest of these, and a row goes to the nearest upper node
and there to the nearest pivot, its leaf. Of each leaf the tree keeps the number of its
rows, their least and largest distance from the pivot and from the upper node.

A query is first compared with the rows of its own leaf; its k-th distance there
bounds what it still needs (with fewer than k rows, the distance within which the
leaves' own bounds promise k rows). In the second round it descends: a node is left out if even
the nearest point it could hold is beyond the bound. Rows of node j lie

* in a ring around p_j, so not nearer than ``d(q, p_j) - largest`` or ``least - d(q, p_j)``;
* beyond the plane between p_j and the sibling p_i that is nearest to the query, so not
  nearer than ``(d(q, p_j)^2 - d(q, p_i)^2) / (2 d(p_i, p_j))``.

Leaves are put together, children of one upper node side by side, to groups of about
``block_rows`` rows; a dense leaf (a vector that a third of all rows share) is cut into several
blocks instead. A query goes once to each group with a leaf that it needs, together with the list
of these leaves, so what is shuffled grows with the number of groups, not of leaves. One task
holds one block of each side and keeps the ``k`` best per query; of equal vectors in a leaf the first
``k`` count. Inside the tasks a matrix product leaves out the pairs whose distance is
beyond the bound by more than its rounding error, the others' distances come from the differences.

Rows are identified by one or more key columns; ties go to the smaller training
key, so the result is a function of the rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barflow.session import materialize

LEAF_ROWS = 1_000
MAX_DOUBLES = 1 << 22
DEFAULT_BLOCK_ROWS = 20_000
#: Numbers (or pairs) that a step inside a task holds in one array, whatever the number of rows and nodes.
PIECE = 1 << 18


def _keys(x: str | Sequence[str]) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def _matrix(series: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(v, dtype=float) for v in series]) if len(series) else np.zeros((0, 0))


def _distances(mat: np.ndarray, points: np.ndarray) -> np.ndarray:
    diff = mat[:, None, :] - points[None, :, :]
    return np.sqrt(np.einsum("ijk,ijk->ij", diff, diff))


def _chunks(rows: int, points: np.ndarray, budget: int = PIECE) -> Iterator[slice]:
    """Pieces of the rows whose differences from all points stay under ``budget`` numbers."""
    step = max(1, min(4096, budget // max(1, points.size)))
    return (slice(s, min(rows, s + step)) for s in range(0, rows, step))


def _beyond(d: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Least distance of each query (row) from the points nearer to node j than to the node nearest to the query."""
    own, at = np.unique(d.argmin(1), return_inverse=True)
    apart = _distances(points[own], points)[at]  # not all pairs of points: a node may have very many children
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.nan_to_num((d ** 2 - d.min(1)[:, None] ** 2) / (2 * apart), nan=0.0)


@dataclass(frozen=True)
class PivotTree:
    """``pivots``, the upper node of each (the first pivots are the upper nodes), and of each
    leaf ``rows``, ``near`` and ``far`` from its pivot, ``upper_near`` and ``upper_far`` from its upper node."""
    pivots: np.ndarray
    parent: np.ndarray
    rows: np.ndarray
    near: np.ndarray
    far: np.ndarray
    upper_near: np.ndarray
    upper_far: np.ndarray

    @staticmethod
    def of(pivots: np.ndarray) -> PivotTree:
        """The tree of these pivots, without rows yet."""
        uppers = pivots[:int(np.ceil(np.sqrt(len(pivots))))]
        parts = [_distances(pivots[c], uppers).argmin(1) for c in _chunks(len(pivots), uppers)]
        none = np.zeros(len(pivots))
        return PivotTree(pivots, np.concatenate(parts) if parts else none.astype(int), none.astype(int), none, none, none, none)

    @cached_property
    def uppers(self) -> np.ndarray:
        return self.pivots[:int(self.parent.max()) + 1 if len(self.parent) else 0]

    @cached_property
    def children(self) -> list[np.ndarray]:
        return [np.flatnonzero(self.parent == a) for a in range(len(self.uppers))]

    @cached_property
    def upper_ring(self) -> tuple[np.ndarray, np.ndarray]:
        least, most = np.full(len(self.uppers), np.inf), np.full(len(self.uppers), -np.inf)
        np.minimum.at(least, self.parent, self.upper_near)
        np.maximum.at(most, self.parent, self.upper_far)
        return least, most

    def leaf_of(self, mat: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per vector: its leaf, and its distances from the leaf's pivot and from the upper node."""
        leaf, own, upper = np.zeros(len(mat), np.int32), np.zeros(len(mat)), np.zeros(len(mat))
        if not len(self.pivots):
            return leaf, own, upper
        node = np.zeros(len(mat), np.int32)
        for c in _chunks(len(mat), self.uppers):
            d = _distances(mat[c], self.uppers)
            node[c], upper[c] = d.argmin(1), d.min(1)
        for a in np.unique(node):
            rows, under = np.flatnonzero(node == a), self.children[a]
            for c in _chunks(len(rows), self.pivots[under]):
                d = _distances(mat[rows[c]], self.pivots[under])
                leaf[rows[c]], own[rows[c]] = under[d.argmin(1)], d.min(1)
        return leaf, own, upper

    def promised(self, mat: np.ndarray, k: int) -> np.ndarray:
        """Per query a distance within which there are ``k`` rows, by the leaves' rings alone (infinite if there are fewer)."""
        out = np.full(len(mat), np.inf)
        for c in _chunks(len(mat), self.pivots):
            most = _distances(mat[c], self.pivots) + self.far
            order = most.argsort(1)
            enough = np.cumsum(self.rows[order], 1) >= k
            at = enough.argmax(1)
            ends = np.take_along_axis(most, np.take_along_axis(order, at[:, None], 1), 1)[:, 0]
            out[c] = np.where(enough.any(1), ends, np.inf)
        return out

    def visits(self, mat: np.ndarray, bound: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of query and leaf, but for its own leaf, where a row may be within the query's bound."""
        if not len(mat) or not len(self.pivots):
            return
        limit = bound * (1 + 1e-9) + 1e-9  # rounding must not lose a neighbour
        home, _, _ = self.leaf_of(mat)
        least, most = self.upper_ring
        go = np.zeros((len(mat), len(self.uppers)), bool)
        for c in _chunks(len(mat), self.uppers):
            d = _distances(mat[c], self.uppers)
            go[c] = np.maximum.reduce([d - most, least - d, _beyond(d, self.uppers)]) <= limit[c, None]
        for a, under in enumerate(self.children):
            rows = np.flatnonzero(go[:, a])
            for c in _chunks(len(rows), self.pivots[under]):
                at = rows[c]
                d = _distances(mat[at], self.pivots[under])
                least_of = np.maximum.reduce([d - self.far[under], self.near[under] - d, _beyond(d, self.pivots[under])])
                i, j = np.nonzero((least_of <= limit[at, None]) & (under[None, :] != home[at, None]))
                yield at[i], under[j]


@dataclass(frozen=True)
class KnnModel:
    """A fitted training set: its tree and its rows with their leaves. Fit once, search often."""
    tree: PivotTree
    cells: DataFrame          # t0.., t_vec, t_y, cell
    keys: tuple[str, ...]     # names of the key columns, as t0..


def _fields(df: DataFrame, cols: Sequence[str]) -> str:
    return ", ".join(f"{c} {df.schema[c].dataType.simpleString()}" for c in cols)


def fit(train: DataFrame, keys: str | Sequence[str] = "id", vec: str = "vec", y: str | None = None,
        pivots: int | None = None) -> KnnModel:
    """Grow the tree and write the rows with their leaves as a table (shared by the tree's bounds and every search).
    ``pivots`` sets the number of leaves; by default it follows from the number of rows."""
    names = _keys(keys)
    t = train.select(*[F.col(c).alias(f"t{i}") for i, c in enumerate(names)],
                     F.col(vec).cast("array<double>").alias("t_vec"),
                     (F.col(y).cast("double") if y else F.lit(None).cast("double")).alias("t_y"))
    count, width = t.agg(F.count(F.lit(1)), F.max(F.size("t_vec"))).first()
    wanted = pivots or max(1, min(-(-count // LEAF_ROWS), MAX_DOUBLES // max(1, width or 1)))
    # the first rows by hash; a vector that many rows share counts once
    ids = [f"t{i}" for i in range(len(names))]
    chosen = t.orderBy(F.xxhash64("t_vec", *ids), "t_vec", *ids).select("t_vec").limit(wanted).collect()
    mat = np.array(list(dict.fromkeys(tuple(r["t_vec"]) for r in chosen)), dtype=float)
    tree = PivotTree.of(mat)
    rows = materialize(_dealt(t, "t_vec", tree, "own double, upper double"), "knn")
    found = rows.groupBy("cell").agg(F.count(F.lit(1)), F.min("own"), F.max("own"), F.min("upper"), F.max("upper")).collect()
    stats = np.zeros((5, len(mat)))
    for leaf, *values in found:  # a row per leaf
        if len(mat):
            stats[:, leaf] = values
    tree = PivotTree(mat, tree.parent, stats[0].astype(int), *stats[1:])
    return KnnModel(tree, rows.drop("own", "upper"), tuple(names))


def _dealt(rows: DataFrame, vec: str, tree: PivotTree, more: str = "") -> DataFrame:
    cols = rows.columns

    def run(batches):
        for b in batches:
            leaf, own, upper = tree.leaf_of(_matrix(b[vec]))
            b = b.assign(cell=leaf)
            yield b.assign(own=own, upper=upper) if more else b

    return rows.mapInPandas(run, f"{_fields(rows, cols)}, cell int" + (f", {more}" if more else ""))


_NODE = "place int, vec array<double>, parent int, rows long, near double, far double, upper_near double, upper_far double"


def save(model: KnnModel, path: str) -> KnnModel:
    """Write a fitted model: its rows and its tree; returns it as read back."""
    spark = model.cells.sparkSession
    names = [(i, c) for i, c in enumerate(model.keys)]
    spark.createDataFrame(names, "place int, key string").coalesce(1).write.mode("overwrite").parquet(f"{path}/keys")
    t = model.tree
    nodes = [(i, t.pivots[i].tolist(), int(t.parent[i]), int(t.rows[i]), *(float(x[i]) for x in (t.near, t.far, t.upper_near, t.upper_far)))
             for i in range(len(t.pivots))]
    spark.createDataFrame(nodes, _NODE).coalesce(1).write.mode("overwrite").parquet(f"{path}/tree")
    model.cells.write.mode("overwrite").parquet(f"{path}/cells")
    return load(spark, path)


def load(spark: SparkSession, path: str) -> KnnModel:
    """A stored model; only its tree comes to the driver."""
    nodes = spark.read.parquet(f"{path}/tree").orderBy("place").collect()
    column = lambda name, kind: np.array([r[name] for r in nodes], dtype=kind)
    tree = PivotTree(column("vec", float), column("parent", int), column("rows", int),
                     *(column(c, float) for c in ("near", "far", "upper_near", "upper_far")))
    keys = tuple(r["key"] for r in spark.read.parquet(f"{path}/keys").orderBy("place").collect())
    return KnnModel(tree, spark.read.parquet(f"{path}/cells"), keys)


def _first_copies(mat: np.ndarray, cell: np.ndarray, k: int) -> np.ndarray:
    """Places of the rows, but of equal vectors in a cell only of the first ``k``: the later ones lose every tie."""
    if not mat.size:
        return np.arange(len(mat))
    wide = np.ascontiguousarray(np.column_stack([mat, cell]))
    _, same = np.unique(wide.view(f"V{wide.dtype.itemsize * wide.shape[1]}").ravel(), return_inverse=True)
    order = np.argsort(same, kind="stable")
    return np.sort(order[_places(same[order]) < k])


def _places(ascending: np.ndarray) -> np.ndarray:
    """Number of equal values before each."""
    head = np.concatenate([[True], ascending[1:] != ascending[:-1]]) if len(ascending) else np.zeros(0, bool)
    at = np.arange(len(ascending))
    return at - np.maximum.accumulate(np.where(head, at, 0))


def _best(i: np.ndarray, j: np.ndarray, d: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``k`` best columns ``j`` of each row ``i``; equal distances go to the smaller column."""
    order = np.lexsort((j, d, i))
    order = order[_places(i[order]) < k]
    return i[order], j[order], d[order]


def _candidates(q_mat: np.ndarray, t_mat: np.ndarray, limit: np.ndarray, k: int,
                budget: int = PIECE) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Row, column and distance, in pieces of rows: all columns that may be among the ``k`` best of a row
    and within its limit. Neither products nor differences hold more than ``budget`` numbers at a time."""
    width, kk = t_mat.shape[1], min(k, len(t_mat))
    centre = t_mat.mean(0)
    centre = np.where(np.isfinite(centre), centre, 0.0)
    t = t_mat - centre
    square = np.einsum("ij,ij->i", t, t)
    step, piece = max(1, budget // len(t_mat)), max(1, budget // max(1, width))
    for s in range(0, len(q_mat), step):
        q = q_mat[s:s + step] - centre
        own = np.einsum("ij,ij->i", q, q)
        slack = 8 * (width + 8) * np.finfo(float).eps * (own + square.max())  # above the error of the three terms
        less = square[None, :] - 2 * (q @ t.T)  # squared distance, less the query's own square
        cut = (limit[s:s + step] * (1 + 1e-9) + 1e-9) ** 2 - own + slack
        keep = ~(less > cut[:, None])  # a distance that isn't a number stays
        if keep.sum() > 32 * len(q) and kk < len(t_mat):
            cut = np.minimum(cut, np.partition(less, kk - 1, axis=1)[:, kk - 1] + 2 * slack)
            keep = ~(less > cut[:, None])
        i, j = np.nonzero(keep)
        d = np.empty(len(i))
        for at in range(0, len(i), piece):
            c = slice(at, at + piece)
            diff = q_mat[s + i[c]] - t_mat[j[c]]
            d[c] = np.sqrt(np.einsum("ij,ij->i", diff, diff))
        yield i + s, j, d


def _top_k(q_mat: np.ndarray, t_mat: np.ndarray, k: int, limit: np.ndarray | None = None,
           budget: int = PIECE) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Row, column and distance of the ``k`` best columns of each row within its limit, in pieces of rows."""
    limit = np.full(len(q_mat), np.inf) if limit is None else limit
    for i, j, d in _candidates(q_mat, t_mat, limit, k, budget):
        yield _best(i, j, d, k)


def _nearest(q_mat: np.ndarray, leaves: Sequence[np.ndarray], limit: np.ndarray, t_mat: np.ndarray, cell: np.ndarray,
             k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, column and distance of the ``k`` best columns per row in the leaves that the row needs;
    a row's limit falls with each leaf."""
    wanted = np.concatenate(leaves)
    order = np.argsort(wanted, kind="stable")
    asked, wanted = np.repeat(np.arange(len(leaves)), [len(x) for x in leaves])[order], wanted[order]
    limit = limit.copy()
    rows = np.argsort(cell, kind="stable")
    held = cell[rows]
    none = np.zeros(0, int)
    best = none, none, np.zeros(0)
    for leaf in np.unique(held):
        q = asked[slice(*np.searchsorted(wanted, [leaf, leaf + 1]))]
        t = rows[slice(*np.searchsorted(held, [leaf, leaf + 1]))]
        if not len(q):
            continue
        t = t[_first_copies(t_mat[t], cell[t], k)]
        found = [(q[i], t[j], d) for i, j, d in _top_k(q_mat[q], t_mat[t], k, limit[q])]
        best = _best(*(np.concatenate(x) for x in zip(best, *found)), k)
        last = _places(best[0]) == k - 1
        limit[best[0][last]] = np.fmin(limit[best[0][last]], best[2][last])
    return best


def _groups(tree: PivotTree, block_rows: int) -> tuple[np.ndarray, list[int]]:
    """The group of each leaf, and the number of blocks of each group."""
    group, held = np.zeros(max(1, len(tree.rows)), np.int32), [0]
    for leaf in np.argsort(tree.parent, kind="stable"):
        if held[-1] and held[-1] + tree.rows[leaf] > block_rows:
            held.append(0)
        held[-1] += int(tree.rows[leaf])
        group[leaf] = len(held) - 1
    return group, [max(1, -(-n // block_rows)) for n in held]


def _search(q: DataFrame, q_blocks: DataFrame, model: KnnModel, q_keys: list[str], t_keys: list[str], k: int,
            group: np.ndarray, t_blocks: list[int]) -> DataFrame:
    """The ``k`` best training rows for each row of ``q`` among those of its ``leaves`` in its ``grp``,
    per block of the group (a few blocks' candidates per query)."""
    t, spark = model.cells, q.sparkSession
    placed = spark.createDataFrame([(i, int(g)) for i, g in enumerate(group)], "cell int, grp int")
    sizes = spark.createDataFrame(list(enumerate(t_blocks)), "grp int, t_blocks int").join(q_blocks, "grp")  # a row per group
    keys = ["grp", "q_block", "t_block"]
    parts = 8 * sum(t_blocks)  # so a task has a bounded number of a group's blocks

    def dealt(df: DataFrame, ids: list[str], own: str, other: str) -> DataFrame:
        j = df.join(sizes, "grp")
        mine = F.pmod(F.xxhash64(*ids), F.col(f"{own}_blocks")).cast("int").alias(f"{own}_block")
        each = F.explode(F.sequence(F.lit(0), F.col(f"{other}_blocks") - 1)).alias(f"{other}_block")
        return j.select(*df.columns, mine, each).repartition(parts, *keys).groupBy(*keys)

    schema = f"{_fields(q, q_keys)}, {_fields(t, t_keys)}, distance double, t_y double"
    cols = [*q_keys, *t_keys, "distance", "t_y"]

    def pair(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({c: [] for c in cols})
        right = right.sort_values(t_keys, kind="stable").reset_index(drop=True)
        limit = left["bound"].to_numpy(dtype=float)
        qi, ti, dist = _nearest(_matrix(left["q_vec"]), list(left["leaves"]), np.where(np.isnan(limit), np.inf, limit),
                                _matrix(right["t_vec"]), right["cell"].to_numpy(), k)
        a = left[q_keys].iloc[qi].reset_index(drop=True)
        b = right[[*t_keys, "t_y"]].iloc[ti].reset_index(drop=True)
        return pd.concat([a, b], axis=1).assign(distance=dist)[cols]

    return (dealt(q, q_keys, "q", "t").cogroup(dealt(t.join(placed, "cell"), t_keys, "t", "q"))
            .applyInPandas(pair, schema))


def _asked(group: np.ndarray, bound: np.ndarray, mat: np.ndarray, tree: PivotTree,
           pairs: int = PIECE) -> Iterator[tuple[np.ndarray, np.ndarray, list[np.ndarray]]]:
    """Query, group and the leaves there that the query still needs; ``pairs`` of query and leaf at a time."""
    step = max(1, pairs // max(1, len(tree.pivots)))
    for s in range(0, len(mat), step):
        found = list(tree.visits(mat[s:s + step], bound[s:s + step]))
        if not found:
            continue
        i, leaf = (np.concatenate(x) for x in zip(*found))
        order = np.lexsort((leaf, group[leaf], i))
        i, leaf = i[order], leaf[order]
        g = group[leaf]
        head = np.flatnonzero(np.concatenate([[True], (i[1:] != i[:-1]) | (g[1:] != g[:-1])])) if len(i) else np.zeros(0, int)
        for h in range(0, len(head), 4096):  # vectors go out in small batches
            start = head[h:h + 4096]
            stop = head[h + 4096] if h + 4096 < len(head) else len(i)
            yield s + i[start], g[start], np.split(leaf[start[0]:stop].astype(np.int32), start[1:] - start[0])


def search(queries: DataFrame, model: KnnModel, k: int, keys: str | Sequence[str] = "id", vec: str = "vec",
           block_rows: int = DEFAULT_BLOCK_ROWS) -> DataFrame:
    """k nearest training rows per query row: the query's key columns (one key:
    as ``q_id``), ``rank``, the training row's (one key: ``t_id``; several:
    ``t_<name>``), ``distance`` and ``t_y``."""
    names = _keys(keys)
    q_keys, t_keys = [f"q{i}" for i in range(len(names))], [f"t{i}" for i in range(len(model.keys))]
    tree, spark = model.tree, queries.sparkSession
    group, t_blocks = _groups(tree, block_rows)
    q = queries.select(*[F.col(c).alias(n) for c, n in zip(names, q_keys)], F.col(vec).cast("array<double>").alias("q_vec"))
    blocks = F.greatest(F.lit(1), F.ceil(F.count(F.lit(1)) / F.lit(block_rows))).cast("int").alias("q_blocks")
    asked = f"{_fields(q, [*q_keys, 'q_vec'])}, grp int, leaves array<int>, bound double"

    def homes(batches):
        for b in batches:
            leaf, _, _ = tree.leaf_of(_matrix(b["q_vec"]))
            yield b.assign(grp=group[leaf], leaves=list(leaf[:, None]), bound=np.nan)

    home = q.mapInPandas(homes, asked)
    first = _search(home, home.groupBy("grp").agg(blocks), model, q_keys, t_keys, k, group, t_blocks)
    # the best of the own leaf, and its k-th distance (none while it has fewer rows). All uses below share this
    # aggregate, so its shuffle is written once
    hit = F.struct("distance", *t_keys, "t_y")
    best = first.groupBy(*q_keys).agg(F.collect_list(hit).alias("_hits")).select(
        *[F.col(c).alias(f"_{c}") for c in q_keys], F.slice(F.sort_array("_hits"), 1, k).alias("_best"))
    on = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in q_keys]
    bounded = q.join(best, on, "left").select(*q_keys, "q_vec", F.get(F.col("_best.distance"), F.lit(k - 1)).alias("bound"))

    def visits(batches):
        for b in batches:
            mat, bound = _matrix(b["q_vec"]), b["bound"].to_numpy(dtype=float)
            few = np.isnan(bound)
            if few.any():
                bound = bound.copy()
                bound[few] = tree.promised(mat[few], k)
            b = b.assign(bound=bound)
            for i, grp, leaves in _asked(group, bound, mat, tree):
                yield b.iloc[i].assign(grp=grp, leaves=leaves)[[*q_keys, "q_vec", "grp", "leaves", "bound"]]

    own = best.select(*[F.col(f"_{c}").alias(c) for c in q_keys], F.explode("_best").alias("_h")).select(
        *q_keys, *[F.col(f"_h.{c}").alias(c) for c in (*t_keys, "distance", "t_y")])
    if len(tree.pivots) > 1:
        more = bounded.mapInPandas(visits, asked)
        # a query may come to every group, so all groups have the blocks of all queries
        every = spark.createDataFrame([(g,) for g in range(len(t_blocks))], "grp int").crossJoin(q.agg(blocks))
        own = own.unionByName(_search(more, every, model, q_keys, t_keys, k, group, t_blocks))
    best = Window.partitionBy(*q_keys).orderBy("distance", *t_keys)  # a few times k rows per query
    ranked = own.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    q_out = ["q_id"] if len(names) == 1 else names
    t_out = ["t_id"] if len(model.keys) == 1 else [f"t_{c}" for c in model.keys]
    return ranked.select(*[F.col(a).alias(b) for a, b in zip(q_keys, q_out)], "rank",
                         *[F.col(a).alias(b) for a, b in zip(t_keys, t_out)], "distance", "t_y")


def knn(queries: DataFrame, train: DataFrame, k: int, q_id: str | Sequence[str] = "id", t_id: str | Sequence[str] = "id",
        q_vec: str = "vec", t_vec: str = "vec", t_y: str | None = None, block_rows: int = DEFAULT_BLOCK_ROWS,
        pivots: int | None = None) -> DataFrame:
    """:func:`fit` and :func:`search` in one call."""
    return search(queries, fit(train, t_id, t_vec, t_y, pivots), k, q_id, q_vec, block_rows)


def knn_predict(neighbours: DataFrame, keys: str | Sequence[str] = "q_id") -> DataFrame:
    """M4: uniform-weight mean of the neighbours' targets."""
    return neighbours.groupBy(*_keys(keys)).agg(F.avg("t_y").alias("y_pred"))


def knn_closeness(neighbours: DataFrame, keys: str | Sequence[str] = "q_id") -> DataFrame:
    """Sum of the k neighbour distances per query row."""
    return neighbours.groupBy(*_keys(keys)).agg(F.sum("distance").alias("closeness"))

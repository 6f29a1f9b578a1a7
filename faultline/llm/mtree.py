"""Exact top-k search by inner product in M-trees.

Integer vectors get one more coordinate that gives all of them the length of the
longest; the Euclidean distance to a query then falls as the inner product rises, so a
metric tree answers the search. Vectors near the same routing object form subtrees
of bounded size, each built in a task as pages: a node has a centre, a covering radius
and the distance to its parent's centre, a leaf page its vectors by distance to its centre.

A query first searches its home subtree; the k-th best score found there goes with it
to all others. Blocks of queries search a subtree together, best first: the page with the smallest
possible distance of any query is opened next, stored distances rule out (query, page) pairs by the
triangle inequality before any distance is computed, and of a leaf page only the vectors
whose distance to the centre fits are multiplied. The answer is exact for any subtrees.
"""

from __future__ import annotations

import heapq
import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from faultline.functions.settle import settle
from faultline.llm.shipping import send_code
from faultline.llm.vectors import answers, distinct_vectors, finite, matrix, most_common_length

#: Routing objects: a hash sample of at most about so many vectors.
ROUTERS = 64
#: Vectors of a subtree, queries of a block, and blocks that one task takes, at most about.
SUBTREE, QUERY_BLOCK, BLOCKS_PER_TASK = 2048, 512, 4
FANOUT, LEAF = 16, 256


class Node:
    """A page: centre, covering radius, distance to the parent's centre, and what it holds."""

    __slots__ = ("centre", "radius", "to_parent", "children", "child_table", "ids", "x", "far")

    def __init__(self, x: np.ndarray, ids: np.ndarray, parent: np.ndarray | None):
        self.centre = x.mean(axis=0)
        far = np.sqrt(((x - self.centre) ** 2).sum(axis=1))
        self.radius = float(far.max())
        self.to_parent = 0.0 if parent is None else float(np.sqrt(((self.centre - parent) ** 2).sum()))
        self.children: list[Node] = []
        self.child_table = self.ids = self.x = self.far = None
        if len(x) <= LEAF:
            order = np.argsort(far, kind="stable")
            self.ids, self.x, self.far = ids[order], x[order], far[order]
            return
        picks = x[np.linspace(0, len(x) - 1, FANOUT).astype(int)]
        near = ((x**2).sum(axis=1)[:, None] - 2 * x @ picks.T + (picks**2).sum(axis=1)).argmin(axis=1)
        if np.bincount(near).max() > len(x) * 0.9:  # hardly any structure: even parts by distance
            near = np.argsort(np.argsort(far, kind="stable")) * FANOUT // len(x)
        for part in np.unique(near):
            self.children.append(Node(x[near == part], ids[near == part], self.centre))
        self.child_table = (
            np.array([c.centre for c in self.children]),
            np.array([c.radius for c in self.children]),
            np.array([c.to_parent for c in self.children]),
        )


class Best:
    """The k highest scores of each query so far, ties to smaller ids; a query joins when it has any."""

    def __init__(self, queries: int, k: int, least: np.ndarray):
        self.k, self.least = k, least.astype(np.float64)
        self.q, self.ids, self.scores = (np.zeros(0, np.int64) for _ in range(3))
        self.held = np.zeros(queries, np.int64)

    def add(self, q: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        q, ids, scores = (np.concatenate(c) for c in ((self.q, q), (self.ids, ids), (self.scores, scores)))
        order = np.lexsort((ids, -scores, q))
        q = q[order]
        first = np.searchsorted(q, q)
        kept = order[np.arange(len(q)) - first < self.k]
        self.ids, self.scores = ids[kept], scores[kept]
        self.q = np.concatenate([np.zeros(0, np.int64), q[np.arange(len(q)) - first < self.k]])
        counts = np.bincount(self.q, minlength=len(self.least))
        last = np.cumsum(counts) - 1
        full = counts >= self.k
        self.least[full] = np.maximum(self.least[full], self.scores[last[full]])


def search_block(root: Node, x: np.ndarray, k: int, least: np.ndarray, longest: float) -> Best:
    """The k highest inner products of each row of x in a tree, none below its `least`.

    All queries of the block go through the pages together: stored parent distances drop (query,
    page) pairs first, then one matrix product gives the distances to the centres that are
    left, and one per leaf page the inner products. The page with the smallest possible
    distance of any query is opened first. The bounds allow for rounding, and the products are
    integers in doubles, so the answer is exact.
    """
    best = Best(len(x), k, least)
    if not len(x):
        return best
    points = np.concatenate([x, np.zeros((len(x), 1))], axis=1)
    square = (x**2).sum(axis=1)
    slack = 1e-6 * np.maximum(np.sqrt(np.maximum(square, longest)), 1.0)

    def reach(q: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(square[q] + longest - 2 * best.least[q], 0.0)) + slack[q]

    every = np.arange(len(x))
    at_root = np.sqrt(((points - root.centre) ** 2).sum(axis=1))
    queue = [(0.0, 0, every, at_root, np.maximum(at_root - root.radius, 0.0), root)]
    opened = 1
    while queue:
        _, _, q, at_centre, bound, node = heapq.heappop(queue)
        some = bound <= reach(q)
        q, at_centre = q[some], at_centre[some]
        if not len(q):
            continue
        limit = reach(q)
        if node.ids is not None:
            first = np.searchsorted(node.far, (at_centre - limit).min())
            last = np.searchsorted(node.far, (at_centre + limit).max(), side="right")
            scores = x[q] @ node.x[first:last, :-1].T
            row, column = np.nonzero(scores >= best.least[q][:, None])
            if len(row):
                found = scores[row, column].astype(np.int64)
                best.add(q[row], node.ids[first:last][column], found)
            continue
        centres, radii, to_parent = node.child_table
        # Parent distances first: |d(q, parent) - d(child, parent)| - radius is a lower bound.
        near = np.abs(at_centre[:, None] - to_parent) - radii <= limit[:, None]
        children = np.flatnonzero(near.any(axis=0))
        far = (points[q] ** 2).sum(axis=1)[:, None] - 2 * points[q] @ centres[children].T
        far = np.sqrt(np.maximum(far + (centres[children] ** 2).sum(axis=1), 0.0))
        bounds = np.maximum(far - radii[children], 0.0)
        for i, child in enumerate(children.tolist()):
            left = near[:, child] & (bounds[:, i] <= limit)
            if left.any():
                heapq.heappush(
                    queue, (float(bounds[left, i].min()), opened, q[left], far[left, i], bounds[left, i], node.children[child])
                )
                opened += 1
    return best


def lifted(x: np.ndarray, longest: float) -> np.ndarray:
    """Vectors with the coordinate that gives all of them the same length."""
    rest = np.sqrt(np.maximum(longest - (x.astype(np.float64) ** 2).sum(axis=1), 0.0))
    return np.concatenate([x.astype(np.float64), rest[:, None]], axis=1)


def top_k(
    vectors: DataFrame,
    queries: str,
    key: str = "vec_id",
    vector: str = "embedding",
    *,
    k: int = 20,
    scale: float = 64.0,
    seed: int = 31,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k highest integer inner products of each query.

    Components are floor(scale * x). Queries are the rows where `queries` holds, candidates all
    rows but the query itself; ties go to the smaller key. Null vectors, those with null or
    non-finite components, those of another length than most, and null keys take no
    part; zero vectors do. Squared lengths have to be below 2^52, which 64 components of
    16 000 * scale keep. Repeated rows count once, equal vectors under other keys are all found.
    Columns other than key, vector and those of the condition are not read.
    """
    send_code(vectors.sparkSession)
    rows = (
        vectors.select(
            F.col(key).cast("long").alias("id"),
            F.col(vector).alias("vector"),
            F.coalesce(F.expr(queries), F.lit(False)).alias("asked"),
        )
        .where(F.col("id").isNotNull() & finite("vector"))
        .withColumn(
            "vector", F.transform("vector", lambda x: F.floor(x.cast("double") * scale).cast("long"))
        )
    )
    dimensions = max(most_common_length(rows), 1)
    rows = rows.where(F.size("vector") == dimensions)
    points, members = distinct_vectors(rows, k + 1)
    square = F.aggregate("vector", F.lit(0).cast("long"), lambda s, x: s + x * x)
    total, longest = points.agg(F.count("*"), F.max(square)).first()
    longest = float(longest or 0)

    draw = F.pmod(F.xxhash64(F.lit(seed), "rep"), F.lit(1 << 30))
    share = int((1 << 30) * min(1.0, ROUTERS / max(total, 1)))
    chosen = points.where(draw < share).orderBy("rep").select("vector").toPandas()
    routers = np.array(chosen["vector"].tolist(), dtype=np.float64).reshape(-1, dimensions)
    routers = lifted(routers if len(routers) else np.zeros((1, dimensions)), longest)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column(1), dimensions)
            flat = np.concatenate([x, np.zeros((len(x), 1))], axis=1)
            norms = (routers**2).sum(axis=1)
            own = (norms - 2 * lifted(x, longest) @ routers.T).argmin(axis=1)
            home = (norms - 2 * flat @ routers.T).argmin(axis=1)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(own), pa.array(home)],
                names=["rep", "vector", "asked", "router", "home"],
            )

    routed = settle(
        points.mapInArrow(
            route, "rep long, vector array<long>, asked boolean, router long, home long"
        )
    )
    # A router with many vectors has several subtrees, small ones are merged into few: at most
    # total / SUBTREE + ROUTERS rows.
    sizes = routed.groupBy("router").agg(F.count("*").alias("n")).orderBy("router").toPandas()
    first = 0
    tree_of = np.zeros(len(routers), np.int64)
    parts_of = np.ones(len(routers), np.int64)
    filled = 0
    for router, n in zip(sizes["router"], sizes["n"], strict=True):
        if filled and filled + n > SUBTREE:
            first, filled = first + 1, 0
        tree_of[router], parts_of[router] = first, -(-n // SUBTREE)
        filled += n
        if parts_of[router] > 1:
            first, filled = first + parts_of[router], 0
    count = int(first + (filled > 0))
    table = F.array(*[F.struct(F.lit(int(t)).alias("t"), F.lit(int(p)).alias("p")) for t, p in zip(tree_of, parts_of, strict=True)])
    spot = F.element_at(table, (F.col("router") + 1).cast("int"))
    home_spot = F.element_at(table, (F.col("home") + 1).cast("int"))
    spread = F.xxhash64(F.lit(seed + 1), "rep")
    placed = routed.select(
        "rep", "vector", (spot["t"] + F.pmod(spread, spot["p"].cast("long"))).alias("tree")
    )
    asked = routed.where("asked").select(
        "rep", "vector", (home_spot["t"] + F.pmod(spread, home_spot["p"].cast("long"))).alias("home")
    )

    def build(table: pd.DataFrame) -> pd.DataFrame:
        x = np.array(table["vector"].tolist(), dtype=np.float64).reshape(-1, dimensions)
        order = np.argsort(table["rep"].to_numpy())
        root = Node(lifted(x, longest)[order], table["rep"].to_numpy()[order], None)
        return pd.DataFrame({"tree": [int(table["tree"].iloc[0])], "pages": [pickle.dumps(root)]})

    trees = settle(placed.groupBy("tree").applyInPandas(build, "tree long, pages binary"))

    def search(root: Node, reps, table, least) -> pd.DataFrame:
        best = search_block(root, table, k + 1, least, longest)
        return pd.DataFrame({"q": reps[best.q], "rep": best.ids, "score": best.scores})

    none = {"q": np.zeros(0, np.int64), "rep": np.zeros(0, np.int64), "score": np.zeros(0, np.int64)}

    def at_home(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        reps = right["rep"].to_numpy()
        x = np.array(right["vector"].tolist(), dtype=np.float64).reshape(-1, dimensions)
        if not len(left) or not len(reps):
            return pd.DataFrame(none)
        return search(pickle.loads(left["pages"].iloc[0]), reps, x, np.full(len(reps), -np.inf))

    # The queries of one home are cut into parts of bounded size.
    part = F.pmod(F.xxhash64(F.lit(seed + 2), "rep"), F.lit(max(1, -(-total // (SUBTREE * 8)))))
    homes = asked.withColumn("part", part)
    home_parts = homes.select(F.col("home").alias("tree"), F.col("part").alias("piece")).distinct()
    home_trees = trees.join(home_parts, "tree")
    started = settle(
        home_trees.groupBy("tree", "piece")
        .cogroup(homes.withColumnRenamed("home", "tree").groupBy("tree", "part"))
        .applyInPandas(at_home, "q long, rep long, score long")
    )
    ranked = Window.partitionBy("q").orderBy(F.desc("score"), "rep")
    worst = (
        started.withColumn("place", F.row_number().over(ranked))
        .where(F.col("place") == k + 1)
        .select(F.col("q").alias("rep"), F.col("score").alias("worst"))
    )
    n_blocks = max(1, -(-asked.count() // QUERY_BLOCK))
    block = F.pmod(F.xxhash64(F.lit(seed + 3), "rep"), F.lit(n_blocks))

    def to_block(table: pd.DataFrame) -> pd.DataFrame:
        x = np.array(table["vector"].tolist(), dtype=np.int64).reshape(-1, dimensions)
        worst = table["worst"].astype("float64").fillna(-np.inf).to_numpy()
        packed = pickle.dumps((table["rep"].to_numpy(), x, worst, table["home"].to_numpy()))
        return pd.DataFrame({"block": [int(table["block"].iloc[0])], "asked": [packed]})

    blocks = settle(
        asked.join(worst, "rep", "left")
        .withColumn("block", block)
        .groupBy("block")
        .applyInPandas(to_block, "block long, asked binary")
    )

    def elsewhere(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame(none)
        tree, root = int(left["tree"].iloc[0]), pickle.loads(left["pages"].iloc[0])
        out = []
        for packed in right["asked"]:
            reps, x, worst, home = pickle.loads(packed)
            other = home != tree
            out.append(search(root, reps[other], x[other].astype(np.float64), worst[other]))
        return pd.concat(out)

    supers = F.sequence(F.lit(0), F.lit((n_blocks - 1) // BLOCKS_PER_TASK))
    every_tree = F.sequence(F.lit(0).cast("long"), F.lit(max(count - 1, 0)).cast("long"))
    left = trees.select("tree", F.explode(supers).alias("super"), "pages")
    right = blocks.select(
        F.explode(every_tree).alias("tree"),
        F.floor(F.col("block") / BLOCKS_PER_TASK).cast("int").alias("super"),
        "asked",
    )
    others = (
        left.groupBy("tree", "super")
        .cogroup(right.groupBy("tree", "super"))
        .applyInPandas(elsewhere, "q long, rep long, score long")
    )
    best = settle(
        started.union(others)
        .withColumn("place", F.row_number().over(ranked))
        .where(F.col("place") <= k + 1)
        .drop("place")
    )
    query_rows = rows.where("asked").select("id", "vector").distinct()
    named = query_rows.join(
        points.where("asked").select("vector", F.col("rep").alias("q")), "vector"
    ).select("id", "q")
    return answers(named, best, members, k, ascending=False)

"""Exact top-k search by inner product with two cover trees.

Queries and candidates are dealt to blocks of points that are near each other, and each block becomes a cover tree: a
node has a centre and a covering radius that bounds the distance of all its points; children cover half the distance.
For a query node (centre p, radius r) and a candidate node (centre q, radius s) no inner product exceeds
``p.q + r|q| + s|p| + rs``.  A pair of nodes is left out if that is below the worst k-th score that the queries of the
group have so far, so nothing that belongs to a result is lost; equal scores are kept and go to the smaller id.

* Equal vectors are one point, which keeps its k + 1 smallest ids: no query can use more.  That cut is made before
  the shuffle, and so a vector that a third of all rows share costs k + 1 rows per task.
* Blocks are formed with PIVOTS points taken by hash, a fixed number; a pivot's points are dealt by hash to as many
  blocks of about BLOCK points as they need.
* Every query block first meets a block of its own pivot, which gives the k-th scores.  Then the bound chooses first
  the pivots and, under them, the candidate blocks it has to meet: blocks, not points, are paired.

Vectors that are null or have null or non-finite components take no part; neither do null ids.  Vectors are compared
with those of their own length only.  A row that is repeated counts once.
"""

from __future__ import annotations

import math
import pickle
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType
from pyspark.sql.window import Window

from txnflow.session import stored

PIVOTS, BLOCK, LEAF = 64, 4096, 24
SHARE, MOST_ROOTS = 16, 4096
NOTHING = -(2**62)  # below every score


@dataclass
class Node:
    """``loose``: points of the node in no child; ``points``: all its points."""

    centre: np.ndarray
    radius: float
    points: np.ndarray
    loose: np.ndarray
    children: list[Node] = field(default_factory=list)

    def plain(self) -> tuple:
        """The tree as tuples, for pickling."""
        return self.centre, self.radius, self.points, self.loose, [c.plain() for c in self.children]


def node(centre, radius, points, loose, children) -> Node:
    return Node(centre, radius, points, loose, [node(*c) for c in children])


def cover_tree(x: np.ndarray, points: np.ndarray, centre: int, reach: float | None = None) -> Node:
    """The tree of the given rows of x.  Children of fewer than LEAF points stay loose in their parent."""
    distance = np.sqrt(((x[points] - x[centre]) ** 2).sum(1))
    top = Node(x[centre], float(distance.max()), points, points)
    if len(points) <= LEAF or top.radius == 0:
        return top
    half = 2.0 ** math.floor(math.log2(min(top.radius, reach or top.radius))) / 2
    rest, away, groups = points, distance, []
    while len(rest):
        head = centre if not groups else int(rest[np.argmax(away)])
        gap = np.sqrt(((x[rest] - x[head]) ** 2).sum(1))
        near = gap <= half
        groups.append((head, rest[near]))
        rest, away = rest[~near], np.minimum(away, gap)[~near]
    large = [g for g in groups if len(g[1]) >= LEAF]
    top.children = [cover_tree(x, own, head, half) for head, own in large]
    small = [own for _, own in groups if len(own) < LEAF]
    top.loose = np.concatenate(small) if small else points[:0]
    return top


def bound(a: Node, b: Node) -> float:
    """No inner product between points of a and b is larger (the last term covers rounding)."""
    p, q = float(np.sqrt(a.centre @ a.centre)), float(np.sqrt(b.centre @ b.centre))
    value = float(a.centre @ b.centre) + a.radius * q + b.radius * p + a.radius * b.radius
    return value + 1e-9 * (1 + abs(value))


class Tops:
    """The k best (score, id) of each query, larger scores and then smaller ids first."""

    def __init__(self, queries: int, k: int):
        self.scores = np.full((queries, k), NOTHING, np.int64)
        self.ids = np.full((queries, k), np.iinfo(np.int64).max, np.int64)

    def offer(self, queries: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        """``scores`` has a row per query and a column per id."""
        k = self.scores.shape[1]
        good = scores >= self.scores[queries, -1][:, None]
        for row in np.flatnonzero(good.any(1)):
            q, own = queries[row], good[row]
            s, i = np.r_[self.scores[q], scores[row, own]], np.r_[self.ids[q], ids[own]]
            best = np.lexsort((i, -s))[:k]
            self.scores[q], self.ids[q] = s[best], i[best]


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of integer vectors."""
    largest = max(np.abs(a).max(initial=0), np.abs(b).max(initial=0))
    if float(largest) ** 2 * max(1, a.shape[1]) < 2**53:
        return (a.astype(float) @ b.T.astype(float)).astype(np.int64)
    return a @ b.T


def dual_search(x: np.ndarray, queries: Node, y: np.ndarray, candidates: Node, id_lists: list, tops: Tops) -> None:
    """Offer every candidate that can be among a query's best: depth first, promising pairs of nodes first."""
    sizes = np.fromiter(map(len, id_lists), np.int64, len(id_lists))
    stack = [(queries, candidates)]
    while stack:
        q, c = stack.pop()
        if bound(q, c) < tops.scores[q.points, -1].min():
            continue
        if q.children and q.radius > c.radius:
            parts = list(q.children)
            if len(q.loose):
                parts.append(Node(q.centre, q.radius, q.loose, q.loose))
            stack += sorted(((p, c) for p in parts), key=lambda pair: bound(*pair))
            continue
        if len(c.loose):
            ids = np.concatenate([id_lists[i] for i in c.loose])
            scores = product(x[q.points], y[c.loose])
            tops.offer(q.points, np.repeat(scores, sizes[c.loose], axis=1), ids)
        stack += sorted(((q, child) for child in c.children), key=lambda pair: bound(*pair))


def integer_vector(vector: Column) -> Column:
    """floor(64 * x) of each component; null if the vector or a component is null or not finite."""
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when(good, F.transform(vector, lambda x: F.floor(x.cast("double") * 64).cast("long")))


def _blocks(points: DataFrame, pivots: DataFrame, size: int, fields: list[str]) -> DataFrame:
    """The points in blocks: (dim, pivot, part, tree), one row each; tree is pickled (x, ids, node, vids)."""
    centres = [(r.vid, len(r.vector), np.array(r.vector, float)) for r in pivots.toLocalIterator()]

    def near(batches):
        for batch in batches:
            pivot = np.zeros(batch.num_rows, np.int64)
            vectors = batch.column("vector").to_pylist()
            lengths = np.fromiter(map(len, vectors), np.int64, len(vectors))
            for n in np.unique(lengths):
                at = np.flatnonzero(lengths == n)
                x = np.array([vectors[i] for i in at], float).reshape(len(at), n)
                own = [(i, c) for i, (_, m, c) in enumerate(centres) if m == n]
                if own:
                    gaps = np.stack([((x - c) ** 2).sum(1) for _, c in own], 1)
                    pivot[at] = np.array([i for i, _ in own])[gaps.argmin(1)]
            yield batch.append_column("pivot", pa.array(pivot))

    kept = points.select("vid", "vector", *fields).withColumn("dim", F.size("vector"))
    schema = StructType([*kept.schema.fields, StructField("pivot", LongType())])
    dealt = stored(kept.mapInArrow(near, schema), "dealt-points")
    parts = dealt.groupBy("dim", "pivot").agg(F.ceil(F.count("*") / size).alias("parts"))
    dealt = dealt.join(F.broadcast(parts), ["dim", "pivot"])  # as many rows as pivots and lengths
    dealt = dealt.withColumn("part", F.pmod(F.xxhash64("vid"), F.col("parts")))

    def grow(table: pa.Table) -> pa.Table:
        order = np.argsort(np.array(table.column("vid").to_pylist()), kind="stable")
        table = table.take(order)
        x = np.array(table.column("vector").to_pylist(), np.int64).reshape(len(order), -1)
        ids = [np.array(i, np.int64) for i in table.column("ids").to_pylist()] if "ids" in fields else []
        tree = cover_tree(x.astype(float), np.arange(len(x)), 0)
        head = {c: table.column(c)[:1] for c in ("dim", "pivot", "part")}
        packed = pickle.dumps((x, ids, tree.plain(), table.column("vid").to_pylist()))
        more = {"centre": pa.array([tree.centre.tolist()]), "radius": pa.array([tree.radius]), "tree": pa.array([packed])}
        return pa.table(head | more)

    made = "dim int, pivot long, part long, centre array<double>, radius double, tree binary"
    return dealt.groupBy("dim", "pivot", "part").applyInArrow(grow, made)


def _search(pairs: DataFrame, k: int) -> DataFrame:
    """(vid, scores, ids) of each query point for pairs of blocks (query_tree, tree, least: k-th scores so far)."""

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                x, _, queries, vids = pickle.loads(batch.column("query_tree")[i].as_py())
                y, ids, candidates, _ = pickle.loads(batch.column("tree")[i].as_py())
                tops = Tops(len(x), k)
                least = batch.column("least")[i].as_py()
                if least is not None:
                    tops.scores[:, -1] = np.frombuffer(least, "<i8")
                dual_search(x, node(*queries), y, node(*candidates), ids, tops)
                real = tops.ids < np.iinfo(np.int64).max
                columns = [[t[r].tolist() for t, r in zip(a, real, strict=True)] for a in (tops.scores, tops.ids)]
                last = tops.scores[:, -1].astype("<i8").tobytes()
                at = [batch.column(c)[i].as_py() for c in ("dim", "pivot", "part")]
                names = ["dim", "pivot", "part", "vid", "scores", "ids", "least"]
                values = [*([a] * len(x) for a in at), vids, *columns, [last, *[None] * (len(x) - 1)]]
                types = [pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, types, strict=True)], names)

    made = "dim int, pivot long, part long, vid string, scores array<long>, ids array<long>, least binary"
    return pairs.select("dim", "pivot", "part", "query_tree", "tree", "least").mapInArrow(run, made)


def _dot(a, b) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def _norm(a) -> Column:
    return F.sqrt(_dot(a, a))


def _most(centre: str, radius: str, other: str, reach: str) -> Column:
    """``bound`` as a column."""
    r, s = F.col(radius), F.col(reach)
    most = _dot(centre, other) + r * _norm(other) + s * _norm(centre) + r * s
    return most + 1e-6 * (1 + F.abs(most))


def _pairs(heads: DataFrame, data: DataFrame) -> DataFrame:
    """(dim, pivot, part, c_pivot, c_part): the blocks that each query block has to meet besides its first one.

    The blocks of a pivot have a common root, and a query block first meets the roots: one per pivot and, for lengths
    without a pivot, one per length.  Only under a root that may matter is it paired with blocks, SHARE of them a key,
    so a pivot's blocks are many tasks' work however many it has.
    """
    blocks = data.select("dim", F.col("pivot").alias("c_pivot"), F.col("part").alias("c_part"), F.col("centre").alias("c_centre"), F.col("radius").alias("c_radius"))
    first = blocks.groupBy("dim", "c_pivot").agg(F.min_by("c_centre", "c_part").alias("root"), F.max("c_part").alias("last"))
    gap = F.zip_with("c_centre", "root", lambda x, y: x - y)
    reach = F.max(_norm(gap) + F.col("c_radius")) * (1 + 1e-9)
    reach = blocks.join(first, ["dim", "c_pivot"]).groupBy("dim", "c_pivot").agg(reach.alias("reach"))
    roots = stored(first.join(reach, ["dim", "c_pivot"]), "roots")
    few = roots.count() <= MOST_ROOTS  # beyond, lengths are many and deal the join
    near = heads.join(F.broadcast(roots) if few else roots, "dim").filter(_most("centre", "radius", "root", "reach") >= F.col("worst"))
    shares = F.sequence(F.lit(0).cast("long"), F.floor(F.col("last") / SHARE))
    near = near.drop("root", "reach").withColumn("share", F.explode(shares))
    met = near.join(blocks.withColumn("share", F.floor(F.col("c_part") / SHARE)), ["dim", "c_pivot", "share"])
    met = met.filter("not (pivot = c_pivot and c_part = 0)").filter(_most("centre", "radius", "c_centre", "c_radius") >= F.col("worst"))
    return met.select("dim", "pivot", "part", "c_pivot", "c_part")


def top_k(rows: DataFrame, is_query: Column, k: int = 20, vector: str = "embedding", key: str = "vec_id") -> DataFrame:
    """(query_id, rank, key, score): each query row's k largest inner products with the other rows."""
    points = rows.select(F.col(key).cast("long").alias("id"), integer_vector(F.col(vector)).alias("vector"), is_query.alias("asked"))
    points = points.filter("id is not null and vector is not null").distinct()
    points = points.withColumn("vid", F.sha2(F.array_join(F.col("vector").cast("array<string>"), ","), 256))
    points = stored(points, "points")
    first = Window.partitionBy("vid").orderBy("id")
    few = points.withColumn("n", F.row_number().over(first)).filter(F.col("n") <= k + 1)
    distinct = few.groupBy("vid").agg(F.first("vector").alias("vector"), F.sort_array(F.collect_list("id")).alias("ids"))
    distinct = stored(distinct, "distinct-points")
    asked = stored(points.filter("asked").select("vid").distinct().join(distinct, "vid").select("vid", "vector"), "query-points")
    pivots = distinct.orderBy("vid").limit(PIVOTS).select("vid", "vector")

    data = stored(_blocks(distinct, pivots, BLOCK, ["ids"]), "candidate-trees")
    own = stored(_blocks(asked, pivots, BLOCK, []).withColumnRenamed("tree", "query_tree"), "query-trees")
    home = own.join(data.filter("part = 0").select("dim", "pivot", "tree"), ["dim", "pivot"])
    begun = stored(_search(home.withColumn("least", F.lit(None).cast("binary")), k + 1), "first-scores")

    least = F.min(F.when(F.size("scores") > k, F.element_at("scores", -1)).otherwise(F.lit(NOTHING)))
    so_far = begun.groupBy("dim", "pivot", "part").agg(least.alias("worst"), F.max("least").alias("least"))
    heads = own.select("dim", "pivot", "part", "centre", "radius").join(so_far.drop("least"), ["dim", "pivot", "part"])
    pairs = _pairs(heads, data)
    asking = own.select("dim", "pivot", "part", "query_tree").join(so_far.drop("worst"), ["dim", "pivot", "part"])
    pairs = pairs.join(asking, ["dim", "pivot", "part"])
    trees = data.select("dim", F.col("pivot").alias("c_pivot"), F.col("part").alias("c_part"), "tree")
    more = _search(pairs.join(trees, ["dim", "c_pivot", "c_part"]), k + 1)

    found = begun.select("vid", "scores", "ids").union(more.select("vid", "scores", "ids"))
    found = found.select("vid", F.explode(F.arrays_zip("scores", "ids")).alias("f")).select("vid", "f.scores", "f.ids")
    best = Window.partitionBy("vid").orderBy(F.desc("scores"), "ids")
    found = stored(found.withColumn("n", F.row_number().over(best)).filter(F.col("n") <= k + 1), "found")
    queries = points.filter("asked").select(F.col("id").alias("query_id"), "vid")
    ranked = queries.join(found, "vid").filter("query_id <> ids")
    rank = F.row_number().over(Window.partitionBy("query_id", "vid").orderBy("n"))
    ranked = ranked.withColumn("rank", rank).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", F.col("ids").alias(key), F.col("scores").alias("score"))

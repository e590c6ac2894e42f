"""Merkle manifest of a table with octopus multiproofs.

Each row is a leaf, the sha256 of its columns.  The leaves of a group, by key, form a tree of runs of ``FAN`` nodes, and
the roots of the groups, by group, form the tree above them.  A row's proof are its siblings on the way to the root.

1. Leaves are computed where the texts are read; only digests move from there on.  They are sorted over all partitions
   by (group, key, leaf), so a group of any size is spread, and numbered from the counts of the partitions.
2. Aligned blocks of BLOCK = FAN ** HEIGHT leaves are dealt to leaf partitions: chunks of less than 2 * BLOCK leaves
   that follow each other, so a chunk holds many small groups or a part of a large one.
3. A chunk gives the roots of its blocks.  Levels above are built from blocks of BLOCK nodes in the same way; a round
   has 1 / BLOCK of the nodes of the one before.
4. Each chunk computes the coordinates (tree, level, index) that all its proofs need together and that do not follow
   from its own leaves: for runs of neighbours these are a few nodes at either edge of each level.  One join fetches
   them.  The chunk derives shared interiors once and expands the proofs of its leaves.

A null column counts as ``-``; null groups come first, null keys too.  Rows with one key are leaves each, by their
digest; equal rows are interchangeable.  An empty table gives no rows.  The driver holds the number of leaves and of
groups that begin in each partition, and no digest.
"""

from __future__ import annotations

import hashlib
from binascii import hexlify, unhexlify
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from txnflow.session import stored

FAN, HEIGHT = 3, 7
TOP = -1  # the number of the tree above the groups

NODES = "tree long, size long, level int, index long, digest binary"


def encoded(column: Column) -> Column:
    """The column as it enters a digest: UTF-8 byte count, colon and value; ``-`` if null."""
    text = column.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(columns: list[Column]) -> Column:
    return F.sha2(F.concat(*[encoded(c) for c in columns]).cast("binary"), 256)


def run_digest(run: list[bytes]) -> bytes:
    return hashlib.sha256(b"".join(run)).hexdigest().encode()


def height(size: int) -> int:
    """The number of levels above the leaves of a tree."""
    levels = 0
    while size > 1:
        size, levels = -(-size // FAN), levels + 1
    return levels


def missing(known: np.ndarray, size: int, level: int = 0) -> Iterator[tuple[int, np.ndarray]]:
    """(level, indices) of the fewest nodes that, with the known ones of ``level`` (sorted), give the proofs of all.

    ``size`` is the number of nodes at that level.  Known nodes give their parents, so a sibling is asked for only
    where no known node lies below it.
    """
    while size > 1:
        runs = np.unique(known // FAN)
        members = (runs[:, None] * FAN + np.arange(FAN)).ravel()
        members = members[members < size]
        yield level, np.setdiff1d(members, known, assume_unique=True)
        known, size, level = runs, -(-size // FAN), level + 1


def lifted(first: int, nodes: list[bytes], size: int, levels: int) -> list[tuple[int, list[bytes]]]:
    """Per level above: first index and digests, from a block of neighbours whose first index divides evenly."""
    out = []
    while levels and size > 1:
        nodes = [run_digest(nodes[i : i + FAN]) for i in range(0, len(nodes), FAN)]
        first, size, levels = first // FAN, -(-size // FAN), levels - 1
        out.append((first, nodes))
    return out


class Tree:
    """The known part of a tree: per level the digests by index, filled upwards from known and fetched nodes."""

    def __init__(self, size: int, known: dict[int, bytes], fetched: dict[tuple[int, int], bytes]):
        self.siblings: list[dict[int, tuple[bytes, bytes]]] = []
        level = 0
        while size > 1:
            around, parents = {}, {}
            for run in sorted({i // FAN for i in known}):
                places = range(run * FAN, min(run * FAN + FAN, size))
                own = [known[i] if i in known else fetched[level, i] for i in places]
                parents[run] = run_digest(own)
                for at, i in enumerate(places):
                    if i in known:
                        around[i] = (b"".join(own[:at]), b"".join(own[at + 1 :]))
            self.siblings.append(around)
            known, size, level = parents, -(-size // FAN), level + 1
        self.root = known[0]

    def path(self, index: int) -> list[tuple[bytes, bytes]]:
        """What stands left and right of the node and its ancestors in their runs."""
        out = []
        for around in self.siblings:
            out.append(around[index])
            index //= FAN
        return out


def folded(digest: bytes, path: list[tuple[bytes, bytes]]) -> bytes:
    for left, right in path:
        digest = hashlib.sha256(left + digest + right).hexdigest().encode()
    return digest


def _numbered(leaves: DataFrame) -> tuple[DataFrame, int]:
    """(tree, size, position, chunk, key, leaf, other) of rows (group, key, leaf, other, row); the number of trees."""
    spark, block = leaves.sparkSession, FAN**HEIGHT
    order = ["group", "key", "leaf", "row"]
    cut = leaves.repartitionByRange(*order).sortWithinPartitions(*order)
    cut = cut.withColumn("at", F.monotonically_increasing_id())  # the partition above 33 bits of the place in it
    cut = stored(cut.select("group", "key", "leaf", "other", F.shiftright("at", 33).alias("part"), F.expr("at & 8589934591").alias("at")), "merkle-leaves")
    held = stored(cut.groupBy("part", "group").agg(F.min("at").alias("at"), F.count("*").alias("n")), "merkle-parts")
    counts = held.groupBy("part").agg(F.sum("n").alias("n")).orderBy("part").collect()  # a row per partition
    starts = dict(zip([r.part for r in counts], np.cumsum([0, *(r.n for r in counts)]).tolist(), strict=False))
    offsets = spark.createDataFrame(list(starts.items()), "part long, offset long")
    held = held.join(F.broadcast(offsets), "part").withColumn("first", F.col("offset") + F.col("at"))
    trees = held.groupBy("group").agg(F.min("first").alias("first"), F.sum("n").alias("size"), F.min("part").alias("home"))
    trees = stored(trees, "merkle-groups")
    begun = trees.groupBy("home").agg(F.count("*").alias("n")).orderBy("home").collect()  # a row per partition
    before = dict(zip([r.home for r in begun], np.cumsum([0, *(r.n for r in begun)]).tolist(), strict=False))
    before_rows = spark.createDataFrame(list(before.items()), "home long, before long")
    number = F.row_number().over(Window.partitionBy("home").orderBy("first")) - 1 + F.col("before")
    trees = trees.join(F.broadcast(before_rows), "home").withColumn("tree", number)
    same = F.col("t.group").eqNullSafe(F.col("h.group"))
    places = held.alias("h").join(trees.alias("t"), same).select("h.part", "h.group", "offset", "t.first", "t.size", "t.tree")
    joined = cut.alias("c").join(places.alias("p"), (F.col("c.part") == F.col("p.part")) & F.col("c.group").eqNullSafe(F.col("p.group")))
    position = F.col("offset") + F.col("at") - F.col("first")
    begins = F.col("first") + position - position % block
    numbered = joined.select("tree", "size", position.alias("position"), begins.alias("begins"), "key", "leaf", "other")
    numbered = numbered.withColumn("chunk", F.expr(f"begins div {block}")).drop("begins")
    return numbered, sum(r.n for r in begun)


def _segments(batch: pa.RecordBatch) -> Iterator[tuple[int, list]]:
    """Per row of a batch of chunks, the trees in it: (tree, size, first and past-the-last place in the row's lists)."""
    for row in range(batch.num_rows):
        tree = batch.column("tree")[row].values.to_numpy()
        size = batch.column("size")[row].values.to_numpy()
        cuts = np.flatnonzero(np.r_[True, tree[1:] != tree[:-1], True]) if len(tree) else np.zeros(1, np.int64)
        yield row, [(int(tree[a]), int(size[a]), int(a), int(b)) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def _nodes(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary()]
    columns = zip(*rows, strict=True) if rows else [[]] * 5
    arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, ["tree", "size", "level", "index", "digest"])


def _block_roots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    block = FAN**HEIGHT
    for batch in batches:
        out = []
        for row, trees in _segments(batch):
            place = batch.column("position")[row].values.to_numpy()
            digests = [hexlify(d) for d in batch.column("leaf")[row].values.to_pylist()]
            for tree, size, lo, hi in trees:
                for a in range(lo, hi, block):
                    own = digests[a : min(a + block, hi)]
                    above = lifted(int(place[a]), own, size, HEIGHT)
                    first, nodes = above[-1] if above else (int(place[a]), own)
                    out.append((tree, size, len(above), first, unhexlify(nodes[0])))
        yield _nodes(out)


def _lift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From blocks of neighbours of one level, the nodes of the HEIGHT levels above them."""
    for batch in batches:
        out = []
        for tree, size, level, nodes in zip(*(batch.column(c).to_pylist() for c in ("tree", "size", "level", "nodes")), strict=True):
            nodes.sort(key=lambda n: n["index"])
            here = size
            for _ in range(level):
                here = -(-here // FAN)
            for up, (first, digests) in enumerate(lifted(nodes[0]["index"], [hexlify(n["digest"]) for n in nodes], here, HEIGHT), 1):
                out += [(tree, size, level + up, first + i, unhexlify(d)) for i, d in enumerate(digests)]
        yield _nodes(out)


def _upward(nodes: DataFrame, level: int, top: int) -> DataFrame:
    """The nodes with all those above them; ``level`` is that of the nodes, ``top`` the highest of any tree."""
    known, newest = [nodes], nodes
    while level < top:
        blocks = newest.filter(F.col("level") == level)
        blocks = blocks.groupBy("tree", "size", "level", F.expr(f"index div {FAN**HEIGHT}").alias("block"))
        blocks = blocks.agg(F.collect_list(F.struct("index", "digest")).alias("nodes"))
        newest = stored(blocks.mapInArrow(_lift, NODES), "merkle-nodes")
        known.append(newest)
        level += HEIGHT
    out = known[0]
    for more in known[1:]:
        out = out.unionByName(more)
    return out


def _wanted(trees: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row, held in _segments(batch):
                chunk = batch.column("chunk")[row].as_py()
                place = batch.column("position")[row].values.to_numpy()
                for tree, size, lo, hi in held:
                    if hi - lo < size:
                        out += [(chunk, tree, lv, int(i)) for lv, at in missing(place[lo:hi], size) for i in at]
                own = np.array([t for t, *_ in held], np.int64)
                out += [(chunk, TOP, lv, int(i)) for lv, at in missing(own, trees) for i in at]
            columns = zip(*out, strict=True) if out else [[]] * 4
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["chunk", "tree", "level", "index"])

    return run


def _expand(trees: int):
    names = ["key", "leaf", "subroot", "root", "proof_sha256", "folded_root"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, held in _segments(batch):
                place = batch.column("position")[row].values.to_pylist()
                leaves = [hexlify(d) for d in batch.column("leaf")[row].values.to_pylist()]
                others = batch.column("other")[row].values.to_pylist()
                keys = batch.column("key")[row].values
                fetched: dict[int, dict] = {}
                for n in batch.column("fetched")[row].as_py() or ():
                    fetched.setdefault(n["tree"], {})[n["level"], n["index"]] = hexlify(n["digest"])
                own = {t: Tree(size, dict(zip(place[lo:hi], leaves[lo:hi], strict=True)), fetched.get(t, {})) for t, size, lo, hi in held}
                top = Tree(trees, {t: x.root for t, x in own.items()}, fetched.get(TOP, {}))
                root = top.root.decode()
                columns: list[list] = [[] for _ in names[1:]]
                for t, _, lo, hi in held:
                    above = top.path(t)
                    for i in range(lo, hi):
                        path = own[t].path(place[i]) + above
                        digest = leaves[i] if others[i] is None else hexlify(others[i])
                        proof = hashlib.sha256(b"".join(p for both in path for p in both)).hexdigest()
                        values = (leaves[i].decode(), own[t].root.decode(), root, proof, folded(digest, path).decode())
                        for column, value in zip(columns, values, strict=True):
                            column.append(value)
                yield pa.RecordBatch.from_arrays([keys, *(pa.array(c, pa.string()) for c in columns)], names)

    return run


def manifest(
    docs: DataFrame,
    columns: list[str],
    group: str = "source",
    key: str = "doc_id",
    claimed: dict[str, Column] | None = None,
    doubt: Column | None = None,
) -> DataFrame:
    """(key, leaf, subroot, root, proof_sha256, folded_root, verified) of every row; a leaf is the digest of ``columns``.

    Where ``doubt`` holds, the proof is checked against the leaf of the ``claimed`` columns in place of the row's own.
    ``verified`` tells if the proof leads to the root.
    """
    own, other = [F.col(c) for c in columns], F.lit(None).cast("binary")
    if doubt is not None:
        other = F.when(doubt, F.unhex(leaf([(claimed or {}).get(c, F.col(c)) for c in columns])))
    leaves = docs.select(
        F.col(group).cast("string").alias("group"), F.col(key).alias("key"), F.unhex(leaf(own)).alias("leaf"), other.alias("other")
    )
    leaves = stored(leaves.withColumn("row", F.monotonically_increasing_id()), "merkle-rows")  # equal rows need not meet
    numbered, trees = _numbered(leaves)
    entry = F.struct("tree", "position", "size", "key", "leaf", "other")
    chunks = numbered.groupBy("chunk").agg(F.sort_array(F.collect_list(entry)).alias("e"))
    parts = [F.col(f"e.{c}").alias(c) for c in ("tree", "size", "position", "key", "leaf", "other")]
    chunks = stored(chunks.select("chunk", *parts), "merkle-chunks")

    roots = stored(chunks.select("tree", "size", "position", "leaf").mapInArrow(_block_roots, NODES), "merkle-nodes")
    nodes = _upward(roots, HEIGHT, height(roots.agg(F.max("size")).first()[0] or 0))
    subroots = nodes.filter("index = 0").groupBy("tree").agg(F.max_by("digest", "level").alias("digest"))
    subroots = subroots.select(
        F.lit(TOP).cast("long").alias("tree"), F.lit(trees).cast("long").alias("size"), F.lit(0).alias("level"), F.col("tree").alias("index"), "digest"
    )
    nodes = nodes.unionByName(_upward(stored(subroots, "merkle-nodes"), 0, height(trees)))

    wanted = chunks.select("chunk", "tree", "size", "position").mapInArrow(_wanted(trees), "chunk long, tree long, level int, index long")
    fetched = wanted.join(nodes.drop("size"), ["tree", "level", "index"])
    fetched = fetched.groupBy("chunk").agg(F.collect_list(F.struct("tree", "level", "index", "digest")).alias("fetched"))
    kind = docs.schema[key].dataType.simpleString()
    texts = ("leaf", "subroot", "root", "proof_sha256", "folded_root")
    proofs = chunks.join(fetched, "chunk", "left").mapInArrow(_expand(trees), f"key {kind}, " + ", ".join(f"{c} string" for c in texts))
    return proofs.select(F.col("key").alias(key), *texts, (F.col("folded_root") == F.col("root")).alias("verified"))

"""Merkle manifest of a table, and octopus multiproofs of its rows.

Every row is a leaf; the rows of a group (a language) form one tree in the order of their ids, and the trees' roots, in the
order of the groups, form the top tree. A node is the hash of up to eight consecutive children. Leaves are numbered without
a task per tree: they are dealt by ranges and counted per partition. Nodes are made in blocks of 8^4 leaves, so a tree of a
hundred billion leaves takes three passes.

A proof of one row is the list of its path's siblings. Rows are proved by pieces of consecutive leaves: a piece computes the
least set of node coordinates that its own leaves don't give (the octopus), fetches these in one join, derives the inner
nodes that its rows share, and writes each row's own proof from them.

Defined results: an empty or null text, group or any other null field is a leaf like others (``-`` stands for null). Null
ids come first, equal ids are ordered by their leaf hash, and rows that are equal throughout are interchangeable. Long texts
are hashed whole where they are read and never moved. An empty table has no root and no proofs. Other columns play no role.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import chain, groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickfold.llm.common import narrow_join
from tickfold.session import stage

ARITY = 8
#: Levels that one pass builds: a task holds blocks of ARITY ** BLOCK_LEVELS children.
BLOCK_LEVELS = 4
#: Leaves of a piece are at most 2 ** PIECE_BITS.
PIECE_BITS = 13
#: The tree above all groups; groups are "" (null) or "=" and their value.
TOP = "^"
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


@dataclass(frozen=True)
class Manifest:
    #: id, tree, idx, n (leaves of the tree), rank (of the tree), leaf, changed, piece
    leaves: DataFrame
    #: tree, level, idx, hash: all nodes, the leaves as level 0
    nodes: DataFrame
    #: tree, n, rank, subroot
    trees: DataFrame
    root: bytes | None
    n_trees: int


def field(value: Column) -> Column:
    """``-`` for null, else the length in bytes, a colon and the value."""
    value = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaf(values: Sequence[Column]) -> Column:
    return F.unhex(F.sha2(F.concat(*map(field, values)), 256))


def tree_key(group: Column) -> Column:
    """Never null, and sorted as the group is: null first, then by bytes."""
    return F.coalesce(F.concat(F.lit("="), group.cast("string")), F.lit(""))


def digest(children: Sequence[bytes]) -> bytes:
    return hashlib.sha256(b"".join(children).hex().encode()).digest()


def numbered(df: DataFrame, group: list[str], order: list[Column], name: str) -> DataFrame:
    """A written copy of ``df`` in order, with ``row`` (ascending) and ``idx``, the position from 0 within the group.

    Rows are dealt by ranges of (group, order); rows equal in all of that are told apart by a number, so they can share
    partitions with others. Counts per partition and group give the offsets: a group has at most as many of them as there are
    partitions.
    """
    keys = [*map(F.col, group), *order]
    dealt = df.withColumn("row", F.monotonically_increasing_id()).repartitionByRange(*keys, "row").sortWithinPartitions(*keys, "row")
    rows = stage(dealt.withColumn("row", F.monotonically_increasing_id()), name).withColumn("part", F.shiftright("row", 33))
    counts = rows.groupBy(*group, "part").agg(F.min("row").alias("first"), F.count("*").alias("held"))
    before = F.sum("held").over(Window.partitionBy(*group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = stage(counts.withColumn("before", F.coalesce(before, F.lit(0))), f"{name}-offsets")
    placed = narrow_join(rows, offsets.drop("held"), [*group, "part"], "inner", offsets.count())
    return placed.withColumn("idx", F.expr("row - first + before")).drop("part", "first", "before")


def lifted(levels: int):
    """(tree, block, idx, n, hash) in order -> the nodes of the next levels as (tree, level, idx, n, hash)."""
    kinds = {"tree": pa.string(), "level": pa.int32(), "idx": pa.int64(), "n": pa.int64(), "hash": pa.binary()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        rows = chain.from_iterable(zip(*batch.to_pydict().values()) for batch in batches)
        for (tree, _), block in groupby(rows, lambda r: r[:2]):
            block = list(block)
            first, n, hashes = block[0][2], block[0][3], [r[4] for r in block]
            for level in range(1, levels + 1):
                if n == 1:
                    break
                hashes = [digest(hashes[i : i + ARITY]) for i in range(0, len(hashes), ARITY)]
                first, n = first // ARITY, -(-n // ARITY)
                out += [(tree, level, first + i, n, h) for i, h in enumerate(hashes)]
            if len(out) > 20_000:
                yield as_batch(out, kinds)
                out = []
        if out:
            yield as_batch(out, kinds)

    return run


def as_batch(rows: list[tuple], kinds: dict[str, pa.DataType]) -> pa.RecordBatch:
    columns = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds.values())], names=list(kinds))


def inner_nodes(leaves: DataFrame, most: int, name: str, levels: int = BLOCK_LEVELS) -> list[DataFrame]:
    """Written tables of the nodes above ``leaves`` (tree, idx, n, hash), as (tree, level, idx, n, hash)."""
    tables: list[DataFrame] = []
    below, base = leaves.filter("n > 1"), 0
    while most > 1:
        block = F.shiftright("idx", 3 * levels).alias("block")
        dealt = below.select("tree", block, "idx", "n", "hash").repartition("tree", "block").sortWithinPartitions("tree", "block", "idx")
        made = dealt.mapInArrow(lifted(levels), "tree string, level int, idx long, n long, hash binary")
        made = stage(made.withColumn("level", (F.col("level") + base).cast("int")), f"{name}-{base}")
        tables.append(made)
        base += levels
        most = -(-most // ARITY**levels)
        below = made.filter((F.col("level") == base) & (F.col("n") > 1)).drop("level")
    return tables


def manifest(
    docs: DataFrame,
    fields: Sequence[str] = FIELDS,
    group: str = "lang",
    order: str = "doc_id",
    changed: Column | None = None,
    block_levels: int = BLOCK_LEVELS,
    piece_bits: int = PIECE_BITS,
) -> Manifest:
    """The trees over ``docs``. ``changed`` is an optional second leaf hash of a row (null: as it is), folded in the proofs."""
    if changed is None:
        changed = F.lit(None).cast("binary")
    thin = docs.select(
        F.col(order).alias("id"), tree_key(F.col(group)).alias("tree"), leaf([F.col(c) for c in fields]).alias("leaf"), changed.alias("changed")
    )
    placed = numbered(stage(thin, "merkle-leaves"), ["tree"], [F.asc_nulls_first("id"), F.col("leaf")], "merkle-order")
    sizes = stage(placed.groupBy("tree").agg(F.count("*").alias("n")), "merkle-sizes")
    ranks = numbered(sizes, [], [F.col("tree")], "merkle-ranks").select("tree", "n", F.col("idx").alias("rank"))
    n_trees, most = sizes.agg(F.count("*"), F.coalesce(F.max("n"), F.lit(0))).first()
    leaves = narrow_join(placed, ranks, "tree", "inner", n_trees).withColumn("piece", F.shiftright("row", piece_bits)).drop("row")
    zero = leaves.select("tree", F.lit(0).alias("level"), "idx", "n", F.col("leaf").alias("hash"))
    nodes = zero
    for made in inner_nodes(zero.drop("level"), most, "merkle-nodes", block_levels):
        nodes = nodes.unionByName(made)
    subroots = nodes.filter("n = 1").select("tree", F.col("hash").alias("subroot"))
    trees = stage(narrow_join(ranks, subroots, "tree", "inner", n_trees), "merkle-trees")
    top = trees.select(F.lit(TOP).alias("tree"), F.lit(0).alias("level"), F.col("rank").alias("idx"), F.lit(n_trees).cast("long").alias("n"), F.col("subroot").alias("hash"))
    above = top
    for made in inner_nodes(top.drop("level"), n_trees, "merkle-top", block_levels):
        above = above.unionByName(made)
    root = above.filter("n = 1").select("hash").first()
    return Manifest(leaves, nodes.unionByName(above).drop("n"), trees, bytes(root[0]) if root else None, n_trees)


def missing(known: np.ndarray, n: int) -> list[np.ndarray]:
    """By level, the least set of nodes of a tree with ``n`` leaves that give its root together with the leaves ``known``."""
    levels = []
    while n > 1:
        parents = np.unique(known // ARITY)
        children = (parents[:, None] * ARITY + np.arange(ARITY)).ravel()
        levels.append(np.setdiff1d(children[children < n], known))
        known, n = parents, -(-n // ARITY)
    return levels


def requests(n_trees: int):
    """(piece, tree, idx, n, rank) in order -> the coordinates that each piece lacks."""
    kinds = {"piece": pa.int64(), "tree": pa.string(), "level": pa.int32(), "idx": pa.int64()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = chain.from_iterable(zip(*batch.to_pydict().values()) for batch in batches)
        for piece, held in groupby(rows, lambda r: r[0]):
            ranks, out = [], []
            for tree, own in groupby(held, lambda r: r[1]):
                own = list(own)
                ranks.append(own[0][4])
                levels = missing(np.array([r[2] for r in own]), own[0][3])
                out += [(piece, tree, level, i) for level, lacking in enumerate(levels) for i in lacking.tolist()]
            levels = missing(np.array(ranks), n_trees)
            out += [(piece, TOP, level, i) for level, lacking in enumerate(levels) for i in lacking.tolist()]
            if out:
                yield as_batch(out, kinds)

    return run


class Path:
    """The nodes on and beside the paths from some leaves of a tree to its root."""

    def __init__(self, tree: str, known: dict[int, bytes], n: int, fetched: dict[tuple[str, int, int], bytes]):
        #: by level: parent -> hex hashes of its children
        self.runs: list[dict[int, list[str]]] = []
        level = 0
        while n > 1:
            runs = {}
            for parent in sorted({i // ARITY for i in known}):
                children = range(parent * ARITY, min(parent * ARITY + ARITY, n))
                runs[parent] = [(known[c] if c in known else fetched[tree, level, c]).hex() for c in children]
            self.runs.append(runs)
            known = {p: hashlib.sha256("".join(run).encode()).digest() for p, run in runs.items()}
            n, level = -(-n // ARITY), level + 1
        self.root = known[0]

    def tails(self, above: str) -> dict[int, str]:
        """For every parent of leaves, the siblings of all levels above it, ``above`` (of the tree on top) last."""
        tails = {0: above}
        for runs in reversed(self.runs[1:]):
            tails = {p * ARITY + j: "".join(run[:j] + run[j + 1 :]) + tails[p] for p, run in runs.items() for j in range(len(run))}
        return tails

    def fold(self, at: int, leaf: bytes) -> bytes:
        """The root recomputed from one leaf and its siblings."""
        for runs in self.runs:
            parent, j = divmod(at, ARITY)
            run = runs[parent]
            leaf = hashlib.sha256("".join([*run[:j], leaf.hex(), *run[j + 1 :]]).encode()).digest()
            at = parent
        return leaf


PROOF = "leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def expanded(n_trees: int, root: bytes, id_type: pa.DataType):
    """(piece, kind, tree, level, idx, n, rank, hash, changed, id), a piece's fetched nodes first -> a row per proved leaf."""
    text = [pa.string()] * 5
    kinds = dict(zip(["id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"], [id_type, *text, pa.bool_()]))

    def proofs(held: Iterator[tuple]) -> Iterator[tuple]:
        fetched, trees, found = {}, {}, []
        for _, kind, tree, level, idx, n, rank, value, changed, key in held:
            if kind == 0:
                fetched[tree, level, idx] = value
                continue
            if not found or found[-1][0] != tree:
                found.append((tree, n, rank, []))
            found[-1][3].append((idx, value, changed, key))
        paths = [(Path(tree, {r[0]: r[1] for r in own}, n, fetched), rank, own) for tree, n, rank, own in found]
        top = Path(TOP, {rank: path.root for path, rank, _ in paths}, n_trees, fetched)
        if top.root != root:
            raise ValueError("the fetched nodes don't give the root of the manifest")
        above = top.tails("")
        for path, rank, own in paths:
            parent, j = divmod(rank, ARITY)
            run = top.runs[0][parent] if top.runs else [path.root.hex()]
            tails = path.tails("".join(run[:j] + run[j + 1 :]) + above[parent] if top.runs else "")
            for idx, value, changed, key in own:
                parent, j = divmod(idx, ARITY)
                if path.runs:
                    run = path.runs[0][parent]
                    siblings = "".join(run[:j] + run[j + 1 :]) + tails[parent]
                else:
                    siblings = tails[0]
                folded = top.fold(rank, path.fold(idx, value if changed is None else changed))
                proof = hashlib.sha256(siblings.encode()).hexdigest()
                yield key, value.hex(), path.root.hex(), root.hex(), proof, folded.hex(), folded == root

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = chain.from_iterable(zip(*batch.to_pydict().values()) for batch in batches)
        for _, held in groupby(rows, lambda r: r[0]):
            yield as_batch(list(proofs(held)), kinds)

    return run


def proofs(made: Manifest, wanted: DataFrame | None = None) -> DataFrame:
    """A row per leaf of ``wanted`` (rows of ``made.leaves``; all by default): id, leaf, subroot, root, proof_sha256, folded_root, verified.

    ``proof_sha256`` is the hash of the siblings on the way to the root, ``folded_root`` the root that the changed leaf (else
    the leaf) and the siblings give. A piece asks for at most 14 nodes a level where its leaves are consecutive; a request is
    sent where the nodes are if the requests are few, else both are dealt by coordinate.
    """
    wanted = made.leaves if wanted is None else wanted
    id_type = wanted.select("id").limit(0).toArrow().schema.field("id").type
    id_kind = dict(wanted.dtypes)["id"]
    if made.root is None:
        return wanted.sparkSession.createDataFrame([], f"id {id_kind}, {PROOF}")
    at = wanted.select("piece", "tree", "idx", "n", "rank").repartition("piece").sortWithinPartitions("piece", "tree", "idx")
    asked = stage(at.mapInArrow(requests(made.n_trees), "piece long, tree string, level int, idx long"), "merkle-requests")
    got = narrow_join(made.nodes, asked, ["tree", "level", "idx"], "inner", asked.count())
    nothing = {"n": "long", "rank": "long", "changed": "binary", "id": id_kind}
    columns = ["piece", "kind", "tree", "level", "idx", "n", "rank", "hash", "changed", "id"]
    nodes = got.withColumns({"kind": F.lit(0), **{c: F.lit(None).cast(t) for c, t in nothing.items()}}).select(columns)
    rows = wanted.withColumns({"kind": F.lit(1), "level": F.lit(0), "hash": F.col("leaf")}).select(columns)
    together = nodes.unionByName(rows).repartition("piece").sortWithinPartitions("piece", "kind", "tree", "level", "idx")
    return together.mapInArrow(expanded(made.n_trees, made.root, id_type), f"id {id_kind}, {PROOF}")

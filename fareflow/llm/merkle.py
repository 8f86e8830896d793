"""A Merkle manifest of a dataset, and octopus multiproofs of its rows.

A row's leaf is the digest of its columns. The leaves of a source, in id order, are the lowest level of
the source's tree: every FAN consecutive nodes of a level (the last run may be shorter, even one) have one parent,
the digest of their digests as text, until one node is left, the subroot. The subroots in source order make the
top tree in the same way, whose last node is the root. A node's coordinate is (tree, level, index).

Positions come from a range partitioning and the counts of its ranges, so no source meets in one task.
Levels are grouped aggregates over runs of FAN nodes.

Proofs are made by leaf partitions of at most twice PART_LEAVES leaves: blocks of one large tree, or several small
trees. A partition finds the octopus of its leaves, the least set of coordinates that it lacks to derive every node
on the paths of all its leaves; all partitions fetch theirs in one look-up. Then each derives the interior nodes, which
its leaves share, once, and expands the proof of every single leaf from them.

Defined results: null columns, ids and sources count as values of their own, ordered first. Rows that share an
id are leaves in the order of their digests; equal rows are interchangeable, but each has its own place. A
table without rows has no root.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from fareflow.llm.common import arrow_map, groups_of, pick
from fareflow.operators.joins import lookup
from fareflow.sources.tables import RunFolder

FAN = 16
PART_LEAVES = FAN ** 3
#: The number of the top tree; the others have the places of their sources.
TOP = -1
DIGEST_CHARS = 64
ROWS_AT_ONCE = 1024
COORDINATE = ["tree", "level", "index"]
PART = ["part_tree", "part_no"]


def row_digest(values: Sequence[Column]) -> Column:
    """The digest of values, each "-" if null, else its byte count, ":" and itself."""
    texts = [v.cast("string") for v in values]
    return F.sha2(F.concat(*[
        F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]), 256)


def digest(text: str) -> str:
    return sha256(text.encode()).hexdigest()


@dataclass
class Manifest:
    """Stored tables: ``leaves`` (id, tree, pos, n, part_tree, part_no, leaf, presented) and ``nodes`` (tree, level,
    index, n, hash; n is the number of nodes of the level); ``n_trees`` is the number of sources."""

    run: RunFolder
    leaves: DataFrame
    nodes: DataFrame
    n_trees: int

    def roots(self) -> DataFrame:
        """tree, hash: the subroots of all sources and, for tree TOP, the root."""
        return self.nodes.where("n = 1").select("tree", "hash")


def _trees(counts: DataFrame, run: RunFolder) -> DataFrame:
    """source, tree (its place), n, start (leaves of the sources before) from the ``counts`` (range, source, here).

    Sources begin in the order of ranges. The number of ranges is that of the shuffle's partitions, so their
    totals are run through in one task; the sources that begin in one range are as few as its rows.
    """
    sources = run.write("sources", counts.groupBy("source").agg(F.min("range").alias("range"), F.sum("here").alias("n")))
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    begun = sources.groupBy("range").agg(F.count(F.lit(1)).alias("_trees"), F.sum("n").alias("_leaves")).select(
        "range", F.coalesce(F.sum("_trees").over(before), F.lit(0)).alias("_tree"),
        F.coalesce(F.sum("_leaves").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy("range").orderBy("source")
    earlier = inside.rowsBetween(Window.unboundedPreceding, -1)
    placed = sources.withColumns({
        "_at": F.row_number().over(inside) - 1, "_first": F.coalesce(F.sum("n").over(earlier), F.lit(0))})
    return run.write("trees", placed.join(begun, "range").select(
        "source", (F.col("_tree") + F.col("_at")).alias("tree"), "n", (F.col("_start") + F.col("_first")).alias("start")))


def _placed(rows: DataFrame, run: RunFolder) -> DataFrame:
    """The ``rows`` (source, id, leaf, presented, tie) with tree, pos (place in it), n and the leaf partition."""
    order = ["source", "id", "leaf", "tie"]
    ranges = run.write("ranges", rows.repartitionByRange(*order).withColumn("range", F.spark_partition_id()))
    counts = run.write("counts", ranges.groupBy("range", "source").agg(F.count(F.lit(1)).alias("here")))
    trees = _trees(counts, run)
    before = Window.partitionBy("tree").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    same = F.expr("c.source <=> t.source")
    starts = run.write("starts", counts.alias("c").join(trees.alias("t"), same).select(
        "c.range", "c.source", "c.here", "t.tree", "t.n", "t.start").withColumn(
        "before", F.coalesce(F.sum("here").over(before), F.lit(0))))
    inside = Window.partitionBy("range", "source").orderBy("id", "leaf", "tie")
    ranked = ranges.withColumn("_at", F.row_number().over(inside) - 1)
    joined = ranked.alias("r").join(starts.alias("s"), F.expr("r.range = s.range AND r.source <=> s.source")).select(
        "r.id", "s.tree", (F.col("s.before") + F.col("r._at")).alias("pos"), "s.n", "s.start", "r.leaf", "r.presented")
    large = F.col("n") > PART_LEAVES
    return run.write("leaves", joined.select(
        "id", "tree", "pos", "n", F.when(large, F.col("tree")).otherwise(F.lit(TOP)).cast("long").alias("part_tree"),
        F.floor(F.when(large, F.col("pos")).otherwise(F.col("start")) / PART_LEAVES).alias("part_no"), "leaf", "presented"))


def _levels(lowest: DataFrame, most: int, run: RunFolder, name: str) -> DataFrame:
    """All levels over ``lowest`` (tree, index, n, hash), whose largest tree has ``most`` nodes there."""
    now = all_levels = lowest.withColumn("level", F.lit(0))
    level = 0
    while most > 1:
        level, most = level + 1, -(-most // FAN)
        run_of = F.sort_array(F.collect_list(F.struct("index", "hash")))
        parents = now.where("n > 1").groupBy("tree", F.floor(F.col("index") / FAN).alias("index"), "n").agg(
            F.sha2(F.array_join(F.transform(run_of, lambda x: x["hash"]), ""), 256).alias("hash"))
        now = run.write(f"{name}_{level}", parents.select(
            "tree", "index", F.ceil(F.col("n") / FAN).alias("n"), "hash", F.lit(level).alias("level")))
        all_levels = all_levels.unionByName(now)
    return all_levels


def build_manifest(
    docs: DataFrame, columns: Sequence[str], id_column: str = "doc_id", source_column: str = "source",
    presented: Mapping[str, Column] | None = None,
) -> Manifest:
    """The manifest of ``docs`` over ``columns``, which take part in a leaf in this order.

    ``presented`` has expressions over the columns, by column: what somebody who shows a row says that
    it holds. Proofs are then folded from the leaf of the row as shown.
    """
    run = RunFolder(docs.sparkSession)
    rows = pick(docs, *dict.fromkeys([*columns, id_column, source_column]))
    shown = {c: (presented or {}).get(c, F.col(c)) for c in columns}
    same = F.lit(True)
    for c in columns:
        same = same & shown[c].eqNullSafe(F.col(c))
    hashed = rows.select(
        F.col(source_column).alias("source"), F.col(id_column).alias("id"), row_digest([F.col(c) for c in columns]).alias("leaf"),
        F.when(~same, row_digest([shown[c] for c in columns])).alias("presented"), F.monotonically_increasing_id().alias("tie"))
    leaves = _placed(run.write("rows", hashed), run)
    most, n_trees = leaves.agg(F.max("n"), F.max("tree")).first()
    own = _levels(leaves.select("tree", F.col("pos").alias("index"), "n", F.col("leaf").alias("hash")), most or 0, run, "level")
    n_trees = 0 if n_trees is None else n_trees + 1
    subroots = run.write("subroots", own.where("n = 1").select(
        F.lit(TOP).cast("long").alias("tree"), F.col("tree").alias("index"), F.lit(n_trees).cast("long").alias("n"), "hash"))
    return Manifest(run, leaves, own.unionByName(_levels(subroots, n_trees, run, "top")), n_trees)


def octopus(trees: np.ndarray, positions: np.ndarray, sizes: np.ndarray, n_trees: int):
    """The coordinates that leaves (tree, position, size of the tree) lack: (tree, level, missing indices) level by level."""
    order = np.lexsort((positions, trees))
    trees, positions, sizes = trees[order], positions[order], sizes[order]
    firsts = np.flatnonzero(np.diff(trees, prepend=trees[0] - 1))
    for a, b in zip(firsts, [*firsts[1:], len(trees)]):
        yield from _lacking(int(trees[a]), np.unique(positions[a:b]), int(sizes[a]))
    yield from _lacking(TOP, trees[firsts], n_trees)


def _lacking(tree: int, have: np.ndarray, n: int):
    level = 0
    while n > 1:
        runs = np.unique(have // FAN)
        children = (runs[:, None] * FAN + np.arange(FAN)).reshape(-1)
        yield tree, level, np.setdiff1d(children[children < n], have, assume_unique=True)
        have, n, level = runs, -(-n // FAN), level + 1


def _missing(leaves: DataFrame, n_trees: int) -> DataFrame:
    """part_tree, part_no, tree, level, index: the octopus of each leaf partition."""
    def work(batches):
        for group in groups_of(batches, 2):
            trees, positions, sizes = (group.column(i).to_numpy() for i in (2, 3, 4))
            for tree, level, lacking in octopus(trees, positions, sizes, n_trees):
                n = len(lacking)
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array(np.full(n, group.column(i)[0].as_py(), np.int64)) for i in (0, 1)),
                     pa.array(np.full(n, tree, np.int64)), pa.array(np.full(n, level, np.int32)),
                     pa.array(lacking.astype(np.int64))], [*PART, *COORDINATE])

    rows = leaves.select(*PART, "tree", "pos", "n").repartition(*PART).sortWithinPartitions(*PART)
    return arrow_map(rows, work, "part_tree bigint, part_no bigint, tree bigint, level int, index bigint")


class Paths:
    """The derived nodes of one leaf partition.

    ``leaves``: the positions that it has, by tree; ``known``: the digests of these leaves and of what it fetched.
    """

    def __init__(
        self, leaves: dict[int, list[int]], sizes: dict[int, int], n_trees: int, known: dict[tuple[int, int, int], str],
    ):
        self.known = known
        self.runs: dict[tuple[int, int, int], str] = {}
        self.above: dict[tuple[int, int, int], str] = {}
        self.height: dict[int, int] = {}
        self.subroots: dict[int, str] = {}
        for tree, positions in leaves.items():
            self.subroots[tree] = known[TOP, 0, tree] = self._derive(tree, positions, sizes[tree])
        self.root = self._derive(TOP, leaves, n_trees)

    def _derive(self, tree: int, have, n: int) -> str:
        """The last node of a tree, by way of all nodes above ``have``, each made once."""
        level = 0
        while n > 1:
            level, have = level + 1, {i // FAN for i in have}
            for index in have:
                joined = "".join([self.known[tree, level - 1, i] for i in range(index * FAN, min(n, index * FAN + FAN))])
                self.runs[tree, level, index] = joined
                self.known[tree, level, index] = digest(joined)
            n = -(-n // FAN)
        self.height[tree] = level
        return self.known[tree, level, 0]

    def _up(self, at: tuple[int, int, int]) -> tuple[int, int, int] | None:
        """The coordinate of the parent; a subroot is itself a node of the top tree; None above the root."""
        tree, level, index = at
        if level < self.height[tree]:
            return tree, level + 1, index // FAN
        return None if tree == TOP else (TOP, 0, tree)

    def proof(self, at: tuple[int, int, int]) -> str:
        """The siblings on the way to the root, joined; what leaves share is put together once."""
        parent = self._up(at)
        if parent is None:
            return ""
        if parent not in self.above:
            self.above[parent] = self.proof(parent)
        if not parent[1]:
            return self.above[parent]
        place = at[2] % FAN * DIGEST_CHARS
        joined = self.runs[parent]
        return joined[:place] + joined[place + DIGEST_CHARS:] + self.above[parent]

    def fold(self, at: tuple[int, int, int], own: str) -> str:
        """The root that follows from ``own`` at a coordinate and the siblings above it."""
        while own != self.known[at]:
            parent = self._up(at)
            if parent is None:
                return own
            if parent[1]:
                place = at[2] % FAN * DIGEST_CHARS
                joined = self.runs[parent]
                own = digest(joined[:place] + own + joined[place + DIGEST_CHARS:])
            at = parent
        return self.root


def _expanded(batches, n_trees: int):
    """The proofs of the leaves among sorted rows, partition by partition."""
    for group in groups_of(batches, 2):
        fetched = group.column("fetched").to_pylist()
        at = list(zip(*(group.column(c).to_pylist() for c in COORDINATE)))
        hashes = group.column("hash").to_pylist()
        own = [i for i, f in enumerate(fetched) if not f]
        n = group.column("n").to_pylist()
        leaves: dict[int, list[int]] = {}
        for i in own:
            leaves.setdefault(at[i][0], []).append(at[i][2])
        paths = Paths(leaves, {at[i][0]: n[i] for i in own}, n_trees, dict(zip(at, hashes)))
        presented = group.column("presented").to_pylist()
        for start in range(0, len(own), ROWS_AT_ONCE):
            some = own[start:start + ROWS_AT_ONCE]
            folded = [paths.fold(at[i], presented[i] or hashes[i]) for i in some]
            yield pa.RecordBatch.from_arrays(
                [group.column("id").take(pa.array(some)).combine_chunks(), pa.array([hashes[i] for i in some]),
                 pa.array([paths.subroots[at[i][0]] for i in some]), pa.array([paths.root] * len(some)),
                 pa.array([paths.proof(at[i]) for i in some]), pa.array(folded), pa.array([f == paths.root for f in folded])],
                ["id", "leaf", "subroot", "root", "proof", "folded_root", "verified"])


def proofs(manifest: Manifest, asked: Column | None = None) -> DataFrame:
    """id, leaf, subroot, root, proof (the sibling digests up to the root, joined), folded_root and verified for every
    leaf, or for those where ``asked`` (over id, tree, pos, leaf) holds."""
    run, n_trees = manifest.run, manifest.n_trees
    leaves = manifest.leaves if asked is None else manifest.leaves.where(asked)
    missing = run.write("missing", _missing(leaves, n_trees))
    levels = [r.level for r in missing.select("level").distinct().collect()]  # as many as the tree is high
    wanted = missing.groupBy(*COORDINATE).agg(F.count(F.lit(1)).alias("n_asked"))
    stored = manifest.nodes.where(F.col("level").isin(levels)).select(*COORDINATE, "hash")
    answers = run.write("answers", wanted.join(stored, COORDINATE))
    fetched = lookup(missing, answers, COORDINATE, ["hash"], "n_asked")
    nothing = {"n": F.lit(None).cast("long"), "presented": F.lit(None).cast("string"), "fetched": F.lit(True)}
    rows = leaves.select(
        *PART, "tree", F.lit(0).alias("level"), F.col("pos").alias("index"), F.col("leaf").alias("hash"), "n", "presented",
        F.lit(False).alias("fetched"), "id").unionByName(fetched.withColumns(nothing).withColumn(
            "id", F.lit(None).cast(leaves.schema["id"].dataType)))
    rows = rows.repartition(*PART).sortWithinPartitions(*PART)
    return arrow_map(rows, lambda batches: _expanded(batches, n_trees), (
        f"id {dict(leaves.dtypes)['id']}, leaf string, subroot string, root string, proof string, folded_root string, "
        "verified boolean"))

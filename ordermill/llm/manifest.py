"""Merkle manifest of a table, with a proof for each row found by pointer jumping.

A leaf is the SHA-256 of a row's columns. The leaves of each group (a language), by id, form a binary tree, whose root
is the group's subroot; the subroots, by group, form the tree above them. A lone node at the end of a level becomes the
digest of itself alone.

Trees are built from runs of 2 ** BLOCK neighbours, each reduced to one node in its task, so a tree of n leaves takes
log2(n) / BLOCK shuffles, each of 2 ** BLOCK times fewer rows. Numbers of leaves come from range partitions and their
row counts; no group is ever in one task.

Proofs: every node holds a pointer to an ancestor (its parent at first) and the siblings on the way there. A self-join of
the nodes with those they point to doubles the distance and concatenates the siblings, until every leaf points past
the root; that takes log2 of the height joins. Inner nodes that no later join asks for are left out. Ancestors at a
distance of 8 and more are few (n / 2 ** 8 and fewer); they are broadcast while their bytes, known from the number of
leaves, are at most `BROADCAST_BYTES`, so that no ancestor's descendants meet in one task, and merged beyond, where they are many.

Defined results: null values are "-" in a leaf; rows with a null or repeated id are leaves each, in the order id (missing
first), then leaf; a null group is a group like others, and the first; a table without rows has no root (None) and no
proofs; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ordermill.llm.common import stored

# The columns of a leaf, in order.
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
BLOCK = 10
BROADCAST_BYTES = 32 * 1024 * 1024
NEAR = 8  # joins over shorter distances are always shuffled
# A step towards the root: L or R (the sibling stands left or right) and the sibling's digest, or - and zeros.
STEP = 33
NO_SIBLING = "-" + "\0" * 32
TOP = -1  # the tree over the subroots
NODE = "struct<tree:long,height:int,number:long>"


def digest(*parts: Column) -> Column:
    """Hex SHA-256 of concatenated texts."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def leaf_digest(columns: Sequence[str] = COLUMNS, **replaced: Column) -> Column:
    def field(name: str) -> Column:
        value = replaced.get(name, F.col(name)).cast("string")
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))

    return digest(*map(field, columns))


def _hex(binary: Column) -> Column:
    return F.lower(F.hex(binary))


def numbered(rows: DataFrame, *order: str) -> DataFrame:
    """The rows with `number`, their place (from 0) in the order; sorted and counted by range partitions."""
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = placed.select("*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at"))
    placed = stored(placed, "manifest-order")
    parts = placed.groupBy("part").agg(F.count("*").alias("n"), F.min("at").alias("first"))
    before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    # A row per shuffle partition.
    parts = parts.select(F.col("part").alias("of"), (F.coalesce(before, F.lit(0)) - F.col("first")).alias("shift"))
    joined = placed.join(F.broadcast(parts), F.col("part") == F.col("of"))
    return joined.withColumn("number", F.col("at") + F.col("shift")).drop("part", "at", "of", "shift")


def _height(n: Column) -> Column:
    """Levels above n leaves: log2, rounded up."""
    return F.when(n > 1, F.length(F.bin(n - 1))).otherwise(0)


def _reduced(level: Column) -> Column:
    """Digests of every two neighbours."""
    pairs = F.sequence(F.lit(0), F.shiftright(F.size(level) - 1, 1))
    return F.transform(pairs, lambda i: digest(F.get(level, i * 2), F.coalesce(F.get(level, i * 2 + 1), F.lit(""))))


def _climb(nodes: DataFrame, base: int) -> DataFrame:
    """All nodes of the blocks above `nodes`, those at height `base` (tree, height_of the tree, number, node, row): the
    same columns with height, is_last (the only node of its block, to be taken further) and the step of all others."""
    block = F.shiftright("number", BLOCK).alias("block")
    members = F.array_sort(F.collect_list(F.struct("number", "node", "row"))).alias("members")
    blocks = nodes.groupBy("tree", "height_of", block).agg(members)
    first = F.transform("members", lambda m: m["node"])
    heights = F.slice(F.sequence(F.lit(0), F.least(F.lit(BLOCK), F.col("height_of") - base)), 2, BLOCK)
    levels = F.aggregate(
        heights, F.array(first), lambda done, _: F.concat(done, F.array(_reduced(F.element_at(done, -1))))
    )
    blocks = blocks.withColumn("levels", levels)

    def step(level: Column, i: Column) -> Column:
        side = F.when(i % 2 == 1, "L").otherwise("R").cast("binary")
        beside = F.concat(side, F.unhex(F.get(level, i.bitwiseXOR(F.lit(1)))))
        return F.coalesce(beside, F.lit(NO_SIBLING).cast("binary"))

    def level_nodes(level: Column, k: Column) -> Column:
        is_last = k + 1 == F.size("levels")
        start = F.call_function("shiftleft", F.col("block"), F.lit(BLOCK) - k)
        row = lambda i: F.when(k == 0, F.get("members", i)["row"])
        return F.transform(
            level,
            lambda node, i: F.struct(
                (k + base).alias("height"),
                (start + i).alias("number"),
                node.alias("node"),
                is_last.alias("is_last"),
                F.when(~is_last, step(level, i)).alias("step"),
                row(i).alias("row"),
            ),
        )

    return blocks.select("tree", "height_of", F.inline(F.flatten(F.transform("levels", level_nodes))))


def _trees(nodes: DataFrame, height: int) -> tuple[DataFrame, DataFrame]:
    """All nodes of trees up to a height, from their leaves, and the roots (tree, node)."""
    every, roots = [], []
    for base in range(0, max(height, 1), BLOCK):
        climbed = stored(_climb(nodes, base), "manifest-nodes")
        every.append(climbed)
        last = climbed.filter("is_last")
        roots.append(last.filter("height = height_of").select("tree", "node"))
        none = F.lit(None).cast(nodes.schema["row"].dataType).alias("row")
        nodes = last.filter("height < height_of").select("tree", "height_of", "number", "node", none)
    both = every[0], roots[0]
    for more in zip(every[1:], roots[1:], strict=True):
        both = tuple(a.unionByName(b) for a, b in zip(both, more, strict=True))
    return both


class Manifest:
    """`root` (None without rows), `subroots` (tree, of_group, subroot) and `leaves`, each with its path to the root.

    `altered` is another leaf for rows that are to be checked as if they had been tampered with, or null.
    """

    def __init__(
        self,
        docs: DataFrame,
        key: str = "doc_id",
        group: str = "lang",
        columns: Sequence[str] = COLUMNS,
        altered: Column | None = None,
    ):
        other = (F.lit(None) if altered is None else altered).cast("string")
        slim = docs.select(F.col(key).alias("key"), F.col(group).alias("group"), leaf_digest(columns).alias("leaf"), other.alias("altered"))
        placed = numbered(stored(slim, "manifest-leaves"), "group", "key", "leaf")
        groups = placed.groupBy("group").agg(F.min("number").alias("start"), F.count("*").alias("n"))
        groups = numbered(stored(groups, "manifest-groups"), "group").select(
            F.col("group").alias("of_group"), "start", "n", F.col("number").alias("tree"), _height(F.col("n")).alias("height_of")
        )
        groups = stored(groups, "manifest-trees")
        self.n_leaves, self.n_groups, height = groups.agg(
            F.coalesce(F.sum("n"), F.lit(0)), F.count("*"), F.coalesce(F.max("height_of"), F.lit(0))
        ).first()
        leaves = placed.join(groups, F.col("group").eqNullSafe(F.col("of_group"))).select(
            "tree",
            "height_of",
            (F.col("number") - F.col("start")).alias("number"),
            F.col("leaf").alias("node"),
            F.struct("key", F.unhex("altered").alias("altered")).alias("row"),
        )
        nodes, roots = _trees(leaves, height)
        top_height = max(self.n_groups - 1, 0).bit_length()
        tops = roots.select(
            F.lit(TOP).cast("long").alias("tree"),
            F.lit(top_height).alias("height_of"),
            F.col("tree").alias("number"),
            "node",
            F.lit(None).cast(leaves.schema["row"].dataType).alias("row"),
        )
        top_nodes, top_root = _trees(tops, top_height)
        row = top_root.first()
        self.root = row and row["node"]
        known = groups.select(F.col("tree").alias("of_tree"), "of_group")
        self.subroots = stored(roots.join(known, F.col("tree") == F.col("of_tree")).select("tree", "of_group", F.col("node").alias("subroot")), "manifest-subroots")
        self._height, self._top_height = height, top_height
        self.leaves = self._paths(nodes.unionByName(top_nodes))

    def _up(self) -> Column:
        inside = F.struct("tree", (F.col("height") + 1).alias("height"), F.shiftright("number", 1).alias("number"))
        above = F.struct(F.lit(TOP).cast("long").alias("tree"), F.lit(0).alias("height"), F.col("tree").alias("number"))
        up = F.when(F.col("height") + 1 < F.col("height_of"), inside.cast(NODE))
        return up.when((F.col("tree") != TOP) & F.lit(self.n_groups > 1), above.cast(NODE)) if self.n_groups > 1 else up

    def _paths(self, nodes: DataFrame) -> DataFrame:
        """tree, key, leaf, altered and path (steps from the leaf to the root, STEP bytes each) by pointer jumping."""
        path = F.coalesce("step", F.lit("").cast("binary")).alias("path")
        up = self._up().alias("up")
        leaves = nodes.filter("row IS NOT NULL").select("tree", "row.*", F.unhex("node").alias("leaf"), up, path)
        inner = nodes.filter("row IS NULL AND step IS NOT NULL")
        inner = inner.select(F.struct("tree", "height", "number").cast(NODE).alias("node"), up, path)
        distance = 1
        while distance <= self._height + self._top_height:
            far = inner.filter(f"node.tree = {TOP} OR node.height >= {distance}")
            far = far.select(F.col("node").alias("hop"), F.col("up").alias("hop_up"), F.col("path").alias("hop_path"))
            n_far = (2 * self.n_leaves >> distance) + self.n_groups * (self._height + 4)
            small = distance >= NEAR and n_far * (STEP * distance + 64) <= BROADCAST_BYTES
            far = far.hint("broadcast" if small else "merge")
            leaves = self._jump(leaves, far)
            needed = inner.filter(f"node.tree = {TOP} OR node.height >= {2 * distance}")
            inner = stored(self._jump(needed, far), "manifest-paths")
            distance *= 2
        return leaves.drop("up")

    @staticmethod
    def _jump(near: DataFrame, far: DataFrame) -> DataFrame:
        further = F.concat("path", F.coalesce("hop_path", F.lit("").cast("binary"))).alias("path")
        kept = [c for c in near.columns if c not in ("up", "path")]
        return near.join(far, F.col("up") == F.col("hop"), "left").select(*kept, F.col("hop_up").alias("up"), further)

    def proofs(self) -> DataFrame:
        """tree, subroot, root, key, leaf, altered and path of each row."""
        subroots = self.subroots.select(F.col("tree").alias("of_tree"), "subroot")
        rows = self.leaves.join(subroots, F.col("tree") == F.col("of_tree")).drop("of_tree")
        return rows.withColumns(
            {"root": F.lit(self.root).cast("string"), "leaf": _hex(F.col("leaf")), "altered": _hex(F.col("altered"))}
        )


def _steps(path: Column) -> Column:
    """Array of (side, sibling as hex)."""
    at = F.when(F.length(path) > 0, F.sequence(F.lit(1), F.length(path), F.lit(STEP))).otherwise(F.array().cast("array<int>"))
    side = lambda i: F.substring(path, i, F.lit(1)).cast("string")
    sibling = lambda i: _hex(F.substring(path, i + 1, F.lit(STEP - 1)))
    return F.transform(at, lambda i: F.struct(side(i).alias("side"), sibling(i).alias("sibling")))


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the siblings on its path give."""

    def up(node: Column, step: Column) -> Column:
        left, right = step["side"] == "L", step["side"] == "R"
        both = F.when(left, F.concat(step["sibling"], node)).when(right, F.concat(node, step["sibling"]))
        return digest(F.coalesce(both, node))

    return F.aggregate(_steps(path), leaf, up)


def siblings_digest(path: Column) -> Column:
    beside = F.filter(_steps(path), lambda s: s["side"] != "-")
    return digest(F.array_join(F.transform(beside, lambda s: s["sibling"]), ""))


def report(docs: DataFrame) -> DataFrame:
    """Proofs of documents, those whose id's crc32 is divided by 7 with 1 added to n_chars before they are checked."""
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    more = (F.col("n_chars").cast("decimal(20,0)") + 1).cast("string")
    rows = Manifest(docs, altered=F.when(chosen, leaf_digest(n_chars=more))).proofs()
    folded = fold(F.coalesce("altered", "leaf"), F.col("path")).alias("folded_root")
    out = rows.select(F.col("key").alias("doc_id"), "leaf", "subroot", "root", siblings_digest(F.col("path")).alias("proof_sha256"), folded)
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))

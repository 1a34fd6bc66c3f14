"""Merkle manifest of a dataset, its levels kept as concatenated hex strings.

Rows are leaves, ordered by id within their group (language); every run of
``arity`` consecutive nodes, the last one possibly shorter, becomes their
hash until one node remains: the subroot of the group. Subroots, ordered by
group, give the root the same way.

A block holds ``arity ** depth`` aligned nodes and keeps each of its levels as
one string of 64-digit hashes. Parents are hashes of fixed-width substrings of
a level, and the substrings that flank a node within its run are the siblings
that prove it. The roots of the blocks are the nodes of the next tier, which
recurses until every group has one node. A tier shrinks the number of nodes by
``arity ** depth`` (1,024), so a handful of tiers covers any table, and no task
holds more than a block.

Positions come from a range partitioning and sort by group and id: the rows
number themselves within a partition, and prefix sums over one row per
partition and group place them in their group.

H is lowercase hex SHA-256 of its inputs concatenated, digests as hex text; a
field is ``-`` if null, else its UTF-8 byte count, ``:`` and its value.

Defined cases: null fields are leaves like others; a null group is a group of
its own and comes first; null ids come first in their group; rows of one id
follow each other by their leaf hash, so equal rows are leaves of their own; an
empty table gives no leaves and an empty result; texts of any length are hashed
whole; extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shopstream.llm.common import cut

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
DIGEST = 64  # hex digits of a node
_PATH = "array<struct<before:string,after:string>>"


def field(c: Column) -> Column:
    """A value with its byte count before it, ``-`` for null."""
    text = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(fields: list[Column]) -> Column:
    return F.sha2(F.concat(*[field(c) for c in fields]), 256)


def positions(spark: SparkSession, df: DataFrame, group: str, order: list[str]) -> DataFrame:
    """``df`` with ``pos`` (place in its group, from 0) and ``total`` (rows of the group).

    ``df`` is range-partitioned and sorted by ``group`` and ``order`` and
    written; the only rows that meet in one place are one per partition and group.
    """
    keys = [F.col(group).asc_nulls_first(), *[F.col(c).asc_nulls_first() for c in order]]
    ordered = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    placed = cut(spark, ordered.withColumn("_at", F.monotonically_increasing_id()), "merkle-order")
    part = F.shiftright("_at", 33).alias("_part")
    counts = placed.groupBy(F.col(group), part).agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    earlier = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.withColumns({
        "_before": F.coalesce(F.sum("_n").over(earlier), F.lit(0).cast("long")),
        "total": F.sum("_n").over(Window.partitionBy(group))}).drop("_n")
    return placed.withColumn("_part", part).join(starts, [group, "_part"]).withColumn(
        "pos", F.col("_before") + F.col("_at") - F.col("_first")).drop("_part", "_at", "_first", "_before")


def _runs(level: Column, arity: int) -> Column:
    """The next level: the hash of each run of ``arity`` digests, a shorter one at the end included."""
    width = DIGEST * arity
    last = F.floor((F.length(level) - 1) / width).cast("int")
    return F.array_join(F.transform(F.sequence(F.lit(0), last), lambda k: F.sha2(
        F.substr(level, k * width + 1, F.lit(width)).cast("binary"), 256)), "")


def tier(nodes: DataFrame, arity: int, depth: int, carry: list[str] = []) -> DataFrame:  # noqa: B006
    """Blocks of one tier: grp, block, total, rows (pos, node, carried columns), levels (hex strings), root.

    ``nodes`` has grp, pos, total, node. A block takes ``depth`` steps, fewer only
    if it holds its whole group and reaches one node before.
    """
    size = arity ** depth
    blocks = nodes.groupBy("grp", F.floor(F.col("pos") / size).alias("block"), "total").agg(
        F.array_sort(F.collect_list(F.struct("pos", "node", *carry))).alias("rows"))
    steps = sum((F.col("total") > arity ** k).cast("int") for k in range(depth))
    lowest = F.array_join(F.transform("rows", lambda x: x["node"]), "")
    levels = F.aggregate(
        F.sequence(F.lit(0), steps), F.array(lowest),
        lambda acc, k: F.when(k == 0, acc).otherwise(F.concat(acc, F.array(_runs(F.element_at(acc, -1), arity)))))
    return blocks.select("grp", "block", "total", "rows", levels.alias("levels")).withColumn(
        "root", F.element_at("levels", -1))


def sibling_path(levels: Column, place: Column, arity: int) -> Column:
    """Per step of the node at ``place`` in its block: the digests of its run before and after it."""

    def flank(level, k):
        own = F.floor(place / F.pow(F.lit(arity), k)).cast("int")
        first = own - own % arity
        return F.struct(F.substr(level, first * DIGEST + 1, (own - first) * DIGEST).alias("before"),
                        F.substr(level, (own + 1) * DIGEST + 1, (first + arity - 1 - own) * DIGEST).alias("after"))

    return F.transform(F.slice(levels, F.lit(1), F.size(levels) - 1), flank)


def fold(node: Column, path: Column) -> Column:
    """The root that a node and its siblings give."""
    return F.aggregate(path, node, lambda acc, s: F.sha2(F.concat(s["before"], acc, s["after"]).cast("binary"), 256))


def proof_digest(path: Column) -> Column:
    """Hash of all siblings, level by level, left to right."""
    parts = F.transform(path, lambda s: F.concat(s["before"], s["after"]))
    return F.sha2(F.array_join(parts, "").cast("binary"), 256)


@dataclass
class Manifest:
    """The blocks of every tier, lowest first, subroots (grp, pos, node), the tiers above them and the root.

    The rows of the lowest blocks also hold the columns ``carried`` of their leaves.
    """

    tiers: list[DataFrame]
    subroots: DataFrame
    top: list[DataFrame]
    root: str | None
    arity: int
    carried: list[str]

    def paths(self) -> DataFrame:
        """Every leaf with ``subroot`` and ``path``, its siblings from the lowest level up to the root.

        Segments are handed down tier by tier: a block gets the path of its root
        and adds the flanks of its own nodes. Only the blocks meet in a join.
        """
        roots = self.top[-1].select("grp", F.col("root").alias("subroot"), F.col("block").alias("pos"),
                                    F.expr(f"cast(array() as {_PATH})").alias("path"))
        for blocks in reversed(self.top):
            roots = _expand(roots, blocks, self.arity, ["pos", "node"])
        # a subroot is the one node of its group
        held = self.subroots.join(roots.select("pos", "path"), "pos").select(
            "grp", F.col("node").alias("subroot"), F.lit(0).cast("long").alias("pos"), "path")
        for blocks in reversed(self.tiers[1:]):
            held = _expand(held, blocks, self.arity, ["pos"])
        return _expand(held, self.tiers[0], self.arity, ["pos", "node", *self.carried])


def _expand(above: DataFrame, blocks: DataFrame, arity: int, columns: list[str]) -> DataFrame:
    """The nodes of ``blocks`` with their paths, from those of the block roots (grp, pos, subroot, path)."""
    met = blocks.join(above.select("grp", F.col("pos").alias("block"), "subroot", "path"), ["grp", "block"])
    nodes = F.explode(F.transform(F.col("rows"), lambda row, k: F.struct(
        row.alias("row"), sibling_path(F.col("levels"), k, arity).alias("near")))).alias("x")
    return met.select("grp", "subroot", "path", nodes).select(
        "grp", "subroot", *[F.col(f"x.row.{c}").alias(c) for c in columns],
        F.concat("x.near", "path").alias("path"))


def _climb(spark: SparkSession, nodes: DataFrame, arity: int, depth: int,
           carry: list[str]) -> tuple[list[DataFrame], DataFrame]:
    """Tiers of blocks above ``nodes`` until every group has one node, and these nodes (grp, node)."""
    tiers, size = [], arity ** depth
    while True:
        blocks = cut(spark, tier(nodes, arity, depth, [] if tiers else carry), "merkle-tier")
        tiers.append(blocks)
        most = blocks.agg(F.max("total")).first()[0]
        nodes = blocks.select("grp", F.col("block").alias("pos"), F.ceil(F.col("total") / size).alias("total"),
                              F.col("root").alias("node"))
        if most is None or most <= size:
            return tiers, nodes.select("grp", "node")


def build(spark: SparkSession, docs: DataFrame, *, group_col: str = "lang", id_col: str = "doc_id",
          fields: tuple[str, ...] = FIELDS, changes: dict[str, Column] | None = None, arity: int = 2,
          depth: int = 10) -> Manifest:
    """The manifest of ``docs``; with ``changes`` the leaves also carry ``changed_leaf``, from the changed fields."""
    if arity < 2 or depth < 1:
        raise ValueError("a run has two nodes and a block one step at least")
    grp = F.coalesce(F.concat(F.lit("="), F.col(f"`{group_col}`").cast("string")), F.lit(""))  # null first
    columns = {c: F.col(f"`{c}`") for c in fields}
    changed = [leaf_hash([*{**columns, **changes}.values()]).alias("changed_leaf")] if changes else []
    # texts are read and hashed once; the sort samples and moves hashes only
    leaves = cut(spark, docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), grp.alias("grp"),
                                    leaf_hash([*columns.values()]).alias("node"), *changed), "merkle-leaves")
    carried = ["doc_id", *(["changed_leaf"] if changes else [])]
    tiers, roots = _climb(spark, positions(spark, leaves, "grp", ["doc_id", "node"]), arity, depth, carried)
    ranked = cut(spark, positions(spark, roots.withColumn("all", F.lit("")), "all", ["grp"]), "merkle-subroots")
    top, root = _climb(spark, ranked.select(F.col("all").alias("grp"), "pos", "total", "node"), arity, depth, [])
    found = root.first()  # one row, or none of an empty table
    return Manifest(tiers, ranked.select("grp", "pos", "node"), top, found.node if found else None, arity, carried)


def audit(spark: SparkSession, docs: DataFrame, changes: dict[str, Column], **options) -> DataFrame:
    """Proofs of all rows, checked against rows whose fields ``changes`` alters.

    Columns: doc_id, leaf, subroot, root, proof_sha256, folded_root (from the
    changed leaf and the original siblings), verified (it equals the root).
    """
    manifest = build(spark, docs, changes=changes, **options)
    folded = fold(F.col("changed_leaf"), F.col("path"))
    return manifest.paths().select(
        "doc_id", F.col("node").alias("leaf"), "subroot", F.lit(manifest.root).cast("string").alias("root"),
        proof_digest(F.col("path")).alias("proof_sha256"), folded.alias("folded_root")).withColumn(
        "verified", F.col("folded_root") == F.col("root"))

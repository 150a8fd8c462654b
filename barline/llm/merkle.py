"""Merkle manifest of a dataset: a tree per group, a tree over the groups, and a proof per row.

A row's place in its group, written in base ``arity``, names its way through the
tree. The lowest digits, so many that a block of rows stays small, are columns of
their own; grouping them away one after the other nests the nodes below a block into
one struct. All rows of a block meet after one shuffle, and every later grouping
has the block among its keys. The roots of the blocks are the rows of the next tier,
until a tree is one block. Then the way back: what lies above a block meets its
nested struct in one grouping, and exploding that level by level gives each row its
siblings. No task holds more than a block, whatever the size of a group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from barline.llm.common import ranked
from barline.sources.tables import stage

#: Digits within a block: 3 ** 6 rows.
LEVELS = 6
PATH = "array<struct<left: string, right: string>>"


def leaf_digest(values: list[Column]) -> Column:
    """SHA-256 over each value's byte count, a colon and its UTF-8 text; NULL is a dash."""
    told = [v.cast("string") for v in values]
    parts = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in told]
    return F.sha2(F.concat(*parts), 256)


def _digests(nodes: Column) -> Column:
    return F.array_join(F.transform(nodes, lambda c: c["digest"]), "")


def _rolled(nodes: DataFrame, arity: int, levels: int) -> DataFrame:
    """Blocks of ``nodes`` (tree, members, rank, digest, item): ``tree``, ``members``, ``block``, ``digest``, ``nodes`` nested.

    Levels above the root of a small tree hash nothing: there a node is its only child.
    """
    digits = [F.pmod(F.floor(F.col("rank") / arity**k), F.lit(arity)).cast("int").alias(f"d{k}") for k in range(levels)]
    block = F.floor(F.col("rank") / arity**levels).alias("block")
    rows = nodes.select("tree", "members", block, *digits, "digest", F.col("item").alias("nodes")).repartition("tree", "block")
    for k in range(levels):
        keys = ["tree", "members", "block", *(f"d{i}" for i in range(k + 1, levels))]
        child = F.struct(F.col(f"d{k}").alias("digit"), "digest", "nodes")
        rows = rows.groupBy(*keys).agg(F.sort_array(F.collect_list(child)).alias("nodes"))
        digest = F.when(F.col("members") > arity**k, F.sha2(_digests(F.col("nodes")), 256)).otherwise(F.col("nodes")[0]["digest"])
        rows = rows.withColumn("digest", digest)
    return rows


def _unrolled(blocks: DataFrame, above: DataFrame, arity: int, levels: int) -> DataFrame:
    """One row per item: ``tree``, ``digest``, ``item``, ``path`` from the item up, and the columns of ``above``.

    ``above`` has tree, block, path and more, one row per block.
    """
    more = [c for c in above.columns if c not in ("tree", "block")]
    met = blocks.select("tree", "block", "members", "nodes").unionByName(above, allowMissingColumns=True)
    rows = met.groupBy("tree", "block").agg(*(F.any_value(c, F.lit(True)).alias(c) for c in ["members", "nodes", *more]))
    for k in reversed(range(levels)):

        def placed(node: Column, i: Column) -> Column:
            left = _digests(F.slice("nodes", F.lit(1), i))
            right = _digests(F.slice("nodes", i + 2, F.lit(arity)))
            return F.struct(F.struct(left.alias("left"), right.alias("right")).alias("beside"), node["digest"].alias("digest"), node["nodes"].alias("nodes"))

        rows = rows.withColumn("at", F.explode(F.transform("nodes", placed)))
        step = F.when(F.col("members") > arity**k, F.array("at.beside")).otherwise(F.array().cast(PATH))
        rows = rows.withColumns({"path": F.concat(step, "path"), "digest": F.col("at.digest"), "nodes": F.col("at.nodes")}).drop("at")
    return rows.select("tree", "digest", F.col("nodes").alias("item"), *more)


def _forest(nodes: DataFrame, arity: int, levels: int) -> list[DataFrame]:
    """The tiers of blocks over ``nodes``, each staged; in the last, every tree is one block."""
    tiers = []
    while True:
        tiers.append(stage(_rolled(nodes, arity, levels), "merkle-blocks"))
        largest = tiers[-1].agg(F.max("block")).first()[0]
        if not largest:
            return tiers
        members = F.ceil(F.col("members") / arity**levels)
        nodes = tiers[-1].select("tree", members.alias("members"), F.col("block").alias("rank"), "digest", F.struct("block").alias("item"))


def _walked(tiers: list[DataFrame], above: DataFrame, arity: int, levels: int) -> DataFrame:
    """From the roots (``above``: tree, path, more) down through the tiers to the items of the first."""
    above = above.withColumn("block", F.lit(0).cast("long"))
    for blocks in reversed(tiers[1:]):
        above = _unrolled(blocks, above, arity, levels).withColumn("block", F.col("item.block")).drop("digest", "item")
    return _unrolled(tiers[0], above, arity, levels)


def manifest(
    docs: DataFrame,
    *,
    group_col: str = "source",
    order_col: str = "doc_id",
    columns: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"),
    changed: dict[str, Column] | None = None,
    arity: int = 3,
    levels: int = LEVELS,
) -> DataFrame:
    """Per row ``doc_id`` (``order_col``), ``leaf``, ``found`` (its leaf as it is now), ``subroot``, ``root`` and ``path``.

    A leaf is the digest of ``columns``. In a group, leaves ascend by ``order_col``,
    NULL first, ties by digest; runs of ``arity`` become the digest of their digests
    until one is left, the subroot. Subroots, NULL group first, then by the bytes of
    the group's name, give the root likewise. ``path`` lists the digests left and right of
    the row's way, from the leaf's level to the root's. ``changed`` holds columns as they
    are to be found when checked, by name: ``found`` is the leaf of those.

    NULLs count as values of their own: a NULL group is a group, told apart from
    an empty name. Rows that repeat each other are leaves each. An empty table gives
    no rows. Columns besides those named are not read, whatever their names.
    """
    plain = [F.col(c) for c in columns]
    later = [(changed or {}).get(c, F.col(c)) for c in columns]
    named = docs.select(
        F.col(group_col).cast("string").alias("tree"), F.col(order_col).alias("id"), leaf_digest(plain).alias("digest"),
        leaf_digest(later).alias("found"),
    )
    leaves = ranked(named, "tree", ["id", "digest"], "merkle-leaves")
    # Keys that are never NULL and sort as the contract asks: NULL, then by bytes.
    tree = F.coalesce(F.concat(F.lit("1"), "tree"), F.lit("0"))
    leaves = leaves.withColumn("tree", tree)
    sizes = leaves.groupBy("tree").agg(F.count("*").alias("members"))
    nodes = leaves.join(sizes, "tree").select("tree", "members", "rank", "digest", F.struct("id", "found").alias("item"))
    tiers = _forest(nodes, arity, levels)

    roots = tiers[-1].select(F.col("tree").alias("name"), "digest")
    trees = ranked(roots.withColumn("tree", F.lit("")), "tree", ["name"], "merkle-roots")
    number = trees.agg(F.count("*")).first()[0]
    item = F.struct("name", F.col("digest").alias("subroot")).alias("item")
    tops = _forest(trees.select("tree", F.lit(number).alias("members"), "rank", "digest", item), arity, levels)
    root = tops[-1].select("tree", F.col("digest").alias("root"), F.array().cast(PATH).alias("path"))
    above = _walked(tops, root, arity, levels).select(F.col("item.name").alias("tree"), F.col("item.subroot").alias("subroot"), "root", "path")
    rows = _walked(tiers, above, arity, levels)
    return rows.select(F.col("item.id").alias("doc_id"), F.col("digest").alias("leaf"), F.col("item.found").alias("found"), "subroot", "root", "path")


def proof_digest(path: Column) -> Column:
    """SHA-256 over all siblings of a path, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda p: F.concat(p["left"], p["right"])), ""), 256)


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(path, leaf, lambda node, p: F.sha2(F.concat(p["left"], node, p["right"]), 256))

"""Merkle manifest of a dataset: one leaf digest per row, an ``ARITY``-ary tree per group, and a tree over
the groups' roots, built level by level with sibling-shift self-joins.

Digest ``H``: lowercase hex SHA-256 of its inputs concatenated, digests entering as their hex text. A row's
leaf is H of its fields, each ``-`` if null, else its UTF-8 byte count, ``:``, its text (integers decimal).

Positions. Rows are sorted by (group, order column ascending with nulls last, leaf) over range partitions, so
a hot group spreads over many tasks; a row's gapless position in its group is its offset in its sorted
partition plus the rows of that group in earlier partitions (prefix sums over one row per partition and
group), never a window over a whole group.

Levels. A node at position i has slot i mod ARITY; its run is the positions i - slot + k, k < ARITY (for a
binary tree, i XOR 1). Each node is exploded to the positions of its run and equijoined with the level's
nodes on (group, position), so each node learns its siblings left and right of it; slot-zero rows then emit
the parents, H of the run's digests in order, at position i div ARITY. A group with one node left is done:
that node is its top (a lone leaf is its own top). A last run of one node is still hashed. The tops,
ordered by group, go through the same levels to give the root.

Paths. From the root down, every node gets the (left, right) siblings of itself and its ancestors, leaf
level first. The proof is H of all of them concatenated; folding a leaf digest through them
(H(left || digest || right) per level) gives the root again. Only paths of level one and above are stored;
the leaf level is projected straight into digests.

Defined results: null fields are ``-``; a null group is its own group, ordered before all others; rows equal
in group and order column are ordered by leaf, and repeated rows are separate leaves with equal digests;
an empty table gives no rows. Only the named fields are read, so other columns never clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import materialised

ARITY = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def field(value: Column | str) -> Column:
    """``-`` for null, else UTF-8 byte count, ``:``, value as text."""
    value = (F.col(value) if isinstance(value, str) else value).cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def group_key(name: str) -> Column:
    """Non-null key that sorts a null group first and others by their UTF-8 bytes."""
    return F.when(F.col(name).isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), F.col(name).cast("string")))


def positions(rows: DataFrame, order: list[Column]) -> DataFrame:
    """``rows(g, ...)`` -> the same rows with ``i``, their gapless position within g under ``order``."""
    ranked = materialised(rows.orderBy(F.col("g"), *order).withColumn("_m", F.monotonically_increasing_id()), "merkle-sorted")
    part = F.shiftrightunsigned("_m", 33)  # the sorted partition a row came from
    runs = ranked.groupBy("g", part.alias("_part")).agg(F.min("_m").alias("_first"), F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy("g").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumn("_start", F.coalesce(F.sum("_n").over(earlier), F.lit(0))).drop("_n")
    placed = ranked.withColumn("_part", part).join(runs, ["g", "_part"])
    return placed.withColumn("i", F.col("_start") + F.col("_m") - F.col("_first")).drop("_m", "_part", "_first", "_start")


def level(nodes: DataFrame, arity: int = ARITY) -> DataFrame:
    """``nodes(g, i, h)`` -> (g, i, h, left, right, top): siblings of each node found by self-join."""
    slot = F.col("i") % arity
    run = F.array(*[F.struct(F.lit(k).alias("k"), (F.col("i") - slot + k).alias("j")) for k in range(arity)])
    wanted = nodes.select("g", "i", F.explode(run).alias("t")).select("g", "i", "t.k", "t.j")
    found = wanted.join(nodes.select("g", F.col("i").alias("j"), "h"), ["g", "j"])
    runs = found.groupBy("g", "i").agg(F.sort_array(F.collect_list(F.struct("k", "h"))).alias("run"))

    def joined(keep) -> Column:
        return F.array_join(F.transform(F.filter("run", keep), lambda x: x["h"]), "")

    return runs.select(
        "g",
        "i",
        joined(lambda x: x["k"] == slot).alias("h"),
        joined(lambda x: x["k"] < slot).alias("left"),
        joined(lambda x: x["k"] > slot).alias("right"),
        ((F.col("i") == 0) & (F.size("run") == 1)).alias("top"),
    )


def levels(nodes: DataFrame, arity: int = ARITY) -> list[DataFrame]:
    """All levels of the trees of every group, leaf level first, each written once."""
    out = []
    while not nodes.isEmpty():
        here = materialised(level(nodes, arity), f"merkle-level{len(out)}")
        out.append(here)
        parents = here.where((F.col("i") % arity == 0) & ~F.col("top"))
        nodes = materialised(parents.select("g", (F.col("i") / arity).cast("long").alias("i"), digest("h", "right").alias("h")), "merkle-nodes")
    return out


def with_paths(nodes: DataFrame, above: DataFrame | None, tops: DataFrame, arity: int = ARITY) -> DataFrame:
    """Give each node its path: its own (left, right) and then its parent's path; a top takes ``tops.path`` of
    its group. ``above`` holds (g, i, path) of the level above, or None at the highest level. Other columns of
    ``nodes`` stay."""
    entry = F.array(F.struct(F.col("left"), F.col("right")))
    done = nodes.where("top").join(tops, "g")
    if above is None:
        return done
    parent = above.select("g", F.col("i").alias("_pi"), F.col("path").alias("_pp"))
    inner = nodes.where("NOT top").withColumn("_pi", (F.col("i") / arity).cast("long"))
    inner = inner.join(parent, ["g", "_pi"]).withColumn("path", F.concat(entry, F.col("_pp"))).drop("_pi", "_pp")
    return done.unionByName(inner)


def paths_down(tree: list[DataFrame], tops: DataFrame, lowest: int, arity: int = ARITY) -> DataFrame:
    """Paths of the nodes of level ``lowest``, from the highest level down, each level above it written once."""
    above = None
    for at in range(len(tree) - 1, lowest - 1, -1):
        here = with_paths(tree[at].select("g", "i", "left", "right", "top"), above, tops, arity).drop("left", "right", "top")
        above = here if at == lowest else materialised(here, f"merkle-paths{at}")
    return above


def proof(path: Column) -> Column:
    """H of all siblings, leaf level first, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda x: F.concat(x["left"], x["right"])), ""), 256)


def fold(leaf: Column, path: Column) -> Column:
    """The root reached from ``leaf`` through the siblings of ``path``."""
    return F.aggregate(path, leaf, lambda acc, x: F.sha2(F.concat(x["left"], acc, x["right"]), 256))


def manifest(
    docs: DataFrame,
    group: str = "lang",
    order: str = "doc_id",
    fields: tuple[str, ...] = FIELDS,
    carry: dict[str, Column] | None = None,
    arity: int = ARITY,
) -> DataFrame:
    """One row per input row: ``order``, the ``carry`` columns (computed from the input row), leaf, subroot,
    root, path (array of (left, right) siblings up to the root, leaf level first) and proof_sha256.

    Texts are read once, for the leaf and ``carry``; the tree moves digests only."""
    carry = carry or {}
    rows = docs.select(
        F.col(order).alias("_order"),
        *[c.alias(f"_c_{name}") for name, c in carry.items()],
        group_key(group).alias("g"),
        digest(*[field(f) for f in fields]).alias("leaf"),
    )
    placed = materialised(positions(rows, [F.col("_order").asc_nulls_last(), F.col("leaf")]), "merkle-leaves")
    trees = levels(placed.select("g", "i", F.col("leaf").alias("h")), arity)
    kinds = "path array<struct<left:string,right:string>>"
    if trees:
        group_tops = materialised(_tops(trees), "merkle-tops")
        # the tree over the groups' tops, ordered by group
        over = positions(group_tops.select(F.lit("").alias("g"), F.col("g").alias("member"), "h"), [F.col("member")])
        over = materialised(over, "merkle-over")
        upper = levels(over.select("g", "i", "h"), arity)
        root_top = upper[-1].where("top").select("g", F.array().cast(kinds.split(" ", 1)[1]).alias("path"))
        from_root = paths_down(upper, root_top, 0, arity).join(over.select("g", "i", "member"), ["g", "i"])
        tops = materialised(from_root.select(F.col("member").alias("g"), "path"), "merkle-top-paths")
        above = paths_down(trees, tops, 1, arity) if len(trees) > 1 else None
        leaves = placed.join(trees[0].select("g", "i", "left", "right", "top"), ["g", "i"])
        out = with_paths(leaves, above, tops, arity).join(group_tops.select("g", F.col("h").alias("subroot")), "g")
    else:
        empty = docs.sparkSession.createDataFrame([], f"g string, subroot string, {kinds}")
        out = placed.join(empty, "g")
    return out.select(
        F.col("_order").alias(order),
        *[F.col(f"_c_{n}").alias(n) for n in carry],
        "leaf",
        "subroot",
        fold(F.col("leaf"), F.col("path")).alias("root"),
        "path",
        proof(F.col("path")).alias("proof_sha256"),
    )


def _tops(trees: list[DataFrame]) -> DataFrame:
    """(g, h) of each group's top, wherever its level."""
    out = trees[0].where("top").select("g", "h")
    for t in trees[1:]:
        out = out.unionByName(t.where("top").select("g", "h"))
    return out

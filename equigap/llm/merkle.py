"""Merkle manifest of a dataset, verified by a recursive climb.

Each row is a leaf: a hash of its fields, each with its length before it.  Per
group the leaves stand in order of their key; every ``FAN`` neighbouring nodes
become their parent, the hash of their joined digests, until one node is
left, the group's subroot.  The subroots, in order of their groups, become
the dataset's root in the same way.

Places are ordinals over range partitions, so a group with a third of all
rows is built by many tasks.  The levels are built ``STRIDE`` at a time: the
up to FAN**STRIDE nodes below one ancestor meet in a task, which makes their
levels and stores, for each of them, its *node row*: its hash, for each level
up to the ancestor the digests to its left and right in its run, and the
ancestor's key as its parent.  The number of jobs is the depth over STRIDE,
and each handles FAN**STRIDE times fewer rows than the one before.

Verification is a Spark recursive query over the node rows.  It starts with
every leaf's row and a hash to be checked (that of what is found in the
dataset now), and step by step joins the parent's row, appends the siblings
to the proof and folds the hash with them, until no parent is left.  The
folded hash equals the root exactly if the leaf is untouched.

Defined cases: null fields are ``-``; null groups and null keys come first;
rows that share a key follow the order of their hashes, and equal rows are
leaves of their own; a text of any length is one field; a lone leaf is its
own subroot, and a lone subroot the root (the proof is then that of no
siblings); an empty table has no root and gives an empty result.  Fields are
named, other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .util import Scratch

FAN, STRIDE = 3, 6
#: The group number of the tree over the groups' subroots.
TOP = -1
NODE = ("g", "t", "i")


def field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(*values: Column) -> Column:
    """Lowercase hex SHA-256 of the fields."""
    return F.sha2(F.concat(*map(field, values)), 256)


def _levels(stride: int) -> DataFrame | dict[str, Column]:
    """Columns a0 .. a{stride}: the digests of each level, of the sorted a0."""
    def up(a: str) -> Column:
        runs = F.sequence(F.lit(0), F.floor((F.size(a) - 1) / FAN).cast("int"))
        return F.transform(runs, lambda j: F.sha2(F.array_join(F.slice(a, j * FAN + 1, FAN), ""), 256))

    return {f"a{k + 1}": up(f"a{k}") for k in range(stride)}


def _strides(nodes: DataFrame, stride: int) -> DataFrame:
    """``nodes``: g, i, members, hash (hex) of one level.  A row per ancestor up to
    ``stride`` levels above: g, i, members (of its level), a0 .. a{stride}, depth."""
    width = FAN**stride
    block = nodes.groupBy("g", F.floor(F.col("i") / width).alias("block"), "members").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("i", "hash"))), lambda x: x["hash"]).alias("a0"))
    for name, column in _levels(stride).items():
        block = block.withColumn(name, column)
    depth = F.lit(stride)
    for k in reversed(range(stride)):  # a group that becomes one node on the way stops there
        depth = F.when(F.col("members") <= FAN**k, k).otherwise(depth)
    return block.select("g", F.col("block").alias("i"), F.ceil(F.col("members") / width).alias("members"), *[f"a{k}" for k in range(stride + 1)], depth.alias("depth"))


def _node_rows(strides: DataFrame, t: int, stride: int) -> DataFrame:
    """g, t, i, hash, levels, pg, pt, pi of the nodes below ``strides``."""
    width = FAN**stride
    below = strides.select("*", F.posexplode("a0").alias("r", "hash"))
    levels = []
    for k in range(stride):
        own = F.floor(F.col("r") / FAN**k).cast("int")
        first = (own - own % FAN + 1).cast("int")
        side = lambda start, n, k=k: F.unhex(F.array_join(F.slice(f"a{k}", start, n), ""))
        levels.append(F.struct(side(first, own % FAN).alias("l"), side(own + 2, FAN - 1 - own % FAN).alias("r")))
    one = F.col("members") == 1
    return below.select(
        "g", F.lit(t).alias("t"), (F.col("i") * width + F.col("r")).alias("i"), F.unhex("hash").alias("hash"),
        F.slice(F.array(*levels), F.lit(1), F.col("depth")).alias("levels"),
        F.when(~one, F.col("g")).when(F.col("g") != TOP, F.lit(TOP).cast("long")).alias("pg"),
        F.when(~one, F.lit(t + 1)).when(F.col("g") != TOP, 0).alias("pt"),
        F.when(~one, F.col("i")).when(F.col("g") != TOP, F.col("g")).alias("pi"))


def _tree(nodes: DataFrame, scratch: Scratch, name: str, stride: int) -> tuple[DataFrame, list[DataFrame], DataFrame]:
    """``nodes``: g, i, members, hash.  The node rows of the nodes, those of the
    levels above, and (g, hash) of the last node of each g."""
    most = nodes.agg(F.max("members")).first()[0] or 0
    rows, roots, t = [], [], 0
    while t == 0 or most > 1:
        made = scratch.write(_strides(nodes, stride), f"{name}-{t}")
        rows.append(scratch.write(_node_rows(made, t, stride), f"{name}-rows-{t}"))
        last = made.select("g", "i", "members", F.element_at(F.element_at(F.array(*[f"a{k}" for k in range(stride + 1)]), F.col("depth") + 1), 1).alias("hash"))
        roots.append(last.where("members = 1").select("g", "hash"))
        nodes, most, t = last.where("members > 1"), -(-most // FAN**stride), t + 1
    ends = roots[0]
    for more in roots[1:]:
        ends = ends.union(more)
    return rows[0], rows[1:], ends


class Manifest:
    """The built tree: ``leaves`` and ``nodes`` (node rows), ``subroots`` (g, group,
    subroot) and ``root`` (None of an empty table)."""

    def __init__(self, leaves: DataFrame, key: str, group: str, stride: int = STRIDE):
        """``leaves``: the columns ``key``, ``group``, leaf, and any that the leaf
        rows shall carry."""
        scratch = Scratch(leaves.sparkSession, "merkle")
        self.spark, self.scratch = leaves.sparkSession, scratch
        placed = scratch.ordinals(leaves, "leaves", [group], [key, "leaf"])
        groups = scratch.ordinals(placed.select(group, "members").distinct().withColumnRenamed("members", "group_members"), "groups", [], [group])
        groups = groups.select(F.col(group).alias("g_group"), F.col("ordinal").alias("g"))
        carried = [c for c in leaves.columns if c not in (group, "leaf")]
        placed = scratch.write(placed.join(groups, F.col(group).eqNullSafe(F.col("g_group"))).select(
            "g", F.col("ordinal").alias("i"), "members", F.col("leaf").alias("hash"), *carried), "placed")
        rows, above, ends = _tree(placed.select("g", "i", "members", "hash"), scratch, "tree", stride)
        own = placed.select(F.col("g").alias("o_g"), F.col("i").alias("o_i"), *carried)
        self.leaves = scratch.write(rows.join(own, F.expr("g = o_g and i = o_i")).drop("o_g", "o_i"), "leaf-rows")
        ends = scratch.write(ends, "subroots")
        top = ends.select(F.lit(TOP).cast("long").alias("g"), F.col("g").alias("i"), F.lit(ends.count()).cast("long").alias("members"), "hash")
        top_rows, top_above, root = _tree(top, scratch, "top", stride)
        nodes = top_rows
        for more in [*above, *top_above]:
            nodes = nodes.union(more)
        self.nodes = nodes
        self.subroots = ends.join(groups, "g").select("g", F.col("g_group").alias(group), F.col("hash").alias("subroot"))
        found = root.first()
        self.root = found["hash"] if found else None

    def climb(self, check: str, *carried: str) -> DataFrame:
        """A row per leaf: ``carried`` columns of the leaf rows, g, leaf (hex), proof
        (its siblings' digests from the leaf to the root, left to right, as bytes)
        and folded_root: the column ``check`` (hex) folded with them."""
        fold = "aggregate({0}, {1}, (x, y) -> unhex(sha2(lower(hex(concat(y.l, x, y.r))), 256)))"
        told = "aggregate({0}, {1}, (x, y) -> concat(x, y.l, y.r))"
        own = "".join(f"{c}, " for c in carried)
        climb = f"""
            with recursive climb as (
              select {own}g, hash, {fold.format("levels", f"unhex({check})")} folded, {told.format("levels", "x''")} proof, pg, pt, pi from {{leaves}}
              union all
              select {"".join(f"c.{c}, " for c in carried)}c.g, c.hash, {fold.format("n.levels", "c.folded")}, {told.format("n.levels", "c.proof")}, n.pg, n.pt, n.pi
              from climb c join {{nodes}} n on c.pg = n.g and c.pt = n.t and c.pi = n.i)
            select {own}g, lower(hex(hash)) leaf, proof, lower(hex(folded)) folded_root from climb where pg is null"""
        settings = {
            "spark.sql.cteRecursionRowLimit": "-1",  # a guard against endless recursion; this one ends at the root
            # Spark deals each step's rows evenly; small partitions need no further cut.
            "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "false"}
        before = {k: self.spark.conf.get(k) for k in settings}
        for k, v in settings.items():
            self.spark.conf.set(k, v)
        try:
            return self.scratch.write(self.spark.sql(climb, leaves=self.leaves, nodes=self.nodes), f"climbed-{check}")
        finally:
            for k, v in before.items():
                self.spark.conf.set(k, v)


def verified(docs: DataFrame, fields: list[str], found: dict[str, Column] | None = None, key: str = "doc_id", group: str = "source") -> DataFrame:
    """The manifest of ``docs`` by ``fields``, and each row's proof, against the
    same rows with the fields in ``found`` as they are found now: ``key``, leaf,
    subroot, root, proof_sha256, folded_root, verified."""
    found = found or {}
    check = leaf_hash(*[found.get(c, F.col(f"`{c}`")) for c in fields])
    leaves = docs.select(F.col(key).alias("m_key"), F.col(group).alias("m_group"), leaf_hash(*[F.col(f"`{c}`") for c in fields]).alias("leaf"), check.alias("m_check"))
    manifest = Manifest(leaves, "m_key", "m_group")
    climbed = manifest.climb("m_check", "m_key")
    out = climbed.join(manifest.subroots.select(F.col("g").alias("s_g"), "subroot"), F.expr("g = s_g"))
    root = F.lit(manifest.root).cast("string")
    return out.select(F.col("m_key").alias(key), "leaf", "subroot", root.alias("root"), F.sha2(F.lower(F.hex("proof")), 256).alias("proof_sha256"),
                      "folded_root", (F.col("folded_root") == root).alias("verified"))

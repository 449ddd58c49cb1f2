"""Merkle manifest of a dataset by exchanging subtrees.

Every row is a leaf: the SHA-256 of its fields, each ``-`` if null, else its
UTF-8 byte count, ``:`` and its value.  The leaves of a group (a language)
stand in the order of the key; while a level has several nodes, each run of
two consecutive ones (the last run may have one) becomes the hash of its
hexadecimal digests.  The last node is the group's subroot; the subroots, in
the order of the groups, form the root in the same way.

A group may hold most rows, so no task sees a whole one.  Its leaves are cut
into superblocks of ``2 ** BLOCK_LEVELS``, which are whole subtrees:

* upwards, the superblocks are reduced to their top nodes, these to theirs,
  until every group has one node; each tier is 1024 times smaller;
* downwards, the nodes of a tier are cogrouped by superblock with the outer
  nodes that their superblock needs (its path to the root).  One function
  finishes the local reduction, joins the local siblings with the outer ones
  to whole proofs, and folds the claimed leaves along them.

A proof is a list of sibling digests, bottom up, with one step per level:
``L`` or ``R`` for the sibling's side, ``-`` where a node has none.

Defined results: a null field is ``-``; null groups form one group before all
others (groups are ordered by their UTF-8 bytes); a null key orders before
all others; rows with one key are ordered by their leaves, so repeated rows
stand side by side; texts are hashed as a whole in the JVM, whatever their
length; a lone leaf is its subroot and a lone subroot the root; other columns
are not read, whatever their names; an empty table has no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplens.llm.common import materialize
from shoplens.llm.ordering import numbered

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
BLOCK_LEVELS = 10

_PATH = "tree string, position long, subroot string, root string, steps string, proof array<string>"


def leaf_of(values: Sequence[Column]) -> Column:
    """The leaf of a row with these fields."""
    def field(value: Column) -> Column:
        text = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))
    return F.sha2(F.concat(*map(field, values)), 256)


def _digest(data: str) -> str:
    return hashlib.sha256(data.encode("ascii")).hexdigest()


def _levels(size: int, height: int) -> int:
    """Levels that a superblock has in a tree of ``size`` nodes."""
    return min(height, (int(size) - 1).bit_length())


def _reduce(nodes: list[str], levels: int) -> list[list[str]]:
    """All levels of a superblock, its nodes first."""
    rows = [nodes]
    for _ in range(levels):
        last = rows[-1]
        rows.append([_digest("".join(last[i:i + 2])) for i in range(0, len(last), 2)])
    return rows


def _local_proof(rows: list[list[str]], at: int) -> tuple[str, list[str]]:
    """(steps, siblings) of node ``at`` below the top of its superblock."""
    steps, proof = "", []
    for row in rows[:-1]:
        near = at ^ 1
        if near < len(row):
            steps += "L" if near < at else "R"
            proof.append(row[near])
        else:
            steps += "-"
        at >>= 1
    return steps, proof


def fold(leaf: str, steps: str, proof: Sequence[str]) -> str:
    """The root that a leaf and its proof lead to."""
    siblings = iter(proof)
    for side in steps:
        if side == "L":
            leaf = _digest(next(siblings) + leaf)
        elif side == "R":
            leaf = _digest(leaf + next(siblings))
        else:
            leaf = _digest(leaf)
    return leaf


def _blocks(nodes: DataFrame, height: int):
    return nodes.withColumn("block", F.shiftright("position", height)).groupBy("tree", "block")


def _ascend(nodes: DataFrame, height: int) -> list[DataFrame]:
    """Tiers of ``nodes(tree, position, size, node)``, up to one node a tree."""
    def top(block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("position")
        size = int(block["size"].iloc[0])
        rows = _reduce(block["node"].tolist(), _levels(size, height))
        return pd.DataFrame({"tree": [block["tree"].iloc[0]],
                             "position": [int(block["position"].iloc[0]) >> height],
                             "size": [-(-size >> height)], "node": rows[-1]})

    tiers = [nodes.select("tree", "position", "size", "node")]
    largest = nodes.agg(F.max("size").alias("n")).first()["n"] or 0
    while largest > 1:
        tiers.append(materialize(_blocks(tiers[-1], height).applyInPandas(
            top, "tree string, position long, size long, node string"), "tier"))
        largest = -(-largest >> height)
    return tiers


def _descend(nodes: DataFrame, paths: DataFrame, height: int) -> DataFrame:
    """Paths of the nodes of one tier from those of the tier above."""
    def join(block: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(list(_paths(block, outer, height)), columns=[
            "tree", "position", "subroot", "root", "steps", "proof"])

    return _blocks(nodes, height).cogroup(paths.withColumnRenamed("position", "block").groupBy("tree", "block")
                                  ).applyInPandas(join, _PATH)


def _paths(block: pd.DataFrame, outer: pd.DataFrame, height: int) -> Iterator[tuple]:
    """(tree, position, subroot, root, steps, proof) of a superblock's nodes."""
    block.sort_values("position", inplace=True)
    tree, subroot, root, above, beyond = outer[["tree", "subroot", "root", "steps", "proof"]].iloc[0]
    beyond = list(beyond)
    rows = _reduce(block["node"].tolist(), _levels(block["size"].iloc[0], height))
    for at, position in enumerate(block["position"].tolist()):
        steps, proof = _local_proof(rows, at)
        yield tree, position, subroot, root, steps + above, proof + beyond


def leaves(docs: DataFrame, fields: Sequence[str] = FIELDS, key: str = "doc_id",
           group: str = "lang", claimed: Column | None = None) -> DataFrame:
    """(key, leaf, claimed, tree): the leaf of every row and the one a holder
    of the row claims for it (by default the same)."""
    leaf = leaf_of([F.col(c) for c in fields])
    return docs.select(
        F.col(key).alias("key"), leaf.alias("leaf"),
        (F.lit(None).cast("string") if claimed is None else claimed).alias("claimed"),
        # Groups in the order of their bytes, null first.
        F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit("")).alias("tree"))


def manifest(rows: DataFrame, height: int = BLOCK_LEVELS) -> DataFrame:
    """``leaves`` with (tree, position) and, per row, ``subroot``, ``root``,
    ``steps`` and ``proof`` of the original leaves, and ``folded_root``, where
    the claimed leaf and the proof lead.  Superblocks have ``2 ** height``
    nodes."""
    placed = numbered(materialize(rows, "leaves"), ["key", "leaf"], "tree")
    placed = materialize(placed.withColumnRenamed("leaf", "node"), "placed")
    tiers = _ascend(placed, height)
    # The subroots are the nodes of one more tree.
    subroots = tiers[-1].select(F.col("tree").alias("name"), "node")
    if len(tiers) == 1:
        subroots = materialize(subroots, "subroots")
    upper = materialize(numbered(subroots, ["name"]).withColumn("tree", F.lit("*")), "upper")
    above = _ascend(upper, height)
    paths = above[-1].select(
        "tree", "position", F.col("node").alias("subroot"), F.col("node").alias("root"),
        F.lit("").alias("steps"), F.array().cast("array<string>").alias("proof"))
    for tier in reversed(above[:-1]):
        paths = materialize(_descend(tier, paths, height), "paths")
    paths = (paths.join(upper.select("position", "name", "node"), "position")
             .select(F.col("name").alias("tree"), F.lit(0).cast("long").alias("position"),
                     F.col("node").alias("subroot"), "root", "steps", "proof"))
    for tier in reversed(tiers[1:-1]):
        paths = materialize(_descend(tier, paths, height), "paths")
    if len(tiers) == 1:             # every group is one leaf, which has its path already
        return _folded(placed.join(paths.drop("position"), "tree"))
    return _finish(placed, paths, height, rows.schema["key"].dataType.simpleString())


def _finish(placed: DataFrame, paths: DataFrame, height: int, key_type: str) -> DataFrame:
    """The rows' own tier: paths as on any other, and the fold of every claim."""
    def join(block: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
        found = pd.DataFrame(list(_paths(block, outer, height)), columns=[
            "tree", "position", "subroot", "root", "steps", "proof"])
        block = block.reset_index(drop=True)
        shown = block["claimed"].where(block["claimed"].notna(), block["node"])
        return pd.DataFrame({
            "key": block["key"], "tree": found["tree"], "position": found["position"],
            "leaf": block["node"], "claimed": shown, "subroot": found["subroot"],
            "root": found["root"], "steps": found["steps"], "proof": found["proof"],
            "folded_root": [fold(*x) for x in zip(shown, found["steps"], found["proof"])]})

    # Keys that a pandas column cannot hold with nulls travel as text.
    sent = placed.withColumn("key", F.col("key").cast("string"))
    done = _blocks(sent, height).cogroup(
        paths.withColumnRenamed("position", "block").groupBy("tree", "block")).applyInPandas(
        join, "key string, tree string, position long, leaf string, claimed string, "
              "subroot string, root string, steps string, proof array<string>, folded_root string")
    return done.withColumn("key", F.col("key").cast(key_type))


def _folded(rows: DataFrame) -> DataFrame:
    """One-leaf groups: the proofs are those of their subroots."""
    @F.pandas_udf("string")
    def folded(leaf: pd.Series, steps: pd.Series, proof: pd.Series) -> pd.Series:
        return pd.Series([fold(*x) for x in zip(leaf, steps, proof)], dtype=object)

    shown = F.coalesce("claimed", "node")
    return rows.select("key", "tree", "position", F.col("node").alias("leaf"),
                       shown.alias("claimed"), "subroot", "root", "steps", "proof",
                       folded(shown, "steps", "proof").alias("folded_root"))

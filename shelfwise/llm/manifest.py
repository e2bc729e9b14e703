"""Merkle manifest of a table: a tree of digests per tree key, one tree above them, a proof for every row.

Leaves are digests of the rows' fields, taken where the row is read, so texts never move. Within a
tree, leaves stand in key order (``ranked``: a hot tree is spread over range partitions); every ``FAN``
consecutive nodes become one, until one remains. The roots of all trees, in key order, form the top tree.

The work is exchanged by subtrees. A superblock is the ``FAN ** DEPTH`` consecutive nodes below one node
``DEPTH`` levels up. On the way up each superblock is reduced to its root, and those roots are the
nodes of the next tier (one 512th of the rows, so few tiers). On the way down the nodes of a superblock
are cogrouped with one row: what its root needs from outside, the sibling digests up to the
top. One ``applyInPandas`` call repeats the superblock's reduction, joins inner siblings and outer ones to every
node's proof, and folds leaves along it. No task holds more than a superblock and its one outer row.

Defined cases: NULL fields are written ``-``; a NULL tree key is a tree of its own, the first one; of rows with the
same key (also NULL, which comes first) the smaller leaf digest comes first, and rows alike in all are
interchangeable; a lone leaf is its tree's root, a lone tree's root the root; an empty table gives no
rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import hand_off, ship
from shelfwise.llm.ranks import ranked

FAN = 8
#: Levels that a superblock spans.
DEPTH = 3
BLOCK = FAN**DEPTH
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What an outer row tells: the path above, and the two roots that the path leads to.
_PATH = "proof array<string>, places array<int>, subroot string, root string"
_PATH_COLUMNS = ["proof", "places", "subroot", "root"]
_TOLD = f"key string, leaf string, tree string, folded_root string, {_PATH}"


def encoded(value: Column) -> Column:
    """UTF-8 byte count, ``:`` and the value as text; ``-`` for NULL."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(fields: Sequence[Column]) -> Column:
    """SHA-256 (32 bytes) of all fields, each with its length, in a row."""
    return F.unhex(F.sha2(F.concat(*[encoded(f) for f in fields]).cast("binary"), 256))


def _digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def levels(nodes: Sequence[str], of: int) -> list[list[str]]:
    """A superblock's nodes, level by level up to its root, in a tree that has ``of`` nodes on their level."""
    out = [list(nodes)]
    while of > 1 and len(out) <= DEPTH:
        out.append([_digest("".join(out[-1][i : i + FAN])) for i in range(0, len(out[-1]), FAN)])
        of = -(-of // FAN)
    return out


def siblings(level: Sequence[str]) -> list[str]:
    """For every node of a level the other digests of its run, joined."""
    return ["".join([*level[i - i % FAN : i], *level[i + 1 : i - i % FAN + FAN]]) for i in range(len(level))]


def fold(node: str, proof: Sequence[str], places: Sequence[int]) -> str:
    """The root that follows from a node, its siblings level by level, and its place among them."""
    for others, place in zip(proof, places):
        node = _digest(others[: 64 * place] + node + others[64 * place :])
    return node


def _ordered(block: pd.DataFrame) -> tuple[pd.DataFrame, list[list[str]]]:
    block = block.sort_values("pos", kind="stable")
    return block, levels([bytes(x).hex() for x in block["node"]], int(block["of"].iloc[0]))


def _reduce(key: tuple, block: pd.DataFrame) -> pd.DataFrame:
    """A superblock's root, as a node of the next tier."""
    block, tower = _ordered(block)
    of = -(-int(block["of"].iloc[0]) // FAN ** (len(tower) - 1))
    return pd.DataFrame({"tree": [key[0]], "pos": [key[1]], "of": [of], "node": [bytes.fromhex(tower[-1][0])]})


def _paths(tower: list[list[str]], outer: pd.DataFrame) -> dict[str, list]:
    """Path of every node of a superblock: inner siblings, then its root's outer ones."""
    beside = [siblings(level) for level in tower[:-1]]
    told = outer.iloc[0]
    above, where = list(told["proof"]), [int(p) for p in told["places"]]
    proofs, places = [], []
    for i in range(len(tower[0])):
        proofs.append([s[i // FAN**k] for k, s in enumerate(beside)] + above)
        places.append([i // FAN**k % FAN for k in range(len(beside))] + where)
    return {"proof": proofs, "places": places, **{c: [told[c]] * len(proofs) for c in ("subroot", "root")}}


def _outward(block: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
    """Paths of inner nodes, which are the outer rows of the superblocks below."""
    block, tower = _ordered(block)
    return pd.DataFrame({"tree": block["tree"], "pos": block["pos"], **_paths(tower, outer)})


def _finish(block: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
    """Rows of a superblock of leaves: paths, and the root that the claimed leaf (else the leaf) folds to."""
    block, tower = _ordered(block)
    paths = _paths(tower, outer)
    claimed = [leaf if c is None else bytes(c).hex() for leaf, c in zip(tower[0], block["claim"])]
    folded = [fold(*x) for x in zip(claimed, paths["proof"], paths["places"])]
    return pd.DataFrame({"key": block["key"], "leaf": tower[0], "tree": block["tree"], "folded_root": folded, **paths})


def _blocks(nodes: DataFrame) -> DataFrame:
    return nodes.withColumn("block", F.expr(f"pos div {BLOCK}"))


def _climb(nodes: DataFrame) -> list[DataFrame]:
    """Stored tiers from the nodes up to one node per tree; at least one tier above the first."""
    tiers = [nodes]
    while True:
        up = _blocks(tiers[-1].select("tree", "pos", "of", "node")).groupBy("tree", "block")
        tiers.append(hand_off(up.applyInPandas(_reduce, "tree string, pos long, of long, node binary"), "tier"))
        if (tiers[-1].agg(F.max("of")).first()[0] or 0) <= 1:
            return tiers


def _exchange(nodes: DataFrame, outer: DataFrame, fn, schema: str) -> DataFrame:
    """Cogroup each superblock with its outer row."""
    below = _blocks(nodes).groupBy("tree", "block")
    above = outer.select("tree", F.col("pos").alias("block"), *_PATH_COLUMNS).groupBy("tree", "block")
    return below.cogroup(above).applyInPandas(fn, schema)


def _descend(tiers: list[DataFrame], outer: DataFrame) -> DataFrame:
    """Paths of the nodes of the lowest tier but the first, from those of the highest."""
    for tier in reversed(tiers[1:-1]):
        nodes = tier.select("tree", "pos", "of", "node")
        outer = hand_off(_exchange(nodes, outer, _outward, f"tree string, pos long, {_PATH}"), "paths")
    return outer


def manifest(
    rows: DataFrame, key: str = "doc_id", tree: str = "lang", fields: Sequence[str] = FIELDS, claim: Column | None = None
) -> DataFrame:
    """One row per row: key, leaf, proof, places, subroot, root, folded_root, verified.

    ``proof`` holds per level, from the leaf up through its tree's root to the top root, the joined hex digests of the
    run's other nodes, ``places`` the node's place among them. ``claim`` is a leaf digest (32 bytes,
    ``leaf_digest``) that a holder of the row presents; it is folded in place of the true leaf, if not NULL.
    """
    spark = rows.sparkSession
    ship(spark)
    kind = rows.schema[key].dataType
    sheet = rows.select(
        F.col(key).alias("key"),
        # Keeps NULL apart from texts and before them; bytes stay in order.
        F.coalesce(F.concat(F.lit("="), F.col(tree).cast("string")), F.lit("-")).alias("tree"),
        leaf_digest([F.col(f) for f in fields]).alias("node"),
        (F.lit(None).cast("binary") if claim is None else claim).alias("claim"),
    )
    leaves = ranked(hand_off(sheet, "leaves"), ["tree"], ["key", "node"])
    leaves = hand_off(leaves.withColumn("key", F.col("key").cast("string")), "ranked")
    own = _climb(leaves)
    names = own[-1].select(F.col("tree").alias("name"), "node")
    tops = hand_off(ranked(names, [], ["name"]).withColumn("tree", F.lit("")), "subroots")
    top = _climb(tops)
    nothing = [F.array().cast("array<string>").alias("proof"), F.array().cast("array<int>").alias("places"), F.lit("").alias("subroot")]
    summit = top[-1].select("tree", "pos", *nothing, F.lower(F.hex("node")).alias("root"))
    found = _exchange(
        tops.select("tree", "pos", "of", "node", F.col("name").alias("key"), F.lit(None).cast("binary").alias("claim")),
        _descend(top, summit),
        _finish,
        _TOLD,
    )
    roots = found.select(F.col("key").alias("tree"), F.lit(0).cast("long").alias("pos"), "proof", "places", F.col("leaf").alias("subroot"), "root")
    told = _exchange(leaves, _descend(own, hand_off(roots, "roots")), _finish, _TOLD)
    return told.select(
        F.col("key").cast(kind).alias(key),
        "leaf",
        "proof",
        "places",
        "subroot",
        "root",
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


def op11_manifest(documents: DataFrame) -> DataFrame:
    """The contract's columns; a third of the rows (by id) present a text put into lower case."""
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    changed = [F.translate("text", _UPPER, _LOWER) if f == "text" else F.col(f) for f in FIELDS]
    told = manifest(documents, claim=F.when(tampered, leaf_digest(changed)))
    proof = F.sha2(F.array_join("proof", "").cast("binary"), 256).alias("proof_sha256")
    return told.select("doc_id", "leaf", "subroot", "root", proof, "folded_root", "verified")

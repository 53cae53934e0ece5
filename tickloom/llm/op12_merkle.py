"""Merkle manifest of a dataset: leaves, proofs and folded proofs by exchange of subtrees."""

from __future__ import annotations

from collections.abc import Iterable
from hashlib import sha256

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm.common import fresh, running, table
from tickloom.session import written

ARITY = 3
LEVELS = 7  # levels that a superblock of 3^7 consecutive nodes reduces on its own
SLICE = 1 << 16  # rows of the global order that share one row of the table of offsets

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
NODES = "tree long, place long, size long, digest string"


def field(value: Column) -> Column:
    """A value as it is hashed: its UTF-8 byte count, a colon and itself; null is a hyphen."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(fields: Iterable[Column]) -> Column:
    return F.sha2(F.concat(*[field(f) for f in fields]), 256)


def tampered(text: Column, key: Column) -> Column:
    """The text without line feeds where the key's crc32 is even; a null key leaves it."""
    return F.when(F.crc32(key.cast("string")) % 2 == 0, F.replace(text, F.lit("\n"), F.lit(""))).otherwise(text)


def joined(digests: Iterable[str]) -> str:
    return sha256("".join(digests).encode()).hexdigest()


def height(size: int) -> int:
    """Levels above the nodes of a tree: one for each time that several nodes remain."""
    levels = 0
    while size > 1:
        size = -(-size // ARITY)
        levels += 1
    return levels


def rows_of_tree(digests: list[str], levels: int) -> list[list[str]]:
    """The nodes of a subtree, level by level, from those given to its top."""
    rows = [digests]
    for _ in range(levels):
        last = rows[-1]
        rows.append([joined(last[i : i + ARITY]) for i in range(0, len(last), ARITY)])
    return rows


def siblings(rows: list[list[str]], at: int) -> list[tuple[str, str]]:
    """On each level of a subtree, what stands left and right of a node in its run."""
    path = []
    for row in rows[:-1]:
        first = at - at % ARITY
        path.append(("".join(row[first:at]), "".join(row[at + 1 : first + ARITY])))
        at //= ARITY
    return path


def fold(digest: str, path: Iterable[tuple[str, str]]) -> str:
    for left, right in path:
        digest = joined((left, digest, right))
    return digest


def inside_rows(frame: pd.DataFrame, levels: int) -> list[list[str]]:
    """The levels that a superblock reduces, from its nodes in their order."""
    return rows_of_tree(frame["digest"].tolist(), min(levels, height(int(frame["size"].iloc[0]))))


def by_place(frame: pd.DataFrame) -> pd.DataFrame:
    return frame.sort_values("place", kind="stable")


def block(levels: int) -> Column:
    return F.floor(F.col("place") / ARITY**levels).alias("block")


def reduced(nodes: DataFrame, levels: int) -> DataFrame:
    """One node for each superblock: the next layer of every tree, of the columns NODES."""

    def top(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        digest = inside_rows(by_place(frame), levels)[-1][0]
        size = -(-int(frame["size"].iloc[0]) // ARITY**levels)
        return pd.DataFrame({"tree": [key[0]], "place": [key[1]], "size": [size], "digest": [digest]})

    return nodes.groupBy("tree", block(levels)).applyInPandas(top, NODES)


PATH = "left array<string>, right array<string>, top string"


def outer_paths(nodes: DataFrame, levels: int, name: str) -> DataFrame:
    """``tree``, ``place``, the siblings on the way up from each node, and the tree's ``top``.

    Superblocks of a layer are reduced to the next layer, until every tree is one node; then
    layer by layer downwards each superblock meets the path of its own node, which is all it
    needs from outside, and gives each of its nodes the path inside followed by that one.
    """
    layers = [nodes]
    while not layers[-1].filter("size > 1").isEmpty():
        layers.append(written(reduced(layers[-1], levels), f"{name}-layer"))
    empty = F.array().cast("array<string>")
    paths = layers[-1].select("tree", "place", empty.alias("left"), empty.alias("right"), F.col("digest").alias("top"))

    def extend(inside: pd.DataFrame, outside: pd.DataFrame) -> pd.DataFrame:
        inside, upper = by_place(inside), outside.iloc[0]
        rows = inside_rows(inside, levels)
        found = [siblings(rows, i) for i in range(len(inside))]
        return pd.DataFrame(
            {
                "tree": inside["tree"],
                "place": inside["place"],
                "left": [[a for a, _ in path] + list(upper["left"]) for path in found],
                "right": [[b for _, b in path] + list(upper["right"]) for path in found],
                "top": [upper["top"]] * len(found),
            }
        )

    for layer in reversed(layers[:-1]):
        paths = (
            layer.groupBy("tree", block(levels))
            .cogroup(paths.groupBy("tree", F.col("place").alias("block")))
            .applyInPandas(extend, f"tree long, place long, {PATH}")
        )
    return written(paths, f"{name}-paths")


def placed(leaves: DataFrame, source: str, order: list[str], name: str) -> DataFrame:
    """Adds ``tree``, ``place`` and ``size``: a source's number in order, the rank of a row in it, and its rows.

    Rows are ranked over all sources at once. Slices of consecutive ranks, not sources, are
    what the sources' first ranks are joined by, so a source of any size is spread.
    """
    ranked = running(leaves, [source, *order], {"_rank": F.lit(1)}, name)
    ranked = written(ranked.withColumn("_slice", F.floor(F.col("_rank") / SLICE)), f"{name}-ranked")
    parts = ranked.groupBy(source, "_slice").agg(F.min("_rank").alias("_low"), F.count(F.lit(1)).alias("_n"))
    whole = parts.groupBy(source).agg(F.min("_low").alias("tree"), F.sum("_n").alias("size"))
    of_source = whole.withColumnRenamed(source, "_source")
    offsets = parts.join(of_source, F.col(source).eqNullSafe(F.col("_source"))).select(
        F.col(source).alias("_source"), F.col("_slice").alias("_part"), "tree", "size"
    )
    same = (F.col("_slice") == F.col("_part")) & F.col(source).eqNullSafe(F.col("_source"))
    return ranked.join(offsets, same).withColumn("place", F.col("_rank") - F.col("tree")).drop(
        "_rank", "_slice", "_part", "_source"
    )


def manifest(documents: DataFrame, key: str, source: str, fields: tuple[str, ...], text: str, levels: int = LEVELS) -> DataFrame:
    """Adds digests and proofs to the key of every document.

    A leaf hashes the ``fields``. Per source, leaves ascend by key; while several nodes
    remain, each three consecutive ones become one. What remains of the sources, ordered by
    source, likewise gives ``root``. ``proof`` is the list of siblings from leaf to root, level
    by level and left to right; ``folded_root`` is recomputed from the leaf of the tampered
    row and these. Null sources are one source, the first; null keys come first and are never
    tampered with. Rows of one key are ordered by their leaves, so equal rows are
    leaves of their own next to each other. An empty table has no rows and no root.

    Digests are made where the rows are read and only they are shuffled. Superblocks of
    3^levels consecutive leaves are reduced by one task each; their nodes (by default a
    two-thousandth of the rows) likewise, layer by layer. At last leaves and the outer siblings of their
    superblock are cogrouped, and one function finishes the local levels, joins the proofs
    and folds them.
    """
    other = [tampered(F.col(c), F.col(key)) if c == text else F.col(c) for c in fields]
    leaves = documents.select(
        F.col(key).cast("long").alias("key"),
        F.col(source).alias("source"),
        leaf(F.col(c) for c in fields).alias("digest"),
        leaf(other).alias("changed"),
    )
    nodes = placed(leaves, "source", ["key", "digest", "changed"], "op12-leaves").drop("source")
    nodes = written(nodes, "op12-nodes")
    above = written(reduced(nodes, levels), "op12-layer")
    inner = outer_paths(above, levels, "op12-sources")
    subroots = inner.filter("place = 0").select("tree", F.col("top").alias("digest"))
    ordered = running(subroots, ["tree"], {"place": F.lit(1)}, "op12-subroots")
    size = F.lit(subroots.count()).cast("long")
    roots = written(ordered.select(F.lit(0).cast("long").alias("tree"), "place", size.alias("size"), "digest", F.col("tree").alias("of")), "op12-roots")
    ways = outer_paths(roots.drop("of"), levels, "op12-root").drop("tree")
    upper = roots.select("place", "of").join(ways, "place").select(
        F.col("of").alias("tree"), F.col("left").alias("left_up"), F.col("right").alias("right_up"), F.col("top").alias("root")
    )
    outer = inner.join(upper, "tree").select(
        "tree",
        F.col("place").alias("block"),
        F.concat("left", "left_up").alias("left"),
        F.concat("right", "right_up").alias("right"),
        F.col("top").alias("subroot"),
        "root",
    )

    def finish(inside: pd.DataFrame, outside: pd.DataFrame) -> pd.DataFrame:
        inside, upper = by_place(inside), outside.iloc[0]
        outer_path = list(zip(upper["left"], upper["right"], strict=True))
        rows = inside_rows(inside, levels)
        proofs, folded = [], []
        for at, changed in enumerate(inside["changed"]):
            path = siblings(rows, at) + outer_path
            proofs.append([d for pair in path for side in pair for d in cut(side)])
            folded.append(fold(changed, path))
        return pd.DataFrame(
            {
                "key": inside["key"].astype("Int64"),
                "leaf": inside["digest"],
                "subroot": upper["subroot"],
                "root": upper["root"],
                "proof": proofs,
                "folded_root": folded,
            }
        )

    names = "key long, leaf string, subroot string, root string, proof array<string>, folded_root string"
    made = nodes.groupBy("tree", block(levels)).cogroup(outer.groupBy("tree", "block")).applyInPandas(finish, names)
    out = fresh(("leaf", "subroot", "root", "proof", "folded_root"), key)
    return made.withColumnRenamed("key", out)


def cut(digests: str) -> list[str]:
    return [digests[i : i + 64] for i in range(0, len(digests), 64)]


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest of all documents, with the proofs' digests."""
    made = manifest(table(spark, sf_dir, "documents"), "doc_id", "source", FIELDS, "text")
    return made.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        F.sha2(F.concat_ws("", "proof"), 256).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )

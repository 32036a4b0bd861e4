"""Merkle manifest of a dataset: a tree of fan-out 16 per source, and one over the sources.

Concatenated-level strings. The nodes of a level are dealt to aligned blocks of 16^3; a block keeps each of its levels as
one string of 64 hex digits a node. A parent is the hash of a fixed-width piece of that string, and the siblings of a node are
the two pieces beside it. The tops of the blocks are the nodes of the next round, and the roots of the trees those of the tree
above them, so no task ever holds more than one block, however many rows a source has.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from .ranks import placed
from .shared import narrow_side, written

DIGEST, FAN = 64, 16
RUN = DIGEST * FAN
BLOCK = FAN**3
STEPS = "array<struct<left:string,right:string>>"


def digest(*parts: Column) -> Column:
    """Lowercase hex SHA-256 of texts put together."""
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """Byte count, colon and value; a dash for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_of(*values: Column) -> Column:
    return digest(*[field(v) for v in values])


def proof_of(path: Column) -> Column:
    """Hash of all siblings on the way up, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""), 256)


def folded(leaf: Column, path: Column) -> Column:
    """The root that follows from a leaf and the siblings on its way up."""
    return F.aggregate(path, leaf, lambda node, s: digest(s["left"], node, s["right"]))


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _parents(level: Column) -> Column:
    """The level above, as one string."""

    def hashed(text: Column) -> Column:
        runs = F.sequence(F.lit(0), F.ceil(F.length(text) / RUN).cast("int") - 1)
        return F.array_join(F.transform(runs, lambda i: F.sha2(F.substring(text, i * RUN + 1, F.lit(RUN)), 256)), "")

    # Pieces of bytes are found without counting characters.
    return _let(level.cast("binary"), hashed)


def _blocks(nodes: DataFrame, payload: Sequence[str]) -> DataFrame:
    """``nodes`` (tree, pos, n, digest, payload) -> (tree, n, block, rows, level0-2, levels, top), n being the tree's nodes."""
    rows = F.array_sort(F.collect_list(F.struct("pos", "digest", *payload)))
    grouped = nodes.groupBy("tree", "n", F.floor(F.col("pos") / BLOCK).alias("block")).agg(rows.alias("rows"))
    joined = grouped.withColumn("level0", F.array_join("rows.digest", ""))
    for k in range(3):
        joined = joined.withColumn(f"level{k + 1}", _parents(F.col(f"level{k}")))
    steps = F.when(F.col("n") == 1, 0).when(F.col("n") <= FAN, 1).when(F.col("n") <= FAN**2, 2).otherwise(3)
    top = F.element_at(F.array(*[F.col(f"level{k}") for k in range(4)]), steps + 1)
    kept = F.transform("rows", lambda r: F.struct(F.lit(True).alias("__node"), *[r[c].alias(c) for c in payload]))
    return joined.select("tree", "n", "block", kept.alias("rows"), "level0", "level1", "level2", steps.alias("levels"), top.alias("top"))


def _nodes(blocks: DataFrame, payload: Sequence[str], above: Sequence[str]) -> DataFrame:
    """The nodes of ``blocks`` (which has ``upper``, the steps above a block) with the steps of each: (tree, pos, digest, path)."""
    run = F.explode(F.sequence(F.lit(0), F.ceil(F.size("rows") / FAN).cast("int") - 1)).alias("run")
    runs = blocks.select("*", run)

    def piece(level: str, at: Column) -> Column:
        return F.substring(F.col(level).cast("binary"), at * RUN + 1, F.lit(RUN)).cast("string")

    second, third = F.floor(F.col("run") / FAN).cast("int"), F.lit(0)
    runs = runs.select(
        "tree", "block", "levels", "upper", "run", *above, F.slice("rows", F.col("run") * FAN + 1, FAN).alias("rows"),
        piece("level0", F.col("run")).alias("run0"), piece("level1", second).alias("run1"), piece("level2", third).alias("run2"),
    )
    leaves = runs.select("*", F.posexplode("rows").alias("at", "row"))
    places = [F.col("at"), F.col("run") % FAN, F.floor(F.col("run") / FAN).cast("int")]

    def step(k: int, at: Column) -> Column:
        text = F.col(f"run{k}")
        return F.struct(F.substring(text, F.lit(1), at * DIGEST).alias("left"), F.substring(text, at * DIGEST + DIGEST + 1, F.lit(RUN)).alias("right"))

    own = F.slice(F.array(*[step(k, at) for k, at in enumerate(places)]), F.lit(1), F.col("levels"))
    return leaves.select(
        "tree",
        (F.col("block") * BLOCK + F.col("run") * FAN + F.col("at")).alias("pos"),
        F.substring("run0", F.col("at") * DIGEST + 1, F.lit(DIGEST)).alias("digest"),
        F.concat(own, F.col("upper")).alias("path"),
        *[F.col("row")[c].alias(c) for c in payload],
        *above,
    )


def _climbed(nodes: DataFrame, payload: Sequence[str]) -> tuple[DataFrame, DataFrame | None, DataFrame]:
    """Rounds of blocks up to the roots: the blocks of ``nodes``, the steps above each of them, and (tree, root)."""
    rounds, roots, payload = [], None, list(payload)
    while True:
        blocks = written(_blocks(nodes, [] if rounds else payload), "blocks")
        rounds.append(blocks)
        done = blocks.where(F.col("n") <= BLOCK).select("tree", F.col("top").alias("root"))
        roots = done if roots is None else roots.unionByName(done)
        if (blocks.agg(F.max("n")).first()[0] or 0) <= BLOCK:
            break
        more = blocks.where(F.col("n") > BLOCK)
        nodes = more.select("tree", F.col("block").alias("pos"), F.ceil(F.col("n") / BLOCK).alias("n"), F.col("top").alias("digest"))
    upper = None
    for blocks in reversed(rounds[1:]):
        found = _nodes(_below(blocks, upper), [], [])
        upper = written(found.select("tree", F.col("pos").alias("block"), F.col("path").alias("upper")), "upper")
    return rounds[0], upper, written(roots, "roots")


def _below(blocks: DataFrame, upper: DataFrame | None) -> DataFrame:
    none = F.array().cast(STEPS)
    if upper is None:
        return blocks.withColumn("upper", none)
    return blocks.join(upper, ["tree", "block"], "left").withColumn("upper", F.coalesce("upper", none))


def manifest(docs: DataFrame, leaf: Column, key: str = "doc_id", source: str = "source", carry: dict[str, Column] | None = None) -> DataFrame:
    """(key, leaf, subroot, root, path) for every row, and the columns named in ``carry``.

    ``path`` has, from leaf to root, the siblings left and right of the node on each level; both are empty where a node is
    alone in its run. Leaves of a source ascend by key (null first); equal keys go by leaf, repeated rows share the places
    next to each other in any order. Sources go by their bytes, null first. Other columns are not looked at. No rows: none.
    """
    carry = carry or {}
    extra = {f"__carry{i}": c for i, c in enumerate(carry.values())}
    # A text that orders like the source and is never null; the row number tells repeated rows apart.
    tree = F.coalesce(F.concat(F.lit("="), F.col(source).cast("string")), F.lit(""))
    leaves = written(docs.select(F.col(key).alias("__key"), tree.alias("tree"), leaf.alias("digest"), F.monotonically_increasing_id().alias("__row"), *[c.alias(n) for n, c in extra.items()]), "leaves")
    kept = ["__key", *extra]
    nodes = placed(leaves, ["__key", "digest", "__row"], group=["tree"])
    nodes = nodes.withColumnsRenamed({"__before": "pos", "__total": "n"}).drop("__row")
    blocks, upper, roots = _climbed(nodes, kept)
    tops = placed(roots.withColumnRenamed("root", "digest"), ["tree"]).withColumnsRenamed({"__before": "pos", "__total": "n", "tree": "__tree"})
    over, beyond, root = _climbed(tops.withColumn("tree", F.lit("")), ["__tree"])
    last = _nodes(_below(over, beyond), ["__tree"], []).join(root.select("tree", "root"), "tree")
    trees = written(last.select(F.col("__tree").alias("tree"), F.col("digest").alias("__subroot"), F.col("root").alias("__root"), F.col("path").alias("__last")), "trees")
    # What lies above a block meets the block, not its rows.
    above = _below(blocks.select("tree", "block"), upper).join(narrow_side(trees, 16 * RUN), "tree")
    above = above.select("tree", "block", F.concat("upper", "__last").alias("upper"), "__subroot", "__root")
    found = _nodes(blocks.join(above, ["tree", "block"]), kept, ["__subroot", "__root"])
    return found.select(F.col("__key").alias(key), F.col("digest").alias("leaf"), F.col("__subroot").alias("subroot"), F.col("__root").alias("root"), "path", *[F.col(n).alias(c) for n, c in zip(extra, carry)])

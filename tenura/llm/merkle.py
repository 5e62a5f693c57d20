"""Merkle manifest of a data set as a persistent tree: versions copy a path of nodes and share all others."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tenura.llm.texts import ascii_lower, bounded
from tenura.operators.ordered import matched
from tenura.session import checkpointed

FAN = 8
# Levels of an aligned block: a block holds FAN ** LEVELS nodes of the level it starts from.
LEVELS = 3
BLOCK = FAN**LEVELS
# Paths of a few KB each: tables of at most this many go to all tasks.
PATH_ROWS = 5_000
STEP = "struct<before:string,after:string>"
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(parts: Column) -> Column:
    """Lowercase hex SHA-256 of the joined strings of an array."""
    return F.sha2(F.array_join(parts, ""), 256)


def leaf_digest(values: list[Column]) -> Column:
    """Digest of a row: each value as its UTF-8 byte count, a colon and itself, or ``-`` for NULL."""
    texts = [v.cast("string") for v in values]
    parts = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat(*parts), 256)


def tampered_ids(doc_id: Column | str = "doc_id") -> Column:
    """Whether a document is tampered with: 3 divides the crc32 of its id as text. Never for a NULL id."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(column.cast("string").cast("binary")) % 3 == 0, F.lit(False))


def leaves(docs: DataFrame) -> DataFrame:
    """(lang, doc_id, leaf, changed): the digest of each row, and that of its tampered form or NULL."""
    row = {name: F.col(name) for name in FIELDS}
    lowered = {**row, "text": ascii_lower(F.col("text").cast("string"))}
    changed = F.when(tampered_ids(), leaf_digest(list(lowered.values())))
    return docs.select(
        F.col("lang").cast("string").alias("lang"), F.col("doc_id").cast("bigint").alias("doc_id"),
        leaf_digest(list(row.values())).alias("leaf"), changed.alias("changed"),
    )


def numbered(df: DataFrame, order: list[str]) -> DataFrame:
    """``df`` with ``place``, 0 to n - 1 in ascending order, NULL first, without a sort on one task.

    Rows are dealt to ranges and sorted there; a row's serial number splits even a range of equal rows. The result is
    a stored table, so later reads see the same numbers. Only one row per range meets in a task.
    """
    ranged = df.withColumn("_serial", F.monotonically_increasing_id())
    keys = [*order, "_serial"]
    held = checkpointed(ranged.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_serial").withColumn("_row", F.monotonically_increasing_id()))
    part = F.shiftright("_row", 33)
    sizes = held.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    ahead = Window.partitionBy(F.lit(0)).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_start"))
    inside = F.col("_row").bitwiseAND(F.lit((1 << 33) - 1))
    joined = held.withColumn("_part", part).join(F.broadcast(starts), "_part")  # one row a task of the sort
    return joined.withColumn("place", F.col("_start") + inside).drop("_part", "_start", "_row")


def tree_height(rows: Column) -> Column:
    """Levels above the leaves: how often ``rows`` nodes in runs of FAN become one."""
    powers = F.array(*[F.lit(FAN**k).cast("bigint") for k in range(21)])
    return F.size(F.filter(powers, lambda p: p < rows))


def parents(nodes: Column) -> Column:
    """The next level: a digest of every FAN consecutive nodes, the last run with what is left."""
    runs = F.sequence(F.lit(0), F.ceil(F.size(nodes) / F.lit(FAN)).cast("int") - 1)
    return F.transform(runs, lambda r: digest(F.slice(nodes, r * FAN + 1, F.lit(FAN))))


def siblings(level: Column, place: Column) -> Column:
    """The joined digests before and after a node in its run."""
    start = place - place % FAN
    before = F.array_join(F.slice(level, start + 1, place - start), "")
    after = F.array_join(F.slice(level, place + 2, FAN - 1 - (place - start)), "")
    return F.struct(before.alias("before"), after.alias("after"))


def copied_path(leaf: Column, path: Column) -> Column:
    """The nodes that a version with this leaf has of its own: the leaf and each ancestor up to the root."""
    def ancestor(nodes: Column, step: Column) -> Column:
        node = F.sha2(F.concat(step["before"], F.element_at(nodes, -1), step["after"]), 256)
        return F.concat(nodes, F.array(node))

    return F.aggregate(path, F.array(leaf), ancestor)


def proof_digest(path: Column) -> Column:
    """Digest of all siblings of a path, level by level, left to right."""
    return digest(F.transform(path, lambda step: F.concat(step["before"], step["after"])))


def _inner(node: Column) -> Column:
    """Path of the ``node``-th entry of a block inside that block."""
    steps = [
        F.when(F.col("up") > k, siblings(F.col(f"l{k}"), F.floor(node / F.lit(FAN**k)).cast("int"))) for k in range(LEVELS)
    ]
    return F.array_compact(F.array(*steps))


@dataclass(frozen=True)
class Forest:
    """Trees over numbered nodes, in stored layers of aligned blocks.

    ``layers[k]`` has a row per block: (tree, block, entries, l0, l1, l2, up, top); ``entries`` are what the nodes carry,
    in order, ``l0`` to ``l2`` the digests of the levels inside the block, ``up`` how many levels the block adds and
    ``top`` the last of them. The tops of a layer are the nodes of the next one. ``roots`` is (tree, height, root).
    """

    layers: list[DataFrame]
    roots: DataFrame


def forest(nodes: DataFrame, carried: list[str]) -> Forest:
    """Trees of ``nodes`` (tree, place, digest and the carried columns); places are 0 to n - 1 in each tree.

    Blocks are bounded groups, so a tree with nearly all nodes is as many groups as its size asks for.
    """
    heights = checkpointed(nodes.groupBy("tree").agg(tree_height(F.count(F.lit(1))).alias("height")))
    highest = heights.agg(F.max("height")).first()[0]
    layers: list[DataFrame] = []
    level = nodes.select("tree", "place", "digest", F.struct(F.col("digest"), *carried).alias("entry"))
    roots = None
    for done in range(0, (highest or 0) + 1, LEVELS):
        entry = F.sort_array(F.collect_list(F.struct("place", "entry")))
        blocks = level.groupBy("tree", F.floor(F.col("place") / BLOCK).cast("bigint").alias("block")).agg(entry.alias("rows"))
        up = F.least(F.lit(LEVELS), F.col("height") - done)
        known = (
            matched(blocks, bounded(heights), ["tree"], False)
            .select("tree", "block", "height", F.col("rows.entry").alias("entries"), up.alias("up"))
            .withColumn("l0", F.col("entries.digest"))
        )
        for k in range(1, LEVELS):
            known = known.withColumn(f"l{k}", F.when(F.col("up") >= k, parents(F.col(f"l{k - 1}"))))
        top = F.when(F.col("up") == LEVELS, digest(F.col(f"l{LEVELS - 1}")))
        for k in range(LEVELS):
            top = top.when(F.col("up") == k, F.col(f"l{k}")[0])
        layer = checkpointed(known.withColumn("top", top))
        layers.append(layer)
        finished = layer.where(F.col("height") <= done + LEVELS).select("tree", "height", F.col("top").alias("root"))
        roots = finished if roots is None else roots.union(finished)
        level = layer.where(F.col("height") > done + LEVELS).select(
            "tree", F.col("block").alias("place"), F.col("top").alias("digest"), F.struct(F.col("top").alias("digest")).alias("entry"))
    return Forest(layers, checkpointed(roots))


def unfolded(trees: Forest, ends: DataFrame) -> DataFrame:
    """(tree, place, entry, path, and the columns of ``ends``) of every node: its siblings up to the root and beyond.

    ``ends`` has for each tree the path that follows its root, ``path``, and more columns to hand down. Paths come down
    layer by layer: a block's path is joined to it once and each of its nodes puts its own steps before it.
    """
    handed = [c for c in ends.columns if c not in ("tree", "path")]
    paths = None
    for depth in range(len(trees.layers) - 1, -1, -1):
        layer = trees.layers[depth]
        whole = layer.where(F.col("height") <= LEVELS * (depth + 1))
        joined = matched(whole, ends, ["tree"], False)
        if paths is not None:
            joined = joined.unionByName(layer.join(bounded(paths, PATH_ROWS), ["tree", "block"]).select(*joined.columns))
        every = F.transform(
            F.sequence(F.lit(0), F.size("entries") - 1),
            lambda j: F.struct(
                (F.col("block") * BLOCK + j).alias("place"), F.get("entries", j).alias("entry"),
                F.concat(_inner(j), F.col("path")).alias("path"),
            ),
        )
        rows = joined.select("tree", *handed, F.inline(every))
        if depth:
            paths = rows.select("tree", F.col("place").alias("block"), "path", *handed)
    return rows


@dataclass(frozen=True)
class Manifest:
    """``documents`` has per row: doc_id, lang, leaf, changed, subroot, root and path; ``subtrees`` (lang, rows, subroot)."""

    documents: DataFrame
    subtrees: DataFrame
    root: str | None


def manifest(rows: DataFrame) -> Manifest:
    """The trees of ``leaves`` rows: one per language in order of doc_id, and one over the languages' roots.

    Rows of one doc_id lie in the order of their digests, a NULL doc_id first; NULL is a language, the first. Without
    rows there is no root.
    """
    placed = checkpointed(numbered(rows, ["lang", "doc_id", "leaf"]))
    groups = numbered(placed.groupBy("lang").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("rows")), ["lang"])
    groups = bounded(groups.withColumnRenamed("place", "tree"))
    nodes = matched(placed, groups, ["lang"], False).select(
        "tree", (F.col("place") - F.col("first")).alias("place"), F.col("leaf").alias("digest"), "doc_id", "changed")
    below = forest(nodes, ["doc_id", "changed"])
    tops = below.roots.select(F.lit(0).cast("bigint").alias("tree"), F.col("tree").alias("place"), F.col("root").alias("digest"))
    above = forest(tops, [])
    whole = above.roots.first()
    root = whole["root"] if whole else None
    no_path = F.array().cast(f"array<{STEP}>")
    ends = rows.sparkSession.range(1).select(F.col("id").alias("tree"), no_path.alias("path"))
    subroots = unfolded(above, ends).select(F.col("place").alias("tree"), F.col("entry.digest").alias("subroot"), "path")
    subtrees = bounded(matched(subroots, groups.select("tree", "lang", "rows"), ["tree"], False), PATH_ROWS)
    documents = unfolded(below, subtrees.select("tree", "subroot", "path", "lang")).select(
        F.col("entry.doc_id").alias("doc_id"), "lang", F.col("entry.digest").alias("leaf"), F.col("entry.changed").alias("changed"),
        "subroot", F.lit(root).cast("string").alias("root"), "path",
    )
    return Manifest(documents, subtrees.select("lang", "rows", "subroot"), root)


def versions(made: Manifest) -> DataFrame:
    """(doc_id, lang, height, digest): the nodes that each tampered leaf's version has of its own, leaf at height 0.

    All other nodes of a version are those of the manifest; the node of the largest height is the version's root.
    """
    own = made.documents.where(F.col("changed").isNotNull()).withColumn("nodes", copied_path(F.col("changed"), F.col("path")))
    return own.select("doc_id", "lang", F.posexplode("nodes").alias("height", "digest"))


def verified_documents(docs: DataFrame) -> DataFrame:
    """One row per row: doc_id, leaf, subroot, root, proof_sha256, folded_root and verified.

    A tampered row makes a version: its leaf changes, each ancestor is copied, siblings are shared, so ``folded_root`` is
    the version's root. An untouched row folds its own leaf, which gives the root again. NULL columns count as ``-``; a
    NULL text stays NULL when tampered with, a row with a NULL doc_id is never tampered with, and a text without A-Z
    does not change. Repeated rows are leaves each. An empty table gives no rows; other columns are ignored.
    """
    documents = manifest(leaves(docs)).documents
    nodes = copied_path(F.coalesce("changed", "leaf"), F.col("path"))
    folded = documents.withColumn("folded_root", F.element_at(nodes, -1))
    return folded.select(
        "doc_id", "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"), "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )

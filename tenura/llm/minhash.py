"""Near-duplicate groups: universal hash minima, banding, verification and connected components."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenura.llm.components import components
from tenura.llm.merkle import numbered
from tenura.llm.texts import CACHE_WORDS, bounded, by_slice, free_name, mixed, released, small_batches, space_words
from tenura.session import checkpointed

SIGNATURE = pa.schema([
    ("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("h1", pa.int64()), ("h2", pa.int64()), ("signature", pa.binary()),
])
SETS = pa.schema([("node", pa.int64()), ("shingles", pa.list_(pa.int64()))])


@dataclass(frozen=True)
class NearDuplicates:
    """Settings of the operator.

    Documents are linked when ``100 * |A and B| >= percent * |A or B|`` over their distinct word shingles. With 25 bands of
    4 rows a pair at 0.8 shares no bucket with probability 2e-6. ``screen`` is the share of equal minima below which a
    pair is dropped before its full sets are compared; at 100 minima 0.6 lies five standard deviations below 0.8.
    ``block_rows`` and ``block_shingles`` bound what a task compares at once in a bucket that a star cannot settle.
    What is known of buckets with more than ``hot_rows`` classes is sent to the rows instead of the rows to one task.
    """

    words: int = 2
    percent: int = 80
    bands: int = 25
    rows: int = 4
    screen: float = 0.6
    block_rows: int = 400
    block_shingles: int = 1 << 20
    hot_rows: int = 1_000
    seed: int = 20_240_607

    def coefficients(self) -> tuple[np.ndarray, np.ndarray]:
        drawn = np.random.default_rng(self.seed).integers(0, 2**63, (2, self.bands * self.rows), dtype=np.uint64)
        return drawn[0] * np.uint64(2) + np.uint64(1), drawn[1]


class Shingler:
    """Distinct shingle hashes (64 bits) of a text; word hashes are kept in a cache of bounded size."""

    def __init__(self, words: int):
        self.words = words
        self.known: dict[bytes, int] = {}

    def __call__(self, text: str | None) -> np.ndarray:
        words = [w for w in space_words(text)]
        if not words:
            return np.empty(0, np.uint64)
        words = b"\n".join(words).lower().split(b"\n")
        known = self.known
        if len(known) > CACHE_WORDS:
            known.clear()
        for word in set(words).difference(known):
            known[word] = xxhash.xxh3_64_intdigest(word)
        hashes = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        size = min(self.words, len(hashes))
        mix = mixed(hashes[: len(hashes) - size + 1] + np.uint64(size))
        for i in range(1, size):
            mix = mixed(mix * np.uint64(0x9E3779B97F4A7C15) + hashes[i : len(hashes) - size + 1 + i])
        return np.unique(mix)


def minima(shingles: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The last 16 bits of the least multiply-shift hash (upper 32 bits) over a set, block by block."""
    least = np.full(len(a), 0xFFFFFFFF, np.uint64)
    for start in range(0, len(shingles), 256):
        block = shingles[start : start + 256]
        least = np.minimum(least, ((a[:, None] * block + b[:, None]) >> np.uint64(32)).min(axis=1))
    return least.astype(np.uint16)


def signatures(docs: DataFrame, how: NearDuplicates) -> DataFrame:
    """Per document: set size, two hashes of the whole set and the minima (16 bits each)."""
    a, b = how.coefficients()

    def run(batches):
        shingler = Shingler(how.words)

        def work(piece: pa.RecordBatch) -> dict[str, object]:
            out: dict[str, list] = {"n_shingles": [], "h1": [], "h2": [], "signature": []}
            for text in piece.column(1).to_pylist():
                shingles = shingler(text)
                out["n_shingles"].append(len(shingles))
                raw = xxhash.xxh3_128_digest(shingles.tobytes())
                out["h1"].append(int.from_bytes(raw[:8], "little", signed=True))
                out["h2"].append(int.from_bytes(raw[8:], "little", signed=True))
                out["signature"].append(minima(shingles, a, b).tobytes() if len(shingles) else b"")
            return {"doc_id": piece.column(0), **out}

        yield from by_slice(work, SIGNATURE)(batches)
        shingler.known.clear()
        released()

    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id bigint, n_shingles bigint, h1 bigint, h2 bigint, signature binary"
    )


def shingle_sets(docs: DataFrame, how: NearDuplicates) -> DataFrame:
    """(node, shingles) of whole texts."""

    def run(batches):
        shingler = Shingler(how.words)

        def work(piece: pa.RecordBatch) -> dict[str, object]:
            found = [shingler(text).view(np.int64) for text in piece.column(1).to_pylist()]
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in found])]).astype(np.int32)
            values = pa.array(np.concatenate(found) if found else np.empty(0, np.int64))
            return {"node": piece.column(0), "shingles": pa.ListArray.from_arrays(pa.array(offsets), values)}

        yield from by_slice(work, SETS)(batches)
        shingler.known.clear()
        released()

    return docs.mapInArrow(run, "node bigint, shingles array<bigint>")


def _equal_minima(left: str, right: str, how: NearDuplicates):
    same = [
        (F.substring(left, 2 * i + 1, 2) == F.substring(right, 2 * i + 1, 2)).cast("int")
        for i in range(how.bands * how.rows)
    ]
    total = same[0]
    for one in same[1:]:
        total = total + one
    return total


class _Links:
    """Candidate pairs become links: first the minima are compared, then the full sets."""

    def __init__(self, docs: DataFrame, classes: DataFrame, how: NearDuplicates):
        self.docs, self.classes, self.how = docs, classes, how

    def verified(self, pairs: DataFrame) -> DataFrame:
        """Distinct linked pairs (a, b) of candidate pairs (a, b), a < b."""
        how = self.how
        minima_of = self.classes.select("node", "signature")
        screened = checkpointed(
            pairs.distinct()
            .join(minima_of.toDF("a", "_sa"), "a")
            .join(minima_of.toDF("b", "_sb"), "b")
            .where(_equal_minima("_sa", "_sb", how) >= how.screen * how.bands * how.rows)
            .select("a", "b")
        )
        wanted = screened.select(F.explode(F.array("a", "b")).alias("node")).distinct()
        with small_batches(self.docs.sparkSession):
            sets = checkpointed(shingle_sets(self._texts(wanted), how))
        joined = (
            screened.join(sets.toDF("a", "_a"), "a").join(sets.toDF("b", "_b"), "b")
            .withColumn("_both", F.size(F.array_intersect("_a", "_b")))
        )
        union = F.size("_a") + F.size("_b") - F.col("_both")
        linked = (F.col("_both") > 0) & (F.lit(100) * F.col("_both") >= F.lit(how.percent) * union)
        return joined.where(linked).select("a", "b").distinct()


    def between_blocks(self, left: DataFrame) -> DataFrame:
        """Links (a, b) that join the components which meet in a bucket; see ``near_duplicates``."""
        how = self.how
        with small_batches(self.docs.sparkSession):
            sets = checkpointed(shingle_sets(self._texts(left.select("node").distinct()), how))
        known = sets.join(self.classes, "node").withColumn("_size", F.size("shingles"))
        sized = checkpointed(left.join(known.select("node", "_size"), "node"))
        outside = F.col("root") != F.col("major")

        def blocks(rows, size):
            return F.greatest(F.ceil(rows / F.lit(how.block_rows)), F.ceil(size / F.lit(how.block_shingles)), F.lit(1)).cast("int")

        counts = sized.groupBy("bucket").agg(
            blocks(F.count_if(outside), F.sum(F.when(outside, F.col("_size")))).alias("_nq"),
            blocks(F.count(F.lit(1)), F.sum("_size")).alias("_nd"), F.count(F.lit(1)).alias("_rows"),
        )
        dealt = _with_facts(sized, counts, how).withColumn("_h", F.xxhash64("node"))

        def every(n):
            return F.explode(F.sequence(F.lit(0), n - 1))

        asked = dealt.where(outside).select(
            "bucket", F.pmod("_h", "_nq").cast("int").alias("q"), every(F.col("_nd")).alias("d"), "node", "root", F.lit(True).alias("asked")
        )
        others = dealt.select(
            "bucket", every(F.col("_nq")).alias("q"), F.pmod("_h", "_nd").cast("int").alias("d"), "node", "root", F.lit(False).alias("asked")
        )
        rows = asked.union(others).join(known.select("node", "signature", "shingles"), "node")

        def work(group):
            return block_links(group, how)

        return rows.groupBy("bucket", "q", "d").applyInPandas(work, "a bigint, b bigint").distinct()

    def _texts(self, wanted: DataFrame) -> DataFrame:
        named = self.docs.select(F.col("doc_id").cast("bigint").alias("node"), F.col("text").cast("string"))
        return named.join(bounded(wanted), "node", "left_semi")


def block_links(group: pd.DataFrame, how: NearDuplicates) -> pd.DataFrame:
    """Links between the components of a block: asked rows are compared with all others until they share a component.

    Pairs that meet in an earlier band are left to that band's bucket. Minima screen, full sets confirm; of a
    component only the first link found is returned, so the result is at most one row a component.
    """
    nodes, asked = group["node"].to_numpy(), group["asked"].to_numpy()
    roots = group["root"].to_numpy().copy()
    minima_of = np.stack([np.frombuffer(s, np.uint16) for s in group["signature"]])
    bands = minima_of.reshape(len(nodes), how.bands, how.rows)
    own = int((bands == bands[:1]).all(axis=(0, 2)).argmax())
    sets = [np.asarray(s, np.int64) for s in group["shingles"]]
    sizes = np.array([len(s) for s in sets])
    found: list[tuple[int, int]] = []
    data = np.flatnonzero(~asked)
    for i in np.flatnonzero(asked):
        near = data[roots[data] != roots[i]]
        if not len(near):
            continue
        equal = minima_of[near] == minima_of[i]
        earlier = equal.reshape(len(near), how.bands, how.rows)[:, :own].all(axis=2).any(axis=1)
        level = equal.mean(axis=1)
        near = near[~earlier & (level >= how.screen)]
        if not len(near):
            continue
        own_set = np.sort(sets[i])
        pool = np.concatenate([sets[j] for j in near])
        places = np.minimum(np.searchsorted(own_set, pool), len(own_set) - 1)
        starts = np.concatenate([[0], np.cumsum(sizes[near])[:-1]])
        both = np.add.reduceat((own_set[places] == pool).astype(np.int64), starts)
        linked = near[100 * both >= how.percent * (sizes[i] + sizes[near] - both)]
        for j in linked:
            if roots[j] != roots[i]:
                found.append((min(nodes[i], nodes[j]), max(nodes[i], nodes[j])))
                roots[roots == roots[j]] = roots[i]
    return pd.DataFrame(found, columns=["a", "b"], dtype="int64")


def _merged(labels: DataFrame, edges: DataFrame) -> DataFrame:
    """Labels (node, root) after more edges: the edges are lifted to roots first, so only what is new is worked on."""
    lifted = _labelled(_labelled(edges, labels, "a"), labels, "b")
    moved = checkpointed(components(lifted))
    relabelled = _labelled(labels, moved, "root")
    return checkpointed(relabelled.union(moved.select("node", "root")).distinct())


def _labelled(df: DataFrame, labels: DataFrame, column: str) -> DataFrame:
    """``df`` with ``column`` replaced by its root; a node without a label is its own root."""
    named = labels.select(F.col("node").alias(column), F.col("root").alias("_root"))
    return (
        df.join(named, column, "left")
        .withColumn(column, F.coalesce("_root", column))
        .select(*df.columns)
    )


def near_duplicates(docs: DataFrame, how: NearDuplicates | None = None) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id (least doc_id reachable by links) and kept.

    1. Documents with equal shingle sets form a class named by its least doc_id; only classes go on.
    2. Each class falls into one bucket per band. A bucket's classes are first paired with the least one (a star, not
       all pairs), screened by their minima, confirmed on full sets and joined into components.
    3. Buckets whose other classes still lie in several components are taken up again: the classes outside the
       bucket's largest component are the queries, and all its classes the data. Blocks of bounded size of both meet in
       tasks, which compare them by minima and then by full sets and return one link for each join of two components.
       So every pair of a bucket is tested or lies in one component, no pairs are written out, and nothing is capped.

    Empty or NULL texts have no shingles and are linked with nothing. Rows with a repeated doc_id are one vertex, so
    they connect what each of them is linked with. A row with a NULL doc_id takes part in nothing: its component_id is
    NULL and it is kept. Repeated rows give repeated results; an empty table gives none; other columns are ignored.
    """
    how = how or NearDuplicates()
    with small_batches(docs.sparkSession):
        signed = checkpointed(signatures(docs, how))
    named = signed.where(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0))
    # The minima of equal sets are equal, so any row of a class has them.
    founders = checkpointed(
        named.groupBy("h1", "h2", "n_shingles").agg(F.min("doc_id").alias("node"), F.first("signature").alias("signature"))
    )
    placed = checkpointed(
        named.select("doc_id", "h1", "h2", "n_shingles")
        .join(founders.drop("signature"), ["h1", "h2", "n_shingles"])
        .select("doc_id", "node")
    )
    classes = founders.select("node", "signature")
    # A doc_id that occurs in several classes is one vertex and so connects them.
    members = placed.select("doc_id", "node").distinct()
    twice = members.groupBy("doc_id").agg(F.min("node").alias("a"), F.max("node").alias("_z")).where("a < _z")
    shared = members.join(twice.select("doc_id", "a"), "doc_id").where("node <> a").select("a", F.col("node").alias("b"))

    width = 2 * how.rows
    keys = [F.xxhash64(F.lit(i), F.substring("signature", i * width + 1, width)) for i in range(how.bands)]
    buckets = classes.select("node", F.explode(F.array(*keys)).alias("bucket"))
    full = buckets.groupBy("bucket").agg(
        F.min("node").alias("pivot"), F.max("node").alias("_z"), F.count(F.lit(1)).alias("_rows")).where("pivot < _z")
    crowded = checkpointed(_with_facts(buckets, full.drop("_z"), how))

    links = _Links(docs, classes, how)
    star = crowded.where("node <> pivot").select(F.col("pivot").alias("a"), F.col("node").alias("b"))
    labels = checkpointed(components(links.verified(star).union(shared)))
    left = checkpointed(_unsettled(crowded, labels, how))
    labels = _merged(labels, checkpointed(links.between_blocks(left)))

    final = _labelled(members.groupBy("doc_id").agg(F.min("node").alias("_group")), labels, "_group")
    return (
        signed.select("doc_id", "n_shingles")
        .join(final, "doc_id", "left")
        .select(
            "doc_id", "n_shingles", F.coalesce("_group", "doc_id").alias("component_id"),
            F.coalesce(F.col("doc_id") == F.coalesce("_group", "doc_id"), F.lit(True)).alias("kept"),
        )
    )


def _with_facts(rows: DataFrame, facts: DataFrame, how: NearDuplicates) -> DataFrame:
    """``rows`` with the facts of their bucket; ``facts`` has one row a bucket and its size ``_rows``.

    A bucket with more than ``hot_rows`` rows is not dealt to one task: the facts of the few such buckets go to the rows,
    which stay where they are. All others meet by shuffle.
    """
    facts = checkpointed(facts)
    hot = bounded(facts.where(F.col("_rows") > how.hot_rows).drop("_rows"))
    cold = facts.where(F.col("_rows") <= how.hot_rows).drop("_rows")
    others = rows.join(hot.select("bucket"), "bucket", "left_anti").join(cold, "bucket")
    return rows.join(hot, "bucket").unionByName(others)


def _unsettled(crowded: DataFrame, labels: DataFrame, how: NearDuplicates) -> DataFrame:
    """(bucket, node, root, major): buckets whose classes, without the tested pivot, lie in several components."""
    rest = crowded.where("node <> pivot").select("bucket", "node", F.col("node").alias("root"))
    marked = checkpointed(_labelled(rest, labels.toDF("node", "root"), "root"))
    sizes = marked.groupBy("bucket", "root").agg(F.count(F.lit(1)).alias("_n"))
    major = sizes.groupBy("bucket").agg(F.max(F.struct("_n", "root")).alias("_s"), F.count(F.lit(1)).alias("_k"), F.sum("_n").alias("_rows"))
    return _with_facts(marked, major.where("_k > 1").select("bucket", F.col("_s.root").alias("major"), "_rows"), how)


def _vertices(docs: DataFrame, vertex: str) -> tuple[DataFrame, DataFrame]:
    """``docs`` with the vertex of each row, and the vertices that several rows share.

    Rows are one vertex if their doc_id and their text are equal. Where no doc_id has two texts the vertex is the doc_id;
    else the pairs are numbered in order of doc_id and a hash of the text, so that the least vertex has the least doc_id.
    A NULL doc_id has none. Texts are moved only in the second case.
    """
    doc_id, text_hash = F.col("doc_id").cast("bigint"), F.xxhash64(F.col("text").cast("string"))
    pairs = docs.where(doc_id.isNotNull()).groupBy(doc_id.alias("id"), text_hash.alias("hash")).agg(F.count(F.lit(1)).alias("n"))
    pairs = checkpointed(pairs.withColumn("vertex", F.col("id")))
    if not pairs.groupBy("id").count().where("count > 1").isEmpty():
        pairs = checkpointed(numbered(pairs.drop("vertex"), ["id", "hash"]).withColumnRenamed("place", "vertex"))
        id_, hash_ = free_name(docs, "_id"), free_name(docs, "_hash")
        named = pairs.select(F.col("id").alias(id_), F.col("hash").alias(hash_), F.col("vertex").alias(vertex))
        same = (doc_id == named[id_]) & (text_hash == named[hash_])
        marked = docs.join(named, same, "left").drop(id_, hash_)
    else:
        marked = docs.withColumn(vertex, doc_id)
    return marked, pairs.where("n > 1").select("vertex")


def deduplicated(docs: DataFrame, how: NearDuplicates | None = None) -> DataFrame:
    """One row of each group of ``docs``, with its columns as they are.

    The group's least doc_id stays. Rows that share a doc_id but not a text are documents of their own: all stay if they
    are alike with nothing. Of rows with the same doc_id and text one stays, that with the least hash of all columns.
    Rows with a NULL doc_id stay, as they are in no group. Only ids are joined, and texts are moved only where ids repeat.
    """
    vertex, gone = free_name(docs, "_vertex"), free_name(docs, "_gone")
    marked, repeated = _vertices(docs, vertex)
    found = near_duplicates(marked.select(F.col(vertex).alias("doc_id"), "text"), how)
    lost = bounded(found.where(~F.col("kept")).select(F.col("doc_id").alias(gone)).distinct())
    stay = marked.join(lost, F.col(vertex) == F.col(gone), "left_anti")
    again = bounded(repeated.select(F.col("vertex").alias(gone)))
    if not again.isEmpty():
        several = F.col(vertex) == F.col(gone)
        columns = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
        order = F.xxhash64(F.to_json(F.struct(columns.alias("row"))))
        one = stay.join(again, several, "left_semi").groupBy(vertex).agg(F.min_by(columns, order).alias("_row"))
        stay = stay.join(again, several, "left_anti").drop(vertex).unionByName(one.select("_row.*"))
        return stay
    return stay.drop(vertex)

"""Synthetic minority rows between nearest neighbours."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenura.operators.neighbours import Forest, forest_neighbours
from tenura.operators.ordered import hash_positions
from tenura.session import checkpointed

# Cells of the neighbour search, and rows that a task compares with one block at once.
MOST_PIVOTS = 1024
ASKED_ROWS = 8_000


def _unit(*parts: Column) -> Column:
    """A number in [0, 1) that depends only on its parts."""
    return F.pmod(F.xxhash64(*parts), F.lit(1 << 52)) / float(1 << 52)


def _squares(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of ``x`` to all of ``y``; those that are no number count as infinite."""
    total = np.zeros((len(x), len(y)))
    with np.errstate(invalid="ignore", over="ignore"):
        for i in range(x.shape[1]):
            gap = x[:, i, None] - y[None, :, i]
            total += gap * gap
    total[np.isnan(total)] = np.inf
    return total


def _stacked(vectors: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(v, float) for v in vectors]) if len(vectors) else np.empty((0, 0))


def _nearest(asked: pd.DataFrame, data: pd.DataFrame, k: int) -> pd.DataFrame:
    """(_id, _other, d): the ``k`` nearest rows of ``data`` for each asked row, itself left out; ties by id."""
    data = data.sort_values("_id")
    x, y, ids, others = _stacked(asked["_x"]), _stacked(data["_x"]), asked["_id"].to_numpy(), data["_id"].to_numpy()
    at = {other: i for i, other in enumerate(others)}
    own = np.array([at.get(i, -1) for i in ids])
    found = [pd.DataFrame({"_id": ids[:0], "_other": others[:0], "d": np.empty(0)})]
    for start in range(0, len(x) if len(y) else 0, 256):
        d = _squares(x[start : start + 256], y)
        mine = own[start : start + 256]
        d[np.flatnonzero(mine >= 0), mine[mine >= 0]] = np.nan
        last = min(k, len(y)) - 1
        limit = np.partition(d, last, axis=1)[:, last]  # NaN sorts last
        rows, places = np.nonzero(d <= np.where(np.isnan(limit), np.inf, limit)[:, None])
        values = d[rows, places]
        order = np.lexsort((places, values, rows))
        rows, places, values = rows[order], places[order], values[order]
        first = np.arange(len(rows)) - np.searchsorted(rows, rows) < k
        found.append(pd.DataFrame({"_id": ids[start + rows[first]], "_other": others[places[first]], "d": values[first]}))
    return pd.concat(found, ignore_index=True)


class _Cells:
    """Cells around pivots, with bounds on the distance from a point to any point of a cell."""

    def __init__(self, pivots: np.ndarray, rows: np.ndarray, least: np.ndarray, most: np.ndarray):
        self.pivots, self.rows, self.least, self.most = pivots, rows, least, most

    def reached(self, x: np.ndarray, own: np.ndarray, bound: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(row, cell) of all cells that can hold one of the ``k`` nearest.

        ``bound`` is a distance within which a row has ``k`` others, or infinite. Cells are left out only by the
        triangle inequality and by the plane between two pivots, less than rounding could move them.
        """
        d = np.sqrt(_squares(x, self.pivots))
        with np.errstate(invalid="ignore", divide="ignore", over="ignore"):
            outer = d + self.most
            order = np.argsort(outer, axis=1)
            enough = np.cumsum(self.rows[order], axis=1) > k  # one of them is the row itself
            at = order[np.arange(len(x)), enough.argmax(axis=1)]
            other = np.where(enough.any(axis=1), outer[np.arange(len(x)), at], np.inf)
            bound = np.fmin(bound, other) * (1 + 1e-9)
            between = np.sqrt(_squares(self.pivots[own], self.pivots))
            mine = d[np.arange(len(x)), own][:, None]
            plane = (d * d - mine * mine - 1e-12 * (d * d + mine * mine)) / (2 * between)
            low = np.fmax(d - self.most, self.least - d) - 1e-12 * (d + self.most)
            outside = (low > bound[:, None]) | (plane > bound[:, None]) & (between > 0)
        return np.nonzero(~outside & (self.rows > 0))


def near_neighbours(
    df: DataFrame, key: str, vector: str, k: int = 5, block_rows: int = 2_000, recall: float | None = None, forest: Forest = Forest()
) -> DataFrame:
    """The ``k`` nearest rows of each row: (key, vector, neighbours array of vectors); fewer only where fewer exist.

    Without ``recall`` the search is exact. With it an index finds candidates in about n log n comparisons, at least that
    share of the true neighbours as measured on a sample of the rows; see ``neighbours.Forest``. All distances are exact.

    Equal vectors are collapsed to one with a count, so a crowded point costs no more than any other; its own copies
    are its nearest neighbours. Distinct vectors fall into cells, each around the nearest of some pivots, and cells into
    blocks of about ``block_rows``. The k-th distance inside its block bounds what a vector looks for; it is then compared
    with all blocks of all cells that can hold anything as near. So the result is exact for any number of dimensions.
    In few dimensions a vector meets few cells; in many, where no cell can be left out, all pairs are compared.
    """
    points = checkpointed(
        df.where(F.col(vector).isNotNull()).groupBy(F.col(vector).alias("_x"))
        .agg(F.count(F.lit(1)).alias("_n"), F.min(F.col(key).cast("string")).alias("_id"))
    )
    if recall is not None:
        best = forest_neighbours(points.select("_id", "_x"), k, recall, forest)[0]
        if best is not None:
            return _with_vectors(df, key, vector, points, best, k)
    wanted = max(1, min(MOST_PIVOTS, points.count() // block_rows))
    pivots = _stacked(pd.Series([r["_x"] for r in points.orderBy(F.xxhash64("_id"), "_id").limit(wanted).select("_x").collect()]))
    if not len(pivots):
        return df.where(F.lit(False)).select(key, vector, F.array().cast("array<array<double>>").alias("neighbours"))

    def to_cells(batches):
        for batch in batches:
            for start in range(0, len(batch), 512):
                part = batch.iloc[start : start + 512]
                d = _squares(_stacked(part["_x"]), pivots)
                cell = d.argmin(axis=1)
                yield part.assign(_cell=cell.astype(np.int32), _away=np.sqrt(d[np.arange(len(part)), cell]))

    placed = checkpointed(points.select("_id", "_x").mapInPandas(to_cells, "_id string, _x array<double>, _cell int, _away double"))
    blocks = F.ceil(F.count(F.lit(1)) / F.lit(block_rows)).cast("int")
    # At most MOST_PIVOTS rows.
    cells = checkpointed(placed.groupBy("_cell").agg(
        F.count(F.lit(1)).alias("_rows"), F.min("_away").alias("_least"), F.max("_away").alias("_most"), blocks.alias("_blocks")))
    sizes = {r["_cell"]: r for r in cells.collect()}
    about = _Cells(pivots, *[np.array([sizes[c][name] if c in sizes else 0 for c in range(len(pivots))]) for name in ("_rows", "_least", "_most")])
    every = F.broadcast(cells.select("_cell", "_blocks"))
    dealt = placed.join(every, "_cell").select("_cell", F.pmod(F.xxhash64("_id"), "_blocks").cast("int").alias("_block"), "_id", "_x")

    def within(block):
        near = _nearest(block, block, k).groupby("_id")["d"].agg(["size", "max"])
        bound = near["max"].where(near["size"] >= k).reindex(block["_id"]).fillna(np.inf).to_numpy()
        return block.assign(_bound=np.sqrt(bound))[["_id", "_x", "_cell", "_bound"]]

    bounds = dealt.groupBy("_cell", "_block").applyInPandas(within, "_id string, _x array<double>, _cell int, _bound double")

    def to_reached(batches):
        for batch in batches:
            for start in range(0, len(batch), 256):
                part = batch.iloc[start : start + 256]
                rows, reached = about.reached(_stacked(part["_x"]), part["_cell"].to_numpy(), part["_bound"].to_numpy(), k)
                yield part.iloc[rows].assign(_cell=reached.astype(np.int32))[["_id", "_x", "_cell"]]

    asked = checkpointed(bounds.mapInPandas(to_reached, "_id string, _x array<double>, _cell int"))
    # Rows that ask one cell are dealt to chunks, each of which meets every block of it.
    chunks = F.ceil(F.count(F.lit(1)) / F.lit(ASKED_ROWS)).cast("int")
    chunked = F.broadcast(checkpointed(asked.groupBy("_cell").agg(chunks.alias("_chunks"))))
    asking = asked.join(chunked, "_cell").join(every, "_cell").select(
        "_cell", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)).alias("_block"),
        F.pmod(F.xxhash64(F.lit(1), "_id"), "_chunks").cast("int").alias("_chunk"), "_id", "_x", F.lit(True).alias("_asks"),
    )
    data = dealt.join(chunked, "_cell").select(
        "_cell", "_block", F.explode(F.sequence(F.lit(0), F.col("_chunks") - 1)).alias("_chunk"), "_id", "_x", F.lit(False).alias("_asks")
    )

    def meeting(group):
        return _nearest(group[group["_asks"]], group[~group["_asks"]], k)

    found = asking.unionByName(data).groupBy("_cell", "_block", "_chunk").applyInPandas(meeting, "_id string, _other string, d double")
    # At most k rows from each block a vector has met.
    best = found.groupBy("_id").agg(F.slice(F.sort_array(F.collect_list(F.struct("d", F.col("_other").alias("id")))), 1, k).alias("_best"))
    return _with_vectors(df, key, vector, points, best, k)


def _with_vectors(df: DataFrame, key: str, vector: str, points: DataFrame, best: DataFrame, k: int) -> DataFrame:
    """Neighbours as vectors, a crowded point as often as it has rows, for each row of ``df``."""
    others = points.select(F.col("_id").alias("id"), F.col("_x").alias("x"), F.col("_n").alias("m"))
    candidates = best.select("_id", F.inline("_best")).join(others, "id").select("_id", F.struct("d", "id", "x", "m").alias("c"))
    nearest = candidates.groupBy("_id").agg(F.sort_array(F.collect_list("c")).alias("_near"))
    repeated = F.flatten(F.transform("_near", lambda c: F.array_repeat(c["x"], F.least(c["m"], F.lit(k)).cast("int"))))
    own = F.array_repeat("_x", F.least(F.col("_n") - 1, F.lit(k)).cast("int"))
    result = points.join(nearest, "_id", "left").select(
        "_x", F.slice(F.concat(own, F.coalesce(repeated, F.array().cast("array<array<double>>"))), 1, k).alias("neighbours")
    )
    return df.select(key, vector).join(result, F.col(vector) == F.col("_x")).select(key, vector, "neighbours")


def smote(
    df: DataFrame, key: str, vector: str, label: str, ratio: float = 0.5, k: int = 5, seed: int = 42, recall: float | None = 0.9
) -> DataFrame:
    """Add synthetic rows of class 1 until it has ``ratio`` times the rows of class 0.

    Neighbours are found with at least ``recall`` (None: exactly); up to ``Forest.leaf_rows`` distinct vectors all are exact.

    Each new row lies on the line from a minority row to one of its nearest neighbours; draws depend only on key and seed.
    Rows keep key, vector and label; a new key is the source key with a number.
    """
    kept = df.select(F.col(key).cast("string").alias(key), vector, F.col(label).cast("double").alias(label))
    counts = kept.agg(
        F.count_if(F.col(label) == 1).alias("minority"), F.count_if(F.col(label) == 0).alias("majority")
    ).first()
    minority, wanted = counts["minority"], max(int(ratio * counts["majority"] - counts["minority"]), 0)
    if not wanted or not minority:
        return kept
    sources = checkpointed(near_neighbours(kept.where(F.col(label) == 1), key, vector, k, recall=recall))
    numbered = hash_positions(sources, key, f"smote:{seed}", "_position")
    whole, rest = divmod(wanted, minority)
    copies = F.lit(whole) + (F.col("_position") < rest).cast("int")
    made = numbered.withColumn("_copies", copies).where("_copies > 0").withColumn(
        "_copy", F.explode(F.sequence(F.lit(1), F.col("_copies")))
    )
    parts = (F.lit(seed), F.col(key), F.col("_copy"))
    pick = F.floor(_unit(F.lit("neighbour"), *parts) * F.size("neighbours")).cast("int")
    other = F.coalesce(F.get("neighbours", pick), F.col(vector))
    step = _unit(F.lit("step"), *parts)
    made = made.withColumn("_other", other).withColumn("_step", step).select(
        F.concat(F.col(key), F.lit("#"), F.col("_copy").cast("string")).alias(key),
        F.expr(f"zip_with({vector}, _other, (a, b) -> a + _step * (b - a))").alias(vector),
        F.lit(1.0).alias(label),
    )
    return kept.unionByName(made)

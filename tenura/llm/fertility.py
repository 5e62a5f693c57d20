"""Quality rules from tokeniser fertility, with rejection bands per language or script."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tenura.llm.texts import CACHE_WORDS, bounded, by_slice, free_name, held_out, released, row_key, small_batches
from tenura.session import checkpointed

# First code points of Unicode ranges, with the script that most of a range's letters have.
SCRIPTS = [
    (0x41, "Latin"), (0x5B, ""), (0x61, "Latin"), (0x7B, ""), (0xC0, "Latin"), (0x250, ""), (0x370, "Greek"),
    (0x400, "Cyrillic"), (0x530, "Armenian"), (0x590, "Hebrew"), (0x600, "Arabic"), (0x780, ""), (0x900, "Devanagari"),
    (0x980, "Bengali"), (0xA00, ""), (0xB80, "Tamil"), (0xC00, ""), (0xE00, "Thai"), (0xE80, ""), (0x10A0, "Georgian"),
    (0x1100, "Hangul"), (0x1200, ""), (0x1E00, "Latin"), (0x1F00, "Greek"), (0x2000, ""), (0x3040, "Kana"),
    (0x3100, ""), (0x3400, "Han"), (0xA000, ""), (0xAC00, "Hangul"), (0xD7B0, ""), (0xF900, "Han"), (0xFB00, ""),
    (0x20000, "Han"), (0x32000, ""),
]
SPACES = b" \t\n\r\x0b\x0c"
SYMBOLS = b"#*$%&|<>"
MEASURES = ["chars_per_token", "byte_share", "entropy"]
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_tokens"]
SCHEMA = pa.schema(
    [("doc_id", pa.int64()), ("row", pa.int64()), ("text_hash", pa.int64()), *[(c, pa.int64()) for c in COUNTS], *[(m, pa.float64()) for m in MEASURES], ("kind", pa.string())]
)


@dataclass(frozen=True)
class Fertility:
    """``vocabulary`` is the path of a sentencepiece model with byte fallback.

    A measure's band is its median minus and plus ``widths`` spreads among the distinct texts of one language (or script,
    where the language is not known) and one power of two of their token count that pass the base rules; longer texts
    vary less. Copies count once, so they do not move the band. A length class with fewer than ``least_texts`` distinct
    texts takes in the next shorter and longer classes until it has as many, or the whole language or script. A spread
    is the interquartile range, but at least ``floors``, so a uniform or tiny group rejects nothing that is near it.

    Without labels ``widths`` hold. With labelled rows they are learned on those that are not held out
    (``texts.held_out``) and fail no base rule: a language or script with at least ``least_labels`` good ones takes, on either
    side of each measure, ``margin`` times the farthest of them, but at least ``least_width``; others take what all good
    rows together give, if these are as many.
    """

    vocabulary: str
    least_words: int = 50
    repeat_percent: int = 50
    widths: dict[str, tuple[float, float]] = field(default_factory=lambda: {
        "chars_per_token": (4.5, 10.0), "byte_share": (1e6, 10.0), "entropy": (2.6, 1e6),
    })
    least_texts: int = 20
    least_labels: int = 100
    margin: float = 1.25
    least_width: float = 1.0
    floors: dict[str, float] = field(default_factory=lambda: {"chars_per_token": 0.05, "byte_share": 0.01, "entropy": 0.1})


class PieceCounter:
    """Token ids of words with a bounded cache; words are encoded on their own, many in one call."""

    def __init__(self, path: str):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        self.is_byte = np.array([self.library.is_byte(i) for i in range(self.library.vocab_size())])
        self.known: dict[bytes, bytes] = {}

    def learn(self, words: set[bytes]) -> None:
        new = words.difference(self.known)
        if len(self.known) + len(new) > CACHE_WORDS:
            self.known.clear()
            new = words
        listed = list(new)
        for word, ids in zip(listed, self.library.encode([w.decode() for w in listed], num_threads=1)):
            self.known[word] = np.array(ids, np.int32).tobytes()

    def measures(self, words: list[bytes], chars: int) -> tuple[int, float, float, float]:
        """Tokens, characters per token, share of byte tokens and entropy of the token distribution in bits; zeros without words."""
        if not words:
            return 0, 0.0, 0.0, 0.0
        ids = np.frombuffer(b"".join(map(self.known.__getitem__, words)), np.int32)
        counts = np.bincount(ids)
        used = np.flatnonzero(counts)
        share = counts[used] / len(ids)
        return len(ids), chars / len(ids), float(counts[used][self.is_byte[used]].sum() / len(ids)), float(-(share * np.log2(share)).sum())


def repeated_words(words: list[bytes]) -> int:
    """Words inside 3-word windows that occur at least twice."""
    if len(words) < 4:
        return 0
    index: dict[bytes, int] = {}
    ids = np.array([index.setdefault(w, len(index)) for w in words], np.int64)
    if len(index) == len(words):
        return 0
    size = len(index)
    pairs = np.unique(ids[:-1] * size + ids[1:], return_inverse=True)[1]
    _, place, counts = np.unique(pairs[:-1] * size + ids[2:], return_inverse=True, return_counts=True)
    starts = np.flatnonzero(counts[place] > 1)
    hit = np.zeros(len(words), bool)
    for i in range(3):
        hit[starts + i] = True
    return int(hit.sum())


def repeated_lines(raw: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [line for line in raw.split(b"\n") if line.strip(SPACES)]
    return len(lines) - len(set(lines))


def script(text: str) -> str:
    """The script of most letters; the empty string without any."""
    points = np.frombuffer(text.encode("utf-32-le", "replace"), "<u4")
    places = np.bincount(np.searchsorted([s for s, _ in SCRIPTS], points, "right"), minlength=len(SCRIPTS) + 1)[1:]
    totals: dict[str, int] = {}
    for n, (_, name) in zip(places, SCRIPTS):
        if name and n:
            totals[name] = totals.get(name, 0) + int(n)
    return max(sorted(totals), key=totals.__getitem__) if totals else ""


def text_measures(docs: DataFrame, vocabulary: str) -> DataFrame:
    """Per row: doc_id, row, text_hash, counts, measures and kind (its language, else script:<name>)."""

    def run(batches):
        counter = PieceCounter(vocabulary)

        def work(piece: pa.RecordBatch) -> dict[str, object]:
            texts = [t or "" for t in piece.column("text").to_pylist()]
            raws = [t.encode() for t in texts]
            worded = [r.split() for r in raws]
            counter.learn(set().union(*worded))
            out: dict[str, list] = {f.name: [] for f in SCHEMA if f.name not in ("doc_id", "row", "text_hash")}
            for text, raw, words, lang in zip(texts, raws, worded, piece.column("lang").to_pylist()):
                chars = len(text) - len(raw) + len(raw.translate(None, SPACES))
                found = counter.measures(words, chars)
                counts = len(words), chars, len(raw) - len(raw.translate(None, SYMBOLS)), repeated_lines(raw), repeated_words(words)
                for name, value in zip(COUNTS + MEASURES, [*counts, *found]):
                    out[name].append(value)
                out["kind"].append(lang if lang and lang != "und" else f"script:{script(text)}")
            return {"doc_id": piece.column("doc_id"), "row": piece.column("row"), "text_hash": piece.column("text_hash"), **out}

        yield from by_slice(work, SCHEMA)(batches)
        counter.known.clear()
        released()

    rows = docs.select(
        F.col("doc_id").cast("bigint"), row_key(["doc_id", "text", "lang"]).alias("row"), F.xxhash64("text").alias("text_hash"),
        F.col("text").cast("string"), F.col("lang").cast("string"),
    )
    kinds = ", ".join(f"{f.name} {'double' if f.type == pa.float64() else 'string' if f.type == pa.string() else 'bigint'}" for f in SCHEMA)
    return rows.mapInArrow(run, kinds)


def base_failed(how: Fertility) -> Column:
    few = F.col("n_words") < how.least_words
    return few | (F.col("n_repeat_words") * 100 > F.col("n_words") * how.repeat_percent)


def length_class() -> Column:
    return F.floor(F.log2(F.greatest(F.col("n_tokens"), F.lit(1)))).cast("int")


def neighbours(values: DataFrame, least_texts: int) -> DataFrame:
    """(kind, length, _from): the length classes whose texts make up the band of a class; itself where it has enough.

    The side has one row for two length classes of a kind, so each window holds at most one row a length.
    """
    sizes = checkpointed(values.where(F.col("measure") == MEASURES[0]).groupBy("kind", "length").agg(F.sum("n").alias("_texts")))
    others = sizes.toDF("_kind", "_from", "_texts")
    pairs = sizes.select("kind", "length").join(others, F.col("kind") == F.col("_kind")).withColumn("_away", F.abs(F.col("_from") - F.col("length")))
    nearer = Window.partitionBy("kind", "length").orderBy("_away").rangeBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("_texts").over(nearer), F.lit(0))
    return pairs.withColumn("_before", before).where(F.col("_before") < least_texts).select("kind", "length", "_from")


def centres(measured: DataFrame, how: Fertility) -> DataFrame:
    """(kind, length, <measure>_mid, <measure>_spread) from exact quartiles of all distinct texts that pass the base rules.

    Texts are reduced to one row each and then to counts of values. Measures are rounded to thousandths for the
    quartiles, which bounds the distinct values of a group.
    """
    texts = measured.where(~base_failed(how)).groupBy("kind", length_class().alias("length"), "text_hash").agg(
        *[F.first(m).alias(m) for m in MEASURES]
    )
    listed = F.inline(F.array(*[F.struct(F.lit(m).alias("measure"), F.round(m, 3).alias("value")) for m in MEASURES]))
    values = checkpointed(
        texts.select("kind", "length", listed).groupBy("kind", "length", "measure", "value").agg(F.count(F.lit(1)).alias("n"))
    )
    taken = bounded(neighbours(values, how.least_texts)).toDF("_kind", "_length", "_from")
    pooled = values.join(taken, (F.col("kind") == F.col("_kind")) & (F.col("length") == F.col("_from")))
    quartiles = F.percentile("value", [0.25, 0.5, 0.75], F.col("n"))
    found = pooled.groupBy("kind", F.col("_length").alias("length"), "measure").agg(quartiles.alias("q"))
    columns = []
    for m in MEASURES:
        q = F.max(F.when(F.col("measure") == m, F.col("q")))
        columns += [q[1].alias(f"{m}_mid"), F.greatest(q[2] - q[0], F.lit(how.floors[m])).alias(f"{m}_spread")]
    return found.groupBy("kind", "length").agg(*columns)


def fitted_widths(placed: DataFrame, labels: DataFrame, how: Fertility) -> DataFrame:
    """(kind, <measure>_low, <measure>_high) where good rows enough are labelled; the row with a NULL kind is of all of them.

    ``placed`` are measured rows with their centres. Only ids of labelled rows are joined.
    """
    good = labels.where("quality = 1").select(F.col("doc_id").cast("bigint").alias("_good")).distinct()
    known = placed.where(~base_failed(how) & ~held_out("doc_id")).join(good, F.col("doc_id") == F.col("_good"), "left_semi")

    def farthest(m: str, sign: int) -> Column:
        away = sign * (F.col(m) - F.col(f"{m}_mid")) / F.col(f"{m}_spread")
        return F.greatest(F.max(away) * how.margin, F.lit(how.least_width))

    sides = [farthest(m, sign).alias(f"{m}_{side}") for m in MEASURES for sign, side in ((-1, "low"), (1, "high"))]
    own = known.groupBy("kind").agg(F.count(F.lit(1)).alias("_n"), *sides)
    whole = known.agg(F.lit(None).cast("string").alias("kind"), F.count(F.lit(1)).alias("_n"), *sides)
    return own.unionByName(whole).where(F.col("_n") >= how.least_labels).drop("_n")


def quality_rules(docs: DataFrame, how: Fertility, labels: DataFrame | None = None) -> DataFrame:
    """One row per input row: doc_id, row, counts, measures, kind, base_failed and kept.

    A document that fails no base rule is kept when each measure lies in its group's band. NULL, empty and blank texts
    have zero words and fail the base rules. NULL languages (also empty or ``und``) go by script. Rows with one doc_id
    are judged one by one; ``row`` tells them apart. An empty table gives no rows; other columns are ignored. ``labels``
    (doc_id, quality) only set how wide the bands are, from rows that are not held out.
    """
    with small_batches(docs.sparkSession):
        measured = checkpointed(text_measures(docs, how.vocabulary))
    around = bounded(centres(measured, how).withColumnsRenamed({"kind": "_kind", "length": "_length"}))
    joined = measured.join(around, (F.col("kind") == F.col("_kind")) & (length_class() == F.col("_length")), "left")
    sides = [f"{m}_{side}" for m in MEASURES for side in ("low", "high")]
    stated = {f"{m}_{side}": width for m in MEASURES for side, width in zip(("low", "high"), how.widths[m])}
    if labels is not None:
        fitted = bounded(fitted_widths(joined, labels, how).withColumnRenamed("kind", "_of"))
        whole = fitted.where("_of IS NULL").first()
        stated = {side: whole[side] for side in sides} if whole else stated
        joined = joined.join(fitted.where("_of IS NOT NULL"), F.col("kind") == F.col("_of"), "left")
        widths = {side: F.coalesce(F.col(side), F.lit(stated[side])) for side in sides}
    else:
        widths = {side: F.lit(stated[side]) for side in sides}
    inside = F.lit(True)
    for m in MEASURES:
        mid, spread = F.col(f"{m}_mid"), F.col(f"{m}_spread")
        inside = inside & F.col(m).between(mid - spread * widths[f"{m}_low"], mid + spread * widths[f"{m}_high"])
    failed = base_failed(how)
    return joined.select(
        "doc_id", "row", *COUNTS, *MEASURES, "kind", failed.alias("base_failed"),
        (~failed & F.coalesce(inside, F.lit(True))).alias("kept"),
    )


def kept_documents(docs: DataFrame, how: Fertility, labels: DataFrame | None = None) -> DataFrame:
    """Rows of ``docs`` that the rules keep, with their columns as they are. The rejected rows' keys are the joined side."""
    doc, row = free_name(docs, "_doc"), free_name(docs, "_row")
    rejected = quality_rules(docs, how, labels).where(~F.col("kept")).select(F.col("doc_id").alias(doc), F.col("row").alias(row)).distinct()
    same = F.col("doc_id").cast("bigint").eqNullSafe(F.col(doc)) & (row_key(["doc_id", "text", "lang"]) == F.col(row))
    return docs.join(bounded(rejected), same, "left_anti")

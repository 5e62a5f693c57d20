import random

import pytest
from pyspark.sql import functions as F

from tenura.llm import minhash
from tenura.llm.components import components
from tenura.llm.minhash import NearDuplicates, deduplicated, near_duplicates
from tests.llm.samples import SCHEMA, documents, messy_rows


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def shingles(text, size=2):
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", lowered(text)) if w]
    return {tuple(words)} if 0 < len(words) < size else set(zip(*(words[i:] for i in range(size))))


def brute(rows, size=2):
    """(doc_id, n, component, kept) of every row, all pairs compared."""
    sets = [shingles(r[1], size) for r in rows]
    root = {r[0]: r[0] for r in rows if r[0] is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(rows):
        for j in range(i):
            b = rows[j]
            if a[0] is None or b[0] is None or not sets[i] or not sets[j]:
                continue
            both = len(sets[i] & sets[j])
            if 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                x, y = find(a[0]), find(b[0])
                root[max(x, y)] = min(x, y)
    out = []
    for r, s in zip(rows, sets):
        component = None if r[0] is None else find(r[0])
        out.append((r[0], len(s), component, r[0] is None or component == r[0]))
    return out


def result(df):
    return [tuple(r) for r in df.collect()]


def same(df, rows):
    assert sorted(result(df), key=repr) == sorted(brute(rows), key=repr)


def test_messy_rows(spark):
    rows = messy_rows()
    same(near_duplicates(documents(spark, rows)), rows)


def edited(words, n, rng):
    words = list(words)
    for i in rng.sample(range(len(words)), n):
        words[i] = f"neu{rng.randrange(10**9)}"
    return words


def test_families_around_the_threshold(spark):
    """Copies with few to many edits: some links, chains of links and many pairs just below the threshold."""
    rng = random.Random(4)
    rows = []
    for family in range(6):
        words = [f"f{family}w{rng.randrange(10**6)}" for _ in range(80)]
        for _ in range(25):
            rows.append((len(rows), " ".join(edited(words, rng.randrange(0, 12), rng)), "en", "s"))
        for _ in range(12):  # a chain: each is an edit of the one before
            words = edited(words, 4, rng)
            rows.append((len(rows), " ".join(words), "en", "s"))
    rng.shuffle(rows)
    same(near_duplicates(documents(spark, rows)), rows)
    # Blocks of a few rows take the same decisions.
    same(near_duplicates(documents(spark, rows), NearDuplicates(block_rows=7, block_shingles=500)), rows)


def test_repeated_ids_join_their_groups(spark):
    rows = [(1, "a b c d", "", ""), (5, "a b c d", "", ""), (5, "p q r s", "", ""), (3, "p q r s", "", ""), (8, "z z z", "", "")]
    same(near_duplicates(documents(spark, rows)), rows)


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert result(near_duplicates(empty)) == []
    assert deduplicated(empty).columns == empty.columns and deduplicated(empty).count() == 0


def test_one_row_of_each_group_stays(spark):
    rows = messy_rows()
    docs = documents(spark, rows)
    left = deduplicated(docs)
    assert left.columns == docs.columns
    # Rows with one id and one text are a document; rows with one id and two texts are two.
    named = sorted({r[:2] for r in rows if r[0] is not None}, key=lambda r: (r[0], r[1] or ""))
    alone = [(i, text) for i, (_, text) in enumerate(named)]
    expected = [named[i][0] for i, _, _, kept in brute(alone) if kept]
    assert sorted(r.doc_id for r in left.collect() if r.doc_id is not None) == sorted(expected)
    assert left.where("doc_id IS NULL").count() == 2


def test_rows_of_one_id_with_other_texts_are_kept(spark):
    long = [" ".join(f"{t}{k}" for k in range(30)) for t in "abc"]
    rows = [(1, "one two three four five six", "en", "s"), (1, "wholly different words in this one", "en", "s"), (2, long[0], "en", "s"),
            (3, long[0], "en", "s"), (3, long[1], "en", "s"), (4, long[1] + " end", "en", "s"), (4, long[1] + " end", "en", "s"), (5, None, "en", "s"),
            (5, "", "en", "s"), (6, long[2], "en", "s"), (6, long[2], "en", "s")]
    left = sorted((r.doc_id, r.text) for r in deduplicated(documents(spark, rows)).select("doc_id", F.coalesce("text", F.lit("-")).alias("text")).collect())
    assert left == sorted([(1, rows[0][1]), (1, rows[1][1]), (2, long[0]), (3, long[1]), (5, "-"), (5, ""), (6, long[2])])


@pytest.mark.parametrize("hot_rows", [2, 1_000])
def test_hot_buckets_change_nothing(spark, hot_rows):
    base = [f"w{k}" for k in range(40)]
    rows = [(i, " ".join([*base[:i % 20], f"x{i % 9}", *base[i % 20:]]), "en", "s") for i in range(60)]
    same(near_duplicates(documents(spark, rows), NearDuplicates(hot_rows=hot_rows)), rows)


def test_components_of_a_long_path_and_a_hub(spark):
    rng = random.Random(1)
    path = [(i, i + 1) for i in range(60)]
    hub = [(100, 100 + i) for i in range(1, 40)]
    edges = [tuple(rng.sample(e, 2)) for e in path + hub] + [(7, 7), (100, 101), (None, 3)]
    found = components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()
    assert {(r.node, r.root) for r in found} == {(i, 0) for i in range(1, 61)} | {(100 + i, 100) for i in range(1, 40)}


def test_minima_estimate_similarity():
    how = NearDuplicates()
    a, b = how.coefficients()
    shingler = minhash.Shingler(2)
    base = [f"w{i}" for i in range(400)]
    x, y = shingler(" ".join(base)), shingler(" ".join(base[:360]))
    level = (minhash.minima(x, a, b) == minhash.minima(y, a, b)).mean()
    assert level == pytest.approx(359 / 399, abs=0.15)

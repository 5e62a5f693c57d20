import hashlib
import random
import re

from tenura.llm.positions import (
    Windows, benchmark_items, build_index, clean_documents, contamination, phrase_matches, proximity_matches,
)
from tests.llm.samples import SCHEMA, documents, messy_rows


def words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(rows, items):
    windows = {}
    for item_id, text in items:
        w = words(text)
        n = min(13, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[i : i + n]), set()).add(item_id)
    sizes = {len(w) for w in windows}
    out = []
    for r in rows:
        w = words(r[1])
        hit, found = set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if (key := tuple(w[i : i + n])) in windows:
                    hit.update(range(i, i + n))
                    found |= windows[key]
        ids = ",".join(sorted(str(x) for x in found if x is not None))
        out.append((r[0], len(w), len(hit), len([x for x in found if x is not None]), ids, bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=repr)


def found(df):
    return sorted((tuple(r[c] for c in ("doc_id", "n_words", "n_hit", "n_items", "items", "contaminated")) for r in df.collect()), key=repr)


def benchmark(spark, items):
    return spark.createDataFrame(items, "item_id bigint, text string").selectExpr("*", "'x' AS words", "'y' AS item")


def cases():
    rng = random.Random(3)
    vocabulary = [f"v{i}" for i in range(40)] + ["the", "of", "É", "ñandú", "日本"]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.choice([1, 2, 5, 13, 14, 30])))) for i in range(1, 25)]
    items += [(30, ""), (31, None), (None, "only nameless words here"), (32, "  !! "), (33, items[3][1]), (34, "the"), (35, "the the the")]
    rows = messy_rows()
    for i in range(100, 160):
        own = [rng.choice(vocabulary) for _ in range(rng.randrange(0, 60))]
        passage = (rng.choice(items)[1] or "").split()
        cut = passage[rng.randrange(0, 3) : len(passage) - rng.randrange(0, 3)]
        place = rng.randrange(0, len(own) + 1)
        rows.append((i, ", ".join(own[:place] + [w.upper() for w in cut] + own[place:]), "en", "s"))
    rows += [(200, "Only nameless, words HERE", "en", "s"), (201, "the the the the", "en", "s"), rows[-1]]
    return rows, items


def test_against_brute_force(spark):
    rows, items = cases()
    assert found(contamination(documents(spark, rows), benchmark(spark, items))) == brute(rows, items)


def test_clean_documents_stay_as_they_are(spark):
    rows, items = cases()
    docs = documents(spark, rows)
    left = clean_documents(docs, benchmark(spark, items))
    assert left.columns == docs.columns
    expected = [r[0] for r in brute(rows, items) if not r[5]]
    assert sorted([r.doc_id for r in left.collect()], key=repr) == sorted(expected, key=repr)


def test_empty_tables(spark):
    rows = [(1, "a b", "", "")]
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert found(contamination(documents(spark, rows), none)) == [(1, 2, 0, 0, "", False)]
    assert found(contamination(spark.createDataFrame([], SCHEMA), none)) == []


def test_digest_of_no_items():
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0c442")


def test_proximity_finds_moved_words(spark):
    item = [f"p{i}" for i in range(20)]
    moved = item[:6] + ["extra"] + item[6:12] + item[13:]
    other = ["x"] * 5 + item[:3] + ["y"] * 40 + item[3:]
    rows = [(1, " ".join(["q"] * 9 + moved), "", ""), (2, " ".join(other), "", ""), (3, " ".join(item), "", ""), (4, "q r s", "", "")]
    items, _ = benchmark_items(benchmark(spark, [(1, " ".join(item))]))
    index = build_index(documents(spark, rows))
    near = {(r.doc_id, r.near) for r in proximity_matches(items, index, slack=3, share=0.9).collect()}
    assert {d for d, _ in near} == {1, 3} and (3, 20) in near
    exact = {r.doc_id for r in phrase_matches(items, index, Windows()).collect()}
    assert exact == {2, 3}

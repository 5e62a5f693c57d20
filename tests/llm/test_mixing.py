import hashlib
import random

import pytest

from tenura.llm.mixing import Mixture, mix, mixed_documents
from tests.llm.samples import SCHEMA, documents, messy_rows


def brute(rows, weights=(1, 2, 3), limit=3):
    sizes = [len((r[1] or "").encode().split()) for r in rows]
    names = sorted({r[3] for r in rows}, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total = {s: sum(n for r, n in zip(rows, sizes) if r[3] == s) for s in names}
    capped: set = set()
    while True:
        free = [s for s in names if s not in capped]
        each = (sum(total.values()) - limit * sum(total[s] for s in capped)) / (sum(weight[s] for s in free) or 1)
        over = {s for s in free if weight[s] * each > limit * total[s]}
        if not over:
            break
        capped |= over
    target = {s: float(limit * total[s]) if s in capped else weight[s] * each for s in names}

    def place(doc_id):
        return int(hashlib.md5(b"" if doc_id is None else str(doc_id).encode()).hexdigest()[:15], 16)

    out = []
    for s in names:
        mine = [(place(r[0]), r, n) for r, n in zip(rows, sizes) if r[3] == s]
        full = int(target[s] // total[s]) if total[s] else 0
        left = target[s] - full * total[s]
        for h, r, n in mine:
            below = sum(m for g, _, m in mine if g < h)
            own = sum(m for g, _, m in mine if g == h)
            out.append((r[0], s, n, total[s], target[s], n * (full + (2 * below + own <= 2 * left))))
    return out, target


def test_against_brute_force(spark):
    rng = random.Random(5)
    sources = ["a", "b", "ä", "z", None, "tiny", "Z"]
    rows = messy_rows() + [(100 + i, "w " * rng.randrange(0, 300 if i % 7 else 3000), "en", rng.choice(sources[:4] if i > 20 else sources)) for i in range(150)]
    found = mix(documents(spark, rows)).collect()
    expected, target = brute(rows)
    key = ("doc_id", "source", "size", "source_size", "taken")
    assert sorted([tuple(r[k] for k in key) for r in found], key=repr) == sorted([(*e[:4], e[5]) for e in expected], key=repr)
    for r in found:
        assert r.target == pytest.approx(target[r.source]) and r.taken <= 3 * r["size"]


def test_no_source_size_is_lost_and_levels_do_not_matter(spark):
    rows = [(i, "w " * (1 + i % 9), "en", "hot" if i % 3 else f"s{i % 10}") for i in range(300)]
    first = sorted(map(tuple, mix(documents(spark, rows)).collect()))
    again = sorted(map(tuple, mix(documents(spark, rows).repartition(7), Mixture(bits=6)).collect()))
    assert first == again
    taken = {}
    for r in mix(documents(spark, rows)).collect():
        taken.setdefault(r.source, [r.target, 0])[1] += r.taken
    assert all(abs(t - got) <= 9 for t, got in taken.values())


def test_documents_are_repeated_or_left_out(spark):
    docs = documents(spark, messy_rows())
    left = mixed_documents(docs)
    assert left.columns == docs.columns
    copies = {}
    for r in mix(docs).collect():
        copies[(r.doc_id, r.source, r["size"])] = copies.get((r.doc_id, r.source, r["size"]), 0) + r.copies
    found = {}
    for r in left.collect():
        k = (r.doc_id, r.source, len((r.text or "").encode().split()))
        found[k] = found.get(k, 0) + 1
    assert found == {k: n for k, n in copies.items() if n}


def test_empty_table_and_empty_texts(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert mix(empty).count() == 0 and mixed_documents(empty).count() == 0
    rows = [(1, None, "", "a"), (2, "", "", None)]
    assert [(r.target, r.taken) for r in mix(documents(spark, rows)).collect()] == [(0.0, 0), (0.0, 0)]

"""The Merkle manifest against a plain tree in Python."""

import hashlib
import zlib

import pytest

from tenura.llm.merkle import leaves, manifest, verified_documents, versions
from tests.llm.samples import SCHEMA, documents, messy_rows


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row):
    doc_id, text, lang, source, n_chars = row
    values = [None if v is None else str(v) for v in (doc_id, source, lang, n_chars, text)]
    return sha("".join("-" if v is None else f"{len(v.encode())}:{v}" for v in values))


def lowered(text):
    return None if text is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def climbed(nodes):
    """The root, and for each node the list of (before, after) up to it."""
    paths, at, level = [[] for _ in nodes], list(range(len(nodes))), list(nodes)
    while len(level) > 1:
        for i, place in enumerate(at):
            start = place - place % 8
            paths[i].append(("".join(level[start:place]), "".join(level[place + 1 : start + 8])))
            at[i] = place // 8
        level = [sha("".join(level[i : i + 8])) for i in range(0, len(level), 8)]
    return level[0], paths


def brute_force(rows):
    trees = {}
    for row in rows:
        trees.setdefault(row[2], []).append((row[0] is not None, row[0] or 0, leaf_of(row), row))
    order = sorted(trees, key=lambda lang: (lang is not None, (lang or "").encode()))
    below = {lang: climbed([x[2] for x in sorted(trees[lang], key=lambda x: x[:3])]) for lang in order}
    if not order:
        return []
    root, above = climbed([below[lang][0] for lang in order])
    out = []
    for lang, upper in zip(order, above):
        for (*_, leaf, row), path in zip(sorted(trees[lang], key=lambda x: x[:3]), below[lang][1]):
            whole = path + upper
            node = leaf
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0:
                node = leaf_of((row[0], lowered(row[1]), *row[2:]))
            for before, after in whole:
                node = sha(before + node + after)
            out.append((repr(row[0]), leaf, below[lang][0], root, sha("".join(b + a for b, a in whole)), node, node == root))
    return sorted(out)


def found(docs):
    return sorted((repr(r[0]), *r[1:]) for r in verified_documents(docs).collect())


def table(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize("sizes", [[1], [8], [9], [1, 2, 64, 65], [7, 512, 513], [1, 1500, 20]])
def test_trees_of_all_shapes(spark, sizes):
    rows = [(1000 * t + 7 * i % 1000 + i, f"Text {i} of {t}", f"l{t}", "s", i) for t, n in enumerate(sizes) for i in range(n)]
    assert found(table(spark, rows)) == brute_force(rows)


def test_many_languages(spark):
    rows = [(i, f"A{i}", None if i == 5 else f"l{i % 600}é", None, None) for i in range(1300)]
    assert found(table(spark, rows)) == brute_force(rows)


def test_messy_rows(spark):
    rows = messy_rows()
    docs = documents(spark, rows)
    plain = [(*r, len(r[1]) if r[1] is not None else None) for r in rows]
    assert found(docs) == brute_force(plain)


def test_repeated_ids_and_rows(spark):
    rows = [(3, f"T{i % 4}", "en", "s", 1) for i in range(40)] + [(None, None, None, None, None)] * 9
    assert found(table(spark, rows)) == brute_force(rows)


def test_empty_table(spark):
    docs = table(spark, [])
    assert verified_documents(docs).count() == 0
    made = manifest(leaves(docs))
    assert made.root is None and made.subtrees.count() == 0 and versions(made).count() == 0


def test_versions_copy_only_the_path(spark):
    rows = [(i, f"Text {i}", "en" if i % 5 else "de", "s", i) for i in range(900)]
    made = manifest(leaves(table(spark, rows)))
    copies = versions(made).collect()
    heights = {}
    for r in copies:
        heights.setdefault((r.doc_id, r.lang), {})[r.height] = r.digest
    tampered = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 3 == 0]
    assert len(heights) == len(tampered)
    # 720 leaves need four levels, 180 three; the languages' tree adds one.
    assert all(len(nodes) == (1 + 4 + 1 if lang == "en" else 1 + 3 + 1) for (_, lang), nodes in heights.items())
    tops = {r.doc_id: r.folded_root for r in verified_documents(table(spark, rows)).collect()}
    assert all(nodes[max(nodes)] == tops[doc_id] for (doc_id, _), nodes in heights.items())
    assert {r.lang: r.rows for r in made.subtrees.collect()} == {"en": 720, "de": 180}

import numpy as np
import pytest

from tenura.llm.additive import FEATURES, Additive, boosted, edges_of, quality, shallow_tree, text_features
from tenura.llm.texts import table
from tests.llm.samples import SCHEMA, documents, messy_rows


def test_trees_find_the_best_cut():
    g, h = np.array([1.0, 1.0, -3.0, -3.0, -3.0]), np.ones(5)
    assert shallow_tree(g, h, 2, 0.0) == pytest.approx([1, 1, -3, -3, -3])
    assert shallow_tree(g, h, 1, 0.0) == pytest.approx([-7 / 5] * 5)


def test_pairs_learn_what_single_features_cannot():
    draw = np.random.default_rng(0)
    x = draw.random((1500, 4))
    y = ((x[:, 0] > 0.5) ^ (x[:, 2] > 0.5)).astype(float)
    model = boosted(x, y, Additive())
    assert (0, 2) in model.pairs
    assert ((model.score(x) >= 0.5) == y).mean() > 0.95
    alone = boosted(x, y, Additive(pairs=0))
    assert ((alone.score(x) >= 0.5) == y).mean() < 0.7


def test_scores_are_sums_of_lookups():
    draw = np.random.default_rng(1)
    x = draw.random((300, 3))
    model = boosted(x, (x.sum(axis=1) > 1.5).astype(float), Additive(rounds=5, pair_rounds=3))
    for row in x[:20]:
        total = model.intercept + sum(t[np.searchsorted(e, v, "right")] for e, t, v in zip(model.edges, model.tables, row))
        for (a, b), t in zip(model.pairs, model.pair_tables):
            total += t[np.searchsorted(model.pair_edges[a], row[a], "right"), np.searchsorted(model.pair_edges[b], row[b], "right")]
        assert model.score(row[None])[0] == pytest.approx(1 / (1 + np.exp(-total)))


def test_features_of_texts():
    assert text_features(None) == text_features(" \n") == [0.0] * len(FEATURES)
    named = dict(zip(FEATURES, text_features("A a #b\nA a #b !")))
    assert named["symbols"] == pytest.approx(2 / 9) and named["repeated_lines"] == 0 and named["top_word"] == pytest.approx(2 / 7)
    assert all(np.isfinite(text_features(t)).all() for t in ("!", "🙂", "\x00", "ß" * 10_000, "1 2 3"))
    assert len(edges_of(np.ones(50), 8)) == 1


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    rows = quality(table(spark, folder, "documents"), table(spark, folder, "labels")).join(table(spark, folder, "labels"), "doc_id").where("held_out AND quality IS NOT NULL").collect()
    assert np.mean([r.predicted == r["quality"] for r in rows]) >= 0.97


def test_messy_rows_and_missing_labels(spark):
    labels = spark.createDataFrame([(1, None, None), (None, 1, 1)], "doc_id bigint, quality int, toxic int")
    found = quality(documents(spark, messy_rows()), labels).collect()
    assert len(found) == len(messy_rows()) and {r.score for r in found} == {0.5}
    assert quality(spark.createDataFrame([], SCHEMA), labels).count() == 0

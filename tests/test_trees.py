"""Tree attributions against enumeration of all subsets, and boosting against a small numpy version."""

from itertools import combinations
from math import factorial

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from tenura.operators import boosting, trees
from tenura.operators.boosting import Boosting, BoostingRun, best_split, leaf_value, soft


def table(spark, n=240, slots=5, seed=3):
    """Rows with slots of few values, one of them binary, and a label that depends on three of them."""
    draw = np.random.default_rng(seed)
    x = np.column_stack([draw.integers(0, 9, n) / 2.0, draw.normal(0, 1, n).round(2), draw.integers(0, 2, n), draw.integers(0, 4, n),
                         draw.normal(0, 1, n).round(1)])[:, :slots]
    y = ((x[:, 0] > 2) ^ (x[:, 2] > 0) | (x[:, 1] > 1.2)).astype(float)
    rows = [(str(i), [float(v) for v in r], float(t), float(1 + i % 3), i % 4 != 0) for i, (r, t) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "key string, x array<double>, label double, weight double, train boolean"), x, y


def conditional(nodes, x, known):
    """A tree's expected value when some slots are known; others follow both branches by cover."""
    def value(i):
        left, right, slot, threshold, cover, leaf = nodes[i]
        if left < 0:
            return leaf
        if slot in known:
            return value(left if x[slot] <= threshold else right)
        a, b = nodes[left][4], nodes[right][4]
        return (a * value(left) + b * value(right)) / (a + b)

    return value(min(nodes))


def enumerated(forest, x, slots):
    def total(known):
        return sum(conditional(tree, x, known) for tree in forest)

    out = []
    for i in range(slots):
        others = [j for j in range(slots) if j != i]
        out.append(sum(
            factorial(len(s)) * factorial(slots - 1 - len(s)) / factorial(slots) * (total({*s, i}) - total(set(s)))
            for size in range(slots) for s in combinations(others, size)))
    return out, total(set())


@pytest.mark.parametrize("kind", ["boosted", "forest"])
def test_attributions_equal_enumeration(spark, kind):
    if kind == "boosted":
        estimator = GBTClassifier(maxIter=4, maxDepth=4, seed=1, weightCol="weight")
    else:
        estimator = RandomForestClassifier(numTrees=5, maxDepth=5, seed=1, weightCol="weight")
    df, x, _ = table(spark)
    vectors = df.withColumn("features", array_to_vector("x"))
    model = estimator.fit(vectors)
    nodes = trees.ensemble_nodes(model)
    tables = trees.path_table(nodes)
    forest = {}
    for r in nodes.collect():
        forest.setdefault(r.tree, {})[r.id] = (r.left, r.right, r.slot, r.threshold, r.cover, r.value)
    names = [[f"s{i}"] for i in range(5)]
    found = trees.path_attributions(df, "key", "x", tables, names, [n[0] for n in names]).collect()
    scored = {r.key: r for r in model.transform(vectors).select("key", "rawPrediction", "probability").collect()}
    assert len(found) == len(x)
    for r in found:
        values = [e.shap_value for e in r.attributions]
        assert abs(r.base + sum(values) - r.prediction) < 1e-9
        own = scored[r.key]
        # Spark's margin is half the log-odds.
        assert abs(r.prediction - (2 * own.rawPrediction[1] if kind == "boosted" else own.probability[1])) < 1e-9
    for r in found[::40]:
        expected, base = enumerated(forest.values(), x[int(r.key)], 5)
        assert np.allclose([e.shap_value for e in r.attributions], expected, atol=1e-9) and abs(r.base - base) < 1e-9


def test_slots_of_one_feature_are_summed(spark):
    df, _, _ = table(spark)
    nodes = spark.createDataFrame(
        [(0, 0, 1, 2, 0, 2.0, 10.0, None), (0, 1, -1, -1, -1, None, 4.0, 1.0), (0, 2, 3, 4, 1, 0.0, 6.0, None),
         (0, 3, -1, -1, -1, None, 6.0, 3.0), (0, 4, -1, -1, -1, None, 0.0, 9.0)], trees.NODES)
    tables = trees.path_table(nodes)
    apart = trees.path_attributions(df, "key", "x", tables, [[f"s{i}"] for i in range(5)], list("abcde"))
    joint = trees.path_attributions(df, "key", "x", tables, [["s0", "s1"], ["s2"], ["s3", "s4"]], list("xyz"))
    sums = {r.key: sum(e.shap_value for e in r.attributions[:2]) for r in apart.collect()}
    for r in joint.collect():
        assert abs(r.attributions[0].shap_value - sums[r.key]) < 1e-12
        assert abs(r.base + sum(e.shap_value for e in r.attributions) - r.prediction) < 1e-9


def numpy_trees(x, y, w, cuts, how, start):
    """Plain recursive boosting on the same cut points."""
    margin, made = np.full(len(y), start), []
    for _ in range(how.rounds):
        p = 1 / (1 + np.exp(-margin))
        g, h = w * (p - y), w * p * (1 - p)
        tree = []

        def grow(rows, depth):
            G, H = g[rows].sum(), h[rows].sum()
            value = -np.sign(G) * max(abs(G) - how.alpha, 0) / (H + how.penalty) * how.rate

            def score(a, b):
                return max(abs(a) - how.alpha, 0) ** 2 / (b + how.penalty)

            best = (0.0, None)
            if depth < how.depth:
                for slot, points in enumerate(cuts):
                    for cut in points:
                        left = x[rows, slot] <= cut
                        a, b = g[rows][left].sum(), h[rows][left].sum()
                        gain = 0.5 * (score(a, b) + score(G - a, H - b) - score(G, H))
                        if min(b, H - b) >= how.least_child and gain > how.gamma + 1e-9 and gain > best[0] + 1e-12:
                            best = (gain, (slot, cut))
            if best[1] is None:
                tree.append((None, None, round(float(value), 9)))
                margin[rows] += value
                return
            slot, cut = best[1]
            tree.append((slot, cut, None))
            left = x[rows, slot] <= cut
            grow(rows[left], depth + 1)
            grow(rows[~left], depth + 1)

        grow(np.arange(len(y)), 0)
        made.append(tree)
    return made


def flat(model):
    made = []
    for tree in model.trees:
        out = []

        def walk(i):
            if tree.slot[i] < 0:
                out.append((None, None, round(tree.value[i], 9)))
                return
            out.append((tree.slot[i], model.cuts[tree.slot[i]][tree.bin[i]], None))
            walk(tree.left[i])
            walk(tree.right[i])

        walk(0)
        made.append(out)
    return made


def test_trees_equal_a_small_numpy_version(spark):
    df, x, y = table(spark)
    plain = Boosting(rounds=4, depth=3, rate=0.3, row_share=1.0, column_share=1.0)
    settings = [plain, Boosting(4, 4, 0.2, 1.0, 1.0, 2.0, 0.4, 0.7, 3.0), Boosting(3, 2, 1.0, 1.0, 1.0, 0.5, 0.0, 0.0, 0.01)]
    run = BoostingRun(df, settings, "key", "label", "x", "train", positive_weight=2.0)
    run.advance({0: 4, 1: 4, 2: 3})
    train = np.array([i % 4 != 0 for i in range(len(y))])
    w = np.where(y == 1, 2.0, 1.0)
    share = (w * y)[train].sum() / w[train].sum()
    assert abs(run.start - np.log(share / (1 - share))) < 1e-12
    for trial, how in enumerate(settings):
        model = run.model(trial)
        assert flat(model) == numpy_trees(x[train], y[train], w[train], run.cuts, how, run.start)
        margin = model.margins(x)
        losses = w * (np.logaddexp(0, margin) - y * margin)
        last = [row for row in run.losses if row[0] == trial][-1]
        assert last[1] == how.rounds
        assert np.allclose(last[2:], [losses[train].sum() / w[train].sum(), losses[~train].sum() / w[~train].sum()])


def test_models_side_by_side_equal_models_alone(spark):
    df, x, _ = table(spark)
    settings = [Boosting(rounds=5, depth=d, row_share=0.7, column_share=0.6) for d in (2, 4)]
    both = BoostingRun(df, settings, "key", "label", "x", "train")
    both.advance({0: 2, 1: 2})
    both.settle()
    both.advance({0: 5, 1: 5})
    alone = BoostingRun(df, [settings[0]], "key", "label", "x", "train")
    alone.advance({0: 5})
    assert flat(both.model(0)) == flat(alone.model(0))
    found = both.scores([1]).collect()
    margins = both.model(1).margins(x[::4])
    assert np.allclose(sorted(r.probability for r in found), sorted(1 / (1 + np.exp(-margins))))


def test_models_of_different_depths_do_not_wait_for_each_other(spark, monkeypatch):
    df, x, _ = table(spark)
    settings = [Boosting(6, 1, 0.3, 0.7, 0.6, 0.1), Boosting(2, 4, 0.3, 0.7, 0.6, 0.1)]
    jobs, level = [], BoostingRun._level
    monkeypatch.setattr(BoostingRun, "_level", lambda run, *a: jobs.append(a[0]) or level(run, *a))
    both = BoostingRun(df, settings, "key", "label", "x", "train")
    both.advance({0: 6, 1: 2})
    assert len(jobs) == 9  # two trees of four levels, and the last losses
    assert [row[:2] for row in sorted(both.losses)] == [(0, i) for i in range(7)] + [(1, i) for i in range(3)]
    alone = BoostingRun(df, [settings[0]], "key", "label", "x", "train")
    alone.advance({0: 6})
    assert flat(both.model(0)) == flat(alone.model(0))
    assert [row[1:] for row in sorted(both.losses) if row[0] == 0] == sorted(row[1:] for row in alone.losses)


def test_a_table_of_some_rows_has_work_for_all_cores(spark):
    df, _, _ = table(spark, n=12_000)
    run = BoostingRun(df, [Boosting(rounds=1, depth=2)], "key", "label", "x", "train")
    assert run.state.rdd.getNumPartitions() == 4
    run.advance({0: 1})
    assert not run.kept


def test_margins_kept_by_executors_are_those_of_all_trees(spark, monkeypatch):
    monkeypatch.setattr(boosting, "SETTLE", 2)
    df, x, _ = table(spark)
    run = BoostingRun(df, [Boosting(rounds=6, depth=2)], "key", "label", "x", "train")
    run.advance({0: 6})
    margins = run.model(0).margins(x[::4])
    assert np.allclose(sorted(r.probability for r in run.scores([0]).collect()), sorted(1 / (1 + np.exp(-margins))))


def indicators(spark, n=300):
    """Rows with a wide slot, five indicators of one choice, one of its own, and a constant."""
    draw = np.random.default_rng(11)
    choice, own, wide = draw.integers(0, 6, n), draw.integers(0, 2, n), draw.normal(0, 1, n).round(1)
    x = np.column_stack([*[choice == k for k in range(5)], wide, own, np.ones(n)]).astype(float)
    y = ((choice == 2) | (own > 0) & (wide > 0.2)).astype(float)
    rows = [(str(i), [float(v) for v in r], float(t), i % 4 != 0) for i, (r, t) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "key string, x array<double>, label double, train boolean"), x, y


def test_indicators_of_one_choice_share_a_code(spark):
    df, x, y = indicators(spark)
    how = Boosting(rounds=3, depth=4, rate=0.5, row_share=1.0, column_share=1.0, least_child=0.2)
    run = BoostingRun(df, [how], "key", "label", "x", "train")
    assert run.layout.columns == 3 and run.layout.column[7] == -1
    assert len({run.layout.column[i] for i in range(5)}) == 1 and run.layout.column[6] not in (run.layout.column[0], run.layout.column[5])
    run.advance({0: 3})
    train = np.array([i % 4 != 0 for i in range(len(y))])
    assert flat(run.model(0)) == numpy_trees(x[train], y[train], np.ones(train.sum()), run.cuts, how, run.start)
    bins = boosting.binned(x, run.cuts)
    codes, some = run.layout.coded(bins), np.arange(3, 250, 7)
    for tree in run.trees[0]:
        assert run.layout.leaves(tree, codes).tolist() == tree.leaves_of(bins).tolist()
        assert run.layout.leaves(tree, codes, some).tolist() == tree.leaves_of(bins)[some].tolist()


def test_rows_lie_in_blocks_with_margins_of_growing_models_only(spark, monkeypatch):
    monkeypatch.setattr(boosting, "BLOCK_ROWS", 50)
    df, x, _ = table(spark)
    run = BoostingRun(df, [Boosting(rounds=4, depth=2), Boosting(rounds=2, depth=3), Boosting(rounds=1)], "key", "label", "x", "train")
    assert run.state.count() == 5
    carried, move = [], BoostingRun._move
    monkeypatch.setattr(BoostingRun, "_move", lambda run, models: carried.append(models) or move(run, models))
    run.advance({0: 2, 1: 2, 2: 1})
    run.advance({0: 4})
    assert carried[0] == [0, 1, 2] and carried[-1] == [0] and not run.kept
    run.settle([0])
    rows = run.state.select((F.length("margins") / 8).alias("margins"), (F.length("id") / 8).alias("rows")).collect()
    assert all(r["margins"] == r["rows"] for r in rows) and sum(r["rows"] for r in rows) == 240
    for trial in (0, 1):  # one that went on, and one whose margins were dropped
        found = run.scores([trial]).collect()
        margins = run.model(trial).margins(x[::4])
        assert np.allclose(sorted(r.probability for r in found), sorted(1 / (1 + np.exp(-margins))))


def test_sums_of_the_driver_are_those_of_tasks(spark, monkeypatch):
    df, _, _ = table(spark, n=12_000)
    settings = [Boosting(rounds=2, depth=d, row_share=0.7, column_share=0.6) for d in (2, 4)]
    made = []
    for most in (boosting.DRIVER_BYTES, 0):
        monkeypatch.setattr(boosting, "DRIVER_BYTES", most)
        run = BoostingRun(df, settings, "key", "label", "x", "train")
        run.advance({0: 2, 1: 2})
        made.append((run.trees, sorted(run.losses)))
    assert made[0] == made[1]


def test_exact_sums_do_not_depend_on_tasks_and_give_those_of_siblings(spark, monkeypatch):
    df, x, _ = table(spark, n=3_000)
    settings = [Boosting(rounds=2, depth=d, row_share=0.7, column_share=0.6, least_child=0.5) for d in (1, 4)]
    asked, summed = [], BoostingRun._rest
    monkeypatch.setattr(BoostingRun, "_rest", lambda run, *a: asked.append(summed(run, *a)) or asked[-1])

    def grown():
        run = BoostingRun(df, settings, "key", "label", "x", "train")
        run.advance({0: 2, 1: 2})
        return run

    plain = grown()
    assert plain.unit is None and not any(asked)
    monkeypatch.setattr(boosting, "MOST_TASK_ROWS", 0)
    few = grown()
    assert sum(map(len, asked)) >= 2 * 4  # of each of two trees of four levels the larger halves
    monkeypatch.setattr(boosting, "TASK_ROWS", 300)
    many = grown()
    assert few.state.rdd.getNumPartitions() < many.state.rdd.getNumPartitions() and few.trees == many.trees
    del asked[:]
    monkeypatch.setattr(boosting, "DRIVER_BYTES", 0)
    assert grown().trees == few.trees
    for trial in (0, 1):
        assert [(t.slot, t.bin, t.left) for t in few.trees[trial]] == [(t.slot, t.bin, t.left) for t in plain.trees[trial]]
        assert np.allclose(few.model(trial).margins(x), plain.model(trial).margins(x), atol=1e-9)


def test_tabulated_paths_give_the_same_attributions(monkeypatch):
    draw = np.random.default_rng(5)
    x, owners = draw.integers(0, 4, (150, 9)).astype(float), np.array([0, 0, 1, 2, 2, 2, 3, 4, 4])

    def paths(n, size):
        slot = np.stack([draw.permutation(9)[:size] for _ in range(n)]).reshape(n, size)
        cut, up = draw.integers(0, 3, (n, size)) + 0.5, draw.random((n, size)) < 0.5
        share = np.where(draw.random((n, size)) < 0.1, 0.0, draw.random((n, size)))
        return trees.Paths(draw.normal(size=n), slot, np.where(up, cut, -np.inf), np.where(up, np.inf, cut), share)

    tables = [paths(3, 0), paths(5, 1), paths(40, 4), paths(2500, 3), paths(30, 6), paths(20, 7)]
    for values in (1 << 24, 3000):  # all but the longest and the empty ones; few
        monkeypatch.setattr(trees, "TABLE_VALUES", values)
        made, rest = trees.lookups(tables, owners)
        assert len(made) + len(rest) == (7 if values > 3000 else 6) and any(t is tables[5] for t in rest)
        found, total = trees.attributed(x, rest, owners, 5), trees.predictions(x, rest)
        for part in made:
            part.add(x, found, total)
        assert np.allclose(found, trees.attributed(x, tables, owners, 5), atol=1e-12)
        assert np.allclose(total, trees.predictions(x, tables), atol=1e-12)


def test_stops_without_gain_on_validation_rows(spark):
    df, x, _ = table(spark)
    noise = df.withColumn("label", F.pmod(F.xxhash64("key"), F.lit(2)).cast("double"))
    run = BoostingRun(noise, [Boosting(rounds=60, rate=0.5, penalty=0.1)], "key", "label", "x", "train", patience=3)
    run.advance({0: 60})
    assert run.stopped[0] and len(run.trees[0]) < 60
    best = min(run.losses, key=lambda row: (row[3], row[1]))
    assert len(run.model(0).trees) == best[1]
    scored = boosting.with_boosted_probability(df.where("NOT train"), run.model(0), "x")
    assert np.allclose(sorted(r.probability for r in scored.collect()), sorted(r.probability for r in run.scores([0]).collect()))


def test_attributions_of_boosted_models(spark):
    df, x, _ = table(spark)
    run = BoostingRun(df, [Boosting(rounds=6, depth=4)], "key", "label", "x", "train")
    run.advance({0: 6})
    model = run.model(0)
    tables = trees.path_table(model.nodes(spark))
    names = [f"s{i}" for i in range(5)]
    found = trees.path_attributions(df, "key", "x", tables, [[n] for n in names], names).collect()
    margins = model.margins(x)
    for r in found:
        assert abs(r.prediction - margins[int(r.key)]) < 1e-9
        assert abs(r.base + sum(e.shap_value for e in r.attributions) - r.prediction) < 1e-9


def test_parts_of_a_split():
    assert soft(np.array([3.0, -3.0, 0.5]), 1.0).tolist() == [2.0, -2.0, 0.0]
    assert leaf_value(-4.0, 3.0, Boosting(rate=0.5, alpha=1.0, penalty=1.0)) == 0.375
    assert leaf_value(1.0, 0.0, Boosting(penalty=0.0)) == 0.0
    histogram = np.array([[[1.0, 1.0], [1.0, 1.0], [-2.0, 2.0]], [[2.0, 2.0], [-2.0, 2.0], [0.0, 0.0]]])
    assert best_split(histogram, Boosting(penalty=0.0))[:2] == (0, 1)
    assert best_split(histogram, Boosting(penalty=0.0, gamma=100.0))[0] == -1

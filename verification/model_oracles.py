"""The SQL of the queries of fitted models."""

from __future__ import annotations

from itertools import combinations
from math import factorial

from verification.oracle_base import sql
from verification.oracles import _AUC, _CONFUSION, _GENDER, AGE, ORACLES, REGISTRY

_NUMERIC = (
    "bd registration_init_time transaction_count renewal_count cancel_count total_amount_paid avg_plan_days latest_membership_expire_date "
    "num_active_days total_secs avg_total_secs total_num_songs avg_num_songs total_num_unq avg_num_unq").split()
_CATEGORICAL = {"city": 0.011, "gender": 0.05, "latest_is_auto_renew": 0.0, "latest_payment_method_id": 0.04, "registered_via": 0.03}

ORACLES["tree_attribution_checks"] = sql("split_sizes", """
  SELECT m AS model, validation AS additive, validation AS equal FROM split_sizes, (SELECT unnest(['boosted_trees', 'random_forest']) AS m)""")


def _fixed_trees() -> str:
    """Shapley values of the two stated trees by all subsets of three features."""
    def part(known: bool, column: str, cut: float, share: str) -> str:
        return f"CAST({column} <= {cut} AS DOUBLE)" if known else share

    def value(known: frozenset[str]) -> str:
        a = part("c" in known, "c", 0.5, "a0")
        al, ar = part("n" in known, "n", 3.5, "a1"), part("t" in known, "t", 9.5, "a2")
        b, bn, bt = part("t" in known, "t", 7.5, "b0"), part("n" in known, "n", 5.5, "b2"), part("t" in known, "t", 11.5, "b4")
        first = f"({a} * ({al} * 0.5 + (1 - {al}) * -0.25) + (1 - {a}) * ({ar} * 1.0 + (1 - {ar}) * 2.0))"
        second = f"({b} * -0.5 + (1 - {b}) * ({bn} * 0.75 + (1 - {bn}) * ({bt} * 0.25 + (1 - {bt}) * -1.0)))"
        return f"({first} + {second})"

    def shapley(feature: str) -> str:
        others = [f for f in "cnt" if f != feature]
        return " + ".join(
            f"{factorial(len(s)) * factorial(2 - len(s)) / 6!r} * ({value(frozenset({*s, feature}))} - {value(frozenset(s))})"
            for size in range(3) for s in combinations(others, size))

    return f"""
  SELECT msno, round({value(frozenset())}, 6) AS base, round({value(frozenset("cnt"))}, 6) AS prediction,
    round({shapley("c")}, 6) AS cancel_count, round({shapley("n")}, 6) AS num_active_days, round({shapley("t")}, 6) AS transaction_count
  FROM known, (SELECT
    avg(CAST(c <= 0.5 AS DOUBLE)) AS a0, avg(CAST(n <= 3.5 AS DOUBLE)) FILTER (c <= 0.5) AS a1, avg(CAST(t <= 9.5 AS DOUBLE)) FILTER (c > 0.5) AS a2,
    avg(CAST(t <= 7.5 AS DOUBLE)) AS b0, avg(CAST(n <= 5.5 AS DOUBLE)) FILTER (t > 7.5) AS b2,
    avg(CAST(t <= 11.5 AS DOUBLE)) FILTER (t > 7.5 AND n > 5.5) AS b4 FROM known)"""


_KNOWN = """(SELECT msno, coalesce(CAST(cancel_count AS DOUBLE), 0) AS c, coalesce(CAST(num_active_days AS DOUBLE), 0) AS n,
    coalesce(CAST(transaction_count AS DOUBLE), 0) AS t FROM customer_features)"""
ORACLES["fixed_tree_attributions"] = sql("customer_features", _fixed_trees().replace("FROM known", f"FROM {_KNOWN} known"))
ORACLES["penalised_tree_checks"] = sql("split_sizes", """
  SELECT validation AS explained, true AS same_loss, true AS train_loss_falls, true AS best_round FROM split_sizes""")
# Thirty trials; a third, rounded up, goes on from each of four rungs.
ORACLES["tuning_checks"] = """
  SELECT CAST(i AS INTEGER) AS trial, true AS in_ranges, true AS all_rounds, true AS no_gap, true AS best_round, true AS improved, true AS ordered,
    '30,10,4,2' AS at_rungs FROM range(30) t(i)"""
ORACLES["forest_checks"] = sql("split_sizes", """
  SELECT validation AS in_range, CAST(1 AS DOUBLE) AS importance, CAST(0 AS DOUBLE) AS constant, true AS all_slots FROM split_sizes""")
ORACLES["perceptron_checks"] = sql("split_sizes", "SELECT validation AS equal, training AS rows FROM split_sizes")
ORACLES["comparison_checks"] = """
  SELECT m AS model, true AS marked, true AS in_range, true AS agrees FROM (SELECT unnest(['logistic_regression', 'random_forest']) AS m)"""
_CORRELATION = ", ".join(
    f"('{f}', (SELECT coalesce(abs(round(CASE WHEN isfinite(corr({f}, is_churn)) THEN corr({f}, is_churn) END, 6)), 0) FROM customer_features))" for f in _NUMERIC)
_CLOSE = " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, corr({a}, {b}) AS r FROM customer_features" for a in _NUMERIC for b in _NUMERIC if a != b)
_STATED = ", ".join(f"('{f}', {v})" for f, v in _CATEGORICAL.items())
ORACLES["selection_from_importances"] = sql("customer_features", f"""
, measured(feature, v) AS (VALUES {_CORRELATION}), stated(feature, v) AS (VALUES {_STATED}),
  ranked AS (
    SELECT *, row_number() OVER (ORDER BY v DESC, feature) AS rank, count(*) FILTER (v > 0.01) OVER () AS above
    FROM (SELECT feature, CAST(v AS DOUBLE) AS v, false AS stated FROM measured UNION ALL SELECT feature, CAST(v AS DOUBLE), true FROM stated)
  ), chosen AS (SELECT * FROM ranked WHERE CASE WHEN above >= 8 THEN v > 0.01 ELSE rank <= 8 END),
  close AS (SELECT a, list(b) AS near FROM ({_CLOSE}) WHERE isfinite(r) AND abs(r) >= 0.9 GROUP BY a),
  numbers AS (SELECT feature, near, row_number() OVER (ORDER BY rank) AS k FROM chosen LEFT JOIN close ON a = feature WHERE NOT stated),
  walked(k, kept) AS (
    SELECT CAST(0 AS BIGINT), CAST([] AS VARCHAR[])
    UNION ALL
    SELECT numbers.k, CASE WHEN list_has_any(kept, coalesce(near, [])) THEN kept ELSE list_append(kept, feature) END
    FROM walked JOIN numbers ON numbers.k = walked.k + 1
  ), selected AS (
    SELECT list_concat((SELECT coalesce(list(feature ORDER BY rank), []) FROM chosen WHERE stated), kept) AS names FROM walked ORDER BY k DESC LIMIT 1
  )
  SELECT r.feature, round(v, 6) AS perm_importance_mean,
    CASE WHEN list_contains(names, r.feature) THEN 'kept' WHEN r.feature IN (SELECT feature FROM chosen) THEN 'dropped_correlation' ELSE 'dropped_importance' END AS status,
    CASE WHEN list_contains(names, r.feature) THEN CAST(list_position(names, r.feature) AS INTEGER) END AS position
  FROM ranked r, selected""").replace("WITH ", "WITH RECURSIVE ", 1)
ORACLES["strategy_from_metrics"] = sql("cases", f"""
  SELECT strategy, round(f1, 6) AS f1_churn, round(recall, 6) AS recall_churn,
    row_number() OVER (ORDER BY f1 DESC, recall DESC, strategy DESC) = 1 AS chosen
  FROM (SELECT CASE model_version WHEN 'v0' THEN 'smote' ELSE 'class_weight_balanced' END AS strategy,
      coalesce(2*tp / nullif(2*tp + fp + fn, 0), 0) AS f1, coalesce(tp / nullif(tp + fn, 0), 0) AS recall
    FROM (SELECT model_version, {_CONFUSION} FROM cases WHERE model_version IN ('v0', 'v1') GROUP BY model_version))""")
_CARD_FAIR = """
  SELECT 'fairness_{name}' AS section, unnest([g || ' sample_size', g || ' churn_rate', g || ' predicted_churn_rate']) AS name,
    unnest([CAST(n AS VARCHAR), printf('%.4f', r), printf('%.4f', p)]) AS value
  FROM (SELECT {group} AS g, count(*) AS n, avg(is_churn) AS r, avg(predicted) AS p FROM cases GROUP BY {group})
  UNION ALL SELECT 'fairness_{name}', 'gap', printf('%.4f', max(r) - min(r)) FROM (SELECT avg(is_churn) AS r FROM cases GROUP BY {group})"""
ORACLES["model_card_facts"] = sql("cases customer_features", f"""
  SELECT 'training_data' AS section, 'rows' AS name, CAST(count(*) AS VARCHAR) AS value FROM customer_features
  UNION ALL SELECT 'model', 'name', 'churn'
  UNION ALL SELECT 'feature', n, t FROM (VALUES ('bd', 'smallint'), ('gender', 'string'), ('total_amount_paid', 'decimal(20,2)')) f(n, t)
  UNION ALL SELECT 'metric', unnest(['precision_churn', 'recall_churn', 'f1_churn', 'roc_auc']),
    unnest([printf('%.4f', coalesce(tp / nullif(tp + fp, 0), 0)), printf('%.4f', coalesce(tp / nullif(tp + fn, 0), 0)),
      printf('%.4f', coalesce(2*tp / nullif(2*tp + fp + fn, 0), 0)), printf('%.4f', ({_AUC}))]) FROM (SELECT {_CONFUSION} FROM cases)
  UNION ALL {_CARD_FAIR.format(name='gender', group=_GENDER)}
  UNION ALL {_CARD_FAIR.format(name='age_band', group=AGE)}""")
ORACLES["top_importances_report"] = sql("customer_features", f"""
  SELECT feature, round(CAST(v AS DOUBLE), 6) AS perm_importance_mean FROM (VALUES {_CORRELATION}) t(feature, v) ORDER BY v DESC, feature LIMIT 5""")
ORACLES["projected_features"] = sql("customer_features", "SELECT total_amount_paid, msno, gender, bd FROM customer_features")
ORACLES["registration_log"] = sql("version_metrics", """
  SELECT CAST(version AS INTEGER) AS version, stage, role, run_id, round(roc_auc, 6) AS roc_auc, day FROM (
    SELECT list_sort(list(roc_auc))[1:3] AS a FROM version_metrics), (VALUES
      (1, 'Production', 'champion', 'r0', 2, DATE '2024-01-31'), (2, 'Staging', 'challenger', 'r1', 1, DATE '2024-02-01'),
      (1, 'Production', 'champion', 'r0', 2, DATE '2024-02-01'), (3, 'Production', 'champion', 'r2', 3, DATE '2024-02-02'),
      (1, 'Archived', 'former_champion', 'r0', 2, DATE '2024-02-02')) t(version, stage, role, run_id, i, day), unnest([a[i]]) AS u(roc_auc)""")
ORACLES["lineage_log"] = "SELECT * FROM (VALUES " + ", ".join(
    "(" + ", ".join("'" + x.replace("'", "''") + "'" for x in row) + ", true)" for row in REGISTRY) + ") t(feature_name, source_table, transformation_rule, current)"
ORACLES["chosen_training"] = sql("split_sizes train", """
  SELECT validation, (SELECT count(*) - CAST(round_even(0.2 * count(*), 0) AS BIGINT) FROM train WHERE is_churn = 0) AS training_zeros,
    true AS all_kept, true AS balanced, true AS weighted FROM split_sizes""")

# Tables that grow by day and by file ----------------------------------------------------------------------------------

ORACLES["monitoring_state_verdict"] = ORACLES["monitoring_verdict"]
ORACLES["updated_files"] = sql("predictions", """
  SELECT count(*) AS rows, count(DISTINCT pred_id) AS ids, count(*) FILTER (changed) AS changed,
    CAST(count(DISTINCT CASE WHEN changed THEN pred_id % 8 END) AS INTEGER) AS rewritten,
    CAST(count(DISTINCT pred_id % 8) - count(DISTINCT CASE WHEN changed THEN pred_id % 8 END) AS INTEGER) AS kept,
    CAST(count(DISTINCT CASE WHEN changed THEN pred_id % 8 END) AS INTEGER) AS removed
  FROM (SELECT *, risk_tier = 'High' AND pred_id % 8 IN (2, 5) AS changed FROM predictions)""")
ORACLES["partition_watermark"] = sql("predictions", """
  SELECT CAST(s AS INTEGER) AS step, count(*) FILTER (s > 0 OR NOT late) AS row_count, true AS equal,
    CAST(CASE s WHEN 0 THEN count(DISTINCT day) FILTER (NOT late) WHEN 1 THEN count(DISTINCT day) FILTER (late) ELSE 0 END AS INTEGER) AS hashed
  FROM (SELECT scored_at >= TIMESTAMP '2024-01-20' AS late, CAST(scored_at AS DATE) AS day FROM predictions), range(3) t(s) GROUP BY s""")

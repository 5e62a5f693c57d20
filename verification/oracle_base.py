"""SQL building blocks of the oracles: the derived tables as common table expressions."""

from __future__ import annotations

CTES: dict[str, tuple[tuple[str, ...], str]] = {}


def cte(name: str, needs: tuple[str, ...], body: str) -> None:
    CTES[name] = (needs, body)


def sql(needs: str, body: str) -> str:
    """``body`` behind the CTEs it needs, in dependency order."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        for parent in CTES[name][0]:
            visit(parent)
        if name not in ordered:
            ordered.append(name)

    for name in needs.split():
        visit(name)
    if not ordered:
        return body
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n][1]})" for n in ordered) + "\n" + body


cte("members", (), """
  SELECT CAST(c_custkey AS VARCHAR) AS msno, c_nationkey AS city, CAST(floor(c_acctbal/100) AS INTEGER) AS bd,
    CASE c_custkey % 3 WHEN 0 THEN 'male' WHEN 1 THEN 'female' END AS gender,
    CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 3 WHEN 'BUILDING' THEN 4 WHEN 'FURNITURE' THEN 7
      WHEN 'HOUSEHOLD' THEN 9 ELSE 13 END AS registered_via,
    CAST((1990 + c_custkey % 5)*10000 + (1 + c_custkey % 12)*100 + 1 + c_custkey % 28 AS INTEGER) AS registration_init_time
  FROM customer WHERE c_custkey % 8 <> 7""")
cte("train", (), """
  SELECT CAST(c_custkey AS VARCHAR) AS msno,
    CASE WHEN EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderdate >= TIMESTAMP '2000-08-01')
      THEN 0 ELSE 1 END AS is_churn
  FROM customer""")
cte("transactions", (), """
  SELECT txn_id, msno, payment_method_id, payment_plan_days, plan_list_price, actual_amount_paid, is_auto_renew,
    CAST(strftime(d, '%Y%m%d') AS INTEGER) AS transaction_date,
    CAST(strftime(d + payment_plan_days * INTERVAL 1 DAY, '%Y%m%d') AS INTEGER) AS membership_expire_date, is_cancel
  FROM (
    SELECT o_orderkey AS txn_id, CAST(o_custkey AS VARCHAR) AS msno,
      CAST(CAST(substr(o_orderpriority,1,1) AS INTEGER) + 5*(o_orderkey % 8) AS INTEGER) AS payment_method_id,
      CASE o_orderkey % 4 WHEN 0 THEN 7 WHEN 1 THEN 30 WHEN 2 THEN 90 ELSE 195 END AS payment_plan_days,
      CAST(floor(o_totalprice) AS INTEGER) AS plan_list_price,
      CAST(floor(o_totalprice) - 10*(o_orderkey % 3) AS INTEGER) AS actual_amount_paid,
      CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS is_auto_renew, o_orderdate AS d,
      CASE WHEN o_orderstatus = 'P' AND o_orderkey % 5 = 0 THEN 1 ELSE 0 END AS is_cancel
    FROM orders WHERE o_orderdate < TIMESTAMP '2000-08-01' AND o_custkey % 50 <> 49)""")
cte("user_logs", (), """
  SELECT CAST(user_id AS VARCHAR) AS msno, CAST(strftime(ts, '%Y%m%d') AS INTEGER) AS date,
    count(*) FILTER (event_type = 'view') AS num_25, count(*) FILTER (event_type = 'click') AS num_50,
    count(*) FILTER (event_type = 'signup') AS num_75, count(*) FILTER (event_type = 'error') AS num_985,
    count(*) FILTER (event_type = 'purchase') AS num_100,
    count(DISTINCT json_extract_string(props, '$.k')) AS num_unq,
    CAST(sum(CAST(value AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS total_secs
  FROM events GROUP BY ALL""")
cte("predictions", (), """
  SELECT pred_id, customer_id, scored_at, churn_probability, model_version, threshold_version, feature_snapshot_id,
    CASE WHEN churn_probability >= 0.7 THEN 'High' WHEN churn_probability >= 0.4 THEN 'Medium' ELSE 'Low' END AS risk_tier
  FROM (
    SELECT event_id AS pred_id, CAST(user_id AS VARCHAR) AS customer_id, ts AS scored_at,
      least(CAST(round(value*100) AS BIGINT) // 2, 10000) / 10000.0 AS churn_probability,
      'v' || (event_id % 3) AS model_version, 'v1' AS threshold_version,
      CASE WHEN event_id % 7 <> 0 THEN 'snap-' || strftime(ts, '%Y%m%d') END AS feature_snapshot_id
    FROM events)""")
cte("latest_txn", ("transactions",), """
  SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (
      PARTITION BY msno ORDER BY transaction_date DESC NULLS LAST, txn_id DESC) AS rn FROM transactions) WHERE rn = 1""")
cte("txn_agg", ("transactions", "latest_txn"), """
  SELECT t.msno, CAST(count(*) AS INTEGER) AS transaction_count,
    CAST(count(*) FILTER (t.is_cancel = 0) AS INTEGER) AS renewal_count, CAST(sum(t.is_cancel) AS INTEGER) AS cancel_count,
    CAST(sum(t.actual_amount_paid) AS DOUBLE) AS total_amount_paid,
    CAST((2*100*sum(t.payment_plan_days) + count(*)) // (2*count(*)) AS DOUBLE) / 100 AS avg_plan_days,
    max(l.payment_method_id) AS latest_payment_method_id, max(l.is_auto_renew) AS latest_is_auto_renew,
    max(t.membership_expire_date) AS latest_membership_expire_date
  FROM transactions t JOIN latest_txn l USING (msno) GROUP BY t.msno""")
cte("log_agg", ("user_logs",), """
  SELECT msno, CAST(count(DISTINCT date) AS INTEGER) AS num_active_days, CAST(sum(total_secs) AS DOUBLE) AS total_secs,
    CAST((2*100*CAST(sum(total_secs)*100 AS HUGEINT) + count(*)) // (2*count(*)) AS DOUBLE) / 10000 AS avg_total_secs,
    CAST(sum(songs) AS BIGINT) AS total_num_songs,
    CAST((2*10000*sum(songs) + count(*)) // (2*count(*)) AS DOUBLE) / 10000 AS avg_num_songs,
    CAST(sum(num_unq) AS BIGINT) AS total_num_unq,
    CAST((2*10000*sum(num_unq) + count(*)) // (2*count(*)) AS DOUBLE) / 10000 AS avg_num_unq
  FROM (SELECT *, num_25 + num_50 + num_75 + num_985 + num_100 AS songs FROM user_logs) GROUP BY msno""")
cte("customer_features", ("train", "members", "txn_agg", "log_agg"), """
  SELECT * FROM train LEFT JOIN members USING (msno) LEFT JOIN txn_agg USING (msno) LEFT JOIN log_agg USING (msno)""")
_RAW = "msno, payment_method_id, payment_plan_days, plan_list_price, actual_amount_paid, is_auto_renew, transaction_date, membership_expire_date, is_cancel"
cte("raw_transactions", ("transactions",), f"SELECT {_RAW} FROM transactions")
cte("raw_latest", ("raw_transactions",), """
  SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (
      PARTITION BY msno ORDER BY transaction_date DESC NULLS LAST, payment_method_id DESC, is_auto_renew DESC) AS rn
    FROM raw_transactions) WHERE rn = 1""")
cte("raw_features", ("customer_features", "raw_latest"), """
  SELECT c.* REPLACE (l.payment_method_id AS latest_payment_method_id, l.is_auto_renew AS latest_is_auto_renew)
  FROM customer_features c LEFT JOIN raw_latest l USING (msno)""")
cte("split_sizes", ("train",), """
  SELECT CAST(sum(round_even(0.2 * n, 0)) AS BIGINT) AS validation, CAST(sum(n - round_even(0.2 * n, 0)) AS BIGINT) AS training
  FROM (SELECT is_churn, count(*) AS n FROM train GROUP BY 1)""")
cte("latest", ("predictions",), """
  SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (
      PARTITION BY customer_id ORDER BY scored_at DESC, pred_id DESC) AS rn FROM predictions) WHERE rn = 1""")
cte("recoded", ("transactions",), """
  SELECT * REPLACE (CASE WHEN payment_method_id IN (3,6,8,10,11,12,13,14,16,18,20,22,26) THEN 1
    ELSE payment_method_id END AS payment_method_id) FROM transactions""")
cte("clean_members", ("members",), """
  SELECT msno, city, coalesce(CASE WHEN bd BETWEEN 18 AND 90 THEN CAST(bd AS DOUBLE) END,
      (SELECT quantile_cont(CAST(bd AS DOUBLE), 0.5) FROM members WHERE bd BETWEEN 18 AND 90)) AS bd, gender,
    registered_via, registration_init_time FROM members""")
cte("rollup", ("recoded",), """
  SELECT r.msno, arg_min(r.payment_method_id, r.txn_id) AS payment_method_id,
    CAST(sum(r.payment_plan_days) AS BIGINT) AS total_payment_plan_days,
    CAST(sum(r.plan_list_price) AS BIGINT) AS total_plan_list_price,
    CAST(sum(r.actual_amount_paid) AS BIGINT) AS total_actual_amount_paid,
    max(r.payment_plan_days) FILTER (r.transaction_date = l.last) AS last_plan_days,
    max(r.plan_list_price) FILTER (r.transaction_date = l.last) AS last_plan_price,
    arg_min(r.is_auto_renew, r.txn_id) AS is_auto_renewal, min(r.transaction_date) AS first_transaction_date,
    max(r.transaction_date) AS last_transaction_date, max(r.membership_expire_date) AS membership_expire_date,
    max(r.is_cancel) AS is_cancel, count(*) AS no_of_transactions
  FROM recoded r JOIN (SELECT msno, max(transaction_date) AS last FROM recoded GROUP BY msno) l USING (msno)
  GROUP BY r.msno""")
cte("dated", ("train", "clean_members", "rollup"), """
  SELECT m.* EXCLUDE (registration_init_time, gender), t.is_churn,
    r.* EXCLUDE (msno, first_transaction_date, last_transaction_date, membership_expire_date),
    CAST(strptime(CAST(m.registration_init_time AS VARCHAR), '%Y%m%d') AS DATE) AS registration_init_time,
    CAST(strptime(CAST(r.first_transaction_date AS VARCHAR), '%Y%m%d') AS DATE) AS first_transaction_date,
    CAST(strptime(CAST(r.last_transaction_date AS VARCHAR), '%Y%m%d') AS DATE) AS last_transaction_date,
    CAST(strptime(CAST(r.membership_expire_date AS VARCHAR), '%Y%m%d') AS DATE) AS membership_expire_date
  FROM clean_members m JOIN rollup r USING (msno) JOIN train t USING (msno)""")
cte("training", ("dated",), """
  SELECT msno, is_churn, city, bd, registered_via, payment_method_id, last_plan_days, last_plan_price, is_auto_renewal,
    is_cancel, no_of_transactions, CAST(membership_expire_date - registration_init_time AS INTEGER) AS membership_duration_days,
    CAST(last_transaction_date - first_transaction_date AS INTEGER) AS transaction_span_days,
    total_plan_list_price / no_of_transactions AS avg_plan_price,
    total_payment_plan_days / no_of_transactions AS avg_plan_days,
    total_plan_list_price - total_actual_amount_paid AS amount_due
  FROM dated""")
cte("cases", ("predictions", "customer_features"), """
  SELECT p.*, f.*, is_churn AS actual, CASE WHEN churn_probability >= 0.5 THEN 1 ELSE 0 END AS predicted,
    CASE WHEN is_churn <> (churn_probability >= 0.5)::INT THEN 1 ELSE 0 END AS is_misclassified,
    CASE WHEN is_churn = 1 AND churn_probability < 0.5 THEN 'FN' WHEN is_churn = 0 AND churn_probability >= 0.5 THEN 'FP'
      ELSE 'correct' END AS error_type
  FROM predictions p JOIN customer_features f ON f.msno = p.customer_id""")
cte("labelled", ("predictions", "customer_features"), """
  SELECT pred_id, msno, scored_at, churn_probability AS score, is_churn AS label,
    coalesce(latest_is_auto_renew, 0) AS latest_is_auto_renew,
    CASE WHEN coalesce(cancel_count, 0) > 0 THEN 1 ELSE 0 END AS has_cancel_history,
    CAST(transaction_count AS DOUBLE) AS transaction_count, total_amount_paid, avg_plan_days,
    CAST(num_active_days AS DOUBLE) AS num_active_days, avg_total_secs
  FROM predictions JOIN customer_features ON msno = customer_id WHERE churn_probability IS NOT NULL""")
cte("windowed", ("labelled",), """
  SELECT *, CASE WHEN scored_at >= TIMESTAMP '2024-01-24' THEN 'current'
      WHEN scored_at >= TIMESTAMP '2023-11-02' THEN 'baseline' END AS time_window,
    CAST(('0x' || substr(md5(msno), 1, 8)) AS BIGINT) % 100 AS bucket FROM labelled""")
cte("strategy", ("windowed",), """
  SELECT CASE WHEN count(*) FILTER (time_window = 'current') < 50 OR count(*) FILTER (time_window = 'baseline') < 50
    THEN 'hash_fallback' ELSE 'time_window' END AS cohort_strategy FROM windowed""")
cte("cohorts", ("windowed", "strategy"), """
  SELECT * FROM (SELECT *, CASE WHEN cohort_strategy = 'time_window' THEN time_window
      WHEN bucket < 70 THEN 'baseline' ELSE 'current' END AS cohort FROM windowed, strategy) WHERE cohort IS NOT NULL""")
cte("cohort_auc", ("cohorts",), """
  SELECT cohort, CAST(sum(label) AS BIGINT) AS positives, CAST(sum(1 - label) AS BIGINT) AS negatives,
    sum(CASE WHEN label = 1 THEN below + ties/2.0 ELSE 0 END) / nullif(sum(label) * sum(1 - label), 0) AS roc_auc
  FROM (SELECT cohort, label,
      coalesce(sum(1 - label) OVER (PARTITION BY cohort ORDER BY score RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0)
        - sum(1 - label) OVER (PARTITION BY cohort, score) AS below,
      sum(1 - label) OVER (PARTITION BY cohort, score) AS ties FROM cohorts)
  GROUP BY cohort""")
cte("series", ("cohorts",), """
  SELECT 'feature' AS family, name, cohort, value FROM (UNPIVOT (SELECT cohort, transaction_count, total_amount_paid,
      avg_plan_days, num_active_days, avg_total_secs FROM cohorts) ON COLUMNS(* EXCLUDE cohort) INTO NAME name VALUE value)
  UNION ALL SELECT 'segment', 'latest_is_auto_renew=' || latest_is_auto_renew, cohort, score FROM cohorts
  UNION ALL SELECT 'segment', 'has_cancel_history=' || has_cancel_history, cohort, score FROM cohorts
  UNION ALL SELECT 'score', 'score', cohort, score FROM cohorts""")
cte("edges", ("series",), """
  SELECT family, name, list_sort(list_distinct(quantile_cont(value, [0.0, 0.1, 0.2, 0.30000000000000004, 0.4, 0.5,
    0.6000000000000001, 0.7000000000000001, 0.8, 0.9, 1.0]))) AS e FROM series WHERE cohort = 'baseline' GROUP BY family, name""")
cte("psi_values", ("series", "edges"), """
  SELECT family, name, CASE WHEN bn < 2 OR cn < 2 THEN 'nan'::DOUBLE WHEN max(k) < 2 THEN 0
      ELSE sum((c/cn + 1e-6 - b/bn - 1e-6) * ln((c/cn + 1e-6) / (b/bn + 1e-6))) END AS psi
  FROM (SELECT family, name, k, bin, CAST(count(*) FILTER (cohort = 'baseline') AS DOUBLE) AS b,
      CAST(count(*) FILTER (cohort = 'current') AS DOUBLE) AS c,
      sum(count(*) FILTER (cohort = 'baseline')) OVER (PARTITION BY family, name) AS bn,
      sum(count(*) FILTER (cohort = 'current')) OVER (PARTITION BY family, name) AS cn
    FROM (SELECT *, len(e) AS k, len(list_filter(e[2:len(e)-1], lambda x: x <= value)) AS bin FROM series JOIN edges USING (family, name))
    GROUP BY family, name, k, bin)
  GROUP BY family, name, bn, cn""")
_EDGES = "[0.0, 0.1, 0.2, 0.30000000000000004, 0.4, 0.5, 0.6000000000000001, 0.7000000000000001, 0.8, 0.9, 1.0]"


def unit_bins(table: str, score: str, label: str) -> str:
    """Equal-width bins over [0, 1] with sums per bin."""
    return f"""
  SELECT CAST(g.bin AS INTEGER) AS bin, {_EDGES}[g.bin + 1] AS bin_lower, {_EDGES}[g.bin + 2] AS bin_upper,
    b.mean_pred, b.actual_rate, coalesce(b.n, 0) AS count
  FROM range(10) g(bin) LEFT JOIN (
    SELECT len(list_filter({_EDGES}[2:10], lambda x: x <= {score})) AS bin, avg({score}) AS mean_pred, avg({label}) AS actual_rate,
      count(*) AS n FROM {table} GROUP BY 1) b ON b.bin = g.bin"""


cte("calibration", ("cases",), unit_bins("cases", "churn_probability", "actual"))
cte("current_calibration", ("cohorts",), unit_bins("(SELECT * FROM cohorts WHERE cohort = 'current')", "score", "label"))
cte("facts", ("cohorts", "cohort_auc", "psi_values", "current_calibration"), """
  SELECT *, baseline_auc - current_auc AS auc_delta FROM (SELECT max(cohort_strategy) AS cohort_strategy,
    count(*) FILTER (cohort = 'baseline') AS baseline_row_count, count(*) FILTER (cohort = 'current') AS current_row_count,
    (SELECT roc_auc FROM cohort_auc WHERE cohort = 'baseline') AS baseline_auc,
    (SELECT roc_auc FROM cohort_auc WHERE cohort = 'current') AS current_auc,
    coalesce((SELECT max(psi) FROM psi_values WHERE family = 'feature' AND NOT isnan(psi)), 0) AS max_psi,
    avg((score - label) * (score - label)) FILTER (cohort = 'current') AS brier_score,
    (SELECT max(abs(mean_pred - actual_rate)) FROM current_calibration) AS max_calibration_error,
    coalesce((SELECT list(name ORDER BY name) FROM psi_values WHERE family = 'segment' AND NOT isnan(psi) AND psi > 0.2), []) AS breached_segments
  FROM cohorts)""")
cte("verdict", ("facts",), """
  SELECT *, CASE WHEN len(reasons) = 0 THEN NULL ELSE array_to_string(reasons, '; ') END AS breached_reasons,
    current_row_count >= 1000 AND len(reasons) > 0 AS breached,
    CASE WHEN current_row_count < 1000 THEN 'insufficient_data' WHEN len(reasons) > 0 THEN 'breached' ELSE 'ok' END AS status
  FROM (SELECT *, list_filter([
      CASE WHEN baseline_auc IS NULL THEN 'Insufficient baseline class coverage for AUC and no production baseline artifact found.' END,
      CASE WHEN current_auc IS NULL THEN 'Insufficient current class coverage for AUC (requires both churn/non-churn).' END,
      CASE WHEN max_psi > 0.2 THEN printf('PSI threshold breached: max_psi=%.4f (>0.2)', max_psi) END,
      CASE WHEN auc_delta > 0.05 THEN printf('AUC degradation threshold breached: delta=%.4f (>0.05)', auc_delta) END,
      CASE WHEN current_row_count < 1000 THEN printf('Insufficient labelled samples in current window: %d < 1000', current_row_count) END,
      CASE WHEN current_row_count >= 1000 AND max_calibration_error > 0.1
        THEN printf('Calibration error exceeds threshold: %.4f > 0.1', max_calibration_error) END,
      CASE WHEN current_row_count >= 1000 AND len(breached_segments) > 0
        THEN 'Segment PSI breached (0.2): ' || array_to_string(breached_segments, ', ') END], lambda x: x IS NOT NULL) AS reasons FROM facts)""")
cte("snapshots", ("predictions",), """
  SELECT 'snap-' || day AS snapshot_id, row_count, build_completed_at,
    CASE WHEN CAST(day AS INTEGER) % 4 = 0 THEN 'failed' ELSE 'completed' END AS status
  FROM (SELECT strftime(scored_at, '%Y%m%d') AS day, CAST(count(*) AS INTEGER) AS row_count, max(scored_at) AS build_completed_at
    FROM predictions GROUP BY 1)""")
cte("current_snapshot", ("snapshots",), """
  SELECT arg_max(snapshot_id, build_completed_at) AS snapshot_id FROM snapshots WHERE status = 'completed'""")
cte("daily_results", ("predictions",), """
  SELECT 'run-' || day AS run_id, CAST(day AS TIMESTAMP) AS created_at, r.rule_name, r.severity, r.status FROM (
    SELECT CAST(scored_at AS DATE) AS day, avg((risk_tier = 'High')::INT) AS high, avg((feature_snapshot_id IS NOT NULL)::INT) AS linked
    FROM predictions GROUP BY 1), LATERAL (SELECT unnest([
      {'rule_name': 'high_share', 'severity': 'blocking', 'status': CASE WHEN high <= 0.06 THEN 'pass' ELSE 'fail' END},
      {'rule_name': 'linked_share', 'severity': 'blocking', 'status': CASE WHEN linked >= 0.85 THEN 'pass' ELSE 'fail' END},
      {'rule_name': 'linked_warning', 'severity': 'warning', 'status': CASE WHEN linked >= 0.86 THEN 'pass' ELSE 'fail' END}]) AS r)""")
cte("version_metrics", ("cases",), """
  SELECT model_version, max(precision_churn) AS precision_churn,
    sum(CASE WHEN actual = 1 THEN below + ties/2.0 ELSE 0 END) / nullif(sum(actual) * sum(1 - actual), 0) AS roc_auc
  FROM (SELECT model_version, actual,
      coalesce(sum(CASE WHEN actual = 1 AND predicted = 1 THEN 1 ELSE 0 END) OVER (PARTITION BY model_version)
        / nullif(sum(predicted) OVER (PARTITION BY model_version), 0), 0) AS precision_churn,
      sum(1 - actual) OVER (PARTITION BY model_version ORDER BY churn_probability RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
        - sum(1 - actual) OVER (PARTITION BY model_version, churn_probability) AS below,
      sum(1 - actual) OVER (PARTITION BY model_version, churn_probability) AS ties FROM cases)
  GROUP BY model_version""")


def chosen(table: str, key: str, stratum: str, fraction: float, seed: int) -> str:
    """Rows of a table with ``picked``: round(fraction * n) of each stratum by seeded hash."""
    return f"""
  SELECT *, row_number() OVER (PARTITION BY {stratum} ORDER BY md5('{seed}:' || {key}), {key})
    <= round_even({fraction} * count(*) OVER (PARTITION BY {stratum}), 0) AS picked FROM {table}"""


cte("sampled", ("train",), chosen("train", "msno", "is_churn", 0.2, 42))


def content_hash(table: str, numbers: list[str], texts: list[str]) -> str:
    """Order-independent digest of number and text columns; an entry may be ``name=expression``."""
    parts = {}
    for entry in numbers:
        name, _, expression = entry.partition("=")
        parts[name] = f"coalesce(CAST({expression or name} AS VARCHAR), 'N')"
    for name in texts:
        parts[name] = f"coalesce(length({name}) || ':' || {name}, 'N')"
    row = ", ".join(parts[name] for name in sorted(parts))
    words = " || '|' || ".join(
        f"CAST(sum(CAST(CAST('0x' || substr(h, {1 + 15 * i}, 15) AS BIGINT) AS HUGEINT)) AS VARCHAR)" for i in range(4))
    return f"""
  SELECT count(*) AS row_count, sha256(count(*) || '|' || {words}) AS content_hash
  FROM (SELECT sha256(concat_ws('|', {row})) AS h FROM {table})"""

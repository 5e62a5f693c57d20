"""The SQL of each registered query, for DuckDB."""

from __future__ import annotations

from verification.oracle_base import content_hash, sql, unit_bins

ORACLES: dict[str, str] = {}

# The registry the lineage must have, stated here so that the check does not read it from the engine.
REGISTRY = [
    ("is_churn", "train_v2", "Direct copy of the churn target keyed by msno."),
    ("city", "members_v3", "Direct copy of city keyed by msno."),
    ("bd", "members_v3", "Direct copy of age (bd) keyed by msno; contains outliers and zeros."),
    ("gender", "members_v3", "Direct copy of gender keyed by msno; sparse with many NULLs."),
    ("registered_via", "members_v3", "Direct copy of registered_via (registration channel code) keyed by msno."),
    ("registration_init_time", "members_v3", "Direct copy of registration date as YYYYMMDD integer keyed by msno."),
    ("transaction_count", "transactions_v2", "COUNT(*) of transaction rows grouped by msno."),
    ("renewal_count", "transactions_v2", "SUM(CASE WHEN is_cancel = 0 THEN 1 ELSE 0 END) grouped by msno."),
    ("cancel_count", "transactions_v2", "SUM(is_cancel) grouped by msno."),
    ("total_amount_paid", "transactions_v2", "SUM(actual_amount_paid) grouped by msno."),
    ("avg_plan_days", "transactions_v2", "AVG(payment_plan_days) grouped by msno, rounded to 2 decimal places."),
    ("latest_payment_method_id", "transactions_v2", "payment_method_id from the most recent transaction row (by transaction_date) per msno."),
    ("latest_is_auto_renew", "transactions_v2", "is_auto_renew from the most recent transaction row (by transaction_date) per msno."),
    ("latest_membership_expire_date", "transactions_v2", "MAX(membership_expire_date) as YYYYMMDD integer per msno."),
    ("num_active_days", "user_logs_v2", "COUNT(DISTINCT date) grouped by msno."),
    ("total_secs", "user_logs_v2", "SUM(total_secs) grouped by msno."),
    ("avg_total_secs", "user_logs_v2", "AVG(total_secs) grouped by msno, rounded to 4 decimal places."),
    ("total_num_songs", "user_logs_v2", "SUM(num_25 + num_50 + num_75 + num_985 + num_100) grouped by msno."),
    ("avg_num_songs", "user_logs_v2", "AVG(num_25 + num_50 + num_75 + num_985 + num_100) grouped by msno, rounded to 4 decimal places."),
    ("total_num_unq", "user_logs_v2", "SUM(num_unq) grouped by msno."),
    ("avg_num_unq", "user_logs_v2", "AVG(num_unq) grouped by msno, rounded to 4 decimal places."),
    ("feature_created_at", "processed.customer_features", "Auto-populated by DEFAULT NOW() when row is inserted into processed.customer_features."),
]

ORACLES["customer_features"] = sql("customer_features", "SELECT * FROM customer_features")
ORACLES["transaction_features"] = sql("txn_agg", "SELECT * FROM txn_agg")
ORACLES["activity_features"] = sql("log_agg", "SELECT * FROM log_agg")
ORACLES["latest_transaction"] = sql("latest_txn", "SELECT * FROM latest_txn")
ORACLES["payment_method_recode"] = sql("recoded", "SELECT txn_id, payment_method_id FROM recoded")
ORACLES["age_cleaning"] = sql("clean_members", "SELECT msno, bd FROM clean_members")
_PARTS = ", ".join(
    f"{c}, CAST(year({c}) AS INTEGER) AS {c}_year, CAST(month({c}) AS INTEGER) AS {c}_month, "
    f"CAST(day({c}) AS INTEGER) AS {c}_day"
    for c in ("registration_init_time", "first_transaction_date", "last_transaction_date", "membership_expire_date")
)
ORACLES["date_parse_and_parts"] = sql("dated", f"SELECT msno, {_PARTS} FROM dated")
ORACLES["transaction_rollup"] = sql("rollup", "SELECT * FROM rollup")
ORACLES["training_table"] = sql("training", """
  SELECT * REPLACE (round(avg_plan_price, 6) AS avg_plan_price, round(avg_plan_days, 6) AS avg_plan_days) FROM training""")
ORACLES["rule_driven_members"] = sql("clean_members", """
  SELECT msno, city, bd, registered_via,
    CAST(strptime(CAST(registration_init_time AS VARCHAR), '%Y%m%d') AS DATE) AS registration_init_time FROM clean_members""")
ORACLES["rule_driven_train"] = sql("train", "SELECT * FROM train WHERE msno IS NOT NULL AND is_churn IS NOT NULL")
ORACLES["rule_driven_user_logs"] = sql("user_logs", """
  SELECT * REPLACE (CAST(strptime(CAST(date AS VARCHAR), '%Y%m%d') AS DATE) AS date, CAST(total_secs AS DOUBLE) AS total_secs,
    CAST(num_25 AS INTEGER) AS num_25, CAST(num_50 AS INTEGER) AS num_50, CAST(num_75 AS INTEGER) AS num_75, CAST(num_985 AS INTEGER) AS num_985,
    CAST(num_100 AS INTEGER) AS num_100, CAST(num_unq AS INTEGER) AS num_unq) FROM user_logs""")
ORACLES["rule_driven_transactions"] = sql("rollup", """
  SELECT * REPLACE (CAST(strptime(CAST(first_transaction_date AS VARCHAR), '%Y%m%d') AS DATE) AS first_transaction_date,
    CAST(strptime(CAST(last_transaction_date AS VARCHAR), '%Y%m%d') AS DATE) AS last_transaction_date,
    CAST(strptime(CAST(membership_expire_date AS VARCHAR), '%Y%m%d') AS DATE) AS membership_expire_date) FROM rollup""")


def _list(columns: str, prefix: str = "") -> str:
    return ", ".join(prefix + c for c in columns.split())


# Dashboard ---------------------------------------------------------------------------------------------------------

BUCKET = """CASE WHEN churn_probability < 0.1 THEN '0-10%' WHEN churn_probability < 0.2 THEN '10-20%'
  WHEN churn_probability < 0.3 THEN '20-30%' WHEN churn_probability < 0.4 THEN '30-40%'
  WHEN churn_probability < 0.5 THEN '40-50%' WHEN churn_probability < 0.6 THEN '50-60%'
  WHEN churn_probability < 0.7 THEN '60-70%' WHEN churn_probability < 0.8 THEN '70-80%'
  WHEN churn_probability < 0.9 THEN '80-90%' ELSE '90-100%' END"""
PAYMENT = "CASE WHEN latest_is_auto_renew = 1 THEN 'Auto-Renew' ELSE 'Manual' END"
CANCELS = "CASE WHEN cancel_count = 0 THEN 'Never Cancelled' WHEN cancel_count = 1 THEN '1 Cancellation' ELSE '2+ Cancellations' END"
USAGE = "CASE WHEN num_active_days < 30 THEN 'Light (<30 days)' WHEN num_active_days < 90 THEN 'Moderate (30-90 days)' ELSE 'Heavy (90+ days)' END"
TENURE = "CASE WHEN transaction_count <= 3 THEN 'New (<=3 txns)' WHEN transaction_count <= 10 THEN 'Developing (4-10 txns)' ELSE 'Established (11+ txns)' END"
AGE = """CASE WHEN bd BETWEEN 18 AND 24 THEN '18-24' WHEN bd BETWEEN 25 AND 34 THEN '25-34' WHEN bd BETWEEN 35 AND 44 THEN '35-44'
  WHEN bd BETWEEN 45 AND 54 THEN '45-54' WHEN bd >= 55 THEN '55+' ELSE 'Unknown' END"""

ORACLES["latest_prediction"] = sql("latest", "SELECT * FROM latest")
ORACLES["risk_tier_labels"] = sql("predictions", f"""
  SELECT pred_id, risk_tier, {BUCKET} AS bucket, threshold_version FROM predictions""")
ORACLES["segment_labels"] = sql("customer_features", f"""
  SELECT msno, {PAYMENT} AS payment_behavior, {CANCELS} AS cancel_history, {USAGE} AS usage_intensity, {TENURE} AS tenure,
    CASE WHEN coalesce(cancel_count, 0) > 0 THEN 1 ELSE 0 END AS has_cancel_history, {AGE} AS age_band FROM customer_features""")
ORACLES["lenient_numbers"] = """
  SELECT o_orderkey, TRY_CAST(o_orderpriority AS DOUBLE) AS whole, TRY_CAST(substr(o_orderpriority, 1, 1) AS DOUBLE) AS lead FROM orders"""
ORACLES["lenient_dates"] = """
  SELECT o_orderkey, CAST(try_strptime(CAST(o_orderkey % 13 * 100 + o_orderkey % 32 + 20000000 AS VARCHAR), '%Y%m%d') AS DATE) AS day
  FROM orders"""
ORACLES["portfolio_counts"] = sql("latest", """
  SELECT count(*) AS total_scored, count(*) FILTER (risk_tier = 'High') AS high_count,
    count(*) FILTER (risk_tier = 'Medium') AS medium_count, count(*) FILTER (risk_tier = 'Low') AS low_count,
    max(scored_at) AS latest_scored_at FROM latest""")
ORACLES["score_buckets"] = sql("latest", f"""
  SELECT b.bucket, coalesce(c.n, 0) AS count,
    CAST(round_even(100.0 * coalesce(c.n, 0) / max(coalesce(c.n, 0)) OVER (), 0) AS INTEGER) AS pct
  FROM (SELECT unnest(['0-10%','10-20%','20-30%','30-40%','40-50%','50-60%','60-70%','70-80%','80-90%','90-100%']) AS bucket) b
  LEFT JOIN (SELECT {BUCKET} AS bucket, count(*) AS n FROM latest GROUP BY 1) c USING (bucket)""")
_SEGMENT = """SELECT '{kind}' AS segment_type, {name} AS segment_name, count(*) AS total,
    count(*) FILTER (risk_tier = 'High') AS high_count,
    CAST((2*sum(CAST(round(churn_probability*10000) AS BIGINT)) + count(*)) // (2*count(*)) AS DOUBLE) / 10000 AS avg_churn_prob
  FROM latest JOIN customer_features ON msno = customer_id GROUP BY {group}"""
ORACLES["segment_breakdown"] = sql("latest customer_features", " UNION ALL ".join([
    _SEGMENT.format(kind="payment_behavior", name=PAYMENT, group="latest_is_auto_renew"),
    _SEGMENT.format(kind="cancel_history", name=CANCELS, group=CANCELS),
    _SEGMENT.format(kind="usage_intensity", name=USAGE, group=USAGE),
    _SEGMENT.format(kind="tenure", name=TENURE, group=TENURE),
]))
_ENRICHED = """
  SELECT *, CASE WHEN risk_tier = 'High' AND customer_segment IN ('Payment Friction','Low Engagement') THEN 'Urgent'
      WHEN risk_tier = 'High' THEN 'High' WHEN risk_tier = 'Medium' THEN 'Medium' ELSE 'Low' END AS intervention_priority,
    CASE WHEN risk_tier = 'High' AND customer_segment = 'Low Engagement' THEN 'Send re-engagement campaign'
      WHEN risk_tier = 'High' AND customer_segment = 'Payment Friction' THEN 'Escalate to retention team'
      WHEN risk_tier = 'Medium' THEN 'Send targeted reminder or lightweight incentive'
      ELSE 'No immediate action; monitor only' END AS recommended_action,
    ['Membership timing indicates upcoming renewal risk.', 'Plan duration patterns look less sticky than healthier subscribers.',
     'Unlisted feature is contributing to this customer''s churn risk.'] AS business_explanations
  FROM (SELECT *, CASE WHEN coalesce(cancel_count, 0) > 0 OR latest_is_auto_renew = 0 THEN 'Payment Friction'
      WHEN num_active_days < 10 OR avg_total_secs < 900 THEN 'Low Engagement'
      WHEN risk_tier = 'Low' THEN 'Stable' ELSE 'General' END AS customer_segment
    FROM {rows} LEFT JOIN customer_features ON msno = customer_id)"""
_CARD = """customer_id, churn_probability, risk_tier, scored_at, customer_segment, intervention_priority, recommended_action,
  business_explanations"""
_CARD_FEATURES = "transaction_count, cancel_count, num_active_days, avg_total_secs, avg_plan_days, latest_is_auto_renew"
ORACLES["retention_queue"] = sql("latest customer_features", f"""
  SELECT rank, {_CARD} FROM ({_ENRICHED.format(rows='''(SELECT *, row_number() OVER (
      ORDER BY churn_probability DESC, customer_id) AS rank FROM latest QUALIFY rank <= 50)''')})""".replace(
    "SELECT rank", "SELECT CAST(rank AS INTEGER) AS rank"))
ORACLES["retention_queue_filtered"] = sql("latest customer_features", f"""
  SELECT {_CARD} FROM ({_ENRICHED.format(rows='''(SELECT * FROM latest WHERE risk_tier = 'Medium' QUALIFY row_number() OVER (
      ORDER BY churn_probability DESC, customer_id) <= 50)''')}) WHERE customer_segment = 'Low Engagement'""")
ORACLES["queue_summary"] = sql("latest", """
  SELECT count(*) AS total_customers, count(*) FILTER (risk_tier = 'High') AS high_risk_count,
    count(*) FILTER (risk_tier = 'Medium') AS medium_risk_count, round(coalesce(avg(churn_probability), 0), 6) AS avg_churn_probability
  FROM (SELECT * FROM latest ORDER BY churn_probability DESC, customer_id LIMIT 50)""")
ORACLES["customer_cards"] = sql("latest customer_features", f"SELECT {_CARD}, {_CARD_FEATURES} FROM ({_ENRICHED.format(rows='latest')})")
ORACLES["customer_card"] = sql("latest customer_features predictions", f"""
  SELECT {_CARD}, {_CARD_FEATURES} FROM ({_ENRICHED.format(rows='latest')})
  WHERE customer_id = (SELECT arg_max(customer_id, pred_id) FROM predictions)""")
_MODEL = """city, bd, gender, registered_via, registration_init_time, transaction_count, renewal_count, cancel_count,
  total_amount_paid, avg_plan_days, latest_payment_method_id, latest_is_auto_renew, latest_membership_expire_date,
  num_active_days, total_secs, avg_total_secs, total_num_songs, avg_num_songs, total_num_unq, avg_num_unq"""
ORACLES["attribution_input"] = sql("latest customer_features", f"""
  SELECT customer_id, churn_probability, risk_tier, scored_at, {_MODEL} FROM latest JOIN customer_features ON msno = customer_id""")
ORACLES["tier_sample_customers"] = sql("latest", """
  SELECT lower(risk_tier) AS tier, customer_id, churn_probability FROM (
    SELECT *, CASE risk_tier WHEN 'High' THEN -churn_probability WHEN 'Low' THEN churn_probability
        ELSE round(abs(churn_probability - quantile_cont(churn_probability, 0.5) OVER (PARTITION BY risk_tier)), 9) END AS d FROM latest)
  QUALIFY row_number() OVER (PARTITION BY risk_tier ORDER BY d, customer_id) = 1""")

# Exploration -------------------------------------------------------------------------------------------------------

ORACLES["churn_rate"] = sql("training", "SELECT round(avg(is_churn), 6) AS churn_rate FROM training")
for _name, _dim in (("city", "city"), ("plan_days", "round(avg_plan_days, 6)"), ("payment_method", "payment_method_id")):
    _alias = {"city": "city", "plan_days": "avg_plan_days", "payment_method": "payment_method_id"}[_name]
    ORACLES[f"churn_rate_by_{_name}"] = sql("training", f"""
      SELECT {_dim} AS {_alias}, round(avg(is_churn), 6) AS churn_rate FROM training WHERE {_dim} IS NOT NULL GROUP BY 1""")


def _counts(table: str, column: str, extra: str = "") -> str:
    return (f"SELECT {extra}'{column}' AS \"column\", CAST({column} AS VARCHAR) AS value, count(*) AS count FROM {table} "
            f"WHERE {column} IS NOT NULL GROUP BY {column}")


ORACLES["value_counts_members"] = sql("members", " UNION ALL ".join(
    _counts("members", c) for c in ("city", "gender", "registered_via")))
ORACLES["value_counts_payments"] = sql("transactions recoded", " UNION ALL ".join([
    _counts("transactions", "payment_method_id", "'before' AS stage, "), _counts("transactions", "is_auto_renew", "'before' AS stage, "),
    _counts("recoded", "payment_method_id", "'after' AS stage, ")]))
ORACLES["label_counts"] = sql("train", _counts("train", "is_churn"))
_HIST = """SELECT '{c}' AS "column", CAST(g.bin AS INTEGER) AS bin, round(low + g.bin*(span/30), 6) AS bin_lower,
    round(low + (g.bin + 1)*(span/30), 6) AS bin_upper,
    (SELECT count(*) FROM transactions t WHERE least(CAST(floor((CAST(t.{c} AS DOUBLE) - low) / (span/30)) AS INTEGER), 29) = g.bin) AS count
  FROM (SELECT CAST(min({c}) AS DOUBLE) AS low, CAST(max({c}) - min({c}) AS DOUBLE) AS span FROM transactions), range(30) g(bin)"""
ORACLES["histograms"] = sql("transactions", " UNION ALL ".join(
    _HIST.format(c=c) for c in ("payment_plan_days", "plan_list_price", "actual_amount_paid")))
_BOX = """SELECT '{stage}' AS stage, '{c}' AS "column", q1, median, q3,
    min({c}) FILTER ({c} BETWEEN q1 - 1.5*(q3-q1) AND q3 + 1.5*(q3-q1)) AS whisker_low,
    max({c}) FILTER ({c} BETWEEN q1 - 1.5*(q3-q1) AND q3 + 1.5*(q3-q1)) AS whisker_high,
    count(*) FILTER (NOT {c} BETWEEN q1 - 1.5*(q3-q1) AND q3 + 1.5*(q3-q1)) AS outliers
  FROM (SELECT CAST({c} AS DOUBLE) AS {c} FROM {t}), (SELECT quantile_cont(CAST({c} AS DOUBLE), 0.25) AS q1,
    quantile_cont(CAST({c} AS DOUBLE), 0.5) AS median, quantile_cont(CAST({c} AS DOUBLE), 0.75) AS q3 FROM {t}) GROUP BY q1, median, q3"""
ORACLES["box_statistics"] = sql("members clean_members transactions", " UNION ALL ".join([
    _BOX.format(stage="before", c="bd", t="members"), _BOX.format(stage="after", c="bd", t="clean_members"),
    _BOX.format(stage="raw", c="plan_list_price", t="transactions")]))
_TRAINING_NUMERIC = """city bd registered_via payment_method_id last_plan_days last_plan_price is_auto_renewal is_cancel
  no_of_transactions membership_duration_days transaction_span_days avg_plan_price avg_plan_days amount_due"""
ORACLES["variance_ranking"] = sql("training", "SELECT CAST(row_number() OVER (ORDER BY variance DESC) AS INTEGER) AS rank, \"column\", round(variance, 2) AS variance FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", var_samp({c}) AS variance FROM training" for c in _TRAINING_NUMERIC.split()) + ") ORDER BY variance DESC LIMIT 10")
_CORRELATED = ("bd last_plan_days last_plan_price no_of_transactions membership_duration_days transaction_span_days "
               "avg_plan_price avg_plan_days amount_due").split()
ORACLES["correlation_matrix"] = sql("training", " UNION ALL ".join(
    f"SELECT '{a}' AS column_a, '{b}' AS column_b, round(corr({a}, {b}), 6) AS correlation FROM training"
    for a in _CORRELATED for b in _CORRELATED))
_FEATURES = ["msno", "is_churn", *[c.strip() for c in _MODEL.replace("\n", " ").split(",")]]
ORACLES["null_counts"] = sql("customer_features", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS nulls FROM customer_features" for c in _FEATURES))
ORACLES["duplicate_rows"] = sql("transactions", "SELECT count(*) AS rows, count(*) - count(DISTINCT msno) AS duplicate_rows FROM transactions")
ORACLES["describe"] = sql("transactions", " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count({c}) AS count, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std,
      CAST(min({c}) AS DOUBLE) AS min, quantile_cont(CAST({c} AS DOUBLE), 0.25) AS p25, quantile_cont(CAST({c} AS DOUBLE), 0.5) AS p50,
      quantile_cont(CAST({c} AS DOUBLE), 0.75) AS p75, CAST(max({c}) AS DOUBLE) AS max FROM transactions"""
    for c in ("payment_plan_days", "plan_list_price", "actual_amount_paid", "transaction_date")))


def _percent(part: str, digits: int) -> str:
    scale = 100 * 10 ** digits
    return f"CAST((2*{scale}*{part} + count(*)) // (2*count(*)) AS DOUBLE) / {10 ** digits}"


ORACLES["coverage"] = sql("customer_features train", f"""
  SELECT {_percent('count(city)', 1)} AS pct_demographics, {_percent('count(transaction_count)', 1)} AS pct_transactions,
    {_percent('count(num_active_days)', 1)} AS pct_user_logs, {_percent('sum(is_churn)', 2)} AS features_churn_rate,
    count(*) AS feature_rows, (SELECT {_percent('sum(is_churn)', 2)} FROM train) AS raw_churn_rate FROM customer_features""")

# Labelled cases ----------------------------------------------------------------------------------------------------

ORACLES["prediction_cases"] = sql("cases", "SELECT pred_id, customer_id, actual, predicted, is_misclassified, error_type FROM cases")
_CONFUSION = """count(*) FILTER (actual = 0 AND predicted = 0) AS tn, count(*) FILTER (actual = 0 AND predicted = 1) AS fp,
    count(*) FILTER (actual = 1 AND predicted = 0) AS fn, count(*) FILTER (actual = 1 AND predicted = 1) AS tp"""
ORACLES["confusion_counts"] = sql("cases", f"SELECT {_CONFUSION} FROM cases")
_AUC = """SELECT sum(CASE WHEN actual = 1 THEN below + ties/2.0 ELSE 0 END) / (sum(actual) * sum(1 - actual)) FROM (SELECT actual,
      sum(1 - actual) OVER (ORDER BY churn_probability RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
        - sum(1 - actual) OVER (PARTITION BY churn_probability) AS below,
      sum(1 - actual) OVER (PARTITION BY churn_probability) AS ties FROM cases)"""
ORACLES["classification_metrics"] = sql("cases", f"""
  SELECT round(coalesce(tp / nullif(tp + fp, 0), 0), 6) AS precision_churn, round(coalesce(tp / nullif(tp + fn, 0), 0), 6) AS recall_churn,
    round(coalesce(2*tp / nullif(2*tp + fp + fn, 0), 0), 6) AS f1_churn, tp + fn AS support_churn, round(({_AUC}), 6) AS roc_auc
  FROM (SELECT {_CONFUSION} FROM cases)""")
ORACLES["class_weights"] = sql("train", """
  SELECT is_churn AS label, count(*) AS n, round((SELECT count(*) FROM train) / ((SELECT count(DISTINCT is_churn) FROM train) * count(*)), 6) AS weight,
    round((SELECT count(*) FILTER (is_churn = 0) / greatest(count(*) FILTER (is_churn = 1), 1) FROM train), 6) AS pos_weight
  FROM train GROUP BY is_churn""")
_PROFILED = "bd transaction_count total_amount_paid avg_plan_days num_active_days avg_total_secs".split()
_NUMERIC_PROFILE = "SELECT * FROM (" + " UNION ALL ".join(f"""SELECT '{c}' AS feature,
    avg({c}) FILTER (is_misclassified = 1) AS misclassified_mean, avg({c}) FILTER (is_misclassified = 0) AS correct_mean,
    quantile_cont(CAST({c} AS DOUBLE), 0.5) FILTER (is_misclassified = 1) AS misclassified_median,
    quantile_cont(CAST({c} AS DOUBLE), 0.5) FILTER (is_misclassified = 0) AS correct_median,
    count({c}) FILTER (is_misclassified = 1) AS n1, count({c}) FILTER (is_misclassified = 0) AS n0,
    sqrt((var_samp({c}) FILTER (is_misclassified = 1) + var_samp({c}) FILTER (is_misclassified = 0)) / 2) AS pooled
  FROM cases""" for c in _PROFILED) + ") WHERE n1 > 0 AND n0 > 0"
_NUMERIC_RANKED = f"""SELECT *, row_number() OVER (ORDER BY abs(std_mean_diff) DESC, feature) AS rank FROM (
    SELECT *, CASE WHEN n1 > 1 AND n0 > 1 AND pooled > 0 THEN (misclassified_mean - correct_mean) / pooled ELSE 0 END AS std_mean_diff
    FROM ({_NUMERIC_PROFILE}))"""
ORACLES["numeric_error_profile"] = sql("cases", f"""
  SELECT feature, round(misclassified_mean, 6) AS misclassified_mean, round(correct_mean, 6) AS correct_mean,
    round(misclassified_median, 6) AS misclassified_median, round(correct_median, 6) AS correct_median,
    round(std_mean_diff, 6) AS std_mean_diff, CAST(rank AS INTEGER) AS rank FROM ({_NUMERIC_RANKED})""")


def _categorical(columns: str) -> str:
    long = " UNION ALL ".join(
        f"SELECT '{c}' AS feature, coalesce(CAST({c} AS VARCHAR), 'nan') AS category, is_misclassified FROM cases" for c in columns.split())
    return f"""SELECT feature, category, w/wt AS misclassified_share, c/ct AS correct_share, w/wt - c/ct AS share_diff,
        CASE WHEN c > 0 THEN (w/wt) / (c/ct) END AS lift
      FROM (SELECT feature, category, count(*) FILTER (is_misclassified = 1) AS w, count(*) FILTER (is_misclassified = 0) AS c,
          (SELECT count(*) FROM cases WHERE is_misclassified = 1) AS wt, (SELECT count(*) FROM cases WHERE is_misclassified = 0) AS ct
        FROM ({long}) GROUP BY feature, category) WHERE wt > 0 AND ct > 0
      QUALIFY row_number() OVER (PARTITION BY feature ORDER BY round(abs(w/wt - c/ct), 12) DESC, category) = 1"""


ORACLES["categorical_error_profile"] = sql("cases", f"""
  SELECT feature, category, round(misclassified_share, 6) AS misclassified_share, round(correct_share, 6) AS correct_share,
    round(share_diff, 6) AS share_diff, round(lift, 6) AS lift FROM ({_categorical('city gender registered_via latest_payment_method_id')})""")
ORACLES["error_insights"] = sql("cases", f"""
  SELECT CAST(rank AS INTEGER) AS position, printf('`%s` is materially %s among misclassified cases (misclassified mean=%.2f, correct mean=%.2f). Action: add bucketized/interaction features for `%s` and re-tune threshold.',
      feature, CASE WHEN misclassified_mean > correct_mean THEN 'higher' ELSE 'lower' END, misclassified_mean, correct_mean, feature) AS insight
    FROM ({_NUMERIC_RANKED}) WHERE rank <= 2
  UNION ALL SELECT 3, printf('Category `%s=%s` is over-represented in misclassifications (misclassified share=%.1f%%, correct share=%.1f%%). Action: introduce category-target interactions or category-specific calibration.',
      feature, category, misclassified_share*100, correct_share*100)
    FROM (SELECT * FROM ({_categorical('city gender')}) ORDER BY abs(share_diff) DESC, feature LIMIT 1)
  UNION ALL SELECT 4, CASE WHEN fn > fp THEN 'False negatives exceed false positives. Action: lower decision threshold to catch more true churners and monitor precision trade-off.'
      ELSE 'False positives are at least as frequent as false negatives. Action: increase decision threshold or add precision-oriented features to reduce false alarms.' END
    FROM (SELECT {_CONFUSION} FROM cases)""")
_FAIR = """SELECT {group} AS {name}, count(*) AS sample_size, round(avg(is_churn), 6) AS churn_rate,
    round(avg(predicted), 6) AS predicted_churn_rate FROM cases GROUP BY 1"""
_GENDER = "coalesce(nullif(gender, ''), 'Unknown')"
ORACLES["fairness_by_gender"] = sql("cases", _FAIR.format(group=_GENDER, name="gender").replace("GROUP BY 1", f"GROUP BY {_GENDER}"))
ORACLES["fairness_by_age_band"] = sql("cases", _FAIR.format(group=AGE, name="age_band"))
ORACLES["fairness_gaps"] = sql("cases", f"""
  SELECT 'gender' AS "group", round(max(r) - min(r), 6) AS fairness_gap FROM (SELECT avg(is_churn) AS r FROM cases GROUP BY {_GENDER})
  UNION ALL SELECT 'age_band', round(max(r) - min(r), 6) FROM (SELECT avg(is_churn) AS r FROM cases GROUP BY {AGE})""")
ORACLES["training_date_range"] = sql("predictions", """
  SELECT min(CAST(scored_at AS DATE)) AS first_day, max(CAST(scored_at AS DATE)) AS last_day FROM predictions""")

# Sampling ----------------------------------------------------------------------------------------------------------

ORACLES["stratified_sample"] = sql("sampled", "SELECT msno, is_churn FROM sampled WHERE picked")
ORACLES["sampled_transactions"] = sql("sampled transactions", """
  SELECT txn_id, msno FROM transactions WHERE msno IN (SELECT msno FROM sampled WHERE picked)""")
ORACLES["train_validation_split"] = sql("sampled", """
  SELECT msno, is_churn, CASE WHEN picked THEN 'validation' ELSE 'train' END AS split FROM sampled""")
ORACLES["hash_cohorts"] = sql("predictions", """
  SELECT pred_id, CAST(b AS INTEGER) AS bucket, CASE WHEN b < 70 THEN 'baseline' ELSE 'current' END AS cohort
  FROM (SELECT pred_id, CAST(('0x' || substr(md5(customer_id), 1, 8)) AS BIGINT) % 100 AS b FROM predictions)""")
ORACLES["monitoring_cohorts"] = sql("cohorts", "SELECT pred_id, msno, cohort, cohort_strategy FROM cohorts")

# Monitoring --------------------------------------------------------------------------------------------------------

ORACLES["labelled_predictions"] = sql("labelled", "SELECT * FROM labelled")
ORACLES["roc_auc_by_cohort"] = sql("cohort_auc", "SELECT cohort, positives, negatives, round(roc_auc, 6) AS roc_auc FROM cohort_auc")
ORACLES["roc_points"] = sql("cases", """
  SELECT churn_probability AS threshold, true_positives, false_positives,
    round(true_positives / (SELECT sum(actual) FROM cases), 6) AS tpr, round(false_positives / (SELECT sum(1 - actual) FROM cases), 6) AS fpr
  FROM (SELECT DISTINCT churn_probability, CAST(sum(actual) OVER w AS BIGINT) AS true_positives,
      CAST(sum(1 - actual) OVER w AS BIGINT) AS false_positives
    FROM cases WINDOW w AS (ORDER BY churn_probability DESC RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))""")
ORACLES["calibration_bins"] = sql("calibration", """
  SELECT bin, round(CAST(bin_lower AS DOUBLE), 6) AS bin_lower, round(CAST(bin_upper AS DOUBLE), 6) AS bin_upper,
    round(mean_pred, 6) AS mean_pred, round(actual_rate, 6) AS actual_rate, count FROM calibration""")
ORACLES["max_calibration_error"] = sql("calibration", """
  SELECT round(coalesce(max(abs(mean_pred - actual_rate)), 0), 6) AS max_calibration_error FROM calibration""")
ORACLES["brier_score"] = sql("cases", """
  SELECT round(avg((churn_probability - actual) * (churn_probability - actual)), 6) AS brier_score FROM cases""")
ORACLES["score_distribution"] = sql("predictions", f"""
  SELECT bin, round(CAST(bin_lower AS DOUBLE), 6) AS bin_lower, round(CAST(bin_upper AS DOUBLE), 6) AS bin_upper, count,
    round(count / (SELECT count(*) FROM predictions), 6) AS pct
  FROM ({unit_bins('predictions', 'churn_probability', '0')})""")
ORACLES["feature_psi"] = sql("psi_values", "SELECT name AS feature, round(psi, 6) AS psi FROM psi_values WHERE family = 'feature'")
ORACLES["segment_psi"] = sql("psi_values", "SELECT name AS segment, round(psi, 6) AS psi FROM psi_values WHERE family = 'segment'")
ORACLES["max_feature_psi"] = sql("psi_values", """
  SELECT round(coalesce(max(psi) FILTER (NOT isnan(psi)), 0), 6) AS max_psi FROM psi_values WHERE family = 'feature'""")
ORACLES["breached_segments"] = sql("psi_values", """
  SELECT coalesce(list(name ORDER BY name) FILTER (NOT isnan(psi) AND psi > 0.01), []) AS breached_segments FROM psi_values WHERE family = 'segment'""")
ORACLES["sample_guard"] = sql("cohorts", """
  SELECT count(*) FILTER (cohort = 'current') AS current_rows, count(*) FILTER (cohort = 'current') < 1000 AS insufficient FROM cohorts""")
ORACLES["score_psi"] = sql("psi_values", "SELECT round(psi, 6) AS psi FROM psi_values WHERE family = 'score'")
ORACLES["monitoring_verdict"] = sql("verdict", """
  SELECT round(baseline_auc, 6) AS baseline_auc, 'historical_baseline_window' AS baseline_auc_source, round(current_auc, 6) AS current_auc,
    round(auc_delta, 6) AS auc_delta, round(max_psi, 6) AS max_psi, breached, breached_reasons, cohort_strategy, baseline_row_count,
    current_row_count, status, round(brier_score, 6) AS brier_score, round(max_calibration_error, 6) AS max_calibration_error,
    breached_segments, 1000 AS min_sample_threshold, 10 AS bins FROM verdict""")
ORACLES["retrain_decision"] = sql("verdict", """
  SELECT status, round(max_psi, 6) AS max_psi, round(auc_delta, 6) AS auc_delta, retrain AS should_retrain,
    CASE WHEN retrain THEN 'retrain_if_needed' ELSE 'skip_retraining' END AS decision,
    CASE WHEN status = 'insufficient_data' THEN 'insufficient_labeled_samples' WHEN retrain THEN 'drift_or_degradation'
      ELSE 'within_thresholds' END AS reason
  FROM (SELECT *, status <> 'insufficient_data' AND (max_psi > 0.2 OR coalesce(auc_delta > 0.05, false)) AS retrain FROM verdict)""")
ORACLES["monitoring_status"] = sql("verdict", """
  SELECT TIMESTAMP '2024-01-31' AS monitored_at, round(baseline_auc, 6) AS baseline_auc, round(current_auc, 6) AS current_auc,
    round(auc_delta, 6) AS auc_delta, round(max_psi, 6) AS max_psi, breached, breached_reasons, baseline_row_count, current_row_count
  FROM verdict""")

# Quality rules -----------------------------------------------------------------------------------------------------


def _verdict(condition: str) -> str:
    return f"CASE WHEN {condition} THEN 'pass' ELSE 'fail' END"


_CF = "processed.customer_features"
_RULES = [
    (f"schema::{_CF}", "blocking", "SELECT 'pass'"),
    ("schema::processed.churn_predictions", "blocking", "SELECT 'pass'"),
    ("schema::processed.feature_snapshots", "warning", "SELECT 'pass'"),
    ("freshness::raw.members", "warning", f"SELECT {_verdict('count(*) > 0')} FROM members"),
    ("freshness::raw.transactions", "warning", f"SELECT {_verdict('count(*) > 0')} FROM transactions"),
    ("freshness::raw.user_logs", "warning", "SELECT " + _verdict("epoch(TIMESTAMP '2024-01-31') - epoch(max(ts)) <= 168*3600") + " FROM events"),
    ("freshness::raw.train", "warning", f"SELECT {_verdict('count(*) > 0')} FROM train"),
    *[(f"coverage::{_CF}::{c}", s, f"SELECT {_verdict(f'count({c}) >= {m} * count(*)')} FROM customer_features") for c, m, s in (
        ("msno", 1.0, "blocking"), ("is_churn", 1.0, "blocking"), ("transaction_count", 0.95, "blocking"),
        ("total_amount_paid", 0.85, "warning"), ("latest_payment_method_id", 0.85, "warning"), ("num_active_days", 0.5, "warning"))],
    *[(f"distribution::{_CF}::{c}", "warning", "SELECT 'pass'") for c in ("transaction_count", "total_amount_paid", "num_active_days", "total_secs")],
    ("row_count_positive", "blocking", f"SELECT {_verdict('count(*) > 0')} FROM customer_features"),
    ("row_count_matches_train", "blocking", f"SELECT {_verdict('count(*) = (SELECT count(*) FROM train)')} FROM customer_features"),
    ("is_churn_binary", "blocking", f"SELECT {_verdict('bool_and(is_churn IN (0, 1))')} FROM customer_features"),
    ("no_duplicate_msno", "blocking", f"SELECT {_verdict('count(*) = count(DISTINCT msno)')} FROM customer_features"),
    ("bd_in_plausible_range", "warning", f"SELECT {_verdict('count(*) FILTER (bd < 0 OR bd > 100) = 0')} FROM customer_features"),
    ("total_amount_paid_non_negative", "blocking", f"SELECT {_verdict('count(*) FILTER (total_amount_paid < 0) = 0')} FROM customer_features"),
]
_RULE_ROWS = " UNION ALL ".join(
    f"SELECT {i} AS position, '{n}' AS rule_name, '{s}' AS severity, ({q}) AS status" for i, (n, s, q) in enumerate(_RULES))
_VERDICT = """SELECT count(*) AS rules, count(*) FILTER (status <> 'fail') AS ok,
    count(*) FILTER (status = 'fail' AND severity = 'warning') AS warning_failures,
    count(*) FILTER (status = 'fail' AND severity = 'blocking') AS blocking_failures,
    count(*) FILTER (status = 'fail' AND severity = 'blocking') > 0 AS failing FROM """
ORACLES["quality_rule_set"] = sql("customer_features transactions", _RULE_ROWS)
ORACLES["quality_verdict"] = sql("customer_features transactions", f"{_VERDICT} ({_RULE_ROWS})")
ORACLES["freshness_rules"] = sql("predictions", """
  SELECT CAST(i AS INTEGER) AS position, 'freshness::predictions' AS rule_name, 'warning' AS severity,
    CASE WHEN age <= hours THEN 'pass' ELSE 'fail' END AS status, round_even(age, 4) AS age_hours, CAST(n AS DOUBLE) AS row_count
  FROM (SELECT (epoch_us(TIMESTAMP '2024-01-31') - epoch_us(max(scored_at))) / 3600000000 AS age, count(*) AS n FROM predictions),
    (VALUES (0, 24), (1, 48), (2, 0.5)) l(i, hours)""")
ORACLES["coverage_rules"] = sql("customer_features", " UNION ALL ".join(
    f"""SELECT 'coverage::features::{c}' AS rule_name, {_verdict(f'count({c}) / count(*) >= 0.88')} AS status,
      round_even(count({c}) / count(*), 6) AS non_null_ratio, CAST(count({c}) AS DOUBLE) AS non_null_count FROM customer_features"""
    for c in ("msno", "city", "gender", "transaction_count", "num_active_days")))
_SMOKE = [
    ("rows", "blocking", "count(*) > 0", "count(*)", "transactions"),
    ("match", "blocking", "count(*) = (SELECT count(*) FROM train)", "count(*)", "members"),
    ("channel", "blocking", "bool_and(registered_via IN (3,4,7,9))", "count(*) FILTER (registered_via NOT IN (3,4,7,9))", "members"),
    ("gender", "blocking", "bool_and(gender IS NOT NULL)", "count(*) FILTER (gender IS NULL)", "members"),
    ("unique_member", "blocking", "count(*) = count(DISTINCT msno)", "count(*) - count(DISTINCT msno)", "members"),
    ("unique_payer", "blocking", "count(*) = count(DISTINCT msno)",
     "(SELECT count(*) FROM (SELECT msno FROM transactions GROUP BY msno HAVING count(*) > 1))", "transactions"),
    ("age", "blocking", "bool_and(bd BETWEEN 18 AND 90)", "count(*) FILTER (bd < 18 OR bd > 90)", "members"),
    ("paid", "blocking", "bool_and(actual_amount_paid >= 0)", "count(*) FILTER (actual_amount_paid < 0)", "transactions"),
]
ORACLES["smoke_rules"] = sql("transactions members train", " UNION ALL ".join([
    f"SELECT {i} AS position, '{n}' AS rule_name, '{s}' AS severity, {_verdict(c)} AS status, CAST({o} AS BIGINT) AS observed FROM {t}"
    for i, (n, s, c, o, t) in enumerate(_SMOKE)] + ["SELECT 8, 'odd', 'warning', 'fail', NULL"]))
ORACLES["distribution_rules"] = sql("user_logs", " UNION ALL ".join(
    f"""SELECT 'distribution::logs::{c}' AS rule_name, CASE WHEN d <= 0.01 THEN 'pass' ELSE 'fail' END AS status, round(m2, 6) AS mean,
      round(s2, 6) AS std, CAST(n2 AS DOUBLE) AS n, round_even(d, 6) AS deviation
    FROM (SELECT *, abs(m2 - m1) / CASE WHEN s1 > 1e-9 THEN s1 ELSE greatest(abs(m1), 1e-9) END AS d FROM (
      SELECT avg({c}) FILTER (date <= 20240115) AS m1, stddev_pop({c}) FILTER (date <= 20240115) AS s1,
        avg({c}) FILTER (date > 20240115) AS m2, stddev_pop({c}) FILTER (date > 20240115) AS s2,
        count({c}) FILTER (date > 20240115) AS n2 FROM user_logs))""" for c in ("total_secs", "num_unq", "num_100")))
ORACLES["newest_run_results"] = sql("daily_results", """
  SELECT * FROM daily_results WHERE run_id = (SELECT arg_max(run_id, created_at) FROM daily_results)""")
ORACLES["blocking_failure_history"] = sql("daily_results", """
  SELECT rule_name, max(created_at) AS last_failed_at FROM daily_results WHERE severity = 'blocking' AND status = 'fail' GROUP BY rule_name""")
ORACLES["run_verdicts"] = sql("daily_results", f"{_VERDICT} daily_results")
ORACLES["build_checks"] = sql("customer_features train", """
  SELECT count(*) AS feature_rows, count(*) FILTER (msno IS NULL) AS null_msno, count(*) FILTER (is_churn IS NULL) AS null_is_churn,
    (SELECT count(*) FROM train) AS train_rows, count(*) = (SELECT count(*) FROM train) AND count(msno) = count(*)
      AND count(is_churn) = count(*) AS passed FROM customer_features""")

# Lineage and versions ----------------------------------------------------------------------------------------------

ORACLES["current_snapshot"] = sql("current_snapshot", "SELECT snapshot_id FROM current_snapshot")
ORACLES["newest_snapshot_row"] = sql("snapshots", "SELECT * FROM snapshots ORDER BY build_completed_at DESC LIMIT 1")
_REGISTRY = " UNION ALL ".join(
    "SELECT '{}' AS feature_name, '{}' AS source_table, '{}' AS transformation_rule".format(*row) for row in REGISTRY)
ORACLES["lineage_rows"] = sql("current_snapshot", f"""
  SELECT r.*, (SELECT snapshot_id FROM current_snapshot) AS snapshot_id, (SELECT max(build_completed_at) FROM snapshots) AS created_at
  FROM ({_REGISTRY}) r""")
_NAMES = ", ".join(f"'{c}'" for c in [*_FEATURES[1:], "feature_created_at"])
ORACLES["lineage_completeness"] = f"""
  SELECT count(*) FILTER (r.feature_name IS NULL) AS missing_in_lineage, count(*) FILTER (c.name IS NULL) AS extra_in_lineage
  FROM (SELECT unnest([{_NAMES}]) AS name) c FULL JOIN ({_REGISTRY}) r ON r.feature_name = c.name"""
ORACLES["linked_rows"] = sql("current_snapshot predictions", f"""
  SELECT (SELECT count(*) FROM ({_REGISTRY}) WHERE (SELECT snapshot_id FROM current_snapshot) IS NOT NULL) AS linked_lineage_rows,
    (SELECT count(feature_snapshot_id) FROM predictions) AS linked_prediction_rows""")
ORACLES["provenance_triples"] = sql("predictions", """
  SELECT DISTINCT model_version, threshold_version, feature_snapshot_id FROM predictions
  ORDER BY model_version, threshold_version NULLS LAST, feature_snapshot_id NULLS LAST LIMIT 40""")
ORACLES["content_hash"] = sql("transactions", content_hash("transactions", (
    "txn_id payment_method_id payment_plan_days plan_list_price actual_amount_paid is_auto_renew transaction_date "
    "membership_expire_date is_cancel").split(), ["msno"]))
_DECIMALS = {"total_amount_paid": "DECIMAL(20,2)", "avg_plan_days": "DECIMAL(8,2)", "total_secs": "DECIMAL(28,2)",
             "avg_total_secs": "DECIMAL(12,4)", "avg_num_songs": "DECIMAL(10,4)", "avg_num_unq": "DECIMAL(10,4)"}
ORACLES["feature_table_hash"] = sql("customer_features", content_hash("customer_features", [
    f"{c}=CAST({c} AS {_DECIMALS[c]})" if c in _DECIMALS else c for c in _FEATURES if c not in ("msno", "gender")], ["msno", "gender"]))
ORACLES["attribution_update"] = sql("predictions", """
  SELECT p.pred_id, p.customer_id, coalesce(n.note, 'old') AS note FROM predictions p LEFT JOIN (
    SELECT customer_id, scored_at, max('new-' || model_version) AS note FROM predictions WHERE risk_tier = 'High' GROUP BY ALL) n
  ON p.customer_id = n.customer_id AND p.scored_at = n.scored_at""")
ORACLES["promotion_gate"] = sql("version_metrics", """
  SELECT model_version, round(challenger_auc, 6) AS challenger_auc, round(challenger_business, 6) AS challenger_business,
    round(champion_auc, 6) AS champion_auc, round(champion_business, 6) AS champion_business, round(challenger_auc - champion_auc, 6) AS auc_margin,
    round(challenger_business - champion_business, 6) AS business_delta, ok AS business_gate_ok, decision, decision LIKE 'promoted%' AS promote
  FROM (SELECT *, CASE WHEN champion_auc IS NULL THEN 'promoted_initial_champion'
      WHEN challenger_auc > champion_auc AND ok THEN 'promoted_over_champion' WHEN challenger_auc <= champion_auc THEN 'kept_existing_champion'
      ELSE 'kept_existing_champion_business_regression' END AS decision
    FROM (SELECT m.model_version, m.roc_auc AS challenger_auc, m.precision_churn AS challenger_business, c.roc_auc AS champion_auc,
        c.precision_churn AS champion_business, coalesce(m.precision_churn - c.precision_churn >= -0.001, true) AS ok
      FROM version_metrics m LEFT JOIN version_metrics c ON m.model_version = 'v' || (CAST(substr(c.model_version, 2) AS INTEGER) + 1)))""")
ORACLES["current_production_version"] = sql("predictions", """
  SELECT 'churn' AS model_name, version, stage, role, run_id, round(roc_auc, 6) AS roc_auc FROM (
    SELECT version, CASE WHEN (day + version) % 2 = 0 THEN 'Production' ELSE 'Archived' END AS stage, 'champion' AS role,
      'run-' || day AS run_id, roc_auc
    FROM (SELECT CAST(substr(model_version, 2) AS INTEGER) AS version, CAST(strftime(scored_at, '%Y%m%d') AS INTEGER) AS day,
        max(scored_at) AS logged_at, avg(churn_probability) AS roc_auc FROM predictions GROUP BY 1, 2)
    QUALIFY row_number() OVER (PARTITION BY version ORDER BY logged_at DESC) = 1)
  WHERE stage = 'Production' ORDER BY version DESC LIMIT 1""")

# Models ------------------------------------------------------------------------------------------------------------

_CATEGORICAL = "city gender latest_is_auto_renew latest_payment_method_id registered_via".split()
ORACLES["imputation_values"] = sql("customer_features", " UNION ALL ".join(
    [f"SELECT '{c}' AS feature, 'median' AS strategy, round(quantile_cont(CAST({c} AS DOUBLE), 0.5), 6) AS number, CAST(NULL AS VARCHAR) AS level FROM customer_features"
     for c in _FEATURES[2:] if c not in _CATEGORICAL]
    + [f"(SELECT '{c}' AS feature, 'most_frequent', NULL, CAST({c} AS VARCHAR) FROM customer_features WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)"
       for c in _CATEGORICAL]))
ORACLES["smote_rows"] = sql("members train", """
  SELECT is_churn, CASE WHEN is_churn = 1 THEN greatest(n, n + extra) ELSE n END AS rows,
    CASE WHEN is_churn = 1 THEN greatest(extra, 0) ELSE 0 END AS synthetic, CAST(0 AS BIGINT) AS outside
  FROM (SELECT is_churn, count(*) AS n, CAST(floor(0.5 * (SELECT count(*) FROM members JOIN train USING (msno) WHERE is_churn = 0)
      - (SELECT count(*) FROM members JOIN train USING (msno) WHERE is_churn = 1)) AS BIGINT) AS extra
    FROM members JOIN train USING (msno) GROUP BY is_churn)""")

# Attributions and documents with known results -----------------------------------------------------------------------

_KNOWN = """
  SELECT customer_id, feature, position, value FROM (
    SELECT customer_id, unnest([{'feature': 'cancel_count', 'position': 0, 'value': 0.75 * (coalesce(cancel_count, 0) - 0.5)},
      {'feature': 'num_active_days', 'position': 1, 'value': -0.5 * (coalesce(num_active_days, 0) - 10) + 2.0 * (churn_probability - 0.25)},
      {'feature': 'transaction_count', 'position': 2, 'value': -0.125 * (coalesce(transaction_count, 0) - 8)}], recursive := true)
    FROM latest JOIN customer_features ON msno = customer_id)"""
_TOP = f"""SELECT customer_id, feature, value, row_number() OVER (PARTITION BY customer_id ORDER BY abs(value) DESC, position) AS rank
  FROM ({_KNOWN})"""
ORACLES["top_attributions"] = sql("latest customer_features", f"""
  SELECT customer_id, CAST(rank - 1 AS INTEGER) AS position, feature, round(CAST(value AS DOUBLE), 6) AS shap_value FROM ({_TOP}) WHERE rank <= 2""")
ORACLES["global_attribution_importance"] = sql("latest customer_features", f"""
  SELECT feature, round(avg(abs(CAST(value AS DOUBLE))), 6) AS mean_abs_attribution FROM ({_KNOWN}) GROUP BY feature""")
ORACLES["attribution_explanations"] = sql("latest customer_features", f"""
  SELECT customer_id, list(CASE feature WHEN 'cancel_count' THEN 'Recent cancellation behaviour suggests the subscription relationship is unstable.'
    WHEN 'num_active_days' THEN 'Listening activity has dropped, which is often an early sign of churn.'
    ELSE 'Transaction activity is lower than what we usually see for retained customers.' END ORDER BY rank) AS explanations
  FROM ({_TOP}) WHERE rank <= 2 GROUP BY customer_id""")
ORACLES["json_documents"] = """
  SELECT event_id, CASE WHEN event_id % 5 <> 0 AND event_id % 7 <> 0 THEN CAST(json_extract_string(props, '$.k') AS BIGINT) END AS k,
    CASE WHEN event_id % 5 <> 0 AND event_id % 7 <> 0 THEN '[{"k":' || json_extract_string(props, '$.k') || '}]' END AS written FROM events"""
ORACLES["evolved_predictions"] = sql("predictions", """
  SELECT pred_id, customer_id, churn_probability, CASE WHEN scored_at >= TIMESTAMP '2024-01-10' THEN feature_snapshot_id END AS feature_snapshot_id,
    CASE WHEN scored_at >= TIMESTAMP '2024-01-10' THEN threshold_version ELSE 'v0' END AS threshold_version FROM predictions""")


# Layouts without ids, files and stored tables -------------------------------------------------------------------------

ORACLES["raw_layout_features"] = sql("raw_features", "SELECT * FROM raw_features")
ORACLES["loaded_layout_features"] = ORACLES["raw_layout_features"]
ORACLES["raw_layout_rollup"] = sql("rollup recoded", """
  SELECT r.* REPLACE (f.m AS payment_method_id, f.a AS is_auto_renewal) FROM rollup r JOIN (
    SELECT msno, first(payment_method_id ORDER BY transaction_date, payment_method_id, is_auto_renew) AS m,
      first(is_auto_renew ORDER BY transaction_date, payment_method_id, is_auto_renew) AS a FROM recoded GROUP BY 1) f USING (msno)""")
ORACLES["raw_layout_latest"] = sql("raw_transactions", """
  SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY msno ORDER BY transaction_date DESC, payment_method_id DESC,
      payment_plan_days DESC, plan_list_price DESC, actual_amount_paid DESC, is_auto_renew DESC, membership_expire_date DESC, is_cancel DESC) AS rn
    FROM raw_transactions) WHERE rn = 1""")
ORACLES["csv_load"] = sql("raw_transactions", "SELECT * FROM raw_transactions")
ORACLES["csv_scan_filter"] = sql("members", "SELECT * FROM members WHERE gender IS NULL AND bd > 50")
ORACLES["replaced_table"] = sql("members", "SELECT * FROM members")
ORACLES["appended_log"] = sql("predictions", """
  SELECT pred_id, customer_id, churn_probability, scored_at, CAST(scored_at AS DATE) AS run_date FROM predictions""")

# Properties of fitted models and draws --------------------------------------------------------------------------------

ORACLES["simple_sample"] = sql("train", """
  SELECT * FROM train WHERE CAST('0x' || substr(md5('42:' || msno), 1, 12) AS BIGINT) < 100 * 281474976710656 // (SELECT count(*) FROM train)""")
ORACLES["smote_neighbours"] = sql("members train", """
  SELECT count(*) AS rows, CAST(0 AS BIGINT) AS short, CAST(0 AS BIGINT) AS strange FROM members JOIN train USING (msno) WHERE is_churn = 1""")
ORACLES["nearest_on_a_line"] = sql("members", """
  SELECT a.msno, list_sort(list(CAST(abs(a.bd - b.bd) AS DOUBLE)))[1:5] AS distances
  FROM members a JOIN members b ON a.msno <> b.msno GROUP BY 1""")
_SCALED = ", ".join(
    f"round((coalesce({c}, (SELECT quantile_cont({c}, 0.5) FROM numbers)) - avg(coalesce({c}, (SELECT quantile_cont({c}, 0.5) FROM numbers))) OVER ())"
    f" / stddev_samp(coalesce({c}, (SELECT quantile_cont({c}, 0.5) FROM numbers))) OVER (), 6) AS {c}"
    for c in ("bd", "num_active_days", "total_amount_paid")
)
ORACLES["scaled_numbers"] = sql("customer_features", f"""
  SELECT msno, {_SCALED} FROM (SELECT msno, CAST(bd AS DOUBLE) AS bd, CAST(num_active_days AS DOUBLE) AS num_active_days,
    CAST(total_amount_paid AS DOUBLE) AS total_amount_paid FROM customer_features) numbers""").replace("FROM numbers)", "FROM (SELECT CAST(bd AS DOUBLE) AS bd, CAST(num_active_days AS DOUBLE) AS num_active_days, CAST(total_amount_paid AS DOUBLE) AS total_amount_paid FROM customer_features))")
ORACLES["fixed_score_importance"] = "SELECT * FROM (VALUES ('cancel_count', false), ('num_active_days', true), ('bd', true)) t(feature, unused)"
ORACLES["batch_score_checks"] = sql("train", """
  SELECT count(*) AS customers, count(*) AS in_range, count(*) AS right_tier, count(*) AS with_provenance FROM train""")
ORACLES["attribution_checks"] = sql("split_sizes", "SELECT validation AS linear, validation AS sampled FROM split_sizes")
ORACLES["logistic_optimum"] = sql("split_sizes", "SELECT training AS rows, true AS flat FROM split_sizes")

# Logs that the plans write --------------------------------------------------------------------------------------------

ORACLES["feature_build"] = sql("train", """
  SELECT s.status, 'r1' AS pipeline_run_id, CASE WHEN s.status = 'completed' THEN t.n END AS row_count,
    CAST(22 AS INTEGER) AS feature_count, t.n AS published
  FROM (SELECT unnest(['building', 'completed']) AS status) s, (SELECT count(*) AS n FROM train) t""")
ORACLES["recorded_watermark"] = sql("train", """
  SELECT CAST(i AS BIGINT) AS watermark_id, 'processed.customer_features' AS table_name, count(*) AS row_count, 'r' || i AS pipeline_run_id
  FROM train, (SELECT unnest([1, 2]) AS i) GROUP BY i""")
ORACLES["validation_log"] = sql("customer_features transactions", f"""
  SELECT rule_name, severity, status, CAST(2 AS BIGINT) AS runs FROM ({_RULE_ROWS})""")
ORACLES["prediction_log"] = sql("train", """
  SELECT d AS run_date, count(*) AS scored, count(*) FILTER (d = DATE '2024-02-01') AS explained
  FROM train, (SELECT unnest([DATE '2024-01-31', DATE '2024-02-01']) AS d) GROUP BY d""")
ORACLES["monitoring_log"] = f"""
  SELECT CAST(0.75 AS DOUBLE) AS baseline_auc, current_auc, baseline_row_count, current_row_count, status FROM ({ORACLES['monitoring_verdict']})"""

from verification import model_oracles  # noqa: E402, F401  (registers its SQL here)

"""Twins of the marts, data tests, business questions and screens."""

from __future__ import annotations

from oracle import core  # noqa: F401
from oracle.ctes import cte
from oracle.texts import oracle

GMV = "status = 'SUCCESS' AND txn_type = 'PAYMENT'"

# ---- fraud -------------------------------------------------------------------------------------

cte("outcome_kinds", """
SELECT o.*, k.kind, k.pos FROM outcomes o,
  LATERAL (SELECT unnest(CASE WHEN flagged THEN kinds ELSE ['NONE'] END) AS kind,
                  generate_subscripts(CASE WHEN flagged THEN kinds ELSE ['NONE'] END, 1) AS pos) k""")
cte("fraud_cells", """
SELECT dt AS date_day, kind AS rule_kind, account_tier, channel,
  count(*) FILTER (kind <> 'NONE') AS alerts_fired,
  count(*) FILTER (kind = rule_type AND decision = 'BLOCK') AS txns_blocked,
  count(*) FILTER (kind <> 'NONE' AND is_fraud_confirmed) AS tp,
  count(*) FILTER (kind <> 'NONE' AND NOT is_fraud_confirmed) AS fp,
  count(*) FILTER (kind = 'NONE' AND is_fraud_confirmed) AS fn,
  count(*) FILTER (kind <> 'NONE' AND is_fraud_confirmed AND pos = 1) AS tp_txns,
  count(*) FILTER (kind <> 'NONE' AND NOT is_fraud_confirmed AND account_tier = 'VIP') AS fp_vip,
  count(*) FILTER (kind = rule_type AND decision = 'REVIEW') AS reviews,
  coalesce(sum(amount_vnd) FILTER (kind = rule_type AND decision = 'BLOCK' AND is_fraud_confirmed), 0)::BIGINT AS gross,
  coalesce(sum(amount_vnd) FILTER (kind <> 'NONE' AND NOT is_fraud_confirmed), 0)::BIGINT AS fp_vnd,
  coalesce(sum(amount_vnd) FILTER (kind = 'NONE' AND is_fraud_confirmed), 0)::BIGINT AS leaked,
  count(*) AS n, count(is_fraud_confirmed) AS labelled
FROM outcome_kinds GROUP BY ALL""")
cte("fraud_fact", """
SELECT date_day, rule_kind AS rule_type, account_tier, channel, alerts_fired, txns_blocked, tp, fp, fn,
  fp / nullif(fp + tp, 0) AS false_positive_rate, tp / nullif(tp + fp, 0) AS precision,
  sum(tp_txns) OVER w / nullif(sum(tp_txns) OVER w + sum(fn) OVER w, 0) AS recall,
  gross AS gross_fraud_blocked_vnd,
  round(fp_vnd * 0.3::DECIMAL(9,6) + fp_vip * 1800000, 2)::DECIMAL(18,2) AS friction_cost_vnd,
  round(gross * 0.7::DECIMAL(9,6) - leaked - (fp_vnd * 0.3::DECIMAL(9,6) + fp_vip * 1800000) - reviews * 25000, 2)::DECIMAL(18,2)
    AS net_loss_prevented_vnd,
  labelled / n AS label_coverage_rate, 'base' AS scenario
FROM fraud_cells WINDOW w AS (PARTITION BY date_day, account_tier, channel)""")

oracle("a1_confusion_matrix", """
SELECT count(*) FILTER (flagged AND is_fraud_confirmed) AS tp, count(*) FILTER (flagged AND NOT is_fraud_confirmed) AS fp,
  count(*) FILTER (NOT flagged AND is_fraud_confirmed) AS fn, count(*) FILTER (NOT flagged AND NOT is_fraud_confirmed) AS tn
FROM outcomes""")
oracle("a2_rates", """
SELECT *, round(fp / nullif(fp + tp, 0), 6) AS false_positive_rate, round(tp / nullif(tp + fp, 0), 6) AS precision,
  round(tp / nullif(tp + fn, 0), 6) AS recall
FROM (SELECT account_tier, channel, count(*) FILTER (flagged AND is_fraud_confirmed) AS tp,
  count(*) FILTER (flagged AND NOT is_fraud_confirmed) AS fp, count(*) FILTER (NOT flagged AND is_fraud_confirmed) AS fn,
  count(*) FILTER (NOT flagged AND NOT is_fraud_confirmed) AS tn FROM outcomes GROUP BY ALL)""")
oracle("a3_friction_cost", """
SELECT account_tier, sum(fp)::BIGINT AS fp, sum(friction_cost_vnd)::DOUBLE AS friction_cost_vnd
FROM fraud_fact GROUP BY account_tier""")
oracle("a4_net_loss_prevented", """
SELECT rule_type, sum(gross_fraud_blocked_vnd)::BIGINT AS gross_fraud_blocked_vnd,
  sum(net_loss_prevented_vnd)::DOUBLE AS net_loss_prevented_vnd FROM fraud_fact GROUP BY rule_type""")
COVERAGE = """
SELECT dt::VARCHAR AS date_day, count(*) AS txns, count(is_fraud_confirmed) AS labelled,
  round(count(is_fraud_confirmed) / count(*), 6) AS label_coverage_rate,
  count(is_fraud_confirmed) / count(*) >= 0.8 AS mature FROM outcomes GROUP BY dt"""
oracle("a5_label_coverage", COVERAGE)
oracle("m2_labels_mature", f"SELECT * FROM ({COVERAGE}) WHERE NOT mature")
oracle("a6_fraud_performance", """
SELECT * REPLACE (date_day::VARCHAR AS date_day, round(false_positive_rate, 6) AS false_positive_rate,
  round(precision, 6) AS precision, round(recall, 6) AS recall, friction_cost_vnd::DOUBLE AS friction_cost_vnd,
  net_loss_prevented_vnd::DOUBLE AS net_loss_prevented_vnd, round(label_coverage_rate, 6) AS label_coverage_rate)
FROM fraud_fact""")
oracle("blocked_by_rule_and_tier", """
SELECT dt::VARCHAR AS date_day, rule_id, rule_type, coalesce(account_tier, 'UNKNOWN') AS account_tier,
  count(*) AS blocked_txns, sum(amount_vnd)::BIGINT AS blocked_vnd
FROM decided WHERE decision = 'BLOCK' GROUP BY ALL""")
oracle("suspended_by_risk", """
SELECT DISTINCT user_id FROM (
  SELECT user_id FROM alerts WHERE severity = 'CRITICAL'
  UNION ALL SELECT user_id FROM outcomes WHERE decision = 'BLOCK' AND is_fraud_confirmed)""")

# ---- loyalty -----------------------------------------------------------------------------------

cte("loyalty_days", f"""
SELECT dt AS date_day, user_id, coalesce(account_tier, 'UNKNOWN') AS account_tier, grp AS experiment_group,
  coalesce(sum(amount_vnd) FILTER ({GMV}), 0)::BIGINT AS gmv, count(*) FILTER ({GMV}) AS txns,
  sum(points)::BIGINT AS points_issued
FROM points_of GROUP BY ALL""")
cte("redeemed", """
SELECT make_timestamp(r.ms * 1000)::DATE AS date_day, r.user_id, coalesce(p.account_tier, 'UNKNOWN') AS account_tier,
  h.grp AS experiment_group, sum(points_spent)::BIGINT AS points_redeemed
FROM redemptions r LEFT JOIN profiles p ON r.user_id = p.user_id JOIN holdout h ON h.user_id = r.user_id GROUP BY ALL""")


def totals(by: str) -> str:
    keys = f"{by}, " if by else ""
    return f"""
SELECT {keys}experiment_group, count(*) FILTER (txns > 0) AS active_users, sum(gmv)::BIGINT AS gmv,
  sum(points_issued)::BIGINT AS points_issued, sum(gmv)::BIGINT / nullif(count(*) FILTER (txns > 0), 0) AS arpu
FROM (SELECT {keys}experiment_group, user_id, sum(gmv) AS gmv, sum(txns) AS txns, sum(points_issued) AS points_issued
      FROM loyalty_days GROUP BY ALL) GROUP BY ALL"""


def lifted(by: str) -> str:
    keys = f"{by}, " if by else ""
    pick = ", ".join(
        f"max(CASE WHEN experiment_group = '{g}' THEN {n} END) AS {n}_{s}"
        for g, s in (("TREATMENT", "t"), ("CONTROL", "c")) for n in ("active_users", "gmv", "points_issued", "arpu"))
    return f"""
SELECT *, (arpu_t - arpu_c) / nullif(arpu_c, 0) AS incremental_lift,
  (arpu_t - arpu_c) * active_users_t AS incremental_revenue,
  (points_issued_t - points_issued_c * (active_users_t / nullif(active_users_c, 0))) * 500::DOUBLE AS point_cost,
  incremental_revenue * 0.3::DOUBLE / nullif(point_cost, 0) AS program_roi
FROM (SELECT {keys}{pick} FROM ({totals(by)}) {('GROUP BY ' + by) if by else ''})"""


def owed(by: str) -> str:
    keys = f"{by}, " if by else ""
    join = f"FULL JOIN s USING ({by})" if by else "CROSS JOIN s"
    group = f"GROUP BY {by}" if by else ""
    return f"""
SELECT {keys}coalesce(points_issued, 0) AS points_issued, coalesce(points_redeemed, 0) AS points_redeemed,
  'base' AS scenario, coalesce(points_issued, 0) - coalesce(points_redeemed, 0) AS outstanding_points,
  ((coalesce(points_issued, 0) - coalesce(points_redeemed, 0)) * 500)::DOUBLE AS liability_vnd,
  coalesce(points_redeemed, 0) / nullif(coalesce(points_issued, 0), 0) AS redemption_rate,
  1 - coalesce(points_redeemed, 0) / nullif(coalesce(points_issued, 0), 0) AS breakage_rate
FROM (SELECT {keys}sum(points_issued)::BIGINT AS points_issued FROM loyalty_days {group}) i
{join.replace(' s', f' (SELECT {keys}sum(points_redeemed)::BIGINT AS points_redeemed FROM redeemed {group}) s')}"""


OWED_ROUNDED = "* REPLACE (round(redemption_rate, 6) AS redemption_rate, round(breakage_rate, 6) AS breakage_rate)"
oracle("a7_incremental_lift", f"""
SELECT account_tier, active_users_t, active_users_c, round(arpu_t, 6) AS arpu_t, round(arpu_c, 6) AS arpu_c,
  round(incremental_lift, 6) AS incremental_lift, round(incremental_revenue, 6) AS incremental_revenue
FROM ({lifted('account_tier')})""")
oracle("a8_program_roi", f"""
SELECT points_issued_t, points_issued_c, round(point_cost, 6) AS point_cost, round(program_roi, 6) AS program_roi
FROM ({lifted('')})""")
oracle("q9_incremental_revenue", f"""
SELECT active_users_t, active_users_c, round(incremental_lift, 6) AS incremental_lift,
  round(incremental_revenue, 6) AS incremental_revenue, round(point_cost, 6) AS point_cost,
  round(program_roi, 6) AS program_roi FROM ({lifted('')})""")
oracle("q10_tier_budget", f"""
SELECT account_tier, round(incremental_lift, 6) AS incremental_lift, round(program_roi, 6) AS program_roi
FROM ({lifted('account_tier')})""")
oracle("a9_liability", f"SELECT {OWED_ROUNDED} FROM ({owed('account_tier')})")
oracle("q11_point_liability", f"SELECT {OWED_ROUNDED} FROM ({owed('')})")
oracle("a10_loyalty_analytics", f"""
WITH t AS ({totals('date_day, account_tier')}), o AS ({owed('date_day, account_tier, experiment_group')}),
l AS (SELECT *, 'TREATMENT' AS experiment_group FROM ({lifted('date_day, account_tier')}))
SELECT date_day::VARCHAR AS date_day, account_tier, experiment_group, coalesce(t.active_users, 0) AS active_users,
  coalesce(t.gmv, 0) AS gmv, coalesce(t.points_issued, 0) AS points_issued, round(arpu, 6) AS arpu,
  o.points_redeemed, o.outstanding_points, o.liability_vnd, round(o.redemption_rate, 6) AS redemption_rate,
  round(o.breakage_rate, 6) AS breakage_rate, round(l.incremental_lift, 6) AS incremental_lift,
  round(l.incremental_revenue, 6) AS incremental_revenue, round(l.point_cost, 6) AS point_cost,
  round(l.program_roi, 6) AS program_roi,
  (sum(o.outstanding_points) OVER (PARTITION BY account_tier, experiment_group ORDER BY date_day))::BIGINT
    AS outstanding_points_to_date
FROM t FULL JOIN o USING (date_day, account_tier, experiment_group)
LEFT JOIN l USING (date_day, account_tier, experiment_group)""")
oracle("a11_holdout_balance", """
WITH u AS (SELECT user_id, account_tier, experiment_group,
    coalesce(sum(gmv) FILTER (date_day < DATE '2024-01-08'), 0) AS pre FROM loyalty_days GROUP BY ALL),
g AS (SELECT experiment_group, count(*) AS gn, avg(pre) AS mean, var_samp(pre) AS var FROM u GROUP BY ALL),
t AS (SELECT account_tier, count(*) AS tn FROM u GROUP BY ALL),
cells AS (SELECT account_tier, experiment_group, count(*) AS users, sum(pre)::BIGINT AS pre_gmv FROM u GROUP BY ALL),
x AS (SELECT *, tn * gn / (SELECT count(*) FROM u) AS expected FROM cells JOIN g USING (experiment_group) JOIN t USING (account_tier))
SELECT account_tier, experiment_group, users, round(users / gn, 6) AS tier_share, pre_gmv, round(mean, 6) AS pre_gmv_per_user,
  round((SELECT (max(mean) FILTER (experiment_group = 'TREATMENT') - max(mean) FILTER (experiment_group = 'CONTROL'))
    / sqrt((max(var) FILTER (experiment_group = 'TREATMENT') + max(var) FILTER (experiment_group = 'CONTROL')) / 2) FROM g), 6) AS smd,
  round(sum(pow(users - expected, 2) / expected) OVER (), 6) AS chi2 FROM x""")
cte("roi_interval", """
WITH u AS (SELECT experiment_group, user_id, sum(gmv) AS gmv, sum(points_issued) AS points FROM loyalty_days GROUP BY ALL
  HAVING sum(txns) > 0),
s AS (SELECT count(*) FILTER (experiment_group = 'TREATMENT') AS n_t, count(*) FILTER (experiment_group = 'CONTROL') AS n_c,
  avg(gmv) FILTER (experiment_group = 'TREATMENT') AS arpu_t, avg(gmv) FILTER (experiment_group = 'CONTROL') AS arpu_c,
  var_samp(gmv) FILTER (experiment_group = 'TREATMENT') AS v_t, var_samp(gmv) FILTER (experiment_group = 'CONTROL') AS v_c,
  sum(points) FILTER (experiment_group = 'TREATMENT') AS p_t, sum(points) FILTER (experiment_group = 'CONTROL') AS p_c FROM u)
SELECT n_t, n_c, arpu_t, arpu_c, sqrt(v_t / n_t + v_c / n_c) AS se, (p_t - p_c * (n_t / n_c)) * 500::DOUBLE AS point_cost,
  (arpu_t - arpu_c) * n_t * 0.3 / point_cost AS program_roi,
  (arpu_t - arpu_c - 1.959964 * se) * n_t * 0.3 / point_cost AS roi_low,
  (arpu_t - arpu_c + 1.959964 * se) * n_t * 0.3 / point_cost AS roi_high FROM s""")
oracle("a12_roi_interval", """
SELECT n_t, n_c, round(arpu_t, 6) AS arpu_t, round(arpu_c, 6) AS arpu_c, round(se, 6) AS se,
  round(point_cost, 6) AS point_cost, round(program_roi, 6) AS program_roi, round(roi_low, 6) AS roi_low,
  round(roi_high, 6) AS roi_high FROM roi_interval""")
oracle("e8_roi_and_liability", f"""
SELECT round(program_roi, 6) AS program_roi, round(roi_low, 6) AS roi_low, round(roi_high, 6) AS roi_high, liability_vnd,
  round(redemption_rate, 6) AS redemption_rate, round(breakage_rate, 6) AS breakage_rate
FROM roi_interval, ({owed('')})""")

# ---- merchants ---------------------------------------------------------------------------------

cte("channel_days", f"""
SELECT dt AS date_day, merchant_id, channel, count(*) AS txn_count,
  coalesce(sum(amount_vnd) FILTER ({GMV}), 0)::BIGINT AS gmv,
  coalesce(sum(amount_vnd) FILTER (txn_type = 'REFUND' AND status = 'SUCCESS'), 0)::BIGINT AS refund_amount,
  count(*) FILTER (txn_type = 'REFUND' AND status = 'SUCCESS') AS refund_count,
  coalesce(sum(amount_vnd) FILTER (cb), 0)::BIGINT AS chargeback_amount, count(*) FILTER (cb) AS chargeback_count
FROM (SELECT c.*, l.transaction_id IS NOT NULL AS cb FROM clean c LEFT JOIN (
  SELECT transaction_id FROM labels_t WHERE is_fraud_confirmed AND label_source = 'CHARGEBACK') l
  ON l.transaction_id = c.transaction_id) GROUP BY ALL""")
cte("merchant_sums", """
SELECT date_day, merchant_id, sum(txn_count)::BIGINT AS txn_count, sum(gmv)::BIGINT AS gmv,
  sum(refund_amount)::BIGINT AS refund_amount, sum(refund_count)::BIGINT AS refund_count,
  sum(chargeback_amount)::BIGINT AS chargeback_amount, sum(chargeback_count)::BIGINT AS chargeback_count,
  sum(gmv::DECIMAL(18,0) * rate::DECIMAL(9,6)) AS interchange
FROM channel_days JOIN interchange_rate USING (channel) GROUP BY ALL""")
cte("merchant_costs", """
SELECT date_day, merchant_id, industry, scenario, txn_count, gmv, refund_amount, take_rate,
  gmv::DECIMAL(18,0) * take_rate::DECIMAL(9,6) AS g, interchange AS i,
  refund_amount::DECIMAL(18,0) * refund_fee_rate::DECIMAL(9,6) + refund_count::DECIMAL(9,0) * fixed_refund_cost::DECIMAL(12,2) AS r,
  chargeback_amount::DECIMAL(18,0) + chargeback_count::DECIMAL(9,0) * chargeback_penalty_fee::DECIMAL(12,2) AS f,
  txn_count::DECIMAL(9,0) * cost_per_txn::DECIMAL(12,2) AS p
FROM merchant_sums JOIN merchant_industry USING (merchant_id) JOIN take_rate USING (industry), cost_scenarios""")
cte("merchant_all", """
SELECT date_day, merchant_id, industry, scenario, txn_count, gmv, refund_amount, take_rate::DOUBLE AS take_rate,
  round(g, 2)::DECIMAL(18,2) AS gross_revenue, round(i, 2)::DECIMAL(18,2) AS interchange_fee,
  round(r, 2)::DECIMAL(18,2) AS refund_cost, round(f, 2)::DECIMAL(18,2) AS fraud_cost,
  round(p, 2)::DECIMAL(18,2) AS processing_cost, round(g - i - r - f - p, 2)::DECIMAL(18,2) AS net_revenue,
  round(g - i - r - f - p, 2)::DECIMAL(18,2)::DOUBLE / nullif(gmv, 0) AS net_take_rate,
  round(g - i - r - f - p, 2) < 0 AS is_margin_negative
FROM merchant_costs""")
cte("merchant_fact", "SELECT * FROM merchant_all WHERE scenario = 'base'")

MONEY = ["gross_revenue", "interchange_fee", "refund_cost", "fraud_cost", "processing_cost", "net_revenue"]
oracle("a13_merchant_profitability", f"""
SELECT * REPLACE (date_day::VARCHAR AS date_day, {', '.join(f'{m}::DOUBLE AS {m}' for m in MONEY)},
  round(net_take_rate, 6) AS net_take_rate) FROM merchant_fact""")
oracle("j6_scenarios", """
SELECT date_day::VARCHAR AS date_day, merchant_id, industry, scenario, processing_cost::DOUBLE AS processing_cost,
  net_revenue::DOUBLE AS net_revenue FROM merchant_all""")
oracle("p11_margin_negative", """
SELECT date_day::VARCHAR AS date_day, merchant_id, net_revenue::DOUBLE AS net_revenue,
  round(net_take_rate, 6) AS net_take_rate FROM merchant_fact WHERE is_margin_negative""")
oracle("a14_chargeback_penalty", """
SELECT merchant_id, sum(chargeback_count)::BIGINT AS chargebacks, sum(chargeback_amount)::BIGINT AS chargeback_amount
FROM channel_days GROUP BY merchant_id HAVING sum(chargeback_count) > 0""")
WATERFALL = "\nUNION ALL ".join(
    f"SELECT industry, {i}::BIGINT AS step_no, '{m}' AS step, ({'' if m in ('gross_revenue', 'net_revenue') else '-'}sum({m}))::DOUBLE AS amount_vnd "
    "FROM merchant_fact GROUP BY industry" for i, m in enumerate(MONEY))
oracle("a26_cost_waterfall", WATERFALL)
oracle("q6_travel_margin", f"SELECT * FROM ({WATERFALL}) WHERE industry = 'Travel'")
BY_MERCHANT = f"""
SELECT merchant_id, industry, sum(txn_count)::BIGINT AS txn_count, sum(gmv)::BIGINT AS gmv,
  {', '.join(f'sum({m})::DOUBLE AS {m}' for m in MONEY)},
  round(sum(net_revenue)::DOUBLE / nullif(sum(gmv), 0), 6) AS net_take_rate
FROM merchant_fact GROUP BY ALL HAVING sum(net_revenue) < 0 AND sum(gmv) > 0 ORDER BY gmv DESC, merchant_id"""
oracle("t3_loss_making", f"{BY_MERCHANT} LIMIT 10")
oracle("q5_loss_making", f"{BY_MERCHANT} LIMIT 20")
oracle("e5_negative_merchants", f"SELECT merchant_id, industry, gmv, net_take_rate FROM ({BY_MERCHANT} LIMIT 10)")
oracle("e4_take_rate_by_industry", """
SELECT industry, sum(gmv)::BIGINT AS gmv, sum(net_revenue)::DOUBLE AS net_revenue,
  round(sum(net_revenue)::DOUBLE / sum(gmv), 6) AS net_take_rate FROM merchant_fact GROUP BY industry""")
oracle("q7_cost_what_if", f"""
SELECT industry, scenario, sum(txn_count)::BIGINT AS txn_count, sum(gmv)::BIGINT AS gmv,
  {', '.join(f'sum({m})::DOUBLE AS {m}' for m in MONEY)},
  round(sum(net_revenue)::DOUBLE / sum(gmv), 6) AS net_take_rate, sum(net_revenue) < 0 AS is_margin_negative
FROM merchant_all GROUP BY ALL""")

# ---- lifecycle ---------------------------------------------------------------------------------

cte("as_of_dates", "SELECT d::DATE AS as_of FROM generate_series(DATE '2024-06-24', DATE '2024-07-01', INTERVAL 1 DAY) g(d)")
cte("activity_gaps", """
SELECT *, make_timestamp(ms * 1000)::DATE AS dt,
  ms - lag(ms) OVER (PARTITION BY user_id ORDER BY ms, transaction_id) AS gap FROM activity""")
cte("life_features", """
SELECT as_of, user_id, min(dt) AS first_date, max(dt) AS last_date,
  count(*) FILTER (dt > as_of - 30) AS txn_count_30d, count(*) FILTER (dt > as_of - 90) AS txn_count_90d,
  coalesce(sum(amount_vnd) FILTER (dt > as_of - 30), 0)::BIGINT AS gmv_30d, median(gap) / 86400000 AS median_gap,
  as_of - min(dt) AS days_since_first, as_of - max(dt) AS days_silent,
  (as_of - max(dt)) / nullif(median(gap) / 86400000, 0) AS silence_ratio
FROM as_of_dates JOIN activity_gaps ON dt <= as_of GROUP BY as_of, user_id""")
cte("life_p80", "SELECT as_of, quantile_cont(txn_count_30d, 0.8) AS p80 FROM life_features GROUP BY as_of")
cte("life_states", """
SELECT f.*, CASE WHEN s.user_id IS NOT NULL THEN 'HIGH_RISK_SUSPENDED' WHEN days_since_first <= 30 THEN 'NEW'
  WHEN days_silent > 90 THEN 'CHURNED' WHEN days_silent > 60 THEN 'DORMANT'
  WHEN silence_ratio > 2 AND txn_count_90d >= 3 THEN 'AT_RISK' WHEN txn_count_30d >= p80 THEN 'HIGHLY_ACTIVE'
  ELSE 'ACTIVE' END AS state
FROM life_features f JOIN life_p80 USING (as_of) LEFT JOIN suspended s ON s.user_id = f.user_id""")
cte("life_moves", """
SELECT a.user_id, a.state AS state_from, a.gmv_30d AS gmv_30d_before, b.state AS state_to
FROM life_states a JOIN life_states b ON a.user_id = b.user_id
WHERE a.as_of = DATE '2024-06-24' AND b.as_of = DATE '2024-07-01'""")
TODAY = "as_of = DATE '2024-07-01'"
oracle("a15_lifecycle_features", f"""
SELECT as_of::VARCHAR AS as_of, user_id, first_date::VARCHAR AS first_date, last_date::VARCHAR AS last_date, txn_count_30d,
  txn_count_90d, gmv_30d, round(median_gap, 6) AS median_gap, days_since_first, days_silent,
  round(silence_ratio, 6) AS silence_ratio FROM life_features WHERE {TODAY}""")
oracle("a16_population_p80", """
SELECT as_of::VARCHAR AS as_of, round(p80, 6) AS p80 FROM life_p80 WHERE as_of IN (DATE '2024-06-24', DATE '2024-07-01')""")
oracle("a17_customer_lifecycle", f"""
SELECT user_id, state, days_silent, round(silence_ratio, 6) AS silence_ratio, txn_count_30d, txn_count_90d, gmv_30d
FROM life_states WHERE {TODAY}""")
TRANSITIONS = """
SELECT state_from, state_to, count(*) AS customers, sum(gmv_30d_before)::BIGINT AS gmv_30d_before
FROM life_moves GROUP BY ALL"""
oracle("a18_transitions", TRANSITIONS)
for name in ("t5_transition_table", "e7_lifecycle_flow"):
    oracle(name, f"""
SELECT *, state_from = 'HIGHLY_ACTIVE' AND state_to = 'AT_RISK' AS highlight FROM ({TRANSITIONS})
ORDER BY highlight DESC, state_from, state_to""")
oracle("t4_churn_risk", "SELECT * FROM life_moves WHERE state_to = 'AT_RISK' ORDER BY gmv_30d_before DESC, user_id")
oracle("q12_slipping_customers", """
SELECT * FROM life_moves WHERE state_from = 'HIGHLY_ACTIVE' AND state_to = 'AT_RISK' ORDER BY gmv_30d_before DESC, user_id""")
HISTORY = """
SELECT user_id, state, as_of::VARCHAR AS valid_from, (lead(as_of) OVER w)::VARCHAR AS valid_to,
  lead(as_of) OVER w IS NULL AS is_current, round(median_gap, 6) AS median_gap, days_silent,
  round(silence_ratio, 6) AS silence_ratio, txn_count_30d, txn_count_90d, gmv_30d
FROM (SELECT *, lag(state) OVER (PARTITION BY user_id ORDER BY as_of) AS before FROM life_states)
WHERE before IS NULL OR before <> state WINDOW w AS (PARTITION BY user_id ORDER BY as_of)"""
oracle("w6_lifecycle_history", HISTORY)
oracle("w6_history_by_day", HISTORY)


# ---- screens and checks ------------------------------------------------------------------------

HEALTH = """
SELECT ingested_ms // 10000 * 10000 AS period_start, count(*) AS events, count(*) / 10 AS events_per_s,
  round(quantile_cont(ingested_ms - ms, 0.5), 6) AS event_lag_p50_ms, round(quantile_cont(ingested_ms - ms, 0.95), 6) AS event_lag_p95_ms,
  round(quantile_cont(ingested_ms - ms, 0.99), 6) AS event_lag_p99_ms,
  round(quantile_cont(ingested_ms - max_seen_ms + 10000, 0.99), 6) AS watermark_lag_p99_ms,
  round(avg(out_of_order::INT), 6) AS out_of_order_rate, round(avg(late::INT), 6) AS late_rate
FROM arrivals GROUP BY 1"""
oracle("a19_stream_health", HEALTH)
oracle("r6_stream_health", f"SELECT period_start, watermark_lag_p99_ms, late_rate, events_per_s FROM ({HEALTH})")
oracle("m1_data_complete", """
SELECT dt::VARCHAR AS date_day, count(*) AS events, round(avg(late::INT), 6) AS late_rate,
  round(quantile_cont(ingested_ms - max_seen_ms + 10000, 0.99), 6) AS watermark_lag_p99_ms FROM arrivals GROUP BY dt""")
oracle("a20_kpi_minute", f"""
WITH m AS (SELECT ms // 60000 AS k, coalesce(sum(amount_vnd) FILTER ({GMV}), 0)::BIGINT AS gmv, count(*) AS txns,
  count(*) FILTER (status = 'SUCCESS') AS ok FROM clean GROUP BY 1)
SELECT s.k * 60000 AS minute, coalesce(gmv, 0) AS gmv, coalesce(txns, 0) AS txns, round(ok / nullif(txns, 0), 6) AS success_rate
FROM (SELECT unnest(range(min(k), max(k) + 1)) AS k FROM m) s LEFT JOIN m ON m.k = s.k""")
oracle("a21_alerts_per_minute", """
SELECT event_ts // 60000 * 60000 AS minute, alert_type, count(*) AS alerts FROM alerts GROUP BY ALL""")
oracle("r3_alerts_by_type", """
SELECT event_ts // 60000 * 60000 AS minute, count(*) FILTER (alert_type = 'CARD_TESTING') AS card_testing,
  count(*) FILTER (alert_type = 'IMPOSSIBLE_TRAVEL') AS impossible_travel, count(*) FILTER (alert_type = 'RULE_BLOCK') AS rule_block
FROM alerts GROUP BY 1""")
HEAT = """
SELECT floor(lat / {g})::BIGINT AS lat_cell, floor(lon / {g})::BIGINT AS lon_cell, count(*) AS txns,
  sum(amount_vnd)::BIGINT AS amount_vnd FROM clean {where} GROUP BY 1, 2"""
oracle("a22_geo_heatmap", HEAT.format(g="0.01::DOUBLE", where=""))
oracle("r2_geo_alerts", HEAT.format(
    g="0.1::DOUBLE", where="WHERE transaction_id IN (SELECT transaction_id FROM alerts)"))
SUCCESS = """
SELECT channel, dt::VARCHAR AS date_day, count(*) AS txns, round(count(*) FILTER (status = 'SUCCESS') / count(*), 6) AS success_rate,
  round(count(*) FILTER (status = 'FAILED' AND failure_reason = 'INSUFFICIENT_FUND') / nullif(count(*) FILTER (status = 'FAILED'), 0), 6) AS share_insufficient_fund,
  round(count(*) FILTER (status = 'FAILED' AND failure_reason = 'CARD_DECLINED') / nullif(count(*) FILTER (status = 'FAILED'), 0), 6) AS share_card_declined,
  round(count(*) FILTER (status = 'FAILED' AND failure_reason = 'TIMEOUT') / nullif(count(*) FILTER (status = 'FAILED'), 0), 6) AS share_timeout
FROM clean GROUP BY channel, dt"""
oracle("a23_success_by_channel", SUCCESS)
oracle("e3_success_by_channel", f"SELECT channel, date_day, success_rate FROM ({SUCCESS})")
oracle("q8_success_drift", """
SELECT channel, dt::VARCHAR AS date_day, txns, round(rate, 6) AS success_rate,
  round(rate - lag(rate) OVER (PARTITION BY channel ORDER BY dt), 6) AS delta,
  round(fund / nullif(failed, 0), 6) AS share_insufficient_fund, round(declined / nullif(failed, 0), 6) AS share_card_declined,
  round(timeout / nullif(failed, 0), 6) AS share_timeout
FROM (SELECT channel, dt, count(*) AS txns, count(*) FILTER (status = 'SUCCESS') / count(*) AS rate,
  count(*) FILTER (status = 'FAILED') AS failed, count(*) FILTER (status = 'FAILED' AND failure_reason = 'INSUFFICIENT_FUND') AS fund,
  count(*) FILTER (status = 'FAILED' AND failure_reason = 'CARD_DECLINED') AS declined,
  count(*) FILTER (status = 'FAILED' AND failure_reason = 'TIMEOUT') AS timeout FROM clean GROUP BY ALL)""")
BLOCK_RATE = """
SELECT h.k * 3600000 AS hour, h.txns, h.blocked, round(h.rate, 6) AS block_rate, round(w.rate, 6) AS week_ago_rate,
  round(h.rate - w.rate, 6) AS delta, sparkline
FROM (SELECT *, array_to_string(list(blocked) OVER (ORDER BY k ROWS BETWEEN 23 PRECEDING AND CURRENT ROW), ',') AS sparkline FROM hours) h
LEFT JOIN hours w ON w.k = h.k - 168"""
cte("hours", """
SELECT s.k, coalesce(txns, 0) AS txns, coalesce(blocked, 0) AS blocked, blocked / nullif(txns, 0) AS rate
FROM (SELECT unnest(range(min(ms // 3600000), max(ms // 3600000) + 1)) AS k FROM decided) s
LEFT JOIN (SELECT ms // 3600000 AS k, count(*) AS txns, count(*) FILTER (decision = 'BLOCK') AS blocked FROM decided GROUP BY 1) d
ON d.k = s.k""")
oracle("a24_block_rate", BLOCK_RATE)
oracle("r4_block_rate_tile", f"{BLOCK_RATE} ORDER BY hour DESC LIMIT 1")
BAND = f"""
WITH days AS (SELECT DATE '{{day}}' - (7 * w)::INT AS d FROM range(0, 5) g(w)),
m AS (SELECT dt, ms // 60000 % 1440 AS mod_, sum(amount_vnd)::BIGINT AS gmv FROM clean WHERE {GMV} GROUP BY ALL),
f AS (SELECT d, k AS minute_of_day, coalesce(gmv, 0) AS gmv FROM days CROSS JOIN range(0, 1440) r(k) LEFT JOIN m ON m.dt = d AND m.mod_ = k)
SELECT minute_of_day, sum(gmv) FILTER (d = DATE '{{day}}')::BIGINT AS gmv,
  round(quantile_cont(gmv, 0.5) FILTER (d < DATE '{{day}}'), 6) AS expected, round(quantile_cont(gmv, 0.1) FILTER (d < DATE '{{day}}'), 6) AS p10,
  round(quantile_cont(gmv, 0.9) FILTER (d < DATE '{{day}}'), 6) AS p90,
  sum(gmv) FILTER (d = DATE '{{day}}') < quantile_cont(gmv, 0.1) FILTER (d < DATE '{{day}}') AS below_band
FROM f GROUP BY 1"""
oracle("a25_gmv_band", BAND.format(day="2024-01-29"))
oracle("e2_gmv_vs_band", BAND.format(day="2024-01-30"))
for name in ("a27_card_testing_economics", "q3_card_testing_devices"):
    oracle(name, """
SELECT device_hash, count(*) AS chains, sum(chain_len)::BIGINT AS test_transactions,
  coalesce(sum(large_amount_vnd) FILTER (decision = 'BLOCK'), 0)::BIGINT AS blocked_vnd,
  coalesce(sum(large_amount_vnd) FILTER (decision <> 'BLOCK'), 0)::BIGINT AS passed_vnd
FROM alerts a JOIN card_attacks USING (transaction_id) JOIN decided d USING (transaction_id)
WHERE a.alert_type = 'CARD_TESTING' GROUP BY device_hash""")
cte("kpi_days", """
SELECT b.dt, m.gmv, m.net_revenue, m.net_revenue / nullif(m.gmv, 0) AS net_take_rate, success_rate, net_fraud_prevented
FROM (SELECT dt, count(*) FILTER (status = 'SUCCESS') / count(*) AS success_rate FROM clean GROUP BY dt) b
LEFT JOIN (SELECT date_day AS dt, sum(gmv)::BIGINT AS gmv, sum(net_revenue)::DOUBLE AS net_revenue FROM merchant_fact GROUP BY 1) m ON m.dt = b.dt
LEFT JOIN (SELECT date_day AS dt, sum(net_loss_prevented_vnd)::DOUBLE AS net_fraud_prevented FROM fraud_fact GROUP BY 1) f ON f.dt = b.dt""")
KPIS = """
SELECT dt::VARCHAR AS date_day, gmv, round(net_revenue, 6) AS net_revenue, round(net_take_rate, 6) AS net_take_rate,
  round(success_rate, 6) AS success_rate, round(net_fraud_prevented, 6) AS net_fraud_prevented,
  gmv - lag(gmv) OVER w AS gmv_delta, round(net_revenue - lag(net_revenue) OVER w, 6) AS net_revenue_delta,
  round(net_take_rate - lag(net_take_rate) OVER w, 6) AS net_take_rate_delta,
  round(success_rate - lag(success_rate) OVER w, 6) AS success_rate_delta,
  round(net_fraud_prevented - lag(net_fraud_prevented) OVER w, 6) AS net_fraud_prevented_delta,
  array_to_string(list(gmv) OVER (ORDER BY dt ROWS BETWEEN 29 PRECEDING AND CURRENT ROW), ',') AS gmv_series
FROM kpi_days WINDOW w AS (ORDER BY dt)"""
oracle("a28_kpi_row", KPIS)
oracle("e1_kpi_row", f"SELECT * FROM ({KPIS}) ORDER BY date_day DESC LIMIT 1")
oracle("a29_index_100", f"""
WITH s AS (SELECT 'GMV' AS series, ms // 3600000 * 3600000 AS hour, sum(amount_vnd)::BIGINT AS value FROM clean WHERE {GMV} GROUP BY 2
  UNION ALL SELECT 'ALERTS', event_ts // 3600000 * 3600000, count(*) FROM alerts GROUP BY 2)
SELECT series, hour, value, round(100 * value / first_value(value) OVER (PARTITION BY series ORDER BY hour), 6) AS index_100 FROM s""")
BEFORE_AFTER = """
WITH d AS (SELECT date_day, rule_type, sum(net_loss_prevented_vnd) AS net, sum(friction_cost_vnd) AS fric
  FROM fraud_fact GROUP BY ALL HAVING avg(label_coverage_rate) >= {cov}),
a AS (SELECT * FROM d WHERE date_day BETWEEN DATE '2024-01-15' AND DATE '2024-01-21'),
b AS (SELECT date_day + 7 AS date_day, rule_type, net AS net_b, fric AS fric_b FROM d
  WHERE date_day BETWEEN DATE '2024-01-08' AND DATE '2024-01-14')
SELECT rule_type, count(*) AS weekday_pairs, sum(coalesce(net, 0) - coalesce(net_b, 0))::DOUBLE AS delta_net_loss_prevented,
  sum(coalesce(fric, 0) - coalesce(fric_b, 0))::DOUBLE AS delta_friction_cost,
  delta_friction_cost > delta_net_loss_prevented AS switch_off
FROM a FULL JOIN b USING (date_day, rule_type) GROUP BY rule_type"""
oracle("w8_rule_before_after", BEFORE_AFTER.format(cov="0"))
oracle("q1_rule_worth", BEFORE_AFTER.format(cov="0.3"))
oracle("q2_vip_wrongly_blocked", """
SELECT user_id, count(*) AS fp_count, sum(amount_vnd)::BIGINT AS amount_vnd,
  round(sum(amount_vnd)::DOUBLE * any_value(gross_margin_rate)::DOUBLE
    + count(*) * any_value(vip_churn_risk)::DOUBLE * any_value(vip_annual_value)::DOUBLE, 2) AS friction_cost_vnd
FROM outcomes, cost_assumptions
WHERE account_tier = 'VIP' AND decision = 'BLOCK' AND NOT is_fraud_confirmed GROUP BY user_id""")
oracle("q4_missed_fraud", """
SELECT channel, industry, count(*) AS missed, sum(amount_vnd)::BIGINT AS amount_vnd
FROM outcomes LEFT JOIN merchant_industry USING (merchant_id)
WHERE is_fraud_confirmed AND transaction_id NOT IN (SELECT transaction_id FROM alerts) GROUP BY ALL""")
oracle("t1_alert_feed", "SELECT * FROM alerts ORDER BY event_ts DESC, alert_id LIMIT 50")
oracle("r1_alert_feed", """
SELECT event_ts, severity, alert_type, transaction_id, user_id FROM (
  SELECT * FROM alerts ORDER BY event_ts DESC, alert_id LIMIT 100)""")
for name in ("t2_top_devices", "r5_suspect_devices"):
    oracle(name, """
SELECT device_hash, count(*) AS alerts, max(event_ts) AS last_alert FROM alerts GROUP BY device_hash
ORDER BY alerts DESC, device_hash LIMIT 10""".replace("AS alerts,", "AS alerts,"))
oracle("e6_prevented_vs_friction", """
SELECT date_day::VARCHAR AS date_day, sum(net_loss_prevented_vnd)::DOUBLE AS net_loss_prevented_vnd,
  sum(friction_cost_vnd)::DOUBLE AS friction_cost_vnd FROM fraud_fact GROUP BY 1""")

RECONCILED = f"""
SELECT dt, gold_gmv, silver_gmv, gold_gmv - silver_gmv AS difference FROM
(SELECT date_day AS dt, sum(gmv)::BIGINT AS gold_gmv FROM merchant_fact GROUP BY 1) FULL JOIN
(SELECT dt, coalesce(sum(amount_vnd) FILTER ({GMV}), 0)::BIGINT AS silver_gmv FROM clean GROUP BY 1) USING (dt)"""
oracle("j12_layer_reconciliation", f"SELECT * REPLACE (dt::VARCHAR AS dt) FROM ({RECONCILED})")
oracle("qf_gmv_mismatch", f"SELECT dt::VARCHAR AS dt, gold_gmv, silver_gmv FROM ({RECONCILED}) WHERE difference <> 0")
oracle("a13_refreshed_by_late_rows", f"""
WITH early AS (SELECT dt, coalesce(sum(amount_vnd) FILTER ({GMV}), 0)::BIGINT AS gmv FROM ontime_clean GROUP BY 1)
SELECT r.dt::VARCHAR AS dt, r.silver_gmv AS gold_gmv, r.silver_gmv, 0::BIGINT AS difference,
  r.dt IN (SELECT c.dt FROM clean c JOIN arrivals a ON a.transaction_id = c.transaction_id WHERE a.late) AS rewritten,
  e.gmv IS DISTINCT FROM r.silver_gmv AS was_wrong,
  CASE WHEN e.gmv IS DISTINCT FROM r.silver_gmv THEN e.gmv END AS gold_gmv_before
FROM ({RECONCILED}) r LEFT JOIN early e ON e.dt = r.dt""")
oracle("m4_layers_meet", f"""
SELECT sum(gold_gmv)::BIGINT AS gold_gmv, sum(silver_gmv)::BIGINT AS silver_gmv, count(*) FILTER (difference <> 0) AS days_off
FROM ({RECONCILED})""")

oracle("qa_unique_bronze", "SELECT transaction_id, count(*) AS copies FROM payments GROUP BY 1 HAVING count(*) > 1")
oracle("qa_unique_silver", "SELECT transaction_id, count(*) AS copies FROM clean GROUP BY 1 HAVING count(*) > 1")
oracle("qa_not_null", """
SELECT * FROM (SELECT 'account_tier' AS column_name, count(*) - count(account_tier) AS nulls FROM enriched
  UNION ALL SELECT 'amount_vnd', count(*) - count(amount_vnd) FROM enriched) WHERE nulls > 0""")
oracle("qb_accepted_values", """
WITH rows AS (SELECT CASE WHEN ms % 97 = 5 THEN 'REVERSED' ELSE status END AS status, channel, account_tier FROM enriched),
cells AS (SELECT unnest([{'c': 'status', 'v': status}, {'c': 'channel', 'v': channel}, {'c': 'account_tier', 'v': account_tier}]) AS x FROM rows)
SELECT x.c AS column_name, x.v AS value, count(*) AS rows FROM cells
WHERE (x.c = 'status' AND x.v NOT IN ('SUCCESS', 'FAILED', 'PENDING')) OR (x.c = 'channel' AND x.v NOT IN ('WEB', 'APP', 'POS'))
  OR (x.c = 'account_tier' AND x.v NOT IN ('BRONZE', 'SILVER', 'GOLD', 'VIP')) GROUP BY ALL""")
oracle("qb_lifecycle_states", """
SELECT 'state' AS column_name, state AS value, count(*) AS rows FROM life_states 
WHERE state NOT IN ('HIGH_RISK_SUSPENDED', 'NEW', 'CHURNED', 'DORMANT', 'AT_RISK', 'HIGHLY_ACTIVE', 'ACTIVE') GROUP BY state""")
oracle("qc_relationships", """
SELECT merchant_id, count(*) AS rows FROM merchant_fact WHERE merchant_id NOT IN (SELECT merchant_id FROM merchant_industry) GROUP BY 1""")
oracle("qd_merchant_invariants", """
SELECT date_day::VARCHAR AS date_day, merchant_id, gmv, refund_amount, gross_revenue::DOUBLE AS gross_revenue,
  net_revenue::DOUBLE AS net_revenue FROM merchant_fact
WHERE net_revenue > gross_revenue OR take_rate > 0.1 OR take_rate < 0 OR refund_amount > gmv""")
oracle("qe_fpr_range", """
SELECT date_day::VARCHAR AS date_day, rule_type, account_tier, channel FROM fraud_fact
WHERE false_positive_rate < 0 OR false_positive_rate > 1""")
oracle("qh_freshness", """
SELECT * FROM (SELECT max(ingested_ms) AS last_ingested FROM payments)
WHERE last_ingested < epoch_ms(TIMESTAMP '2024-01-31 12:00:00') - 900000""")
oracle("q_holdout_contamination", """
SELECT c.user_id, count(*) AS rows FROM clean c JOIN holdout h ON c.user_id = h.user_id
WHERE c.experiment_group <> h.grp GROUP BY 1""")

MEET = """
SELECT dt::VARCHAR AS dt, coalesce(a, 0)::BIGINT AS points_stream, coalesce(b, 0)::BIGINT AS points_batch,
  (coalesce(a, 0) - coalesce(b, 0))::BIGINT AS difference,
  round(abs(coalesce(a, 0) - coalesce(b, 0)) / nullif(coalesce(b, 0), 0), 6) AS relative,
  coalesce(abs(coalesce(a, 0) - coalesce(b, 0)) / nullif(coalesce(b, 0), 0) < 0.005, coalesce(a, 0) = coalesce(b, 0)) AS ok
FROM (SELECT dt, sum(points) AS a FROM ontime_points_of GROUP BY dt) FULL JOIN
     (SELECT dt, sum(points) AS b FROM points_of GROUP BY dt) USING (dt)"""
oracle("qg_points_reconciliation", MEET)
oracle("m3_points_meet", f"""
SELECT sum(points_stream)::BIGINT AS points_stream, sum(points_batch)::BIGINT AS points_batch,
  round(abs(sum(points_stream) - sum(points_batch)) / sum(points_batch), 6) AS relative FROM ({MEET})""")

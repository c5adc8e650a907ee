"""Twins of sources, projections, joins, windows and detectors."""

from __future__ import annotations

from oracle import core  # noqa: F401
from oracle.ctes import CRC32
from oracle.texts import oracle
from tillwatch import testbed as tb

BROKEN = "ms % 500 = 3"

oracle("s3_parse_json", f"""
SELECT dt::VARCHAR AS dt, count(*) FILTER (NOT {BROKEN}) AS parsed, count(*) FILTER ({BROKEN}) AS quarantined
FROM payments GROUP BY dt""")
oracle("s5_bronze_layout", """
SELECT dt::VARCHAR AS dt, count(*) AS rows, sum(amount)::BIGINT AS amount, 1::BIGINT AS files, count(*) AS rows_in_files
FROM payments GROUP BY dt""")
oracle("s9_lake_scan", """
SELECT dt::VARCHAR AS dt, channel, count(*) AS rows, sum(amount)::BIGINT AS amount FROM payments
WHERE dt BETWEEN DATE '2024-01-05' AND DATE '2024-01-08' GROUP BY dt, channel""")
oracle("s10_seed_scan", """
SELECT industry, channel, count(*) AS rows, max(take_rate)::DOUBLE AS take_rate,
  max(rate)::DOUBLE AS interchange_rate, max(rate_to_vnd)::DOUBLE AS max_fx
FROM payments p JOIN fx_rate f ON f.date = p.dt AND f.currency = p.currency
JOIN merchant_industry m USING (merchant_id) JOIN take_rate USING (industry) JOIN interchange_rate USING (channel)
GROUP BY industry, channel""")
PUBLIC = """user_id, full_name, kyc_status, account_tier, round(risk_score_baseline, 6) AS risk_score_baseline,
  home_country"""
ISO = "strftime(make_timestamp(changed_ms * 1000), '%Y-%m-%dT%H:%M:%S.%gZ')"
oracle("s11_cdc_scan", f"SELECT {PUBLIC}, {ISO} AS updated_at FROM profiles")
# the plain topic knows no deletes: a deleted user keeps the last published row
oracle("s12_compacted_profiles", f"""
SELECT user_id, account_tier, kyc_status, {ISO} AS updated_at FROM profile_changes
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY changed_ms DESC) = 1""")
oracle("s13_ground_truth", "SELECT fraud_type, transaction_id FROM injected")
oracle("s14_rules_source", """
SELECT rule_id, version, priority, action, max_amount_vnd FROM rule_changes
QUALIFY row_number() OVER (PARTITION BY rule_id ORDER BY version DESC) = 1 AND enabled AND op <> 'd'""")
oracle("s15_fraud_labels", """
SELECT label_source, datediff('day', make_timestamp(ms * 1000)::DATE, make_timestamp(resolved_ms * 1000)::DATE) AS delay_days,
  count(*) AS labels, count(*) FILTER (is_fraud_confirmed) AS confirmed
FROM clean JOIN labels_t USING (transaction_id) GROUP BY ALL""")
oracle("s15_redemptions", """
SELECT user_id, count(*) AS redemptions, sum(points_spent)::BIGINT AS points_spent FROM redemptions GROUP BY user_id""")

oracle("p1_event_time", f"""
SELECT transaction_id, ms AS event_ms, ingested_ms AS ingested_at FROM payments WHERE NOT ({BROKEN})""")
oracle("p2_profile_projection", f"SELECT {PUBLIC}, changed_ms AS updated_at FROM profile_changes")
oracle("p3_enrich_projection", """
SELECT transaction_id, account_tier, kyc_status, round(risk_score_baseline, 6) AS risk_score_baseline,
  profile_missing FROM enriched""")
oracle("p4_serialise", """
SELECT transaction_id, concat('{"transaction_id":"', transaction_id, '"', ',"account_tier":"' || account_tier || '"',
  ',"kyc_status":"' || kyc_status || '"', ',"risk_score_baseline":' || risk_score_baseline::VARCHAR,
  ',"profile_missing":', profile_missing::VARCHAR, '}') AS value FROM enriched""")
WINNER = """
SELECT rule_id, rule_type, action AS decision, count(*) AS txns FROM (
  SELECT * FROM rule_matches WHERE {cond}
  QUALIFY row_number() OVER (PARTITION BY transaction_id ORDER BY priority DESC, version DESC, rule_id DESC) = 1)
GROUP BY rule_id, rule_type, action"""
oracle("p5_scope_match", WINNER.format(
    cond="rule_id IN (SELECT rule_id FROM live_rules WHERE scope IS NOT NULL)"))
oracle("p6_rule_active", WINNER.format(cond="rule_id IN ('R-014', 'R-030', 'R-070')"))
oracle("p7_rule_predicates", """
SELECT rule_id, rule_type, action AS decision, count(*) AS txns FROM (
  SELECT * FROM rule_matches QUALIFY row_number() OVER (
    PARTITION BY transaction_id, rule_type ORDER BY priority DESC, version DESC, rule_id DESC) = 1)
GROUP BY rule_id, rule_type, action""")
oracle("p8_device_hash", """
SELECT sha256(concat(device_id, 'test-salt')) AS device_hash, count(*) AS rows FROM payments GROUP BY 1""")
oracle("p9_ip_mask", r"""
SELECT regexp_replace(ip_address, '\.[^.]+$', '.x') AS ip_network, count(*) AS rows FROM payments GROUP BY 1""")
oracle("p10_loyalty_eligible", """
SELECT dt::VARCHAR AS dt, count(*) AS txns, sum(amount_vnd)::BIGINT AS amount_vnd FROM decided
WHERE decision <> 'BLOCK' AND status IN ('SUCCESS', 'PENDING') AND txn_type = 'PAYMENT' GROUP BY dt""")
oracle("p12_kyc_abuse", """
SELECT transaction_id, user_id, amount_vnd, 'R-001' AS rule_id FROM enriched
WHERE kyc_status = 'UNVERIFIED' AND amount_vnd >= 2500000 AND ms >= epoch_ms(TIMESTAMP '2024-01-01')""")
oracle("p13_vip", """
SELECT user_id, count(*) AS txns, sum(amount_vnd)::BIGINT AS amount_vnd FROM enriched
WHERE account_tier = 'VIP' GROUP BY user_id""")
oracle("p14_holdout", f"""
SELECT user_id, CASE WHEN ({CRC32}) % 10 = 0 THEN 'CONTROL' ELSE 'TREATMENT' END AS experiment_group
FROM (SELECT DISTINCT user_id FROM payments)""")

ENRICHED = """transaction_id, user_id, ms AS event_ts, amount_vnd, account_tier, kyc_status,
  round(risk_score_baseline, 6) AS risk_score_baseline, home_country, profile_missing"""
oracle("j1_enrich", f"SELECT {ENRICHED} FROM enriched")
oracle("j2_enrich_as_of", f"SELECT {ENRICHED} FROM enriched_as_of")
oracle("j3_rule_join", "SELECT transaction_id, decision, rule_id, rule_type FROM decided")
oracle("j4_fx", """
SELECT transaction_id, dt::VARCHAR AS dt, currency, amount, rate_to_vnd::DOUBLE AS rate_to_vnd, amount_vnd FROM clean""")
oracle("j5_seed_joins", """
SELECT industry, channel, take_rate::DOUBLE AS take_rate, rate::DOUBLE AS interchange_rate, count(*) AS txns,
  sum(amount_vnd)::BIGINT AS amount_vnd
FROM clean LEFT JOIN merchant_industry USING (merchant_id) LEFT JOIN take_rate USING (industry)
LEFT JOIN interchange_rate USING (channel) GROUP BY ALL""")
oracle("j7_alerts_labels", """
SELECT transaction_id, account_tier, decision, flagged, array_to_string(kinds, ',') AS kinds, is_fraud_confirmed,
  label_source FROM outcomes""")
oracle("j8_missed_fraud", """
SELECT l.transaction_id, label_source, merchant_id, channel, amount_vnd, dt::VARCHAR AS dt
FROM labels_t l JOIN clean c ON c.transaction_id = l.transaction_id
WHERE is_fraud_confirmed AND l.transaction_id NOT IN (SELECT transaction_id FROM alerts)""")
oracle("j9_fp_proxy", """
SELECT b.transaction_id, b.user_id, b.merchant_id, b.ms AS event_ts, b.amount_vnd, min(s.ms) - b.ms AS retry_after_ms
FROM decided b JOIN decided s ON s.user_id = b.user_id AND s.merchant_id = b.merchant_id
  AND s.ms > b.ms AND s.ms <= b.ms + 1800000 AND s.status = 'SUCCESS' AND s.decision <> 'BLOCK'
WHERE b.decision = 'BLOCK' GROUP BY b.transaction_id, b.user_id, b.merchant_id, b.ms, b.amount_vnd""")
oracle("j10_refund_links", """
SELECT r.original_txn_id, r.transaction_id, r.merchant_id, r.amount_vnd, o.amount_vnd AS original_vnd,
  o.transaction_id IS NULL AS orphan
FROM clean r LEFT JOIN clean o ON r.original_txn_id = o.transaction_id WHERE r.txn_type = 'REFUND'""")
oracle("j11_relationships", """
SELECT user_id, count(*) AS rows FROM clean WHERE user_id NOT IN (SELECT user_id FROM profiles) GROUP BY user_id""")
oracle("j13_detector_recall", """
SELECT fraud_type, count(*) AS attacks, count(*) FILTER (hit) AS detected,
  round(count(*) FILTER (hit) / count(*), 6) AS recall
FROM (SELECT fraud_type, split_part(transaction_id, '-', 1) AS attack,
        bool_or(transaction_id IN (SELECT transaction_id FROM alerts)) AS hit
      FROM injected GROUP BY ALL) GROUP BY fraud_type""")
oracle("j14_lineage", """
SELECT transaction_id, true AS in_topic, transaction_id IN (SELECT transaction_id FROM alerts) AS in_alerts,
  transaction_id IN (SELECT transaction_id FROM alerts WHERE severity = 'CRITICAL') AS in_feed,
  true AS in_bronze, transaction_id IN (SELECT transaction_id FROM clean) AS in_silver,
  transaction_id IN (SELECT transaction_id FROM outcomes) AS in_mart
FROM (SELECT DISTINCT transaction_id FROM payments)""")

oracle("w1_dedup", """
SELECT transaction_id, user_id, amount, currency, ms AS event_ts, max(ingested_ms) AS ingested_at, status
FROM payments GROUP BY ALL""")
oracle("w2_impossible_travel", """
SELECT transaction_id, user_id, ms AS event_ts, prev_transaction_id, round(km, 3) AS km, gap_ms FROM travel""")
oracle("w3_gaps", """
SELECT user_id, count(gap) AS gaps, sum(gap)::BIGINT AS total_ms, max(gap) AS longest_ms
FROM (SELECT user_id, ms - lag(ms) OVER (PARTITION BY user_id ORDER BY ms, transaction_id) AS gap FROM activity)
GROUP BY user_id HAVING count(gap) > 0""")
oracle("w4_trailing_15m", """
SELECT transaction_id, user_id, ms AS event_ts, total_15m FROM points_of WHERE eligible""")
oracle("w5_card_testing", "SELECT * FROM card_attacks")
oracle("w5_card_testing_evidence", """
SELECT device_id, alert_txn, transaction_id, ms AS event_ts, amount_vnd FROM chains WHERE chain_len >= 5""")
oracle("w7_points_overspent", """
WITH moves AS (
  SELECT user_id, dt AS date_day, points AS plus, 0 AS minus FROM points_of
  UNION ALL SELECT user_id, make_timestamp(ms * 1000)::DATE, 0, points_spent FROM redemptions),
days AS (SELECT user_id, date_day, sum(plus) AS plus, sum(minus) AS minus FROM moves GROUP BY ALL)
SELECT * FROM (
  SELECT user_id, date_day::VARCHAR AS date_day, (sum(plus) OVER w)::BIGINT AS issued_to_date,
    (sum(minus) OVER w)::BIGINT AS redeemed_to_date
  FROM days WINDOW w AS (PARTITION BY user_id ORDER BY date_day)) WHERE redeemed_to_date > issued_to_date""")
oracle("w9_arrival_watermark", """
SELECT transaction_id, ingested_ms AS ingested_at, src_partition,
  max(ms) OVER (PARTITION BY src_partition ORDER BY ingested_ms RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS max_seen_ms,
  coalesce(ms < max_seen_ms, false) AS out_of_order, coalesce(ms < max_seen_ms - 10000, false) AS late
FROM payments""")

oracle("u1_merge_late", """
SELECT dt::VARCHAR AS dt, count(*) AS txns, count(*) FILTER (late) AS late_txns, sum(amount_vnd)::BIGINT AS amount_vnd
FROM (
  SELECT a.*, c.amount_vnd FROM arrivals a JOIN clean c
  ON a.transaction_id = c.transaction_id AND a.ingested_ms = c.ingested_ms)
GROUP BY dt""")
oracle("u2_alert_stream", "SELECT * FROM alerts")

oracle("x4_late_classification", """
SELECT transaction_id, ms AS event_ts, ingested_ms AS ingested_at, max_seen_ms, out_of_order, late FROM arrivals""")
oracle("x7_rules_not_ready", "SELECT 'PASS' AS decision, true AS rules_not_ready, count(*) AS txns FROM enriched")
oracle("x8_rule_engine", """
SELECT transaction_id, user_id, ms AS event_ts, amount_vnd, decision, rule_id, rule_type, false AS rules_not_ready
FROM decided""")
oracle("x11_loyalty_points", """
SELECT transaction_id, user_id, amount_vnd, total_15m, multiplier::BIGINT AS multiplier, points::BIGINT AS points
FROM points_of WHERE eligible""")
oracle("x12_sliding_sums", """
SELECT user_id, (ms // 60000 - k) * 60000 AS window_start, sum(amount_vnd)::BIGINT AS total
FROM points_of, range(0, 15) g(k) WHERE eligible GROUP BY ALL""")

# ---- streams -----------------------------------------------------------------------------------

oracle("s1_read_payment_events", """
SELECT src_partition AS partition, count(*) AS records, count(DISTINCT user_id) AS keys FROM payments GROUP BY 1""")
oracle("s2_read_user_profiles", "SELECT op, count(*) AS records FROM profile_changes GROUP BY op")
oracle("s4_land_bronze", f"""
SELECT CASE WHEN {BROKEN} THEN 'quarantine' ELSE 'event' END AS kind,
  (CASE WHEN {BROKEN} THEN make_timestamp(ingested_ms * 1000)::DATE ELSE dt END)::VARCHAR AS dt, count(*) AS rows
FROM payments GROUP BY ALL""")
oracle("s7_topic_sinks", """
SELECT 'blocked_transactions' AS route, count(*) AS records FROM ok_decided WHERE decision = 'BLOCK'
UNION ALL SELECT 'fraud_alerts', count(*) FROM ok_alerts
UNION ALL SELECT 'loyalty_points', count(*) FROM ok_points_of WHERE eligible
UNION ALL SELECT 'stream_metrics', 1""")
oracle("s8_serving_sink", """
SELECT ms // 60000 * 60000 AS minute, coalesce(sum(amount_vnd) FILTER (status = 'SUCCESS' AND txn_type = 'PAYMENT'), 0)::BIGINT AS gmv,
  count(*) AS txns, count(*) FILTER (status = 'SUCCESS') AS succeeded FROM ok_clean GROUP BY 1""")
oracle("s16_keyed_producer", """
SELECT user_id AS key, count(*) AS records, 1::BIGINT AS partitions FROM payments GROUP BY 1""")
oracle("x2_silent_partition", f"""
WITH sent AS (SELECT *, {tb.SILENT_ARRIVAL_MS} AS arrived FROM payments WHERE ms % 500 <> 3),
grid AS (
  SELECT i.arrived, p.src_partition, max(r.ms) AS ms, max(r.arrived) AS seen
  FROM (SELECT DISTINCT arrived FROM sent) i CROSS JOIN (SELECT DISTINCT src_partition FROM sent) p
  LEFT JOIN sent r ON r.arrived = i.arrived AND r.src_partition = p.src_partition GROUP BY ALL),
carried AS (
  SELECT arrived, max(ms) OVER w AS top, max(seen) OVER w AS last FROM grid
  WINDOW w AS (PARTITION BY src_partition ORDER BY arrived ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
newest AS (SELECT *, max(last) OVER (PARTITION BY arrived) AS newest FROM carried),
smallest AS (SELECT arrived, min(top) FILTER (last >= least(arrived - 30000, newest)) - 10000 AS mark FROM newest GROUP BY arrived),
marks AS (SELECT arrived, max(mark) OVER (ORDER BY arrived) AS watermark_ms FROM smallest)
SELECT transaction_id, src_partition, arrived AS ingested_at, watermark_ms, coalesce(ms < watermark_ms, false) AS late
FROM sent JOIN marks USING (arrived)""")
oracle("x3_late_side_output", """
WITH runs AS (SELECT *, CASE WHEN ingested_ms >= epoch_ms(TIMESTAMP '2024-01-21') THEN 2
    WHEN ingested_ms >= epoch_ms(TIMESTAMP '2024-01-11') OR src_partition = 5 THEN 1 ELSE 0 END AS run FROM ok_payments),
first_seen AS (SELECT transaction_id, any_value(ms) AS ms, min(run) AS run FROM runs GROUP BY 1),
tops AS (SELECT run, max(max(ms)) OVER (ORDER BY run ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS top FROM runs GROUP BY run)
SELECT transaction_id, ms AS event_ts FROM first_seen JOIN tops USING (run) WHERE ms < top - 10000""")
oracle("x6_rules_arrive_later", """
WITH runs AS (SELECT transaction_id, min(ingested_ms) < epoch_ms(TIMESTAMP '2024-01-21') AS early FROM ok_payments GROUP BY 1)
SELECT early AS rules_not_ready, CASE WHEN early THEN 'PASS' ELSE decision END AS decision, count(*) AS txns
FROM ok_decided JOIN runs USING (transaction_id) GROUP BY ALL""")
PIECE = "greatest(0, least(3, floor(({at} - 1704067200000) / 691200000.0)::BIGINT))"
oracle("s14_rules_topic", f"""
WITH last AS (
  SELECT * FROM rule_changes JOIN ev ON ev.id = version WHERE NOT ({tb.RULE_BROKEN})
  QUALIFY row_number() OVER (PARTITION BY rule_id ORDER BY ms0 DESC, version DESC) = 1)
SELECT 'rule' AS kind, rule_id AS id, version, action, enabled, max_amount_vnd::VARCHAR AS max_amount_vnd FROM last WHERE op <> 'd'
UNION ALL SELECT 'quarantine', rule_id, count(*), NULL, NULL, NULL FROM rule_changes JOIN ev ON ev.id = version
  WHERE {tb.RULE_BROKEN} GROUP BY rule_id""")
oracle("s12_profiles_topic", """
SELECT user_id, account_tier, kyc_status, 0::BIGINT AS unreadable FROM profiles WHERE user_id NOT LIKE '%7'
UNION ALL SELECT user_id, NULL, NULL, count(*) FROM profile_changes WHERE user_id LIKE '%7' GROUP BY user_id""")
# every label record with its arrival, older ones of revised labels included
ALL_LABELS = f"""
SELECT transaction_id, {', '.join(f'{e} AS {n}' for n, e in tb.LABEL.items())} FROM expanded, (VALUES (0), (1)) o(old)
WHERE ({tb.LABEL_PRESENT}) AND (old = 0 OR {tb.REVISED})"""
oracle("s15_labels_topic", f"""
SELECT label_source AS kind, count(*) AS records, count(*) FILTER (is_fraud_confirmed) AS confirmed FROM labels_t GROUP BY 1
UNION ALL SELECT 'quarantine', count(*), NULL FROM ({ALL_LABELS}) WHERE {tb.LABEL_CUT}""")
oracle("s15_redemptions_topic", f"""
SELECT redemption_id, user_id, points_spent, ms AS event_ts, 0::BIGINT AS unreadable FROM redemptions
UNION ALL SELECT concat('D', id), NULL, NULL, NULL, (CASE WHEN {tb.REDEEMED_TWICE} THEN 2 ELSE 1 END)::BIGINT
FROM (SELECT *, ms0 AS ms FROM ev) WHERE ({tb.REDEMPTION_CONDITION}) AND {tb.REDEMPTION_CUT}""")
oracle("a6_refreshed_by_labels", f"""
WITH runs AS (
  SELECT c.dt, max(CASE WHEN resolved_ms >= epoch_ms(TIMESTAMP '2024-02-22') THEN 2
    WHEN resolved_ms >= epoch_ms(TIMESTAMP '2024-01-19') THEN 1 ELSE 0 END) AS run
  FROM ({ALL_LABELS}) l JOIN clean c ON c.transaction_id = l.transaction_id GROUP BY c.dt)
SELECT f.* REPLACE (date_day::VARCHAR AS date_day, round(false_positive_rate, 6) AS false_positive_rate,
  round(precision, 6) AS precision, round(recall, 6) AS recall, friction_cost_vnd::DOUBLE AS friction_cost_vnd,
  net_loss_prevented_vnd::DOUBLE AS net_loss_prevented_vnd, round(label_coverage_rate, 6) AS label_coverage_rate),
  coalesce(r.run, 0)::BIGINT AS refreshed_in
FROM fraud_fact f LEFT JOIN runs r ON r.dt = f.date_day""")
oracle("x6_rules_topic", f"""
WITH changed AS (
  SELECT r.*, ms0, {PIECE.format(at='ms0')} AS piece FROM rule_changes r JOIN ev ON ev.id = version WHERE NOT ({tb.RULE_BROKEN})),
pieces AS (SELECT unnest(range(4)) AS piece),
books AS (
  SELECT p.piece, c.* EXCLUDE (piece) FROM pieces p JOIN changed c ON c.piece <= p.piece
  QUALIFY row_number() OVER (PARTITION BY p.piece, rule_id ORDER BY ms0 DESC, version DESC) = 1),
live AS (SELECT * FROM books WHERE op <> 'd' AND enabled),
arrived AS (SELECT transaction_id, min({PIECE.format(at='ingested_ms')}) AS piece FROM ok_payments GROUP BY 1),
tops AS (
  SELECT p.piece, max(ms) AS top FROM pieces p JOIN ok_payments o ON {PIECE.format(at='ingested_ms')} <= p.piece GROUP BY p.piece),
judged AS (
  SELECT c.transaction_id, c.ms, c.amount_vnd,
    coalesce((SELECT min(t.piece) FROM tops t WHERE t.piece >= a.piece AND c.ms < t.top - 10000), 3) AS piece
  FROM ok_clean c JOIN arrived a ON a.transaction_id = c.transaction_id),
best AS (
  SELECT j.transaction_id, rule_id, action FROM judged j JOIN live l ON l.piece = j.piece AND l.ms0 <= j.ms AND j.amount_vnd > l.max_amount_vnd
  QUALIFY row_number() OVER (PARTITION BY j.transaction_id ORDER BY priority DESC, version DESC, rule_id DESC) = 1)
SELECT j.transaction_id, coalesce(action, 'PASS') AS decision, rule_id, NOT EXISTS (FROM live l WHERE l.piece = j.piece) AS rules_not_ready
FROM judged j LEFT JOIN best b ON b.transaction_id = j.transaction_id""")
oracle("u1_silver_merge", """
WITH runs AS (SELECT *, CASE WHEN ingested_ms >= epoch_ms(TIMESTAMP '2024-01-21') THEN 2
    WHEN ingested_ms >= epoch_ms(TIMESTAMP '2024-01-11') OR src_partition = 5 THEN 1 ELSE 0 END AS run FROM ok_payments),
first_seen AS (SELECT transaction_id, any_value(ms) AS ms, min(run) AS run FROM runs GROUP BY 1),
tops AS (SELECT run, max(max(ms)) OVER (ORDER BY run ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS top FROM runs GROUP BY run)
SELECT dt::VARCHAR AS dt, count(*) AS txns, sum(amount_vnd)::BIGINT AS amount_vnd,
  count(*) FILTER (coalesce(f.ms < top - 10000, false)) > 0 AS rewritten
FROM ok_clean c JOIN first_seen f ON f.transaction_id = c.transaction_id JOIN tops USING (run) GROUP BY dt""")
oracle("x8_stream_decisions", "SELECT transaction_id, decision, rule_id, rule_type FROM ok_decided")
oracle("x9_card_testing_stream", """
SELECT device_id, alert_txn AS transaction_id, b_ms AS event_ms, large_amount_vnd, chain_len,
  min(ms) OVER (PARTITION BY alert_txn) AS chain_start_ms, transaction_id AS evidence_id FROM chains
WHERE chain_len >= 5""")
oracle("x10_travel_stream", """
SELECT user_id, transaction_id, ms AS event_ms, prev_transaction_id, round(km, 3) AS km, gap_ms FROM travel""")
oracle("x11_stream_points", """
SELECT transaction_id, total_15m, multiplier::BIGINT AS multiplier, points::BIGINT AS points FROM ok_points_of WHERE eligible""")
oracle("x12_sliding_stream", """
SELECT user_id, (ms // 60000 - k) * 60000 AS window_start, sum(amount_vnd)::BIGINT AS total
FROM points_of, range(0, 15) g(k) WHERE eligible GROUP BY ALL""")
# Positions are forgotten a day after, streaks two minutes after their first failure.
oracle("x13_state_ttl", """
WITH stop AS (SELECT max(ms) AS cut FROM clean WHERE transaction_id LIKE 'C%-3'),
phases AS (SELECT phase, cut - 10000 + later AS mark, cut FROM stop,
  (VALUES ('stopped', 0::BIGINT), ('ten minutes', 600000), ('a day', 86400000)) p(phase, later)),
seen AS (SELECT phase, mark, c.* FROM phases, clean c WHERE ms <= cut AND ms < mark),
positions AS (
  SELECT * FROM seen QUALIFY row_number() OVER (PARTITION BY phase, user_id ORDER BY ms DESC, transaction_id DESC) = 1),
small AS (
  SELECT *, coalesce(status = 'FAILED' AND amount_vnd < 20000, false) AS small,
    max(CASE WHEN NOT coalesce(status = 'FAILED' AND amount_vnd < 20000, false) THEN (ms, transaction_id) END)
      OVER (PARTITION BY phase, device_id) AS broken FROM seen),
streaks AS (
  SELECT *, min(ms) OVER (PARTITION BY phase, device_id) AS first_ms FROM small
  WHERE small AND (broken IS NULL OR (ms, transaction_id) > broken))
SELECT 'travel' AS detector, phase, user_id AS id, transaction_id, ms FROM positions WHERE ms + 86400000 >= mark
UNION ALL SELECT 'card', phase, device_id, transaction_id, ms FROM streaks WHERE first_ms + 120000 >= mark""")
oracle("x14_resume", "SELECT dt::VARCHAR AS dt, count(*) AS txns, count(*) AS distinct_txns FROM ok_clean GROUP BY dt")
oracle("x15_live_metrics", """
WITH seen AS (SELECT *, max(ms) OVER (ORDER BY ingested_ms RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS top FROM ok_clean)
SELECT count(*) AS events, round(quantile_cont(ingested_ms - ms, 0.5), 6) AS lag_p50_ms,
  round(quantile_cont(ingested_ms - ms, 0.95), 6) AS lag_p95_ms, round(quantile_cont(ingested_ms - ms, 0.99), 6) AS lag_p99_ms,
  0::DOUBLE AS late_rate, round(avg(coalesce(ms < top, false)::INTEGER), 6) AS out_of_order_rate,
  max(ingested_ms) - max(ms) + 10000 AS watermark_lag_ms FROM seen""")
oracle("x15_metrics_by_batch", """
WITH runs AS (SELECT *, CASE WHEN ingested_ms >= epoch_ms(TIMESTAMP '2024-01-21') THEN 2
    WHEN ingested_ms >= epoch_ms(TIMESTAMP '2024-01-11') OR src_partition = 5 THEN 1 ELSE 0 END AS run FROM ok_payments),
tops AS (SELECT run, max(max(ms)) OVER (ORDER BY run ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS top FROM runs GROUP BY run),
fresh AS (SELECT * FROM runs QUALIFY row_number() OVER (PARTITION BY transaction_id ORDER BY run, ingested_ms DESC) = 1),
seen AS (
  SELECT f.*, top, max(ms) OVER (PARTITION BY run ORDER BY ingested_ms RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS inside
  FROM fresh f JOIN tops USING (run))
SELECT run AS batch_id, count(*) AS events, round(quantile_cont(ingested_ms - ms, 0.5), 6) AS lag_p50_ms,
  round(quantile_cont(ingested_ms - ms, 0.95), 6) AS lag_p95_ms, round(quantile_cont(ingested_ms - ms, 0.99), 6) AS lag_p99_ms,
  round(avg(coalesce(ms < top - 10000, false)::INTEGER), 6) AS late_rate,
  round(avg(coalesce(ms < inside OR ms < top, false)::INTEGER), 6) AS out_of_order_rate,
  max(ingested_ms) - max(greatest(ms, coalesce(top, ms))) + 10000 AS watermark_lag_ms FROM seen GROUP BY run""")
oracle("x8_micro_batches", """
SELECT 'decision' AS kind, transaction_id AS id, concat(decision, ' ', coalesce(rule_id, '-')) AS value FROM steady_decided
UNION ALL SELECT 'alert', alert_id, severity FROM steady_alerts
UNION ALL SELECT 'points', transaction_id, concat(total_15m, ' ', points::BIGINT) FROM steady_points_of WHERE eligible
UNION ALL SELECT 'minute', (ms // 60000 * 60000)::VARCHAR, concat(count(*), ' ',
  coalesce(sum(amount_vnd) FILTER (status = 'SUCCESS' AND txn_type = 'PAYMENT'), 0)::BIGINT) FROM steady_clean GROUP BY ms // 60000""")

"""Pipeline stages every twin builds on: clean rows, enrichment, decisions, alerts, points."""

from __future__ import annotations

import re

from oracle.ctes import CTES, cte

DAY = 86400000

cte("clean", """
SELECT p.*, f.rate_to_vnd, cast(round(amount::DECIMAL(19,0) * rate_to_vnd) AS BIGINT) AS amount_vnd
FROM (SELECT * FROM payments
      QUALIFY row_number() OVER (PARTITION BY transaction_id ORDER BY ingested_ms DESC) = 1) p
LEFT JOIN fx_rate f ON f.date = p.dt AND f.currency = p.currency""")

cte("enriched", """
SELECT c.*, account_tier, kyc_status, risk_score_baseline, home_country,
  p.user_id IS NULL AS profile_missing
FROM clean c LEFT JOIN profiles p ON c.user_id = p.user_id""")

cte("enriched_as_of", """
SELECT c.*, CASE WHEN h.op <> 'd' THEN account_tier END AS account_tier,
  CASE WHEN h.op <> 'd' THEN kyc_status END AS kyc_status,
  CASE WHEN h.op <> 'd' THEN risk_score_baseline END AS risk_score_baseline,
  CASE WHEN h.op <> 'd' THEN home_country END AS home_country,
  h.op IS NULL OR h.op = 'd' AS profile_missing
FROM clean c LEFT JOIN (
  SELECT *, coalesce(lead(changed_ms) OVER (PARTITION BY user_id ORDER BY changed_ms), 9e15) AS until_ms
  FROM profile_changes) h
ON c.user_id = h.user_id AND c.ms >= h.changed_ms AND c.ms < h.until_ms""")

cte("velocity", """
SELECT transaction_id, count(*) OVER (PARTITION BY user_id ORDER BY ms
  RANGE BETWEEN 899999 PRECEDING AND CURRENT ROW) AS n FROM clean""")

# Every (transaction, rule) pair that matches; the scope is checked key by key.
cte("rule_matches", """
SELECT e.transaction_id, r.rule_id, r.rule_type, r.action, r.priority, r.version
FROM enriched e JOIN velocity v ON e.transaction_id = v.transaction_id
JOIN live_rules r ON r.effective_from <= e.ms
WHERE (r.scope IS NULL OR (
    (r.scope['account_tier'] IS NULL OR r.scope['account_tier'] = e.account_tier)
    AND (r.scope['channel'] IS NULL OR r.scope['channel'] = e.channel)
    AND (r.scope['kyc_status'] IS NULL OR r.scope['kyc_status'] = e.kyc_status)))
  AND CASE r.rule_type
    WHEN 'AMOUNT_THRESHOLD' THEN e.amount_vnd > cast(r.params['max_amount_vnd'] AS BIGINT)
    WHEN 'COUNTRY_BLOCK' THEN e.home_country = r.params['country']
    WHEN 'DEVICE_BLACKLIST' THEN list_contains(string_split(r.params['device_ids'], ','), e.device_id)
    WHEN 'VELOCITY' THEN v.n > cast(r.params['max_count'] AS BIGINT)
    WHEN 'CHANNEL_BLOCK' THEN e.channel = r.params['channel'] END""")

cte("verdicts", """
SELECT * FROM rule_matches
QUALIFY row_number() OVER (PARTITION BY transaction_id ORDER BY priority DESC, version DESC, rule_id DESC) = 1""")

cte("decided", """
SELECT e.*, v.rule_id, v.rule_type, coalesce(v.action, 'PASS') AS decision
FROM enriched e LEFT JOIN verdicts v ON e.transaction_id = v.transaction_id""")

# Consecutive small failures by row numbers; the run directly before a large success counts.
cte("device_rows", """
SELECT *, row_number() OVER w AS rn,
  status = 'FAILED' AND amount_vnd < 20000 AS small,
  status = 'SUCCESS' AND amount_vnd > 10000000 AS large
FROM clean WINDOW w AS (PARTITION BY device_id ORDER BY ms, transaction_id)""")
cte("device_runs", """
SELECT *, max(CASE WHEN NOT small THEN rn END) OVER (
  PARTITION BY device_id ORDER BY rn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS last_other
FROM device_rows""")
cte("chains", """
SELECT b.transaction_id AS alert_txn, b.device_id, b.user_id, b.ms AS b_ms, b.amount_vnd AS large_amount_vnd,
  a.transaction_id, a.ms, a.amount_vnd,
  count(*) OVER (PARTITION BY b.transaction_id) AS chain_len
FROM device_runs b JOIN device_rows a
  ON a.device_id = b.device_id AND a.rn < b.rn AND a.rn > coalesce(b.last_other, 0)
WHERE b.large AND a.small AND b.ms - a.ms <= 120000""")
cte("card_attacks", """
SELECT device_id, alert_txn AS transaction_id, any_value(user_id) AS user_id, any_value(b_ms) AS event_ts,
  any_value(large_amount_vnd) AS large_amount_vnd, count(*) AS chain_len, min(ms) AS chain_start,
  sum(amount_vnd)::BIGINT AS chain_vnd
FROM chains WHERE chain_len >= 5 GROUP BY device_id, alert_txn""")

cte("travel_pairs", """
SELECT *, lag(transaction_id) OVER w AS prev_transaction_id, ms - lag(ms) OVER w AS gap_ms,
  lag(lat) OVER w AS plat, lag(lon) OVER w AS plon
FROM clean WINDOW w AS (PARTITION BY user_id ORDER BY ms, transaction_id)""")
cte("travel", """
SELECT * FROM (
  SELECT *, 2 * 6371.0088 * asin(sqrt(least(1.0, pow(sin(radians(lat - plat) / 2), 2)
    + cos(radians(plat)) * cos(radians(lat)) * pow(sin(radians(lon - plon) / 2), 2)))) AS km
  FROM travel_pairs WHERE gap_ms < 600000) WHERE km > 300""")

cte("alerts", """
SELECT concat(alert_type, ':', transaction_id) AS alert_id, alert_type, severity, transaction_id, user_id,
  event_ts, sha256(concat(device_id, 'test-salt')) AS device_hash
FROM (
  SELECT 'RULE_BLOCK' AS alert_type, 'MEDIUM' AS severity, transaction_id, user_id, device_id, ms AS event_ts
  FROM decided WHERE decision = 'BLOCK'
  UNION ALL SELECT 'CARD_TESTING', 'CRITICAL', transaction_id, user_id, device_id, event_ts FROM card_attacks
  UNION ALL SELECT 'IMPOSSIBLE_TRAVEL', 'MEDIUM', transaction_id, user_id, device_id, ms FROM travel)""")

cte("outcomes", """
SELECT *, len(kinds) > 0 AS flagged FROM (
  SELECT d.* EXCLUDE (account_tier), coalesce(d.account_tier, 'UNKNOWN') AS account_tier,
    l.is_fraud_confirmed, l.label_source, l.resolved_ms,
    list_filter([CASE WHEN d.decision IN ('BLOCK', 'ALERT', 'REVIEW') THEN d.rule_type END,
      CASE WHEN c.transaction_id IS NOT NULL THEN 'CARD_TESTING' END,
      CASE WHEN t.transaction_id IS NOT NULL THEN 'IMPOSSIBLE_TRAVEL' END], lambda x: x IS NOT NULL) AS kinds
  FROM decided d LEFT JOIN labels_t l ON d.transaction_id = l.transaction_id
  LEFT JOIN card_attacks c ON c.transaction_id = d.transaction_id
  LEFT JOIN travel t ON t.transaction_id = d.transaction_id)""")

cte("points_of", """
SELECT * EXCLUDE (n15), n15::BIGINT AS total_15m,
  CASE WHEN eligible AND n15 >= 5000000 AND grp = 'TREATMENT' THEN 2 ELSE 1 END AS multiplier,
  CASE WHEN eligible THEN amount_vnd // 100000 * CASE WHEN n15 >= 5000000 AND grp = 'TREATMENT' THEN 2 ELSE 1 END
    ELSE 0 END AS points
FROM (
  SELECT *, sum(CASE WHEN eligible THEN amount_vnd ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ms
    RANGE BETWEEN 899999 PRECEDING AND CURRENT ROW) AS n15
  FROM (SELECT d.*, h.grp, decision <> 'BLOCK' AND status <> 'FAILED' AND txn_type = 'PAYMENT' AS eligible
        FROM decided d JOIN holdout h ON d.user_id = h.user_id))""")

# Arrival order: rows of the same millisecond do not see each other.
cte("arrivals", """
SELECT *, max(ms) OVER (ORDER BY ingested_ms RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS max_seen_ms,
  coalesce(ms < max_seen_ms, false) AS out_of_order, coalesce(ms < max_seen_ms - 10000, false) AS late
FROM payments""")

CHAIN = ["payments", "clean", "enriched", "velocity", "rule_matches", "verdicts", "decided", "device_rows",
         "device_runs", "chains", "card_attacks", "travel_pairs", "travel", "alerts", "points_of"]


def chain(prefix: str, source: str) -> None:
    """The same stages once more over other input rows, under prefixed names."""
    cte(f"{prefix}payments", source)
    for name in CHAIN[1:]:
        text = CTES[name]
        for other in CHAIN:
            text = re.sub(rf"(?<![\w.'])({other})(?![\w'])(?=[^']*(?:'[^']*'[^']*)*$)", f"{prefix}{other}", text)
        cte(f"{prefix}{name}", text)


# Rows that were on time when they arrived; rows whose JSON can be read.
chain("ontime_", "SELECT * FROM arrivals WHERE NOT late")
chain("ok_", "SELECT * FROM payments WHERE ms % 500 <> 3")
# Readable rows of transactions that first arrived on time, with all their copies.
chain("steady_", """SELECT * FROM payments WHERE ms % 500 <> 3
  AND transaction_id IN (SELECT transaction_id FROM arrivals WHERE NOT late)""")

"""DuckDB twins of the contract tables, as named common table expressions."""

from __future__ import annotations

import re

from tillwatch import testbed as tb
from tillwatch.sources import seeds as sd

CTES: dict[str, str] = {}


def cte(name: str, sql: str) -> None:
    CTES[name] = sql


def build(sql: str) -> str:
    """Prefix sql with the expressions it names, in dependency order."""
    order: list[str] = []

    def visit(text: str) -> None:
        for name in CTES:
            if name not in order and re.search(rf"\b{name}\b", text):
                seen.add(name)
                if name not in active:
                    active.add(name)
                    visit(CTES[name])
                    if name not in order:
                        order.append(name)

    seen: set[str] = set()
    active: set[str] = set()
    visit(sql)
    if not order:
        return sql
    own = sql.startswith("WITH ")
    tail = ",\n" + sql.removeprefix("WITH ") if own else "\n" + sql
    return "WITH " + ",\n".join(f"{n} AS MATERIALIZED (\n{CTES[n]}\n)" for n in order) + tail


def _cols(exprs: dict[str, str]) -> str:
    return ",\n  ".join(f"{e} AS {n}" for n, e in exprs.items())


# Zlib's CRC-32 over an ASCII id, bit by bit; DuckDB has no such function.
CRC32 = """xor(list_reduce(
  list_prepend(4294967295::BIGINT, list_transform(range(0, 8 * length(user_id)),
    lambda i: ((ascii(substr(user_id, (i // 8 + 1)::BIGINT, 1))::BIGINT >> (i % 8)::BIGINT) & 1))),
  lambda x, b: CASE WHEN (xor(x, b) & 1) = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END
), 4294967295)"""

cte("ev", "SELECT event_id AS id, epoch_us(ts) // 1000 AS ms0, user_id AS u, event_type, value FROM events")
cte("expanded", f"""
SELECT *, {_cols({**tb.PASS_1, 'uid': f"cast({tb.PASS_1['uid']} AS bigint)"})}
FROM ev, (VALUES {', '.join(f"('{f}', {k}::BIGINT)" for f, k in tb.SLOTS)}) s(fam, k)
WHERE CASE fam {' '.join(f"WHEN '{f}' THEN {cond}" for f, (_, cond) in tb.FAMILIES.items())} END""")
cte("copied", f"""
SELECT *, {_cols(tb.PASS_2)}
FROM (SELECT * FROM expanded, (VALUES (0::BIGINT), (1::BIGINT)) c(copy) WHERE copy = 0 OR {tb.COPIED})""")
cte("holdout", f"""
SELECT user_id, CASE WHEN ({CRC32}) % 10 = 0 THEN 'CONTROL' ELSE 'TREATMENT' END AS grp
FROM (SELECT DISTINCT user_id FROM copied)""")
cte("payments", f"""
SELECT transaction_id, c.user_id, merchant_id,
  CASE WHEN currency = 'VND' THEN base_vnd ELSE greatest(1,
    cast(floor(base_vnd / {tb.FX_TEXT.format(dom='day(make_timestamp(ms * 1000))')}) AS bigint)) END AS amount,
  currency, lat, lon, ip_address, device_id, channel, ms, status, failure_reason, txn_type,
  original_txn_id, CASE WHEN fam IN ('C', 'I', 'K') THEN 'TREATMENT' ELSE grp END AS experiment_group,
  ingested_ms, src_partition, make_timestamp(ms * 1000)::DATE AS dt
FROM copied c JOIN holdout h ON c.user_id = h.user_id""")
cte("profile_changes", f"""
SELECT {_cols(tb.PROFILE)}
FROM (SELECT DISTINCT u FROM ev WHERE {tb.PROFILE_PRESENT}), (VALUES (1), (2), (3)) x(v)
WHERE {tb.PROFILE_VERSION}""")
cte("profiles", """
SELECT * FROM profile_changes
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY changed_ms DESC) = 1 AND op <> 'd'""")


def _map(m) -> str:
    return "NULL::MAP(VARCHAR, VARCHAR)" if m is None else (
        "MAP {" + ", ".join(f"'{k}': '{v}'" for k, v in m.items()) + "}")


cte("rules", "SELECT * FROM (VALUES " + ", ".join(
    f"('{r[0]}', '{r[1]}', {_map(r[2])}, {_map(r[3])}, '{r[4]}', {r[5]}, {r[6]}, "
    f"epoch_ms(TIMESTAMP '{r[7][:19]}'), {r[8]}, TIMESTAMP '{r[9][:19]}')" for r in tb.RULES
) + f") r({', '.join(tb.RULE_COLUMNS)})")
cte("live_rules", """
SELECT * FROM rules
QUALIFY row_number() OVER (PARTITION BY rule_id ORDER BY version DESC, updated_at DESC) = 1 AND enabled""")
cte("rule_changes", f"SELECT {_cols(tb.RULE_CHANGE)} FROM ev WHERE {tb.RULE_CHANGE_CONDITION}")
cte("labels_t", f"""
SELECT transaction_id, {_cols(tb.LABEL)} FROM expanded, (VALUES (0), (1)) o(old)
WHERE ({tb.LABEL_PRESENT}) AND (old = 0 OR {tb.REVISED})
QUALIFY row_number() OVER (PARTITION BY transaction_id ORDER BY resolved_ms DESC) = 1""")
cte("redemptions", f"""
SELECT concat('D', id) AS redemption_id, {tb.PROFILE['user_id']} AS user_id,
  id % 40 + 1 AS points_spent, ms0 AS ms FROM ev WHERE {tb.REDEMPTION_CONDITION}""")
cte("injected", """
SELECT CASE fam WHEN 'C' THEN 'CARD_TESTING' WHEN 'I' THEN 'IMPOSSIBLE_TRAVEL' ELSE 'KYC_ABUSE' END AS fraud_type,
  transaction_id FROM expanded WHERE fam IN ('C', 'I', 'K')""")
cte("history_fx", f"""
SELECT d::DATE AS date, currency, cast({tb.FX_TEXT.format(dom='day(d)')} AS decimal(18,6)) AS rate_to_vnd
FROM generate_series(DATE '{sd.HISTORY_FROM}', DATE '{sd.HISTORY_TO}', INTERVAL 1 DAY) g(d),
     (VALUES ('VND'), ('USD'), ('SGD')) c(currency)""")
cte("activity", f"""
SELECT transaction_id, user_id, new_ms AS ms, cast(round(amount::DECIMAL(19,0) * rate_to_vnd) AS BIGINT) AS amount_vnd
FROM (
  SELECT *, {tb.ACTIVITY_MS} AS new_ms FROM (SELECT *, {tb.USER_NUMBER} AS u FROM payments)
  QUALIFY row_number() OVER (PARTITION BY transaction_id ORDER BY ingested_ms DESC) = 1) p
LEFT JOIN history_fx f ON f.date = make_timestamp(new_ms * 1000)::DATE AND f.currency = p.currency
WHERE status = 'SUCCESS' AND txn_type = 'PAYMENT'""")
cte("suspended", """
SELECT user_id FROM alerts WHERE severity = 'CRITICAL'
UNION SELECT user_id FROM outcomes WHERE decision = 'BLOCK' AND is_fraud_confirmed""")

cte("fx_rate", f"""
SELECT d::DATE AS date, currency, cast({tb.FX_TEXT.format(dom='day(d)')} AS decimal(18,6)) AS rate_to_vnd
FROM generate_series(DATE '{sd.FX_FROM}', DATE '{sd.FX_TO}', INTERVAL 1 DAY) g(d),
     (VALUES ('VND'), ('USD'), ('SGD')) c(currency)""")


def _values(rows: list[tuple], names: list[str], texts: set[str]) -> str:
    cells = ", ".join("(" + ", ".join(
        f"'{v}'" if n in texts else f"{v}::DECIMAL(18,6)" for n, v in zip(names, row)) + ")" for row in rows)
    return f"SELECT * FROM (VALUES {cells}) v({', '.join(names)})"


cte("take_rate", _values(sd.TAKE_RATE, ["industry", "take_rate"], {"industry"}))
cte("interchange_rate", _values(sd.INTERCHANGE_RATE, ["channel", "rate"], {"channel"}))
cte("merchant_industry", """
SELECT concat('M', lpad(cast(n AS VARCHAR), 4, '0')) AS merchant_id,
  CASE n % 3 WHEN 0 THEN 'Travel' WHEN 1 THEN 'F&B' ELSE 'Retail' END AS industry
FROM range(1, 100) g(n)""")
cte("cost_assumptions", _values(sd.COSTS, sd.COST_COLUMNS, {"scenario"}))
cte("cost_scenarios", _values(sd.WHAT_IF, sd.COST_COLUMNS, {"scenario"}))

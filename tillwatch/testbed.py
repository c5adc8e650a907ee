"""Contract tables derived from the driver's ``events`` table.

Every table is a narrow projection of the events (one scan, one explode, integer arithmetic only),
so its size grows with the given data and DuckDB derives the same rows from the same expressions.

Row families, by the letter that starts the transaction id:
T normal traffic, P the payment a refund points to, C card testing burst, I impossible travel pair,
K spend of an unverified user, L loyalty burst, R blocked attempt and its retry.
"""

from __future__ import annotations

import os
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwatch.functions.exprs import iso_millis

# family -> (highest k, condition on the event that expands into this family)
FAMILIES = {
    "T": (0, "true"),
    "P": (0, "event_type = 'signup' AND id % 10 = 0 AND id % 30 <> 0"),
    "C": (6, "event_type = 'error' AND id % 25 = 0"),
    "I": (1, "event_type = 'view' AND id % 25 = 0"),
    "K": (0, "event_type = 'click' AND id % 25 = 0"),
    "L": (3, "event_type = 'purchase' AND id % 20 = 0"),
    "R": (1, "event_type = 'purchase' AND id % 25 = 5"),
}
FIRST_K = {"L": 1}
SLOTS = [(fam, k) for fam, (last, _) in FAMILIES.items() for k in range(FIRST_K.get(fam, 0), last + 1)]

_USER = "concat('U', lpad(cast(uid AS string), 6, '0'))"

# Three passes of column expressions, valid in Spark and in DuckDB.
PASS_1 = {
    "ms": """ms0 + CASE fam WHEN 'C' THEN 15000 * k WHEN 'I' THEN 240000 * k WHEN 'L' THEN 240000 * k
             WHEN 'R' THEN 60000 + 360000 * k WHEN 'P' THEN -3600000 ELSE 0 END""",
    "uid": "CASE fam WHEN 'K' THEN 5 + 20 * ((u - u % 20) / 20) ELSE u END",
    "base_vnd": """CASE fam
        WHEN 'T' THEN greatest(1000, cast(floor(value * 20000) AS bigint))
        WHEN 'P' THEN 2 * greatest(1000, cast(floor(value * 20000) AS bigint))
        WHEN 'C' THEN CASE WHEN k < 6 THEN 5000 + (id * 31 + k * 997) % 14001 ELSE 15000000 END
        WHEN 'I' THEN 500000 WHEN 'K' THEN 3000000 WHEN 'L' THEN 2000000
        ELSE CASE WHEN k = 0 THEN 2600000 ELSE 1900000 END END""",
    "currency": """CASE WHEN fam IN ('T', 'P') AND id % 20 = 0 THEN 'USD'
        WHEN fam IN ('T', 'P') AND id % 20 = 1 THEN 'SGD' ELSE 'VND' END""",
    "city": "CASE WHEN fam IN ('C', 'K') THEN 0 WHEN fam = 'I' THEN 2 * k ELSE u % 3 END",
    "transaction_id": """concat(fam, cast(id AS string),
        CASE WHEN fam IN ('C', 'I', 'L', 'R') THEN concat('-', cast(k AS string)) ELSE '' END)""",
    "merchant_id": """CASE WHEN fam IN ('C', 'I', 'K') THEN concat('M', lpad(cast(id * 3 % 25 + 60 AS string), 4, '0'))
        ELSE concat('M', lpad(cast(id * 7 % 50 + 1 AS string), 4, '0')) END""",
    "channel": """CASE fam WHEN 'C' THEN 'WEB' WHEN 'I' THEN 'APP' WHEN 'K' THEN 'WEB'
        WHEN 'R' THEN CASE WHEN k = 0 THEN 'WEB' ELSE 'APP' END
        ELSE CASE id % 3 WHEN 0 THEN 'POS' WHEN 1 THEN 'WEB' ELSE 'APP' END END""",
    "ip_address": """CASE WHEN fam IN ('C', 'I', 'K')
        THEN concat('198.18.', cast(id % 32 AS string), '.', cast(id % 100 + k AS string)) WHEN id % 50 = 7 THEN '115.78.x.x'
        ELSE concat('115.78.', cast(id % 256 AS string), '.', cast(u % 256 AS string)) END""",
    "status": """CASE WHEN fam = 'C' AND k < 6 THEN 'FAILED'
        WHEN fam = 'T' AND event_type = 'error' AND id % 3 = 0 THEN 'FAILED'
        WHEN fam = 'T' AND id % 101 = 0 THEN 'PENDING' ELSE 'SUCCESS' END""",
    "txn_type": """CASE WHEN fam = 'T' AND event_type = 'signup' AND id % 10 = 0 THEN 'REFUND'
        ELSE 'PAYMENT' END""",
}
PASS_2 = {
    "user_id": f"""CASE fam
        WHEN 'C' THEN concat('HIT-', cast(id AS string), '-', cast(k AS string))
        WHEN 'I' THEN concat('FAR-', cast(id AS string)) ELSE {_USER} END""",
    "device_id": f"""CASE fam WHEN 'C' THEN concat('dx-', cast(id AS string))
        WHEN 'I' THEN concat('df-', cast(id AS string)) ELSE concat('d-', {_USER}) END""",
    "lat": """cast(CASE city WHEN 0 THEN 208648 WHEN 1 THEN 119404 ELSE 100341 END
        + CASE WHEN fam IN ('C', 'I', 'K') THEN 0 ELSE id % 200 - 100 END AS double) / 10000""",
    "lon": """cast(CASE city WHEN 0 THEN 1066838 WHEN 1 THEN 1084583 ELSE 1057825 END
        + CASE WHEN fam IN ('C', 'I', 'K') THEN 0 ELSE id % 100 - 50 END AS double) / 10000""",
    "failure_reason": """CASE WHEN status = 'FAILED' THEN
        CASE WHEN fam = 'C' THEN CASE k % 3 WHEN 0 THEN 'CARD_DECLINED'
                                 WHEN 1 THEN 'INSUFFICIENT_FUND' ELSE 'TIMEOUT' END
        ELSE CASE id % 9 WHEN 0 THEN 'INSUFFICIENT_FUND' WHEN 3 THEN 'CARD_DECLINED'
             ELSE 'TIMEOUT' END END END""",
    "original_txn_id": """CASE WHEN txn_type = 'REFUND' AND id % 30 <> 0
        THEN concat('P', cast(id AS string)) END""",
    "ingested_ms": """ms + 1000 * (id % 8) + CASE WHEN id % 100 < 3 THEN 1000 * (5 + id % 56) ELSE 0 END
        + CASE WHEN id % 200 = 77 THEN 660000 ELSE 0 END + 90000 * copy""",
    "src_partition": "CASE WHEN fam IN ('C', 'I') THEN id % 6 ELSE u % 6 END",
}
# One partition is silent for ten days and then delivers what it held back a thousand times faster.
SILENT_PARTITION = 5
SILENT_FROM_MS, SILENT_TO_MS = 1704931200000, 1705795200000
SILENT_ARRIVAL_MS = f"""CASE WHEN src_partition = {SILENT_PARTITION} AND ingested_ms >= {SILENT_FROM_MS}
    AND ingested_ms < {SILENT_TO_MS} THEN {SILENT_TO_MS} + cast(floor((ingested_ms - {SILENT_FROM_MS}) / 1000) AS bigint)
    ELSE ingested_ms END"""
FX_TEXT = "CASE currency WHEN 'USD' THEN 24000 + 10 * {dom} WHEN 'SGD' THEN 18000 + 7 * {dom} ELSE 1 END"
COPIED = "id % 40 = 0"

# Profiles: one row per change. op c at v=1, u at v=2, d at v=3.
PROFILE_PRESENT = "u % 37 <> 3"
PROFILE_VERSION = "v = 1 OR (v = 2 AND u % 5 = 0) OR (v = 3 AND u % 31 = 9)"
PROFILE = {
    "user_id": "concat('U', lpad(cast(u AS string), 6, '0'))",
    "full_name": "concat('User ', cast(u AS string))",
    "kyc_status": """CASE WHEN (u * 7 + 5) % 20 = 0 THEN 'UNVERIFIED' WHEN (u * 7 + 5) % 20 < 3
        THEN 'PENDING' ELSE 'VERIFIED' END""",
    "account_tier": """CASE WHEN u % 20 = 0 THEN 'VIP' WHEN u % 20 < 4 THEN 'GOLD'
        WHEN u % 20 < 10 OR (v > 1 AND u % 20 = 15) THEN 'SILVER' ELSE 'BRONZE' END""",
    "risk_score_baseline": "cast(u * 13 % 36 AS double) / 100",
    "home_country": "CASE WHEN u % 23 = 7 THEN 'SG' ELSE 'VN' END",
    "op": "CASE v WHEN 1 THEN 'c' WHEN 2 THEN 'u' ELSE 'd' END",
    "changed_ms": "CASE v WHEN 1 THEN 1701388800000 WHEN 2 THEN 1705276800000 ELSE 1705708800000 END",
}

# Fixed values of the fraud rules under test; the older version of a rule must lose.
RULE_COLUMNS = ["rule_id", "rule_type", "scope", "params", "action", "priority", "enabled",
                "effective_from", "version", "updated_at"]
RULES = [
    ("R-001", "AMOUNT_THRESHOLD", {"kyc_status": "UNVERIFIED"}, {"max_amount_vnd": "2499999"},
     "BLOCK", 200, True, "2024-01-01T00:00:00Z", 1, "2024-01-01T00:00:00Z"),
    ("R-014", "AMOUNT_THRESHOLD", {"account_tier": "BRONZE", "channel": "WEB"},
     {"max_amount_vnd": "5000000"},
     "BLOCK", 100, True, "2024-01-01T00:00:00Z", 6, "2024-01-01T00:00:00Z"),
    ("R-014", "AMOUNT_THRESHOLD", {"account_tier": "BRONZE", "channel": "WEB"},
     {"max_amount_vnd": "2000000"},
     "BLOCK", 100, True, "2024-01-15T00:00:00Z", 7, "2024-01-14T09:00:00Z"),
    ("R-020", "COUNTRY_BLOCK", None, {"country": "SG"},
     "REVIEW", 50, True, "2024-01-01T00:00:00Z", 1, "2024-01-01T00:00:00Z"),
    ("R-030", "DEVICE_BLACKLIST", None, {"device_ids": "d-U000002,d-U000008"},
     "BLOCK", 150, True, "2024-01-10T00:00:00Z", 2, "2024-01-10T00:00:00Z"),
    ("R-040", "VELOCITY", None, {"max_count": "3", "window_sec": "900"},
     "ALERT", 60, True, "2024-01-01T00:00:00Z", 1, "2024-01-01T00:00:00Z"),
    ("R-050", "CHANNEL_BLOCK", {"kyc_status": "PENDING"}, {"channel": "POS"},
     "REVIEW", 40, True, "2024-01-01T00:00:00Z", 1, "2024-01-01T00:00:00Z"),
    ("R-060", "AMOUNT_THRESHOLD", None, {"max_amount_vnd": "0"},
     "BLOCK", 999, False, "2024-01-01T00:00:00Z", 3, "2024-01-02T00:00:00Z"),
    ("R-070", "AMOUNT_THRESHOLD", None, {"max_amount_vnd": "100000"},
     "BLOCK", 900, True, "2024-02-15T00:00:00Z", 1, "2024-01-20T00:00:00Z"),
    ("R-080", "AMOUNT_THRESHOLD", {"account_tier": "VIP"}, {"max_amount_vnd": "0"},
     "ALLOW", 300, True, "2024-01-20T00:00:00Z", 1, "2024-01-19T00:00:00Z"),
]

LIFECYCLE_AS_OF = "2024-07-01"
SALT = os.environ.get("TILLWATCH_SALT", "test-salt")  # production sets its own

# Changes of the data-driven rule catalogue: id, version and payload come from signup events.
RULE_CHANGE = {
    "rule_id": "concat('X-', lpad(cast(id % 40 AS string), 3, '0'))",
    "op": "CASE WHEN id % 13 = 0 THEN 'd' ELSE 'u' END",
    "version": "cast(id AS bigint)",
    "enabled": "id % 7 <> 0",
    "priority": "cast(id % 100 AS bigint)",
    "action": "CASE id % 3 WHEN 0 THEN 'ALERT' WHEN 1 THEN 'REVIEW' ELSE 'BLOCK' END",
    "max_amount_vnd": "cast(1000000 + id % 500 * 10000 AS bigint)",
}
RULE_CHANGE_CONDITION = "event_type = 'signup'"
# Some records of the rules topic cannot be read; some deletes are records without a value.
RULE_BROKEN, RULE_TOMBSTONE = "id % 11 = 0", "id % 26 = 0"

# Labels by transaction: which rows have one and what it says.
LABEL_PRESENT = """CASE fam WHEN 'C' THEN k = 6 WHEN 'I' THEN k = 1 WHEN 'K' THEN true
    WHEN 'R' THEN k = 0 AND id % 4 <> 3 WHEN 'L' THEN id % 40 = 0 WHEN 'T' THEN id % 3 <> 1
    ELSE false END"""
# Some labels are revised: the older one (old = 1) says the opposite and came one day earlier.
REVISED = "id % 8 = 0"
LABEL = {
    "is_fraud_confirmed": "(fam IN ('C', 'I', 'K') OR (fam = 'T' AND id % 211 = 0)) <> (old = 1)",
    "label_source": """CASE id % 3 WHEN 0 THEN 'CHARGEBACK' WHEN 1 THEN 'INVESTIGATION'
        ELSE 'COMPLAINT' END""",
    "resolved_ms": "ms + 86400000 * (7 + id % 39 - old)",
}
REDEEMED_TWICE = "id % 20 = 5"
# Of these a first attempt came cut short, by the time in milliseconds.
LABEL_CUT, REDEMPTION_CUT = "resolved_ms % 40 = 3", "ms % 4 = 3"
REDEMPTION_CONDITION = "event_type = 'signup' AND id % 10 = 5"
USER_NUMBER = "cast(regexp_extract(user_id, '([0-9]+)', 1) AS bigint)"
ACTIVITY_MS = """1719792000000 - 86400000 * cast(CASE u % 7 WHEN 3 THEN 3 WHEN 4 THEN 40 WHEN 5 THEN 75
    WHEN 6 THEN 120 ELSE 0 END AS bigint) - (1 + u % 5) * (1706659200000 - ms)"""


def _select(exprs: dict[str, str]) -> list:
    return [F.expr(e).alias(n) for n, e in exprs.items()]


def _rule_literal(row: tuple) -> str:
    def as_map(m):
        if m is None:
            return "cast(NULL AS map<string,string>)"
        return "map(" + ", ".join(f"'{k}', '{v}'" for k, v in m.items()) + ")"

    rid, rtype, scope, params, action, prio, enabled, eff, version, upd = row
    return (f"('{rid}', '{rtype}', {as_map(scope)}, {as_map(params)}, '{action}', {prio}, "
            f"{str(enabled).lower()}, timestamp'{eff}', {version}, timestamp'{upd}')")


def rules(spark: SparkSession, rows: list[tuple] = RULES) -> DataFrame:
    body = ", ".join(_rule_literal(r) for r in rows)
    return spark.sql(f"SELECT * FROM VALUES {body} AS r({', '.join(RULE_COLUMNS)})")


class Testbed:
    """The contract tables for one data folder."""

    __test__ = False

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    @cached_property
    def events(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/events.parquet").select(
            F.col("event_id").alias("id"),
            F.unix_millis(F.col("ts").cast("timestamp")).alias("ms0"),
            F.col("user_id").alias("u"), "event_type", "value")

    @cached_property
    def expanded(self) -> DataFrame:
        """One row per transaction, before duplicates."""
        none = "cast(array() AS array<struct<fam: string, k: bigint>>)"
        families = []
        for fam, (_, cond) in FAMILIES.items():
            slots = ", ".join(f"named_struct('fam', '{f}', 'k', {k}L)" for f, k in SLOTS if f == fam)
            families.append(f"CASE WHEN {cond} THEN array({slots}) ELSE {none} END")
        return (
            self.events
            .select("*", F.expr(f"inline(concat({', '.join(families)}))"))
            .select("*", *_select({**PASS_1, "uid": f"cast({PASS_1['uid']} AS bigint)"}))
        )

    @cached_property
    def payments(self) -> DataFrame:
        """Bronze ``payment_events``: at-least-once, so some transactions appear twice."""
        dom = "day(timestamp_millis(ms))"
        amount = ("CASE WHEN currency = 'VND' THEN base_vnd ELSE greatest(1, "
                  f"cast(floor(base_vnd / {FX_TEXT.format(dom=dom)}) AS bigint)) END")
        rows = (
            self.expanded
            .select("*", F.explode(F.expr(
                f"CASE WHEN {COPIED} THEN array(0L, 1L) ELSE array(0L) END")).alias("copy"))
            .select("*", *_select(PASS_2))
        )
        group = F.when(F.col("fam").isin("C", "I", "K"), F.lit("TREATMENT")).otherwise(
            F.when(F.crc32("user_id") % 10 == 0, "CONTROL").otherwise("TREATMENT"))
        event_ts = F.timestamp_millis("ms")
        return rows.select(
            "transaction_id", "user_id", "merchant_id", F.expr(amount).alias("amount"), "currency",
            F.struct("lat", "lon").alias("location"),
            "ip_address", "device_id", "channel", event_ts.alias("event_ts"), "status",
            "failure_reason", "txn_type", "original_txn_id", group.alias("experiment_group"),
            F.timestamp_millis("ingested_ms").alias("ingested_at"), "src_partition",
            F.to_date(event_ts).alias("dt"))

    @cached_property
    def unruly_payments(self) -> DataFrame:
        """Bronze of a producer that now and then sends a status the contract does not know."""
        odd = F.pmod(F.unix_millis("event_ts"), F.lit(97)) == 5
        return self.payments.withColumn("status", F.when(odd, "REVERSED").otherwise(F.col("status")))

    @cached_property
    def raw_payments(self) -> DataFrame:
        """The topic as the broker delivers it: key, JSON value, arrival time, partition.

        Some values are cut short, as a broken producer would send them.
        """
        event = F.to_json(F.struct(
            "transaction_id", "user_id", "merchant_id", "amount", "currency", "location",
            "ip_address", "device_id", "channel", iso_millis(F.col("event_ts")).alias("timestamp"),
            "status", "failure_reason", "txn_type", "original_txn_id", "experiment_group"),
            {"ignoreNullFields": "false"})
        broken = F.pmod(F.unix_millis("event_ts"), F.lit(500)) == 3
        return self.payments.select(
            F.col("user_id").alias("key"),
            F.when(broken, F.substring(event, 1, 40)).otherwise(event).alias("value"),
            F.col("src_partition").alias("partition"), "ingested_at", "dt")

    @cached_property
    def silenced_payments(self) -> DataFrame:
        """The topic with one partition silent for a while."""
        arrival = F.expr(SILENT_ARRIVAL_MS)
        return (
            self.raw_payments.withColumns({"src_partition": F.col("partition"), "ingested_ms": F.unix_millis("ingested_at")})
            .withColumn("ingested_at", F.timestamp_millis(arrival)).drop("src_partition", "ingested_ms"))

    @cached_property
    def profile_changes(self) -> DataFrame:
        return (
            self.events.where(PROFILE_PRESENT).select("u").distinct()
            .select("u", F.explode(F.expr("filter(array(1, 2, 3), v -> " + PROFILE_VERSION + ")"))
                    .alias("v"))
            .select(*_select(PROFILE))
            .withColumn("updated_at", F.timestamp_millis("changed_ms"))
        )

    @cached_property
    def raw_profile_changes(self) -> DataFrame:
        """Change records as JSON: {before, after, op, ts_ms}."""
        row = F.struct("user_id", "full_name", "kyc_status", "account_tier", "risk_score_baseline",
                       "home_country", iso_millis(F.col("updated_at")).alias("updated_at"))
        gone = F.col("op") == "d"
        return self.profile_changes.select(
            F.col("user_id").alias("key"),
            F.to_json(F.struct(
                F.when(F.col("op") != "c", row).alias("before"),
                F.when(~gone, row).alias("after"),
                "op", F.col("changed_ms").alias("ts_ms"))).alias("value"))

    @cached_property
    def rules(self) -> DataFrame:
        return rules(self.spark)

    @cached_property
    def rule_changes(self) -> DataFrame:
        return (self.events.where(RULE_CHANGE_CONDITION).select("id", "ms0")
                .select(*_select(RULE_CHANGE), F.timestamp_millis("ms0").alias("updated_at")))

    @cached_property
    def raw_rule_changes(self) -> DataFrame:
        """The rules topic: JSON changes by rule id, some cut short."""
        row = F.struct(
            "rule_id", F.lit("AMOUNT_THRESHOLD").alias("rule_type"),
            F.create_map(F.lit("max_amount_vnd"), F.col("max_amount_vnd").cast("string")).alias("params"), "action", "priority",
            "enabled", iso_millis(F.col("updated_at")).alias("effective_from"), "version",
            iso_millis(F.col("updated_at")).alias("updated_at"))
        gone = F.col("op") == "d"
        change = F.to_json(F.struct(F.when(gone, row).alias("before"), F.when(~gone, row).alias("after"), "op"))
        value = F.when(F.expr(RULE_BROKEN), F.substring(change, 1, 30)).when(
            gone & F.expr(RULE_TOMBSTONE), F.lit(None)).otherwise(change)
        return self.rule_changes.withColumn("id", F.col("version")).select(
            F.col("rule_id").alias("key"), value.alias("value"), F.col("updated_at").alias("ingested_at"))

    @cached_property
    def labels(self) -> DataFrame:
        """Labels as they arrive; a later one replaces an earlier one."""
        return (self.expanded.where(LABEL_PRESENT)
                .select("*", F.explode(F.expr(
                    f"CASE WHEN {REVISED} THEN array(0L, 1L) ELSE array(0L) END")).alias("old"))
                .select("transaction_id", *_select(LABEL))
                .withColumn("resolved_at", F.timestamp_millis("resolved_ms")).drop("resolved_ms"))

    @cached_property
    def redemptions(self) -> DataFrame:
        """Redemptions as they arrive, some of them twice."""
        return self.events.where(REDEMPTION_CONDITION).select("*", F.explode(F.expr(
            f"CASE WHEN {REDEEMED_TWICE} THEN array(0, 1) ELSE array(0) END")).alias("copy")).select(
            F.concat(F.lit("D"), F.col("id").cast("string")).alias("redemption_id"),
            F.expr(PROFILE["user_id"]).alias("user_id"),
            (F.col("id") % 40 + 1).alias("points_spent"), F.lit("VOUCHER").alias("reward_type"),
            F.timestamp_millis("ms0").alias("event_ts"))

    @staticmethod
    def _with_cut_copies(rows: DataFrame, key: str, at: str, cut) -> DataFrame:
        """Rows as JSON records that arrive when they hold; of some a copy cut short."""
        fields = [iso_millis(F.col(at)).alias("timestamp" if at == "event_ts" else at) if c == at else F.col(c)
                  for c in rows.columns]
        return rows.select(
            F.col(key).alias("key"), F.to_json(F.struct(*fields)).alias("json"), F.col(at).alias("ingested_at"), cut.alias("cut"),
        ).select("key", "ingested_at", F.explode(F.when(
            F.col("cut"), F.array("json", F.substring("json", 1, 25))).otherwise(F.array("json"))).alias("value"))

    @cached_property
    def raw_labels(self) -> DataFrame:
        """The labels topic: JSON by transaction, arriving when the case is resolved."""
        cut = F.expr(LABEL_CUT.replace("resolved_ms", "unix_millis(resolved_at)"))
        return self._with_cut_copies(self.labels, "transaction_id", "resolved_at", cut)

    @cached_property
    def raw_redemptions(self) -> DataFrame:
        """The redemptions topic: JSON by redemption, some of them twice."""
        cut = F.expr(REDEMPTION_CUT.replace("ms", "unix_millis(event_ts)"))
        return self._with_cut_copies(self.redemptions, "redemption_id", "event_ts", cut)

    @cached_property
    def injected(self) -> DataFrame:
        """Ground truth of the injected scenarios, one record per attack."""
        scenario = F.expr(
            f"""CASE WHEN {FAMILIES['C'][1]} THEN 'C' WHEN {FAMILIES['I'][1]} THEN 'I'
                WHEN {FAMILIES['K'][1]} THEN 'K' END""")
        return (
            self.events.withColumn("fam", scenario).where("fam IS NOT NULL")
            .select(
                F.expr("""CASE fam WHEN 'C' THEN 'CARD_TESTING' WHEN 'I' THEN 'IMPOSSIBLE_TRAVEL'
                          ELSE 'KYC_ABUSE' END""").alias("fraud_type"),
                F.expr("""CASE fam
                    WHEN 'C' THEN transform(sequence(0, 6), k -> concat('C', id, '-', k))
                    WHEN 'I' THEN transform(sequence(0, 1), k -> concat('I', id, '-', k))
                    ELSE array(concat('K', id)) END""").alias("transaction_ids"),
                F.timestamp_millis("ms0").alias("injected_at"))
        )

    @cached_property
    def history(self) -> DataFrame:
        """Bronze of a longer time: all payments, copies included, stretched over nine months."""
        stretched = F.timestamp_millis("new_ms")
        return (
            self.payments.withColumns({"u": F.expr(USER_NUMBER), "ms": F.unix_millis("event_ts")})
            .withColumn("new_ms", F.expr(ACTIVITY_MS))
            .withColumns({
                "ingested_at": F.timestamp_millis(F.unix_millis("ingested_at") + F.col("new_ms") - F.col("ms")),
                "event_ts": stretched, "dt": F.to_date(stretched)})
            .drop("u", "ms", "new_ms")
        )

"""The rule engine: which rule decides a transaction.

A rule is a candidate when it is enabled, effective at event time, its scope equals the attributes of
the transaction and the predicate of its type holds. Among candidates the highest priority wins, then
the higher version, then the higher id.

Rules are first brought into one typed form; a rule that cannot be (unknown type, missing or unreadable
parameter, scope on an unknown attribute) never matches and is reported with its problem. Few rules
become one expression, many are joined on their scope: both read the same typed form and answer alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from tillwatch.operators.latest import latest
from tillwatch.operators.slices import SECOND
from tillwatch.operators.trailing import trailing_sums

# Above this number the rules are joined instead of compiled into the plan.
COMPILE_LIMIT = 200
# The same for the device ids of all blacklists together.
COMPILE_DEVICES = 10_000
# Attributes of an enriched transaction that a scope may name.
RULE_ATTRIBUTES = ["account_tier", "channel", "currency", "device_id", "home_country", "ip_address", "kyc_status",
                   "merchant_id", "status", "txn_type", "user_id"]


def active_rules(changes: DataFrame) -> DataFrame:
    """Newest version of every rule; a disabled or deleted rule disappears."""
    newest = latest(changes, ["rule_id"], [F.desc("version"), F.desc("updated_at")])
    alive = F.col("enabled")
    if "op" in changes.columns:
        alive = alive & (F.col("op") != "d")
    return newest.where(alive)


def checked_rules(rules: DataFrame, attributes: list[str] = RULE_ATTRIBUTES) -> DataFrame:
    """Rules in typed form, with ``problem`` set where a rule cannot be applied.

    ``entries`` is the scope as (key, value) pairs in order of the key; ``limit`` the number that the
    transaction must exceed, ``word`` the value it must equal, ``devices`` the list it must be in.
    """
    if "problem" in rules.columns:
        return rules
    kind, p = F.col("rule_type"), F.col("params")
    limit = F.when(kind == "AMOUNT_THRESHOLD", F.expr("try_cast(params['max_amount_vnd'] AS bigint)")).when(
        kind == "VELOCITY", F.expr("try_cast(params['max_count'] AS bigint)"))
    window = F.when(kind == "VELOCITY", F.expr("try_cast(params['window_sec'] AS bigint)"))
    word = F.when(kind == "COUNTRY_BLOCK", p["country"]).when(kind == "CHANNEL_BLOCK", p["channel"])
    devices = F.when(kind == "DEVICE_BLACKLIST", F.array_distinct(F.split(p["device_ids"], ",")))
    entries = F.coalesce(F.array_sort(F.map_entries("scope")), F.expr("cast(array() AS array<struct<key:string,value:string>>)"))
    typed = rules.select(
        "rule_id", "rule_type", "action", "priority", "version", "effective_from", entries.alias("entries"),
        limit.alias("limit"), window.alias("window_sec"), word.alias("word"), devices.alias("devices"))
    known = F.array(*[F.lit(a) for a in attributes])
    problem = (
        F.when(F.col("rule_id").isNull() | F.col("action").isNull() | F.col("priority").isNull()
               | F.col("version").isNull() | F.col("effective_from").isNull(), "incomplete")
        .when(F.exists("entries", lambda e: ~F.array_contains(known, e["key"]) | e["value"].isNull()), "scope")
        .when(kind.isin("AMOUNT_THRESHOLD", "VELOCITY") & F.col("limit").isNull(), "limit")
        .when((kind == "VELOCITY") & ~F.coalesce(F.col("window_sec") > 0, F.lit(False)), "window")
        .when(kind.isin("COUNTRY_BLOCK", "CHANNEL_BLOCK") & F.col("word").isNull(), "word")
        .when((kind == "DEVICE_BLACKLIST") & F.col("devices").isNull(), "devices")
        .when(~F.coalesce(kind.isin("AMOUNT_THRESHOLD", "VELOCITY", "COUNTRY_BLOCK", "CHANNEL_BLOCK", "DEVICE_BLACKLIST"),
                          F.lit(False)), "type"))
    return typed.withColumn("problem", problem)


def _velocity(window_sec: int) -> str:
    return f"_txns_{window_sec}s"


def with_velocity(
    payments: DataFrame, thresholds: dict[int, int], recent: DataFrame | None = None,
) -> DataFrame:
    """Add the trailing transaction count of the user, per window, where it can matter.

    ``recent`` rows count as well but get no result (the look-back of a micro-batch).

    ``thresholds`` maps a window in seconds to the smallest count that any rule tests. Only three
    narrow columns are shuffled by user, and only the rows above the threshold come back, so the
    wide rows keep the partitioning by transaction they already have.
    """
    narrow = ["transaction_id", "user_id", "event_ts"]
    counted = payments.select(*narrow)
    if recent is not None:
        counted = counted.unionByName(recent.select(*narrow))
    for sec, threshold in sorted(thresholds.items()):
        name = _velocity(sec)
        hits = (
            trailing_sums(counted, ["user_id"], F.unix_millis("event_ts"), sec * SECOND,
                          {name: F.lit(1).cast("bigint")})
            .where(F.col(name) > threshold).select("transaction_id", name))
        payments = payments.join(hits, "transaction_id", "left")
    return payments


def _thresholds(rules: DataFrame) -> dict[int, int]:
    """Smallest count per velocity window. Each distinct window costs one shuffle of narrow rows."""
    return {r["window_sec"]: r["least"] for r in rules.where("rule_type = 'VELOCITY'").groupBy("window_sec").agg(
        F.min("limit").alias("least")).collect()}


def _predicate(rule: Row) -> Column:
    kind = rule["rule_type"]
    if kind == "AMOUNT_THRESHOLD":
        return F.col("amount_vnd") > rule["limit"]
    if kind == "COUNTRY_BLOCK":
        return F.col("home_country") == rule["word"]
    if kind == "DEVICE_BLACKLIST":
        return F.col("device_id").isin(rule["devices"])
    if kind == "VELOCITY":
        return F.col(_velocity(rule["window_sec"])) > rule["limit"]
    return F.col("channel") == rule["word"]


def _condition(rule: Row) -> Column:
    cond = (F.col("event_ts") >= F.lit(rule["effective_from"])) & _predicate(rule)
    for entry in rule["entries"]:
        cond = cond & (F.col(entry["key"]).cast("string") == entry["value"])
    return cond


def _verdict(rules: list[Row]) -> Column:
    """The best of a few rules that holds on a row, null if none does."""
    ordered = sorted(
        rules, key=lambda r: (r["priority"], r["version"], r["rule_id"], r["rule_type"], r["action"]), reverse=True)
    return F.coalesce(*[
        F.when(_condition(r), F.struct(
            F.lit(r["rule_id"]).alias("rule_id"), F.lit(r["rule_type"]).alias("rule_type"),
            F.lit(r["action"]).alias("decision")))
        for r in ordered])


def _compiled(payments: DataFrame, rules: list[Row]) -> DataFrame:
    """Few rules: one chain of conditions per row, no join and no shuffle."""
    return payments.withColumn("_v", _verdict(rules)).select(*payments.columns, "_v.*")


def _with_device_scopes(rules: DataFrame) -> DataFrame:
    """Blacklists as one row per device, the device being one more attribute of the scope.

    A long list then meets the transactions through the join key, not by a search in every row. A scope
    that already names a device keeps only that one.
    """
    own = F.expr("get(filter(entries, e -> e.key = 'device_id'), 0).value")
    listed = rules.withColumn("device", F.explode_outer("devices")).where(
        F.col("devices").isNull() | (F.col("device").isNotNull() & (own.isNull() | (own == F.col("device")))))
    added = F.array_sort(F.concat("entries", F.array(F.struct(F.lit("device_id").alias("key"), F.col("device").alias("value")))))
    return listed.withColumn(
        "entries", F.when(F.col("device").isNotNull() & own.isNull(), added).otherwise(F.col("entries"))).drop("device", "devices")


def _hits(payments: DataFrame, rules: DataFrame, windows: list[int]) -> DataFrame:
    """Many rules: equi-join on the scope, one row per transaction and rule that holds.

    The distinct sets of scope keys are read to the driver (subsets of the known attributes); the rules
    themselves stay distributed.
    """
    keyed = _with_device_scopes(rules).select(
        F.col("entries").alias("scope_key"),
        F.struct("priority", "version", "rule_id", "rule_type", "action").alias("verdict"),
        "rule_type", "limit", "window_sec", "word", "effective_from")
    shapes = [tuple(r[0]) for r in keyed.select(F.transform("scope_key", lambda e: e["key"])).distinct().collect()]

    def key_of(shape: tuple) -> Column:
        pairs = F.array(*[F.struct(F.lit(k).alias("key"), F.col(k).cast("string").alias("value")) for k in shape]) if shape \
            else F.expr("cast(array() AS array<struct<key:string,value:string>>)")
        present = F.lit(True)
        for k in shape:
            present = present & F.col(k).isNotNull()
        return F.when(present, pairs)  # a row without one of the attributes cannot match the scope

    counts = F.create_map(*[x for sec in windows for x in (F.lit(sec).cast("bigint"), F.col(_velocity(sec)))]) \
        if windows else F.lit(None).cast("map<bigint,bigint>")
    probes = payments.select(
        "transaction_id", "event_ts", "amount_vnd", "home_country", "channel", counts.alias("counts"),
        F.explode(F.array_compact(F.array(*[key_of(s) for s in shapes]))).alias("scope_key"))
    kind = F.col("rule_type")
    holds = (
        F.when(kind == "AMOUNT_THRESHOLD", F.col("amount_vnd") > F.col("limit"))
        .when(kind == "COUNTRY_BLOCK", F.col("home_country") == F.col("word"))
        .when(kind == "DEVICE_BLACKLIST", F.lit(True))
        .when(kind == "VELOCITY", F.col("counts")[F.col("window_sec")] > F.col("limit"))
        .when(kind == "CHANNEL_BLOCK", F.col("channel") == F.col("word")))
    return probes.join(keyed, "scope_key").where((F.col("effective_from") <= F.col("event_ts")) & holds).select(
        "transaction_id", "verdict")


def _joined(payments: DataFrame, rules: DataFrame, windows: list[int]) -> DataFrame:
    """Many rules: the best hit per transaction. Partial aggregation keeps one per transaction and task."""
    best = _hits(payments, rules, windows).groupBy("transaction_id").agg(F.max("verdict").alias("_v"))
    return (
        payments.join(best, "transaction_id", "left")
        .select(*payments.columns, "_v.rule_id", "_v.rule_type", F.col("_v.action").alias("decision")))


def _few(rules: list[Row], compile_limit: int) -> bool:
    return len(rules) <= compile_limit and sum(len(r["devices"] or []) for r in rules) <= COMPILE_DEVICES


def _least_counts(rules: list[Row]) -> dict[int, int]:
    """As :func:`_thresholds`, of rules that have been read."""
    least: dict[int, int] = {}
    for r in rules:
        if r["rule_type"] == "VELOCITY":
            least[r["window_sec"]] = min(r["limit"], least.get(r["window_sec"], r["limit"]))
    return least


def decide(
    enriched: DataFrame, rules: DataFrame, compile_limit: int = COMPILE_LIMIT,
    recent: DataFrame | None = None,
) -> DataFrame:
    """Add ``decision``, ``rule_id``, ``rule_type`` and ``rules_not_ready``.

    ``enriched`` needs unique transactions with ``amount_vnd`` and profile columns; ``rules`` are active
    rules, checked or not; ``recent`` are earlier rows that velocity rules must see. Blocked rows are
    flagged, not removed. Without any usable rule every row passes and carries ``rules_not_ready``.
    A caller whose rules can change while it runs passes one kept snapshot.
    """
    usable = checked_rules(rules).where("problem IS NULL").drop("problem")
    rows = usable.limit(compile_limit + 1).collect()
    columns = enriched.columns
    if not rows:
        out = enriched.withColumns({
            "rule_id": F.lit(None).cast("string"), "rule_type": F.lit(None).cast("string"),
            "decision": F.lit(None).cast("string")})
    elif _few(rows, compile_limit):
        out = _compiled(with_velocity(enriched, _least_counts(rows), recent), rows)
    else:
        thresholds = _thresholds(usable)
        out = _joined(with_velocity(enriched, thresholds, recent), usable, sorted(thresholds))
    return out.select(
        *columns, "rule_id", "rule_type", F.coalesce("decision", F.lit("PASS")).alias("decision"),
        F.lit(not rows).alias("rules_not_ready"))


def matches_by_type(enriched: DataFrame, rules: DataFrame, compile_limit: int = COMPILE_LIMIT) -> DataFrame:
    """The winning rule of every rule type that holds on a transaction, in one pass over the transactions.

    Rows ``transaction_id``, ``rule_id``, ``rule_type``, ``decision``; a transaction without a match has none.
    """
    usable = checked_rules(rules).where("problem IS NULL").drop("problem")
    rows = usable.limit(compile_limit + 1).collect()
    if not _few(rows, compile_limit):
        thresholds = _thresholds(usable)
        hits = _hits(with_velocity(enriched, thresholds), usable, sorted(thresholds))
        best = hits.groupBy("transaction_id", F.col("verdict.rule_type").alias("rule_type")).agg(F.max("verdict").alias("_v"))
        return best.select("transaction_id", "_v.rule_id", "rule_type", F.col("_v.action").alias("decision"))
    kinds = sorted({r["rule_type"] for r in rows})
    found = F.array(*[_verdict([r for r in rows if r["rule_type"] == kind]) for kind in kinds]) if kinds else F.expr(
        "cast(array() AS array<struct<rule_id:string,rule_type:string,decision:string>>)")
    return with_velocity(enriched, _least_counts(rows)).select("transaction_id", F.inline(F.array_compact(found)))

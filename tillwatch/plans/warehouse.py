"""The lake as a graph of DataFrames, from Bronze to the Gold marts.

Bronze is deduplicated and converted once. Whatever reads the result more than once (decisions,
detectors, points, outcomes) starts from ``facts``, the same rows written as a table to the shared
folder, and scans only its own columns; a plan that needs the rows once uses ``clean`` directly.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwatch.functions.exprs import device_hash
from tillwatch.operators.card_testing import card_testing
from tillwatch.operators.enrich import enrich
from tillwatch.operators.latest import content_order, current_rows, latest
from tillwatch.operators.points import loyalty_points
from tillwatch.operators.rules import active_rules, decide
from tillwatch.operators.travel import impossible_travel
from tillwatch.plans import fraud, lifecycle, loyalty, merchant
from tillwatch.plans.silver import clean, protect
from tillwatch.sources.seeds import Seeds


class Warehouse:
    def __init__(
        self, payments: DataFrame, profile_changes: DataFrame, rules: DataFrame, labels: DataFrame,
        redemptions: DataFrame, seeds: Seeds, salt: str,
        stage: Callable[[DataFrame, str], DataFrame],
    ):
        self.payments = payments
        self.profile_changes = profile_changes
        self.rule_rows = rules
        self.label_rows = labels
        self.redemption_rows = redemptions
        self.seeds = seeds
        self.salt = salt
        self.stage = stage

    @cached_property
    def clean(self) -> DataFrame:
        return clean(self.payments, self.seeds.fx_rate)

    @cached_property
    def facts(self) -> DataFrame:
        """The clean rows as a written table: it outlives lost executors and is scanned by column."""
        return self.stage(self.clean, "facts")

    @cached_property
    def silver(self) -> DataFrame:
        return protect(self.facts, self.salt)

    @cached_property
    def labels(self) -> DataFrame:
        """The newest verdict of every transaction; labels are revised for weeks."""
        return latest(self.label_rows, ["transaction_id"], [F.desc("resolved_at"), content_order(self.label_rows)])

    @cached_property
    def redemptions(self) -> DataFrame:
        """One row per redemption; of differing copies the earliest."""
        return latest(self.redemption_rows, ["redemption_id"], [F.asc("event_ts"), content_order(self.redemption_rows)])

    @cached_property
    def profiles(self) -> DataFrame:
        return current_rows(
            self.profile_changes, ["user_id"], [F.desc("updated_at"), content_order(self.profile_changes)])

    @cached_property
    def rules(self) -> DataFrame:
        return active_rules(self.rule_rows)

    @cached_property
    def enriched(self) -> DataFrame:
        return enrich(self.facts, self.profiles)

    @cached_property
    def decided(self) -> DataFrame:
        return decide(self.enriched, self.rules)

    @cached_property
    def card_testing(self) -> DataFrame:
        return card_testing(self.facts)

    @cached_property
    def travel(self) -> DataFrame:
        return impossible_travel(self.facts)

    @cached_property
    def alerts(self) -> DataFrame:
        """One alert stream from the three detectors."""
        return fraud.alert_stream(self.decided, self.card_testing, self.travel).withColumn(
            "device_hash", device_hash(F.col("device_id"), self.salt)).drop("device_id")

    @cached_property
    def outcomes(self) -> DataFrame:
        return fraud.outcomes(self.decided, self.card_testing, self.travel, self.labels)

    @cached_property
    def fct_fraud_performance(self) -> DataFrame:
        return fraud.fct_fraud_performance(self.outcomes, self.seeds.cost_assumptions)

    @cached_property
    def points(self) -> DataFrame:
        return loyalty_points(self.decided.select(
            "transaction_id", "user_id", "dt", "event_ts", "amount_vnd", "status", "txn_type",
            "decision", "account_tier", loyalty.group_of_user().alias("experiment_group")))

    @cached_property
    def loyalty_users(self) -> DataFrame:
        return loyalty.user_days(self.points)

    @cached_property
    def redeemed(self) -> DataFrame:
        return loyalty.redeemed_days(self.redemptions, self.profiles)

    @cached_property
    def fct_loyalty_analytics(self) -> DataFrame:
        return loyalty.fct_loyalty_analytics(
            self.loyalty_users, self.redeemed, self.seeds.cost_assumptions)

    @cached_property
    def fct_merchant_profitability(self) -> DataFrame:
        return self.merchant_margin(self.facts)

    def merchant_margin(self, rows: DataFrame) -> DataFrame:
        return merchant.fct_merchant_profitability(rows, self.labels, self.seeds)

    @cached_property
    def suspended(self) -> DataFrame:
        return lifecycle.suspended_by_risk(self.alerts, self.outcomes)

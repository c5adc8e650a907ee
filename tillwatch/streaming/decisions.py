"""The decision stream: admit, hold until the watermark, then judge, detect, award and route.

A micro-batch is admitted at once: parsed, freed of repeats, enriched, measured, added to the minute
table. A row is judged when the watermark passes it, because only then every earlier row that is on time
has arrived: velocity counts, card-testing chains, neighbouring positions and trailing sums then see the
same rows as the batch operators, however the rows were spread over micro-batches. Rows that arrive below
the watermark are late: they are judged on arrival and take the side output.

Judging uses the batch operators over the rows that the watermark has just passed and a look-back read
from the stream's own output. The look-back is as long as the longest window of the rules in force. There
is no keyed state to grow and no Python on the rows, and a hot user or device is cut into time slices.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tillwatch.functions.exprs import experiment_group
from tillwatch.operators.arrival import with_arrival_watermark
from tillwatch.operators.card_testing import card_testing
from tillwatch.operators.enrich import enrich
from tillwatch.operators.latest import dedup
from tillwatch.operators.points import SPAN_MS, earns_points, loyalty_points
from tillwatch.operators.quantiles import selected_percentiles
from tillwatch.operators.rules import RULE_ATTRIBUTES, checked_rules, decide
from tillwatch.operators.slices import HOUR, SECOND
from tillwatch.operators.travel import impossible_travel
from tillwatch.plans.fraud import alert_stream
from tillwatch.plans.silver import to_vnd
from tillwatch.schemas import PAYMENT_EVENT
from tillwatch.sources.files import with_parsed
from tillwatch.streaming import sinks

WATERMARK_MS = 10 * SECOND
# The longest look-back of points, card testing and travel; rules may reach further.
DETECTOR_REACH_MS = SPAN_MS
LONG_AGO = -(1 << 62)
NO_BATCH = LONG_AGO
MARK = ("batch_id bigint, nth bigint, lo_ms bigint, hi_ms bigint, done_lo_ms bigint, done_hi_ms bigint, "
        "top_ms bigint, passed_ms bigint")


@dataclass
class Mark:
    """What one batch covered: admitted and judged event times (empty ranges have lo > hi), the largest
    event time so far, and the time up to which every on-time row has been judged."""

    batch_id: int
    nth: int = 0
    lo_ms: int = 1
    hi_ms: int = LONG_AGO
    done_lo_ms: int = 1
    done_hi_ms: int = LONG_AGO
    top_ms: int | None = None
    passed_ms: int = LONG_AGO


def _instant(ms: int) -> Column:
    """An event time as a literal that a scan can be pruned by."""
    return F.timestamp_millis(F.lit(max(ms, 0)))


class DecisionStream:
    """State of one running decision stream: where it writes and how far event time has come.

    ``profiles``, ``rules`` and ``fx_rate`` are called once per micro-batch and return the snapshot
    of that moment, so a changed rule or profile takes effect without a restart. The data side only
    reads them. ``rules`` may be a ``RuleBook``, which notes the version that each batch has used.

    Below ``out``: ``parsed``, ``admitted`` and ``decided`` rows, ``topics``, ``kpi_minute``, ``quarantine`` and
    ``rules_quarantine`` by batch, and ``marks``, one row per batch with the event times it covers, by
    which later batches choose the folders they read. A batch without a mark is repeated as a whole.
    """

    def __init__(
        self, spark: SparkSession, out: str, profiles: Callable[[], DataFrame],
        rules: Callable[[], DataFrame], fx_rate: Callable[[], DataFrame], reach_ms: int = DETECTOR_REACH_MS,
    ):
        self.spark, self.out, self.reach_ms = spark, out, reach_ms
        self.profiles, self.rules, self.fx_rate = profiles, rules, fx_rate
        self.marks: dict[int, Mark] = {}
        # marks of all batches that reach up to this event time are in memory
        self.known_from: int | None = None

    # -- progress ---------------------------------------------------------------------------------

    def _read_marks(self, condition, newest: bool = False) -> list[Mark]:
        try:
            marks = self.spark.read.schema(MARK).parquet(f"{self.out}/marks")
        except AnalysisException as missing:  # nothing written yet
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return []
        marks = marks.where(condition)
        if newest:
            marks = marks.orderBy(F.desc("nth")).limit(1)
        return [Mark(**r.asDict()) for r in marks.collect()]

    def _marks_from(self, floor: int, batch_id: int) -> list[Mark]:
        """Marks of earlier batches that cover event times from ``floor`` on."""
        if self.known_from is None or floor < self.known_from:
            last = self._before(batch_id)
            found = self._read_marks((F.col("hi_ms") >= floor) | (F.col("done_hi_ms") >= floor))
            self.marks = {m.batch_id: m for m in [*found, last] if m.batch_id != NO_BATCH}
            self.known_from = floor
        return [m for m in self.marks.values() if m.batch_id != batch_id and max(m.hi_ms, m.done_hi_ms) >= floor]

    def _before(self, batch_id: int) -> Mark:
        """How far the stream had come before this batch, by the order of completion."""
        earlier = [m for m in self.marks.values() if m.batch_id != batch_id]
        if not earlier:
            earlier = self._read_marks(F.col("batch_id") != batch_id, newest=True)
            self.marks.update({m.batch_id: m for m in earlier})
        return max(earlier, key=lambda m: m.nth, default=Mark(NO_BATCH))

    def _forget(self, floor: int) -> None:
        """Drop marks that a running stream no longer needs; they can be read again."""
        newest = max(self.marks.values(), key=lambda m: m.nth).batch_id
        self.marks = {b: m for b, m in self.marks.items()
                      if b == newest or max(m.hi_ms, m.done_hi_ms) >= floor}
        self.known_from = floor if self.known_from is None else max(self.known_from, floor)

    # -- reading back -----------------------------------------------------------------------------

    def _stored(self, kind: str, marks: list[Mark], lo: int, hi: int, hours: list[int] | None = None) -> DataFrame | None:
        """Rows of earlier batches with lo <= event time < hi, in some of the event hours only if given."""
        spans = [(m.batch_id, m.lo_ms, m.hi_ms) if kind == "admitted" else (m.batch_id, m.done_lo_ms, m.done_hi_ms)
                 for m in marks]
        wanted = [(lo, hi)] if hours is None else [(h * HOUR, (h + 1) * HOUR) for h in hours]
        paths = [f"{self.out}/{kind}/batch_id={b}" for b, first, last in sorted(spans)
                 if first <= last and any(last >= x and first < y for x, y in wanted)]
        if not paths:
            return None
        rows = self.spark.read.parquet(*paths)
        if hours is not None:
            rows = rows.where(F.floor(F.unix_millis("event_ts") / HOUR).isin(hours))
        return rows.where(F.col("event_ts").between(_instant(lo), _instant(hi - 1)))

    def _write(self, rows: DataFrame, kind: str, batch_id: int) -> DataFrame:
        path = sinks.write_batch(rows, f"{self.out}/{kind}", batch_id)
        return self.spark.read.schema(rows.schema).parquet(path)

    # -- one micro-batch --------------------------------------------------------------------------

    def process(self, batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        # text is parsed once
        names = [f.name for f in PAYMENT_EVENT.fields if f.name != "timestamp"]
        parsed = with_parsed(batch, PAYMENT_EVENT).select(
            "key", F.when(~F.col("ok"), F.col("value")).alias("value"), "ingested_at", "event_ts",
            *[F.col(f"e.{n}").alias(n) for n in names], "ok")
        stored = self.spark.read.schema(parsed.schema).parquet(
            sinks.write_batch(parsed, f"{self.out}/parsed", batch_id, by=["ok"]))
        sinks.write_batch(stored.where("NOT ok").select("key", "value", "ingested_at"), f"{self.out}/quarantine", batch_id)
        events = stored.where("ok").select(*names, "event_ts", "ingested_at", F.to_date("event_ts").alias("dt"))
        before = self._before(batch_id)
        rows = dedup(events).persist()
        try:
            ms = F.unix_millis("event_ts")
            lo, hi, hours = rows.agg(F.min(ms), F.max(ms), F.collect_set(F.floor(ms / HOUR).cast("bigint"))).first()
            if lo is None:
                return
            # a repeat carries the event time of its first copy, so only those hours are read
            seen = self._stored("admitted", self._marks_from(lo, batch_id), lo, hi + 1, sorted(hours))
            # both sides meet by transaction, as the rows already lie; the ids seen do not go to every task
            fresh = rows if seen is None else rows.join(
                seen.select("transaction_id").hint("merge"), "transaction_id", "left_anti")
            late = F.lit(False) if before.top_ms is None else F.unix_millis("event_ts") < before.top_ms - WATERMARK_MS
            # the rate serves the decision only; Silver converts again
            admitted = self._write(
                enrich(to_vnd(fresh, self.fx_rate()), self.profiles()).withColumn("late", late), "admitted", batch_id)
        finally:
            rows.unpersist()
        top = hi if before.top_ms is None else max(hi, before.top_ms)
        mark = Mark(batch_id=batch_id, nth=before.nth + 1, top_ms=top,
                    passed_ms=max(before.passed_ms, top - WATERMARK_MS))
        lo, hi = admitted.agg(F.min(ms), F.max(ms)).first()
        if lo is not None:
            mark.lo_ms, mark.hi_ms = lo, hi
        self._close(admitted, before, mark)

    def drain(self) -> None:
        """End of a finite input: judge the rows that still wait for the watermark."""
        before = self._before(NO_BATCH)
        if before.top_ms is not None and before.passed_ms <= before.top_ms:
            # batches of the engine count from 0, so a negative number is free
            self._close(None, before, Mark(
                batch_id=-2 - before.nth, nth=before.nth + 1, top_ms=before.top_ms, passed_ms=before.top_ms + 1))

    def _close(self, admitted: DataFrame | None, before: Mark, mark: Mark) -> None:
        """Judge what the watermark has passed with this batch, and what arrived below it."""
        # one snapshot for the whole batch, and the same one if the batch is repeated
        snapshot = self.rules.of_batch(mark.batch_id) if hasattr(self.rules, "of_batch") else self.rules()
        rules = checked_rules(snapshot, RULE_ATTRIBUTES).persist()
        try:
            sinks.write_batch(rules.where("problem IS NOT NULL"), f"{self.out}/rules_quarantine", mark.batch_id)
            reach = max(self.reach_ms, longest_window_ms(rules))
            ms = F.unix_millis("event_ts")
            waiting = self._stored(
                "admitted", self._marks_from(before.passed_ms - reach, mark.batch_id), before.passed_ms, mark.passed_ms)
            ready = [] if waiting is None else [waiting]
            if admitted is not None:
                ready.append(admitted.where(ms < mark.passed_ms))
            if not ready:
                self._mark(mark, reach)
                return
            target = ready[0] if len(ready) == 1 else ready[0].unionByName(ready[1])
            # a column of stored files: nothing is worth keeping in memory
            lo, hi, below = target.agg(F.min(ms), F.max(ms), F.min(F.when(ms < before.passed_ms, ms))).first()
            if lo is not None:
                self._judge(target, rules, admitted, before, mark, reach, below)
                mark.done_lo_ms, mark.done_hi_ms = lo, hi
            elif admitted is not None:
                self._publish(None, None, admitted, before, mark)
            self._mark(mark, reach)
        finally:
            rules.unpersist()

    def _judge(self, target, rules, admitted, before: Mark, mark: Mark, reach: int, below: int | None) -> None:
        ms = F.unix_millis("event_ts")
        # rows the watermark has passed need the look-back before it; rows below it need their own
        floor = before.passed_ms - reach if below is None else below - reach
        known = self._stored("decided", self._marks_from(floor, mark.batch_id), floor, mark.passed_ms)
        decided = self._write(decide(target, rules, recent=known), "decided", mark.batch_id)
        context = decided.withColumn("_ours", F.lit(True))
        if known is not None:
            context = context.unionByName(known.select(*decided.columns, F.lit(False).alias("_ours")))
        self._publish(decided, context, admitted, before, mark)

    def _publish(self, decided, context, admitted, before: Mark, mark: Mark) -> None:
        """``context`` is ``decided`` with the look-back; ``_ours`` tells the rows of this batch."""
        routes = []
        if decided is not None:
            alerts = alert_stream(
                decided, card_testing(context, also=("_ours",)).where("_ours"),
                impossible_travel(context, also=("_ours",)).where("_ours"))
            # rows that cannot earn count for nothing, and only these columns are needed
            earning = context.where("NOT late").where(earns_points()).select(
                "transaction_id", "user_id", "dt", "event_ts", "amount_vnd", "status", "txn_type", "decision", "_ours",
                experiment_group(F.col("user_id")).alias("experiment_group"))
            points = loyalty_points(earning).where("_ours").select(
                "transaction_id", "user_id", "dt", "event_ts", "total_15m", "multiplier", "points")
            routes += [
                sinks.routed(decided.where("decision = 'BLOCK'").drop("late"), "blocked_transactions", "user_id"),
                sinks.routed(alerts, "fraud_alerts", "user_id"),
                sinks.routed(points, "loyalty_points", "user_id"),
                sinks.routed(decided.where("late"), "late_events", "user_id")]
        if admitted is not None:
            routes.append(sinks.routed(batch_metrics(admitted, before.top_ms, mark), "stream_metrics", "batch_id"))
            sinks.write_batch(sinks.serving_delta(admitted), f"{self.out}/kpi_minute", mark.batch_id)
        everything = routes[0]
        for part in routes[1:]:
            everything = everything.unionByName(part)
        sinks.fan_out(everything, f"{self.out}/topics", mark.batch_id)

    def _mark(self, mark: Mark, reach: int) -> None:
        row = self.spark.createDataFrame([tuple(vars(mark).values())], MARK)
        sinks.write_batch(row.coalesce(1).drop("batch_id"), f"{self.out}/marks", mark.batch_id)
        self.marks[mark.batch_id] = mark
        self._forget(mark.passed_ms - reach)

    def run(self, raw: DataFrame, checkpoint: str, finite: bool = False, drain: bool = True) -> StreamingQuery:
        """Start the stream. A ``finite`` run ends with its input; ``drain`` then judges the last rows."""
        writer = raw.writeStream.foreachBatch(self.process).option("checkpointLocation", checkpoint)
        query = sinks.start(writer, finite, "5 seconds")
        if finite and drain:
            self.drain()
        return query


def longest_window_ms(rules: DataFrame) -> int:
    """The longest velocity window among checked rules."""
    return SECOND * (rules.where("problem IS NULL").agg(F.max("window_sec")).first()[0] or 0)


def batch_metrics(admitted: DataFrame, top_before: int | None, mark: Mark) -> DataFrame:
    """Health of one micro-batch: size, lag, watermark lag, late and out-of-order shares.

    ``lag`` is arrival minus event time. A row is out of order if it is older than a row that arrived in
    an earlier batch, or earlier in this one. ``watermark_lag_ms`` is the newest arrival minus the watermark
    after the batch.
    """
    rows = with_arrival_watermark(admitted.withColumnRenamed("late", "_late")).withColumn("batch_id", F.lit(mark.batch_id))
    older = F.col("out_of_order")
    if top_before is not None:
        older = older | (F.col("event_ms") < top_before)
    rates = rows.groupBy("batch_id").agg(
        F.avg(F.col("_late").cast("int")).alias("late_rate"), F.avg(older.cast("int")).alias("out_of_order_rate"),
        (F.max("arrived_ms") - mark.top_ms + WATERMARK_MS).alias("watermark_lag_ms"))
    lags = selected_percentiles(rows, ["batch_id"], F.col("arrived_ms") - F.col("event_ms"), {
        "lag_p50_ms": 0.5, "lag_p95_ms": 0.95, "lag_p99_ms": 0.99})
    return rates.join(lags.withColumnRenamed("n", "events"), "batch_id")


def progress_metrics(query: StreamingQuery) -> dict:
    """What the engine itself reports about the last batch."""
    p = query.lastProgress or {}
    ops = p.get("stateOperators") or []
    return {
        "batch_id": p.get("batchId"),
        "rows": p.get("numInputRows"),
        "rows_per_s": p.get("processedRowsPerSecond"),
        "watermark": (p.get("eventTime") or {}).get("watermark"),
        "dropped_late": sum(op.get("numRowsDroppedByWatermark", 0) for op in ops),
    }

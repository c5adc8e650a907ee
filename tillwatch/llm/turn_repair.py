"""Cheapest repair of conversations to ``(s?(ua)+)?`` by Four-Russians block tables.

A row is one of nine symbols: it must go, or it has a role initial (s, u, a, other) and is whole or
truncated. Four states tell what the repaired roles so far end in. The cost to go from each state to the
end is a vector of four numbers; less its minimum, it is one of a few dozen, because no two states are
ever far apart. The tables hold, for every such vector and every block of ``BLOCK`` symbols, the vector
before the block and what the minimum grew by. A conversation is read from its end a block per look-up
and only the vectors between blocks are kept. The edits are then traced from the start: each block is
expanded backward into its inner vectors, and at every row the first letter (D, I, K, R) that keeps the
cost is taken. Costs to go are exact for every suffix, so ties fall to the ASCII-least audit.

Rows of a conversation come to one task twice, first without text, then with it. The task keeps a byte
and an edit per row but never a text, and the digest runs along, so a long conversation costs time and
not memory.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.window import Window

from tillwatch.llm.common import bound_batches, per_process
from tillwatch.llm.line_dedup import WHITE

BLOCK = 4
SYMBOLS = 9
DELETE = 0  # 1 + 2 * initial + truncated for the others
SYSTEM, USER, ASSISTANT, OTHER = range(4)
LEGAL = {(SYSTEM, USER), (USER, ASSISTANT), (ASSISTANT, USER)}
#: States: 0 nothing yet, 1 after s, 2 after u, 3 after a. What an inserted or renamed row leads to:
NEXT = (2, 2, 3, 2)
ROLE_INTO = {2: "user", 3: "assistant"}
COST_DELETE, COST_CHANGE, COST_TRUNCATED = 3, 2, 1
WHOLE, BLANK, REPEATED, TRUNCATED, GONE = 0, 1, 2, 3, -1


def keep_into(state: int, initial: int) -> int | None:
    """The state after a row kept as it is; None if it cannot stand there."""
    if initial == SYSTEM:
        return 1 if state == 0 else None
    if initial == USER:
        return 2 if state != 2 else None
    return 3 if initial == ASSISTANT and state == 2 else None


def with_inserts(costs: list[float]) -> tuple[float, ...]:
    """The costs when rows may be inserted first; two suffice, a third leads back."""
    return tuple(
        min(costs[s], COST_CHANGE + costs[NEXT[s]], 2 * COST_CHANGE + costs[NEXT[NEXT[s]]]) for s in range(4))


#: Only 0 and 3 may end.
AT_END = with_inserts([0, float("inf"), float("inf"), 0])


def edits_of(symbol: int, state: int) -> list[tuple[str, int, int]]:
    """(letter, cost, next state) of what may be done with a row, in the order of the letters."""
    found = [("D", COST_DELETE, state)]
    if symbol != DELETE:
        initial, truncated = divmod(symbol - 1, 2)
        into = keep_into(state, initial)
        if into is not None:
            found.append(("K", truncated * COST_TRUNCATED, into))
        found.append(("R", COST_CHANGE + truncated * COST_TRUNCATED, NEXT[state]))
    return found


def before(symbol: int, costs: tuple[float, ...]) -> tuple[float, ...]:
    """Costs to go in front of a row, from those behind it."""
    return with_inserts([min(c + costs[t] for _, c, t in edits_of(symbol, s)) for s in range(4)])


class BlockTables:
    """Normalised vectors, their transitions over single symbols and over whole blocks, and the edits."""

    def __init__(self, block: int = BLOCK):
        self.block = block
        self.vectors: list[tuple[int, ...]] = []
        index: dict[tuple[int, ...], int] = {}

        def number(costs: tuple[float, ...]) -> tuple[int, int]:
            least = int(min(costs))
            vector = tuple(int(c) - least for c in costs)
            if vector not in index:
                index[vector] = len(self.vectors)
                self.vectors.append(vector)
            return index[vector], least

        self.end, _ = number(AT_END)
        one: list[list[tuple[int, int]]] = []
        while len(one) < len(self.vectors):  # every vector that can be reached
            one.append([number(before(symbol, self.vectors[len(one)])) for symbol in range(SYMBOLS)])
        self.one = one
        step = np.array([[v for v, _ in row] for row in one], np.int32)
        grow = np.array([[g for _, g in row] for row in one], np.int32)
        # block codes read forward, so the first symbol is the last to be applied
        into, cost = np.arange(len(one), dtype=np.int32)[:, None], np.zeros((len(one), 1), np.int32)
        for _ in range(block):
            cost = np.concatenate([cost + grow[into, s] for s in range(SYMBOLS)], axis=1)
            into = np.concatenate([step[into, s] for s in range(SYMBOLS)], axis=1)
        self.into, self.cost = into.tolist(), cost.tolist()
        self.steps = {
            (after, symbol): tuple(self._step(after, symbol, s) for s in range(4))
            for after, symbol in product(range(len(one)), range(SYMBOLS))}
        self.tails = tuple(self._tail(s) for s in range(4))

    def _step(self, after: int, symbol: int, state: int) -> tuple[str, int]:
        """ASCII-least edits up to and including a row, and the state behind it."""
        behind, (here, grown) = self.vectors[after], self.one[after][symbol]
        costs, letters = [c + grown for c in self.vectors[here]], ""
        while True:
            options = [*edits_of(symbol, state), ("I", COST_CHANGE, NEXT[state])]
            for letter, cost, into in sorted(options):
                if costs[state] == cost + (costs if letter == "I" else behind)[into]:
                    break
            letters, state = letters + letter, into
            if letter != "I":
                return letters, state

    def _tail(self, state: int) -> str:
        """Rows inserted behind the last one."""
        letters = ""
        while AT_END[state]:
            letters, state = letters + "I", NEXT[state]
        return letters

    def repair(self, symbols: bytes | bytearray) -> tuple[int, list[str], str]:
        """The cost, the edits of every row (those inserted before it first), and the inserts at the end."""
        block, first = self.block, len(symbols) % self.block
        vector, cost, between = self.end, 0, []
        for at in range(len(symbols) - block, first - 1, -block):
            code = 0
            for symbol in symbols[at:at + block]:
                code = code * SYMBOLS + symbol
            between.append(vector)
            cost += self.cost[vector][code]
            vector = self.into[vector][code]
        edits, state = [], 0
        start = self._inner(symbols[:first], vector)
        for symbol, after in start:
            cost += self.one[after][symbol][1]
        vector = self.one[start[0][1]][start[0][0]][0] if start else vector
        cost += self.vectors[vector][0]
        spans = [(start, first)] + [(None, at + block) for at in range(first, len(symbols), block)]
        for inner, end in spans:
            for symbol, after in self._inner(symbols[end - block:end], between.pop()) if inner is None else inner:
                letters, state = self.steps[after, symbol][state]
                edits.append(letters)
        return cost, edits, self.tails[state]

    def _inner(self, symbols: bytes | bytearray, vector: int) -> list[tuple[int, int]]:
        """A block expanded backward: each symbol with the vector behind it, in reading order."""
        found = []
        for symbol in reversed(symbols):
            found.append((symbol, vector))
            vector = self.one[vector][symbol][0]
        return found[::-1]


class Conversation:
    """What a task keeps of the conversation it is reading."""

    def __init__(self, key, tables: BlockTables):
        self.key, self.tables = key, tables
        self.symbols = bytearray()
        self.counts = {BLANK: 0, REPEATED: 0, TRUNCATED: 0}
        self.illegal, self.last = 0, None
        self.first_turn = self.last_turn = None
        self.turns = 0
        self.plan: tuple[int, list[str], str] | None = None
        self.at = self.state = self.place = 0
        self.digest = hashlib.sha256()

    def note(self, turn: int | None, initial: int, fault: int) -> None:
        """A row without its text."""
        if fault == GONE:
            return
        if fault != WHOLE:
            self.counts[fault] += 1
        self.symbols.append(DELETE if fault in (BLANK, REPEATED) else 1 + 2 * initial + (fault == TRUNCATED))
        if self.last is not None and (self.last, initial) not in LEGAL:
            self.illegal += 1
        self.last = initial
        if turn is not None and turn != self.last_turn:
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.last_turn, self.turns = turn, self.turns + 1

    def _planned(self) -> tuple[int, list[str], str]:
        if self.plan is None:
            self.plan = self.tables.repair(self.symbols)
        return self.plan

    def _put(self, edit: str, role: str, text: str) -> tuple:
        self.digest.update(f"{chr(10) if self.place else ''}{role}:{text}".encode())
        self.place += 1
        return self.key, self.place - 1, edit, role, text

    def _inserted(self) -> tuple:
        self.state = NEXT[self.state]
        return self._put("I", ROLE_INTO[self.state], "")

    def take(self, role: str, text: str) -> Iterator[tuple]:
        """The next row with its text: the repaired rows up to it."""
        letters, symbol = self._planned()[1][self.at], self.symbols[self.at]
        self.at += 1
        for _ in letters[:-1]:
            yield self._inserted()
        if letters[-1] != "D":
            initial = (symbol - 1) // 2
            self.state = keep_into(self.state, initial) if letters[-1] == "K" else NEXT[self.state]
            yield self._put(letters[-1], role if letters[-1] == "K" else ROLE_INTO[self.state], text)

    def close(self) -> Iterator[tuple]:
        for _ in self._planned()[2]:
            yield self._inserted()

    def report(self) -> tuple:
        cost, edits, tail = self._planned()
        gaps = self.last_turn - self.first_turn + 1 - self.turns if self.turns else 0
        return (self.key, gaps, self.counts[BLANK], self.counts[REPEATED], self.counts[TRUNCATED], self.illegal, cost,
                "".join(edits) + tail, self.digest.hexdigest())


ROWS = "place bigint, edit string, role string, text string"
REPORT = ("gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, "
          "repaired_sha256 string")
IN_BATCH = 1000


def _reader(schema: pa.Schema, whole: bool):
    """A function for ``mapInArrow``: repaired rows, or one report per conversation."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = per_process("turn_tables", BlockTables)
        now: Conversation | None = None
        out: list[tuple] = []

        def packed() -> pa.RecordBatch:
            columns = zip(*out, strict=True) if out else [[] for _ in schema]
            made = pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)
            out.clear()
            return made

        def end() -> None:
            rest = list(now.close())
            out.extend(rest if whole else [now.report()])

        for batch in batches:
            for key, turn, role, text, initial, fault in zip(
                    *(batch.column(n).to_pylist() for n in ("conv", "turn", "role", "text", "initial", "fault")),
                    strict=True):
                if now is None or key != now.key:
                    if now is not None:
                        end()
                    now = Conversation(key, tables)
                if fault is not None:
                    now.note(turn, initial, fault)
                elif whole:
                    out.extend(now.take(role, text))
                else:
                    for _ in now.take(role, text):
                        pass
                if len(out) >= IN_BATCH:
                    yield packed()
        if now is not None:
            end()
        yield packed()

    return read


def damaged(conversations: DataFrame) -> DataFrame:
    """``conv turn role text gone``: rows after the damage that crc32 of ``conv_id:turn`` decides.

    Of the remainders by 20: 0 drops the row (it stays here, marked ``gone``), 1 empties its text, 2 takes
    ``.!?`` out of it, 3 puts it twice, 4 makes it a user's. A null (id and turn within the hash, role and
    text) reads as one space.
    """
    def filled(name: str) -> Column:
        return F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(" "))

    hit = F.crc32(F.concat(filled("conv_id"), F.lit(":"), filled("turn"))) % 20
    text = F.when(hit == 1, "").when(hit == 2, F.translate(filled("text"), ".!?", "")).otherwise(filled("text"))
    row = F.struct(
        F.col("conv_id").alias("conv"), F.col("turn").cast("bigint").alias("turn"),
        F.when(hit == 4, "user").otherwise(filled("role")).alias("role"), text.alias("text"), (hit == 0).alias("gone"))
    return conversations.select(F.inline(F.when(hit == 3, F.array(row, row)).otherwise(F.array(row))))


def _in_order(rows: DataFrame) -> DataFrame:
    """Every row twice, by conversation: first all without their text but with their fault, then all with it."""
    marked = rows.withColumns({"mark": F.md5("text"), "initial": F.substring("role", 1, 1)})
    initial = F.when(F.col("initial") == "s", SYSTEM).when(F.col("initial") == "u", USER).when(
        F.col("initial") == "a", ASSISTANT).otherwise(OTHER)
    body = F.rtrim(F.col("text"), F.lit(WHITE))
    plain = F.when(F.col("gone"), GONE).when(body == "", BLANK).when(
        F.substring(body, -1, 1).isin(".", "!", "?"), WHOLE).otherwise(TRUNCATED)
    same = Window.partitionBy("conv", "gone", "role", "mark").orderBy("turn")
    narrow = (
        marked.select("conv", "turn", "role", "mark", "gone", initial.alias("initial"), plain.alias("fault"))
        .withColumn("nth", F.row_number().over(same))
        .withColumn("fault", F.when(F.col("fault").isin(GONE, BLANK) | (F.col("nth") == 1), F.col("fault")).otherwise(REPEATED)))
    none = F.lit(None)
    first = narrow.select(
        "conv", F.lit(0).alias("pass"), "turn", "role", "mark", none.cast("string").alias("text"), "initial", "fault", "nth")
    then = marked.where(~F.col("gone")).select(
        "conv", F.lit(1).alias("pass"), "turn", "role", "mark", "text", none.cast("int").alias("initial"),
        none.cast("int").alias("fault"), none.cast("int").alias("nth"))
    return first.unionByName(then).repartition("conv").sortWithinPartitions(
        "conv", "pass", "turn", "role", "mark", "nth")


def _read(rows: DataFrame, columns: str, whole: bool) -> DataFrame:
    bound_batches(rows.sparkSession)
    schema = T.StructType([T.StructField("conv_id", rows.schema["conv"].dataType), *T.StructType.fromDDL(columns)])
    return _in_order(rows).mapInArrow(_reader(to_arrow_schema(schema), whole), schema)


def repaired_rows(rows: DataFrame) -> DataFrame:
    """``conv_id place edit role text``: the repaired conversations of ``rows`` (``conv turn role text gone``).

    Rows are taken by turn (missing turns first, equal turns by role, then by the md5 of the text). A row is
    blank if it holds nothing but white space, a duplicate if role and text (by md5) came before in the
    conversation, truncated if its last visible character is none of ``.!?``; the first that fits counts.
    Blank and duplicate rows are deleted. Keeping costs nothing, a new role (user or assistant) 2, deleting
    3, inserting an empty row of a user or an assistant 2, and a truncated row that stays 1 more. Of the
    cheapest edits that give roles ``(s?(ua)+)?`` the ASCII-least are made. A missing id is a conversation.
    Rows marked ``gone`` count as absent. Empty tables give empty results.
    """
    return _read(rows, ROWS, whole=True)


def repair_report(rows: DataFrame) -> DataFrame:
    """One row per conversation of ``rows``: what is wrong with it, the cost and letters of its repair (as
    ``repaired_rows`` makes it), and the SHA-256 of the repaired ``role:text`` lines.

    Conversations without rows left give zeros, an empty audit and the hash of the empty string.
    """
    return _read(rows, REPORT, whole=False)

"""Repair of conversation structure by least weights.

A conversation's rows, by turn (nulls first; equal turns by role, then by a hash of the text), are kept (cost 0),
given the role user or assistant (3), or deleted (4); rows with an empty text and one of these two roles may be
inserted anywhere (3). What comes out has roles whose initials read ``(s?(ua)+)?``. Blank rows, and rows whose
role and text came before, must be deleted; a truncated row adds 3 unless deleted. Among the cheapest edits the
one whose letters (D, I, K, R, in order) come first in ASCII wins.

One integer holds both: its high digits the cost, its low digits the letters, two octal digits for each row's
slot, zeros at a slot's end where there is no letter. A slot is a row's own letter, or an insertion and then a
kept or new role (an insertion is never before a deletion: the other order costs the same and comes first;
two insertions before a row lead back to the same state). No slot is the start of another, so comparing slots in
place compares the strings; the slot after the last row, with up to two insertions, may end early, and its zeros
then say less. So an ordinary minimum over integers along the rows decides everything; nodes are the four states
of the pattern (nothing yet, after s, after u, after a).

Spread: identical rows are counted before anything moves. The first row of each role and text is found by an
aggregate and goes along as a mark of its own, so that a sort brings both together, however often a text comes.
All rows are sorted over the whole table by conversation and turn, and a task reads its share as a stream, in
segments of ``SEGMENT`` rows. A conversation that lies within one segment is settled at once. Of the others,
which run over a segment's or a task's end, each segment yields its least weight from each state to each, and its
texts. These weights are chained: since only four prefixes meet at a segment's end, a prefix's rank stands in for
its letters, and integers stay as long as a segment. The path found goes back to the segments, whose letters and
texts are then put together in order as a stream. What one task holds is a segment, four marks for each segment
of one conversation, and the audit of the conversation, which is a result cell.

Null roles and texts count as one space, null turns come first and count for no gap. Rows with zero copies only
say that the conversation exists. No rows: no faults, cost 0, empty audit. A null conversation id is a
conversation of its own. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256
from itertools import groupby
from operator import itemgetter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.llm.common import pick
from granary.session import scratch_path

SEGMENT = 256
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
BLANKS = " \t\n\x0b\x0c\r"
#: states: nothing yet, after s, after u, after a
NEXT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
GIVEN = {"u": "user", "a": "assistant"}
#: what is still to insert at the end
ENDS = {0: "", 1: "II", 2: "I", 3: ""}
LETTERS, DIGITS = str.maketrans("1234", "DIKR", "0"), str.maketrans("DIKR", "1234")
FORCED, CUT, GOOD = 0, 1, 2  # must go, truncated, neither


def slot(letters: str, rows: int = 1) -> int:
    """The digits of ``letters``, padded to the width of so many rows."""
    return int(letters.translate(DIGITS).ljust(2 * rows, "0") or "0", 8)


@lru_cache(maxsize=1024)
def edges(initial: str, state_of_row: int) -> tuple[tuple[tuple[int, int], int, int], ...]:
    """((from, to), cost, digits) of the least edit of a row between each two states."""
    best: dict[tuple[int, int], tuple[int, int]] = {}

    def add(q, to, cost, letters):
        new = (cost, slot(letters))
        best[q, to] = min(best.get((q, to), new), new)

    for q in range(4):
        add(q, q, DELETE, "D")
        if state_of_row != FORCED:
            more = TRUNCATED if state_of_row == CUT else 0
            for first, at, cost in [("", q, 0)] + [("I", NEXT[q, x], INSERT) for x in "ua" if (q, x) in NEXT]:
                if (at, initial) in NEXT:
                    add(q, NEXT[at, initial], cost + more, first + "K")
                for x in "ua":
                    if (at, x) in NEXT:
                        add(q, NEXT[at, x], cost + more + REROLE, first + "R")
    return tuple((k, *v) for k, v in best.items())


def least(rows: list[tuple[str, str, int]], start: int) -> dict[int, int]:
    """Least weight from ``start`` to each state: the cost, then two digits for each row."""
    width = 6 * len(rows)
    now, shift = {start: 0}, width
    for role, _, fate in rows:
        shift -= 6
        then: dict[int, int] = {}
        for (q, to), cost, digits in edges(role[:1], fate):
            if q in now:
                weight = now[q] + (cost << width) + (digits << shift)
                if to not in then or weight < then[to]:
                    then[to] = weight
        now = then
    return now


def split(weight: int, rows: int) -> tuple[int, str]:
    """(cost, letters) of a weight over so many rows."""
    width = 6 * rows
    low = weight & ((1 << width) - 1)
    return weight >> width, (f"{low:0{2 * rows}o}".translate(LETTERS) if rows else "")


def settled(rows: list[tuple[str, str, int]]) -> tuple[int, str]:
    """(cost, audit) of a whole conversation."""
    found = []
    for q, weight in least(rows, 0).items():
        # one more slot: the cost moves up with all digits
        found.append((weight << 6) + (INSERT * len(ENDS[q]) << 6 * (len(rows) + 1)) + slot(ENDS[q]))
    return split(min(found), len(rows) + 1)


def replay(rows: list[tuple[str, str, int]], audit: str, state: int) -> tuple[list[str], int]:
    """(``role:text`` of what the audit makes of the rows, state reached)."""
    out, row = [], iter(rows)
    for letter in audit:
        role, text = ("", "") if letter == "I" else next(row)[:2]
        if letter == "D":
            continue
        if letter != "K":
            role = GIVEN["a" if state == 2 else "u"]
        state = NEXT[state, role[:1]]
        out.append(f"{role}:{text}")
    return out, state


class Segment:
    """Consecutive rows of one conversation, with their counts."""

    COUNTS = ("blank", "duplicate", "truncated", "illegal", "turns")
    FIELDS = ("n", *COUNTS, "first", "last", "low", "high")

    def __init__(self):
        self.rows: list[tuple[str, str, int]] = []
        self.n = self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.first = self.last = self.low = self.high = None

    def add(self, turn, role: str, text: str, is_first: bool) -> None:
        held = text.rstrip(BLANKS)
        if not held:
            fate, self.blank = FORCED, self.blank + 1
        elif not is_first:
            fate, self.duplicate = FORCED, self.duplicate + 1
        elif held[-1] not in ".!?":
            fate, self.truncated = CUT, self.truncated + 1
        else:
            fate = GOOD
        initial = role[:1]
        if self.n:
            self.illegal += self.last + initial not in ("su", "ua", "au")
        else:
            self.first = initial
        self.last, self.n = initial, self.n + 1
        if turn is not None and turn != self.high:
            self.low = turn if self.low is None else self.low
            self.high, self.turns = turn, self.turns + 1
        self.rows.append((role, "" if fate == FORCED else text, fate))

    def follow(self, other) -> None:
        """Add the counts of the segment that comes next (an object with the same fields)."""
        if other.n:
            if self.n:
                self.illegal += self.last + other.first not in ("su", "ua", "au")
            else:
                self.first = other.first
            for name in self.COUNTS:
                setattr(self, name, getattr(self, name) + getattr(other, name))
            self.n, self.last = self.n + other.n, other.last
        if other.low is not None:
            self.turns -= self.high == other.low
            self.low = other.low if self.low is None else self.low
            self.high = other.high

    def result(self, conv, cost: int, audit: str, digest: str, repaired: str | None) -> dict:
        return {
            "conv_id": conv, "gaps": 0 if self.low is None else self.high - self.low + 1 - self.turns, "blank": self.blank,
            "duplicate": self.duplicate, "truncated": self.truncated, "illegal": self.illegal, "cost": cost, "audit": audit,
            "repaired_sha256": digest, "repaired": repaired,
        }

    def whole(self, conv, with_text: bool) -> dict:
        cost, audit = settled(self.rows)
        text = "\n".join(replay(self.rows, audit, 0)[0])
        return self.result(conv, cost, audit, sha256(text.encode("utf-8")).hexdigest(), text if with_text else None) | {"segment": None}

    def part(self, conv, task: int, seq: int) -> dict:
        costs, audits = [None] * 16, [None] * 16
        for q in range(4):
            for to, weight in least(self.rows, q).items():
                costs[4 * q + to], audits[4 * q + to] = split(weight, len(self.rows))
        return {"conv_id": conv, "segment": {
            **{f: getattr(self, f) for f in self.FIELDS}, "task": task, "seq": seq, "costs": costs, "audits": audits,
            "roles": [r[0] for r in self.rows], "texts": [r[1] for r in self.rows],
        }}


RESULT = (
    "conv_id string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
    "repaired_sha256 string, repaired string"
)
PART = (
    "n long, blank long, duplicate long, truncated long, illegal long, turns long, first string, last string, low long, "
    "high long, task long, seq long, costs array<long>, audits array<string>, roles array<string>, texts array<string>"
)


def _rows(batches) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns))


def _batches(rows: Iterator[dict], schema, at_once: int = 200):
    import pyarrow as pa

    held = []
    for row in rows:
        held.append(row)
        if len(held) >= at_once:
            yield pa.RecordBatch.from_pylist(held, schema)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def _arrow(ddl: str, spark):
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(ddl))


def _segments(rows: Iterator[tuple], task: int, most: int, with_text: bool) -> Iterator[dict]:
    """Results of conversations that lie inside the task and one segment, segments of the others. ``rows``: conv,
    turn, role, hash, kind (0: the mark of a first row), copies, text; sorted."""
    seq, first_conv, ready = 0, True, None
    for conv, group in groupby(rows, key=itemgetter(0)):
        if ready:  # the conversation before has ended here
            yield ready[1].whole(ready[0], with_text)
            ready = None
        segment, cut, mark = Segment(), first_conv, None
        for _, turn, role, key, kind, copies, text in group:
            if kind == 0:
                mark = (turn, role, key)
                continue
            for _ in range(copies):
                if segment.n == most:
                    yield segment.part(conv, task, seq)
                    segment, cut, seq = Segment(), True, seq + 1
                segment.add(turn, role, text, mark == (turn, role, key))
                mark = None
        if cut:
            yield segment.part(conv, task, seq)
            seq += 1
        else:
            ready = (conv, segment)
        first_conv = False
    if ready:  # it may go on in the next task
        yield ready[1].part(ready[0], task, seq)


def _path(rows: Iterator[tuple]) -> Iterator[dict]:
    """For each segment of each conversation the states it starts from and ends in. ``rows``: conv, task, seq,
    n, costs, audits; sorted."""
    for _, group in groupby(rows, key=itemgetter(0)):
        now = {0: (0, 0)}  # state -> (cost, rank of the letters so far)
        places, back = [], []
        for _, task, seq, n, costs, audits in group:
            width, then = 6 * n, {}
            for at in range(16):
                q, to = divmod(at, 4)
                if q in now and costs[at] is not None:
                    cost, rank = now[q]
                    weight = (cost + costs[at] << width + 2) + (rank << width) + slot(audits[at], n)
                    if to not in then or weight < then[to][0]:
                        then[to] = (weight, q)
            low = {to: w & ((1 << width + 2) - 1) for to, (w, _) in then.items()}
            order = sorted(set(low.values()))
            now = {to: (w >> width + 2, order.index(low[to])) for to, (w, _) in then.items()}
            places.append((task, seq))
            back.append(bytes(then[to][1] if to in then else 9 for to in range(4)))
        state = min(now, key=lambda q: (now[q][0] + INSERT * len(ENDS[q]) << 8) + (now[q][1] << 6) + slot(ENDS[q]))
        for (task, seq), came in zip(reversed(places), reversed(back)):
            yield {"task": task, "seq": seq, "q": came[state], "to": state}
            state = came[state]


class _Counts:
    def __init__(self, values: dict):
        self.__dict__.update(values)


def _whole(rows: Iterator[tuple], with_text: bool) -> Iterator[dict]:
    """Results from segments with their states. ``rows``: conv, segment, q, to; sorted."""
    for conv, group in groupby(rows, key=itemgetter(0)):
        total, cost, audit, text, digest, state, some = Segment(), 0, [], [], sha256(), 0, False

        def put(lines):
            nonlocal some
            for line in lines:
                piece = ("\n" if some else "") + line
                some = True
                digest.update(piece.encode("utf-8"))
                if with_text:
                    text.append(piece)

        for _, part, q, to in group:
            total.follow(_Counts(part))
            at = 4 * q + to
            cost += part["costs"][at]
            audit.append(part["audits"][at])
            lines, state = replay(list(zip(part["roles"], part["texts"])), audit[-1], q)
            put(lines)
        put(replay([], ENDS[state], state)[0])
        audit.append(ENDS[state])
        yield total.result(conv, cost + INSERT * len(ENDS[state]), "".join(audit), digest.hexdigest(), "".join(text) if with_text else None)


def damaged(conversations: DataFrame) -> DataFrame:
    """The contract's damage by crc32(``conv_id:turn``) % 20 (nulls: one space): 0 drops a row (zero copies), 1
    empties its text, 2 removes ``.!?``, 3 repeats it, 4 sets the role user. Columns: conv_id, turn, role, text,
    copies."""
    c = pick(conversations, "conv_id", "turn", "role", "text")

    def filled(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    fate = F.crc32(F.concat(filled("conv_id"), F.lit(":"), filled("turn")).cast("binary")) % 20
    return c.select("conv_id", "turn", filled("role").alias("role"), filled("text").alias("text"), fate.alias("fate")).select(
        "conv_id", "turn",
        F.when(F.col("fate") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("fate") == 1, "").when(F.col("fate") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.when(F.col("fate") == 0, 0).when(F.col("fate") == 3, 2).otherwise(1).alias("copies"),
    )


def repair(
    rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
    copies_col: str | None = None, with_text: bool = True, segment: int = SEGMENT,
) -> DataFrame:
    """Per conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 and (if
    wanted) ``repaired``, the rows as ``role:text``, joined by line feeds."""
    spark = rows.sparkSession
    names = [conv_col, turn_col, role_col, text_col, *([copies_col] if copies_col else [])]
    plain = pick(rows, *names).toDF(*["conv", "turn", "role", "text", "copies"][:len(names)])
    conv_type = plain.schema["conv"].dataType
    copies = F.coalesce(F.col("copies"), F.lit(0)).cast("long") if copies_col else F.lit(1).cast("long")
    gone = copies == 0
    plain = plain.select(
        F.col("conv").cast("string").alias("conv"), F.col("turn").cast("long").alias("turn"),
        *[F.when(gone, "").otherwise(F.coalesce(F.col(c).cast("string"), F.lit(" "))).alias(c) for c in ("role", "text")],
        copies.alias("copies"),
    )
    key = F.substring(F.unhex(F.sha2(F.col("text"), 256)), 1, 16)
    lines = plain.groupBy("conv", "turn", "role", "text").agg(F.sum("copies").alias("copies"))
    lines = lines.select("conv", "turn", "role", key.alias("key"), F.lit(1).alias("kind"), "copies", "text")
    firsts = (
        plain.filter(F.col("copies") > 0).groupBy("conv", "role", key.alias("key"))
        .agg(F.min(F.struct(F.col("turn").isNotNull().alias("known"), "turn")).alias("at"))
        .select("conv", F.col("at.turn").alias("turn"), "role", "key", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("copies"), F.lit(None).cast("string").alias("text"))
    )
    order = ["conv", "turn", "role", "key"]
    found_schema, path_schema = _arrow(f"{RESULT}, segment struct<{PART.replace(' ', ':').replace(',:', ',')}>", spark), _arrow("task long, seq long, q int, to int", spark)
    result_schema = _arrow(RESULT, spark)

    def cut(batches):
        from pyspark import TaskContext

        return _batches(_segments(_rows(batches), TaskContext.get().partitionId(), segment, with_text), found_schema)

    def chain(batches):
        return _batches(_path(_rows(batches)), path_schema)

    def join(batches):
        return _batches(_whole(_rows(batches), with_text), result_schema)

    path = scratch_path(spark, "conversation-segments")
    (
        lines.unionByName(firsts).repartitionByRange(*order).sortWithinPartitions(*order, "kind")
        .mapInArrow(cut, f"{RESULT}, segment struct<{PART.replace(' ', ':').replace(',:', ',')}>").write.parquet(path)
    )
    found = spark.read.parquet(path)
    parts = found.filter(F.col("segment").isNotNull()).select("conv_id", "segment", "segment.task", "segment.seq")
    steps = (
        parts.select("conv_id", "task", "seq", "segment.n", "segment.costs", "segment.audits")
        .repartition("conv_id").sortWithinPartitions("conv_id", "task", "seq").mapInArrow(chain, "task long, seq long, q int, to int")
    )
    joined = (
        parts.join(steps, ["task", "seq"]).repartition("conv_id").sortWithinPartitions("conv_id", "task", "seq")
        .select("conv_id", "segment", "q", "to").mapInArrow(join, RESULT)
    )
    whole = found.filter(F.col("segment").isNull()).drop("segment").unionByName(joined)
    whole = whole.withColumn("conv_id", F.col("conv_id").cast(conv_type))
    return whole if with_text else whole.drop("repaired")

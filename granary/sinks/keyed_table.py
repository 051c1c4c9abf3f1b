"""A table with one row per key, merged into in place: Spark buckets under versioned slots.

A key's hash gives its slot (a partition column) and, by another hash, its bucket. A merge reads and joins only
the slots that the batch touches; the base side is bucketed by the key and joins without an exchange. The
merged slots are appended under a version of their own, and one small file then names the live version of each
slot. That file is the commit: readers follow the newest one, so a merge that dies halfway leaves files that
nobody lists, and earlier snapshots stay readable until :meth:`KeyedTable.vacuum`. Writers take turns: of two
that start from one snapshot, the second fails.

A batch is staged in pieces by the key's hash, and a merge takes a few pieces at a time, so that the shuffles of
one round only are on the disk; the pieces go when they are merged.

Small batches may be added as deltas first, each a folder named by the same file, and folded into the slots
together later: a batch then costs its own rows, and a reader opens the slots and the few deltas since.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from hashlib import md5

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from granary.session import release, scratch_path

SLOTS, BUCKETS = 32, 8
PIECES = 32  # a batch is staged in at least so many pieces
ROUND_BYTES = 64 << 20  # staged bytes that a round of a merge takes, or else one piece
PACKED = {"compression": "zstd", "parquet.compression.codec.zstd.level": "9"}  # hashes are hexadecimal text: half the bytes
_PIECE = "_piece"
_FOLDER, _DELTAS = "_snapshots", "_deltas"  # Spark's file listing passes over names with an underscore


@dataclass
class Snapshot:
    number: int = 0
    slots: dict[int, str] = field(default_factory=dict)  # slot -> live version
    mark: int | None = None  # the last batch that the slots hold
    deltas: dict[int, str] = field(default_factory=dict)  # later batch -> its folder


def _hadoop(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, at, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, none if it isn't there."""
    _, at, fs = _hadoop(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(at)] if fs.exists(at) else []


def remove(spark: SparkSession, path: str) -> None:
    _, at, fs = _hadoop(spark, path)
    fs.delete(at, True)


@dataclass
class Stage:
    """A batch's rows in ``path``, a folder for each piece that has some; ``keep``: a merge leaves them there."""

    spark: SparkSession
    path: str
    schema: T.StructType
    keep: bool = False

    def sizes(self) -> dict[int, int]:
        """Piece -> bytes, of the pieces of a table."""
        names = [n for n in folders(self.spark, self.path) if re.fullmatch(rf"{_PIECE}=\d+", n)]
        _, _, fs = _hadoop(self.spark, self.path)
        at = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        return {int(n.partition("=")[2]): fs.getContentSummary(at(f"{self.path}/{n}")).getLength() for n in names}

    def read(self, pieces: list[int] | None = None) -> DataFrame:
        """Rows of these pieces, of all that ``sizes`` lists if not given."""
        there = {int(n.partition("=")[2]) for n in folders(self.spark, self.path) if n.startswith(f"{_PIECE}=")}
        wanted = sorted(p for p in there if (p >= 0 if pieces is None else p in pieces))
        if not wanted:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[f"{self.path}/{_PIECE}={p}" for p in wanted])

    def drop(self, pieces: list[int]) -> None:
        for p in pieces:
            remove(self.spark, f"{self.path}/{_PIECE}={p}")


def stage(rows: DataFrame, piece: F.Column, path: str) -> Stage:
    """Add rows to the stage in ``path``; ``piece`` below 0 is for rows that no merge takes."""
    rows.withColumn(_PIECE, piece).write.mode("append").options(**PACKED).partitionBy(_PIECE).parquet(path)
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in rows.schema.fields])
    return Stage(rows.sparkSession, path, schema)


class KeyedTable:
    """``schema`` holds the key and the payload; ``slots`` and ``buckets`` hold for the table's life."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, key: str, slots: int = SLOTS, buckets: int = BUCKETS):
        self.spark, self.path, self.key, self.slots, self.buckets = spark, path.rstrip("/"), key, slots, buckets
        self.columns = schema.names
        self.pieces = slots * -(-PIECES // slots)  # each lies in one slot
        self.name = "keyed_" + md5(self.path.encode()).hexdigest()[:20]
        if not spark.catalog.tableExists(self.name):
            packed = ", ".join(f"'{k}' '{v}'" for k, v in PACKED.items())
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
            spark.sql(
                f"CREATE TABLE `{self.name}` ({columns}, `_version` STRING, `_slot` INT) USING parquet "
                f"PARTITIONED BY (`_version`, `_slot`) CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {buckets} BUCKETS "
                f"OPTIONS ({packed}) LOCATION '{self.path}'")
            if any(n.startswith("_version=") for n in folders(spark, self.path)):
                spark.catalog.recoverPartitions(self.name)

    # snapshots

    def snapshot(self, number: int | None = None) -> Snapshot:
        """The newest committed snapshot, or the one of this number."""
        at = f"{self.path}/{_FOLDER}"
        known = sorted(int(n[:-5]) for n in folders(self.spark, at) if n.endswith(".json") and not n.startswith("."))
        if number is not None:
            known = [n for n in known if n == number]
        if not known:
            return Snapshot()
        [row] = self.spark.read.text(f"{at}/{known[-1]:012d}.json", wholetext=True).collect()
        told = json.loads(row.value)
        if (told["slots_in_all"], told["buckets"]) != (self.slots, self.buckets):
            raise ValueError(f"{self.path} has {told['slots_in_all']} slots and {told['buckets']} buckets")
        slots, deltas = ({int(k): v for k, v in told[name].items()} for name in ("slots", "deltas"))
        return Snapshot(known[-1], slots, told["mark"], deltas)

    def _commit(self, new: Snapshot) -> None:
        final = f"{self.path}/{_FOLDER}/{new.number:012d}.json"
        jvm, to, fs = _hadoop(self.spark, final)
        draft = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{_FOLDER}/.{uuid.uuid4().hex}")
        text = json.dumps({"slots": new.slots, "mark": new.mark, "deltas": new.deltas, "slots_in_all": self.slots, "buckets": self.buckets})
        out = fs.create(draft, False)
        out.write(bytearray(text.encode()))
        out.close()
        if fs.exists(to) or not fs.rename(draft, to):
            fs.delete(draft, False)
            raise RuntimeError(f"snapshot {new.number} was committed by another writer")

    # rows

    def read(self, slots: list[int] | None = None, at: Snapshot | None = None) -> DataFrame:
        """Live rows, of these slots only if given."""
        live = (at or self.snapshot()).slots
        by_version: dict[str, list[int]] = {}
        for slot, version in live.items():
            if slots is None or slot in slots:
                by_version.setdefault(version, []).append(slot)
        wanted = F.lit(False)
        for version, of in sorted(by_version.items()):
            wanted = wanted | ((F.col("_version") == version) & F.col("_slot").isin(of))
        return self.spark.table(self.name).where(wanted).select(*self.columns)

    def slot_of(self) -> F.Column:
        return self._dealt(self.slots)

    def piece_of(self) -> F.Column:
        return self._dealt(self.pieces)

    def _dealt(self, among: int) -> F.Column:
        return F.pmod(F.xxhash64(F.col(self.key)), F.lit(among)).cast("int")

    def merge(
        self, batch: DataFrame | Stage, combine: Callable[[DataFrame | None, DataFrame], DataFrame], mark: int | None = None,
        reduce: Callable[[DataFrame], DataFrame] | None = None,
    ) -> Snapshot:
        """Fold a batch in. ``combine(base, batch)`` gives the new rows of the touched slots, one per key, where
        ``base`` holds their rows (None: they have none). The batch is staged first, so that it is worked out once
        and decides the touched slots (at most ``slots``). Then these are merged by rounds of a few pieces:
        ``reduce(batch)``, if given, leaves few rows per key, and the rows are dealt to as many tasks as there are
        buckets, whatever the session's number of shuffle partitions, so that the join finds both sides in place.
        After a round its pieces, its draft and its shuffles leave the disk; there is one commit, after the last."""
        before = self.snapshot()
        given = isinstance(batch, Stage)
        staged = batch if given else stage(batch, self.piece_of(), scratch_path(self.spark, "merge"))
        release(self.spark)
        slots, version = dict(before.slots), f"{before.number + 1:08d}-{uuid.uuid4().hex[:12]}"
        for pieces in self._rounds(staged.sizes()):
            touched = {p % self.slots for p in pieces}
            held = sorted(s for s in touched if s in before.slots)
            base = self.read(held, before) if held else None
            if base is not None and len(pieces) < len(touched) * self.pieces // self.slots:
                base = base.where(self.piece_of().isin(pieces))
            rows, draft = staged.read(pieces), None
            if reduce:
                draft, reduced = scratch_path(self.spark, "merge"), reduce(rows)
                reduced.write.options(**PACKED).parquet(draft)
                rows = self.spark.read.schema(reduced.schema).parquet(draft)
                release(self.spark)
            out = combine(base, rows.repartition(self.buckets, self.key))
            out.select(*self.columns, F.lit(version).alias("_version"), self.slot_of().alias("_slot")).write.insertInto(self.name)
            slots.update(dict.fromkeys(touched, version))
            if not staged.keep:
                staged.drop(pieces)
            if draft:
                remove(self.spark, draft)
            release(self.spark)
        new = Snapshot(before.number + 1, slots, before.mark if mark is None else mark, {b: f for b, f in before.deltas.items() if mark is None or b > mark})
        self._commit(new)
        if not given:
            remove(self.spark, staged.path)
        return new

    def _rounds(self, sizes: dict[int, int]) -> list[list[int]]:
        """All pieces of the slots that have some of these pieces, those of a slot side by side, in rounds."""
        rounds: list[list[int]] = []
        filled = 0
        for slot in sorted({p % self.slots for p in sizes}):
            for piece in range(slot, self.pieces, self.slots):
                size = sizes.get(piece, 0)
                if not rounds or filled and filled + size > ROUND_BYTES:
                    rounds.append([])
                    filled = 0
                rounds[-1].append(piece)
                filled += size
        return rounds

    # deltas

    def add_delta(self, rows: DataFrame, batch: int) -> Snapshot:
        """Rows of a batch beside the slots. A batch that comes again replaces its delta; one that the slots hold
        already changes nothing."""
        before = self.snapshot()
        if before.mark is not None and batch <= before.mark:
            return before
        name = f"{batch:012d}-{uuid.uuid4().hex[:12]}"
        rows.withColumn("_batch", F.lit(batch).cast("long")).write.parquet(f"{self.path}/{_DELTAS}/{name}")
        new = Snapshot(before.number + 1, before.slots, before.mark, {**before.deltas, batch: name})
        self._commit(new)
        return new

    def deltas(self, at: Snapshot | None = None) -> DataFrame | None:
        """Rows of the live deltas with ``_batch``, None if there is none."""
        names = sorted((at or self.snapshot()).deltas.values())
        return self.spark.read.parquet(*[f"{self.path}/{_DELTAS}/{n}" for n in names]) if names else None

    def fold(self, combine: Callable[[DataFrame | None, DataFrame], DataFrame]) -> Snapshot:
        """Merge all deltas into the slots."""
        now = self.snapshot()
        held = self.deltas(now)
        return now if held is None else self.merge(held, combine, max(now.deltas))

    def vacuum(self, keep: int = 1) -> int:
        """Drop all but the newest ``keep`` snapshots, and the slots and deltas that none of these lists; how
        many went. Don't run it beside a writer."""
        known = sorted(int(n[:-5]) for n in folders(self.spark, f"{self.path}/{_FOLDER}") if n.endswith(".json") and not n.startswith("."))
        kept = [self.snapshot(n) for n in known[-keep:]]
        live = {(v, s) for snap in kept for s, v in snap.slots.items()}
        names = {n for snap in kept for n in snap.deltas.values()}
        gone = 0
        for folder in folders(self.spark, self.path):
            version = folder.removeprefix("_version=")
            for part in folders(self.spark, f"{self.path}/{folder}") if version != folder else []:
                slot = part.removeprefix("_slot=")
                if slot != part and (version, int(slot)) not in live:
                    self.spark.sql(f"ALTER TABLE `{self.name}` DROP IF EXISTS PARTITION (`_version`='{version}', `_slot`={slot})")
                    self._delete(f"{folder}/{part}")
                    gone += 1
        for name in folders(self.spark, f"{self.path}/{_DELTAS}"):
            if name not in names:
                self._delete(f"{_DELTAS}/{name}")
                gone += 1
        for n in known[:-keep]:
            self._delete(f"{_FOLDER}/{n:012d}.json")
        return gone

    def _delete(self, below: str) -> None:
        remove(self.spark, f"{self.path}/{below}")

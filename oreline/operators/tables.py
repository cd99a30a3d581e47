"""Parquet tables with atomic replacement and a keyed upsert.

Plain Parquet has no MERGE, and overwriting a directory while reading it fails,
so a table here is a set of immutable Parquet directories plus a small file that
says which of them are live:

    <path>/data/<write id>/[__period=<p>/]__bucket=<b>/part-*.parquet
    <path>/live/<version>.json

Every change writes data nobody reads yet, checks it, and only then publishes a
new list under the next version; readers see the old or the new table, and a job
that dies in between leaves the old one. Two writers cannot publish the same
version: the later one fails and may start over. That holds on stores that rename
in one step, such as HDFS; on others one writer per table is up to the caller.

Rows of a keyed table are spread over ``buckets`` by their key. An upsert rewrites
only the directories that hold rows it replaces; a bucket that merely gains rows
gets one more directory. A write that finds ``MOST_DIRS`` directories in a bucket
it adds to folds them into one, so the list is bounded by buckets, not by writes.

A keyed table may also be laid out by a period (day, month or year of a date
column): a slot is then a bucket of a period. Keys are hashes, so changes of a few
recent rows meet every bucket, but only the directories of their own periods hold
rows they replace. A row may move to another period when it is replaced; for tables
whose rows never do, ``fixed_period`` lets an upsert look at the periods of its delta
alone.

A big write may be made in parts, each of a share of the rows, one after the other: then
the shuffle files of one part are gone before the next part makes its own.

A version also keeps the greatest value of each timestamp column where that is
known without a scan, and which directories hold a watched value (an unknown key,
say), noted when they are written.
"""

from __future__ import annotations

import json
import re
import threading
import uuid
from collections.abc import Collection, Iterable, Iterator, Mapping
from contextlib import contextmanager
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oreline.operators import files
from oreline.operators.dedup import latest_per_key
from oreline.operators.filters import footer_max
from oreline.operators.quality import ContractViolation, contract_measures, contract_problems
from oreline.schemas import Contract

BUCKET = "__bucket"
PERIOD = "__period"
DIR = "__dir"
# Names of the periods of a date, and of the period of rows without one.
GRAINS = {"day": "yyyy-MM-dd", "month": "yyyy-MM", "year": "yyyy"}
NO_PERIOD = "none"
MODES = ("overwrite", "append", "error")
# A bucket with this many directories is folded by the next write that adds to it.
MOST_DIRS = 16
# Up to this many rows a delta's keys are small enough for a broadcast
# join by Spark's own threshold, so the rows kept stay in the tasks that read them.
SMALL_DELTA = 500_000
DIR_OF_FILE = rf"/data/([0-9a-f]+/(?:{PERIOD}=[^/]+/)?{BUCKET}=[0-9]+)/[^/]+$"
# A write that reads files of more bytes may be made in parts of about that
# size, at most so many, as each part scans all files.
PART_BYTES = 1 << 30
MOST_PARTS = 4
# Spark's size of a relation that it knows nothing about starts here.
UNKNOWN_BYTES = 1 << 60
CODEC = "zstd"
# Spark's setting that removes a job's shuffle files when the job ends (4.1 on).
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# Text of a timestamp whose order is that of the times (years 1 to 9999).
PLAIN_TIME = r"[0-9]{4}-"


class DuplicateKeys(ValueError):
    """One merge batch holds several rows for a key."""


class SchemaDrift(ValueError):
    """The rows to merge do not have the target's columns."""


class TableExists(ValueError):
    """The target is already there."""


class ConcurrentWrite(RuntimeError):
    """Another writer published first; nothing of this write is visible."""


class TableMissing(ValueError):
    """The target was never published."""


# A bucket, or "<period>/<bucket>" of a table laid out by period.
Slot = int | str


@dataclass(frozen=True)
class Layout:
    """How the rows of a table are dealt into directories, and what is noted of these."""

    key: str | None = None
    buckets: int = 1
    period: str | None = None
    grain: str = "month"
    # Columns whose value in a directory is worth noting.
    watched: tuple[tuple[str, int], ...] = ()

    def slots(self, schema: T.StructType) -> dict[str, Column]:
        """Partition columns of rows, the period first."""
        if not self.key:
            return {}
        # Rows without a key are spread by their content, not piled on one bucket.
        content = F.xxhash64(*[F.col(f"`{name}`") for name in schema.names])
        spread = F.when(F.col(self.key).isNull(), content).otherwise(F.xxhash64(F.col(self.key)))
        out = {BUCKET: F.pmod(spread, F.lit(self.buckets)).cast("int")}
        if self.period:
            name = F.date_format(F.col(self.period), GRAINS[self.grain])
            out = {PERIOD: F.coalesce(name, F.lit(NO_PERIOD)), **out}
        return out

    def bucket_of_key(self) -> Column:
        """Bucket of rows that have a key; reads no other column."""
        return F.pmod(F.xxhash64(F.col(self.key)), F.lit(self.buckets)).cast("int")


@dataclass(frozen=True)
class Staged:
    """Written, not yet published rows."""

    write_id: str
    rows: int
    schema: T.StructType
    by_slot: dict[Slot, str]
    # Greatest value per timestamp column as text; None without one, no entry if unknown.
    highest: dict[str, str | None] = field(default_factory=dict)
    # Directories that hold the watched value of a column.
    marked: dict[str, list[str]] = field(default_factory=dict)


@dataclass(frozen=True)
class Live:
    """What readers see."""

    version: int
    schema: T.StructType
    layout: Layout
    batch: int | None
    dirs: dict[Slot, list[str]] = field(default_factory=dict)
    highest: dict[str, str | None] = field(default_factory=dict)
    marked: dict[str, list[str]] = field(default_factory=dict)

    @property
    def key(self) -> str | None:
        return self.layout.key

    def listed(self) -> set[str]:
        return {d for dirs in self.dirs.values() for d in dirs}


class VersionedTable:
    """A Parquet table addressed by path, optionally keyed, bucketed and laid out by period.

    ``watched`` maps columns to a value: the table knows which of its directories hold it.
    The layout takes effect when the table is first written or overwritten.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        key: str | None = None,
        buckets: int = 1,
        period: str | None = None,
        grain: str = "month",
        fixed_period: bool = False,
        watched: Mapping[str, int] | None = None,
    ):
        if grain not in GRAINS:
            raise ValueError(f"grain must be one of {sorted(GRAINS)}, not {grain!r}")
        if period and not key:
            raise ValueError("a layout by period needs a key")
        self.spark = spark
        self.path = path.rstrip("/")
        self.fixed_period = fixed_period
        watched = tuple(sorted((watched or {}).items()))
        self.layout = Layout(key, buckets if key else 1, period, grain, watched)

    # --- reading ---------------------------------------------------------------

    def live(self) -> Live | None:
        """The published state, or None where nothing was published."""
        names = files.child_names(self.spark, f"{self.path}/live")
        if not names:
            return None
        state = json.loads(files.read_text(self.spark, f"{self.path}/live/{names[-1]}"))
        return Live(
            version=int(names[-1].removesuffix(".json")),
            schema=T.StructType.fromJson(state["schema"]),
            layout=Layout(
                state["key"],
                state["buckets"],
                state.get("period"),
                state.get("grain", "month"),
                tuple((c, v) for c, v in state.get("watched", [])),
            ),
            batch=state["batch"],
            dirs={_slot(s): dirs for s, dirs in state["dirs"].items()},
            highest=state.get("highest", {}),
            marked=state.get("marked", {}),
        )

    def exists(self) -> bool:
        return self.live() is not None

    def read(self) -> DataFrame:
        live = self._require()
        return self._read_dirs(live.schema, live.listed())

    def greatest(self, column: str) -> str | None:
        """The greatest timestamp of ``column`` as text, None without one; reads no row.

        It comes with the version where that knows it, else from the files' footers.
        """
        live = self._require()
        if column not in live.highest and live.listed():
            paths = [f"{self.path}/data/{d}" for d in sorted(live.listed())]
            found = footer_max(self.spark, paths, live.schema, column)
            return found.select(F.col(f"max_{column}").cast("string")).first()[0]
        return live.highest.get(column)

    def read_marked(self, *columns: str) -> DataFrame:
        """Rows of the directories that hold the watched value of any of ``columns``."""
        live = self._require()
        unknown = set(columns) - {c for c, _ in live.layout.watched}
        if unknown:
            raise ValueError(f"{self.path} does not watch {sorted(unknown)}")
        return self._read_dirs(live.schema, {d for c in columns for d in live.marked.get(c, [])})

    def _require(self) -> Live:
        live = self.live()
        if live is None:
            raise TableMissing(f"no table at {self.path}")
        return live

    def _read_dirs(self, schema: T.StructType, dirs: Iterable[str]) -> DataFrame:
        paths = [f"{self.path}/data/{d}" for d in sorted(dirs)]
        if not paths:
            return self.spark.createDataFrame([], schema)
        df = self.spark.read.schema(schema).parquet(*paths)
        return df.select(*[F.col(f"`{f.name}`").alias(f.name, metadata=f.metadata) for f in schema])

    # --- staging and publishing --------------------------------------------------

    def stage(
        self,
        df: DataFrame,
        contract: Contract | None = None,
        layout: Layout | None = None,
        moved: bool = True,
        parts_by: str | None = None,
    ) -> Staged:
        """Write ``df`` where no reader looks; measure it in the same pass.

        ``moved=False`` leaves rows in the tasks that hold them, for rows that
        lie together by bucket already. With ``parts_by`` big input is written in parts
        by that column. Nothing is left of a write that fails or breaks its contract.
        """
        layout = layout or self.layout
        if contract is not None:
            problems = contract_problems(df.schema, contract)
            if problems:
                raise ContractViolation(contract.table, problems)
            df = df.select(*contract.names)
        schema = df.schema
        write_id = uuid.uuid4().hex
        out = f"{self.path}/data/{write_id}"

        slots = layout.slots(schema)
        measures = [F.count(F.lit(1)).alias("__rows")]
        if contract is not None:
            measures += contract_measures(contract)
        times = [f.name for f in schema if f.dataType == T.TimestampNTZType()]
        measures += [F.max(F.col(f"`{c}`")).cast("string").alias(f"__max {c}") for c in times]
        # At most one value for each slot.
        slot = F.concat_ws("/", *slots) if slots else F.lit("0")
        watched = [(c, v) for c, v in layout.watched if c in schema.names]
        measures += [F.collect_set(F.when(F.col(c) == v, slot)).alias(f"__has {c}") for c, v in watched]
        try:
            with shuffles_freed(self.spark):
                found = [
                    self._write_part(part, out, slots, moved, measures)
                    for part in in_parts(df, parts_by)
                ]
            rows = sum(metrics.pop("__rows") for metrics in found)
            greatest = {c: [metrics.pop(f"__max {c}") for metrics in found] for c in times}
            known = [c for c in times if all(t is None or re.match(PLAIN_TIME, t) for t in greatest[c])]
            highest = {c: max((t for t in greatest[c] if t is not None), default=None) for c in known}
            holders = {c: {n for metrics in found for n in metrics.pop(f"__has {c}")} for c, _ in watched}
            broken = {name: sum(metrics[name] for metrics in found) for name in found[0]}
            if any(broken.values()):
                raise ContractViolation(
                    contract.table, [f"{name}: {n} row(s)" for name, n in sorted(broken.items()) if n]
                )
        except BaseException:
            files.delete(self.spark, out)
            raise
        by_slot = self._slot_dirs(write_id, layout)
        marked = {c: sorted(by_slot[_slot(name)] for name in names) for c, names in holders.items()}
        return Staged(write_id, rows, schema, by_slot, highest, marked)

    def _write_part(
        self, part: DataFrame, out: str, slots: dict[str, Column], moved: bool, measures: list[Column]
    ) -> dict:
        """Add rows to the directory of a write; what was measured of them."""
        if slots:
            # Rebalancing collects a slot's rows into few files, and lets
            # adaptive execution split a slot that is too big for one task.
            part = part.withColumns(slots)
            part = part.hint("rebalance", *map(F.col, slots)) if moved else part
        # Measured last, in the writing stage: a retried shuffle cannot count twice.
        seen = Observation()
        writer = part.observe(seen, *measures).write.mode("append").option("compression", CODEC)
        (writer.partitionBy(*slots) if slots else writer).parquet(out)
        return dict(seen.get)

    def _slot_dirs(self, write_id: str, layout: Layout) -> dict[Slot, str]:
        """Directories of one write by slot."""
        if not layout.key:
            return {0: write_id}
        root, parents = f"{self.path}/data", [write_id]
        for name in [PERIOD] * bool(layout.period) + [BUCKET]:
            parents = [
                f"{parent}/{child}"
                for parent in parents
                for child in files.child_names(self.spark, f"{root}/{parent}")
                if child.startswith(f"{name}=")
            ]
        values = [[part.partition("=")[2] for part in d.split("/")[1:]] for d in parents]
        return {_slot("/".join(v)): d for v, d in zip(values, parents)}

    def check_mode(self, mode: str) -> None:
        if mode not in MODES:
            raise ValueError(f"mode must be one of {MODES}, not {mode!r}")
        if mode == "error" and self.exists():
            raise TableExists(f"{self.path} already holds a table")

    def publish(self, staged: Staged, mode: str = "overwrite") -> None:
        """Make staged rows the table (overwrite) or part of it (append)."""
        self.check_mode(mode)
        live = self.live()
        version = live.version + 1 if live else 1
        if mode == "append" and live is not None:
            if live.schema.names != staged.schema.names:
                raise SchemaDrift(
                    f"{self.path}: appended columns {staged.schema.names} "
                    f"are not the table's {live.schema.names}"
                )
            full = [d for s in staged.by_slot for d in _full(live.dirs.get(s, []))]
            kept = self._rewritten(live, full) if full else live
            both = live.highest.keys() & staged.highest.keys()
            highest = {c: _later(live.highest[c], staged.highest[c]) for c in both}
            self._commit(replace(_with_more(kept, staged), version=version, highest=highest))
            return
        empty = Live(version, staged.schema, self.layout, None, highest=staged.highest)
        self._commit(_with_more(empty, staged))

    def _commit(self, state: Live) -> None:
        text = json.dumps(
            {
                "schema": state.schema.jsonValue(),
                "key": state.layout.key,
                "buckets": state.layout.buckets,
                "period": state.layout.period,
                "grain": state.layout.grain,
                "watched": state.layout.watched,
                "batch": state.batch,
                "dirs": {s: dirs for s, dirs in sorted(state.dirs.items()) if dirs},
                "highest": state.highest,
                "marked": {c: sorted(dirs) for c, dirs in state.marked.items() if dirs},
            }
        )
        name = f"{state.version:012d}.json"
        if not files.create_text(self.spark, f"{self.path}/live/{name}", text):
            raise ConcurrentWrite(f"{self.path}: version {state.version} was published meanwhile")

    # --- table operations ----------------------------------------------------------

    def write(
        self,
        df: DataFrame,
        mode: str = "overwrite",
        contract: Contract | None = None,
        parts_by: str | None = None,
    ) -> int:
        """Write rows; ``overwrite`` may also change the column set. Returns the row count.

        ``parts_by`` names a column by which big input may be made and written in parts,
        best one that ``df`` joins its big tables by.
        """
        self.check_mode(mode)
        live = self.live() if mode == "append" else None
        if live is not None:
            df = self._align(df, live.schema, "fail")
            staged = self.stage(df, contract, live.layout, parts_by=parts_by)
        else:
            staged = self.stage(df, contract, parts_by=parts_by)
        self.publish(staged, mode)
        return staged.rows

    def ensure(self, schema: T.StructType) -> None:
        """Create the table empty where it is missing."""
        if not self.exists():
            times = {f.name: None for f in schema if f.dataType == T.TimestampNTZType()}
            self._commit(Live(1, schema, self.layout, None, highest=times))

    @contextmanager
    def work(self) -> Iterator[str]:
        """A folder beside the data for what a change writes on its way; removed after it."""
        path = f"{self.path}/work/{uuid.uuid4().hex}"
        try:
            yield path
        finally:
            files.delete(self.spark, path)

    def upsert(
        self,
        source: DataFrame,
        on_duplicate: str = "error",
        order: list[str] | None = None,
        on_schema_change: str = "ignore",
        batch: int | None = None,
        keeps_times: bool = False,
        parts_by: str | None = None,
    ) -> int:
        """Replace rows whose key is in ``source``, insert the others; never delete.

        A NULL key matches nothing and is inserted each time. Two source rows for
        one key raise ``DuplicateKeys``; ``on_duplicate="latest"`` keeps the last
        one by ``order``. Source columns the table lacks are ignored unless
        ``on_schema_change="fail"``. A ``batch`` number that was already merged is
        skipped, which makes replays of a stream's batch harmless. ``keeps_times``
        promises that replaced rows keep their timestamps, so the greatest ones stay
        known. ``parts_by`` is as for ``write``.
        """
        live = self._require()
        if live.key is None:
            raise ValueError(f"{self.path} has no key to merge on")
        if batch is not None and live.batch is not None and batch <= live.batch:
            return 0
        key = live.key
        source = self._align(source, live.schema, on_schema_change)
        if on_duplicate == "latest":
            if not order:
                raise ValueError('on_duplicate="latest" needs the columns to order by')
            # Stored first: the ranking reads its input twice, the caller's batch runs once.
            with self.work() as folder:
                stored = written(source, f"{folder}/batch")
                latest = latest_per_key(stored, [key], order, keep_null_keys=True)
                with shuffles_freed(self.spark):
                    return self._merge(live, latest, False, batch, keeps_times, parts_by)
        if on_duplicate != "error":
            raise ValueError(f"unknown on_duplicate {on_duplicate!r}")
        with shuffles_freed(self.spark):
            return self._merge(live, source, True, batch, keeps_times, parts_by)

    def _merge(
        self,
        live: Live,
        source: DataFrame,
        check: bool,
        batch: int | None,
        keeps_times: bool,
        parts_by: str | None,
    ) -> int:
        key = live.key
        # The delta is written once and becomes part of the table as it is. From
        # here on it is a table of known size, so joins with it are broadcast only
        # if it is small.
        delta = self.stage(source, layout=live.layout, parts_by=parts_by)
        if not delta.rows:
            return 0
        keys = (
            self._read_dirs(live.schema, delta.by_slot.values())
            .select(F.col(key))
            .where(F.col(key).isNotNull())
        )
        if check:
            doubled = keys.groupBy(key).count().where("count > 1").limit(5).collect()
            if doubled:
                raise DuplicateKeys(
                    f"{self.path}: several rows for {key} in "
                    f"{[r[key] for r in doubled]} in one merge batch"
                )

        if self.fixed_period:
            candidates = [s for s in delta.by_slot if s in live.dirs]
        else:
            # A replaced row may lie in another period, but in no other bucket.
            buckets = set(map(_bucket, delta.by_slot))
            candidates = [s for s in live.dirs if _bucket(s) in buckets]
        touched = {d for s in delta.by_slot for d in _full(live.dirs.get(s, []))}
        if candidates:
            held = [d for s in candidates for d in live.dirs[s]]
            met = self._with_dir(live.schema, key, held).where(F.col(key).isNotNull())
            for part in in_parts(met.join(keys, key, "left_semi"), key):
                # At most one row per listed directory.
                touched |= {r[DIR] for r in part.select(DIR).distinct().collect()}
        kept = live
        if touched:
            kept = self._rewritten(live, touched, keys, moved=delta.rows > SMALL_DELTA)
        # All of the delta stays, and all kept rows are at or before the old greatest
        # time: the delta's is the new one, unless it is less and the old row may be gone.
        highest = {
            c: _later(t, live.highest[c])
            for c, t in delta.highest.items()
            if c in live.highest and (keeps_times or _later(t, live.highest[c]) == t)
        }
        merged = replace(
            _with_more(kept, delta),
            version=live.version + 1,
            batch=live.batch if batch is None else batch,
            highest=highest,
        )
        self._commit(merged)
        return delta.rows

    def _with_dir(self, schema: T.StructType, key: str, dirs: Iterable[str]) -> DataFrame:
        """Keys in keyed directories, each with the directory it lies in."""
        paths = [f"{self.path}/data/{d}" for d in sorted(dirs)]
        lies_in = F.regexp_extract("_metadata.file_path", DIR_OF_FILE, 1)
        return self.spark.read.schema(schema).parquet(*paths).select(key, lies_in.alias(DIR))

    def _rewritten(
        self,
        live: Live,
        touched: Collection[str],
        gone: DataFrame | None = None,
        moved: bool = False,
    ) -> Live:
        """``live`` after the directories ``touched`` were written anew without the keys ``gone``."""
        old = self._read_dirs(live.schema, touched)
        if gone is not None:
            # The bucket follows from the key, so joining on both changes nothing
            # but spreads rows without a key over many tasks.
            old = old.withColumn(BUCKET, live.layout.slots(live.schema)[BUCKET])
            gone = gone.withColumn(BUCKET, live.layout.bucket_of_key())
            old = old.join(gone, [live.key, BUCKET], "left_anti").select(*live.schema.names)
        kept = self.stage(old, layout=live.layout, moved=moved, parts_by=live.key)
        rest = replace(
            live,
            dirs={s: [d for d in dirs if d not in touched] for s, dirs in live.dirs.items()},
            marked={c: [d for d in dirs if d not in touched] for c, dirs in live.marked.items()},
        )
        return _with_more(rest, kept)

    def _align(self, df: DataFrame, schema: T.StructType, on_schema_change: str) -> DataFrame:
        missing = [f.name for f in schema if f.name not in df.columns]
        extra = [c for c in df.columns if c not in schema.names]
        if on_schema_change not in ("ignore", "fail"):
            raise ValueError(f"unknown on_schema_change {on_schema_change!r}")
        if missing or (extra and on_schema_change == "fail"):
            raise SchemaDrift(f"{self.path}: missing {missing}, unexpected {extra}")
        return df.select(
            *[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name, metadata=f.metadata) for f in schema]
        )

    def unreferenced(self) -> list[str]:
        """Data directories that the current version does not read.

        Those of past versions and of writes that were never published. Removing
        them is left to the storage's own clean-up, after the longest reader.
        """
        current, out = self._require().listed(), []
        for write_id in files.child_names(self.spark, f"{self.path}/data"):
            out += [d for d in self._leaf_dirs(write_id) if d not in current]
        return [f"{self.path}/data/{d}" for d in out]

    def _leaf_dirs(self, parent: str) -> list[str]:
        names = files.child_names(self.spark, f"{self.path}/data/{parent}")
        inner = [f"{parent}/{n}" for n in names if n.startswith((f"{PERIOD}=", f"{BUCKET}="))]
        return [d for child in inner for d in self._leaf_dirs(child)] or [parent]


def _slot(name: str) -> Slot:
    return int(name) if name.isdigit() else name


def _bucket(slot: Slot) -> int:
    return int(str(slot).rpartition("/")[2])


def _full(dirs: list[str]) -> list[str]:
    return dirs if len(dirs) >= MOST_DIRS else []


def _later(a: str | None, b: str | None) -> str | None:
    return max((t for t in (a, b) if t is not None), default=None)


def _with_more(live: Live, more: Staged) -> Live:
    """``live`` with the directories of a write."""
    dirs = {s: list(d) for s, d in live.dirs.items()}
    for s, d in more.by_slot.items():
        dirs.setdefault(s, []).append(d)
    columns = live.marked.keys() | more.marked.keys()
    marked = {c: live.marked.get(c, []) + more.marked.get(c, []) for c in columns}
    return replace(live, dirs=dirs, marked=marked)


def work_dir(spark: SparkSession) -> str:
    """A fresh folder in storage that all executors share.

    Below ``spark.checkpoint.dir`` where the session names one, else below the
    warehouse; never in a machine's own temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    root = root or spark.sparkContext.getCheckpointDir()
    root = root or spark.conf.get("spark.sql.warehouse.dir")
    return f"{root.rstrip('/')}/oreline-{uuid.uuid4().hex}"


def written(df: DataFrame, path: str) -> DataFrame:
    """Cut the lineage: write ``df`` and read it back with its real size known."""
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def written_in_parts(df: DataFrame, path: str, by: str) -> DataFrame:
    """``written``, in parts by a column where the input is big."""
    with shuffles_freed(df.sparkSession):
        for part in in_parts(df, by):
            part.write.mode("append").option("compression", CODEC).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def in_parts(df: DataFrame, by: str | None) -> list[DataFrame]:
    """``df`` dealt by a hash of ``by`` into parts, each row to one; whole if its input is small.

    The parts are meant to be made one after the other. Where ``df`` joins or numbers its
    rows by that column, the optimizer takes the condition down to the scans, so that
    every step of a part meets its share of the rows only.
    """
    n = min(MOST_PARTS, -(-_bytes_read(df) // PART_BYTES)) if by else 1
    if n <= 1:
        return [df]
    share = F.pmod(F.xxhash64(F.col(f"`{by}`")), F.lit(n))
    return [df.where(share == k) for k in range(n)]


def _bytes_read(df: DataFrame) -> int:
    """Size of the files that ``df`` reads, as far as the optimizer knows it."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(k).stats().sizeInBytes())) for k in range(leaves.size())]
    return sum(n for n in sizes if n < UNKNOWN_BYTES)


# Sessions that free shuffle files now: how many writers want it, and the setting before.
_freeing: dict[str, tuple[int, str | None]] = {}
_lock = threading.Lock()


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Jobs that run inside remove their shuffle files when they end.

    Otherwise these stay until the driver happens to collect its garbage, beside those of
    all jobs that follow.
    """
    session = spark._jsparkSession.sessionUUID()
    with _lock:
        inside, before = _freeing.get(session, (0, spark.conf.get(FREE_SHUFFLES, None)))
        _freeing[session] = (inside + 1, before)
        spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        with _lock:
            inside, before = _freeing.pop(session)
            if inside > 1:
                _freeing[session] = (inside - 1, before)
            elif before is None:
                spark.conf.unset(FREE_SHUFFLES)
            else:
                spark.conf.set(FREE_SHUFFLES, before)

"""Tables that several writers append to at once: data files by ranges of a key's hash, and a log of numbered commits that tells which of them count.

A folder holds `data`, where each writer puts files of its own, and `log`, where commit n is one small file, created only if there is none of that
number. What no commit names is not there: a writer that dies before its commit leaves nothing that a reader sees, and a commit that
touches several tables (rows, their index, a checkpoint) is seen as a whole.

Each file holds the rows whose key hashes start with its prefix, of some bits; small batches have few bits, so that they are one file. An
append reads only the files whose prefix its own keys fall under. Small files are merged into ones of longer prefixes as they become many, so
that the number of files an append opens follows its batch, not the history. The list of files is held by the driver, as in any table log.
"""

from __future__ import annotations

import json
import math
import time
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.dedupe import first_of
from . import storage

#: Commits after which the log is summed up, and bits of the longest prefix.
SUMMED, DEEPEST = 16, 20
#: Files of fewer than FULL rows grow with the table, up to GROWN times bucket_rows, before there are more than 2^SPREAD of them: each costs every reader and writer.
SPREAD, GROWN, FULL = 8, 64, 1_000_000
HASH, BUCKET = "_hash", "_bucket"


class Conflict(RuntimeError):
    """Another writer has changed what a commit was made from."""


@dataclass(frozen=True)
class File:
    """A data file: rows of keys whose hash starts with the `depth` bits of `prefix`."""

    path: str
    prefix: int
    depth: int
    rows: int

    def covers(self, prefix: int, depth: int) -> bool:
        """Whether it can hold keys of another prefix."""
        d = min(depth, self.depth)
        return self.prefix >> (self.depth - d) == prefix >> (depth - d)


@dataclass
class Table:
    schema: T.StructType
    keys: list[str]
    files: dict[str, File] = field(default_factory=dict)
    #: Grows with each generation: all files of an earlier one are gone.
    generation: int = 0

    @property
    def rows(self) -> int:
        return sum(f.rows for f in self.files.values())


@dataclass
class Snapshot:
    version: int = 0
    tables: dict[str, Table] = field(default_factory=dict)
    #: The last batch of each writer that numbers its batches.
    batches: dict[str, int] = field(default_factory=dict)
    state: dict = field(default_factory=dict)

    def after(self, version: int, commit: dict) -> Snapshot:
        tables = dict(self.tables)
        for name, change in commit["tables"].items():
            old = tables.get(name)
            files = {} if old is None or change.get("all") else dict(old.files)
            for path in change["remove"]:
                files.pop(path, None)
            files |= {f[0]: File(*f) for f in change["add"]}
            tables[name] = Table(T.StructType.fromJson(change["schema"]), change["keys"], files, (old.generation if old else 0) + bool(change.get("all")))
        return Snapshot(version, tables, self.batches | dict([commit["batch"]] if commit.get("batch") else []), self.state | commit.get("state", {}))

    def as_json(self) -> bytes:
        of = lambda t: {"schema": t.schema.jsonValue(), "keys": t.keys, "generation": t.generation, "files": [[f.path, f.prefix, f.depth, f.rows] for f in t.files.values()]}
        return json.dumps({"version": self.version, "batches": self.batches, "state": self.state, "tables": {n: of(t) for n, t in self.tables.items()}}).encode()

    @staticmethod
    def from_json(data: bytes) -> Snapshot:
        s = json.loads(data)
        of = lambda t: Table(T.StructType.fromJson(t["schema"]), t["keys"], {f[0]: File(*f) for f in t["files"]}, t["generation"])
        return Snapshot(s["version"], {n: of(t) for n, t in s["tables"].items()}, s["batches"], s["state"])


@dataclass
class Append:
    """Rows whose keys the table does not hold, of several in the batch the first by order. Keys that are null in a part are compared as SQL does: never found in the table."""

    table: str
    rows: DataFrame
    keys: list[str]
    order: list[str]


@dataclass
class Put:
    """Rows that take the place of those with their keys; of several in the batch the last by order."""

    table: str
    rows: DataFrame
    keys: list[str]
    order: list[str]


@dataclass
class Drop:
    """Rows of these keys go; `rows` needs the key columns only."""

    table: str
    rows: DataFrame
    keys: list[str]


@dataclass
class Replace:
    """A new generation of the whole table. With `seen`, the version that it was made from, it fails if the table has changed since."""

    table: str
    rows: DataFrame
    keys: list[str]
    seen: int | None = None


Change = Append | Put | Drop | Replace


@dataclass
class Prepared:
    """Files that a change has written, those it takes out, the prefixes (of `depth` bits) that it touches, and the files that it has read."""

    change: Change
    schema: T.StructType
    base: int
    generation: int
    add: list[File]
    remove: list[str]
    touched: set[int]
    depth: int
    opened: set[str]
    staged: str


@dataclass(frozen=True)
class Done:
    """What a commit did: its version (that of an earlier try, if the batch was there already), files of the table opened, rows added, by table."""

    version: int
    opened: dict[str, int]
    rows: dict[str, int]
    tries: int
    repeated: bool = False


def _prefix(depth: int) -> Column:
    return F.lit(0).cast("long") if depth == 0 else F.shiftrightunsigned(HASH, 64 - depth)


class Ledger:
    """Tables below `path`. bucket_rows: rows of a file about; most_files: small files before they are merged; on_step is told of each step that
    a commit is about to take, for tests that stop it there."""

    def __init__(self, spark: SparkSession, path: str, bucket_rows: int = 1_000_000, most_files: int = 8, on_step: Callable[[str], None] | None = None):
        self.spark, self.path, self.bucket_rows, self.most_files, self.step = spark, path.rstrip("/"), bucket_rows, most_files, on_step or (lambda _: None)

    # The log

    def _log(self, version: int, kind: str) -> str:
        return f"{self.path}/log/{version:020d}.{kind}"

    def snapshot(self, version: int | None = None) -> Snapshot:
        """The tables as of a version, or as of the last commit: the newest sum of the log and the commits after it."""
        found = [(int(n[:20]), n[21:]) for n in storage.names(self.spark, f"{self.path}/log") if n[:20].isdigit() and (version is None or int(n[:20]) <= version)]
        sums, commits = ([v for v, kind in found if kind == k] for k in ("sum", "commit"))
        now = Snapshot.from_json(storage.read_bytes(self.spark, self._log(max(sums), "sum"))) if sums else Snapshot()
        for v in sorted(v for v in commits if v > now.version):
            now = now.after(v, self._commit(v))
        if version is not None and (now.version != version or version not in (0, *(v for v, _ in found))):
            raise ValueError(f"there is no version {version}")
        return now

    def _commit(self, version: int) -> dict:
        return json.loads(storage.read_bytes(self.spark, self._log(version, "commit")))

    def read(self, table: str, version: int | None = None) -> DataFrame | None:
        """The table as of a version, or now; None where it was never written. A DataFrame keeps to the files of its version, until vacuum()."""
        found = self.snapshot(version).tables.get(table)
        return None if found is None else self._rows(found, found.files.values())

    def _rows(self, table: Table, files: Iterable[File], hashed: bool = False) -> DataFrame:
        schema = T.StructType([*table.schema.fields, T.StructField(HASH, T.LongType())]) if hashed else table.schema
        paths = [f"{self.path}/data/{f.path}" for f in files]
        return self.spark.read.schema(schema).parquet(*paths).select(*schema.names) if paths else self.spark.createDataFrame([], schema)

    # Writing

    def _depth(self, rows: int) -> int:
        bits = lambda size: max(0, math.ceil(math.log2(max(1, rows) / size)))
        return min(DEEPEST, max(min(bits(self.bucket_rows), SPREAD), bits(max(self.bucket_rows, min(GROWN * self.bucket_rows, FULL)))))

    def _write(self, rows: DataFrame, depth: int) -> list[File]:
        """rows (with HASH) as files of this depth: a task, and a file, for each prefix."""
        folder = uuid.uuid4().hex
        target = f"{self.path}/data/{folder}"
        rows.withColumn(BUCKET, _prefix(depth)).repartition(BUCKET).write.partitionBy(BUCKET).parquet(target)
        names = [n for n in storage.data_files(self.spark, target) if n.endswith(".parquet")]
        if not names:
            return []
        # Metadata only: no column is read. A task may write several prefixes, in files of one name.
        counted = self.spark.read.parquet(target).groupBy(F.col(BUCKET).cast("long").alias("b"), F.col("_metadata.file_name").alias("f")).agg(F.count("*").alias("n"))
        of = {n: (int(n.split("/")[0].partition("=")[2]), n.rsplit("/", 1)[-1]) for n in names}
        sizes = {(r.b, r.f): r.n for r in counted.collect()}
        return [File(f"{folder}/{n}", of[n][0], depth, sizes[of[n]]) for n in names if of[n] in sizes]

    def _stage(self, rows: DataFrame, keys: list[str]) -> tuple[str, DataFrame]:
        folder = f"{uuid.uuid4().hex}-staged"
        frame = rows.withColumn(HASH, F.xxhash64(*keys))
        frame.write.parquet(f"{self.path}/data/{folder}")
        return folder, self.spark.read.schema(frame.schema).parquet(f"{self.path}/data/{folder}")

    def _first(self, change: Append) -> DataFrame:
        return first_of(change.rows, change.keys, change.order)

    def _last(self, change: Put) -> DataFrame:
        rest = F.struct(*[c for c in change.rows.columns if c not in change.keys])
        best = change.rows.groupBy(*change.keys).agg(F.max_by(rest, F.struct(*change.order)).alias("_r"))
        return best.select(*[F.col(c) if c in change.keys else F.col(f"_r.{c}").alias(c) for c in change.rows.columns])

    def _touched(self, staged: DataFrame, depth: int) -> set[int]:
        return {r[0] for r in staged.select(_prefix(depth).alias("p")).distinct().collect()}

    def _prepare(self, change: Change, now: Snapshot) -> Prepared:
        if len(set(change.keys)) < len(change.keys) or not change.keys or {HASH, BUCKET} & set(change.rows.columns):
            raise ValueError(f"{change.table} needs its keys, each once; {HASH} and {BUCKET} are made here")
        old = now.tables.get(change.table)
        if old is not None and old.keys != change.keys:
            raise ValueError(f"{change.table} is kept by {old.keys}")
        if isinstance(change, Drop):
            kinds = {f.name: f.dataType for f in old.schema.fields} if old else {}
            rows = change.rows.select(*[F.col(k).cast(kinds[k]) if k in kinds else F.col(k) for k in change.keys]).distinct()
        else:
            rows = {Append: self._first, Put: self._last, Replace: lambda c: c.rows}[type(change)](change)
            if old is not None and not isinstance(change, Replace):
                rows = rows.select(*[F.col(f.name).cast(f.dataType) for f in old.schema.fields])
        staged, batch = self._stage(rows, change.keys)
        n = batch.count()
        schema = T.StructType([T.StructField(f.name, f.dataType) for f in rows.schema.fields]) if old is None or isinstance(change, Replace) else old.schema
        base = lambda **x: Prepared(**({"change": change, "schema": schema, "base": now.version, "generation": old.generation if old else 0, "staged": staged} | x))
        if isinstance(change, Replace):
            return base(add=self._write(batch, self._depth(n)), remove=[], touched={0}, depth=0, opened=set())
        files = list(old.files.values()) if old else []
        depth = max([self._depth(n), *(f.depth for f in files)])
        touched = self._touched(batch, depth)
        # By prefix of each depth in use, not file by file and key by key.
        under = {d: {p >> (depth - d) for p in touched} for d in {f.depth for f in files}}
        open_ = [f for f in files if f.prefix in under[f.depth]]
        if isinstance(change, Append):
            fresh = batch.join(self._rows(old, open_).select(*change.keys), change.keys, "left_anti").select(*batch.columns) if open_ else batch
            return base(add=self._write(fresh, self._depth(n)), remove=[], touched=touched, depth=depth, opened={f.path for f in open_})
        if open_:
            left = self._rows(old, open_, hashed=True).join(batch.select(*change.keys), change.keys, "left_anti").select(*schema.names, HASH)
            rows = left if isinstance(change, Drop) else left.unionByName(batch)
            return base(add=self._write(rows, self._depth(n + sum(f.rows for f in open_))), remove=[f.path for f in open_], touched=touched, depth=depth, opened={f.path for f in open_})
        return base(add=[] if isinstance(change, Drop) else self._write(batch, self._depth(n)), remove=[], touched=touched, depth=depth, opened=set())

    def _again(self, p: Prepared, now: Snapshot, since: list[dict]) -> Prepared:
        """p on top of the commits of others since it was made. Those that touch other keys leave it as it is."""
        others = [c["tables"][p.change.table] for c in since if p.change.table in c["tables"]]
        if isinstance(p.change, Replace):
            if p.change.seen is not None and others:
                raise Conflict(f"{p.change.table} has changed since version {p.change.seen}")
            p.base = now.version
            return p
        # Merged files hold the same rows as those they replace, so an append, which only looks keys up, need not look again.
        gone = {path for c in others if not (c.get("tidy") and isinstance(p.change, Append)) for path in c["remove"]}
        added = [File(*f) for c in others if not c.get("tidy") for f in c["add"]]
        met = [f for f in added if any(f.covers(t, p.depth) for t in p.touched)]
        if any(c.get("all") for c in others) or gone & p.opened or (met and not isinstance(p.change, Append)):
            return self._prepare(p.change, now)
        p.base = now.version
        live = [f for f in met if f.path in now.tables[p.change.table].files]
        if len(live) < len(met):
            return self._prepare(p.change, now)
        if live and p.add:
            # What is left of it after the rows that have come meanwhile: their files alone are read.
            table = now.tables[p.change.table]
            own = self._rows(Table(p.schema, p.change.keys), p.add, hashed=True)
            fresh = own.join(self._rows(table, live).select(*p.change.keys), p.change.keys, "left_anti").select(*own.columns)
            depth = p.add[0].depth
            p.add, p.opened = self._write(fresh, depth), p.opened | {f.path for f in live}
        return p

    def commit(self, changes: Iterable[Change], batch: tuple[str, int] | None = None, state: dict | None = None, tries: int = 30) -> Done:
        """All changes in one commit: a reader sees all or none. Rows come before what is said of them because there is no state in between.

        batch is (writer, number) of a writer whose batches are numbered upwards: one that was committed before is not committed again. state is merged
        into the snapshot's. Where another writer takes the number first, what it has done is read, and only what it touches is done again.
        """
        changes = list(changes)
        if len({c.table for c in changes}) < len(changes):
            raise ValueError("a commit changes each table once")
        now = self.snapshot()
        if batch and now.batches.get(batch[0], -1) >= batch[1]:
            return Done(now.version, {}, {}, 0, True)
        for c in changes:
            if isinstance(c, Replace) and c.seen is not None and any(c.table in self._commit(v)["tables"] for v in range(c.seen + 1, now.version + 1)):
                raise Conflict(f"{c.table} has changed since version {c.seen}")
        self.step("write")
        made = [self._prepare(c, now) for c in changes]
        for attempt in range(1, tries + 1):
            entry = {"tables": {p.change.table: {"schema": p.schema.jsonValue(), "keys": p.change.keys, "add": [[f.path, f.prefix, f.depth, f.rows] for f in p.add], "remove": p.remove, "all": isinstance(p.change, Replace)} for p in made}, "state": state or {}}
            if batch:
                entry["batch"] = batch
            self.step("commit")
            if self._put(now.version + 1, entry):
                self.step("after")
                for p in made:
                    storage.delete(self.spark, f"{self.path}/data/{p.staged}")
                for p in made:
                    self._tidy(p.change.table)
                return Done(now.version + 1, {p.change.table: len(p.opened) for p in made}, {p.change.table: sum(f.rows for f in p.add) for p in made}, attempt)
            before, now = now, self.snapshot()
            if batch and now.batches.get(batch[0], -1) >= batch[1]:
                return Done(now.version, {}, {}, attempt, True)
            since = [self._commit(v) for v in range(before.version + 1, now.version + 1)]
            self.step("again")
            made = [self._again(p, now, since) for p in made]
        raise Conflict(f"no commit in {tries} tries")

    def _put(self, version: int, entry: dict) -> bool:
        if not storage.create_new(self.spark, self._log(version, "commit"), json.dumps(entry).encode()):
            return False
        if version % SUMMED == 0:
            storage.create_new(self.spark, self._log(version, "sum"), self.snapshot(version).as_json())
        return True

    # Tidying

    def _tidy(self, table: str) -> None:
        """Merges small files once there are more than most_files of them, files of much shorter prefixes than the table's size asks for, and
        those of a prefix that has many. Rows stay as they are, so it gets in nobody's way: if another writer is first, it is left for later."""
        now = self.snapshot()
        own = now.tables[table]
        depth = self._depth(own.rows)
        small = [f for f in own.files.values() if f.depth < depth and f.rows < self.bucket_rows / 4 or depth == 0 and f.rows < self.bucket_rows / 2]
        merged = {f.path: f for f in own.files.values() if f.depth <= depth - 2}
        if len(small) > self.most_files:
            merged |= {f.path: f for f in small}
        by_prefix: dict[tuple[int, int], list[File]] = {}
        for f in own.files.values():
            by_prefix.setdefault((f.depth, f.prefix), []).append(f)
        for same in by_prefix.values():
            if len(same) > self.most_files:
                merged |= {f.path: f for f in same}
        if len(merged) < 2:
            return
        add = self._write(self._rows(own, merged.values(), hashed=True), depth)
        change = {"schema": own.schema.jsonValue(), "keys": own.keys, "add": [[f.path, f.prefix, f.depth, f.rows] for f in add], "remove": list(merged), "tidy": True}
        for _ in range(5):
            self.step("tidy")
            if self._put(now.version + 1, {"tables": {table: change}}):
                return
            before, now = now, self.snapshot()
            since = [self._commit(v)["tables"].get(table) for v in range(before.version + 1, now.version + 1)]
            if any(c and (c.get("all") or set(c["remove"]) & set(merged)) for c in since):
                return

    def vacuum(self, older_ms: int = 24 * 3_600_000, now_ms: int | None = None) -> int:
        """Deletes folders of data that the last version does not name and that nobody has changed for older_ms, which must be longer than any
        write or read takes: what dead writers and earlier versions have left. Commits that the last sum of the log holds go too. Returns how many folders."""
        named = {f.path.split("/")[0] for t in self.snapshot().tables.values() for f in t.files.values()}
        limit, gone = (int(time.time() * 1000) if now_ms is None else now_ms) - older_ms, 0
        for folder in storage.names(self.spark, f"{self.path}/data"):
            at = f"{self.path}/data/{folder}"
            if folder not in named and storage.modified_ms(self.spark, at) <= limit:
                storage.delete(self.spark, at)
                gone += 1
        log = [n for n in storage.names(self.spark, f"{self.path}/log") if n[:20].isdigit()]
        summed = max((n[:20] for n in log if n.endswith(".sum")), default="")
        for name in log:
            if name[:20] < summed and storage.modified_ms(self.spark, f"{self.path}/log/{name}") <= limit:
                storage.delete(self.spark, f"{self.path}/log/{name}")
        return gone

"""Versioned file tables: all-or-nothing commits without a rename, reads of
any kept version, and merges that rewrite only the parts they touch.

A table is a folder::

    <table>/data/<commit>/part=<n>/*.parquet   rows, never changed once written
    <table>/versions/<number>.json             what a version is made of

A commit writes its rows to a folder of its own, compares what is stored there
with what was handed over, and then makes the next numbered file appear under
``versions``. That one small file is the commit: before it no reader sees
anything of the new rows, after it every reader sees all of them, and it fails
if another writer took the number first. No folder of rows is renamed or
replaced, so the same holds on an object store, given that its connector
refuses to create a file that exists (conditional writes switched on).

A version lists its parts: for each part number, the folder that holds it.
Rows of a keyed table are dealt to a fixed number of parts by a hash of their
key, so the list is bounded by that number, and a merge replaces the parts its
keys fall in and lists the others as they are.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakewash.operators.fingerprint import Fingerprint, fingerprint, require_same_content, write_fingerprinted
from lakewash.sources.sinks import StagedSink

PART = "part"

# File systems that rename a file at once and refuse to replace another; on any
# other one a file that is created appears when it is closed.
RENAMING = {"file", "hdfs", "viewfs"}


class CommitConflict(RuntimeError):
    """Another writer committed first; the table is as that writer left it."""


@dataclass(frozen=True)
class Version:
    """One committed state of a table."""

    number: int
    operation: str
    schema: T.StructType
    key: tuple[str, ...]
    parts: int
    folders: Mapping[int, str]  # part number -> folder, relative to the table
    rows: Mapping[int, int]  # part number -> rows

    @property
    def row_count(self) -> int:
        return sum(self.rows.values())

    def to_json(self) -> str:
        return json.dumps({"number": self.number, "operation": self.operation, "schema": self.schema.jsonValue(),
                           "key": list(self.key), "parts": self.parts,
                           "folders": {str(k): v for k, v in self.folders.items()},
                           "rows": {str(k): v for k, v in self.rows.items()}})

    @staticmethod
    def from_json(text: str) -> "Version":
        d = json.loads(text)
        return Version(d["number"], d["operation"], T.StructType.fromJson(d["schema"]), tuple(d["key"]), d["parts"],
                       {int(k): v for k, v in d["folders"].items()}, {int(k): v for k, v in d["rows"].items()})


class VersionedTable:
    """A versioned table at a path of any Hadoop file system."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._log = f"{self.path}/versions"

    # ------------------------------------------------------------ log files

    def _fs(self, path: str):
        hpath = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return hpath.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), hpath

    def versions(self) -> list[int]:
        """Numbers of the kept versions, oldest first."""
        fs, log = self._fs(self._log)
        if not fs.exists(log):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(log)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def version(self, number: int | None = None) -> Version:
        """A version by its number; the newest without one."""
        kept = self.versions()
        if not kept:
            raise FileNotFoundError(f"{self.path} holds no version")
        number = kept[-1] if number is None else number
        if number not in kept:
            raise LookupError(f"{self.path} has no version {number}; it keeps {kept[0]} to {kept[-1]}")
        fs, at = self._fs(f"{self._log}/{number:012d}.json")
        stream = fs.open(at)
        try:
            text = self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return Version.from_json(text)

    def _publish(self, version: Version) -> Version:
        """Make the version's file appear, whole, or fail if its number is taken."""
        fs, at = self._fs(f"{self._log}/{version.number:012d}.json")
        jvm = self.spark.sparkContext._jvm
        fs.mkdirs(at.getParent())
        renames = fs.getScheme() in RENAMING
        written = self._fs(f"{self._log}/{uuid.uuid4().hex}.new")[1] if renames else at
        try:
            stream = fs.create(written, False)  # an object store shows the file when it is closed
            try:
                stream.write(bytearray(version.to_json().encode()))
            finally:
                stream.close()
            if renames:  # a rename that refuses to replace what is there
                none = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
                jvm.org.apache.hadoop.fs.FileContext.getFileContext(
                    at.toUri(), self.spark.sparkContext._jsc.hadoopConfiguration()).rename(written, at, none)
        except Py4JJavaError as err:
            taken = fs.exists(at)
            if renames:
                fs.delete(written, False)
            if taken:
                raise CommitConflict(f"{self.path}: version {version.number} was committed by another writer") from err
            raise
        return version

    # ------------------------------------------------------------ rows

    def read(self, version: int | None = None, parts: Sequence[int] | None = None) -> DataFrame:
        """The rows of a version (default: the newest). The frame names that
        version's own folders, so later commits never change what it reads.
        ``parts`` reads some of the parts only."""
        v = self.version(version)
        wanted = [f"{self.path}/{folder}" for part, folder in sorted(v.folders.items()) if parts is None or part in parts]
        if not wanted:
            return self.spark.createDataFrame([], v.schema)
        return self.spark.read.schema(v.schema).parquet(*wanted)

    def _part(self, key: Sequence[str], parts: int) -> Column:
        if not key or parts == 1:
            return F.lit(0)
        return F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in key]), F.lit(parts)).cast("int")

    def _write(self, df: DataFrame, key: Sequence[str], parts: int) -> tuple[str, dict[int, int], Fingerprint]:
        """Rows to a new folder, a sub-folder for each part; rows of each part.
        What is stored is read back and compared with what was handed over."""
        if PART in map(str.lower, df.columns):
            raise ValueError(f"a column named {PART!r} is how parts are stored; rename it")
        folder = f"data/{uuid.uuid4().hex}"
        rows = df.withColumn("_lw_part", self._part(key, parts))
        if parts > 1:
            rows = rows.repartition("_lw_part")
        at = f"{self.path}/{folder}"
        try:
            source = write_fingerprinted(
                rows, lambda d: d.withColumnRenamed("_lw_part", PART).write.partitionBy(PART).parquet(at),
                columns=df.columns)
            counts: dict[int, int] = {}
            if source.rows:
                stored = self.spark.read.schema(T.StructType([*df.schema.fields, T.StructField(PART, T.IntegerType())])).parquet(at)
                require_same_content(source, fingerprint(stored, columns=df.columns), self.path)
                counts = {r[PART]: r["count"] for r in stored.groupBy(PART).count().collect()}  # at most `parts` rows
        except Exception:
            self._remove(folder)
            raise
        return folder, counts, source

    def _remove(self, folder: str) -> None:
        fs, at = self._fs(f"{self.path}/{folder}")
        fs.delete(at, True)

    def _commit(self, base: int, operation: str, schema: T.StructType, key: Sequence[str], parts: int,
                kept: Mapping[int, str], kept_rows: Mapping[int, int], folder: str, counts: Mapping[int, int]) -> Version:
        folders = {**kept, **{p: f"{folder}/{PART}={p}" for p in counts}}
        version = Version(base + 1, operation, schema, tuple(key), parts, folders, {**kept_rows, **counts})
        try:
            return self._publish(version)
        except CommitConflict:
            self._remove(folder)  # this writer's own rows, in no version
            raise

    def refresh(self, df: DataFrame, key: Sequence[str] = (), parts: int = 1) -> Version:
        """Replace all rows: the next version holds ``df`` and nothing else. A
        table that is to be merged into names its key and a number of parts
        (a part should fit a few tasks)."""
        sink = StagedVersion(self, key, parts)
        sink.stage(df)
        return sink.publish()

    def append(self, df: DataFrame) -> Version:
        """Add rows to a table without a key, in one commit."""
        base = self.version()
        if base.key:
            raise ValueError("rows join a keyed table by merge")
        same = df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in base.schema.fields])
        folder, counts, _ = self._write(same, (), 1)
        moved = {max(base.folders, default=-1) + 1 + p: p for p in counts}
        folders = {**base.folders, **{n: f"{folder}/{PART}={p}" for n, p in moved.items()}}
        version = Version(base.number + 1, "append", base.schema, (), max(len(folders), 1), folders,
                          {**base.rows, **{n: counts[p] for n, p in moved.items()}})
        try:
            return self._publish(version)
        except CommitConflict:
            self._remove(folder)
            raise

    def merge(self, changes: DataFrame, delete: str | None = None) -> Version:
        """Update, insert and delete by the table's key, in one commit.

        A change whose key the table holds replaces that row, any other is
        added; with ``delete``, the name of a boolean column of ``changes``
        that is no column of the table, true rows take their key's row away.
        A key may occur once in ``changes`` and may not be null: two changes
        of a key have no order. Only parts that hold a changed key are read
        and written; the version lists the other parts as they are. Old and
        new rows of those parts are joined by the key, which is unique in
        either, so no key is hot.
        """
        base = self.version()
        if not base.key:
            raise ValueError(f"{self.path} has no key to merge by")
        key = list(base.key)
        names = [f.name for f in base.schema.fields]
        gone = F.coalesce(F.col(f"`{delete}`"), F.lit(False)) if delete else F.lit(False)
        fields = [F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in base.schema.fields]
        typed = changes.select(*fields, gone.alias("_lw_gone"))
        part = self._part(key, base.parts)
        null_key = F.lit(False)
        for k in key:
            null_key = null_key | F.col(f"`{k}`").isNull()
        groups = typed.groupBy(part.alias("p"), *[F.col(f"`{k}`") for k in key]).agg(F.count(F.lit(1)).alias("n"))
        report = groups.groupBy("p").agg(F.max("n").alias("most"), F.max(null_key.cast("int")).alias("nulls")).collect()
        if any(r["most"] > 1 for r in report):
            raise ValueError(f"a key of {key} occurs more than once in the changes")
        if any(r["nulls"] for r in report):
            raise ValueError(f"a key of {key} is null in the changes")
        touched = sorted(r["p"] for r in report)  # at most `parts` numbers
        if not touched:
            return base
        old = self.read(base.number, touched)
        same = None
        marked = typed.select(*[F.col(f"`{k}`").alias(f"_lw_k{i}") for i, k in enumerate(key)])
        for i, k in enumerate(key):
            term = F.col(f"`{k}`") == F.col(f"_lw_k{i}")
            same = term if same is None else same & term
        kept = old.join(marked, same, "left_anti")
        rows = kept.unionByName(typed.where(~F.col("_lw_gone")).select(*[F.col(f"`{c}`") for c in names]))
        folder, counts, _ = self._write(rows, key, base.parts)
        left = {p: f for p, f in base.folders.items() if p not in touched}
        return self._commit(base.number, "merge", base.schema, key, base.parts, left,
                            {p: n for p, n in base.rows.items() if p in left}, folder, counts)

    def vacuum(self, keep: int = 1) -> list[str]:
        """Forget all but the newest ``keep`` versions and remove the folders
        that no kept version names: what failed commits and old versions left.
        Run it while nobody writes, and when no reader of an older version is
        still at work. Returns the removed folders."""
        if keep < 1:
            raise ValueError("at least the newest version is kept")
        numbers = self.versions()
        live = {f.split(f"/{PART}=")[0] for n in numbers[-keep:] for f in self.version(n).folders.values()}
        for n in numbers[:-keep]:
            fs, at = self._fs(f"{self._log}/{n:012d}.json")
            fs.delete(at, False)
        fs, data = self._fs(f"{self.path}/data")
        found = [f"data/{s.getPath().getName()}" for s in fs.listStatus(data)] if fs.exists(data) else []
        dead = sorted(f for f in found if f not in live)
        for folder in dead:
            self._remove(folder)
        return dead


class StagedVersion(StagedSink):
    """A full refresh of a versioned table in two steps: the rows are written
    and compared, then the version that lists them is committed. It replaces
    the version that was the newest when it was staged."""

    def __init__(self, table: VersionedTable, key: Sequence[str] = (), parts: int = 1):
        if parts > 1 and not key:
            raise ValueError("parts are dealt by a key")
        self.table, self.key, self.parts = table, key, parts

    def stage(self, df: DataFrame) -> Fingerprint:
        kept = self.table.versions()
        self._base, self._schema = kept[-1] if kept else 0, df.schema
        self._folder, self._counts, source = self.table._write(df, self.key, self.parts)
        return source

    def publish(self) -> Version:
        return self.table._commit(self._base, "refresh", self._schema, self.key, self.parts, {}, {},
                                  self._folder, self._counts)

    def discard(self) -> None:
        self.table._remove(self._folder)

"""S6, S9, S11, S12 with versions: the tables of a load become visible together, or not at all.

A root folder holds

* ``_loads/<load>/<table>``: the files of one load, never changed once written;
* ``_versions/<number>.json``: one manifest per version, which names the folder,
  schema and row count of every table of the root.

A load writes its tables into a folder of its own, beside whatever readers use.  Keys
declared as a table's *grain* are checked on the files written (their key columns
only); violations are stored under ``_violations/<load>/<table>`` and refuse the load.
``commit`` then adds one manifest: a file written aside and renamed to the next number,
which fails if that number exists.  Readers take the highest number.  So

* a job that dies anywhere before the rename leaves the last version as it was;
* all tables of a load change in one step, for every reader that holds a ``Version``;
* of two loads that finish at once one takes the number, the other renames to the next
  after merging: tables it didn't write are those of the newest version;
* a stream's batch is published once: its number is kept in the manifest, and a batch
  that comes again (a restart between the commit and the stream's own checkpoint) is
  skipped.

Old versions stay readable by number until ``vacuum`` deletes them.  The file system
must refuse a rename onto an existing file, as HDFS and ABFS do in one step (the local
one checks first, which does for one writer); an S3 bucket needs a table format.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from pitchlens.sources.grain import check_grain

VERSIONS, LOADS, VIOLATIONS = "_versions", "_loads", "_violations"
TAG = "__pl_table"  # partition column of tables written in one pass


class GrainViolation(ValueError):
    """Keys declared unique occur more than once; ``stored`` maps a table to the folder
    that holds its violations (the keys and their number ``n``)."""

    def __init__(self, stored: Mapping[str, str]):
        super().__init__("grain violated: " + ", ".join(f"{t} (see {p})" for t, p in sorted(stored.items())))
        self.stored = dict(stored)


# --- files of the shared storage, by Spark's own Hadoop client -----------------

def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _fs(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    return _fs(spark, path).exists(_path(spark, path))


def _names(spark: SparkSession, folder: str) -> list[tuple[str, float]]:
    """(name, modification time in seconds) of a folder's entries; none if there is no folder."""
    if not exists(spark, folder):
        return []
    return [(s.getPath().getName(), s.getModificationTime() / 1000) for s in _fs(spark, folder).listStatus(_path(spark, folder))]


def read_text(spark: SparkSession, path: str) -> str:
    """A small file's text."""
    stream = _fs(spark, path).open(_path(spark, path))
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _created(spark: SparkSession, path: str, text: str) -> bool:
    """Write ``path`` whole unless it exists; False if it does."""
    jvm = spark._jvm
    folder, name = path.rsplit("/", 1)
    aside = f"{folder}/.{name}-{uuid.uuid4().hex[:12]}"
    out = _fs(spark, aside).create(_path(spark, aside), False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(_path(spark, path).toUri(), spark._jsc.hadoopConfiguration())
    plain = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        files.rename(_path(spark, aside), _path(spark, path), plain)
    except Exception as e:  # py4j wraps the JVM's exception
        _fs(spark, aside).delete(_path(spark, aside), False)
        if "FileAlreadyExistsException" in str(getattr(e, "java_exception", e)):
            return False
        raise
    return True


# --- versions -------------------------------------------------------------------

@dataclass(frozen=True)
class Version:
    """All tables of a root as of one commit."""

    root: str
    number: int = 0
    tables: Mapping[str, Mapping] = field(default_factory=dict)
    batches: Mapping[str, int] = field(default_factory=dict)

    def read(self, spark: SparkSession, name: str) -> DataFrame:
        """A table of this version, with the schema it was written with."""
        if name not in self.tables:
            raise KeyError(f"no table {name} in version {self.number} of {self.root}")
        t = self.tables[name]
        schema = T.StructType.fromJson(t["schema"])
        if not t["rows"]:
            return spark.createDataFrame([], schema)
        column = t.get("column")
        stored = T.StructType([T.StructField(column, schema)]) if column else schema
        df = spark.read.schema(stored).parquet(f"{self.root}/{t['path']}")
        return df.select(f"{column}.*") if column else df


def versions(spark: SparkSession, root: str) -> list[int]:
    """The numbers of the versions kept, ascending."""
    return sorted(int(n[:-5]) for n, _ in _names(spark, f"{root.rstrip('/')}/{VERSIONS}") if n[:-5].isdigit() and n.endswith(".json"))


def version(spark: SparkSession, root: str, number: int | None = None) -> Version:
    """A version by number; without one the newest, which is empty (0) where none is."""
    root = root.rstrip("/")
    if number is None:
        number = max(versions(spark, root), default=0)
        if not number:
            return Version(root)
    known = json.loads(read_text(spark, f"{root}/{VERSIONS}/{number:012d}.json"))
    return Version(root, number, known["tables"], known["batches"])


def is_published(spark: SparkSession, root: str) -> bool:
    return exists(spark, f"{root.rstrip('/')}/{VERSIONS}")


class Load:
    """The tables of one load under ``root``: ``write`` each, then ``commit``.

    What ``write`` returns reads the load's own files, before anyone else sees
    them, so a table can be made from another of the same load.  ``batch`` is a
    stream's name and the number of its batch.
    """

    def __init__(self, spark: SparkSession, root: str, batch: tuple[str, int] | None = None):
        self.spark, self.root, self.batch = spark, root.rstrip("/"), batch
        self.name = uuid.uuid4().hex[:16]
        self._tables: dict[str, dict] = {}
        self._violations: dict[str, str] = {}

    @property
    def already_published(self) -> bool:
        """Whether the stream's batch is in the newest version."""
        return self.batch is not None and version(self.spark, self.root).batches.get(self.batch[0], -1) >= self.batch[1]

    def _only_once(self, *names: str) -> None:
        twice = self._tables.keys() & set(names)
        if twice:
            raise ValueError(f"written before in this load: {sorted(twice)}")

    def _written(self, name: str, path: str, schema: T.StructType, column: str | None, grain: Sequence[str]) -> DataFrame:
        entry = {"path": path, "schema": json.loads(schema.json()), "rows": 1}
        if column:
            entry["column"] = column
        if not exists(self.spark, f"{self.root}/{path}"):  # a tag without rows
            entry["rows"] = 0
        rows = Version(self.root, 0, {name: entry}).read(self.spark, name)
        if entry["rows"]:
            entry["rows"] = rows.count()  # from the files' footers
        self._tables[name] = entry
        if grain and entry["rows"]:
            audit = f"{self.root}/{VIOLATIONS}/{self.name}/{name}"
            twice = check_grain(rows, grain)
            twice.write.parquet(audit)
            if not self.spark.read.schema(twice.schema).parquet(audit).isEmpty():
                self._violations[name] = audit
        return Version(self.root, 0, self._tables).read(self.spark, name)

    def write(self, name: str, df: DataFrame, grain: Sequence[str] = (), partition_by: Sequence[str] = ()) -> DataFrame:
        """Write a table's files; ``grain`` are its unique keys."""
        self._only_once(name)
        path = f"{LOADS}/{self.name}/{name}"
        writer = df.write.partitionBy(*partition_by) if partition_by else df.write
        writer.parquet(f"{self.root}/{path}")
        return self._written(name, path, df.schema, None, grain)

    def write_tagged(self, rows: DataFrame, grains: Mapping[str, Sequence[str]] | None = None) -> dict[str, DataFrame]:
        """Write several tables in one pass over ``rows``: column ``TAG`` names a row's
        table, which has a struct column of that name with the table's columns."""
        grains = grains or {}
        self._only_once(*(c for c in rows.columns if c != TAG))
        folder = f"{LOADS}/{self.name}/tagged-{uuid.uuid4().hex[:8]}"
        rows.write.partitionBy(TAG).parquet(f"{self.root}/{folder}")
        return {c: self._written(c, f"{folder}/{TAG}={c}", rows.schema[c].dataType, c, grains.get(c, ()))
                for c in rows.columns if c != TAG}

    def commit(self) -> Version:
        """Make the load's tables the newest version; refused where a grain is violated."""
        if self._violations:
            raise GrainViolation(self._violations)
        while True:
            last = version(self.spark, self.root)
            batches = dict(last.batches)
            if self.batch:
                stream, number = self.batch
                if batches.get(stream, -1) >= number:
                    return last
                batches[stream] = number
            new = Version(self.root, last.number + 1, {**last.tables, **self._tables}, batches)
            manifest = json.dumps({"tables": new.tables, "batches": new.batches, "load": self.name, "at": time.time()})
            if _created(self.spark, f"{self.root}/{VERSIONS}/{new.number:012d}.json", manifest):
                return new


def publish(spark: SparkSession, root: str, tables: Mapping[str, DataFrame],
            grains: Mapping[str, Sequence[str]] | None = None, batch: tuple[str, int] | None = None) -> Version:
    """Write ``tables`` and make them, together, the newest version of ``root``."""
    load = Load(spark, root, batch)
    if load.already_published:
        return version(spark, root)
    for name, df in tables.items():
        load.write(name, df, (grains or {}).get(name, ()))
    return load.commit()


def vacuum(spark: SparkSession, root: str, keep: int = 2, older_than: float = 24 * 3600) -> list[str]:
    """Delete all but the newest ``keep`` versions, and the files of loads that no kept
    version names and that are older than ``older_than`` seconds (a younger one may
    still be writing).  Returns the folders deleted."""
    if keep < 1:
        raise ValueError("the newest version stays")
    root = root.rstrip("/")
    numbers = versions(spark, root)
    for n in numbers[:-keep]:
        path = f"{root}/{VERSIONS}/{n:012d}.json"
        _fs(spark, path).delete(_path(spark, path), False)
    named = {t["path"].split("/")[1] for n in numbers[-keep:] for t in version(spark, root, n).tables.values()}
    gone = []
    for name, changed in _names(spark, f"{root}/{LOADS}"):
        if name not in named and changed < time.time() - older_than:
            path = f"{root}/{LOADS}/{name}"
            _fs(spark, path).delete(_path(spark, path), True)
            gone.append(path)
    return gone


def violations(spark: SparkSession, refused: GrainViolation) -> dict[str, DataFrame]:
    """The stored violations of a refused load, per table."""
    return {t: spark.read.parquet(p) for t, p in refused.stored.items()}

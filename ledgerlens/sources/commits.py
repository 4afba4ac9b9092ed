"""Table writes that take effect at one moment.

A write first puts its new files into a hidden folder beside the table, then
commits by renaming one small file into place, and only then moves the new
files over the old ones.  Before the rename nothing has happened; after it
the write is certain: :func:`recover`, which every writer calls first, finishes
the moves of a writer that died between, and removes what another left
uncommitted.  Moves can be repeated: a new folder that is no longer beside the
table has been moved already.

One commit may hold steps for several tables (rows, rejected rows and the
ledger of one load), so they cannot disagree after a crash.

:func:`read_table` follows the commit: where moves are still missing it reads the
new files where they are.  Plain readers of the folder see the old or new files
of each partition, as with any partition overwrite; appended rows show as their files are moved.

A table has one writer at a time.  All file work goes through the session's
Hadoop file system; renaming a file must not overwrite silently on it, and on
object stores, where a rename copies, a repeated move copies again.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

COMMITTED = "_COMMITTED"
#: Spark removes the shuffle files of a query when it ends.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"
WHOLE, PARTITIONS, APPEND = "whole", "partitions", "append"


class Files:
    """The few calls on the session's Hadoop file system that commits need."""

    def __init__(self, spark: SparkSession):
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()

    def _at(self, path: str):
        p = self._jvm.org.apache.hadoop.fs.Path(path)
        return p, p.getFileSystem(self._conf)

    def exists(self, path: str) -> bool:
        p, fs = self._at(path)
        return fs.exists(p)

    def children(self, path: str) -> list[tuple[str, bool]]:
        """(name, is a folder) of what lies in a folder; nothing if there is no folder."""
        p, fs = self._at(path)
        if not fs.exists(p):
            return []
        return [(s.getPath().getName(), s.isDirectory()) for s in fs.listStatus(p)]

    def move(self, source: str, target: str) -> None:
        s, fs = self._at(source)
        t, _ = self._at(target)
        fs.mkdirs(t.getParent())
        if not fs.rename(s, t):
            raise OSError(f"could not move {source} to {target}")

    def delete(self, path: str) -> None:
        p, fs = self._at(path)
        fs.delete(p, True)

    def write(self, path: str, text: str) -> None:
        p, fs = self._at(path)
        out = fs.create(p, True)
        out.write(bytearray(text.encode()))
        out.close()

    def read(self, path: str) -> str:
        p, fs = self._at(path)
        stream = fs.open(p)
        text = self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        stream.close()
        return text


def staging_root(path: str) -> str:
    """``<parent>/_staging_<name>``: next to the table, ignored by Spark's file listing."""
    parent, name = path.rstrip("/").rsplit("/", 1)
    return f"{parent}/_staging_{name}"


def is_data(name: str) -> bool:
    return not name.startswith(("_", "."))


def partition_value(name: str) -> str | None:
    """The value in a partition folder's name, as text."""
    value = unquote(name.split("=", 1)[1])
    return None if value == NULL_PARTITION else value


def value_text(value) -> str | None:
    """A partition value as Spark writes it in a folder's name, unescaped."""
    if value is None or isinstance(value, str):
        return value
    if isinstance(value, bool):
        return str(value).lower()
    return value.isoformat() if isinstance(value, dt.date) else str(value)


class Commit:
    """A write of one or more tables; ``home`` is the table beside which it is staged."""

    def __init__(self, spark: SparkSession, home: str):
        self.spark, self.files = spark, Files(spark)
        self.folder = f"{staging_root(home)}/{uuid.uuid4().hex}"
        self.steps: list[dict] = []

    def scratch(self, name: str) -> str:
        """A path for the write's own intermediates, removed with it."""
        return f"{self.folder}/_{name}"

    def write(self, df: DataFrame, folder: str, partition_by: list[str] | None = None) -> None:
        """Write files of this write.  What its job shuffled is of no more use then and
        goes at once, so that the disk holds one step's shuffles and not those of the whole run."""
        writer = df.write.option("partitionOverwriteMode", "static")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        before = self.spark.conf.get(SHUFFLE_CLEANUP, None)
        self.spark.conf.set(SHUFFLE_CLEANUP, "true")
        try:
            writer.parquet(folder)
        finally:
            if before is None:
                self.spark.conf.unset(SHUFFLE_CLEANUP)
            else:
                self.spark.conf.set(SHUFFLE_CLEANUP, before)

    def _stage(self, df: DataFrame, kind: str, path: str, partition_by: list[str] | None, name: str | None = None) -> dict:
        folder = f"{self.folder}/{name or len(self.steps)}"
        self.write(df, folder, partition_by)
        step = {"kind": kind, "staged": folder, "path": path.rstrip("/"), "gone": []}
        self.steps.append(step)
        return step

    def replace(self, df: DataFrame, path: str, partition_by: list[str] | None = None, name: str | None = None) -> None:
        """The whole table becomes ``df`` (staged as ``name``)."""
        self._stage(df, WHOLE, path, partition_by, name)

    def replace_partitions(self, df: DataFrame, path: str, partition_col: str, touched: list) -> None:
        """The partitions ``touched`` become what ``df`` holds of them; those it holds nothing of go."""
        step = self._stage(df, PARTITIONS, path, [partition_col])
        new = {name for name, folder in self.files.children(step["staged"]) if folder and is_data(name)}
        values = {value_text(v) for v in touched}
        step["gone"] = [name for name, folder in self.files.children(step["path"])
                        if folder and is_data(name) and name not in new and partition_value(name) in values]

    def append(self, df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
        """The rows of ``df`` are added to the table."""
        self._stage(df, APPEND, path, partition_by)

    def commit(self) -> None:
        """The moment at which all steps take effect."""
        self.files.write(f"{self.folder}/{COMMITTED}.tmp", json.dumps(self.steps))
        self.files.move(f"{self.folder}/{COMMITTED}.tmp", f"{self.folder}/{COMMITTED}")

    def apply(self) -> None:
        """Move the new files into place; may be repeated after a crash."""
        for step in self.steps:
            _apply(self.files, step)
        self.files.delete(self.folder)

    def finish(self) -> None:
        """Commit and apply."""
        self.commit()
        self.apply()

    def abandon(self) -> None:
        """Remove everything staged."""
        self.files.delete(self.folder)


def _apply(files: Files, step: dict) -> None:
    staged, path = step["staged"], step["path"]
    if step["kind"] == WHOLE:
        if files.exists(staged):
            files.delete(path)
            files.move(staged, path)
    elif step["kind"] == PARTITIONS:
        for name in step["gone"]:
            files.delete(f"{path}/{name}")
        for name, folder in files.children(staged):
            if folder and is_data(name):
                files.delete(f"{path}/{name}")
                files.move(f"{staged}/{name}", f"{path}/{name}")
    else:
        _move_files(files, staged, path)


def _move_files(files: Files, staged: str, path: str) -> None:
    for name, folder in files.children(staged):
        if not is_data(name):
            continue
        if folder:
            _move_files(files, f"{staged}/{name}", f"{path}/{name}")
        else:
            # A file left behind by a copying rename that did not end.
            files.delete(f"{path}/{name}")
            files.move(f"{staged}/{name}", f"{path}/{name}")


def _steps(files: Files, folder: str) -> list[dict] | None:
    """The steps of a committed write; None if it is not committed."""
    marker = f"{folder}/{COMMITTED}"
    return json.loads(files.read(marker)) if files.exists(marker) else None


def recover(spark: SparkSession, path: str) -> int:
    """Finish or remove what earlier writers of the table left; returns the number of writes finished."""
    files, finished = Files(spark), 0
    for name, folder in files.children(staging_root(path)):
        if not folder:
            continue
        where = f"{staging_root(path)}/{name}"
        steps = _steps(files, where)
        for step in steps or []:
            _apply(files, step)
        finished += steps is not None
        files.delete(where)
    return finished


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame | None:
    """The table as of its last commit, or None if there is none."""
    files, path = Files(spark), path.rstrip("/")

    def read(folder: str) -> DataFrame | None:
        try:
            reader = spark.read.schema(schema) if schema is not None else spark.read
            return reader.parquet(folder)
        except AnalysisException:
            return None

    for name, folder in files.children(staging_root(path)):
        where = f"{staging_root(path)}/{name}"
        for step in (_steps(files, where) or [] if folder else []):
            if step["path"] != path or not files.exists(step["staged"]):
                continue
            if step["kind"] == WHOLE:
                return read(step["staged"])
            if step["kind"] == PARTITIONS:
                return _partly_moved(files, step, read)
    return read(path) if schema is None or files.exists(path) else None


def _partly_moved(files: Files, step: dict, read) -> DataFrame | None:
    """A partitioned table of which some new partitions are not in place yet."""
    waiting = [name for name, folder in files.children(step["staged"]) if folder and is_data(name)]
    old, new = read(step["path"]), read(step["staged"])
    if not waiting or old is None:
        return old if new is None or not waiting else new
    column = waiting[0].split("=", 1)[0]
    values = [partition_value(name) for name in [*waiting, *step["gone"]]]
    text = F.col(column).cast("string")
    stays = ~F.coalesce(text.isin([v for v in values if v is not None]), F.lit(False))
    if None in values:
        stays = stays & text.isNotNull()
    return old.filter(stays).unionByName(new.select([F.col(f.name).cast(f.dataType) for f in old.schema.fields]))

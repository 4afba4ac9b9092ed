"""Intermediate tables in the shared folder, removed when they are no longer needed."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from ledgerlens.session import ensure_checkpoint_dir


class Tables:
    """Parquet tables of one run below the shared checkpoint folder.  Written tables cut the lineage, so
    a lost executor costs no earlier step; they take a fraction of a checkpoint's room."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
        self._paths: dict[int, str] = {}
        self._kept: list[DataFrame] = []

    def write(self, df: DataFrame) -> DataFrame:
        """``df`` written and read back."""
        path = f"{self.folder}/{len(self._kept)}"
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self._paths[id(out)] = path
        self._kept.append(out)
        return out

    def _delete(self, path: str) -> None:
        where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(where, True)

    def drop(self, table: DataFrame) -> None:
        """Remove a table that :meth:`write` returned."""
        path = self._paths.pop(id(table), None)
        if path:
            self._delete(path)

    def drop_all_but(self, *tables: DataFrame) -> None:
        """Remove all tables but ``tables``."""
        keep = {id(t) for t in tables}
        for key in [k for k in self._paths if k not in keep]:
            self._delete(self._paths.pop(key))

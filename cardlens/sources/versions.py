"""Tables as lists of live files, several tables to a version, and versions published as a whole.

Below ``root`` every write makes a folder of its own, ``<table>/_written=<id>``, and its files never change.
A manifest names the live files of all tables, with the rows and the range of keys of each. The table
``published`` holds a row for each version, its number and its manifest; that row is written last, as one file,
so a reader sees a version whole or not at all, and older versions stay readable. Files are never deleted here.

One writer at a time: a second one that started from the same version is refused when it publishes, or
finds its number taken twice, which readers refuse as well.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from cardlens.schemas import TableSchema

_WRITTEN = "_written"
_MANIFEST = "table string, file string, rows long, first_key string, last_key string"
_PUBLISHED = "version long, manifest string"


class VersionConflict(RuntimeError):
    """Another writer published first; nothing of this version is visible."""


class Store:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def version(self) -> int | None:
        """The number of the version published last; None before the first."""
        return max(self._published(), default=None)

    def _published(self) -> dict[int, str]:
        try:
            rows = self.spark.read.schema(_PUBLISHED).parquet(f"{self.root}/published").collect()  # a row a version
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return {}
        found = {r["version"]: r["manifest"] for r in rows}
        if len(found) < len(rows):
            raise VersionConflict(f"{self.root}: a version was published twice")
        return found

    def manifest(self, version: int | None = None) -> DataFrame:
        """``table, file, rows, first_key, last_key`` of a version, by default the last."""
        published = self._published()
        number = max(published, default=None) if version is None else version
        if number is None:
            return self.spark.createDataFrame([], _MANIFEST)
        if number not in published:
            raise ValueError(f"{self.root}: there is no version {number}")
        return self.spark.read.schema(_MANIFEST).parquet(published[number])

    def files(self, table: str, version: int | None = None) -> DataFrame:
        return self.manifest(version).where(F.col("table") == table)

    def read(self, table: str, schema: TableSchema | None = None, version: int | None = None) -> DataFrame:
        """A table of a version, the same rows whatever is published meanwhile."""
        return self.read_files(table, [r["file"] for r in self.files(table, version).select("file").collect()], schema)

    def read_files(
        self, table: str, files: Sequence[str], schema: TableSchema | None = None, file_column: str | None = None
    ) -> DataFrame:
        """Some files of a table; ``file_column`` adds the file that each row comes from."""
        if not files and schema is None:
            raise ValueError(f"{self.root}: no files of {table}")
        if not files:
            rows = self.spark.createDataFrame([], schema.struct())
            return rows.withColumn(file_column, F.lit(None).cast("string")) if file_column else rows
        reader = self.spark.read.option("basePath", f"{self.root}/{table}")
        rows = (reader.schema(schema.struct()) if schema else reader).parquet(*files)
        if file_column:
            rows = rows.select("*", F.col("_metadata.file_path").alias(file_column))
        return rows.drop(_WRITTEN)

    def new_path(self, table: str) -> str:
        """Where the next files of a table go."""
        return f"{self.root}/{table}/{_WRITTEN}={uuid.uuid4().hex}"

    def listing(self, table: str, path: str, key: str | None = None) -> DataFrame:
        """The manifest rows of the files written to ``path``. Of these only the column ``key`` is read."""
        rows = self.spark.read.parquet(path)
        first, last = (f(key).cast("string") if key else F.lit(None).cast("string") for f in (F.min, F.max))
        return rows.groupBy(F.col("_metadata.file_path").alias("file")).agg(
            F.count("*").alias("rows"), first.alias("first_key"), last.alias("last_key")
        ).select(F.lit(table).alias("table"), "file", "rows", "first_key", "last_key")

    def publish(self, changed: Mapping[str, DataFrame], base: int | None) -> int:
        """Make the listings of the ``changed`` tables, beside the other tables of version ``base``, the next version."""
        if self.version() != base:
            raise VersionConflict(f"{self.root}: version {base} is not the last any more")
        rows = self.manifest(base).where(~F.col("table").isin(list(changed)))
        for listing in changed.values():
            rows = rows.unionByName(listing)
        number, path = (base or 0) + 1, f"{self.root}/manifests/{uuid.uuid4().hex}"
        rows.coalesce(1).write.parquet(path)  # a row a file of the tables
        entry = self.spark.createDataFrame([(number, path)], _PUBLISHED)
        entry.coalesce(1).write.mode("append").parquet(f"{self.root}/published")
        if self._published()[number] != path:
            raise VersionConflict(f"{self.root}: version {number} was published twice")
        return number

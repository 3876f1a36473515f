"""Layers whose files are sorted by a key, for lookups and pages that open few files.

Rows are dealt to files by ranges of the key and sorted inside; an index holds
each file's number of rows and its least and largest key. A lookup reads the
files whose range holds the key, which is one if the key is unique. A page
starts behind the last key of the page before (a cursor, in place of an offset),
so the hundredth page opens as many files as the first.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of a file, on average.
ROWS = 1_000_000


@dataclass
class ClusteredLayer:
    """The layer in folder ``path``, sorted by the columns ``keys``, ascending, nulls first."""

    spark: SparkSession
    path: str
    keys: tuple[str, ...]

    def write(self, df: DataFrame, rows_per_file: int = ROWS) -> None:
        files = max(1, -(-df.count() // rows_per_file))
        by = [F.col(f"`{k}`").asc_nulls_first() for k in self.keys]
        df.repartitionByRange(files, *by).sortWithinPartitions(*by).write.parquet(f"{self.path}/rows")
        key = self._key()
        (self.spark.read.parquet(f"{self.path}/rows").groupBy(F.col("_metadata.file_path").alias("file"))
         .agg(F.count(F.lit(1)).alias("n"), F.min(key).alias("low"), F.max(key).alias("high"))
         .orderBy("low").coalesce(1).write.parquet(f"{self.path}/index"))

    def _key(self) -> Column:
        return F.struct(*[F.col(f"`{k}`").alias(f"k{i}") for i, k in enumerate(self.keys)])

    def _at(self, value: tuple) -> Column:
        """A key as a column of the same types."""
        types = self.spark.read.parquet(f"{self.path}/rows").select(*[f"`{k}`" for k in self.keys]).schema
        return F.struct(*[F.lit(v).cast(f.dataType).alias(f"k{i}") for i, (v, f) in enumerate(zip(value, types, strict=True))])

    def index(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/index")

    def read(self, files: list[str]) -> DataFrame:
        """The rows of some files (none: no rows)."""
        return self.spark.read.parquet(*files) if files else self.spark.read.parquet(f"{self.path}/rows").limit(0)

    def lookup_files(self, value: tuple) -> list[str]:
        at = self._at(value)
        return [r.file for r in self.index().where((F.col("low") <= at) & (F.col("high") >= at)).select("file").collect()]

    def lookup(self, value: tuple) -> DataFrame:
        """The rows with this key."""
        return self.read(self.lookup_files(value)).where(self._key() == self._at(value))

    def page_files(self, after: tuple | None, limit: int) -> list[str]:
        """The files that hold the next ``limit`` rows behind a key: the one that the
        key lies in, and as many as the rows need (``limit + 1`` index rows are read at most)."""
        index = self.index() if after is None else self.index().where(F.col("high") > self._at(after))
        files, rows = [], 0
        for k, r in enumerate(index.orderBy("low").limit(limit + 1).collect()):
            if rows >= limit:
                break
            files.append(r.file)
            rows += r.n if k or after is None else 0  # how many of the first lie behind the key is not known
        return files

    def page(self, after: tuple | None, limit: int) -> DataFrame:
        """The next ``limit`` rows behind the key ``after`` (None: the first page), in order."""
        if limit < 1:
            raise ValueError("a page has a row at least")
        rows = self.read(self.page_files(after, limit))
        rows = rows if after is None else rows.where(self._key() > self._at(after))
        return rows.orderBy(*[F.col(f"`{k}`").asc_nulls_first() for k in self.keys]).limit(limit)

    def cursor(self, page: DataFrame) -> tuple | None:
        """The key to go on from: that of the page's last row."""
        last = page.agg(F.max(self._key()).alias("k")).first().k
        return None if last is None else tuple(last)

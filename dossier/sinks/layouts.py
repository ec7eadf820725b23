"""Tables laid out by key: bucketed ones that join without a shuffle, and ones changed in part.

Rows: J1, J8, U4 on bucketed tables; M2, M4, M6 that rewrite only the folders they touch.
"""
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from dossier.operators.versions import clear_log, delete_ids, upsert


# ---- bucketed tables --------------------------------------------------------------------

def append_bucketed(rows: DataFrame, name: str, keys: Sequence[str], buckets: int,
                    path: str | None = None) -> None:
    """Append to the table ``name``, which is bucketed by ``keys``; the first append makes it.

    Two tables of the same keys and number of buckets are joined on them, and made distinct by
    them, without a shuffle.  An append costs one shuffle of the new rows, which gives one file a
    bucket and splits a bucket that is too large for one task.  A bucket is read by one task: keys
    should be near to unique, as note ids are.  Repeated appends add files, so their sort order
    holds within each file only.
    """
    dealt = rows.hint("rebalance", buckets, *[F.col(k) for k in keys])
    writer = dealt.write.mode("append").format("parquet").bucketBy(buckets, *keys).sortBy(*keys)
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(name)


# ---- tables changed in part -------------------------------------------------------------

@dataclass(frozen=True)
class BucketFolders:
    """A Parquet table in ``n`` folders by a hash of ``keys``, changed by the folders touched.

    A change first writes the new content of the touched folders to ``<path>.pending``, then
    replaces these folders; others keep their files.  When it fails while the content is made, the
    table is as before.  When the process ends while folders are replaced, the next change (or
    :meth:`finish`) replaces them again from the pending content, so no row is lost and no write
    counts twice.  There is one writer at a time; a reader that must not see a change half done
    reads before or after it.

    A NULL key counts as ``missing``, the spelling under which upserts look up rows without an id.
    The number of folders is part of the folders' names: opening a table with another number
    fails instead of reading wrongly.
    """
    spark: SparkSession
    path: str
    schema: StructType
    keys: tuple[str, ...]
    n: int = 1024
    missing: str = "MISSING"

    @property
    def folder(self) -> str:
        return f"bucket_of_{self.n}"

    def bucket(self, **given: Column) -> Column:
        """The folder of a row; ``given`` stands for key columns that are not in the row."""
        parts = [F.coalesce(given.get(k, F.col(k)).cast("string"), F.lit(self.missing)) for k in self.keys]
        return F.pmod(F.xxhash64(*parts), F.lit(self.n)).cast("int")

    def create(self, rows: DataFrame) -> None:
        """A new table of ``rows``."""
        self._write(rows.select(*self.schema.names, self.bucket().alias(self.folder)), "errorifexists")

    def read(self, touched: Sequence[int] | None = None) -> DataFrame:
        """The table, or the rows of some folders; only these are listed and read."""
        self._check()
        df = self.spark.read.schema(self._laid_out).parquet(self.path)
        if touched is not None:
            df = df.filter(F.col(self.folder).isin(list(touched)))
        return df.select(*self.schema.names)

    def upsert(self, new: DataFrame, order: str = "ord") -> DataFrame:
        """M2: write ``new`` over the table by (contact, eni id); returns the rows written, with ``action``.

        ``new`` is read more than once and must give the same rows each time.
        """
        if not set(self.keys) <= {"contact_id", "eni_id"}:
            raise ValueError(f"an upsert finds rows by contact and eni id, not by {self.keys}")
        self.finish()
        touched = self._folders(new.select(self.bucket().alias(self.folder)))
        done = upsert(new, self.read(touched), order, self.missing)
        return self._change(done, touched).filter("action <> 'kept'")

    def delete(self, ids: DataFrame, key: str) -> None:
        """M4: leave out the rows whose ``key`` is listed."""
        self.finish()
        ids = ids.select(key).filter(F.col(key).isNotNull())
        if self.keys == (key,):
            touched = self._folders(ids.select(self.bucket().alias(self.folder)))
        else:
            touched = self._folders(self.read().join(ids, key, "left_semi").select(self.bucket().alias(self.folder)))
        self._change(delete_ids(self.read(touched), ids, key), touched)

    def clear(self, contact: str | None = None) -> None:
        """M6: leave out one contact's rows (by null-safe equality), or all rows when none is named."""
        self.finish()
        if contact is None:
            touched = list(range(self.n))
        elif self.keys == ("contact_id",):
            touched = self._folders(self.spark.range(1).select(
                self.bucket(contact_id=F.lit(contact)).alias(self.folder)))
        else:
            touched = self._folders(self.read().filter(F.col("contact_id") == contact)
                                    .select(self.bucket().alias(self.folder)))
        self._change(clear_log(self.read(touched), contact), touched)

    def finish(self) -> None:
        """Replace folders from the content of a change that was stopped on the way, if there is one."""
        if self._exists(f"{self._pending}/touched/_SUCCESS"):
            touched = [r[0] for r in self.spark.read.schema("folder int").parquet(f"{self._pending}/touched").collect()]
            self._replace(touched)

    # -- steps of a change; no list below is longer than the number of folders

    @property
    def _pending(self) -> str:
        return f"{self.path.rstrip('/')}.pending"

    def _folders(self, found: DataFrame) -> list[int]:
        return sorted(r[0] for r in found.distinct().collect())

    def _change(self, content: DataFrame, touched: list[int]) -> DataFrame:
        """Write the new content of the folders ``touched`` aside, then put it in their place."""
        self._delete(f"{self._pending}/touched")
        kinds = {f.name: F.col(f.name).cast(f.dataType) for f in self.schema.fields}
        staged = content.withColumns(kinds | {self.folder: self.bucket()})
        staged.write.mode("overwrite").parquet(self._rows)
        stored = self.spark.read.schema(staged.schema).parquet(self._rows)
        strays = set(self._folders(stored.select(self.folder))) - set(touched)
        if strays:
            raise ValueError(f"rows for folders that were not read: {sorted(strays)[:5]}")
        self.spark.createDataFrame([(k,) for k in touched], "folder int").coalesce(1).write.mode(
            "overwrite").parquet(f"{self._pending}/touched")
        self._replace(touched)
        return stored.drop(self.folder)

    @property
    def _laid_out(self) -> StructType:
        return StructType([*self.schema.fields, StructField(self.folder, IntegerType())])

    @property
    def _rows(self) -> str:
        return f"{self._pending}/rows"

    def _replace(self, touched: list[int]) -> None:
        """Put pending rows in the place of the folders touched; doing it again changes nothing."""
        stored = self.spark.read.schema(self._laid_out).parquet(self._rows)
        self._write(stored, "overwrite")
        for k in set(touched) - set(self._folders(stored.select(self.folder))):
            self._delete(f"{self.path}/{self.folder}={k}")  # nothing is left in it
        self._delete(f"{self._pending}/touched")

    def _write(self, rows: DataFrame, mode: str) -> None:
        """One file or a few per folder; a folder that is too large for one task is split."""
        (rows.hint("rebalance", F.col(self.folder)).write.mode(mode).option("partitionOverwriteMode", "dynamic")
         .partitionBy(self.folder).parquet(self.path))

    def _fs(self, path: str):
        where = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), where

    def _exists(self, path: str) -> bool:
        fs, where = self._fs(path)
        return fs.exists(where)

    def _delete(self, path: str) -> None:
        fs, where = self._fs(path)
        fs.delete(where, True)

    def _check(self) -> None:
        fs, where = self._fs(self.path)
        names = [s.getPath().getName() for s in fs.listStatus(where)] if fs.exists(where) else []
        other = [x for x in names if x.startswith("bucket_of_") and not x.startswith(f"{self.folder}=")]
        if other:
            raise ValueError(f"{self.path} is laid out as {other[0]}, not as {self.folder}")

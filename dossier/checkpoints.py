"""Where frozen intermediate results go."""
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Only where that is unset, as in local tests, a temporary folder is used.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir")
    if named:
        return named
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    folder = tempfile.mkdtemp(prefix="dossier-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def run_folder(spark: SparkSession, name: str) -> str:
    """A new folder of its own under the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


#: Folders of frozen tables that an enclosing :func:`released_after` removes.
_KEPT: list[list[str]] = []


@contextmanager
def released_after(spark: SparkSession) -> Iterator[None]:
    """Remove the tables that were frozen inside, once what comes of them has been written.

    ``with released_after(spark): append_profiles(run_profiles(...).versions, dst)``
    """
    _KEPT.append([])
    try:
        yield
    finally:
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        for folder in _KEPT.pop():
            path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(conf).delete(path, True)


def freeze(df: DataFrame, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` to the shared folder once and go on from the written table.

    Later steps all see the same rows, the lineage ends here, and a lost executor costs a read
    and not a recomputation.  A table rather than ``checkpoint()``, which runs the last stage a
    second time to write it: the stage may hold calls that must not be made twice.
    """
    spark = df.sparkSession
    folder = run_folder(spark, "frozen")
    if _KEPT:
        _KEPT[-1].append(folder)
    writer = df.write.partitionBy(*partition_by) if partition_by else df.write
    writer.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder).select(*df.columns)

"""One file per document, for consumers that want it that way."""
import re
import uuid
from collections.abc import Iterable, Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dossier.checkpoints import freeze
from dossier.filesystems import opener, tasks_open


def write_named_files(docs: DataFrame, folder: str, text: str = "text") -> None:
    """Write each (name, text) row to a file of its own, from the tasks.

    ``folder`` is a path or a URI of a file system that Arrow opens in the tasks (mounted folders,
    ``hdfs`` with its native library, ``s3``, ``gs``); any other is refused.  A name may hold
    sub-folders.  A file is written under a temporary name and moved into place, so a task that
    runs twice leaves one whole file.  NULL texts are empty files.  For paths that only Spark
    opens use :func:`write_documents_by_name`, for large numbers of documents the table forms in
    :mod:`dossier.sinks.writers`.
    """
    open_system = opener(folder)

    def write(rows: Iterable) -> None:
        import uuid

        system, path = open_system()
        made = set()
        for row in rows:
            target = f"{path}/{row['name']}"
            parent = target.rpartition("/")[0]
            if parent not in made:
                system.create_dir(parent, recursive=True)
                made = made | {parent} if len(made) < 1000 else {parent}
            temporary = f"{parent}/.{uuid.uuid4().hex}"
            with system.open_output_stream(temporary) as f:
                f.write((row["text"] or "").encode("utf-8"))
            system.move(temporary, target)

    docs.select("name", docs[text].alias("text")).foreachPartition(write)


def write_documents_by_name(docs: DataFrame, folder: str, text: str = "text") -> None:
    """One file per document in a folder ``name=<name>``, as Spark lays out partitions.

    Works on every path that Spark writes to; a task that runs twice leaves one file, and a write
    that fails leaves none.  Names written before are replaced, others stay.  A file holds the text
    and a line break.  Rows that repeat a name are files of their own beside each other; a NULL
    text is an empty one; NULL and empty names share Spark's default folder and are read as NULL.

    Where tasks can open the folder they stage all files first and then put them in place, in a job of its own.
    Elsewhere Spark's own commit does, which moves one folder after the other in the driver.
    """
    if tasks_open(folder):
        return _stage_and_publish(docs.select("name", docs[text].alias("text")), folder)
    (docs.select("name", docs[text].alias("value")).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").option("maxRecordsPerFile", 1)
     .partitionBy("name").text(folder))


# Fixed value: what Spark escapes in the name of a partition's folder.
ESCAPED = "[\x01-\x1f\x7f\"#%'*/:=?\\\\{\\[\\]^]"


def _stage_and_publish(docs: DataFrame, folder: str) -> None:
    """Two jobs of the tasks: every (name, text) row to a file under a hidden folder, then each name's files to its own."""
    open_system, stage, escaped = opener(folder), f".staging-{uuid.uuid4().hex}", re.compile(ESCAPED)

    def write(batches: Iterator) -> Iterator:
        import uuid

        import pyarrow as pa

        system, path = open_system()
        part = f"{path}/{stage}/{uuid.uuid4().hex}"
        system.create_dir(part, recursive=True)
        for batch in batches:
            targets, staged = [], []
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                shown = escaped.sub(lambda c: f"%{ord(c[0]):02X}", name) if name else "__HIVE_DEFAULT_PARTITION__"
                targets.append(f"{path}/name={shown}")
                staged.append(f"{part}/part-{uuid.uuid4().hex}.txt")
                with system.open_output_stream(staged[-1]) as f:
                    f.write((text or "").encode("utf-8") + b"\n")
            yield pa.RecordBatch.from_arrays([pa.array(targets, pa.string()), pa.array(staged, pa.string())], ["target", "staged"])

    def publish(rows: Iterable) -> None:
        system, _ = open_system()
        for row in rows:
            system.create_dir(row["target"], recursive=True)
            system.delete_dir_contents(row["target"])
            for staged in row["staged"]:
                system.move(staged, row["target"] + "/" + staged.rpartition("/")[2])

    system, path = open_system()
    system.create_dir(f"{path}/{stage}", recursive=True)
    try:
        # a job that fails ends here, with no document touched; the files of a task that ran twice are moved once
        width = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        # texts are not dealt anew: only paths are shuffled, so that one task has all files of a name
        written = freeze(docs.mapInArrow(write, "target STRING, staged STRING"))
        written.repartition(width, "target").groupBy("target").agg(F.collect_list("staged").alias("staged")).foreachPartition(publish)
    finally:
        system.delete_dir(f"{path}/{stage}")

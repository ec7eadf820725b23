"""File sources: documents, summaries, context corpus, catalogue, legacy log."""
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dossier.filesystems import opener, tasks_open
from dossier.functions.text import contact_from_name, id_from_name, strip, whole_json


#: Names and bytes that a task hands on together.
BATCH_NAMES, BATCH_BYTES = 5_000, 8 << 20


def _entries(spark: SparkSession, folder: str, ending: str) -> DataFrame:
    """(path, length, modificationTime) of the files below a folder that tasks can open.

    One task lists the folder, then tasks list its sub-folders; as in Spark's own sources, names
    that begin with ``.`` or ``_`` are hidden.
    """
    open_system = opener(folder)
    width, size, marker = int(spark.conf.get("spark.sql.shuffle.partitions")), BATCH_NAMES, "path STRING, is_folder BOOLEAN, "

    def rows(recursive: bool):
        def run(batches: Iterator) -> Iterator:
            import os

            import pyarrow as pa
            from pyarrow import fs

            system, root = open_system()
            root = root.rstrip("/")

            def local(path: str) -> Iterator[tuple]:
                with os.scandir(path) as found:
                    for e in found:
                        if e.name[0] in "._":
                            continue
                        if e.is_dir():
                            yield (e.path, True, None, None)
                        else:
                            s = e.stat()
                            yield (e.path, False, s.st_size, s.st_mtime_ns // 1000)

            def remote(path: str) -> Iterator[tuple]:
                for e in system.get_file_info(fs.FileSelector(path)):
                    if e.base_name[0] not in "._":
                        plain = e.type == fs.FileType.File
                        yield (e.path, not plain, e.size if plain else None, (e.mtime_ns or 0) // 1000 if plain else None)

            listed = local if isinstance(system, fs.LocalFileSystem) else remote

            def walk(path: str) -> Iterator[tuple]:
                for e in listed(path):
                    if recursive and e[1]:
                        yield from walk(e[0])
                    else:
                        yield e

            def found() -> Iterator[tuple]:
                for batch in batches:
                    if not recursive:
                        yield from (e for _ in range(batch.num_rows) for e in walk(root))
                        continue
                    for row in zip(*(batch.column(i).to_pylist() for i in range(4))):
                        if row[1]:
                            yield from walk(row[0])
                        else:
                            yield row

            def packed(part: list[tuple]) -> pa.RecordBatch:
                kinds = (pa.string(), pa.bool_(), pa.int64(), pa.int64())
                return pa.RecordBatch.from_arrays([pa.array([r[i] for r in part], t) for i, t in enumerate(kinds)],
                                                  ["path", "is_folder", "length", "micros"])

            part = []
            for e in found():
                if e[1] or e[0].endswith(ending):
                    part.append(e)
                if len(part) == size:
                    yield packed(part)
                    part = []
            if part:
                yield packed(part)

        return run

    schema = marker + "length BIGINT, micros BIGINT"
    top = spark.range(0, 1, 1, 1).mapInArrow(rows(False), schema)
    return top.repartition(width).mapInArrow(rows(True), schema).select(
        "path", "length", F.timestamp_micros("micros").alias("modificationTime"))


def _whole(spark: SparkSession, folder: str, ending: str) -> DataFrame:
    """(path, name, content) of the files below a folder whose names have the ending.

    Tasks list and open the files themselves where they can: Spark's file index holds every file
    in the driver, and its readers take far longer to open a small file than to read it.
    """
    if not tasks_open(folder):
        return (spark.read.option("pathGlobFilter", f"*{ending}").option("recursiveFileLookup", "true")
                .text(folder, wholetext=True)
                .select(F.col("_metadata.file_path").alias("path"),
                        F.col("_metadata.file_name").alias("name"), F.col("value").alias("content")))
    open_system, names, room = opener(folder), BATCH_NAMES, BATCH_BYTES

    def read(batches: Iterator) -> Iterator:
        import pyarrow as pa

        system, _ = open_system()
        paths, texts, held = [], [], 0

        def packed() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(texts, pa.binary())], ["path", "content"])

        for batch in batches:
            for path in batch.column(0).to_pylist():
                with system.open_input_file(path) as f:
                    texts.append(f.read())
                paths.append(path)
                held += len(texts[-1])
                if len(paths) == names or held >= room:
                    yield packed()
                    paths, texts, held = [], [], 0
        if paths:
            yield packed()

    found = _entries(spark, folder, ending).select("path").mapInArrow(read, "path STRING, content BINARY")
    return found.select("path", _name(F.col("path")).alias("name"), F.col("content").cast("string").alias("content"))


def _name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def read_documents_by_name(spark: SparkSession, folder: str, by_tasks: bool = False) -> DataFrame:
    """(name, text) of documents that ``write_documents_by_name`` wrote; a filter on names opens only their files.

    Spark's index of the folders is made and held in the driver.  To read all of many documents give ``by_tasks``:
    tasks list the folders and open the files where they can, and a filter on names comes after.
    """
    if by_tasks and tasks_open(folder):
        found = _whole(spark, folder, "")
        shown = F.substring_index(F.element_at(F.split("path", "/"), -2), "name=", -1)
        name = F.when(shown != "__HIVE_DEFAULT_PARTITION__", _unescaped(shown))
        stored = found.select(F.col("content").alias("value"), name.alias("name"))
    else:
        stored = spark.read.schema("value STRING, name STRING").text(folder, wholetext=True)
    return stored.select("name", F.regexp_replace("value", r"\n\z", "").alias("text"))


def _unescaped(shown: Column) -> Column:
    """A partition's value from the name of its folder, where Spark puts ``%`` and two digits for some characters."""
    def plain(x: Column) -> Column:
        code = F.conv(F.left(x, F.lit(2)), 16, 10).cast("int")
        return F.when(x.rlike("^[0-9A-Fa-f]{2}"), F.concat(F.char(code), F.substring(x, F.lit(3), F.length(x)))).otherwise(
            F.concat(F.lit("%"), x))

    parts = F.split(shown, "%")
    return F.concat(F.get(parts, F.lit(0)), F.array_join(F.transform(F.slice(parts, F.lit(2), F.size(parts)), plain), ""))


def read_profile_json(spark: SparkSession, folder: str) -> DataFrame:
    """One document per file; bad JSON keeps its row and gets ``doc_error``."""
    docs = _whole(spark, folder, ".json").withColumnRenamed("content", "doc")
    bad = whole_json(F.col("doc")).isNull()
    return docs.withColumn("doc_error", F.when(bad, F.lit("Invalid JSON")))


def split_front_matter(content: Column) -> tuple[Column, Column]:
    """Front matter and stripped body of a summary text."""
    parts = F.split(content, "---\n", 3)
    has = content.startswith("---\n") & (F.size(parts) >= 3)
    return (F.when(has, F.element_at(parts, 2)).otherwise(F.lit("")),
            strip(F.when(has, F.element_at(parts, 3)).otherwise(content)))


def read_summaries(spark: SparkSession, folder: str) -> DataFrame:
    """Markdown summaries as front matter and body."""
    front, body = split_front_matter(F.col("content"))
    return _whole(spark, folder, ".md").select(
        "path", "name", front.alias("front_matter"), body.alias("body"))


def _listed(spark: SparkSession, folder: str, ending: str) -> DataFrame:
    """(path, length, modificationTime) of the files below a folder; none is opened."""
    if tasks_open(folder):
        return _entries(spark, folder, ending)
    return (spark.read.format("binaryFile").option("pathGlobFilter", f"*{ending}")
            .option("recursiveFileLookup", "true").load(folder)
            .select("path", "length", "modificationTime"))


def list_summaries(spark: SparkSession, folder: str) -> DataFrame:
    """Name, size, time and the ids in the name of each summary, without its content."""
    files, name = _listed(spark, folder, ".md"), _name(F.col("path"))
    return files.select(
        "path", name.alias("name"), "length", "modificationTime",
        contact_from_name(F.regexp_replace(name, r"\.md$", "")).alias("contact_id"),
        id_from_name(name).alias("eni_id"))


def files_newest(files: DataFrame) -> DataFrame:
    """Newest first."""
    return files.orderBy(F.desc("modificationTime"), "path")


def read_context(spark: SparkSession, folder: str) -> DataFrame:
    """Context texts; the folder is the type, the file name the subtype."""
    return _whole(spark, folder, ".md").select(
        *_context_keys(), "path", "content", F.octet_length("content").cast("long").alias("length"))


def list_context(spark: SparkSession, folder: str) -> DataFrame:
    """Type, subtype, path and length of the context texts, without opening them."""
    return _listed(spark, folder, ".md").select(*_context_keys(), "path", "length")


def _context_keys() -> list[Column]:
    path = F.col("path")
    return [F.element_at(F.split(path, "/"), -2).alias("type"), F.regexp_replace(_name(path), r"\.md$", "").alias("subtype")]


def available_subtypes(context: DataFrame) -> DataFrame:
    """Sorted subtypes per type."""
    return context.select("type", "subtype").distinct().groupBy("type").agg(
        F.array_sort(F.collect_list("subtype")).alias("subtypes"))


def read_catalog(spark: SparkSession, src: str) -> DataFrame:
    """Catalogue of source types; an empty subtype is NULL."""
    return (spark.read.schema("eni_source_type STRING, eni_source_subtype STRING")
            .csv(src, header=True))


def read_legacy_log(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """Rows of a JSON map contact -> ids per file; an empty or broken file gives no rows.

    With ``lines`` every line is a map, so that a log of any size can be split.
    """
    return legacy_rows(spark.read.text(path, wholetext=not lines), "value")


def legacy_rows(df: DataFrame, doc: str) -> DataFrame:
    """The (contact, id) rows of legacy documents held in a column."""
    ids = F.from_json(F.col(doc), "MAP<STRING, ARRAY<STRING>>")
    return (df.select(F.explode(ids).alias("contact_id", "ids"))
            .select("contact_id", F.explode("ids").alias("eni_id")))

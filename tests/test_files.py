"""One file per document: exact texts, replaced names, failed writes, other file systems."""
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from dossier.sinks.files import write_documents_by_name, write_named_files
from dossier.sources import files as sources
from dossier.sources.files import read_documents_by_name

DOCS = [("a.md", "one\n\n"), ("b/c=d %.md", "\r\n two"), ("007", ""), ("e.md", None), ("ä.md", "x" * 100_000),
        ("twice", "1\n"), ("twice", "2")]


def docs(spark, rows):
    return spark.createDataFrame(rows, "name string, text string").repartition(3)


def stored(spark, folder):
    return sorted((r.name or "", r.text) for r in read_documents_by_name(spark, str(folder)).collect())


def test_texts_by_name_come_back_as_they_were(spark, tmp_path):
    write_documents_by_name(docs(spark, DOCS), f"{tmp_path}/d")
    assert stored(spark, tmp_path / "d") == sorted((n, t or "") for n, t in DOCS)


def test_written_names_are_replaced_and_others_stay(spark, tmp_path):
    write_documents_by_name(docs(spark, DOCS), f"{tmp_path}/d")
    write_documents_by_name(docs(spark, [("twice", "3"), ("new", "4")]), f"{tmp_path}/d")
    want = [(n, t or "") for n, t in DOCS if n != "twice"] + [("twice", "3"), ("new", "4")]
    assert stored(spark, tmp_path / "d") == sorted(want)


def test_a_failed_write_changes_no_document(spark, tmp_path):
    write_documents_by_name(docs(spark, [("a", "old"), ("b", "old")]), f"{tmp_path}/d")
    broken = docs(spark, [("a", "new"), ("b", "new")]).withColumn(
        "text", F.when(F.col("name") == "b", F.raise_error(F.lit("lost"))).otherwise(F.col("text")))
    with pytest.raises(Exception, match="lost"):
        write_documents_by_name(broken, f"{tmp_path}/d")
    assert stored(spark, tmp_path / "d") == [("a", "old"), ("b", "old")]


def test_a_name_is_found_by_its_folder(spark, tmp_path):
    write_documents_by_name(docs(spark, DOCS), f"{tmp_path}/d")
    one = read_documents_by_name(spark, f"{tmp_path}/d").filter("name = '007'")
    assert "PartitionFilters: [isnotnull(name" in one._jdf.queryExecution().executedPlan().toString()
    assert one.count() == 1


@pytest.mark.parametrize("prefix", ["", "file:", "file://"])
def test_named_files_through_the_file_system_of_the_path(spark, tmp_path, prefix):
    rows = [("s/a.md", "one\n"), ("b.md", None)]
    write_named_files(docs(spark, rows), f"{prefix}{tmp_path}/f")
    found = {str(p.relative_to(tmp_path / "f")): p.read_bytes().decode() for p in Path(tmp_path, "f").rglob("*") if p.is_file()}
    assert found == {"s/a.md": "one\n", "b.md": ""}


def test_a_file_system_that_tasks_cannot_open_is_refused(spark, tmp_path):
    with pytest.raises(Exception, match="nowhere"):
        write_named_files(docs(spark, [("a", "b")]), "nowhere://host/folder")


def test_tasks_list_and_read_files(spark, tmp_path):
    """Files of sub-folders and with odd names and bytes are read, hidden ones and other endings are not; no index of them is made."""
    found = {"a.md": b"one", "view/b c%.md": b"\r\n", "view/deep/d.md": b"", "view/deep/e.md": b"\xff\x00"}
    for name, text in {**found, ".f.md": b"x", "_g/h.md": b"x", "view/i.json": b"x"}.items():
        path = tmp_path / "f" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(text)
    folder = str(tmp_path / "f")
    df = sources.read_context(spark, folder)
    assert "FileScan" not in df._jdf.queryExecution().executedPlan().toString()
    got = {r["path"].removeprefix(folder + "/"): (r["type"], r["subtype"], bytes(r["b"]), r["length"])
           for r in df.withColumn("b", F.col("content").cast("binary")).collect()}
    assert got == {n: (("f/" + n).split("/")[-2], n.split("/")[-1][:-3], t, len(t)) for n, t in found.items()}
    listed = {(r["path"].removeprefix(folder + "/"), r["length"]) for r in sources.list_context(spark, folder).collect()}
    assert listed == {(n, len(t)) for n, t in found.items()}


def test_a_document_is_staged_and_moved(spark, tmp_path):
    """Nothing but the folders of the documents is left of a write: no staged file, no marker, no checksum."""
    write_documents_by_name(docs(spark, DOCS), f"{tmp_path}/d")
    assert sorted(p.name for p in (tmp_path / "d").iterdir()) == sorted(
        ["name=a.md", "name=b%2Fc%3Dd %25.md", "name=007", "name=e.md", "name=ä.md", "name=twice"])


@pytest.mark.parametrize("write", [
    write_documents_by_name,
    lambda df, folder: df.withColumnRenamed("text", "value").write.option("maxRecordsPerFile", 1).partitionBy("name").text(folder)], ids=["tasks", "spark"])
def test_tasks_read_all_documents_by_name(spark, tmp_path, write):
    """The same rows as by Spark's index, without one: odd, missing and repeated names, texts of several lines."""
    rows = DOCS + [("%41", "p"), ("50 %", "q"), ("a+b c", "r"), ("x=name=y", "s"), ("[^]{'\"#*?\\:}", "t"), (None, "u"), ("", "v")]
    write(docs(spark, [(n, t or "") for n, t in rows]), f"{tmp_path}/d")
    df = read_documents_by_name(spark, f"{tmp_path}/d", by_tasks=True)
    assert "FileScan" not in df._jdf.queryExecution().executedPlan().toString()
    got = sorted((r.name or "", r.text) for r in df.collect())
    assert got == sorted((n or "", t or "") for n, t in rows)
    assert got == stored(spark, tmp_path / "d")
    assert df.filter("name IS NULL").count() == 2

"""Bucketed tables join without a shuffle; changes in part keep other folders and survive stops."""
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from checks.layouts import bucketed
from dossier.operators import selection, versions
from dossier.sinks.layouts import BucketFolders

OLD = "contact_id string, eni_id string, version int, text string"
NEW = "contact_id string, eni_id string, ord int, text string"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_neither_side_of_the_anti_join_is_shuffled(spark, no_broadcast):
    notes = bucketed(spark.range(2000).selectExpr("concat('E', id) AS eni_id", "'C' AS contact_id"), ["eni_id"])
    log = bucketed(spark.range(3000).selectExpr("concat('E', id % 500) AS eni_id", "'completed' AS processing_status"), ["eni_id"])
    left = selection.unprocessed(notes, log)
    assert "Exchange" not in plan(left) and "LeftAnti" in plan(left)
    assert left.count() == 1500


def test_the_stored_side_of_matches_and_merges_is_not_shuffled(spark, no_broadcast):
    pairs = spark.range(1000).selectExpr("concat('C', id % 7) AS contact_id", "concat('E', id) AS eni_id")
    old, seen = bucketed(pairs, ["contact_id", "eni_id"]), bucketed(pairs.limit(300), ["contact_id", "eni_id"])
    merged = versions.merge_processed(seen, old)
    assert "Exchange" not in plan(merged) and merged.count() == 1000
    matched = versions.match_existing(pairs.withColumn("ord", F.lit(1)), old)
    assert plan(matched).count("Exchange") == 1 and matched.filter("is_existing").count() == 1000


def table(spark, tmp_path, rows, keys=("contact_id", "eni_id"), n=8) -> BucketFolders:
    df = spark.createDataFrame(rows, OLD)
    t = BucketFolders(spark, f"{tmp_path}/t", df.schema, keys, n)
    t.create(df)
    return t


def files(t: BucketFolders) -> dict[str, set[str]]:
    found: dict[str, set[str]] = {}
    for p in Path(t.path).rglob("*.parquet"):
        found.setdefault(p.parent.name, set()).add(p.name)
    return found


ROWS = [(f"C{i % 5}", f"E{i}", 1, "a") for i in range(60)] + [("C1", None, 1, "a"), (None, "E1", 1, "a")]


def sorted_rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_an_upsert_keeps_the_files_of_other_folders(spark, tmp_path):
    t = table(spark, tmp_path, ROWS)
    before = files(t)
    new = spark.createDataFrame([("C3", "E3", 1, "b"), ("C9", None, 2, "c")], NEW)
    want = sorted_rows(versions.upsert(new, t.read()).drop("action"))
    written = t.upsert(new)
    assert sorted(r.action for r in written.collect()) == ["created", "updated"]
    assert sorted_rows(t.read()) == want
    touched = {f"{t.folder}={k}" for k in t._folders(new.select(t.bucket()))}
    after = files(t)
    assert len(touched) < len(before) and {k for k in after if after[k] != before.get(k)} == touched


def test_a_table_of_a_wider_type_takes_the_values_of_an_upsert(spark, tmp_path):
    df = spark.createDataFrame([("C", "E", 1, "a")], OLD.replace("int", "bigint"))
    t = BucketFolders(spark, f"{tmp_path}/t", df.schema, ("contact_id",), 4)
    t.create(df)
    t.upsert(spark.createDataFrame([("C", "E", 1, "b")], NEW))
    assert t.read().schema == df.schema and sorted_rows(t.read()) == [("C", "E", 2, "b")]


def test_a_delete_that_empties_folders_and_one_by_another_column(spark, tmp_path):
    t = table(spark, tmp_path, ROWS, ("contact_id",))
    t.delete(spark.createDataFrame([("C1",), (None,), ("C1",)], "contact_id string"), "contact_id")
    assert sorted_rows(t.read()) == sorted([r for r in ROWS if r[0] != "C1"], key=repr)
    t.delete(spark.createDataFrame([("E1",), ("E7",)], "eni_id string"), "eni_id")
    left = [r for r in ROWS if r[0] != "C1" and r[1] not in ("E1", "E7")]
    assert sorted_rows(t.read()) == sorted(left, key=repr)
    t.delete(spark.createDataFrame([], "contact_id string"), "contact_id")
    t.clear("C2")
    assert sorted_rows(t.read()) == sorted([r for r in left if r[0] != "C2"], key=repr)
    t.clear()
    assert t.read().count() == 0
    t.upsert(spark.createDataFrame([("C1", "E1", 1, "z")], NEW))
    assert sorted_rows(t.read()) == [("C1", "E1", 1, "z")]


def test_a_change_that_fails_leaves_the_table_as_it_was(spark, tmp_path):
    t = table(spark, tmp_path, ROWS)
    before = files(t)
    new = spark.createDataFrame([("C3", "E3", 1, "b")], NEW)
    broken = new.withColumn("text", F.when(F.col("ord") > 0, F.raise_error(F.lit("lost"))).otherwise(F.col("text")))
    with pytest.raises(Exception, match="lost"):
        t.upsert(broken)
    assert files(t) == before
    t.upsert(new)
    assert [r for r in t.read().collect() if r.text == "b"]


@pytest.mark.parametrize("replaced", [False, True])
def test_a_change_that_stops_while_folders_are_replaced_is_finished_once(spark, tmp_path, monkeypatch, replaced):
    t = table(spark, tmp_path, ROWS, ("contact_id",))
    new = spark.createDataFrame([("C3", "E3", 1, "b")], NEW)
    want = sorted_rows(versions.upsert(new, t.read()).drop("action"))
    write = BucketFolders._write

    def stop(self, rows, mode):
        if replaced:
            write(self, rows, mode)
        raise RuntimeError("stopped")

    monkeypatch.setattr(BucketFolders, "_write", stop)
    with pytest.raises(RuntimeError, match="stopped"):
        t.upsert(new)
    monkeypatch.setattr(BucketFolders, "_write", write)
    t.finish()
    assert sorted_rows(t.read()) == want
    t.delete(spark.createDataFrame([("C3",)], "contact_id string"), "contact_id")
    assert sorted_rows(t.read()) == sorted([r for r in want if r[0] != "C3"], key=repr)


def test_another_number_of_folders_is_refused(spark, tmp_path):
    t = table(spark, tmp_path, ROWS)
    with pytest.raises(ValueError, match="laid out as"):
        BucketFolders(spark, t.path, t.schema, t.keys, 4).read()


def test_only_touched_folders_are_read(spark, tmp_path):
    t = table(spark, tmp_path, ROWS)
    p = t.read([2, 3])._jdf.queryExecution().executedPlan().toString()
    assert f"PartitionFilters: [isnotnull({t.folder}" in p or f"PartitionFilters: [{t.folder}" in p

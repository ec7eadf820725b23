"""Positions and numbers within hot keys."""
import random

from pyspark.sql import functions as F

from dossier.operators import ordering, selection


def test_position_is_a_global_row_number(spark):
    rnd = random.Random(1)
    values = [(rnd.randrange(50), i) for i in range(5000)]
    df = spark.createDataFrame(values, "a INT, b INT").repartition(7)
    got = {(r["a"], r["b"]): r["pos"] for r in
           ordering.with_position(df, [F.desc("a"), F.asc("b")]).collect()}
    for pos, key in enumerate(sorted(values, key=lambda v: (-v[0], v[1])), 1):
        assert got[key] == pos


def test_number_within_a_hot_key(spark):
    rnd = random.Random(2)
    rows = [("hot" if i % 3 else f"k{i % 11}", n) for i, n in enumerate(rnd.sample(range(10**6), 4000))]
    df = spark.createDataFrame(rows, "k STRING, ord LONG")
    got = {(r["k"], r["ord"]): r["n"] for r in ordering.number_within(df, ["k"], "ord", "n").collect()}
    for key in {k for k, _ in rows}:
        for n, o in enumerate(sorted(o for k, o in rows if k == key), 1):
            assert got[(key, o)] == n


def test_page_without_limit(spark):
    df = spark.range(1000).orderBy(F.desc("id"))
    assert sorted(r["id"] for r in selection.page(df, None, 990).collect()) == list(range(10))


def test_waves_cover_the_selection_once(spark):
    df = spark.createDataFrame([(f"c{i}", None) for i in range(45)], "contact_id STRING, last_processed_at TIMESTAMP")
    sizes = {r["wave"]: r["count"] for r in selection.waves(selection.selection_order(df), 20).groupBy("wave").count().collect()}
    assert sizes == {0: 20, 1: 20, 2: 5}


def test_selected_contacts_keep_their_first_place(spark):
    spark.createDataFrame([("a", 3), ("b", 1), ("a", 2), ("", 4), (None, 5)], "contact_id STRING, o INT").createOrReplaceTempView("sel")
    sql = "SELECT contact_id FROM sel WHERE o > CAST(:generator AS INT) ORDER BY o"
    got = selection.select_contacts_sql(spark, sql, {"generator": "0"}).orderBy("pos").collect()
    assert [r["contact_id"] for r in got] == ["b", "a"]
    got = selection.select_contacts_sql(spark, sql + " LIMIT 1", {"generator": "0"}, limit=2).collect()
    assert [r["contact_id"] for r in got] == ["b"]


def test_a_page_is_of_all_contacts_with_notes(spark):
    """Contacts that no run has seen are in the page and in the rest, beside those of the log."""
    from checks import load
    sf = "/root/testdata/sf0.01"
    parts = load()[0]["o3_page"](spark, sf).groupBy("part").count().collect()
    notes = spark.read.parquet(f"{sf}/events.parquet").filter("event_id % 11 > 1").select("user_id").distinct().count()
    found = {r["part"]: r["count"] for r in parts}
    assert (found["page"], found["rest"]) == (30, notes - 45)
    assert found["log page"] == 30 and found["log rest"] > 0

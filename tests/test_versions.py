"""Versions, upserts and merges."""


from dossier.operators import generation, versions

OLD = "contact_id STRING, eni_id STRING, version INT, personal STRING, deals STRING"
NEW = "contact_id STRING, eni_id STRING, ord INT, personal STRING"


def test_versions_are_contiguous_and_one_is_latest(spark):
    old = spark.createDataFrame([("a", "g", 1), ("a", "g", 2), ("b", "g", 1)], "contact_id STRING, generator STRING, version INT")
    new = spark.createDataFrame([("a", "g", 7), ("a", "g", 3), ("c", "g", 1), ("c", "h", 1)],
                                "contact_id STRING, generator STRING, ord INT")
    table = versions.append_versions(new, old)
    rows = versions.with_latest(table).collect()
    for key in {(r["contact_id"], r["generator"]) for r in rows}:
        mine = [r for r in rows if (r["contact_id"], r["generator"]) == key]
        assert sorted(r["version"] for r in mine) == list(range(1, len(mine) + 1))
        assert [r["version"] for r in mine if r["is_latest"]] == [len(mine)]
    assert {(r["contact_id"], r["version"]) for r in versions.latest_versions(table, "g").collect()} == {("a", 4), ("b", 1), ("c", 1)}


def test_upsert(spark):
    old = spark.createDataFrame([("a", "1", 3, "p", "d"), ("b", "1", 1, "p", "d"), ("c", None, 1, "p", "d")], OLD)
    new = spark.createDataFrame([("a", "1", 1, "x"), ("a", "1", 2, None), ("z", None, 1, "n"), ("c", None, 1, "n")], NEW)
    got = {(r["contact_id"], r["eni_id"], r["action"]): (r["version"], r["personal"], r["deals"])
           for r in versions.upsert(new, old).collect()}
    assert got == {("a", "1", "updated"): (5, "x", "d"), ("b", "1", "kept"): (1, "p", "d"), ("c", None, "kept"): (1, "p", "d"),
                   ("z", None, "created"): (1, "n", None), ("c", None, "created"): (1, "n", None)}


def test_forced_migration_updates(spark):
    docs = spark.createDataFrame([(1, '{"contact_id": "CNT-000001", "eni_id": "E", "insights": {"personal": "new"}}')], "ord INT, doc STRING")
    old = versions.upsert(versions.split_records(docs)[0], spark.createDataFrame(
        [], "contact_id STRING, eni_id STRING, version INT, member_name STRING")).drop("action")
    table, report = versions.migrate(docs, old)
    assert [r["outcome"] for r in report.collect()] == ["skipped"]
    table, report = versions.migrate(docs, old, force=True)
    assert [r["outcome"] for r in report.collect()] == ["migrated"]
    assert [(r["version"], r["action"]) for r in table.collect()] == [(2, "updated")]


EXISTING = [("a", "personal", "- one\n  * [N/A,E1,t]\n- two\n  * [N/A,E2,t]"), ("b", "deals", None)]
BULLETS = [("a", "personal", 1, "-  ONE\n  * [N/A,E1,t]\n"), ("a", "personal", 2, "- one\n  * [N/A,E9,t]\n"),
           ("a", "personal", 3, "- one\n  * [N/A,E9,t]\n"), ("b", "deals", 1, "- x\n  * [N/A,E3,t]\n"),
           ("c", "deals", 1, "- y\n")]


def frames(spark):
    return (spark.createDataFrame(EXISTING, "contact_id STRING, section STRING, text STRING"),
            spark.createDataFrame(BULLETS, "contact_id STRING, section STRING, ord INT, bullet STRING"))


def test_append_merge_keeps_and_appends(spark):
    old, new = frames(spark)
    got = {(r["contact_id"], r["section"]): r["text"] for r in generation.append_merge(old, new).collect()}
    assert got[("a", "personal")] == EXISTING[0][2] + "\n- one\n  * [N/A,E9,t]\n"
    assert got[("b", "deals")] == "- x\n  * [N/A,E3,t]\n"
    assert got[("c", "deals")] == "- y\n"


def test_append_merge_is_idempotent(spark):
    old, new = frames(spark)
    once = generation.append_merge(old, new)
    twice = generation.append_merge(once, new)
    assert sorted(once.collect()) == sorted(twice.collect())


def test_nothing_new_leaves_the_text_as_it_is(spark):
    old, new = frames(spark)
    got = generation.append_merge(old, new.filter("contact_id = 'none'")).collect()
    assert {r["text"] for r in got} == {t for _, _, t in EXISTING}


def test_backfill_does_not_repeat(spark):
    df = spark.createDataFrame([("x", ["x"]), ("y", None), (None, ["z"])], "one STRING, many ARRAY<STRING>")
    got = [r["many"] for r in versions.backfill_arrays(df, {"one": "many"}).collect()]
    assert got == [["x"], ["y"], ["z"]]


def test_clear_log_keeps_rows_without_a_contact(spark):
    log = spark.createDataFrame([("a",), (None,), ("b",)], "contact_id STRING")
    assert versions.clear_log(log, "a").count() == 2
    assert versions.clear_log(log).count() == 0

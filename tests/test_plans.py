"""What the physical plans must and must not hold."""
import re

import pytest
from pyspark.sql import functions as F

import checks
from checks.bindings import RULE_MAP
from dossier.operators import selection
from dossier.operators.rules import rule_filter, rules_frame
from dossier.plans.preparation import pending_notes
from dossier.schemas import NOTES, RUN_LOG

SF_DIR = "/root/testdata/sf0.001"
# queries that start jobs while they are built are looked at through their last plan only
QUERIES = checks.load()[0]


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if not n.startswith(("t1", "t2", "t3_stream", "x4_profile"))))
def test_no_query_multiplies_rows_or_gathers_a_window(spark, name):
    p = plan(QUERIES[name](spark, SF_DIR))
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p
    # a window without a partition key runs in one task; only that over one row per partition may
    single = [w for w in re.findall(r"Window \[([^\n]*)", p)
              if re.search(r"windowspecdefinition\(\w+#\d+L? (ASC|DESC)", w)]
    assert all("_part" in w for w in single), single
    assert "PythonUDF" not in p or name.startswith("x")


@pytest.fixture
def stored(spark, tmp_path):
    notes = spark.range(1000).select(
        F.concat(F.lit("E"), "id").alias("eni_id"), F.lit("CNT-000001").alias("contact_id"),
        F.lit("click").alias("eni_source_type"), F.lit(None).cast("string").alias("eni_source_subtype"),
        F.lit("x").alias("description"), F.lit(None).cast("date").alias("logged_date"))
    notes.write.parquet(f"{tmp_path}/notes")
    spark.createDataFrame([], RUN_LOG).write.parquet(f"{tmp_path}/log")
    return (spark.read.schema(NOTES).parquet(f"{tmp_path}/notes"), spark.read.schema(RUN_LOG).parquet(f"{tmp_path}/log"))


def test_filters_and_columns_reach_the_scan(spark, stored):
    notes, log = stored
    p = plan(selection.by_type(notes, "click", "null").select("eni_id"))
    assert "EqualTo(eni_source_type,click)" in p and "IsNull(eni_source_subtype)" in p
    assert "description" not in p
    p = plan(pending_notes(notes, log, rules_frame(spark, RULE_MAP), list(RULE_MAP)).select("eni_id"))
    assert "In(eni_source_type" in p and "logged_date" not in p
    assert "EqualTo(processing_status,completed)" in p and "processor_version" not in p


def test_rules_are_the_broadcast_side(spark, stored):
    notes, _ = stored
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        p = plan(rule_filter(notes, rules_frame(spark, RULE_MAP)))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert re.search(r"BroadcastHashJoin[^\n]*LeftSemi, BuildRight", p) and "LocalTableScan" in p


def test_anti_join_is_used(spark, stored):
    assert "LeftAnti" in plan(selection.unprocessed(*stored))

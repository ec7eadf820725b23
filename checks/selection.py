"""Scans, predicates, joins, counts, orders (S1-S3, S8, S11, P*, J1-J3, A1-A3, W4, W6, W7, O*, U1)."""
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks.bindings import RULE_MAP, frame
from checks.registry import SECTIONS, check
from dossier.checkpoints import run_folder
from dossier.operators import ordering, rules, selection
from dossier.operators.versions import profile_count, profile_filter
from dossier.sinks.writers import append_profiles
from dossier.sources.tables import read_notes, read_profiles, read_run_log, read_table

DAY = "CAST(logged_date AS varchar) AS logged_date"
CUTOFF = datetime(1999, 6, 1)
CUTOFF_SQL = "TIMESTAMP '1999-06-01 00:00:00'"
LATEST = """last AS (SELECT contact_id, max(processed_at) AS seen_at FROM run_log WHERE processing_status = 'completed'
  AND processor_system_prompt_key = 'structured_insight' AND processor_generator = 'structured_insight' GROUP BY contact_id),
cl AS (SELECT c.contact_id, l.seen_at FROM (SELECT DISTINCT contact_id FROM notes
  WHERE regexp_matches(description, '\\S') AND contact_id IS NOT NULL) c
  LEFT JOIN last l ON l.contact_id = c.contact_id)"""


def stamp(c: str) -> F.Column:
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


def stamp_sql(c: str) -> str:
    return f"strftime({c}, '%Y-%m-%d %H:%M:%S')"


def noted(df):
    return df.withColumn("logged_date", F.col("logged_date").cast("string"))


def last_seen(spark, sf):
    return selection.contact_last_processed(frame(spark, sf, "notes"), frame(spark, sf, "run_log"), "structured_insight")


def with_sources(df):
    return df.withColumns({"eni_source_types": F.array("source_type"),
                           "eni_source_subtypes": F.array("source_subtype")})


@check("s1_read_notes", "notes",
       f"SELECT eni_id, contact_id, eni_source_type, eni_source_subtype, description, {DAY} FROM notes")
def s1(spark, sf):
    """S1"""
    dst = run_folder(spark, "notes")
    frame(spark, sf, "notes").write.parquet(dst)
    return noted(read_notes(spark, dst))


@check("s2_read_run_log", "run_log",
       f"SELECT eni_id, contact_id, {stamp_sql('processed_at')} AS processed_at, processing_status, "
       "processing_duration_ms FROM run_log")
def s2(spark, sf):
    """S2"""
    dst = run_folder(spark, "log")
    frame(spark, sf, "run_log").write.parquet(dst)
    return read_run_log(spark, dst).select(
        "eni_id", "contact_id", stamp("processed_at").alias("processed_at"),
        "processing_status", "processing_duration_ms")


@check("s2_declared_schema_scan", "",
       "SELECT o_orderkey, o_orderstatus FROM orders")
def s2b(spark, sf):
    """A declared schema of two columns is all the scan reads."""
    from pyspark.sql.types import LongType, StringType, StructField, StructType
    schema = StructType([StructField("o_orderkey", LongType()),
                         StructField("o_orderstatus", StringType())])
    return read_table(spark, f"{sf}/orders.parquet", schema)


@check("s3_read_profiles", "profiles",
       f"SELECT contact_id, version, {stamp_sql('updated_at')} AS updated_at FROM profiles "
       "WHERE processing_status = 'completed' AND source_type IN ('click', 'view') "
       "ORDER BY profiles.updated_at DESC, contact_id, generator, version LIMIT 50 OFFSET 20")
def s3(spark, sf):
    """S3"""
    dst = run_folder(spark, "profiles")
    df = with_sources(frame(spark, sf, "profiles")).withColumn("sections", F.struct(*SECTIONS))
    append_profiles(df, dst)
    out = read_profiles(spark, dst, source_types=["click", "view"], status="completed", limit=50, offset=20)
    return out.select("contact_id", "version", stamp("updated_at").alias("updated_at"))


@check("s8_rules_frame", "notes rules",
       "SELECT n.eni_source_type, r.subtype, r.ord, count(*) AS n FROM notes n JOIN rules r "
       "ON r.eni_source_type = n.eni_source_type GROUP BY 1, 2, 3")
def s8(spark, sf):
    """S8"""
    r = rules.rules_frame(spark, RULE_MAP)
    return (frame(spark, sf, "notes").join(r, "eni_source_type")
            .groupBy("eni_source_type", "subtype", "ord").agg(F.count(F.lit(1)).alias("n")))


SELECTION_SQL = """SELECT contact_id FROM pick_log
  WHERE processor_system_prompt_key = :system_prompt AND processor_generator = :generator
    AND processed_at < CAST(:job_start_time AS timestamp)
  ORDER BY processed_at DESC, contact_id, pos"""


@check("s11_select_contacts_sql", "run_log",
       "SELECT contact_id FROM (SELECT contact_id FROM run_log WHERE "
       "processor_system_prompt_key = 'structured_insight' AND processor_generator = "
       "'structured_insight' AND processed_at < TIMESTAMP '2000-01-01 00:00:00' "
       "ORDER BY processed_at DESC, contact_id, pos LIMIT 300 OFFSET 40) GROUP BY contact_id")
def s11(spark, sf):
    """S11"""
    frame(spark, sf, "run_log").createOrReplaceTempView("pick_log")
    ids = selection.select_contacts_sql(
        spark, SELECTION_SQL, {"system_prompt": "structured_insight",
                               "generator": "structured_insight",
                               "job_start_time": "2000-01-01 00:00:00"}, limit=300, offset=40)
    return ids.select("contact_id")


@check("s11_limit_in_text", "run_log",
       "SELECT contact_id FROM (SELECT contact_id FROM run_log ORDER BY processed_at DESC, contact_id, pos "
       "LIMIT 300 OFFSET 40) GROUP BY contact_id")
def s11b(spark, sf):
    """A LIMIT in the text and an offset beside it skip first"""
    frame(spark, sf, "run_log").createOrReplaceTempView("pick_log")
    return selection.select_contacts_sql(
        spark, "SELECT contact_id FROM pick_log ORDER BY processed_at DESC, contact_id, pos LIMIT 300;", {},
        limit=7, offset=40).select("contact_id")


@check("s11_limit_in_subquery", "run_log",
       "SELECT contact_id FROM (SELECT contact_id FROM (SELECT * FROM run_log ORDER BY processed_at, contact_id, pos "
       "LIMIT 500 OFFSET 3) ORDER BY processed_at DESC, contact_id, pos LIMIT 10 OFFSET 20) GROUP BY contact_id")
def s11c(spark, sf):
    """A LIMIT of an inner query, or in a comment, is not the text's own"""
    frame(spark, sf, "run_log").createOrReplaceTempView("pick_log")
    return selection.select_contacts_sql(
        spark, "SELECT contact_id FROM (SELECT * FROM pick_log ORDER BY processed_at, contact_id, pos LIMIT 500 OFFSET 3) "
        "ORDER BY processed_at DESC, contact_id, pos -- limit 5", {}, limit=10, offset=20).select("contact_id")


@check("s11_limit_column", "run_log",
       "SELECT contact_id FROM (SELECT contact_id FROM (SELECT contact_id, processed_at, pos AS \"limit\", pos FROM run_log) t "
       "WHERE t.\"limit\" >= 0 ORDER BY processed_at, contact_id, pos LIMIT 7 OFFSET 2) GROUP BY contact_id")
def s11d(spark, sf):
    """A column called limit is no clause, under WITH and without brackets around it"""
    frame(spark, sf, "run_log").createOrReplaceTempView("pick_log")
    return selection.select_contacts_sql(
        spark, "WITH t AS (SELECT contact_id, processed_at, pos AS limit, pos FROM pick_log LIMIT ALL) SELECT contact_id "
        "FROM t WHERE t.limit >= 0 ORDER BY processed_at, contact_id, pos", {}, limit=7, offset=2).select("contact_id")


@check("p1_usable_notes", "notes",
       f"SELECT eni_id, description, {DAY} FROM notes WHERE description IS NOT NULL AND trim(description) <> ''")
def p1(spark, sf):
    """P1"""
    return noted(selection.usable_notes(frame(spark, sf, "notes"))).select(
        "eni_id", "description", "logged_date")


@check("p2_by_type_null", "notes",
       "SELECT eni_id FROM notes WHERE eni_source_type = 'click' AND eni_source_subtype IS NULL")
def p2a(spark, sf):
    """The sentinel asks for a real NULL."""
    return selection.by_type(frame(spark, sf, "notes"), "click", "null").select("eni_id")


@check("p2_by_type_subtype", "notes",
       "SELECT eni_id FROM notes WHERE eni_source_type = 'view' AND eni_source_subtype = 'sector' "
       "UNION ALL SELECT eni_id FROM notes WHERE eni_source_type = 'error'")
def p2b(spark, sf):
    """With and without a subtype."""
    n = frame(spark, sf, "notes")
    return selection.by_type(n, "view", "sector").select("eni_id").unionByName(
        selection.by_type(n, "error").select("eni_id"))


@check("p3_rule_filter", "notes rules",
       "SELECT eni_id FROM notes n WHERE EXISTS (SELECT 1 FROM rules r WHERE r.eni_source_type = "
       "n.eni_source_type) AND (n.eni_source_subtype IS NULL OR trim(n.eni_source_subtype) = '' OR "
       "lower(n.eni_source_subtype) IN ('none', 'nan', 'nat') OR EXISTS (SELECT 1 FROM rules r WHERE "
       "r.eni_source_type = n.eni_source_type AND r.subtype = n.eni_source_subtype))")
def p3(spark, sf):
    """P3"""
    return rules.rule_filter(frame(spark, sf, "notes"), frame(spark, sf, "rules")).select("eni_id")


@check("p5_processed_ids", "run_log",
       "SELECT 'processed' AS which, eni_id FROM (SELECT DISTINCT eni_id FROM run_log WHERE "
       "processing_status IN ('completed', 'skipped')) UNION ALL SELECT 'completed', eni_id FROM "
       "(SELECT DISTINCT eni_id FROM run_log WHERE processing_status = 'completed')")
def p5(spark, sf):
    """P5: both named options."""
    log = frame(spark, sf, "run_log")
    return (selection.processed_ids(log).select(F.lit("processed").alias("which"), "eni_id")
            .unionByName(selection.processed_ids(log, ("completed",)).select(
                F.lit("completed").alias("which"), "eni_id")))


@check("p6_log_for", "run_log",
       "SELECT eni_id, contact_id FROM run_log WHERE processor_system_prompt_key = 'member_summary' "
       "AND processor_generator = 'structured_insight'")
def p6(spark, sf):
    """P6"""
    return selection.log_for(frame(spark, sf, "run_log"), "member_summary",
                             "structured_insight").select("eni_id", "contact_id")


@check("p7_due", "notes run_log", f"SELECT contact_id, {stamp_sql('seen_at')} AS last_processed_at FROM cl "
       f"WHERE seen_at IS NULL OR seen_at < {CUTOFF_SQL}", LATEST)
def p7(spark, sf):
    """P7"""
    df = last_seen(spark, sf)
    return selection.due(df, CUTOFF).select(
        "contact_id", stamp("last_processed_at").alias("last_processed_at"))


@check("p8_due_in_list", "profiles notes",
       "SELECT DISTINCT n.contact_id FROM notes n WHERE regexp_matches(n.description, '\\S') "
       "AND n.contact_id IN (SELECT contact_id FROM profiles WHERE source_type = 'purchase') AND "
       "n.contact_id NOT IN (SELECT contact_id FROM profiles WHERE generator = 'member_summary' AND processing_status = 'completed')")
def p8(spark, sf):
    """Listed contacts without a log row; here old-style profiles stand for the log."""
    p = frame(spark, sf, "profiles")
    log = p.filter("generator = 'member_summary'").withColumnRenamed("updated_at", "processed_at")
    df = selection.contact_last_processed(frame(spark, sf, "notes"), log)
    return selection.due_in_list(df, p.filter("source_type = 'purchase'")).select("contact_id")


@check("p9_profile_filter", "profiles",
       "SELECT contact_id, version FROM profiles WHERE contact_id IN ('CNT-000003', 'CNT-000008', "
       "'CNT-000021') AND source_type = 'view' AND processing_status = 'completed'")
def p9(spark, sf):
    """P9"""
    return profile_filter(with_sources(frame(spark, sf, "profiles")),
                          ["CNT-000003", "CNT-000008", "CNT-000021"], ["view"],
                          "completed").select("contact_id", "version")


@check("p13_valid_contact_id", "ids",
       "SELECT ord, contact_id, CAST(coalesce(regexp_matches(contact_id, '^CNT-[A-Za-z0-9]{6,}$'), "
       "false) AS int) AS ok FROM ids")
def p13(spark, sf):
    """P13"""
    return frame(spark, sf, "ids").select(
        "ord", "contact_id", selection.valid_contact_id(F.col("contact_id")).cast("int").alias("ok"))


@check("p14_non_null", "ids", "SELECT ord, contact_id FROM ids WHERE contact_id IS NOT NULL")
def p14(spark, sf):
    """P14"""
    return selection.non_null(frame(spark, sf, "ids"), "contact_id")


@check("j1_unprocessed", "notes run_log",
       "SELECT n.eni_id, n.contact_id FROM notes n LEFT JOIN (SELECT DISTINCT eni_id FROM run_log WHERE "
       "processing_status = 'completed') l ON l.eni_id = n.eni_id WHERE l.eni_id IS NULL")
def j1(spark, sf):
    """J1"""
    return selection.unprocessed(frame(spark, sf, "notes"), frame(spark, sf, "run_log")).select(
        "eni_id", "contact_id")


@check("j2_contact_last_processed", "notes run_log",
       f"SELECT contact_id, {stamp_sql('seen_at')} AS last_processed_at FROM cl", LATEST)
def j2(spark, sf):
    """J2"""
    df = last_seen(spark, sf)
    return df.select("contact_id", stamp("last_processed_at").alias("last_processed_at"))


@check("j3_in_list", "notes profiles",
       "SELECT eni_id, contact_id FROM notes WHERE contact_id IN (SELECT contact_id FROM profiles)")
def j3(spark, sf):
    """J3"""
    return selection.in_list(frame(spark, sf, "notes"), frame(spark, sf, "profiles")).select(
        "eni_id", "contact_id")


@check("a1_contact_counts", "notes",
       "SELECT contact_id, count(*) AS record_count FROM notes WHERE regexp_matches(description, '\\S') "
       "GROUP BY contact_id ORDER BY record_count DESC, contact_id LIMIT 25")
def a1(spark, sf):
    """A1"""
    return selection.contact_counts(frame(spark, sf, "notes"), 25)


@check("a2_type_counts", "notes",
       "SELECT eni_source_type, eni_source_subtype, count(*) AS record_count FROM notes GROUP BY 1, 2")
def a2(spark, sf):
    """A2"""
    return selection.type_counts(frame(spark, sf, "notes"))


@check("a3_last_processed", "run_log",
       f"SELECT contact_id, {stamp_sql('max(processed_at)')} AS last_processed_at FROM run_log "
       "WHERE processing_status IN ('completed', 'skipped') AND processor_system_prompt_key = 'member_summary' GROUP BY contact_id")
def a3(spark, sf):
    """A3 over P6, with the wider choice of states"""
    return selection.last_processed(frame(spark, sf, "run_log"), "member_summary", "structured_insight",
                                    ("completed", "skipped")).select(
        "contact_id", stamp("last_processed_at").alias("last_processed_at"))


@check("o3_prioritized_contacts", "notes run_log",
       f"SELECT contact_id, {stamp_sql('seen_at')} AS last_processed_at FROM cl WHERE seen_at IS NULL OR seen_at < {CUTOFF_SQL} "
       "ORDER BY seen_at NULLS FIRST, contact_id LIMIT 40 OFFSET 5", LATEST)
def o3b(spark, sf):
    """J2, P7, O2 and O3 together"""
    df = selection.prioritized_contacts(frame(spark, sf, "notes"), frame(spark, sf, "run_log"), CUTOFF,
                                        "structured_insight", limit=40, offset=5)
    return df.select("contact_id", stamp("last_processed_at").alias("last_processed_at"))


@check("a5_profile_count", "profiles",
       "SELECT count(*) AS n FROM profiles WHERE processing_status = 'completed' AND source_type = 'view'")
def a5(spark, sf):
    """A5"""
    return profile_count(with_sources(frame(spark, sf, "profiles")), source_types=["view"],
                         status="completed")


@check("o1_newest_first", "notes",
       "SELECT eni_id, row_number() OVER (ORDER BY logged_date DESC NULLS LAST, eni_id) AS pos FROM notes")
def o1(spark, sf):
    """O1, the order shown as positions"""
    df = selection.newest_first(frame(spark, sf, "notes"))
    return ordering.with_position(df).select("eni_id", "pos")


@check("o2_selection_order", "notes run_log",
       "SELECT contact_id, row_number() OVER (ORDER BY seen_at NULLS FIRST, contact_id) AS pos FROM cl", LATEST)
def o2(spark, sf):
    """O2"""
    df = last_seen(spark, sf)
    return selection.selection_order(df).select("contact_id", "pos")


LOGGED = """logged AS (SELECT contact_id, max(processed_at) AS seen_at FROM run_log
  WHERE processing_status = 'completed' GROUP BY contact_id)"""


def _pages(prefix: str, source: str) -> str:
    return (f"SELECT '{prefix}page' AS part, contact_id FROM (SELECT contact_id FROM {source} ORDER BY seen_at NULLS FIRST, contact_id "
            f"LIMIT 30 OFFSET 15) UNION ALL SELECT '{prefix}rest', contact_id FROM (SELECT contact_id FROM {source} ORDER BY "
            "seen_at NULLS FIRST, contact_id OFFSET 45)")


@check("o3_page", "notes run_log", _pages("", "cl") + " UNION ALL " + _pages("log ", "logged"), LATEST + ",\n" + LOGGED)
def o3(spark, sf):
    """O3: a page of the contacts with notes, seen or not, and all after it; the same of all contacts of the log."""
    parts = []
    for prefix, df in (("", last_seen(spark, sf)), ("log ", selection.last_processed(frame(spark, sf, "run_log")))):
        parts += [selection.selection_page(df, 30, 15).select(F.lit(f"{prefix}page").alias("part"), "contact_id"),
                  selection.selection_page(df, None, 45).select(F.lit(f"{prefix}rest").alias("part"), "contact_id")]
    return reduce(DataFrame.unionByName, parts)


@check("o4_list_page", "run_log",
       "SELECT eni_id, processing_duration_ms FROM run_log ORDER BY processing_duration_ms DESC, eni_id "
       "LIMIT 40 OFFSET 10")
def o4(spark, sf):
    """O4"""
    return selection.list_page(frame(spark, sf, "run_log"), "processing_duration_ms", False, 40, 10,
                               ("eni_id",)).select("eni_id", "processing_duration_ms")


@check("o5_most_recent", "profiles",
       f"SELECT contact_id, version, {stamp_sql('updated_at')} AS updated_at, business FROM (SELECT *, row_number() "
       "OVER (PARTITION BY contact_id ORDER BY profiles.updated_at DESC, version DESC) AS r FROM profiles) "
       "WHERE r = 1")
def o5(spark, sf):
    """O5"""
    return selection.most_recent(frame(spark, sf, "profiles")).select(
        "contact_id", "version", stamp("updated_at").alias("updated_at"), "business")


@check("w4_dedup_ordered", "run_log",
       "SELECT contact_id, pos FROM (SELECT contact_id, pos, row_number() OVER (PARTITION BY contact_id "
       "ORDER BY pos) AS r FROM run_log) WHERE r = 1")
def w4(spark, sf):
    """W4"""
    return selection.dedup_ordered(frame(spark, sf, "run_log"))


@check("w6_last_n", "results",
       "SELECT ord, action FROM results ORDER BY synced_at DESC, ord DESC LIMIT 100")
def w6(spark, sf):
    """W6"""
    return selection.last_n(frame(spark, sf, "results"), ["synced_at", "ord"], 100).select(
        "ord", "action")


@check("w7_waves", "notes run_log",
       "SELECT contact_id, (row_number() OVER (ORDER BY seen_at NULLS FIRST, contact_id) - 1) // 20 AS wave FROM cl",
       LATEST)
def w7(spark, sf):
    """W7"""
    df = last_seen(spark, sf)
    return selection.waves(selection.selection_order(df), 20).select("contact_id", "wave")


@check("u1_distinct_keys", "notes",
       "SELECT DISTINCT eni_source_type, eni_source_subtype FROM notes")
def u1(spark, sf):
    """U1"""
    return selection.distinct_keys(frame(spark, sf, "notes"), ["eni_source_type", "eni_source_subtype"])

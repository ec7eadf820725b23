"""Tables laid out by key: bucketed joins (J1, J8, U4) and changes in part (M2, M4, M6)."""
import uuid

from pyspark.sql import functions as F

from checks.bindings import frame
from checks.registry import ORACLES, check
from checks.storing import OLD_SQL, UPSERT_SQL, incoming, stored
from dossier.checkpoints import freeze, run_folder
from dossier.operators import selection, versions
from dossier.sinks.layouts import BucketFolders, append_bucketed


def bucketed(df, keys: list[str]):
    """``df`` as a bucketed table of its own, appended in two runs."""
    spark = df.sparkSession
    name, path = f"by_key_{uuid.uuid4().hex}", run_folder(spark, "bucketed")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    half = F.pmod(F.xxhash64(*keys), F.lit(2))
    for part in (df.filter(half == 0), df.filter(half == 1)):
        append_bucketed(part, name, keys, buckets, path)
    return spark.table(name)


@check("j1_bucketed", sql=ORACLES["j1_unprocessed"])
def j1(spark, sf):
    """J1 on tables bucketed by id: neither side is shuffled"""
    notes, log = (bucketed(frame(spark, sf, x), ["eni_id"]) for x in ("notes", "run_log"))
    return selection.unprocessed(notes, log).select("eni_id", "contact_id")


@check("j8_bucketed", sql=ORACLES["j8_match_existing"])
def j8(spark, sf):
    """The stored side stays where it is"""
    old = bucketed(stored(spark, sf), ["contact_id", "eni_id"])
    return versions.match_existing(incoming(spark, sf), old).select(
        "contact_id", "eni_id", "ord", F.col("is_existing").cast("int").alias("is_existing"))


@check("u4_bucketed", sql=ORACLES["u4_merge_processed"])
def u4(spark, sf):
    """U4 on tables bucketed by (contact, id): neither side is shuffled"""
    old, new = (bucketed(frame(spark, sf, x).select("contact_id", "eni_id"), ["contact_id", "eni_id"])
                for x in ("run_log", "legacy"))
    return versions.merge_processed(old, new)


def folders(df, keys: tuple[str, ...], n: int = 16) -> BucketFolders:
    spark = df.sparkSession
    made = BucketFolders(spark, run_folder(spark, "folders"), df.schema, keys, n)
    made.create(df)
    return made


@check("m2_upsert_in_part", "profiles", f"SELECT * EXCLUDE (action) FROM ({UPSERT_SQL})", OLD_SQL)
def m2(spark, sf):
    """M2: the table after an upsert that rewrites only the folders of the keys written"""
    t = folders(stored(spark, sf), ("contact_id", "eni_id"))
    t.upsert(freeze(incoming(spark, sf)))
    return t.read()


@check("m2_upsert_written", "profiles", f"SELECT * FROM ({UPSERT_SQL}) WHERE action <> 'kept'", OLD_SQL)
def m2_written(spark, sf):
    """M2: the rows that the upsert wrote"""
    t = folders(stored(spark, sf), ("contact_id", "eni_id"))
    return t.upsert(freeze(incoming(spark, sf)))


@check("m4_delete_in_part", sql=ORACLES["m4_delete_ids"])
def m4(spark, sf):
    """M4 on folders by contact"""
    t = folders(frame(spark, sf, "profiles"), ("contact_id",))
    t.delete(frame(spark, sf, "ids"), "contact_id")
    return t.read().select("contact_id", "version")


@check("m6_clear_in_part", sql=ORACLES["m6_clear_log"])
def m6(spark, sf):
    """M6 on folders by contact: one contact's rows go, then all rows"""
    t = folders(frame(spark, sf, "run_log"), ("contact_id",))
    t.clear("CNT-000007")
    rest = freeze(t.read().select(F.lit("one").alias("scope"), "contact_id"))
    t.clear()
    none = t.read().select(F.lit("all").alias("scope"), "contact_id")
    return rest.unionByName(none).groupBy("scope", "contact_id").agg(F.count(F.lit(1)).alias("n"))

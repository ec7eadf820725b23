"""Publication: latest profiles, skip test, master lookup, outbox, summary."""
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dossier.operators.publish import build_outbox, sync_plan, sync_results
from dossier.operators.versions import latest_versions
from dossier.schemas import DEFAULT_GENERATOR


def publish_latest(versions: DataFrame, master: DataFrame, now: datetime,
                   force: bool = False) -> tuple[DataFrame, DataFrame]:
    """Outbox of the latest profiles that are due, and one result row per contact."""
    planned = sync_plan(latest_versions(versions, DEFAULT_GENERATOR), now, force)
    outbox = build_outbox(planned.filter(F.col("action") == "sync"), master)
    skipped = planned.filter(F.col("action") == "skip").select(
        "contact_id", F.lit(True).alias("success"), F.lit("skipped").alias("action"),
        F.lit("not due yet").alias("error_message"))
    return outbox, sync_results(outbox).unionByName(skipped)

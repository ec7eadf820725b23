"""Table scans with declared schemas."""
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from dossier.operators.selection import list_page
from dossier.operators.versions import profile_filter
from dossier.schemas import NOTES, PROFILE_VERSIONS, RUN_LOG


def read_table(spark: SparkSession, src: str, schema: StructType | None = None,
               fmt: str = "parquet", **options: str) -> DataFrame:
    """Read a table in any format Spark knows; columnar formats prune and push down as usual."""
    reader = spark.read.format(fmt).options(**options)
    return (reader.schema(schema) if schema is not None else reader).load(src)


def read_notes(spark: SparkSession, src: str, fmt: str = "parquet", **options: str) -> DataFrame:
    """The note table."""
    return read_table(spark, src, NOTES, fmt, **options)


def read_run_log(spark: SparkSession, src: str, fmt: str = "parquet",
                 **options: str) -> DataFrame:
    """The run log."""
    return read_table(spark, src, RUN_LOG, fmt, **options)


def read_profiles(spark: SparkSession, src: str, fmt: str = "parquet",
                  contacts: list[str] | None = None, source_types: list[str] | None = None,
                  status: str | None = None, order_by: str = "updated_at",
                  ascending: bool = False, limit: int | None = None,
                  offset: int = 0) -> DataFrame:
    """S3: profile versions with optional filters, order and page; ``insights`` read as ``sections``."""
    stored = storage_sections(read_table(spark, src, PROFILE_VERSIONS, fmt))
    return profile_page(stored, contacts, source_types, status, order_by, ascending, limit, offset)


def profile_page(df: DataFrame, contacts=None, source_types=None, status=None,
                 order_by: str = "updated_at", ascending: bool = False,
                 limit: int | None = None, offset: int = 0) -> DataFrame:
    """The same options over a table that is already a DataFrame."""
    out = profile_filter(df, contacts, source_types, status)
    if limit is None and not offset:
        return out
    return list_page(out, order_by, ascending, limit, offset,
                     ("contact_id", "generator", "version"))


def storage_sections(df: DataFrame) -> DataFrame:
    """Rename the stored ``insights`` struct to ``sections``, the name the operators use."""
    return df.withColumn("sections", F.col("insights")).drop("insights")

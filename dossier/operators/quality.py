"""Checks that report findings."""
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dossier.functions.responses import normalize_records
from dossier.functions.sections import uncited
from dossier.operators.selection import valid_contact_id
from dossier.schemas import PROFILE_STATUSES

# Fixed value: a context file above this size is reported.
LARGE_FILE_BYTES = 100 * 1024

# Length limits of the text columns of a profile version.
MAX_LENGTHS = (("contact_id", 50), ("eni_id", 100), ("member_name", 255), ("generator", 50),
               ("system_prompt_key", 100))
POSITIVE = ("record_count", "total_eni_ids", "version")


def profile_errors(columns: list[str]) -> Column:
    """V3: messages for what is wrong with a profile row, an empty array when nothing is."""
    checks = [(~valid_contact_id(F.col("contact_id")), "invalid contact_id")]
    for name, n in MAX_LENGTHS:
        if name in columns:
            checks.append((F.length(name) > n, f"{name} longer than {n}"))
    for name in POSITIVE:
        if name in columns:
            checks.append((F.col(name) < 1, f"{name} below 1"))
    if "processing_status" in columns:
        checks.append((~F.col("processing_status").isin(*PROFILE_STATUSES),
                       "unknown processing_status"))
    return F.array_compact(F.array(*[F.when(bad, F.lit(text)) for bad, text in checks]))


def profile_findings(df: DataFrame, keys: list[str]) -> DataFrame:
    """V3: one row per problem of each profile row."""
    return df.select(*keys, F.explode(profile_errors(df.columns)).alias("finding"))


def uncited_sections(df: DataFrame, keys: list[str]) -> DataFrame:
    """V4: sections with text and no citation, one row each."""
    return df.select(*keys, F.explode(uncited(F.col("sections"))).alias("section")).withColumn(
        "finding", F.concat(F.lit("no citation in section "), "section"))


def document_findings(docs: DataFrame, keys: list[str], doc: str = "doc") -> DataFrame:
    """V5: documents that are not valid JSON records, or break a profile rule."""
    rows = normalize_records(docs, doc)
    errors = F.when(F.col("record_error").isNotNull(), F.array("record_error")).otherwise(
        profile_errors(rows.columns))
    return rows.select(*keys, F.explode(errors).alias("finding"))


def context_findings(mapping: DataFrame, files: DataFrame) -> DataFrame:
    """V2: mapped context files that do not exist."""
    return mapping.join(files.select("path"), "path", "left_anti").select(
        "type", "subtype", "path", F.lit("file of the mapping is missing").alias("finding"))


def corpus_stats(files: DataFrame, types: DataFrame) -> DataFrame:
    """Types, files, empty and large files, undecodable ones, and types with no file.

    ``files`` has (type, length, content); text that was not valid UTF-8 holds the replacement
    character.
    """
    per_file = files.agg(
        F.count(F.lit(1)).alias("total_files"),
        F.count_if(F.col("length") == 0).alias("empty_files"),
        F.count_if(F.col("length") > LARGE_FILE_BYTES).alias("large_files"),
        F.count_if(F.contains("content", F.lit("�"))).alias("undecodable_files"))
    per_type = (types.select("type").distinct()
                .join(files.select("type", F.lit(1).alias("_has")).distinct(), "type", "left")
                .agg(F.count(F.lit(1)).alias("total_types"),
                     F.count_if(F.col("_has").isNull()).alias("types_without_files")))
    rows = [(per_file, c) for c in ("total_files", "empty_files", "large_files",
                                    "undecodable_files")]
    names = ", ".join(f"'{c}', {c}" for _, c in rows)
    return (per_file.selectExpr(f"stack({len(rows)}, {names}) AS (metric, value)")
            .unionByName(per_type.selectExpr(
                "stack(2, 'total_types', total_types, 'types_without_files', "
                "types_without_files) AS (metric, value)")))

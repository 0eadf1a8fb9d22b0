"""The stored tables of a crawl under fixed schemas, one immutable folder per run.

A run writes each of its tables once, to ``<store>/tables/<name>/run=<n>``; a run that is started again writes the same
folder anew. Schemas are checked on both sides: a table that lacks a column, or has it under another type, is an error
when it is written and when it is read, and so is a table that was never written. Further columns are kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from holdsift.sources.tables import exists

#: Fixed columns of the tables a crawl keeps beside ledger, staging and published rows, which have stores of their own.
SCHEMAS = {
    "source_config": (
        "source_id int, source_key string, amc_name string, base_url string, page_type string, strategy string, "
        "api_patterns array<string>, file_types array<string>, download_selectors array<string>, enabled boolean, "
        "page_structure_hash string, last_crawled_at timestamp, last_success_at timestamp"),
    "discovered_document": (
        "doc_id string, source_id int, source_key string, url string, url_fingerprint string, filename string, file_type string, "
        "file_hash_sha256 string, file_size_bytes bigint, status string, last_error string, pipeline_run_id string"),
    "classified_document": (
        "doc_id string, source_id int, amc_name string, scheme_name string, scheme_category string, period_month int, "
        "period_year int, confidence_score double, is_quarantined boolean, quarantine_reason string"),
    "validated_data": "doc_id string, table_id int, business_rules_passed boolean",
    "drift_detection": (
        "source_id int, document_id string, detection_type string, severity string, previous_signature string, "
        "current_signature string, similarity_score double, description string, detected_at timestamp, alert_sent boolean, "
        "resolved boolean"),
    "audit_log": "entity_type string, entity_id string, action string, after_state string, actor string, pipeline_run_id string, created_at timestamp",
    "pipeline_run": (
        "run_id string, source_id int, status string, started_at timestamp, completed_at timestamp, documents_discovered bigint, "
        "documents_novel bigint, documents_classified bigint, documents_quarantined bigint, documents_extracted bigint, "
        "documents_published bigint"),
}


class SchemaError(ValueError):
    """A stored table does not have the columns it must have."""


def check(df: DataFrame, name: str) -> DataFrame:
    """``df`` as it is, if it has the fixed columns of the table under their types."""
    have = {f.name: f.dataType for f in df.schema.fields}
    wrong = []
    for f in T.StructType.fromDDL(SCHEMAS[name]).fields:
        if f.name not in have:
            wrong.append(f"{f.name} is missing")
        elif have[f.name].simpleString() != f.dataType.simpleString():
            wrong.append(f"{f.name} is {have[f.name].simpleString()}, not {f.dataType.simpleString()}")
    if wrong:
        raise SchemaError(f"table {name}: " + "; ".join(wrong))
    return df


def _folder(store: str, name: str) -> str:
    return f"{store}/tables/{name}"


def write_table(df: DataFrame, store: str, name: str, run_no: int) -> DataFrame:
    """Write a run's rows of a table, and read them back."""
    path = f"{_folder(store, name)}/run={run_no}"
    check(df, name).write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_table(spark: SparkSession, store: str, name: str, before: int | None = None, newest: bool = False) -> DataFrame:
    """Rows of all runs with the ``run`` that wrote them; of those ``before`` a run, or of the ``newest`` of them."""
    path = _folder(store, name)
    if not exists(spark, path):
        raise FileNotFoundError(f"no table {name} in {store}")
    rows = check(spark.read.option("mergeSchema", "true").parquet(path), name)
    rows = rows if before is None else rows.filter(F.col("run") < before)
    return rows.join(rows.agg(F.max("run").alias("run")), "run", "left_semi") if newest else rows


def rows_before(spark: SparkSession, store: str, name: str, run_no: int, newest: bool = False) -> DataFrame | None:
    """Like ``read_table``; None where no run wrote the table yet."""
    return read_table(spark, store, name, run_no, newest) if exists(spark, _folder(store, name)) else None

"""Source audits: pages stand for fetched documents, documents for probe attempts."""

from __future__ import annotations

from pyspark.sql import functions as F

from kalends.catalog import base, query
from kalends.catalog.base import sql
from kalends.catalog.functions import normalized_sql, text_sql
from kalends.functions.classes import SOURCE_FAMILIES
from kalends.functions.text import unescape_closed
from kalends.plans import audit
from kalends.session import cut
from kalends.sources.tables import table

# Suffixes given to pages in turn.
_SUFFIX = (".html", ".json", ".pdf", ".xls", ".zip", ".csv", ".htm")


@query("content_signature", """
    SELECT page_id AS doc_id, CASE WHEN why = '' THEN 'PASS' ELSE 'FAIL' END AS status, why AS reason FROM (SELECT page_id, CASE WHEN page_id % 40 = 39 THEN 'EMPTY_RESPONSE' WHEN page_id % 30 = 29 THEN 'UNEXPECTED_CONTENT_TYPE:application/xml'
      WHEN page_id % 7 = 2 AND page_id % 3 <> 0 THEN 'INVALID_PDF_SIGNATURE' WHEN page_id % 7 = 3 THEN 'INVALID_XLS_SIGNATURE' WHEN page_id % 7 = 4 AND page_id % 3 <> 2 THEN 'INVALID_ZIP_CONTAINER_SIGNATURE'
      WHEN page_id % 7 IN (0, 6) AND position('<' IN CASE page_id % 3 WHEN 0 THEN '%PDF-1.7 ' WHEN 1 THEN '  {"a": ' ELSE 'PK' END || html) = 0 THEN 'INVALID_HTML_SIGNATURE'
      WHEN page_id % 7 = 1 AND page_id % 3 <> 1 THEN 'INVALID_JSON_SIGNATURE' ELSE '' END AS why FROM pages)""")
def content_signature(spark, sf_dir):
    k = F.col("page_id")
    lead = F.when(k % 3 == 0, "%PDF-1.7 ").when(k % 3 == 1, '  {"a": ').otherwise("PK")
    docs = table(spark, sf_dir, "pages").select(
        k.alias("doc_id"), F.element_at(F.array(*[F.lit(s) for s in _SUFFIX]), (k % 7 + 1).cast("int")).alias("suffix"),
        F.when(k % 30 == 29, "Application/XML").otherwise("text/html").alias("content_type"), F.lit("html").alias("expected_type"),
        F.when(k % 40 == 39, "").otherwise(F.concat(lead, "html")).alias("body"))
    return audit.content_signature(docs)


# Markers each language's pages must show.
MARKERS = (("en", "The"), ("en", "and"), ("en", "tion on"), ("fr", "de la"), ("fr", "qué"), ("de", "der"), ("de", "die der"))
_VISIBLE = normalized_sql(text_sql("html", "' '"))
_MISSING = "list_filter(CASE spec " + " ".join(
    f"WHEN '{s}' THEN [" + ", ".join(f"'{m}'" for m in sorted({"en": ["the", "and", "tion on"], "fr": ["de la", "que"], "de": ["der", "die der"]}[s])) + "]" for s in ("en", "fr", "de")) + " END, lambda m: NOT contains(shown, m))"


@query("marker_audit", f"""
    SELECT doc_id, spec, CASE WHEN spec NOT IN ('en', 'fr', 'de') THEN '' ELSE array_to_string(missing, '|') END AS missing_markers, CASE WHEN spec NOT IN ('en', 'fr', 'de') THEN 'NOT_APPLICABLE' WHEN len(missing) = 0 THEN 'PASS' ELSE 'FAIL' END AS status
    FROM (SELECT *, {_MISSING} AS missing FROM (SELECT page_id AS doc_id, regexp_extract(url, '/([a-z][a-z])/', 1) AS spec, {_VISIBLE} AS shown FROM pages))""")
def marker_audit(spark, sf_dir):
    docs = table(spark, sf_dir, "pages").select(F.col("page_id").alias("doc_id"), F.regexp_extract("url", "/([a-z][a-z])/", 1).alias("spec"), F.col("html").alias("body"))
    return audit.marker_audit(docs, spark.createDataFrame(MARKERS, "spec string, marker string"), unescape_closed)


_STATUS = ("ACCESS_BLOCKED", "CONTENT_VALIDATION_FAILED", "ACQUIRED_DISCOVERY_EVIDENCE", "ACQUIRED_DOCUMENTATION_EVIDENCE", "ACQUIRED_DATASET", "FAILED")
_STATE = ("ACCESS_BLOCKED", "SOURCE_NOT_MACHINE_READABLE", "NO_ADMISSIBLE_SOURCE_FOUND_IN_CURRENT_PROBE", "UNAVAILABLE_AFTER_EXHAUSTIVE_AUDIT", "EXACT_OFFICIAL")
_LIST = lambda names: "[" + ", ".join(f"'{n}'" for n in names) + "]"
base.add("probe", f"""
    SELECT source || '_' || lang AS economy, 'D' || doc_id AS source_id, {_LIST(audit.PROBE_FAMILIES)}[CAST(n_chars % 8 + 1 AS INTEGER)] AS source_family, {_LIST(_STATUS)}[CAST(doc_id % 6 + 1 AS INTEGER)] AS retrieval_status,
           {_LIST(audit.CANDIDATE_CLASSES)}[CASE WHEN doc_id % 13 = 0 THEN CAST(n_chars % 4 + 1 AS INTEGER) ELSE 1 END] AS runtime_class, {_LIST(audit.CANDIDATE_CLASSES)}[CAST(n_chars % 4 + 1 AS INTEGER)] AS declared_class,
           {_LIST(_STATE)}[CAST(doc_id % 5 + 1 AS INTEGER)] AS state FROM documents""")
base.add("famcov", f"""
    SELECT e.economy, f.source_family, f.family_order, f.family_order <= 6 AS core, count(p.source_id) AS attempts, count(*) FILTER (WHERE retrieval_status = 'ACQUIRED_DATASET') AS datasets, count(*) FILTER (WHERE retrieval_status = 'ACQUIRED_DISCOVERY_EVIDENCE') AS discoveries,
           count(*) FILTER (WHERE retrieval_status = 'ACQUIRED_DOCUMENTATION_EVIDENCE') AS documents, count(*) FILTER (WHERE retrieval_status = 'ACCESS_BLOCKED') AS blocked, count(*) FILTER (WHERE retrieval_status = 'CONTENT_VALIDATION_FAILED') AS invalid,
           coalesce({_LIST(audit.CANDIDATE_CLASSES)}[max(list_position({_LIST(audit.CANDIDATE_CLASSES)}, runtime_class))], '') AS best_runtime_class
    FROM (SELECT DISTINCT economy FROM probe) e CROSS JOIN (SELECT unnest({_LIST(audit.PROBE_FAMILIES)}) AS source_family, unnest(range(1, 9))::INTEGER AS family_order) f LEFT JOIN probe p ON p.economy = e.economy AND p.source_family = f.source_family GROUP BY 1, 2, 3""", "probe")
base.add("famaudit", """
    SELECT *, audit_status IN ('DATASET_ACQUIRED', 'DOCUMENTATION_ONLY', 'SOURCE_NOT_MACHINE_READABLE', 'ATTEMPTED_NO_ADMISSIBLE_DATASET') AS resolved FROM (SELECT *, CASE WHEN attempts = 0 THEN 'NOT_INVESTIGATED' WHEN datasets > 0 THEN 'DATASET_ACQUIRED' WHEN documents > 0 THEN 'DOCUMENTATION_ONLY'
      WHEN discoveries > 0 THEN 'DISCOVERY_ONLY' WHEN invalid > 0 THEN 'SOURCE_NOT_MACHINE_READABLE' WHEN blocked = attempts THEN 'ACCESS_BLOCKED' ELSE 'ATTEMPTED_NO_ADMISSIBLE_DATASET' END AS audit_status FROM famcov)""", "famcov")


def probe(spark, sf_dir):
    pick = lambda names, at: F.element_at(F.array(*[F.lit(n) for n in names]), (at + 1).cast("int"))
    k, n = F.col("doc_id"), F.col("n_chars")
    return table(spark, sf_dir, "documents").select(
        F.concat_ws("_", "source", "lang").alias("economy"), F.concat(F.lit("D"), k).alias("source_id"), pick(audit.PROBE_FAMILIES, n % 8).alias("source_family"), pick(_STATUS, k % 6).alias("retrieval_status"),
        F.when(k % 13 == 0, pick(audit.CANDIDATE_CLASSES, n % 4)).otherwise(audit.CANDIDATE_CLASSES[0]).alias("runtime_class"), pick(audit.CANDIDATE_CLASSES, n % 4).alias("declared_class"), pick(_STATE, k % 5).alias("state"))


@query("source_family_coverage", sql("SELECT * FROM famaudit", "famaudit"))
def source_family_coverage(spark, sf_dir):
    return audit.source_family_coverage(probe(spark, sf_dir))


_RANK = lambda name: f"list_position({_LIST(audit.CANDIDATE_CLASSES)}, {name})"


@query("best_source_summary", sql(f"""
    SELECT b.economy, b.source_id AS best_source_id, b.runtime_class AS best_runtime_class, b.retrieval_status, d.source_id AS best_declared_source_id, a.candidates, c.core_attempted, c.core_resolved, c.core_resolved = 6 AS core_complete,
           c.core_resolved = 6 AND a.explicit AND NOT c.core_open AS definitive_unavailability_allowed,
           CASE WHEN b.runtime_class <> 'D_UNAVAILABLE' THEN CASE WHEN b.state = 'UNAVAILABLE_AFTER_EXHAUSTIVE_AUDIT' AND NOT (c.core_resolved = 6 AND a.explicit AND NOT c.core_open) THEN 'NO_ADMISSIBLE_SOURCE_FOUND_IN_CURRENT_PROBE' ELSE b.state END
                WHEN c.core_resolved = 6 AND a.explicit AND NOT c.core_open THEN 'UNAVAILABLE_AFTER_EXHAUSTIVE_AUDIT' WHEN a.blocked THEN 'ACCESS_BLOCKED' WHEN a.unreadable THEN 'SOURCE_NOT_MACHINE_READABLE' ELSE 'NO_ADMISSIBLE_SOURCE_FOUND_IN_CURRENT_PROBE' END AS audit_state
    FROM (SELECT *, row_number() OVER (PARTITION BY economy ORDER BY {_RANK('runtime_class')} DESC, {_RANK('declared_class')} DESC, retrieval_status = 'ACQUIRED_DATASET' DESC, source_id DESC) AS k FROM probe) b
    JOIN (SELECT *, row_number() OVER (PARTITION BY economy ORDER BY {_RANK('declared_class')} DESC, source_id DESC) AS k FROM probe) d ON d.economy = b.economy AND d.k = 1
    JOIN (SELECT economy, count(*) AS candidates, bool_or(state = 'UNAVAILABLE_AFTER_EXHAUSTIVE_AUDIT') AS explicit, bool_and(state = 'ACCESS_BLOCKED') AS blocked, bool_or(state = 'SOURCE_NOT_MACHINE_READABLE') AS unreadable FROM probe GROUP BY 1) a ON a.economy = b.economy
    JOIN (SELECT economy, count(*) FILTER (WHERE audit_status <> 'NOT_INVESTIGATED') AS core_attempted, count(*) FILTER (WHERE resolved) AS core_resolved, bool_or(audit_status IN ('ACCESS_BLOCKED', 'NOT_INVESTIGATED')) AS core_open FROM famaudit WHERE core GROUP BY 1) c ON c.economy = b.economy
    WHERE b.k = 1""", "probe", "famaudit"))
def best_source_summary(spark, sf_dir):
    rows = probe(spark, sf_dir)
    return audit.best_source_summary(rows, audit.source_family_coverage(rows))


_DATA = ("REST API", "IO_TABLE", "SUT", "STATBANK", "XLSX FILE", "YEARBOOK")
_KIND = ("HBS", "METHODOLOGY", "CPI")


@query("attempt_family_best", sql(f"""
    WITH_ SELECT e.economy, f.source_family, f.family_order, coalesce(b.attempts, 0) AS attempts, coalesce(b.status, 'NOT_INVESTIGATED_IN_CURRENT_PROBE') AS best_status, coalesce(b.dataset, '') AS best_dataset, coalesce(nullif(b.why, ''), 'GAP') AS remaining_gap
    FROM (SELECT DISTINCT source AS economy FROM documents) e CROSS JOIN (SELECT unnest({_LIST(SOURCE_FAMILIES)}) AS source_family, unnest(range(1, 10))::INTEGER AS family_order) f
    LEFT JOIN (SELECT economy, family, count(*) AS attempts, arg_min(status, doc_id) AS status, arg_min(d, doc_id) AS dataset, arg_min(why, doc_id) AS why FROM (SELECT source AS economy, doc_id, d, status, why,
        CASE WHEN doc_id % 17 = 0 THEN 'exhaustive_unavailability_documentation' WHEN d LIKE '%API%' THEN 'official_national_accounts_api' WHEN d = 'IO_TABLE' THEN 'official_input_output_tables' WHEN d = 'SUT' THEN 'official_supply_and_use_tables' WHEN d = 'STATBANK' THEN 'official_statistical_database'
             WHEN d LIKE '%XLSX%' THEN 'official_csv_xls_xlsx' WHEN k IN ('HBS', 'CPI') THEN 'survey_or_cpi_class_c_only' ELSE 'official_classifications_methodology' END AS family
      FROM (SELECT source, doc_id, {_LIST(_DATA)}[CAST(doc_id % 6 + 1 AS INTEGER)] AS d, {_LIST(_KIND)}[CAST(n_chars % 3 + 1 AS INTEGER)] AS k, {_LIST(_STATUS)}[CAST(n_chars % 6 + 1 AS INTEGER)] AS status, CASE WHEN n_chars % 2 = 0 THEN '' ELSE 'REJECTED_' || lang END AS why FROM documents)) GROUP BY 1, 2) b
      ON b.economy = e.economy AND b.family = f.source_family""".replace("WITH_ ", "")))
def attempt_family_best(spark, sf_dir):
    pick = lambda names, at: F.element_at(F.array(*[F.lit(n) for n in names]), (at + 1).cast("int"))
    k, n = F.col("doc_id"), F.col("n_chars")
    attempts = table(spark, sf_dir, "documents").select(
        F.col("source").alias("economy"), k.alias("attempt_id"), pick(_DATA, k % 6).alias("dataset"), pick(_KIND, n % 3).alias("classification"), F.when(k % 17 == 0, SOURCE_FAMILIES[8]).otherwise("").alias("source_family"),
        pick(_STATUS, n % 6).alias("retrieval_status"), F.when(n % 2 == 0, "").otherwise(F.concat(F.lit("REJECTED_"), "lang")).alias("rejection_reason"))
    return audit.attempt_family_best(attempts, "GAP")

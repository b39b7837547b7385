"""Audits of fetched documents and of the sources tried per economy."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from kalends.functions.classes import SOURCE_FAMILIES, source_family
from kalends.functions.text import normalize_name, searchable_text, unescape

PROBE_FAMILIES = SOURCE_FAMILIES[:8]
CORE_FAMILIES = SOURCE_FAMILIES[:6]
# Candidate classes from worst to best, and the families' resolved states.
CANDIDATE_CLASSES = ("D_UNAVAILABLE", "C_ONLY", "B_CANDIDATE", "A_CANDIDATE")
RESOLVED = ("DATASET_ACQUIRED", "DOCUMENTATION_ONLY", "SOURCE_NOT_MACHINE_READABLE", "ATTEMPTED_NO_ADMISSIBLE_DATASET")


def content_signature(docs: DataFrame) -> DataFrame:
    """PASS or the reason a body does not look like its suffix and declared type say.

    ``docs``: doc_id, suffix, content_type, expected_type, body (text or binary). Binary formats are told by their first bytes, texts by
    the whole body: a long comment or blank run before the first sign changes nothing.
    """
    raw = F.col("body").cast("binary")
    head = F.hex(F.substring(raw, 1, 4))
    whole = F.col("body").cast("string")
    kind = F.lower(F.coalesce("content_type", F.lit("")))
    wrong = (F.coalesce("expected_type", F.lit("")) != "") & (kind != "") & ~kind.contains(F.col("expected_type")) & ~kind.contains("octet-stream") & ~kind.contains("binary")
    suffix = F.lower("suffix")
    reason = (
        F.when(F.coalesce(F.octet_length(raw), F.lit(0)) == 0, "EMPTY_RESPONSE").when(wrong, F.concat(F.lit("UNEXPECTED_CONTENT_TYPE:"), kind))
        .when((suffix == ".pdf") & (head != "25504446"), "INVALID_PDF_SIGNATURE").when((suffix == ".xls") & (head != "D0CF11E0"), "INVALID_XLS_SIGNATURE")
        .when(suffix.isin(".xlsx", ".zip", ".ods") & ~head.startswith("504B"), "INVALID_ZIP_CONTAINER_SIGNATURE")
        .when(suffix.isin(".html", ".htm") & ~whole.contains("<"), "INVALID_HTML_SIGNATURE")
        .when((suffix == ".json") & ~whole.rlike(r"^\s*[\{\[]"), "INVALID_JSON_SIGNATURE").otherwise(""))
    return docs.select("doc_id", F.when(reason == "", "PASS").otherwise("FAIL").alias("status"), reason.alias("reason"))


def marker_audit(docs: DataFrame, markers: DataFrame, read: Callable[[Column], Column] = unescape) -> DataFrame:
    """Whether every required marker of a document's specification occurs in its normalised visible text.

    ``docs``: doc_id, spec, body; ``markers``: spec, marker. Markers are gathered per specification, so each text
    is normalised once and never repeated per marker. ``read`` reads character references.
    """
    wanted = markers.groupBy("spec").agg(F.array_sort(F.collect_set(normalize_name(F.col("marker")))).alias("wanted"))
    rows = docs.join(wanted, "spec", "left").withColumn("text", normalize_name(searchable_text(F.col("body"), read)))
    none = F.coalesce(F.size("wanted"), F.lit(0)) <= 0
    missing = F.filter("wanted", lambda m: ~F.contains(F.col("text"), m))
    return rows.select("doc_id", F.coalesce("spec", F.lit("")).alias("spec"), F.when(none | (F.col("text") == ""), "").otherwise(F.array_join(missing, "|")).alias("missing_markers"),
                       F.when(none | (F.col("text") == ""), "NOT_APPLICABLE").when(F.size(missing) == 0, "PASS").otherwise("FAIL").alias("status"))


def _families(economies: DataFrame) -> DataFrame:
    rows = F.array(*[F.struct(F.lit(f).alias("source_family"), F.lit(i + 1).alias("family_order"), F.lit(f in CORE_FAMILIES).alias("core")) for i, f in enumerate(PROBE_FAMILIES)])
    return economies.select("economy").distinct().withColumn("f", F.explode(rows)).select("economy", "f.*")


def class_rank(col: Column) -> Column:
    """4 for the best candidate class down to 1, 0 for an unknown one."""
    return F.array_position(F.array(*[F.lit(c) for c in CANDIDATE_CLASSES]), F.coalesce(col, F.lit(""))).cast("int")


def source_family_coverage(probe: DataFrame) -> DataFrame:
    """Every economy with every family: attempts by outcome, audit status and whether the family is settled.

    ``probe``: economy, source_id, source_family, retrieval_status, runtime_class, declared_class, state.
    """
    status = F.col("retrieval_status")
    count = lambda name: F.count_if(status == name)
    held = probe.groupBy("economy", "source_family").agg(
        F.count("*").alias("attempts"), count("ACQUIRED_DATASET").alias("datasets"), count("ACQUIRED_DISCOVERY_EVIDENCE").alias("discoveries"),
        count("ACQUIRED_DOCUMENTATION_EVIDENCE").alias("documents"), count("ACCESS_BLOCKED").alias("blocked"), count("CONTENT_VALIDATION_FAILED").alias("invalid"),
        F.max(class_rank(F.col("runtime_class"))).alias("rank"))
    n = lambda name: F.coalesce(name, F.lit(0))
    audit = (
        F.when(n("attempts") == 0, "NOT_INVESTIGATED").when(n("datasets") > 0, "DATASET_ACQUIRED").when(n("documents") > 0, "DOCUMENTATION_ONLY")
        .when(n("discoveries") > 0, "DISCOVERY_ONLY").when(n("invalid") > 0, "SOURCE_NOT_MACHINE_READABLE").when(n("blocked") == n("attempts"), "ACCESS_BLOCKED")
        .otherwise("ATTEMPTED_NO_ADMISSIBLE_DATASET"))
    best = F.coalesce(F.get(F.array(*[F.lit(c) for c in CANDIDATE_CLASSES]), F.col("rank") - 1), F.lit(""))
    grid = _families(probe).join(held, ["economy", "source_family"], "left")
    return grid.select("economy", "source_family", "family_order", "core", *[n(c).alias(c) for c in ("attempts", "datasets", "discoveries", "documents", "blocked", "invalid")],
                       best.alias("best_runtime_class"), audit.alias("audit_status"), audit.isin(*RESOLVED).alias("resolved"))


def best_source_summary(probe: DataFrame, families: DataFrame) -> DataFrame:
    """Best candidate per economy, completeness of the core families, and the audit state that follows.

    Best rows are maxima of ordered structs, combined map-side however many candidates an economy has.
    """
    order = F.struct(class_rank(F.col("runtime_class")).alias("a"), class_rank(F.col("declared_class")).alias("b"), (F.col("retrieval_status") == "ACQUIRED_DATASET").cast("int").alias("c"), "source_id")
    declared = F.struct(class_rank(F.col("declared_class")).alias("b"), "source_id")
    picked = F.struct("source_id", "runtime_class", "retrieval_status", "state")
    own = probe.groupBy("economy").agg(
        F.max_by(picked, order).alias("best"), F.max(declared).alias("declared"), F.count("*").alias("candidates"),
        F.bool_or(F.col("state") == "UNAVAILABLE_AFTER_EXHAUSTIVE_AUDIT").alias("explicit"), F.bool_and(F.col("state") == "ACCESS_BLOCKED").alias("all_blocked"),
        F.bool_or(F.col("state") == "SOURCE_NOT_MACHINE_READABLE").alias("unreadable"))
    core = families.filter("core").groupBy("economy").agg(
        F.count_if(F.col("audit_status") != "NOT_INVESTIGATED").alias("core_attempted"), F.count_if("resolved").alias("core_resolved"), F.count("*").alias("core_required"),
        F.bool_or(F.col("audit_status").isin("ACCESS_BLOCKED", "NOT_INVESTIGATED")).alias("core_open"))
    allowed = (F.col("core_resolved") == F.col("core_required")) & F.col("explicit") & ~F.col("core_open")
    none = "NO_ADMISSIBLE_SOURCE_FOUND_IN_CURRENT_PROBE"
    good = F.col("best.runtime_class").isin(*CANDIDATE_CLASSES[1:])
    guarded = F.when((F.col("best.state") == "UNAVAILABLE_AFTER_EXHAUSTIVE_AUDIT") & ~allowed, none).otherwise(F.col("best.state"))
    state = (
        F.when(good, guarded).when(allowed, "UNAVAILABLE_AFTER_EXHAUSTIVE_AUDIT").when(F.col("all_blocked"), "ACCESS_BLOCKED")
        .when(F.col("unreadable"), "SOURCE_NOT_MACHINE_READABLE").otherwise(none))
    return own.join(core, "economy").select(
        "economy", F.col("best.source_id").alias("best_source_id"), F.col("best.runtime_class").alias("best_runtime_class"), F.col("best.retrieval_status").alias("retrieval_status"),
        F.col("declared.source_id").alias("best_declared_source_id"), "candidates", "core_attempted", "core_resolved", (F.col("core_resolved") == F.col("core_required")).alias("core_complete"),
        allowed.alias("definitive_unavailability_allowed"), state.alias("audit_state"))


def attempt_family_best(attempts: DataFrame, remaining_gap: str) -> DataFrame:
    """Attempts per economy and family with the first attempt's outcome, and the gap that remains.

    ``attempts``: economy, attempt_id, dataset, classification, source_family, retrieval_status, rejection_reason.
    """
    family = source_family(F.col("dataset"), F.col("classification"), F.col("source_family"))
    first = attempts.withColumn("source_family", family).groupBy("economy", "source_family").agg(
        F.count("*").alias("attempts"), F.min_by(F.struct("dataset", "retrieval_status", "rejection_reason"), F.col("attempt_id")).alias("first"))
    rows = F.array(*[F.struct(F.lit(f).alias("source_family"), F.lit(i + 1).alias("family_order")) for i, f in enumerate(SOURCE_FAMILIES)])
    grid = attempts.select("economy").distinct().withColumn("f", F.explode(rows)).select("economy", "f.*")
    filled = lambda col: F.when(F.coalesce(col, F.lit("")) != "", col)
    return grid.join(first, ["economy", "source_family"], "left").select(
        "economy", "source_family", "family_order", F.coalesce("attempts", F.lit(0)).alias("attempts"),
        F.coalesce(filled(F.col("first.retrieval_status")), F.lit("NOT_INVESTIGATED_IN_CURRENT_PROBE")).alias("best_status"),
        F.coalesce(F.col("first.dataset"), F.lit("")).alias("best_dataset"), F.coalesce(filled(F.col("first.rejection_reason")), F.lit(remaining_gap)).alias("remaining_gap"))

"""Filings from scraped manifests: what a filing's documents are, and which of them a form is read from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.text import normalize_accession, normalize_cik
from ledgerline.operators.rollup import keep_last

DOCUMENTS = "array<struct<seq: string, description: string, filename: string, type: string, s3_key: string, url: string>>"
COMPLETE = "COMPLETE SUBMISSION TEXT FILE"
#: The mark a stored document begins with if it is a block of a submission.
BLOCK = "<DOCUMENT>"
#: File names of documents that are text; one of them without the mark is malformed.
TEXT_NAMES = r"(?i)\.(?:htm|html|txt)$"
_LAST = 2147483647


def key_parts(key: Column) -> tuple[Column, Column, Column]:
    """(day, form, cik) of a manifest's key "prefix/day/form/cik/accession/manifest.json"."""
    parts = F.split(key, "/")
    return tuple(F.element_at(parts, at) for at in (-5, -4, -3))


def filings(manifests: DataFrame, start: str | None = None, end: str | None = None, forms: list[str] | None = None, ciks: DataFrame | None = None) -> DataFrame:
    """Every manifest of the days and forms as a filing: the last scrape of each, with its documents as an array.

    start and end are included; ciks (cik) keeps the filings of some issuers. A manifest that names a
    failure is left out. Rows that aren't valid (no date, or documents that can't be read) are marked
    in `problem` and not dropped.
    """
    day, form, cik = key_parts(F.col("manifest_key"))
    rows = manifests.withColumn("_day", day).withColumn("_form", form).withColumn("_cik", normalize_cik(cik))
    rows = rows.where(F.col("_day") >= start) if start else rows
    rows = rows.where(F.col("_day") <= end) if end else rows
    rows = rows.where(F.col("_form").isin(forms)) if forms else rows
    rows = rows.join(ciks.select(normalize_cik(F.col("cik")).alias("_cik")).distinct(), "_cik", "left_semi") if ciks is not None else rows
    last = keep_last(rows, ["manifest_key"], F.col("last_scraped_at"), F.coalesce("form_type", F.lit("")), F.coalesce("accession_number", F.lit("")))
    documents = F.from_json("documents_json", DOCUMENTS)
    problem = F.when(F.try_to_date("filing_date", "yyyy-MM-dd").isNull(), "no date").when(documents.isNull(), "no documents")
    return last.where("coalesce(trim(failure_reason), '') = ''").select(
        "manifest_key", normalize_cik(F.col("cik")).alias("cik"), normalize_accession(F.col("accession_number")).alias("accession_number"), "form_type", "filing_date", "company_name",
        documents.alias("documents"), problem.alias("problem"),
    )


def complete_submission(documents: Column) -> Column:
    """The first document that is a complete submission by its type or description; null without one."""
    is_one = lambda c: F.upper(F.trim(F.coalesce(c, F.lit("")))) == COMPLETE
    return F.get(F.filter(documents, lambda d: (is_one(d["type"]) | is_one(d["description"])) & d["s3_key"].isNotNull()), F.lit(0))


def in_sequence(documents: Column) -> Column:
    """The stored documents in the order of their numbers; those without a whole number come last, equal ones as listed."""
    numbered = F.transform(documents, lambda d, i: F.struct(F.coalesce(d["seq"].try_cast("int"), F.lit(_LAST)).alias("n"), i.alias("i"), d.alias("d")))
    return F.transform(F.filter(F.array_sort(numbered), lambda x: F.coalesce(x["d"]["s3_key"], F.lit("")) != ""), lambda x: x["d"])


def submission_candidates(known: DataFrame) -> DataFrame:
    """filings() with resource (the complete submission's place) and failure where there is none."""
    document = complete_submission(F.col("documents"))
    return known.withColumn("resource", document["s3_key"]).withColumn("failure", F.coalesce("problem", F.when(document.isNull(), "no complete submission")))


def assembled_submissions(known: DataFrame, stored: DataFrame) -> DataFrame:
    """(manifest_key, accession_number, submission, left_out, failure): the blocks of each filing's stored documents, put together in sequence.

    stored is (s3_key, text). Attachments that aren't text are left out and counted. A document that
    isn't stored, a text document without the mark of a block, and a filing without any block fail
    the filing: it has no submission then.
    """
    entries = known.where("problem is null").select("manifest_key", "accession_number", F.posexplode_outer(in_sequence(F.col("documents"))).alias("place", "d"))
    found = entries.join(stored.select(F.col("s3_key").alias("_key"), "text"), F.col("d.s3_key") == F.col("_key"), "left")
    block = F.ltrim("text").startswith(BLOCK)
    name = F.when(F.coalesce("d.filename", F.lit("")) != "", F.col("d.filename")).otherwise(F.col("d.s3_key"))
    marked = found.select(
        "manifest_key", "accession_number", "place", F.when(block, F.col("text")).alias("block"), (F.col("d").isNotNull() & F.col("text").isNull()).alias("missing"),
        (F.col("text").isNotNull() & ~block & name.rlike(TEXT_NAMES)).alias("bare"), (F.col("text").isNotNull() & ~block & ~name.rlike(TEXT_NAMES)).alias("other"),
    )
    # a filing's documents are one submission: they belong in one place
    together = marked.groupBy("manifest_key", "accession_number").agg(
        F.array_sort(F.collect_list(F.when(F.col("block").isNotNull(), F.struct("place", "block")))).alias("blocks"), F.max("missing").alias("missing"), F.max("bare").alias("bare"), F.count(F.when(F.col("other"), 1)).alias("left_out"), F.count("place").alias("n"),
    )
    failure = F.when(F.col("n") == 0, "no documents").when(F.col("missing"), "document not found").when(F.col("bare") | (F.size("blocks") == 0), "malformed document")
    return together.select("manifest_key", "accession_number", F.when(failure.isNull(), F.array_join(F.transform("blocks", lambda b: b["block"]), "")).alias("submission"), "left_out", failure.alias("failure"))

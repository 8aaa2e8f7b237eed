"""Queries that hold what mentions record against the text they cite, beside the SQL that gives the same rows where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions import evidence, parties
from ledgerline.operators.matching import distinct_mentions, restatement
from ledgerline.plans.lineage import cut
from ledgerline.sources import manifests
from ledgerline.sources.tables import table

FACTS = "array<struct<kind: string, normalized_amount: string, currency: string, prior: boolean, spans: array<struct<text: string>>>>"


def _facts(spark: SparkSession, d: str) -> DataFrame:
    """(mention, place, kind, normalized_amount, currency, prior, texts, others, name): every amount of every mention with its own and its siblings' cited texts."""
    rows = distinct_mentions(table(spark, d, "mentions", "debt_instrument_mention_id", "name", "amounts_json")).withColumn("facts", F.from_json("amounts_json", FACTS))
    texts = lambda fact: F.transform(fact["spans"], lambda s: s["text"])
    one = rows.select("debt_instrument_mention_id", "name", "facts", F.posexplode("facts").alias("place", "fact"))
    others = F.flatten(F.transform(F.filter("facts", lambda f, i: i != F.col("place")), texts))
    return one.select("debt_instrument_mention_id", "place", "fact.kind", "fact.normalized_amount", "fact.currency", F.coalesce("fact.prior", F.lit(False)).alias("prior"), texts(F.col("fact")).alias("texts"), others.alias("others"), "name")


def amount_evidence(spark: SparkSession, d: str) -> DataFrame:
    """Every recorded amount with what its evidence confirms of it, and where from."""
    checked = evidence.scale_by_siblings(evidence.verify_amounts(cut(_facts(spark, d)), "normalized_amount", "currency", "texts", "name"), "normalized_amount", "texts", "others")
    rescued = F.col("verified.amount").isNull() & F.col("scaled").isNotNull()
    return checked.select(
        "debt_instrument_mention_id", "place", "kind", "prior", "normalized_amount", F.when(rescued, evidence.numeric_text(F.col("scaled"))).otherwise(F.col("verified.amount")).alias("verified_amount"),
        F.col("verified.currency").alias("verified_currency"), F.when(rescued, "scaled").otherwise(F.col("verified.derived_from")).alias("derived_from"),
    )


def date_status(spark: SparkSession, d: str) -> DataFrame:
    """Every mention's status as its dated facts give it, events after the filing being expected ones."""
    rows = distinct_mentions(table(spark, d, "mentions", "debt_instrument_mention_id", "date", "dates_json"))
    facts = rows.withColumn("facts", evidence.mark_expected(F.from_json("dates_json", evidence.DATED), F.coalesce("date", F.lit(""))))
    told = facts.withColumn("s", evidence.derived_status(F.col("facts")))
    return told.select("debt_instrument_mention_id", F.col("s.status").alias("derived_status"), F.col("s.date").alias("derived_status_date"), F.col("s.from_kind").alias("from_kind"), evidence.retirement_expected(F.col("facts")).alias("retirement_expected"))


def name_evidence(spark: SparkSession, d: str) -> DataFrame:
    """What the names of mentions say by themselves: amount, currency, maturity, rates, and how often restated."""
    names = table(spark, d, "mentions", "name").where("name is not null").distinct()
    read = names.select("name", evidence.amount_in_name(F.col("name")).alias("amount"), evidence.currency_in_name(F.col("name")).alias("currency"), evidence.maturity(F.col("name")).alias("maturity"), F.array_join(F.transform(evidence.rates(F.col("name")), lambda r: evidence.numeric_text(r)), ",").alias("rates"), restatement(F.col("name")).alias("r"))
    return read.select("name", evidence.numeric_text(F.col("amount")).alias("amount"), "currency", "maturity", "rates", F.col("r.rank").alias("restated"))


def lender_signatures(spark: SparkSession, d: str) -> DataFrame:
    """Every mention's lenders as matching compares them, and how completely they are disclosed."""
    rows = distinct_mentions(table(spark, d, "mentions", "debt_instrument_mention_id", "parties_json")).withColumn("p", F.from_json("parties_json", parties.PARTIES))
    kinds = F.transform(F.filter("p", lambda p: p["role"] == "lender"), lambda p: p["kind"])
    return rows.select("debt_instrument_mention_id", parties.lender_signature(F.col("p")).alias("lenders"), parties.disclosure_of(kinds).alias("disclosure"))


def filing_documents(spark: SparkSession, d: str) -> DataFrame:
    """Every filing's stored documents in sequence, by the last scrape of its manifest."""
    known = manifests.filings(table(spark, d, "filing_manifests"))
    each = known.select("manifest_key", "accession_number", F.posexplode(manifests.in_sequence(F.col("documents"))).alias("place", "d"))
    return each.select("manifest_key", "accession_number", "place", "d.type", "d.filename")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "amount_evidence": amount_evidence, "date_status": date_status, "name_evidence": name_evidence, "lender_signatures": lender_signatures, "filing_documents": filing_documents,
}

_RANKS = "map {'announcement': 1, 'closing': 2, 'amendment': 3, 'termination': 4, 'retirement': 4, 'exchange': 5, 'default': 6}"
_STATUSES = "map {'announcement': 'announced', 'closing': 'entered_into', 'amendment': 'amended', 'termination': 'terminated', 'retirement': 'repaid', 'exchange': 'exchanged', 'default': 'defaulted'}"
SQL = {
    "date_status": f"""
        with m as (select distinct debt_instrument_mention_id id, coalesce(date, '') filed, dates_json from mentions),
        f as (select id, filed, unnest(from_json(dates_json, '[{{"kind":"VARCHAR","normalized_date":"VARCHAR","prior":"BOOLEAN","expected":"BOOLEAN"}}]')) x, generate_subscripts(from_json(dates_json, '["JSON"]'), 1) pos from m),
        g as (select id, pos, x.kind kind, x.normalized_date as day, coalesce(x.prior, false) prior,
            coalesce(x.expected, false) or coalesce(x.kind in ('closing', 'amendment', 'termination', 'retirement', 'exchange', 'default', 'repayment') and x.normalized_date > filed and filed <> '', false) expected from f),
        c as (select * from g where {_RANKS}[kind] is not null and not prior and not expected),
        n as (select id, max(day) newest from c group by 1),
        w as (select c.id, arg_max({{'k': c.kind, 'd': c.day}}, {{'d': coalesce(c.day, n.newest, ''), 'r': {_RANKS}[c.kind], 'p': -c.pos}}) best from c join n on n.id = c.id group by 1),
        o as (select id, bool_or(kind = 'closing' and expected) closing, bool_or(kind in ('retirement', 'termination', 'exchange', 'default') and expected) planned,
            arg_min({{'d': day}}, pos) filter (kind = 'agreement' and not prior) agreed from g group by 1)
        select m.id debt_instrument_mention_id,
            case when w.best is not null then {_STATUSES}[w.best.k] when o.closing then 'announced' when o.agreed is not null then 'entered_into' end derived_status,
            case when w.best is not null then w.best.d when o.closing then null when o.agreed is not null then o.agreed.d end derived_status_date,
            case when w.best is not null then w.best.k when o.closing then 'closing:expected' when o.agreed is not null then 'agreement' end from_kind, coalesce(o.planned, false) retirement_expected
        from m left join w on w.id = m.id left join o on o.id = m.id""",
    "filing_documents": """
        with r as (select *, row_number() over (partition by manifest_key order by last_scraped_at desc, coalesce(form_type, '') desc, coalesce(accession_number, '') desc) r from filing_manifests),
        f as (select manifest_key, replace(accession_number, '-', '') accession_number, unnest(from_json(documents_json, '[{"seq":"VARCHAR","filename":"VARCHAR","type":"VARCHAR","s3_key":"VARCHAR"}]')) x,
            generate_subscripts(from_json(documents_json, '["JSON"]'), 1) pos from r where r = 1 and coalesce(trim(failure_reason), '') = '')
        select manifest_key, accession_number, row_number() over (partition by manifest_key order by coalesce(try_cast(x.seq as integer), 2147483647), pos) - 1 place, x.type as type, x.filename as filename from f where coalesce(x.s3_key, '') <> ''""",
}

"""Queries of the relational operators, each beside the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerline.functions import dates, evidence, text
from ledgerline.operators import classify, graph, prose, publish, rollup, segmenting
from ledgerline.sources.tables import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function's name, with its SQL where SQL can express it."""

    def register(build):
        QUERIES[build.__name__] = build
        if sql:
            SQL[build.__name__] = sql
        return build

    return register


_day = lambda c: F.date_format(c, "yyyy-MM-dd")


@query("""
select o_custkey as entity, strftime(min(o_orderdate), '%Y-%m-%d') first_seen, strftime(max(o_orderdate), '%Y-%m-%d') last_seen, count(*) observations,
  count(distinct o_orderpriority) priorities, arg_max(o_totalprice, (o_orderdate, o_orderkey)) filter (o_orderstatus = 'F') newest_final_price,
  arg_max(o_orderkey, (o_orderdate, o_orderkey)) filter (o_orderstatus = 'F') newest_final_from,
  arg_min(o_orderkey, (o_orderdate, o_orderkey)) seed, bool_and(o_orderstatus = 'F') all_final,
  case max(case o_orderstatus when 'P' then 2 when 'O' then 1 else 0 end) when 2 then 'P' when 1 then 'O' else 'F' end worst_status
from orders group by 1""")
def entity_rollup(spark: SparkSession, d: str) -> DataFrame:
    """Every entity's observations in one row: span, counts, newest values with the record they come from, worst status."""
    final = F.col("o_orderstatus") == "F"
    recency = (F.col("o_orderdate"), F.col("o_orderkey"))
    rank = F.when(F.col("o_orderstatus") == "P", 2).when(F.col("o_orderstatus") == "O", 1).otherwise(0)
    rolled = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("entity")).agg(
        _day(F.min("o_orderdate")).alias("first_seen"), _day(F.max("o_orderdate")).alias("last_seen"), F.count("*").alias("observations"), F.countDistinct("o_orderpriority").alias("priorities"),
        rollup.newest(F.when(final, F.col("o_totalprice")), *recency).alias("newest_final_price"), rollup.newest(F.when(final, F.col("o_orderkey")), *recency).alias("newest_final_from"),
        rollup.oldest(F.col("o_orderkey"), *recency).alias("seed"), F.bool_and(final).alias("all_final"), F.max(rank).alias("_worst"),
    )
    return rolled.withColumn("worst_status", F.when(F.col("_worst") == 2, "P").when(F.col("_worst") == 1, "O").otherwise("F")).drop("_worst")


@query("""
with m as (select distinct * exclude (synthesized_by) from mentions where cik is not null)
select lpad(ltrim(cik, '0'), 10, '0') cik, arg_max(company_name, (coalesce(date, ''), coalesce(accession_number, ''), debt_instrument_mention_id)) filter (company_name is not null) company_name,
  arg_max(debt_instrument_mention_id, (coalesce(date, ''), coalesce(accession_number, ''), debt_instrument_mention_id)) filter (company_name is not null) company_name_from,
  min(date) first_seen, max(date) last_seen, count(distinct debt_instrument_mention_id) mentions, count(distinct accession_number) filings
from m group by 1""")
def issuer_rollup(spark: SparkSession, d: str) -> DataFrame:
    """Every issuer's mentions rolled up, the newest company name with the mention it comes from."""
    rows = table(spark, d, "mentions", "debt_instrument_mention_id", "cik", "company_name", "date", "accession_number").where("cik is not null").withColumn("cik", text.normalize_cik(F.regexp_replace("cik", "^0+", "")))
    key = (F.coalesce("date", F.lit("")), F.coalesce("accession_number", F.lit("")), F.col("debt_instrument_mention_id"))
    named = F.when(F.col("company_name").isNotNull(), F.col("debt_instrument_mention_id"))
    return rows.groupBy("cik").agg(
        rollup.newest(F.col("company_name"), *key).alias("company_name"), rollup.newest(named, *key).alias("company_name_from"), F.min("date").alias("first_seen"), F.max("date").alias("last_seen"),
        F.countDistinct("debt_instrument_mention_id").alias("mentions"), F.countDistinct("accession_number").alias("filings"),
    )


@query("""
select l_partkey, arg_max(l_extendedprice, (l_returnflag <> 'N', l_shipdate, l_orderkey, l_linenumber)) price,
  arg_max(l_orderkey, (l_returnflag <> 'N', l_shipdate, l_orderkey, l_linenumber)) price_from, bool_and(l_returnflag = 'N') derived_only
from lineitem group by 1""")
def stated_over_derived(spark: SparkSession, d: str) -> DataFrame:
    """The newest stated value of each entity, else its newest derived one."""
    key = F.struct(F.col("l_returnflag") != "N", "l_shipdate", "l_orderkey", "l_linenumber")
    rows = table(spark, d, "lineitem", "l_partkey", "l_extendedprice", "l_orderkey", "l_linenumber", "l_shipdate", "l_returnflag")
    return rows.groupBy("l_partkey").agg(F.max_by("l_extendedprice", key).alias("price"), F.max_by("l_orderkey", key).alias("price_from"), F.bool_and(F.col("l_returnflag") == "N").alias("derived_only"))


@query("""
with m as (select distinct debt_instrument_mention_id id, item_id, cast(principal_amount as varchar) amount, principal_currency currency, principal_amount_kind kind, coalesce(date, '') date from mentions)
select item_id, (arg_max({'a': amount, 'c': currency, 'k': kind, 'i': id}, (date, id)) filter (amount is not null)).a amount,
  (arg_max({'a': amount, 'c': currency, 'k': kind, 'i': id}, (date, id)) filter (amount is not null)).c currency,
  (arg_max({'a': amount, 'c': currency, 'k': kind, 'i': id}, (date, id)) filter (amount is not null)).k kind,
  (arg_max({'a': amount, 'c': currency, 'k': kind, 'i': id}, (date, id)) filter (amount is not null)).i amount_from
from m group by 1""")
def principal_bundle(spark: SparkSession, d: str) -> DataFrame:
    """Amount, currency and kind of one and the same mention: the newest of the item that has an amount."""
    rows = table(spark, d, "mentions", "item_id", "debt_instrument_mention_id", "principal_amount", "principal_currency", "principal_amount_kind", "date")
    bundle = F.struct(F.col("principal_amount").cast("string").alias("amount"), F.col("principal_currency").alias("currency"), F.col("principal_amount_kind").alias("kind"), F.col("debt_instrument_mention_id").alias("amount_from"))
    best = F.max_by(F.when(F.col("principal_amount").isNotNull(), bundle), F.when(F.col("principal_amount").isNotNull(), F.struct(F.coalesce("date", F.lit("")), "debt_instrument_mention_id")))
    return rows.groupBy("item_id").agg(best.alias("b")).select("item_id", "b.amount", "b.currency", "b.kind", "b.amount_from")


@query("""
with p as (select distinct lpad(ltrim(cik, '0'), 10, '0') cik, unnest(from_json(parties_json, '[{"role":"VARCHAR","canonical_name":"VARCHAR","kind":"VARCHAR"}]')) x from mentions where cik is not null),
n as (select cik, x.role as role, x.canonical_name as name, trim(regexp_replace(regexp_replace(lower(x.canonical_name), '[.'']', '', 'g'), '[^a-z0-9]+', ' ', 'g')) k from p where x.kind = 'named')
select cik, role, k party, min(name) canonical_name, count(distinct name) spellings from n group by 1, 2, 3""")
def party_dedupe(spark: SparkSession, d: str) -> DataFrame:
    """The parties of each issuer by role and folded name, with the first spelling."""
    parties = F.explode(F.from_json("parties_json", "array<struct<role: string, canonical_name: string, kind: string>>"))
    rows = table(spark, d, "mentions", "cik", "parties_json").where("cik is not null").select(F.lpad(F.regexp_replace("cik", "^0+", ""), 10, "0").alias("cik"), parties.alias("p")).where("p.kind = 'named'")
    key = F.trim(F.regexp_replace(F.regexp_replace(F.lower("p.canonical_name"), "[.']", ""), "[^a-z0-9]+", " "))
    return rows.groupBy("cik", F.col("p.role").alias("role"), key.alias("party")).agg(F.min("p.canonical_name").alias("canonical_name"), F.countDistinct("p.canonical_name").alias("spellings"))


@query("""
with i as (select item_id, item, accession_number, '8-K' form_type from classifications union all select item_id, item, accession_number, '6-K' from sixk_snippets)
select distinct item_id, item, accession_number, form_type from i where item_id in (select item_id from mentions where item_id is not null)""")
def referenced_items(spark: SparkSession, d: str) -> DataFrame:
    """Items of both genres that some mention cites, stamped with their form type."""
    columns = ("item_id", "item", "accession_number")
    items = table(spark, d, "classifications", *columns).withColumn("form_type", F.lit("8-K")).unionByName(table(spark, d, "sixk_snippets", *columns).withColumn("form_type", F.lit("6-K")))
    return items.join(table(spark, d, "mentions", "item_id"), "item_id", "left_semi").distinct()


@query("""
select distinct replace(accession_number, '-', '') accession_number, filing_date from filing_manifests m
where not exists (select 1 from documents d where d.accession_number = replace(m.accession_number, '-', ''))""")
def unseen_filings(spark: SparkSession, d: str) -> DataFrame:
    """Filings whose document hasn't been taken in."""
    filings = table(spark, d, "filing_manifests", "accession_number", "filing_date").withColumn("accession_number", text.normalize_accession(F.col("accession_number")))
    return filings.distinct().join(table(spark, d, "documents", "accession_number"), "accession_number", "left_anti")


@query("""
select event_id, strftime(ts, '%Y-%m-%d') as day, event_type, value, 'kept' origin from events where strftime(ts, '%Y-%m-%d') not in (select strftime(ts, '%Y-%m-%d') from events where event_id % 97 = 0)
union all select event_id, strftime(ts, '%Y-%m-%d'), event_type, value * 2, 'fresh' from events where event_id % 97 = 0""")
def replace_by_source(spark: SparkSession, d: str) -> DataFrame:
    """A table after the sources of some rows were processed anew: their old rows go, the new ones come."""
    events = table(spark, d, "events").select("event_id", _day("ts").alias("day"), "event_type", "value")
    fresh = events.where("event_id % 97 = 0").withColumn("value", F.col("value") * 2).withColumn("origin", F.lit("fresh"))
    return rollup.replace_by_source(events.withColumn("origin", F.lit("kept")), fresh, ["day"])


@query("""
select item_id, accession_number, lpad(ltrim(cik, '0'), 10, '0') cik, '8-K' form_type, label, null::bigint sixk_token_count from classifications
union all select item_id, accession_number, lpad(ltrim(cik, '0'), 10, '0'), '6-K', label, sixk_token_count from sixk_snippets""")
def genre_union(spark: SparkSession, d: str) -> DataFrame:
    """Both genres' items under one schema; what a genre lacks is null."""
    columns = ["item_id", "accession_number", "cik", "label"]
    both = table(spark, d, "classifications", *columns).withColumn("form_type", F.lit("8-K")).unionByName(table(spark, d, "sixk_snippets", *columns, "sixk_token_count").withColumn("form_type", F.lit("6-K")), allowMissingColumns=True)
    return both.withColumn("cik", F.lpad(F.regexp_replace("cik", "^0+", ""), 10, "0"))


_DIGEST = """select cik, sha256(string_agg(r, chr(10) order by r)) digest from (select distinct cik, sha256(coalesce(debt_instrument_mention_id, chr(0)) || chr(31) || coalesce(date, chr(0)) || chr(31) || coalesce(name, chr(0))) r
from mentions where cik is not null %s) group by 1"""


@query(f"""
with now as ({_DIGEST % ''}), before as ({_DIGEST % "and date < '2025-06-01'"})
select coalesce(n.cik, b.cik) cik, case when b.cik is null then 'added' when n.cik is null then 'removed' else 'changed' end change
from now n full outer join before b on n.cik = b.cik where n.digest is distinct from b.digest""")
def digest_diff(spark: SparkSession, d: str) -> DataFrame:
    """Issuers whose set of mentions differs from what it was."""
    rows = table(spark, d, "mentions", "cik", "debt_instrument_mention_id", "date", "name").where("cik is not null")
    columns = ("debt_instrument_mention_id", "date", "name")
    return rollup.changed_keys(rollup.set_digest(rows, "cik", *columns), rollup.set_digest(rows.where("date < '2025-06-01'"), "cik", *columns), "cik")


@query("""
select manifest_key, replace(accession_number, '-', '') accession_number, form_type, filing_date, strftime(last_scraped_at, '%Y-%m-%d %H:%M:%S') last_scraped_at
from (select *, row_number() over (partition by manifest_key order by last_scraped_at desc, coalesce(form_type, '') desc, coalesce(accession_number, '') desc) r from filing_manifests) where r = 1""")
def keep_last_dedupe(spark: SparkSession, d: str) -> DataFrame:
    """The last scrape of every manifest."""
    rows = table(spark, d, "filing_manifests", "manifest_key", "accession_number", "form_type", "filing_date", "last_scraped_at")
    kept = rollup.keep_last(rows, ["manifest_key"], F.col("last_scraped_at"), F.coalesce("form_type", F.lit("")), F.coalesce("accession_number", F.lit("")))
    return kept.withColumn("accession_number", text.normalize_accession(F.col("accession_number"))).withColumn("last_scraped_at", F.date_format("last_scraped_at", "yyyy-MM-dd HH:mm:ss"))


@query("select l_orderkey, l_linenumber, l_partkey, l_suppkey from (select *, row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey, l_extendedprice) r from lineitem) where r = 1")
def keep_first_dedupe(spark: SparkSession, d: str) -> DataFrame:
    """The first row of every key in a given order."""
    rows = table(spark, d, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    return rollup.keep_first(rows, ["l_orderkey"], *(F.col(c) for c in ("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"))).drop("l_extendedprice")


@query("""
with q as (select distinct l_partkey, l_suppkey, max(l_discount) over (partition by l_partkey, l_suppkey) score from lineitem),
r as (select *, row_number() over (partition by l_partkey order by score desc, l_suppkey) candidate_rank, first_value(score) over (partition by l_partkey order by score desc, l_suppkey) top from q)
select l_partkey, l_suppkey, score, candidate_rank, top - score <= 0.0100001 within_margin from r""")
def candidate_rank_margin(spark: SparkSession, d: str) -> DataFrame:
    """Candidates of each entity ranked by score, and whether they come close to the best."""
    scored = table(spark, d, "lineitem", "l_partkey", "l_suppkey", "l_discount").groupBy("l_partkey", "l_suppkey").agg(F.max("l_discount").alias("score"))
    order = Window.partitionBy("l_partkey").orderBy(F.desc("score"), "l_suppkey")
    ranked = scored.withColumn("candidate_rank", F.row_number().over(order).cast("long")).withColumn("_top", F.first("score").over(order))
    return ranked.withColumn("within_margin", F.col("_top") - F.col("score") <= 0.0100001).drop("_top")


@query("""
with r as (select p_partkey, p_brand, p_size, dense_rank() over (partition by p_brand order by p_size) k from part)
select c.p_partkey child, min(p.p_partkey) parent from r c join r p on p.p_brand = c.p_brand and p.k = c.k - 1 group by 1 having count(*) = 1""")
def previous_rank_link(spark: SparkSession, d: str) -> DataFrame:
    """Each row linked to the one row of the next lower rank that occurs in its group; ties give no link."""
    ranked = table(spark, d, "part", "p_partkey", "p_brand", "p_size").withColumn("k", F.dense_rank().over(Window.partitionBy("p_brand").orderBy("p_size")))
    # a lower rank with a single row is all that can give a link: the rest needs no join
    single = ranked.groupBy("p_brand", "k").agg(F.min("p_partkey").alias("parent"), F.count("*").alias("n")).where("n = 1").select("p_brand", (F.col("k") + 1).alias("k"), "parent")
    return ranked.join(single, ["p_brand", "k"]).select(F.col("p_partkey").alias("child"), "parent")


@query("""
with e as (select distinct m.item_id child, p.item_id parent from mentions m join mentions p on m.amendment_of = p.debt_instrument_mention_id where m.item_id <> p.item_id)
select child, min(parent) parent from e group by 1 having count(distinct parent) = 1""")
def unique_parent(spark: SparkSession, d: str) -> DataFrame:
    """Items whose mentions' amendment pointers all lead to one other item, with that item."""
    rows = table(spark, d, "mentions", "debt_instrument_mention_id", "item_id", "amendment_of")
    targets = rows.select(F.col("debt_instrument_mention_id").alias("amendment_of"), F.col("item_id").alias("parent")).distinct()
    led = rows.select(F.col("item_id").alias("child"), "amendment_of").where("amendment_of is not null").distinct().join(targets, "amendment_of").where("child <> parent")
    return led.groupBy("child").agg(rollup.single_or_null(F.col("parent")).alias("parent")).where("parent is not null")


@query("""
select a.c_custkey a, b.c_custkey b from customer a join customer b on a.c_nationkey = b.c_nationkey and a.c_mktsegment = b.c_mktsegment and a.c_custkey < b.c_custkey
and abs(a.c_acctbal - b.c_acctbal) < 50""")
def blocked_theta_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Pairs within a block whose values are near: the value's band is part of the block, so a block is never paired out."""
    rows = table(spark, d, "customer", "c_custkey", "c_nationkey", "c_mktsegment", "c_acctbal").withColumn("band", F.floor(F.col("c_acctbal") / 50))
    reach = rows.withColumn("band", F.explode(F.array(F.col("band") - 1, F.col("band"), F.col("band") + 1)))
    a, b = rows.alias("a"), reach.alias("b")
    same = [F.col(f"a.{c}") == F.col(f"b.{c}") for c in ("c_nationkey", "c_mktsegment", "band")]
    near = (F.abs(F.col("a.c_acctbal") - F.col("b.c_acctbal")) < 50) & (F.col("a.c_custkey") < F.col("b.c_custkey"))
    return a.join(b, same[0] & same[1] & same[2] & near).select(F.col("a.c_custkey").alias("a"), F.col("b.c_custkey").alias("b"))


@query("""
with n as (select distinct p_brand, string_split(lower(p_name), ' ') w, lower(p_name) name from part),
c as (select p_brand, lower(p_name) name, count(*) n from part group by 1, 2)
select a.p_brand, a.name, cast(sum(c.n) as bigint) class_size from n a join n b on a.p_brand = b.p_brand and (a.name = b.name or ((list_has_all(a.w, b.w) or list_has_all(b.w, a.w)) and least(len(a.w), len(b.w)) >= 2))
join c on c.p_brand = b.p_brand and c.name = b.name group by 1, 2""")
def name_class_size(spark: SparkSession, d: str) -> DataFrame:
    """How many rows of a group bear a name's own or a compatible name, decided once per pair of distinct names."""
    counts = table(spark, d, "part", "p_brand", "p_name").groupBy("p_brand", F.lower("p_name").alias("name")).agg(F.count("*").alias("n")).withColumn("w", F.split("name", " "))
    # the smaller word set lies within the larger, so it meets it at its first word
    small = counts.select("p_brand", F.col("name").alias("s"), F.col("w").alias("sw"), F.array_min("w").alias("word"))
    large = counts.select("p_brand", F.col("name").alias("l"), F.col("w").alias("lw"), F.explode(F.array_distinct("w")).alias("word"))
    pairs = small.join(large, ["p_brand", "word"]).where((F.col("s") != F.col("l")) & (F.size(F.array_except("sw", "lw")) == 0) & (F.least(F.size("sw"), F.size("lw")) >= 2)).select("p_brand", "s", "l")
    both = pairs.select("p_brand", F.col("s").alias("name"), F.col("l").alias("other")).unionByName(pairs.select("p_brand", F.col("l").alias("name"), F.col("s").alias("other"))).unionByName(counts.select("p_brand", "name", F.col("name").alias("other"))).distinct()
    return both.join(counts.select("p_brand", F.col("name").alias("other"), "n"), ["p_brand", "other"]).groupBy("p_brand", "name").agg(F.sum("n").alias("class_size"))


@query("""
with recursive e as (select distinct amendment_of a, debt_instrument_mention_id b from mentions m where amendment_of in (select debt_instrument_mention_id from mentions) and amendment_of <> debt_instrument_mention_id),
u as (select a, b from e union select b, a from e),
r(n, m) as (select distinct a, a from u union select u.b, r.m from r join u on u.a = r.n where r.m < u.b)
select n as node, least(min(m), n) component from r group by n""")
def connected_families(spark: SparkSession, d: str) -> DataFrame:
    """Families of mentions connected by amendment pointers, named by their smallest member."""
    rows = table(spark, d, "mentions", "debt_instrument_mention_id", "amendment_of")
    edges = rows.where("amendment_of is not null and amendment_of <> debt_instrument_mention_id").distinct().join(rows.select(F.col("debt_instrument_mention_id").alias("amendment_of")), "amendment_of", "left_semi")
    return graph.connected_components(edges, "debt_instrument_mention_id", "amendment_of")


@query("""
with e as (select o_orderkey, lag(o_orderkey) over (partition by o_custkey order by o_orderdate, o_orderkey) parent from orders),
c as (select parent, count(*) n, max(o_orderkey) child from e where parent is not null group by 1)
select o.o_orderkey, case when c.n = 1 then c.child end superseded_by, c.n is null is_head from orders o left join c on c.parent = o.o_orderkey""")
def superseded_heads(spark: SparkSession, d: str) -> DataFrame:
    """Each record with the one that supersedes it; heads are superseded by none."""
    orders = table(spark, d, "orders", "o_orderkey", "o_custkey", "o_orderdate")
    chain = orders.withColumn("parent", F.lag("o_orderkey").over(Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")))
    child = chain.where("parent is not null").groupBy("parent").agg(F.count("*").alias("n"), F.max("o_orderkey").alias("child"))
    return orders.join(child, orders["o_orderkey"] == child["parent"], "left").select("o_orderkey", F.when(F.col("n") == 1, F.col("child")).alias("superseded_by"), F.col("n").isNull().alias("is_head"))


@query("""
select debt_instrument_mention_id, case when lower(trim(name)) in ('nan', 'none', 'null', '<na>', 'n/a', '') then null else trim(name) end as name,
case when lower(trim(maturity_date)) in ('nan', 'none', 'null', '<na>', 'n/a', '') then null else trim(maturity_date) end maturity_date,
case when lower(trim(status)) in ('nan', 'none', 'null', '<na>', 'n/a', '') then null else trim(status) end status from mentions""")
def placeholder_nulling(spark: SparkSession, d: str) -> DataFrame:
    """Texts that stand for a missing value become null, in every text column."""
    rows = table(spark, d, "mentions", "debt_instrument_mention_id", "name", "maturity_date", "status")
    return rows.select("debt_instrument_mention_id", *(text.coerce_text(F.col(c)).alias(c) for c in ("name", "maturity_date", "status")))


@query("""
select o_orderkey, cast(cast(cast(o_totalprice as varchar) as decimal(38,2)) as varchar) amount, cast(cast(cast(o_totalprice / 1000 as decimal(18,6)) as decimal(9,4)) as varchar) rate, strftime(o_orderdate, '%Y-%m-%d') as day from orders""")
def declared_types(spark: SparkSession, d: str) -> DataFrame:
    """Money and rates under their declared decimal types, dates as text."""
    return table(spark, d, "orders").select(
        "o_orderkey", F.col("o_totalprice").cast("string").cast("decimal(38,2)").cast("string").alias("amount"),
        (F.col("o_totalprice") / 1000).cast("decimal(18,6)").cast("decimal(9,4)").cast("string").alias("rate"), _day("o_orderdate").alias("day"),
    )


@query("select substr(date, 1, 7) as month, count(*) as n, count(distinct accession_number) accessions from mentions group by 1")
def month_layout(spark: SparkSession, d: str) -> DataFrame:
    """Rows per month partition."""
    return table(spark, d, "mentions", "date", "accession_number").groupBy(F.substring("date", 1, 7).alias("month")).agg(F.count("*").alias("n"), F.countDistinct("accession_number").alias("accessions"))


@query()
def shard_layout(spark: SparkSession, d: str) -> DataFrame:
    """Rows per date and crc32 shard of the accession number."""
    return table(spark, d, "documents", "date", "accession_number").groupBy("date", text.shard(F.col("accession_number")).alias("shard")).agg(F.count("*").alias("n"))


@query("""
select 'documents' as name, (select count(*) from documents where date < '2025-01-01') as before, (select count(*) from documents) as now, (select count(*) from documents) < 0.5 * (select count(*) from documents where date < '2025-01-01') refused
union all select 'mentions', (select count(*) from mentions), (select count(*) from mentions where date < '2023-06-01'), (select count(*) from mentions where date < '2023-06-01') < 0.5 * (select count(*) from mentions)""")
def shrink_guard(spark: SparkSession, d: str) -> DataFrame:
    """Whether a new snapshot has so many rows less than the last that it must not be published."""
    documents, mentions = table(spark, d, "documents", "date"), table(spark, d, "mentions", "date")
    count = lambda df, when, name: df.agg(F.count(F.when(when, 1)).alias(name))
    one = documents.agg(F.count(F.when(F.col("date") < "2025-01-01", 1)).alias("before"), F.count("*").alias("now")).withColumn("name", F.lit("documents"))
    two = mentions.agg(F.count("*").alias("before"), F.count(F.when(F.col("date") < "2023-06-01", 1)).alias("now")).withColumn("name", F.lit("mentions"))
    return one.unionByName(two).select("name", "before", "now", publish.shrunk(F.col("before"), F.col("now")).alias("refused"))


@query("""
select case when amounts_json is null then 'missing' when not json_valid(amounts_json) then 'not json' when json_type(amounts_json) <> 'ARRAY' then 'not a list' when json_array_length(amounts_json) = 0 then 'empty'
when json_extract_string(amounts_json, '$[0].kind') is null then 'no kind' when json_extract_string(amounts_json, '$[0].currency') is null then 'no currency' else 'ok' end problem, count(*) as n from mentions group by 1""")
def payload_check(spark: SparkSession, d: str) -> DataFrame:
    """How many payloads break which rule of their contract, by their first fact; payload_facts_check reads all facts."""
    payload = table(spark, d, "mentions", "amounts_json").withColumn("v", F.try_parse_json("amounts_json"))
    kind = F.schema_of_variant("v")
    first = lambda key: F.get_json_object("amounts_json", f"$[0].{key}")
    problem = (
        F.when(F.col("amounts_json").isNull(), "missing").when(F.col("v").isNull(), "not json").when(~kind.startswith("ARRAY"), "not a list").when(F.size(F.from_json("amounts_json", "array<string>")) == 0, "empty")
        .when(first("kind").isNull(), "no kind").when(first("currency").isNull(), "no currency").otherwise("ok")
    )
    return payload.groupBy(problem.alias("problem")).agg(F.count("*").alias("n"))


@query("""
select case when amounts_json is null then 'missing' when not json_valid(amounts_json) then 'not json' when json_type(amounts_json) <> 'ARRAY' then 'not a list' when json_array_length(amounts_json) = 0 then 'empty'
when list_count(json_extract_string(amounts_json, '$[*].kind')) < json_array_length(amounts_json) then 'no kind' when list_count(json_extract_string(amounts_json, '$[*].currency')) < json_array_length(amounts_json) then 'no currency' else 'ok' end problem, count(*) as n from mentions group by 1""")
def payload_facts_check(spark: SparkSession, d: str) -> DataFrame:
    """How many payloads break which rule of their contract in any of their facts."""
    payload = table(spark, d, "mentions", "amounts_json").withColumn("v", F.try_parse_json("amounts_json"))
    kind = F.schema_of_variant("v")
    facts = F.from_json("amounts_json", "array<string>")
    lacks = lambda key: F.exists(facts, lambda x: F.get_json_object(x, f"$.{key}").isNull())
    problem = (
        F.when(F.col("amounts_json").isNull(), "missing").when(F.col("v").isNull(), "not json").when(~kind.startswith("ARRAY"), "not a list").when(F.size(facts) == 0, "empty")
        .when(lacks("kind"), "no kind").when(lacks("currency"), "no currency").otherwise("ok")
    )
    return payload.groupBy(problem.alias("problem")).agg(F.count("*").alias("n"))


@query("""
with f as (select distinct debt_instrument_mention_id id, unnest(from_json(dates_json, '[{"kind":"VARCHAR","normalized_date":"VARCHAR","prior":"BOOLEAN","expected":"BOOLEAN"}]')) x, generate_subscripts(from_json(dates_json, '["JSON"]'), 1) pos from mentions)
select id as debt_instrument_mention_id, arg_min(x.kind, pos) kind, arg_min(x.normalized_date, pos) as day from f where x.kind in ('closing', 'amendment', 'announcement') and not coalesce(x.prior, false) and not coalesce(x.expected, false) group by 1""")
def json_fact_filter(spark: SparkSession, d: str) -> DataFrame:
    """The first fact of certain kinds that is neither prior nor expected."""
    facts = F.from_json("dates_json", "array<struct<kind: string, normalized_date: string, prior: boolean, expected: boolean>>")
    wanted = F.filter(facts, lambda x: x["kind"].isin("closing", "amendment", "announcement") & ~F.coalesce(x["prior"], F.lit(False)) & ~F.coalesce(x["expected"], F.lit(False)))
    rows = table(spark, d, "mentions", "debt_instrument_mention_id", "dates_json").distinct().select("debt_instrument_mention_id", F.get(wanted, F.lit(0)).alias("f"))
    return rows.where("f is not null").select("debt_instrument_mention_id", "f.kind", F.col("f.normalized_date").alias("day"))


@query("""
with f as (select distinct debt_instrument_mention_id id, date, unnest(from_json(dates_json, '[{"kind":"VARCHAR","normalized_date":"VARCHAR"}]')) x from mentions)
select id as debt_instrument_mention_id, x.kind as kind, count(*) as n, count(*) filter (x.normalized_date > date) expected from f group by 1, 2""")
def post_filing_expected(spark: SparkSession, d: str) -> DataFrame:
    """How many dated events of a mention lie after its filing, and so are expected only."""
    facts = F.explode(F.from_json("dates_json", "array<struct<kind: string, normalized_date: string>>"))
    rows = table(spark, d, "mentions", "debt_instrument_mention_id", "date", "dates_json").distinct().select("debt_instrument_mention_id", "date", facts.alias("x")).distinct()
    return rows.groupBy("debt_instrument_mention_id", F.col("x.kind").alias("kind")).agg(F.count("*").alias("n"), F.count(F.when(F.col("x.normalized_date") > F.col("date"), 1)).alias("expected"))


@query("""
with t as (select o_orderkey, case o_orderkey % 4 when 0 then strftime(o_orderdate, '%Y-%m-%d') when 1 then strftime(o_orderdate, '%-m/%-d/%Y') when 2 then strftime(o_orderdate, '%B %-d, %Y') else '13/45/2020' end w from orders)
select o_orderkey, w as written, case o_orderkey % 4 when 0 then strftime(strptime(w, '%Y-%m-%d'), '%Y-%m-%d') when 1 then strftime(strptime(w, '%-m/%-d/%Y'), '%Y-%m-%d') when 2 then strftime(strptime(w, '%B %-d, %Y'), '%Y-%m-%d') end as day from t""")
def date_parse(spark: SparkSession, d: str) -> DataFrame:
    """Dates in several spellings read to ISO text; what is no date gives null."""
    kind = F.col("o_orderkey") % 4
    written = F.when(kind == 0, _day("o_orderdate")).when(kind == 1, F.date_format("o_orderdate", "M/d/yyyy")).when(kind == 2, F.date_format("o_orderdate", "MMMM d, yyyy")).otherwise("13/45/2020")
    return table(spark, d, "orders", "o_orderkey", "o_orderdate").select("o_orderkey", written.alias("written")).withColumn("day", dates.iso_date(F.col("written")))


@query("""
select o_orderkey, strftime(cast(o_orderdate as date) + to_months(cast(o_orderkey % 40 as integer)), '%Y-%m-%d') months_on, strftime(cast(o_orderdate as date) + to_days(cast(o_orderkey % 40 as integer)), '%Y-%m-%d') days_on from orders""")
def tenor_add(spark: SparkSession, d: str) -> DataFrame:
    """A date plus a tenor, months clamped to their ends."""
    day, n = F.to_date("o_orderdate"), (F.col("o_orderkey") % 40).cast("int")
    return table(spark, d, "orders", "o_orderkey", "o_orderdate").select("o_orderkey", _day(dates.plus_tenor(day, n, F.lit("month"))).alias("months_on"), _day(dates.plus_tenor(day, n, F.lit("day"))).alias("days_on"))


@query("""
select o_orderkey, '$' || cast(cast(o_totalprice / 1000 as decimal(18,1)) as varchar) || ' thousand' as written, cast(cast(cast(o_totalprice / 1000 as decimal(18,1)) * 1000 as decimal(38,2)) as varchar) amount from orders""")
def amount_parse(spark: SparkSession, d: str) -> DataFrame:
    """Written amounts read back to whole units by figure and scale word (Column expressions)."""
    rows = table(spark, d, "orders", "o_orderkey", "o_totalprice").select("o_orderkey", F.concat(F.lit("$"), (F.col("o_totalprice") / 1000).cast("decimal(18,1)").cast("string"), F.lit(" thousand")).alias("written"))
    return rows.withColumn("amount", evidence.amount(F.col("written")).cast("decimal(38,2)").cast("string"))


@query("""
with s as (select user_id, event_type, ts, event_id, case event_type when 'error' then 4 when 'purchase' then 3 when 'signup' then 2 when 'click' then 1 else 0 end p from events)
select user_id, arg_max(event_type, (cast(ts as date), p, event_id)) status, strftime(max(ts), '%Y-%m-%d') status_date from s group by 1""")
def status_from_events(spark: SparkSession, d: str) -> DataFrame:
    """The status of an entity from its newest event, ties by precedence of kinds."""
    rank = F.when(F.col("event_type") == "error", 4).when(F.col("event_type") == "purchase", 3).when(F.col("event_type") == "signup", 2).when(F.col("event_type") == "click", 1).otherwise(0)
    return table(spark, d, "events", "user_id", "event_type", "ts", "event_id").groupBy("user_id").agg(
        F.max_by("event_type", F.struct(F.to_date("ts"), rank, "event_id")).alias("status"), _day(F.max("ts")).alias("status_date")
    )


_LEMMAS = "|".join(text.GATE_LEMMAS)


@query(f"select doc_id, coalesce(regexp_matches(text, '(?i)\\b(?:{_LEMMAS})(?:s|es)?\\b'), false) passes from documents")
def keyword_gate(spark: SparkSession, d: str) -> DataFrame:
    """Whether whole documents hold one of the gate's lemmas."""
    return table(spark, d, "documents", "doc_id", "text").select("doc_id", text.passes_gate(F.col("text")).alias("passes"))


def _quoted(pattern: str) -> str:
    return pattern.replace("'", "''")


@query(rf"""
with l as (select distinct doc_id, form_type, text, list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(x)), lambda x: x <> '' and not regexp_matches(x, '{_quoted(prose.COVER)}')) w from documents),
h as (select *, substr(trim(regexp_replace(array_to_string(w, ' '), '\s+', ' ', 'g')), 1, 1000) head from l),
p as (select *, case when regexp_matches(substr(head, 1, 400), '{_quoted(prose.AGREEMENT)}') then length(regexp_extract(substr(head, 1, 400), '(?s)^(.*?)(?:{_quoted(prose.AGREEMENT)})', 1)) end a,
  case when regexp_matches(head, '{_quoted(prose.REPORT)}') then length(regexp_extract(head, '(?s)^(.*?)(?:{_quoted(prose.REPORT)})', 1)) end r, len(regexp_extract_all(text, '{_quoted(prose.STATEMENT)}')) s from h),
k as (select doc_id, case when regexp_matches(coalesce(trim(form_type), ''), '{prose.TRANSACTION_TYPES}') then 'exhibit_type' when a is not null and (r is null or a <= r) then 'agreement_title' when r is not null then 'report_title'
  when length(text) >= 30000 and s >= 3 then 'statements' else 'default' end as rule from p)
select doc_id, rule, case when rule in ('report_title', 'statements') then 'report' else 'event' end kind from k""")
def document_kind(spark: SparkSession, d: str) -> DataFrame:
    """Event or report, by the first rule that holds."""
    rows = table(spark, d, "documents", "doc_id", "form_type", "text").distinct()
    return prose.with_kind(rows, "text", "form_type").select("doc_id", "rule", "kind")


@query(r"""
with l as (select doc_id, unnest(string_split(regexp_replace(regexp_replace(text, '(?i)<br\s*/?>|</(?:p|div|tr|li|h[1-6]|table)>', chr(10), 'g'), '<[^<>]*>', ' ', 'g'), chr(10))) w from documents),
t as (select doc_id, trim(regexp_replace(w, '[ \t\r\f\v]+', ' ', 'g')) line from l)
select doc_id, count(*) lines, cast(sum(length(line)) as bigint) chars, min(md5(line)) least_md5 from t where line <> '' group by 1""")
def flatten_lines(spark: SparkSession, d: str) -> DataFrame:
    """Bodies flattened to their non-blank lines: number, length and a check value of the lines."""
    lines = F.explode(F.filter(F.transform(F.split(F.regexp_replace(F.regexp_replace("text", r"(?i)<br\s*/?>|</(?:p|div|tr|li|h[1-6]|table)>", "\n"), "<[^<>]*>", " "), "\n"), lambda w: F.trim(F.regexp_replace(w, r"[ \t\r\f\x0b]+", " "))), lambda w: w != ""))
    rows = table(spark, d, "documents", "doc_id", "text").select("doc_id", lines.alias("line"))
    return rows.groupBy("doc_id").agg(F.count("*").alias("lines"), F.sum(F.length("line")).cast("long").alias("chars"), F.min(F.md5("line")).alias("least_md5"))


@query(r"""
with l as (select doc_id, unnest(string_split(text, chr(10))) w, generate_subscripts(string_split(text, chr(10)), 1) n from documents where text is not null),
h as (select doc_id, n, regexp_extract(w, '^Item (\d\.0\d)', 1) item from l where regexp_matches(w, '^Item \d\.0\d')), e as (select doc_id, max(n) last from l group by 1)
select h.doc_id, h.item, h.n start_line, coalesce(lead(h.n) over (partition by h.doc_id order by h.n) - 1, e.last) end_line from h join e on e.doc_id = h.doc_id""")
def section_spans(spark: SparkSession, d: str) -> DataFrame:
    """Sections as line ranges from one item heading to the line before the next."""
    lines = table(spark, d, "documents", "doc_id", "text").where("text is not null").select("doc_id", F.split("text", "\n").alias("w")).withColumn("last", F.size("w"))
    heads = lines.select("doc_id", "last", F.posexplode("w").alias("n", "line")).where(F.col("line").rlike(r"^Item \d\.0\d")).withColumn("start_line", (F.col("n") + 1).cast("long"))
    after = F.lead("start_line").over(Window.partitionBy("doc_id").orderBy("start_line"))
    return heads.select("doc_id", F.regexp_extract("line", r"^Item (\d\.0\d)", 1).alias("item"), "start_line", F.coalesce(after - 1, F.col("last")).cast("long").alias("end_line"))


@query("""
with s as (select doc_id, text, unnest(generate_series(0, (length(text) - 1) // 1000)) k from documents where length(text) > 0)
select doc_id, k as window, sha256(substr(text, k * 1000 + 1, 1000)) window_sha, sha256(text) source_sha from s""")
def span_rebuild(spark: SparkSession, d: str) -> DataFrame:
    """Windows rebuilt from their offsets, with check values of the window and its source."""
    rows = table(spark, d, "documents", "doc_id", "text").where(F.length("text") > 0)
    spans = rows.withColumn("window", F.explode(F.sequence(F.lit(0), F.floor((F.length("text") - 1) / 1000).cast("long"))))
    spans = spans.select("doc_id", "window", (F.col("window") * 1000).alias("start"), F.least((F.col("window") + 1) * 1000, F.length("text")).alias("end"), F.sha2("text", 256).alias("source_sha256"))
    rebuilt = segmenting.rebuild_windows(spans, rows, "doc_id", "text")
    return rebuilt.select("doc_id", "window", F.sha2("window_text", 256).alias("window_sha"), F.col("source_sha256").alias("source_sha"))


@query("""
with i as (select user_id, epoch_us(ts) // 1000000 s, epoch_us(ts) // 1000000 + 3600 e from events),
m as (select *, case when s <= max(e) over (partition by user_id order by s, e rows between unbounded preceding and 1 preceding) then 0 else 1 end f from i),
g as (select *, sum(f) over (partition by user_id order by s, e rows between unbounded preceding and current row) k from m)
select user_id, min(s) start_s, max(e) end_s, count(*) members from g group by user_id, k""")
def interval_islands(spark: SparkSession, d: str) -> DataFrame:
    """Overlapping intervals of an entity merged."""
    seconds = F.unix_seconds(F.col("ts").cast("timestamp"))
    rows = table(spark, d, "events", "user_id", "ts").select("user_id", seconds.alias("start_s"), (seconds + 3600).alias("end_s"))
    return rollup.islands(rows, "user_id", "start_s", "end_s")


@query("""
with recursive o as (select l_orderkey k, row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey, l_quantity) i, cast(l_quantity as bigint) q from lineitem),
r(k, i, q, held, pack) as (select k, i, q, q, cast(1 as bigint) from o where i = 1 union all
select o.k, o.i, o.q, case when r.held + o.q > 60 then o.q else r.held + o.q end, case when r.held + o.q > 60 then r.pack + 1 else r.pack end from r join o on o.k = r.k and o.i = r.i + 1)
select k as l_orderkey, pack, count(*) as n, cast(sum(q) as bigint) as total from r group by 1, 2""")
def greedy_pack(spark: SparkSession, d: str) -> DataFrame:
    """Items of a group packed in order: a pack is closed where the next item would exceed the budget."""
    rows = table(spark, d, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    lists = rows.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_quantity"))).alias("items"))
    start = F.expr("array(named_struct('held', 0L, 'n', 0L))")
    folded = F.expr("""aggregate(items, array(named_struct('n', 0L, 'total', 0L)), (acc, x) ->
        case when element_at(acc, -1).n > 0 and element_at(acc, -1).total + cast(x.l_quantity as bigint) > 60
             then concat(acc, array(named_struct('n', 1L, 'total', cast(x.l_quantity as bigint))))
             else concat(slice(acc, 1, size(acc) - 1), array(named_struct('n', element_at(acc, -1).n + 1L, 'total', element_at(acc, -1).total + cast(x.l_quantity as bigint)))) end)""")
    del start
    packs = lists.select("l_orderkey", F.posexplode(folded).alias("p", "k"))
    return packs.select("l_orderkey", (F.col("p") + 1).cast("long").alias("pack"), "k.n", "k.total")


@query("""
with s as (select distinct item_id, relevance, classification_score score from classifications where classification_score is not null and relevance is not null),
c as (select score, sum(case when relevance then 1 else 0 end) p, count(*) n from s group by 1),
w as (select score, sum(p) over (order by score desc) tp, sum(n) over (order by score desc) taken, sum(p) over () pos from c)
select score threshold, tp / taken as precision, tp / pos as recall from w where tp / pos >= 0.95 order by score desc limit 1""")
def score_threshold(spark: SparkSession, d: str) -> DataFrame:
    """The highest threshold with the wanted recall, with its precision and recall."""
    rows = table(spark, d, "classifications", "item_id", "relevance", "classification_score").distinct()
    return classify.recall_curve(rows, "classification_score", "relevance").where("recall >= 0.95").orderBy(F.desc("threshold")).limit(1).select("threshold", "precision", "recall")


@query("""
with t as (select distinct item_id, text from sixk_snippets where text is not null and text <> ''), w as (select distinct item_id, unnest(string_split(lower(text), ' ')) w from t)
select item_id, count(*) words from w group by 1""")
def token_sets(spark: SparkSession, d: str) -> DataFrame:
    """Number of distinct words of each text."""
    rows = table(spark, d, "sixk_snippets", "item_id", "text").where("text is not null and text <> ''").distinct()
    return rows.select("item_id", F.explode(F.split(F.lower("text"), " ")).alias("w")).distinct().groupBy("item_id").agg(F.count("*").alias("words"))


@query("""
with a as (select distinct item_id, verdict from classifications), b as (select distinct item_id, label as verdict from classifications)
select 'only_left' side, item_id, verdict from (select * from a except select * from b) union all select 'only_right', item_id, verdict from (select * from b except select * from a)""")
def replay_diff(spark: SparkSession, d: str) -> DataFrame:
    """What two derivations of the same rows don't share, both ways."""
    a, b = table(spark, d, "classifications", "item_id", "verdict").distinct(), table(spark, d, "classifications", "item_id", F.col("label").alias("verdict")).distinct()
    return a.subtract(b).withColumn("side", F.lit("only_left")).unionByName(b.subtract(a).withColumn("side", F.lit("only_right"))).select("side", "item_id", "verdict")


@query("""
with f as (select distinct manifest_key, unnest(from_json(documents_json, '[{"seq":"VARCHAR","description":"VARCHAR","filename":"VARCHAR","type":"VARCHAR"}]')) x from filing_manifests)
select manifest_key, count(*) files, count(*) filter (x.type like 'EX-%') exhibits, min(x.filename) first_name from f group by 1""")
def manifest_documents(spark: SparkSession, d: str) -> DataFrame:
    """The files listed in each manifest."""
    files = F.explode(F.from_json("documents_json", "array<struct<seq: string, description: string, filename: string, type: string>>"))
    rows = table(spark, d, "filing_manifests", "manifest_key", "documents_json").select("manifest_key", files.alias("x")).distinct()
    return rows.groupBy("manifest_key").agg(F.count("*").alias("files"), F.count(F.when(F.col("x.type").startswith("EX-"), 1)).alias("exhibits"), F.min("x.filename").alias("first_name"))

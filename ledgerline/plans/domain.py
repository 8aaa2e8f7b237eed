"""Queries of the core problems over the project's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions import parties, text
from ledgerline.operators import classify, hierarchy, identity, itemizing, matching, prose, publish, segmenting, units
from ledgerline.plans.lineage import cut
from ledgerline.sources.tables import table
from ledgerline.streaming import stages


def _amount_tables(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    mentions = table(spark, d, "mentions", "debt_instrument_mention_id", "item_id", "date", "name", "principal_amount", "principal_currency", "amounts_json")
    return mentions, table(spark, d, "classifications", "item_id", "text").unionByName(table(spark, d, "sixk_snippets", "item_id", "text"))


def _amounts(spark: SparkSession, d: str) -> DataFrame:
    return units.recorded_amounts(*_amount_tables(spark, d))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return units.misrecorded(_amounts(spark, d)).select("debt_instrument_mention_id", "slot").distinct()


def p2_amounts(spark: SparkSession, d: str) -> DataFrame:
    """Every amount in whole units of its stated currency and in US dollars."""
    return units.in_dollars(_amounts(spark, d), table(spark, d, "fx_rates")).select(
        "debt_instrument_mention_id", "slot", "source", "date", "recorded_amount", "recorded_currency", "amount", "currency", "power", "usd_amount"
    )


LINK_FIELDS = {"amendment_of": "amendment_of", "split_of": "split_of"}


def _linked(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "mentions", "debt_instrument_mention_id", *LINK_FIELDS.values())


def _pointers(spark: SparkSession, d: str) -> DataFrame:
    return hierarchy.pointers(_linked(spark, d), "debt_instrument_mention_id", LINK_FIELDS)


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return hierarchy.tops(_pointers(spark, d)).select(F.col("tree").alias("link_field"), F.col("node").alias("debt_instrument_mention_id"), F.col("top").alias("top_mention_id"))


def p5_nodes(spark: SparkSession, d: str) -> DataFrame:
    """Every mention for each field: root, depth, path from the root, number of descendants, state."""
    rows = hierarchy.hierarchy(_pointers(spark, d), hierarchy.all_nodes(_linked(spark, d), "debt_instrument_mention_id", LINK_FIELDS))
    return rows.select(
        F.col("tree").alias("link_field"), F.col("node").alias("debt_instrument_mention_id"), "root", "depth", F.array_join("path", ">").alias("path"), "descendants", "state"
    )


def p5_further_parents(spark: SparkSession, d: str) -> DataFrame:
    """The existing parents of mentions with several that the trees leave out."""
    rows = hierarchy.further_parents(_linked(spark, d), "debt_instrument_mention_id", LINK_FIELDS)
    return rows.select(F.col("tree").alias("link_field"), F.col("node").alias("debt_instrument_mention_id"), F.col("parent").alias("parent_mention_id"))


def p5_descendants(spark: SparkSession, d: str) -> DataFrame:
    """Every ancestor with every descendant."""
    return hierarchy.descendants(_pointers(spark, d)).select(F.col("tree").alias("link_field"), "ancestor", "descendant", "distance")


def p2_scales(spark: SparkSession, d: str) -> DataFrame:
    """Every pair of sources of amounts: robust factor and offset between them, and the known conversion they snap to."""
    return units.source_units(cut(units.recorded_figures(*_amount_tables(spark, d))))[0]


def p2_units(spark: SparkSession, d: str) -> DataFrame:
    """The unit of every source of amounts (records, and each notation of the text) as a power of ten of the whole unit's."""
    return units.source_units(cut(units.recorded_figures(*_amount_tables(spark, d))))[1]


def instrument_edges(spark: SparkSession, d: str) -> DataFrame:
    """Mentions clustered into instruments: member, related and ambiguous edges."""
    return matching.cluster(table(spark, d, "mentions"))


def instrument_rollup(spark: SparkSession, d: str) -> DataFrame:
    """One row per instrument with provenance."""
    mentions = table(spark, d, "mentions")
    return matching.instruments(mentions, cut(matching.cluster(mentions)))


def instrument_lineage(spark: SparkSession, d: str) -> DataFrame:
    """Families of instruments along amendment, split and retirement pointers, what supersedes each, the heads and the pointers."""
    mentions = table(spark, d, "mentions")
    edges = cut(matching.cluster(mentions))
    amended = cut(matching.parent_links(mentions, edges, "amendment_of"))
    links = cut(matching.break_cycles(amended, matching.first_seen(mentions, edges)))
    split, retired = cut(matching.parent_links(mentions, edges, "split_of")), cut(matching.retirer_links(mentions, edges))
    return matching.lifecycle(links, edges.where("edge_type = 'member'").select("instrument_id").distinct(), split, retired)


def inferred_lineage(spark: SparkSession, d: str) -> DataFrame:
    """Restated agreements, as instruments, linked to the predecessor their names imply where their mentions name none."""
    mentions = table(spark, d, "mentions")
    edges = cut(matching.cluster(mentions))
    rows = matching.instruments(mentions, edges).join(matching.parent_links(mentions, edges, "amendment_of").withColumnRenamed("parent_id", "amendment_of"), "instrument_id", "left")
    borrowers = parties.borrower_keys(F.from_json("parties", parties.PARTIES))
    return matching.ordinal_links(rows.select(F.col("instrument_id").alias("id"), "cik", "name", "first_seen", F.col("start_date").alias("start"), borrowers.alias("borrowers"), "amendment_of"))


def item_rollup(spark: SparkSession, d: str) -> DataFrame:
    """The roll-up of instruments over the mentions of each item, as if an item named one instrument."""
    mentions = table(spark, d, "mentions")
    edges = mentions.where("item_id is not null").select(F.col("debt_instrument_mention_id").alias("mention_id"), F.col("item_id").alias("instrument_id"), F.lit("member").alias("edge_type")).distinct()
    return matching.instruments(mentions, edges).drop("parties")


def item_sections(spark: SparkSession, d: str) -> DataFrame:
    """The items every document declares, with their sections."""
    return itemizing.itemize(table(spark, d, "documents", "doc_id", "text"), "doc_id", "text")


def document_items(spark: SparkSession, d: str) -> DataFrame:
    """The items every document heads, declared or not, with their sections."""
    return itemizing.itemize(table(spark, d, "documents", "doc_id", "text"), "doc_id", "text", undeclared=True)


def text_windows(spark: SparkSession, d: str) -> DataFrame:
    """Every document in windows of bounded size, as spans with their source's check value."""
    return segmenting.split_windows(table(spark, d, "documents", "doc_id", "text"), "doc_id", "text")


def prose_bodies(spark: SparkSession, d: str) -> DataFrame:
    """The prose documents of every submission, without prologues of facts, and whether they pass the keyword gate."""
    bodies = prose.without_prologue(prose.prose_documents(table(spark, d, "documents", "doc_id", "text"), "doc_id", "text"), "body")
    return bodies.select("doc_id", "document_index", "document_type", F.char_length("body").alias("chars"), F.sha2("body", 256).alias("source_sha256"), text.passes_gate(F.col("body")).alias("passes"))


def expanded_windows(spark: SparkSession, d: str) -> DataFrame:
    """The windows of every document that pass the keyword gate, with the context before them, merged where they meet."""
    documents = table(spark, d, "documents", "doc_id", "text")
    cut_up = cut(segmenting.split_windows(documents, "doc_id", "text"))
    passing = segmenting.rebuild_windows(cut_up, documents, "doc_id", "text").where("fresh").where(text.passes_gate(F.col("window_text")))
    return prose.expand_windows(passing.select("doc_id", "window", "start", "end"), documents, ["doc_id"], "text")


def item_relevance(spark: SparkSession, d: str) -> DataFrame:
    """Every item's relevance as scored by a linear model fitted on a bounded sample; document frequencies and threshold cover all items."""
    items = table(spark, d, "classifications", "item_id", "text", "relevance").dropDuplicates(["item_id"])
    return classify.fit(items, "item_id", "text", "relevance").score(items, "text").select("item_id", "classification_score", "verdict")


def resolved_redirects(spark: SparkSession, d: str) -> DataFrame:
    """Every id that was replaced, led to the live id at the end of its redirects."""
    rows = table(spark, d, "mentions", "debt_instrument_mention_id", "split_of").distinct()
    redirects = rows.where("split_of is not null").select(F.col("debt_instrument_mention_id").alias("old_id"), F.col("split_of").alias("new_id"))
    return identity.resolve_redirects(redirects, rows.where("split_of is null").select(F.col("debt_instrument_mention_id").alias("instrument_id")))


def carried_ids(spark: SparkSession, d: str) -> DataFrame:
    """Instrument ids kept, and ids led on, when the mentions of the last months join the clustering."""
    mentions = table(spark, d, "mentions")
    before = mentions.where("date < '2025-06-01'")
    now, then = (cut(matching.cluster(rows)) for rows in (mentions, before))
    items = mentions.select(F.col("debt_instrument_mention_id").alias("mention_id"), "item_id").distinct()
    members = lambda edges: edges.where("edge_type = 'member'").select("instrument_id", "mention_id").join(items, "mention_id")
    columns = ("instrument_type", "start_date", "maturity_date", "interest_rate_pct", "principal_amount")
    named = lambda rows: rows.withColumn("fingerprint", text.name_fingerprint(text.coerce_text(F.col("name"))))
    said = identity.content(named(members(now).join(mentions.select(F.col("debt_instrument_mention_id").alias("mention_id"), "name", *columns), "mention_id")))
    stated = identity.content(named(matching.instruments(before, then)))
    seeds = matching.first_seen(mentions, now).select("instrument_id", F.to_json("seen").alias("seed"))
    return identity.carry_over(members(now), members(then), said, stated, seeds)


CONTRACT = {"item_id": "string", "accession_number": "string", "cik": "string", "label": "string", "classification_score": "double", "section_char_count": "bigint", "form_type": "string"}


def published_items(spark: SparkSession, d: str) -> DataFrame:
    """Cited items of both genres under the published contract."""
    both = table(spark, d, "classifications").withColumn("form_type", F.lit("8-K")).unionByName(table(spark, d, "sixk_snippets").withColumn("form_type", F.lit("6-K")), allowMissingColumns=True)
    return publish.conform(both.join(table(spark, d, "mentions", "item_id"), "item_id", "left_semi"), CONTRACT).distinct()


def stream_poll_state(spark: SparkSession, d: str) -> DataFrame:
    """State of every entity after one tick over the events."""
    schema = table(spark, d, "events").schema
    return stages.poll(spark, f"{d}/events.parquet*", schema, stages.fresh_folder(spark, "checkpoint"), stages.fresh_folder(spark, "states"))


QUERIES = {
    "p2_found": p2_found, "p2_amounts": p2_amounts, "p2_scales": p2_scales, "p2_units": p2_units, "p5_found": p5_found, "p5_nodes": p5_nodes, "p5_descendants": p5_descendants, "p5_further_parents": p5_further_parents,
    "resolved_redirects": resolved_redirects, "carried_ids": carried_ids, "instrument_edges": instrument_edges, "instrument_rollup": instrument_rollup, "item_rollup": item_rollup, "instrument_lineage": instrument_lineage, "inferred_lineage": inferred_lineage,
    "item_sections": item_sections, "document_items": document_items, "text_windows": text_windows, "prose_bodies": prose_bodies, "expanded_windows": expanded_windows, "item_relevance": item_relevance, "published_items": published_items, "stream_poll_state": stream_poll_state,
}
SQL = {
    "item_rollup": """
        with m as (select distinct debt_instrument_mention_id id, item_id, accession_number, date, lender_disclosure, principal_amount, principal_currency, principal_amount_kind, interest_rate_kind, interest_rate_pct, amounts_json,
            case when trim(cik) = '' then null else lpad(trim(cik), cast(greatest(10, length(trim(cik))) as integer), '0') end cik, json_extract_string(maturity_date_json, '$.derived_from') derived,
            case when lower(trim(name)) in ('nan', 'none', 'null', '<na>', 'n/a', '') then null else trim(name) end _name, case when lower(trim(instrument_type)) in ('nan', 'none', 'null', '<na>', 'n/a', '') then null else trim(instrument_type) end _instrument_type, case when lower(trim(start_date)) in ('nan', 'none', 'null', '<na>', 'n/a', '') then null else trim(start_date) end _start_date, case when lower(trim(commitment_termination_date)) in ('nan', 'none', 'null', '<na>', 'n/a', '') then null else trim(commitment_termination_date) end _commitment_termination_date, case when lower(trim(company_name)) in ('nan', 'none', 'null', '<na>', 'n/a', '') then null else trim(company_name) end _company_name, case when lower(trim(maturity_date)) in ('nan', 'none', 'null', '<na>', 'n/a', '') then null else trim(maturity_date) end _maturity_date from mentions),
        b as (select *, {'d': coalesce(date, ''), 'a': coalesce(accession_number, ''), 'i': coalesce(item_id, ''), 'm': id} k, coalesce(derived not in ('name', 'computed'), true) stated,
            list_filter(from_json(amounts_json, '[{"kind":"VARCHAR","normalized_amount":"VARCHAR","currency":"VARCHAR","as_of_date":"VARCHAR"}]'), lambda x: x.kind = 'outstanding_balance' and x.normalized_amount is not null)[1] bal from m),
        n as (select cik, arg_max(_company_name, k) issuer from b where _company_name is not null and cik is not null group by 1),
        r as (select item_id instrument_id, min(cik) cik, arg_max(_company_name, k) filter (_company_name is not null) own_name, arg_min(id, k) seed_mention_id, min(date) first_seen, max(date) last_seen, count(*) mentions, count(distinct accession_number) filings,
            arg_max(_name, k) filter (_name is not null) "name", arg_max(id, k) filter (_name is not null) name_from, arg_max(_instrument_type, k) filter (_instrument_type is not null) "instrument_type", arg_max(id, k) filter (_instrument_type is not null) instrument_type_from, arg_max(_start_date, k) filter (_start_date is not null) "start_date", arg_max(id, k) filter (_start_date is not null) start_date_from, arg_max(_commitment_termination_date, k) filter (_commitment_termination_date is not null) "commitment_termination_date", arg_max(id, k) filter (_commitment_termination_date is not null) commitment_termination_date_from,
            arg_max(_maturity_date, {'s': stated, 'k': k}) filter (_maturity_date is not null) maturity_date, arg_max(id, {'s': stated, 'k': k}) filter (_maturity_date is not null) maturity_date_from,
            arg_max(principal_amount, k) filter (principal_amount is not null) principal_amount, (arg_max({'c': principal_currency}, k) filter (principal_amount is not null)).c principal_currency,
            (arg_max({'c': principal_amount_kind}, k) filter (principal_amount is not null)).c principal_amount_kind, arg_max(id, k) filter (principal_amount is not null) principal_from,
            (arg_max({'c': interest_rate_kind}, k) filter (interest_rate_kind is not null or interest_rate_pct is not null)).c interest_rate_kind, (arg_max({'c': interest_rate_pct}, k) filter (interest_rate_kind is not null or interest_rate_pct is not null)).c interest_rate_pct,
            arg_max(id, k) filter (interest_rate_kind is not null or interest_rate_pct is not null) interest_from,
            arg_max({'b': bal, 'd': date, 'i': id}, k) filter (bal is not null) bb,
            case max(case lender_disclosure when 'collective_present' then 2 when 'complete' then 1 else 0 end) when 2 then 'collective_present' when 1 then 'complete' else 'none_named' end lender_disclosure, false synthesized_only
            from b where item_id is not null group by 1)
        select r.* exclude (own_name, bb), coalesce(own_name, issuer) company_name, bb.b.normalized_amount outstanding_balance, bb.b.currency outstanding_balance_currency, coalesce(bb.b.as_of_date, bb.d) outstanding_balance_as_of,
            case when bb is not null then bb.b.as_of_date is null end outstanding_balance_as_of_is_filing_date, bb.i outstanding_balance_from from r left join n on n.cik = r.cik""",
    "published_items": """
        with i as (select item_id, accession_number, cik, label, classification_score, section_char_count, '8-K' form_type from classifications
                   union all select item_id, accession_number, cik, label, classification_score, section_char_count, '6-K' from sixk_snippets)
        select distinct item_id, accession_number, nullif(trim(cik), '') cik, nullif(trim(label), '') as label, classification_score, section_char_count, form_type from i where item_id in (select item_id from mentions)""",
    "resolved_redirects": """
        with recursive e as (select distinct debt_instrument_mention_id n, split_of p from mentions where split_of is not null and split_of <> debt_instrument_mention_id),
        live as (select distinct debt_instrument_mention_id n from mentions where split_of is null),
        w(n, top) as (select n, p from e union select w.n, e.p from w join e on e.n = w.top)
        select distinct w.n old_id, w.top new_id from w join live on live.n = w.top""",
    "stream_poll_state": """
        select cast(user_id as varchar) entity, count(*) as events, arg_max(event_type, (ts, event_id)) last_kind, count(*) filter (event_type = 'error') rounds, count(*) filter (event_type = 'error') >= 3 closed
        from events group by 1""",
    "p5_found": """
        with recursive e as (select distinct 'amendment_of' f, debt_instrument_mention_id n, amendment_of p from mentions where amendment_of in (select debt_instrument_mention_id from mentions)
                             union select distinct 'split_of', debt_instrument_mention_id, split_of from mentions where split_of in (select debt_instrument_mention_id from mentions)),
        w(f, n, top) as (select f, n, p from e union select w.f, w.n, e.p from w join e on e.f = w.f and e.n = w.top),
        done as (select w.f, w.n, w.top from w where not exists (select 1 from e where e.f = w.f and e.n = w.top)),
        cyc as (select f, n from w where n = top)
        select f link_field, n debt_instrument_mention_id, top top_mention_id from done
        union select w.f, w.n, min(w.top) from w join cyc on cyc.f = w.f and cyc.n = w.top group by 1, 2""",
    "p5_descendants": """
        with recursive e as (select distinct 'amendment_of' f, debt_instrument_mention_id n, amendment_of p from mentions where amendment_of in (select debt_instrument_mention_id from mentions)
                             union select distinct 'split_of', debt_instrument_mention_id, split_of from mentions where split_of in (select debt_instrument_mention_id from mentions)),
        cyc(f, n, top) as (select f, n, p from e union select c.f, c.n, e.p from cyc c join e on e.f = c.f and e.n = c.top),
        bad as (select distinct c.f, c.n from cyc c join cyc o on o.f = c.f and o.n = c.top and o.n = o.top),
        w(f, a, n, k) as (select f, p, n, 1 from e where (f, n) not in (select f, n from bad) union all select w.f, e.p, w.n, w.k + 1 from w join e on e.f = w.f and e.n = w.a)
        select f link_field, a ancestor, n descendant, k distance from w""",
    "p5_nodes": """
        with recursive e as (select distinct 'amendment_of' f, debt_instrument_mention_id n, amendment_of p from mentions where amendment_of in (select debt_instrument_mention_id from mentions)
                             union select distinct 'split_of', debt_instrument_mention_id, split_of from mentions where split_of in (select debt_instrument_mention_id from mentions)),
        every as (select distinct f, debt_instrument_mention_id n from mentions cross join (select unnest(['amendment_of', 'split_of']) f)),
        cyc(f, n, top) as (select f, n, p from e union select c.f, c.n, e.p from cyc c join e on e.f = c.f and e.n = c.top),
        low as (select c.f, c.n, min(c.top) root, bool_or(c.top = c.n) on_cycle from cyc c join cyc o on o.f = c.f and o.n = c.top and o.n = o.top group by 1, 2),
        w(f, a, n, k, path) as (select f, n, n, 0, n from every where (f, n) not in (select f, n from low) union all select w.f, e.p, w.n, w.k + 1, e.p || '>' || w.path from w join e on e.f = w.f and e.n = w.a),
        top as (select f, n, arg_max(a, k) root, max(k) depth, arg_max(path, k) path from w group by 1, 2),
        below as (select f, a n, count(*) - 1 descendants from w group by 1, 2)
        select t.f link_field, t.n debt_instrument_mention_id, t.root, t.depth, t.path, b.descendants, 'tree' state from top t join below b on b.f = t.f and b.n = t.n
        union all select f, n, root, null, null, null, case when on_cycle then 'cycle' else 'below cycle' end from low""",
    "p5_further_parents": """
        with e as (select distinct 'amendment_of' f, debt_instrument_mention_id n, amendment_of p from mentions where amendment_of in (select debt_instrument_mention_id from mentions)
                             union select distinct 'split_of', debt_instrument_mention_id, split_of from mentions where split_of in (select debt_instrument_mention_id from mentions)), k as (select f, n, min(p) kept from e group by 1, 2)
        select e.f link_field, e.n debt_instrument_mention_id, e.p parent_mention_id from e join k on k.f = e.f and k.n = e.n where e.p <> k.kept""",
}

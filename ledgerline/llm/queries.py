"""Queries of the corpus operators over the project's tables; SQL is in sql.py beside this module."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import lookalikes, markup, mixing, names, neardup, packing, pages, splitting, tokens
from ledgerline.plans.lineage import cut
from ledgerline.sources.tables import table


def records(spark: SparkSession, d: str) -> DataFrame:
    """(record_kind, record_key, text) of documents and 6-K snippets; repeated rows are left in."""
    documents = table(spark, d, "documents", "doc_id", "text").select(F.lit("document").alias("record_kind"), F.col("doc_id").cast("string").alias("record_key"), "text")
    snippets = table(spark, d, "sixk_snippets", "item_id", "text").select(F.lit("snippet").alias("record_kind"), F.col("item_id").alias("record_key"), "text")
    return documents.unionByName(snippets)


def split_records(spark: SparkSession, d: str) -> DataFrame:
    """records with their pieces under the split limits of size_limits (three rows, hence the broadcast)."""
    limits = table(spark, d, "size_limits").where("purpose = 'split' and size_unit = 'chars'").select("record_kind", "max_size", "overlap_size")
    sized = records(spark, d).join(F.broadcast(limits), "record_kind")
    return splitting.split_pieces(sized, "text", F.col("max_size"), F.col("overlap_size"))


def _names(spark: SparkSession, d: str) -> DataFrame:
    """(scope, name, owner): issuers and named parties under scope party, instruments under their issuer's cik."""
    rows = table(spark, d, "mentions", "cik", "company_name", "name", "parties_json")
    cik = F.when(F.trim("cik") != "", F.lpad(F.regexp_replace(F.trim("cik"), "^0+", ""), 10, "0"))
    rows = rows.withColumn("cik", cik)
    issuers = rows.select(F.lit("party").alias("scope"), F.col("company_name").alias("name"), F.col("cik").alias("owner"))
    instruments = rows.where("cik is not null").select(F.col("cik").alias("scope"), "name", F.lit(None).cast("string").alias("owner"))
    parties = F.from_json("parties_json", "array<struct<canonical_name: string, kind: string>>")
    named = rows.select(F.explode(parties).alias("p")).where("p.kind = 'named'").select(F.lit("party").alias("scope"), F.col("p.canonical_name").alias("name"), F.lit(None).cast("string").alias("owner"))
    return issuers.distinct().unionByName(instruments.distinct()).unionByName(named.distinct())


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return names.variant_pairs(names.link_variants(_names(spark, d)))


def p1_entities(spark: SparkSession, d: str) -> DataFrame:
    """Every spelling with the entity it names (a hash of its form) and that entity's number of spellings."""
    linked = names.link_variants(_names(spark, d))
    sizes = linked.groupBy("scope", "entity").agg(F.count("*").alias("spellings"))
    return linked.join(sizes, ["scope", "entity"])


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    """Near-duplicate documents (compared as they look) and snippets: runs of three words, 0.7."""
    rows = records(spark, d).select(F.col("record_kind").alias("kind"), F.col("record_key").alias("key"), "text")
    return neardup.near_duplicate_pairs(rows, 3, 0.7, looks="document").withColumnRenamed("kind", "record_kind")


def p3_groups(spark: SparkSession, d: str) -> DataFrame:
    """Groups of near-duplicates among documents and snippets: runs of five words, 0.8."""
    rows = records(spark, d).select(F.col("record_kind").alias("kind"), F.col("record_key").alias("key"), "text")
    return neardup.near_duplicate_groups(rows, looks="document").withColumnRenamed("kind", "record_kind").withColumnRenamed("key", "record_key")


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    """Records that the splitter cuts into more than one piece."""
    return split_records(spark, d).where(F.size("pieces") > 1).select("record_kind", "record_key").distinct()


def p4_pieces(spark: SparkSession, d: str) -> DataFrame:
    """Every piece of every record, with its offsets and the kind of boundary it ends at."""
    rows = split_records(spark, d).select("record_kind", "record_key", "text", "pieces").where("text is not null")
    return splitting.explode_pieces(rows.dropDuplicates(["record_kind", "record_key", "text"]), "text")


#: Share of a container by which its pieces of a document overlap.
TOKEN_OVERLAP = 0.05


def p4_token_pieces(spark: SparkSession, d: str) -> DataFrame:
    """Every document in pieces that fit a container (the pack limit, in tokens), with overlap."""
    limit = _pack_limit(spark, d)
    rows = table(spark, d, "documents", "doc_id", "text").where("text is not null").dropDuplicates(["doc_id", "text"])
    cut_up = splitting.split_pieces(rows, "text", limit, int(limit * TOKEN_OVERLAP), unit="tokens")
    return splitting.explode_pieces(cut_up, "text")


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return markup.marked_keys(table(spark, d, "documents", "doc_id", "url", "text"), "doc_id", "text", "url")


def p6_clean(spark: SparkSession, d: str) -> DataFrame:
    """Every document's clean text and the kinds of markup it had."""
    rows = markup.strip_markup(table(spark, d, "documents", "doc_id", "url", "text"), "doc_id", "text", "url")
    return rows.select("doc_id", F.array_join("kinds", ",").alias("kinds"), "frame_lines", "clean_text")


def p6_differences(spark: SparkSession, d: str) -> DataFrame:
    """Every page with its nearest page and the number of lines they share."""
    rows = pages.page_differences(table(spark, d, "documents", "doc_id", "url", "text"), "doc_id", "url", "text")
    return rows.select("doc_id", F.col("mate").alias("nearest_doc_id"), F.col("prefix").alias("common_path"), "lines", F.size("shared").alias("shared_lines"))


def sized_documents(spark: SparkSession, d: str, *columns: str) -> DataFrame:
    """(doc_id, columns, n_tokens) of every document; tokenized once, since sizes are read several times."""
    rows = table(spark, d, "documents", "doc_id", *columns, "text").withColumn("n_tokens", tokens.token_count("text"))
    return cut(rows.select("doc_id", *columns, "n_tokens"))


def _pack_limit(spark: SparkSession, d: str) -> int:
    return table(spark, d, "size_limits").where("purpose = 'pack' and record_kind = 'document' and size_unit = 'tokens'").first()["max_size"]


def _filled(spark: SparkSession, d: str) -> tuple[DataFrame, int]:
    limit = _pack_limit(spark, d)
    return packing.fill_containers(sized_documents(spark, d), "doc_id", "n_tokens", limit), limit


def p7_containers(spark: SparkSession, d: str) -> DataFrame:
    """Every document, or piece of a document above the limit, with its container."""
    return _filled(spark, d)[0]


def p7_report(spark: SparkSession, d: str) -> DataFrame:
    """Number of containers and share of their space left unused."""
    return packing.fill_report(*_filled(spark, d))


#: Size of the large mixture as a share of the tokens the sources have.
LARGE_SHARE = 0.75


def _mixed(spark: SparkSession, d: str, large: bool = False) -> tuple[DataFrame, DataFrame]:
    """The mixture and its report: of the largest size at which the targets hold, or of LARGE_SHARE of all tokens."""
    sized, targets = sized_documents(spark, d, "source"), table(spark, d, "source_targets")
    size = sized.join(targets, "source", "left_semi").dropDuplicates(["source", "doc_id"]).agg(F.sum("n_tokens")).first()[0] if large else None
    return mixing.mix(sized, "doc_id", "source", "n_tokens", targets, int(size * LARGE_SHARE) if size else None)


def p8_mixture(spark: SparkSession, d: str) -> DataFrame:
    """Every record of the mixture with the number of times it appears; every source has its target share."""
    return _mixed(spark, d)[0]


def p8_shares(spark: SparkSession, d: str) -> DataFrame:
    """Target, wanted and actual share of every source in p8_mixture."""
    return _mixed(spark, d)[1]


def p8_large_mixture(spark: SparkSession, d: str) -> DataFrame:
    """A mixture larger than the targets allow: the exponent rises as far as the repeat caps demand."""
    return _mixed(spark, d, large=True)[0]


def p8_large_shares(spark: SparkSession, d: str) -> DataFrame:
    """Target, wanted and actual share of every source in p8_large_mixture."""
    return _mixed(spark, d, large=True)[1]


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    pairs = lookalikes.lookalike_pairs(table(spark, d, "documents", "doc_id", "text"), "doc_id", "text")
    return pairs.select(F.col("key_a").alias("doc_id_a"), F.col("key_b").alias("doc_id_b"))


def p9_canonical(spark: SparkSession, d: str) -> DataFrame:
    """Every document's text in its consistent form."""
    return lookalikes.canonical_texts(table(spark, d, "documents", "doc_id", "text"), "doc_id", "text")


QUERIES = {
    "p1_found": p1_found,
    "p1_entities": p1_entities,
    "p3_found": p3_found,
    "p3_groups": p3_groups,
    "p4_found": p4_found,
    "p4_pieces": p4_pieces,
    "p4_token_pieces": p4_token_pieces,
    "p6_found": p6_found,
    "p6_clean": p6_clean,
    "p6_differences": p6_differences,
    "p7_containers": p7_containers,
    "p7_report": p7_report,
    "p8_mixture": p8_mixture,
    "p8_shares": p8_shares,
    "p8_large_mixture": p8_large_mixture,
    "p8_large_shares": p8_large_shares,
    "p9_found": p9_found,
    "p9_canonical": p9_canonical,
}

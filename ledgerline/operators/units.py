"""Problem 2: one quantity recorded in different units.

The same amounts reach us from several sources: the fact in amounts_json, the flat columns, and the
text, where every notation ("million", "mm", "(000s)", a header's "thousands", a bare figure, ...)
is a source of its own with its own unit. A fact links its sources. For every pair of sources the
scale and offset between two records of one amount are estimated by medians and snapped to the known
conversions (powers of ten of the customary scales); units are propagated from bare figures with a
currency beside them, which are whole units by what they are, along the graph of sources. What an
amount is in whole units, and so which records are off, follows from the unit of its notation.

What notations customarily mean enters as evidence: each counts as KNOWN_WEIGHT linked records.
Where data are few that decides, where they are many they do, and no size is treated apart.
"""

from __future__ import annotations

from collections.abc import Iterator
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import StringType, StructField, StructType

from ledgerline.functions import money
from ledgerline.plans.lineage import cut

#: Powers of ten between units that occur: none, hundred (cents, per cent), thousand, lakh, million, crore, billion, trillion.
CONVERSIONS = (0, 2, 3, 4, 5, 6, 7, 9, 12)
#: Largest distance in log10 at which a factor is taken for a known conversion.
SNAP = 1e-6

AMOUNTS = "array<struct<kind: string, normalized_amount: string, currency: string, prior: boolean, spans: array<struct<tag_id: string, char_start: int, text: string>>>>"
_WRITTEN = StructType([StructField("figure", StringType()), StructField("scale", StringType()), StructField("currency", StringType())])
#: Linked records that a notation's customary meaning counts as.
KNOWN_WEIGHT = 15
#: The source whose unit is the whole currency unit: a bare figure beside a currency.
REFERENCE = "text:"


@pandas_udf(_WRITTEN)
def written(texts: pd.Series) -> pd.DataFrame:
    """(figure, scale, currency) of amounts as written; nulls for null or unreadable text."""
    return pd.DataFrame([money.written(t) if t else (None, None, None) for t in texts], columns=["figure", "scale", "currency"])


def _header_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [(key, *h) for key, text in zip(batch["item_id"].to_pylist(), batch["text"].to_pylist(), strict=True) for h in money.written_headers(text)]
        columns = list(zip(*rows, strict=True)) if rows else [[]] * 4
        yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.string()), pa.array(columns[1], pa.int32()), pa.array(columns[2], pa.string()), pa.array(columns[3], pa.string())], ["item_id", "at", "scale", "currency"])


def item_headers(items: DataFrame) -> DataFrame:
    """(item_id, at, scale, currency): what the items' texts say their bare figures are stated in.

    Texts without a scale in the plural never leave the JVM; repeated items count once.
    """
    some = items.where(F.col("text").rlike(r"(?i)\b(?:thousands|millions|billions|crores|lakhs|lacs)\b")).select("item_id", "text")
    return some.mapInArrow(_header_rows, "item_id string, at int, scale string, currency string").distinct()


def _nearest_known(log: Column, tolerance: float) -> Column:
    """The known conversion at most `tolerance` away from a decimal logarithm, else null."""
    nearest = F.round(log).cast("int")
    return F.when((F.abs(log - nearest) < tolerance) & F.abs(nearest).isin(*CONVERSIONS), nearest)


def snapped_power(recorded: Column, true: Column) -> Column:
    """The known conversion p with recorded = true * 10^p, or null if no known one fits."""
    ratio = F.log10(F.abs(recorded.cast("double")) / F.abs(true.cast("double")))
    return F.when(F.signum(recorded.cast("double")) == F.signum(true.cast("double")), _nearest_known(ratio, SNAP))


_FACT = ("debt_instrument_mention_id", "item_id", "date", "kind", "prior", "recorded_text", "recorded_currency", "spans")


def amount_facts(mentions: DataFrame) -> DataFrame:
    """One row per distinct fact of amounts_json: mention, item, date, kind, prior, recorded value and currency, spans."""
    rows = mentions.select("debt_instrument_mention_id", "item_id", "date", F.explode(F.from_json("amounts_json", AMOUNTS)).alias("f"))
    return rows.select(
        "debt_instrument_mention_id", "item_id", "date", F.col("f.kind").alias("kind"), F.coalesce("f.prior", F.lit(False)).alias("prior"), F.col("f.normalized_amount").alias("recorded_text"),
        F.col("f.currency").alias("recorded_currency"), F.col("f.spans").alias("spans"),
    ).distinct()


def fact_spans(mentions: DataFrame, items: DataFrame) -> DataFrame:
    """Every span of every fact: amount_facts with at, span_no, figure, notation and stated_currency.

    notation names the source the figure comes from: "text:" and the scale as written, or "header:"
    and the scale of the last header before it in its item's text (else of the first one in it) for
    a span that names neither currency nor scale. Without evidence it is null.
    """
    one = amount_facts(mentions).select("*", F.posexplode("spans").alias("span_no", "span")).withColumn("s", written("span.text")).withColumn("at", F.col("span.char_start")).drop("span")
    one = cut(one)
    # bare figures alone are joined with the headers of their items
    bare = F.col("s.figure").isNotNull() & F.col("s.scale").isNull() & F.col("s.currency").isNull()
    before = F.when(F.col("header_at") < F.col("at"), F.col("header_at")).otherwise(-F.col("header_at") - 1)
    headed = (
        one.where(bare)
        .join(item_headers(items).select("item_id", F.col("at").alias("header_at"), F.col("scale").alias("header_scale"), F.col("currency").alias("header_currency")), "item_id", "left")
        .groupBy(*one.columns)
        .agg(F.max_by(F.struct("header_scale", "header_currency"), before).alias("h"))
        .select(*_FACT, "span_no", "at", "s.figure", F.concat(F.lit("header:"), "h.header_scale").alias("notation"), F.col("h.header_currency").alias("stated_currency"))
    )
    plain = one.where(~bare).select(*_FACT, "span_no", "at", "s.figure", F.when(F.col("s.figure").isNotNull(), F.concat(F.lit("text:"), F.coalesce("s.scale", F.lit("")))).alias("notation"), F.col("s.currency").alias("stated_currency"))
    return plain.unionByName(headed)


def recorded_figures(mentions: DataFrame, items: DataFrame) -> DataFrame:
    """Every recorded amount beside the figures that state it: one row per figure.

    (debt_instrument_mention_id, slot, date, source, recorded_amount, recorded_currency, entity,
    addends, figure, notation, stated_currency); entity is what links the sources of one amount.
    """
    spans = cut(fact_spans(mentions, items))
    only = F.when(F.size("spans") == 1, F.col("spans")[0]["tag_id"])
    entity = F.xxhash64("debt_instrument_mention_id", "kind", "prior", "recorded_text", "recorded_currency", F.to_json("spans"))
    facts = spans.select(
        "debt_instrument_mention_id", only.alias("slot"), "date", F.lit("fact").alias("source"), F.expr("try_cast(recorded_text as decimal(38,2))").alias("recorded_amount"), "recorded_currency",
        entity.alias("entity"), F.size("spans").alias("addends"), "figure", "notation", "stated_currency", "kind", "prior", "at",
    )
    flat = mentions.where("principal_amount is not null").select(
        "debt_instrument_mention_id", "date", F.col("principal_amount").cast("decimal(38,2)").alias("recorded_amount"), F.col("principal_currency").alias("recorded_currency"), "name",
        (F.coalesce(F.size(F.from_json("amounts_json", "array<struct<kind: string>>")), F.lit(0)) <= 0).alias("no_facts"),
    ).distinct()
    main = (
        facts.where("kind in ('commitment', 'principal') and not prior and addends = 1")
        .groupBy("debt_instrument_mention_id")
        .agg(F.min_by(F.struct("entity", "figure", "notation", "stated_currency"), F.struct("kind", "at", "slot")).alias("m"))
        .select("debt_instrument_mention_id", "m.*")
    )
    # an amount heads the name: "$500 million 5% Notes due 2030"
    headed = F.regexp_extract("name", r"^\s*([^\d]{0,6}\d[\d.,'’]*(?:\s*(?i:thousand|million|billion|crores?|lakhs?|lacs?|mm|mn|bn|mil\.?|[KMB])\b)?)", 1)
    named = (
        flat.where("no_facts and name is not null").withColumn("s", written(headed)).where("s.figure is not null and (s.scale is not null or s.currency is not null)")
        .withColumn("entity", F.xxhash64("debt_instrument_mention_id", "name")).withColumn("figure", F.col("s.figure")).withColumn("notation", F.concat(F.lit("name:"), F.coalesce("s.scale", F.lit(""))))
        .withColumn("stated_currency", F.col("s.currency"))
    )
    principal = ["debt_instrument_mention_id", F.lit("principal_amount").alias("slot"), "date", F.lit("principal").alias("source"), "recorded_amount", "recorded_currency", "entity", F.lit(1).alias("addends"), "figure", "notation", "stated_currency"]
    rows = facts.drop("kind", "prior", "at").unionByName(flat.where("not no_facts").join(main, "debt_instrument_mention_id").select(*principal)).unionByName(named.select(*principal))
    return rows.distinct()


def known_links(spark: SparkSession) -> DataFrame:
    """(source_a, source_b, power): what notations customarily mean, and that records are in whole units."""
    links = [("fact", "principal", 0)]
    for scale, power in [("", 0), *money.SCALES.items()]:
        # a figure in millions is smaller than its record by six powers of ten
        links += [("fact", f"text:{scale}", -power), ("fact", f"header:{scale}", -power), ("name:" + scale, "principal", power)]
    return spark.createDataFrame(links, "source_a string, source_b string, power int")


def source_units(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(scales, units) of recorded_figures(): pairwise_scales between the sources, and every source's unit as a power of the whole unit's."""
    seen = records.where("addends = 1 and figure is not null and notation is not null")
    observed = seen.select("entity", F.col("notation").alias("unit_source"), F.col("figure").cast("double").alias("value")).unionByName(
        seen.select("entity", F.col("source").alias("unit_source"), F.col("recorded_amount").cast("double").alias("value"))
    )
    scales = cut(pairwise_scales(observed, "entity", "unit_source", "value", known_links(records.sparkSession)))
    return scales, propagate_scales(scales, REFERENCE)


def recorded_amounts(mentions: DataFrame, items: DataFrame) -> DataFrame:
    """Every recorded amount against what is stated.

    Columns: debt_instrument_mention_id, slot, date, source (fact or principal), recorded_amount,
    recorded_currency, stated_amount, stated_currency, power (the known conversion between record
    and statement; null if none fits or one is missing). The stated amount is the figure as written
    times the unit found for its notation; of a fact with several spans it is their sum, if all
    can be read and name one currency, and its slot is null. principal_amount takes what is stated
    for the fact of kind commitment or principal that isn't prior, or for the amount in the name
    where there are no facts. Repeated rows count once; rows without any statement keep nulls.
    """
    records = cut(recorded_figures(mentions, items))
    _, units = source_units(records)
    # a figure of a source stands for 10^-power whole units; there are as many sources as notations
    factor = F.pow(F.lit(10.0), F.abs("_unit")).cast("decimal(20,0)")
    worth = F.when(F.col("_unit") <= 0, F.col("figure").cast("decimal(38,6)") * factor).otherwise(F.col("figure").cast("decimal(38,6)") / factor)
    rows = records.join(units.select(F.col("source").alias("notation"), F.col("power").alias("_unit")), "notation", "left").withColumn("_worth", worth.cast("decimal(38,2)"))
    columns = ["debt_instrument_mention_id", "slot", "date", "source", "recorded_amount", "recorded_currency"]
    single = rows.where("addends = 1").select(*columns, F.col("_worth").alias("stated_amount"), "stated_currency")
    complete = (F.count("_worth") == F.max("addends")) & (F.count("stated_currency") == F.max("addends")) & (F.min("stated_currency") == F.max("stated_currency"))
    several = rows.where("addends > 1").groupBy(*columns, "entity").agg(F.when(complete, F.sum("_worth")).cast("decimal(38,2)").alias("stated_amount"), F.when(complete, F.min("stated_currency")).alias("stated_currency"))
    return single.unionByName(several.drop("entity")).distinct().withColumn("power", snapped_power(F.col("recorded_amount"), F.col("stated_amount")))


def misrecorded(amounts: DataFrame) -> DataFrame:
    """The recorded amounts that differ from their statement in figure or currency."""
    figure = F.coalesce(F.col("recorded_amount") != F.col("stated_amount"), F.lit(True))
    currency = F.col("stated_currency").isNotNull() & ~F.col("recorded_currency").eqNullSafe(F.col("stated_currency"))
    return amounts.where(F.col("stated_amount").isNotNull() & (figure | currency)).where("slot is not null")


def in_dollars(amounts: DataFrame, rates: DataFrame) -> DataFrame:
    """amounts with amount (whole units), currency (ISO) and usd_amount at the rate of the month of date.

    rates is small by its nature (currencies by months) and is joined without a hint: the session's
    broadcast threshold decides on its size. Where nothing is stated, the recorded values stand in
    if their currency is an ISO code.
    """
    iso = F.upper("recorded_currency")
    amount = F.coalesce("stated_amount", "recorded_amount")
    currency = F.coalesce(F.col("stated_currency"), F.when(iso.rlike("^[A-Z]{3}$"), iso))
    rates = rates.select(F.col("currency"), F.col("rate_month"), F.col("usd_per_unit"))
    rows = amounts.withColumn("amount", amount).withColumn("currency", currency).withColumn("rate_month", F.substring("date", 1, 7))
    return rows.join(rates, ["currency", "rate_month"], "left").withColumn("usd_amount", F.round(F.col("amount").cast("double") * F.col("usd_per_unit"), 2))


def pairwise_scales(observations: DataFrame, entity: str, source: str, value: str, known: DataFrame | None = None, known_weight: int = KNOWN_WEIGHT) -> DataFrame:
    """(source_a, source_b, entities, log_factor, spread, power, slope, offset): robust relation between each pair of sources, value_b = scale * value_a + offset.

    log_factor is the median over the entities both sources record of log10(value_b / value_a),
    spread the median absolute deviation from it, slope the median slope between two entities (which
    an offset leaves alone; entities meet in hashed cells of about two), and power the known
    conversion that log_factor, or else slope, snaps to, null if none is near. offset is the median
    of what scale leaves over, 0 where it is within the median deviation of that. Each entity is
    paired through its (few) sources, never across entities. known (source_a, source_b, power) adds
    known_weight entities a row at its power; values of zero, below it or null take no part.
    """
    one = observations.where(F.col(value).cast("double") > 0).groupBy(entity, source).agg(F.percentile_approx(F.col(value).cast("double"), 0.5, 1000).alias("_v"))
    a, b = one.alias("a"), one.alias("b")
    both = a.join(b, (F.col(f"a.{entity}") == F.col(f"b.{entity}")) & (F.col(f"a.{source}") < F.col(f"b.{source}"))).select(
        F.col(f"a.{source}").alias("source_a"), F.col(f"b.{source}").alias("source_b"), F.xxhash64(F.col(f"a.{entity}")).alias("_e"), F.col("a._v").alias("_a"), F.col("b._v").alias("_b")
    )
    if known is not None:
        swap = F.col("source_a") > F.col("source_b")
        power = F.pow(F.lit(10.0), F.when(swap, -F.col("power")).otherwise(F.col("power")))
        # their values differ, so that slopes can be taken between them
        each = F.explode(F.array(*(F.lit(float(i)) for i in range(1, known_weight + 1))))
        both = both.unionByName(
            known.select(F.least("source_a", "source_b").alias("source_a"), F.greatest("source_a", "source_b").alias("source_b"), power.alias("_p"), each.alias("_a")).select(
                "source_a", "source_b", F.xxhash64("_a", "source_a").alias("_e"), "_a", (F.col("_a") * F.col("_p")).alias("_b")
            )
        )
    both = cut(both.withColumn("_d", F.log10(F.col("_b") / F.col("_a"))))
    pair = ["source_a", "source_b"]
    middle = both.groupBy(*pair).agg(F.count("*").alias("entities"), F.percentile_approx("_d", 0.5, 10000).alias("log_factor"))
    cells = both.join(middle.select(*pair, "entities"), pair).groupBy(*pair, F.pmod("_e", F.greatest(F.lit(1), F.col("entities") / 2).cast("long")).alias("_cell"))
    ends = cells.agg(F.min("_a").alias("_a1"), F.max("_a").alias("_a2"), F.min_by("_b", "_a").alias("_b1"), F.max_by("_b", "_a").alias("_b2")).where("_a2 > _a1")
    slopes = ends.groupBy(*pair).agg(F.percentile_approx((F.col("_b2") - F.col("_b1")) / (F.col("_a2") - F.col("_a1")), 0.5, 10000).alias("slope"))
    known_power = F.coalesce(_nearest_known(F.col("log_factor"), 0.05), F.when(F.col("slope") > 0, _nearest_known(F.log10("slope"), 0.05)))
    found = middle.join(slopes, pair, "left").withColumn("power", known_power)
    scale = F.coalesce(F.pow(F.lit(10.0), F.col("power")), F.col("slope"), F.pow(F.lit(10.0), F.col("log_factor")))
    left = both.join(found, pair).withColumn("_left", F.col("_b") - scale * F.col("_a"))
    rest = left.groupBy(*pair).agg(F.percentile_approx("_left", 0.5, 10000).alias("_offset"), F.percentile_approx(F.abs(F.col("_d") - F.col("log_factor")), 0.5, 10000).alias("spread"), F.percentile_approx(F.abs("_left"), 0.5, 10000).alias("_off"))
    return found.join(rest, pair).select(*pair, "entities", "log_factor", "spread", "power", "slope", F.when(F.abs("_offset") < F.col("_off"), 0.0).otherwise(F.col("_offset")).alias("offset"))


def propagate_scales(scales: DataFrame, reference: str) -> DataFrame:
    """(source, power): each source's unit as a power of ten of the reference source's, along the graph of pairwise scales.

    Of several ways the one with the fewest steps counts, among those the one over the most
    entities. It goes on until no further source is reached; sources that no way of known
    conversions reaches are left out.
    """
    steps = scales.where("power is not null").select(F.col("source_a").alias("x"), F.col("source_b").alias("y"), "power", "entities")
    steps = cut(steps.unionByName(steps.select(F.col("y").alias("x"), F.col("x").alias("y"), (-F.col("power")).alias("power"), "entities")))
    found = scales.sparkSession.createDataFrame([(reference, 0, 0)], "source string, power int, step int")
    reached, step = 1, 0
    while True:
        step += 1
        ahead = found.where(F.col("step") == step - 1).alias("f").join(steps.alias("s"), F.col("f.source") == F.col("s.x")).select(
            F.col("s.y").alias("source"), (F.col("f.power") + F.col("s.power")).alias("power"), F.lit(step).alias("step"), "s.entities"
        )
        best = ahead.join(found, "source", "left_anti").groupBy("source").agg(F.max_by("power", F.struct("entities", -F.col("power"))).alias("power"), F.min("step").alias("step"))
        found = cut(found.unionByName(best))
        now = found.count()
        if now == reached:
            return found.select("source", "power")
        reached = now

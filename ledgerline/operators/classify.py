"""A linear text classifier over word n-grams, with a threshold for a wanted recall."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LinearSVC
from pyspark.ml.feature import IDF, HashingTF, NGram, RegexTokenizer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.operators.rollup import running_sums
from ledgerline.plans.lineage import cut

#: Labelled rows the linear model is fitted on, at most; the sample is deterministic in the key's hash.
FIT_ROWS = 20_000
FEATURES = 1 << 16


@dataclass
class Classifier:
    """A fitted pipeline and the threshold at or above which a text counts as relevant."""

    model: PipelineModel
    threshold: float

    def score(self, df: DataFrame, text: str) -> DataFrame:
        """df with classification_score (logistic of the margin), verdict and label. Null text scores as empty text."""
        scored = self.model.transform(df.withColumn("_text", F.coalesce(F.lower(text), F.lit("")))).withColumn("classification_score", logistic(vector_to_array("_raw")[1]))
        verdict = F.when(F.col("classification_score") >= self.threshold, "relevant").otherwise("irrelevant")
        return scored.select(*df.columns, "classification_score", verdict.alias("verdict"))


def logistic(margin):
    """1 / (1 + exp(-margin)), margins clipped to 50 either way."""
    return 1 / (1 + F.exp(-F.greatest(F.lit(-50.0), F.least(F.lit(50.0), margin))))


def recall_curve(scores: DataFrame, score: str, label: str) -> DataFrame:
    """(threshold, taken, hits, precision, recall): one row per distinct score, as if it were the threshold; none without positives.

    Rows are added up per score before anything is ordered. Null scores and labels take no part.
    """
    known = scores.where(F.col(score).isNotNull() & F.col(label).isNotNull())
    counts = known.groupBy(F.col(score).alias("threshold")).agg(F.sum(F.col(label).cast("long")).alias("hits"), F.count("*").alias("taken"))
    curve = running_sums(counts, "threshold", "hits", "taken")
    positives = curve.agg(F.sum("hits").alias("_all"))
    joined = curve.join(F.broadcast(positives)).where("_all > 0")
    return joined.select("threshold", F.col("taken_sum").alias("taken"), F.col("hits_sum").alias("hits"), (F.col("hits_sum") / F.col("taken_sum")).alias("precision"), (F.col("hits_sum") / F.col("_all")).alias("recall"))


def threshold_for_recall(scores: DataFrame, score: str, label: str, recall: float) -> float:
    """The highest threshold at which at least `recall` of the positive rows are kept; 0 without positives."""
    best = recall_curve(scores, score, label).where(F.col("recall") >= recall).agg(F.max("threshold")).first()[0]
    return float(best) if best is not None else 0.0


def average_area(scores: DataFrame, score: str, label: str) -> float | None:
    """The area under precision over recall, by trapezoids between the distinct scores; null without positives."""
    curve = cut(recall_curve(scores, score, label))
    parts = int(scores.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # each point meets the next by the number of rows taken, which grows from point to point
    ranged = cut(curve.repartitionByRange(parts, "taken").withColumn("_part", F.spark_partition_id()))
    order = Window.partitionBy("_part").orderBy("taken")
    ends = ranged.groupBy("_part").agg(F.max_by(F.struct("recall", "precision"), "taken").alias("_last"))
    ends = ends.select("_part", F.lag("_last").over(Window.orderBy("_part")).alias("_ended"))
    steps = ranged.withColumn("_before", F.lag(F.struct("recall", "precision")).over(order)).join(ends, "_part")
    # before the first point nothing is taken and precision counts as 1
    last = F.coalesce("_before", "_ended", F.struct(F.lit(0.0).alias("recall"), F.lit(1.0).alias("precision")))
    area = (F.col("recall") - last["recall"]) * (F.col("precision") + last["precision"]) / 2
    return steps.agg(F.sum(area)).first()[0]


def fit(labelled: DataFrame, key: str, text: str, label: str, recall: float = 0.99, fit_rows: int = FIT_ROWS) -> Classifier:
    """Fit on at most fit_rows rows (two thirds), set the threshold on all labelled rows not fitted on.

    Document frequencies are those of all texts, unlabelled ones included. label is boolean.
    Classes are weighted by their inverse frequency. Rows of null label have no part in model and
    threshold.
    """
    every = labelled.select(F.col(key).cast("string").alias("_key"), F.coalesce(F.lower(text), F.lit("")).alias("_text"), F.col(label).cast("double").alias("_label"))
    rows = every.where("_label is not null").dropDuplicates(["_key"])
    total = rows.count()
    part = F.pmod(F.xxhash64("_key"), F.lit(1_000_000))
    fitted = (part < int(1_000_000 * min(1.0, fit_rows / max(1, total)))) & (part % 3 != 0)
    share = rows.agg(F.avg("_label")).first()[0] or 0.5
    weighted = rows.where(fitted).withColumn("_weight", F.when(F.col("_label") == 1, 0.5 / max(share, 1e-6)).otherwise(0.5 / max(1 - share, 1e-6)))
    stages = [
        RegexTokenizer(inputCol="_text", outputCol="_words", pattern=r"\W+"), NGram(n=2, inputCol="_words", outputCol="_pairs"),
        HashingTF(inputCol="_words", outputCol="_tf1", numFeatures=FEATURES), HashingTF(inputCol="_pairs", outputCol="_tf2", numFeatures=FEATURES),
        VectorAssembler(inputCols=["_tf1", "_tf2"], outputCol="_tf"), IDF(inputCol="_tf", outputCol="_features", minDocFreq=2),
    ]
    linear = LinearSVC(featuresCol="_features", labelCol="_label", weightCol="_weight", rawPredictionCol="_raw", predictionCol="_prediction", maxIter=20, regParam=0.01)
    features = Pipeline(stages=stages).fit(every.dropDuplicates(["_key"]))
    model = PipelineModel([*features.stages, linear.fit(features.transform(weighted))])
    scored = model.transform(rows.where(~fitted)).withColumn("s", logistic(vector_to_array("_raw")[1]))
    return Classifier(model, threshold_for_recall(scored, "s", "_label", recall))

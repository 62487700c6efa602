"""Classification metrics (M9-M13) and weighted means."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import reliable_checkpoint
from .ordered import partitions_for


def accuracy(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """M9: one row (n, correct, accuracy)."""
    hit = (F.col(label) == F.col(prediction)).cast("long")
    return df.agg(F.count(F.lit(1)).alias("n"), F.sum(hit).alias("correct"),
                  F.avg(hit.cast("double")).alias("accuracy"))


def _stack(pairs: Sequence[tuple[int, int, str]], value_type: str) -> str:
    parts = ", ".join(f"{i}, {j}, `{c}`" for i, j, c in pairs)
    return f"stack({len(pairs)}, {parts}) as (label, prediction, {value_type})"


def confusion_counts(df: DataFrame, label: str = "label", prediction: str = "prediction",
                     classes: Sequence[int] = (0, 1)) -> DataFrame:
    """Counts for the full class grid (absent cells are 0), one pass."""
    aggs, pairs = [], []
    for i in classes:
        for j in classes:
            name = f"c_{i}_{j}"
            aggs.append(F.count(F.when((F.col(label) == i) & (F.col(prediction) == j), 1)).alias(name))
            pairs.append((i, j, name))
    return df.agg(*aggs).selectExpr(_stack(pairs, "n"))


def confusion_normalised(df: DataFrame, label: str = "label", prediction: str = "prediction",
                         classes: Sequence[int] = (0, 1)) -> DataFrame:
    """Row-normalised confusion matrix; a class without rows gives a zero row."""
    counts = confusion_counts(df, label, prediction, classes)
    total = F.sum("n").over(_by_label())
    return counts.select("label", "prediction",
                         F.coalesce(F.try_divide(F.col("n").cast("double"), total.cast("double")),
                                    F.lit(0.0)).alias("rate"))


def _by_label():
    from pyspark.sql import Window
    # The grid has len(classes)**2 rows; partitioning it by label is bounded.
    return Window.partitionBy("label")


def _cumulative_counts(per: DataFrame, rows: int) -> DataFrame:
    """tp / fp at each threshold: positives and negatives with a score >= it.

    ``per`` has one row per distinct score (threshold, pos, neg).  Fully in
    the JVM, without a global window:
    1. thresholds are cut into about ``rows / ROWS_PER_PARTITION`` quantile
       buckets (``QuantileDiscretizer``, one approximate-quantile pass);
    2. running sums are a window inside each bucket (one shuffle by bucket);
    3. each bucket's offset comes from the bucket totals, one row per bucket
       (a bounded summary), joined back as a small table.
    Order is Spark's descending order: NaN first, null last.  Thresholds are
    unique, so the order and the result do not depend on task timing.
    """
    from pyspark.ml.feature import QuantileDiscretizer
    from pyspark.sql import Window
    nb = partitions_for(rows, per.sparkSession)
    x = per.withColumn("_x", F.col("threshold").cast("double"))
    if rows:
        nb = max(2, nb)
        model = QuantileDiscretizer(numBuckets=nb, inputCol="_x", outputCol="_qb", handleInvalid="keep",
                                    relativeError=min(1e-3, 0.25 / nb)).fit(x)
        n_reg = len(model.getSplits()) - 1
        x, b = model.transform(x), F.col("_qb").cast("int")
    else:
        n_reg, b = 1, F.lit(0)
    desc_bucket = (F.when(F.col("_x").isNull(), F.lit(n_reg + 1))
                   .when(F.isnan("_x"), F.lit(0))
                   .otherwise(F.lit(n_reg) - b))
    x = x.withColumn("_db", desc_bucket).drop("_x", "_qb")
    totals = {r["_db"]: (r["p"] or 0, r["n"] or 0)
              for r in x.groupBy("_db").agg(F.sum("pos").alias("p"), F.sum("neg").alias("n")).collect()}
    offsets, run_p, run_n = [], 0, 0
    for db in sorted(totals):
        offsets.append((int(db), int(run_p), int(run_n)))
        run_p += totals[db][0]
        run_n += totals[db][1]
    offs = per.sparkSession.createDataFrame(offsets, "_db int, _op long, _on long")
    w = (Window.partitionBy("_db").orderBy(F.col("threshold").desc())
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    # The offsets table has one row per bucket (bounded by the bucket count).
    return (x.withColumn("_tp", F.sum("pos").over(w)).withColumn("_fp", F.sum("neg").over(w))
            .join(F.broadcast(offs), on="_db", how="left")
            .select("threshold", "pos", "neg", (F.col("_tp") + F.col("_op")).alias("tp"),
                    (F.col("_fp") + F.col("_on")).alias("fp")))


def roc_points(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """One ROC point per distinct score, thresholds descending.

    Scores are first aggregated per distinct value (partial aggregation),
    then cumulative positives / negatives come from bucketed running sums.
    Output: threshold, tp, fp, tpr, fpr, pos, neg.
    """
    # Read by the totals, the bucket fit, the bucket totals and the final
    # plan: keep it rather than recompute the scored input four times.
    per = reliable_checkpoint(df.groupBy(F.col(score).alias("threshold"))
                  .agg(F.sum((F.col(label) == 1).cast("long")).alias("pos"),
                       F.sum((F.col(label) != 1).cast("long")).alias("neg")))
    tot = per.agg(F.sum("pos").alias("p"), F.sum("neg").alias("n"), F.count(F.lit(1)).alias("k")).first()
    p, n = tot["p"] or 0, tot["n"] or 0
    cum = _cumulative_counts(per, tot["k"])
    return cum.select("threshold", "tp", "fp",
                      F.try_divide(F.col("tp").cast("double"), F.lit(float(p))).alias("tpr"),
                      F.try_divide(F.col("fp").cast("double"), F.lit(float(n))).alias("fpr"),
                      "pos", "neg")


def roc_auc(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Exact area under the ROC curve, ties counted one half.

    Trapezoids between consecutive distinct thresholds:
    sum(neg * (2 tp - pos)) / (2 P N).  One row: auc, positives, negatives.
    """
    pts = roc_points(df, label, score)
    return pts.agg(
        F.try_divide(F.sum(F.col("neg").cast("double") * (2.0 * F.col("tp") - F.col("pos"))),
                     2.0 * F.sum("pos").cast("double") * F.sum("neg").cast("double")).alias("auc"),
        F.sum("pos").alias("positives"), F.sum("neg").alias("negatives"))


def weighted_mean(df: DataFrame, value: str, weight: str, by: Sequence[str] = (),
                  out: str = "weighted_mean") -> DataFrame:
    """sum(value * weight) / sum(weight), optionally per group."""
    agg = F.try_divide(F.sum(F.col(value) * F.col(weight)), F.sum(F.col(weight)).cast("double")).alias(out)
    return df.groupBy(*by).agg(agg, F.sum(weight).alias("weight_sum")) if by else \
        df.agg(agg, F.sum(weight).alias("weight_sum"))

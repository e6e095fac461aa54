"""Model evaluation: metrics, confusion matrix, F1 by cutoff, residuals.

All metrics are aggregates over the scored rows (partial per task, final on
one row); nothing is collected except the final numbers.
"""

from __future__ import annotations

from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans.scale import one_row


def metrics_regression(df: DataFrame, label: str = "label", prediction: str = "prediction",
                       group=None) -> DataFrame:
    """``metrics_regression``: RMSE, MAE, R2 (optionally per group)."""
    err = F.col(label) - F.col(prediction)
    aggs = [F.sqrt(F.avg(err * err)).alias("rmse"), F.avg(F.abs(err)).alias("mae"),
            (1 - F.sum(err * err) / (F.var_pop(label) * F.count(label))).alias("r2"),
            F.count(F.lit(1)).alias("n")]
    if group:
        return df.groupBy(*([group] if isinstance(group, str) else group)).agg(*aggs)
    return df.agg(*aggs)


def residual_frame(df: DataFrame, label: str = "label", prediction: str = "prediction",
                   keep=()) -> DataFrame:
    """``residual_frame``: actual, predicted, ``actual - predicted`` and the
    recipe's ``abs(actual) - abs(predicted)``."""
    return df.select(*keep, F.col(label).alias("actual"), F.col(prediction).alias("predicted"),
                     (F.col(label) - F.col(prediction)).alias("residual"),
                     (F.abs(label) - F.abs(prediction)).alias("abs_difference"))


def confusion_matrix(df: DataFrame, label: str, prediction: str, classes=None,
                     normalize: bool = False) -> DataFrame:
    """``confusion_matrix``: count per (label, prediction) on the full class
    grid (zero cells kept); with ``normalize`` the share within each label.

    The k x k grid is made inside Spark from the distinct classes of both
    columns (or from ``classes``); nothing is collected and k has no cap.
    """
    counts = df.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction")) \
        .agg(F.count(F.lit(1)).alias("count"))
    ltype, ptype = counts.schema["label"].dataType, counts.schema["prediction"].dataType
    if classes is None:
        both = counts.select(F.explode(F.array(F.col("label"), F.col("prediction").cast(ltype))).alias("c"))
        grid = both.agg(F.collect_set("c").alias("cs"))
    else:
        grid = df.sparkSession.range(1).select(F.array(*[F.lit(c).cast(ltype) for c in classes]).alias("cs"))
    grid = (grid.select(F.col("cs").cast(T.ArrayType(ptype)).alias("ps"), F.explode("cs").alias("label"))
            .select("label", F.explode("ps").alias("prediction")))
    out = grid.join(counts, ["label", "prediction"], "left").withColumn(
        "count", F.coalesce(F.col("count"), F.lit(0)).cast("long"))
    if normalize:
        out = out.withColumn("share", F.try_divide(
            F.col("count").cast("double"), F.sum("count").over(Window.partitionBy("label"))))
    return out


def threshold_grid(max_thresh: float = 0.3, step: float = 0.01) -> list:
    """Cutoffs ``0, step, 2 step, ...`` up to ``max_thresh`` (inclusive), as
    ``start + i * step`` exactly like an arange."""
    n = 0
    while n * step < max_thresh + step - 1e-12:
        n += 1
    return [i * step for i in range(n)]


def f1_by_threshold(df: DataFrame, label: str, score: str, max_thresh: float = 0.3,
                    step: float = 0.01, average: str = "binary", grid=None) -> DataFrame:
    """``f1_by_threshold``: F1 of ``score > t`` for every cutoff ``t``, and
    ``is_best`` on the first cutoff reaching the maximum.

    One pass: each row is tagged with how many cutoffs it clears, counts are
    aggregated per (cleared, label) — at most (cutoffs + 1) x 2 groups — and
    TP/FP per cutoff are suffix sums over that tiny table.
    """
    grid = list(grid) if grid is not None else threshold_grid(max_thresh, step)
    garr = F.array(*[F.lit(float(g)) for g in grid])
    cleared = F.size(F.filter(garr, lambda g: g < F.col(score)))
    pos = (F.col(label) == 1).cast("long")
    zero = (F.col(label) == 0).cast("long")
    agg = df.groupBy(cleared.alias("k")).agg(F.sum(pos).alias("p"), F.sum(zero).alias("z"), F.count(F.lit(1)).alias("n"))
    rows = {r["k"]: (r["p"] or 0, r["n"], r["z"] or 0) for r in agg.collect()}  # <= len(grid) + 1 rows
    total_p = sum(p for p, _, _ in rows.values())
    total_n = sum(n for _, n, _ in rows.values())
    out = []
    for i, g in enumerate(grid):
        tp = sum(p for k, (p, _, _) in rows.items() if k > i)
        pp = sum(n for k, (_, n, _) in rows.items() if k > i)
        fp = pp - tp
        fn = total_p - tp
        if average == "binary":
            den = 2 * tp + fp + fn
            f1 = (2.0 * tp / den) if den else 0.0
        else:  # micro average equals accuracy: label 1 above, label 0 at or below the cutoff
            tn = sum(z for k, (_, _, z) in rows.items() if k <= i)
            f1 = (tp + tn) / total_n if total_n else 0.0
        out.append((float(g), float(f1)))
    best = max(range(len(out)), key=lambda i: (out[i][1], -i)) if out else -1
    return df.sparkSession.createDataFrame(
        [(t, f, i == best) for i, (t, f) in enumerate(out)],
        "threshold DOUBLE, f1 DOUBLE, is_best BOOLEAN")


def metrics_classification(df: DataFrame, label: str, prediction: str,
                           probability: str | None = None, eps: float = 1e-15) -> DataFrame:
    """``metrics_classification`` for a binary label: accuracy, precision,
    recall, F1 (positive class 1), log loss and ROC AUC (exact: ties share
    the average rank)."""
    y = F.col(label).cast("double")
    p = F.col(prediction).cast("double")
    aggs = [F.avg((y == p).cast("double")).alias("accuracy"),
            F.sum(((y == 1) & (p == 1)).cast("long")).alias("tp"),
            F.sum(((y == 0) & (p == 1)).cast("long")).alias("fp"),
            F.sum(((y == 1) & (p == 0)).cast("long")).alias("fn"),
            F.count(F.lit(1)).alias("n")]
    if probability:
        q = F.least(F.greatest(F.col(probability).cast("double"), F.lit(eps)), F.lit(1 - eps))
        aggs.append((-F.avg(y * F.log(q) + (1 - y) * F.log(1 - q))).alias("log_loss"))
    r = one_row(df, *aggs)
    tp, fp, fn = r["tp"], r["fp"], r["fn"]
    precision = tp / (tp + fp) if (tp + fp) else 0.0
    recall = tp / (tp + fn) if (tp + fn) else 0.0
    f1 = 2 * precision * recall / (precision + recall) if (precision + recall) else 0.0
    auc = None
    if probability:
        ev = BinaryClassificationEvaluator(rawPredictionCol=probability, labelCol=label,
                                           metricName="areaUnderROC", numBins=0)
        auc = ev.evaluate(df.select(F.col(probability).cast("double").alias(probability),
                                    F.col(label).cast("double").alias(label)))
    row = (float(r["accuracy"]), float(precision), float(recall), float(f1),
           None if not probability else float(r["log_loss"]), auc, int(r["n"]))
    return df.sparkSession.createDataFrame(
        [row], "accuracy DOUBLE, precision DOUBLE, recall DOUBLE, f1 DOUBLE, log_loss DOUBLE, "
               "auc DOUBLE, n BIGINT")


def metrics_by_class(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """``metrics_classification`` for any number of classes: precision, recall,
    F1 and support of every class, and rows ``micro`` and ``macro``.

    One partial aggregate by (label, prediction); everything else runs on its
    at most k x k rows.
    """
    counts = df.filter(F.col(label).isNotNull() & F.col(prediction).isNotNull()).groupBy(
        F.col(label).cast("string").alias("y"), F.col(prediction).cast("string").alias("p")) \
        .agg(F.count(F.lit(1)).alias("n"))
    hit = F.when(F.col("y") == F.col("p"), F.col("n")).otherwise(0)
    sides = counts.select(F.explode(F.array(
        F.struct(F.col("y").alias("class"), hit.alias("tp"), F.col("n").alias("support"), F.lit(0).cast("long").alias("said")),
        F.struct(F.col("p").alias("class"), F.lit(0).cast("long").alias("tp"), F.lit(0).cast("long").alias("support"),
                 F.col("n").alias("said")))).alias("x")).select("x.*")
    div = lambda a, b: F.coalesce(F.try_divide(F.col(a).cast("double"), F.col(b).cast("double")), F.lit(0.0))
    f1 = F.coalesce(F.try_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")), F.lit(0.0))
    rated = lambda d: (d.withColumn("precision", div("tp", "said")).withColumn("recall", div("tp", "support"))
                       .withColumn("f1", f1).select("class", "precision", "recall", "f1", "support"))
    sums = [F.sum(c).alias(c) for c in ("tp", "support", "said")]
    each = rated(sides.groupBy("class").agg(*sums))
    micro = rated(sides.agg(*sums).withColumn("class", F.lit("micro")))
    macro = each.agg(F.lit("macro").alias("class"), *[F.avg(c).alias(c) for c in ("precision", "recall", "f1")],
                     F.sum("support").alias("support"))
    return each.unionByName(micro).unionByName(macro)

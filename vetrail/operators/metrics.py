"""Ranking and threshold metrics of scored rows.

Scores are first grouped to distinct values with their class counts, so ties cost nothing, and
running counts come from :mod:`vetrail.operators.ordered`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vetrail.functions.scores import f1_with_epsilon
from vetrail.operators.ordered import running_totals


def score_steps(
    scored: DataFrame, label: str, score: str, by: Sequence[str] = ()
) -> DataFrame:
    """One row per distinct score: class counts, and counts at or above it (``tp``, ``fp``)."""
    hit = F.col(label).cast("bigint")
    steps = scored.groupBy(*by, F.col(score).cast("double").alias("threshold")).agg(
        F.sum(hit).alias("pos"), F.sum(1 - hit).alias("neg")
    )
    return running_totals(steps, F.col("threshold").desc(), {"tp": "pos", "fp": "neg"}, by)


def _ratio(a: Column, b: Column) -> Column:
    return F.try_divide(a.cast("double"), b.cast("double"))


def _columns() -> tuple[Column, Column, Column, Column]:
    return F.col("tp"), F.col("fp"), F.col("tp_all"), F.col("fp_all")


def evaluate(
    scored: DataFrame,
    label: str,
    score: str,
    by: Sequence[str] = (),
    cut: float = 0.5,
) -> DataFrame:
    """ROC-AUC, average precision, and F1 at a cut, one row per group of ``by``.

    Average precision is the step sum over distinct scores, not the trapezoid. F1 is 0 where it
    is undefined.
    """
    tp, fp, p, n = _columns()
    pos, neg = F.col("pos"), F.col("neg")
    above = F.col("threshold") >= cut
    tp_cut = F.coalesce(F.sum(F.when(above, pos)), F.lit(0))
    fp_cut = F.coalesce(F.sum(F.when(above, neg)), F.lit(0))
    steps = score_steps(scored, label, score, by)
    return steps.groupBy(*by).agg(
        F.sum(pos + neg).alias("n_rows"),
        F.sum(pos).alias("n_pos"),
        # Each positive beats the negatives below its score, and half of those that tie with it.
        F.sum(_ratio(pos, p) * _ratio(n - fp + neg / 2, n)).alias("roc_auc"),
        F.sum(_ratio(pos, p) * _ratio(tp, tp + fp)).alias("pr_auc"),
        F.coalesce(_ratio(2 * tp_cut, tp_cut + fp_cut + F.sum(pos)), F.lit(0.0)).alias("f1"),
    )


def roc_curve(scored: DataFrame, label: str, score: str) -> DataFrame:
    """Points (threshold, fpr, tpr), one per distinct score, and the start (inf, 0, 0)."""
    tp, fp, p, n = _columns()
    points = score_steps(scored, label, score).select(
        "threshold", _ratio(fp, n).alias("fpr"), _ratio(tp, p).alias("tpr")
    )
    start = scored.limit(1).select(
        F.lit(float("inf")).alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr")
    )
    return points.unionByName(start)


def pr_curve(scored: DataFrame, label: str, score: str) -> DataFrame:
    """Precision and recall per threshold, and the end point (null, 1, 0)."""
    end = scored.limit(1).select(
        F.lit(None).cast("double").alias("threshold"),
        F.lit(1.0).alias("precision"),
        F.lit(0.0).alias("recall"),
    )
    points = threshold_table(scored, label, score)
    return points.select("threshold", "precision", "recall").unionByName(end)


def threshold_table(scored: DataFrame, label: str, score: str) -> DataFrame:
    """Precision, recall and F1 when rows at or above each threshold are flagged."""
    tp, fp, p, _ = _columns()
    return (
        score_steps(scored, label, score)
        .select(
            "threshold", _ratio(tp, tp + fp).alias("precision"), _ratio(tp, p).alias("recall")
        )
        .withColumn("f1", f1_with_epsilon(F.col("precision"), F.col("recall")))
    )


def threshold_at_recall(
    scored: DataFrame, label: str, score: str, target: float = 0.80
) -> DataFrame:
    """The threshold whose recall is nearest the target; the smallest one if several are."""
    table = threshold_table(scored, label, score)
    return table.orderBy(F.abs(F.col("recall") - target), "threshold").limit(1)


def classification_report(
    predicted: DataFrame, label: str, prediction: str, names: tuple[str, str] = ("0", "1")
) -> DataFrame:
    """Precision, recall, F1 and support per class, accuracy, macro and weighted means."""
    y, guess = F.col(label) == 1, F.col(prediction) == 1
    counts = predicted.agg(
        F.count_if(y & guess).alias("tp"),
        F.count_if(~y & guess).alias("fp"),
        F.count_if(y & ~guess).alias("fn"),
        F.count_if(~y & ~guess).alias("tn"),
    )

    def part(a: Column, b: Column) -> Column:
        return F.coalesce(_ratio(a, b), F.lit(0.0))

    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    per_class = []
    for hit, wrong, missed in ((tn, fn, fp), (tp, fp, fn)):
        per_class.append(
            (part(hit, hit + wrong), part(hit, hit + missed), part(2 * hit, 2 * hit + wrong + missed),
             hit + missed)
        )
    (p0, r0, f0, s0), (p1, r1, f1, s1) = per_class
    total = s0 + s1
    accuracy = part(tp + tn, total)

    def row(name: str, p: Column, r: Column, f: Column, s: Column) -> Column:
        return F.struct(
            F.lit(name).alias("row"), p.alias("precision"), r.alias("recall"), f.alias("f1"),
            s.cast("bigint").alias("support"),
        )

    def mean(a: Column, b: Column) -> Column:
        return (a + b) / 2

    def weighted(a: Column, b: Column) -> Column:
        return part(a * s0 + b * s1, total)

    return counts.select(
        F.inline(
            F.array(
                row(names[0], p0, r0, f0, s0),
                row(names[1], p1, r1, f1, s1),
                row("accuracy", accuracy, accuracy, accuracy, total),
                row("macro avg", mean(p0, p1), mean(r0, r1), mean(f0, f1), total),
                row("weighted avg", weighted(p0, p1), weighted(r0, r1), weighted(f0, f1), total),
            )
        )
    )


def compare_models(
    scored: DataFrame, label: str, score: str, model: str = "model"
) -> DataFrame:
    """Metrics of every model, and which one is best by average precision."""
    table = evaluate(scored, label, score, by=[model])
    # One row per model: the window is over a handful of rows, and the metrics are worked out once.
    best = F.max(F.struct("pr_auc", model)).over(Window.partitionBy())
    return table.withColumn("is_best", (F.col(model) == best[model]).cast("int"))

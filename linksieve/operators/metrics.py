"""Binary classification metrics (E1-E4, M8); label 1 is the positive class.

Input is any scored table. ``by`` names columns (a model, a configuration) to
compute a separate result for each of their combinations. A row whose score is null
or NaN has no place in a ranking: the ranking metrics (E2, E4) leave it out, totals
included; the others count it by its prediction.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linksieve.session import checkpointed

SWEEP_THRESHOLDS = tuple(round(0.05 * i, 2) for i in range(1, 20))


def _ratio(numerator: Column, denominator: Column) -> Column:
    """0 where nothing was predicted or nothing is there."""
    return F.when(denominator > 0, numerator.cast("double") / denominator).otherwise(0.0)


def _count(condition: Column) -> Column:
    return F.coalesce(F.sum(F.when(condition, 1).otherwise(0)), F.lit(0)).cast("long")



def outcome_counts(
    scored: DataFrame, by: Sequence[str] = (), label: str = "label", prediction: str = "prediction"
) -> DataFrame:
    """``tn, fp, fn, tp`` in one pass."""
    y, p = F.col(label) == 1, F.col(prediction) == 1
    return scored.groupBy(*by).agg(
        _count(~y & ~p).alias("tn"), _count(~y & p).alias("fp"),
        _count(y & ~p).alias("fn"), _count(y & p).alias("tp"),
    )


def counted_scores(
    scored: DataFrame,
    by: Sequence[str] = (),
    label: str = "label",
    prediction: str = "prediction",
    p: str = "p_phish",
) -> DataFrame:
    """``score, prediction, pos, neg``: all that any metric needs, from one pass over the rows."""
    counts = scored.groupBy(*by, F.col(p).alias("score"), F.col(prediction).alias("prediction")).agg(
        _count(F.col(label) == 1).alias("pos"), _count(F.col(label) != 1).alias("neg")
    )
    return checkpointed(counts)


def outcomes_of(counted: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``tn, fp, fn, tp`` from :func:`counted_scores`."""
    hit = F.col("prediction") == 1

    def total(condition: Column, column: str) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col(column)).otherwise(0)), F.lit(0)).cast("long")

    return counted.groupBy(*by).agg(
        total(~hit, "neg").alias("tn"), total(hit, "neg").alias("fp"),
        total(~hit, "pos").alias("fn"), total(hit, "pos").alias("tp"),
    )


def with_rates(counts: DataFrame) -> DataFrame:
    """Accuracy, precision, recall and F1 from outcome counts."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    return counts.withColumns(
        {
            "accuracy": _ratio(tp + tn, tn + fp + fn + tp),
            "precision": _ratio(tp, tp + fp),
            "recall": _ratio(tp, tp + fn),
            "f1": _ratio(2 * tp, 2 * tp + fp + fn),
        }
    )


def binary_metrics(
    scored: DataFrame, by: Sequence[str] = (), label: str = "label", prediction: str = "prediction"
) -> DataFrame:
    """E1. Accuracy, precision, recall and F1."""
    rates = with_rates(outcome_counts(scored, by, label, prediction))
    return rates.select(*by, "accuracy", "precision", "recall", "f1")


def confusion_matrix(
    scored: DataFrame, by: Sequence[str] = (), label: str = "label", prediction: str = "prediction"
) -> DataFrame:
    """E3. The four cells as rows, with their share of all rows in percent."""
    return confusion_of(outcome_counts(scored, by, label, prediction), by)


def confusion_of(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """E3 from outcome counts."""
    total = F.col("tn") + F.col("fp") + F.col("fn") + F.col("tp")
    cells = F.explode(
        F.array(
            *[
                F.struct(F.lit(actual).alias("actual"), F.lit(predicted).alias("predicted"), F.col(cell).alias("n"))
                for actual, predicted, cell in ((0, 0, "tn"), (0, 1, "fp"), (1, 0, "fn"), (1, 1, "tp"))
            ]
        )
    )
    return counts.select(*by, total.alias("total"), cells.alias("cell")).select(
        *by, "cell.*", (_ratio(F.col("cell.n"), F.col("total")) * 100).alias("pct")
    )


def score_counts(
    scored: DataFrame, by: Sequence[str] = (), label: str = "label", p: str = "p_phish"
) -> DataFrame:
    """Positives and negatives per distinct score, the input of every ranking metric."""
    return scored.groupBy(*by, F.col(p).alias("score")).agg(
        _count(F.col(label) == 1).alias("pos"), _count(F.col(label) != 1).alias("neg")
    )


def rankable(counted: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The same from :func:`counted_scores`."""
    return counted.groupBy(*by, "score").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))


def accumulate(scores: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Per distinct score: ``pos, neg`` at it, ``pos_above, neg_above`` strictly above
    it, the totals ``all_pos, all_neg``, and ``next_same``: whether the next lower
    score has equal counts.

    The scores are dealt out in ascending ranges, one per task, and stored, so a range
    is the number of its task. Each range is summed, the few sums per group are
    accumulated, and a row adds what stands above it within its own range.
    """
    by = list(by)
    # stored before it is filtered: pushed down, the condition would repeat a whole score expression
    ranked = checkpointed(scores).filter(F.col("score").isNotNull() & ~F.isnan("score"))
    ranged = ranked.repartitionByRange(*by, "score").withColumn("rng", F.spark_partition_id())
    ranged = checkpointed(ranged)
    descending = Window.partitionBy(*by).orderBy(F.col("rng").desc())
    before = descending.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*by)
    top = F.max_by(F.struct("pos", "neg"), F.col("score"))
    ranges = (
        ranged.groupBy(*by, "rng")
        .agg(F.sum("pos").alias("range_pos"), F.sum("neg").alias("range_neg"), top.alias("range_top"))
        .select(
            *[F.col(c).alias(f"range_{c}") for c in by], F.col("rng").alias("range_rng"),
            F.coalesce(F.sum("range_pos").over(before), F.lit(0)).alias("pos_before"),
            F.coalesce(F.sum("range_neg").over(before), F.lit(0)).alias("neg_before"),
            F.sum("range_pos").over(whole).alias("all_pos"),
            F.sum("range_neg").over(whole).alias("all_neg"),
            F.lead("range_top").over(descending).alias("next_top"),
        )
    )
    same_range = F.col("rng") == F.col("range_rng")
    for c in by:
        same_range &= F.col(c).eqNullSafe(F.col(f"range_{c}"))
    within = Window.partitionBy(*by, "rng").orderBy(F.col("score").desc())
    above = within.rowsBetween(Window.unboundedPreceding, -1)
    # Not forced to be broadcast: there are few ranges, but ``by`` may have many values.
    return (
        ranged.withColumns(
            {
                "pos_above": F.coalesce(F.sum("pos").over(above), F.lit(0)),
                "neg_above": F.coalesce(F.sum("neg").over(above), F.lit(0)),
                "following": F.lead(F.struct("pos", "neg")).over(within),
            }
        )
        .join(ranges, same_range)
        .select(
            *by, "score", "pos", "neg", "all_pos", "all_neg",
            (F.col("pos_before") + F.col("pos_above")).alias("pos_above"),
            (F.col("neg_before") + F.col("neg_above")).alias("neg_above"),
            (F.struct("pos", "neg") == F.coalesce("following", "next_top")).alias("next_same"),
        )
    )


def cumulative_counts(
    scored: DataFrame, by: Sequence[str] = (), label: str = "label", p: str = "p_phish"
) -> DataFrame:
    """:func:`accumulate` over the scores of a table."""
    return accumulate(score_counts(scored, by, label, p), by)


def area(cumulative: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """E2 from cumulative counts."""
    wins = F.col("neg").cast("double") * (F.col("pos_above") + F.col("pos") / 2)
    pairs = F.first("all_pos").cast("double") * F.first("all_neg")
    return cumulative.groupBy(*by).agg(F.when(pairs > 0, F.sum(wins) / pairs).alias("roc_auc"))


def roc_auc(
    scored: DataFrame, by: Sequence[str] = (), label: str = "label", p: str = "p_phish"
) -> DataFrame:
    """E2. Exact area under the ROC curve, ties counted half; null with one class only."""
    return area(cumulative_counts(scored, by, label, p), by)


def score_metrics(
    scored: DataFrame,
    by: Sequence[str] = (),
    label: str = "label",
    prediction: str = "prediction",
    p: str = "p_phish",
) -> DataFrame:
    """E1 + E2 in one row per group; the scored rows are computed once."""
    return metrics_of(counted_scores(scored, by, label, prediction, p), by)


def metrics_of(counted: DataFrame, by: Sequence[str] = (), cumulative: DataFrame | None = None) -> DataFrame:
    """E1 + E2 from :func:`counted_scores`."""
    names = ["accuracy", "precision", "recall", "f1", "roc_auc"]
    rates = with_rates(outcomes_of(counted, by)).select(*by, *names[:-1])
    auc = area(accumulate(rankable(counted, by), by) if cumulative is None else cumulative, by)
    # One row per group from either side, so each maximum is over a single value.
    both = rates.unionByName(auc, allowMissingColumns=True)
    return both.groupBy(*by).agg(*[F.max(name).alias(name) for name in names])


def roc_curve(
    scored: DataFrame, by: Sequence[str] = (), label: str = "label", p: str = "p_phish"
) -> DataFrame:
    """E4. Curve points ``fpr, tpr, threshold``, corner points only.

    Starts at (0, 0) with threshold infinity. A point on the straight line between
    its neighbours is left out: the step to it and the step from it are the same.
    """
    return corners(cumulative_counts(scored, by, label, p), by)


def corners(cumulative: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """E4 from cumulative counts."""
    is_top = F.col("pos_above") + F.col("neg_above") == 0
    is_corner = is_top | ~F.coalesce("next_same", F.lit(False))
    c = cumulative.filter(is_corner)
    point = F.struct(
        F.try_divide((F.col("neg_above") + F.col("neg")).cast("double"), F.col("all_neg")).alias("fpr"),
        F.try_divide((F.col("pos_above") + F.col("pos")).cast("double"), F.col("all_pos")).alias("tpr"),
        F.col("score").alias("threshold"),
    )
    origin = F.struct(
        F.when(F.col("all_neg") > 0, 0.0).alias("fpr"),
        F.when(F.col("all_pos") > 0, 0.0).alias("tpr"),
        F.lit(float("inf")).alias("threshold"),
    )
    return c.select(
        *by, F.explode(F.when(is_top, F.array(origin, point)).otherwise(F.array(point))).alias("pt")
    ).select(*by, "pt.*")


def threshold_sweep(
    scored: DataFrame,
    thresholds: Iterable[float] = SWEEP_THRESHOLDS,
    by: Sequence[str] = (),
    label: str = "label",
    p: str = "p_phish",
) -> DataFrame:
    """M8. Metrics of the rule ``p >= threshold`` for each threshold.

    Rows are first counted by how many thresholds they reach, so the table is read
    and aggregated once; the cumulation runs over that small result.
    """
    cuts = sorted(set(thresholds))
    reached = sum((F.col(p) >= F.lit(t)).cast("int") for t in cuts)
    binned = scored.groupBy(*by, reached.alias("reached")).agg(
        _count(F.col(label) == 1).alias("pos"), _count(F.col(label) != 1).alias("neg")
    )
    steps = F.explode(
        F.array(*[F.struct(F.lit(i + 1).alias("step"), F.lit(t).alias("threshold")) for i, t in enumerate(cuts)])
    )
    hit = F.col("reached") >= F.col("s.step")
    counts = (
        binned.withColumn("s", steps)
        .groupBy(*by, F.col("s.threshold").alias("threshold"))
        .agg(
            F.sum(F.when(hit, 0).otherwise(F.col("neg"))).alias("tn"),
            F.sum(F.when(hit, F.col("neg")).otherwise(0)).alias("fp"),
            F.sum(F.when(hit, 0).otherwise(F.col("pos"))).alias("fn"),
            F.sum(F.when(hit, F.col("pos")).otherwise(0)).alias("tp"),
        )
    )
    return with_rates(counts)


def threshold_choice(
    scored: DataFrame,
    precisions: Iterable[float],
    by: Sequence[str] = (),
    label: str = "label",
    p: str = "p_phish",
) -> DataFrame:
    """M8. For every wanted precision the threshold with the largest recall that keeps it.

    ``wanted, threshold, precision, recall, tp, fp`` of the rule ``p >= threshold``, chosen among
    all distinct scores; of thresholds with equal recall the highest, which has the fewest false
    alarms. A precision that no score reaches has a null threshold.
    """
    wanted = sorted(set(precisions))
    tp, fp = F.col("pos_above") + F.col("pos"), F.col("neg_above") + F.col("neg")
    points = cumulative_counts(scored, by, label, p).select(*by, "score", "all_pos", tp.alias("tp"), fp.alias("fp"))
    # counts are compared, not their ratio: at the precision itself there is nothing to round
    fits = [F.col("tp") >= F.lit(w) * (F.col("tp") + F.col("fp")) for w in wanted]
    point = F.struct("tp", "score", "fp", "all_pos")
    best = points.groupBy(*by).agg(
        F.max("all_pos").alias("positives"), *[F.max(F.when(f, point)).alias(f"best{i}") for i, f in enumerate(fits)]
    )
    rows = F.explode(
        F.array(*[F.struct(F.lit(w).alias("wanted"), F.col(f"best{i}").alias("at")) for i, w in enumerate(wanted)])
    )
    found = best.filter(F.col("positives").isNotNull()).select(*by, rows.alias("r"))
    tp, fp = F.col("r.at.tp"), F.col("r.at.fp")
    return found.select(
        *by, F.col("r.wanted").alias("wanted"), F.col("r.at.score").alias("threshold"),
        F.try_divide(tp.cast("double"), tp + fp).alias("precision"),
        F.try_divide(tp.cast("double"), F.col("r.at.all_pos")).alias("recall"),
        tp.alias("tp"), fp.alias("fp"),
    )

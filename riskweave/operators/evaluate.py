"""Exact evaluation of scores against labels.

Curves and areas come from running totals per distinct score, so ties are handled as ties and no
task sees more than one range of scores.  Threshold tables need one pass: every row is counted
into the slot between two thresholds, and the few slots are then accumulated.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .. import schema as S
from ..functions.scalars import half_up, pct2, risk_tier
from .running import running_totals

# Cost of a missed fraud and of reviewing a false alarm, in dollars.
FRAUD_LOSS = 250
REVIEW_COST = 15
# Operating points.
GRID = [k / 10 for k in range(1, 10)]
FINE_GRID = [k / 100 for k in range(1, 100)]
BLOCK_SCORE = 0.92


def _classes(label: str) -> dict[str, Column]:
    return {"pos": F.count_if(F.col(label) == 1), "neg": F.count_if(F.col(label) == 0)}


def areas(df: DataFrame, score: str = "score", label: str = S.LABEL, by: tuple[str, ...] = ()) -> DataFrame:
    """``roc_auc`` and ``average_precision``, one row (or one per ``by``), from one pass.

    ROC-AUC is the share of (fraud, legitimate) pairs ranked right, ties half; pairs are counted
    in whole numbers.  Average precision sums, over the thresholds, precision times the recall
    gained there; nothing is interpolated.  NULL when a class is missing.
    """
    rows = running_totals(df, score, _classes(label), by, descending=True)
    # twice the pairs won at a score: legitimate rows below it count double, tied ones once
    below = (F.col("total_neg") - F.col("cum_neg")) * 2 + F.col("neg")
    won = F.sum(F.col("pos").cast("decimal(19,0)") * below.cast("decimal(19,0)")).cast("double")
    pairs = F.max(F.col("total_pos").cast("double") * F.col("total_neg").cast("double") * 2)
    precision = F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg"))
    gained = F.sum(F.col("pos") * precision)
    return rows.groupBy(*by).agg(
        F.try_divide(won, pairs).alias("roc_auc"),
        F.try_divide(gained, F.max("total_pos")).alias("average_precision"),
    )


def roc_auc(df: DataFrame, score: str = "score", label: str = S.LABEL) -> DataFrame:
    """Area under the ROC curve; see :func:`areas`."""
    return areas(df, score, label).select("roc_auc")


def average_precision(df: DataFrame, score: str = "score", label: str = S.LABEL) -> DataFrame:
    """Step-wise area under the precision-recall curve; see :func:`areas`."""
    return areas(df, score, label).select("average_precision")


def pr_curve(df: DataFrame, score: str = "score", label: str = S.LABEL) -> DataFrame:
    """Precision and recall at every distinct score, and the closing point (1, 0)."""
    rows = running_totals(df, score, _classes(label), descending=True)
    points = rows.select(
        F.col(score).cast("double").alias("threshold"),
        (F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg"))).alias("precision"),
        F.try_divide(F.col("cum_pos"), F.col("total_pos")).alias("recall"),
    )
    end = df.sparkSession.sql(
        "SELECT CAST(NULL AS DOUBLE) AS threshold, 1.0D AS precision, 0.0D AS recall"
    )
    return points.unionByName(end)


def score_histogram(df: DataFrame, bins: int = 50, score: str = "score", label: str = S.LABEL) -> DataFrame:
    """Density of the scores per class over ``bins`` equal steps between the class's extremes."""
    classes = df.filter(F.col(label).isin(0, 1) & F.col(score).isNotNull())
    bounds = classes.groupBy(F.col(label).alias("_class")).agg(
        F.min(score).alias("lo"), F.max(score).alias("hi"), F.count(F.lit(1)).alias("class_rows")
    )
    # bounded: the filter above leaves at most two classes
    placed = classes.join(F.broadcast(bounds), F.col(label) == F.col("_class"))
    step = (F.col("hi") - F.col("lo")) / bins
    # a single-valued class has no width of its own; it gets a unit-wide range around the value
    flat = F.col("hi") == F.col("lo")
    lo = F.when(flat, F.col("lo") - 0.5).otherwise(F.col("lo"))
    step = F.when(flat, F.lit(1.0 / bins)).otherwise(step)
    raw = F.least(F.floor((F.col(score) - lo) / step), F.lit(bins - 1).cast("bigint"))
    # division may land one bin beside the edge it belongs to; the edges themselves decide
    slot = (
        F.when(F.col(score) < lo + raw * step, raw - 1)
        .when((F.col(score) >= lo + (raw + 1) * step) & (raw < bins - 1), raw + 1)
        .otherwise(raw)
    )
    counts = placed.groupBy(label, slot.alias("bin"), lo.alias("_lo"), step.alias("_step"), "class_rows").agg(
        F.count(F.lit(1)).alias("n")
    )
    return counts.select(
        label, "bin",
        (F.col("_lo") + F.col("bin") * F.col("_step")).alias("bin_start"),
        "n",
        (F.col("n") / (F.col("class_rows") * F.col("_step"))).alias("density"),
    )


def _ratio4(num: Column, den: Column) -> Column:
    return F.coalesce(half_up(num, den, 1, 4), F.lit(0.0))


def scored_rows(df: DataFrame, score: str = "score") -> DataFrame:
    """Rows with a score; a row without one (NULL or NaN) is no decision either way."""
    return df.filter(F.col(score).isNotNull() & ~F.isnan(score))


def unscored(df: DataFrame, score: str = "score") -> DataFrame:
    """How many rows :func:`scored_rows` leaves out, one row."""
    return df.agg(F.count_if(F.col(score).isNull() | F.isnan(score)).alias("n_unscored"))


def confusion(df: DataFrame, t: float = 0.5, score: str = "score", label: str = S.LABEL) -> DataFrame:
    """Confusion counts at one threshold with precision and recall, one row."""
    flagged, fraud = F.col(score) >= t, F.col(label) == 1
    counts = scored_rows(df, score).agg(
        F.count_if(flagged & fraud).alias("tp"),
        F.count_if(flagged & ~fraud).alias("fp"),
        F.count_if(~flagged & fraud).alias("fn"),
        F.count_if(~flagged & ~fraud).alias("tn"),
    )
    tp = F.col("tp")
    return counts.select(
        F.lit(t).alias("threshold"), "tp", "fp", "fn", "tn",
        F.try_divide(tp, tp + F.col("fp")).alias("precision"),
        F.try_divide(tp, tp + F.col("fn")).alias("recall"),
    )


def _slot(score: str, grid: list[float]) -> Column:
    """How many of the sorted thresholds the score reaches, by halving."""
    def search(lo: int, hi: int) -> str:
        if lo == hi:
            return str(lo)
        mid = (lo + hi) // 2
        return f"CASE WHEN `{score}` >= {grid[mid]!r}D THEN {search(mid + 1, hi)} ELSE {search(lo, mid)} END"

    return F.expr(search(0, len(grid)))


def cross_thresholds(
    df: DataFrame, grid: list[float], score: str = "score", label: str = S.LABEL
) -> DataFrame:
    """Confusion counts of the whole table at every threshold.

    Equal to testing each row against each threshold, but each row is placed once: the table
    shrinks to ``len(grid) + 1`` slots before anything is accumulated.
    """
    grid = sorted(map(float, grid))
    slots = scored_rows(df, score).groupBy(_slot(score, grid).alias("slot")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg")
    )
    values = ", ".join(f"({i}, {t!r}D)" for i, t in enumerate(grid, start=1))
    spine = df.sparkSession.sql(
        f"SELECT * FROM VALUES (0, CAST(NULL AS DOUBLE)), {values} AS grid(_slot, threshold)"
    )
    # bounded: one row per slot of the grid
    filled = spine.join(F.broadcast(slots), F.col("_slot") == F.col("slot"), "left")
    reached = W.orderBy(F.desc("_slot"))
    totals = filled.na.fill(0, ["pos", "neg"]).select(
        "threshold",
        F.sum("pos").over(reached).alias("tp"),
        F.sum("neg").over(reached).alias("fp"),
        F.sum("pos").over(W.partitionBy()).alias("_pos"),
        F.sum("neg").over(W.partitionBy()).alias("_neg"),
    )
    return totals.filter("threshold IS NOT NULL").select(
        "threshold", "tp", "fp",
        (F.col("_pos") - F.col("tp")).alias("fn"),
        (F.col("_neg") - F.col("fp")).alias("tn"),
    )


def threshold_costs(
    df: DataFrame,
    grid: list[float] = GRID,
    loss: int = FRAUD_LOSS,
    review: int = REVIEW_COST,
    score: str = "score",
    label: str = S.LABEL,
) -> DataFrame:
    """Counts, precision, recall and business cost at every threshold."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    recall = _ratio4(tp, tp + fn)
    return cross_thresholds(df, grid, score, label).select(
        "threshold",
        tp.alias("true_positives"),
        fp.alias("false_positives"),
        fn.alias("false_negatives"),
        tn.alias("true_negatives"),
        _ratio4(tp, tp + fp).alias("precision"),
        recall.alias("recall"),
        F.round(recall * 100, 2).alias("fraud_caught_pct"),
        half_up(fp, fp + tn, 100, 4).alias("false_alarm_rate_pct"),
        (fn * loss).alias("cost_missed_fraud"),
        (fp * review).alias("cost_false_alarms"),
        (fn * loss + fp * review).alias("total_cost"),
    )


def best_threshold(costs: DataFrame) -> DataFrame:
    """The cheapest threshold; the lowest one when several cost the same."""
    return costs.orderBy("total_cost", "threshold").limit(1)


def with_tiers(df: DataFrame, score: str = "score", t: float = 0.5) -> DataFrame:
    """Add the binary prediction and the risk tier."""
    s = F.col(score)
    return df.withColumns({"fraud_predicted": (s >= t).cast("int"), "risk_tier": risk_tier(s)})


def critical_queue(predictions: DataFrame, label: str = S.LABEL) -> DataFrame:
    """Size and fraud density of the highest tier."""
    queue = predictions.filter(F.col("risk_tier") == "CRITICAL")
    counts = queue.agg(
        F.count(F.lit(1)).alias("queue_size"), F.count_if(F.col(label) == 1).alias("fraud_count")
    )
    return counts.withColumn("fraud_density_pct", pct2(F.col("fraud_count"), F.col("queue_size")))


def auto_block(predictions: DataFrame, t: float = BLOCK_SCORE, score: str = "score") -> DataFrame:
    """Transactions to block without review."""
    return predictions.filter(F.col(score) >= t)

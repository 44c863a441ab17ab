"""Training, scoring and model choice with distributed tree ensembles.

The feature table never leaves the cluster: encoding, fitting, scoring and evaluating are Spark
jobs.  Only class counts, bin edges, tree nodes and metrics come to the driver.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema as S
from ..functions.scalars import predict_at, risk_tier
from ..operators.evaluate import areas
from ..operators.rates import class_counts, label_mean, top
from ..operators.running import numbered
from ..operators.selection import SplitPoint, split_point
from ..session import cut_lineage
from . import ensemble
from .boosting import PARTS, Growth, fit
from .ensemble import Ensemble

# The training configuration of the two candidates.
BOOSTING = Growth(
    rounds=1000, depth=8, rate=0.05, rows=0.8, columns=0.4, min_hessian=1.0, l2=1.0, metric="auc", patience=50, seed=42
)
# A share of rows has no effect in the original without a frequency, which is not set there.
LEAFWISE = Growth(
    rounds=1000, depth=8, rate=0.05, rows=1.0, columns=0.4, leaves=63, min_rows=20, min_hessian=1e-3, l2=0.0,
    metric="log_loss", patience=50, seed=42,
)

BOOSTED, LEAF_WISE = "boosted_trees", "leafwise_trees"
#: Texts of a column that are looked up in a list, one after the other.
LISTED = 64
#: How the importance of a candidate's features is measured.
IMPORTANCE = {BOOSTED: "gain", LEAF_WISE: "splits"}


def sentinel_fill(df: DataFrame) -> DataFrame:
    """No NULL left: numbers become -999, texts ``unknown``; so does the literal text ``-999``."""
    numeric = {"tinyint", "smallint", "int", "bigint", "float", "double"}

    def filled(c: str, kind: str) -> str:
        if kind in numeric or kind.startswith("decimal"):
            return f"coalesce(`{c}`, CAST({S.NUM_SENTINEL} AS {kind})) AS `{c}`"
        if kind == "string":
            return f"CASE WHEN `{c}` IS NULL OR `{c}` = '-999' THEN '{S.TEXT_SENTINEL}' ELSE `{c}` END AS `{c}`"
        return f"`{c}`"

    return df.selectExpr(*[filled(c, kind) for c, kind in df.dtypes])


def ml_inputs(df: DataFrame, numeric: list[str] = S.NUMERIC, categorical: list[str] = S.CATEGORICAL) -> DataFrame:
    """Key, label and day with the model's input columns; helper columns are left behind."""
    return df.select(S.KEY, S.LABEL, S.DAY, *numeric, *categorical)


def dictionary(df: DataFrame, columns: list[str] = S.CATEGORICAL) -> DataFrame:
    """(column, value, code): codes 0..n-1 by sorted value, for every text that occurs."""
    cells = df.select(*columns).unpivot([], columns, "column", "value").filter("value IS NOT NULL").distinct()
    return cut_lineage(numbered(cells, ("column",), "value", "code").withColumn("code", F.col("code").cast("int")))


def encode(df: DataFrame, codes: DataFrame, columns: list[str] = S.CATEGORICAL) -> DataFrame:
    """``df`` with ``<column>_code`` per column; a text that ``codes`` lack, or NULL, gets code n.

    A column of at most LISTED texts is looked up in its list, so that wide rows pass no join for it.
    """
    # bounded: one row per column, and LISTED rows for each
    sizes = {r["column"]: r["n"] for r in codes.groupBy("column").agg(F.count(F.lit(1)).alias("n")).collect()}
    short = [c for c in columns if 0 < sizes.get(c, 0) <= LISTED]
    listed: dict[str, list[Column]] = {c: [] for c in short}
    for r in codes.filter(F.col("column").isin(short)).collect() if short else []:
        listed[r["column"]] += F.lit(r["value"]), F.lit(r["code"])
    own, found = list(df.columns), {}
    for c in columns:
        if c in listed:
            found[c] = F.try_element_at(F.create_map(*listed[c]), F.col(c))
        elif c in sizes:
            near = codes.filter(F.col("column") == c).select(F.col("value").alias("_value"), F.col("code").alias(f"_code_{c}"))
            df = df.join(near, F.col(c) == F.col("_value"), "left").drop("_value")
            found[c] = F.col(f"_code_{c}")
        else:
            found[c] = F.lit(None).cast("int")
    return df.select(*own, *[F.coalesce(found[c], F.lit(sizes.get(c, 0))).alias(f"{c}_code") for c in columns])


def label_encode(df: DataFrame, columns: list[str] = S.CATEGORICAL) -> tuple[DataFrame, DataFrame]:
    """``df`` with ``<column>_code`` per column, numbered over all its rows, and the dictionary."""
    codes = dictionary(df, columns)
    return encode(df, codes, columns), codes


def ml_inputs(df: DataFrame, numeric: list[str] = S.NUMERIC, categorical: list[str] = S.CATEGORICAL) -> DataFrame:
    """Key, label and day with the model's input columns; helper columns are left behind."""
    return df.select(S.KEY, S.LABEL, S.DAY, *numeric, *categorical)


def assemble(df: DataFrame, numeric: list[str], categorical: list[str] = S.CATEGORICAL) -> DataFrame:
    """``df`` with the model input ``x``: numbers as they are, texts as codes."""
    names = [*numeric, *[f"{c}_code" for c in categorical]]
    return df.withColumn("x", F.array(*[F.col(c).cast("double") for c in names])).drop(*[f"{c}_code" for c in categorical])


@dataclass
class Prepared:
    """The encoded parts of the time split and what they were encoded with."""

    features: list[str]
    split: SplitPoint
    codes: DataFrame
    train: DataFrame
    validation: DataFrame
    fitted: dict[str, Fitted] = field(default_factory=dict)


@dataclass
class Fitted:
    """A candidate: its name, its trees and the dictionary its input is encoded with."""

    name: str
    trees: Ensemble
    codes: DataFrame

    def inputs(self, feat: DataFrame) -> DataFrame:
        """A feature table as model input."""
        numeric = [c for c in self.trees.features if c not in S.CATEGORICAL]
        return assemble(encode(sentinel_fill(feat), self.codes), numeric)

    def save(self, path: str) -> None:
        """Write the model to a folder, replacing what is there."""
        spark = self.codes.sparkSession
        self.trees.save(spark, f"{path}/trees")
        self.codes.coalesce(1).write.mode("overwrite").parquet(f"{path}/codes")
        spark.createDataFrame([(self.name,)], "name string").coalesce(1).write.mode("overwrite").parquet(f"{path}/name")

    @staticmethod
    def load(spark: SparkSession, path: str) -> Fitted:
        name = spark.read.parquet(f"{path}/name").first()["name"]
        return Fitted(name, Ensemble.load(spark, f"{path}/trees"), spark.read.parquet(f"{path}/codes"))


def prepare(feat: DataFrame, fraction: float = 0.8) -> Prepared:
    """Split by time and assemble the model input.

    The dictionary is made from the training part only; both parts are written once.
    """
    filled = sentinel_fill(feat)
    numeric = S.NUMERIC + S.v_columns(feat)
    split = split_point(filled, fraction)
    codes = dictionary(filled.filter(split.is_train()))
    ready = cut_lineage(assemble(encode(filled, codes), numeric).withColumn("_train", split.is_train()))
    train, validation = (ready.filter(c).drop("_train") for c in ("_train", "NOT _train"))
    return Prepared(numeric + S.CATEGORICAL, split, codes, train, validation)


def split_summary(df: DataFrame, fraction: float = 0.8) -> DataFrame:
    """Rows, frauds and fraud rate of the two parts of the time split."""
    part = F.when(split_point(df, fraction).is_train(), "train").otherwise("validation")
    return label_mean(df.withColumn("part", part), "part")


def pos_weight(train: DataFrame) -> Column:
    """Weight legit/fraud for the positive class, 1 otherwise."""
    ratio = class_counts(train).first()["scale_pos_weight"]
    return F.when(F.col(S.LABEL) == 1, float(ratio if ratio is not None else 1.0)).otherwise(1.0)


def balanced_weight(train: DataFrame) -> Column:
    """Weight n / (2 n_c) for both classes."""
    counts = class_counts(train).first()
    legit, fraud = counts["legit_count"], counts["fraud_count"]
    n = legit + fraud
    return F.when(F.col(S.LABEL) == 1, n / (2.0 * max(fraud, 1))).otherwise(n / (2.0 * max(legit, 1)))


def class_weights(train: DataFrame) -> DataFrame:
    """Both weightings per class, one row."""
    counts = class_counts(train)
    n = F.col("legit_count") + F.col("fraud_count")
    return counts.withColumns(
        {
            "balanced_weight_legit": F.try_divide(n.cast("double"), F.col("legit_count") * 2),
            "balanced_weight_fraud": F.try_divide(n.cast("double"), F.col("fraud_count") * 2),
        }
    )


def _start(train: DataFrame, weight: Column) -> float:
    """The log-odds that both classes start from, by weight; 0 without both classes."""
    import math

    sums = train.agg(F.sum(F.when(F.col(S.LABEL) == 1, weight)).alias("pos"), F.sum(F.when(F.col(S.LABEL) == 0, weight)).alias("neg")).first()
    return math.log(sums["pos"] / sums["neg"]) if sums["pos"] and sums["neg"] else 0.0


def _fit(prepared: Prepared, name: str, weight: Column, growth: Growth, stop_fraction: float, parts: int) -> Fitted:
    early = split_point(prepared.train, 1 - stop_fraction).is_train()
    rows, stop = prepared.train.filter(early), prepared.train.filter(~early)
    trees = fit(rows, stop, weight, _start(rows, weight), prepared.features, growth, parts)
    return Fitted(name, trees, prepared.codes)


def fit_boosted(prepared: Prepared, growth: Growth = BOOSTING, stop_fraction: float = 0.1, parts: int = PARTS) -> Fitted:
    """Trees grown level by level, the positive class weighted up.

    The last ``stop_fraction`` of the training time decides when to stop; the validation part
    stays unseen.
    """
    return _fit(prepared, BOOSTED, pos_weight(prepared.train), growth, stop_fraction, parts)


def fit_leafwise(prepared: Prepared, growth: Growth = LEAFWISE, stop_fraction: float = 0.1, parts: int = PARTS) -> Fitted:
    """Trees grown best leaf first, with balanced class weights: the challenger."""
    return _fit(prepared, LEAF_WISE, balanced_weight(prepared.train), growth, stop_fraction, parts)


def score(fitted: Fitted, df: DataFrame) -> DataFrame:
    """``df`` (model input) with the probability of fraud as ``score``."""
    margin = fitted.trees.margin(df.sparkSession, F.col("x"))
    return df.withColumn("_margin", margin).withColumn("score", 1 / (1 + F.exp(-F.col("_margin")))).drop("_margin")


def compare(scored: dict[str, DataFrame]) -> DataFrame:
    """ROC-AUC and average precision of every candidate, all in one pass.

    Label and score are written once, so the trees run once and not once per job of the evaluation.
    """
    parts = [
        df.select(F.lit(i).alias("position"), F.lit(name).alias("model"), S.LABEL, "score")
        for i, (name, df) in enumerate(scored.items())
    ]
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    found = areas(cut_lineage(rows), by=("position", "model"))
    return found.select("position", "model", "roc_auc", F.col("average_precision").alias("pr_auc"))


def pick_best(results: DataFrame) -> DataFrame:
    """The candidate with the highest ROC-AUC, the first one on a tie."""
    return results.orderBy(F.desc("roc_auc"), "position").limit(1)


def train_candidates(prepared: Prepared, boosting: Growth = BOOSTING, leafwise: Growth = LEAFWISE, parts: int = PARTS) -> dict[str, Fitted]:
    """Fit both candidates once, side by side."""
    from concurrent.futures import ThreadPoolExecutor

    if not prepared.fitted:
        with ThreadPoolExecutor(2) as pool:
            first = pool.submit(fit_boosted, prepared, boosting, parts=parts)
            second = pool.submit(fit_leafwise, prepared, leafwise, parts=parts)
            prepared.fitted = {BOOSTED: first.result(), LEAF_WISE: second.result()}
    return prepared.fitted


def importance(fitted: Fitted, spark: SparkSession, n: int | None = 20) -> DataFrame:
    """Features by their share of the importance, as the candidate measures it (see IMPORTANCE)."""
    table = ensemble.importance(fitted.trees.nodes(spark), fitted.trees.features, IMPORTANCE[fitted.name])
    return table if n is None else top(table, n, by="importance", ties=["feature"])


def predictions(scored: DataFrame, model_name: str) -> DataFrame:
    """The published result: score, decision, tier and the columns investigators filter by."""
    s = F.col("score")
    return scored.select(
        S.KEY,
        s.alias("fraud_score"),
        predict_at(s).alias("fraud_predicted"),
        risk_tier(s).alias("risk_tier"),
        S.LABEL,
        F.lit(model_name).alias("model_used"),
        "is_exotic_browser", "no_browser_os_signal",
        "device_type", "browser_family", "os_version_group", "device_manufacturer", "p_email_group",
        "txn_hour", "txn_time_bucket",
        "card1_txn_count_7d", "amt_to_card_avg_ratio",
    )

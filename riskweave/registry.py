"""Named queries over the test tables; every one reads its whole input."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import fixtures as X
from . import schema as S
from .operators import evaluate as V
from .operators import quality as Q
from .operators import rates as C
from .operators.rolling import velocity
from .operators.selection import seeded_sample, split_point
from .plans import eda, ensemble, explain, features, kpis, model
from .plans.staging import stg_identity, stg_transaction
from .session import cut_lineage, scratch_path
from .sources import catalog, landing

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def named(name: str, fn: Query) -> None:
    QUERIES[name] = fn


# ---------------------------------------------------------------- inputs

def _raw(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    return X.raw_transaction(spark, sf), X.raw_identity(spark, sf)


def _timed(spark: SparkSession, sf: str) -> DataFrame:
    t, i = _raw(spark, sf)
    return features.feat_time(features.int_joined(stg_transaction(t), stg_identity(i)))


def _log9(df: DataFrame) -> DataFrame:
    """Nine digits of the logarithm: math libraries differ in the last bits."""
    return df.withColumn("log_txn_amt", F.round("log_txn_amt", 9))


def _staged(spark: SparkSession, sf: str) -> DataFrame:
    return stg_transaction(X.raw_transaction(spark, sf))


# ---------------------------------------------------------------- loading

def _landed(spark: SparkSession, sf: str) -> DataFrame:
    """The transactions after a trip through landing files: compressed text, upper-case headers
    and four spellings of NULL."""
    raw = X.raw_transaction(spark, sf)
    spellings = ", ".join(f"'{t}'" for t in landing.NULL_TOKENS)
    text = raw.selectExpr(
        *[
            f"coalesce(CAST(`{c}` AS STRING), array({spellings})[CAST((TransactionID + {i}) % 4 AS INT)]) AS `{c.upper()}`"
            for i, c in enumerate(raw.columns)
        ]
    )
    path = scratch_path(spark, "landing")
    landing.write_landing(text, path)
    return landing.read_landing(spark, path)


@query
def load_normalized_transactions(spark, sf):
    raw = X.raw_transaction(spark, sf)
    return landing.load_by_name(_landed(spark, sf), raw.schema)


@query
def load_files_by_header(spark, sf):
    """Two sets of files: columns in opposite orders, one of them without dist2."""
    raw = X.raw_transaction(spark, sf)
    path = scratch_path(spark, "landing")
    landing.write_landing(raw.filter(f"{S.KEY} % 2 = 1"), f"{path}/odd")
    even = raw.filter(f"{S.KEY} % 2 = 0").drop("dist2")
    landing.write_landing(even.select(*[F.col(c).alias(c.lower()) for c in reversed(even.columns)]), f"{path}/even", "null")
    return landing.load_by_name(landing.read_landing(spark, [f"{path}/odd", f"{path}/even"]), raw.schema)


@query
def layered_identity(spark, sf):
    """Raw layer to staging layer, each table found through its layer."""
    catalog.ensure_layers(spark, scratch_path(spark, "layers"))
    catalog.materialize(X.raw_identity(spark, sf), "raw_identity")
    staged = stg_identity(catalog.source(spark, "raw_identity"))
    catalog.materialize(staged, "stg_identity", check=lambda t: Q.assert_no_rows(Q.duplicate_keys(t)))
    return catalog.ref(spark, "stg_identity")


@query
def column_catalog(spark, sf):
    landed = _landed(spark, sf)
    names = {c.upper(): c for c in X.raw_transaction(spark, sf).columns}
    return landing.column_catalog(landed.toDF(*[names[c] for c in landed.columns]))


@query
def load_row_counts(spark, sf):
    tables = zip(("raw_transaction", "raw_identity"), _raw(spark, sf))
    return C.union_all(*[C.row_count(df).select(F.lit(n).alias("table_name"), "n") for n, df in tables])


# ---------------------------------------------------------------- profiling

named("class_balance", lambda s, sf: C.class_balance(X.raw_transaction(s, sf)))
named("label_mean", lambda s, sf: C.label_mean(X.raw_transaction(s, sf)))
named("fraud_rate_hour_dow", lambda s, sf: eda.fraud_rate_hour_dow(X.raw_transaction(s, sf)))
named("amount_stats_by_class", lambda s, sf: C.amount_stats(X.raw_transaction(s, sf)))
named("fraud_rate_email", lambda s, sf: eda.fraud_rate_email(X.raw_transaction(s, sf)))
named("null_counts", lambda s, sf: C.null_counts(X.raw_transaction(s, sf), ["dist1", "dist2", "addr1", "addr2"]))
named("fraud_rate_device_type", lambda s, sf: eda.fraud_rate_device_type(*_raw(s, sf)))
named("fraud_rate_os_version", lambda s, sf: eda.fraud_rate_os_version(*_raw(s, sf)))
named("fraud_rate_manufacturer", lambda s, sf: eda.fraud_rate_manufacturer(*_raw(s, sf)))
named("fraud_rate_device_group", lambda s, sf: eda.fraud_rate_device_group(*_raw(s, sf)))
named("eda_os_features", lambda s, sf: eda.os_features(*_raw(s, sf)))
named("eda_browser_features", lambda s, sf: eda.browser_features(*_raw(s, sf)))
named("eda_device_features", lambda s, sf: eda.device_features(*reversed(_raw(s, sf))))
named("segment_dashboard", lambda s, sf: eda.segment_dashboard(*_raw(s, sf)))


# ---------------------------------------------------------------- feature models

named("stg_transaction", lambda s, sf: _log9(_staged(s, sf)))
named("stg_identity", lambda s, sf: stg_identity(X.raw_identity(s, sf)))


@query
def int_joined(spark, sf):
    t, i = _raw(spark, sf)
    return _log9(features.int_joined(stg_transaction(t), stg_identity(i)))


named("feat_time", lambda s, sf: _log9(_timed(s, sf)))
named("feat_velocity", lambda s, sf: _log9(features.feat_velocity(_timed(s, sf), source=_staged(s, sf))))
named("feat_velocity_window", lambda s, sf: _log9(features.feat_velocity(_timed(s, sf), strategy="window")))
named("feat_velocity_strict", lambda s, sf: _log9(features.feat_velocity(_timed(s, sf), strict=True, source=_staged(s, sf))))
named("feat_velocity_orders", lambda s, sf: velocity(X.velocity_orders(s, sf)))
named("feat_final", lambda s, sf: _log9(features.build(*_raw(s, sf))))
named("feat_final_with_v", lambda s, sf: _log9(features.build(*_raw(s, sf), include_v=True)))


# ---------------------------------------------------------------- quality

named("dq_null_violations", lambda s, sf: Q.not_null_violations(features.build(*_raw(s, sf))))
named("dq_null_violations_raw", lambda s, sf: Q.not_null_violations(X.raw_transaction(s, sf), ["card2", "addr1", "P_emaildomain"]))
named("dq_duplicate_keys", lambda s, sf: Q.duplicate_keys(features.build(*_raw(s, sf))))
named("dq_duplicate_keys_raw", lambda s, sf: Q.duplicate_keys(X.raw_transaction(s, sf), "card1"))
named("dq_report", lambda s, sf: Q.quality_report(features.build(*_raw(s, sf))))
named("dq_class_share", lambda s, sf: Q.class_share(X.raw_transaction(s, sf)))


# ---------------------------------------------------------------- dashboard measures

named("kpi_overview", lambda s, sf: kpis.kpi_overview(_staged(s, sf)))
named("kpi_hour", lambda s, sf: kpis.kpi_rate(_staged(s, sf), "txn_hour"))
named("kpi_email", lambda s, sf: kpis.kpi_rate(_staged(s, sf), "p_email_group"))
named("kpi_product", lambda s, sf: kpis.kpi_rate(_staged(s, sf), "ProductCD"))
named("kpi_browser", lambda s, sf: kpis.kpi_rate(_timed(s, sf), "browser_family"))
named("kpi_off_peak", lambda s, sf: kpis.kpi_off_peak(features.feat_time(_staged(s, sf))))


# ---------------------------------------------------------------- model input

named("ml_inputs", lambda s, sf: _log9(model.ml_inputs(features.build(*_raw(s, sf)))))
named("sentinel_fill", lambda s, sf: model.sentinel_fill(X.raw_transaction(s, sf)))


@query
def label_encode(spark, sf):
    encoded, _ = model.label_encode(_timed(spark, sf).select(S.KEY, *S.CATEGORICAL))
    return encoded.select(S.KEY, *[f"{c}_code" for c in S.CATEGORICAL])


named("time_split_summary", lambda s, sf: model.split_summary(_staged(s, sf)))


@query
def class_weights(spark, sf):
    staged = _staged(spark, sf)
    return model.class_weights(staged.filter(split_point(staged).is_train()))


@query
def validation_sample(spark, sf):
    staged = _staged(spark, sf).select(S.KEY, S.LABEL, S.DAY)
    return seeded_sample(staged.filter(~split_point(staged).is_train()), 5000)


# ---------------------------------------------------------------- evaluation

named("pr_curve", lambda s, sf: V.pr_curve(X.pseudo_scores(s, sf)))
named("average_precision", lambda s, sf: V.average_precision(X.pseudo_scores(s, sf)).select(F.round("average_precision", 10).alias("average_precision")))
named("roc_auc", lambda s, sf: V.roc_auc(X.pseudo_scores(s, sf)).select(F.round("roc_auc", 12).alias("roc_auc")))
named("score_histogram", lambda s, sf: V.score_histogram(X.pseudo_scores(s, sf)))
named("confusion_at_half", lambda s, sf: V.confusion(X.pseudo_scores(s, sf)))
named("threshold_costs", lambda s, sf: V.threshold_costs(X.pseudo_scores(s, sf)))
named("threshold_costs_fine", lambda s, sf: V.threshold_costs(X.pseudo_scores(s, sf), V.FINE_GRID))
named("best_threshold", lambda s, sf: V.best_threshold(V.threshold_costs(X.pseudo_scores(s, sf), V.FINE_GRID)))
named("risk_tiers", lambda s, sf: V.with_tiers(X.pseudo_scores(s, sf)))
named("critical_queue", lambda s, sf: V.critical_queue(V.with_tiers(X.pseudo_scores(s, sf))))
named("auto_block", lambda s, sf: V.auto_block(X.pseudo_scores(s, sf)))


@query
def published_threshold_table(spark, sf):
    path = scratch_path(spark, "threshold_analysis")
    catalog.write_table(V.threshold_costs(X.pseudo_scores(spark, sf)), path)
    return spark.read.parquet(path)


# ---------------------------------------------------------------- stored ensembles

def _stored(name: str) -> model.Fitted:
    """A fixed ensemble under the name of a candidate, so that its importance is measured alike."""
    start, trees = X.ENSEMBLES[name]
    tables = [ensemble.table_of(nodes, X.ENSEMBLE_COLUMNS) for nodes in trees]
    candidate = {"mixed": model.BOOSTED, "stumps": model.LEAF_WISE}[name]
    return model.Fitted(candidate, ensemble.Ensemble(X.ENSEMBLE_COLUMNS, start, tables), None)


def _stored_input(spark: SparkSession, sf: str) -> DataFrame:
    feat = cut_lineage(features.build(*_raw(spark, sf)))
    return model.assemble(feat, X.ENSEMBLE_COLUMNS, [])


def _stored_scores(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    rows = _stored_input(spark, sf)
    return {m.name: model.score(m, rows) for m in map(_stored, X.ENSEMBLES)}


@query
def stored_comparison(spark, sf):
    found = model.compare(_stored_scores(spark, sf))
    return found.withColumns({"roc_auc": F.round("roc_auc", 12), "pr_auc": F.round("pr_auc", 10)})


@query
def stored_best(spark, sf):
    return model.pick_best(model.compare(_stored_scores(spark, sf))).select("position", "model")


@query
def stored_predictions(spark, sf):
    fitted = _stored("mixed")
    found = model.predictions(_stored_scores(spark, sf)[fitted.name], fitted.name)
    return found.withColumn("fraud_score", F.round("fraud_score", 12))


def _stored_attributions(spark: SparkSession, sf: str) -> DataFrame:
    fitted = _stored("stumps")
    rows = explain.attribute(_stored_input(spark, sf), fitted.trees)
    return explain.attribution_rows(rows, fitted.trees.features)


def _nine(name: str):
    return (F.round(name, 9) + 0.0).alias(name)


named("stored_attributions", lambda s, sf: _stored_attributions(s, sf).select(S.KEY, "feature", _nine("contribution")))
named("stored_attribution_summary", lambda s, sf: explain.attribution_summary(_stored_attributions(s, sf)).select("feature", _nine("mean_abs_contribution")))


# ---------------------------------------------------------------- trained models

#: The queries that need trained models.
TRAINED = (
    "model_comparison", "best_model", "predictions", "feature_importance_top20",
    "attributions", "attribution_summary", "drill_through",
)
_trained: dict[tuple[str, str], model.Prepared] = {}


def trained(spark: SparkSession, sf: str) -> model.Prepared:
    """Both candidates, trained once per session and data set with the whole configuration."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _trained:
        ready = model.prepare(cut_lineage(features.build(*_raw(spark, sf))))
        model.train_candidates(ready, model.BOOSTING, model.LEAFWISE)
        _trained[key] = ready
    return _trained[key]


def _scored(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    ready = trained(spark, sf)
    return {name: model.score(m, ready.validation) for name, m in ready.fitted.items()}


@query
def model_comparison(spark, sf):
    return model.compare(_scored(spark, sf))


@query
def best_model(spark, sf):
    return model.pick_best(model.compare(_scored(spark, sf)))


def _best(spark: SparkSession, sf: str) -> model.Fitted:
    return trained(spark, sf).fitted[best_model(spark, sf).first()["model"]]


@query
def predictions(spark, sf):
    best = _best(spark, sf)
    path = scratch_path(spark, "predictions")
    catalog.write_table(model.predictions(_scored(spark, sf)[best.name], best.name), path)
    return spark.read.parquet(path)


@query
def feature_importance_top20(spark, sf):
    return model.importance(_best(spark, sf), spark)


@query
def attributions(spark, sf):
    return explain.attribute(trained(spark, sf).validation, _best(spark, sf).trees)


def _attribution_rows(spark: SparkSession, sf: str) -> DataFrame:
    return explain.attribution_rows(attributions(spark, sf), trained(spark, sf).features)


@query
def attribution_summary(spark, sf):
    return explain.attribution_summary(_attribution_rows(spark, sf))


@query
def drill_through(spark, sf):
    """Drivers of the highest-scored transaction."""
    ready, best = trained(spark, sf), _best(spark, sf)
    scored = model.score(best, ready.validation)
    case = scored.orderBy(F.desc("score"), S.KEY).select(S.KEY).first()[0]
    explained = explain.attribute(ready.validation.filter(F.col(S.KEY) == case), best.trees)
    return explain.drill_through(explain.attribution_rows(explained, ready.features), case)

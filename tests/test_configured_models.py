"""The registered model queries train with the whole configuration."""

from riskweave import registry
from riskweave.plans import model


def test_registered_queries_train_the_configured_models(spark, monkeypatch):
    seen = {}
    monkeypatch.setattr(registry, "_trained", {})
    monkeypatch.setattr(registry, "_raw", lambda *_: ())
    monkeypatch.setattr(registry.features, "build", lambda *_: None)
    monkeypatch.setattr(registry, "cut_lineage", lambda df: df)
    monkeypatch.setattr(model, "prepare", lambda _: model.Prepared([], None, None, None, None))
    monkeypatch.setattr(model, "fit_boosted", lambda _, growth, parts: seen.setdefault("boosted", growth))
    monkeypatch.setattr(model, "fit_leafwise", lambda _, growth, parts: seen.setdefault("leafwise", growth))
    registry.trained(spark, "any")
    assert seen == {"boosted": model.BOOSTING, "leafwise": model.LEAFWISE}
    boosted, leafwise = model.BOOSTING, model.LEAFWISE
    assert (boosted.rounds, boosted.depth, boosted.rate, boosted.rows, boosted.columns) == (1000, 8, 0.05, 0.8, 0.4)
    assert (boosted.metric, boosted.patience, boosted.leaves) == ("auc", 50, None)
    assert (leafwise.rounds, leafwise.depth, leafwise.rate, leafwise.columns) == (1000, 8, 0.05, 0.4)
    assert (leafwise.leaves, leafwise.min_rows, leafwise.patience) == (63, 20, 50)

"""Landing files to published tables."""

from dataclasses import replace

from riskweave import fixtures, registry, schema as S
from riskweave.plans import model, pipeline
from riskweave.session import scratch_path
from riskweave.sources import catalog, landing


def test_files_to_published_tables(spark, sf_dir, tmp_path):
    raw_t, raw_i = fixtures.raw_transaction(spark, sf_dir), fixtures.raw_identity(spark, sf_dir)
    t_path, i_path = scratch_path(spark, "t"), scratch_path(spark, "i")
    landing.write_landing(raw_t, t_path)
    landing.write_landing(raw_i, i_path)
    loaded_t, loaded_i = pipeline.load(spark, t_path, i_path, buckets=4)
    assert loaded_t.count() == raw_t.count() and loaded_i.count() == raw_i.count()

    one_plan = pipeline.build_features(spark)
    expected = registry.QUERIES["feat_final"](spark, sf_dir).drop("log_txn_amt")
    assert one_plan.drop("log_txn_amt").exceptAll(expected).count() == 0
    assert one_plan.count() == raw_t.count()
    first = sorted(map(repr, one_plan.collect()))
    stepwise = pipeline.build_features(spark, keep_steps=True)
    assert sorted(map(repr, stepwise.collect())) == first
    assert spark.catalog.tableExists("staging.int_joined")

    path = scratch_path(spark, "model")
    best = pipeline.train_and_publish(spark, path, replace(model.BOOSTING, rounds=16, depth=4), replace(model.LEAFWISE, rounds=16, leaves=7))
    predictions = catalog.ref(spark, "predictions")
    assert {r[0] for r in predictions.select("model_used").distinct().collect()} == {best}
    costs = catalog.ref(spark, "threshold_analysis").collect()
    assert len(costs) == 9
    assert all(r["true_positives"] + r["false_negatives"] == predictions.filter(f"{S.LABEL} = 1").count() for r in costs)
    assert model.Fitted.load(spark, path).name == best

"""Landing files, schema inference, loading by name, layers and tables."""

import gzip

import pytest
from pyspark.sql import types as T

from riskweave import schema as S
from riskweave.operators import quality as Q
from riskweave.operators import rates as C
from riskweave.sources import catalog, landing


@pytest.fixture(scope="module")
def landed(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("landing") / "part.csv.gz"
    lines = [
        "ISFRAUD,transactionid,ProductCD,dist1,Note,extra,flag",
        '0,1,"W,1",NA,"say ""hi""",9,true',
        "1,2,null,2.5,NULL,9,FALSE",
        "0,3,C,,,9,",
    ]
    with gzip.open(path, "wt") as f:
        f.write("\n".join(lines) + "\n")
    return landing.read_landing(spark, str(path))


def test_null_spellings_and_quotes(landed):
    rows = {r["transactionid"]: r for r in landed.collect()}
    assert (rows["1"]["ProductCD"], rows["1"]["Note"], rows["1"]["dist1"]) == ("W,1", 'say "hi"', None)
    assert (rows["2"]["ProductCD"], rows["2"]["Note"]) == (None, None)
    assert (rows["3"]["dist1"], rows["3"]["Note"]) == (None, None)


def test_inferred_types(landed):
    kinds = {f.name: f.dataType.simpleString() for f in landing.infer_schema(landed).fields}
    assert kinds == {
        "ISFRAUD": "bigint", "transactionid": "bigint", "ProductCD": "string", "dist1": "double",
        "Note": "string", "extra": "bigint", "flag": "boolean"}
    counts = {r["column_name"]: r["n_values"] for r in landing.column_catalog(landed).collect()}
    assert counts["dist1"] == 1 and counts["transactionid"] == 3


def test_inference_of_odd_numbers(spark):
    df = spark.sql("SELECT * FROM VALUES ('1', '007', '1e3', '-1.', 'nan'), (NULL, '-5', '.5', '2', '1') AS t(a, b, c, d, e)")
    assert [f.dataType.simpleString() for f in landing.infer_schema(df)] == [
        "bigint", "bigint", "double", "double", "string"]


def test_load_by_name(landed):
    target = T.StructType([
        T.StructField(S.KEY, T.LongType()), T.StructField(S.LABEL, T.IntegerType()),
        T.StructField("dist1", T.DoubleType()), T.StructField("absent", T.StringType())])
    loaded = landing.load_by_name(landed, target)
    assert loaded.schema.names == [S.KEY, S.LABEL, "dist1", "absent"]
    assert sorted(map(tuple, loaded.collect())) == [(1, 0, None, None), (2, 1, 2.5, None), (3, 0, None, None)]
    with pytest.raises(ValueError):
        landing.load_by_name(loaded.selectExpr("1 AS a", "2 AS A"), target)


def test_layers_and_tables(spark):
    catalog.ensure_layers(spark)
    catalog.ensure_layers(spark)
    assert set(catalog.LAYERS) <= set(catalog.list_layers(spark))
    assert catalog.layer_for("feat_final") == "features"
    assert catalog.layer_for("anything", " ml ") == "ml"
    with pytest.raises(KeyError):
        catalog.layer_for("anything")
    catalog.use_layer(spark, "ml")
    assert spark.catalog.currentDatabase() == "ml"
    catalog.use_layer(spark, "default")
    df = spark.range(5).withColumnRenamed("id", S.KEY)
    assert catalog.materialize(df, "feat_final").count() == 5
    catalog.materialize(df.limit(3), "feat_final")
    assert catalog.load_features(spark).count() == 3
    catalog.write_table(df, "raw.raw_transaction")
    assert catalog.source(spark, "raw_transaction").count() == 5
    assert catalog.describe(df) == [(S.KEY, "bigint")]
    assert catalog.preview(df, 2).count() == 2


def test_bucketed_tables_join_without_shuffle(spark):
    catalog.ensure_layers(spark)
    df = spark.range(1000).withColumnRenamed("id", S.KEY)
    left = catalog.materialize(df, "raw_transaction", bucket_by=S.KEY, buckets=4)
    right = catalog.materialize(df, "raw_identity", bucket_by=S.KEY, buckets=4)
    joined = left.join(right.hint("merge"), S.KEY, "left")
    assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
    assert joined.count() == 1000


def test_expectations(spark):
    df = spark.createDataFrame([(1, 0, 5.0), (1, 1, None), (None, 0, -2.0)], f"{S.KEY} long, {S.LABEL} int, {S.AMOUNT} double")
    assert Q.not_null_violations(df, [S.KEY, S.AMOUNT]).count() == 2
    assert [tuple(r) for r in Q.duplicate_keys(df).collect()] == [(1, 2)]
    assert Q.amount_violations(df).count() == 1
    Q.assert_count(df, 3)
    Q.assert_class_share(df, 33, 34)
    Q.assert_no_rows(df.filter("false"))
    for failing in (lambda: Q.assert_count(df, 4), lambda: Q.assert_class_share(df, 1, 2), lambda: Q.assert_no_rows(df)):
        with pytest.raises(AssertionError):
            failing()


def test_counting_operators(spark):
    df = spark.createDataFrame([("a", 1), ("a", 0), ("b", 1), (None, 0)], f"k string, {S.LABEL} int")
    rates = {r["k"]: (r["total"], r["fraud_count"], r["fraud_rate_pct"]) for r in C.fraud_rate(df, ["k"]).collect()}
    assert rates == {"a": (2, 1, 50.0), "b": (1, 1, 100.0), None: (1, 0, 0.0)}
    assert [r["k"] for r in C.top(C.fraud_rate(df, ["k"]), 2, ties=["k"]).collect()] == ["b", "a"]
    assert C.fraud_rate(df, ["k"], min_total=1).count() == 1
    assert C.require_not_null(df, "k").count() == 3
    assert [tuple(r) for r in C.null_counts(df, ["k", S.LABEL]).collect()] == [("k", 1), (S.LABEL, 0)]
    assert C.union_all(df, df).count() == 8


def test_amount_stats_by_sketch(spark, sf_dir):
    from riskweave import fixtures

    raw = fixtures.raw_transaction(spark, sf_dir)
    exact, sketch = ({r[S.LABEL]: r for r in C.amount_stats(raw, approx=a).collect()} for a in (False, True))
    for label, row in exact.items():
        assert (row["min_amt"], row["avg_amt"], row["max_amt"]) == tuple(sketch[label][c] for c in ("min_amt", "avg_amt", "max_amt"))
        assert abs(row["median_amt"] - sketch[label]["median_amt"]) < 1


def test_long_whole_numbers_keep_their_digits(spark):
    df = spark.sql(
        "SELECT * FROM VALUES ('1', '1234567890123456789', '1234567890123456789', '1'), (NULL, '-5', '0.5', repeat('9', 40)) AS t(a, b, c, d)"
    )
    assert [f.dataType.simpleString() for f in landing.infer_schema(df)] == ["bigint", "decimal(38,0)", "string", "string"]


def test_files_are_read_by_their_own_header(spark, tmp_path):
    (tmp_path / "1.csv").write_text("a,b\nx,1\n\"p,q\",NA\n")
    (tmp_path / "2.csv").write_text("B,a\n2,y\n")
    (tmp_path / "3 %41.csv").write_text("c\nz\n")
    (tmp_path / "4.csv").write_text("")
    (tmp_path / "5.csv").write_text("a,b\n")
    with gzip.open(tmp_path / "6.csv.gz", "wt") as f:
        f.write("b,c,a\n3,w,v\n")
    found = landing.read_landing(spark, str(tmp_path))
    assert sorted(c.lower() for c in found.columns) == ["a", "b", "c"]
    rows = {tuple(r) for r in found.select("a", "b", "c").collect()}
    assert rows == {("x", "1", None), ("p,q", None, None), ("y", "2", None), (None, None, "z"), ("v", "3", "w")}
    assert landing.headers(spark, str(tmp_path)).count() == 4
    (tmp_path / "7.csv").write_text("a,A\n1,2\n")
    with pytest.raises(ValueError):
        landing.read_landing(spark, str(tmp_path))


def test_a_failed_check_leaves_the_published_table(spark):
    catalog.ensure_layers(spark)
    df = spark.range(4).withColumnRenamed("id", S.KEY)
    catalog.materialize(df, "predictions", check=lambda written: Q.assert_count(written, 4))
    reader = catalog.ref(spark, "predictions")
    with pytest.raises(AssertionError):
        catalog.materialize(df.limit(1), "predictions", check=lambda written: Q.assert_count(written, 4))
    assert catalog.ref(spark, "predictions").count() == 4
    catalog.materialize(df.limit(2), "predictions")
    # who reads the version before goes on reading it
    assert (reader.count(), catalog.ref(spark, "predictions").count()) == (4, 2)
    for n in (1, 3, 2):
        catalog.materialize(df.limit(n), "predictions")
    versions = [t.name for t in spark.catalog.listTables("ml") if t.name.startswith("predictions__")]
    assert len(versions) == 2 and catalog.ref(spark, "predictions").count() == 2


def test_checks_while_writing(spark, tmp_path):
    df = spark.createDataFrame([(1, 0, 5.0), (1, 1, None), (None, 0, -2.0)], f"{S.KEY} long, {S.LABEL} int, {S.AMOUNT} double")
    watched, found = Q.watch(df, [S.KEY, S.LABEL])
    watched.write.parquet(f"{tmp_path}/copy")
    assert found.get == {f"not_null:{S.KEY}": 1, f"not_null:{S.LABEL}": 0, f"log_domain:{S.AMOUNT}": 1}
    with pytest.raises(AssertionError):
        Q.assert_watched(found)
    watched, found = Q.watch(df.filter(f"{S.KEY} = 1"), [S.KEY, S.LABEL])
    watched.write.parquet(f"{tmp_path}/good")
    Q.assert_watched(found)

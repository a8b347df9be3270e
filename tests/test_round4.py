"""What the fits and set operations keep, shuffle and read: the findings of FINDINGS_r03.md."""

import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import functions as F

from corvid import session
from corvid.operators import features, models, recommend, setops, tuning
from corvid.plans import jobs, queries


def _record_als(monkeypatch):
    made = []
    real = recommend.als

    def als(*args, **kw):
        made.append(kw)
        return real(*args, **kw)

    monkeypatch.setattr(recommend, "als", als)
    return made


def _rating_rows(spark):
    rows = [(u, m, float((u * m) % 5), 100 * u + m) for u in range(12) for m in range(8)]
    return spark.createDataFrame(rows, "userId int, movieId int, rating double, timestamp long")


def test_fits_over_splits_are_checkpointed(spark, monkeypatch):
    made = _record_als(monkeypatch)
    ratings = _rating_rows(spark)
    table, fitted = recommend.evaluate_over_splits(
        ratings, ["timestamp", "userId", "movieId"], [0.5, 0.8], {"own": {"rank": 2, "checkpointInterval": 2}, "given": {"rank": 2}}, seed=1
    )
    assert table.count() == len(fitted) == 4
    assert [kw["checkpointInterval"] for kw in made] and {kw["checkpointInterval"] for kw in made} == {2, recommend.ROUNDS_KEPT}
    assert {kw["blocks"] for kw in made} == {recommend.BLOCKS}


def test_single_fits_have_fewer_blocks(spark, monkeypatch):
    made = _record_als(monkeypatch)
    monkeypatch.setattr(queries, "_ratings", lambda s, d: _rating_rows(s))
    assert queries.q_als_factors(spark, None).count() == 10
    assert queries.q_als_known_pairs(spark, None).count() == 4  # of the users rated before
    assert [kw["blocks"] for kw in made] == [recommend.BLOCKS] * 2


def test_except_digest_reads_each_side_few_times(spark):
    read = spark.sparkContext.accumulator(0)

    def seen(x):
        read.add(1)
        return x

    rows = spark.range(300).select((F.col("id") % 200).alias("x"), F.udf(seen, "long")("id").alias("y"))
    other = spark.range(100).select("id", F.col("id").alias("y"))
    got = setops.except_digest(rows, other).collect()
    assert sorted(r.y for r in got) == list(range(100, 300))
    assert read.value <= 3 * 300


def test_dealt_scan_has_parts_by_size(spark, tmp_path, monkeypatch):
    spark.range(20_000).coalesce(1).write.parquet(str(tmp_path / "t"))
    scan = spark.read.parquet(str(tmp_path / "t"))
    cores = spark.sparkContext.defaultParallelism
    assert session.spread_scan(scan).rdd.getNumPartitions() == cores
    monkeypatch.setattr(session, "PART_BYTES", 4000)
    dealt = session.spread_scan(scan)
    assert dealt.rdd.getNumPartitions() > cores
    assert dealt.agg(F.sum("id")).first()[0] == sum(range(20_000))


def _folds(spark):
    rows = spark.range(240).select(F.col("id").cast("double").alias("x"), (F.col("id") % 240 > 150).cast("double").alias("label"), (F.col("id") % 3).cast("int").alias("fold"))
    return features.assemble(rows, ["x"], "features")


def test_given_folds_keep_no_copies(spark, monkeypatch):
    tree = models.decision_tree("label", maxBins=8)
    grid = tuning.param_grid(tree, {"maxDepth": [0, 2]})
    ev = MulticlassClassificationEvaluator(labelCol="label", metricName="accuracy")
    rows = _folds(spark)
    want = CrossValidator(estimator=tree, estimatorParamMaps=grid, evaluator=ev, numFolds=3, foldCol="fold").fit(rows)
    kept = []
    real = type(rows).persist
    monkeypatch.setattr(type(rows), "persist", lambda self, *a: kept.append(1) or real(self, *a))
    got = tuning.cross_validate(tree, grid, ev, rows, folds=3, fold_col="fold")
    assert len(kept) == 1
    assert got.avgMetrics == pytest.approx(list(want.avgMetrics)) and got.stdMetrics == pytest.approx(list(want.stdMetrics))
    assert got.bestModel.depth == want.bestModel.depth == 1


@pytest.mark.parametrize("fold", ["3", "CAST(NULL AS INT)", "0", "fold % 2"])
def test_given_folds_are_checked(spark, fold):
    tree = models.decision_tree("label")
    with pytest.raises(ValueError):
        tuning.cross_validate(tree, [{}], MulticlassClassificationEvaluator(labelCol="label"), _folds(spark).withColumn("fold", F.expr(fold)), folds=3, fold_col="fold")


def test_claims_models_keep_both_parts(spark):
    """The rows are read for the training part and the test part, not again for each model's scores."""
    read = spark.sparkContext.accumulator(0)

    def seen(x):
        read.add(1)
        return x

    rows = spark.range(400).select("id", (F.col("id") % 3).alias("n"), (F.col("id") % 3 >= 1).cast("int").alias("c"), F.udf(seen, "double")((F.col("id") % 7).cast("double")).alias("x"))
    out = jobs.claims_models(rows, "id", ["x"], [], count_label="n", binary_label="c", reg_grid=[10.0], folds=2, seed=1)
    assert len(out["metrics"].collect()) == 5
    assert read.value <= 3 * 400

"""Composite jobs on the smallest tables: shapes and invariants."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from corvid.operators import logs, models
from corvid.plans import jobs
from corvid.sources import fixtures


def test_log_report_matches_single_reports(spark):
    lines = fixtures.access_log_lines(spark, SF_SMALL)
    rep = jobs.log_report(lines, n=9)
    parsed = logs.parse(lines)
    assert sorted(map(tuple, rep["top_hosts"].collect())) == sorted(map(tuple, logs.top_hosts(parsed, 9).collect()))
    assert sorted(map(tuple, rep["summary"].collect())) == sorted(map(tuple, logs.country_summary(parsed).collect()))
    dense = logs.heatmap(parsed, by="top_host", dense=True)
    assert sorted(map(tuple, rep["heatmap_top_host"].collect())) == sorted(map(tuple, dense.collect()))
    share = rep["host_share"].groupBy("country").agg(F.sum("requests").alias("s"))
    totals = {r.country: r.requests for r in rep["summary"].collect()}
    assert {r.country: r.s for r in share.collect()} == totals


def test_claims_models_job(spark):
    claims = fixtures.claims(spark, SF_SMALL)
    out = jobs.claims_models(
        claims, "o_orderkey", ["Exposure", "o_totalprice"], ["o_orderpriority"], reg_grid=[0.01, 10.0], folds=3, seed=1
    )
    m = {(r.model, r.metric): r.value for r in out["metrics"].collect()}
    assert set(m) == {("poisson", "rmse"), ("logistic_l1", "auc"), ("logistic_l1", "accuracy"), ("logistic_l2", "auc"), ("logistic_l2", "accuracy")}
    assert all(0.0 <= m[(k, "auc")] <= 1.0 for k in ("logistic_l1", "logistic_l2"))
    cv = out["cv"].filter("is_best").groupBy("model").count().collect()
    assert {r.model: r["count"] for r in cv} == {"poisson": 1, "logistic_l1": 1, "logistic_l2": 1}
    width = 2 + 5
    assert out["coefficients"].filter("model = 'poisson'").count() == width + 1


def test_compare_classifiers_separable(spark):
    df = fixtures.particles_separable(spark, SF_SMALL)
    est = {
        "rf": (models.random_forest("label", numTrees=5, maxBins=64, seed=1), {"maxDepth": [1, 3]}),
        "gbt": (models.gbt("label", maxIter=5, maxBins=64, seed=1), {"maxDepth": [2]}),
    }
    out = jobs.compare_classifiers(
        df, ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"], "label", ["l_quantity", "l_discount"], est,
        sample_fraction=0.5, folds=3, seed=1,
    )
    m = {(r.model, r.metric): r.value for r in out["metrics"].collect()}
    assert m[("rf", "balanced_accuracy")] == 1.0 and m[("gbt", "auc")] == 1.0


def test_recommender_report(spark):
    ratings = fixtures.ratings(spark, SF_SMALL)
    movies = fixtures.movies(spark, SF_SMALL)
    out = jobs.recommender_report(ratings, movies, fractions=[0.8], settings={"s": {"maxIter": 3, "rank": 4}}, k=3, seed=1)
    assert out["metrics"].count() == 1
    sizes = [r.size for r in out["top_clusters"].orderBy("rank").collect()]
    assert sizes == sorted(sizes, reverse=True) and len(sizes) <= 3
    assert out["top_genres"].count() <= 10


def test_run_jobs_cli_writes_reports(spark, tmp_path):
    import importlib.util
    import os

    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "scripts", "run_jobs.py")
    spec = importlib.util.spec_from_file_location("run_jobs", path)
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    out = tmp_path / "reports"
    mod.main(["--out", str(out), "--jobs", "logs", "--sf-dir", SF_SMALL])
    summary = spark.read.parquet(str(out / "logs" / "summary"))
    assert {r.country for r in summary.collect()} == {"de", "ca", "sg"}


def test_claims_models_with_exposure_offset(spark):
    claims = fixtures.claims(spark, SF_SMALL)
    out = jobs.claims_models(
        claims, "o_orderkey", ["o_totalprice"], ["o_orderpriority"], reg_grid=[0.01], folds=2, seed=1,
        exposure_offset="Exposure",
    )
    m = {(r.model, r.metric): r.value for r in out["metrics"].collect()}
    assert m[("poisson", "rmse")] > 0

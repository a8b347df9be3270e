from pyspark.ml.classification import LogisticRegression

from corvid.operators import features, models, tuning


def test_param_grid_is_cartesian(spark):
    lr = LogisticRegression()
    grid = tuning.param_grid(lr, {"regParam": [0.1, 1.0], "elasticNetParam": [0.0, 0.5, 1.0]})
    assert len(grid) == 6


def test_coefficient_table_and_feature_names(spark):
    df = spark.createDataFrame(
        [(1.0, "a", 0.0), (2.0, "a", 1.0), (3.0, "b", 1.0), (4.0, "b", 1.0), (5.0, "c", 0.0), (0.5, "c", 0.0)],
        "x double, cat string, y double",
    )
    model, (d,) = features.fit_transform(features.feature_pipeline(["x"], ["cat"]), df)
    width = features.vector_width(d, "features")
    assert width == 1 + 3  # scaled x + three seen categories (keep + drop-last)
    names = features.feature_names(d, "features")
    assert len(names) == width
    fit = models.logistic("y", regParam=0.1).fit(d)
    table = models.coefficient_table(spark, fit, names).orderBy("position").collect()
    assert table[0].term == "(intercept)" and len(table) == width + 1


def test_report_sinks(spark, tmp_path):
    from corvid.sources import sinks

    df = spark.createDataFrame([(1, "a")], "id int, name string")
    rep = {r.name: (r.type, r.nullable) for r in sinks.schema_report(df).collect()}
    assert rep == {"id": ("int", True), "name": ("string", True)}
    path = sinks.write_report(df, str(tmp_path / "rep"), fmt="csv")
    back = spark.read.option("header", True).csv(path)
    assert back.count() == 1 and sinks.preview(df, 1).count() == 1


def test_regression_metric_override(spark):
    from corvid.operators import metrics

    df = spark.createDataFrame([(1.0, 2.0), (3.0, 3.0)], "label double, prediction double")
    row = metrics.regression_metric(df, "mae").first()
    assert (row.metric, row.value) == ("mae", 0.5)


def test_poisson_offset_scales_predictions(spark):
    import math

    from pyspark.sql import functions as F

    rows = [(float(i % 3), 0.5 + (i % 4) * 0.5, float((i % 3) + (i % 2))) for i in range(60)]
    df = spark.createDataFrame(rows, "x double, exposure double, y double").withColumn("log_exp", F.log("exposure"))
    d = features.assemble(df, ["x"], "features")
    fit = models.poisson("y", offset="log_exp", regParam=0.0).fit(d)
    r = fit.transform(d).first()
    want = math.exp(fit.intercept + fit.coefficients[0] * r.x + math.log(r.exposure))
    assert abs(r.prediction - want) < 1e-9


def test_readers_gzip_and_headerless_csv(spark, tmp_path):
    import gzip

    from corvid.sources import readers

    p = tmp_path / "log.gz"
    with gzip.open(p, "wt") as f:
        f.write("\n".join(f"h{i}.de - - [01/Jul/1995:00:00:0{i % 10} -0400] \"GET / HTTP/1.0\" 200 {i}" for i in range(50)))
    lines = readers.read_text_lines(spark, str(p), min_partitions=4)
    assert lines.rdd.getNumPartitions() >= 4 and lines.count() == 50
    c = tmp_path / "p.csv"
    c.write_text("1,0.5,2\n0,1.5,3\n")
    df = readers.read_headerless_csv(spark, str(c), ["label", "a", "b"])
    assert [tuple(r) for r in df.orderBy("label").collect()] == [(0.0, 1.5, 3.0), (1.0, 0.5, 2.0)]

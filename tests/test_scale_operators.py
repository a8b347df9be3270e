"""Operators whose state is a table or a sketch: against plain computation, with hot keys, ties and odd values."""

import collections
import datetime as dt
import gzip
import math
import os
import random

import pytest
from pyspark.errors import PySparkException
from pyspark.ml.feature import StringIndexer
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corvid.operators import cuts, dictionary, heavy, logs, metrics, ranks, sampling, selection, setops
from corvid.sources import files, gzip_index, readers, sinks

# ------------------------------------------------------------------- ranks


def test_ranked_orders_all_rows(spark):
    rng = random.Random(1)
    rows = [(rng.choice([None, 1, 2, 2, 2]), f"k{i:04d}") for i in range(500)]
    df = spark.createDataFrame(rows, "a int, b string").repartition(7)
    got = sorted((r["rank"], r.a, r.b) for r in ranks.ranked(df, ["a", "b"]).collect())
    want = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    assert [(a, b) for _, a, b in got] == want and [r for r, *_ in got] == list(range(500))
    assert ranks.ranked(df.limit(0), ["a", "b"]).count() == 0


def test_ordered_splits_equal_rows_with_salt(spark):
    df = spark.range(4000).select(F.lit(1).alias("a")).repartition(8)
    parts = ranks.ordered(df, ["a"], salt=True, partitions=8).select(ranks.partition_of().alias("p")).distinct().count()
    assert parts > 3
    assert ranks.ranked(df, ["a"], salt=True).select("rank").distinct().count() == 4000


# -------------------------------------------------------------- dictionary


@pytest.mark.parametrize("order", ["frequencyDesc", "frequencyAsc", "alphabetDesc", "alphabetAsc"])
def test_dictionary_equals_string_indexer(spark, order):
    rng = random.Random(2)
    rows = [(i, rng.choice(["hot"] * 60 + [f"u{i}", "b", "c", "", "é"])) for i in range(600)]
    df = spark.createDataFrame(rows, "id int, v string")
    want = {r.id: int(r.x) for r in StringIndexer(inputCol="v", outputCol="x", stringOrderType=order).fit(df).transform(df).collect()}
    got = dictionary.apply(df, dictionary.fit(df, "v", order), "v")
    assert got.columns == ["id", "v", "v_index"] and {r.id: r.v_index for r in got.collect()} == want


def test_dictionary_of_unseen_values_and_nulls(spark):
    train = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "v string")
    d = dictionary.fit(train, "v")
    assert sorted((r.label, r.n, r["index"]) for r in d.collect()) == [("a", 2, 0), ("b", 1, 1)]
    test = spark.createDataFrame([(1, "b"), (2, "new"), (3, None), (4, "a")], "id int, v string")
    kept = dictionary.apply(test, d, "v", "x", "keep")
    assert {r.id: r.x for r in kept.collect()} == {1: 1, 2: 2, 3: 2, 4: 0}
    assert {r.id: r.x for r in dictionary.apply(test, d, "v", "x", "skip").collect()} == {1: 1, 4: 0}
    for bad in ("id = 2", "id = 3"):
        with pytest.raises(PySparkException, match="not in the dictionary"):
            dictionary.apply(test.where(bad), d, "v").collect()
    numbers = spark.createDataFrame([(3,), (3,), (10,)], "n int")
    assert sorted((r.n, r.n_index) for r in dictionary.fit_apply(numbers, ["n"]).collect()) == [(3, 0), (3, 0), (10, 1)]
    empty = dictionary.fit(train.limit(0), "v")
    assert empty.count() == 0 and [r.x for r in dictionary.apply(test, empty, "v", "x", "keep").collect()] == [0] * 4


def test_dictionary_collects_no_labels(spark, monkeypatch):
    """A column with a value for each row: what reaches the driver does not grow with it."""
    df = spark.range(5000).select(F.concat(F.lit("label-"), "id").alias("v"))
    seen, collect = [], type(df).collect
    monkeypatch.setattr(type(df), "collect", lambda self: seen.append(len(out := collect(self))) or out)
    out = dictionary.fit_apply(df, ["v"])
    assert sum(seen) < 100
    monkeypatch.undo()
    assert out.agg(F.count_distinct("v_index")).first()[0] == 5000


# -------------------------------------------------------------------- cuts

CUT_SCHEMA = "t long, x double, u int, pad string"


def _cut_rows(seed, n):
    rng = random.Random(seed)
    t = [None, *[5] * 20, *range(30), 1 << 62, -(1 << 62)]
    x = [None, math.nan, math.inf, -math.inf, 0.0, 1e-300, 1e300, *[2.5] * 10]
    return [(rng.choice(t), rng.choice(x), rng.choice([None, 1, 2, 3]), f"p{rng.randrange(3)}") for _ in range(n)]


def _lexicographic(r):
    key = []
    for v in r[:3]:
        nan = isinstance(v, float) and math.isnan(v)
        key += [v is None, nan, 0 if v is None or nan else v]
    return key


@pytest.mark.parametrize("seed,buckets", [(1, 1 << 16), (2, 40), (3, 1 << 16)])
def test_many_cuts_take_the_first_rows(spark, seed, buckets):
    rows = _cut_rows(seed, 700)
    df = spark.createDataFrame(rows, CUT_SCHEMA).repartition(5)
    wanted = {f"r{r}": r for r in (0, 1, 3, 50, 51, 233, 350, 500, 640, 699, 700, 900)}
    got = cuts.mark_heads(df, ["t", "x", "u"], wanted, buckets=buckets).collect()
    assert len(got) == 700
    # of rows that are equal in the order columns any may be in the head: compare the keys
    for name, r in wanted.items():
        head = sorted((str(_lexicographic(g)) for g in got if g[name]))
        assert head == sorted(str(_lexicographic(x)) for x in sorted(rows, key=_lexicographic)[:r]), name
    nested = sorted(wanted, key=wanted.get)
    assert all(g[b] or not g[a] for g in got for a, b in zip(nested, nested[1:]))


def test_passes_do_not_grow_with_the_cuts(spark):
    df = spark.range(20_000).select((F.col("id") * 7919 % 20_011).alias("t"), "id")
    keyed = selection.key_frame(df, ["t", "id"])
    passes = []
    for fractions in ([0.5], [i / 10 for i in range(1, 10)], [i / 50 for i in range(1, 50)]):
        trace = []
        n, found = cuts.search(keyed, [int(f * 20_000) for f in fractions], trace=trace)
        assert n == 20_000 and len(found) == len(fractions)
        passes.append(len(trace))
    assert max(passes) <= passes[0] + 1


def test_cuts_in_one_hot_value_and_of_copies(spark):
    rows = spark.range(3000).select(F.when(F.col("id") < 2500, 7).otherwise(F.col("id")).alias("t"))
    got = cuts.mark_heads(rows, ["t"], {"a": 10, "b": 2000, "c": 2500, "d": 2600})
    assert [got.agg(F.count_if(c)).first()[0] for c in "abcd"] == [10, 2000, 2500, 2600]
    same = spark.createDataFrame([(None, None)] * 50, "t int, u double")
    got = cuts.mark_heads(same, ["t", "u"], {"a": 20, "b": 49})
    assert got.agg(F.count_if("a"), F.count_if("b"), F.count("*")).first()[:] == (20, 49, 50)
    assert cuts.mark_heads(same.limit(0), ["t"], {"a": 1}).collect() == []


def test_chrono_split_on_timestamps(spark):
    start = dt.datetime(2020, 1, 1)
    df = spark.createDataFrame([(start + dt.timedelta(seconds=i // 3), i) for i in range(100)], "ts timestamp_ntz, id int")
    got = sampling.chrono_split(df, ["ts", "id"], [0.1, 0.25, 0.405])
    for name, n in (("train_10", 10), ("train_25", 25), ("train_40_5", 40)):
        assert sorted(r.id for r in got.where(name).collect()) == list(range(n))


# ------------------------------------------------------------------- heavy


@pytest.mark.parametrize("width,depth,n", [(1 << 16, 2, 5), (4, 2, 5), (1, 1, 3), (64, 3, 40)])
def test_heavy_hitters_are_exact(spark, width, depth, n):
    rng = random.Random(width)
    rows = [(g, k, rng.randrange(1, 4)) for g in ("a", "b") for k in (f"k{int(rng.paretovariate(0.7))}" for _ in range(800))]
    rows += [("tie", f"t{i}", 1) for i in range(30)] + [("few", "one", 2), ("a", None, 5)]
    df = spark.createDataFrame(rows, "g string, k string, w long")
    for weight in (None, "w"):
        held = collections.defaultdict(collections.Counter)
        for g, k, w in rows:
            if k is not None:
                held[g][k] += w if weight else 1
        want = sorted((g, i + 1, k, c) for g, own in held.items() for i, (k, c) in enumerate(sorted(own.items(), key=lambda x: (-x[1], x[0]))[:n]))
        got = heavy.heavy_hitters(df, n, ["g"], "k", "c", weight, width, depth)
        assert sorted(map(tuple, got.collect())) == want


def test_frequency_sketch_bounds_and_merges(spark):
    rows = [("g", f"k{i % 997 if i % 3 else 0}") for i in range(9000)]
    df = spark.createDataFrame(rows, "g string, k string")
    whole = heavy.sketch(df, ["g"], "k", width=256)
    halves = heavy.sketch(df.where("k < 'k5'"), ["g"], "k", width=256).union(heavy.sketch(df.where("k >= 'k5'"), ["g"], "k", width=256))
    assert sorted(map(tuple, heavy.merge(halves, ["g"]).collect())) == sorted(map(tuple, whole.collect()))
    bound = {r.k: r.bound for r in heavy.upper_bounds(df.distinct(), whole, ["g"], "k", 256).collect()}
    true = collections.Counter(k for _, k in rows)
    over = [bound[k] - n for k, n in true.items()]
    assert min(over) >= 0 and sum(over) / len(over) <= 9000 / 256


def _visits(spark, n_hosts):
    return spark.range(n_hosts * 3).select(
        F.when(F.col("id") % 3 == 0, "de").otherwise("ca").alias("country"), F.concat(F.lit("h"), F.col("id") % n_hosts).alias("host"),
        (F.col("id") % 28 + 1).cast("int").alias("day"), (F.col("id") % 24).cast("int").alias("hour"),
    )


def test_host_sketches_by_range(spark, tmp_path):
    visits = _visits(spark, 400)
    ranges = spark.createDataFrame([(1, 3), (1, 28), (5, 5), (29, 31)], "first_day int, last_day int")
    logs.host_sketches(visits).write.parquet(str(tmp_path / "s"))
    got = {tuple(r) for r in logs.unique_hosts_in_ranges(spark.read.parquet(str(tmp_path / "s")), ranges).collect()}
    exact = visits.join(ranges, F.col("day").between(F.col("first_day"), F.col("last_day"))).groupBy("country", "first_day", "last_day").agg(F.count_distinct("host"))
    assert got == {tuple(r) for r in exact.collect()}


def test_host_sketch_error_bound(spark):
    visits = _visits(spark, 30_000)
    ranges = spark.createDataFrame([(1, 28)], "first_day int, last_day int")
    exact = {r.country: r.n for r in visits.groupBy("country").agg(F.count_distinct("host").alias("n")).collect()}
    for lg in (8, 12):
        got = logs.unique_hosts_in_ranges(logs.host_sketches(visits, lg_entries=lg), ranges, lg)
        for r in got.collect():
            assert abs(r.unique_hosts - exact[r.country]) <= 4 * 2 ** (-lg / 2) * exact[r.country]


# --------------------------------------------------------------------- AUC


def test_auc_by_group_equals_auc_exact(spark):
    rng = random.Random(3)
    rows = [("hot", float(rng.choice([1, 1])), 0.5) for _ in range(300)]
    rows += [(m, float(rng.random() < 0.4), s) for m in ("a", "b", None) for s in (rng.choice([rng.random(), 0.25, None, math.nan, -math.inf]) for _ in range(400))]
    rows += [("a", None, 0.3), ("one", 1.0, 0.3), ("one", 1.0, 0.4)]
    df = spark.createDataFrame(rows, "m string, label double, score double")
    got = {r.m: tuple(r)[1:] for r in metrics.auc_by_group(df, ["m"]).collect()}
    assert set(got) == {"hot", "a", "b", None, "one"}
    for m in got:
        want = metrics.auc_exact(df.where(F.col("m").eqNullSafe(F.lit(m)))).first()
        assert got[m][1:] == tuple(want)[1:]
        assert got[m][0] == want[0] if want[0] is None else abs(got[m][0] - want[0]) < 1e-12
    assert metrics.auc_by_group(df.limit(0), ["m"]).collect() == []


def test_auc_of_a_model_in_many_partitions(spark):
    df = spark.range(20_000).select(F.lit("m").alias("m"), (F.col("id") % 2).cast("double").alias("label"), F.pmod(F.xxhash64("id"), F.lit(1 << 40)).cast("double").alias("score"))
    got, want = metrics.auc_by_group(df, ["m"]).first(), metrics.auc_exact(df).first()
    assert abs(got["auc"] - want["auc"]) < 1e-12


# ------------------------------------------------------------------ EXCEPT


@pytest.mark.parametrize("left,right", [(60, 400), (400, 60), (0, 30), (30, 0)])
def test_except_digest_equals_subtract(spark, left, right):
    rng = random.Random(left)
    row = lambda: (rng.choice([None, 1, 2, 3]), rng.choice([None, math.nan, 0.0, -0.0, 1.5]), rng.choice([None, "", "a", "NULL"]))
    schema = "a int, b double, c string"
    a = spark.createDataFrame([row() for _ in range(left)], schema)
    b = spark.createDataFrame([row() for _ in range(right)], schema).toDF("x", "y", "z").where("x is null or x < 3")
    got = setops.except_digest(a, b)
    assert got.columns == ["a", "b", "c"]
    assert sorted(map(str, got.collect())) == sorted(map(str, a.subtract(b).collect()))


def test_except_digest_survives_equal_digests(spark, monkeypatch):
    """Digests only exclude: with all digests equal the rows decide."""
    monkeypatch.setattr(setops, "row_digest", lambda columns: [F.lit(7).cast("long").alias("_h1"), F.lit(7).cast("long").alias("_h2")])
    a, b = spark.range(20).toDF("x"), spark.range(10, 30).toDF("x")
    assert sorted(r.x for r in setops.except_digest(a, b).collect()) == list(range(10))


def test_bloom_has_no_false_negatives(spark):
    rows = spark.range(5000).select(*setops.row_digest(["id"]))
    table = setops.bloom(rows, 1000)
    assert setops.may_match(rows, table, 1000).count() == 5000
    others = spark.range(5000, 15_000).select(*setops.row_digest(["id"]))
    assert setops.may_match(others, table, 1000).count() < 2500


# ---------------------------------------------------------------- storage


def test_bucketed_log_needs_no_exchange_of_rows(spark, tmp_path):
    visits = _visits(spark, 300)
    table = logs.store_bucketed(visits, "corvid_test_bucketed", str(tmp_path / "t"), buckets=8)
    try:
        counts = logs.host_counts(table)
        assert "Exchange" not in counts._jdf.queryExecution().executedPlan().toString()
        hourly = table.groupBy("country", "host", "day", "hour").count()
        assert "Exchange" not in hourly._jdf.queryExecution().executedPlan().toString()
        # the top n of each country move, at most n rows a bucket
        plan = logs.top_hosts(table, 3)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange") == 1 and plan.index("WindowGroupLimit", plan.index("Exchange")) > 0
        assert sorted(map(tuple, logs.top_hosts(table, 3).collect())) == sorted(map(tuple, logs.top_hosts(visits, 3).collect()))
    finally:
        spark.sql("DROP TABLE corvid_test_bucketed")


SCHEMA = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("name", T.StringType()), T.StructField("x", T.DoubleType())])


def test_csv_rejects(spark, tmp_path):
    text = 'id,name,x\n1,a,1.5\n2,"b, ""c""",2\nthree,d,3\n4,e\n5,f,5,6\n,,\n7,g,1e400x\n 8 ,h, 9 \n9999999999,i,1\n'
    (tmp_path / "f.csv").write_text(text)
    good, rejects = readers.read_csv_checked(spark, str(tmp_path / "f.csv"), SCHEMA, header=True, escape='"')
    assert sorted(map(tuple, good.collect()), key=str) == sorted([(1, "a", 1.5), (2, 'b, "c"', 2.0), (None, None, None), (8, "h", 9.0)], key=str)
    got = {(r.line, r.reason) for r in rejects.collect()}
    assert got == {("three,d,3", "id"), ("4,e", "fields"), ("5,f,5,6", "fields"), ("7,g,1e400x", "x"), ("9999999999,i,1", "id")}
    assert all(r.file.endswith("f.csv") for r in rejects.collect())
    assert good.count() == 4 and rejects.count() == 5  # also where no column is asked for


def test_ordered_export_splits_a_hot_key(spark, tmp_path):
    rows = spark.range(9000).select(F.when(F.col("id") % 3 > 0, 5).otherwise(F.col("id") % 11).alias("k"), "id").repartition(6)
    path = sinks.write_ordered(rows, str(tmp_path / "o"), ["k", "id"], files=8)
    got = sinks.read_positions(spark, path).orderBy("position").collect()
    assert [r.position for r in got] == list(range(9000))
    assert [(r.k, r.id) for r in got] == sorted((r.k, r.id) for r in got)
    copies = spark.range(9000).select(F.lit(1).alias("k")).repartition(6)
    sinks.write_ordered(copies, str(tmp_path / "c"), ["k"], files=8)
    assert len([f for f in os.listdir(tmp_path / "c") if f.startswith("part-")]) >= 6


def test_published_reports_are_whole(spark, tmp_path):
    path = str(tmp_path / "r")
    one = {"a": spark.createDataFrame([(1,)], "x int"), "b": spark.createDataFrame([("p",)], "y string")}
    first = sinks.publish(one, path)
    assert [r.x for r in sinks.read_published(spark, path, "a").collect()] == [1]
    failing = spark.range(4).select(F.when(F.col("id") == 3, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).cast("int").alias("y"))
    with pytest.raises(PySparkException, match="lost"):
        sinks.publish({"a": spark.createDataFrame([(2,)], "x int"), "b": failing}, path)
    # the first report of the failed run was written, and is not seen
    assert [r.x for r in sinks.read_published(spark, path, "a").collect()] == [1]
    assert len(os.listdir(f"{path}/snapshots")) == 2
    second = sinks.publish({"a": spark.createDataFrame([(3,)], "x int")}, path)
    assert [r.x for r in sinks.read_published(spark, path, "a").collect()] == [3]
    assert set(os.listdir(f"{path}/snapshots")) == {first, second}
    with pytest.raises(ValueError, match="no published report"):
        sinks.read_published(spark, path, "b")
    with pytest.raises(ValueError):
        sinks.publish({}, path)


# -------------------------------------------------------------------- gzip


def _random_text(seed, n, end="\n"):
    rng = random.Random(seed)
    return end.join("".join(rng.choice("abcdefghij 0123456789") for _ in range(rng.randrange(200))) for _ in range(n))


@pytest.mark.parametrize("case", ["plain", "no end", "crlf", "members", "long lines", "empty", "one line", "feeds", "repeats"])
def test_gzip_ranges_return_every_line_once(spark, tmp_path, case):
    text = {
        "plain": _random_text(1, 20_000) + "\n", "no end": _random_text(2, 9000) + "\nlast", "crlf": _random_text(3, 5000, "\r\n") + "\r\n",
        "members": _random_text(4, 9000) + "\n", "long lines": "\n".join("x" * (1 << 19) + str(i) + _random_text(i, 500, " ") for i in range(6)) + "\n",
        "empty": "", "one line": "é", "feeds": "\n" * 5000, "repeats": "the same line\n" * 200_000,
    }[case]
    data = text.encode()
    cut = len(data) // 3
    packed = gzip.compress(data[:cut]) + gzip.compress(data[cut : 2 * cut], 1) + gzip.compress(data[2 * cut :]) if case == "members" else gzip.compress(data)
    (tmp_path / "log.gz").write_bytes(packed)
    index = gzip_index.build(spark, [str(tmp_path / "log.gz")], str(tmp_path / "index"), span=50_000)
    points = sorted((r.text_offset, r.text_end) for r in index.collect())
    assert all(a[1] == b[0] for a, b in zip(points, points[1:])) and (not points or points[-1][1] == len(data))
    if len(data) > 500_000 and case != "repeats":
        assert len(points) > 5
    got = collections.Counter(r.value for r in gzip_index.read_lines(index, 3).collect())
    assert got == collections.Counter(r.value for r in spark.read.text(str(tmp_path / "log.gz")).collect())


def test_gzip_index_of_several_and_damaged_files(spark, tmp_path):
    paths = []
    for k in range(3):
        (tmp_path / f"{k}.gz").write_bytes(gzip.compress(_random_text(k, 3000).encode()))
        paths.append(str(tmp_path / f"{k}.gz"))
    index = gzip_index.build(spark, paths, str(tmp_path / "i"), span=20_000)
    got = collections.Counter(r.value for r in gzip_index.read_lines(index).collect())
    assert got == collections.Counter(r.value for r in spark.read.text(paths).collect())
    (tmp_path / "bad.gz").write_bytes(b"\x1f\x8b\x08\x00\x00\x00\x00\x00\x00\x03" + b"\xff" * 50)
    with pytest.raises(PySparkException, match="damaged gzip data"):
        gzip_index.build(spark, [str(tmp_path / "bad.gz")], str(tmp_path / "j"))


def test_paths_are_qualified_and_unknown_stores_refused(spark, tmp_path):
    assert files.qualified(spark, str(tmp_path)) == f"file:{tmp_path}"
    assert files.arrow_filesystem(f"file:{tmp_path}")[1] == files.arrow_filesystem(f"file://{tmp_path}")[1] == str(tmp_path)
    with pytest.raises(ValueError, match="no reader of byte ranges"):
        files.arrow_filesystem("ftp://host/x")

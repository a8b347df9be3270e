from pyspark.sql import functions as F

from corvid.operators import logs

LINES = [
    'a.uni.de - - [01/Jul/1995:00:00:01 -0400] "GET /x HTTP/1.0" 200 100',
    'a.uni.de - - [01/Jul/1995:01:10:01 -0400] "GET /y HTTP/1.0" 304 -',
    'b.uni.de - - [02/Jul/1995:23:59:59 -0400] "GET /x HTTP/1.0" 200 5',
    'c.ca - - [03/Jul/1995:05:00:00 -0400] "GET /x HTTP/1.0" 200 7',
    'c.ca - - [03/Jul/1995:05:00:00 -0400] "GET /x HTTP/1.0" 200 7',
    'd.ca - - [03/Jul/1995:05:00:00 -0400] "GET /x HTTP/1.0" 200 7',
    'e.ca - - [03/Jul/1995:06:00:00 -0400] "GET /x HTTP/1.0" 200 7',
    # malformed: too few fields, no status, two-word request
    "x.sg - -",
    'y.sg - - [04/Jul/1995:10:00:00 -0400] "GET /x HTTP/1.0"',
    'z.sg - - [04/Jul/1995:11:00:00 -0400] "GET /x" 404 12',
    "localhost - - [04/Jul/1995:11:00:00 -0400] \"GET / HTTP/1.0\" 200 1",
]


def _parsed(spark):
    return logs.parse(spark.createDataFrame([(x,) for x in LINES], "value string"))


def test_parse_fields_and_malformed(spark):
    rows = {(r.host, r.ts_text): r for r in _parsed(spark).collect()}
    r = rows[("a.uni.de", "01/Jul/1995:01:10:01 -0400")]
    assert (r.day, r.hour, r.status, r.bytes, r.request, r.country) == (1, 1, 304, None, "GET /y HTTP/1.0", "de")
    bad = [r for r in rows.values() if r.host in ("x.sg", "y.sg")]
    assert all(not r.well_formed and r.status is None and r.country == "sg" for r in bad)
    z = [r for r in rows.values() if r.host == "z.sg"][0]
    assert z.well_formed and z.request == "GET /x" and z.status == 404
    local = [r for r in rows.values() if r.host == "localhost"][0]
    assert local.country is None


def test_positional_parse_never_raises(spark):
    df = logs.parse_positional(spark.createDataFrame([(x,) for x in LINES], "value string"))
    rows = df.collect()
    assert len(rows) == len(LINES)
    short = [r for r in rows if r.host == "x.sg"][0]
    assert short.method is None and short.status is None


def test_country_totals_and_uniques(spark):
    p = _parsed(spark)
    req = {r.country: r.requests for r in logs.country_requests(p).collect()}
    assert req == {"de": 3, "ca": 4, "sg": 3}
    uniq = {r.country: r.unique_hosts for r in logs.country_unique_hosts(p).collect()}
    assert uniq == {"de": 2, "ca": 3, "sg": 3}
    summ = {r.country: (r.requests, r.unique_hosts) for r in logs.country_summary(p).collect()}
    assert summ == {c: (req[c], uniq[c]) for c in req}


def test_top_hosts_ties_break_by_host(spark):
    top = logs.top_hosts(_parsed(spark), n=2).filter("country = 'ca'").orderBy("rank").collect()
    assert [(r.host, r.requests) for r in top] == [("c.ca", 2), ("d.ca", 1)]
    dedup = logs.top_hosts(_parsed(spark), n=1, dedup=True).filter("country = 'ca'").collect()
    assert [(r.host, r.requests) for r in dedup] == [("c.ca", 1)]


def test_host_share_sums_to_total(spark):
    share = logs.host_share(_parsed(spark), n=1).filter("country = 'ca'").orderBy("rank").collect()
    assert [(r.host, r.requests) for r in share] == [("c.ca", 2), ("Rest", 2)]
    assert sum(r.pct for r in share) == 100.0
    assert [r.is_largest for r in share] == [True, True]


def test_dense_heatmap_covers_day_range(spark):
    grid = logs.heatmap(_parsed(spark), by="country", dense=True).filter("country = 'de'")
    assert grid.count() == 2 * 24
    cells = {(r.day, r.hour): r.visits for r in grid.filter("visits > 0").collect()}
    assert cells == {(1, 0): 1, (1, 1): 1, (2, 23): 1}
    top = logs.heatmap(_parsed(spark), by="top_host", dense=True).filter("country = 'de'")
    assert {r.host for r in top.collect()} == {"a.uni.de"}
    assert top.count() == 24


def test_pivot_grid(spark):
    grid = logs.heatmap(_parsed(spark), by="country")
    wide = logs.pivot_grid(grid, ["country", "hour"], "day", range(1, 5))
    row = wide.filter("country = 'ca' AND hour = 5").first()
    assert (row.d1, row.d3) == (None, 3)


def test_streaming_country_totals(spark, tmp_path):
    from corvid.streaming.logs import country_requests_stream, log_line_stream

    src = tmp_path / "in"
    src.mkdir()
    (src / "part1.txt").write_text("\n".join(LINES) + "\n")
    q = (
        country_requests_stream(log_line_stream(spark, str(src)))
        .writeStream.outputMode("complete")
        .format("memory")
        .queryName("corvid_stream_test")
        .option("checkpointLocation", str(tmp_path / "ckpt"))
        .start()
    )
    q.processAllAvailable()
    got = {r.country: r.requests for r in spark.sql("SELECT * FROM corvid_stream_test").collect()}
    q.stop()
    assert got == {"de": 3, "ca": 4, "sg": 3}


def test_unique_hosts_approx_close_to_exact(spark):
    p = _parsed(spark)
    exact = {r.country: r.unique_hosts for r in logs.country_unique_hosts(p).collect()}
    approx = {r.country: r.unique_hosts for r in logs.country_unique_hosts(p, approx_rsd=0.01).collect()}
    assert exact == approx  # tiny cardinalities are exact in HLL++


def test_pivot_grid_columns_from_data(spark):
    grid = logs.heatmap(_parsed(spark), by="country")
    wide = logs.pivot_grid(grid, ["country", "hour"], "day")
    assert [c for c in wide.columns if c.startswith("d")] == ["d1", "d2", "d3", "d4"]


def test_written_log_has_few_files_and_keeps_all_rows(spark, tmp_path):
    # every line has a country label of its own
    lines = spark.range(400).selectExpr("concat('h.c', id, ' - - [02/Jan/2023:10:00:00 +0000] \"GET / HTTP/1.0\" 200 1') AS value")
    path = logs.write_parsed(logs.parse(lines.repartition(8)), str(tmp_path / "log"))
    assert len(list((tmp_path / "log").glob("*/*.parquet"))) <= 8
    back = spark.read.parquet(path)
    assert back.select("host").distinct().count() == 400
    assert {r.country for r in back.select("country").distinct().collect()} == {"other"}

"""What the fits over splits hold and leave behind: the findings of FINDINGS_r04.md."""

import threading

from corvid.operators import recommend
from corvid.plans import queries

ORDER = ["timestamp", "userId", "movieId"]


def _rating_rows(spark):
    rows = [(u, m, float((u * m) % 5), 100 * u + m) for u in range(12) for m in range(8)]
    return spark.createDataFrame(rows, "userId int, movieId int, rating double, timestamp long")


def _counts(table):
    return {(r.fraction, r.setting): r.n for r in table.collect()}


def test_blocks_follow_the_ratings():
    assert recommend.blocks_for(0) == recommend.blocks_for(recommend.FEW_RATINGS) == recommend.BLOCKS
    for n in (recommend.FEW_RATINGS + 1, 172_800_000, 999_999_999):
        blocks = recommend.blocks_for(n)
        assert n / blocks <= recommend.BLOCK_RATINGS and blocks < 1.1 * n / recommend.BLOCK_RATINGS + 10
        assert all(blocks % k for k in range(2, blocks))


def test_large_fits_have_small_blocks_and_run_one_by_one(spark, monkeypatch):
    """Before, every fit had 8 blocks, at any number of ratings, and three ran at a time."""
    made, running, most, lock = [], [0], [0], threading.Lock()
    real = recommend.als

    def als(*args, **kw):
        made.append(kw)
        est = real(*args, **kw)
        fit = est.fit

        def counted(df):
            with lock:
                running[0] += 1
                most[0] = max(most[0], running[0])
            try:
                return fit(df)
            finally:
                with lock:
                    running[0] -= 1

        est.fit = counted
        return est

    ratings, settings = _rating_rows(spark), {"free": {"rank": 2, "maxIter": 3}, "given": {"rank": 2, "maxIter": 3, "blocks": 2}}
    want, _ = recommend.evaluate_over_splits(ratings, ORDER, [0.5, 0.8], settings, seed=1)
    monkeypatch.setattr(recommend, "als", als)
    monkeypatch.setattr(recommend, "FEW_RATINGS", 10, raising=False)
    monkeypatch.setattr(recommend, "BLOCK_RATINGS", 5, raising=False)
    got, models = recommend.evaluate_over_splits(ratings, ORDER, [0.5, 0.8], settings, seed=1)
    assert [kw["blocks"] for kw in made] == [11, 2, 17, 2]  # of 48 and 76 ratings
    assert {kw["checkpointInterval"] for kw in made} == {1}
    assert most == [1]
    assert _counts(got) == _counts(want) and len(models) == 4


def test_models_over_splits_keep_no_caches_of_their_fits(spark):
    def cached():
        kept = spark.sparkContext._jsc.getPersistentRDDs()
        return {k for k in kept if str(kept[k]).startswith(("userFactors", "itemFactors"))}

    before, ratings = cached(), _rating_rows(spark)
    table, models = recommend.evaluate_over_splits(ratings, ORDER, [0.5, 0.8], {"own": {"rank": 2}}, seed=1)
    assert not cached() - before
    assert _counts(table)[0.8, "own"] == 4
    model = models[0.8, "own"]
    assert model.rank == 2 and model.userFactors.count() == 10 and model.itemFactors.count() == 8
    assert model.transform(ratings).count() == 80  # cold-start rows are dropped, as set


def test_als_quality_has_small_blocks(spark, monkeypatch):
    made, real = [], recommend.als
    monkeypatch.setattr(recommend, "als", lambda *args, **kw: made.append(kw) or real(*args, **kw))
    monkeypatch.setattr(recommend, "FEW_RATINGS", 10, raising=False)
    monkeypatch.setattr(recommend, "BLOCK_RATINGS", 7, raising=False)
    monkeypatch.setattr(queries, "_ratings", lambda s, d: _rating_rows(s))
    monkeypatch.setattr(queries, "ALS_SETTINGS", {"short": {"maxIter": 2}})
    rows = queries.q_als_quality(spark, None).orderBy("fraction").collect()
    assert [(r.fraction, r.setting, r.n) for r in rows] == [(0.4, "short", 2), (0.6, "short", 7), (0.8, "short", 4)]
    assert rows[2].mse_is_rmse_squared and rows[2].mae_within_rmse
    assert [kw["blocks"] for kw in made] == [11] * 3

"""Recommendation: ALS evaluation over time splits, user clusters from
latent factors, and the taste (top films, genres) of a cluster.

Membership tests are semi-joins on computed one-row / per-cluster frames,
never driver-side lists; the join strategy (broadcast or shuffle) is left
to AQE, which measures the runtime size of the smaller side.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from multiprocessing.pool import ThreadPool

from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame
from pyspark.util import inheritable_thread_target
from pyspark.sql import functions as F

from corvid.operators import metrics, sampling
from corvid.operators.topk import arg_max, top_n
from corvid.session import checkpoint_root, cut_lineage, free_shuffles, persisted

# ------------------------------------------------------------ cluster taste


def cluster_sizes(clusters: DataFrame, cluster_col: str = "prediction") -> DataFrame:
    """(cluster, size)."""
    return clusters.groupBy(cluster_col).agg(F.count(F.lit(1)).alias("size"))


def top_clusters(clusters: DataFrame, n: int = 5, cluster_col: str = "prediction") -> DataFrame:
    """(rank, cluster, size): n largest clusters, smaller id first on ties."""
    return top_n(cluster_sizes(clusters, cluster_col), n, ["size", cluster_col], [True, False]).select(
        "rank", cluster_col, "size"
    )


def largest_cluster(clusters: DataFrame, cluster_col: str = "prediction") -> DataFrame:
    """One row: (cluster, size) of the largest cluster."""
    sizes = cluster_sizes(clusters, cluster_col).withColumn("_all", F.lit(0))
    return arg_max(sizes, ["_all"], "size", cluster_col).select(cluster_col, "size")


def cluster_members(
    clusters: DataFrame, chosen: DataFrame, id_col: str = "id", cluster_col: str = "prediction", user_col: str = "userId"
) -> DataFrame:
    """Ids of the users in the chosen cluster(s) (semi-join, no driver value)."""
    return clusters.join(chosen.select(cluster_col), cluster_col, "left_semi").select(F.col(id_col).alias(user_col))


def cluster_ratings(
    ratings: DataFrame,
    clusters: DataFrame,
    chosen: DataFrame | None = None,
    id_col: str = "id",
    cluster_col: str = "prediction",
    user_col: str = "userId",
) -> DataFrame:
    """Ratings by members of the chosen cluster (default: the largest)."""
    chosen = chosen if chosen is not None else largest_cluster(clusters, cluster_col)
    members = cluster_members(clusters, chosen, id_col, cluster_col, user_col)
    # Users are unique in the cluster table, so a semi-join equals the
    # inner join of the reference and never multiplies rows.
    return ratings.join(members, user_col, "left_semi")


def high_rated_movies(
    ratings: DataFrame, threshold: float = 4.0, min_ratings: int = 1, item_col: str = "movieId", rating_col: str = "rating"
) -> DataFrame:
    """(movieId, avg_rating, n_ratings) with avg >= threshold (HAVING)."""
    agg = ratings.groupBy(item_col).agg(F.avg(rating_col).alias("avg_rating"), F.count(F.lit(1)).alias("n_ratings"))
    return agg.filter((F.col("avg_rating") >= threshold) & (F.col("n_ratings") >= min_ratings))


def top_movies(high: DataFrame, movies: DataFrame, n: int = 5, item_col: str = "movieId") -> DataFrame:
    """(rank, movieId, title, avg_rating): best mean first, smaller id on ties.

    The top-k is taken first, so the title lookup joins n rows (AQE
    broadcasts them) instead of one lookup query per film.
    """
    best = top_n(high, n, ["avg_rating", item_col], [True, False])
    # Semi-join first: the n-row side is the one that can be broadcast,
    # whatever the size of the film table; then join n rows to <= n titles.
    titles = movies.select(item_col, "title").join(best.select(item_col), item_col, "left_semi")
    return best.join(titles, item_col, "left").select("rank", item_col, "title", "avg_rating")


def movie_genres(high: DataFrame, movies: DataFrame, item_col: str = "movieId", sep: str = "[|]") -> DataFrame:
    """(movieId, genre): one row per genre of every listed film."""
    joined = movies.select(item_col, "genres").join(high.select(item_col), item_col, "left_semi")
    return joined.select(item_col, F.explode(F.split("genres", sep)).alias("genre"))


def top_genres(genres: DataFrame, n: int = 10) -> DataFrame:
    """(rank, genre, count): most frequent genres, alphabetical on ties."""
    counts = genres.groupBy("genre").agg(F.count(F.lit(1)).alias("count"))
    return top_n(counts, n, ["count", "genre"], [True, False]).select("rank", "genre", "count")


def cluster_taste(
    ratings: DataFrame,
    clusters: DataFrame,
    movies: DataFrame,
    n_movies: int = 5,
    n_genres: int = 10,
    threshold: float = 4.0,
) -> dict[str, DataFrame]:
    """Top films and genres of the largest cluster (one plan per report)."""
    rated = cluster_ratings(ratings, clusters)
    high = high_rated_movies(rated, threshold)
    return {
        "top_movies": top_movies(high, movies, n_movies),
        "top_genres": top_genres(movie_genres(high, movies), n_genres),
    }


# ---------------------------------------------------------------------- ALS

#: Blocks of the fits here: a fifth less is shuffled than with MLlib's 10.
BLOCKS = 8

#: Over splits, a fit to more ratings than this has blocks by their number instead.
FEW_RATINGS = 32_000_000

#: Ratings of a block of such a fit.
BLOCK_RATINGS = 1_000_000

#: A fit's factors are checkpointed after so many rounds, and the shuffle files before them deleted.
ROUNDS_KEPT = 3


def blocks_for(n_ratings: int) -> int:
    """User and item blocks of a fit to so many ratings: ``BLOCKS``, or for a large fit as many as ``BLOCK_RATINGS`` asks for.

    A task holds a whole block in memory: it builds the block from its
    ratings, and in each step takes in the factors of all that it rates.
    Those do not spill, so a block must not grow with the table.  ALS deals
    ids by their remainder, so the number is a prime: strided ids fill all
    blocks too.
    """
    if n_ratings <= FEW_RATINGS:
        return BLOCKS
    n = max(BLOCKS, -(-n_ratings // BLOCK_RATINGS))
    while any(n % k == 0 for k in range(2, int(n**0.5) + 1)):
        n += 1
    return n


def als(
    user_col: str = "userId",
    item_col: str = "movieId",
    rating_col: str = "rating",
    seed: int | None = None,
    cold_start: str = "drop",
    blocks: int | None = None,
    **params,
) -> ALS:
    """ALS estimator; ``params`` are ALS params (rank, regParam, maxIter...).

    ``blocks`` is the number of user and of item blocks, which is the number
    of tasks of each step: MLlib's own default is 10, at any size.  ALS
    deals the ratings to blocks itself, so no partitioning is needed before.
    Each step sends a user's or film's factors to every block that rates or
    is rated, so what it shuffles grows with ``blocks`` (see ``BLOCKS``).
    """
    est = ALS(userCol=user_col, itemCol=item_col, ratingCol=rating_col, coldStartStrategy=cold_start, **params)
    if seed is not None:
        est = est.setSeed(seed)
    return est.setNumBlocks(blocks) if blocks else est


def known_pairs(train: DataFrame, test: DataFrame, user_col: str = "userId", item_col: str = "movieId") -> DataFrame:
    """Test rows whose user and item both occur in training (what 'drop' scores)."""
    users = train.select(user_col).distinct()
    items = train.select(item_col).distinct()
    return test.join(users, user_col, "left_semi").join(items, item_col, "left_semi")


def evaluate_over_splits(
    ratings: DataFrame,
    order_cols: Sequence[str],
    fractions: Sequence[float],
    settings: Mapping[str, Mapping],
    seed: int | None = None,
    user_col: str = "userId",
    item_col: str = "movieId",
    rating_col: str = "rating",
    parallelism: int = 3,
) -> tuple[DataFrame, dict]:
    """Fit every ALS setting on every chronological head; score the tail.

    Returns the metric table (fraction, setting, n, rmse, mse, mae) and the
    fitted models keyed by (fraction, setting).  One table of ratings and
    split marks is persisted for all fits and released after them; the
    metric table, one row a fit, is checkpointed before.  ``blocks`` in a
    setting sets the tasks of its fit (see :func:`als`); without it they
    follow from the ratings of its training part (see :func:`blocks_for`).

    Up to ``parallelism`` fits run at a time.  Fits that have more blocks
    than ``BLOCKS`` run one by one and are checkpointed every round, others
    every ``ROUNDS_KEPT`` rounds.  The models outlive all fits, so each is
    moved to checkpoints of its factors when it is fitted, and what its fit
    has cached and shuffled is deleted, as is what its scores have shuffled.
    """
    checkpoint_root(ratings.sparkSession)  # without a folder MLlib leaves the checkpoints out
    marked = sampling.chrono_split(ratings, order_cols, fractions, prefix="_train_")
    flags = [sampling.flag_name(f, "_train_") for f in fractions]
    with persisted(marked.select(user_col, item_col, rating_col, *flags)) as cached:
        # fills the cache once, before concurrent fits read it
        sizes = cached.agg(*[F.count_if(flag).alias(flag) for flag in flags]).first()
        tasks = []
        for f, flag in zip(fractions, flags, strict=True):
            for name, params in settings.items():
                blocks = blocks_for(sizes[flag])
                rounds = ROUNDS_KEPT if blocks == BLOCKS else 1
                tasks.append((f, flag, name, {"blocks": blocks, "checkpointInterval": rounds, **params}))

        def fit(task):
            f, flag, name, params = task
            train = cached.filter(flag).select(user_col, item_col, rating_col)
            return _settled(als(user_col, item_col, rating_col, seed=seed, **params).fit(train))

        # Independent fits run as concurrent Spark jobs (as CrossValidator does
        # with ``parallelism``); each is seeded, so the order does not matter.
        # A large fit has tasks for all cores, and its files should go before the next.
        at_once = 1 if any(blocks_for(n) > BLOCKS for n in sizes) else min(parallelism, len(tasks))
        with ThreadPool(max(1, at_once)) as pool:
            fitted = pool.map(inheritable_thread_target(ratings.sparkSession)(fit), tasks)
        rows, models = [], {}
        for (f, flag, name, _), model in zip(tasks, fitted, strict=True):
            models[(f, name)] = model
            pred = model.transform(cached.filter(~F.col(flag)).select(user_col, item_col, rating_col))
            scores = metrics.regression_metrics(pred, rating_col, "prediction")
            m = cut_lineage(scores)
            free_shuffles(scores)
            rows.append(m.select(F.lit(float(f)).alias("fraction"), F.lit(name).alias("setting"), "*"))
        table = cut_lineage(metrics.metric_table(rows))
    return table, models


def _settled(model: ALSModel) -> ALSModel:
    """The model over checkpoints of its factors; what its fit has cached and shuffled is deleted."""
    users, items = cut_lineage(model.userFactors), cut_lineage(model.itemFactors)
    java = model._java_obj
    jvm = users.sparkSession.sparkContext._jvm
    settled = ALSModel(jvm.org.apache.spark.ml.recommendation.ALSModel(java.uid(), java.rank(), users._jdf, items._jdf))
    for factors in (java.userFactors(), java.itemFactors()):
        kept = factors.queryExecution().logical().collectLeaves().head().rdd()
        kept.unpersist(False)
        kept.cleanShuffleDependencies(False)
    return model._copyValues(settled)


def user_factor_vectors(model: ALSModel) -> DataFrame:
    """(id, features VECTOR) from the user factors, ready for k-means."""
    from pyspark.ml.functions import array_to_vector

    return model.userFactors.select("id", array_to_vector(F.col("features").cast("array<double>")).alias("features"))

from corvid.operators import recommend


def test_cluster_taste_ties_and_semijoin(spark):
    clusters = spark.createDataFrame([(1, 0), (2, 0), (3, 1), (4, 1), (5, 2)], "id int, prediction int")
    # clusters 0 and 1 tie at 2 members: the smaller id wins
    assert tuple(recommend.largest_cluster(clusters).first()) == (0, 2)
    ratings = spark.createDataFrame(
        [(1, 10, 5.0), (2, 10, 4.0), (1, 11, 4.0), (2, 12, 3.0), (3, 13, 5.0), (1, 14, 4.5)],
        "userId int, movieId int, rating double",
    )
    rated = recommend.cluster_ratings(ratings, clusters)
    assert rated.count() == 5
    high = recommend.high_rated_movies(rated)
    movies = spark.createDataFrame(
        [(10, "A", "x|y"), (11, "B", "y"), (12, "C", "z"), (13, "D", "x"), (14, "E", "y|z")], "movieId int, title string, genres string"
    )
    top = recommend.top_movies(high, movies, n=2).orderBy("rank").collect()
    assert [(r.movieId, r.title) for r in top] == [(10, "A"), (14, "E")]
    genres = recommend.top_genres(recommend.movie_genres(high, movies), n=3).orderBy("rank").collect()
    assert [(r.genre, r["count"]) for r in genres] == [("y", 3), ("x", 1), ("z", 1)]
    tc = recommend.top_clusters(clusters, n=5).orderBy("rank").collect()
    assert [(r.prediction, r.size) for r in tc] == [(0, 2), (1, 2), (2, 1)]

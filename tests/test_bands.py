"""Batch recommendation by rating bands against one search per request."""

import random

from emolens.operators import recommend as R

CATALOGUE = ("Description string, movie_name string, predicted_emotion string, genres_text string, mean_rating double, "
             "review_count long, recommendation_score double")


def catalogue(n=400):
    r = random.Random(3)
    for i in range(n):
        rating = round(r.uniform(1, 10), 1)
        yield (f"d{i}", f"title {r.randint(0, 60)}", r.choice(["Joy", "joy", "fear"]), " ".join(r.sample(["drama", "war", "sci_fi"], r.randint(1, 3))),
               rating, r.randint(1, 9), round(r.choice([0.5, rating / 10, r.random()]), 2))


def requests(n=60):
    r = random.Random(4)
    for i in range(n):
        yield (i, r.choice(["joy", "FEAR", "calm"]), r.choice([None, "", " Drama ", "sci fi", "opera"]),
               r.choice([None, 0.0, 5.0, round(r.uniform(0, 11), 2)]), r.choice([None, 1, 3, 50]))


def brute(rows, label, genre, least, n):
    g = (genre or "").strip().lower().replace(" ", "_")
    best = {}
    for d, title, e, gs, rating, reviews, score in rows:
        if e.lower() == label.lower() and rating >= (least or 0.0) and (not g or g in gs.split(" ")):
            key = (-score, -rating, d)
            if title not in best or key < best[title][0]:
                best[title] = (key, (title, e, gs, rating, reviews, score))
    got = sorted(best.values(), key=lambda x: (x[0][0], x[0][1], x[1][0]))
    return [x[1] for x in got[:10 if n is None else n]]


def test_bands_answer_like_a_search_per_request(spark):
    rows, asked = list(catalogue()), list(requests())
    cat = spark.createDataFrame(rows, CATALOGUE).repartition(4)
    req = spark.createDataFrame(asked, "request_id long, predicted_label string, preferred_genre string, minimum_rating double, n int")
    got = {}
    for r in R.recommend_batch(req, cat, fallback=True).orderBy("request_id", "position").collect():
        got.setdefault(r.request_id, []).append((r.fallback, tuple(r)[2:8]))
    for i, label, genre, least, n in asked:
        want = [(False, x) for x in brute(rows, label, genre, least, n)] or [(True, x) for x in brute(rows, label, None, least, n)]
        assert got.get(i, []) == want


def test_no_requests_and_no_catalogue(spark):
    cat = spark.createDataFrame(list(catalogue(5)), CATALOGUE)
    req = spark.createDataFrame([], "request_id long, predicted_label string, preferred_genre string, minimum_rating double, n int")
    assert R.recommend_batch(req, cat).count() == 0
    one = spark.createDataFrame([(1, "joy", None, 0.0, 3)], req.schema)
    assert R.recommend_batch(one, cat.where("false")).count() == 0

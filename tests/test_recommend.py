import json
import random
import threading
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwheel.config import Config
from cartwheel.functions.vectors import EPSILON, hyperplanes
from cartwheel.operators import recommend
from cartwheel.operators.factors import FactorModel
from cartwheel.operators.popularity import most_popular, popular_outside, ranked_popularity
from cartwheel.operators.recommend import Recommender, recommend_baskets, request_error, responses, similar_items
from cartwheel.sources import artifacts
from cartwheel.sources.artifacts import champion, follow_champion, load_model, load_recommender, promote, save_model
from cartwheel.streaming.requests import parse_requests, read_requests, serve

N, D = 80, 4
CONFIG = Config(n_factors=D, n_hash_tables=3, n_hash_functions=4)
PLANES = hyperplanes(D, 3, 4, 42)


@pytest.fixture(scope="module")
def arrays():
    rng = np.random.default_rng(5)
    return rng.normal(size=(N, D)), np.round(rng.normal(size=N), 1)  # rounded biases: ties


@pytest.fixture(scope="module")
def model(spark, arrays):
    v, b = arrays
    rows = [(i, [float(x) for x in v[i]], float(b[i])) for i in range(N)]
    items = spark.createDataFrame(rows, "item_id long, features array<double>, bias double")
    users = items.limit(0).withColumnRenamed("item_id", "user_id")
    return FactorModel(spark.createDataFrame([(1.0,)], "mu double"), users, items, D)


@pytest.fixture(scope="module")
def recommender(model):
    return Recommender.from_items(model.items, D, CONFIG)


def popular(arrays, exclude, k):
    return [i for i in sorted(range(N), key=lambda i: (-arrays[1][i], i)) if i not in exclude][:k]


def near(arrays, query, exclude, k):
    key = lambda x: ["".join("1" if p > 0 else "0" for p in x @ t) for t in PLANES]
    own, unit = key(query), lambda x: x / (np.linalg.norm(x) + EPSILON)
    found = [i for i in range(N) if i not in exclude and any(a == b for a, b in zip(own, key(arrays[0][i])))]
    score = {i: round(float(unit(arrays[0][i]) @ unit(query)), 8) + 0.0 for i in found}
    return sorted(found, key=lambda i: (-score[i], i))[:k]


def basket_answer(arrays, basket, k):
    known = [i for i in basket if 0 <= i < N]
    query = np.mean([arrays[0][i] for i in known], axis=0) if known else np.zeros(D)
    first = near(arrays, query, set(known), k)
    return first + popular(arrays, set(basket) | set(first), k - len(first)) if len(first) < k else first


def requests_of(spark, baskets, k=5):
    rows = [(n, b, k) for n, b in enumerate(baskets)]
    return spark.createDataFrame(rows, "basket_id long, basket array<long>, top_k int")


def listed(frame, key):
    out = {}
    for r in frame.orderBy(key, "rank").collect():
        out.setdefault(r[key], []).append(r.item_id)
        assert r["rank"] == len(out[r[key]])
    return out


BASKETS = [
    [1, 2, 3],
    [4],
    [1, 1, 1, 2],  # a repeat weighs more and is excluded once
    [900, 901],  # only unknown items: zero vector
    [900, 5],
    [],
    list(range(60)),  # most of the catalogue
    list(range(N)),  # all of it
]


@pytest.mark.parametrize("k", [1, 5, 30])
def test_baskets_match_brute_force(spark, recommender, arrays, k):
    rng = random.Random(k)
    baskets = BASKETS + [[rng.randrange(-5, N + 5) for _ in range(rng.randrange(1, 9))] for _ in range(30)]
    found = listed(recommend_baskets(requests_of(spark, baskets, k), recommender), "basket_id")
    expected = {n: basket_answer(arrays, b, k) for n, b in enumerate(baskets)}
    assert found == {n: items for n, items in expected.items() if items}


def test_popularity_fill_comes_after_similarity(spark, recommender):
    rows = recommend_baskets(requests_of(spark, BASKETS, 30), recommender).collect()
    for n in range(len(BASKETS)):
        sources = [r.source for r in sorted((r for r in rows if r.basket_id == n), key=lambda r: r["rank"])]
        assert sources == sorted(sources, reverse=True)


def test_responses_and_errors(spark, recommender, arrays):
    rows = [(1, [1, 2], 3), (2, None, 3), (3, [1], None), (4, [], 2), (5, [7], 0)]
    asked = spark.createDataFrame(rows, "basket_id long, basket array<long>, top_k int")
    got = {r.basket_id: r for r in responses(asked, recommender).collect()}
    body = json.loads(got[1].response)
    assert body["basket"] == [1, 2]
    assert [r["item_id"] for r in body["recommendations"]] == basket_answer(arrays, [1, 2], 3)
    assert got[2].response is None and got[2].error and got[3].error
    assert len(json.loads(got[4].response)["recommendations"]) == 2 and got[4].error is None
    assert json.loads(got[5].response)["recommendations"] == []


def test_requests_from_json(spark):
    bodies = ['{"basket": [1, 2], "top_k": 3}', '{"basket": [1]}', '{"basket": [1], "top_k": null}', '{"top_k": 2}', "no json", '{"basket": []}']
    texts = spark.createDataFrame(list(enumerate(bodies)), "basket_id long, value string")
    rows = parse_requests(texts, T.LongType()).withColumn("error", request_error()).orderBy("basket_id").collect()
    assert [(r.basket, r.top_k, r.error is None) for r in rows] == [
        ([1, 2], 3, True), ([1], 5, True), ([1], None, False), (None, 2, False), (None, 5, False), ([], 5, True)
    ]


def test_similar_items(spark, recommender, arrays):
    asked = spark.createDataFrame([(i, 4) for i in (0, 7, 33, 900, 0)], "query_id long, k int")
    found = listed(similar_items(asked, recommender), "query_id")
    expected = {i: near(arrays, arrays[0][i], {i}, 4) for i in (0, 7, 33)}
    expected[900] = popular(arrays, (), 4)
    assert found == {q: items for q, items in expected.items() if items}


def test_popular_outside_random_exclusions(spark, arrays, recommender):
    rng = random.Random(1)
    cases = {n: (rng.randrange(1, N + 5), set(rng.sample(range(-3, N), rng.randrange(0, N)))) for n in range(60)}
    cases[60] = (5, set(popular(arrays, (), 40)))  # the whole top of the list
    needs = spark.createDataFrame(
        [(n, 2, m, len(s)) for n, (m, s) in cases.items()], "q long, n_found long, missing int, n_excluded long"
    )
    rows = 2 * [(n, i) for n, (_, s) in cases.items() for i in s]
    out = popular_outside(needs, spark.createDataFrame(rows, "q long, item_id long"), recommender.popularity, "q")
    found = {}
    for r in out.orderBy("q", "rank").collect():
        found.setdefault(r.q, []).append(r.item_id)
        assert r["rank"] == 2 + len(found[r.q])
    assert found == {n: popular(arrays, s, m) for n, (m, s) in cases.items() if popular(arrays, s, m)}


def test_popularity_fixtures(spark):
    scores = spark.createDataFrame([("e", 0.1), ("c", 0.5), ("a", 0.9), ("d", 0.3), ("b", 0.7)], "item_id string, score double")
    assert [r.item_id for r in most_popular(scores, 3).collect()] == ["a", "b", "c"]
    without = spark.createDataFrame([("a",)], "item_id string")
    assert [r.item_id for r in most_popular(scores, 2, without).collect()] == ["b", "c"]
    assert [r.item_id for r in ranked_popularity(scores).orderBy("pop_rank").collect()] == list("abcde")
    assert most_popular(scores, 0).count() == 0


def test_saved_model_serves_a_stream_like_a_batch(spark, model, arrays, tmp_path):
    path = str(tmp_path / "model")
    save_model(model, path)
    assert load_model(spark, path).items.exceptAll(model.items).isEmpty()
    served = load_recommender(spark, path, CONFIG)
    asked = requests_of(spark, BASKETS).unionByName(
        spark.createDataFrame([(99, None, 5)], "basket_id long, basket array<long>, top_k int")
    )
    for part in range(3):
        asked.where(F.col("basket_id") % 3 == part).coalesce(1).write.mode("append").parquet(str(tmp_path / "asked"))
    stream = read_requests(spark, str(tmp_path / "asked"), model.items.schema["item_id"].dataType, files_per_batch=1)
    serve(stream, served, str(tmp_path / "out"), str(tmp_path / "progress")).awaitTermination()
    answers = spark.read.parquet(str(tmp_path / "out/recommendations"))
    assert answers.select("batch").distinct().count() >= 2
    batch = recommend_baskets(asked, load_recommender(spark, path, CONFIG)).drop("request")
    given = answers.select(batch.columns)
    assert batch.exceptAll(given).isEmpty() and given.exceptAll(batch).isEmpty()
    errors = spark.read.parquet(str(tmp_path / "out/errors")).collect()
    assert [(r.basket_id, r.error) for r in errors] == [(99, "basket is missing")]
    serve(stream, served, str(tmp_path / "out"), str(tmp_path / "progress")).awaitTermination()  # nothing new
    assert spark.read.parquet(str(tmp_path / "out/recommendations")).count() == answers.count()


def test_a_stream_follows_the_champion(spark, model, arrays, tmp_path):
    """A model that is promoted between two batches answers the second one only."""
    latest, asked, out = (str(tmp_path / x) for x in ("latest", "asked", "out"))
    other = replace(model, items=model.items.withColumn("features", F.reverse("features")))
    current = follow_champion(spark, latest, CONFIG)
    with pytest.raises(FileNotFoundError):
        current()
    batches = {}
    for part, (used, error) in enumerate(((other, 2.0), (model, 1.0))):
        promote(spark, used, error, latest, only_better=True)
        rows = requests_of(spark, BASKETS).where(F.col("basket_id") % 2 == part).coalesce(1)
        rows.write.mode("append").parquet(asked)
        stream = read_requests(spark, asked, model.items.schema["item_id"].dataType)
        serve(stream, current, out, str(tmp_path / "progress")).awaitTermination()
        batches[part] = recommend_baskets(rows, Recommender.from_items(used.items, D, CONFIG)).drop("request")
    answers = spark.read.parquet(f"{out}/recommendations")
    for part, wanted in batches.items():
        given = answers.where(F.col("batch") == part).select(wanted.columns)
        assert wanted.exceptAll(given).isEmpty() and given.exceptAll(wanted).isEmpty() and not given.isEmpty()
    assert current() is current()


def test_of_two_promotions_at_once_the_better_stays(spark, model, tmp_path, monkeypatch):
    latest, both, read = str(tmp_path / "latest"), threading.Barrier(2), artifacts.served
    promote(spark, model, 3.0, latest)
    first = threading.local()

    def served_together(*args):
        row = read(*args)
        if not getattr(first, "done", False):
            first.done = True
            both.wait(60)  # both have seen the model before
        return row

    monkeypatch.setattr(artifacts, "served", served_together)
    with ThreadPoolExecutor(2) as pool:
        list(pool.map(lambda error: promote(spark, model, error, latest, only_better=True), (2.0, 1.0)))
    monkeypatch.undo()
    assert champion(spark, latest)[1] == 1.0
    numbers = sorted(x.name for x in (tmp_path / "latest/served").glob("*.json"))
    assert numbers == [f"{i:012d}.json" for i in range(len(numbers))] and 2 <= len(numbers) <= 3
    assert promote(spark, model, 1.0, latest, only_better=True) is None  # equal is not better
    assert not artifacts.create_new(spark, f"{latest}/served/{numbers[0]}", "{}")
    assert not list((tmp_path / "latest/served").glob("_*"))


def test_requests_that_share_an_id_are_answered_one_by_one(spark, recommender, arrays, model, tmp_path):
    rows = [(1, [1, 2], 2), (1, [3], 4), (1, [1, 2], 2), (2, [5], 1)]
    asked = spark.createDataFrame(rows, "basket_id long, basket array<long>, top_k int").coalesce(1)
    found = {}
    for r in recommend_baskets(asked, recommender).orderBy("request", "rank").collect():
        found.setdefault(r.request, []).append(r.item_id)
    want = sorted(basket_answer(arrays, basket, k) for _, basket, k in rows)
    assert sorted(found.values()) == want
    bodies = [json.loads(r.response) for r in responses(asked, recommender).collect()]
    assert sorted([x["item_id"] for x in b["recommendations"]] for b in bodies) == want
    asked.write.parquet(str(tmp_path / "asked"))
    stream = read_requests(spark, str(tmp_path / "asked"), model.items.schema["item_id"].dataType)
    serve(stream, recommender, str(tmp_path / "out"), str(tmp_path / "progress")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out/recommendations")).count() == sum(map(len, want))


def test_one_item_with_two_k(spark, recommender, arrays):
    asked = spark.createDataFrame([(7, 2), (7, 4), (900, 1), (900, 3)], "query_id long, k int")
    found = similar_items(asked, recommender).groupBy("query_id").count().collect()
    near_count = sum(len(near(arrays, arrays[0][7], {7}, k)) for k in (2, 4))
    assert {r.query_id: r["count"] for r in found} == {7: near_count, 900: 4}


def test_missing_model(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        load_model(spark, str(tmp_path / "none"))


def test_passes_answer_every_basket_and_keep_their_answers_only(spark, recommender, arrays, monkeypatch, tmp_path):
    """Baskets in passes that meet the packs of the index: the same answers, and the tables of one pass beside them."""
    rng = random.Random(3)
    baskets = BASKETS + [[rng.randrange(-5, N + 5) for _ in range(rng.randrange(1, 9))] for _ in range(30)]
    asked, work = requests_of(spark, baskets), str(tmp_path / "work")
    whole = sorted(map(tuple, recommend_baskets(asked, recommender).drop("request").collect()))
    monkeypatch.setattr(recommend, "PASS_LINES", 60)
    found = sorted(map(tuple, recommend_baskets(asked, recommender, work).drop("request").collect()))
    assert found == whole and len({r[0] for r in found}) == len(baskets) - 1  # one names every item
    lines = recommend.basket_lines(asked).count()
    answers = {p.name for p in (tmp_path / "work").glob("answers-*")}
    assert len(answers) == -(-lines // 60) > 3
    assert spark.read.parquet(f"{work}/queries").count() < len(baskets) / 2

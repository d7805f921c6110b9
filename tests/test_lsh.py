import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cartwheel.functions.vectors import EPSILON, cosine, hyperplanes
from cartwheel.operators import lsh
from cartwheel.operators.lsh import _bucket_candidates, bucket_sizes, build_index, keyed_queries, neighbors, per_table
from cartwheel.session import stored, tune
from cartwheel.sources.artifacts import load_or_build

N, D = 300, 16


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(11)
    v = rng.normal(size=(N, D))
    v[100:200] = v[100] + 0.001 * rng.normal(size=(100, D))  # a third of all items in few buckets
    v[250] = 0.0
    return v


@pytest.fixture(scope="module")
def items(spark, vectors):
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)]
    return spark.createDataFrame(rows, "item_id long, features array<double>")


def keys(vectors, planes):
    return [["".join("1" if x > 0 else "0" for x in v @ t) for t in planes] for v in vectors]


def expected(vectors, planes, query, k, exclude=()):
    all_keys, own = keys(vectors, planes), keys([query], planes)[0]
    candidates = [i for i in range(len(vectors)) if any(a == b for a, b in zip(all_keys[i], own)) and i not in exclude]
    unit = lambda x: x / (np.linalg.norm(x) + EPSILON)
    scored = [(round(float(unit(vectors[i]) @ unit(query)), 8) + 0.0, i) for i in candidates]
    return [i for _, i in sorted(scored, key=lambda s: (-s[0], s[1]))][:k]


def listed(frame, key="query_id"):
    out = {}
    for r in frame.orderBy(key, "rank").collect():
        out.setdefault(r[key], []).append(r.item_id)
    return out


def test_planes_are_drawn_table_by_table():
    planes = hyperplanes(64, 5, 10, 42)
    assert planes.shape == (5, 64, 10)
    assert planes[0, 0, :3] == pytest.approx([0.49671415, -0.1382643, 0.64768854], abs=1e-8)


@pytest.mark.parametrize("tables, functions", [(3, 5), (5, 10)])
def test_index_has_every_item_in_every_table(items, vectors, tables, functions):
    rows = build_index(items, D, tables, functions).collect()
    assert len(rows) == N * tables
    expected_keys = keys(vectors, hyperplanes(D, tables, functions, 42))
    assert all(r.hash_key == expected_keys[r.item_id][r.table_idx] for r in rows)


@pytest.mark.parametrize("block_rows", [9, 50_000])
def test_neighbors_match_brute_force(items, vectors, block_rows):
    planes = hyperplanes(D, 5, 10, 42)
    index = build_index(items, D)
    queries = items.select(F.col("item_id").alias("query_id"), "features", F.lit(7).alias("k"))
    found = listed(neighbors(index, queries, planes, block_rows=block_rows))
    assert found == {i: expected(vectors, planes, vectors[i], 7) for i in range(N)}


@pytest.mark.parametrize("block_rows", [9, 50_000])
def test_excluded_items_never_return_and_are_replaced(spark, items, vectors, block_rows):
    planes = hyperplanes(D, 5, 10, 42)
    index = build_index(items, D)
    exclude = {i: set(range(100, 160)) | {i} for i in range(90, 130)}
    queries = items.where("item_id >= 90 and item_id < 130").select(
        F.col("item_id").alias("query_id"), "features", F.lit(5).alias("k")
    )
    rows = spark.createDataFrame([(q, i) for q, s in exclude.items() for i in s], "query_id long, item_id long")
    found = listed(neighbors(index, queries, planes, rows, block_rows=block_rows))
    want = {q: expected(vectors, planes, vectors[q], 5, s) for q, s in exclude.items()}
    assert found == {q: items for q, items in want.items() if items}


def test_a_meeting_returns_at_most_k_rows(items):
    """However much is excluded: masked items make no rows."""
    planes = hyperplanes(D, 2, 3, 42)
    index = build_index(items, D, 2, 3)
    everything = F.array(*[F.lit(i).cast("long") for i in range(0, N, 2)])
    queries = items.select(F.col("item_id").alias("query_id"), "features", F.lit(2).alias("k"), everything.alias("excluded"))
    keyed = keyed_queries(queries, planes)
    probes = per_table(keyed.select("query_id", "features", "k", "excluded", "keys"))
    made = _bucket_candidates(index, probes, "query_id", 50_000, bucket_sizes(index))
    assert made.where("item_id % 2 = 0").isEmpty()
    per_query = made.groupBy("query_id").count().agg(F.max("count")).first()[0]
    assert 0 < per_query <= 2 * 2
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "Union" not in plan


def test_zero_vector_meets_only_the_all_zero_bucket(spark, items, vectors):
    planes = hyperplanes(D, 2, 3, 42)
    index = build_index(items, D, 2, 3)
    query = spark.createDataFrame([(0, [0.0] * D, 4)], "query_id long, features array<double>, k int")
    found = neighbors(index, query, planes).collect()
    assert [r.item_id for r in sorted(found, key=lambda r: r.rank)] == expected(vectors, planes, np.zeros(D), 4)
    assert {r.score for r in found} == {0.0}


def test_cosine_column_agrees(items, vectors):
    one = F.array(*[F.lit(float(x)) for x in vectors[3]])
    got = {r.item_id: r.c for r in items.select("item_id", cosine(F.col("features"), one, D).alias("c")).collect()}
    unit = lambda x: x / (np.linalg.norm(x) + EPSILON)
    assert [got[i] for i in range(N)] == pytest.approx([float(unit(v) @ unit(vectors[3])) for v in vectors])


def test_index_is_built_once(spark, items, tmp_path):
    path, calls = str(tmp_path / "buckets"), []

    def build():
        calls.append(1)
        return build_index(items, D, 3, 5)

    first = load_or_build(spark, path, build, "table_idx")
    again = load_or_build(spark, path, build, "table_idx")
    assert len(calls) == 1 and first.count() == again.count() == 3 * N
    columns = ["table_idx", "hash_key", "item_id"]
    assert build().select(*columns).exceptAll(again.select(*columns)).isEmpty()
    (tmp_path / "buckets" / "_SUCCESS").unlink()  # as an interrupted job leaves it
    assert load_or_build(spark, path, build, "table_idx").count() == 3 * N and len(calls) == 3


def test_a_hot_bucket_meets_in_small_calls(spark, monkeypatch):
    """Thirty thousand equal items and as many queries share a bucket: no call gets most of them."""

    def sized(key):
        def rows(left, right):
            n = float(len(left) + len(right))
            return pa.table([pa.array([0], pa.int64()), pa.array([0], pa.int64()), pa.array([n]), pa.array([1], pa.int32())], names=[key, "item_id", "score", "k"])

        return rows

    monkeypatch.setattr(lsh, "_piece_scorer", sized)
    vector = F.array(*[F.lit(1.0)] * 4).alias("features")
    items = spark.range(30_000).select(F.col("id").alias("item_id"), vector)
    queries = spark.range(30_000).select(F.col("id").alias("query_id"), vector, F.lit(1).alias("k"))
    index = build_index(items, 4, 1, 3)
    probes = per_table(lsh.keyed_queries(queries, hyperplanes(4, 1, 3, 42)).withColumn("excluded", F.lit(None).cast("array<long>")))
    found = _bucket_candidates(index, probes, "query_id", lsh.BLOCK_ROWS, None)
    assert 10_000 < found.agg(F.max("score")).first()[0] < 50_000


def test_tasks_of_the_buckets_follow_the_input(spark):
    """Their number is not the session's, whatever the size of the input, and the neighbours stay the same."""
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=4).tolist(), 3) for i in range(80)]
    vectors = spark.createDataFrame(rows, "item_id long, features array<double>, k int")
    planes = lsh.hyperplanes(4, 2, 3, 42)
    index = stored(lsh.build_index(vectors, 4, 2, 3, 42), "buckets")
    probes = lsh.per_table(lsh.with_keys(vectors.select(F.col("item_id").alias("query_id"), "features", "k", F.lit(None).cast("array<long>").alias("excluded")), planes))
    found = []
    try:
        for size, parts in ((0, 64), (1 << 30, 256)):
            tune(spark, size)
            pairs = lsh._bucket_candidates(index, probes, "query_id", 20, None)
            assert pairs.rdd.getNumPartitions() == parts
            found.append(sorted(map(tuple, lsh.best_candidates(pairs).collect())))
    finally:
        tune(spark)
    assert found[0] == found[1] and len(found[0]) > 80


@pytest.mark.parametrize("rows", [9, 1_000])
def test_packs_of_the_index_give_the_same_neighbours(spark, items, vectors, monkeypatch, rows):
    """Many queries meet the packs of the index in one task for each block, which sends k rows a query on, not k a bucket."""
    planes = hyperplanes(D, 5, 4, 42)
    index = stored(build_index(items, D, 5, 4), "buckets")
    without = F.array_compact(F.array("item_id", *[F.when(F.col("item_id") % 3 == 0, F.col("item_id") + i) for i in range(1, 9)]))
    k = F.when(F.col("item_id") % 7 != 0, (F.col("item_id") % 5 + 1).cast("int")).otherwise(F.lit(0))
    queries = items.select(F.col("item_id").alias("query_id"), "features", k.alias("k"), without.alias("excluded"))
    asked = lambda: sorted(map(tuple, neighbors(index, queries, planes).collect()))
    few, sent = asked(), []
    for name in ("QUERY_ROWS", "MIN_QUERIES", "PACK_ROWS"):
        monkeypatch.setattr(lsh, name, rows)
    monkeypatch.setattr(lsh, "FEW_QUERIES", 0)
    ranked = lsh.best_candidates
    monkeypatch.setattr(lsh, "best_candidates", lambda found, *a: ranked(sent.append(found) or found, *a))
    assert asked() == few and len(few) > N
    tasks = max(1, -(-16 // -(-N // rows)))  # of a block
    assert len(few) <= sent[0].count() <= tasks * len(few)
    again = queries.unionByName(queries)  # keys may repeat
    assert sorted(map(tuple, neighbors(index, again, planes).collect())) == few

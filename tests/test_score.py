import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cartwheel.functions.vectors import top_bounded_products, top_products
from cartwheel.operators import score
from cartwheel.operators.evaluate import evaluate, heldout_rmse
from cartwheel.operators.factors import FactorModel, predict_in_blocks, predict_pairs, without_biases
from cartwheel.operators.meetings import Best
from cartwheel.operators.score import top_items

D, USERS, ITEMS, MU = 4, 40, 60, 2.5


@pytest.fixture(scope="module")
def arrays():
    rng = np.random.default_rng(7)
    q = rng.normal(size=(ITEMS, D))
    q[10:20] = q[0]  # copies: exact ties
    bi = rng.normal(size=ITEMS)
    bi[10:20] = bi[0]
    return rng.normal(size=(USERS, D)), rng.normal(size=USERS), q, bi


@pytest.fixture(scope="module")
def model(spark, arrays):
    p, bu, q, bi = arrays
    frame = lambda key, w, b: spark.createDataFrame(
        [(f"{key[0]}{i:03d}", [float(x) for x in w[i]], float(b[i])) for i in range(len(b))],
        f"{key} string, features array<double>, bias double",
    )
    mean = spark.createDataFrame([(MU,)], "mu double")
    return FactorModel(mean, frame("user_id", p, bu), frame("item_id", q, bi), D)


def scores(arrays):
    p, bu, q, bi = arrays
    return np.round(MU + bu[:, None] + bi[None, :] + p @ q.T, 8)


def best(row, k, seen=()):
    return [i for i in sorted(range(ITEMS), key=lambda i: (-row[i], i)) if i not in seen][:k]


def listed(frame):
    out = {}
    for r in frame.orderBy("user_id", "rank").collect():
        out.setdefault(r.user_id, []).append(r.item_id)
    return out


@pytest.mark.parametrize("block_rows", [7, 50_000])
def test_top_items_match_brute_force(spark, model, arrays, block_rows):
    found = listed(top_items(model, model.users, 12, block_rows=block_rows))
    expected = scores(arrays)
    assert found == {f"u{u:03d}": [f"i{i:03d}" for i in best(expected[u], 12)] for u in range(USERS)}


@pytest.mark.parametrize(("block_rows", "block_seen"), [(7, 1_000_000), (50_000, 1_000_000), (50_000, 30)])
def test_seen_items_are_masked(spark, model, arrays, monkeypatch, block_rows, block_seen):
    monkeypatch.setattr(score, "BLOCK_SEEN", block_seen)
    rng = np.random.default_rng(3)
    seen = {u: set(rng.choice(ITEMS, 20, replace=False).tolist()) for u in range(0, USERS, 2)}
    rows = [(f"u{u:03d}", f"i{i:03d}") for u, items in seen.items() for i in items] + [("stranger", "i001"), ("u000", "none")]
    frame = spark.createDataFrame(rows, "user_id string, item_id string")
    found = listed(top_items(model, model.users, 50, seen=frame, block_rows=block_rows))
    expected = scores(arrays)
    assert found == {
        f"u{u:03d}": [f"i{i:03d}" for i in best(expected[u], 50, seen.get(u, ()))] for u in range(USERS)
    }


def test_unknown_user_gets_nothing(spark, model):
    asked = spark.createDataFrame([("u001",), ("stranger",), ("u001",)], "user_id string")
    assert list(listed(top_items(model, asked, 3))) == ["u001"]


def test_cold_pairs_score_what_is_known(spark, model, arrays):
    p, bu, q, bi = arrays
    pairs = spark.createDataFrame(
        [("u001", "i002", 1.0), ("u001", "new", 1.0), ("new", "i002", 1.0), ("new", "new", 1.0)],
        "user_id string, item_id string, rating double",
    )
    got = {(r.user_id, r.item_id): r.prediction for r in predict_pairs(pairs, model).collect()}
    assert got["u001", "i002"] == pytest.approx(MU + bu[1] + bi[2] + p[1] @ q[2])
    assert got["u001", "new"] == pytest.approx(MU + bu[1])
    assert got["new", "i002"] == pytest.approx(MU + bi[2])
    assert got["new", "new"] == pytest.approx(MU)
    assert heldout_rmse(model, pairs).first().n_pairs == 1
    assert heldout_rmse(model, pairs.where("user_id = 'new'")).first().rmse == 0.0


def test_evaluate_and_sample(spark, model, arrays):
    rows = [(f"u{u:03d}", f"i{i:03d}", float(1 + (u + i) % 5)) for u in range(USERS) for i in range(u % 7 + 1)]
    ratings = spark.createDataFrame(rows + [("new", "i001", 2.0)], "user_id string, item_id string, rating double")
    row = evaluate(model, ratings, 10).first()
    assert row.num_users_evaluated == USERS and row.k == 10 and 0 <= row.ndcg_at_10 <= 1
    assert 1 <= evaluate(model, ratings, 10, users=5).first().num_users_evaluated <= 5
    unseen = evaluate(model, ratings, 10, seen=ratings.select("user_id", "item_id")).first()
    assert unseen.precision_at_10 == 0.0


def test_without_biases(spark, model):
    assert without_biases(model).users.agg(F.sum(F.abs("bias"))).first()[0] == 0.0


def test_kernel_limits_and_mask():
    items = np.array([[1.0], [3.0], [2.0], [3.0]])
    queries = np.array([[1.0], [-1.0], [0.0]])
    row, col, score = top_products(queries, items, np.array([2, 1, 9]))
    got = {}
    for r, c in zip(row, col):
        got.setdefault(int(r), []).append(int(c))
    assert got == {0: [1, 3], 1: [0], 2: [0, 1, 2, 3]}
    row, col, _ = top_products(queries, items, np.array([2, 0, 1]), (np.array([0, 2]), np.array([1, 0])))
    assert sorted(zip(row.tolist(), col.tolist())) == [(0, 2), (0, 3), (2, 1)]
    assert len(top_products(np.empty((0, 1)), items, np.empty(0, np.int64))[0]) == 0


@pytest.mark.parametrize("strip", [1, 7, 64, 5_000])
@pytest.mark.parametrize("k", [1, 9, 200])
def test_bounded_products_equal_all_products(strip, k):
    rng = np.random.default_rng(strip + k)
    p, q = rng.normal(size=(50, 3)), rng.normal(size=(300, 3)) * rng.exponential(size=(300, 1))
    q[20:60] = q[0]  # ties
    bias = np.where(np.arange(300) < 60, 0.5, rng.normal(size=300))
    queries = np.hstack([p, np.ones((50, 1)), rng.normal(size=(50, 1))])
    items = np.hstack([q, bias[:, None], np.ones((300, 1))])
    cells = rng.choice(50 * 300, 2_000, replace=False)
    for masked in (None, (cells // 300, cells % 300), (np.repeat(3, 300), np.arange(300))):
        row, col, score, skipped = top_bounded_products(queries, items, k, masked, strip)
        wanted = top_products(queries, items, np.full(50, k), masked)
        order = np.lexsort((col, -score, row)), np.lexsort((wanted[1], -wanted[2], wanted[0]))
        for mine, theirs in zip((row, col, score), wanted):
            assert mine[order[0]].tolist() == theirs[order[1]].tolist()
        assert 0 <= skipped < 50 * 300
        if k == 1 and strip < 64:
            assert skipped > 50 * 300 / 4


def test_skipped_pairs_are_counted(spark):
    rng = np.random.default_rng(1)
    frame = lambda key, n, scale: spark.createDataFrame(
        [(i, [float(x) for x in rng.normal(size=D) * scale(i)], 0.0) for i in range(n)], f"{key} long, features array<double>, bias double"
    )
    lengths = FactorModel(
        spark.createDataFrame([(0.0,)], "mu double"), frame("user_id", 30, lambda i: 1), frame("item_id", 9_000, lambda i: 1 / (1 + i)), D
    )
    counter = spark.sparkContext.accumulator(0)
    assert top_items(lengths, lengths.users, 3, skipped=counter).count() == 90
    assert counter.value > 30 * 9_000 / 2


@pytest.mark.parametrize("block_rows", [6, 250_000])
@pytest.mark.parametrize("how", ["left", "inner"])
def test_pairs_in_blocks_equal_joined_pairs(spark, model, block_rows, how):
    rows = [(f"u{u:03d}", f"i{i:03d}", float(u), "x") for u in range(0, USERS + 3, 2) for i in range(0, ITEMS + 4, 3)]
    rows += [(None, "i001", 1.0, None), ("u001", None, 2.0, "y"), ("u001", "i001", 3.0, "z"), ("u001", "i001", 3.0, "z")]
    pairs = spark.createDataFrame(rows, "user_id string, item_id string, rating double, kind string")
    wanted = predict_pairs(pairs, model, how)
    found = predict_in_blocks(pairs, model, how, block_rows)
    listed = lambda f: sorted((str(r.user_id), str(r.item_id), r.rating, str(r.kind), round(r.prediction, 9)) for r in f.select(*pairs.columns, "prediction").collect())
    assert listed(found) == listed(wanted)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(_cell") == 2  # the pairs once, the parameters once


def test_no_pairs_in_blocks(spark, model):
    empty = spark.createDataFrame([], "user_id string, item_id string, rating double")
    assert predict_in_blocks(empty, model).count() == 0


@pytest.mark.parametrize("scale", [1e-3, 1.0, 1e4, 1e12, 1e160])
def test_products_that_single_precision_cannot_tell_apart(scale):
    """Scores a few millionths apart come in their exact order, whatever the size of the numbers."""
    rng = np.random.default_rng(5)
    base = rng.normal(size=6)
    items = (base + rng.normal(size=(700, 6)) * 1e-7) * scale
    queries = rng.normal(size=(40, 6)) + base
    wanted = np.round(np.einsum("qd,id->qi", queries, items), 8)
    row, col, score = top_products(queries, items, np.full(40, 7))
    for q in range(40):
        assert col[row == q].tolist() == sorted(range(700), key=lambda i: (-wanted[q, i], i))[:7]
        assert score[row == q] == pytest.approx(np.sort(wanted[q])[::-1][:7], rel=1e-12)


def test_a_tile_of_products_stays_small():
    """A hundred million pairs take little memory and no more than a few seconds of one core."""
    rng = np.random.default_rng(6)
    queries = np.hstack([rng.normal(size=(2_000, 16)), np.ones((2_000, 1)), np.zeros((2_000, 1))])
    items = np.hstack([rng.normal(size=(50_000, 16)), np.zeros((50_000, 1)), np.ones((50_000, 1))])
    tracemalloc.start()
    found = top_bounded_products(queries, items, 10)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(found[0]) == 20_000 and peak < 40 << 20


def test_a_user_returns_k_rows_however_many_blocks_there_are(spark, model, arrays, monkeypatch):
    """What is sent on to be ranked follows the users: every block lies once, and keeps the best of all packs."""
    sent, tables = [], {}
    ranked, stored = score.ranked, score.stored
    monkeypatch.setattr(score, "ranked", lambda frame, *a: ranked(sent.append(frame) or frame, *a))
    monkeypatch.setattr(score, "stored", lambda frame, name: tables.setdefault(name, stored(frame, name)))
    found = listed(top_items(model, model.users, 12, block_rows=7))
    tasks = -(-16 // -(-USERS // 7))  # of a block, so that there are twice as many as shuffle partitions
    assert USERS * 12 <= sent[0].count() <= USERS * 12 * tasks
    assert tables["user-blocks"].agg(F.sum(F.size("users"))).first()[0] == USERS
    assert tables["item-packs"].agg(F.sum(F.size("items"))).first()[0] == ITEMS and tables["item-packs"].count() > 3
    expected = scores(arrays)
    assert found == {f"u{u:03d}": [f"i{i:03d}" for i in best(expected[u], 12)] for u in range(USERS)}


@pytest.mark.parametrize("ids", [["a", "b", "c", "d"], [4, 7, 8, 9]])
def test_best_of_parts(ids):
    """Cuts in between lose nothing, equal scores keep the order of ids, and an id counts once if it is to."""
    rng = np.random.default_rng(2)
    for distinct in (False, True):
        held, everything = Best(np.array([2, 0, 3]), distinct), {0: [], 1: [], 2: []}
        held.most = 4
        for _ in range(30):
            rows, picked = rng.integers(0, 3, 2), rng.integers(0, 4, 2)
            values = picked // 2 * 1.0
            held.add(rows, pa.array([ids[i] for i in picked]), values)
            for r, i, v in zip(rows.tolist(), picked.tolist(), values.tolist()):
                everything[r].append((-v, ids[i]))
        rows, names, values = held.cut()
        want = [(r, i, -v) for r, k in ((0, 2), (2, 3)) for v, i in sorted(set(everything[r]) if distinct else everything[r])[:k]]
        assert list(zip(rows.tolist(), names.to_pylist(), values.tolist())) == want

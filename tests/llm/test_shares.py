"""Source mixing against a plain walk over words, and the exactness of its tree."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from helpers_llm import prose, write
from pyspark.sql import functions as F

from cartwheel.llm import queries, shares

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, 0) for i, t, s in rows], SCHEMA)


def some_rows(rng, n, sources):
    return [(i, prose(rng, rng.choice([1, 2, 5, 30, 80])), rng.choice(sources)) for i in range(n)]


def n_words(text):
    return len(re.findall("[^ \t-\r]+", text or ""))


def plain_targets(sizes, share=1.5, repeats=2):
    """Shares by weight; what is above a limit goes to the others, again and again."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    target, full, excess = {s: 0.0 for s in names}, set(), share * sum(sizes.values())
    while excess > 1e-9:
        free = [s for s in names if s not in full]
        for s in free:
            target[s] += excess * weight[s] / sum(weight[x] for x in free)
        excess = 0.0
        for s in free:
            if target[s] > repeats * sizes[s]:
                excess += target[s] - repeats * sizes[s]
                target[s] = float(repeats * sizes[s])
                full.add(s)
    return target


def plain_taken(made, rows):
    """Words taken from each (id, text), by writing out every source's words and visiting its blocks."""
    taken = Counter()
    for s, name in enumerate(made.names):
        own = [(i, t) for i, t, source in rows if source == name]
        digest = lambda i: hashlib.md5(f"{'' if i is None else i}|{made.seed}".encode()).hexdigest()
        own.sort(key=lambda r: (digest(r[0]), n_words(r[1])))
        stream = [doc for doc in own for _ in range(n_words(doc[1]))]
        blocks = [stream[i : i + made.block_words] for i in range(0, len(stream), made.block_words)]
        left, turn = math.floor(made.targets[s] + 0.5), 0
        while left:
            for place in range(len(blocks)):
                block = blocks[int(shares.permuted([place], len(blocks), made.key(s, turn))[0])][:left]
                taken.update(block)
                left -= len(block)
            turn += 1
    return taken


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 17, 64, 65, 1_000])
def test_permutation_and_its_inverse(n):
    for key in (0, 5, 2_000_000_011 % shares.PRIME):
        image = shares.permuted(np.arange(n), n, key)
        assert sorted(image) == list(range(n))
        assert (shares.permuted(image, n, key, back=True) == np.arange(n)).all()
    assert n < 64 or not (shares.permuted(np.arange(n), n, 1) == shares.permuted(np.arange(n), n, 2)).all()


def test_targets_equal_repeated_resharing():
    rng = random.Random(2)
    for _ in range(100):
        sizes = {f"s{i}": rng.choice([0, 1, 7, 100, 5_000]) for i in range(rng.randint(1, 9))}
        names = sorted(sizes)
        found = shares.targets(np.array([sizes[s] for s in names]), np.resize([3.0, 1.0, 2.0], len(names)), 1.5, 2)
        assert found == pytest.approx([plain_targets(sizes)[s] for s in names])
        assert found.sum() == pytest.approx(1.5 * sum(sizes.values()))


def test_tree_splits_exactly_and_each_part_alone():
    draws = np.array([1_000, 0, 37, 250], np.int64)
    parts = list(shares.quotas(draws, 64, 3, 0, 10**6))
    assert [p[0] for p in parts] == list(range(-(-1287 // 64)))
    assert sum(p[2] for p in parts).tolist() == draws.tolist()
    assert [int(p[2].sum()) for p in parts] == [64] * 20 + [7]
    before = np.zeros(4, np.int64)
    for shard, start, own in parts:
        assert (start == before).all()
        before = before + own
        alone = list(shares.quotas(draws, 64, 3, shard, shard + 1))
        assert len(alone) == 1 and (alone[0][2] == own).all() and (alone[0][1] == start).all()
    # A mix: each full shard has about its share of every source.
    assert np.std([p[2][0] / 64 for p in parts[:-1]]) < 0.1


def test_counts_beyond_what_numpy_samples(monkeypatch):
    monkeypatch.setattr(shares, "MOST", 100)
    colors = np.array([900, 33, 0, 701], np.int64)
    for n in (0, 1, 500, 1_633, 1_634):
        got = shares.sample(np.random.default_rng(n), colors, n)
        assert got.sum() == n and (got >= 0).all() and (got <= colors).all()


@pytest.mark.parametrize("block_words", [1, 7, 50, 4_096])
def test_taken_words_equal_a_plain_walk(spark, block_words):
    rng = random.Random(block_words)
    rows = some_rows(rng, 120, ["b", "a", None, "c", "tiny"]) + [(500, "one", "lonely"), (501, None, "void"), (None, "no id here", "a"), (3, " \n", "a")]
    made, placed, spans = shares.mixed(documents(spark, rows), block_words=block_words, shard_blocks=5)
    total = {r["key"]: r["n"] for r in spans.join(placed.select("row", "key"), "row").groupBy("key").agg(F.sum("n_words").alias("n")).collect()}
    expected = Counter()
    for (i, _), n in plain_taken(made, rows).items():
        expected[i] += n
    assert total == dict(expected)
    sizes = defaultdict(int)
    for _, t, s in rows:
        sizes[s] += n_words(t)
    assert dict(zip(made.names, made.targets)) == pytest.approx(plain_targets(sizes))
    assert all(total.get(i, 0) <= 2 * n_words(t) for i, t, _ in rows if i not in (3,))


def test_shards_are_disjoint_and_spell_the_words(spark):
    rng = random.Random(9)
    rows = some_rows(rng, 80, ["x", "y"])
    frame = documents(spark, rows)
    made, placed, spans = shares.mixed(frame, block_words=16, shard_blocks=8)
    spans = spans.join(placed.select("row", "key"), "row").collect()
    seen = Counter((s["key"], s["turn"], w) for s in spans for w in range(s["first_word"], s["first_word"] + s["n_words"]))
    assert max(seen.values()) == 1
    per_shard = Counter()
    for shard, place in {(s["shard"], s["place"]) for s in spans}:
        per_shard[shard] += 1
    draws, _ = made.draws()
    assert sum(per_shard.values()) == draws.sum() and set(per_shard.values()) <= {8, int(draws.sum()) % 8}
    words = {i: t.split() for i, t, _ in rows}
    _, placed, spans = shares.mixed(frame, block_words=16, shard_blocks=8)
    for r in shares.texts(frame, placed, spans).collect():
        part = r["text"].split(" ")
        assert part == words[r["key"]][r["first_word"] : r["first_word"] + len(part)]


def test_query(spark, tmp_path):
    rows = some_rows(random.Random(1), 60, ["q", "r", "s"]) + [(5, None, "q"), (7, "twice", None), (7, "twice", None)]
    folder = write(spark, tmp_path, documents=documents(spark, rows))
    first, second = (sorted(map(tuple, queries.op12_mix(spark, folder).collect()), key=str) for _ in range(2))
    assert first == second and len(first) == len(rows)
    assert sorted((r[0], r[1]) for r in first) == sorted((i, n_words(t)) for i, t, _ in rows)
    assert sum(r[4] for r in first) == pytest.approx(1.5 * sum(r[1] for r in first), abs=3)
    assert all(r[4] <= 2 * r[1] for r in first)


def test_empty_and_wordless_tables(spark):
    for rows in ([], [(1, None, "a"), (2, " ", None)]):
        made, placed, spans = shares.mixed(documents(spark, rows))
        assert placed.count() == len(rows) and spans.count() == 0 and not made.targets.any()


def test_words_in(spark):
    values = ["", " ", "a", " a", "a ", " a  b\t\r\nc ", "\x0b\x0c", "é\xa0ü x", None, "w " * 50_000]
    frame = spark.createDataFrame([(v,) for v in values], "t string")
    assert [r[0] for r in frame.select(shares.words_in(F.col("t"))).collect()] == [n_words(v) for v in values]

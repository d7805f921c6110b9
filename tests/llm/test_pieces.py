"""Piece segmentation against trying every segmentation, and exact round trips."""

import itertools
import math
import random

import corpus_pipeline
import numpy as np
import pytest
from helpers_llm import prose, rows_of, table, write

from cartwheel.llm import lattice, pieces
from cartwheel.llm.blocks import Block
from cartwheel.llm.queries import op4_sentencepiece

SMALL = [b" ", b" a", b"ab", b"abc", b"b", b"c", b" ab", b"bc", b"a", b"cab", "é".encode(), b"  "]


@pytest.fixture(scope="module")
def model():
    return lattice.Vocabulary.load(pieces.MODEL)


@pytest.fixture(scope="module")
def small():
    return lattice.Vocabulary(SMALL, list(range(300, 300 + len(SMALL))), list(range(256)))


def all_paths(text, vocabulary):
    """Every segmentation with its score."""
    single, ids = vocabulary.singles
    if not text:
        return [(0.0, ())]
    out = []
    for size in range(1, min(len(text), vocabulary.longest) + 1):
        head, rest = text[:size], None
        number = vocabulary.by_bytes.get(head)
        if size == 1:
            rest = (single[head[0]], ids[head[0]])
        elif number is not None:
            rest = (vocabulary.scores[number], vocabulary.ids[number])
        if rest is not None:
            out += [(rest[0] + s, (int(rest[1]), *p)) for s, p in all_paths(text[size:], vocabulary)]
    return out


@pytest.mark.parametrize("seed", range(20))
def test_search_finds_the_n_best(small, seed):
    rng = random.Random(seed)
    text = bytes(rng.choice(b"abc d") for _ in range(rng.randint(1, 9)))
    want = sorted((s for s, _ in all_paths(text, small)), reverse=True)[:6]
    found = lattice.best_paths(text, small, 6)
    assert np.allclose([s for s, _ in found], want)
    assert len({p for _, p in found}) == len(found)


def given():
    rng = random.Random(8)
    texts = ["".join(rng.choice(["a", "b", "c", " ", "é", "d", "\n"]) for _ in range(rng.randint(0, 11))) for _ in range(60)]
    return [*texts, "abcabc", "abcabc abcabc", "  a  b ", "", None, "▁a b"]


def test_encode_matches_every_segmentation(spark, small):
    texts = given()
    found = rows_of(pieces.encode(table(spark, texts, ["'x' AS ids", "1 AS nbest"]), small, n=4))
    for i, text in enumerate(texts):
        row = found[i]
        if not text:
            assert (row["ids"], row["score"], row["nbest"]) == (None if text is None else [], 0.0, [])
            continue
        paths = dict((p, s) for s, p in all_paths((" " + text).encode(), small))
        want = sorted(paths.values(), reverse=True)[:4]
        assert np.allclose([row["score"], *(w["score"] for w in row["nbest"])], want), text
        ways = {tuple(row["ids"]): row["score"]}
        for way in row["nbest"]:
            ways[tuple(pieces.rewritten(row["ids"], way["edits"]))] = way["score"]
        assert len(ways) == len(want)
        assert all(math.isclose(paths[p], s, abs_tol=1e-9) for p, s in ways.items())


def test_round_trip_and_counts(spark, model):
    rng = random.Random(1)
    texts = [prose(rng, rng.randint(1, 300)) for _ in range(40)]
    texts += ["", None, " ", "   ", "\n\n\ttabs\t ", " lead and trail ", "▁mark ▁▁", "日本語と한국어 😀 ﷽", "\u0000\u0001", "é", "a" * 5_000, "é" * 3_000]
    texts += ["".join(chr(rng.randrange(32, 0x2FF)) for _ in range(200)) for _ in range(20)] + [prose(rng, 40_000)]
    frame = table(spark, texts)
    encoded = pieces.encode(frame, model)
    found = rows_of(pieces.decode(encoded, model))
    counted = rows_of(pieces.count(frame, model))
    for i, text in enumerate(texts):
        assert found[i]["decoded"] == text, i
        assert counted[i]["n_tokens"] == len(found[i]["ids"] or [])
        scores = [found[i]["score"], *(w["score"] for w in found[i]["nbest"])]
        assert scores == sorted(scores, reverse=True)


def test_other_segmentations_spell_the_same_text(spark, model):
    texts = ["the internationalisation of words", "x", "hello hello hello"]
    for row in pieces.encode(table(spark, texts), model).collect():
        assert row["nbest"]
        for way in row["nbest"]:
            ids = np.array(pieces.rewritten(row["ids"], way["edits"]))
            assert pieces.spell(ids, np.array([0, len(ids)]), model) == [row["text"]]


def test_trie_scores_equal_those_of_single_words(model):
    rng = random.Random(6)
    words = sorted({" " + prose(rng, 1) for _ in range(300)})
    data = np.frombuffer("".join(words).encode(), np.uint8)
    found = lattice.tokens(Block(None, data, np.cumsum([0, *(len(w.encode()) for w in words)])), model)
    for kind, terminal in itertools.islice(enumerate(found.terminal), 200):
        paths = lattice.best_paths(found.spelled(kind), model, 2)
        assert math.isclose(found.forward.score[terminal], paths[0][0], abs_tol=1e-9)
        if len(paths) > 1:
            assert math.isclose(found.forward.slack[terminal], paths[0][0] - paths[1][0], abs_tol=1e-9)
        else:
            assert math.isinf(found.forward.slack[terminal])


@pytest.mark.parametrize("name", ["small", "model"])
def test_walks_equal_levels(request, name, monkeypatch):
    vocabulary, rng = request.getfixturevalue(name), random.Random(9)
    words = ["a" * 70, "a" * 71, "ab" * 40, "ab" * 40 + "c", "=" * 90, " " * 33, "the" * 30, "abcab", "é" * 20]
    words += ["".join(rng.choice("abc ") for _ in range(rng.randint(1, 60))) for _ in range(200)]
    data = np.frombuffer("\n".join(words).encode(), np.uint8)
    block = Block(None, data, np.array([0, len(data)]))
    found = []
    for few in (0, 3, 10**6):
        monkeypatch.setattr(lattice, "FEW", few)
        own = lattice.tokens(block, vocabulary)
        forward = own.forward
        ids, bounds = lattice.best_ids(own)
        found.append([forward.score[own.terminal], forward.pieces[own.terminal], forward.slack[own.terminal], ids, bounds])
        # A trie has one node for each distinct prefix, however it was built.
        found[-1].append(np.array([len(forward.score)]))
    for other in found[1:]:
        assert all(np.array_equal(a, b) for a, b in zip(found[0], other, strict=True))


def test_long_runs(spark, model):
    texts = [c * 200_000 for c in "a =.-é"] + ["ab" * 100_000, "x" + "\t" * 200_000]
    frame = table(spark, texts)
    found = rows_of(pieces.decode(pieces.encode(frame, model), model))
    counted = rows_of(pieces.count(frame, model))
    for i, text in enumerate(texts):
        assert found[i]["decoded"] == text
        assert counted[i]["n_tokens"] == len(found[i]["ids"])
        scores = [found[i]["score"], *(w["score"] for w in found[i]["nbest"])]
        assert all(a >= b - 1e-5 for a, b in zip(scores, scores[1:]))


def test_decode_of_odd_ids(spark, model):
    frame = spark.createDataFrame([(1, [0, 1, 2, 10**6, -5]), (2, [3 + 0xC3]), (3, None), (4, [])], "doc_id long, ids array<int>")
    found = rows_of(pieces.decode(frame, model))
    assert [found[i]["decoded"] for i in (1, 2, 3, 4)] == ["", "�", None, ""]


def test_empty_table(spark, model):
    assert pieces.decode(pieces.encode(table(spark, []), model), model).count() == 0
    assert pieces.count(table(spark, []), model).count() == 0


def test_encoding_and_decoding_in_one_task_give_the_same_rows(spark, small, monkeypatch):
    texts = [*given(), "a b c " * 400]
    frame = table(spark, texts, ["1 AS ids", "'x' AS decoded"]).coalesce(2)
    monkeypatch.setattr(pieces, "ENCODED_BYTES", 500)
    apart = pieces.decode(pieces.encode(frame, small), small)
    together = pieces.encode_and_decode(frame, small)
    assert together.columns == apart.columns
    assert sorted(map(str, together.collect())) == sorted(map(str, apart.collect()))


def test_queries_have_one_python_worker_a_task(spark, tmp_path):
    folder = write(spark, tmp_path, documents=table(spark, ["some text", None, ""]))
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for frame in (corpus_pipeline.encoded(spark, docs, folder), op4_sentencepiece(spark, folder)):
        assert frame._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
        assert all(r["round_trip"] for r in frame.collect())

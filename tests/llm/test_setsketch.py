"""Near duplicates against all pairs in plain Python."""

import random

import numpy as np
import pytest
from helpers_llm import prose, rows_of, table

from cartwheel.llm import setsketch


def shingles(text):
    words = "".join(c.lower() if c.isascii() else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4)) if len(words) >= 5 else frozenset([tuple(words)])


def brute(rows, percent):
    sets = {i: shingles(t) for i, t in rows}
    label = {i: i for i in sets}

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                shared = len(sets[a] & sets[b])
                if 100 * shared >= percent * len(sets[a] | sets[b]):
                    x, y = sorted((root(a), root(b)))
                    label[y] = x
    return {i: (len(sets[i]), root(i)) for i in ids}


def edited(rng, text, share):
    words = text.split(" ")
    for _ in range(int(share * len(words))):
        words[rng.randrange(len(words))] = "x" + str(rng.randrange(10**6))
    return " ".join(words)


def corpus(seed):
    rng = random.Random(seed)
    hot = prose(rng, 80)
    texts = [prose(rng, rng.randint(1, 60)) for _ in range(60)]
    texts += [edited(rng, hot, rng.random() * 0.08) for _ in range(70)]
    texts += [edited(rng, texts[i], 0.02) for i in range(30)]
    texts += [texts[3]] * 20 + [texts[4].upper(), texts[4].replace(" ", "\n"), None, "", " \t", "One", "one", "one two three four", "é É"]
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize("percent", [80, 85])
@pytest.mark.parametrize("block", [256, 16])
def test_components_match_all_pairs(spark, monkeypatch, block, percent):
    monkeypatch.setattr(setsketch, "BLOCK", block)
    texts = corpus(block)
    found = rows_of(setsketch.near_duplicates(table(spark, texts), percent))
    want = brute(list(enumerate(texts)), percent)
    assert {i: (r["n_shingles"], r["component_id"]) for i, r in found.items()} == want
    assert all(r["kept"] == (r["component_id"] == i) for i, r in found.items())


def test_stage_keeps_one_of_each(spark):
    texts = corpus(5)
    frame = table(spark, texts, ["lang AS component", "1 AS n", "'x' AS unit"])
    out = setsketch.deduplicated(frame, 80)
    assert out.columns == frame.columns
    want = {i for i, (_, c) in brute(list(enumerate(texts)), 80).items() if i == c}
    assert {r["doc_id"] for r in out.collect()} == want


def test_edge_rows(spark):
    text = "a b c d e f g"
    out = setsketch.near_duplicates(table(spark, [text, text, text, None], ids=[5, 5, None, 9]), 85).collect()
    assert sorted((r["doc_id"] is None, r["component_id"], r["kept"]) for r in out if r["doc_id"] is not None) == [
        (False, 5, True),
        (False, 5, True),
        (False, 9, True),
    ]
    assert [(r["component_id"], r["kept"]) for r in out if r["doc_id"] is None] == [(None, True)]
    assert setsketch.near_duplicates(table(spark, [])).count() == 0
    assert setsketch.deduplicated(table(spark, [])).count() == 0


def test_long_text(spark):
    rng = random.Random(3)
    words = prose(rng, 60_000)
    out = rows_of(setsketch.near_duplicates(table(spark, [words, words + " end", "short text"]), 85))
    assert out[1]["component_id"] == 0 and out[2]["component_id"] == 2 and out[0]["n_shingles"] == len(shingles(words))


def test_registers_estimate_similarity():
    rng = np.random.default_rng(4)
    for similarity in (0.5, 0.85, 0.95):
        shared = rng.integers(0, 1 << 62, 4_000, dtype=np.uint64)
        extra = int(4_000 * (1 - similarity) / similarity / 2)
        a = np.concatenate([shared, rng.integers(0, 1 << 62, extra, dtype=np.uint64)])
        b = np.concatenate([shared, rng.integers(0, 1 << 62, extra, dtype=np.uint64)])
        r = setsketch.sketches([a, b])
        assert abs((r[0] == r[1]).mean() - similarity) < 0.16
        # The sketch of a union is the maximum of the sketches.
        assert (setsketch.sketches([np.concatenate([a, b])])[0] == np.maximum(r[0], r[1])).all()
        good, _ = setsketch.plausible(r[:1], np.array([len(a)]), r[1:], np.array([len(b)]), 85)
        assert good[0, 0] == (similarity >= 0.8)


def test_components_of_a_long_chain(spark, tmp_path):
    edges = spark.createDataFrame([(i, i + 1) for i in range(0, 200) if i != 99], "a long, b long")
    found = rows_of(setsketch.components(edges, str(tmp_path), "chain"), "id")
    assert all(found[i]["component"] == (0 if i <= 99 else 100) for i in range(201))

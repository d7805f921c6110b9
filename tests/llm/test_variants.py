"""Spelling variants against plain neighbourhoods of whole words."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from helpers_llm import prose, table, write

from cartwheel.llm import queries, variants

LOWER = str.maketrans(variants.CAPITALS, variants.CAPITALS.lower())


def near_words(vocabulary):
    """All words at distance 1, by deleting letters from both sides."""
    holes, near = defaultdict(set), defaultdict(set)
    for w in vocabulary:
        for i in range(len(w)):
            holes[i, w[:i] + w[i + 1 :]].add(w)
            if (shorter := w[:i] + w[i + 1 :]) in vocabulary:
                near[w].add(shorter)
                near[shorter].add(w)
    for group in holes.values():
        for w in group:
            near[w] |= group - {w}
    return near


def plain(vocabulary):
    """{word: (n, n_near, form, form_n, root)}"""
    near = near_words(vocabulary)
    form = {}
    for w, n in vocabulary.items():
        if near[w]:
            best = min(near[w], key=lambda x: (-vocabulary[x], x))
            if vocabulary[best] >= 2 * n:
                form[w] = best
    out = {}
    for w, n in vocabulary.items():
        root = w
        while root in form:
            root = form[root]
        out[w] = (n, len(near[w]), form.get(w), vocabulary[form[w]] if w in form else None, root)
    return out


def found(frame):
    rows = frame.collect()
    assert len({r["word"] for r in rows}) == len(rows)
    return {r["word"]: tuple(r[c] for c in ("n", "n_near", "form", "form_n", "root")) for r in rows}


def test_neighbourhoods_hold_every_reduced_word_that_is_near():
    rng = random.Random(1)
    words = ["".join(rng.choice("abcdé") for _ in range(rng.randint(1, 7))) for _ in range(80)]
    data, bounds = variants.reduced(words, 4)
    symbols = ["".join(map(str, data[a:b])) for a, b in zip(bounds, bounds[1:])]
    own, others = None, set()
    for word, code, same in variants.neighbourhoods(words, 4):
        if same.all():
            own = code
        else:
            assert len(set(zip(word, code))) == len(word)
            others |= set(zip(word.tolist(), code.tolist()))
    for i, a in enumerate(symbols):
        for j, b in enumerate(symbols):
            deletions = {a[:k] + a[k + 1 :] for k in range(len(a))}
            upward = {a[:k] + c + a[k + 1 :] for k in range(len(a)) for c in "0123" if c > a[k]}
            assert ((i, int(own[j])) in others) == (b in deletions | upward)
            assert (own[i] == own[j]) == (a == b)


@pytest.mark.parametrize("symbols", [2, 4, 7])
def test_groups_match_brute_force(spark, symbols):
    rng = random.Random(symbols)
    words = {"".join(rng.choice("abc") for _ in range(rng.randint(1, 6))) for _ in range(400)}
    words |= {w + "é" for w in list(words)[:50]} | {"ab" * 40, "ab" * 40 + "c", "b" + "ab" * 40, "x" * 64, "x" * 65, "x" * 66, "x" * 63 + "y", "y" + "x" * 64}
    vocabulary = {w: rng.choice([1, 2, 3, 4, 8, 16, 30, 70]) for w in words}
    frame = spark.createDataFrame([(w, n, "extra") for w, n in vocabulary.items()], "word string, n long, form string")
    assert found(variants.grouped(frame, symbols=symbols)) == plain(vocabulary)


def test_chains_of_forms_reach_the_last(spark):
    # Each word is near the next only, and has half its count.
    words = ["q" * (5 + i) for i in range(12)]
    vocabulary = {w: 3 << i for i, w in enumerate(words)}
    out = found(variants.grouped(spark.createDataFrame(list(vocabulary.items()), "word string, n long")))
    assert {row[4] for row in out.values()} == {words[-1]} and out == plain(vocabulary)


def test_hot_reduced_word(spark):
    # Letters that share a symbol: one reduced word for thousands, and hardly any near pairs.
    letters = [chr(c) for c in range(0x100, 0x1000)]
    data, _ = variants.reduced(letters, 4)
    same = [x for x, s in zip(letters, data) if s == 0][:60]
    rng = random.Random(4)
    vocabulary = {"".join(rng.choice(same) for _ in range(6)): rng.randint(3, 90) for _ in range(3_000)}
    assert found(variants.grouped(spark.createDataFrame(list(vocabulary.items()), "word string, n long"))) == plain(vocabulary)


def plain_counts(texts, ids):
    counts = Counter()
    for i, text in zip(ids, texts):
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            counts[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 97 == 0 else run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def test_query_matches_brute_force(spark, tmp_path):
    rng = random.Random(6)
    texts = [prose(rng, rng.choice([1, 40, 300])).replace("n", rng.choice("nN"), 3) for _ in range(150)]
    texts += [None, "", "1234 _ \n", "ÀÉÎÕÜ Àéîõü àéîõü ÷×÷×÷ ", "word" * 30_000, "word" * 30_000, "word" * 30_000 + "s"] + [texts[0]] * 4
    ids = [*range(len(texts) - 2), 3, None]
    folder = write(spark, tmp_path, documents=table(spark, texts, ["1 AS word", "'x' AS key"], ids=ids))
    counts = plain_counts(texts, ids)
    assert len(counts) > 100
    assert found(queries.op13_variants(spark, folder)) == plain(counts)


def test_empty_tables(spark):
    assert variants.grouped(spark.createDataFrame([], "word string, n long")).count() == 0
    assert variants.counted(variants.misspelt(variants.runs(table(spark, [])))).count() == 0
    assert variants.near_pairs(spark.createDataFrame([("alone", 4)], "word string, n long")).count() == 0


def test_codes_do_not_depend_on_the_place():
    one = [c for _, c, s in variants.neighbourhoods(["hello"]) if not s.all()]
    two = [(w, c) for w, c, s in variants.neighbourhoods(["some", "hello", "x"]) if not s.all()]
    assert set(np.concatenate(one)) == {c for w, code in two for i, c in zip(w, code) if i == 1}

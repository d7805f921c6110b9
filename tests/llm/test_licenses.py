"""The license index against searching every phrase at every word."""

import math
import random
import re
import time

import numpy as np
from helpers_llm import prose, rows_of, table

from cartwheel.llm import licenses

WORDS = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return WORDS.findall("".join(c.lower() if c.isascii() else c for c in text or ""))


def brute(text):
    own, places = words(text), []
    for template in licenses.BASE:
        phrase = template.words
        places += [(i, template.label) for i in range(len(own)) if own[i : i + len(phrase)] == phrase]
    return own, places


def texts():
    rng = random.Random(3)
    lines = ["Released under the MIT License.", "Licensed under the Apache License, Version 2.0.", "under CC BY-NC 4.0", "cc by", "nc under the mit"]
    out = []
    for _ in range(120):
        parts = [prose(rng, rng.randint(0, 12)) for _ in range(4)]
        for _ in range(rng.randint(0, 4)):
            parts.insert(rng.randrange(len(parts)), rng.choice(lines))
        out.append(rng.choice([" ", "\n", "... "]).join(parts))
    out += [None, "", "...", "under the mit", "license", "UNDER\x00THE/MIT-license", "cc by nc cc by nc cc by nc", "undér the mit license"]
    out += ["This work is licensed under the GNU General Public License, version 3.", "under the mit license " * 5_000]
    return out


def test_base_phrases_match_brute_force(spark):
    given = texts()
    frame = table(spark, given, ["'x' AS licenses", "0 AS n_words"])
    found = rows_of(licenses.digest(licenses.scan(frame, licenses.build_index(frame))))
    assert len(found) == len(given)
    for i, text in enumerate(given):
        own, places = brute(text)
        row, at = found[i], [p for p, _ in places]
        assert row["n_words"] == len(own)
        assert row["n_base"] == len(places)
        assert (row["first_word"], row["last_word"]) == ((min(at), max(at)) if at else (None, None))
        assert row["base_labels"] == ",".join(sorted({label for _, label in places}))
        assert set(filter(None, row["base_labels"].split(","))) <= set(row["labels"].split(","))
        assert 0 <= row["score"] <= 1


def every_place(own, templates, idf):
    """(template, first word of the key, coverage) by trying every template at every word."""
    found = []
    for number, template in enumerate(templates):
        words, key = template.words, template.key.split()
        lead = next(i for i in range(len(words)) if words[i : i + len(key)] == key)
        for at in range(len(own) - len(key) + 1):
            if own[at : at + len(key)] != key:
                continue
            begin = at - lead
            there = [i for i in range(len(words)) if 0 <= begin + i < len(own) and own[begin + i] == words[i]]
            coverage = sum(idf[words[i]] for i in there) / sum(idf[w] for w in words)
            if coverage >= licenses.COVERAGE:
                found.append((number, at, round(coverage, 9)))
    return found


def generated(rng, many, vocabulary):
    """Templates of few different words, so that keys overlap, repeat words and share prefixes."""
    out = []
    for i in range(many):
        words = [rng.choice(vocabulary) for _ in range(rng.randint(3, 9))]
        size = rng.randint(2, len(words))
        first = rng.randint(0, len(words) - size)
        out.append(licenses.Template(f"t{i}", " ".join(words), " ".join(words[first : first + size])))
    return out


def test_all_places_match_brute_force(spark, monkeypatch):
    rng = random.Random(12)
    templates = [*licenses.TEMPLATES, *generated(rng, 40, ["under", "the", "ab", "cd", "license", "x1"])]
    given = texts()[:60]
    for _ in range(80):
        words_ = [rng.choice(["under", "the", "ab", "cd", "license", "x1", "other"]) for _ in range(rng.randint(0, 60))]
        for _ in range(rng.randint(0, 2)):
            copy = rng.choice(templates).words
            copy[rng.randrange(len(copy))] = rng.choice(copy)
            words_[rng.randint(0, len(words_)) : 0] = copy
        given.append(" ".join(words_))
    frame = table(spark, given)
    own = [words(t) for t in given]
    idf = {w: math.log((len(given) + 1) / (sum(w in set(o) for o in own) + 1)) + 1 for t in templates for w in t.words}
    want = {i: every_place(o, templates, idf) for i, o in enumerate(own)}
    assert sum(map(len, want.values())) > 300
    for at_once in (1, licenses.CANDIDATES):
        monkeypatch.setattr(licenses, "CANDIDATES", at_once)
        index = licenses.build_index(frame, templates)
        assert index.window == 2
        for i, row in rows_of(licenses.scan(frame, index)).items():
            assert [(p["template"], p["word"], round(p["coverage"], 9)) for p in row["licenses"]] == want[i], i


def test_cost_does_not_follow_the_number_of_templates():
    rng = random.Random(13)
    names = [f"w{i}" for i in range(4_000)]
    many = [licenses.Template(f"t{i}", " ".join(p), " ".join(p[1:6])) for i, p in enumerate([rng.sample(names, 9) for _ in range(2_000)])]
    text = [rng.choice(["licensed", "under", "the", "mit", "license", "plain"]) if rng.random() < 0.3 else f"v{rng.randrange(900)}" for _ in range(200_000)]
    for at in range(0, len(text), 500):
        text[at : at + 4] = ["under", "the", "mit", "license"]
    hashes = licenses.hash_bytes([w.encode() for w in text])
    owner = np.arange(len(text)) // 1_000
    took = []
    for templates in (licenses.TEMPLATES, [*licenses.TEMPLATES, *many]):
        index = licenses.Index(templates, 10, {})
        number = index.numbers(hashes)
        began = time.process_time()
        found = [index.places(number, owner) for _ in range(5)][0]
        took.append(time.process_time() - began)
        assert len(found[0]) >= 400
    assert took[1] < 4 * took[0] + 0.2


def test_no_templates(spark):
    frame = table(spark, ["under the mit license", None])
    assert [r["licenses"] for r in licenses.scan(frame, licenses.build_index(frame, [])).collect()] == [[], []]


def test_notices_get_their_labels(spark):
    notices = [t.phrase for t in licenses.NOTICES] + [t.phrase.replace("software", "program") for t in licenses.NOTICES]
    frame = table(spark, ["intro words " + n.title() + " more" for n in notices])
    found = rows_of(licenses.digest(licenses.scan(frame, licenses.build_index(frame))))
    for i, template in enumerate(licenses.NOTICES):
        assert template.label in found[i]["labels"].split(",")
    plain = table(spark, ["general public licence", "permission to be free of charge for the software"])
    assert {r["labels"] for r in licenses.digest(licenses.scan(plain, licenses.build_index(plain))).collect()} == {""}


def test_places_do_not_depend_on_neighbours(spark):
    frame = table(spark, ["released under the", "mit license", "under the mit license"]).coalesce(1)
    found = rows_of(licenses.digest(licenses.scan(frame, licenses.build_index(frame))))
    assert [found[i]["n_base"] for i in range(3)] == [0, 0, 1]


def test_empty_table(spark):
    frame = table(spark, [])
    assert licenses.digest(licenses.scan(frame, licenses.build_index(frame))).count() == 0

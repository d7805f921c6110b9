"""Edit matching against dynamic programming over all positions."""

import random
import re

import numpy as np
import pytest
from helpers_llm import prose, rows_of, table

from cartwheel.llm import decontam


def distance_within(pattern, text):
    """Least edit distance of the pattern to any stretch of the text."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(pattern, 1):
        new = [i]
        for j, d in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (c != d)))
        row = new
    return min(row)


def edited(rng, text, edits):
    out = list(text)
    for _ in range(edits):
        at = rng.randrange(len(out))
        kind = rng.randrange(3)
        if kind == 0:
            out[at] = rng.choice("abcxyz")
        elif kind == 1:
            out.insert(at, rng.choice("abcxyz"))
        else:
            del out[at]
    return "".join(out)


@pytest.mark.parametrize("seed", range(6))
def test_myers_matches_dynamic_programming(seed):
    rng = random.Random(seed)
    pattern = "".join(rng.choice("abc ") for _ in range(rng.randint(1, 90)))
    text = "".join(rng.choice("abc ") for _ in range(rng.randint(0, 200))) + edited(rng, pattern, 3) + "ab"
    got, end = decontam.best(decontam.Pattern.bits(pattern), len(pattern), text, anchored=False)
    assert got == min(len(pattern), distance_within(pattern, text))
    assert distance_within(pattern, text[max(0, end - len(pattern) - got) : end]) == got


def test_leaks_match_brute_force(spark):
    rng = random.Random(2)
    items = [prose(rng, rng.randint(8, 60)) for _ in range(12)] + ["short", "", None]
    texts = []
    for i in range(80):
        item = items[rng.randrange(12)]
        k = int(0.05 * len(decontam.plain(item)))
        hidden = edited(rng, item, rng.choice([0, 0, k // 2, k, k + 1, 2 * k + 3]))
        if rng.random() < 0.3:
            hidden = re.sub(" ", rng.choice(["\n", " -- ", ", "]), hidden).upper()
        texts.append(prose(rng, rng.randint(0, 40)) + " " + hidden + ". " + prose(rng, rng.randint(0, 40)))
    texts += [None, "", "   ", prose(rng, 200), "Short", "a SHORT-cut", "shorten it", "ashort", "it is short", "short\nshort"]
    benchmark = spark.createDataFrame(list(enumerate(items)) + [(99, items[0]), (None, items[1])], "item_id long, text string")
    found = rows_of(decontam.leaks(table(spark, texts), benchmark))
    known = [(i, decontam.plain(t)) for i, t in [*enumerate(items), (99, items[0])] if t]
    for number, text in enumerate(texts):
        plain = decontam.plain(text or "") + " "
        want = {}
        for i, item in known:
            if len(item) < decontam.MIN_BYTES:
                if f" {item} " in f" {plain}":
                    want[i] = 0
                continue
            errors = distance_within(item, plain)
            if errors <= int(decontam.RATE * len(item)):
                want[i] = errors
        assert {x["item_id"]: x["errors"] for x in found[number]["leaks"]} == want, number
        for leak in found[number]["leaks"]:
            span = text.encode()[leak["first_byte"] : leak["end_byte"]].decode(errors="replace")
            assert distance_within(dict(known)[leak["item_id"]], decontam.plain(span) + " ") == leak["errors"]


def test_stage_drops_leaks_alone_and_blocks_agree(spark, monkeypatch):
    rng = random.Random(4)
    items = [prose(rng, 20) for _ in range(30)]
    texts = [prose(rng, 50) for _ in range(20)] + [prose(rng, 5) + " " + item for item in items]
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    frame = table(spark, texts, ["'x' AS leaks", "1 AS item_id"])
    whole = decontam.without_leaks(frame, benchmark)
    assert whole.columns == frame.columns
    assert {r["doc_id"] for r in whole.collect()} == set(range(20))
    monkeypatch.setattr(decontam, "ITEM_BYTES", 500)
    assert len(list(decontam.item_blocks(benchmark, "item_id", "text"))) > 3
    cut = rows_of(decontam.leaks(frame, benchmark))
    assert all([x["item_id"] for x in cut[20 + i]["leaks"]] == [i] for i in range(30))


def test_short_items_stand_as_whole_words(spark):
    items = ["What is a lemming?", "ab", "...", "ПРИВЕТ мир"]
    texts = ["so what is a lemming", "what is a lemmings", "what-is-a lemming", "cab abc", "x (ab) y", "ab", "", None, "привет, МИР", "...", "приветмир"]
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id int, text string")
    found = rows_of(decontam.leaks(table(spark, texts), benchmark))
    got = [[x["item_id"] for x in found[i]["leaks"]] for i in range(len(texts))]
    assert got == [[0], [], [0], [], [1], [1], [], [], [3], [], []]
    assert texts[4][found[4]["leaks"][0]["first_byte"] : found[4]["leaks"][0]["end_byte"]] == "ab"


@pytest.mark.parametrize(
    "item",
    ["съешь же ещё этих мягких французских булок", "ξεσκεπάζω την ψυχοφθόρα βδελυγμία", "zażółć gęślą jaźń ąęśćżźńółĄ", "voix ambiguë d'un cœur", "𐐨𐐩𐐪𐐫𐐬𐐭𐐮 deseret"],
)
def test_case_folds_in_all_scripts(spark, item):
    benchmark = spark.createDataFrame([("one", item)], "item_id string, text string")
    texts = [f"x {item.upper()} y", f"{item.title()}", item]
    for row in decontam.leaks(table(spark, texts), benchmark).collect():
        assert [(x["item_id"], x["errors"]) for x in row["leaks"]] == [("one", 0)]


def test_folding_keeps_every_byte_in_place():
    text = "".join(chr(c) for c in range(0x20, 0x11000) if not 0xD800 <= c < 0xE000) + "𐐀"
    data = np.frombuffer(text.encode(), np.uint8)
    low = decontam.folded(data).tobytes().decode()
    assert len(low) == len(text)
    for a, b in zip(text, low):
        if a != b:
            assert b in (a.lower(), a.casefold())
        elif a.lower() != a:
            assert len(a.lower().encode()) != len(a.encode())
    broken = np.frombuffer(b"\xc3A\xd0\xe1\xbaB\xf0\x90\xc3", np.uint8)
    assert decontam.folded(broken).tobytes() == b"\xc3a\xd0\xe1\xbab\xf0\x90\xc3"


def test_blocks_that_are_held_and_stored(spark, monkeypatch):
    rng = random.Random(7)
    items = [prose(rng, 20) for _ in range(30)]
    texts = [prose(rng, 5) + " " + item + " " + items[(i * 7) % 30] for i, item in enumerate(items)] + [prose(rng, 40), None]
    benchmark = spark.createDataFrame([(f"i{i:02}", t) for i, t in enumerate(items)], "item_id string, text string")
    whole = rows_of(decontam.leaks(table(spark, texts), benchmark))
    monkeypatch.setattr(decontam, "ITEM_BYTES", 500)
    for shipped in (1_000, 64 << 20):
        monkeypatch.setattr(decontam, "SHIPPED_BYTES", shipped)
        cut = rows_of(decontam.leaks(table(spark, texts), benchmark))
        for i in range(len(texts)):
            assert sorted(cut[i]["leaks"]) == sorted(whole[i]["leaks"])
            assert cut[i]["text"] == texts[i]
        assert {x["item_id"] for x in cut[1]["leaks"]} == {"i01", "i07"}


def test_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontam.without_leaks(table(spark, ["a", None]), none).count() == 2
    assert decontam.leaks(table(spark, []), none).count() == 0


def test_long_text(spark):
    rng = random.Random(5)
    item = prose(rng, 40)
    text = prose(rng, 150_000) + " " + item
    benchmark = spark.createDataFrame([(1, item)], "item_id long, text string")
    assert [x["item_id"] for x in decontam.leaks(table(spark, [text]), benchmark).first()["leaks"]] == [1]

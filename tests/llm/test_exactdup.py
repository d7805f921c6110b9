"""Content-sort dedup against grouping in plain Python."""

import hashlib
import random
import re

import pytest
from helpers_llm import prose, rows_of, table

from cartwheel.llm import exactdup


def expected(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(re.sub("[\x20\x09-\x0d]+", " ", t or ""), []).append(i)
    return groups


def test_groups_match_brute_force(spark):
    rng = random.Random(1)
    base = [prose(rng, 30) for _ in range(40)]
    texts = [rng.choice(base).replace(" ", rng.choice([" ", "\n", "\t \r", "  "])) for _ in range(300)]
    texts += [None, "", " ", "\n\t", "a b", "a b", "x" * 200_000, "x" * 200_000 + " "]
    rows = list(enumerate(texts))
    found = rows_of(exactdup.groups(table(spark, texts)))
    assert len(found) == len(rows)
    for text, ids in expected(rows).items():
        for i in ids:
            assert found[i]["keep_id"] == min(ids)
            assert found[i]["group_size"] == len(ids)
            assert found[i]["kept"] == (i == min(ids))
            assert found[i]["text_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_hot_text_is_split_and_kept_once(spark):
    texts = ["the same text"] * 5_000 + ["another"]
    out = exactdup.groups(table(spark, texts)).where("kept").orderBy("doc_id").collect()
    assert [(r["doc_id"], r["group_size"]) for r in out] == [(0, 5_000), (5_000, 1)]


def test_deduplicated_keeps_rows_whole(spark):
    frame = table(spark, ["a  b", "a b", None, "", "c"], ["lang AS _text", "1 AS kept", "source AS _row", "doc_id AS _salt"], ids=[4, 2, None, 7, 7])
    out = exactdup.deduplicated(frame)
    assert out.columns == frame.columns
    assert sorted((r["doc_id"], r["text"]) for r in out.collect()) == [(2, "a b"), (7, ""), (7, "c")]


def test_repeated_ids_and_rows(spark):
    out = exactdup.groups(table(spark, ["t", "t", "t", "u"], ids=[3, 3, None, 3])).collect()
    kept = [r for r in out if r["kept"]]
    assert len(out) == 4 and sorted((r["keep_id"], r["group_size"]) for r in kept) == [(3, 1), (3, 3)]


def test_empty_table(spark):
    empty = table(spark, [])
    assert exactdup.groups(empty).count() == 0
    assert exactdup.deduplicated(empty).count() == 0


def test_plan_has_no_python(spark):
    plan = exactdup.groups(table(spark, ["a", "b"]))._jdf.queryExecution().toString()
    assert not any(name in plan for name in ("Python", "Arrow", "Pandas"))


@pytest.mark.parametrize("text", [" x", "\x0bx", "x\x0c\x0c", "\x1fx", "x\x85y"])
def test_only_the_named_white_space_counts(spark, text):
    found = exactdup.groups(table(spark, [text])).first()
    assert found["text_sha256"] == hashlib.sha256(re.sub("[\x20\x09-\x0d]+", " ", text).encode()).hexdigest()

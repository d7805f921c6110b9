"""Toxicity, quality and language: planted signals, edge rows, and held-out accuracy."""

import random

import numpy as np
import pyarrow as pa
import pytest
from helpers_llm import held_out, prose, rows_of, table, write
from pyspark.sql import functions as F

from cartwheel.llm import langmix, quality, toxicity
from cartwheel.llm.blocks import Block, bounded_sample
from cartwheel.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.1"


def marked(spark, tmp_path, mark, label, seed=1):
    """Documents of which some hold a mark; labels cover most and contradict each other for one."""
    rng = random.Random(seed)
    texts, labels = [], []
    for i in range(400):
        bad = rng.random() < 0.3
        words = prose(rng, rng.randint(4, 60)).split(" ")
        if bad:
            words.insert(rng.randrange(len(words)), mark)
        texts.append(" ".join(words))
        if i % 7:
            labels.append((i, 1, int(bad)) if label == "toxic" else (i, int(not bad), 0))
    labels += [(3, None, None), (4_000, 1, 1), (None, 1, 1)]
    texts += [None, "", " \n", "w" * 100_000, mark]
    frame = table(spark, texts, ["'x' AS score", "2 AS toxicity", "3 AS quality"])
    folder = write(spark, tmp_path, documents=frame, labels=spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    return folder, texts, labels


def test_toxicity_query(spark, tmp_path):
    folder, texts, labels = marked(spark, tmp_path, "Scum!", "toxic")
    found = rows_of(QUERIES["op1_toxicity"](spark, folder))
    assert len(found) == len(texts)
    assert all(row["held_out"] == held_out(i, 5, 0) and 0 <= row["score"] <= 1 for i, row in found.items())
    assert all(row["predicted"] == int(row["score"] >= 0.5) for row in found.values())
    known = [(i, t) for i, _, t in labels if i in found and t is not None]
    assert sum(found[i]["predicted"] == t for i, t in known) > 0.97 * len(known)
    assert found[400]["score"] == found[401]["score"] == found[402]["score"]


def test_toxic_weights_are_few_and_the_stage_keeps_columns(spark, tmp_path):
    folder, texts, _ = marked(spark, tmp_path, "scum", "toxic")
    documents, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    weights = toxicity.fit(documents, labels, F.lit(True))
    assert 0 < len(weights.buckets) < 500
    kept = toxicity.without_toxic(documents.drop("toxicity"), weights)
    assert kept.columns == documents.drop("toxicity").columns
    left = {r["doc_id"] for r in kept.collect()}
    assert sum(("scum" in (t or "")) == (i not in left) for i, t in enumerate(texts)) > 0.97 * len(texts)


def test_features_match_plain_python():
    text = "One two, three TWO"
    block = Block(None, np.frombuffer(text.encode(), np.uint8), np.array([0, len(text)]))
    owner, bucket = toxicity.features(block, 20)
    assert len(bucket) == 4 + 3 + 2 and (owner == 0).all()
    assert bucket[1] == bucket[3] and len(set(bucket.tolist())) == 8


def test_quality_query(spark, tmp_path):
    folder, texts, labels = marked(spark, tmp_path, "##%%##", "quality")
    found = rows_of(QUERIES["op5_quality"](spark, folder))
    assert len(found) == len(texts)
    assert all(row["held_out"] == held_out(i, 4, 2) and 0 <= row["score"] <= 1 for i, row in found.items())
    assert all(row["predicted"] == int(row["score"] >= 0.7) for row in found.values())
    known = [(i, q) for i, q, _ in labels if i in found and q is not None]
    assert sum(found[i]["predicted"] == q for i, q in known) > 0.95 * len(known)


def test_quality_chunks_cover_every_byte():
    sizes = [0, 1, 5, 447, 448, 449, 512, 513, 2_000]
    data = np.arange(sum(sizes), dtype=np.int64).astype(np.uint8)
    block = Block(None, data, np.cumsum([0, *sizes]))
    rows, counts = quality.chunks(block)
    at = 0
    for i, size in enumerate(sizes):
        own = data[block.bounds[i] : block.bounds[i + 1]]
        covered = 0
        for c in range(counts[i]):
            part = own[c * quality.STEP : c * quality.STEP + quality.CHUNK]
            assert (rows[at][: len(part)] == part).all() and not rows[at][len(part) :].any()
            covered = c * quality.STEP + len(part)
            at += 1
        assert covered == size


def test_quality_gradient_is_that_of_the_loss():
    rng = np.random.default_rng(1)
    data = rng.integers(0, 256, 3_000).astype(np.uint8)
    block = Block(None, data, np.array([0, 300, 1_500, 3_000]))
    labels = np.array([0.0, 1.0, 1.0])
    network = quality.Network(rng.normal(0, 0.3, (quality.WIDTH, 256, quality.FILTERS)), rng.normal(0, 0.5, 2 * quality.FILTERS + 1))
    rows, counts = quality.chunks(block)

    def loss():
        p = quality.block_scores(block, network)
        return -(labels * np.log(p) + (1 - labels) * np.log(1 - p)).mean()

    table_slope, dense_slope = quality.backward(rows, counts, labels, network)
    for array, slope in ((network.table, table_slope), (network.dense, dense_slope)):
        for index in [np.unravel_index(i, array.shape) for i in np.argsort(-np.abs(slope).ravel())[:8]]:
            old = array[index]
            array[index] = old + 1e-6
            up = loss()
            array[index] = old - 1e-6
            down = loss()
            array[index] = old
            assert (up - down) / 2e-6 == pytest.approx(slope[index], rel=2e-2, abs=1e-7)


def test_language_query(spark, tmp_path):
    rng = random.Random(2)
    make = {"en": "the of and to in that was for with".split(), "fr": "le la les des est que qui dans pour".split(), "de": "der die das und ist nicht mit von".split()}
    texts, langs = [], []
    for i in range(240):
        lang = rng.choice(sorted(make))
        texts.append(" ".join(rng.choice(make[lang]) for _ in range(rng.randint(5, 60))))
        langs.append(lang if i % 9 else None)
    texts += [None, "", "123 !!", "...\n", "日本", " ".join(make["en"] * 8 + make["fr"] * 4)]
    truth = langs + [None] * 6
    folder = write(spark, tmp_path, documents=table(spark, texts, ["1 AS key", "'x' AS lang_pred", "2 AS score"], langs=truth))
    found = rows_of(QUERIES["op10_languages"](spark, folder))
    assert len(found) == len(texts)
    assert all(row["held_out"] == held_out(i, 4, 2) and 0 <= row["score"] <= 1 for i, row in found.items())
    assert sum(found[i]["lang_pred"] == t for i, t in enumerate(truth) if t) > 0.98 * sum(t is not None for t in truth)
    for i in range(240, 244):
        assert (found[i]["lang_pred"], found[i]["score"], found[i]["languages"]) == ("und", 0.0, [])
    assert found[244]["lang_pred"] in make
    shares = {x["lang"]: x["share"] for x in found[245]["languages"]}
    assert set(shares) == {"en", "fr"} and shares["en"] == pytest.approx(2 / 3, abs=0.12)


def test_mixture_climbs_the_likelihood():
    rng = np.random.default_rng(3)
    chances = rng.dirichlet(np.ones(40), 3).astype(np.float32)
    counts = rng.multinomial(500, 0.7 * chances[0] + 0.3 * chances[2], 5).astype(np.float32)
    everything = np.ones((5, 3), bool)
    share, reached = langmix.mixture(counts, chances, everything)
    grid = [np.array([a, b, 1 - a - b]) for a in np.linspace(0.01, 0.98, 40) for b in np.linspace(0.01, 0.98 - a, 20)]
    best = np.max([counts @ np.log(g @ chances) for g in grid], axis=0)
    assert (reached >= best - 3).all() and np.abs(share[:, 0] - 0.7).max() < 0.2
    assert (langmix.select(counts, chances)[:, 1] == 0).all()


def test_empty_tables(spark, tmp_path):
    folder = write(spark, tmp_path, documents=table(spark, []), labels=spark.createDataFrame([], "doc_id long, quality int, toxic int"))
    for name in ("op1_toxicity", "op5_quality", "op10_languages"):
        assert QUERIES[name](spark, folder).count() == 0


def test_without_labels_or_languages(spark, tmp_path):
    folder = write(spark, tmp_path, documents=table(spark, ["a b", None], langs=[None, None]), labels=spark.createDataFrame([], "doc_id long, quality int, toxic int"))
    assert {r["score"] for r in QUERIES["op1_toxicity"](spark, folder).collect()} == {0.5}
    assert {r["score"] for r in QUERIES["op5_quality"](spark, folder).collect()} == {0.5}
    assert {r["lang_pred"] for r in QUERIES["op10_languages"](spark, folder).collect()} == {"und"}


@pytest.mark.parametrize(("name", "label", "least"), [("op1_toxicity", "toxic", 0.9), ("op5_quality", "quality", 0.95)])
def test_held_out_accuracy(spark, name, label, least):
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet").where(F.col(label).isNotNull())
    joined = QUERIES[name](spark, FOLDER).where("held_out").join(labels, "doc_id")
    assert joined.agg(F.avg((F.col("predicted") == F.col(label)).cast("int"))).first()[0] >= least


def test_held_out_languages(spark):
    documents = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "lang")
    joined = QUERIES["op10_languages"](spark, FOLDER).where("held_out").join(documents, "doc_id")
    assert joined.agg(F.avg((F.col("lang_pred") == F.col("lang")).cast("int"))).first()[0] >= 0.97


def test_training_is_repeatable():
    rng = random.Random(1)
    sample = pa.table({"text": [prose(rng, 30) + (" scum" if i % 3 == 0 else "") for i in range(60)], "label": [int(i % 3 == 0) for i in range(60)]})
    a, b = (toxicity.train(sample, toxicity.Settings()) for _ in range(2))
    assert (a.buckets == b.buckets).all() and (a.values == b.values).all()


def test_long_texts_do_not_end_the_sample(spark):
    texts = [f"text {i}" for i in range(40)]
    order = [r["id"] for r in spark.range(40).orderBy(F.xxhash64("id", F.lit(17))).collect()]
    texts[order[0]], texts[order[3]], texts[order[5]] = "x" * 5_000, "y" * 700, "z" * 700
    labels = spark.createDataFrame([(i, 1) for i in range(40)], "doc_id long, toxic int")
    found = [r["text"] for r in bounded_sample(table(spark, texts), labels, "toxic", F.lit(True), 100, 1_200).collect()]
    assert found == [texts[i] for i in order if i not in (order[0], order[5])]
    twice = table(spark, ["same", "same", "other"], ids=[1, 1, 2])
    assert sorted(r["text"] for r in bounded_sample(twice, labels, "toxic", F.lit(True), 100, 100).collect()) == ["other", "same", "same"]
    assert bounded_sample(twice, labels, "toxic", F.lit(True), 100, 9).count() == 2
    assert bounded_sample(table(spark, ["w" * 50]), labels, "toxic", F.lit(True), 100, 8).count() == 0

"""Small document tables for the tests of the text operators."""

import random
import zlib

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"

SYLLABLES = ["th", "er", "on", "an", "re", "he", "in", "ed", "nd", "ha", "at", "en", "es", "of", "or", "é", "ñu"]


def prose(rng: random.Random, words: int) -> str:
    out = ["".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 4))) for _ in range(words)]
    for i in range(0, words, 7):
        out[i] = out[i].capitalize()
    return " ".join(out)


def table(spark, texts, extra=None, **columns):
    """A documents table; ids count from 0 unless given. `extra` is SQL for columns with clashing names."""
    ids = columns.get("ids") or range(len(texts))
    langs = columns.get("langs") or ["en"] * len(texts)
    rows = [(i, t, lang, "src0", None if t is None else len(t)) for i, t, lang in zip(ids, texts, langs, strict=True)]
    frame = spark.createDataFrame(rows, SCHEMA)
    return frame.selectExpr("*", *(extra or []))


def held_out(doc_id, parts, rest):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % parts == rest


def write(spark, tmp_path, **tables):
    for name, frame in tables.items():
        frame.write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def rows_of(frame, key="doc_id"):
    return {row[key]: row for row in frame.collect()}

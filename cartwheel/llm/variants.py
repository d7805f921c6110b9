"""Spelling variants: words that differ by one letter, found through words over a reduced alphabet.

Every letter is hashed to one of `SYMBOLS_USED` symbols. Words that differ by one inserted, deleted or replaced letter have
reduced words that are equal or differ by one edit too, so a word meets all near words where one reduced word is
in the one-edit neighbourhood of the other. Neighbourhoods are full: of two reduced words the longer one makes the shorter by
deletion, and of two of the same length the one with the smaller symbol makes the other by replacement, so each pair is
made once. The neighbourhoods are joined with the reduced vocabulary by a 64-bit code, and every pair of words that meets
is verified by its edit distance on the letters themselves; what codes or symbols confuse costs time and nothing else.

A word's form is its near word of largest n (ties: the smallest), if that n is at least twice the word's own. Following forms
doubles n at each step, so there are no circles, and pointers that are doubled each round reach the last form, the root,
within six rounds.

Scale. Words are counted where they are found, so common words cost one row for each task. A hot reduced word only makes
a hot join key, whose pairs stand in both inputs row by row, and Spark splits it. Words of more than `SHORT` letters
would carry themselves into every neighbour; they meet by number, and only pairs that meet fetch their letters.

Edge cases: a null text has no words, a null id counts as empty text. A vocabulary without near words, or an empty one,
gives no links; words without a near word have null form and are their own root. Equal words are one word. Other columns
are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.blocks import arrow_batches, mixed, powers
from cartwheel.session import stored

MIN_LETTERS, MIN_COUNT, RATIO = 5, 3, 2
SYMBOLS_USED = 4
SHORT = 64
CHUNK = 1 << 16

RUN = r"[A-Za-zÀ-ÿ]"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

# A random odd value for each symbol of the polynomial code.
VALUE = np.random.default_rng(13).integers(1, 1 << 62, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
LENGTH = np.uint64(0xC2B2AE3D27D4EB4F)


def reduced(words: list[str], symbols: int) -> tuple[np.ndarray, np.ndarray]:
    """The symbols of all words behind each other, and where the words begin and end."""
    letters = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    ends = np.cumsum([len(w) for w in words], dtype=np.int64)
    return (mixed(letters + np.uint64(1)) % np.uint64(symbols)).astype(np.int64), np.concatenate([[0], ends])


def codes(raw: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """64-bit codes from polynomial sums, which do not depend on where a word stands, and lengths."""
    return mixed(raw + lengths.astype(np.uint64) * LENGTH).view(np.int64)


def neighbourhoods(words: list[str], symbols: int = SYMBOLS_USED) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(word, code, same) of the reduced words themselves and of those that they make, CHUNK letters at a time.

    `same` marks a word's own code. Deleting any of a run of equal symbols gives one word, which is listed once.
    """
    data, bounds = reduced(words, symbols)
    step, back = powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(VALUE[data] * step[: len(data)], out=sums[1:])
    starts, lengths = bounds[:-1], np.diff(bounds)
    raw = (sums[bounds[1:]] - sums[starts]) * back[starts]
    yield np.arange(len(words)), codes(raw, lengths), np.ones(len(words), bool)
    for lo in range(0, len(data), CHUNK):
        at = np.arange(lo, min(lo + CHUNK, len(data)))
        word = np.searchsorted(bounds, at, "right") - 1
        start, end = bounds[word], bounds[word + 1]
        fresh = (at == start) | (data[at] != data[at - 1])
        i, w, s, e = at[fresh], word[fresh], start[fresh], end[fresh]
        shorter = (sums[i] - sums[s]) * back[s] + (sums[e] - sums[i + 1]) * back[s + 1]
        yield w, codes(shorter, lengths[w] - 1), np.zeros(len(w), bool)
        for symbol in range(1, symbols):
            up = data[at] < symbol
            i, w = at[up], word[up]
            other = raw[w] + (VALUE[symbol] - VALUE[data[i]]) * step[i - start[up]]
            yield w, codes(other, lengths[w]), np.zeros(len(w), bool)


def made(frame: DataFrame, symbols: int, own_only: bool = False) -> DataFrame:
    """All columns of the frame (with a column word) for each code of the word; `same` marks its own."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            for word, code, same in neighbourhoods(batch.column("word").to_pylist(), symbols):
                columns = [c.take(pa.array(word)) for c in batch.select(kept).columns]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(code), pa.array(same)], names=[*kept, "code", "same"])
                if own_only:
                    break

    kept = [c for c in frame.columns if c != "word" or "number" not in frame.columns]
    schema = ", ".join(f"{c} {frame.schema[c].dataType.simpleString()}" for c in kept)
    return frame.mapInArrow(rows, f"{schema}, code long, same boolean")


def near_pairs(vocabulary: DataFrame, symbols: int = SYMBOLS_USED, short: int = SHORT) -> DataFrame:
    """(a, n_a, b, n_b): every pair of different words at edit distance 1, once; `vocabulary` is (word, n)."""
    arrow_batches(vocabulary.sparkSession)
    words = vocabulary.select("word", "n", F.length("word").alias("letters"))

    def met(left: DataFrame, right: DataFrame, carried: list[str], verified: Column | None = None) -> DataFrame:
        a = made(left, symbols).select(*[F.col(c).alias(f"{c}_a") for c in carried], "code", "same")
        own = made(right, symbols, own_only=True)
        b = own.select(*[F.col(c).alias(f"{c}_b") for c in carried], F.col("code").alias("_code"))
        once = ~F.col("same") | (F.col(f"{carried[0]}_a") < F.col(f"{carried[0]}_b"))
        on = (F.col("code") == F.col("_code")) & once
        return a.join(b, on if verified is None else on & verified)

    one_edit = F.levenshtein("word_a", "word_b", 1) == 1
    few = words.where(F.col("letters") <= short).select("word", "n")
    pairs = met(few, few, ["word", "n"], one_edit).select(F.col("word_a").alias("a"), "n_a", F.col("word_b").alias("b"), "n_b")

    # Long words by number. Their partners may be short by one letter.
    rest = stored(
        words.where(F.col("letters") >= short).select("word", "n", "letters").withColumn("number", F.monotonically_increasing_id()), "long-words"
    )
    longer = rest.where(F.col("letters") > short).select("word", "number")
    numbers = met(longer, rest.select("word", "number"), ["number"]).select("number_a", "number_b")
    named = numbers
    for side in ("a", "b"):
        own = rest.select(F.col("number").alias(f"number_{side}"), F.col("word").alias(f"word_{side}"), F.col("n").alias(f"n_{side}"))
        named = named.join(own, f"number_{side}")
    long_pairs = named.where(one_edit).select(F.col("word_a").alias("a"), "n_a", F.col("word_b").alias("b"), "n_b")
    return pairs.unionByName(long_pairs)


def forms(vocabulary: DataFrame, pairs: DataFrame, ratio: int = RATIO) -> DataFrame:
    """(word, n, n_near, form, form_n) of every word."""
    side = lambda word, n, other, m: F.struct(F.col(word).alias("word"), F.col(n).alias("n"), F.struct((-F.col(m)).alias("m"), F.col(other).alias("w")).alias("near"))
    both = pairs.select(F.inline(F.array(side("a", "n_a", "b", "n_b"), side("b", "n_b", "a", "n_a"))))
    best = both.groupBy("word").agg(F.count("*").alias("n_near"), F.min("near").alias("best"))
    taken = -F.col("best.m") >= ratio * F.col("n")
    return vocabulary.select("word", "n").join(best, "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(taken, F.col("best.w")).alias("form"),
        F.when(taken, -F.col("best.m")).alias("form_n"),
    )


def rooted(found: DataFrame) -> DataFrame:
    """Adds root, the last form on the way from each word; `found` is stored."""
    links = found.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    while True:
        further = links.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        links = stored(
            links.join(further, "root", "left").select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("_moved")),
            "roots",
        )
        if links.where("_moved").isEmpty():
            break
        links = links.drop("_moved")
    return found.join(links.select("word", "root"), "word", "left").withColumn("root", F.coalesce("root", "word"))


def grouped(vocabulary: DataFrame, ratio: int = RATIO, symbols: int = SYMBOLS_USED) -> DataFrame:
    """(word, n, n_near, form, form_n, root) for a vocabulary (word, n) of distinct words."""
    words = stored(vocabulary.select("word", "n"), "vocabulary")
    return rooted(stored(forms(words, near_pairs(words, symbols), ratio), "forms"))


def counted(words: DataFrame, min_letters: int = MIN_LETTERS, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n): the vocabulary of a column word."""
    return words.where(F.length("word") >= min_letters).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= min_count)


def runs(documents: DataFrame, min_letters: int = 1, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, word): every maximal run of at least so many letters, A-Z in lower case."""
    found = F.regexp_extract_all(F.col(text), F.lit(f"{RUN}{{{min_letters},}}"), F.lit(0))
    return documents.select(F.col(key).alias("key"), F.explode(found).alias("word")).withColumn(
        "word", F.translate("word", CAPITALS, CAPITALS.lower())
    )


def misspelt(words: DataFrame, every: int = 97) -> DataFrame:
    """The words (key, word) with one letter less where the crc32 of `key:word` is divisible by `every`."""
    number = F.crc32(F.concat(F.coalesce(F.col("key").cast("string"), F.lit("")), F.lit(":"), F.col("word")).cast("binary"))
    at = (F.col("_h") % F.length("word")).cast("int")
    cut = F.concat(F.substring("word", F.lit(1), at), F.substring(F.col("word"), at + 2, F.length("word")))
    return words.withColumn("_h", number).select("key", F.when(F.col("_h") % every == 0, cut).otherwise(F.col("word")).alias("word"))

"""License scans with a positional index of rare tokens.

The templates are phrases of licence notices, each with a mandatory key phrase. A word's postings name the
templates whose key it stands in, and its place there. A file looks up its own rarest licence words: of
every few words in a row that all stand in keys (as many as the shortest key has) the one of highest
inverse document frequency, counted over all documents. So every place of a key has a word that is looked
up. Postings of the words looked up are intersected by relative position, each candidate coming from the first such
word in its span; then the key has to stand there whole, and enough of its template's weight around
it. Templates that share no rare word with a file cost nothing there. A phrase whose key is all of it is found
at every place where it stands.

Words are runs of letters, digits and bytes outside ASCII, A-Z in lower case, and are compared by a
64-bit hash. Edge cases: a null text counts as empty and has no words; a table without documents gives
the same frequency to every word. Ties among equally rare words go to the earlier word of the file. A key that
stands in its template more than once is placed where it stands first. Overlapping places are all reported.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.blocks import LOWER, WORD, Block, Hasher, arrow_batches, blocks, hash_bytes, runs, with_fields

CANDIDATES = 1 << 18  # postings that are intersected at once
COVERAGE = 0.6

PLACE = "struct<label: string, template: int, word: bigint, coverage: double, base: boolean>"
PLACE_TYPE = pa.list_(
    pa.struct([("label", pa.string()), ("template", pa.int32()), ("word", pa.int64()), ("coverage", pa.float64()), ("base", pa.bool_())])
)


@dataclass(frozen=True)
class Template:
    label: str
    phrase: str
    key: str
    base: bool = False

    @property
    def words(self) -> list[str]:
        return self.phrase.split()


# The base phrases, whose key is the whole phrase.
BASE = [
    Template("mit", "under the mit license", "under the mit license", True),
    Template("apache-2", "apache license version 2", "apache license version 2", True),
    Template("cc-by-nc", "cc by nc", "cc by nc", True),
]

# Opening words of well-known licence notices.
NOTICES = [
    Template("gpl-3", "licensed under the gnu general public license version 3", "general public license version 3"),
    Template("gpl-2", "licensed under the gnu general public license version 2", "general public license version 2"),
    Template("lgpl", "under the terms of the gnu lesser general public license", "gnu lesser general public license"),
    Template("agpl-3", "under the terms of the gnu affero general public license", "gnu affero general public license"),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software", "permission is hereby granted free of charge"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted", "redistribution and use in source and binary forms"),
    Template("mpl-2", "subject to the terms of the mozilla public license v 2 0", "mozilla public license v 2"),
    Template("unlicense", "this is free and unencumbered software released into the public domain", "free and unencumbered software"),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee", "copy modify and or distribute this software"),
    Template("apache-2", "you may not use this file except in compliance with the license", "except in compliance with the license"),
    Template("cc-by-sa", "creative commons attribution sharealike 4 0 international license", "commons attribution sharealike"),
    Template("cc-by-nc", "creative commons attribution noncommercial 4 0 international license", "commons attribution noncommercial"),
    Template("cc0", "creative commons zero public domain dedication", "creative commons zero"),
]
TEMPLATES = [*BASE, *NOTICES]


class Index:
    """Templates as numbers of words, and the postings of the words in their keys."""

    def __init__(self, templates: list[Template], texts: int, frequency: dict[str, int]):
        self.templates = templates
        self.vocabulary = vocabulary(templates)
        number = {w: i for i, w in enumerate(self.vocabulary)}
        hashes = hash_bytes([w.encode() for w in self.vocabulary])
        self.order = np.argsort(hashes)
        self.hashes = hashes[self.order]
        # The last entry is that of words in no template, whose number is -1.
        self.idf = np.array([*(np.log((texts + 1) / (frequency.get(w, 0) + 1)) + 1 for w in self.vocabulary), 0.0])
        words = [[number[w] for w in t.words] for t in templates]
        keys = [[number[w] for w in t.key.split()] for t in templates]
        self.lead = np.array([next(i for i in range(len(w)) if w[i : i + len(k)] == k) for w, k in zip(words, keys, strict=True)], np.int64)
        self.words, self.first, self.size = flattened(words)
        self.keys, self.key_first, self.key_size = flattened(keys)
        self.window = int(self.key_size.min(initial=1 << 20))
        # Postings: of every word the templates and places of the keys, one word after the other.
        by_word = np.argsort(self.keys, kind="stable")
        self.template = np.repeat(np.arange(len(keys)), self.key_size)[by_word]
        self.place = by_word - self.key_first[self.template]
        self.many = np.append(np.bincount(self.keys, minlength=len(self.vocabulary)), 0)
        self.begin = np.cumsum(self.many) - self.many

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """The number of each word in the vocabulary, or -1."""
        if not len(self.hashes):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, self.order[at], -1)

    def looked_up(self, word: np.ndarray, text: np.ndarray) -> np.ndarray:
        """Places of the rarest word in every stretch of words that could be a key, ascending."""
        last = len(word) - self.window + 1
        if last < 1:
            return np.zeros(0, np.int64)
        posted = self.many[word] > 0
        whole = text[:last] == text[self.window - 1 :]
        for i in range(self.window):
            whole &= posted[i : i + last]
        start = np.flatnonzero(whole)
        rarest, most = start.copy(), self.idf[word[start]]
        for i in range(1, self.window):
            own = self.idf[word[start + i]]
            rarer = own > most
            rarest[rarer], most[rarer] = start[rarer] + i, own[rarer]
        return np.unique(rarest)

    def places(self, word: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Template, first word of the key and coverage of all places by text, template and word, given number and text of every word."""
        rare = self.looked_up(word, text)
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
        ends, first = np.cumsum(self.many[word[rare]]), 0
        while first < len(rare):
            done = int(ends[first - 1]) if first else 0
            last = max(first + 1, int(np.searchsorted(ends, done + CANDIDATES, "right")))
            found.append(self.verified(word, text, *self.intersected(word, text, rare, first, last)))
            first = last
        template, start, coverage = (np.concatenate(x) for x in zip(*found, strict=True))
        order = np.lexsort((start, template, text[start]))
        return template[order], start[order], coverage[order]

    def intersected(self, word: np.ndarray, text: np.ndarray, rare: np.ndarray, first: int, last: int) -> tuple[np.ndarray, np.ndarray]:
        """Template and first word of the keys that may stand around the words looked up, each at its first one."""
        own = np.repeat(np.arange(first, last), self.many[word[rare[first:last]]])
        posting = spans(self.begin[word[rare[first:last]]], self.many[word[rare[first:last]]])
        template = self.template[posting]
        start = rare[own] - self.place[posting]
        end = start + self.key_size[template]
        before = np.where(own > 0, rare[own - 1], -1)
        good = np.flatnonzero((before < start) & (start >= 0) & (end <= len(word)))
        template, start, end = template[good], start[good], end[good]
        # The last word looked up in the span has to have the posting that fits.
        at = rare[np.searchsorted(rare, end) - 1]
        good = (text[start] == text[end - 1]) & (self.keys[self.key_first[template] + at - start] == word[at])
        return template[good], start[good]

    def verified(self, word: np.ndarray, text: np.ndarray, template: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The candidates whose key stands there whole, with enough of the template in the same text."""
        size = self.key_size[template]
        equal = word[spans(start, size)] == self.keys[spans(self.key_first[template], size)]
        good = np.logical_and.reduceat(equal, np.cumsum(size) - size) if len(size) else np.zeros(0, bool)
        template, start = template[good], start[good]
        if not len(start):
            return template, start, np.zeros(0)
        size = self.size[template]
        own = self.words[spans(self.first[template], size)]
        at = spans(start - self.lead[template], size)
        inside = (at >= 0) & (at < len(word))
        at = np.where(inside, at, 0)
        equal = inside & (word[at] == own) & (text[at] == np.repeat(text[start], size))
        cuts = np.cumsum(size) - size
        coverage = np.add.reduceat(equal * self.idf[own], cuts) / np.add.reduceat(self.idf[own], cuts)
        good = coverage >= COVERAGE
        return template[good], start[good], coverage[good]


def flattened(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All lists one after the other, where each begins, and their sizes."""
    size = np.array([len(x) for x in lists], np.int64)
    return np.array([i for x in lists for i in x], np.int64), np.cumsum(size) - size, size


def spans(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The numbers from begin on, so many of each, one after the other."""
    ends = np.cumsum(size)
    return np.repeat(begin - ends + size, size) + np.arange(ends[-1] if len(ends) else 0)


def vocabulary(templates: list[Template]) -> list[str]:
    return sorted({w for t in templates for w in t.words})


def words_of(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text of every word."""
    starts, ends, text = runs(WORD, block)
    return Hasher(LOWER[block.data]).spans(starts, ends), text


def build_index(documents: DataFrame, templates: list[Template] = TEMPLATES, text: str = "text") -> Index:
    """Count in how many documents each licence word occurs, and index the templates by the rarest."""
    arrow_batches(documents.sparkSession)
    names = vocabulary(templates)
    plain = Index(templates, 0, {})

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, total = 0, np.zeros(len(names), np.int64)
        for block in blocks(batches):
            hashes, owner = words_of(block)
            number = plain.numbers(hashes)
            known = number >= 0
            pairs = np.unique(owner[known] * len(names) + number[known])
            total += np.bincount(pairs % len(names), minlength=len(names))
            texts += block.size
        yield pa.record_batch({"word": ["", *names], "n": pa.array([texts, *total.tolist()], pa.int64())})

    parts = documents.select(F.col(text).alias("text")).mapInArrow(counted, "word string, n long")
    counts = {row["word"]: row["n"] for row in parts.groupBy("word").agg(F.sum("n").alias("n")).collect()}
    return Index(templates, counts.pop("", 0), counts)


def scan(documents: DataFrame, index: Index, text: str = "text") -> DataFrame:
    """All columns of the documents, `n_words`, and `licenses`: every place where a template stands.

    A place has the label, the template's number, the first word of its key, the share of the template's
    weight that stands there, and whether it is a base phrase.
    """
    documents = documents.drop("n_words", "licenses")
    arrow_batches(documents.sparkSession)
    shipped = documents.sparkSession.sparkContext.broadcast(index)

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shipped.value
        labels = np.array([t.label for t in known.templates], object)
        base = np.array([t.base for t in known.templates], bool)
        for block in blocks(batches, text):
            hashes, owner = words_of(block)
            counts = np.bincount(owner, minlength=block.size)
            first = np.cumsum(counts) - counts
            template, start, coverage = known.places(known.numbers(hashes), owner)
            text_of = owner[start]
            columns = [
                pa.array(labels[template], pa.string()),
                pa.array(template, pa.int32()),
                pa.array(start - first[text_of], pa.int64()),
                pa.array(coverage, pa.float64()),
                pa.array(base[template], pa.bool_()),
            ]
            ends = np.searchsorted(text_of, np.arange(block.size + 1)).astype(np.int32)
            places = pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays(columns, fields=list(PLACE_TYPE.value_type)))
            rows = block.rows.append_column("n_words", pa.array(counts, pa.int64()))
            yield rows.append_column("licenses", places)

    return documents.mapInArrow(scanned, with_fields(documents, f"n_words long, licenses array<{PLACE}>"))


def digest(scanned: DataFrame, key: str = "doc_id") -> DataFrame:
    """Base places, labels and the best coverage of each document."""
    base = F.filter("licenses", lambda x: x["base"])
    label = lambda places: F.array_join(F.array_sort(F.array_distinct(F.transform(places, lambda x: x["label"]))), ",")
    word = F.transform(base, lambda x: x["word"])
    return scanned.select(
        key,
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(word).alias("first_word"),
        F.array_max(word).alias("last_word"),
        label(base).alias("base_labels"),
        label(F.col("licenses")).alias("labels"),
        F.coalesce(F.array_max(F.transform("licenses", lambda x: F.least(x["coverage"], F.lit(1.0)))), F.lit(0.0)).alias("score"),
    )

"""Benchmark decontamination by pigeonhole edit matching.

Texts are compared as words in lower case with one space between (everything that is no ASCII letter or digit
nor outside ASCII separates). An item of n bytes may differ by k = RATE * n edits. Cut into k + 1 pieces, at
least one piece of every such occurrence is unchanged; an automaton over all pieces finds those
places, and Myers' bit-parallel distance decides on the text around each. An item of fewer than MIN_BYTES
bytes has no budget: it is found where it stands as whole words.

The benchmark reaches the tasks in blocks of about ITEM_BYTES. A task passes its documents through all
blocks, HELD_BYTES of text at a time, with one automaton alive at once and without a shuffle. Beyond
SHIPPED_BYTES of benchmark the found leaks are stored in between, so that no more than this is shipped to a task.

Edge cases: null and empty texts never match, nor do null items or those without a word. Equal items are all
reported. An empty benchmark keeps every document. Other columns are passed on; the ids of items keep their type, which
has to have an order. Case is folded in all scripts, but for the few letters (such as the dotted capital I) whose
lower case has another number of bytes.
"""

from __future__ import annotations

import uuid
from collections import defaultdict
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DataType

from cartwheel.llm.blocks import LOWER, WORD, Block, arrow_batches, blocks, with_fields
from cartwheel.session import stored

RATE = 0.05
MIN_BYTES = 24
ITEM_BYTES = 4 << 20
HELD_BYTES = 32 << 20
SHIPPED_BYTES = 64 << 20


def leak(item_id: DataType) -> str:
    return f"struct<item_id: {item_id.simpleString()}, errors: int, first_byte: bigint, end_byte: bigint>"


def leak_type(item_id: DataType) -> pa.DataType:
    own = [("item_id", to_arrow_type(item_id)), ("errors", pa.int32()), ("first_byte", pa.int64()), ("end_byte", pa.int64())]
    return pa.list_(pa.struct(own))


def folded_letters() -> np.ndarray:
    """For every code point of two to four bytes that of its folded letter, if this has as many bytes; else itself."""
    table = np.arange(1 << 17, dtype=np.int32)
    for code in range(128, len(table)):
        letter = chr(code)
        for other in (letter.casefold(), letter.lower()):
            if other != letter and len(other) == 1 and len(other.encode()) == len(letter.encode()):
                table[code] = ord(other)
                break
    return table


FOLDED = folded_letters()


def leads(size: int) -> np.ndarray:
    """Which first bytes of letters of so many bytes lead to any that is folded."""
    codes = np.flatnonzero(FOLDED != np.arange(len(FOLDED)))
    own = [c for c in map(chr, codes.tolist()) if len(c.encode()) == size]
    table = np.zeros(256, bool)
    table[[c.encode()[0] for c in own]] = True
    return table


LEADS = {size: leads(size) for size in (2, 3, 4)}


def folded(data: np.ndarray) -> np.ndarray:
    """Lower case for the letters of all scripts, with every byte in its place."""
    low = LOWER[data]
    for size, table in LEADS.items():
        at = np.flatnonzero(table[data[: max(0, len(data) - size + 1)]])
        code = data[at].astype(np.int32) & (0x7F >> size)
        whole = np.ones(len(at), bool)
        for i in range(1, size):
            own = data[at + i]
            whole &= (own & 0xC0) == 0x80
            code = (code << 6) | (own & 0x3F)
        whole &= code < len(FOLDED)
        at, code = at[whole], FOLDED[code[whole]]
        for i in range(size - 1, 0, -1):
            low[at + i] = 0x80 | (code & 0x3F)
            code >>= 6
        low[at] = (0xF00 >> size) & 0xFF | code
    return low


def normalised(block: Block) -> tuple[str, np.ndarray, np.ndarray]:
    """The words of all texts with a space after each, as one character per byte.

    Also the bounds of the texts in it, and the place of each of its bytes in the block.
    """
    word = WORD[block.data]
    kept = word.copy()
    kept[1:] |= word[:-1]
    first = block.bounds[:-1][(block.bounds[:-1] < len(word)) & (np.diff(block.bounds) > 0)]
    kept[first] = word[first]
    places = np.flatnonzero(kept)
    data = np.where(word, folded(block.data), 32)[places].astype(np.uint8)
    return data.tobytes().decode("latin-1"), np.searchsorted(places, block.bounds), places


def plain(text: str) -> str:
    """An item in the form of `normalised`, without the space at its end."""
    data = np.frombuffer(text.encode(), np.uint8)
    return normalised(Block(None, data, np.array([0, len(data)])))[0].rstrip(" ")


class Pattern:
    """An item's bit masks for Myers' distance, forwards and backwards."""

    def __init__(self, item_id: int, text: str, rate: float):
        self.item_id, self.text, self.size = item_id, text, len(text)
        self.short = len(text) < MIN_BYTES
        self.budget = 0 if self.short else int(rate * len(text))
        self.masks = self.bits(text)
        self.reverse: dict[str, int] | None = None

    @staticmethod
    def bits(text: str) -> dict[str, int]:
        masks: dict[str, int] = defaultdict(int)
        for i, c in enumerate(text):
            masks[c] |= 1 << i
        return dict(masks)

    def pieces(self) -> Iterator[tuple[int, str]]:
        """Offset and text of the budget + 1 pieces."""
        cuts = [i * self.size // (self.budget + 1) for i in range(self.budget + 2)]
        for a, b in zip(cuts, cuts[1:]):
            yield a, self.text[a:b]

    def find(self, text: str) -> tuple[int, int, int] | None:
        """Errors, start and end of the best occurrence within the budget, the first of equals."""
        errors, end = best(self.masks, self.size, text, anchored=False)
        if errors > self.budget:
            return None
        self.reverse = self.reverse or self.bits(self.text[::-1])
        _, length = best(self.reverse, self.size, text[max(0, end - self.size - self.budget) : end][::-1], anchored=True)
        return errors, end - length, end


def best(masks: dict[str, int], size: int, text: str, anchored: bool) -> tuple[int, int]:
    """The least edit distance of the pattern to a stretch of the text, and where the stretch ends.

    The stretch begins anywhere, or if anchored at the beginning of the text.
    """
    full, high = (1 << size) - 1, 1 << (size - 1)
    up, down, score = full, 0, size
    least, end = size, 0
    for i, c in enumerate(text, 1):
        equal = masks.get(c, 0)
        vertical = equal | down
        across = (((equal & up) + up) ^ up) | equal
        rise, fall = down | (full & ~(across | up)), up & across
        if rise & high:
            score += 1
        elif fall & high:
            score -= 1
        rise, fall = ((rise << 1) | anchored) & full, (fall << 1) & full
        up, down = fall | (full & ~(vertical | rise)), rise & vertical
        if score < least:
            least, end = score, i
    return least, end


class Matcher:
    """The automaton over the pieces of a block of items."""

    def __init__(self, items: list[tuple[int, str]], rate: float):
        self.patterns = [Pattern(i, t, rate) for i, t in items]
        pieces: dict[str, list[tuple[int, int]]] = defaultdict(list)
        for number, pattern in enumerate(self.patterns):
            for offset, piece in pattern.pieces():
                pieces[piece].append((number, offset))
        self.automaton = ahocorasick.Automaton()
        for piece, owners in pieces.items():
            self.automaton.add_word(piece, (len(piece), owners))
        self.automaton.make_automaton()

    def leaks(self, block: Block) -> list[list[dict]]:
        """The items found in each text, with errors and the span in the text's bytes."""
        text, bounds, places = normalised(block)
        found: list[list[dict]] = []
        for number in range(block.size):
            first, last = int(bounds[number]), int(bounds[number + 1])
            shifts: dict[int, set[int]] = defaultdict(set)
            for end, (length, owners) in self.automaton.iter(text, first, last):
                for owner, offset in owners:
                    shifts[owner].add(end + 1 - length - offset)
            own = []
            for owner in sorted(shifts):
                hit = self.verified(self.patterns[owner], sorted(shifts[owner]), text, first, last)
                if hit:
                    errors, a, b = hit
                    base = int(block.bounds[number])
                    own.append(
                        {
                            "item_id": self.patterns[owner].item_id,
                            "errors": errors,
                            "first_byte": int(places[a]) - base,
                            "end_byte": int(places[b - 1]) + 1 - base,
                        }
                    )
            found.append(own)
        return found

    @staticmethod
    def verified(pattern: Pattern, shifts: list[int], text: str, first: int, last: int) -> tuple[int, int, int] | None:
        """The best occurrence near any of the shifts; shifts closer than the budget share a window."""
        if pattern.short:
            return whole_words(pattern.size, shifts, text, first, last)
        best_hit, k = None, pattern.budget
        i = 0
        while i < len(shifts):
            j = i
            while j + 1 < len(shifts) and shifts[j + 1] - shifts[j] <= k:
                j += 1
            a, b = max(first, shifts[i] - k), min(last, shifts[j] + pattern.size + k)
            hit = pattern.find(text[a:b])
            if hit and (best_hit is None or hit[0] < best_hit[0]):
                best_hit = (hit[0], a + hit[1], a + hit[2])
                if not hit[0]:
                    return best_hit
            i = j + 1
        return best_hit


def whole_words(size: int, places: list[int], text: str, first: int, last: int) -> tuple[int, int, int] | None:
    """The first of the places that begins and ends with a word."""
    for a in places:
        if (a == first or text[a - 1] == " ") and (a + size == last or text[a + size] == " "):
            return 0, a, a + size
    return None


def item_blocks(benchmark: DataFrame, item: str, text: str) -> Iterator[list[tuple[int, str]]]:
    """The items with any word in blocks of about ITEM_BYTES, each of them small enough for driver and tasks."""
    known = benchmark.where(F.col(item).isNotNull() & F.col(text).isNotNull()).select(F.col(item).alias("i"), F.col(text).alias("t"))
    total = known.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    parts = -(-total // ITEM_BYTES)
    for part in range(parts):
        own = known.where(F.pmod(F.xxhash64("i", "t"), F.lit(parts)) == part) if parts > 1 else known
        items = sorted((row["i"], plain(row["t"])) for row in own.toLocalIterator())
        items = [x for x in items if x[1]]
        if items:
            yield items


def leaks(documents: DataFrame, benchmark: DataFrame, rate: float = RATE, text: str = "text", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """All columns of the documents and `leaks`: for each item found its errors and span in the text's bytes."""
    documents = documents.drop("leaks")
    arrow_batches(documents.sparkSession)
    kind = benchmark.schema[item].dataType
    column = f"leaks array<{leak(kind)}>"
    out, held, size = documents.withColumn("leaks", F.array().cast(column.split(" ", 1)[1])), [], 0
    first = True

    def passed(out: DataFrame) -> DataFrame:
        if first:
            return documents.mapInArrow(searcher(held, rate, text, "leaks", leak_type(kind)), with_fields(documents, column))
        more, done = f"leaks_{uuid.uuid4().hex[:8]}", stored(out, "leaks")
        found = done.mapInArrow(searcher(held, rate, text, more, leak_type(kind)), with_fields(done, column.replace("leaks", more, 1)))
        return found.withColumn("leaks", F.concat("leaks", more)).drop(more)

    for items in item_blocks(benchmark, item, item_text):
        held.append(documents.sparkSession.sparkContext.broadcast(items))
        size += sum(len(t) for _, t in items)
        if size >= SHIPPED_BYTES:
            out, first, held, size = passed(out), False, [], 0
    return passed(out) if held else out


def searcher(shipped: list, rate: float, text: str, column: str, kind: pa.DataType):
    """Adds the leaks of all shipped blocks of items as a column."""

    def answered(block: Block, found: list[list[dict]]) -> pa.RecordBatch:
        return block.rows.append_column(column, pa.array(found, kind))

    def through(held: list[Block]) -> Iterator[pa.RecordBatch]:
        found: list[list[list[dict]]] = [[[] for _ in range(block.size)] for block in held]
        for items in shipped if held else []:
            matcher = Matcher(items.value, rate)
            for block, own in zip(held, found, strict=True):
                for known, new in zip(own, matcher.leaks(block), strict=True):
                    known += new
        yield from map(answered, held, found)

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if len(shipped) == 1:
            matcher = None
            for block in blocks(batches, text):
                matcher = matcher or Matcher(shipped[0].value, rate)
                yield answered(block, matcher.leaks(block))
            return
        held, size = [], 0
        for block in blocks(batches, text):
            held.append(block)
            size += len(block.data)
            if size >= HELD_BYTES:
                yield from through(held)
                held, size = [], 0
        yield from through(held)

    return searched


def without_leaks(documents: DataFrame, benchmark: DataFrame, rate: float = RATE) -> DataFrame:
    """The documents that hold no item, with their columns."""
    return leaks(documents, benchmark, rate).where(F.size("leaks") == 0).select(*documents.columns)

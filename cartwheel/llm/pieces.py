"""SentencePiece encoding and decoding with the N best segmentations, and token counts.

`encode` finds the best ids of a whole text and the next best segmentations of it. Pre-tokens are
independent, so the N best differ from the best one in the N - 1 pre-tokens whose least possible loss is
smallest; the forward pass knows that loss for all of them, and the A-star search runs on those alone.
`decode` spells ids out again. `count` needs only the number of pieces at each terminal of the trie.

Edge cases: a null text has null ids and counts 0 tokens; an empty one has no ids, score 0, and no other
segmentation. Text with characters outside the vocabulary, white space of any kind and the word mark
itself come back unchanged, by bytes. Unknown ids and control ids decode to nothing, bytes that are no
UTF-8 to replacement characters. A segmentation that does not exist is left out of `nbest`.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame

from cartwheel.llm.blocks import BLOCK_BYTES, arrow_batches, blocks, with_fields
from cartwheel.llm.lattice import Tokens, Vocabulary, best_ids, best_paths, spread, tokens, with_spaces

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
N = 4
ENCODED_BYTES = 1 << 19  # of text in a block that is encoded: its trie and ways take many times as much
KEPT = 20_000  # searched pre-tokens that a task remembers
KEPT_BYTES = 200  # of the longest of these

WAYS = "array<struct<score: double, edits: array<struct<at: int, drop: int, ids: array<int>>>>>"
ENCODED = f"ids array<int>, score double, nbest {WAYS}"
DECODED = "decoded string"
EDIT_TYPE = pa.struct([("at", pa.int32()), ("drop", pa.int32()), ("ids", pa.list_(pa.int32()))])
WAYS_TYPE = pa.list_(pa.struct([("score", pa.float64()), ("edits", pa.list_(EDIT_TYPE))]))


def loosest(found: Tokens, slack: np.ndarray, many: int) -> list[np.ndarray]:
    """For every text the occurrences with the least slack, at most so many, the least first."""
    slack = slack.copy()
    filled = np.flatnonzero(np.diff(found.at))
    owner_first = found.at[filled]
    owner = np.repeat(np.arange(len(filled)), np.diff(found.at)[filled])
    chosen: list[list[int]] = [[] for _ in range(len(found.at) - 1)]
    for _ in range(many):
        if not len(slack):
            break
        least = np.minimum.reduceat(slack, owner_first)
        hits = np.flatnonzero((slack == least[owner]) & np.isfinite(slack))
        texts, first = np.unique(owner[hits], return_index=True)
        for text, hit in zip(filled[texts].tolist(), hits[first].tolist(), strict=True):
            chosen[text].append(hit)
        slack[hits[first]] = np.inf
    return chosen


def other_ways(
    found: Tokens, counts: np.ndarray, scores: np.ndarray, vocabulary: Vocabulary, n: int, known: dict[bytes, list]
) -> list[list[dict]]:
    """The second to n-th best segmentations of every text, as edits of the best one."""
    forward = found.forward
    token_at = np.concatenate([[0], np.cumsum(counts)])
    out = []
    for text, own in enumerate(loosest(found, forward.slack[found.terminal][found.kind], n - 1)):
        ways: list[tuple[float, list[dict]]] = [(0.0, [])]
        for hit in own:
            spelled = found.spelled(int(found.kind[hit]))
            paths = known.get(spelled)
            if paths is None:
                paths = best_paths(spelled, vocabulary, n)
                if len(spelled) <= KEPT_BYTES:
                    if len(known) >= KEPT:
                        known.clear()
                    known[spelled] = paths
            at, drop = int(token_at[hit] - token_at[found.at[text]]), int(counts[hit])
            choices = [(0.0, [])]
            choices += [(paths[0][0] - score, [{"at": at, "drop": drop, "ids": list(ids)}]) for score, ids in paths[1:]]
            ways = sorted(((a + b, x + y) for a, x in ways for b, y in choices), key=lambda w: w[0])[:n]
        out.append([{"score": float(scores[text]) - loss, "edits": sorted(edits, key=lambda e: e["at"])} for loss, edits in ways[1:]])
    return out


def encoding(shipped: Broadcast[Vocabulary], n: int, text: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """What a task of `encode` does."""

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, known = shipped.value, {}
        for block in blocks(batches, text, ENCODED_BYTES):
            found = tokens(with_spaces(block), own)
            flat, bounds = best_ids(found)
            ids, occurrence = spread(flat, bounds, found.kind)
            rows = occurrence[found.at].astype(np.int32)
            counts = np.diff(occurrence)
            sums = np.concatenate([[0], np.cumsum(found.forward.score[found.terminal][found.kind])])
            scores = sums[found.at[1:]] - sums[found.at[:-1]]
            ways = other_ways(found, counts, scores, own, n, known)
            missing = np.array(block.rows.column(block.rows.schema.get_field_index(text)).is_null())
            lists = pa.ListArray.from_arrays(pa.array(rows), pa.array(ids), mask=pa.array(missing)) if missing.any() else pa.ListArray.from_arrays(pa.array(rows), pa.array(ids))
            out = block.rows.append_column("ids", lists)
            out = out.append_column("score", pa.array(scores, pa.float64()))
            yield out.append_column("nbest", pa.array(ways, WAYS_TYPE))

    return encoded


def encode(documents: DataFrame, vocabulary: Vocabulary, n: int = N, text: str = "text") -> DataFrame:
    """All columns of the documents, `ids`, their `score`, and `nbest`: the next n - 1 segmentations.

    Each of these has a score and edits of the ids: `drop` of them from `at` on give way to others.
    """
    documents = documents.drop("ids", "score", "nbest")
    arrow_batches(documents.sparkSession)
    shipped = documents.sparkSession.sparkContext.broadcast(vocabulary)
    return documents.mapInArrow(encoding(shipped, n, text), with_fields(documents, ENCODED))


def spell(ids: np.ndarray, bounds: np.ndarray, vocabulary: Vocabulary) -> list[str]:
    """The texts of lists of ids, without the space that encoding puts first."""
    letters, at = vocabulary.spelled
    known = np.where((ids >= 0) & (ids < len(at) - 1), ids, 0)
    data, ends = spread(letters, at, known)
    out = []
    for a, b in zip(ends[bounds[:-1]], ends[bounds[1:]], strict=True):
        own = data[a:b].tobytes()
        out.append((own[1:] if own[:1] == b" " else own).decode(errors="replace"))
    return out


def decoding(shipped: Broadcast[Vocabulary], ids: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """What a task of `decode` does."""

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shipped.value
        for batch in batches:
            lists = batch.column(batch.schema.get_field_index(ids))
            if pa.types.is_large_list(lists.type):
                lists = lists.cast(pa.list_(pa.int32()))
            offsets, values = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False)
            first = 0
            while first < len(lists):
                last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + BLOCK_BYTES // 4, "right")) - 1)
                part = batch.slice(first, last - first)
                bounds = offsets[first : last + 1].astype(np.int64) - offsets[first]
                texts = spell(values[offsets[first] : offsets[last]], bounds, own)
                missing = np.array(lists.slice(first, last - first).is_null())
                yield part.append_column("decoded", pa.array(texts, pa.string(), mask=missing))
                first = last

    return decoded


def decode(encoded: DataFrame, vocabulary: Vocabulary, ids: str = "ids") -> DataFrame:
    """All columns, and the text of the ids as `decoded`."""
    encoded = encoded.drop("decoded")
    shipped = encoded.sparkSession.sparkContext.broadcast(vocabulary)
    return encoded.mapInArrow(decoding(shipped, ids), with_fields(encoded, DECODED))


def encode_and_decode(documents: DataFrame, vocabulary: Vocabulary, n: int = N, text: str = "text") -> DataFrame:
    """What `decode` gives for the rows of `encode`, by the same steps in one task.

    One after the other on frames, they would keep two Python workers for each task, and all rows would go through the JVM between them.
    """
    documents = documents.drop("ids", "score", "nbest", "decoded")
    arrow_batches(documents.sparkSession)
    shipped = documents.sparkSession.sparkContext.broadcast(vocabulary)
    encoded, decoded = encoding(shipped, n, text), decoding(shipped, "ids")
    return documents.mapInArrow(lambda batches: decoded(encoded(batches)), with_fields(documents, f"{ENCODED}, {DECODED}"))


def rewritten(ids: list[int], edits: list[dict]) -> list[int]:
    """The ids of another segmentation."""
    out, done = [], 0
    for edit in edits:
        out += [*ids[done : edit["at"]], *edit["ids"]]
        done = edit["at"] + edit["drop"]
    return out + list(ids[done:])


def count(documents: DataFrame, vocabulary: Vocabulary, text: str = "text") -> DataFrame:
    """All columns of the documents, `n_tokens` and `n_pretokens`."""
    documents = documents.drop("n_tokens", "n_pretokens")
    arrow_batches(documents.sparkSession)
    shipped = documents.sparkSession.sparkContext.broadcast(vocabulary)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shipped.value
        for block in blocks(batches, text):
            found = tokens(with_spaces(block), own)
            terminals = found.forward.pieces[found.terminal]
            sums = np.concatenate([[0], np.cumsum(terminals[found.kind])])
            rows = block.rows.append_column("n_tokens", pa.array(sums[found.at[1:]] - sums[found.at[:-1]], pa.int64()))
            yield rows.append_column("n_pretokens", pa.array(np.diff(found.at), pa.int64()))

    return documents.mapInArrow(counted, with_fields(documents, "n_tokens long, n_pretokens long"))

"""Piece lattices of whole blocks of text: vocabulary, pre-tokens, and Viterbi scores shared by a trie.

A vocabulary gives every piece a unigram log-probability by Zipf's law from its rank in the model file;
a byte that no piece covers costs BYTE_SCORE. Text is bytes: a space stands for the word mark, and one
space goes before every text that is not empty.

Two neighbouring bytes that no piece contains can never share a piece, so text is cut there: the pre-tokens
are independent, and the best segmentation of a text is that of each of its pre-tokens. The distinct ones
of a block form a trie, level by level; a forward score depends on the prefix alone and is computed once
for every node. Where only a FEW long spans are left, each is walked byte by byte instead, in the order of
their bytes, so that a span still shares the nodes of the one before it.
"""

from __future__ import annotations

import itertools
from array import array
from bisect import insort
from dataclasses import dataclass
from functools import cached_property

import numpy as np

from cartwheel.llm.blocks import Block, Hasher, hash_bytes

MARK = "▁"
BYTE_SCORE = -25.0
FEW = 64  # spans that are walked one by one: a level of the trie costs as much as about 200 bytes of a walk
REMEMBERED = 10_000


class Vocabulary:
    """Pieces as bytes, with ids and scores; `byte_ids` are the pieces of single bytes."""

    def __init__(self, pieces: list[bytes], ids: list[int], byte_ids: list[int]):
        self.pieces, self.ids = pieces, np.array(ids, np.int32)
        self.byte_ids = np.array(byte_ids, np.int32)
        rank = np.arange(1, len(pieces) + 1)
        self.scores = -np.log(rank) - np.log((1 / rank).sum())
        self.longest = max(map(len, pieces), default=1)

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        """The pieces of a SentencePiece model file, which only the driver reads."""
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        byte_ids, pieces, ids = [0] * 256, [], []
        for i in range(model.vocab_size()):
            if model.is_byte(i):
                byte_ids[int(model.id_to_piece(i)[1:-1], 16)] = i
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                pieces.append(model.id_to_piece(i).replace(MARK, " ").encode())
                ids.append(i)
        return cls(pieces, ids, byte_ids)

    @cached_property
    def joined(self) -> np.ndarray:
        """Whether two bytes stand next to each other in some piece."""
        table = np.zeros((256, 256), bool)
        for piece in self.pieces:
            own = np.frombuffer(piece, np.uint8)
            table[own[:-1], own[1:]] = True
        return table

    @cached_property
    def by_hash(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sorted hashes of the pieces, their numbers, and which leading bits occur at all."""
        hashes = hash_bytes(self.pieces)
        order = np.argsort(hashes)
        bits = np.zeros(1 << 20, bool)
        bits[hashes >> np.uint64(44)] = True
        return hashes[order], order, bits

    @cached_property
    def by_bytes(self) -> dict[bytes, int]:
        return {p: i for i, p in enumerate(self.pieces)}

    @cached_property
    def singles(self) -> tuple[np.ndarray, np.ndarray]:
        """Score and id of the arc over each single byte."""
        scores, ids = np.full(256, BYTE_SCORE), self.byte_ids.copy()
        for byte in range(256):
            number = self.by_bytes.get(bytes([byte]))
            if number is not None:
                scores[byte], ids[byte] = self.scores[number], self.ids[number]
        return scores, ids

    @cached_property
    def by_end(self) -> dict[int, tuple[int, ...]]:
        """Lengths of the pieces of several bytes by their last two bytes, ascending."""
        found: dict[int, set[int]] = {}
        for piece in self.pieces:
            if len(piece) > 1:
                found.setdefault(piece[-2] << 8 | piece[-1], set()).add(len(piece))
        return {end: tuple(sorted(sizes)) for end, sizes in found.items()}

    @cached_property
    def listed(self) -> tuple[list[float], list[int], list[float], list[int]]:
        """Scores and ids of all pieces and of all single bytes as plain numbers."""
        single_scores, single_ids = self.singles
        return self.scores.tolist(), self.ids.tolist(), single_scores.tolist(), single_ids.tolist()

    @cached_property
    def remembered(self) -> dict[bytes, list[tuple[int, float, int]]]:
        """Arcs by the bytes they depend on, for a bounded number of these: runs ask for the same again and again."""
        return {}

    def arcs(self, text: bytes, end: int) -> list[tuple[int, float, int]]:
        """Length, score and id of every arc that ends there, the shortest first."""
        scores, ids, single_scores, single_ids = self.listed
        last = text[end - 1]
        sizes = self.by_end.get(text[end - 2] << 8 | last, ()) if end > 1 else ()
        key = text[max(0, end - sizes[-1]) : end] if sizes else text[end - 1 : end]
        own = self.remembered.get(key)
        if own is None:
            own = [(1, single_scores[last], single_ids[last])]
            for size in sizes:
                number = self.by_bytes.get(key[-size:]) if size <= len(key) else None
                if number is not None:
                    own.append((size, scores[number], ids[number]))
            if len(self.remembered) >= REMEMBERED:
                self.remembered.clear()
            self.remembered[key] = own
        return own

    def numbers(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the hashes are pieces, as positions, and the pieces' numbers."""
        keys, order, bits = self.by_hash
        maybe = np.flatnonzero(bits[hashes >> np.uint64(44)])
        at = np.minimum(np.searchsorted(keys, hashes[maybe]), len(keys) - 1)
        hit = keys[at] == hashes[maybe]
        return maybe[hit], order[at[hit]]

    @cached_property
    def spelled(self) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of every id, one after the other, and where each begins; other ids have none."""
        size = int(max(self.ids.max(initial=0), self.byte_ids.max())) + 1
        texts = [b""] * size
        for byte, i in enumerate(self.byte_ids.tolist()):
            texts[i] = bytes([byte])
        for piece, i in zip(self.pieces, self.ids.tolist(), strict=True):
            texts[i] = piece
        return np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])


def with_spaces(block: Block) -> Block:
    """The block with a space before every text that is not empty."""
    sizes = np.diff(block.bounds)
    bounds = np.concatenate([[0], np.cumsum(sizes + (sizes > 0))])
    data = np.full(bounds[-1], 32, np.uint8)
    own = np.ones(bounds[-1], bool)
    own[bounds[:-1][sizes > 0]] = False
    data[own] = block.data
    return Block(block.rows, data, bounds)


@dataclass
class Forward:
    """Viterbi scores of every node of a trie; node 0 is the root."""

    score: np.ndarray
    pieces: np.ndarray  # how many on the best path
    back: np.ndarray  # the node before the last piece
    token: np.ndarray  # the last piece's id
    slack: np.ndarray  # least loss of any other way into a node of the best path


@dataclass
class Tokens:
    """The pre-tokens of a block: distinct ones with their terminal nodes, and every occurrence."""

    block: Block
    starts: np.ndarray  # of the distinct ones
    ends: np.ndarray
    terminal: np.ndarray
    forward: Forward
    kind: np.ndarray  # of each occurrence, the number of its distinct pre-token
    at: np.ndarray  # where each text's occurrences begin, and their number at the end

    def spelled(self, kind: int) -> bytes:
        return self.block.data[self.starts[kind] : self.ends[kind]].tobytes()


def tokens(block: Block, vocabulary: Vocabulary) -> Tokens:
    """Cut the texts into pre-tokens and score the distinct ones."""
    data, size = block.data, len(block.data)
    cut = np.ones(size, bool)
    if size:
        cut[1:] = ~vocabulary.joined[data[:-1], data[1:]]
        cut[block.bounds[:-1][block.bounds[:-1] < size]] = True
    starts = np.flatnonzero(cut)
    ends = np.append(starts[1:], size) if size else starts
    hasher = Hasher(data)
    _, first, kind = np.unique(hasher.spans(starts, ends), return_index=True, return_inverse=True)
    own, own_ends = starts[first], ends[first]
    terminal, forward = trie_scores(data, own, own_ends, hasher, vocabulary)
    return Tokens(block, own, own_ends, terminal, forward, kind, np.searchsorted(starts, block.bounds))


def trie_scores(
    data: np.ndarray, starts: np.ndarray, ends: np.ndarray, hasher: Hasher, vocabulary: Vocabulary
) -> tuple[np.ndarray, Forward]:
    """Insert the spans into a trie and run the forward pass once for each node, level by level."""
    order = np.argsort(starts - ends, kind="stable")  # the longest first
    starts, sizes = starts[order], (ends - starts)[order]
    terminal = np.zeros(len(order), np.int64)
    deepest = int(sizes[0]) if len(sizes) else 0
    single_score, single_id = vocabulary.singles
    levels = [Forward(np.zeros(1), np.zeros(1, np.int64), np.zeros(1, np.int64), np.zeros(1, np.int32), np.full(1, np.inf))]
    offset = 1
    # Node, score, count and slack at each of the last levels, one entry for every span that is so long.
    recent = [(np.zeros(len(order), np.int64), levels[0])]
    first_node = [0]
    for depth in range(1, deepest + 1):
        active = int(np.searchsorted(-sizes, -depth, "right"))
        if depth > 1 and active <= FEW:
            terminal[:active], rest = walked(data, starts[:active], sizes[:active], depth - 1, recent, first_node, offset, vocabulary)
            levels.append(rest)
            break
        begin = starts[:active]
        if depth == 1:
            _, lead, node = np.unique(data[begin], return_index=True, return_inverse=True)
        else:
            parent = recent[-1][0][:active] - first_node[-1]
            _, lead, node = np.unique(parent * 256 + data[begin + depth - 1], return_index=True, return_inverse=True)
        end = starts[lead] + depth
        last = data[end - 1]
        best = np.full(len(lead), -np.inf)
        second = np.full(len(lead), -np.inf)
        count, back = np.zeros(len(lead), np.int64), np.zeros(len(lead), np.int64)
        token, slack = np.zeros(len(lead), np.int32), np.full(len(lead), np.inf)
        for length in range(1, min(depth, vocabulary.longest, len(recent)) + 1):
            nodes, level = recent[-length]
            base = first_node[-length]
            if length == 1:
                at, gain, ids = np.arange(len(lead)), single_score[last], single_id[last]
            else:
                at, piece = vocabulary.numbers(hasher.spans(end - length, end))
                if not len(at):
                    continue
                gain, ids = vocabulary.scores[piece], vocabulary.ids[piece]
            before = nodes[lead[at]]
            value = level.score[before - base] + gain
            better = value > best[at]
            second[at] = np.maximum(second[at], np.where(better, best[at], value))
            to, source = at[better], before[better]
            best[to], back[to], token[to] = value[better], source, ids[better]
            count[to] = level.pieces[source - base] + 1
            slack[to] = level.slack[source - base]
        slack = np.minimum(slack, best - second)
        levels.append(Forward(best, count, back, token, slack))
        ended = sizes[:active] == depth
        terminal[:active][ended] = node[ended] + offset
        recent.append((node + offset, levels[-1]))
        first_node.append(offset)
        offset += len(lead)
        if len(recent) > vocabulary.longest:
            recent.pop(0)
            first_node.pop(0)
    unsorted = np.empty_like(terminal)
    unsorted[order] = terminal
    join = lambda name: np.concatenate([getattr(level, name) for level in levels])
    return unsorted, Forward(*map(join, ("score", "pieces", "back", "token", "slack")))


def walked(
    data: np.ndarray,
    starts: np.ndarray,
    sizes: np.ndarray,
    done: int,
    recent: list[tuple[np.ndarray, Forward]],
    first_node: list[int],
    offset: int,
    vocabulary: Vocabulary,
) -> tuple[np.ndarray, Forward]:
    """Carry the forward pass on from depth `done` to the ends of the spans, one span after the other.

    Gives the terminal node of every span and the new nodes, which are numbered from `offset` on. In the order of their
    bytes, a span shares most of its prefix with the one before, whose nodes on this stretch are kept.
    """
    texts = [data[a : a + n].tobytes() for a, n in zip(starts.tolist(), sizes.tolist(), strict=True)]
    terminal = np.zeros(len(texts), np.int64)
    made = Forward(array("d"), array("q"), array("q"), array("i"), array("d"))
    # Of the nodes on the present path, from the first that a piece can still begin at.
    first = done + 1 - len(recent)
    node, score, pieces, slack = array("q"), array("d"), array("q"), array("d")
    before = b""
    for number in sorted(range(len(texts)), key=texts.__getitem__):
        text = texts[number]
        shared = common(before, text)
        if shared <= done:
            shared = done
            own = [(int(nodes[number]), level, base) for (nodes, level), base in zip(recent, first_node, strict=True)]
            node = array("q", [n for n, _, _ in own])
            score = array("d", [level.score[n - base] for n, level, base in own])
            pieces = array("q", [level.pieces[n - base] for n, level, base in own])
            slack = array("d", [level.slack[n - base] for n, level, base in own])
        for column in (node, score, pieces, slack):
            del column[shared + 1 - first :]
        for end in range(shared + 1, len(text) + 1):
            best, second, source, token = -np.inf, -np.inf, 0, 0
            for size, gain, own_id in vocabulary.arcs(text, end):
                value = score[-size] + gain
                if value > best:
                    best, second, source, token = value, best, len(score) - size, own_id
                elif value > second:
                    second = value
            loss = min(slack[source], best - second)
            made.back.append(node[source])
            made.token.append(token)
            node.append(offset + len(made.back) - 1)
            for column, of_node, value in ((score, made.score, best), (pieces, made.pieces, pieces[source] + 1), (slack, made.slack, loss)):
                column.append(value)
                of_node.append(value)
        terminal[number] = node[-1]
        before = text
    return terminal, Forward(*(np.array(getattr(made, name)) for name in ("score", "pieces", "back", "token", "slack")))


def common(a: bytes, b: bytes) -> int:
    """How many bytes both begin with."""
    size = min(len(a), len(b))
    unlike = np.frombuffer(a, np.uint8, size) != np.frombuffer(b, np.uint8, size) if size else np.zeros(0, bool)
    return int(unlike.argmax()) if unlike.any() else size


def best_ids(found: Tokens) -> tuple[np.ndarray, np.ndarray]:
    """The ids of the best path of every distinct pre-token, one after the other, and where each begins."""
    forward, node = found.forward, found.terminal.copy()
    bounds = np.concatenate([[0], np.cumsum(forward.pieces[node])])
    ids, place = np.zeros(bounds[-1], np.int32), bounds[1:] - 1
    going = np.flatnonzero(node)
    while len(going) > FEW:
        ids[place[going]] = forward.token[node[going]]
        place[going] -= 1
        node[going] = forward.back[node[going]]
        going = going[node[going] > 0]
    for own in going.tolist():
        at, put = int(node[own]), int(place[own])
        while at:
            ids[put] = forward.token[at]
            at, put = int(forward.back[at]), put - 1
    return ids, bounds


def spread(values: np.ndarray, bounds: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The stretches values[bounds[c]:bounds[c + 1]] of the chosen one after the other, and their bounds."""
    sizes = (bounds[1:] - bounds[:-1])[chosen]
    out = np.concatenate([[0], np.cumsum(sizes)])
    index = np.repeat(bounds[:-1][chosen] - out[:-1], sizes) + np.arange(out[-1])
    return values[index], out


def best_paths(text: bytes, vocabulary: Vocabulary, n: int) -> list[tuple[float, tuple[int, ...]]]:
    """The n best segmentations with their scores, best first.

    Forward Viterbi scores are the exact rest of every path from the end, so that a backward A-star
    search completes paths in the order of their scores. Scores equal to six digits are ties, of which the
    path nearest to its end goes first: a long run of one letter has countless ways of the same score.
    Unfinished paths have different ends, and the score of each is that of its best completion, so only as
    many as are still to be found need to be kept open.
    """
    forward = array("d", [0.0])
    for end in range(1, len(text) + 1):
        forward.append(max(forward[end - size] + gain for size, gain, _ in vocabulary.arcs(text, end)))
    tick = itertools.count()
    open_paths: list[tuple] = [(-round(forward[-1], 6), len(text), next(tick), 0.0, None)]
    found = []
    while open_paths and len(found) < n:
        _, place, _, gone, path = open_paths.pop(0)
        if not place:
            out = []
            while path:
                out.append(path[0])
                path = path[1]
            found.append((gone, tuple(out)))
            continue
        for size, gain, token in vocabulary.arcs(text, place):
            rest = -round(forward[place - size] + gain + gone, 6)
            insort(open_paths, (rest, place - size, next(tick), gone + gain, (token, path)))
        del open_paths[n - len(found) :]
    return found

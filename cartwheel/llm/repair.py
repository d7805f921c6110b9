"""Conversation structure repair: a weighted CYK parse of every conversation, and the turns that it leaves.

Faults. A turn is blank (nothing but white space), else a duplicate (role and text were there before), else truncated
(its last character that is not white space does not end a sentence). Edits: keep a turn (0), give it the role user
or assistant (3), delete it (4, a must for blank and duplicate ones), insert an empty turn of either (3); a truncated
turn that stays adds 3. The cheapest edits are wanted whose roles start with s?(ua)+ or nothing, and of equally
cheap ones the least audit, the string of their initials.

Grammar. A fragment F[p, q] is a piece of a good conversation after a turn of kind p that ends with one of kind q;
its rules are in Chomsky normal form: F[p, q] -> F[p, r] F[r, q] for every r, F[p, q] -> one edited turn, and the start
symbol is F[START, START] or F[START, A]. Insertions need no turn, so `CLOSURE`, the fixed point of inserting, is put
after every terminal and once in front. A cell holds the least (cost, audit) of every fragment of its span. No
audit is the beginning of another one of the same span and cost, so the least pairs of two spans give the least of both.
Since there is a rule for every r, a cell does not depend on where its span is cut: of all spans the chart needs only
aligned ones, whose length doubles from one level to the next, which takes a number of cells in proportion to the turns
instead of their square. `tests/llm` compares with a chart of all spans and all cuts.

Spark. One range partition by conversation and turn puts the rows in order and spreads a long conversation over
many tasks. Faults become one symbol for each turn, `BLOCK` turns of a conversation become one string and one cell,
and the cells of a conversation meet as short strings. The repaired turns are streamed in order behind the audit, so
no task holds a conversation's texts. A conversation's audit is one string, and that string is what one task must hold.

Edge cases: null roles and texts count as one space, which is no kind of role and blank. A null id is a conversation of
its own, null turns come first and do not count as gaps. Rows with the same turn follow each other by role and
text. A role counts by its first character, as it is spelled; a role without one of s, u, a (an empty one too) cannot
be kept. Other columns are not read. An empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from cartwheel.llm.blocks import arrow_batches
from cartwheel.session import shuffle_partitions, stored

BLOCK = 4_096
SHORT = 16
TEXT_PREFIX = 32

# Costs of the edits, and the roles that can be given.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
ROLES = ("user", "assistant")

# What stands at the end of a fragment.
START, S, U, A = range(4)
GIVEN = {START: U, S: U, U: A, A: U}
KINDS, STATES = "sua-", ("clean", "truncated", "duplicate", "blank")
SYMBOLS = "ABCDEFGHIJKLMNOP"
LEGAL = {"su", "ua", "au"}

Cell = dict[tuple[int, int], tuple[int, str]]


def combined(left: Cell, right: Cell) -> Cell:
    """F[p, q] -> F[p, r] F[r, q]."""
    cell: Cell = {}
    for (p, r), (cost, audit) in left.items():
        for q in range(4):
            other = right.get((r, q))
            if other is None:
                continue
            best = cell.get((p, q))
            total = cost + other[0]
            if best is None or total <= best[0]:
                found = (total, audit + other[1])
                if best is None or found < best:
                    cell[p, q] = found
    return cell


def closed() -> Cell:
    """The cheapest insertions that lead from one kind to another."""
    step: Cell = {(p, p): (0, "") for p in range(4)}
    step.update({(p, q): (INSERT, "I") for p, q in GIVEN.items()})
    cell = step
    while (more := combined(cell, step)) != cell:
        cell = more
    return cell


CLOSURE = closed()


def after(p: int, kind: str) -> int | None:
    """What a kept turn of that kind leaves behind one of kind p, if it may stand there."""
    if kind == "s":
        return S if p == START else None
    return GIVEN[p] if kind == "ua"[GIVEN[p] - U] else None


@lru_cache(len(SYMBOLS))
def terminal(symbol: str) -> Cell:
    """One turn, edited in the cheapest way for each pair of kinds, and what is inserted behind it."""
    kind, state = divmod(SYMBOLS.index(symbol), len(STATES))
    cell: Cell = {(p, p): (DELETE, "D") for p in range(4)}
    if STATES[state] in ("clean", "truncated"):
        extra = TRUNCATED * (STATES[state] == "truncated")
        for p, given in GIVEN.items():
            kept = after(p, KINDS[kind])
            cell[p, given] = (REROLE + extra, "R")
            if kept is not None:
                cell[p, kept] = (extra, "K")
    return combined(cell, CLOSURE)


def span(symbols: str) -> Cell:
    """The cell of a span, bottom up: neighbours of one length become spans of twice that length."""
    cells = [short_span(symbols[i : i + SHORT]) for i in range(0, len(symbols), SHORT)]
    while len(cells) > 1:
        cells = [combined(*cells[i : i + 2]) if i + 1 < len(cells) else cells[i] for i in range(0, len(cells), 2)]
    return cells[0]


@lru_cache(1 << 14)
def short_span(symbols: str) -> Cell:
    if len(symbols) == 1:
        return terminal(symbols)
    half = 1 << (len(symbols) - 1).bit_length() - 1
    return combined(short_span(symbols[:half]), short_span(symbols[half:]))


def cheapest(cells: list[Cell]) -> tuple[int, str]:
    """Cost and audit of a conversation from the cells of its blocks in their order."""
    cells = [CLOSURE, *cells]
    while len(cells) > 1:
        cells = [combined(*cells[i : i + 2]) if i + 1 < len(cells) else cells[i] for i in range(0, len(cells), 2)]
    return min(cells[0][START, q] for q in (START, A) if (START, q) in cells[0])


def packed(cell: Cell) -> str:
    return " ".join(f"{p}{q}{cost}:{audit}" for (p, q), (cost, audit) in cell.items())


def unpacked(text: str) -> Cell:
    parts = (x.partition(":") for x in text.split(" "))
    return {(int(head[0]), int(head[1])): (int(head[2:]), audit) for head, _, audit in parts}


def illegal_pairs(kinds: str) -> int:
    return sum(kinds[i : i + 2] not in LEGAL for i in range(len(kinds) - 1))


def kinds_of(symbols: str) -> str:
    return "".join(KINDS[SYMBOLS.index(x) // len(STATES)] for x in symbols)


# Spark


def ordered(conversations: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """(conv, turn, role, text, row), stored: rows are numbered in the order of their conversations."""
    space = F.lit(" ")
    rows = conversations.select(
        F.col(conv).alias("conv"),
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role), space).alias("role"),
        F.coalesce(F.col(text), space).alias("text"),
    )
    first = [F.col("conv").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role")]
    split = rows.repartitionByRange(
        shuffle_partitions(conversations.sparkSession), *first, F.substring("text", 1, TEXT_PREFIX)
    ).sortWithinPartitions(*first, "text")
    return stored(split.withColumn("row", F.monotonically_increasing_id()), "turns")


def marked(rows: DataFrame) -> DataFrame:
    """(conv, turn, row, symbol): kind and first fault of each turn."""
    initial = F.substring("role", 1, 1)
    kind = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    narrow = rows.select(
        "conv",
        "turn",
        "row",
        kind.alias("kind"),
        (~F.col("text").rlike(r"[^\x20\x09-\x0D]")).alias("blank"),
        (~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")).alias("truncated"),
        F.sha2(F.concat_ws(":", F.length("role").cast("string"), "role", "text"), 256).alias("same"),
    )
    # A turn is no duplicate if it is the first of its kind; hot texts cost one row for each task.
    firsts = narrow.groupBy("conv", "same").agg(F.min("row").alias("row")).select("row", F.lit(True).alias("first"))
    state = F.when(F.col("blank"), 3).when(F.col("first").isNull(), 2).when(F.col("truncated"), 1).otherwise(0)
    place = F.col("kind") * len(STATES) + state + 1
    return narrow.join(firsts, "row", "left").select(
        "conv", "turn", "row", F.substring(F.lit(SYMBOLS), place, F.lit(1)).alias("symbol")
    )


def block_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each block: its cell, its faults, and the kinds at both of its ends."""
    for batch in batches:
        strings = batch.column("symbols").to_pylist()
        kinds = [kinds_of(s) for s in strings]
        faults = [[sum(SYMBOLS.index(x) % len(STATES) == i for x in s) for s in strings] for i in (3, 2, 1)]
        made = [
            [packed(span(s)) for s in strings],
            *faults,
            [illegal_pairs(k) for k in kinds],
            [k[0] for k in kinds],
            [k[-1] for k in kinds],
        ]
        columns = [pa.array(x, t) for x, t in zip(made, [pa.string(), *[pa.int64()] * 4, *[pa.string()] * 2])]
        yield pa.RecordBatch.from_arrays([batch.column("conv"), batch.column("block"), *columns], names=BLOCK_FIELDS)


BLOCK_FIELDS = ["conv", "block", "cell", "blank", "duplicate", "truncated", "illegal", "first_kind", "last_kind"]


def conversation_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cost, audit and illegal neighbours of whole conversations from their blocks."""
    for batch in batches:
        costs, audits, illegal = [], [], []
        for blocks, inside in zip(batch.column("blocks").to_pylist(), batch.column("illegal").to_pylist()):
            cost, audit = cheapest([unpacked(b["cell"]) for b in blocks])
            costs.append(cost)
            audits.append(audit)
            borders = (a["last_kind"] + b["first_kind"] for a, b in zip(blocks, blocks[1:]))
            illegal.append(inside + sum(pair not in LEGAL for pair in borders))
        kept = [batch.column(c) for c in ("conv", "blank", "duplicate", "truncated")]
        made = [pa.array(illegal, pa.int64()), pa.array(costs, pa.int64()), pa.array(audits, pa.string())]
        names = ["conv", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]
        yield pa.RecordBatch.from_arrays([*kept, *made], names=names)


def parsed(rows: DataFrame) -> DataFrame:
    """(conv, gaps, blank, duplicate, truncated, illegal, cost, audit) of `ordered` rows."""
    arrow_batches(rows.sparkSession)
    conv = f"conv {rows.schema['conv'].dataType.simpleString()}"
    symbols = stored(marked(rows), "symbols")
    # Row numbers have the partition in their upper bits, so a block is a piece of one partition.
    listed = symbols.groupBy("conv", F.floor(F.col("row") / BLOCK).alias("block")).agg(
        F.array_sort(F.collect_list(F.struct("row", "symbol"))).alias("turns")
    )
    strings = listed.select("conv", "block", F.array_join(F.col("turns.symbol"), "").alias("symbols"))
    longs = "blank long, duplicate long, truncated long, illegal long"
    cells = strings.mapInArrow(block_cells, f"{conv}, block long, cell string, {longs}, first_kind string, last_kind string")
    joined = cells.groupBy("conv").agg(
        F.array_sort(F.collect_list(F.struct("block", "cell", "first_kind", "last_kind"))).alias("blocks"),
        *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal")],
    )
    found = joined.mapInArrow(conversation_cells, f"{conv}, {longs}, cost long, audit string")
    turns = symbols.select("conv", "turn").distinct().groupBy("conv").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).cast("long").alias("gaps")
    )
    both = found.join(turns.withColumnRenamed("conv", "_conv"), F.col("conv").eqNullSafe(F.col("_conv")))
    return both.select("conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")


def edits(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(conv, edit, role, text) of every edit in order, and (conv, None, None, None) before each conversation.

    Rows come as `behind_audits` sorts them; only one batch of texts and one audit are held.
    """
    conv, audit, k, state = None, "", 0, START

    def inserted(k: int, state: int) -> Iterator[tuple[int, int]]:
        while k < len(audit) and audit[k] == "I":
            k, state = k + 1, GIVEN[state]
            yield k, state

    for batch in batches:
        for key, plan, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv", "audit", "role", "text"))):
            if plan is not None:
                for k, state in inserted(k, state):
                    yield conv, "I", ROLES[state - U], ""
                conv, audit, k, state = key, plan, 0, START
                yield conv, None, None, None
                continue
            for k, state in inserted(k, state):
                yield conv, "I", ROLES[state - U], ""
            edit, k = audit[k], k + 1
            if edit == "K":
                state = after(state, role[:1])
            elif edit == "R":
                state = GIVEN[state]
                role = ROLES[state - U]
            yield conv, edit, role, text
    for k, state in inserted(k, state):
        yield conv, "I", ROLES[state - U], ""


def behind_audits(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """Every conversation's audit, then its rows, sorted in one partition and never gathered."""
    heads = audits.select("conv", F.lit(-1).cast("long").alias("row"), "audit", *[F.lit(None).cast("string").alias(c) for c in ("role", "text")])
    texts = rows.select("conv", "row", F.lit(None).cast("string").alias("audit"), "role", "text")
    parts = shuffle_partitions(rows.sparkSession)
    return heads.unionByName(texts).repartition(parts, "conv").sortWithinPartitions("conv", "row")


def repaired_turns(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """(conv, place, edit, role, text): the repaired conversations, turn by turn, deleted turns left out."""

    def turns(batches):
        made, place = [], 0
        for conv, edit, role, text in edits(batches):
            place = 0 if edit is None else place
            if edit not in (None, "D"):
                made.append((conv, place, edit, role, text))
                place += 1
            if len(made) >= 1_000:
                yield from batch_of(made)
                made = []
        yield from batch_of(made)

    def batch_of(made):
        if made:
            columns = [pa.array(c, t) for c, t in zip(zip(*made), [ids, pa.int64(), *[pa.string()] * 3])]
            yield pa.RecordBatch.from_arrays(columns, names=["conv", "place", "edit", "role", "text"])

    kind = rows.schema["conv"].dataType
    ids = to_arrow_type(kind)
    made_of = f"conv {kind.simpleString()}, place long, edit string, role string, text string"
    return behind_audits(rows, audits).mapInArrow(turns, made_of)


def digests(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """(conv, repaired_sha256): SHA-256 of the repaired `role:text` lines, hashed while they stream by."""

    def hashed(batches):
        convs, sums, running, lines = [], [], None, 0
        for conv, edit, role, text in edits(batches):
            if edit is None:
                if running is not None:
                    sums.append(running.hexdigest())
                convs.append(conv)
                running, lines = hashlib.sha256(), 0
            elif edit != "D":
                running.update(("\n" * (lines > 0) + f"{role}:{text}").encode())
                lines += 1
        if running is not None:
            sums.append(running.hexdigest())
            yield pa.RecordBatch.from_arrays([pa.array(convs, ids), pa.array(sums, pa.string())], names=["conv", "repaired_sha256"])

    kind = rows.schema["conv"].dataType
    ids = to_arrow_type(kind)
    return behind_audits(rows, audits).mapInArrow(hashed, f"conv {kind.simpleString()}, repaired_sha256 string")


def repaired(
    conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> tuple[DataFrame, DataFrame]:
    """The rows in order, and for each conversation its faults, cost and audit; both are stored.

    `repaired_turns` and `digests` take the two.
    """
    rows = ordered(conversations, conv, turn, role, text)
    return rows, stored(parsed(rows), "audits")


def damaged(conversations: DataFrame, number: Column) -> DataFrame:
    """Rows with planted faults by `number`: 0 drops, 1 empties, 2 takes sentence ends, 3 repeats, 4 makes user.

    Null roles and texts become one space first.
    """
    rows = conversations.select("conv_id", "turn", *[F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text")])
    rows = rows.withColumn("_n", number).where("_n <> 0")
    text = F.when(F.col("_n") == 1, "").when(F.col("_n") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("_n") == 4, "user").otherwise(F.col("role"))
    copies = F.explode(F.sequence(F.lit(1), F.when(F.col("_n") == 3, 2).otherwise(1)))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("_copy")).drop("_copy")

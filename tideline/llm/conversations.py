"""Repair of conversations whose turns are missing, empty, repeated, cut off or out of turn.

Rows are dealt by ranges of (conversation, turn, role, text digest), so a conversation with a third of all rows is cut
into units in many tasks. A unit is repaired by a generalised LR parser (``glr``) from every stack it may start with;
the units of a conversation are then chained, which picks one path through each. Texts do not take part in this: only
digests and flags do. They meet their edits in one more range-dealt pass.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from tideline.llm import glr
from tideline.llm.tables import shuffle_partitions, written

#: A conversation is nothing, or pairs of user and assistant turns after at most one system turn.
GRAMMAR: list[glr.Rule] = [
    ("talk", ()), ("talk", ("pairs",)), ("talk", ("s", "pairs")),
    ("pairs", ("pair",)), ("pairs", ("pairs", "pair")), ("pair", ("u", "a")),
]
#: What a symbol that is given or inserted stands for.
ROLES = {"u": "user", "a": "assistant"}
LEGAL = ("su", "ua", "au")
UNIT_ROWS = 4096
SPACES = " \t\n\x0b\x0c\r"

KEY = ["conv", "turn", "role", "digest"]
UNIT = (
    "segment int, unit int, blank long, duplicate long, truncated long, illegal long, first string, last string, "
    "first_turn long, last_turn long, turns long"
)
PATHS = "paths array<struct<start: int, stop: int, cost: long, edits: array<string>>>"
KEYS = "keys array<struct<turn: long, role: string, digest: binary>>"
SUMMARY = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
CHAIN = (
    "segment int, unit int, pieces array<string>, numbers array<long>, gaps long, blank long, duplicate long, "
    "truncated long, illegal long, cost long, audit string"
)
MESSAGE = "number long, edit string, role string, text string"


def repairer(costs: glr.Costs) -> glr.Repairer:
    return glr.Repairer(glr.Automaton(GRAMMAR), tuple(ROLES), costs)


def faults(rows: DataFrame) -> DataFrame:
    """Each different (conv, turn, role, text) once, with its copies and first fault; texts as digests.

    ``rows`` has conv, turn, role and text; equal rows are counted before they are shuffled.
    """
    # Seen without white space at the end.
    end = F.rtrim("text", F.lit(SPACES))
    keyed = rows.select(
        "conv",
        "turn",
        "role",
        digest_of(F.col("text")).alias("digest"),
        (end == "").alias("is_blank"),
        (~F.right(end, F.lit(1)).isin(".", "!", "?")).alias("is_cut"),
    )
    rows = written(keyed.groupBy(*keyed.columns).agg(F.count("*").alias("n")))
    # Turns without a number come first.
    place = F.struct(F.col("turn").isNotNull().alias("numbered"), "turn")
    first = rows.where("NOT is_blank").groupBy("conv", "role", "digest").agg(F.min(place).alias("first"))
    same = F.expr("l.conv <=> r.conv AND l.role = r.role AND l.digest = r.digest")
    found = rows.alias("l").join(first.alias("r"), same, "left")
    seen = ~F.col("r.first").eqNullSafe(F.struct(F.col("l.turn").isNotNull().alias("numbered"), "l.turn"))
    return written(found.select("l.*", (~F.col("l.is_blank") & seen).alias("is_repeat")))


def digest_of(text: Column) -> Column:
    """128 bits of a text's SHA-256."""
    return F.unhex(F.substring(F.sha2(text, 256), 1, 32))


def in_order(rows: DataFrame, *more: str) -> DataFrame:
    """Rows in ranges of their place; a conversation may span many tasks."""
    return rows.repartitionByRange(shuffle_partitions(rows), *KEY).sortWithinPartitions(*KEY, *more)


def units_of(marked: DataFrame, costs: glr.Costs, unit_rows: int) -> DataFrame:
    """Stretches of at most ``unit_rows`` rows of a conversation with the paths through each.

    Only what a task sees first of a conversation that may have begun before, and further units of one, need paths
    from every stack.
    """
    fields = ["conv", *KEY[1:], "is_blank", "is_cut", "is_repeat", "n"]
    schema = marked.select("conv", *[F.lit(None).cast(t).alias(n) for n, t in _typed(f"{UNIT}, {KEYS}, {PATHS}")]).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        repair, segment, unit = repairer(costs), TaskContext.get().partitionId(), 0
        rows = (row for batch in batches for row in zip(*(batch.column(c).to_pylist() for c in fields)))
        out = []
        for n_conv, (conv, own) in enumerate(groupby(rows, key=lambda row: row[0])):
            for n_unit, stretch in enumerate(_stretches(own, unit_rows)):
                alone = n_conv > 0 and n_unit == 0
                starts = [0] if alone else repair.automaton.reachable
                out.append({"conv": conv, "segment": segment, "unit": unit, **_unit(repair, stretch, starts)})
                unit += 1
                if len(out) >= 256 or len(stretch) == unit_rows:
                    yield pa.RecordBatch.from_pylist(out, schema=arrow)
                    out = []
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=arrow)

    arrow = to_arrow_schema(schema)
    return in_order(marked).mapInArrow(run, schema)


def _typed(ddl: str) -> list[tuple[str, str]]:
    """Names and types of a field list; commas inside angle brackets separate no fields."""
    out, depth, begin = [], 0, 0
    for i, c in enumerate(ddl + ","):
        depth += (c == "<") - (c == ">")
        if c == "," and not depth:
            name, kind = ddl[begin:i].strip().split(" ", 1)
            out.append((name, kind))
            begin = i + 1
    return out


def _stretches(rows: Iterator[tuple], size: int) -> Iterator[list[tuple]]:
    out: list[tuple] = []
    for row in rows:
        out.append(row)
        if len(out) == size:
            yield out
            out = []
    if out:
        yield out


def _unit(repair: glr.Repairer, rows: list[tuple], starts: list[int]) -> dict:
    symbols, out = [], dict.fromkeys(("blank", "duplicate", "truncated", "illegal", "turns"), 0)
    before = turn = None
    for _, own_turn, role, _, is_blank, is_cut, is_repeat, n in rows:
        initial, must_go = role[:1], is_blank or is_repeat
        fault = "blank" if is_blank else "duplicate" if is_repeat else "truncated" if is_cut else None
        if fault:
            out[fault] += n if is_blank or is_repeat else 1
        if not is_blank and n > 1:
            out["duplicate"] += n - 1 if not is_repeat else 0
        out["illegal"] += (n - 1) + (before is not None and before + initial not in LEGAL)
        out["turns"] += own_turn is not None and own_turn != turn
        before, turn = initial, own_turn
        symbols.append((glr.Row(initial, must_go, is_cut and not must_go), n))
    numbered = [row[1] for row in rows if row[1] is not None]
    paths = [
        {"start": start, "stop": stop, "cost": cost, "edits": edits}
        for start in starts
        for stop, cost, edits in repair.paths(symbols, start)
    ]
    return out | {
        "first": rows[0][2][:1], "last": before, "first_turn": numbered[0] if numbered else None,
        "last_turn": numbered[-1] if numbered else None, "paths": paths,
        "keys": [{"turn": row[1], "role": row[2], "digest": row[3]} for row in rows],
    }


def chained(units: DataFrame, costs: glr.Costs) -> DataFrame:
    """The path of each unit, with the number of each row's first message; a conversation's sums are in its last unit.

    A conversation's units come one by one; what is held of them are the edits of the paths still open, which are in
    proportion to the audit that is returned.
    """
    schema = units.select("conv", *[F.lit(None).cast(t).alias(n) for n, t in _typed(CHAIN)]).schema
    rows = units.drop("keys").repartition(shuffle_partitions(units), "conv").sortWithinPartitions("conv", "segment", "unit")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        repair = repairer(costs)
        every = (row for batch in batches for row in batch.to_pylist())
        out = []
        for _, own in groupby(every, key=lambda row: row["conv"]):
            out += _chain(repair, own)
            if len(out) >= 1024:
                yield pa.RecordBatch.from_pylist(out, schema=arrow)
                out = []
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=arrow)

    arrow = to_arrow_schema(schema)
    return rows.mapInArrow(run, schema)


def _chain(repair: glr.Repairer, units: Iterator[dict]) -> list[dict]:
    """Join the units of one conversation; see ``glr`` for why ranks and single pieces decide between audits."""
    front, total = {0: (0, 0)}, 0
    trail: list[dict[int, tuple[int, list[str]]]] = []
    out, sums, last = [], dict.fromkeys(("blank", "duplicate", "truncated", "illegal", "turns"), 0), None
    low = high = turn = None
    for unit in units:
        found: dict[int, tuple] = {}
        for path in unit["paths"]:
            if path["start"] in front:
                cost, rank = front[path["start"]]
                way = (cost + path["cost"], rank, glr.audit_of("".join(path["edits"])), path["start"], path["edits"])
                if path["stop"] not in found or way < found[path["stop"]]:
                    found[path["stop"]] = way
        audits = sorted({way[1:3] for way in found.values()})
        front = {stop: (way[0], audits.index(way[1:3])) for stop, way in found.items()}
        trail.append({stop: way[3:5] for stop, way in found.items()})
        for name in sums:
            sums[name] += unit[name]
        if last is not None and last + unit["first"] not in LEGAL:
            sums["illegal"] += 1
        last = unit["last"]
        if unit["first_turn"] is not None:
            sums["turns"] -= unit["first_turn"] == turn
            low, high, turn = unit["first_turn"] if low is None else low, unit["last_turn"], unit["last_turn"]
        out.append({"conv": unit["conv"], "segment": unit["segment"], "unit": unit["unit"]})
    stacks = tuple((stack, cost, rank) for stack, (cost, rank) in sorted(front.items()))
    place, added, closing = repair.ending(stacks)
    stack, total, _ = stacks[place]
    for row, back in zip(reversed(out), reversed(trail)):
        stack, row["pieces"] = back[stack]
    out[-1]["pieces"] = [*out[-1]["pieces"][:-1], out[-1]["pieces"][-1] + closing]
    number = 0
    for row in out:
        row["numbers"] = []
        for piece in row["pieces"]:
            row["numbers"].append(number)
            number += len(glr.audit_of(piece)) - piece.count("D")
    out[-1] |= {
        "gaps": 0 if low is None else high - low + 1 - sums.pop("turns"), "cost": total + added,
        "audit": "".join(glr.audit_of(piece) for row in out for piece in row["pieces"]),
        **{name: sums[name] for name in ("blank", "duplicate", "truncated", "illegal")},
    }
    return out


def messages_of(rows: DataFrame, edits: DataFrame) -> DataFrame:
    """The repaired conversations message by message: conv, number, edit (K, R or I), role and text."""
    schema = rows.select("conv", *[F.lit(None).cast(t).alias(n) for n, t in _typed(MESSAGE)]).schema
    texts = rows.where(F.rtrim("text", F.lit(SPACES)) != "").select(
        "conv", "turn", "role", digest_of(F.col("text")).alias("digest"), "text"
    )
    both = edits.withColumn("kind", F.lit(0)).unionByName(
        texts.mapInArrow(_fewer_copies, texts.schema).withColumn("kind", F.lit(1)), allowMissingColumns=True
    )
    wanted = ["conv", "turn", "role", "digest", "kind", "piece", "number", "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The edits of a place come before its texts, of which the first serves. A row that goes and has messages
        # inserted after it needs none.
        place, piece, number = None, None, 0
        for batch in batches:
            out = []
            for conv, turn, role, digest, kind, own, at, text in zip(*(batch.column(c).to_pylist() for c in wanted)):
                if kind == 0:
                    place, piece, number = (conv, turn, role, digest), own, at
                    if "K" not in piece and "R" not in piece:
                        out += _messages(conv, number, piece, role, "")
                        piece = None
                elif piece is not None and place == (conv, turn, role, digest):
                    out += _messages(conv, number, piece, role, text)
                    piece = None
            yield pa.RecordBatch.from_pylist(out, schema=arrow)

    arrow = to_arrow_schema(schema)
    return in_order(both.select(*wanted), "kind").mapInArrow(run, schema)


def _fewer_copies(batches: Iterator[pa.RecordBatch], held: int = 1 << 14) -> Iterator[pa.RecordBatch]:
    """Drop rows that this task has seen not long ago, so that many copies are few before the shuffle."""
    seen: dict[tuple, None] = {}
    for batch in batches:
        fresh = []
        for key in zip(*(batch.column(c).to_pylist() for c in KEY)):
            fresh.append(key not in seen)
            seen[key] = None
            if len(seen) > held:
                del seen[next(iter(seen))]
        yield batch.filter(pa.array(fresh, pa.bool_()))


def _messages(conv, number: int, piece: str, role: str, text: str) -> list[dict]:
    out, i = [], 0
    while i < len(piece):
        letter, i = piece[i], i + 1
        if letter == "D":
            continue
        message = {"conv": conv, "number": number + len(out), "edit": letter, "role": role, "text": text}
        if letter in "RI":
            message["role"], i = ROLES[piece[i]], i + 1
            message["text"] = text if letter == "R" else ""
        out.append(message)
    return out


class Repaired:
    """What ``repair`` found; both tables are in the shared folder."""

    def __init__(self, conversations: DataFrame, messages: DataFrame):
        #: conv, gaps, blank, duplicate, truncated, illegal, cost, audit; only conversations that have rows.
        self.conversations = conversations
        #: conv, number, edit, role, text.
        self.messages = messages


def repair(
    rows: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    costs: glr.Costs = glr.Costs(),
    unit_rows: int = UNIT_ROWS,
) -> Repaired:
    """Repair every conversation at the least cost; of equally cheap ways the one with the ASCII-least audit.

    Rows are taken by turn (null first), then role, then SHA-256 of the text; a null conversation is one like any
    other. Null roles and texts count as one space. Rows without text are blank; of rows of a conversation that agree
    in role and text all but the first are duplicates; both must go. A row whose last visible character is not one of
    ``.!?`` is truncated. Other columns are ignored, whatever their names. No rows give empty tables.

    An audit has a letter per row and is one value, so a conversation can have about two thousand million rows.
    """
    space = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    rows = rows.select(
        F.col(conv_col).alias("conv"), F.col(turn_col).cast("long").alias("turn"),
        space(role_col).alias("role"), space(text_col).alias("text"),
    )
    units = written(units_of(faults(rows), costs, unit_rows))
    chain = written(chained(units, costs))
    edits = (
        units.select("conv", "segment", "unit", "keys")
        .join(chain.select("segment", "unit", "pieces", "numbers"), ["segment", "unit"])
        .select("conv", F.inline(F.arrays_zip("keys", "pieces", "numbers")).alias("key", "piece", "number"))
        .where(F.col("piece").rlike("[KRI]"))
        .select("conv", "key.*", "piece", "number")
    )
    messages = written(messages_of(rows, edits))
    return Repaired(chain.where("audit IS NOT NULL").select("conv", *SUMMARY, "audit"), messages)


def text_hashes(messages: DataFrame) -> DataFrame:
    """SHA-256 of each conversation's ``role:text`` lines. A hash takes its lines one after the other, so each
    conversation is read by one task, as a stream that holds one line."""
    schema = messages.select("conv", F.lit("").alias("sha256")).schema
    lines = messages.select("conv", "number", F.concat("role", F.lit(":"), "text").alias("line"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, digest = None, None
        for batch in batches:
            out = []
            for own, number, line in zip(*(batch.column(c).to_pylist() for c in ("conv", "number", "line"))):
                if number == 0:
                    if digest:
                        out.append((conv, digest.hexdigest()))
                    conv, digest = own, hashlib.sha256()
                else:
                    digest.update(b"\n")
                digest.update(line.encode())
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], t) for i, t in enumerate(arrow.types)], schema=arrow)
        if digest:
            yield pa.RecordBatch.from_arrays([pa.array([conv], arrow.types[0]), pa.array([digest.hexdigest()])], schema=arrow)

    arrow = to_arrow_schema(schema)
    dealt = lines.repartition(shuffle_partitions(lines), "conv").sortWithinPartitions("conv", "number")
    return dealt.mapInArrow(run, schema)


def damaged(rows: DataFrame) -> DataFrame:
    """The conversations with faults put in by a checksum of ``conv_id:turn``; null columns but the ids become a space.

    Of 20 checksums 0 drops the row, 1 empties its text, 2 takes its ``.!?`` away, 3 repeats it, 4 makes it a user's.
    """
    space = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    draw = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn"))) % 20
    text, marked = space("text"), rows.select("conv_id", "turn", "role", "text", draw.alias("draw"))
    return (
        marked.where("draw <> 0")
        .select(
            "conv_id",
            "turn",
            F.when(F.col("draw") == 4, F.lit("user")).otherwise(space("role")).alias("role"),
            F.when(F.col("draw") == 1, F.lit("")).when(F.col("draw") == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
            F.explode(F.when(F.col("draw") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
        )
        .drop("copy")
    )


def repaired_summary(rows: DataFrame, damaged_rows: DataFrame) -> DataFrame:
    """One row per conversation of ``rows``: the faults of its damaged rows, the repair's cost, audit and text hash."""
    found = repair(damaged_rows)
    every = rows.select(F.col("conv_id").alias("conv")).distinct()
    out = (
        every.alias("e")
        .join(found.conversations.alias("c"), F.expr("e.conv <=> c.conv"), "left")
        .join(text_hashes(found.messages).alias("h"), F.expr("e.conv <=> h.conv"), "left")
    )
    return out.select(
        F.col("e.conv").alias("conv_id"),
        *[F.coalesce(F.col(f"c.{name}"), F.lit(0).cast("long")).alias(name) for name in SUMMARY],
        F.coalesce("c.audit", F.lit("")).alias("audit"),
        F.coalesce("h.sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )

"""Fill-in-middle examples: documents cut into prefix, middle and suffix and put together in another order.

Every Arrow batch goes through one column pipeline: the texts become lists of units, the lists are flattened with the
number of their parent, units get ordinals, the ordinals say which piece a unit belongs to, each piece's units are
gathered into lists again and joined. No row moves to another task. A long text is worked on in parts of about a
megabyte, cut between units, so memory follows the longest unit and the batch, not 40 times the longest text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.llm.words import byte_table

#: Marks before the prefix, the suffix and the middle.
MARKS = ("<P>", "<S>", "<M>")
PART_BYTES = 1 << 20
LETTER = byte_table(lambda b: 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A)
#: Bytes of a code point after its first.
INNER = byte_table(lambda b: 0x80 <= b <= 0xBF)

FIELDS = "n long, form string, prefix_chars long, middle_chars long, output string"


def draws(id_col: str, seed: int) -> list[Column]:
    """Four unsigned 32-bit numbers that depend on the id and the seed only; a null id counts as empty."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long").alias(f"h{i + 1}") for i in range(4)]


def unit_starts(data: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Where units begin in ``data``: a run of ASCII letters is one, any other code point is one.

    ``begins`` are the places where a text or a part of one begins; a unit never reaches across them.
    """
    letter = LETTER[data]
    start = ~INNER[data]
    start[1:] &= ~(letter[1:] & letter[:-1])
    start[begins[begins < len(data)]] = True
    return np.flatnonzero(start)


def part_ends(data: np.ndarray, limit: int) -> list[int]:
    """Ends of the parts of one text, each of about ``limit`` bytes and cut where a unit begins."""
    ends, at = [], limit
    while at < len(data):
        # The next place where a unit begins; a very long run of letters stays whole.
        while at < len(data):
            ahead = data[at - 1 : at + 4096]
            fresh = np.flatnonzero(~INNER[ahead[1:]] & ~(LETTER[ahead[1:]] & LETTER[ahead[:-1]]))
            if len(fresh):
                at += int(fresh[0])
                break
            at += len(ahead) - 1
        if at < len(data):
            ends.append(at)
            at += limit
    return [*ends, len(data)]


class Parts:
    """The texts of a batch in parts, each with its row, and groups of neighbouring parts of bounded size."""

    def __init__(self, texts: pa.LargeStringArray, limit: int):
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        self.buffer = texts.buffers()[2] or pa.py_buffer(b"")
        self.data = np.frombuffer(self.buffer, np.uint8)
        begins, ends, rows = [], [], []
        for row in range(len(texts)):
            a, b = int(offsets[row]), int(offsets[row + 1])
            cuts = [b] if b - a <= limit else [a + x for x in part_ends(self.data[a:b], limit)]
            begins += [a, *cuts[:-1]]
            ends += cuts
            rows += [row] * len(cuts)
        self.begins, self.ends, self.rows = (np.array(x, np.int64) for x in (begins, ends, rows))
        self.limit = limit

    def groups(self, chosen: np.ndarray) -> Iterator[np.ndarray]:
        """The numbers of the ``chosen`` parts in runs that hold about ``limit`` bytes."""
        sizes = np.cumsum(self.ends[chosen] - self.begins[chosen])
        marks = np.flatnonzero(np.diff(sizes // self.limit, prepend=0))
        yield from (g for g in np.split(chosen, marks) if len(g))

    def units(self, group: np.ndarray) -> pa.ListArray:
        """For each part of the group the list of its units."""
        sizes = self.ends[group] - self.begins[group]
        first = np.concatenate(([0], np.cumsum(sizes)))
        data = np.concatenate([self.data[a:b] for a, b in zip(self.begins[group], self.ends[group])])
        starts = unit_starts(data, first[:-1])
        bounds = np.append(starts, len(data)).astype(np.int32)
        flat = pa.StringArray.from_buffers(len(starts), pa.py_buffer(bounds), pa.py_buffer(data))
        return pa.ListArray.from_arrays(pa.array(np.searchsorted(starts, first).astype(np.int32)), flat)


def joined_lists(values: pa.Array, counts: np.ndarray) -> pa.Array:
    """The texts of ``values`` joined in runs of ``counts``."""
    bounds = pa.array(np.concatenate(([0], np.cumsum(counts))).astype(np.int32))
    return pc.binary_join(pa.ListArray.from_arrays(bounds, values), pa.scalar("", values.type))


def pieces(parts: Parts, lows: np.ndarray, highs: np.ndarray, wanted: np.ndarray, n_rows: int) -> list[pa.Array]:
    """Prefix, middle and suffix of each wanted row (others: empty)."""
    chosen = np.flatnonzero(wanted[parts.rows])
    joined: list[list[pa.Array]] = [[], [], []]
    row, before = -1, 0
    for group in parts.groups(chosen):
        units = parts.units(group)
        flat, parent = pc.list_flatten(units), pc.list_parent_indices(units)
        lengths = np.asarray(pc.list_value_length(units))
        # Ordinals of a part's first unit: what the parts of the same row before it have.
        bases = np.zeros(len(group), np.int64)
        for i, (own, size) in enumerate(zip(parts.rows[group], lengths)):
            row, before = (own, before) if own == row else (own, 0)
            bases[i], before = before, before + size
        shift = pa.array(bases - np.asarray(units.offsets)[:-1])
        ordinal = pc.add(pa.array(np.arange(len(flat))), pc.take(shift, parent))
        low = pc.take(pa.array(lows[parts.rows[group]]), parent)
        high = pc.take(pa.array(highs[parts.rows[group]]), parent)
        roles = [
            pc.less(ordinal, low),
            pc.and_(pc.greater_equal(ordinal, low), pc.less(ordinal, high)),
            pc.greater_equal(ordinal, high),
        ]
        for out, role in zip(joined, roles):
            counts = np.bincount(np.asarray(pc.filter(parent, role)), minlength=len(group))
            out.append(joined_lists(pc.filter(flat, role), counts).cast(pa.large_string()))
    per_row = np.bincount(parts.rows[chosen], minlength=n_rows)
    none = pa.array([], pa.large_string())
    return [joined_lists(pa.concat_arrays([none, *out]), per_row) for out in joined]


def transformed(
    texts: pa.LargeStringArray, h: list[np.ndarray], plain_from: int, spm_below: int, marks: tuple[str, str, str], limit: int
) -> list[pa.Array]:
    """The columns of ``FIELDS`` for some texts and their four draws."""
    parts = Parts(texts, limit)
    sizes = np.zeros(len(parts.rows), np.int64)
    for group in parts.groups(np.arange(len(parts.rows))):
        sizes[group] = np.asarray(pc.list_value_length(parts.units(group)))
    n = np.bincount(parts.rows, weights=sizes, minlength=len(texts)).astype(np.int64)
    one, other = h[0] % (n + 1), h[1] % (n + 1)
    held = [np.asarray(pc.match_substring(texts, mark), bool) for mark in marks]
    plain = (n == 0) | held[0] | held[1] | held[2] | (h[2] % 100 >= plain_from)
    spm = h[3] % 100 < spm_below
    cut = pieces(parts, np.minimum(one, other), np.maximum(one, other), ~plain, len(texts))
    prefix, middle, suffix = (x.cast(pa.large_string()) for x in cut)
    first, then, last = (pa.scalar(m, pa.large_string()) for m in marks)
    empty = pa.scalar("", pa.large_string())
    as_psm = pc.binary_join_element_wise(first, prefix, then, suffix, last, middle, empty)
    as_spm = pc.binary_join_element_wise(then, suffix, first, prefix, last, middle, empty)
    is_plain, is_spm = pa.array(plain), pa.array(spm)
    none = pa.scalar(None, pa.int64())
    return [
        pa.array(n),
        pc.if_else(is_plain, "plain", pc.if_else(is_spm, "spm", "psm")),
        pc.if_else(is_plain, none, pc.utf8_length(prefix)),
        pc.if_else(is_plain, none, pc.utf8_length(middle)),
        pc.if_else(is_plain, texts, pc.if_else(is_spm, as_spm, as_psm)).cast(pa.string()),
    ]


def fill_in_middle(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    seed: int = 1,
    plain_percent: int = 10,
    spm_percent: int = 20,
    marks: tuple[str, str, str] = MARKS,
    part_bytes: int = PART_BYTES,
    keep_row: bool = False,
) -> DataFrame:
    """One training example per row: id, n (units of the text), form, prefix_chars, middle_chars and output.

    The cuts lie between units and, like the form, depend on the id, the seed and n only. Rows with the same id and
    text give the same example; a null id is an id like any other. Null or empty text, or text that holds a mark,
    stays as it is (``plain``; null becomes empty). An empty table gives no rows. Other columns are ignored, whatever
    their names, or come along as the struct ``row`` if ``keep_row`` is set.
    """
    carried = [F.struct("*").alias("row")] if keep_row else []
    ready = docs.select(
        F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), *draws(id_col, seed), *carried
    )
    kept = ["id", *(["row"] if keep_row else [])]
    fields = [f.split() for f in FIELDS.split(", ")]
    schema = ready.select(*kept, *[F.lit(None).cast(t).alias(name) for name, t in fields]).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = lambda name, batch=batch: batch.column(batch.schema.get_field_index(name))
            texts = pc.cast(column("text"), pa.large_string())
            h = [np.asarray(column(f"h{i}"), np.int64) for i in range(1, 5)]
            made = transformed(texts, h, 100 - plain_percent, spm_percent, marks, part_bytes)
            yield pa.RecordBatch.from_arrays([*map(column, kept), *made], names=[*kept, *[f for f, _ in fields]])

    return ready.mapInArrow(run, schema)


def restored(output: Column, form: Column, marks: tuple[str, str, str] = MARKS) -> Column:
    """The text an example was made from, read off its output and form alone.

    A cut text holds no mark, so the first mark of each kind after the leading one is the one that was put there.
    """
    prefix, suffix, middle = (F.lit(m) for m in marks)

    def pieces_of(lead: Column, inner: Column) -> tuple[Column, Column, Column]:
        body = F.substr(output, F.length(lead) + 1)
        at = F.instr(body, inner)
        rest = F.substr(body, at + F.length(inner))
        end = F.instr(rest, middle)
        return F.substr(body, F.lit(1), at - 1), F.substr(rest, F.lit(1), end - 1), F.substr(rest, end + F.length(middle))

    p, s, m = pieces_of(prefix, suffix)
    psm = F.concat(p, m, s)
    s, p, m = pieces_of(suffix, prefix)
    spm = F.concat(p, m, s)
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)

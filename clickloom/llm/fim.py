"""Fill-in-the-middle texts, cut by memoized content-defined chunks.

A rolling hash over the last 32 bytes ends a chunk where it hits a fixed pattern, so copies
and shared passages fall into equal chunks wherever they stand. A bounded cache in each task
keeps what a chunk adds to a count of units: how many it starts, and whether it begins and
ends inside one. The cache is keyed by the chunk's bytes, so a hit is a verified equality. A
document's count is the sum of its chunks', and a cut is found by counting in the one chunk
that holds it. The cache only saves work; what falls out of it is counted again.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import text_of

# The marks around the parts.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
# Documents that are cut, of a hundred, and of those that are cut, the ones told suffix first.
RATE, SUFFIX_FIRST = 90, 20

WINDOW = 32
CHUNK_BITS = 10  # a chunk in 1,024 bytes, on average
LONGEST = 1 << 14
SEGMENT = 1 << 22
CACHE_BYTES = 1 << 26

_GEAR = np.random.default_rng(12).integers(1 << 32, size=256, dtype=np.uint32)
_ODD = 0x9E3779B1


def chunk_ends(data: np.ndarray) -> np.ndarray:
    """Where chunks end. The hash of a window is a polynomial over its bytes, doubled up in
    five steps; no chunk is longer than ``LONGEST`` bytes."""
    found = []
    for begin in range(0, len(data), SEGMENT):
        lead = min(begin, WINDOW - 1)
        rolled, factor, width = _GEAR[data[begin - lead:begin + SEGMENT]], _ODD, 1
        while width < WINDOW:
            wider = rolled.copy()
            wider[width:] += rolled[:-width] * np.uint32(factor)
            rolled, factor, width = wider, factor * factor % (1 << 32), 2 * width
        found.append(np.flatnonzero(rolled[lead:] >> np.uint32(32 - CHUNK_BITS) == 0) + begin + 1)
    ends = np.unique(np.concatenate([*found, [len(data)]])) if len(data) else np.zeros(0, np.int64)
    starts = np.concatenate([[0], ends[:-1]])
    long = np.flatnonzero(ends - starts > LONGEST)
    more = [np.arange(starts[i] + LONGEST, ends[i], LONGEST) for i in long]
    return np.unique(np.concatenate([ends, *more])).astype(np.int64)


def _char_bytes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes that start a code point, and bytes that go on with one."""
    goes_on = (data & 0xC0) == 0x80
    return ~goes_on, goes_on


def _word_bytes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A word starts at a byte that is no white space and follows one that is, or nothing."""
    inside = (data != 32) & ((data < 9) | (data > 13))
    return inside, inside


# What starts a unit, unless it only goes on with the one before.
UNITS = {"char": _char_bytes, "word": _word_bytes}


def unit_starts(data: np.ndarray, unit: str, inside: bool) -> np.ndarray:
    """Places where units start; ``inside`` says that the byte before belongs to a word."""
    may_start, _ = UNITS[unit](data)
    if unit == "word":
        before = np.concatenate([[inside], may_start[:-1]])
        may_start = may_start & ~before
    return np.flatnonzero(may_start)


@dataclass(frozen=True)
class Summary:
    """What a chunk adds: units started, and whether its first and last byte lie in one."""

    starts: int
    opens: bool
    ends: bool


class ChunkCache:
    """Summaries by content, in two generations of at most half of ``CACHE_BYTES`` each."""

    def __init__(self, unit: str) -> None:
        self.unit, self.hits, self.misses = unit, 0, 0
        self._young: dict[bytes, Summary] = {}
        self._old: dict[bytes, Summary] = {}
        self._size = 0

    def summary(self, chunk: bytes) -> Summary:
        found = self._young.get(chunk)
        if found is not None:
            self.hits += 1
            return found
        found = self._old.get(chunk)
        if found is None:
            self.misses += 1
            data = np.frombuffer(chunk, np.uint8)
            _, goes_on = UNITS[self.unit](data)
            found = Summary(len(unit_starts(data, self.unit, False)), bool(goes_on[0]), bool(goes_on[-1]))
        else:
            self.hits += 1
        if self._size > CACHE_BYTES // 2:
            self._old, self._young, self._size = self._young, {}, 0
        self._young[chunk] = found
        self._size += len(chunk) + 200
        return found


class Cutter:
    """Counts the units of a text and finds cuts, chunk by chunk."""

    def __init__(self, unit: str = "char") -> None:
        self.unit, self.cache = unit, ChunkCache(unit)

    def __call__(self, text: bytes) -> Counted:
        data = np.frombuffer(text, np.uint8)
        ends = chunk_ends(data)
        counts, inside, before = [], [], False
        begin = 0
        for end in ends.tolist():
            part = self.cache.summary(text[begin:end])
            # a word that goes on from the chunk before starts there, not here
            goes_on = self.unit == "word" and before and part.opens
            counts.append(part.starts - goes_on)
            inside.append(before)
            begin, before = end, part.ends
        return Counted(data, self.unit, ends, np.cumsum(counts, dtype=np.int64), inside)


@dataclass(frozen=True)
class Counted:
    data: np.ndarray
    unit: str
    ends: np.ndarray
    running: np.ndarray
    inside: list[bool]

    @property
    def units(self) -> int:
        return int(self.running[-1]) if len(self.running) else 0

    def byte_of(self, unit: int) -> int:
        """Where the part behind the first ``unit`` units begins."""
        if unit <= 0:
            return 0
        if unit >= self.units:
            return len(self.data)
        chunk = int(np.searchsorted(self.running, unit, side="right"))
        begin = int(self.ends[chunk - 1]) if chunk else 0
        earlier = int(self.running[chunk - 1]) if chunk else 0
        starts = unit_starts(self.data[begin:int(self.ends[chunk])], self.unit, self.inside[chunk])
        return begin + int(starts[unit - earlier])


def _draws(doc_id: Column, seed: int) -> list[Column]:
    """Four numbers below 2 ** 32 from a digest of the id; a null id counts as empty text."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    digest = F.sha2(text.cast("binary"), 256)
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4)]


RESULT = ("n", "form", "prefix_units", "middle_units", "output")


def fill_in_middle(docs: DataFrame, unit: str = "char", seed: int = 1, rate: int = RATE,
                   suffix_first: int = SUFFIX_FIRST) -> DataFrame:
    """Adds ``n`` (units of the text), ``form``, ``prefix_units``, ``middle_units`` and
    ``output`` to the columns of ``docs``, replacing columns of these names.

    A text is cut before two units drawn from its doc_id. ``psm`` puts out prefix, suffix,
    middle, ``spm`` suffix, prefix, middle, each behind its mark; ``plain`` the text itself,
    for empty and null texts, those that hold a mark, and the share that is not drawn. Units
    are code points (``char``) or words (``word``; white space belongs to the word before,
    at the text's start to the first). Rows that repeat a doc_id draw alike; a null doc_id
    draws as empty text. Rows keep their number.
    """
    text = text_of()
    h1, h2, h3, h4 = _draws(F.col("doc_id"), seed)

    @F.arrow_udf("n long, first long, second long, first_byte long, second_byte long")
    def cuts(parts: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        cutter = Cutter(unit)
        for texts, *draws in parts:
            rows = []
            for value, *drawn in zip(texts, *draws, strict=True):
                counted = cutter(value.as_py())
                ends = sorted(d.as_py() % (counted.units + 1) for d in drawn)
                rows.append((counted.units, *ends, *(counted.byte_of(e) for e in ends)))
            columns = zip(*rows, strict=True) if rows else ([],) * 5
            yield pa.StructArray.from_arrays(
                [pa.array(c, pa.int64()) for c in columns],
                ["n", "first", "second", "first_byte", "second_byte"])

    data = text.cast("binary")
    marked = F.contains(text, F.lit(PREFIX)) | F.contains(text, F.lit(SUFFIX)) | F.contains(text, F.lit(MIDDLE))
    form = (
        F.when((F.octet_length(text) == 0) | marked | (h3 % 100 >= rate), "plain")
        .when(h4 % 100 < suffix_first, "spm").otherwise("psm")
    )
    kept = [c for c in docs.columns if c not in RESULT]
    own = docs.select(F.struct(*docs.columns).alias("row"), "doc_id", "text")
    at = own.select("row", data.alias("data"), form.alias("form"), cuts(data, h1, h2).alias("at"))
    size, first, second = F.octet_length("data"), F.col("at.first_byte"), F.col("at.second_byte")
    prefix = F.substring("data", F.lit(1), first.cast("int"))
    middle = F.substring("data", (first + 1).cast("int"), (second - first).cast("int"))
    suffix = F.substring("data", (second + 1).cast("int"), (size - second).cast("int"))
    p, s, m = (F.lit(mark).cast("binary") for mark in (PREFIX, SUFFIX, MIDDLE))
    output = (
        F.when(F.col("form") == "psm", F.concat(p, prefix, s, suffix, m, middle))
        .when(F.col("form") == "spm", F.concat(s, suffix, p, prefix, m, middle))
        .otherwise(F.col("data"))
    )
    cut = F.col("form") != "plain"
    return at.select(
        *[F.col(f"row.`{c}`") for c in kept], F.col("at.n").alias("n"), "form",
        F.when(cut, F.col("at.first")).alias("prefix_units"),
        F.when(cut, F.col("at.second") - F.col("at.first")).alias("middle_units"),
        output.cast("string").alias("output"))


def restored(output: Column, form: Column) -> Column:
    """The text, from the output and its form alone: a cut text holds each mark once."""
    parts = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)
    first, second, third = (F.get(parts, F.lit(i)) for i in (1, 2, 3))
    return (
        F.when(form == "psm", F.concat(first, third, second))
        .when(form == "spm", F.concat(second, third, first)).otherwise(output)
    )

"""First-fit decreasing packing of token sequences.

A document's ids are cut into pieces of one sequence's length and a tail. Pieces are dealt
at random into groups of bounded size; each group is packed on its own by first-fit
decreasing, where a tournament tree over the free room of the bins finds the first bin
that fits. Only the lengths of pieces are shuffled, unless the ids are asked for.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import slices, stored, text_of
from clickloom.llm.subwords import subwords

CAPACITY = 1024
GROUP_PIECES = 16_384
END = b"\0\0\0\0"


class TournamentTree:
    """Free room of bins 0, 1, 2 ...; each inner node holds the larger of its children."""

    def __init__(self, bins: int, capacity: int) -> None:
        self.leaves = 1 << max(0, bins - 1).bit_length()
        self.room = [capacity] * (2 * self.leaves)

    def place(self, size: int) -> tuple[int, int]:
        """Takes ``size`` from the first bin with room; its number and its room before."""
        room, at = self.room, 1
        while at < self.leaves:
            at *= 2
            if room[at] < size:
                at += 1
        free, leaf = room[at], at - self.leaves
        room[at] = free - size
        at //= 2
        while at:
            best = max(room[2 * at], room[2 * at + 1])
            if room[at] == best:
                break
            room[at] = best
            at //= 2
        return leaf, free


def first_fit_decreasing(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each piece; pieces of equal length keep their order."""
    order = np.argsort(-lengths, kind="stable")
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    full = int(np.count_nonzero(lengths >= capacity))
    bins[order[:full]] = np.arange(full)
    tree = TournamentTree(max(1, len(lengths) - full), capacity)
    for i in order[full:].tolist():
        at, free = tree.place(int(lengths[i]))
        bins[i], offsets[i] = full + at, capacity - free
    return bins, offsets


def pieces(docs: DataFrame, tokenizer: str = "byte_bpe_50k", capacity: int = CAPACITY,
           ids: bool = False) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens and, if asked for, ids of each piece.

    Every document ends with id 0, so an empty or null text has one id. Whole texts are
    encoded; repeated rows and null doc_ids are documents of their own.
    """
    schema = "doc_id {}, start long, length long, ids_crc32 long, doc_tokens long".format(
        docs.schema["doc_id"].dataType.simpleString()) + (", ids binary" if ids else "")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = subwords(tokenizer).encode
        for batch in slices(batches, 512, "text"):
            rows: list[list] = [[] for _ in range(6)]
            for doc, text in zip(batch.column("doc_id"), batch.column("text"), strict=True):
                encoded = encode(text.as_py()) + END
                total = len(encoded) // 4
                for start in range(0, total, capacity):
                    piece = encoded[4 * start:4 * (start + capacity)]
                    found = (doc, start, len(piece) // 4, zlib.crc32(piece), total, piece)
                    for column, value in zip(rows, found, strict=True):
                        column.append(value)
            arrays = [pa.array([x.as_py() for x in rows[0]], batch.column("doc_id").type),
                      *[pa.array(x, pa.int64()) for x in rows[1:5]]]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
            if ids:
                arrays, names = [*arrays, pa.array(rows[5], pa.binary())], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(arrays, names)

    return docs.select("doc_id", text_of().alias("text")).mapInArrow(cut, schema)


def pack(docs: DataFrame, tokenizer: str = "byte_bpe_50k", capacity: int = CAPACITY,
         group_pieces: int = GROUP_PIECES, ids: bool = False) -> DataFrame:
    """The pieces with sequence_id and offset; no sequence exceeds ``capacity``.

    An empty table gives no rows; columns other than doc_id and text are not read.
    """
    cut = stored(pieces(docs, tokenizer, capacity, ids), "pieces")
    groups = max(1, -(-cut.count() // group_pieces))
    dealt = cut.withColumn("_group", F.pmod(
        F.xxhash64("doc_id", "start", "ids_crc32", "doc_tokens"), F.lit(groups)))

    def place(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["start", "ids_crc32", "doc_tokens"], kind="stable")
        bins, offsets = first_fit_decreasing(rows["length"].to_numpy(), capacity)
        group = int(rows["_group"].iloc[0])
        return rows.drop(columns="_group").assign(
            sequence_id=(group << 32) + bins, offset=offsets)

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in cut.schema]
    return dealt.groupBy("_group").applyInPandas(
        place, ", ".join([*fields, "sequence_id long", "offset long"]))

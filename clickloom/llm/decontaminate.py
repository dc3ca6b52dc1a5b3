"""Benchmark decontamination by edit distance.

An item-sized window of words and a benchmark item are embedded by CGK random walks, which
turn edit distance into Hamming distance; bit sampling over the embeddings, repeated until
the target recall is reached, proposes pairs of window and item, and an exact edit distance
decides. Windows are placed where a document shares unbroken runs of words with an item;
within the threshold there always is one of at least ``floor(n / (edits + 1))`` words, and
an edit breaks at most as many runs as a run has words, so this placement loses nothing.
All work is a map over the documents.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import slices, text_of

WORD = re.compile(r"\w+")
SIMILARITY = 0.8
RECALL = 0.99
GRAM = 3
SHORT_WORD = 5  # bytes
# Items that one pass over the documents holds; more items take more passes.
BLOCK_ITEMS = 2000
BLOCK_BYTES = 8 << 20
MAX_REPEATS = 192
PAD = np.uint32(0)


# ASCII and the bytes of Latin letters from U+00C0 on, whose words can be cut as bytes.
_PLAIN = bytes([*range(128), 0xC3, *range(0x80, 0xC0)])
_SPACED = bytes(b if b > 127 or chr(b).isalnum() or b == 0x5F else 32 for b in range(256))


def words_of(text: str) -> list[bytes]:
    """Runs of word characters in lower case, as UTF-8."""
    data = text.lower().encode()
    if not data.translate(None, _PLAIN) and b"\xc3\x97" not in data and b"\xc3\xb7" not in data:
        return data.translate(_SPACED).split()
    return [w.encode() for w in WORD.findall(text.lower())]


def symbols(words: list[bytes]) -> np.ndarray:
    return np.array([zlib.crc32(w) | 1 for w in words], np.uint32)


def allowed_edits(n: int, similarity: float = SIMILARITY) -> int:
    return int((1 - similarity) * n + 1e-9)


def cgk(rows: np.ndarray, seeds: np.ndarray, steps: int) -> np.ndarray:
    """Random-walk embeddings of equally long rows of symbols: (rows, seeds, steps).

    A walk writes the symbol it stands on and moves on by a random bit of the repeat, the
    step and that symbol.
    """
    count, n = rows.shape
    padded = np.concatenate([rows, np.full((count, 1), PAD, np.uint32)], axis=1)
    at = np.zeros((count, len(seeds)), np.int64)
    line = np.arange(count)[:, None]
    out = np.empty((count, len(seeds), steps), np.uint32)
    for step in range(steps):
        now = padded[line, at]
        out[:, :, step] = now
        mixed = (now ^ seeds[None, :]) * np.uint32(2654435761) + np.uint32(step * 2246822519 % (1 << 32))
        mixed = (mixed ^ (mixed >> np.uint32(15))) * np.uint32(3266489917)
        at = np.minimum(at + ((mixed >> np.uint32(16)) & np.uint32(1)), n)
    return out


def edit_distance(item: list[bytes], text: list[bytes], most: int) -> tuple[int, int, int]:
    """Least edits that turn the item into a run of words of ``text``, and that run.

    Gives (most + 1, 0, 0) if it takes more than ``most``.
    """
    previous = [(0, j) for j in range(len(text) + 1)]
    for i, word in enumerate(item, 1):
        row = [(i, 0)]
        for j, other in enumerate(text, 1):
            cost, start = previous[j - 1]
            best = (cost + (word != other), start)
            up, left = previous[j], row[j - 1]
            if up[0] + 1 < best[0]:
                best = (up[0] + 1, up[1])
            if left[0] + 1 < best[0]:
                best = (left[0] + 1, left[1])
            row.append(best)
        previous = row
        if min(previous)[0] > most:
            return most + 1, 0, 0
    distance, start, end = min((c, s, j) for j, (c, s) in enumerate(previous))
    return (distance, start, end) if distance <= most else (most + 1, 0, 0)


class Index:
    """Benchmark items of one block: runs of words, and CGK signatures by item length."""

    def __init__(self, items: list[tuple[int, str]], similarity: float = SIMILARITY,
                 recall: float = RECALL, seed: int = 11) -> None:
        self.items = [(i, w) for i, w in ((i, words_of(t)) for i, t in items) if w]
        self.similarity, self.recall = similarity, recall
        self.grams: dict[int, dict[tuple, list[tuple[int, int]]]] = defaultdict(lambda: defaultdict(list))
        self.lengths: dict[int, list[int]] = defaultdict(list)
        self.needed = []
        for k, (_, w) in enumerate(self.items):
            n = min(GRAM, len(w) // (allowed_edits(len(w), similarity) + 1))
            # An edit breaks at most n of the runs, so that many stay. Runs of short, hence
            # common, words are not looked for as long as one other is sure to stay.
            runs = sorted(range(len(w) - n + 1), key=lambda at: -max(map(len, w[at:at + n])))
            needed = max(1, len(runs) - n * allowed_edits(len(w), similarity))
            while needed > 1 and max(map(len, w[runs[-1]:runs[-1] + n])) <= SHORT_WORD:
                runs.pop()
                needed -= 1
            for at in runs:
                self.grams[n][tuple(w[at:at + n])].append((k, at))
            self.lengths[len(w)].append(k)
            self.needed.append(needed)
        self.grams = {n: dict(g) for n, g in self.grams.items()}
        # A run can only be where its longest word is: its length and that word's place in it.
        anchors: dict[bytes, set[tuple[int, int]]] = defaultdict(set)
        for n, grams in self.grams.items():
            for gram in grams:
                longest = max(range(n), key=lambda i: (len(gram[i]), gram[i]))
                anchors[gram[longest]].add((n, longest))
        self.anchors = {w: tuple(places) for w, places in anchors.items()}
        self.anchor_words = frozenset(anchors)
        random = np.random.default_rng(seed)
        self.tables = {n: self._table(n, ks, random) for n, ks in self.lengths.items()}

    def _table(self, n: int, ks: list[int], random: np.random.Generator) -> tuple:
        """Seeds, sampled positions and buckets for items of ``n`` words.

        The share of equal positions of pairs at the threshold is measured on mutated
        items; it gives the number of repeats for the target recall.
        """
        rows = np.stack([symbols(self.items[k][1]) for k in ks])
        trial = random.integers(1, 1 << 32, 16, dtype=np.uint32)
        some = rows[: 16]
        changed = np.stack([_mutated(r, allowed_edits(n, self.similarity), random) for r in some])
        equal = (cgk(some, trial, 2 * n) == cgk(changed, trial, 2 * n)).mean()
        repeats = min(MAX_REPEATS, max(8, math.ceil(
            math.log(1 - self.recall) / math.log(1 - min(0.95, float(equal) ** 2 / 2 + 1e-6)))))
        seeds = random.integers(1, 1 << 32, repeats, dtype=np.uint32)
        at = random.integers(0, 2 * n, (repeats, 2))
        buckets: dict[tuple, list[int]] = defaultdict(list)
        for k, row in zip(ks, _sampled(rows, seeds, at, n), strict=True):
            for rep, signature in enumerate(row.tolist()):
                buckets[rep, *signature].append(k)
        return seeds, at, dict(buckets)

    def near(self, windows: np.ndarray) -> list[set[int]]:
        """Items that share a bucket with each window of equal length."""
        n = windows.shape[1]
        seeds, at, buckets = self.tables[n]
        found = []
        for row in _sampled(windows, seeds, at, n):
            hit: set[int] = set()
            for rep, signature in enumerate(row.tolist()):
                hit.update(buckets.get((rep, *signature), ()))
            found.append(hit)
        return found

    def matches(self, text: str) -> list[tuple[int, int, int, int]]:
        """(item, edits, first word, words) of each item found in the text, best match each."""
        words = words_of(text)
        here = self.anchor_words.intersection(words)
        if not here:
            return []
        starts: dict[int, set[int]] = defaultdict(set)
        offsets: dict[int, set[int]] = defaultdict(set)
        for at in [i for i, w in enumerate(words) if w in here]:
            for n, place in self.anchors[words[at]]:
                pos = at - place
                hits = self.grams[n].get(tuple(words[pos:pos + n])) if pos >= 0 else None
                if hits:
                    for k, offset in hits:
                        starts[k].add(pos - offset)
                        offsets[k].add(offset)
        starts = {k: v for k, v in starts.items() if len(offsets[k]) >= self.needed[k]}
        if not starts:
            return []
        by_length: dict[int, dict[int, list[int]]] = defaultdict(lambda: defaultdict(list))
        for k, found in starts.items():
            for start in found:
                by_length[len(self.items[k][1])][start].append(k)
        coded = symbols(words)
        best: dict[int, tuple[int, int, int]] = {}
        for n, at_start in by_length.items():
            ordered = sorted(at_start)
            for begin in range(0, len(ordered), 64):
                some = ordered[begin:begin + 64]
                windows = np.full((len(some), n), PAD, np.uint32)
                for row, start in enumerate(some):
                    part = coded[max(0, start):max(0, start + n)]
                    windows[row, :len(part)] = part
                for start, items in zip(some, self.near(windows), strict=True):
                    # a window serves every item of its length in a common bucket
                    for k in items:
                        self._verify(words, start, k, best)
        return [(self.items[k][0], *v) for k, v in sorted(best.items())]

    def _verify(self, words: list[bytes], start: int, k: int, best: dict) -> None:
        if k in best and best[k][0] == 0:
            return
        item = self.items[k][1]
        most = allowed_edits(len(item), self.similarity)
        low = max(0, start - most)
        if start >= 0 and words[start:start + len(item)] == item:
            best[k] = (0, start, len(item))
            return
        cost, a, b = edit_distance(item, words[low:max(0, start + len(item) + most)], most)
        if cost <= most and (k not in best or (cost, low + a) < best[k][:2]):
            best[k] = (cost, low + a, b - a)


def _sampled(rows: np.ndarray, seeds: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    embedded = cgk(rows, seeds, 2 * n)
    rep = np.arange(len(seeds))
    return np.stack([embedded[:, rep, at[:, i]] for i in range(at.shape[1])], axis=2)


def _mutated(row: np.ndarray, edits: int, random: np.random.Generator) -> np.ndarray:
    changed = row.tolist()
    for _ in range(edits):
        at, kind = int(random.integers(0, max(1, len(changed)))), int(random.integers(0, 3))
        fresh = int(random.integers(1, 1 << 32))
        if kind == 0:
            changed[at:at + 1] = [fresh]
        elif kind == 1:
            changed.insert(at, fresh)
        else:
            del changed[at:at + 1]
    changed = (changed + [0] * len(row))[:len(row)]
    return np.array(changed, np.uint32)


def blocks(benchmark: DataFrame) -> list[list[tuple[int, str]]]:
    """Benchmark items in blocks of bounded size; null texts hold nothing to find."""
    rows = benchmark.where(F.col("text").isNotNull()).select(
        "item_id", F.col("text").cast("string").alias("text"))
    made: list[list[tuple[int, str]]] = [[]]
    size = 0
    for r in rows.orderBy("item_id", "text").toLocalIterator():
        if len(made[-1]) >= BLOCK_ITEMS or (made[-1] and size + len(r["text"]) > BLOCK_BYTES):
            made.append([])
            size = 0
        made[-1].append((r["item_id"], r["text"]))
        size += len(r["text"])
    return [b for b in made if b]


def contaminated(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY,
                 recall: float = RECALL) -> DataFrame:
    """doc_id, item_id, edits, first_word, n_words of every item found in a document.

    An item is found if at most ``1 - similarity`` of its words are edited. Case and
    punctuation do not count. Rows come once per document row and item; null and empty
    texts hold nothing, and repeated rows are reported each. Other columns are not read.
    """
    doc_type = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", text_of().alias("text"))
    schema = f"doc_id {doc_type}, item_id long, edits int, first_word int, n_words int"
    found = None
    for block in blocks(benchmark):
        index = docs.sparkSession.sparkContext.broadcast(Index(block, similarity, recall))
        part = rows.mapInArrow(_search(index), schema)
        found = part if found is None else found.unionByName(part)
    return found if found is not None else docs.sparkSession.createDataFrame([], schema)


def _search(shared):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for batch in slices(batches, 1000, "text"):
            rows = [(doc.as_py(), *m) for doc, text in zip(
                batch.column("doc_id"), batch.column("text"), strict=True)
                for m in index.matches(text.as_py())]
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 5
            types = [batch.column("doc_id").type, pa.int64(), pa.int32(), pa.int32(), pa.int32()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)],
                ["doc_id", "item_id", "edits", "first_word", "n_words"])

    return search


def decontaminated(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY,
                   recall: float = RECALL) -> DataFrame:
    """The rows of ``docs`` in which no item is found, with all their columns."""
    kept = docs
    for block in blocks(benchmark):
        shared = docs.sparkSession.sparkContext.broadcast(Index(block, similarity, recall))

        def keep(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = shared.value
            for batch in slices(batches, 1000, "text"):
                clean = [not index.matches(x.as_py() or "") for x in batch.column("text")]
                yield batch.filter(pa.array(clean, pa.bool_()))

        kept = kept.mapInArrow(keep, docs.schema)
    return kept

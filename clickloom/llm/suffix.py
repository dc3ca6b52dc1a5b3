"""Suffix-array deduplication of repeated byte strings across a corpus.

Every byte covered by a string of ``length`` bytes that also starts elsewhere is removed.
A suffix array of all texts would not fit one machine, so windows of ``length`` bytes are
dealt by content: a window's anchor is its 32-gram of least hash. Equal windows have equal
anchors, so all copies of a window meet under one anchor hash, and runs of windows with one
anchor travel as one segment. Then:

1. segments of unrepeated anchors are dropped; equal segments are folded by count;
2. the distinct segments of an anchor that still differ go to one task, which builds their
   suffix array by two-stage sorting (suffixes smaller than their successors are sorted
   directly, the others are induced from them bucket by bucket), computes adjacent common
   prefixes and marks windows that share a whole window with a neighbour;
3. marked windows go back to their documents, whose covered bytes are removed.

An anchor with very many differing segments (the edge of a passage that a large share of
the corpus holds) does not go to one task; its windows are counted by two 64-bit hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import slices, stored, text_of

LENGTH = 200
GRAM = 32
PIECE_BYTES = 1 << 20  # of text that is hashed at once; positions in it take 20 bits
SORT_BYTES = 1 << 20  # of segments that one suffix array covers, if no anchor has more
CROWDED = 16_384  # distinct segments from which on an anchor is counted by hashes
SEPARATOR = 0xFF  # no byte of UTF-8


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return h ^ (h >> np.uint64(33))


def window_hashes(data: np.ndarray, length: int, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of each run of ``length`` bytes, by doubling."""
    factors = np.random.default_rng(97 + seed).integers(1 << 40, 1 << 63, 64, dtype=np.uint64) | np.uint64(1)
    count = len(data) - length + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    h, size, done, total = data.astype(np.uint64) + np.uint64(1), 1, 0, None
    level = 0
    while True:
        if length & size:
            part = h[done:done + count]
            total = part.copy() if total is None else total * factors[level + 32] + part
            done += size
        if done == length:
            return _mixed(total)
        h = h[:-size] * factors[level] + h[size:]
        size, level = 2 * size, level + 1


def anchor_runs(data: bytes, ends: list[int], length: int = LENGTH, gram: int = GRAM):
    """Segments of texts laid end to end: for each text, arrays of first window, number of
    windows, anchor's place and anchor's hash. Equal windows get anchors of equal hash at
    equal places. ``data`` holds at most PIECE_BYTES."""
    b = np.frombuffer(data, np.uint8)
    width = length - gram + 1
    if len(b) < length:
        return [None] * len(ends)
    hashes = window_hashes(b, gram)
    low = (hashes & ~np.uint64(PIECE_BYTES - 1)) | np.arange(len(hashes), dtype=np.uint64)
    size = 1
    while 2 * size <= width:
        low = np.minimum(low[:-size], low[size:])
        size *= 2
    if size < width:
        low = np.minimum(low[:len(low) - (width - size)], low[width - size:])
    runs, begin = [], 0
    for end in ends:
        if end - begin < length:
            runs.append(None)
        else:
            mine = low[begin:end - length + 1]
            first = np.concatenate([[0], np.flatnonzero(mine[1:] != mine[:-1]) + 1])
            count = np.diff(np.append(first, len(mine)))
            at = (mine[first] & np.uint64(PIECE_BYTES - 1)).astype(np.int64)
            runs.append((begin + first, count, at, hashes[at]))
        begin = end
    return runs


SEGMENTS = "k1 long, k2 long, lo int, n int, anchor long, content long"
_SEGMENTS = pa.schema([("k1", pa.int64()), ("k2", pa.int64()), ("lo", pa.int32()), ("n", pa.int32()),
                       ("anchor", pa.int64()), ("content", pa.int64())])


def segments(keyed: DataFrame, length: int = LENGTH) -> DataFrame:
    """Segments of every text: first window, number of windows, hash of anchor and content."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 4096, "text", PIECE_BYTES):
            k1, k2 = (batch.column(c).to_numpy() for c in ("k1", "k2"))
            texts = [x.as_buffer().to_pybytes() for x in batch.column("text")]
            for group, data, ends, shift in _pieces(texts, length):
                yield _rows(group, data, ends, shift, k1, k2, length)

    return keyed.select("k1", "k2", "text").mapInArrow(run, SEGMENTS)


def _pieces(texts: list[bytes], length: int):
    """Texts laid end to end up to PIECE_BYTES; a longer one in pieces that share all but
    one byte of a window, so that each window lies in exactly one piece."""
    group, parts, size = [], [], 0
    for i, text in enumerate(texts):
        if len(text) < length:
            continue
        if size and size + len(text) > PIECE_BYTES:
            yield group, b"".join(parts), np.cumsum([len(p) for p in parts]).tolist(), 0
            group, parts, size = [], [], 0
        if len(text) > PIECE_BYTES:
            step = PIECE_BYTES - length + 1
            for at in range(0, len(text) - length + 1, step):
                piece = text[at:at + PIECE_BYTES]
                yield [i], piece, [len(piece)], at
            continue
        group.append(i)
        parts.append(text)
        size += len(text)
    if group:
        yield group, b"".join(parts), np.cumsum([len(p) for p in parts]).tolist(), 0


def _rows(group, data, ends, shift, k1, k2, length) -> pa.RecordBatch:
    columns: list[list] = [[] for _ in range(6)]
    begin, digest, view = 0, xxhash.xxh3_64_intdigest, memoryview(data)
    for i, end, run in zip(group, ends, anchor_runs(data, ends, length), strict=True):
        if run is not None:
            first, count, _, anchor = run
            stop = first + count + (length - 1)
            content = [digest(view[a:b]) for a, b in zip(first.tolist(), stop.tolist(), strict=True)]
            for column, value in zip(columns, (
                    np.full(len(first), k1[i]), np.full(len(first), k2[i]), first - begin + shift,
                    count, anchor.view(np.int64), np.array(content, np.uint64).view(np.int64)), strict=True):
                column.append(value)
        begin = end
    arrays = [pa.array(np.concatenate(c) if c else [], type=f.type, safe=False)
              for c, f in zip(columns, _SEGMENTS, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, schema=_SEGMENTS)


def suffix_array(text: np.ndarray, depth: int = LENGTH) -> np.ndarray:
    """Suffixes in order of at least their first ``depth`` bytes, by two-stage sorting."""
    n = len(text)
    if n == 0:
        return np.zeros(0, np.int64)
    step = np.zeros(n, np.int8)
    step[:-1] = np.sign(text[1:].astype(np.int16) - text[:-1])
    step[-1] = -1  # the last suffix is greater than the empty one behind it
    decided = np.where(step != 0, np.arange(n), n - 1)
    smaller = step[np.minimum.accumulate(decided[::-1])[::-1]] > 0
    direct = _sorted_directly(text, np.flatnonzero(smaller), depth)
    first = text[direct]
    edges = np.searchsorted(first, np.arange(257))
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    waiting[text[-1]].append(np.array([n - 1]))
    placed = []
    for c in range(256):
        # Greater suffixes of this bucket: those induced by smaller buckets, then, in the
        # order of the scan, those induced inside the bucket by a run of one byte.
        larger = [np.concatenate(waiting[c])] if waiting[c] else []
        waiting[c] = []
        while larger and len(larger[-1]):
            before = larger[-1][larger[-1] > 0] - 1
            larger.append(before[text[before] == c])
        bucket = np.concatenate([*larger, direct[edges[c]:edges[c + 1]]])
        if not len(bucket):
            continue
        placed.append(bucket)
        before = bucket[bucket > 0] - 1
        byte = text[before]
        before, byte = before[byte > c], byte[byte > c]
        order = np.argsort(byte, kind="stable")
        before, byte = before[order], byte[order]
        cuts = np.flatnonzero(np.diff(byte)) + 1
        for part in np.split(before, cuts):
            if len(part):
                waiting[text[part[0]]].append(part)
    return np.concatenate(placed).astype(np.int64)


def _sorted_directly(text: np.ndarray, places: np.ndarray, depth: int) -> np.ndarray:
    """Buckets by the first two bytes, each sorted by comparison of its suffixes."""
    raw = text.tobytes()
    following = np.append(text, 0)[places + 1].astype(np.uint16)
    head = text[places].astype(np.uint16) << 8 | following
    order = np.argsort(head, kind="stable")
    places, head = places[order], head[order]
    cuts = np.flatnonzero(np.diff(head)) + 1
    done = []
    for part in np.split(places, cuts):
        if len(part) > 1:
            part = np.array(sorted(part.tolist(), key=lambda i: raw[i:i + depth]), np.int64)
        done.append(part)
    return np.concatenate(done) if done else places


def common_prefixes(text: np.ndarray, order: np.ndarray, depth: int = LENGTH) -> np.ndarray:
    """Common prefix, up to ``depth``, of each suffix with the one before it in order."""
    padded = np.concatenate([text, np.zeros(depth + 8, np.uint8)]).astype(np.uint64)
    words = np.zeros(len(padded) - 7, np.uint64)
    for i in range(8):
        words = words << np.uint64(8) | padded[i:len(padded) - 7 + i]
    lcp = np.zeros(len(order), np.int64)
    left, right = order[:-1], order[1:]
    active = np.arange(1, len(order))
    for at in range(0, depth, 8):
        differ = words[left + at] ^ words[right + at]
        equal = differ == 0
        some = differ[~equal]
        lcp[active[~equal]] = at + sum(
            (some >> np.uint64(shift) == 0).astype(np.int64) for shift in range(56, 0, -8))
        lcp[active[equal]] = min(depth, at + 8)
        active, left, right = active[equal], left[equal], right[equal]
        if not len(active):
            break
    return np.minimum(lcp, depth)


def repeated_windows(parts: list[bytes], length: int = LENGTH) -> list[np.ndarray]:
    """For each part, flags of its windows that occur again in this or another part."""
    text = np.frombuffer(bytes([SEPARATOR]).join(parts), np.uint8)
    order = suffix_array(text, length)
    lcp = common_prefixes(text, order, length)
    sizes = np.array([len(p) for p in parts])
    starts = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
    rest = np.repeat(starts + sizes, sizes + 1)[:len(text)] - np.arange(len(text))
    whole = np.zeros(len(order), bool)
    whole[1:] = (lcp[1:] >= length) & (rest[order[1:]] >= length) & (rest[order[:-1]] >= length)
    marked = np.zeros(len(text), bool)
    marked[order[whole]] = True
    marked[order[np.flatnonzero(whole) - 1]] = True
    return [marked[a:a + max(0, n - length + 1)] for a, n in zip(starts.tolist(), sizes.tolist(), strict=True)]


def _ranges(flags: np.ndarray) -> list[int]:
    edges = np.flatnonzero(np.diff(np.concatenate([[0], flags.view(np.int8), [0]])))
    return edges.tolist()


_MARKS = pa.schema([("anchor", pa.int64()), ("content", pa.int64()), ("ranges", pa.list_(pa.int32()))])
MARKS = "anchor long, content long, ranges array<int>"


def sorted_marks(parts: DataFrame, length: int = LENGTH) -> DataFrame:
    """Repeated windows of distinct segments, whole anchors at a time, as flat ranges."""

    def flush(rows: list[tuple]) -> pa.RecordBatch:
        flags = repeated_windows([r[2] for r in rows], length)
        found = [(a, c, _ranges(f)) for (a, c, _), f in zip(rows, flags, strict=True) if f.any()]
        columns = zip(*found, strict=True) if found else [[]] * 3
        return pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(columns, _MARKS, strict=True)], schema=_MARKS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        size = 0
        for batch in slices(batches, 4096, "part", SORT_BYTES):
            for anchor, content, part in zip(
                    batch.column("anchor").to_pylist(), batch.column("content").to_pylist(),
                    batch.column("part").to_pylist(), strict=True):
                if size >= SORT_BYTES and rows[-1][0] != anchor:
                    yield flush(rows)
                    rows, size = [], 0
                rows.append((anchor, content, part))
                size += len(part)
        if rows:
            yield flush(rows)

    return parts.repartition("anchor").sortWithinPartitions("anchor").select(
        "anchor", "content", "part").mapInArrow(run, MARKS)


def counted_marks(parts: DataFrame, length: int = LENGTH) -> DataFrame:
    """The same for crowded anchors, by counting hashes of single windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 512, "part"):
            columns: list[list] = [[] for _ in range(5)]
            for anchor, content, part in zip(
                    batch.column("anchor").to_pylist(), batch.column("content").to_pylist(),
                    batch.column("part").to_pylist(), strict=True):
                b = np.frombuffer(part, np.uint8)
                g1, g2 = (window_hashes(b, length, s).view(np.int64) for s in (1, 2))
                for column, value in zip(columns, (
                        np.full(len(g1), anchor), np.full(len(g1), content), np.arange(len(g1)), g1, g2), strict=True):
                    column.append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(c) if c else [], pa.int64()) for c in columns],
                ["anchor", "content", "at", "g1", "g2"])

    windows = parts.select("anchor", "content", "part").mapInArrow(
        run, "anchor long, content long, at long, g1 long, g2 long")
    again = windows.groupBy("anchor", "g1", "g2").agg(F.count("*").alias("c")).where("c > 1").drop("c")
    at = F.transform(F.array_sort(F.collect_set("at")), lambda x: x.cast("int"))
    flat = F.flatten(F.transform(at, lambda x: F.array(x, x + 1)))
    return windows.join(again, ["anchor", "g1", "g2"]).groupBy("anchor", "content").agg(flat.alias("ranges"))


def repeats(keyed: DataFrame, length: int = LENGTH, crowded: int = CROWDED) -> DataFrame:
    """k1, k2, doc_id, text and ``found``: the marked windows of every row of ``keyed``."""
    every = stored(segments(keyed, length), "segments")
    shared = every.groupBy("anchor").agg(F.count("*").alias("c")).where("c > 1").select("anchor")
    some = stored(every.join(shared, "anchor"), "shared-segments")
    folded = stored(some.groupBy("anchor", "content").agg(
        F.count("*").alias("copies"), F.min(F.struct("k1", "k2", "lo", "n")).alias("first")), "folded")
    kinds = folded.groupBy("anchor").agg(F.count("*").alias("kinds")).where("kinds > 1")
    differing = folded.join(kinds, "anchor").select(
        "anchor", "content", "kinds", "first.k1", "first.k2", "first.lo", "first.n")
    # doc_id is kept so that both joins of the texts read one exchange.
    parts = keyed.join(differing, ["k1", "k2"]).select(
        "anchor", "content", "kinds", "doc_id",
        F.substring(F.col("text"), F.col("lo") + 1, F.col("n") + length - 1).alias("part"))
    parts = stored(parts.drop("doc_id"), "parts")
    marks = sorted_marks(parts.where(F.col("kinds") <= crowded), length).unionByName(
        counted_marks(parts.where(F.col("kinds") > crowded), length))
    results = folded.select("anchor", "content", (F.col("copies") > 1).alias("all")).join(
        marks, ["anchor", "content"], "left").where(F.col("all") | F.col("ranges").isNotNull())
    found = some.join(results, ["anchor", "content"]).groupBy("k1", "k2").agg(
        F.collect_set(F.struct("lo", "n", "all", "ranges")).alias("found"))
    return keyed.join(found, ["k1", "k2"], "left")


def removed_runs(found: list[dict] | None, length: int = LENGTH) -> list[tuple[int, int]]:
    """Maximal removed byte runs of a text from its marked windows."""
    spans = []
    for f in found or ():
        marked = [0, f["n"]] if f["all"] else f["ranges"]
        spans += [(f["lo"] + a, f["lo"] + b - 1 + length)
                  for a, b in zip(marked[::2], marked[1::2], strict=True)]
    merged: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if merged and a <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(b, merged[-1][1]))
        else:
            merged.append((a, b))
    return merged


def keyed_texts(docs: DataFrame) -> DataFrame:
    """doc_id, UTF-8 text and a 96-bit key of both; equal rows share a key and a result."""
    text = text_of()
    return docs.select(
        F.xxhash64("doc_id", text).alias("k1"), F.crc32(text.cast("binary")).alias("k2"),
        "doc_id", text.cast("binary").alias("text"))


def remove_repeats(docs: DataFrame, length: int = LENGTH, crowded: int = CROWDED,
                   text: bool = True) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans and the kept bytes of each row.

    Texts are UTF-8 bytes; a null text is empty. Strings are judged on the input and never
    cross documents; overlaps and repeats inside one document count. Repeated rows repeat
    each other. Kept bytes may break a character; ``kept`` is null without ``text``. Other
    columns are not read; an empty table gives no rows.
    """
    doc_type = docs.schema["doc_id"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 512, "text"):
            rows = []
            for data, found in zip(batch.column("text"), batch.column("found"), strict=True):
                data = data.as_buffer().to_pybytes()
                runs = removed_runs(found.as_py(), length)
                kept, at = [], 0
                for a, b in runs:
                    kept.append(data[at:a])
                    at = b
                kept = b"".join([*kept, data[at:]])
                rows.append((len(data), sum(b - a for a, b in runs), len(runs),
                             hashlib.sha256(kept).hexdigest(), [x for r in runs for x in r],
                             kept if text else None))
            columns = list(zip(*rows, strict=True))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int64()), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array(c, t) for c, t in zip(columns, kinds, strict=True)]],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans", "kept"])

    return repeats(keyed_texts(docs), length, crowded).select("doc_id", "text", "found").mapInArrow(
        cut, f"doc_id {doc_type}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, "
             "spans array<long>, kept binary")


def without_repeats(docs: DataFrame, length: int = LENGTH, crowded: int = CROWDED) -> DataFrame:
    """``docs`` with repeated strings cut out of the texts, and all other columns.

    What a cut leaves of a broken character goes too, and ``n_chars``, if there, is counted
    anew. Rows whose text is cut to nothing are dropped; a text that was empty or null stays.
    """
    names = docs.columns
    text = text_of()
    rows = docs.select(
        F.xxhash64("doc_id", text).alias("k1"), F.crc32(text.cast("binary")).alias("k2"), "doc_id",
        text.cast("binary").alias("text"),
        F.struct(*[F.lit(None).cast("string").alias(c) if c == "text" else F.col(c) for c in names],
                 F.col("text").isNull().alias("_null")).alias("row"))
    schema = docs.schema

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 512, "text"):
            texts, kept, at_row = batch.column("text"), [], batch.column("row")
            for data, found in zip(texts, batch.column("found"), strict=True):
                data = data.as_buffer().to_pybytes()
                parts, at = [], 0
                for a, b in removed_runs(found.as_py(), length):
                    parts.append(data[at:a])
                    at = b
                kept.append("".join(p.decode(errors="ignore") for p in [*parts, data[at:]]))
            stays = [bool(k.strip()) or not t.as_buffer().size for k, t in zip(kept, texts, strict=True)]
            empty = at_row.field(len(names)).to_pylist()
            columns = []
            for i, name in enumerate(names):
                column = at_row.field(i)
                if name == "text":
                    column = pa.array([None if n else k for k, n in zip(kept, empty, strict=True)], pa.string())
                elif name == "n_chars":
                    column = pa.array([len(k) for k in kept]).cast(column.type)
                columns.append(column)
            yield pa.RecordBatch.from_arrays(columns, names).filter(pa.array(stays, pa.bool_()))

    return repeats(rows, length, crowded).select("row", "text", "found").mapInArrow(cut, schema)

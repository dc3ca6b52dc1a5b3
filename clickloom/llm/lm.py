"""Language-model scores: a causal self-attention model over subword ids, in numpy.

Counts cover the whole training part of the corpus: words, and pairs of subword ids inside
words. The attention model predicts the class of the next id from the window before it; the
pair counts give the id within its class. Inside the most frequent words the counts of their
beginnings are mixed in, backed off to the attention model. The probabilities of all ids that
may come next, and of the end, add up to one.

The attention weights are fitted on every window of every training document, in rounds: each
partition runs Adam over its share from the same weights, and the results are averaged by
their windows, so the work grows with the corpus and the driver sees one set of weights.

Every text is read once, in overlapping windows: each id is scored in exactly one window,
with the ids before it in that window as context. At last a word's probability is mixed with
its share in the corpus, which all distinct words of the training part have; words outside a
bounded dictionary are looked up by a join.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import fold_remainder, slices, stored, text_of
from clickloom.llm.subwords import subwords

DICTIONARY = 100_000  # the most frequent words, which every task holds
FLUSH_WORDS = 300_000  # distinct words that a counting task holds at once
KEPT_IDS = 1022  # the most frequent subword ids; the others share a place, those that open words another
OTHER, OPENER, END, BOUNDARY, BEGIN = KEPT_IDS, KEPT_IDS + 1, KEPT_IDS + 2, KEPT_IDS + 2, KEPT_IDS + 2
PLACES = KEPT_IDS + 2
CLASSES, OPENING, WIDTH = 48, 42, 16
WINDOW, OVERLAP = 64, 32  # half-windows, see class_shares
ROUNDS, RATE, BATCH = 4, 0.02, 32
SHARE = 0.4  # of a word's share in the corpus in its probability
SMOOTHING = 0.1
TRUST = 20.0  # the count that the attention model is worth against a word's beginnings


def words_of(text: str) -> list[bytes]:
    """Words between white space (space, tab to carriage return); A-Z in lower case."""
    return text.encode().lower().split()


def word_counts(docs: DataFrame) -> DataFrame:
    """word, c over the texts of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def flush() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays(
                [pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], ["word", "c"])
            counts.clear()
            return batch

        for batch in slices(batches, 256, "text"):
            for text in batch.column("text"):
                counts.update(words_of(text.as_py()))
            if len(counts) > FLUSH_WORDS:
                yield flush()
        yield flush()

    return docs.select("text").mapInArrow(run, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


class Coder:
    """Subword ids of words, each encoded with the space before it."""

    def __init__(self, tokenizer: str) -> None:
        self.encode = subwords(tokenizer)._encode

    def __call__(self, word: bytes) -> bytes:
        return np.array(self.encode(" " + word.decode()), np.uint16).tobytes()


@lru_cache(1)
def cached_ids(tokenizer: str):
    """Subword ids of a word, kept for the tasks of a Python worker."""
    return lru_cache(200_000)(Coder(tokenizer))


class Beginnings:
    """Counts of words by the ids they begin with, for the beginnings of frequent words."""

    def __init__(self, frequent: dict[bytes, int], tokenizer: str) -> None:
        self.coder = Coder(tokenizer)
        self.ends: dict[bytes, int] = {}
        for word, c in frequent.items():
            ids = self.coder(word)
            self.ends[ids] = self.ends.get(ids, 0) + c
        self.all = sorted({ids[:at] for ids in self.ends for at in range(2, len(ids) + 1, 2)})
        self.number = {beginning: i for i, beginning in enumerate(self.all)}
        self._known: dict[bytes, tuple[bytes, bytes]] = {}

    def count(self, ids: list[bytes], times: list[int]) -> np.ndarray:
        """How often words with these ids have each beginning."""
        totals, number = np.zeros(len(self.all)), self.number
        for b, c in zip(ids, times, strict=True):
            for at in range(2, len(b) + 1, 2):
                found = number.get(b[:at])
                if found is None:
                    break
                totals[found] += c
        return totals

    def settle(self, totals: np.ndarray) -> None:
        """Takes the counts over all words; ``rest`` is what goes on to rare words."""
        self.total = dict(zip(self.all, totals.tolist(), strict=True))
        self.rest = dict(self.total)
        for beginning, c in self.total.items():
            self.rest[beginning] -= self.ends.get(beginning, 0)
            if len(beginning) > 2:
                self.rest[beginning[:-2]] -= c

    def __call__(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids; and behind each id the count of the beginning so far, of how it goes on, and
        of what goes on to rare words."""
        known, ids, counts = self._known, [], []
        for word in words:
            found = known.get(word)
            if found is None:
                b = self.coder(word)
                seen = []
                total = self.total.get(b[:2])
                for at in range(2, len(b) + 1, 2):
                    if not total:  # no longer beginning is known either
                        seen += [0] * (3 * (len(b) - at + 2) // 2)
                        break
                    more = self.ends.get(b, 0) if at == len(b) else self.total.get(b[:at + 2], 0)
                    seen += [total, more, self.rest[b[:at]]]
                    total = more
                found = b, np.array(seen, np.float32).tobytes()
                if len(word) < 64:
                    if len(known) >= 150_000:
                        known.clear()
                    known[word] = found
            ids.append(found[0])
            counts.append(found[1])
        return (np.frombuffer(b"".join(ids), np.uint16),
                np.frombuffer(b"".join(counts), np.float32).reshape(-1, 3))


@dataclass
class Model:
    place: np.ndarray  # of each subword id among the kept ones
    inside: np.ndarray  # log10 of the probability of an id in its place
    opens: np.ndarray  # whether an id starts a word
    pair: np.ndarray  # log10 of the probability of a place within its class, given the one before
    kind: np.ndarray  # class of each place
    weights: dict[str, np.ndarray]
    totals: np.ndarray  # counts of the beginnings of frequent words


def pair_counts(counts: DataFrame, place: np.ndarray, beginnings: Beginnings,
                tokenizer: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Counts of pairs of places inside words, of ids, and of beginnings, over all words."""
    places = PLACES
    shared = counts.sparkSession.sparkContext.broadcast(beginnings)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(tokenizer)
        pairs = np.zeros((places + 1) * places)
        single = np.zeros(len(place))
        totals = np.zeros(len(shared.value.all))
        for batch in slices(batches, 50_000):
            raw = [coder(word) for word in batch.column("word").to_pylist()]
            totals += shared.value.count(raw, batch.column("c").to_pylist())
            coded = [np.frombuffer(ids, np.uint16) for ids in raw]
            sizes = np.array([len(x) for x in coded])
            c = np.repeat(batch.column("c").to_numpy(), sizes)
            ids = np.concatenate(coded)
            before = np.concatenate([[BOUNDARY], place[ids[:-1]]])
            before[np.cumsum(sizes)[:-1]] = BOUNDARY
            single += np.bincount(ids, c, len(single))
            pairs += np.bincount(before * places + place[ids], c, len(pairs))
        every = np.concatenate([pairs, single, totals])
        found = np.flatnonzero(every)
        yield pa.RecordBatch.from_arrays(
            [pa.array(found, pa.int64()), pa.array(every[found], pa.float64())], ["at", "c"])

    # One row per pair of places, id and beginning of a frequent word, whatever the corpus.
    rows = counts.mapInArrow(run, "at long, c double").groupBy("at").agg(F.sum("c").alias("c")).toArrow()
    at, c = rows.column("at").to_numpy(), rows.column("c").to_numpy()
    every = np.zeros((places + 1) * places + len(place) + len(beginnings.all))
    every[at] = c
    pairs, single, totals = np.split(every, [(places + 1) * places, (places + 1) * places + len(place)])
    return pairs.reshape(places + 1, places), single, totals


def classes_of(pairs: np.ndarray, embedded: np.ndarray, opens: np.ndarray, rounds: int = 12) -> np.ndarray:
    """Classes of places by k-means, weighted by count, over their embeddings.

    The first half of the classes are for ids that open a word and the end of a text, the
    others for ids inside words.
    """
    weight = pairs.sum(axis=0) + 1e-9
    kind = np.zeros(len(embedded), np.int64)
    for first, last, mine in ((0, OPENING - 1, np.flatnonzero(opens)), (OPENING, CLASSES, np.flatnonzero(~opens))):
        points = embedded[mine]
        centres = points[np.argsort(-weight[mine])[:last - first]].copy()
        for _ in range(rounds if len(points) else 0):
            near = ((points[:, None, :] - centres[None]) ** 2).sum(axis=2).argmin(axis=1)
            kind[mine] = first + near
            for k in range(len(centres)):
                if (near == k).any():
                    centres[k] = np.average(points[near == k], axis=0, weights=weight[mine][near == k])
    return np.append(kind, OPENING - 1)  # the end of a text is a class of its own


def embeddings_of(pairs: np.ndarray) -> np.ndarray:
    """Places by the pairs they take part in: damped counts, reduced by SVD."""
    before, after = np.sqrt(pairs[:-1]), np.sqrt(pairs.T[:, :])
    joined = np.concatenate([before / (np.linalg.norm(before, axis=1, keepdims=True) + 1e-9),
                             after / (np.linalg.norm(after, axis=1, keepdims=True) + 1e-9)], axis=1)
    u, s, _ = np.linalg.svd(joined - joined.mean(axis=0), full_matrices=False)
    return (u[:, :WIDTH] * s[:WIDTH]).astype(np.float64)


def pair_table(pairs: np.ndarray, kind: np.ndarray, used: np.ndarray) -> np.ndarray:
    """log10 P(place | class of the place, place before), backed off to the class.

    Places that no id has are left next to nothing.
    """
    places = pairs.shape[1]
    total = pairs.sum(axis=0) + SMOOTHING * used + 1e-12
    belongs = np.zeros((places, CLASSES))
    belongs[np.arange(places), kind[:places]] = 1
    single = total / (belongs.T @ total)[kind[:places]]
    strength = 2.0
    seen = pairs @ belongs
    table = (pairs + strength * single) / (seen[:, kind[:places]] + strength)
    table = np.append(np.log10(table), np.zeros((places + 1, 1)), axis=1)  # the end is alone in its class
    return table.astype(np.float32)


def initial_weights(embedded: np.ndarray, kind: np.ndarray) -> dict[str, np.ndarray]:
    random = np.random.default_rng(3)
    table = np.zeros((PLACES + 1, WIDTH))
    table[:len(embedded)] = embedded * 2
    draw = lambda *shape: random.normal(0, 1 / math.sqrt(shape[0]), shape)
    return {"embed": table, "place": random.normal(0, 0.05, (WINDOW, WIDTH)),
            "qkv": draw(WIDTH, 3 * WIDTH), "o": draw(WIDTH, WIDTH) * 0.3,
            "c": draw(WIDTH, CLASSES), "bc": np.zeros(CLASSES)}


_CAUSAL = np.tril(np.ones((WINDOW, WINDOW)))
_OPENING = np.stack([np.ones(CLASSES), np.arange(CLASSES) < OPENING], axis=1)  # sums of all, of the opening ones
_flat = lambda m: m.reshape(-1, m.shape[-1])


def _scaled(w: dict[str, np.ndarray]) -> np.ndarray:
    """The projection to queries, keys and values, with the scale of the products in the queries."""
    scale = np.ones(3 * WIDTH, w["qkv"].dtype)
    scale[:WIDTH] = 1 / math.sqrt(WIDTH)
    return scale


def _exponentials(q: np.ndarray, k: np.ndarray, allowed: np.ndarray) -> np.ndarray:
    """exp of the products of queries and keys where a query may look, else 0."""
    a = q @ np.ascontiguousarray(k.transpose(0, 2, 1))
    if (q ** 2).sum(axis=2).max(initial=0) * (k ** 2).sum(axis=2).max(initial=0) > 3600:
        np.minimum(a, 60, out=a)  # products beyond 60 can only occur here
    np.exp(a, out=a)
    a *= allowed
    return a


def attend(w: dict[str, np.ndarray], at: np.ndarray) -> tuple:
    """Hidden states, last, for windows of places (windows, WINDOW), by masked attention."""
    x = w["embed"].take(at, axis=0)
    x += w["place"]
    q, k, v = np.split((_flat(x) @ (w["qkv"] * _scaled(w))).reshape(*at.shape, -1), 3, axis=2)
    a = _exponentials(q, k, _CAUSAL.astype(x.dtype))
    a /= a @ np.ones((WINDOW, 1), a.dtype)
    mixed = a @ v
    h = x + (_flat(mixed) @ w["o"]).reshape(x.shape)
    return x, q, k, v, a, mixed, h


def gradients(w: dict[str, np.ndarray], at: np.ndarray, target: np.ndarray, counted: np.ndarray):
    """Mean cross entropy of the counted positions and its gradient by each weight."""
    x, q, k, v, a, mixed, h = attend(w, at)
    p = _flat(h) @ w["c"]
    p += w["bc"]
    np.clip(p, -60, 60, out=p)
    np.exp(p, out=p)
    p /= p @ np.ones((CLASSES, 1), p.dtype)
    each, target, counted = np.arange(len(p)), target.ravel(), counted.ravel()
    n = max(1, counted.sum())
    picked = p[each, target]
    loss = -(np.log(picked + 1e-12) * counted).sum() / n
    p[each, target] = picked - 1
    p *= (counted / n).astype(p.dtype)[:, None]
    g = {"c": _flat(h).T @ p, "bc": p.sum(axis=0)}
    dh = p @ w["c"].T
    dmixed = (dh @ w["o"].T).reshape(x.shape)
    g["o"] = _flat(mixed).T @ dh
    ds = dmixed @ np.ascontiguousarray(v.transpose(0, 2, 1))
    ds -= (dmixed * mixed).sum(axis=2)[..., None]
    ds *= a
    scaled = _scaled(w)
    dqkv = np.empty((*at.shape, 3 * WIDTH), x.dtype)
    np.matmul(ds, k, out=dqkv[..., :WIDTH])
    np.matmul(ds.transpose(0, 2, 1), q, out=dqkv[..., WIDTH:2 * WIDTH])
    np.matmul(a.transpose(0, 2, 1), dmixed, out=dqkv[..., 2 * WIDTH:])
    g["qkv"] = (_flat(x).T @ _flat(dqkv)) * scaled
    dx = dh + _flat(dqkv) @ (w["qkv"] * scaled).T
    g["place"] = dx.reshape(x.shape).sum(axis=0)
    ids = at.ravel().astype(np.uint16)  # places fit; short numbers sort quickly
    order = np.argsort(ids, kind="stable")
    ids = ids[order]
    runs = np.flatnonzero(np.append(True, ids[1:] != ids[:-1]))
    g["embed"] = np.zeros_like(w["embed"])
    g["embed"][ids[runs]] = np.add.reduceat(dx[order], runs, axis=0)
    return loss, g


def class_shares(w: dict[str, np.ndarray], sizes: np.ndarray, inputs: np.ndarray, wanted: np.ndarray,
                 batch: int = 128) -> tuple[np.ndarray, np.ndarray]:
    """Of each position of texts laid end to end, the probabilities of the class that is wanted
    and of the classes that open a word.

    Windows of ``WINDOW`` positions overlap by half. A position is scored in one window: the
    first window of a text scores all its positions, the others their second half. Only the
    rows that score are computed, so a batch holds half-windows of queries, each with the keys
    of its own half and of the half before.
    """
    blocks = -(-sizes // OVERLAP)
    first = np.cumsum(blocks) - blocks
    # texts are laid out anew, each from the beginning of a half-window on
    cell = np.arange(len(inputs)) + np.repeat(first * OVERLAP - (np.cumsum(sizes) - sizes), sizes)
    laid = np.full((blocks.sum() + 1, OVERLAP), BEGIN)  # a half-window in front of all
    laid.ravel()[cell + OVERLAP] = inputs
    aim = np.zeros((len(laid) - 1, OVERLAP), np.int64)
    aim.ravel()[cell] = wanted
    opens_text = np.zeros(len(aim), bool)
    opens_text[first] = True
    # projections of places and of positions in the window add up, so they are looked up
    both = np.concatenate([w["qkv"] * _scaled(w), w["c"]], axis=1)
    ids, lines = w["embed"] @ both, w["place"] @ both
    ids[:, 3 * WIDTH:] += w["bc"]
    queries, keys, values, classes = np.split(ids, [WIDTH, 2 * WIDTH, 3 * WIDTH], axis=1)
    values = np.append(values, np.ones((len(values), 1), values.dtype), axis=1)  # sums the weights up as well
    queries, keys, values, classes = map(np.ascontiguousarray, (queries, keys, values, classes))
    line_q, line_k, line_v, line_c = np.split(lines, [WIDTH, 2 * WIDTH, 3 * WIDTH], axis=1)
    line_v = np.append(line_v, np.zeros((WINDOW, 1), line_v.dtype), axis=1)
    out = w["o"] @ w["c"]
    allowed = _CAUSAL[OVERLAP:].astype(ids.dtype)
    picked, opening = np.empty(aim.shape, np.float32), np.empty(aim.shape, np.float32)
    for at in range(0, len(aim), batch):
        own = laid[at + 1:at + batch + 1]
        window = np.concatenate([laid[at:at + len(own)], own], axis=1)
        start = opens_text[at:at + len(own)]
        q, logits = queries.take(own, axis=0), classes.take(own, axis=0)
        k, v = keys.take(window, axis=0), values.take(window, axis=0)
        for table, line in ((q, line_q), (logits, line_c)):
            table += line[OVERLAP:]
            table[start] += line[:OVERLAP] - line[OVERLAP:]
        for table, line in ((k, line_k), (v, line_v)):
            table += line
            table[start, OVERLAP:] += line[:OVERLAP] - line[OVERLAP:]
        a = _exponentials(q, k, allowed)
        a[start, :, :OVERLAP] = 0  # no half-window before
        mixed = a @ v
        logits = _flat(logits)
        mixed = _flat(mixed)
        logits += (mixed[:, :WIDTH] / mixed[:, WIDTH:]) @ out
        np.clip(logits, -60, 60, out=logits)
        np.exp(logits, out=logits)
        sums = logits @ _OPENING.astype(logits.dtype)
        picked[at:at + len(own)] = (logits[np.arange(len(logits)), aim[at:at + len(own)].ravel()] / sums[:, 0]).reshape(own.shape)
        opening[at:at + len(own)] = (sums[:, 1] / sums[:, 0]).reshape(own.shape)
    return picked.ravel()[cell], opening.ravel()[cell]


def _laid_out(model_place: np.ndarray, texts: list[np.ndarray]):
    """Inputs, targets and owners: BEGIN and the ids predict the ids and the end."""
    sizes = np.array([len(t) + 1 for t in texts])
    inputs, targets = np.full(sizes.sum(), BEGIN), np.full(sizes.sum(), END)
    at = 0
    for t, size in zip(texts, sizes.tolist(), strict=True):
        places = model_place[t]
        inputs[at + 1:at + size] = places
        targets[at:at + size - 1] = places
        at += size
    return sizes, inputs, targets


class Trainer:
    """Adam over the windows of one partition, from given weights."""

    def __init__(self, weights: dict[str, np.ndarray], rate: float) -> None:
        self.every = np.concatenate([v.ravel() for v in weights.values()]).astype(np.float32)
        cuts = np.cumsum([v.size for v in weights.values()])[:-1]
        self.w = {k: part.reshape(v.shape) for (k, v), part in zip(weights.items(), np.split(self.every, cuts), strict=True)}
        self.rate, self.steps, self.windows = rate, 0, 0
        self.first, self.second = np.zeros_like(self.every), np.zeros_like(self.every)
        self.random = np.random.default_rng(9)

    def read(self, place: np.ndarray, kind: np.ndarray, texts: list[np.ndarray]) -> None:
        """One pass over all windows of the texts, which follow each other without overlap."""
        sizes, inputs, targets = _laid_out(place, texts)
        counts = -(-sizes // WINDOW)
        ends = np.repeat(np.cumsum(sizes), counts)
        nth = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        position = (np.repeat(np.cumsum(sizes) - sizes, counts) + nth * WINDOW)[:, None] + np.arange(WINDOW)
        order = self.random.permutation(len(position))
        for at in range(0, len(order), BATCH):
            some = order[at:at + BATCH]
            last = ends[some, None]
            cells = np.minimum(position[some], last - 1)
            counted = (position[some] < last).astype(np.float32)
            self.step(gradients(self.w, inputs[cells], kind[targets[cells]], counted)[1])
        self.windows += len(position)

    def step(self, g: dict[str, np.ndarray]) -> None:
        self.steps += 1
        n, rate = self.steps, self.rate * min(1.0, self.steps / 20)
        g = np.concatenate([g[name].ravel() for name in self.w])
        self.first *= np.float32(0.9)
        self.first += np.float32(0.1) * g
        g *= g
        g *= np.float32(0.02)
        self.second *= np.float32(0.98)
        self.second += g
        down = np.sqrt(self.second)
        down *= np.float32(1 / math.sqrt(1 - 0.98 ** n))
        down += np.float32(1e-8)
        np.divide(self.first, down, out=down)
        down *= np.float32(rate / (1 - 0.9 ** n))
        self.every -= down


def fit(w: dict[str, np.ndarray], place: np.ndarray, kind: np.ndarray, train: DataFrame,
        tokenizer: str) -> dict[str, np.ndarray]:
    """Weights after ``ROUNDS`` rounds, which together read every window of ``train`` once.

    A round reads the documents that a hash assigns to it; its partitions' weights are
    averaged by their windows. Without documents the weights stay as they are.
    """
    shapes = {name: v.shape for name, v in w.items()}
    part = F.pmod(F.xxhash64("doc_id", "text"), F.lit(ROUNDS))
    for number in range(ROUNDS):
        shared = train.sparkSession.sparkContext.broadcast((w, place, kind))
        rate = RATE * (1 - number / ROUNDS)

        def run(batches: Iterator[pa.RecordBatch], shared=shared, rate=rate) -> Iterator[pa.RecordBatch]:
            start, place, kind = shared.value
            trainer, ids = Trainer(start, rate), cached_ids(tokenizer)
            for batch in slices(batches, 512, "text", 1 << 20):
                trainer.read(place, kind, [np.frombuffer(b"".join(map(ids, words_of(t.as_py()))), np.uint16)
                                           for t in batch.column("text")])
            if trainer.windows:
                flat = trainer.every.astype(float)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(len(flat) + 1)), pa.array(np.append(flat, 1.0) * trainer.windows)], ["at", "v"])

        # One row per weight, and one for the number of windows, whatever the corpus.
        rows = train.where(part == number).select("text").mapInArrow(run, "at long, v double").groupBy(
            "at").agg(F.sum("v").alias("v")).orderBy("at").toArrow()
        if rows.num_rows:
            flat = rows.column("v").to_numpy()
            flat, at, w = flat[:-1] / flat[-1], 0, {}
            for name, shape in shapes.items():
                size = math.prod(shape)
                w[name] = flat[at:at + size].reshape(shape)
                at += size
    return w


def position_logs(model: Model, texts: list[np.ndarray], counts: list[np.ndarray]) -> tuple:
    """Sizes of the texts in positions, whether a position opens a word (or is the end), and natural
    logs: of a position's id, given that a word opens there or goes on, and of a word's opening there."""
    sizes, inputs, targets = _laid_out(model.place, texts)
    n = len(inputs)
    before, extra = np.full(n, BOUNDARY), np.zeros(n, np.float32)
    opens, seen = np.ones(n, bool), np.zeros((n, 3), np.float32)
    at = 0
    for t, c, size in zip(texts, counts, sizes.tolist(), strict=True):
        extra[at:at + size - 1] = model.inside[t]
        opens[at:at + size - 1] = model.opens[t]
        seen[at + 1:at + size] = c
        at += size
    before[~opens] = inputs[~opens]
    within = model.pair[before, targets] * np.float32(math.log(10)) + extra * np.float32(math.log(10))
    picked, opening = class_shares(model.weights, sizes, inputs, model.kind[targets])
    total, more, rest = seen.T
    rest = np.maximum(rest, 0) + np.float32(TRUST)
    # what opens a word shares the count of the words that end here by the model alone
    chosen = np.log(np.maximum(picked / np.maximum(opening, 1e-30), 1e-30)) + within
    inner = np.log(np.maximum((more + rest * picked * np.exp(within)) / (total + np.float32(TRUST)), 1e-30))
    begun = np.log(np.maximum((more + rest * opening) / (total + np.float32(TRUST)), 1e-30))
    return sizes, opens, np.where(opens, chosen, inner), np.where(opens, begun, 0)


def score_texts(model: Model, texts: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """log10 probability of each word and end by the subword model, the number of them in each
    text, and log10 of the probability that a text begins with a word or ends."""
    sizes, opens, ids, begun = (x.astype(np.float64) if x.dtype == np.float32 else x
                                for x in position_logs(model, texts, counts))
    starts = np.flatnonzero(opens)
    words = np.add.reduceat(ids, starts)
    last = np.searchsorted(starts, np.cumsum(sizes) - 1)  # the ends of the texts
    closed = np.append(begun[starts[1:]], 0.0)  # a word is over where the next one opens
    closed[last] = 0.0
    log10 = 1 / math.log(10)
    return (words + closed) * log10, np.diff(last, prepend=-1), begun[np.cumsum(sizes) - sizes] * log10


def mixed(by_model: np.ndarray, share: np.ndarray) -> np.ndarray:
    """log10 of the mixture of a word's probability with its share in the corpus."""
    with np.errstate(divide="ignore"):
        return np.logaddexp((by_model + math.log10(1 - SHARE)) * math.log(10),
                            np.log(SHARE * share)) / math.log(10)


def learn(train: DataFrame, counts: DataFrame, frequent: dict[bytes, int], tokenizer: str) -> Model:
    coder = Coder(tokenizer)
    size = 50_257
    common = np.zeros(size)
    for word, c in frequent.items():
        np.add.at(common, np.frombuffer(coder(word), np.uint16), c)
    tokens = subwords(tokenizer).tokens
    opens = np.array([tokens.get(i, b"").startswith(b" ") for i in range(size)])
    place = np.where(opens, OPENER, OTHER)
    kept = [i for i in np.argsort(-common, kind="stable")[:KEPT_IDS].tolist() if common[i] > 0]
    place[kept] = np.arange(len(kept))
    beginnings = Beginnings(frequent, tokenizer)
    pairs, single, totals = pair_counts(counts, place, beginnings, tokenizer)
    inside = np.zeros(size)
    for shared in (OTHER, OPENER):
        mine = place == shared
        inside[mine] = np.log10((single[mine] + SMOOTHING) / (single[mine] + SMOOTHING).sum())
    embedded = embeddings_of(pairs)
    used = np.isin(np.arange(PLACES), place)
    at_place = np.zeros(PLACES, bool)
    at_place[place] = opens  # kept ids have places of their own, rare ones do not mix
    kind = classes_of(pairs, embedded, at_place)
    weights = fit(initial_weights(embedded, kind), place, kind, train, tokenizer)
    # a class without ids has no share
    weights["bc"] = np.where(np.isin(np.arange(CLASSES), kind[np.append(used, True)]), weights["bc"], -1e4)
    return Model(place, inside.astype(np.float32), opens, pair_table(pairs, kind, used), kind,
                 {k: v.astype(np.float32) for k, v in weights.items()}, totals)


_loaded: dict[int, tuple] = {}


def _prepared(shared, tokenizer: str) -> tuple:
    """What a Python worker needs of the broadcast, built once for all its tasks."""
    key = shared._id if hasattr(shared, "_id") else id(shared)
    if key not in _loaded:
        frequent, model = shared.value
        _loaded.clear()
        beginnings = Beginnings(frequent, tokenizer)
        beginnings.settle(model.totals)
        _loaded[key] = (beginnings, model, frequent)
    return _loaded[key]


def score(docs: DataFrame, tokenizer: str = "byte_bpe_50k", dictionary: int = DICTIONARY) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row.

    Rows whose crc32(doc_id as text) mod 10 is 0 are held out of all learning. A null text
    is empty: its one token is the end. Repeated rows count and are scored each; without
    training rows nothing is known. Other columns than doc_id and text are not read.
    """
    spark = docs.sparkSession
    doc_type = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", text_of().alias("text"), (fold_remainder(F.col("doc_id"), 10) == 0).alias("held_out"))
    train = rows.where(~F.col("held_out"))
    counts = stored(word_counts(train), "word-counts")
    n_docs = train.count()
    distinct, words = counts.agg(F.count("*"), F.coalesce(F.sum("c"), F.lit(0))).first()
    total, kinds = words + n_docs, distinct + (n_docs > 0)
    # A fixed number of words, so their size does not grow with the corpus.
    frequent = {bytes(r["word"]): r["c"] for r in
                counts.orderBy(F.col("c").desc(), "word").limit(dictionary).collect()}
    least = min(frequent.values()) if len(frequent) == dictionary else 0
    model = learn(train, counts, frequent, tokenizer)
    below = math.log10(total + SMOOTHING * (kinds + 1))
    shared = spark.sparkContext.broadcast((frequent, model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        beginnings, model, frequent = _prepared(shared, tokenizer)
        end = math.log10(n_docs + SMOOTHING) - below
        for batch in slices(batches, 512, "text", 1 << 20):
            out: list[list] = [[] for _ in range(6)]
            texts, seen, every = [], [], []
            for text in batch.column("text"):
                words = words_of(text.as_py())
                ids, c = beginnings(words)
                texts.append(ids)
                seen.append(c)
                every.append(words)
            by_model, sizes, begun = score_texts(model, texts, seen)
            at = 0
            for words, size, first in zip(every, sizes.tolist(), begun.tolist(), strict=True):
                c = np.array([*map(frequent.get, words, repeat(0)), n_docs], float)
                mine = by_model[at:at + size]
                at += size
                known = c > 0
                known[-1] = True
                rare = np.flatnonzero(~known)
                values = (size, int((c > 0).sum()), end + (np.log10(c[:-1][known[:-1]] + SMOOTHING) - below).sum(),
                          [words[i] for i in rare.tolist()], mine[rare],
                          first + mixed(mine[known], c[known] / max(1, total)).sum())
                for column, value in zip(out, values, strict=True):
                    column.append(value)
            kinds = [pa.int64(), pa.int64(), pa.float64(), pa.list_(pa.binary()), pa.list_(pa.float64()), pa.float64()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"),
                 *[pa.array(c, t) for c, t in zip(out, kinds, strict=True)]],
                ["doc_id", "held_out", "n_tokens", "known", "base", "rare", "by_model", "score"])

    read = rows.mapInArrow(
        run, f"doc_id {doc_type}, held_out boolean, n_tokens long, known long, base double, "
             "rare array<binary>, by_model array<double>, score double")
    numbered = stored(read.withColumn("row", F.monotonically_increasing_id()), "scored")
    rare = numbered.select("row", F.explode(F.arrays_zip("rare", "by_model")).alias("r")).select(
        "row", F.col("r.rare").alias("word"), F.col("r.by_model").alias("by_model"))
    found = rare.join(counts.where(F.col("c") <= least) if least else counts, "word", "left")
    log = F.log10(F.coalesce("c", F.lit(0)) + SMOOTHING) - below
    # both parts of the mixture as logs, as a long word's probability is less than a double holds
    model_part, share_part = F.col("by_model") + math.log10(1 - SHARE), F.log10(F.col("c") * (SHARE / max(1, total)))
    larger = F.greatest(model_part, share_part)
    mix = F.when(F.col("c").isNull(), model_part).otherwise(
        larger + F.log10(1 + F.pow(F.lit(10.0), F.least(model_part, share_part) - larger)))
    sums = found.groupBy("row").agg(
        F.sum(log).alias("more"), F.count("c").alias("more_known"), F.sum(mix).alias("more_score"))
    return numbered.drop("rare", "by_model").join(sums, "row", "left").select(
        "doc_id", "held_out", "n_tokens",
        (F.col("known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more", F.lit(0.0))).alias("base_score"),
        (F.col("score") + F.coalesce("more_score", F.lit(0.0))).alias("score"))

"""Toxicity by a weighted finite-state pattern grammar.

A lexical transducer turns words into insults, threats, targets, negations and reporting
verbs; a scope transducer weakens what is denied or reported; a clause transducer weighs
insults and threats by the targets around them. The last two are composed into one machine
that runs over each clause with an insult or a threat. A report reaches over a colon and a
closing quotation mark; a second machine reads the clause backwards, for reporting verbs
behind the speech ("you scum, he said"). The insult lexicon (words and word
stems) is learned from a bounded sample of labelled rows; a logistic curve turns the sum
over clauses into a probability.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import fold_remainder, slices, text_of
from clickloom.llm.quality import calibrate, labelled_sample

# The most labelled rows that the lexicon and the curve are learned from.
SAMPLE_ROWS = 20_000
LEXICON_SIZE = 4000
STEM_LENGTHS = (4, 5, 6)
# What a word or stem takes to enter: toxic documents, log odds, share of toxic documents.
MIN_DOCUMENTS, MIN_LOG_ODDS, MIN_SHARE = 4, 3.5, 0.9

# Seed words of the grammar: plain vocabulary in the four languages of the corpus.
INSULTS = "idiot moron loser scum trash clown worthless pathetic disgusting stupid dumm trottel abschaum versager widerlich imbécile crétin abruti minable ordure imbécil basura payaso estúpido patético"
THREATS = "kill hurt destroy murder stab shoot töten umbringen vernichten tuer détruire frapper matar destruir golpear"
TARGETS = "you your yours he she they him her them du dich dir ihr euch sie tu te toi vous ils tú usted ustedes vosotros ellos"
NEGATIONS = "not never no neither nor nicht kein keine nie niemals pas jamais aucun nunca jamás ningún"
REPORTS = "said says wrote quoted reported claimed alleged sagte schrieb berichtete dit écrivit rapporta dijo escribió informó"
SEED_WEIGHT = 4.0

WORD = re.compile(r"\w+")
TOKEN = re.compile(r"\w+|:")
# A mark inside closing quotation marks does not end the clause.
CLAUSE = re.compile(r"""[.!?;\n|]+(?![.!?;\n|"'”’»“])""")


@dataclass
class Transducer:
    """Arcs (state, symbol) -> (output, weight, next state); ``start`` opens a clause.

    A symbol without an arc passes unchanged with weight 1 and keeps the state.
    """

    start: object
    arcs: dict = field(default_factory=dict)

    def step(self, state: object, symbol: str) -> tuple[str, float, object]:
        return self.arcs.get((state, symbol), (symbol, 1.0, state))

    def states(self) -> list:
        found = [self.start]
        for (a, _), (_, _, b) in self.arcs.items():
            found += [x for x in (a, b) if x not in found]
        return found


SYMBOLS = ("insult", "threat", "target", "negation", "report", "colon", "other")


def compose(first: Transducer, second: Transducer) -> Transducer:
    """Outputs of ``first`` are read by ``second``; weights multiply."""
    made = Transducer((first.start, second.start))
    todo, seen = [made.start], {made.start}
    while todo:
        a, b = todo.pop()
        for symbol in SYMBOLS:
            middle, w1, a2 = first.step(a, symbol)
            out, w2, b2 = second.step(b, middle)
            made.arcs[(a, b), symbol] = (out, w1 * w2, (a2, b2))
            if (a2, b2) not in seen:
                seen.add((a2, b2))
                todo.append((a2, b2))
    return made


def scope_transducer(reach: int = 3, denied: float = 0.5, reported: float = 0.6) -> Transducer:
    """A negation weakens the next ``reach`` words up to a colon, a report the rest of the clause."""
    arcs = {}
    for report in (False, True):
        weight = reported if report else 1.0
        for left in range(reach + 1):
            state, after = (report, left), (report, max(0, left - 1))
            for symbol in SYMBOLS:
                scale = weight * (denied if left else 1.0) if symbol in ("insult", "threat") else 1.0
                arcs[state, symbol] = (symbol, scale, after)
            arcs[state, "negation"] = ("negation", 1.0, (report, reach))
            arcs[state, "report"] = ("report", 1.0, (True, left))
            arcs[state, "colon"] = ("colon", 1.0, (report, 0))
    return Transducer((False, 0), arcs)


def trailing_transducer(reach: int = 4, reported: float = 0.6) -> Transducer:
    """Reads a clause from its end: a report among the last ``reach`` words weakens what stands
    before it. Without an insult or threat in between, as that would be what is told."""
    arcs = {}
    for left in range(reach + 1):
        for symbol in SYMBOLS:
            over = symbol in ("insult", "threat", "colon")
            arcs[left, symbol] = (symbol, 1.0, 0 if over else max(0, left - 1))
        if left:
            arcs[left, "report"] = ("report", 1.0, "told")
    for symbol in ("insult", "threat"):
        arcs["told", symbol] = (symbol, reported, "told")
    return Transducer(reach, arcs)


def clause_transducer(aimed: float = 1.5, unaimed_threat: float = 0.25) -> Transducer:
    """An insult counts more behind a target; a threat without one counts little."""
    return Transducer("free", {
        ("free", "target"): ("target", 1.0, "aimed"),
        ("free", "threat"): ("threat", unaimed_threat, "free"),
        ("aimed", "insult"): ("insult", aimed, "aimed"),
        ("aimed", "threat"): ("threat", 1.0, "aimed"),
        ("aimed", "colon"): ("colon", 1.0, "free"),
    })


class Grammar:
    """Scores texts: the lexical transducer followed by the composed scope and clause machine."""

    def __init__(self, words: dict[str, float], stems: dict[str, float]) -> None:
        self.words, self.stems = words, stems
        self.classes = {w: (kind, SEED_WEIGHT) for kind, listed in (
            ("report", REPORTS), ("negation", NEGATIONS), ("target", TARGETS),
            ("threat", THREATS), ("insult", INSULTS)) for w in listed.split()}
        self.classes[":"] = ("colon", 0.0)
        self.machine = compose(scope_transducer(), clause_transducer())
        self.backwards = trailing_transducer()
        self._known: dict[str, tuple[str, float]] = {}

    def lexical(self, word: str) -> tuple[str, float]:
        found = self._known.get(word)
        if found is None:
            weight = self.words.get(word) or max(
                (self.stems.get(word[:n], 0.0) for n in STEM_LENGTHS if len(word) > n), default=0.0)
            found = ("insult", weight) if weight else self.classes.get(word, ("other", 0.0))
            if len(self._known) >= 200_000:
                self._known.clear()
            self._known[word] = found
        return found

    def clause(self, words: list[str]) -> float:
        """Weight of a clause, given as its words and colons."""
        state, found, told = self.machine.start, [], False
        read = [self.lexical(word) for word in words]
        for at, (symbol, weight) in enumerate(read):
            out, scale, state = self.machine.step(state, symbol)
            told = told or symbol == "report"
            if out in ("insult", "threat"):
                found.append((at, weight * scale))
        if not found or not told:
            return sum(weight for _, weight in found)
        state, behind = self.backwards.start, {}
        for at in range(len(read) - 1, -1, -1):
            _, behind[at], state = self.backwards.step(state, read[at][0])
        return sum(weight * behind[at] for at, weight in found)

    def text(self, text: str) -> float:
        """Sum over matched clauses, on a log scale; 0 if no clause matches."""
        lowered, lexical, known = text.lower(), self.lexical, self._known
        hot = False
        for word in set(WORD.findall(lowered)):
            if (known.get(word) or lexical(word))[0] in ("insult", "threat"):
                hot = True
                break
        if not hot:
            return 0.0
        return math.log1p(sum(self.clause(TOKEN.findall(c)) for c in CLAUSE.split(lowered)))


def keys_of(text: str) -> set[str]:
    """Words, and word stems marked with a trailing hyphen."""
    words = set(WORD.findall(text.lower()))
    return words | {f"{w[:n]}-" for w in words for n in STEM_LENGTHS if len(w) > n}


def learn_lexicon(sample: DataFrame) -> tuple[dict[str, float], dict[str, float]]:
    """Words and stems that mark toxic documents, with their smoothed log odds."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 2000, "text", 8 << 20):
            seen: tuple[Counter, Counter] = Counter(), Counter()
            for text, label in zip(batch.column("text"), batch.column("label"), strict=True):
                seen[label.as_py() > 0].update(keys_of(text.as_py()))
            keys = list(seen[0].keys() | seen[1].keys())
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.string()), *[pa.array([s[k] for k in keys], pa.int64()) for s in seen]],
                ["key", "clean", "toxic"])

    n = {r["label"]: r["count"] for r in sample.groupBy((F.col("label") > 0).alias("label")).count().collect()}
    clean, toxic = n.get(False, 0), n.get(True, 0)
    least = max(MIN_DOCUMENTS, int(0.004 * toxic))
    weight = F.log((F.col("toxic") + 0.5) / (toxic + 1)) - F.log((F.col("clean") + 0.5) / (clean + 1))
    rows = sample.select("text", "label").mapInArrow(
        count, "key string, clean long, toxic long").groupBy("key").agg(
        F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")).where(
        F.col("toxic") >= least).withColumn("weight", weight).where(
        (F.col("weight") >= MIN_LOG_ODDS)
        & (F.col("toxic") >= MIN_SHARE * (F.col("toxic") + F.col("clean")))).orderBy(
        (F.col("toxic") * F.col("weight")).desc(), "key").limit(LEXICON_SIZE).collect()
    words = {r["key"]: r["weight"] for r in rows if not r["key"].endswith("-")}
    stems = {r["key"][:-1]: r["weight"] for r in rows if r["key"].endswith("-")}
    return words, stems


@dataclass
class Model:
    words: dict[str, float]
    stems: dict[str, float]
    slope: float
    offset: float

    def probability(self, value: float) -> float:
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, self.slope * value + self.offset))))


def train(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> Model:
    """Without toxic or without clean labels the seed words alone make the score."""
    sample = labelled_sample(docs, labels, "toxic", rows)
    words, stems = learn_lexicon(sample)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grammar = Grammar(words, stems)
        for batch in slices(batches, 1000, "text"):
            yield pa.RecordBatch.from_arrays([
                pa.array([grammar.text(x.as_py()) for x in batch.column("text")], pa.float64()),
                batch.column("label")], ["value", "label"])

    found = sample.select("text", "label").mapInArrow(measure, "value double, label int").collect()
    x, y = np.array([r["value"] for r in found]), np.array([r["label"] > 0 for r in found], bool)
    if len(x) < 10 or y.all() or not y.any():
        return Model(words, stems, 2.0, -2.0)
    slope, offset = calibrate(x, y)
    return Model(words, stems, slope, offset)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out and score of every row; an empty or null text scores lowest."""
    doc_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grammar = Grammar(model.words, model.stems)
        for batch in slices(batches, 1000, "text"):
            scores = [model.probability(grammar.text(x.as_py())) for x in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(scores, pa.float64())],
                ["doc_id", "held_out", "score"])

    rows = docs.select("doc_id", (fold_remainder(F.col("doc_id"), 3) == 1).alias("held_out"),
                       text_of().alias("text"))
    return rows.mapInArrow(run, f"doc_id {doc_type}, held_out boolean, score double")


def without_toxic(docs: DataFrame, model: Model, threshold: float = 0.7) -> DataFrame:
    """The rows whose score stays below ``threshold``, with all their columns."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grammar = Grammar(model.words, model.stems)
        for batch in slices(batches, 1000, "text"):
            good = [model.probability(grammar.text(x.as_py() or "")) < threshold
                    for x in batch.column("text")]
            yield batch.filter(pa.array(good, pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)

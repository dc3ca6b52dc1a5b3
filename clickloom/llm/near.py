"""Near-duplicate documents by Order MinHash.

A sketch takes the least occurrence-labelled five-word shingles under several hash
functions and keeps them in text order, so it agrees for texts of high ordered similarity.
Texts that share a sketch are candidates; a banded alignment of their shingle sequences
decides. Short texts also share keys of their shingles with a few left out, which finds all
pairs of them. Exact copies are folded first.

In a bucket, members are compared with pivots, not with each other. The first pivot is the
member that shares most with others; of the members that stay outside its class up to four are
pivots of a second round. So a large group of copies costs one comparison per member, and small
buckets are done. What is left are crowded buckets of texts that share a passage or a template
and are no copies. Among the texts of those, all links are found by a prefix join: a text
offers its rarest shingles only, so many that two texts at the threshold share one of them.
No link that a bucket offers is lost, and a shared template brings no pairs.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import slices, stored, text_of
from clickloom.llm.components import components

SHINGLE_WORDS = 5
SIMILARITY = 0.8
# Two long texts at the threshold agree in one sketch with probability 0.8 ** 5, and miss all
# 24 with less than 1 in 10,000. Of few shingles the least are drawn without putting back, so
# short texts agree less often.
SKETCHES, LEAST = 24, 5
# Texts of at most so many shingles get keys of what is left when a fifth of their shingles
# or less goes; two such texts at the threshold always share one. At most 106 keys a text.
SHORT = 14
# Pivots of a bucket in the first and in the second round.
PIVOTS = (1, 4)
# Shingles that come last in the order of rarity, at most; more would only save more pairs.
COMMON_SHINGLES = 200_000
# 64-bit words of the signature by which a pair is refused before it is made.
SIGNATURE_WORDS = 16


class Shingler:
    """64-bit hashes of the five-word shingles of a text, in order; case does not count.

    A text of fewer words is one shingle; one without words has none.
    """

    def __init__(self) -> None:
        self._known: dict[str, int] = {}
        self._factors = np.random.default_rng(5).integers(
            1 << 40, 1 << 63, SHINGLE_WORDS, dtype=np.uint64) | np.uint64(1)

    def __call__(self, text: str) -> np.ndarray:
        known, words = self._known, text.lower().split()
        try:
            coded = [known[w] for w in words]
        except KeyError:
            if len(known) > 300_000:
                known.clear()
            for w in words:
                if w not in known:
                    known[w] = xxhash.xxh3_64_intdigest(w)
            coded = [known[w] for w in words]
        if not coded:
            return np.zeros(0, np.uint64)
        h = np.array(coded, np.uint64)
        if len(h) < SHINGLE_WORDS:
            h = np.concatenate([h, np.zeros(SHINGLE_WORDS - len(h), np.uint64)])
        n = len(h) - SHINGLE_WORDS + 1
        return _mixed(sum(h[i:i + n] * f for i, f in enumerate(self._factors)))


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


@cache
def _functions(sketches: int) -> tuple[np.ndarray, np.ndarray]:
    random = np.random.default_rng(23)
    return (random.integers(1, 1 << 63, sketches, dtype=np.uint64) | np.uint64(1),
            random.integers(1, 1 << 63, sketches, dtype=np.uint64))


def _labelled(shingles: np.ndarray) -> np.ndarray:
    """The shingles told apart by how many equal ones stand before them."""
    n = len(shingles)
    if n == 0:
        return shingles
    order = np.argsort(shingles, kind="stable")
    ordered = shingles[order]
    begin = np.concatenate([[True], ordered[1:] != ordered[:-1]])
    nth = np.arange(n) - np.maximum.accumulate(np.where(begin, np.arange(n), 0))
    labelled = np.empty(n, np.uint64)
    labelled[order] = ordered + nth.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return labelled


def order_minhash(shingles: np.ndarray, sketches: int = SKETCHES, least: int = LEAST) -> list[int]:
    """One key per sketch: the least labelled shingles, in text order."""
    n = len(shingles)
    if n == 0:
        return []
    labelled = _labelled(shingles)
    odd, add = _functions(sketches)
    drawn = _mixed(labelled[None, :] * odd[:, None] + add[:, None])
    if n > least:
        at = np.sort(np.argpartition(drawn, least - 1, axis=1)[:, :least], axis=1)
    else:
        at = np.broadcast_to(np.arange(n), (sketches, n))
    key = add + np.arange(sketches, dtype=np.uint64)
    for i in range(at.shape[1]):
        key = _mixed(key * np.uint64(0x9FB21C651E98DF25) + shingles[at[:, i]])
    return key.view(np.int64).tolist()


@cache
def _kept(n: int, out: int) -> np.ndarray:
    """The places that stay, in order, for each way to leave out so many of n."""
    return np.array(list(combinations(range(n), n - out)))


def left_out(shingles: np.ndarray) -> list[int]:
    """Keys of a short text with each choice of a fifth of its shingles or less left out.

    If an alignment at the threshold matches m shingles, neither text has more than m / 4
    others, which are a fifth of its own at most; so both get the key of the matched ones.
    """
    n, keys = len(shingles), set()
    for out in range(n // 5 + 1) if 0 < n <= SHORT else ():
        at = _kept(n, out)
        key = np.full(len(at), 0x51ED270B35AE2F17 + n - out, np.uint64)
        for i in range(n - out):
            key = _mixed(key * np.uint64(0x9FB21C651E98DF25) + shingles[at[:, i]])
        keys.update(key.view(np.int64).tolist())
    return sorted(keys)


def aligned(a: np.ndarray, b: np.ndarray, similarity: float = SIMILARITY) -> bool:
    """Whether an alignment of two shingle sequences matches enough of them.

    Similarity is matched shingles over all shingles of both, matched ones counted once. A
    match off the diagonal by more than the shingles that may stay unmatched cannot be
    part of a good alignment, so only a band is aligned, by bit-parallel longest common
    subsequence.
    """
    n, m = len(a), len(b)
    if not n or not m:
        return n == m
    need = int(np.ceil(similarity * (n + m) / (1 + similarity) - 1e-9))
    if need > min(n, m):
        return False
    a, b = a.tolist(), b.tolist()
    if sum((Counter(a) & Counter(b)).values()) < need:
        return False
    band = max(n, m) - need
    places: dict[int, int] = {}
    for i, x in enumerate(a):
        places[x] = places.get(x, 0) | 1 << i
    every, window = (1 << n) - 1, (1 << (2 * band + 1)) - 1
    row = every
    for j, x in enumerate(b):
        hit = places.get(x)
        if hit:
            near = window << (j - band) if j >= band else window >> (band - j)
            some = row & hit & near
            row = ((row + some) | (row - some)) & every
    return n - row.bit_count() >= need


def sketched(docs: DataFrame) -> DataFrame:
    """doc_id, hashes of the exact text, count of shingles and keys of each row."""
    doc_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler()
        for batch in slices(batches, 512, "text"):
            counts, keys = [], []
            for text in batch.column("text"):
                shingles = shingler(text.as_py())
                counts.append(len(shingles))
                keys.append(order_minhash(shingles) + left_out(shingles))
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in ("doc_id", "t1", "t2", "t3")], pa.array(counts, pa.int32()),
                 pa.array(keys, pa.list_(pa.int64()))], ["doc_id", "t1", "t2", "t3", "n", "sketches"])

    return _hashed(docs).select("doc_id", "t1", "t2", "t3", "text").mapInArrow(
        run, f"doc_id {doc_type}, t1 long, t2 long, t3 int, n int, sketches array<long>")


TEXT_KEY = ["t1", "t2", "t3"]


def _hashed(docs: DataFrame) -> DataFrame:
    text = text_of()
    return docs.withColumns({
        "t1": F.xxhash64(text), "t2": F.crc32(text.cast("binary")), "t3": F.octet_length(text),
        "text": text})


def classes(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """t1, t2, t3, node and class of each distinct text; ``first`` is its least doc_id.

    Texts are joined to classes through chains of links. Empty and null texts are equal,
    as are exact copies; other columns than doc_id and text are not read.
    """
    docs = docs.select("doc_id", "text")
    texts = stored(stored(sketched(docs).groupBy(*TEXT_KEY).agg(
        F.min("doc_id").alias("first"), F.first("n").alias("n"), F.first("sketches").alias("sketches"),
    ), "texts").withColumn("node", F.monotonically_increasing_id()), "nodes")
    member = texts.select("node", "n", F.explode("sketches").alias("bucket"))
    sizes = member.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
    member = stored(member.join(sizes, "bucket"), "members")
    score = member.groupBy("node").agg(F.sum("size").alias("score"))
    members = stored(member.drop("size").join(score, "node"), "scored-members")
    wanted = texts.join(score.select("node"), "node").select(
        "node", *TEXT_KEY, F.col("first").alias("doc_id"))
    found = _hashed(docs).join(wanted.drop("doc_id"), TEXT_KEY).groupBy("node").agg(
        F.min("text").alias("text"))
    links = _links(members, stored(found, "candidate-texts"), similarity)
    return texts.join(links, "node", "left").select(
        *TEXT_KEY, "first", "node", F.coalesce("label", "node").alias("class"))


def _links(members: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """node, label of the texts that link to another one."""
    spark = members.sparkSession
    labels = spark.createDataFrame([], "node long, label long")
    tested = spark.createDataFrame([], "a long, b long")
    served = spark.createDataFrame([], "bucket long, node long")
    bags = None
    # Rounds over buckets, then over the rare shingles of the crowded texts; a last round
    # of each stage leaves pivots for a full join.
    for turn, count in enumerate((*PIVOTS, 0, *PIVOTS, 0)):
        state = members.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
        top = state.groupBy("bucket").agg(
            F.max(F.struct("score", -F.col("node"), "node", "label", "n")).alias("top"),
            F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high")
        members = stored(state.join(top.select("bucket", F.col("top.label").alias("main"),
                                               F.col("top.node").alias("top")), "bucket").select(
            "bucket", "node", "n", "score", "label", "main", "top"), "open-buckets")
        outside = members.where("label <> main").join(served, ["bucket", "node"], "left_anti")
        if not count and bags is None:
            crowded = members.join(outside.select("bucket").distinct(), "bucket", "left_semi")
            bags = _rare_bags(crowded.select("node", "label").distinct(), texts, similarity)
            # texts that share a rare shingle are first compared with pivots, so a large
            # group of near copies is linked before the join of all its pairs
            members = _token_members(bags)
            served = spark.createDataFrame([], "bucket long, node long")
            continue
        if not count:
            fresh = bags.drop("label").join(labels, "node", "left").withColumn(
                "label", F.coalesce("label", "node"))
            pairs = _prefix_pairs(fresh, similarity)
        else:
            if count == PIVOTS[0]:
                pivots = members.where("node = top")
            else:
                pivots = outside.groupBy("bucket", F.pmod(
                    F.xxhash64("node", F.lit(turn)), F.lit(count)).alias("draw")).agg(
                    F.max(F.struct("score", -F.col("node"), "node", "label", "n")).alias("top")).select(
                    "bucket", "top.node", "top.label", "top.n")
            pivots = stored(pivots.select("bucket", "node", "label", "n"), "pivots")
            served = served.union(pivots.select("bucket", "node"))
            p = pivots.select("bucket", F.col("node").alias("pivot"), F.col("label").alias("p_label"),
                              F.col("n").alias("p_n"))
            # a pair whose counts of shingles differ too much cannot reach the similarity
            pairs = members.join(p, "bucket").where(
                (F.col("label") != F.col("p_label"))
                & (F.least("n", "p_n") >= similarity * F.greatest("n", "p_n"))).select(
                F.least("node", "pivot").alias("a"), F.greatest("node", "pivot").alias("b")).distinct()
        pairs = stored(pairs.join(tested, ["a", "b"], "left_anti"), "pairs")
        tested = tested.union(pairs)
        good = stored(_verified(pairs, texts, similarity), "links")
        if not good.isEmpty():
            # links between the labels so far are enough to go on
            a, b = (labels.select(F.col("node").alias(c), F.col("label").alias(f"l{c}")) for c in "ab")
            mapped = good.join(a, "a", "left").join(b, "b", "left").select(
                F.coalesce("la", "a").alias("a"), F.coalesce("lb", "b").alias("b"))
            old = labels.select(F.col("node").alias("a"), F.col("label").alias("b"))
            labels = components(mapped.union(old))
        members = members.select("bucket", "node", "n", "score")
    return labels


def rare_pairs(nodes: DataFrame, texts: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """a, b: pairs of texts in different classes that may be similar, by a prefix join.

    Aligned similarity never exceeds that of the bags of shingles. In any fixed order of all
    shingles, two bags at the threshold share one of the first n - ceil(similarity n) + 1 of
    each; with rare shingles first few texts share those. Counts only choose the order, so
    it does not matter that a task counts for itself what it sees once. A pair also needs
    lengths that fit, enough shingles on both sides of the shared one, and signatures that
    differ in no more bits than shingles may differ: each shingle sets one bit, so one that
    only one text has changes one bit at most.
    """
    return _prefix_pairs(_rare_bags(nodes, texts, similarity), similarity)


def _rare_bags(nodes: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """node, label, n, tokens (the rarest shingles that a text offers), bits (its signature)."""
    own = stored(texts.join(nodes, "node").select("node", "label", "text"), "crowded-texts")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, gathered, waiting = Shingler(), [], 0

        def told() -> pa.RecordBatch:
            tokens, counts = np.unique(np.concatenate(gathered), return_counts=True)
            often = counts > 1
            return pa.RecordBatch.from_arrays(
                [pa.array(tokens[often].view(np.int64)), pa.array(counts[often], pa.int64())], ["token", "seen"])

        for batch in slices(batches, 512, "text"):
            for text in batch.column("text"):
                gathered.append(_labelled(shingler(text.as_py())))
                waiting += len(gathered[-1])
            if waiting > 1 << 20:
                yield told()
                gathered, waiting = [], 0
        if gathered:
            yield told()

    seen = own.select("text").mapInArrow(counted, "token long, seen long").groupBy("token").agg(
        F.sum("seen").alias("seen"))
    common = np.array(seen.orderBy(F.desc("seen"), "token").limit(COMMON_SHINGLES).collect(), np.int64).reshape(-1, 2)
    common = common[np.argsort(common[:, 0].view(np.uint64) if len(common) else [])]
    tokens, often = common[:, 0].copy().view(np.uint64), common[:, 1]

    def offered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler()
        for batch in slices(batches, 256, "text"):
            sizes, chosen, signatures = [], [], []
            for text in batch.column("text"):
                bag = _labelled(shingler(text.as_py()))
                n, rank = len(bag), np.zeros(len(bag), np.int64)
                if len(tokens):
                    at = np.minimum(np.searchsorted(tokens, bag), len(tokens) - 1)
                    rank = np.where(tokens[at] == bag, often[at], 0)
                first = n - int(np.ceil(similarity * n - 1e-9)) + 1
                bits = np.zeros(64 * SIGNATURE_WORDS, np.uint8)
                bits[bag % np.uint64(len(bits))] = 1
                sizes.append(n)
                chosen.append(bag[np.lexsort((bag, rank))[:first]].view(np.int64).tolist())
                signatures.append(np.packbits(bits).view(np.int64).tolist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), batch.column("label"), pa.array(sizes, pa.int64()),
                 pa.array(chosen, pa.list_(pa.int64())), pa.array(signatures, pa.list_(pa.int64()))],
                ["node", "label", "n", "tokens", "bits"])

    return stored(own.mapInArrow(
        offered, "node long, label long, n long, tokens array<long>, bits array<long>"), "rare-shingles")


def _token_members(bags: DataFrame) -> DataFrame:
    """bucket (a rare shingle that more texts offer), node, n, score, as of sketch buckets."""
    member = bags.select("node", "n", F.explode("tokens").alias("bucket"))
    sizes = member.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
    member = member.join(sizes, "bucket")
    score = member.groupBy("node").agg(F.sum("size").alias("score"))
    return stored(member.drop("size").join(score, "node"), "token-members")


def _prefix_pairs(bags: DataFrame, similarity: float) -> DataFrame:
    """a, b: pairs of texts of different labels that share a rare shingle and may be similar."""
    rows = bags.select("node", "label", "n", F.posexplode("tokens").alias("place", "token"))
    shared = rows.groupBy("token").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high")
    rows = rows.join(shared.select("token"), "token").join(bags.select("node", "bits"), "node")
    x, y = (rows.select("token", *[F.col(c).alias(f"{c}_{side}") for c in ("node", "label", "n", "place", "bits")])
            for side in "xy")
    both = F.col("n_x") + F.col("n_y")
    need = F.ceil(F.lit(similarity / (1 + similarity)) * both - 1e-9)
    most = F.least("place_x", "place_y") + F.least(
        F.col("n_x") - F.col("place_x"), F.col("n_y") - F.col("place_y"))
    differ = sum((F.bit_count(F.get("bits_x", F.lit(i)).bitwiseXOR(F.get("bits_y", F.lit(i))))
                  for i in range(SIGNATURE_WORDS)), F.lit(0))
    return x.join(y, "token").where(
        (F.col("node_x") < F.col("node_y")) & (F.col("label_x") != F.col("label_y"))
        & (F.least("n_x", "n_y") >= similarity * F.greatest("n_x", "n_y")) & (most >= need)
        & (differ <= both - 2 * need)).select(
        F.col("node_x").alias("a"), F.col("node_y").alias("b")).distinct()


def _verified(pairs: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler()
        for batch in slices(batches, 256, "ta"):
            last, left = None, None
            good = []
            for ta, tb in zip(batch.column("ta"), batch.column("tb"), strict=True):
                ta = ta.as_py()
                if ta != last:
                    last, left = ta, shingler(ta)
                good.append(aligned(left, shingler(tb.as_py()), similarity))
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    with_texts = pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("ta")), "a").join(
        texts.select(F.col("node").alias("b"), F.col("text").alias("tb")), "b")
    return with_texts.select("a", "b", "ta", "tb").mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """doc_id and class_id of every row: the least doc_id of its class.

    Rows with a null doc_id take part; repeated rows share a class. A text without words
    is similar to its exact copies only.
    """
    found = classes(docs, similarity)
    named = found.groupBy("class").agg(F.min("first").alias("class_id"))
    texts = found.join(named, "class").select(*TEXT_KEY, "class_id")
    return _hashed(docs.select("doc_id", "text")).select("doc_id", *TEXT_KEY).join(
        texts, TEXT_KEY).select("doc_id", "class_id")


def deduplicated(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """One row of each class, with all its columns: that with the least doc_id."""
    found = classes(docs, similarity)
    kept = found.groupBy("class").agg(F.min(F.struct("first", "node")).alias("m")).select("m.node")
    keys = found.join(kept, "node").select(*[F.col(c).alias(f"_{c}") for c in TEXT_KEY],
                                           F.col("first").alias("_first"))
    # The row travels as one column, so no name of its columns can clash.
    text = text_of()
    own = docs.select(
        F.struct(*[f"`{c}`" for c in docs.columns]).alias("row"), F.col("doc_id").alias("_doc_id"),
        F.xxhash64(text).alias("_k1"), F.crc32(text.cast("binary")).alias("_k2"), F.octet_length(text).alias("_k3"))
    same = ((own["_k1"] == keys["_t1"]) & (own["_k2"] == keys["_t2"]) & (own["_k3"] == keys["_t3"])
            & own["_doc_id"].eqNullSafe(keys["_first"]))
    # rows that are repeated with their doc_id count once
    return own.join(keys, same, "left_semi").dropDuplicates(
        ["_doc_id", "_k1", "_k2", "_k3"]).select("row.*")

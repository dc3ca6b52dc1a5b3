"""The training-data operators against brute force, on small and odd tables."""

import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from clickloom.llm import common, decontaminate, lm, near, packing, quality, sharding, suffix, topk, toxicity, warc
from clickloom.llm.components import components
from clickloom.llm.subwords import subwords
from clickloom.session import work_path

# Columns whose names the operators use inside.
CLASHES = "k1 long, t1 string, found string, shard string, slot string, label string, sequence_id string"


def words(seed, count, vocabulary=4000):
    draw = random.Random(seed)
    return [f"w{draw.randrange(vocabulary)}" for _ in range(count)]


@pytest.fixture(scope="module")
def odd(spark):
    common.ship(spark)
    shared = " ".join(words(1, 80))
    base = words(2, 200)
    edited = base[:100] + ["changed"] + base[101:]
    texts = [None, "", " ", "a", shared, shared, " ".join(base), " ".join(edited), " ".join(words(3, 150)),
             " ".join(words(4, 30)) + " " + shared + " " + " ".join(words(5, 30)), "x" * 700, "né " * 30_000,
             " ".join(words(6, 40)) + " ß€ 漢字 " + " ".join(words(7, 40))]
    rows = [(i, t, *[None] * 7) for i, t in enumerate(texts)]
    rows += [(None, "text of no id", *["c" if i else 1 for i in range(7)]), (8, texts[8], *[None] * 7)]
    return spark.createDataFrame(rows, f"doc_id long, text string, {CLASHES}")


def rows_of(df):
    return [(r["doc_id"], r["text"] or "") for r in df.select("doc_id", "text").collect()]


def brute_repeats(texts, length):
    data = [t.encode() for t in texts]
    seen = Counter(b[i:i + length] for b in data for i in range(len(b) - length + 1))
    result = []
    for b in data:
        gone = [False] * len(b)
        for i in range(len(b) - length + 1):
            if seen[b[i:i + length]] > 1:
                gone[i:i + length] = [True] * length
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        result.append((len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return result


@pytest.mark.parametrize("crowded", [suffix.CROWDED, 1])
def test_suffix_dedup(spark, odd, crowded):
    docs = odd.where("doc_id is null or doc_id <> 11")
    got = suffix.remove_repeats(docs, crowded=crowded).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()
    rows = rows_of(docs)
    expected = [(i, *b) for (i, _), b in zip(rows, brute_repeats([t for _, t in rows], 200), strict=True)]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, expected))
    assert suffix.remove_repeats(docs.limit(0)).count() == 0
    kept = suffix.without_repeats(docs.withColumn("n_chars", F.length("text")), crowded=crowded)
    assert kept.columns == [*docs.columns, "n_chars"]
    assert all(len(r["text"]) == r["n_chars"] for r in kept.where("text is not null").collect())


def test_suffix_array_by_brute_force():
    draw = random.Random(5)
    for _ in range(60):
        length = draw.choice([3, 8, 21])
        parts = [bytes(draw.choice(b"abc") for _ in range(draw.randrange(80))) for _ in range(draw.randrange(1, 6))]
        seen = Counter(p[i:i + length] for p in parts for i in range(len(p) - length + 1))
        flags = [[seen[p[i:i + length]] > 1 for i in range(len(p) - length + 1)] for p in parts]
        assert [f.tolist() for f in suffix.repeated_windows(parts, length)] == flags
        raw = bytes([255]).join(parts)
        text = np.frombuffer(raw, np.uint8)
        assert suffix.suffix_array(text, 1000).tolist() == sorted(range(len(raw)), key=lambda i: raw[i:])


def test_sharding(spark, odd):
    many = spark.range(3000).select(
        F.col("id").alias("doc_id"), F.expr("repeat('ab ', int(id % 97) + 1)").alias("text"),
        F.concat(F.lit("s"), F.col("id") % 5).alias("source"), F.lit("en").alias("lang"))
    got = sharding.kd_shards(many, shards=8).toPandas()
    bytes_of = got.groupby("shard")["size"].sum()
    assert sorted(bytes_of.index) == list(range(8)) and bytes_of.max() - bytes_of.min() < 0.05 * bytes_of.mean()
    for _, part in got.groupby("shard"):
        assert sorted(part["slot"]) == list(range(len(part)))
    text_rows = odd.withColumns({"source": F.lit(None).cast("string"), "lang": F.lit("en")})
    got = sharding.kd_shards(text_rows, shards=4).collect()
    expected = Counter((i, len(t.encode()) + 1, zlib.crc32(t.encode())) for i, t in rows_of(odd))
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == expected
    assert sharding.kd_shards(text_rows.limit(0)).count() == 0


def test_warc_round_trip(spark):
    common.ship(spark)
    long = "<p>€\r\n\r\nWARC/1.1\r\n</p>" * 20
    rows = [(1, "http://a", long), (2, "http://b\r\nx", long), (2, "http://b", long), (3, None, "short"), (4, "u", "short"),
            (5, "u", None), (6, "u", ""), (None, "u", long), (7, "u", "n" * 100), (8, "u", "n" * 100)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit("clash"))
    got = warc.round_trip(pages, payload=True).select(
        warc.field("page-id").alias("page"), "response.*", warc.field("revisited-page-id").alias("first"), "request").collect()
    assert len(got) == len(rows) and all(r["request"]["id"] for r in got)
    bodies = Counter(bytes(r["payload"]).decode() for r in got if r["warc_type"] == "response")
    assert bodies == Counter({long: 1, "short": 2, "": 2, "n" * 100: 1})
    revisits = {(r["page"], r["first"], r["http_length"]) for r in got if r["warc_type"] == "revisit"}
    assert revisits == {("1", None, len(long.encode())), ("2", None, len(long.encode())), ("8", "7", 100)}
    assert warc.round_trip(pages.limit(0)).count() == 0


def test_top_k(spark):
    common.ship(spark)
    draw = np.random.default_rng(4)
    vectors = [(i, draw.normal(size=6).tolist()) for i in range(160)] + [(i, [0.5] * 6) for i in range(160, 220)]
    vectors += [(40, [0.5] * 6), (None, [1.0] * 6), (500, None), (520, [1.0, float("nan")] * 3), (540, [1.0, None] * 3), (560, [1.0])]
    table = spark.createDataFrame(vectors, "vec_id long, embedding array<float>").withColumn("row", F.lit("clash"))
    got = topk.top_k(table, k=20).collect()
    rows = [(i, np.floor(64 * np.float32(v).astype(float)).astype(int)) for i, v in vectors[:222]]
    expected = Counter()
    for at, (i, q) in enumerate(rows):
        if i is not None and i % 20 == 0:
            best = sorted(((-int(q @ c), math.inf if j is None else j, j) for b, (j, c) in enumerate(rows) if b != at))
            expected.update((i, n, j, -s) for n, (s, _, j) in enumerate(best[:20], 1))
    assert Counter(tuple(r) for r in got) == expected
    assert topk.top_k(table.limit(0)).count() == 0


def test_uniform_cutoff_sends_few_entries_and_all_winners():
    draw = np.random.default_rng(8)
    for kind, scale in ((np.float32, 8), (np.int64, 1 << 27)):
        q, c = (np.floor(scale * draw.normal(size=(n, 16))).astype(kind) for n in (40, 3000))
        lists = topk._partial_scores(q, c)
        total = sum(lists).astype(np.int64)
        cutoff = -np.sort(-total, axis=1)[:, 19]
        sent = set(zip(*(x.tolist() for x in topk._sent(lists, cutoff.astype(float))), strict=True))
        assert all((i, j) in sent for i, j in zip(*np.nonzero(total >= cutoff[:, None]), strict=True))
        assert len(sent) < total.size // 2
    everything = topk._sent(lists, np.full(40, -np.inf))
    assert len(everything[0]) == total.size


def test_components(spark):
    draw = random.Random(2)
    edges = [(draw.randrange(120), draw.randrange(120)) for _ in range(80)] + [(0, i) for i in range(200, 260)]
    label = {n: n for e in edges for n in e}
    for _ in label:
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    got = {r["node"]: r["label"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {n: v for n, v in label.items() if n in got} and all(n in got or v == n for n, v in label.items())


def test_near_duplicates(spark, odd):
    got = [(r["doc_id"], r["class_id"]) for r in near.near_duplicates(odd).collect()]
    assert len(got) == odd.count()
    classes = dict(got)
    assert classes[4] == classes[5] == 4 and classes[6] == classes[7] == 6
    assert classes[0] == classes[1] == 0 and got.count((8, 8)) == 2
    assert all(classes[i] == i for i in (3, 9, 10, 11, 12))
    kept = near.deduplicated(odd)
    assert kept.columns == odd.columns
    assert sorted(r["doc_id"] for r in kept.where("doc_id is not null").collect()) == [0, 2, 3, 4, 6, 8, 9, 10, 11, 12]
    assert near.near_duplicates(odd.limit(0)).count() == 0


def test_short_near_duplicates(spark):
    common.ship(spark)
    draw, shingler, pairs = random.Random(6), near.Shingler(), 0
    for _ in range(4000):
        a = [draw.randrange(40) for _ in range(draw.randrange(1, near.SHORT + 1))]
        b = [x for x in a if draw.random() < 0.85] + [99] * draw.randrange(2)
        a, b = (np.array(x, np.uint64) for x in (a, b))
        if 0 < len(b) <= near.SHORT and near.aligned(a, b):
            pairs += 1
            assert set(near.left_out(a)) & set(near.left_out(b))
    assert pairs > 500
    assert all(len(k := near.left_out(shingler(" ".join(words(n, n))))) == len(set(k)) <= 106 for n in range(19))
    rows = []
    for i in range(60):  # whole texts, and the same without their last word
        whole = [f"s{i}-{at}" for at in range(9 + i % 10)]
        rows += [(2 * i, " ".join(whole)), (2 * i + 1, " ".join(whole[:-1]))]
    got = near.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"]: r["class_id"] for r in got} == {i: i - i % 2 for i, _ in rows}


def test_near_duplicates_in_crowded_buckets(spark):
    common.ship(spark)
    template, rows = words(20, 268), []
    for family in range(60):  # two texts of a family reach the threshold, those of two families just do not
        shared = template + [f"f{family}-{i}" for i in range(6)]
        rows += [(2 * family + one, " ".join(shared + [f"f{family}-{one}-{i}" for i in range(30)])) for one in (0, 1)]
    shingler = near.Shingler()
    coded = [shingler(t) for _, t in rows]
    alike = {(a, b) for b in range(len(rows)) for a in range(b) if near.aligned(coded[a], coded[b])}
    assert alike == {(2 * f, 2 * f + 1) for f in range(60)}
    sketches = Counter(k for c in coded for k in near.order_minhash(c))
    assert max(sketches.values()) > 60
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["class_id"] for r in near.near_duplicates(docs).collect()}
    assert got == {i: i - i % 2 for i, _ in rows}


def test_alignment_is_the_ordered_overlap():
    draw = random.Random(8)
    for _ in range(200):
        a = [draw.randrange(9) for _ in range(draw.randrange(1, 25))]
        b = [x for x in a if draw.random() < 0.9] + [draw.randrange(9) for _ in range(draw.randrange(4))]
        if not b:
            continue
        row = [0] * (len(b) + 1)
        for x in a:
            last = row[:]
            for j, y in enumerate(b, 1):
                row[j] = last[j - 1] + 1 if x == y else max(last[j], row[j - 1])
        same = row[-1] / (len(a) + len(b) - row[-1]) >= 0.8
        assert near.aligned(np.array(a), np.array(b)) == same


def test_packing(spark, odd):
    from tokenizers import Tokenizer
    import public_tokenizers

    reference = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for text in ["a  b", " a", "a ", "x\n \ny", "don't 12 34\t  z", "a \n b", "né ß€ 漢字", "", "<|endoftext|>", "a  b"]:
        ids = np.frombuffer(subwords().encode(text), np.uint32).tolist()
        assert ids == reference.encode(text, add_special_tokens=False).ids, text
    got = packing.pack(odd, group_pieces=8, ids=True).toPandas()
    lengths = Counter()
    for i, t in rows_of(odd):
        n = len(reference.encode(t, add_special_tokens=False).ids) + 1
        lengths.update((i, a, min(1024, n - a), n) for a in range(0, n, 1024))
    found = Counter((None if math.isnan(i) else int(i), a, b, n) for i, a, b, n in zip(
        got["doc_id"], got["start"], got["length"], got["doc_tokens"], strict=True))
    assert found == lengths
    assert all(zlib.crc32(ids) == c for ids, c in zip(got["ids"], got["ids_crc32"], strict=True))
    for _, part in got.sort_values("offset").groupby("sequence_id"):
        ends = (part["offset"] + part["length"]).tolist()
        assert part["offset"].tolist() == [0, *ends[:-1]] and ends[-1] <= 1024
    assert packing.pack(odd.limit(0)).count() == 0


def test_first_fit_decreasing():
    draw = np.random.default_rng(3)
    lengths = draw.integers(1, 1025, 400)
    bins, offsets = packing.first_fit_decreasing(lengths)
    room, expected = [], {}
    for i in np.argsort(-lengths, kind="stable"):
        at = next((b for b, free in enumerate(room) if free >= lengths[i]), len(room))
        if at == len(room):
            room.append(1024)
        expected[i] = (at, 1024 - room[at])
        room[at] -= lengths[i]
    assert {i: (b, o) for i, (b, o) in enumerate(zip(bins, offsets, strict=True))} == expected


def labelled(spark, odd):
    draw = random.Random(4)
    rows, marks = [], []
    for i in range(1000, 1240):
        bad, toxic = i % 4 == 0, i % 3 == 0
        text = [f"{w}%%%" if bad else w for w in words(i, 40)]
        if toxic:
            for _ in range(3):
                text[draw.randrange(40)] = draw.choice(["blorg", "blorga", "blorgo", "scum"])
        rows.append((i, " ".join(text)))
        marks.append((i, int(not bad), int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").unionByName(odd.select("doc_id", "text"))
    labels = spark.createDataFrame([*marks, (None, 1, 1), (3, None, None)], "doc_id long, quality int, toxic int")
    return docs, labels, {i: (q, t) for i, q, t in marks}


def test_classifiers(spark, odd):
    docs, labels, marks = labelled(spark, odd)
    for at, scored, cut in ((0, quality.score(docs, quality.train(docs, labels)), 0.5),
                            (1, toxicity.score(docs, toxicity.train(docs, labels)), 0.7)):
        rows = scored.collect()
        assert len(rows) == docs.count() and all(0 <= r["score"] <= 1 for r in rows)
        held = [r for r in rows if r["doc_id"] in marks and r["held_out"]]
        assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows if r["doc_id"] is not None)
        right = sum((r["score"] >= cut) == bool(marks[r["doc_id"]][at]) for r in held)
        assert right >= 0.95 * len(held)
    none = labels.limit(0)
    assert quality.score(docs, quality.train(docs, none)).count() == docs.count()
    kept = toxicity.without_toxic(odd, toxicity.train(docs, labels))
    assert kept.columns == odd.columns and kept.count() == odd.count()
    assert toxicity.score(odd.limit(0), toxicity.train(docs, none)).count() == 0


def test_grammar_weighs_clauses():
    grammar = toxicity.Grammar({}, {})
    plain, aimed = grammar.clause("that scum".split()), grammar.clause("you scum".split())
    denied, told = grammar.clause("not scum".split()), grammar.clause("he said scum".split())
    assert grammar.clause("kill it".split()) < grammar.clause("they kill them".split())
    assert aimed > plain > denied > 0 and told < aimed and grammar.text("all is well. nothing here") == 0


def test_reported_speech_before_and_behind():
    grammar = toxicity.Grammar({}, {})
    plain = grammar.text("you scum")
    for told in ("he said you scum", "he said: you scum", "you scum, he said", "“you scum!” he said",
                 '"You scum," the man said', "she wrote: 'you scum'"):
        assert 0 < grammar.text(told) < plain, told
    # a new sentence is not told, nor is what a verb far from the end follows; a colon ends the address
    assert grammar.text("he said so. you scum") == plain
    assert grammar.text("you scum, they said no more of it on the next day") == plain
    assert grammar.text("you: scum") == grammar.text("that scum")


def test_decontamination(spark, odd):
    item = words(50, 40)
    edited = item[:10] + ["other"] + item[12:30] + ["more", *item[30:]]
    texts = {100: " ".join(words(51, 60) + item), 101: ", ".join([*words(52, 20), *edited]).upper(),
             102: " ".join(item[:25]), 103: " ".join(words(53, 90))}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").unionByName(odd.select("doc_id", "text"))
    benchmark = spark.createDataFrame([(1, " ".join(item)), (2, None), (3, ""), (4, "one two")], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): (r["edits"], r["first_word"]) for r in decontaminate.contaminated(docs, benchmark).collect()}
    assert got == {(100, 1): (0, 60), (101, 1): (3, 20)}
    kept = decontaminate.decontaminated(docs, benchmark)
    assert sorted(set(texts) - {r["doc_id"] for r in kept.collect()}) == [100, 101]
    assert decontaminate.contaminated(docs, benchmark.limit(0)).count() == 0
    assert decontaminate.contaminated(docs.limit(0), benchmark).count() == 0


def test_language_model(spark, odd):
    common_words = words(1, 60, 40)
    texts = [(i, " ".join(random.Random(i).choices(common_words, k=50)) + "\x0bEnd") for i in range(2000, 2150)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").unionByName(
        odd.select("doc_id", "text").where("doc_id is null or doc_id <> 11"))
    got = lm.score(docs, dictionary=30).collect()
    rows = rows_of(docs)
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0
    counts = Counter(w for i, t in rows if not held(i) for w in [*t.encode().lower().split(), None])
    total = sum(counts.values())
    log = lambda w: math.log10((counts[w] + 0.1) / (total + 0.1 * (len(counts) + 1)))
    expected = Counter((i, held(i), len(k := [*t.encode().lower().split(), None]), sum(counts[w] > 0 for w in k), total,
                        round(sum(map(log, k)), 6)) for i, t in rows)
    assert Counter((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6))
                   for r in got) == expected
    assert all(r["score"] < 0 and math.isfinite(r["score"]) for r in got)
    assert lm.score(docs.limit(0)).count() == 0


def test_next_ids_and_words_share_one(spark):
    common.ship(spark)
    known = words(1, 90, 60) + ["once", "onceagain", "é漢"]
    docs = spark.createDataFrame([(i, " ".join(random.Random(i).choices(known, k=70))) for i in range(300)],
                                 "doc_id long, text string")
    train = docs.where(common.fold_remainder(F.col("doc_id"), 10) != 0)
    counts = lm.word_counts(train)
    all_counts = {bytes(r["word"]): r["c"] for r in counts.collect()}
    frequent = dict(sorted(all_counts.items(), key=lambda x: (-x[1], x[0]))[:25])
    model = lm.learn(train, counts, frequent, "byte_bpe_50k")
    beginnings = lm.Beginnings(frequent, "byte_bpe_50k")
    beginnings.settle(model.totals)
    for context in ([], known[:1], known[:5], known * 2, ["onceag"], ["unseen", "x" * 90]):
        context = [w.encode() for w in context]
        ids, seen = beginnings(context)
        word = beginnings.coder(context[-1]) if context else b""
        places = np.arange(len(model.place))
        # every id behind the context, and the end; which of them continue the word is told apart
        more = np.array([beginnings.ends.get(word, 0) if o else beginnings.total.get(word + np.uint16(y).tobytes(), 0)
                         for y, o in zip(places, model.opens, strict=True)], np.float32)
        share = 0.0
        for at in range(0, len(places), 2000):
            some = places[at:at + 2000]
            texts = [np.append(ids, np.uint16(y)) for y in some]
            counts_behind = []
            for m in more[at:at + 2000]:
                c = np.concatenate([seen, np.zeros((1, 3), np.float32)])
                if len(ids):
                    c[len(ids) - 1, 1] = m
                counts_behind.append(c)
            sizes, _, chosen, begun = lm.position_logs(model, texts, counts_behind)
            here = np.cumsum(sizes) - 2
            share += np.exp((chosen + begun)[here].astype(float)).sum()
        sizes, _, chosen, begun = lm.position_logs(model, [ids], [seen])
        share += math.exp(chosen[-1] + begun[-1])
        assert abs(share - 1) < 1e-4
    # scores of whole texts, word by word
    n = sum(all_counts.values()) + train.count()
    for row in lm.score(docs, dictionary=25).where("doc_id < 40").collect():
        text = " ".join(random.Random(row["doc_id"]).choices(known, k=70))
        by_model, _, begun = lm.score_texts(model, *[[x] for x in beginnings(lm.words_of(text))])
        share = [all_counts.get(w, 0) / n for w in lm.words_of(text)] + [train.count() / n]
        expected = begun[0] + sum(math.log10(0.6 * 10 ** m + 0.4 * s) for m, s in zip(by_model, share, strict=True))
        assert abs(row["score"] - expected) < 1e-3 * abs(expected)


def test_every_training_window_is_read_once():
    kind = np.zeros(lm.PLACES + 1, np.int64)
    trainer = lm.Trainer(lm.initial_weights(np.zeros((lm.PLACES, lm.WIDTH)), kind), 0.01)
    seen = []
    trainer.step = lambda g: seen.append(g)
    trainer.read(np.arange(50_257) % lm.PLACES, kind, [np.arange(n, dtype=np.uint16) for n in (0, 1, 63, 64, 500)])
    assert trainer.windows == 1 + 1 + 1 + 2 + 8 and seen


def test_language_model_gradients():
    random_ = np.random.default_rng(1)
    kind = np.append(random_.integers(0, lm.CLASSES, lm.PLACES), 0)
    w = lm.initial_weights(random_.normal(size=(lm.PLACES, lm.WIDTH)), kind)
    at = random_.integers(0, lm.KEPT_IDS, (3, lm.WINDOW))
    target, counted = random_.integers(0, lm.CLASSES, at.shape), np.ones(at.shape)
    _, g = lm.gradients(w, at, target, counted)
    for name in w:
        place = (at[1, 2], 5) if name == "embed" else tuple(random_.integers(0, n) for n in w[name].shape)
        kept = w[name][place]
        losses = []
        for step in (1e-5, -1e-5):
            w[name][place] = kept + step
            losses.append(lm.gradients(w, at, target, counted)[0])
        w[name][place] = kept
        assert abs(g[name][place] - (losses[0] - losses[1]) / 2e-5) < 1e-6


def test_half_windows_score_like_whole_windows():
    random_ = np.random.default_rng(4)
    kind = np.append(random_.integers(0, lm.CLASSES, lm.PLACES), 0)
    w = lm.initial_weights(random_.normal(size=(lm.PLACES, lm.WIDTH)), kind)
    sizes = np.array([1, 5, 31, 32, 33, 63, 64, 65, 96, 97, 300, 1])
    inputs, wanted = random_.integers(0, lm.PLACES, sizes.sum()), random_.integers(0, lm.CLASSES, sizes.sum())
    half, at, expected = lm.WINDOW - lm.OVERLAP, 0, []
    for size in sizes.tolist():
        text = inputs[at:at + size]
        for begin in range(0, max(1, size - lm.OVERLAP), half):  # every window of the text
            window = np.resize(text[begin:begin + lm.WINDOW], lm.WINDOW)[None]
            p = np.exp(lm.attend(w, window)[-1][0] @ w["c"] + w["bc"])
            p /= p.sum(axis=1, keepdims=True)
            for row in range(lm.OVERLAP if begin else 0, min(lm.WINDOW, size - begin)):
                expected.append((p[row, wanted[at + begin + row]], p[row, :lm.OPENING].sum()))
        at += size
    assert len(expected) == sizes.sum()
    for batch in (1, 3, 128):
        got = np.stack(lm.class_shares(w, sizes, inputs, wanted, batch), axis=1)
        assert np.allclose(got, expected, rtol=1e-5, atol=1e-9)


def test_work_folder(spark):
    assert work_path(spark, "a") != work_path(spark, "a")

"""Hard negatives, fill-in-the-middle and personal data against brute force."""

import hashlib
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from clickloom.llm import common, fim, hardneg, near, packing, pii, subwords, warc


# Hard negatives --------------------------------------------------------------------------

def brute_negatives(rows, positives=5, negatives=10, every=100):
    """The same from all scores; ``rows`` are (vec_id, label, whole vector)."""
    order = lambda r: (-r[1], r[0] is None, r[0] or 0)
    result = []
    for i, (anchor, label, vector) in enumerate(rows):
        if anchor is None or anchor % every:
            continue
        scored = [(other, lab, sum(a * b for a, b in zip(vector, v, strict=True)))
                  for j, (other, lab, v) in enumerate(rows) if j != i and len(v) == len(vector)]
        own = sorted(((o, s) for o, lab, s in scored if lab == label), key=order)[:positives]
        for positive, p in own:
            fit = [(o, s) for o, lab, s in scored if lab != label and 30 * p <= 100 * s <= 90 * p]
            for rank, (negative, n) in enumerate(sorted(fit, key=order)[:negatives], start=1):
                result.append((anchor, positive, rank, negative, p, n))
    return sorted(result, key=str)


@pytest.mark.parametrize("blocks", [(8192, 8192), (3, 40)])
def test_hard_negatives(spark, monkeypatch, blocks):
    common.ship(spark)
    monkeypatch.setattr(hardneg, "ANCHOR_BLOCK", blocks[0])
    monkeypatch.setattr(hardneg, "CANDIDATE_BLOCK", blocks[1])
    draw = random.Random(11)
    rows = []
    for i in range(400):
        # a third of all rows bear one label; vectors of few values make ties
        vector = [draw.choice([-0.5, 0.25, 0.5, 1.0]) for _ in range(19)]
        rows.append((i, 0 if i % 3 == 0 else draw.randrange(1, 4), vector, "x"))
    rows += [rows[0], rows[7], (None, 1, rows[5][2], "x"), (500, None, rows[1][2], "x"), (600, 1, None, "x"),
             (700, 1, [None] * 19, "x"), (800, 1, [float("nan")] * 19, "x"), (900, 2, [float("inf")] * 19, "x"),
             (1000, 1, [1.0, 2.0], "x"), (1001, 1, [1.0, 2.5], "x"), (1002, 2, [0.5, 1.0], "x")]
    vectors = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>, place string")
    got = hardneg.hard_negatives(vectors.withColumn("row", F.lit("clash")))
    whole = [(i, lab, [math.floor(256 * x) for x in v]) for i, lab, v, _ in rows if lab is not None and v is not None
             and all(x is not None and math.isfinite(x) for x in v)]
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute_negatives(whole)
    assert hardneg.hard_negatives(vectors.limit(0)).count() == 0
    assert hardneg.hard_negatives(vectors.where("vec_id is null")).count() == 0


def test_vertical_scan_prunes_and_stays_exact():
    draw = np.random.default_rng(3)
    vectors = draw.integers(-300, 300, (2000, 32)).astype(np.float64)
    block, anchor = hardneg.Block(vectors), vectors[5] * np.r_[np.full(4, 20), np.ones(28)]
    seen = []

    def watched(test):
        return lambda lower, upper: seen.append(len(lower)) or test(lower, upper)

    rows, scores = block.scan(anchor, np.arange(2000), watched(hardneg.best_of_label(5)))
    exact = vectors @ anchor
    best = np.sort(exact)[-5:]
    assert set(np.flatnonzero(exact >= best[0])) <= set(rows) and np.array_equal(scores, exact[rows])
    assert seen[0] == 2000 and seen[1] < 400
    low, high = 0.3 * best[-1], 0.9 * best[-1]
    rows, scores = block.scan(anchor, np.arange(2000), watched(hardneg.in_windows([low], [high], 10)))
    inside = np.sort(exact[(exact >= low) & (exact <= high)])[-10:]
    assert np.array_equal(np.sort(scores[(scores >= low) & (scores <= high)])[-10:], inside)
    assert len(rows) < 100


# Fill-in-the-middle ----------------------------------------------------------------------

def odd_texts():
    draw = random.Random(2)
    shared = "".join(draw.choice("abcdé 漢𝄞 ") for _ in range(20_000))
    return [None, "", "a", "é", "𝄞𝄞", " ", "<P>", "x<S>y", "a<M", shared, shared, "front " + shared, "w " * 40_000,
            "y" * 50_000, " lead and tail ", "one\ttwo\n\nthree", "é" * 30_000, "<", "<P", "ab<", "<<>>"]


def test_fill_in_middle(spark):
    common.ship(spark)
    texts = odd_texts()
    rows = [(i * 7 + k, t, "n", 1.5) for k in range(3) for i, t in enumerate(texts)]
    rows += [(None, "no id of its own", "n", 2.5), (9, texts[9], "n", 1.0), (9, texts[9], "n", 1.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n string, at double")
    made = fim.fill_in_middle(docs)
    assert sorted(made.columns) == sorted({*docs.columns, *fim.RESULT})
    got = made.withColumn("again", fim.restored(F.col("output"), F.col("form"))).collect()
    expected = []
    for doc_id, text, _, _ in rows:
        t = text or ""
        digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
        h1, h2, h3, h4 = (int(digest[8 * i:8 * i + 8], 16) for i in range(4))
        a, b = sorted((h1 % (len(t) + 1), h2 % (len(t) + 1)))
        p, m, s = t[:a], t[a:b], t[b:]
        if not t or any(x in t for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
            expected.append((doc_id, len(t), "plain", None, None, t, t))
        elif h4 % 100 < 20:
            expected.append((doc_id, len(t), "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}", t))
        else:
            expected.append((doc_id, len(t), "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}", t))
    fields = ("doc_id", "n", "form", "prefix_units", "middle_units", "output", "again")
    assert sorted((tuple(r[f] for f in fields) for r in got), key=str) == sorted(expected, key=str)
    assert {r["form"] for r in got} == {"plain", "spm", "psm"}
    assert fim.fill_in_middle(docs.limit(0)).count() == 0
    words = fim.fill_in_middle(docs.where("doc_id is not null"), unit="word").withColumn(
        "again", fim.restored(F.col("output"), F.col("form"))).collect()
    assert all(r["again"] == (r["text"] or "") for r in words)
    assert all(r["n"] == len(re.findall(r"[^\x09-\x0d\x20]+", r["text"] or "")) for r in words)


def test_chunks_do_not_depend_on_their_place():
    draw = np.random.default_rng(4)
    passage = draw.integers(97, 123, 60_000).astype(np.uint8)
    first, second = draw.integers(97, 123, 5_000).astype(np.uint8), draw.integers(97, 123, 9_123).astype(np.uint8)

    def chunks(data):
        ends = fim.chunk_ends(data).tolist()
        return [data[a:b].tobytes() for a, b in zip([0, *ends], ends, strict=False)]

    a, b = chunks(np.concatenate([first, passage])), chunks(np.concatenate([second, passage]))
    assert b"".join(a) == np.concatenate([first, passage]).tobytes()
    assert len(set(a) & set(b)) > 40 and max(map(len, a)) <= fim.LONGEST
    assert max(np.diff(fim.chunk_ends(np.zeros(100_000, np.uint8)))) <= fim.LONGEST


@pytest.mark.parametrize("unit", sorted(fim.UNITS))
def test_cuts_by_chunks_equal_cuts_of_the_whole(monkeypatch, unit):
    monkeypatch.setattr(fim, "CHUNK_BITS", 4)
    monkeypatch.setattr(fim, "CACHE_BYTES", 4000)
    monkeypatch.setattr(fim, "SEGMENT", 257)
    cutter, draw = fim.Cutter(unit), random.Random(6)
    for _ in range(200):
        text = "".join(draw.choice("ab é漢𝄞\n ") for _ in range(draw.randrange(400))).encode()
        counted = cutter(text)
        starts = fim.unit_starts(np.frombuffer(text, np.uint8), unit, False).tolist()
        assert counted.units == len(starts)
        for k in range(len(starts) + 1):
            expected = 0 if k == 0 else len(text) if k == len(starts) else starts[k]
            assert counted.byte_of(k) == expected
    before = cutter.cache.misses
    text = b"the same text again " * 50
    cutter(text), cutter(text)
    assert cutter.cache.hits > 0 and cutter.cache.misses - before <= 1 + len(text) // 2


# Personal data -----------------------------------------------------------------------------

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def brute_spans(text):
    found = []
    for rank, (kind, pattern) in enumerate(BASE.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            good = {"email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in m.group().split(".")),
                    "card": 12 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]
            if good:
                found.append((m.start(), rank, f"{kind}:{m.start()}:{m.end()}"))
    return ",".join(s for _, _, s in sorted(found))


def odd_data():
    draw = random.Random(13)
    pieces = ["a", "b.c", "@", "x@y.z", ".", "-", "+", "+1 ", "(555)", " ", "  ", "10.0.0.1", "256.1.2.3", "1.2.3.4.5.6.7.8",
              "4111 1111 1111 1111", "4111-1111-1111-1112", "é", "𝄞", "12", "345", "_", "%", "000", "\n", "+49 (0)30 1234-567"]
    texts = ["".join(draw.choice(pieces) for _ in range(draw.randrange(1, 30))) for _ in range(1500)]
    texts += [None, "", "a@b.co_m@d.ef", "a" * 500, "1" * 500, "0000000255.1.1.1", "é " * 300 + "x@y.zz",
              "4111111111111111 " * 60, "+123456789", "+1234567890123456", "000000000000", "1 2 3 4 5 6 7 8 9 0 1 2"]
    return texts


def test_base_spans(spark):
    texts = odd_data()
    docs = spark.createDataFrame([(i, t, "c", 1) for i, t in enumerate(texts)] + [(None, "x@y.zz", "c", 1), (3, texts[3], "c", 1)],
                                 "doc_id long, text string, spans string, row int")
    found = pii.personal_data(docs, support=10**9)
    assert sorted(found.columns) == sorted(docs.columns)
    for r in found.withColumn("told", pii.digest(F.col("spans"))).collect():
        assert r["told"] == brute_spans(r["text"]), (r["text"] or "")[:200]
    assert pii.personal_data(docs.limit(0)).count() == 0


def test_base_spans_of_very_long_texts(spark):
    """Runs on which the plain patterns would search in quadratic time."""
    expected = {
        "a" * 300_000: "", "1" * 300_000: "", "+1" + " (" * 100_000: "",
        "a@" + "b." * 50_000 + "c": "email:0:100003",
        "1.2." * 50_000 + "9": ",".join(f"ip:{i}:{i + 7}" for i in range(0, 200_000, 8)),
        "x@y.zz, " * 30_000: ",".join(f"email:{i}:{i + 6}" for i in range(0, 240_000, 8)),
    }
    texts = list(expected)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = pii.personal_data(docs, keep=["doc_id"]).select("doc_id", pii.digest(F.col("spans")).alias("told"))
    assert {texts[r["doc_id"]]: r["told"] for r in found.collect()} == expected


def brute_disclosures(texts, support):
    """Disclosure of each (entity, term) with its stem's, from whole documents in Python."""
    word = re.compile(r"""(?<![^\s"'(\[«“„])[^\W\d_](?:(?:[^\W\d_]|['’-]){1,38}[^\W\d_])(?![^\W\d_]|['’-])"""
                      r"""(?=[)\]"',.;:!?»”]*(?:\s|$))""")
    near, having, df, evidence = {}, {}, {}, {}
    for i, text in enumerate(texts):
        words = [(m.group().lower(), m.start(), m.end()) for m in word.finditer(text)]
        for form in {w for w, _, _ in words} | {w[:4] + "*" for w, _, _ in words}:
            df[form] = df.get(form, 0) + 1
        for span in filter(None, brute_spans(text).split(",")):
            kind, start, end = span.split(":")
            start, end = int(start), int(end)
            value = text[start:end]
            value = value.lower() if kind == "email" else value if kind == "ip" else re.sub("[^0-9]", "", value)
            entity = f"{kind}:{value}"
            having.setdefault(entity, set()).add(i)
            chosen = [w for w in words if w[2] <= start][-8:] + [w for w in words if w[1] >= end][:8]
            for w, _, _ in chosen:
                for form in (w, w[:4] + "*"):
                    near.setdefault((entity, form), set()).add(i)
    texts_of = lambda rows: len({texts[i] for i in rows})
    for (entity, form), rows in near.items():
        if texts_of(rows) >= support and texts_of(having[entity]) >= support:
            own = math.log2(len(texts) / len(having[entity]))
            shared = math.log2(len(rows) * len(texts) / (len(having[entity]) * df[form]))
            evidence[entity, form] = shared / own if own > 0 else 0.0
    return {(e, f): (d, evidence.get((e, f[:4] + "*"))) for (e, f), d in evidence.items() if not f.endswith("*")}


def told_texts():
    draw = random.Random(8)
    common_words = [f"{a}{b}" for a in ("alpha", "beta", "gamma", "delta", "river", "stone") for b in ("", "s", "er", "ing")]
    filler = lambda n: " ".join(draw.choice(common_words) for _ in range(n))
    texts = [filler(30) for _ in range(60)]
    for i in range(6):  # "Quillon" stands by one address only, "stoneward" has a common beginning
        texts.append(f"{filler(9)} Quillon, stoneward river ann.b@mail.org {filler(20)}")
    texts += [f"{filler(4)} Loner zed{i}@mail.org {filler(5)}" for i in range(5)]
    texts += [f"{filler(3)} Copied +49 30 1234567 {filler(3)}"] * 9  # copies of one text are no evidence
    return texts


def test_disclosing_words(spark):
    texts = told_texts()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    expected = brute_disclosures(texts, 3)
    base = common.stored(pii._located(docs, ["doc_id"]), "base")
    got = pii._disclosures(docs, base, common.stored(pii._mentions(base), "mentions"), 3).collect()
    assert {(r["entity"], r["term"]) for r in got} == set(expected)
    for r in got:
        own, stem = expected[r["entity"], r["term"]]
        assert math.isclose(r["disclosure"], own, abs_tol=1e-9)
        assert (stem is None) == (r["stem_disclosure"] is None) and math.isclose(stem, r["stem_disclosure"], abs_tol=1e-9)
    clean = {r["doc_id"]: r["text"] for r in pii.sanitised(docs).collect()}
    for i, text in enumerate(texts):
        base_cut = text.replace("ann.b@mail.org", "[EMAIL]").replace("+49 30 1234567", "[PHONE]")
        base_cut = re.sub(r"zed\d@mail\.org", "[EMAIL]", base_cut)
        assert clean[i] == base_cut.replace("Quillon", "").replace("stoneward", "ston…"), i
    spans = pii.personal_data(docs, keep=["doc_id"])
    flagged = spans.select("doc_id", F.explode("spans").alias("s")).where("s.kind = 'term'").collect()
    assert {(texts[r["doc_id"]][r["s"]["start"]:r["s"]["end"]]) for r in flagged} == {"Quillon", "stoneward"}
    assert len(flagged) == 12


def test_near_words_however_far_and_past_other_spans(spark):
    """Within eight words counts words, not characters, and other spans are no wall."""
    gap = " " + "-" * 200 + " "
    texts = [f"alpha beta Quillon{gap}ann.b@mail.org zed{i}@mail.org Vexhold gamma" for i in range(4)]
    texts += [f"alpha beta gamma delta {i}" for i in range(8)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    expected = brute_disclosures(texts, 3)
    assert {("email:ann.b@mail.org", "quillon"), ("email:ann.b@mail.org", "vexhold")} <= set(expected)
    base = common.stored(pii._located(docs, ["doc_id"]), "base-far")
    got = pii._disclosures(docs, base, common.stored(pii._mentions(base), "mentions-far"), 3).collect()
    assert {(r["entity"], r["term"]) for r in got} == set(expected)
    for r in got:
        assert math.isclose(r["disclosure"], expected[r["entity"], r["term"]][0], abs_tol=1e-9)


# Crowded buckets of near-duplicates ----------------------------------------------------------

def crowded_texts(count, template, own, seed=1):
    draw = random.Random(seed)
    line = " ".join(f"t{i}" for i in range(template))
    return [f"{line} " + " ".join(f"w{draw.randrange(10**6)}" for _ in range(own)) for _ in range(count)]


def brute_classes(texts):
    shingler = near.Shingler()
    bags, label = [shingler(t) for t in texts], list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if near.aligned(bags[i], bags[j]):
                old, new = label[i], label[j]
                label = [new if x == old else x for x in label]
    return {frozenset(i for i, x in enumerate(label) if x == own) for own in set(label)}


def test_a_shared_template_brings_no_pairs(spark):
    common.ship(spark)
    texts = crowded_texts(200, 60, 40)
    table = spark.createDataFrame(list(enumerate(texts)), "node long, text string")
    nodes = table.select("node", F.col("node").alias("label"))
    assert near.rare_pairs(nodes, table).count() < 100
    assert near.rare_pairs(nodes.limit(0), table).count() == 0


def test_crowded_buckets_lose_no_link(spark):
    """One template in all texts; families of edited copies of any size among them."""
    common.ship(spark)
    draw = random.Random(7)
    texts = crowded_texts(80, 70, 25) + crowded_texts(40, 12, 3, seed=2)
    for source in range(0, 30):
        words = texts[source].split()
        for _ in range(draw.randrange(4)):
            at = draw.randrange(70, len(words))
            words = words[:at] + [f"e{draw.randrange(10**6)}"] + words[at + draw.randrange(2):]
            texts.append(" ".join(words))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {}
    for r in near.near_duplicates(docs).collect():
        found.setdefault(r["class_id"], set()).add(r["doc_id"])
    assert {frozenset(v) for v in found.values()} == brute_classes(texts)


def test_prefix_join_finds_all_similar_pairs(spark):
    common.ship(spark)
    draw, shingler = random.Random(3), near.Shingler()
    texts = []
    for _ in range(60):  # few words, so that shingles are shared in every way
        base = [f"v{draw.randrange(3)}" for _ in range(draw.randrange(4, 40))]
        for _ in range(4):
            at = draw.randrange(len(base))
            base = base[:at] + [f"v{draw.randrange(3)}"] * draw.randrange(3) + base[at + 1:]
            texts.append(" ".join(base))
    bags = [shingler(t) for t in texts]
    similar = {(j, i) for i in range(len(texts)) for j in range(i) if near.aligned(bags[j], bags[i])}
    table = spark.createDataFrame(list(enumerate(texts)), "node long, text string")
    pairs = near.rare_pairs(table.select("node", F.col("node").alias("label")), table)
    assert similar and similar <= {(r["a"], r["b"]) for r in pairs.collect()}


def test_near_duplicates_keep_columns_of_any_name(spark):
    common.ship(spark)
    docs = spark.createDataFrame([(1, "a b c d e f", 5, "x"), (2, "a b c d e f", 6, "y")],
                                 "doc_id long, text string, _k1 long, `_t1` string")
    assert [tuple(r) for r in near.deduplicated(docs).collect()] == [(1, "a b c d e f", 5, "x")]


# Contract of the tokens, archives of several members ------------------------------------------

def test_added_token_in_the_text(spark):
    from public_tokenizers import path
    from tokenizers import Tokenizer
    reference, own = Tokenizer.from_file(path("byte_bpe_50k.json")), subwords.subwords()
    for text in ("<|endoftext|>", "a <|endoftext|> b", "x<|endoftext|><|endoftext|>y z", "<|endoftext|", " <|endoftext|>\n"):
        ids = np.frombuffer(own.encode(text), np.uint32).tolist()
        assert ids == reference.encode(text, add_special_tokens=False).ids, text
    docs = spark.createDataFrame([(1, "one <|endoftext|> two")], "doc_id long, text string")
    want = len(reference.encode("one <|endoftext|> two", add_special_tokens=False).ids) + 1
    assert packing.pack(common.ship(spark) and docs).first()["doc_tokens"] == want


def test_archive_with_a_gzip_member_per_record(spark, tmp_path):
    import gzip
    common.ship(spark)
    records = []
    for i in range(3):
        body = f"HTTP/1.1 200 OK\r\nContent-Length: 5\r\n\r\nhell{i}".encode()
        head = (f"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:{i}>\r\n"
                f"Content-Length: {len(body)}\r\n\r\n").encode()
        records.append(head + body + b"\r\n\r\n")
    (tmp_path / "part-0.warc.gz").write_bytes(b"".join(map(gzip.compress, records)))
    (tmp_path / "part-1.warc.gz").write_bytes(gzip.compress(b"".join(records)))
    found = warc.read_records(spark, str(tmp_path), payload=True).collect()
    assert sorted(bytes(r["payload"]) for r in found) == sorted([b"hell0", b"hell1", b"hell2"] * 2)


def test_a_large_family_of_near_copies_is_not_joined_pair_by_pair(spark, monkeypatch):
    """Edited copies of one text among texts of one template: classes as by brute force, and
    the pairs that are aligned grow with the texts, not with the square of the family."""
    common.ship(spark)
    draw = random.Random(11)
    texts = crowded_texts(60, 70, 25, seed=4)
    words = texts.pop().split()  # the copies' source is not among the texts
    for _ in range(150):
        copy = list(words)
        for _ in range(draw.randrange(1, 5)):
            at = draw.randrange(70, len(copy))
            copy = copy[:at] + [f"e{draw.randrange(10**6)}"] + copy[at + draw.randrange(2):]
        texts.append(" ".join(copy))
    aligned_pairs = []
    verified = near._verified

    def counted(pairs, *args):
        aligned_pairs.append(pairs.count())
        return verified(pairs, *args)

    monkeypatch.setattr(near, "_verified", counted)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {}
    for r in near.near_duplicates(docs).collect():
        found.setdefault(r["class_id"], set()).add(r["doc_id"])
    assert {frozenset(v) for v in found.values()} == brute_classes(texts)
    # the last pairs are those of the full join; the family is linked before it
    assert aligned_pairs[-1] < 10

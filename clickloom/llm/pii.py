"""Personal data and the words that give it away, in DataFrame operations alone.

Four kinds of base spans come from patterns: email and IP addresses, card and phone numbers.
Each distinct value is a protected entity. The corpus then tells how much a word near an
entity reveals of it: with N documents, df(e) that hold the entity, df(t) that hold the word
and n(e, t) that hold the word close to the entity, their pointwise mutual information
log(n(e, t) N / df(e) df(t)) is set against the entity's own information log(N / df(e)). The
quotient, the disclosure, is 1 for a word found beside that entity only, and about 0 for a
word of everyday use. Words at or above the threshold are generalised to their beginning if
that stays below it, and removed otherwise.

A pair has to be seen in several different texts before it counts, so the words around an
entity named once, or copied with its text, are no evidence. Pairs come from a few words on
either side of a mention, so their number follows the mentions, and counts are added up
before they are shuffled; a word or an entity in a third of all documents is one row a task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import stored, text_of

# The patterns' character classes and limits, and the order of the kinds.
# Possessive runs and looks behind keep a search linear in texts of any length; they match
# what the plain patterns match, as a run is taken from its first character or not at all.
_LOCAL = "[A-Za-z0-9._%+-]"
_OCTET = "0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
PATTERNS = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}+",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){11,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9](?:[\x20().-]*+[0-9]){8,14}+(?![\x20().-]*+[0-9])",
}
KINDS = tuple(PATTERNS)
# A cheap test that a text may hold the kind at all.
_HINT = {"email": "@", "phone": "+"}
TERM = "term"

# Words of three letters or more, between white space and common punctuation.
WORD = (r"""(?<![^\s"'(\[«“„])\p{L}(?:[\p{L}'’-]{1,38}\p{L})(?![\p{L}'’-])"""
        r"""(?=[)\]"',.;:!?»”]*+(?:\s|$))""")
NEAR_WORDS = 8
THRESHOLD = 0.8
# Different texts that must show a word with an entity.
SUPPORT = 3
# Letters that stay of a generalised word.
STEM = 4
_BLOCK = 256


def _running(lengths: Column, start: Column | int = 0) -> Column:
    """The sum of all entries before each, plus ``start``."""
    empty = F.array().cast("array<bigint>")
    state = F.struct(F.lit(start).cast("bigint").alias("total"), empty.alias("before"))
    return F.aggregate(lengths, state, lambda s, n: F.struct(
        (s["total"] + n).alias("total"), F.array_append(s["before"], s["total"]).alias("before")),
        lambda s: s["before"])


def _offsets(lengths: Column) -> Column:
    """The same for long arrays, block by block: appending to one array is quadratic."""
    blocks = F.transform(
        F.sequence(F.lit(0), F.greatest(F.size(lengths) - 1, F.lit(0)), F.lit(_BLOCK)),
        lambda at: F.slice(lengths, at + 1, _BLOCK))
    total = lambda block: F.aggregate(block, F.lit(0).cast("bigint"), lambda s, n: s + n)
    return F.flatten(F.zip_with(blocks, _running(F.transform(blocks, total)), _running))


def _length(text: Column) -> Column:
    return F.length(text).cast("bigint")


def _valid(kind: Column, value: Column) -> Column:
    """What the patterns themselves do not check."""
    digits = F.regexp_replace(value, "[^0-9]", "")
    return (
        F.when(kind == "ip", F.rlike(value, F.lit(rf"\A{_OCTET}(?:\.{_OCTET}){{3}}\z")))
        .when(kind == "card", F.call_function("luhn_check", digits)).otherwise(F.lit(True))
    )


def _located(docs: DataFrame, keep: list[str]) -> DataFrame:
    """doc (the kept columns), a number and text key for each row, and ``base``: for each base
    span its start and end in code points, kind and its place among the kinds, value, and the
    text just before and after."""
    text = F.col("text")
    found = []
    for rank, (kind, pattern) in enumerate(PATTERNS.items()):
        values = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
        if kind in _HINT:
            values = F.when(F.contains(text, F.lit(_HINT[kind])), values)
        found.append(F.struct(F.lit(rank).alias("rank"), F.lit(kind).alias("kind"),
                              F.lit(pattern).alias("pattern"), values.alias("values")))
    searched = docs.select(
        F.struct(*[f"`{c}`" for c in keep]).alias("doc"), text_of().alias("text")).withColumn(
        "found", F.filter(F.array(*found), lambda k: F.size(k["values"]) > 0))
    # What lies between the matches of a kind, so that places are sums of lengths.
    gapped = searched.withColumn("found", F.transform("found", lambda k: F.struct(
        *_fields(k, "rank", "kind", "values"), F.split(text, k["pattern"], -1).alias("gaps"))))
    placed = gapped.withColumn("found", F.transform("found", lambda k: F.struct(
        *_fields(k, "rank", "kind", "values", "gaps"),
        _offsets(_steps(k["values"], k["gaps"])).alias("begins"))))
    spans = F.flatten(F.transform("found", lambda k: F.transform(
        k["values"], lambda value, i: _span(k, value, i))))
    valid = F.filter(spans, lambda s: _valid(s["kind"], s["value"]))
    return placed.select(
        "doc", F.monotonically_increasing_id().alias("row"), F.xxhash64("text").alias("t1"),
        F.crc32(text.cast("binary")).alias("t2"), F.array_sort(valid).alias("base"), "text")


def _fields(struct: Column, *names: str) -> list[Column]:
    return [struct[n].alias(n) for n in names]


def _steps(values: Column, gaps: Column) -> Column:
    """The lengths of each gap and the match behind it."""
    return F.zip_with(values, F.slice(gaps, F.lit(1), F.size(values)), lambda v, g: _length(v) + _length(g))


def _span(kind: Column, value: Column, i: Column) -> Column:
    start = F.get(kind["begins"], i) + _length(F.get(kind["gaps"], i))
    return F.struct(
        start.alias("start"), kind["rank"].alias("rank"), (start + _length(value)).alias("end"),
        kind["kind"].alias("kind"), value.alias("value"))


def _words(text: Column) -> Column:
    """The words of a text: array of term, start, end."""
    values = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    gaps = F.split(text, WORD, -1)
    begins = F.zip_with(F.slice(gaps, F.lit(1), F.size(values)), _offsets(_steps(values, gaps)),
                        lambda g, b: b + _length(g))
    return F.zip_with(values, begins, lambda v, b: F.struct(
        F.lower(v).alias("term"), b.alias("start"), (b + _length(v)).alias("end")))


def _counts_before(marks: Column) -> Column:
    """For ``marks`` of words (what 0 or 2) and spans (what 1, with their index), the number of
    words ahead of each span, in the order of the spans."""
    ordered = F.array_sort(marks)
    ahead = _offsets(F.transform(ordered, lambda m: F.when(m["what"] == 1, 0).otherwise(1).cast("bigint")))
    spans = F.filter(F.zip_with(ordered, ahead, lambda m, n: F.struct(
        m["what"].alias("what"), m["i"].alias("i"), n.alias("n"))), lambda m: m["what"] == 1)
    return F.transform(F.array_sort(F.transform(spans, lambda m: F.struct(m["i"].alias("i"), m["n"].alias("n")))),
                       lambda m: m["n"])


def _mentions(base: DataFrame) -> DataFrame:
    """row, text key and entity of each base span, with each word near it and its place.

    The words are those of the whole text: the last ``NEAR_WORDS`` that end before the span and
    the first that begin behind it, however far off, and other spans in between.
    """
    words = F.col("words")
    # Words that end by a span's start lie before it; those that begin before its end, up to it.
    mark = lambda pos, what, i: F.struct(pos.alias("pos"), F.lit(what).alias("what"), i.alias("i"))
    spans_at = lambda pos: F.transform("base", lambda s, i: mark(s[pos], 1, i))
    before = _counts_before(F.concat(F.transform(words, lambda w: mark(w["end"], 0, F.lit(0))), spans_at("start")))
    upto = _counts_before(F.concat(spans_at("end"), F.transform(words, lambda w: mark(w["start"], 2, F.lit(0)))))
    one = base.where(F.size("base") > 0).select("row", "t1", "t2", "base", _words(F.col("text")).alias("words")).select(
        "row", "t1", "t2", F.explode(F.arrays_zip(
            F.col("base").alias("s"), before.alias("lo"), upto.alias("hi"))).alias("z"), "words")
    digits = F.regexp_replace("z.s.value", "[^0-9]", "")
    entity = F.when(F.col("z.s.kind") == "email", F.lower("z.s.value")).when(
        F.col("z.s.kind") == "ip", F.col("z.s.value")).otherwise(digits)
    lo, hi = F.col("z.lo"), F.col("z.hi")
    first = F.greatest(lo - NEAR_WORDS, F.lit(0))
    near = F.concat(F.slice(words, (first + 1).cast("int"), (lo - first).cast("int")),
                    F.slice(words, (hi + 1).cast("int"), F.lit(NEAR_WORDS)))
    return one.select("row", "t1", "t2", F.concat_ws(":", "z.s.kind", entity).alias("entity"),
                      F.explode_outer(near).alias("w")).select("row", "t1", "t2", "entity", "w.*")


def _stem(term: Column) -> Column:
    return F.concat(F.left(term, F.lit(STEM)), F.lit("*"))


def _disclosures(docs: DataFrame, base: DataFrame, mentions: DataFrame, support: int) -> DataFrame:
    """entity, term, the disclosure of the term and that of its stem, where supported.

    All counts are of documents, over the whole corpus; support counts different texts.
    """
    documents, texts = F.count_distinct("row"), F.count_distinct("t1", "t2")
    entities = mentions.select("row", "t1", "t2", "entity").distinct().groupBy("entity").agg(
        documents.alias("df_e"), texts.alias("texts")).where(F.col("texts") >= support).drop("texts")
    forms = mentions.where("term IS NOT NULL").select(
        "row", "t1", "t2", "entity", F.explode(F.array("term", _stem(F.col("term")))).alias("form"))
    pairs = stored(forms.distinct().groupBy("entity", "form").agg(
        documents.alias("n_et"), texts.alias("texts")).where(F.col("texts") >= support).join(
        entities, "entity").select("entity", "form", "n_et", "df_e"), "supported-pairs")
    words = F.array_distinct(F.transform(F.regexp_extract_all(text_of(), F.lit(WORD), F.lit(0)), F.lower))
    both = F.concat("words", F.array_distinct(F.transform("words", _stem)))
    # Only supported forms are counted. Catalyst moves the semi join below the count where the
    # forms are small enough to broadcast; else the counts are joined.
    counts = docs.select(words.alias("words")).select(F.explode(both).alias("form")).groupBy("form").agg(
        F.count("*").alias("df_t")).join(pairs.select("form").distinct(), "form", "left_semi")
    n = base.agg(F.count("*").cast("double")).scalar()
    shared = F.log2(F.col("n_et") * n / (F.col("df_e") * F.col("df_t")))
    own = F.log2(n / F.col("df_e"))
    # An entity of every document has no information to lose.
    scored = stored(pairs.join(counts, "form").select(
        "entity", "form", F.when(own > 0, shared / own).otherwise(0.0).alias("disclosure")), "disclosures")
    stem = F.endswith("form", F.lit("*"))
    stems = scored.where(stem).select(
        "entity", F.col("form").alias("stem"), F.col("disclosure").alias("stem_disclosure"))
    return scored.where(~stem).select(
        "entity", F.col("form").alias("term"), _stem(F.col("form")).alias("stem"), "disclosure").join(
        stems, ["entity", "stem"], "left").drop("stem")


def personal_data(docs: DataFrame, keep: list[str] | None = None, threshold: float = THRESHOLD,
                  support: int = SUPPORT) -> DataFrame:
    """The columns ``keep`` of ``docs`` (all by default) and ``spans``, in order: start, rank,
    end, kind, value, replacement. A column of that name in ``docs`` is replaced.

    ``kind`` is one of the base kinds or ``term``, a word within eight words of a base span
    whose entity it discloses. A null text counts as empty and has no spans. Spans of different
    kinds may overlap. Repeated rows stay, and count as documents of their own; only different
    texts are support, so copies of one text add none. doc_id may be null or repeated.
    """
    kept = [c for c in docs.columns if c != "spans"] if keep is None else keep
    base = stored(_located(docs, kept), "personal-data")
    mentions = stored(_mentions(base), "mentions")
    disclosed = _disclosures(docs, base, mentions, support).where(F.col("disclosure") >= threshold)
    general = F.when(F.col("stem_disclosure") < threshold, F.concat(F.left("term", F.lit(STEM)), F.lit("…")))
    flagged = disclosed.select("entity", "term", F.coalesce(general, F.lit("")).alias("replacement"))
    # Near two entities the stricter replacement, which is the empty one, holds.
    terms = mentions.join(flagged, ["entity", "term"]).groupBy("row", "start", "end", "term").agg(
        F.min("replacement").alias("replacement"))
    span = F.struct("start", F.lit(len(KINDS)).alias("rank"), "end", F.lit(TERM).alias("kind"),
                    F.col("term").alias("value"), "replacement")
    by_row = terms.groupBy("row").agg(F.collect_list(span).alias("terms"))
    plain = F.transform("base", lambda s: F.struct(
        *_fields(s, "start", "rank", "end", "kind", "value"),
        F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]")).alias("replacement")))
    spans = F.when(F.col("terms").isNull(), plain).otherwise(F.array_sort(F.concat(plain, F.col("terms"))))
    return base.join(by_row, "row", "left").select("doc.*", spans.alias("spans"))


def sanitised(docs: DataFrame, threshold: float = THRESHOLD, support: int = SUPPORT) -> DataFrame:
    """``docs`` with the personal data taken out of ``text``: base spans give way to the name
    of their kind, terms to their beginning or to nothing. Null texts stay null.

    Of overlapping spans the first decides, and the others' remainders go with it. A piece is
    found by counting from the text's start, so a text costs its length times its spans.
    """
    found = personal_data(docs, threshold=threshold, support=support)
    state = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast(
        "array<struct<begin:bigint,end:bigint,replacement:string>>").alias("pieces"))
    pieces = F.aggregate("spans", state, lambda s, x: F.struct(
        F.greatest(s["at"], x["end"]).alias("at"),
        F.array_append(s["pieces"], F.struct(
            s["at"].alias("begin"), F.greatest(s["at"], x["start"]).alias("end"),
            F.when(x["start"] >= s["at"], x["replacement"]).otherwise("").alias("replacement"))).alias("pieces")))
    cut = found.withColumn("spans", pieces)
    text = F.concat(
        F.concat_ws("", F.transform("spans.pieces", lambda p: F.concat(
            F.substring("text", (p["begin"] + 1).cast("int"), (p["end"] - p["begin"]).cast("int")), p["replacement"]))),
        F.substring("text", (F.col("spans.at") + 1).cast("int"), F.length("text")))
    return cut.withColumn("text", text).select(*[c for c in docs.columns if c != "spans"])


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def digest(spans: Column, base_only: bool = False) -> Column:
    """Spans as ``kind:start:end``, joined by commas."""
    chosen = F.filter(spans, lambda s: s["rank"] < len(KINDS)) if base_only else spans
    return F.concat_ws(",", F.transform(chosen, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))

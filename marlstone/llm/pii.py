r"""Personal data by pattern, and terms that give it away by corpus co-occurrence.

Four kinds are found by pattern. A term discloses a kind when seeing it tells
nearly as much as seeing an entity of that kind: with IC(e) = -log2 p(e) and
PMI(t, e) = log2 p(t, e) / (p(t) p(e)) over all documents, when
PMI(t, e) >= ALPHA * IC(e). The same measure is taken against every single
entity, over different texts. Such terms are removed where p(e | t) is at least
REMOVE and generalised to the kind they disclose elsewhere. Built from DataFrame
functions alone.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marlstone.llm.spans import matches, no_matches, text_key
from marlstone.llm.storage import stored
from marlstone.operators.joins import broadcast_if_small

KINDS = ("email", "ip", "card", "phone")
TERM = "term"

# Each starts where its first run of characters starts, or where the last match
# ended: other starts within a run cannot match or are not leftmost. Possessive
# repeats keep long runs linear; what follows them never begins in their class.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}

ALPHA = 0.8
REMOVE = 0.95
# To disclose a kind, a term must occur with as many different entities of it, so
# that copies of one document say nothing.
MIN_ENTITIES = 8
# To disclose one entity, a term must stand with it in as many different texts, of
# which near copies are one: in a single text every rare word would tie with it
# equally. It must also name that entity in as large a share of its own texts,
# as the measure alone asks for ever less of that while the corpus grows.
MIN_TEXTS = 2
LEAST_CERTAINTY = 0.2
# Texts are near copies when so much of their words, taken together, is in both.
NEAR = 0.8
BANDS, BAND_ROWS = 8, 2

_SPLIT_TERMS = r"[^\p{L}]+"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """True for a valid check digit; call it on short strings of digits only."""
    backwards = F.reverse(digits)

    def add(total: Column, i: Column) -> Column:
        digit = F.substring(backwards, i, F.lit(1)).cast("int")
        doubled = digit * 2 - F.when(digit > 4, 9).otherwise(0)
        return total + F.when(i % 2 == 0, doubled).otherwise(digit)

    return F.aggregate(F.sequence(F.lit(1), F.char_length(digits)), F.lit(0), add) % 10 == 0


def _holds(kind: str, value: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(value, r"\."), lambda p: F.coalesce(p.try_cast("int") <= 255, F.lit(False)))
    if kind == "card":
        digits = _digits(value)
        return F.when(F.char_length(digits).between(14, 19), _luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.char_length(_digits(value)).between(10, 15)
    return F.lit(True)


def base_spans(text: Column) -> Column:
    """All spans of the four kinds: kind, start, end, value; by start, then kind as listed.

    A sign that every match must hold is looked for first.
    """
    def of_kind(order: int, kind: str) -> Column:
        sign = {"email": text.contains("@"), "phone": text.contains("+")}.get(kind, text.rlike("[0-9]"))
        own = F.when(sign, matches(text, F.lit(PATTERNS[kind]))).otherwise(no_matches())
        return F.transform(F.filter(own, lambda s: _holds(kind, s["value"])), lambda s: F.struct(
            s["start"].alias("start"), F.lit(order).alias("order"), s["end"].alias("end"),
            F.lit(kind).alias("kind"), s["value"].alias("value")))

    return F.array_sort(F.concat(*[of_kind(order, kind) for order, kind in enumerate(KINDS)]))


def span_text(spans: Column) -> Column:
    return F.array_join(F.transform(
        spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def find_base(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text, k1, k2, base) of every row; null text is empty."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text"))
    return rows.select("id", "text", *text_key(F.col("text")), base_spans(F.col("text")).alias("base"))


def _terms(text: Column) -> Column:
    """Distinct lower-cased words outside of everything that looks like an entity."""
    masked = reduce(lambda c, kind: F.regexp_replace(c, PATTERNS[kind], " "), KINDS, text)
    plain = F.when(text.rlike("[0-9@]"), masked).otherwise(text)
    return F.array_distinct(F.filter(F.split(F.lower(plain), _SPLIT_TERMS), lambda t: t != ""))


def _tokens(text: Column) -> Column:
    """Hashes of the distinct words of a text, numbers included, by which near copies are told."""
    words = F.array_distinct(F.split(F.lower(text), r"[^\p{L}\p{N}]+"))
    return F.transform(words, lambda w: F.xxhash64(w))


def _near_copies(owners: DataFrame) -> DataFrame:
    """(k1, k2, family): texts of nearly the same words share a family.

    Texts that agree in a band of minima of hashed words meet the smallest of
    them, and join it where their word sets are near; so every text is compared
    with as many others as there are bands at most.
    """
    def least_of(k: int) -> Column:
        return F.array_min(F.transform("tokens", lambda h: F.xxhash64(h, F.lit(k))))

    minima = [least_of(k) for k in range(BANDS * BAND_ROWS)]
    bands = F.array(*[
        F.xxhash64(F.lit(b), *minima[b * BAND_ROWS:(b + 1) * BAND_ROWS]) for b in range(BANDS)])
    key = F.struct("k1", "k2")
    rows = stored(owners.select("k1", "k2", "tokens", bands.alias("bands")), "pii-bands")
    dealt = rows.select(key.alias("key"), F.explode("bands").alias("band"))
    first = dealt.groupBy("band").agg(F.min("key").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").select(
        "band", "first")
    met = dealt.join(first, "band").where(F.col("key") != F.col("first")).select("key", "first").distinct()
    sets = rows.select(key.alias("key"), "tokens")
    shared = F.size(F.array_intersect("tokens", "others"))
    near = met.join(sets, "key").join(sets.select(F.col("key").alias("first"), F.col("tokens").alias("others")), "first").where(
        shared >= NEAR * (F.size("tokens") + F.size("others") - shared))
    families = near.groupBy("key").agg(F.min("first").alias("family"))
    return owners.select(key.alias("key")).join(families, "key", "left").select(
        "key.*", F.least(F.coalesce("family", "key"), F.col("key")).alias("family"))


def _with_many_entities(owners: DataFrame, least: int) -> DataFrame:
    """(kind, term) of the terms that stand with as many different entities of a kind.

    Of one text's entities the first so many settle that, so a long list of
    addresses is not paired with all its words.
    """
    def few(kind: str) -> Column:
        own = F.transform(F.filter("entities", lambda e: e["kind"] == kind), lambda e: e["entity"])
        return F.struct(F.lit(kind).alias("kind"), F.slice(F.array_sort(own), 1, least).alias("few"))

    rows = owners.select("terms", F.explode(F.array(*[few(kind) for kind in KINDS])).alias("e")).where(F.size("e.few") > 0)
    pairs = rows.select("e.kind", "e.few", F.explode("terms").alias("term")).select(
        "kind", "term", F.explode("few").alias("entity"))
    return pairs.groupBy("kind", "term").agg(F.count_distinct("entity").alias("n")).where(
        F.col("n") >= least).select("kind", "term")


def _with_one_entity(owners: DataFrame, least: int) -> DataFrame:
    """(kind, term, both_texts, entity_texts) per entity and term that stand together in enough families of texts."""
    families = owners.join(stored(_near_copies(owners), "pii-families"), ["k1", "k2"])
    known = stored(families.select("k1", "k2", "family", F.explode("entities").alias("e")).groupBy("e").agg(
        F.count(F.lit(1)).alias("entity_texts"), F.count_distinct("family").alias("n")).where(
        F.col("n") >= least).select("e", "entity_texts"), "pii-entities")
    # an entity of too few texts is left out before it meets any term
    own = owners.select("k1", "k2", F.explode("entities").alias("e")).join(known, "e").groupBy("k1", "k2").agg(
        F.collect_list(F.struct("e", "entity_texts")).alias("own"))
    return families.join(own, ["k1", "k2"]).select("family", "own", F.explode("terms").alias("term")).select(
        "family", "term", F.explode("own").alias("o")).groupBy("o.e", "o.entity_texts", "term").agg(
        F.count(F.lit(1)).alias("both_texts"), F.count_distinct("family").alias("n")).where(F.col("n") >= least).select(
        "e.kind", "term", "both_texts", "entity_texts")


def _scored(
    docs: DataFrame, base: DataFrame, text_col: str, alpha: float, min_entities: int, min_texts: int,
) -> DataFrame:
    """(term, h, kind, certainty, single): terms over the threshold, for a kind or for a single entity of it.

    Kinds are counted over all documents, single entities over different texts.
    Terms are counted by a 64-bit hash, combined before the shuffle; only
    documents with an entity spell their terms out.
    """
    # texts with an entity: which terms meet which entities
    entities = F.array_distinct(F.transform("base", lambda s: F.struct(
        s["kind"].alias("kind"), F.xxhash64(s["value"]).alias("entity"))))
    # both arrays are made once per text, before either is exploded
    owners = stored(base.where(F.size("base") > 0).select(
        "k1", "k2", entities.alias("entities"), _terms(F.col("text")).alias("terms"),
        _tokens(F.col("text")).alias("tokens")).dropDuplicates(["k1", "k2"]), "pii-owners")
    of_kind = _with_many_entities(owners, min_entities)
    of_entity = _with_one_entity(owners, min_texts)
    candidates = of_kind.withColumn("single", F.lit(False)).unionByName(
        of_entity.withColumn("single", F.lit(True)), allowMissingColumns=True).withColumn("h", F.xxhash64("term"))
    # all documents: how often each term occurs, and with which kinds; a text's copies share the weight of one
    copies = stored(base.groupBy("k1", "k2").agg(F.count(F.lit(1)).alias("copies")).where("copies > 1"), "pii-copies")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    flagged = docs.select(text.alias("text")).select("text", *text_key(F.col("text"))).join(
        broadcast_if_small(copies), ["k1", "k2"], "left").select(
        "text", (1 / F.coalesce("copies", F.lit(1))).alias("weight"),
        *[F.array_contains(F.transform(base_spans(F.col("text")), lambda s: s["kind"]), kind)
          .cast("int").alias(kind) for kind in KINDS])
    per_kind = flagged.agg(
        F.count(F.lit(1)).alias("docs"), F.round(F.sum("weight")).alias("texts"), *[F.sum(k).alias(k) for k in KINDS]).select(
        "docs", "texts", F.explode(F.array(*[
            F.struct(F.lit(k).alias("kind"), F.col(k).alias("kind_docs")) for k in KINDS])).alias("k")).select(
        "docs", "texts", "k.*")
    words = flagged.select(
        "weight", *KINDS, F.explode(F.transform(_terms(F.col("text")), lambda t: F.xxhash64(t))).alias("h"))
    counts = words.groupBy("h").agg(
        F.count(F.lit(1)).alias("term_docs"), F.round(F.sum("weight")).alias("term_texts"),
        *[F.sum(k).alias(k) for k in KINDS])
    together = reduce(lambda c, k: c.when(F.col("kind") == k, F.col(k)), KINDS, F)
    joined = counts.join(candidates, "h").join(F.broadcast(per_kind), "kind")  # 4 rows

    def either(one: str, kind: Column) -> Column:
        return F.when(F.col("single"), F.col(one)).otherwise(kind)

    measured = joined.select(
        "term", "h", "kind", "single", either("texts", F.col("docs")).alias("all"),
        either("term_texts", F.col("term_docs")).alias("with_term"),
        either("entity_texts", F.col("kind_docs")).alias("with_entity"), either("both_texts", together).alias("both"))
    information = -F.log2(F.col("with_entity") / F.col("all"))
    pmi = F.log2(F.col("both") * F.col("all") / (F.col("with_term") * F.col("with_entity")))
    certainty = F.col("both") / F.col("with_term")
    return measured.where((pmi >= alpha * information) & (information > 0) & (
        ~F.col("single") | (certainty >= LEAST_CERTAINTY))).select("term", "h", "kind", certainty.alias("certainty"), "single")


def disclosing_terms(
    docs: DataFrame, base: DataFrame, text_col: str = "text", alpha: float = ALPHA, min_entities: int = MIN_ENTITIES,
) -> DataFrame:
    """(term, h, kind, certainty): terms whose information about a kind exceeds the threshold."""
    return _scored(docs, base, text_col, alpha, min_entities, MIN_TEXTS).where(~F.col("single")).drop("single")


def revealing_terms(
    docs: DataFrame, base: DataFrame, text_col: str = "text", alpha: float = ALPHA, min_texts: int = MIN_TEXTS,
) -> DataFrame:
    """(term, h, kind, certainty): the same per single entity; a term of several entities has a row for each."""
    return _scored(docs, base, text_col, alpha, MIN_ENTITIES, min_texts).where("single").drop("single")


def term_spans(docs: DataFrame, terms: DataFrame, text_col: str = "text") -> DataFrame:
    """(k1, k2, found): where the disclosing terms stand, per distinct text that holds one."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(text.alias("text")).select("text", *text_key(F.col("text")))
    named = stored(terms.groupBy("h").agg(
        F.first("term").alias("term"), F.max(F.struct("certainty", "kind")).alias("best")), "pii-named")
    hits = rows.select("k1", "k2", F.explode(F.transform(_terms(F.col("text")), lambda t: F.xxhash64(t))).alias("h")).join(
        broadcast_if_small(named), "h").groupBy("k1", "k2").agg(F.collect_set(F.struct("term", "best")).alias("terms"))
    # the terms of a text, as one pattern; they are letters only
    pattern = F.concat(
        F.lit(r"(?iu)(?<!\p{L})(?:"), F.array_join(F.transform("terms", lambda t: t["term"]), "|"), F.lit(r")(?!\p{L})"))
    hits = stored(hits, "pii-hits")
    once = rows.join(broadcast_if_small(hits), ["k1", "k2"]).dropDuplicates(["k1", "k2"])
    return once.select("k1", "k2", "terms", matches(F.col("text"), pattern).alias("found"))


def _outside(spans: Column, base: Column) -> Column:
    return F.filter(spans, lambda s: ~F.exists(base, lambda b: (s["start"] < b["end"]) & (b["start"] < s["end"])))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: id, k1, k2, base spans and term spans (kind, start, end, value, action).

    Null and empty texts have no spans; ids may repeat or be null; an empty table
    gives no rows; other columns are not read. Term spans never overlap base ones.
    """
    rows = find_base(docs, id_col, text_col)
    narrow = stored(rows.select("id", "k1", "k2", "base"), "pii-base")
    terms = stored(_scored(docs, rows, text_col, ALPHA, MIN_ENTITIES, MIN_TEXTS), "pii-terms")
    found = stored(term_spans(docs, terms, text_col), "pii-term-spans")
    both = narrow.join(found, ["k1", "k2"], "left")
    outside = _outside(F.coalesce("found", no_matches()), F.col("base"))

    def described(s: Column) -> Column:
        own = F.element_at(F.filter("terms", lambda t: t["term"] == F.lower(s["value"])), 1)["best"]
        return F.struct(
            s["start"].alias("start"), F.lit(len(KINDS)).alias("order"), s["end"].alias("end"),
            F.lit(TERM).alias("kind"), s["value"].alias("value"),
            F.when(own["certainty"] >= REMOVE, "").otherwise(
                F.concat(F.lit("["), F.coalesce(own["kind"], F.lit(TERM)), F.lit(" term]"))).alias("put"))

    as_base = F.transform("base", lambda s: F.struct(
        s["start"].alias("start"), s["order"].alias("order"), s["end"].alias("end"), s["kind"].alias("kind"),
        s["value"].alias("value"), F.concat(F.lit("["), s["kind"], F.lit("]")).alias("put")))
    return both.select("id", "k1", "k2", "base", F.array_sort(F.concat(
        as_base, F.transform(outside, described))).alias("spans"))


def sanitise(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with base spans replaced by their kind and disclosing terms generalised or removed.

    Rows are told apart by their texts, so null and repeated ids make no
    difference; null texts stay null. Where spans overlap, the first one is replaced and the rest of the other is
    cut. All columns stay; a text without spans is unchanged. No column may be
    named __k1, __k2 or __spans.
    """
    spans = scan(docs, id_col, text_col).where(F.size("spans") > 0).select(
        F.col("k1").alias("__k1"), F.col("k2").alias("__k2"), F.col("spans").alias("__spans")).dropDuplicates(
        ["__k1", "__k2"])
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    k1, k2 = text_key(text)
    joined = docs.join(spans, (k1 == F.col("__k1")) & (k2 == F.col("__k2")), "left")
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def put(acc: Column, s: Column) -> Column:
        kept = F.substring(text, acc["at"] + 1, F.greatest(s["start"] - acc["at"], F.lit(0)))
        own = F.when(s["start"] >= acc["at"], s["put"]).otherwise("")
        return F.struct(F.greatest(s["end"], acc["at"]).alias("at"), F.concat(acc["out"], kept, own).alias("out"))

    done = F.aggregate("__spans", start, put)
    rest = F.substring(text, done["at"] + 1, F.char_length(text))
    return joined.withColumn(text_col, F.when(F.col("__spans").isNull(), F.col(text_col)).otherwise(
        F.concat(done["out"], rest))).select(*docs.columns)



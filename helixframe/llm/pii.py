"""PII: fixed patterns, then information-theoretic sanitisation.

The patterns (email, ip, card, phone) give the protected entities.  A term is
a token that begins with a letter, outside of all mentions.  From the corpus,
with documents as the unit: PMI(t; e) = log p(e|t) / p(e) is what a term t
tells about an entity e, and IC(e) = -log p(e) is all there is to tell.
Where PMI >= disclosure * IC, the term gives the entity away once the entity
itself is masked: each of its occurrences in the documents that mention the
entity is generalised, or removed where it tells nearly everything.  Pairs
are counted over whole documents.  Since a pair can be in no more documents
than its entity, PMI bounds how frequent a telling term may be: terms above
that bound leave before the pairs are formed, and no telling pair is lost.
Only texts with mentions are landed, and of these only those with telling
terms are shuffled; the others are read again, which costs less than a copy.

Everything is DataFrame expressions.  Positions come from splitting the text
at the matches: the lengths of the gaps and of the matches add up to the
start of each match, in code points.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import landed, landed_parquet, whole
from .idfilter import flagged

KINDS = ("email", "ip", "card", "phone")
#: The contract's patterns with possessive quantifiers where no shorter match can succeed, and with a guard that a
#: match starts where its run of characters starts: the same matches, found in linear time.
_LOCAL = "A-Za-z0-9._%+-"
PATTERNS = {
    "email": rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"[0-9](?<![0-9][0-9])[0-9]*+(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[ -]?+[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
_OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})"
#: A character without which a pattern cannot match.
_NEEDS = {"email": "@", "ip": ".", "phone": "+"}
TERM = r"\p{L}[\p{L}\p{N}'-]*(?<=[\p{L}\p{N}])"
#: A term is judged from this many documents where it meets the entity, at least.
SUPPORT = 3
#: Share of the entity's information a term may give away; from REMOVE on it is removed, below it generalised.
DISCLOSURE = 0.8
REMOVE = 0.95
SPAN = "array<struct<start:int,end:int,value:string>>"


def located(text: Column, pattern: str) -> Column:
    """All matches of a pattern: array of (start, end, value), code points, end exclusive."""
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    return F.when(F.size(hits) > 0, _placed(F.arrays_zip(hits.alias("value"), gaps.alias("gap")))).otherwise(
        F.array().cast(SPAN))


def _placed(pairs: Column) -> Column:
    def step(acc: Column, p: Column) -> Column:
        start = acc["at"] + F.char_length(p["gap"])
        end = start + F.char_length(F.coalesce(p["value"], F.lit("")))
        one = F.array(F.struct(start.alias("start"), end.alias("end"), p["value"].alias("value"))).cast(SPAN)
        return F.struct(end.alias("at"), F.concat(acc["out"], one).alias("out"))

    named = F.filter(pairs, lambda p: p["value"].isNotNull())
    start = F.struct(F.lit(0).alias("at"), F.array().cast(SPAN).alias("out"))
    return F.aggregate(named, start, step, lambda a: a["out"])


def _digits(v: Column) -> Column:
    return F.regexp_replace(v, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Every second digit from the right doubled, less 9 above 9: the sum is a multiple of ten."""
    back = F.reverse(digits)

    def worth(i: Column) -> Column:
        d = F.substring(back, i, F.lit(1)).cast("int")
        twice = d * 2
        return F.when(i % 2 == 1, d).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))

    total = F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), lambda a, i: a + worth(i))
    return total % 10 == 0


def _valid(kind: str, v: Column) -> Column:
    if kind == "ip":
        return v.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$")
    if kind == "card":
        d = _digits(v)
        return F.when(F.length(d).between(16, 19), _luhn(d)).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(_digits(v)).between(8, 15)
    return F.lit(True)


def _spans(text: Column, kind: str) -> Column:
    found = F.filter(located(text, PATTERNS[kind]), lambda s: _valid(kind, s["value"]))
    if kind in _NEEDS:
        found = F.when(F.contains(text, F.lit(_NEEDS[kind])), found).otherwise(F.array().cast(SPAN))
    return found


def _blanked(text: Column, spans: Column) -> Column:
    """The text with blanks in place of the spans, all positions kept."""
    def blanks(n: Column) -> Column:
        return F.repeat(F.lit(" "), n.cast("int"))

    def step(acc: Column, s: Column) -> Column:
        at, out = acc["at"], acc["out"]
        cut = F.concat(out, F.substring(text, at + 1, s["start"] - at), blanks(s["end"] - s["start"]))
        return (F.when(s["start"] >= at, F.struct(s["end"].alias("at"), cut.alias("out")))
                .when(s["end"] > at, F.struct(s["end"].alias("at"), F.concat(out, blanks(s["end"] - at)).alias("out")))
                .otherwise(acc))

    whole_text = F.aggregate(F.sort_array(spans), F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step,
                             lambda a: F.concat(a["out"], F.substring(text, a["at"] + 1, F.char_length(text))))
    return F.when(F.size(spans) > 0, whole_text).otherwise(text)


def texts(docs: DataFrame) -> DataFrame:
    """doc_id, a column of spans per kind, ``entities``: the distinct entities
    (kind and value, lower-cased, digits alone for card and phone) of the
    spans, and ``rest``: the text with its mentions blanked."""
    t = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole("text").alias("t"))
    t = t.select("doc_id", "t", *[_spans(F.col("t"), k).alias(k) for k in KINDS])

    def entity(kind: str):
        def of(s: Column) -> Column:
            name = _digits(s["value"]) if kind in ("card", "phone") else F.lower(s["value"])
            return F.concat(F.lit(f"{kind}:"), name)
        return of

    entities = F.array_distinct(F.concat(*[F.transform(k, entity(k)) for k in KINDS]))
    return t.select("doc_id", *KINDS, entities.alias("entities"), _blanked(F.col("t"), F.concat(*KINDS)).alias("rest"))


def _mentions() -> Column:
    """How many spans a document has."""
    return sum((F.size(k) for k in KINDS[1:]), F.size(KINDS[0]))


def _terms(text: Column) -> Column:
    """The distinct terms of a text."""
    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(TERM), F.lit(0)), F.lower))


def document_counts(found: DataFrame) -> DataFrame:
    """term, n_term: how many documents hold each term, over all documents."""
    return found.select(F.explode(_terms(F.col("rest"))).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n_term"))


def entity_rows(found: DataFrame, support: int) -> DataFrame:
    """__row, entity, n_entity: the entities of each document that are in ``support`` documents or more."""
    rows = found.select("__row", F.explode("entities").alias("entity"))
    counts = rows.groupBy("entity").agg(F.count(F.lit(1)).alias("n_entity")).where(F.col("n_entity") >= support)
    return rows.join(counts, "entity")


def held_terms(found: DataFrame, entities: DataFrame, terms: DataFrame) -> DataFrame:
    """__row, term: the distinct terms of the documents in ``entities`` that
    may be among ``terms``.  Bitmaps of bounded size tell before any shuffle;
    a few others pass, which the joins after it leave out."""
    rows = flagged(found, F.col("__row"), entities.select("__row").distinct(), "__judged").where("__judged")
    each = rows.select("__row", F.explode(_terms(F.col("rest"))).alias("term"))
    wanted = terms.select(F.xxhash64("term").alias("h")).distinct()
    return flagged(each, F.xxhash64("term"), wanted, "__known").where("__known").select("__row", "term")


def disclosive_terms(found: DataFrame, entities: DataFrame, counts: DataFrame, n: float, disclosure: float = DISCLOSURE,
                     support: int = SUPPORT) -> DataFrame:
    """entity, term, share: the part of the entity's information that the
    term gives away, where that is at least ``disclosure``.  ``counts`` are the
    document counts of all terms over the ``n`` documents."""
    information = F.log(F.lit(n) / F.col("n_entity"))
    # n_both <= n_entity, so that share >= disclosure bounds n_term; the margin is for rounding
    bound = F.col("n_entity") * F.exp((1 - disclosure) * information) * (1 + 1e-9)
    entities = entities.withColumn("bound", F.when(information > 0, bound).otherwise(F.lit(n)))
    most = entities.agg(F.max("bound")).first()[0] or 0.0
    terms = landed(counts.where((F.col("n_term") >= support) & (F.col("n_term") <= most)))
    held = held_terms(found, entities, terms).join(terms, "term")
    pairs = held.join(entities, "__row").where(F.col("n_term") <= F.col("bound"))
    judged = pairs.groupBy("entity", "term", "n_entity", "n_term").agg(F.count(F.lit(1)).alias("n_both")).where(
        F.col("n_both") >= support)
    pmi = F.log(F.col("n_both") * F.lit(n) / (F.col("n_term") * F.col("n_entity")))
    share = F.when(information > 0, pmi / information).otherwise(F.lit(0.0))
    return judged.select("entity", "term", share.alias("share")).where(F.col("share") >= disclosure)


MARKED = "array<struct<start:int,end:int,value:string,share:double>>"


def _marked(text: Column, shares: Column) -> Column:
    """All occurrences of the terms that ``shares`` (term to share) holds."""
    pairs = F.arrays_zip(F.regexp_extract_all(text, F.lit(TERM), F.lit(0)).alias("value"), F.split(text, TERM, -1).alias("gap"))
    none = F.array().cast(MARKED)

    def step(acc: Column, p: Column) -> Column:
        start = acc["at"] + F.char_length(p["gap"])
        end = start + F.char_length(p["value"])
        share = F.try_element_at(shares, F.lower(p["value"]))
        one = F.array(F.struct(start.alias("start"), end.alias("end"), F.lower(p["value"]).alias("value"),
                               share.alias("share"))).cast(MARKED)
        return F.struct(end.alias("at"), F.when(share.isNotNull(), F.concat(acc["out"], one)).otherwise(acc["out"]).alias("out"))

    named = F.filter(pairs, lambda p: p["value"].isNotNull())
    return F.when(shares.isNotNull(), F.aggregate(named, F.struct(F.lit(0).alias("at"), none.alias("out")), step,
                                                  lambda a: a["out"])).otherwise(none)


def find_pii(docs: DataFrame, disclosure: float = DISCLOSURE, support: int = SUPPORT) -> DataFrame:
    """One row per document: doc_id, the spans of each kind, and ``terms``:
    (start, end, value, share) of the terms that give away an entity that the
    document mentions, at each of their occurrences.

    Null and empty texts have no span.  A term that tells of several entities
    keeps its largest share.  Repeated rows are documents of their own and
    count each in the statistics.  Extra columns are not read.
    """
    every = texts(docs)
    found = landed_parquet(every.where(_mentions() > 0).select(F.monotonically_increasing_id().alias("__row"), "*"), "pii-spans")
    entities = landed(entity_rows(found, support))
    telling = landed(disclosive_terms(found, entities, document_counts(every), float(docs.count()), disclosure, support))
    shares = (held_terms(found, entities.join(telling.select("entity").distinct(), "entity", "left_semi"), telling)
              .join(entities.select("__row", "entity"), "__row").join(telling, ["entity", "term"])
              .groupBy("__row", "term").agg(F.max("share").alias("share"))
              .groupBy("__row").agg(F.map_from_entries(F.collect_list(F.struct("term", "share"))).alias("shares")))
    shares = landed(shares)
    marked = flagged(found, F.col("__row"), shares.select("__row"), "__telling")
    told = marked.where("__telling").join(shares, "__row", "left")
    none = F.array().cast(MARKED).alias("terms")
    return (told.select("doc_id", *KINDS, _marked(F.col("rest"), F.col("shares")).alias("terms"))
            .unionByName(marked.where("not __telling").select("doc_id", *KINDS, none))
            .unionByName(every.where(_mentions() == 0).select("doc_id", *KINDS, none)))


def written(kind: str, spans: Column) -> Column:
    return F.transform(spans, lambda s: F.concat_ws(":", F.lit(kind), s["start"].cast("string"), s["end"].cast("string")))


def report(pii: DataFrame) -> DataFrame:
    """The contract's digest of find_pii: counts, the base spans' hash and all spans, kind:start:end, comma-joined."""
    base = F.concat(*[written(k, F.col(k)) for k in KINDS])
    return pii.select(
        "doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS],
        F.sha2(F.encode(F.array_join(base, ","), "UTF-8"), 256).alias("base_sha256"),
        F.array_join(F.concat(base, written("term", F.col("terms"))), ",").alias("spans"),
        F.size("terms").cast("long").alias("n_term"))


def generalised(value: Column) -> Column:
    """A term's generalisation: its first letter and how long it is, to the next five letters."""
    bound = (F.ceil(F.char_length(value) / 5) * 5).cast("string")
    return F.concat(F.lit("["), F.substring(value, 1, 1), F.lit("*"), bound, F.lit("]"))


def sanitise(docs: DataFrame, pii: DataFrame, remove: float = REMOVE) -> DataFrame:
    """doc_id and the text with entities replaced by their kind, telling
    terms generalised, and those that tell nearly everything removed.  Ids
    must be unique here.  Spans that overlap an earlier one are skipped."""
    def masked(kind: str):
        return lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.lit(f"[{kind}]").alias("by"))

    marks = F.concat(
        *[F.transform(k, masked(k)) for k in KINDS],
        F.transform("terms", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.when(
            s["share"] >= remove, F.lit("")).otherwise(generalised(s["value"])).alias("by"))))
    rows = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole("text").alias("t"))
            .join(pii.select("doc_id", F.sort_array(marks).alias("marks")), "doc_id"))

    def step(acc: Column, m: Column) -> Column:
        cut = F.substring(F.col("t"), acc["at"] + 1, m["start"] - acc["at"])
        return F.when(m["start"] >= acc["at"], F.struct(m["end"].alias("at"), F.concat(acc["out"], cut, m["by"]).alias("out"))
                      ).otherwise(acc)

    out = F.aggregate("marks", F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step,
                      lambda a: F.concat(a["out"], F.substring(F.col("t"), a["at"] + 1, F.char_length("t"))))
    return rows.select("doc_id", out.alias("text"))

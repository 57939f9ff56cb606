"""Personal data in texts, and the terms that give it away, by DataFrame functions alone.

Matches of four patterns are the protected entities. Corpus co-occurrence then tells how much of
an entity a term reveals: with probabilities over documents, the information of an entity c is
IC(c) = -log2 P(c), and a term t near it reveals PMI(c; t) = log2(P(c, t) / (P(c) P(t))) of it
(the (C, a)-sanitisation of Sanchez and Batet, 2016). Terms that reveal a large enough share
PMI / IC of any entity are generalised or removed wherever they stand.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textcheck.session import materialise

KINDS = ("email", "ip", "card", "phone")
GENERALISED, REMOVED = "generalised", "removed"
# Fixed patterns of the four kinds. Runs are possessive and start where a run starts (or where the
# last match ended), which finds the same matches as trying every place, in linear time.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
PART = "0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
VALID_IP = rf"^{PART}(?:\.{PART}){{3}}$"
LABELS = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]", REMOVED: "[REMOVED]"}
#: A term is a run of at least three letters; letter case does not count.
TERM = r"\p{L}{3,}+"
#: Characters on either side of an entity in which its terms stand.
REACH = 80
#: Different surroundings in which a term must stand by an entity before it counts as evidence.
LEAST_WINDOWS = 3
#: Shares of an entity's information from which on a term is generalised, or removed.
GENERALISE_AT, REMOVE_AT = 0.90, 0.97
#: Characters of a text held as one piece when windows are cut out.
PIECE = 4_096

SPAN = "struct<kind:string,start:bigint,stop:bigint,value:string>"


def running(values: Column, add: Callable[[Column, Column], Column]) -> Column:
    """[0, v1, v1 + v2, ...] of an array of longs for ``add``, in n^1.5 steps: folds over the
    whole copy their result at each element, so rows of about sqrt(n) elements are folded."""
    width = F.greatest(F.lit(1), F.ceil(F.sqrt(F.size(values)))).cast("int")
    rows = F.when(F.size(values) > 0, F.transform(
        F.sequence(F.lit(1), F.greatest(F.lit(1), F.size(values)), width),
        lambda start: F.slice(values, start, width))).otherwise(F.array().cast("array<array<bigint>>"))
    start = F.array(F.lit(0).cast("long"))

    def fold(so_far: Column, x: Column) -> Column:
        return F.concat(so_far, F.array(add(F.element_at(so_far, -1), x)))

    return F.aggregate(rows, start, lambda done, row: F.concat(done, F.slice(
        F.aggregate(row, F.slice(done, -1, 1), fold), F.lit(2), F.size(row))))


def _plus(a: Column, b: Column) -> Column:
    return a + b


def _valid(kind: str) -> Callable[[Column], Column]:
    return lambda span: _is_valid(kind, span["value"])


def _is_valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        return value.rlike(VALID_IP)
    if kind == "card":
        digits = F.regexp_replace(value, "[ -]", "")
        # The value is tested for its length first: the sum is for numbers of 16 to 19 digits.
        return F.when(F.length(digits).between(16, 19), F.call_function("luhn_check", digits)).otherwise(False)
    if kind == "phone":
        return F.length(F.regexp_replace(value, "[^0-9]", "")).between(8, 15)
    return F.lit(True)


def _located(found: DataFrame, name: str, text: str, matches: str, pattern: str, kind: Column | None,
             ) -> DataFrame:
    """Add ``name``: (kind, start, stop, value) of the ``matches`` of ``pattern`` in ``text``."""
    none = F.array().cast("array<struct<gap:bigint,value:string>>")
    # The pieces between the matches; only texts with a match are split.
    gaps = F.zip_with(F.split(F.col(text), pattern, -1), matches, lambda gap, value: F.struct(
        F.char_length(gap).cast("long").alias("gap"), value.alias("value")))
    parts, ends = f"{name}_parts", f"{name}_ends"
    found = found.withColumn(parts, F.when(F.size(matches) > 0, gaps).otherwise(none))
    steps = F.transform(parts, lambda x: x["gap"] + F.coalesce(F.char_length(x["value"]), F.lit(0)))
    spans = F.zip_with(parts, ends, lambda x, before: F.struct(
        (kind if kind is not None else F.lit(name)).alias("kind"),
        (before + x["gap"]).alias("start"),
        (before + x["gap"] + F.char_length(x["value"])).alias("stop"), x["value"].alias("value")))
    return found.withColumn(ends, running(steps, _plus)).withColumn(
        name, F.filter(spans, lambda s: s["value"].isNotNull())).drop(parts, ends)


def with_entities(docs: DataFrame, text: str = "text", keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """(kept columns as ``row``, text, entities): the valid matches by kind, then start.

    Per kind matches are leftmost and do not overlap; those that fail their test are dropped.
    Positions are in characters. Null texts are empty.
    """
    found = docs.select(F.struct(*[F.col(f"`{c}`").alias(c) for c in keep]).alias("row"),
                        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    found = found.withColumns({f"{k}_all": F.regexp_extract_all("text", F.lit(PATTERNS[k]), F.lit(0))
                               for k in KINDS})
    for kind in KINDS:
        found = _located(found, kind, "text", f"{kind}_all", PATTERNS[kind], None)
    valid = [F.filter(kind, _valid(kind)) for kind in KINDS]
    return found.select("row", "text", F.concat(*valid).alias("entities"))


def _without_addresses(text: Column) -> Column:
    """The text with blanks for its e-mail addresses: no other kind holds letters."""
    blanks = F.transform(F.regexp_extract_all(text, F.lit(PATTERNS["email"]), F.lit(0)),
                         lambda m: F.repeat(F.lit(" "), F.char_length(m)))
    return F.when(F.contains(text, F.lit("@")), F.array_join(F.zip_with(
        F.split(text, PATTERNS["email"], -1), blanks,
        lambda gap, blank: F.concat(gap, F.coalesce(blank, F.lit("")))), "")).otherwise(text)


def _terms_of(text: Column) -> Column:
    return F.transform(F.regexp_extract_all(text, F.lit(TERM), F.lit(0)), F.lower)


def _windows(found: DataFrame) -> DataFrame:
    """(entity, window, terms): what stands around each entity, once per document."""
    # No filter, and no explode that implies one: it would be pushed below and find all twice.
    some = F.size("entities") > 0
    cut = found.withColumn("blank", F.when(some, _without_addresses(F.col("text")))).withColumn(
        "pieces", F.regexp_extract_all("blank", F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))).withColumn(
        "size", F.char_length("blank"))

    def between(start: Column, length: Column) -> Column:
        first = F.floor(start / PIECE).cast("int")
        near = F.concat(F.get("pieces", first), F.coalesce(F.get("pieces", first + 1), F.lit("")))
        return F.coalesce(F.substr(near, (start - first * PIECE + 1).cast("int"), length.cast("int")), F.lit(""))

    def around(s: Column) -> Column:
        start = F.greatest(s["start"] - REACH - 1, F.lit(0))
        before, after = between(start, s["start"] - start), between(s["stop"], F.lit(REACH + 1))
        # A term that the window may have cut is left out.
        before = F.when(start > 0, F.regexp_replace(before, r"^\p{L}+", "")).otherwise(before)
        after = F.when(s["stop"] + REACH + 1 < F.col("size"),
                       F.regexp_replace(after, r"\p{L}+$", "")).otherwise(after)
        key = F.when(s["kind"] == "email", F.lower(s["value"])).otherwise(
            F.regexp_replace(s["value"], "[ ().-]", "."))
        return F.struct(F.concat(s["kind"], F.lit(":"), key).alias("entity"),
                        F.array_sort(F.array_distinct(_terms_of(F.concat(before, F.lit(" "), after)))).alias("terms"))

    return cut.select(F.explode_outer(F.array_distinct(F.transform("entities", around))).alias("w")).select(
        "w.*").where("entity IS NOT NULL")


def disclosing_terms(docs: DataFrame, text: str = "text", least_windows: int = LEAST_WINDOWS,
                     generalise_at: float = GENERALISE_AT, remove_at: float = REMOVE_AT) -> DataFrame:
    """(term, share, action): the terms that reveal at least ``generalise_at`` of an entity.

    P(c), P(t) and P(c, t) are shares of all documents: with the entity, with the term anywhere
    outside of an address, with the term within REACH characters of the entity. Copies of a
    document count on both sides; but a pair is evidence only if the term stands by the entity in
    ``least_windows`` different surroundings, so that the words around an entity that occurs
    once, or in copies only, are left alone. An entity of every document has no information.
    """
    texts = docs.select(F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    windows = materialise(_windows(with_entities(texts, "text", ())))
    total = texts.agg(F.count("*")).scalar()
    entities = windows.groupBy("entity").agg(F.count("*").alias("with_entity"))
    # Equal surroundings are one row before the rows of a term meet.
    pairs = windows.select("entity", F.xxhash64("terms").alias("window"), F.explode("terms").alias("term")).groupBy(
        "entity", "term", "window").agg(F.count("*").alias("n")).groupBy("entity", "term").agg(
        F.sum("n").alias("together"), F.count("*").alias("windows")).where(F.col("windows") >= least_windows)
    pairs = materialise(pairs.join(entities, "entity"))
    spread = texts.select(F.explode_outer(F.array_distinct(_terms_of(_without_addresses(F.col("text"))))).alias(
        "term")).where("term IS NOT NULL").groupBy("term").agg(F.count("*").alias("with_term"))
    together = F.least("together", "with_term", "with_entity")
    share = F.log2(together * total / (F.col("with_entity") * F.col("with_term"))) / F.log2(
        total / F.col("with_entity"))
    return (pairs.join(spread, "term").where(F.col("with_entity") < total)
            .groupBy("term").agg(F.max(share).alias("share")).where(F.col("share") >= generalise_at)
            .withColumn("action", F.when(F.col("share") >= remove_at, REMOVED).otherwise(GENERALISED)))


def _masked(marked: DataFrame) -> DataFrame:
    """Add ``sanitised``: the text with a label for each span; spans that overlap become one,
    with the label of the first."""
    label = lambda s: F.coalesce(
        F.element_at(F.create_map(*[F.lit(x) for pair in LABELS.items() for x in pair]), s["kind"]),
        F.when(s["value"].rlike(r"^\p{Lu}"), "[NAME]").otherwise("[WORD]"))
    ordered = F.array_sort(F.transform("spans", lambda s: F.struct(
        s["start"].alias("start"), (-s["stop"]).alias("end"), label(s).alias("label"))))
    marked = marked.withColumn("_ordered", ordered)
    marked = marked.withColumn("_reach", running(F.transform("_ordered", lambda s: -s["end"]), F.greatest))
    # A span begins a group if all before it have ended; a last one stands at the text's end.
    marked = marked.withColumn("_heads", F.concat(
        F.filter(F.zip_with("_ordered", "_reach", lambda s, reach: F.struct(
            s["start"].alias("start"), reach.alias("before"), s["label"].alias("label"))),
            lambda h: h["start"] >= h["before"]),
        F.array(F.struct(F.char_length("text").cast("long").alias("start"),
                         F.element_at("_reach", -1).alias("before"), F.lit("").alias("label")))))
    width = F.greatest(F.lit(1), F.ceil(F.sqrt(F.size("_heads")))).cast("int")
    # Substrings count from the start of the text, so each group of sqrt(n) heads gets its section.
    groups = F.transform(F.sequence(F.lit(1), F.size("_heads"), width), lambda i: F.slice("_heads", i, width))
    sections = F.transform(groups, lambda g: F.struct(
        g.alias("heads"), g[0]["before"].alias("from"),
        F.substr("text", (g[0]["before"] + 1).cast("int"),
                 (F.element_at(g, -1)["start"] - g[0]["before"]).cast("int")).alias("section")))
    rebuilt = F.array_join(F.flatten(F.transform(sections, lambda x: F.transform(x["heads"], lambda h: F.concat(
        F.substr(x["section"], (h["before"] - x["from"] + 1).cast("int"),
                 (h["start"] - h["before"]).cast("int")), h["label"])))), "")
    return marked.withColumn("sanitised", F.when(F.size("spans") > 0, rebuilt).otherwise(F.col("text")))


def sanitise(docs: DataFrame, text: str = "text", keep: Sequence[str] = ("doc_id",),
             terms: DataFrame | None = None) -> DataFrame:
    """(kept columns, entities, spans, sanitised): personal data of each row of ``docs``.

    ``entities`` are the valid matches of the four patterns, ``spans`` these and the terms that
    give an entity away (kinds "generalised" and "removed", last), all as (kind, start, stop,
    value), by kind, then start; ``sanitised`` has labels in their place. ``terms`` is a table of
    ``disclosing_terms``, by default that of ``docs``. Null, empty and blank texts have no spans;
    equal rows and repeated or null ids are rows of their own; columns that are not kept are not
    read, and a kept one must not be named as an output.
    """
    if clash := {"entities", "spans", "sanitised"} & set(keep):
        raise ValueError(f"kept columns with the names of outputs: {sorted(clash)}")
    if terms is None:
        terms = disclosing_terms(docs, text)
    terms = materialise(terms.select("term", "action"))
    texts = docs.select(F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    # One row per text that holds such a term, whatever the number of its copies.
    held = materialise(texts.select(F.sha2("text", 256).alias("digest"), F.explode_outer(F.array_distinct(
        _terms_of(_without_addresses(F.col("text"))))).alias("term")).join(terms, "term").groupBy("digest").agg(
        F.map_from_entries(F.collect_set(F.struct("term", "action"))).alias("actions")))
    found = with_entities(docs, text, keep).withColumn("digest", F.sha2("text", 256)).join(held, "digest", "left")
    blank = F.when(F.col("actions").isNotNull(), _without_addresses(F.col("text")))
    found = found.withColumn("blank", blank).withColumn("words", F.coalesce(
        F.regexp_extract_all("blank", F.lit(TERM), F.lit(0)), F.array().cast("array<string>")))
    found = _located(found, "located", "blank", "words", TERM, F.lit(""))
    marks = F.filter(F.transform("located", lambda s: F.struct(
        F.element_at("actions", F.lower(s["value"])).alias("kind"), s["start"].alias("start"),
        s["stop"].alias("stop"), s["value"].alias("value"))), lambda s: s["kind"].isNotNull())
    found = found.withColumn("marks", F.array_sort(marks)).withColumn("spans", F.concat("entities", "marks"))
    return _masked(found).select("row.*", "entities", "spans", "sanitised")


def counted(spans: str, kind: str) -> Column:
    """Number of spans of a kind."""
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def listed(spans: Column) -> Column:
    """kind:start:end of spans, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")

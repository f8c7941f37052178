"""Personal data and the terms that give it away (built-in functions only).

E-mail addresses, IP addresses, card and phone numbers are found by pattern and check. Then the corpus tells which
terms reveal one of these entities: for an entity e and a term t near it,

* the information of the entity is IC = ln(N / n_e), with N documents and n_e different surroundings of e,
* what the term discloses is PMI = ln(J N / ((J + O) n_e)), with J different surroundings of e holding t, and O
  documents holding t elsewhere only.

Terms with at least ``MIN_WINDOWS`` such surroundings and PMI >= ``THRESHOLD`` IC disclose e, wherever they stand.
Such a term is generalised to its first ``PREFIX`` letters if that class of terms discloses nothing, and removed
otherwise. Surroundings are up to ``WINDOW`` terms on either side, not beyond another entity; equal ones count once,
so copies of a document are no evidence.

The patterns are the plain ones with possessive repetition and a look behind, which find the same matches in linear time
and without recursion, so texts may be long. Positions follow from the lengths of the pieces around the matches.

Cases: null text is empty and has no spans; ids are not used, so null and repeated ids don't matter; copies of rows
count as documents; an empty table stays empty. Columns beside the text are passed through by :func:`find`, those of
the same names as its results are replaced.
"""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from resight.llm.tables import let, text_of
from resight.session import saved

_LOCAL = "[A-Za-z0-9._%+-]"
EMAIL = rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
# entities that part a text: in one pass, with the usual bound of a mail name, so that no run of letters is read again
NAMED_MAIL = rf"{_LOCAL}{{1,64}}+@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
LONG_NUMBER = r"[0-9](?:[\x20-]?[0-9]){15,}+"
ENTITY = f"{NAMED_MAIL}|{IP}|{PHONE}|{LONG_NUMBER}"
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
KINDS = ("email", "ip", "card", "phone")
ACTIONS = ("generalise", "remove")

WINDOW = 8
MIN_WINDOWS = 3
THRESHOLD = 0.9
PREFIX = 3
_CHUNK = 512

_SPAN = "array<struct<start:int,end:int,text:string>>"


def _no_spans() -> Column:
    return F.array().cast(_SPAN)


def _running(parts: Column, start: Column) -> Column:
    """Spans of matches, given (gap before, text) in order, from ``start`` on."""
    first = F.struct(start.alias("at"), _no_spans().alias("spans"))

    def step(seen: Column, part: Column) -> Column:
        begin = seen.at + part.gap
        end = begin + F.length(part.text)
        span = F.struct(begin.alias("start"), end.alias("end"), part.text.alias("text"))
        return F.struct(end.alias("at"), F.concat(seen.spans, F.array(span)).alias("spans"))

    return F.aggregate(parts, first, step, lambda seen: seen.spans)


def _placed(parts: Column, start: Column) -> Column:
    """As :func:`_running`; long lists are added up in chunks, so that time stays nearly linear."""

    def chunked(parts: Column) -> Column:
        chunks = F.transform(
            F.sequence(F.lit(0), F.floor((F.size(parts) - 1) / _CHUNK).cast("int")), lambda i: F.slice(parts, i * _CHUNK + 1, _CHUNK)
        )
        size = lambda c: F.aggregate(c, F.lit(0), lambda n, p: n + p.gap + F.length(p.text))
        starts = F.aggregate(
            F.transform(chunks, size),
            F.struct(start.alias("at"), F.array().cast("array<int>").alias("out")),
            lambda s, n: F.struct((s.at + n).alias("at"), F.concat(s.out, F.array(s.at)).alias("out")),
            lambda s: s.out,
        )
        return F.flatten(F.zip_with(chunks, starts, _running))

    return F.when(F.size(parts) <= _CHUNK, _running(parts, start)).otherwise(chunked(parts))


def spans(text: Column, pattern: str, start: Column | None = None) -> Column:
    """(start, end, text) of all matches in code points."""
    matches, gaps = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)
    parts = F.zip_with(
        F.slice(gaps, 1, F.size(matches)), matches, lambda g, m: F.struct(F.length(g).alias("gap"), m.alias("text"))
    )
    return let(parts, lambda p: _placed(p, F.lit(0) if start is None else start))


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _is_ip(text: Column) -> Column:
    return F.forall(F.split(F.regexp_replace(text, r"(?<![0-9])0+", ""), r"\."), lambda p: F.lpad(p, 3, "0") <= "255") & ~text.rlike(
        r"[1-9][0-9]{3}"
    )


def _is_card(text: Column) -> Column:
    """16 to 19 digits, and the sum from the right, every second one doubled, ends in 0."""

    def luhn(digits: Column) -> Column:
        def add(total: Column, i: Column) -> Column:
            d = F.substr(digits, F.length(digits) - i, F.lit(1)).cast("int")
            return total + F.when(i % 2 == 0, d).when(d > 4, 2 * d - 9).otherwise(2 * d)

        return F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), add) % 10 == 0

    digits = _digits(text)
    return F.when(F.length(digits).between(16, 19), luhn(digits)).otherwise(F.lit(False))


def _is_phone(text: Column) -> Column:
    return F.length(_digits(text)).between(8, 15)


#: kind -> pattern, a cheap test of the text, check of a match
_RULES: dict[str, tuple[str, Callable[[Column], Column], Callable[[Column], Column]]] = {
    "email": (EMAIL, lambda t: t.contains("@"), lambda m: F.lit(True)),
    "ip": (IP, lambda t: t.rlike(r"[0-9]\.[0-9]"), _is_ip),
    "card": (CARD, lambda t: t.rlike(r"[0-9][\x20-]?[0-9]"), _is_card),
    "phone": (PHONE, lambda t: t.contains("+"), _is_phone),
}


def base_spans(text: Column, kind: str) -> Column:
    pattern, may, holds = _RULES[kind]
    return F.when(may(text), F.filter(spans(text, pattern), lambda s: holds(s.text))).otherwise(_no_spans())


def _listed(kind: str, found: Column) -> Column:
    return F.transform(found, lambda s: F.concat_ws(":", F.lit(kind), s.start.cast("string"), s.end.cast("string")))


def _cut(docs: DataFrame, text: str) -> DataFrame:
    """Add the text's ``found`` entities, and the ``gaps`` before, between and after them."""
    t = text_of(text)
    may = t.rlike(r"[@+]|[0-9]")
    return docs.withColumns(
        {
            "gaps": F.when(may, F.split(t, ENTITY, -1)).otherwise(F.array(t)),
            "found": F.when(may, F.regexp_extract_all(t, F.lit(ENTITY), F.lit(0))).otherwise(F.array().cast("array<string>")),
        }
    )


def _kind(match: Column) -> Column:
    """Kind of an entity as it is cut out, null where it fails its check."""
    return (
        F.when(match.contains("@"), "email")
        .when(match.startswith("+"), F.when(_is_phone(match), "phone"))
        .when(match.contains("."), F.when(_is_ip(match), "ip"))
        .when(_is_card(match), "card")
    )


def _entity(match: Column) -> Column:
    """An entity whatever its spelling."""
    kind = _kind(match)
    value = F.when(match.contains("@"), F.lower(match)).when(match.contains(".") & ~match.startswith("+"), match)
    return F.concat(kind, F.lit(":"), value.otherwise(_digits(match)))


def _terms(text: Column) -> Column:
    lower = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    return F.regexp_extract_all(lower, F.lit(TERM), F.lit(0))


def _class(term: Column) -> Column:
    return F.concat(F.substring(term, 1, PREFIX), F.lit("*"))


def _features(terms: Column) -> Column:
    """Different terms, and the classes of those that are longer than their class name."""
    classes = F.transform(F.filter(terms, lambda t: F.length(t) > PREFIX), _class)
    return F.array_distinct(F.concat(terms, classes))


def surroundings(docs: DataFrame, text: str = "text") -> DataFrame:
    """(doc, entity, terms) of every entity; ``doc`` tells rows of the input apart."""
    cut = _cut(docs.select(text_of(text).alias("t")).filter(F.col("t").rlike(ENTITY)), "t").select(
        "found", F.transform("gaps", _terms).alias("gaps")
    )

    def around(match: Column, i: Column) -> Column:
        before, after = F.get("gaps", i), F.get("gaps", i + 1)
        last = F.slice(before, F.greatest(F.size(before) - WINDOW, F.lit(0)) + 1, WINDOW)
        return F.struct(_entity(match).alias("entity"), F.concat(last, F.slice(after, 1, WINDOW)).alias("terms"))

    rows = cut.select(F.monotonically_increasing_id().alias("doc"), F.transform("found", around).alias("around"))
    return rows.select("doc", F.inline("around")).filter(F.col("entity").isNotNull())


def document_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """How many documents hold each feature outside entities."""
    gaps = _cut(docs.select(text), text)
    feature = F.explode(_features(_terms(F.array_join("gaps", " ")))).alias("feature")
    return gaps.select(feature).groupBy("feature").agg(F.count(F.lit(1)).alias("docs"))


def disclosing(docs: DataFrame, text: str = "text") -> DataFrame:
    """(term, action) of the terms that reveal an entity."""
    near = saved(surroundings(docs, text))
    windows = near.select("entity", "terms").distinct()
    per_entity = windows.groupBy("entity").agg(F.count(F.lit(1)).alias("n_entity")).filter(F.col("n_entity") >= MIN_WINDOWS)
    joint = windows.select("entity", F.explode(_features(F.col("terms"))).alias("feature"))
    joint = joint.groupBy("entity", "feature").agg(F.count(F.lit(1)).alias("n_joint")).filter(F.col("n_joint") >= MIN_WINDOWS)
    beside = near.select("doc", "entity", F.explode(_features(F.col("terms"))).alias("feature")).distinct()
    beside = beside.groupBy("entity", "feature").agg(F.count(F.lit(1)).alias("docs_near"))
    pairs = saved(joint.join(per_entity, "entity").join(beside, ["entity", "feature"]))

    n_docs = docs.count()
    elsewhere = F.col("docs") - F.col("docs_near")
    n, n_e, j = F.lit(float(n_docs)), F.col("n_entity"), F.col("n_joint")
    information = F.ln(n / n_e)
    disclosed = F.ln(j * n / ((j + elsewhere) * n_e))
    features = saved(
        pairs.join(document_counts(docs, text), "feature")
        .filter((information > 0) & (disclosed >= THRESHOLD * information))
        .select("feature")
        .distinct()
    )
    classes = features.filter(F.col("feature").endswith("*")).select(F.col("feature").alias("class"))
    terms = features.filter(~F.col("feature").endswith("*")).select(F.col("feature").alias("term"))
    named = F.when(F.length("term") > PREFIX, _class(F.col("term"))).otherwise(F.col("term"))
    terms = terms.withColumn("class", named).join(classes.withColumn("reveals", F.lit(True)), "class", "left")
    coarse = (F.length("term") > PREFIX) & F.col("reveals").isNull()
    return terms.select("term", F.when(coarse, ACTIONS[0]).otherwise(ACTIONS[1]).alias("action"))


def _hits(docs: DataFrame, terms: DataFrame, text: str) -> DataFrame:
    """Per different text, by its hash, the disclosing terms it holds: action -> terms."""
    cut = _cut(docs.select(text_of(text).alias("t")), "t")
    held = cut.select(F.sha2("t", 256).alias("text_key"), F.explode(F.array_distinct(_terms(F.array_join("gaps", " ")))).alias("term"))
    found = held.join(terms, "term").select("text_key", F.struct("term", "action").alias("hit"))
    return found.groupBy("text_key").agg(F.collect_set("hit").alias("hits"))


def find(docs: DataFrame, text: str = "text", terms: DataFrame | None = None) -> DataFrame:
    """Add the spans of each kind and action, as arrays of (start, end, text) named ``spans_<kind>``, and
    ``gaps``, ``found`` and ``hits`` for :func:`sanitised`."""
    terms = saved(disclosing(docs, text)) if terms is None else terms
    own = ["text_key", "gaps", "found", "hits", *[f"spans_{k}" for k in (*KINDS, *ACTIONS)]]
    rows = docs.drop(*[c for c in own if c != text]).withColumn("text_key", F.sha2(text_of(text), 256))
    rows = _cut(rows.join(saved(_hits(docs, terms, text)), "text_key", "left"), text)
    rows = rows.withColumns({f"spans_{k}": base_spans(text_of(text), k) for k in KINDS})

    # a disclosing term may stand anywhere between entities
    gap_sizes = F.zip_with(
        "gaps", F.concat(F.array(F.lit(0)), F.transform("found", F.length)), lambda g, e: F.struct(e.alias("gap"), g.alias("text"))
    )
    in_gaps = F.flatten(F.transform(let(gap_sizes, lambda p: _placed(p, F.lit(0))), lambda g: spans(g.text, TERM, g.start)))

    def acted(action: str) -> Column:
        these = F.transform(F.filter("hits", lambda h: h.action == action), lambda h: h.term)
        lower = lambda s: F.translate(s.text, string.ascii_uppercase, string.ascii_lowercase)
        return F.when(F.col("hits").isNotNull(), F.filter(in_gaps, lambda s: F.array_contains(these, lower(s)))).otherwise(_no_spans())

    return rows.withColumns({f"spans_{a}": acted(a) for a in ACTIONS}).drop("text_key")


def span_list(*kinds: str) -> Column:
    """``kind:start:end``, comma-joined, by kind as given and then by start."""
    return F.array_join(F.concat(*[_listed(k, F.col(f"spans_{k}")) for k in kinds]), ",")


def sanitised(found: DataFrame, text: str = "text") -> DataFrame:
    """Replace the text of :func:`find`'s rows: entities by their kind in brackets, disclosing terms by their class or
    by nothing. The spans are dropped, as they belong to the old text."""
    lower = lambda t: F.translate(t, string.ascii_uppercase, string.ascii_lowercase)

    def term(t: Column) -> Column:
        hit = F.get(F.filter("hits", lambda h: h.term == lower(t)), F.lit(0))
        return F.when(hit.action == ACTIONS[0], _class(t)).when(hit.action == ACTIONS[1], "").otherwise(t)

    def gap(g: Column) -> Column:
        replaced = F.transform(F.regexp_extract_all(g, F.lit(TERM), F.lit(0)), term)
        return F.array_join(F.zip_with(F.split(g, TERM, -1), F.concat(replaced, F.array(F.lit(""))), lambda a, b: F.concat(a, b)), "")

    gaps = F.when(F.col("hits").isNotNull(), F.transform("gaps", gap)).otherwise(F.col("gaps"))
    masks = F.transform("found", lambda m: F.coalesce(F.concat(F.lit("["), _kind(m), F.lit("]")), m))
    whole = F.array_join(F.zip_with(gaps, F.concat(masks, F.array(F.lit(""))), lambda a, b: F.concat(a, b)), "")
    clean = F.when(F.col(text).isNotNull(), whole)
    return found.withColumn(text, clean).drop("gaps", "found", "hits", *[f"spans_{k}" for k in (*KINDS, *ACTIONS)])

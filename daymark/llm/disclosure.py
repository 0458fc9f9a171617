"""Personal data and the terms that give it away, by DataFrame expressions only.

Base spans come from fixed patterns. Every distinct value found is a protected entity. How
strongly a term reveals an entity is measured in bits over whole texts of the corpus: the
entity's own information is -log2 of its share of all documents, and the term gives away as much
of it as their pointwise mutual information says. Terms that leave less of it than a threshold
are added as spans in the texts that hold the entity, there at every place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import written

#: Bits of an entity's information that a term may leave and is still added.
LEFT = 1.0
#: Bits that a term must give away at least.
GIVEN = 1.0
#: Distinct texts in which term and entity must stand together.
SUPPORT = 2
#: Documents, with the corpus' own share of the entity, that are added to those of each term, so
#: that few documents prove little.
PRIOR = 1.0

KINDS = ("email", "ip", "card", "phone")
# Each gives the matches of the stated pattern that can pass its check. Stretches are taken
# possessively and only begun where the pattern's leftmost match can begin, so the time is
# linear in the text and long stretches need no deep stack.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9]){11,}+",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
GATES = {"email": "instr(text, '@') > 0", "ip": "instr(text, '.') > 0", "card": "true", "phone": "instr(text, '+') > 0"}
DIGITS = "regexp_replace(s.value, '[^0-9]', '')"
LUHN = (
    "aggregate(sequence(1, length(d)), 0, (a, i) -> a + aggregate(array(CAST(substr(d, i, 1) AS INT)), 0, (b, x) -> b + "
    "CASE WHEN (length(d) - i) % 2 = 0 THEN x WHEN x > 4 THEN 2 * x - 9 ELSE 2 * x END)) % 10 = 0"
)
CHECKS = {
    "email": "true",
    "ip": "forall(split(s.value, '[.]'), p -> length(ltrim('0', p)) <= 3 AND CAST(concat('0', right(ltrim('0', p), 3)) AS INT) <= 255)",
    "card": f"exists(array({DIGITS}), d -> length(d) BETWEEN 12 AND 19 AND {LUHN})",
    "phone": f"length({DIGITS}) BETWEEN 9 AND 15",
}
SPAN = "array<struct<start:int,kind_no:int,end:int,kind:string,value:string>>"
NONE = f"CAST(array() AS {SPAN})"
#: A term is a run of letters and digits, with single apostrophes and hyphens inside.
TERM = r"[\p{L}\p{N}][\p{L}\p{M}\p{N}]*+(?:['’-][\p{L}\p{N}][\p{L}\p{M}\p{N}]*+)*+"

def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _places(text: str, pattern: str, item: str, only: str = "true") -> str:
    """An array with ``item`` for each match; a = place of the match, b = its end, v = the match.

    ``only`` is a condition on v for the matches that are kept.
    The pieces between the matches give the places, in code points.
    """
    q = _quoted(pattern)
    bound = item.replace("{a}", "(acc.at + length(z.p[i]))").replace("{b}", "(acc.at + length(z.p[i]) + length(z.m[i]))").replace("{v}", "z.m[i]")
    only = only.replace("{v}", "z.m[i]")
    first = item.replace("{a}", "0").replace("{b}", "0").replace("{v}", "''")
    return (
        f"transform(array(regexp_extract_all({text}, {q}, 0)), m0 -> CASE WHEN size(m0) = 0 THEN slice(array({first}), 1, 0) ELSE "
        f"transform(array(named_struct('m', m0, 'p', split({text}, {q}, -1))), z -> "
        f"aggregate(sequence(0, size(z.m) - 1), named_struct('at', 0, 'out', slice(array({first}), 1, 0)), "
        f"(acc, i) -> named_struct('at', acc.at + length(z.p[i]) + length(z.m[i]), 'out', CASE WHEN {only} THEN concat(acc.out, array({bound})) ELSE acc.out END), "
        f"acc -> acc.out))[0] END)[0]"
    )


def _kind(kind: str) -> str:
    item = f"named_struct('start', {{a}}, 'kind_no', {KINDS.index(kind)}, 'end', {{b}}, 'kind', '{kind}', 'value', {{v}})"
    found = _places("text", PATTERNS[kind], item)
    return f"CASE WHEN {GATES[kind]} THEN filter({found}, s -> {CHECKS[kind]}) ELSE {NONE} END"


def base_spans(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text, null as empty) with ``spans``: the checked matches by start and kind."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    arrays = ", ".join(f"CAST({_kind(k)} AS {SPAN})" for k in KINDS)
    return texts.withColumn("spans", F.expr(f"array_sort(concat({arrays}))"))


ENTITIES = (
    f"array_distinct(transform(spans, s -> concat(s.kind, ':', CASE WHEN s.kind IN ('card', 'phone') "
    f"THEN {DIGITS} ELSE lower(s.value) END)))"
)
TERMS = f"array_distinct(transform(regexp_extract_all(coalesce(text, ''), {_quoted(TERM)}, 0), v -> lower(v)))"


def _given(total: int) -> tuple[Column, Column]:
    """(bits of the entity's information that the term gives, bits that it leaves).

    The entity's probability given the term is estimated from the documents with both among
    those with the term, and ``PRIOR`` documents that hold the entity as often as all do.
    """
    share = F.col("holders") / F.lit(total)
    given_term = (F.col("together") + PRIOR * share) / (F.col("texts") + PRIOR)
    return F.log2(given_term / share), -F.log2(given_term)


def revealing_pairs(
    marked: DataFrame, docs: DataFrame, left: float = LEFT, given: float = GIVEN, support: int = SUPPORT
) -> tuple[DataFrame, DataFrame]:
    """Terms that reveal an entity, and where term and entity meet.

    ``marked`` has a row (name, copies, entities, terms) per distinct text that holds an entity,
    ``docs`` all documents. The first result is (entity, term, together, texts, holders, bits),
    the numbers counting documents; the second (name, entity, term) for the texts that hold
    both. ``support`` counts different texts, so exact copies lend a term no weight.

    All words of the corpus are counted, combined before the shuffle. A term in more documents
    than ``2 ** left`` times those of an entity, with the prior, leaves too much to be telling, so
    entities meet only the words that are rare enough for them; this loses no term.
    """
    total = docs.count()
    held = docs.select(F.explode(F.expr(TERMS)).alias("term")).groupBy("term").agg(F.count("*").alias("texts"))
    entities = marked.select("name", "copies", F.explode("entities").alias("entity"))
    counted = entities.groupBy("entity").agg(F.sum("copies").alias("holders"), F.count("*").alias("different"))
    known = written(
        entities.join(counted.where(F.col("different") >= support).drop("different"), "entity"), "entities"
    )
    rarest = known.groupBy("name").agg(F.max("holders").alias("most"))
    words = marked.join(rarest, "name").select("name", "most", F.explode("terms").alias("term"))
    allowed = F.lit(2.0**left)
    rare = words.join(held, "term").where(F.col("texts") <= allowed * (F.col("most") + PRIOR))
    pairs = rare.drop("most").join(known, "name").where(F.col("texts") <= allowed * (F.col("holders") + PRIOR))
    pairs = written(pairs, "pairs")
    bits, rest = _given(total)
    telling = (
        pairs.groupBy("entity", "term")
        .agg(
            F.sum("copies").alias("together"), F.count("*").alias("different"),
            F.first("texts").alias("texts"), F.first("holders").alias("holders"),
        )
        .where((F.col("different") >= support) & (rest <= left) & (bits >= given))
    )
    return telling.select("entity", "term", "together", "texts", "holders", bits.alias("bits")), pairs.select("name", "entity", "term")


def all_spans(
    docs: DataFrame, left: float = LEFT, given: float = GIVEN, support: int = SUPPORT, with_text: bool = False
) -> DataFrame:
    """doc_id, spans (base) and added (terms that reveal an entity of the text), maybe the text.

    Added spans have the kind ``term`` and never lie inside a base span. See ``personal_data``.
    """
    text = "text" if with_text else "CASE WHEN size(spans) > 0 THEN text END AS text"
    found = written(base_spans(docs).selectExpr("doc_id", "xxhash64(text) AS name", "spans", text), "spans")
    marked = found.where("size(spans) > 0").groupBy("name").agg(
        F.count("*").alias("copies"), F.first("text").alias("text"), F.first("spans").alias("spans")
    )
    marked = marked.selectExpr("name", "copies", f"{ENTITIES} AS entities", f"{TERMS} AS terms")
    telling, pairs = revealing_pairs(marked, docs, left, given, support)
    hits = pairs.join(telling.select("entity", "term"), ["entity", "term"]).groupBy("name").agg(F.collect_set("term").alias("telling"))
    item = f"named_struct('start', {{a}}, 'kind_no', {len(KINDS)}, 'end', {{b}}, 'kind', 'term', 'value', lower({{v}}))"
    places = _places("text", TERM, item, "array_contains(around, lower({v}))")
    added = f"filter(transform(array(telling), around -> {places})[0], t -> NOT exists(spans, s -> t.start < s.end AND s.start < t.end))"
    # Only texts with entities have a place in the join; the others pass beside it.
    some = found.where("size(spans) > 0").join(hits, "name", "left")
    kept = ["doc_id", "spans", *["text"] * with_text]
    some = some.selectExpr(*kept, f"CASE WHEN telling IS NULL THEN {NONE} ELSE {added} END AS added")
    return some.unionByName(found.where("size(spans) = 0").selectExpr(*kept, f"{NONE} AS added"))


def _listed(spans: str) -> str:
    return f"array_join(transform({spans}, s -> concat(s.kind, ':', s.start, ':', s.end)), ',')"


def personal_data(
    docs: DataFrame, left: float = LEFT, given: float = GIVEN, support: int = SUPPORT
) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans.

    Places are code points, ends exclusive. ``spans`` lists base and added spans as
    kind:start:end by start and then by kind, ``base_sha256`` hashes the list of base spans.
    A term is added if it leaves at most ``left`` bits of an entity's information, gives
    ``given`` bits at least, and stands in ``support`` different texts with the entity; entities
    and terms of one text only are therefore never told by terms.

    Null and empty texts have no spans. Spans of different kinds may overlap; both stay. Rows
    with equal texts get the same spans, whatever their doc_id, and count as one text where
    texts are counted. Very long texts are searched whole. An empty table gives an empty
    result. Other columns are ignored.
    """
    rows = all_spans(docs, left, given, support)
    counts = [F.expr(f"CAST(size(filter(spans, s -> s.kind = '{k}')) AS BIGINT)").alias(f"n_{k}") for k in KINDS]
    return rows.select(
        "doc_id", *counts,
        F.sha2(F.expr(_listed("spans")), 256).alias("base_sha256"),
        F.expr(_listed("array_sort(concat(spans, added))")).alias("spans"),
    )


def sanitised(
    docs: DataFrame, left: float = LEFT, given: float = GIVEN, support: int = SUPPORT
) -> DataFrame:
    """doc_id and the text with base spans generalised to their kind and revealing terms removed."""
    rows = all_spans(docs, left, given, support, with_text=True)
    step = (
        "(acc, s) -> CASE WHEN s.start < acc.at THEN acc ELSE named_struct('at', s.end, 'out', "
        "concat(acc.out, substring(text, acc.at + 1, s.start - acc.at), CASE WHEN s.kind = 'term' THEN '' ELSE concat('[', s.kind, ']') END)) END"
    )
    clean = (
        f"aggregate(array_sort(concat(spans, added)), named_struct('at', 0, 'out', ''), {step}, "
        "acc -> concat(acc.out, substring(text, acc.at + 1)))"
    )
    return rows.select("doc_id", F.expr(clean).alias("text"))

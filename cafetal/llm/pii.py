"""Personal data: patterns, and terms that reveal a protected entity by co-occurrence (DataFrame functions only)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cafetal.llm.common import fresh, materialise

KINDS = ("email", "ip", "card", "phone")
TERM_KINDS = ("generalised", "removed")

# The contract's patterns.  The look-behinds and possessive groups find the same matches, but a long
# run of letters or digits is entered once only, and long matches need no stack.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# A cheap look whether a text can have any match at all.
_HINTS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][\x20-]?[0-9]", "phone": r"\+[0-9]"}
_OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]?[0-9])"
_TERM = r"\p{L}{3,}"
_TERM_TYPE = "array<struct<term:string,start:int,end:int>>"
_BLOCK = 128
_CELL = 256  # code points of a cell in which spans meet
_COPIES = ("__least1", "__least2", "__least3")


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, however often and in whatever lambda it is used."""
    return F.get(F.transform(F.array(value), lambda x: body(x)), F.lit(0))


def _total(xs: Column) -> Column:
    return F.aggregate(xs, F.lit(0), lambda a, x: a + x)


def _places(text: Column, pattern: str, span) -> Column:
    """``span(match, start)`` of every match.

    Starts are sums of the lengths of gaps and matches: of whole blocks, then of the
    rest of the match's block.
    """
    def steps(gaps, found):
        return F.transform(gaps, lambda g, i: F.length(g) + F.when(i > 0, F.length(F.get(found, i - 1))).otherwise(0))

    def start(lengths, blocks, i):
        b = F.floor(i / _BLOCK).cast("int")
        return _total(F.slice(blocks, F.lit(1), b)) + _total(F.slice(lengths, b * _BLOCK + 1, i % _BLOCK + 1))

    def sums(lengths):
        return F.transform(F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / _BLOCK).cast("int")),
                           lambda b: _total(F.slice(lengths, b * _BLOCK + 1, F.lit(_BLOCK))))

    return _let(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
        lambda found: _let(
            steps(F.split(text, pattern, -1), found),
            lambda lengths: _let(sums(lengths), lambda blocks: F.transform(
                found, lambda m, i: span(m, start(lengths, blocks, i))))))


def _valid(kind: str, m: Column) -> Column:
    digits = F.regexp_replace(m, "[^0-9]", "")
    if kind == "ip":
        return m.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$")
    if kind == "card":
        return F.length(digits).between(12, 19) & F.call_function("luhn_check", digits)
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.lit(True)


def _entities(kind: str, m: Column) -> Column:
    """Hashes of what a match names, as it is and in a coarser grain.

    An address and its domain, an IP and its block of 256, the digits of a card or phone and the first six of them.
    """
    if kind in ("card", "phone"):
        digits = F.regexp_replace(m, "[^0-9]", "")
        return F.array(F.xxhash64(F.lit(kind), digits), F.xxhash64(F.lit(f"{kind} group"), F.left(digits, F.lit(6))))
    cut = r"^[^@]*@" if kind == "email" else r"\.[0-9]+$"
    return F.array(F.xxhash64(F.lit(kind), F.lower(m)), F.xxhash64(F.lit(f"{kind} group"), F.regexp_replace(F.lower(m), cut, "")))


def base_spans(body: str = "__body") -> Column:
    """All valid base spans of a text, sorted: array of struct(start, kind number, end, entities)."""
    def of(k: int, kind: str) -> Column:
        spans = _places(F.col(body), PATTERNS[kind], lambda m, s: F.struct(
            s.alias("start"), F.lit(k).alias("kind"), (s + F.length(m)).alias("end"),
            _entities(kind, m).alias("entities"), _valid(kind, m).alias("ok")))
        kept = F.filter(spans, lambda x: x["ok"])
        empty = F.array().cast("array<struct<start:int,kind:int,end:int,entities:array<bigint>,ok:boolean>>")
        return F.when(F.col(body).rlike(_HINTS[kind]), kept).otherwise(empty)

    return F.array_sort(F.concat(*[of(k, kind) for k, kind in enumerate(KINDS)]))


def _masked(spans: str, body: str) -> str:
    """SQL: the text with its spans masked; of overlapping spans the first one counts."""
    masks = " ".join(f"when {k} then '[{n.upper()}]'" for k, n in enumerate(KINDS))
    return f"""
      aggregate({spans}, struct(0 as pos, cast(array() as array<string>) as bits),
        (a, x) -> case when x.start < a.pos then a else
          struct(x.end as pos, concat(a.bits, array(substring({body}, a.pos + 1, x.start - a.pos),
                 case x.kind {masks} when {len(KINDS)} then '[TERM]' else '' end)) as bits) end,
        a -> concat(array_join(a.bits, ''), substring({body}, a.pos + 1)))
    """


def _least_hash(seed: int) -> Column:
    return F.array_min(F.transform("__terms", lambda t: F.xxhash64(t["term"], F.lit(seed))))


def _judged(table: DataFrame, frequency: DataFrame, n_docs: int, removed: float, generalised: float,
            least_bits: float) -> DataFrame:
    """(__uid, term, kind): terms that disclose an entity of their document.

    Entities that stand in the very same documents are one class, so a list of ten thousand addresses in two
    documents is counted once.  A pair's count is at most min(df, n), so pairs that could not pass even then are never made:
    among them all of an entity or term of one document, and an entity that a large share of all documents holds.
    """
    def bits(c):
        return F.log2(c / F.col("df") * F.lit(float(max(n_docs, 1))) / F.col("n"))

    def sure(c, groups):
        return c / F.col("df") * groups / (groups + 1)

    held = table.select("__uid", F.explode("__entities").alias("entity"))
    same = F.xxhash64(F.count(F.lit(1)), F.bit_xor(F.xxhash64("__uid")), F.bit_xor(F.xxhash64("__uid", F.lit(1))))
    many = held.groupBy("entity").agg(F.count(F.lit(1)).alias("n"), same.alias("class")).filter("n > 1")
    held = (held.join(many, "entity").select("__uid", "class", "n").distinct()
            .select(F.col("__uid").alias("__huid"), "class", "n"))
    # c / n <= 1, so bits are at most log2(D / df)
    rare = frequency.filter(F.log2(F.lit(float(max(n_docs, 1))) / F.col("df")) >= least_bits)
    terms = table.select("__uid", *_COPIES, F.explode(F.array_distinct(F.transform("__terms", lambda t: t["term"]))).alias("term")
                         ).join(rare, "term")
    most = F.least("df", "n")
    pairs = materialise(
        terms.join(held, (F.col("__uid") == F.col("__huid")) & (sure(most, most) >= generalised) & (bits(most) >= least_bits))
        .select("__uid", "class", "term", "n", "df", *_COPIES), "pii-pairs")
    # copies of a text are no further evidence: those that share two of three least hashes of their terms count as one
    counted = pairs.groupBy("class", "term", "n", "df").agg(
        F.count(F.lit(1)).alias("c"), *(F.count_distinct(k).alias(k) for k in _COPIES))
    x, y, z = _COPIES
    groups = F.greatest(F.least(x, y), F.least(F.greatest(x, y), z))
    evidence = sure(F.col("c"), groups)
    verdicts = (counted.filter((groups > 1) & (evidence >= generalised) & (bits(F.col("c")) >= least_bits))
                .select("class", "term", F.when(evidence >= removed, len(KINDS) + 1).otherwise(len(KINDS)).alias("kind")))
    return (pairs.select("__uid", "class", "term").join(verdicts, ["class", "term"])
            .groupBy("__uid", "term").agg(F.max("kind").alias("kind")))


def _clear_places(table: DataFrame, judged: DataFrame) -> DataFrame:
    """Occurrences (__uid, start, end, kind) of judged terms that overlap no base span; both meet in cells of the text."""
    cells = F.sequence(F.floor(F.col("start") / _CELL), F.floor((F.col("end") - 1) / _CELL))
    places = (table.filter(F.size("__terms") > 0).select("__uid", F.explode("__terms").alias("t")).select("__uid", "t.*")
              .join(judged, ["__uid", "term"]).select("__uid", "start", "end", "kind"))
    base = table.select("__uid", F.explode("base").alias("x")).select(
        F.col("__uid").alias("__buid"), F.col("x.start").alias("start"), F.col("x.end").alias("end"))
    base = base.select("__buid", F.col("start").alias("__from"), F.col("end").alias("__to"), F.explode(cells).alias("__bcell"))
    taken = (places.withColumn("__cell", F.explode(cells))
             .join(base, (F.col("__uid") == F.col("__buid")) & (F.col("__cell") == F.col("__bcell"))
                   & (F.col("__from") < F.col("end")) & (F.col("start") < F.col("__to")), "left_semi")
             .select("__uid", "start").distinct())
    return places.join(taken, ["__uid", "start"], "left_anti")


def find_personal_data(docs: DataFrame, removed: float = 0.74, generalised: float = 0.6, least_bits: float = 4.0,
                       id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Personal data and what reveals it, in every whole text.

    Base spans are the patterns' matches.  Each distinct value is a protected entity, and so is its group (mail domain,
    block of IPs, first digits of a number).  Terms (runs of three letters or more) co-occur with every entity of
    their document.  Over all documents, c counts those that hold both, df those that hold the term, n those that hold the
    entity, and k the c documents with copies of one text counted once (texts count as copies if two of three least
    hashes of their terms agree: the median of three counts of distinct ones).  The term discloses
    log2(c * D / (df * n)) bits of the entity's log2(D / n), and leaves the entity with a probability c / df, of which
    k / (k + 1) is believed: one document is never enough, however rare its words.  A term that
    discloses ``least_bits`` and is believed to ``generalised`` (two documents of two are 0.67) is
    generalised, from ``removed`` on (three of three are 0.75) it is removed: all its occurrences in all
    documents that hold the entity, but for those that overlap a base span.

    Returns one row per input row: ``doc_id``, ``base`` and ``spans`` (arrays of
    struct(start, kind, end), code points, end exclusive, sorted; kinds number
    ``KINDS`` then ``TERM_KINDS``).  A null text is the empty one; null ids are passed on; repeated rows come back
    repeated, and as copies they are no evidence.

    Plan: base spans and the terms of documents that have some come from one scan and are written; document
    frequencies come from a second one, partially aggregated in each task.  Pairs of a document's entities and terms are
    only made where both stand in two documents or more.
    """
    body = F.coalesce(F.col(text_col), F.lit(""))
    source = docs.select(F.col(id_col).cast("long").alias("__id"), F.xxhash64(body).alias("__h"), body.alias("__body"))
    terms = F.when(F.size("__base") > 0, _places(F.col("__body"), _TERM, lambda m, s: F.struct(
        F.lower(m).alias("term"), s.alias("start"), (s + F.length(m)).alias("end"))))
    table = materialise(source.withColumn("__base", base_spans()).select(
        F.monotonically_increasing_id().alias("__uid"),
        "__id", "__h", F.transform("__base", lambda x: F.struct(x["start"], x["kind"], x["end"])).alias("base"),
        F.array_distinct(F.flatten(F.transform("__base", lambda x: x["entities"]))).alias("__entities"),
        F.coalesce(terms, F.array().cast(_TERM_TYPE)).alias("__terms"))
        .select("*", *(_least_hash(k).alias(c) for k, c in enumerate(_COPIES))), "pii-base")
    frequency = (source.select(F.explode(F.array_distinct(
        F.regexp_extract_all(F.lower("__body"), F.lit(_TERM), F.lit(0)))).alias("term"))
        .groupBy("term").agg(F.count("*").alias("df")).filter("df > 1"))
    judged = _judged(table, frequency, table.count(), removed, generalised, least_bits)
    found = (_clear_places(table, judged).groupBy(F.col("__uid").alias("__xuid"))
             .agg(F.collect_list(F.struct("start", "kind", "end")).alias("__extra")))
    empty = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    return (table.join(found, F.col("__uid") == F.col("__xuid"), "left")
            .select(F.col("__id").alias("doc_id"), "__h", "base",
                    F.array_sort(F.concat("base", F.coalesce("__extra", empty))).alias("spans")))


def sanitise(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **parameters) -> DataFrame:
    """The columns of ``docs`` with the text masked: base spans by their kind, terms generalised or removed.

    Parameters as in :func:`find_personal_data`; a null text comes back empty.  Of
    overlapping spans the first one is masked.  One shuffle of the texts.
    """
    body = F.coalesce(F.col(text_col), F.lit(""))
    own, sid, sh, spans = fresh(docs, "__sbody", "__sid", "__sh", "__spans")
    found = (find_personal_data(docs, id_col=id_col, text_col=text_col, **parameters)
             .select(F.col("doc_id").alias(sid), F.col("__h").alias(sh), F.col("spans").alias(spans))
             .dropDuplicates([sid, sh]))
    joined = docs.withColumn(own, body).join(
        found, F.col(id_col).cast("long").eqNullSafe(F.col(sid)) & (F.xxhash64(own) == F.col(sh)))
    return joined.select(*[F.expr(_masked(spans, own)).alias(c) if c == text_col else F.col(f"`{c}`")
                           for c in docs.columns])


def digest(result: DataFrame) -> DataFrame:
    """The contract's columns of a :func:`find_personal_data` result."""
    names = F.array(*[F.lit(n) for n in (*KINDS, *TERM_KINDS)])

    def text(spans):
        return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(names, x["kind"]), x["start"],
                                                                     x["end"])), ",")

    def count(k):
        return F.size(F.filter("base", lambda x: x["kind"] == k)).cast("long")

    return result.select("doc_id", *[count(k).alias(f"n_{n}") for k, n in enumerate(KINDS)],
                         F.sha2(text(F.col("base")), 256).alias("base_sha256"), text(F.col("spans")).alias("spans"))

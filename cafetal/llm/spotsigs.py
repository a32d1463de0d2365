"""Document fingerprints after SpotSigs: chains of content words that follow common words.

Everything here is column expressions and DataFrame operators: no Python worker is started.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cafetal.llm.common import numbered

# The common words of English, French, German and Spanish at which chains start.
ANCHORS = (
    # English
    "the a an and or of to in on at by for from with as is are was were be been has have had it its this that these those "
    "not but he she they we you his her their there which who will would can could do does did said only any "
    # French
    "le la les un une des du de et ou en dans sur pour par avec est sont qui que ne pas ce cette ces il elle ils au aux se "
    # German
    "der die das den dem ein eine einer und oder nicht ist sind war mit von zu zur zum im am auf aus bei nach für als auch "
    # Spanish
    "el los las y o una uno del al con por para es son que no lo su sus se como más pero este esta"
).split()

CHAIN = 2  # content words of a signature
LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often ``body`` (or a lambda in it) looks at it."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    """Runs of ASCII letters, digits and all characters beyond ASCII; A-Z in lower case."""
    return F.filter(F.split(F.translate(text, LETTERS, LETTERS.lower()), BREAK), lambda w: w != "")


def signatures(text: Column, chain: int = CHAIN) -> Column:
    """The sorted set of a text's spot signatures: a common word and the next ``chain`` content words, joined by blanks.

    Content words are all others; a chain goes on over common words between them.  A text without a
    whole chain has all runs of ``chain + 1`` words instead; if it has fewer words, all of them are its one
    signature; without words the set is empty.
    """
    is_common = lambda w: w.isin(*sorted(set(ANCHORS)))

    def spots(s: Column) -> Column:
        # the k-th common word stands at word i, so i - k content words come before it
        return F.filter(F.transform(s["spots"], lambda x, k: F.concat_ws(
            " ", F.array(x["w"]), F.slice(s["content"], x["i"] - k + 1, chain), F.when(
                x["i"] - k + chain > F.size(s["content"]), F.lit("")))),
            lambda g: ~g.endswith(" "))

    def plain(ws: Column) -> Column:
        runs = F.transform(F.sequence(F.lit(1), F.greatest(F.size(ws) - chain, F.lit(1))),
                           lambda i: F.concat_ws(" ", F.slice(ws, i, chain + 1)))
        return F.when(F.size(ws) == 0, F.array().cast("array<string>")).otherwise(runs)

    def of_words(ws: Column) -> Column:
        split = F.struct(
            F.filter(F.transform(ws, lambda w, i: F.struct(w.alias("w"), i.alias("i"))), lambda x: is_common(x["w"])).alias("spots"),
            F.filter(ws, lambda w: ~is_common(w)).alias("content"))
        return let(let(split, spots), lambda found: F.when(F.size(found) > 0, found).otherwise(plain(ws)))

    return let(words(text), lambda ws: F.array_sort(F.array_distinct(of_words(ws))))


def fingerprint(signature_set: Column) -> Column:
    """SHA-256 of the sorted signatures, joined by newlines."""
    return F.sha2(F.array_join(signature_set, "\n"), 256)


def hashed(signature_set: Column) -> Column:
    """The signatures as 64-bit hashes: what likenesses are counted on, and what is shuffled."""
    return F.transform(signature_set, lambda s: F.xxhash64(s))


def likeness(a: Column, b: Column, least: float = 0.0) -> Column:
    """Jaccard similarity of two sets; 1 for two empty ones.

    Pruned: no two sets whose sizes differ by more than a factor of ``least`` can be that similar,
    so such a pair (and one with an empty set) is 0 without being intersected.
    """
    small, big = F.least(F.size(a), F.size(b)), F.greatest(F.size(a), F.size(b))
    common = F.size(F.array_intersect(a, b))
    exact = let(common.cast("double"), lambda n: n / (F.size(a) + F.size(b) - n))
    return (F.when(big == 0, 1.0).when((small == 0) | (small < F.lit(least) * big), 0.0).otherwise(exact))


def length_part(signature_set: Column, least: float = 0.8) -> Column:
    """The partition of a set by its length: sets at least ``least`` alike lie in the same or in neighbouring ones."""
    n = F.size(signature_set)
    return F.when(n > 0, F.floor(F.log(n.cast("double")) / F.log(F.lit(1 / least)) + 1e-9)).otherwise(-1).cast("int")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every document's fingerprint, and its likeness to an edited copy and to the next document.

    Next is the document that follows by ascending id (null ids first, equal ids by a hash of the text;
    repeated rows are one document), after the last one the first.  The edited text has its last quarter
    (``floor(n_chars / 4)`` code points) replaced by the first as many (or all) of the next text.  A null text is
    empty.  Returns a row for each row: id, ``n_chars``, ``edited_sha256``, ``fingerprint``, ``edited_fingerprint``,
    ``near_edited``, ``near_next``, ``n_signatures``, ``length_part`` and ``next_id``.  Other columns are not looked at.

    Two shuffles by id: one of the texts, one of quarters of texts and hashed signatures.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("__id"), text.alias("__text"))
    rows = rows.withColumn("__h", F.xxhash64("__text", F.col("__id").isNull())).withColumn("__k", F.coalesce("__id", F.lit(0)))
    keys = rows.groupBy("__k", "__h").agg(F.first("__id").alias("__id"), F.first(F.length("__text")).alias("__n"))
    order = numbered(keys, [F.col("__id").asc_nulls_first(), F.col("__h").asc()], "__g", "spotsigs-order")
    total = order.count()
    before = order.select(((F.col("__g") + 1) % max(1, total)).alias("__g"), F.col("__k").alias("__to_k"),
                          F.col("__h").alias("__to_h"), F.floor(F.col("__n") / 4).cast("int").alias("__need"))
    gives = order.select("__g", "__k", "__h").join(before, "__g").drop("__g")
    whole = (rows.groupBy("__k", "__h").agg(F.first("__id").alias("__id"), F.first("__text").alias("__text"),
                                            F.count(F.lit(1)).alias("__rows")).join(gives, ["__k", "__h"]))
    # both uses of ``whole`` need the same columns of the texts' shuffle, so that it is made once
    gifts = whole.filter("__rows > 0").select(
        F.col("__to_k").alias("__k"), F.col("__to_h").alias("__h"), F.col("__id").alias("__next_id"),
        F.expr("left(__text, __need)").alias("__head"), hashed(signatures(F.col("__text"))).alias("__next"))
    n = F.length("__text")
    edited = F.concat(F.expr("left(__text, length(__text) - cast(floor(length(__text) / 4) as int))"), "__head")
    out = (whole.select("__k", "__h", "__id", "__text", "__rows").join(gifts, ["__k", "__h"])
           .withColumn("__edited", edited)
           .withColumn("__own", signatures(F.col("__text"))).withColumn("__changed", signatures(F.col("__edited")))
           .select(F.col("__id").alias("doc_id"), n.cast("long").alias("n_chars"),
                   F.sha2("__edited", 256).alias("edited_sha256"), fingerprint(F.col("__own")).alias("fingerprint"),
                   fingerprint(F.col("__changed")).alias("edited_fingerprint"),
                   likeness(F.col("__own"), F.col("__changed")).alias("near_edited"),
                   likeness(hashed(F.col("__own")), F.col("__next")).alias("near_next"),
                   F.size("__own").cast("long").alias("n_signatures"), length_part(F.col("__own")).alias("length_part"),
                   F.col("__next_id").alias("next_id"), "__rows"))
    return out.withColumn("__rows", F.explode(F.sequence(F.lit(1).cast("long"), "__rows"))).drop("__rows")


def _oracle() -> str:
    stops = ", ".join(f"'{w}'" for w in sorted(set(ANCHORS)))
    return f"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
pairs AS (
  SELECT doc_id, text, length(text) AS n,
         coalesce(lead(doc_id) OVER (ORDER BY doc_id), first_value(doc_id) OVER (ORDER BY doc_id)) AS next_id,
         coalesce(lead(text) OVER (ORDER BY doc_id), first_value(text) OVER (ORDER BY doc_id)) AS next_text
  FROM docs
), edits AS (
  SELECT doc_id, n, text, next_id, next_text, left(text, n - n // 4) || left(next_text, n // 4) AS edited FROM pairs
), texts AS (
  SELECT DISTINCT text FROM (SELECT text FROM docs UNION ALL SELECT edited FROM edits)
), cut AS (
  SELECT text, list_filter(string_split_regex(translate(text, '{LETTERS}', '{LETTERS.lower()}'),
                           '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda w: w <> '') AS ws FROM texts
), parts AS (
  SELECT text, ws, list_filter(ws, lambda w: w NOT IN ({stops})) AS content,
         list_filter(list_transform(ws, lambda w, i: {{'w': w, 'i': i}}), lambda x: x.w IN ({stops})) AS spots FROM cut
), found AS (
  SELECT text, ws, list_transform(
           list_filter(list_transform(spots, lambda x, k: {{'w': x.w, 'from': x.i - k + 1}}), lambda y: y."from" + {CHAIN - 1} <= len(content)),
           lambda y: y.w || ' ' || array_to_string(list_slice(content, y."from", y."from" + {CHAIN - 1}), ' ')) AS sigs FROM parts
), sets AS (
  SELECT text, list_sort(list_distinct(CASE WHEN len(sigs) > 0 THEN sigs WHEN len(ws) = 0 THEN []
    ELSE list_transform(range(1, greatest(len(ws) - {CHAIN}, 1) + 1),
                        lambda i: array_to_string(list_slice(ws, i, i + {CHAIN}), ' ')) END)) AS s FROM found
), compared AS (
  SELECT e.doc_id, e.n, e.next_id, e.edited, a.s AS a, b.s AS b, c.s AS c,
         len(list_intersect(a.s, b.s)) AS ab, len(list_intersect(a.s, c.s)) AS ac
  FROM edits e JOIN sets a ON a.text = e.text JOIN sets b ON b.text = e.edited JOIN sets c ON c.text = e.next_text
)
SELECT doc_id, CAST(n AS BIGINT) AS n_chars, sha256(edited) AS edited_sha256,
       sha256(array_to_string(a, chr(10))) AS fingerprint, sha256(array_to_string(b, chr(10))) AS edited_fingerprint,
       CASE WHEN len(a) + len(b) = 0 THEN 1e0 ELSE ab / (len(a) + len(b) - ab)::DOUBLE END AS near_edited,
       CASE WHEN len(a) + len(c) = 0 THEN 1e0 ELSE ac / (len(a) + len(c) - ac)::DOUBLE END AS near_next,
       CAST(len(a) AS BIGINT) AS n_signatures,
       CAST(CASE WHEN len(a) > 0 THEN floor(ln(len(a)::DOUBLE) / ln(1 / 0.8) + 1e-9) ELSE -1 END AS INTEGER) AS length_part, next_id
FROM compared
"""


ORACLE = _oracle()

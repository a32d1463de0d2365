"""Line dedup: lines that several documents share stay in one of them only."""

from __future__ import annotations

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cafetal.llm.common import ASCII_SPACE, column, fresh, slices

_FLUSH = 50_000


def _line_keys(min_chars: int):
    def explode(batches):
        ids, texts, positions, highs, lows = out = ([], [], [], [], [])

        def flush():
            batch = pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(texts, pa.int64()), pa.array(positions, pa.int32()),
                 pa.array(highs, pa.int64()), pa.array(lows, pa.int64())],
                names=["__id", "__text", "__pos", "__hi", "__lo"])
            for c in out:
                c.clear()
            return batch

        for batch in slices(batches):
            for doc, digest, text in zip(column(batch, "__id"), column(batch, "__text"),
                                         column(batch, "__body"), strict=True):
                for pos, line in enumerate(text.encode().split(b"\n")):
                    key = line.strip(ASCII_SPACE)
                    if len(key) < min_chars or (not key.isascii() and len(key.decode()) < min_chars):
                        continue
                    h = xxhash.xxh3_128_digest(key.lower())  # bytes.lower() touches A-Z only
                    ids.append(doc)
                    texts.append(digest)
                    positions.append(pos)
                    highs.append(int.from_bytes(h[:8], "big", signed=True))
                    lows.append(int.from_bytes(h[8:], "big", signed=True))
                    if len(ids) >= _FLUSH:
                        yield flush()
        if ids:
            yield flush()

    return explode


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                min_chars: int = 10, min_docs: int = 2) -> DataFrame:
    """Drop lines whose key occurs in ``min_docs`` documents or more.

    A line's key is the line without ASCII white space at both ends and with A-Z
    in lower case; keys under ``min_chars`` code points are never dropped.  The
    document with the smallest id that holds a key keeps all its lines with it.

    Returns the columns of ``docs`` with the text replaced by the kept lines in
    their order, plus ``n_lines`` and ``n_dropped`` (an input column of either
    name is replaced).  Row for row: repeated rows come back repeated, and count
    as one document.  A null or empty text is one empty line and comes back as
    the empty text; a text of which all lines go comes back empty.  Rows with a
    null id are no document that could be named as a holder: they are neither
    counted nor changed.

    Plan: lines are hashed where they are read (128 bits), so two small shuffles
    carry (hash, document) and (hash, document, position) only; a common line is
    counted by partial aggregation, and in the join that marks its lines the
    runtime splits it.  The texts are shuffled once, to meet their positions.
    """
    body = F.coalesce(F.col(text_col), F.lit(""))
    digest = F.xxhash64(body)
    keys = (docs.select(F.col(id_col).cast("long").alias("__id"), digest.alias("__text"), body.alias("__body"))
            .filter("__id is not null")
            .mapInArrow(_line_keys(min_chars),
                        "__id long, __text long, __pos int, __hi long, __lo long"))
    shared = (keys.select("__hi", "__lo", "__id").distinct()
              .groupBy("__hi", "__lo").agg(F.count("*").alias("__n"), F.min("__id").alias("__first"))
              .filter(F.col("__n") >= min_docs).drop("__n"))
    drops = (keys.join(shared, ["__hi", "__lo"]).filter("__id <> __first")
             .groupBy(F.col("__id").alias("__drop_id"), F.col("__text").alias("__drop_text"))
             .agg(F.collect_set("__pos").alias("__drop")))
    # case-insensitive, as Spark resolves names
    rest = [c for c in docs.columns if c.lower() not in {"n_lines", "n_dropped"}]
    own = fresh(docs, "__id", "__text", "__body", "__lines", "__drop")
    own_id, own_text, own_body, lines, drop = own
    drops = drops.select(F.col("__drop_id").alias("__drop_id_" + own_id), F.col("__drop_text").alias("__drop_text_" + own_id),
                         F.col("__drop").alias(drop))
    kept = F.transform(
        F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(drop)), lambda p: F.get(F.col(lines), p))
    base = docs.select(*[F.col(f"`{c}`") for c in rest], F.col(id_col).cast("long").alias(own_id),
                       digest.alias(own_text), body.alias(own_body))
    joined = (base.join(drops, (F.col(own_id) == F.col("__drop_id_" + own_id))
                        & (F.col(own_text) == F.col("__drop_text_" + own_id)), "left")
              .withColumn(lines, F.split(F.col(own_body), "\n", -1)))
    return joined.select(
        *[F.when(F.col(drop).isNull(), F.col(own_body)).otherwise(F.array_join(kept, "\n")).alias(c)
          if c == text_col else F.col(f"`{c}`") for c in rest],
        F.size(lines).cast("long").alias("n_lines"),
        F.coalesce(F.size(drop), F.lit(0)).cast("long").alias("n_dropped"))


def digest(result: DataFrame) -> DataFrame:
    """The contract's columns of a :func:`dedup_lines` result."""
    return result.select(F.col("doc_id").cast(T.LongType()).alias("doc_id"), "n_lines", "n_dropped",
                         F.sha2(F.col("text"), 256).alias("kept_sha256"))


ORACLE = """
with lines as (
  select doc_id, rid, u.pos as pos, u.line as line,
         translate(trim(u.line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as k
  from (select doc_id, rid, unnest(list_transform(l, lambda x, i: {'pos': i, 'line': x})) as u
        from (select doc_id, row_number() over () as rid, string_split(coalesce(text, ''), chr(10)) as l
              from documents))
), shared as (
  select k, min(doc_id) as first_id from lines where length(k) >= 10 and doc_id is not null
  group by k having count(distinct doc_id) >= 2
), marked as (
  select l.*, coalesce(s.first_id <> l.doc_id, false) as gone
  from lines l left join shared s on l.k = s.k
)
select doc_id, count(*) as n_lines, count(*) filter (where gone) as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by pos) filter (where not gone), '')) as kept_sha256
from marked group by doc_id, rid
"""

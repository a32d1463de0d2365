from __future__ import annotations

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark, texts, partitions=3):
    """A documents table: ``texts`` is a list of texts or of (doc_id, text)."""
    rows = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
    rows = [(i, t, "en", "src0", None if t is None else len(t)) for i, t in rows]
    return spark.createDataFrame(rows, DOC_SCHEMA).repartition(partitions)

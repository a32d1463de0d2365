"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator
from uuid import uuid4

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cafetal.session import checkpoint_root

ASCII_SPACE = b" \t\n\x0b\f\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder and read it back.

    Cuts the lineage: a lost executor costs the tasks it ran, not the whole
    history, and what reads the result several times does not compute it again.
    """
    spark = df.sparkSession
    path = f"{checkpoint_root(spark)}/cafetal-llm/{name}-{uuid4().hex[:12]}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def hashed_sample(df: DataFrame, hash_col: str, rows: int, total: int) -> DataFrame:
    """The ``rows`` rows of smallest hash, give or take none if the hash is uniform.

    A threshold on the hash comes first, so what tasks hand over for the final order
    is about ``rows`` in all and does not grow with their number.
    """
    if total > 2 * rows:
        df = df.filter(F.col(hash_col) < int(-(1 << 63) + (1 << 64) * min(1.0, (1.2 * rows + 50) / total)))
    return df.orderBy(hash_col).limit(rows)


def slices(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches into slices, so that few texts are Python objects at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def column(batch: pa.RecordBatch, name: str) -> list:
    return batch.column(batch.schema.get_field_index(name)).to_pylist()


def fresh(df: DataFrame, *names: str) -> tuple[str, ...]:
    """Column names like ``names`` that ``df`` does not use, whatever columns it brings along."""
    used = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in used:
            name = "_" + name
        out.append(name)
    return tuple(out)


def numbered(df: DataFrame, order: list, name: str, label: str) -> DataFrame:
    """Add ``name``: the place of each row, from 0 without gaps, in ``order``; rows stay spread over tasks.

    Rows are sorted by ranges and written; places inside the parts become places in all by
    the counts of the parts before (a row for each part, so that table may be broadcast).
    """
    mid, part, first = fresh(df, "__mid", "__part", "__first")
    ordered = df.repartitionByRange(*order).sortWithinPartitions(*order)
    ordered = materialise(ordered.withColumn(mid, F.monotonically_increasing_id()), label)
    ordered = ordered.withColumn(part, F.shiftright(mid, 33))
    counts = {r[0]: r[1] for r in ordered.groupBy(part).count().collect()}
    before, offsets = 0, []
    for p in sorted(counts):
        offsets.append((p, before - (p << 33)))
        before += counts[p]
    offsets = df.sparkSession.createDataFrame(offsets, f"{part} long, {first} long")
    return (ordered.join(F.broadcast(offsets), part)
            .withColumn(name, F.col(mid) + F.col(first)).drop(mid, part, first))

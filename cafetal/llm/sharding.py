"""Sharding by histogram sort: splitters of near equal bytes, then one exchange."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.window import Window

from cafetal.llm.common import fresh, materialise

_TOP = 1 << 63


class KeySpace:
    """Sort keys (hash of the text, id) as one integer: 64 hash bits, then the id's offset."""

    def __init__(self, low_id: int, high_id: int):
        self.low = low_id
        self.bits = max(1, (high_id - low_id + 1).bit_length())

    @property
    def end(self) -> int:
        return 1 << (64 + self.bits)

    def split(self, key: int) -> tuple[int, int]:
        """(hash, id offset) of a key, the hash signed as Spark has it."""
        return (key >> self.bits) - _TOP, key & ((1 << self.bits) - 1)


def place(hashes: np.ndarray, offsets: np.ndarray, probes: list[tuple[int, int]]) -> np.ndarray:
    """How many of the sorted probes are at or below each (hash, offset)."""
    ph = np.array([p[0] for p in probes], np.int64)
    po = np.array([p[1] for p in probes], np.int64)
    first = np.searchsorted(ph, hashes, "left")
    end = np.searchsorted(ph, hashes, "right")
    at = first.copy()
    tied = np.flatnonzero(first < end)  # rows whose hash is also a probe's: the id decides
    for start in np.unique(first[tied]):
        rows = tied[first[tied] == start]
        at[rows] = start + np.searchsorted(po[start:end[rows[0]]], offsets[rows], "right")
    return at


def _histogram(keys: DataFrame, probes: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Exact bytes and rows below each probe, and in total: one count over all partitions."""
    n = len(probes) + 1

    def count(batches):
        size, rows = np.zeros(n, np.int64), np.zeros(n, np.int64)
        for b in batches:
            h, o, s = (b.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            at = place(h, o, probes)
            np.add.at(size, at, s)
            rows += np.bincount(at, minlength=n)
        full = np.flatnonzero(rows)
        yield pa.RecordBatch.from_arrays([pa.array(full.astype(np.int32)), pa.array(size[full]), pa.array(rows[full])],
                                         names=["b", "s", "n"])

    got = (keys.select("__h", "__o", "__s").mapInArrow(count, "b int, s long, n long")
           .groupBy("b").agg(F.sum("s").alias("s"), F.sum("n").alias("n")).collect())  # at most n rows
    size, rows = np.zeros(n, np.int64), np.zeros(n, np.int64)
    for r in got:
        size[r.b], rows[r.b] = r.s, r.n
    return np.cumsum(size), np.cumsum(rows)


def splitters(keys: DataFrame, space: KeySpace, ranges: int, exact_every: int, tolerance: float,
              fan_out: int = 24) -> tuple[list[tuple[int, int]], np.ndarray]:
    """Boundaries between ``ranges`` key ranges of near equal bytes, and the rows in each range.

    Every round puts ``fan_out`` probes into each open interval and counts exactly.
    A boundary is settled when the bytes below it are within ``tolerance`` of a
    range's share (a tenth of the share for boundaries that are no multiple of
    ``exact_every``), or when at most one distinct key is left in its interval; of
    the interval's two ends the nearer one is then taken.
    """
    total, _ = _histogram(keys, [])
    total = int(total[-1])
    share = total * exact_every / ranges
    lo = {k: (0, 0, 0) for k in range(1, ranges)}  # key, bytes below, rows below
    hi = {k: (space.end, total, None) for k in range(1, ranges)}
    found: dict[int, int] = {}
    while len(found) < ranges - 1:
        probes = sorted({lo[k][0] + (hi[k][0] - lo[k][0]) * i // (fan_out + 1)
                         for k in lo if k not in found for i in range(1, fan_out + 1)} - {0})
        size, rows = _histogram(keys, [space.split(p) for p in probes])
        for k in [k for k in lo if k not in found]:
            goal = total * k / ranges
            at = int(np.searchsorted(size[:-1], goal, "right"))  # probes before it have at most the goal below
            if at and probes[at - 1] > lo[k][0]:
                lo[k] = (probes[at - 1], int(size[at - 1]), int(rows[at - 1]))
            if at < len(probes) and probes[at] < hi[k][0]:
                hi[k] = (probes[at], int(size[at]), int(rows[at]))
            (a, sa, na), (b, sb, nb) = lo[k], hi[k]
            allowed = tolerance * share if k % exact_every == 0 else 0.1 * total / ranges
            nearest = a if goal - sa <= sb - goal else b
            if min(goal - sa, sb - goal) <= allowed or b - a <= 1 or (nb is not None and nb - na <= 1):
                found[k] = min(nearest, space.end - 1)
    order = [space.split(found[k]) for k in sorted(found)]
    return order, np.diff(_histogram(keys, order)[1], prepend=0)


def shard(docs: DataFrame, shards: int = 16, id_col: str = "doc_id", text_col: str = "text",
          tolerance: float = 0.001, rows_per_range: int = 250_000) -> DataFrame:
    """Deal all rows into ``shards`` shards of near equal bytes (law ``bytes``).

    A row's size is the UTF-8 length of its text plus one (null text: one).  Rows
    are sorted by (hash of the text, id), so equal texts stand together; a group of
    copies is divided only where a boundary falls into it, which is what keeps the
    bytes equal when one text holds a third of all rows.

    Returns the columns of ``docs`` plus ``size``, ``text_crc32``, ``law``, ``shard``,
    ``slot`` (gapless from 0 in each shard, in key order) and ``grown_shard`` (null
    under this law); input columns of these names are replaced.  Null ids sort
    below all others; rows equal in text and id can't be told apart and stay in
    one shard.  An empty table gives an empty result; with fewer rows than shards
    some shards are empty.  ``tolerance`` is a share of a shard's bytes; one row is
    the finest unit.

    Plan: probing reads a narrow table of keys; each round sends at most
    (probes + 1) sums to the driver.  Shards are sorted as several key ranges each
    (about ``rows_per_range`` rows), so no task holds a whole shard: the exact row
    counts of the ranges before it give a range its first slot.
    """
    body = F.coalesce(F.col(text_col), F.lit(""))
    h, i, o, r = fresh(docs, "__h", "__i", "__o", "__r")
    added = {"size": F.octet_length(body).cast("long") + 1,
             "text_crc32": F.crc32(F.encode(body, "UTF-8")).cast("long"),
             "law": F.lit("bytes"), h: F.xxhash64(body),
             i: F.coalesce(F.col(id_col).cast("long"), F.lit(None).cast("long"))}
    base = docs.withColumns(added)
    narrow = materialise(base.select(F.col(h).alias("__h"), F.col(i).alias("__i"), F.col("size").alias("__s")), "shard-keys")
    n, low, high = narrow.agg(F.count("*"), F.min("__i"), F.max("__i")).first()
    low, high = (0, 0) if low is None else (low - 1, high)  # the place below the smallest is for null

    def offset(name: str):
        return F.coalesce(F.col(name), F.lit(low)) - F.lit(low)

    space = KeySpace(low, high)
    per_shard = max(1, -(-n // (shards * rows_per_range)))
    if n:
        bounds, counts = splitters(narrow.select("__h", offset("__i").alias("__o"), "__s"), space, shards * per_shard,
                                   per_shard, tolerance)
    else:
        bounds, counts = [(0, 0)] * (shards * per_shard - 1), np.zeros(shards * per_shard, np.int64)
    before = np.cumsum(counts) - counts
    start = (before - before[np.arange(len(counts)) // per_shard * per_shard])

    @pandas_udf("int")
    def key_range(hashes, offsets):
        import pandas as pd

        return pd.Series(place(hashes.to_numpy(), offsets.to_numpy(), bounds).astype(np.int32), index=hashes.index)

    @pandas_udf("long")
    def first_slot(ranges):
        import pandas as pd

        return pd.Series(start[ranges.to_numpy()], index=ranges.index)

    in_range = Window.partitionBy(r).orderBy(h, o)
    placed = (base.withColumn(o, offset(i)).withColumn(r, key_range(h, o))
              .withColumn("slot", F.row_number().over(in_range).cast("long") - 1 + first_slot(r))
              .withColumn("shard", F.floor(F.col(r) / per_shard).cast("int"))
              .withColumn("grown_shard", F.lit(None).cast("int")))
    return placed.drop(h, i, o, r)


def digest(result: DataFrame) -> DataFrame:
    return result.select(F.col("doc_id").cast("long").alias("doc_id"), "size", "text_crc32", "law", "shard", "slot",
                         "grown_shard")

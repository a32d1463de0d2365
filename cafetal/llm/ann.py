"""Approximate nearest neighbours by learned partitions of a neighbour graph."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cafetal.llm.common import hashed_sample, materialise

_BLOCK = 1024  # queries, or rows of a partition, compared at a time


def neighbour_graph(x: np.ndarray, k: int) -> np.ndarray:
    """The k rows of largest inner product with each row, itself left out; in blocks."""
    k = min(k, len(x) - 1)
    out = np.empty((len(x), k), np.int64)
    for s in range(0, len(x), _BLOCK):
        score = x[s:s + _BLOCK] @ x.T
        score[np.arange(len(score)), np.arange(s, s + len(score))] = -np.inf
        out[s:s + _BLOCK] = np.argpartition(-score, k - 1, axis=1)[:, :k] if k else 0
    return out


def partition_graph(near: np.ndarray, x: np.ndarray, parts: int, rounds: int, slack: float, seed: int) -> np.ndarray:
    """Balanced parts of the neighbour graph that cut few edges: label propagation with room for n/parts (1 + slack).

    Starts from balanced slabs (recursive halving at the median along a random
    direction); then nodes move, those that gain most first, to the part that holds
    most of their neighbours and has room.
    """
    n, rng = len(x), np.random.default_rng(seed)
    label = np.zeros(n, np.int64)
    groups = [np.arange(n)]
    while len(groups) < parts:
        groups.sort(key=len)
        g = groups.pop()
        order = g[np.argsort(x[g] @ rng.standard_normal(x.shape[1]), kind="stable")]
        groups += [order[:len(g) // 2], order[len(g) // 2:]]
    for k, g in enumerate(groups):
        label[g] = k
    room = int(np.ceil(n / parts * (1 + slack)))
    reverse_from, reverse_to = np.repeat(np.arange(n), near.shape[1]), near.ravel()
    for _ in range(rounds):
        votes = np.zeros((n, parts), np.float32)
        np.add.at(votes, (reverse_from, label[reverse_to]), 1)
        np.add.at(votes, (reverse_to, label[reverse_from]), 1)
        best = votes.argmax(axis=1)
        gain = votes[np.arange(n), best] - votes[np.arange(n), label]
        size = np.bincount(label, minlength=parts)
        moved = 0
        for i in np.argsort(-gain, kind="stable").tolist():
            if gain[i] <= 0:
                break
            a, b = label[i], best[i]
            if size[b] < room and size[a] > 1:
                label[i] = b
                size[a] -= 1
                size[b] += 1
                moved += 1
        if moved < n // 200:
            break
    return label


@dataclass
class Router:
    """A two-layer classifier that gives the share of a vector's neighbours in each partition."""

    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: np.ndarray
    mass: float = 1.0

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        z = np.maximum(x @ self.w1 + self.b1, 0) @ self.w2 + self.b2
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)

    def route(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, partition) pairs: the most probable partitions that together reach the mass."""
        p = self.probabilities(x)
        order = np.argsort(-p, axis=1, kind="stable")
        total = np.cumsum(np.take_along_axis(p, order, axis=1), axis=1)
        use = np.concatenate([np.ones((len(x), 1), bool), total[:, :-1] < self.mass], axis=1)
        row, rank = np.nonzero(use)
        return row, order[row, rank]


def fit_router(x: np.ndarray, target: np.ndarray, hidden: int, epochs: int, seed: int) -> Router:
    """Adam on the cross-entropy with the share of each row's neighbours per partition."""
    rng = np.random.default_rng(seed)
    d, parts = x.shape[1], target.shape[1]
    ws = [rng.standard_normal((d, hidden)) * np.sqrt(2 / d), np.zeros(hidden),
          rng.standard_normal((hidden, parts)) * np.sqrt(1 / hidden), np.zeros(parts)]
    m, v, step = [np.zeros_like(w) for w in ws], [np.zeros_like(w) for w in ws], 0
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for s in range(0, len(x), 256):
            a, y = x[order[s:s + 256]], target[order[s:s + 256]]
            h = a @ ws[0] + ws[1]
            r = np.maximum(h, 0)
            z = r @ ws[2] + ws[3]
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            dz = (p - y) / len(a)
            dh = (dz @ ws[2].T) * (h > 0)
            step += 1
            for k, g in enumerate((a.T @ dh, dh.sum(axis=0), r.T @ dz, dz.sum(axis=0))):
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.999 * v[k] + 0.001 * g * g
                ws[k] -= 2e-3 * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.999 ** step)) + 1e-8)
    return Router(*ws)


def fit(x: np.ndarray, rows: int, per_part: int, most_parts: int, k: int, recall: float, seed: int = 5) -> Router:
    """Learn partitions and their router on a sample of the vectors of a table with ``rows`` of them.

    Partitions: about rows / ``per_part``, or one for each 64 vectors of the sample if that is more (so tables of a few
    hundred rows have several), at most ``most_parts`` and a sixteenth of the sample.  The mass that a query's partitions must reach is set on a tenth of
    the sample kept from training: the least at which its own neighbours are found
    to the share ``recall``.
    """
    parts = int(max(1, min(most_parts, max(rows // per_part, len(x) // 64), len(x) // 16)))
    if parts == 1:
        d = x.shape[1] if len(x) else 1
        return Router(np.zeros((d, 1)), np.zeros(1), np.zeros((1, 1)), np.zeros(1))
    near = neighbour_graph(x, k)
    label = partition_graph(near, x, parts, 20, 0.05, seed)
    target = np.zeros((len(x), parts))
    np.add.at(target, (np.repeat(np.arange(len(x)), near.shape[1]), label[near.ravel()]), 1 / near.shape[1])
    held = np.arange(len(x)) % 10 == 0
    router = fit_router(x[~held], target[~held], 128, 12, seed)
    # Rows go to the partition the router finds likeliest, so recall is counted against that.
    home = router.probabilities(x).argmax(axis=1)
    p = router.probabilities(x[held])
    order = np.argsort(-p, axis=1, kind="stable")
    before = np.cumsum(np.take_along_axis(p, order, axis=1), axis=1) - np.take_along_axis(p, order, axis=1)
    at = np.empty_like(before)
    np.put_along_axis(at, order, before, axis=1)  # mass spent before a partition is reached
    needed = np.sort(np.take_along_axis(at, home[near[held]], axis=1).ravel())
    router.mass = float(min(1.0, needed[min(len(needed) - 1, int(np.ceil(recall * len(needed))))] + 1e-9))
    return router


def search(vectors: DataFrame, queries: DataFrame | None = None, k: int = 20, recall: float = 0.97,
           sample: int = 8192, per_part: int = 2048, most_parts: int = 512, queries_per_chunk: int = 100_000,
           id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """The ``k`` rows of largest inner product found for each query: ``query_id``, ``rank``, ``vec_id``, ``score``.

    ``queries`` are rows of the same shape (default: rows of ``vectors`` whose id is
    divisible by 20); a row with the query's own id is no candidate.  Scores are in
    double precision on the original vectors, ties go to the smaller id.  Vectors
    that are null, zero, or hold null, NaN or infinite components take no part, nor
    do rows without an id or vectors of another length than the commonest one.
    Repeated rows (same id and vector) count once; one id with several vectors is
    ranked once per vector.  With no usable vector the result is empty.

    The index is fitted on a ``sample`` of distinct vectors (smallest hashes), and
    every row is assigned by the learned router.  Equal vectors are one entry that
    carries its ``k`` + 1 smallest ids, which is all that any answer can use: a
    vector repeated in a third of all rows costs one row, and the same goes for
    equal queries.  Partitions of more entries than ``per_part`` * 2 are split by
    hash, and each query goes to all pieces of a partition: no task holds more, and
    no entry is left out.  Only k + 1 rows per query and piece are merged.  Vectors
    without structure (nothing near anything) need most partitions to reach the
    recall; structured ones few.
    """
    def usable(df):
        return (df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
                .filter(F.col("id").isNotNull() & F.col("v").isNotNull())
                .filter(F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
                        & F.exists("v", lambda c: c != 0)))

    rows = usable(vectors)
    if queries is None:
        own = rows.filter(F.col("id") % 20 == 0)
    else:
        own = usable(queries)
    length = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    if length is None:
        return rows.select(F.col("id").alias("query_id"), F.lit(0).alias("rank"), F.col("id").alias("vec_id"),
                           F.lit(0.0).alias("score")).limit(0)
    size = length.n

    # Only the k + 1 smallest ids of a vector can stand in an answer; the limit works before the shuffle, too.
    few = Window.partitionBy("v").orderBy("id")
    entries = materialise(
        rows.filter(F.size("v") == size).distinct().withColumn("r", F.row_number().over(few)).filter(F.col("r") <= k + 1)
        .groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids")), "ann-entries")
    asked = materialise(own.filter(F.size("v") == size).distinct(), "ann-queries")
    n = entries.count()
    picked = hashed_sample(entries.select("v", F.xxhash64("v").alias("h")), "h", sample, n).collect()  # bounded
    x = np.array([r.v for r in picked], float).reshape(-1, size)
    scale = np.sqrt((x * x).sum(axis=1)).max()  # inner products are compared, so all are scaled alike
    router = fit(x / scale, n, per_part, most_parts, k, recall)
    shared = entries.sparkSession.sparkContext.broadcast((router, scale))

    def home(batches):
        router, scale = shared.value
        for b in batches:
            v = np.array(b.column("v").to_pylist(), float).reshape(-1, size)
            part = router.probabilities(v / scale).argmax(axis=1) if len(v) else np.zeros(0, int)
            yield pa.RecordBatch.from_arrays(
                [pa.array(part.astype(np.int64)), pa.array([r.tobytes() for r in v], pa.binary()), b.column("ids")],
                names=["part", "raw", "ids"])

    placed = materialise(entries.mapInArrow(home, "part long, raw binary, ids array<long>"), "ann-placed")
    counts = {r.part: r["count"] for r in placed.groupBy("part").count().collect()}  # at most most_parts rows
    pieces = np.ones(max([*counts, 0]) + 1, np.int64)
    for p, c in counts.items():
        pieces[p] = -(-c // (2 * per_part))
    first = np.cumsum(pieces) - pieces
    piece_at = F.array(*[F.lit(int(a)) for a in first])
    piece_of = F.array(*[F.lit(int(a)) for a in pieces])
    base = placed.select((F.get(piece_at, F.col("part").cast("int"))
                          + F.pmod(F.xxhash64("raw"), F.get(piece_of, F.col("part").cast("int")))).alias("piece"),
                         F.lit(None).cast("long").alias("q"), "raw", "ids")

    def route(batches):
        router, scale = shared.value
        for b in batches:
            v = np.array(b.column("v").to_pylist(), float).reshape(-1, size)
            for s in range(0, len(v), _BLOCK):
                row, part = router.route(v[s:s + _BLOCK] / scale)
                known = part < len(pieces)
                row, part = row[known], part[known]
                many = pieces[part]
                row, start = np.repeat(row, many), np.repeat(first[part], many)
                step = np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
                raw = [v[s + i].tobytes() for i in row.tolist()]
                ids = b.column("q").take(pa.array(s + row))
                yield pa.RecordBatch.from_arrays([pa.array(start + step), ids, pa.array(raw, pa.binary())],
                                                 names=["piece", "q", "raw"])

    # Equal queries are asked once, under their smallest id.  Very many queries go in chunks, each with all entries.
    groups = asked.groupBy("v").agg(F.min("id").alias("q"))
    chunks = max(1, -(-groups.count() // queries_per_chunk))
    base = base.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1)))) if chunks > 1 else (
        base.withColumn("chunk", F.lit(0)))
    sent = (groups.mapInArrow(route, "piece long, q long, raw binary")
            .withColumn("chunk", F.pmod(F.xxhash64("q"), F.lit(chunks)).cast("int"))
            .withColumn("ids", F.lit(None).cast("array<long>")))

    def rerank(base: pd.DataFrame, ask: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(base) and len(ask):
            v = np.frombuffer(b"".join(base["raw"]), "<f8").reshape(-1, size)
            low = np.array([i[0] for i in base["ids"]], np.int64)
            order = np.argsort(low, kind="stable")  # ties go to the smaller id
            v, ids = v[order], base["ids"].to_numpy()[order]
            for s in range(0, len(ask), _BLOCK):
                q = np.frombuffer(b"".join(ask["raw"].iloc[s:s + _BLOCK]), "<f8").reshape(-1, size)
                score = q @ v.T
                best = np.argsort(-score, axis=1, kind="stable")[:, :k + 1]
                for j, qid in enumerate(ask["q"].iloc[s:s + _BLOCK].tolist()):
                    hits = [(-float(score[j, e]), int(i)) for e in best[j] for i in ids[e]]
                    hits = sorted(hits)[:k + 1]
                    out.append((qid, [h for h, _ in hits], [i for _, i in hits]))
        return pd.DataFrame(out, columns=["q", "less", "hits"])

    # k + 1 rows a query and piece: one of them may be the asking row itself, and no member of a group needs more.
    found = (base.groupBy("piece", "chunk").cogroup(sent.groupBy("piece", "chunk"))
             .applyInPandas(rerank, "q long, less array<double>, hits array<long>"))
    merged = F.slice(F.array_sort(F.flatten(F.collect_list(F.arrays_zip("less", "hits")))), 1, k + 1)
    top = found.groupBy("q").agg(merged.alias("top"))
    members = asked.join(groups.withColumnRenamed("v", "gv"), F.col("v") == F.col("gv")).select(
        F.col("id").alias("query_id"), "q")
    others = F.slice(F.filter("top", lambda t: t["hits"] != F.col("query_id")), 1, k)
    return (top.join(members, "q").select("query_id", F.posexplode(others).alias("at", "t"))
            .select("query_id", (F.col("at") + 1).alias("rank"), F.col("t.hits").alias("vec_id"),
                    (-F.col("t.less")).alias("score")))

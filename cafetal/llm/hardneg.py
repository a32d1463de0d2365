"""Hard-negative mining by angular triangle filtering.

Every row keeps its angles to a few reference directions.  For an anchor ``a`` and a row ``x``
the triangle inequality on the sphere puts their angle between ``max |t(a) - t(x)|`` and
``min (t(a) + t(x))`` over the references, which makes an interval of the cosine and, times both norms,
bounds of the score; they are widened for rounding, so no score lies outside.  Only rows whose bounds
overlap the wanted window of scores are scored, in integers.

Rows lie in cells, by their nearest reference, and cells in pieces of bounded size; the bounds are first
taken for whole cells, then, as a stretch of rows sorted by angle, inside a piece, then row by row.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cafetal.llm.common import column, hashed_sample, materialise, slices

SAMPLE = 4096  # rows that references are chosen from, and that give first bounds; nothing is decided by them alone
REFERENCES = 8  # angles stored beside the one to the own cell
CELLS, CELL_ROWS, PIECE_ROWS, ANCHORS = 256, 4096, 8192, 2048
_SLACK = 1e-6  # radians by which intervals of angles are widened
_NO_ID = np.iinfo(np.int64).max


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer inner products of the rows of ``a`` and ``b`` (whole numbers as float64 if they are exact)."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)))
    most = float(np.abs(a.astype(float)).max()) * float(np.abs(b.astype(float)).max()) * a.shape[1]
    if most < 2 ** 53:
        return a.astype(np.float64) @ b.astype(np.float64).T
    return a.astype(object) @ b.astype(object).T


def pack(q: np.ndarray) -> list[bytes]:
    kind = "<i4" if not q.size or np.abs(q.astype(float)).max() < 2 ** 31 else "<i8"
    return [r.tobytes() for r in q.astype(kind)]


def unpack(cells: list[bytes], dim: int) -> np.ndarray:
    if dim and len({len(c) for c in cells}) == 1:
        return np.frombuffer(b"".join(cells), f"<i{len(cells[0]) // dim}").reshape(-1, dim).astype(np.int64)
    return np.array([np.frombuffer(c, f"<i{len(c) // dim}").astype(np.int64) if dim else [] for c in cells],
                    np.int64).reshape(len(cells), dim)


def units(q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Norms, and directions (zero for zero vectors, whose scores are zero by their norm)."""
    x = q.astype(np.float64)
    norm = np.sqrt((x * x).sum(axis=1))
    return norm, x / np.where(norm, norm, 1)[:, None]


def angles(unit: np.ndarray, refs: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(unit @ refs.T, -1, 1))


def bounds(least: np.ndarray, most: np.ndarray, low_norm, high_norm) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of the score from an interval of the angle and one of the product of norms, safe against rounding."""
    top = np.cos(np.clip(least - _SLACK, 0, np.pi))
    bottom = np.cos(np.clip(most + _SLACK, 0, np.pi))
    high = np.where(top > 0, top * high_norm, top * low_norm)
    low = np.where(bottom > 0, bottom * low_norm, bottom * high_norm)
    return low - 1e-6 - 1e-9 * high_norm, high + 1e-6 + 1e-9 * high_norm


@dataclass
class Model:
    """Reference directions for vectors of the commonest length; the first ``cells`` of them are centres of cells."""

    dim: int
    refs: np.ndarray
    cells: int
    sample_q: np.ndarray
    sample_label: np.ndarray
    sample_id: np.ndarray

    def near(self) -> np.ndarray:
        return self.refs[:REFERENCES]


def farthest_first(unit: np.ndarray, n: int) -> np.ndarray:
    """Directions far from each other: each next one is the row farthest from those chosen."""
    chosen, closest = [0], unit @ unit[0]
    while len(chosen) < min(n, len(unit)):
        k = int(closest.argmin())
        if closest[k] > 1 - 1e-9:
            break
        chosen.append(k)
        closest = np.maximum(closest, unit @ unit[k])
    return unit[chosen]


def fit(rows: DataFrame) -> Model | None:
    """Choose the references from a bounded sample; None for an empty table."""
    total = rows.count()
    mixed = rows.withColumn("__h", F.xxhash64("id", "label", "q"))
    found = hashed_sample(mixed, "__h", SAMPLE, total).select("id", "noid", "label", "q").collect()
    if not found:
        return None
    dim = Counter(len(r.q) for r in found).most_common(1)[0][0]
    found = [r for r in found if len(r.q) == dim]
    q = np.array([r.q for r in found], np.int64).reshape(len(found), dim)
    norm, unit = units(q)
    cells = max(1, min(CELLS, total // CELL_ROWS))
    refs = farthest_first(unit[norm > 0], max(cells, REFERENCES)) if (norm > 0).any() else np.zeros((1, dim))
    return Model(dim, refs, min(cells, len(refs)), q, np.array([r.label for r in found], np.int64),
                 np.array([_NO_ID if r.noid else r.id for r in found], np.int64))


_ROWS = "rid long, id long, noid boolean, label long, dim int, q binary, norm double, turn double, angles binary, cell int"


def _placed(model):
    """Angles, norm and cell of each row."""
    def run(batches):
        m = model.value
        for b in slices(batches, 2048):
            q = b.column(b.schema.get_field_index("q"))
            dims = np.diff(q.offsets.to_numpy())
            flat = q.flatten().to_numpy(zero_copy_only=False)
            n = b.num_rows
            norm, turn, cell = np.zeros(n), np.zeros(n), np.zeros(n, np.int32)
            packed, stored = [None] * n, [b""] * n
            start = np.concatenate([[0], np.cumsum(dims)])
            for dim in np.unique(dims).tolist():
                at = np.flatnonzero(dims == dim)
                x = np.stack([flat[start[i]:start[i] + dim] for i in at.tolist()])
                norm[at], unit = units(x)
                if dim == m.dim:
                    centre = angles(unit, m.refs[:m.cells])
                    cell[at] = centre.argmin(axis=1)
                    turn[at] = centre.min(axis=1)
                    near = angles(unit, m.near())
                else:
                    cell[at] = m.cells + dim % 64  # other lengths: no reference, only the norms bound the score
                    near = np.zeros((len(at), 0))
                for i, v, t in zip(at.tolist(), pack(x), near, strict=True):
                    packed[i], stored[i] = v, t.tobytes()
            keep = [b.column(b.schema.get_field_index(c)) for c in ("rid", "id", "noid", "label")]
            yield pa.RecordBatch.from_arrays(
                [*keep, pa.array(dims.astype(np.int32)), pa.array(packed, pa.binary()), pa.array(norm), pa.array(turn),
                 pa.array(stored, pa.binary()), pa.array(cell)],
                names=["rid", "id", "noid", "label", "dim", "q", "norm", "turn", "angles", "cell"])
    return run


def _kth(values: np.ndarray, k: int) -> float:
    return -np.inf if len(values) < k else float(np.partition(values.astype(float), len(values) - k)[len(values) - k])


_ANCHOR = "rid long, id long, label long, dim int, q binary, norm double, angles binary"
_WINDOWS = "rank array<int>, positive_id array<long>, positive_score array<long>, low array<double>, high array<double>"
_LISTS = ("rank", "positive_id", "positive_score", "low", "high")


def _routed(model, cells: dict, k: int, negatives: bool, ratio: tuple[int, int]):
    """Send each anchor to all cells whose bounds overlap one of its windows.

    The k-th best score within the sample is a lower bound of the k-th best of all, which raises the windows' lower ends.
    """
    def run(batches):
        m = model.value
        near, far, small, big, key = (np.array(x) for x in zip(*((*c[1:5], i) for i, c in cells.items()), strict=True))
        for b in slices(batches, 256):
            rows = {c: column(b, c) for c in ("rid", "id", "label", "dim", "q", "norm", "angles")}
            found = {c: column(b, c) for c in _LISTS[:3]} if negatives else None
            out = {c: [] for c in ("cell", *rows, *_LISTS)}
            same = [i for i, d in enumerate(rows["dim"]) if d == m.dim]
            of_sample = np.zeros((0, 0))
            if same:
                q = unpack([rows["q"][i] for i in same], m.dim)
                of_sample = scores(q, m.sample_q)
                centres = angles(units(q)[1], m.refs[:m.cells])
            for i in range(b.num_rows):
                j = same.index(i) if rows["dim"][i] == m.dim else None
                if negatives:
                    rank, pid, high = (found[c][i] for c in _LISTS[:3])
                    low = [-(-ratio[0] * s // ratio[1]) for s in high]
                    use = [w for w in range(len(rank)) if low[w] <= high[w]]
                    rank, pid, high, low = ([x[w] for w in use] for x in (rank, pid, high, low))
                    score, high = high, [float(h) for h in high]
                    if j is not None:
                        s = of_sample[j][m.sample_label != rows["label"][i]]
                        low = [max(float(lo), _kth(s[(s >= lo) & (s <= hi)], k)) for lo, hi in zip(low, high, strict=True)]
                    low = [float(x) for x in low]
                else:
                    rank, pid, score, high, low = [0], [0], [0], [np.inf], [-np.inf]
                    if j is not None:
                        s = of_sample[j][(m.sample_label == rows["label"][i]) & (m.sample_id != rows["id"][i])]
                        low = [_kth(s, k)]
                if not rank:
                    continue
                if j is None:
                    to = np.flatnonzero(key == m.cells + rows["dim"][i] % 64)
                else:
                    t = np.append(centres[j], 0.0)[np.minimum(key, m.cells)]
                    least = np.maximum(0, np.maximum(near - t, t - far))
                    bottom, top = bounds(least, np.minimum(np.pi, t + far), rows["norm"][i] * small, rows["norm"][i] * big)
                    to = np.flatnonzero((key < m.cells) & (top >= min(low)) & (bottom <= max(high)))
                for c in to.tolist():
                    for name, v in (("cell", int(key[c])), *((n, rows[n][i]) for n in rows),
                                    *zip(_LISTS, (rank, pid, score, low, high), strict=True)):
                        out[name].append(v)
            kinds = {"cell": pa.int32(), "dim": pa.int32(), "q": pa.binary(),
                     "norm": pa.float64(), "angles": pa.binary(), "rank": pa.list_(pa.int32()),
                     "low": pa.list_(pa.float64()), "high": pa.list_(pa.float64()), "positive_id": pa.list_(pa.int64()),
                     "positive_score": pa.list_(pa.int64())}
            yield pa.RecordBatch.from_arrays([pa.array(v, kinds.get(n, pa.int64())) for n, v in out.items()], names=list(out))
    return run


_FOUND = ["rid", "anchor_id", "rank", "positive_id", "positive_score", "id", "noid", "score"]
_FOUND_SCHEMA = ("rid long, anchor_id long, rank int, positive_id long, positive_score long, id long, noid boolean, score long")


def _probe(model, k: int, negatives: bool):
    """Score the rows of a piece that the angles leave to an anchor, and keep the best k of each window."""
    def run(rows: pd.DataFrame, anchors: pd.DataFrame) -> pd.DataFrame:
        m, out = model.value, []
        for dim, xs in rows.groupby("dim"):
            mine = anchors[anchors["dim"] == dim]
            if not len(mine):
                continue
            xs = xs.sort_values("turn", kind="stable")
            turn, norm, label, ids, noid = (xs[c].to_numpy() for c in ("turn", "norm", "label", "id", "noid"))
            x = unpack(xs["q"].tolist(), dim)
            near = np.frombuffer(b"".join(xs["angles"]), np.float64).reshape(len(xs), -1) if dim == m.dim else None
            q = unpack(mine["q"].tolist(), dim)
            centre = angles(units(q)[1], m.refs[xs["cell"].iloc[0]][None, :])[:, 0] if dim == m.dim else None
            biggest = norm.max()
            for i, a in enumerate(mine.itertuples(index=False)):
                low, high = min(a.low), max(a.high)
                s, e = 0, len(xs)
                if centre is not None and low > 0:
                    # score >= low > 0 means an angle of arccos(low / norms) at most: a stretch of the sorted rows
                    room = a.norm * biggest * (1 + 1e-9)
                    if room < low:
                        continue
                    wide = np.arccos(min(1.0, low / room)) + _SLACK
                    s, e = np.searchsorted(turn, centre[i] - wide, "left"), np.searchsorted(turn, centre[i] + wide, "right")
                if s >= e:
                    continue
                fits = (label[s:e] != a.label) if negatives else (label[s:e] == a.label) & (noid[s:e] | (ids[s:e] != a.id))
                at = s + np.flatnonzero(fits)
                if near is not None:
                    t = np.frombuffer(a.angles, np.float64)
                    most = np.minimum(np.pi, (near[at] + t).min(axis=1))
                    bottom, top = bounds(np.abs(near[at] - t).max(axis=1), most, a.norm * norm[at], a.norm * norm[at])
                else:
                    top = a.norm * norm[at] * (1 + 1e-9) + 1e-6
                    bottom = -top
                at = at[(top >= low) & (bottom <= high)]
                if not len(at):
                    continue
                got = scores(q[i:i + 1], x[at])[0]
                for w, lo, hi, pid, ps in zip(a.rank, a.low, a.high, a.positive_id, a.positive_score, strict=True):
                    inside = np.flatnonzero((got >= lo) & (got <= hi))
                    if len(inside) > k:
                        best = _kth(got[inside], k)
                        inside = inside[got[inside].astype(float) >= best]
                    order = sorted(inside.tolist(), key=lambda r: (-got[r], noid[at[r]], ids[at[r]]))[:k]
                    out += [(a.rid, a.id, w, pid, ps, ids[at[r]], bool(noid[at[r]]),
                             max(-2 ** 63, min(2 ** 63 - 1, int(got[r])))) for r in order]
        return pd.DataFrame(out, columns=_FOUND)
    return run


def _best(found: DataFrame, k: int) -> DataFrame:
    """The first ``k`` of each anchor and window, from the best of each piece."""
    order = Window.partitionBy("rid", "rank").orderBy(F.col("score").desc(), "noid", "id")
    return found.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k)


def mine(rows: DataFrame, anchors: Column, positives: int = 5, negatives: int = 5, ratio: tuple[int, int] = (80, 100)) -> DataFrame:
    """Hard negatives of the rows that ``anchors`` picks: ``anchor_id``, ``positive_id``, ``rank``, ``negative_id`` and both scores.

    ``rows`` has ``vec_id``, ``label`` (not null) and ``q``, an array of long.  Scores are integer inner products, those of
    rows of another length do not exist; higher ones come first, ties by smaller ``vec_id`` (null ids last).  A positive is one of
    the first ``positives`` rows of the anchor's label with another ``vec_id``; its negatives are the first ``negatives`` rows of other
    labels whose score is at most the positive's and at least ``ratio`` of it.  A repeated row is a row of its own, as anchor,
    positive and negative.  Anchors without other rows of their label have no rows here; an empty table gives none.
    Scores beyond a long are cut to its ends.
    """
    spark = rows.sparkSession
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    base = materialise(rows.select(F.monotonically_increasing_id().alias("rid"), anchors.alias("anchor"),
                                   F.coalesce("vec_id", F.lit(_NO_ID)).cast("long").alias("id"),
                                   F.col("vec_id").isNull().alias("noid"), F.col("label").cast("long").alias("label"), "q"),
                       "hardneg-rows")
    model = fit(base)
    if model is None:
        return spark.createDataFrame([], schema)
    sent = spark.sparkContext.broadcast(model)  # at most SAMPLE vectors and CELLS references
    placed = materialise(base.mapInArrow(_placed(sent), _ROWS), "hardneg-placed")
    # a row for each cell: at most CELLS + 64
    cells = {r.cell: (r.cell, r.near, r.far, r.small, r.big, -(-r.n // PIECE_ROWS)) for r in
             placed.groupBy("cell").agg(F.min("turn").alias("near"), F.max("turn").alias("far"), F.min("norm").alias("small"),
                                        F.max("norm").alias("big"), F.count(F.lit(1)).alias("n")).collect()}
    chosen = placed.join(base.filter("anchor").select("rid"), "rid", "left_semi").select(*_ANCHOR.replace(",", "").split()[::2])
    group = ["cell", "piece", "part"]

    def by_cell(numbers: dict[int, int]) -> Column:
        return F.create_map(*(F.lit(x) for c in numbers.items() for x in c))[F.col("cell")]

    def search(windows: DataFrame, k: int, negative: bool) -> DataFrame:
        to_cells = materialise(windows.mapInArrow(_routed(sent, cells, k, negative, ratio), f"cell int, {_ANCHOR}, {_WINDOWS}"),
                               "hardneg-routed")
        # a row for each cell that an anchor may find something in; the rows of others stay where they are
        parts = {r.cell: -(-r["count"] // ANCHORS) for r in to_cells.groupBy("cell").count().collect()}
        if not parts:
            return spark.createDataFrame([], f"{_FOUND_SCHEMA}, place int")
        pieces = by_cell({c: cells[c][-1] for c in parts})
        asking = (to_cells.withColumn("part", F.pmod("rid", by_cell(parts)).cast("int"))
                  .withColumn("piece", F.explode(F.sequence(F.lit(0), pieces - 1))))
        asked = (placed.filter(F.col("cell").isin(*parts)).withColumn("piece", F.pmod(F.xxhash64("rid"), pieces).cast("int"))
                 .withColumn("part", F.explode(F.sequence(F.lit(0), by_cell(parts) - 1))))
        found = asked.groupBy(*group).cogroup(asking.groupBy(*group)).applyInPandas(_probe(sent, k, negative), _FOUND_SCHEMA)
        return _best(found, k)

    near = search(chosen, positives, False)
    near = (near.groupBy("rid").agg(F.sort_array(F.collect_list(F.struct(F.col("place").alias("rank"), F.col("id"), "score", "noid")))
                                    .alias("p")))
    windows = chosen.join(near, "rid").select(
        *chosen.columns, F.col("p.rank").alias("rank"), F.col("p.id").alias("positive_id"), F.col("p.score").alias("positive_score"))
    out = search(materialise(windows, "hardneg-windows"), negatives, True)
    known = lambda c: F.when(F.col(c) != _NO_ID, F.col(c))
    return out.select("anchor_id", known("positive_id").alias("positive_id"), F.col("place").cast("int").alias("rank"),
                      known("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def quantised(embeddings: DataFrame, scale: int = 256) -> DataFrame:
    """``vec_id``, ``label`` and ``q``, the vector as floor(scale * x); rows without label, or with a null or
    non-finite component (or no vector), are left out."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) != float("inf")))
    return (embeddings.filter(F.col("label").isNotNull() & F.col("embedding").isNotNull() & finite)
            .select("vec_id", F.col("label").cast("long").alias("label"),
                    F.transform("embedding", lambda x: F.floor(x.cast("double") * scale).cast("long")).alias("q")))


def hard_negatives(embeddings: DataFrame) -> DataFrame:
    """Hard negatives of every hundredth vector, after the labels of every seventh have been moved on by one."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(quantised(embeddings).withColumn("label", moved), F.coalesce(F.col("vec_id") % 100 == 0, F.lit(False)))


ORACLE = """
WITH rows AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, a.label AS anchor_label, c.vec_id, c.label,
         CAST(list_inner_product(a.q, c.q) AS BIGINT) AS score
  FROM rows a, rows c WHERE a.vec_id % 100 = 0 AND c.vec_id <> a.vec_id
), positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE label = anchor_label
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, p.positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank,
       s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND s.label <> s.anchor_label
  AND 80 * p.positive_score <= 100 * s.score AND s.score <= p.positive_score
QUALIFY rank <= 5
"""

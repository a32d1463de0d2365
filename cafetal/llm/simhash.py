"""SimHash near-dedup: a self-join of the fingerprints' binary trie."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cafetal.llm.common import column, fresh, materialise, slices

_HELD = 1 << 18  # fingerprints of whole subtries that a task joins at a time
_CHUNK = 1 << 15  # node pairs held at a time
_BRUTE = 128  # fingerprint pairs up to which a node pair is compared outright


def fingerprint(text: str | None, shingle: int) -> int:
    """The 64-bit SimHash of a text, as an unsigned integer; 0 for a text without words."""
    words = (text or "").encode().lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), 42)
    digest = xxhash.xxh64_intdigest
    votes, n = np.zeros(64, np.int64), len(words) - shingle + 1
    for start in range(0, n, 20_000):
        part = words[start:start + 20_000 + shingle - 1]
        grams = zip(*(part[k:] for k in range(shingle)), strict=False)
        hashes = np.array([digest(g, 42) for g in map(b" ".join, grams)], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        votes += bits.sum(axis=0, dtype=np.int64)
    return int(((votes * 2 > n).astype(np.uint64) << np.arange(64, dtype=np.uint64)).sum())


def _fingerprints(shingle: int):
    def run(batches):
        for b in slices(batches):
            fp = np.array([fingerprint(t, shingle) for t in column(b, "__body")], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fp.view(np.int64))],
                                             names=["__id", "__text", "__fp"])

    return run


def join_tries(a: np.ndarray, b: np.ndarray | None, bits: int, top: int = 0):
    """Yield index pairs (i, j) of values at most ``bits`` apart; ``a``, ``b`` sorted, unique, unsigned.

    With ``b`` None, ``a`` is joined with itself and each pair comes once; with ``top``, only pairs that agree in
    their first ``top`` bits, as the join starts at the nodes of that depth.  A trie
    node is a range of the sorted array.  Node pairs go down together, bit by bit;
    those whose paths already differ in more than ``bits`` bits are pruned, and
    small ones are compared outright.
    """
    alone = b is None
    b = a if alone else b
    if not len(a) or not len(b):
        return
    one = np.uint64(1)
    # columns: a from, a to, b from, b to, differing bits, next bit
    stack = [np.array([[0, len(a), 0, len(b), 0, 63]], np.int64)]
    if top:
        cut = np.flatnonzero(np.append(True, (a[1:] ^ a[:-1]) >> np.uint64(64 - top) != 0))
        end = np.append(cut[1:], len(a))
        cut, end = cut[end - cut > 1], end[end - cut > 1]
        roots = np.stack([cut, end, cut, end, np.zeros_like(cut), np.full_like(cut, 63 - top)], axis=1)
        stack = [roots[k:k + _CHUNK] for k in range(0, len(roots), _CHUNK)]
    while stack:
        nodes = stack.pop()
        if len(nodes) > _CHUNK:
            stack += [nodes[_CHUNK:], nodes[:_CHUNK]]
            continue
        rows, cols = nodes[:, 1] - nodes[:, 0], nodes[:, 3] - nodes[:, 2]
        small = (rows * cols <= _BRUTE) | (nodes[:, 5] < 0)
        if small.any():
            leaf = nodes[small]
            n, m = rows[small], cols[small]
            which = np.repeat(np.arange(len(leaf)), n * m)
            k = np.arange(len(which)) - np.repeat(np.cumsum(n * m) - n * m, n * m)
            i, j = leaf[which, 0] + k // m[which], leaf[which, 2] + k % m[which]
            near = np.bitwise_count(a[i] ^ b[j]) <= bits
            if alone:
                near &= i < j
            if near.any():
                yield i[near], j[near]
            nodes = nodes[~small]
        if not len(nodes):
            continue
        bit = nodes[:, 5].astype(np.uint64)
        mask = ~(((one << bit) << one) - one)  # 1 << 64 is 0 here, as wanted for the top bit
        cut_a = np.searchsorted(a, (a[nodes[:, 0]] & mask) | (one << bit))
        cut_b = np.searchsorted(b, (b[nodes[:, 2]] & mask) | (one << bit))
        zero_a, one_a = (nodes[:, 0], cut_a), (cut_a, nodes[:, 1])
        zero_b, one_b = (nodes[:, 2], cut_b), (cut_b, nodes[:, 3])
        same = nodes[:, 0] == nodes[:, 2] if alone else np.zeros(len(nodes), bool)
        kids = []
        for x, y, cost, keep in ((zero_a, zero_b, 0, None), (one_a, one_b, 0, None), (zero_a, one_b, 1, None),
                                 (one_a, zero_b, 1, ~same)):
            ok = (x[0] < x[1]) & (y[0] < y[1]) & (nodes[:, 4] + cost <= bits)
            ok = ok if keep is None else ok & keep
            kids.append(np.stack([x[0], x[1], y[0], y[1], nodes[:, 4] + cost, nodes[:, 5] - 1], axis=1)[ok])
        kids = np.concatenate(kids)
        if len(kids):
            stack.append(kids)


def _forest(values: np.ndarray, pairs) -> tuple[np.ndarray, np.ndarray]:
    """A star for each group of linked values: (value, the group's smallest), without the smallest itself."""
    label = np.arange(len(values))
    for i, j in pairs:
        while True:
            x, y = label[i], label[j]
            apart = x != y
            if not apart.any():
                break
            np.minimum.at(label, np.maximum(x, y)[apart], np.minimum(x, y)[apart])
            while (label[label] != label).any():
                label = label[label]
    child = np.flatnonzero(label != np.arange(len(values)))
    return values[child], values[label[child]]


class Tries:
    """Tries of fingerprints turned so that one of ``bits`` + 1 blocks of bits comes first.

    Two fingerprints at most ``bits`` apart agree in one block at least, so they meet below one node in the trie that
    has this block on top.  A subtrie that is crowded is split the same way once more: what is below its root is
    turned so that one of ``bits`` + 1 blocks of the rest comes next, and pairs meet deeper down.
    """

    def __init__(self, bits: int):
        self.blocks = bits + 1
        self.wide = 64 // self.blocks
        self.rest = 64 - self.wide
        self.deep = self.rest // self.blocks

    def number(self, first: int, second: int | None = None) -> int:
        return first if second is None else self.blocks * (first + 1) + second

    def depth(self, trie: int) -> int:
        return self.wide if trie < self.blocks else self.wide + self.deep

    def turned(self, fp: np.ndarray, trie: int) -> np.ndarray:
        """The fingerprints (unsigned) with their bits in the order of a trie."""
        first, second = (trie, None) if trie < self.blocks else (trie // self.blocks - 1, trie % self.blocks)
        out = _rotated(fp, first * self.wide)
        if second:
            shift, rest = np.uint64(second * self.deep), np.uint64(self.rest)
            mask = np.uint64((1 << self.rest) - 1)
            low = out & mask
            out = (out & ~mask) | ((low << shift | low >> (rest - shift)) & mask)
        return out

    def restored(self, turned: np.ndarray, trie: int) -> np.ndarray:
        first, second = (trie, None) if trie < self.blocks else (trie // self.blocks - 1, trie % self.blocks)
        if second:
            shift, rest = np.uint64(second * self.deep), np.uint64(self.rest)
            mask = np.uint64((1 << self.rest) - 1)
            low = turned & mask
            turned = (turned & ~mask) | ((low >> shift | low << (rest - shift)) & mask)
        return _rotated(turned, (64 - first * self.wide) % 64)


def _rotated(x: np.ndarray, by: int) -> np.ndarray:
    return x if not by else x << np.uint64(by) | x >> np.uint64(64 - by)


def _turned_column(fp: Column, tries: Tries, first: int, second: int | None = None) -> Column:
    """The same turn as a column expression."""
    def rotated(x, by, wide):
        mask = F.lit(-1 if wide == 64 else (1 << wide) - 1)
        return x if not by else F.shiftleft(x, by).bitwiseOR(F.shiftrightunsigned(x.bitwiseAND(mask), wide - by)).bitwiseAND(mask)

    out = rotated(fp, first * tries.wide, 64)
    if second:
        above = F.shiftleft(F.shiftrightunsigned(out, tries.rest), tries.rest)
        out = above.bitwiseOR(rotated(out.bitwiseAND(F.lit((1 << tries.rest) - 1)), second * tries.deep, tries.rest))
    return out


def _keyed(fp: Column, tries: Tries, first: int, second: int | None = None) -> Column:
    """A fingerprint's row for one trie: (trie, node at the depth where the join starts, fingerprint)."""
    trie = tries.number(first, second)
    node = F.shiftrightunsigned(_turned_column(fp, tries, first, second), 64 - tries.depth(trie))
    return F.struct(F.lit(trie).alias("trie"), node.alias("node"), fp.alias("fp"))


def _joined(tries: Tries, bits: int):
    """Star edges of whole subtries, which come one after the other."""
    def star(trie, node, fp):
        for t in np.unique(trie).tolist():
            a = np.sort(tries.turned(fp[trie == t], t))
            child, root = _forest(a, join_tries(a, None, bits, tries.depth(t)))
            if len(child):
                u, v = tries.restored(child, t), tries.restored(root, t)
                yield pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], names=["u", "v"])

    def run(batches):
        held: list[tuple] = []
        size = 0
        for b in batches:
            held.append((b.column(0).to_numpy(), b.column(1).to_numpy(), b.column(2).to_numpy().view(np.uint64)))
            size += b.num_rows
            if size >= _HELD:
                cols = [np.concatenate(c) for c in zip(*held, strict=True)]
                open_ = (cols[0] == cols[0][-1]) & (cols[1] == cols[1][-1])  # the last subtrie may go on
                yield from star(*(c[~open_] for c in cols))
                held = [tuple(c[open_] for c in cols)]
                size = int(open_.sum())
        if held:
            yield from star(*(np.concatenate(c) for c in zip(*held, strict=True)))
    return run


def link(values: DataFrame, bits: int, most: int = 1 << 17) -> DataFrame:
    """Star edges (``u``, ``v``) that join all fingerprints reachable by steps of at most ``bits`` bits.

    ``values`` has distinct fingerprints in ``__fp``.  Each is copied to ``bits`` + 1 tries (three for two bits), which
    start at the nodes that one block of bits leads to; subtries of more than ``most`` fingerprints start deeper, at
    ``bits`` + 1 times as many.  Subtries are dealt out by their roots and sorted; a task takes whole ones as they come,
    joins each with itself and returns a spanning star of each group it finds, at most one
    edge a fingerprint and trie, never all pairs of a group.  Nothing comes to the driver but counts.
    """
    tries = Tries(bits)
    fp, some = F.col("__fp"), range(tries.blocks)
    first = values.select(F.inline(F.array(*(_keyed(fp, tries, i) for i in some))))
    crowded = (first.groupBy("trie", "node").count().filter(F.col("count") > most)
               .select("trie", "node", F.lit(True).alias("crowded")))
    marked = first.join(crowded, ["trie", "node"], "left")
    below = [F.array(*(_keyed(F.col("fp"), tries, i, j) for j in some)) for i in some]
    deeper = marked.filter("crowded").select(F.inline(F.get(F.array(*below), F.col("trie"))))
    every = marked.filter("crowded IS NULL").select("trie", "node", "fp").unionByName(deeper)
    return (every.repartition(F.col("trie"), F.col("node")).sortWithinPartitions("trie", "node")
            .mapInArrow(_joined(tries, bits), "u long, v long"))


def components(edges: DataFrame) -> DataFrame:
    """(``node``, ``root``) for every node of the edges ``u``, ``v``; the root is the group's smallest node.

    Rounds of large-star and small-star: each node's neighbours are tied to the
    smallest node seen, until the edges are stars and stay as they are.
    """
    edges = materialise(edges.selectExpr("greatest(u, v) as u", "least(u, v) as v").distinct(), "cc-edges")
    before = None
    while True:
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u").select(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v"))
                 .union(least.select("u", F.col("m").alias("v"))).filter("u <> v").distinct())
        edges = materialise(small, "cc-edges")
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())
        if now == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = now


def _clusters(docs: DataFrame, id_col: str, text_col: str, shingle: int, bits: int) -> DataFrame:
    """One row per input row: ``__id``, ``__text`` (hash of the text), ``__fp`` and its group's ``root``."""
    body = F.coalesce(F.col(text_col), F.lit(""))
    prints = materialise(
        docs.select(F.col(id_col).cast("long").alias("__id"), F.xxhash64(body).alias("__text"), body.alias("__body"))
        .mapInArrow(_fingerprints(shingle), "__id long, __text long, __fp long"), "fingerprints")
    nodes = materialise(prints.select("__fp").distinct(), "fingerprint-nodes")
    roots = components(link(nodes, bits))
    return prints.join(roots, F.col("__fp") == F.col("node"), "left").select(
        "__id", "__text", "__fp", F.coalesce("root", "__fp").alias("root"))


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
               bits: int = 2) -> DataFrame:
    """Fingerprint and component of every document: ``doc_id``, ``fingerprint``, ``component_id``.

    Words (parted by ASCII white space, A-Z lowered) form ``shingle``-word shingles,
    repeats included; fewer words are one shingle.  Fingerprints at most ``bits``
    bits apart link; a component's id is the smallest id reachable.  One row per
    input row.  A null text, an empty one and one of white space only have the
    fingerprint zero and link like any other.  Rows with a null id take part in
    linking; a component without any other id has a null component id.

    Plan: equal fingerprints are one node, however many documents share it, so the
    join and the components see distinct fingerprints only; the last joins, which
    hand a component to its documents, are on rows of three numbers, where the
    runtime splits a fingerprint shared by a third of all rows.
    """
    rows = _clusters(docs, id_col, text_col, shingle, bits)
    smallest = rows.groupBy(F.col("root").alias("__root")).agg(F.min("__id").alias("component_id"))
    return rows.join(smallest, F.col("root") == F.col("__root")).select(
        F.col("__id").alias("doc_id"), F.lower(F.lpad(F.hex("__fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
             bits: int = 2) -> DataFrame:
    """The rows of ``docs`` without near-duplicates: of each component the row with the smallest id.

    A row without an id stays only if its component has no other; of rows equal in id
    the one with the smallest text hash stays, and of rows equal in both any one.
    """
    rows = _clusters(docs, id_col, text_col, shingle, bits)
    first = F.min(F.struct(F.col("__id").isNull().alias("n"), F.col("__id").alias("i"), F.col("__text").alias("t")))
    own, digest, keep, keep_digest = fresh(docs, "__kid", "__khash", "__keep", "__keep_hash")
    kept = rows.groupBy("root").agg(first.alias("k")).select(F.col("k.i").alias(keep), F.col("k.t").alias(keep_digest))
    body = F.coalesce(F.col(text_col), F.lit(""))
    marked = docs.withColumns({own: F.col(id_col).cast("long"), digest: F.xxhash64(body)})
    return (marked.join(kept, F.col(own).eqNullSafe(F.col(keep)) & (F.col(digest) == F.col(keep_digest)), "left_semi")
            .dropDuplicates([own, digest]).drop(own, digest))

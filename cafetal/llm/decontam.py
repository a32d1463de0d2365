"""Benchmark decontamination: latent semantic retrieval, then common subsequences and answers."""

from __future__ import annotations

import re
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cafetal.llm.common import column, materialise, slices

FEATURES = 18  # words are hashed to 2^18 TF-IDF features
_SPARE = 16  # dimensions of the randomised range beyond the rank
_PLAIN = 64  # commonest words, counted per passage instead of added up one by one
_HEAVY = 1 << 13  # features of the latent space beside the items' own: those with most weight in the corpus
UNIT = 128  # words of an item that are looked for together; longer items are several units
HALF = 32  # passages are windows of two halves of so many words, each half in two windows
_WORD = bytes(b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))


def tokens(text: str) -> np.ndarray:
    """CRC-32 of each word (runs of letters and digits, lower case)."""
    ws = text.lower().encode().translate(_WORD).split()
    return np.fromiter(map(crc32, ws), np.uint32, len(ws))


def features(toks: np.ndarray) -> np.ndarray:
    return (toks & ((1 << FEATURES) - 1)).astype(np.int64)


def _tokenise(batches):
    """All columns but the last, which is the text; then its tokens."""
    for b in slices(batches):
        toks = [tokens(t).tobytes() for t in column(b, "__body")]
        yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(toks, pa.binary())],
                                         names=[*b.schema.names[:-1], "__toks"])


def _halves(raw: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tokens of several texts in one array, the number of halves of each text, each token's half."""
    toks = [np.frombuffer(r, np.uint32) for r in raw]
    count = np.array([-(-len(t) // HALF) for t in toks], np.int64)
    first = np.cumsum(count) - count
    half = [f + np.arange(len(t)) // HALF for f, t in zip(first.tolist(), toks, strict=True)]
    flat = np.concatenate([*toks, np.zeros(0, np.uint32)])
    return flat, count, np.concatenate([*half, np.zeros(0, np.int64)])


def _passage_counts(batches):
    """Per feature the passages' halves that hold it; the number of halves under the key -1."""
    n, total = np.zeros(1 << FEATURES, np.int64), 0
    for b in slices(batches, 256):
        flat, count, half = _halves(column(b, "__toks"))
        key = half << FEATURES | features(flat)
        key = np.sort(key.astype(np.uint32) if int(count.sum()) < 1 << 32 - FEATURES else key)
        first = np.append(True, key[1:] != key[:-1])[:len(key)]
        n += np.bincount(key[first] & ((1 << FEATURES) - 1), minlength=len(n))
        total += int(count.sum())
    full = np.flatnonzero(n)
    yield pa.RecordBatch.from_arrays([pa.array(np.append(full, -1)), pa.array(np.append(n[full], total))],
                                     names=["f", "n"])


def inverse_frequencies(toks: DataFrame, common: float) -> tuple[np.ndarray, np.ndarray]:
    """IDF of every feature over all passages, 0 for features in more than ``common`` of them; and the passages that hold it."""
    got = toks.select("__toks").mapInArrow(_passage_counts, "f long, n long").groupBy("f").agg(F.sum("n").alias("n"))
    n = np.zeros((1 << FEATURES) + 1)
    rows = got.toPandas()  # at most 2^18 + 1 rows
    n[rows.f.to_numpy()] = rows.n.to_numpy()  # -1 is the last place
    total, n = max(n[-1], 1), n[:-1]
    idf = np.log((total + 1) / (n + 1))
    idf[n > common * total] = 0
    return idf.astype(np.float32), n


def _tfidf(toks: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Features of a passage and their weights, of length 1 in all."""
    f, n = np.unique(features(toks), return_counts=True)
    w = n * idf[f]
    f, w = f[w > 0], w[w > 0]
    return f, w / max(np.sqrt((w * w).sum()), 1e-30)


class Space:
    """Rows of a features x dimensions matrix, with the commonest features apart."""

    def __init__(self, names: np.ndarray, idf: np.ndarray):
        self.names, self.idf = names, idf
        self.row = np.full(1 << FEATURES, -1, np.int32)
        self.row[names] = np.arange(len(names))
        # The commonest words make up most tokens: they are counted per passage, the others added one by one.
        order = np.argsort(idf[names], kind="stable")
        self.plain = order[idf[names][order] > 0][:_PLAIN]
        self.plain_at = np.full(len(names) + 1, -1, np.int32)  # row -1, the features outside, is the last
        self.plain_at[self.plain] = np.arange(len(self.plain))

    def split(self, f: np.ndarray, group: np.ndarray, groups: int):
        """Counts of the commonest features per group, and (token number, row) of the others."""
        row = self.row[f]
        plain, m = self.plain_at[row], len(self.plain)
        is_plain = plain >= 0
        counts = np.bincount(group[is_plain] * m + plain[is_plain], minlength=groups * m) if m else np.zeros(0)
        other = np.flatnonzero((row >= 0) & ~is_plain)
        other = other[self.idf[f[other]] > 0]
        return counts.reshape(groups, m).astype(np.float32), other, row[other]

    def fold(self, counts: np.ndarray, group: np.ndarray, row: np.ndarray, weighted: np.ndarray) -> np.ndarray:
        """The groups' sums of ``weighted`` rows; ``group`` rises."""
        z = counts @ weighted[self.plain] if len(self.plain) else np.zeros((len(counts), weighted.shape[1]), np.float32)
        if len(row):
            start = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
            z[group[start]] += np.add.reduceat(weighted[row], start, axis=0)
        return z


def latent_features(items: list[Item], idf: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The items' features and those of most weight in the corpus."""
    mass = counts * idf.astype(float) ** 2
    heavy = np.argsort(-mass, kind="stable")[:_HEAVY]
    own = [features(i.toks) for i in items]
    names = np.unique(np.concatenate([heavy[mass[heavy] > 0], *own]))
    return names[idf[names] > 0]


def randomised_svd(toks: DataFrame, space: Space, rank: int, seed: int = 7) -> np.ndarray:
    """Leading right singular vectors of the TF-IDF matrix A of all passages: a row of ``rank`` for each feature of ``space``.

    The matrix has a row per passage (64 words, one after the other, over whole texts), of length 1.  One distributed
    pass over the tokens adds up Y = A'(A Omega), a sum of a'(a Omega) over the rows: each task adds up its passages in a
    features x dimensions table, Spark adds up the tables.  The Nystroem form of the sketch gives the eigenvectors of
    A'A, which are A's right singular vectors: they are the left singular vectors of
    Y (Omega'Y)^-1/2.
    """
    spark = toks.sparkSession
    wide = min(rank + _SPARE, len(space.names))
    schema = "f long, " + ", ".join(f"v{k} float" for k in range(wide))
    sums = [F.sum(f"v{k}").alias(f"v{k}") for k in range(wide)]

    def added(basis: np.ndarray) -> np.ndarray:
        sent = spark.sparkContext.broadcast((space, basis.astype(np.float32)))

        def run(batches):
            space, basis = sent.value
            weighted = basis * space.idf[space.names][:, None]
            total = np.zeros_like(weighted)
            for b in slices(batches, 256):
                flat, count, half = _halves(column(b, "__toks"))
                first = np.cumsum(count) - count
                text = np.repeat(np.arange(len(count)), count)
                number = np.cumsum(-(-count // 2)) - -(-count // 2)
                passage = (number[text] + (np.arange(len(text)) - first[text]) // 2)[half] if len(text) else half
                groups = int((-(-count // 2)).sum())
                f = features(flat)
                square = np.bincount(passage, space.idf[f].astype(float) ** 2, minlength=groups)
                counts, other, row = space.split(f, passage, groups)
                z = space.fold(counts, passage[other], row, weighted)
                z /= np.maximum(square, 1e-12)[:, None]
                if len(space.plain):
                    total[space.plain] += counts.T @ z
                if len(row):
                    order = np.argsort(row, kind="stable")
                    start = np.flatnonzero(np.append(True, row[order][1:] != row[order][:-1]))
                    total[row[order][start]] += np.add.reduceat(z[passage[other[order]]], start, axis=0)
            total *= space.idf[space.names][:, None]
            full = np.flatnonzero(total.any(axis=1))
            yield pa.RecordBatch.from_arrays([pa.array(full), *(pa.array(np.ascontiguousarray(c)) for c in total[full].T)],
                                             names=["f", *(f"v{k}" for k in range(wide))])

        got = toks.select("__toks").mapInArrow(run, schema).groupBy("f").agg(*sums).toPandas()  # at most 2^18 rows
        y = np.zeros((len(space.names), wide))
        y[got.f.to_numpy()] = got.drop(columns="f").to_numpy(float)
        return y

    omega = np.stack([np.random.default_rng((seed, int(x))).standard_normal(wide) for x in space.names])
    omega, _ = np.linalg.qr(omega)
    omega = omega.astype(np.float32).astype(float)  # as it is sent
    y = added(omega)
    small = omega.T @ y
    energy, turn = np.linalg.eigh((small + small.T) / 2)
    sure = energy > 1e-5 * max(float(energy[-1]), 1e-30)  # sums are in 32 bits
    vectors, values, _ = np.linalg.svd(y @ turn[:, sure] / np.sqrt(energy[sure]), full_matrices=False)
    return vectors[:, values > 1e-3 * max(float(values.max(initial=0)), 1e-30)][:, :rank]


def common_subsequence(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the longest common subsequence, by bit vectors."""
    places: dict[int, int] = {}
    for k, x in enumerate(a.tolist()):
        places[x] = places.get(x, 0) | 1 << k
    full = (1 << len(a)) - 1
    v = full
    for y in b.tolist():
        if m := places.get(y):
            u = v & m
            v = ((v + u) | (v - u)) & full
    return len(a) - v.bit_count()


class Item:
    """A benchmark item's words and those of its answer."""

    def __init__(self, item_id: int, text: str, answer: str | None):
        self.id, self.toks = item_id, tokens(text)
        self.words = self.toks.tolist()
        self.distinct = frozenset(self.words)
        sentences = [s for s in re.split(r"(?<=[.!?])\s+|\n+", text) if len(tokens(s))]
        self.answer = tokens(answer if answer is not None else sentences[-1])

    def check(self, region: np.ndarray, least: float, whole: float = 0.95) -> tuple[float, bool]:
        """Share of the item's words found in order in a stretch of its own size, and the answer beside it.

        Of all stretches the best that holds the item (``least`` with the answer, or ``whole``), else the best.
        """
        n = len(self.toks)
        absent = self.distinct.difference(region.tolist())
        # no subsequence can be longer than the words that are there
        if n - len(absent) < least * n or absent and n - sum(t in absent for t in self.words) < least * n:
            return 0.0, False
        if common_subsequence(self.toks, region) < least * n:
            return 0.0, False
        size, step = -(-5 * n // 4), max(1, n // 8)
        stretches = sorted((-common_subsequence(self.toks, region[k:k + size]), k)
                           for k in range(0, max(1, len(region) - size + step), step))
        best = False, 0.0, False
        for c, at in stretches:
            share = -c / n
            if share < (best[1] if best[0] else least):
                break
            near = region[max(0, at - size // 2):at + size + size // 2]
            answer = common_subsequence(self.answer, near) / max(1, len(self.answer)) >= least
            best = max(best, (answer or share >= whole, share, answer))
            if best[0] and answer:
                break
        return best[1:]


class Index:
    """Units of the items in the latent space and as plain TF-IDF, with what folding passages in takes."""

    def __init__(self, items: list[Item], space: Space, vectors: np.ndarray):
        self.items, self.space = items, space
        self.vectors = vectors.astype(np.float32)
        self.weighted = self.vectors * space.idf[space.names][:, None]  # a word's share in a passage's sum
        self.unit = [(k, at) for k, i in enumerate(items) for at in range(0, max(1, len(i.toks) - UNIT // 2), UNIT)]
        z = np.zeros((len(self.unit), self.vectors.shape[1]), np.float32)
        postings: list[list[tuple[int, float]]] = [[] for _ in space.names]
        for u, (k, at) in enumerate(self.unit):
            toks = items[k].toks
            end = at + UNIT if (k, at + UNIT) in self.unit[u + 1:u + 2] else len(toks)
            f, w = _tfidf(toks[at:end], space.idf)
            rows = space.row[f]
            z[u] = w @ self.vectors[rows] if len(f) else 0
            for r, x in zip(rows.tolist(), w.tolist(), strict=True):
                postings[r].append((u, x * float(space.idf[space.names[r]])))
        self.z = z / np.maximum(np.linalg.norm(z, axis=1, keepdims=True), 1e-12)
        # plain TF-IDF: the units that hold a word, and what one occurrence adds to their inner product
        self.dense = np.zeros((len(space.plain), len(self.unit)), np.float32)
        for i, r in enumerate(space.plain.tolist()):
            for u, x in postings[r]:
                self.dense[i, u] = x
            postings[r] = []
        self.first = np.concatenate([[0], np.cumsum([len(p) for p in postings])])
        self.post_unit = np.array([u for p in postings for u, _ in p], np.int64)
        self.post_weight = np.array([x for p in postings for _, x in p], np.float32)

    def cosines(self, raw: list[bytes]):
        """For blocks of passages: (their numbers, plain cosines, latent cosines) with each unit; then (text, half) of all."""
        flat, count, half = _halves(raw)
        n = int(count.sum())
        f = features(flat)
        counts, other, row = self.space.split(f, half, n)
        h = half[other]
        square = np.bincount(half, self.space.idf[f].astype(float) ** 2, minlength=n)
        text = np.repeat(np.arange(len(raw)), count)
        last = np.append(text[1:] != text[:-1], True) if n else np.zeros(0, bool)
        two = lambda x: x + np.where(last if x.ndim == 1 else last[:, None], 0, np.append(x[1:], x[:1], axis=0))
        z, length = two(self.space.fold(counts, h, row, self.weighted)), np.sqrt(np.maximum(two(square), 1e-12))
        z, counts = z / length[:, None], two(counts)
        step = max(256, (1 << 22) // max(1, len(self.unit)))
        places = text, np.arange(n) - (np.cumsum(count) - count)[text]
        for k in range(0, n, step):
            e = min(n, k + step)
            plain = counts[k:e] @ self.dense
            # tokens of these passages: their own halves, and the next one's
            a, z_ = np.searchsorted(h, [k, e + 1])
            tok_row, tok_half = row[a:z_], h[a:z_] - k
            many = self.first[tok_row + 1] - self.first[tok_row]
            at = np.repeat(self.first[tok_row] - (np.cumsum(many) - many), many) + np.arange(int(many.sum()))
            place = np.repeat(tok_half, many) * len(self.unit) + self.post_unit[at]
            sparse = np.bincount(place, self.post_weight[at], minlength=(e - k + 1) * len(self.unit)).astype(np.float32)
            sparse = sparse[:(e - k + 1) * len(self.unit)].reshape(e - k + 1, len(self.unit))
            plain += sparse[:-1] + np.where(last[k:e, None], 0, sparse[1:])
            yield k, plain / length[k:e, None], z[k:e] @ self.z.T, places

    def candidates(self, raw: list[bytes], least: float, latent: float):
        """(text, item) -> [(half, words of the item before the unit, cosine)] of the passages near an item."""
        found: dict[tuple[int, int], list[tuple[int, int, float]]] = {}
        for k, plain, near, (text, half) in self.cosines(raw):
            for i, u in zip(*np.nonzero((plain >= least) | (near >= latent)), strict=True):
                item, at = self.unit[u]
                found.setdefault((int(text[k + i]), item), []).append((int(half[k + i]), at, float(max(plain[i, u], near[i, u]))))
        return found


def _regions(hits: list[tuple[int, int, float]], n: int) -> list[tuple[int, int]]:
    """Stretches of words that an item of ``n`` words may fill, from the passages near its units."""
    if n <= UNIT + UNIT // 2:
        return [(half * HALF - n, (half + 2) * HALF + n) for half in sorted({h for h, _, _ in hits})]
    slack, out = n // 4 + 2 * HALF, []
    for start in sorted({h * HALF - at for h, at, _ in hits}):
        if out and start - slack <= out[-1][0] + 2 * slack:
            out[-1] = out[-1][0], start + n + slack
        else:
            out.append((start - slack, start + n + slack))
    return out


def _search(index, cosine: float, latent: float, subsequence: float, whole: float):
    def run(batches):
        for b in slices(batches, 256):
            raw, uid, rows = column(b, "__toks"), column(b, "__uid"), []
            for (t, j), hits in index.value.candidates(raw, cosine, latent).items():
                item = index.value.items[j]
                words = np.frombuffer(raw[t], np.uint32)
                best = False, 0.0, False
                for low, high in _regions(hits, len(item.toks)):
                    share, answer = item.check(words[max(0, low):max(0, high)], subsequence, whole)
                    if share >= subsequence:
                        best = max(best, (answer or share >= whole, share, answer))
                if best[1]:
                    rows.append((uid[t], item.id, *best[1:], min(1.0, max(c for _, _, c in hits))))
            cols = list(zip(*rows, strict=True)) or [()] * 5
            kinds = pa.int64(), pa.int64(), pa.float64(), pa.bool_(), pa.float64()
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)],
                                             names=["__muid", "item_id", "lcs", "answer", "cosine"])

    return run


def find_leaks(docs: DataFrame, benchmark: DataFrame, rank: int = 32, cosine: float = 0.2, latent: float = 0.45,
               subsequence: float = 0.8, whole: float = 0.95, common: float = 0.5, block: int = 8192, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """Benchmark items that documents hold, word for word or paraphrased.

    Passages are windows of 64 words, one every 32 words, over whole texts; TF-IDF
    counts all of them.  The TF-IDF matrix of all passages is taken to its ``rank`` leading singular vectors by a
    distributed randomised SVD, so words that occur together in the corpus lie near each other.  Items, in units of
    about 128 words, and passages are folded in; passages at least ``latent`` near a unit in that space (against the
    passage's full length) are candidates, and so are those with a plain TF-IDF cosine of ``cosine``.  A
    candidate holds the item if at least ``subsequence`` of the item's words stand in
    order in a stretch 1.25 times the item's size, and as much of its answer beside
    it, or ``whole`` of the item anyway; every stretch is judged by itself.  The answer is the column ``answer`` of
    ``benchmark`` if there is one and it has words, else the item's last sentence.

    Returns one row per input row: ``doc_id``, ``contaminated``, ``n_items``,
    ``item_id``, ``lcs``, ``answer`` and ``cosine`` of the best match (most words,
    then answer, then the smallest id; null without one), and ``text_hash`` (XXH64 of
    the text), which tells rows without an id or with the same id apart.  Null and empty texts
    hold nothing; null ids are passed on.  Items without an id or without words
    are left out; an item of which every word is in more than ``common`` of all
    passages is too plain to be found.  Repeated items count once per id.

    Plan: texts are hashed to words once and that table is written; four scans of
    it follow (frequencies, SVD, search, ids).  Items are handled in blocks of about
    ``block``, so what is broadcast is bounded (a block's units, 2^18 frequencies, and the singular vectors of at most
    2^18 features); each further block of items is two more scans.
    """
    body = F.coalesce(F.col(text_col), F.lit(""))
    toks = materialise(
        docs.select(F.col(id_col).cast("long").alias("__id"), F.xxhash64(body).alias("__hash"), body.alias("__body"))
        .mapInArrow(_tokenise, "__id long, __hash long, __toks binary").withColumn("__uid", F.monotonically_increasing_id()),
        "decontam-tokens")
    idf, counts = inverse_frequencies(toks, common)
    answer = F.col("answer").cast("string") if "answer" in benchmark.columns else F.lit(None).cast("string")
    items = materialise(
        benchmark.select(F.col("item_id").cast("long").alias("item"), F.col("text").cast("string").alias("body"),
                         answer.alias("reply"))
        .filter("item is not null and body is not null").distinct(), "decontam-items")
    blocks = max(1, -(-items.count() // block))
    matches = None
    for k in range(blocks):
        part = items.filter(F.pmod(F.xxhash64("item", "body", "reply"), F.lit(blocks)) == k)
        rows = [Item(r.item, r.body, r.reply if r.reply and len(tokens(r.reply)) else None)
                for r in part.collect() if len(tokens(r.body))]  # about ``block`` rows
        if not rows:
            continue
        names = latent_features(rows, idf, counts)
        if not len(names):
            continue
        space = Space(names, idf)
        index = docs.sparkSession.sparkContext.broadcast(Index(rows, space, randomised_svd(toks, space, rank)))
        found = toks.select("__uid", "__toks").mapInArrow(
            _search(index, cosine, latent, subsequence, whole),
            "__muid long, item_id long, lcs double, answer boolean, cosine double")
        found = found.filter(F.col("answer") | (F.col("lcs") >= whole))
        matches = found if matches is None else matches.union(found)
    every = toks.select("__uid", F.col("__id").alias("doc_id"), F.col("__hash").alias("text_hash"))
    if matches is None:
        return every.select("doc_id", F.lit(False).alias("contaminated"), F.lit(0).cast("long").alias("n_items"),
                            *[F.lit(None).cast(t).alias(c) for c, t in (("item_id", "long"), ("lcs", "double"),
                                                                        ("answer", "boolean"), ("cosine", "double"))],
                            "text_hash")
    order = F.struct("lcs", "answer", (-F.col("item_id")).alias("__less"), "cosine", "item_id")
    best = matches.groupBy("__muid").agg(F.count_distinct("item_id").alias("n_items"), F.max(order).alias("__best"))
    return every.join(best, F.col("__uid") == F.col("__muid"), "left").select(
        "doc_id", F.col("__best").isNotNull().alias("contaminated"),
        F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
        *[F.col(f"__best.{c}").alias(c) for c in ("item_id", "lcs", "answer", "cosine")], "text_hash")

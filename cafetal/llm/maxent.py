"""Language-model scores: a hashed maximum-entropy model with class-factored softmax over the real vocabulary.

Every word has a symbol.  The most frequent words have one of their own; each other word has the symbol of its
class, learned from the whole corpus: words are put together by their endings, and endings whose words stand between the
same frequent words are one class.  The model gives the symbol from the two symbols before it, by class-factored
softmax over hashed features; inside a class a word's share follows its count.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass
from itertools import repeat
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cafetal.llm.common import column, materialise, slices

SIDE = 16  # classes, and symbols in a class
SYMBOLS = SIDE * SIDE  # frequent words, classes of the other words, END; as a context END also stands before the text
WORDS = 126  # frequent words with a symbol of their own
END = SYMBOLS - 1
CLASSES = END - WORDS
FORMS = 1 << 12  # hashed endings of words
_SIDES = 128  # frequent neighbours on either side: words, END, and all others
_EDGE = WORDS + FORMS  # the end among codes, which number the frequent words and then the endings
ROWS = 1 << 12  # hashed features
_FLUSH = 1 << 21
_BLOCKS = 16  # parts in which tasks hand over a gradient


def words(text: str) -> list[bytes]:
    return text.encode().lower().split()  # bytes: A-Z and ASCII white space only


def held_out(id_col: str = "doc_id") -> Column:
    """Rows that nothing is learned from; rows without an id are learned from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("long").cast("string").cast("binary")) % 7 == 2, F.lit(False))


def feature_rows(context: np.ndarray) -> np.ndarray:
    """The hashed features of contexts (word before last * SYMBOLS + last word), a row of four each.

    Always on; the last word; the word before it, skipping one (both have rows of
    their own); and the two together, hashed into the remaining rows.
    """
    skip, last = context // SYMBOLS, context % SYMBOLS
    mixed = (context.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)
    first = 1 + 2 * SYMBOLS
    return np.stack([np.zeros_like(context), 1 + last, 1 + SYMBOLS + skip,
                     first + (mixed % np.uint64(ROWS - first)).astype(np.int64)], axis=1)


def forms(ws: list[bytes]) -> np.ndarray:
    """The hashed endings of words: their last three bytes."""
    return np.fromiter((crc32(w[-3:]) for w in ws), np.int64, len(ws)) & (FORMS - 1)


def form_classes(beside: np.ndarray, seed: int = 3, rounds: int = 15) -> np.ndarray:
    """Classes of the endings by the frequent words beside their words: weighted k-means on the roots of the shares."""
    mass = beside.sum(axis=1)
    x = np.sqrt(beside / np.maximum(mass, 1)[:, None])
    seen = np.flatnonzero(mass)
    if len(seen) <= CLASSES:
        out = np.zeros(FORMS, np.int64)
        out[seen] = np.arange(len(seen))
        return out
    rng = np.random.default_rng(seed)
    centres = x[rng.choice(seen, CLASSES, replace=False, p=mass[seen] / mass[seen].sum())]
    for _ in range(rounds):
        label = (x @ centres.T - 0.5 * (centres * centres).sum(axis=1)).argmax(axis=1)
        weight = np.bincount(label, mass, minlength=CLASSES)
        sums = np.zeros_like(centres)
        np.add.at(sums, label, x * mass[:, None])
        full = weight > 0
        centres[full] = sums[full] / weight[full, None]
        if not full.all():  # an empty class starts again at the heaviest endings
            centres[~full] = x[np.argsort(-mass, kind="stable")[:int((~full).sum())]]
    return (x @ centres.T - 0.5 * (centres * centres).sum(axis=1)).argmax(axis=1)


def _log_softmax(z: np.ndarray) -> np.ndarray:
    z = z - z.max(axis=1, keepdims=True)
    return z - np.log(np.exp(z).sum(axis=1, keepdims=True))


@dataclass
class Weights:
    """Class weights (feature, class) and symbol weights (feature, class, symbol in class)."""

    of_class: np.ndarray
    of_symbol: np.ndarray

    @classmethod
    def start(cls, counts: np.ndarray, last: np.ndarray, skip: np.ndarray) -> Weights:
        """Single symbols under the feature that is always on, and damped ratios under the two single words.

        ``last`` and ``skip`` count a symbol (column) after a word, or with one between.
        """
        w = cls(np.zeros((ROWS, SIDE)), np.zeros((ROWS, SIDE, SIDE)))
        p = ((counts + 1) / (counts + 1).sum()).reshape(SIDE, SIDE)
        alone = [np.log(p.sum(axis=1)), np.log(p / p.sum(axis=1, keepdims=True))]
        w.of_class[0], w.of_symbol[0] = alone
        for first, damp, seen in ((1, 0.6, last), (1 + SYMBOLS, 0.4, skip)):
            q = (seen + 20 * p.ravel()).reshape(-1, SIDE, SIDE)
            q /= q.sum(axis=(1, 2), keepdims=True)
            given = [np.log(q.sum(axis=2)), np.log(q / q.sum(axis=2, keepdims=True))]
            w.of_class[first:first + SYMBOLS] = damp * (given[0] - alone[0])
            w.of_symbol[first:first + SYMBOLS] = damp * (given[1] - alone[1])
        return w

    def log_probability(self, context: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        """log P(class | context) + log P(symbol | class, context), base e."""
        out = np.empty(len(context))
        for s in range(0, len(context), 1 << 15):
            f, y = feature_rows(context[s:s + (1 << 15)]), symbol[s:s + (1 << 15)]
            c, k, at = y // SIDE, y % SIDE, np.arange(len(y))
            out[s:s + len(y)] = (_log_softmax(self.of_class[f].sum(axis=1, dtype=float))[at, c]
                                 + _log_softmax(self.of_symbol[f, c[:, None]].sum(axis=1, dtype=float))[at, k])
        return out

    def gradient(self, context: np.ndarray, symbol: np.ndarray, n: np.ndarray) -> tuple[float, Weights]:
        """Log loss of counted trigrams and its gradient, summed in sparse batches."""
        loss, g = 0.0, Weights(np.zeros_like(self.of_class), np.zeros_like(self.of_symbol))
        for s in range(0, len(n), 1 << 14):
            i = slice(s, s + (1 << 14))
            f, y, w = feature_rows(context[i]), symbol[i], n[i].astype(float)
            c, at = y // SIDE, np.arange(len(y))
            for table, total, rows, target in (
                    (self.of_class, g.of_class, f, c),
                    (self.of_symbol.reshape(-1, SIDE), g.of_symbol.reshape(-1, SIDE), f * SIDE + c[:, None], y % SIDE)):
                lp = _log_softmax(table[rows].sum(axis=1, dtype=float))
                loss -= float(w @ lp[at, target])
                d = np.exp(lp)
                d[at, target] -= 1
                d *= w[:, None]
                used, where = np.unique(rows, return_inverse=True)
                cells = where.reshape(rows.shape)[:, :, None] * SIDE + np.arange(SIDE)
                total[used] += np.bincount(
                    cells.ravel(), np.broadcast_to(d[:, None, :], cells.shape).ravel(),
                    minlength=len(used) * SIDE).reshape(-1, SIDE)
        return loss, g


@dataclass
class Vocabulary:
    """Counts of the training corpus: totals, a bounded table of the most frequent words, and the classes of all others."""

    tokens: int
    distinct: int
    texts: int
    place: dict[bytes, int]
    counts: np.ndarray
    form: np.ndarray  # of the table's words
    form_class: np.ndarray  # of each ending
    class_tokens: np.ndarray  # tokens of each class
    class_total: np.ndarray  # its words' counts plus one each, and one for a word that is not known

    @property
    def symbols(self) -> np.ndarray:
        """Counts of the model's symbols."""
        n = np.zeros(SYMBOLS)
        n[:min(WORDS, len(self.counts))] = self.counts[:WORDS]
        n[WORDS:END] = self.class_tokens
        n[END] = self.texts
        return n

    def places(self, ws: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.place.get, ws, repeat(-1)), np.int64, len(ws))

    def codes(self, ws: list[bytes], places: np.ndarray) -> np.ndarray:
        """Code of each word: its place if it is one of the frequent words, else ``WORDS`` and its ending."""
        out = np.where((places >= 0) & (places < WORDS), places, WORDS + self.form[places])  # place -1 is a filler
        unknown = np.flatnonzero(places < 0)
        if len(unknown):
            out[unknown] = WORDS + forms([ws[i] for i in unknown.tolist()])
        return out.astype("<u2")

    def symbol_of_code(self) -> np.ndarray:
        return np.concatenate([np.arange(WORDS), WORDS + self.form_class, [END]])


def _flat(raw: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes of several texts in one array, each with two edges before and one behind; the texts' starts and sizes."""
    codes = [np.frombuffer(r, "<u2") for r in raw]
    n = np.array([len(c) for c in codes], np.int64)
    start = np.cumsum(n + 3) - n - 3
    out = np.full(int((n + 3).sum()), _EDGE, np.int64)
    out[np.arange(int(n.sum())) + np.repeat(start + 2 - (np.cumsum(n) - n), n)] = np.concatenate([*codes, np.zeros(0, "<u2")])
    return out, start, n


def _trigrams(raw: list[bytes], symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Trigrams of symbols (context * SYMBOLS + symbol) of the tokens of several texts, ends included; tokens of each text."""
    flat, start, n = _flat(raw)
    y = symbol[flat]
    at = np.arange(int((n + 1).sum())) + np.repeat(start + 2 - (np.cumsum(n + 1) - n - 1), n + 1)
    return (y[at - 2] * SYMBOLS + y[at - 1]) * SYMBOLS + y[at], n + 1


def _count_words(batches):
    counts: Counter = Counter()

    def rows():
        batch = pa.RecordBatch.from_arrays([pa.array([w.decode() for w in counts], pa.string()),
                                            pa.array(list(counts.values()), pa.int64())], names=["word", "c"])
        counts.clear()
        return batch

    for b in slices(batches):
        for text in column(b, "__body"):
            counts.update(words(text))
        if len(counts) > 150_000:
            yield rows()
    yield rows()


def _encoded(vocabulary):
    """Texts read as codes, with the sums that need the words themselves: the only pass that looks at words again."""
    def run(batches):
        v = vocabulary.value
        logs = np.log10(v.counts + 1) if len(v.counts) else np.zeros(1)
        end_log = np.log10(v.texts + 1)
        for b in slices(batches, 256):
            cols = [[] for _ in range(6)]
            for text in column(b, "__body"):
                ws = words(text)
                at = v.places(ws)
                known = at[at >= 0]
                rare = Counter(w.decode() for w, k in zip(ws, (at < 0).tolist(), strict=True) if k) if (
                    len(known) < len(ws)) else {}
                cols[0].append(len(ws) + 1)
                cols[1].append(len(known) + (v.texts > 0))
                cols[2].append(float(logs[known].sum() + end_log))
                cols[3].append(float(logs[known[known >= WORDS]].sum()))
                cols[4].append([{"word": w, "m": m} for w, m in rare.items()])
                cols[5].append(v.codes(ws, at).tobytes())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()),
                 pa.array(cols[2], pa.float64()), pa.array(cols[3], pa.float64()),
                 pa.array(cols[4], pa.list_(pa.struct([("word", pa.string()), ("m", pa.int64())]))), pa.array(cols[5], pa.binary())],
                names=["doc_id", "held_out", "n_tokens", "known", "base", "inside", "rare", "codes"])

    return run


_ENCODED = ("doc_id long, held_out boolean, n_tokens long, known long, base double, inside double, "
            "rare array<struct<word:string,m:long>>, codes binary")


def _count_neighbours(batches):
    """Per ending of the words without a symbol of their own: the frequent words before and behind them."""
    total = np.zeros(FORMS * 2 * _SIDES, np.int64)
    for b in slices(batches):
        code, _, _ = _flat(column(b, "codes"))
        side = np.where(code < WORDS, code, np.where(code == _EDGE, WORDS, WORDS + 1))
        rare = np.flatnonzero((code >= WORDS) & (code < _EDGE))
        form = (code[rare] - WORDS) * 2 * _SIDES
        total += np.bincount(np.concatenate([form + side[rare - 1], form + _SIDES + side[rare + 1]]), minlength=len(total))
    full = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(full), pa.array(total[full])], names=["cell", "n"])


def _count_forms(vocabulary):
    """Per ending: tokens, words, of the words without a symbol of their own; reads the table of all counts."""
    def run(batches):
        n = np.zeros((2, FORMS), np.int64)
        place = vocabulary.value.place
        for b in batches:
            ws, c = [w.encode() for w in column(b, "word")], b.column(b.schema.get_field_index("c")).to_numpy()
            rare = np.array([place.get(w, WORDS) >= WORDS for w in ws], bool)
            f = forms(ws)[rare]
            n[0] += np.bincount(f, c[rare], minlength=FORMS).astype(np.int64)
            n[1] += np.bincount(f, minlength=FORMS)
        full = np.flatnonzero(n[1])
        yield pa.RecordBatch.from_arrays([pa.array(full), *(pa.array(x[full]) for x in n)], names=["f", "tokens", "words"])

    return run


def _count_trigrams(symbol):
    def run(batches):
        held, size = [], 0

        def rows():
            code, n = np.unique(np.concatenate([*held, np.zeros(0, np.int64)]), return_counts=True)
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(code), pa.array(n)], names=["code", "n"])

        for b in slices(batches):
            held.append(_trigrams(column(b, "codes"), symbol.value)[0])
            size += len(held[-1])
            if size > _FLUSH:
                yield rows()
                size = 0
        yield rows()

    return run


def _short(cells: np.ndarray) -> bytes:
    """32-bit numbers by their upper halves, rounded: what tasks hand over of a gradient."""
    bits = np.ascontiguousarray(cells, np.float32).view(np.uint32)
    return ((bits.astype(np.uint64) + 0x8000) >> np.uint64(16)).astype("<u2").tobytes()


def _long(raw: bytes) -> np.ndarray:
    return (np.frombuffer(raw, "<u2").astype(np.uint32) << np.uint32(16)).view(np.float32)


def _gradients(weights):
    def run(part: pd.DataFrame) -> pd.DataFrame:
        code, n = part["code"].to_numpy(), part["n"].to_numpy()
        order = np.argsort(code)  # the order of arrival must not matter
        code, n = code[order], n[order]
        loss, g = weights.value.gradient(code // SYMBOLS, code % SYMBOLS, n)
        cells = np.concatenate([g.of_class.reshape(ROWS, -1), g.of_symbol.reshape(ROWS, -1)], axis=1)
        blocks = cells.reshape(_BLOCKS, -1)
        return pd.DataFrame({"block": range(_BLOCKS), "loss": [loss / _BLOCKS] * _BLOCKS,
                             "cells": [_short(x) for x in blocks]})

    return run


def _add_blocks(part: pd.DataFrame) -> pd.DataFrame:
    """One block of the gradient, summed over tasks."""
    cells = sum(_long(x).astype(float) for x in part["cells"])
    return pd.DataFrame([(int(part["block"].iloc[0]), float(part["loss"].sum()), _short(cells))],
                        columns=["block", "loss", "cells"])


def count(train: DataFrame, text_col: str, table_size: int) -> tuple[Vocabulary, DataFrame]:
    """Count all words of all texts: (vocabulary without classes yet, table of all counts).

    Every token is counted.  The table of frequent words has at most ``table_size``
    of them, and less by those that a tie at its end would bring in.
    """
    texts = train.select(F.coalesce(text_col, F.lit("")).alias("__body"))
    counts = materialise(texts.mapInArrow(_count_words, "word string, c long").groupBy("word")
                         .agg(F.sum("c").alias("c")), "lm-counts")
    n_texts = texts.count()
    total = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    # The most frequent words, by whole ranges of counts, as far as the table has room.
    grade = F.floor(F.log2("c") * 16).cast("int")
    room, lowest = table_size, None
    for r in sorted(counts.groupBy(grade.alias("g")).count().collect(), key=lambda r: -r.g):  # about 1000 rows at most
        if r["count"] > room:
            break
        room, lowest = room - r["count"], r.g
    top = counts.filter(grade >= lowest if lowest is not None else F.lit(False)).toPandas()
    top = top.sort_values(["c", "word"], ascending=[False, True])
    known = [w.encode() for w in top["word"]]
    vocabulary = Vocabulary(total[0] + n_texts, total[1] + (n_texts > 0), n_texts, {w: k for k, w in enumerate(known)},
                            top["c"].to_numpy(float), np.append(forms(known), 0), np.zeros(FORMS, np.int64), np.zeros(CLASSES),
                            np.ones(CLASSES))
    return vocabulary, counts


def encode(texts: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """Texts (``__id``, ``__held``, ``__body``) as codes, written once; all later passes read two bytes a token."""
    shared = texts.sparkSession.sparkContext.broadcast(vocabulary)
    return materialise(texts.mapInArrow(_encoded(shared), _ENCODED).withColumn("uid", F.monotonically_increasing_id()), "lm-codes")


def learn(encoded: DataFrame, vocabulary: Vocabulary, counts: DataFrame, rounds: int = 6, rate: float = 0.1, tasks: int = 8) -> Weights:
    """Learn classes (into ``vocabulary``) and weights from all encoded texts.

    Classes are learned from the neighbours of all words, and their totals counted over all words.  The
    model's training data are the counts of all its
    trigrams of symbols, at most 2^24 rows however large the corpus.  Weights start
    from the symbols' own counts; each of ``rounds`` rounds then sums the gradient
    of ``tasks`` tasks, block by block, and takes an Adam step with it on the driver.
    """
    spark = encoded.sparkSession
    codes = encoded.select("codes")
    beside = np.zeros(FORMS * 2 * _SIDES)
    got = (codes.mapInArrow(_count_neighbours, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
           .toPandas())  # at most 2^20 rows
    beside[got.cell.to_numpy(int)] = got.n.to_numpy()
    vocabulary.form_class = form_classes(beside.reshape(FORMS, -1))
    shared = spark.sparkContext.broadcast(vocabulary)
    got = (counts.mapInArrow(_count_forms(shared), "f long, tokens long, words long")
           .groupBy("f").agg(F.sum("tokens").alias("tokens"), F.sum("words").alias("words")).toPandas())  # at most 2^12 rows
    of = vocabulary.form_class[got.f.to_numpy(int)]
    vocabulary.class_tokens = np.bincount(of, got.tokens.to_numpy(float), minlength=CLASSES)
    vocabulary.class_total = vocabulary.class_tokens + np.bincount(of, got.words.to_numpy(float), minlength=CLASSES) + 1
    symbol = spark.sparkContext.broadcast(vocabulary.symbol_of_code())
    grams = materialise(
        codes.mapInArrow(_count_trigrams(symbol), "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))
        .select("code", "n", F.pmod(F.xxhash64("code"), F.lit(tasks)).cast("int").alias("task")), "lm-trigrams")
    tokens = max(vocabulary.tokens, 1)

    def after(word: Column) -> np.ndarray:
        table = np.zeros((SYMBOLS, SYMBOLS))
        got = grams.groupBy(word.alias("w"), (F.col("code") % SYMBOLS).alias("y")).agg(F.sum("n").alias("n")).toPandas()
        table[got.w.to_numpy(int), got.y.to_numpy(int)] = got.n.to_numpy()
        return table

    weights = Weights.start(vocabulary.symbols, after(F.floor(F.col("code") / SYMBOLS) % SYMBOLS),
                            after(F.floor(F.col("code") / (SYMBOLS * SYMBOLS))))
    moments = [[np.zeros_like(x), np.zeros_like(x)] for x in (weights.of_class, weights.of_symbol)]
    for k in range(1, rounds + 1):
        current = spark.sparkContext.broadcast(weights)
        blocks = "block int, loss double, cells binary"
        got = (grams.groupBy("task").applyInPandas(_gradients(current), blocks)
               .groupBy("block").applyInPandas(_add_blocks, blocks).collect())  # the gradient once, in blocks
        if not got:
            break
        cells = np.concatenate([_long(r.cells) for r in sorted(got, key=lambda r: r.block)])
        cells = cells.reshape(ROWS, SIDE + SIDE * SIDE).astype(float) / tokens
        total = {"of_class": cells[:, :SIDE], "of_symbol": cells[:, SIDE:].reshape(ROWS, SIDE, SIDE)}
        for name, (m, v) in zip(total, moments, strict=True):
            m += 0.1 * (total[name] - m)
            v += 0.01 * (total[name] ** 2 - v)
            step = rate * (m / (1 - 0.9 ** k)) / (np.sqrt(v / (1 - 0.99 ** k)) + 1e-6)
            setattr(weights, name, (getattr(weights, name) - step).astype(np.float32))
        current.destroy()
    return weights


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("__id"), held_out(id_col).alias("__held"),
                       F.coalesce(text_col, F.lit("")).alias("__body"))


def fit(train: DataFrame, text_col: str = "text", table_size: int = 1 << 17, **parameters) -> tuple[Vocabulary, DataFrame, Weights]:
    """Learn from every row of ``train``: (vocabulary, all word counts, weights)."""
    vocabulary, counts = count(train, text_col, table_size)
    texts = train.select(F.lit(0).cast("long").alias("__id"), F.lit(False).alias("__held"), F.coalesce(text_col, F.lit("")).alias("__body"))
    return vocabulary, counts, learn(encode(texts, vocabulary), vocabulary, counts, **parameters)


def _model_scores(model):
    """uid and the model's part of each text's score, without the counts of words inside their classes."""
    def run(batches):
        symbol, class_total, weights = model.value
        inside = np.zeros(SYMBOLS)
        inside[WORDS:END] = np.log10(class_total)  # a word's share in its class has this total
        for b in slices(batches, 256):
            grams, n = _trigrams(column(b, "codes"), symbol)
            if not len(n):
                continue
            code, where = np.unique(grams, return_inverse=True)
            lp = weights.log_probability(code // SYMBOLS, code % SYMBOLS) / np.log(10) - inside[code % SYMBOLS]
            total = np.add.reduceat(lp[where], np.cumsum(n) - n)
            yield pa.RecordBatch.from_arrays(
                [*(b.column(b.schema.get_field_index(c)) for c in _KEPT), pa.array(total)], names=[*_KEPT, "model"])

    return run


_KEPT = ("uid", "doc_id", "held_out", "n_tokens", "known", "base", "inside")


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", table_size: int = 1 << 17,
                    **parameters) -> DataFrame:
    """Train on the rows that aren't held out, then score all whole texts.

    Returns one row per input row: ``doc_id``, ``held_out``, ``n_tokens`` (words and
    one end), ``n_known``, ``train_tokens``, ``base_score`` (add-one unigrams) and
    ``score`` (the maximum-entropy model), both log10 of the text's probability.  A
    null text is the empty one: only its end.  Null ids are passed on, and learned
    from.  With no training text, all counts are zero and words are as likely as an
    unknown one.

    The model gives a token's symbol from the two symbols before it; a word without a symbol of its own
    has that of its class, and within the class its share follows its count, so the
    probabilities of all words, an unknown one in each class and the end sum to one.

    Plan: a pass counts the words of the texts learned from, a second one writes all texts as codes of two bytes a word;
    learning and scoring read the codes.  Words in a bounded table of the most frequent ones, which hold most tokens,
    are looked up where texts are read.  Only the others, once per document, are joined
    with the full counts, so no frequent word is a hot key there.
    """
    source = _texts(docs, id_col, text_col)
    vocabulary, counts = count(source.filter("not __held"), "__body", table_size)
    encoded = encode(source, vocabulary)
    weights = learn(encoded.filter("not held_out"), vocabulary, counts, **parameters)
    model = docs.sparkSession.sparkContext.broadcast((vocabulary.symbol_of_code(), vocabulary.class_total, weights))
    parts = encoded.select(*_KEPT, "codes").mapInArrow(
        _model_scores(model), "uid long, doc_id long, held_out boolean, n_tokens long, known long, base double, inside double, model double")
    rare = (encoded.select("uid", F.explode("rare").alias("r")).select("uid", "r.word", "r.m")
            .join(counts, "word").groupBy(F.col("uid").alias("rid"))
            .agg(F.sum("m").alias("more"), F.sum(F.col("m") * F.log10(F.col("c") + 1)).alias("logs")))
    logs = F.coalesce("logs", F.lit(0.0))
    floor = float(np.log10(vocabulary.tokens + vocabulary.distinct + 1))
    return parts.join(rare, F.col("uid") == F.col("rid"), "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("known") + F.coalesce("more", F.lit(0))).alias("n_known"),
        F.lit(vocabulary.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + logs - F.col("n_tokens") * floor).alias("base_score"),
        (F.col("model") + F.col("inside") + logs).alias("score"))

from __future__ import annotations

import random
from collections import defaultdict
from zlib import crc32

import numpy as np
import pytest

from cafetal.llm import registry, toxicity
from cafetal.llm.toxicity import BITS, pair_keys, word_ids
from tests.conftest import SF_MID
from tests.llm.helpers import docs

BAD = ["idiot", "scum", "vermin", "Ékel"]


def corpus(n=1200, seed=4):
    r = random.Random(seed)
    vocab = [f"{a}{b}{c}" for a in "bcdfg" for b in "aeiou" for c in ["n", "rs", "lt", "éx", "m", "st"]]
    rows, labels = [], []
    for i in range(n):
        words = r.choices(vocab, k=r.choice([8, 40, 300]))
        toxic = i % 6 == 0
        if toxic:
            for _ in range(max(1, len(words) // 40)):
                words[r.randrange(len(words))] = r.choice(BAD) + r.choice([".", "!", ""])
        rows.append((i, " ".join(words).capitalize()))
        labels.append((i, 1, int(toxic)))
    # a clean text copied very often: its words must not become signs of a class
    rows += [(n + k, "Praised be the oft copied clean text of many words") for k in range(300)]
    labels += [(n + k, 0, 0) for k in range(300)]
    return rows, labels


def label_table(spark, labels):
    return spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def fitted(spark):
    rows, labels = corpus()
    d, y = docs(spark, rows), label_table(spark, labels)
    return rows, labels, d, y, toxicity.train(d, y.filter(toxicity.fold() != 0))


def test_held_out_accuracy(spark, fitted):
    rows, labels, d, _, model = fitted
    y = {i: t for i, _, t in labels}
    got = {r.doc_id: r for r in toxicity.score(d, model).collect()}
    held = [i for i in y if crc32(str(i).encode()) % 5 == 0]
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got.values())
    wrong = [i for i in held if got[i].predicted != y[i]]
    assert len(wrong) <= 0.03 * len(held)


def test_counts_match_brute_force(fitted):
    """The lower order's probabilities, from counts made without Spark."""
    rows, labels, _, _, model = fitted
    import xxhash

    y = {i: t for i, _, t in labels if crc32(str(i).encode()) % 5}
    seen, left = set(), [defaultdict(set), defaultdict(set)]
    for i, t in rows:
        h = xxhash.xxh64_intdigest(t.encode(), 42)
        h = h - (1 << 64) if h >> 63 else h
        if i in y and t not in seen and h % 5:
            seen.add(t)
            for k in pair_keys(word_ids(t)).tolist():
                left[y[i]][k & ((1 << BITS) - 1)].add(k)
    n = np.zeros((2, 1 << BITS))
    for c in (0, 1):
        for u, ks in left[c].items():
            n[c, u] = len(ks)
    total = n.sum(axis=1)
    both = np.zeros(1 << BITS)
    for u in {*left[0], *left[1]}:
        both[u] = len(left[0][u] | left[1][u])
    shared = np.maximum(both - 0.75, 0) / both.sum()
    shared += (1 - shared.sum()) / len(shared)
    for c in (0, 1):
        own = np.maximum(n[c] - 3 - 2 * total[c] * (n[1 - c] + 3) / total[1 - c], 0) / total[c]
        want = own + (1 - own.sum()) * shared
        assert np.allclose(model.word[c], want, rtol=1e-4, atol=1e-12)
        assert abs(model.word[c].sum(dtype=float) - 1) < 1e-3
    bad = int(word_ids("idiot")[0])
    assert model.word[1, bad] > 2 * model.word[0, bad]


def test_edges(spark, fitted):
    *_, model = fitted
    odd = [(1, None), (2, ""), (None, "x"), (3, "123 !!"), (3, "123 !!"), (4, "word " * 60_000), (5, "Ékel \x00 ퟿")]
    d = docs(spark, odd).selectExpr("*", "1 as score", "2 as __body", "'x' as toxic")
    got = toxicity.score(d, model).collect()
    assert len(got) == len(odd) and all(0 <= r.score <= 1 for r in got)
    assert {r.score for r in got if r.doc_id in (1, 2)} == {model.score("")} and model.score("") < 0.5
    assert toxicity.score(d.filter("false"), model).count() == 0


@pytest.mark.parametrize("labels", [[], [(1, 1, 0)], [(None, 1, 1), (1, None, None)], [(1, 1, 1), (77, 1, 0)]])
def test_few_or_no_labels(spark, labels):
    d = docs(spark, [(1, "some text here"), (2, None)])
    model = toxicity.train(d, label_table(spark, labels))
    assert all(0 <= r.score <= 1 for r in toxicity.score(d, model).collect())
    assert model.score("") < 0.5


def test_query_on_given_tables(spark):
    got = registry.op3_toxicity(spark, SF_MID)
    y = spark.read.parquet(f"{SF_MID}/labels.parquet")
    pdf = got.join(y, "doc_id").filter("held_out").toPandas()
    assert (pdf.predicted == pdf.toxic).mean() >= 0.9
    assert got.count() == spark.read.parquet(f"{SF_MID}/documents.parquet").count()

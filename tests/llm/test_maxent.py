from __future__ import annotations

import math
import random
import re
from collections import Counter
from zlib import crc32

import numpy as np
import pytest

from cafetal.llm import maxent
from cafetal.llm.maxent import CLASSES, END, ROWS, SIDE, SYMBOLS, WORDS, Weights, feature_rows, score_documents
from tests.llm.helpers import docs

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def tokens(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))


def held(i):
    return i is not None and crc32(str(i).encode()) % 7 == 2


def corpus(n=500, seed=2):
    """Two topics with words of their own, so that the words before say something of the next."""
    r = random.Random(seed)
    vocab = [[f"{a}{x}" for x in range(150)] for a in ("north", "south")]
    common = ["the", "of", "and", "Être", "\x85x"]
    rows = []
    for i in range(n):
        own = vocab[i % 2]
        rows.append((i, " ".join(r.choice(common) if r.random() < 0.4 else own[int(r.paretovariate(0.7)) % 150]
                                 for _ in range(r.choice([4, 40, 200])))))
    return rows + [(1000, None), (1001, ""), (1002, " \n"), (1003, "unseen words"), (1004, "THE\tthe\x0bthe"),
                   (1005, "x" * 50_000), (1006, "the " * 30_000), (None, "the of null"), (5, "the"), (5, "the")]


def base(rows):
    c = Counter()
    for i, t in rows:
        if not held(i):
            c.update([*tokens(t), None])  # None: the end
    n, v = sum(c.values()), len(c)
    return {k: (held(i), len(tokens(t)) + 1, sum(c[w] > 0 for w in [*tokens(t), None]), n,
                sum(math.log10((c[w] + 1) / (n + v + 1)) for w in [*tokens(t), None])) for k, (i, t) in enumerate(rows)}


@pytest.mark.parametrize("table_size", [10, 1 << 17])
def test_base_matches_brute_force(spark, table_size):
    rows = corpus()
    d = docs(spark, rows).selectExpr("*", "1 as base", "2 as uid", "3 as word", "4 as score")
    got = sorted(score_documents(d, table_size=table_size, rounds=2).collect(), key=lambda r: (str(r.doc_id), r.n_tokens))
    want = sorted(zip(rows, base(rows).values(), strict=True), key=lambda x: (str(x[0][0]), x[1][1]))
    assert len(got) == len(rows)
    for g, ((i, _), w) in zip(got, want, strict=True):
        assert (g.doc_id, g.held_out, g.n_tokens, g.n_known, g.train_tokens) == (i, *w[:4])
        assert math.isclose(g.base_score, w[4], rel_tol=1e-9)
        assert g.score < 0 and math.isfinite(g.score)


def test_model_beats_unigrams_on_held_out_texts(spark):
    rows = [r for r in corpus(1500) if r[0] is not None and r[0] < 1000 or r[0] is None]
    got = [r for r in score_documents(docs(spark, rows)).collect() if r.held_out]
    n = sum(r.n_tokens for r in got)
    assert sum(r.score for r in got) / n > sum(r.base_score for r in got) / n + 0.02


def test_probabilities_sum_to_one(spark):
    rows = corpus(200)
    vocabulary, counts, weights = maxent.fit(docs(spark, [r for r in rows if not held(r[0])]), table_size=300, rounds=2)
    for context in (END * SYMBOLS + END, 3 * SYMBOLS + 1, 0):
        p = np.exp(weights.log_probability(np.full(SYMBOLS, context), np.arange(SYMBOLS)))
        assert math.isclose(p.sum(), 1, rel_tol=1e-9)
    c = {r.word: r.c for r in counts.collect()}
    share, tokens_of = np.ones(CLASSES), np.zeros(CLASSES)
    for w, n in c.items():
        if not 0 <= vocabulary.place.get(w.encode(), -1) < WORDS:
            k = vocabulary.form_class[crc32(w.encode()[-3:]) % maxent.FORMS]
            share[k] += n + 1
            tokens_of[k] += n
    assert np.array_equal(share, vocabulary.class_total) and np.array_equal(tokens_of, vocabulary.class_tokens)
    assert vocabulary.tokens == sum(c.values()) + vocabulary.texts == vocabulary.symbols.sum()


def test_scores_match_a_plain_second_implementation(spark):
    """The model's own weights and counts, applied token by token with dictionaries."""
    rows = corpus(120)
    train = docs(spark, [r for r in rows if not held(r[0])])
    v, counts, w = maxent.fit(train, table_size=200, rounds=2)
    c = {r.word: r.c for r in counts.collect()}
    rank = {x: k for k, x in enumerate(sorted(c, key=lambda x: (-c[x], x)))}

    def symbol(word):
        if word is None:
            return END
        if word in rank and rank[word] < WORDS:
            return rank[word]
        return WORDS + int(v.form_class[crc32(word.encode()[-3:]) % maxent.FORMS])

    def log_p(skip, last, y):
        f = feature_rows(np.array([skip * SYMBOLS + last]))[0]
        out = 0.0
        for table, at in ((w.of_class, y // SIDE), (w.of_symbol[:, y // SIDE], y % SIDE)):
            z = [sum(float(table[r][k]) for r in f) for k in range(SIDE)]
            out += z[at] - max(z) - math.log(sum(math.exp(x - max(z)) for x in z))
        return out / math.log(10)

    got = {r.doc_id: r.score for r in score_documents(docs(spark, rows), table_size=200, rounds=2).collect() if r.doc_id is not None}
    for i, text in rows:
        if i is None or i in (5, 1005, 1006):
            continue
        ys, total = [END, END], 0.0
        for word in [*tokens(text), None]:
            y = symbol(word)
            total += log_p(ys[-2], ys[-1], y)
            if WORDS <= y < END:
                total += math.log10((c.get(word, 0) + 1) / v.class_total[y - WORDS])
            ys.append(y)
        assert math.isclose(got[i], total, rel_tol=1e-5), i


def test_classes_follow_the_company_words_keep():
    """Endings of words that stand between the same frequent words fall together."""
    r = np.random.default_rng(1)
    kind = r.integers(0, 3, maxent.FORMS)
    shares = r.dirichlet(np.full(2 * maxent._SIDES, 0.1), 3)
    beside = np.stack([r.multinomial(400, shares[k]) for k in kind]).astype(float)
    label = maxent.form_classes(beside)
    for k in np.unique(label):
        assert len(set(kind[label == k])) == 1


def test_gradient_matches_differences():
    r = np.random.default_rng(0)
    w = Weights(r.standard_normal((ROWS, SIDE)) * 0.1, r.standard_normal((ROWS, SIDE, SIDE)) * 0.1)
    context, y, n = r.integers(0, SYMBOLS**2, 40), r.integers(0, SYMBOLS, 40), r.integers(1, 9, 40)
    loss, g = w.gradient(context, y, n)
    assert math.isclose(loss, -float(n @ w.log_probability(context, y)), rel_tol=1e-9)
    f = feature_rows(context)
    for row, c, k in ((0, 3, 4), (f[5, 1], y[5] // SIDE, y[5] % SIDE), (f[7, 3], y[7] // SIDE, 0)):
        for table, grad, at in ((w.of_class, g.of_class, (row, c)), (w.of_symbol, g.of_symbol, (row, c, k))):
            table[at] += 1e-5
            up = w.gradient(context, y, n)[0]
            table[at] -= 2e-5
            down = w.gradient(context, y, n)[0]
            table[at] += 1e-5
            assert math.isclose((up - down) / 2e-5, grad[at], rel_tol=1e-4, abs_tol=1e-5)


def test_empty_and_untrained(spark):
    assert score_documents(docs(spark, ["x"]).filter("false")).count() == 0
    only = [i for i in range(100) if held(i)][:2]
    got = score_documents(docs(spark, [(only[0], "a b"), (only[1], None)])).collect()
    assert all((r.n_known, r.train_tokens, r.base_score) == (0, 0, 0.0) and r.score <= 0 for r in got)
    assert END == SYMBOLS - 1 == WORDS + CLASSES

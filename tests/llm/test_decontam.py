from __future__ import annotations

import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from cafetal.llm.decontam import (Index, Item, Space, common_subsequence, find_leaks, inverse_frequencies, latent_features,
                                  randomised_svd, tokens)
from tests.llm.helpers import docs


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        old = row
        row = [0]
        for j, y in enumerate(b):
            row.append(old[j] + 1 if x == y else max(old[j + 1], row[j]))
    return row[-1]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 4), max_size=40), st.lists(st.integers(0, 4), max_size=40))
def test_common_subsequence(a, b):
    assert common_subsequence(np.array(a, np.uint32), np.array(b, np.uint32)) == lcs(a, b)


R = random.Random(8)
VOCAB = [f"{a}{b}{c}{d}" for a in "bcdfglm" for b in "aeiou" for c in "nrst" for d in ("", "el", "ing", "ö")]
COMMON = ["the", "of", "and", "is"]


def prose(n):
    return [R.choice(VOCAB) if R.random() < 0.6 else R.choice(COMMON) for _ in range(n)]


def sentences(words):
    return ". ".join(" ".join(words[k:k + 9]).capitalize() for k in range(0, len(words), 9)) + "."


ITEMS = [(k, sentences(prose(R.choice([12, 25, 40, 70, 150])))) for k in range(60)]


def changed(text, share):
    words = text.split()
    for k in R.sample(range(len(words)), int(share * len(words))):
        words[k] = "changed" + R.choice(VOCAB)
    return " ".join(words)


def corpus():
    """(rows, the item that each row surely holds or None)."""
    rows, truth = [], {}
    for i in range(400):
        body, item = prose(R.choice([5, 60, 300, 2000])), None
        if i % 4 == 0:
            item = ITEMS[R.randrange(len(ITEMS))]
            text = [item[1], item[1].upper(), item[1].replace(" ", "\n"), changed(item[1][:-30], 0.1) + item[1][-30:]][
                i // 4 % 4]
            at = R.randrange(len(body) + 1)
            body = [*body[:at], text, *body[at:]]
        rows.append((i, " ".join(body)))
        truth[i] = item and item[0]
    return rows, truth


def benchmark(spark, items=None):
    return spark.createDataFrame(ITEMS if items is None else items, "item_id long, text string")


def test_planted_passages_and_brute_force(spark):
    rows, truth = corpus()
    got = {r.doc_id: r for r in find_leaks(docs(spark, rows), benchmark(spark)).collect()}
    assert len(got) == len(rows)
    # every passage against every item, without retrieval
    items = [Item(i, t, None) for i, t in ITEMS]
    for i, text in rows:
        words, want = tokens(text), set()
        for item in items:
            n = len(item.toks)
            for half in range(-(-len(words) // 32)):
                share, answer = item.check(words[max(0, half * 32 - n):(half + 2) * 32 + n], 0.8)
                if share >= 0.8 and (answer or share >= 0.95):
                    want.add(item.id)
                    break
        r = got[i]
        assert (r.contaminated, r.n_items) == (bool(want), len(want)), i
        assert r.item_id in want if want else r.item_id is None
    caught = [got[i].item_id == k for i, k in truth.items() if k is not None]
    assert sum(caught) >= 0.97 * len(caught)
    assert not [i for i, k in truth.items() if k is None and got[i].contaminated]


def test_blocks_and_repeats(spark):
    rows = [(k, f"Before it. {t} After it") for k, t in ITEMS]
    many = ITEMS + [(500 + k, t) for k, t in ITEMS] + ITEMS + [(None, "x y z"), (900, None), (901, "..."), (902, "")]
    got = find_leaks(docs(spark, rows), benchmark(spark, many), block=50).collect()
    assert all(r.contaminated and r.n_items == 2 and r.item_id == r.doc_id and r.lcs == 1.0 for r in got)


def test_answers(spark):
    text = ITEMS[2][1]
    q = spark.createDataFrame([(1, text, "forty two"), (2, ITEMS[3][1], None)], "item_id long, text string, answer string")
    loose = changed(text, 0.12)
    rows = [(1, loose + " forty two"), (2, loose + " no idea"), (3, text), (4, ITEMS[3][1])]
    others = [(100 + k, " ".join(prose(60))) for k in range(20)]  # else its words are in most passages
    got = {r.doc_id: (r.item_id, r.answer) for r in find_leaks(docs(spark, rows * 9 + others), q).collect()}
    assert {k: v for k, v in got.items() if k < 100} == {1: (1, True), 2: (None, None), 3: (1, False), 4: (2, True)}


def test_edges(spark):
    odd = [(1, None), (2, ""), (None, ITEMS[0][1]), (3, "!!"), (4, "word " * 50_000), (5, ITEMS[0][1]), (5, ITEMS[0][1])]
    d = docs(spark, odd * 3).selectExpr("*", "1 as item_id", "2 as __toks", "3 as answer")
    got = find_leaks(d, benchmark(spark), common=0.9).collect()
    assert sorted((str(r.doc_id), r.item_id) for r in got if r.contaminated) == [("5", 0)] * 6 + [("None", 0)] * 3
    assert len(got) == len(odd) * 3
    assert find_leaks(d.filter("false"), benchmark(spark)).count() == 0
    for items in ([], [(None, "some text"), (4, None), (5, "?!")]):
        none = find_leaks(d, benchmark(spark, items)).collect()
        assert len(none) == len(odd) * 3 and not any(r.contaminated for r in none)


def table_of(spark, texts, parts=4):
    rows = [(bytearray(tokens(t).tobytes()),) for t in texts]
    return spark.createDataFrame(rows, "__toks binary").repartition(parts)


def space_of(toks, items, common=0.9):
    idf, counts = inverse_frequencies(toks, common)
    return Space(latent_features(items, idf, counts), idf)


def test_svd_of_the_passages_matches_numpy(spark):
    """The passages are topical, so that the leading singular values stand apart."""
    r = random.Random(3)
    topics = [r.sample(VOCAB, 12) for _ in range(6)]
    texts = [" ".join(r.choice(topics[k % 6]) if r.random() < 0.9 else r.choice(VOCAB) for _ in range(r.choice([30, 64, 300])))
             for k in range(300)]
    toks = table_of(spark, texts)
    space = space_of(toks, [Item(0, texts[0], None)])
    v = randomised_svd(toks, space, 6)
    rows = []
    for t in texts:
        ids = tokens(t)
        for k in range(0, len(ids), 64):
            f = ids[k:k + 64] & ((1 << 18) - 1)
            a = np.zeros(len(space.names))
            np.add.at(a, np.searchsorted(space.names, f), space.idf[f])
            rows.append(a / np.sqrt((space.idf[f].astype(float) ** 2).sum()))
    a = np.stack(rows)
    _, sv, right = np.linalg.svd(a, full_matrices=False)
    assert np.allclose(v.T @ v, np.eye(6), atol=1e-5)
    assert np.linalg.norm(a @ v) ** 2 > 0.97 * (sv[:6] ** 2).sum()          # nearly all the energy of six dimensions
    assert np.linalg.svd(right[:6] @ v)[1].min() > 0.8                       # nearly the same subspace


def test_latent_space_finds_what_words_miss(spark):
    """Words that occur together in the corpus stand for each other; plain TF-IDF at the same limit sees nothing."""
    r = random.Random(4)
    topics = [[f"t{k}w{i}" for i in range(40)] for k in range(8)]
    texts = [" ".join(r.choice(topics[k % 8]) for _ in range(64)) for k in range(800)]
    item = Item(1, " ".join(topics[2][:20]), None)
    paraphrase = " ".join(topics[2][20:] * 2)                                # other words of the topic, none of the item's
    other = " ".join(topics[5][20:] * 2)
    toks = table_of(spark, texts)
    space = space_of(toks, [item])
    index = Index([item], space, randomised_svd(toks, space, 8))
    raw = [tokens(t).tobytes() for t in (paraphrase, other)]
    assert not index.candidates(raw, 0.2, 2.0)
    found = index.candidates(raw, 2.0, 0.45)
    assert set(found) == {(0, 0)} and len(index.vectors[0]) == 8 < len(space.names)


def test_plain_cosines_are_tf_idf(spark):
    toks = table_of(spark, [t for _, t in ITEMS])
    items = [Item(i, t, None) for i, t in ITEMS[:7]] + [Item(99, " ".join(t for _, t in ITEMS[:9]), None)]
    space = space_of(toks, items, 0.5)
    index = Index(items, space, np.zeros((len(space.names), 1)))
    raw = [tokens(t).tobytes() for _, t in ITEMS] + [b""]

    def vector(ids):
        f = ids & ((1 << 18) - 1)
        a = np.zeros(1 << 18)
        np.add.at(a, f, space.idf[f])
        return a, np.sqrt((space.idf[f].astype(float) ** 2).sum())

    for k, plain, _, (text, half) in index.cosines(raw):
        for i in range(0, len(plain), 3):
            a, norm = vector(np.frombuffer(raw[text[k + i]], np.uint32)[half[k + i] * 32:half[k + i] * 32 + 64])
            for u, (j, at) in enumerate(index.unit):
                end = at + 128 if (j, at + 128) in index.unit else None
                b, _ = vector(items[j].toks[at:end])
                assert abs(plain[i, u] - a @ b / max(norm, 1e-6) / max(np.linalg.norm(b), 1e-9)) < 1e-4


def test_items_of_all_lengths(spark):
    """Items of 20 to 3,000 words, word for word and with a fifth of their words changed, against brute force."""
    r = random.Random(6)
    vocab = [f"{a}{b}" for a in VOCAB for b in ("", "ka", "lo", "mu", "pe")]

    def text(n):
        return " ".join(r.choice(vocab) if r.random() < 0.6 else r.choice(COMMON) for _ in range(n))

    items, rows = [], []
    for size in (20, 200, 1000, 3000):
        for k in range(12):
            body = text(size)
            items.append((len(items), body))
            loose = body.split()
            for i in r.sample(range(size - 12), int(0.17 * size)):
                loose[i] = "changed" + r.choice(VOCAB)
            for x in (body, " ".join(loose)):
                rows.append((len(rows), f"{text(r.choice([0, 50, 500]))} {x} {text(r.choice([0, 70]))}"))
    rows += [(1000 + k, text(700)) for k in range(50)]
    got = {x.doc_id: x for x in find_leaks(docs(spark, rows), benchmark(spark, items)).collect()}
    for k, t in rows:
        if k >= 1000:
            assert not got[k].contaminated
            continue
        words, item = tokens(t), Item(k // 2, items[k // 2][1], None)
        share = common_subsequence(item.toks, words) / len(item.toks)         # brute force: the item in order in the text
        assert share >= 0.8
    caught = [got[k].item_id == k // 2 for k, _ in rows if k < 1000]
    assert sum(caught) >= 0.95 * len(caught), [k for k, c in enumerate(caught) if not c]


def test_thousands_of_items_take_one_search(spark):
    r = random.Random(7)
    vocab = [f"{a}{b}{c}" for a in VOCAB for b in ("", "ka", "lo", "mu") for c in ("", "xi", "zu")]
    items = [(k, " ".join(r.choice(vocab) for _ in range(20))) for k in range(5000)]
    rows = [(k, f"some words before {items[k * 25][1]} and behind") for k in range(200)]
    df = find_leaks(docs(spark, rows), benchmark(spark, items))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 1
    assert [x.item_id for x in df.orderBy("doc_id").collect()] == [k * 25 for k in range(200)]


def test_many_items_keep_their_length(spark):
    r = random.Random(5)
    vocab = [f"{a}{b}" for a in VOCAB for b in ("", "ka", "lo", "mu", "pe")]

    def text(n):
        return " ".join(r.choice(vocab) if r.random() < 0.6 else r.choice(COMMON) for _ in range(n))

    items = [(k, text(r.choice([10, 14, 20, 30]))) for k in range(2000)]
    rows = [(k, f"{text(40)} {t} {text(40)}") for k, t in items]
    got = {x.doc_id: x for x in find_leaks(docs(spark, rows), benchmark(spark, items)).collect()}
    assert [k for k, t in rows if not Item(k, items[k][1], None).check(tokens(t), 0.8)[1]] == []  # brute force finds all
    assert [k for k, _ in rows if got[k].item_id != k] == []


def test_second_stretch_with_the_answer(spark):
    words = [f"fact{k}" for k in range(40)]
    item = ". ".join(" ".join(words[k:k + 10]) for k in (0, 10, 20)) + ". " + " ".join(words[30:]) + "."
    without = " ".join([*words[:30], *words[34:]])  # 36 of 40 words, 6 of 10 of the answer
    loose = " ".join(w if k % 6 or k >= 30 else f"other{k}" for k, w in enumerate(words))  # 35 of 40, whole answer
    gap = " ".join(f"gap{k}" for k in range(150))
    q = benchmark(spark, [(1, item)])
    rows = [(1, f"{without} {gap} {loose}"), (2, f"{loose} {gap} {without}"), (3, f"{without} {gap}"),
            (4, f"{without} {' '.join(gap.split()[:70])} {loose}")]
    rows += [(100 + k, " ".join(prose(60))) for k in range(40)]
    got = {r.doc_id: (r.item_id, r.lcs, r.answer) for r in find_leaks(docs(spark, rows), q).collect() if r.doc_id < 100}
    assert got == {k: (None, None, None) if k == 3 else (1, 0.875, True) for k in range(1, 5)}

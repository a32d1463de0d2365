from __future__ import annotations

import random
import re
from hashlib import sha256

import duckdb
from pyspark.sql import functions as F

from cafetal.llm import spotsigs as ss
from tests.conftest import SF_MID
from tests.llm.helpers import docs

COMMON = set(ss.ANCHORS)


def sigs(text):
    ws = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text))
    out = set()
    for i, w in enumerate(ws):
        chain = [x for x in ws[i + 1:] if x not in COMMON][:2]
        if w in COMMON and len(chain) == 2:
            out.add(" ".join([w, *chain]))
    if not out and ws:
        out = {" ".join(ws[i:i + 3]) for i in range(max(1, len(ws) - 2))}
    return sorted(out, key=str.encode)


def jaccard(a, b):
    a, b = set(a), set(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def brute(rows):
    """Rows of (id, text) with different texts where ids are equal; the order of such is taken from the result."""
    out = []
    for k, (i, text) in enumerate(rows):
        text, after = text or "", rows[(k + 1) % len(rows)][1] or ""
        cut = len(text) // 4
        edited = text[:len(text) - cut] + after[:cut]
        mine, other, nxt = sigs(text), sigs(edited), sigs(after)
        sha = lambda x: sha256(x.encode()).hexdigest()
        out.append((i, len(text), sha(edited), sha("\n".join(mine)), sha("\n".join(other)), jaccard(mine, other), jaccard(mine, nxt)))
    return sorted(out, key=str)


COLUMNS = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]


def run(df):
    return sorted((tuple(r) for r in ss.fingerprints(df).select(*COLUMNS).collect()), key=str)


TEXTS = ["The cat sat on the mat and the dog lay by the door of a house", "", None, "   ", "one", "one two", "one two three four",
         "of the and", "L'été DE la mer est à nous, le soleil brille", "das Haus und der Baum ist nicht von hier",
         "é" * 50, "the 🙂🙂 smile of a 👩‍👩‍👧 family the", "No stop", "and and and x y", "\x00\x01 the a\tb\nc"]


def test_texts(spark):
    rng = random.Random(2)
    long = " ".join(rng.choice(["the", "of", "word", "other", "third", "and"]) for _ in range(30_000))
    rows = [(i * 3 - 20, t) for i, t in enumerate([*TEXTS, long, "x" * 100_000, TEXTS[0], TEXTS[0]])]
    d = docs(spark, rows).selectExpr("*", "1 as __k", "2 as __h", "3 as near_next", "4 as edited")
    assert run(d) == brute(rows)


def test_null_and_repeated_ids(spark):
    rows = [(None, "a b c d e f g"), (2, "the cat sat on the mat"), (5, "more of the same text is here to read")]
    got = run(docs(spark, rows + [rows[1], rows[0]]))
    want = brute(rows)
    assert got == sorted(want + [w for w in want if w[0] in (2, None)], key=str)
    same = run(docs(spark, [(1, "the first text is short"), (1, "the second text is longer than that"), (2, "x")]))
    assert [r[0] for r in same] == [1, 1, 2] and len({r[3] for r in same}) == 3


def test_one_and_no_document(spark):
    assert run(docs(spark, [(7, "the cat sat on the mat")])) == brute([(7, "the cat sat on the mat")])
    assert run(docs(spark, [(7, "x")]).filter("false")) == []


def test_sql(spark):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{SF_MID}/documents.parquet'")
    names = [*COLUMNS, "n_signatures", "length_part", "next_id"]
    want = sorted((tuple(r) for r in con.sql(f"SELECT {', '.join(names)} FROM ({ss.ORACLE})").fetchall()))
    got = ss.fingerprints(spark.read.parquet(f"{SF_MID}/documents.parquet")).select(*names).collect()
    assert sorted(tuple(r) for r in got) == want
    # a quarter of the text is changed: most of the chains stay, and next documents have few in common
    mean = lambda k: sum(r[k] for r in want) / len(want)
    assert mean(5) > 0.5 and mean(6) < 0.1


def test_no_python_in_the_plan(spark):
    plan = ss.fingerprints(docs(spark, [(1, "the cat sat")]))._jdf.queryExecution().toString()
    assert not re.search(r"Python|Pandas|Arrow", plan)


def test_pruned_likeness(spark):
    rows = [([1, 2, 3], [1, 2, 3], 1.0), ([1], list(range(1, 11)), 0.0), (list(range(9)), list(range(10)), 0.9), ([], [], 1.0),
            ([], [1], 0.0)]
    df = spark.createDataFrame(rows, "a array<long>, b array<long>, want double")
    for r in df.withColumn("got", ss.likeness(F.col("a"), F.col("b"), 0.8)).collect():
        assert r.got == r.want
    parts = [r[0] for r in spark.range(0, 400).select(ss.length_part(F.sequence(F.lit(1), F.col("id").cast("int") + 1))).collect()]
    for i, a in enumerate(parts):
        for j, b in enumerate(parts[i:]):
            assert (i + 1) < 0.8 * (i + j + 1) or b - a <= 1

from __future__ import annotations

import hashlib
from collections import defaultdict

from cafetal.llm import linededup
from tests.llm.helpers import docs

UP, LOW = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SPACE = " \t\n\x0b\f\r"


def brute(rows):
    key = lambda line: line.strip(SPACE).translate(str.maketrans(UP, LOW))
    held = defaultdict(set)
    for i, t in rows:
        for line in (t or "").split("\n"):
            if i is not None and len(key(line)) >= 10:
                held[key(line)].add(i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        keep = [x for x in lines if i is None or len(held[key(x)]) < 2 or min(held[key(x)]) == i]
        out.append((i, len(lines), len(lines) - len(keep), hashlib.sha256("\n".join(keep).encode()).hexdigest()))
    return sorted(out, key=str)


CASES = [
    (5, "A shared line here\nunique to five\n\n"), (3, "  a SHARED line here\t\nown words of three"),
    (9, "a shared line here\na shared line here\nshort"), (11, None), (12, ""), (13, "\n\n"), (14, "short\nshort"),
    (15, "Ünïcode Zeile ÄÖ\nx"), (16, "ünïcode Zeile ÄÖ\nx"), (17, "Ünïcode zeile ÄÖ"), (18, "\x85padded line 18\x85"),
    (19, "padded line 18"), (20, "line " * 20_000 + "\n" + "many\n" * 5_000 + "a shared line here"),
    (None, "a shared line here"), (21, "same row twice in table"), (21, "same row twice in table"),
    (22, "same row twice in table"), (-4, "ten chars!\r\nnine char"), (23, "TEN chars!\nnine char"),
]


def test_matches_brute_force(spark):
    got = [tuple(r) for r in linededup.digest(linededup.dedup_lines(docs(spark, CASES))).collect()]
    assert sorted(got, key=str) == brute(CASES)


def test_hot_line_and_columns(spark):
    rows = [(i, f"the very common line\nown line number {i}") for i in range(300)]
    d = docs(spark, rows).selectExpr("*", "1 as n_lines", "2 as __hot", "'x' as line")
    out = linededup.dedup_lines(d)
    assert [c for c in out.columns if c not in d.columns] == ["n_dropped"] and "__hot" in out.columns
    kept = {r.doc_id: (r.text, r.n_lines) for r in out.collect()}
    assert kept[0] == (rows[0][1], 2) and kept[299] == ("own line number 299", 2)


def test_empty_table_and_nulls(spark):
    assert linededup.dedup_lines(docs(spark, [(1, "x")]).filter("false")).count() == 0
    nulls = spark.createDataFrame([(None, None, None, None, None)] * 2,
                                  "doc_id long, text string, lang string, source string, n_chars long")
    assert [r.text for r in linededup.dedup_lines(nulls).collect()] == ["", ""]


def test_threshold(spark):
    rows = [(1, "a line in two docs\na line in three docs"), (2, "a line in two docs\na line in three docs"),
            (3, "a line in three docs")]
    got = {r.doc_id: r.text for r in linededup.dedup_lines(docs(spark, rows), min_docs=3).collect()}
    assert got == {1: rows[0][1], 2: "a line in two docs", 3: ""}

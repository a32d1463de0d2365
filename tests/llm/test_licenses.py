from __future__ import annotations

import math
import random
import re
import textwrap

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cafetal.llm import licenses
from cafetal.llm.licenses import FAMILIES, PHRASES, TEMPLATES, TemplateIndex, digest, scan_licenses
from tests.llm.helpers import docs

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOW))


def brute_matches(text, threshold=0.8, templates=TEMPLATES):
    """Every stretch of words, however its lines break."""
    ws, out = words(text), set()
    for name, t in templates.items():
        own, longest = set(words(t)), math.ceil(len(words(t)) / threshold - 1e-9)
        blocks = []
        for last in range(len(ws)):
            best = max(((len(own.intersection(ws[first:last + 1])), first) for first in range(max(0, last - longest + 1), last + 1)),
                       default=(0, 0))
            if ws[last] in own and best[0] >= threshold * len(own) - 1e-9:
                blocks.append((-best[0], last - best[1], best[1], last))
        taken = []
        for n, _, first, last in sorted(blocks):
            if all(last < a or first > z for a, z in taken):
                taken.append((first, last))
                stretch = set(ws[first:last + 1])
                marks = {m for heads, ms in FAMILIES if own.intersection(heads) for m in ms}
                if stretch & marks == own & marks:
                    out.add((name.split("/")[0], first, last - first + 1, -n / len(own)))
    return sorted(out, key=lambda m: (m[1], m[2], m[0], m[3]))


def brute(i, text):
    ws = words(text)
    at = [(k, label) for p, label in PHRASES.items() for k in range(len(ws)) if ws[k:k + len(p.split())] == p.split()]
    base, m = {b for _, b in at}, brute_matches(text)
    return (i, len(ws), len(at), min((k for k, _ in at), default=None), max((k for k, _ in at), default=None),
            ",".join(sorted(base)), ",".join(sorted(base | {x[0] for x in m})),
            1.0 if at else max((x[3] for x in m), default=0.0))


def corpus():
    r = random.Random(3)
    lines = list(TEMPLATES.values()) + ["All rights reserved.", "the license of this work", "Tiwh enor. The", "",
                                        "cc", "by nobody", "ALL RIGHTS", "Reserved", "CC-BY", "général public license"]
    texts = []
    for _ in range(150):
        pick = []
        for x in r.choices(lines, k=r.randrange(1, 9)):
            ws = x.split()
            if r.random() < 0.5 and len(ws) > 4:
                ws.pop(r.randrange(len(ws)))
            if r.random() < 0.3 and ws:
                ws.insert(r.randrange(len(ws)), "\n")
            pick.append(" ".join(ws))
        texts.append("\n".join(pick))
    return texts + [None, "", "\n\n", "Ünï 1½ ço\x85de", "general public license " * 3000, "x" * 100_000,
                    "all rights reserved all rights reserved"]


def test_matches_brute_force(spark):
    rows = [*enumerate(corpus()), (None, "cc by"), (3, "repeated"), (3, "repeated")]
    d = docs(spark, rows).selectExpr("*", "1 as base", "2 as matches", "3 as n_words")
    got = digest(scan_licenses(d)).collect()
    assert sorted((tuple(r) for r in got), key=str) == sorted((brute(*x) for x in rows), key=str)
    assert sum(r.labels != r.base_labels for r in got) > 50
    full = {r.doc_id: [tuple(m) for m in r.matches] for r in scan_licenses(d).filter("doc_id > 3").collect()}
    assert all(full[i] == brute_matches(t) for i, t in rows if i is not None and i > 3)


def test_edges(spark):
    assert scan_licenses(docs(spark, ["x"]).filter("false")).count() == 0
    assert scan_licenses(docs(spark, ["the mit license"]), templates={}).first().matches == []


@pytest.mark.parametrize("threshold", [0.5, 0.8, 1.0])
@settings(max_examples=120, deadline=None)
@given(data=st.data())
def test_filters_lose_nothing(threshold, data):
    word = st.sampled_from("abcdefgh")
    templates = data.draw(st.dictionaries(st.sampled_from("TUVW"), st.lists(word, min_size=1, max_size=7)
                                          .map(" ".join), min_size=1))
    freq = {w.encode(): data.draw(st.integers(0, 5)) for w in "abcdefgh"}
    index = TemplateIndex(templates, threshold, freq)
    text = " ".join(data.draw(st.lists(st.sampled_from("abcdefghxyz"), max_size=40)))
    assert index.matches(licenses.words(text)) == brute_matches(text, threshold, templates)
    assert licenses.words("A-B c") == [b"a", b"b", b"c"]


def labels(text):
    return {m[0] for m in TemplateIndex(TEMPLATES, 0.8, {}).matches(licenses.words(text))}


@pytest.mark.parametrize("width", [10, 30, 40, 10_000])
@pytest.mark.parametrize("form", ["{}", "# {}", "{}\n", " * {}\n *"])
def test_wrapped_notices(width, form):
    for name, text in TEMPLATES.items():
        notice = "\n".join(form.format(x) for x in textwrap.wrap(text, width, break_on_hyphens=False, break_long_words=False))
        found = labels(f"Some words before\n\n{notice}\nand behind it")
        assert name.split("/")[0] in found, name
        # the same words far apart are no notice, on however many lines
        for gap in ("\n", " "):
            scattered = gap.join(w + gap + "other words from texts " * 20 for w in text.split())
            assert not labels(scattered), name


def test_siblings():
    assert labels("This work is licensed under the GNU General Public License, version 3.") == {"gpl-3.0"}
    assert labels("This work is licensed under the GNU Affero General Public License, version 3.") == {"agpl-3.0"}
    assert labels("licensed under the GNU Lesser General Public License") == {"lgpl"}
    assert labels("Licensed under CC BY 4.0") == {"cc-by-4.0"}
    assert labels("Licensed under CC BY-NC 4.0") == {"cc-by-nc-4.0"}
    assert labels("Licensed under CC BY-SA 4.0") == {"cc-by-sa-4.0"}
    assert labels("Licensed under a Creative Commons Attribution-NonCommercial 4.0 International License") == {"cc-by-nc-4.0"}


def test_labels_do_not_depend_on_line_breaks(spark):
    from tests.conftest import SF_MID

    index = TemplateIndex(TEMPLATES, 0.8, {})
    texts = [r.text for r in spark.read.parquet(f"{SF_MID}/documents.parquet").select("text").collect()]
    seen = set()
    for t in texts:
        got = index.matches(licenses.words(t))
        seen |= {m[0] for m in got}
        assert got == index.matches(licenses.words(t.replace("\n", " ")))
    assert "gpl-3.0" in seen and not seen & {"agpl-3.0", "lgpl"}

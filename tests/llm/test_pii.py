from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import xxhash

from cafetal.llm.pii import KINDS, TERM_KINDS, digest, find_personal_data, sanitise
from tests.llm.helpers import docs

CONTRACT = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(d):
    s = [int(x) for x in reversed(d)]
    return (sum(s[::2]) + sum(sum(divmod(2 * x, 10)) for x in s[1::2])) % 10 == 0


def base(text):
    out = []
    for k, kind in enumerate(KINDS):
        for m in re.finditer(CONTRACT[kind], text):
            v, d = m.group(), re.sub("[^0-9]", "", m.group())
            ok = {"email": True, "ip": all(int(x) <= 255 for x in v.split(".")) if kind == "ip" else True,
                  "card": 12 <= len(d) <= 19 and luhn(d), "phone": 9 <= len(d) <= 15}[kind]
            if ok:
                out.append((m.start(), k, m.end(), d if k > 1 else v.lower()))
    return sorted(out)


LETTERS = re.compile(r"[^\W\d_]+")


def signed(h):
    return h - (1 << 64) if h >> 63 else h


def term_hash(w, k):
    """Spark's xxhash64 of a string and an int: the first's hash is the second's seed."""
    return signed(xxhash.xxh64_intdigest(k.to_bytes(4, "little"), xxhash.xxh64_intdigest(w.encode(), 42)))


def groups(kind, v):
    """The value and its coarser group."""
    g = v[:6] if kind > 1 else v.split("@")[1] if kind == 0 else v.rpartition(".")[0]
    return {(kind, v), (kind, "group", g)}


def brute(rows, removed=0.74, generalised=0.6, least_bits=4.0):
    texts = [t or "" for _, t in rows]
    found = [base(t) for t in texts]
    words = [[(m.group().lower(), m.start(), m.end()) for m in LETTERS.finditer(t) if len(m.group()) >= 3] for t in texts]
    held = [set().union(*(groups(k, v) for _, k, _, v in f)) for f in found]
    n, c, df = Counter(), Counter(), Counter()
    for es, ws in zip(held, words, strict=True):
        n.update(es)
        df.update({w for w, _, _ in ws})
        c.update({(e, w) for e in es for w in {w for w, _, _ in ws}})
    rare = {w for w, d in df.items() if d > 1 and math.log2(len(rows) / d) >= least_bits}
    copies = defaultdict(lambda: (set(), set(), set()))
    for es, ws in zip(held, words, strict=True):
        mine = {w for w, _, _ in ws}
        least = [min((term_hash(x, k) for x in mine), default=None) for k in range(3)] if es else []
        for e in es:
            for w in mine & rare:
                for k, h in enumerate(least):
                    copies[e, w][k].add(h)

    def kind(e, w):
        k = sorted(map(len, copies[e, w]))[1] if w in rare else 0
        sure = c[e, w] / df[w] * k / (k + 1)
        return (k > 1 and sure >= generalised and math.log2(c[e, w] * len(rows) / (df[w] * n[e])) >= least_bits) * (
            len(KINDS) + (sure >= removed))

    out = []
    for (i, _), f, es, ws in zip(rows, found, held, words, strict=True):
        extra = [(s, k, e) for w, s, e in ws if (k := max((kind(x, w) for x in es), default=0))
                 and not any(a < e and s < b for a, _, b, _ in f)]
        names = (*KINDS, *TERM_KINDS)
        text = lambda xs: ",".join(f"{names[k]}:{s}:{e}" for s, k, e in xs)
        out.append((i, *(sum(x[1] == k for x in f) for k in range(4)),
                    hashlib.sha256(text([x[:3] for x in f]).encode()).hexdigest(), text(sorted([x[:3] for x in f] + extra))))
    return sorted(out, key=str)


ODD = [
    "mail a.b%x@y.com.z, a@b.c.d%x@y.z 1.2.3.4.5.6.7.8 4111 1111 1111 1111 +1 (555) 123-4567 x",
    "4111-1111-1111-1111 4111111111111111x 4111 1111 1111 1112 1.2.3.256 01.002.3.255 999.1.1.1", None, "", " ",
    "é@é a@b a@b.c a@b@c.d @x.y a@.b .@a-.-", "+1 234 +49(0)30-12345678.. +123456789012345678", "1." * 40,
    "+4111 1111 1111 1111", "9" * 6000, "1 " * 8000, "a" * 30_000, "a.b@c." * 500, "a@b.cc " * 400, "+1 234" * 400,
    "x" * 250 + " john a@b.cc smith " + "y" * 300, "Ünïcödé 😀 name a@b.cc 😀 Straße +1 202 555 0143 naïve 😀",
]


def corpus(seed=6):
    r = random.Random(seed)
    vocab = [f"{a}{b}{x}" for a in "bcdfgh" for b in "aeiouéü" for x in ["n", "rs", "tl", "m"]]
    seldom = ["".join(r.choices("abcdefghijklmnopqrstuvwxyz", k=7)) for _ in range(600)]
    rows = list(enumerate(ODD, 5000))
    people = [(f"user{k}@mail{k % 3}.org", f"+1 202 555 {1000 + k}", f"surname{chr(97 + k)}", f"town{chr(97 + k % 4)}")
              for k in range(12)]
    for i in range(500):
        words = r.choices(vocab, k=r.choice([3, 30, 200])) + r.choices(seldom, k=6)
        if i % 5 == 0:
            mail, phone, name, town = r.choice(people)
            at = r.randrange(len(words) + 1)
            words[at:at] = r.choice([[name, mail, town], [town.upper(), "call", phone, name], [mail, phone, name]])
        elif i % 17 == 0:
            words.insert(r.randrange(len(words)), r.choice(people)[r.choice([2, 3])])
        rows.append((i, " ".join(words)))
    rows += [(6000 + i, "the hot copy of Martha owner@hot.example with plenty") for i in range(40)]
    return [*rows, (None, "null id a@b.cc"), (1, rows[30][1]), (1, rows[30][1])]


def test_matches_brute_force(spark):
    rows = corpus()
    d = docs(spark, rows).selectExpr("*", "1 as base", "2 as __base", "'x' as term", "3 as entity")
    got = sorted((tuple(r) for r in digest(find_personal_data(d)).collect()), key=str)
    want = brute(rows)
    assert got == want
    assert sum("removed" in r[-1] for r in want) > 20 and any("generalised" in r[-1] for r in want)


def test_native_plan(spark):
    result = find_personal_data(docs(spark, ["a@b.cc"]))
    plan = result._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_sanitise(spark):
    days = "alfa bravo carla delta emilio fiona gustav hanna igor jana".split()
    rows = [(i, f"Write Smithson at s.m@x.org today, {d} {d}s") for i, d in enumerate(days[:5])]
    rows += [(10 + i, f"nothing to hide on day {i} {d} {d}s") for i, d in enumerate(days * 10)] + [(None, None), (200, "1.2.3.4")]
    rows += [(300 + i, "quiet words here") for i in range(200)]
    d = docs(spark, rows)
    got = {r.doc_id: r.text for r in sanitise(d).collect()}
    assert "[EMAIL]" in got[3]
    assert "Smithson" not in got[3] and "s.m@" not in got[3]
    assert got[15] == rows[10][1] and got[None] == "" and got[200] == "[IP]"
    assert sanitise(d).columns == d.columns and sanitise(d).count() == len(rows)


def test_empty_table(spark):
    assert digest(find_personal_data(docs(spark, ["x"]).filter("false"))).count() == 0


def filler(r, n):
    return " ".join("".join(r.choices("abcdefghijklmnopqrstuvwxyz", k=r.choice([4, 6, 8]))) for _ in range(n))


def test_evidence_rises_with_documents_not_with_rarity(spark):
    r = random.Random(1)
    rows = [(1, "see Rosamund one@xa.org " + filler(r, 20))]
    rows += [(k, f"see Theobald two@xb.org {filler(r, 20)}") for k in (2, 3)]
    rows += [(k, f"see Wilhelmina mail{k}@xc.org {filler(r, 20)}") for k in (4, 5, 6)]        # one domain, three addresses
    rows += [(k, "see Copied four@xd.org and only this again") for k in (7, 8, 9)]             # copies of one text
    rows += [(k, f"see Cornelia +1 202 555 01{k} {filler(r, 20)}") for k in (40, 41, 42)]      # one prefix
    rows += [(100 + i, f"see what we do and only this again today {filler(r, 20)}") for i in range(200)]
    got = {x.doc_id: x.spans for x in digest(find_personal_data(docs(spark, rows))).collect()}
    assert got[1] == "email:13:23" and got[7] == got[8] == "email:11:22"                       # one text is never enough
    assert got[2].startswith("generalised:4:12,email:") and got[3].startswith("generalised:4:12,email:")
    assert all(got[k].startswith("removed:4:14,email:") for k in (4, 5, 6))
    assert all(got[k].startswith("removed:4:12,phone:") for k in (40, 41, 42))
    assert not any(got[100 + i] for i in range(200))


def planted(seed=3):
    """Documents with entities, the names of their owners, and rare ordinary words around them."""
    r = random.Random(seed)
    vocabulary = filler(r, 3000).split()
    rows, names = [], {}
    for k in range(30):
        name = "name" + filler(r, 1)
        for _ in range(r.choice([2, 3, 5])):
            body = r.choices(vocabulary, k=80)
            at = r.randrange(80)
            rows.append((len(rows), " ".join([*body[:at], name, f"u{k}@dom{k}.net", *body[at:]])))
            names[len(rows) - 1] = name
    rows += [(1000 + k, " ".join(r.choices(vocabulary, k=80))) for k in range(600)]
    return rows, names


def test_precision_and_recall_of_planted_names(spark):
    rows, names = planted()
    text = dict(rows)
    hit = wrong = 0
    for r in find_personal_data(docs(spark, rows)).collect():
        for x in r.spans:
            if x.kind >= len(KINDS):
                right = text[r.doc_id][x.start:x.end] == names.get(r.doc_id)
                hit += right
                wrong += not right
    assert hit >= 0.95 * len(names) and wrong <= 0.05 * hit, (hit, len(names), wrong)


def test_document_of_many_entities_and_terms(spark):
    r = random.Random(9)
    big = " ".join(f"user{k}@list.example {filler(r, 4)}" for k in range(3000))
    rows = [(1, big), (2, big + " more"), (3, "owner user7@list.example is Rosamund " + filler(r, 9)),
            (4, "user9@list.example has Rosamund " + filler(r, 9))] + [(10 + k, filler(r, 30)) for k in range(60)]
    got = {x.doc_id: x for x in digest(find_personal_data(docs(spark, rows))).collect()}
    assert got[1].n_email == got[2].n_email == 3000 and got[3].n_email == 1


def test_far_terms(spark):
    r = random.Random(2)
    far = "Rosamund" + " so we go on" * 40 + " far@x.org" + " and so on we go" * 40 + " rosamund"
    rows = [(7000, far + " bbba"), (7001, "far@x.org" + " so on" * 60 + " Rosamund bbbb")]
    rows += [(k, filler(r, 5) + (" bbba" if k % 2 else " bbbb")) for k in range(100)]
    got = {x.doc_id: x.spans for x in digest(find_personal_data(docs(spark, rows), least_bits=3.0)).collect()}
    assert got == {x[0]: x[-1] for x in brute(rows, least_bits=3.0)}

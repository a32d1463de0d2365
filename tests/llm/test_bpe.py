from __future__ import annotations

import hashlib
import struct

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from cafetal.llm import bpe
from cafetal.llm.bpe import encode_documents, merge_long, tokenizer
from tests.llm.helpers import docs

PATH = public_tokenizers.path("word_bpe_49k.json")
LIB = Tokenizer.from_file(PATH)

CASES = [
    "It's WE'LL don't I'M 'd 's'' x", "<|endoftext|>a<|startoftext|> b <|endoftext|>", "ΣΑΣ ΟΔΟΣ.", "é Å Å ﬁ ½²Ⅷ一二٣x9",
    "a\x1cb\x1fc\x85d\xa0e f​g", " \x1c ", "İstanbul ŞİŞ ǅ ß ẞ", "🙂🙂👨‍👩‍👧 zero‍width", "\x00\x01\x7f", "a" * 3000, "xyz" * 900,
    "1234567890", "___--__..,,", "̀abc", "が ガ", "it’s", "हिन्दी ไทย العربية", "﻿bom", "<|EndOfText|> <|endoftext|", "",
    "   ", "\n\t", "x <|endoftext|>́y", "the the THE The", "word " * 5000, "日本語" * 100,
]


def want(text):
    got = LIB.encode(text or "", add_special_tokens=False)
    return got.ids, LIB.decode(got.ids, skip_special_tokens=False)


def encode(texts):
    return [(list(struct.unpack(f"<{len(r) // 4}I", r)), n.decode()) for r, n in tokenizer(bpe.read_spec(PATH)).encode_batch(texts)]


def test_cases_match_the_library():
    for text, got in zip(CASES, encode(CASES), strict=True):
        assert got == want(text), text[:60]


# letters of scripts whose classes no Unicode version has changed
ALPHABET = st.sampled_from(list("aeinorst'SLDMRE ΣσßéÉçñü1²½一二\t\n\x1c\x85\xa0́̈🙂-.,!<|>_")) | st.sampled_from(
    ["<|endoftext|>", "<|startoftext|>", "'ll", "the", "tion"])


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(ALPHABET, max_size=30).map("".join), max_size=6))
def test_random_texts_match_the_library(texts):
    assert encode(texts) == [want(t) for t in texts]


@settings(max_examples=50, deadline=None)
@given(st.text("abcdehinorst", min_size=2, max_size=60))
def test_heap_and_scan_agree(word):
    t = tokenizer(bpe.read_spec(PATH))
    parts = t.inner[list(word.encode())]
    (_, rows), = bpe.merge_words(parts[None, :].copy(), t.ranks)
    assert merge_long(parts.tolist(), t.ranks.single) == rows[0].tolist()


def test_memory_is_bounded_and_forgetting_is_harmless():
    t = bpe.WordBpe(bpe.read_spec(PATH))
    t.known.most = 10
    texts = [f"word{i} common text{i % 7}. new-{i}" for i in range(200)]
    for k in range(0, 200, 5):
        got = t.encode_batch(texts[k:k + 5])
        assert [n.decode() for _, n in got] == [want(x)[1] for x in texts[k:k + 5]]
        assert len(t.known) < 80


@pytest.mark.parametrize("digests", [True, False])
def test_documents(spark, digests):
    rows = [*enumerate(CASES), (None, "null id"), (99, None), (3, "repeated"), (3, "repeated")]
    d = docs(spark, rows).selectExpr("*", "1 as ids", "2 as n_tokens", "3 as __id")
    columns = [("ids_sha256", "decoded_sha256")] if digests else []
    got = sorted((tuple(r) for r in encode_documents(d, PATH, *columns).collect()), key=str)
    out = []
    for i, t in rows:
        ids, text = want(t)
        out.append((i, len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(),
                    hashlib.sha256(text.encode()).hexdigest()) if digests else (i, len(ids), ids, text))
    assert got == sorted(out, key=str)
    assert encode_documents(d.filter("false"), PATH).count() == 0


def test_decode(spark):
    ids, text = want("the license's text <|endoftext|>")
    d = spark.createDataFrame([(1, ids), (2, []), (3, None), (4, [10**6, ids[0]])], "k int, ids array<long>")
    got = {r.k: r.decoded for r in bpe.decode_documents(d, PATH).collect()}
    assert got == {1: text, 2: "", 3: None, 4: LIB.decode(ids[:1], skip_special_tokens=False)}

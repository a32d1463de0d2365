"""BPE encoding and decoding with a contiguous rank array per word."""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import struct
import unicodedata
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cafetal.llm.common import column, slices

NONE = 1 << 40  # rank of a pair that doesn't merge
_SHORT = 64  # bytes up to which the ranks of a word are scanned again for each merge
_CACHED = 200_000  # entries at which a generation of the memory is full

# str.split() also parts at these four; the tokenizer's white space does not have them.
_NO_BLANK = re.compile("[\x1c-\x1f]").search
_BLANK = re.compile("[^\\S\x1c-\x1f]+")

# The printable stand-ins of byte-level vocabularies.
_PLAIN = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]


def _byte_symbols() -> list[str]:
    """The character that stands for each byte: itself if printable, else the next free one from 256 on."""
    symbols = {b: chr(b) for b in _PLAIN}
    for b in range(256):
        if b not in symbols:
            symbols[b] = chr(256 + len(symbols) - len(_PLAIN))
    return [symbols[b] for b in range(256)]


class Ranks:
    """Merge ranks by pair of ids, for arrays of pairs and for single ones."""

    def __init__(self, merges: list[tuple[int, int, int]]):
        self.merged = np.array([m for _, _, m in merges], np.int64)
        keys = np.array([a << 32 | b for a, b, _ in merges], np.int64)
        self.order = np.argsort(keys, kind="stable")
        self.keys = np.append(keys[self.order], np.iinfo(np.int64).max)
        self.order = np.append(self.order, NONE)
        self.single = {(a, b): (r, m) for r, (a, b, m) in enumerate(merges)}

    def of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        pair = left << 32 | right
        at = np.searchsorted(self.keys, pair)
        return np.where(self.keys[at] == pair, self.order[at], NONE)


def merge_words(parts: np.ndarray, ranks: Ranks) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Apply BPE merges to words of equal length: a row of ids each.

    A word's parts and the ranks of its neighbouring parts stand in two contiguous
    rows.  Each round scans every row for its smallest rank (leftmost if tied),
    deletes that boundary and refreshes the two ranks beside it, in all words at once.
    Yields finished words by length: their numbers, and their ids as rows of a table.
    """
    who = np.arange(len(parts))
    near = ranks.of(parts[:, :-1], parts[:, 1:])
    while len(who):
        n = parts.shape[1]
        at = near.argmin(axis=1) if n > 1 else np.zeros(len(parts), np.int64)
        best = near[np.arange(len(parts)), at] if n > 1 else np.full(len(parts), NONE)
        over = best == NONE
        if over.any():
            yield who[over], parts[over]
            who, parts, near, at, best = (x[~over] for x in (who, parts, near, at, best))
        row = np.arange(len(parts))
        parts[row, at] = ranks.merged[best]
        keep = np.arange(n)[None, :] != (at + 1)[:, None]
        parts = parts[keep].reshape(len(row), n - 1)
        near = near[keep[:, 1:]].reshape(len(row), max(0, n - 2))
        if n > 2:
            left, right = np.flatnonzero(at > 0), np.flatnonzero(at < n - 2)
            by, to = at[left], at[right]
            near[left, by - 1] = ranks.of(parts[left, by - 1], parts[left, by])
            near[right, to] = ranks.of(parts[right, to], parts[right, to + 1])


def merge_long(parts: list[int], ranks: dict[tuple[int, int], tuple[int, int]]) -> list[int]:
    """The same merges for one word of very many parts, whose ranks stand in a heap."""
    parts, n = list(parts), len(parts)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(*ranks[p], i, p) for i in range(n - 1) if (p := (parts[i], parts[i + 1])) in ranks]
    heapq.heapify(heap)
    while heap:
        _, merged, i, pair = heapq.heappop(heap)
        j = after[i]
        if parts[i] != pair[0] or j >= n or parts[j] != pair[1]:
            continue  # one of the two has been merged meanwhile
        parts[i], parts[j] = merged, -1
        after[i] = after[j]
        if after[j] < n:
            before[after[j]] = i
            if (p := (merged, parts[after[j]])) in ranks:
                heapq.heappush(heap, (*ranks[p], i, p))
        if before[i] >= 0 and (p := (parts[before[i]], merged)) in ranks:
            heapq.heappush(heap, (*ranks[p], before[i], p))
    return [p for p in parts if p >= 0]


class Recent:
    """Ids and tokens of chunks, in bounded memory: two generations, the older of which goes when the newer is full.

    Both are bytes by chunk: ids as little-endian 32-bit integers, tokens joined by blanks.
    """

    def __init__(self, most: int = _CACHED):
        self.most, self.ids, self.names, self.old = most, {}, {}, ({}, {})

    def __len__(self) -> int:
        return len(self.ids) + len(self.old[0])

    def turn(self) -> None:
        """Between batches: start a new generation if this one is full."""
        if len(self.ids) > self.most:
            self.old, self.ids, self.names = (self.ids, self.names), {}, {}

    def absent(self, keys: set[str]) -> set[str]:
        """Those of ``keys`` that have to be computed; the others are in the newer generation now."""
        new = keys.difference(self.ids)
        ids, names = self.old
        known = new.intersection(ids) if ids else ()
        for k in known:
            self.ids[k], self.names[k] = ids[k], names[k]
        return new.difference(known)


class WordBpe:
    """A word-level BPE tokenizer read from a ``tokenizers`` JSON text.

    Normalisation is NFC, white space runs to one blank, lower case; words are
    the pre-tokenizer's matches, byte by byte, the last part with the word end.
    """

    def __init__(self, spec: str):
        spec = json.loads(spec)
        model = spec["model"]
        vocab: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.names = {i: t for t, i in (vocab | self.special).items()}
        end, symbols = model["end_of_word_suffix"], _byte_symbols()
        self.inner = np.array([vocab[s] for s in symbols], np.int64)
        self.last = np.array([vocab[s + end] for s in symbols], np.int64)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.ranks = Ranks([(vocab[a], vocab[b], vocab[a + b]) for a, b in pairs])
        self.parts = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]).findall
        self.cut = re.compile("(" + "|".join(map(re.escape, self.special)) + ")").split
        self.raw_names = {i: t.encode() for i, t in self.names.items()}
        self.known = Recent()

    def _add_words(self, words: set[str]) -> None:
        by_length = defaultdict(list)
        for w in words:
            by_length[len(raw := w.encode())].append((w, raw))
        name, ids_of, names_of = self.raw_names.__getitem__, self.known.ids, self.known.names
        for n, group in by_length.items():
            raw = np.frombuffer(b"".join([r for _, r in group]), np.uint8).reshape(-1, n)
            parts = self.inner[raw]
            parts[:, -1] = self.last[raw[:, -1]]
            if n > _SHORT:
                merged = ((np.array([k]), np.array([merge_long(p.tolist(), self.ranks.single)]))
                          for k, p in enumerate(parts))
            else:
                merged = merge_words(parts, self.ranks)
            for who, ids in merged:
                m, flat = 4 * ids.shape[1], ids.astype("<u4").tobytes()
                for k, (i, row) in enumerate(zip(who.tolist(), ids.tolist(), strict=True)):
                    w = group[i][0]
                    ids_of[w], names_of[w] = flat[k * m:k * m + m], b" ".join(map(name, row))

    def _add_chunks(self, chunks: set[str]) -> None:
        # isalpha() means letters only, so such a chunk is one word; a word is a chunk that is not cut again
        cut = {c: ws for c in chunks if not c.isalpha() and len(ws := self.parts(c)) > 1}
        words = chunks.difference(cut)
        rest = {w for ws in cut.values() for w in ws} - words
        self._add_words(words | self.known.absent(rest))
        ids, names = self.known.ids, self.known.names
        for c, ws in cut.items():
            ids[c], names[c] = b"".join([ids[w] for w in ws]), b" ".join([names[w] for w in ws])

    def _cut(self, text: str) -> list[str]:
        """Normalised chunks between white space, and special tokens."""
        out = []
        for piece in self.cut(text) if "<|" in text else (text,):
            if piece in self.special:
                out.append(piece.upper())  # chunks are in lower case: no mistaking one for the other
                continue
            if not piece.isascii():
                # Lower case goes character by character here, so a final sigma is like any other.
                piece = unicodedata.normalize("NFC", piece).replace("Σ", "σ")
            piece = piece.lower()
            out += filter(None, _BLANK.split(piece)) if _NO_BLANK(piece) else piece.split()
        return out

    def encode_batch(self, texts: list[str]) -> list[tuple[bytes, bytes]]:
        """For each text its ids (little-endian, 32 bits) and its tokens joined by blanks (UTF-8)."""
        cut = [self._cut(t) for t in texts]
        self.known.turn()
        for s, i in self.special.items():
            self.known.ids[s.upper()], self.known.names[s.upper()] = struct.pack("<I", i), s.encode()
        found = set()
        for cs in cut:
            found.update(cs)
        self._add_chunks(self.known.absent(found))
        ids, names = self.known.ids.__getitem__, self.known.names.__getitem__
        return [(b"".join(map(ids, cs)), b" ".join(map(names, cs))) for cs in cut]

    def decode(self, ids: list[int]) -> str:
        """Tokens joined by blanks; special tokens are kept, unknown ids are left out."""
        return " ".join(self.names[i] for i in ids if i in self.names)


@lru_cache(maxsize=2)
def tokenizer(spec: str) -> WordBpe:
    """One tokenizer a worker process, so that its memory of words outlives a task."""
    return WordBpe(spec)


def read_spec(path: str) -> str:
    """The tokenizer file's text, read on the driver and sent along: executors needn't have the file."""
    with open(path, encoding="utf-8") as f:
        return f.read()


_KINDS = {"ids": pa.list_(pa.int32()), "decoded": pa.string(), "ids_sha256": pa.string(),
          "decoded_sha256": pa.string()}
_SQL = {"ids": "array<int>", "decoded": "string", "ids_sha256": "string", "decoded_sha256": "string"}


def _encoded(spec, columns: tuple[str, ...]):
    def value(name: str, raw: bytes, names: bytes):
        if name == "ids":
            return np.frombuffer(raw, "<u4").astype(np.int32)
        if name == "decoded":
            return names.decode()
        return hashlib.sha256(raw if name == "ids_sha256" else names).hexdigest()

    def run(batches):
        bpe = tokenizer(spec.value)
        for b in slices(batches, 256):
            got = bpe.encode_batch(column(b, "__body"))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([len(raw) // 4 for raw, _ in got], pa.int64()),
                 *(pa.array([value(c, *x) for x in got], _KINDS[c]) for c in columns)],
                names=["doc_id", "n_tokens", *columns])

    return run


def encode_documents(docs: DataFrame, path: str, columns: tuple[str, ...] = ("ids", "decoded"), id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """Encode every text and decode it again: ``doc_id``, ``n_tokens`` and the chosen columns.

    Columns: ``ids``, ``decoded`` (the ids decoded again), and their SHA-256,
    ``ids_sha256`` (over little-endian unsigned 32-bit ids) and ``decoded_sha256``
    (over UTF-8).  One row per input row, no shuffle.  A null text is encoded as the
    empty text: no tokens.  Null ids are passed on.
    """
    spark = docs.sparkSession
    spec = spark.sparkContext.broadcast(read_spec(path))  # a vocabulary file of fixed size
    schema = ", ".join(["doc_id long, n_tokens long", *(f"{c} {_SQL[c]}" for c in columns)])
    return (docs.select(F.col(id_col).cast("long").alias("__id"), F.coalesce(text_col, F.lit("")).alias("__body"))
            .mapInArrow(_encoded(spec, columns), schema))


def decode_documents(encoded: DataFrame, path: str, ids_col: str = "ids") -> DataFrame:
    """Add ``decoded`` to a table of id arrays (null ids give null; unknown ids are left out)."""
    spark = encoded.sparkSession
    spec = spark.sparkContext.broadcast(read_spec(path))

    @F.pandas_udf("string")
    def decoded(ids):
        bpe = tokenizer(spec.value)
        return ids.map(lambda x: None if x is None else bpe.decode(list(x)))

    return encoded.withColumn("decoded", decoded(ids_col))

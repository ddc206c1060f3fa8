"""Lexical retrieval packing: BM25 neighbours of a seed fill its window.

Documents are dealt to shards of bounded size by a hash; a shard has its own
BM25 inverted index and packs its own documents, so each id is used once with
no state shared between tasks. In a shard the longest unused document is the
seed; where its tail leaves room, its unused neighbours are taken in order of
their BM25 score as long as one fits whole; if none does, the best one is cut
and its rest seeds the next window. Only a shard's last window is padded.

Tokens: a text is cut before each single space, which is always a boundary of
the tokenizer's own splitting, and the ids of each such unit are remembered by
the Python worker. A text with two adjacent white-space characters, or with a
special token, goes to the tokenizer whole.
"""

from __future__ import annotations

import base64
import functools
import re
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cubeguard.llm.common import ship_code, use_alone

WINDOW, END_ID = 2048, 1
#: A shard has about so many documents, or so many bytes of text, whichever is less.
SHARD_ROWS, SHARD_BYTES = 1024, 8 << 20
#: Units that a Python worker remembers at most; beyond, it starts anew at the next shard.
REMEMBERED = 2_000_000
K1, B = 1.2, 0.75
TOKENIZER, RANKS = "byte_bpe_50k.json", "byte_bpe_50k.tiktoken"

_SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, seed_doc_id long, padded_length long"


def _mixed(x: np.ndarray) -> np.ndarray:
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


def unit_hashes(units: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of each unit: sums of its bytes times a random number for each place."""
    at = np.frombuffer(units.buffers()[1], np.int64)[units.offset:units.offset + len(units) + 1]
    data = np.frombuffer(units.buffers()[2] or b"", np.uint8)[at[0]:at[-1]].astype(np.uint64) + np.uint64(1)
    at = at - at[0]
    size = np.diff(at)
    place = np.arange(len(data)) - np.repeat(at[:-1], size)
    some = size > 0
    out = []
    for seed in (1, 2):
        factor = _mixed(np.arange(int(size.max(initial=0)), dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed * 0xD6E8FEB86659FD93 % 2**64))
        h = np.zeros(len(units), np.uint64)
        if some.any():
            h[some] = np.add.reduceat(data * factor[place], at[:-1][some])
        out.append(_mixed(h + size.astype(np.uint64)))
    return out[0], out[1]


class Units:
    """Remembers units, the parts of texts after a space: hashes of a unit -> its index, or -1 if a text with it must be encoded whole."""

    def __init__(self, tokenizer: str, ranks: str):
        import public_tokenizers as public
        import tiktoken
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(public.path(tokenizer))
        with open(public.path(ranks), "rb") as f:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.piece = tiktoken.Encoding("units", pat_str=public.PATTERN, mergeable_ranks=table, special_tokens={})
        self.special = [t.content for t in self.whole.get_added_tokens_decoder().values()]
        self.first: dict[str, int] = {}
        self.ids, self.used = np.empty(1 << 16, np.uint32), 0
        self.starts, self.sizes = np.empty(1 << 16, np.int64), np.empty(1 << 16, np.int64)
        self.count = 0
        self.keys, self.checks, self.index = np.empty(0, np.uint64), np.empty(0, np.uint64), np.empty(0, np.int64)

    def __len__(self) -> int:
        return len(self.keys)

    def forget(self) -> None:
        self.keys, self.checks, self.index = self.keys[:0], self.checks[:0], self.index[:0]
        self.first.clear()
        self.ids, self.used = self.ids[:1 << 16].copy(), 0
        self.starts, self.sizes, self.count = self.starts[:1 << 16].copy(), self.sizes[:1 << 16].copy(), 0

    def add(self, unit: str, text: str) -> int:
        if not unit or unit[0].isspace() or unit[-1].isspace() or re.search(r"\s\s", unit) or any(s in unit for s in self.special):
            return -1
        # Beyond the Latin letters, the libraries' Unicode tables need not agree.
        ids = self.piece.encode_ordinary(text) if max(unit) < "ɐ" else self.whole.encode(text, add_special_tokens=False).ids
        while self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.empty_like(self.ids)])
        if self.count == len(self.starts):
            self.starts, self.sizes = (np.concatenate([x, np.empty_like(x)]) for x in (self.starts, self.sizes))
        self.ids[self.used:self.used + len(ids)] = ids
        self.starts[self.count], self.sizes[self.count] = self.used, len(ids)
        self.used += len(ids)
        self.count += 1
        return self.count - 1

    def indices(self, units: pa.LargeStringArray) -> np.ndarray:
        """Index of each of some different units; new ones are remembered. By 128 bits of hash, sorted by the first 64."""
        key, check = unit_hashes(units)
        order = np.argsort(key)
        key, check = key[order], check[order]
        at = np.searchsorted(self.keys, key)
        near = np.minimum(at, max(len(self.keys) - 1, 0))
        hit = (self.keys[near] == key) & (self.checks[near] == check) if len(self.keys) else np.zeros(len(key), bool)
        found = np.empty(len(key), np.int64)
        found[hit] = self.index[near[hit]]
        new = np.flatnonzero(~hit)
        if len(new):
            found[new] = [self.add(u, " " + u) for u in units.take(pa.array(order[new])).to_pylist()]
            self.keys, self.checks, self.index = (np.insert(x, at[new], v[new]) for x, v in ((self.keys, key), (self.checks, check), (self.index, found)))
        out = np.empty(len(key), np.int64)
        out[order] = found
        return out

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Ids of a whole text, with the end id; its units as terms."""
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """:meth:`encode` of each text; a unit is looked up once for all of them."""
        split = pc.split_pattern(pa.array(texts, pa.large_string()), pattern=" ")
        codes = split.values.dictionary_encode()
        terms, at = self.indices(codes.dictionary)[codes.indices.to_numpy()], split.offsets.to_numpy()
        return [self._one(text, terms[a:z]) for text, a, z in zip(texts, at[:-1].tolist(), at[1:].tolist(), strict=True)]

    def _one(self, text: str, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not text:
            return np.array([END_ID], np.uint32), np.empty(0, np.int64)
        first = text.partition(" ")[0]
        if (k := self.first.get(first)) is None:
            k = self.first[first] = self.add(first, first)
        idx = terms.copy()
        idx[0] = k
        if idx.min() < 0:
            ids = self.whole.encode(text, add_special_tokens=False).ids
            words = pa.array(text.split(), pa.large_string()).dictionary_encode()
            terms = self.indices(words.dictionary)[words.indices.to_numpy()]
            return np.array([*ids, END_ID], np.uint32), terms[terms >= 0]
        sizes = self.sizes[idx]
        ends = np.cumsum(sizes)
        out = np.empty(ends[-1] + 1, np.uint32)
        out[:-1] = self.ids[np.repeat(self.starts[idx] - ends + sizes, sizes) + np.arange(ends[-1])]
        out[-1] = END_ID
        return out, terms  # as a term, the first unit is a word like the others


@functools.lru_cache(maxsize=1)
def _units(tokenizer: str, ranks: str) -> Units:
    return Units(tokenizer, ranks)


class Index:
    """BM25 inverted index of a shard; a term in one document only links nothing."""

    def __init__(self, docs: list[np.ndarray]):
        n = len(docs)
        pairs = [np.unique(d, return_counts=True) for d in docs]
        doc = np.repeat(np.arange(n), [len(t) for t, _ in pairs])
        tf = np.concatenate([c for _, c in pairs]).astype(np.float64) if n else np.empty(0)
        _, term, df = np.unique(np.concatenate([t for t, _ in pairs]), return_inverse=True, return_counts=True)
        size = np.array([len(d) for d in docs], np.float64)
        norm = K1 * (1 - B + B * size / max(size.mean(), 1.0))
        idf = np.log1p((n - df + 0.5) / (df + 0.5))
        weight = idf[term] * tf * (K1 + 1) / (tf + norm[doc])
        shared = df[term] > 1
        doc, term, weight = doc[shared], term[shared], weight[shared]
        by_term = np.argsort(term, kind="stable")
        self.n, self.doc, self.weight = n, doc[by_term], weight[by_term]
        self.at = np.searchsorted(term[by_term], np.arange(len(df) + 1))
        self.terms = np.split(term, np.searchsorted(doc, np.arange(1, n)))

    def scores(self, seed: int) -> np.ndarray:
        terms = self.terms[seed]
        if not len(terms):
            return np.zeros(self.n)
        starts, sizes = self.at[terms], self.at[terms + 1] - self.at[terms]
        ends = np.cumsum(sizes)
        post = np.repeat(starts - ends + sizes, sizes) + np.arange(ends[-1])
        return np.bincount(self.doc[post], self.weight[post], self.n)


def pack_shard(sizes: np.ndarray, index: Index, window: int = WINDOW) -> list[tuple[int, int, int, int, int, int]]:
    """(document, start, length, sequence, offset, seed) of each piece."""
    unused = np.ones(len(sizes), bool)
    seeds = iter(np.argsort(-sizes, kind="stable").tolist())
    out, sequence, room, rest, seed = [], 0, window, None, 0

    def place(doc: int, start: int) -> int | None:
        """As much of it as there is room for; where its rest starts."""
        nonlocal room
        length = min(room, int(sizes[doc]) - start)
        out.append((doc, start, length, sequence, window - room, seed))
        room -= length
        return start + length if start + length < sizes[doc] else None

    while True:
        if rest is None:
            seed = next((s for s in seeds if unused[s]), None)
            if seed is None:
                return out
            unused[seed], rest = False, (seed, 0)
        seed = rest[0]
        start = place(*rest)
        rest = None
        if start is not None:
            rest = (seed, start)
        elif room:
            score = index.scores(seed)
            ranked = np.flatnonzero(unused)
            ranked = ranked[np.argsort(-score[ranked], kind="stable")]
            while room and len(ranked):
                fits = sizes[ranked] <= room
                k = int(fits.argmax())
                if not fits[k]:  # none fits whole: cut the best one
                    best = int(ranked[0])
                    unused[best] = False
                    rest = (best, place(best, 0))
                    break
                unused[ranked[k]] = False
                place(int(ranked[k]), 0)
                ranked = np.delete(ranked, k)
        if not room:
            sequence, room = sequence + 1, window


def _shard_packer(window: int, tokenizer: str, ranks: str):
    def run(table: pa.Table) -> pa.Table:
        units = _units(tokenizer, ranks)
        use_alone(units)
        if len(units) > REMEMBERED:
            units.forget()
        table = table.combine_chunks()
        texts = table.column("text").to_pylist()
        encoded = units.encode_all(texts)
        ids = table.column("doc_id").to_pylist()
        order = sorted(range(len(ids)), key=lambda k: (ids[k] is None, ids[k] or 0, texts[k]))
        ids, tokens = [ids[k] for k in order], [encoded[k][0] for k in order]
        sizes = np.array([len(t) for t in tokens])
        pieces = pack_shard(sizes, Index([encoded[k][1] for k in order]), window)
        doc, start, length, sequence, offset, seed = (np.array(x, np.int64) for x in zip(*pieces, strict=True))
        shard = table.column("shard")[0].as_py()
        filled = np.bincount(sequence, length)[sequence].astype(np.int64)
        return pa.table({
            "doc_id": pa.array([ids[k] for k in doc], pa.int64()), "start": start, "length": length,
            "ids_crc32": np.array([zlib.crc32(tokens[d][s:s + n].astype("<u4").tobytes()) for d, s, n, *_ in pieces], np.int64),
            "doc_tokens": sizes[doc].astype(np.int64), "sequence_id": (np.int64(shard) << 32) + sequence, "offset": offset,
            "seed_doc_id": pa.array([ids[k] for k in seed], pa.int64()),
            "padded_length": np.where(filled & (filled - 1) == 0, filled, window),
        })

    return run


def pack(docs: DataFrame, window: int = WINDOW, tokenizer: str = TOKENIZER, ranks: str = RANKS) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, ...

    Every id of every document lies in exactly one piece: the tokenizer's ids,
    without special tokens, then id 1. Null and empty texts are their end id alone.
    Rows with a null or repeated doc_id are packed like any other. Sequences have
    ``window`` ids; a shard's last one may have fewer and is padded to ``window``
    unless its length is a power of two (``padded_length``). An empty table gives an
    empty result. Other columns are not read.
    """
    ship_code(docs.sparkSession)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    count, size = rows.agg(F.count(F.lit(1)), F.sum(F.octet_length("text"))).first()
    shards = max(1, -(-count // SHARD_ROWS), -(-(size or 0) // SHARD_BYTES))
    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("doc_id", "text"), F.lit(shards)))
    return dealt.groupBy("shard").applyInArrow(_shard_packer(window, tokenizer, ranks), _SCHEMA)

import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from cubeguard.llm import packing as P
from tests.llm.helpers import frame, rows, words


@pytest.fixture(scope="module")
def ids():
    tokenizer = Tokenizer.from_file(public_tokenizers.path(P.TOKENIZER))
    return lambda text: np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [1], dtype="<u4")


def test_round_trip(spark, ids):
    got = P.pack(frame(spark)).collect()
    pieces = {}
    for r in got:
        pieces.setdefault(r.doc_id, []).append((r.start, r.length, r.ids_crc32, r.doc_tokens))
    wanted = {}
    for i, t, *_ in rows():
        wanted.setdefault(i, []).append(t)
    assert set(pieces) == set(wanted)
    for i, texts in wanted.items():
        own = ids(texts[0])  # repeated rows have the same text
        assert {p[3] for p in pieces[i]} == {len(own)}
        assert all(zlib.crc32(own[s:s + n].tobytes()) == c and n > 0 for s, n, c, _ in pieces[i])
        assert Counter(k for s, n, *_ in pieces[i] for k in range(s, s + n)) == dict.fromkeys(range(len(own)), len(texts))
    for k in {r.sequence_id for r in got}:
        own = sorted((r.offset, r.length, r.padded_length) for r in got if r.sequence_id == k)
        ends = np.cumsum([n for _, n, _ in own])
        assert [o for o, *_ in own] == [0, *ends[:-1].tolist()] and ends[-1] <= 2048
        full = ends[-1] == 2048 or ends[-1] & (ends[-1] - 1) == 0
        assert own[0][2] == (ends[-1] if full else 2048)


@pytest.mark.parametrize("text", ["a b", " a", "a ", "a  b", "a\nb c\n", "x \n y", "\n", "it's 12ab, ok!?", "Ünï cødé 漢字  x", "a b c", "<|endoftext|> a b", "tab\tbed  two\n\n three", "don't 'S ...  "])
def test_units_are_the_tokenizers(ids, text):
    units = P.Units(P.TOKENIZER, P.RANKS)
    for _ in range(2):  # new, then remembered
        assert units.encode(text)[0].tolist() == ids(text).tolist()


def test_bm25_by_brute_force():
    docs = [np.array(x) for x in ([1, 2, 3, 3], [1, 2, 9], [7, 8], [3, 3, 3, 1], [])]
    docs = [d.astype(np.int64) for d in docs]
    index, n = P.Index(docs), len(docs)
    mean = np.mean([len(d) for d in docs])
    for seed, own in enumerate(docs):
        for d, other in enumerate(docs):
            want = 0.0
            for t in set(own.tolist()):
                df = sum(t in x for x in docs)
                tf = int((other == t).sum())
                if df > 1 and tf:
                    want += np.log1p((n - df + 0.5) / (df + 0.5)) * tf * (P.K1 + 1) / (tf + P.K1 * (1 - P.B + P.B * len(other) / mean))
            assert abs(index.scores(seed)[d] - want) < 1e-9


def test_window_is_filled_with_neighbours():
    a, b = words(300, 1, 60), words(300, 2, 60)
    vocabulary = {w: k for k, w in enumerate(sorted({*a, *b}))}
    docs = [np.array([vocabulary[w] for w in (a if k % 2 else b)[10 * (k // 2):10 * (k // 2) + 30]]) for k in range(40)]
    pieces = P.pack_shard(np.array([100] * 40), P.Index(docs), 500)
    same = [doc % 2 == seed % 2 for doc, *_, seed in pieces if doc != seed]
    assert np.mean(same) > 0.7  # windows hold their seed's kind
    assert sorted(p[0] for p in pieces) == list(range(40))


def test_empty_table(spark):
    assert P.pack(frame(spark, [])).count() == 0

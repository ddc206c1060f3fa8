import hashlib
import random

import numpy as np
import pytest

from cubeguard.llm import suffix_dedup as S
from tests.llm.helpers import frame, rows, words


def plain(docs):
    """(doc_id, text) rows -> the contract's rows, by a set of all strings seen."""
    seen, out = set(), []
    for doc_id, text in sorted(docs, key=lambda r: (r[0] is not None, r[0] or 0)):
        b = (text or "").encode()
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - 99):
            s = b[i:i + 100]
            if s in seen:
                gone[i:i + 100] = True
            seen.add(s)
        kept = bytes(np.frombuffer(b, np.uint8)[~gone])
        spans = int((np.diff(np.concatenate([[0], gone])) > 0).sum()) if len(b) else 0
        out.append((doc_id, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def texts(seed, n=60):
    rng = random.Random(seed)
    base = [" ".join(words(rng.randint(5, 200), seed * 100 + k, 60)) for k in range(8)]
    out = []
    for _ in range(n):
        parts = []
        for _ in range(rng.randint(0, 4)):
            b = rng.choice(base)
            kind = rng.random()
            if kind < 0.4:
                a = rng.randrange(len(b))
                parts.append(b[a:a + rng.randint(1, 400)])
            elif kind < 0.6:
                a = rng.randrange(len(b))
                parts.append(b[:a] + "X" + b[a:])
            elif kind < 0.7:
                parts.append(rng.choice("aé") * rng.randint(1, 300))
            else:
                parts.append(" ".join(words(rng.randint(1, 60), rng.randrange(10**6))))
        out.append(rng.choice([" ", "", "\n"]).join(parts))
    return out


def report(spark, docs, parts=4):
    own = [(i, t, None, "s", "clash", "clash", 7) for i, t in docs]
    return sorted((tuple(r) for r in S.suffix_dedup(frame(spark, own).repartition(parts)).collect()), key=str)


def test_suffix_arrays():
    rng = random.Random(1)
    for k in range(300):
        n, size = rng.randint(0, 60), rng.choice([1, 2, 3, 20])
        t = np.array([rng.randint(1, size) for _ in range(n)] + [0], np.int16)
        names = t.tolist()
        want = sorted(range(n + 1), key=lambda i: names[i:])
        assert S.suffix_array(t).tolist() == want
        s = S._is_s(t)
        lms = np.array([i for i in want if i and s[i] and not s[i - 1]], np.int32)
        if len(lms):
            assert S._induce_narrow(t, s, lms, size + 1).tolist() == S._induce_wide(t, s, lms, size + 1).tolist() == want
        got = S.common_prefixes(t.astype(np.uint8), np.array(want), np.ones(n + 1, bool), 4)
        for a, b in zip(want, want[1:], strict=False):
            m = 0
            while m < 4 and names[a + m:a + m + 1] == names[b + m:b + m + 1] != []:
                m += 1
            assert got[b] == m


def test_large_alphabet():
    rng = np.random.default_rng(3)
    unit = rng.integers(1, 5000, 3000)
    t = np.append(np.concatenate([unit, unit[500:], unit]), 0).astype(np.int32)
    lists = t.tolist()
    assert S.suffix_array(t).tolist() == sorted(range(len(t)), key=lambda i: lists[i:])


def test_equal_strings_have_one_key_and_each_lies_in_one_piece():
    text = " ".join(words(2000, 3, 50)) + "a" * 500 + "xyz" * 100 + "".join(f"{k % 69:02d}"[:1] for k in range(69)) * 4
    b = np.frombuffer((text + "b" + text[700:3000]).encode(), np.uint8)
    start, end, key, inner = S.pieces(b)
    owner = np.searchsorted(start, np.arange(len(b) - S.LENGTH + 1), "right") - 1
    assert start[0] == 0 and end[-1] == len(b) and (end[:-1] == start[1:] + S.LENGTH - 1).all() and (end - start).max() <= S.STRINGS + S.LENGTH
    seen, held = {}, {}
    for s, k in enumerate(owner.tolist()):
        string = b[s:s + S.LENGTH].tobytes()
        assert seen.setdefault(string, key[k]) == key[k]
        assert inner[k] or string not in held.setdefault(k, set())
        held.setdefault(k, set()).add(string)
    assert inner.mean() < 0.1


def test_parts_of_a_long_text(monkeypatch):
    b = np.frombuffer(" ".join(words(1500, 4, 50)).encode(), np.uint8)
    keys = lambda: [k for a, z, k, _ in zip(*S.pieces(b), strict=True) for _ in range(a, z - S.LENGTH + 1)]
    want = keys()
    monkeypatch.setattr(S, "BYTES", 777)
    assert keys() == want


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_all_strings(spark, seed):
    docs = list(enumerate(texts(seed)))
    random.Random(seed).shuffle(docs)
    assert report(spark, docs) == sorted(plain(docs), key=str)


def test_shards_and_hot_hashes_by_hand():
    """One surrounding in two shards: what is first in each is handed on with its hash."""
    shared = " ".join(words(60, 9)).encode()
    group = [(True, d, 0, 10 * d, bytes([65 + d]) * 70 + shared[:150] + bytes([97 + d]) * 70) for d in range(6)]
    one = S.shard_marks([(False, *r[1:]) for r in group])
    assert [(m[0], (m[2] >> 32) - 10 * m[0], (m[2] & 0xFFFFFFFF) - 10 * m[0]) for m in one] == [(d, 70, 220) for d in range(1, 6)]
    halves = [S.shard_marks(group[k::2]) for k in (0, 1)]
    spans, first = {}, {}
    for m in halves[0] + halves[1]:
        if m[3] is None:
            spans.setdefault(m[0], set()).update(range(m[2] >> 32, m[2] & 0xFFFFFFFF))
        else:
            first.setdefault(m[3:], []).append((m[0], m[2]))
    for places in first.values():
        for d, s in sorted(places)[1:]:
            spans.setdefault(d, set()).update(range(s, s + 100))
    assert {d: (min(s) - 10 * d, max(s) + 1 - 10 * d) for d, s in spans.items()} == {d: (70, 220) for d in range(1, 6)}


def test_nulls_repeated_rows_and_lengths(spark):
    long = [r for r in rows() if len(r[1] or "") > 10_000]
    own = [r for r in rows() if len(r[1] or "") < 10_000] + [(None, "n" * 150, "en", None, "c", "l", 1), (20, "é" * 50, None, None, "c", "l", 1), (21, "z" * 99, None, None, "c", "l", 1), (22, "z" * 100, None, None, "c", "l", 1)]
    got = sorted((tuple(r) for r in S.suffix_dedup(frame(spark, own)).collect()), key=str)
    assert got == sorted(plain([(r[0], r[1]) for r in own]), key=str)
    twice = {r.doc_id: r for r in S.suffix_dedup(frame(spark, long), with_bytes=True).collect()}
    assert hashlib.sha256(twice[7].kept).hexdigest() == plain([(7, long[0][1])])[0][4]
    assert twice[8].n_removed == twice[8].n_bytes and twice[8].kept == b"" and twice[8].n_spans == 1


def test_repeated_long_rows(spark):
    t = " ".join(words(80, 5))
    got = sorted((tuple(r) for r in S.suffix_dedup(frame(spark, [(1, t, None, None, "c", "l", 1)] * 3 + [(2, t, None, None, "c", "l", 1)])).collect()), key=str)
    n, empty = len(t), hashlib.sha256(b"").hexdigest()
    first = hashlib.sha256(t.encode()).hexdigest()
    assert got == sorted([(1, n, 0, 0, first), (1, n, n, 1, empty), (1, n, n, 1, empty), (2, n, n, 1, empty)], key=str)


def test_empty_table(spark):
    assert S.suffix_dedup(frame(spark, [])).collect() == []


def test_keys_dealt_over_several_shards(spark, monkeypatch):
    """With two pieces of a key to a shard, what is first in a shard is compared again: the same result."""
    monkeypatch.setattr(S, "CAP", 2)
    passage = " ".join(words(40, 77))
    docs = [(i, " ".join(words(12, i)) + " " + passage + " " + " ".join(words(12, 500 + i))) for i in range(60)] + [(100 + i, t) for i, t in enumerate(texts(5, 30))]
    assert report(spark, docs) == sorted(plain(docs), key=str)

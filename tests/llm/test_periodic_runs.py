import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np

from cubeguard.llm import periodic_runs as P
from tests.llm.helpers import frame, rows, words


def plain_runs(w):
    """Every maximal stretch of every period, the smallest period of each."""
    n, out = len(w), []
    for q in range(1, n // 3 + 1):
        x = 0
        while x + q < n:
            if w[x] != w[x + q]:
                x += 1
                continue
            s = x
            while x + q < n and w[x] == w[x + q]:
                x += 1
            if x + q - s >= max(24, 3 * q) and not any(q % d == 0 and all(w[i] == w[i + d] for i in range(s, x + q - d)) for d in range(1, q)):
                out.append((s, x + q - s, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def plain(doc_id, text):
    w = re.findall("[^\x20\x09-\x0d]+", text or "")
    h = zlib.crc32(("" if doc_id is None else str(doc_id)).encode())
    n, g = len(w), h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(w)
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=(None, None, None))
    kept = [x for i, x in enumerate(w) if not any(s + q <= i < s + m for s, m, q in runs)]
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
            sha("".join(f"{s},{m},{q}\n" for s, m, q in runs)), sha(" ".join(kept)))


def structured(rng):
    """Words with periodic stretches, copies, broken periods and nested ones."""
    out = []
    for _ in range(rng.randint(1, 6)):
        kind = rng.random()
        vocabulary = "ab" if rng.random() < 0.5 else "abcdefgh"
        root = [rng.choice(vocabulary) for _ in range(rng.randint(1, 12))]
        if kind < 0.5:
            piece = (root * 40)[:rng.randint(1, 60)]
        elif kind < 0.7:
            piece = (root * 6 + [rng.choice(vocabulary)]) * rng.randint(1, 5)
        elif kind < 0.85 and out:
            at = rng.randrange(len(out))
            piece = out[at:at + 40]
        else:
            piece = [rng.choice("abcdefgh") for _ in range(rng.randint(1, 50))]
        out += piece
    return out


def test_equals_every_period_of_every_stretch():
    rng = random.Random(5)
    for _ in range(150):
        texts = [structured(rng) for _ in range(4)]
        assert P.found_in(texts) == [plain_runs(t) for t in texts]


def test_grammar_alone_finds_all_runs():
    """Without cutting anything out first."""
    rng = random.Random(6)
    for _ in range(150):
        t = structured(rng)
        ids = np.array([ord(c) - 97 for c in t])
        assert [(s, e - s, q) for s, e, q in P.grammar_runs(ids)] == plain_runs(t)


def test_grammar_expands_to_the_text():
    rng = random.Random(8)
    for _ in range(200):
        ids = [rng.randrange(3) for _ in range(rng.randint(0, 80))]
        if len(ids) > 5:
            ids[3] = -1
        rules, sequence = P.re_pair(ids)
        top = max(ids, default=-1) + 1
        expand = lambda s: [s] if s < top else expand(rules[s - top][0]) + expand(rules[s - top][1])
        assert [x for s in sequence for x in expand(s)] == ids
        seen = {}
        for i, pair in enumerate(zip(sequence, sequence[1:], strict=False)):
            if min(pair) >= 0:
                assert i - seen.setdefault(pair, i) < 2  # only overlapping, as in "aaa"


def test_stretches_hold_every_run_and_stay_in_their_text():
    texts = [np.array([1, 2] * 20), np.array([1, 2] * 20), np.arange(100), np.zeros(0, np.int64), np.array([5] * 15), np.array([5] * 24)]
    assert P.repeated_stretches(texts) == [[(0, 40)], [(0, 40)], [], [], [], [(0, 24)]]


def test_documents(spark):
    ids = [i for i in range(3000) if zlib.crc32(str(i).encode()) % 10 == 0][:25]
    own = [(i, " ".join(words(60 + 9 * k, k)), None, None, "clash", "x", 1) for k, i in enumerate(ids)]
    own += [(700_000 + k, " \t\n".join(structured(random.Random(k))), "en", None, "clash", "x", 1) for k in range(60)]
    own += [r for r in rows() if len(r[1] or "") < 10_000] * 2
    got = sorted((tuple(r) for r in P.periodic_runs(frame(spark, own).repartition(3)).collect()), key=str)
    assert got == sorted((plain(r[0], r[1]) for r in own), key=str)


def test_long_texts(spark):
    unit = words(3000, 4, 3000)
    texts = ["a " * 200_000, " ".join(unit * 20), " ".join(words(100_000, 3, 5000)), " ".join((["x", "y"] * 50 + unit[:30]) * 100)]
    ids = [i for i in range(20) if zlib.crc32(str(i).encode()) % 10][:4]
    got = {r.doc_id: tuple(r)[1:5] for r in P.periodic_runs(frame(spark, [(i, t, None, None, "c", "l", 1) for i, t in zip(ids, texts, strict=True)])).collect()}
    want = {0: (1, 0, 200_000, 1), 1: (1, 0, 60_000, 3000), 2: (0, None, None, None)}
    assert [got[i] for i in ids[:3]] == [want[k] for k in range(3)]
    assert got[ids[3]][0] == 101


def test_empty_table(spark):
    assert P.periodic_runs(frame(spark, [])).collect() == []

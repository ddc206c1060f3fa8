"""Periodic runs in word sequences, found on a Re-Pair grammar of each text.

A run is a stretch of consecutive words with smallest period q and at least
max(24, 3 * q) words that neither neighbour extends. The steps, all inside one text:

1. Words become ids. Each position of a run lies in a 16-word string that the text
   holds twice (the string and its copy q words on cover the run), so positions in no
   such string are cut out first; what is left are stretches with a mark between them.
2. Re-Pair: the most frequent pair of neighbours becomes a rule A -> B C until no pair
   occurs twice; of equally frequent pairs the oldest goes first, which keeps rules
   balanced.
3. A run lies in the expansion of one lowest node of the derivation and crosses that
   node's boundary, between B and C, or it crosses a boundary of the remaining
   sequence. So the runs that cross the boundary are computed once for each rule,
   within its expansion, and once for each boundary of the sequence. Candidates for
   the period are the distances to equal 8-word strings beside the boundary: with
   at least 16 equal words at that distance, 8 of them lie on one side of it. A
   candidate is confirmed word by word and extended as far as it holds.
4. The runs of a rule are translated to all positions that derive from it, and
   overlapping stretches of one period are merged: a run that goes on beyond a rule's
   expansion is found again, whole, at a node above.

Texts are independent of each other, so nothing is shuffled: one pass over the
table, a few texts at a time.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import deque

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cubeguard.llm.common import ship_code

MIN_WORDS, MIN_PERIODS = 24, 3
#: A run has at least so many positions that equal the one a period on, so half of them beside a boundary.
EQUAL = 16
SIDE = EQUAL // 2
#: Words whose equal strings are looked for at a time (one text at least).
WORDS_AT_ONCE = 1 << 17
_WORD = re.compile("[^\x20\x09-\x0d]+")
_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)


def damage(doc_id, words: list) -> list:
    """The contract's damage: a tenth of the documents become periodic from a word on."""
    h = zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    head, period = words[:a], words[a:a + p]
    return head + (period * ((n - a) // p + 1))[:n - a]


def _hashes(ids: np.ndarray, k: int) -> np.ndarray:
    """A 64-bit hash of each string of ``k`` (a power of two) ids; equal strings have equal ones."""
    h, width = (ids.astype(np.uint64) + np.uint64(1)) * _MIX, 1
    while width < k:
        h = h[:-width] * _BASE + h[width:] if len(h) > width else h[:0]
        h ^= h >> np.uint64(29)
        h *= _MIX
        width *= 2
    return h


def repeated_stretches(texts: list) -> list:
    """For each array of ids, the (start, end) stretches whose positions lie in a string of EQUAL words held twice."""
    sizes = np.array([len(t) for t in texts])
    ids = np.concatenate(texts) if texts else np.zeros(0, np.int64)
    owner = np.repeat(np.arange(len(texts)), sizes)
    out = [[] for _ in texts]
    h = _hashes(ids, EQUAL)
    if not len(h):
        return out
    inside = owner[:len(h)] == owner[EQUAL - 1:EQUAL - 1 + len(h)]
    start = np.flatnonzero(inside)
    key = h[start] ^ (owner[start].astype(np.uint64) * _BASE)
    order = np.argsort(key)
    same = key[order][1:] == key[order][:-1]
    twice = np.zeros(len(start), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    cover = np.zeros(len(ids) + 1, np.int64)
    np.add.at(cover, start[twice], 1)
    np.add.at(cover, start[twice] + EQUAL, -1)
    on = np.concatenate([[0], np.cumsum(cover[:-1]) > 0, [0]]).astype(np.int8)
    first = np.cumsum(sizes) - sizes
    # a stretch may touch the next text's first position: cut at the texts' edges
    edges = np.flatnonzero(np.diff(on))
    for s, e in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
        while s < e:
            t = int(owner[s])
            stop = min(e, int(first[t] + sizes[t]))
            out[t].append((s - int(first[t]), stop - int(first[t])))
            s = stop
    return out


def re_pair(ids: list):
    """(rules, sequence): rules[i] = (left, right) makes symbol top + i; no pair occurs twice in the sequence.

    ``ids`` are not negative below ``top`` = max + 1; a negative id is a mark that no pair holds.
    Linear but for the queues: each replacement touches its two neighbours.
    """
    sym, n = list(ids), len(ids)
    nxt, prv = list(range(1, n + 1)), list(range(-1, n - 1))
    top = max(ids, default=-1) + 1
    places: dict = {}
    for i in range(n - 1):
        if sym[i] >= 0 and sym[i + 1] >= 0:
            places.setdefault((sym[i], sym[i + 1]), set()).add(i)
    places = {p: s for p, s in places.items() if len(s) > 1}
    queues: dict = {}
    for p, s in places.items():
        queues.setdefault(len(s), deque()).append(p)
    rules = []
    most = max(queues, default=0)
    while most > 1:
        queue = queues.get(most)
        if not queue:
            most -= 1
            continue
        pair = queue.popleft()
        spots = places.get(pair)
        if spots is None:
            continue
        if len(spots) < most:  # overtaken: queue it where it belongs now
            if len(spots) > 1:
                queues.setdefault(len(spots), deque()).append(pair)
            else:
                del places[pair]
            continue
        del places[pair]
        left, right = pair
        chosen, taken = [], -1
        for i in sorted(spots):
            if i != taken:  # else overlapped by the one before, as in "aaa"
                chosen.append(i)
                taken = nxt[i]
        if len(chosen) < 2:
            continue
        new = top + len(rules)
        rules.append(pair)
        for i in chosen:
            j = nxt[i]
            k, b = nxt[j], prv[i]
            for p, at in (((sym[b], left), b) if b >= 0 else (None, 0), ((right, sym[k]), j) if k < n else (None, 0)):
                old = places.get(p)
                if old is not None:
                    old.discard(at)
            sym[i], nxt[i] = new, k
            if k < n:
                prv[k] = i
        fresh: dict = {}
        for i in chosen:
            b, k = prv[i], nxt[i]
            if b >= 0 and sym[b] >= 0:
                fresh.setdefault((sym[b], new), set()).add(b)
            if k < n and sym[k] >= 0:
                fresh.setdefault((new, sym[k]), set()).add(i)
        for p, s in fresh.items():
            if len(s) > 1:
                places[p] = s
                queues.setdefault(len(s), deque()).append(p)
    out, i = [], 0
    while i < n:
        out.append(sym[i])
        i = nxt[i]
    return rules, out


class _Crossing:
    """Runs that cross a boundary within a window of ``ids``."""

    def __init__(self, ids: np.ndarray):
        self.ids = ids
        self.gram = _hashes(ids, SIDE)
        self.order = np.argsort(self.gram, kind="stable")
        sorted_ = self.gram[self.order]
        new = np.concatenate([[True], sorted_[1:] != sorted_[:-1]]) if len(sorted_) else np.zeros(0, bool)
        starts = np.flatnonzero(new)
        group = np.cumsum(new) - 1
        self.rank = np.empty(len(self.order), np.int64)
        self.rank[self.order] = np.arange(len(self.order))
        self.begin, self.end = np.empty_like(self.rank), np.empty_like(self.rank)
        self.begin[self.order] = starts[group]
        self.end[self.order] = np.append(starts[1:], len(self.order))[group]
        self.alone = (self.end - self.begin == 1).tolist()

    def _others(self, x: int, later: bool) -> np.ndarray:
        """Positions of the string at x, after it or before it."""
        if not 0 <= x < len(self.alone) or self.alone[x]:
            return _NONE
        r = self.rank[x]
        return self.order[r + 1:self.end[x]] if later else self.order[self.begin[x]:r]

    def _candidates(self, b: int, lo: int, hi: int):
        """(period, u, m): the positions u..u+m would equal those a period on; ascending periods."""
        found = []
        for x, later in ((b - SIDE, True), (b - 1, True), (b - SIDE + 1, False), (b, False)):
            y = self._others(x, later)
            if not len(y):
                continue
            q = y - x if later else x - y
            m = np.maximum(q, SIDE)
            if x == b - SIDE:
                u = b - m
            elif x == b - 1:
                u = np.full(len(q), x)
            elif x == b:
                u = y
            else:
                u = b - q - m + 1
            fits = (u >= lo) & (u + m + q <= hi) & (MIN_PERIODS * q <= hi - lo)
            q, m, u = q[fits], m[fits], u[fits]
            for part in (0, 4, 2, 1, 3):  # strings at quarters of the way
                if not len(q):
                    break
                at = u + (m - SIDE) * part // 4
                good = self.gram[at] == self.gram[at + q]
                q, m, u = q[good], m[good], u[good]
            if len(q):
                found.append(np.stack([q, u, m]))
        if not found:
            return found
        all_ = np.concatenate(found, axis=1)
        return all_[:, np.argsort(all_[0], kind="stable")]

    def _grown(self, x: int, q: int, limit: int, step: int) -> int:
        """The first position from x on (by step) that does not equal the one a period on, or the limit."""
        size, ids = 64, self.ids
        while x != limit:
            n = min(size, abs(limit - x))
            a = x if step > 0 else x - n + 1
            equal = ids[a:a + n] == ids[a + q:a + n + q]
            if step < 0:
                equal = equal[::-1]
            if not equal.all():
                return x + step * int(np.argmin(equal))
            x, size = x + step * n, size * 2
        return x

    def runs(self, b: int, lo: int, hi: int) -> list:
        """(start, end, period) of the runs within lo..hi that cross from b - 1 to b."""
        cand = self._candidates(b, lo, hi)
        out = []
        while len(cand) and cand.shape[1]:
            q, u, m = (int(v) for v in cand[:, 0])
            cand = cand[:, 1:]
            ids = self.ids
            if not np.array_equal(ids[u:u + m], ids[u + q:u + q + m]):
                continue
            s = self._grown(u - 1, q, lo - 1, -1) + 1
            e = self._grown(u + m, q, hi - q, 1) + q
            if e - s < max(MIN_WORDS, MIN_PERIODS * q):
                continue
            out.append((s, e, q))
            known = (cand[0] % q == 0) & (cand[1] >= s) & (cand[1] + cand[2] + cand[0] <= e)
            cand = cand[:, ~known]  # multiples of a period inside its run
        return out


_NONE = np.zeros(0, np.int64)


def grammar_runs(ids: np.ndarray) -> list:
    """(start, end, period) of all runs of ``ids``; a negative id equals no other."""
    rules, sequence = re_pair(ids.tolist())
    top = int(max(ids.max(initial=-1), -1)) + 1
    size = [1] * top
    for a, c in rules:
        size.append(size[a] + size[c])
    length = lambda s: size[s] if s >= 0 else 1
    crossing, at, first, found = _Crossing(ids), 0, {}, []
    starts = []
    for s in sequence:
        starts.append(at)
        first.setdefault(s, at)
        if at:
            found += crossing.runs(at, 0, len(ids))
        at += length(s)
    inside: dict = {}
    for r in range(len(rules) - 1, -1, -1):
        (a, c), p = rules[r], first[top + r]
        first.setdefault(a, p)
        first.setdefault(c, p + size[a])
    for r, (a, c) in enumerate(rules):
        p = first[top + r]
        own = [(s - p, e - p, q) for s, e, q in crossing.runs(p + size[a], p, p + size[top + r])] if size[top + r] >= MIN_WORDS else []
        if own or a in inside or c in inside:
            inside[top + r] = own
    places: dict = {}
    for s, p in zip(sequence, starts, strict=True):
        if s in inside:
            places.setdefault(s, []).append(p)
    for r in range(len(rules) - 1, -1, -1):
        here = places.pop(top + r, None)
        if not here:
            continue
        a, c = rules[r]
        found += [(p + s, p + e, q) for p in here for s, e, q in inside[top + r]]
        if a in inside:
            places.setdefault(a, []).extend(here)
        if c in inside:
            places.setdefault(c, []).extend(p + size[a] for p in here)
    return merged(found)


def merged(found: list) -> list:
    """Maximal stretches: those of one period that share at least a period are one."""
    out, by = [], {}
    for s, e, q in found:
        by.setdefault(q, set()).add((s, e))
    for q, spans in by.items():
        start = end = None
        for s, e in sorted(spans):
            if start is not None and s <= end - q:
                end = max(end, e)
                continue
            if start is not None:
                out.append((start, end, q))
            start, end = s, e
        out.append((start, end, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def runs_of(ids: np.ndarray, stretches: list) -> list:
    """(start, length, period) of the runs of a text, by start, then period."""
    if not stretches:
        return []
    parts, origin, at = [], [], 0
    for k, (s, e) in enumerate(stretches):
        parts += [ids[s:e], np.array([-1 - k])]
        origin.append((at, s))
        at += e - s + 1
    out, k = [], 0
    for s, e, q in grammar_runs(np.concatenate(parts)):
        while k + 1 < len(origin) and origin[k + 1][0] <= s:
            k += 1
        out.append((s - origin[k][0] + origin[k][1], e - s, q))
    return out


def summary(words: list, runs: list) -> tuple:
    """The contract's columns after doc_id."""
    best = (None, None, None, None)
    if runs:
        top = runs[0]
        for r in runs[1:]:
            if r[1] * top[2] > top[1] * r[2]:
                top = r
        best = (*top, 1000 * top[1] // top[2])
    kept = np.ones(len(words), bool)
    for s, n, q in runs:
        kept[s + q:s + n] = False
    text = " ".join(words if kept.all() else [words[i] for i in np.flatnonzero(kept).tolist()])
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    return (len(runs), *best, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest())


def found_in(texts: list) -> list:
    """Runs of each list of words."""
    known: dict = {}
    ids = [np.array([known.setdefault(w, len(known)) for w in t], np.int64) for t in texts]
    return [runs_of(i, s) for i, s in zip(ids, repeated_stretches(ids), strict=True)]


_DDL = ("doc_id bigint, n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, "
        "runs_sha256 string, collapsed_sha256 string")
_SCHEMA = pa.schema([("doc_id", pa.int64())] + [(n, pa.int64()) for n in ("n_runs", "start", "length", "period", "exponent_milli")]
                    + [("runs_sha256", pa.string()), ("collapsed_sha256", pa.string())])


def _report(batches):
    def flush(docs, texts):
        rows = [(d, *summary(t, r)) for d, t, r in zip(docs, texts, found_in(texts), strict=True)]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _SCHEMA, strict=True)], schema=_SCHEMA)

    docs, texts, held = [], [], 0
    for batch in batches:
        for doc_id, text in zip(batch.column("doc_id"), batch.column("text"), strict=True):
            doc_id = doc_id.as_py()
            words = damage(doc_id, _WORD.findall(text.as_py() or ""))
            docs.append(doc_id)
            texts.append(words)
            held += len(words) + 1
            if held >= WORDS_AT_ONCE:
                yield flush(docs, texts)
                docs, texts, held = [], [], 0
    if docs:
        yield flush(docs, texts)


def periodic_runs(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_runs, the run of the greatest exponent, two digests.

    Reads each whole text after the contract's damage. A null or empty text, or one
    without words, has no run: n_runs 0, four nulls and the digests of the empty string.
    A null doc_id counts as the empty string in the damage. Rows are judged one by one,
    repeated ones too; an empty table gives an empty result. Other columns are not read,
    whatever their names.
    """
    ship_code(docs.sparkSession)
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return base.mapInArrow(_report, _DDL)

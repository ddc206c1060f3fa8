"""Removal of repeated byte strings with sharded suffix arrays (induced sorting).

A byte goes if a string of ``LENGTH`` bytes that covers it also starts earlier (smaller
doc_id, or earlier in the same text). The steps:

1. Pieces. Each LENGTH-byte string has a key: the least hash of its GRAM-byte strings.
   Consecutive strings of one key make a piece, so each string lies in one piece, and
   equal strings lie in pieces of one key. Equal pieces fall together, first in the task
   that reads them, then by (key, piece's hash) after one shuffle of a few bytes a
   piece, read as a sorted stream; all but the earliest are repeats from end to end.
2. Suffix arrays. Where one key has several different pieces, or one that may hold a
   string twice, each of them goes into a shard of bounded size, one row each. A shard's suffixes are classified as S or
   L, the leftmost S suffixes' substrings are sorted by induction and named, the names'
   suffixes sorted recursively, and the array induced from them. Common prefixes with
   the suffix before are computed in text order (permuted); suffixes with LENGTH bytes in
   common form classes, and all but the earliest of a class are repeats.
3. A key with more than CAP different pieces is dealt over several shards by a hash. What
   is first in one of them is compared once more, by a 128-bit hash of its LENGTH bytes.
4. Each text is cut at the union of its repeats.

No task holds more than a shard, or one text.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cubeguard.functions.joins import checked_broadcast
from cubeguard.llm.common import ship_code, store

LENGTH, GRAM = 100, 40
#: Strings in a piece at most.
STRINGS = 1 << 10
#: Bytes of a shard (and one key's pieces more at most), and pieces of one key in a shard.
SHARD, CAP = 1 << 17, 1 << 14
#: Bytes of a text, and pieces of a task, that are looked at together.
BYTES, PIECES = 1 << 20, 1 << 18
_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)
_LAST = np.uint64(0x94D049BB133111EB)
#: Suffixes are induced a bucket at a time if a bucket holds so many on average, else one by one.
_WIDE = 128


# --- suffix arrays -----------------------------------------------------------

def _is_s(t: np.ndarray) -> np.ndarray:
    """Suffixes that are smaller than the next one; the last is the least of all."""
    step = np.sign(np.diff(t))
    at = np.where(step != 0, np.arange(len(step)), len(step))
    nxt = np.minimum.accumulate(at[::-1])[::-1]
    return np.append(np.append(step, 1)[nxt] > 0, True)


def _buckets(t, size):
    ends = np.cumsum(np.bincount(t, minlength=size))
    return np.concatenate([[0], ends[:-1]]), ends


def _induce_wide(t, s, lms, size):
    """The suffixes' order from the LMS suffixes' order, a bucket at a time."""
    begin, end = _buckets(t, size)
    sa = np.full(len(t), -1, np.int32)
    count = np.bincount(t[lms], minlength=size)
    lms_from = end - count
    grouped = lms[np.argsort(t[lms], kind="stable")]
    at = np.cumsum(count) - count
    sa[np.repeat(lms_from - at, count) + np.arange(len(grouped))] = grouped

    # whether a suffix is L (S) and so moved by the one after it; nothing comes after the last
    is_l, is_s = ~s, s.copy()
    is_s[-1] = False

    def put(chunk, wanted, ends, step):
        j = chunk - 1
        j = j[wanted[j]]
        if not len(j):
            return
        c = t[j]
        order = c.argsort(kind="stable")
        c = c[order]
        n = np.bincount(c, minlength=size)
        sa[ends[c] + step * (np.arange(len(c)) - (n.cumsum() - n)[c])] = j[order]
        ends += step * n

    head = begin.copy()
    for c in np.flatnonzero(end > begin).tolist():
        lo = int(begin[c])
        while lo < head[c]:
            hi = int(head[c])
            put(sa[lo:hi], is_l, head, 1)
            lo = hi
        if count[c]:
            put(sa[lms_from[c]:end[c]], is_l, head, 1)
    tail = end - 1
    for c in np.flatnonzero(end > begin)[::-1].tolist():
        hi = int(end[c]) - 1
        while hi > tail[c]:
            lo = int(tail[c])
            put(sa[lo + 1:hi + 1][::-1], is_s, tail, -1)
            hi = lo
        if head[c] > begin[c]:
            put(sa[begin[c]:head[c]][::-1], is_s, tail, -1)
    return sa


def _induce_narrow(t, s, lms, size):
    """As above, a suffix at a time."""
    begin, end = _buckets(t, size)
    n = len(t)
    # the bucket of the suffix before, by its type; -1 where it has the other type or there is none
    before = np.concatenate([[-1], t[:-1], [-1]])
    large = np.concatenate([[False], ~s[:-1], [False]])
    to_l, to_s = np.where(large, before, -1).tolist(), np.where(large, -1, before).tolist()
    sa = np.full(n, -1, np.int64)
    count = np.bincount(t[lms], minlength=size)
    grouped = lms[np.argsort(t[lms], kind="stable")]
    sa[np.repeat(end - count - (np.cumsum(count) - count), count) + np.arange(len(grouped))] = grouped
    sa = sa.tolist()
    head = begin.tolist()
    for p in sa:
        c = to_l[p]
        if c >= 0:
            k = head[c]
            sa[k] = p - 1
            head[c] = k + 1
    tail = end.tolist()
    for p in reversed(sa):
        c = to_s[p]
        if c >= 0:
            k = tail[c] - 1
            sa[k] = p - 1
            tail[c] = k
    return np.array(sa, np.int32)


def _names(t, lms, ordered):
    """Names of the LMS substrings, by rank in ``ordered``; equal substrings have one name."""
    stop = np.append(lms[1:], lms[-1])  # a substring ends with the next one's first symbol
    length = np.zeros(len(t), np.int32)
    length[lms] = stop - lms
    a, b = ordered[:-1], ordered[1:]
    same = length[a] == length[b]
    left = np.flatnonzero(same)
    k = 0
    while len(left):
        differs = t[a[left] + k] != t[b[left] + k]
        same[left[differs]] = False
        left = left[~differs]
        left = left[length[a[left]] > k]
        k += 1
    name = np.empty(len(t), np.int32)
    name[ordered] = np.concatenate([[0], np.cumsum(~same)])
    return name[lms]


def suffix_array(t: np.ndarray) -> np.ndarray:
    """Suffix array of ``t``, whose last symbol is its only 0, by induced sorting."""
    size = int(t.max()) + 1
    if size == len(t) and np.bincount(t).max() == 1:  # a permutation
        sa = np.empty(len(t), np.int32)
        sa[t] = np.arange(len(t), dtype=np.int32)
        return sa
    s = _is_s(t)
    lms = np.flatnonzero(s[1:] & ~s[:-1]).astype(np.int32) + 1
    induce = _induce_wide if size * _WIDE <= len(t) else _induce_narrow
    if len(lms) > 1:
        rough = induce(t, s, lms, size)
        is_lms = np.zeros(len(t), bool)
        is_lms[lms] = True
        names = _names(t, lms, rough[is_lms[rough]])
        lms = lms[suffix_array(names)]
    return induce(t, s, lms, size)


def common_prefixes(t: np.ndarray, sa: np.ndarray, wanted: np.ndarray, most: int) -> np.ndarray:
    """For the ``wanted`` suffixes, in text order, the prefix shared with the one before in ``sa``, up to ``most`` bytes.

    ``t`` holds bytes; eight are compared at a time, and one by one where those differ.
    """
    before = np.full(len(t) + 1, -1, np.int32)
    before[sa[1:]] = sa[:-1]
    padded = np.concatenate([t, np.zeros(most + 8, t.dtype)]).astype(np.uint64)
    word, width = padded, 1
    while width < 8:
        word = word[:-width] << np.uint64(8 * width) | word[width:]
        width *= 2
    plcp = np.zeros(len(t), np.int32)
    at = np.flatnonzero(wanted & (before[:-1] >= 0))
    prev = before[at]
    for k in range(0, most, 8):
        same = word[at + k] == word[prev + k]
        differs = ~same
        a, b = at[differs] + k, prev[differs] + k
        extra = np.zeros(len(a), np.int32)
        go = np.ones(len(a), bool)
        for j in range(8):
            go &= padded[a + j] == padded[b + j]
            extra += go
        plcp[at[differs]] = np.minimum(k + extra, most)
        at, prev = at[same], prev[same]
    plcp[at] = most
    return plcp


def repeats(texts: list, rank: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Which LENGTH-byte strings of the texts start earlier elsewhere: a flag a byte, texts in a row with a mark after each.

    ``rank`` orders the texts' documents and ``start`` is where a context starts in its own.
    """
    sizes = np.array([len(c) for c in texts])
    bytes_ = np.frombuffer(b"\0".join([*texts, b""]), np.uint8)
    ends = np.cumsum(sizes + 1) - 1
    t = np.append(bytes_.astype(np.int16) + 2, np.int16(0))
    t[ends] = 1
    sa = suffix_array(t)[1:]
    first = ends - sizes
    owner = np.repeat(np.arange(len(texts)), sizes + 1)
    offset = np.arange(len(bytes_)) - first[owner]
    key = (rank[owner].astype(np.int64) << 40) + start[owner] + offset
    whole = sizes[owner] - offset >= LENGTH
    plcp = common_prefixes(bytes_, sa, whole, LENGTH)
    sa = sa[whole[sa]]
    joined = plcp[sa] >= LENGTH
    flag = np.zeros(len(bytes_), bool)
    if len(sa):
        heads = np.flatnonzero(~joined)
        earliest = np.minimum.reduceat(key[sa], heads)
        flag[sa] = key[sa] > np.repeat(earliest, np.diff(np.append(heads, len(sa))))
    return flag


# --- pieces ------------------------------------------------------------------

def _least(h: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` consecutive hashes."""
    size = 1
    while size * 2 <= width:
        h, size = np.minimum(h[:-size], h[size:]), size * 2
    rest = width - size
    return np.minimum(h[:len(h) - rest], h[rest:])


def _gram_hashes(b: np.ndarray) -> np.ndarray:
    """A hash of each GRAM-byte string: those of 32 and of 8 bytes make one."""
    h, w = (b.astype(np.uint64) + np.uint64(1)) * _MIX, 1
    while w < 32:
        h = h[:-w] * _BASE + h[w:]
        h ^= h >> np.uint64(29)
        h *= _MIX
        w *= 2
        if w == GRAM - 32:
            short = h
    h = h[:len(b) - GRAM + 1] * _BASE + short[32:]
    for shift in (32, 29):  # the least hash must be one by chance, not by its gram's form
        h ^= h >> np.uint64(shift)
        h *= _LAST
    h ^= h >> np.uint64(32)
    return h


def pieces(b: np.ndarray):
    """(start, end, key, inner) of the pieces of a text: consecutive LENGTH-byte strings with one least hash.

    ``inner`` marks pieces that may hold a string twice: their least hash occurs twice.
    """
    out = []
    width = LENGTH - GRAM + 1
    for a in range(0, len(b) - LENGTH + 1, BYTES):
        h = _gram_hashes(b[a:a + BYTES + LENGTH - 1])
        least = _least(h, width)
        new = np.concatenate([[True], least[1:] != least[:-1]])
        new[::STRINGS] = True
        start, key = np.flatnonzero(new), least[new]
        # least hashes in text order: equal ones beside each other lie in the strings between
        edge = np.zeros(width - 1, np.uint64)
        x = np.flatnonzero(~_least(~np.concatenate([edge, least, edge]), width) == h)
        i = np.flatnonzero(h[x][1:] == h[x][:-1])
        first, last = np.searchsorted(start, np.clip([x[i + 1] - width + 1, x[i]], 0, len(least) - 1), "right") - 1
        marks = np.zeros(len(start) + 1, np.int64)
        np.add.at(marks, np.minimum(first, last), 1)
        np.add.at(marks, np.maximum(first, last) + 1, -1)
        out.append((start + a, np.append(start[1:], len(least)) + a + LENGTH - 1, key.view(np.int64), np.cumsum(marks)[:-1] > 0))
    if not out:
        none = np.zeros(0, np.int64)
        return none, none, none, none > 0
    return tuple(np.concatenate(c) for c in zip(*out, strict=True))


def _merged(start, end):
    """Union of intervals, as sorted arrays."""
    if not len(start):
        return start, end
    order = np.argsort(start, kind="stable")
    start, end = start[order], np.maximum.accumulate(end[order])
    new = np.concatenate([[True], start[1:] > end[:-1]])
    return start[new], end[np.append(np.flatnonzero(new)[1:] - 1, len(end) - 1)]


#: Kinds of rows between the steps.
_PLAIN, _INNER, _DONE = 0, 1, 2
_OCC_DDL = "fp bigint, ctx bigint, doc_id bigint, tag bigint, span bigint, kind tinyint"
_OCC = pa.schema([(n, pa.int64()) for n in ("fp", "ctx", "doc_id", "tag", "span")] + [("kind", pa.int8())])


def _span(start, end):
    return (start << 32) | end


def _piece_rows(batches):
    """Pieces with their key, hash and place; those that a text of the same task holds earlier are done."""
    def flush(docs, parts):
        fp, ctx, start, end, inner, doc = (np.concatenate(p) for p in zip(*parts, strict=True))
        ranked = sorted(range(len(docs)), key=lambda d: (docs[d][0] is not None, docs[d][0] or 0, docs[d][1]))
        rank = np.empty(len(docs), np.int64)
        rank[ranked] = np.arange(len(docs))
        order = np.lexsort((start, rank[doc], ctx, fp))
        later = np.concatenate([[False], (fp[order][1:] == fp[order][:-1]) & (ctx[order][1:] == ctx[order][:-1])])
        keep, gone = order[~later], order[later]
        gone_doc, gone_start, gone_end = [], [], []
        gone = gone[np.argsort(doc[gone], kind="stable")]
        for d, own in zip(*_groups(doc[gone]), strict=True):
            s, e = _merged(start[gone[own]], end[gone[own]])
            gone_doc.append(np.full(len(s), d))
            gone_start.append(s)
            gone_end.append(e)
        d = np.concatenate([doc[keep], *gone_doc]).astype(np.int64)
        s, e = np.concatenate([start[keep], *gone_start]), np.concatenate([end[keep], *gone_end])
        n, extra = len(keep), len(d) - len(keep)
        dealt = (d[n:] * 2654435761 + s[n:]) * 40503  # any partition will do
        kind = np.concatenate([np.where(inner[keep], _INNER, _PLAIN), np.full(extra, _DONE)]).astype(np.int8)
        ids = pa.array([x[0] for x in docs], pa.int64()).take(pa.array(d))
        tags = pa.array([x[1] for x in docs], pa.int64()).take(pa.array(d))
        cols = [pa.array(np.concatenate([fp[keep], dealt])), pa.array(np.concatenate([ctx[keep], np.zeros(extra, np.int64)])), ids, tags,
                pa.array(_span(s, e)), pa.array(kind)]
        table = pa.RecordBatch.from_arrays(cols, schema=_OCC)
        for i in range(0, len(d), 10_000):
            yield table.slice(i, 10_000)

    docs, parts, held = [], [], 0
    for batch in batches:
        for doc_id, tag, text in zip(*(batch.column(c) for c in ("doc_id", "tag", "text")), strict=True):
            raw = text.as_buffer() if text.is_valid else b""
            b = np.frombuffer(raw, np.uint8) if text.is_valid and len(raw) else np.zeros(0, np.uint8)
            start, end, fp, inner = pieces(b)
            if not len(start):
                continue
            view = memoryview(b)
            ctx = np.array([xxhash.xxh3_64_intdigest(view[s:e]) for s, e in zip(start.tolist(), end.tolist(), strict=True)], np.uint64).view(np.int64)
            parts.append((fp, ctx, start, end, inner, np.full(len(start), len(docs))))
            docs.append((doc_id.as_py(), tag.as_py()))
            held += len(start)
            if held >= PIECES:
                yield from flush(docs, parts)
                docs, parts, held = [], [], 0
    if docs:
        yield from flush(docs, parts)


def _groups(sorted_):
    """Values and slices of a sorted array."""
    if not len(sorted_):
        return sorted_, []
    first = np.flatnonzero(np.concatenate([[True], sorted_[1:] != sorted_[:-1]]))
    stops = np.append(first[1:], len(sorted_))
    return sorted_[first], [slice(a, z) for a, z in zip(first.tolist(), stops.tolist(), strict=True)]


_PLACE_DDL = "doc_id bigint, tag bigint, span bigint, fp bigint"
_PLACE = pa.schema([(n, pa.int64()) for n in ("doc_id", "tag", "span", "fp")])


def _earliest(batches):
    """Sorted by (fp, ctx, place): repeats (fp null), and the first of each different piece where a key has several, or one that may repeat inside."""
    last, head = None, None  # the row before; (doc_id, tag, span) of its key's first row, None once it is out
    for batch in batches:
        kind = batch.column("kind").to_numpy()
        done = kind == _DONE
        if done.any():
            over = batch.filter(pa.array(done))
            yield pa.RecordBatch.from_arrays([over.column("doc_id"), over.column("tag"), over.column("span"), pa.nulls(over.num_rows, pa.int64())], schema=_PLACE)
            batch, kind = batch.filter(pa.array(~done)), kind[~done]
        n = batch.num_rows
        if not n:
            continue
        fp, ctx = batch.column("fp").to_numpy(), batch.column("ctx").to_numpy()
        new = np.concatenate([[last is None or fp[0] != last[0]], fp[1:] != fp[:-1]])
        differs = np.concatenate([[last is None or ctx[0] != last[1]], ctx[1:] != ctx[:-1]]) | new
        further = differs & ~new
        first = np.maximum.accumulate(np.where(new, np.arange(n), -1))
        heads = np.unique(first[further])
        need = further | (differs & (kind == _INNER))
        need[heads[heads >= 0]] = True
        out = need | ~differs
        place = [batch.column(c) for c in ("doc_id", "tag", "span")]
        if len(heads) and heads[0] < 0 and head is not None:
            yield pa.RecordBatch.from_pylist([dict(zip(("doc_id", "tag", "span", "fp"), (*head, int(fp[0])), strict=True))], schema=_PLACE)
            head = None
        if new.any():
            i = int(first[-1])
            head = None if need[i] else tuple(c[i].as_py() for c in place)
        last = fp[-1], ctx[-1]
        mask = pa.array(out)
        hashes = pa.array(fp[out], mask=~need[out])
        yield pa.RecordBatch.from_arrays([c.filter(mask) for c in place] + [hashes], schema=_PLACE)


# --- shards ------------------------------------------------------------------

_CTX_DDL = "fp bigint, salt int, hot boolean, doc_id bigint, tag bigint, start bigint, bytes binary"
_CTX = pa.schema([("fp", pa.int64()), ("salt", pa.int32()), ("hot", pa.bool_()), ("doc_id", pa.int64()), ("tag", pa.int64()), ("start", pa.int64()), ("bytes", pa.binary())])


def _needed(batches):
    """The bytes of the pieces of each text that shards need."""
    for batch in batches:
        rows = []
        for doc_id, tag, text, needs in zip(*(batch.column(c) for c in ("doc_id", "tag", "text", "needs")), strict=True):
            raw, doc_id, tag = text.as_buffer(), doc_id.as_py(), tag.as_py()
            view = memoryview(raw)
            for x in needs.as_py():
                s, e = x["span"] >> 32, x["span"] & 0xFFFFFFFF
                rows.append((x["fp"], x["salt"], x["hot"], doc_id, tag, s, bytes(view[s:e])))
            if len(rows) >= 20_000:
                yield _batch(rows, _CTX)
                rows = []
        if rows:
            yield _batch(rows, _CTX)


def _batch(rows, schema):
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


_MARK_DDL = "doc_id bigint, tag bigint, span bigint, h1 bigint, h2 bigint"
_MARK = pa.schema([(n, pa.int64()) for n in ("doc_id", "tag", "span", "h1", "h2")])


def shard_marks(rows: list) -> list:
    """(doc_id, tag, span, null, null) of the repeats in a shard of (hot, doc_id, tag, start, bytes) rows;
    for a hot key also (doc_id, tag, start, h1, h2) of the strings that are first here."""
    place = lambda r: (r[1] is not None, r[1] or 0, r[2])
    ranks = {p: k for k, p in enumerate(sorted({place(r) for r in rows}))}
    flag = repeats([r[4] for r in rows], np.array([ranks[place(r)] for r in rows]), np.array([r[3] for r in rows]))
    out, at = [], 0
    for hot, doc_id, tag, start, raw in rows:
        n = len(raw)
        own = flag[at:at + n]
        at += n + 1
        edges = np.flatnonzero(np.diff(np.concatenate([[0], own, [0]]).astype(np.int8))).tolist()
        out += [(doc_id, tag, _span(start + s, start + e - 1 + LENGTH), None, None) for s, e in zip(edges[::2], edges[1::2], strict=True)]
        if hot:
            for i in np.flatnonzero(~own[:n - LENGTH + 1]).tolist():
                h = xxhash.xxh3_128_digest(raw[i:i + LENGTH])
                out.append((doc_id, tag, start + i, int.from_bytes(h[:8], "big", signed=True), int.from_bytes(h[8:], "big", signed=True)))
    return out


def _shards(batches):
    """Streams pieces sorted by (fp, salt); whole groups are gathered up to a shard."""
    rows, size, last = [], 0, None
    for batch in batches:
        cols = [batch.column(c).to_pylist() for c in ("fp", "salt", "hot", "doc_id", "tag", "start", "bytes")]
        for fp, salt, *row in zip(*cols, strict=True):
            if size >= SHARD and (fp, salt) != last:
                marks = shard_marks(rows)
                if marks:
                    yield _batch(marks, _MARK)
                rows, size = [], 0
            last = fp, salt
            rows.append(row)
            size += len(row[4])
    if rows:
        marks = shard_marks(rows)
        if marks:
            yield _batch(marks, _MARK)


# --- texts -------------------------------------------------------------------

_OUT_DDL = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary"
_OUT = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("kept", pa.binary())])


def _cut(with_bytes):
    def run(batches):
        for batch in batches:
            rows, size = [], 0
            for doc_id, n, text, spans in zip(*(batch.column(c) for c in ("doc_id", "n", "text", "spans")), strict=True):
                raw = memoryview(text.as_buffer()) if text.is_valid else memoryview(b"")
                doc_id, total = doc_id.as_py(), len(raw)
                spans = np.array(spans.as_py() or [], np.int64)
                start, end = _merged(spans >> 32, spans & 0xFFFFFFFF)
                edges = [0, *np.stack([start, end], 1).ravel().tolist(), total]
                sha, kept = hashlib.sha256(), []
                for a, b in zip(edges[::2], edges[1::2], strict=True):
                    sha.update(raw[a:b])
                    if with_bytes:
                        kept.append(bytes(raw[a:b]))
                rows.append((doc_id, total, int((end - start).sum()), len(start), sha.hexdigest(), b"".join(kept) if with_bytes else None))
                if n.as_py() > 1:  # the same row again: all of it starts earlier
                    gone = total >= LENGTH
                    again = (doc_id, total, total if gone else 0, int(gone), hashlib.sha256(b"" if gone else raw).hexdigest(), b"" if gone else bytes(raw))
                    rows += [again if with_bytes else (*again[:5], None)] * (n.as_py() - 1)
                size += total
                if size >= 16 << 20:
                    yield _batch(rows, _OUT)
                    rows, size = [], 0
            if rows:
                yield _batch(rows, _OUT)
    return run


def _keyed(docs: DataFrame) -> DataFrame:
    """doc_id, tag, n, text: rows that share a doc_id are told apart by a tag; n equal rows are one."""
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    twice = checked_broadcast(base.groupBy("doc_id").agg(F.count(F.lit(1)).alias("k")).where("k > 1").select(F.col("doc_id").alias("again")))
    same = base["doc_id"].eqNullSafe(twice["again"])
    alone = base.join(twice, same, "left_anti").select("doc_id", F.lit(0).cast("long").alias("tag"), F.lit(1).cast("long").alias("n"), "text")
    more = (base.join(twice, same, "left_semi").groupBy("doc_id", "text").agg(F.count(F.lit(1)).alias("n"))
            .select("doc_id", F.xxhash64("text").alias("tag"), "n", "text"))
    return alone.unionByName(more)


def _at(left: DataFrame, right: DataFrame):
    return left["doc_id"].eqNullSafe(right["d"]) & (left["tag"] == right["t"])


def repeated_spans(texts: DataFrame) -> DataFrame:
    """(doc_id, tag, span) intervals, start << 32 | end, whose union is what goes, for texts with unique (doc_id, tag)."""
    spark = texts.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    occ = texts.select("doc_id", "tag", "text").mapInArrow(_piece_rows, _OCC_DDL)
    found = store(occ.repartition(parts, "fp").sortWithinPartitions("fp", "ctx", "doc_id", "tag", "span").mapInArrow(_earliest, _PLACE_DDL))
    need = found.where(F.col("fp").isNotNull())
    many = checked_broadcast(need.groupBy("fp").agg(F.count(F.lit(1)).alias("k")).where(F.col("k") > CAP).select(F.col("fp").alias("hot_fp"), "k"))
    salt = F.pmod(F.xxhash64("doc_id", "span"), F.ceil(F.col("k") / CAP)).cast("int")
    need = need.join(many, need["fp"] == many["hot_fp"], "left").select(
        "doc_id", "tag", F.struct("fp", F.coalesce(salt, F.lit(0)).alias("salt"), F.col("k").isNotNull().alias("hot"), "span").alias("x"))
    of_text = store(need.groupBy(F.col("doc_id").alias("d"), F.col("tag").alias("t")).agg(F.collect_list("x").alias("needs")))
    some = _some(texts, of_text)
    ctx = some.join(of_text, _at(some, of_text)).select("doc_id", "tag", "text", "needs").mapInArrow(_needed, _CTX_DDL)
    marks = store(ctx.repartition(parts, "fp", "salt").sortWithinPartitions("fp", "salt", "doc_id", "tag", "start").mapInArrow(_shards, _MARK_DDL))
    # equal strings of one place tie at the first rank; a group holds one place a shard at most
    order = F.rank().over(Window.partitionBy("h1", "h2").orderBy("doc_id", "tag", "span"))
    hot = (marks.where(F.col("h1").isNotNull()).withColumn("r", order).where(F.col("r") > 1)
           .select("doc_id", "tag", F.shiftleft("span", 32).bitwiseOR(F.col("span") + LENGTH).alias("span")))
    sure = marks.where(F.col("h1").isNull()).select("doc_id", "tag", "span")
    return found.where(F.col("fp").isNull()).select("doc_id", "tag", "span").unionByName(sure).unionByName(hot)


def _some(texts: DataFrame, of_text: DataFrame) -> DataFrame:
    """Texts that ``of_text`` names, before their join moves them; as they are where the names are too many to send."""
    ids = checked_broadcast(of_text.select("d", "t"))
    return texts.join(ids, _at(texts, ids), "left_semi")


def suffix_dedup(docs: DataFrame, with_bytes: bool = False) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept_sha256 (``with_bytes``: also kept).

    Whole texts as UTF-8 bytes; a null or empty text has none and nothing to remove, nor
    has one under LENGTH bytes. Null doc_ids come first; rows that share a doc_id are put
    in order by a hash of their text, and of equal rows the later ones are repeats of the
    first. Strings are judged on the input, never across documents. An empty table gives
    an empty result; other columns are not read, whatever their names.
    """
    ship_code(docs.sparkSession)
    texts = _keyed(docs)
    spans = store(repeated_spans(texts).groupBy(F.col("doc_id").alias("d"), F.col("tag").alias("t")).agg(F.collect_list("span").alias("spans")))
    ids = checked_broadcast(spans.select("d", "t"))
    none = F.lit(None).cast("array<bigint>").alias("spans")
    clean = texts.join(ids, _at(texts, ids), "left_anti").select("doc_id", "n", "text", none)
    some = _some(texts, spans)
    hit = some.join(spans, _at(some, spans)).select("doc_id", "n", "text", "spans")
    out = clean.unionByName(hit).mapInArrow(_cut(with_bytes), _OUT_DDL)
    return out if with_bytes else out.drop("kept")

"""Near-duplicate groups: MinHash signatures joined by multi-index Hamming search.

A document's set is its distinct word shingles. ``SLOTS`` MinHash values of
``b`` = 16 bits make its signature; two signatures differ in as many slots as
their distance says. The signature is split into ``CHUNKS`` chunks of ``WIDTH``
slots. Two signatures at a distance of at most ``RADIUS`` = 2 * CHUNKS - 1 slots
have, by pigeonhole, one chunk with at most one wrong slot, so each document
enumerates the single errors of each chunk (one slot left out) as keys, and
every such pair meets under a key. At a similarity of 0.8 the expected distance
is a fifth of the slots; a pair misses all keys with probability 1e-7.

Documents that meet are confirmed on their full sets, never on the signature.
Only links that are needed to join a group are written, not all pairs.

Skew: equal sets fall together first (map-side combined). What remains meets in
loose groups (components of the key graph); a group is cut into blocks by a hash,
of bounded rows and shingles, and a task holds two blocks at most.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cubeguard.llm.common import connected_components, ship_code, store, use_alone

CHUNKS, WIDTH = 12, 5
SLOTS, RADIUS = CHUNKS * WIDTH, 2 * CHUNKS - 1
#: Pairs that meet by a key are looked at on their full sets up to this distance:
#: beyond it, a similarity of 0.8 has a probability under 1e-7.
LOOK = SLOTS // 2 - 1
#: A block holds about so many documents and shingles; a task holds two blocks.
BLOCK_ROWS, BLOCK_SHINGLES = 1024, 2_000_000
#: Shingles hashed at a time, and words whose hash a Python worker remembers.
SLICE, REMEMBERED = 1 << 16, 500_000

_rng = np.random.Generator(np.random.PCG64(20))
_MUL = _rng.integers(1, 1 << 63, SLOTS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _rng.integers(0, 1 << 63, SLOTS, dtype=np.uint64)
_MIX = np.uint64(0x9E3779B97F4A7C15)


class _WordHashes(dict):
    """word -> 64-bit hash; forgets all when full, so its memory is bounded."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.forget()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value

    def forget(self) -> None:
        self.clear()


_WORDS = _WordHashes()


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    return (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)


def shingle_set(text: str | None, size: int) -> np.ndarray:
    """Sorted distinct 64-bit fingerprints of the word shingles of a whole text.

    Words are runs of anything but [\\x20\\x09-\\x0D] after A-Z are lower-cased:
    what bytes.lower() and bytes.split() do.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(_WORDS.__getitem__, words), np.uint64, len(words))
    n = min(size, len(h))
    out = np.full(len(h) - n + 1, n, np.uint64)
    for k in range(n):
        out = _mixed(out * _MIX + h[k:len(h) - n + 1 + k])
    return np.unique(out)


def signature(shingles: np.ndarray) -> np.ndarray:
    """b-bit MinHash signature of a non-empty set."""
    low = np.full(SLOTS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), SLICE):
        part = shingles[at:at + SLICE]
        low = np.minimum(low, (part[None, :] * _MUL[:, None] + _ADD[:, None]).min(axis=1))
    return (_mixed(low) >> np.uint64(48)).astype(np.uint16)


def _profiles(size: int):
    schema = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("digest", pa.binary()), ("sig", pa.binary())])

    def run(batches):
        use_alone(_WORDS)
        for batch in batches:
            counts, digests, sigs = [], [], []
            for text in batch.column(1).to_pylist():
                own = shingle_set(text, size)
                counts.append(len(own))
                digests.append(xxhash.xxh3_128_digest(own.tobytes()) if len(own) else None)
                sigs.append(signature(own).tobytes() if len(own) else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(digests, pa.binary()), pa.array(sigs, pa.binary())], schema=schema)

    return run


def _keys(batches):
    """(rep, key) for each chunk and each slot of it that is left out."""
    salts = _mixed(np.arange(1, SLOTS + 1, dtype=np.uint64) * _MIX).reshape(CHUNKS, WIDTH)
    for batch in batches:
        sigs = batch.column(1).to_pylist()
        if not sigs:
            continue
        sig = np.frombuffer(b"".join(sigs), np.uint16).reshape(-1, CHUNKS, WIDTH).astype(np.uint64)
        keys = np.empty(sig.shape, np.uint64)
        for out in range(WIDTH):
            kept = [k for k in range(WIDTH) if k != out]
            packed = np.zeros(sig.shape[:2], np.uint64)
            for k in kept:
                packed = (packed << np.uint64(16)) | sig[:, :, k]
            keys[:, :, out] = _mixed(packed ^ salts[None, :, out]) + salts[None, :, out]
        rep = np.repeat(batch.column(0).to_numpy(zero_copy_only=False), SLOTS)
        yield pa.RecordBatch.from_arrays([pa.array(rep, pa.int64()), pa.array(keys.reshape(-1).view(np.int64))], names=["rep", "key"])


def _sets(size: int):
    names = ["root", "rep", "nb", "sig", "shingles"]

    def run(batches):
        use_alone(_WORDS)
        for batch in batches:
            shingles = [shingle_set(t, size) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("root"), batch.column("rep"), batch.column("nb"), pa.array([signature(s).tobytes() for s in shingles], pa.binary()), pa.array([s.tobytes() for s in shingles], pa.binary())], names=names)

    return run


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest index reachable, by repeated minima over the links."""
    low = np.arange(n)
    while len(a):
        m = np.minimum(low[a], low[b])
        np.minimum.at(low, a, m)
        np.minimum.at(low, b, m)
        low = low[low]
        open_ = low[a] != low[b]
        if not open_.any():
            break
    return low


def links_of_blocks(reps, sides, sigs, sets, percent: int):
    """Links that join the rows of two blocks: (rep, smallest rep it reaches here).

    Rows of one side were compared in that side's own task, unless there is
    one side only. Each row's candidates are counted at once on full sets.
    """
    order = np.argsort(reps, kind="stable")
    reps, sides = np.asarray(reps)[order], np.asarray(sides)[order]
    sig = np.stack([np.frombuffer(sigs[k], np.uint16) for k in order])
    own = [np.frombuffer(sets[k], np.uint64) for k in order]
    n, sizes = len(own), np.array([len(s) for s in own])
    one = sides.min() == sides.max()
    starts = np.concatenate([[0], np.cumsum(sizes)])
    _, ids = np.unique(np.concatenate(own), return_inverse=True)
    seen = np.zeros(ids.max() + 1, bool)
    left, right = [], []
    for k in range(n - 1):
        rest = np.arange(k + 1, n) if one else k + 1 + np.flatnonzero(sides[k + 1:] != sides[k])
        # Sizes alone can rule a pair out: |smaller| / |larger| bounds the similarity.
        rest = rest[(100 * np.minimum(sizes[rest], sizes[k]) >= percent * np.maximum(sizes[rest], sizes[k]))]
        rest = rest[(sig[rest] != sig[k]).sum(axis=1) <= LOOK]
        if not len(rest):
            continue
        mine = ids[starts[k]:starts[k + 1]]
        seen[mine] = True
        both = np.array([np.count_nonzero(seen[ids[starts[r]:starts[r + 1]]]) for r in rest])
        seen[mine] = False
        rest = rest[100 * both >= percent * (sizes[k] + sizes[rest] - both)]
        left.append(np.full(len(rest), k))
        right.append(rest)
    if not left:
        return reps[:0], reps[:0]
    root = _roots(n, np.concatenate(left), np.concatenate(right))
    tied = np.flatnonzero(root != np.arange(n))
    return reps[tied], reps[root[tied]]


def _links(percent: int):
    """Streams rows sorted by (root, lo, hi); holds one pair of blocks at a time."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches):
        def flush(rows):
            if len(rows) > 1:
                a, b = links_of_blocks([r[0] for r in rows], [r[1] for r in rows], [r[2] for r in rows], [r[3] for r in rows], percent)
                if len(a):
                    yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], schema=schema)

        key, rows = None, []
        for batch in batches:
            cols = [batch.column(c).to_pylist() for c in ("root", "lo", "hi", "rep", "block", "sig", "shingles")]
            for root, lo, hi, *row in zip(*cols, strict=True):
                if (root, lo, hi) != key:
                    yield from flush(rows)
                    key, rows = (root, lo, hi), []
                rows.append(row)
        yield from flush(rows)

    return run


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept.

    Links documents with 100 * |A & B| >= percent * |A | B| on their sets of
    ``size``-word shingles (fewer words: the whole sequence as one shingle).

    Null or empty texts and those without words have the empty set and link with
    nothing. A null doc_id links with nothing either; its component_id is null and
    it is kept. Rows that share a doc_id are one document. An empty table gives an
    empty result. Other columns are not read, whatever their names.
    """
    ship_code(docs.sparkSession)
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    prof = store(base.mapInArrow(_profiles(size), "doc_id long, n_shingles long, digest binary, sig binary"))
    known = prof.where(F.col("doc_id").isNotNull() & F.col("digest").isNotNull())
    reps = store(known.groupBy("digest", "sig").agg(F.min("doc_id").alias("rep"), F.max("n_shingles").alias("n")))

    keys = reps.select("rep", "sig").mapInArrow(_keys, "rep long, key long")
    meet = Window.partitionBy("key").orderBy("rep")
    star = (keys.withColumn("hub", F.first("rep").over(meet)).where(F.col("hub") != F.col("rep"))
            .select("rep", "hub").distinct())
    loose = connected_components(star, "rep", "hub")
    members = store(loose.join(reps.select(F.col("rep").alias("node"), "n"), "node"))
    blocks = members.groupBy("root").agg(F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS), F.ceil(F.sum("n") / BLOCK_SHINGLES)).cast("int").alias("nb"))
    active = members.join(blocks, "root").select("root", F.col("node").alias("rep"), "nb").distinct()
    # One plan at every size: Spark would broadcast a small ``active`` and shuffle the texts beyond.
    text = base.join(active.hint("merge"), base["doc_id"] == active["rep"]).select("root", "rep", "nb", "text")
    sets = text.mapInArrow(_sets(size), "root long, rep long, nb int, sig binary, shingles binary")
    own = F.pmod(F.xxhash64("rep"), F.col("nb")).cast("int")
    dealt = (sets.withColumn("block", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)))
             .select("root", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "rep", "block", "sig", "shingles"))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    links = (dealt.repartition(parts, "root", "lo", "hi").sortWithinPartitions("root", "lo", "hi")
             .mapInArrow(_links(percent), "a long, b long"))
    # Rows of one doc_id but different texts are one document: their sets' representatives are tied as well.
    same = known.groupBy("doc_id").agg(F.min("digest").alias("d0"), F.max("digest").alias("d1")).where("d0 <> d1").select("doc_id")
    twice = (known.join(same, "doc_id").join(reps.select("digest", "rep"), "digest").select(F.col("doc_id").alias("a"), F.col("rep").alias("b")))
    comp = store(connected_components(links.union(twice)))
    label = reps.select("digest", "rep").join(comp, F.col("rep") == F.col("node"), "left").select("digest", F.coalesce("root", "rep").alias("component"))
    out = prof.join(label, "digest", "left")
    comp_id = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return out.select("doc_id", "n_shingles", comp_id.alias("component_id")).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))

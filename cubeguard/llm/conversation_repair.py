"""Conversation structure repair: a min-plus dynamic programme over runs of equal rows.

A row of a conversation is a symbol: its role's initial and its first fault. The
roles that a conversation may have are the words of ``(s?(ua)+)?``, so four states
(nothing yet, after s, after u, after a) say what may follow. A symbol's transition
is a 4 x 4 matrix over (min, +): the cheapest way from state to state by inserts
before the row and one edit of the row. Equal consecutive symbols are one run; a run
of length L advances the vector of costs to go through the cached binary powers of
its matrix, the last run first. Then the choices of each run are unrolled from the
first row on; the least letter that keeps the cost is the ASCII-least audit, since a
letter fixes the state that follows.

Scale: rows are dealt by ranges of (conversation, turn, ...), so that a conversation
with a third of all rows lies in many partitions. A partition is streamed in order; a
conversation inside it is finished there. One that a partition's edge or
``BLOCK_ROWS``/``BLOCK_CHARS`` cuts leaves a block: its runs, their matrix and the
texts that may stay. The blocks of a conversation are streamed twice, from the last
(costs to go, by the matrices) and from the first (choices, hash); one block is held
at a time. Equal rows are combined map-side before, and what makes a row a duplicate
is the earliest turn of (conversation, role, text), also combined map-side.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cubeguard.llm.common import SPACES, ship_code, store

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
#: A block of a conversation holds so many rows or characters at most (one row at least).
BLOCK_ROWS, BLOCK_CHARS = 1 << 16, 8 << 20
#: Rows of one turn are put in order by role and so many characters, then by their text's digest.
HEAD = 64
_INF = 1 << 40
_STATES = range(4)
#: An insert (or a rerole) goes from nothing, s or a to u, and from u to a.
_NEXT = (2, 2, 3, 2)
_ACCEPT = (0, _INF, _INF, 0)
_KEEP_TO = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}, "o": {}}


def _inserted(vector) -> tuple:
    """Costs to go if inserts may come first."""
    v = list(vector)
    for _ in _STATES:
        for p in _STATES:
            v[p] = min(v[p], INSERT + v[_NEXT[p]])
    return tuple(v)


END = _inserted(_ACCEPT)


def _edits(symbol: str, p: int):
    """(letter, cost, next state) of the edits that a row allows in state p, letters ascending."""
    yield "D", DELETE, p
    if symbol != "X":
        extra = TRUNCATED if symbol.isupper() else 0
        if p in _KEEP_TO[symbol.lower()]:
            yield "K", KEEP + extra, _KEEP_TO[symbol.lower()][p]
        yield "R", REROLE + extra, _NEXT[p]


def _times(a, b):
    """Product of two matrices over (min, +)."""
    return tuple(tuple(min(a[p][k] + b[k][r] for k in _STATES) for r in _STATES) for p in _STATES)


def apply(matrix, vector) -> tuple:
    return tuple(min(matrix[p][k] + vector[k] for k in _STATES) for p in _STATES)


IDENTITY = tuple(tuple(0 if p == r else _INF for r in _STATES) for p in _STATES)


@lru_cache(maxsize=None)
def transition(symbol: str) -> tuple:
    """Cheapest way from state to state past one row, inserts before it included."""
    columns = []
    for r in _STATES:
        columns.append(_inserted([min([c for _, c, n in _edits(symbol, p) if n == r], default=_INF) for p in _STATES]))
    return tuple(tuple(min(columns[r][p], _INF) for r in _STATES) for p in _STATES)


@lru_cache(maxsize=1024)
def power(symbol: str, k: int) -> tuple:
    """transition(symbol) to the power of 2 ** k: nine symbols, at most 64 powers each."""
    if k == 0:
        return transition(symbol)
    half = power(symbol, k - 1)
    return _times(half, half)


def _bits(length: int):
    return (k for k in range(length.bit_length()) if length >> k & 1)


def past(symbol: str, length: int, vector) -> tuple:
    """Costs to go before a run, from those after it."""
    for k in _bits(length):
        vector = apply(power(symbol, k), vector)
    return vector


def matrix_of(symbols: str, lengths) -> tuple:
    out = IDENTITY
    for s, n in zip(symbols, lengths, strict=True):
        for k in _bits(n):
            out = _times(out, power(s, k))
    return out


@lru_cache(maxsize=100_000)
def _unroll_run(symbol: str, length: int, p: int, after: tuple):
    """(audit, state after) of a run entered in state p, the costs to go after it up to a constant."""
    if symbol == "X":
        return "D" * length, p  # an insert is never better before a deletion than after it
    to_go = [after]
    for _ in range(length):
        v = apply(transition(symbol), to_go[-1])
        low = min(v)
        to_go.append(tuple(x - low for x in v))
    letters = []
    for j in range(length - 1, -1, -1):
        v, before = to_go[j], apply(transition(symbol), to_go[j])
        while True:
            here = before[p]
            options = [(a, c + v[n], n) for a, c, n in _edits(symbol, p)] + [("I", INSERT + before[_NEXT[p]], _NEXT[p])]
            letter, _, p = min(o for o in options if o[1] == here)
            letters.append(letter)
            if letter != "I":
                break
    return "".join(letters), p


def unroll(symbols: str, lengths, p: int, after: tuple):
    """Audits of the runs from state p, and the state after them; ``after`` are the costs to go after the last."""
    vectors = [after]
    for s, n in zip(reversed(symbols), reversed(lengths), strict=True):
        vectors.append(past(s, n, vectors[-1]))
    vectors.reverse()
    audits = []
    for s, n, v in zip(symbols, lengths, vectors[1:], strict=True):
        low = min(v)
        key = tuple(x - low for x in v)
        audit, p = _unroll_run(s, n, p, key) if n <= 64 else _unroll_run.__wrapped__(s, n, p, key)
        audits.append(audit)
    return audits, p, vectors[0]


class _Block:
    """Consecutive rows of a conversation: counts, runs, and what may stay."""

    def __init__(self):
        self.rows = self.chars = self.blank = self.duplicate = self.truncated = self.illegal = self.distinct = 0
        self.first_turn = self.turn = self.first = self.last = None
        self.symbols, self.lengths, self.roles, self.texts = [], [], [], []

    def _run(self, symbol, n):
        if n and self.symbols and self.symbols[-1] == symbol:
            self.lengths[-1] += n
        elif n:
            self.symbols.append(symbol)
            self.lengths.append(n)

    def add(self, turn, role, text, n, is_first):
        initial = role[:1]
        self.illegal += n - 1 if initial + initial not in ("su", "ua", "au") else 0
        if self.rows:
            self.illegal += self.last + initial not in ("su", "ua", "au")
        else:
            self.first = initial
        self.last, self.rows = initial, self.rows + n
        if turn is not None and turn != self.turn:
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.turn, self.distinct = turn, self.distinct + 1
        shown = text.rstrip(SPACES)
        if not shown:
            self.blank += n
            self._run("X", n)
            return
        self.duplicate += n - is_first
        if is_first:
            symbol = initial if initial in ("s", "u", "a") else "o"
            if shown[-1] not in ".!?":
                self.truncated += 1
                symbol = symbol.upper()
            self._run(symbol, 1)
            self.roles.append(role)
            self.texts.append(text)
            self.chars += len(role) + len(text)
        self._run("X", n - is_first)

    @property
    def full(self):
        return self.rows >= BLOCK_ROWS or self.chars >= BLOCK_CHARS

    _COUNTS = ("rows", "blank", "duplicate", "truncated", "illegal", "distinct")

    def packed(self):
        """The block as columns."""
        return {"counts": [getattr(self, c) for c in self._COUNTS], "turns": [self.first_turn, self.turn], "ends": [self.first, self.last],
                "symbols": "".join(self.symbols), "lengths": self.lengths, "roles": self.roles, "texts": self.texts}

    @classmethod
    def unpacked(cls, row):
        b = cls()
        for c, v in zip(cls._COUNTS, row["counts"], strict=True):
            setattr(b, c, v)
        (b.first_turn, b.turn), (b.first, b.last) = row["turns"], row["ends"]
        b.symbols, b.lengths, b.roles, b.texts = row["symbols"], row["lengths"], row["roles"], row["texts"]
        return b


class _Repair:
    """Takes a conversation's blocks in order, with the costs to go after each."""

    def __init__(self):
        self.blank = self.duplicate = self.truncated = self.illegal = self.distinct = self.cost = 0
        self.first_turn = self.turn = self.last = None
        self.state, self.audit, self.sha, self.any, self.started = 0, [], hashlib.sha256(), False, False

    def _line(self, role, text):
        self.sha.update((("\n" if self.any else "") + role + ":" + text).encode("utf-8", "surrogatepass"))
        self.any = True

    def add(self, b: _Block, after: tuple):
        if not b.rows:
            return
        for c in ("blank", "duplicate", "truncated", "illegal", "distinct"):
            setattr(self, c, getattr(self, c) + getattr(b, c))
        if self.last is not None:
            self.illegal += self.last + b.first not in ("su", "ua", "au")
        self.last = b.last
        if b.first_turn is not None:
            if self.turn == b.first_turn:
                self.distinct -= 1
            self.first_turn = b.first_turn if self.first_turn is None else self.first_turn
            self.turn = b.turn
        p = self.state
        audits, self.state, before = unroll("".join(b.symbols), b.lengths, p, after)
        if not self.started:
            self.cost, self.started = before[p], True
        kept = iter(zip(b.roles, b.texts, strict=True))
        for symbol, audit in zip(b.symbols, audits, strict=True):
            self.audit.append(audit)
            if symbol == "X":
                continue
            for letter in audit:
                if letter == "I":
                    p = _NEXT[p]
                    self._line("user" if p == 2 else "assistant", "")
                    continue
                role, text = next(kept)
                if letter == "K":
                    p = _KEEP_TO[symbol.lower()][p]
                    self._line(role, text)
                elif letter == "R":
                    p = _NEXT[p]
                    self._line("user" if p == 2 else "assistant", text)

    def row(self, conv_id):
        p = self.state
        while END[p]:
            p = _NEXT[p]
            self.audit.append("I")
            self._line("user" if p == 2 else "assistant", "")
        gaps = 0 if self.turn is None else self.turn - self.first_turn + 1 - self.distinct
        return {"conv_id": conv_id, "gaps": gaps, "blank": self.blank, "duplicate": self.duplicate, "truncated": self.truncated,
                "illegal": self.illegal, "cost": self.cost, "audit": "".join(self.audit), "repaired_sha256": self.sha.hexdigest()}


_OUT = [("gaps", "bigint", pa.int64()), ("blank", "bigint", pa.int64()), ("duplicate", "bigint", pa.int64()),
        ("truncated", "bigint", pa.int64()), ("illegal", "bigint", pa.int64()), ("cost", "bigint", pa.int64()),
        ("audit", "string", pa.string()), ("repaired_sha256", "string", pa.string())]
_CUT = [("part", "int", pa.int32()), ("seq", "bigint", pa.int64()), ("counts", "array<bigint>", pa.list_(pa.int64())),
        ("turns", "array<bigint>", pa.list_(pa.int64())), ("ends", "array<string>", pa.list_(pa.string())),
        ("symbols", "string", pa.string()), ("lengths", "array<bigint>", pa.list_(pa.int64())),
        ("roles", "array<string>", pa.list_(pa.string())), ("texts", "array<string>", pa.list_(pa.string())),
        ("after", "array<bigint>", pa.list_(pa.int64()))]


def _schemas(columns):
    ddl = "conv_id bigint, " + ", ".join(f"{n} {t}" for n, t, _ in columns)
    return ddl, pa.schema([("conv_id", pa.int64())] + [(n, t) for n, _, t in columns])


_BOTH_DDL, _BOTH = _schemas(_OUT + _CUT)
_OUT_DDL, _FINAL = _schemas(_OUT)
_CUT_DDL, _BLOCKS = _schemas(_CUT)


def _batches(rows, schema, size=512, chars=16 << 20):
    """Record batches of dictionaries, of so many rows or characters of text."""
    held, weight = [], 0
    for r in rows:
        held.append(r)
        weight += len(r.get("audit") or "") + sum(map(len, r.get("texts") or ()))
        if len(held) >= size or weight >= chars:
            yield pa.RecordBatch.from_pylist(held, schema=schema)
            held, weight = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema=schema)


def _stream(batches, names):
    for batch in batches:
        yield from zip(*[batch.column(c).to_pylist() for c in names], strict=True)


def _repair_partition(batches):
    """Rows in order -> a finished row for each conversation that lies inside the partition, blocks of the others."""
    from pyspark import TaskContext
    part = TaskContext.get().partitionId()

    def rows():
        none = object()
        conv, block, seq, at_edge, last_key, is_first = none, None, 0, True, None, 0

        def cut(conv, block, seq):
            return {"conv_id": conv, "part": part, "seq": seq, **block.packed()}

        for c, turn, role, head, sha, mark, n, text in _stream(batches, ("conv_id", "turn", "role", "head", "sha", "mark", "n", "text")):
            if conv is none or c != conv:
                if conv is not none:
                    if at_edge or seq:
                        yield cut(conv, block, seq)
                    else:
                        yield _whole(conv, block)
                    at_edge = False
                conv, block, seq, last_key = c, _Block(), 0, None
            if mark == 0:  # says that a conversation exists
                continue
            key = (turn, role, head, sha)
            if mark == 1:  # says that the row of this key is the first of its role and text
                last_key = key
                continue
            is_first = 1 if key == last_key else 0
            if block.full:
                yield cut(conv, block, seq)
                block, seq = _Block(), seq + 1
            block.add(turn, role, text, n, is_first)
        if conv is not none:
            yield cut(conv, block, seq)

    yield from _batches(rows(), _BOTH)


def _whole(conv, block):
    r = _Repair()
    r.add(block, END)
    return r.row(conv)


def _from_last(batches):
    """Blocks, a conversation's last one first -> with the costs to go after each."""
    def rows():
        none = object()
        conv, vector = none, END
        names = ["conv_id"] + [n for n, *_ in _CUT]
        for values in _stream(batches, names):
            row = dict(zip(names, values, strict=True))
            if conv is none or row["conv_id"] != conv:
                conv, vector = row["conv_id"], END
            row["after"] = list(vector)
            vector = apply(matrix_of(row["symbols"], row["lengths"]), vector)
            yield row
    yield from _batches(rows(), _BLOCKS)


def _from_first(batches):
    """Blocks in order, with the costs to go after each -> a row a conversation."""
    def rows():
        none = object()
        conv, repair = none, None
        names = ["conv_id"] + [n for n, *_ in _CUT]
        for values in _stream(batches, names):
            row = dict(zip(names, values, strict=True))
            if conv is none or row["conv_id"] != conv:
                if conv is not none:
                    yield repair.row(conv)
                conv, repair = row["conv_id"], _Repair()
            repair.add(_Block.unpacked(row), tuple(row["after"]))
        if conv is not none:
            yield repair.row(conv)
    yield from _batches(rows(), _FINAL)


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, n) after the contract's damage; n = 2 is a row repeated beside itself."""
    one = F.lit(" ")
    shown = [F.coalesce(F.col(c).cast("string"), one) for c in ("conv_id", "turn")]
    code = F.crc32(F.concat(shown[0], F.lit(":"), shown[1]).cast("binary")) % 20
    text = F.coalesce(F.col("text").cast("string"), one)
    return (conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), code.alias("code"),
                                 F.coalesce(F.col("role").cast("string"), one).alias("role"), text.alias("text"))
            .where(F.col("code") != 0)
            .select("conv_id", "turn", F.when(F.col("code") == 4, "user").otherwise(F.col("role")).alias("role"),
                    F.when(F.col("code") == 1, "").when(F.col("code") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
                    F.when(F.col("code") == 3, 2).otherwise(1).cast("long").alias("n")))


def repair(rows: DataFrame, conv_ids: DataFrame) -> DataFrame:
    """Faults, cost, audit and digest of the cheapest repair, for each id of ``conv_ids``.

    ``rows``: conv_id, turn, role, text, n (so many equal rows), none of them null but
    conv_id and turn. A conversation's rows go by turn (null first); within a turn by
    role, then the text's first 64 characters, then its SHA-256. Two texts are the same
    if their SHA-256 is. A role whose initial is none of s, u, a (the empty role too)
    cannot be kept, only reroled or deleted.
    """
    ship_code(rows.sparkSession)
    sha, head = F.unhex(F.sha2(F.col("text").cast("binary"), 256)), F.substring("text", 1, HEAD)
    one = rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("n").alias("n"))
    one = one.select("conv_id", "turn", "role", head.alias("head"), sha.alias("sha"), F.lit(2).alias("mark"), "n", "text")
    none = F.lit(None).cast("string")
    turn = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"))
    first = (rows.select("conv_id", "role", head.alias("head"), sha.alias("sha"), turn.alias("at"))
             .groupBy("conv_id", "role", "sha").agg(F.min("at").alias("at"), F.min("head").alias("head"))
             .select("conv_id", F.col("at.turn").alias("turn"), "role", "head", "sha", F.lit(1).alias("mark"), F.lit(0).cast("long").alias("n"), none.alias("text")))
    there = (conv_ids.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
             .select("conv_id", F.lit(None).cast("long").alias("turn"), none.alias("role"), none.alias("head"), F.lit(None).cast("binary").alias("sha"),
                     F.lit(0).alias("mark"), F.lit(0).cast("long").alias("n"), none.alias("text")))
    by = ["conv_id", "turn", "role", "head", "sha"]
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = one.unionByName(first).unionByName(there).repartitionByRange(parts, *by).sortWithinPartitions(*by, "mark")
    both = store(dealt.mapInArrow(_repair_partition, _BOTH_DDL))
    blocks = both.where(F.col("part").isNotNull()).select("conv_id", *[n for n, *_ in _CUT])
    back = (blocks.repartition(parts, "conv_id").sortWithinPartitions("conv_id", F.col("part").desc(), F.col("seq").desc())
            .mapInArrow(_from_last, _CUT_DDL))
    cut = (back.repartition(parts, "conv_id").sortWithinPartitions("conv_id", "part", "seq").mapInArrow(_from_first, _OUT_DDL))
    return both.where(F.col("part").isNull()).select("conv_id", *[n for n, *_ in _OUT]).unionByName(cut)


def repair_report(conversations: DataFrame) -> DataFrame:
    """One row per conv_id of ``conversations`` (a null one too): faults, cost, audit, repaired_sha256.

    The contract's damage comes first; null roles, texts, ids and turns are read as one
    space there. A conversation without rows after it has zeros, an empty audit and the
    digest of an empty string. Rows that share conv_id and turn are put in order as
    :func:`repair` says; repeated rows are duplicates. An empty table gives an empty
    result; other columns are not read, whatever their names.
    """
    return repair(damaged(conversations), conversations)

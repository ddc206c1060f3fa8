import hashlib
import random
import re
import zlib
from functools import lru_cache

import pytest

from cubeguard.llm import conversation_repair as C

SCHEMA = "conv_id long, turn long, role string, text string, n long, head string, mark int, sha binary"
NAMES = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def plain(rows):
    """The contract, conversation by conversation; the cheapest edits by a search over suffixes."""
    out = {}
    for conv in {r[0] for r in rows}:
        after = []
        for c, turn, role, text in [r for r in rows if r[0] == conv]:
            code = zlib.crc32(f"{' ' if c is None else c}:{' ' if turn is None else turn}".encode()) % 20
            role, text = " " if role is None else role, " " if text is None else text
            if code == 0:
                continue
            text = "" if code == 1 else re.sub("[.!?]", "", text) if code == 2 else text
            after += [(turn, "user" if code == 4 else role, text)] * (2 if code == 3 else 1)
        after.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2][:64], hashlib.sha256(r[2].encode()).digest()))
        faults, seen = [], set()
        for _, role, text in after:
            shown = re.findall("[^\x20\x09-\x0d]", text)
            fault = "blank" if not shown else "duplicate" if (role, text) in seen else "truncated" if shown[-1] not in ".!?" else ""
            seen.add((role, text))
            faults.append(fault)
        turns = [t for t, *_ in after if t is not None]
        step = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}

        @lru_cache(maxsize=None)
        def best(i, state, left):
            """(cost, audit) from row i on; ``left``: inserts still allowed before this row."""
            options = []
            if left:
                nxt = "a" if state == "u" else "u"
                c, a = best(i, nxt, left - 1)
                options.append((c + 3, "I" + a))
            if i == len(after):
                if state in ("", "a"):
                    options.append((0, ""))
            else:
                c, a = best(i + 1, state, 3)
                options.append((c + 4, "D" + a))
                if faults[i] not in ("blank", "duplicate"):
                    extra = 3 if faults[i] == "truncated" else 0
                    nxt = step.get((state, after[i][1][:1]))
                    if nxt:
                        c, a = best(i + 1, nxt, 3)
                        options.append((c + extra, "K" + a))
                    c, a = best(i + 1, "a" if state == "u" else "u", 3)
                    options.append((c + 3 + extra, "R" + a))
            return min(options, default=(10**9, ""))

        cost, audit = best(0, "", 3)
        lines, state, i = [], "", 0
        for letter in audit:
            nxt = "a" if state == "u" else "u"
            name = {"u": "user", "a": "assistant"}[nxt]
            if letter == "I":
                lines.append(name + ":")
                state = nxt
                continue
            if letter == "K":
                lines.append(f"{after[i][1]}:{after[i][2]}")
                state = after[i][1][0]
            elif letter == "R":
                lines.append(f"{name}:{after[i][2]}")
                state = nxt
            i += 1
        initials = [r[1][:1] for r in after]
        out[conv] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, faults.count("blank"), faults.count("duplicate"),
                     faults.count("truncated"), sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False)), cost, audit,
                     hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def table(seed, conversations=60, longest=14):
    rng = random.Random(seed)
    texts = ["Yes.", "No", "Why?", "", " \n", None, "Well. And\n", "Möglich!", "a" * 70 + ".", "a" * 70 + "!", "é ."]
    roles = ["user", "assistant", "system", "tool", None, "", "utter", "User"]
    rows = []
    for c in range(conversations):
        turn = rng.choice([0, 0, 3, -2])
        for _ in range(rng.randint(1, longest)):
            turn += rng.choice([1, 1, 1, 0, 2])
            role = rng.choice(roles[:2] if rng.random() < 0.7 else roles)
            text = rng.choice(texts) if rng.random() < 0.6 else f"Text {rng.random()}{rng.choice(['.', '', '?'])}"
            rows.append((c if c else None, None if rng.random() < 0.05 else turn, role, text))
    return rows


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(*r, 9, "clash", 1, b"x") for r in rows], SCHEMA).repartition(parts)


def check(spark, rows):
    got = {r.conv_id: tuple(r[n] for n in NAMES[1:]) for r in C.repair_report(frame(spark, rows)).collect()}
    want = plain(rows)
    assert set(got) == set(want)
    assert {k: (got[k], want[k]) for k in got if got[k] != want[k]} == {}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_equals_plain_search(spark, seed):
    check(spark, table(seed))


def test_long_conversation_in_blocks(spark):
    rng = random.Random(7)
    rows = []
    for t in range(220):
        rows.append((5, t, rng.choice(["user", "assistant"]) if t % 40 > 20 else "user", rng.choice(["Same.", f"New {t}.", f"Cut {t}", ""])))
    rows += [(6, 1, "system", "Only."), (7, None, None, None), (8, 2, "user", "a."), (8, 3, "assistant", "b.")]
    check(spark, rows)
    # blocks of a few rows, streamed from the last and from the first, give the same
    runs = [("u", 3), ("X", 2), ("U", 4), ("a", 2), ("s", 1), ("o", 2), ("u", 70)]
    symbols, lengths = "".join(s for s, _ in runs), [n for _, n in runs]
    audits, state, before = C.unroll(symbols, lengths, 0, C.END)
    for cut in range(1, len(runs)):
        after = C.apply(C.matrix_of(symbols[cut:], lengths[cut:]), C.END)
        left, p, first = C.unroll(symbols[:cut], lengths[:cut], 0, after)
        right, q, _ = C.unroll(symbols[cut:], lengths[cut:], p, C.END)
        assert (left + right, q, first) == (audits, state, before)


def test_small_blocks_equal_plain_search(spark):
    rows = [r for r in table(11, 4, 30) if r[0] is not None]
    want = plain(rows)
    for conv in want:
        after, block = [], None
        dealt = [r for r in C.damaged(frame(spark, rows)).where(f"conv_id = {conv}").collect()]
        dealt.sort(key=lambda r: (r.turn is not None, r.turn or 0, r.role, r.text[:64], hashlib.sha256(r.text.encode()).digest()))
        seen, blocks = set(), []
        for k, r in enumerate(dealt):
            if k % 3 == 0:
                block = C._Block()
                blocks.append(block)
            block.add(r.turn, r.role, r.text, r.n, int((r.role, r.text) not in seen))
            seen.add((r.role, r.text))
        vector = C.END
        for b in reversed(blocks):
            after.append(vector)
            vector = C.apply(C.matrix_of("".join(b.symbols), b.lengths), vector)
        repair = C._Repair()
        for b, v in zip(blocks, reversed(after), strict=True):
            repair.add(C._Block.unpacked(b.packed()), v)
        row = repair.row(conv)
        assert tuple(row[n] for n in NAMES[1:]) == want[conv]


def test_repeated_rows_and_one_hot_text(spark):
    rows = [(1, 1, "user", "Hi.")] * 40 + [(1, t, "assistant", "Hot.") for t in range(2, 60)] + [(2, t, "user", f"x{t % 2}.") for t in range(20)]
    check(spark, rows)


def test_empty_table(spark):
    assert C.repair_report(spark.createDataFrame([], SCHEMA)).collect() == []


def test_long_text(spark):
    check(spark, [(1, 1, "user", "word " * 200_000 + "."), (1, 2, "assistant", "ok" * 500_000)])


def test_powers():
    for s in "XsuaoSUAO":
        v = C.END
        for n in range(1, 40):
            v = C.apply(C.transition(s), v)
            assert v == C.past(s, n, C.END)

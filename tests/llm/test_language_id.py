import random
import string
import zlib

import numpy as np
import pytest

from cubeguard.llm import language_id as L
from tests.llm.helpers import SCHEMA, frame

DOCS = "/root/testdata/sf0.001/documents.parquet"


def test_gradient_matches_finite_differences():
    net = L.BiGru(3, seed=1)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    bytes_, mask = L.padded([b"abca", b"b", "çà".encode()])
    lang = np.array([0, 2, 1])
    _, grad = net.gradients(bytes_, mask, lang)
    rng = np.random.default_rng(0)
    for name, value in net.p.items():
        for _ in range(4):
            at = tuple(rng.integers(0, n) for n in value.shape) if name != "E" else (int(bytes_[0, 0]), int(rng.integers(0, L.EMBED)))
            kept, step = value[at], 1e-4
            value[at] = kept + step
            up = net.gradients(bytes_, mask, lang)[0]
            value[at] = kept - step
            down = net.gradients(bytes_, mask, lang)[0]
            value[at] = kept
            assert abs((up - down) / (2 * step) - grad[name][at]) < 2e-4, name


def test_both_directions_reach_every_position():
    net = L.BiGru(2, seed=3)
    y = [net.probabilities(*L.padded([w]))[0] for w in (b"abcd", b"abce", b"xbcd")]
    assert np.abs(y[0][0] - y[1][0]).max() > 0  # the last byte reaches the first position
    assert np.abs(y[0][3] - y[2][3]).max() > 0


def test_padding_changes_nothing():
    net = L.BiGru(2, seed=3)
    alone, _ = net.probabilities(*L.padded([b"abc"]))
    both, _ = net.probabilities(*L.padded([b"abc", b"abcdefgh"]))
    assert np.allclose(alone[:, 0], both[:3, 0], atol=1e-6)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(DOCS)
    got = {r.doc_id: r for r in L.language_id(docs).collect()}
    own = docs.select("doc_id", "lang").collect()
    assert len(got) == len(own)
    assert all(got[r.doc_id].held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in own)
    out = [got[r.doc_id].lang_pred == r.lang for r in own if got[r.doc_id].held_out]
    assert np.mean(out) > 0.95 and len(out) > 20


def test_filter_drops_what_is_of_no_learned_language(spark):
    docs = spark.read.parquet(DOCS).select("doc_id", "text", "lang", "source", "n_chars")
    rng = random.Random(1)
    noise = [(10 ** 6 + k, " ".join("".join(rng.choices(string.ascii_lowercase, k=rng.randint(2, 9))) for _ in range(40)), None, None, None) for k in range(100)]
    foreign = ["Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw.", "Все люди рождаются свободными и равными в своем достоинстве и правах.",
               "人人生而自由,在尊严和权利上一律平等。", "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan."]
    noise += [(2 * 10 ** 6 + k, t, None, None, None) for k, t in enumerate(foreign)]
    kept = [r.doc_id for r in L.keep_identified(docs.union(spark.createDataFrame(noise, docs.schema))).collect()]
    assert sorted(kept) == sorted(r.doc_id for r in docs.where("text rlike '[a-zA-Z]'").collect())


def test_made_runs_are_of_no_language():
    runs = ["the", "letter", "words", "écrit", "слово"]
    made = L.made_runs(runs, np.ones(5), 400)
    assert len(made) > 300 and not set(made) & set(runs)
    assert made == L.made_runs(runs, np.ones(5), 400)


def test_only_text_decides(spark, monkeypatch):
    monkeypatch.setattr(L, "STEPS", 60)
    docs = spark.read.parquet(DOCS)
    held = L.held_out()
    changed = docs.selectExpr("doc_id", "text", f"case when {zlib_sql()} then 'xx' else lang end as lang", "'other' as source")
    a = {r.doc_id: (r.lang_pred, round(r.score, 9)) for r in L.language_id(docs).collect()}
    b = {r.doc_id: (r.lang_pred, round(r.score, 9)) for r in L.language_id(changed).collect()}
    assert a == b and held is not None


def zlib_sql():
    return "crc32(cast(cast(doc_id as string) as binary)) % 4 = 2"


def test_awkward_rows(spark, monkeypatch):
    monkeypatch.setattr(L, "STEPS", 20)
    got = {(r.doc_id, r.lang_pred == "und", 0 <= r.score <= 1) for r in L.language_id(frame(spark)).collect()}
    assert {i for i, und, _ in got if und} == {4, 5, 6, 13}  # null, empty, blank, no letter
    assert all(ok for *_, ok in got)
    kept = L.keep_identified(frame(spark))
    assert kept.columns == [c.split()[0] for c in SCHEMA.split(", ")]
    assert not {4, 5, 6, 13} & {r.doc_id for r in kept.collect()}


def test_no_labels_and_empty_table(spark):
    rows = [(1, "some text", None, None, None, None, None)]
    assert [tuple(r) for r in L.language_id(frame(spark, rows)).collect()] == [(1, zlib.crc32(b"1") % 4 == 2, "und", 0.0)]
    assert L.language_id(frame(spark, [])).count() == 0


@pytest.mark.parametrize("text, runs", [("Ab-c1d É", ["ab", "c", "d", "é"]), ("12 !", []), (None, []), ("²", [])])
def test_runs(text, runs):
    assert L.runs_of(text) == runs

"""The stages in order on a small corpus, each against its own input, by brute force."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from cubeguard.llm import language_id, mixing, packing
from tests.llm.test_exact_dedup import DELETED
from tests.llm.test_minhash_dedup import brute as near_groups

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def outputs(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    # rows that every stage must stand: no text, no letters, repeated rows, null columns
    extra = [(900_001, None, "en", "src0", 0), (900_002, "", None, None, None), (900_003, "12 !!", "fr", "src1", 5), (900_004, "Copy of it all, written twice here.", "en", "src2", 9),
             (900_004, "Copy of it all, written twice here.", "en", "src2", 9), (900_005, "Copy  of it all,\nwritten twice here.", None, None, None)]
    docs = docs.union(spark.createDataFrame(extra, docs.schema))
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        out.append(corpus_pipeline.store(stage(spark, out[-1], SF)))
    return out


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_stages_keep_the_columns(outputs):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language ID", "exact dedup", "MinHash near-dedup", "mixing", "packing"]
    assert all(df.columns == outputs[0].columns for df in outputs[:-1])
    assert all(df.count() > 0 for df in outputs)


def test_language_stage_drops_what_has_no_language_only(outputs):
    before, after = rows(outputs[0]), rows(outputs[1])
    gone = [r for r in before if r not in after]
    assert {900_001, 900_002, 900_003} <= {r[0] for r in gone}
    assert all(not language_id.runs_of(r[1]) for r in gone)


def test_exact_stage_keeps_the_longest_of_equal_texts(outputs):
    best = {}
    for r in rows(outputs[1]):
        norm = r[1].translate(DELETED)
        best[norm] = min(best.get(norm, (1, 0)), (-len(r[1]), r[0]))
    assert sorted((-len(r[1]), r[0]) for r in rows(outputs[2])) == sorted(best.values())


def test_near_stage_keeps_one_of_each_group(outputs):
    own = rows(outputs[2])
    kept = {i for i, _, _, keep in near_groups([(r[0], r[1]) for r in own], 5) if keep}
    assert {r[0] for r in rows(outputs[3])} == kept


def test_mixing_stage_samples_by_its_probabilities(outputs):
    want = {r.doc_id for r in mixing.mix_report(outputs[3]).collect() if r.kept}
    assert {r[0] for r in rows(outputs[4])} == want


def test_packing_stage_packs_every_id(outputs):
    tokenizer = Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))
    texts = {r[0]: r[1] for r in rows(outputs[4])}
    pieces = {}
    for r in outputs[5].collect():
        pieces.setdefault(r.doc_id, []).append((r.start, r.length, r.ids_crc32))
    assert pieces.keys() == texts.keys()
    for i, own in pieces.items():
        ids = np.array(tokenizer.encode(texts[i], add_special_tokens=False).ids + [1], dtype="<u4")
        own.sort()
        assert [s for s, *_ in own] == [0, *np.cumsum([n for _, n, _ in own])[:-1].tolist()] and sum(n for _, n, _ in own) == len(ids)
        assert all(zlib.crc32(ids[s:s + n].tobytes()) == c for s, n, c in own)


def test_run_is_the_stages_in_order(spark, outputs, monkeypatch):
    calls = []
    stages = [(n, lambda s, d, p, k=k: calls.append(k) or d) for k, (n, _) in enumerate(corpus_pipeline.STAGES)]
    monkeypatch.setattr(corpus_pipeline, "STAGES", stages)
    assert corpus_pipeline.run(spark, SF).count() == 200 and calls == [0, 1, 2, 3, 4]


def test_empty_corpus(spark, outputs):
    docs = outputs[0].where("false")
    for _, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.store(stage(spark, docs, SF))
        assert docs.count() == 0

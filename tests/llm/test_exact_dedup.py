import hashlib

from pyspark.sql import functions as F

from cubeguard.llm.exact_dedup import exact_duplicates, keep_first
from tests.llm.helpers import SCHEMA, frame, rows

DELETED = str.maketrans("", "", " \t\n\x0b\x0c\r")


def brute(own):
    groups = {}
    for i, t, *_ in own:
        groups.setdefault((t or "").translate(DELETED), []).append((-len(t or ""), i is None, i or 0))
    out = []
    for norm, members in groups.items():
        members.sort()
        keep = None if members[0][1] else members[0][2]
        for k, (_, null, i) in enumerate(members):
            out.append((None if null else i, keep, len(members), k == 0, hashlib.sha256(norm.encode()).hexdigest()))
    return sorted(out, key=repr)


def found(df):
    return sorted(map(tuple, df.select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()), key=repr)


def test_matches_brute_force(spark):
    assert found(exact_duplicates(frame(spark))) == brute(rows())


def test_colliding_digests_do_not_join_texts(spark):
    weak = lambda norm: (F.length(norm) % 3).cast("string")
    assert found(exact_duplicates(frame(spark), weak)) == brute(rows())
    assert keep_first(frame(spark), weak).count() == keep_first(frame(spark)).count()


def test_hot_group_over_partitions(spark):
    own = [(k, "same  text" if k % 3 else f"text {k}", None, None, None, None, None) for k in range(600)]
    df = frame(spark, own).repartition(40)
    assert found(exact_duplicates(df)) == brute(own)


def test_kept_rows_have_all_columns(spark):
    kept = keep_first(frame(spark))
    assert kept.columns == [c.split()[0] for c in SCHEMA.split(", ")]
    texts = [(r.text or "").translate(DELETED) for r in kept.collect()]
    assert len(texts) == len(set(texts)) == len({(r[1] or "").translate(DELETED) for r in rows()})


def test_empty_table(spark):
    assert found(exact_duplicates(frame(spark, []))) == [] and keep_first(frame(spark, [])).count() == 0

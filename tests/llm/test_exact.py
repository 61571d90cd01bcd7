import hashlib

import pytest

from coursepulse.llm import exact


def found(documents, *rows, **options):
    got = exact.deduplicate(documents(*rows), **options)
    return sorted(((r.id, r.keep_id, r.group_size, r.kept) for r in got.collect()), key=repr)


def test_white_space_runs_are_one_space(documents):
    assert found(documents, (3, "a  b"), (1, "a\t\nb"), (2, "a b"), (4, "a b"), (5, "A b"), (6, " a b")) == [
        (1, 1, 3, True), (2, 1, 3, False), (3, 1, 3, False), (4, 4, 1, True), (5, 5, 1, True), (6, 6, 1, True)]


def test_null_is_empty(documents):
    assert found(documents, (2, None), (1, ""), (3, " ")) == [(1, 1, 2, True), (2, 1, 2, False), (3, 3, 1, True)]


def test_null_ids_and_repeated_rows(documents):
    assert found(documents, (None, "x"), (7, "x"), (7, "x")) == [(7, 7, 3, True), (7, 7, 3, True), (None, 7, 3, False)]
    assert found(documents, (None, "x")) == [(None, None, 1, True)]


def test_digest_long_texts_and_empty_tables(documents):
    long = "word " * 300_000
    row = exact.deduplicate(documents((1, long))).first()
    assert row.text_sha256 == hashlib.sha256(long.encode()).hexdigest()
    assert found(documents) == []


@pytest.mark.parametrize("depth", [0, 2])
def test_overfull_buckets_are_split(documents, depth):
    rows = [(i, f"text {i % 150}") for i in range(300)]
    index = exact.build(documents(*rows), bucket_rows=10, depth=depth)
    sizes = {(r.bucket, r.depth): r["count"] for r in index.entries.groupBy("bucket", "depth").count().collect()}
    assert max(sizes.values()) <= 10 and sum(sizes.values()) == 150
    slots = index.directory.collect()
    assert sorted(r.slot for r in slots) == list(range(1 << index.depth))
    assert {r.depth for r in slots} != {index.depth} or len(slots) == 1 << index.depth
    got = exact.lookup(documents(*rows), index)
    assert sorted((r.id, r.keep_id) for r in got.collect()) == [(i, i % 150) for i in range(300)]


def test_a_chain_of_one_hash_stays_together(documents, monkeypatch):
    from pyspark.sql import functions as F
    monkeypatch.setattr(exact.F, "xxhash64", lambda *columns: F.lit(5).cast("bigint"))
    rows = [(i, f"text {i % 20}") for i in range(40)]
    index = exact.build(documents(*rows), bucket_rows=4, depth=0)
    assert sorted(r.chain for r in index.entries.collect()) == list(range(1, 21))
    assert sorted((r.id, r.keep_id) for r in exact.lookup(documents(*rows), index).collect()) == [(i, i % 20) for i in range(40)]


def test_texts_of_one_hash_are_told_apart_by_bytes(documents, monkeypatch):
    from pyspark.sql import functions as F
    monkeypatch.setattr(exact.F, "xxhash64", lambda *columns: F.lit(5).cast("bigint"))
    rows = [(i, f"text {i % 20}") for i in range(60)]
    got = exact.deduplicate(documents(*rows).repartition(7), bucket_rows=4).collect()
    assert sorted((r.id, r.keep_id, r.group_size) for r in got) == [(i, i % 20, 3) for i in range(60)]
    assert {(r.keep_id, r.chain) for r in got} == {(i, i + 1) for i in range(20)}


@pytest.mark.parametrize("held", [0, 700, 1 << 25])
def test_equal_brute_force_over_many_tasks(documents, monkeypatch, held):
    monkeypatch.setattr(exact, "HELD_BYTES", held)
    monkeypatch.setattr(exact, "ANSWER_ROWS", 3)
    rows = [(i * 7 % 401, "hot  text" if i % 3 == 0 else f"t{i % 90}" + " \t"[i % 2] + "x" * (i % 40)) for i in range(400)] + [(900, None), (901, ""), (None, "hot text")]
    groups = {}
    for i, text in rows:
        groups.setdefault(" ".join((text or "").replace("\t", " ").split(" ")) if "hot" not in (text or "") else "hot text", []).append(i)
    want = sorted(((i, min(x for x in ids if x is not None), len(ids)) for ids in groups.values() for i in ids), key=repr)
    got = exact.deduplicate(documents(*rows).repartition(9), bucket_bytes=200, depth=1).collect()
    assert sorted(((r.id, r.keep_id, r.group_size) for r in got), key=repr) == want
    assert len({r.bucket for r in got}) > 8


def test_kept_rows_have_their_own_columns(documents):
    df = documents((2, "x"), (1, "x"), (3, "y"), (None, "y"))
    kept = exact.keep_first(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 3]


def test_one_row_of_equal_texts_stays(documents):
    # A null id beside an id, repeated rows, null ids alone, and an id whose other text is not a copy.
    df = documents((3, "y"), (None, "y"), (7, "x"), (7, "x"), (7, " x"), (None, "z"), (None, "z"), (1, "a"), (5, "a"), (5, "alone"))
    kept = exact.keep_first(df, unnamed=False)
    assert kept.columns == df.columns
    assert sorted(((r.doc_id or 0, r.text) for r in kept.collect())) == [(0, "z"), (1, "a"), (3, "y"), (5, "alone"), (7, " x"), (7, "x")]
    assert sorted(r.text for r in exact.keep_first(documents((7, "x  y"), (7, "x y")), unnamed=False).collect()) == ["x  y"]

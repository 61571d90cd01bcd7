import pyarrow as pa
from pyspark.sql import functions as F

from coursepulse.llm import exact, shared


def test_batches_of_a_stage_are_bounded_in_bytes(spark):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"rows": pa.array([batch.num_rows]), "bytes": pa.array([batch.nbytes])})

    def largest(**bound):
        found = shared.stage(rows.mapInArrow(sizes, "rows long, bytes long"), "sizes", **bound)
        assert found.agg(F.sum("rows")).first()[0] == 4000
        return found.agg(F.max("bytes")).first()[0]

    rows = spark.range(4000, numPartitions=1).select("id", F.repeat(F.lit("x"), 2000).alias("body"))
    assert largest() > 4 * shared.BATCH_BYTES
    assert largest(batch_bytes=shared.BATCH_BYTES) < 1.1 * shared.BATCH_BYTES
    assert spark.conf.get(shared.BATCH_SETTING, None) is None
    spark.conf.set(shared.BATCH_SETTING, "100000")
    try:
        assert largest(batch_bytes=shared.BATCH_BYTES) < 110_000
        assert spark.conf.get(shared.BATCH_SETTING) == "100000"
    finally:
        spark.conf.unset(shared.BATCH_SETTING)


def test_near_and_exact_dedup_pass_texts_and_sets_in_small_batches(documents, monkeypatch):
    from coursepulse.llm import nearcopies

    bounds = {}
    for module in (exact, nearcopies):
        def noted(df, name, batch_bytes=None):
            if "MapInArrow" in df._jdf.queryExecution().optimizedPlan().toString():
                bounds.setdefault(name, set()).add(batch_bytes)
            return shared.stage(df, name, batch_bytes)

        monkeypatch.setattr(module, "stage", noted)
    docs = documents(*[(n, f"{n % 3} " + " ".join(f"w{i}" for i in range(60))) for n in range(9)])
    assert sorted(r.doc_id for r in nearcopies.keep_one(exact.keep_first(docs), by_row=True).collect()) == [0]
    assert bounds == dict.fromkeys(("texts", "index", "sketches", "sets", "links"), {shared.BATCH_BYTES})


def test_held_texts_leave_a_task_in_small_batches():
    schema = pa.schema([("key", pa.int64()), ("body", pa.binary())])
    rows = [(n, b"x" * 3000) for n in range(2000)] + [(2000, b"y" * 3 * shared.BATCH_BYTES), (2001, b"")]
    batches = list(exact._text_batches(iter(rows), schema))
    assert [tuple(r.values()) for b in batches for r in b.to_pylist()] == rows
    assert all(b.nbytes <= 1.1 * shared.BATCH_BYTES or b["body"][-1].as_py()[:1] == b"y" for b in batches) and len(batches) > 5
    assert list(exact._text_batches(iter([]), schema)) == []

import pytest

from coursepulse.llm import mixing


def water(sizes, share=1.5, most=2.0):
    """Shares by weight; what a full source cannot take is shared again until none is above its limit."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    full, total = {}, share * sum(sizes.values())
    while True:
        rest = [s for s in order if s not in full]
        left = total - sum(full.values())
        got = {s: left * weight[s] / sum(weight[r] for r in rest) for s in rest}
        above = [s for s in rest if got[s] > most * sizes[s]]
        if not above:
            return full | got
        full |= {s: most * sizes[s] for s in above}


def corpus(documents):
    rows = []
    for n, (source, size) in enumerate([("a", 30), ("b", 4), ("c", 200), ("é", 90), (None, 25)]):
        rows += [(n * 1000 + i, " ".join(["w"] * (i % (2 * size // 10 + 1) + 1)), "en", source) for i in range(40)]
    return documents(*rows, (9000, None, "en", "a"), (9001, "", "en", "a"), (9002, "w " * 5000, "en", "c"))


def test_targets_and_words_taken(documents):
    rows = mixing.mix(corpus(documents)).documents.collect()
    sizes, taken = {}, {}
    for r in rows:
        sizes[r.source] = sizes.get(r.source, 0) + r["size"]
        taken[r.source] = taken.get(r.source, 0) + r.taken
        assert 0 <= r.taken <= 2 * r["size"] and r["size"] == len((r.id and "") or "") + r["size"]
    want = water(sizes)
    for r in rows:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
    for source in sizes:
        assert taken[source] == pytest.approx(want[source], rel=0.01, abs=2)
    assert len(rows) == 203 and {r.taken for r in rows if r.id in (9000, 9001)} == {0}


def test_reruns_agree(documents):
    df = corpus(documents)
    one, two = (sorted(map(tuple, mixing.mix(x).documents.collect()), key=repr) for x in (df, df.repartition(7)))
    assert one == two


def test_every_stretch_of_the_schedule_has_the_mix(documents):
    mix = mixing.mix(corpus(documents), slots=1 << 12)
    share = {r.source_no: r.target for r in mix.sources.collect()}
    total = sum(share.values())
    slots = mix.schedule.filter("slot >= 1000 AND slot < 1500").groupBy("source_no").count().collect()
    for r in slots:
        assert r["count"] / 500 == pytest.approx(share[r.source_no] / total, abs=0.02)
    ranks = [r["rank"] for r in mix.schedule.filter("source_no = 0").orderBy("slot").collect()]
    assert ranks == list(range(len(ranks)))


def test_nulls_repeats_and_empty_tables(documents):
    assert mixing.mix(documents()).documents.count() == 0
    nothing = mixing.mix(documents((1, None), (2, ""))).documents.collect()
    assert [(r["size"], r.taken) for r in nothing] == [(0, 0), (0, 0)]
    same = documents((1, "a b c", "en", "s"), (1, "a b c", "en", "s"), (None, "d e", "en", "s"), (None, "d e", "en", "s"))
    rows = mixing.mix(same).documents.collect()
    assert len(rows) == 4 and sum(r.taken for r in rows) == pytest.approx(15, abs=1)


def test_mixed_rows(documents):
    df = corpus(documents)
    taken = {r.id: (r.taken, r["size"]) for r in mixing.mix(df).documents.collect()}
    times = {}
    for r in mixing.mixed_documents(df).collect():
        times[r.doc_id] = times.get(r.doc_id, 0) + 1
    assert mixing.mixed_documents(df).columns == df.columns
    for id_, (words, size) in taken.items():
        assert times.get(id_, 0) in ([0] if not size else [int(words / size), int(words / size) + 1])

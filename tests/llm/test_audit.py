from collections import Counter
from itertools import permutations

import numpy as np

from coursepulse.llm import audit, terms

SPACES = " \t\n\x0b\x0c\r"


def words_of(text):
    for c in SPACES:
        text = text.replace(c, " ")
    return [w for w in text.split(" ") if w]


def brute(docs, labels):
    """docs: (id, text, part), labels: (id, quality, toxic)."""
    failed = []
    for i, (key, text, part) in enumerate(docs):
        text = text or ""
        words = words_of(text)
        fails = set()
        if len(words) < 200:
            fails.add("A")
        if 100 * len(set(words)) < 50 * len(words):
            fails.add("B")
        if 100 * sum("A" <= c <= "Z" for c in text) > 3 * len(text):
            fails.add("C")
        if set(text) & set("#$%&*|"):
            fails.add("D")
        if any((t or "") == text and k is not None and (key is None or k < key) for k, t, _ in docs):
            fails.add("E")
        mine = [x for x in labels if x[0] is not None and x[0] == key]
        failed.append((part or "", fails, any(x[1] == 1 for x in mine), any(x[2] == 1 for x in mine)))
    report = {}
    for part in {p for p, *_ in failed}:
        own = [f for f in failed if f[0] == part]
        shapley = Counter()
        for order in permutations("ABCDE"):
            for step, letter in enumerate(order):
                before = set(order[:step])
                out = [f for f in own if letter in f[1] and not f[1] & before]
                shapley[letter] += len(out)
                report[part, "".join(order), step + 1] = [
                    sum(not f[1] & (before | {letter}) for f in own), len(out), sum(letter in f[1] and bool(f[1] & before) for f in own),
                    sum(f[1] == {letter} for f in own), sum(f[2] for f in out), sum(f[3] for f in out), letter]
        for key, row in report.items():
            if key[0] == part:
                row[-1] = shapley[row[-1]]
    return {k: tuple(v) for k, v in report.items()}


LONG = " ".join(f"w{i}" for i in range(220))
DOCS = [
    (1, LONG, "en"), (2, LONG, "en"), (3, LONG, None), (None, LONG, "de"), (2, LONG, "en"), (4, "short", "en"), (5, None, "en"), (6, "", ""),
    (7, "same " * 300, "de"), (8, LONG.upper(), "de"), (9, LONG + " 5%", "de"), (10, "A#" * 3, None), (11, "é É x " * 250, "fr"),
    (12, LONG + " | " + "Z" * 200, "fr"), (13, "x\ty\x0bz\x0c\r\n" * 80, "fr"), (14, " ".join(f"{i}" for i in range(199)), "fr"),
    (15, " ".join(f"{i}" for i in range(100)) + " a" * 101, "fr"), (None, "only null", "fr"), (None, "only null", "fr")]
LABELS = [(1, 1, 0), (2, 0, 1), (2, 1, None), (4, 1, 1), (7, None, 1), (None, 1, 1), (99, 1, 1), (12, 1, 0)]


def test_against_every_order(spark, documents):
    labels = spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")
    df = documents(*[(i, t, p) for i, t, p in DOCS]).selectExpr("*", "1 AS failed", "2 AS part", "3 AS digest", "4 AS docs", "5 AS `meta.url`")
    got = {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley)
           for r in audit.interactions(df, labels).collect()}
    want = brute(DOCS, LABELS)
    assert len(got) == 4 * 600
    assert got == want


def test_empty_tables(spark, documents):
    labels = spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")
    assert audit.interactions(documents(), labels).count() == 0
    alone = audit.interactions(documents((1, "x", "en")), labels.limit(0)).collect()
    assert len(alone) == 600 and all(r.kept == ("A" not in r.filter_order[:r.step]) and r.shapley in (0, 120) for r in alone)


def test_the_matrix(spark, documents, monkeypatch):
    """Rows of the shards, read with the dictionary, are the words of the texts, whatever the size of a shard; the
    terms of a part have no gaps."""
    from pyspark.sql import functions as F

    monkeypatch.setattr(terms, "SHARD_BYTES", 30)
    texts = {i: t for i, (_, t, _) in enumerate(DOCS)}
    made = terms.document_terms(documents(*texts.items()).repartition(3), {"key": F.col("doc_id")})
    word = {r.term: bytes(r.word).decode() for r in made.dictionary.collect()}
    assert len(set(word.values())) == len(word)
    assert all(term & (1 << terms.PLACE_BITS) - 1 == 0 or term - 1 in word for term in word)
    seen = {}
    for shard in made.shards.collect():
        ends, of, counts = (np.frombuffer(shard[c], t) for c, t in (("offsets", np.int64), ("terms", np.int64), ("counts", np.int32)))
        sums, distinct = terms.rows_of(shard.offsets, shard.terms, shard.counts)
        for i, doc in enumerate(shard.docs):
            row = slice(ends[i], ends[i + 1])
            assert len(set(of[row])) == row.stop - row.start
            seen[doc.key] = Counter({word[t]: int(n) for t, n in zip(of[row], counts[row], strict=True)})
            assert (sums[i], distinct[i]) == (seen[doc.key].total(), len(seen[doc.key]))
    assert seen == {i: Counter(words_of(t or "")) for i, t in texts.items()}

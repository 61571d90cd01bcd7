import os
import random
import time

import pytest
from pyspark.sql import functions as F

from coursepulse.llm import queries, toxicity

SF = "/root/testdata/sf0.1"

NAMES = toxicity.EVENT


def events(text):
    found = toxicity.Reader(toxicity.INSULTS).events(text)
    return {name: int(n) for name, n in zip(NAMES, found) if n}


def test_clauses_are_scored_not_words():
    assert events("You are an idiot.") == {"insult": 1, "insult aimed": 1}
    assert events("What an idiot, what a moron!") == {"insult": 1}  # one clause, one event of a kind
    assert events("An idiot. A moron") == {"insult": 2}
    assert events("You are not an idiot") == {"insult": 1, "insult aimed": 1, "insult negated": 1}
    assert events("not that any of this was done by an idiot") == {"insult": 1}  # out of reach
    assert events("He said that they were idiots") == {"insult": 1, "insult aimed": 1, "insult reported": 1}
    assert events("I will kill you") == {"threat": 1, "threat aimed": 1}
    assert events("skilled workers, overkill") == {}
    assert events("STUPID!! THING!!") == {"insult": 1}
    assert events("nonidiot") == {} and events("") == {} and events(None) == {}
    assert events("calm words " * 100_000 + "idiot") == {"insult": 1}


def test_long_texts_take_linear_time():
    text = "what an idiot, said nobody! " * 200_000  # 5 MB of clauses, each with a core; read back to the start it takes minutes
    begun = time.monotonic()
    assert events(text)["insult"] == 200_000
    assert time.monotonic() - begun < 30
    unbroken = "idiot " * 300_000  # one clause
    assert events(unbroken) == {"insult": 1}


@pytest.mark.skipif(not os.path.isdir(SF), reason="the given tables are not here")
def test_held_out_documents_are_told_apart(spark):
    """Of the rows that nothing was learned from nearly all have the label that they are given."""
    found = queries.QUERIES["op6_toxicity"](spark, SF).filter("held_out")
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "toxic")
    right = {r.toxic: r.share for r in found.join(labels, "doc_id").groupBy("toxic").agg(
        F.avg((F.col("predicted") == F.col("toxic")).cast("int")).alias("share")).collect()}
    assert right[1] > 0.90 and right[0] > 0.97


def corpus(spark, documents, n=400):
    rng = random.Random(1)
    calm = [f"{a}{b}" for a in ("lor", "dol", "sit", "amet", "con") for b in ("em", "or", "um", "is", "ed", "ta")]
    docs, labels = [], []
    for i in range(n):
        words = [rng.choice(calm) for _ in range(60)]
        bad = i % 4 == 0
        if bad:
            words[rng.randrange(60)] = rng.choice(["zarbum", "zarbis", "quolta"])
        docs.append((i, " ".join(words) + "."))
        labels.append((i, 1, int(bad)))
    return documents(*docs, (9000, None), (9001, "")), spark.createDataFrame(
        labels + [(9002, 1, 1), (None, 1, 1), (5, 1, None)], "doc_id long, quality int, toxic int")


def test_stems_and_weights_are_learned(spark, documents):
    docs, labels = corpus(spark, documents)
    grammar = toxicity.fit(docs, labels.filter("doc_id % 5 != 0"))
    assert {"zarb", "quol"} <= set(grammar.insults)
    rows = toxicity.score(docs, grammar).collect()
    assert all((r.toxicity >= 0.5) == (r.doc_id % 4 == 0) for r in rows if r.doc_id < 9000)
    empty = [r.toxicity for r in rows if r.doc_id >= 9000]
    assert len(set(empty)) == 1 and 0 < empty[0] < 0.5
    assert grammar == toxicity.fit(docs.repartition(3), labels.filter("doc_id % 5 != 0"))


def test_without_labels_the_grammar_holds(spark, documents):
    docs = documents((1, "You are an idiot."), (2, "A calm day."))
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    rows = {r.doc_id: r.toxicity for r in toxicity.score(docs, toxicity.fit(docs, none)).collect()}
    assert rows[1] > 0.5 > rows[2]
    assert toxicity.score(documents(), toxicity.fit(documents(), none)).count() == 0


def test_the_sample_is_bounded(spark, documents):
    docs, labels = corpus(spark, documents)
    few = toxicity.labelled_sample(docs, labels, "toxic", "doc_id", "text", 20)
    assert 5 < few.filter(F.col("label") == 1).count() < 45 and few.filter(F.col("label") == 0).count() < 45

import os
import random

import pytest
from pyspark.sql import functions as F

from coursepulse.llm import language, queries

SF = "/root/testdata/sf0.01"

ENGLISH = "the house on the hill was old and the people of the village were afraid of it "
GERMAN = "das haus auf dem berg war alt und die leute aus dem dorf hatten angst davor "


@pytest.fixture(scope="module")
def model(spark):
    rows = [(i, (ENGLISH if i % 2 else GERMAN) * (1 + i % 3), "en" if i % 2 else "de") for i in range(20)]
    return language.fit(spark.createDataFrame([*rows, (99, "unlabelled", None), (98, None, "en")], "doc_id long, text string, lang string"))


def judged(documents, model, *texts):
    rows = language.identify(documents(*enumerate(texts)), model).orderBy("doc_id").collect()
    return [r.language for r in rows]


def test_languages_are_told_apart(documents, model):
    assert set(model.dictionaries) == {"de", "en"}
    got = judged(documents, model, "the people were afraid of the old house", "DIE LEUTE!! HATTEN!! ANGST!! VOR DEM HAUS", ENGLISH * 20_000)
    assert [(r.lang_pred, r.rejected) for r in got] == [("en", False), ("de", False), ("en", False)]
    assert all(0 <= r.score <= 1 for r in got)


def test_texts_without_letters_are_undetermined(documents, model):
    for r in judged(documents, model, None, "", " \t\n", "123 456!?"):
        assert (r.lang_pred, r.score, r.rejected) == ("und", 0.0, True)


def test_narrow_leads_are_rejected(documents, model):
    assert judged(documents, model, "zzz")[0].rejected


def test_the_fit_is_bounded_and_repeatable(spark):
    rows = [(i, f"{ENGLISH} word{i}", "en") for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    few = language.fit(df, sample_docs=10)
    assert few == language.fit(df.repartition(5), sample_docs=10)
    assert len([w for w in few.dictionaries["en"].split() if w == b"word"]) == 1
    assert len(language.fit(df, dictionary_bytes=50).dictionaries["en"]) <= 51


def test_empty_tables_and_own_columns(documents, model):
    assert language.identify(documents(), model).count() == 0
    assert language.fit(documents()).dictionaries == {}
    kept = language.keep_identified(documents((1, ENGLISH), (1, ENGLISH), (2, None), (None, GERMAN)), model)
    assert kept.columns == documents().columns
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 1, 1]


def test_long_varied_texts_are_not_rejected():
    pick = random.Random(1)
    words = {lang: ["".join(pick.choices(letters, k=7)) for _ in range(1000)] for lang, letters in (("x", "abcdefghijklm"), ("y", "nopqrstuvwxyz"))}
    compressors = language._compressors(language.Model({lang: " ".join(own).encode() for lang, own in words.items()}, 0.004))
    for lang, own in words.items():
        short, long = (language.judge(" ".join(pick.choices(own, k=n)).encode(), compressors, 0.004) for n in (4_000, 500_000))
        assert short[0] == long[0] == lang and not short[3] and not long[3]
        assert long[2] > short[2] / 3


@pytest.mark.skipif(not os.path.isdir(SF), reason="the given tables are not here")
def test_held_out_documents_are_told_apart(spark):
    found = queries.QUERIES["op3_language"](spark, SF).filter("held_out")
    named = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang").filter("lang IS NOT NULL")
    share = found.join(named, "doc_id").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert share > 0.97

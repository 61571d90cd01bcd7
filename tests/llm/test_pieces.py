import gc
import os
import pickle
import random

import pytest
import sentencepiece

from coursepulse.llm import pieces
from coursepulse.llm.queries import model_path

pytestmark = pytest.mark.skipif(not os.path.exists(model_path()), reason="no piece model here")
TEXTS = ["", " ", "  two  spaces ", "line\nbreak\t\r\n", "naïve Ünïcode ß ﬁ", "日本語テスト 😀🇩🇪", "}\r\n\r\r);\r", "a" * 5000, "▁▁x",
         "x" * 70 + "y", "don't stop.Now,then", "0123456789 3.14", "\x00\x7f"]


@pytest.fixture(scope="module")
def model():
    return pieces.read_model(model_path())


def test_equal_to_the_library(model):
    library, own = sentencepiece.SentencePieceProcessor(model_proto=model), pieces.Encoder(model)
    rng = random.Random(2)
    made = ["".join(rng.choice("abc théß.,\n日▁ 12") for _ in range(rng.randrange(60))) for _ in range(500)]
    for text in TEXTS + made:
        ids = own.encode(text).tolist()
        assert ids == library.encode(text), text
        assert own.decode(ids) == library.decode(ids)
        if "▁" not in text:
            assert own.decode(ids) == text


def test_best_scores_equal_a_plain_table():
    """Without merge ranks the largest sum of scores wins."""
    encoder = pieces.Encoder.__new__(pieces.Encoder)
    import ahocorasick
    scores = {"a": -2.5, "b": -2.5, "c": -3.5, "ab": -3.2, "bc": -2.1, "abc": -6.5, "▁": -1.5, "▁a": -2.2}
    encoder.pieces = list(scores)
    encoder.score, encoder.length = list(scores.values()), [len(p) for p in scores]
    encoder.rank = {p: i for i, p in enumerate(scores)}
    encoder.merges, encoder.bytes, encoder.unknown, encoder.pairs = False, {}, 0, {}
    encoder.automaton = ahocorasick.Automaton()
    for piece, i in encoder.rank.items():
        encoder.automaton.add_word(piece, i)
    encoder.automaton.make_automaton()

    def best(word):
        table = [(0.0, [])] + [(-1e9, [])] * len(word)
        for end in range(1, len(word) + 1):
            for start in range(end):
                if word[start:end] in scores and table[start][0] + scores[word[start:end]] > table[end][0]:
                    table[end] = (table[start][0] + scores[word[start:end]], table[start][1] + [word[start:end]])
        return table[-1][1]

    from array import array
    for word in ("▁abc", "abcabc", "bca", "▁abab", "ccc"):
        ids = array("i")
        ids.frombytes(encoder._word(word))
        assert [encoder.pieces[i] for i in ids] == best(word)


def test_columns_round_trip(documents, model):
    df = documents(*enumerate(TEXTS), (50, None), (50, None))
    rows = pieces.decode(pieces.encode(df, model), model).collect()
    assert len(rows) == len(TEXTS) + 2
    for r in rows:
        assert r.decoded == (r.text or "").replace("▁", " ")
        assert r.text or r.pieces == []
    assert pieces.encode(documents(), model).count() == 0


def test_the_memory_of_words_is_bounded(model, monkeypatch):
    monkeypatch.setattr(pieces, "CACHED_WORDS", 5)
    monkeypatch.setattr(pieces, "CACHED_PAIRS", 5)
    library, own = sentencepiece.SentencePieceProcessor(model_proto=model), pieces.Encoder(model)
    text = " ".join(f"word{i % 23} other{i}" for i in range(200))
    assert own.encode(text).tolist() == library.encode(text)
    assert len(own.words) <= 5 and len(own.older) <= 5 and len(own.pairs) <= 6


def test_what_a_worker_makes_of_a_model_goes_with_the_job(spark, documents, model):
    """Encoders are kept with the broadcast, which a worker drops at its first task of another job, not with the module."""
    kept = pieces.Kept(model)
    assert kept.once(pieces.Encoder) is kept.once(pieces.Encoder) and not pickle.loads(pickle.dumps(pieces.Kept(model))).made

    def alive(_):
        gc.collect()
        yield sum(isinstance(o, pieces.Encoder) for o in gc.get_objects())

    assert pieces.encode(documents(*[(n, f"the house {n}") for n in range(40)]), model).filter("size(pieces) = 0").count() == 0
    assert set(spark.sparkContext.parallelize(range(64), 64).mapPartitions(alive).collect()) == {0}


def test_only_texts_go_to_the_tasks(documents, model):
    """No Arrow batch of whole rows is made, with or without the way back."""
    docs = documents((1, "the house"), (2, None)).drop("pieces")
    for back in (None, "back"):
        found = pieces.encode(docs, model, round_trip=back)
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        assert "MapInArrow" not in plan and "BatchEvalPython" in plan and plan.count("BatchEvalPython") == 1
        assert sorted((r.doc_id, len(r.pieces)) for r in found.collect())[1] == (2, 0)

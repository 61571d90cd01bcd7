import os
import random

import pytest
from tokenizers import Tokenizer

from coursepulse.llm import tokens
from coursepulse.llm.queries import QUERIES, vocabulary_path

pytestmark = pytest.mark.skipif(not os.path.exists(vocabulary_path()), reason="no vocabulary here")
TEXTS = ["", " ", "  two  spaces ", "line\nbreak\t\r\n", "naïve Ünïcode ß ﬁ", "日本語テスト 😀🇩🇪", "}\r\n\r\r);\r", "don't stop.Now,they'll 'LL", "0123 ٣Ⅷ² 3.14",
         "\x00\x7f\x85\x1c", "<|endoftext|>", "a<|endoftext|><|endoftext|> b<|endoftext", " x　 y​", "\U0001e900\U00031350Ᲊ"]


@pytest.fixture(scope="module")
def file():
    return tokens.read_vocabulary(vocabulary_path())


@pytest.fixture(scope="module")
def whole(file):
    return tokens.Merges(file).whole()


def by_library(texts):
    return [len(e) for e in Tokenizer.from_file(vocabulary_path()).encode_batch(texts, add_special_tokens=False)]


def test_equal_to_the_library(file, whole):
    own, rng = tokens.Counter(file, whole), random.Random(3)
    parts = ["a", "the", " house", "'s", "'ll", " ", "  ", "\n", "\x85", "é", "日", "1", "٣", "<|endoftext|>", "　", "!", "²", "\U0001e900", "́", "\x1c"]
    texts = TEXTS + ["".join(rng.choice(parts) for _ in range(rng.randrange(40))) for _ in range(1500)]
    assert [own.count(t) for t in texts] == by_library(texts)


def test_every_code_point(file, whole):
    own = tokens.Counter(file, whole)
    texts = ["".join(f"a{chr(c)} {chr(c)}1" for c in range(start, start + 512) if not 0xD800 <= c < 0xE000) for start in range(0, 0x110000, 512)]
    assert [own.count(t) for t in texts] == by_library(texts)


def test_proven_strings_encode_alone(file, whole):
    """Each is one token by the library, and those left out are not."""
    merges = tokens.Merges(file)
    rest = [s for raw in merges.strings if (s := raw.decode("utf-8", "ignore")).encode() == raw and s not in set(whole)]
    pieces = Tokenizer.from_file(vocabulary_path()).pre_tokenizer
    alone = [s for s in whole if len(pieces.pre_tokenize_str(s)) == 1]
    assert len(alone) > 40_000 and set(by_library(alone)) == {1}
    assert 1 not in by_library(rest)


def test_long_texts_in_blocks(file, whole, monkeypatch):
    own, rng = tokens.Counter(file, whole), random.Random(4)
    monkeypatch.setattr(tokens, "BLOCK", 50)
    monkeypatch.setattr(tokens, "REMEMBERED", 5)
    texts = [" ".join(rng.choice(["don't", "house", "  gap", "née", "x\n", "zzqq"]) for _ in range(400)), "ab" * 100_000, " " * 5000 + "x", "é" * 4000]
    assert [own.count(t) for t in texts] == by_library(texts)
    assert len(own.known) <= 5


def test_rows(documents, spark, file):
    df = documents(*enumerate(TEXTS), (50, None), (50, None), (None, "word " * 1100)).selectExpr("*", "1 AS n_tokens")
    rows = tokens.count_tokens(df, file).collect()
    assert sorted(rows[0].asDict()) == sorted([*df.columns, "n_bytes", "over_limit"])
    got = sorted(((r.doc_id is None, r.doc_id or 0, r.n_bytes, r.n_tokens, r.over_limit) for r in rows))
    texts = [*TEXTS, "", "", "word " * 1100]
    ids = [*((False, i) for i in range(len(TEXTS))), (False, 50), (False, 50), (True, 0)]
    want = [(*i, len(t.encode()), n, n > 1024) for i, t, n in zip(ids, texts, by_library(texts), strict=True)]
    assert got == sorted(want)
    assert tokens.count_tokens(documents(), file).count() == 0


def test_the_query_against_the_library(spark):
    folder = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    counts = dict(zip(texts, by_library(list(texts.values())), strict=True))
    rows = QUERIES["op11_tokens"](spark, folder).collect()
    assert {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in rows} == {
        i: (len(t.encode()), counts[i], counts[i] > 1024) for i, t in texts.items()}


def test_other_kinds_are_refused(file):
    with pytest.raises(ValueError, match="byte-level"):
        tokens.Merges(file.replace(b'"add_prefix_space":false', b'"add_prefix_space":true').replace(b'"add_prefix_space": false', b'"add_prefix_space": true'))

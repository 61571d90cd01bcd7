import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from coursepulse.llm import anchors, repeats, substrings, suffixes

WORDS = [f"w{i}" for i in range(40)]


def corpus(seed, documents):
    rng = random.Random(seed)
    passage = " ".join(rng.choice(WORDS) for _ in range(30))
    texts = []
    for _ in range(60):
        parts = [" ".join(rng.choice(WORDS) for _ in range(rng.randrange(0, 60)))]
        if rng.random() < 0.5:
            parts.insert(rng.randrange(2), passage)
        if rng.random() < 0.2:
            parts.append("ab " * rng.randrange(90))
        texts.append(rng.choice([" ", "\n", "\t "]).join(parts))
    texts += texts[:10] + [None, "", " \n", "äöü " * 70, texts[0][: len(texts[0]) // 2]]
    return documents(*[(i * 3 % 97, t) for i, t in enumerate(texts)])


def by_words(rows, window=20):
    first, out = {}, {}
    for d, text in sorted(rows):
        words = (text or "").encode().split()
        gone = set()
        for p in range(len(words) - window + 1):
            key = tuple(words[p:p + window])
            if first.setdefault(key, (d, p)) != (d, p):
                gone.update(range(p, p + window))
        kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
        out[d] = (len(words), len(gone), hashlib.sha256(kept).hexdigest())
    return out


def by_bytes(rows, length):
    count = Counter()
    for _, text in rows:
        raw = (text or "").encode()
        count.update(raw[p:p + length] for p in range(len(raw) - length + 1))
    out = {}
    for d, text in rows:
        raw = (text or "").encode()
        gone = set()
        for p in range(len(raw) - length + 1):
            if count[raw[p:p + length]] > 1:
                gone.update(range(p, p + length))
        spans = sum(1 for p in gone if p - 1 not in gone)
        out[d] = (len(raw), len(gone), spans, hashlib.sha256(bytes(b for i, b in enumerate(raw) if i not in gone)).hexdigest())
    return out


@pytest.mark.parametrize("seed, group_rows", [(1, 20_000), (2, 3)])
def test_passages_equal_brute_force(documents, seed, group_rows):
    df = corpus(seed, documents)
    got = {r.id: (r.n_units, r.n_removed, r.kept_sha256) for r in substrings.remove_passages(df, group_rows=group_rows).collect()}
    want = by_words([(r.doc_id, r.text) for r in df.collect()])
    assert got == want and sum(v[1] for v in want.values()) > 300


@pytest.mark.parametrize("seed, group_rows, length", [(3, 20_000, 200), (4, 3, 40)])
def test_strings_equal_brute_force(documents, seed, group_rows, length):
    df = corpus(seed, documents)
    got = {r.id: (r.n_units, r.n_removed, r.n_spans, r.kept_sha256)
           for r in suffixes.remove_strings(df, length=length, group_rows=group_rows).collect()}
    want = by_bytes([(r.doc_id, r.text) for r in df.collect()], length)
    assert got == want and sum(v[1] for v in want.values()) > 300


def test_spans_and_what_is_kept(documents):
    passage = " ".join(f"p{i}" for i in range(25))
    rows = {r.id: r for r in substrings.remove_passages(documents((1, f"a {passage} b"), (2, f"c {passage} d"))).collect()}
    assert rows[1].n_removed == 0 and [tuple(s) for s in rows[2].spans] == [(1, 26)]
    assert bytes(rows[2].kept) == b"c d"


def test_ids_and_empty_tables(documents):
    passage = " ".join(f"p{i}" for i in range(25))
    df = documents((1, passage), (None, passage), (2, "a"), (2, "b"), (3, passage), (2, "b"), (None, None), (4, "c " + passage), (4, passage))
    rows = substrings.remove_passages(df).collect()
    assert sorted((r.id or 99, r.n_units, r.n_removed) for r in rows) == [
        (1, 25, 0), (2, 1, 0), (2, 1, 0), (2, 1, 0), (3, 25, 25), (4, 25, 25), (4, 26, 25), (99, 0, 0), (99, 25, 25)]
    # Without an id a passage that stands nowhere else stays, once.
    rows = substrings.remove_passages(documents((None, passage), (None, passage), (5, "x"))).collect()
    assert sorted((r.id or 99, r.n_units, r.n_removed) for r in rows) == [(5, 1, 0), (99, 25, 0), (99, 25, 25)]
    # A repeated row repeats its strings.
    twice = suffixes.remove_strings(documents((1, "z" * 150 + passage), (1, "z" * 150 + passage), (None, "q" * 90)), length=100).collect()
    assert sorted((r.id or 99, r.n_units == r.n_removed) for r in twice) == [(1, True), (1, True), (99, False)]
    assert substrings.remove_passages(documents()).count() == 0
    assert suffixes.remove_strings(documents()).count() == 0


def test_a_very_long_text(documents):
    rng = random.Random(9)
    long = " ".join(str(rng.random()) for _ in range(150_000))  # longer than a chunk of the search for anchors
    tail = long[-5000:]
    rows = {r.id: r for r in suffixes.remove_strings(documents((1, long), (2, tail)), bodies=False).collect()}
    assert (rows[2].n_removed, rows[1].n_removed) == (5000, 5000)


def test_least_agrees_with_a_plain_search(monkeypatch):
    rng = np.random.default_rng(1)
    hashes = rng.integers(0, 2**63, 500).astype(np.uint64)
    hashes[100:200] = hashes[100]
    want = [w + int(np.argmin(hashes[w:w + 13])) for w in range(500 - 12)]
    assert anchors.least(hashes, 13).tolist() == want
    monkeypatch.setattr(anchors, "CHUNK", 64)
    assert anchors.least(hashes, 13).tolist() == [w + int(np.argmin(hashes[w:w + 13] & ~np.uint64(127))) for w in range(500 - 12)]


def test_words_are_split_at_ascii_white_space_only():
    body = "a b\x1cc\td\x0be  f g\x85h\n".encode()
    start, end = anchors.word_bounds(np.frombuffer(body, np.uint8))
    assert [body[s:e] for s, e in zip(start, end)] == body.split()


def test_a_hot_anchor_is_dealt_to_tasks(documents, monkeypatch):
    """A short phrase among different words everywhere, and whole passages in it, with groups of a few rows."""
    monkeypatch.setattr(repeats, "DEALT_ROWS", 4)
    rng = random.Random(12)
    phrase = [f"p{i}" for i in range(12)]
    texts = {}
    for i in range(60):
        left, right = ([f"{side}{j}" + (rng.choice("ab") if j % 3 == 0 else "") for j in range(rng.choice([4, 9]))] for side in "lr")
        texts[i] = " ".join(left + phrase + right)
    got = {r.id: (r.n_units, r.n_removed) for r in substrings.remove_passages(documents(*texts.items())).collect()}
    first, want = {}, {}
    for i, text in texts.items():
        words, covered = text.split(), set()
        for p in range(len(words) - 19):
            if first.setdefault(tuple(words[p:p + 20]), (i, p)) != (i, p):
                covered.update(range(p, p + 20))
        want[i] = (len(words), len(covered))
    assert got == want and sum(n for _, n in want.values()) > 0

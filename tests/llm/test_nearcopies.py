import random

import numpy as np

from coursepulse.llm import nearcopies


def shingle_set(text):
    words = bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode()).split()
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4)))


def brute_force(rows, percent):
    sets = {d: shingle_set(t) for d, t in rows}
    parent = {d: d for d in sets}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            common = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {d: (len(s), root(d)) for d, s in sets.items()}


def test_components_equal_brute_force(documents):
    rng = random.Random(7)
    rows = []
    for _ in range(12):
        base = [f"w{rng.randrange(500)}" for _ in range(rng.randrange(1, 200))]
        for _ in range(rng.randrange(1, 12)):
            words = list(base)
            for _ in range(rng.randrange(0, 8)):
                words[rng.randrange(len(words))] = f"x{rng.randrange(50)}"
            text = rng.choice([" ", "\n "]).join(words)
            rows.append((len(rows) * 7 % 1009, text.upper() if rng.random() < 0.3 else text))
    rows += [(2001, None), (2002, ""), (2003, " \t"), (2004, "One two"), (2005, "one TWO"), (2006, "one"), (2007, "ÄÖ one"), (2008, "äö one")]
    for percent in (85, 80):
        got = {r.id: (r.n_shingles, r.component_id) for r in nearcopies.near_copies(documents(*rows), percent=percent).collect()}
        assert got == brute_force(rows, percent)


def test_a_chain_is_one_component(documents):
    words = [f"w{i}" for i in range(300)]
    rows = [(100 - k, " ".join([*(f"x{i}" for i in range(k * 4)), *words[k * 4:]])) for k in range(20)]
    got = {r.id: r.component_id for r in nearcopies.near_copies(documents(*rows)).collect()}
    assert set(got.values()) == {81}


def test_ids_empty_tables_and_kept_rows(documents):
    assert nearcopies.near_copies(documents()).count() == 0
    text = " ".join(f"w{i}" for i in range(50))
    df = documents((5, text), (3, text), (3, text), (None, text), (9, None))
    assert sorted((r.id or 99, r.component_id) for r in nearcopies.near_copies(df).collect()) == [(3, 3), (3, 3), (5, 3), (9, 9), (99, 3)]
    other = " ".join(f"v{i}" for i in range(50))
    shared = documents((3, text), (3, other), (4, other), (None, text + " x"), (None, "alone"))
    assert sorted((r.id or 99, r.n_shingles, r.component_id or 99) for r in nearcopies.near_copies(shared).collect()) == [
        (3, 46, 3), (3, 46, 3), (4, 46, 3), (99, 1, 99), (99, 47, 3)]
    kept = nearcopies.keep_one(df)
    assert kept.columns == df.columns and sorted(r.doc_id or 0 for r in kept.collect()) == [0, 3, 3, 9]


def test_signatures_within_reach_share_a_key():
    rng = np.random.default_rng(3)
    for _ in range(300):
        one = rng.integers(0, 1 << 16, nearcopies.SYMBOLS).astype(np.uint64)
        two = one.copy()
        changed = rng.choice(nearcopies.SYMBOLS, nearcopies.REACH, replace=False)
        two[changed] = rng.integers(0, 1 << 16, nearcopies.REACH)
        keys = nearcopies.chunk_keys(np.stack([one, two]))
        assert (keys[0] == keys[1]).any()


def test_rows_that_share_an_id_or_have_none(documents):
    one, two = (" ".join(f"{c}{i}" for i in range(60)) for c in "ab")
    df = documents((1, one), (5, one + " more"), (5, two), (None, two + " more"), (None, "alone"), (8, "c d"), (8, "c d"), (9, ""), (9, None))
    kept = nearcopies.keep_one(df, by_row=True)
    assert kept.columns == df.columns
    got = sorted((r.doc_id or 0, r.text or "") for r in kept.collect())
    assert got == [(0, "alone"), (1, one), (5, two), (8, "c d"), (9, "")]


def test_pairs_just_above_the_threshold_are_found(documents):
    """Some hundred pairs of similarity 0.85 to 0.87, alone and in a crowd."""
    rng = random.Random(22)
    texts, want = {}, 0
    for number in range(300):
        frame = [f"c{i}" for i in range(40)] if number % 2 else []
        words = frame + [f"w{number}x{i}" for i in range(200 - len(frame))]
        other = list(words)
        at = rng.randrange(50, 180)
        other[at:at + rng.choice([10, 11])] = [f"o{number}x{i}" for i in range(11)]
        one, two = ({tuple(w[i:i + 5]) for i in range(len(w) - 4)} for w in (words, other))
        share = len(one & two) / len(one | two)
        want += share >= 0.85
        texts[2 * number], texts[2 * number + 1] = (words, share), (other, share)
    rows = {r.id: r.component_id for r in nearcopies.near_copies(documents(*((k, " ".join(w)) for k, (w, _) in texts.items()))).collect()}
    assert 200 < want
    for k in range(0, 600, 2):
        assert (rows[k + 1] == k) == (texts[k][1] >= 0.85), texts[k][1]

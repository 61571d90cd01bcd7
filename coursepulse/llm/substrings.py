"""Removal of repeated passages of words: seed and extend on winnowed anchors.

Documents meet on anchors, the least stretches of ``block`` words in every window of ``window`` words. From an anchor the
match is extended both ways: first by everything its windows can reach, then window by window on either side. Runs of
windows that also start earlier make the maximal repeats, and their words are removed; the first occurrence stays
(smaller id, or earlier in the same document). Windows are judged on the input, not on what is left.

Words are runs of anything but ASCII white space, unchanged. The words that are left are joined by one space.

Defined cases: a null or empty text has no words; texts shorter than a window keep all words; every row is a document and
gives a row; rows without an id come after all others, and rows that share one in an order by their texts; repeated texts lose all words but
in the first; an empty table gives an empty result; other columns are ignored. Documents are read whole.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from . import anchors as anchor
from .repeats import GROUP_ROWS, Rule, remove


def word_units(body: bytes) -> np.ndarray:
    """A 64-bit hash for each word."""
    raw = np.frombuffer(body, np.uint8) if body else np.zeros(0, np.uint8)
    start, end = anchor.word_bounds(raw)
    return anchor.stretch(anchor.sums(raw.astype(np.uint64)), start, end)


def without_words(body: bytes, covered: np.ndarray) -> bytes:
    words = body.split()  # bytes split at ASCII white space only
    return b" ".join([w for w, gone in zip(words, covered.tolist(), strict=True) if not gone] if covered.any() else words)


def remove_passages(docs: DataFrame, id_col: str = "doc_id", text: str = "text", window: int = 20, block: int = 5,
                    group_rows: int = GROUP_ROWS, bodies: bool = True) -> DataFrame:
    """Per document: id, n_units (words), n_removed, n_spans, kept_sha256, spans and, if ``bodies``, kept."""
    rule = Rule(word_units, without_words, window, block, plain=False, first_stays=True)
    return remove(docs, rule, id_col, text, group_rows, bodies)

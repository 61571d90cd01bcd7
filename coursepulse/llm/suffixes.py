"""Removal of byte strings that occur more than once: op2's anchors on bytes, not prefix doubling.

A string of ``length`` bytes holds an anchor, the least stretch of length / 2 bytes in it by hash. Suffixes are ranked from
the anchors' positions only. First all anchors are sorted by the rank of their half-length prefix; unique ones drop out,
as no string around them can recur. Then those of equal rank are sorted again by the rank of everything that strings
around them can reach, which settles the inside of long repeats. What is left is compared at every position around
the anchors by one fingerprint of all ``length`` bytes (``repeats``); there are no rank pairs and no doubling rounds.
Strings that share their fingerprint are repeated, and all bytes that they cover are removed.

Ranks are 64-bit fingerprints of contents, compared within their anchor's group, so each decision rests on 128 bits.

Defined cases: a null text is empty; texts shorter than ``length`` keep all bytes; a string that occurs twice in one
document is repeated, overlapping occurrences too; every occurrence is removed, the first as well; every row is a document
and gives a row, also where rows share an id or have none; an empty table gives an empty result; other
columns are ignored. Texts are read whole; matches never cross documents.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from .repeats import GROUP_ROWS, Rule, remove


def byte_units(body: bytes) -> np.ndarray:
    return np.frombuffer(body, np.uint8).astype(np.uint64) if body else np.zeros(0, np.uint64)


def without_bytes(body: bytes, covered: np.ndarray) -> bytes:
    return np.frombuffer(body, np.uint8)[~covered].tobytes() if covered.any() else body


def remove_strings(docs: DataFrame, id_col: str = "doc_id", text: str = "text", length: int = 200, group_rows: int = GROUP_ROWS,
                   bodies: bool = True) -> DataFrame:
    """Per document: id, n_units (bytes), n_removed, n_spans, kept_sha256, spans and, if ``bodies``, kept."""
    rule = Rule(byte_units, without_bytes, length, max(1, length // 2), plain=True, first_stays=False)
    return remove(docs, rule, id_col, text, group_rows, bodies)

"""Language identification by compression.

Every language has a zstandard raw-content dictionary: its most widespread words, from a bounded sample of labelled
documents. A text is compressed once with each dictionary, in blocks of ``BLOCK`` bytes that do not know each other, so that
the dictionary helps as much at the end of a long text as at its start and the lead grows with the size; the language whose dictionary makes it smallest wins, and
a narrow lead over the second rejects the document.

Defined cases: a null text and a text without a letter are ``und`` with score 0 and are rejected; an empty table
gives an empty result; ties go to the language that comes first by name and are rejected; labels that are null are
not learned; repeated rows are judged alike; other columns pass through untouched (``out`` must be a new name).
Whole texts are compressed, however long.
"""

from __future__ import annotations

import math
from collections import Counter
from typing import NamedTuple

import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import free_name, ship

UNDETERMINED = "und"
BLOCK = 32768
RESULT = "lang_pred string, score double, margin double, rejected boolean"


class Model(NamedTuple):
    """``dictionaries``: raw content by language; ``narrow``: the least lead over the second, as a share of the smallest size."""

    dictionaries: dict[str, bytes]
    narrow: float


def letters(text: Column) -> Column:
    """Lower-case text with everything that is not a letter replaced by one space."""
    return F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}]+", " "))


def fit(docs: DataFrame, label: str = "lang", text: str = "text", id_col: str = "doc_id", sample_docs: int = 400,
        sample_chars: int = 4000, dictionary_bytes: int = 8192, narrow: float = 0.004) -> Model:
    """Dictionaries from at most ``sample_docs`` labelled documents of each language.

    The sample is the documents of the language with the smallest hashes of their ids, and of each at most
    ``sample_chars`` characters; both bounds hold at any size of the corpus. Only the fit is sampled.
    """
    labelled = docs.filter(F.col(label).isNotNull() & F.col(text).isNotNull())
    rows = labelled.select(F.col(label).alias("label"), F.xxhash64(id_col).alias("pick"), F.col(text).alias("body"))
    sizes = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return Model({}, narrow)
    # A share of the hash range that holds about twice the wanted documents; then the exact number of them.
    edge = F.create_map(*[F.lit(x) for lang, n in sizes.items()
                          for x in (lang, math.floor(2**62 * min(1.0, 2 * (sample_docs + 50) / n)))])
    few = rows.filter(F.col("pick").bitwiseAND(F.lit(2**62 - 1)) <= edge[F.col("label")])
    texts = (
        few.withColumn("body", letters(F.substring("body", 1, sample_chars)))
        .groupBy("label")
        .agg(F.slice(F.array_sort(F.collect_list(F.struct("pick", "body"))), 1, sample_docs).alias("texts"))
        .collect()
    )
    return Model({r["label"]: _dictionary([t["body"] for t in r["texts"]], dictionary_bytes) for r in texts}, narrow)


def _dictionary(texts: list[str], size: int) -> bytes:
    """The words found in most texts, the most widespread last, where references to them are shortest."""
    spread = Counter(word for text in texts for word in set(text.split()))
    chosen, used = [], 0
    for word, _ in sorted(spread.items(), key=lambda x: (-x[1], x[0])):
        used += len(word.encode()) + 1
        if used > size:
            break
        chosen.append(word)
    return (" ".join(reversed(chosen)) + " ").encode()


def _compressors(model: Model) -> dict[str, zstandard.ZstdCompressor]:
    settings = zstandard.ZstdCompressionParameters(
        strategy=zstandard.STRATEGY_GREEDY, min_match=4, window_log=17, hash_log=14, chain_log=14, search_log=3,
        target_length=32, write_content_size=False, write_checksum=False, write_dict_id=False)
    made = {}
    for lang, content in sorted(model.dictionaries.items()):
        book = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        book.precompute_compress(compression_params=settings)
        made[lang] = zstandard.ZstdCompressor(dict_data=book, compression_params=settings)
    return made


def judge(raw: bytes, compressors: dict[str, zstandard.ZstdCompressor], narrow: float) -> tuple:
    """(language, score, margin, rejected) of normalised text. The score is the winner's share of a softmax of the
    sizes; the margin is its lead over the second, as a share of its size."""
    if not raw or not compressors:
        return UNDETERMINED, 0.0, 0.0, True
    blocks = [raw[start:start + BLOCK] for start in range(0, len(raw), BLOCK)]
    sizes = sorted((sum(len(c.compress(block)) for block in blocks), lang) for lang, c in compressors.items())
    best = sizes[0][0]
    score = 1.0 / sum(math.exp(max(-700.0, 0.5 * (best - s))) for s, _ in sizes)
    lead = (sizes[1][0] - best) / best if len(sizes) > 1 else 1.0
    return sizes[0][1], score, lead, lead <= 0 or lead < narrow


def identify(docs: DataFrame, model: Model, text: str = "text", out: str = "language") -> DataFrame:
    """``docs`` with a struct column ``out``: lang_pred, score, margin and rejected."""
    ship(docs.sparkSession)

    made: dict[str, zstandard.ZstdCompressor] = {}  # filled once in each task

    # Texts go to the workers a hundred at a time; an Arrow batch would hold up to 64 MB of them on both sides.
    @F.udf(RESULT, useArrow=False)
    def compare(body: str) -> tuple:
        if not made:
            made.update(_compressors(model))
        return judge(body.encode(), made, model.narrow)

    return docs.withColumn(out, compare(letters(F.col(text))))


def keep_identified(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The documents whose language is not rejected, with their own columns."""
    found = free_name(docs, "language")
    return identify(docs, model, text, found).filter(~F.col(f"{found}.rejected")).drop(found)

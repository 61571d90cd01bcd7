"""Token counts of a byte-level BPE vocabulary, by a whole-token shortcut.

Before any text is read every vocabulary string is put through the merges by itself. The strings that end as one token
are proven: wherever such a string is a pre-token, it counts one. A text is cut into pre-tokens, those found among the
proven strings are counted without merging, and only the rest are merged, each by a heap of ranked pairs, so that a run
of a million letters takes n log n steps. Counts of short ones are remembered in a bounded memory of the worker.

Special strings are one token each and cut the text, as the library does by default. Letters and numbers are told by the
``regex`` package. The library has Unicode tables of its own: a character is tried against the library the first time
a worker meets it, and texts with a character that the two cut differently are cut by the library.

Defined cases: null and empty texts have no tokens and 0 bytes; repeated rows are counted alike; an empty table gives
an empty result; other columns pass through, and one that is named like a result column is replaced by it. Whole texts
are counted, a block of about ``BLOCK`` characters at a time, cut where no pre-token can lie across.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .shared import ship

#: The pattern that cuts a text into pre-tokens, and the bytes that a byte-level vocabulary writes as themselves.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
PRINTED = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]

BLOCK = 1 << 20
REMEMBERED = 200_000
REMEMBERED_CHARS = 64


def byte_letters() -> list[str]:
    """The character that stands for each byte: itself if it is printed, else the next unused one from 256 on."""
    printed, unused = set(PRINTED), iter(range(256, 512))
    return [chr(b if b in printed else next(unused)) for b in range(256)]


class Merges:
    """The vocabulary as pairs of ids with the rank of their merge."""

    def __init__(self, file: bytes):
        read = json.loads(file)
        model, cut = read["model"], read["pre_tokenizer"] or {}
        plain = not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix",
                                               "fuse_unk", "byte_fallback", "ignore_merges"))
        if (model["type"] != "BPE" or cut.get("type") != "ByteLevel" or cut.get("add_prefix_space") or not cut.get("use_regex", True)
                or read["normalizer"] or not plain):
            raise ValueError("only byte-level BPE without normalisation and added prefixes is supported")
        added = read["added_tokens"]
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in added):
            raise ValueError("special strings that take white space or stand for words are not supported")
        vocabulary = model["vocab"]
        letters = byte_letters()
        self.byte = [vocabulary[c] for c in letters]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.rank = {(vocabulary[a], vocabulary[b]): rank for rank, (a, b) in enumerate(pairs)}
        self.made = [vocabulary[a + b] for a, b in pairs]
        self.special = sorted((t["content"] for t in added), key=len, reverse=True)
        value = {c: b for b, c in enumerate(letters)}
        self.strings = [bytes(value[c] for c in s) for s in vocabulary if all(c in value for c in s)]

    def count(self, raw: bytes) -> int:
        """Tokens that are left when the pair of least rank, the leftmost of them, is merged until no pair has a rank."""
        ids = [self.byte[b] for b in raw]
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        rank, made = self.rank, self.made
        # One number for rank and position sorts as the two do.
        heap = [found * n + at for at in range(n - 1) if (found := rank.get((ids[at], ids[at + 1]))) is not None]
        heapify(heap)
        left = n
        while heap:
            merge, at = divmod(heappop(heap), n)
            right = after[at]
            if ids[at] < 0 or right >= n:
                continue
            now = rank.get((ids[at], ids[right]))
            if now is None or made[now] != made[merge]:
                continue  # one of the two has been merged since
            ids[at], ids[right] = made[merge], -1
            left -= 1
            after[at] = further = after[right]
            if further < n:
                before[further] = at
                if (found := rank.get((ids[at], ids[further]))) is not None:
                    heappush(heap, found * n + at)
            if (previous := before[at]) >= 0 and (found := rank.get((ids[previous], ids[at]))) is not None:
                heappush(heap, found * n + previous)
        return left

    def whole(self) -> list[str]:
        """The vocabulary strings that the merges turn into one token, each tried by itself."""
        proven = []
        for raw in self.strings:
            try:
                text = raw.decode()
            except UnicodeDecodeError:
                continue  # part of a character is never a pre-token
            if self.count(raw) == 1:
                proven.append(text)
        return proven


class Counter:
    """A vocabulary in a task."""

    def __init__(self, file: bytes, whole: list[str]):
        self.merges, self.whole = Merges(file), frozenset(whole)
        self.library = Tokenizer.from_str(file.decode()).pre_tokenizer
        self.cut = regex.compile(PATTERN)
        self.special = regex.compile("|".join(map(regex.escape, self.merges.special))) if self.merges.special else None
        self.block_end = regex.compile(r"(?<=[!-~])(?= [!-~])")  # before a space between two printed ASCII characters
        self.known: dict[str, int] = {}
        self.alike = set(map(chr, range(128)))
        self.unlike: set[str] = set()

    def _by_library(self, text: str) -> list[str]:
        return [text[start:end] for _, (start, end) in self.library.pre_tokenize_str(text)]

    def _cuts_alike(self, text: str) -> bool:
        """Whether pattern and library cut all characters of the text alike; new ones are tried among all kinds of neighbours."""
        if text.isascii():
            return True
        letters = set(text)
        for c in letters - self.alike - self.unlike:
            probe = f"a{c}a 1{c}1 !{c}! {c}{c} {c}"
            (self.alike if self.cut.findall(probe) == self._by_library(probe) else self.unlike).add(c)
        return letters.isdisjoint(self.unlike)

    def _blocks(self, text: str) -> Iterator[str]:
        start = 0
        while len(text) - start > BLOCK:
            end = self.block_end.search(text, start + BLOCK)
            if end is None:
                break
            yield text[start:end.start()]
            start = end.start()
        yield text[start:] if start else text

    def _plain(self, text: str) -> int:
        total, whole, known = 0, self.whole, self.known
        for block in self._blocks(text):
            found = self.cut.findall(block) if self._cuts_alike(block) else self._by_library(block)
            rest = [p for p in found if p not in whole]
            total += len(found) - len(rest)
            for p in rest:
                if (n := known.get(p)) is None:
                    n = self.merges.count(p.encode())
                    if len(p) <= REMEMBERED_CHARS:
                        if len(known) >= REMEMBERED:
                            known.clear()
                        known[p] = n
                total += n
        return total

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        if self.special is None or not self.special.search(text):
            return self._plain(text)
        parts = self.special.split(text)
        return len(parts) - 1 + sum(self._plain(p) for p in parts if p)


_made: dict[int, Counter] = {}


def _once(file: bytes, whole: list[str]) -> Counter:
    """One counter per worker and vocabulary: its memory lasts from task to task."""
    key = hash(file)
    if key not in _made:
        _made.clear()
        _made[key] = Counter(file, whole)
    return _made[key]


def read_vocabulary(path: str) -> bytes:
    """A tokenizer file, read on the driver; it goes to the tasks with the job (some megabytes)."""
    with open(path, "rb") as file:
        return file.read()


def count_tokens(docs: DataFrame, vocabulary: bytes, text: str = "text", limit: int = 1024) -> DataFrame:
    """``docs`` with n_bytes (UTF-8), n_tokens and over_limit (more than ``limit`` tokens)."""
    ship(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast((vocabulary, Merges(vocabulary).whole()))

    @F.arrow_udf("long")
    def tokens(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        counter = _once(*sent.value)
        for batch in batches:
            yield pa.array([counter.count(t.as_py()) for t in batch], pa.int64())

    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    return docs.withColumns({"n_bytes": F.octet_length(body).cast("long"), "n_tokens": tokens(body)}).withColumn(
        "over_limit", F.col("n_tokens") > limit)

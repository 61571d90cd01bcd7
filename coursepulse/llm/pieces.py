"""SentencePiece encoding and decoding with a given model file.

An Aho-Corasick automaton over the pieces reports, at every position of a text and in one pass, all pieces that end
there (its output links). A Viterbi table relaxes the best path to that position with each of them. For a unigram
model every piece may follow every other and the largest sum of scores wins. For a BPE model a piece may follow the
last piece of the best path only if merging the two by the model's ranks leaves them as they are; then exactly one
path reaches each position, and it is the encoding that merging the whole text gives.

Text is normalised as the model's identity rule says: a space in front, spaces written as U+2581. Characters that are
no piece become their UTF-8 byte pieces. A text is cut only where no piece can lie across, so no length is too long.

Defined cases: null and empty texts have no pieces, and decode to the empty text; U+2581 in a text decodes to a space,
as the model cannot tell them apart; repeated rows are encoded alike; an empty table gives an empty result; other
columns pass through (``out`` must be a new name).
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Callable, Iterator
from itertools import pairwise
from math import inf

import ahocorasick
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import free_name, ship

MARK = "▁"
CACHED_WORDS = 100_000
CACHED_CHARS = 64
ROWS = 256
CACHED_PAIRS = 300_000


class Decoder:
    """The pieces of a model, and the way back from ids to text."""

    def __init__(self, model: bytes):
        self._read(sentencepiece.SentencePieceProcessor(model_proto=model))

    def _read(self, read: sentencepiece.SentencePieceProcessor) -> None:
        ids = range(read.vocab_size())
        self.pieces = [read.id_to_piece(i) for i in ids]
        self.bytes = {int(self.pieces[i][3:5], 16): i for i in ids if read.is_byte(i)}
        self.byte_of = {i: b for b, i in self.bytes.items()}
        self.unknown = read.unk_id()
        self.silent = {i for i in ids if read.is_control(i)}
        # What an id stands for by itself; a byte that is part of a longer character stands for nothing alone.
        self.plain = ["" if i in self.silent else p for i, p in enumerate(self.pieces)]
        for b, i in self.bytes.items():
            self.plain[i] = chr(b) if b < 0x80 else None

    def decode(self, ids) -> str:
        try:
            text = "".join(map(self.plain.__getitem__, ids))
        except TypeError:  # characters of several bytes
            parts, raw = [], bytearray()
            for i in ids:
                if i in self.byte_of:
                    raw.append(self.byte_of[i])
                    continue
                if raw:
                    parts.append(raw.decode("utf-8", "replace"))
                    raw.clear()
                parts.append(self.plain[i])
            parts.append(raw.decode("utf-8", "replace"))
            text = "".join(parts)
        return text.replace(MARK, " ").removeprefix(" ")


class Encoder(Decoder):
    """The model in a task: automaton, table of best paths, and a bounded memory of words met before."""

    def __init__(self, model: bytes):
        read = sentencepiece.SentencePieceProcessor(model_proto=model)
        self._read(read)
        ids = range(read.vocab_size())
        special = {*self.byte_of, *self.silent, self.unknown}
        self.rank = {p: i for i, p in enumerate(self.pieces) if i not in special and not read.is_unused(i)}
        self.score = [read.get_score(i) for i in ids]
        # Merge ranks are whole numbers; log probabilities are not.
        self.merges = all(self.score[i].is_integer() for i in self.rank.values())
        self.length = [len(p) for p in self.pieces]
        self.words: dict[str, bytes] = {}  # words met lately
        self.older: dict[str, bytes] = {}  # and before; those not met again go
        self.pairs: dict[int, bool] = {}
        self.automaton = ahocorasick.Automaton()
        for piece, i in self.rank.items():
            if not self.merges or self._merged(piece) == [piece]:
                self.automaton.add_word(piece, i)
        self.automaton.make_automaton()
        # Words: a run of marks with what follows up to the next mark, or up to a character that joins no other. A
        # character that is in no piece is a word of its own.
        known = set("".join(self.rank)) - {MARK}
        single = {c for c in known if c in self.rank}
        joined = set("".join(p for p in self.rank if len(p) > 1))
        if any(MARK in p.lstrip(MARK) for p in self.rank) or single != known:
            raise ValueError("pieces with a mark inside, or with characters that are no pieces, are not supported")
        letters = {c for c in known & joined if c.isalpha()}
        others = (known & joined) - letters
        if any((a in letters) != (b in letters) for p in self.rank for a, b in pairwise(p.lstrip(MARK))):
            letters, others = letters | others, set()  # some piece holds both kinds
        kinds = [f"[{''.join(map(re.escape, sorted(kind)))}]+" for kind in (letters, others) if kind]
        self.cut = re.compile("|".join([f"{MARK}+(?:{'|'.join(kinds)})?", *kinds, "."]), re.DOTALL)

    def _merged(self, text: str) -> list[str]:
        """Adjacent symbols joined by best score, the leftmost first, until no two make a piece."""
        parts = list(text)
        while len(parts) > 1:
            found = [(-self.score[i], k) for k in range(len(parts) - 1) if (i := self.rank.get(parts[k] + parts[k + 1])) is not None]
            if not found:
                break
            k = min(found)[1]
            parts[k:k + 2] = [parts[k] + parts[k + 1]]
        return parts

    def _may_follow(self, before: int, piece: int) -> bool:
        left, right = self.pieces[before], self.pieces[piece]
        if len(self.pairs) >= CACHED_PAIRS:
            self.pairs.clear()
        self.pairs[before << 32 | piece] = known = self._merged(left + right) == [left, right]
        return known

    def _word(self, word: str) -> bytes:
        """Best path over one word, as 32-bit ids."""
        if len(word) == 1 and word not in self.rank:
            raw = word.encode("utf-8", "replace")
            return array("i", [self.bytes.get(b, self.unknown) for b in raw] if self.bytes else [self.unknown]).tobytes()
        n = len(word)
        last = [-1] * (n + 1)  # the piece that ends the best path
        size = self.length
        if self.merges:
            # Paths are told apart by whether their pieces stay apart, so there is one to each position at most.
            allowed = self.pairs.get
            for end, piece in self.automaton.iter(word):
                end += 1
                if last[end] < 0:
                    if start := end - size[piece]:
                        before = last[start]
                        if (fits := allowed(before << 32 | piece)) is None:
                            fits = before >= 0 and self._may_follow(before, piece)
                        if not fits:
                            continue
                    last[end] = piece
        else:
            best: list[float] = [0.0] + [-inf] * n
            for end, piece in self.automaton.iter(word):
                end += 1
                score = best[end - size[piece]] + self.score[piece]
                if score > best[end]:
                    best[end] = score
                    last[end] = piece
        path = []
        while n:
            path.append(last[n])
            n -= size[path[-1]]
        path.reverse()
        return array("i", path).tobytes()

    def encode(self, text: str | None) -> array:
        ids = array("i")
        if not text:
            return ids
        words, older = self.words, self.older
        found = []
        for word in self.cut.findall(MARK + text.replace(" ", MARK)):
            if (word_ids := words.get(word)) is None:
                if (word_ids := older.get(word)) is None:
                    word_ids = self._word(word)
                if len(word) <= CACHED_CHARS:
                    if len(words) >= CACHED_WORDS:
                        self.words, self.older = words, older = {}, words
                    words[word] = word_ids
            found.append(word_ids)
        ids.frombytes(b"".join(found))
        return ids


def read_model(path: str) -> bytes:
    """The bytes of a model file on the driver; they go to the tasks with the job (some hundred kilobytes)."""
    with open(path, "rb") as file:
        return file.read()


class Kept:
    """A model, and what a worker has made of it. It is sent as a broadcast, which a worker gives up with its first task of
    another job: the memory of words lasts from task to task, but not beyond the job."""

    def __init__(self, model: bytes):
        self.model = model
        self.made: dict[type, Decoder] = {}

    def once(self, kind: type) -> Decoder:
        if kind not in self.made:
            self.made[kind] = kind(self.model)
        return self.made[kind]


def _with(docs: DataFrame, text: str, added: list[T.StructField], make: Callable[[pa.Array], Iterator[pa.Array]]) -> DataFrame:
    """``docs`` with columns ``added``, as ``make`` gives them for the column ``text``; given ones of those names give way.
    Columns go to the tasks by number, so their names may hold anything. A task holds ``ROWS`` rows besides the batch it reads."""
    new = {f.name.lower() for f in added}
    given = [f for f in docs.schema.fields if f.name.lower() not in new]
    numbered = docs.select(F.col(f"`{text}`").alias("text"), *[F.col(f"`{f.name}`").alias(f"c{i}") for i, f in enumerate(given)])
    names = [f.name for f in [*given, *added]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (whole.slice(start, ROWS) for whole in batches for start in range(0, len(whole), ROWS)):
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], *make(batch.column(0))], names)

    return numbered.mapInArrow(run, T.StructType([*given, *added]))


def encode(docs: DataFrame, model: bytes, text: str = "text", out: str = "pieces", round_trip: str | None = None) -> DataFrame:
    """``docs`` with ``out``, the piece ids of ``text`` in order, and, if it has a name, ``round_trip``: whether decoding
    them gives the text again. Given columns of these names give way.

    Only texts go to the tasks, a hundred at a time; an Arrow batch would hold up to 64 MB of rows on both sides."""
    ship(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(Kept(model))
    ids_type = T.ArrayType(T.IntegerType())

    def to_ids(body: str | None) -> list[int]:
        return sent.value.once(Encoder).encode(body).tolist()

    def to_ids_and_back(body: str | None) -> tuple[list[int], bool]:
        encoder = sent.value.once(Encoder)
        ids = encoder.encode(body)
        return ids.tolist(), encoder.decode(ids) == (body or "")

    new = {name.lower() for name in (out, round_trip) if name}
    given = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in new]
    if not round_trip:
        return docs.select(*given, F.udf(to_ids, ids_type, useArrow=False)(F.col(f"`{text}`")).alias(out))
    both = F.udf(to_ids_and_back, T.StructType().add("ids", ids_type).add("same", "boolean"), useArrow=False)
    found = free_name(docs, "encoded")
    return docs.withColumn(found, both(F.col(f"`{text}`"))).select(
        *given, F.col(f"{found}.ids").alias(out), F.col(f"{found}.same").alias(round_trip))


def decode(rows: DataFrame, model: bytes, pieces: str = "pieces", out: str = "decoded") -> DataFrame:
    """``rows`` with ``out``, the text of the ids in ``pieces``; null ids give the empty text."""
    ship(rows.sparkSession)
    sent = rows.sparkSession.sparkContext.broadcast(Kept(model))

    def to_text(column: pa.Array) -> Iterator[pa.Array]:
        decoder = sent.value.once(Decoder)
        yield pa.array([decoder.decode(ids or []) for ids in column.to_pylist()], pa.string())

    return _with(rows, pieces, [T.StructField(out, T.StringType())], to_text)

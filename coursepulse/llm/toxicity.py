"""Toxicity by a weighted finite-state pattern grammar.

A clause is read as a string of symbols: insult, threat, target, negation, reported speech, or other. Small transducers
are composed over it. One marks what a negation governs, one what is only reported, one whether the clause
addresses somebody; the composed machine ends a clause in an event such as "insult, aimed, not negated, reported".
A document's score is a logistic function of its events. Words alone score nothing outside of a clause's event.

Insult words are arcs learned from labels: word beginnings whose documents are mostly toxic. Event weights are learned
from the same labels, pulled towards the grammar's own values. Both fits read a bounded sample (``sample_docs`` of
each label, those with the smallest hashes of their ids); scoring reads every whole text.

Defined cases: null and empty texts have no clause and get the score of a document without events; without labels the
grammar's own words and weights hold; a document labelled twice counts with each label; null labels and labels without
document are not learned; repeated rows score alike; empty tables give empty results; other columns pass through.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from typing import NamedTuple

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import ship, stage

# The grammar's word lists. Insults and threats match as word beginnings, the others as whole words.
INSULTS = ("idiot", "moron", "stupid", "scum", "worthless", "pathetic", "imbecil", "imbécil", "abruti", "connard", "dummkopf",
           "arschloch", "estúpid", "gilipollas")
THREATS = ("kill", "murder", "strangle", "stab you", "shoot you", "beat you", "hurt you", "umbringen", "abstechen", "te tuer",
           "vous tuer", "matarte", "matarlos")
TARGETS = ("you", "your", "yours", "u", "ur", "they", "them", "he", "she", "him", "her", "du", "dich", "dir", "ihr", "euch", "sie",
           "tu", "te", "toi", "vous", "ils", "tú", "ti", "usted", "ustedes", "ellos")
NEGATIONS = ("not", "no", "never", "isn't", "aren't", "don't", "without", "nicht", "kein", "keine", "nie", "pas", "jamais", "sans",
             "nunca", "jamás", "sin")
REPORTS = ("said", "says", "say", "called", "calls", "wrote", "quoted", "allegedly", "sagte", "nannte", "schrieb", "dit", "disait",
           "appelé", "dijo", "llamó", "escribió")

WORD = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?")
CLAUSE_END = re.compile(r"[.!?;:|\n\r…]+")
EVENT = ("insult", "insult aimed", "insult negated", "insult reported", "threat", "threat aimed", "threat negated", "threat reported")
#: The grammar's own weights: a base value, then one for each event.
PRIOR = np.array([-3.0, 4.5, 1.0, -2.0, -1.0, 4.5, 1.0, -2.0, -1.0])
NEGATION_REACH = 3


class Grammar(NamedTuple):
    insults: tuple[str, ...]
    weights: tuple[float, ...]


# Transducers: (state, symbol) -> (state, symbol). A symbol is (kind, marks).
Symbol = tuple[str, frozenset]
Machine = Callable[[object, Symbol], tuple[object, Symbol]]


def negation(state: int, symbol: Symbol) -> tuple[int, Symbol]:
    """Marks a core within reach of a negation; the state counts the words that are left of the reach."""
    kind, marks = symbol
    if kind == "negation":
        return NEGATION_REACH, symbol
    if state and kind in ("insult", "threat"):
        symbol = (kind, marks | {"negated"})
    return max(0, state - 1), symbol


def reported(state: int, symbol: Symbol) -> tuple[int, Symbol]:
    """Marks every core after a verb of saying."""
    kind, marks = symbol
    if kind == "report":
        return 1, symbol
    return state, (kind, marks | {"reported"}) if state and kind in ("insult", "threat") else symbol


def collect(state: tuple, symbol: Symbol) -> tuple[tuple, Symbol]:
    """The cores of the clause so far, and whether somebody is addressed."""
    cores, aimed = state
    kind, _ = symbol
    return (cores | {symbol} if kind in ("insult", "threat") else cores, aimed or kind == "target"), symbol


def compose(machines: Iterable[tuple[Machine, object]]) -> Callable[[Iterable[str]], tuple]:
    """One machine that feeds the output of each transducer to the next. Its transitions are kept once met: their
    number is bounded by the product of the states, whatever is read."""
    steps = [machine for machine, _ in machines]
    start = tuple(state for _, state in machines)
    arcs: dict[tuple, tuple] = {}

    def run(kinds: Iterable[str]) -> tuple:
        state = start
        for kind in kinds:
            if (after := arcs.get((state, kind))) is None:
                symbol, states = (kind, frozenset()), []
                for machine, own in zip(steps, state, strict=True):
                    own, symbol = machine(own, symbol)
                    states.append(own)
                after = arcs[state, kind] = tuple(states)
            state = after
        return state[-1]

    return run


class Reader:
    """The grammar in a task."""

    def __init__(self, insults: Iterable[str]):
        self.clause = compose([(negation, 0), (reported, 0), (collect, (frozenset(), False))])
        self.cores = ahocorasick.Automaton()
        for kind, stems in (("threat", THREATS), ("insult", insults)):
            for stem in stems:
                self.cores.add_word(stem, (kind, len(stem)))
        self.cores.make_automaton()
        self.kind = {w: kind for kind, words in (("target", TARGETS), ("negation", NEGATIONS), ("report", REPORTS)) for w in words}

    def events(self, text: str | None) -> np.ndarray:
        """Clauses of the text by event. Only clauses around a core are read: no other clause can end in an event."""
        counts = np.zeros(len(EVENT))
        if not text:
            return counts
        low = text.lower()
        found: dict[int, str] = {}
        for end, (kind, length) in self.cores.iter(low):
            at = end + 1 - length
            if (at == 0 or not low[at - 1].isalpha()) and kind != "threat" or (kind == "threat" and _whole(low, at, end + 1)):
                found.setdefault(at, kind)
        starts = [0, *(end.end() for end in CLAUSE_END.finditer(low))] if found else []
        upto = -1
        for at in sorted(found):
            if at < upto:
                continue
            begin = starts[bisect_right(starts, at) - 1]
            ending = CLAUSE_END.search(low, at)
            upto = ending.start() if ending else len(low)
            kinds = (found.get(w.start()) or self.kind.get(w.group(), "other") for w in WORD.finditer(low, begin, upto))
            cores, aimed = self.clause(kinds)
            for kind, marks in cores:
                base = EVENT.index(kind)
                counts[base] += 1
                counts[base + 1] += aimed
                counts[base + 2] += "negated" in marks
                counts[base + 3] += "reported" in marks
        return counts


def _whole(text: str, start: int, end: int) -> bool:
    return (start == 0 or not text[start - 1].isalpha()) and (end == len(text) or not text[end].isalpha())


def _shape(events: np.ndarray) -> np.ndarray:
    """A leading one and the damped counts."""
    return np.concatenate([np.ones((len(events), 1)), np.log1p(events)], axis=1)


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, id_col: str, text: str, sample_docs: int) -> DataFrame:
    """At most about ``sample_docs`` documents of each label, by hash of the id: columns id, body, label."""
    known = labels.filter(F.col(label).isin(0, 1) & F.col(id_col).isNotNull()).select(
        F.col(id_col).alias("id"), F.col(label).cast("int").alias("label"))
    own = docs.filter(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(text).alias("body"))
    sizes = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    edge = F.lit(0.0)
    for value, n in sizes.items():
        edge = F.when(F.col("label") == value, F.lit(min(1.0, sample_docs / n))).otherwise(edge)
    chosen = known.filter(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) <= edge * (1 << 30))
    # The sample is bounded, so its ids go to every task, and no text of another document moves.
    return own.join(F.broadcast(chosen), "id")


def learn_stems(sample: DataFrame, lengths: tuple[int, ...] = (4, 5, 6, 7), most: int = 2000, precision: float = 0.9,
                support: int = 5) -> tuple[str, ...]:
    """Word beginnings (and whole words) found in ``support`` toxic documents at least, ``precision`` of all documents
    that hold them being toxic. Of nested beginnings the shortest is kept."""
    ship(sample.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        toxic, clean = Counter(), Counter()
        for batch in batches:
            for body, label in zip(batch["body"].to_pylist(), batch["label"].to_pylist(), strict=True):
                words = set(WORD.findall((body or "").lower()))
                (toxic if label else clean).update({w[:n] for w in words for n in lengths if len(w) >= n} | words)
            if len(toxic) + len(clean) > 1_000_000:
                yield _counts(toxic, clean)
                toxic, clean = Counter(), Counter()
        yield _counts(toxic, clean)

    counted = sample.select("body", "label").mapInArrow(count, "stem string, toxic long, clean long")
    found = (
        counted.groupBy("stem").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
        .filter((F.col("toxic") >= support) & (F.col("toxic") >= precision * (F.col("toxic") + F.col("clean"))))
        .orderBy(F.desc("toxic"), "stem").limit(most)
    ).collect()
    stems: list[str] = []
    for stem in sorted((r["stem"] for r in found), key=lambda s: (len(s), s)):
        if not any(stem.startswith(s) for s in stems):
            stems.append(stem)
    return tuple(stems)


def _counts(toxic: Counter, clean: Counter) -> pa.RecordBatch:
    stems = list(toxic.keys() | clean.keys())
    return pa.RecordBatch.from_pydict({
        "stem": pa.array(stems, pa.string()), "toxic": pa.array([toxic[s] for s in stems], pa.int64()),
        "clean": pa.array([clean[s] for s in stems], pa.int64())})


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", id_col: str = "doc_id", text: str = "text",
        sample_docs: int = 10_000, pull: float = 1.0) -> Grammar:
    """Stems and event weights from the sample. ``pull``: strength of the pull towards the grammar's own weights."""
    sample = stage(labelled_sample(docs, labels, label, id_col, text, sample_docs).select("body", "label"), "sample")
    learned = learn_stems(sample)
    insults = tuple(dict.fromkeys([*learned, *INSULTS]))
    rows = read(sample, insults, "body", "events").groupBy("events", "label").count().collect()
    if not rows:
        return Grammar(insults, tuple(PRIOR))
    x = _shape(np.array([r["events"] for r in rows]))
    y, n = np.array([r["label"] for r in rows]), np.array([r["count"] for r in rows], float)
    w = PRIOR.copy()
    for _ in range(50):  # Newton steps on the penalised likelihood
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (n * (p - y)) + pull * (w - PRIOR)
        step = np.linalg.solve((x * (n * p * (1 - p))[:, None]).T @ x + pull * np.eye(len(w)), slope)
        w -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return Grammar(insults, tuple(w.tolist()))


def read(docs: DataFrame, insults: tuple[str, ...], text: str = "text", out: str = "events") -> DataFrame:
    """``docs`` with ``out``: the number of clauses for each of ``EVENT``."""
    ship(docs.sparkSession)

    @F.pandas_udf("array<double>")
    def clauses(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        reader = Reader(insults)
        for batch in batches:
            yield pd.Series([reader.events(t) for t in batch], dtype=object)

    return docs.withColumn(out, clauses(F.col(text)))


def score(docs: DataFrame, grammar: Grammar, text: str = "text", out: str = "toxicity") -> DataFrame:
    """``docs`` with ``out``, between 0 and 1, and ``out``_events."""
    marked = read(docs, grammar.insults, text, f"{out}_events")
    base, *weights = grammar.weights
    total = F.lit(base)
    for i, weight in enumerate(weights):
        total = total + F.log1p(F.col(f"{out}_events")[i]) * weight
    return marked.withColumn(out, 1 / (1 + F.exp(-total)))

"""Toxicity by a weighted finite-state pattern grammar.

Words become symbols: insult (a learned lexicon of words and word beginnings
with weights), threat, target, negation and reported speech (short lists), clause
end, or other.  Transducers are composed, each reading what the one before
writes: negation turns the insults and threats in its reach into negated ones,
reported speech turns what comes after a verb of saying into reported ones, and
the clause's transducer remembers whether an insult, a threat or a target was
there and writes at its end what the rest counts as.  Each match adds its weight
to its kind.  A document is scored from these sums by a logistic model over the
kinds whose weights are in the order that the grammar means: neither a targeted
insult nor a threat weighs less than a plain insult, no negated or reported
match more.

The lexicon comes from one half of a bounded sample of the labelled rows, the
kinds' weights from the other half.  Of near copies one text is left in the
sample, and a lexicon entry must stand after many different words in toxic
texts, so copies of one text can't put theirs in.
"""

from __future__ import annotations

import functools
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from occurra.llm import logistic
from occurra.llm.common import cut, mix64, pick, place_of, positional, prepare, texts
from occurra.llm.jaccard import shingle_sets

#: Rows of the training sample: at most about so many of either label.
SAMPLE = 8000
#: Entries of the lexicon at most, and of those that are looked at in their contexts.
ENTRIES, CANDIDATES = 2000, 40_000
#: Words a worker remembers.
REMEMBERED = 100_000
CONTEXTS = 6  # different words before an entry, in toxic texts
STEMS = (4, 5, 6)  # lengths of word beginnings that can be entries
LEAST_WEIGHT = 1.5

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT, END, DENIED_INSULT, DENIED_THREAT, SAID_INSULT, SAID_THREAT = range(11)
# fixed values: closed-class words of English, French, German and Spanish
TARGETS = "you your yours u ye tu toi te vous votre vos ton ta tes du dich dir dein deine ihr euch euer tú ti usted ustedes vosotros vuestro"
NEGATIONS = "not never no nor cannot isn aren wasn don doesn didn wouldn couldn ne pas jamais aucun nicht kein keine nie niemals nunca jamás ni"
REPORTS = "said says say quoted wrote claimed called reported dit disait écrit cité sagte sagt schrieb zitierte dijo dice escribió citó"
THREATS = "kill hurt destroy murder stab tuer mourir frapper töten sterben schlagen matar morir golpear"
_LISTS = {
    w: s for names, s in ((THREATS, THREAT), (TARGETS, TARGET), (NEGATIONS, NEGATION), (REPORTS, REPORT)) for w in names.split()
}

_TOKEN = re.compile(r"[^\W\d_]+|[.!?;\n]")

KINDS = ("plain", "targeted", "negated", "reported", "threat")
#: Weights of the kinds of match before any label is seen; last: intercept.
PRIOR = np.array([2.0, 2.6, 0.8, 0.8, 6.0, -3.0])
#: Pairs of kinds of which the first never weighs more.
BELOW = [(0, 1), (0, 4), (2, 0), (3, 0)]
NEAR = 3  # words that a negation reaches over, in its clause
SAID = 12  # words that a verb of saying reaches over


@dataclass(frozen=True)
class Transducer:
    """``moves[state][symbol]`` is (next state, symbol that it writes); else the state stays and writes what it reads."""

    moves: tuple[dict[int, tuple[int, int]], ...]

    def step(self, state: int, symbol: int) -> tuple[int, int]:
        return self.moves[state].get(symbol, (state, symbol))


def reaching(mark: int, words: int, turns: dict[int, int]) -> Transducer:
    """After ``mark``, over so many symbols, turns symbols into others; a clause's end ends it."""
    first = {mark: (1, mark)}
    later = [
        {s: ((k + 1) % (words + 1), turns.get(s, s)) for s in range(SAID_THREAT + 1)} | {mark: (1, mark), END: (0, END)}
        for k in range(1, words + 1)
    ]
    return Transducer((first, *later))


DENIED = reaching(NEGATION, NEAR, {INSULT: DENIED_INSULT, THREAT: DENIED_THREAT})
QUOTED = reaching(REPORT, SAID, {
    INSULT: SAID_INSULT, DENIED_INSULT: SAID_INSULT, THREAT: SAID_THREAT, DENIED_THREAT: SAID_THREAT,
})
#: What a clause's end says: nothing, insults at nobody, insults and threats at somebody.
NOTHING, LOOSE, AIMED = range(11, 14)


def _clause() -> Transducer:
    """State: 1 a target, 2 an insult was there; the end writes what the clause's matches count as."""
    moves = []
    for state in range(4):
        out = {TARGET: (state | 1, TARGET), END: (0, AIMED if state & 1 else LOOSE if state & 2 else NOTHING)}
        out |= {s: (state | 2, s) for s in (INSULT, DENIED_INSULT, SAID_INSULT)}
        moves.append(out)
    return Transducer(tuple(moves))


class Grammar:
    """The composition of the transducers; its states are numbered and made as they are reached."""

    PARTS = (DENIED, QUOTED, _clause())

    def __init__(self) -> None:
        self.numbers: dict[tuple, int] = {}
        self.states: list[tuple] = []
        self.table: list[list] = []  # by state and symbol: (next state, symbol written)
        self.number((0,) * len(self.PARTS))

    def number(self, state: tuple) -> int:
        if state not in self.numbers:
            self.numbers[state] = len(self.states)
            self.states.append(state)
            self.table.append([None] * (SAID_THREAT + 1))
        return self.numbers[state]

    def step(self, state: int, symbol: int) -> tuple[int, int]:
        written, after = symbol, []
        for part, s in zip(self.PARTS, self.states[state]):  # each reads what the one before writes
            s, written = part.step(s, written)
            after.append(s)
        got = self.table[state][symbol] = (self.number(tuple(after)), written)
        return got

    def clauses(self, symbols: list[tuple[int, float]]) -> np.ndarray:
        """The weight of the matches, by kind."""
        out, state, table = np.zeros(len(KINDS)), 0, self.table
        insults, threats = [0.0] * 3, [0.0] * 3  # as such, negated, reported
        place = {INSULT: (insults, 0), DENIED_INSULT: (insults, 1), SAID_INSULT: (insults, 2),
                 THREAT: (threats, 0), DENIED_THREAT: (threats, 1), SAID_THREAT: (threats, 2)}
        for symbol, w in [*symbols, (END, 0.0)]:
            state, written = table[state][symbol] or self.step(state, symbol)
            if not written:
                continue
            if written in place:
                held, k = place[written]
                held[k] += w
            elif written == AIMED:
                out += (0, insults[0], insults[1] + threats[1], insults[2] + threats[2], threats[0])
            elif written == LOOSE:  # threats at nobody go with the insults
                out += (insults[0] + threats[0], 0, insults[1] + threats[1], insults[2] + threats[2], 0)
            if symbol == END and (written != NOTHING or any(threats)):
                insults[:], threats[:] = [0.0] * 3, [0.0] * 3
        return out


class Symbols(dict):
    """Each word's (symbol, weight), found once."""

    def __init__(self, lexicon: dict[str, float], threat: float = 1.0) -> None:
        super().__init__({c: (END, 0.0) for c in ".!?;\n"})
        self.lexicon, self.threat = lexicon, threat

    def __missing__(self, word: str) -> tuple[int, float]:
        entries = [self.lexicon.get(e, 0.0) for e in features(word)]
        best = max(entries)
        kind = INSULT if best > 0 else _LISTS.get(word, OTHER)
        got = (kind, best if kind == INSULT else self.threat if kind == THREAT else 0.0)
        if len(self) > REMEMBERED:
            self.clear()
            self.update({c: (END, 0.0) for c in ".!?;\n"})
        self[word] = got
        return got


def features(word: str) -> list[str]:
    """A word and its beginnings, as lexicon entries."""
    return [word, *(word[:k] + "*" for k in STEMS if len(word) > k)]


def tokens(text: str) -> list[str]:
    return _TOKEN.findall(unicodedata.normalize("NFC", text).lower() if not text.isascii() else text.lower())


def clause_features(text: str, symbols: Symbols, grammar: Grammar) -> np.ndarray:
    """log(1 + weight of matches) by kind, over the whole text."""
    seen = [symbols[t] for t in tokens(text)]
    if not any(s in (INSULT, THREAT) for s, _ in seen):
        return np.zeros(len(KINDS))
    return np.log1p(grammar.clauses(seen))


def _hash_part(col: Column) -> Column:
    return F.pmod(F.crc32(col.cast("string").cast("binary")), F.lit(3))


def held_out(doc_id: Column) -> Column:
    """Rows whose label is never learned from."""
    return F.coalesce(_hash_part(doc_id) == 1, F.lit(False))


def bounded_sample(labels: DataFrame, label: str, bound: int) -> DataFrame:
    """(doc_id, y, half) of labelled rows to learn from, about ``bound`` of either label at most.

    Rows are chosen by a hash of their id; ids labelled twice take the larger label.
    """
    rows = pick(labels, doc_id="doc_id", y=label).where("doc_id is not null and y is not null")
    rows = rows.select(F.col("doc_id").cast("long"), F.col("y").cast("int")).groupBy("doc_id").agg(F.max("y").alias("y"))
    rows = rows.where(~held_out(F.col("doc_id")))
    counts = {r["y"]: r["n"] for r in rows.groupBy("y").agg(F.count("*").alias("n")).collect()}
    share = F.lit(0)
    for y, n in counts.items():
        share = F.when(F.col("y") == y, F.lit(int(min(1.0, bound / n) * 1_000_000))).otherwise(share)
    rows = rows.where(F.pmod(F.xxhash64("doc_id", F.lit(17)), F.lit(1_000_000)) < share)
    return rows.withColumn("half", (_hash_part(F.col("doc_id")) == 0).cast("int"))


def sample_texts(docs: DataFrame, labels: DataFrame, label: str, bound: int) -> DataFrame:
    """The sample's distinct texts (text, y, half), kept in the shared folder.

    The sample's ids are broadcast: ``bound`` is their proven size.
    """
    prepare(docs.sparkSession)
    ids = bounded_sample(labels, label, bound)
    rows = texts(docs).join(F.broadcast(ids), "doc_id").where("text is not null")
    return cut(rows.groupBy("text").agg(F.max("y").alias("y"), F.min("half").alias("half")))


def _count_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(entry, toxic, clean): how many different words of how many texts an entry stands for."""
    toxic, clean = Counter(), Counter()
    for batch in batches:
        for text, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            (toxic if y else clean).update(e for w in set(tokens(text)) for e in features(w))
    names = list(set(toxic) | set(clean))
    yield pa.record_batch(
        [pa.array(names, pa.string()), pa.array([toxic[e] for e in names], pa.int64()),
         pa.array([clean[e] for e in names], pa.int64())], names=["entry", "toxic", "clean"])


@dataclass(frozen=True)
class Model:
    lexicon: dict[str, float]
    weights: np.ndarray

    @property
    def threat(self) -> float:
        """A threat weighs as the middle one of the insults."""
        return float(np.median(list(self.lexicon.values()))) if self.lexicon else 1.0


HASHES, BAND = 64, 4  # least shingle hashes of a text; texts that share BAND neighbouring ones meet
COPY = 0.7  # share of equal hashes of near copies; those with a likeness of 0.8 have fewer once in 40 cases


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, sig): the least shingle hashes in ``HASHES`` orders, each that of the hashes' products with an odd number."""
    odd = mix64(np.arange(1, HASHES + 1, dtype=np.uint64)) | np.uint64(1)
    for batch in batches:
        sigs = []
        for s in shingle_sets(batch.column(1).to_pylist()):
            sigs.append([int((s * k).min().view(np.int64)) for k in odd] if len(s) else None)
        yield pa.record_batch([batch.column(0), pa.array(sigs, pa.list_(pa.int64()))], names=["id", "sig"])


def without_copies(sample: DataFrame) -> DataFrame:
    """A sample (text, y, half) without the near copies, of the same label, of a text with a smaller hash.

    Texts meet the first one they share a band of least hashes with; equal hashes
    estimate the similarity of their shingle sets.
    """
    rows = sample.withColumn("id", F.xxhash64("text"))
    sigs = cut(rows.select("id", "text").mapInArrow(_signatures, "id long, sig array<long>").where("sig is not null"))
    starts = F.sequence(F.lit(0), F.lit(HASHES - BAND), F.lit(BAND))
    bands = F.posexplode(F.transform(starts, lambda i: F.xxhash64(F.slice("sig", i + 1, BAND)))).alias("band", "h")
    marks = sigs.join(rows.select("id", "y"), "id").select("id", "y", bands)
    first = marks.groupBy("y", "band", "h").agg(F.min("id").alias("first"))
    met = marks.join(first, ["y", "band", "h"]).where("id <> first").select("id", "first").distinct()
    met = met.join(sigs, "id").join(sigs.toDF("first", "other"), "first")
    equal = F.aggregate(F.zip_with("sig", "other", lambda p, q: (p == q).cast("int")), F.lit(0), lambda n, x: n + x)
    hidden = met.where(equal >= COPY * HASHES).select("id").distinct()
    return cut(rows.join(hidden, "id", "left_anti").drop("id"))


def learn(
    docs: DataFrame, labels: DataFrame, bound: int = SAMPLE, entries: int = ENTRIES, candidates: int = CANDIDATES
) -> Model:
    """The lexicon and the kinds' weights; without labels, an empty one and the prior.

    ``bound`` limits the labelled rows of either label, ``entries`` the size of
    the lexicon and ``candidates`` the entries whose contexts are counted, the
    most telling first; none of them depends on how many documents there are.
    """
    sample = without_copies(sample_texts(docs, labels, "toxic", bound))
    first, second = sample.where("half = 1"), sample.where("half = 0")
    totals = {r["y"]: r["n"] for r in first.groupBy("y").agg(F.count("*").alias("n")).collect()}
    pos, neg = totals.get(1, 0), totals.get(0, 0)
    counted = first.select("text", "y").mapInArrow(_count_features, "entry string, toxic long, clean long")
    counted = counted.groupBy("entry").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    # log-odds of careful bounds: fewer toxic and more clean texts than were counted
    at_least = F.greatest(F.col("toxic") - 1.5 * F.sqrt("toxic"), F.lit(0.1)) / (pos + 1)
    at_most = (F.col("clean") + 1.5 * F.sqrt("clean") + 3) / (neg + 4)
    weight = F.log(at_least) - F.log(at_most)
    likely = counted.where(F.col("toxic") >= CONTEXTS).withColumn("w", weight).where(F.col("w") >= LEAST_WEIGHT)
    # bounded: an entry needs CONTEXTS of the at most ``bound`` texts
    likely = likely.orderBy(F.desc("w"), F.desc("toxic"), "entry").limit(candidates).collect()
    found = {r["entry"]: (r["toxic"], r["clean"]) for r in likely}
    likely = {r["entry"]: r["w"] for r in likely}
    for e, (toxic, clean) in found.items():
        # a beginning goes when a longer one or a word has nearly all its toxic texts and fewer clean ones
        for stem in features(e.rstrip("*")):
            if stem != e and len(stem) <= len(e) and stem in likely and found[stem][1] > clean:
                if toxic >= 0.8 * found[stem][0]:
                    del likely[stem]

    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The words before (or, at the start of a text, after) likely entries in toxic texts."""
        seen = set()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                words = tokens(text)
                for i, w in enumerate(words):
                    for e in features(w):
                        if e in likely:
                            seen.add((e, words[i - 1] if i else "", words[i + 1] if i + 1 < len(words) else ""))
        cols = list(zip(*seen)) or [()] * 3
        yield pa.record_batch([pa.array(c, pa.string()) for c in cols], names=["entry", "before", "after"])

    around = first.where("y = 1").select("text").mapInArrow(contexts, "entry string, before string, after string")
    around = around.groupBy("entry").agg(F.count_distinct("before", "after").alias("n")).where(F.col("n") >= CONTEXTS)
    kept = {r["entry"]: r["n"] for r in around.collect()}
    best = sorted(kept, key=lambda e: (-likely[e] * np.log1p(kept[e]), e))[:entries]
    lexicon = {e: float(likely[e]) for e in best}
    threat = Model(lexicon, PRIOR).threat

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        symbols, grammar = Symbols(lexicon, threat), Grammar()
        for batch in batches:
            got = [clause_features(t, symbols, grammar).tolist() for t in batch.column(0).to_pylist()]
            yield pa.record_batch([batch.column(1), pa.array(got, pa.list_(pa.float64()))], names=["y", "x"])

    rows = second.select("text", "y").mapInArrow(measure, "y int, x array<double>").collect()  # the bounded sample
    rows.sort(key=lambda r: (r["y"], r["x"]))
    x = np.array([r["x"] for r in rows]).reshape(len(rows), len(KINDS))
    y = np.array([r["y"] for r in rows], float)
    return Model(lexicon, logistic.fit_ordered(x, y, PRIOR, BELOW, 0.2))


@functools.lru_cache(maxsize=1)
def _machine(lexicon: tuple, threat: float) -> tuple[Symbols, Grammar]:
    return Symbols(dict(lexicon), threat), Grammar()


def scorer(model: Model):
    """A column function: a text's toxicity, 0 to 1; a null text as an empty one."""
    lexicon, weights, threat = tuple(sorted(model.lexicon.items())), model.weights, model.threat

    @F.pandas_udf("double")
    def score(text: pd.Series) -> pd.Series:
        symbols, grammar = _machine(lexicon, threat)
        x = np.array([clause_features(t or "", symbols, grammar) for t in text]).reshape(len(text), len(KINDS))
        return pd.Series(1 / (1 + np.exp(-(x @ weights[:-1] + weights[-1]))))

    return score


def score(docs: DataFrame, labels: DataFrame, bound: int = SAMPLE, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, score): the toxicity of each whole text.

    Defined cases: null and empty texts score as texts without any match; null
    ids are scored too; equal rows each give a row, equal texts score alike;
    without labels the prior weights and an empty lexicon hold; an empty table
    gives no rows; extra columns are left out.
    """
    prepare(docs.sparkSession)
    return texts(docs, key, text).select("doc_id", scorer(learn(docs, labels, bound))(F.col("text")).alias("score"))


def without_toxic(docs: DataFrame, labels: DataFrame, limit: float, bound: int = SAMPLE) -> DataFrame:
    """The rows of ``docs`` that score below ``limit``, all columns as they are; cases as for :func:`score`."""
    prepare(docs.sparkSession)
    rows, text = positional(docs), F.col(f"c{place_of(docs, 'text')}").cast("string")
    return rows.where(scorer(learn(docs, labels, bound))(text) < limit).toDF(*docs.columns)

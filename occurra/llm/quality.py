"""Quality by hierarchical empirical Bayes over hosts and paths.

A document's own evidence is the log-odds of a classifier of its words and its
form, fitted on a bounded sample of labelled rows: words are hashed to
2^``BUCKET_BITS`` buckets, and the weights of the form's measures and of the mean
log-odds of a text's words are fitted with log-odds from the other half of the
sample.  Sites have a rate of good
documents: the global prior is a beta distribution whose moments come from all
hosts, a host's posterior adds its documents' probabilities, and a path's
posterior takes the host's mean as its prior with the strength of
``PATH_STRENGTH`` documents.  Sparse hosts and paths so stay near what lies
above them.  The score moves a document's log-odds by what its path's posterior,
without the document itself, says beyond the global rate.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from operator import eq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from occurra.llm import logistic
from occurra.llm.common import cut, place_of, positional, prepare
from occurra.llm.toxicity import sample_texts
from occurra.llm.wordhash import PIECE, hash_words, pieces

SAMPLE = 8000
PATH_STRENGTH = 20.0
#: What a site can move a document's log-odds at most.
SITE_LIMIT = 2.0
#: Sites whose posteriors are broadcast at most; more are joined by shuffle.
BROADCAST_SITES = 20_000

FEATURES = ("symbols", "bars", "exclamations", "capitals", "digits", "white", "same word", "same line", "length", "words")
#: Weights before any label is seen; last: intercept.
PRIOR = np.array([-2.0, -2.0, -2.0, -1.0, -0.5, 0.0, -2.0, -1.0, 0.0, 1.0, 2.0])
BUCKET_BITS = 16
SEEN = 4.0  # texts that a bucket's rates are drawn to the common one by

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#$%&*+=<>@^_~\\{}[]")] = True


def buckets(raw: bytes) -> np.ndarray:
    """The distinct buckets of a text's words, in lower case; of long texts piece by piece."""
    found = [hash_words(part)[0] >> np.uint64(64 - BUCKET_BITS) for part in pieces(raw.lower())]
    return np.unique(np.concatenate(found)).astype(np.int64) if found else np.zeros(0, np.int64)


def word_means(texts: list[str], odds: np.ndarray) -> np.ndarray:
    """The mean log-odds of each text's words, 0 without any; hashed for many texts at once."""
    out, lowered = np.zeros(len(texts)), [t.encode("utf-8", "surrogatepass").lower() for t in texts]
    i = 0
    while i < len(lowered):
        j, size = i, 0
        while j < len(lowered) and (j == i or size + len(lowered[j]) < PIECE):
            size += len(lowered[j]) + 1
            j += 1
        total, count = np.zeros(j - i), np.zeros(j - i)
        ends = np.cumsum([len(x) + 1 for x in lowered[i:j]])
        for part in pieces(lowered[i]) if j == i + 1 else [b"\n".join(lowered[i:j])]:
            hashes, starts = hash_words(part)
            owner = np.searchsorted(ends, starts, side="right") if j > i + 1 else np.zeros(len(starts), np.int64)
            total += np.bincount(owner, odds[(hashes >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)], j - i)
            count += np.bincount(owner, minlength=j - i)
        out[i:j] = total / np.maximum(count, 1)
        i = j
    return out


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(bucket, good, bad): in how many texts of a partition a bucket is."""
    counts = np.zeros((2, 1 << BUCKET_BITS), np.int64)
    for batch in batches:
        for text, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            counts[0 if y else 1, buckets(text.encode("utf-8", "surrogatepass"))] += 1
    at = np.flatnonzero(counts.any(axis=0))
    yield pa.record_batch([pa.array(at, pa.int32()), *(pa.array(counts[k, at], pa.int64()) for k in (0, 1))],
                          names=["bucket", "good", "bad"])


def word_odds(sample: DataFrame) -> np.ndarray:
    """Log-odds of each bucket; a row per bucket at most reaches the driver."""
    totals = {r["y"]: r["n"] for r in sample.groupBy("y").agg(F.count("*").alias("n")).collect()}
    good, bad = totals.get(1, 0), totals.get(0, 0)
    out = np.zeros(1 << BUCKET_BITS, np.float32)
    if not good or not bad:
        return out
    counted = sample.select("text", "y").mapInArrow(_count_words, "bucket int, good long, bad long")
    for r in counted.groupBy("bucket").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad")).collect():
        rate = (r["good"] + r["bad"]) / (good + bad)
        out[r["bucket"]] = np.log((r["good"] + SEEN * rate) / (good + SEEN)) - np.log((r["bad"] + SEEN * rate) / (bad + SEEN))
    return out


def measure(text: str) -> list[float]:
    """The measures of one whole text's form."""
    raw = text.encode("utf-8", "surrogatepass")
    n = max(1, len(raw))
    by = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    letters = max(1, int(by[65:91].sum() + by[97:123].sum() + by[128:].sum()))
    words, lines = raw.split(), [x for x in raw.split(b"\n") if x.strip()]
    repeats = sum(map(eq, words, words[1:])) / max(1, len(words))
    lines_again = (len(lines) - len(Counter(lines))) / max(1, len(lines))
    share = np.array([by[_SYMBOL].sum() / n, by[ord("|")] / n, by[ord("!")] / n, by[65:91].sum() / letters,
                      by[48:58].sum() / n, (by[32] + by[9:14].sum()) / n, repeats, lines_again])
    return [*np.sqrt(share).tolist(), float(np.log10(n))]


def features(texts: list[str], odds: np.ndarray) -> np.ndarray:
    """The classifier's features of whole texts, a row each."""
    form = np.array([measure(t) for t in texts]).reshape(len(texts), len(FEATURES) - 1)
    return np.concatenate([form, word_means(texts, odds)[:, None]], axis=1)


def learn(docs: DataFrame, labels: DataFrame, bound: int = SAMPLE) -> tuple[np.ndarray, np.ndarray]:
    """Weights of the classifier and log-odds of words; without labels, the prior and zeros."""
    sample = sample_texts(docs, labels, "quality", bound)
    odds = [word_odds(sample.where(F.col("half") == k)) for k in (0, 1)]

    @F.pandas_udf("array<double>")
    def crossed(text: pd.Series, half: pd.Series) -> pd.Series:
        both = [features(text.tolist(), odds[1 - k]) for k in (0, 1)]  # words by what the other half says
        return pd.Series([both[h][i].tolist() for i, h in enumerate(half)])

    rows = sample.select("y", crossed("text", "half").alias("x")).collect()  # the bounded sample
    rows.sort(key=lambda r: (r["y"], r["x"]))
    x = np.array([r["x"] for r in rows]).reshape(len(rows), len(FEATURES))
    weights = logistic.fit(x, np.array([r["y"] for r in rows], float), PRIOR, 0.05)
    return weights, (odds[0] + odds[1]) / 2


def beta_prior(hosts: DataFrame) -> tuple[float, float]:
    """Beta parameters by moments over hosts (n, s), each weighed by its documents."""
    r = hosts.agg(
        F.sum("n").alias("n"), F.sum("s").alias("s"), F.count("*").alias("k"),
        F.sum(F.col("s") * F.col("s") / F.col("n")).alias("q"), F.sum(F.col("n") * F.col("n")).alias("nn"),
    ).first()
    if not r["n"]:
        return 1.0, 1.0
    n, mean = float(r["n"]), min(max(float(r["s"]) / float(r["n"]), 1e-6), 1 - 1e-6)
    between = max(float(r["q"]) - n * mean * mean, 0.0)  # sum of n (rate - mean)^2
    spread = n - float(r["nn"]) / n
    variance = (between - (r["k"] - 1) * mean * (1 - mean)) / spread if spread > 0 else 0.0
    strength = mean * (1 - mean) / variance - 1 if variance > 1e-9 else 1000.0
    strength = min(max(strength, 1.0), 1000.0)
    return mean * strength, (1 - mean) * strength


def _scored(docs: DataFrame, labels: DataFrame, host: str, path: str, bound: int) -> tuple[DataFrame, list[str]]:
    """Positional columns of ``docs`` with the evidence, posteriors and score; the positional names."""
    prepare(docs.sparkSession)
    weights, odds = learn(docs, labels, bound)

    @F.pandas_udf("double")
    def evidence(text: pd.Series) -> pd.Series:
        x = features([t or "" for t in text], odds)
        return pd.Series(np.clip(x @ weights[:-1] + weights[-1], -20, 20))

    rows = positional(docs)
    names = rows.columns
    h, p, text = (F.col(f"c{place_of(docs, c)}").cast("string") for c in (host, path, "text"))
    rows = rows.withColumn("evidence", evidence(text)).withColumn("host", h).withColumn("path", p)
    good = 1 / (1 + F.exp(-F.col("evidence")))
    paths = cut(rows.groupBy(F.col("host").alias("h"), F.col("path").alias("p")).agg(
        F.count("*").cast("double").alias("n"), F.sum(good).alias("s")))
    hosts = paths.groupBy("h").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    a, b = beta_prior(hosts)
    rates = hosts.select(F.col("h").alias("hh"), ((F.col("s") + a) / (F.col("n") + a + b)).alias("host_posterior"))
    sites = cut(paths.join(rates, F.col("h").eqNullSafe(F.col("hh"))).drop("hh"))
    few = sites.limit(BROADCAST_SITES + 1).count() <= BROADCAST_SITES
    on = F.col("host").eqNullSafe(F.col("h")) & F.col("path").eqNullSafe(F.col("p"))
    joined = rows.join(F.broadcast(sites) if few else sites, on)
    others = F.greatest(F.col("s") - good, F.lit(0.0)) + PATH_STRENGTH * F.col("host_posterior")
    rate = others / (F.col("n") - 1 + PATH_STRENGTH)
    rate = F.greatest(F.least(rate, F.lit(1 - 1e-6)), F.lit(1e-6))
    shift = F.log(rate / (1 - rate)) - float(np.log(a / b))
    shift = F.greatest(F.least(shift, F.lit(SITE_LIMIT)), F.lit(-SITE_LIMIT))
    scored = joined.withColumn("path_posterior", rate)
    return scored.withColumn("score", 1 / (1 + F.exp(-(F.col("evidence") + shift)))), names


def score(
    docs: DataFrame, labels: DataFrame, host: str = "source", path: str = "lang", bound: int = SAMPLE
) -> DataFrame:
    """(doc_id, host, path, evidence, host_posterior, path_posterior, score) of every row.

    Defined cases: null and empty texts have the evidence of their form; a null
    host or path is a site of its own; equal texts have equal evidence, equal
    rows each give a row; without labels the prior weights hold; an empty table
    gives no rows; extra columns are left out.
    """
    scored, _ = _scored(docs, labels, host, path, bound)
    doc_id = F.col(f"c{place_of(docs, 'doc_id')}").cast("long").alias("doc_id")
    return scored.select(doc_id, "host", "path", "evidence", "host_posterior", "path_posterior", "score")


def only_good(
    docs: DataFrame, labels: DataFrame, limit: float, host: str = "source", path: str = "lang", bound: int = SAMPLE
) -> DataFrame:
    """The rows of ``docs`` that score ``limit`` or more, all columns as they are; cases as for :func:`score`."""
    scored, names = _scored(docs, labels, host, path, bound)
    return scored.where(F.col("score") >= limit).select(*names).toDF(*docs.columns)

"""Language identification by hyperdimensional profiles.

Every letter has a random vector of +1 and -1, drawn from its code point.  An
n-gram's vector binds its letters': each is rotated by its place and they are
multiplied.  A text's n-gram vectors are bundled, that is summed with their
counts, and so are the texts of a language into its prototype.  A text has the
language whose prototype is nearest by cosine, once what all languages have in
common, the mean of the prototypes, is taken off both.

Words are taken apart, with a blank on either side, so short ones have n-grams, too.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from occurra.llm.common import cut, pick, prepare, texts

DIMS = 2048
N = 3  # letters of an n-gram
SHARPNESS = 12.0  # of the score, the winner's share of exp(SHARPNESS * cosine)
LETTERS = 4096  # letter vectors a worker remembers
GRAMS = 4096  # n-gram vectors made at once
CELLS = 1 << 22  # counts (texts x n-grams) held at once
LONG = 1 << 21  # code points of a text looked at at once
LAST = 0x10FFFF + 1
BLANK = 0x20
UNKNOWN = "und"


@functools.lru_cache(maxsize=LETTERS)
def letter(code: int) -> np.ndarray:
    return np.random.default_rng([20240611, code]).integers(0, 2, DIMS, np.int8) * np.int8(2) - np.int8(1)


def gram_vectors(grams: np.ndarray) -> np.ndarray:
    """The vectors of n-grams (rows of N code points): the product of their rotated letters."""
    out = np.ones((len(grams), DIMS), np.int8)
    for place in range(N):
        codes, at = np.unique(grams[:, place], return_inverse=True)
        out *= np.roll(np.stack([letter(int(c)) for c in codes]), place, axis=1)[at]
    return out.astype(np.float32)


_letter_table = np.zeros(0, bool)


def letters() -> np.ndarray:
    """Whether each code point is a letter."""
    global _letter_table
    if not len(_letter_table):
        _letter_table = np.fromiter((chr(c).isalpha() for c in range(LAST)), bool, LAST)
    return _letter_table


def grams_of(text: str) -> np.ndarray:
    """The packed n-grams of a text, in lower case; none without a letter."""
    code = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    code = np.where(letters()[code], code, BLANK)
    code = np.concatenate([[BLANK], code, [BLANK]])
    code = code[np.concatenate([[True], (code[1:] != BLANK) | (code[:-1] != BLANK)])]  # blanks as one
    if len(code) < N:
        return np.zeros(0, np.int64)
    out = code[: len(code) - N + 1].copy()
    inner = np.ones(len(out), bool)
    for k in range(1, N):
        part = code[k : len(code) - N + 1 + k]
        out = out * LAST + part
        if k < N - 1:
            inner &= part != BLANK
    return out[inner]


def counts_of(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct packed n-grams of a text and their counts; long texts piece by piece."""
    text = text or ""
    if len(text) <= LONG:
        return np.unique(grams_of(text), return_counts=True)
    total: dict[int, int] = {}
    at = 0
    while at < len(text):
        end = min(len(text), at + LONG)
        while end < len(text) and text[end - 1].isalpha():
            end += 1  # to the end of a word
        for g, n in zip(*(x.tolist() for x in np.unique(grams_of(text[at:end]), return_counts=True))):
            total[g] = total.get(g, 0) + n
        at = end
    g = np.array(sorted(total), np.int64)
    return g, np.array([total[k] for k in g.tolist()], np.int64)


def unpack(grams: np.ndarray) -> np.ndarray:
    cols = []
    for _ in range(N):
        grams, low = np.divmod(grams, LAST)
        cols.append(low)
    return np.stack(cols[::-1], axis=1)


def bundle(counted: list[tuple[np.ndarray, np.ndarray]], weights: np.ndarray | None = None) -> np.ndarray:
    """The texts' bundles, a row each; with ``weights`` (rows x texts) weighted sums of them.

    N-gram vectors are made for all texts together, ``GRAMS`` at a time.
    """
    everything, at = np.unique(np.concatenate([g for g, _ in counted]), return_inverse=True)
    sizes = [len(g) for g, _ in counted]
    owner = np.repeat(np.arange(len(counted)), sizes)
    n = np.concatenate([c for _, c in counted]).astype(np.float32)
    order = np.argsort(at, kind="stable")
    at, owner, n = at[order], owner[order], n[order]
    out = np.zeros((len(counted) if weights is None else len(weights), DIMS), np.float32)
    step = max(1, min(GRAMS, CELLS // max(1, len(counted))))
    for lo in range(0, len(everything), step):
        part = everything[lo : lo + step]
        i, j = np.searchsorted(at, [lo, lo + len(part)])
        cells = np.zeros((len(counted), len(part)), np.float32)
        cells[owner[i:j], at[i:j] - lo] = n[i:j]
        out += (cells if weights is None else weights @ cells) @ gram_vectors(unpack(part))
    return out


def learns(doc_id: Column) -> Column:
    """Rows whose language may be learned from; never those without an id."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(5)) != 0, F.lit(False))


def _profiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, profile) of a partition: the sum of its texts' bundles, each divided by its n-grams."""
    sums: dict[str, np.ndarray] = {}
    for batch in batches:
        rows = [(v, counts_of(t)) for t, v in zip(*(batch.column(k).to_pylist() for k in range(2)))]
        rows = [r for r in rows if len(r[1][0])]
        if not rows:
            continue
        names = sorted({v for v, _ in rows})
        place = {v: k for k, v in enumerate(names)}
        weights = np.zeros((len(names), len(rows)), np.float32)
        for k, (v, (_, n)) in enumerate(rows):
            weights[place[v], k] = 1 / n.sum()
        for v, total in zip(names, bundle([c for _, c in rows], weights).astype(np.float64)):
            sums[v] = sums[v] + total if v in sums else total
    yield _vectors(sums)


def _vectors(sums: dict[str, np.ndarray]) -> pa.RecordBatch:
    return pa.record_batch([pa.array(list(sums), pa.string()), pa.array([v.tobytes() for v in sums.values()], pa.binary())],
                           names=["lang", "profile"])


def _add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[str, np.ndarray] = {}
    for batch in batches:
        for v, raw in zip(*(batch.column(k).to_pylist() for k in range(2))):
            sums[v] = sums[v] + np.frombuffer(raw) if v in sums else np.frombuffer(raw)
    yield _vectors(sums)


def prototypes(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> dict[str, np.ndarray]:
    """The profile of every language, from all rows that may be learned from, at length one.

    A row per task and language is shuffled, a row per language reaches the
    driver.
    """
    prepare(docs.sparkSession)
    rows = pick(docs, doc_id=key, text=text, lang=lang).select(
        F.col("text").cast("string"), F.col("lang").cast("string"), learns(F.col("doc_id").cast("long")).alias("learns")
    )
    known = rows.where("learns and text is not null and lang is not null").select("text", "lang")
    parts = known.mapInArrow(_profiles, "lang string, profile binary")
    sums = parts.repartition(16, "lang", F.pmod(F.spark_partition_id(), F.lit(16))).mapInArrow(_add, parts.schema)
    sums = sums.repartition(8, "lang").mapInArrow(_add, parts.schema)
    found = {r["lang"]: np.frombuffer(r["profile"]) for r in sums.collect()}
    return {v: found[v] / np.linalg.norm(found[v]) for v in sorted(found) if found[v].any()}


def classifier(known: dict[str, np.ndarray]):
    """A function from texts to their languages and scores."""
    names = list(known)
    table = np.stack([known[v] for v in names]) if names else np.zeros((0, DIMS))
    common = table.mean(axis=0) if len(names) > 1 else np.zeros(DIMS)
    table = table - common
    length = np.linalg.norm(table, axis=1, keepdims=True)
    table = table / np.where(length > 0, length, 1)

    def answer(said: list[str | None]) -> tuple[list[str], np.ndarray]:
        counted = [counts_of(t) for t in said]
        at = [k for k, (g, _) in enumerate(counted) if len(g)]
        pred, score = [UNKNOWN] * len(said), np.zeros(len(said))
        if names and at:
            got = bundle([counted[k] for k in at]).astype(np.float64)
            got /= np.maximum(np.linalg.norm(got, axis=1, keepdims=True), 1e-30)
            got -= common
            got /= np.maximum(np.linalg.norm(got, axis=1, keepdims=True), 1e-30)
            cosine = got @ table.T
            best = cosine.argmax(axis=1)  # ties: the first name
            share = np.exp(SHARPNESS * (cosine - cosine.max(axis=1, keepdims=True)))
            score[at] = 1 / share.sum(axis=1)
            for k, b in zip(at, best):
                pred[k] = names[b]
        return pred, score

    return answer


def predict(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """(doc_id, held_out, lang_pred, score) for every row of ``docs``.

    Rows whose crc32 of the id modulo 5 is 0 are held out: nothing is learned
    from them.  The score is the winner's share among the languages.

    Defined cases: null texts and texts without a letter give ``und`` and 0, as
    does everything if no language can be learned; a null id is not held out and
    not learned from; rows without a language are predicted only; equal rows
    each give a row, equal texts the same language; texts of any length are
    taken whole; an empty table gives no rows; extra columns are left out.
    """
    answer = classifier(prototypes(docs, key, text, lang))

    @F.pandas_udf("lang_pred string, score double")
    def model(text: pd.Series) -> pd.DataFrame:
        pred, score = answer(text.tolist())
        return pd.DataFrame({"lang_pred": pred, "score": score})

    rows = texts(docs, key, text).select("doc_id", model(F.col("text")).alias("got"))
    held = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))
    return rows.select("doc_id", held.alias("held_out"), "got.lang_pred", "got.score")

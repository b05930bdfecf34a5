"""BPE with a lexicon of frequent words in a minimal acyclic transducer.

Words are counted over the whole corpus; the most frequent ones (a fixed,
documented number) are compiled into an acyclic automaton with shared prefixes
and suffixes.  Each transition holds how many words lie before it, so a path
gives a word's number and, by it, its ids.  The automaton is a file of flat
arrays that Spark ships to every executor and each worker maps into memory; a
batch's words walk it together.  All other words are merged by the tokenizers
library's own BPE model, so the ids don't depend on the lexicon.
"""

from __future__ import annotations

import functools
import hashlib
import json
import os
import re
import tempfile
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from occurra.llm.common import cut, prepare, texts
from occurra.llm.tokens import byte_chars, default_path

#: Words in the lexicon; bounds what the driver compiles and every worker maps.
LEXICON_WORDS = 50_000
#: Longer words are not in the lexicon.
LONGEST = 48
#: Distinct words a worker remembers.
REMEMBERED = 300_000

# up to U+017F lower case stays among the characters whose classes are listed here
_PLAIN = re.compile(r"[\x00-\u017f]*\Z")


def _classes() -> tuple[str, str]:
    import unicodedata

    kinds = {"L": [], "N": []}
    for c in map(chr, range(0x250)):
        if unicodedata.category(c)[0] in kinds:
            kinds[unicodedata.category(c)[0]].append(re.escape(c))
    return "".join(kinds["L"]), "".join(kinds["N"])


@functools.cache
def _pattern() -> re.Pattern:
    letters, digits = _classes()
    space = r"\t-\r \x85\xa0"
    return re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{letters}]+|[{digits}]|[^{space}{letters}{digits}]+")


class WordBPE:
    """The word-end BPE file: split, ids of a word, decoding."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.lib = Tokenizer.from_file(path)
        self.lib.no_truncation()
        self.lib.no_padding()
        spec = json.load(open(path, encoding="utf-8"))
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.cut = re.compile("(" + "|".join(map(re.escape, self.specials)) + ")")
        back = byte_chars()
        self.to_char = {b: c for c, b in back.items()}
        self.back = back
        size = self.lib.get_vocab_size(with_added_tokens=True)
        self.token = [(self.lib.id_to_token(i) or "").encode() for i in range(size)]

    def split(self, text: str) -> Iterator[tuple[str | None, list[str]]]:
        """Parts of the text: a special string, or the words between."""
        for part in self.cut.split(text) if "<|" in text else [text]:
            if part in self.specials:
                yield part, []
            elif part:
                yield None, self.words(part)

    def words(self, text: str) -> list[str]:
        if _PLAIN.match(text):  # composed already, and lower-cased alike
            return _pattern().findall(text.lower())
        clean = self.lib.normalizer.normalize_str(text)
        parts = self.lib.pre_tokenizer.pre_tokenize_str(clean)
        return [bytes(map(self.back.__getitem__, w)).decode() for w, _ in parts]

    def merge(self, word: str) -> bytes:
        """Ids of one word, merged exactly."""
        chars = word if word.isascii() and word.isprintable() else "".join(map(self.to_char.__getitem__, word.encode()))
        return np.array([t.id for t in self.lib.model.tokenize(chars)], "<u4").tobytes()

    def decode(self, ids: bytes) -> bytes:
        return b" ".join(map(self.token.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@functools.cache
def word_bpe(path: str) -> WordBPE:
    return WordBPE(path)


def compile_words(words: dict[bytes, bytes]) -> dict[str, np.ndarray]:
    """Flat arrays of the minimal acyclic transducer of ``words`` -> ids.

    Words are added in byte order; a state that can't change any more is
    replaced by an equal one if there is one, so suffixes are shared.
    """
    register: dict[tuple, int] = {}
    arcs: list[dict[int, int]] = []  # of finished states
    final: list[bool] = []
    path: list[tuple[dict[int, int], list[bool]]] = [({}, [False])]

    def freeze(state) -> int:
        sig = (state[1][0], tuple(state[0].items()))
        if sig not in register:
            register[sig] = len(arcs)
            arcs.append(state[0])
            final.append(state[1][0])
        return register[sig]

    last = b""
    ordered = sorted(w for w in words if 0 < len(w) <= LONGEST)
    for word in ordered:
        same = 0
        while same < min(len(last), len(word)) and last[same] == word[same]:
            same += 1
        for i in range(len(last), same, -1):
            done = freeze(path.pop())
            path[-1][0][last[i - 1]] = done
        for b in word[same:]:
            path[-1][0][b] = -1
            path.append(({}, [False]))
        path[-1][1][0] = True
        last = word
    for i in range(len(last), 0, -1):
        done = freeze(path.pop())
        path[-1][0][last[i - 1]] = done
    root = freeze(path.pop())

    below = [0] * len(arcs)  # words that end at or after a state; finished states come after theirs
    for s, out in enumerate(arcs):
        below[s] = final[s] + sum(below[t] for t in out.values())
    rows = []
    for s, out in enumerate(arcs):
        skip = int(final[s])
        for b, t in sorted(out.items()):
            rows.append((s << 8 | b, t, skip))
            skip += below[t]
    rows.sort()
    ids = [words[w] for w in ordered]
    return {
        "arc": np.array([r[0] for r in rows], np.uint32),
        "to": np.array([r[1] for r in rows], np.uint32),
        "skip": np.array([r[2] for r in rows], np.uint32),
        "final": np.array(final, np.uint8),
        "at": np.concatenate([[0], np.cumsum([len(i) // 4 for i in ids])]).astype(np.uint32),
        "ids": np.frombuffer(b"".join(ids), "<u4").astype(np.uint32),
        "root": np.array([root], np.uint32),
    }


class Lexicon:
    """The transducer's file, mapped into memory."""

    def __init__(self, file: str) -> None:
        with open(file, "rb") as f:
            head = json.loads(f.readline())
            base = f.tell()
        for name, kind, at, n in head:
            part = np.asarray(np.memmap(file, kind, "r", base + at, (n,))) if n else np.zeros(0, kind)
            setattr(self, name, part)

    @staticmethod
    def write(arrays: dict[str, np.ndarray], file: str) -> None:
        head, at, blocks = [], 0, []
        for name, arr in arrays.items():
            raw = arr.tobytes()
            head.append((name, str(arr.dtype), at, len(arr)))
            raw += b"\0" * (-len(raw) % 8)
            at += len(raw)
            blocks.append(raw)
        line = json.dumps(head).encode()
        line += b" " * (-(len(line) + 1) % 8) + b"\n"
        with open(file, "wb") as f:
            f.write(line + b"".join(blocks))

    def find(self, words: list[bytes]) -> list[bytes | None]:
        """Ids of each word, or None; all words walk the automaton together."""
        found: list[bytes | None] = [None] * len(words)
        if not len(self.arc) or not words:
            return found
        state = np.full(len(words), self.root[0], np.uint32)
        count = np.zeros(len(words), np.int64)
        lengths = np.array([len(w) for w in words])
        width = min(LONGEST, int(lengths.max()))
        grid = np.frombuffer(b"".join(w[:width].ljust(width, b"\0") for w in words), np.uint8)
        grid = grid.reshape(len(words), width)
        live = np.flatnonzero((lengths > 0) & (lengths <= LONGEST))
        ends = []
        for i in range(width + 1):
            over = lengths[live] == i
            ends.append(live[over])
            live = live[~over]
            if not len(live):
                break
            keys = state[live] << np.uint32(8) | grid[live, i]
            at = np.minimum(np.searchsorted(self.arc, keys), len(self.arc) - 1)
            hit = self.arc[at] == keys
            live, at = live[hit], at[hit]
            state[live] = self.to[at]
            count[live] += self.skip[at]
        done = np.concatenate(ends)
        done = done[self.final[state[done]] == 1]
        for w, k in zip(done.tolist(), count[done].tolist()):
            found[w] = self.ids[self.at[k] : self.at[k + 1]].tobytes()
        return found


@functools.lru_cache(maxsize=1)
def _lexicon(name: str) -> Lexicon:
    return Lexicon(SparkFiles.get(name))


def word_counts(docs: DataFrame, path: str) -> DataFrame:
    """(word string, n long) over all texts of ``docs`` (doc_id, text)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, seen = word_bpe(path), Counter()

        def out():
            return pa.record_batch(
                [pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], names=["word", "n"]
            )

        for batch in batches:
            for text in batch.column(0).to_pylist():
                for _, words in bpe.split(text or ""):
                    seen.update(words)
            if len(seen) > REMEMBERED:
                yield out()
                seen = Counter()
        yield out()

    return docs.select("text").mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def fit_lexicon(docs: DataFrame, path: str, words: int = LEXICON_WORDS) -> str:
    """Compile the most frequent words, ``words`` at most; returns the shipped file's name."""
    spark: SparkSession = docs.sparkSession
    # words by how often they are met, in steps of a sixteenth of a doubling; the most frequent steps that fit
    counts = word_counts(docs, path).where((F.octet_length("word") <= LONGEST) & (F.col("n") > 1))
    counts = cut(counts.withColumn("step", F.floor(F.log2("n") * 16)))
    least, total = None, 0
    for r in sorted(counts.groupBy("step").count().collect(), key=lambda r: -r["step"]):
        total += r["count"]
        if total > words:
            break
        least = r["step"]
    top = [] if least is None else counts.where(F.col("step") >= least).select("word").collect()
    bpe = word_bpe(path)
    arrays = compile_words({r[0].encode(): bpe.merge(r[0]) for r in top})
    folder = tempfile.mkdtemp(prefix="lexicon-")
    draft = os.path.join(folder, "draft")
    Lexicon.write(arrays, draft)
    digest = hashlib.sha256(open(draft, "rb").read()).hexdigest()[:20]
    name = f"lexicon-{digest}.bin"
    if not any(f.endswith(name) for f in spark.sparkContext.listFiles):
        os.rename(draft, os.path.join(folder, name))
        spark.sparkContext.addFile(os.path.join(folder, name))
    return name


class Encoder:
    """Words' ids, remembered up to a bound; new words by automaton, else merged."""

    def __init__(self, path: str, lexicon: str | None) -> None:
        self.bpe, self.lexicon = word_bpe(path), lexicon
        self.known: dict[str, bytes] = {}

    def learn(self, words: set[str]) -> None:
        new = list(words - self.known.keys())
        if len(self.known) + len(new) > REMEMBERED:
            self.known, new = {}, list(words)
        hits = _lexicon(self.lexicon).find([w.encode() for w in new]) if self.lexicon else [None] * len(new)
        for w, ids in zip(new, hits):
            self.known[w] = self.bpe.merge(w) if ids is None else ids

    def encode(self, batch: list[str]) -> Iterator[bytes]:
        parts = [list(self.bpe.split(t)) for t in batch]
        self.learn(set().union(*(words for p in parts for _, words in p)))
        get = self.known.__getitem__
        for p in parts:
            yield b"".join(
                np.array([self.bpe.specials[s]], "<u4").tobytes() if s else b"".join(map(get, words))
                for s, words in p
            )


@functools.lru_cache(maxsize=1)
def _encoder(path: str, lexicon: str | None) -> Encoder:
    return Encoder(path, lexicon)


def encode(docs: DataFrame, tokenizer: str | None = None, words: int = LEXICON_WORDS) -> DataFrame:
    """(doc_id, ids binary): little-endian unsigned 32-bit ids of every whole text.

    Ids are those of the tokenizers library without added special tokens;
    special strings in a text give their ids, as in the library.

    Defined cases: a null or empty text has no ids; a null doc_id stays null;
    equal rows each give a row; an empty table gives no rows; texts of any
    length are encoded whole; extra columns are left out.
    """
    spark = docs.sparkSession
    prepare(spark)
    path = tokenizer or default_path("word_bpe_49k.json")
    rows = texts(docs)
    lexicon = fit_lexicon(rows, path, words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = _encoder(path, lexicon)
        for batch in batches:
            got = list(enc.encode([t or "" for t in batch.column(1).to_pylist()]))
            yield pa.record_batch([batch.column(0), pa.array(got, pa.binary())], names=["doc_id", "ids"])

    return rows.mapInArrow(run, "doc_id long, ids binary")


def decode(encoded: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """``encoded`` (doc_id, ids) with the decoded ``text``, special tokens kept."""
    path = tokenizer or default_path("word_bpe_49k.json")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = word_bpe(path)
        for batch in batches:
            got = [bpe.decode(i or b"").decode("utf-8", "replace") for i in batch.column(1).to_pylist()]
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(got, pa.string())],
                                  names=["doc_id", "ids", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids binary, text string")

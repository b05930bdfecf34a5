"""Document fingerprints: a Merkle tree over paragraphs and sections.

A paragraph is a line, and within long lines a run of words that ends after a
word whose hash says so (one in ``WORDS_PER_LEAF``); a run of more than
``LONG_RUN`` bytes without white space (as in Chinese or base64) is also cut
inside, where the bytes before a character say so; a section is a run of
paragraphs that ends after one whose hash says so.  As cuts follow content, an
edit changes the paragraphs it touches and leaves the cuts elsewhere.  A leaf is
the hash of a paragraph's bytes, a section's digest is taken over its leaves,
and the root over the sections.

The fingerprint is a string that holds the tree: the root, then each section's
digest with its leaves.  Equal roots are equal texts; else the sections are
aligned in order, and only leaves between the aligned ones are looked at.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from occurra.llm.common import mix64, prepare, texts
from occurra.llm.wordhash import PIECE, SPACE, Ranges, pieces

WORDS_PER_LEAF = 4
LONG_RUN = 64
CHARS_PER_LEAF = 16
LEAST, MOST = 16, 128  # bytes between the cuts in a run
LEAVES_PER_SECTION = 32
LEAF_HEX = 16
SECTION_HEX = 16
HELD = 1 << 28  # bits of an alignment's table held at once; larger ones are halved at the best place


def _cuts(arr: np.ndarray) -> list[int]:
    """Where to cut a run of bytes without white space.

    By a hash of the eight bytes before a character, ``LEAST`` to ``MOST``
    bytes apart (from cut to cut, so constant runs are cut evenly).
    """
    spots = []
    for a in range(8, len(arr), 1 << 16):
        b = min(a + (1 << 16), len(arr))
        head = np.lib.stride_tricks.sliding_window_view(arr[a - 8 : b - 1], 8).copy().view("<u8").ravel()
        spots.append(np.flatnonzero((mix64(head) % np.uint64(CHARS_PER_LEAF) == 0) & (arr[a:b] & 0xC0 != 0x80)) + a)
    spots = np.concatenate(spots) if spots else np.zeros(0, np.int64)
    out, at = [], 0
    while len(arr) - at > LEAST:
        k = int(np.searchsorted(spots, at + LEAST))
        end = int(spots[k]) if k < len(spots) else len(arr)
        if end > at + MOST:
            end = at + MOST
            while end > at + LEAST and arr[end] & 0xC0 == 0x80:
                end -= 1
        if end >= len(arr):
            break
        out.append(end)
        at = end
    return out


def _leaves(raws: list[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Leaf hashes of each of some byte strings, and the bytes before each leaf."""
    raw = b"".join(raws)
    ends_at = np.cumsum([len(r) for r in raws])
    starts_at = np.concatenate([[0], ends_at[:-1]]).astype(np.int64)
    if not raw:
        return [(np.zeros(0, np.uint64), np.zeros(0, np.int64)) for _ in raws]
    ranges = Ranges(raw)
    gap = SPACE[ranges.arr]
    edge = np.zeros(len(raw) + 1, bool)
    edge[starts_at] = edge[ends_at] = True
    before, after = np.concatenate([[True], gap[:-1]]), np.concatenate([gap[1:], [True]])
    first = np.flatnonzero(~gap & (before | edge[:-1]))
    last = np.flatnonzero(~gap & (after | edge[1:])) + 1
    lines = np.concatenate([[0], np.cumsum(ranges.arr == 10)])
    cut = ranges.hash(first, last)[:-1] % np.uint64(WORDS_PER_LEAF) == 0
    cut |= lines[first[1:]] > lines[last[:-1]]
    full = starts_at[ends_at > starts_at]
    begin = np.union1d(full, first[1:][cut]).astype(np.int64)
    # white space before a document's first word belongs to its first leaf
    lead = first[np.minimum(np.searchsorted(first, full), len(first) - 1)] if len(first) else full[:0]
    begin = np.setdiff1d(begin, np.setdiff1d(lead, full)) if len(first) else begin
    long = np.flatnonzero(last - first > LONG_RUN)
    if len(long):
        inside = [c + a for a, b in zip(first[long].tolist(), last[long].tolist()) for c in _cuts(ranges.arr[a:b])]
        begin = np.union1d(begin, np.array(inside, np.int64)).astype(np.int64)
    finish = np.concatenate([begin[1:], [len(raw)]])
    hashes = ranges.hash(begin, finish)
    at = np.searchsorted(begin, np.concatenate([starts_at, [len(raw)]]))
    own = [slice(at[i], at[i + 1] if ends_at[i] > starts_at[i] else at[i]) for i in range(len(raws))]
    return [(hashes[o], begin[o] - a) for o, a in zip(own, starts_at)]


def _tree(leaves: np.ndarray) -> str:
    """The fingerprint of a text with these leaves."""
    root, parts = hashlib.blake2b(digest_size=16), []
    if len(leaves):
        ends = np.flatnonzero((leaves >> np.uint64(40)) % np.uint64(LEAVES_PER_SECTION) == 0) + 1
        ends = ends[ends < len(leaves)].tolist()
        words = leaves.astype("<u8").tobytes()
        brief = leaves.astype(">u8").tobytes().hex()
        for a, b in zip([0, *ends], [*ends, len(leaves)]):
            digest = hashlib.blake2b(words[8 * a : 8 * b], digest_size=SECTION_HEX // 2).hexdigest()
            root.update(bytes.fromhex(digest))
            parts.append(digest + brief[LEAF_HEX * a : LEAF_HEX * b])
    return root.hexdigest() + "/" + ".".join(parts)


def fingerprints(values: list[str]) -> list[str]:
    """The fingerprint of each text."""
    return [f for f, _ in trees(values)]


def trees(values: list[str]) -> list[tuple[str, np.ndarray]]:
    """The fingerprint of each text, and the bytes of UTF-8 before each leaf."""
    raws = [v.encode("utf-8", "surrogatepass") for v in values]
    out: list[tuple[str, np.ndarray]] = []
    i = 0
    while i < len(raws):
        j, size = i, 0
        while j < len(raws) and (j == i or size + len(raws[j]) <= PIECE):
            size += len(raws[j])
            j += 1
        if size > PIECE:
            cut = pieces(raws[i])
            before = accumulate(map(len, cut), initial=0)
            got = [(h, s + n) for n, p in zip(before, cut) for h, s in _leaves([p])]
            hashes, starts = map(np.concatenate, zip(*got))
            out.append((_tree(hashes), starts))
        else:
            out += [(_tree(h), s) for h, s in _leaves(raws[i:j])]
        i = j
    return out


def sections(fingerprint: str) -> list[tuple[str, list[str]]]:
    """(digest, leaves) of each section."""
    body = fingerprint.partition("/")[2]
    return [
        (s[:SECTION_HEX], [s[k : k + LEAF_HEX] for k in range(SECTION_HEX, len(s), LEAF_HEX)])
        for s in body.split(".") if s
    ]


def likeness(a: str, b: str) -> float:
    """Share of the two trees' leaves that both have, 0 to 1; 1 for equal roots.

    Leaves of sections that both have aren't compared.  A fingerprint without
    leaves (empty text) is like no other.
    """
    if a == b:
        return 1.0
    left, right = a.partition("/")[2].split("."), b.partition("/")[2].split(".")
    count = lambda parts: sum((len(s) - SECTION_HEX) // LEAF_HEX for s in parts if s)
    total = count(left) + count(right)
    both = Counter(left) & Counter(right)
    both.pop("", None)
    shared = sum((len(s) - SECTION_HEX) // LEAF_HEX * k for s, k in both.items())

    def rest(parts: list[str]) -> Counter:
        spare, out = Counter(both), Counter()
        for s in parts:
            if spare[s] > 0:
                spare[s] -= 1
            else:
                out.update([s[k : k + LEAF_HEX] for k in range(SECTION_HEX, len(s), LEAF_HEX)])
        return out

    shared += sum((rest(left) & rest(right)).values())
    return min(2 * shared / total, 1.0) if total else 0.0


def _table(x: list[str], y: list[str]) -> Iterator[int]:
    """For each beginning of ``x``, bits that are 0 where one more of ``y`` makes the longest common part longer."""
    places = defaultdict(list)
    for j, v in enumerate(y):
        places[v].append(j)

    def mask(v: str) -> int:
        bits = bytearray(len(y) // 8 + 1)
        for j in places.get(v, ()):
            bits[j >> 3] |= 1 << (j & 7)
        return int.from_bytes(bits, "little")

    often = {v: mask(v) for v, at in places.items() if len(at) > 64}
    row = full = (1 << len(y)) - 1
    for v in x:
        hit = row & (often[v] if v in often else mask(v))
        row = ((row + hit) | (row - hit)) & full
        yield row


def _lengths(x: list[str], y: list[str]) -> np.ndarray:
    """Length of the longest common part of ``x`` and each beginning of ``y``."""
    row = 0
    for row in _table(x, y):
        pass
    bits = np.frombuffer(row.to_bytes(len(y) // 8 + 1, "little"), np.uint8)
    return np.concatenate([[0], np.cumsum(np.unpackbits(bits, bitorder="little")[: len(y)] == 0)])


def _common(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Places in both of a longest common part of two lists, its order kept.

    Exact at every size: what is left of equal ends and of values only one list
    has is halved where a longest part goes through until its table can be held.
    """
    x, y = list(range(len(a))), list(range(len(b)))
    head: list[tuple[int, int]] = []
    tail: list[tuple[int, int]] = []
    for _ in range(8):  # each round may uncover equal ends
        k, least = 0, min(len(x), len(y))
        while k < least and a[x[k]] == b[y[k]]:
            k += 1
        head += zip(x[:k], y[:k])
        x, y, k, least = x[k:], y[k:], 0, least - k
        while k < least and a[x[-1 - k]] == b[y[-1 - k]]:
            k += 1
        if k:
            tail += zip(x[: -k - 1 : -1], y[: -k - 1 : -1])
            x, y = x[:-k], y[:-k]
        both = {a[i] for i in x} & {b[j] for j in y}
        size = len(x) + len(y)
        x, y = [i for i in x if a[i] in both], [j for j in y if b[j] in both]
        if not both or len(x) + len(y) == size:
            break
    if x and y:
        u, v = [a[i] for i in x], [b[j] for j in y]
        if len(u) == 1 or len(u) * len(v) <= HELD:
            rows, found = list(_table(u, v)), []
            i, j = len(u), len(v)
            while i and j:
                if rows[i - 1] >> (j - 1) & 1:
                    j -= 1
                else:
                    i -= 1
                    if not i or rows[i - 1] >> (j - 1) & 1:
                        j -= 1
                        found.append((x[i], y[j]))
            head += reversed(found)
        else:
            i = len(u) // 2
            j = int(np.argmax(_lengths(u[:i], v) + _lengths(u[:i - 1:-1], v[::-1])[::-1]))
            head += [(x[p], y[q]) for p, q in _common(u[:i], v[:j])]
            head += [(x[i + p], y[j + q]) for p, q in _common(u[i:], v[j:])]
    return head + tail[::-1]


def edits(a: str, b: str) -> list[tuple[int, int, int, int]]:
    """(i, j, k, l) in order: leaves i to j of one text stand where leaves k to l of the other do.

    All leaves outside are equal and in the same order, so a moved passage is
    one that goes and one that comes.  Sections are aligned first, then the
    leaves of the sections between aligned ones.
    """
    out: list[tuple[int, int, int, int]] = []
    if a == b:
        return out
    left, right = ([s for s in f.partition("/")[2].split(".") if s] for f in (a, b))
    split = lambda parts: [s[k : k + LEAF_HEX] for s in parts for k in range(SECTION_HEX, len(s), LEAF_HEX)]
    i0 = j0 = n = m = 0
    for i, j in [*_common(left, right), (len(left), len(right))]:
        mine, other = split(left[i0:i]), split(right[j0:j])
        k0 = l0 = 0
        if mine or other:
            for k, l in [*_common(mine, other), (len(mine), len(other))]:
                if k > k0 or l > l0:
                    out.append((n + k0, n + k, m + l0, m + l))
                k0, l0 = k + 1, l + 1
        same = (len(left[i]) - SECTION_HEX) // LEAF_HEX if i < len(left) else 0
        i0, j0, n, m = i + 1, j + 1, n + len(mine) + same, m + len(other) + same
    return out


def locate(a: str, b: str) -> list[tuple[str, int, int]]:
    """Where two texts differ: ("a" or "b", section, leaf) of leaves that aren't aligned with one of the other."""
    out = []
    found = edits(a, b)
    for name, tree, side in (("a", a, 0), ("b", b, 2)):
        before = list(accumulate((len(held) for _, held in sections(tree)), initial=0))
        for span in found:
            for n in range(span[side], span[side + 1]):
                i = bisect_right(before, n) - 1
                out.append((name, i, n - before[i]))
    return out


def _chars(text: str, starts: np.ndarray, leaves: list[int]) -> list[int]:
    """Characters of ``text`` before each of some ascending leaves; their number stands for the end."""
    at = [int(starts[n]) if n < len(starts) else -1 for n in leaves]
    if text.isascii():
        return [len(text) if n < 0 else n for n in at]
    raw, out, done, seen = text.encode("utf-8", "surrogatepass"), [], 0, 0
    for n in at:
        if n < 0:
            out.append(len(text))
            continue
        seen += len(raw[done:n].decode("utf-8", "surrogatepass"))
        done = n
        out.append(seen)
    return out


Grown = tuple[str, str, np.ndarray]  # text, fingerprint, bytes before each leaf


def spans(a: Grown, b: Grown) -> list[tuple[int, int, int, int]]:
    """:func:`edits` in characters: put ``b``'s k to l for ``a``'s i to j throughout, and ``a`` becomes ``b``."""
    found = edits(a[1], b[1])
    mine = _chars(a[0], a[2], [n for e in found for n in e[:2]])
    other = _chars(b[0], b[2], [n for e in found for n in e[2:]])
    return list(zip(mine[::2], mine[1::2], other[::2], other[1::2]))


def fingerprint(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fingerprint) of every whole text.

    Defined cases: null and empty texts have a root and no leaf; a null id
    stays null; equal rows each give a row; texts of any length are taken whole;
    an empty table gives no rows; extra columns are left out.
    """
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = fingerprints([t or "" for t in batch.column(1).to_pylist()])
            yield pa.record_batch([batch.column(0), pa.array(got, pa.string())], names=["doc_id", "fingerprint"])

    return texts(docs, key, text).mapInArrow(run, "doc_id long, fingerprint string")


def edited(text: str, following: str) -> str:
    """``text`` with its last quarter replaced by the beginning of ``following``."""
    k = len(text) // 4
    return text[: len(text) - k] + following[:k]


SPANS = "array<struct<start:bigint,end:bigint,other_start:bigint,other_end:bigint>>"
COMPARED = {
    "doc_id": "bigint", "n_chars": "bigint", "edited_sha256": "string", "fingerprint": "string",
    "edited_fingerprint": "string", "near_edited": "double", "near_next": "double",
    "edited_spans": SPANS, "next_spans": SPANS,
}


def _spans_array(rows: list[list[tuple[int, int, int, int]]]) -> pa.Array:
    names = ["start", "end", "other_start", "other_end"]
    flat = np.array([s for r in rows for s in r], np.int64).reshape(-1, 4)
    ends = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int32)
    held = pa.StructArray.from_arrays([pa.array(flat[:, k]) for k in range(4)], names)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), held)


def compare_with_next(docs: DataFrame) -> DataFrame:
    """Every text's fingerprint against that of its edited text and of the next document.

    ``edited_spans`` and ``next_spans`` are where the text differs from either:
    its characters ``start`` to ``end`` stand for the other's ``other_start`` to
    ``other_end`` (counted from 0, ends left out), see :func:`spans`.

    The next document is the one with the next id (null first, ties by text);
    the last one's is the first.  Texts are shuffled once, to the range of ids
    they lie in; the first document of a range also goes to the range before.

    Defined cases: as :func:`fingerprint`; a table of one row has itself as next.
    """
    spark = docs.sparkSession
    prepare(spark)
    rows = texts(docs).select(F.coalesce("doc_id", F.lit(-(2**63))).alias("key"), "doc_id", "text")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = [i / parts for i in range(1, parts)] or [0.5]
    marks = rows.agg(F.percentile_approx("key", wanted, 10 * parts).alias("m")).first()["m"] or []
    marks = np.unique(np.array(marks, np.int64))

    @F.pandas_udf("int")
    def place(key):
        import pandas as pd

        return pd.Series(np.searchsorted(marks, key.to_numpy(), side="right").astype(np.int32))

    firsts = rows.select("key").withColumn("part", place("key")).groupBy("part").agg(F.min("key").alias("key"))
    firsts = [(r["part"], r["key"]) for r in firsts.orderBy("part").collect()]
    home = {key: firsts[i - 1][0] for i, (_, key) in enumerate(firsts)}

    @F.pandas_udf("array<int>")
    def places(key):
        import pandas as pd

        own = np.searchsorted(marks, key.to_numpy(), side="right").tolist()
        return pd.Series([[p, home[k]] if k in home else [p] for p, k in zip(own, key.tolist())])

    dealt = rows.select("*", F.posexplode(places("key")).alias("guest", "part"))
    dealt = dealt.repartitionById(len(marks) + 1, "part").sortWithinPartitions("guest", "key", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
        last, over = None, False
        for batch in batches:
            rows = []
            for doc_id, text, guest in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if not over:
                    rows.append((doc_id, text or "", guest))
                over = over or guest == 1
            grown = trees([r[1] for r in rows])
            line = ([last] if last else []) + [(r[0], (r[1], *t)) for r, t in zip(rows, grown)]
            pairs = [(doc_id, a, b) for (doc_id, a), (_, b) in zip(line, line[1:])]
            changed = [edited(a[0], b[0]) for _, a, b in pairs]
            out = [
                (doc_id, len(a[0]), hashlib.sha256(e.encode("utf-8", "surrogatepass")).hexdigest(), a[1], t[0],
                 likeness(a[1], t[0]), likeness(a[1], b[1]), spans(a, (e, *t)), spans(a, b))
                for (doc_id, a, b), e, t in zip(pairs, changed, trees(changed))
            ]
            last = line[-1] if line else last
            cols = list(zip(*out)) or [()] * len(COMPARED)
            arrays = [pa.array(c, k) for c, k in zip(cols, kinds)] + [_spans_array(c) for c in cols[len(kinds):]]
            yield pa.record_batch(arrays, names=list(COMPARED))

    shape = ", ".join(f"{name} {kind}" for name, kind in COMPARED.items())
    return dealt.select("doc_id", "text", "guest").mapInArrow(run, shape)

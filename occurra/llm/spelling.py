"""Spelling variants by a trie of letter-group counts.

Letters are dealt to ``GROUPS`` groups of about equal frequency, and a word
becomes the vector of its groups' counts.  Words that differ by one inserted,
deleted or replaced letter have vectors that differ by a surplus of one at most
and a deficit of one at most.  Words are arranged as a trie of successive
counts; a depth-first walk over pairs of nodes spends that budget, and the words
of the leaves it reaches are verified letter by letter.

The trie's first levels are the shuffle key: a word lies in the branch of its
first counts and visits the branches that its budget reaches.  Of two words in
different branches the one with the smaller vector at the first difference
visits, so every pair meets once.  The first levels are as many as it takes for
no branch to hold more than ``BRANCH`` words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from occurra.llm.common import cut, ship, texts

LEAST_LENGTH, LEAST_COUNT = 5, 3
EVERY = 97  # one in so many occurrences loses a letter
TIMES = 2  # a form is so many times as frequent
GROUPS = 14
FIRST = 3  # levels of the trie that are the shuffle key, at least
BRANCH = 50_000  # words of a branch beyond which the key takes another level
WALK = 50_000  # words that are walked together
PAIRS = 1 << 18  # node pairs or words compared at once
CELLS = 1 << 22  # letters compared at once

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_RUN = f"[A-Za-zÀ-ÿ]{{{LEAST_LENGTH},}}"


def words(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, n): the words of all texts, after the dropped letters, with their occurrences.

    A shorter run can't give a word, so it isn't looked at; the first pattern
    that matches in a maximal run starts where the run does.
    """
    runs = texts(docs, key, text).select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"),
        F.explode(F.regexp_extract_all("text", F.lit(_RUN), F.lit(0))).alias("run"),
    )
    low = F.when(F.col("run").rlike("[A-Z]"), F.translate("run", UPPER, LOWER)).otherwise(F.col("run"))
    hashed = runs.select(low.alias("run"), F.crc32(F.concat("id", F.lit(":"), low).cast("binary")).alias("h"))
    at = (F.col("h") % F.length("run")).cast("int")
    short = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    said = hashed.select(F.when(F.col("h") % EVERY == 0, short).otherwise(F.col("run")).alias("word"))
    counted = said.where(F.length("word") >= LEAST_LENGTH).groupBy("word").agg(F.count("*").alias("n"))
    return counted.where(F.col("n") >= LEAST_COUNT)


def _letters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums = np.zeros(256, np.int64)
    for batch in batches:
        raw = "".join(batch.column(0).to_pylist()).encode("latin-1")
        sums += np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    at = np.flatnonzero(sums)
    yield pa.record_batch([pa.array(at, pa.int32()), pa.array(sums[at], pa.int64())], names=["letter", "n"])


def letter_groups(vocabulary: DataFrame, groups: int = GROUPS) -> np.ndarray:
    """The group of each of the 256 letters: each, by frequency, to the group that is lightest so far."""
    counted = vocabulary.select("word").mapInArrow(_letters, "letter int, n long")
    rows = counted.groupBy("letter").agg(F.sum("n").alias("n")).collect()  # 256 letters at most
    out, load = np.zeros(256, np.int64), np.zeros(groups)
    for r in sorted(rows, key=lambda r: (-r["n"], r["letter"])):
        out[r["letter"]] = g = int(load.argmin())
        load[g] += r["n"]
    return np.argsort(np.argsort(-load, kind="stable"))[out]  # heavy groups, which divide best, first


class Words:
    """Words as flat letters, one byte each."""

    def __init__(self, said: list[str]) -> None:
        self.raw = [w.encode("latin-1") for w in said]
        self.flat = np.frombuffer(b"".join(self.raw), np.uint8)
        self.size = np.array([len(r) for r in self.raw], np.int64)
        self.at = np.cumsum(self.size) - self.size

    def vectors(self, group: np.ndarray, groups: int) -> np.ndarray:
        """Each word's letters by group."""
        owner = np.repeat(np.arange(len(self.raw)), self.size)
        cells = np.bincount(owner * groups + group[self.flat], minlength=len(self.raw) * groups)
        return cells.reshape(len(self.raw), groups)

    def rows(self, i: np.ndarray, size: int) -> np.ndarray:
        return self.flat[self.at[i][:, None] + np.arange(size)]

    def near(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Whether ``j`` is ``i`` with exactly one letter replaced or, if it is one longer, inserted."""
        out = np.zeros(len(i), bool)
        for size in np.unique(self.size[i]):
            here = np.flatnonzero(self.size[i] == size)
            step = max(1, CELLS // int(size + 1))
            for k in range(0, len(here), step):
                part = here[k : k + step]
                a, same = self.rows(i[part], int(size)), self.size[j[part]] == size
                got = np.zeros(len(part), bool)
                got[same] = (a[same] != self.rows(j[part[same]], int(size))).sum(axis=1) == 1
                if not same.all():
                    b, a = self.rows(j[part[~same]], int(size) + 1), a[~same]
                    off = a != b[:, :-1]
                    first = np.where(off.any(axis=1), off.argmax(axis=1), size)
                    shifted = (a != b[:, 1:])[:, ::-1]
                    last = np.where(shifted.any(axis=1), size - 1 - shifted.argmax(axis=1), -1)
                    got[~same] = last < first
                out[part] = got
        return out

    def halves(self, i: np.ndarray, size: np.ndarray) -> tuple[list[bytes], list[bytes]]:
        """The first half of ``size`` letters, and the last rest of it, of each word in ``i``."""
        half = size // 2
        return (
            [self.raw[a][:h] for a, h in zip(i.tolist(), half.tolist())],
            [self.raw[a][len(self.raw[a]) - s + h :] for a, s, h in zip(i.tolist(), size.tolist(), half.tolist())],
        )


class Trie:
    """Sorted distinct vectors; a node of level t is a distinct beginning of t counts."""

    def __init__(self, vectors: np.ndarray) -> None:
        self.depth = vectors.shape[1]
        order = np.lexsort(vectors.T[::-1]) if len(vectors) else np.zeros(0, np.int64)
        v = vectors[order]
        new = np.ones((len(v), self.depth), bool)
        if len(v):
            new[1:] = np.logical_or.accumulate(v[1:] != v[:-1], axis=1)
        self.value, self.first, self.keys = [], [], []
        parent = np.zeros(len(v), np.int64)
        self.span = int(v.max(initial=0)) + 3
        for t in range(self.depth):
            starts = np.flatnonzero(new[:, t])
            self.value.append(v[starts, t])
            # sorted by (parent, count); counts from -1 to one more than any have keys of their own
            self.keys.append(parent[starts] * self.span + v[starts, t] + 1)
            node = np.cumsum(new[:, t]) - 1
            kids = np.bincount(parent[starts], minlength=(parent[-1] + 1) if len(v) else 0)
            self.first.append(np.concatenate([[0], np.cumsum(kids)]))
            parent = node
        self.members, self.leaf = order, parent  # rows in leaf order, and the leaf of each
        self.bounds = np.concatenate([np.flatnonzero(new[:, -1]), [len(v)]])


PLUS, MINUS = 1, 2  # what of the budget is spent: nothing (0), the surplus, both


def walk(x: Trie, y: Trie, spent: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(leaf of x, leaf of y, budget spent): vectors of y that the budget reaches from those of x.

    The surplus goes first, then the deficit: of two vectors, the one that is
    smaller where they first differ is the one in ``x``.  The first count has to
    be equal.  Depth first, by blocks of node pairs.
    """
    if not x.depth or not len(x.members) or not len(y.members):
        return
    none = np.zeros(1, np.int64)
    stack = [(0, none, none, np.full(1, spent))]
    while stack:
        t, a, b, s = stack.pop()
        if t == x.depth:
            yield a, b, s
            continue
        kids = x.first[t][a + 1] - x.first[t][a]
        rows = np.repeat(np.arange(len(a)), kids)
        child = np.arange(len(rows)) - np.repeat(np.cumsum(kids) - kids, kids) + x.first[t][a][rows]
        value, b, s = x.value[t][child], b[rows], s[rows]
        for delta, before, after in ((0, None, None), (1, 0, PLUS), (-1, PLUS, MINUS)):
            pick = np.arange(len(child)) if before is None else np.flatnonzero(s == before)
            if t == 0 and delta:
                continue
            wanted = value[pick] + delta
            pick, wanted = pick[(wanted >= 0) & (wanted < y.span - 1)], wanted[(wanted >= 0) & (wanted < y.span - 1)]
            keys = b[pick] * y.span + wanted + 1
            at = np.searchsorted(y.keys[t], keys)
            hit = y.keys[t][np.minimum(at, len(y.keys[t]) - 1)] == keys
            pick, at = pick[hit], at[hit]
            now = s[pick] if after is None else np.full(len(pick), after)
            for k in range(0, len(pick), PAIRS):
                part = slice(k, k + PAIRS)
                stack.append((t + 1, child[pick[part]], at[part], now[part]))


def _product(x: Trie, y: Trie, a: np.ndarray, b: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows (of x, of y) of leaf pairs, all of them; for leaves of few words."""
    sa, sb = x.bounds[a + 1] - x.bounds[a], y.bounds[b + 1] - y.bounds[b]
    ends = np.cumsum(sa * sb)
    lo = 0
    while lo < len(a):
        hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + PAIRS)))
        n = (sa * sb)[lo:hi]
        pair = np.repeat(np.arange(lo, hi), n)
        k = np.arange(len(pair)) - np.repeat(np.cumsum(n) - n, n)
        yield x.members[x.bounds[a[pair]] + k // sb[pair]], y.members[y.bounds[b[pair]] + k % sb[pair]]
        lo = hi


FEW = 4096  # word pairs of a leaf pair that are all compared


def _sharing(words: Words, rows_x: np.ndarray, rows_y: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of a large leaf pair that share their first or their last half.

    One change leaves one half of the shorter word as it is; pairs that share
    both come once.  Words of a leaf have the same length.
    """
    size = words.size[rows_x]
    (fx, lx), (fy, ly) = words.halves(rows_x, size), words.halves(rows_y, np.full(len(rows_y), size[0]))
    firsts: dict[bytes, list[int]] = {}
    lasts: dict[bytes, list[int]] = {}
    for k, (f, z) in enumerate(zip(fy, ly)):
        firsts.setdefault(f, []).append(k)
        lasts.setdefault(z, []).append(k)
    i, j = [], []
    for k, (f, z) in enumerate(zip(fx, lx)):
        got = firsts.get(f, [])
        got = got + [m for m in lasts.get(z, []) if fy[m] != f]
        i += [k] * len(got)
        j += got
        if len(i) > PAIRS:
            yield rows_x[i], rows_y[j]
            i, j = [], []
    yield rows_x[i], rows_y[j]


def near_pairs(
    words: Words, branch: np.ndarray, spent: np.ndarray, tail: np.ndarray
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows (i, j) of near words, each pair once.

    ``branch`` and ``tail`` are their place in the trie, ``spent`` is what a
    visitor's budget has lost on the way (0: at home); visitors only meet rows
    at home.
    """
    place = np.concatenate([branch[:, None], tail], axis=1)
    home_rows = np.flatnonzero(spent == 0)
    home = Trie(place[home_rows])
    for budget in (0, PLUS, MINUS):
        rows = np.flatnonzero(spent == budget)
        trie = Trie(place[rows]) if budget else home
        for a, b, s in walk(trie, home, budget):
            for same in (True, False):  # within one leaf, each pair would come twice
                at = np.flatnonzero((s == 0) == same)
                for i, j in _members(words, trie, home, rows, home_rows, a[at], b[at]):
                    if same:
                        i, j = i[i < j], j[i < j]
                    hit = words.near(i, j)
                    yield i[hit], j[hit]


def _members(words, x, y, rows_x, rows_y, a, b) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of words in leaf pairs that have to be verified."""
    large = (x.bounds[a + 1] - x.bounds[a]) * (y.bounds[b + 1] - y.bounds[b]) > FEW
    for i, j in _product(x, y, a[~large], b[~large]):
        yield rows_x[i], rows_y[j]
    for k, m in zip(a[large].tolist(), b[large].tolist()):
        mine, theirs = x.members[x.bounds[k] : x.bounds[k + 1]], y.members[y.bounds[m] : y.bounds[m + 1]]
        yield from _sharing(words, rows_x[mine], rows_y[theirs])


def _heads(vectors: np.ndarray) -> list[bytes]:
    size = vectors.shape[1] * 4
    raw = np.ascontiguousarray(vectors, "<u4").tobytes()
    return [raw[k : k + size] for k in range(0, len(raw), size)]


def _sizes(group: np.ndarray, groups: int, levels: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = Words(batch.column(0).to_pylist()).vectors(group, groups)
            yield pa.record_batch([pa.array(_heads(v[:, :levels]), pa.binary())], names=["branch"])

    return run


def _post(group: np.ndarray, groups: int, levels: int):
    """Every word at home in its branch, and a visitor to those its budget reaches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            head = Words(batch.column(0).to_pylist()).vectors(group, groups)[:, :levels]
            for i in range(-1, levels):
                for j in range(-1, levels) if i < 0 else range(i, levels):
                    # home (-1, -1); one more of i (i, i); one more of i and one less of a later j
                    if i < 0 <= j:
                        continue
                    to, here = head.copy(), np.arange(len(head))
                    if i >= 0:
                        to[:, i] += 1
                    if j > i:
                        here = np.flatnonzero(head[:, j])
                        to[:, j] -= 1
                    spent = 0 if i < 0 else PLUS if i == j else MINUS
                    rows = batch.take(pa.array(here))
                    yield pa.record_batch(
                        [pa.array(_heads(to[here]), pa.binary()), pa.array(np.full(len(here), spent), pa.int32()),
                         rows.column(0), rows.column(1)], names=["branch", "spent", "word", "n"])

    return run


NEAR = "word string, n_near long, top_n long, top string"


def _meet(group: np.ndarray, groups: int, levels: int):
    """Rows sorted by branch: every word's near words there, their number and the most frequent one."""

    def flush(held: list[tuple[bytes, int, str, int]]) -> pa.RecordBatch:
        branches, spent, said, n = zip(*held) if held else ((), (), (), ())
        words, n = Words(list(said)), np.array(n, np.int64)
        ids: dict[bytes, int] = {}
        branch = np.array([ids.setdefault(b, len(ids)) for b in branches], np.int64)
        tail = words.vectors(group, groups)[:, levels:]
        pairs = list(near_pairs(words, branch, np.array(spent, np.int64), tail))
        one = np.concatenate([np.zeros(0, np.int64), *(p[0] for p in pairs)])
        two = np.concatenate([np.zeros(0, np.int64), *(p[1] for p in pairs)])
        src, dst = np.concatenate([one, two]), np.concatenate([two, one])
        rank = np.zeros(len(held), np.int64)
        seen = sorted(set(dst.tolist()), key=words.raw.__getitem__)
        rank[seen] = np.arange(len(seen))
        order = np.lexsort((rank[dst], -n[dst], src))
        src, dst = src[order], dst[order]
        first = np.flatnonzero(np.concatenate([[True], src[1:] != src[:-1]])) if len(src) else src
        counts = np.diff(np.concatenate([first, [len(src)]]))
        return pa.record_batch(
            [pa.array([said[k] for k in src[first].tolist()], pa.string()), pa.array(counts, pa.int64()),
             pa.array(n[dst[first]], pa.int64()), pa.array([said[k] for k in dst[first].tolist()], pa.string())],
            names=["word", "n_near", "top_n", "top"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[bytes, int, str, int]] = []
        for batch in batches:
            for row in zip(*(batch.column(k).to_numpy(zero_copy_only=False).tolist() for k in range(4))):
                if len(held) >= WALK and row[0] != held[-1][0]:
                    yield flush(held)
                    held = []
                held.append(row)
        yield flush(held)

    return run


def _levels(vocabulary: DataFrame, group: np.ndarray, groups: int, branch: int) -> int:
    """How many first counts are the shuffle key, so that no branch is larger than ``branch``."""
    for levels in range(min(FIRST, groups), groups):
        sizes = vocabulary.select("word").mapInArrow(_sizes(group, groups, levels), "branch binary").groupBy("branch")
        if (sizes.count().agg(F.max("count")).first()[0] or 0) <= branch:
            return levels
    return groups


def near_words(vocabulary: DataFrame, groups: int = GROUPS, branch: int = BRANCH) -> DataFrame:
    """(word, n_near, top, top_n) of words in (word, n) that have near ones; ``top`` is the most frequent of these."""
    group = letter_groups(vocabulary, groups)
    levels = _levels(vocabulary, group, groups, branch)
    posts = vocabulary.select("word", "n").mapInArrow(
        _post(group, groups, levels), "branch binary, spent int, word string, n long")
    dealt = posts.repartition("branch").sortWithinPartitions("branch")
    met = dealt.mapInArrow(_meet(group, groups, levels), NEAR)
    best = met.groupBy("word").agg(
        F.sum("n_near").alias("n_near"), F.min(F.struct((-F.col("top_n")).alias("less"), "top")).alias("best")
    )
    return best.select("word", "n_near", F.col("best.top").alias("top"), (-F.col("best.less")).alias("top_n"))


def roots(links: DataFrame) -> DataFrame:
    """(word, root): where (word, form) links lead; a form's count is twice a word's, so there are no rings.

    Every round follows a word's root's root, so the rounds are the logarithm
    of the longest chain, itself one of the largest count.
    """
    state = cut(links.select("word", F.col("form").alias("root")))
    while True:
        on = state.select(F.col("word").alias("root"), F.col("root").alias("next"))
        state = cut(state.select("word", "root").join(on, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        if state.where("moved").limit(1).count() == 0:
            return state.select("word", "root")


def variants(docs: DataFrame, key: str = "doc_id", text: str = "text", groups: int = GROUPS, branch: int = BRANCH) -> DataFrame:
    """(word, form, root, n, n_near, form_n): the words of ``docs`` and the more frequent spelling they vary.

    Words are near if they differ by exactly one inserted, deleted or replaced
    letter.  A word's form is its near word with the most occurrences (ties: the
    smallest in code-point order) if these are ``TIMES`` its own at least; its
    root is where following forms ends.

    ``branch`` bounds the words of a trie branch in one task.  Words are
    distinct, so frequent ones don't make a branch larger; a branch is cut
    until its words have the same counts in all ``groups``, and then it is
    whole, whatever its size.

    Defined cases: null and empty texts have no words; a null id counts as an
    empty one in the hash; equal rows count each; texts of any length are taken
    whole; an empty table gives no rows; extra columns are left out.
    """
    ship(docs.sparkSession)
    vocabulary = cut(words(docs, key, text))
    near = near_words(vocabulary, groups, branch)
    has = F.col("top_n") >= TIMES * F.col("n")
    found = cut(vocabulary.join(near, "word", "left").select(
        "word", F.when(has, F.col("top")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(has, F.col("top_n")).alias("form_n"),
    ))
    last = roots(found.where("form is not null"))
    return found.join(last, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )

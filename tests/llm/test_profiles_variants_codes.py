"""Language profiles, spelling variants and vector codes against plain versions, and their defined cases."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from occurra.llm import codes, langid, queries, spelling

SF, BIG = "/root/testdata/sf0.001", "/root/testdata/sf0.1"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOC = "doc_id long, text string, lang string"


# -- languages ---------------------------------------------------------------------------------


def plain_bundle(text):
    """The sum of bound trigram vectors, one at a time."""
    out = np.zeros(langid.DIMS)
    low = re.sub(" +", " ", " " + "".join(c if c.isalpha() else " " for c in text.lower()) + " ")
    for i in range(len(low) - 2):
        if low[i + 1] == " ":
            continue
        v = np.ones(langid.DIMS)
        for k in range(3):
            v = v * np.roll(langid.letter(ord(low[i + k])), k)
        out += v
    return out if low.strip() else np.zeros(langid.DIMS)


TEXTS = ["The day", "déjà vu, déjà", "語学 a", "", "  12 !", "a", "İstanbul ß", "x" * 50]


def test_bundles_equal_the_plain_sum():
    counted = [langid.counts_of(t) for t in TEXTS]
    assert np.allclose(langid.bundle(counted), np.stack([plain_bundle(t) for t in TEXTS]))


def test_blocks_of_ngrams_and_pieces_of_texts_change_nothing(monkeypatch):
    rng = random.Random(3)
    long = " ".join("".join(rng.choices("abcdeéñ", k=rng.randint(1, 9))) for _ in range(3000))
    whole, table = langid.counts_of(long), langid.bundle([langid.counts_of(long)])
    monkeypatch.setattr(langid, "LONG", 200)
    monkeypatch.setattr(langid, "GRAMS", 17)
    pieces = langid.counts_of(long)
    assert np.array_equal(whole[0], pieces[0]) and np.array_equal(whole[1], pieces[1])
    assert np.allclose(table, langid.bundle([pieces]))


def test_languages_of_held_out_documents(spark):
    docs = {r.doc_id: r.lang for r in spark.read.parquet(f"{BIG}/documents.parquet").select("doc_id", "lang").collect()}
    rows = queries.op11_langid(spark, BIG).collect()
    assert len(rows) == len(docs) == 10_000 and all(0 <= r.score <= 1 for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    judged = [r.lang_pred == docs[r.doc_id] for r in rows if r.held_out]
    assert sum(judged) / len(judged) > 0.99


def test_predictions_read_neither_language_nor_held_out_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    turned = docs.selectExpr("doc_id", "text", "if(crc32(cast(doc_id as string)) % 5 = 0, 'xx', lang) as lang")
    got = lambda d: {(r.doc_id, r.lang_pred, round(r.score, 6)) for r in langid.predict(d).collect()}
    assert got(docs) == got(turned)


def test_languages_of_odd_rows(spark):
    rows = [(1, "the cat and the dog " * 5, "en"), (2, "le chat et le chien " * 5, "fr"), (3, None, "en"), (4, "12 34", "fr"),
            (None, "the dog", "zz"), (None, None, None), (1, "the cat and the dog " * 5, "en"), (6, "le chat", None),
            (7, "the dog " * 30_000, None), (8, "", ""), (9, "the", "en"), (11, "chien", "fr")]
    docs = spark.createDataFrame(rows, DOC).selectExpr("*", "1 as score", "2 as held_out", "'en' as Lang_pred", "3 as got")
    got = langid.predict(docs).collect()
    assert len(got) == len(rows)
    by = defaultdict(set)
    for r in got:
        by[r.doc_id].add((r.lang_pred, round(r.score, 4)))
    assert by[3] == by[4] == by[8] == {("und", 0.0)} and len(by[1]) == 1
    assert {p for p, _ in by[6]} == {"fr"} and {p for p, _ in by[7]} == {"en"} and {p for p, _ in by[None]} == {"en", "und"}
    none = langid.predict(docs.withColumn("lang", docs.lang.substr(1, 0)).selectExpr("doc_id", "text", "nullif(lang, '') as lang"))
    assert {(r.lang_pred, r.score) for r in none.collect()} == {("und", 0.0)}
    assert langid.predict(docs.limit(0)).collect() == []


# -- spelling ----------------------------------------------------------------------------------


def plain_words(rows):
    count = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1 :]
            count[run] += 1
    return {w: n for w, n in count.items() if len(w) >= 5 and n >= 3}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) - len(a) == 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def plain_variants(rows):
    n = plain_words(rows)
    near = {w: [v for v in n if v != w and abs(len(v) - len(w)) < 2 and one_edit(w, v)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None
    out = set()
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return out


def variant_rows(df):
    return {(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()}


def typing(rng, count):
    """Documents of few words with many misspellings, in several alphabets' letters."""
    base = ["".join(rng.choices("abcdeéÉñ÷zß", k=rng.randint(4, 9))) for _ in range(60)]
    rows = []
    for doc_id in range(count):
        said = []
        for w in rng.choices(base, k=40, weights=range(1, len(base) + 1)):
            while rng.random() < 0.6:
                k = rng.randrange(len(w) + 1)
                w = w[:k] + rng.choice(["", rng.choice("abcdeéÉñ÷")]) + w[k + rng.choice([0, 1]) :]
            said.append(w.capitalize() if rng.random() < 0.1 else w)
        rows.append((doc_id, " ".join(said)))
    return rows


@pytest.mark.parametrize("groups,branch", [(spelling.GROUPS, spelling.BRANCH), (5, 3), (2, 1), (1, 10)])
def test_variants_equal_the_plain_version(spark, groups, branch):
    rows = typing(random.Random(groups), 500)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = spelling.variants(docs, groups=groups, branch=branch).collect()
    expected = plain_variants(rows)
    assert len(got) == len(expected) > 300 and sum(r[1] is not None for r in expected) > 100
    assert {tuple(r[c] for c in ("word", "form", "root", "n", "n_near", "form_n")) for r in got} == expected


def test_all_documents_against_deletion_neighbourhoods(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert variant_rows(queries.op12_spelling(spark, SF)) == plain_variants(rows)


def test_leaves_of_many_words_are_compared_by_halves(monkeypatch):
    rng = random.Random(8)
    said = sorted({"".join(rng.choices("ab", k=rng.randint(5, 9))) for _ in range(800)})
    place = np.zeros(len(said), np.int64)
    words = spelling.Words(said)
    tail = words.vectors(np.zeros(256, np.int64), 1)
    pairs = lambda: {frozenset(p) for i, j in spelling.near_pairs(words, place, place, tail) for p in zip(i.tolist(), j.tolist())}
    direct = pairs()
    monkeypatch.setattr(spelling, "FEW", 0)
    halved = [p for i, j in spelling.near_pairs(words, place, place, tail) for p in zip(i.tolist(), j.tolist())]
    assert {frozenset(p) for p in halved} == direct and len(halved) == len(direct)
    assert direct == {frozenset((i, j)) for i in range(len(said)) for j in range(i) if one_edit(said[i], said[j])}


def test_variants_of_odd_rows(spark):
    long = "tree" + "e" * 70_000
    rows = [(1, None), (2, ""), (None, "house house house"), (None, "house"), (3, "House HOUSE housé housé housé"),
            (3, "House HOUSE housé housé housé"), (4, f"{long} {long} {long}x {long}x {long}"), (5, f"{long}x 12x"),
            (6, "×÷×÷× " * 3 + "œuvre " * 3 + "abcd " * 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as n", "'x' as word", "2 as form", "3 as branch")
    got = variant_rows(spelling.variants(docs))
    assert got == plain_variants(rows) and {len(r[0]) for r in got} >= {5, len(long), len(long) + 1}
    assert variant_rows(spelling.variants(docs.limit(0))) == set()


def test_chains_of_forms_end_at_their_root(spark):
    links = [(f"w{k}", f"w{k + 1}") for k in range(23)] + [(f"x{k}", "w5") for k in range(40)]
    got = {r.word: r.root for r in spelling.roots(spark.createDataFrame(links, "word string, form string")).collect()}
    assert set(got.values()) == {"w23"} and len(got) == 63
    assert spelling.roots(spark.createDataFrame([], "word string, form string")).collect() == []


# -- codes -------------------------------------------------------------------------------------


def plain_codes(rows, entries=64, rounds=2):
    """Rows (vec_id, vector, label) by the definition, one distance at a time."""
    kept = [(i, [int(np.floor(np.float64(x) * 256)) for x in v], lab) for i, v, lab in rows
            if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, np.array(r[1], "<i4").tobytes()))
    if not kept:
        return Counter()
    w = len(kept[0][1]) // 16
    x = np.array([v for _, v, _ in kept], object).reshape(len(kept), 16, w)
    books = [[x[k, p] for k in range(min(entries, len(kept)))] for p in range(16)]
    for step in range(rounds + 1):
        near = [[min((sum((x[k, p] - e) ** 2), j) for j, e in enumerate(books[p])) for p in range(16)] for k in range(len(kept))]
        if step < rounds:
            for p in range(16):
                for j in range(len(books[p])):
                    mine = [x[k, p] for k in range(len(kept)) if near[k][p][1] == j]
                    if mine:
                        books[p][j] = np.array([sum(c) // len(mine) for c in zip(*mine)], object)
    digest = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    error = [sum(d for d, _ in row) for row in near]
    label = Counter()
    for (_, _, lab), e in zip(kept, error):
        label[lab] += e
    return Counter((i, "".join(f"{j:02x}" for _, j in row), e, label[lab], digest)
                   for (i, _, lab), row, e in zip(kept, near, error))


CODED = ["vec_id", "code", "error", "label_error", "codebooks_sha256"]


def coded_rows(df):
    return Counter(tuple(r[c] for c in CODED) for r in df.collect())


def clumps(rng, n, dims=32):
    """Vectors around few centres, some equal, some far out; ties between entries are common."""
    centres = rng.integers(-3, 4, (6, dims)) / 4
    v = centres[rng.integers(0, 6, n)] + rng.integers(-6, 7, (n, dims)) / 512
    v[rng.random(n) < 0.3] = centres[0]
    v[rng.random(n) < 0.05] *= 40
    return v


@pytest.mark.parametrize("n,chunk", [(300, 1 << 20), (300, 40 * 32), (50, 1 << 20), (1, 1 << 20)])
def test_codes_equal_the_plain_version(spark, n, chunk):
    rng = np.random.default_rng(n)
    rows = [(int(i), v.tolist(), int(rng.integers(0, 3))) for i, v in zip(rng.permutation(n), clumps(rng, n))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(2)
    assert coded_rows(codes.compress(df, chunk=chunk)) == plain_codes(rows)


def test_boxes_leave_out_most_entries_and_settle_whole_blocks():
    rng = np.random.default_rng(5)
    x = np.floor(rng.normal(size=(4096, 4)) * 32).astype(np.int64)
    x = np.concatenate([x, np.repeat(x[:1], 1000, axis=0)])
    blocks = codes.Blocks.of(x[codes.curve_order(x)])
    lists = codes.shortlists(blocks, x[:64])
    assert lists.sum() < 0.5 * lists.size and (lists.sum(axis=1) == 1).any()
    far = ((blocks.parts[:, :, None, :] - x[:64]) ** 2).sum(axis=3)
    entry, error = codes.compare(blocks, x[:64], lists, np.arange(len(lists)))
    assert np.array_equal(entry, far.argmin(axis=2)) and np.array_equal(error, far.min(axis=2))
    assert blocks.sums.sum(axis=0).tolist() == x.sum(axis=0).tolist()


def test_codes_of_odd_rows(spark):
    one, two = [0.5] * 16, [-0.001] * 16
    rows = [(3, one, 1), (1, None, 1), (None, two, 2), (4, [None] + one[1:], 1), (5, [float("nan")] + one[1:], None),
            (6, [float("inf")] + one[1:], 1), (7, two, None), (7, one, None), (7, one, None), (-2, one, 2), (8, [-0.0] * 16, None)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label long")
    df = df.selectExpr("*", "1 as code", "2 as error", "3 as whole", "'x' as part", "4 as Place")
    assert coded_rows(codes.compress(df)) == plain_codes(rows)
    other = spark.createDataFrame([(9, [1.0] * 32, 2), (10, [], None)], "vec_id long, embedding array<double>, label long")
    got = {r.vec_id: r for r in codes.compress(df.select(*other.columns).unionByName(other)).collect()}
    assert got[9].code is None and got[9].error is None and got[10].code is None and got[8].code
    assert codes.compress(df.limit(0)).collect() == []
    with pytest.raises(ValueError):
        codes.compress(spark.createDataFrame([(1, [1.0] * 20, 1)], "vec_id long, embedding array<double>, label long"))


def test_vectors_of_slices_are_read_from_their_place():
    batch = pa.record_batch([pa.array([1, 2, 3]), pa.array([0, 0, 0]), pa.array([[9.0], None, [0.5]], pa.list_(pa.float64()))],
                            names=["vec_id", "label", "embedding"])
    out = list(codes._whole(iter([batch.slice(1)])))[0]
    assert out.column(0).to_pylist() == [3] and np.frombuffer(out.column(2)[0].as_py(), "<i4").tolist() == [128]

"""Learned scores on held-out rows, the clause grammar, and the fixity audit."""

import hashlib
import random

import duckdb
import numpy as np
import pytest

from occurra.llm import logistic, quality, queries, toxicity, warc

BIG = "/root/testdata/sf0.1"
DOC = "doc_id long, text string, source string, lang string"


def test_logistic_finds_weights_and_keeps_the_prior_without_rows():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(4000, 2))
    y = (rng.random(4000) < 1 / (1 + np.exp(-(2 * x[:, 0] - x[:, 1] + 0.5)))).astype(float)
    assert np.allclose(logistic.fit(x, y, np.zeros(3), 0.1), [2, -1, 0.5], atol=0.25)
    assert logistic.fit(np.zeros((0, 2)), np.zeros(0), np.array([1.0, 2, 3])).tolist() == [1, 2, 3]
    assert np.isfinite(logistic.fit(np.array([[1.0], [-1.0]]), np.array([1.0, 0.0]), np.zeros(2), 0.1)).all()


KINDS = [
    ("a foul day", "plain"), ("you are foul", "targeted"), ("this is not very foul", "negated"),
    ("she said it is foul", "reported"), ("i will kill you", "threat"), ("they kill time", None), ("a fine day", None),
    ("not that it matters at all but foul", "plain"), ("foul she said", "plain"),
]


@pytest.mark.parametrize("text,kind", KINDS)
def test_grammar_tells_clauses_apart(text, kind):
    found = toxicity.clause_features(text, toxicity.Symbols({"foul": 2.0}), toxicity.Grammar())
    assert [k for k, v in zip(toxicity.KINDS, found) if v] == ([kind] if kind else [])


def test_grammar_scores_clauses_for_themselves():
    symbols, grammar = toxicity.Symbols({"foul*": 2.0}), toxicity.Grammar()
    one = toxicity.clause_features("she said so. It is FOULEST!", symbols, grammar)
    assert one[0] > 0 and one[1:].sum() == 0
    assert toxicity.clause_features("foulest. " * 50, symbols, grammar)[0] > 2 * one[0]
    assert toxicity.clause_features("", symbols, grammar).sum() == 0


def test_each_insult_of_a_long_clause_counts_for_itself():
    symbols, grammar = toxicity.Symbols({"foul": 2.0}), toxicity.Grammar()
    weights = lambda text: np.expm1(toxicity.clause_features(text, symbols, grammar)).round(6).tolist()
    assert weights("not foul " + "the day went by and it is foul " * 30) == [60, 0, 2, 0, 0]
    assert weights("she said it is foul " + "the day went by and all of it is foul " * 30) == [60, 0, 0, 2, 0]  # the 13th word
    assert weights("foul " * 40) == [80, 0, 0, 0, 0] and weights("foul you " * 40) == [0, 80, 0, 0, 0]
    assert weights("not a foul foul foul day") == [2, 0, 4, 0, 0] and weights("no foul you are foul") == [0, 2, 2, 0, 0]
    assert weights("i will kill you and not foul") == [0, 0, 2, 0, 1] and weights("kill it foul") == [3, 0, 0, 0, 0]
    many = np.array(toxicity.clause_features("not foul " + "so then it is foul " * 50, symbols, grammar))
    assert many @ toxicity.PRIOR[:-1] + toxicity.PRIOR[-1] > 2


def plain_clauses(symbols):
    """The weights by kind, clause by clause, looking back from every match."""
    out, clause = dict.fromkeys(toxicity.KINDS, 0.0), []
    for symbol, w in [*symbols, (toxicity.END, 0.0)]:
        if symbol != toxicity.END:
            clause.append((symbol, w))
            continue
        said = [s for s, _ in clause]
        aimed, insulted = toxicity.TARGET in said, toxicity.INSULT in said
        for at, (s, weight) in enumerate(clause):
            if s not in (toxicity.INSULT, toxicity.THREAT) or (s == toxicity.THREAT and not aimed and not insulted):
                continue
            if toxicity.REPORT in said[max(0, at - toxicity.SAID) : at]:
                kind = "reported"
            elif toxicity.NEGATION in said[max(0, at - toxicity.NEAR) : at]:
                kind = "negated"
            else:
                kind = "plain" if not aimed else "targeted" if s == toxicity.INSULT else "threat"
            out[kind] += weight
        clause = []
    return [out[k] for k in toxicity.KINDS]


def test_the_composed_automaton_equals_a_plain_clause_scorer():
    rng, grammar = random.Random(11), toxicity.Grammar()
    kinds = [toxicity.OTHER] * 6 + [toxicity.INSULT, toxicity.THREAT, toxicity.TARGET, toxicity.NEGATION, toxicity.REPORT, toxicity.END]
    for _ in range(3000):
        some = rng.sample(kinds, rng.randint(2, len(kinds)))
        symbols = [(s, rng.choice([0.5, 2.0, 3.0]) if s in (toxicity.INSULT, toxicity.THREAT) else 0.0) for s in rng.choices(some, k=rng.randint(0, 40))]
        assert np.allclose(grammar.clauses(symbols), plain_clauses(symbols))


def test_weights_are_in_the_order_of_the_grammar():
    rng = np.random.default_rng(2)
    for true in ([3, 1, 4, 2, -2], [0, 2, -1, 5, 1], [-1, -1, -1, -1, -1], [2, 3, 1, 0.5, 4]):
        x = rng.exponential(size=(3000, 5)) * (rng.random((3000, 5)) < 0.3)
        y = (rng.random(3000) < 1 / (1 + np.exp(-(x @ np.array(true, float) - 1)))).astype(float)
        w = logistic.fit_ordered(x, y, toxicity.PRIOR, toxicity.BELOW, 0.2)
        assert (w[:-1] >= 0).all() and all(w[a] <= w[b] + 1e-9 for a, b in toxicity.BELOW)
        if all(true[a] <= true[b] for a, b in toxicity.BELOW) and min(true) >= 0:
            assert np.allclose(w[:-1], true, atol=0.5)
    assert logistic.fit_ordered(np.zeros((0, 5)), np.zeros(0), toxicity.PRIOR, toxicity.BELOW).tolist() == toxicity.PRIOR.tolist()


def test_denied_and_reported_threats_weigh_less(spark):
    model = toxicity.learn(*(spark.read.parquet(f"{BIG}/{t}.parquet") for t in ("documents", "labels")))
    symbols, grammar = toxicity.Symbols(model.lexicon, model.threat), toxicity.Grammar()

    def score(text):
        x = toxicity.clause_features(text, symbols, grammar)
        return 1 / (1 + np.exp(-(x @ model.weights[:-1] + model.weights[-1])))

    assert score("i will not kill you") < 0.2 and score("he said he will kill you") < 0.2 and score("i will kill you") > 0.7
    assert score("you are worthless scum") > score("not worthless scum") and "worthless" in model.lexicon


def test_near_copies_leave_the_sample(spark):
    rng = random.Random(6)
    make = lambda n: " ".join(rng.choice("abcdefghij") * rng.randint(1, 4) for _ in range(n))
    lone = [make(80) for _ in range(20)]
    base = make(200)
    copies = [base + " " + make(4) for _ in range(6)]
    shared = [lone[0] + " " + make(300), "", "one two"]
    rows = [(t, 1, 0) for t in [*lone, *copies, *shared]] + [(base, 0, 1)]
    left = [r.text for r in toxicity.without_copies(spark.createDataFrame(rows, "text string, y int, half int")).collect()]
    assert sum(t in copies for t in left) == 1 and set(left) >= {*lone, *shared, base}


def test_toxicity_on_held_out_rows(spark):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{BIG}/labels.parquet").collect()}
    rows = queries.op6_toxicity(spark, BIG).collect()
    assert len(rows) == 10_000 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows)
    judged = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    caught = sum(p and y for p, y in judged) / sum(y for _, y in judged)
    wrong = sum(p and not y for p, y in judged) / sum(not y for _, y in judged)
    assert caught > 0.9 and wrong < 0.01


def test_held_out_labels_are_never_used(spark):
    docs = spark.read.parquet(f"{BIG}/documents.parquet").limit(1500)
    labels = spark.read.parquet(f"{BIG}/labels.parquet")
    turned = labels.selectExpr("doc_id", "quality", "if(crc32(cast(doc_id as string)) % 3 = 1, 1 - toxic, toxic) as toxic")
    score = lambda x: {r.doc_id: round(r.score, 9) for r in toxicity.score(docs, x).collect()}
    assert score(labels) == score(turned)


ODD = [(1, None, "h", "p"), (2, "", None, None), (None, "no id", "h", None), (4, "a " * 50_000, "h", "p"), (4, "a " * 50_000, "h", "p")]


@pytest.mark.parametrize("empty_labels", [True, False])
def test_scores_on_odd_rows(spark, empty_labels):
    docs = spark.createDataFrame(ODD, DOC).selectExpr("*", "1 as score", "2 as evidence", "3 as h", "4 as c0", "5 as y")
    labels = spark.createDataFrame(
        [] if empty_labels else [(1, 1, 0), (2, 0, None), (None, 1, 1), (4, 1, 0), (4, 0, 1)], "doc_id long, quality int, toxic int"
    )
    for module in (toxicity, quality):
        rows = module.score(docs, labels).collect()
        assert len(rows) == 5 and all(0 <= r.score <= 1 for r in rows)
        assert len({r.score for r in rows if r.doc_id == 4}) == 1
        assert module.score(docs.limit(0), labels).count() == 0
    kept = toxicity.without_toxic(docs, labels, 1.1)
    assert kept.columns == docs.columns and kept.exceptAll(docs).count() == 0 and kept.count() == 5
    good = quality.only_good(docs, labels, 0.0)
    assert good.columns == docs.columns and good.exceptAll(docs).count() == 0 and good.count() == 5
    assert quality.only_good(docs, labels, 1.1).count() == 0


def test_quality_on_held_out_rows(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{BIG}/labels.parquet").collect()}
    rows = queries.op9_quality(spark, BIG).collect()
    judged = [(r.keep, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    assert len(rows) == 10_000
    assert np.mean([k == y for k, y in judged]) > 0.97
    assert np.mean([k for k, y in judged if y]) > 0.995


def plain_posteriors(rows):
    """Scores of (evidence, host, path) rows by plain grouping, one document left out at a time."""
    good = [1 / (1 + np.exp(-e)) for e, _, _ in rows]
    host, path = {}, {}
    for g, (_, h, p) in zip(good, rows):
        host.setdefault(h, []).append(g)
        path.setdefault((h, p), []).append(g)
    n, s, k = np.array([len(v) for v in host.values()], float), np.array([sum(v) for v in host.values()]), len(host)
    mean = min(max(s.sum() / n.sum(), 1e-6), 1 - 1e-6)
    between = max((s * s / n).sum() - n.sum() * mean * mean, 0)
    spread = n.sum() - (n * n).sum() / n.sum()
    variance = (between - (k - 1) * mean * (1 - mean)) / spread if spread > 0 else 0
    strength = min(max(mean * (1 - mean) / variance - 1 if variance > 1e-9 else 1000, 1), 1000)
    out = []
    for g, (e, h, p) in zip(good, rows):
        top = (sum(host[h]) + mean * strength) / (len(host[h]) + strength)
        rate = (sum(path[h, p]) - g + quality.PATH_STRENGTH * top) / (len(path[h, p]) - 1 + quality.PATH_STRENGTH)
        shift = np.clip(np.log(rate / (1 - rate)) - np.log(mean / (1 - mean)), -quality.SITE_LIMIT, quality.SITE_LIMIT)
        out.append((top, rate, 1 / (1 + np.exp(-(e + shift)))))
    return out


def test_posteriors_equal_plain_grouping(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "labels"))
    docs = docs.selectExpr("doc_id", "text", "if(doc_id % 3 = 0, 'hot', nullif(source, 'src3')) as source", "lang")
    got = quality.score(docs, labels).collect()
    want = plain_posteriors([(r.evidence, r.host, r.path) for r in got])
    assert len(got) == docs.count() and len({r.host for r in got}) > 5
    assert np.allclose([(r.host_posterior, r.path_posterior, r.score) for r in got], want, atol=1e-9)


def test_words_tell_what_form_doesnt(spark):
    rng = random.Random(9)
    some = lambda words: " ".join(rng.choices(words, k=60)) + "."
    rows = [(i, some("alpha beta gamma delta".split() if i % 2 else "omega sigma kappa theta".split()), "h", "p") for i in range(600)]
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(600)], "doc_id long, quality int, toxic int")
    weights, odds = quality.learn(spark.createDataFrame(rows, DOC), labels)
    evidence = quality.features(["alpha beta gamma " * 20, "omega sigma " * 20], odds) @ weights[:-1] + weights[-1]
    assert evidence[0] > 1 and evidence[1] < -1
    whole = "word " * 300_000 + "end"
    assert len(quality.buckets(whole.encode())) == len(quality.buckets(b"Word END")) == 2


def test_word_means_of_many_texts_at_once(monkeypatch):
    odds = np.random.default_rng(1).normal(size=1 << quality.BUCKET_BITS).astype(np.float32)
    texts = ["one Two", "", "  ", "word " * 300_000 + "end", "é\nà b", "one", *(f"w{k} " * k for k in range(40))]
    one = lambda w: odds[quality.buckets(w.encode())[0]]
    want = [np.mean([one(w) for w in t.split()]) if t.split() else 0 for t in texts]
    assert np.allclose(quality.word_means(texts, odds), want, atol=1e-4)
    monkeypatch.setattr(quality, "PIECE", 20)
    assert np.allclose(quality.word_means(texts, odds), want, atol=1e-4) and len(quality.word_means([], odds)) == 0


def test_sparse_sites_shrink(spark, monkeypatch):
    good, bad = "A plain sentence of some words here.", "$$$ ### %%% &&& *** $$$ ### %%%"
    rng = random.Random(0)
    rows = [(i, good + f" {rng.random()}", f"h{i % 5}", "a") for i in range(500)]
    rows += [(1000 + i, bad + f" {i}", "dump", "a") for i in range(300)] + [(2000, good, "dump", "a"), (2001, good, "tiny", "x")]
    rows += [(3000, bad, "small", "y"), (3001, good, "small", "y")]
    docs = spark.createDataFrame(rows, DOC)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    for sites in (20_000, 0):  # by broadcast and by shuffle
        monkeypatch.setattr(quality, "BROADCAST_SITES", sites)
        got = {r.doc_id: r for r in quality.score(docs, labels).collect()}
        assert len(got) == len(rows)
        overall = np.mean([1 / (1 + np.exp(-r.evidence)) for r in got.values()])
        assert got[1000].host_posterior < got[3000].host_posterior < overall  # one bad document tells less than 300
        assert got[2000].score < got[2001].score  # same text, worse site
        assert abs(got[2001].path_posterior - overall) < abs(got[1000].path_posterior - overall)


def brute_audit(rows):
    """Damaged records by comparing every record of both replicas."""
    def digest(s):
        return hashlib.sha256(s.encode()).hexdigest()

    made = []
    for page_id, url, html, copy in rows:
        body = html or ""
        rec = f"WARC/1.0\r\nWARC-Type: response\r\nWARC-Target-URI: {url or ''}\r\nContent-Length: {len(body.encode())}\r\n\r\n{body}\r\n\r\n"
        made.append((page_id, digest(rec), len(rec.encode()), None if copy is None else digest(rec if copy == "same" else copy), copy))
    made.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    out, start = set(), 0
    for i, (page_id, d, n, other, copy) in enumerate(made):
        start = 0 if i % warc.FILE_RECORDS == 0 else start
        if other != d:
            out.add((page_id, i // warc.FILE_RECORDS, start, n, d, other))
        start += n
    return out


@pytest.mark.parametrize("fanout,size", [(16, 1000), (2, 7), (3, 1)])
def test_audit_finds_exactly_the_damage(spark, monkeypatch, fanout, size):
    monkeypatch.setattr(warc, "FILE_RECORDS", size)
    rng = random.Random(8)
    rows = [(i, f"http://x/{i}", "é" * rng.randrange(30), rng.choice(["same"] * 12 + ["bad", None, "é"])) for i in range(150)]
    rows += [(None, None, None, "bad"), (3, None, "", "same"), (3, None, "", "same"), (200, "u", "y" * 9000, None)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, copy string").selectExpr("*", "1 as digest", "2 as length")
    from pyspark.sql import functions as F

    record = warc.record_bytes(F.col("url"), F.col("html"))
    df = df.withColumn("copy", F.when(F.col("copy") == "same", record).otherwise(F.col("copy")))
    got = {(r.page_id, r.file, r.start, r.length, r.digest, r.replica_digest) for r in warc.fixity(df, fanout).collect()}
    assert got == brute_audit(rows)
    assert warc.fixity(df.limit(0)).count() == 0
    assert warc.fixity(df.withColumn("copy", record)).count() == 0


def test_plan_of_the_audit_doesnt_grow_with_the_levels(spark):
    pages = spark.range(300).selectExpr("id as page_id", "'u' as url", "cast(id as string) as html")
    joins = [warc.fixity(queries.damaged(pages), f)._jdf.queryExecution().optimizedPlan().toString().count("Join ") for f in (16, 2)]
    assert joins[0] == joins[1] <= 3


def test_op8_matches_sql(spark):
    con = duckdb.connect()
    con.execute("create view pages as select * from read_parquet('/root/testdata/sf0.01/pages.parquet')")
    cur = con.execute(queries.oracle_sql()["op8_warc"])
    names = [d[0] for d in cur.description]
    want = {tuple(dict(zip(names, r)).items()) for r in cur.fetchall()}
    got = {tuple(r.asDict().items()) for r in queries.op8_warc(spark, "/root/testdata/sf0.01").collect()}
    assert {frozenset(w) for w in want} == {frozenset(g) for g in got} and got

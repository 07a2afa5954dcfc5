"""Vectors, urls, the pipeline and the registered queries."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.test_texts import plain_line_dedup, plain_near_duplicates
from tests.oracle_check import compare, connect
from vanewright.llm import langid, linededup, oracles, packing, queries, toxicity, urlfilter, vectors

FOLDER = "/root/testdata/sf0.001"


# vectors

def plain_links(rows, similar=0.95):
    usable = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            usable[i] = np.array(v) / np.linalg.norm(v)
    links = {i: {j for j in usable if j != i and len(usable[i]) == len(usable[j]) and usable[i] @ usable[j] >= similar}
             for i in usable}
    group = {i: {i} for i in usable}
    for i in usable:
        for j in links[i]:
            both = group[i] | group[j]
            for k in both:
                group[k] = both
    return {i: (len(links[i]), min(group[i])) for i in usable}


def test_vectors_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(vectors, "BLOCK", 60)
    monkeypatch.setattr(vectors, "SHARD", 80)
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=16).tolist()) for i in range(300)]
    for centre in range(6):
        base = rng.normal(size=16)
        rows += [(1000 + 100 * centre + i, (base + 0.12 * rng.normal(size=16)).tolist()) for i in range(25)]
    rows += [(2000 + i, rows[0][1]) for i in range(5)] + [(2100, [2 * x for x in rows[1][1]])]
    odd = [(3000, None), (3001, []), (3002, [0.0] * 16), (3003, [float("nan")] * 16), (3004, [None] + [1.0] * 15),
           (3005, [1.0, 2.0]), (None, rows[2][1]), (3006, [float("inf")] + [1.0] * 15)]
    table = spark.createDataFrame([(i, v, "x") for i, v in rows + odd], "vec_id long, embedding array<double>, id string")
    found = vectors.near_vectors(table.repartition(3))
    got = {r.vec_id: r for r in found.collect()}
    expected = plain_links(rows + odd[:-2] + odd[-1:])
    assert len(got) == len(rows + odd) and all(not got[i].n_links for i, _ in odd)
    true = sum(n for n, _ in expected.values())
    assert sum(got[i].n_links for i in expected) >= 0.97 * true
    assert all(got[i].n_links <= n for i, (n, _) in expected.items())
    assert all(r.kept == (r.vec_id is not None and r.vec_id == r.component_id) for r in got.values())
    assert np.mean([got[i].component_id == c for i, (_, c) in expected.items()]) >= 0.97
    assert vectors.audit_recall(table, found, every=5) >= 0.97
    assert vectors.near_vectors(table.limit(0)).count() == 0


def groups_in_range(size, others=1000):
    """Two dense groups of 64 dimensions about 0.965 apart, and other vectors."""
    rng = np.random.default_rng(2)
    one, other, *_ = np.linalg.qr(rng.normal(size=(64, 64)))[0]
    groups = [base + 0.003 * rng.normal(size=(size, 64)) for base in (one, 0.966 * one + np.sqrt(1 - 0.966**2) * other)]
    units = np.concatenate([*groups, rng.normal(size=(others, 64))])
    return units / np.linalg.norm(units, axis=1)[:, None]


@pytest.mark.parametrize("size", [20, 30, 60, 200, 500])
def test_search_finds_dense_groups_in_range_of_each_other(size):
    units = groups_in_range(size)
    lists = [np.array(found, np.int64) for found in vectors.build_graph(units)]
    found = vectors.Block(units, lists).search_all(units, vectors.SIMILAR, lists)
    near = units @ units.T >= vectors.SIMILAR
    assert near[:size, size:2 * size].sum() > size * size / 2  # the groups do link
    assert sum(len(f) for f in found) >= 0.999 * near.sum()
    assert all(near[at, f].all() for at, f in enumerate(found))


def test_pruning_leaves_out_shadowed_neighbours():
    units = np.array([[1, 0], [0.99, 0.14], [0.98, 0.2], [0, 1]], np.float64)
    units /= np.linalg.norm(units, axis=1)[:, None]
    near = units @ units.T
    kept = vectors.robust_prune(near[:1, 1:], near[None, 1:, 1:])
    assert kept.tolist() == [[True, False, True]]


@pytest.mark.parametrize("size", [1, 2, 30, 1200])
def test_pruning_together_is_pruning_one_by_one(size):
    units = np.random.default_rng(size).normal(size=(size, 12))
    units /= np.linalg.norm(units, axis=1)[:, None]
    near = units @ units.T
    lists = [set() for _ in units]
    for own in range(size):
        left = [int(o) for o in np.argsort(-near[own], kind="stable") if o != own][:vectors.CANDIDATES]
        for _ in range(vectors.DEGREE):
            if left:
                best = left.pop(0)
                lists[own].add(best)
                lists[best].add(own)
                left = [o for o in left if vectors.ALPHA * (1 - near[best, o]) > 1 - near[own, o]]
    assert [set(found) for found in vectors.build_graph(units)] == lists


# urls

def plain_verdicts(pages, rules):
    """(verdict, share) of every url (id, host, path, rule verdict), template by template."""
    own = {(h, p): [s for s in p.split("/") if s] for _, h, p, _ in pages}
    level = defaultdict(Counter)
    for _, h, p, _ in pages:
        for at, s in enumerate(own[h, p]):
            level[h, at][s] += 1
    def step(h, at, s):
        named = not re.search("[0-9]", s) and len(s) < 24 and 20 * level[h, at][s] >= sum(level[h, at].values())
        return s if named else "*"
    template = {(h, p): tuple(step(h, at, s) for at, s in enumerate(segments)) for (h, p), segments in own.items()}
    nodes = defaultdict(lambda: [0, 0])
    for _, h, p, v in pages:
        for k in range(len(template[h, p]) + 1):
            nodes[h, template[h, p][:k]][0] += v == "block"
            nodes[h, template[h, p][:k]][1] += v is not None
    side, pools = {}, defaultdict(lambda: [0, 0])
    for (h, node), (blocked, labels) in nodes.items():
        if node and labels >= 5:
            above = nodes[h, node[:-1]]
            share = above[0] / above[1]
            if abs(blocked / labels - share) > 2.0 * np.sqrt(share * (1 - share) / labels):
                side[h, node] = (h, node[:-1], blocked / labels > share)
                pools[side[h, node]][0] += blocked
                pools[side[h, node]][1] += labels
    overall = sum(v == "block" for *_, v in pages) / max(1, sum(v is not None for *_, v in pages))
    out = {}
    for i, h, p, v in pages:
        deepest = [k for k in range(1, len(template[h, p]) + 1) if (h, template[h, p][:k]) in side]
        blocked, labels = pools[side[h, template[h, p][:deepest[-1]]]] if deepest else nodes[h, ()]
        rejected = labels and 2 * blocked >= labels and (blocked + 4 * overall) / (labels + 4) >= 0.5
        out[i] = (v or ("block" if rejected else "allow"), "/".join(template[h, p]))
    return out


def judged_by_both(spark, urls, rules):
    """The operator's (verdict, template) by page, and the plain version's."""
    pages = spark.createDataFrame(urls, "page_id int, url string")
    found = urlfilter.judge_urls(pages, rules).collect()
    known = dict(rules)
    plain = plain_verdicts([(r.page_id, r.host, r.path, known.get(r.rule)) for r in found], rules)
    return {r.page_id: (r.verdict, r.template) for r in found}, plain


def test_rules_hosts_and_paths(spark):
    urls = [
        (1, "HTTPS://WWW.Example.COM/en/a?x#y", "www.example.com", "/en/a", "www.example.com/en/", "allow"),
        (2, "http://m.example.com/en/", "m.example.com", "/en/", "example.com/en/", "block"),
        (3, "http://notexample.com/en/x", "notexample.com", "/en/x", "com/", "allow"),
        (4, "http://example.com", "example.com", "", None, "allow"),
        (5, "ftp://a.net/fr/b", "a.net", "/fr/b", "net/fr/", "block"),
        (6, "http://b.net/FR/b", "b.net", "/FR/b", None, "allow"),
        (7, None, "", "", None, "allow"), (8, "no scheme", "", "", None, "allow"), (9, "a\n://x.com/?q", "x.com", "/", "com/", "allow"),
        (9, "a\n://x.com/?q", "x.com", "/", "com/", "allow"), (10, "", "", "", None, "allow"),
    ]
    pages = spark.createDataFrame([(i, u, "own") for i, u, *_ in urls], "page_id int, url string, verdict string")
    judged = urlfilter.judge_urls(pages, queries.URL_RULES)
    assert judged.columns == ["page_id", "url", "verdict", "host", "path", "rule", "verdict_", "template", "share"]
    rows = sorted((r.page_id, r.host, r.path, r.rule or "", r.verdict_) for r in judged.collect())
    assert rows == sorted((i, h, p, r or "", v) for i, _, h, p, r, v in urls)
    assert urlfilter.judge_urls(pages.limit(0), queries.URL_RULES).count() == 0


def test_templates_judge_what_no_rule_fits(spark):
    """Blocked and allowed sections, a section like the blocked one, deep paths, and hosts without labels."""
    urls = [(i, f"http://shop.org/spam/{i}/x") for i in range(40)] + [(100 + i, f"http://shop.org/news/{i}") for i in range(40)]
    urls += [(200 + i, f"http://shop.org/a/b/c/{'good' if i % 2 else 'bad'}/{i}") for i in range(40)]
    urls += [(300, "http://shop.org/else"), (301, "http://other.org/spam/1/x"), (302, "http://" + "deep.org" + "/d" * 300)]
    rules = [(f"shop.org/spam/{i}", "block") for i in range(10, 30)] + [(f"shop.org/news/{i}", "allow") for i in range(10, 30)]
    rules += [(f"shop.org/a/b/c/bad/{i}", "block") for i in range(10, 30, 2)] + [(f"shop.org/a/b/c/good/{i}", "allow") for i in range(11, 30, 2)]
    got, plain = judged_by_both(spark, urls, rules)
    assert got == plain
    assert got[1] == ("block", "spam/*/x") and got[101] == ("allow", "news/*")
    assert got[200] == ("block", "a/b/c/bad/*") and got[201] == ("allow", "a/b/c/good/*")
    assert got[301][0] == got[302][0] == "allow" and got[302][1].count("d") == 300


@pytest.mark.parametrize("seed", range(3))
def test_templates_against_a_plain_version(spark, seed):
    rng = np.random.default_rng(seed)
    words = ["en", "fr", "shop", "blog", "x", "y1", "a" * 30, *(f"w{chr(97 + i)}" for i in range(26))]
    urls, rules = [], set()
    for i in range(1200):
        host = f"h{rng.integers(4)}.org"
        path = "".join("/" + words[min(int(rng.exponential(5)), len(words) - 1)] for _ in range(rng.integers(0, 6)))
        urls.append((i, f"http://{host}{path}"))
        if rng.random() < 0.05 and path and host != "h3.org":
            rules.add((f"{host}{path}", "block" if ("shop" in path) ^ (rng.random() < 0.1) else "allow"))
    rules = list(dict(sorted(rules)).items())
    got, plain = judged_by_both(spark, urls, rules)
    assert got == plain and len({v for v, _ in got.values()}) == 2


# the registered queries and the pipeline

@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, name):
    df = queries.QUERIES[name](spark, FOLDER)
    if name in oracles.ORACLES:
        assert compare(df, connect(FOLDER), oracles.ORACLES[name]) is None
    else:
        table = "embeddings" if "embedding" in name else "documents"
        assert df.count() >= spark.read.parquet(f"{FOLDER}/{table}.parquet").count()


def test_pipeline_against_a_plain_version(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = {r.doc_id: r for r in docs.collect()}
    language = langid.fit_languages(docs)
    kept = {}
    for i, r in rows.items():
        pred, _, _, sure = langid.label_texts([r.text or ""], language)[0]
        if pred != "und" and sure >= corpus_pipeline.LEAST_LANGUAGE:
            kept[i] = r.text
    stages = dict(corpus_pipeline.STAGES)
    first = stages["language"](spark, docs, FOLDER)
    assert first.columns == docs.columns and {r.doc_id: r.text for r in first.collect()} == kept
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    model = toxicity.fit_toxicity(first, labels)
    measured = {i: model.measures(toxicity.folded(t))[:2] for i, t in kept.items()}
    kept = {i: t for i, t in kept.items() if model.scores(np.array([measured[i]]))[0] < corpus_pipeline.TOXIC}
    second = stages["toxicity"](spark, first, FOLDER)
    assert {r.doc_id: r.text for r in second.collect()} == kept
    third = stages["line_dedup"](spark, second, FOLDER)
    kept = {i: t for i, _, _, t in plain_line_dedup(list(kept.items()))}
    assert third.columns == docs.columns and {r.doc_id: r.text for r in third.collect()} == kept
    assert third.where(F.col("n_chars") != F.length("text")).count() == 0
    fourth = stages["near_copies"](spark, third, FOLDER)
    groups = plain_near_duplicates(list(kept.items()), 5, 80)
    kept = {i: kept[i] for i, _, c in groups if i == c}
    assert {r.doc_id: r.text for r in fourth.collect()} == kept
    words = packing.encoder(queries.tokenizer_path("byte_bpe_50k.json"))
    packed = stages["packing"](spark, fourth, FOLDER).groupBy("doc_id").agg(F.sum("length").alias("n")).collect()
    assert {r.doc_id: r.n for r in packed} == {i: len(words.encode(t)) // 4 + 1 for i, t in kept.items()}


def test_pipeline_on_odd_rows(spark, odd_docs, no_docs):
    schema = odd_docs.withColumn("lang", F.lit("en"))
    for docs in (schema, no_docs.withColumn("lang", F.lit("en"))):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, FOLDER)
            if name != "packing":
                assert out.columns == docs.columns
            assert out.count() <= 10 * docs.count()
            docs = out

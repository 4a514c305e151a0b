"""Nearest neighbours and URL judgement against brute force."""

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from blotterlake.llm import hnsw, url_filter
from blotterlake.llm.queries import QUERIES
from blotterlake.llm.url_filter import RULES, Rule

from .conftest import SF

VECTORS = "vec_id long, embedding array<float>, label int"


def exact(ids, vectors, query_ids, k=10):
    out = {}
    for q in query_ids:
        i = ids.index(q)
        distance = np.sqrt(((vectors - vectors[i]) ** 2).sum(1))
        order = [j for j in np.lexsort((ids, distance)) if ids[j] != q][:k]
        out[q] = [(ids[j], distance[j]) for j in order]
    return out


def test_recall_over_whole_table(spark):
    sf = "/root/testdata/sf0.1"
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").collect()
    ids, vectors = [r.vec_id for r in rows], np.array([r.embedding for r in rows], float)
    expected = exact(ids, vectors, [i for i in ids if i % 100 == 0])
    found = {}
    for r in QUERIES["op10_nearest"](spark, sf).collect():
        found.setdefault(r.query_id, {})[r.rank] = (r.vec_id, r.score)
    assert set(found) == set(expected)
    hits = 0
    for q, near in expected.items():
        got = [found[q][i] for i in range(1, 11)]
        assert got == sorted(got, key=lambda x: (x[1], x[0]))
        distance = dict(zip(ids, np.sqrt(((vectors - vectors[ids.index(q)]) ** 2).sum(1))))
        assert all(s == pytest.approx(distance[v], abs=1e-12) for v, s in got)
        hits += len({v for v, _ in near} & {v for v, _ in got})
    assert hits / sum(map(len, expected.values())) >= 0.95


def test_recall_over_many_shards(spark):
    rng = np.random.default_rng(2)
    vectors = rng.normal(0, 1, (3000, 24)).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(vectors)], VECTORS)
    rows = hnsw.usable(df)
    found = hnsw.nearest(rows, hnsw.query_rows(rows, 50), shard_rows=400, ef=60).collect()
    expected = exact(list(range(3000)), vectors.astype(float), range(0, 3000, 50))
    hits = sum((r.vec_id in {v for v, _ in expected[r.query_id]}) for r in found)
    assert len(found) == 600 and hits / 600 >= 0.95


def test_vectors_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0], 0), (1, [1.0, 0.5], 0), (2, [0.0, 0.0], 0), (3, None, 0), (4, [nan, 1.0], 0), (5, [inf, 1.0], 0), (6, [None, 1.0], 0),
        (7, [], 0), (None, [1.0, 1.0], 0), (8, [1.0, 0.5], 0), (8, [9.0, 9.0], 0), (9, [1.0, 2.0, 3.0], 0), (100, [1.0, 0.5], 0), (200, [0.0, 0.0], 0),
    ]
    df = spark.createDataFrame(rows, VECTORS).withColumn("shard", F.lit("x")).withColumn("dim", F.lit("x"))
    usable = hnsw.usable(df)
    assert sorted(r.vec_id for r in usable.collect()) == [0, 1, 8, 9, 100]
    found = [tuple(r) for r in hnsw.nearest(usable, hnsw.query_rows(usable)).collect()]
    assert sorted(found) == [
        (0, 1, 1, 0.5), (0, 2, 8, 0.5), (0, 3, 100, 0.5), (100, 1, 1, 0.0), (100, 2, 8, 0.0), (100, 3, 0, 0.5),
    ]
    empty = hnsw.usable(df.limit(0))
    assert hnsw.nearest(empty, hnsw.query_rows(empty)).collect() == []


def test_equal_vectors_fill_a_shard(spark):
    df = spark.createDataFrame([(i, [1.0, 1.0] if i < 150 else [2.0, float(i)], 0) for i in range(200)], VECTORS)
    rows = hnsw.usable(df)
    found = [(r.query_id, r.vec_id, r.score) for r in hnsw.nearest(rows, hnsw.query_rows(rows)).orderBy("query_id", "rank").collect()]
    assert len(found) == 20 and all(score == 0 for _, _, score in found)


def test_recall_with_a_third_of_the_rows_equal(spark):
    """By vec_id, for queries that are copies and for the others."""
    rng = np.random.default_rng(4)
    centres = rng.normal(0, 1, (20, 32))
    vectors = (centres[rng.integers(0, 20, 3000)] + rng.normal(0, 0.3, (3000, 32))).astype(np.float32)
    copies = rng.random(3000) < 1 / 3
    vectors[copies] = vectors[0]
    df = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(vectors)], VECTORS)
    rows = hnsw.usable(df)
    expected = exact(list(range(3000)), vectors.astype(float), range(0, 3000, 10))
    found = {}
    for r in hnsw.nearest(rows, hnsw.query_rows(rows, 10)).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    recall = {q: len({v for v, _ in near} & found[q]) / 10 for q, near in expected.items()}
    of_copies = [x for q, x in recall.items() if copies[q]]
    others = [x for q, x in recall.items() if not copies[q]]
    print("recall of copies", np.mean(of_copies), "of others", np.mean(others))
    assert np.mean(of_copies) == 1 and np.mean(others) >= 0.95


# ---- URLs ---------------------------------------------------------------------------------


def split(url):
    if url is None or "://" not in url:
        return "", ""
    host, path = re.match(r"([^/?#]*)([^?#]*)", url.split("://", 1)[1], re.S).groups()
    return re.sub("[A-Z]", lambda m: m[0].lower(), host), path


def rule_for(host, path):
    fitting = [r for r in RULES if host and (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fitting, key=lambda r: len(r.text), default=None)


def plain_ranks(pages, damping=0.85):
    """Fixed point by dense matrices."""
    judged = [(split(p[1])[0], rule_for(*split(p[1]))) for p in pages]
    links = {}
    for (_, _, html), (host, _) in zip(pages, judged):
        for target in re.findall(r"""<a\s[^>]*?href\s*=\s*["']?\s*(?:https?:)?//([^/?#"'\s>]+)""", html or "", re.I):
            if host and host != target.lower():
                links[(host, target.lower())] = links.get((host, target.lower()), 0) + 1
    hosts = sorted({h for h, _ in judged if h} | {h for pair in links for h in pair})
    at = {h: i for i, h in enumerate(hosts)}
    matrix = np.zeros((len(hosts), len(hosts)))
    for (a, b), n in links.items():
        matrix[at[a], at[b]] = n
    forward = np.divide(matrix, matrix.sum(1, keepdims=True), out=np.zeros_like(matrix), where=matrix.sum(1, keepdims=True) > 0)
    backward = np.divide(matrix, matrix.sum(0, keepdims=True), out=np.zeros_like(matrix), where=matrix.sum(0, keepdims=True) > 0)
    seeds = {v: np.zeros(len(hosts)) for v in ("allow", "block")}
    for h, i in at.items():
        own = [r for host, r in judged if host == h]
        for v in seeds:
            seeds[v][i] = sum(r is not None and r.verdict == v for r in own) / len(own) if own else 0
    one = np.eye(len(hosts))
    trust = np.linalg.solve(one - damping * forward.T, (1 - damping) * seeds["allow"])
    distrust = np.linalg.solve(one - damping * backward, (1 - damping) * seeds["block"])
    return {h: (trust[i], distrust[i]) for h, i in at.items()}


def check_pages(pages, found):
    ranks = plain_ranks(pages)
    expected = []
    for page_id, url, _ in pages:
        host, path = split(url)
        rule = rule_for(host, path)
        trust, distrust = ranks.get(host, (0, 0))
        verdict = rule.verdict if rule else "block" if distrust - trust > url_filter.THRESHOLD else "allow"
        expected.append(repr((page_id, host, path, rule and rule.text, verdict)))
    assert sorted(repr((r.page_id, r.host, r.path, r.rule, r.verdict)) for r in found) == sorted(expected)
    for r in found:
        if r.host:
            assert (r.trust, r.distrust) == pytest.approx(ranks[r.host], abs=1e-7)


def test_url_query(spark):
    pages = [tuple(r) for r in spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url", "html").collect()]
    check_pages(pages, QUERIES["op2_url_filter"](spark, SF).collect())


def test_trust_and_distrust_flow_along_links(spark):
    link = lambda *hosts: "".join(f'<p><A class=x\nhref="http://{h}/p?q">t</a>' for h in hosts)
    pages = [
        (1, "http://good.org/fr/1", link("friend.com", "friend.com", "far.com")), (2, "http://friend.com/a", link("deep.com")),
        (3, "http://evil.net/x", link("victim.com")), (4, "http://pusher.com/", link("evil.net", "evil.net")), (5, "HTTP://Boss.Pusher2.com", link("pusher.com")),
        (6, "no url", link("evil.net")), (7, None, None), (8, "x://", "<a href=/own>"), (9, "http://EXAMPLE.net/en/x?y#z", link("self.com")),
        (10, "http://a.example.net", link("b.example.net")), (11, "http://example.com/de", None), (12, "ftp://sub.example.com/de/", ""), (12, "http://friend.com/a", None),
        (None, "http://net/", None), (13, "http://q.com?x=http://evil.net/", '<a href="https://evil.net">'), (14, "http://r.com#http://", "<a href='//evil.net/'>"),
    ]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("host", F.lit("x")).withColumn("trust", F.lit("x"))
    found = url_filter.judge(df).collect()
    check_pages(pages, found)
    verdicts = {r.page_id: r.verdict for r in found}
    assert verdicts[4] == "block" and verdicts[2] == "allow"
    assert url_filter.judge(df.limit(0)).collect() == []


def test_longest_of_many_rules(spark):
    rules = (Rule("com", "/", "block"), Rule("a.com", "/", "allow"), Rule("a.com", "/x/", "block"), Rule("bb.a.com", "/", "allow"))
    pages = [(i, u, None) for i, u in enumerate(["http://a.com/", "http://a.com/x/y", "http://bb.a.com/x/y", "http://c.a.com/x/", "http://z.com/", "http://com", "http://acom/x"])]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    assert {r.page_id: r.rule for r in url_filter.judge(df, rules).collect()} == {
        0: "a.com/", 1: "a.com/x/", 2: "bb.a.com/", 3: "a.com/x/", 4: "com/", 5: None, 6: None,
    }

"""Dual-tree search against scoring every pair."""
import math
import random
import re
from collections import Counter

import numpy as np
import pytest

import __spark_entry__ as E
from veilspark.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, k):
    rows = [(i, Counter(terms(t))) for i, t in docs]
    rows = [(i, c, sum(c.values())) for i, c in rows if c]
    n_docs, length = len(rows), sum(n for _, _, n in rows)
    df = Counter(t for _, c, _ in rows for t in c)
    own = {}
    for i, t in items:
        own.setdefault(i, set()).update(terms(t))
    out = []
    for item, ts in own.items():
        w = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) for t in ts}
        found = []
        for i, c, n in rows:
            m = 100 - 90 + (90 * n * n_docs) // length
            s = sum(w[t] * ((1_000_000_000 * c[t]) // (1000 * c[t] + 8 * m)) for t in ts if t in c)
            if s > 0:
                found.append((-s, i is None, i))
        found.sort(key=lambda x: x[:2] if x[1] else x)
        out += [(item, r, i, -s) for r, (s, _, i) in enumerate(found[:k], 1)]
    return sorted(out, key=repr)


def got(spark, docs, items, k=3, kind="long", **more):
    d = spark.createDataFrame([(i, t, 1, 2) for i, t in docs], f"doc_id {kind}, text string, score int, item_id int").repartition(4)
    q = spark.createDataFrame([(i, t, 9) for i, t in items], "item_id long, text string, rank int").repartition(2)
    out = lexical.search(d, q, k, **more)
    assert out.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted((tuple(r) for r in out.collect()), key=repr)


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(5)
    words = [f"w{i}" for i in range(60)]
    docs = [(i, " ".join(rng.choices(words, weights=[1 / (j + 1) for j in range(60)], k=rng.randint(1, 40)))) for i in range(400)]
    docs += [(1000 + i, "W3 w7, Été w59 w58") for i in range(50)]  # copies: ties by id
    docs += [(2000, None), (2001, ""), (2002, "... ##"), (None, "w3 w7 été"), (5, docs[5][1]), (5, docs[5][1]), (3000, "w1 " * 5000)]
    items = [(i, " ".join(rng.sample(words, 6))) for i in range(30)]
    items += [(100, "w3 w7 été"), (101, None), (102, "absent"), (103, ""), (104, "ÉTÉ"), (105, "w3"), (105, "w7"), (None, "w9 w10"), (2, items[2][1])]
    return docs, items


def test_every_pair(spark, corpus):
    docs, items = corpus
    assert got(spark, docs, items) == brute(docs, items, 3)
    assert got(spark, docs, items, k=1000) == brute(docs, items, 1000)


def test_in_passes(spark, corpus):
    docs, items = corpus
    assert got(spark, docs, items, terms_a_pass=40) == brute(docs, items, 3)


def test_empty_tables_and_text_ids(spark):
    assert got(spark, [], [(1, "a")]) == [] and got(spark, [(1, "a")], []) == []
    assert got(spark, [("b", "x y"), ("a", "x y")], [(1, "x")], kind="string") == brute([("b", "x y"), ("a", "x y")], [(1, "x")], 3)


def test_terms(spark):
    texts = ["A-b_c", "İ ẞ É", "x\x7fy", "漢字 5%", "", None]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, text string").select("i", lexical.terms_column(lexical.F.col("text")).alias("t")).collect()
    for r in rows:
        assert r["t"] == terms(texts[r["i"]]) == [x.decode() for x in lexical.terms_of((texts[r["i"]] or "").encode())]


def test_bounds_prune_and_lose_nothing():
    """Documents of separate topics: whole leaves are passed over, and the best are those of all pairs."""
    rng = np.random.default_rng(3)
    weights = np.full(200, 1000, dtype=np.int64)
    items = [np.arange(t * 10, t * 10 + 5) for t in range(20)]
    n = 2048
    docs = [(np.sort(rng.choice(np.arange(d % 20 * 10, d % 20 * 10 + 10), 4, replace=False)), rng.integers(1, 9, 4)) for d in range(n)]
    search = lexical.Search(items, weights, n, n * 20, 5, np.zeros(20, dtype=np.int64))
    search.batch(list(range(n)), [20] * n, [t for t, _ in docs], [f for _, f in docs])
    want = []
    for j, item in enumerate(items):
        scores = sorted((-int(lexical._additions(t, f, weights, 20, n, n * 20)[np.isin(t, item)].sum()), i) for i, (t, f) in enumerate(docs))
        want += [(j, i, -s) for s, i in scores[:5] if s < 0]
    assert sorted(search.results()) == sorted(want)
    assert search.pairs_scored < n * len(items) / 5


def test_beyond_64_bits():
    big = lexical._additions(np.array([0]), np.array([3]), np.array([7]), 10 ** 12, 10 ** 12, 10 ** 3)
    m = 10 + 90 * 10 ** 24 // 10 ** 3
    assert big.tolist() == [7 * (3_000_000_000 // (3000 + 8 * m))]


def test_query_against_every_pair(spark, sf_dir):
    read = lambda name, key: [tuple(r) for r in spark.read.parquet(f"{sf_dir}/{name}.parquet").select(key, "text").collect()]
    rows = E.queries()["op12_lexical_search"](spark, sf_dir).collect()
    assert sorted(map(tuple, rows), key=repr) == brute(read("documents", "doc_id"), read("benchmark", "item_id"), 10)

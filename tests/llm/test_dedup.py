"""Exact, line and near dedup on small tables, against brute force."""
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from veilspark.llm import exactdedup, linededup, minhash
from veilspark.llm.graph import components

SCHEMA = "doc_id long, text string"


def frame(spark, rows, schema=SCHEMA):
    return spark.createDataFrame(rows, schema).repartition(3)


# exact ------------------------------------------------------------------------------------

def test_exact_edges(spark):
    rows = [(1, "a"), (2, "a"), (2, "a"), (3, None), (4, ""), (None, "b"), (None, "b"), (5, "b"), (6, "long" * 5000),
            (7, "long" * 5000 + "x"), (8, "long" * 5000), (None, "solo")]
    got = exactdedup.exact_dedup(frame(spark, rows), prefix_chars=8).collect()
    assert len(got) == len(rows)
    kept = {(r["doc_id"], r["group_size"]) for r in got if r["kept"]}
    assert kept == {(2, 3), (4, 2), (5, 3), (8, 2), (7, 1), (None, 1)}
    assert sum(r["kept"] for r in got) == 6  # the repeated (2, "a") stays once
    assert all(r["keep_id"] == 2 for r in got if r["group_size"] == 3 and r["doc_id"] in (1, 2))


def test_exact_empty_table_and_other_columns(spark):
    docs = frame(spark, [(1, "a", 3, "k")], "doc_id long, text string, bytes int, prefix string")
    assert exactdedup.exact_dedup(docs).count() == 1
    assert exactdedup.exact_dedup(docs.limit(0)).count() == 0


def test_prefix_hash_separates_and_full_hash_decides(spark):
    rows = [(1, "x" * 300 + "a"), (2, "x" * 300 + "b"), (3, "x" * 300 + "a")]
    got = {r["doc_id"]: (r["keep_id"], r["kept"]) for r in exactdedup.exact_dedup(frame(spark, rows), prefix_chars=16).collect()}
    assert got == {1: (3, False), 2: (2, True), 3: (3, True)}


# lines ------------------------------------------------------------------------------------

def test_lines_by_site(spark):
    menu = "Home | About"
    rows = [(i, f"{menu} \nown {i}\n\n{menu}", "h1", i) for i in range(20)]
    rows += [(100 + i, f"{menu if i < 1 else 'plain'}\nown {i}", "h2", i) for i in range(50)]
    rows += [(200, None, None, 0), (201, "", None, 0), (202, f"{menu}\nx", None, 0)]
    docs = frame(spark, rows, "doc_id long, text string, source string, host_ long")
    got = {r["doc_id"]: r for r in linededup.drop_boilerplate(docs, ratio=0.5, min_pages=5, dropped_col="gone").collect()}
    assert got[3]["text"] == "own 3\n" and got[3]["gone"] == 2 and got[3]["host_"] == 3
    assert got[100]["text"] == f"{menu}\nown 0"        # one page of 50
    assert got[101]["text"] == "own 1"                 # 'plain' is on 49 of 50
    assert got[200]["text"] is None and got[201]["text"] == "" and got[202]["text"] == f"{menu}\nx"
    assert linededup.drop_boilerplate(docs.limit(0)).count() == 0


def test_a_line_twice_on_a_page_counts_once(spark):
    rows = [(i, "twice\ntwice\nown" + str(i), "h") for i in range(4)] + [(9 + i, f"z{i}", "h") for i in range(6)]
    docs = frame(spark, rows, "doc_id long, text string, source string")
    share = linededup.boilerplate_lines(docs, ratio=0.1, min_pages=2).collect()
    assert [(r["pages"], r["host_pages"]) for r in share] == [(4, 10)]


def test_copies_keep_their_text(spark):
    menu = "Home | About"
    copy = f"{menu}\nthe text of\nmany copies"
    rows = [(i, copy, "h") for i in range(60)] + [(100 + i, f"{menu}\nown {i}", "h") for i in range(90)]
    rows += [(300 + i, f"{'prose again' if i < 6 else 'x'}{i if i >= 6 else ''}\nown {i}", "g") for i in range(120)]
    got = {r["doc_id"]: r["text"] for r in linededup.drop_boilerplate(frame(spark, rows, "doc_id long, text string, source string")).collect()}
    assert all(got[i] == "the text of\nmany copies" for i in range(60)) and got[100] == "own 0"
    assert got[300] == "prose again\nown 0"  # in 5 % of the texts


def test_small_hosts_lose_their_boilerplate(spark):
    rows = [(i, f"menu\nown {i}", "five") for i in range(5)]
    rows += [(100 + i, f"{'menu' if i < 9 else 'plain' + str(i)}\nown {i}", "fifty") for i in range(50)]
    rows += [(200, "menu\nonly", "one")]
    got = {r["doc_id"]: r["text"] for r in linededup.drop_boilerplate(frame(spark, rows, "doc_id long, text string, source string")).collect()}
    assert [got[i] for i in (0, 4, 100, 108, 109)] == ["own 0", "own 4", "own 0", "own 8", "plain9\nown 9"]
    assert got[200] == "menu\nonly"


def test_host_of(spark):
    urls = ["http://A.example.org/x", "https://u:p@b.org:80?q", "mailto:x", None]
    got = spark.createDataFrame([(u,) for u in urls], "url string").select(linededup.host_of(F.col("url")).alias("h"))
    assert [r["h"] for r in got.collect()] == ["a.example.org", "b.org", None, None]


# near -------------------------------------------------------------------------------------

def brute_classes(texts, words=5, least=0.8):
    """Classes of the counted shingles by comparing all pairs."""
    sets = []
    for t in texts:
        w = re.findall(r"[a-z0-9_\x80-\U0010ffff]+", (t or "").lower())
        n = min(words, len(w))
        sets.append(Counter(tuple(w[i:i + n]) for i in range(len(w) - n + 1)) if w else Counter())
    label = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if sets[i] and sets[j] and (sets[i] & sets[j]).total() >= least * (sets[i] | sets[j]).total():
                a, b = label[i], label[j]
                label = [min(a, b) if x in (a, b) else x for x in label]
    return label


def copies(rng, n_base=12):
    words = [f"w{i}" for i in range(400)]
    out = []
    for _ in range(n_base):
        base = [rng.choice(words) for _ in range(rng.choice([6, 30, 120]))]
        out.append(" ".join(base))
        for _ in range(rng.choice([0, 2, 9])):
            v = list(base)
            for _ in range(rng.randint(0, max(1, len(v) // 50))):
                v[rng.randrange(len(v))] = rng.choice(words)
            out.append(" ".join(v) + rng.choice(["", ".", " !"]))
    return out


def test_near_groups_are_those_of_brute_force(spark):
    texts = copies(random.Random(5)) + [None, "", "a b", "A B!", "...", "one"]
    got = {r["doc_id"]: r for r in minhash.near_groups(frame(spark, list(enumerate(texts)))).collect()}
    assert [got[i]["class_id"] for i in range(len(texts))] == brute_classes(texts)
    assert all(got[i]["kept"] == (got[i]["class_id"] == i) for i in got)


def test_near_groups_on_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = sorted(docs.select("doc_id", "text").collect())
    got = {r["doc_id"]: r["class_id"] for r in minhash.near_groups(docs).collect()}
    assert [got[r["doc_id"]] for r in rows] == [rows[k]["doc_id"] for k in brute_classes([r["text"] for r in rows])]


def test_near_dedup_keeps_columns_repeats_once_and_null_ids(spark):
    t = " ".join(f"w{i}" for i in range(60))
    rows = [(1, t, "k", 1), (1, t, "k", 1), (None, t + " x", "k", 2), (2, "other words stand here today", "k", 3),
            (None, None, None, 4), (None, "", None, 5)]
    docs = frame(spark, rows, "doc_id long, text string, key_ string, gone_id_ long")
    got = minhash.near_dedup(docs)
    assert got.columns == docs.columns
    assert sorted((r["doc_id"] or -1, r["gone_id_"]) for r in got.collect()) == [(-1, 4), (-1, 5), (1, 1), (2, 3)]
    assert minhash.near_dedup(docs.limit(0)).count() == 0


@pytest.mark.parametrize("rounds", [0, 1])
def test_blocks_leave_no_link_out(spark, monkeypatch, rounds):
    """Buckets with several classes: bands of one row make nearly everything meet, in blocks of a few."""
    monkeypatch.setattr(minhash, "ROUNDS", rounds)
    monkeypatch.setattr(minhash, "BLOCK", 4)
    texts = copies(random.Random(8), 6)
    s = minhash.Settings(bands=24, rows=1)
    got = {r["doc_id"]: r["class_id"] for r in minhash.near_groups(frame(spark, list(enumerate(texts))), settings=s).collect()}
    assert [got[i] for i in range(len(texts))] == brute_classes(texts)


def test_a_round_makes_one_row_per_text(spark):
    """Forty texts that share twelve buckets: each meets one head, the same few in all buckets."""
    rows = [(b, bytes([i]), bytes([i]), bytes([0])) for b in range(12) for i in range(40)]
    pool = spark.createDataFrame(rows, "band long, same binary, component binary, main binary").repartition(3)
    pairs = minhash._one_head_each(pool, 0).collect()
    assert len(pairs) == 39 and len({bytes(p["b"]) for p in pairs}) == 1


def test_buckets_with_the_same_members_are_one(spark):
    rows = [(1, b"x", [1, 2, 3]), (2, b"y", [1, 2, 4]), (3, b"z", [3, 5]), (4, b"z", [3, 5]), (5, None, [])]
    sketches = spark.createDataFrame(rows, "id long, same binary, bands array<long>")
    got = sorted((r["band"], bytes(r["same"])) for r in minhash._buckets(sketches).collect())
    assert got == [(1, b"x"), (1, b"y"), (3, b"x"), (3, b"z")]


@pytest.mark.parametrize("weights", ["set", "count"])
def test_alike_matrix_is_pairwise_similarity(weights):
    sets = [minhash.shingles(t) for t in copies(random.Random(3), 8)]
    s = minhash.Settings(weights=weights)
    want = [[minhash.similarity(a, b, weights) >= s.similarity for b in sets] for a in sets]
    assert (minhash._alike_matrix(sets, s) == np.array(want)).all()


@pytest.mark.parametrize("weights", ["set", "count"])
def test_signatures_estimate_similarity(weights):
    rng = np.random.default_rng(2)
    a = np.unique(rng.integers(-2**62, 2**62, 800))
    w = {x: float(c) for x, c in zip(a, rng.integers(1, 5, len(a)))}
    x, y = a[:600], a[100:]
    one = lambda k: (k, np.ones(len(k)) if weights == "set" else np.array([w[i] for i in k]))
    sig = minhash.signatures([one(x), one(y)], 2048)
    truth = minhash.similarity(one(x), one(y), weights)
    assert abs((sig[0] == sig[1]).mean() - truth) < 0.05


def test_one_shingle_texts_have_full_signatures():
    for k in range(200):
        assert (minhash.signatures([(np.array([k]), np.ones(1))], 64) != 0).all()


# components -------------------------------------------------------------------------------

def test_components_of_chains_and_hubs(spark):
    rng = random.Random(1)
    links = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 50)] + [(200, 201), (201, 201), (201, 200)]
    rng.shuffle(links)
    got = dict(components(frame(spark, links, "a long, b long")).collect())
    assert got == {**{i: 0 for i in range(61)}, **{100 + i: 100 for i in range(50)}, 200: 200, 201: 200}
    assert components(frame(spark, links, "a long, b long").limit(0)).count() == 0

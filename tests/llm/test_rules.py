"""Quality rules against plain Python: base measures and the n-gram ratio."""
import math
import random
import re
from collections import Counter

import pytest
import xxhash
from pyspark.sql import functions as F

import __spark_entry__ as E
from veilspark.llm import rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    text = text or ""
    words, seen, dup = WORD.findall(text), set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    wins = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    n = Counter(wins)
    held = {i + k for i, w in enumerate(wins) if n[w] > 1 for k in range(3)}
    failed = len(words) < 50 or 100 * len(held) > 50 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(held), failed


def place(kind, *words):
    h = 42
    for w in words:
        h = xxhash.xxh64_intdigest(w.encode(), seed=h)
    return kind * rules.SLOTS + (h - (1 << 64) if h >> 63 else h) % rules.SLOTS


def grams(text):
    words = WORD.findall(text or "")
    out = [place(0, w) for w in words] + [place(2, w[-2:]) for w in words]
    return out + [rules.SLOTS if a == b else place(1, a, b) for a, b in zip(words, words[1:])]


def verdicts(docs, trusted):
    raw, good = Counter(), Counter()
    for i, text in docs:
        g = grams(text)
        raw.update(g)
        if i in trusted:
            good.update(g)
    size = lambda c, k: sum(n for p, n in c.items() if p // rules.SLOTS == k)
    all_raw, all_good = [size(raw, k) for k in range(3)], [size(good, k) for k in range(3)]

    def ratio(p):
        k = p // rules.SLOTS
        if not all_good[k]:
            return 0
        x = (math.log((good[p] + 1) / (all_good[k] + rules.SLOTS)) - math.log((raw[p] + 1) / (all_raw[k] + rules.SLOTS))) * 1e6
        return math.floor(abs(x) + 0.5) * (1 if x > 0 else -1)

    out = []
    for i, text in docs:
        b = base(text)
        g = grams(text)
        mean = sum(map(ratio, g)) / (len(g) * 1e6) if g else None
        out.append((i, *b, mean, not b[5] and (mean or 0) >= rules.LEAST_RATIO))
    return out


def same(rows, want):
    assert len(rows) == len(want)
    for r, w in zip(sorted(rows, key=repr), sorted(want, key=repr)):
        assert r[:7] == w[:7] and r[8] == w[8]
        assert (r[7] is None and w[7] is None) or r[7] == pytest.approx(w[7], abs=1e-6)


GOOD = "a plain story of people who walk along the river and talk about the weather of the day number {} until dark"
TEXTS = [None, "", " \n\t ", "one", "two words", "a a a", "a a a a", "a b c a b c", "x y\nx y\n\n \nx y\nz", "p|q <r> #1 $2 50% &c *d",
         "same line\r\nsame line\r\nsame line", "a\x0bb\x0cc\x1cd e f　g", "é ü 漢 🙂", "w " * 5000,
         " ".join(f"u{i}" for i in range(30_000)), " ".join(f"n{i % 700}" for i in range(2000)),
         "A!! B!! C!! " * 20, "\n".join(GOOD.format(i) for i in range(9))]


@pytest.fixture(scope="module")
def docs():
    rng = random.Random(1)
    story, noise = GOOD.split(), ["###", "$$$", "%%&", "&&|", "|", "!!>", "<*", "@@#"]
    out = list(enumerate(TEXTS)) + [(100 + i, " ".join(rng.choices(story, k=80))) for i in range(30)]
    return out + [(200 + i, " ".join(rng.choices(noise, k=70))) for i in range(5)] + [(None, "null id"), (101, out[19][1])]


def frame(spark, docs):
    return spark.createDataFrame([(i, t, 1, "x") for i, t in docs], "doc_id long, text string, n_words int, words string").repartition(3)


def test_base_measures(spark, docs):
    got = rules.base_measures(frame(spark, docs)).drop("words").collect()
    assert sorted(map(tuple, got), key=repr) == sorted(((i, *base(t)) for i, t in docs), key=repr)


def test_verdicts(spark, docs):
    labels = spark.createDataFrame([(100 + i, 1, 0) for i in range(15)] + [(200, 0, 0), (None, 1, 0), (100, 1, 0), (3, None, 1)],
                                   "doc_id long, quality int, toxic int")
    got = [tuple(r) for r in rules.quality_rules(frame(spark, docs), labels).collect()]
    want = verdicts(docs, {100 + i for i in range(15)})
    same(got, want)
    kept = {r[0] for r in got if r[8]}
    assert {100 + i for i in range(30)} <= kept and not kept & {200, 201, 202, 203, 204}


def test_without_trusted_documents_base_rules_decide(spark, docs):
    got = rules.quality_rules(frame(spark, docs), spark.createDataFrame([], "doc_id long, quality int")).collect()
    assert all(r["kept"] == (not r["base_failed"]) and r["ratio"] in (0, None) for r in got)


def test_empty_table_text_ids_and_native_plan(spark, docs):
    labels = spark.createDataFrame([("k1", 1)], "doc_id string, quality int")
    text = frame(spark, docs).withColumn("doc_id", F.concat(F.lit("k"), F.col("doc_id").cast("string")))
    out = rules.quality_rules(text, labels)
    assert out.count() == len(docs)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
    assert rules.quality_rules(text.limit(0), labels).count() == 0


def test_the_list_of_trusted_ids_is_bounded(spark):
    labels = spark.range(5000).select(F.col("id").alias("doc_id"), F.lit(1).alias("quality"))
    assert 300 < rules.trusted_ids(labels, bound=500).count() < 700
    assert rules.trusted_ids(labels, bound=5000).count() == 5000


def test_query_against_plain(spark, sf_dir):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    good = {r["doc_id"] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").where("quality = 1").collect()}
    same([tuple(r) for r in E.queries()["op13_quality_rules"](spark, sf_dir).collect()], verdicts(docs, good))

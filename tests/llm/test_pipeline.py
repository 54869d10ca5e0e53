"""The whole pipeline, row for row, against plain Python over the same documents."""
import base64
import hashlib
import math
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import tiktoken
from test_dedup import brute_classes

import corpus_pipeline
from veilspark.llm import linededup, mixing, quality


def good(docs, model):
    def score(text):
        at, x = quality.features(text or "")
        return 1 / (1 + math.exp(-float(x @ model.weights[at])))
    return [d for d in docs if score(d["text"]) >= quality.KEEP_SCORE]


def without_boilerplate(docs):
    texts = defaultdict(set)
    for d in docs:
        texts[d["source"]].add(d["text"])
    bare = lambda line: line.strip(" \t\r")
    gone = {}
    for source, own in texts.items():
        n = Counter(line for t in own if t is not None for line in {bare(x) for x in t.split("\n")} if line)
        gone[source] = {line for line, k in n.items() if k >= linededup.MIN_PAGES and k / len(own) > linededup.RATIO}
    out = []
    for d in docs:
        text = d["text"]
        if text is not None:
            text = "\n".join(x for x in text.split("\n") if bare(x) not in gone[d["source"]])
        out.append(d | {"text": text})
    return out


def one_of_each(docs):
    docs = sorted(docs, key=lambda d: d["doc_id"])
    return [d for i, (d, c) in enumerate(zip(docs, brute_classes([d["text"] for d in docs]))) if c == i]


def kind(text, tokens):
    if not tokens:
        return "empty"
    if text.count("|") * 5 > tokens:
        return "table"
    if sum(text.count(c) for c in "#$%") > tokens:
        return "noise"
    if text.count("!") > tokens:
        return "shouting"
    return "note" if tokens < 150 else "article" if tokens < 1000 else "book"


def drawn(docs):
    rows = []
    for d in docs:
        n = len(re.findall(r"[^ \t\r\n]+", d["text"] or ""))
        rows.append((d, n, (d["source"] or mixing.NONE, d["lang"] or mixing.NONE, kind(d["text"] or "", n))))
    tokens = Counter()
    for _, n, cell in rows:
        tokens[cell] += n
    total, weight = sum(tokens.values()), {c: float(n) for c, n in tokens.items()}
    share = []
    for k in range(3):
        own = Counter()
        for c, n in tokens.items():
            own[c[k]] += n
        power = {v: n ** mixing.POWER for v, n in own.items() if n}
        share.append({v: x / sum(power.values()) for v, x in power.items()})
    for _ in range(mixing.ROUNDS):
        for k in range(3):
            now = Counter()
            for c, w in weight.items():
                now[c[k]] += w
            weight = {c: w * share[k][c[k]] * total / now[c[k]] if now[c[k]] > 0 else w for c, w in weight.items()}
    ratio = {c: weight[c] / n if n else 1.0 for c, n in tokens.items()}
    scale = min(mixing.BUDGET, 1 / max(r for c, r in ratio.items() if tokens[c]))
    out = []
    for d, _, cell in rows:
        u = int(hashlib.md5(f"{d['doc_id']}|{mixing.SEED}".encode()).hexdigest()[:8], 16) / 2 ** 32
        if u < min(1.0, ratio[cell] * scale):
            out.append(d)
    return out


def test_pipeline_row_for_row(spark, sf_dir):
    docs = [r.asDict() for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    model = quality.fit(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    sizes = [len(docs)]
    for step in (lambda d: good(d, model), without_boilerplate, one_of_each, drawn):
        docs = step(docs)
        sizes.append(len(docs))
    assert sizes[0] > sizes[1] == sizes[2] > sizes[3] > sizes[4] > 0
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_50k.tiktoken"), "rb"))}
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = {}
    for d in docs:
        ids = np.array(enc.encode_ordinary(d["text"] or ""), dtype="<u4")
        want[d["doc_id"]] = (len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256((d["text"] or "").encode()).hexdigest())
    got = corpus_pipeline.run(spark, sf_dir).collect()
    assert {r["doc_id"]: tuple(r)[1:] for r in got} == want and len(got) == len(want)


def edge_table(spark, sf_dir):
    """Documents with nulls in any column, empty and long texts, repeated rows, and more columns with awkward names."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [tuple(r) for r in docs.limit(40).collect()]
    rows += [rows[0], rows[0], (9001, None, "en", "src1", None), (9002, "", None, None, 0), (None, "no id here", None, "src2", 10),
             (None, None, None, None, None), (9003, "word " * 20_000, "en", "src1", 100_000), (9004, "...", "en", "src1", 3)]
    full = spark.createDataFrame(rows, docs.schema)
    return full.selectExpr("*", "1 AS score", "'x' AS tokens", "2 AS key_", "3 AS host_", "4 AS p", "5 AS prediction_", "6 AS kept")


def test_every_stage_takes_awkward_tables(spark, sf_dir):
    docs = edge_table(spark, sf_dir)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf_dir)
        rows = out.collect()
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == docs.columns and len(rows) <= docs.count(), name
        else:
            assert len(rows) == docs.count()
            assert all(r["n_tokens"] == 0 for r in rows if r["doc_id"] in (9001, 9002))
        assert stage(spark, docs.limit(0), sf_dir).count() == 0, name

"""Licences, mixing, embeddings, classifiers and the pipeline on small tables."""
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from veilspark.llm import embeddedup, ftrl, langid, licenses, mixing, quality, toxicity
from veilspark.llm.queries import QUERIES
from veilspark.llm.words import Tokens

# licences ---------------------------------------------------------------------------------


def test_rules_name_known_sentences():
    known = {i for i, _ in licenses.SENTENCES}
    assert all(set(ids) <= known for _, _, ids in licenses.RULES)


def test_licences(spark):
    bsd = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
           "the following conditions are met. Neither the name of the copyright holder nor the names of its contributors "
           "may be used to endorse or promote products derived from this software without specific prior written permission.")
    rows = [(1, "Text.\nLicensed under the Apache License, Version 2.0.\nMore", 5), (2, "RELEASED under the MIT   License!", 5),
            (3, bsd, 5), (4, None, 5), (5, "", 5), (6, "Nothing here. All rights reserved. Or", 5),
            (7, "This work is licensed under the GNU General Public License, version 3. All rights reserved.", 5),
            (8, "not all rights reserved today", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, licence int")
    got = {r["doc_id"]: r for r in licenses.scan(docs, out=("l", "c", "n", "ids")).collect()}
    assert [got[i]["l"] for i in range(1, 9)] == ["Apache-2.0", "MIT", "BSD-3-Clause", None, None, "all-rights-reserved",
                                                 "GPL-3.0-only", None]
    assert got[7]["ids"] == "gpl3_short reserved" and got[4]["ids"] == "" and got[1]["licence"] == 5


def test_licence_headers_as_they_occur(spark):
    bsd = ("Copyright (c) 2020, Someone\nAll rights reserved.\n\nRedistribution and use in source and binary forms, with or "
           "without\nmodification, are permitted provided that the following conditions are met:\n\n1. Redistributions\n")
    endorse = ("Neither the name of the copyright holder nor the names of its\n   contributors may be used to endorse or "
               "promote products derived from\n   this software without specific prior written permission.\n")
    gpl = ("# This program is free software: you can redistribute it and/or modify\n# it under the terms of the GNU {}General "
           "Public License as published by\n# the Free Software Foundation, either version {} of the License, or\n# (at your "
           "option) any later version.\n#\n# This program is distributed")
    apache = ('Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
              "compliance with the License. You may obtain a copy of the License at")
    mit = ("MIT License\nCopyright (c) 2020 X\n\nThe above copyright notice and this permission notice shall be included in "
           "all\ncopies or substantial portions of the Software.\n")
    texts = [(bsd, "BSD-2-Clause"), (bsd + endorse, "BSD-3-Clause"), (gpl.format("", 3), "GPL-3.0-or-later"),
             (gpl.format("", 2), "GPL-2.0-or-later"), (gpl.format("Affero ", 3), "AGPL-3.0-or-later"), (apache, "Apache-2.0"),
             ("/*\n * " + apache.replace("; you", ";\n * you").replace("in comp", "in\n * comp") + "\n */", "Apache-2.0"),
             (mit, "MIT"), ("All rights reserved.\n" + apache[:67], "Apache-2.0"),
             ("This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0. If", "MPL-2.0"),
             ("a line\nAll rights reserved\na line", "all-rights-reserved"),
             ("free\n\nsoftware licensed under\n\nthe Apache License, Version 2.0.", None)]
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(texts)], "doc_id long, text string")
    got = {r["doc_id"]: r["licence"] for r in licenses.scan(docs).collect()}
    assert [got[i] for i in range(len(texts))] == [want for _, want in texts]


# mixing -----------------------------------------------------------------------------------

def test_raking_meets_the_marginals(spark):
    cells = spark.createDataFrame([("a", "en", "x", 900), ("a", "fr", "x", 50), ("a", "en", "y", 10), ("a", "fr", "y", 40),
                                   ("b", "en", "x", 70), ("b", "en", "y", 30), ("b", "fr", "x", 20), ("b", "fr", "y", 100)],
                                  "s string, l string, k string, tokens long")
    half = spark.createDataFrame([("a", 1.0), ("b", 1.0), ("absent", 5.0)], "value string, share double")
    raked = mixing.rake(cells, ("s", "l", "k"), {"s": half}, rounds=10).collect()
    total = sum(r["tokens"] for r in raked)
    assert abs(sum(r["weight"] for r in raked) - total) < 1e-6
    assert abs(sum(r["weight"] for r in raked if r["s"] == "a") - total / 2) < 0.001 * total
    raw = {l: sum(r["tokens"] for r in raked if r["l"] == l) ** mixing.POWER for l in ("en", "fr")}
    want = total * raw["fr"] / sum(raw.values())
    assert abs(sum(r["weight"] for r in raked if r["l"] == "fr") - want) < 0.001 * total
    p = mixing.probabilities(mixing.rake(cells, ("s", "l", "k"), {"s": half}, rounds=3), 0.6).collect()
    assert all(0 <= r["p"] <= 1 for r in p)
    assert abs(sum(r["p"] * r["tokens"] for r in p) - 0.6 * total) < 1e-6 * total


def test_mix_edges(spark):
    rows = [(1, "a b c", "s", "en", 1), (1, "a b c", "s", "en", 1), (None, "d e", None, None, 2), (3, None, "s", "fr", 3),
            (4, "", "t", None, 4), (5, "x | y | z", "t", "de", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, tokens_ long")
    got = mixing.mix(docs).collect()
    assert len(got) == 6 and {r["topic"] for r in got} == {"note", "empty", "table"}
    assert len({r["kept"] for r in got if r["doc_id"] == 1}) == 1
    assert mixing.sample(docs).columns == docs.columns
    assert mixing.sample(docs, budget=1.0).count() == 6
    assert mixing.mix(docs.limit(0)).count() == 0


def test_the_draw_meets_the_targets(spark):
    words = {"note": 5, "article": 200}
    size = {("hot", "en"): 1500, ("hot", "fr"): 300, ("b", "en"): 500, ("b", "fr"): 100, ("c", "en"): 80, ("c", "fr"): 40}
    docs = spark.createDataFrame([(f"{s}-{lang}-{k}-{i}", "w " * n, s, lang) for (s, lang), m in size.items()
                                  for k, n in words.items() for i in range(m)],
                                 "doc_id string, text string, source string, lang string")
    got = mixing.mix(docs).toPandas()
    assert got["p"].max() <= 1 and got["p"].max() > 0.999
    for dim in ("source", "lang", "topic"):
        aim = got.groupby(dim)["tokens"].sum() ** mixing.POWER
        for tokens, off in ((got["tokens"] * got["p"], 1e-6), (got["tokens"] * got["kept"], 0.08)):  # three standard errors
            drawn = tokens.groupby(got[dim]).sum()
            assert (drawn / drawn.sum() - aim / aim.sum()).abs().max() < off


# embeddings -------------------------------------------------------------------------------

def brute_links(rows, cosine):
    ok = [(i, lab, np.array(v, dtype=float)) for i, v, lab in rows
          if lab is not None and v and all(x is not None and np.isfinite(x) for x in v) and np.any(v)]
    n = {}
    label = {i: i for i, *_ in rows}
    for a in range(len(ok)):
        for b in range(a):
            (i, p, x), (j, q, y) = ok[a], ok[b]
            if p == q and len(x) == len(y) and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= cosine:
                n[i], n[j] = n.get(i, 0) + 1, n.get(j, 0) + 1
                lo, hi = sorted((label[i], label[j]))
                label = {k: lo if c == hi else c for k, c in label.items()}
    return {i: (n.get(i, 0), label[i]) for i, *_ in rows}


@pytest.mark.parametrize("cells,block", [(6, 8), (2, 1000)])
def test_embedding_groups_are_those_of_brute_force(spark, cells, block):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(12, 8))
    rows = []
    for i in range(240):
        v = centres[rng.integers(12)] + rng.normal(size=8) * rng.choice([0.05, 0.25, 0.6])
        rows.append((i, [float(x) for x in v.astype(np.float32)], int(rng.integers(3))))
    rows += [(300 + i, rows[0][1], rows[0][2]) for i in range(5)] + [(310, None, 1), (311, [0.0] * 8, 1), (312, [], 1),
             (313, [float("nan")] + [1.0] * 7, 1), (314, [None] + [1.0] * 7, 1), (315, [1.0] * 8, None),
             (316, [1.0] * 8, 1), (317, [1.0] * 5, 1), (318, [2.0] * 8, 1), (319, [2.0] * 5, 1),
             (320, [float("inf")] * 8, 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in
           embeddedup.embedding_groups(df, cells=cells, block=block).collect()}
    assert got == brute_links(rows, embeddedup.COSINE)
    assert got[316] == (1, 316) and got[318] == (1, 316)


def test_embeddings_without_vectors(spark):
    df = spark.createDataFrame([(1, None, 1), (2, [0.0], 1)], "vec_id long, embedding array<float>, label int")
    assert [tuple(r) for r in embeddedup.embedding_groups(df).orderBy("vec_id").collect()] == [
        (1, 0, 1, True), (2, 0, 2, True)]
    assert embeddedup.embedding_groups(df.limit(0)).count() == 0


# classifiers ------------------------------------------------------------------------------

def held_out(spark, name, label):
    sf = "/root/testdata/sf0.01"
    truth = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", label)
    return QUERIES[name](spark, sf).join(truth, "doc_id").where("held_out").toPandas()


def test_quality_held_out(spark):
    got = held_out(spark, "op7_quality", "quality")
    assert (got["predicted"] == got["quality"]).mean() > 0.95
    assert got[got["quality"] == 1]["predicted"].mean() == 1


def test_toxicity_held_out(spark):
    got = held_out(spark, "op2_toxicity", "toxic")
    assert (got["predicted"] == got["toxic"]).mean() > 0.95
    assert got[got["toxic"] == 0]["predicted"].mean() < 0.03


def test_language_held_out(spark):
    sf = "/root/testdata/sf0.01"
    truth = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang")
    got = QUERIES["op3_language_id"](spark, sf).join(truth, "doc_id").toPandas()
    rest = got[got["held_out"]]
    assert len(got) == 1000 and (rest["lang_pred"] == rest["lang"]).mean() > 0.98
    assert got["score"].between(0, 1).all()


EDGES = [(1, None, 1), (2, "", 1), (3, "12 !!! 3", 1), (None, "only words here", 1), (5, "word " * 30000, 1)]


def edge_docs(spark):
    return spark.createDataFrame(EDGES, "doc_id long, text string, tags_ int")


def test_classifiers_without_labels_and_on_edges(spark):
    docs = edge_docs(spark)
    none = spark.createDataFrame([(1, None), (2, 0), (2, 1)], "doc_id long, y int")
    q = quality.score(docs, quality.fit(docs, none, label="y")).collect()
    assert [r["score"] for r in q] == [0.5] * 5
    t = toxicity.tag(docs, toxicity.fit(docs, none, label="y")).collect()
    assert all(r["score"] < 1e-6 and not r["spans"] for r in t) and t[0]["tags_"] == 1
    lang = langid.identify(docs, langid.fit(docs.withColumn("lang", F.lit(None).cast("string")))).collect()
    assert {(r["lang_pred"], r["score"]) for r in lang} == {("und", 0.0)}


def test_und_for_texts_without_letters(spark):
    train = spark.createDataFrame([(i, t, lang) for i in range(60) for t, lang in (("the cat and dog", "en"), ("der hund und", "de"))],
                                  "doc_id long, text string, lang string")
    got = langid.identify(edge_docs(spark), langid.fit(train)).collect()
    assert [r["lang_pred"] == "und" for r in got] == [True, True, True, False, False]
    assert [r["score"] == 0 for r in got] == [True, True, True, False, False]


def test_toxic_spans_are_offsets_of_the_text(spark):
    rows = [(i, f"é word{i} lines\nand BADWORD here {i}" if i % 2 else f"é word{i} lines\nand nice here {i}", i % 2) for i in range(80)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    got = toxicity.tag(docs, toxicity.fit(docs, docs)).collect()
    for r in got:
        assert (r["score"] >= 0.7) == (r["toxic"] == 1)
        assert [r["text"][s["start"]:s["end"]] for s in r["spans"]] == (["BADWORD"] if r["toxic"] else [])


def test_marginals_are_those_of_enumeration():
    rng = np.random.default_rng(0)
    chain = toxicity.Chain(np.zeros(toxicity.DIM), 0.0, (0.3, -0.7, 1.1))
    e, first = rng.normal(size=9), np.array([0, 4, 5])
    p, steps = chain.marginals(e, first, pairs=True)
    want, want_steps = np.zeros(9), np.zeros(3)
    for a, b in zip(first, [4, 5, 9]):
        total, ones, moved = 0.0, np.zeros(b - a), np.zeros(3)
        for y in np.ndindex(*[2] * (b - a)):
            kinds = list(zip(y, y[1:]))
            had = np.array([kinds.count(k) for k in ((0, 1), (1, 0), (1, 1))])
            w = np.exp(np.dot(y, e[a:b]) + had @ np.array(chain.move))
            total, ones, moved = total + w, ones + w * np.array(y), moved + w * had
        want[a:b], want_steps = ones / total, want_steps + moved / total
    assert np.allclose(p, want) and np.allclose(steps, want_steps)


def one_by_one(chain, e, first):
    """Marginals by the textbook recursions, one token after the other."""
    out, bounds = np.zeros(len(e)), [*first, len(e)]
    a, c, b = chain.move
    step = np.array([[0.0, a], [c, b]])
    for i, j in zip(bounds, bounds[1:]):
        n = j - i
        f, g = np.zeros((n, 2)), np.zeros((n, 2))
        f[0] = [0.0, e[i]]
        for t in range(1, n):
            f[t] = np.logaddexp(f[t - 1][0] + step[0], f[t - 1][1] + step[1]) + [0.0, e[i + t]]
        for t in range(n - 2, -1, -1):
            g[t] = np.logaddexp(step[:, 0] + g[t + 1][0], step[:, 1] + e[i + t + 1] + g[t + 1][1])
        out[i:j] = 1.0 / (1.0 + np.exp(f[:, 0] + g[:, 0] - f[:, 1] - g[:, 1]))
    return out


def test_chains_of_any_length_are_whole():
    rng = np.random.default_rng(6)
    for lengths in ([1], [3000], [1, 700, 2, 256, 257, 255, 1, 512], [5] * 200):
        e = np.clip(rng.normal(size=sum(lengths)) * 8, -30, 30)
        first = np.cumsum([0, *lengths[:-1]])
        chain = toxicity.Chain(np.zeros(toxicity.DIM), 0.0, (-4.0, 1.5, 3.0))
        assert np.allclose(chain.marginals(e, first), one_by_one(chain, e, first), atol=1e-9)
    assert len(toxicity.Document("word " * 5000 + "\nnext line").first) == 2


def test_tags_are_those_of_one_document_at_a_time(spark):
    """The CRF query's path on a small table against the recursions, one document after the other."""
    rows = [(i, f"word{i} and {'BADWORD' if i % 3 == 0 else 'nice'} here\n" + "long " * (i * 40), int(i % 3 == 0)) for i in range(60)]
    docs = spark.createDataFrame(rows + rows[:2], "doc_id long, text string, toxic int")
    chain = toxicity.fit(docs, docs)
    for r in toxicity.tag(docs, chain).collect():
        d = toxicity.Document(r["text"])
        p = one_by_one(chain, chain.emissions(d.at), d.first)
        assert abs(r["score"] - chain.score(p)) < 1e-9
        on = {k for s in r["spans"] for k in range(s["start"], s["end"])}
        words = list(re.finditer(r"\w+", r["text"]))
        assert all((w.start() in on) == (x >= 0.5) for w, x in zip(words, p)) and len(words) == len(p)


def test_ftrl_step_by_step(spark):
    """Two shards' weights by plain numbers, coordinate by coordinate, and their average."""
    rng = np.random.default_rng(1)
    rows = [(int(r), " ".join(rng.choice(list("abcdefg"), 5)), int(rng.integers(2))) for r in rng.integers(-2 ** 40, 2 ** 40, 5000)]
    sample = spark.createDataFrame(rows, "rank long, text string, y int").repartition(3)

    def features(text):
        at, n = np.unique([ord(c) - 97 for c in text.split()], return_counts=True)
        return at, n / 5

    got = ftrl.train(sample, features, 7, len(rows), epochs=2, alpha=0.4, l1=0.05, l2=0.02)
    weights, shards = [], {}
    parts = sample.select("rank", "text", "y", F.pmod("rank", F.lit(2)).alias("s")).collect()
    dealt = sample.repartition(2, F.pmod("rank", F.lit(2))).select(F.spark_partition_id().alias("p"), F.pmod("rank", F.lit(2)).alias("s")).distinct().collect()
    of = {r["s"]: r["p"] for r in dealt}  # both halves may be dealt to one task
    for r in parts:
        shards.setdefault(of[r["s"]], []).append((r["rank"], len(features(r["text"])[0]), r["y"], r["text"]))
    for rows_ in shards.values():
        z, n = [0.0] * 7, [0.0] * 7
        w = lambda j: 0.0 if abs(z[j]) <= 0.05 else -(z[j] - math.copysign(0.05, z[j])) / ((1 + math.sqrt(n[j])) / 0.4 + 0.02)
        for _ in range(2):
            for _, _, y, text in sorted(rows_, key=lambda r: r[:3]):
                at, x = features(text)
                x = x.astype(np.float32).astype(float)
                now = [w(j) for j in at]
                p = 1 / (1 + math.exp(-sum(a * b for a, b in zip(now, x))))
                for j, v, own in zip(at, x, now):
                    g = v * (p - y)
                    z[j] += g - (math.sqrt(n[j] + g * g) - math.sqrt(n[j])) / 0.4 * own
                    n[j] += g * g
        weights.append([w(j) for j in range(7)])
    assert np.allclose(got[:, 0], np.mean(weights, axis=0), atol=1e-6) and np.abs(got).max() > 0.01


def test_a_rare_language_is_learned(spark):
    rows = [(i, "the cat and the dog " * 3, "en") for i in range(900)] + [(2000 + i, "der hund und die katze", "de") for i in range(12)]
    model = langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), fit_rows=60)
    probe = spark.createDataFrame([(1, "und die katze der hund")], "doc_id long, text string")
    assert model.languages == ["de", "en"] and langid.identify(probe, model).first()["lang_pred"] == "de"


def test_ids_of_any_type(spark):
    rows = [(f"id-{i}", "good plain words of prose" if i % 2 else "### $$$ noise ###", i % 2, "en" if i % 2 else "xx") for i in range(60)]
    docs = spark.createDataFrame(rows + [(None, "no id", 0, "en")], "doc_id string, text string, y int, lang string")
    labels = docs.select("doc_id", "y")
    assert quality.score(docs, quality.fit(docs, labels, label="y")).count() == 61
    assert toxicity.tag(docs, toxicity.fit(docs, labels, label="y")).count() == 61
    assert langid.identify(docs, langid.fit(docs)).count() == 61
    assert mixing.mix(docs.withColumn("source", F.lit("s"))).count() == 61
    vectors = spark.createDataFrame([("a", [1.0, 0.0], 1), ("b", [1.0, 0.01], 1)], "vec_id string, embedding array<double>, label int")
    assert [r["component_id"] for r in embeddedup.embedding_groups(vectors).collect()] == ["a", "a"]


@pytest.mark.parametrize("name", ["score", "spans", "lang_pred", "licence", "sentence_ids", "topic", "p"])
def test_a_column_named_like_an_output_is_an_error(spark, name):
    docs = spark.createDataFrame([(1, "text", "s", "en", 0)], f"doc_id long, text string, source string, lang string, {name.upper()} int")
    model = quality.QualityModel(np.zeros(quality.DIM, np.float32))
    chain = toxicity.Chain(np.zeros(toxicity.DIM, np.float32))
    lang = langid.LanguageModel(["en"], np.zeros(langid.DIM, np.float32), np.zeros((langid.DIM, 1), np.float32))
    calls = {"score": lambda: quality.score(docs, model), "spans": lambda: toxicity.tag(docs, chain), "lang_pred": lambda: langid.identify(docs, lang)}
    with pytest.raises(ValueError):
        calls.get(name, lambda: licenses.scan(docs) if name in ("licence", "sentence_ids") else mixing.mix(docs))()


def test_vectors_of_extreme_length(spark):
    rows = [(1, [1e200, 1e200], 1), (2, [1.0, 1.0], 1), (3, [1e-200, 1e-200], 1), (4, [1.0, -1.0], 1)]
    got = embeddedup.embedding_groups(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()
    assert sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in got) == [(1, 2, 1), (2, 2, 1), (3, 2, 1), (4, 0, 4)]


def test_every_known_sentence_has_an_anchor():
    words = licenses.anchors(licenses.SENTENCES)
    assert all(set(words) & set(s.split()) for _, s in licenses.SENTENCES) and len(words) <= 8


def scan_by_hand(text):
    """Sentence identifiers by trying every known sentence at every word."""
    plain = re.sub(r"[^\x00-\x7F]+", " ", text or "").lower()
    marked = " H " + re.sub(r"\n[^a-z0-9\n]*(?=\n)", " H ", re.sub(r"[.!?]+([ \t\r]|$|\n)", " H ", plain)).replace("\n", " S ") + " H "
    signs = re.sub(r"[^a-z0-9HS]+", " ", marked).split()
    known = sorted(((s.split(), i) for i, s in licenses.SENTENCES), key=lambda x: -len(" ".join(x[0])))
    out, at = [], 0
    while at < len(signs):
        for words, i in known:
            k, left = at, list(words)
            while left and k < len(signs) and (signs[k] == left[0] or (signs[k] == "S" and k > at and signs[k - 1] != "S")):
                if signs[k] != "S":
                    left.pop(0)
                k += 1
            if not left and signs[at] == words[0] and signs[k - 1] == words[-1]:
                if i in licenses.WHOLE and not (signs[at - 1] in "HS" and signs[k] in "HS"):
                    continue
                out.append(i)
                at = k - 1
                break
        at += 1
    return out


def test_scan_against_every_sentence_at_every_word(spark):
    rng = random.Random(3)
    sentences = [s for _, s in licenses.SENTENCES]
    texts = [None, "", "license", "All rights reserved", "x all rights reserved"]
    for _ in range(250):
        out = []
        for _ in range(rng.randint(1, 4)):
            words = rng.choice(sentences).split() if rng.random() < 0.7 else [rng.choice(["the", "software", "mit", "license", "foo"]) for _ in range(rng.randint(1, 6))]
            out.append("".join(w + rng.choice([" ", " ", " ", "\n", "\n# ", ", ", "\n// "]) for w in words).strip())
        texts.append(rng.choice(["", "Intro. ", "é ", "so "]) + rng.choice([". ", "\n", "\n\n", " ", "! "]).join(out))
    got = licenses.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")).collect()
    for r in got:
        assert r["sentence_ids"].split() == scan_by_hand(texts[r["doc_id"]]), texts[r["doc_id"]]
    assert sum(bool(r["sentence_ids"]) for r in got) > 150


def test_hashes_do_not_depend_on_the_place():
    a, b = Tokens("the word, and " * 9000 + "word"), Tokens("word")
    assert a.hashes()[-1] == b.hashes()[0] == a.hashes()[1]


def test_stored_tables_are_released(spark):
    import os

    from veilspark.llm import common
    with common.released(spark) as keep:
        a = common.stored(spark.range(3), "a")
        first = common.last_stored()
        b = common.stored(a.where("id > 0"), "b")
        keep.append(common.last_stored())
    gone, kept = first.removeprefix("file:"), keep[0].removeprefix("file:")
    assert not os.path.exists(os.path.dirname(gone)) and os.path.exists(kept) and b.count() == 2


# pipeline ---------------------------------------------------------------------------------

def test_pipeline_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    now, sizes = docs, [docs.count()]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        now = stage(spark, now, sf_dir)
        assert now.columns == docs.columns
        assert now.dtypes == docs.dtypes
        now = spark.createDataFrame(now.collect(), docs.schema)
        sizes.append(now.count())
    assert sizes == sorted(sizes, reverse=True) and sizes[-1] > 0
    last = corpus_pipeline.STAGES[-1][1](spark, now, sf_dir)
    assert last.count() == sizes[-1] and last.select("doc_id").distinct().count() == sizes[-1]
    assert now.where(F.length("text") != F.col("n_chars")).count() == 0
    got = corpus_pipeline.run(spark, sf_dir)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, last.collect()))

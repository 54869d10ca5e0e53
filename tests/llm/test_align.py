"""Token alignment against a plain reading of its definition, on whole texts."""
import hashlib
from collections import Counter
from itertools import accumulate

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

import __spark_entry__ as E
from veilspark.llm import align

PATHS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def tables():
    aligner = align.Aligner(*PATHS)
    return align.Tables(aligner.a_json, aligner.b_model)


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(PATHS[0])
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=PATHS[1])


def plain(text, libraries, tables):
    """n_a, n_b, groups, links of one text; Nones where the bytes differ."""
    if not text:
        return 0, 0, [], []
    a, b = libraries
    ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    raw = (" " + text).encode()
    if b"".join(tables.bytes_a[i] for i in ids_a) != raw or b"".join(tables.bytes_b[i] for i in ids_b) != raw:
        return 0, 0, [], []
    ends_a = list(accumulate(len(tables.bytes_a[i]) for i in ids_a))
    ends_b = list(accumulate(len(tables.bytes_b[i]) for i in ids_b))
    links = [(x, y) for x, e in zip(ids_a, ends_a) for y, f in zip(ids_b, ends_b) if e == f]
    groups, a0, b0 = [], 0, 0
    for e in sorted(set(ends_a) & set(ends_b)):
        a1, b1 = ends_a.index(e) + 1, ends_b.index(e) + 1
        groups.append((ids_a[a0:a1], ids_b[b0:b1]))
        a0, b0 = a1, b1
    return len(ids_a), len(ids_b), groups, links


def written(groups):
    return ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in groups)


TEXTS = ["", "a", " a", "a ", "a  b", "a \n b", "x\n\n y", "\ttab", "Höhe über 5 €", "日本語 の 文", "▁ is a sign", "a ▁b",
         "<s> hi </s> <|endoftext|>", "tail space", "\x00 nul", "don't stop", "1234567 89", "🙂 🙂🙂", "l" * 300, "ab " * 50]


def test_texts_one_by_one(tables, libraries):
    for text, got in zip(TEXTS, tables.align(TEXTS)):
        n_a, n_b, groups, links = plain(text, libraries, tables)
        row = align._row(text, got)
        assert row[:4] == (n_a, n_b, len(groups), len(links)), text
        assert row[7] == written(groups)
        assert Counter({p: n for p, n in zip(map(int, row[5]), map(int, row[6]))}) == Counter(x << 32 | y for x, y in links)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("ab zé\n\t.'5▁ 漢"), max_size=25), max_size=6))
def test_any_text(tables, libraries, texts):
    for text, got in zip(texts, tables.align(texts)):
        n_a, n_b, groups, links = plain(text, libraries, tables)
        assert align._row(text, got)[:4] == (n_a, n_b, len(groups), len(links))
        assert align._row(text, got)[7] == written(groups)


def test_tokens_without_bytes_share_an_end():
    # A ends at 1, 3, 3; B ends at 1, 1, 3
    assert align.slices([1, 2, 0], [1, 0, 2]) == ([1, 3], [1, 3], [2, 3])
    groups = [(0, 1, 0, 2), (1, 3, 2, 3)]
    assert [align.links(g, [1, 2, 0], [1, 0, 2]) for g in groups] == [[(0, 0), (0, 1)], [(1, 2), (2, 2)]]


def check(rows, docs, libraries, tables):
    own = {}
    for i, text in docs:
        own.setdefault(i, []).append(plain(text, libraries, tables))
    counts = Counter(p for found in own.values() for x in found for p in x[3])
    top = {}
    for (_, b), n in counts.items():
        top[b] = max(top.get(b, 0), n)
    want = Counter()
    for i, found in own.items():
        for n_a, n_b, groups, links in found:
            sha = hashlib.sha256(written(groups).encode()).hexdigest() if groups else ""
            want[(i, n_a, n_b, len(groups), len(links), sum(counts[p] == top[p[1]] for p in links),
                  sum(counts[p] for p in links), sha)] += 1
    assert Counter(map(tuple, rows)) == want


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.mark.parametrize("hot_pairs", [1, 40, align.HOT_PAIRS])
def test_counts_hot_and_rare(spark, tables, libraries, hot_pairs):
    docs = [(i, t) for i, t in enumerate(TEXTS)] + [(3, "a "), (3, "a "), (None, "x y"), (7, None)] + [(50 + i, "the same words here") for i in range(30)]
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in docs], "doc_id long, text string, n_a int, row string").repartition(3)
    got = align.align(df, align.Aligner(*PATHS), hot_pairs=hot_pairs).select(*COLUMNS).collect()
    check(got, docs, libraries, tables)


def test_text_ids_and_empty_table(spark):
    aligner = align.Aligner(*PATHS)
    df = spark.createDataFrame([("k", "some text")], "doc_id string, text string")
    row = align.align(df, aligner, groups=True).first()
    assert row["doc_id"] == "k" and row["groups"].count("|") == row["n_groups"] > 0
    assert align.align(df.limit(0), aligner).count() == 0


def test_query_against_plain(spark, sf_dir, tables, libraries):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    docs = [(i, t) for i, t in docs if t is None or len(t) < 20_000]  # the plain reading is quadratic
    got = E.queries()["op11_token_alignment"](spark, sf_dir)
    assert got.columns == COLUMNS
    if all(t is None or len(t) < 20_000 for _, t in docs) and got.count() == len(docs):
        check(got.collect(), docs, libraries, tables)
    else:
        own = {r["doc_id"]: tuple(r)[1:5] for r in got.collect()}
        for i, t in docs:
            n_a, n_b, groups, links = plain(t, libraries, tables)
            assert own[i] == (n_a, n_b, len(groups), len(links))

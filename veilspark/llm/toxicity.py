"""Toxicity: a linear-chain conditional random field over words, two states (clean, toxic).

Labels are given per document, a chain needs them per token. They are induced: of a
toxic document's words, those that speak most for the label (by how many toxic and clean
documents of the sample hold the word, or words that begin alike) are its toxic tokens;
all words of clean documents are clean. A chain is a whole line of text. Emissions add the weights of the hashed word and of its beginnings; transitions
are one table.

Scoring runs forward-backward over all chains of a batch at once. A document's score is a
logistic function, calibrated on the sample, of its two largest token marginals; offending
spans are runs of tokens whose marginal is at least 1/2, as character offsets of the text.

Defined cases: a null text, or one without words, scores 0 and has no spans. Without
toxic or without clean labels every score is 0. Label rows that disagree on an id, or
are null, are not learned from. Ids may be of any type. Other columns pass through; one named
like an output raises an error.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import ftrl
from .common import fresh, no_clash
from .words import Tokens

BITS = 20
DIM = 1 << BITS
#: labelled documents the field is fitted on, at most (about; all, if there are fewer)
FIT_ROWS = 8_000
#: words of one block of the scan over chains (it cuts no chain)
SCAN_WORDS = 256
#: documents of one gradient step
STEP_DOCS = 32
TOXIC_SCORE = 0.7
BEGINNINGS = (4, 5, 6)  # bytes
#: a document's toxic tokens speak for the label at least so much, against its strongest one
NEAR_BEST = 0.5
LEAST_DOCS = 2
BATCH_CHARS = 1_000_000


def _lower(text: str) -> str:
    """Lower case, character by character, so that offsets stay."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c if len(c.lower()) != 1 else c.lower() for c in text)


class Document:
    """Feature coordinates (tokens x features), first tokens of the chains, and the words' byte ranges."""

    def __init__(self, text: str):
        self.tokens = t = Tokens(_lower(text), signs=False, lower=False)
        parts = [t.hashes()]
        for n, size in enumerate(BEGINNINGS, 1):
            h = t.hashes(t.start, np.minimum(t.start + size, t.end))
            parts.append(np.where(t.end - t.start > size, h ^ np.uint64(n), parts[0]))
        self.at = (np.stack(parts, axis=1) >> np.uint64(64 - BITS)).astype(np.int32).reshape(-1, len(parts))
        line = np.cumsum(t.bytes == 10)[t.start] if len(t.start) else np.empty(0, dtype=int)
        begins = np.concatenate([[True], line[1:] != line[:-1]])[:len(line)]
        self.first = np.flatnonzero(begins)

    def offsets(self, bytes_: np.ndarray) -> np.ndarray:
        """Byte offsets as character offsets."""
        starts = np.cumsum((self.tokens.bytes & 0xC0) != 0x80)
        return np.where(bytes_ > 0, starts[np.maximum(bytes_ - 1, 0)], 0)


@dataclass
class Chain:
    """Weights of the field; ``move`` are the log weights of clean-toxic, toxic-clean, toxic-toxic steps."""

    weights: np.ndarray
    bias: float = 0.0
    move: tuple[float, float, float] = (0.0, 0.0, 0.0)
    scale: tuple[float, float, float] = (-30.0, 0.0, 0.0)  # of the score: constant, largest, second largest

    def evidence(self, p: np.ndarray) -> np.ndarray:
        """Logits of a document's two largest marginals."""
        top = np.zeros(2)
        top[:min(2, len(p))] = np.sort(p)[::-1][:2]
        return np.clip(np.log((top + 1e-6) / (1.0 - top + 1e-6)), -8, 8)

    def score(self, p: np.ndarray) -> float:
        return float(1.0 / (1.0 + np.exp(-np.clip(self.scale[0] + self.evidence(p) @ self.scale[1:], -30, 30))))

    def emissions(self, at: np.ndarray) -> np.ndarray:
        return np.clip(self.bias + self.weights[at].sum(axis=1, dtype=float), -30, 30)

    def marginals(self, e: np.ndarray, first: np.ndarray, pairs: bool = False):
        """P(toxic) of every token of the chains that begin at ``first``; with ``pairs`` also the expected
        numbers of the three steps.

        Chains lie end to end, and each begins anew whatever was before it. Forward and backward odds are
        each a fractional linear function of the odds one token on, so both are scans (``_scan``)."""
        x = np.exp(e)
        a, c, b = np.exp(self.move)
        begins = np.zeros(len(e) + 1, dtype=bool)
        begins[first] = begins[-1] = True
        starts, ends = begins[:-1], begins[1:]
        # forward: x (a + b r) / (1 + c r), or x where a chain starts
        forward = _scan(np.where(starts, 0.0, b * x), np.where(starts, x, a * x), np.where(starts, 0.0, c))
        # backward: (c + b y) / (1 + a y) with y = x * back of the next token, or 1 where a chain ends
        x_next = np.append(x[1:], 1.0)
        back = _scan(*(np.where(ends, end, v)[::-1] for v, end in ((b * x_next, 0.0), (np.full(len(e), c), 1.0), (a * x_next, 0.0))))[::-1]
        q = forward * back
        p = q / (1.0 + q)
        if not pairs:
            return p
        inner = np.flatnonzero(~starts)
        y, r = x[inner] * back[inner], forward[inner - 1]
        joint = np.stack([a * y, r * c, r * b * y])
        return p, (joint / (1.0 + joint.sum(axis=0))).sum(axis=1)


def _scan(n1: np.ndarray, n0: np.ndarray, d1: np.ndarray) -> np.ndarray:
    """r[t] = (n1[t] r[t-1] + n0[t]) / (d1[t] r[t-1] + 1) from r[-1] = 0, for all t.

    Blocks of SCAN_WORDS are composed side by side (a 2 x 2 matrix each), their first values follow one
    after the other, and all blocks then run from these: the same values as one loop over t."""
    size = len(n1)
    blocks = max(1, -(-size // SCAN_WORDS))
    pad = blocks * SCAN_WORDS - size
    n1, n0, d1 = (np.append(v, np.zeros(pad)).reshape(blocks, SCAN_WORDS).T for v in (n1, n0, d1))
    p = np.ones(blocks), np.zeros(blocks), np.zeros(blocks), np.ones(blocks)
    for t in range(SCAN_WORDS):
        p = (n1[t] * p[0] + n0[t] * p[2], n1[t] * p[1] + n0[t] * p[3], d1[t] * p[0] + p[2], d1[t] * p[1] + p[3])
        top = np.maximum(np.maximum(p[0], p[1]), np.maximum(p[2], p[3]))
        p = tuple(v / top for v in p)
    start, r = np.zeros(blocks), 0.0
    for k in range(blocks):
        start[k] = r
        r = (p[0][k] * r + p[1][k]) / (p[2][k] * r + p[3][k])
    out = np.empty((SCAN_WORDS, blocks))
    r = start
    for t in range(SCAN_WORDS):
        r = (n1[t] * r + n0[t]) / (d1[t] * r + 1.0)
        out[t] = r
    return out.T.ravel()[:size]


def _cues(sample: DataFrame) -> np.ndarray:
    """How much each coordinate speaks for the label: documents that hold it, by label, over the whole sample."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, n = np.zeros((2, DIM), dtype=np.int32), np.zeros(2, dtype=int)
        for b in batches:
            for t, y in zip(b["text"], b["y"]):
                held[y][np.unique(Document(t).at)] += 1
                n[y] += 1
        y, at = np.nonzero(held)
        yield pd.DataFrame({"y": np.append(y, [0, 1]), "at": np.append(at, [-1, -1]), "n": np.append(held[y, at], n)})

    # only coordinates that some toxic document holds can speak for the label
    parts = sample.select("text", "y").mapInPandas(count, "y int, at int, n long").groupBy("at").agg(
        F.sum(F.when(F.col("y") == 1, F.col("n")).otherwise(0)).alias("toxic"),
        F.sum(F.when(F.col("y") == 0, F.col("n")).otherwise(0)).alias("clean")).where(
        (F.col("toxic") >= LEAST_DOCS) | (F.col("at") < 0)).toPandas()
    total = parts[parts["at"] < 0]
    speaks = np.zeros(DIM)
    if not len(total) or not total["toxic"].sum() or not total["clean"].sum():
        return speaks
    parts = parts[parts["at"] >= 0]
    toxic, clean = parts["toxic"].to_numpy(), parts["clean"].to_numpy()
    odds = np.log((toxic + 0.5) / (total["toxic"].sum() + 1)) - np.log((clean + 0.5) / (total["clean"].sum() + 1))
    speaks[parts["at"].to_numpy()] = toxic * np.maximum(odds - np.log(5.0), 0.0)
    return speaks.astype(np.float32)


def _token_labels(doc: Document, toxic: int, speaks: np.ndarray) -> np.ndarray:
    s = speaks[doc.at].max(axis=1) if len(doc.at) else np.empty(0)
    return (s >= NEAR_BEST * s.max()) & (s > 0) if toxic and len(s) else np.zeros(len(s), dtype=bool)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label: str = "toxic",
        fit_rows: int = FIT_ROWS, epochs: int | None = None, rate: float = 1.0, l2: float = 1e-4) -> Chain:
    """A field from about ``fit_rows`` of the labelled documents at most: shards climb the likelihood by
    adaptive gradient steps, and their weights are averaged."""
    sample, n = ftrl.labelled_sample(docs, labels, label, id_col, text_col, fit_rows)
    speaks = _cues(sample)
    if not speaks.any():
        return Chain(np.zeros(DIM, dtype=np.float32), -30.0)
    shards = -(-max(n, 1) // ftrl.SHARD_ROWS)
    epochs = epochs or int(np.clip(8_000 / max(n, 1), 4, 24))  # small samples need more steps

    def climb(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = []
        for b in batches:
            for i, t, y in zip(b["rank"], b["text"], b["y"]):
                doc = Document(t)
                if len(doc.at):
                    own.append((i, len(doc.at), doc.at, doc.first, _token_labels(doc, y, speaks)))
        if not own:
            return
        own.sort(key=lambda r: r[:2])  # the same order on every run
        w, seen = np.zeros(DIM), np.full(DIM, 1e-8)
        rest, rest_seen = np.array([-3.0, 0.0, 0.0, 0.0]), np.full(4, 1e-8)  # bias and the three steps
        for _ in range(epochs):
            for k in range(0, len(own), STEP_DOCS):
                part = own[k:k + STEP_DOCS]
                at, y = np.concatenate([r[2] for r in part]), np.concatenate([r[4] for r in part])
                begin = np.cumsum([0] + [r[1] for r in part[:-1]])
                first = np.concatenate([r[3] + s for r, s in zip(part, begin)])
                chain = Chain(w, rest[0], tuple(rest[1:]))
                p, steps = chain.marginals(chain.emissions(at), first, pairs=True)
                g = y - p
                flat = at.ravel()
                coord, back = np.unique(flat, return_inverse=True)
                grad = np.bincount(back, np.repeat(g, at.shape[1])) - l2 * w[coord]
                seen[coord] += grad * grad
                w[coord] += rate * grad / np.sqrt(seen[coord])
                inner = np.ones(len(y), dtype=bool)
                inner[first] = False
                was, now = np.append(False, y[:-1])[inner], y[inner]
                had = np.array([(~was & now).sum(), (was & ~now).sum(), (was & now).sum()])
                grad = np.append(g.sum(), had - steps) - l2 * rest
                rest_seen += grad * grad
                rest += rate * grad / np.sqrt(rest_seen)
        used = np.flatnonzero(np.abs(w) > 1e-4)
        yield pd.DataFrame({"at": np.concatenate([used, [-1, -2, -3, -4, -5]]),
                            "w": np.concatenate([w[used], rest, [1.0]])})

    parts = sample.repartition(shards, F.pmod("rank", F.lit(shards))).mapInPandas(climb, "at int, w double").groupBy(
        "at").agg(F.sum("w").alias("w")).toPandas()
    value = dict(zip(parts["at"].tolist(), parts["w"].tolist()))
    count = value.get(-5, 1.0)
    weights = np.zeros(DIM, dtype=np.float32)
    positive = parts[parts["at"] >= 0]
    weights[positive["at"].to_numpy()] = positive["w"].to_numpy() / count
    chain = Chain(weights, value.get(-1, -30.0) / count, tuple(value.get(k, 0.0) / count for k in (-2, -3, -4)))
    return replace(chain, scale=_scale(chain, sample))


def _scale(chain: Chain, sample: DataFrame) -> tuple[float, float, float]:
    """Logistic regression of the label on the evidence; two numbers a row of the bounded sample."""

    def evidence(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            docs = [Document(t) for t in b["text"]]
            e = [chain.evidence(chain.marginals(chain.emissions(d.at), d.first)) for d in docs]
            yield pd.DataFrame({"a": [x[0] for x in e], "b": [x[1] for x in e], "y": b["y"].astype(int)})

    got = sample.mapInPandas(evidence, "a double, b double, y int").toPandas()
    x = np.column_stack([np.ones(len(got)), got["a"], got["b"]])
    v = np.zeros(3)
    for _ in range(30):
        q = 1.0 / (1.0 + np.exp(-np.clip(x @ v, -30, 30)))
        v += np.linalg.solve((x.T * (q * (1 - q))) @ x + 0.1 * np.eye(3), x.T @ (got["y"].to_numpy() - q) - 0.1 * v)
    return tuple(v.tolist())


def tag_column(text: Column, chain: Chain) -> Column:
    """struct(score, starts, ends) of a text column: score in 0..1, character offsets of offending spans."""

    @F.pandas_udf("score double, starts array<int>, ends array<int>")
    def tag(texts: pd.Series) -> pd.DataFrame:
        score = np.zeros(len(texts))
        starts: list = [[]] * len(texts)
        ends: list = [[]] * len(texts)
        batch: list[tuple[int, Document]] = []

        def flush():
            if not batch:
                return
            begin = np.cumsum([0] + [len(d.at) for _, d in batch])
            p = chain.marginals(chain.emissions(np.concatenate([d.at for _, d in batch])),
                                np.concatenate([d.first + s for (_, d), s in zip(batch, begin)]))
            for (i, d), a, b in zip(batch, begin, begin[1:]):
                own = p[a:b]
                score[i] = chain.score(own)
                if own.max() >= 0.5:
                    on = np.flatnonzero(own >= 0.5)
                    run = np.concatenate([[True], (np.diff(on) > 1) | np.isin(on[1:], d.first)])
                    starts[i] = d.offsets(d.tokens.start[on[run]]).tolist()
                    ends[i] = d.offsets(d.tokens.end[on[np.append(run[1:], True)]]).tolist()
            batch.clear()

        chars = 0
        for i, t in enumerate(texts):
            doc = Document(t)
            if len(doc.at):
                batch.append((i, doc))
                chars += len(t)
                if chars >= BATCH_CHARS:
                    flush()
                    chars = 0
        flush()
        return pd.DataFrame({"score": score, "starts": pd.Series(starts, dtype=object),
                             "ends": pd.Series(ends, dtype=object)})

    return tag(F.coalesce(text.cast("string"), F.lit("")))


def tag(docs: DataFrame, chain: Chain, text_col: str = "text", score_out: str = "score",
        spans_out: str = "spans") -> DataFrame:
    """``docs`` with its score and its offending spans: array of (start, end), ends not included."""
    no_clash(docs, score_out, spans_out)
    (t,) = fresh(docs, "tags_")
    spans = F.arrays_zip(F.col(t)["starts"].alias("start"), F.col(t)["ends"].alias("end"))
    return docs.withColumn(t, tag_column(F.col(text_col), chain)).withColumns(
        {score_out: F.col(t)["score"], spans_out: spans}).drop(t)

"""Ranked lexical search by two trees: every item's best documents, exactly.

A document is the vector of what each item term adds to its score; an item is the set of
its terms. Documents form leaves, nodes and batches in the order of their strongest
terms, items form leaves and nodes in the same way; every node holds the largest value
of each coordinate below it (of an item node that is the union of its terms). The sum of
a document node's maxima over an item node's terms is no less than any score of a pair
below the two; if it is less than the weakest k-th score of the node's items, the pair is
pruned with all that is below it. What is left at the leaves is scored exactly.

Every task searches its own documents with the whole item tree and answers at most k
rows per item. The items' k-th scores among one part of the documents (taken by a hash,
all documents are searched afterwards) are the floor that every task starts from: no
k-th score over all documents can be lower, and few rows pass it, however many tasks.

Item terms are what is broadcast: items are searched in passes of at most about
``TERMS_A_PASS`` terms, each a search of all documents, so nothing broadcast grows with
the documents or beyond that bound with the items (one item of more terms is a pass).

Scores are whole numbers: a term's weight w is floor(1000 * ln((2N+2) / (2df+1))); with
m = 100 - 90 + (90 * n * N) div L, a document's score is the sum over an item's terms of
w * ((1000000000 * tf) div (1000 * tf + 8 * m)).

Defined cases: a null or empty text has no terms; such documents count in neither N nor L
and are found by no item, and such items find nothing. Rows of one item id are one
item with the terms of all. Repeated document rows are documents of their own. Equal
scores rank by ascending id, null ids last; equal rows have ranks of their own. Empty
tables give an empty result. Only id and text columns are read, so extra columns cannot
clash.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
K = 10
TERMS_A_PASS = 65_536
#: documents of a leaf, leaves of a node, nodes of a batch; items of a node below the root
LEAF, LEAVES, NODES, ITEM_NODE = 32, 8, 8, 8
#: one part in so many sets the floors that the search starts from
FLOOR_PART = 64

#: every byte that is not part of a term becomes a blank, A-Z become a-z
_BYTES = bytes(b if b >= 0x80 or chr(b).isdigit() else ord(chr(b).lower()) if chr(b).isalpha() else 32 for b in range(256))


def terms_of(raw: bytes) -> list[bytes]:
    """Terms of a text in UTF-8, with repeats."""
    return raw.translate(_BYTES).split()


def terms_column(text: Column) -> Column:
    """The same as an array column."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.regexp_extract_all(F.translate(F.coalesce(text.cast("string"), F.lit("")), upper, upper.lower()), F.lit(TERM), 0)


# vectors ----------------------------------------------------------------------------------

def vectors(docs: DataFrame, vocabulary: list[str], id_col: str, text_col: str) -> DataFrame:
    """Documents with a term: id, n (all terms with repeats), and of the vocabulary's terms their number and tf."""
    number = {t.encode(): i for i, t in enumerate(vocabulary)}
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").cast("binary").alias("text")).where("text IS NOT NULL")
    ints = pa.list_(pa.int64())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = number.keys()
        for batch in batches:
            at, n, terms, tfs = [], [], [], []
            for i, raw in enumerate(batch.column(1)):
                found = terms_of(raw.as_py())
                if not found:
                    continue
                tf = Counter(found)
                held = sorted((number[t], tf[t]) for t in tf.keys() & known)
                at.append(i)
                n.append(len(found))
                terms.append([x for x, _ in held])
                tfs.append([x for _, x in held])
            columns = [batch.column(0).take(pa.array(at, pa.int64())), pa.array(n, pa.int64()), pa.array(terms, ints), pa.array(tfs, ints)]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "n", "terms", "tfs"])

    id_type = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(count, f"id {id_type}, n long, terms array<long>, tfs array<long>")


def term_weights(df: np.ndarray, n_docs: int) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(x) + 1))) for x in df], dtype=np.int64)


# trees ------------------------------------------------------------------------------------

class ItemTree:
    """Items by number, each a sorted array of term numbers; nodes of ITEM_NODE children up to one root."""

    def __init__(self, items: list[np.ndarray], weights: np.ndarray):
        # items whose strongest terms are the same stand together
        by_weight = [sorted(map(int, t), key=lambda x: (-weights[x], x)) for t in items]
        self.order = sorted(range(len(items)), key=lambda i: by_weight[i])
        self.levels = [[items[i] for i in self.order]]
        while len(self.levels[-1]) > 1:
            below = self.levels[-1]
            self.levels.append([np.unique(np.concatenate(below[i:i + ITEM_NODE])) for i in range(0, len(below), ITEM_NODE)])

    def reached(self, maxima: np.ndarray, floors: list[np.ndarray], among: np.ndarray | None = None) -> np.ndarray:
        """Items (as places in ``order``) whose bound with a document node is not below their floor, found
        from the root down; ``among``: those that the document node above has left."""
        allowed = None
        if among is not None:
            allowed = [among]
            for _ in self.levels[1:]:
                allowed.append(np.unique(allowed[-1] // ITEM_NODE))
        live = np.zeros(1, dtype=np.int64)
        for depth in range(len(self.levels) - 1, -1, -1):
            level, floor = self.levels[depth], floors[depth]
            if allowed is not None:
                live = live[np.isin(live, allowed[depth], assume_unique=True)]
            live = np.array([j for j in live.tolist() if maxima[level[j]].sum() >= floor[j]], dtype=np.int64)
            if not depth or not len(live):
                return live
            live = (live[:, None] * ITEM_NODE + np.arange(ITEM_NODE)).ravel()
            live = live[live < len(self.levels[depth - 1])]
        return live

    def floors(self, floor: np.ndarray) -> list[np.ndarray]:
        """The weakest floor below each node, by level."""
        out = [floor]
        for level in self.levels[1:]:
            out.append(np.minimum.reduceat(out[-1], np.arange(0, len(out[-1]), ITEM_NODE)))
        return out


def _additions(terms: np.ndarray, tfs: np.ndarray, weights: np.ndarray, n: int, n_docs: int, n_terms: int) -> np.ndarray:
    """What each of a document's terms adds to the score of an item that has it."""
    m = 100 - 90 + 90 * n * n_docs // n_terms
    if m >> 58 or (len(tfs) and int(tfs.max()) > 9_000_000_000):  # beyond 64 bits: Python's integers
        return np.array([int(w) * (1_000_000_000 * int(t) // (1000 * int(t) + 8 * m)) for w, t in zip(weights[terms], tfs)], dtype=np.int64)
    return weights[terms] * (1_000_000_000 * tfs // (1000 * tfs + 8 * m))


class Search:
    """The best k of each item among the documents that one task has met."""

    def __init__(self, items: list[np.ndarray], weights: np.ndarray, n_docs: int, n_terms: int, k: int,
                 floor: np.ndarray):
        self.tree = ItemTree(items, weights)
        self.weights, self.n_docs, self.n_terms, self.k = weights, n_docs, n_terms, k
        # a score of 0 is no match
        self.floor = np.maximum(floor[self.tree.order], 1)
        self.best: list[list[tuple]] = [[] for _ in items]
        self.pairs_scored = 0

    def batch(self, ids: list, n: list[int], terms: list[np.ndarray], tfs: list[np.ndarray]) -> None:
        adds = [_additions(t, f, self.weights, x, self.n_docs, self.n_terms) for t, f, x in zip(terms, tfs, n)]
        # documents with the same strongest term stand together
        strong = [int(t[np.argmax(a)]) if len(t) else -1 for t, a in zip(terms, adds)]
        order = sorted((i for i in range(len(ids)) if strong[i] >= 0), key=lambda i: strong[i])
        if not order or not self.best:
            return
        leaves = []
        for lo in range(0, len(order), LEAF):
            own = order[lo:lo + LEAF]
            values = np.zeros((len(own), len(self.weights)), dtype=np.int64)
            for row, i in enumerate(own):
                values[row, terms[i]] = adds[i]
            leaves.append((own, values.max(axis=0)))
        nodes = [leaves[i:i + LEAVES] for i in range(0, len(leaves), LEAVES)]
        tops = [np.maximum.reduce([m for _, m in node]) for node in nodes]
        live = self.tree.reached(np.maximum.reduce(tops), self.tree.floors(self.floor))
        for node, top in zip(nodes, tops):
            if not len(live):
                return
            held = self.tree.reached(top, self.tree.floors(self.floor), live)
            for own, maxima in node:
                if not len(held):
                    break
                found = self.tree.reached(maxima, self.tree.floors(self.floor), held)
                if len(found):
                    values = np.zeros((len(own), len(self.weights)), dtype=np.int64)
                    for row, i in enumerate(own):
                        values[row, terms[i]] = adds[i]
                    self._score(found, [ids[i] for i in own], values)

    def _score(self, items: np.ndarray, ids: list, values: np.ndarray) -> None:
        for j in items.tolist():
            scores = values[:, self.tree.levels[0][j]].sum(axis=1)
            self.pairs_scored += len(ids)
            at = np.flatnonzero(scores >= self.floor[j])
            if len(at):
                best = self.best[j] + [(-int(scores[i]), ids[i] is None, ids[i]) for i in at.tolist()]
                best.sort(key=lambda x: x[:2] if x[1] else x)
                self.best[j] = best[:self.k]
                if len(best) >= self.k:
                    self.floor[j] = max(self.floor[j], -self.best[j][-1][0])

    def results(self) -> Iterator[tuple[int, object, int]]:
        """(item number, document id, score)"""
        for place, best in enumerate(self.best):
            for score, _, i in best:
                yield self.tree.order[place], i, -score


def _searched(vecs: DataFrame, items: list[np.ndarray], weights: np.ndarray, n_docs: int, n_terms: int, k: int,
              floor: np.ndarray) -> DataFrame:
    """Best k rows per item of every task: item (its number), id, score."""
    id_type = vecs.schema["id"].dataType.simpleString()
    context = vecs.sparkSession.sparkContext.broadcast((items, weights, floor))
    many = LEAF * LEAVES * NODES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, weights, floor = context.value
        search = Search(items, weights, n_docs, n_terms, k, floor)
        id_arrow = pa.null()
        for batch in batches:
            id_arrow = batch.schema.field(0).type
            for lo in range(0, batch.num_rows, many):
                part = batch.slice(lo, many)
                search.batch(part.column(0).to_pylist(), part.column(1).to_pylist(),
                             *([x.values.to_numpy(zero_copy_only=False) for x in part.column(c)] for c in (2, 3)))
        rows = list(search.results())
        if rows:
            item, ids, scores = zip(*rows)
            yield pa.RecordBatch.from_arrays([pa.array(item, pa.int64()), pa.array(ids, id_arrow), pa.array(scores, pa.int64())],
                                             names=["item", "id", "score"])

    return vecs.mapInArrow(run, f"item long, id {id_type}, score long")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    best = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


# search -----------------------------------------------------------------------------------

def _passes(items: DataFrame, bound: int) -> int:
    """Into how many parts by a hash of the id the items fall so that none has more terms than ``bound``
    (or it is one item)."""
    parts = 1
    while True:
        load = items.groupBy(F.pmod(F.xxhash64("item_id"), F.lit(parts)).alias("part")).agg(
            F.sum(F.size("terms")).alias("terms"), F.count(F.lit(1)).alias("items"))
        if not load.where((F.col("terms") > bound) & (F.col("items") > 1)).limit(1).count():
            return parts
        parts *= 2


def search(docs: DataFrame, items: DataFrame, k: int = K, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text_col: str = "text", terms_a_pass: int = TERMS_A_PASS) -> DataFrame:
    """The ``k`` best documents of each item: item id, rank, document id, score."""
    terms = items.select(F.col(item_col).alias("item_id"), F.explode(terms_column(F.col(item_text_col))).alias("term"))
    wanted = stored(terms.distinct().groupBy("item_id").agg(F.sort_array(F.collect_list("term")).alias("terms")), "items")
    parts = _passes(wanted, terms_a_pass)
    out = None
    for p in range(parts):
        one = _search_pass(docs, wanted.where(F.pmod(F.xxhash64("item_id"), F.lit(parts)) == p), k, id_col, text_col)
        out = one if out is None else out.unionByName(one)
    return out.select(F.col("item_id").alias(item_col), "rank", F.col("id").alias(id_col), "score")


def _search_pass(docs: DataFrame, items: DataFrame, k: int, id_col: str, text_col: str) -> DataFrame:
    spark = docs.sparkSession
    rows = items.collect()  # bounded by terms_a_pass
    vocabulary = sorted({t for r in rows for t in r["terms"]})
    number = {t: i for i, t in enumerate(vocabulary)}
    numbered = [np.array(sorted(number[t] for t in r["terms"]), dtype=np.int64) for r in rows]
    vecs = stored(vectors(docs, vocabulary, id_col, text_col), "vectors")
    n_docs, n_terms = vecs.agg(F.count(F.lit(1)), F.sum("n")).first()
    df = np.zeros(len(vocabulary), dtype=np.int64)
    for r in vecs.select(F.explode("terms").alias("t")).groupBy("t").count().collect():  # one row per vocabulary term
        df[r["t"]] = r["count"]
    weights = term_weights(df, n_docs)
    args = (numbered, weights, n_docs, n_terms or 1, k)
    part = vecs.where(F.pmod(F.xxhash64("id", "n"), F.lit(FLOOR_PART)) == 0)
    floor = np.zeros(len(rows), dtype=np.int64)
    first = _ranked(_searched(part, *args, floor), k).where(F.col("rank") == k)
    for r in first.select("item", "score").collect():  # one row per item of the pass
        floor[r["item"]] = r["score"]
    names = spark.createDataFrame([(i, r["item_id"]) for i, r in enumerate(rows)],
                                  f"item long, item_id {items.schema['item_id'].dataType.simpleString()}")
    found = _ranked(_searched(vecs, *args, floor), k)
    return found.join(F.broadcast(names), "item").select("item_id", F.col("rank").cast("int").alias("rank"), "id", "score")

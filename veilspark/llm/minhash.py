"""MinHash near-dedup with DartMinHash signatures and banded joining.

A text's elements are its distinct five-word shingles, each weighted by how often it occurs (or 1). Every
element owns a strip of the plane: its weight by all ranks >= 0. Darts fall on the strips
with density 1; where they fall depends only on a hash of the element, so equal regions
of two texts hold the same darts. A text sees the darts below its weights; each dart has
a coordinate, and per coordinate the dart with the least rank is the signature's entry:
two texts agree there with the probability of their (weighted) Jaccard similarity. Darts
are thrown only up to the rank where about k (ln k + 4) of them are expected; a text with
an empty coordinate goes on to twice that rank, which leaves earlier darts as they are.

Bands of the signature are joined: texts that share a band key and may be alike by size
share a bucket. Sets whose similarity reaches t differ in size by a factor of 1/t at most,
so with size classes that grow by 1/t they are in the same class or in neighbouring ones:
a text enters its bands' buckets of its class and of the next. This loses no pair and
keeps texts apart that share a common passage but little else. Buckets with the same
members are one.

Pairs are not made within a bucket. In each of ``ROUNDS`` rounds a bucket's head is the
first of its open members by the round's order of all texts, and a text is compared with one
head: the first of its buckets' heads that is not in its own component. A round so makes one row
per text at most, however large the buckets are, and as a group's texts have the same few
heads, a group of near copies is one component after a round or two. Two members of one
component need no comparing, and a bucket whose members are in one component is settled.
That leaves buckets of texts that are close but not alike. They are compared in blocks:
the members outside the bucket's largest component (those inside need no comparing with
each other) with one another and with all others; a task holds two blocks, computes
their similarities as matrix products, and answers one row per member at most. So no two
texts of a bucket that are alike end up in two classes, and no step makes rows in
proportion to pairs.

Texts with the same shingle set are one node from the start, however many they are.

Defined cases: words are lower-cased runs of ASCII letters, digits, _ and all non-ASCII
characters; a text of one to four words has one shingle, all its words; a text without
words (null, empty, signs only) links with nothing, and every such row stays. Rows
repeated with id and text are copies of each other: one stays. Of a group the smallest id
stays; rows with a null id come after all ids. Extra columns pass through ``near_dedup``,
whatever their names.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, may_be_among, stored, whole_text
from .graph import components
from .words import Tokens, distinct, mix

#: rounds in which every text is compared with one head
ROUNDS = 2
#: members of one block, when what is left of a bucket is compared in blocks
BLOCK = 256
#: hashes in the bitmaps of keys: 1 MB each, as several are broadcast and stay in the executors' memory for a while
BITS = 1 << 23
#: shingles whose darts a worker throws together
BATCH = 400_000

_U = np.uint64


@dataclass(frozen=True)
class Settings:
    words: int = 5
    similarity: float = 0.8
    bands: int = 24
    rows: int = 6
    weights: str = "count"  # a shingle weighs as often as it occurs; "set": 1


def shingles(text: str, words: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes (int64) of a whole text, and their counts."""
    h = Tokens(text, signs=False).hashes()
    if not len(h):
        return np.empty(0, dtype=np.int64), np.empty(0)
    n = min(words, len(h))
    with np.errstate(over="ignore"):
        s = np.zeros(len(h) - n + 1, dtype=np.uint64)
        for j in range(n):
            s = s * _U(0x9DDFEA08EB382D69) + h[j:len(h) - n + 1 + j]
        return distinct((mix(s) ^ _U(n)).view(np.int64))


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], weights: str = "set") -> float:
    """Exact (weighted) Jaccard similarity of two shingle sets."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    if weights == "set":
        union = len(a[0]) + len(b[0]) - len(i)
        return len(i) / union if union else 0.0
    both = np.minimum(a[1][i], b[1][j]).sum()
    union = a[1].sum() + b[1].sum() - both
    return both / union if union else 0.0


def unit_elements(found: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """A counted set as a plain one: an element that counts c gives c elements, the same ones in every text,
    so plain similarity of the results is weighted similarity."""
    element, count = found
    n = count.astype(np.int64)
    number = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    with np.errstate(over="ignore"):
        out = mix(np.repeat(element, n).view(np.uint64) + number.astype(np.uint64) * _U(0xD1342543DE82EF95)).view(np.int64)
    return np.sort(out), np.ones(len(out))


# darts ------------------------------------------------------------------------------------

def _rank_bands(top: float):
    """(low, high, number) of the rank bands that reach ``top``: 1/4 high, then each doubles the rank, 256 high at most."""
    low, high, k = 0.0, 0.25, 0
    while low < top:
        yield low, high, k
        low, high, k = high, high + min(high, 256.0), k + 1


def _unit(x: np.ndarray) -> np.ndarray:
    return (x >> _U(11)).astype(np.float64) * (1.0 / (1 << 53))


def _poisson(u: np.ndarray, mean: float) -> np.ndarray:
    """Poisson variates of the uniform ones ``u``."""
    n, p, total = 0, np.exp(-mean), 0.0
    table = []
    while total < 1 - 1e-15 and n < 20 * mean + 60:
        total += p
        table.append(total)
        n += 1
        p *= mean / n
    return np.searchsorted(np.array(table), u, side="right")


def _throw(element: np.ndarray, weight: np.ndarray, owner: np.ndarray, top: np.ndarray, k: int):
    """(slot, rank, dart) of every dart that each owner sees below its own top rank."""
    cells = np.ceil(weight).astype(np.int64)
    at = np.repeat(np.arange(len(element)), cells)
    cell = np.arange(len(at)) - np.repeat(np.cumsum(cells) - cells, cells)
    inside, owner = np.minimum(weight[at] - cell, 1.0), owner[at]  # how much of the unit cell the weight covers
    with np.errstate(over="ignore"):
        seed = mix(element[at].view(np.uint64) + cell.astype(np.uint64) * _U(0xD1342543DE82EF95))
        own_top = top[owner]
        out = []
        for low, high, band in _rank_bands(float(top.max()) if len(top) else 0.0):
            on = np.flatnonzero(own_top > low)
            s = mix(seed[on] ^ _U((band + 1) * 0x9E3779B97F4A7C15 % (1 << 64)))
            n = _poisson(_unit(s), high - low)
            src = np.repeat(on, n)
            number = np.arange(len(src)) - np.repeat(np.cumsum(n) - n, n)
            dart = mix(np.repeat(s, n) + (number.astype(np.uint64) + _U(1)) * _U(0xBF58476D1CE4E5B9))
            rank = low + (high - low) * _unit(dart)
            place = mix(dart ^ _U(0x94D049BB133111EB))
            seen = (rank < own_top[src]) & (_unit(place) < inside[src])
            coordinate = mix(place)[seen] % _U(k)
            out.append((owner[src[seen]] * k + coordinate.astype(np.int64), rank[seen], dart[seen]))
    return [np.concatenate(x) for x in zip(*out)]


def signatures(sets: list[tuple[np.ndarray, np.ndarray]], k: int) -> np.ndarray:
    """uint64 (texts x k): the earliest dart of every coordinate, for non-empty weighted sets."""
    sig = np.zeros((len(sets), k), dtype=np.uint64)
    todo = np.arange(len(sets))
    total = np.array([w.sum() for _, w in sets])
    top = k * (np.log(k) + 4.0) / np.maximum(total, 1e-300)
    while len(todo):
        owner = np.repeat(np.arange(len(todo)), [len(sets[i][0]) for i in todo])
        slot, rank, dart = _throw(np.concatenate([sets[i][0] for i in todo]),
                                  np.concatenate([sets[i][1] for i in todo]), owner, top[todo], k)
        least = np.full(len(todo) * k, np.inf)
        np.minimum.at(least, slot, rank)
        first = rank == least[slot]
        found = np.zeros(len(todo) * k, dtype=np.uint64)
        found[slot[first]] = dart[first]
        full = np.isfinite(least).reshape(-1, k).all(axis=1)
        sig[todo[full]] = found.reshape(-1, k)[full]
        todo = todo[~full]
        top[todo] *= 2.0
    return sig


def band_keys(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """int64 (texts x bands): a key per band; keys of different bands differ."""
    keys = np.zeros((len(sig), bands), dtype=np.uint64)
    with np.errstate(over="ignore"):
        for j in range(bands):
            h = np.full(len(sig), (j + 1) * 0x9E3779B97F4A7C15 % (1 << 64), dtype=np.uint64)
            for r in range(rows):
                h = mix(h * _U(0x9DDFEA08EB382D69) + sig[:, j * rows + r])
            keys[:, j] = h
    return keys.view(np.int64)


# Spark ------------------------------------------------------------------------------------

def _weighted(found: tuple[np.ndarray, np.ndarray], weights: str) -> tuple[np.ndarray, np.ndarray]:
    return (found[0], np.ones(len(found[0]))) if weights == "set" else found


def size_class(total: float, least: float) -> int:
    """Classes that grow by 1 / least: totals within that factor differ by one class at most."""
    return int(np.floor(np.log(total) / -np.log(least) + 1e-9))


def bucket_keys(keys: np.ndarray, total: float, least: float) -> np.ndarray:
    """Keys of the buckets of a text: each band with its size class and with the next one."""
    c = size_class(total, least)
    both = [keys.view(np.uint64) ^ mix(np.full(1, n, dtype=np.int64).view(np.uint64)) for n in (c, c + 1)]
    return mix(np.concatenate(both)).view(np.int64)


def sketch_column(text: Column, settings: Settings = Settings()) -> Column:
    """struct(same, bands): a digest of the weighted shingle set (null without words), and its bucket keys."""

    @F.pandas_udf("same binary, bands array<long>")
    def sketch(texts: pd.Series) -> pd.DataFrame:
        same: list = [None] * len(texts)
        bands: list = [np.empty(0, dtype=np.int64)] * len(texts)
        batch, size = [], 0

        def flush():
            if batch:
                sig = signatures([x for _, x in batch], settings.bands * settings.rows)
                for (i, found), keys in zip(batch, band_keys(sig, settings.bands, settings.rows)):
                    bands[i] = bucket_keys(keys, float(found[1].sum()), settings.similarity)
                batch.clear()

        for i, t in enumerate(texts):
            found = _weighted(shingles(t, settings.words), settings.weights)
            if len(found[0]):
                same[i] = hashlib.blake2b(found[0].tobytes() + found[1].tobytes(), digest_size=16).digest()
                batch.append((i, found))
                size += len(found[0])
                if size >= BATCH:
                    flush()
                    size = 0
        flush()
        return pd.DataFrame({"same": pd.Series(same, dtype=object), "bands": pd.Series(bands, dtype=object)})

    return sketch(text)


def _alike(a: Column, b: Column, settings: Settings) -> Column:
    """Whether two texts are similar enough."""

    @F.pandas_udf("boolean")
    def alike(left: pd.Series, right: pd.Series) -> pd.Series:
        known: dict[str, tuple] = {}  # heads repeat

        def of(t):
            if t not in known:
                if len(known) > 256:
                    known.clear()
                known[t] = shingles(t, settings.words)
            return known[t]

        return pd.Series([similarity(of(x), of(y), settings.weights) >= settings.similarity
                          for x, y in zip(left, right)], dtype=bool)

    return alike(a, b)


def _alike_matrix(sets: list[tuple[np.ndarray, np.ndarray]], settings: Settings) -> np.ndarray:
    """Which of the shingle sets are similar enough, as a square matrix."""
    n = len(sets)
    if settings.weights != "set":
        sets = [unit_elements(s) for s in sets]
    owner = np.repeat(np.arange(n), [len(s[0]) for s in sets])
    _, column, held = np.unique(np.concatenate([s[0] for s in sets]), return_inverse=True, return_counts=True)
    shared = held[column] > 1
    owner, column = owner[shared], np.unique(column[shared], return_inverse=True)[1]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    common, width = np.zeros((n, n)), 4096
    for low in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        a, b = np.searchsorted(column, [low, low + width])
        m = np.zeros((n, width), dtype=np.float32)
        m[owner[a:b], column[a:b] - low] = 1.0
        common += m @ m.T
    size = np.array([len(s[0]) for s in sets], dtype=float)
    union = size[:, None] + size[None, :] - common
    near = np.divide(common, union, out=np.zeros_like(common), where=union > 0) >= settings.similarity
    np.fill_diagonal(near, True)  # shingles that only one text holds were left out
    return near


def _links_in_blocks(pool: DataFrame, texts: DataFrame, settings: Settings) -> DataFrame:
    """Links (a, b) that join what is alike in each bucket of ``pool`` (band, same, component, main).

    A bucket's members outside its main component are dealt to blocks of one kind, those inside to blocks of the
    other; a task is two blocks of the first kind, or one of either."""
    inside = (F.col("component") == F.col("main")).alias("inside")
    member = pool.select("band", "same", inside)
    count = lambda cond: F.ceil(F.sum(cond.cast("int")) / BLOCK).cast("int")
    blocks = member.groupBy("band").agg(count(~F.col("inside")).alias("outer"), count(F.col("inside")).alias("inner"))
    dealt = member.join(blocks, "band")
    own = F.pmod(F.xxhash64("same"), F.when(F.col("inside"), F.col("inner")).otherwise(F.col("outer"))).cast("int")
    dealt = dealt.withColumn("own", own)
    # blocks of the second kind are numbered on from those of the first
    with_outer = lambda me: F.transform(F.sequence(F.lit(0), F.col("outer") - 1), lambda k: F.struct(
        F.least(k, me).alias("i"), F.greatest(k, me).alias("j")))
    inner_tasks = F.transform(F.sequence(F.lit(0), F.col("inner") - 1), lambda k: F.struct(
        F.col("own").alias("i"), (F.col("outer") + k).alias("j")))
    none = F.array().cast("array<struct<i:int,j:int>>")
    to_do = F.when(F.col("inside"), with_outer(F.col("outer") + F.col("own"))).otherwise(F.concat(
        with_outer(F.col("own")), F.when(F.col("inner") > 0, inner_tasks).otherwise(none)))
    tasks = dealt.select("band", "same", F.explode(to_do).alias("task")).select(
        "band", "task.i", "task.j", "same").join(texts, "same")

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("same", ignore_index=True)
        near = _alike_matrix([shingles(t, settings.words) for t in pdf["body"]], settings)
        root = np.arange(len(pdf))
        while True:  # the least number spreads over the links of this task
            low = np.minimum(root, np.where(near, root[None, :], len(pdf)).min(axis=1))
            if (low == root).all():
                break
            root = low
        on = root != np.arange(len(pdf))
        return pd.DataFrame({"a": pdf["same"].to_numpy()[root[on]], "b": pdf["same"].to_numpy()[on]})

    return tasks.groupBy("band", "i", "j").applyInPandas(compare, "a binary, b binary")


def _buckets(sketches: DataFrame) -> DataFrame:
    """(band, same) of the nodes that share a bucket with another; of buckets with the same members one is left."""
    one_each = sketches.where(F.col("same").isNotNull()).groupBy("same").agg(F.first("bands").alias("bands"))
    member = one_each.select("same", F.explode("bands").alias("band"))
    print_of = [F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("same").cast("decimal(38,0)")).alias("x"),
                F.sum(F.xxhash64("same", F.lit(1)).cast("decimal(38,0)")).alias("y")]
    shared = member.groupBy("band").agg(*print_of).where("n > 1")
    single = shared.groupBy("n", "x", "y").agg(F.min("band").alias("band")).select("band")
    mostly = may_be_among(member, ["band"], single, ["band"], bits=BITS).where("maybe")  # most bands are of one text alone
    return mostly.join(single, "band").select("band", "same")


def _open(member: DataFrame, comp: DataFrame) -> DataFrame:
    """Members of the buckets that more than one component is in: band, same, component, and the bucket's largest
    component as ``main``."""
    labelled = member.join(comp.withColumnRenamed("node", "same"), "same", "left").select(
        "band", "same", F.coalesce("component", "same").alias("component"))
    sizes = labelled.groupBy("band", "component").agg(F.count(F.lit(1)).alias("n"))
    main = sizes.groupBy("band").agg(F.max(F.struct("n", "component")).alias("main"),
                                     F.count(F.lit(1)).alias("parts")).where("parts > 1")
    return labelled.join(main.select("band", F.col("main.component").alias("main")), "band")


def _one_head_each(pool: DataFrame, number: int) -> DataFrame:
    """(a, b): each open node with the first of its buckets' heads that is of another component; one row a node."""
    place = F.xxhash64("same", F.lit(number))  # an order that all buckets share, so that a group has few heads
    heads = pool.groupBy("band").agg(F.min(F.struct(place.alias("place"), "same", "component")).alias("head"))
    other = pool.join(heads, "band").where(F.col("component") != F.col("head.component"))
    return (other.groupBy("same").agg(F.min("head").alias("head"))
            .select(F.col("same").alias("a"), F.col("head.same").alias("b")))


def near_links(docs: DataFrame, sketches: DataFrame, text_col: str, settings: Settings) -> DataFrame:
    """Components (node, component) of the texts that are alike.

    ``sketches`` has key (a hash of the text), same, bands per row of ``docs``; nodes are ``same``.
    """
    member = stored(_buckets(sketches), "members")
    # one text of each node that is in some bucket with another; copies are collapsed before they meet it
    nodes = member.select("same").distinct()
    one = stored(sketches.join(nodes, "same", "left_semi").groupBy("same").agg(F.min("key").alias("key")), "nodes")
    body = docs.select(whole_text(text_col).alias("body")).select(F.unhex(F.md5("body")).alias("key"), "body")
    met = may_be_among(body, ["key"], one, ["key"], bits=BITS).where("maybe").drop("maybe")  # only their texts are shuffled
    texts = stored(met.dropDuplicates(["key"]).join(one, "key").select("same", "body"), "texts")

    links = None
    comp = member.select(F.col("same").alias("node"), F.col("same").alias("component")).limit(0)
    pool = stored(_open(member, comp), "open")
    for number in range(ROUNDS):
        ta = texts.select(F.col("same").alias("a"), F.col("body").alias("text_a"))
        tb = texts.select(F.col("same").alias("b"), F.col("body").alias("text_b"))
        new = stored(_one_head_each(pool, number).join(ta, "a").join(tb, "b").where(
            _alike(F.col("text_a"), F.col("text_b"), settings)).select("a", "b"), "new_links")
        if new.isEmpty():
            continue
        links = new if links is None else links.unionByName(new)
        comp = stored(components(links), "components")
        pool = stored(_open(member, comp), "open")
        if pool.isEmpty():
            return comp
    new = stored(_links_in_blocks(pool, texts, settings).distinct(), "new_links")
    if new.isEmpty():
        return comp
    return stored(components(new if links is None else links.unionByName(new)), "components")


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                settings: Settings = Settings()) -> DataFrame:
    """One row per row of ``docs``: id, key (md5 of its text), class_id (smallest id of its class), class_size, kept."""
    rows = docs.select(F.col(id_col).alias("id"), whole_text(text_col).alias("body"))
    sketches = stored(rows.withColumn("sketch", sketch_column(F.col("body"), settings)).select(
        "id", F.unhex(F.md5("body")).alias("key"), "sketch.same", "sketch.bands"), "sketches")
    comp = near_links(docs, sketches, text_col, settings)
    # equal rows are counted, then written out again: one of them may stay
    own = sketches.groupBy("id", "key", "same").agg(F.count(F.lit(1)).alias("copies"))
    labelled = stored(own.join(comp.withColumnRenamed("node", "same"), "same", "left").select(
        "id", "key", "copies", F.coalesce("component", "same").alias("label")), "labels")
    # of the smallest id's rows (or those without an id) the one with the least text hash stays
    lead = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", F.hex("key").alias("key")))
    classes = (labelled.where("label is not null").groupBy("label")
               .agg(lead.alias("lead"), F.sum("copies").alias("size")))
    found = labelled.join(classes, "label", "left")
    copy = F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))
    found = found.select(
        "id", "key", F.when(F.col("label").isNull(), F.col("id")).otherwise(F.col("lead.id")).alias("class_id"),
        F.coalesce("size", F.lit(1)).cast("long").alias("class_size"), "label",
        (F.col("id").eqNullSafe(F.col("lead.id")) & (F.hex("key") == F.col("lead.key"))).alias("leads"),
        copy.alias("copy"))
    return found.select(F.col("id").alias(id_col), "key", "class_id", "class_size",
                        (F.col("label").isNull() | (F.col("leads") & (F.col("copy") == 1))).alias("kept"))


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               settings: Settings = Settings()) -> DataFrame:
    """``docs`` with one row of each class, and its own columns. Only rows that may go, or may be there twice, are shuffled."""
    groups = stored(near_groups(docs, id_col, text_col, settings), "groups")
    key, gone_id, gone_key, maybe = fresh(docs, "key_", "gone_id_", "gone_key_", "maybe_")
    keyed = docs.withColumn(key, F.unhex(F.md5(whole_text(text_col))))
    same_row = F.col(id_col).eqNullSafe(F.col(gone_id)) & (F.col(key) == F.col(gone_key))
    per_row = groups.groupBy(F.col(id_col).alias(gone_id), F.col("key").alias(gone_key)).agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.col("kept").cast("int")).alias("stay"))
    gone = stored(per_row.where("rows > stay"), "gone").select(gone_id, gone_key, "stay")
    once = gone.where("stay > 0").drop("stay")
    among = lambda some: may_be_among(keyed, [id_col, key], some, [gone_id, gone_key], maybe, BITS)
    seen = among(gone)
    # joins that shuffle at every size: a broadcast would grow with the input until it turns into a shuffle
    stay = seen.where(F.col(maybe)).join(gone.drop("stay").hint("shuffle_hash"), same_row, "left_anti")
    first = among(once).where(F.col(maybe)).join(once.hint("shuffle_hash"), same_row, "left_semi").dropDuplicates([id_col, key])
    return seen.where(~F.col(maybe)).unionByName(stay).unionByName(first).drop(key, maybe)

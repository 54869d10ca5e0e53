"""Embedding near-dedup: spherical k-means cells, blocked cosines within cells.

Vectors are compared only under the same label. Equal vectors (same label, same
components) are one node with a count, however many rows hold them. Centroids are fitted
by spherical k-means (unit vectors, cosine assignment, normalised means) on a bounded
sample; every vector is assigned. A pair may have its ends in two cells, so a vector also
visits cells it could have a neighbour in. With unit x of home centre c and y of home
centre d, x.(c - d) >= 0 >= y.(c - d), hence x.(c - d) <= |x - y| |c - d|: if the left
side is over |c - d| sqrt(2 - 2 t), no y of cell d has cosine t with x. All other cells
with a smaller number are visited. No pair is lost, and none is compared twice.

Within a cell, homes and visitors are dealt to blocks by a hash; a task multiplies two
blocks and answers, per vector, how many rows it links with, and as links the least node
of its group there: rows in proportion to the vectors, never to the pairs.

Defined cases: null, zero or empty vectors, vectors with a null or non-finite component
and rows without a label link with nothing; only vectors of equal length are compared.
Repeated rows are vectors of their own. A row with a null id counts as a neighbour, and
has no say in the smallest id. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored
from .graph import components

COSINE = 0.93
#: distinct vectors the centroids are fitted on, at most (about)
FIT_ROWS = 20_000
ROUNDS = 6
#: vectors of one block
BLOCK = 1_024
#: distinct vectors per cell to aim at
CELL = 2_048
#: cells at most: what the driver holds and ships is MAX_CELLS^2 numbers; larger cells have more blocks
MAX_CELLS = 1_024
_SLACK = 1e-6  # for rounding in the bound, far from the threshold's own comparison


def _unit(rows: pd.Series) -> np.ndarray:
    x = np.stack([np.asarray(r, dtype=np.float64) for r in rows])
    x /= np.abs(x).max(axis=1, keepdims=True)  # so that no square overflows or vanishes
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def valid(vector: Column, label: Column) -> Column:
    """Whether a vector can link at all."""
    sound = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    zero = F.forall(vector, lambda x: x == 0)
    return F.coalesce(label.isNotNull() & vector.isNotNull() & (F.size(vector) > 0) & sound & ~zero, F.lit(False))


def spherical_kmeans(sample: DataFrame, k: int, rounds: int = ROUNDS) -> np.ndarray:
    """Unit centroids of ``sample`` (node, vector). Each round, tasks answer one sum per cell and
    Spark adds them; the driver holds the k centroids."""
    first = sample.orderBy(F.xxhash64("node", F.lit("start"))).limit(k).toPandas()
    centres = _unit(first["vector"])
    size = centres.shape[1]
    for _ in range(rounds):
        def sums(batches: Iterator[pd.DataFrame], centres=centres) -> Iterator[pd.DataFrame]:
            total, n = np.zeros(centres.shape), np.zeros(len(centres), dtype=int)
            for b in batches:
                x = _unit(b["vector"])
                cell = (x @ centres.T).argmax(axis=1)
                np.add.at(total, cell, x)
                n += np.bincount(cell, minlength=len(centres))
            used = np.flatnonzero(n)
            yield pd.DataFrame({"cell": used, "total": list(total[used])})

        added = [F.sum(F.get("total", F.lit(j))).alias(f"x{j}") for j in range(size)]
        got = sample.mapInPandas(sums, "cell int, total array<double>").groupBy("cell").agg(*added).toPandas()
        total = got[[f"x{j}" for j in range(size)]].to_numpy()
        norm = np.linalg.norm(total, axis=1)
        centres = centres.copy()
        ok = norm > 0  # an empty cell keeps its centre
        centres[got["cell"].to_numpy()[ok]] = total[ok] / norm[ok, None]
    return np.unique(centres, axis=0)


def _assign(nodes: DataFrame, centres: np.ndarray, cosine: float) -> DataFrame:
    """Nodes with their home cell and the cells with smaller numbers that they must visit."""
    reach = np.sqrt(2.0 - 2.0 * cosine)
    apart = np.sqrt(np.maximum(2.0 - 2.0 * (centres @ centres.T), 0.0))
    size = centres.shape[1]

    @F.pandas_udf("home int, visits array<int>")
    def assign(vectors: pd.Series) -> pd.DataFrame:
        home = np.zeros(len(vectors), dtype=int)
        visits: list = [[]] * len(vectors)
        fits = np.flatnonzero([len(v) == size for v in vectors])
        for at in np.array_split(fits, max(1, len(fits) // 4096)):
            if not len(at):
                continue
            s = _unit(vectors.iloc[at]) @ centres.T
            home[at] = own = s.argmax(axis=1)
            may = s[np.arange(len(at)), own][:, None] - s <= apart[own] * reach + _SLACK
            may &= np.arange(len(centres)) < own[:, None]
            for i, row in zip(at, may):
                visits[i] = np.flatnonzero(row).tolist()
        return pd.DataFrame({"home": home, "visits": pd.Series(visits, dtype=object)})

    return nodes.withColumn("cells", assign(F.col("vector"))).select(
        "label", "size", "node", "vector", "copies", "cells.home", "cells.visits")


def _links(placed: DataFrame, cosine: float, block: int) -> DataFrame:
    """(node, linked, root): per task and node, rows linked with, and the least node of its group in the task."""
    seats = placed.select("label", "size", "node", "vector", "copies", F.explode(F.concat(
        F.array(F.struct(F.col("home").alias("cell"), F.lit(False).alias("visitor"))),
        F.transform("visits", lambda c: F.struct(c.alias("cell"), F.lit(True).alias("visitor"))))).alias("seat")
    ).select("label", "size", "node", "vector", "copies", "seat.cell", "seat.visitor")
    cell = ["label", "size", "cell"]
    blocks = seats.groupBy(*cell).agg(
        F.ceil(F.sum((~F.col("visitor")).cast("int")) / block).cast("int").alias("homes"),
        F.ceil(F.sum(F.col("visitor").cast("int")) / block).cast("int").alias("visitors"))
    dealt = seats.join(blocks.where("homes > 0"), cell)
    number = lambda n: F.pmod(F.xxhash64("node"), n).cast("int")
    own = F.when(F.col("visitor"), number(F.greatest("visitors", F.lit(1)))).otherwise(number(F.col("homes")))
    dealt = dealt.withColumn("own", own)
    # a home block meets itself, the home blocks after it, and every visitor block
    task = lambda kind, a, b, side: F.struct(F.lit(kind).alias("kind"), a.alias("i"), b.alias("j"), side.alias("side"))
    span = lambda a, b: F.when(a <= b, F.sequence(a, b)).otherwise(F.array().cast("array<int>"))
    one, zero = F.lit(1), F.lit(0)
    as_left = F.transform(span(F.col("own"), F.col("homes") - 1), lambda j: task("h", F.col("own"), j, zero))
    as_right = F.transform(span(zero, F.col("own") - 1), lambda i: task("h", i, F.col("own"), one))
    with_guests = F.transform(span(zero, F.col("visitors") - 1), lambda j: task("v", F.col("own"), j, zero))
    as_guest = F.transform(span(zero, F.col("homes") - 1), lambda i: task("v", i, F.col("own"), one))
    tasks = F.when(F.col("visitor"), as_guest).otherwise(F.concat(as_left, as_right, with_guests))
    rows = dealt.select(*cell, "node", "vector", "copies", F.explode(tasks).alias("task")).select(
        *cell, "task.kind", "task.i", "task.j", "task.side", "node", "vector", "copies")

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        left = pdf[pdf["side"] == 0]
        right = pdf[pdf["side"] == 1]
        same = pdf["kind"].iloc[0] == "h" and pdf["i"].iloc[0] == pdf["j"].iloc[0]
        right = left if same else right
        none = pd.DataFrame({"node": pd.Series(dtype=object), "linked": pd.Series(dtype="int64"),
                             "root": pd.Series(dtype=object)})
        if not len(left) or not len(right):
            return none
        near = _unit(left["vector"]) @ _unit(right["vector"]).T >= cosine
        if same:
            np.fill_diagonal(near, False)
        a, b = near.any(axis=1), near.any(axis=0)
        if not a.any():
            return none
        near, left, right = near[a][:, b], left[a], right[b]
        names = sorted(set(left["node"]) | set(right["node"]))
        number = {n: k for k, n in enumerate(names)}
        x = np.array([number[n] for n in left["node"]])
        y = np.array([number[n] for n in right["node"]])
        while True:  # the least number spreads over the links of this task
            low_x = np.minimum(x, np.where(near, y[None, :], len(names)).min(axis=1))
            low_y = np.minimum(y, np.where(near, low_x[:, None], len(names)).min(axis=0))
            if same:
                low_x = low_y = np.minimum(low_x, low_y)
            if (low_x == x).all() and (low_y == y).all():
                break
            x, y = low_x, low_y
        out = [(left["node"], near @ right["copies"].to_numpy(), x)]
        if not same:
            out.append((right["node"], near.T @ left["copies"].to_numpy(), y))
        return pd.concat([pd.DataFrame({"node": n.to_numpy(), "linked": c, "root": [names[k] for k in r]})
                          for n, c, r in out])

    return rows.groupBy(*cell, "kind", "i", "j").applyInPandas(compare, "node binary, linked long, root binary")


def embedding_groups(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                     label_col: str = "label", cosine: float = COSINE, cells: int | None = None,
                     fit_rows: int = FIT_ROWS, block: int = BLOCK) -> DataFrame:
    """One row per row of ``vectors``: id, n_links, component_id, kept."""
    rows = vectors.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"),
                          F.col(vector_col).cast("array<double>").alias("vector"))
    sound = valid(F.col("vector"), F.col("label"))
    key = F.unhex(F.md5(F.concat_ws("|", F.col("label").cast("string"), F.to_json("vector"))))
    rows = stored(rows.select("id", "label", "vector", F.when(sound, key).alias("node")), "vectors")
    counted = stored(rows.where("node is not null").groupBy("label", "node").agg(
        F.count(F.lit(1)).alias("copies"), F.min("id").alias("least")), "nodes")
    distinct_vectors = stored(rows.where("node is not null").select("label", "node", "vector").dropDuplicates(["node"])
                              .withColumn("size", F.size("vector")).join(
                                  counted.select("node", "copies"), "node"), "distinct")
    n = distinct_vectors.count()
    links = None
    if n:
        # centroids for the most frequent length; vectors of other lengths have one cell of their own
        size = distinct_vectors.groupBy("size").count().orderBy(F.desc("count"), "size").first()["size"]
        of_size = distinct_vectors.where(F.col("size") == size)
        k = cells or min(MAX_CELLS, max(2, -(-n // CELL)))
        part = F.pmod(F.xxhash64("node"), F.lit(1 << 30)) < int(min(1.0, fit_rows / n) * (1 << 30))
        fitted = stored(of_size.where(part).select("node", "vector"), "sample")
        centres = spherical_kmeans(fitted if not fitted.isEmpty() else of_size.limit(fit_rows), k)
        links = stored(_links(_assign(distinct_vectors, centres, cosine), cosine, block), "links")
    if links is None:
        return rows.select(F.col("id").alias(id_col), F.lit(0).cast("long").alias("n_links"),
                           F.col("id").alias("component_id"), F.lit(True).alias("kept"))
    linked = links.groupBy("node").agg(F.sum("linked").alias("linked"))
    comp = components(links.select(F.col("node").alias("a"), F.col("root").alias("b")))
    info = counted.select("node", "copies", "least").join(linked, "node", "left").join(comp, "node", "left").select(
        "node", "copies", "least", F.coalesce("linked", F.lit(0)).alias("linked"),
        F.coalesce("component", "node").alias("component"))
    info = stored(info, "info")
    least = info.groupBy("component").agg(F.min("least").alias("component_id"))
    info = info.join(least, "component").select("node", (F.col("linked") + F.col("copies") - 1).alias("n_links"),
                                                "component_id")
    found = rows.select("id", "node").join(info, "node", "left")
    comp_id = F.when(F.col("node").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return found.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                        comp_id.alias("component_id"), F.col("id").eqNullSafe(comp_id).alias("kept"))

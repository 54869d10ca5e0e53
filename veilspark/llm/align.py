"""Alignment of two tokenizers: where the tokens of both end at the same byte.

Tokenizer A is a byte-level BPE (a ``tokenizers`` JSON file) and encodes a blank and the
text; tokenizer B is a sentence-piece BPE and encodes the text, to which it adds the
blank itself. The cumulative byte ends of either side are keys of a dictionary from end
to index; the sorted common keys slice both id lists into groups, and every slice is
expanded into its links: the A-B occurrence pairs whose byte ranges end together.

Neither side joins what stands on the two sides of a blank that comes before a sign
(B: checked on its pieces when the tables are built), so both end there, and a text is
aligned stretch by stretch; stretches met before come from a bounded memory. A text in
which a blank stands before other white space, or ends the text, is aligned as a whole.

How often two ids are linked is counted over all texts. A pair with over 1 / ``HOT_PAIRS``
of all links is hot: there are at most ``HOT_PAIRS`` of these, so they are broadcast. The
other pairs are joined by a shuffle, in which no key holds more than that share.

Defined cases: a null or empty text, and a text whose joined token bytes differ from a
blank and the text (a literal U+2581, for one), have no tokens on either side and no
links. Repeated rows are rows of their own, and each counts. An empty table gives an
empty result. Only the id column is carried (any type, nulls too); other columns are
not read, so their names cannot clash.
"""

from __future__ import annotations

import gc
import hashlib
import os
from collections.abc import Iterable, Iterator
from itertools import accumulate, chain, pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

#: pairs that may be broadcast (17 bytes each)
HOT_PAIRS = 1 << 18
#: texts are encoded together up to so many characters; rows of one Arrow batch that leaves a task
BATCH_CHARS, ROWS_OUT = 2_000_000, 512
#: stretches that a task remembers (and those of one batch more), and the longest of them
REMEMBERED, STRETCH_CHARS = 300_000, 48

_ODD_BLANK = regex.compile(r" (?:\s|\Z)")


def _byte_of_sign() -> dict[str, int]:
    """The byte that each sign of a byte-level vocabulary stands for: printable ones for
    themselves, the others in order from U+0100."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def slices(lengths_a: list[int], lengths_b: list[int]) -> tuple[list[int], list[int], list[int]]:
    """The common ends of two lists of token lengths over the same bytes, in order, and where the groups that end
    there end in either list. Where tokens without bytes share an end, the last of them ends the group."""
    at_a = dict(zip(accumulate(lengths_a), range(1, len(lengths_a) + 1)))
    at_b = dict(zip(accumulate(lengths_b), range(1, len(lengths_b) + 1)))
    common = sorted(at_a.keys() & at_b.keys())
    return common, list(map(at_a.__getitem__, common)), list(map(at_b.__getitem__, common))


def links(group: tuple[int, int, int, int], lengths_a: list[int], lengths_b: list[int]) -> list[tuple[int, int]]:
    """(A index, B index) of a group's occurrence pairs that end together: its last tokens, and those before
    them that only tokens without bytes follow."""
    a, i, b, j = group
    first_a, first_b = i - 1, j - 1
    while first_a > a and not lengths_a[first_a]:
        first_a -= 1
    while first_b > b and not lengths_b[first_b]:
        first_b -= 1
    return [(x, y) for x in range(first_a, i) for y in range(first_b, j)]


class Tables:
    """Both tokenizers, built in a worker: token bytes by id, and what was aligned before."""

    def __init__(self, a_json: str, b_model: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(a_json)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_model)
        of = _byte_of_sign()
        self.bytes_a = [b""] * self.a.get_vocab_size()
        for token, i in self.a.get_vocab().items():
            self.bytes_a[i] = bytes(map(of.__getitem__, token)) if all(c in of for c in token) else token.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.vocab_size())]
        self.bytes_b = [bytes([int(p[3:-1], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                        for i, p in enumerate(pieces)]
        self.length_a, self.length_b = list(map(len, self.bytes_a)), list(map(len, self.bytes_b))
        self.digits = list(map(str, range(max(len(self.bytes_a), len(self.bytes_b)))))
        self.by_stretch = not any("▁" in p.lstrip("▁") for p in pieces)
        self.forget()

    def _align(self, texts: list[str]) -> list[tuple | None]:
        """(n_a << 32 | n_b, packed links, groups as text) of a blank and each text; None where the bytes differ."""
        a = [e.ids for e in self.a.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)]
        b = self.b.encode(texts, num_threads=1)
        raws = [b" " + t.encode() for t in texts]
        if self._same(chain.from_iterable(a), chain.from_iterable(b), b"".join(raws)):
            if (out := self._sliced(a, b, raws)) is not None:
                return out
        good = [i for i, raw in enumerate(raws) if self._same(a[i], b[i], raw)]
        out = [None] * len(texts)
        for i in good:
            out[i] = self._sliced([a[i]], [b[i]], [raws[i]])[0]
        return out

    def _same(self, ids_a: Iterable[int], ids_b: Iterable[int], raw: bytes) -> bool:
        """Whether the tokens of both sides are these bytes."""
        return (b"".join(map(self.bytes_a.__getitem__, ids_a)) == raw
                and b"".join(map(self.bytes_b.__getitem__, ids_b)) == raw)

    def _sliced(self, a: list[list[int]], b: list[list[int]], raws: list[bytes]) -> list[tuple] | None:
        """As ``_align``, of texts laid end to end whose bytes are the same; None if a side has no end where a text ends."""
        ids_a, ids_b = list(chain.from_iterable(a)), list(chain.from_iterable(b))
        lengths_a, lengths_b = list(map(self.length_a.__getitem__, ids_a)), list(map(self.length_b.__getitem__, ids_b))
        common, to_a, to_b = slices(lengths_a, lengths_b)
        bounds = np.fromiter(accumulate(map(len, raws)), dtype=np.int64, count=len(raws))
        ends = np.array(common, dtype=np.int64)
        cuts = np.searchsorted(ends, bounds, side="right")  # how many groups there are up to a text's end
        if not len(ends) or not (ends[np.maximum(cuts, 1) - 1] == bounds).all():
            return None
        cuts = [0, *cuts.tolist()]
        digits_a, digits_b = list(map(self.digits.__getitem__, ids_a)), list(map(self.digits.__getitem__, ids_b))
        groups = list(zip([0, *to_a[:-1]], to_a, [0, *to_b[:-1]], to_b))
        parts = [digits_a[i] + "|" + digits_b[k] if j - i == 1 == m - k else
                 ",".join(digits_a[i:j]) + "|" + ",".join(digits_b[k:m]) for i, j, k, m in groups]
        if 0 in lengths_a or 0 in lengths_b:
            found = [[ids_a[x] << 32 | ids_b[y] for x, y in links(g, lengths_a, lengths_b)] for g in groups]
            packed = [np.array(x, dtype=np.int64).tobytes() for x in found]
            linked = [b"".join(packed[i:j]) for i, j in pairwise(cuts)]
        else:
            last_a = np.array(ids_a, dtype=np.int64)[np.array(to_a) - 1]
            flat = (last_a << 32 | np.array(ids_b, dtype=np.int64)[np.array(to_b) - 1]).tobytes()
            linked = [flat[8 * i:8 * j] for i, j in pairwise(cuts)]
        return [(len(x) << 32 | len(y), own, ";".join(parts[i:j])) for x, y, own, (i, j) in zip(a, b, linked, pairwise(cuts))]

    def align(self, texts: list[str]) -> Iterator[tuple | None]:
        """(n_a, n_b, packed links, groups as text) of whole texts; None without tokens."""
        whole = [not t or not self.by_stretch or t[0].isspace() or bool(_ODD_BLANK.search(t)) for t in texts]
        parts = [[] if w else t.split(" ") for t, w in zip(texts, whole)]
        asked = set(chain.from_iterable(parts))
        missing = list(asked - self.known.keys())
        known = self.known
        if missing:
            known.update(zip(missing, self._align(missing)))
        bad = {s for s in asked if known[s] is None}
        # what is remembered is settled before the first answer: who asks may not wait for the last
        if len(known) > REMEMBERED:
            self.known = {s: known[s] for s in asked if len(s) <= STRETCH_CHARS}  # what this batch has asked for stays
        elif any(len(s) > STRETCH_CHARS for s in missing):
            self.known = {s: v for s, v in known.items() if len(s) <= STRETCH_CHARS}
        for text, w, own in zip(texts, whole, parts):
            if not text or (bad and not bad.isdisjoint(own)):
                yield None
                continue
            found = self._align([text]) if w else list(map(known.__getitem__, own))
            if w and found[0] is None:
                yield None
                continue
            counts, linked, groups = zip(*found)
            n = sum(counts)
            yield n >> 32, n & 0xFFFFFFFF, b"".join(linked), ";".join(groups)

    def forget(self) -> None:
        self.known: dict[str, tuple | None] = {}


_built: dict[int, Tables] = {}


def _tables(a_json: str, b_model: bytes) -> Tables:
    """A worker's tables; it keeps those of one pair of tokenizers."""
    key = hash((a_json, b_model))
    if key not in _built:
        _built.clear()
        _built[key] = Tables(a_json, b_model)
    return _built[key]


class Aligner:
    """The two tokenizers' files (by their paths on the driver)."""

    def __init__(self, a_json: str, b_model: str):
        with open(a_json, encoding="utf-8") as f:
            self.a_json = f.read()
        with open(b_model, "rb") as f:
            self.b_model = f.read()

    def alignments(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   groups: bool = False) -> DataFrame:
        """Per row: id, n_a, n_b, n_groups, n_links, groups_sha256, its distinct linked ids as ``pairs``
        (A id << 32 | B id) with ``times``, and the groups themselves if asked for."""
        a_json, b_model = self.a_json, self.b_model
        names = ["n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times", "groups"][:8 if groups else 7]
        types = [pa.int64()] * 4 + [pa.string(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.string()]
        kinds = ["long"] * 4 + ["string", "array<long>", "array<long>", "string"]
        rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
        id_type = rows.schema["id"].dataType

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            tables = _tables(a_json, b_model)
            gc.freeze()  # what is remembered has no cycles: the collector need not look through it again and again
            gc.disable()
            try:
                for batch in batches:
                    yield from rows_of(tables, batch)
            finally:
                tables.forget()
                gc.unfreeze()
                gc.enable()

        def rows_of(tables: Tables, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            for lo, hi in _bounded(batch.column(1)):
                texts = batch.column(1).slice(lo, hi - lo).to_pylist()
                out = []
                for at, (text, got) in enumerate(zip(texts, tables.align(texts)), lo):
                    out.append(_row(text, got))
                    if len(out) == ROWS_OUT or at == hi - 1:
                        ids = batch.column(0).slice(at + 1 - len(out), len(out))
                        columns = [pa.array(c, type=t) for c, t in zip(zip(*out), types[:len(names)])]
                        yield pa.RecordBatch.from_arrays([ids, *columns], names=["id", *names])
                        out = []

        schema = ", ".join([f"id {id_type.simpleString()}", *(f"{n} {k}" for n, k in zip(names, kinds))])
        return rows.mapInArrow(run, schema)


def _bounded(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Row ranges of at most about BATCH_CHARS bytes."""
    size, lo = 0, 0
    for i, n in enumerate(pc.binary_length(texts).to_pylist()):
        size += n
        if size >= BATCH_CHARS:
            yield lo, i + 1
            size, lo = 0, i + 1
    if lo < len(texts):
        yield lo, len(texts)


def _row(text: str, got: tuple | None) -> tuple:
    if got is None:
        return 0, 0, 0, 0, "", [], [], ""
    n_a, n_b, linked, groups = got
    pairs, times = np.unique(np.frombuffer(linked, dtype=np.int64), return_counts=True)
    return (n_a, n_b, groups.count(";") + bool(groups), len(linked) // 8, hashlib.sha256(groups.encode()).hexdigest(),
            pairs, times, groups)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(pair, n, best): links that hold the pair, over all rows; whether no other pair of its B id has more."""
    one = aligned.select(F.explode(F.arrays_zip("pairs", "times")).alias("p")).select("p.pairs", "p.times")
    n = stored(one.groupBy(F.col("pairs").alias("pair")).agg(F.sum("times").alias("n")), "pairs")
    b = F.col("pair").bitwiseAND(0xFFFFFFFF).alias("b")
    top = n.groupBy(b).agg(F.max("n").alias("top"))
    return n.withColumn("b", b).join(top, "b").select("pair", "n", (F.col("n") == F.col("top")).alias("best"))


def link_counts(aligned: DataFrame, hot_pairs: int = HOT_PAIRS) -> DataFrame:
    """``aligned`` (a stored table) without its pairs, with n_best and count_sum over each row's links."""
    counts = stored(pair_counts(aligned), "pair_counts")
    total = counts.agg(F.sum("n")).first()[0] or 0
    is_hot = F.col("n") * F.lit(hot_pairs) > F.lit(total)
    top = counts.where(is_hot).toPandas().sort_values("pair")  # fewer than hot_pairs rows
    keys, n, best = (top[c].to_numpy() for c in ("pair", "n", "best"))
    spread = aligned.sparkSession.sparkContext.broadcast((keys.astype(np.int64), n.astype(np.int64), best.astype(bool)))

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, n, best = spread.value
        for batch in batches:
            pairs, times = batch.column(1), batch.column(2)
            sums, bests, cold, cold_times = [], [], [], []
            for p, t in zip(pairs, times):
                p = p.values.to_numpy(zero_copy_only=False)
                t = t.values.to_numpy(zero_copy_only=False)
                at = np.minimum(np.searchsorted(keys, p), max(len(keys) - 1, 0))
                hit = keys[at] == p if len(keys) else np.zeros(len(p), dtype=bool)
                at, own = at[hit], t[hit]
                sums.append(int(n[at] @ own))
                bests.append(int(own[best[at]].sum()))
                cold.append(p[~hit])
                cold_times.append(t[~hit])
            kept = [batch.column(0), pa.array(bests, pa.int64()), pa.array(sums, pa.int64()),
                    pa.array(cold, pa.list_(pa.int64())), pa.array(cold_times, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(kept, names=["row", "n_best", "count_sum", "pairs", "times"])

    found = aligned.select("row", "pairs", "times").mapInArrow(
        look_up, "row long, n_best long, count_sum long, pairs array<long>, times array<long>")
    rare = (found.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("p"))
            .select("row", F.col("p.pairs").alias("pair"), F.col("p.times").alias("times"))
            .join(counts.where(~is_hot), "pair")
            .select("row", F.when(F.col("best"), F.col("times")).otherwise(0).alias("n_best"),
                    (F.col("times") * F.col("n")).alias("count_sum")))
    own = [c for c in aligned.columns if c not in ("row", "pairs", "times")]
    head = aligned.select("row", F.struct(*own).alias("own"), F.lit(0).cast("long").alias("n_best"),
                          F.lit(0).cast("long").alias("count_sum"))
    parts = [df.select("row", F.lit(None).cast(head.schema["own"].dataType).alias("own"), "n_best", "count_sum")
             for df in (found, rare)]
    return (head.unionByName(parts[0]).unionByName(parts[1]).groupBy("row")
            .agg(F.max("own").alias("own"), F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
            .select("own.*", "n_best", "count_sum"))


def align(docs: DataFrame, aligner: Aligner, id_col: str = "doc_id", text_col: str = "text",
          groups: bool = False, hot_pairs: int = HOT_PAIRS) -> DataFrame:
    """Per row of ``docs``: id, n_a, n_b, n_groups, n_links, groups_sha256 (and groups), n_best, count_sum."""
    aligned = aligner.alignments(docs, id_col, text_col, groups).withColumn("row", F.monotonically_increasing_id())
    # the row numbers hold from the moment the table is written
    return link_counts(stored(aligned, "aligned"), hot_pairs).withColumnRenamed("id", id_col)

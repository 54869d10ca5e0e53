"""Byte-level BPE encoding and decoding with a given rank file.

Texts of up to ``chunk_chars`` characters are encoded where they are. Longer ones are
cut into chunks that overlap; Spark deals the chunks to its tasks, and each is
pre-tokenised from its own start. Where a cut falls inside a pre-token, the first
boundaries of a chunk are wrong until they meet those of the chunk before it. The next
match of the pattern depends only on the text after a boundary, so from a boundary
that both share on, both agree: that is where the chunks are stitched (at the first one
with no white space before it, as a run of white space is matched by what follows). The pieces
between stitches begin and end at true boundaries and are encoded independently; a
text's ids are its pieces' ids in order. If two neighbours share no boundary in their
overlap, the whole text becomes one piece, so the result is exact in any case.

Ids are a binary column: unsigned 32-bit little-endian numbers. Decoding concatenates
the tokens' bytes.

Defined cases: a null text is encoded as the empty one (no ids); null ids decode to no
bytes. Equal long texts are encoded once. Rows may repeat; extra columns pass through,
whatever their names.
"""

from __future__ import annotations

import base64
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import fresh, whole_text

CHUNK_CHARS = 32_768
OVERLAP_CHARS = 512
#: a match is certain if so many characters of the text follow it (the pattern looks ahead this far)
LOOK_AHEAD = 3
#: white space as the pattern has it (fixed values: Unicode's White_Space)
SPACE = frozenset(
    "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000")


def token_list(rank_file: bytes) -> list[bytes]:
    """Token bytes by rank (empty where a rank is free)."""
    ranks = {int(b): base64.b64decode(a) for a, b in (line.split() for line in rank_file.splitlines() if line)}
    return [ranks.get(i, b"") for i in range(max(ranks) + 1)]


class Encoder:
    """Ranks and pattern: the merges run in tiktoken, boundaries are matched here."""

    def __init__(self, rank_file: bytes, pattern: str):
        import tiktoken

        self.tokens = token_list(rank_file)
        self.pattern = regex.compile(pattern)
        ranks = {token: rank for rank, token in enumerate(self.tokens) if token}
        self.encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def encode_many(self, texts: Iterable[str]) -> list[bytes]:
        """Ids of whole texts; the strings of special tokens are plain text."""
        return [np.array(self.encoding.encode_ordinary(t), dtype="<u4").tobytes() for t in texts]

    def boundaries(self, text: str, whole: bool) -> list[int]:
        """0 and the ends of the matches from the start of ``text``; only certain ones unless ``whole``."""
        last = len(text) if whole else len(text) - LOOK_AHEAD
        out = [0]
        for m in self.pattern.finditer(text):
            if m.end() > last:
                break
            out.append(m.end())
        return out

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))


_encoders: dict[int, Encoder] = {}


class Tokenizer:
    """A rank file (by its path on the driver) and a pattern; workers build the tables once."""

    def __init__(self, rank_path: str, pattern: str, chunk_chars: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS):
        if not LOOK_AHEAD < overlap <= chunk_chars:
            raise ValueError("the overlap must be longer than the pattern looks ahead, and no longer than a chunk")
        with open(rank_path, "rb") as f:
            self.rank_file = f.read()
        self.pattern, self.chunk_chars, self.overlap = pattern, chunk_chars, overlap

    def __getstate__(self):
        return self.__dict__.copy()

    def encoder(self) -> Encoder:
        key = hash((self.rank_file, self.pattern))
        if key not in _encoders:
            _encoders.clear()  # a worker keeps the tables of one
            _encoders[key] = Encoder(self.rank_file, self.pattern)
        return _encoders[key]

    # expressions ---------------------------------------------------------------------------

    def encode_column(self, text: Column) -> Column:
        me = self

        @F.pandas_udf("binary")
        def encode(texts: pd.Series) -> pd.Series:
            return pd.Series(me.encoder().encode_many(texts), dtype=object)

        return encode(F.coalesce(text.cast("string"), F.lit("")))

    def round_trip_column(self, text: Column) -> Column:
        """struct(ids, decoded): both from one worker."""
        me = self

        @F.pandas_udf("ids binary, decoded binary")
        def round_trip(texts: pd.Series) -> pd.DataFrame:
            enc = me.encoder()
            ids = enc.encode_many(texts)
            return pd.DataFrame({"ids": pd.Series(ids, dtype=object),
                                 "decoded": pd.Series(list(map(enc.decode, ids)), dtype=object)})

        return round_trip(F.coalesce(text.cast("string"), F.lit("")))

    def decode_column(self, ids: Column) -> Column:
        rank_file = self.rank_file

        @F.pandas_udf("binary")
        def decode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            tokens = token_list(rank_file)  # decoding needs no other table
            for rows in batches:
                yield pd.Series([b"".join(map(tokens.__getitem__, np.frombuffer(r, dtype="<u4").tolist())) for r in rows],
                                dtype=object)

        return decode(F.coalesce(ids, F.lit(b"")))

    # DataFrames ----------------------------------------------------------------------------

    def encode(self, docs: DataFrame, text_col: str = "text", out: str = "ids", decoded: str | None = None) -> DataFrame:
        """``docs`` with the ids of each whole text, and with what they decode to if ``decoded`` names a column."""
        body, key, done = fresh(docs, "body_", "key_", "done_")
        rows = docs.withColumn(body, whole_text(text_col))
        short = rows.where(F.length(body) <= self.chunk_chars)
        long = rows.where(F.length(body) > self.chunk_chars)
        keyed = long.withColumn(key, F.sha2(body, 256))
        texts = keyed.select(F.col(key).alias("key"), F.col(body).alias("text")).dropDuplicates(["key"])
        found = self.encode_long(texts, bool(decoded)).select(F.col("key").alias(key), F.col("done").alias(done))
        names = {out: "ids"} | ({decoded: "decoded"} if decoded else {})
        columns = [F.col(c) for c in docs.columns if c.lower() not in {n.lower() for n in names}]
        columns += [F.col(f"{done}.{part}").alias(n) for n, part in names.items()]
        return (short.withColumn(done, self._done(F.col(body), bool(decoded))).select(*columns)
                .unionByName(keyed.join(found, key).select(*columns)))

    def _done(self, text: Column, decoded: bool) -> Column:
        return self.round_trip_column(text) if decoded else F.struct(self.encode_column(text).alias("ids"))

    def chunks(self, texts: DataFrame) -> DataFrame:
        """(key, text) as overlapping chunks: key, k, chunk, total (the text's length in chunks)."""
        size, overlap = self.chunk_chars, self.overlap
        schema = pa.schema([("key", pa.string()), ("k", pa.int32()), ("chunk", pa.string()), ("total", pa.int32())])

        def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for key, text in zip(batch.column("key").to_pylist(), batch.column("text").to_pylist()):
                    total = -(-len(text) // size)
                    for k in range(total):  # a chunk a batch: memory holds one text and one chunk
                        chunk = text[k * size:(k + 1) * size + overlap]
                        yield pa.RecordBatch.from_arrays([pa.array(x, type=f.type) for x, f in zip(
                            ([key], [k], [chunk], [total]), schema)], schema=schema)

        return texts.mapInArrow(cut, "key string, k int, chunk string, total int")

    def boundaries_column(self, chunk: Column, last: Column) -> Column:
        """struct(head, tail): boundaries in the first ``overlap`` characters of this chunk, and those of the next
        chunk's that may be cut at."""
        me = self

        @F.pandas_udf("head array<int>, tail array<int>")
        def pretokenise(chunks: pd.Series, whole: pd.Series) -> pd.DataFrame:
            enc, head, tail = me.encoder(), [], []
            for text, is_last in zip(chunks, whole):
                b = np.array(enc.boundaries(text, bool(is_last)), dtype=np.int32)
                head.append(b[b <= me.overlap])
                # a piece must not end in white space: at its end, a run of it would be matched as one
                tail.append(np.array([x for x in b[b >= me.chunk_chars].tolist() if text[x - 1] not in SPACE],
                                     dtype=np.int32) - me.chunk_chars)
            return pd.DataFrame({"head": head, "tail": tail})

        return pretokenise(chunk, last)

    def pieces(self, texts: DataFrame) -> DataFrame:
        """(key, text) as pieces that begin and end at true pre-token boundaries: key, piece, text."""
        size = self.chunk_chars
        # a chunk that reaches the text's end sees all that the pattern may look at
        at_end = F.length("chunk") < F.lit(size + self.overlap)
        dealt = self.chunks(texts).repartition("key", "k")
        b = dealt.withColumn("b", self.boundaries_column(F.col("chunk"), at_end | (F.col("k") == F.col("total") - 1)))
        by_text = Window.partitionBy("key").orderBy("k")
        met = F.array_min(F.array_intersect(F.lag("b.tail").over(by_text), F.col("b.head")))
        cut = b.withColumn("at", F.when(F.col("k") == 0, 0).otherwise(met))
        cut = cut.withColumn("next", F.lead("at").over(by_text)).withColumn(
            "good", F.min(F.col("at").isNotNull()).over(Window.partitionBy("key")))
        start = F.when(F.col("good"), F.col("at")).otherwise(0)
        end = F.when(F.col("k") == F.col("total") - 1, F.length("chunk")).otherwise(
            F.lit(size) + F.when(F.col("good"), F.col("next")).otherwise(0))
        part = cut.select("key", F.when(F.col("good"), F.col("k")).otherwise(0).alias("piece"), "k",
                          F.substring("chunk", start + 1, end - start).alias("part"))
        parts = F.array_sort(F.collect_list(F.struct("k", "part")))
        return part.groupBy("key", "piece").agg(
            F.array_join(F.transform(parts, lambda x: x["part"]), "").alias("text"))

    def encode_long(self, texts: DataFrame, decoded: bool = False) -> DataFrame:
        """(key, done) of each (key, text), by pieces: ids, and what they decode to if asked for."""
        parts = ["ids", "decoded"][:1 + decoded]
        got = self.pieces(texts).select("key", "piece", self._done(F.col("text"), decoded).alias("done"))
        in_order = lambda part: F.array_sort(F.collect_list(F.struct("piece", F.hex(f"done.{part}").alias("x"))))
        whole = lambda part: F.unhex(F.array_join(F.transform(part, lambda x: x["x"]), ""))
        rows = got.groupBy("key").agg(*[in_order(p).alias(p) for p in parts])
        return rows.select("key", F.struct(*[whole(p).alias(p) for p in parts]).alias("done"))

    def decode(self, docs: DataFrame, ids_col: str = "ids", out: str = "decoded") -> DataFrame:
        """``docs`` with the bytes that its ids stand for."""
        return docs.withColumn(out, self.decode_column(F.col(ids_col)))

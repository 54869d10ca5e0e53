"""Quality rules: base measures, and how much likelier a text's n-grams are in a trusted corpus than in the raw one.

Words are the runs of signs that aren't white space (blank, U+0009 to U+000D). The n-grams
are each word, each pair of neighbouring words (a word that follows itself is one shared
pair, so that stuttering looks alike whatever it repeats) and each word's last two
signs; each kind is hashed to ``SLOTS`` places of its own.

Two multinomials over the places are counted in one scan: the raw corpus (every n-gram of
every document) and the trusted target (all documents that the labels call good). Their ids
first set bits in bitmaps of ``BITS`` hashes, 4 MB however many they are, which are broadcast;
only the texts whose id hits a bit are shuffled to the ids and compared with them. What is
shuffled is so in proportion to the trusted texts, at every size, and never more than the
texts once. Both are smoothed by one count per place. A document's
verdict is the mean of log(target / raw) over its n-grams; it is kept if that is at least
``LEAST_RATIO`` and no base rule fails (fewer than 50 words; more than half of the words
in three-word windows that the text has twice). Ratios are whole millionths, so sums
don't depend on the order of the rows and the threshold decides alike on every run.

All of it is built-in functions: base measures are array expressions per row (windows are
compared by a 64-bit hash within one text; only texts with an equal pair sort theirs), the
ratio is an explode, a join with the bounded table of places, and a sum per row.

Defined cases: a null, empty or blank text has no words and fails the base rules.
Without trusted documents, or with none that has words, the target equals the raw corpus
(every ratio is 0, and the base rules alone decide). Labels may repeat or be null; only
rows of the wanted value count. Repeated documents are rows of their own. Of the input
only the id and the text are read, so extra columns cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BITS, may_be_among, stored, whole_text

WORD = r"[^\x20\x09-\x0D]+"
NOT_SYMBOLS = "[^#*$%&|<>]+"
#: places per kind of n-gram (words, pairs, endings); the table of ratios has three times as many rows
SLOTS = 1 << 14
#: least mean of log(target / raw) over the n-grams of a document: half a nat rarer in trusted text than in the raw corpus
LEAST_RATIO = -0.5
LEAST_WORDS, REPEAT_PERCENT = 50, 50
KINDS = ("word", "pair", "ending")
_UNIT = 1_000_000


def n_symbols(text: Column) -> Column:
    return F.length(F.regexp_replace(text, NOT_SYMBOLS, "")).cast("long")


def n_dup_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return (F.size(lines) - F.size(F.array_distinct(lines))).cast("long")


def windows(words: Column) -> Column:
    """A 64-bit hash of each three neighbouring words."""
    n = F.size(words)
    pairs = F.arrays_zip(words.alias("a"), F.slice(words, 2, n).alias("b"), F.slice(words, 3, n).alias("c"))
    hashed = F.transform(pairs, lambda p: F.xxhash64(p["a"], p["b"], p["c"]))
    return F.when(n >= 3, F.slice(hashed, 1, n - 2))


def _places_twice(placed: Column) -> Column:
    """Places whose hash the array, sorted by (hash, place), has twice, in order."""
    same = lambda x, i: F.get(placed, i)["h"] == x["h"]
    twice = F.transform(placed, lambda x, i: F.when(same(x, i - 1) | same(x, i + 1), x["i"]))
    return F.sort_array(F.filter(twice, lambda x: x.isNotNull()))


def base_measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """Per row: id, words, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    rows = docs.select(F.col(id_col).alias("id"), whole_text(text_col).alias("text"), *carry)
    rows = rows.withColumn("words", F.regexp_extract_all("text", F.lit(WORD), 0))
    rows = rows.select(
        "id", *carry, "words", F.size("words").cast("long").alias("n_words"),
        F.length(F.regexp_replace("text", r"[\x20\x09-\x0D]+", "")).cast("long").alias("word_chars"),
        n_symbols(F.col("text")).alias("n_symbols"), n_dup_lines(F.col("text")).alias("n_dup_lines"),
        windows(F.col("words")).alias("h"))
    # each array is a column of its own, so that a lambda reads it and does not make it anew
    rows = rows.withColumn("placed", F.when(F.size(F.array_distinct("h")) < F.size("h"), F.sort_array(
        F.transform("h", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    rows = rows.withColumn("places", _places_twice(F.col("placed")))
    steps = F.transform("places", lambda p, i: F.least(F.lit(3), F.coalesce(F.get("places", i + 1) - p, F.lit(3))))
    rows = rows.withColumn("n_repeat_words", F.coalesce(
        F.aggregate(steps, F.lit(0).cast("long"), lambda a, x: a + x), F.lit(0).cast("long")))
    return rows.withColumn("base_failed", (F.col("n_words") < LEAST_WORDS) | (
        100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))).drop("h", "placed", "places")


# n-grams ----------------------------------------------------------------------------------

def places(rows: DataFrame, slots: int = SLOTS) -> DataFrame:
    """``rows`` (with words) as one row per word: its places of each kind in 0 .. 3 * slots (a pair's place is
    null at the last word)."""
    zipped = F.arrays_zip(F.col("words").alias("a"), F.slice("words", 2, F.size("words")).alias("b"))
    each = rows.withColumn("w", F.explode(zipped)).drop("words")
    a, b = F.col("w.a"), F.col("w.b")
    return each.select(
        *[c for c in each.columns if c != "w"], F.pmod(F.xxhash64(a), F.lit(slots)).alias("word"),
        F.when(a == b, slots).when(b.isNotNull(), slots + F.pmod(F.xxhash64(a, b), F.lit(slots))).alias("pair"),
        (2 * slots + F.pmod(F.xxhash64(F.substring(a, -2, 2)), F.lit(slots))).alias("ending"))


def trusted_ids(labels: DataFrame, id_col: str = "doc_id", label: str = "quality", good: int = 1,
                bound: int | None = None) -> DataFrame:
    """Distinct ids that the labels call good: all, or about ``bound`` at most, by a hash of the id, if a caller asks."""
    ids = labels.where((F.col(label) == good) & F.col(id_col).isNotNull()).select(F.col(id_col).alias("id")).distinct()
    n = ids.count() if bound is not None else 0
    if bound is not None and n > bound:
        ids = ids.where(F.pmod(F.xxhash64("id", F.lit("trusted")), F.lit(1 << 30)) < int(bound / n * (1 << 30)))
    return ids


def may_be_trusted(rows: DataFrame, ids: DataFrame, bits: int = BITS) -> DataFrame:
    """``rows`` with ``maybe``: false for ids that are surely not among ``ids`` (trusted_id), true for all that are and,
    by a hash, a few others."""
    if rows.schema["id"].dataType != ids.schema["trusted_id"].dataType:  # equal ids of two types have two hashes
        return rows.withColumn("maybe", F.col("id").isNotNull())
    return may_be_among(rows, ["id"], ids, ["trusted_id"], bits=bits).withColumn("maybe", F.col("id").isNotNull() & F.col("maybe"))


def marked(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(text, good) of every row: good is 1 if its id is trusted, else 0."""
    ids = stored(trusted.select(F.col("id").alias("trusted_id")), "trusted")
    rows = may_be_trusted(docs.select(F.col(id_col).alias("id"), whole_text(text_col).alias("text")), ids)
    # a shuffle at every size: a broadcast of the ids would grow with the input until it turns into one
    found = rows.where("maybe").join(ids.hint("shuffle_hash"), F.col("id") == F.col("trusted_id"), "left")
    return rows.where("NOT maybe").select("text", F.lit(0).cast("long").alias("good")).unionByName(
        found.select("text", F.col("trusted_id").isNotNull().cast("long").alias("good")))


def ratios(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           slots: int = SLOTS) -> DataFrame:
    """(place, ratio) for every place of every kind: log(target / raw) in whole millionths."""
    rows = marked(docs, trusted, id_col, text_col).select(
        F.regexp_extract_all("text", F.lit(WORD), 0).alias("words"), "good")
    each = places(rows, slots).select("good", F.explode(F.array(*KINDS)).alias("place")).where("place IS NOT NULL")
    counted = each.groupBy("place").agg(F.count(F.lit(1)).alias("raw"), F.sum("good").alias("target"))
    counted = stored(counted, "places")  # 3 * slots rows at most
    every = docs.sparkSession.range(len(KINDS) * slots).select(F.col("id").alias("place"))
    full = every.join(F.broadcast(counted), "place", "left").fillna(0, ["raw", "target"]).withColumn(
        "kind", F.floor(F.col("place") / slots))
    sums = full.groupBy("kind").agg(F.sum("raw").alias("all_raw"), F.sum("target").alias("all_target"))
    smooth = full.join(F.broadcast(sums), "kind")
    ratio = F.log((F.col("target") + 1) / (F.col("all_target") + slots)) - F.log((F.col("raw") + 1) / (F.col("all_raw") + slots))
    return smooth.select("place", F.when(F.col("all_target") > 0, F.round(ratio * _UNIT).cast("long")).otherwise(0).alias("ratio"))


def judge(docs: DataFrame, table: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          least: float = LEAST_RATIO, slots: int = SLOTS) -> DataFrame:
    """Every row's base measures, its ratio (null without words) and whether it is kept."""
    rows = base_measures(docs, id_col, text_col).withColumn("row", F.monotonically_increasing_id())
    kept = [c for c in rows.columns if c != "words"]
    each = places(rows.withColumn("words", F.when(F.size("words") > 0, F.col("words"))
                                  .otherwise(F.array(F.lit("")))), slots)
    sums = F.lit(0)
    for kind in KINDS:  # the table has 3 * slots rows
        own = F.broadcast(table.select(F.col("place").alias(kind), F.col("ratio").alias(f"{kind}_ratio")))
        each = each.join(own, kind, "left")
        sums = sums + F.coalesce(f"{kind}_ratio", F.lit(0))
    total = each.groupBy(*kept).agg(F.sum(sums).alias("total"))
    grams = F.when(F.col("n_words") > 0, 3 * F.col("n_words") - 1)
    ratio = F.col("total") / (grams * _UNIT)
    return total.select(
        F.col("id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        F.when(F.col("n_words") > 0, ratio).alias("ratio"),
        (~F.col("base_failed") & (F.coalesce(ratio, F.lit(0.0)) >= least)).alias("kept"))


def quality_rules(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``judge`` with the ratios of ``docs`` against the documents that ``labels`` trusts."""
    return judge(docs, ratios(docs, trusted_ids(labels, id_col), id_col, text_col), id_col, text_col)

"""Mixing sources to target weights: iterative proportional fitting, then sampling.

Documents are summed to cells (source, language, topic) of tokens. Raking scales the
cells' token weights to each marginal's target shares in turn, for a fixed number of
rounds. The share of a cell's documents to keep is its weight per token, scaled so that no
cell's probability exceeds 1: the expected shares of the draw are then the raked ones. The
targets thus set how many tokens can be drawn without repeats, at most ``BUDGET`` of all.
A budget given by the caller comes before the targets: cells whose probability would exceed
1 are kept whole, the others share the rest, and the draw misses the targets by that. Each
document is drawn by a uniform number from a hash of its id, so a draw repeats on any cluster.

Only cells (at most sources x languages x topics) take part in the iterations; documents
are read twice: to count and to draw. All of it is DataFrame functions.

Targets default to the corpus's own shares raised to a power below 1, which lifts rare
values; a table of (value, share) may be given for any marginal.

Defined cases: a null source or language is the value ``unknown``; a null or empty text
has 0 tokens, topic ``empty``, and its cell's probability is that of an average token; a
null id draws by its text. Targets without a cell are left out and the others scaled up.
An empty table gives an empty result. Other columns pass through; one named like an output raises
an error.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, no_clash, stored

POWER = 0.7
ROUNDS = 8
BUDGET = 0.8
CAP_ROUNDS = 12
SEED = "mix-1"
NONE = "unknown"


def token_count(text: Column) -> Column:
    """Words between blanks, tabs and line ends."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^ \t\r\n]+")).cast("long")


def _signs(text: Column, sign: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(sign), F.lit("")))


def topic(text: Column, tokens: Column) -> Column:
    """A stand-in for a topic where the table has none: what kind of writing a text is."""
    t = F.coalesce(text, F.lit(""))
    return (F.when(tokens == 0, "empty").when(_signs(t, "|") * 5 > tokens, "table")
            .when((_signs(t, "#") + _signs(t, "$") + _signs(t, "%")) > tokens, "noise")
            .when(_signs(t, "!") > tokens, "shouting").when(tokens < 150, "note").when(tokens < 1000, "article")
            .otherwise("book"))


def _value(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(NONE))


def _target(cells: DataFrame, dim: str, given: DataFrame | None, power: float) -> DataFrame:
    """(dim, share) over the values that cells have; shares sum to 1."""
    own = cells.groupBy(dim).agg(F.sum("tokens").cast("double").alias("t")).where("t > 0")
    if given is None:
        raw = own.select(dim, F.pow("t", F.lit(power)).alias("share"))
    else:
        raw = own.join(given.select(F.col("value").alias(dim), "share"), dim, "left").select(
            dim, F.coalesce("share", F.lit(0.0)).alias("share"))
    total = raw.agg(F.sum("share")).first()[0]  # one number
    return raw.withColumn("share", F.col("share") / F.lit(total)) if total else raw


def rake(cells: DataFrame, dims: tuple[str, ...], targets: Mapping[str, DataFrame] | None = None,
         power: float = POWER, rounds: int = ROUNDS) -> DataFrame:
    """``cells`` (dims, tokens) with weight: tokens raked to the targets, in all as many as before."""
    total = float(cells.agg(F.sum("tokens")).first()[0] or 0)
    share = {d: stored(_target(cells, d, (targets or {}).get(d), power), f"target_{d}") for d in dims}
    w = cells.withColumn("weight", F.col("tokens").cast("double"))
    for _ in range(rounds):
        for d in dims:
            now = w.groupBy(d).agg(F.sum("weight").alias("now")).where("now > 0")
            factor = now.join(share[d], d).select(d, (F.col("share") * F.lit(total) / F.col("now")).alias("factor"))
            w = w.join(factor, d, "left").withColumn(
                "weight", F.col("weight") * F.coalesce("factor", F.lit(1.0))).drop("factor")
        w = stored(w, "raked")  # a round's plan does not hold the rounds before it
    return w


def probabilities(raked: DataFrame, budget: float | None = None, rounds: int = CAP_ROUNDS) -> DataFrame:
    """``raked`` with p, at most 1: in proportion to the weights, or of ``budget`` of the tokens in all."""
    ratio = F.when(F.col("tokens") > 0, F.col("weight") / F.col("tokens")).otherwise(F.lit(1.0))
    cells = raked.withColumn("ratio", ratio)
    if budget is None:
        top = cells.where("tokens > 0").agg(F.max("ratio")).first()[0]  # one number
        scale = min(BUDGET, 1 / top) if top else BUDGET
        return cells.withColumn("p", F.least(F.lit(1.0), F.col("ratio") * F.lit(scale)))
    aim = budget * float(cells.agg(F.sum("tokens")).first()[0] or 0)
    scale = budget
    for _ in range(rounds):  # cells that are kept whole leave the rest of the budget to the others
        whole = F.col("ratio") * F.lit(scale) >= 1
        taken, rest = cells.agg(F.sum(F.when(whole, F.col("tokens"))), F.sum(F.when(~whole, F.col("weight")))).first()
        if not rest:
            break
        last, scale = scale, (aim - float(taken or 0)) / float(rest)
        if scale == last:
            break
    return cells.withColumn("p", F.least(F.lit(1.0), F.col("ratio") * F.lit(scale)))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        lang_col: str = "lang", topic_of=topic, targets: Mapping[str, DataFrame] | None = None, power: float = POWER,
        rounds: int = ROUNDS, budget: float | None = None, seed: str = SEED,
        out: tuple[str, str, str, str] = ("tokens", "topic", "p", "kept")) -> DataFrame:
    """``docs`` with its tokens, topic, probability to be kept, and whether it is."""
    no_clash(docs, *out)
    src, lang, own = fresh(docs, "source_", "lang_", "id_")
    tokens, kind, p, kept = out
    rows = docs.withColumns({src: _value(source_col), lang: _value(lang_col), tokens: token_count(F.col(text_col))})
    rows = rows.withColumn(kind, topic_of(F.col(text_col), F.col(tokens)))
    dims = {src: "s", lang: "l", kind: "k"}
    cells = stored(rows.select(*[F.col(c).alias(d) for c, d in dims.items()], F.col(tokens).alias("tokens"))
                   .groupBy("s", "l", "k").agg(F.sum("tokens").alias("tokens")), "cells")
    named = {d: t for d, t in zip(("s", "l", "k"), [(targets or {}).get(n) for n in ("source", "lang", "topic")])
             if t is not None}
    done = stored(probabilities(rake(cells, ("s", "l", "k"), named, power, rounds), budget), "probabilities")
    found = rows.join(done.select(F.col("s").alias(src), F.col("l").alias(lang), F.col("k").alias(kind),
                                  F.col("p").alias(p)), [src, lang, kind])
    draw = F.conv(F.substring(F.md5(F.concat(F.coalesce(F.col(id_col).cast("string"), F.col(text_col), F.lit("")),
                                             F.lit("|" + seed))), 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32))
    found = found.withColumn(kept, draw < F.col(p))
    return found.select(*docs.columns, tokens, kind, p, kept)


def sample(docs: DataFrame, **settings) -> DataFrame:
    """The documents that the draw keeps, with their own columns."""
    out = tuple(fresh(docs, "tokens_", "topic_", "p_", "kept_"))
    return mix(docs, out=out, **settings).where(F.col(out[3])).select(*docs.columns)

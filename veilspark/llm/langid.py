"""Language identification: sparse softmax regression on TF-IDF character n-grams.

Texts are lower-cased, everything but letters becomes one blank, and character
1-, 2- and 3-grams are hashed to a fixed number of coordinates. Document frequencies
are counted over all training documents. The regression is trained by FTRL with
elastic-net penalties on a bounded sample, then one temperature is chosen on rows that
the training did not see, so that the scores are calibrated probabilities.

Defined cases: a null text or one without a letter is ``und`` with score 0. With no
training rows every text is ``und``. Ties between languages go to the first in
alphabetical order. Ids may be of any type. Other columns pass through; one named like an output
raises an error.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import ftrl
from .common import fresh, no_clash
from .words import mix

DIM = 1 << 16
#: training documents the regression is fitted on, at most (about; all, if there are fewer)
FIT_ROWS = 8_000
#: languages that are learned, at most: those with the most rows
MAX_LANGUAGES = 512
UNKNOWN = "und"

_letters: list[np.ndarray] = []


def _is_letter() -> np.ndarray:
    if not _letters:
        _letters.append(np.fromiter((unicodedata.category(chr(i))[0] == "L" for i in range(0x110000)), dtype=bool))
    return _letters[0]


def grams(text: str) -> np.ndarray:
    """Coordinates of all n-grams of a whole text, with repeats; empty without a letter."""
    c = np.frombuffer(text.lower().encode("utf-32-le", "replace"), dtype=np.uint32)
    letter = _is_letter()[c]
    if not letter.any():
        return np.empty(0, dtype=np.int64)
    c = np.where(letter, c, 32)
    c = np.concatenate([[32], c[letter | np.concatenate([[False], letter[:-1]])], [32]]).astype(np.uint64)
    # n-grams may span blanks: they then hold a word's end and the next word's start
    with np.errstate(over="ignore"):
        one = c * np.uint64(0x9E3779B97F4A7C15)
        two = one[:-1] * np.uint64(31) + c[1:]
        three = two[:-1] * np.uint64(0x9DDFEA08EB382D69) + c[2:]
        return (mix(np.concatenate([one, two, three])) % np.uint64(DIM)).astype(np.int64)


def tf_idf(at: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct coordinates and unit-length (1 + log tf) x idf values."""
    n = np.bincount(at, minlength=DIM)
    at = np.flatnonzero(n)
    x = (1.0 + np.log(n[at])) * idf[at]
    return at, x / (np.sqrt((x * x).sum()) or 1.0)


def document_frequencies(texts: DataFrame) -> tuple[np.ndarray, int]:
    """Over all rows of ``texts`` (text): in how many each coordinate occurs, and the number of rows."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        df, n = np.zeros(DIM, dtype=np.int64), 0
        for b in batches:
            for t in b["text"]:
                seen = np.zeros(DIM, dtype=bool)
                seen[grams(t)] = True
                df += seen
                n += 1
        at = np.flatnonzero(df)
        yield pd.DataFrame({"at": np.append(at, -1), "n": np.append(df[at], n)})

    parts = texts.mapInPandas(count, "at int, n long").groupBy("at").agg(F.sum("n").alias("n")).toPandas()
    df = np.zeros(DIM)
    rows = parts[parts["at"] < 0]["n"].sum()
    parts = parts[parts["at"] >= 0]
    df[parts["at"].to_numpy()] = parts["n"].to_numpy()
    return df, int(rows)


@dataclass
class LanguageModel:
    languages: list[str]
    idf: np.ndarray       # float32, DIM
    weights: np.ndarray   # float32, DIM x languages
    temperature: float = 1.0

    def logits(self, text: str) -> np.ndarray | None:
        """Uncalibrated logits, or None for a text without letters."""
        at = grams(text)
        if not len(at) or not self.languages:
            return None
        at, x = tf_idf(at, self.idf)
        return x @ self.weights[at]

    def predict_column(self, text: Column) -> Column:
        """struct(lang, score) of a text column."""
        model = self

        @F.pandas_udf("lang string, score double")
        def predict(texts: pd.Series) -> pd.DataFrame:
            langs, scores = [], np.zeros(len(texts))
            for i, t in enumerate(texts):
                s = model.logits(t)
                if s is None:
                    langs.append(UNKNOWN)
                    continue
                p = ftrl.probabilities(s / model.temperature) if len(s) > 1 else np.ones(1)
                langs.append(model.languages[int(p.argmax())])
                scores[i] = p.max()
            return pd.DataFrame({"lang": langs, "score": scores})

        return predict(F.coalesce(text.cast("string"), F.lit("")))


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        fit_rows: int = FIT_ROWS, epochs: int = 3) -> LanguageModel:
    """A model of the languages of ``docs`` (rows without text or language are not used)."""
    rows = docs.where(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull()).select(
        F.xxhash64(id_col, text_col).alias("rank"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    most = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(MAX_LANGUAGES)
    counts = {r["lang"]: r["n"] for r in most.collect()}
    languages = sorted(counts)
    if not languages:
        return LanguageModel([], np.zeros(DIM, np.float32), np.zeros((DIM, 0), np.float32))
    df, n = document_frequencies(rows.select("text"))
    idf = (np.log((1.0 + n) / (1.0 + df)) + 1.0).astype(np.float32)
    code = F.array_position(F.array(*[F.lit(x) for x in languages]), F.col("lang")) - 1
    sample = rows.where(F.col("lang").isin(*languages)).select("rank", "text", "lang", code.cast("int").alias("y"))
    if n > fit_rows:
        # each language is drawn from by itself: in proportion, but of a rare one all that a quarter of an even share holds
        least = fit_rows / (4 * len(languages))
        rate = {lang: min(1.0, max(m / n * fit_rows, least) / m) for lang, m in counts.items()}
        drawn = F.create_map(*[F.lit(x) for lang, r in rate.items() for x in (lang, int(r * (1 << 30)))])
        sample = sample.where(F.pmod("rank", F.lit(1 << 30)) < F.element_at(drawn, F.col("lang")))
    sample = sample.drop("lang")
    kept_back = F.pmod(F.xxhash64("rank"), F.lit(11)) == 3  # for the temperature

    def features(text: str):
        at = grams(text)
        return tf_idf(at, idf) if len(at) else (at, np.empty(0))

    w = ftrl.train(sample.where(~kept_back), features, DIM, min(n, fit_rows), classes=len(languages), epochs=epochs,
                   alpha=0.5, l1=0.002, l2=0.001)
    model = LanguageModel(languages, idf, w.astype(np.float32))
    return LanguageModel(languages, idf, model.weights, _temperature(model, sample.where(kept_back)))


def _temperature(model: LanguageModel, rows: DataFrame) -> float:
    """The temperature with the least log loss over ``rows`` (each row adds its loss at every temperature tried)."""
    grid = np.geomspace(0.02, 5.0, 60)
    # where every row is told right, the loss alone would ask for certainty: one more row per language, told wrong
    k = len(model.languages)
    wrong = k / (rows.count() + k)

    def losses(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(len(grid))
        for b in batches:
            for t, y in zip(b["text"], b["y"]):
                if (s := model.logits(t)) is not None and len(s) > 1:
                    logp = np.log(np.maximum(ftrl.probabilities(s[None, :] / grid[:, None]), 1e-300))
                    total -= (1 - wrong) * logp[:, y] + wrong * (logp.sum(axis=1) - logp[:, y]) / (len(s) - 1)
        yield pd.DataFrame({"k": np.arange(len(grid)), "loss": total})

    got = rows.select("text", "y").mapInPandas(losses, "k int, loss double").groupBy("k").agg(
        F.sum("loss").alias("loss")).collect()
    total = np.zeros(len(grid))
    for r in got:
        total[r["k"]] = r["loss"]
    return float(grid[int(total.argmin())]) if total.any() else 1.0


def identify(docs: DataFrame, model: LanguageModel, text_col: str = "text", lang_out: str = "lang_pred",
             score_out: str = "score") -> DataFrame:
    """``docs`` with the predicted language and its calibrated probability."""
    no_clash(docs, lang_out, score_out)
    (p,) = fresh(docs, "prediction_")
    got = docs.withColumn(p, model.predict_column(F.col(text_col)))
    return got.withColumns({lang_out: F.col(p)["lang"], score_out: F.col(p)["score"]}).drop(p)

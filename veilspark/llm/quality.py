"""Quality classifier: logistic regression on hashed word n-grams, trained by FTRL.

Tokens are lower-cased words and runs of other signs. A token equal to the one before
it is read as one shared "repeat" token, so that stuttering text looks alike whatever
it repeats. Unigrams and bigrams are hashed to a fixed number of coordinates, valued
log(1 + count), scaled to unit length; a document's score is one sparse dot product.

Defined cases: a null or empty text scores the model's bias alone. With no labelled
rows of either class every weight is 0 and every score 0.5. Label rows that disagree
on an id, or are null, are not learned from. Ids may be of any type. Other columns pass through;
one named like the output raises an error.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import ftrl
from .common import no_clash
from .words import Tokens, distinct

BITS = 18
DIM = (1 << BITS) + 1  # and the bias
#: labelled rows the classifier is fitted on, at most (about; all, if there are fewer)
FIT_ROWS = 16_000
KEEP_SCORE = 0.7

_REPEAT = np.uint64(0x9E3779B97F4A7C15)


def features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct coordinates (0 is the bias) and values of a whole text."""
    h = Tokens(text).hashes()
    if len(h) > 1:
        h[1:] = np.where(h[1:] == h[:-1], _REPEAT, h[1:])
    with np.errstate(over="ignore"):
        pairs = (h[:-1] * np.uint64(0x9DDFEA08EB382D69) + h[1:]) * np.uint64(0xC4CEB9FE1A85EC53)
    at, n = distinct(np.concatenate([h >> np.uint64(64 - BITS), pairs >> np.uint64(64 - BITS)]).astype(np.int32))
    x = np.log1p(n)
    x /= np.sqrt(x @ x) or 1.0
    return np.concatenate([[0], at + 1]), np.concatenate([[1.0], x])


@dataclass
class QualityModel:
    weights: np.ndarray  # float32, DIM

    def score_column(self, text: Column) -> Column:
        """Score in 0..1 of a text column."""
        weights = self.weights

        @F.pandas_udf("double")
        def score(texts: pd.Series) -> pd.Series:
            out = np.empty(len(texts))
            for i, t in enumerate(texts):
                at, x = features(t)
                out[i] = float(x @ weights[at])
            return pd.Series(1.0 / (1.0 + np.exp(-np.clip(out, -35, 35))))

        return score(F.coalesce(text.cast("string"), F.lit("")))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label: str = "quality",
        fit_rows: int = FIT_ROWS, epochs: int = 6) -> QualityModel:
    """A model from about ``fit_rows`` of the labelled documents at most."""
    sample, n = ftrl.labelled_sample(docs, labels, label, id_col, text_col, fit_rows)
    w = ftrl.train(sample, features, DIM, n, epochs=epochs, alpha=3.0, l1=0.2, l2=0.001)
    return QualityModel(w[:, 0].astype(np.float32))


def score(docs: DataFrame, model: QualityModel, text_col: str = "text", out: str = "score") -> DataFrame:
    no_clash(docs, out)
    return docs.withColumn(out, model.score_column(F.col(text_col)))


def keep_good(docs: DataFrame, model: QualityModel, text_col: str = "text",
              threshold: float = KEEP_SCORE) -> DataFrame:
    """The documents that the classifier accepts, with their own columns."""
    return docs.where(model.score_column(F.col(text_col)) >= F.lit(threshold))

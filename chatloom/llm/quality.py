"""Quality scores from a regularised quadratic discriminant over document statistics."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatloom.llm.words import utf8
from chatloom.plans.staging import stage

#: Names of the statistics, in the order of the feature vector.
FEATURES = (
    "log_bytes",
    "log_words",
    "word_length",
    "upper_share",
    "digit_share",
    "symbol_share",
    "bar_share",
    "shout_share",
    "stop_share",
    "bracket_share",
    "high_share",
    "line_share",
    "byte_entropy",
    "long_word_share",
    "distinct_words",
    "top_word_share",
    "repeated_lines",
)

_EPS = 1e-4
_CHUNK = 1 << 20


def _marks(chars: str) -> np.ndarray:
    mask = np.zeros(256)
    mask[list(chars.encode())] = 1
    return mask


_UPPER = _marks("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_LOWER = _marks("abcdefghijklmnopqrstuvwxyz")
_DIGIT = _marks("0123456789")
_SYMBOL = _marks("#$%&*@^~<>=+_\\/`")
_BAR = _marks("|")
_SHOUT = _marks("!?")
_STOP = _marks(".,;:")
_BRACKET = _marks("()[]{}\"'")
_HIGH = np.where(np.arange(256) >= 128, 1.0, 0.0)


def statistics(text: str | None) -> np.ndarray:
    """The transformed statistics of one whole text; null counts as empty.

    Shares enter as logarithms, so that a Gaussian fits them; an empty text has all
    shares at their floor.
    """
    data = utf8(text)
    n = len(data)
    counts = np.zeros(256)
    for at in range(0, n, _CHUNK):
        counts += np.bincount(np.frombuffer(data[at : at + _CHUNK], np.uint8), minlength=256)
    words = data.split()
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    kinds: dict[bytes, int] = {}
    for word in words:
        kinds[word] = kinds.get(word, 0) + 1
    lines = [line for line in data.split(b"\n") if line.strip()]
    size, n_words, n_lines = max(n, 1), max(len(words), 1), max(len(lines), 1)
    letters = max(counts @ (_UPPER + _LOWER), 1)
    share = counts[counts > 0] / size
    log_share = lambda x: np.log(_EPS + x)
    return np.array(
        [
            np.log1p(n),
            np.log1p(len(words)),
            lengths.sum() / n_words,
            log_share(counts @ _UPPER / letters),
            log_share(counts @ _DIGIT / size),
            log_share(counts @ _SYMBOL / size),
            log_share(counts @ _BAR / size),
            log_share(counts @ _SHOUT / size),
            log_share(counts @ _STOP / size),
            log_share(counts @ _BRACKET / size),
            log_share(counts @ _HIGH / size),
            log_share(counts[10] / size),
            -(share * np.log2(share)).sum(),
            log_share((lengths > 20).sum() / n_words),
            np.log(max(len(kinds), 1) / n_words),
            np.log(max(kinds.values(), default=1) / n_words),
            log_share(1 - len(set(lines)) / n_lines),
        ]
    )


def features(docs: DataFrame, *, text_col: str = "text", carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``carry`` and the column ``x`` (array of double): the statistics of each row."""

    @F.pandas_udf("array<double>")
    def measure(texts: pd.Series) -> pd.Series:
        return pd.Series([statistics(t) for t in texts], dtype=object)

    return docs.select(*carry, measure(F.col(text_col)).alias("x"))


@dataclass(frozen=True)
class Discriminant:
    """Two Gaussians over standardised statistics: means, inverted Cholesky factors, constants.

    Without rows of both classes there are no Gaussians, and every score is ``base``.
    """

    base: float
    centre: np.ndarray | None = None
    scale: np.ndarray | None = None
    means: tuple[np.ndarray, ...] = ()
    whiten: tuple[np.ndarray, ...] = ()
    constants: tuple[float, ...] = ()

    def scores(self, x: np.ndarray) -> np.ndarray:
        if not self.means:
            return np.full(len(x), self.base)
        z = np.clip((x - self.centre) / self.scale, -20, 20)
        logs = []
        for mean, inverse, constant in zip(self.means, self.whiten, self.constants, strict=True):
            d = (z - mean) @ inverse.T
            logs.append(constant - 0.5 * (d * d).sum(axis=1))
        return 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -500, 500)))


def _moments(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Per class of one partition: the sums of (1, x) times (1, x), as long rows."""
    width = len(FEATURES) + 1
    sums = {0: np.zeros((width, width)), 1: np.zeros((width, width))}
    for batch in batches:
        for label in (0, 1):
            rows = batch.loc[batch["label"] == label, "x"]
            if len(rows):
                one = np.hstack([np.ones((len(rows), 1)), np.vstack(rows.to_numpy())])
                sums[label] += one.T @ one
    for label, total in sums.items():
        if total[0, 0]:
            yield pd.DataFrame({"label": label, "cell": np.arange(width * width), "value": total.ravel()})


def fit(labelled: DataFrame, *, shrinkage: float = 0.05) -> Discriminant:
    """Fit to rows of ``x`` and ``label`` (0 or 1; other labels are ignored).

    Only sums of products leave the executors: a few hundred numbers per class,
    whatever the number of rows. Each class covariance is drawn towards a multiple of
    the identity, by ``shrinkage`` or, with few rows, by more.
    """
    rows = (
        labelled.where(F.col("label").isin(0, 1))
        .select(F.col("label").cast("int").alias("label"), "x")
        .mapInPandas(_moments, "label int, cell int, value double")
        .groupBy("label", "cell")
        .agg(F.sum("value").alias("value"))
        .collect()
    )
    width = len(FEATURES) + 1
    sums = {0: np.zeros(width * width), 1: np.zeros(width * width)}
    for row in rows:
        sums[row["label"]][row["cell"]] = row["value"]
    cross = {label: total.reshape(width, width) for label, total in sums.items()}
    n = {label: total[0, 0] for label, total in cross.items()}
    if not n[0] or not n[1]:
        return Discriminant(base=1.0 if not n[0] else 1 / (n[0] + 2))
    both = cross[0] + cross[1]
    centre = both[0, 1:] / both[0, 0]
    variance = np.diag(both)[1:] / both[0, 0] - centre**2
    scale = np.sqrt(np.maximum(variance, 1e-6))
    means, whiten, constants = [], [], []
    for label in (0, 1):
        mean = cross[label][0, 1:] / n[label]
        cov = (cross[label][1:, 1:] / n[label] - np.outer(mean, mean)) / np.outer(scale, scale)
        p = len(FEATURES)
        part = max(shrinkage, p / (p + n[label]))
        cov = (1 - part) * cov + part * max(np.trace(cov) / p, 0.05) * np.eye(p)
        factor = np.linalg.cholesky((cov + cov.T) / 2 + 1e-6 * np.eye(p))
        means.append((mean - centre) / scale)
        whiten.append(np.linalg.inv(factor))
        constants.append(float(np.log(n[label] / both[0, 0]) - np.log(np.diag(factor)).sum()))
    return Discriminant(n[1] / both[0, 0], centre, scale, tuple(means), tuple(whiten), tuple(constants))


def held_out(doc_id: Column) -> Column:
    """True where no label may be learnt from the row; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def score(measured: DataFrame, model: Discriminant) -> DataFrame:
    """``measured`` with ``x`` replaced by ``score``, the chance of label 1."""

    @F.pandas_udf("double")
    def rate(x: pd.Series) -> pd.Series:
        return pd.Series(model.scores(np.vstack(x.to_numpy())) if len(x) else np.zeros(0))

    return measured.withColumn("score", rate("x")).drop("x")


def quality_scores(
    docs: DataFrame,
    labels: DataFrame,
    *,
    threshold: float = 0.7,
    shrinkage: float = 0.05,
) -> DataFrame:
    """Score every row of ``docs`` (doc_id, text) by labels (doc_id, quality).

    Returns doc_id, held_out, score, predicted. Null and empty texts are scored like any
    other; every row, repeated ones too, gets its score. Labels that are null or other
    than 0 and 1, and rows with a null id, are not learnt from. Without rows of both
    classes nothing speaks against a document unless all labels are 0. Other columns of
    either table are not looked at.
    """
    measured = stage(features(docs.select("doc_id", "text")), "statistics")
    known = labels.select("doc_id", F.col("quality").alias("label")).where(~held_out(F.col("doc_id")))
    model = fit(measured.join(known, "doc_id"), shrinkage=shrinkage)
    scored = score(measured, model)
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"),
    )


def keep_good(
    docs: DataFrame, labels: DataFrame, *, threshold: float = 0.7, shrinkage: float = 0.05
) -> DataFrame:
    """The rows of ``docs``, all their columns, that score at least ``threshold``."""
    measured = stage(features(docs.select("doc_id", "text")), "statistics")
    known = labels.select("doc_id", F.col("quality").alias("label")).where(~held_out(F.col("doc_id")))
    model = fit(measured.join(known, "doc_id"), shrinkage=shrinkage)

    @F.pandas_udf("double")
    def rate(texts: pd.Series) -> pd.Series:
        return pd.Series(model.scores(np.vstack([statistics(t) for t in texts])) if len(texts) else np.zeros(0))

    return docs.where(rate(F.col("text")) >= threshold)

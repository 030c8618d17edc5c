"""How far the origin of a work gives its class away: a classifier that sees source, period and length only.

Works with equal features are one row with a weight, so that a fold is a table of
(features, class, count) whatever the number of works: sources times periods times
deciles times classes.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .sampling import folds

FEATURES = ("journal_id", "period", "decile")
STEPS = 300
#: The inverse strength of the penalty, as usual for this model.
C = 1.0


def fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray, n_classes: int) -> np.ndarray:
    """Weights (features + 1, classes) of a multinomial logistic regression; rows count by `weight`, the intercept isn't penalised."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros((x.shape[1], n_classes))
    hot = np.eye(n_classes)[y]
    bound = 0.25 * np.linalg.norm(x * np.sqrt(weight)[:, None], 2) ** 2 + 1 / C
    ahead, t = w.copy(), 1.0
    for _ in range(STEPS):  # accelerated gradient steps
        z = x @ ahead
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        grad = x.T @ ((p - hot) * weight[:, None])
        grad[:-1] += ahead[:-1] / C
        new = ahead - grad / bound
        s = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead, w, t = new + (t - 1) / s * (new - w), new, s
    return w


def _score(key, table):
    """Confusion counts of one repeat: every fold predicted from the others."""
    classes = sorted(table["h2_class_id"].unique())
    x = np.hstack([(table[[f]].to_numpy() == np.unique(table[f].to_numpy())[None, :]).astype(float) for f in FEATURES])
    y = table["h2_class_id"].map({c: k for k, c in enumerate(classes)}).to_numpy()
    n, fold = table["n"].to_numpy(float), table["fold"].to_numpy()
    out = []
    for f in np.unique(fold):
        train, test = fold != f, fold == f
        size = np.bincount(y[train], n[train], len(classes))
        weight = n[train] * (n[train].sum() / (np.maximum(size, 1) * max(1, (size > 0).sum())))[y[train]]
        w = fit(x[train], y[train], weight, len(classes))
        guess = (np.hstack([x[test], np.ones((test.sum(), 1))]) @ w).argmax(axis=1)
        out += [(key[0], classes[a], classes[b], int(c)) for a, b, c in zip(y[test], guess, n[test], strict=True)]
    return pd.DataFrame(out, columns=["rep", "truth", "guess", "n"])


def scores(works: DataFrame, seed: int, repeats: int = 10, n_folds: int = 5) -> DataFrame:
    """(rep, macro_f1) of cross-validation; works: work_id, h2_class_id and FEATURES."""
    dealt = folds(works.select("work_id", "h2_class_id").distinct(), "work_id", "h2_class_id", seed, n_folds, repeats)
    counts = works.select("work_id", *FEATURES).join(dealt, "work_id").groupBy("rep", "fold", "h2_class_id", *FEATURES).agg(F.count(F.lit(1)).alias("n"))
    guessed = counts.groupBy("rep").applyInPandas(_score, "rep long, truth string, guess string, n long")
    cells = guessed.groupBy("rep", "truth", "guess").agg(F.sum("n").alias("n"))
    sides = F.array(F.struct(F.col("truth").alias("c"), F.col("n").alias("support"), F.lit(0).cast("long").alias("guessed"), F.when(F.col("truth") == F.col("guess"), F.col("n")).otherwise(0).alias("hit")), F.struct(F.col("guess").alias("c"), F.lit(0).cast("long").alias("support"), F.col("n").alias("guessed"), F.lit(0).cast("long").alias("hit")))
    per = cells.select("rep", F.explode(sides).alias("x")).select("rep", "x.*").groupBy("rep", "c").agg(F.sum("support").alias("support"), F.sum("guessed").alias("guessed"), F.sum("hit").alias("hit")).where("support > 0")
    f1 = F.coalesce(F.try_divide(2 * F.col("hit").cast("double"), F.col("support") + F.col("guessed")), F.lit(0.0))
    return per.groupBy("rep").agg(F.round(F.avg(f1), 6).alias("macro_f1"))

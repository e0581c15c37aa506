"""Labelled rows for training: bounded, drawn by a hash, never the held-out third."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, label: str, most: int) -> DataFrame:
    """(doc_id, text, label) of at most ``most`` labelled rows a class, the first by a hash of the id.

    Rows whose crc32 of the id is 1 modulo 3 are held out; null ids and labels don't take part.
    ``docs`` has doc_id and text. The drawn labels are at most 2 * ``most`` rows, so they are
    broadcast to the scan of the texts.
    """
    known = labels.select("doc_id", F.col(label).cast("int").alias("label")).where("doc_id is not null and label in (0, 1)")
    known = known.where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("label").alias("label"))
    draw = [known.where(F.col("label") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most) for c in (0, 1)]
    return docs.join(F.broadcast(draw[0].unionByName(draw[1])), "doc_id").select("doc_id", "text", "label")


def platt(margins, labels, rounds: int = 100) -> tuple[float, float]:
    """(slope, offset) of the logistic curve that best maps margins to labels, by Newton's method."""
    import numpy as np

    n1, n0 = max(1, int((labels == 1).sum())), max(1, int((labels == 0).sum()))
    target = np.where(labels == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    weight = np.where(labels == 1, 0.5 / n1, 0.5 / n0)  # classes count alike
    x = np.column_stack([margins, np.ones(len(margins))])
    at = np.array([1.0, 0.0])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ at, -30, 30)))
        grad = x.T @ (weight * (p - target)) + 1e-4 * at * [1, 0]
        hess = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-4 * np.eye(2)
        step = np.linalg.solve(hess, grad)
        at = at - step
        if abs(step).max() < 1e-8:
            break
    return float(at[0]), float(at[1])


def dual_coordinate_descent(starts, columns, values, labels, dims: int, cost, rounds: int = 20, seed: int = 5):
    """Weights of a linear hinge-loss model by dual coordinate descent over sparse rows.

    Row i has ``columns[starts[i]:starts[i + 1]]`` and the ``values`` of the same slice; labels
    are -1 or 1; ``cost`` bounds each row's dual variable. A last dimension holds the bias.
    """
    import numpy as np

    n, rng = len(starts) - 1, np.random.default_rng(seed)
    w, alpha = np.zeros(dims + 1), np.zeros(n)
    square = np.array([values[a:b] @ values[a:b] for a, b in zip(starts[:-1], starts[1:], strict=True)]) + 1.0
    for _ in range(rounds):
        most = 0.0
        for i in rng.permutation(n):
            a, b = starts[i], starts[i + 1]
            c, v, y = columns[a:b], values[a:b], labels[i]
            gradient = y * (w[c] @ v + w[dims]) - 1
            new = min(max(alpha[i] - gradient / square[i], 0.0), cost[i])
            if new != alpha[i]:
                step = (new - alpha[i]) * y
                most = max(most, abs(step))
                w[c] += step * v  # a row's columns are distinct
                w[dims] += step
                alpha[i] = new
        if most < 1e-4:
            break
    return w

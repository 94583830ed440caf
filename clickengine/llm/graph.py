"""Connected components of a graph that lives in tables."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickengine.llm.common import materialize


def components(links: DataFrame) -> DataFrame:
    """(u, c): the smallest number reachable from every number that has a link.

    ``links``: (u, v) rows, either way round, u <> v.  Each round takes the smallest
    label among the neighbours and then the label of that label, so the rounds grow with
    the logarithm of the longest path.  A number with any share of the links is no
    trouble: minima are taken before the shuffle, and joins can split its rows.
    """
    once = links.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()
    both = materialize(once.unionByName(once.select(F.col("v").alias("u"), F.col("u").alias("v"))))
    labels = materialize(both.groupBy("u").agg(F.min("v").alias("n")).select("u", F.least("u", "n").alias("c")))
    while True:
        of = labels.select(F.col("u").alias("v"), F.col("c").alias("cv"))
        near = both.join(of, "v").groupBy("u").agg(F.min("cv").alias("n"))
        low = labels.join(near, "u").select("u", F.col("c").alias("old"), F.least("c", "n").alias("c"))
        jump = labels.select(F.col("u").alias("c"), F.col("c").alias("cc"))
        step = materialize(low.join(jump, "c").select("u", "old", F.least("c", "cc").alias("c")))
        labels = step.select("u", "c")
        if step.where("c <> old").isEmpty():
            return labels


def local_components(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest index reachable from each of n indices by the links i - j."""
    label = np.arange(n)
    while len(i):
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        np.minimum.at(new, label[i], low)
        np.minimum.at(new, label[j], low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    return label

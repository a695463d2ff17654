"""Greedy chains over sorted values: the first, then each that lies beyond a span after the one taken last."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def taken(rows: DataFrame, keys: list[str], value: str, span: str, tie: list[str] = (), at_least: bool = False) -> DataFrame:
    """The rows that the chain of each group (keys) takes; beyond is at least ``span`` after, or more than that.

    The groups are sorted runs of a partition and go by one after another, so a group of any size
    needs no memory: what is kept is one value.  value, span and all columns that matter to the caller must not be null.
    """
    grouped = rows.withColumns({"_g": F.xxhash64(*keys), "_h": F.hash(*keys)})
    runs = grouped.repartition("_g", "_h").sortWithinPartitions("_g", "_h", value, *tie)

    def run(frames):
        now, last = None, 0
        for f in frames:
            keep = np.zeros(len(f), dtype=bool)
            for i, (g, h, v, s) in enumerate(zip(f["_g"].tolist(), f["_h"].tolist(), f[value].tolist(), f[span].tolist(), strict=True)):
                if (g, h) != now or v > last + s or (at_least and v == last + s):
                    keep[i] = True
                    now, last = (g, h), v
            yield f[keep]

    return runs.mapInPandas(run, runs.schema).drop("_g", "_h")

"""Hook for a user's own model."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .joins import lookup, spread_key


def batch_infer(df: DataFrame, text: str, predict: Callable[[list[str]], list[tuple[str, float]]],
                row_id: str, batch: int = 64, hot_share: float | None = 0.01) -> DataFrame:
    """Label each distinct text once and join the answers back.

    ``predict`` takes a list of texts and returns ``(label, score)`` pairs; it
    is shipped to the executors and called with at most ``batch`` texts.  Rows
    without text are not sent to the model.  The texts are read more than once:
    write them to a table first when they are costly to compute.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            texts = frame["_text"].tolist()
            for i in range(0, len(texts), batch):
                part = texts[i:i + batch]
                answers = predict(part)
                yield pd.DataFrame({"_text": part, "label": [a[0] for a in answers],
                                    "score": [float(a[1]) for a in answers]})

    distinct = df.where(F.col(text).isNotNull() & (F.col(text) != "")) \
        .select(F.col(text).alias("_text")).distinct()
    answers = distinct.mapInPandas(run, "_text string, label string, score double")
    has_text = F.col(text).isNotNull() & (F.col(text) != "")
    return lookup(df, answers, spread_key(has_text, F.col(text), F.col(row_id)), "_text",
                  ["label", "score"], row_id, hot_share)

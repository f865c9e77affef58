"""Bounded samples of labelled documents, and fitting on them inside a task."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from tallyhouse.llm.common import held_out, typed
from tallyhouse.llm.packing import lean


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int) -> DataFrame:
    """``text, label`` of at most ``per_class`` documents of each label, none of them held out.

    The sample is the ids with the smallest hashes, so it is the same on every run. NULL ids, texts
    and labels are left out; of several labels of an id the largest counts.
    """
    known = typed(labels, doc_id="long", **{label: "int"}).where(F.col("doc_id").isNotNull() & ~held_out())
    known = known.groupBy("doc_id").agg(F.max(label).alias("label")).where("label is not null")
    picked = None
    for value in (0, 1):
        part = known.where(F.col("label") == value).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
        picked = part if picked is None else picked.unionByName(part)
    texts = typed(docs, doc_id="long", text="string").where("text is not null")
    # The sample is at most 2 * per_class pairs of numbers, whatever the size of the labels.
    return texts.join(F.broadcast(picked), "doc_id").select("text", "label")


def fitted_in_task(sample: DataFrame, fit: Callable[[list[bytes], np.ndarray], Any]) -> Any:
    """``fit(texts, labels)`` of a ``labelled_sample``, run by one task: the texts never reach the driver, only the model does.

    Rows are sorted before, so the model does not depend on how they were dealt."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = sorted((t.encode(), int(v)) for frame in frames for t, v in zip(frame["text"], frame["label"]))
        model = fit([t for t, _ in rows], np.array([v for _, v in rows], dtype=np.int64))
        yield pd.DataFrame({"model": [pickle.dumps(model)]})

    found = sample.repartition(1).mapInPandas(lean(run), "model binary").collect()  # one row
    return pickle.loads(found[0]["model"]) if found else fit([], np.zeros(0, dtype=np.int64))

"""Sequential folds over the rows of a document."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows that a task gives back at once.
ROWS = 10_000


def fold_documents(df: DataFrame, key: str, order: str, columns: list[str], fold: Callable, schema: str) -> DataFrame:
    """The rows of fold(key, lists of the order and of the columns, sorted by the order) for each document.

    A document is one row of arrays, and documents come in Arrow batches: a group of its own for each costs more than
    most folds."""
    names, out_names = (key, order, *columns), [x.split()[0] for x in schema.split(", ")]
    rows = F.sort_array(F.collect_list(F.struct(order, *columns))).alias("_rows")
    documents = df.groupBy(key).agg(rows).select(key, *(F.col("_rows")[c].alias(c) for c in names[1:]))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out: list[tuple] = []
            for k, *arrays in zip(*(b[c] for c in names)):
                out.extend(fold(k, *(a.tolist() for a in arrays)))
                if len(out) >= ROWS:
                    yield pd.DataFrame(out, columns=out_names)
                    out = []
            if out:
                yield pd.DataFrame(out, columns=out_names)

    return documents.mapInPandas(run, schema)


cloudpickle.register_pickle_by_value(sys.modules[__name__])

"""Ordered folds of user functions, where the order matters and no column expression says what is meant."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator, Sequence
from typing import Any

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_type

# Executors may not have the package installed, so its functions travel with the plan.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def fold(df: DataFrame, keys: Sequence[str], order: Sequence[str], columns: Sequence[str], step: Callable[[Any, dict], tuple[Any, Any]],
         result: T.DataType | str, name: str = "value") -> DataFrame:
    """Every row of ``df`` with what ``step(memory, row) -> (memory, value)`` makes of it, in the order of its key.

    ``memory`` is None for the first row of a key; ``row`` has the given ``columns``, null as None. Rows run through in sorted Arrow batches and
    the memory of one key is all that is held, so a key may be of any length; as each step depends on the one before, a key is one
    task's work. What can be said by ``ordered.scan`` is divided there and should be. Null keys are a key; null order values come first.
    """
    result = T._parse_datatype_string(result) if isinstance(result, str) else result
    source = df.select(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)], F.struct(*columns).alias("row"), F.struct(*df.columns).alias("whole"),
                       *[F.col(o).alias(f"o{i}") for i, o in enumerate(order)])
    names = [f"k{i}" for i in range(len(keys))]
    by = [*names, *[f"o{i}" for i in range(len(order))]]
    dealt = (source.repartition(*names) if keys else source.coalesce(1)).sortWithinPartitions(*by)
    schema = T.StructType([T.StructField("whole", T.StructType(df.schema.fields)), T.StructField("value", result)])
    kind = to_arrow_type(result)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, memory = None, None
        for batch in batches:
            found = []
            plain = [batch.column(i).to_pylist() for i in range(len(names) + 1)]
            for *key, row in zip(*plain):
                if key != last:
                    last, memory = key, None
                memory, value = step(memory, row)
                found.append(value)
            yield pa.RecordBatch.from_arrays([batch.column(len(names) + 1), pa.array(found, kind)], ["whole", "value"])

    made = dealt.drop(*by[len(names):]).mapInArrow(run, schema)
    return made.select("whole.*", F.col("value").alias(name))

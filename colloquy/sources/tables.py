"""Table functions: several rows for each input row, in Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame
from pyspark.sql import types as T


def exploded(df: DataFrame, keep: list[str], needs: list[str], fn: Callable[..., list[tuple]], fields: str) -> DataFrame:
    """keep columns, untouched, and the fields of every tuple that fn makes of the values of `needs`."""
    made = T.StructType.fromDDL(fields)
    schema = T.StructType([*[df.schema[k] for k in keep], *made.fields])

    def run(batches: Iterator):
        import pyarrow as pa

        kinds = {"string": pa.string(), "bigint": pa.int64(), "int": pa.int32(), "double": pa.float64(), "boolean": pa.bool_()}
        types = [kinds[f.dataType.simpleString()] for f in made.fields]
        for batch in batches:
            at, rows = [], []
            for n, values in enumerate(zip(*[batch.column(c).to_pylist() for c in needs])):
                found = fn(*values)
                at += [n] * len(found)
                rows += found
            columns = list(zip(*rows)) or [()] * len(types)
            place = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays([*[batch.column(k).take(place) for k in keep], *[pa.array(c, t) for c, t in zip(columns, types)]], schema.names)

    return df.select(*dict.fromkeys([*keep, *needs])).mapInArrow(run, schema)

"""Row-wise operators over whole texts: each row comes back with a struct of what was found in its text."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from eventloom.llm.words import SLICE_BYTES, release, slices

#: Gets the texts of some rows, gives an array per field.
Finder = Callable[[pa.Array], list[pa.Array]]


def free_name(columns: list[str], name: str) -> str:
    """name, or with underscores added until no column has it in any case."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def with_found(df: DataFrame, text: str, name: str, fields: T.StructType, finder: Callable[[], Finder], keep: list[str] | None = None, size: int = SLICE_BYTES, key: str | None = None) -> DataFrame:
    """df's columns of `keep` (all by default) and a struct column `name`. finder() is called once per task; what it
    returns sees about `size` bytes of text at a time and must treat a null text as empty;
    with a `key` column it sees structs of key and text."""
    keep = df.columns if keep is None else keep
    if name in keep:
        raise ValueError(f"column {name} exists; pick a free name")
    carried = [c for c in df.columns if c in keep]
    inner = free_name(carried, "_text")
    inner_key = [df[f"`{key}`"].alias(free_name([*carried, inner], "_key"))] if key else []
    source = df.select(*[df[f"`{c}`"] for c in carried], df[f"`{text}`"].cast("string").alias(inner), *inner_key)
    schema = T.StructType([*[df.schema[c] for c in carried], T.StructField(name, fields, False)])
    kinds = [to_arrow_type(f.dataType) for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = finder()
        for batch in batches:
            for part in slices(batch, inner, size):
                column = part.column(len(carried))
                if key:
                    column = pa.StructArray.from_arrays([part.column(len(carried) + 1), column], names=["key", "text"])
                found = [a if a.type == k else a.cast(k) for a, k in zip(find(column), kinds, strict=True)]
                struct = pa.StructArray.from_arrays(found, names=fields.names)
                yield pa.RecordBatch.from_arrays([*part.columns[: len(carried)], struct], names=[*carried, name])
        del find
        release()

    return source.mapInArrow(run, schema)

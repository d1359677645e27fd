"""Row-wise Python over Arrow batches: extra columns beside the rows they belong to."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema


def annotate(df: DataFrame, keep: list[str] | None, inputs: dict[str, Column], outputs: str, start) -> DataFrame:
    """One row per row of ``df``: a struct ``doc`` with the columns ``keep`` and the columns ``outputs``.

    ``start()`` runs once per task and returns a function from a record batch of ``inputs`` to the lists or arrays
    of ``outputs``, in order.  As the kept columns sit in a struct, their names may clash with the new ones.
    Without ``keep`` the struct ``doc`` that ``df`` has already is passed on.
    """
    doc = F.col("doc") if keep is None else F.struct(*[df[c] for c in keep]).alias("doc")
    frame = df.select(doc, *[c.alias(n) for n, c in inputs.items()])
    fields = T.StructType([frame.schema["doc"], *T._parse_datatype_string(outputs).fields])

    def run(batches):
        work, schema = start(), to_arrow_schema(fields)
        for batch in batches:
            made = work(batch) if batch.num_rows else [[] for _ in schema[1:]]
            arrays = [pa.array(a, type=f.type) for a, f in zip(made, list(schema)[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(schema[0].type), *arrays], schema=schema)

    return frame.mapInArrow(run, fields)


def pick(df: DataFrame, keep: list[str], *columns: str) -> DataFrame:
    """The kept columns out of ``doc``, then the named new ones."""
    return df.select(*[F.col("doc")[c].alias(c) for c in keep], *columns)


def fold(key: Column, parts: int) -> Column:
    """The remainder of CRC-32 of a key's text; a null key falls into no fold (null)."""
    return F.pmod(F.crc32(key.cast("string").cast("binary")), F.lit(parts))

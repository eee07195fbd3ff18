"""Row-local steps over Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, _parse_datatype_string

#: Rows that one call of a row function gets at most; long texts come fewer at a time through SLICE_BYTES.
SLICE_ROWS = 4096
SLICE_BYTES = 2 << 20
#: Bytes of an Arrow batch, unless the session says so itself: texts differ too much for a bound of rows alone.
BATCH_BYTES = 4 << 20
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def bound_batches(spark: SparkSession) -> None:
    """Have the session cut Arrow batches by bytes too; a setting of its own stays."""
    if spark.conf.get(_BATCH, "1") == "1":
        spark.conf.set(_BATCH, str(BATCH_BYTES))


def slices(batch: pa.RecordBatch, column: pa.Array) -> Iterator[pa.RecordBatch]:
    """Parts of a batch that hold at most SLICE_ROWS rows and, but for a longer single value, SLICE_BYTES of ``column``."""
    sizes = pc.binary_length(column).fill_null(0).to_pylist()
    start = held = 0
    for i, n in enumerate(sizes):
        if i > start and (held + n > SLICE_BYTES or i - start >= SLICE_ROWS):
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += n
    if start < batch.num_rows:
        yield batch.slice(start)


def map_rows(df: DataFrame, inputs: dict[str, Column | str], schema: str, make: Callable[[], Callable[[dict], dict]], keep: list[str] | None = None) -> DataFrame:
    """One output row per input row: ``row`` (a struct of the kept columns of ``df``) and the columns of ``schema``.

    ``make`` runs once per task and gives a function from columns (name to Python list) to columns. An input is
    a column, or the name of one; a kept column is read from ``row``, so that it travels once.
    The first input decides how many rows a call gets. Kept columns travel in a struct, so their names
    can't clash with those of ``schema``. No shuffle.
    """
    kept = df.columns if keep is None else keep
    added = _parse_datatype_string(schema)
    fields = [StructField("row", StructType([df.schema[c] for c in kept])), *added.fields] if kept else added.fields
    held = {n: kept.index(c) for n, c in inputs.items() if isinstance(c, str) and c in kept}
    sent = {n: df[f"`{c}`"] if isinstance(c, str) else c for n, c in inputs.items() if n not in held}
    narrow = df.select(*([F.struct(*[df[f"`{c}`"] for c in kept]).alias("row")] if kept else []), *[c.alias(f"in_{n}") for n, c in sent.items()])
    names, whole_row = list(inputs), bool(kept)
    bound_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        target = to_arrow_schema(added)
        work = make()
        column = lambda part, n: part.column("row").field(held[n]) if n in held else part.column(f"in_{n}")
        for whole in batches:
            for part in slices(whole, column(whole, names[0])):
                got = work({n: column(part, n).to_pylist() for n in names})
                out = [pa.array(got[f.name], type=f.type) for f in target]
                yield pa.RecordBatch.from_arrays([*([part.column("row")] if whole_row else []), *out], names=[*(["row"] if whole_row else []), *target.names])

    return narrow.mapInArrow(run, StructType(fields))

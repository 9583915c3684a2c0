"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

SLICE_BYTES = 4 << 20


def text_size(col: str = "text") -> Column:
    """UTF-8 bytes of a text, 0 for null."""
    return F.coalesce(F.octet_length(col), F.lit(0)).cast("long")


def remainder(doc_id: str, modulus: int) -> Column:
    """crc32 of the id written as text, modulo ``modulus`` (null id: as '')."""
    return F.pmod(F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))), F.lit(modulus)).cast("int")


def row_slices(batches: Iterator[pa.RecordBatch], text: str = "text",
               limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches into runs of rows with about ``limit`` bytes of text
    (one row at least), so a task's working memory does not follow the batch."""
    for batch in batches:
        col = batch.column(batch.schema.get_field_index(text))
        sizes = pc.fill_null(pc.binary_length(col), 0).to_pylist()
        start, held = 0, 0
        for i, n in enumerate(sizes):
            if held and held + n > limit:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n + 16
        if start < batch.num_rows:
            yield batch.slice(start)


def map_slices(df: DataFrame, fn: Callable[[pa.RecordBatch], dict | None], schema: str,
               text: str = "text") -> DataFrame:
    """``mapInArrow`` of a function from a slice of rows to a dict of columns;
    ``fn`` may return None when it has nothing to say about the slice."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType
    out = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches):
        for part in row_slices(batches, text):
            got = fn(part)
            if got is not None:
                yield pa.RecordBatch.from_arrays(
                    [x if isinstance(x, pa.Array) else pa.array(x, type=f.type)
                     for x, f in ((got[f.name], f) for f in out)], schema=out)

    return df.mapInArrow(run, schema)


def slots(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def cut(df: DataFrame) -> DataFrame:
    """Write to the shared checkpoint folder and go on from there."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)

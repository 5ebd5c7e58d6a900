"""What the text operators share: reading, word rule, folds, Arrow helpers."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A word is a run of anything but these: space, tab, line feed, vertical tab, form feed, carriage return.
BLANKS = " \t\n\x0b\x0c\r"
BLANK_CLASS = "[\\x20\\x09-\\x0D]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """The words of a text in order; none for a null text."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), f"{BLANK_CLASS}+"), lambda w: w != "")


def numbered(df: DataFrame) -> tuple[DataFrame, dict[str, Column]]:
    """The same rows with columns named c0, c1, ... and, by its own exact name, the column each name stands for.

    Foreign columns may have any name, with dots, blanks or other case; none is looked up this way. Of
    columns that share a name the first counts.
    """
    plain = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    return plain, {c: F.col(f"c{i}") for i, c in reversed(list(enumerate(df.columns)))}


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id's decimal digits modulo `folds`; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def mapped(df: DataFrame, task: Callable[[pa.RecordBatch], Iterator[dict] | dict | None], schema: str) -> DataFrame:
    """Apply `task` to every Arrow batch; it returns columns by name (or None for no rows)."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = task(batch)
            for columns in [made] if isinstance(made, dict) else made or ():
                yield pa.RecordBatch.from_arrays(
                    [pa.array(columns[f.name], type=f.type) for f in arrow], schema=arrow
                )

    return df.mapInArrow(run, schema)


def packed(df: DataFrame, column: str) -> DataFrame:
    """The same rows with a text column compressed (binary, null stays null), to be unpacked after a shuffle."""
    import zlib

    from pyspark.sql.types import BinaryType, StructField, StructType

    names = df.columns
    at = names.index(column)
    schema = StructType([StructField(f.name, BinaryType() if k == at else f.dataType) for k, f in enumerate(df.schema)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(at).to_pylist()
            small = pa.array([None if t is None else zlib.compress(t.encode(), 1) for t in texts], pa.binary())
            columns = [small if k == at else c for k, c in enumerate(batch.columns)]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return df.mapInArrow(run, schema)


def unpacked(data: bytes | None) -> str | None:
    import zlib

    return None if data is None else zlib.decompress(data).decode()


def pieces(batch: pa.RecordBatch, column: str, most: int) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that a string column holds about `most` bytes per piece; one long text is a piece alone."""
    import numpy as np

    lengths = pa.compute.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
    ends, start, total = np.cumsum(lengths), 0, 0
    while start < batch.num_rows:
        stop = max(start + 1, int(np.searchsorted(ends, total + most, "right")))
        yield batch.slice(start, stop - start)
        total, start = int(ends[stop - 1]), stop

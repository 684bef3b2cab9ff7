"""What the operators of this subpackage share: white space, shared storage, Arrow maps."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from helixframe.operators.shared import materialize, shared_dir, write_shared

__all__ = ["arrow_schema", "ascii_lower", "bitmap", "in_bitmap", "map_text_groups", "map_texts", "materialize", "shared_dir", "unused", "word_count", "write_shared"]

#: White space everywhere in this subpackage: the space and the code points 9 to 13.
SPACES = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def unused(df: DataFrame, *names: str) -> list[str]:
    """A column name for each of ``names`` that no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    mark = "__"
    while any((mark + n).lower() in taken for n in names):
        mark += "_"
    return [mark + n for n in names]


def ascii_lower(text: Column) -> Column:
    """``text`` with A-Z lower-cased and every other character as it is."""
    plain = F.length(text) == F.octet_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def word_count(text: Column) -> Column:
    """Number of words, that is of runs without white space; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


#: Bits of a bitmap of hashes; a multiple of what one of Spark's bitmaps holds.
BITMAP_BITS = 1 << 24
SPARK_BITS = 32_768


def bitmap(hashes: DataFrame) -> bytes:
    """BITMAP_BITS bits, those set that a ``hash`` of the table falls on: a filter of fixed size, which may let others through."""
    place = hashes.select(F.pmod("hash", F.lit(BITMAP_BITS)).alias("p"))
    parts = place.groupBy(F.floor(F.col("p") / SPARK_BITS).alias("part")).agg(F.bitmap_construct_agg(F.col("p") % SPARK_BITS).alias("bits"))
    found = bytearray(BITMAP_BITS // 8)
    for r in parts.collect():  # at most BITMAP_BITS / SPARK_BITS rows
        at = r["part"] * (SPARK_BITS // 8)
        found[at : at + SPARK_BITS // 8] = bytes(r["bits"]).ljust(SPARK_BITS // 8, b"\0")
    return bytes(found)


def in_bitmap(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which of the hashes (uint64) the bitmap, as bytes, lets through."""
    at = hashes & np.uint64(BITMAP_BITS - 1)
    return (bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


def map_texts(df: DataFrame, id_col: str, text_col: str, schema: str, make, extra: tuple = ()) -> DataFrame:
    """Map each row by ``make()(id, text, *extra)``, an iterable of output tuples, in Arrow batches.

    ``make`` is called once in each task, so that a model is unpacked once. Null texts come as "".
    Output leaves in batches of bounded size whatever the texts' lengths.
    """
    arrow = arrow_schema(schema)

    def run(batches):
        row = make()
        out, held = [], 0
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1)
            more = [batch.column(2 + i).to_pylist() for i in range(len(extra))]
            for i, key in enumerate(ids):
                text = texts[i].as_py() or ""
                for made in row(key, text, *(x[i] for x in more)):
                    out.append(made)
                held += len(text)
                if len(out) >= 4096 or held >= 1 << 24:
                    yield _batch(out, arrow)
                    out, held = [], 0
        if out:
            yield _batch(out, arrow)

    return df.select(id_col, text_col, *extra).mapInArrow(run, schema)


def map_text_groups(df: DataFrame, id_col: str, text_col: str, schema: str, make, chars: int = 1 << 16) -> DataFrame:
    """As ``map_texts``, but ``make()`` maps a list of (id, text) of about ``chars`` characters at once.

    A longer text is a group of its own, so what a group holds is bounded by the longest text.
    """
    arrow = arrow_schema(schema)

    def run(batches):
        group = make()
        rows, held = [], 0
        for batch in batches:
            texts = batch.column(1)
            for i, key in enumerate(batch.column(0).to_pylist()):
                text = texts[i].as_py() or ""
                if rows and held + len(text) > chars:
                    yield _batch(list(group(rows)), arrow)
                    rows, held = [], 0
                rows.append((key, text))
                held += len(text) + 32
        if rows:
            yield _batch(list(group(rows)), arrow)

    return df.select(id_col, text_col).mapInArrow(run, schema)


def _batch(rows: list, arrow: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[] for _ in arrow]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow)


def arrow_schema(schema: str) -> pa.Schema:
    return pa.schema([(f.name, _arrow_type(f.dataType)) for f in _struct(schema).fields])


def _struct(schema: str):
    from pyspark.sql.types import StructType

    return StructType.fromDDL(schema)


def _arrow_type(kind) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)

"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from lociq.plans.storage import find_package

#: Rows that one Python step holds at a time, whatever the size of Spark's Arrow batches.
SLICE_ROWS = 512


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def schema_of(ddl: str) -> T.StructType:
    return T._parse_datatype_string(ddl)


def to_batch(got: dict, arrow: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(got[f.name], type=f.type) for f in arrow], schema=arrow)


def map_columns(df: DataFrame, fn: Callable[[dict], dict], ddl: str) -> DataFrame:
    """Apply ``fn`` to slices of columns (name -> list of Python values), on Arrow batches.

    ``fn`` returns lists by output column; these may be longer or shorter than the input.
    """
    out_type = schema_of(ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow = to_arrow_schema(out_type)
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(at, SLICE_ROWS)
                yield to_batch(fn({n: part.column(i).to_pylist() for i, n in enumerate(part.schema.names)}), arrow)

    find_package(df.sparkSession)
    return df.mapInArrow(run, out_type)


def map_stream(df: DataFrame, fn: Callable[[Iterator[dict]], Iterator[dict]], ddl: str) -> DataFrame:
    """Apply ``fn`` to a task's rows in their order: it takes batches of columns one after another and yields such batches."""
    out_type = schema_of(ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow = to_arrow_schema(out_type)
        for got in fn({n: b.column(i).to_pylist() for i, n in enumerate(b.schema.names)} for b in batches):
            yield to_batch(got, arrow)

    find_package(df.sparkSession)
    return df.mapInArrow(run, out_type)


def map_groups(df: DataFrame, keys: list[str], fn: Callable[[dict], dict], ddl: str, then: list[str] | None = None) -> DataFrame:
    """Apply ``fn`` to each group's columns, a group at a time, on sorted partitions.

    Groups must be bounded by the caller. Many small groups share one Python call into Arrow.
    """
    out_type = schema_of(ddl)
    names = [f.name for f in out_type]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow = to_arrow_schema(out_type)
        out: dict[str, list] = {n: [] for n in names}
        held: dict[str, list] | None = None
        held_key = None

        def done(group: dict) -> None:
            for n, v in fn(group).items():
                out[n].extend(v)

        for batch in batches:
            cols = {n: batch.column(i).to_pylist() for i, n in enumerate(batch.schema.names)}
            key = list(zip(*(cols[k] for k in keys), strict=True))
            cuts = [0, *(i for i in range(1, len(key)) if key[i] != key[i - 1]), len(key)] if key else []
            for lo, hi in zip(cuts, cuts[1:], strict=False):
                part = {n: v[lo:hi] for n, v in cols.items()}
                if held is not None and held_key == key[lo]:
                    for n, v in part.items():
                        held[n].extend(v)
                    continue
                if held is not None:
                    done(held)
                held, held_key = part, key[lo]
            if len(out[names[0]]) >= 4096:
                yield to_batch(out, arrow)
                out = {n: [] for n in names}
        if held is not None:
            done(held)
        if out[names[0]]:
            yield to_batch(out, arrow)

    find_package(df.sparkSession)
    return df.repartition(*keys).sortWithinPartitions(*keys, *(then or [])).mapInArrow(run, out_type)


def fold_of(doc_id) -> int:
    """crc32 of the id as text, modulo 5. A null id counts as the text ``null``."""
    return zlib.crc32(b"null" if doc_id is None else str(doc_id).encode()) % 5


def fold_column(col: str = "doc_id"):
    """``fold_of`` as a column."""
    return F.pmod(F.crc32(F.coalesce(F.col(col).cast("string"), F.lit("null")).cast("binary")), F.lit(5)).cast("int")


#: 64-bit hashes of words in bytes, remembered by each worker up to so many words.
MOST_WORDS = 400_000
_HASHES: dict[str, bytes] = {}


def word_hashes(words: list[str]) -> np.ndarray:
    got = list(map(_HASHES.get, words))
    if None in got:
        if len(_HASHES) > MOST_WORDS:
            _HASHES.clear()
        for i, g in enumerate(got):
            if g is None:
                got[i] = h = xxhash.xxh3_64_digest(words[i].encode("utf-8", "surrogatepass"))
                if len(words[i]) <= 64:
                    _HASHES[words[i]] = h
    return np.frombuffer(b"".join(got), dtype=">u8").astype(np.uint64)


_STEP = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], dtype=np.uint64)


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


def shingle_hashes(text: str | None, width: int = 5) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the runs of ``width`` lower-cased, blank-separated words.

    A text of fewer words has one shingle of all its words; a null, empty or blank text none.
    """
    words = (text or "").lower().split()
    if not words:
        return np.empty(0, dtype=np.uint64)
    w = word_hashes(words)
    n, k = len(w), min(width, len(w))
    h = np.full(n - k + 1, k, dtype=np.uint64)
    for i in range(k):
        h = mixed(h * _STEP[i % 8] + w[i : n - k + 1 + i])
    h.sort()
    first = np.ones(len(h), dtype=bool)
    np.not_equal(h[1:], h[:-1], out=first[1:])
    return h[first]


def flag_rows(docs: DataFrame, keep: Callable[[str | None], bool]) -> DataFrame:
    """The rows whose text ``keep`` accepts, as they are; null texts and repeated rows are asked about like any other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array([keep(t) for t in batch.column("text").to_pylist()], type=pa.bool_()))

    find_package(docs.sparkSession)
    return docs.mapInArrow(run, docs.schema)


def rewrite_texts(docs: DataFrame, change: Callable[[str | None], str | None]) -> DataFrame:
    """Every row with ``change`` applied to its text, null or not; n_chars, where there is one, follows a text that changed."""
    schema = docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("text")
            old = batch.column(at).to_pylist()
            new = [change(t) for t in old]
            columns = list(batch.columns)
            columns[at] = pa.array(new, type=batch.schema.field(at).type)
            k = batch.schema.get_field_index("n_chars")
            if k >= 0:
                columns[k] = pa.array([len(b) if a != b else n for a, b, n in zip(old, new, batch.column(k).to_pylist(), strict=True)], type=batch.schema.field(k).type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    find_package(docs.sparkSession)
    return docs.mapInArrow(run, schema)

"""Bottom-k sketches of shingle hashes: mergeable, with resemblance, containment and distinct counts."""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from lociq.llm.frames import SLICE_ROWS, schema_of, shingle_hashes, to_batch
from lociq.plans.storage import find_package

#: Hashes kept of a text.
K = 128
_SPACE = float(1 << 64)


def bottom(hashes: np.ndarray, k: int = K) -> np.ndarray:
    """The k least of sorted distinct hashes."""
    return hashes[:k]


def merge(a: np.ndarray, b: np.ndarray, k: int = K) -> np.ndarray:
    """The sketch of the union of what two sketches stand for."""
    return np.union1d(a, b)[:k]


def distinct(a: np.ndarray, k: int = K) -> float:
    """Distinct shingles: exact below k, else (k - 1) over the k-th least hash as a share of all."""
    return float(len(a)) if len(a) < k else (k - 1) / (float(a[k - 1]) / _SPACE)


def resemblance(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Share of the union's sketch that both hold. Two empty sketches resemble wholly."""
    union = merge(a, b, k)
    if not len(union):
        return 1.0
    return len(np.intersect1d(np.intersect1d(a, b, assume_unique=True), union, assume_unique=True)) / len(union)


def containment(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated share of a's shingles that b has too; 1 for an empty a."""
    if not len(a):
        return 1.0
    return min(1.0, resemblance(a, b, k) * distinct(merge(a, b, k), k) / distinct(a, k))


def written(a: np.ndarray) -> str:
    """The sketch as text: its hashes as little-endian 64-bit integers, in base64."""
    return base64.b64encode(a.astype("<u8").tobytes()).decode()


def read(text: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(text), dtype="<u8").astype(np.uint64)


def sketch_of(text: str | None, k: int = K) -> np.ndarray:
    return bottom(shingle_hashes(text), k)


def edited(text: str, following: str) -> str:
    """The last quarter (rounded down) of the code points replaced by as many first ones of the next text, or all it has."""
    n = len(text) // 4
    return text[: len(text) - n] + following[:n]


def tie_of(text):
    """A column: the text's hash below 2^32, by which rows of one id follow each other."""
    return F.xxhash64(text).bitwiseAND(F.lit(0xFFFFFFFF))


_ROW = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, contained_next double, distinct_shingles double"


def _ranges(keys: DataFrame, parts: int) -> np.ndarray:
    """Where ranges of ids begin: parts - 1 values at most, from quantiles of the id alone; an id that is a large share of the rows comes several times."""
    got = keys.approxQuantile("key", [i / parts for i in range(1, parts)], 1 / (4 * parts)) if parts > 1 else []
    return np.array(sorted(int(x) for x in got), dtype=np.int64)


def range_of(begins: np.ndarray, key: np.ndarray, tie: np.ndarray) -> np.ndarray:
    """The range of each row, in the order of (key, tie). The rows of an id that comes m times in ``begins`` are cut into m ranges of ties, which are hashes below 2^32."""
    left, right = np.searchsorted(begins, key, side="left"), np.searchsorted(begins, key, side="right")
    often = right - left
    return np.where(often > 1, left + 1 + (tie * np.maximum(often, 1) >> 32), right).astype(np.int32)


def sketch_with_next(docs: DataFrame, *, k: int = K, parts: int | None = None) -> DataFrame:
    """Each document's sketch, its edited text's, and its likeness to the next document.

    The next document is the one with the next doc_id; the last is followed by the first. A
    document moves once, to a range of ids, and the first of a range also to the range before;
    an id that many rows have is cut into several ranges. Rows with the same id follow each
    other by a hash of their texts, then the texts; a null id comes first. Null texts count as
    empty. A lone document is its own next. An empty table has no row.
    """
    spark = docs.sparkSession
    find_package(spark)
    text = F.coalesce("text", F.lit(""))
    keyed = docs.select(
        "doc_id", text.alias("text"), F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("key"), tie_of(text).alias("tie")
    )
    parts = parts or 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    begins = spark.sparkContext.broadcast(_ranges(keyed.select("key"), parts))

    @F.pandas_udf("int")
    def part_of(key: pd.Series, tie: pd.Series) -> pd.Series:
        return pd.Series(range_of(begins.value, key.to_numpy(), tie.to_numpy()))

    part = part_of("key", "tie")
    first = F.min(F.struct("key", "tie")).alias("first")
    firsts = sorted((r.first.key, r.first.tie, r.part) for r in keyed.select("key", "tie", part.alias("part")).groupBy("part").agg(first).collect())  # a row for each range
    if not firsts:
        return spark.createDataFrame([], schema_of(_ROW))
    # as many rows as ranges, so they are broadcast; of rows that share a first place any one is the guest
    before = F.broadcast(spark.createDataFrame([(key, tie, firsts[i - 1][2]) for i, (key, tie, _) in enumerate(firsts)], "key long, tie long, before int"))
    own, guest = F.struct(F.col("own").alias("part"), F.lit(False).alias("guest")), F.struct(F.col("before").alias("part"), F.lit(True).alias("guest"))
    placed = keyed.withColumn("own", part).join(before, ["key", "tie"], "left").withColumn("p", F.explode(F.array(own, guest)))
    placed = placed.select("doc_id", "text", "key", "tie", "p.part", "p.guest").filter("part is not null")
    dealt = placed.repartition("part").sortWithinPartitions("part", "guest", "key", "tie", "text").select("doc_id", "text", "part", "guest")
    out_type = schema_of(_ROW)

    def run(batches):
        arrow = to_arrow_schema(out_type)
        last = None  # the document that waits for its next
        for batch in batches:
            for lo in range(0, batch.num_rows, SLICE_ROWS):
                cols = batch.slice(lo, SLICE_ROWS).to_pydict()
                out: dict[str, list] = {f.name: [] for f in out_type}
                for doc_id, text, of, guest in zip(cols["doc_id"], cols["text"], cols["part"], cols["guest"], strict=True):
                    sketch = sketch_of(text, k)
                    if last is not None and last[2] == of and not last[4]:
                        own = last[3]
                        other = edited(last[1], text)
                        changed = sketch_of(other, k)
                        row = (last[0], len(last[1]), hashlib.sha256(other.encode("utf-8", "surrogatepass")).hexdigest(), written(own), written(changed), resemblance(own, changed, k), resemblance(own, sketch, k), containment(own, sketch, k), distinct(own, k))
                        for column, v in zip(out.values(), row, strict=True):
                            column.append(v)
                    last = (doc_id, text, of, sketch, guest)
                yield to_batch(out, arrow)

    return dealt.mapInArrow(run, out_type)

"""Media columns as content-defined chunks: a deduplicated chunk store and ordered chunk lists.

A rolling gear hash over the last 32 bytes cuts a payload where its top bits are zero, between
``SHORTEST`` and ``LONGEST`` bytes. A chunk is stored once, under its SHA-256 digest, as
compressed 8-bit samples. The ordered list of a payload's chunks rebuilds it; every chunk is
checked against its digest, and the payload against its length.
"""

from __future__ import annotations

import hashlib
import struct
import zlib

import numpy as np
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lociq.llm.frames import map_columns
from lociq.plans.storage import materialise, scratch_path

UNIT = 64
SHORTEST, LONGEST, CUT_BITS = 1024, 16384, 12
#: A chunk used more often than this is copied once for each so many uses, so that no task joins all of them.
USES = 500
#: Bits of the broadcast filter for shared digests: 8 MB, whatever the size of the corpus.
FILTER_BITS = 26
_GEAR = np.random.default_rng(64).integers(0, 1 << 32, 256, dtype=np.uint32)


def payload_of(text: str | None) -> tuple[bytes, int]:
    """The text in UTF-8 with bytes 0 up to a positive multiple of UNIT, and the unpadded length."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    size = max(UNIT, -(-len(raw) // UNIT) * UNIT)
    return raw.ljust(size, b"\0"), len(raw)


def gear_hashes(data: bytes) -> np.ndarray:
    """The gear hash at every byte: the sum over the last 32 bytes of gear[byte] << distance."""
    h = _GEAR[np.frombuffer(data, dtype=np.uint8)]
    for k in (1, 2, 4, 8, 16):  # windows of 2, 4, 8, 16 and 32 bytes
        longer = h.copy()
        longer[k:] += h[:-k] << np.uint32(k)
        h = longer
    return h


def cut_points(data: bytes) -> list[int]:
    """Ends of the chunks; the last is the length."""
    n, cuts, at = len(data), [], 0
    if n > SHORTEST:
        spots = np.flatnonzero(gear_hashes(data) >> np.uint32(32 - CUT_BITS) == 0) + 1
        k = 0
        while n - at > SHORTEST:
            k += int(np.searchsorted(spots[k:], at + SHORTEST))
            at = min(int(spots[k]) if k < len(spots) else n, at + LONGEST, n)
            cuts.append(at)
    if at < n:
        cuts.append(n)
    return cuts


def chunks_of(data: bytes) -> list[tuple[bytes, bytes]]:
    """(digest, bytes) of the chunks in order."""
    out, lo = [], 0
    for hi in cut_points(data):
        chunk = data[lo:hi]
        out.append((hashlib.sha256(chunk).digest(), chunk))
        lo = hi
    return out


def _digests(cols: dict) -> dict:
    return {"digest": [d for text in cols["text"] for d, _ in chunks_of(payload_of(text)[0])]}


def _bit(digest):
    """The filter's bit for a digest column: its first four bytes, cut to FILTER_BITS."""
    return F.conv(F.hex(F.substring(digest, 1, 4)), 16, 10).cast("long").bitwiseAND(F.lit((1 << FILTER_BITS) - 1))


def shared_filter(docs: DataFrame) -> np.ndarray:
    """A bit for every digest that occurs twice or more, in 64-bit words.

    Occurrences are counted in Spark; what comes to the driver is the filter, of bounded size.
    A bit that other digests set too only sends a chunk the shared way, so a full filter is
    still right: then all chunks are joined.
    """
    shared = map_columns(docs.select("text"), _digests, "digest binary").groupBy("digest").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    words = shared.select(_bit("digest").alias("bit")).select(F.shiftright("bit", 6).alias("word"), F.expr("shiftleft(1L, cast(bit & 63 as int))").alias("set")).groupBy("word").agg(F.bit_or("set").alias("set")).toPandas()
    out = np.zeros(1 << (FILTER_BITS - 6), dtype=np.uint64)
    out[words["word"].to_numpy(dtype=np.int64)] = words["set"].to_numpy(dtype=np.int64).view(np.uint64)
    return out


_STORED = "kind int, doc_id long, key binary, n_bytes long, payload_bytes long, digests array<binary>, sizes array<int>, bodies array<binary>, digest binary, body binary"


def store(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(media, chunks), both written to the shared folder.

    media has a row for each document: doc_id, key (SHA-256 of the payload), n_bytes,
    payload_bytes and the ordered lists digests, sizes and bodies. A chunk that occurs once
    lies in its document's bodies; the body of any other is null there and lies once in
    chunks (digest, body). So every distinct chunk is stored once, and only digests and
    shared chunks move between executors.
    """
    spark = docs.sparkSession
    seen = spark.sparkContext.broadcast(shared_filter(docs))

    def put(cols: dict) -> dict:
        squeeze = zstandard.ZstdCompressor(level=3).compress
        words, out = seen.value, {k.split()[0]: [] for k in _STORED.split(", ")}
        sent: set[bytes] = set()

        def row(*values) -> None:
            for column, v in zip(out.values(), values, strict=True):
                column.append(v)

        for doc_id, text in zip(cols["doc_id"], cols["text"], strict=True):
            data, raw = payload_of(text)
            digests, sizes, bodies = [], [], []
            for digest, chunk in chunks_of(data):
                bit = int.from_bytes(digest[:4], "big") & ((1 << FILTER_BITS) - 1)
                shared = int(words[bit >> 6]) >> (bit & 63) & 1
                body = None if shared and digest in sent else squeeze(chunk)
                if shared and body is not None:
                    sent.add(digest)
                    row(1, None, None, None, None, None, None, None, digest, body)
                digests.append(digest)
                sizes.append(len(chunk))
                bodies.append(None if shared else body)
            row(0, doc_id, hashlib.sha256(data).digest(), raw, len(data), digests, sizes, bodies, None, None)
        return out

    path = scratch_path(spark, "media")
    map_columns(docs.select("doc_id", "text"), put, _STORED).write.partitionBy("kind").option("compression", "zstd").parquet(path)
    table = spark.read.schema(_STORED.removeprefix("kind int, ") + ", kind int").parquet(path)
    media = table.filter("kind = 0").select("doc_id", "key", "n_bytes", "payload_bytes", "digests", "sizes", "bodies")
    return media, materialise(table.filter("kind = 1").groupBy("digest").agg(F.first("body").alias("body")), "chunks")


def feature_of(data: bytes, chunks: int) -> str:
    """Chunks, mean byte and entropy in bits, of the whole payload."""
    n = np.bincount(np.frombuffer(data, dtype=np.uint8), minlength=256)
    p = n[n > 0] / len(data)
    return f"chunks={chunks};mean={(n * np.arange(256)).sum() / len(data):.4f};entropy={max(0.0, -(p * np.log2(p)).sum()):.4f}"


_READ = "n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, n_chunks int"


def _rebuild(by: str):
    def rebuild(cols: dict) -> dict:
        expand = zstandard.ZstdDecompressor().decompress
        names = [by, *(c.split()[0] for c in _READ.split(", "))]
        out: dict[str, list] = {n: [] for n in names}
        for i, who in enumerate(cols[by]):
            bodies, digests, sizes = list(cols["bodies"][i]), cols["digests"][i], cols["sizes"][i]
            for x in (cols["fetched"][i] or []) if "fetched" in cols else []:
                bodies[x["place"]] = x["body"]
            parts = [expand(b, max_output_size=s) for b, s in zip(bodies, sizes, strict=True)]
            for part, digest, size in zip(parts, digests, sizes, strict=True):
                if len(part) != size or hashlib.sha256(part).digest() != digest:
                    raise ValueError("a stored chunk doesn't have its size or digest")
            data = b"".join(parts)
            if len(data) != cols["payload_bytes"][i] or hashlib.sha256(data).digest() != cols["key"][i]:
                raise ValueError("a rebuilt payload differs from the one that was stored")
            stored = b"".join([*(d + struct.pack("<I", s) for d, s in zip(digests, sizes, strict=True)), *bodies])
            row = (who, cols["n_bytes"][i], len(data), hashlib.sha256(data).hexdigest(), zlib.crc32(data[-UNIT:]), len(stored), hashlib.sha256(stored).hexdigest(), feature_of(data, len(parts)), len(parts))
            for n, v in zip(names, row, strict=True):
                out[n].append(v)
        return out

    return rebuild


def read_back(media: DataFrame, chunks: DataFrame) -> DataFrame:
    """Rebuild every document's media from the store and compute its features.

    Documents whose chunks all lie with them are read in place. The others are rebuilt once
    for each distinct payload and chunk list: their shared digests are joined with the chunks,
    hot ones over copies of the chunk, and the results are joined back to the documents, each
    with its own length.
    """
    lacks = F.exists("bodies", lambda b: b.isNull())
    whole = map_columns(media.filter(~lacks), _rebuild("doc_id"), "doc_id long, " + _READ)
    lists = F.concat("key", F.array_join(F.transform("digests", lambda d: F.hex(d)), ",").cast("binary"), F.array_join(F.transform("sizes", lambda s: s.cast("string")), ",").cast("binary"))
    owing = media.filter(lacks).withColumn("stored", F.unhex(F.sha2(lists, 256)))
    one = owing.groupBy("stored").agg(F.first(F.struct("key", "n_bytes", "payload_bytes", "digests", "sizes", "bodies")).alias("m")).select("stored", "m.*")
    refs = one.select("stored", F.posexplode(F.arrays_zip("digests", "bodies")).alias("place", "c")).filter("c.bodies is null").select("stored", "place", F.col("c.digests").alias("digest"))
    copies = refs.groupBy("digest").agg(F.ceil(F.count(F.lit(1)) / USES).cast("int").alias("copies"))
    held = chunks.join(copies, "digest").withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("copies") - 1))).select("digest", "salt", "body")
    hot = copies.filter("copies > 1")
    salted = refs.join(hot, "digest", "left").withColumn("salt", F.pmod(F.xxhash64("stored", "place"), F.coalesce("copies", F.lit(1))).cast("int")).select("stored", "place", "digest", "salt")
    fetched = salted.join(held, ["digest", "salt"]).groupBy("stored").agg(F.collect_list(F.struct("place", "body")).alias("fetched"))
    rebuilt = map_columns(one.join(fetched, "stored"), _rebuild("stored"), "stored binary, " + _READ)
    shared = owing.select("doc_id", "stored", "n_bytes").join(rebuilt.drop("n_bytes"), "stored").drop("stored")
    return whole.unionByName(shared)


def media_features(docs: DataFrame) -> DataFrame:
    """Store every whole text and read it back: a row for each document.

    A null text counts as empty; its payload is UNIT zero bytes. Rows with the same doc_id, or
    a null one, each count. media_bytes and media_sha256 are of the stored form as it is read
    back: the ordered chunk list (a digest and a 32-bit size each), then the compressed bodies
    of the chunks. An empty table has no row.
    """
    return read_back(*store(docs))

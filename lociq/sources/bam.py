"""BAM files in and out, and alignments laid out for range reads.

A BAM file is a chain of small compressed blocks, each with the same first four bytes. Spark's
line reader, told that these are the line separator, reads the blocks of a file in any number of
splits and from any file system, so no task needs a file by itself. A record may begin in one
split and end in the next: each split hands on the bytes before its first record and after its
last whole one, which are put together by file, and have to be whole records then.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from lociq.functions import cigar
from lociq.operators.intervals import overlap_exists, overlap_join
from lociq.plans.storage import find_package, materialise, scratch_path
from lociq.sources.reads import with_tag_columns

# Fixed values of the format.
MAGIC, BAM_MAGIC = b"\x1f\x8b\x08\x04", b"BAM\x01"
EOF_BLOCK = bytes.fromhex("1f8b08040000000000ff0600424302001b0003000000000000000000")
BASES = "=ACMGRSVTWYHKDBN"
NUMBERS = {"c": "b", "C": "B", "s": "h", "S": "H", "i": "i", "I": "I"}
# End of the fixed values.

#: Bytes of a block before compression.
BLOCK_BYTES = 65280
#: Bytes at the start of a split in which its first record is sought and what follows it is checked.
SOUGHT_BYTES = 1 << 18
_HEX = "0123456789abcdef"
_TO_BASES, _TO_HEX = str.maketrans(_HEX, BASES), str.maketrans(BASES + BASES.lower(), _HEX * 2)
_QUAL_UP, _QUAL_DOWN = bytes((i + 33) % 256 for i in range(256)), bytes((i - 33) % 256 for i in range(256))
_HEAD = struct.Struct("<iiiBBHHHiiii")

RECORDS = (
    "qname string, flag int, rname string, pos int, mapq int, cigar array<struct<op:int,len:int>>, rnext string, pnext int, tlen int, seq string, qual string,"
    " tags map<string,string>, tag_types map<string,string>"
)
_BORDERS = "file string, start bigint, begins boolean, head binary, tail binary"


def _parse_ddl(ddl: str) -> T.StructType:
    return T._parse_datatype_string(ddl)


# ---------------------------------------------------------------- blocks and records


def block_size(data: bytes) -> int | None:
    """Length that a block's own header gives it, or None if this is no block header."""
    if len(data) < 18 or not data.startswith(MAGIC):
        return None
    at, end = 12, 12 + int.from_bytes(data[10:12], "little")
    while at + 4 <= min(end, len(data)):
        n = int.from_bytes(data[at + 2 : at + 4], "little")
        if data[at : at + 2] == b"BC" and n == 2:
            return int.from_bytes(data[at + 4 : at + 6], "little") + 1
        at += 4 + n
    return None


def inflate(block: bytes) -> bytes:
    skip = 12 + int.from_bytes(block[10:12], "little")
    out = zlib.decompress(block[skip:-8], wbits=-15)
    if zlib.crc32(out) != int.from_bytes(block[-8:-4], "little") or len(out) != int.from_bytes(block[-4:], "little"):
        raise ValueError("a block's checksum or length is wrong")
    return out


def deflate(data: bytes) -> bytes:
    z = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = z.compress(data) + z.flush()
    return MAGIC + b"\0\0\0\0\0\xff\x06\0BC\x02\0" + (len(body) + 25).to_bytes(2, "little") + body + zlib.crc32(data).to_bytes(4, "little") + len(data).to_bytes(4, "little")


def read_header(data: bytes) -> tuple[str, list[tuple[str, int]], int] | None:
    """(text, references with lengths, bytes) of a file's header, or None if ``data`` ends before it does."""
    try:
        if not data.startswith(BAM_MAGIC):
            if len(data) >= 4:
                raise ValueError("not a BAM file")
            return None
        n = struct.unpack_from("<i", data, 4)[0]
        at, refs = 8 + n, []
        (count,) = struct.unpack_from("<i", data, at)
        at += 4
        for _ in range(count):
            (k,) = struct.unpack_from("<i", data, at)
            refs.append((data[at + 4 : at + 3 + k].decode(), struct.unpack_from("<i", data, at + 4 + k)[0]))
            at += 8 + k
        return data[8 : 8 + n].rstrip(b"\0").decode(), refs, at
    except struct.error:
        return None


def plausible(data: bytes, at: int, n_refs: int) -> int | None:
    """Where the next record begins if one may begin here: what it says of itself agrees. len(data) if it can't be told to its end."""
    if at + 36 > len(data):
        return len(data)
    size, ref, pos, l_name, _, _, n_cigar, _, l_seq, next_ref, next_pos, _ = _HEAD.unpack_from(data, at)
    if not (-1 <= ref < n_refs and -1 <= next_ref < n_refs and pos >= -1 and next_pos >= -1 and l_name >= 1 and l_seq >= 0):
        return None
    if size < 32 + l_name + 4 * n_cigar + (l_seq + 1) // 2 + l_seq:
        return None
    name = data[at + 36 : at + 36 + l_name]
    if len(name) == l_name and (name[-1] or any(not 33 <= c <= 126 for c in name[:-1])):
        return None
    ops = data[at + 36 + l_name : at + 36 + l_name + 4 * n_cigar : 4]
    if any(c & 15 > 8 for c in ops):
        return None
    return min(at + 4 + size, len(data))


def first_record(data: bytes, n_refs: int) -> int | None:
    """The first place from which on all of ``data`` reads as records, one whole at least."""
    for at in range(max(0, len(data) - 36)):
        to, whole = at, 0
        while to is not None and to < len(data):
            to = plausible(data, to, n_refs)
            whole += to is not None and to < len(data)
        if to is not None and whole:
            return at
    return None


class _Columns:
    """Records decoded into columns of Arrow."""

    def __init__(self, names: list[str]):
        self.names = [*names, None]  # -1 is no reference
        self.plain: list[tuple] = []
        self.ops: list[int] = []
        self.cuts, self.tag_cuts = [0], [0]
        self.keys: list[str] = []
        self.values: list[str] = []
        self.kinds: list[str] = []

    def add(self, data: bytes, at: int, end: int) -> None:
        _, ref, pos, l_name, mapq, _, n_cigar, flag, l_seq, next_ref, next_pos, tlen = _HEAD.unpack_from(data, at)
        at += 36
        name = data[at : at + l_name - 1].decode("latin-1")
        at += l_name
        ops = struct.unpack_from(f"<{n_cigar}I", data, at)
        at += 4 * n_cigar
        half = (l_seq + 1) // 2
        seq = data[at : at + half].hex()[:l_seq].translate(_TO_BASES) if l_seq else "*"
        at += half
        raw = data[at : at + l_seq]
        qual = "*" if not l_seq or raw[:1] == b"\xff" else raw.translate(_QUAL_UP).decode("latin-1")
        tags = read_tags(data, at + l_seq, end)
        if (long := tags.get("CG")) and n_cigar == 2 and ops[0] & 15 == 4 and ops[0] >> 4 == l_seq and ops[1] & 15 == 3:
            ops = tuple(map(int, long[1].split(",")[1:]))  # more ops than the field can count
            del tags["CG"]
        self.plain.append((name, flag, self.names[ref], pos, mapq, self.names[next_ref], next_pos, tlen, seq, qual))
        self.ops += ops
        self.cuts.append(len(self.ops))
        for k, (kind, value) in tags.items():
            self.keys.append(k)
            self.kinds.append(kind)
            self.values.append(value)
        self.tag_cuts.append(len(self.keys))

    def batch(self, arrow: pa.Schema, border: dict | None = None) -> pa.RecordBatch:
        n = len(self.plain)
        cols = list(zip(*self.plain, strict=True)) if n else [()] * 10
        ops = np.array(self.ops, dtype=np.uint32)
        pairs = pa.StructArray.from_arrays([pa.array((ops & 15).astype(np.int32)), pa.array((ops >> 4).astype(np.int32))], names=["op", "len"])
        cuts, tag_cuts, keys = pa.array(self.cuts, pa.int32()), pa.array(self.tag_cuts, pa.int32()), pa.array(self.keys, pa.string())
        made = dict(zip(("qname", "flag", "rname", "pos", "mapq", "rnext", "pnext", "tlen", "seq", "qual"), cols, strict=True))
        made |= {"cigar": pa.ListArray.from_arrays(cuts, pairs), "tags": pa.MapArray.from_arrays(tag_cuts, keys, pa.array(self.values, pa.string())), "tag_types": pa.MapArray.from_arrays(tag_cuts, keys, pa.array(self.kinds, pa.string()))}
        out = []
        for f in arrow:
            if border is not None:
                out.append(pa.array([border.get(f.name)], type=f.type))
            elif f.name in made:
                out.append(made[f.name].cast(f.type) if isinstance(made[f.name], pa.Array) else pa.array(list(made[f.name]), type=f.type))
            else:
                out.append(pa.nulls(n, f.type))
        return pa.RecordBatch.from_arrays(out, schema=arrow)


def read_tags(data: bytes, at: int, end: int) -> dict[str, tuple[str, str]]:
    """key -> (type as in SAM text, value as text); of a repeated key the last counts."""
    out: dict[str, tuple[str, str]] = {}
    while at < end:
        key, kind = data[at : at + 2].decode("latin-1"), chr(data[at + 2])
        at += 3
        if kind in NUMBERS:
            (v,) = struct.unpack_from("<" + NUMBERS[kind], data, at)
            at += struct.calcsize(NUMBERS[kind])
            out[key] = ("i", str(v))
        elif kind in "ZH":
            stop = data.index(b"\0", at, end)
            out[key] = (kind, data[at:stop].decode("latin-1"))
            at = stop + 1
        elif kind == "A":
            out[key] = ("A", chr(data[at]))
            at += 1
        elif kind == "f":
            out[key] = ("f", str(np.frombuffer(data, "<f4", 1, at)[0]))
            at += 4
        elif kind == "B":
            of, n = chr(data[at]), struct.unpack_from("<i", data, at + 1)[0]
            values = np.frombuffer(data, "<f4", n, at + 5) if of == "f" else struct.unpack_from(f"<{n}{NUMBERS[of]}", data, at + 5)
            out[key] = ("B", ",".join([of, *map(str, values)]))
            at += 5 + n * (4 if of == "f" else struct.calcsize(NUMBERS[of]))
        else:
            raise ValueError(f"tag {key} has the unknown type {kind}")
    return out


def _number(v: int) -> tuple[str, bytes]:
    kind = next((k for k, lo, hi in (("c", -128, 127), ("C", 0, 255), ("s", -32768, 32767), ("S", 0, 65535), ("i", -(1 << 31), (1 << 31) - 1), ("I", 0, (1 << 32) - 1)) if lo <= v <= hi), None)
    if kind is None:
        raise ValueError(f"{v} doesn't fit into a tag")
    return kind, struct.pack("<" + NUMBERS[kind], v)


def pack_tag(key: str, kind: str, value: str) -> bytes:
    if kind == "i":
        kind, body = _number(int(value))
    elif kind in "ZH":
        body = value.encode("latin-1") + b"\0"
    elif kind == "A":
        body = value.encode("latin-1")[:1]
    elif kind == "f":
        body = struct.pack("<f", float(value))
    elif kind == "B":
        of, *items = value.split(",")
        body = of.encode() + struct.pack("<i", len(items)) + (np.array(items, dtype="<f4").tobytes() if of == "f" else struct.pack(f"<{len(items)}{NUMBERS[of]}", *map(int, items)))
    else:
        raise ValueError(f"tag {key} has the unknown type {kind}")
    return key.encode() + kind.encode() + body


def region_bin(start: int, end: int) -> int:
    """The smallest bin of the format's five levels that holds [start, end)."""
    end -= 1
    for shift, first in ((14, 4681), (17, 585), (20, 73), (23, 9), (26, 1)):
        if start >> shift == end >> shift:
            return first + (start >> shift)
    return 0


def pack_record(r: dict, refs: dict[str, int]) -> bytes:
    """A record of a row of RECORDS; tags without a type are numbers if they read so, else text."""
    ops = [(x["op"], x["len"]) for x in r["cigar"] or []]
    seq = "" if r["seq"] in (None, "*") else r["seq"]
    qual = b"\xff" * len(seq) if r["qual"] in (None, "*") else r["qual"].encode("latin-1").translate(_QUAL_DOWN)
    if len(qual) != len(seq):
        raise ValueError(f"read {r['qname']}: {len(seq)} bases and {len(qual)} qualities")
    kinds = dict(r.get("tag_types") or {})
    tags = b"".join(pack_tag(k, kinds.get(k) or ("i" if v.lstrip("-").isdigit() and len(v) < 11 else "Z"), v) for k, v in dict(r["tags"] or {}).items())
    span = sum(n for op, n in ops if op in cigar.ON_REFERENCE)
    if len(ops) > 65535:
        tags += pack_tag("CG", "B", ",".join(["I", *(str(n << 4 | op) for op, n in ops)]))
        ops = [(4, len(seq)), (3, span)]
    for name in (r["rname"], r["rnext"]):
        if name is not None and name not in refs:
            raise ValueError(f"reference {name} isn't in the header")
    pos, name = -1 if r["pos"] is None else r["pos"], (r["qname"] or "*").encode("latin-1") + b"\0"
    digits = seq.translate(_TO_HEX) + "0" * (len(seq) % 2)
    if digits.strip(_HEX):
        digits = "".join(c if c in _HEX else "f" for c in digits)  # a base that the format doesn't know is N
    spot = region_bin(max(pos, 0), max(pos, 0) + max(span, 1))
    head = (refs.get(r["rname"], -1), pos, len(name), 255 if r["mapq"] is None else r["mapq"], spot, len(ops), r["flag"] or 0, len(seq), refs.get(r["rnext"], -1), -1 if r["pnext"] is None else r["pnext"], r["tlen"] or 0)
    body = struct.pack("<iiBBHHHiiii", *head) + name + struct.pack(f"<{len(ops)}I", *(n << 4 | op for op, n in ops)) + bytes.fromhex(digits) + qual + tags
    return struct.pack("<i", len(body)) + body


# ---------------------------------------------------------------- reading


def bam_header(spark: SparkSession, path: str) -> tuple[str, list[tuple[str, int]]]:
    """Header text and references of the first file below a path that isn't empty, read by the file system's own client."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    stream, raw, data, name = None, b"", b"", ""
    for name in sorted(spark.read.text(path).inputFiles()):
        where = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(name))
        if where.getFileSystem(conf).getFileStatus(where).getLen():
            stream = where.getFileSystem(conf).open(where)
            break
    if stream is None:  # a table without rows
        return "", []
    try:
        while True:
            more = bytes(stream.readNBytes(1 << 16))
            raw += more
            while (n := block_size(raw)) and n <= len(raw):
                data += inflate(raw[:n])
                raw = raw[n:]
            if found := read_header(data):
                return found[:2]
            if not more:
                raise ValueError(f"{name} ends within its header")
    finally:
        stream.close()


def _decode(batches: Iterator[pa.RecordBatch], arrow: pa.Schema, refs: list[tuple[str, int]]) -> Iterator[pa.RecordBatch]:
    """Records of the blocks of one split after another, and a border row for each split."""
    names, now, piece, data, at, state = [n for n, _ in refs], None, b"", b"", 0, ""
    out, head = _Columns(names), b""

    def begin() -> None:
        """Find the first record of the bytes so far: after the header, or where they read as records."""
        nonlocal at, state, head
        if now[1] == 0:
            if found := read_header(data):
                if found[1] != refs:
                    raise ValueError(f"{now[0]} has other references than the first file")
                at, state = found[2], "in"
        elif (spot := first_record(data, len(refs))) is not None:
            head, at, state = data[:spot], spot, "in"

    def parse() -> None:
        nonlocal at, data
        while at + 4 <= len(data) and (end := at + 4 + int.from_bytes(data[at : at + 4], "little", signed=True)) <= len(data):
            out.add(data, at, end)
            at = end
        data, at = data[at:], 0

    def grow(block: bytes) -> None:
        nonlocal data
        data += inflate(block)
        if state == "seek" and len(data) >= (1 if now[1] == 0 else SOUGHT_BYTES):
            begin()
        if state == "in":
            parse()

    def finish() -> Iterator[pa.RecordBatch]:
        nonlocal state
        if now is None:
            return
        if piece and block_size(piece) != len(piece):
            raise ValueError(f"{now[0]}: a block ends in the middle")
        if piece:
            grow(piece)
        if state == "seek":
            begin()
            if state == "in":
                parse()
        if out.plain:
            yield out.batch(arrow)
        inside = state == "in"
        yield out.batch(arrow, {"file": now[0], "start": now[1], "begins": inside, "head": head if inside else data, "tail": data if inside else b""})

    for batch in batches:
        for name, start, value in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            if (name, start) != now:
                yield from finish()
                now, piece, data, at, state, head, out = (name, start), b"", b"", 0, "seek", b"", _Columns(names)
                if not value and start == 0:
                    continue
            if piece and block_size(piece) == len(piece):
                grow(piece)
                piece = MAGIC + value
            else:  # the four bytes may stand inside a block's data by chance
                piece = piece + MAGIC + value
            if len(out.plain) >= 2048:
                yield out.batch(arrow)
                out = _Columns(names)
    yield from finish()


def _join_borders(key, borders):
    """The records that lie across the splits of a file, put together in the order of the splits."""
    import pandas as pd

    borders, carry, rows = borders.sort_values("start"), b"", []
    for head, tail, begins in zip(borders["head"], borders["tail"], borders["begins"], strict=True):
        carry += head
        if begins:
            rows.append(carry)
            carry = tail
    return pd.DataFrame({"file": [key[0]], "whole": [b"".join(rows) + carry]})


def read_bam(spark: SparkSession, path: str) -> DataFrame:
    """Alignments of BAM files: the columns of ``read_sam``, and tag_types.

    ``path`` names a file, a folder or a pattern; all files have the first one's references.
    Blocks are read in Spark's splits, inflated and checked. Records go to a table in the
    shared folder, as each file's splits hand on their borders, which become the records
    that lie across splits; bytes left over are an error, never left out.
    """
    text, refs = bam_header(spark, path)
    find_package(spark)
    lines = spark.read.option("encoding", "ISO-8859-1").option("lineSep", MAGIC.decode("latin-1")).text(path)
    pieces = lines.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.col("value").cast("binary").alias("value"))
    schema = _parse_ddl(f"{RECORDS}, {_BORDERS}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _decode(batches, to_arrow_schema(schema), refs)

    table = materialise(pieces.mapInArrow(run, schema), "bam")
    records = [f.name for f in _parse_ddl(RECORDS)]
    across = table.filter("file is not null").select("file", "start", "begins", "head", "tail").groupBy("file").applyInPandas(_join_borders, "file string, whole binary")
    record_type = _parse_ddl(RECORDS)

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, data in zip(*(batch.column(i).to_pylist() for i in range(2)), strict=True):
                out, at = _Columns([n for n, _ in refs]), 0
                while at < len(data):
                    end = at + 4 + int.from_bytes(data[at : at + 4], "little", signed=True)
                    if plausible(data, at, len(refs)) is None or end > len(data):
                        raise ValueError(f"{name}: the bytes between its splits are no records; read it with larger splits")
                    out.add(data, at, end)
                    at = end
                yield out.batch(to_arrow_schema(record_type))

    return with_tag_columns(table.filter("file is null").select(*records).unionByName(across.mapInArrow(parse, record_type)))


# ---------------------------------------------------------------- writing


def write_bam(df: DataFrame, path: str, lengths: DataFrame, *, order: str = "unsorted") -> None:
    """Alignments as BAM, a file for each partition with a header of its own.

    ``lengths`` (chrom, length) are the references, which come to the driver: the header lists
    them all. Rows keep their order. Text columns are as ``read_sam`` gives them; a missing
    value is what the format has for it.
    """
    refs = [(r[0], r[1]) for r in lengths.select("chrom", F.col("length").cast("int")).orderBy("chrom").collect()]
    text = f"@HD\tVN:1.6\tSO:{order}\n" + "".join(f"@SQ\tSN:{n}\tLN:{k}\n" for n, k in refs)
    header = BAM_MAGIC + struct.pack("<i", len(text)) + text.encode() + struct.pack("<i", len(refs)) + b"".join(struct.pack("<i", len(n) + 1) + n.encode() + b"\0" + struct.pack("<i", k) for n, k in refs)
    names = [f.name for f in _parse_ddl(RECORDS)]
    ids = {n: i for i, (n, _) in enumerate(refs)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = bytearray(header)
        for batch in batches:
            blocks = []
            for row in batch.to_pylist():
                held += pack_record(row, ids)
                while len(held) >= BLOCK_BYTES:
                    blocks.append(deflate(bytes(held[:BLOCK_BYTES])))
                    del held[:BLOCK_BYTES]
            yield pa.RecordBatch.from_arrays([pa.array([b[:-2] for b in blocks], pa.binary())], names=["value"])
        blocks = [deflate(bytes(held[i : i + BLOCK_BYTES])) for i in range(0, len(held), BLOCK_BYTES)] + [EOF_BLOCK]
        yield pa.RecordBatch.from_arrays([pa.array([b[:-2] for b in blocks], pa.binary())], names=["value"])

    find_package(df.sparkSession)
    rows = df.select(*[F.col(n) if n in df.columns else F.lit(None).alias(n) for n in names])
    # a block ends with two bytes 0, the high ones of its length: they are the line separator
    rows.mapInArrow(run, "value binary").select(F.col("value").cast("string").alias("value")).write.option("lineSep", "\0\0").text(path)


# ---------------------------------------------------------------- range reads

#: Positions of a step of the linear index.
STEP = 1 << 14
#: Files that a range read may name one by one; beyond, all are scanned and filtered by their statistics.
MOST_FILES = 100_000


def write_indexed(alignments: DataFrame, path: str, *, key: str = "rname", s: str = "pos", e: str = "end", rows_per_file: int = 1_000_000) -> None:
    """Alignments sorted by place, in files of ``rows_per_file`` rows, and an index of them.

    The index has a row for each file, reference and STEP of starts: the least start and greatest
    end there. Rows without a place come last and are in no step. ``path`` gets data/ and index/.
    """
    spark = alignments.sparkSession
    placed = F.when(F.col(s).isNotNull() & F.col(e).isNotNull(), F.col(key))
    spot = [placed.isNull(), placed, F.col(s), F.col(e)]
    n = max(1, spark.sparkContext.defaultParallelism)
    alignments.repartitionByRange(n, *spot).sortWithinPartitions(*spot).write.option("maxRecordsPerFile", rows_per_file).parquet(f"{path}/data")
    rows = spark.read.parquet(f"{path}/data").filter(placed.isNotNull())
    steps = rows.groupBy(F.col("_metadata.file_path").alias("file"), F.col(key), F.floor(F.col(s) / STEP).alias("step")).agg(F.min(s).alias("first"), F.max(e).alias("last"), F.count(F.lit(1)).alias("rows"))
    steps.coalesce(1).sortWithinPartitions("file", key, "step").write.parquet(f"{path}/index")


def files_of(spark: SparkSession, path: str, regions: DataFrame, *, key: str = "rname", r: tuple[str, str] = ("s", "e")) -> DataFrame:
    """(file): those with a step that some region reaches."""
    steps = spark.read.parquet(f"{path}/index")
    return overlap_join(steps, regions.select(key, *r).distinct(), [key], l=("first", "last"), r=r).select("file").distinct()


def fetch(spark: SparkSession, path: str, regions: DataFrame, *, key: str = "rname", s: str = "pos", e: str = "end", r: tuple[str, str] = ("s", "e")) -> DataFrame:
    """Alignments of an indexed table that overlap some region, each once; files that the index rules out aren't read.

    regions: ``key`` and the half-open interval ``r``. File names come to the driver, MOST_FILES
    at most.
    """
    named = [x.file for x in files_of(spark, path, regions, key=key, r=r).limit(MOST_FILES + 1).collect()]
    data = spark.read.parquet(f"{path}/data")
    if not named:
        return data.filter("false")
    if len(named) <= MOST_FILES:
        data = spark.read.schema(data.schema).parquet(*named)
    return overlap_exists(data, regions.withColumnsRenamed({r[0]: "_rs", r[1]: "_re"}), [key], l=(s, e), r=("_rs", "_re"))

"""FASTQ, FASTA, SAM and GTF as DataFrames, and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lociq.functions import cigar, sequence


#: Splits of files whose line counts are broadcast, at most; beyond, they are joined by shuffle.
MOST_SPLITS = 200_000


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, start, value): lines in the order of their file's splits; gzip and bzip2 by suffix."""
    return spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value")


def _records(spark: SparkSession, path: str, size: int) -> DataFrame:
    """(file, k, base, l0 ... l[size-1]) of records of ``size`` lines; a last one with fewer lines is dropped.

    k numbers a file's records from 0, and base is how many the files before it have, by name.

    A first scan counts the lines of each split, so that the second knows which line of a
    record a split begins with. Records inside a split are put together as they are read;
    only the few lines at the borders of splits are grouped.
    """
    from lociq.plans.storage import find_package

    find_package(spark)
    if path.lower().endswith(".zip"):
        source = _zipped(spark, path)
    else:
        source = _lines(spark, path)
    counts = source.groupBy("file", "start").agg(F.count(F.lit(1)).alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = counts.select("file", "start", before.alias("offset"))
    held = counts.groupBy("file").agg(F.floor(F.sum("n") / size).alias("records"))
    bases = held.select("file", F.coalesce(F.sum("records").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    splits, files = counts.agg(F.count(F.lit(1)), F.count_distinct("file")).first()
    if splits <= MOST_SPLITS:
        placed = source.join(F.broadcast(offsets), ["file", "start"])
    else:  # a shuffled join forgets the order of lines, so it is sorted again
        numbered = source.withColumn("place", F.monotonically_increasing_id())
        placed = numbered.join(offsets.hint("merge"), ["file", "start"]).sortWithinPartitions("file", "start", "place")
    placed = placed.select("file", "start", "offset", "value")
    spec = "file string, k bigint, whole boolean, " + ", ".join(f"l{i} string" for i in range(size))
    names = ["file", "k", "whole", *(f"l{i}" for i in range(size))]

    def cut(frames):
        import pandas as pd

        now, at, parts = None, 0, {}
        for frame in frames:
            out: list[tuple] = []
            for name, start, offset, value in zip(frame["file"], frame["start"], frame["offset"], frame["value"], strict=True):
                if (name, start) != now:
                    if parts:
                        out.append((now[0], at // size, False, *(parts.get(i) for i in range(size))))
                    now, at, parts = (name, start), int(offset), {}
                parts[at % size] = value.rstrip()
                if at % size == size - 1:
                    out.append((name, at // size, len(parts) == size, *(parts.get(i) for i in range(size))))
                    parts = {}
                at += 1
            yield pd.DataFrame(out, columns=names)
        if parts:
            yield pd.DataFrame([(now[0], at // size, False, *(parts.get(i) for i in range(size)))], columns=names)

    rows = placed.mapInPandas(cut, spec)
    inner = rows.filter("whole").drop("whole")
    inner = inner.join(F.broadcast(bases) if splits <= MOST_SPLITS else bases, "file")
    if splits == files:
        return inner
    border = rows.filter("not whole").groupBy("file", "k").agg(*[F.max(f"l{i}").alias(f"l{i}") for i in range(size)]).filter(f"l{size - 1} is not null")
    return inner.unionByName(border.join(bases, "file"))


def _zipped(spark: SparkSession, path: str) -> DataFrame:
    """Lines of zip archives, which hold one text each and are read whole."""
    files = spark.read.format("binaryFile").load(path).select("path", "content")

    def cut(frames):
        import pandas as pd

        for frame in frames:
            for name, content in zip(frame["path"], frame["content"], strict=True):
                rows = open_text(name, bytes(content)).splitlines()
                yield pd.DataFrame({"file": [name] * len(rows), "start": [0] * len(rows), "value": rows})

    return files.mapInPandas(cut, "file string, start bigint, value string")


def open_text(name: str, data: bytes) -> str:
    """A file's text by its suffix: .gz or .z, .bz2, .zip (its first member), else as it is."""
    import bz2
    import gzip
    import io
    import zipfile

    low = name.lower()
    if low.endswith((".gz", ".z")):
        data = gzip.decompress(data)
    elif low.endswith(".bz2"):
        data = bz2.decompress(data)
    elif low.endswith(".zip"):
        with zipfile.ZipFile(io.BytesIO(data)) as z:
            data = z.read(z.namelist()[0])
    return data.decode()


def read_fastq(spark: SparkSession, path: str, mate: int | None = None, quality: str | None = None) -> DataFrame:
    """(frag_id, mate, qname, seq, qual, file); frag_id numbers the records from 1, over all files of a folder by name.

    Names lose @, what follows white space and the mate; a header of the later style
    (``@id N:...``) gives its mate too. ``quality`` converts the qualities to offset 33.
    """
    r = _records(spark, path, 4)
    head = F.substring("l0", 2, 1 << 20)
    told = F.coalesce(F.nullif(F.regexp_extract(head, r"^\S+/([12])(?:\s|$)", 1), F.lit("")), F.nullif(F.regexp_extract(head, r"^\S+\s([12]):", 1), F.lit(""))).cast("int")
    qual = sequence.convert_quality(F.col("l3"), quality) if quality else F.col("l3")
    return r.select((F.col("base") + F.col("k") + 1).alias("frag_id"), F.coalesce(F.lit(mate).cast("int"), told).alias("mate"), sequence.clean_name(head).alias("qname"), F.col("l1").alias("seq"), qual.alias("qual"), "file")


def read_pairs(spark: SparkSession, first: str, second: str, *, quality: str | None = None, trim5: int = 0, trim3: int = 0) -> DataFrame:
    """Both mates, trimmed; the row number in the files is the fragment's name, so both sides have their reads in one order."""
    both = read_fastq(spark, first, 1, quality).unionByName(read_fastq(spark, second, 2, quality)).drop("file")
    return both.withColumns({c: sequence.trim(F.col(c), trim5, trim3) for c in ("seq", "qual")}) if trim5 or trim3 else both


def fastq_record(name: Column, mate: Column, seq: Column, qual: Column) -> Column:
    return F.concat_ws("\n", F.concat(F.lit("@"), name, F.lit("/"), mate.cast("string")), seq, F.lit("+"), qual)


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(n, value): lines numbered from 0 over all files of a folder by name."""
    r = _records(spark, path, 1)
    return r.select((F.col("base") + F.col("k")).alias("n"), F.col("l0").alias("value"))


def write_names(reads: DataFrame, path: str) -> None:
    """The name file of normalised pairs: fragment and original name, in order."""
    lines = F.concat_ws("\t", F.col("frag_id").cast("string"), "qname").alias("value")
    reads.filter("mate = 1").orderBy("frag_id").select(lines).write.text(path)


def read_names(spark: SparkSession, path: str) -> DataFrame:
    c = F.split("value", "\t", 2)
    return spark.read.text(path).select(c[0].cast("long").alias("frag_id"), c[1].alias("qname"))


def write_fastq(reads: DataFrame, path: str, name: str = "frag_id") -> None:
    reads.orderBy("frag_id", "mate").select(fastq_record(F.col(name).cast("string"), F.col("mate"), F.col("seq"), F.col("qual")).alias("value")).write.text(path)


def interleave(reads: DataFrame, length: int) -> DataFrame:
    """Mates as single reads: the mate digit (0 or 1) before the name, cut to ``length``."""
    return reads.select(F.concat((F.col("mate") - 1).cast("string"), F.col("frag_id").cast("string")).alias("qname"), F.substring("seq", 1, length).alias("seq"), F.substring("qual", 1, length).alias("qual"))


def read_length(reads: DataFrame) -> int | None:
    """Length of one read's sequence."""
    row = reads.select(F.length("seq").alias("n")).first()
    return row.n if row else None


def read_fasta(spark: SparkSession, path: str, chunk: int = 1 << 16) -> DataFrame:
    """(chrom, chunk, seq): sequences in chunks, so that a long one is spread over rows and tasks.

    A sequence's lines may lie in several splits: segments between headers and split borders
    are summed first, and a line's place in its sequence is its segment's offset plus the
    place in the segment.
    """
    from lociq.plans.storage import find_package

    find_package(spark)

    def number(frames):
        import pandas as pd

        now, seg, at = None, 0, 0
        for frame in frames:
            out: list[tuple] = []
            for name, start, value in zip(frame["file"], frame["start"], frame["value"], strict=True):
                if (name, start) != now:
                    now, seg, at = (name, start), 0, 0
                if value.startswith(">"):
                    seg, at = seg + 1, 0
                    out.append((name, start, seg, (value[1:].split() or [""])[0], 0, ""))
                else:
                    bases = "".join(value.split())
                    out.append((name, start, seg, None, at, bases))
                    at += len(bases)
            yield pd.DataFrame(out, columns=["file", "start", "seg", "head", "at", "bases"])

    rows = _lines(spark, path).mapInPandas(number, "file string, start bigint, seg bigint, head string, at bigint, bases string")
    segments = rows.groupBy("file", "start", "seg").agg(F.max("head").alias("head"), F.sum(F.length("bases")).alias("n"))
    order = Window.partitionBy("file").orderBy("start", "seg")
    named = segments.withColumn("chrom", F.last("head", True).over(order)).withColumn("opens", F.sum(F.col("head").isNotNull().cast("int")).over(order)).filter("chrom is not null")
    before = F.coalesce(F.sum("n").over(Window.partitionBy("file", "opens").orderBy("start", "seg").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = rows.join(named.select("file", "start", "seg", "chrom", before.alias("offset")), ["file", "start", "seg"]).withColumn("at", F.col("at") + F.col("offset"))
    first, last = F.floor(F.col("at") / chunk), F.floor((F.col("at") + F.greatest(F.length("bases") - 1, F.lit(0))) / chunk)
    split = placed.withColumn("chunk", F.explode(F.sequence(first, last)))
    lo = F.greatest(F.col("chunk") * chunk - F.col("at"), F.lit(0))
    hi = F.least((F.col("chunk") + 1) * chunk - F.col("at"), F.length("bases"))
    piece = split.bases.substr(lo.cast("int") + 1, (hi - lo).cast("int"))
    return split.groupBy("chrom", "chunk").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.col("at"), F.length("bases").alias("n"), piece.alias("p")))), lambda x: x["p"]), "").alias("seq"))


def fetch(genome: DataFrame, spans: DataFrame, keys: list[str], chunk: int = 1 << 16) -> DataFrame:
    """Adds seq to spans (chrom, s, e): the pieces of all chunks a span touches, in order."""
    asked = spans.withColumn("chunk", F.explode(F.sequence(F.floor(F.col("s") / chunk), F.floor(F.greatest(F.col("e") - 1, F.col("s")) / chunk))))
    met = asked.join(genome, ["chrom", "chunk"])
    lo, hi = F.greatest(F.col("s") - F.col("chunk") * chunk, F.lit(0)), F.least(F.col("e") - F.col("chunk") * chunk, F.lit(chunk))
    piece = met.select(*keys, "chunk", met.seq.substr(lo.cast("int") + 1, F.greatest(hi - lo, F.lit(0)).cast("int")).alias("piece"))
    return piece.groupBy(*keys).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("chunk", "piece"))), lambda x: x["piece"]), "").alias("seq"))


def transcript_sequences(transcripts: DataFrame, genome: DataFrame, chunk: int = 1 << 16) -> DataFrame:
    """(tx_id, seq): exon sequences in transcript order; transcripts with a short exon or no base are left out."""
    ex = transcripts.select("tx_id", "chrom", "strand", F.posexplode("exons").alias("k", "x")).select("tx_id", "chrom", "strand", "k", F.col("x.start").alias("s"), F.col("x.end").alias("e"))
    got = fetch(genome, ex, ["tx_id", "k", "strand", "s", "e"], chunk).withColumn("whole", F.length("seq") == F.col("e") - F.col("s"))
    n = transcripts.select("tx_id", F.size("exons").alias("n"))
    joined = got.groupBy("tx_id", "strand").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("k", "seq"))), lambda x: x["seq"]), "").alias("seq"), F.bool_and("whole").alias("whole"), F.count(F.lit(1)).alias("got"))
    kept = joined.join(n, "tx_id").filter("whole and got = n").filter(sequence.has_bases(F.col("seq")))
    return kept.select("tx_id", F.when(F.col("strand") == "-", sequence.reverse_complement(F.col("seq"))).otherwise(F.col("seq")).alias("seq"))


def write_fasta(df: DataFrame, path: str, name: str = "tx_id", width: int = 50) -> None:
    df.select(F.concat(F.lit(">"), F.col(name).cast("string"), F.lit("\n"), sequence.wrap(F.col("seq"), width)).alias("value")).write.text(path)


def reference_lengths(genome: DataFrame) -> DataFrame:
    return genome.groupBy("chrom").agg(F.sum(F.length("seq")).alias("length"))


_FLAGS = {"paired": 1, "proper": 2, "unmapped": 4, "mate_unmapped": 8, "reverse": 16, "mate_reverse": 32, "first": 64, "second": 128, "secondary": 256, "qc_fail": 512, "duplicate": 1024}
_TAGS = {"XS": "string", "XC": "int", "XD": "int", "XE": "int", "AS": "int", "NH": "int", "MD": "string", "R2": "string", "Q2": "string", "HI": "int", "IH": "int", "NM": "int", "XM": "int"}


def has_flag(flag: Column, name: str) -> Column:
    return flag.bitwiseAND(_FLAGS[name]) != 0


def with_flags(flag: Column, on: list[str] = (), off: list[str] = ()) -> Column:
    for n in on:
        flag = flag.bitwiseOR(_FLAGS[n])
    for n in off:
        flag = flag.bitwiseAND(~_FLAGS[n])
    return flag


def with_tag_columns(rows: DataFrame) -> DataFrame:
    """Adds the usual tags as columns, the mate's number and the end on the reference."""
    typed = rows.withColumns({k.lower() if k != "AS" else "as_score": F.col("tags")[k].try_cast(t) for k, t in _TAGS.items()})
    return typed.withColumn("mate", F.when(has_flag(F.col("flag"), "second"), 2).otherwise(1)).withColumn("end", cigar.reference_end(F.col("pos"), F.col("cigar")))


def read_sam(spark: SparkSession, path: str, *, types: bool = False) -> DataFrame:
    """Alignments of SAM text: pos and pnext from 0, CIGAR as ops, tags as a map and the usual ones as columns.

    Of a repeated tag the last counts. With ``types`` there is tag_types as well, each tag's letter.
    """
    c = F.split("value", "\t")
    rows = spark.read.text(path).filter(~F.col("value").startswith("@")).filter("value <> ''")
    tags = F.slice(c, 12, F.greatest(F.size(c) - 11, F.lit(0)))
    last = F.filter(tags, lambda t, i: ~F.exists(F.slice(tags, i + 2, F.greatest(F.size(tags) - i - 1, F.lit(0))), lambda x: F.substring(x, 1, 2) == F.substring(t, 1, 2)))
    part = lambda at, n: F.map_from_entries(F.transform(last, lambda t: F.struct(F.substring(t, 1, 2), F.substring(t, at, n))))
    base = rows.select(c[0].alias("qname"), c[1].cast("int").alias("flag"), F.nullif(c[2], F.lit("*")).alias("rname"), (c[3].cast("int") - 1).alias("pos"), c[4].cast("int").alias("mapq"), cigar.parse(c[5]).alias("cigar"),
        F.when(c[6] == "=", c[2]).otherwise(F.nullif(c[6], F.lit("*"))).alias("rnext"), (c[7].cast("int") - 1).alias("pnext"), c[8].cast("int").alias("tlen"), c[9].alias("seq"), c[10].alias("qual"),
        part(6, 1 << 20).alias("tags"), *([part(4, 1).alias("tag_types")] if types else []))
    return with_tag_columns(base)


def sam_header(lengths: DataFrame, order: str = "unsorted") -> DataFrame:
    """(value): the header lines of references (chrom, length), by name."""
    first = lengths.sparkSession.createDataFrame([(f"@HD\tVN:1.6\tSO:{order}",)], "value string").coalesce(1)
    refs = lengths.orderBy("chrom").select(F.concat(F.lit("@SQ\tSN:"), F.col("chrom").cast("string"), F.lit("\tLN:"), F.col("length").cast("string")).alias("value"))
    return first.unionAll(refs)


def write_sam(df: DataFrame, path: str, lengths: DataFrame | None = None) -> None:
    """SAM lines; a missing value is *. With ``lengths`` (chrom, length) the first files hold the header.

    A tag's type is that of tag_types, where there is such a column, else i for whole numbers and Z.
    """
    star = lambda c: F.coalesce(c, F.lit("*"))
    guess = lambda t: F.when(t["value"].rlike("^-?[0-9]+$"), F.lit("i")).otherwise(F.lit("Z"))
    kind = (lambda t: F.coalesce(F.col("tag_types")[t["key"]], guess(t))) if "tag_types" in df.columns else guess
    tags = F.array_join(F.transform(F.map_entries("tags"), lambda t: F.concat(t["key"], F.lit(":"), kind(t), F.lit(":"), t["value"])), "\t")
    ops = cigar.render(F.col("cigar"))
    cells = [F.col("qname"), F.col("flag").cast("string"), star(F.col("rname")), (F.col("pos") + 1).cast("string"), F.col("mapq").cast("string"), F.when(F.size("cigar") > 0, ops).otherwise("*"), F.when(F.col("rnext") == F.col("rname"), "=").otherwise(star(F.col("rnext"))), (F.col("pnext") + 1).cast("string"), F.col("tlen").cast("string"), F.col("seq"), F.col("qual"), F.nullif(tags, F.lit(""))]
    rows = df.select(F.concat_ws("\t", *cells).alias("value"))
    (sam_header(lengths).unionAll(rows) if lengths is not None else rows).write.text(path)


def primary(alignments: DataFrame, keys: list[str]) -> DataFrame:
    """Each read's mapped alignments that aren't secondary; a read without one has its unmapped rows."""
    un = has_flag(F.col("flag"), "unmapped")
    kind = F.when(un, 1).when(~has_flag(F.col("flag"), "secondary"), 0).otherwise(2)
    ranked = alignments.withColumn("_kind", kind).withColumn("_best", F.min("_kind").over(Window.partitionBy(*keys)))
    return ranked.filter("_kind = _best and _kind < 2").drop("_kind", "_best")


def read_gtf(spark: SparkSession, path: str) -> DataFrame:
    """GTF rows: start from 0, a score of . as 0, any other strand than + and - as ., attributes as a map (the last of a tag counts)."""
    c = F.split("value", "\t")
    rows = spark.read.text(path).filter("trim(value) <> ''").filter(~F.col("value").startswith("#"))
    pairs = F.arrays_zip(F.regexp_extract_all(c[8], F.lit(r'(\S+)\s+"([^"]*)"'), 1).alias("k"), F.regexp_extract_all(c[8], F.lit(r'(\S+)\s+"([^"]*)"'), 2).alias("v"))
    attrs = F.aggregate(pairs, F.create_map().cast("map<string,string>"), lambda m, p: F.map_concat(F.map_filter(m, lambda k, v: k != p["k"]), F.create_map(p["k"], p["v"])))
    return rows.select(c[0].alias("seqid"), c[1].alias("source"), c[2].alias("feature_type"), (c[3].cast("int") - 1).alias("start"), c[4].cast("int").alias("end"), F.when(c[5] == ".", 0.0).otherwise(F.expr("try_cast(split(value, '\t')[5] as double)")).alias("score"), F.when(c[6].isin("+", "-"), c[6]).otherwise(".").alias("strand"), c[7].alias("phase"), attrs.alias("attrs"))


def write_gtf(df: DataFrame, path: str, compression: str = "none") -> None:
    """Ordered by seqid, start, and type from last to first; ``compression`` is gzip or another that readers tell by the suffix."""
    attrs = F.array_join(F.transform(F.array_sort(F.map_entries("attrs")), lambda a: F.concat(a["key"], F.lit(' "'), a["value"], F.lit('";'))), " ")
    line = F.concat_ws("\t", "seqid", "source", "feature_type", (F.col("start") + 1).cast("string"), F.col("end").cast("string"), F.col("score").cast("string"), "strand", F.coalesce("phase", F.lit(".")), attrs)
    df.orderBy("seqid", "start", F.desc("feature_type")).select(line.alias("value")).write.text(path, compression=compression)


def gtf_transcripts(gtf: DataFrame, source: str | None = None) -> DataFrame:
    """Transcripts of the exon rows by (seqid, transcript_id)."""
    from lociq.sources.tables import number

    a = F.col("attrs")
    ex = gtf.filter("feature_type = 'exon'").withColumn("name", a["transcript_id"])
    exons = F.array_sort(F.collect_set(F.struct("start", "end")))
    first = lambda c: F.coalesce(F.min(c), F.lit("na"))
    t = ex.groupBy(F.col("seqid").alias("chrom"), "name").agg(F.min("strand").alias("strand"), exons.alias("exons"), first(a["gene_biotype"]).alias("gene_biotype"), first(a["gene_name"]).alias("gene"), F.min(F.lit(source) if source else F.col("source")).alias("src"))
    return number(t.select("chrom", F.get("exons", F.lit(0))["start"].alias("tx_start"), F.element_at("exons", -1)["end"].alias("tx_end"), F.lit(-1).alias("cluster_id"), "strand", F.size("exons").alias("exon_count"), "exons", "gene_biotype", F.array("name").alias("tx_names"), F.array("gene").alias("gene_names"), F.array("src").alias("annotation_sources")))

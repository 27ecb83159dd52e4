"""Schemas and tab-separated sources and sinks: transcripts, clusters, pairs, chimeras, insert sizes, lists.

Arrays are comma-joined text: with a trailing comma in transcript rows, without one elsewhere.
Missing names are ``na``. Rows are parsed by JVM-side expressions, so columns that a query
doesn't use are not split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_EXONS = "array<struct<start:int,end:int>>"
TRANSCRIPTS = "chrom string, tx_start int, tx_end int, tx_id bigint, cluster_id int, strand string, exon_count int, exons array<struct<start:int,end:int>>, gene_biotype string, tx_names array<string>, gene_names array<string>, annotation_sources array<string>"
CLUSTERS = "rname string, start int, end int, cluster_id int, strand string, orientation int, exons array<struct<start:int,end:int>>, concordant_frags int, qnames array<string>, unpaired_qnames array<string>"
PAIRS = "pair_id int, id5p int, id3p int, qnames array<string>, spanning_qnames array<string>"
# The header of a chimera report, in its order.
CHIMERAS = """rname5p string, start5p int, end5p int, rname3p string, start3p int, end3p int, chimera_id string, num_frags int,
strand5p string, strand3p string, chimera_type string, distance bigint, num_discordant_frags int, num_spanning_frags int,
num_discordant_frags_5p int, num_discordant_frags_3p int, num_concordant_frags_5p int, num_concordant_frags_3p int,
biotypes_5p array<string>, biotypes_3p array<string>, genes_5p array<string>, genes_3p array<string>, transcripts_5p array<string>, transcripts_3p array<string>"""


def fields(ddl: str) -> list[tuple[str, str]]:
    return [tuple(x.strip().split(" ", 1)) for x in ddl.replace("\n", " ").replace("array<struct<start:int,end:int>>", _EXONS.replace(",", ";")).split(", ")]


def lines(spark: SparkSession, path: str, comment: str | None = "#") -> DataFrame:
    """(value) of the non-blank lines; gzip and bzip2 are read by suffix."""
    out = spark.read.text(path).filter("trim(value) <> ''")
    return out.filter(~F.col("value").startswith(comment)) if comment else out


def listed(text: Column) -> Column:
    """Comma-joined text as an array without empty items."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), ","), lambda x: x != "")


def joined(items: Column, trailing: bool = False) -> Column:
    text = F.array_join(items.cast("array<string>"), ",")
    return F.when(F.size(items) > 0, F.concat(text, F.lit(","))).otherwise(F.lit("")) if trailing else text


def _ints(text: Column) -> Column:
    return F.transform(listed(text), lambda x: x.cast("int"))


def _zip(starts: Column, ends: Column) -> Column:
    return F.zip_with(starts, ends, lambda a, b: F.struct(a.alias("start"), b.alias("end")))


def _edges(exons: Column, field: str, trailing: bool = False) -> Column:
    return joined(F.transform(exons, lambda x: x[field]), trailing)


def _columns(df: DataFrame, n: int) -> list[Column]:
    parts = F.split("value", "\t", -1)
    return [F.get(parts, F.lit(i)) for i in range(n)]


def read_transcripts(spark: SparkSession, path: str) -> DataFrame:
    df = lines(spark, path)
    c = _columns(df, 13)
    return df.select(c[0].alias("chrom"), *[c[i].cast(t).alias(n) for i, n, t in ((1, "tx_start", "int"), (2, "tx_end", "int"), (3, "tx_id", "bigint"), (4, "cluster_id", "int"))], c[5].alias("strand"), c[6].cast("int").alias("exon_count"), _zip(_ints(c[7]), _ints(c[8])).alias("exons"), c[9].alias("gene_biotype"), *[listed(c[i]).alias(n) for i, n in ((10, "tx_names"), (11, "gene_names"), (12, "annotation_sources"))])


def write_transcripts(df: DataFrame, path: str, compression: str = "none") -> None:
    """Ordered by chromosome and start; ``compression`` is gzip or another that readers tell by the suffix."""
    cells = [*[F.col(c).cast("string") for c in ("chrom", "tx_start", "tx_end", "tx_id", "cluster_id", "strand")], F.size("exons").cast("string"), _edges(F.col("exons"), "start", True), _edges(F.col("exons"), "end", True), F.col("gene_biotype"), *[joined(F.col(c), True) for c in ("tx_names", "gene_names", "annotation_sources")]]
    df.orderBy("chrom", "tx_start", "tx_id").select(F.concat_ws("\t", *[F.coalesce(x, F.lit("")) for x in cells]).alias("value")).write.text(path, compression=compression)


def read_genepred(spark: SparkSession, path: str, source: str = "na") -> DataFrame:
    """GenePred rows as transcripts; tx_id numbers them from 1 by place."""
    df = lines(spark, path)
    c = _columns(df, 11)
    return number(df.select(c[1].alias("chrom"), c[3].cast("int").alias("tx_start"), c[4].cast("int").alias("tx_end"), F.lit(-1).alias("cluster_id"), c[2].alias("strand"), c[7].cast("int").alias("exon_count"), _zip(_ints(c[8]), _ints(c[9])).alias("exons"), F.lit("na").alias("gene_biotype"), F.array(c[0]).alias("tx_names"), F.array(F.coalesce(c[10], F.lit("na"))).alias("gene_names"), F.array(F.lit(source)).alias("annotation_sources")))


def read_bed12(spark: SparkSession, path: str, source: str = "na") -> DataFrame:
    """BED12 rows as transcripts: blocks become exons."""
    df = lines(spark, path).filter(~F.col("value").rlike("^(track|browser)"))
    c = _columns(df, 12)
    start = c[1].cast("int")
    exons = F.zip_with(_ints(c[11]), _ints(c[10]), lambda s, n: F.struct((start + s).alias("start"), (start + s + n).alias("end")))
    return number(df.select(c[0].alias("chrom"), start.alias("tx_start"), c[2].cast("int").alias("tx_end"), F.lit(-1).alias("cluster_id"), c[5].alias("strand"), c[9].cast("int").alias("exon_count"), exons.alias("exons"), F.lit("na").alias("gene_biotype"), F.array(c[3]).alias("tx_names"), F.array(c[3]).alias("gene_names"), F.array(F.lit(source)).alias("annotation_sources")))


def write_genepred(df: DataFrame, path: str) -> None:
    cells = [F.get("tx_names", F.lit(0)), F.col("chrom"), F.col("strand"), *[F.col(c).cast("string") for c in ("tx_start", "tx_end", "tx_start", "tx_end")], F.size("exons").cast("string"), _edges(F.col("exons"), "start", True), _edges(F.col("exons"), "end", True), F.get("gene_names", F.lit(0))]
    df.select(F.concat_ws("\t", *[F.coalesce(x, F.lit("")) for x in cells]).alias("value")).write.text(path)


def number(df: DataFrame) -> DataFrame:
    """tx_id from 1 in the order of places, a null chromosome first; no task sorts all rows."""
    from lociq.operators.cluster import numbered

    order = ["tx_start", "tx_end", "strand", "tx_names", "exons"]
    every = numbered(df.drop("tx_id"), "chrom", order, "tx_id").withColumn("tx_id", (F.col("tx_id") + 1).cast("bigint"))
    return every.select(*[n for n, _ in fields(TRANSCRIPTS)])


def read_clusters(spark: SparkSession, path: str) -> DataFrame:
    df = lines(spark, path)
    c = _columns(df, 14)
    return df.select(c[0].alias("rname"), *[c[i].cast("int").alias(n) for i, n in ((1, "start"), (2, "end"), (3, "cluster_id"))], c[4].alias("strand"), c[5].cast("int").alias("orientation"), _zip(_ints(c[7]), _ints(c[8])).alias("exons"), c[11].cast("int").alias("concordant_frags"), listed(c[12]).alias("qnames"), listed(c[13]).alias("unpaired_qnames"))


def write_clusters(df: DataFrame, path: str) -> None:
    cells = [*[F.col(c).cast("string") for c in ("rname", "start", "end", "cluster_id", "strand", "orientation")], F.size("exons").cast("string"), _edges(F.col("exons"), "start"), _edges(F.col("exons"), "end"), F.size("qnames").cast("string"), F.size("unpaired_qnames").cast("string"), F.col("concordant_frags").cast("string"), joined(F.col("qnames")), joined(F.col("unpaired_qnames"))]
    df.select(F.concat_ws("\t", *[F.coalesce(x, F.lit("")) for x in cells]).alias("value")).write.text(path)


def read_pairs(spark: SparkSession, path: str) -> DataFrame:
    """Cluster pairs; a missing fifth column is an empty list."""
    df = lines(spark, path)
    c = _columns(df, 5)
    return df.select(*[c[i].cast("int").alias(n) for i, n in enumerate(("pair_id", "id5p", "id3p"))], listed(c[3]).alias("qnames"), listed(c[4]).alias("spanning_qnames"))


def write_pairs(df: DataFrame, path: str) -> None:
    cells = [*[F.col(c).cast("string") for c in ("pair_id", "id5p", "id3p")], joined(F.col("qnames")), *([joined(F.col("spanning_qnames"))] if "spanning_qnames" in df.columns else [])]
    df.orderBy("pair_id").select(F.concat_ws("\t", *cells).alias("value")).write.text(path)


def read_chimeras(spark: SparkSession, path: str) -> DataFrame:
    df = lines(spark, path)
    spec = fields(CHIMERAS)
    return df.select(*[(listed(c) if t.startswith("array") else c.cast(t)).alias(n) for c, (n, t) in zip(_columns(df, len(spec)), spec, strict=True)])


def _headed(spark: SparkSession, header: str, rows: DataFrame) -> DataFrame:
    """(value) with the header as the first file's first line."""
    return spark.createDataFrame([(header,)], "value string").coalesce(1).unionAll(rows)


def write_chimeras(df: DataFrame, path: str) -> None:
    """The first file is headed by the commented column names."""
    spec = fields(CHIMERAS)
    cells = [joined(F.col(n)) if t.startswith("array") else F.coalesce(F.col(n).cast("string"), F.lit("")) for n, t in spec]
    _headed(df.sparkSession, "#" + "\t".join(n for n, _ in spec), df.select(F.concat_ws("\t", *cells).alias("value"))).write.text(path)


def read_insert_sizes(spark: SparkSession, path: str) -> DataFrame:
    df = lines(spark, path)
    c = _columns(df, 2)
    return df.select(c[0].cast("int").alias("isize"), c[1].cast("bigint").alias("num_samples"))


def write_insert_sizes(df: DataFrame, path: str) -> None:
    lines_ = df.orderBy("isize").select(F.concat_ws("\t", F.col("isize").cast("string"), F.col("num_samples").cast("string")).alias("value"))
    _headed(df.sparkSession, "#insert_size\tnum_samples", lines_).write.text(path)


def read_list(spark: SparkSession, path: str) -> DataFrame:
    """(value): distinct trimmed lines of a mask."""
    return lines(spark, path).select(F.trim("value").alias("value")).distinct()


def read_expression(spark: SparkSession, path: str) -> DataFrame:
    """(tracking_id, fpkm) by header."""
    return spark.read.option("header", True).option("sep", "\t").csv(path).select("tracking_id", F.col("FPKM").cast("double").alias("fpkm"))


def read_fusion_spec(spark: SparkSession, path: str) -> DataFrame:
    df = lines(spark, path)
    c = _columns(df, 7)
    return df.select(c[0].alias("tx5p"), c[1].cast("int").alias("start5p"), c[2].cast("int").alias("end5p"), c[3].alias("tx3p"), c[4].cast("int").alias("start3p"), c[5].cast("int").alias("end3p"), c[6].cast("double").alias("fpkm"))


def read_false_positives(spark: SparkSession, path: str) -> DataFrame:
    df = lines(spark, path)
    c = _columns(df, 4)
    return df.select(c[0].alias("tx_name_5p"), c[1].cast("int").alias("end5p"), c[2].alias("tx_name_3p"), c[3].cast("int").alias("start3p"))


def scrape_metric(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    """(value): the whole number that a log line names, by a pattern with one group."""
    return spark.read.text(path).select(F.regexp_extract("value", pattern, 1).alias("v")).filter("v <> ''").select(F.col("v").cast("bigint").alias("value"))

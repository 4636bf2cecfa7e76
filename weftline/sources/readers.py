"""Readers of the text formats records come in. Each gives a typed DataFrame; a bad cast is null, never an error."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.ids import canonical_id, valid_id
from ..operators.audit import number_in_place
from ..operators.validate import duplicate_keys, require


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def or_empty(spark: SparkSession, path: str, schema, read) -> DataFrame:
    """read(path), or no rows of the schema where the path does not exist."""
    return read(path) if exists(spark, path) else spark.createDataFrame([], schema)


def read_tsv(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """Tab-separated with a header; quotes are doubled inside quotes; an empty field is null. All strings without a schema."""
    r = spark.read.option("sep", "\t").option("header", "true").option("escape", '"').option("multiLine", "true").option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false")
    return (r.schema(schema) if schema else r).csv(path)


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """Comma-separated with `#` comment lines, a byte order mark or not; column names in upper case, all strings."""
    df = spark.read.option("comment", "#").option("header", "true").option("escape", '"').csv(path)
    return df.toDF(*(c.lstrip("﻿").strip().upper() for c in df.columns))


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """(row_index, id): one id a line in file order, blank lines aside. File order is kept for one file."""
    lines = spark.read.text(path).filter(F.trim("value") != "").select(F.trim("value").alias("id"))
    return number_in_place(lines).select("row_index", "id")


def read_fasta(spark: SparkSession, path: str, check: bool = True) -> DataFrame:
    """(id, sequence): id is the header's first word with its entry in upper case; lines are joined, blanks removed.

    With check a malformed or a repeated id raises ValueError; text before a file's first header is a malformed id.
    """
    # one row a record; only the first of a file keeps its mark
    text = F.regexp_replace("value", r"^\s*>", "")
    cut = F.split(text, "\n", 2)
    rows = spark.read.option("lineSep", "\n>").text(path).filter(F.trim(F.translate("value", "\r\n", "  ")) != "")
    rows = rows.select(F.split(F.trim(cut[0]), r"\s+")[0].alias("id"), F.regexp_replace(F.coalesce(F.get(cut, F.lit(1)), F.lit("")), r"\s+", "").alias("sequence"))
    if check:
        require(rows.filter(~valid_id("id")).select("id"), "malformed FASTA id")
    rows = rows.select(canonical_id("id").alias("id"), "sequence")
    if check:
        require(duplicate_keys(rows, "id").select("id"), "repeated FASTA id")
    return rows


HITS = ("query_id", "target_id", "fident", "alnlen", "qcov", "tcov", "evalue", "bits", "qtmscore", "ttmscore")


def read_hits(spark: SparkSession, path: str, missing_ok: bool = True) -> DataFrame:
    """Pairwise hits without a header: eight columns, ten with structure scores. Rows of fewer than eight or with a field that is no number drop out."""
    cols = F.split("value", "\t")
    numbers = [F.get(cols, F.lit(i)).try_cast("double").alias(n) for i, n in enumerate(HITS) if i > 1]
    schema = ", ".join([f"{n} string" for n in HITS[:2]] + [f"{n} double" for n in HITS[2:]])
    if missing_ok and not exists(spark, path):
        return spark.createDataFrame([], schema)
    rows = spark.read.text(path).filter(F.size(cols) >= 8).select(cols[0].alias(HITS[0]), cols[1].alias(HITS[1]), *numbers)
    return rows.filter(F.col("fident").isNotNull() & F.col("qcov").isNotNull() & F.col("tcov").isNotNull())


def read_clusters(spark: SparkSession, path: str, strict: bool = False) -> DataFrame:
    """(rep, member) rows without a header. A row of one column drops out, or with strict raises ValueError."""
    cols = F.split("value", "\t")
    lines = spark.read.text(path).filter(F.trim("value") != "")
    if strict:
        require(lines.filter(F.size(cols) < 2), "short cluster row")
    return lines.filter(F.size(cols) >= 2).select(cols[0].alias("rep"), cols[1].alias("member"))


def read_topologies(spark: SparkSession, path: str) -> DataFrame:
    """(domain, topology) of a domain list: class, architecture and topology joined by "."; comments and short rows drop out."""
    cols = F.split(F.trim("value"), r"\s+")
    lines = spark.read.text(path).filter((F.trim("value") != "") & ~F.trim("value").startswith("#") & (F.size(cols) >= 4))
    return lines.select(F.lower(cols[0]).alias("domain"), F.array_join(F.slice(cols, 2, 3), ".").alias("topology"))


def read_header_keys(spark: SparkSession, data: str, index: str) -> DataFrame:
    """(key, id) of a header file with an index of (key, offset, length): the first word of the entry at each offset, its entry in upper case.

    Entries end with a null byte. Spark reads them as lines of the one file, wherever it lies; their offsets are running sums of lengths, within a
    scan's partition and over partitions, and meet the index by a join. An offset where no entry starts, a malformed
    and a repeated id raise ValueError.
    """
    cols = F.split(F.trim("value"), r"\s+")
    rows = spark.read.text(index).filter(F.trim("value") != "").select(cols[0].alias("key"), cols[1].cast("long").alias("offset"))
    at = spark.read.option("lineSep", "\0").text(data).select("value", (F.octet_length("value") + 1).cast("long").alias("size"), F.monotonically_increasing_id().alias("at")).withColumn("part", F.shiftright("at", 33))
    before = at.groupBy("part").agg(F.sum("size").alias("n")).select("part", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    inside = F.coalesce(F.sum("size").over(Window.partitionBy("part").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    entries = at.withColumn("inside", inside).join(F.broadcast(before), "part").select((F.col("inside") + F.col("base")).alias("offset"), F.split(F.trim(F.translate("value", "\n\r\t", "   ")), " ")[0].alias("id"))
    require(rows.join(entries, "offset", "left_anti"), "no header at offset")
    keys = rows.join(entries, "offset").select("key", "id")
    require(keys.filter(~valid_id("id")), "malformed header id")
    keys = keys.select("key", canonical_id("id").alias("id"))
    require(duplicate_keys(keys, "id"), "repeated header id")
    return keys


def checksums(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """(path, bytes, sha256) of every file below path."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(path)
    return files.select("path", F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))

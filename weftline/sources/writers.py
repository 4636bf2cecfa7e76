"""Writers: text, FASTA, and Parquet in row order, through Spark's own committers."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.audit import number_rows


def write_tsv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Tab-separated with a header; quotes doubled; null as an empty field."""
    df.write.mode(mode).option("sep", "\t").option("header", "true").option("escape", '"').option("quoteAll", "false").option("emptyValue", "").option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false").csv(path)


def write_fasta(df: DataFrame, path: str, id_: str, sequence: str | Column, mode: str = "overwrite") -> None:
    """`>id`, then the sequence on one line. Rows without id or sequence are left out."""
    seq = F.col(sequence) if isinstance(sequence, str) else sequence
    df.filter(F.col(id_).isNotNull() & seq.isNotNull()).select(F.concat(F.lit(">"), F.col(id_), F.lit("\n"), seq).alias("value")).write.mode(mode).text(path)


def write_fasta_shards(df: DataFrame, path: str, id_: str, sequence: str, per_shard: int = 50_000) -> DataFrame:
    """Blocks of so many records in id order, one folder a block. Returns (row_index, id, shard)."""
    n = number_rows(df.filter(F.col(id_).isNotNull()).select(id_, sequence), [id_, sequence]).withColumn("shard", F.floor(F.col("row_index") / per_shard))
    n.select("shard", F.concat(F.lit(">"), F.col(id_), F.lit("\n"), F.col(sequence)).alias("value")).write.mode("overwrite").partitionBy("shard").text(path)
    return n.select("row_index", id_, "shard")


def write_split(df: DataFrame, path: str, as_text: bool = False, order: str = "row_index") -> None:
    """Zstandard Parquet in the order of `order`: files follow one another in name order. as_text writes every column as a string, null as ""."""
    ordered = df.repartitionByRange(order).sortWithinPartitions(order)
    out = ordered.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in df.columns)) if as_text else ordered
    out.write.mode("overwrite").option("compression", "zstd").parquet(path)


def schema_text(df: DataFrame) -> str:
    """The schema as indented JSON."""
    return json.dumps(df.schema.jsonValue(), indent=2)


def write_report(spark, path: str, report: dict) -> None:
    """A small JSON report, with the Spark version, written under another name and then renamed."""
    jvm, text = spark._jvm, json.dumps({**report, "spark": spark.version}, indent=2, sort_keys=True) + "\n"
    fs = jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    part = jvm.org.apache.hadoop.fs.Path(path + ".part")
    out = fs.create(part, True)
    out.write(bytearray(text.encode()))
    out.close()
    fs.delete(jvm.org.apache.hadoop.fs.Path(path), False)
    fs.rename(part, jvm.org.apache.hadoop.fs.Path(path))

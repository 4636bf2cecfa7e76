"""Releases: gates, staged folders with checksums, and files that travel with them."""

from __future__ import annotations

import json
import os
import shutil
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.validate import require
from .readers import checksums, exists
from .writers import schema_text, write_split


def read_json(spark: SparkSession, path: str) -> dict:
    """A small JSON file; a missing one raises FileNotFoundError."""
    if not exists(spark, path):
        raise FileNotFoundError(path)
    return json.loads("\n".join(r[0] for r in spark.read.text(path).collect()))


def gate(**passed: bool) -> None:
    """Raises ValueError that names the gates which did not pass."""
    failed = [k for k, ok in passed.items() if not ok]
    if failed:
        raise ValueError(f"release gates failed: {', '.join(failed)}")


def sums_file(spark: SparkSession, path: str) -> DataFrame:
    """(line) of a checksum manifest over every data file below path: digest, two blanks, name relative to path."""
    root = path.rstrip("/") + "/"
    inside = F.substr("path", F.instr("path", root) + len(root))
    return checksums(spark, path).filter(~F.col("path").endswith(".crc")).select(F.concat("sha256", F.lit("  "), inside).alias("line")).orderBy("line")


def stage(spark: SparkSession, frames: dict[str, DataFrame], path: str, card: str = "", gates: dict[str, bool] | None = None, as_text: bool = True, order: str = "row_index") -> None:
    """Writes every frame in its row order below path with a schema, a card and a checksum manifest.

    Everything goes to `<path>.part`, which takes the place of path only when it is complete. A failed gate or write leaves path as it was.
    """
    gate(**(gates or {}))
    jvm = spark._jvm
    part, final, old = (jvm.org.apache.hadoop.fs.Path(path.rstrip("/") + end) for end in (".part", "", ".old"))
    fs = final.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.delete(part, True)
    here = str(part.toString())
    for name, df in frames.items():
        write_split(df, f"{here}/{name}", as_text, order)

    def put(name: str, text: str) -> None:
        out = fs.create(jvm.org.apache.hadoop.fs.Path(f"{here}/{name}"), True)
        out.write(bytearray(text.encode()))
        out.close()

    put("README.md", card)
    put("schema.json", json.dumps({n: json.loads(schema_text(df)) for n, df in frames.items()}, indent=2))
    put("SHA256SUMS", "".join(r["line"] + "\n" for r in sums_file(spark, here).toLocalIterator()))
    fs.delete(old, True)
    if fs.exists(final):
        fs.rename(final, old)
    fs.rename(part, final)
    fs.delete(old, True)


def copy_files(paths: DataFrame, target: str, path: str = "path", name: str = "name") -> int:
    """Copies the files of (path, name) rows below target, a folder all executors share; returns their number.

    Every path is copied once. Files that are not there raise ValueError with the first few.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        os.makedirs(target, exist_ok=True)
        for pdf in batches:
            done = []
            for p, n in zip(pdf[path], pdf[name]):
                there = os.path.isfile(p)
                if there:
                    shutil.copyfile(p, os.path.join(target, n) + ".part")
                    os.replace(os.path.join(target, n) + ".part", os.path.join(target, n))
                done.append((p, there))
            yield pd.DataFrame(done, columns=["path", "there"])

    rows = paths.select(path, name).distinct().mapInPandas(run, "path string, there boolean").persist()
    try:
        require(rows.filter("not there").select("path"), "missing files")
        return rows.count()
    finally:
        rows.unpersist()

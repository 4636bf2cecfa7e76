"""Inventories in pages and files by fetch: the transport is passed in, so that it can be replaced."""

from __future__ import annotations

import gzip
import hashlib
import os
import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.sequences import shard_path
from ..operators.audit import number_rows
from ..operators.validate import duplicate_keys, missing_keys
from ..session import Scratch


def retry(call: Callable, tries: int = 5, wait: float = 1.0, sleep: Callable = time.sleep):
    """call() until it does not raise, waiting wait * 2**n after try n; the last error is raised."""
    for n in range(tries):
        try:
            return call()
        except Exception:
            if n + 1 == tries:
                raise
            sleep(wait * 2**n)


def discover(spark: SparkSession, page: Callable[[int, int], tuple[int, list[str]]], page_size: int = 10_000, tries: int = 5, wait: float = 1.0) -> DataFrame:
    """(pdb_id) of a paged service, upper case, each once. page(start, rows) gives (total, ids); pages are fetched by tasks
    into a table of the shared folder, which is checked and returned.

    A total that changes between pages, and an incomplete or repeated inventory, raise ValueError.
    """
    total, _ = retry(lambda: page(0, 1), tries, wait)
    starts = spark.range(0, total, page_size).withColumnRenamed("id", "start").repartition(max(1, min(total // page_size + 1, spark.sparkContext.defaultParallelism)))

    def fetch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for start in pdf["start"]:
                now, ids = retry(lambda s=start: page(int(s), page_size), tries, wait)
                yield pd.DataFrame({"pdb_id": [i.upper() for i in ids], "total": now})

    rows = Scratch(spark, "inventory").write(starts.mapInPandas(fetch, "pdb_id string, total long"))
    seen = rows.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("pdb_id").alias("ids"), F.count_if(F.col("total") != total).alias("changed")).first()
    if seen["changed"]:
        raise ValueError("the inventory's size changed between pages")
    if seen["n"] != seen["ids"]:
        raise ValueError("the inventory repeats an id")
    if seen["n"] != total:
        raise ValueError(f"incomplete inventory: {seen['n']} of {total}")
    return rows.select("pdb_id")


def _readable(path: str) -> bool:
    try:
        with gzip.open(path, "rb") as f:
            ok = f.read(5) == b"data_"
            while f.read(1 << 20):
                pass
            return ok
    except (OSError, EOFError):
        return False


def fetch_one(id_: str, path: str, get: Callable[[str], bytes], tries: int = 5, wait: float = 1.0) -> tuple[str, str, int, str]:
    """(id, status, bytes, sha256): a readable file is kept, any other fetched anew and renamed into place; an error is a status."""
    try:
        status = "cached"
        if not _readable(path):
            if os.path.exists(path):
                os.remove(path)
            os.makedirs(os.path.dirname(path), exist_ok=True)

            def load():
                with open(path + ".part", "wb") as f:
                    f.write(get(id_))
                if not _readable(path + ".part"):
                    raise ValueError("not a readable structure file")
                os.replace(path + ".part", path)

            retry(load, tries, wait)
            status = "downloaded"
        h, n = hashlib.sha256(), 0
        with open(path, "rb") as f:
            while block := f.read(1 << 20):
                h.update(block)
                n += len(block)
        return id_, status, n, h.hexdigest()
    except Exception as e:  # noqa: BLE001 - the status carries it
        return id_, f"error:{type(e).__name__}", 0, ""


def shard_rows(ids: DataFrame, shards: int, index: int, limit: int | None = None, key: str = "pdb_id") -> DataFrame:
    """Every shards-th id in id order from index on; a limit counts before that."""
    n = number_rows(ids.select(key), [key])
    n = n if limit is None else n.filter(F.col("row_index") < limit)
    return n.filter(F.pmod("row_index", F.lit(shards)) == index).select(key)


def download(ids: DataFrame, root: str, get: Callable[[str], bytes], key: str = "pdb_id", tries: int = 5, wait: float = 1.0) -> DataFrame:
    """(pdb_id, status, bytes, sha256) of fetching every id below root, a folder all executors share."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame([fetch_one(i, p, get, tries, wait) for i, p in zip(pdf[key], pdf["path"])], columns=["pdb_id", "status", "bytes", "sha256"])

    return ids.select(key, shard_path(root, key).alias("path")).mapInPandas(run, "pdb_id string, status string, bytes long, sha256 string")


def verify(ids: DataFrame, log: DataFrame, key: str = "pdb_id", shown: int = 20) -> dict:
    """What a download log (pdb_id, status) lacks of the ids, has beyond them, repeats and reports as failed: counts and a few examples each."""
    want, got = ids.select(F.upper(key).alias(key)).distinct(), log.select(F.upper(key).alias(key), "status")
    failed = got.filter(~F.coalesce(F.col("status").isin("ok", "cached", "downloaded"), F.lit(False))).select(key).unionByName(duplicate_keys(got, key).select(key))
    parts = {"missing": missing_keys(want, got, key), "extra": missing_keys(got, want, key), "failure": failed}
    out = {"source_ids": want.count(), "logged_ids": got.select(key).distinct().count()}
    for name, df in parts.items():
        out[f"{name}_count"], out[f"{name}_examples"] = df.count(), [r[0] for r in df.orderBy(key).limit(shown).collect()]
    return out | {"status": "failed" if any(out[f"{n}_count"] for n in parts) else "passed"}


def opened(base: str) -> Callable[[str], bytes]:
    """get for download: the gzipped file of an id below a base address."""
    def get(id_: str) -> bytes:
        import urllib.request

        with urllib.request.urlopen(f"{base.rstrip('/')}/{id_.lower()}.cif.gz", timeout=120) as r:
            return r.read()

    return get


def posted(url: str, query: dict) -> Callable[[int, int], tuple[int, list[str]]]:
    """page for discover: a search service that takes a JSON query with request_options.paginate and gives total_count and result_set."""
    def page(start: int, rows: int) -> tuple[int, list[str]]:
        import json
        import urllib.request

        options = query.get("request_options", {}) | {"paginate": {"start": start, "rows": rows}}
        request = urllib.request.Request(url, json.dumps(query | {"request_options": options}).encode(), {"Content-Type": "application/json"})
        with urllib.request.urlopen(request, timeout=120) as r:
            found = json.load(r)
        return found["total_count"], [x["identifier"] for x in found.get("result_set", [])]

    return page

"""Structure files: a tokenizer for the dictionary format, run in tasks over whole files."""

from __future__ import annotations

import gzip
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.sequences import best_float, method_category, one_letter_length

_TOKEN = re.compile(r"^;(.*?)\n;(?=\s|$)|'(.*?)'(?=\s|$)|\"(.*?)\"(?=\s|$)|(#[^\n]*)|(\S+)", re.S | re.M)


def parse(text: str) -> dict[str, list[str]]:
    """Each item's values as a list: quoted words, semicolon blocks, loops and single values. Later blocks add to earlier ones."""
    tokens = [(m[5] if m[5] is not None else next(g for g in m.groups()[:3] if g is not None), m[5] is not None) for m in _TOKEN.finditer(text) if m[4] is None]
    out: dict[str, list[str]] = {}
    i, n = 0, len(tokens)
    is_item = lambda t: t[1] and t[0].startswith("_")
    is_word = lambda t: t[1] and (t[0].lower() == "loop_" or t[0].startswith("_") or t[0].lower().startswith(("data_", "save_")))
    while i < n:
        word, bare = tokens[i]
        if bare and word.lower() == "loop_":
            i += 1
            names = []
            while i < n and is_item(tokens[i]):
                names.append(tokens[i][0])
                i += 1
            values = []
            while i < n and not is_word(tokens[i]):
                values.append(tokens[i][0])
                i += 1
            for k, name in enumerate(names):
                out.setdefault(name, []).extend(values[k :: len(names)])
        elif bare and word.startswith("_") and i + 1 < n:
            out.setdefault(word, []).append(tokens[i + 1][0])
            i += 2
        else:
            i += 1
    return out


def files(spark: SparkSession, path: str, pattern: str = "*.cif.gz") -> DataFrame:
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(path).select("path", "content")


def _columns(data: dict, items: dict[str, str]) -> list[dict]:
    lists = {k: data[v] for k, v in items.items() if v in data}
    return [dict(zip(lists, row)) for row in zip(*lists.values())] if len(lists) == len(items) else []


#: Single items as lists, and loops as rows, with the items they come from.
LISTS = {
    "methods": "_exptl.method", "xray": "_refine.ls_d_res_high", "em": "_em_3d_reconstruction.resolution", "deposited": "_pdbx_database_status.recvd_initial_deposition_date", "revised": "_pdbx_audit_revision_history.revision_date",
    "work": "_refine.ls_R_factor_R_work", "free": "_refine.ls_R_factor_R_free", "assembly": "_pdbx_struct_assembly.id", "details": "_pdbx_struct_assembly.oligomeric_details",
}
LOOPS = {
    "entities": {"entity": "_entity_poly.entity_id", "type": "_entity_poly.type", "code": "_entity_poly.pdbx_seq_one_letter_code_can"},
    "ref_seq": {"ref_id": "_struct_ref_seq.ref_id", "accession": "_struct_ref_seq.pdbx_db_accession", "strands": "_struct_ref_seq.pdbx_strand_id"},
    "refs": {"ref_id": "_struct_ref.id", "db_name": "_struct_ref.db_name", "accession": "_struct_ref.pdbx_db_accession"},
}
ATOM = {
    "model": "_atom_site.pdbx_PDB_model_num", "chain": "_atom_site.auth_asym_id", "entity": "_atom_site.label_entity_id", "label_seq": "_atom_site.label_seq_id", "auth_seq": "_atom_site.auth_seq_id",
    "ins": "_atom_site.pdbx_PDB_ins_code", "atom": "_atom_site.label_atom_id", "alt": "_atom_site.label_alt_id", "occupancy": "_atom_site.occupancy", "b_factor": "_atom_site.B_iso_or_equiv", "group": "_atom_site.group_PDB",
}
_struct = lambda names: "array<struct<" + ", ".join(f"`{n}`: string" for n in names) + ">>"
PARSED = (
    "file string, pdb_id string, error_type string, message string, " + ", ".join(f"{n} array<string>" for n in LISTS) + ", "
    + ", ".join(f"{n} {_struct(items)}" for n, items in LOOPS.items()) + f", atoms {_struct(['row', *ATOM])}"
)


def _atoms(data: dict) -> list[dict]:
    lists = {k: data[v] for k, v in ATOM.items() if v in data}
    rows = (dict.fromkeys(ATOM) | dict(zip(lists, row)) | {"row": str(i)} for i, row in enumerate(zip(*lists.values()))) if lists else ()
    return [r for r in rows if r["group"] == "ATOM"]


def _parse_files(batches: Iterator[pd.DataFrame], most: int = 1 << 22) -> Iterator[pd.DataFrame]:
    """Parsed rows, handed on whenever the files they come from hold `most` bytes: many small files a batch, or one large one."""
    frame = lambda rows: pd.DataFrame({c: pd.Series([r[c] for r in rows], dtype=object) for c in rows[0]})
    for pdf in batches:
        rows, size = [], 0
        for path, content in zip(pdf["path"], pdf["content"]):
            name = path.rsplit("/", 1)[-1]
            row = {"file": name, "pdb_id": name[:4].upper(), "error_type": None, "message": None, **dict.fromkeys((*LISTS, *LOOPS, "atoms"))}
            try:
                text = gzip.decompress(content) if content[:2] == b"\x1f\x8b" else bytes(content)
                size += len(text)
                if not text.lstrip().startswith(b"data_"):
                    raise ValueError("no data block")
                d = parse(text.decode("utf-8", "replace"))
                row |= {n: d.get(item, []) for n, item in LISTS.items()} | {n: _columns(d, items) for n, items in LOOPS.items()} | {"atoms": _atoms(d)}
            except Exception as e:  # noqa: BLE001 - one bad file becomes a row, not a failed job
                row |= {"error_type": type(e).__name__, "message": re.sub(r"[\t\n]", " ", str(e))}
            rows.append(row)
            if size >= most:
                yield frame(rows)
                rows, size = [], 0
        if rows:
            yield frame(rows)


def parsed(source: DataFrame) -> DataFrame:
    """One row a file with all its items and loops nested: what the readers below take. Write it where several of them read it. Given such rows, returns them."""
    return source if "content" not in source.columns else source.mapInPandas(_parse_files, PARSED)


def _loop(source: DataFrame, name: str) -> DataFrame:
    return parsed(source).filter("error_type is null").select("pdb_id", F.explode(name).alias("x")).select("pdb_id", "x.*")


def read_metadata(source: DataFrame) -> DataFrame:
    """One row a file: method, category, resolution, and its error where it has one. The category picks the resolution's source."""
    rows = parsed(source).withColumn("method", F.array_join("methods", ";"))
    cat = method_category("method")
    return rows.select("file", "pdb_id", "method", cat.alias("category"), F.when(cat == "xray", best_float("xray")).when(cat == "em", best_float("em")).alias("resolution"), "error_type", "message")


def read_entities(source: DataFrame) -> DataFrame:
    """(pdb_id, entity, deposited_length) of the L-polypeptides."""
    return _loop(source, "entities").filter("type = 'polypeptide(L)'").select("pdb_id", "entity", one_letter_length("code").alias("deposited_length"))


def read_atoms(source: DataFrame) -> DataFrame:
    """The ATOM rows of every file, with `row` their place in it."""
    return _loop(source, "atoms").withColumn("row", F.col("row").cast("int")).drop("group")


def chain_entities(atoms: DataFrame, entities: DataFrame) -> DataFrame:
    """(pdb_id, chain, entity): the entity of a chain's last CA row among L-polypeptides."""
    known = entities.select("pdb_id", "entity").distinct()
    ca = atoms.filter("atom = 'CA'").join(known, ["pdb_id", "entity"], "left_semi")
    return ca.groupBy("pdb_id", "chain").agg(F.max_by("entity", "row").alias("entity"))


def read_references(source: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(ref_seq, refs) for native_accessions."""
    return _loop(source, "ref_seq"), _loop(source, "refs")


def read_entry(source: DataFrame) -> DataFrame:
    """(pdb_id, deposition_date, release_date, r_work, r_free, assembly_count, assembly_descriptions) per file; the release is the earliest revision."""
    rows = parsed(source).filter("error_type is null")
    here = lambda c: F.filter(c, lambda x: ~x.isin("", ".", "?"))
    first = lambda c: F.get(here(c), F.lit(0))
    return rows.select(
        "pdb_id", first("deposited").alias("deposition_date"), F.array_min(here("revised")).alias("release_date"), first("work").try_cast("double").alias("r_work"), first("free").try_cast("double").alias("r_free"),
        F.size(F.array_distinct(here("assembly"))).alias("assembly_count"), F.array_join(F.array_sort(F.array_distinct(here("details"))), ";").alias("assembly_descriptions"))

"""Identifiers `<entry>_<chain>` or `<entry>_MODEL_<n>_<chain>`: the entry folds case, the rest does not."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def canonical_id(c: Column | str) -> Column:
    """First four characters in upper case, the rest kept. Null stays null."""
    c = F.col(c) if isinstance(c, str) else c
    return F.concat(F.upper(F.substring(c, 1, 4)), F.substr(c, F.lit(5)))


def entry_of(c: Column | str) -> Column:
    """The entry an id belongs to: its first four characters in upper case."""
    c = F.col(c) if isinstance(c, str) else c
    return F.upper(F.substring(c, 1, 4))


def entry_key(pdb_id: Column | str, id_: Column | str) -> Column:
    """The entry as written, blanks and case aside; taken from the id where it is missing."""
    pdb_id = F.col(pdb_id) if isinstance(pdb_id, str) else pdb_id
    return F.coalesce(F.nullif(F.upper(F.regexp_replace(pdb_id, r"\s+", "")), F.lit("")), entry_of(id_))


def valid_id(c: Column | str) -> Column:
    """Four characters, an underscore and a chain that is not empty."""
    c = F.col(c) if isinstance(c, str) else c
    return (F.instr(c, "_") == 5) & (F.length(c) > 5)


def components(c: Column | str) -> Column:
    """Struct (pdb_id, model, chain); model is "" where the id names none."""
    c = F.col(c) if isinstance(c, str) else c
    full = r"^([^_]+)_MODEL_([0-9]+)_(.+)$"
    has_model = c.rlike(full)
    cut = F.instr(c, "_")
    return F.struct(
        F.when(has_model, F.regexp_extract(c, full, 1)).when(cut > 0, F.substring_index(c, "_", 1)).otherwise(c).alias("pdb_id"),
        F.when(has_model, F.regexp_extract(c, full, 2)).otherwise(F.lit("")).alias("model"),
        F.when(has_model, F.regexp_extract(c, full, 3)).when(cut > 0, F.substr(c, cut + 1)).otherwise(F.lit("")).alias("chain"),
    )


def split_label(c: Column | str) -> Column:
    """train, valid or test from any spelling of those; null for held-out, missing and unknown labels."""
    c = F.lower(F.trim(F.col(c) if isinstance(c, str) else c))
    return F.when(c.isin("train", "training"), "train").when(c.isin("valid", "validation", "val"), "valid").when(c.isin("test", "testing"), "test")


def letters(c: Column | str) -> Column:
    """A sequence in upper case with everything but A-Z removed; null where nothing is left."""
    c = F.upper(F.col(c) if isinstance(c, str) else c)
    return F.nullif(F.regexp_replace(c, "[^A-Z]+", ""), F.lit(""))

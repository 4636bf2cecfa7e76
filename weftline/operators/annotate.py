"""Annotations: residues and chains from atoms, and identifiers from mapping tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.sequences import joined, present, residue_key


def residues(atoms: DataFrame, chain: list[str]) -> DataFrame:
    """One row per chain and residue of atoms (label_seq, auth_seq, ins, atom, alt, occupancy, b_factor).

    ca, backbone and alt are flags (a CA atom; all of N, CA, C, O; an alternate location), occupancy the largest and
    b_factor the mean of its CA atoms, position the largest label number that parses. Text that is no number is null.
    """
    has = lambda name: F.max(F.coalesce(F.col("atom") == name, F.lit(False)))
    of_ca = lambda c: F.when(F.col("atom") == "CA", F.col(c).cast("string").try_cast("double"))
    return atoms.withColumn("residue", residue_key("label_seq", "auth_seq", "ins")).groupBy(*chain, "residue").agg(
        has("CA").alias("ca"), (has("N") & has("CA") & has("C") & has("O")).alias("backbone"), F.max(present(F.col("alt")).isNotNull()).alias("alt"),
        F.max(of_ca("occupancy")).alias("occupancy"), F.avg(of_ca("b_factor")).alias("b_factor"), F.max(present(F.col("label_seq")).try_cast("int")).alias("position"),
    )


def chains(residue_rows: DataFrame, chain: list[str]) -> DataFrame:
    """Completeness of each chain from its residues. Means and gaps are null where no CA residue gives a value."""
    ca = F.col("ca")
    n_ca, n_bb = F.count_if("ca"), F.count_if("backbone")
    positions = F.when(ca, F.col("position"))
    first, last = F.min(positions), F.max(positions)
    return residue_rows.groupBy(*chain).agg(
        n_ca.alias("observed_ca_residues"), n_bb.alias("complete_backbone_residues"), F.try_divide(n_bb, n_ca).alias("backbone_complete_fraction"),
        (last - first + 1 - F.countDistinct(positions)).alias("internal_missing_residues"), first.alias("first_position"), last.alias("last_position"),
        F.avg(F.when(ca, F.col("occupancy"))).alias("mean_ca_occupancy"), F.min(F.when(ca, F.col("occupancy"))).alias("min_ca_occupancy"),
        F.avg(F.when(ca, F.col("b_factor"))).alias("mean_ca_b_factor"), F.count_if(ca & F.col("alt")).alias("alternate_location_residues"),
    )


def terminal_missing(first="first_position", last="last_position", deposited="deposited_length"):
    """Residues of the deposited chain before the first and after the last position; null where any is unknown or the length is 0."""
    return F.when(F.col(deposited) > 0, F.col(first) - 1 + F.greatest(F.lit(0), F.col(deposited) - F.col(last)))


def mapped_ids(mapping: DataFrame, keys: list[str], values: dict[str, list[str]], wanted: DataFrame | None = None) -> DataFrame:
    """Per key the different ids of each field, sorted and joined by ";". values: field -> candidate columns, the first present one counts.

    Rows of keys that are not wanted drop out before anything is collected.
    """
    rows = mapping if wanted is None else mapping.join(wanted.select(*keys).distinct(), keys, "left_semi")
    return rows.groupBy(*keys).agg(*(joined(F.coalesce(*(present(F.col(c)) for c in cs))).alias(name) for name, cs in values.items()))


def native_accessions(ref_seq: DataFrame, refs: DataFrame, entry: str = "pdb_id") -> DataFrame:
    """(entry, chain, native_uniprot_ids): a strand's own accession, else that of the UniProt reference it names."""
    known = refs.filter(F.col("db_name").isin("UNP", "UNIPROT")).select(entry, "ref_id", present(F.col("accession")).alias("ref_accession")).filter("ref_accession is not null").groupBy(entry, "ref_id").agg(F.max("ref_accession").alias("ref_accession"))
    own = ref_seq.join(known, [entry, "ref_id"], "left").select(entry, F.coalesce(present(F.col("accession")), "ref_accession").alias("a"), F.explode(F.split("strands", "[;,]")).alias("chain"))
    return own.filter("a is not null").groupBy(entry, F.trim("chain").alias("chain")).agg(joined(F.col("a")).alias("native_uniprot_ids"))

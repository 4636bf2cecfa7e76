"""Scalar functions over sequences, methods and measures."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The amino acid and the structural alphabet share twenty letters.
ALPHABET = "ACDEFGHIKLMNPQRSTVWY"
#: How a missing value is written.
MISSING = ("", ".", "?")


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def present(c: Column | str) -> Column:
    """The value, null where it is one of the missing tokens."""
    return F.when(~_c(c).isin(*MISSING), _c(c))


def one_letter_length(c: Column | str) -> Column:
    """Length of a one-letter code whose modified residues stand in parentheses and count once; blanks do not count."""
    return F.length(F.regexp_replace(F.regexp_replace(_c(c), r"\([^)]*\)", "X"), r"\s+", ""))


def unknown_fraction(c: Column | str) -> Column:
    """Share of letters outside the twenty; null for empty and null sequences."""
    return F.try_divide(F.length(F.translate(_c(c), ALPHABET, "")), F.length(_c(c)))


def only_alphabet(c: Column | str) -> Column:
    return F.upper(_c(c)).rlike(f"^[{ALPHABET}]*$")


def coverage(length: Column | str, deposited: Column | str) -> Column:
    """Observed share of the deposited length, at most 1; null where no deposited length is known."""
    return F.when(_c(deposited) > 0, F.least(F.lit(1.0), _c(length) / _c(deposited)))


def quality_score(resolution: Column | str) -> Column:
    return F.when(_c(resolution) > 0, 1.0 / _c(resolution))


def method_category(method: Column | str) -> Column:
    """xray where the methods name X-ray diffraction, else em for electron microscopy, else other; null stays null."""
    m = F.upper(_c(method))
    return F.when(m.contains("X-RAY DIFFRACTION"), "xray").when(m.contains("ELECTRON MICROSCOPY"), "em").when(m.isNotNull(), "other")


def best_float(values: Column | str) -> Column:
    """Smallest number among strings; text, NaN and infinities count as none."""
    numbers = F.transform(_c(values), lambda x: x.try_cast("double"))
    return F.array_min(F.filter(numbers, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))


def multi_value(c: Column | str, sep: str = ";") -> Column:
    """Array of the trimmed parts of a joined field, empty parts aside; null gives an empty array."""
    parts = F.transform(F.split(F.coalesce(_c(c), F.lit("")), sep), lambda x: F.trim(x))
    return F.filter(parts, lambda x: x != "")


def joined(c: Column, sep: str = ";") -> Column:
    """Aggregate: the different values, sorted and joined."""
    return F.array_join(F.array_sort(F.collect_set(c)), sep)


def sequence_stats(c: Column | str) -> Column:
    """Struct (entropy_bits, max_fraction, symbols) of a sequence's letters, within the row; null for empty and null.

    H = log2(n) - sum(k log2 k) / n over the counts k of the letters.
    """
    s = _c(c)
    n = F.length(s)
    counts = F.transform(F.array_distinct(F.filter(F.split(s, ""), lambda x: x != "")), lambda x: (n - F.length(F.replace(s, x, F.lit("")))).cast("double"))
    h = F.log2(n) - F.aggregate(counts, F.lit(0.0), lambda t, k: t + k * F.log2(k)) / n
    return F.when(n > 0, F.struct(F.greatest(h, F.lit(0.0)).alias("entropy_bits"), (F.array_max(counts) / n).alias("max_fraction"), F.size(counts).alias("symbols")))


def period(date: Column | str, train_end: str = "2024-12-31", valid_end: str = "2025-12-31", test_end: str = "2026-09-30") -> Column:
    """train, valid or test by ISO date, ends included; null for later and missing dates."""
    d = F.nullif(_c(date), F.lit(""))
    return F.when(d <= train_end, "train").when(d <= valid_end, "valid").when(d <= test_end, "test")


def shard_path(root: str, id_: Column | str) -> Column:
    """<root>/<middle two characters>/<id>.cif.gz in lower case."""
    low = F.lower(_c(id_))
    return F.concat_ws("/", F.lit(root), F.substring(low, 2, 2), F.concat(low, F.lit(".cif.gz")))


def residue_key(label_seq: Column | str, auth_seq: Column | str, ins: Column | str) -> Column:
    return F.coalesce(present(_c(label_seq)), F.concat_ws(":", _c(auth_seq), _c(ins)))


def requested_model(model: Column | str) -> Column:
    return F.coalesce(F.nullif(_c(model), F.lit("")), F.lit("1"))


def one_line(c: Column | str) -> Column:
    return F.translate(_c(c), "\t\n\r", "   ")

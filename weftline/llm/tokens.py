"""Token counts of whole texts in a public tokenizer's vocabulary."""

from __future__ import annotations

import base64
import os
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TOKENIZERS = os.environ.get("TOKENIZER_DIR", "/opt/tokenizers")
RANKS = "byte_bpe_50k.tiktoken"
#: Fixed value: the pattern that splits text before the merges of the rank file.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: A single blank between two other signs. The pattern always starts a new piece there, so counts add up over such cuts.
_CUT = re.compile(r"(?<=\S) (?=\S)")
_KEPT = 400_000
_counters: dict[str, "_Counter"] = {}


class _Counter(dict):
    """Token counts by word, filled as words appear. Emptied when _KEPT are held: a bound on memory, counts stay exact."""

    def __init__(self, path: str):
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.encode = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def __missing__(self, word: str) -> int:
        if len(self) >= _KEPT:
            self.clear()
        n = len(self.encode(" " + word))
        if len(word) < 64:
            self[word] = n
        return n

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        first, *rest = _CUT.split(text)
        return len(self.encode(first)) + sum(map(self.__getitem__, rest))


def counter(path: str) -> _Counter:
    if path not in _counters:
        _counters[path] = _Counter(path)
    return _counters[path]


def token_counter(folder: str = TOKENIZERS, ranks: str = RANKS):
    """A Column function: tokens of a text. Null and empty texts have none."""
    path = os.path.join(folder, ranks)

    @F.pandas_udf("long")
    def n_tokens(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        count = counter(path).count
        for texts in batches:
            yield pd.Series(list(map(count, texts)), dtype="int64")

    return n_tokens


def with_tokens(documents: DataFrame, text: str = "text", name: str = "n_tokens", folder: str = TOKENIZERS) -> DataFrame:
    """Documents with the column `name` for their text, which is dropped."""
    return documents.withColumn(name, token_counter(folder)(F.col(text))).drop(text)


def source_key(c: Column | str) -> Column:
    """A source's name without case, blanks and separators; null where nothing is left."""
    c = F.col(c) if isinstance(c, str) else c
    return F.nullif(F.regexp_replace(F.lower(c), r"[\s_\-./:]+", ""), F.lit(""))

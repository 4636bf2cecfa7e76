"""Languages of documents and of their parts: piece unigrams summed over all segmentations."""

from __future__ import annotations

import math
import os
import re
import unicodedata
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import Scratch, count_rows
from .prose import BREAK, Placed, prose, typeset
from .tokens import TOKENIZERS

#: What a label may call a language.
NAMES = {
    "en": ("en", "eng", "english"),
    "de": ("de", "deu", "ger", "german", "deutsch"),
    "fr": ("fr", "fra", "fre", "french", "français", "francais"),
    "es": ("es", "spa", "spanish", "español", "espanol", "castellano"),
    "pt": ("pt", "por", "portuguese", "português", "portugues"),
    "it": ("it", "ita", "italian", "italiano"),
    "ru": ("ru", "rus", "russian", "русский"),
}
PIECES = "piece_bpe_32k.model"
START = "▁"
#: Word scores kept, words summed at once: bounds on memory.
_KEPT, _AT_ONCE = 150_000, 200_000
#: Longer words are summed in logarithms, which cannot underflow.
_PLAIN = 32
_END, _CLOSE = (".", "!", "?", "…"), "\"')]}»”’“"
_CHUNK = re.compile(r"\S+")


def named_language(label: Column | str) -> Column:
    """The code of the language a label names, region, case and blanks aside: the two-letter one for the names above, else
    the label itself; null for blank and missing labels."""
    c = F.lower(F.trim(F.col(label) if isinstance(label, str) else label))
    bare = F.trim(F.regexp_replace(c, r"[-_(].*$", ""))
    out = F.nullif(bare, F.lit(""))
    for code, names in NAMES.items():
        out = F.when(bare.isin(*names), code).otherwise(out)
    return out


def vocabulary(folder: str = TOKENIZERS, model: str = PIECES) -> list[str]:
    """The pieces of a public vocabulary in lower case, each once; byte and control pieces aside."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=os.path.join(folder, model))
    keep = (sp.id_to_piece(i).lower() for i in range(sp.get_piece_size()) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i)))
    return list(dict.fromkeys(p for p in keep if p.replace(START, "").isalpha() or p.replace(START, "") in ("'", "-", "’") or p == START))


def normal(chunk: str) -> str:
    """A word as scored: without surrounding marks, composed, in lower case; "" where there is no letter."""
    a, b = 0, len(chunk)
    while a < b and not chunk[a].isalpha():
        a += 1
    while b > a and not chunk[b - 1].isalpha():
        b -= 1
    return unicodedata.normalize("NFC", chunk[a:b]).lower()


class Lattice:
    """Forward and backward sums over all segmentations of a word into pieces, for all languages at once."""

    def __init__(self, pieces: list[str], p: np.ndarray):
        self.index = {x: i for i, x in enumerate(pieces)}
        self.longest = max(map(len, pieces))
        self.p, self.floor = p, np.full(p.shape[1], p[p > 0].min() * 1e-2)

    def _arcs(self, s: str) -> list[list[tuple[int, int]]]:
        get, n = self.index.get, len(s)
        arcs = [[(j, k) for j in range(i + 1, min(n, i + self.longest) + 1) if (k := get(s[i:j])) is not None] for i in range(n)]
        for i, a in enumerate(arcs):
            if not a or a[0][0] != i + 1:
                a.append((i + 1, -1))  # a sign the vocabulary lacks costs all languages the same
        return arcs

    def _logs(self) -> tuple[np.ndarray, np.ndarray]:
        if not hasattr(self, "log_p"):
            with np.errstate(divide="ignore"):
                self.log_p, self.log_floor = np.log(self.p), np.log(self.floor)
        return self.log_p, self.log_floor

    def score(self, word: str) -> np.ndarray:
        """Natural log of the word's probability by language."""
        s = START + word
        if len(s) > _PLAIN:
            return self._forward(self._arcs(s))[-1]
        a = np.zeros((len(s) + 1, self.p.shape[1]))
        a[0] = 1
        for i, arcs in enumerate(self._arcs(s)):
            for j, k in arcs:
                a[j] += a[i] * (self.p[k] if k >= 0 else self.floor)
        return np.log(a[-1])

    def _forward(self, all_arcs: list) -> np.ndarray:
        log_p, log_floor = self._logs()
        a = np.full((len(all_arcs) + 1, self.p.shape[1]), -np.inf)
        a[0] = 0
        for i, arcs in enumerate(all_arcs):
            for j, k in arcs:
                np.logaddexp(a[j], a[i] + (log_p[k] if k >= 0 else log_floor), out=a[j])
        return a

    def expected(self, word: str, weights: np.ndarray, counts: dict[int, np.ndarray]) -> None:
        """Adds the expected uses of each piece in so many occurrences of the word by language."""
        s = START + word
        arcs, n = self._arcs(s), len(s)
        if n > _PLAIN:
            log_p, log_floor = self._logs()
            a, b = self._forward(arcs), np.full((n + 1, self.p.shape[1]), -np.inf)
            b[n] = 0
            for i in range(n - 1, -1, -1):
                for j, k in arcs[i]:
                    np.logaddexp(b[i], b[j] + (log_p[k] if k >= 0 else log_floor), out=b[i])
            for i in range(n):
                for j, k in arcs[i]:
                    if k >= 0:
                        counts[k] = counts.get(k, 0) + weights * np.exp(a[i] + log_p[k] + b[j] - a[n])
            return
        a, b = np.zeros((n + 1, self.p.shape[1])), np.zeros((n + 1, self.p.shape[1]))
        a[0] = b[n] = 1
        for i in range(n):
            for j, k in arcs[i]:
                a[j] += a[i] * (self.p[k] if k >= 0 else self.floor)
        for i in range(n - 1, -1, -1):
            for j, k in arcs[i]:
                b[i] += b[j] * (self.p[k] if k >= 0 else self.floor)
        for i in range(n):
            for j, k in arcs[i]:
                if k >= 0:
                    counts[k] = counts.get(k, 0) + weights * a[i] * self.p[k] * b[j] / a[n]


class Scorer:
    """Sentences of texts with their scores by language. Word scores are kept as words appear and emptied at _KEPT: a bound on memory that changes no score."""

    def __init__(self, pieces: list[str], p: np.ndarray):
        self.lattice, self.n = Lattice(pieces, p), p.shape[1]
        self.clear()

    def clear(self) -> None:
        self.seen: dict[str, int] = {}
        self.rows: list[tuple] = []
        self.table = np.zeros((0, self.n + 3))

    def _row(self, chunk: str) -> int:
        w, bare = normal(chunk), chunk.rstrip(_CLOSE)
        first = next((c for c in chunk if c.isalnum()), "")
        ends = bare.endswith(_END) and not (len(w) == 1 and bare.endswith("."))
        self.rows.append((*(self.lattice.score(w) if w else np.zeros(self.n)), float(bool(w)), float(ends), float(first.isupper() or first.isdigit())))
        if len(chunk) < 64:
            self.seen[chunk] = len(self.rows) - 1
        return len(self.rows) - 1

    def sentences(self, texts: list[str], placed: bool = False) -> tuple[np.ndarray, ...]:
        """For each sentence of all texts: text number, flow number, scores, words, whether it is whole; placed: also its start
        and end in the text."""
        if len(self.seen) > _KEPT:
            self.clear()
        seen, n_flow, held, out = self.seen, 0, ([], [], [], [], []), []
        for t, text in enumerate(texts):
            flows = _placed_chunks(text) if placed else ((flow.split(), None, None) for flow in prose(text).split(BREAK))
            for chunks, starts, ends in flows:
                if chunks:
                    held[0].extend([seen[c] if c in seen else self._row(c) for c in chunks])
                    held[1].append(np.full(len(chunks), t))
                    held[2].append(np.full(len(chunks), n_flow))
                    if placed:
                        held[3].append(starts)
                        held[4].append(ends)
                    n_flow += 1
                if len(held[0]) > _AT_ONCE:
                    out.append(self._sums(*held))
                    held = ([], [], [], [], [])
        out.append(self._sums(*held))
        return tuple(np.concatenate(x) for x in zip(*out))

    def _sums(self, idx: list[int], text_of: list, flow_of: list, starts_of: list, ends_of: list) -> tuple:
        if not idx:
            z = np.zeros(0, dtype=int)
            return z, z, np.zeros((0, self.n)), np.zeros(0), z.astype(bool), z, z
        if len(self.table) < len(self.rows):
            self.table = np.vstack([self.table, np.array(self.rows[len(self.table) :])])
        x, text_of, flow_of = self.table[np.array(idx)], np.concatenate(text_of), np.concatenate(flow_of)
        cut = np.append(flow_of[1:] != flow_of[:-1], True)
        whole = (x[:, -2] > 0) & (cut | np.append(x[1:, -1] > 0, True))
        last = whole | cut
        starts = np.append(0, np.flatnonzero(last)[:-1] + 1)
        sums = np.add.reduceat(x, starts, axis=0)
        if starts_of:
            places = np.concatenate(starts_of)[starts], np.concatenate(ends_of)[last]
        else:
            places = np.zeros(len(starts), dtype=int), np.zeros(len(starts), dtype=int)
        return text_of[starts], flow_of[starts], sums[:, : self.n], sums[:, self.n], whole[last] & (x[starts, -1] > 0), *places


def _placed_chunks(text: str | None) -> Iterator[tuple[list[str], np.ndarray, np.ndarray]]:
    """The chunks of each flow with their starts and ends in the text."""
    if not text:
        return
    t = typeset(Placed(text))
    at = 0
    for flow in t.text.split(BREAK):
        spans = [m.span() for m in _CHUNK.finditer(flow)]
        if spans:
            a, b = np.array(spans).T + at
            yield [flow[x:y] for x, y in spans], t.starts[a], t.ends[b - 1]
        at += len(flow) + 1


_scorers: dict[str, Scorer] = {}


def _scorer(model) -> Scorer:
    name, shared = model
    if name not in _scorers:
        _scorers.clear()
        _scorers[name] = Scorer(*shared.value)
    return _scorers[name]


def _posterior(scores: np.ndarray) -> np.ndarray:
    e = np.exp(scores - scores.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


class Model:
    """Piece probabilities by language, broadcast to the executors; both dimensions are fixed by vocabulary and languages."""

    def __init__(self, spark, languages: list[str], pieces: list[str], p: np.ndarray):
        self.languages, self.pieces, self.p = languages, pieces, p
        self.shared = (uuid.uuid4().hex, spark.sparkContext.broadcast((pieces, p)))


def _maximise(languages: list[str], pieces: list[str], counts: np.ndarray, alpha: float) -> np.ndarray:
    """Probabilities from expected counts: each language backs off to all languages, and those to a flat vocabulary."""
    whole = counts.sum(axis=1) + 1.0 / len(pieces)
    back = (whole / whole.sum())[:, None]
    return (counts + alpha * back) / (counts.sum(axis=0, keepdims=True) + alpha)


def _expectation(words: DataFrame, languages: list[str], pieces: list[str], p: np.ndarray) -> np.ndarray:
    """Expected piece counts of (language, word, n). Tasks send one row a piece they saw; the sum is a table of the vocabulary."""
    shared = words.sparkSession.sparkContext.broadcast((pieces, p))
    at = {x: i for i, x in enumerate(languages)}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lattice, counts = Lattice(*shared.value), {}
        for pdf in batches:
            for lang, word, n in zip(pdf["language"], pdf["word"], pdf["n"]):
                weights = np.zeros(len(at))
                weights[at[lang]] = n
                lattice.expected(word, weights, counts)
        if counts:
            yield pd.DataFrame({"piece": list(counts), "uses": [v.tolist() for v in counts.values()]})

    rows = words.mapInPandas(run, "piece int, uses array<double>").groupBy("piece").agg(*(F.sum(F.col("uses")[i]).alias(f"u{i}") for i in range(len(languages)))).collect()
    counts = np.zeros((len(pieces), len(languages)))
    for r in rows:
        counts[r["piece"]] = r[1:]
    return counts


def fit(documents: DataFrame, reference: DataFrame, key: str = "doc_id", max_documents: int = 4000, rounds: int = 2, steps: int = 2, alpha: float = 200.0, folder: str = TOKENIZERS) -> Model:
    """Piece probabilities of the languages in `reference`, fitted by expectation maximisation over all segmentations.

    Training words: the reference sentences, and the prose of at most about `max_documents` documents drawn by the
    hash of their key (the documented bound of the sample). The first round trusts a document's label; each later
    one gives every sentence the language the last model is sure of, so wrong labels and mixed texts wash out.
    Expected piece counts are summed on Spark; only a table of vocabulary x languages comes back.

    Null and empty texts and labels that name no language of the reference add nothing to the first round. Without
    documents the reference alone is fitted; without a reference the model knows no language.
    """
    spark = documents.sparkSession
    scratch = Scratch(spark, "languages")
    languages = [r[0] for r in reference.select(named_language("lang").alias("l")).filter("l is not null").distinct().orderBy("l").collect()]
    pieces = vocabulary(folder)
    if not languages:
        return Model(spark, [], pieces, np.zeros((len(pieces), 0)))
    n = documents.count()
    pick = F.pmod(F.xxhash64(key, F.lit("fit")), F.lit(1_000_000)) < math.ceil(1_000_000 * min(1.0, max_documents / max(n, 1)))
    sample = documents.filter(pick).select("text", named_language("lang").alias("label")).unionByName(reference.select(F.col("sentence").alias("text"), named_language("lang").alias("label"))).filter("text is not null")
    sample = scratch.write(sample.repartition(max(spark.sparkContext.defaultParallelism, 1), F.xxhash64("text")))

    def by_label(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: Counter = Counter()
        for pdf in batches:
            for text, label in zip(pdf["text"], pdf["label"]):
                counts.update((label, w) for c in prose(text).replace(BREAK, " ").split() if (w := normal(c)))
        if counts:
            yield pd.DataFrame([(a, b, c) for (a, b), c in counts.items()], columns=["language", "word", "n"])

    def by_model(model):
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            scorer, counts = _scorer(model), Counter()
            for pdf in batches:
                for text in pdf["text"]:
                    for flow in prose(text).split(BREAK):
                        for words, lang, sure in _split_sentences(scorer, flow):
                            if sure:
                                counts.update((languages[lang], w) for w in words)
            if counts:
                yield pd.DataFrame([(a, b, c) for (a, b), c in counts.items()], columns=["language", "word", "n"])

        return run

    schema = "language string, word string, n long"
    labelled = sample.filter(F.col("label").isin(*languages))
    words = labelled.mapInPandas(by_label, schema)
    p = np.full((len(pieces), len(languages)), 1.0 / len(pieces))
    for r in range(rounds):
        table = scratch.write(words.groupBy("language", "word").agg(F.sum("n").alias("n")).repartition(spark.sparkContext.defaultParallelism))
        for _ in range(steps):
            p = _maximise(languages, pieces, _expectation(table, languages, pieces, p), alpha)
        if r + 1 < rounds:
            words = sample.mapInPandas(by_model(Model(spark, languages, pieces, p).shared), schema)
    return Model(spark, languages, pieces, p)


def _split_sentences(scorer: Scorer, flow: str) -> Iterator[tuple[list[str], int, bool]]:
    held: list[str] = []
    for chunk in flow.split():
        held.append(chunk)
        if chunk.rstrip(_CLOSE).endswith(_END):
            yield _judge(scorer, held)
            held = []
    if held:
        yield _judge(scorer, held)


def _judge(scorer: Scorer, chunks: list[str]) -> tuple[list[str], int, bool]:
    rows = [scorer.rows[scorer.seen[c] if c in scorer.seen else scorer._row(c)] for c in chunks]
    score = np.array(rows)[:, : scorer.n].sum(axis=0)
    best = int(score.argmax())
    return [w for c in chunks if (w := normal(c))], best, bool(_posterior(score[None])[0, best] > 0.99)


SEGMENTS = "language string, confidence double, n_sentences int, n_words int"
PLACES = "start int, end int"


def segments(documents: DataFrame, model: Model, key: str = "doc_id", label: str = "lang", sure: float = 0.99, least_words: int = 2, places: bool = False) -> DataFrame:
    """(key, label, segment, language, confidence, n_sentences, n_words): stretches of one language, in order.

    Sentences of the prose (see `prose`) are scored by summing over all segmentations of their words; the posterior
    under equal priors is the confidence. A sentence with fewer than `least_words` words or a posterior under `sure`
    belongs to the stretch it stands in. A stretch ends where a sure sentence of another language follows or the
    flow breaks (headings, captions, bibliographies). n_sentences counts the whole sure sentences of a stretch, confidence is their
    mean, weighted by words. Texts without prose, empty and null texts, and all texts under a model
    of no language, have one segment without language. Repeated keys are documents of their own.

    With places also (start, end): where the stretch's sure sentences begin and end in the text as given, markup counted,
    in signs from 0, the end not included; null without a language.
    """
    shared, languages = model.shared, model.languages
    columns = f"{SEGMENTS}, {PLACES}" if places else SEGMENTS
    if not languages:
        none = lambda kind: F.lit(None).cast(kind)
        more = [none("int").alias("start"), none("int").alias("end")] if places else []
        return documents.select(key, label, F.lit(1).alias("segment"), none("string").alias("language"), none("double").alias("confidence"), F.lit(0).alias("n_sentences"), F.lit(0).alias("n_words"), *more)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = _scorer(shared)
        for pdf in batches:
            for at in range(0, len(pdf), 500):
                part = pdf.iloc[at : at + 500]
                yield _stretches(part, scorer, key, label, languages, sure, least_words, places)

    kind = dict(documents.dtypes)
    return documents.select(key, label, "text").mapInPandas(run, f"{key} {kind[key]}, {label} string, segment int, {columns}")


def _stretches(pdf: pd.DataFrame, scorer: Scorer, key: str, label: str, languages: list[str], sure: float, least_words: int, places: bool) -> pd.DataFrame:
    text_of, flow_of, scores, words, whole, start, end = scorer.sentences(pdf["text"].tolist(), placed=places)
    rows = pd.DataFrame({"t": text_of, "flow": flow_of, "words": words, "whole": whole, "start": start, "end": end})
    if len(rows):
        post = _posterior(scores)
        rows["best"], rows["conf"] = post.argmax(axis=1), post.max(axis=1)
    else:
        rows["best"], rows["conf"] = 0, 0.0
    rows = rows[(rows["conf"] >= sure) & (rows["words"] >= least_words)]
    new = (rows["flow"] != rows["flow"].shift()) | (rows["best"] != rows["best"].shift())
    rows = rows.assign(run=new.cumsum(), cw=rows["conf"] * rows["words"])
    runs = rows.groupby("run").agg(t=("t", "first"), best=("best", "first"), cw=("cw", "sum"), n_words=("words", "sum"), n_sentences=("whole", "sum"), start=("start", "min"), end=("end", "max")).reset_index(drop=True)
    runs["segment"] = runs.groupby("t").cumcount() + 1
    out = pdf[[key, label]].reset_index(drop=True).merge(runs, left_index=True, right_on="t", how="left")
    found = pd.DataFrame({
        key: out[key].to_numpy(), label: out[label].to_numpy(), "segment": out["segment"].fillna(1).astype("int32").to_numpy(),
        "language": [languages[int(b)] if b == b else None for b in out["best"]],
        "confidence": (out["cw"] / out["n_words"]).to_numpy(), "n_sentences": out["n_sentences"].fillna(0).astype("int32").to_numpy(), "n_words": out["n_words"].fillna(0).astype("int32").to_numpy(),
    })
    return found.assign(**{c: out[c].astype("Int32").reset_index(drop=True) for c in ("start", "end")}) if places else found


def document_languages(parts: DataFrame, key: str = "doc_id", label: str = "lang") -> DataFrame:
    """(key, label, language, confidence, n_languages) per document: the language of most words, its confidence times its share of the words."""
    by = parts.groupBy(key, label, "language").agg(F.sum("n_words").alias("n"), F.sum(F.col("confidence") * F.col("n_words")).alias("c"))
    return by.groupBy(key, label).agg(F.max_by("language", F.struct("n", "language")).alias("language"), F.try_divide(F.max(F.struct("n", "language", "c"))["c"], F.sum("n")).alias("confidence"), F.count("language").alias("n_languages"))


def unnamed_languages(parts: DataFrame, key: str = "doc_id", label: str = "lang", least_sentences: int = 2) -> DataFrame:
    """(key, lang): languages with so many whole sentences in a row in a document whose label does not name them."""
    held = parts.filter(F.col("n_sentences") >= least_sentences).select(key, F.col("language").alias("found"), named_language(label).alias("named"))
    return held.filter("named is null or named != found").select(key, F.col("found").alias("lang")).distinct()

import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from weftline.llm import languages
from weftline.llm.prose import BREAK, prose

SENTENCES = {
    "en": ["The library opens at nine and closes at six.", "She asked whether the train had already left.", "Nobody could remember who had written the letter.", "We walked along the river for an hour.", "There is enough bread for all of them."],
    "de": ["Die Bibliothek öffnet um neun und schließt um sechs.", "Sie fragte, ob der Zug schon abgefahren sei.", "Niemand wusste noch, wer den Brief geschrieben hatte.", "Wir gingen eine Stunde am Fluss entlang.", "Es gibt genug Brot für alle."],
    "ru": ["Библиотека открывается в девять часов утра.", "Она спросила, ушёл ли уже поезд.", "Никто не помнил, кто написал письмо.", "Мы гуляли по берегу реки целый час.", "Хлеба хватит на всех."],
}


def test_forward_sums_all_segmentations():
    rnd = np.random.default_rng(51)
    pieces = ["▁a", "▁", "a", "b", "ab", "ba", "bab", "▁ab"]
    p = rnd.dirichlet(np.ones(len(pieces)), size=2).T
    lattice = languages.Lattice(pieces, p)
    word = "abab"
    s, total, uses = "▁" + word, np.zeros(2), np.zeros((len(pieces), 2))
    for cuts in itertools.product([0, 1], repeat=len(s) - 1):
        parts, held = [], ""
        for ch, cut in zip(s, (*cuts, 1)):
            held += ch
            if cut:
                parts.append(held)
                held = ""
        if all(x in lattice.index for x in parts):
            q = np.prod([p[lattice.index[x]] for x in parts], axis=0)
            total += q
            for x in parts:
                uses[lattice.index[x]] += q
    assert np.allclose(lattice.score(word), np.log(total))
    counts = {}
    lattice.expected(word, np.array([3.0, 1.0]), counts)
    for k, v in counts.items():
        assert np.allclose(v, np.array([3.0, 1.0]) * uses[k] / total)
    assert np.isfinite(lattice.score("ж" * 500)).all()


def test_long_words_are_summed_whole():
    rnd = np.random.default_rng(53)
    pieces = ["▁a", "▁", "a", "b", "ab", "ba", "bab", "▁ab"]
    lattice = languages.Lattice(pieces, rnd.dirichlet(np.ones(len(pieces)), size=2).T)
    word = "".join(rnd.choice(["a", "b"], size=60))
    a = np.zeros((62, 2))
    a[0] = 1
    for i in range(61):
        for j in range(i + 1, 62):
            if (k := lattice.index.get(("▁" + word)[i:j])) is not None:
                a[j] += a[i] * lattice.p[k]
    assert np.allclose(lattice.score(word), np.log(a[-1]))
    long, short = {}, {}
    lattice.expected(word, np.array([2.0, 3.0]), long)
    languages._PLAIN, held = 100, languages._PLAIN
    try:
        lattice.expected(word, np.array([2.0, 3.0]), short)
    finally:
        languages._PLAIN = held
    assert long.keys() == short.keys() and all(np.allclose(long[k], short[k]) for k in long)


def article(body, title="Nobody cares"):
    return "\\documentclass{article}\n\\newcommand{\\fw}{for words}\n\\title{" + title + "}\n\\begin{document}\n\\maketitle\n\\section{Ein Titel hier}\n" + body + "\n\\begin{thebibliography}{9}\n\\bibitem{a} A. Who, \\emph{Die Bibliothek schließt um sechs}.\n\\end{thebibliography}\n\\end{document}\nafter the end"


@pytest.mark.parametrize("markup, text", [
    ("One $x<y$ two~\\cite{a}. % gone\nThree [\\ref{b}].", "One two . Three ."),
    ("\\iffalse hidden \\fi seen \\begin{comment}\nnot\n\\end{comment} too", "seen too"),
    ("caf\\'e na\\\"{\\i}ve \\c{c}a gro{\\ss} Stra\\ss e \\~n l'\\`a {\\it word} \\textbf{bold.}", "café naïve ça groß Straße ñ l'à word bold."),
    ("A ``quoted term'' here. He said ``One is here. Two is there.'' Yes.", "A here. He said ``One is here. Two is there.'' Yes."),
    ("50\\% of it \\fw now", "50 of it for words now"),
    ("Before.\n\\[ a = b \\]\n$$ c $$\n\\begin{equation}\nx\n\\end{equation}\nAfter\\footnote{aside}.", "Before. After."),
    ("A \"quoted " + "term " * 80 + "\" here. It said \"One is here. " + "Two is there. " * 40 + "\" Yes \"open.", "A here. It said \"One is here. " + "Two is there. " * 40 + "\" Yes \"open."),
    ("broken $math never ends\n\nnext one \\textit{open", "broken $math never ends next one open"),
])
def test_prose(markup, text):
    assert " ".join(prose(article(markup)).replace(BREAK, " ").split()) == text


def test_prose_of_plain_and_missing_texts():
    assert prose(None) == "" and prose("") == "" and prose("Plain text. Here.") == "Plain text. Here."
    assert "caption words" in prose(article("\\begin{figure}\\caption{caption words}\\end{figure}"))


@pytest.fixture(scope="module")
def model(spark):
    rnd = random.Random(52)
    docs = []
    for i in range(60):
        lang = list(SENTENCES)[i % 3]
        docs.append((i, article(" ".join(rnd.choices(SENTENCES[lang], k=6))), "ru" if i == 3 else lang))
    ref = [(k, s) for k, v in SENTENCES.items() for s in v]
    return languages.fit(spark.createDataFrame(docs, "doc_id long, text string, lang string"), spark.createDataFrame(ref, "lang string, sentence string"))


def found(spark, model, texts, labels=None):
    df = spark.createDataFrame([(i, t, (labels or {}).get(i)) for i, t in enumerate(texts)], "doc_id long, text string, lang string").withColumn("best", F.lit(1))
    parts = languages.segments(df, model)
    return parts, {(r["doc_id"], r["lang"]) for r in languages.unnamed_languages(parts).collect()}


def test_documents_and_segments(spark, model):
    en, de, ru = (" ".join(SENTENCES[k][:4]) for k in ("en", "de", "ru"))
    texts = [article(en), article(de), article(en + "\n\n\\begin{quote}\n" + " ".join(SENTENCES["ru"][2:4]) + "\n\\end{quote}\n" + en), article(en + " " + SENTENCES["de"][0] + " " + en), article(en + "\n% " + SENTENCES["de"][0] + "\n% " + SENTENCES["de"][1] + "\n"), None, "", article("$x$"), "no sentence", ru]
    parts, got = found(spark, model, texts, {1: "GER", 2: "en-GB", 9: "Russian "})
    assert got == {(0, "en"), (2, "ru"), (3, "en"), (4, "en")}
    rows = parts.collect()
    assert [r["language"] for r in sorted((r for r in rows if r["doc_id"] == 2), key=lambda r: r["segment"])] == ["en", "ru", "en"]
    assert {r["doc_id"] for r in rows} == set(range(len(texts))) and all(r["confidence"] is None or 0.99 <= r["confidence"] <= 1 for r in rows)
    assert {r["doc_id"] for r in rows if r["language"] is None} >= {5, 6, 7}
    whole = {r["doc_id"]: r for r in languages.document_languages(parts).collect()}
    assert whole[2]["language"] == "en" and whole[2]["n_languages"] == 2 and whole[2]["confidence"] < 0.9 and whole[7]["language"] is None
    assert languages.segments(spark.createDataFrame([], "doc_id long, text string, lang string"), model).count() == 0


def test_no_documents_and_no_reference(spark):
    docs, ref = spark.createDataFrame([(1, "One. Two.", None)], "doc_id long, text string, lang string"), spark.createDataFrame([(k, s) for k, v in SENTENCES.items() for s in v], "lang string, sentence string")
    none = languages.fit(docs, ref.limit(0))
    assert [(r["segment"], r["language"]) for r in languages.segments(docs, none).collect()] == [(1, None)] and languages.unnamed_languages(languages.segments(docs, none)).count() == 0
    alone = languages.fit(docs.limit(0), ref)
    assert found(spark, alone, [" ".join(SENTENCES["de"])])[1] == {(0, "de")}


def test_long_text(spark, model):
    _, got = found(spark, model, [article(" ".join(SENTENCES["de"] * 4000)), "x" * 200_000])
    assert got == {(0, "de")}


def test_labels(spark):
    names = [("en_US", "en"), (" Deutsch", "de"), ("fre", "fr"), ("pt-BR", "pt"), ("xx", "xx"), ("nl-BE", "nl"), ("", None), (None, None), ("Русский", "ru"), ("und", "und")]
    df = spark.createDataFrame(names, "l string, want string")
    assert df.filter(~languages.named_language("l").eqNullSafe(F.col("want"))).count() == 0


def test_model_is_a_distribution(model):
    assert np.allclose(model.p.sum(axis=0), 1) and (model.p > 0).all() and math.isfinite(np.log(model.p).sum())


def test_places_cut_the_source(spark, model):
    de, ru = " ".join(SENTENCES["de"][:2]), " ".join(SENTENCES["ru"][2:4])
    marked = de.replace("ö", '\\"o').replace("ß", "{\\ss}")
    text = article("Intro $x<y$ % gone\n" + " ".join(SENTENCES["en"][:3]) + " \\textbf{" + marked + "} \\cite{a}\n" + ru + "\n\\begin{figure}\\caption{" + " ".join(SENTENCES["en"][3:]) + "}\\end{figure}")
    df = spark.createDataFrame([(1, text, "en"), (2, None, None), (3, ru, "ru")], "doc_id long, text string, lang string")
    rows = languages.segments(df, model, places=True).orderBy("doc_id", "segment").collect()
    cut = [(r["doc_id"], r["language"], (text if r["doc_id"] == 1 else ru)[r["start"] : r["end"]]) for r in rows if r["language"]]
    assert [c[:2] for c in cut] == [(1, "en"), (1, "de"), (1, "ru"), (1, "en"), (3, "ru")]
    assert cut[0][2].endswith(SENTENCES["en"][2]) and cut[1][2] == marked and cut[2][2] == ru and cut[3][2] == " ".join(SENTENCES["en"][3:]) and cut[4][2] == ru
    assert all(r["start"] is None for r in rows if r["language"] is None)


def test_a_language_without_known_names(spark):
    nl = ["De bibliotheek gaat om negen uur open.", "Zij vroeg of de trein al vertrokken was.", "Niemand wist nog wie de brief geschreven had.", "Wij liepen een uur langs de rivier."]
    ref = [(k, s) for k, v in SENTENCES.items() for s in v] + [("nl", s) for s in nl]
    model = languages.fit(spark.createDataFrame([], "doc_id long, text string, lang string"), spark.createDataFrame(ref, "lang string, sentence string"))
    assert "nl" in model.languages
    assert found(spark, model, [" ".join(nl), " ".join(nl), " ".join(SENTENCES["de"])], {0: "NL_be", 1: "de", 2: "nl"})[1] == {(1, "nl"), (2, "de")}

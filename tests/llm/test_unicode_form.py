import unicodedata

from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from folioflow.llm import unicode_form as U
from tests.llm import helpers as H

SAME = ["Déjà vu Effect", "Déjà vu Effect", "Ｄéjà　vu Effect", "D​éjà ﻿vu Efﬀect".replace("Efﬀect", "Eﬀect"), "Dеjà vu Effect".replace("е", "é"), " Déjà\tvu\n Effесt"]


def test_equal_reading_is_one_form():
    assert {U.canonical(t) for t in SAME} == {"Déjà vu Effect"}


def test_what_reads_differently_stays_apart():
    texts = ["Role", "Rôle", "role", "Role?", "α-Role", "Ω Role", "Ro le", "Rо1e"]
    assert len({U.canonical(t) for t in texts}) == len(texts)
    assert U.canonical("Ω Σ п λ") == "Ω Σ п λ"
    assert U.folded("STRASSE") == U.folded("Straße") == "strasse"


def test_every_look_alike_reaches_its_letter():
    assert {k: U.canonical(k) for k in U.LOOKALIKES} == U.LOOKALIKES
    assert U.canonical("Dependen\u03f2y \u03f9ase") == "Dependency Case"
    assert U.canonical("\u03c3\u03c2 \u03a3") == "\u03c3\u03c2 \u03a3"  # other sigmas have no Latin shape


def test_look_alikes_under_accents_are_composed():
    same = ["\u00e9\u00eb", "e\u0301e\u0308", "\u0435\u0301\u0435\u0308", "\u0435\u0301\u0451", "\u0435\u200b\u0301\u0451"]
    assert {U.canonical(t) for t in same} == {"\u00e9\u00eb"}
    assert U.canonical("\u0439\u03ae") == U.canonical("\u0438\u0306\u03b7\u0301") == "\u0439\u03ae"  # no Latin shape below the accent


@given(st.text(max_size=40))
def test_a_form_is_its_own_form(t):
    form = U.canonical(t)
    assert U.canonical(form) == form and form == unicodedata.normalize("NFKC", form)
    assert U.canonical("​".join(t)) == U.canonical(t) or not t.isascii()


def test_columns_agree_with_the_function(spark):
    texts = [*SAME, "", "  ", None, "plain  ascii\x0ctext ", "x" * 200_000 + "é​", "\x1c a"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = df.select(U.canonical_form(F.col("t")).alias("c"), U.folded_form(F.col("t")).alias("f"), "i").orderBy("i").collect()
    assert [(r.c, r.f) for r in got] == [(None, None) if t is None else (U.canonical(t), U.folded(t)) for t in texts]


def brute(titles, pages):
    recs = {("title", p, p, t) for p, t in titles if p and t} | {("clean_text", f"{p}#{n}", p, t) for p, n, t in pages if p and t}
    return {(a[0], a[1], b[1]) for a in recs for b in recs if a[0] == b[0] and a[1] < b[1] and a[2] != b[2] and a[3] != b[3] and U.canonical(a[3]) == U.canonical(b[3]) != ""}


def test_pairs_against_brute_force(spark):
    titles = [("a", "Title one"), ("a", "Title one"), ("b", "Title one"), ("c", "Title one"), ("d", "title one"), ("e", None), ("f", ""), ("g", "​"), (None, "Title one"), ("h", "Tіtle one")]
    pages = [("a", 1, "text\nhere"), ("b", 1, "text here"), ("b", 1, "text here"), ("b", 2, "teхt here"), ("a", 2, "text​ here"), ("c", 1, None), ("c", 2, "")]
    papers = H.clash(spark.createDataFrame([H.paper(p, t) for p, t in titles], H.PAPERS))
    content = H.clash(spark.createDataFrame([H.page(p, n, t) for p, n, t in pages], H.PAGES))
    got = U.same_reading_pairs(papers, content).collect()
    assert len(got) == len(set(map(tuple, got))) and set(map(tuple, got)) == brute(titles, pages)
    assert U.same_reading_pairs(papers.limit(0), content.limit(0)).count() == 0
    assert U.forms(papers, content).where("key = 'b#1'").first().form == "text here"


def test_a_large_class_without_differences_makes_no_pairs(spark):
    papers = spark.createDataFrame([H.paper(f"p{i}", "The same notice") for i in range(3000)], H.PAPERS)
    assert U.same_reading_pairs(papers, spark.createDataFrame([], H.PAGES)).count() == 0

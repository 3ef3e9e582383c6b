import random
import string

import pytest

from folioflow.llm import names as N
from tests.llm import helpers as H

SHORT = [("Frederick", "Fred"), ("Frederick", "Fritz"), ("Winifred", "Freddie"), ("Alexander", "Alex"), ("Alexandra", "Alex")]


def pairs(spark, names, forms=SHORT):
    papers = H.clash(spark.createDataFrame([H.paper(f"p{i}", authors=[n]) for i, n in enumerate(names)], H.PAPERS))
    return {frozenset(r) for r in N.variant_pairs(papers, spark.createDataFrame(forms, H.FORMS)).collect()}


def distance(a, b):
    """Edits, a swap of neighbours counting one, as a table."""
    d = [[max(i, j) if 0 in (i, j) else 0 for j in range(len(b) + 1)] for i in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            d[i][j] = min(d[i - 1][j] + 1, d[i][j - 1] + 1, d[i - 1][j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                d[i][j] = min(d[i][j], d[i - 2][j - 2] + 1)
    return d[-1][-1]


@pytest.mark.parametrize("shard", [5000, 3])
@pytest.mark.parametrize("most", [1, 2])
def test_trie_join_against_brute_force(spark, most, shard):
    rng = random.Random(most)
    words = {"".join(rng.choice("abc") for _ in range(rng.randrange(3, 8))) for _ in range(150)} | {"kamadapir", "kamadpair", "kamadapri", "akmadapir", "kmadapir", "kamadapirr", "x", ""} - {""}
    df = spark.createDataFrame([(w,) for w in words] * 2, "word string")
    got = {tuple(r) for r in N.near_words(df, most, shard).collect()}
    assert got == {(a, b) for a in words for b in words if a != b and distance(a, b) <= most}


FREDERICK = ["Frederick Kamadapir", "KAMADAPIR Frederick", "Kamadapir, Frederick", "Fred Kamadapir", "Fritz Kamadapir", "F. Kamadapir", "Kamadapir F", "Kamadapir, F.", "Dr. Frederick Kamadapir", "Frederick Kamadapir1,2", "Frederick Kamadapir*", "Frederick  Kamadapir", "Frederick Kamadapír", "Fredreick Kamadapir", "Frederick Kamdapir", "FREDERICK KAMADAPIR"]


def test_all_spellings_of_one_person(spark):
    got = pairs(spark, [*["Frederick Kamadapir"] * 3, *FREDERICK])
    assert got == {frozenset((a, b)) for a in FREDERICK for b in FREDERICK if a != b}


def test_a_slip_in_the_surname_beside_an_initial(spark):
    names = ["Frederick Kamadapir", "F. Kamadpair", "Kamadapirr, F."]
    assert pairs(spark, names) == {frozenset((a, b)) for a in names for b in names if a != b}
    assert pairs(spark, ["Frederick Kamadapir", "G. Kamadpair"]) == set()
    # It fits two people, so it is neither; its own spellings stay together.
    assert pairs(spark, ["Frederick Kamadapir", "Florence Kamadapir", "F. Kamadpair", "Kamadpair, F."]) == {frozenset(("F. Kamadpair", "Kamadpair, F."))}


def test_other_people_stay_apart(spark):
    assert pairs(spark, ["Anna B. Kamadapir", "Anna C. Kamadapir", "Anna Lomeseval", "Berta Kamadapir", "Anna Kamadapor Lo"]) == set()
    assert pairs(spark, ["F. Kamadapir", "Frederick Kamadapir", "Florence Kamadapir"]) == set()  # the initial fits both
    assert pairs(spark, ["Anna B. Kamadapir", "Anna C. Kamadapir", "Anna Kamadapir"]) == set()
    assert pairs(spark, ["Anna B. Kamadapir", "Anna Kamadapir"]) == {frozenset(("Anna B. Kamadapir", "Anna Kamadapir"))}
    assert pairs(spark, ["Ann Li", "Anna Li", "Ana Li"]) == set()  # too short for a slip


def test_well_known_names_are_not_slips_of_each_other(spark):
    """Mario and Marta are one letter from Maria, two from each other, and Marja is a slip of one of them."""
    others = [f"{g} {x}kovadin" for g in ("Maria", "Mario", "Marta") for x in ("Tele", "Rafi", "Sumo", "Gade")]
    names = others * 2 + ["Maria Silva"] * 6 + ["Mario Silva"] * 3 + ["Marta Silva"] * 2 + ["Maira Silva"]
    assert pairs(spark, names) == {frozenset(("Maria Silva", "Maira Silva"))}
    assert pairs(spark, ["Maria Silva", "Mario Silva", "Marta Silva"]) == set()  # nothing says which is which
    forms = [("Maria", "Mia"), ("Mario", "Marek")]
    assert pairs(spark, ["Maria Silva"] * 9 + ["Mario Silva"], forms) == set()  # known as two names


def test_slips_in_short_words_need_support(spark):
    names = ["Chen Wei"] * 8 + ["Chne Wei"] + ["Tsai Mo"] * 3 + ["Tasi Mo"] * 2 + ["Anna Li"] * 9 + ["Anna Lo"]  # two letters are never a slip
    assert pairs(spark, names) == {frozenset(("Chen Wei", "Chne Wei"))}


def test_persons_of_three_names(spark):
    one = ["Anna Maria Kamadapir", "Anna M. Kamadapir", "Kamadapir, Anna Maria", "A. M. Kamadapir", "Anna Kamadapir"]
    apart = ["Ulla Maria Lomeseval", "Ulla Berta Lomeseval"]
    van = ["Jan van der Zabolopan", "J. van der Zabolopan"]
    got = pairs(spark, [*one, *apart, *van, "Berta van der Zabolopan"])
    assert got == {frozenset((a, b)) for a in one for b in one if a != b} | {frozenset(van)}
    assert N.parse_kind("Kamadapir Institute")[0] and not N.parse_kind("Anna Maria Kamadapir")[0]


def test_planted_slips(spark):
    """Recall and precision over names of a closed list of given names with one slip each."""
    rng = random.Random(11)
    word = lambda k: "".join(rng.choice("bdfgklmnprstvz") + rng.choice("aeiou") for _ in range(k))
    given = sorted({word(3).title() for _ in range(25)})
    people = sorted({f"{rng.choice(given)} {word(4).title()}" for _ in range(300)})
    names, true = [], set()
    for p in people:
        names += [p] * rng.randrange(2, 5)
        if rng.random() < 0.4:
            i = rng.randrange(1, len(p) - 1)
            q = p[:i] + p[i + 1] + p[i] + p[i + 2 :]
            if " " not in p[i : i + 2] and q != p:
                names.append(q)
                true.add(frozenset((p, q)))
    got = pairs(spark, names)
    assert len(got & true) >= 0.95 * len(true) > 50 and len(got & true) >= 0.95 * len(got)


def test_a_short_form_of_several_names_takes_the_known_one(spark):
    assert pairs(spark, ["Alex Kamadapir", "Alexandra Kamadapir", "Alexander Lomeseval"]) == {frozenset(("Alex Kamadapir", "Alexandra Kamadapir"))}


def test_organisations(spark):
    one = ["Sesidasis Laboratory for Computational Research", "SESIDASIS LABORATORY FOR COMPUTATIONAL RESEARCH", "The Sesidasis Laboratory of Computational Research", "Laboratory for Computational Research, Sesidasis", "Sesidasis Lab for Comp. Research", "Sesidasis Lab for Computational Research Team", "Seidasis Laboratory for Computational Research"]
    other = ["Sesidasis University for Computational Research", "Zabolopan Laboratory for Computational Research", "Zabolopan Laboratory for Speech Technology"]
    assert pairs(spark, [*one[:1] * 3, *one, *other]) == {frozenset((a, b)) for a in one for b in one if a != b}


def test_slips_of_a_name_that_is_rarer_than_they_are(spark):
    """Two slips and the name between them, the name being the rarest."""
    names = ["Bevekofath Kamadapir"] + ["Beekofath Kamadapir"] * 4 + ["Bevekofath Kamaadapir"] * 3
    assert len(pairs(spark, names)) == 3


def test_bad_rows(spark):
    papers = spark.createDataFrame([H.paper("a", authors=None), H.paper("b", authors=[]), H.paper("c", authors=[None, "", "  ", "*", "1", "B.", "Prof."]), H.paper(None, authors=["Anna Kamadapir"]), H.paper("d", authors=["x" * 20_000 + " y" * 500])], H.PAPERS)
    forms = spark.createDataFrame([(None, "x"), ("y", None)], H.FORMS)
    assert N.variant_pairs(H.clash(papers), H.clash(forms)).count() == 0
    assert N.variant_pairs(papers.limit(0), forms.limit(0)).count() == 0


def test_one_surname_holds_most_names(spark):
    rng = random.Random(8)
    given = ["".join(rng.choice(string.ascii_lowercase) for _ in range(9)).title() for _ in range(1500)]
    got = pairs(spark, [f"{g} Kamadapir" for g in given] + [f"Kamadapir, {g}" for g in given[:100]])
    assert {frozenset((f"{g} Kamadapir", f"Kamadapir, {g}")) for g in given[:100]} <= got and len(got) <= 110

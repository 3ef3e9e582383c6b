import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from folioflow.functions import text


def column(spark, f, values):
    df = spark.createDataFrame(list(enumerate(values)), "i int, x string")
    return [r.y for r in df.select("i", f(F.col("x")).alias("y")).orderBy("i").collect()]


def reference_clean(raw):
    """The same rules as a row-wise loop."""
    t = unicodedata.normalize("NFKC", raw)
    t = re.sub(r"\b([A-Za-z]{3,})-\n([a-z]{2,5})\b", r"\1\2", t)
    out, blank = [], True
    for line in t.splitlines():
        line = re.sub(r"[ \t]+", " ", line).strip()
        if line or not blank:
            out.append(line)
        blank = not line
    return "\n".join(out).strip()


CASES = ["", "  \n\n a", "eﬃcient ﬁnd it", "a\r\nb\x0cc\x1cd\x85e", "one \t two\n\n\n\n three  \n", "exper-\niment", "well-\nknown", "pre-\nTraining", "abc-\nabcdef", "ab-\ncd", "a\n \n \t\nb", "　x \n y", "é" * 3000]


def test_clean_text(spark):
    assert column(spark, text.clean_text, [*CASES, None]) == [*map(reference_clean, CASES), None]


def test_quality_boundaries(spark):
    q = lambda x: text.quality(x)["good"]
    assert column(spark, q, ["a" * 79, "a" * 80, "a " * 80, "a" * 85 + "\x01" * 15, "a" * 84 + "\x01" * 16, "a" * 98 + "�" * 2, "a" * 99 + "�", ""]) == [False, True, True, True, False, False, True, False]


def test_edges(spark):
    f = lambda x: F.array_join(text.edge_indexes(text.lines(x)).cast("array<string>"), ",")
    many = "\n".join(f"l{i}" for i in range(10))
    assert column(spark, f, ["", "a", "a\n\nb", many, "\n \n"]) == ["", "0", "0,2", "0,1,2,7,8,9", ""]


def test_noise_key(spark):
    assert column(spark, text.noise_key, [" Page  12 of 30 ", "A1 b2", "", "see http://x", "x" * 120, "x" * 121]) == ["page <number> of <number>", "a1 b2", None, None, "x" * 120, None]


@pytest.mark.parametrize("line, yes", [
    ("Abstract", True), ("Results:", True), ("3.2 Training Setup", True), ("A.1 Prompt Details", True), ("Appendix B More", True), ("Table 1 Results", False), ("Figure 2 X", False),
    ("1 " + "Word " * 13, True), ("1 " + "Word " * 14, False), ("a new approach", True), ("plain sentence here", False), ("", False), ("1 lower", False), ("x" * 121, False),
])
def test_headings(spark, line, yes):
    assert column(spark, text.is_heading, [line]) == [yes]


def test_urls(spark):
    f = lambda x: F.array_join(text.urls(x, F.array(F.lit("https://z.org/a."), F.lit("ftp://no"))), " ")
    assert column(spark, f, ["(https://a.b/c). https://a.b/c, http://d.e/f?g=1]"]) == ["https://a.b/c http://d.e/f?g=1 https://z.org/a."]
    urls = ["https://www.github.com/x", "https://github.com:443/x", "https://a.github.io", "https://doi.org/1", "https://dx.doi.org/1", "http://Kaggle.com/x", "https://notgithub.com"]
    assert column(spark, text.is_artifact_url, urls) == [True, False, True, False, False, True, False]


def test_scalars(spark):
    assert column(spark, text.paper_id_from_url, ["https://x.org/2026.a-b.1/", "https://x.org/p/q.pdf?z=1#k", "https://x.org/p;v=1", "https://x.org"]) == ["2026.a-b.1", "q", "p", ""]
    assert column(spark, lambda x: text.year_of(x), ["in 1999/2001", "x2020", "2020-05", "21999", ""]) == [1999, None, 2020, None, None]
    assert column(spark, text.blank_to_null, ["  x　", "  ", None]) == ["x", None, None]


def test_natural_order(spark):
    names = ["p.100", "p.2", "p.10", "10a", "9b", "P.3"]
    df = spark.createDataFrame([(n,) for n in names], "x string").withColumn("k", text.natural_key(F.col("x"))).orderBy("k")
    assert [r.x for r in df.collect()] == ["9b", "10a", "p.2", "P.3", "p.10", "p.100"]

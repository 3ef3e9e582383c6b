import random

import pytest
from pyspark.sql import functions as F

from folioflow.functions import layout, tables

BLOCK = "paper_id string, page_number int, block_no int, x0 double, x1 double, y0 double, text string, block_type int, page_width double"


def row_wise(blocks, width):
    """Reading order as a loop over regions between wide blocks."""
    wide = sorted((b for b in blocks if b[4] - b[3] >= width * 0.7), key=lambda b: (b[5], b[3], b[2]))
    rest = [b for b in blocks if b not in wide]
    side = lambda b: (b[3] + b[4]) / 2 >= width / 2
    top = lambda b: (b[5], b[3], b[2])
    if sum(not side(b) for b in rest) < 2 or sum(map(side, rest)) < 2:
        return [b[2] for b in sorted(blocks, key=top)]
    out, left = [], list(rest)
    for w in [*wide, None]:
        now = [b for b in left if w is None or b[5] < w[5]]
        out += [b[2] for b in sorted(now, key=lambda b: (side(b), *top(b)))]
        left = [b for b in left if b not in now]
        out += [w[2]] if w else []
    return out


def test_reading_order_against_a_loop(spark):
    rng = random.Random(1)
    rows, want = [], {}
    for page in range(300):
        n = rng.randrange(1, 9)
        blocks = []
        for b in range(n):
            x0 = rng.choice([0, 10, 300, 320])
            blocks.append((f"p{page}", 1, b, float(x0), float(x0 + rng.choice([100, 200, 450])), float(rng.randrange(6) * 10), f"t{b}", 0, 600.0))
        rows += blocks
        want[f"p{page}"] = row_wise(blocks, 600)
    got: dict = {}
    for r in layout.reading_order(spark.createDataFrame(rows, BLOCK)).orderBy("paper_id", "position").collect():
        got.setdefault(r.paper_id, []).append(r.block_no)
    assert got == want


def test_blank_and_picture_blocks_are_left_out(spark):
    rows = [("p", 1, 0, 0.0, 10.0, 5.0, " b ", 0, 600.0), ("p", 1, 1, 0.0, 10.0, 1.0, "a", 0, 600.0), ("p", 1, 2, 0.0, 10.0, 2.0, " \n", 0, 600.0), ("p", 1, 3, 0.0, 10.0, 2.0, "pic", 1, 600.0)]
    assert [r.raw_text for r in layout.layout_text(spark.createDataFrame(rows, BLOCK)).collect()] == ["a\n\nb"]
    assert layout.layout_text(spark.createDataFrame([], BLOCK)).collect() == []


def score(spark, cells, rows, cols):
    df = spark.createDataFrame([(cells, rows, cols)], "c array<array<string>>, r int, k int")
    return tuple(df.select(tables.complexity(F.col("c"), F.col("r"), F.col("k")), tables.confidence(F.col("c"), F.col("r"), F.col("k"))).first())


@pytest.mark.parametrize("cells, rows, cols, want", [
    ([["a", "b"], ["c", "d"]], 2, 2, (0.0, 1.0)), ([["a"] * 5] * 10, 10, 5, (0.20 + 0.15, 1.0)), ([["a", ""], ["b", None]], 2, 2, (0.20, 0.75)), ([["a\nb", "c"], ["d", "e"]], 2, 2, (0.15, 1.0)),
    ([["a"], ["b", "c"]], 2, 2, (0.30, 0.85)), ([["a"]], 1, 1, (0.0, 0.85)), ([], 0, 0, (0.0, 0.0)), ([["a"], ["b"], ["c", "d"]], 3, 2, (0.30, 0.7)),
])
def test_table_scores(spark, cells, rows, cols, want):
    assert score(spark, cells, rows, cols) == want


def test_exactly_the_threshold_is_not_poor(spark):
    df = spark.createDataFrame([(0.15 + 0.15 + 0.30, 1.0), (0.0, 1.0 - 0.30), (0.0, 0.699)], "c double, f double")
    assert [r[0] for r in df.select(tables.visual_reason(F.col("c"), F.col("f"))).collect()] == ["complex_table", None, "poor_table_extraction"]


def test_captions_and_ids(spark):
    rows = [("x\n Table  2a: y ", "Table 9"), ("nothing", "TABLE 3b"), ("Stable 4", ""), (None, None)]
    df = spark.createDataFrame(rows, "a string, b string").withColumn("c", tables.caption(F.col("a"), F.col("b")))
    got = [(r.c, r.i) for r in df.select("c", tables.table_id(F.col("c"), F.lit(7), F.lit(1)).alias("i")).collect()]
    assert got == [("Table 2a: y", "Table 2A"), ("TABLE 3b", "Table 3B"), (None, "page_7_table_1"), (None, "page_7_table_1")]

import random
import re
from collections import defaultdict

import pytest

from folioflow.llm import boilerplate as B
from tests.llm import helpers as H

NOTE = "Copies of this paper may be made for classroom use, number {}"


def brute(pages, papers, min_papers=5, share=0.2):
    venue = {p: v for p, v in papers if v is not None and p is not None}
    size = defaultdict(int)
    for p in venue:
        size[venue[p]] += 1
    key = lambda x: re.sub(r"[^a-zé]", "", x.lower())
    seen = defaultdict(set)
    for p, n, t in pages:
        for x in (t or "").split("\n"):
            if p in venue and len(x.strip()) >= 25 and key(x):
                seen[venue[p], key(x)].add(p)
    return {(p, n, i) for p, n, t in pages if p in venue for i, x in enumerate((t or "").split("\n"), 1) if len(x.strip()) >= 25 and key(x) and len(seen[venue[p], key(x)]) >= max(min_papers, share * size[venue[p]])}


def tables(spark, pages, papers):
    return H.clash(spark.createDataFrame([H.page(p, n, t) for p, n, t in pages], H.PAGES)), H.clash(spark.createDataFrame([H.paper(p, venue=v) for p, v in papers], H.PAPERS))


def test_lines_against_brute_force(spark):
    rng = random.Random(5)
    papers = [(f"p{i}", rng.choice(["V", "V", "V", "W", None])) for i in range(60)] + [("q", "tiny")]
    lines = [NOTE, "SHARE THIS PAPER with your team, code {}", "The authors thank the readers for their comments", "short {}", "Été comme hiver nous remercions les lecteurs {}", "1234567890 1234567890 1234567890"]
    pages = []
    for p, _ in papers:
        for n in (1, 2):
            body = [f"unique text of {p} line {rng.random()} goes here and on" + chr(97 + rng.randrange(26)) * rng.randrange(9) for _ in range(4)]
            for x in lines:
                if rng.random() < 0.35:
                    body.insert(rng.randrange(len(body) + 1), x.format(rng.randrange(999)).swapcase() if rng.random() < 0.3 else "  " + x.format(rng.randrange(999)))
            pages.append((p, n, "\n".join(body)))
    content, listed = tables(spark, pages + pages[:10], papers + papers[:5])
    got = B.repeated_lines(content, listed).select("paper_id", "page_number", "line_no").collect()
    assert len(got) == len(set(map(tuple, got))) and set(map(tuple, got)) == brute(pages, papers)


def test_blocks_have_their_whole_length(spark):
    block = [f"Notice part {chr(97 + i)}{chr(97 + i)}{chr(98 + i)} of the long legal notice" for i in range(20)]
    pages = [(f"p{i}", 1, "\n".join(["own words of " + "abcdefghij"[i] * 20, *block, "the end of " + "abcdefghij"[i] * 20])) for i in range(10)]
    content, listed = tables(spark, pages, [(p, "V") for p, _, _ in pages])
    got = {(r.paper_id, r.line_no): r.block for r in B.repeated_lines(content, listed).collect()}
    assert got == {(f"p{i}", n): 22 - n for i in range(10) for n in range(2, 22)}
    texts = {r.paper_id: (r.clean_text, r.lines_removed) for r in B.strip_pages(content, listed).collect()}
    assert texts["p3"] == ("own words of " + "d" * 20 + "\nthe end of " + "d" * 20, 20)


def brute_blocks(rows, least):
    """(page, line_no) -> the longest beginning of its suffix that suffixes of enough papers share."""
    seen = defaultdict(set)
    for _, paper, _, _, suffix in rows:
        for n in range(1, len(suffix) + 1):
            seen[tuple(suffix[:n])].add(paper)
    best = {(page, line): max((n for n in range(1, len(s) + 1) if len(seen[tuple(s[:n])]) >= least), default=0) for page, _, _, line, s in rows}
    return {k: n for k, n in best.items() if n}


@pytest.mark.parametrize("parts", [1, 7, 40])
def test_array_over_any_number_of_partitions(spark, parts):
    """Ranges that end inside a partition, cross a boundary or cover whole partitions, against sets of all prefixes."""
    rng = random.Random(parts)
    rows, notice = [], [1, 2, 3, 4, 5, 6]
    for page in range(160):
        ids = [rng.randrange(7, 60) for _ in range(rng.randrange(4))] + notice[rng.choice([0, 0, 0, 2]) : rng.choice([6, 6, 3, 4])] + [rng.randrange(7, 12) for _ in range(rng.randrange(3))]
        rows += [(page, page // 2, 6, i + 1, ids[i:]) for i in range(len(ids))]
    df = spark.createDataFrame(rows, B._SUFFIX)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ranged = df.repartitionByRange(parts, "suffix", "page", "line_no").sortWithinPartitions("suffix", "page", "line_no")
        got = {(r.page, r.line_no): r.block for r in B.repeated_blocks(ranged).collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert got == brute_blocks(rows, 6)


def test_only_the_array_decides(spark):
    """In another order, where equal beginnings are no neighbours, nothing is found."""
    pages = [(f"p{i:02}", 1, NOTE.format(i) + "\nown text of the paper number " + "abcdefghijklmnopqrstuvwxyz"[i]) for i in range(20)]
    content, listed = tables(spark, pages, [(p, "V") for p, _, _ in pages])
    _, suffixes = B.suffix_array(content, listed)
    assert B.repeated_blocks(suffixes).count() == 20
    assert B.repeated_blocks(suffixes.repartition(1).sortWithinPartitions("page", "line_no")).count() == 0


def test_repeats_within_one_paper_do_not_count(spark):
    pages = [("p0", n, NOTE.format(n)) for n in range(30)] + [(f"p{i}", 1, "x") for i in range(1, 5)]
    content, listed = tables(spark, pages, [(f"p{i}", "V") for i in range(5)])
    assert B.repeated_lines(content, listed).count() == 0


def test_bad_rows(spark):
    pages = [("a", 1, None), ("a", 2, ""), (None, 1, NOTE), ("a", None, NOTE), ("nowhere", 1, NOTE), ("b", 1, "w " * 300_000)]
    content, listed = tables(spark, pages, [("a", "V"), ("b", None), (None, "V")])
    assert B.repeated_lines(content, listed).count() == 0
    kept = {(r.paper_id, r.page_number): r.clean_text for r in B.strip_pages(content, listed).collect()}
    assert kept["a", 1] is None and kept["a", 2] == "" and kept["nowhere", 1] == NOTE and len(kept) == 6
    assert B.repeated_lines(content.limit(0), listed.limit(0)).count() == 0 == B.strip_pages(content.limit(0), listed).count()


def test_identical_pages_of_one_venue(spark):
    """Every page is a copy of one long page: one group holds all rows."""
    text = "\n".join(f"line {chr(97 + i % 26)}{chr(97 + i // 26)} of the very same page everywhere" for i in range(120))
    content, listed = tables(spark, [(f"p{i}", 1, text) for i in range(40)], [(f"p{i}", "V") for i in range(40)])
    assert B.repeated_lines(content, listed).count() == 40 * 120

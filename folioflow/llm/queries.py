"""The queries of the language-model operators over the project's tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from folioflow.llm import abuse, boilerplate, mcl, mixing, names, packing, scanrepair, termfreq, tokens, unicode_form
from folioflow.session import cut, table

Query = Callable[[SparkSession, str], DataFrame]


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return unicode_form.same_reading_pairs(table(spark, d, "papers"), table(spark, d, "page_content"))


def p1_forms(spark: SparkSession, d: str) -> DataFrame:
    return unicode_form.forms(table(spark, d, "papers"), table(spark, d, "page_content"))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return mcl.groups(table(spark, d, "stored_vectors")).where("size > 1").select("embedding_id", "first_embedding_id")


def p2_clusters(spark: SparkSession, d: str) -> DataFrame:
    return mcl.described(table(spark, d, "stored_vectors"))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return termfreq.marked_terms(table(spark, d, "results"))


def p3_terms(spark: SparkSession, d: str) -> DataFrame:
    return termfreq.term_table(table(spark, d, "results"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return scanrepair.noisy_lines(table(spark, d, "page_content"), table(spark, d, "papers"))


def p4_pages(spark: SparkSession, d: str) -> DataFrame:
    return scanrepair.repaired_pages(table(spark, d, "page_content"), table(spark, d, "papers"))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return boilerplate.repeated_lines(table(spark, d, "page_content"), table(spark, d, "papers")).select("paper_id", "page_number", "line_no").distinct()


def p6_pages(spark: SparkSession, d: str) -> DataFrame:
    return boilerplate.strip_pages(table(spark, d, "page_content"), table(spark, d, "papers"))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return names.variant_pairs(table(spark, d, "papers"), table(spark, d, "name_forms"))


def p7_entities(spark: SparkSession, d: str) -> DataFrame:
    return names.entities(table(spark, d, "papers"), table(spark, d, "name_forms"))


def p8_packed(spark: SparkSession, d: str) -> DataFrame:
    return packing.pack(tokens.token_counts(table(spark, d, "documents"), ["doc_id"]))


def p8_containers(spark: SparkSession, d: str) -> DataFrame:
    return packing.fill(p8_packed(spark, d))


def p9_mixed(spark: SparkSession, d: str) -> DataFrame:
    counted = tokens.token_counts(table(spark, d, "documents"), ["doc_id", "source"])
    return mixing.repeated(mixing.mixed(counted, table(spark, d, "mix_targets")))


def p9_shares(spark: SparkSession, d: str) -> DataFrame:
    counted, targets = cut(tokens.token_counts(table(spark, d, "documents"), ["doc_id", "source"])), table(spark, d, "mix_targets")
    return mixing.shares(mixing.mixed(counted, targets), counted, targets)


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return p10_scores(spark, d).where("abusive").select("doc_id").distinct()


def p10_scores(spark: SparkSession, d: str) -> DataFrame:
    return abuse.scores(table(spark, d, "documents"), table(spark, d, "doc_labels"))


def p10_rates(spark: SparkSession, d: str) -> DataFrame:
    return abuse.rates(p10_scores(spark, d))


QUERIES: dict[str, Query] = {f.__name__: f for f in (p1_found, p1_forms, p2_found, p2_clusters, p3_found, p3_terms, p4_found, p4_pages, p6_found, p6_pages, p7_found, p7_entities, p8_packed, p8_containers, p9_mixed, p9_shares, p10_found, p10_scores, p10_rates)}

_TERMS = r"""
WITH good AS (SELECT paper_id, response FROM results WHERE status = 'success' AND paper_id IS NOT NULL),
lists AS (
  SELECT 'datasets_benchmarks' AS field, paper_id, response.datasets_benchmarks.value AS value FROM good
  UNION ALL SELECT 'contribution_type', paper_id, response.contribution_type.value FROM good),
items AS (SELECT field, paper_id, unnest(regexp_split_to_array(lower(value), '[,;|\n\r]|\band\b')) AS item FROM lists),
terms AS (
  SELECT field, paper_id, regexp_replace(regexp_replace(regexp_replace(item, '\s+', ' ', 'g'),
    '^ ?(?:[-*+•·‣◦▪–—] ?|\(?[0-9]{1,2}[.)] )*', ''), '[ .]+$', '') AS term FROM items),
kept AS (SELECT * FROM terms WHERE term <> ''),
field_n AS (SELECT field, count(DISTINCT paper_id) AS field_papers FROM kept GROUP BY field),
counted AS (SELECT field, term, count(*) AS mentions, count(DISTINCT paper_id) AS papers FROM kept GROUP BY field, term)
SELECT field, term, mentions, papers, field_papers,
  CASE WHEN papers < 3 THEN 'rare' WHEN papers > 0.2::DOUBLE * field_papers THEN 'common' END AS mark
FROM counted JOIN field_n USING (field)
"""

_LINES = r"""
WITH v AS (SELECT DISTINCT paper_id, venue FROM papers WHERE venue IS NOT NULL),
need AS (SELECT venue, greatest(5, 0.2::DOUBLE * count(DISTINCT paper_id)) AS needed FROM v GROUP BY venue),
pages AS (SELECT DISTINCT paper_id, page_number, string_split(clean_text, chr(10)) AS ls FROM page_content WHERE clean_text IS NOT NULL),
lines AS (SELECT paper_id, page_number, unnest(ls) AS line, unnest(range(1, len(ls) + 1)) AS line_no FROM pages),
keyed AS (
  SELECT paper_id, page_number, CAST(line_no AS INTEGER) AS line_no,
    regexp_replace(lower(translate(line, '{wide}', '{latin}')), '[^\p{{L}}\p{{M}}]+', '', 'g') AS k
  FROM lines WHERE length(regexp_replace(line, '^\s+|\s+$', '', 'g')) >= 25),
often AS (SELECT venue, k FROM keyed JOIN v USING (paper_id) JOIN need USING (venue) WHERE k <> '' GROUP BY venue, k, needed HAVING count(DISTINCT paper_id) >= needed)
SELECT DISTINCT paper_id, page_number, line_no FROM keyed JOIN v USING (paper_id) JOIN often USING (venue, k)
"""


def oracle_sql() -> dict[str, str]:
    wide = boilerplate._WIDE + "".join(unicode_form.LOOKALIKES)
    latin = boilerplate._LATIN + "".join(unicode_form.LOOKALIKES.values())
    return {
        "p3_terms": _TERMS,
        "p3_found": f"SELECT field, term, mark FROM ({_TERMS}) WHERE mark IS NOT NULL",
        "p6_found": _LINES.format(wide=wide, latin=latin),
    }

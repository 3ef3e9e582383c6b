"""Queries of the text, layout, table and page operators over the project's tables, and their SQL.

Inputs that the tables lack (blocks, cells, images) are derived from the order tables by arithmetic
that both sides share.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow.functions import layout, tables, text
from folioflow.operators import pages as ops
from folioflow.session import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

S, B = text.SPACES, text.BLANKS


def query(sql: str | None = None):
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


def _pages(spark: SparkSession, d: str, *columns: str) -> DataFrame:
    return ops.one_per_page(table(spark, d, "page_content"), *columns)


_PG = "pg AS (SELECT DISTINCT paper_id, page_number, raw_text, clean_text FROM page_content WHERE paper_id IS NOT NULL AND page_number IS NOT NULL)"
_STRIP = lambda x: rf"regexp_replace({x}, '^[{S}]+|[{S}]+$', '', 'g')"
_LINES = lambda x: f"CASE WHEN coalesce({x}, '') = '' THEN [] WHEN ends_with({x}, chr(10)) THEN list_slice(string_split({x}, chr(10)), 1, -2) ELSE string_split({x}, chr(10)) END"
_EDGES = lambda ls: f"(SELECT list_sort(list_distinct(list_concat(f[1:3], f[-3:]))) FROM (SELECT list_filter(range(len({ls})), lambda i: {_STRIP(f'{ls}[i + 1]')} <> '') AS f))"
# RE2 looks neither ahead nor behind, so neighbouring numbers take two passes.
_MASK = lambda x: rf"regexp_replace({x}, '(^|[^\p{{L}}\p{{N}}_])\p{{Nd}}+($|[^\p{{L}}\p{{N}}_])', '\1<number>\2', 'g')"
_KEY = lambda x: rf"(SELECT CASE WHEN n = '' OR length(n) > 120 OR contains(n, 'http://') OR contains(n, 'https://') THEN NULL ELSE {_MASK(_MASK('n'))} END FROM (SELECT lower({_STRIP(rf'''regexp_replace({x}, '[{S}]+', ' ', 'g')''')}) AS n))"
_LIGATURES = lambda x: f"replace(replace(replace(replace(replace({x}, 'ﬁ', 'fi'), 'ﬂ', 'fl'), 'ﬀ', 'ff'), 'ﬃ', 'ffi'), 'ﬄ', 'ffl')"
_JOINED = lambda x: rf"regexp_replace({x}, '(^|[^\p{{L}}\p{{N}}_])([A-Za-z]{{3,}})-\n([a-z]{{2,5}})($|[^\p{{L}}\p{{N}}_])', '\1\2\3\4', 'g')"
_CLEAN = lambda x: _STRIP(rf"regexp_replace(regexp_replace(regexp_replace(regexp_replace({_JOINED(_LIGATURES(x))}, '{text.BREAK}', chr(10), 'g'), '[ \t]+', ' ', 'g'), '[{B}]*\n[{B}]*', chr(10), 'g'), '\n{{3,}}', chr(10) || chr(10), 'g')")
_HEADING = lambda x: rf"""(SELECT CASE WHEN t = '' OR length(t) > 120 THEN false ELSE
  regexp_replace(lower(t), ':+$', '') IN ({", ".join(f"'{k}'" for k in text.KNOWN_TITLES)})
  OR (NOT starts_with(lower(t), 'table ') AND NOT starts_with(lower(t), 'figure ') AND NOT starts_with(lower(t), 'fig. ')
      AND len(regexp_split_to_array(t, '[{S}]+')) <= 14 AND (regexp_matches(t, '{text.NUMBERED}') OR regexp_matches(t, '{text.APPENDIX}'))) END
  FROM (SELECT {_STRIP(x)} AS t))"""
_QUALITY = rf"""q AS (
  SELECT *, length(regexp_replace(raw, '[{S}]', '', 'g')) AS visible,
    length(regexp_replace(raw, '[^\p{{C}}]', '', 'g')) - length(regexp_replace(raw, '[^\x09-\x0d\x1c-\x1f\x{{85}}]', '', 'g')) AS unprintable,
    length(raw) - length(replace(raw, '�', '')) AS replaced
  FROM (SELECT *, coalesce(raw_text, '') AS raw FROM pg)),
good AS (SELECT *, CASE WHEN visible < 80 THEN false ELSE (visible - unprintable) / visible >= 0.85::DOUBLE AND replaced / visible < 0.02::DOUBLE END AS good FROM q)"""


@query(f"WITH {_PG} SELECT paper_id, page_number, {_CLEAN('raw_text')} AS text FROM pg")
def clean_text(spark: SparkSession, d: str) -> DataFrame:
    return _pages(spark, d, "raw_text").select("paper_id", "page_number", text.clean_text(F.col("raw_text")).alias("text"))


@query(f"WITH {_PG} SELECT paper_id, page_number, {_JOINED('clean_text')} AS text FROM pg")
def dehyphenate(spark: SparkSession, d: str) -> DataFrame:
    return _pages(spark, d, "clean_text").select("paper_id", "page_number", text.dehyphenate(F.col("clean_text")).alias("text"))


@query(f"WITH {_PG}, {_QUALITY} SELECT paper_id, page_number, visible, unprintable, replaced, good FROM good")
def page_quality(spark: SparkSession, d: str) -> DataFrame:
    q = text.quality(F.coalesce("raw_text", F.lit("")))
    return _pages(spark, d, "raw_text").select("paper_id", "page_number", q.alias("q")).select("paper_id", "page_number", "q.*")


@query(f"WITH {_PG}, l AS (SELECT *, {_LINES('clean_text')} AS ls FROM pg) SELECT paper_id, page_number, array_to_string({_EDGES('ls')}, ',') AS edges FROM l")
def edge_lines(spark: SparkSession, d: str) -> DataFrame:
    edges = text.edge_indexes(text.lines(F.coalesce("clean_text", F.lit(""))))
    return _pages(spark, d, "clean_text").select("paper_id", "page_number", F.array_join(edges.cast("array<string>"), ",").alias("edges"))


@query(f"WITH {_PG}, l AS (SELECT paper_id, page_number, unnest({_LINES('clean_text')}) AS line FROM pg) SELECT k AS noise_key, count(*) AS lines FROM (SELECT {_KEY('line')} AS k FROM l) WHERE k IS NOT NULL GROUP BY k")
def noise_key(spark: SparkSession, d: str) -> DataFrame:
    lines = _pages(spark, d, "clean_text").select(F.explode(text.lines(F.coalesce("clean_text", F.lit("")))).alias("line"))
    return lines.select(text.noise_key(F.col("line")).alias("noise_key")).where("noise_key is not null").groupBy("noise_key").agg(F.count("*").alias("lines"))


@query(f"""
WITH {_PG}, l AS (SELECT *, {_LINES('clean_text')} AS ls FROM pg), e AS (SELECT *, {_EDGES('ls')} AS edges FROM l),
k AS (SELECT DISTINCT paper_id, page_number, {_KEY('ls[i + 1]')} AS key FROM (SELECT *, unnest(edges) AS i FROM e)),
n AS (SELECT paper_id, count(*) AS pages FROM pg GROUP BY 1),
noisy AS (SELECT paper_id, key FROM k JOIN n USING (paper_id) WHERE key IS NOT NULL AND pages >= 3 GROUP BY paper_id, key, pages HAVING count(DISTINCT page_number) >= greatest(3, ceil(0.30::DOUBLE * pages))),
each AS (SELECT paper_id, page_number, unnest(ls) AS line, unnest(range(len(ls))) AS i, edges FROM e),
kept AS (SELECT * FROM each WHERE NOT (list_contains(edges, i) AND EXISTS (SELECT 1 FROM noisy z WHERE z.paper_id = each.paper_id AND z.key = {_KEY('each.line')}))),
texts AS (SELECT paper_id, page_number, {_STRIP("string_agg(line, chr(10) ORDER BY i)")} AS t FROM kept GROUP BY paper_id, page_number)
SELECT pg.paper_id, pg.page_number, CASE WHEN pg.clean_text IS NULL THEN NULL WHEN pg.paper_id IN (SELECT paper_id FROM noisy) THEN coalesce(t, '') ELSE pg.clean_text END AS clean_text
FROM pg LEFT JOIN texts USING (paper_id, page_number)""")
def repeated_noise(spark: SparkSession, d: str) -> DataFrame:
    return ops.repeated_noise(_pages(spark, d, "clean_text")).select("paper_id", "page_number", "clean_text")


@query(f"WITH {_PG}, l AS (SELECT paper_id, page_number, unnest({_LINES('clean_text')}) AS line FROM pg) SELECT {_STRIP('line')} AS heading, count(*) AS lines FROM l WHERE {_HEADING('line')} GROUP BY 1")
def heading_lines(spark: SparkSession, d: str) -> DataFrame:
    lines = _pages(spark, d, "clean_text").select(F.explode(text.lines(F.coalesce("clean_text", F.lit("")))).alias("line"))
    return lines.where(text.is_heading(F.col("line"))).groupBy(text.strip(F.col("line")).alias("heading")).agg(F.count("*").alias("lines"))


@query(f"""
WITH {_PG}, l AS (SELECT paper_id, page_number, {_LINES('clean_text')} AS ls FROM pg),
x AS (SELECT paper_id, page_number, unnest(ls) AS line, unnest(range(len(ls))) AS i FROM l),
h AS (SELECT paper_id, page_number, arg_min({_STRIP('line')}, i) AS first_h, arg_max({_STRIP('line')}, i) AS last_h FROM x WHERE {_HEADING('line')} GROUP BY 1, 2)
SELECT pg.paper_id, pg.page_number, coalesce(first_h, last_value(last_h IGNORE NULLS) OVER (PARTITION BY pg.paper_id ORDER BY pg.page_number ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) AS section
FROM pg LEFT JOIN h USING (paper_id, page_number)""")
def sections(spark: SparkSession, d: str) -> DataFrame:
    return ops.sections(_pages(spark, d, "clean_text")).select("paper_id", "page_number", "section")


_LINKED = "linked AS (SELECT paper_id, page_number, coalesce(raw_text, '') || ' see https://www.github.com/x/' || paper_id || '), https://doi.org/10.1/' || page_number || '. https://a.github.io/' || page_number || '; https://github.com:443/y!' AS raw FROM pg)"


def _linked(spark: SparkSession, d: str) -> DataFrame:
    """Pages with links appended: the tables have next to none."""
    number = F.col("page_number").cast("string")
    raw = F.concat(F.coalesce("raw_text", F.lit("")), F.lit(" see https://www.github.com/x/"), F.col("paper_id"), F.lit("), https://doi.org/10.1/"), number, F.lit(". https://a.github.io/"), number, F.lit("; https://github.com:443/y!"))
    return _pages(spark, d, "raw_text").select("paper_id", "page_number", raw.alias("raw"))


_URLS = r"""u AS (SELECT paper_id, page_number, unnest(list_distinct(list_transform(regexp_extract_all(raw, 'https?://[^\s<>()\[\]{}"'']+'), lambda x: regexp_replace(x, '[.,;:!?)\]}]+$', '')))) AS url FROM linked)"""


@query(f"WITH {_PG}, {_LINKED}, {_URLS} SELECT paper_id, page_number, url FROM u WHERE url <> ''")
def extract_urls(spark: SparkSession, d: str) -> DataFrame:
    return _linked(spark, d).select("paper_id", "page_number", F.explode(text.urls(F.col("raw"))).alias("url"))


@query(f"""WITH {_PG}, {_LINKED}, {_URLS}, h AS (SELECT *, regexp_replace(lower(regexp_extract(url, '://([^/?#]*)', 1)), '^www\\.', '') AS host FROM u)
SELECT paper_id, page_number, url FROM h WHERE host NOT IN ({", ".join(f"'{x}'" for x in text.DENIED_HOSTS)}) AND (host IN ({", ".join(f"'{x}'" for x in text.ARTIFACT_HOSTS)}) OR ends_with(host, '.github.io'))""")
def artifact_urls(spark: SparkSession, d: str) -> DataFrame:
    return extract_urls(spark, d).where(text.is_artifact_url(F.col("url")))


@query(f"WITH {_PG} SELECT paper_id, page_number, regexp_matches(coalesce(raw_text, ''), '{text.EQUATION}') AS equation FROM pg")
def equation_flag(spark: SparkSession, d: str) -> DataFrame:
    return _pages(spark, d, "raw_text").select("paper_id", "page_number", text.has_equation(F.coalesce("raw_text", F.lit(""))).alias("equation"))


@query("SELECT l_orderkey AS page, max(l_quantity * 10 * (l_linenumber * 50) / 480000.0::DOUBLE) AS ratio FROM lineitem GROUP BY 1")
def image_ratio(spark: SparkSession, d: str) -> DataFrame:
    image = F.struct((F.col("l_quantity") * 10).alias("w"), (F.col("l_linenumber") * 50).alias("h"))
    pages = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("page")).agg(F.collect_list(image).alias("images"))
    return pages.select("page", text.large_image_ratio(F.col("images"), F.lit(480000.0)).alias("ratio"))


_FACTS = "facts AS (SELECT *, (page_number % 10) / 10.0::DOUBLE AS image_ratio, length(coalesce(clean_text, '')) % 30 AS drawings, 'Fig. ' || page_number || chr(10) || coalesce(raw_text, '') AS captioned FROM pg)"


def _facts(pages: DataFrame) -> DataFrame:
    return pages.withColumn("image_ratio", (F.col("page_number") % 10) / F.lit(10.0)).withColumn("drawings", F.length(F.coalesce("clean_text", F.lit(""))) % 30)


@query(f"WITH {_PG}, {_FACTS} SELECT paper_id, page_number, image_ratio >= 0.05::DOUBLE OR drawings >= 20 AS figure FROM facts")
def figure_flag(spark: SparkSession, d: str) -> DataFrame:
    raw = F.concat(F.lit("Fig. "), F.col("page_number").cast("string"), F.lit("\n"), F.coalesce("raw_text", F.lit("")))
    return _facts(_pages(spark, d, "raw_text", "clean_text")).select("paper_id", "page_number", text.figure_candidate(raw, F.col("image_ratio"), F.col("drawings")).alias("figure"))


_BLOCKS = """blocks AS (SELECT CAST(l_orderkey AS VARCHAR) AS paper_id, 1 AS page_number, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_shipdate) AS INTEGER) AS block_no,
  CAST(l_partkey * 37 % 380 AS DOUBLE) AS x0, CAST(l_partkey * 37 % 380 + l_suppkey * 53 % 560 + 20 AS DOUBLE) AS x1, CAST(CAST(l_quantity AS BIGINT) * 13 % 90 AS DOUBLE) AS y0,
  l_returnflag || l_partkey AS t FROM lineitem),
w AS (SELECT *, x1 - x0 >= 600 * 0.70::DOUBLE AS wide, (x0 + x1) / 2 >= 300 AS right_ FROM blocks),
two AS (SELECT *, count(*) FILTER (NOT wide AND NOT right_) OVER p >= 2 AND count(*) FILTER (NOT wide AND right_) OVER p >= 2 AS two FROM w WINDOW p AS (PARTITION BY paper_id, page_number)),
region AS (SELECT *, CASE WHEN NOT two THEN 0 WHEN wide THEN (SELECT count(*) FROM two b WHERE b.paper_id = a.paper_id AND b.wide AND (b.y0, b.x0, b.block_no) < (a.y0, a.x0, a.block_no)) ELSE (SELECT count(*) FROM two b WHERE b.paper_id = a.paper_id AND b.wide AND b.y0 <= a.y0) END AS r FROM two a),
placed AS (SELECT paper_id, page_number, block_no, t, CAST(row_number() OVER (PARTITION BY paper_id, page_number ORDER BY r, two AND wide, CASE WHEN two AND NOT wide AND right_ THEN 1 ELSE 0 END, y0, x0, block_no) AS INTEGER) AS position FROM region)"""


def _blocks(spark: SparkSession, d: str) -> DataFrame:
    from pyspark.sql import Window

    nth = F.row_number().over(Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"))
    x0, wide = F.col("l_partkey") * 37 % 380, F.col("l_suppkey") * 53 % 560 + 20
    return table(spark, d, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("paper_id"), F.lit(1).alias("page_number"), nth.alias("block_no"), x0.cast("double").alias("x0"), (x0 + wide).cast("double").alias("x1"),
        (F.col("l_quantity").cast("long") * 13 % 90).cast("double").alias("y0"), F.concat("l_returnflag", F.col("l_partkey").cast("string")).alias("text"), F.lit(0).alias("block_type"), F.lit(600.0).alias("page_width"),
    )


@query(f"WITH {_BLOCKS} SELECT paper_id, block_no, position FROM placed")
def reading_order(spark: SparkSession, d: str) -> DataFrame:
    return layout.reading_order(_blocks(spark, d)).select("paper_id", "block_no", "position")


@query(f"WITH {_BLOCKS} SELECT paper_id, page_number, string_agg(t, chr(10) || chr(10) ORDER BY position) AS raw_text FROM placed GROUP BY 1, 2")
def layout_text(spark: SparkSession, d: str) -> DataFrame:
    return layout.layout_text(_blocks(spark, d))


@query(f"WITH {_BLOCKS}, pg AS (SELECT paper_id, page_number, string_agg(t, chr(10) || chr(10) ORDER BY position) AS raw_text FROM placed GROUP BY 1, 2) SELECT paper_id, page_number, raw_text, {_CLEAN('raw_text')} AS clean_text, 'native' AS text_source FROM pg")
def pages_from_blocks(spark: SparkSession, d: str) -> DataFrame:
    raw = layout.layout_text(_blocks(spark, d))
    return raw.withColumn("clean_text", text.clean_text(F.col("raw_text"))).withColumn("text_source", F.lit("native"))


_CELLS = """rows_ AS (SELECT o_custkey, o_orderkey, CASE WHEN o_orderkey % 13 = 0 THEN [CAST(o_orderkey AS VARCHAR), o_orderstatus] ELSE
  [CAST(o_orderkey AS VARCHAR), CASE WHEN o_orderstatus = 'P' THEN ' ' ELSE o_orderstatus END, CASE WHEN starts_with(o_orderpriority, '1') THEN 'a' || chr(10) || 'b' ELSE o_orderpriority END, CASE WHEN o_totalprice > 400000 THEN NULL ELSE 'x' END] END AS cells FROM orders),
t AS (SELECT o_custkey, list(cells) AS cells, count(*) AS n, 4 + o_custkey % 2 AS cols FROM rows_ GROUP BY o_custkey),
m AS (SELECT o_custkey, n, cols, flatten(cells) AS f, len(list_filter(cells, lambda r: len(r) <> cols)) AS irregular FROM t),
s AS (SELECT *, len(list_filter(f, lambda c: trim(coalesce(c, '')) = '')) / greatest(len(f), 1) AS e, len(list_filter(f, lambda c: contains(coalesce(c, ''), chr(10)))) / greatest(len(f), 1) AS ml FROM m)"""


def _tables(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    key, status = F.col("o_orderkey").cast("string"), F.col("o_orderstatus")
    full = F.array(key, F.when(status == "P", " ").otherwise(status), F.when(F.col("o_orderpriority").startswith("1"), "a\nb").otherwise(F.col("o_orderpriority")), F.when(F.col("o_totalprice") > 400000, None).otherwise("x"))
    rows = o.select("o_custkey", F.when(F.col("o_orderkey") % 13 == 0, F.array(key, status)).otherwise(full).alias("cells"))
    return rows.groupBy("o_custkey").agg(F.collect_list("cells").alias("cells"), F.count("*").alias("n")).withColumn("cols", (F.lit(4) + F.col("o_custkey") % 2).cast("int"))


_COMPLEX = """least(CASE WHEN cols >= 5 THEN 0.20::DOUBLE ELSE 0 END + CASE WHEN n >= 10 THEN 0.15::DOUBLE ELSE 0 END + CASE WHEN e >= 0.15::DOUBLE THEN 0.20::DOUBLE ELSE 0 END
  + CASE WHEN ml >= 0.10::DOUBLE THEN 0.15::DOUBLE ELSE 0 END + CASE WHEN irregular > 0 THEN 0.30::DOUBLE ELSE 0 END, 1.0::DOUBLE)"""
_CONFIDENT = "greatest(0.0::DOUBLE, least(1.0::DOUBLE - least(e * 0.50::DOUBLE, 0.40::DOUBLE) - least(irregular * 0.15::DOUBLE, 0.30::DOUBLE) - CASE WHEN n = 1 OR cols = 1 THEN 0.15::DOUBLE ELSE 0 END, 1.0::DOUBLE))"


@query(f"WITH {_CELLS} SELECT o_custkey AS table_key, {_COMPLEX} AS complexity FROM s")
def table_complexity(spark: SparkSession, d: str) -> DataFrame:
    return _tables(spark, d).select(F.col("o_custkey").alias("table_key"), tables.complexity(F.col("cells"), F.col("n"), F.col("cols")).alias("complexity"))


@query(f"WITH {_CELLS} SELECT o_custkey AS table_key, {_CONFIDENT} AS confidence FROM s")
def table_confidence(spark: SparkSession, d: str) -> DataFrame:
    return _tables(spark, d).select(F.col("o_custkey").alias("table_key"), tables.confidence(F.col("cells"), F.col("n"), F.col("cols")).alias("confidence"))


@query(f"WITH {_CELLS} SELECT o_custkey AS table_key, 'page_1_table_1' AS table_id, {_COMPLEX} AS complexity, {_CONFIDENT} AS confidence FROM s")
def table_scan(spark: SparkSession, d: str) -> DataFrame:
    t = _tables(spark, d)
    c, r = F.col("cells"), F.col("n")
    return t.select(F.col("o_custkey").alias("table_key"), tables.table_id(F.lit(None).cast("string"), F.lit(1), F.lit(1)).alias("table_id"), tables.complexity(c, r, F.col("cols")).alias("complexity"), tables.confidence(c, r, F.col("cols")).alias("confidence"))


_CAPTIONED = """c AS (SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN p_name || chr(10) || 'TABLE  ' || p_size || 'a  of ' || p_brand WHEN p_partkey % 3 = 1 THEN p_name ELSE 'Stable ' || p_size END AS above, CASE WHEN p_partkey % 2 = 0 THEN 'see table ' || p_size || ' for ' || p_type ELSE '' END AS below FROM part),
f AS (SELECT p_partkey, trim(regexp_replace(coalesce(list_filter(string_split(above, chr(10)), lambda x: regexp_matches(x, '(?i)\\btable\\s+[0-9]+[a-z]?\\b'))[1], list_filter(string_split(below, chr(10)), lambda x: regexp_matches(x, '(?i)\\btable\\s+[0-9]+[a-z]?\\b'))[1]), '\\s+', ' ', 'g')) AS caption FROM c)"""


def _captioned(spark: SparkSession, d: str) -> DataFrame:
    k, size = F.col("p_partkey"), F.col("p_size").cast("string")
    above = F.when(k % 3 == 0, F.concat("p_name", F.lit("\nTABLE  "), size, F.lit("a  of "), "p_brand")).when(k % 3 == 1, F.col("p_name")).otherwise(F.concat(F.lit("Stable "), size))
    below = F.when(k % 2 == 0, F.concat(F.lit("see table "), size, F.lit(" for "), "p_type")).otherwise("")
    return table(spark, d, "part").select(k, tables.caption(above, below).alias("caption"))


@query(f"WITH {_CAPTIONED} SELECT p_partkey AS table_key, caption FROM f")
def table_caption(spark: SparkSession, d: str) -> DataFrame:
    return _captioned(spark, d).select(F.col("p_partkey").alias("table_key"), "caption")


@query(f"""WITH {_CAPTIONED} SELECT p_partkey AS table_key, CASE WHEN caption IS NULL THEN 'page_' || (p_partkey % 9 + 1) || '_table_2' ELSE 'Table ' || upper(regexp_extract(caption, '(?i)\\btable\\s+([0-9]+[a-z]?)\\b', 1)) END AS table_id FROM f""")
def table_id(spark: SparkSession, d: str) -> DataFrame:
    return _captioned(spark, d).select(F.col("p_partkey").alias("table_key"), tables.table_id(F.col("caption"), F.col("p_partkey") % 9 + 1, F.lit(2)).alias("table_id"))


_TABLE_ROWS = """tb AS (SELECT paper_id, page_number, i AS table_index, 'page_' || page_number || '_table_' || i AS table_id, CASE WHEN i = 1 THEN 'Table ' || page_number END AS caption, CASE WHEN page_number % 2 = 0 THEN 'a | b' END AS text,
  (length(coalesce(clean_text, '')) * i % 11) / 10.0::DOUBLE AS complexity, (length(coalesce(clean_text, '')) * i % 7) / 6.0::DOUBLE AS confidence FROM pg, (VALUES (1), (2)) v(i) WHERE page_number % 3 <> 1)"""
_REASONS = f"""WITH {_PG}, {_QUALITY}, {_TABLE_ROWS},
tr AS (SELECT paper_id, page_number, list(r ORDER BY table_index) AS rs FROM (SELECT *, CASE WHEN complexity >= 0.60::DOUBLE THEN 'complex_table' WHEN confidence < 0.70::DOUBLE THEN 'poor_table_extraction' END AS r FROM tb) WHERE r IS NOT NULL GROUP BY 1, 2),
every AS (SELECT paper_id, page_number, list_filter(list_concat(
   [CASE WHEN NOT good THEN 'corrupted_text' END, CASE WHEN NOT good AND page_number % 10 >= 5 THEN 'scanned_page' END], coalesce(rs, []),
   [CASE WHEN regexp_matches(raw, '(?im)^\\s*(?:figure|fig\\.)\\s*[0-9]+[a-z]?\\b') AND (page_number % 10 >= 1 OR length(coalesce(clean_text, '')) % 30 >= 20) THEN 'figure' END,
    CASE WHEN NOT good AND regexp_matches(raw, '{text.EQUATION}') THEN 'equation' END]), lambda x: x IS NOT NULL) AS a FROM good LEFT JOIN tr USING (paper_id, page_number)),
reasons AS (SELECT paper_id, page_number, list_filter(a, lambda x, i: list_position(a, x) = i) AS rs FROM every)"""


def _table_rows(pages: DataFrame) -> DataFrame:
    n = F.length(F.coalesce("clean_text", F.lit("")))
    number = F.col("page_number").cast("string")
    rows = pages.where("page_number % 3 <> 1").withColumn("table_index", F.explode(F.array(F.lit(1), F.lit(2))))
    return rows.select(
        "paper_id", "page_number", "table_index", F.concat(F.lit("page_"), number, F.lit("_table_"), F.col("table_index").cast("string")).alias("table_id"),
        F.when(F.col("table_index") == 1, F.concat(F.lit("Table "), number)).alias("caption"), F.when(F.col("page_number") % 2 == 0, "a | b").alias("text"),
        ((n * F.col("table_index") % 11) / F.lit(10.0)).alias("complexity"), ((n * F.col("table_index") % 7) / F.lit(6.0)).alias("confidence"),
    )


def _judged(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    pages = _pages(spark, d, "raw_text", "clean_text")
    rows = _table_rows(pages)
    facts = _facts(pages).select("paper_id", "page_number", "image_ratio", "drawings")
    return ops.visual_reasons(pages, facts, rows.select("paper_id", "page_number", "table_index", "complexity", "confidence")), rows


@query(_REASONS + "SELECT paper_id, page_number, array_to_string(rs, '|') AS reasons, len(rs) > 0 AS needs_visual FROM reasons")
def visual_reasons(spark: SparkSession, d: str) -> DataFrame:
    return _judged(spark, d)[0].select("paper_id", "page_number", F.array_join("visual_reason", "|").alias("reasons"), "needs_visual")


def _shown(judged: DataFrame) -> DataFrame:
    return judged.withColumn("image_path", F.when(F.col("page_number") % 2 == 1, F.format_string("visuals/page_%03d.png", "page_number")))


@query(_REASONS + "SELECT tb.paper_id, tb.page_number, table_index, coalesce(len(rs) > 0 AND tb.page_number % 2 = 1, false) AS use_visual FROM tb LEFT JOIN reasons USING (paper_id, page_number)")
def table_use_visual(spark: SparkSession, d: str) -> DataFrame:
    judged, rows = _judged(spark, d)
    return ops.table_use_visual(rows, _shown(judged)).select("paper_id", "page_number", "table_index", "use_visual")


@query(_REASONS + """,
meta AS (SELECT paper_id, title, array_to_string(authors, ', ') AS a, venue, year, pdf_url FROM papers WHERE paper_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY paper_id ORDER BY seen_at) = 1),
pt AS (SELECT paper_id, string_agg('=== PAGE ' || page_number || ' ===' || chr(10) || coalesce(clean_text, ''), chr(10) || chr(10) ORDER BY page_number) AS t FROM pg GROUP BY 1),
ut AS (SELECT paper_id, string_agg('=== PAGE ' || page_number || ' / ' || table_id || ' ===' || chr(10) || coalesce(caption || chr(10), '') || text, chr(10) || chr(10) ORDER BY page_number, table_index) AS t
  FROM tb LEFT JOIN reasons USING (paper_id, page_number) WHERE text IS NOT NULL AND NOT coalesce(len(rs) > 0 AND page_number % 2 = 1, false) GROUP BY 1),
al AS (SELECT paper_id, string_agg('=== PAGE ' || page_number || ' ===' || chr(10) || 'https://github.com/x/' || paper_id, chr(10) || chr(10) ORDER BY page_number) AS t FROM pg WHERE page_number = 2 GROUP BY 1),
vt AS (SELECT paper_id, string_agg('Page ' || page_number || ': ' || array_to_string(rs, ', '), chr(10) ORDER BY page_number) AS t, string_agg(printf('visuals/page_%03d.png', page_number), '|' ORDER BY page_number) AS v FROM reasons WHERE len(rs) > 0 AND page_number % 2 = 1 GROUP BY 1)
SELECT meta.paper_id, regexp_replace('PAPER METADATA' || chr(10) || chr(10) || 'Paper ID: ' || meta.paper_id || chr(10) || 'Title: ' || coalesce(title, 'None') || chr(10) || 'Authors: ' || coalesce(nullif(a, ''), 'Unknown') || chr(10)
  || 'Venue: ' || coalesce(nullif(venue, ''), 'Unknown') || chr(10) || 'Year: ' || coalesce(CAST(year AS VARCHAR), 'Unknown') || chr(10) || 'PDF URL: ' || coalesce(pdf_url, 'None')
  || chr(10) || chr(10) || 'FULL PAPER TEXT' || coalesce(chr(10) || chr(10) || pt.t, '') || coalesce(chr(10) || chr(10) || 'TABLES NOT REPRESENTED BY IMAGES' || chr(10) || chr(10) || ut.t, '')
  || coalesce(chr(10) || chr(10) || 'ARTIFACT LINKS' || chr(10) || chr(10) || al.t, '') || coalesce(chr(10) || chr(10) || 'VISUAL PAGES' || chr(10) || vt.t, ''), '^\\s+|\\s+$', '', 'g') AS text, coalesce(vt.v, '') AS visual_pages
FROM meta LEFT JOIN pt USING (paper_id) LEFT JOIN ut USING (paper_id) LEFT JOIN al USING (paper_id) LEFT JOIN vt USING (paper_id)""")
def llm_context(spark: SparkSession, d: str) -> DataFrame:
    judged, rows = _judged(spark, d)
    pages = _shown(judged).withColumn("urls", F.when(F.col("page_number") == 2, F.array(F.concat(F.lit("https://github.com/x/"), F.col("paper_id")), F.lit("https://doi.org/1"))).otherwise(F.array().cast("array<string>")))
    papers = table(spark, d, "papers").where("paper_id is not null").groupBy("paper_id").agg(F.min_by(F.struct("title", "authors", "venue", "year", "pdf_url"), "seen_at").alias("p")).select("paper_id", "p.*")
    out = ops.contexts(papers, pages, ops.table_use_visual(rows, pages))
    return out.select("paper_id", "text", F.array_join("visual_pages", "|").alias("visual_pages"))


_DOCUMENTS = f"WITH {_PG}, {_TABLE_ROWS}, doc AS (SELECT DISTINCT paper_id, paper_id NOT LIKE '%7' AS pdf_exists, (SELECT CAST(count(*) AS INTEGER) FROM pg WHERE pg.paper_id = papers.paper_id) + CASE WHEN paper_id LIKE '%3' THEN 1 WHEN paper_id LIKE '%9' THEN -1 ELSE 0 END AS page_count FROM papers WHERE paper_id IS NOT NULL)"


@query(_DOCUMENTS + """,
n AS (SELECT paper_id, count(*) AS n, count(DISTINCT page_number) AS dn, min(page_number) AS lo, max(page_number) AS hi FROM pg GROUP BY 1),
o AS (SELECT paper_id, count(*) AS off_ FROM tb JOIN doc USING (paper_id) WHERE page_number < 1 OR page_number > page_count GROUP BY 1)
SELECT paper_id, array_to_string(list_filter([CASE WHEN NOT pdf_exists THEN 'missing pdf' END, CASE WHEN page_count <= 0 THEN 'no pages' END, CASE WHEN n IS NULL OR n <> page_count THEN 'page count differs' END,
  CASE WHEN n IS NULL OR lo <> 1 OR hi <> n OR dn <> n THEN 'page numbers are not a sequence' END, CASE WHEN off_ > 0 THEN 'table outside the document' END], lambda x: x IS NOT NULL), '|') AS violations
FROM doc LEFT JOIN n USING (paper_id) LEFT JOIN o USING (paper_id)""")
def validate_document(spark: SparkSession, d: str) -> DataFrame:
    pages = _pages(spark, d, "clean_text")
    n = pages.groupBy("paper_id").agg(F.count("*").cast("int").alias("n"))
    shift = F.when(F.col("paper_id").endswith("3"), 1).when(F.col("paper_id").endswith("9"), -1).otherwise(0)
    papers = table(spark, d, "papers").where("paper_id is not null").select("paper_id").distinct().join(n, "paper_id", "left")
    papers = papers.select("paper_id", (~F.col("paper_id").endswith("7")).alias("pdf_exists"), (F.coalesce("n", F.lit(0)) + shift).alias("page_count"))
    return ops.validate_documents(papers, pages, _table_rows(pages)).select("paper_id", F.array_join("violations", "|").alias("violations"))


_OCR = f"""{_QUALITY}, src AS (SELECT DISTINCT paper_id, page_number, text_source, warnings FROM page_content WHERE paper_id IS NOT NULL AND page_number IS NOT NULL),
o AS (SELECT good.*, text_source, warnings, page_number % 5 = 0 AS broke, {_CLEAN("'recognised  ' || clean_text")} AS seen FROM good JOIN src USING (paper_id, page_number)),
u AS (SELECT *, NOT good AND NOT broke AND coalesce(seen, '') <> '' AS used FROM o)"""


@query(f"""WITH {_PG}, {_OCR} SELECT paper_id, page_number, raw_text, CASE WHEN used THEN seen ELSE clean_text END AS clean_text, CASE WHEN used THEN 'ocr' ELSE text_source END AS text_source,
  array_to_string(list_concat(coalesce(warnings, []), CASE WHEN good OR used THEN [] WHEN broke THEN ['ocr failed: engine failed'] ELSE ['ocr gave no text'] END), '|') AS warnings FROM u""")
def ocr_fallback(spark: SparkSession, d: str) -> DataFrame:
    pages = _pages(spark, d, "raw_text", "clean_text", "text_source", "warnings")
    ocr = pages.select("paper_id", "page_number", F.concat(F.lit("recognised  "), F.col("clean_text")).alias("text"), F.when(F.col("page_number") % 5 == 0, "engine failed").alias("error"))
    return ops.ocr_fallback(pages, ocr).withColumn("warnings", F.array_join("warnings", "|"))


@query("SELECT doc_id, CASE WHEN text IS NULL THEN NULL ELSE sha256(text) END AS text_hash FROM documents")
def text_hash(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", text.text_hash(F.col("text")).alias("text_hash"))


@query(rf"SELECT doc_id, nullif(regexp_replace(text, '^[{S}]+|[{S}]+$', '', 'g'), '') AS text FROM documents")
def strip_text(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", text.blank_to_null(F.col("text")).alias("text"))


@query("SELECT DISTINCT paper_id, TRY_CAST(nullif(regexp_extract(coalesce(nullif(CASE WHEN year % 2 = 0 THEN CAST(year AS VARCHAR) END, ''), paper_id), '(?:^|[^a-zA-Z0-9_])((?:19|20)[0-9]{2})\\b', 1), '') AS INTEGER) AS year_found FROM papers")
def year(spark: SparkSession, d: str) -> DataFrame:
    stated = F.when(F.col("year") % 2 == 0, F.col("year").cast("string"))
    return table(spark, d, "papers").select("paper_id", text.year_of(stated, F.col("paper_id")).alias("year_found")).distinct()


@query("SELECT DISTINCT paper_url, regexp_extract(regexp_replace(paper_url, '/+$', ''), '([^/]*)$', 1) AS found, regexp_replace(regexp_extract(pdf_url, '([^/]*)$', 1), '\\.pdf$', '') AS found_pdf FROM papers")
def paper_id(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "papers").select("paper_url", text.paper_id_from_url(F.col("paper_url")).alias("found"), text.paper_id_from_url(F.concat("pdf_url", F.lit("?a=1#b"))).alias("found_pdf")).distinct()


@query("""WITH k AS (SELECT DISTINCT paper_id, CASE WHEN regexp_matches(paper_id, '^[0-9]') THEN [''] ELSE [] END AS f, list_transform(regexp_extract_all(paper_id, '[0-9]+|[^0-9]+'), lambda p: CASE WHEN regexp_matches(p, '^[0-9]') THEN lpad(p, 20, '0') ELSE lower(p) END) AS k FROM jobs WHERE paper_id IS NOT NULL)
SELECT paper_id, array_to_string(list_concat(f, k), '/') AS sort_key FROM k""")
def natural_sort(spark: SparkSession, d: str) -> DataFrame:
    ids = table(spark, d, "jobs").where("paper_id is not null").select("paper_id").distinct()
    return ids.select("paper_id", F.array_join(text.natural_key(F.col("paper_id")), "/").alias("sort_key"))

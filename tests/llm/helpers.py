"""Small tables with everything that may go wrong: nulls in every column, repeats, columns too many."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

T0 = datetime(2026, 1, 1)
PAPERS = "paper_id string, title string, authors array<string>, venue string, year int, seen_at timestamp"
PAGES = "paper_id string, page_number int, raw_text string, clean_text string, text_source string"
STORE = "id string, embedding array<float>, document string, metadata struct<paper_id:string,embedding_type:string,schema_version:string,embedding_model:string,text_hash:string,run_id:string,facet:string>"
RESULTS = "paper_id string, status string, response struct<datasets_benchmarks:struct<value:string>,contribution_type:struct<value:string>>"
DOCUMENTS = "doc_id long, text string, lang string, source string"
LABELS = "doc_id long, rater string, abusive int"
TARGETS = "source string, target_share double, max_repeats int"
FORMS = "formal string, short string"

#: Names that the operators use inside; none may be mistaken for the operators' own columns.
CLASHING = ("field", "key", "form", "text_id", "n", "word", "cell", "node", "venue_key", "version", "line_no", "bag", "entity", "size", "rank", "tokens", "before", "score", "label", "h", "top", "mark", "record", "seq", "state")


def clash(df):
    """The same table with extra columns of the operators' inner names."""
    for c in CLASHING:
        if c not in df.columns:
            df = df.withColumn(c, F.lit("clash"))
    return df


def paper(pid, title="T", authors=(), venue=None):
    return (pid, title, list(authors) if authors is not None else None, venue, 2026, T0)


def page(pid, n, text, raw="", source="native"):
    return (pid, n, raw, text, source)


def unit(i, vector, facet="f", run="r1"):
    return (i, vector, "d", ("p", "facet", "v1", "m", "h", run, facet))


def result(pid, data, kind=None, status="success"):
    return (pid, status, ((data,), (kind,)))

"""Sources: prompts, paper lists, result lines, title maps, artifact folders, PDF and picture files."""

from __future__ import annotations

import ast

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow import schemas
from folioflow.functions.text import blank_to_null
from folioflow.thresholds import DEFAULT, Thresholds


def paper_list(spark: SparkSession, path: str) -> DataFrame:
    """A JSON array of papers, in order; a file whose top level is no array is an error."""
    first = spark.read.text(path, wholetext=True).select(F.regexp_extract("value", r"^[\s﻿]*(.)", 1).alias("c")).where("c <> '['").first()
    if first:
        raise ValueError(f"{path}: the top level must be an array")
    return spark.read.schema(schemas.PAPER_LIST).option("multiLine", True).json(path)


def result_lines(lines: DataFrame, strict: bool = False) -> DataFrame:
    """Text lines (value) of results as rows. Lenient: blank and malformed lines are left out.

    Strict: a malformed line, one that is no object, or one without a paper_id raises and names it.
    """
    filled = lines.where(F.trim("value") != "")
    kind = F.try_parse_json("value")
    sound = kind.isNotNull() & (F.schema_of_variant(kind).startswith("OBJECT"))
    read = filled.withColumn("sound", F.coalesce(sound, F.lit(False))).withColumn("r", F.from_json("value", schemas.RESULT))
    if not strict:
        return read.where("sound").select("r.*")
    fault = F.when(~F.col("sound"), "is no JSON object").when(blank_to_null(F.col("r.paper_id")).isNull(), "has no paper_id")
    checked = F.when(fault.isNotNull(), F.raise_error(F.concat(F.lit("line "), fault, F.lit(": "), F.substring("value", 1, 200))).cast(schemas.RESULT)).otherwise(F.col("r"))
    return read.select(checked.alias("r")).select("r.*")


def read_results(spark: SparkSession, path: str, strict: bool = False) -> DataFrame:
    return result_lines(spark.read.text(path), strict)


def title_map(rows: DataFrame, order: str) -> DataFrame:
    """(paper_id or anthology_id, title) rows -> one title a paper, the last that is not blank."""
    named = rows.select(blank_to_null(F.coalesce("paper_id", "anthology_id")).alias("paper_id"), blank_to_null(F.col("title")).alias("title"), order).where("paper_id is not null and title is not null")
    return named.groupBy("paper_id").agg(F.max_by("title", order).alias("title"))


def artifact_files(spark: SparkSession, folder: str) -> DataFrame:
    """(path, length) of every file below the folder; contents are not read."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder).select("path", "length")


def pdf_check(content: Column, t: Thresholds = DEFAULT) -> Column:
    """Why a file cannot be a PDF, null if it may be one. Pages and encryption need an engine for PDFs."""
    return F.when(content.isNull(), "missing").when(F.length(content) < t.min_pdf_bytes, "too small").when(F.substring(content, 1, 5) != F.lit(b"%PDF-"), "not a PDF").when(F.locate("/Encrypt", F.decode(content, "ISO-8859-1")) > 0, "encrypted")


def encoded_image(path: Column, content: Column) -> Column:
    """struct(mime, data): base64 and the type by the file's ending, PNG if unknown."""
    ending = F.lower(F.regexp_extract(path, r"\.([^.]+)$", 1))
    mime = F.when(ending.isin("jpg", "jpeg"), "image/jpeg").when(ending == "webp", "image/webp").otherwise("image/png")
    return F.struct(mime.alias("mime"), F.base64(content).alias("data"))


def file_hash(content: Column) -> Column:
    """SHA-256 of a file's bytes, as in ``spark.read.format("binaryFile")``."""
    return F.sha2(content, 256)


def load_prompt(source: str, name: str = "EXTRACTION_SYSTEM_PROMPT") -> str:
    """The text that a prompt module (its source) gives ``name``, without white space around it.

    The module is read, not run: the value must be a literal. A missing, blank or other value is an error.
    """
    value = None
    for node in ast.parse(source).body:
        targets = node.targets if isinstance(node, ast.Assign) else [node.target] if isinstance(node, ast.AnnAssign) else []
        if any(isinstance(t, ast.Name) and t.id == name for t in targets) and node.value is not None:
            try:
                value = ast.literal_eval(node.value)
            except ValueError:
                value = None
    if not isinstance(value, str) or not value.strip():
        raise ValueError(f"the prompt module must give {name} a text that is not blank")
    return value.strip()

"""The closed contract of an extraction reply, checked exactly.

Native JSON functions accept trailing text, coerce types and drop unknown keys, so the check is an
Arrow UDF over the standard library; only replies that pass are read with a fixed schema.
"""

from __future__ import annotations

import json
from typing import Any

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values.
FIELDS = ("problem_gap", "claimed_contribution", "technical_approach", "datasets_benchmarks", "contribution_type", "evaluation_summary", "reproducibility", "limitations_failures")
ITEM_KEYS, SPAN_KEYS, MAX_SPANS = {"value", "source_span", "confidence"}, {"page", "text"}, 3

# What is said about each breach of the contract.
SAYS = {
    "json": "response is not valid JSON: {}",
    "top": "top-level response must be a JSON object",
    "fields": "top-level fields mismatch; missing={}, extra={}",
    "object": "{} must be an object",
    "keys": "{} keys must be exactly {}; got {}",
    "value": "{}.value must be null or a non-empty string",
    "list": "{}.source_span must be a list",
    "many": "{}.source_span may contain at most 3 spans",
    "numeric": "{}.confidence must be numeric",
    "between": "{}.confidence must be between 0.0 and 1.0",
    "null spans": "{}: null value requires empty source_span",
    "null confidence": "{}: null value requires confidence 0.0",
    "span keys": "{}.source_span[{}] must contain exactly page and text",
    "span page": "{}.source_span[{}].page must be an integer or null",
    "span text": "{}.source_span[{}].text must be a non-empty string",
}

SPAN = T.StructType([T.StructField("page", T.LongType()), T.StructField("text", T.StringType())])
ITEM = T.StructType([T.StructField("value", T.StringType()), T.StructField("source_span", T.ArrayType(SPAN)), T.StructField("confidence", T.DoubleType())])
RESPONSE = T.StructType([T.StructField(f, ITEM) for f in FIELDS])


def _number(x: Any) -> bool:
    return isinstance(x, (int, float)) and not isinstance(x, bool)


def _item(item: Any) -> str | None:
    """The key of the first breach in one field's object."""
    value, spans, sure = item["value"], item["source_span"], item["confidence"]
    holds = {
        "value": lambda: value is None or isinstance(value, str) and value.strip(),
        "list": lambda: isinstance(spans, list),
        "many": lambda: len(spans) <= MAX_SPANS,
        "numeric": lambda: _number(sure),
        "between": lambda: 0 <= sure <= 1,
        "null spans": lambda: value is not None or not spans,
        "null confidence": lambda: value is not None or sure == 0,
    }
    return next((k for k, test in holds.items() if not test()), None)


def _span(span: Any) -> str | None:
    holds = {
        "span keys": lambda: isinstance(span, dict) and span.keys() == SPAN_KEYS,
        "span page": lambda: span["page"] is None or isinstance(span["page"], int) and not isinstance(span["page"], bool),
        "span text": lambda: isinstance(span["text"], str) and span["text"],
    }
    return next((k for k, test in holds.items() if not test()), None)


def violation(payload: Any) -> str | None:
    """The first breach of the contract in its fixed order, as a message."""
    if not isinstance(payload, dict):
        return SAYS["top"]
    if payload.keys() ^ set(FIELDS):
        return SAYS["fields"].format(sorted(set(FIELDS) - payload.keys()), sorted(payload.keys() - set(FIELDS)))
    for name in FIELDS:
        item = payload[name]
        if not isinstance(item, dict):
            return SAYS["object"].format(name)
        if item.keys() != ITEM_KEYS:
            return SAYS["keys"].format(name, sorted(ITEM_KEYS), sorted(item))
        if breach := _item(item):
            return SAYS[breach].format(name)
        for i, span in enumerate(item["source_span"]):
            if breach := _span(span):
                return SAYS[breach].format(name, i)
    return None


def reply_error(raw: str | None) -> str | None:
    """Why a raw reply is refused, None if it is accepted. Null counts as no JSON."""
    try:
        payload = json.loads(raw or "")
    except ValueError as e:
        return SAYS["json"].format(e)
    return violation(payload)


@F.pandas_udf(T.StringType())
def contract_error(raw: pd.Series) -> pd.Series:
    return raw.map(reply_error)


def parsed(raw: Column, error: Column) -> Column:
    """The reply as a struct where ``error`` is null."""
    return F.when(error.isNull(), F.from_json(raw, RESPONSE))


def confidence_band(confidence: Column) -> Column:
    return F.when(confidence >= 1.0, "certain").when(confidence >= 0.8, "strong").when(confidence >= 0.6, "fair").when(confidence >= 0.3, "weak").when(confidence > 0, "very weak").otherwise("none")

"""Tolerant reading of feature documents."""

from __future__ import annotations

import ast
import json
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as t

PAIRS = t.ArrayType(
    t.StructType([t.StructField("key", t.StringType()), t.StructField("value", t.StringType())])
)
_PYTHON_WORDS = {"true": "True", "false": "False", "null": "None"}


#: rows whose parsed form a worker holds at once
SLICE_ROWS = 200


def slices(batches: Iterator[pd.Series], rows: int = SLICE_ROWS) -> Iterator[pd.Series]:
    """Batches in slices of few rows: parsed texts take many times their bytes, and go slice by slice."""
    for texts in batches:
        for start in range(0, len(texts), rows):
            yield texts.iloc[start : start + rows]


def read_document(text: str | None) -> object:
    """The value of JSON text or of a Python literal with JSON words; ``{}`` for anything else."""
    text = (text or "").strip()
    if not text:
        return {}
    try:
        return json.loads(text)
    except (ValueError, RecursionError):
        literal = re.sub(r"\b(true|false|null)\b", lambda m: _PYTHON_WORDS[m.group()], text)
    try:
        value = ast.literal_eval(literal)
    except (ValueError, SyntaxError, TypeError, MemoryError, RecursionError):
        return {}
    return value if isinstance(value, (dict, list)) else {}


def _leaves(document: dict) -> Iterator[tuple[str, str]]:
    """Leaves in document order, at any depth. Objects with one member are used up: most levels of deep documents."""
    waiting: list[tuple[object, object]] = [("", document)]
    while waiting:
        name, node = waiting.pop()
        while isinstance(node, dict):
            if len(node) != 1:
                waiting.extend(reversed(node.items()))
                break
            name, node = node.popitem()
        else:
            if not isinstance(node, list):
                yield str(name).lower().strip(), str(node).lower().strip()


def leaf_pairs_of(text: str | None) -> list[dict[str, str]] | None:
    """Leaves under their innermost key in first-seen order, last value wins; None if not an object."""
    document = read_document(text)
    if not isinstance(document, dict):
        return None
    return [{"key": k, "value": v} for k, v in dict(_leaves(document)).items()]


@F.pandas_udf(PAIRS)
def leaf_pairs(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for texts in slices(batches):
        yield texts.map(leaf_pairs_of, na_action=None)


# or Spark repeats it in the filters that it makes for an explode or pushes down
leaf_pairs = leaf_pairs.asNondeterministic()


def _is_json(text: str | None) -> bool:
    try:
        json.loads(text or "")
    except (ValueError, RecursionError):
        return False
    return True


@F.pandas_udf(t.BooleanType())
def is_json(texts: pd.Series) -> pd.Series:
    """Whole-text JSON check: unlike the built-in parsers it sees text after the value."""
    return texts.map(_is_json, na_action=None)

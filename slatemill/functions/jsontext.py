"""JSON inside free text, and canonical hashes of rows."""

import json
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def balanced(text: str | None) -> tuple[str | None, str]:
    """(the JSON object in a text, 'ok') or (None, why not): empty, not_found, not_closed, broken.

    A code fence around the text is taken off. If the whole is JSON it is taken as it is, else the first object whose braces
    balance; braces inside strings do not count.
    """
    text = (text or "").strip()
    if not text:
        return None, "empty"
    if text.startswith("```"):
        text = re.sub(r"\s*```$", "", re.sub(r"^```(?:json)?\s*", "", text))
    if _is_json(text):
        return text, "ok"
    start = text.find("{")
    if start < 0:
        return None, "not_found"
    depth = 0
    for m in _MARKS.finditer(text, start):
        if m[0] in "{}":
            depth += 1 if m[0] == "{" else -1
            if not depth:
                found = text[start : m.end()]
                return (found, "ok") if _is_json(found) else (None, "broken")
    return None, "not_closed"


#: Strings, ended or not, and braces outside of them.
_MARKS = re.compile(r'"(?:[^"\\]|\\.)*(?:"|\Z)|[{}]', re.S)


def _is_json(text: str) -> bool:
    try:
        json.loads(text)
        return True
    except (ValueError, RecursionError):
        return False


def extract_objects(df: DataFrame, column: str) -> DataFrame:
    """df with ``object`` and ``object_status`` of the first JSON object in a text column, in Arrow batches."""

    def find(batches):
        for batch in batches:
            found = [balanced(t) for t in batch.column(batch.schema.get_field_index(column)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([x for x, _ in found], pa.string()), pa.array([y for _, y in found], pa.string())], names=[*batch.schema.names, "object", "object_status"])

    return df.mapInArrow(find, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema) + ", object string, object_status string")


def content_hash(*columns: str) -> Column:
    """The hash of a row's canonical JSON: its columns in the order of their names, nulls kept."""
    return F.sha2(F.to_json(F.struct(*sorted(columns)), {"ignoreNullFields": "false"}), 256)

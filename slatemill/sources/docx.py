"""Paragraphs and pictures of DOCX files, read from their ZIP parts in Arrow batches; nothing is written to a machine's own disk."""

import io
import re
import zipfile
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

_W, _A, _R = ("{http://schemas.openxmlformats.org/wordprocessingml/2006/main}", "{http://schemas.openxmlformats.org/drawingml/2006/main}", "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}")


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).selectExpr("regexp_extract(path, '([^/]+)$', 1) AS doc_id", "content")


def paragraphs(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, pos, text) of the body's own paragraphs, blanks shortened, empty ones left out but counted. A broken file gives no rows."""

    def take(frames):
        for frame in frames:
            out = []
            for doc, content in zip(frame["doc_id"], frame["content"]):
                body = _part(content, "word/document.xml")
                for pos, node in enumerate([] if body is None else body.iterfind(f"{_W}body/{_W}p")):
                    text = re.sub(r"\s+", " ", "".join(t.text or "" for t in node.iter(f"{_W}t"))).strip()
                    if text:
                        out.append((doc, pos, text))
            yield pd.DataFrame(out, columns=["doc_id", "pos", "text"])

    return _files(spark, path).mapInPandas(take, "doc_id string, pos int, text string")


def pictures(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, pos, nth, target) of the pictures in each paragraph.

    Here every paragraph counts, those in table cells too, so numbers may run ahead of those of ``paragraphs`` after a table.
    """

    def take(frames):
        for frame in frames:
            out = []
            for doc, content in zip(frame["doc_id"], frame["content"]):
                body, links = _part(content, "word/document.xml"), _part(content, "word/_rels/document.xml.rels")
                targets = {} if links is None else {x.get("Id"): x.get("Target") for x in links if (x.get("Target") or "").startswith("media/")}
                for pos, node in enumerate([] if body is None else body.iter(f"{_W}p")):
                    found = [targets[x.get(f"{_R}embed")] for x in node.iter(f"{_A}blip") if x.get(f"{_R}embed") in targets]
                    out += [(doc, pos, nth, target) for nth, target in enumerate(found, 1)]
            yield pd.DataFrame(out, columns=["doc_id", "pos", "nth", "target"])

    return _files(spark, path).mapInPandas(take, "doc_id string, pos int, nth int, target string")


def _part(content: bytes, name: str):
    try:
        with zipfile.ZipFile(io.BytesIO(content)) as z:
            return ElementTree.fromstring(z.read(name))
    except (zipfile.BadZipFile, KeyError, ElementTree.ParseError):
        return None

"""Document sources: YAML files and JSON lines, read untyped.

Structure is checked before any schema applies, so documents are kept as
VARIANT. A file that cannot be parsed becomes a finding, not a failed job.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Codes and texts of parse findings.
PARSE_MESSAGES = {
    "parse.unreadable": "cannot read file",
    "parse.duplicate-key": "duplicate key: the same key appears twice in this block",
    "parse.invalid-yaml": "invalid YAML",
    "parse.empty": "file is empty",
    "parse.not-a-mapping": "top level must be a mapping",
}

PARSED_DDL = ("file STRING, body STRING, code STRING, message STRING, line INT, col INT, "
              "positions ARRAY<STRUCT<path: STRING, line: INT, col: INT>>")

_NULL = re.compile(r"^(~|null|Null|NULL|)$")
_BOOL = re.compile(r"^(true|True|TRUE|false|False|FALSE)$")
_INT = re.compile(r"^[-+]?[0-9]+$")
_FLOAT = re.compile(r"^[-+]?(\.[0-9]+|[0-9]+(\.[0-9]*)?)([eE][-+]?[0-9]+)?$")
_TIME = re.compile(r"^(\d{4}-\d{2}-\d{2})([Tt ]\s*\d.*)?$")


class _Refused(Exception):
    def __init__(self, code: str, message: str, line: int = 1, col: int = 1):
        super().__init__(message)
        self.found = (code, message, line, col)


def _plain(node):
    """A plain scalar by the YAML 1.2 core rules; dates stay text."""
    text = node.value
    if node.style in ("'", '"', "|", ">"):
        return text
    if _NULL.match(text):
        return None
    if _BOOL.match(text):
        return text.lower() == "true"
    if _INT.match(text):
        return int(text)
    if _FLOAT.match(text):
        return float(text)
    day = _TIME.match(text)
    return day.group(1) if day and node.tag.endswith(":timestamp") else text


def _value(node, path: str, places: list):
    import yaml

    if isinstance(node, yaml.MappingNode):
        out = {}
        for key, child in node.value:
            name = str(key.value)
            if name in out:
                raise _Refused("parse.duplicate-key", PARSE_MESSAGES["parse.duplicate-key"],
                               key.start_mark.line + 1, key.start_mark.column + 1)
            below = f"{path}.{name}" if path else name
            places.append((f"{below}!", key.start_mark.line + 1, key.start_mark.column + 1))
            places.append((below, child.start_mark.line + 1, child.start_mark.column + 1))
            out[name] = _value(child, below, places)
        return out
    if isinstance(node, yaml.SequenceNode):
        out = []
        for i, child in enumerate(node.value):
            below = f"{path}[{i}]"
            places.append((below, child.start_mark.line + 1, child.start_mark.column + 1))
            out.append(_value(child, below, places))
        return out
    return _plain(node)


def _parse(content: bytes | str) -> tuple:
    import yaml

    loader = getattr(yaml, "CSafeLoader", yaml.SafeLoader)
    places: list = []
    try:
        text = content.decode("utf-8") if isinstance(content, bytes) else content
        node = yaml.compose(text, Loader=loader)
        value = None if node is None else _value(node, "", places)
        if value is None:
            raise _Refused("parse.empty", PARSE_MESSAGES["parse.empty"])
        if not isinstance(value, dict):
            raise _Refused("parse.not-a-mapping", PARSE_MESSAGES["parse.not-a-mapping"])
    except UnicodeDecodeError:
        return (None, "parse.unreadable", PARSE_MESSAGES["parse.unreadable"], None, None, None)
    except _Refused as found:
        return (None, *found.found, None)
    except yaml.MarkedYAMLError as broken:
        mark = broken.problem_mark or broken.context_mark
        line, col = (mark.line + 1, mark.column + 1) if mark else (1, 1)
        return (None, "parse.invalid-yaml", f"invalid YAML: {broken.problem or broken}", line, col, None)
    places.append(("", 1, 1))
    return (json.dumps(value, ensure_ascii=False), None, None, None, None,
            [{"path": p, "line": n, "col": c} for p, n, c in places])


def _parse_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        parsed = [_parse(c) for c in batch["content"]]
        out = pd.DataFrame(parsed, columns=["body", "code", "message", "line", "col", "positions"])
        out["line"] = out["line"].astype("Int32")
        out["col"] = out["col"].astype("Int32")
        out.insert(0, "file", batch["file"].to_numpy())
        yield out


def parse_documents(files: DataFrame) -> DataFrame:
    """Parse (file, content) rows: the document, or why there is none."""
    parsed = files.select("file", "content").mapInPandas(_parse_batches, PARSED_DDL)
    return parsed.withColumn("doc", F.try_parse_json("body")).drop("body")


def scan_documents(spark: SparkSession, directory: str) -> DataFrame:
    """Every ``*.yaml`` below a directory, but no name and no folder that
    starts with an underscore."""
    raw = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
           .option("pathGlobFilter", "*.yaml").load(directory))
    below = re.escape(directory.rstrip("/")) + "/(.*)$"
    files = raw.select(F.regexp_extract("path", below, 1).alias("file"), "content")
    # Spark's scan passes over files of no length; the listing has them.
    listed = spark.createDataFrame([(p,) for p in raw.inputFiles()], "path string")
    empty = (listed.select(F.regexp_extract(F.url_decode("path"), below, 1).alias("file"))
             .join(files.select("file"), "file", "left_anti").withColumn("content", F.lit(b"").cast("binary")))
    return parse_documents(files.unionByName(empty).where(~F.col("file").rlike(r"(^|/)_")))


def read_json_documents(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines, one document each."""
    lines = spark.read.text(path).select(F.col("_metadata.file_name").alias("file"), "value")
    return json_documents(lines, "value")


def json_documents(df: DataFrame, body: str = "body") -> DataFrame:
    """Documents from a text column; unreadable ones carry a parse code."""
    doc = F.try_parse_json(body)
    broken = (F.when(F.trim(F.col(body)) == "", F.lit("parse.empty"))
               .when(F.col("doc").isNull(), F.lit("parse.invalid-json"))
               .when(~F.schema_of_variant("doc").startswith("OBJECT"), F.lit("parse.not-a-mapping")))
    return df.withColumn("doc", doc).withColumn("code", broken)


def positions(parsed: DataFrame) -> DataFrame:
    """Where each path of each file starts: (file, path, line, col)."""
    return parsed.select("file", F.inline("positions"))

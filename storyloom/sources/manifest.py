"""What made a stage: a digest of its source, schema, tables, options and parent, kept beside its files."""

from __future__ import annotations

import hashlib
import json
from dataclasses import asdict, is_dataclass

from pyspark.sql import DataFrame, SparkSession

# Spark's readers skip names that begin with an underscore.
NAME = "_manifest.json"


def _file_marks(df: DataFrame) -> list[str]:
    """Path, length and time of every file that the table reads."""
    spark, marks = df.sparkSession, []
    for name in sorted(df.inputFiles()):
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        status = path.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(path)
        marks.append(f"{name} {status.getLen()} {status.getModificationTime()}")
    return marks


def described(value) -> object:
    """A value as plain JSON: sets in order, tables by their files, schema and plan."""
    if isinstance(value, DataFrame):
        digest = hashlib.sha256("\n".join(_file_marks(value)).encode()).hexdigest()
        return {"files": digest, "schema": value.schema.json(), "plan": value.semanticHash()}
    if is_dataclass(value) and not isinstance(value, type):
        return described(asdict(value))
    if isinstance(value, dict):
        return {str(k): described(v) for k, v in sorted(value.items(), key=lambda kv: str(kv[0]))}
    if isinstance(value, (set, frozenset)):
        return sorted(map(str, value))
    if isinstance(value, (list, tuple)):
        return [described(v) for v in value]
    return value


def fingerprint(**parts) -> str:
    text = json.dumps(described(parts), sort_keys=True, ensure_ascii=False)
    return hashlib.sha256(text.encode()).hexdigest()


def write_manifest(spark: SparkSession, folder: str, made_by: str) -> None:
    """Written after the stage's files, so that a stage cut short has none."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder.rstrip('/')}/{NAME}")
    out = path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path, True)
    try:
        out.write(bytearray(json.dumps({"made_by": made_by}).encode()))
    finally:
        out.close()


def read_manifest(spark: SparkSession, folder: str) -> str | None:
    """What a whole stage was made by; None where there is no manifest."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder.rstrip('/')}/{NAME}")
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(path):
        return None
    stream = system.open(path)
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return json.loads(text).get("made_by")

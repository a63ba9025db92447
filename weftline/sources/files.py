"""Files of posts and rules, read with explicit schemas, and their sinks."""

from __future__ import annotations

import json
import os
import tempfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.schemas import DIGEST, POST, RULE_FILE
from ..functions.text import strip
from .documents import json_elements


def category_map(spark: SparkSession, path: str, strict: bool = False) -> DataFrame:
    """Posts of {category: [post]} documents: category, pos and the post's
    columns. Values that aren't lists and posts that aren't objects are left out
    (``strict``: malformed JSON fails instead of giving no row). Categories keep
    the file's order in ``category_pos``. A document of any size is read by as many
    tasks as it has byte ranges."""
    rows = json_elements(spark, path, strict=strict).withColumn("p", F.from_json("value", POST))
    return rows.select("file", F.col("key_pos").alias("category_pos"), F.col("key").alias("category"), "pos", "p.*")


def posts_with_category(spark: SparkSession, path: str) -> DataFrame:
    return category_map(spark, path).withColumn("source_category", F.col("category"))


def posts_only(spark: SparkSession, path: str) -> DataFrame:
    return category_map(spark, path).drop("category", "category_pos", "file")


def post_list(spark: SparkSession, path: str) -> DataFrame:
    """A JSON list of posts."""
    return spark.read.schema(POST).json(path, multiLine=True)


def rule_files(spark: SparkSession, paths: str | list[str]) -> tuple[DataFrame, DataFrame]:
    """(rules, corrupt): the rules of all files in order of path and place, and
    the paths that hold no JSON."""
    files = spark.read.schema(RULE_FILE).option("columnNameOfCorruptRecord", "_corrupt_record").json(paths, multiLine=True).withColumn("file", F.col("_metadata.file_path"))
    rules = files.where("_corrupt_record is null").select("file", F.posexplode("rules").alias("pos", "rule")).select("file", "pos", "rule.*")
    whole = spark.read.text(paths, wholetext=True).withColumn("file", F.col("_metadata.file_path"))
    return rules, whole.where(F.try_parse_json("value").isNull()).select("file")


def url_list(spark: SparkSession, path: str) -> DataFrame:
    """(pos-less) URLs, one a line, without blank lines; # lines stay."""
    return spark.read.text(path).select(strip("value").alias("url")).where("url <> ''")


def digest_lines(spark: SparkSession, path: str) -> DataFrame:
    """Digests of a JSONL file; bad lines are passed over."""
    return spark.read.schema(DIGEST).json(path, mode="DROPMALFORMED")


def known_rule_ids(spark: SparkSession, path: str) -> DataFrame:
    """Ids of the rules in a JSONL file."""
    return digest_lines(spark, path).select(F.explode("rules.rule_id").alias("rule_id")).where("rule_id is not null and rule_id <> ''").distinct()


def known_posts(spark: SparkSession, path: str) -> DataFrame:
    return category_map(spark, path).select("category", "post_id").distinct()


def append_lines(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").json(path)


# Configuration files, on the driver


def load_json(path: str | Path, kind: type | None = None, default=None):
    """A JSON file; ``default`` (or an empty ``kind``) where it is missing,
    malformed or of another type."""
    empty = kind() if kind is not None and default is None else default
    try:
        with open(path, encoding="utf-8") as file:
            found = json.load(file)
    except (OSError, ValueError):
        return empty
    return found if kind is None or isinstance(found, kind) else empty


def write_json(path: str | Path, data, indent: int = 2, backup: bool = True) -> bool:
    """Write a file as a whole or not at all: to a temporary one beside it, then
    in its place; the old one is kept as .backup."""
    path = Path(path)
    path.parent.mkdir(parents=True, exist_ok=True)
    handle, name = tempfile.mkstemp(dir=path.parent, suffix=".tmp")
    try:
        with os.fdopen(handle, "w", encoding="utf-8") as file:
            json.dump(data, file, indent=indent, ensure_ascii=False)
            file.flush()
            os.fsync(file.fileno())
        if backup and path.exists():
            os.replace(path, f"{path}.backup")
        os.replace(name, path)
    except (OSError, TypeError, ValueError):
        Path(name).unlink(missing_ok=True)
        return False
    return True


def read_json(path: str | Path, default=None):
    """A file, or its backup where it can't be read, or the default."""
    for place in (path, f"{path}.backup"):
        found = load_json(place)
        if found is not None:
            return found
    return default


def query_map(spark: SparkSession, raw: dict) -> DataFrame:
    """(name, query_string) of search definitions: lists of terms or strings."""
    from ..functions.text import search_string

    rows = [(k, [t for t in v if isinstance(t, str)] if isinstance(v, list) else None, v if isinstance(v, str) else None) for k, v in raw.items()]
    named = spark.createDataFrame(rows, "name string, terms array<string>, plain string")
    query = F.when(F.col("terms").isNotNull(), search_string("terms")).otherwise(F.nullif(strip("plain"), F.lit("")))
    return named.select("name", query.alias("query_string")).where("query_string is not null")

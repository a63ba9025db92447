"""One JSON document as a sink: staged by tasks, committed as a whole or not at all.

format("weftline_document") writes rows (value: JSON; optionally key) as one indented
document: an array, or with keys an object of arrays, keys in order of their rows.
Tasks write their rows to a staging folder beside the target, each attempt to a file
of its own. The commit puts these together as a stream, a block at a time, into a
temporary file, keeps the old document as .backup, and moves the new one in its
place: a reader finds the old document or the new one. A failed job's abort removes
what was staged, and the old document stays. If the commit can't replace the target,
the new document is kept beside it as emergency_save_<time>.json, and the commit
fails. Paths are those of any file system that pyarrow knows."""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

from .documents import is_document, json_elements


def _store(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path if "://" in path or path.startswith("/") else os.path.abspath(path))


@dataclass
class Staged(WriterCommitMessage):
    part: int
    file: str
    rows: int


class DocumentSink(DataSource):
    """Options: path, indent (2), backup (true)."""

    @classmethod
    def name(cls):
        return "weftline_document"

    def schema(self):
        return "key string, value string"

    def writer(self, schema, overwrite):
        return _Document(self.options, [f.name for f in schema])


class _Document(DataSourceWriter):
    def __init__(self, options, columns):
        self.path, self.columns = options["path"].rstrip("/"), columns
        self.indent = int(options.get("indent", "2"))
        self.backup = options.get("backup", "true").lower() == "true"
        self.staging = f"{self.path}.staged-{uuid.uuid4().hex}"

    def write(self, iterator):
        from pyspark import TaskContext

        context = TaskContext.get()
        store, folder = _store(self.staging)
        store.create_dir(folder)
        name, rows = f"{folder}/{context.partitionId():09d}-{context.taskAttemptId()}", 0
        with store.open_output_stream(name) as out:
            for row in iterator:
                own = row.asDict()
                out.write(json.dumps([own.get("key"), own["value"]], ensure_ascii=False).encode() + b"\n")
                rows += 1
        return Staged(context.partitionId(), name, rows)

    def _text(self, store, parts: list[Staged]) -> Iterator[str]:
        """The document, a row at a time."""
        pad, keyed, key, first = " " * self.indent, "key" in self.columns, None, True
        line = lambda text, depth: "\n".join(f"{pad * depth}{x}" for x in text.split("\n"))
        yield "{" if keyed else "["
        for part in sorted(parts, key=lambda p: p.part):
            with store.open_input_stream(part.file) as file:
                for own, value in map(json.loads, _lines(file)):
                    if keyed and (first or own != key):
                        yield ("" if first else f"\n{pad}],") + f"\n{pad}{json.dumps(own, ensure_ascii=False)}: ["
                        key, empty = own, True
                    else:
                        empty = first
                    yield ("" if empty else ",") + "\n" + line(json.dumps(json.loads(value), indent=self.indent, ensure_ascii=False), 2 if keyed else 1)
                    first = False
        yield ("" if first else f"\n{pad}]" if keyed else "") + ("" if first else "\n") + ("}" if keyed else "]") + "\n"

    def commit(self, messages):
        store, path = _store(self.path)
        temporary = f"{path}.{uuid.uuid4().hex}.tmp"
        with store.open_output_stream(temporary, buffer_size=1 << 20) as out:
            for text in self._text(store, [m for m in messages if m is not None and m.rows]):
                out.write(text.encode())
        try:
            _sync(store, temporary)
            if self.backup and _there(store, path):
                store.copy_file(path, f"{temporary}.old")  # the old document stays in its place meanwhile
                store.move(f"{temporary}.old", f"{path}.backup")
            store.move(temporary, path)
        except Exception:
            from datetime import datetime

            store.move(temporary, f"{path.rsplit('/', 1)[0]}/emergency_save_{datetime.now():%Y%m%d_%H%M%S}.json")
            raise
        finally:
            self.abort(messages)

    def abort(self, messages):
        store, folder = _store(self.staging)
        if _there(store, folder):
            store.delete_dir(folder)


def _lines(file) -> Iterator[bytes]:
    rest = b""
    while block := file.read(1 << 20):
        *whole, rest = (rest + block).split(b"\n")
        yield from whole


def _there(store, path: str) -> bool:
    from pyarrow import fs

    return store.get_file_info(path).type != fs.FileType.NotFound


def _sync(store, path: str) -> None:
    from pyarrow import fs

    if isinstance(store, fs.LocalFileSystem):
        handle = os.open(path, os.O_RDONLY)
        try:
            os.fsync(handle)
        finally:
            os.close(handle)


def write_document(rows: DataFrame, path: str, key: str | None = None, order: list[str] | None = None, indent: int = 2, backup: bool = True) -> None:
    """rows as one document, in order; with ``key`` as an object of arrays by that
    column, which the rows then lack. Nulls are written."""
    spark = rows.sparkSession
    spark.dataSource.register(DocumentSink)
    body = F.to_json(F.struct(*[F.col(f"`{c}`") for c in rows.columns if c != key]), {"ignoreNullFields": "false"})
    ranked = [*([key] if key else []), *(order or [])]
    rows = rows.repartitionByRange(*ranked).sortWithinPartitions(*ranked) if ranked else rows
    named = [F.col(f"`{key}`").cast("string").alias("key")] if key else []
    rows.select(*named, body.alias("value")).write.format("weftline_document").mode("append").option("path", path).option("indent", indent).option("backup", str(backup)).save()


def read_document(spark: SparkSession, path: str, nested: bool = True) -> DataFrame:
    """json_elements() of a document, or of its backup where it isn't whole."""
    for place in (path, f"{path}.backup"):
        if is_document(spark, place):
            return json_elements(spark, place, nested)
    raise ValueError(f"neither {path} nor its backup is a document")

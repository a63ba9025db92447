"""Copy-on-write keyed upsert into a folder of sorted Parquet files.

A table is a folder of files whose key ranges follow each other. Changes, one for
each key, are routed to the file that holds or would hold their key; base rows of
files that have changes and the changes themselves are range-partitioned by key,
and in each sorted stretch numpy's searchsorted places the changes: it gives vectors
of positions to delete, to patch and to insert, and new Arrow columns are taken by
them. Only files whose rows differ afterwards are written anew, cut into the fewest
files of at most so many rows, and neighbours that fit into one are joined; all
other files stay as they are.

Nothing but a row for each file or range partition meets in one place: rows get
their number in the table or their file from their partition's counts, the home of
a key is the last file start before it, carried over partitions; which files join
is decided by stretches, cut wherever two neighbours are too large together. A file
may be larger than memory: it is read, patched and written as a stream. The driver
moves and deletes files, as a commit does; new ones are complete before old ones go.
If the driver is lost, the folder is left with files of both kinds and the upsert
starts again from its inputs in a new one; a lost executor costs tasks.

Defined results: rows of the table with a null key are left out when its files are
written, changes with a null key are ignored; of rows that share a key all are
kept, patched and deleted together, in the order of a hash of their columns; an
empty table has no files, and changes find no home and are ignored; nulls (and NaNs)
are equal when rows are compared; columns keep their names and order, whatever they
are; changed columns are set to nulls too; a table whose last row goes has no files."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import materialize, row_mark, shared_dir
from .mixing import sums_before

DELETE, SET = 1, 2
#: Bits of a number that count rows inside a partition, as Spark's ids do.
ROW_BITS = 33


@dataclass
class SortedFiles:
    """A folder, and its files (file, name, first, last, n): their numbers in order
    of keys, from 0, their names there, key ranges and rows."""

    folder: str
    files: DataFrame
    schema: T.StructType
    key: str

    @property
    def inner(self) -> dict[str, str]:
        """Names of the columns while rows are worked on, by name in the files: the
        key is k, so that no name clashes with ours."""
        return {c: "k" if c == self.key else f"c{i}" for i, c in enumerate(self.schema.names)}

    def rows(self) -> DataFrame:
        """All rows under inner names; their file as ``name``, their position ``at``."""
        spark = self.files.sparkSession
        fs, path = _files(spark, self.folder)
        read = spark.read.schema(self.schema).parquet(self.folder) if fs.globStatus(path(f"{self.folder}/*.parquet")) else None
        where = [F.col("_metadata.file_name"), F.col("_metadata.row_index")] if read else [F.lit(""), F.lit(0).cast("long")]
        read = spark.createDataFrame([], self.schema) if read is None else read
        return read.select(*[F.col(f"`{c}`").alias(n) for c, n in self.inner.items()], where[0].alias("name"), where[1].alias("at"))


def new_folder(spark: SparkSession) -> str:
    """A folder of its own under the shared one, which stays."""
    return f"{shared_dir(spark)}/upsert-{uuid.uuid4().hex}"


def _named(prefix: str, number: Column) -> Column:
    return F.concat(F.lit(prefix), F.lpad(number.cast("string"), 12, "0"), F.lit(".parquet"))


def _files(spark: SparkSession, folder: str):
    """The file system of a folder, and its class of paths."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    return path(folder).getFileSystem(spark._jsc.hadoopConfiguration()), path


def _write(rows: DataFrame, inner: dict[str, str], order: list[str], folder: str, prefix: str) -> None:
    """One file for each value of the column ``file`` (whole numbers), its rows in
    this order. A file is written by one task as a stream, in a hidden folder, and
    moved when all are complete."""
    spark = rows.sparkSession
    staged, number = f"{folder}/_staged-{uuid.uuid4().hex}", "file"
    while number in {c.lower() for c in inner}:
        number += "_"
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartitionById(parts, F.pmod(F.col("file"), F.lit(parts)).cast("int")).sortWithinPartitions("file", *order)
    dealt.select(*[F.col(n).alias(c) for c, n in inner.items()], F.col("file").alias(number)).write.partitionBy(number).parquet(staged)
    fs, path = _files(spark, folder)
    for status in fs.globStatus(path(f"{staged}/{number}=*/*.parquet")) or []:  # a name for each file
        found = status.getPath()
        fs.rename(found, path(f"{folder}/{prefix}{found.getParent().getName().split('=')[1].rjust(12, '0')}.parquet"))
    fs.delete(path(staged), True)


def write_sorted(rows: DataFrame, key: str, most: int, folder: str) -> SortedFiles:
    """rows in files of ``most`` rows each, by key (the last: the rest)."""
    table = SortedFiles(folder, rows, rows.schema, key)
    tie = row_mark(rows)
    rows = rows.select(*[F.col(f"`{c}`").alias(n) for c, n in table.inner.items()], tie.alias("tie")).where("k is not null")
    # numbers in a partition follow its order; the counts of those before make them numbers of the table
    dealt = materialize(rows.repartitionByRange("k", "tie").sortWithinPartitions("k", "tie").withColumn("id", F.monotonically_increasing_id()))
    dealt = dealt.withColumn("part", F.shiftright("id", ROW_BITS))
    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each partition
    counts = dealt.groupBy("part").agg(F.count("*").alias("n")).select("part", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("ahead"))
    number = F.col("ahead") + F.col("id").bitwiseAND((1 << ROW_BITS) - 1)
    numbered = dealt.join(materialize(counts), "part").withColumn("file", F.floor(number / most))
    files = numbered.groupBy("file").agg(F.min("k").alias("first"), F.max("k").alias("last"), F.count("*").alias("n"))
    table.files = materialize(files.select("file", _named("start-", F.col("file")).alias("name"), "first", "last", "n"))
    _write(numbered, table.inner, ["k", "id"], folder, "start-")
    return table


def latest(changes: DataFrame, key: str, by: list[str]) -> DataFrame:
    """The row of each key that is highest by these columns (then by the others, in
    order; nulls are lowest). Keys are pre-aggregated before they are shuffled."""
    rest = [c for c in changes.columns if c not in (key, *by)]
    top = changes.groupBy(F.col(f"`{key}`")).agg(F.max(F.struct(*[F.col(f"`{c}`") for c in (*by, *rest)])).alias("__top"))
    return top.select(F.col(f"`{key}`"), *[F.col("__top").getField(c).alias(c) for c in (*by, *rest)])


def homes(table: SortedFiles, changes: DataFrame, key: str = "k") -> DataFrame:
    """changes with ``home``, the number of the last file that begins at or below
    their key, or else of the first, and ``first``, where that file begins. Changes
    with a null key are left out, and all where the table has no files."""
    marks = table.files.select(F.col("first").alias(key), F.lit(0).alias("kind"), F.struct("file", "first").alias("own"))
    both = changes.where(F.col(key).isNotNull()).withColumn("kind", F.lit(1)).unionByName(marks, allowMissingColumns=True)
    dealt = materialize(both.repartitionByRange(key).sortWithinPartitions(key, "kind").withColumn("id", F.monotonically_increasing_id()))
    dealt = dealt.withColumn("part", F.shiftright("id", ROW_BITS))
    # files are numbered by their keys, so the last one before is the highest
    parts = dealt.groupBy("part").agg(F.max("own").alias("own"))  # a row for each partition
    parts = parts.select("part", F.max("own").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)).alias("before"))
    inside = F.max("own").over(Window.partitionBy("part").orderBy("id").rowsBetween(Window.unboundedPreceding, 0))
    found = dealt.withColumn("inside", inside).where("kind = 1").join(parts, "part")
    begin = table.files.where("file = 0").select("file", "first").first()
    head = F.struct(F.lit(begin and begin["file"]).cast("long").alias("file"), F.lit(begin and begin["first"]).cast(table.schema[table.key].dataType).alias("first"))
    home = F.coalesce("inside", "before", head)
    return found.select(*changes.columns, home["file"].alias("home"), home["first"].alias("first")).where("home is not null")


def _differs(old: pa.ChunkedArray, new: pa.ChunkedArray) -> np.ndarray:
    """Where values differ; nulls are equal, and NaNs."""
    if pa.types.is_nested(old.type):
        return np.array([a != b for a, b in zip(old.to_pylist(), new.to_pylist(), strict=True)], bool)
    unequal = pc.fill_null(pc.not_equal(old, new), False)
    if pa.types.is_floating(old.type):
        unequal = pc.and_(unequal, pc.invert(pc.fill_null(pc.and_(pc.is_nan(old), pc.is_nan(new)), False)))
    return np.asarray(pc.or_(unequal, pc.xor(pc.is_null(old), pc.is_null(new)))).astype(bool)


def positional_delta(base: np.ndarray, keys: np.ndarray, deletes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Where changes fall in a sorted column of keys (a change for each of ``keys``,
    which ``deletes`` says to delete): the positions to delete; those to patch and
    by which change; the changes to insert, and before which positions."""
    low, high = np.searchsorted(base, keys, "left"), np.searchsorted(base, keys, "right")
    n = high - low
    row = np.repeat(low - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum()) if len(keys) else np.zeros(0, np.int64)
    change = np.repeat(np.arange(len(keys)), n)
    gone = deletes[change]
    inserts = np.flatnonzero((n == 0) & ~deletes)
    return row[gone], row[~gone], change[~gone], inserts, low[inserts]


def apply_delta(rows: pa.Table, columns: list[str], settable: list[str]) -> pa.Table:
    """Base rows and changes, sorted by key, become the new rows: base rows (those
    deleted marked ``gone``) with patched columns, and inserted ones; ``differs``
    marks what the delta altered."""
    kind, keys = np.asarray(rows["kind"]), np.asarray(rows["k"])
    base, changes = np.flatnonzero(kind == 0), np.flatnonzero(kind == 1)
    gone, patched, by, inserted, before = positional_delta(keys[base], keys[changes], np.asarray(rows["action"])[changes] == DELETE)
    own = np.insert(base, before, changes[inserted])  # positions before which rows go in are those of the base
    place = np.empty(len(kind), np.int64)
    place[own] = np.arange(len(own))
    value = own.copy()
    value[place[base[patched]]] = changes[by]
    differ = np.zeros(len(own), bool)
    out = {}
    for c in columns:
        if c in settable:
            old, new = rows[c].take(pa.array(base[patched])), rows[c].take(pa.array(changes[by]))
            differ[place[base[patched]]] |= _differs(old, new)
            out[c] = rows[c].take(pa.array(value))
        else:
            out[c] = rows[c].take(pa.array(own))
    lost = np.zeros(len(own), bool)
    lost[place[base[gone]]] = True
    differ[place[changes[inserted]]] = True
    out |= {"home": rows["home"].take(pa.array(own)), "gone": pa.array(lost), "differs": pa.array(differ | lost)}
    return pa.table(out)


def _merge(columns: list[str], settable: list[str]):
    """The stream of sorted base rows and changes as that of new rows, with their
    range partition and their number, there, in their file."""

    def merged(batches):
        from pyspark import TaskContext

        part, rest, file, seen = TaskContext.get().partitionId(), None, None, 0

        def numbered(t: pa.Table):
            nonlocal file, seen
            own, stays = np.asarray(t["home"]), ~np.asarray(t["gone"])
            at = np.zeros(len(own), np.int64)
            cuts = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]])) if len(own) else []
            for a, b in pairwise([*cuts, len(own)]):
                if own[a] != file:
                    file, seen = own[a], 0
                at[a:b] = seen + np.cumsum(stays[a:b]) - stays[a:b]
                seen += int(stays[a:b].sum())
            return t.append_column("at", pa.array(at)).append_column("part", pa.array(np.full(len(at), part)))

        for batch in batches:
            t = pa.Table.from_batches([batch])
            t = t if rest is None else pa.concat_tables([rest, t])
            keys = np.asarray(t["k"])
            if not len(keys):
                continue
            cut = int(np.searchsorted(keys, keys[-1]))  # rows of the last key may go on
            rest = t.slice(cut).combine_chunks()
            yield from numbered(apply_delta(t.slice(0, cut), columns, settable)).to_batches()
        if rest is not None:
            yield from numbered(apply_delta(rest, columns, settable)).to_batches()

    return merged


def upsert(table: SortedFiles, changes: DataFrame, settable: list[str], most: int, action: Callable[[Column, Column], Column]) -> DataFrame:
    """Apply changes (one for a key) to the table's files, in place. ``action``
    gives, of a change (a struct) and the first key of its home file, 1 (delete),
    2 (set the columns ``settable``, or insert) or null (ignore).

    Returns (name, n, rewritten) of the files that the folder holds then."""
    spark, inner, kinds = changes.sparkSession, table.inner, {f.name: f.dataType for f in table.schema}
    columns, patched = list(inner.values()), [inner[c] for c in settable]
    keyed = changes.select(F.col(f"`{table.key}`").cast(kinds[table.key]).alias("k"), F.struct(*[F.col(f"`{c}`") for c in changes.columns]).alias("change"))
    acts = homes(table, keyed).withColumn("action", action(F.col("change"), F.col("first")).cast("int")).where("action is not null")
    acts = materialize(acts.select("k", *[F.col("change").getField(c).cast(kinds[c]).alias(inner[c]) for c in settable], "action", "home"))
    # files that changes fall into, and those that end with a key of which the next has rows
    ends = acts.select("k").join(table.files.select(F.col("last").alias("k"), "file"), "k").select("file")
    touched = acts.select(F.col("home").alias("file")).unionByName(ends).distinct()
    touched = materialize(touched.join(table.files, "file").select(F.col("file").alias("home"), "name"))
    base = table.rows().join(touched, "name").drop("name").withColumn("kind", F.lit(0))
    both = base.unionByName(acts.withColumn("kind", F.lit(1)), allowMissingColumns=True)
    # keys alone decide the range, so that a change meets all rows of its key
    dealt = both.repartitionByRange("k").sortWithinPartitions("k", "kind", "home", "at").select(*columns, "kind", "action", "home")
    schema = ", ".join(f"{n} {kinds[c].simpleString()}" for c, n in inner.items()) + ", home long, gone boolean, differs boolean, at long, part long"
    new = materialize(dealt.mapInArrow(_merge(columns, patched), schema))
    # of each file: whether it differs, and its rows; of each of its stretches: the rows before
    stretch = new.groupBy("home", "part").agg(F.count_if(~F.col("gone")).alias("n"), F.max("differs").alias("differs"))
    ahead = F.coalesce(F.sum("n").over(Window.partitionBy("home").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    stretch = materialize(stretch.withColumn("ahead", ahead))
    state = stretch.groupBy(F.col("home").alias("file")).agg(F.sum("n").alias("now"), F.max("differs").alias("differs"))
    state = table.files.join(state, "file", "left").select("file", "name", F.coalesce("differs", F.lit(False)).alias("rewritten"), F.when(F.col("differs"), F.col("now")).otherwise(F.col("n")).alias("n"))
    state = materialize(state)
    pieces = materialize(planned_files(state, most))
    # a row's piece, from its number in the file
    cuts = state.where("rewritten and n > 0").select(F.col("file").alias("home"), F.col("n").alias("rows"), F.ceil(F.col("n") / most).alias("pieces"))
    number, size, more = F.col("at") + F.col("ahead"), F.floor(F.col("rows") / F.col("pieces")), F.col("rows") % F.col("pieces")
    piece = F.when(number < more * (size + 1), F.floor(number / (size + 1))).otherwise(more + F.floor((number - more * (size + 1)) / size))
    target = pieces.where("rewritten").select(F.col("file").alias("home"), "piece", F.col("into").alias("file"))
    rows = new.where("not gone").join(stretch.select("home", "part", "ahead"), ["home", "part"]).join(cuts, "home").withColumn("piece", piece).join(target, ["home", "piece"])
    prefix = f"new-{uuid.uuid4().hex[:8]}-"
    _write(rows, inner, ["k", "home", "part", "at"], table.folder, prefix)
    fs, path = _files(spark, table.folder)
    for row in state.where("rewritten").select("name").toLocalIterator():  # a name for each file that goes
        fs.delete(path(f"{table.folder}/{row['name']}"), False)
    name = F.when(F.col("rewritten"), _named(prefix, F.col("into"))).otherwise(F.col("name"))
    return pieces.groupBy(name.alias("name"), "rewritten").agg(F.sum("size").alias("n"))


def planned_files(state: DataFrame, most: int) -> DataFrame:
    """(file, name, piece, size, rewritten, into): the pieces of each file (one, if
    it isn't rewritten; none, if it is empty) and the number of the new file that
    holds them: each piece joins its left neighbour, as that has grown, if both are
    of rewritten files and have at most ``most`` rows together."""
    k = F.when(F.col("rewritten"), F.ceil(F.col("n") / most)).otherwise(F.lit(1)).cast("long")
    cut = state.where("n > 0").withColumn("k", k).withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), F.col("k") - 1)))
    size = F.floor(F.col("n") / F.col("k")) + (F.col("piece") < F.col("n") % F.col("k")).cast("long")
    cut = cut.select("file", "name", "piece", size.alias("size"), "rewritten")
    order = [F.col("file"), F.col("piece")]
    ranked = materialize(sums_before(cut, order, {"rank": F.lit(1)}))
    left = ranked.select((F.col("rank") + 1).alias("rank"), F.col("size").alias("beside"), F.col("rewritten").alias("also"))
    # two that are too large together never join, however the left one has grown
    apart = ~F.coalesce(F.col("rewritten") & F.col("also") & (F.col("size") + F.col("beside") <= most), F.lit(False))
    marked = ranked.join(left, "rank", "left").select(*ranked.columns, apart.cast("long").alias("apart"))
    marked = sums_before(marked, [F.col("rank")], {"before": F.col("apart")}).withColumn("stretch", F.col("before") + F.col("apart"))

    def joined(batches):
        stretch, into, held = None, 0, 0
        for batch in batches:
            out = np.zeros(batch.num_rows, np.int64)
            for i, (own, rank, size) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("stretch", "rank", "size")), strict=True)):
                if own == stretch and held + size <= most:
                    held += size
                else:
                    stretch, into, held = own, rank, size
                out[i] = into
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in ("file", "name", "piece", "size", "rewritten")], pa.array(out)], names=["file", "name", "piece", "size", "rewritten", "into"])

    dealt = marked.repartition("stretch").sortWithinPartitions("stretch", "rank").select("stretch", "rank", "file", "name", "piece", "size", "rewritten")
    return dealt.mapInArrow(joined, "file long, name string, piece long, size long, rewritten boolean, into long")


def digests(table: SortedFiles, files: DataFrame, sums: Callable[[dict[str, Column]], dict[str, Column]]) -> DataFrame:
    """(name, first_id, n_rows, sums, ids_sha256, columns, rewritten) of each file,
    from what lies in it; ``sums`` gives what to sum up, of the table's columns. One
    task reads a file's keys in order, as a stream."""
    import hashlib

    wanted = sums({c: F.col(n) for c, n in table.inner.items()})
    names = list(wanted)
    read = table.rows().select("name", "at", F.col("k").cast("string").alias("k"), *[F.coalesce(v, F.lit(0)).cast("long").alias(f"s{i}") for i, v in enumerate(wanted.values())])

    def digest(batches):
        own, hashed, first, count, total = None, None, None, 0, [0] * len(names)

        def row():
            return pa.RecordBatch.from_arrays([pa.array([x]) for x in (own, first, count, *total, hashed.hexdigest())], names=["name", "first_id", "n_rows", *names, "ids_sha256"])

        for batch in batches:
            name = batch.column("name").dictionary_encode()
            code, keys = np.asarray(name.indices), batch.column("k").to_pylist()
            cuts = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]])) if len(code) else []
            for a, b in pairwise([*cuts, len(code)]):
                this, joined = name.dictionary[code[a]].as_py(), ",".join(keys[a:b])
                if this != own:
                    if own is not None:
                        yield row()
                    own, hashed, first, count, total = this, hashlib.sha256(), keys[a], 0, [0] * len(names)
                else:
                    joined = "," + joined
                hashed.update(joined.encode())
                count += int(b - a)
                total = [t + int(np.asarray(batch.column(f"s{i}"))[a:b].sum()) for i, t in enumerate(total)]
        if own is not None:
            yield row()

    dealt = read.repartition("name").sortWithinPartitions("name", "at").drop("at")
    found = dealt.mapInArrow(digest, "name string, first_id string, n_rows long, " + "".join(f"`{n}` long, " for n in names) + "ids_sha256 string")
    found = found.join(files.select("name", "rewritten"), "name").withColumn("first_id", F.col("first_id").cast(table.schema[table.key].dataType))
    return found.withColumn("columns", F.lit(",".join(table.schema.names)))

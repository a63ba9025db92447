"""The keyed upsert held against a plain one over lists, and its odd cases."""

import glob
import hashlib
import math
import random
import zlib

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from weftline.llm.queries import op13_upsert
from weftline.llm.upsert import DELETE, SET, digests, latest, new_folder, planned_files, upsert, write_sorted

CHANGED = ["source", "segment", "city", "balance"]


def crc(x):
    return zlib.crc32(str(x).encode())


def joined(pieces, most):
    """[(rows, rewritten)] with neighbours joined, in order."""
    out = []
    for rows, rewritten in pieces:
        if rewritten and out and out[-1][1] and len(out[-1][0]) + len(rows) <= most:
            out[-1] = (out[-1][0] + rows, True)
        else:
            out.append((list(rows), rewritten))
    return out


def plain(clients, changes, most, key="client_id"):
    """Files as lists of rows, by the contract."""
    start = sorted((r for r in clients if r[key] is not None and crc(r[key]) % 7 > 3), key=lambda r: r[key])
    files = [start[i : i + most] for i in range(0, len(start), most)]
    wins = {}
    low = lambda x: (x is not None, x)
    for c in changes:
        rank = (low(c["seq"]), low(c["change_id"]))
        if c[key] is not None and (c[key] not in wins or rank > wins[c[key]][0]):
            wins[c[key]] = (rank, c)
    new = [list(f) for f in files]
    for k, (_, c) in sorted(wins.items()):
        at = max([i for i, f in enumerate(files) if f[0][key] <= k], default=0)
        h = crc(files[at][0][key]) % 16 if files else 99
        if h > 7:
            continue
        own = [r for r in new[at] if r[key] == k]
        rest = [r for r in new[at] if r[key] != k]
        if c["op"] == "D" or (c["change_id"] is not None and crc(c["change_id"]) % 8 < h):
            new[at] = rest
        else:
            own = own or [dict.fromkeys(clients[0]) | {key: k}]
            new[at] = sorted(rest + [r | {n: c[n] for n in CHANGED} for r in own], key=lambda r: r[key])
    pieces = []
    for old, now in zip(files, new, strict=True):
        if old == now:
            pieces.append((now, False))
        elif now:
            k = math.ceil(len(now) / most)
            sizes = [len(now) // k + (i < len(now) % k) for i in range(k)]
            for i in range(k):
                pieces.append((now[sum(sizes[:i]) : sum(sizes[: i + 1])], True))
    return joined(pieces, most)


def expected(files):
    out = []
    for rows, rewritten in files:
        cents = sum(math.floor(100 * r["balance"] + 0.5) for r in rows if r["balance"] is not None)
        crcs = sum(crc("|".join(r[n] or "" for n in CHANGED[:3])) for r in rows)
        ids = ",".join(str(r["client_id"]) for r in rows)
        out.append((rows[0]["client_id"], len(rows), cents, crcs, hashlib.sha256(ids.encode()).hexdigest(), rewritten))
    return sorted(out)


def test_query_against_lists(spark, sf="/root/testdata/sf0.001"):
    clients = [r.asDict() for r in spark.read.parquet(f"{sf}/clients.parquet").collect()]
    changes = [r.asDict() for r in spark.read.parquet(f"{sf}/client_changes.parquet").collect()]
    most = 1 + len(clients) // 1000
    want = plain(clients, changes, most)
    got = op13_upsert(spark, sf).collect()
    assert sorted((r.first_id, r.n_rows, r.cents, r.rows_crc, r.ids_sha256, r.rewritten) for r in got) == expected(want)
    assert {r.columns for r in got} == {",".join(clients[0])}
    folder = got[0].path.rsplit("/", 1)[0].removeprefix("file://")
    assert sorted(glob.glob(f"{folder}/**/*.parquet", recursive=True)) == sorted(r.path.removeprefix("file://") for r in got)
    by_first = {rows[0]["client_id"]: rows for rows, _ in want}
    for r in got:  # whole rows, in order, as the files hold them
        table = pq.ParquetFile(r.path.removeprefix("file://")).read()
        assert table.column_names == list(clients[0]) and table.to_pylist() == by_first[r.first_id]


@pytest.mark.parametrize("seed", range(3))
def test_random_tables(spark, seed):
    """Small files, many changes, nulls, odd column names; sizes 1 to 7."""
    pick = random.Random(seed)
    kinds = "client_id long, home string, source string, segment string, city string, balance double"
    word = lambda: pick.choice([None, "a", "b", "ü"])
    ids = pick.sample(range(-40, 160), 120)
    clients = [{"client_id": i, "home": word(), "source": word(), "segment": word(), "city": word(), "balance": pick.choice([None, 0.5, -1.25])} for i in ids] + [dict.fromkeys(("client_id", "home", *CHANGED))]
    same = pick.sample(clients, 40)
    changes = [{"change_id": j, "client_id": pick.choice([*range(-60, 400), None]), "seq": pick.choice([None, 1, 2]), "op": pick.choice([None, "D", "U"]), **{n: word() for n in CHANGED[:3]}, "balance": pick.choice([None, 0.5])} for j in range(300)]
    changes += [{"change_id": 1000 + j, "client_id": c["client_id"], "seq": 9, "op": "U", **{n: c[n] for n in CHANGED}} for j, c in enumerate(same)]
    most = 1 + 3 * seed
    base = spark.createDataFrame([tuple(c.values()) for c in clients], kinds)
    moved = spark.createDataFrame([tuple(c.values()) for c in changes], "change_id long, client_id long, seq long, op string, source string, segment string, city string, balance double").repartition(5)
    code = lambda c: F.crc32(c.cast("string").cast("binary"))
    table = write_sorted(base.where(code(F.col("client_id")) % 7 > 3), "client_id", most, new_folder(spark))

    def action(change, first):
        h = code(first) % 16
        return F.when(h <= 7, F.when(F.coalesce(change["op"] == "D", F.lit(False)) | (code(change["change_id"]) % 8 < h), DELETE).otherwise(SET))

    files = upsert(table, latest(moved, "client_id", ["seq", "change_id"]), CHANGED, most, action)
    sums = lambda c: {"cents": F.floor(100 * c["balance"] + 0.5), "rows_crc": F.crc32(F.concat_ws("|", *[F.coalesce(c[n], F.lit("")) for n in CHANGED[:3]]).cast("binary"))}
    got = digests(table, files, sums).collect()
    assert sorted((r.first_id, r.n_rows, r.cents, r.rows_crc, r.ids_sha256, r.rewritten) for r in got) == expected(plain(clients, changes, most))


def test_keys_over_two_files_and_empty_tables(spark):
    base = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c"), (2, "d"), (3, "e"), (None, "x")], "id long, kind string")
    table = write_sorted(base, "id", 2, new_folder(spark))
    assert [(r.file, r.first, r.last, r.n) for r in table.files.orderBy("file").collect()] == [(0, 1, 2, 2), (1, 2, 2, 2), (2, 3, 3, 1)]
    changes = spark.createDataFrame([(2, "z")], "id long, kind string")
    files = upsert(table, changes, ["kind"], 2, lambda change, first: F.lit(SET))
    assert sorted((r.n, r.rewritten) for r in files.collect()) == [(1, False), (2, True), (2, True)]
    assert sorted((r.k, r.c1) for r in table.rows().collect()) == [(1, "a"), (2, "z"), (2, "z"), (2, "z"), (3, "e")]
    table = write_sorted(base, "id", 2, new_folder(spark))
    files = upsert(table, base.where("id is not null").select("id", "kind").dropDuplicates(["id"]), ["kind"], 2, lambda change, first: F.lit(DELETE))
    assert files.count() == 0 and table.rows().count() == 0 and digests(table, files, lambda c: {}).count() == 0
    table = write_sorted(base.where("false"), "id", 2, new_folder(spark))
    files = upsert(table, changes, ["kind"], 2, lambda change, first: F.lit(SET))
    assert files.count() == 0 and digests(table, files, lambda c: {}).count() == 0
    table = write_sorted(base, "id", 2, new_folder(spark))
    files = upsert(table, changes.where("false"), ["kind"], 2, lambda change, first: F.lit(SET))
    assert [r.rewritten for r in files.collect()] == [False] * 3


def test_neighbours_join_as_grown(spark):
    rows = [(0, "a", True, 2), (1, "b", True, 2), (2, "c", True, 2), (3, "d", False, 1), (4, "e", True, 1), (5, "f", True, 0), (6, "g", True, 3), (7, "h", True, 9)]
    state = spark.createDataFrame(rows, "file long, name string, rewritten boolean, n long")
    got = planned_files(state, 4).groupBy("into").agg(F.sum("size").alias("n")).orderBy("into").collect()
    assert [r.n for r in got] == [4, 2, 1, 4, 3, 3, 3]

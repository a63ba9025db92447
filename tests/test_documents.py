"""Documents read by byte ranges against json.loads."""

import json
import random

import numpy as np
import pytest

from weftline.sources import documents, files


def made(seed, nested):
    pick = random.Random(seed)
    strange = ['}', '"', "\\", "[{", "}]", "\n", "é½", "a", '\\"}', " ", ",", ":"]

    def value(depth=0):
        k = pick.randrange(6 if depth < 3 else 3)
        if k == 0:
            return "".join(pick.choice(strange) for _ in range(pick.randrange(9)))
        if k == 1:
            return pick.choice([None, True, 1.5, -3, 0])
        if k == 2:
            return ""
        return [value(depth + 1) for _ in range(pick.randrange(4))] if k == 3 else {pick.choice(strange) + str(i): value(depth + 1) for i in range(pick.randrange(4))}

    items = lambda: [value() if pick.random() < 0.3 else {"post_id": str(pick.randrange(99)), "title": value(9), "more": value()} for _ in range(pick.randrange(12))]
    if not nested:
        return items()
    return {"".join(pick.choice(strange) for _ in range(3)) + str(i): pick.choice([items(), items(), items(), value(), {"x": [{"y": 1}], "z": items()}, []]) for i in range(12)}


def plain(document, nested):
    if not nested:
        return [(None, None, i, x) for i, x in enumerate(document) if isinstance(x, dict)]
    return [(k, n, i, x) for n, (k, v) in enumerate(document.items()) if isinstance(v, list) for i, x in enumerate(v) if isinstance(x, dict)]


@pytest.mark.parametrize("nested", [True, False])
def test_ranges_of_every_size(spark, tmp_path, nested):
    for seed in range(2):
        document, indent = made(seed, nested), seed or None
        path = tmp_path / f"d{seed}.json"
        path.write_text(json.dumps(document, indent=indent, ensure_ascii=bool(seed % 2)), encoding="utf-8")
        for size in (f"{len(path.read_bytes()) // 25}b", "1m"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            spark.conf.set("spark.sql.files.openCostInBytes", "1b")
            try:
                found = documents.json_elements(spark, str(path), nested)
                got = sorted((r.key_pos or 0, r.pos, r.key, json.loads(r.value)) for r in found.collect())
            finally:
                spark.conf.unset("spark.sql.files.maxPartitionBytes")
                spark.conf.unset("spark.sql.files.openCostInBytes")
            assert got == sorted((n or 0, i, k, x) for k, n, i, x in plain(document, nested))


def test_several_tasks_read_one_document(spark, tmp_path):
    path = tmp_path / "one.json"
    posts = [{"post_id": str(i), "title": "t" * 50, "comments": [{"comment_id": "c", "body": "{b}", "score": i}]} for i in range(2000)]
    path.write_text(json.dumps({"a": posts[:1500], "b": posts[1500:]}))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        assert spark.read.option("lineSep", "}").text(str(path)).rdd.getNumPartitions() > 8
        rows = files.category_map(spark, str(path)).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sorted((r.category, r.pos, r.post_id) for r in rows) == sorted([("a", i, str(i)) for i in range(1500)] + [("b", i, str(1500 + i)) for i in range(500)])
    assert all(r.comments[0].body == "{b}" for r in rows)


def test_broken_and_empty_documents(spark, tmp_path):
    for name, text in {"cut": '{"a": [{"post_id": "1"}, {"post', "string": '{"a": [{"post_id": "1}]}', "empty": "", "null": "null", "other": '{"a": 1, "b": {"c": [{"d": 2}]}}', "good": ' \n{"a": [{"post_id": "7"}]}\n'}.items():
        (tmp_path / f"{name}.json").write_text(text)
    found = documents.json_elements(spark, str(tmp_path)).collect()
    assert [(r.key, r.key_pos, r.pos, json.loads(r.value)) for r in found] == [("a", 0, 0, {"post_id": "7"})]
    with pytest.raises(Exception, match="no JSON document"):
        documents.json_elements(spark, f"{tmp_path}/cut.json", strict=True).collect()


def test_escaped_quotes():
    data = np.frombuffer(rb'"a\"b" "\\" "\\\" }"', np.uint8)
    assert np.flatnonzero(documents.switches(data)).tolist() == [0, 5, 7, 10, 12, 19]


def test_cut_and_put_together_without_spark():
    """The two scans over every cut of small documents, by hand."""
    import pyarrow as pa

    for seed in range(40):
        nested = seed % 3 > 0
        text = json.dumps(made(seed, nested), indent=seed % 2 or None, ensure_ascii=seed % 4 == 0)
        pieces = text.split("}")
        pieces = pieces[:-1] if pieces[-1] == "" else pieces
        step = 1 + seed % 7
        starts = [i // step for i in range(len(pieces))]
        batch = pa.RecordBatch.from_pydict({"file": ["f"] * len(pieces), "start": starts, "value": pieces})
        parts = pa.Table.from_batches(list(documents._measured(iter([batch])))).to_pandas().rename(columns={"out": "outside", "in": "inside"})
        parts["part"] = range(len(parts))
        begin = documents._begin(parts).set_index("start")
        assert begin["whole"].all()
        inside, depth = begin["inside"].to_dict(), begin["depth"].to_dict()
        batch = pa.RecordBatch.from_pydict({"file": ["f"] * len(pieces), "start": starts, "value": pieces, "inside": [bool(inside[s]) for s in starts], "depth": [int(depth[s]) for s in starts]})
        rows = [r for b in documents._cut(nested)(iter([batch])) for r in b.to_pylist()]
        values: list[list[str]] = []
        for r in rows:
            if r["kind"] in ("whole", "tail"):
                values.append([r["text"]])
            elif r["kind"] in ("head", "middle"):
                values[-1].append(r["text"])
        found = ["".join(v) for v in values if v[0].startswith("{")]
        top = [x for v in json.loads(text).values() if isinstance(v, list | dict) for x in (v if isinstance(v, list) else v.values())] if nested else json.loads(text)
        assert [json.loads(v) for v in found] == [x for x in top if isinstance(x, dict)]


def test_tables_are_dealt_out_by_their_size(spark, tmp_path, monkeypatch):
    from weftline import tables

    path = f"{tmp_path}/t.parquet"
    spark.range(20_000).coalesce(1).write.parquet(path)  # one row group
    monkeypatch.setattr(tables, "SHARE", 4000, raising=False)
    dealt = tables.spread(spark.read.parquet(path))
    sizes = [len(p) for p in dealt.rdd.glom().collect()]
    assert len(sizes) > 2 * spark.sparkContext.defaultParallelism and max(sizes) < 2 * 20_000 / len(sizes)
    monkeypatch.setattr(tables, "SHARE", 1 << 30)
    assert tables.spread(spark.read.parquet(path)).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism

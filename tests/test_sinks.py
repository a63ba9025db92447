"""The document sink, the forum stream and keyed appends: what stays when they fail."""

import json

import pytest
from pyspark.sql import functions as F

from weftline.sources import sinks
from weftline.sources import web as sources
from weftline.streaming import incremental


def test_documents_as_json_writes_them(spark, tmp_path):
    path = tmp_path / "d.json"
    rows = spark.createDataFrame([("b", i, None if i % 3 else f"é\"{i}", [i]) for i in range(7)] + [("a\"}", 9, "x", []), ("c", 1, "", None)], "kind string, n long, text string, list array<long>").repartition(4)
    own = [{"n": r.n, "text": r.text, "list": r.list} for r in sorted(rows.collect(), key=lambda r: (r.kind, r.n))]
    sinks.write_document(rows, str(path), "kind", ["n"])
    want = {"a\"}": own[:1], "b": own[1:8], "c": own[8:]}
    assert path.read_text() == json.dumps(want, indent=2, ensure_ascii=False).replace("[]", "[]") + "\n"
    sinks.write_document(rows.drop("kind"), str(path), order=["n", "text"], indent=4)
    assert [x["n"] for x in json.loads(path.read_text())] == [0, 1, 1, 2, 3, 4, 5, 6, 9]
    assert json.loads((tmp_path / "d.json.backup").read_text()) == want
    sinks.write_document(rows.where("false").drop("kind"), str(path), backup=False)
    assert json.loads(path.read_text()) == [] and json.loads((tmp_path / "d.json.backup").read_text()) == want
    sinks.write_document(rows.where("false"), str(path), "kind")
    assert json.loads(path.read_text()) == {} and sorted(p.name for p in tmp_path.iterdir() if not p.name.startswith(".")) == ["d.json", "d.json.backup"]


def test_a_failed_task_leaves_the_old_document(spark, tmp_path):
    path = tmp_path / "d.json"
    sinks.write_document(spark.range(50).withColumn("k", F.lit("a")), str(path), "k", ["id"])
    old = path.read_text()
    bad = spark.range(0, 100, 1, 4).withColumn("k", F.when(F.col("id") == 99, F.raise_error(F.lit("stop"))).otherwise("a"))
    with pytest.raises(Exception, match="stop"):
        sinks.write_document(bad, str(path))
    assert path.read_text() == old and sorted(p.name for p in tmp_path.iterdir() if not p.name.startswith(".")) == ["d.json"]
    path.write_text(old[:-40])  # broken from outside: its backup is read
    (tmp_path / "d.json.backup").write_text(old)
    assert sinks.read_document(spark, str(path)).count() == 50
    (tmp_path / "d.json.backup").unlink()
    with pytest.raises(ValueError, match="neither"):
        sinks.read_document(spark, str(path))


def test_what_cannot_be_replaced_is_kept_beside(spark, tmp_path):
    path = tmp_path / "d.json"
    path.mkdir()
    (path / "x").write_text("in the way")
    with pytest.raises(Exception):  # noqa: B017
        sinks.write_document(spark.range(3), str(path), order=["id"])
    saved = list(tmp_path.glob("emergency_save_*.json"))
    assert len(saved) == 1 and json.loads(saved[0].read_text()) == [{"id": 0}, {"id": 1}, {"id": 2}]
    assert [p.name for p in tmp_path.iterdir() if "staged" in p.name or "tmp" in p.name] == []


class Client:
    """A forum of numbered posts; a file says how many there are and which one fails."""

    @staticmethod
    def _state(options):
        with open(options["state"], encoding="utf-8") as file:
            return json.load(file)

    @classmethod
    def latest(cls, category, query, options):
        state = cls._state(options)
        if category in state.get("down", []):
            raise OSError("down")
        return state["n"] // int(query)

    @classmethod
    def posts(cls, category, query, start, end, options):
        ids = [i * int(query) for i in range(start, end)]
        if cls._state(options).get("fails") in ids:
            raise OSError("page lost")
        return [{"post_id": f"{category}{i}", "title": "t", "score": i, "comments": [{"comment_id": "c", "body": "b", "score": 1}]} for i in ids]


def test_forum_goes_on_after_failures(spark, tmp_path):
    sources.register(spark)
    state, target, checkpoint = tmp_path / "state.json", f"{tmp_path}/target", f"{tmp_path}/check"

    def run(**now):
        state.write_text(json.dumps(now))
        read = spark.readStream.format("weftline_forum").option("categories", "a\nb").option("queries", "all=1\nthird=3").option("page", "4")
        stream = read.option("client", "tests.test_sinks:Client").option("state", str(state)).load()
        return incremental.append_stream(stream, target, checkpoint, ["category", "post_id"], ["query", "place"])

    ids = lambda n: sorted(f"{c}{i}" for c in "ab" for i in range(n))
    assert sorted(r.post_id for r in run(n=10).collect()) == ids(10)
    with pytest.raises(Exception, match="page lost"):
        run(n=30, fails=17)
    found = run(n=30).collect()  # the batch that failed is repeated
    assert sorted(r.post_id for r in found) == ids(30)
    assert all(r.query == "all" and r.comments[0].body == "b" for r in found)
    with pytest.raises(Exception, match="down"):  # a new run doesn't know its place in a category that is down
        run(n=30, down=["b"])
    assert sorted(r.post_id for r in run(n=31).collect()) == ids(31)


def test_keys_that_were_there_and_repeated_batches(spark, tmp_path):
    source, target, checkpoint = f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/check"
    rows = lambda pairs: spark.createDataFrame(pairs, "k string, v long")
    rows([("a", 0), ("b", 0)]).write.parquet(f"{target}/old=1")
    append = lambda: incremental.append_stream(spark.readStream.schema("k string, v long").parquet(source), target, checkpoint, ["k"], ["v"])
    rows([("b", 1), ("c", 3), ("c", 2), (None, 7)]).write.mode("append").parquet(source)
    assert sorted(map(tuple, append().collect()), key=str) == [("a", 0), ("b", 0), ("c", 2), (None, 7)]
    rows([("c", 1), ("d", 4), (None, 8)]).write.mode("append").parquet(source)
    assert sorted(r.k or "" for r in append().collect()) == ["", "a", "b", "c", "d"]
    # the driver died after a batch was written and before it was noted: it is repeated
    commits = sorted((tmp_path / "check" / "commits").glob("[0-9]*"))
    commits[-1].unlink()
    (commits[-1].parent / f".{commits[-1].name}.crc").unlink(missing_ok=True)
    assert sorted(r.k or "" for r in append().collect()) == ["", "a", "b", "c", "d"]


def test_a_page_of_the_forum_reads_its_blocks_only(spark, tmp_path, monkeypatch):
    from weftline.plans import roundtrips as R

    rows = spark.range(5000).selectExpr("concat('c', id % 2) as category", "id * 3 as place", "cast(id as string) as post_id")
    folder = f"file://{tmp_path}/forum"
    R.write_forum(rows, folder, ["1", "2"])
    read, lines = [], R.ConversationForum._lines
    monkeypatch.setattr(R.ConversationForum, "_lines", staticmethod(lambda f: read.append(lines(f)) or read[-1]))
    for category in ("c0", "c1", "c2"):
        for query in ("1", "2"):
            for until in (0, 1, 4500, 7000, 99_999):
                options = {"folder": folder, "until": str(until)}
                want = [i for i in range(5000) if f"c{i % 2}" == category and 3 * i % int(query) == 0 and 3 * i < until]
                assert R.ConversationForum.latest(category, query, options) == len(want)
                for start in (0, 19, 330, 2400):
                    read.clear()
                    got = R.ConversationForum.posts(category, query, start, start + 20, options)
                    assert [int(p["post_id"]) for p in got] == want[start : start + 20]
                    assert sum(map(len, read)) < 700  # of 2500 in the category

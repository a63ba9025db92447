import hashlib

from weftline.llm.spotsigs import fingerprints_with_edits, spot_links

BASE = "the river ran under a bridge and the people of the town were on the road to see it in the morning light of day"


def sets(fp):
    return {fp[i : i + 8] for i in range(0, len(fp), 8)}


def likeness(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def test_edited_and_next(spark, odd, empty):
    own = odd.where("doc_id is not null").dropDuplicates(["doc_id"])
    for table in (own, own.limit(1)):
        rows = sorted(((r.doc_id, r.text or "") for r in table.collect()), reverse=True)
        got = {r.doc_id: r for r in fingerprints_with_edits(table).collect()}
        for (i, text), (j, after) in zip(rows, rows[1:] + rows[:1], strict=True):
            half = len(text) // 2
            edited = text[: len(text) - half] + after[:half]
            r = got[i]
            assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
            assert abs(r.near_next - likeness(sets(r.fingerprint), sets(got[j].fingerprint))) < 1e-12
            assert abs(r.near_edited - likeness(sets(r.fingerprint), sets(r.edited_fingerprint))) < 1e-12
    assert fingerprints_with_edits(empty).count() == 0
    assert fingerprints_with_edits(odd).count() == odd.count()


def test_equal_texts_and_halves(spark):
    other = "nobody saw what was in the box that he had with him at the door of the old house by the sea"
    df = spark.createDataFrame([(1, BASE), (2, other), (3, BASE), (4, BASE.upper())], "doc_id long, text string")
    r = {x.doc_id: x for x in fingerprints_with_edits(df).collect()}
    assert r[1].fingerprint == r[3].fingerprint == r[4].fingerprint != r[2].fingerprint
    assert r[4].near_next == 1.0 and r[3].near_next < r[3].near_edited < 0.9


def test_links_equal_brute_force(spark):
    words = BASE.split()
    rows = [(i, " ".join(words[:k] + ["x%d" % i] + words[k:])) for i, k in enumerate([0, 3, 3, 9, 14, 22, 23])] + [(20, BASE), (21, BASE), (22, ""), (23, None), (24, "the " * 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    prints = {r.doc_id: sets(r.fingerprint) for r in fingerprints_with_edits(df).collect()}
    for least in (0.5, 0.8):
        links, member = spot_links(df, least)
        classes = {r.doc_id: r["class"] for r in member.collect()}
        assert len(classes) == len(rows) and classes[21] == classes[20] == 0  # a content word without an anchor before it changes nothing
        reps = sorted({c for c in classes.values() if prints[c]})
        want = {(a, b) for a in reps for b in reps if a < b and likeness(prints[a], prints[b]) >= least}
        assert {(r.a, r.b) for r in links.collect()} == want

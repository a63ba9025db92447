import random

from pyspark.sql import functions as F

from weftline.operators import spelling
from weftline.plans import queries as Q


def edits_between(a, b):
    """Damerau and Levenshtein's distance by the table of Lowrance and Wagner."""
    last, far = {}, len(a) + len(b)
    d = {(-1, -1): far}
    for i in range(len(a) + 1):
        d[i, -1], d[i, 0] = far, i
    for j in range(len(b) + 1):
        d[-1, j], d[0, j] = far, j
    for i in range(1, len(a) + 1):
        col = 0
        for j in range(1, len(b) + 1):
            row, at = last.get(b[j - 1], 0), col
            if a[i - 1] == b[j - 1]:
                col = j
            d[i, j] = min(d[i - 1, j - 1] + (a[i - 1] != b[j - 1]), d[i, j - 1] + 1, d[i - 1, j] + 1, d[row - 1, at - 1] + i - row + j - at - 1)
        last[a[i - 1]] = i
    return d[len(a), len(b)]


def test_edit_count_equals_the_distance(spark):
    rng = random.Random(4)
    words = ["axb", "ba", "ca", "abc"] + ["".join(rng.choice("abcd") for _ in range(rng.randrange(1, 7))) for _ in range(60)]
    pairs = spark.createDataFrame([(a, b) for a in words for b in words], "a string, b string")
    for r in pairs.withColumn("n", spelling.edit_count(F.col("a"), F.col("b"))).collect():
        assert r.n == min(edits_between(r.a, r.b), 3), r


def test_registered_query_corrects_two_edits(spark, tmp_path):
    rng = random.Random(5)
    known = {"".join(rng.choice("abcdef") for _ in range(rng.randrange(5, 9))): 40 + i % 3 for i in range(12)}
    rare = set()
    for w in known:
        for _ in range(8):
            x = list(w)
            for _ in range(rng.randrange(1, 4)):
                i = rng.randrange(len(x))
                x[i : i + 1] = rng.choice([[], [rng.choice("abcdef")], [x[i], rng.choice("abcdef")], [*x[i + 1 : i + 2], x[i]]])
            if len(x) > 2:
                rare.add("".join(x))
    rare -= set(known)
    texts = [" ".join([w] * n) for w, n in known.items()] + [" ".join(sorted(rare))]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    want, two = {}, 0
    for w in rare:
        best = min((edits_between(w, k), -n, k) for k, n in known.items())
        if best[0] <= 2:
            want[w] = best[2]
            two += best[0] == 2
    assert two > 10
    assert {r.word: r.correction for r in Q.token_spelling_two(spark, str(tmp_path)).collect()} == want


def test_few_edits_are_those_of_short_words(spark):
    pick = random.Random(3)
    pairs = [("".join(pick.choice("abc") for _ in range(pick.randrange(1, 7))), "".join(pick.choice("abc") for _ in range(pick.randrange(1, 7)))) for _ in range(1500)]
    rows = spark.createDataFrame(pairs, "a string, b string").select("a", "b", spelling.edit_count(F.col("a"), F.col("b")).alias("n")).collect()
    for r in rows:
        assert spelling.few_edits(r.a, r.b, 2) == r.n, (r.a, r.b)


def test_long_words(spark):
    pick = random.Random(8)
    letters = lambda n: "".join(pick.choice("abcdefgh") for _ in range(n))

    def edited(w, times):
        for _ in range(times):
            i, k = pick.randrange(len(w) - 1), pick.randrange(4)
            w = [w[:i] + w[i + 1 :], w[:i] + "z" + w[i:], w[:i] + "y" + w[i + 1 :], w[:i] + w[i + 1] + w[i] + w[i + 2 :]][k]
        return w

    known = [letters(n) for n in (20, 31, 32, 33, 34, 40, 64, 500, 3000)] + ["a" * 20_000]
    unknown = {edited(w, t): w for w in known for t in (1, 2)} | {"a" * 19_999 + "b": "a" * 20_000, "b" + "a" * 20_000 + "b": "a" * 20_000}
    far = [letters(n) for n in (33, 64, 500, 20_000)]
    dictionary = spark.createDataFrame([(w, 1) for w in known], "word string, freq long")
    words = spark.createDataFrame([(w,) for w in [*unknown, *far] if w not in known], "word string")
    got = {r.word: r.correction for r in spelling.corrections(words, dictionary).collect()}
    assert got == {w: c for w, c in unknown.items() if w not in known}


def test_corrected_texts_shuffle_words_and_not_tokens(spark):
    """Casing, repeats, odd characters, rows that share a key or have none; and what
    leaves a text are the words to be corrected, not all of its tokens."""
    dictionary = spark.createDataFrame([("river", 50), ("house", 60)], "word string, freq long")
    rows = [(1, "A Rivr, the RIVR! rivr\u212a  hause\n"), (2, "river house"), (3, ""), (4, None), (5, "rivr b"), (5, "c hause"), (None, "Hause")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = spelling.correct(docs, dictionary, "doc_id", skip=["the"], edits=1)
    want = {1: "A River, the RIVER! river\u212a  house\n", 2: "river house", 5: "criver  bhouse", None: "House"}
    assert {r.doc_id: r.corrected for r in got.collect()} == want
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "posexplode" not in plan and "array_distinct" in plan

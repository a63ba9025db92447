import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from weftline.llm.linefreq import COUNTS, judge_lines

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ123456789", "abcdefghijklmnopqrstuvwxyz000000000")


def counts(text):
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    times, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if times[w] > 1:
            covered |= {i, i + 1, i + 2}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered)


def normalised(line):
    return " ".join(WORD.findall(line.translate(LOWER)))


def plain(rows, max_texts, max_share):
    """{(text, host): (counts, base_failed, removed line numbers, removed words, kept, clean text)}"""
    holders, texts = defaultdict(set), defaultdict(set)
    for text, host in rows:
        texts[host].add(text or "")
        for line in (text or "").split("\n"):
            if normalised(line):
                holders[host, normalised(line)].add(text or "")
    out = {}
    for text, host in rows:
        body, c = text or "", counts(text or "")
        gone = [i for i, x in enumerate(body.split("\n")) if len(h := holders.get((host, normalised(x)), ())) > max_texts and len(h) > max_share * len(texts[host])]
        words = sum(len(WORD.findall(body.split("\n")[i])) for i in gone)
        failed = c[0] < 50 or 100 * c[4] > 50 * c[0]
        clean = text if not gone else "\n".join(x for i, x in enumerate(body.split("\n")) if i not in gone)
        out[text, host] = (*c, failed, gone, words, not failed and 2 * words <= c[0], clean)
    return out


def check(df, **limits):
    rows = [(r.text, r.source) for r in df.collect()]
    want = plain(rows, limits.get("max_texts", 10), limits.get("max_share", 0.01))
    got = judge_lines(df, **limits)
    found = got.collect()
    assert len(found) == len(rows)
    for r in found:
        assert (*[r[c] for c in COUNTS], r.base_failed, list(r.removed_lines), r.removed_words, r.kept, r.clean_text) == want[r.text, r.source]
    return found


@pytest.mark.parametrize("seed", [1, 2])
def test_against_plain_python(spark, seed):
    pick = random.Random(seed)
    shared = ["Sign up 2024!", "sign  UP 1999!", "Terms | Privacy", "a b c", " ", "# é ½"]
    words = ["it", "was", "a", "a#b", "Zeit", "é", "x$", "|", " wide", "\u0085"]
    own = lambda: " ".join(pick.choice(words) for _ in range(pick.randrange(1, 40)))
    rows = []
    for i in range(120):
        lines = [pick.choice(shared) if pick.random() < 0.4 else own() for _ in range(pick.randrange(8))]
        rows.append((i, pick.choice(["\n", "\r\n", "\n\n"]).join(lines), pick.choice(["one", "one", "two", "", None])))
    rows += rows[:20]
    found = check(spark.createDataFrame(rows, "doc_id long, text string, source string"), max_texts=4, max_share=0.05)
    assert any(r.removed_lines for r in found) and any(r.kept for r in found)


def test_odd_rows_and_columns(odd, empty):
    found = check(odd, max_texts=0, max_share=0.0)
    assert {"id", "score", "gone", "component"} <= set(found[0].asDict())
    assert judge_lines(empty).count() == 0


def test_copies_are_one_text(spark):
    text = "\n".join(" ".join(f"{w}{x}" for x in "abcdefghijkl") for w in ("one", "two", "three", "four", "five"))
    df = spark.range(200).select(F.col("id").alias("doc_id"), F.lit(text).alias("text"), F.lit("s").alias("source"))
    assert {(r.kept, len(r.removed_lines)) for r in judge_lines(df).collect()} == {(True, 0)}
    near = spark.range(200).select(F.col("id").alias("doc_id"), F.concat(F.lit(text), F.lit("\nmy number is x"), F.translate(F.col("id").cast("string"), "0123456789", "abcdefghij")).alias("text"), F.lit("s").alias("source"))
    assert {(r.kept, len(r.removed_lines)) for r in judge_lines(near).collect()} == {(False, 5)}


def test_one_word_text_of_a_million_and_white_space(spark):
    rows = [(1, "x" * 1_000_000, "s"), (2, " " * 1_000_000, "s"), (3, "w " * 300_000, "s"), (4, "\n" * 500_000, "s")]
    got = {r.doc_id: r for r in judge_lines(spark.createDataFrame(rows, "doc_id long, text string, source string")).drop("text", "clean_text").collect()}
    assert [got[i].n_words for i in (1, 2, 3, 4)] == [1, 0, 300_000, 0] and got[3].n_repeat_words == 300_000 and not any(r.kept for r in got.values())

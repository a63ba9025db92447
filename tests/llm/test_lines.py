import hashlib
import random

from weftline.llm.lines import dedup_lines, removed_lines

WHITE = " \t\n\x0b\x0c\r"


def within_one(a, b):
    if abs(len(a) - len(b)) > 1:
        return False
    p = 0
    while p < min(len(a), len(b)) and a[p] == b[p]:
        p += 1
    q = 0
    while q < min(len(a), len(b)) - p and a[-1 - q] == b[-1 - q]:
        q += 1
    return max(len(a), len(b)) - p - q <= 1


def mark(text):
    return int(hashlib.sha256(text.encode()).hexdigest()[:15], 16)


def plain(rows, min_chars, edits=1):
    seen, out = [], set()
    for i, m, text in sorted({(i, mark(t), t) for i, t in rows if i is not None and t is not None}):
        for n, line in enumerate(text.split("\n")):
            line = line.strip(WHITE)
            if len(line) < min_chars:
                continue
            if any(within_one(line, x) if edits else line == x for x in seen):
                out.add((i, m, n))
            seen.append(line)
    return out


def rows(seed):
    rng = random.Random(seed)
    base = ["".join(rng.choice("ab cé") for _ in range(rng.randrange(3, 90))) for _ in range(20)]

    def edit(x):
        for _ in range(rng.choice([0, 0, 1, 1, 2])):
            p, k = rng.randrange(len(x) + 1), rng.randrange(3)
            x = x[:p] + rng.choice("abé") + x[p:] if k == 0 else x[:p] + x[p + 1 :] if k == 1 else x[:p] + rng.choice("abz") + x[p + 1 :]
        return x

    return [(i, "\n".join(" " * rng.randrange(2) + edit(rng.choice(base)) + rng.choice(["", "\r"]) for _ in range(rng.randrange(9)))) for i in range(60)]


def test_equals_brute_force(spark):
    for seed, edits in ((1, 1), (2, 1), (3, 0)):
        own = rows(seed)
        df = spark.createDataFrame(own, "doc_id long, text string")
        assert {tuple(r) for r in removed_lines(df, min_chars=5, max_edits=edits).collect()} == plain(own, 5, edits)


def test_many_near_copies_of_one_line(spark):
    line = "the same line in very many documents"
    own = [(i, line[: i % 36] + "#" + line[i % 36 :]) for i in range(200)] + [(500, line)]
    df = spark.createDataFrame(own, "doc_id long, text string")
    assert {tuple(r) for r in removed_lines(df).collect()} == plain(own, 20)


def check(df, out, min_chars):
    """Every row of df with its own lines gone, by brute force."""
    gone = plain([(r.doc_id, r.text) for r in df.collect()], min_chars)
    want = []
    for r in df.collect():
        own = set() if r.text is None else {n for i, m, n in gone if i == r.doc_id and m == mark(r.text)}
        kept = r.text if r.text is None else "\n".join(x for n, x in enumerate(r.text.split("\n")) if n not in own)
        want.append((r.doc_id, kept, sorted(own)))
    order = lambda x: (x[0] is None, x[0] or 0, x[1] is None, x[1] or "", x[2])
    assert sorted(((r.doc_id, r.text, list(r.removed_lines)) for r in out.collect()), key=order) == sorted(want, key=order)


def test_rows_that_share_an_id(spark):
    line = "a line that two documents have in common"
    for extra in ("\none more line that nobody else has at all", ""):
        own = [(1, line), (5, f"{line}\nanother line that only this row has got"), (5, f"something that is nowhere else to be found{extra}"), (5, f"something that is nowhere else to be found{extra}"), (7, "another line that only this row has got")]
        df = spark.createDataFrame(own, "doc_id long, text string")
        check(df, dedup_lines(df), 20)


def test_lines_whose_polynomial_hashes_collide(spark):
    """Thue-Morse words and their complements collide modulo any power of two."""
    word = "".join("ab"[bin(i).count("1") % 2] for i in range(2048))
    other = word.translate(str.maketrans("ab", "ba"))
    own = [(1, word), (2, other), (3, other[:700] + "c" + other[701:]), (4, word[:-1])]
    df = spark.createDataFrame(own, "doc_id long, text string")
    assert {(r.id, r.line) for r in removed_lines(df).collect()} == {(3, 0), (4, 0)}
    check(df, dedup_lines(df), 20)


def test_long_texts(spark):
    """Texts and lines above the size of a working chunk."""
    rng = random.Random(4)
    long = "".join(rng.choice("abcdefgh ") for _ in range(600_000))
    own = [(1, long), (2, f"{long}x"), (3, "\n".join(long[i : i + 97] for i in range(0, 600_000, 97)))]
    df = spark.createDataFrame([*own, (4, own[2][1] + "\nand a line of its own at the end")], "doc_id long, text string")
    out = {r.doc_id: r for r in dedup_lines(df).collect()}
    assert out[1].text == long and out[2].text == "" and out[3].removed_lines == []
    assert out[4].text.endswith("and a line of its own at the end") and len(out[4].text) < 60


def test_odd_rows(spark, odd, empty):
    out = dedup_lines(odd, min_chars=5)
    assert out.columns == [*[c for c in odd.columns if c != "removed_lines"], "removed_lines"] and out.count() == odd.count()
    check(odd, out, 5)
    assert dedup_lines(empty).count() == 0

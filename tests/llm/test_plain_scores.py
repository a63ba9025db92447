"""Scores of the trained operators, computed again word by word and gram by gram
in plain Python from the same model, and licences found amid other words."""

import io
import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from weftline.llm import language as G
from weftline.llm import quality as Q
from weftline.llm.common import BASE
from weftline.llm.licences import NOTICES, UNKNOWN, fit_licences, grams_of, scan_licences, words_of

FULL = (1 << 64) - 1
MORE = ["aa bb aa aa", "one", " lead and  trail ", "tab\tline\nfeed feed FEED", "ßçé 𝒳 ünï ünï", "a b a b", "word " * 300, "z" * 70]


def mixed(h):
    h ^= h >> 32
    h = h * 0xD6E8FEB86659FD93 & FULL
    return h ^ h >> 32


def raw(s):
    return sum((ord(c) + 1) * pow(BASE, i, 1 << 64) for i, c in enumerate(s)) & FULL


def plain_features(text):
    words = [w for w in re.split(r"[ \t-\r]+", text) if w]
    found = []
    for w in words:
        found += [mixed(raw(w[i : i + k]) + k & FULL) for k in Q.GRAMS for i in range(len(w) - k + 1)]
        found.append(mixed(raw(w) + 99 & FULL))
    for _ in range(sum(a == b for a, b in zip(words, words[1:]))):
        found += [mixed(1 + part) for part in range(Q.REPEAT)]
    return Counter(h >> 64 - Q.BITS for h in found)


def plain_quality(text, table, bias):
    counts = plain_features(text or "")
    logit = sum(float(table[b]) * n for b, n in counts.items()) / (sum(counts.values()) + Q.SHRINK) + bias
    return 1 / (1 + math.exp(-logit))


def some_texts(odd):
    return [r.text for r in odd.select("text").collect()] + MORE


def test_quality_scores(spark, odd):
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choice(["red", "blue", "green", "Mud!!"]) for _ in range(rng.randrange(3, 30))), i % 2) for i in range(80)]
    train = spark.createDataFrame(rows, "doc_id long, text string, label int")
    model = Q.fit_quality(train, train)
    held = np.load(io.BytesIO(model))
    df = spark.createDataFrame([(t,) for t in some_texts(odd)], "text string").repartition(3)
    for r in Q.score_quality(df, model).collect():
        assert r.score == pytest.approx(plain_quality(r.text, held["table"], float(held["bias"])), abs=1e-9)


def test_quality_features():
    for text in MORE:
        units = np.array([ord(c) for c in text], np.uint32)
        buckets, ends = Q.features(units, np.array([0, len(units)]))
        assert ends.tolist() == [0, len(buckets)] and Counter(buckets.tolist()) == plain_features(text)


def plain_language(text, held):
    """The nearest codeword's language and its share, and whether the next is close."""
    low = (text or "").lower()
    if not any(c.isalpha() for c in low):
        return "und", 0.0, False
    grams = Counter(mixed(raw(low[i : i + k]) + k & FULL) >> 64 - G.BITS for k in G.GRAMS for i in range(len(low) - k + 1))
    total = sum(grams.values())
    bits = [sum(float(held["table"][b, j]) * n for b, n in grams.items()) / total + float(held["bias"][j]) for j in range(len(held["bias"]))]
    loss = [sum(float(w) * math.log1p(math.exp(-x * int(c))) for x, c, w in zip(bits, row, held["weight"])) for row in held["code"]]
    near = [math.exp(-8 * (x - min(loss))) for x in loss]
    share = sorted((x / sum(near) for x in near), reverse=True)
    return str(held["names"][loss.index(min(loss))]), share[0], share[0] - share[1] < 0.05


def test_language_scores(spark, odd):
    rng = random.Random(6)
    words = {"aa": "the of and river stone", "bb": "der und nicht schön über", "cc": "que para niño según los", "dd": "kuin joka mutta sekä ovat"}
    rows = [(i, " ".join(rng.choice(words[k].split()) for _ in range(rng.randrange(3, 40))), k) for i in range(25) for k in words]
    model = G.fit_language(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    held = dict(np.load(io.BytesIO(model)))
    texts = some_texts(odd) + [t for _, t, _ in rows[:20]]
    df = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    for r in G.predict_language(df, model).collect():
        lang, score, close = plain_language(r.text, held)
        assert r.score == pytest.approx(score, abs=1e-4)
        assert close or (r.lang_pred, r.ambiguous) == (lang, close)


def plain_scan(text, model):
    """(line, family, confirmed) of single lines: what the scan says of a text
    that has no two lines next to each other."""
    out = set()
    for at, line in enumerate(text.split("\n")):
        grams = {g for g in grams_of(words_of(line)) if g in model.of}
        p = model.probabilities(line)
        family = max(p, key=p.get)
        if not grams or family == "none":
            continue
        pairs = {g for g in grams if g.count(" ") == 1}
        likeness = max((len(pairs & own) / len(own) for own in (grams_of(words_of(n), (2,)) for n in NOTICES.get(family, [])) if own), default=0.0)
        sure = family != UNKNOWN and p[family] >= 0.5 and likeness >= 0.6
        out.add((at, family if sure else UNKNOWN, sure))
    return out


def test_licences(spark):
    rng = random.Random(8)
    notices = [n for own in NOTICES.values() for n in own]
    prose = ["The river ran under the bridge.", "She sold the software to a friend.", "Permission was given to walk on the grass."]
    texts = []
    for i in range(60):
        words = rng.choice(notices).split()
        lines = [" ".join(w for w in words if rng.random() > 0.1), rng.choice(prose), rng.choice(notices) if i % 3 else ""]
        texts.append("\n\n".join(lines))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    model = fit_licences(df)
    got = {i: set() for i in range(len(texts))}
    for r in scan_licences(df, model).collect():
        got[r.doc_id].add((r.paragraph, r.family, r.confirmed))
    for i, text in enumerate(texts):
        assert got[i] == plain_scan(text, model), text


def test_licences_amid_other_words(spark):
    """Notices with words around them and a name and a year put in; prose without."""
    rng = random.Random(9)
    names = ["Ada Example", "Northern Tools Ltd", "J. Doe and others"]
    rows, truth = [], []
    for family, own in NOTICES.items():
        for notice in own:
            if len(words_of(notice)) < 6:
                continue
            rows.append(f"Copyright {rng.randrange(1990, 2024)} {rng.choice(names)}. {notice} See the file for more.")
            truth.append(family)
    clean = ["The weather was fine and the train left at noon.", "He signed the contract and paid for the boat.", "A free copy of the book lay on the table.", "They sold the house without any notice."] * 5
    df = spark.createDataFrame(list(enumerate(rows + clean)), "doc_id long, text string")
    found = {}
    for r in scan_licences(df, fit_licences(df)).where("confirmed").collect():
        found.setdefault(r.doc_id, set()).add(r.family)
    right = sum(found.get(i) == {f} for i, f in enumerate(truth))
    assert right >= 0.9 * len(truth) and not any(i in found for i in range(len(truth), len(truth) + len(clean)))

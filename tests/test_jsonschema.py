"""Compiled schemas against a plain validator, on crafted and on random digests."""

import json
import random
import re

import pytest
from pyspark.sql import functions as F

from weftline.functions.jsonschema import schema_errors, without_required
from weftline.functions.schemas import FILLED, digest_schema
from weftline.operators import extraction as E


def kind(v):
    return "null" if v is None else "boolean" if isinstance(v, bool) else "integer" if isinstance(v, int) else "number" if isinstance(v, float) else "string" if isinstance(v, str) else "array" if isinstance(v, list) else "object"


def plain(v, s, root, path="$"):
    if "$ref" in s:
        s = root["$defs"][s["$ref"].rsplit("/", 1)[-1]]
    out, k = [], kind(v)
    types = [s["type"]] if isinstance(s.get("type"), str) else s.get("type", [])
    if types and k not in types and not (k == "integer" and "number" in types):
        out.append((path, f"not of type {' or '.join(types)}"))
    if "enum" in s and v not in s["enum"]:
        out.append((path, f"not one of {', '.join(map(str, s['enum']))}"))
    number = k in ("integer", "number")
    out += [(path, f"{w} {s[w]}") for w, bad in (("minimum", lambda x, y: x < y), ("maximum", lambda x, y: x > y), ("exclusiveMinimum", lambda x, y: x <= y)) if w in s and number and bad(v, s[w])]
    out += [(path, f"{w} {s[w]}") for w, bad in (("minLength", lambda x, y: len(x) < y), ("maxLength", lambda x, y: len(x) > y), ("pattern", lambda x, y: not re.search(y, x))) if w in s and k == "string" and bad(v, s[w])]
    out += [(path, f"{w} {s[w]}") for w, bad in (("minItems", lambda x, y: len(x) < y), ("maxItems", lambda x, y: len(x) > y)) if w in s and k == "array" and bad(v, s[w])]
    if k == "array" and "items" in s:
        out += [e for i, x in enumerate(v) for e in plain(x, s["items"], root, f"{path}[{i}]")]
    if k == "object":
        out += [(f"{path}.{n}", "missing") for n in s.get("required", []) if n not in v]
        out += [e for n, own in s.get("properties", {}).items() if n in v for e in plain(v[n], own, root, f"{path}.{n}")]
        if s.get("additionalProperties") is False:
            out += [(f"{path}.{n}", "not in the schema") for n in v if n not in s.get("properties", {})]
    if "anyOf" in s:
        tried = [plain(v, x, root, path) for x in s["anyOf"]]
        out += [] if any(not t for t in tried) else tried[0]
    return out


def errors(spark, texts, schema):
    rows = spark.createDataFrame(list(enumerate(texts)), "i long, t string").repartition(3)
    return {r.i: None if r.e is None else [(x.path, x.error) for x in r.e] for r in rows.select("i", schema_errors("t", schema).alias("e")).collect()}


def test_crafted_digests(spark):
    citation = {"source_post_id": "p", "snippet": "s", "upvotes": 3}
    rule = {"rule_id": "1", "text": "x", "rule_type": "trend", "categories": ["fit"], "context_tags": [], "confidence": 1, "citations": [citation]}
    whole = {"extracted_at": "now", "source_post_id": "p", "source_title": "t", "rules": [rule]}
    changed = lambda **k: whole | {"rules": [rule, rule | k]}
    crafted = [whole, whole | {"rules": []}, whole | {"rules": None}, whole | {"source_platform": "radio", "source_url": None}, changed(rule_type="rumour"), changed(categories=[]), changed(categories=["fit", "hats", 3]), changed(confidence=1.5), changed(confidence="high"), changed(confidence=-0.1), changed(citations=[]), changed(citations=[citation, {"snippet": 1}, citation | {"upvotes": 1.5}]), changed(safety=None), changed(safety="extreme"), changed(examples="one"), {}, [], 3, "x", None]
    schema = digest_schema()
    got = errors(spark, [*map(json.dumps, crafted), "{", "", None], schema)
    for i, d in enumerate(crafted):
        assert sorted(got[i]) == sorted(plain(d, schema, schema)), d
    assert got[0] == [] and got[12] == [] and got[len(crafted)] == got[len(crafted) + 1] == [("$", "no JSON")] and got[len(crafted) + 2] is None
    assert got[6] == [("$.rules[1].categories[1]", got[6][0][1]), *got[6][1:]] and len(got[6]) == 3


SCHEMA = {
    "type": ["object", "array"],
    "additionalProperties": False,
    "required": ["a"],
    "properties": {
        "a": {"anyOf": [{"type": "integer", "minimum": 2, "exclusiveMinimum": 1}, {"type": "array", "minItems": 1, "maxItems": 2, "items": {"type": "array", "items": {"type": "string", "minLength": 1, "maxLength": 3, "pattern": "^[ab]"}}}]},
        "b": {"enum": [1, "x", None, True]},
        "c d": {"type": "object", "properties": {"a": {"type": "boolean"}}},
    },
    "items": {"type": "number", "maximum": 10},
}


def test_random_values(spark):
    pick = random.Random(4)

    def value(depth):
        k = pick.randrange(9 if depth else 7)
        return [None, True, pick.randrange(-1, 12), pick.choice([0.5, 10.5]), pick.choice(["", "a", "x", "abcd"]), {}, []][k] if k < 7 else [value(depth - 1) for _ in range(pick.randrange(4))] if k == 7 else {pick.choice(["a", "b", "c d", "e"]): value(depth - 1) for _ in range(3)}

    values = [pick.choice([value(3), {pick.choice(["a", "b", "c d", "e"]): value(3) for _ in range(3)}]) for _ in range(400)]
    got = errors(spark, [json.dumps(v) for v in values], SCHEMA)
    for i, v in enumerate(values):
        assert sorted(got[i]) == sorted(plain(v, SCHEMA, SCHEMA)), v
    assert sum(not e for e in got.values()) > 10


def test_references_that_come_back(spark):
    with pytest.raises(ValueError, match="come back"):
        schema_errors(F.lit("{}"), {"$ref": "#/$defs/A", "$defs": {"A": {"properties": {"x": {"$ref": "#/$defs/A"}}}}})
    assert without_required(digest_schema(), FILLED)["required"] == ["rules"]


def test_asked_again_only_where_it_failed(spark, tmp_path):
    log = tmp_path / "asked"

    def model(prompts):
        with log.open("a") as file:
            file.writelines(f"{p[:1]}{p.count('STRICT')}\n" for p in prompts)
        return ['{"n": 1}' if p[0] == "a" or (p[0] == "b" and "STRICT" in p) else None if p[0] == "d" else "no" for p in prompts]

    posts = spark.createDataFrame([(p,) for p in "abcd"], "p string").repartition(2)
    rows = E.ask_again(posts, F.col("p"), model, {"type": "object", "required": ["n"]}, retries=2)
    got = {r.p: (r.answer, len(r.errors)) for r in rows.collect()}
    assert got == {"a": ('{"n": 1}', 0), "b": ('{"n": 1}', 0), "c": ("no", 1), "d": (None, 1)}
    assert sorted(log.read_text().split()) == ["a0", "b0", "b1", "c0", "c1", "c2", "d0", "d1", "d2"]

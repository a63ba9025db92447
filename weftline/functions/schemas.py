"""Explicit schemas of posts, rules and digests; sources never infer."""

from __future__ import annotations

from pyspark.sql import types as T


def _of(ddl: str) -> T.StructType:
    fields = []
    for part in ddl.split(", "):
        name, kind = part.split(" ", 1)
        fields.append(T.StructField(name, {"string": T.StringType(), "long": T.LongType(), "double": T.DoubleType(), "int": T.IntegerType(), "boolean": T.BooleanType()}[kind]))
    return T.StructType(fields)


COMMENT = _of("comment_id string, body string, score long")
POST = T.StructType([*_of("post_id string, title string, score long, url string, flair string, selftext string").fields, T.StructField("comments", T.ArrayType(COMMENT))])
RECORD = T.StructType([*POST.fields, *_of("subreddit string, label string, text string").fields])
CANDIDATE = _of("text string, source string")
SOURCE = _of("url string, domain string")
RULE = T.StructType([*_of("rule_text string, rule_type string, quality_score int, word_count int").fields, T.StructField("sources", T.ArrayType(SOURCE)), T.StructField("source_count", T.IntegerType())])
RULE_FILE = T.StructType([T.StructField("rules", T.ArrayType(RULE)), T.StructField("_corrupt_record", T.StringType())])
EXTRACTION = T.StructType([T.StructField("has_fashion_rule", T.BooleanType()), T.StructField("rules", T.ArrayType(T.StringType())), *_of("category string, confidence string").fields])
CITATION = _of("source_post_id string, source_url string, source_comment_id string, snippet string, upvotes long")
DIGEST_RULE = T.StructType(
    [
        *_of("rule_id string, text string, rule_type string").fields,
        *[T.StructField(n, T.ArrayType(T.StringType())) for n in ("categories", "context_tags", "examples", "exceptions")],
        *_of("rationale string, confidence double").fields,
        T.StructField("citations", T.ArrayType(CITATION)),
        *_of("safety string").fields,
    ]
)
DIGEST = T.StructType([*_of("source_platform string, extracted_at string, domain_topic string, source_post_id string, source_title string, source_url string").fields, T.StructField("rules", T.ArrayType(DIGEST_RULE))])
CORPUS_ROW = _of("post_id string, title string, category string, clean_text string")


def _text(**more) -> dict:
    return {"type": "string"} | more


def _or_null(kind: dict) -> dict:
    return {"anyOf": [kind, {"type": "null"}]}


def digest_schema() -> dict:
    """What a digest has to be, as a JSON schema."""
    from . import lexicons as L

    texts = {"type": "array", "items": _text()}
    citation = {"type": "object", "required": ["source_post_id", "snippet"], "properties": {"source_post_id": _text(), "source_url": _or_null(_text()), "source_comment_id": _or_null(_text()), "snippet": _text(), "upvotes": _or_null({"type": "integer"})}}
    rule = {
        "type": "object",
        "required": ["rule_id", "text", "rule_type", "categories", "context_tags", "confidence", "citations"],
        "properties": {
            "rule_id": _text(),
            "text": _text(),
            "rule_type": _text(enum=L.RULE_TYPES),
            "categories": {"type": "array", "minItems": 1, "items": _text(enum=L.CATEGORIES)},
            "context_tags": texts,
            "examples": texts,
            "exceptions": texts,
            "rationale": _or_null(_text()),
            "confidence": {"type": "number", "minimum": 0, "maximum": 1},
            "citations": {"type": "array", "minItems": 1, "items": {"$ref": "#/$defs/Citation"}},
            "safety": _or_null(_text(enum=L.SEVERITIES)),
        },
    }
    return {
        "$defs": {"Citation": citation, "Rule": rule},
        "type": "object",
        "required": ["extracted_at", "source_post_id", "source_title", "rules"],
        "properties": {
            "source_platform": _text(enum=L.PLATFORMS),
            "extracted_at": _text(),
            "domain_topic": _text(enum=L.TOPICS),
            "source_post_id": _text(),
            "source_title": _text(),
            "source_url": _or_null(_text()),
            "rules": {"type": "array", "minItems": 1, "items": {"$ref": "#/$defs/Rule"}},
        },
    }


#: What the run fills in itself, or can do without.
FILLED = {"extracted_at", "source_post_id", "source_title", "rule_id", "text", "context_tags", "snippet"}

"""JSON schemas as column expressions: every way in which a JSON text breaks a schema,
with the path of the place, without Python on the rows.

A schema (a dict, as models are asked for) is walked once, on the driver, and gives
an expression over the parsed text, a variant. Arrays at any depth are checked
element by element with higher-order functions. Known keywords: type, enum, const, minimum, maximum,
exclusiveMinimum, exclusiveMaximum, minLength, maxLength, pattern, minItems, maxItems,
items, required, properties, additionalProperties (false), anyOf, allOf, $ref into
the same schema. Others are passed over, as the standard says of unknown ones; a
schema that contains itself is an error, since expressions end."""

from __future__ import annotations

import json

from pyspark.sql import Column
from pyspark.sql import functions as F

ERRORS = "array<struct<path:string,error:string>>"


def _none() -> Column:
    return F.array().cast(ERRORS)


def _fault(bad: Column, path: Column, error: str) -> Column:
    return F.when(F.coalesce(bad, F.lit(False)), F.array(F.struct(path.alias("path"), F.lit(error).alias("error")))).otherwise(_none())


def _kind(v: Column) -> Column:
    """The JSON type of a variant."""
    found = F.schema_of_variant(v)
    number = F.when(found.rlike(r"^DECIMAL\(\d+,0\)$") | (found == "BIGINT"), "integer").otherwise("number")
    return (
        F.when(found == "VOID", "null")
        .when(found == "STRING", "string")
        .when(found == "BOOLEAN", "boolean")
        .when(found.startswith("ARRAY"), "array")
        .when(found.startswith("OBJECT"), "object")
        .otherwise(number)
    )


def _resolved(schema: dict, root: dict, open_: tuple[str, ...]) -> tuple[dict, tuple[str, ...]]:
    while "$ref" in schema:
        ref = schema["$ref"]
        if not ref.startswith("#/") or ref in open_:
            raise ValueError(f"{ref}: only references into the schema that don't come back to themselves")
        found = root
        for part in ref[2:].split("/"):
            found = found[part.replace("~1", "/").replace("~0", "~")]
        schema, open_ = found | {k: v for k, v in schema.items() if k != "$ref"}, (*open_, ref)
    return schema, open_


def _as_key(name: str) -> str:
    if "'" in name:
        raise ValueError(f"{name}: quotes in property names are not supported")
    return f"$['{name}']"


def _faults(v: Column, path: Column, schema: dict, root: dict, open_: tuple[str, ...]) -> Column:
    """What breaks the schema at v, which is there (it may be the null of JSON)."""
    schema, open_ = _resolved(schema, root, open_)
    checks: list[Column] = []
    kind = _kind(v)
    is_ = lambda *kinds: kind.isin(*kinds)
    types = schema.get("type")
    if types:
        types = [types] if isinstance(types, str) else types
        allowed = [*types, *(["integer"] if "number" in types else [])]
        checks.append(_fault(~is_(*allowed), path, f"not of type {' or '.join(types)}"))
    if "enum" in schema or "const" in schema:
        values = schema.get("enum", [schema.get("const")])
        checks.append(_fault(~F.to_json(v).isin(*[json.dumps(x, ensure_ascii=False, separators=(",", ":")) for x in values]), path, f"not one of {', '.join(map(str, values))}"))
    number = F.try_variant_get(v, "$", "double")
    for word, bad in (("minimum", lambda x, y: x < y), ("maximum", lambda x, y: x > y), ("exclusiveMinimum", lambda x, y: x <= y), ("exclusiveMaximum", lambda x, y: x >= y)):
        if word in schema:
            checks.append(_fault(is_("integer", "number") & bad(number, F.lit(float(schema[word]))), path, f"{word} {schema[word]}"))
    text = F.try_variant_get(v, "$", "string")
    if "minLength" in schema:
        checks.append(_fault(is_("string") & (F.length(text) < schema["minLength"]), path, f"minLength {schema['minLength']}"))
    if "maxLength" in schema:
        checks.append(_fault(is_("string") & (F.length(text) > schema["maxLength"]), path, f"maxLength {schema['maxLength']}"))
    if "pattern" in schema:
        checks.append(_fault(is_("string") & ~text.rlike(schema["pattern"]), path, f"pattern {schema['pattern']}"))
    parts = F.when(is_("array"), F.try_variant_get(v, "$", "array<variant>"))
    if "minItems" in schema:
        checks.append(_fault(F.size(parts) < schema["minItems"], path, f"minItems {schema['minItems']}"))
    if "maxItems" in schema:
        checks.append(_fault(F.size(parts) > schema["maxItems"], path, f"maxItems {schema['maxItems']}"))
    if isinstance(schema.get("items"), dict):
        each = F.transform(parts, lambda x, i: _faults(x, F.concat(path, F.lit("["), i.cast("string"), F.lit("]")), schema["items"], root, open_))
        checks.append(F.coalesce(F.flatten(each), _none()))
    for name in schema.get("required", []):
        checks.append(_fault(is_("object") & F.try_variant_get(v, _as_key(name), "variant").isNull(), F.concat(path, F.lit(f".{name}")), "missing"))
    for name, own in schema.get("properties", {}).items():
        value = F.try_variant_get(v, _as_key(name), "variant")
        checks.append(F.when(is_("object") & value.isNotNull(), _faults(value, F.concat(path, F.lit(f".{name}")), own, root, open_)).otherwise(_none()))
    if schema.get("additionalProperties") is False:
        extra = F.filter(F.json_object_keys(F.to_json(v)), lambda k: ~k.isin(*schema.get("properties", {})) if schema.get("properties") else F.lit(True))
        checks.append(F.when(is_("object"), F.transform(extra, lambda k: F.struct(F.concat(path, F.lit("."), k).alias("path"), F.lit("not in the schema").alias("error")))).otherwise(_none()))
    for own in schema.get("allOf", []):
        checks.append(_faults(v, path, own, root, open_))
    if options := schema.get("anyOf"):
        tried = [_faults(v, path, own, root, open_) for own in options]
        right = tried[0]  # a value that fits none is told why it isn't the first
        for more in tried[1:]:
            right = F.when(F.size(more) == 0, more).otherwise(right)
        checks.append(right)
    return F.concat(*checks) if checks else _none()


def schema_errors(text: Column | str, schema: dict) -> Column:
    """array<struct<path, error>> of a JSON text: empty for a valid one, one error at
    ``$`` for a text that is no JSON, in order of the schema's keywords, parents and
    elements. Null for null."""
    c = F.col(text) if isinstance(text, str) else text
    v = F.try_parse_json(c)
    # parsed once: inside, the value is a lambda's argument
    found = F.transform(F.array(F.struct(v.alias("v"))), lambda row: F.when(row["v"].isNull(), _fault(F.lit(True), F.lit("$"), "no JSON")).otherwise(_faults(row["v"], F.lit("$"), schema, schema, ())))
    return F.when(c.isNotNull(), F.flatten(found))


def without_required(schema: dict, names: set[str]) -> dict:
    """The schema with these properties no longer required, wherever they are."""
    if isinstance(schema, list):
        return [without_required(x, names) for x in schema]
    if not isinstance(schema, dict):
        return schema
    return {k: [x for x in v if x not in names] if k == "required" and isinstance(v, list) else without_required(v, names) for k, v in schema.items()}

"""A schema's rules against a plain walk over the same values."""

import copy
import json
import random

import pytest
from pyspark.sql import functions as F

from marlspark.operators import json_rules as J
from marlspark.operators.preflight import THEMES, WORKSTREAMS

BUNDLE = J.bundle_schema(THEMES, WORKSTREAMS)


def sample(schema):
    """A value that fits."""
    if "anyOf" in schema:
        return sample(schema["anyOf"][-1])
    if "enum" in schema:
        return schema["enum"][0]
    if schema["type"] == "object":
        return {k: sample(v) for k, v in schema["properties"].items()}
    if schema["type"] == "array":
        return [sample(schema["items"]) for _ in range(schema.get("minItems", 1))]
    return {"string": "t", "integer": 3, "boolean": True, "null": None}[schema["type"]]


def walk(schema, v, path="$"):
    """(path, rule) of what does not fit."""
    kinds = {"string": str, "boolean": bool, "object": dict, "array": list, "null": type(None)}
    if "anyOf" in schema:
        return [] if any(not walk(s, v, path) for s in schema["anyOf"]) else [(path, "anyOf")]
    t = schema["type"]
    ok = (isinstance(v, (int, float)) and not isinstance(v, bool) and v == int(v)) if t == "integer" else isinstance(v, kinds[t])
    if not ok:
        return [(path, "type")]
    out = [(path, "enum")] if "enum" in schema and v not in schema["enum"] else []
    if t == "array":
        out += [(path, "minItems")] if len(v) < schema.get("minItems", 0) else []
        out += [(path, "maxItems")] if len(v) > schema.get("maxItems", 99) else []
        out += [x for i, e in enumerate(v) for x in walk(schema["items"], e, f"{path}[{i}]")]
    if t == "object":
        out += [(f"{path}.{k}", "required") for k in schema["required"] if k not in v]
        out += [x for k, s in schema["properties"].items() if k in v for x in walk(s, v[k], f"{path}.{k}")]
        out += [(f"{path}.{k}", "additionalProperties") for k in v if k not in schema["properties"]]
    return out


def places(v, at=()):
    yield at
    for k, x in v.items() if isinstance(v, dict) else enumerate(v) if isinstance(v, list) else ():
        yield from places(x, (*at, k))


def test_bundles_equal_a_walk(spark):
    rng = random.Random(6)
    good, values = sample(BUNDLE), []
    for _ in range(60):
        v = copy.deepcopy(good)
        for _ in range(rng.randint(0, 4)):
            at = rng.choice([p for p in places(v) if p])
            inner = v
            for k in at[:-1]:
                inner = inner[k]
            change = rng.random()
            if change < 0.25 and isinstance(inner, dict):
                del inner[at[-1]]
            elif change < 0.4 and isinstance(inner, dict):
                inner["it's new"] = 1
            elif change < 0.5 and isinstance(inner[at[-1]], list):
                inner[at[-1]] *= 6
            else:
                inner[at[-1]] = rng.choice([None, "other", 2.0, 2.5, True, [], {}, ["x"], 7])
        values.append(v)
    values += [good, [], None, 3, "text"]
    df = spark.createDataFrame([(i, json.dumps(v)) for i, v in enumerate(values)], "i int, t string")
    rules = J.Rules(json.dumps({**BUNDLE, "title": "a bundle"}))
    got = {r.i: sorted((x.path, x.rule) for x in r.x) for r in df.select("i", rules.issues(F.try_parse_json("t")).alias("x")).collect()}
    assert got == {i: sorted(walk(BUNDLE, v)) for i, v in enumerate(values)}
    assert not got[60] and got[62] == [("$", "type")]
    assert [tuple(x) for x in spark.range(1).select(rules.issues(F.try_parse_json(F.lit("{"))).alias("x")).first().x] == [("$", "json", "missing")]


def test_other_keywords(spark):
    schema = {"$defs": {"n": {"type": ["integer", "null"], "minimum": 1, "maximum": 3}}, "type": "object", "properties": {"a": {"$ref": "#/$defs/n"}, "b": {"type": "string", "minLength": 2, "maxLength": 3}, "c": {"const": 5}}}
    rules = J.Rules(schema)
    texts = ['{"a": 0, "b": "x", "c": 5}', '{"a": null, "b": "xxxx", "c": "5"}', '{"a": 4, "other": 1}', '{"a": 2, "b": "xy"}']
    got = [[(x.path, x.rule) for x in r.x] for r in spark.createDataFrame(list(enumerate(texts)), "i int, t string").orderBy("i").select(rules.issues(F.try_parse_json("t")).alias("x")).collect()]
    assert got == [[("$.a", "minimum"), ("$.b", "minLength")], [("$.b", "maxLength"), ("$.c", "const")], [("$.a", "maximum")], []]
    for bad in ({"oneOf": []}, {"properties": {"x": {"pattern": "a"}}}, {"additionalProperties": {"type": "string"}}):
        with pytest.raises(ValueError):
            J.Rules(bad)

"""JSON Schema compiled to one pass of rules over a variant column.

Understood are type (one or several), enum, const, required, properties, additionalProperties (a boolean or a schema for
other names is refused unless false or true), items, minItems, maxItems, minLength, maxLength, minimum, maximum, anyOf and
local $ref; other keywords raise, but for those that only describe. Every value is taken out of its parent once.

Cases: a column that is null (text that is no JSON) has the issue ``json`` at ``$``; a missing name is told from a JSON
null; 1.0 is an integer, true is not; a value of a wrong type has that issue and none of its parts' ; of anyOf, which
fails where all its schemas do, the single issue ``anyOf`` is given.
"""

from __future__ import annotations

import json

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.text import let
from .preflight import kind_of

ISSUES = "array<struct<path:string,rule:string,found:string>>"
SAYS_NOTHING = {"$schema", "$id", "$defs", "$comment", "title", "description", "default", "examples"}
KNOWN = {"type", "enum", "const", "required", "properties", "additionalProperties", "items", "minItems", "maxItems", "minLength", "maxLength", "minimum", "maximum", "anyOf", "$ref"}


def _issue(when: Column, path: Column, rule: str, found: Column) -> Column:
    return F.when(when, F.struct(path.alias("path"), F.lit(rule).alias("rule"), found.alias("found")))


def _is(v: Column, kind: Column, name: str) -> Column:
    number = F.try_variant_get(v, "$", "double")
    named = {
        "string": kind == "str", "boolean": kind == "bool", "null": kind == "null", "array": kind == "list", "object": kind == "dict",
        "number": kind.isin("int", "float"), "integer": (kind == "int") | (kind == "float") & (number == F.floor(number)),
    }
    return named[name]


def _step(name: str) -> str:
    return "$['" + name.replace("\\", "\\\\").replace("'", "\\'") + "']"


class Rules:
    """A schema's rules; ``issues`` of a variant are in the order of the schema, parents first."""

    def __init__(self, schema: dict | str):
        self.root = json.loads(schema) if isinstance(schema, str) else schema
        self._check(self.root, "#")

    def _check(self, schema: dict, at: str) -> None:
        for k in schema:
            if k not in KNOWN | SAYS_NOTHING:
                raise ValueError(f"{at}: keyword {k} is not understood")
        if not isinstance(schema.get("additionalProperties", True), bool):
            raise ValueError(f"{at}: additionalProperties must be true or false")
        for k in ("properties", "$defs"):
            for name, part in schema.get(k, {}).items():
                self._check(part, f"{at}/{k}/{name}")
        for i, part in enumerate([*schema.get("anyOf", ()), *([schema["items"]] if "items" in schema else ())]):
            self._check(part, f"{at}/{i}")

    def _resolved(self, schema: dict, seen: tuple[str, ...] = ()) -> dict:
        if "$ref" not in schema:
            return schema
        ref = schema["$ref"]
        if ref in seen or not ref.startswith("#"):
            raise ValueError(f"{ref}: only local references that end are understood")
        found = self.root
        for name in ref[1:].strip("/").split("/"):
            found = found[name.replace("~1", "/").replace("~0", "~")] if name else found
        return {**self._resolved(found, (*seen, ref)), **{k: v for k, v in schema.items() if k != "$ref"}}

    def issues(self, v: Column) -> Column:
        bad = F.array(_issue(F.lit(True), F.lit("$"), "json", F.lit("missing")))
        return F.when(v.isNull(), bad).otherwise(self._of(self.root, v, F.lit("$"))).cast(ISSUES)

    def _of(self, schema: dict, value: Column, path: Column, depth: int = 0) -> Column:
        if depth > 32:
            raise ValueError("schemas that hold themselves are not understood")
        schema = self._resolved(schema)
        # A value and its kind are bound once, whatever asks for them.
        return let(value, lambda v: let(kind_of(v), lambda kind: self._rules(schema, v, kind, path, depth)))

    def _rules(self, schema: dict, v: Column, kind: Column, path: Column, depth: int) -> Column:
        own, parts = [], []
        kinds = schema.get("type")
        if kinds is not None:
            fits = F.lit(False)
            for k in [kinds] if isinstance(kinds, str) else kinds:
                fits = fits | _is(v, kind, k)
            own.append(_issue(~fits, path, "type", kind))
        if "enum" in schema or "const" in schema:
            told = F.to_json(v)
            allowed = [json.dumps(x, ensure_ascii=False, separators=(",", ":")) for x in schema.get("enum", [schema.get("const")])]
            typed = fits if kinds is not None else F.lit(True)
            own.append(_issue(typed & ~told.isin(*allowed), path, "enum" if "enum" in schema else "const", told))
        text, number = F.try_variant_get(v, "$", "string"), F.try_variant_get(v, "$", "double")
        for k, low in (("minLength", True), ("maxLength", False)):
            if k in schema:
                n = F.length(text)
                own.append(_issue((kind == "str") & ((n < schema[k]) if low else (n > schema[k])), path, k, n.cast("string")))
        for k, low in (("minimum", True), ("maximum", False)):
            if k in schema:
                own.append(_issue(kind.isin("int", "float") & ((number < schema[k]) if low else (number > schema[k])), path, k, number.cast("string")))
        if "anyOf" in schema:
            fails = F.lit(True)
            for option in schema["anyOf"]:
                fails = fails & (F.size(self._of(option, v, path, depth + 1)) > 0)
            own.append(_issue(fails, path, "anyOf", kind))
        if {"items", "minItems", "maxItems"} & schema.keys():
            items = F.try_variant_get(v, "$", "array<variant>")
            n = F.size(items)
            for k, low in (("minItems", True), ("maxItems", False)):
                if k in schema:
                    own.append(_issue((kind == "list") & ((n < schema[k]) if low else (n > schema[k])), path, k, n.cast("string")))
            if "items" in schema:
                each = F.transform(items, lambda x, i: self._of(schema["items"], x, F.concat(path, F.lit("["), i.cast("string"), F.lit("]")), depth + 1))
                parts.append(F.when(kind == "list", F.flatten(each)))
        names = schema.get("properties", {})
        here = lambda n: F.concat(path, F.lit("." + n))
        for n in schema.get("required", ()):
            own.append(_issue((kind == "dict") & F.try_variant_get(v, _step(n), "variant").isNull(), here(n), "required", F.lit("missing")))
        for n, part in names.items():
            inner = F.try_variant_get(v, _step(n), "variant")
            parts.append(F.when((kind == "dict") & inner.isNotNull(), self._of(part, inner, here(n), depth + 1)))
        if schema.get("additionalProperties") is False:
            other = F.array_except(F.json_object_keys(F.to_json(v)), F.array(*[F.lit(n) for n in names]).cast("array<string>"))
            parts.append(F.when(kind == "dict", F.transform(other, lambda n: F.struct(F.concat(path, F.lit("."), n).alias("path"), F.lit("additionalProperties").alias("rule"), n.alias("found")))))
        empty = F.array().cast(ISSUES)
        found = F.filter(F.array(*own).cast(ISSUES), lambda x: x.isNotNull()) if own else empty
        return F.concat(found, *[F.coalesce(p.cast(ISSUES), empty) for p in parts])


def closed(**properties: dict) -> dict:
    """An object of exactly these names."""
    return {"type": "object", "additionalProperties": False, "required": list(properties), "properties": properties}


def one_of(*values: str) -> dict:
    return {"type": "string", "enum": list(values)}


def list_of(items: dict, least: int | None = None, most: int | None = None) -> dict:
    return {"type": "array", "items": items, **({} if least is None else {"minItems": least}), **({} if most is None else {"maxItems": most})}


def bundle_schema(themes: tuple[str, ...], workstreams: tuple[str, ...]) -> dict:
    """The schema of a reviewer's answer: a review and a revised analysis."""
    text, whole, grade = {"type": "string"}, {"type": "integer"}, one_of("pass", "mixed", "fail")
    severity, theme = one_of("critical", "major", "minor"), one_of(*themes)
    texts = lambda names: closed(**{n: text for n in names.split()})
    review = closed(
        review_target=closed(**texts("analysis_json_path paper_json_path analysis_title paper_title")["properties"], resolved_paper_by=one_of("explicit_path", "doi", "title_exact", "filename_exact", "manual")),
        overall_verdict=one_of("pass", "minor_revision", "major_revision", "reject"), ready_for_proposal_use={"type": "boolean"}, confidence=one_of("high", "medium", "low"), summary=text,
        checks=closed(**{n: grade for n in "schema metadata evidence_quotes semantic_grounding taxonomy_mapping numeric_claims".split()}),
        field_reviews=list_of(closed(field=text, status=one_of("supported", "partially_supported", "unsupported", "incorrect", "format_error"), severity=severity, reason=text, paper_evidence=text, suggested_fix=text)),
        issues=list_of(closed(severity=severity, field=text, problem=text, paper_evidence=text, recommended_action=text)),
        stats=closed(required_field_count=whole, missing_required_fields=list_of(text), matched_evidence_quotes=whole, total_evidence_quotes=whole, matched_numeric_claims=whole, total_numeric_claims=whole),
    )
    revised = closed(
        title=text, authors=text, year=whole, venue=text, doi=text, research_purpose=text, research_significance=text, contributions=list_of(texts("point evidence"), 2, 5),
        theme_primary=theme, theme_secondary={"anyOf": [theme, {"type": "null"}]}, workstream_fit=one_of(*workstreams), is_close_baseline_to_cute={"type": "boolean"}, key_technique=text, key_results=text,
        gap_identified=list_of(texts("gap evidence relevance_to_cute"), 1, 5), proposal_evidence=texts("for_state_of_art for_gap for_feasibility"),
    )
    return closed(review=review, revised_analysis=revised)

"""Checks of structured analyses against their source text: schema, taxonomy, format, metadata, quotes, numbers.

Analyses are variants, so that a missing field, a JSON null and a value of the
wrong type are told apart. All rules are column expressions; only the ratio of
quotes that are not verbatim runs Python (Arrow batches).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from difflib import SequenceMatcher
from functools import partial

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as X

# Fields by type, themes, workstreams, fields of prose and of numbers.
FIELDS = {
    "title": "str", "authors": "str", "year": "int", "venue": "str", "doi": "str",
    "research_purpose": "str", "research_significance": "str", "contributions": "list",
    "theme_primary": "str", "workstream_fit": "str", "is_close_baseline_to_cute": "bool",
    "key_technique": "str", "key_results": "str", "gap_identified": "list", "proposal_evidence": "dict",
}
THEMES = (
    "1. CPU-side AI acceleration / in-core accelerator",
    "2. Matrix extension / AMX / SME",
    "3. Vector extension / RVV / vector AI enhancement",
    "4. RISC-V custom ISA / open ISA AI extension",
    "5. LLM / Transformer / inference acceleration",
    "6. Quantization / mixed precision / FP8 / BF16 / block scale / mx",
    "7. Compiler / tensor IR / operator generation",
    "8. Memory hierarchy / scratchpad / dataflow / systolic",
    "9. HBM / advanced packaging / multi-node system",
)
WORKSTREAMS = ("1", "2", "3")
PARTS = ("proposal_evidence.for_state_of_art", "proposal_evidence.for_gap", "proposal_evidence.for_feasibility")
PROSE = ("research_purpose", "research_significance", "key_technique", "key_results", *PARTS)
NUMBERS = ("key_results", "proposal_evidence.for_feasibility")
LISTS = {"contributions": (2, 5, ("point", "evidence")), "gap_identified": (1, 5, ("gap", "evidence", "relevance_to_cute"))}
ISSUE = "array<struct<severity:string,field:string,category:string,message:string>>"


def get(v: Column, path: str, kind: str = "variant") -> Column:
    return F.try_variant_get(v, "$." + path, kind)


def kind_of(v: Column) -> Column:
    """missing, null, str, int, float, bool, list or dict."""
    s = F.schema_of_variant(v)
    return (
        F.when(v.isNull(), "missing").when(s == "VOID", "null").when(s == "STRING", "str").when(s == "BOOLEAN", "bool").when(s == "BIGINT", "int")
        .when(s.startswith("ARRAY"), "list").when(s.startswith("OBJECT"), "dict").otherwise("float")
    )


def is_kind(v: Column, kind: str) -> Column:
    found = kind_of(v)
    return found.isin("int", "bool") if kind == "int" else found == kind  # a bool passes as an int


def issue(when: Column, severity: str, field: Column | str, category: str, message: Column | str) -> Column:
    c = lambda x: F.lit(x) if isinstance(x, str) else x
    return F.when(when, F.struct(F.lit(severity).alias("severity"), c(field).alias("field"), F.lit(category).alias("category"), c(message).alias("message")))


def _two(f: Callable[[Column, Column], Column]) -> Callable[[Column, Column], Column]:
    """A function of exactly an item and its place, as higher-order functions want it."""
    return lambda x, i: f(x, i)


def schema_issues(v: Column) -> Column:
    """All schema, taxonomy and format issues of an analysis, in the order of the rules; the analysis is parsed once."""
    return X.let(v, _issues)


def _issues(v: Column) -> Column:
    single = []
    for f, kind in FIELDS.items():
        at = get(v, f)
        single.append(issue(~is_kind(at, kind), "critical", f, "schema", F.concat(F.lit(f"expected {kind}, found "), kind_of(at))))
    second = get(v, "theme_secondary")
    single.append(issue(~kind_of(second).isin("str", "null", "missing"), "critical", "theme_secondary", "schema", "expected a string or null"))
    each = []
    for f, (low, high, names) in LISTS.items():
        at = get(v, f)
        items = F.coalesce(F.try_variant_get(v, f"$.{f}", "array<variant>"), F.array().cast("array<variant>"))
        # A null or wrong list raises the schema issue above and no more.
        single.append(issue((kind_of(at) == "list") & ~F.size(items).between(low, high), "major", f, "schema", f"expected {low} to {high} items"))

        def item_issues(f: str, names: tuple[str, ...], x: Column, i: Column) -> Column:
            name = F.concat(F.lit(f + "["), i.cast("string"), F.lit("]"))
            whole = issue(kind_of(x) != "dict", "critical", name, "schema", "expected an object")
            parts = [issue((kind_of(x) == "dict") & (kind_of(F.try_variant_get(x, f"$.{n}", "variant")) != "str"), "critical", F.concat(name, F.lit("." + n)), "schema", "expected a string") for n in names]
            cjk = issue(X.contains_cjk(F.try_variant_get(x, "$.evidence", "string")), "major", F.concat(name, F.lit(".evidence")), "format", "quote holds Chinese characters")
            return F.array(whole, *parts, cjk)

        each.append(F.flatten(F.transform(items, _two(partial(item_issues, f, names)))))
    for p in PARTS:
        single.append(issue((kind_of(get(v, "proposal_evidence")) == "dict") & (kind_of(get(v, p)) != "str"), "critical", p, "schema", "expected a string"))
    for f in ("theme_primary", "theme_secondary"):
        single.append(issue((kind_of(get(v, f)) == "str") & ~get(v, f, "string").isin(*THEMES), "major", f, "taxonomy", "not a known theme"))
    single.append(issue((kind_of(get(v, "workstream_fit")) == "str") & ~get(v, "workstream_fit", "string").isin(*WORKSTREAMS), "major", "workstream_fit", "taxonomy", "not 1, 2 or 3"))
    for p in PROSE:
        single.append(issue((kind_of(get(v, p)) == "str") & get(v, p, "string").contains('"'), "minor", p, "format", "holds an ASCII double quote"))
    return F.filter(F.concat(F.array(*single), *each), lambda x: x.isNotNull()).cast(ISSUE)


def quotes(v: Column) -> Column:
    """field and quote of every evidence item."""
    out = []
    for f in LISTS:
        items = F.coalesce(F.try_variant_get(v, f"$.{f}", "array<variant>"), F.array().cast("array<variant>"))
        name = partial(lambda f, x, i: F.struct(F.concat(F.lit(f + "["), i.cast("string"), F.lit("].evidence")).alias("field"), F.coalesce(F.try_variant_get(x, "$.evidence", "string"), F.lit("")).alias("quote")), f)
        out.append(F.transform(items, _two(name)))
    return F.concat(*out)


def common_length(where: dict[str, int], n: int, y: str) -> int:
    """Length of the longest common subsequence of ``y`` and a text of n characters, whose places by character are bits of ``where``."""
    full = (1 << n) - 1
    v = full
    for c in y:
        if m := where.get(c):
            u = v & m
            v = ((v + u) | (v - u)) & full
    return n - v.bit_count()


def best_match(x: str, options: list[str]) -> tuple[float, int | None]:
    """difflib's largest ratio of ``x`` and an option, and the first option that has it.

    Characters in common, and then the longest common subsequence, bound what
    difflib can match; an option whose bound can't win is not compared.
    """
    where: dict[str, int] = {}
    for i, c in enumerate(x):
        where[c] = where.get(c, 0) | 1 << i
    n = {c: m.bit_count() for c, m in where.items()}
    of = lambda matched, y: 2.0 * matched / (len(x) + len(y)) if x or y else 1.0
    bounds = [of(sum(min(k, y.count(c)) for c, k in n.items()), y) for y in options]
    best, which = 0.0, None
    wins = lambda r, i: which is None or r > best or (r == best and i < which)
    for i in sorted(range(len(options)), key=lambda i: -bounds[i]):
        if which is not None and bounds[i] < best:
            break
        y = options[i]
        if wins(bounds[i], i) and wins(of(common_length(where, len(x), y), y), i):
            r = SequenceMatcher(None, x, y).ratio()
            if wins(r, i):
                best, which = r, i
    return best, which


def best_sentences(pairs: DataFrame, quote: str, sentences: str) -> DataFrame:
    """Add ratio (rounded to three places) and sentence: the first sentence most like the quote, by difflib's ratio.

    ``pairs`` should hold only quotes that are not verbatim. Upper bounds of the
    ratio skip sentences that can't be the best, which changes nothing.
    """
    schema = ", ".join(f"`{c}` {pairs.schema[c].dataType.simpleString()}" for c in pairs.columns) + ", ratio double, sentence string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            q, s = (b.column(b.schema.get_field_index(c)).to_pylist() for c in (quote, sentences))
            ratio, found = [], []
            for x, options in zip(q, s, strict=True):
                best, which = best_match((x or "").lower(), [o.lower() for o in options or ()])
                ratio.append(round(best, 3))
                found.append(None if which is None else options[which])
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(ratio, pa.float64()), pa.array(found, pa.string())], names=[*b.schema.names, "ratio", "sentence"])

    return pairs.mapInArrow(run, schema)


def quote_verdict(quote: Column, verbatim: Column, ratio: Column) -> tuple[Column, Column]:
    """Status and severity of a quote: verbatim, near, far or missing."""
    empty = F.trim(F.coalesce(quote, F.lit(""))) == ""
    status = F.when(empty, "fail").when(verbatim, "pass").when(ratio >= 0.85, "partial").otherwise("fail")
    severity = F.when(empty, "critical").when(verbatim, F.lit(None).cast("string")).when(ratio >= 0.85, "minor").when(ratio >= 0.6, "major").otherwise("critical")
    return status, severity


def check_quotes(pairs: DataFrame, quote: str = "quote", body: str = "body") -> DataFrame:
    """Add status, severity, ratio, sentence to pairs of quote and source text."""
    q, t = F.lower(X.normalized_text(F.coalesce(quote, F.lit("")))), F.lower(X.normalized_text(F.coalesce(body, F.lit(""))))
    marked = pairs.withColumn("__verbatim", (q != "") & F.contains(t, q))
    # Texts of verbatim quotes need not reach Python.
    marked = marked.withColumn("__q", X.normalized_text(F.coalesce(quote, F.lit("")))).withColumn("__s", F.when(~F.col("__verbatim") & (F.trim("__q") != ""), X.sentences(F.col(body))))
    kept = [c for c in pairs.columns if c != body]
    # One pass: rows without sentences to compare get ratio 0 and no sentence there.
    both = best_sentences(marked.select(*kept, "__verbatim", "__q", "__s"), "__q", "__s").withColumn("ratio", F.when(F.col("__verbatim"), 1.0).otherwise(F.col("ratio")))
    status, severity = quote_verdict(F.col(quote), F.col("__verbatim"), F.col("ratio"))
    return both.select(*kept, status.alias("status"), severity.alias("severity"), "ratio", "sentence")


def check_numbers(pairs: DataFrame, claim: str, body: str) -> DataFrame:
    """One row for each numeric token of a claim: pass if the source has it, spaces aside, else fail."""
    kept = [c for c in pairs.columns if c not in (claim, body)]
    rows = pairs.withColumn("__space", X.numeric_space(F.coalesce(body, F.lit("")))).select(*kept, "__space", F.explode(X.numeric_tokens(F.col(claim))).alias("token"))
    return rows.select(*kept, "token", F.when(F.contains("__space", X.numeric_key(F.col("token"))), "pass").otherwise("fail").alias("status"))


def totals(checks: DataFrame, key: str) -> DataFrame:
    return checks.groupBy(key).agg(F.count_if(F.col("status") == "pass").alias("matched"), F.count("*").alias("total"))

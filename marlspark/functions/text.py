"""Text functions over columns: normalisation, patterns, tokens. All stay in the JVM.

Word boundaries, word characters and white space are Unicode's: patterns carry
``(?U)``, since newer JDKs read a bare ``\\b`` as ASCII.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Ligatures and quotes that normalisation spells out.
LIGATURES = (("ﬃ", "ffi"), ("ﬄ", "ffl"), ("ﬀ", "ff"), ("ﬁ", "fi"), ("ﬂ", "fl"))
QUOTES = ("“”‘’ ", "\"\"'' ")
# Lines of publishers' boilerplate.
NOISE = (
    r"authorized licensed use limited to:.*$",
    r"downloaded on .+ from .+$",
    r"\d{4}\s+ieee\s+international\s+symposium.*$",
    r"\d{4}\s+ieee/acm\s+international\s+symposium.*$",
    r"\d{4}\s+ieee/acm\s+international\s+conference.*$",
    r"\d{4}\s+acm\s+international\s+conference.*$",
    r"979-\d[\d-]*\d/\d{2}/\$[\d.]+.*$",
    r"doi\s+10\.\d{4,}",
    r"\d+\s*$",
    r"restrictions apply\.$",
    r"open access support provided by:?$",
    r"pdf download$",
    r"total citations:.*$",
    r"total downloads:.*$",
    r"published:.*$",
    r"citation in bibtex format$",
    r"conference sponsors:.*$",
    r"ccs concepts$",
    r"acm reference format:?$",
    r"keywords?\s*$",
    r"this work is licensed under.*$",
    r"\.$",
)
# Headings that end a body, and numbers with their units.
REFERENCES = r"(?i)^(\d{0,2}\.?\s*)?(references|bibliography)\s*$"
NUMERIC = r"\d+(?:\.\d+)?(?:\s?(?:x|X|×|%|ms|s|MB|GB|KB|MHz|GHz|cycles?|TOPS|GOPS|TFLOPS|GFLOPS|亿|万))?"


def let(value: Column, f: Callable[[Column], Column]) -> Column:
    """``f`` of a value that is computed once a row, however often ``f`` uses it.

    A plain column would be written out at each use; a lambda's argument is not.
    """
    return F.element_at(F.transform(F.array(value), lambda x: f(x)), 1)


def quoted(term: str) -> str:
    return r"\Q" + term.replace(r"\E", r"\E\\E\Q") + r"\E"


def term_pattern(term: str) -> str:
    """A whole-word, case-blind pattern of a literal term."""
    return r"(?iuU)\b" + quoted(term) + r"\b"


def folded(text: Column) -> Column:
    """Lower case, with the letters that equal ASCII ones only in case-blind matching."""
    return F.lower(F.translate(text, "ſKİı", "skii"))


def has_folded(text: Column, term: str) -> Column:
    """Whether the ASCII term is in the folded text as a whole word.

    A plain search screens it, and the pattern begins with the literal, which Java
    seeks by its last letters; the boundary before it is looked up behind.
    """
    low = quoted(term.lower())
    return text.contains(term.lower()) & text.rlike(rf"(?U){low}(?<=\b{low})\b")


def has_term(text: Column, term: str) -> Column:
    """Whether the term is in the text as a whole word, case-blind."""
    return has_folded(folded(text), term) if term.isascii() else text.rlike(term_pattern(term))


def scored_text(title: Column, abstract: Column) -> Column:
    return F.concat(F.coalesce(title, F.lit("")), F.lit(" "), F.coalesce(abstract, F.lit("")))


def normalized_title(t: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(t), "[^a-z0-9]+", " "))


def squeezed(t: Column) -> Column:
    """Lower-case letters and digits alone."""
    return F.regexp_replace(F.lower(t), "[^a-z0-9]", "")


def normalized_text(t: Column) -> Column:
    """Ligatures and quotes spelled out, words rejoined at hyphens, white space collapsed."""
    for a, b in LIGATURES:
        t = F.replace(t, F.lit(a), F.lit(b))
    t = F.translate(t, *QUOTES)
    t = F.regexp_replace(t, r"(?U)(?<=\w)-\s+(?=\w)", "")
    return F.regexp_replace(F.regexp_replace(t, r"(?U)\s+", " "), "^ | $", "")


def sentences(t: Column) -> Column:
    return F.filter(F.split(normalized_text(t), r"(?<=[.!?])\s+"), lambda s: F.trim(s) != "")


def contains_cjk(t: Column) -> Column:
    return t.rlike(r"[\x{4e00}-\x{9fff}]")


def numeric_key(t: Column) -> Column:
    return F.replace(F.replace(F.lower(t), F.lit("×"), F.lit("x")), F.lit(" "), F.lit(""))


def numeric_tokens(t: Column) -> Column:
    """Numbers with their units: bare single digits are left out, the first of equal ones stays."""
    found = F.transform(F.regexp_extract_all(t, F.lit(NUMERIC), F.lit(0)), lambda x: F.trim(x))
    found = F.filter(found, lambda x: ~x.rlike(r"^\d$"))
    # Sorted by key, the first of equal ones stands after a different key: no search for each token.
    keyed = F.array_sort(F.transform(found, lambda x, i: F.struct(numeric_key(x).alias("k"), i.alias("i"), x.alias("x"))))
    firsts = let(keyed, lambda s: F.filter(s, lambda x, i: (i == 0) | (x["k"] != F.get(s, i - 1)["k"])))
    return F.transform(F.array_sort(F.transform(firsts, lambda x: F.struct(x["i"].alias("i"), x["x"].alias("x")))), lambda x: x["x"])


def numeric_space(t: Column) -> Column:
    return F.replace(F.replace(F.lower(normalized_text(t)), F.lit("×"), F.lit("x")), F.lit(" "), F.lit(""))


def stripped(line: Column) -> Column:
    return F.regexp_replace(line, r"(?U)^\s+|\s+$", "")


def is_noise(bare: Column) -> Column:
    """Of a stripped line; white space and digits are Unicode's."""
    return (bare == "") | bare.rlike("(?iU)^(?:" + "|".join(NOISE) + ")")


def clean_lines(t: Column) -> Column:
    """Lines before the first reference heading, without noise, stripped; each line is stripped once."""

    def body(lines: Column) -> Column:
        head = F.array_position(F.transform(lines, lambda x: x.rlike("(?U)" + REFERENCES)), True)
        before = F.when(head > 0, F.slice(lines, F.lit(1), (head - 1).cast("int"))).otherwise(lines)
        return F.filter(before, lambda x: ~is_noise(x))

    return let(F.transform(F.split(t, "\n"), stripped), body)


def relevance(score: Column) -> Column:
    return F.when(score >= 10, "High").when(score >= 5, "Medium").when(score >= 1, "Low").otherwise("None")


def relevance_rank(label: Column) -> Column:
    return F.when(label == "High", 3).when(label == "Medium", 2).when(label == "Low", 1).otherwise(0)


def strip_jats(t: Column) -> Column:
    return F.regexp_replace(t, r"</?jats:[^>]*>", "")


def safe_filename(t: Column, most: int = 80) -> Column:
    bare = F.regexp_replace(t, r"(?U)[^\w\s\-]", "")
    return F.substring(F.regexp_replace(F.regexp_replace(bare, r"(?U)^\s+|\s+$", ""), r"(?U)\s+", "-"), 1, most)


def document_stem(name: Column) -> Column:
    return F.regexp_replace(name, r"(\.review\.json|\.revised\.json|\.json|\.pdf)$", "")


def arxiv_id(t: Column) -> Column:
    """The bare id in a link or ``id:`` form, version left out; null where there is none."""
    bare = F.regexp_replace(F.element_at(F.split(F.trim(t), "/abs/"), -1), "^id:", "")
    bare = F.regexp_replace(bare, r"v\d+$", "")
    return F.when(bare.rlike(r"^\d{4}\.\d{4,5}$") | bare.rlike(r"^[a-z\-]+(\.[A-Z]{2})?/\d{7}$"), bare)


def doi_prefix(doi: Column) -> Column:
    return F.substring_index(doi, "/", 1)


def slug(t: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(t), "[^a-z0-9]+", "-"), "^-|-$", "")


def tail(t: Column, n: int) -> Column:
    return F.right(t, F.lit(n))


def day(t: Column) -> Column:
    return F.substring(t, 1, 10)


def escape_html(t: Column) -> Column:
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        t = F.replace(t, F.lit(a), F.lit(b))
    return t


def _number(x: float) -> str:
    return str(int(x)) if x == int(x) else repr(float(x))


#: A boundary of ASCII words, as browsers see it.
BOUNDARY = r"(?:(?<=[0-9A-Za-z_])(?![0-9A-Za-z_])|(?<![0-9A-Za-z_])(?=[0-9A-Za-z_]))"


def highlighted(t: Column, terms: Iterable[tuple[str, int]]) -> Column:
    """Escaped text with every term in a span, longer terms first (equal ones in order); heavier ones brighter, up to weight 10.

    A later term is also marked where it stands in an earlier one's markup, as on the review page.
    """
    t = escape_html(t)
    for term, weight in sorted(terms, key=lambda x: -len(x[0])):
        light = _number(25 + 35 * min((weight - 1) / 9, 1))
        t = F.regexp_replace(t, f"(?i){BOUNDARY}({quoted(term)}){BOUNDARY}", f'<span class="kw" style="color:hsl(43, 80%, {light}%)">$1</span>')
    return t


def url_contains(url: Column, part: str) -> Column:
    return F.coalesce(F.contains(F.lower(url), F.lit(part.lower())), F.lit(False))


# What makes a failed stage not worth or worth another try, in order.
FATAL = ("invalid_api_key", "incorrect api key", "unauthorized", "missing bearer", "permission denied", "no such file or directory")
# What of a failure's kind counts towards a breaker.
BREAKING = ("quota", "rate limit", "429", "capacity", "high demand", "service unavailable", "stream disconnected", "timeout", "exit_code_124")
RETRYABLE = (r"\b429\b", "rate limit", "too many requests", "insufficient_quota", "quota", "capacity", "temporarily unavailable", "503 service unavailable", "service unavailable", "currently experiencing high demand", "stream disconnected", "timeout", "timed out", "connection reset", "econnreset")


def failure_kind(output: Column, code: Column) -> tuple[Column, Column]:
    """The first pattern that the output shows and whether another try is worth it."""
    low = F.lower(output)
    kind, retry = F.concat(F.lit("exit_code_"), code.cast("string")), F.lit(False)
    for patterns, again in ((RETRYABLE, True), (FATAL, False)):
        for p in reversed(patterns):
            hit = low.rlike(p)
            kind, retry = F.when(hit, p).otherwise(kind), F.when(hit, again).otherwise(retry)
    return kind, retry

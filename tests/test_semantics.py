"""Semantics on small tables, with values worked out by hand."""

import difflib
import json
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from marlspark.functions import html
from marlspark.functions import text as X
from marlspark.operators import corpus, dedup, enrich, preflight, runs, scoring
from marlspark.plans.preflight import evidence_fuzzy
from marlspark.schemas import DB, UNAVAILABLE
from marlspark.sources import sinks, tables


def one(spark, column, **values):
    row = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values))
    return row.select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    ("text", "term", "hit"),
    [("The AMX unit", "amx", True), ("AMXes", "amx", False), ("éAMX", "AMX", False), ("mixed-precision.", "mixed-precision", True), ("a b", "a.b", False), ("riſc", "RISC", True), ("", "x", False)],
)
def test_terms_are_whole_words(spark, text, term, hit):
    assert one(spark, X.has_term(F.col("t"), term), t=text) is hit


@pytest.mark.parametrize(("score", "band"), [(-1, "None"), (0, "None"), (1, "Low"), (4, "Low"), (5, "Medium"), (9, "Medium"), (10, "High")])
def test_bands(spark, score, band):
    assert spark.range(1).select(X.relevance(F.lit(score)).alias("x")).first()["x"] == band


def test_score_counts_entries_once_each_in_order(spark):
    topic = scoring.Topic.of({"topic": "t", "keywords": ["chip", {"term": "matrix extension", "weight": 10}, "matrix", "chip"]})
    df = spark.createDataFrame([("Matrix extension", "chip chip"), (None, None)], "title string, abstract string")
    got = [(r.relevance_score, r.matched_keywords, r.relevance) for r in df.transform(scoring.score(topic)).collect()]
    assert got == [(13, "chip, matrix extension, matrix, chip", "High"), (0, "", "None")]


def test_scoring_stays_in_the_jvm(spark):
    df = spark.createDataFrame([("a", "b")], "title string, abstract string").transform(scoring.score(scoring.SAMPLE_TOPIC))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_topic_years_and_venues(spark):
    df = spark.createDataFrame([("OSDI", "2024"), ("osdi", ""), ("sosp", "2024")], "venue string, year string")
    topic = scoring.Topic.of({"filter_venues": ["osdi"], "filter_years": {"start": 2020}})
    assert [tuple(r) for r in df.transform(scoring.filter_topic(topic)).collect()] == [("OSDI", "2024")]


def test_slice_prefers_the_score(spark):
    df = spark.createDataFrame([(1, "12"), (2, ""), (3, "3")], "id int, relevance_score string")
    assert [r.id for r in scoring.slice_scored(df, min_score=3, top_n=1, order=("id",)).orderBy("id").collect()] == [1, 3]
    assert scoring.slice_name("a.csv", min_score=11) == "a-score-gte11.csv" and scoring.slice_name("a.csv", top_n=5) == "a-top5.csv"


def test_first_wins_and_blank_keys(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("", 3), ("", 4), (None, 5)], "k string, n int")
    assert sorted(r.n for r in df.transform(dedup.first_or_blank("k", "n")).collect()) == [1, 3, 4, 5]
    assert [r.n for r in dedup.merge_tables(df, "k", ("n",)).collect()] == [1]
    again = df.transform(dedup.first_or_blank("k", "n"))
    assert sorted(r.n for r in again.transform(dedup.first_or_blank("k", "n")).collect()) == [1, 3, 4, 5]


def test_marks_fold(spark):
    rows = spark.createDataFrame([("a", "", ""), ("b", "core", "x")], "paper_id string, keep string, notes string")
    marks = spark.createDataFrame([("a", "keep", "n1", 1), ("a", "", "n2", 2), ("b", "", "", 3)], "paper_id string, keep string, notes string, seq int")
    assert sorted(tuple(r) for r in dedup.upsert_marks(rows, marks, ["seq"]).collect()) == [("a", "keep", "n2"), ("b", "core", "")]


@pytest.mark.parametrize(
    ("text", "want"),
    [("co-\nop ﬁne “q”", 'coop fine "q"'), ("  a \t b ", "a b"), ("a - b", "a - b"), ("", "")],
)
def test_normalized_text(spark, text, want):
    assert one(spark, X.normalized_text(F.col("t")), t=text) == want


def test_numeric_tokens(spark):
    assert one(spark, X.numeric_tokens(F.col("t")), t="7 runs, 2.5× and 2.5x, 10 MB, 10MB, 3 ms, 12") == ["2.5×", "10 MB", "3 ms", "12"]


def test_clean_lines_stop_at_references(spark):
    body = "Title\n12 \n\nKeywords\nDOI 10.1145/1\nText.\n 3. References \nlate"
    assert one(spark, X.clean_lines(F.col("t")), t=body) == ["Title", "Text."]


@pytest.mark.parametrize(("out", "kind", "retry"), [("HTTP 429", r"\b429\b", True), ("quota; Unauthorized", "unauthorized", False), ("x4290", "exit_code_1", False), ("it timed out", "timed out", True)])
def test_failure_kind(spark, out, kind, retry):
    got = X.failure_kind(F.col("t"), F.lit(1))
    assert (one(spark, got[0], t=out), one(spark, got[1], t=out)) == (kind, retry)


def test_cascade_and_merge(spark):
    papers = spark.createDataFrame([("1", ""), ("2", "own"), ("3", UNAVAILABLE), ("4", "[error: x]")], "paper_id string, abstract string")
    a = spark.createDataFrame([("1", "A"), ("2", "A"), ("3", "")], "paper_id string, abstract string")
    b = spark.createDataFrame([("1", "B"), ("3", "B")], "paper_id string, abstract string")
    got = {r.paper_id: (r.abstract, r.filled_from) for r in enrich.cascade(papers, [("a", a), ("b", b)]).collect()}
    assert got == {"1": ("A", "a"), "2": ("own", "original"), "3": ("B", "b"), "4": (UNAVAILABLE, "none")}
    new = spark.createDataFrame([("1", "N", "k"), ("2", "", "k")], "paper_id string, abstract string, keep string")
    rows = papers.withColumn("keep", F.lit("h"))
    assert {r.paper_id: (r.abstract, r.keep) for r in enrich.merge_back(rows, new, ["abstract", "keep"]).collect()}["1"] == ("N", "h")


def test_contained_first_and_empty_texts(spark):
    left = spark.createDataFrame([("k", "Deep Nets"), ("e", "--")], "k string, t string")
    right = spark.createDataFrame([(1, ""), (2, "deep-nets for all"), (3, "Deep nets")], "o int, t string")
    assert {r.k: r.matched_o for r in corpus.contained_first(left, right, "k", "t", "o", "t", ["o"]).collect()} == {"k": 2, "e": None}


def test_empty_titles_and_titles_that_repeat(spark):
    """As an index by title has it: a title's first place, its last values; an empty text is in all."""
    left = spark.createDataFrame([("k", "Deep Nets"), ("e", "--"), ("z", "nothing alike")], "k string, t string")
    right = spark.createDataFrame([(1, "other", "v0"), (2, "Deep nets", "v1"), (3, "deep-nets for all", "v2"), (4, "deep  NETS", "v3"), (5, "!", "v4"), (6, "OTHER", "v5")], "o int, t string, v string")
    found = lambda r, **o: {x.k: x.matched_v for x in corpus.contained_first(left, r, "k", "t", "o", "t", ["v"], **o).collect()}
    assert found(right) == {"k": "v3", "e": None, "z": None}
    assert found(right, least=0) == {"k": "v3", "e": "v5", "z": "v4"}
    assert found(right.where("o <> 5"), least=0) == {"k": "v3", "e": "v5", "z": None}


def test_postings_hold_no_text_and_long_texts_are_found(spark):
    import random

    from marlspark.operators import containment as H

    rng = random.Random(7)
    long = "".join(rng.choice("abcdefgh ij-klé") for _ in range(2_300_000))
    big = spark.createDataFrame([(1, long), (2, long[::-1]), (3, "- \"x\" -"), (4, None), (5, "")], "o int, big string")
    cuts = [(i, long[a : a + n]) for i, (a, n) in enumerate([(0, 30), (1_048_560, 60), (2_200_000, 100_000), (5, 27), (17, 12), (9, 3), (11, 1)])]
    small = spark.createDataFrame([*cuts, (10, "-"), (11, '"'), (12, ""), (13, None), (14, "zzzzzzzzz"), (15, long + "x")], "s int, small string")
    for form, make in ((H.PLAIN, lambda t: t), (H.NORMAL, lambda t: spark.range(1).select(H.NORMAL.column(F.lit(t))).first()[0])):
        want = {(s, o) for s, t in [tuple(r) for r in small.collect()] for o, u in [tuple(r) for r in big.collect()] if t and u and make(t) and make(t) in make(u)} if form is H.PLAIN else None
        got = H.containing(small, big, "small", "big", form)
        pairs = {(r.s, r.o) for r in got.select("s", "o").collect()}
        if want is not None:
            assert pairs == want
        else:
            assert {(i, 1) for i, _ in cuts} <= pairs and {(10, 3), (11, 3)} <= pairs and not any(s in (12, 13, 14, 15) for s, _ in pairs)
        assert "Generate" not in got._jdf.queryExecution().toString()
        fields = H.postings(big.selectExpr("1L AS a", "2L AS b", "big AS t"), form.rough).schema
        assert all(f.dataType.simpleString() == "bigint" for f in fields)


def test_streaks(spark):
    df = spark.createDataFrame([("a", i, f) for i, f in enumerate([True, True, False, True, True, True])], "k string, n int, failed boolean")
    assert [r.streak for r in runs.consecutive(df, "k", ["n"], "failed").orderBy("n").collect()] == [1, 2, 0, 1, 2, 3]
    assert [tuple(r) for r in runs.tripped(df, "k", ["n"], "failed").collect()] == [("a", 5)]


def _issues(spark, **change):
    base = {"title": "t", "authors": "a", "year": 2024, "venue": "v", "doi": "d", "research_purpose": "p", "research_significance": "s", "contributions": [{"point": "p", "evidence": "e"}] * 2, "theme_primary": preflight.THEMES[0], "theme_secondary": None, "workstream_fit": "1", "is_close_baseline_to_cute": True, "key_technique": "k", "key_results": "r", "gap_identified": [{"gap": "g", "evidence": "e", "relevance_to_cute": "r"}], "proposal_evidence": {"for_state_of_art": "x", "for_gap": "y", "for_feasibility": "z"}}
    base.update(change)
    df = spark.createDataFrame([(json.dumps({k: v for k, v in base.items() if v != "-"}),)], "j string")
    return [(i.severity, i.field, i.category) for i in df.select(preflight.schema_issues(F.try_parse_json("j")).alias("i")).first()["i"]]


@pytest.mark.parametrize(
    ("change", "want"),
    [
        ({}, []),
        ({"year": True}, []),
        ({"year": "2024"}, [("critical", "year", "schema")]),
        ({"title": "-"}, [("critical", "title", "schema")]),
        ({"title": None}, [("critical", "title", "schema")]),
        ({"theme_secondary": ""}, [("major", "theme_secondary", "taxonomy")]),
        ({"theme_secondary": 3}, [("critical", "theme_secondary", "schema")]),
        ({"contributions": None}, [("critical", "contributions", "schema")]),
        ({"gap_identified": []}, [("major", "gap_identified", "schema")]),
        ({"contributions": [{"point": "p", "evidence": "中"}, 7]}, [("major", "contributions[0].evidence", "format"), ("critical", "contributions[1]", "schema")]),
        ({"key_results": 'a "b"'}, [("minor", "key_results", "format")]),
        ({"workstream_fit": "4"}, [("major", "workstream_fit", "taxonomy")]),
        ({"proposal_evidence": {"for_state_of_art": "x", "for_gap": 1, "for_feasibility": "z"}}, [("critical", "proposal_evidence.for_gap", "schema")]),
    ],
)
def test_preflight_rules(spark, change, want):
    assert sorted(_issues(spark, **change)) == sorted(want)


def test_quotes_use_the_rounded_ratio(spark):
    body = "We built a fast chip for sparse tensors. It runs well. Nothing else matters here."
    rows = [("We built a fast chip", body), ("It ran quite well.", body), ("zzz qqq", body), (" ", body)]
    got = preflight.check_quotes(spark.createDataFrame(rows, "quote string, body string")).collect()
    by = {r.quote: r for r in got}
    assert by["We built a fast chip"].status == "pass" and by[" "].severity == "critical"
    want = max(round(difflib.SequenceMatcher(None, "it ran quite well.", s.lower()).ratio(), 3) for s in body.replace(". ", ".|").split("|"))
    assert by["It ran quite well."].ratio == pytest.approx(want)
    assert preflight.quote_verdict  # thresholds:
    v = spark.createDataFrame([("q", 0.85), ("q", 0.849), ("q", 0.6), ("q", 0.599)], "q string, r double")
    s, sev = preflight.quote_verdict(F.col("q"), F.lit(False), F.col("r"))
    assert [tuple(r) for r in v.select(s, sev).collect()] == [("partial", "minor"), ("fail", "major"), ("fail", "major"), ("fail", "critical")]


def test_quotes_of_whole_long_texts_equal_brute_force(spark, tmp_path):
    rng = random.Random(3)
    word = lambda: "".join(rng.choices("abcdeeeilmnorst", k=rng.randint(2, 9)))
    text = lambda n: " ".join(" ".join(word() for _ in range(rng.randint(3, 25))) + rng.choice(".!?") for _ in range(n))
    rows = [(i, text(rng.choice([1, 4, 60, 150]))) for i in range(45)] + [(45, "short"), (46, "eel"), (48, None), (49, ""), (None, text(3))]
    rows = [(i, t, None if i == 4 else len(t or "")) for i, t in rows]
    spark.createDataFrame(rows, "doc_id long, text string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    want, late = {}, 0
    for i, t, _ in rows:
        t = t or ""
        at = zlib.crc32(str(i).encode()) % (max(len(t) - 60, 0) + 1) if i is not None else 0
        late += at > 2000
        quote = t[at : at + 50] if i is not None and i % 3 == 0 else t[at : at + 60].replace("e", "e ") + "." if i is not None and i % 3 == 1 else ""
        q, whole = (" ".join(x.split()) for x in (quote, t))
        if not q or t == "" and i == 48:
            want[i] = ("fail", "critical", 0.0)
        elif q in whole:
            want[i] = ("pass", None, 1.0)
        else:
            r = max((round(difflib.SequenceMatcher(None, q, s).ratio(), 3) for s in re.split(r"(?<=[.!?])\s+", whole) if s), default=0.0)
            want[i] = ("partial", "minor", r) if r >= 0.85 else ("fail", "major" if r >= 0.6 else "critical", r)
    got = {r.doc_id: (r.status, r.severity, r.ratio) for r in evidence_fuzzy(spark, str(tmp_path)).collect()}
    assert late > 10 and len(got) == len(rows) and got == want


def test_best_match_is_the_first_best_of_difflib():
    rng = random.Random(4)
    for _ in range(300):
        x, *options = ("".join(rng.choices("ab c", k=rng.randint(1, 12))) for _ in range(rng.randint(1, 9)))
        ratios = [difflib.SequenceMatcher(None, x, y).ratio() for y in options]
        assert preflight.best_match(x, options) == ((max(ratios), ratios.index(max(ratios))) if options else (0.0, None))


def test_csv_round_trip_keeps_blanks(spark, tmp_path):
    rows = [("doi:1", 'say "hi"\nthere', "", "2024", "OSDI", "", "u", "")]
    df = spark.createDataFrame(rows, DB)
    sinks.write_csv(df, str(tmp_path / "t"), DB.fieldNames())
    back = tables.read_csv_folder(spark, str(tmp_path / "t"), DB)
    assert [tuple(r)[:8] for r in back.collect()] == rows


def test_partitioned_write_skips_what_is_there(spark, tmp_path):
    df = spark.createDataFrame([("a", 1, "x"), ("b", 1, "y")], "venue string, year int, v string")
    sinks.write_partitioned(df, str(tmp_path / "p"))
    more = spark.createDataFrame([("a", 1, "new"), ("c", 2, "z")], "venue string, year int, v string")
    sinks.write_partitioned(more, str(tmp_path / "p"))
    assert sorted(r.v for r in spark.read.parquet(str(tmp_path / "p")).collect()) == ["x", "y", "z"]


def test_config_subset():
    text = 'topic: cpu  # name\nkeywords:\n  - AMX\n  - term: "matrix ext"\n    weight: 10\n  - {term: GEMM, weight: 5}\nfilter_years:\n  start: 2022\n  end: 2024\n'
    topic = scoring.Topic.of(tables.parse_config(text))
    assert topic.keywords == (("AMX", 1), ("matrix ext", 10), ("GEMM", 5)) and topic.years == (2022, 2024)


def test_pages_are_fetched_with_retries(spark):
    df = spark.createDataFrame([("u1",), ("bad",)], "url string")

    def get(url):
        if url == "bad":
            raise OSError(url)
        return "<html>"

    assert sorted(tuple(r) for r in tables.fetch_pages(df, get, retries=1, wait=0).collect()) == [("bad", None, False), ("u1", "<html>", True)]


def test_lookup_batches(spark):
    ids = spark.range(7).select(F.col("id").cast("string").alias("id")).coalesce(1)
    got = tables.lookup_batches(ids, lambda c: [{"n": len(c)} if i != "3" else None for i in c], "id string, n int", size=3).collect()
    assert sorted((r.id, r.n) for r in got) == [("0", 3), ("1", 3), ("2", 3), ("4", 3), ("5", 3), ("6", 1)]


def test_atom(spark):
    xml = '<feed xmlns="http://www.w3.org/2005/Atom"><entry><id>http://arxiv.org/abs/2401.00001v2</id><title>A\n  B</title><summary>s</summary><published>2024-01-02T00:00:00Z</published><author><name>X Y</name></author><category term="cs.AR"/></entry></feed>'
    r = tables.parse_atom(spark.createDataFrame([(xml,)], "xml string")).first()
    assert (r.title, r.published, r.authors, r.categories) == ("A B", "2024-01-02", ["X Y"], ["cs.AR"])


def test_first_marks_and_repeated_keys(spark):
    rows = spark.createDataFrame([("a", "x", 1), ("a", "y", 2), ("b", "z", 3)], "paper_id string, keep string, _row int").withColumn("notes", F.lit(""))
    marks = spark.createDataFrame([("a", "keep", "n", 1)], "paper_id string, keep string, notes string, seq int")
    got = {r._row: (r.keep, r.notes) for r in dedup.upsert_marks(rows, marks, ["seq"]).collect()}
    assert got == {1: ("keep", "n"), 2: ("y", ""), 3: ("z", "")}
    earlier = spark.createDataFrame([("a", "one", "", 1), ("a", "two", "t", 2), ("", "never", "", 3)], "paper_id string, keep string, notes string, _row int")
    assert sorted(tuple(r) for r in enrich.reattach(rows.select("paper_id"), earlier).collect()) == [("a", "two", "t"), ("a", "two", "t"), ("b", "", "")]


def test_contained_texts_equal_comparing_all(spark):
    import random

    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abkeo1") for _ in range(rng.randint(1, 9)))
    big = [(i, " ".join(word() for _ in range(rng.randint(0, 40)))) for i in range(80)]
    small = [(i, t[(a := rng.randint(0, max(0, len(t) - 3))) : a + rng.randint(0, 30)] if rng.random() < 0.7 else word()) for i, (_, t) in enumerate(big)] + [(900, "e"), (901, ""), (902, None)]
    squeeze = lambda t: "".join(c for c in (t or "").lower() if c.isalnum())
    want = {}
    for i, t in small:
        x = squeeze(t)
        hits = [j for j, u in big if x and squeeze(u) and (x in squeeze(u) or squeeze(u) in x)]
        want[i] = max((j for j, u in big if squeeze(u) == squeeze(big[min(hits)][1])), default=None) if hits else None
    df = lambda rows, k: spark.createDataFrame(rows, f"{k} int, {k}_text string")
    found = corpus.contained_first(df(small, "s"), df(big, "b"), "s", "s_text", "b", "b_text", ["b"])
    assert {r.s: r.matched_b for r in found.collect()} == want
    assert "NestedLoop" not in found._jdf.queryExecution().toString()


def test_fuzzy_quotes_equal_difflib_over_whole_texts(spark):
    from difflib import SequenceMatcher

    rows = [(1, "the quick brown fox jumpd", " ".join(f"Filler sentence {i}." for i in range(400)) + " The quick brown fox jumps. End."), (2, "nothing like it", "A. B. C."), (3, "", "text")]
    got = {r.k: r for r in preflight.check_quotes(spark.createDataFrame(rows, "k int, quote string, body string")).collect()}
    parts = [s.strip() for s in (rows[0][2].replace(". ", ".\n")).split("\n")]
    best = max(SequenceMatcher(None, rows[0][1], s.lower()).ratio() for s in parts)
    assert got[1].ratio == round(best, 3) and got[1].sentence == "The quick brown fox jumps."
    assert got[3].status == "fail" and got[3].severity == "critical"


def test_escapes_and_terms(spark):
    one = lambda c: spark.range(1).select(c).first()[0]
    assert one(html.unquoted(F.lit("a%zz+%C3%A9%2"))) == "a%zz é%2"
    assert one(html.unquoted(F.lit("%FFx%"))) == "�x%"
    for t, term, hit in (("a LICENSE b", "license", True), ("licenses", "license", False), ("of\nthe", "of the", False), ("é license", "license", True), ("élicense", "license", False), ("c++ x", "c++", False), ("x c+", "c+", False)):
        assert one(X.has_term(F.lit(t), term)) == one(F.lit(t).rlike(X.term_pattern(term))) == hit, (t, term)
    numbers = " ".join(f"{i % 50}.5 ms" for i in range(3000))
    assert len(one(X.numeric_tokens(F.lit(numbers)))) == 50


def test_plans_score_once_and_loop_nowhere(spark):
    from marlspark import catalog

    plan = catalog.QUERIES["top_n_scored"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("\\Qlicense\\E(?<=") <= 1 and "TakeOrdered" in plan
    for name in ("containment_join", "evidence_exact", "lookup_cascade"):
        assert "NestedLoop" not in catalog.QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString(), name


def test_no_sketch_is_kept_by_user(spark, tmp_path):
    """Users of many rows, null users and a null type; a pair of type and user carries no sketch of 3 KB."""
    from marlspark import catalog

    rows = [(kind, u) for kind in ("a", None) for u in range(3000) for _ in range(3)] + [("a", None), ("b", None), ("c", 7), ("c", 7), ("c", None)]
    spark.createDataFrame(rows, "event_type string, user_id long").repartition(3).write.parquet(f"{tmp_path}/events.parquet")
    df = catalog.QUERIES["extra_approx_distinct"](spark, str(tmp_path))
    assert {r.event_type: r.close for r in df.collect()} == dict.fromkeys(("a", None, "b", "c"), True)
    sketches = [line for line in df._jdf.queryExecution().executedPlan().toString().splitlines() if "approx_count_distinct(" in line]
    assert sketches and not any("user_id" in line.split("functions=")[0] for line in sketches)

"""Field rules one by one, and a whole enrichment against a record-by-record version."""

import re

import pytest
from pyspark.sql import functions as F

from marlspark.operators import policies as R

GONE = "[abstract unavailable]"
ANSWER = "s2_paper_id string, citation_count int, abstract string, arxiv_id string, published_date string, fields_of_study array<string>"


def absent(a):
    return not a or a == GONE or a.startswith("[error:")


def take(p, a):
    p["citation_count"], p["s2_paper_id"] = str(a[1] or 0), a[0] or ""
    if a[2] and absent(p["abstract"]):
        p["abstract"] = a[2]
    p["arxiv_id"] = a[3] or p["arxiv_id"]
    p["published_date"] = (a[4] or "")[:10] or p["published_date"]
    p["categories"] = p["categories"] or "; ".join(x for x in a[5] or [] if x is not None)


def plain(t):
    return re.sub("[^a-z0-9]+", " ", t.lower()).strip()


def brute(papers, batch, bulk, search, registry, preprints, strict=False, force=False, limit=None):
    rows = [{k: ("0" if v is None and k == "citation_count" else v or "") for k, v in p.items()} for p in papers]
    chosen = [p for p in rows if force or absent(p["abstract"]) or p["citation_count"] in ("", "0")][:limit]
    for p in chosen:
        if p["doi"] and "DOI:" + p["doi"] in batch:
            take(p, batch["DOI:" + p["doi"]])
        for pool, named in ((bulk, True), (search, False)):
            if p["doi"] or not absent(p["abstract"]) or not p["title"].strip():
                continue
            found = None
            for venue, year, title, own, answer in pool:
                fits = not own or own == p["year"] if named else not p["year"] or not own or own == p["year"]
                if plain(title) and plain(title) == plain(p["title"]) and fits and (not named or p["venue"] and p["year"] and (venue, year) == (p["venue"], p["year"])):
                    found = answer
                    break
            if found:
                take(p, found)
            elif not named:
                p["abstract"] = GONE
        done = False
        for source, key, clean in ((registry, "doi", lambda t: re.sub(r"</?jats:[^>]*>", "", t).strip()), (preprints, "arxiv_id", lambda t: t)):
            if done or not absent(p["abstract"]) or p[key] not in source or not p[key]:
                continue
            text, error = source[p[key]]
            if error:
                p["abstract"], done = error, strict
            elif text:
                p["abstract"], done = clean(text), True
        if not done and not p["abstract"]:
            p["abstract"] = GONE
    last = {p["paper_id"]: dict(p) for p in chosen}
    for p in rows:
        for f, v in last.get(p["paper_id"], {}).items():
            if f not in ("keep", "notes", "at") and v:
                p[f] = v
    return rows


FIELDS = ("paper_id", "title", "venue", "year", "doi", "abstract", "citation_count", "arxiv_id", "s2_paper_id", "published_date", "categories", "keep")
PAPERS = [
    ("p1", "A", "v", "2024", "d1", "", "0", "", "", "", "", "x"),  # all from the batch
    ("p2", "B", "v", "2024", "d2", "own", "5", "", "", "", "own", None),  # nothing to do
    ("p3", "C", "v", "2024", "d3", "own", "0", "a0", "", "", "own", None),  # counts alone: the abstract stays
    ("p4", "The  Title!", "v", "2024", None, GONE, None, None, None, None, None, "y"),  # bulk, first candidate whose year fits
    ("p5", "the title", "w", "", "", "[error: old]", "3", "", "", "", "", ""),  # search, any year
    ("p6", "nowhere", "w", "2024", "", "[error: old]", "3", "", "", "", "", ""),  # searched, not found
    ("p7", "  ", "w", "2024", "", "[error: old]", "3", "a7", "", "", "", ""),  # no title: the error stays until the preprint
    ("p8", "H", "v", "2024", "d8", "", "3", "a8", "", "", "", ""),  # registry fails, the preprint has it
    ("p9", "I", "v", "2024", "d9", None, "3", "a9", "", "", "", ""),  # registry text is markup alone
    ("p10", "J", "v", "2024", "d10", "", "3", "a10", "", "", "", ""),  # preprint fails
    ("p11", "K", "v", "2024", "d11", "", "3", "", "", "", "", ""),  # found nowhere
    ("r", "first", "v", "2024", "d1", "", "0", "", "", "", "", "m1"),  # one id three times
    ("r", "second", "v", "2024", "d3", "own", "0", "", "", "", "", "m2"),
    ("r", "third", "v", "2024", "d2", "kept", "9", "", "", "", "", "m3"),  # not due, but of that id
    (None, None, None, None, None, None, None, None, None, None, None, None),
    ("", "The title", "v", "2024", "", "", "", "", "", "", "", ""),
]
BATCH = {"DOI:d1": ("s1", 4, "batch", "b1", "2024-01-02T00", ["f", None, "g"]), "DOI:d3": (None, None, "other", "", None, None), "DOI:d9": ("s9", 1, None, None, None, [])}
BULK = [("v", "2024", "the title", "2023", ("k1", 1, "bulk 1", None, None, None)), ("v", "2024", "The title.", "", ("k2", 2, "bulk 2", "kx", "2024", ["q"])), ("v", "2024", "the title", "2024", ("k3", 3, "bulk 3", None, None, None)), ("v", "2024", "...", "", ("k4", 4, "bulk 4", None, None, None))]
SEARCH = [("", "", "The title", "1999", ("q1", 8, "search 1", None, None, None)), ("", "", "", "", ("q2", 9, "search 2", None, None, None))]
REGISTRY = {"d8": (None, "[error: HTTP 500]"), "d9": ("<jats:p> </jats:p>", None), "d10": ("", None), "": ("never", None)}
PREPRINTS = {"a7": ("preprint 7", None), "a8": ("preprint 8", ""), "a9": ("preprint 9", None), "a10": ("x", "[error: timeout]")}


@pytest.fixture(scope="module")
def tables(spark):
    make = lambda rows, schema: spark.createDataFrame(rows, schema)
    papers = make([(i, *p) for i, p in enumerate(PAPERS)], "at int, " + ", ".join(f"{f} string" for f in FIELDS)).withColumns({"id": F.lit("clash"), "rank": F.lit(1), "error": F.lit("clash"), "n": F.lit(0)})
    batch = make([(k, *a) for k, a in BATCH.items()], f"id string, {ANSWER}")
    bulk = make([(v, y, t, o, i, *a) for i, (v, y, t, o, a) in enumerate(BULK)], f"venue string, year string, title string, candidate_year string, rank int, {ANSWER}")
    search = make([(t, o, i, *a) for i, (_, _, t, o, a) in enumerate(SEARCH)], f"title string, year string, rank int, {ANSWER}")
    registry = make([(k, *a) for k, a in REGISTRY.items()], "doi string, abstract string, error string")
    preprints = make([(k, *a) for k, a in PREPRINTS.items()], "arxiv_id string, abstract string, error string")
    return papers, (batch, bulk, search, registry, preprints)


@pytest.mark.parametrize("options", [{}, {"strict": True, "limit": 12, "force": True}])
def test_a_whole_enrichment_equals_record_by_record(tables, options):
    papers, found = tables
    got = R.enrich_table(papers, "2026-01-31", ["at"], *found, **options)
    want = brute([dict(zip(FIELDS, p, strict=True)) for p in PAPERS], BATCH, BULK, SEARCH, REGISTRY, PREPRINTS, **options)
    place = lambda r: tuple(r[f] for f in FIELDS)
    rows = got.collect()
    assert sorted(map(place, rows)) == sorted(map(place, want))
    assert "id" not in got.columns and {r["source"] for r in rows} == {"dblp"}
    if not options:
        origin = {r["paper_id"]: r["origin"].asDict() for r in rows}
        assert origin["p1"]["abstract"] == origin["p1"]["categories"] == "batch" and origin["p2"]["abstract"] is None
        assert origin["p3"]["citation_count"] == "batch" and origin["p3"]["abstract"] is None and origin["p3"]["arxiv_id"] is None
        assert [origin[p]["abstract"] for p in ("p4", "p5", "p6", "p7", "p8", "p9", "p11")] == ["bulk", "search", "none", "preprints", "preprints", "registry", "none"]


def test_sources_left_out_and_empty_tables(tables):
    papers, (batch, *_) = tables
    alone = {r["paper_id"]: r["abstract"] for r in R.enrich_table(papers, "d", ["at"], batch).collect()}
    assert alone["p1"] == "batch" and alone["p11"] == "" and alone["p6"] == "[error: old]"
    assert R.enrich_table(papers.limit(0), "d", ["at"], batch).count() == 0
    assert R.enrich_table(papers, "d", ["at"], batch.limit(0)).count() == len(PAPERS)


def test_policies(spark):
    df = spark.createDataFrame([("own", "own", "own", ("n", None, "n")), ("", None, "own", ("", "n", "")), ("own", "", "", None)], "a string, b string, c string, x struct<a: string, b: string, c: string>")
    rules = [R.Rule("a", lambda x: x["a"], "overwrite", "-"), R.Rule("b", lambda x: x["b"], "fill"), R.Rule("c", lambda x: x["c"], "if_present")]
    got = R.apply_rules(df.withColumn("origin", R.no_origin("abc")), "x", "s", rules)
    assert [(*r[:3], *r["origin"]) for r in got.collect()] == [("n", "own", "n", "s", None, "s"), ("-", "n", "own", "s", "s", None), ("own", "", "", None, None, None)]
    assert {(r["field"], r["source"]): r["n"] for r in R.origin_counts(got).collect()} == {("a", "s"): 2, ("a", "original"): 1, ("b", "s"): 1, ("b", "original"): 2, ("c", "s"): 1, ("c", "original"): 2}
    with pytest.raises(ValueError, match="sometimes"):
        R.Rule("a", lambda x: x["a"], "sometimes")

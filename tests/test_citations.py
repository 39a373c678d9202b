"""Citation graphs against a plain union-find."""

import random

from marlspark.operators import citations as C


def _components(pairs):
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for u, v in pairs:
        a, b = find(u), find(v)
        root[max(a, b)] = min(a, b)
    return {x: find(x) for x in root}


def test_components_equal_union_find(spark):
    rng = random.Random(7)
    pairs = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)]
    pairs += [(1000 + i, 1001 + i) for i in range(60)] + [(2000, 2000 + i) for i in range(1, 90)] + [(5, 5)] + pairs[:20]
    got = {r.node: r.component for r in C.components(spark.createDataFrame(pairs, "u long, v long")).collect()}
    want = _components([p for p in pairs if p[0] != p[1]])
    assert got == want


def test_components_of_nothing(spark):
    assert C.components(spark.createDataFrame([], "u string, v string")).count() == 0
    assert C.components(spark.createDataFrame([("a", "a"), (None, "b")], "u string, v string")).count() == 0


PAPERS = "paper_id string, s2_paper_id string, doi string, arxiv_id string, title string"


def _papers(spark):
    rows = [
        ("a", "1", "10.1/A", "", "First"),
        ("b", "", " 10.1/a ", "24.1v1", 'Sec"ond'),
        ("c", None, None, "24.1v3", "Third"),
        ("d", "", "", "", "no id"),
        ("e", "5", "", "", None),
        ("e", "5", "", "", None),
        (None, "9", "10.1/A", "", "no key"),
    ]
    return spark.createDataFrame(rows, PAPERS)


def test_works_edges_and_degrees(spark):
    papers = _papers(spark)
    members = C.works(papers)
    assert {(r.paper_id, r.work) for r in members.collect()} == {("a", "a"), ("b", "a"), ("c", "a"), ("d", "d"), ("e", "e")} and members.count() == 5
    refs = [("S2:1", "S2:5"), ("ARXIV:24.1", "S2:5"), ("S2:5", "DOI:10.1/a"), ("S2:1", "ARXIV:24.1"), ("S2:5", "S2:77"), ("S2:9", "S2:5"), (None, "S2:5"), ("S2:1", "S2:5")]
    edges = C.edges_inside(spark.createDataFrame(refs, "citing string, cited string"), papers, members)
    assert {(r.citing, r.cited, r.n) for r in edges.collect()} == {("a", "e", 3), ("e", "a", 1)}
    counted = C.degrees(edges, members)
    assert {(r.work, r.cites, r.cited_by) for r in counted.collect()} == {("a", 1, 1), ("d", 0, 0), ("e", 1, 1)}
    assert C.summary(edges, counted).first().asDict() == {"n_works": 3, "n_isolated": 1, "most_cites": 1, "most_cited_by": 1, "n_edges": 2}
    assert [(r.place, r.work) for r in C.most_cited(counted, 2).collect()] == [(1, "a"), (2, "e")]
    titles = papers.where("paper_id in ('a', 'b')").selectExpr("paper_id AS work", "title")
    assert {r.value for r in C.dot_lines(edges, titles).collect()} == {'"a" [label="First"];', '"b" [label="Sec\\"ond"];', '"a" -> "e";', '"e" -> "a";'}


def test_ids_are_asked_in_order_and_nothing_is_a_graph(spark):
    asked = [r.x for r in _papers(spark).select(C.lookup_id().alias("x")).collect()]
    assert asked == ["S2:1", "DOI:10.1/a", "ARXIV:24.1", None, "S2:5", "S2:5", "S2:9"]
    none = spark.createDataFrame([], PAPERS)
    members = C.works(none)
    edges = C.edges_inside(spark.createDataFrame([], "citing string, cited string"), none, members)
    assert C.summary(edges, C.degrees(edges, members)).first().asDict() == {"n_works": 0, "n_isolated": 0, "most_cites": None, "most_cited_by": None, "n_edges": 0}

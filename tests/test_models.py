"""The catalogue of models' files and the metadata over it, on hard listings."""

from marlspark.operators import models as M

FILES = [
    ("pdf", None, "a.pdf"), ("pdf", None, "a.json"), ("pdf", None, "lonely.pdf"), ("human", None, "a.json"), ("human", None, "a.pdf"), ("human", "ignored", "b.review.json"),
    ("llm", "glm5.1", "a.json"), ("llm", "glm5.1", "a.review.json"), ("llm", "glm5.1", "a.revised.json"), ("llm", "gpt5.4", "a.json"), ("llm", "gpt5.4", "a.json"),
    ("llm", "gpt5.4", "b.revised.json"), ("llm", "gpt5.4", "b.pdf.json"), ("llm", None, "c.json"), ("llm", "m", None), (None, "m", "d.json"), ("llm", "m", "e.JSON"), ("llm", "m", "review.json"),
]


def test_catalogue(spark):
    files = spark.createDataFrame(FILES, "area string, model string, file string")
    got = {r["basename"]: r for r in M.model_catalog(files).collect()}
    assert set(got) == {"a", "b", "b.pdf", "review"}
    a = got["a"]
    assert (a["pdf"], a["human"]) == ("a.pdf", "a.json") and {m: tuple(v) for m, v in a["models"].items()} == {"glm5.1": ("a.json", "a.review.json", "a.revised.json"), "gpt5.4": ("a.json", None, None)}
    assert got["b"]["human"] == "b.review.json" and got["b"]["pdf"] is None and tuple(got["b"]["models"]["gpt5.4"]) == (None, None, "b.revised.json")
    assert {r["basename"] for r in M.model_catalog(files, everything=True).where("models IS NULL").collect()} == {"lonely"}
    assert M.model_catalog(files.limit(0)).count() == 0


def test_metadata(spark):
    names = ["titled", "blank", "absent", "broken", "list", "none", "both_blank", "null", "repeated"]
    rows = [("llm", m, f"{n}.json") for n in names for m in M.MODELS] + [("llm", "glm5.1", f"{n}.revised.json") for n in ("blank", "absent")] + [("llm", "third", "other.json")]
    glm = {"titled": '{"title": "T", "year": 2024}', "blank": '{"title": "", "venue": "raw"}', "broken": "{", "list": "[1]", "both_blank": '{"title": "", "venue": "x"}', "null": None}
    gpt = {"titled": '{"title": "U"}', "blank": '{"title": "G", "authors": "A"}', "broken": '{"title": "H"}', "list": '{"venue": "only"}', "both_blank": '{"title": null, "venue": "y"}', "null": "3"}
    docs = [("glm5.1", f"{n}.json", t) for n, t in glm.items()] + [("gpt5.4", f"{n}.json", t) for n, t in gpt.items()]
    docs += [("glm5.1", "blank.revised.json", '{"title": "never"}'), ("glm5.1", "absent.revised.json", '{"title": "R"}'), ("gpt5.4", "repeated.json", '{"title": "1"}'), ("gpt5.4", "repeated.json", '{"title": "2"}'), (None, None, "{}")]
    catalogue = M.model_catalog(spark.createDataFrame(rows, "area string, model string, file string"))
    got = {r[0]: tuple(r[1:]) for r in M.model_metadata(catalogue, spark.createDataFrame(docs, "model string, file string, text string")).collect()}
    assert got == {
        "titled": ("T", "", "2024", ""), "blank": ("G", "", "", "A"), "absent": ("R", "", "", ""), "broken": ("H", "", "", ""), "list": ("", "only", "", ""),
        "none": (None,) * 4, "both_blank": ("", "y", "", ""), "null": (None,) * 4, "repeated": ("2", "", "", ""), "other": (None,) * 4,
    }

"""The pipeline's stages, each on its own input."""

from pathlib import Path
from urllib.parse import urlparse

import corpus_pipeline
from marlspark.llm import leaks
from marlspark.llm.codes import words

from .test_operators import brute_classes

SF = "/root/testdata/sf0.001"


def test_stages_take_effect(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, sizes, kept = docs.columns, [docs.count()], {"": docs.toPandas()}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        if k < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == columns, name
            sizes.append(docs.count())
            kept[name] = docs.toPandas()
    assert sizes == sorted(sizes, reverse=True) and 0 < sizes[-1] < sizes[0]
    assert {"shard", "position"} <= set(docs.columns) and docs.count() > 0
    # Near duplicates: the least id of each class of a comparison of all pairs.
    before = kept["line_dedup"]
    least = {}
    for i, r in zip(before.doc_id, brute_classes(before.text.tolist()), strict=True):
        least[r] = min(i, least.get(r, i))
    assert set(kept["near_dedup"].doc_id) == set(least.values())
    # Decontamination: what goes holds most of an item, and no item stays whole.
    items = [words([t])[0].tolist() for t in spark.read.parquet(f"{SF}/benchmark.parquet").toPandas().text]
    left = set(kept["decontamination"].doc_id)
    for i, t in zip(kept["near_dedup"].doc_id, kept["near_dedup"].text, strict=True):
        codes = words([t])[0].tolist()
        if i in left:
            text = " ".join(map(str, codes)) + " "
            assert not any(f"{' '.join(map(str, it))} " in text for it in items)
        else:
            assert any(leaks.subsequence(it, codes) >= 0.6 * len(it) for it in items)


def test_run_returns_the_last_stage(spark):
    got = corpus_pipeline.run(spark, SF)
    assert got.count() > 0
    # Working tables and earlier results are gone.
    assert [x.name for x in Path(urlparse(got.inputFiles()[0]).path).parents[1].iterdir()] == ["4-mixing"]

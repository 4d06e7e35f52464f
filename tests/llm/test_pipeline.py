"""The pipeline's stages on documents with planted cases."""

import random

import corpus_pipeline
from tests.llm.test_operators import prose


def test_stages(spark, tmp_path):
    r, bad = random.Random(5), ["grumblefuss", "snotwaffle", "dunderpate", "wretchling"]
    texts = {}
    for i in range(160):
        w = prose(i + 10_000, r.randint(60, 150)).split(" ")
        if i % 4 == 0:
            for _ in range(5):
                w.insert(r.randrange(len(w)), r.choice(bad))
        texts[i] = " ".join(w)
    item = prose(777, 30)
    near = prose(888, 120).replace("\n", "").split(" ")  # one line, so that line dedup leaves it
    planted = {200: " ".join(near), 201: " ".join([*near[:60], "changed", *near[61:]]), 202: texts[1], 203: f"{prose(1, 40)} {item} {prose(2, 40)}", 204: None, 205: ""}
    texts |= planted
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in texts.items()], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(160)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(0, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    kept, left = {}, spark.read.parquet(str(tmp_path / "documents.parquet"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, left, str(tmp_path))
        assert out.columns == docs.columns
        out.write.parquet(str(tmp_path / name))
        left = spark.read.parquet(str(tmp_path / name))
        kept[name] = {x["doc_id"] for x in left.collect()}
    toxic = {i for i in range(160) if i % 4 == 0}
    clean = set(texts) - toxic
    assert len(kept["toxicity"] & toxic) <= 2 and len(clean - kept["toxicity"]) <= 2
    assert 202 not in kept["jaccard_join"] and 200 in kept["jaccard_join"] and 201 not in kept["jaccard_join"]
    assert 203 in kept["jaccard_join"] and 203 not in kept["decontamination"]
    assert kept["jaccard_join"] - kept["decontamination"] == {203}
    assert {204, 205} <= kept["decontamination"]
    pieces = corpus_pipeline.STAGES[-1][1](spark, left, str(tmp_path)).collect()
    assert {p["doc_id"] for p in pieces} == kept["decontamination"]
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == len(pieces)

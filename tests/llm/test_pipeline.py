"""The pipeline's stages on a small fixture, each against what it must keep."""

import corpus_pipeline as pipeline

from litro.llm import packing


def test_stages(spark, tmp_path):
    r = [f"w{k}" for k in range(400)]
    clean = {i: " ".join(r[(i * 37 + k * (i + 3)) % 400] for k in range(60)) for i in range(1, 60)}
    item = " ".join(f"bench{k}" for k in range(20))
    rows = [(i, t, "en", "s", len(t)) for i, t in clean.items()]
    rows += [(100, clean[5] + " extra", "en", "s", 9), (101, clean[5], "en", "t", 9), (102, "a b " + item + " c", "en", "s", 9)]
    rows += [(103, "mail me x.y@example.com now please or call", "en", "s", 42), (104, None, None, None, None), (105, "", "en", "s", 0), (None, "no id", "en", "s", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    step = spark.read.parquet(f"{tmp_path}/documents.parquet")
    ids = {}
    for name, stage in pipeline.STAGES[:-1]:
        step = stage(spark, step, str(tmp_path))
        assert step.columns == list(pipeline.COLUMNS)
        step.write.parquet(f"{tmp_path}/{name}")
        step = spark.read.parquet(f"{tmp_path}/{name}")
        ids[name] = sorted((x.doc_id for x in step.collect()), key=lambda v: (v is None, v))
    everything = [*clean, 100, 101, 102, 103, 104, 105, None]
    assert ids["toxicity"] == everything
    assert ids["near_duplicates"] == [i for i in everything if i not in (100, 101)]
    assert ids["decontamination"] == ids["personal_data"] == [i for i in everything if i not in (100, 101, 102)]
    texts = {x.doc_id: (x.text, x.n_chars) for x in step.collect()}
    assert texts[103] == ("mail me <EMAIL> now please or call", 34) and texts[104] == (None, None) and texts[7] == (clean[7], len(clean[7]))
    packed = pipeline.STAGES[-1][1](spark, step, str(tmp_path)).collect()
    assert {p.doc_id for p in packed} == set(texts) and max(p.length for p in packed) <= packing.CAPACITY
    again = pipeline.run(spark, str(tmp_path)).collect()
    assert sorted((str(p.doc_id), p.part, p.length) for p in again) == sorted((str(p.doc_id), p.part, p.length) for p in packed)


def test_near_copies_without_id_take_no_clean_document_along(spark, tmp_path):
    x, y = (" ".join(f"{c}{k}" for k in range(60)) for c in "xy")
    rows = [(5, x), (7, y), (None, x + " more"), (None, y + " more"), (9, x + " else"), (9, "of its own"), (None, "no id")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = sorted((r.doc_id or 0, r.text) for r in pipeline.drop_near_copies(spark, docs, str(tmp_path)).collect())
    assert got == [(0, "no id"), (5, x), (7, y), (9, "of its own")]


def test_rows_that_share_an_id_are_judged_by_their_texts(spark, tmp_path):
    item = " ".join(f"bench{k}" for k in range(20))
    rows = [(1, item), (1, "clean one"), (None, item), (2, "clean two"), (None, "clean none"), (None, None), (3, None)]
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = pipeline.drop_benchmark(spark, docs, str(tmp_path))
    assert got.columns == list(pipeline.COLUMNS)
    assert sorted((r.doc_id or 0, r.text or "") for r in got.collect()) == [(0, ""), (0, "clean none"), (1, "clean one"), (2, "clean two"), (3, "")]

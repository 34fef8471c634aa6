import corpus_pipeline
from surveyspark.llm import queries
from surveyspark.llm.queries import VOCABULARY


def test_queries_are_registered():
    import __spark_entry__

    names = __spark_entry__.queries()
    for n in range(1, 14):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1
    assert names["pipeline"] is corpus_pipeline.run
    assert [n.split("_")[0] for n in queries.QUERIES] == [f"op{n}" for n in range(1, 14)]


def test_stages_keep_clean_documents_and_act_on_planted_cases(spark, tmp_path, prose):
    passage, item = prose(1, 70), prose(2, 30)
    text = prose(3, 150)
    clean = {k: prose(100 + k, 120 + k) for k in range(20)}
    rows = [*clean.items(), (100, None), (101, "12 34 !!"), (102, text), (103, text), (104, text.replace("ba", "bo", 1)),
            (105, prose(4, 50) + " " + passage + " " + prose(5, 50)), (106, prose(6, 50) + " " + passage),
            (107, prose(7, 60) + " " + item + " " + prose(8, 60)), (108, passage)]
    data = [(i, t, "en", "s", len(t or "")) for i, t in rows]
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    now, kept = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = f"{tmp_path}/{name}"
        stage(spark, now, str(tmp_path)).write.parquet(out)
        before, now = now, spark.read.parquet(out)
        if k < 4:
            assert now.columns == docs.columns
            kept[name] = {r.doc_id: r.text for r in now.collect()}
            assert set(clean) <= set(kept[name]) and all(kept[name][i] == clean[i] for i in clean)
    assert set(kept["language_id"]) == {i for i, _ in rows} - {100, 101}
    assert set(kept["near_duplicates"]) == set(kept["language_id"]) - {103, 104}
    assert passage in kept["substring_dedup"][105] and passage not in kept["substring_dedup"][106]
    assert 108 not in kept["substring_dedup"]
    assert set(kept["substring_dedup"]) - set(kept["decontamination"]) == {107}
    packed = now.collect()
    assert {r.doc_id for r in packed} == set(kept["decontamination"])
    whole = corpus_pipeline.run(spark, str(tmp_path)).collect()
    columns = ("doc_id", "piece", "start", "length", "ids_crc32")
    assert sorted(tuple(r[c] for c in columns) for r in whole) == sorted(tuple(r[c] for c in columns) for r in packed)
    assert VOCABULARY.endswith("byte_bpe_50k.json")

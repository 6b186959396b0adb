"""Every stage on tables whose further columns bear the operators' own names."""

import pytest

NAMES = "_op_words _op_n _op_features _op_at _op_ok _op_host host_ok host_docs rate_short _words _n _features _at _host _contamination contamination _found found _text_key _op_text_key _op_key _op_id text_key class_id kept copies row_number shard slot part chunk node features".split()
LONG = "word " * 6000 + "x" * 3000
TEXTS = [None, "", " \n\t", "one two three four five six seven eight nine ten eleven", LONG, LONG, "ten " + "y" * 5000, 'the token = "1beb58b8af68854f0e01b4ad40cdbb6ae7f578ae" was set by some one in the old house by the sea']


def table(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, len(t or ""), *([f"user{i}"] * len(NAMES))) for i, t, s in rows], "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{n} string" for n in NAMES))


@pytest.fixture(scope="module")
def stages():
    import corpus_pipeline

    return dict(corpus_pipeline.STAGES)


@pytest.mark.parametrize("name", ["quality", "near_duplicates", "decontamination", "secrets"])
def test_a_stage_returns_the_columns_it_got(spark, stages, tmp_path, name):
    rows = [(i, t, f"s{i % 2}") for i, t in enumerate(TEXTS)] + [(3, TEXTS[3], "s1"), (None, None, None)]
    spark.createDataFrame([("q-1", "seven eight nine")], "item_id string, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = table(spark, rows)
    out = stages[name](spark, docs, str(tmp_path))
    assert out.columns == docs.columns and out.schema == docs.schema
    got = out.collect()
    assert got and all(r[n] == f"user{r['doc_id']}" for r in got for n in NAMES)
    ids = sorted(str(r["doc_id"]) for r in got)
    want = {
        "quality": {"3", "7"},  # LONG repeats itself, the one before the last has two words
        "near_duplicates": {"0", "1", "2", "3", "4", "6", "7", "None"},
        "decontamination": {"0", "1", "2", "4", "5", "6", "7", "None"},
        "secrets": {"0", "1", "2", "3", "4", "5", "6", "7", "None"},
    }[name]
    assert set(ids) == want and (name != "near_duplicates" or len(ids) == len(want))
    if name == "secrets":
        assert ["[SECRET]" in r["text"] for r in got if r["doc_id"] == 7] == [True] and all(r["text"] == TEXTS[4] for r in got if r["doc_id"] == 4)
    assert stages[name](spark, table(spark, []), str(tmp_path)).isEmpty()


def test_packing_takes_such_tables(spark, stages, tmp_path):
    docs = table(spark, [(i, t, "s") for i, t in enumerate(TEXTS)])
    rows = stages["packing"](spark, docs, str(tmp_path)).collect()
    assert {r["doc_id"] for r in rows} == set(range(len(TEXTS))) and stages["packing"](spark, table(spark, []), str(tmp_path)).isEmpty()


def test_operators_replace_only_the_column_they_name(spark):
    from afterview.llm.contamination import benchmark_hits
    from afterview.llm.hostrules import with_features
    from afterview.llm.secrets import scan_secrets
    from afterview.llm.shards import shard_rows

    docs = table(spark, [(i, t, "s") for i, t in enumerate(TEXTS)])
    items = spark.createDataFrame([("q", "seven eight nine")], "item_id string, text string")
    for made, own in ((benchmark_hits(docs, items), {"contamination"}), (with_features(docs), {"features"}), (scan_secrets(docs), {"found"}), (shard_rows(docs, ["doc_id"], 3), {"row_number", "shard", "slot"})):
        assert sorted(made.columns) == sorted(docs.columns)
        for r in made.collect():
            assert all(r[n] == f"user{r['doc_id']}" for n in NAMES if n not in own) and not any(isinstance(r[n], str) for n in own)

import random

from pathlib import Path

import corpus_pipeline
from strandlake.llm import queries
from strandlake.llm.runtime import shared_folder


def words(rng, n):
    return " ".join("".join(rng.choice(["the", "and", "ing", "her", "tion"]) for _ in range(rng.randint(1, 3))) + str(rng.randint(0, 9)) for _ in range(n))


def test_stages(spark, tmp_path):
    rng = random.Random(6)
    base = words(rng, 120)
    near = base.split(" ")
    near[60] = "changed"
    rows = [(1, base, "en"), (2, " ".join(near), "en"), (3, base, "en"), (4, words(rng, 50) + "\na line of many documents here", "en"), (5, "A line of many documents here  \n" + words(rng, 40), None), (6, "12 34 ...", "en"), (7, None, "en"), (8, words(rng, 30) + " password=0123456789abcdef01", "en"), (9, "", "en")]
    docs = spark.createDataFrame([(d, t, lang, "s", len(t or "")) for d, t, lang in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    seen, now = {}, docs
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, now, str(tmp_path)).write.parquet(f"{tmp_path}/{name}")
        now = spark.read.parquet(f"{tmp_path}/{name}")
        seen[name] = now
        if name != "packing":
            assert now.columns == docs.columns
    ids = {k: sorted({r.doc_id for r in v.collect()}) for k, v in seen.items()}
    assert ids["language_id"] == [1, 2, 3, 4, 5, 8]
    assert ids["line_dedup"] == [1, 2, 4, 5, 8]  # 3 is a copy of 1 and has nothing left
    assert ids["near_duplicates"] == ids["secret_scan"] == ids["packing"] == [1, 4, 5, 8]
    five = next(r for r in seen["line_dedup"].collect() if r.doc_id == 5)
    assert "many documents" not in five.text and five.n_chars == len(five.text)
    assert next(r for r in seen["secret_scan"].collect() if r.doc_id == 8).text.endswith(" [SECRET]")
    run = corpus_pipeline.run(spark, str(tmp_path)).drop("sequence_id")
    assert sorted(map(tuple, run.collect())) == sorted(map(tuple, seen["packing"].drop("sequence_id").collect()))


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def test_no_documents(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_nulls_repeats_long_texts_and_further_columns(spark, tmp_path):
    rng = random.Random(7)
    long = words(rng, 60_000)
    rows = [(1, long, "en"), (2, words(rng, 40), None), (2, words(rng, 40), None), (None, words(rng, 40), "en"), (None, None, None), (3, "one two", "de"), (3, "one two", "de"), (4, "\n" * 5000, "en"), (5, None, "en")]
    docs = spark.createDataFrame([(d, t, lang, None, None, 7, "kept") for d, t, lang in rows], SCHEMA + ", gone int, d string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    now = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        stage(spark, now, str(tmp_path)).write.parquet(f"{tmp_path}/{name}")
        now = spark.read.parquet(f"{tmp_path}/{name}")
        assert now.columns == docs.columns
    assert sorted((r.doc_id or 0, r.gone, r.d) for r in now.collect()) == [(0, 7, "kept"), (1, 7, "kept"), (2, 7, "kept"), (2, 7, "kept"), (3, 7, "kept")]
    assert next(r.text for r in now.collect() if r.doc_id == 1) == long
    packed = corpus_pipeline.run(spark, str(tmp_path))
    assert packed.groupBy("doc_id").count().count() == 4


def test_a_run_leaves_only_what_its_result_reads(spark, tmp_path):
    rng = random.Random(8)
    rows = [(k, words(rng, 30), "en", "s", 1) for k in range(20)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    home = Path(shared_folder(spark).removeprefix("file:"))
    before = set(home.iterdir())
    assert corpus_pipeline.run(spark, str(tmp_path)).count() > 0
    made = [x.name for folder in set(home.iterdir()) - before if folder.name.startswith("pipeline-") for x in folder.iterdir() if not x.name.startswith(".")]
    assert made == ["secret_scan"]


def test_every_operator_has_a_query():
    assert sorted(int(k[2:].split("_")[0]) for k in queries.queries()) == list(range(1, 14))

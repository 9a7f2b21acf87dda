"""The corpus pipeline on a small corpus, stage by stage."""

import corpus_pipeline
import pyarrow.parquet as pq

import __spark_entry__
from test_similarity import brute_components, brute_jaccard

DOCS = "/root/testdata/sf0.001/documents.parquet"


def test_stages_keep_columns_and_take_effect(spark):
    docs = spark.read.parquet(DOCS)
    columns, n = docs.columns, docs.count()
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_classifier", "line_dedup", "ngram_jaccard_join", "pii", "packing"]
    sizes = [n]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        if name == "ngram_jaccard_join":
            rows = docs.select("doc_id", "text").collect()
            ids = [r["doc_id"] for r in rows]
            stay = set(brute_components(ids, brute_jaccard([r["text"] for r in rows])))
        out = stage(spark, docs, "/root/testdata/sf0.001").cache()
        if name == "ngram_jaccard_join":
            assert {r["doc_id"] for r in out.select("doc_id").collect()} == stay
        assert out.columns == columns, name
        assert out.where("n_chars <> length(text)").count() == 0
        sizes.append(out.count())
        docs = out
    assert sizes[0] > sizes[1] == sizes[2] >= sizes[3] == sizes[4]
    assert docs.where("text rlike '[a-z0-9]@mail[0-9]'").count() == 0
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, "/root/testdata/sf0.001")
    assert packed.select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()


def test_run_and_registration(spark):
    names = __spark_entry__.queries()
    assert {f"op{n}_" for n in range(1, 11)} <= {q.split("_")[0] + "_" for q in names}
    assert "pipeline" in names and set(__spark_entry__.oracle_sql()) <= set(names)
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert out.count() >= pq.read_table(DOCS).num_rows * 0.5


PROSE = "The old mill stood by the river and the people of the village came there every morning to trade their corn for bread and salt. "


def test_pipeline_takes_odd_rows(spark, tmp_path):
    rows = [(k, PROSE + f"Number {k} of them said that the price was fair, and the others agreed with that view in the end. " * (k + 1), "en", "s", 1) for k in range(12)]
    rows += [(3, rows[3][1], "en", "s", 1), (3, rows[3][1], "en", "s", 1), (50, None, None, None, None), (51, "", "en", "s", 0), (52, "\n" * 300_000, "en", "s", 1), (None, PROSE * 3, "en", "s", 1)]
    rows += [(60, "mail user1@mail.com " * 5000 + PROSE * 200, "en", "s", 1), (61, "x" * 200_000 + " " + PROSE * 3000, "en", "s", 1)]
    kind = "doc_id long, text string, lang string, source string, n_chars long"
    more = "_id long, h1 long, rep long, score double, keep boolean, base string, spans string, row long, n_lines long, place long"
    df = spark.createDataFrame([(*r, *[1] * 3, 0.5, True, "b", "s", *[1] * 3) for r in rows], f"{kind}, {more}").repartition(3)
    df.write.parquet(f"{tmp_path}/documents.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path)).toPandas()
    per_doc = out.groupby("doc_id").length.sum()
    assert set(range(12)) <= set(per_doc.index) and not {50, 51, 52} & set(per_doc.index)
    assert (out.groupby("sequence_id").length.sum() <= 2048).all()
    df.limit(0).write.parquet(f"{tmp_path}/none/documents.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").count() == 0

import corpus_pipeline
import __spark_entry__
from nestmetrics import llm

SF = "/root/testdata/sf0.001"


def test_registered():
    assert [n for n in llm.queries()] == [n for n in __spark_entry__.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in llm.queries()) == list(range(1, 14))
    assert "pipeline" in __spark_entry__.queries() and set(llm.oracle_sql()) <= set(llm.queries())


def test_stages_keep_columns_and_clean_documents(spark):
    """Whole-table run, each stage against what it must and must not do."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r["doc_id"]: r["text"] for r in kept.collect()}
        out = stage(spark, kept, SF)
        assert out.columns == docs.columns and out.schema.simpleString() == docs.schema.simpleString()
        rows = {r["doc_id"]: r["text"] for r in out.collect()}
        assert set(rows) <= set(before)
        if name == "exact_dedup":
            largest = {}
            for i, t in before.items():
                largest[t] = max(i, largest.get(t, i))
            assert rows == {i: t for t, i in largest.items()}
        if name == "suffix_dedup":
            assert set(rows) == set(before)
        kept = spark.createDataFrame(out.collect(), out.schema)
    packed = corpus_pipeline.STAGES[-1][1](spark, kept, SF)
    assert {r["doc_id"] for r in packed.collect()} == {r["doc_id"] for r in kept.collect()}


def test_run_over_the_tables(spark):
    assert corpus_pipeline.run(spark, SF).count() > 100


def test_suffix_dedup_cuts_passages_of_over_50_words(spark):
    """Also those that have fewer bytes than the strings of op6; passages of 50 words stay."""
    long, short = (" ".join(f"{c}{i}" for i in range(n)) for c, n in (("p", 51), ("q", 50)))
    assert len(long) < 400
    texts = [f"One two.\n{long} three", f"four {long}\nFive.", f"six {short} seven", f"{short} eight", "nine", None]
    out = corpus_pipeline.suffix_dedup(spark, spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), SF)
    left = {r["doc_id"]: r["text"] for r in out.collect()}
    assert left == {0: "One two.\nthree", 1: "four Five."} | dict(list(enumerate(texts))[2:])

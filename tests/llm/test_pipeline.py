import corpus_pipeline
import __spark_entry__ as entry
from tests.compare import connect, difference
from tests.llm import small

import pytest

FOLDER = "/root/testdata/sf0.001"
CORPUS = sorted(n for n in entry.queries() if n.startswith("op") or n == "pipeline")


def test_all_registered():
    assert [n.split("_")[0] for n in sorted(CORPUS, key=lambda n: int(n[2:].split("_")[0]) if n != "pipeline" else 99)] == [*(f"op{i}" for i in range(1, 14)), "pipeline"]


@pytest.mark.parametrize("name", [n for n in CORPUS if n in entry.oracle_sql()])
def test_matches_sql(spark, name):
    assert difference(entry.queries()[name](spark, FOLDER), connect(FOLDER), entry.oracle_sql()[name]) is None


def test_stages_do_what_their_operators_do(spark, folder):
    """Each stage against plain Python on what the stage before it kept."""
    benchmark = " ".join(f"question{i}" for i in range(25))
    docs = [d for d in small.corpus(11, 80) if d[0] is not None] + [(700, f"{'some text before it ' * 3}{benchmark} and after it")]
    df = small.frame(spark, docs).select("doc_id", "text", "lang", "source", "n_chars").dropDuplicates()
    spark.createDataFrame([(1, benchmark)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    kept = df
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = [(r.doc_id, r.text) for r in kept.collect()]
        kept = stage(spark, kept, folder)
        assert kept.columns == df.columns
        after = [(r.doc_id, r.text) for r in kept.collect()]
        kept = spark.createDataFrame(kept.collect(), df.schema)
        if name == "quality rules":
            assert all(len(small.words(t)) >= 20 for _, t in after) and len(after) > 30
        elif name == "near duplicates":
            want = small.components(before)
            assert sorted(after) == sorted(d for d in before if want[d] == d[0])
        elif name == "repeated passages":
            want = small.removal(before)
            assert sorted(after) == sorted((i, want[i, t][4].decode("utf-8", "ignore") if want[i, t][1] else t) for i, t in before if small.words(want[i, t][4].decode("utf-8", "ignore")))
        else:
            assert {i for i, _ in before} - {i for i, _ in after} == {700}
    pieces = corpus_pipeline.STAGES[-1][1](spark, kept, folder)
    assert {r.doc_id for r in pieces.collect()} == {i for i, _ in after}


def test_pipeline_runs(spark):
    assert corpus_pipeline.run(spark, FOLDER).count() > 0

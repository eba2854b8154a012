import pytest

from exactnn import Corpus, read_xvec, sentence_ground_truth, token_ground_truth
from exactnn.operators.embed import hashing_token_embedder
from exactnn.plans.vector_tables import duplicate_report


@pytest.fixture(scope="module")
def corpora(spark, sf):
    items = spark.read.parquet(f"{sf}/benchmark.parquet").selectExpr(
        "item_id as row_id", "text as question", "'en' as title"
    )
    docs = spark.read.parquet(f"{sf}/documents.parquet").selectExpr(
        "doc_id as row_id", "text", "lang as title"
    )
    return Corpus(items, "question", ["row_id"], "title"), Corpus(docs, "text", ["row_id"], "title")


def test_sentence_job_checks_itself_and_goes_on(spark, tmp_path, corpora):
    query, base = corpora

    def run():
        return sentence_ground_truth(
            spark, query, base, str(tmp_path), "hashing", 50, 2000, 10, output_dimension=32,
            validate=True, single_file=True,
        )

    truth = run()
    sizes = {r.part: (r.row_count, r.dim) for r in truth.manifest.collect()}
    assert sizes == {
        "train": (2000, 32), "test": (50, 32), "neighbors": (50, 10), "distances": (50, 10)
    }
    checks = {r.check: r.value for r in truth.checks.collect()}
    assert checks == {
        "checked": 500, "mismatches": 0, "zero_queries": 0, "queries": 50, "missing": 0,
        "short": 0, "complete": 50, "surplus": 0, "order_violations": 0,
        "unknown_query": 0, "unknown_base": 0, "repeated_base": 0,
    }
    assert {r.title for r in truth.base.select("title").distinct().collect()} == {"en"}
    lists = read_xvec(spark, truth.names.indices, "ivec").orderBy("idx").collect()
    stored = truth.neighbours.orderBy("query_id", "rank").collect()
    assert [i for r in lists for i in r.vector] == [r.base_id for r in stored]
    assert {r.part: r.total_rows for r in duplicate_report(spark, truth.names.bundle).collect()} == {
        "train": 2000, "test": 50
    }
    before = sorted(p.stat().st_mtime_ns for p in tmp_path.rglob("*") if p.is_file())
    run()
    assert before == sorted(p.stat().st_mtime_ns for p in tmp_path.rglob("*") if p.is_file())


def test_what_is_stored_is_what_was_asked_for(spark, tmp_path, corpora):
    """Another metric, another table or a run that was cut short is made anew."""
    query, base = corpora

    def run(metric="sqeuclidean", base=base):
        truth = sentence_ground_truth(
            spark, query, base, str(tmp_path), "hashing", 40, 500, 5, output_dimension=32,
            metric=metric, bundle=False, validate=True,
        )
        checks = {r.check: r.value for r in truth.checks.collect()}
        assert checks["mismatches"] == 0 and checks["checked"] == 200
        return sorted(map(tuple, truth.neighbours.collect())), truth

    first, truth = run()
    assert run("cosine")[0] != first
    assert run()[0] == first
    fewer = Corpus(base.table.where("row_id % 2 = 0"), "text", ["row_id"], "title")
    other, _ = run(base=fewer)
    assert other == run(base=fewer)[0]
    marks = [p for p in tmp_path.rglob("*.stamp")]
    assert marks
    for mark in tmp_path.rglob("*neighbours*.stamp/*.parquet"):
        mark.rename(mark.with_suffix(".lost"))
    assert run(base=fewer)[0] == other


def test_token_job(spark, tmp_path, corpora):
    query, base = corpora
    truth = token_ground_truth(
        spark, query, base, str(tmp_path), hashing_token_embedder(16), 16, 100, 3000, 5,
        validate=True,
    )
    assert truth.query.count() == 100 and truth.base.count() == 3000
    checks = {r.check: r.value for r in truth.checks.collect()}
    assert checks["checked"] == 500 and checks["mismatches"] == 0 and checks["complete"] == 100


def test_base_smaller_than_asked(spark, tmp_path, corpora):
    query, base = corpora
    few = Corpus(base.table.where("row_id < 3"), "text", ["row_id"], "title")
    truth = sentence_ground_truth(
        spark, query, few, str(tmp_path), "hashing", 5, 10**6, 10, output_dimension=16,
        validate=True,
    )
    assert 10 < truth.base.count() < 10**6
    assert {r.check: r.value for r in truth.checks.collect()}["complete"] == 5


def test_command_line(spark, tmp_path, corpora, capsys):
    from exactnn.__main__ import main

    query, base = corpora
    query.table.write.parquet(str(tmp_path / "q"))
    base.table.write.parquet(str(tmp_path / "b"))
    tables = ["--query-table", str(tmp_path / "q"), "--base-table", str(tmp_path / "b")]
    main(["sentences", "20", "300", *tables, "-ods", "16", "-k", "5", "--post-validation",
          "--data-dir", str(tmp_path / "out")])
    assert "mismatches" in capsys.readouterr().out
    main(["tokens", "20", "300", *tables, "--dim", "16", "-k", "5", "--no-bundle",
          "--data-dir", str(tmp_path / "out")])
    assert "neighbors" in capsys.readouterr().out
    assert len(list((tmp_path / "out").glob("*/*/*.ivec"))) == 2
    assert len(list((tmp_path / "out").glob("*/*/*.bundle"))) == 1

"""The pipeline's stages on the small tables, and that the library does without them."""

from __future__ import annotations

import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from eventloom.llm import quality, toxicity
from eventloom.llm.queries import ORACLE, QUERIES
from tests.conftest import TESTDATA
from tests.llm.test_similarity import plain_near
from tests.llm.test_text_operators import plain_lines
from tests.test_oracle import compare_with_oracle

SF = f"{TESTDATA}/sf0.001"
#: Has enough labels to learn from.
LARGER = f"{TESTDATA}/sf0.01"


def test_names():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "quality", "line_dedup", "near_dedup", "packing"]


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
@pytest.mark.parametrize("name", sorted(ORACLE))
def test_queries_match_their_sql(spark, name, sf):
    compare_with_oracle(spark, QUERIES[name], ORACLE[name], sf)


def test_stages(spark, request):
    docs = spark.read.parquet(f"{LARGER}/documents.parquet")
    labels = {r.doc_id: r for r in spark.read.parquet(f"{LARGER}/labels.parquet").collect()}
    stages = dict(corpus_pipeline.STAGES)
    columns, cached = docs.columns, []
    request.addfinalizer(lambda: [frame.unpersist(blocking=True) for frame in cached])

    def kept(name, docs):
        out = stages[name](spark, docs, LARGER).cache()
        cached.append(out)
        assert out.columns == columns and out.dtypes == docs.dtypes
        return out, {r.doc_id for r in out.collect()}

    before = {r.doc_id for r in docs.collect()}
    docs, after = kept("toxicity", docs)
    gone = before - after
    assert sum(labels[i].toxic for i in gone if i in labels) >= 0.6 * sum(r.toxic for r in labels.values())
    assert sum(labels[i].toxic == 0 for i in gone if i in labels) <= 5
    before = after
    docs, after = kept("quality", docs)
    gone = [labels[i].quality for i in before - after if i in labels]
    assert sum(gone) <= 2 and sum(q == 0 for q in gone) >= 0.8 * sum(labels[i].quality == 0 for i in before if i in labels)

    texts = [(r.doc_id, r.text) for r in docs.collect()]
    docs, same = kept("line_dedup", docs)
    assert same == after
    assert sorted((r.doc_id, r.text) for r in docs.collect()) == sorted((r[0], r[3]) for r in plain_lines(texts))
    assert docs.where(F.char_length("text") != F.col("n_chars")).count() == 0

    texts = [(r.doc_id, r.text) for r in docs.collect()]
    docs, after = kept("near_dedup", docs)
    assert after == {r[0] for r in plain_near(texts) if r[3]}
    pieces = stages["packing"](spark, docs, LARGER)
    assert {r.doc_id for r in pieces.select("doc_id").collect()} == after


def test_run(spark):
    assert corpus_pipeline.run(spark, SF).count() > 0


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_of_no_rows_and_of_nulls(spark, name):
    """Labels are of other documents: nothing is learned, and nothing fails."""
    stage = dict(corpus_pipeline.STAGES)[name]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    assert stage(spark, spark.createDataFrame([], schema), SF).count() == 0
    rows = spark.createDataFrame([(None, None, None, None, None), (-1, "", None, None, 0), (-1, "", None, None, 0), (-2, None, None, None, None)], schema)
    ids = [r.doc_id for r in stage(spark, rows, SF).collect()]
    assert set(ids) <= {None, -1, -2}
    if name in ("line_dedup", "near_dedup", "packing"):
        assert sorted(map(str, ids)) == ["-1", "-1", "-2", "None"]


def test_columns_named_like_those_of_operators_keep_their_values(spark):
    extra = ["n_lines", "n_dropped", "kept_text", "lost", "id", "score"]
    rows = [(i, "a line that several documents hold\nand one of their own", "en", "s", 1, *range(6)) for i in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{n} int" for n in extra))
    for name in ("line_dedup", "near_dedup"):
        out = dict(corpus_pipeline.STAGES)[name](spark, docs, SF)
        assert out.columns == docs.columns
        assert {tuple(r[n] for n in extra) for r in out.collect()} == {tuple(range(6))}


def test_a_cluster_has_to_name_a_shared_folder(spark):
    from types import SimpleNamespace

    from eventloom.llm.staging import shared_root

    def session(master):
        return SimpleNamespace(conf={}, sparkContext=SimpleNamespace(master=master))

    with pytest.raises(ValueError, match="shares"):
        shared_root(session("spark://host:7077"))


def test_classifier_stages_keep_what_scores_say(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    scored = {r.doc_id for r in quality.score_quality(docs, labels).collect() if r.predicted}
    assert {r.doc_id for r in quality.keep_quality(docs, labels).collect()} == scored
    scored = {r.doc_id for r in toxicity.score_toxicity(docs, labels).collect() if not r.predicted}
    assert {r.doc_id for r in toxicity.drop_toxic(docs, labels).collect()} == scored


def test_the_library_does_without(tmp_path):
    """A copy without the subpackage and the pipeline still imports and has its other queries."""
    import shutil

    root = Path(__file__).resolve().parents[2]
    shutil.copytree(root / "eventloom", tmp_path / "eventloom", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    for name in ("__spark_entry__.py", "duckdb_oracle.py"):
        shutil.copy(root / name, tmp_path / name)
    code = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), any(n.startswith('op') for n in e.queries()))"
    said = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, env={"PATH": "/usr/bin:/bin"})
    assert said.stdout.split() == ["43", "43", "False"], said.stderr

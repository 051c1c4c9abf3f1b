import os
import shutil
import subprocess
import sys

import pytest

import __spark_entry__
import corpus_pipeline
from granary.llm import quality_net, simhash, suffix_dedup
from granary.llm.common import pick, share
from pyspark.sql import functions as F

REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SF = "/root/testdata/sf0.001"


def test_every_query_is_registered():
    names = __spark_entry__.queries()
    assert [sum(n.startswith(f"op{i}_") for n in names) for i in range(1, 11)] == [1] * 10 and "pipeline" in names
    assert [f.__name__ for _, f in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "repeats", "benchmark", "tokens"]


def test_pipeline_matches_plain_steps(spark):
    """Each stage against a plain version of its rule on the rows its predecessor kept."""
    from test_simhash import slow_components, slow_fingerprint
    from test_suffix_dedup import brute
    from test_tokens_and_items import PATH, brute as hits
    from tokenizers import Tokenizer

    from granary.llm.common import plain_words
    from granary.llm.decontaminate import MAX_COVERAGE, without_words

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    model = quality_net.fit(docs, labels, learn_from=lambda c: share(c, 5, (1, 2, 3, 4)))
    rows = docs.select("doc_id", "text", quality_net.score_column(F.col("text"), model).alias("s")).orderBy("doc_id").collect()
    kept = [(r["doc_id"], r["text"]) for r in rows if r["s"] >= quality_net.THRESHOLD]
    root = slow_components([slow_fingerprint(t) for _, t in kept])
    kept = [k for i, k in enumerate(kept) if root[i] == i]
    texts = []
    for (i, t), (_, spans, _) in zip(kept, brute([t for _, t in kept])):
        left = suffix_dedup.without_spans(t, spans)
        if not spans or left.strip(" "):
            texts.append((i, left))
    items = [(r["item_id"], plain_words(r["text"])) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    final = {}
    for i, t in texts:
        words = plain_words(t)
        marks = set()
        for _, w in items:
            for q in ([w] if 0 < len(w) < 10 else [w[k:k + 10] for k in range(len(w) - 9)]):
                for k in range(len(words) - len(q) + 1):
                    if words[k:k + len(q)] == q:
                        marks.update(range(k, k + len(q)))
        if len(marks) > MAX_COVERAGE * len(words):
            continue
        spans = []
        for k in sorted(marks):
            if spans and spans[-1][1] == k:
                spans[-1] = (spans[-1][0], k + 1)
            else:
                spans.append((k, k + 1))
        final[i] = without_words(t, spans) if spans else t
    lib = Tokenizer.from_file(PATH)
    got = {r["doc_id"]: list(r["ids"]) for r in corpus_pipeline.run(spark, SF).collect()}
    assert got == {i: lib.encode(t, add_special_tokens=False).ids for i, t in final.items()}
    assert hits is not None


def test_stages_on_odd_tables(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame([(None, None, None, None, None), (1, "", "en", "s", 0), (1, "", "en", "s", 0), (2, None, None, "s", None)], docs.schema)
    for name, stage in corpus_pipeline.STAGES:
        for frame in (docs.limit(0), odd):
            out = stage(spark, frame, SF)
            out.collect()
            if name != corpus_pipeline.STAGES[-1][0]:
                assert out.columns == docs.columns


def test_pick_prefers_the_exact_name(spark):
    df = spark.createDataFrame([(1, "a", "b")], "doc_id long, TEXT string, text string")
    assert pick(df, "text").first()[0] == "b"


@pytest.mark.parametrize("gone", [("granary/llm", "tests/llm", "corpus_pipeline.py")])
def test_the_rest_works_without_these_folders(tmp_path, gone):
    copy = tmp_path / "repo"
    shutil.copytree(REPO, copy, ignore=shutil.ignore_patterns(".git", "__pycache__", "llm", "corpus_pipeline.py", "spark-warehouse"))
    code = "import __spark_entry__ as e; q = e.queries(); assert len(q) >= 95 and 'pipeline' not in q and e.oracle_sql(); print('fine')"
    out = subprocess.run([sys.executable, "-c", code], cwd=copy, capture_output=True, text=True, env={**os.environ, "PYTHONPATH": str(copy)})
    assert out.stdout.strip() == "fine", out.stderr


def test_chains_over_simhash_are_whole(spark):
    assert simhash.keep_one(spark.read.parquet(f"{SF}/documents.parquet")).count() > 0

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from granary.llm import language_id, line_rules, quality_net
from granary.llm.common import share
from llm_help import by_id, docs_of

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")


def test_quality_on_held_out_rows(spark, docs, labels):
    model = quality_net.fit(docs, labels, learn_from=lambda c: share(c, 5, (1, 2, 3, 4)))
    rows = docs.join(labels.select("doc_id", "quality"), "doc_id").where(share(F.col("doc_id"), 5, (0,)))
    got = rows.select("quality", quality_net.score_column(F.col("text"), model).alias("s")).collect()
    right = [(r["s"] >= quality_net.THRESHOLD) == (r["quality"] == 1) for r in got]
    assert len(right) > 40 and np.mean(right) > 0.95
    odd = docs_of(spark, [None, "", " ", "x " * 50_000]).select(quality_net.score_column(F.col("text"), model).alias("s")).collect()
    assert all(0.0 <= r["s"] <= 1.0 for r in odd)


def test_quality_without_labels(spark, labels):
    d = docs_of(spark, ["a b", None])
    model = quality_net.fit(d, labels.limit(0))
    assert [r[0] for r in d.select(quality_net.score_column(F.col("text"), model)).collect()] == [0.5, 0.5]
    one = spark.createDataFrame([(0, 1), (0, None)], "doc_id long, quality int")
    model = quality_net.fit(d, one)
    assert [r[0] for r in d.select(quality_net.score_column(F.col("text"), model)).collect()] == [pytest.approx(2 / 3)] * 2
    assert quality_net.fit(d.limit(0), labels)[1].fitted is False


def test_sample_is_bounded_and_the_same_each_time(docs, labels):
    a = quality_net.fit(docs, labels, max_sample=50)[1]
    b = quality_net.fit(docs.repartition(5), labels, max_sample=50)[1]
    assert np.allclose(a.w[0], b.w[0])


def test_word_vectors_equal_a_plain_count(spark):
    texts = ["the cat sat", "THE cat !! cat cat", None, ""]
    tokens = quality_net.Tokens()
    place, sign = quality_net.index_vectors()
    want = np.zeros((quality_net.VOCABULARY, quality_net.DIMENSIONS))
    for t in texts:
        ids = tokens(t)
        for i, a in enumerate(ids):
            for j in range(max(0, i - quality_net.REACH), min(len(ids), i + quality_net.REACH + 1)):
                if i != j:
                    for p, s in zip(place[ids[j]], sign[ids[j]]):
                        want[a, p] += s
    want /= np.maximum(np.linalg.norm(want, axis=1, keepdims=True), 1.0)
    assert np.allclose(quality_net.word_vectors(docs_of(spark, texts)), want, atol=1e-6)


def test_language_on_held_out_rows(docs):
    model = language_id.fit(docs.where(share(F.col("doc_id"), 3, (0, 2))))
    got = by_id(language_id.identify(docs, model))
    rows = docs.where(share(F.col("doc_id"), 3, (1,)) & F.col("lang").isNotNull()).select("doc_id", "lang").collect()
    assert np.mean([got[r["doc_id"]]["lang_pred"] == r["lang"] for r in rows]) > 0.98


def test_language_of_odd_texts_and_mixtures(spark, docs):
    model = language_id.fit(docs)
    by = {r["lang"]: r["text"] for r in docs.where(F.length("text") > 3000).dropDuplicates(["lang"]).collect()}
    mixed = by["en"][:3000] + " " + by["de"][:1200]
    got = by_id(language_id.identify(docs_of(spark, [None, "", "12 -- !", mixed, by["fr"] * 20]), model))
    assert [got[i]["lang_pred"] for i in range(5)] == ["und", "und", "und", "en", "fr"]
    assert got[0]["score"] == 0.0 and 0.5 < got[3]["score"] < 0.9 < got[4]["score"]
    none = language_id.fit(docs.limit(0))
    assert language_id.predict(["some text"], *none) == (["und"], [0.0])


def test_language_batches_agree_with_single_documents(docs):
    names, logp = language_id.fit(docs)
    texts = [r["text"] for r in docs.orderBy("doc_id").limit(40).collect()]
    whole = language_id.predict(texts, names, logp)
    single = [language_id.predict([t], names, logp) for t in texts]
    assert whole[0] == [s[0][0] for s in single]
    assert np.allclose(whole[1], [s[1][0] for s in single])


def slow_counts(text):
    import re

    t = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    runs = [tuple(w[i:i + 8]) for i in range(len(w) - 7)]
    cover = {j for i, r in enumerate(runs) if runs.count(r) > 1 for j in range(i, i + 8)}
    seen, dup = set(), 0
    for line in t.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(cover)


def test_base_counts_match_brute_force(spark):
    rnd = random.Random(3)
    texts = [None, "", "\n \n", "a b c d e f g h " * 40, "x\u00a0y\u2003z\x1c", "l\nl\n l\nl"]
    texts += ["".join(rnd.choice(["a ", "b ", "c\n", "# ", "é|", "  ", "\n"]) for _ in range(rnd.randint(0, 120))) for _ in range(80)]
    got = by_id(line_rules.judge(docs_of(spark, texts), line_rules.Field()))
    for i, t in enumerate(texts):
        r = got[i]
        want = slow_counts(t)
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want, repr(t)
        assert r["base_failed"] == (want[0] < 20 or 100 * want[4] > 30 * want[0])
        assert r["kept"] == (not r["base_failed"])  # an untrained field calls every line content


def test_viterbi_finds_the_best_sequence():
    rng = np.random.default_rng(9)
    for n in range(1, 9):
        x = rng.normal(size=(n, line_rules.FEATURES))
        field = line_rules.Field(rng.normal(size=(2, line_rules.FEATURES)), rng.normal(size=(2, 2)))

        def value(states):
            return sum(field.emit[s] @ v for s, v in zip(states, x)) + sum(field.step[a, b] for a, b in zip(states, states[1:]))

        best = max(value([k >> i & 1 for i in range(n)]) for k in range(2**n))
        assert value(field.viterbi(x).tolist()) == pytest.approx(best)


def test_field_learns_from_labels(spark, docs, labels):
    field = line_rules.fit(docs, labels, learn_from=lambda c: share(c, 5, (1, 2, 3, 4)))
    got = by_id(line_rules.judge(docs, field))
    rows = labels.where(share(F.col("doc_id"), 5, (0,)) & F.col("quality").isNotNull()).collect()
    good = [got[r["doc_id"]] for r in rows if r["quality"] == 1 and r["doc_id"] in got]
    bad = [got[r["doc_id"]] for r in rows if r["quality"] == 0 and r["doc_id"] in got]
    assert np.mean([g["kept"] or g["base_failed"] for g in good]) > 0.97
    assert np.mean([b["kept"] for b in bad]) < 0.3
    assert line_rules.fit(docs, labels.limit(0)).emit.any() == False  # noqa: E712


def test_the_sample_is_bounded_in_lines(spark, monkeypatch):
    texts = ["good line here\n" * 5000, "bad 1 2 3\n" * 5000]
    labels = spark.createDataFrame([(0, 1), (1, 0)], "doc_id long, quality int")
    sizes = []
    monkeypatch.setattr(line_rules.Field, "fit", lambda self, x, y: sizes.extend(map(len, x)) or self)
    line_rules.fit(docs_of(spark, texts), labels)
    assert sizes == [line_rules.MAX_LINES] * 2
    x = np.arange(1000)[:, None]
    some = line_rules.sample_lines(x)[:, 0]
    assert some[0] == 0 and some[-1] == 999 and len(set(some.tolist())) == line_rules.MAX_LINES
    assert line_rules.sample_lines(x[:100]) is not None and len(line_rules.sample_lines(x[:100])) == 100

"""Empty tables, repeated rows and very long texts, across operators."""

import numpy as np

from granary.llm import bpe_chunks, decontaminate, language_id, line_rules, quality_net, simhash, url_filter
from granary.llm.common import share
from granary.llm.queries import vocabulary_path
from llm_help import by_id, docs_of


def labelled(spark, texts):
    langs = ["en", "de"]
    return spark.createDataFrame([(i, t, langs[i % 2]) for i, t in enumerate(texts)], "doc_id long, text string, lang string")


def test_language_of_empty_repeated_and_long(spark):
    texts = ["the house and the garden of the man", "das haus und der garten des mannes"] * 12
    model = language_id.fit(labelled(spark, texts))
    assert language_id.identify(docs_of(spark, []), model).collect() == []
    got = by_id(language_id.identify(docs_of(spark, [texts[0], texts[0], texts[1] * 20000, None]), model))
    assert (got[0]["lang_pred"], got[0]["score"]) == (got[1]["lang_pred"], got[1]["score"]) and got[0]["lang_pred"] == "en"
    assert got[2]["lang_pred"] == "de" and got[3]["lang_pred"] == "und"


def test_more_than_four_languages_in_a_set():
    names = [f"l{i}" for i in range(6)]
    rng = np.random.default_rng(1)
    table = np.full((language_id.BUCKETS, 6), 0.01)
    words = [[f"{c}{a}{b}" for a in "abcdefgh" for b in "ijklmnop"] for c in "qrstuv"]
    for i, w in enumerate(words):
        at, n = language_id.trigram_counts(" ".join(w))
        table[at, i] += 50 * n
    logp = np.log(table / table.sum(0))
    mixed = " ".join(rng.permutation([x for i, w in enumerate(words) for x in w * (3 if i == 4 else 2)]))
    lang, score = language_id.predict([mixed], names, logp)
    assert lang == ["l4"] and 0.15 < score[0] < 0.35


def test_rules_of_empty_and_repeated(spark):
    docs = docs_of(spark, ["A line of words that goes on.\nAnother line.", "menu\nhome\nnews", "x y z"] * 6)
    labels = spark.createDataFrame([(i, int(i % 3 == 0), 0) for i in range(18)], "doc_id long, quality int, toxic int")
    field = line_rules.fit(docs, labels, learn_from=lambda c: share(c, 5, (0, 1, 2, 3, 4)))
    assert line_rules.judge(docs_of(spark, []), field).collect() == []
    got = by_id(line_rules.judge(docs, field))
    assert all({k: v for k, v in got[i].items() if k != "doc_id"} == {k: v for k, v in got[i % 3].items() if k != "doc_id"} for i in got)
    model = quality_net.fit(docs, labels, learn_from=lambda c: share(c, 5, (0, 1, 2, 3, 4)))
    from pyspark.sql import functions as F

    scores = {r["doc_id"]: r["s"] for r in docs.select("doc_id", quality_net.score_column(F.col("text"), model).alias("s")).collect()}
    assert all(abs(scores[i] - scores[i % 3]) < 1e-6 for i in scores)


def test_repeated_rows_give_repeated_results(spark):
    text = "one two three four five six seven eight nine ten eleven"
    docs = docs_of(spark, [text, text, None])
    bench = spark.createDataFrame([(1, text)], "item_id long, text string")
    got = by_id(decontaminate.contamination(docs, bench))
    assert got[0]["n_hit"] == got[1]["n_hit"] == 11 and got[2]["n_hit"] == 0
    codes = by_id(bpe_chunks.encode_texts(docs, vocabulary_path(), with_ids=False))
    assert codes[0]["ids_sha256"] == codes[1]["ids_sha256"] and codes[2]["n_tokens"] == 0
    pages = spark.createDataFrame([(i, "http://casinobonus.example/x", "") for i in range(3)], "page_id long, url string, html string")
    assert len({r["block_score"] for r in url_filter.judge(pages).collect()}) == 1


def test_simhash_of_a_very_long_text(spark):
    long = " ".join(f"w{i % 997}" for i in range(300_000))
    got = by_id(simhash.components(docs_of(spark, [long, long, "a b c"])))
    assert got[0]["fp"] == got[1]["fp"] and got[0]["component_id"] == got[1]["component_id"] == 0

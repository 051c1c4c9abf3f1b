import random

import pandas as pd
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from granary.llm import bpe_chunks, decontaminate
from granary.llm.common import plain_words
from llm_help import by_id, docs_of

PATH = public_tokenizers.path("byte_bpe_50k.json")


def test_encoding_equals_the_library(spark):
    lib = Tokenizer.from_file(PATH)
    rnd = random.Random(1)
    bits = ["a", "b", " ", "  ", "\n", "\t", "é", "ü", "1", "9", "'s", "'", "<|endoftext|>", "!", "漢", "\u00a0", "😀", " the", "word", "_", "-"]
    texts = [None, "", " ", "x" * 5000, "ab " * 9000, "<|endoftext|>"]
    texts += ["".join(rnd.choice(bits) for _ in range(rnd.randint(0, 900))) for _ in range(80)]
    sample = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").limit(60).collect()
    texts += [r["text"] for r in sample]
    got = by_id(bpe_chunks.encode_texts(docs_of(spark, texts), PATH))
    from hashlib import sha256
    for i, t in enumerate(texts):
        ids = lib.encode(t or "", add_special_tokens=False).ids
        r = got[i]
        assert list(r["ids"]) == ids and r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == sha256((t or "").encode()).hexdigest()
        assert lib.decode(ids, skip_special_tokens=False) == (t or "")


@pytest.mark.parametrize("mean", [16, 64, 256])
def test_joins_are_repaired_at_any_chunk_size(mean):
    lib = Tokenizer.from_file(PATH)
    encode = bpe_chunks.encoder(PATH, mean)
    rnd = random.Random(mean)
    for _ in range(150):
        t = "".join(rnd.choice(["The ", "cat's ", "sat", "  ", "\n\n", "on", ", ", "été ", "12", " 3.5", "!!", "ß"]) for _ in range(rnd.randint(1, 300)))
        assert encode(t).tolist() == lib.encode(t, add_special_tokens=False).ids


def test_chunks_are_shared_between_documents():
    enc, table, _ = bpe_chunks.codec(PATH)
    chunks = bpe_chunks.ChunkEncoder(enc, table, 64)
    body = " ".join(f"word{i} stands here" for i in range(400))
    chunks.encode(body)
    before = len(chunks.cache)
    chunks.encode("another start. " + body)
    assert len(chunks.cache) < before * 1.1  # only chunks next to the start are new


def brute(words, items, window):
    hit, found = set(), set()
    for item, w in items:
        for q in ([w] if 0 < len(w) < window else [w[i:i + window] for i in range(len(w) - window + 1)]):
            for k in range(len(words) - len(q) + 1):
                if q and words[k:k + len(q)] == q:
                    hit.update(range(k, k + len(q)))
                    found.add(item)
    return len(hit), sorted(found, key=str)


def test_automaton_matches_brute_force():
    rnd = random.Random(7)
    for _ in range(800):
        letters = [b"a", b"b", b"c"][:rnd.randint(1, 3)]
        window = rnd.randint(1, 5)
        items = [(i, [rnd.choice(letters) for _ in range(rnd.randint(0, 7))]) for i in range(rnd.randint(0, 5))]
        words = [rnd.choice([*letters, b"z"]) for _ in range(rnd.randint(0, 30))]
        spans, found = decontaminate.SuffixAutomaton(items, window).spans(words)
        assert (sum(b - a for a, b in spans), sorted(found, key=str)) == brute(words, items, window)


def items_of(spark, texts):
    return spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "item_id long, text string, doc_id string")


def test_blocks_of_items_give_the_same(spark):
    items = ["one two three four five six seven eight nine ten eleven", "Short item", None, "", "...", "short ITEM"]
    texts = ["a " + items[0].upper().replace(" ", "--") + " b", "a short, item here", None, "", "nothing", "one two three four five six seven eight nine"]
    want = [brute(plain_words(t), [(i, plain_words(x)) for i, x in enumerate(items)], 10) for t in texts]
    for block in (1, 5, 10_000):
        got = by_id(decontaminate.contamination(docs_of(spark, texts), items_of(spark, items), block_words=block))
        assert [(got[i]["n_hit"], got[i]["items"]) for i in range(len(texts))] == want
    none = by_id(decontaminate.contamination(docs_of(spark, texts), items_of(spark, items).limit(0)))
    assert all(r["n_hit"] == 0 and r["items"] == [] for r in none.values())


def test_one_automaton_at_a_time(spark, monkeypatch):
    """Blocks are small, also those of one long item, and a task never holds two automata."""
    rnd = random.Random(11)
    items = [" ".join(rnd.choice("abcdefgh") for _ in range(rnd.choice([2, 5, 12, 90]))) for _ in range(60)]
    texts = [" ".join(rnd.choice("abcdefgh") for _ in range(300)) + " " + rnd.choice(items) for _ in range(12)]
    parts = decontaminate.blocks(items_of(spark, items + items[:20]), 4, 25)
    assert len(parts) > 20 and all(len(t.split()) <= 28 for p in parts for _, t in p.value)
    alive, most = [0], [0]

    class Counted(decontaminate.SuffixAutomaton):
        def __init__(self, *args):
            alive[0] += 1
            most[0] = max(most[0], alive[0])
            super().__init__(*args)

        def __del__(self):
            alive[0] -= 1

    monkeypatch.setattr(decontaminate, "SuffixAutomaton", Counted)
    got = pd.concat(decontaminate.matches(parts, 4, 1000).func(iter([pd.Series(texts[:5]), pd.Series(texts[5:])])))
    monkeypatch.undo()
    assert most[0] == 1
    want = [brute(plain_words(t), [(i, plain_words(x)) for i, x in enumerate(items + items[:20])], 4) for t in texts]
    assert list(zip(got["n_hit"], got["items"])) == want
    rows = by_id(decontaminate.contamination(docs_of(spark, texts), items_of(spark, items + items[:20]), window=4, block_words=25))
    assert [(rows[i]["n_hit"], rows[i]["items"]) for i in range(len(texts))] == want


def test_items_digest(spark):
    df = spark.createDataFrame([([3, 10, 2],), ([],)], "items array<long>")
    got = [r[0] for r in df.select(decontaminate.items_digest(F.col("items"))).collect()]
    assert got == [decontaminate.digest_of([3, 10, 2]), decontaminate.digest_of([])]


def test_spans_are_removed_and_leaks_dropped(spark):
    item = "one two three four five six seven eight nine ten eleven"
    texts = ["Before it, " + item.upper() + "! After it stand some more words of its own.", item, "Clean text.", None, ""]
    d = docs_of(spark, texts)
    out = decontaminate.remove_contamination(d, items_of(spark, [item]))
    assert out.columns == d.columns
    got = by_id(out)
    assert got[0]["text"] == "Before it, ! After it stand some more words of its own." and got[0]["n_chars"] == len(got[0]["text"])
    assert 1 not in got and got[2]["text"] == "Clean text." and got[3]["text"] is None and got[4]["text"] == ""

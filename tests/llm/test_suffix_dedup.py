import hashlib
import random

from pyspark.sql import functions as F

from granary.llm import suffix_dedup
from llm_help import by_id, docs_of


def brute(texts, length=200):
    data = [(t or "").encode() for t in texts]
    seen = {}
    for b in data:
        for i in range(len(b) - length + 1):
            seen[b[i:i + length]] = seen.get(b[i:i + length], 0) + 1
    out = []
    for b in data:
        mark = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if seen[b[i:i + length]] > 1:
                mark[i:i + length] = b"\1" * length
        spans, i = [], 0
        while i < len(b):
            if mark[i]:
                j = i
                while j < len(b) and mark[j]:
                    j += 1
                spans.append((i, j))
                i = j
            else:
                i += 1
        kept = bytes(c for c, m in zip(b, mark) if not m)
        out.append((len(b), spans, hashlib.sha256(kept).hexdigest()))
    return out


def corpus():
    rnd = random.Random(6)

    def words(n):
        return " ".join("".join(rnd.choice("abcdeéß") for _ in range(rnd.randint(1, 9))) for _ in range(n))

    shared = [words(60) for _ in range(4)]
    long = words(900)
    texts = [None, "", "short", long, long, "x" * 199, "x" * 1000, "ab" * 400, "é" * 99 + "a", "é" * 100, "é" * 100]
    for _ in range(25):
        t = words(rnd.randint(0, 80))
        for _ in range(rnd.randint(0, 3)):
            s = rnd.choice(shared)
            a = rnd.randrange(len(s))
            t += s[a:a + rnd.randint(50, 400)] + words(rnd.randint(0, 20))
        texts.append(t)
    for _ in range(15):  # near copies of the long text
        w = long.split(" ")
        for _ in range(rnd.randint(1, 30)):
            w[rnd.randrange(len(w))] = words(1)
        texts.append(" ".join(w))
    return texts


def test_matches_brute_force(spark):
    texts = corpus()
    want = brute(texts)
    for parts in (1, 5):
        got = by_id(suffix_dedup.removed(docs_of(spark, texts, parts)))
        for i, (n, spans, digest) in enumerate(want):
            r = got[i]
            assert (r["n_bytes"], [(s["start"], s["end"]) for s in r["spans"]], hashlib.sha256(r["kept"]).hexdigest()) == (n, spans, digest), i


def test_small_chunks_settle_within_a_task(spark, monkeypatch):
    texts = corpus()
    monkeypatch.setattr(suffix_dedup, "CHUNK_ROWS", 5)
    got = by_id(suffix_dedup.removed(docs_of(spark, texts, 2), length=64))
    for i, (n, spans, digest) in enumerate(brute(texts, 64)):
        assert [(s["start"], s["end"]) for s in got[i]["spans"]] == spans


def test_stage_keeps_whole_characters_and_columns(spark):
    rnd = random.Random(1)
    tail = "".join(rnd.choice("abcdef ") for _ in range(300))
    texts = ["é" + tail + "# own words", "è" + tail + "% other words", "clean text", None, "", tail]
    d = docs_of(spark, texts)
    out = suffix_dedup.remove_repeats(d)
    assert out.columns == d.columns
    got = by_id(out)
    assert got[0]["text"] == "é# own words" and got[1]["text"] == "è% other words" and got[0]["n_chars"] == len("é# own words")
    assert got[2]["text"] == "clean text" and got[3]["text"] is None and got[4]["text"] == ""
    assert 5 not in got  # nothing was left of it


def test_empty_table_and_repeated_rows(spark):
    d = docs_of(spark, ["a" * 300])
    assert suffix_dedup.removed(d.limit(0)).collect() == []
    got = suffix_dedup.removed(d.unionAll(d)).select(F.size("spans"), F.octet_length("kept")).collect()
    assert [tuple(r) for r in got] == [(1, 0), (1, 0)]

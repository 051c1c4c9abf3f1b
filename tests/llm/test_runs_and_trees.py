"""op11 and op13 against the library and against plain definitions."""

import random
from hashlib import sha256
from zlib import crc32

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from granary.llm import bpe_tree, periodic_runs
from granary.llm.queries import RANKS, op11_byte_bpe, op13_periodic_runs, vocabulary_path
from llm_help import by_id, docs_of

public_tokenizers = pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module", params=[(2, 1), (9, 2), (1024, 8)])
def coder(request):
    return bpe_tree.TreeCoder(vocabulary_path(RANKS), public_tokenizers.PATTERN, *request.param)


SIGNS = [
    "a", "e", "the", "ing", " ", "  ", "\n", "\r\n", "\t", "'", "'s", "'re", "'ll", "1", "23", ".", "!!", "é", "ß", "中", "文", "　", "\xa0",
    "\x85", "\x1c", "᠎", "😀", "é", "ʼ", "Ⅷ", "²", "_", "क", "ि", "​", "¼", "𐐀", "<|endoftext|>",
]


def test_trees_equal_the_library(coder):
    rng = random.Random(1)
    for _ in range(3000):
        text = "".join(rng.choices(SIGNS, k=rng.randint(0, 60)))
        if rng.random() < 0.3:
            text = rng.choice(["a", " ", "\n", "aa ", "中", "1", "-", "='", "ab", "'a"]) * rng.randint(0, 400)
        ids = coder.encode(text)
        assert ids == coder.enc.encode_ordinary(text), text
        assert coder.decode(ids) == text.encode()


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=200))
def test_any_text(text):
    coder = bpe_tree.TreeCoder(vocabulary_path(RANKS), public_tokenizers.PATTERN, 5, 1)
    assert coder.encode(text) == coder.enc.encode_ordinary(text)


def test_long_pieces(coder):
    rng = random.Random(2)
    for text in ("ab" * 20000, " " * 30000 + "x", "".join(rng.choices("abcdefgh", k=30000)), "中" * 20000, "'" * 9999 + "s"):
        assert coder.encode(text) == coder.enc.encode_ordinary(text)


def test_tokens_that_merging_does_not_reach(tmp_path):
    """A token without a way to it by merges is found for a piece of its own, not inside a longer one."""
    import base64

    ranks = [bytes([b]) for b in range(256)] + [b"ab", b"bc", b"xyz", b"abc"]
    path = tmp_path / "ranks"
    path.write_bytes(b"".join(base64.b64encode(t) + b" %d\n" % i for i, t in enumerate(ranks)))
    coder = bpe_tree.TreeCoder(str(path), public_tokenizers.PATTERN, 3, 1)
    rng = random.Random(3)
    for _ in range(1500):
        text = "".join(rng.choices(["a", "b", "c", "xyz", "x", " "], weights=[3, 3, 3, 3, 1, 1], k=rng.randint(0, 40)))
        assert coder.encode(text) == coder.enc.encode_ordinary(text), text


def test_op11_rows(spark):
    texts = [None, "", "a", "word " * 5000, "x" * 40000, "<|endoftext|> a", "same text", "same text", "é中 'tis 1a"]
    got = by_id(bpe_tree.encode_texts(docs_of(spark, texts), vocabulary_path(RANKS), public_tokenizers.PATTERN))
    enc = bpe_tree.TreeCoder(vocabulary_path(RANKS), public_tokenizers.PATTERN).enc
    for i, text in enumerate(texts):
        ids = enc.encode_ordinary(text or "")
        assert got[i] == {
            "doc_id": i, "n_tokens": len(ids), "ids": ids, "ids_sha256": sha256(" ".join(map(str, ids)).encode()).hexdigest(),
            "decoded_sha256": sha256((text or "").encode()).hexdigest(),
        }
    assert bpe_tree.encode_texts(docs_of(spark, []), vocabulary_path(RANKS), public_tokenizers.PATTERN).collect() == []


def test_op11_query(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    got = by_id(op11_byte_bpe(spark, "/root/testdata/sf0.001"))
    enc = bpe_tree.TreeCoder(vocabulary_path(RANKS), public_tokenizers.PATTERN).enc
    for r in rows:
        ids = enc.encode_ordinary(r.text or "")
        assert (got[r.doc_id]["n_tokens"], got[r.doc_id]["ids_sha256"]) == (len(ids), sha256(" ".join(map(str, ids)).encode()).hexdigest())


# runs


def plain_runs(w, times=4, least=6):
    n, out = len(w), []
    for q in range(1, n // times + 1):
        s = 0
        while s + q < n:
            e = s
            while e + q < n and w[e] == w[e + q]:
                e += 1
            m = e + q - s
            if m >= max(least, times * q) and not any(all(w[i] == w[i + p] for i in range(s, s + m - p)) for p in range(1, q)):
                out.append((s, m, q))
            s = e + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def some_words(rng, most=70):
    n, signs = rng.randint(0, most), rng.choice([1, 2, 3, 5])
    w = [rng.randrange(signs) for _ in range(n)]
    if n and rng.random() < 0.7:
        a, p = rng.randrange(n), rng.randint(1, 9)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)] + [rng.randrange(signs) for _ in range(rng.randint(0, 9))]
    return w


def test_runs_by_definition():
    rng = random.Random(9)
    for _ in range(4000):
        w, times = some_words(rng), rng.choice([4, 4, 5])
        assert periodic_runs.runs(np.array(w, np.int64), times=times) == plain_runs(w, times), w


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=90))
def test_runs_of_any_words(w):
    assert periodic_runs.runs(np.array(w, np.int64)) == plain_runs(w)


def test_fewer_periods_are_refused():
    with pytest.raises(ValueError):
        periodic_runs.runs(np.zeros(9, np.int64), times=3)


def by_contract(doc_id, text):
    words = [w for w in (text or "").replace("\t", " ").replace("\n", " ").replace("\x0b", " ").replace("\x0c", " ").replace("\r", " ").split(" ") if w]
    n, h = len(words), crc32(str(doc_id).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = plain_runs(words)
    gone = {i for s, m, q in found for i in range(s + q, s + m)}
    best = min(found, key=lambda r: (-r[1], r[0], r[2])) if found else None
    return {
        "doc_id": doc_id, "n_runs": len(found), "start": best and best[0], "length": best and best[1], "period": best and best[2],
        "exponent_milli": best and 1000 * best[1] // best[2],
        "runs_sha256": sha256("".join(f"{s},{m},{q}\n" for s, m, q in found).encode()).hexdigest(),
        "collapsed_sha256": sha256(" ".join(w for i, w in enumerate(words) if i not in gone).encode()).hexdigest(),
    }


def test_op13_query(spark, tmp_path):
    rng = random.Random(10)
    texts = [None, "", " \x85 ", "a " * 900, "one\x0btwo three"] + [" ".join(map(str, some_words(rng, 40))) for _ in range(300)]
    docs_of(spark, texts).write.parquet(f"{tmp_path}/documents.parquet")
    got = by_id(op13_periodic_runs(spark, str(tmp_path)))
    assert got == {i: by_contract(i, t) for i, t in enumerate(texts)}


def test_op13_driver_table(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    got = by_id(op13_periodic_runs(spark, "/root/testdata/sf0.001"))
    short = [r for r in rows if len((r.text or "").split()) < 900]
    assert len(short) > 150
    for r in short:
        assert got[r.doc_id] == by_contract(r.doc_id, r.text)


def test_op13_rows(spark):
    texts = ["x x x x x x x y", None, "x x x x x x x y"]
    got = by_id(periodic_runs.find_runs(docs_of(spark, texts)))
    assert got[0]["runs"] == [{"start": 0, "length": 7, "period": 1}] and got[0]["collapsed"] == "x y"
    assert {k: v for k, v in got[2].items() if k != "doc_id"} == {k: v for k, v in got[0].items() if k != "doc_id"}
    assert (got[1]["n_words"], got[1]["runs"], got[1]["collapsed"], got[1]["start"]) == (0, [], "", None)
    assert periodic_runs.find_runs(docs_of(spark, [])).collect() == []
    nulls = spark.createDataFrame([(None, "a b " * 20)], "doc_id long, text string")
    assert periodic_runs.find_runs(nulls, change=periodic_runs.planted).collect()[0]["doc_id"] is None

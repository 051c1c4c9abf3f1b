import random

import numpy as np
import xxhash

from granary.llm import golay, simhash
from granary.llm.components import connected
from llm_help import by_id, docs_of


def slow_fingerprint(text):
    import re

    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not w:
        return 0
    shingles = [" ".join(w[i:i + 4]) for i in range(max(1, len(w) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(fps):
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 4:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


def test_golay_keys_meet_within_four_bits():
    rng, rnd = np.random.default_rng(5), random.Random(5)
    a = rng.integers(0, 2**64, 3000, dtype=np.uint64, endpoint=False)
    a[:3] = (0, 2**64 - 1, 1)
    b = a.copy()
    for i in range(len(b)):
        for bit in rnd.sample(range(64), 4):
            b[i] ^= np.uint64(1 << bit)
    for x, y in zip(golay.keys(a).tolist(), golay.keys(b).tolist()):
        assert set(x) & set(y)


def test_golay_decodes_to_the_nearest_codeword():
    parity, _, _ = golay._tables()
    words = np.array([m << 11 | int(parity[m]) for m in range(4096)], np.int64)
    assert min(int(w).bit_count() for w in words[1:]) == 7
    rnd = random.Random(1)
    for _ in range(300):
        m = rnd.randrange(4096)
        v = int(words[m])
        for bit in rnd.sample(range(23), rnd.randint(0, 3)):
            v ^= 1 << bit
        assert golay.decode(np.array([v]))[0] == m


def test_components_match_brute_force(spark):
    rnd = random.Random(8)
    base = [" ".join(rnd.choice("abcdefgh") * rnd.randint(1, 3) for _ in range(60)) for _ in range(6)]
    texts = [None, "", " \n\t", "One two", "one  TWO", "É é", "word"]
    texts += base + [base[0]] * 30  # a third of all rows is one text
    for b in base:
        for _ in range(10):
            w = b.split()
            w[rnd.randrange(len(w))] = "zz"
            texts.append(" ".join(w))
    fps = [slow_fingerprint(t) for t in texts]
    want = slow_components(fps)
    got = by_id(simhash.components(docs_of(spark, texts)))
    for i in range(len(texts)):
        assert got[i]["fp"] % 2**64 == fps[i]
        assert got[i]["component_id"] == want[i]


def test_chains_of_links_and_dense_groups(spark):
    """Fingerprints a few bits apart in chains, and a dense ball, given directly."""
    rnd = random.Random(2)
    fps, x = set(), 0x0F0F_1234_5678_9ABC
    for _ in range(40):
        for bit in rnd.sample(range(64), 3):
            x ^= 1 << bit
        fps.add(x)
    center = 0xDEAD_BEEF_0123_4567
    fps |= {center ^ sum(1 << b for b in rnd.sample(range(64), rnd.randint(0, 5))) for _ in range(300)}
    fps |= {rnd.getrandbits(64) for _ in range(300)} | {0, 1, 2**64 - 1}
    fps = sorted(fps)
    rows = [(int(np.uint64(f).astype(np.int64)),) for f in fps]
    got = {r["fp"] % 2**64: r["root"] for r in simhash.fingerprint_components(spark.createDataFrame(rows, "fp long").repartition(4)).collect()}
    want = slow_components(fps)
    classes = {}
    for f, w in zip(fps, want):
        assert classes.setdefault(w, got[f]) == got[f]
    assert len(set(classes.values())) == len(classes)


def test_keep_one_keeps_the_columns(spark):
    d = docs_of(spark, ["a b c d e", "a b c d e", None, "other words stand here now"])
    out = simhash.keep_one(d.unionAll(d))
    assert out.columns == d.columns
    assert sorted(r["doc_id"] for r in out.collect()) == [0, 2, 3]
    assert simhash.keep_one(d.limit(0)).collect() == []


def test_null_ids(spark):
    d = spark.createDataFrame([(None, "p q r s t"), (3, "p q r s t"), (None, "alone in the world here")], "doc_id long, text string")
    got = sorted((str(r["doc_id"]), str(r["component_id"])) for r in simhash.components(d).collect())
    assert got == [("3", "3"), ("None", "3"), ("None", "None")]
    assert sorted(str(r["doc_id"]) for r in simhash.keep_one(d).collect()) == ["3", "None"]


def test_keep_one_counts_rows_not_ids(spark):
    """Ids that are null, or shared by different texts, lose no component; nulls in other places are other rows."""
    schema = "doc_id long, text string, lang string, source string"
    rows = [(None, "p q r s t", "en", "s"), (3, "p q r s t", "en", "s")]
    rows += [(None, f"text number {i} stands here alone {i * i}", "en", "s") for i in range(6)] * 2
    rows += [(5, "one text of the id five", None, "s"), (5, "quite another one with this id", None, "s")] * 3
    rows += [(8, None, "word", "s"), (8, "word", None, "s")]
    got = sorted(r["text"] or "" for r in simhash.keep_one(spark.createDataFrame(rows, schema).repartition(3)).collect())
    assert got == sorted({r[1] or "" for r in rows})


def test_connected_components(spark):
    edges = [(1, 2), (2, 3), (5, 4), (4, 6), (9, 9), (7, 1)] + [(100, i) for i in range(101, 160)] + [(i, i + 1) for i in range(200, 240)]
    got = {r["node"]: r["root"] for r in connected(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {1: 1, 2: 1, 3: 1, 7: 1, 4: 4, 5: 4, 6: 4} | {i: 100 for i in range(100, 160)} | {i: 200 for i in range(200, 241)}
    assert got == want
    assert connected(spark.createDataFrame([], "a long, b long")).collect() == []

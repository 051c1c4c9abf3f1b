import random
import re

from granary.llm import licenses
from llm_help import by_id, docs_of

PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}


def brute(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    places, labels = [], set()
    for phrase, label in PHRASES.items():
        p = phrase.split()
        for i in range(len(words) - len(p) + 1):
            if words[i:i + len(p)] == p:
                places.append(i)
                labels.add(label)
    return (len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels)))


def test_base_matches_brute_force(spark):
    rnd = random.Random(4)
    bits = ["GNU General Public License", "Apache-License", "CC BY", "cc-by-nc 4.0", "MIT License", "mit", "license", "cc cc by by",
            "Éa", "x1", " ", "\n", ".", "the", "gnugeneral public license", "Licensed under the Apache License, Version 2.0"]
    texts = [None, "", "  ..  ", "mit license " * 3000] + [
        rnd.choice([" ", ", "]).join(rnd.choice(bits) for _ in range(rnd.randint(0, 30))) for _ in range(150)]
    got = by_id(licenses.scan(docs_of(spark, texts)))
    for i, t in enumerate(texts):
        r = got[i]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == brute(t), t
        assert 0.0 <= r["score"] <= 1.0
        assert set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(","))


def test_rules_are_many_and_suppress_what_they_contain(spark):
    assert len(licenses.rules()) > 300
    texts = [
        "This work is licensed under the GNU General Public License, version 3.",
        "Released under CC BY-NC 4.0", "SPDX-License-Identifier: Apache-2.0", "gnu lesser general public license v2.1 or later",
        "nothing here", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    ]
    got = by_id(licenses.scan(docs_of(spark, texts)))
    labels = [got[i]["labels"] for i in range(len(texts))]
    assert labels == ["gpl,gpl-3", "cc-by,cc-by-nc-4.0", "apache-2.0", "lgpl-2.1", "", "mit"]
    assert [got[i]["score"] for i in range(len(texts))] == [0.95, 0.95, 1.0, 0.85, 0.0, 0.95]


def samples(pattern, rnd):
    """A text that the pattern matches, with random alternatives."""
    from re import _constants as c, _parser

    def draw(nodes):
        out = ""
        for op, arg in nodes:
            if op is c.LITERAL:
                out += chr(arg)
            elif op is c.IN:
                kind, value = arg[0]
                out += "7" if kind is c.CATEGORY else "x" if kind is c.NEGATE else chr(rnd.choice(arg)[1])
            elif op is c.NOT_LITERAL:
                out += "x"
            elif op is c.BRANCH:
                out += draw(rnd.choice(arg[1]))
            elif op is c.SUBPATTERN:
                out += draw(arg[3])
            elif op in (c.MAX_REPEAT, c.MIN_REPEAT):
                out += "".join(draw(arg[2]) for _ in range(rnd.randint(arg[0], min(arg[1], arg[0] + 1))))
            else:
                assert op is c.ASSERT_NOT, op
        return out

    return draw(_parser.parse(pattern))


def test_matches_of_each_rule_hold_its_keyword(spark):
    rnd = random.Random(9)
    gate = re.compile(licenses._gate([r[0] for r in licenses.rules()]))
    for key, _, label, rx in licenses.rules():
        for text in {samples(rx, rnd) for _ in range(40)}:
            assert re.search(licenses._whole(rx), text), (rx, text)
            assert key in f" {text} " and gate.search(text), (key, text)
    texts = ["under the Q Public License here", "the FreeBSD license", "Microsoft Public License", "Licensed under the Microsoft Public License (Ms-PL)."]
    got = by_id(licenses.scan(docs_of(spark, texts)))
    assert [got[i]["labels"] for i in range(4)] == ["qpl", "bsd-2-clause", "ms-pl-1", "ms-pl-1"]
    assert [got[i]["score"] for i in range(4)] == [0.6, 0.85, 0.85, 0.95]


def test_no_python_in_the_plan_and_empty_table(spark):
    df = licenses.scan(docs_of(spark, ["mit license"]).limit(0))
    assert df.collect() == []
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_repeated_rows_repeat(spark):
    d = docs_of(spark, ["mit license"])
    assert licenses.scan(d.unionAll(d)).count() == 2

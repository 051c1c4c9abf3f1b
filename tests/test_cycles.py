"""Strongly connected components and circuits against plain search; long shapes in few checkpoints."""

import random

import pytest

from granary.operators import graph


def edges_of(spark, pairs):
    return spark.createDataFrame([(str(a), str(b)) for a, b in pairs], "source_district string, target_district string")


def plain_cycles(pairs):
    after = {}
    for a, b in {(str(a), str(b)) for a, b in pairs}:
        after.setdefault(a, []).append(b)
    found = []

    def grow(root, path):
        for b in after.get(path[-1], []):
            if b == root:
                found.append(tuple(path))
            elif b > root and b not in path:
                grow(root, [*path, b])

    for a in sorted(after):
        grow(a, [a])
    return sorted(found)


def test_cycles_by_plain_search(spark):
    rng = random.Random(11)
    pairs = []
    for part in range(3):  # separate random parts, some with chains hung into them
        n = rng.randint(3, 7)
        pairs += [(f"{part}n{rng.randrange(n)}", f"{part}n{rng.randrange(n)}") for _ in range(rng.randint(3, 11))]
        a, b = f"{part}n{rng.randrange(n)}", f"{part}n{rng.randrange(n)}"
        chain = [a, *[f"{part}c{i}" for i in rng.sample(range(9), 4)], b]
        pairs += list(zip(chain, chain[1:]))
    pairs += [("r3", "r1"), ("r1", "r2"), ("r2", "r3"), ("s", "s"), ("t", "u")]
    for per_task in (graph.TASK_COMPONENT, 0):
        got = sorted(tuple(r["cycle"]) for r in graph.simple_cycles(edges_of(spark, pairs), per_task=per_task).collect())
        assert got == plain_cycles(pairs)


def test_circuits_of_one_component():
    """Random small graphs, parallel paths between the same two nodes included."""
    for seed in range(200):
        rng = random.Random(seed)
        n = rng.randint(2, 6)
        edges = {(str(a), str(b)) for a, b in ((rng.randrange(n), rng.randrange(n)) for _ in range(rng.randint(1, 14))) if a != b}
        got = list(graph._circuits([(a, b, [b]) for a, b in edges]))
        assert sorted(map(tuple, got)) == plain_cycles(edges)
    got = sorted(map(tuple, graph._circuits([("a", "b", ["x", "b"]), ("a", "b", ["y", "b"]), ("b", "a", ["a"]), ("b", "a", ["z", "a"])])))
    assert got == [("a", "x", "b"), ("a", "x", "b", "z"), ("a", "y", "b"), ("a", "y", "b", "z")]


def test_long_shapes_take_few_rounds(spark, monkeypatch):
    """A ladder of 1000 rungs without circuits, 1000 rings and a ladder of 60 rungs with 1830 circuits."""
    pairs = [(f"u{i:04}", f"u{i + 1:04}") for i in range(999)] + [(f"v{i:04}", f"v{i + 1:04}") for i in range(999)]
    pairs += [(f"u{i:04}", f"v{i:04}") for i in range(1000)]
    pairs += [(f"r{k:04}{i}", f"r{k:04}{(i + 1) % 3}") for k in range(1000) for i in range(3)]
    pairs += [(f"a{i:02}", f"a{i + 1:02}") for i in range(59)] + [(f"b{i + 1:02}", f"b{i:02}") for i in range(59)]
    pairs += [(f"a{i:02}", f"b{i:02}") for i in range(60)] + [(f"b{i:02}", f"a{i:02}") for i in range(60)]
    rounds = []
    kept = graph._checkpoint
    monkeypatch.setattr(graph, "_checkpoint", lambda df: rounds.append(1) or kept(df))
    got = [tuple(r["cycle"]) for r in graph.simple_cycles(edges_of(spark, pairs)).collect()]
    assert len(got) == len(set(got)) == 1000 + 60 + 60 * 59 // 2
    assert sum(c[0].startswith("r") for c in got) == 1000 and max(map(len, got)) == 120
    assert len(rounds) < 60


def test_components_by_rounds_over_the_cluster(spark):
    pairs = [("b", "c"), ("c", "d"), ("d", "b"), ("d", "e"), ("e", "f"), ("f", "e"), ("a", "b"), ("f", "g")]
    e = edges_of(spark, pairs).toDF("src", "tgt")
    for small in (0, graph.SMALL_CORE):
        got = {(r["node"], r["component"]) for r in graph.components(e, small).collect()}
        assert got == {("b", "b"), ("c", "b"), ("d", "b"), ("e", "e"), ("f", "e")}


def test_no_cycles(spark):
    assert graph.simple_cycles(edges_of(spark, [("a", "b"), ("b", "c")])).collect() == []
    assert graph.simple_cycles(edges_of(spark, [])).collect() == []


def test_longer_circuits_are_refused(spark):
    with pytest.raises(RuntimeError):
        graph.simple_cycles(edges_of(spark, [("a", "b"), ("b", "c"), ("c", "a")]), max_length=2).collect()

"""Lineage graph as node and edge DataFrames; cycle and quality checks."""

from __future__ import annotations

import itertools

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.session import scratch_path

CIRCULAR = "CIRCULAR_LINEAGE"
MISSING_YEAR = "MISSING_YEAR"


def graph_nodes(edges: DataFrame, seq: list[str]) -> DataFrame:
    """Distinct districts; attributes from the first edge touching the node,
    the source end checked before the target end (first writer wins).

    ``min_by`` is a partial aggregate, so a node touched by a third of all
    edges is still reduced map-side."""
    ends = edges.select(
        F.explode(F.array(
            F.struct(F.col("source_district").alias("node"), F.lit(0).alias("pos"), *[F.col(c) for c in seq],
                     "state", "source"),
            F.struct(F.col("target_district").alias("node"), F.lit(1).alias("pos"), *[F.col(c) for c in seq],
                     "state", "source"),
        )).alias("e")
    ).select("e.*")
    order = F.struct(*[F.col(c) for c in seq], F.col("pos"))
    return ends.groupBy("node").agg(F.min_by(F.struct("state", "source"), order).alias("a")).select(
        F.col("node").alias("district"), "a.state", "a.source"
    )


def graph_edges(edges: DataFrame, seq: list[str]) -> DataFrame:
    """One edge per (source, target); the last row's attributes win."""
    order = F.struct(*[F.col(c) for c in seq])
    return edges.groupBy("source_district", "target_district").agg(
        F.max_by(F.struct("event_type", "effective_year", "source"), order).alias("a")
    ).select("source_district", "target_district", "a.event_type", "a.effective_year", "a.source")


def _checkpoint(df: DataFrame) -> DataFrame:
    """The rows written to the shared folder and read again: cuts the lineage of
    an iteration, so no round works out the one before again.

    A table and not ``checkpoint()``, which keeps the plan's estimated size: a
    join's estimate is the product of its sides', so the digits of it would
    double with each round of pointer doubling, until planning never ends."""
    spark = df.sparkSession
    path = scratch_path(spark, "graph")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: up to so many edges (drawn together) one task labels the components; beyond it rounds over the cluster do
SMALL_CORE = 1_000_000
#: components with so many nodes on their edges or fewer are searched for circuits in one task each
TASK_COMPONENT = 10_000
#: circuits leave a task in batches of about so many nodes
_BATCH_NODES = 100_000


def _chains(e: DataFrame) -> DataFrame:
    """Edges (src, tgt) with ``chain``, the first inner node of the unbranched path that the edge belongs to, or
    ``ring``, the least node of the closed ring of inner nodes; both NULL for an edge between other nodes.

    An inner node has one edge in and one out. Each points at its predecessor
    while that is an inner node too; pointers double until they stand still,
    so a path of n edges takes log2(n) rounds, and in each fewer nodes move than
    before. On a ring they never do; once a round changes no least node there,
    each has looked all around.
    """
    into = e.groupBy("tgt").agg(F.count(F.lit(1)).alias("n_in"), F.min("src").alias("pred"))
    out = e.groupBy("src").agg(F.count(F.lit(1)).alias("n_out"))
    inner = into.where("n_in = 1").join(out.where("n_out = 1"), F.col("tgt") == F.col("src")).select(F.col("tgt").alias("node"), "pred")
    names = inner.select(F.col("node").alias("pred"), F.lit(True).alias("inner"))
    first = inner.join(names, "pred", "left").select(
        "node", F.when(F.col("inner"), F.col("pred")).otherwise(F.col("node")).alias("up"), F.col("node").alias("least"))
    up = _checkpoint(first.withColumn("moved", F.lit(True)))
    before = -1
    n = up.count()
    for _ in range(n.bit_length() + 1 if n else 0):
        step = up.select(F.col("node").alias("up"), F.col("up").alias("over"), F.col("least").alias("other"))
        up = _checkpoint(up.join(step, "up").select(
            "node", F.col("over").alias("up"), F.least("least", "other").alias("least"), (F.col("over") != F.col("up")).alias("moved"),
            (F.col("other") < F.col("least")).alias("less")))
        moved, less = up.where("moved").agg(F.count(F.lit(1)), F.count_if("less")).first()
        if not moved or (moved == before and not less):
            break
        before = moved
    # the edge out of an inner node, and the edge into a path's first node, belong to the path
    chain, ring = F.when(~F.col("moved"), F.col("up")), F.when(F.col("moved"), F.col("least"))
    by_src = up.select(F.col("node").alias("src"), chain.alias("chain_out"), ring.alias("ring"))
    by_tgt = up.select(F.col("node").alias("tgt"), chain.alias("chain_in"))
    return e.join(by_src, "src", "left").join(by_tgt, "tgt", "left").select(
        "src", "tgt", F.coalesce("chain_out", "chain_in").alias("chain"), "ring")


def _drawn(e: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(``e`` with its chains and rings, the edges that are left when each chain is one edge: src, tgt, chain)."""
    marked = _checkpoint(_chains(e))
    whole = marked.where(F.col("chain").isNull() & F.col("ring").isNull()).select("src", "tgt", F.lit(None).cast("string").alias("chain"))
    inside = marked.where(F.col("chain").isNotNull())
    starts = inside.join(inside.select(F.col("tgt").alias("src"), "chain"), ["src", "chain"], "left_anti").select("src", "chain")
    ends = inside.join(inside.select(F.col("src").alias("tgt"), "chain"), ["tgt", "chain"], "left_anti").select("tgt", "chain")
    open_ = starts.join(ends, "chain").select("src", "tgt", "chain")
    # a chain from a node back to itself starts nowhere: the edge into its first inner node tells the node
    closed = inside.join(starts, "chain", "left_anti").where(F.col("tgt") == F.col("chain")).select("src", F.col("src").alias("tgt"), "chain")
    return marked, _checkpoint(whole.unionByName(open_).unionByName(closed))


def _label_small(batches):
    """Strongly connected components of all the edges, by one depth-first search with its own stack."""
    edges = pd.concat([b for b in batches] or [pd.DataFrame({"src": [], "tgt": []})])
    after: dict = {}
    for a, b in zip(edges["src"], edges["tgt"]):
        after.setdefault(a, []).append(b)
        after.setdefault(b, [])
    order: dict = {}
    low: dict = {}
    held: list = []
    label: dict = {}
    for root in after:
        if root in order:
            continue
        work = [(root, iter(after[root]))]
        order[root] = low[root] = len(order)
        held.append(root)
        while work:
            node, rest = work[-1]
            for nxt in rest:
                if nxt not in order:
                    order[nxt] = low[nxt] = len(order)
                    held.append(nxt)
                    work.append((nxt, iter(after[nxt])))
                    break
                if nxt not in label:
                    low[node] = min(low[node], order[nxt])
            else:
                work.pop()
                if work:
                    low[work[-1][0]] = min(low[work[-1][0]], low[node])
                if low[node] == order[node]:
                    members = []
                    while not members or members[-1] != node:
                        members.append(held.pop())
                    label.update(dict.fromkeys(members, min(members)))
    yield pd.DataFrame({"node": list(label), "component": list(label.values())}, dtype="object")


def _spread_labels(start: DataFrame, edges: DataFrame, column: str) -> DataFrame:
    """(node, label): the least label that comes to a node along ``edges`` (src, tgt)."""
    now = _checkpoint(start)
    while True:
        over = edges.join(now.select(F.col("node").alias("src"), F.col(column).alias("other")), "src").groupBy("tgt").agg(F.min("other").alias("other"))
        new = _checkpoint(now.join(over.withColumnRenamed("tgt", "node"), "node", "left").select(
            "node", F.least(column, "other").alias(column), (F.col("other") < F.col(column)).alias("moved")))
        if new.where("moved").isEmpty():
            return new.drop("moved")
        now = new.drop("moved")


def components(edges: DataFrame, small: int = SMALL_CORE) -> DataFrame:
    """(node, component) of the strongly connected components with an edge inside, named by their least node.

    Nodes without an edge in or out are cut off first. What is left is labelled
    by one task if it has at most ``small`` edges. Beyond that, rounds over the
    cluster: the least name that reaches a node colours it, what reaches back to
    the name inside its colour is a component, and the rest goes round again.
    """
    e = edges.select("src", "tgt").distinct()
    found = None
    while True:
        left = e.count()
        while True:  # cut off ends while that takes a tenth away
            into, out = e.select(F.col("tgt").alias("src")).distinct(), e.select(F.col("src").alias("tgt")).distinct()
            e = _checkpoint(e.join(into, "src", "left_semi").join(out, "tgt", "left_semi"))
            now = e.count()
            if not now or now > 0.9 * left:
                break
            left = now
        if not now:
            break
        if now <= small:
            new = e.coalesce(1).mapInPandas(_label_small, "node string, component string")
        else:
            nodes = e.select(F.col("src").alias("node")).union(e.select("tgt")).distinct()
            colour = _spread_labels(nodes.select("node", F.col("node").alias("component")), e, "component")
            same = e.join(colour.select(F.col("node").alias("src"), "component"), "src").join(
                colour.select(F.col("node").alias("tgt"), F.col("component").alias("other")), "tgt").where("component = other")
            back = _checkpoint(same.select(F.col("tgt").alias("src"), F.col("src").alias("tgt")))
            # 0 at the namesake spreads backwards inside each colour
            seen = _spread_labels(colour.select("node", (F.col("node") != F.col("component")).cast("int").alias("far")), back, "far")
            new = seen.where("far = 0").join(colour, "node").select("node", "component")
        new = _checkpoint(new)
        found = new if found is None else found.unionByName(new)
        if now <= small:
            break
        e = _checkpoint(e.join(new.select(F.col("node").alias("src")), "src", "left_anti").join(new.select(F.col("node").alias("tgt")), "tgt", "left_anti"))
    if found is None:
        return e.select(F.col("src").alias("node"), F.col("tgt").alias("component"))
    return found


def cyclic_core(edges: DataFrame, small: int = SMALL_CORE) -> DataFrame:
    """Distinct (src, tgt) pairs that lie on a cycle: those inside a strongly connected component.

    Unbranched paths are first drawn together into one edge each, so neither a
    long chain nor many separate rings take rounds of their own. An empty
    result proves the graph acyclic."""
    e = _checkpoint(edges.select(F.col("source_district").alias("src"), F.col("target_district").alias("tgt")).distinct())
    marked, g = _drawn(e)
    names = components(g, small)
    inside = _checkpoint(g.join(names.select(F.col("node").alias("src"), "component"), "src").join(
        names.select(F.col("node").alias("tgt"), F.col("component").alias("other")), "tgt").where("component = other"))
    stay = inside.where(F.col("chain").isNotNull()).select("chain").distinct()
    plain = inside.where(F.col("chain").isNull()).select("src", "tgt")
    chained = marked.where(F.col("chain").isNotNull()).join(stay, "chain", "left_semi").select("src", "tgt")
    return _checkpoint(plain.unionByName(chained).unionByName(marked.where(F.col("ring").isNotNull()).select("src", "tgt")))


def _walk(edges: pd.DataFrame) -> pd.DataFrame:
    """The nodes of one chain or ring in order; a ring starts at its least node."""
    after = dict(zip(edges["src"], edges["tgt"]))
    starts = set(after) - set(edges["tgt"])
    name = edges["chain"].iloc[0]
    node = name if pd.isna(edges["head"].iloc[0]) else edges["head"].iloc[0]
    node = starts.pop() if starts else node
    nodes = [node]
    for _ in range(len(edges)):
        node = after[node]
        nodes.append(node)
    return pd.DataFrame({"chain": [name], "nodes": [nodes]})


def _circuits(edges):
    """Nodes of each circuit of one component's (src, tgt, step), from its least node on.

    Depth-first from each root through greater nodes; a node that led to no
    circuit stays blocked until one it waits for is free again, so between two
    circuits each edge is looked at a bounded number of times."""
    after: dict = {}
    for src, tgt, step in edges:
        after.setdefault(src, []).append((tgt, step))
    for root in sorted(after):
        blocked, waiting, path = {root}, {}, []
        work = [[root, iter(after[root]), False]]
        while work:
            frame = work[-1]
            for nxt, step in frame[1]:
                if nxt == root:
                    frame[2] = True
                    yield [root, *(n for s in path for n in s), *step[:-1]]
                elif nxt > root and nxt not in blocked:
                    blocked.add(nxt)
                    path.append(step)
                    work.append([nxt, iter(after.get(nxt, ())), False])
                    break
            else:
                work.pop()
                if frame[2]:
                    free = [frame[0]]
                    while free:
                        node = free.pop()
                        if node in blocked:
                            blocked.discard(node)
                            free += waiting.pop(node, ())
                else:
                    for nxt, _ in after.get(frame[0], ()):
                        waiting.setdefault(nxt, set()).add(frame[0])
                if work:
                    path.pop()
                    work[-1][2] |= frame[2]


def _component_circuits(max_length: int | None):
    """Circuits of each component of the rows (component, src, tgt, step), which come sorted by component."""
    def run(batches):
        held: list = []
        out: list = []
        nodes = 0
        rows = (r for b in batches for r in b.itertuples(index=False, name=None))
        for row in itertools.chain(rows, [None]):
            if held and (row is None or row[0] != held[0][0]):
                for cycle in _circuits([(r[1], r[2], list(r[3])) for r in held]):
                    out.append(cycle)
                    nodes += len(cycle)
                    if nodes > _BATCH_NODES:
                        yield pd.DataFrame({"cycle": out})
                        out, nodes = [], 0
                    if max_length is not None and len(cycle) > max_length:
                        break  # the caller fails on it
                held = []
            held.append(row)
        yield pd.DataFrame({"cycle": out}, dtype="object")

    return run


def simple_cycles(edges: DataFrame, max_length: int | None = None, small: int = SMALL_CORE,
                  per_task: int = TASK_COMPONENT) -> DataFrame:
    """Every elementary circuit (self-loops included), each reported once as
    an array of nodes starting at its smallest node.

    Only edges inside strongly connected components count. A component that is
    one ring is walked as it is (its circuit is a result row of its nodes). In
    the others, unbranched paths are one edge. Components of at most
    ``per_task`` nodes on their edges are searched each in one task, many side by
    side, so the number of rounds doesn't grow with their length. In larger ones
    paths grow by one edge per round from each node, only through nodes greater
    than that and not yet on the path, closing where an edge leads back. The
    number of circuits can be exponential in the core size; ``max_length`` bounds
    the length and the call fails (never truncates) if a longer circuit or an
    open path remains.
    """
    every = _checkpoint(edges.select(F.col("source_district").alias("src"), F.col("target_district").alias("tgt")).distinct())
    loops = every.where(F.col("src") == F.col("tgt")).select(F.array("src").alias("cycle"))
    marked, g = _drawn(every.where(F.col("src") != F.col("tgt")))
    closed = g.where(F.col("src") == F.col("tgt")).select("chain", F.col("src").alias("head"))
    between = g.where(F.col("src") != F.col("tgt"))
    names = components(between, small)
    inside = _checkpoint(between.join(names.withColumnRenamed("node", "src"), "src").join(
        names.select(F.col("node").alias("tgt"), F.col("component").alias("other")), "tgt").where("component = other").drop("other"))
    # only chains on a circuit are walked: each is part of a result row
    stay = inside.where(F.col("chain").isNotNull()).select("chain").unionByName(closed.select("chain")).distinct()
    named = marked.where(F.col("chain").isNotNull()).join(stay, "chain", "left_semi").select("src", "tgt", "chain").unionByName(
        marked.where(F.col("ring").isNotNull()).select("src", "tgt", F.col("ring").alias("chain")))
    walks = _checkpoint(named.join(closed, "chain", "left").groupBy("chain").applyInPandas(_walk, "chain string, nodes array<string>"))
    rings = walks.join(marked.where(F.col("ring").isNotNull()).select(F.col("ring").alias("chain")).distinct(), "chain", "left_semi")
    self_closed = closed.join(walks, "chain").select(F.slice("nodes", 2, F.size("nodes") - 1).alias("step"))
    # an edge's step: the nodes after its source
    e = _checkpoint(inside.join(walks, "chain", "left").select(
        "component", "src", "tgt", F.coalesce(F.slice("nodes", 2, F.size("nodes") - 1), F.array("tgt")).alias("step")))
    light = _checkpoint(e.groupBy("component").agg(F.sum(F.size("step")).alias("nodes")).where(F.col("nodes") <= per_task).select("component"))
    searched = _checkpoint(e.join(light, "component").select("component", "src", "tgt", "step").repartition("component")
                           .sortWithinPartitions("component").mapInPandas(_component_circuits(max_length), "cycle array<string>"))
    e = e.join(light, "component", "left_anti").drop("component")
    paths = e.where(F.col("tgt") > F.col("src")).select(
        F.col("src").alias("root"), F.col("tgt").alias("last"), F.array("src", "tgt").alias("ends"), F.concat(F.array("src"), "step").alias("nodes"))
    found = [rings.select(F.slice("nodes", 1, F.size("nodes") - 1).alias("cycle")), self_closed.select(F.col("step").alias("cycle")), searched]
    closing = e.select(F.col("src").alias("last"), F.col("tgt").alias("root"), "step")
    steps = e.select(F.col("src").alias("last"), F.col("tgt").alias("next"), "step")
    paths = _checkpoint(paths)
    while not paths.isEmpty():
        found.append(paths.join(closing, ["root", "last"]).select(F.concat("nodes", F.slice("step", 1, F.size("step") - 1)).alias("cycle")))
        longer = paths.join(steps, "last").where((F.col("next") > F.col("root")) & ~F.array_contains(F.col("ends"), F.col("next")))
        longer = longer.select("root", F.col("next").alias("last"), F.array_append("ends", F.col("next")).alias("ends"), F.concat("nodes", "step").alias("nodes"))
        paths = _checkpoint(longer)
        if max_length is not None and not paths.where(F.size("nodes") > max_length).isEmpty():
            raise RuntimeError(f"open paths remain at max_length={max_length}; refusing to truncate cycles")
    out = loops
    for f in found:
        out = out.unionByName(f)
    if max_length is not None and not out.where(F.size("cycle") > max_length).isEmpty():
        raise RuntimeError(f"circuits longer than max_length={max_length}; refusing to truncate cycles")
    at = F.array_position("cycle", F.array_min("cycle")).cast("int")
    return out.select(F.concat(F.slice("cycle", at, F.size("cycle")), F.slice("cycle", F.lit(1), at - 1)).alias("cycle"))


def quoted(c) -> F.Column:
    """A text as Python prints it inside a list: single quotes, or double ones if it holds a single
    quote and no double one; backslashes and, where needed, single quotes are escaped."""
    safe = F.replace(c, F.lit("\\"), F.lit("\\\\"))
    single = F.concat(F.lit("'"), F.replace(safe, F.lit("'"), F.lit("\\'")), F.lit("'"))
    return F.when(c.contains("'") & ~c.contains('"'), F.concat(F.lit('"'), safe, F.lit('"'))).otherwise(single)


def cycle_text(cycle) -> F.Column:
    """Python list text of a cycle: ['a', 'b']."""
    return F.concat(F.lit("["), F.array_join(F.transform(cycle, quoted), ", "), F.lit("]"))


def cycle_issues(edges: DataFrame, max_length: int | None = None) -> DataFrame:
    return simple_cycles(edges, max_length).select(
        F.lit(CIRCULAR).alias("issue_type"), cycle_text(F.col("cycle")).alias("details")
    )


def missing_year(edges: DataFrame) -> DataFrame:
    """Edges without a year -> "src -> tgt"."""
    return edges.where(F.col("effective_year").isNull()).select(
        F.lit(MISSING_YEAR).alias("issue_type"),
        F.concat(F.col("source_district"), F.lit(" -> "), F.col("target_district")).alias("details"),
    )


def quality_report(edges: DataFrame, max_length: int | None = None) -> DataFrame:
    """Cycles followed by missing years, as (issue_type, details)."""
    return cycle_issues(edges, max_length).unionByName(missing_year(edges))


def node_link(nodes: DataFrame, edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Node-link form: node rows ``{id, district, state, source}`` and link
    rows ``{source, target, event_type, effective_year, source_document}``."""
    n = nodes.select(F.col("district").alias("id"), "district", "state", "source")
    links = edges.select(
        F.col("source_district").alias("source"), F.col("target_district").alias("target"),
        "event_type", "effective_year", F.col("source").alias("source_document"),
    )
    return n, links

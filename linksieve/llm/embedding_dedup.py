"""Near-duplicate embeddings with a robust-pruned flat graph.

1. Equal vectors are one node with a count. Centroids are fitted on a bounded sample, and every
   node is a member of the cluster shards of its ``overlap`` nearest centroids. A shard of more
   than ``SHARD`` members is dealt by hash into several, each a graph of its own.
2. In each shard a graph is built: from a node's nearest members, nearest first, a neighbour is
   kept unless one kept before is ``ALPHA`` times nearer to it than the node is. Links go both ways.
3. A node's adjacency lists from all its shards are united.
4. Every node is searched for in the shards of its nearest centroid, by the united lists: greedily
   from the shard's medoid, from one entry of every part that the medoid does not reach and from the
   node's own row, then on through every neighbour near the range until it is exhausted.
5. What is found is verified by cosine in double precision. Counts of the disjoint shards of a
   cluster add up; links become components.
6. A sample of nodes is audited against brute force over all rows, in blocks. Recall is the share of
   their links found, or the mean share of a node if that is less. If it is below ``LEAST_RECALL``,
   the same shards are compared exactly, in blocks of rows and queries, and then, while it still is,
   those of twice the overlap. With an overlap of all clusters that is every row with every other.

Vectors are compared with those of the same number of components. Null and zero vectors, and those
with null or non-finite components, are linked with nothing; nor are rows without id, whose
component is null. Rows that share id and vector are copies, and count as links of each other. An
empty table gives an empty result.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linksieve.llm.components import components
from linksieve.llm.texts import column
from linksieve.session import checkpointed

COSINE = 0.9

#: Rows that centroids are fitted on, members of a shard, the most centroids, first overlap.
SAMPLE = 20_000
SHARD = 4_000
CENTROIDS = 2_048
OVERLAP = 4

#: Candidates and neighbours of a node, how much nearer prunes, and the search's beam.
CANDIDATES = 64
DEGREE = 20
ALPHA = 1.2
BEAM = 32

#: Neighbours this far below the range are still walked through.
MARGIN = 0.08

#: Nodes audited, and the least share of their links to be found.
AUDITED = 256
LEAST_RECALL = 0.97

NODE = "node {id}, copies long, unit binary"


def unit_vector(values) -> bytes | None:
    """The vector at length one, as doubles; None if it has no direction."""
    if values is None or any(v is None for v in values):
        return None
    vector = np.array(values, np.float64)
    most = np.abs(vector).max(initial=0.0)
    if not np.isfinite(most) or most == 0 or np.isnan(vector).any():
        return None
    vector /= most
    return (vector / np.sqrt(vector @ vector)).tobytes()


def nodes_of(df: DataFrame, vector: str, key: str) -> DataFrame:
    """``node`` (smallest id), ``copies`` and ``unit`` of every distinct vector that can be linked."""
    classes = (
        df.filter(column(key).isNotNull() & column(vector).isNotNull())
        .groupBy(column(vector).alias("vector"))
        .agg(F.min(column(key)).alias("node"), F.count("*").alias("copies"))
    )
    key_type = df.schema[key].dataType.simpleString()

    def run(batches):
        for batch in batches:
            units = pa.array([unit_vector(v) for v in batch.column("vector").to_pylist()], pa.binary())
            columns = [batch.column("node"), batch.column("copies"), units]
            yield pa.RecordBatch.from_arrays(columns, names=["node", "copies", "unit"]).filter(units.is_valid())

    return classes.mapInArrow(run, NODE.format(id=key_type))


def fit_centroids(nodes: DataFrame, count: int) -> dict[int, np.ndarray]:
    """Unit centroids per vector size, from the ``SAMPLE`` nodes whose ids hash lowest."""
    rows = nodes.orderBy(F.xxhash64("node"), "node").limit(SAMPLE).select("unit").collect()
    by_size: dict[int, list] = {}
    for row in rows:
        by_size.setdefault(len(row.unit), []).append(np.frombuffer(row.unit))
    found = {}
    for size, vectors in by_size.items():
        sample = np.array(vectors)
        wanted = max(1, min(CENTROIDS, len(sample), -(-count * len(sample) // (len(rows) * SHARD // OVERLAP))))
        centroids = sample[:wanted].copy()
        for _ in range(8):
            nearest = np.argmax(sample @ centroids.T, axis=1)
            for c in range(wanted):
                members = sample[nearest == c]
                if len(members) and (length := np.linalg.norm(total := members.sum(axis=0))) > 0:
                    centroids[c] = total / length
        found[size] = centroids
    return found


def memberships(nodes: DataFrame, centroids: dict[int, np.ndarray], overlap: int, exact: bool) -> DataFrame:
    """A row per node and shard's cluster: ``cluster`` string, ``home`` whether it is the nearest.

    If ``exact``, vectors of a size with no more clusters than the overlap are one cluster.
    """
    shared = nodes.sparkSession.sparkContext.broadcast({k: v.tobytes() for k, v in centroids.items()})
    schema = nodes.schema.simpleString()[len("struct<") : -1].replace(":", " ")

    def run(batches):
        table = {k: np.frombuffer(v).reshape(-1, k // 8) for k, v in shared.value.items()}
        for batch in batches:
            rows, clusters, home = [], [], []
            for i, unit in enumerate(batch.column("unit").to_pylist()):
                if len(unit) not in table or exact and overlap >= len(table[len(unit)]):
                    # one cluster: the sample has not this size, or all would be in all
                    nearest = [0]
                else:
                    near = table[len(unit)] @ np.frombuffer(unit)
                    nearest = np.argsort(-near, kind="stable")[:overlap]
                rows += [i] * len(nearest)
                clusters += [f"{len(unit)}-{c}" for c in nearest]
                home += [True] + [False] * (len(nearest) - 1)
            part = batch.take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [*part.columns, pa.array(clusters, pa.string()), pa.array(home, pa.bool_())],
                names=[*batch.schema.names, "cluster", "home"],
            )

    return nodes.mapInArrow(run, f"{schema}, cluster string, home boolean")


def pruned_graph(vectors: np.ndarray) -> list[np.ndarray]:
    """Adjacency lists by robust pruning of every vector's nearest ones, with links back."""
    count = len(vectors)
    wanted = min(CANDIDATES, count - 1)
    out = [np.empty(0, np.int64)] * count
    if wanted < 1:
        return out
    back: list[list] = [[] for _ in range(count)]
    for start in range(0, count, 256):
        block = np.arange(start, min(start + 256, count))
        near = vectors[block] @ vectors.T
        near[np.arange(len(block)), block] = -np.inf
        chosen = np.argpartition(-near, wanted - 1, axis=1)[:, :wanted]
        values = np.take_along_axis(near, chosen, axis=1)
        order = np.argsort(-values, axis=1, kind="stable")
        chosen, values = np.take_along_axis(chosen, order, axis=1), np.take_along_axis(values, order, axis=1)
        among = np.matmul(vectors[chosen], vectors[chosen].transpose(0, 2, 1))
        # distances on the sphere: |a - b|^2 = 2 - 2 a.b
        to_node, to_each = 2 - 2 * values, 2 - 2 * among
        alive, kept = np.ones(chosen.shape, bool), np.zeros(chosen.shape, bool)
        rows = np.arange(len(block))
        for _ in range(min(DEGREE, wanted)):
            best = np.argmax(alive, axis=1)  # nearest first
            some = alive[rows, best]
            kept[rows[some], best[some]] = True
            alive &= ~((ALPHA * ALPHA * to_each[rows, best] <= to_node) & some[:, None])
            alive[rows, best] = False
            if not alive.any():
                break
        for i, node in enumerate(block):
            out[node] = chosen[i, kept[i]]
            for other, value in zip(chosen[i, kept[i]], values[i, kept[i]]):
                back[other].append((value, node))
    return [
        np.unique(np.r_[own, [n for _, n in heapq.nlargest(2 * DEGREE, back[i])]]).astype(np.int64)
        for i, own in enumerate(out)
    ]


def build(members: DataFrame, key_type: str) -> DataFrame:
    """``node, neighbours`` from each shard."""

    def run(table: pa.Table) -> pa.Table:
        vectors = np.array([np.frombuffer(u) for u in table.column("unit").to_pylist()])
        nodes = table.column("node")
        lists = [nodes.take(pa.array(n)).to_pylist() for n in pruned_graph(vectors)]
        return pa.table({"node": nodes, "neighbours": pa.array(lists, pa.list_(nodes.type))})

    return members.groupBy("cluster", "part").applyInArrow(run, f"node {key_type}, neighbours array<{key_type}>")


def entries(vectors: np.ndarray, adjacent: list[np.ndarray]) -> np.ndarray:
    """The medoid, and a row of every part of the graph that those before do not reach."""
    reached = np.zeros(len(vectors), bool)
    found, start = [], int(np.argmax(vectors @ vectors.sum(axis=0)))
    while True:
        found.append(start)
        reached[start] = True
        open_rows = [start]
        while open_rows:
            around = adjacent[open_rows.pop()]
            fresh = around[~reached[around]]
            reached[fresh] = True
            open_rows += fresh.tolist()
        if reached.all():
            return np.array(found)
        start = int(np.argmin(reached))


def range_search(query: np.ndarray, vectors: np.ndarray, adjacent: list[np.ndarray], starts: np.ndarray) -> np.ndarray:
    """Rows of ``vectors`` within the range of ``query``: greedy descent from ``starts``, then expansion."""
    seen = np.zeros(len(vectors), bool)
    seen[starts] = True
    near = np.full(len(vectors), -2.0)
    near[starts] = vectors[starts] @ query
    queue, beam = list(zip((-near[starts]).tolist(), starts.tolist())), near[starts].tolist()
    heapq.heapify(queue)
    heapq.heapify(beam)
    width = BEAM + len(beam) - 1  # so that no start is crowded out by the others
    while queue:
        value, row = heapq.heappop(queue)
        value = -value
        if value < COSINE - MARGIN and len(beam) >= width and value < beam[0]:
            break  # outside the range, and the beam holds nearer ones only
        fresh = adjacent[row][~seen[adjacent[row]]]
        if not len(fresh):
            continue
        seen[fresh] = True
        values = vectors[fresh] @ query
        near[fresh] = values
        for other, v in zip(fresh.tolist(), values.tolist()):
            if len(beam) < width:
                heapq.heappush(beam, v)
            elif v > beam[0]:
                heapq.heapreplace(beam, v)
            elif v < COSINE - MARGIN:
                continue
            heapq.heappush(queue, (-v, other))
    return np.flatnonzero(near >= COSINE)


def search(members: DataFrame, key_type: str, exact: bool) -> DataFrame:
    """Per query and shard: ``node, n_links`` (copies of linked nodes), ``near`` (one per joined component).

    ``members`` has the united ``neighbours``, and the shard's queries as rows with ``query``. If
    ``exact``, the neighbours are not used: a query is compared with all rows.
    """

    def run(table: pa.Table) -> pa.Table:
        is_query = np.array(table.column("query").to_pylist(), bool)
        rows = table.filter(pa.array(~is_query))
        queries = table.filter(pa.array(is_query))
        nodes = rows.column("node").to_pylist()
        made = {"node": [], "n_links": [], "near": []}
        if nodes:
            vectors = np.array([np.frombuffer(u) for u in rows.column("unit").to_pylist()])
            copies = np.array(rows.column("copies").to_pylist(), np.int64)
            at = {node: i for i, node in enumerate(nodes)}
            if not exact:
                adjacent = [
                    np.array([at[n] for n in ns if n in at], np.int64) for ns in rows.column("neighbours").to_pylist()
                ]
                common = entries(vectors, adjacent)
            component = np.arange(len(nodes))
            for node, unit in zip(queries.column("node").to_pylist(), queries.column("unit").to_pylist()):
                query = np.frombuffer(unit)
                if exact:
                    found = np.flatnonzero(vectors @ query >= COSINE)
                else:
                    own = [at[node]] if node in at else []
                    starts = np.unique(np.r_[common, own]).astype(np.int64)
                    found = range_search(query, vectors, adjacent, starts)
                found = found[[nodes[i] != node for i in found]] if len(found) else found
                # links to nodes that other queries of the shard have joined already say nothing new
                roots = np.unique(component[found])
                near = [nodes[r] for r in roots]
                if len(roots) > 1:
                    component[np.isin(component, roots)] = roots[0]
                made["node"].append(node)
                made["n_links"].append(int(copies[found].sum()))
                made["near"].append(near)
        ends = rows.column("node").type
        return pa.table(
            {
                "node": pa.array(made["node"], ends),
                "n_links": pa.array(made["n_links"], pa.int64()),
                "near": pa.array(made["near"], pa.list_(ends)),
            }
        )

    return members.groupBy("cluster", "part", "block").applyInArrow(
        run, f"node {key_type}, n_links long, near array<{key_type}>"
    )


def true_links(nodes: DataFrame) -> DataFrame:
    """``node, true_links`` of the audited sample, by brute force over all rows in blocks."""
    sample = nodes.orderBy(F.xxhash64("node", F.lit(1)), "node").limit(AUDITED).select("node", "unit").collect()
    key_type = nodes.schema["node"].dataType.simpleString()
    shared = nodes.sparkSession.sparkContext.broadcast([(r.node, bytes(r.unit)) for r in sample])

    def run(batches):
        queries = shared.value
        counts = np.zeros(len(queries), np.int64)
        for batch in batches:
            by_size: dict[int, list] = {}
            for row in zip(*(batch.column(c).to_pylist() for c in ("node", "copies", "unit"))):
                by_size.setdefault(len(row[2]), []).append(row)
            for size, rows in by_size.items():
                vectors = np.array([np.frombuffer(u) for _, _, u in rows])
                copies = np.array([c for _, c, _ in rows], np.int64)
                for i, (node, unit) in enumerate(queries):
                    if len(unit) == size:
                        linked = vectors @ np.frombuffer(unit) >= COSINE
                        linked &= np.array([n != node for n, _, _ in rows]) if linked.any() else False
                        counts[i] += copies[linked].sum()
        yield pa.RecordBatch.from_pydict({"node": [n for n, _ in queries], "true_links": counts.tolist()})

    partial = nodes.mapInArrow(run, f"node {key_type}, true_links long")
    return partial.groupBy("node").agg(F.sum("true_links").alias("true_links"))


def found_links(nodes: DataFrame, centroids: dict[int, np.ndarray], overlap: int, exact: bool) -> DataFrame:
    """The rows of ``search`` over the shards of this overlap, by graph or ``exact``."""
    key_type = nodes.schema["node"].dataType.simpleString()
    members = checkpointed(memberships(nodes, centroids, overlap, exact))
    parts = members.groupBy("cluster").agg(F.ceil(F.count("*") / SHARD).alias("parts"))
    dealt = members.join(parts, "cluster").withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")))
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))
    no_list = F.lit(None).cast(f"array<{key_type}>").alias("neighbours")
    if exact:  # every block of queries meets every part of the rows
        rows = dealt.select(
            "cluster", "part", every.alias("block"), "node", "copies", "unit", no_list, F.lit(False).alias("query")
        )
        block = F.col("part").alias("block")
    else:
        lists = build(dealt.select("cluster", "part", "node", "unit"), key_type)
        united = lists.groupBy("node").agg(F.array_distinct(F.flatten(F.collect_list("neighbours"))).alias("neighbours"))
        block = F.lit(0).cast("long").alias("block")
        rows = dealt.join(united, "node").select(
            "cluster", "part", block, "node", "copies", "unit", "neighbours", F.lit(False).alias("query")
        )
    queries = dealt.filter("home").select(
        "cluster", every.alias("part"), block, "node", "copies", "unit", no_list, F.lit(True).alias("query")
    )
    return search(rows.unionByName(queries), key_type, exact)


def audited(truth: DataFrame, linked: DataFrame) -> float:
    """Recall of the audited nodes: of all their links, or of a node's on average if that is less."""
    least = F.least("true_links", F.coalesce("n_links", F.lit(0)))
    all_links, found, mean = (
        truth.filter("true_links > 0")
        .join(linked, "node", "left")
        .agg(F.sum("true_links"), F.sum(least), F.avg(least / F.col("true_links")))
        .first()
    )
    return min(found / all_links, mean) if all_links else 1.0


def deduplicate(df: DataFrame, vector: str = "embedding", key: str = "vec_id") -> DataFrame:
    """``key, n_links, component_id, kept`` and ``audited_recall`` for every row of ``df``."""
    nodes = checkpointed(nodes_of(df, vector, key))
    count = nodes.count()
    centroids = fit_centroids(nodes, count)
    most = max([len(c) for c in centroids.values()], default=1)
    truth = checkpointed(true_links(nodes))
    overlap, exact = OVERLAP, False
    while True:
        found = checkpointed(found_links(nodes, centroids, overlap, exact))
        linked = found.groupBy("node").agg(F.sum("n_links").alias("n_links"))
        recall = audited(truth, linked)
        if recall >= LEAST_RECALL or exact and overlap >= most:
            break
        if exact:
            overlap *= 2
        exact = True
    links = found.select(F.col("node").alias("a"), F.explode("near").alias("b"))
    named = nodes.join(linked, "node").join(components(links), "node", "left")
    named = named.select(
        "node",
        F.col("copies").alias("\x00copies"),
        F.col("n_links").alias("\x00links"),
        F.coalesce("component", "node").alias("\x00component"),
    )
    classes = (
        df.filter(column(key).isNotNull() & column(vector).isNotNull())
        .groupBy(column(vector).alias("\x00vector"))
        .agg(F.min(column(key)).alias("node"))
        .join(named, "node")
        .select("\x00vector", "\x00copies", "\x00links", "\x00component")
    )
    rows = df.select(column(key), column(vector)).join(classes, column(vector) == column("\x00vector"), "left")
    component = F.when(column(key).isNotNull(), F.coalesce(column("\x00component"), column(key)))
    return rows.select(
        column(key),
        F.when(column(key).isNull(), 0)
        .otherwise(F.coalesce(column("\x00links") + column("\x00copies") - 1, F.lit(0)))
        .cast("long")
        .alias("n_links"),
        component.alias("component_id"),
        column(key).eqNullSafe(component).alias("kept"),
        F.lit(recall).alias("audited_recall"),
    )

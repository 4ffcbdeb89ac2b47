"""Near-duplicate documents by min-max hashing.

A document is the set of its distinct word shingles. Under each of ``PERMUTATIONS`` hash functions
both the smallest and the largest value are kept, so a signature has two values for every hash
evaluated, and both agree between two sets with the probability of their Jaccard similarity. The
signature is cut into bands; documents that agree in a band are candidates.

Equal sets are one class and go on once. Candidates are joined to the smallest member of their
bucket and the links contracted to candidate groups; all pairs that a band may propose lie in one
group. Groups are confirmed on full sets: a group is split into blocks of bounded size, every pair
of blocks is one task's work, and within it a pair is compared unless both are known to be in one
component already. So no pair is emitted but links that join components, and none is dropped.

Texts: ASCII letters in lower case, words between ASCII white space; a text of fewer words than a
shingle is one shingle. Null and blank texts are empty sets and linked with nothing. Rows without
id are linked with nothing, their component is null. Rows that share an id are one document.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField

from linksieve.llm.components import components
from linksieve.llm.texts import column, text_columns
from linksieve.session import checkpointed

#: Hash functions; each gives a minimum and a maximum.
PERMUTATIONS = 72

#: The most likely share of pairs at the threshold that agree in no band.
MISSED = 2e-5

#: Shingles in a block of a group whose pairs one task compares.
BLOCK = 400_000

#: Values computed at a time, to bound the memory a long text takes.
AT_ONCE = 1 << 20


def band_rows(percent: int) -> int:
    """Values in a band: as many as leave ``MISSED`` of the pairs at the threshold or fewer."""
    values, rows = 2 * PERMUTATIONS, 1
    while (1 - (percent / 100) ** (rows + 1)) ** (values // (rows + 1)) <= MISSED:
        rows += 1
    return rows


def shingle_set(text: str | None, size: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of ``size`` words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    hashed = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    size = min(size, len(words))
    rolled = hashed[: len(words) - size + 1].copy()
    for shift in range(1, size):
        rolled *= np.uint64(0x9E3779B97F4A7C15)
        rolled ^= rolled >> np.uint64(32)
        rolled += hashed[shift : len(words) - size + 1 + shift]
    rolled *= np.uint64(0xC2B2AE3D27D4EB4F)
    rolled ^= rolled >> np.uint64(29)
    return np.unique(rolled)


def min_max_signature(shingles: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """Minimum and maximum of the set under each permutation, side by side."""
    found = np.empty((len(factors), 2), np.uint64)
    step = max(1, AT_ONCE // len(shingles))
    for start in range(0, len(factors), step):
        values = np.multiply.outer(factors[start : start + step], shingles)
        found[start : start + step, 0] = values.min(axis=1)
        found[start : start + step, 1] = values.max(axis=1)
    return found.ravel()


def _factors() -> np.ndarray:
    """Odd factors; a product with one permutes the 64-bit integers."""
    return np.random.default_rng(42).integers(0, 1 << 63, PERMUTATIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def signatures(df: DataFrame, text: str, keep: list[str], size: int, percent: int) -> DataFrame:
    """``keep``, ``n_shingles``, a digest of the set, and the keys of its bands, 8 bytes each."""

    def make():
        factors, rows = _factors(), band_rows(percent)
        bands = 2 * len(factors) // rows

        def row(t):
            shingles = shingle_set(t, size)
            if not len(shingles):
                return 0, b"", b""
            values = min_max_signature(shingles, factors)[: bands * rows].reshape(bands, rows)
            keys = b"".join([xxhash.xxh3_64_digest(v.tobytes(), seed=i) for i, v in enumerate(values)])
            return len(shingles), xxhash.xxh3_128_digest(shingles.tobytes()), keys

        return lambda texts: list(zip(*map(row, texts))) or [[]] * 3

    fields = [
        StructField("n_shingles", LongType()),
        StructField("digest", BinaryType()),
        StructField("bands", BinaryType()),
    ]
    return text_columns(df, make, fields, text, keep)


def candidate_groups(classes: DataFrame) -> DataFrame:
    """``node, component`` of classes (``node, bands``) that share a bucket with another."""
    band = F.explode(F.sequence(F.lit(0), (F.octet_length("bands") / 8 - 1).cast("int")))
    banded = classes.select("node", "bands", band.alias("band")).select(
        "node", F.expr("substring(bands, band * 8 + 1, 8)").alias("bucket")
    )
    heads = banded.groupBy("bucket").agg(F.min("node").alias("head"), F.count("*").alias("n")).filter("n > 1")
    links = banded.join(heads, "bucket").filter("node != head").select("node", "head")
    return components(links, "node", "head")


def link_block(nodes: list, sides: np.ndarray, sets: list[np.ndarray], percent: int) -> list[tuple]:
    """Links that join components: between the two sides, or within if there is one side only."""
    count = len(nodes)
    sizes = np.array([len(s) for s in sets], np.int64)
    starts = np.r_[0, np.cumsum(sizes)[:-1]]
    tokens = np.unique(np.concatenate(sets), return_inverse=True)[1]
    component = np.arange(count)
    first_of: dict = {}
    for i, node in enumerate(nodes):  # rows that share an id are in one component
        component[i] = first_of.setdefault(tuple(node.values()) if isinstance(node, dict) else node, i)
    across = len(np.unique(sides)) > 1
    marked = np.zeros(int(tokens.max()) + 1, bool)
    links = []
    for i in range(count):
        open_rows = component != component[i]
        open_rows &= (sides != sides[i]) if across else (np.arange(count) > i)
        open_rows &= (100 * sizes >= percent * sizes[i]) & (100 * sizes[i] >= percent * sizes)
        if not open_rows.any():
            continue
        own = tokens[starts[i] : starts[i] + sizes[i]]
        marked[own] = True
        shared = np.add.reduceat(marked[tokens], starts, dtype=np.int64)
        marked[own] = False
        linked = np.flatnonzero(open_rows & (100 * shared >= percent * (sizes + sizes[i] - shared)))
        for j in linked:
            if component[j] != component[i]:
                links.append((nodes[i], nodes[j]))
                component[component == component[j]] = component[i]
    return links


def confirmed_links(members: DataFrame, percent: int) -> DataFrame:
    """Links ``a, b`` of ``members``: ``node, component, blocks, shingles`` (bytes)."""
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), (F.col("blocks") - 1).cast("int")))
    dealt = members.withColumn("own", own).withColumn("other", other)
    dealt = dealt.select(
        "node", "component", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "shingles"
    )
    key = members.schema["node"].dataType.simpleString()

    def confirm(table: pa.Table) -> pa.Table:
        nodes = table.column("node").to_pylist()
        sets = [np.frombuffer(s, np.uint64) for s in table.column("shingles").to_pylist()]
        links = link_block(nodes, table.column("own").to_numpy(), sets, percent)
        ends = table.schema.field("node").type
        return pa.table({"a": pa.array([a for a, _ in links], ends), "b": pa.array([b for _, b in links], ends)})

    return dealt.groupBy("component", "i", "j").applyInArrow(confirm, f"a {key}, b {key}")


def deduplicate(df: DataFrame, text: str = "text", key: str = "doc_id", size: int = 5, percent: int = 80) -> DataFrame:
    """``key``, ``n_shingles``, ``component_id`` (smallest id of the group) and ``kept``."""
    docs = df.select(column(key).alias("node"), column(text).alias("text"))
    signed = checkpointed(signatures(docs, "text", ["node"], size, percent))
    classes = checkpointed(
        signed.filter("n_shingles > 0 AND node IS NOT NULL")
        .groupBy("digest")
        .agg(F.min("node").alias("node"), F.first("n_shingles").alias("n_shingles"), F.first("bands").alias("bands"))
    )
    groups = candidate_groups(classes).join(classes.select("node", "n_shingles"), "node")
    sizes = groups.groupBy("component").agg(F.ceil(F.sum("n_shingles") / BLOCK).alias("blocks"))
    members = docs.join(groups.select("node", "component").distinct().join(sizes, "component"), "node")

    def make():
        return lambda texts: [[shingle_set(t, size).tobytes() for t in texts]]

    shingled = text_columns(
        members, make, [StructField("shingles", BinaryType())], "text", ["node", "component", "blocks"]
    ).filter(F.octet_length("shingles") > 0)
    found = components(confirmed_links(shingled, percent))
    # ids of one class, and what their class is linked with
    label = classes.select("digest", "node").join(found, "node", "left")
    label = label.select(F.col("digest"), F.coalesce("component", "node").alias("component"))
    named = signed.join(label, "digest", "left").withColumn(
        "component", F.when(F.col("node").isNotNull(), F.coalesce("component", "node"))
    )
    return named.select(
        F.col("node").alias(key),
        "n_shingles",
        F.col("component").alias("component_id"),
        F.col("node").eqNullSafe(F.col("component")).alias("kept"),
    )


def keep_one(df: DataFrame, text: str = "text", key: str = "doc_id", size: int = 5, percent: int = 80) -> DataFrame:
    """All columns of ``df``; of each group of near-duplicates the row with the smallest id.

    A document is an id and a text: rows that share both are copies, of which one stays, and rows
    that share the id only are near-duplicates of each other only if their texts are. Rows without
    id all stay.
    """
    identity = F.struct(column(key).alias("id"), F.md5(column(text).cast("string").cast("binary")).alias("text"))
    copies = df.filter(column(key).isNotNull()).withColumn("\x00document", identity)
    documents = copies.dropDuplicates(["\x00document"])  # aggregated before they are shuffled
    groups = deduplicate(documents.select("\x00document", column(text)), text, "\x00document", size, percent)
    kept = groups.filter("kept").select(column("\x00document").alias("\x00kept"))
    first = documents.join(kept, column("\x00document") == column("\x00kept"), "left_semi").drop("\x00document")
    return first.unionByName(df.filter(column(key).isNull()))

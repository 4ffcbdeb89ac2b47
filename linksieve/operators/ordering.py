"""Exact-size random selections without sorting the table.

Rows get a fixed pseudo-random order: by the md5 of a salt and a unique key. A
selection of the first k rows per label in that order is then the same thing as
a comparison with the k-th row, the *cut*. Cuts are found by narrowing down:

1. count rows per (label, hash prefix); the running counts tell which prefix
   holds each cut. While a prefix still has more rows than one task should rank,
   count its longer prefixes in the same way,
2. rank only the rows of those few prefixes.

After that, selecting is a plain filter against literals: no sort, join or shuffle
of the table, and it can be repeated on any later read of it. Keys are unique and
hashed, so prefixes are even whatever the data looks like: two scans do for tables
of up to 10^10 rows per label, three for 10^15.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linksieve.session import checkpointed

DIGEST_LENGTH = 32
# Hex digits added per narrowing step: 65,536 counts per label.
PREFIX_STEP = 4
# Rows of one prefix that one task may rank.
ROWS_PER_PREFIX = 500_000


def hash_key(key: Column, salt: str) -> Column:
    """Hex digest that fixes the place of a row; its length is the same for all rows."""
    return F.md5(F.concat(F.lit(f"{salt}|"), key))


@dataclass(frozen=True)
class Cuts:
    """For each label, the cut rows in ascending rank order.

    A cut is the digest of the last row inside, followed by its key, so that
    comparing strings compares digests first; ``None`` stands for rank 0.
    """

    key: str
    label: str | None
    salt: str
    per_label: dict[int, list[str | None]]
    sizes: dict[int, int] = field(default_factory=dict)

    def segment(self) -> Column:
        """Index of the segment a row falls in: the number of cuts it lies beyond."""
        place = F.concat(hash_key(F.col(self.key), self.salt), F.col(self.key))
        # every place lies beyond the empty string, which stands for rank 0
        cuts = {k: F.array(*[F.lit(c or "") for c in v]).cast("array<string>") for k, v in self.per_label.items()}
        if not cuts:
            return F.lit(None).cast("int")
        if self.label is None:
            own = cuts[0]
        else:
            pairs = [x for k, v in cuts.items() for x in (F.lit(k), v)]
            own = F.try_element_at(F.create_map(*pairs), F.col(self.label).cast("int"))
        return F.when(own.isNotNull(), F.size(F.filter(own, lambda cut: place > cut)))


def _prefix_counts(rows: DataFrame, within: DataFrame | None, digits: int) -> DataFrame:
    """``label, outer, prefix, n``: rows per prefix of ``digits``, inside given shorter ones."""
    known = digits - PREFIX_STEP
    rows = rows.withColumn("outer", F.substring("digest", 1, known))
    if within is not None:
        rows = rows.join(F.broadcast(within), ["label", "outer"], "left_semi")
    prefix = F.substring("digest", 1, digits)
    return rows.groupBy("label", "outer", prefix.alias("prefix")).agg(F.count(F.lit(1)).alias("n"))


def find_cuts(
    df: DataFrame,
    key: str,
    salt: str,
    ranks: Callable[[dict[int, int]], dict[int, list[int]]],
    label: str | None = None,
) -> Cuts:
    """Locate the rows at given ranks of the hash order, per label.

    ``key`` must be unique in ``df``: a key that repeats across a cut raises, as no
    cut then has the asked size. ``ranks`` gets the number of rows per label and
    returns ascending ranks per label. Rows without a label are in no segment.
    ``label`` is a class label; without it the whole table is one group (label 0).

    What reaches the driver is a size per label and a row per cut; what is broadcast
    are the cuts.
    """
    spark = df.sparkSession
    rows = df.select(
        (F.lit(0) if label is None else F.col(label).cast("int")).alias("label"),
        F.col(key).alias("key"),
        hash_key(F.col(key), salt).alias("digest"),
    ).filter("label IS NOT NULL")
    digits = PREFIX_STEP
    counts = checkpointed(_prefix_counts(rows, None, digits))
    counted = counts.groupBy("label").agg(F.sum("n").alias("n")).collect()
    sizes = {r["label"]: r["n"] for r in sorted(counted, key=lambda r: r["label"])}

    wanted = {lab: [min(k, sizes[lab]) for k in ks] for lab, ks in ranks(sizes).items()}
    # (label, rank, prefix the row lies in, its rank inside the prefix)
    targets = sorted({(lab, k, "", k) for lab, ks in wanted.items() for k in ks if k > 0})
    found = []
    while targets:
        asked = spark.createDataFrame(targets, "label int, rank long, outer string, nth long")
        ascending = Window.partitionBy("label", "outer").orderBy("prefix")
        before = F.col("upto") - F.col("n")
        hits = (
            counts.withColumn("upto", F.sum("n").over(ascending))
            .join(F.broadcast(asked), ["label", "outer"])
            .filter((F.col("nth") <= F.col("upto")) & (F.col("nth") > before))
            .select("label", "rank", "prefix", (F.col("nth") - before).alias("nth"), "n")
            .collect()
        )
        targets = [(h["label"], h["rank"], h["prefix"], h["nth"]) for h in hits]
        chosen = spark.createDataFrame(targets, "label int, rank long, outer string, nth long")
        within = chosen.select("label", "outer").distinct()
        if max(h["n"] for h in hits) > ROWS_PER_PREFIX and digits + PREFIX_STEP <= DIGEST_LENGTH:
            digits += PREFIX_STEP
            counts = _prefix_counts(rows, within, digits)
            continue
        ranked = Window.partitionBy("label", "outer").orderBy("digest", "key")
        found = (
            rows.withColumn("outer", F.substring("digest", 1, digits))
            .join(F.broadcast(within), ["label", "outer"], "left_semi")
            .withColumn("nth", F.row_number().over(ranked))
            .withColumn("again", F.coalesce(F.lead("key").over(ranked) == F.col("key"), F.lit(False)))
            .join(F.broadcast(chosen), ["label", "outer", "nth"])
            .select("label", "rank", F.concat("digest", "key").alias("cut"), "again")
            .collect()
        )
        if any(r["again"] for r in found):
            raise ValueError(f"column {key} repeats values; exact sizes need one row per value")
        break
    at = {(r["label"], r["rank"]): r["cut"] for r in found}
    cuts = {lab: [at[lab, k] if k > 0 else None for k in ks] for lab, ks in wanted.items()}
    return Cuts(key, label, salt, cuts, sizes)

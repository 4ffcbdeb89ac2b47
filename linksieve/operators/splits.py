"""Train / validation / test splits, samples and folds.

All are pure functions of the URL, the label counts and a seed: the same corpus
gives the same split on any cluster and in any row order. Input is a corpus of
unique URLs; as it is read several times, pass a stored table.
"""

from __future__ import annotations

import math
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linksieve.functions.lexicons import DEFAULT_LEXICONS
from linksieve.functions.strings import column
from linksieve.functions.suffixes import registered_domain
from linksieve.operators.ordering import Cuts, find_cuts
from linksieve.session import checkpointed

SEED = 42
TEST_PER_CLASS = 50_000
VALIDATION_FRACTION = 0.10
TUNING_ROWS = 150_000
CURVE_FRACTIONS = (0.10, 0.25, 0.50, 1.00)
FOLDS = 3
HELD_OUT_DOMAINS = 0.15


def proportional_quotas(sizes: dict[int, int], total: int) -> dict[int, int]:
    """Share ``total`` rows among labels by size, largest remainder first.

    Whole-number arithmetic, so no rounding depends on the machine; equal
    remainders go to the lower label.
    """
    rows = sum(sizes.values())
    if rows == 0:
        return dict.fromkeys(sizes, 0)
    quotas = {label: n * total // rows for label, n in sizes.items()}
    by_remainder = sorted(sizes, key=lambda label: (-(sizes[label] * total % rows), label))
    for label in by_remainder[: total - sum(quotas.values())]:
        quotas[label] += 1
    return quotas


def balanced_quota(sizes: dict[int, int], per_class: int, divisor: int = 1) -> int:
    """Rows per class of a balanced selection; 0 when a class is missing."""
    return min([per_class, *(sizes.get(label, 0) // divisor for label in (0, 1))])


def split_cuts(
    corpus: DataFrame,
    seed: int = SEED,
    test_per_class: int = TEST_PER_CLASS,
    validation_fraction: float = VALIDATION_FRACTION,
) -> Cuts:
    """L1 + L2. The cuts between test, validation and train rows of each label."""

    def ranks(sizes: dict[int, int]) -> dict[int, list[int]]:
        test = balanced_quota(sizes, test_per_class, divisor=2)
        # Only the two classes are balanced; another label has no test rows.
        in_test = {label: test if label in (0, 1) else 0 for label in sizes}
        rest = {label: n - in_test[label] for label, n in sizes.items()}
        left = sum(rest.values())
        train = proportional_quotas(rest, left - math.ceil(validation_fraction * left))
        return {
            label: [in_test[label], in_test[label] + rest[label] - train[label]] for label in sizes
        }

    return find_cuts(corpus, "url", f"split-{seed}", ranks, "label")


def make_splits(
    corpus: DataFrame,
    seed: int = SEED,
    test_per_class: int = TEST_PER_CLASS,
    validation_fraction: float = VALIDATION_FRACTION,
) -> DataFrame:
    """L1 + L2. ``corpus`` with a column ``split``: ``test``, ``val`` or ``train``.

    The test rows hold exactly as many URLs of each class,
    ``min(test_per_class, half of either class)``. Of the rest, a tenth (rounded
    up) is for validation, with the class ratio kept.
    """
    cuts = split_cuts(corpus, seed, test_per_class, validation_fraction)
    segment = cuts.segment()
    return corpus.withColumn(
        "split", F.when(segment == 0, "test").when(segment == 1, "val").when(segment == 2, "train")
    )


def stratified_sample(corpus: DataFrame, rows: int = TUNING_ROWS, seed: int = SEED) -> DataFrame:
    """L3. ``rows`` rows with the class ratio kept; everything if there are fewer."""

    def ranks(sizes: dict[int, int]) -> dict[int, list[int]]:
        quotas = proportional_quotas(sizes, min(rows, sum(sizes.values())))
        return {label: [quotas[label]] for label in sizes}

    cuts = find_cuts(corpus, "url", f"sample-{seed}", ranks, "label")
    if sum(cuts.sizes.values()) <= rows:
        return corpus
    return corpus.filter(cuts.segment() == 0)


def with_curve_step(
    corpus: DataFrame, fractions: tuple[float, ...] = CURVE_FRACTIONS, seed: int = SEED
) -> DataFrame:
    """L3. Column ``step``: index of the smallest fraction whose sample has the row.

    Samples are nested, so the sample of ``fractions[i]`` is ``step <= i``. Each
    holds ``int(fraction * rows)`` rows with the class ratio kept.
    """
    if list(fractions) != sorted(fractions):
        raise ValueError("fractions must ascend")

    def ranks(sizes: dict[int, int]) -> dict[int, list[int]]:
        total = sum(sizes.values())
        steps = [proportional_quotas(sizes, math.floor(f * total)) for f in fractions]
        return {label: [quotas[label] for quotas in steps] for label in sizes}

    cuts = find_cuts(corpus, "url", f"sample-{seed}", ranks, "label")
    return corpus.withColumn("step", cuts.segment())


def with_folds(corpus: DataFrame, folds: int = FOLDS, seed: int = SEED) -> DataFrame:
    """L4. Column ``fold`` in ``0..folds-1``; per label, fold sizes differ by one at most."""

    def ranks(sizes: dict[int, int]) -> dict[int, list[int]]:
        # The first n % folds folds take one row more, as ntile() does.
        return {
            label: [i * (n // folds) + min(i, n % folds) for i in range(1, folds)]
            for label, n in sizes.items()
        }

    cuts = find_cuts(corpus, "url", f"fold-{seed}", ranks, "label")
    return corpus.withColumn("fold", cuts.segment())


def raw_host_domain(url: str = "url", suffixes: Iterable[str] = DEFAULT_LEXICONS.suffixes) -> Column:
    """Registrable domain of the bare text of column ``url`` before the first slash.

    Port, user info and query are not cut off, and addresses are treated like
    names: ``a.com:80`` is a domain of its own and ``1.2.3.4`` belongs to ``3.4``.
    """
    return F.expr(registered_domain(f"substring_index({column(url)}, '/', 1)", suffixes))


def domain_disjoint_split(
    corpus: DataFrame,
    seed: int = SEED,
    held_out_fraction: float = HELD_OUT_DOMAINS,
    test_per_class: int = TEST_PER_CLASS,
    domain: Column | None = None,
    suffixes: Iterable[str] = DEFAULT_LEXICONS.suffixes,
) -> DataFrame:
    """L5. ``corpus`` with ``domain`` and ``split``: ``train``, ``test`` or ``unused``.

    A share of all domains is held out; their rows are balanced to the test set
    and what is left of them is ``unused``. Train holds all other domains. Whether
    a domain is held out follows from its own hash, so the rows, a third of which
    may share one domain, are neither joined nor shuffled by domain.
    """
    with_domain = corpus.withColumn("domain", raw_host_domain(suffixes=suffixes) if domain is None else domain)
    # Written out, as it is read again for each narrowing of the cut.
    domains = checkpointed(with_domain.select("domain").distinct())
    held_out = find_cuts(
        domains, "domain", f"domain-{seed}",
        lambda sizes: {0: [int(sizes.get(0, 0) * held_out_fraction)]},
    )
    is_held_out = held_out.segment() == 0

    def ranks(sizes: dict[int, int]) -> dict[int, list[int]]:
        return {label: [balanced_quota(sizes, test_per_class)] for label in sizes if label in (0, 1)}

    test = find_cuts(with_domain.filter(is_held_out), "url", f"split-{seed}", ranks, "label")
    in_test = F.coalesce(test.segment() == 0, F.lit(False))
    return with_domain.withColumn(
        "split", F.when(~is_held_out, "train").when(in_test, "test").otherwise("unused")
    )

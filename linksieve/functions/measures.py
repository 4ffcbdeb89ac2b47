"""Measures over the single characters of a URL, vectorised over Arrow batches.

Built-in functions can only count characters through arrays of one-character strings or
back-references, which took nearly half of the feature stage. A batch of strings as one array of
code points needs a handful of passes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

MEASURES = ("domain_entropy", "url_entropy", "longest_consecutive_run")

#: Characters counted in a table with a column for each; beyond so many in a batch, pairs are sorted.
ASCII, WIDEST = 128, 256


def character_measures(text: str, domain: str) -> Column:
    """A struct of ``MEASURES`` from two non-null string columns.

    Entropy is Shannon's, in bits, 0 for an empty string. The longest run is that of one repeated
    character; line feeds do not count.
    """

    def laid_out(strings: pa.Array):
        """Code points of all strings in a row, the string of each, and how many each has."""
        _, offsets, data = strings.buffers()
        wide = np.int64 if pa.types.is_large_string(strings.type) else np.int32
        ends = np.frombuffer(offsets, wide)[strings.offset : strings.offset + len(strings) + 1]
        raw = data[int(ends[0]) : int(ends[-1])].to_pybytes() if data is not None and len(strings) else b""
        if raw.isascii():
            codes, lengths = np.frombuffer(raw, np.uint8), np.diff(ends)
        else:
            text = raw.decode("utf-8", "surrogatepass")
            codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
            first_bytes = (np.frombuffer(raw, np.uint8) & 0xC0) != 0x80
            lengths = np.diff(np.r_[0, np.cumsum(first_bytes)][ends - ends[0]])
        return codes, np.repeat(np.arange(len(strings)), lengths), lengths

    def entropy(codes, row, lengths):
        # log2(n) - sum(k * log2 k) / n over the counts k of the distinct characters
        width, symbols = ASCII, codes.astype(np.int64)
        if len(codes) and codes.max() >= ASCII:  # characters beyond ASCII are numbered: a batch has few
            beyond = codes >= ASCII
            rare, numbers = np.unique(codes[beyond], return_inverse=True)
            symbols[beyond] = ASCII + numbers
            width += len(rare)
        if width <= WIDEST:
            counts = np.bincount(row * width + symbols, minlength=width * len(lengths))
            of = None
        else:
            keys, counts = np.unique(row * width + symbols, return_counts=True)
            of = keys // width
        k = np.arange(counts.max(initial=0) + 1)
        weighted = (k * np.log2(np.maximum(k, 1)))[counts]
        sums = weighted.reshape(-1, width).sum(axis=1) if of is None else np.bincount(of, weighted, len(lengths))
        n = np.maximum(lengths, 1)
        return np.where(lengths > 0, np.log2(n) - sums / n, 0.0)

    def longest_run(codes, row, lengths):
        longest = np.zeros(len(lengths))
        if len(codes):
            starts = np.flatnonzero(np.r_[True, (codes[1:] != codes[:-1]) | (row[1:] != row[:-1])])
            runs = np.diff(np.r_[starts, len(codes)])
            counted = codes[starts] != 10
            starts, runs = starts[counted], runs[counted]
            if len(starts):
                first = np.flatnonzero(np.r_[True, row[starts[1:]] != row[starts[:-1]]])
                longest[row[starts[first]]] = np.maximum.reduceat(runs, first)
        return longest

    @F.arrow_udf(", ".join(f"{name} double" for name in MEASURES))
    def measured(texts: pa.Array, domains: pa.Array) -> pa.Array:
        whole = laid_out(texts)
        values = entropy(*laid_out(domains)), entropy(*whole), longest_run(*whole)
        return pa.StructArray.from_arrays(list(map(pa.array, values)), names=list(MEASURES))

    return measured(text, domain)

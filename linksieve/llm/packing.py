"""Best-fit packing of token sequences by exact-complement hashing.

Every document becomes its ids and one end id; only documents longer than a sequence are
cut. How many pieces there are of each length is a table of at most ``capacity`` rows, and
the plan is made on it alone:

1. Exact stage. From the longest length down, the gap beside a piece is looked up among the
   sums of one, two and three available lengths. A combination that fills the gap exactly is
   used as often as its counts allow, which empties at least one length.
2. Best fit. What is left goes, longest first, into the open sequence with the smallest gap
   that is large enough, again for many equal pieces at once.

The plan is a list of patterns (lengths of a sequence, how often). Pieces then get their rank
within their length, and the rank decides pattern, sequence and offset. Ranks are counted in
``SALTS`` parts of a length, so a length that most pieces share is no single group.

Null text is an empty document: only the end id. Repeated rows and ids are packed each for
itself. An empty table gives an empty result.
"""

from __future__ import annotations

import gc
import json
import re
from array import array
from bisect import bisect_left, insort
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, BinaryType, LongType, StructField, StructType
from tokenizers import Tokenizer

from linksieve.llm.bpe import NOT_SPACE, VOCABULARY, byte_symbols
from linksieve.llm.texts import column, remembered, text_columns
from linksieve.session import checkpointed

CAPACITY = 4096

#: The id that closes a document.
END = 1

#: Parts in which the ranks of one length are counted.
SALTS = 16

#: Words, and pieces between white space, that a generation of an encoder's memory holds; longer ones
#: are forgotten with their batch.
REMEMBERED, LONGEST = 200_000, 64

#: All but the printable characters of Latin-1, which are composed already and of one case and class under
#: every Unicode version.
UNUSUAL = re.compile("[^!-~\u00a1-\u00ac\u00ae-\u00ff]")

#: Documents encoded at a time, where their ids are carried along and where only checksums go on: the more,
#: the fewer of their pieces are distinct, and the more memory a worker takes.
CARRIED, DOCUMENTS = 1024, 4096

# Stands for the end of a piece; no id of a vocabulary.
_END_MARK = 0xFFFFFFFF
_MARK = _END_MARK.to_bytes(4, "little")


class LibraryEncoder:
    """Ids by the tokenizers library's model, words remembered.

    Arrow splits a batch of texts and numbers its distinct pieces, so Python sees each piece of a batch
    once. All pieces are cut into words in one go, with line feeds between them, and only words that are
    new reach the model. Arrow then puts the ids of the pieces in the order of the texts. Nine in ten
    pieces of a large batch were not in the one before, so only those that took a way of their own are
    remembered.
    """

    def __init__(self, path: str):
        tokenizer = Tokenizer.from_file(path)
        self.tokenizer, self.model = tokenizer, tokenizer.model
        self.normalizer, self.splitter = tokenizer.normalizer, tokenizer.pre_tokenizer
        self.special = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
        with open(path, encoding="utf-8") as file:
            (pattern,) = (
                step["pattern"]["Regex"]
                for step in json.load(file)["pre_tokenizer"]["pretokenizers"]
                if step["type"] == "Split"
            )
        self.pattern = regex.compile(f"{pattern}|\n")
        self.symbols = byte_symbols()
        self.words: dict[str, bytes] = {"\n": _MARK}
        self.pieces: dict[str, bytes] = {"": b""}
        self.older_words: dict[str, bytes] = {}
        self.older_pieces: dict[str, bytes] = {}

    def _word(self, symbols: str) -> bytes:
        return array("I", [t.id for t in self.model.tokenize(symbols)]).tobytes()

    def _learn_words(self, words: set[str]) -> list[str]:
        """Have the ids of ``words`` in ``words``; returns those too long to stay."""
        if len(self.words) >= REMEMBERED:  # what is in use moves on, the rest is forgotten
            self.words, self.older_words = {"\n": _MARK}, self.words
        known, older = self.words, self.older_words
        new = words.difference(known)
        for word in new:
            if (found := older.get(word)) is None:
                plain = word if word.isascii() else "".join(map(self.symbols.__getitem__, word.encode()))
                found = self._word(plain)
            known[word] = found
        return [w for w in new if len(w) > LONGEST]

    def _together(self, pieces: list[str]) -> pa.Array:
        """Ids of pieces of usual characters, which need no normalizer but lower case."""
        found = self.pattern.findall("\n".join([*pieces, ""]).lower())
        long = self._learn_words(set(found))
        ids = np.frombuffer(b"".join(map(self.words.__getitem__, found)), np.uint32)
        for word in long:  # strings of any length would make the memory unbounded, although their number is bounded
            del self.words[word]
        marks = ids == _END_MARK
        ends = np.flatnonzero(marks) - np.arange(len(pieces))
        return _binary(ids[~marks], np.r_[0, ends])

    def _alone(self, pieces: list[str]) -> list[bytes]:
        """Ids of pieces of any characters, each by the library's normalizer and splitter."""
        if len(self.pieces) >= REMEMBERED:
            self.pieces, self.older_pieces = {"": b""}, self.pieces
        made = []
        for piece in pieces:
            if (ids := self.older_pieces.get(piece)) is None:
                split = self.splitter.pre_tokenize_str(self.normalizer.normalize_str(piece))
                ids = b"".join([self._word(symbols) for symbols, _ in split])
            if len(piece) <= LONGEST:
                self.pieces[piece] = ids
            made.append(ids)
        return made

    def _whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of whole texts as little-endian unsigned 32-bit integers."""
        texts = [t or "" for t in texts]
        odd = [NOT_SPACE.search(t) is not None or any(s in t for s in self.special) for t in texts]
        # Arrow's white space is Python's; a text that begins or ends with some gets an empty piece there
        split = pc.utf8_split_whitespace(pa.array(["" if o else t for t, o in zip(texts, odd)], pa.string()))
        coded = split.flatten().dictionary_encode()
        pieces = coded.dictionary.to_pylist()
        own = list(map(self.pieces.get, pieces))  # ids of pieces that go a way of their own
        usual = [ids is None for ids in own]
        gc.disable()  # the model's many small results hold no cycles, and looking for them takes half of the time
        try:
            if UNUSUAL.search("".join(pieces)):
                alone = [i for i, p in enumerate(pieces) if usual[i] and UNUSUAL.search(p)]
                for i, ids in zip(alone, self._alone([pieces[i] for i in alone])):
                    own[i], usual[i] = ids, False
            together = self._together([p for p, u in zip(pieces, usual) if u])
        finally:
            gc.enable()
        # the place of every distinct piece: first those encoded together, then the others
        usual = np.array(usual, bool)
        place = np.where(usual, np.cumsum(usual) - 1, len(together) + np.cumsum(~usual) - 1)
        distinct = pa.concat_arrays([together, pa.array([ids for ids in own if ids is not None], pa.large_binary())])
        ordered = distinct.take(pa.array(place[coded.indices.to_numpy()], pa.int64()))
        ids, ends = _contents(ordered)
        cuts = ends[split.offsets.to_numpy()].tolist()
        return [self._whole(t) if o else ids[i:j] for t, o, i, j in zip(texts, odd, cuts, cuts[1:])]


def _binary(ids: np.ndarray, ends: np.ndarray) -> pa.Array:
    """An Arrow array of the stretches of ``ids`` between ``ends``, as bytes."""
    offsets = (ends.astype(np.int64) * ids.itemsize).tobytes()
    buffers = [None, pa.py_buffer(offsets), pa.py_buffer(ids.tobytes())]
    return pa.Array.from_buffers(pa.large_binary(), len(ends) - 1, buffers)


def _contents(values: pa.Array) -> tuple[bytes, np.ndarray]:
    """All bytes of an array of large binaries that begins its buffers, and where each value begins and ends."""
    _, offsets, data = values.buffers()
    ends = np.frombuffer(offsets, np.int64, len(values) + 1) if len(values) else np.zeros(1, np.int64)
    return data.to_pybytes() if data is not None else b"", ends


def token_pieces(
    df: DataFrame,
    text: str = "text",
    keep: list[str] | None = None,
    capacity: int = CAPACITY,
    vocabulary: str = VOCABULARY,
    documents: int = CARRIED,
) -> DataFrame:
    """A row per piece: the kept columns, ``piece`` int, ``start`` and ``length`` long, ``ids``.

    ``ids`` holds little-endian unsigned 32-bit integers. Kept columns of these names are
    replaced.
    """

    def make():
        encoder = remembered(("library", vocabulary), lambda: LibraryEncoder(vocabulary))
        end, most = END.to_bytes(4, "little"), 4 * capacity

        def compute(texts):
            whole = [ids + end for ids in encoder.encode(texts)]
            return [[[ids[i : i + most] for i in range(0, len(ids), most)] for ids in whole]]

        return compute

    made = ("piece", "start", "length", "ids")
    kept = [c for c in (df.columns if keep is None else keep) if c.lower() not in made]
    cut = text_columns(df, make, [StructField("ids", ArrayType(BinaryType()))], text, kept, documents)
    return (
        cut.select(*map(column, kept), F.posexplode("ids").alias("piece", "ids"))
        .withColumn("start", F.col("piece").cast("long") * capacity)
        .withColumn("length", (F.octet_length("ids") / 4).cast("long"))
        .select(*map(column, kept), *made)
    )


def _pair_sums(counts: np.ndarray) -> np.ndarray:
    """Whether two available lengths make a sum; index = sum, up to the capacity."""
    size = len(counts)
    spectrum = np.fft.rfft((counts > 0).astype(float), 2 * size)
    return np.fft.irfft(spectrum * spectrum, 2 * size)[:size] > 0.5


def _fill(gap: int, counts: np.ndarray, pairs: np.ndarray) -> tuple[int, ...] | None:
    """One, two or three available lengths, longest first, that sum to ``gap``."""
    if counts[gap]:
        return (gap,)

    def pair(total: int, held: int = 0) -> tuple[int, ...] | None:
        if total < 2 or not pairs[total]:
            return None
        first = np.arange(total - 1, (total - 1) // 2, -1)
        second = total - first
        need = 1 + (first == second) + (first == held)
        fits = (counts[first] >= need) & (counts[second] >= 1 + (first == second) + (second == held))
        found = np.flatnonzero(fits)
        return (int(first[found[0]]), int(second[found[0]])) if len(found) else None

    if found := pair(gap):
        return found
    longest = np.arange(gap - 2, 0, -1)
    for length in longest[(counts[longest] > 0) & pairs[gap - longest]]:
        if found := pair(int(gap - length), int(length)):
            return (int(length), *found)
    return None


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """Patterns and how often each is used; together exactly the pieces of ``histogram``."""
    counts = np.zeros(capacity + 1, np.int64)
    for length, n in histogram.items():
        counts[length] = n
    patterns: list[tuple[tuple[int, ...], int]] = []
    pairs = _pair_sums(counts)
    for length in range(capacity, 0, -1):
        while counts[length]:
            counts[length] -= 1  # the piece whose gap is filled
            gap = capacity - length
            filled = () if gap == 0 else _fill(gap, counts, pairs)
            counts[length] += 1
            if filled is None:
                break
            used = defaultdict(int)
            for part in (length, *filled):
                used[part] += 1
            times = min(int(counts[part]) // n for part, n in used.items())
            for part, n in used.items():
                counts[part] -= times * n
            patterns.append(((length, *filled), times))
            if any(not counts[part] for part in used):
                pairs = _pair_sums(counts)

    open_by_gap: dict[int, list] = defaultdict(list)  # gap -> [(pattern, times)]
    gaps: list[int] = []

    def put(gap: int, pattern: tuple[int, ...], times: int) -> None:
        if gap not in open_by_gap:
            insort(gaps, gap)
        open_by_gap[gap].append((pattern, times))

    for length in range(capacity, 0, -1):
        left = int(counts[length])
        while left:
            at = bisect_left(gaps, length)
            if at == len(gaps):  # none is large enough: open sequences, each filled with this length
                each = min(capacity // length, left)
                times = left // each
                put(capacity - each * length, (length,) * each, times)
                left -= times * each
                continue
            gap = gaps[at]
            pattern, times = open_by_gap[gap].pop()
            if not open_by_gap[gap]:
                del open_by_gap[gap]
                gaps.pop(at)
            each = min(gap // length, left)
            used = min(times, left // each)
            if used < times:
                put(gap, pattern, times - used)
            put(gap - each * length, pattern + (length,) * each, used)
            left -= used * each
    for rows in open_by_gap.values():
        patterns += rows
    return patterns


def _places(patterns: list[tuple[tuple[int, ...], int]]) -> dict[int, tuple]:
    """For each length, sorted: first rank, first sequence and offset of every run of ranks."""
    runs: dict[int, list] = defaultdict(list)
    ranks: dict[int, int] = defaultdict(int)
    sequence = 0
    for pattern, times in patterns:
        offset = 0
        for length in pattern:
            runs[length].append((ranks[length], sequence, offset))
            ranks[length] += times
            offset += length
        sequence += times
    return {length: tuple(zip(*rows)) for length, rows in runs.items()}


def place(pieces: DataFrame, capacity: int = CAPACITY, key: str = "doc_id") -> DataFrame:
    """``pieces`` (with ``piece`` and ``length``) and ``sequence_id``, ``offset`` long.

    ``pieces`` is read three times, so it should be a stored table. What reaches the driver
    is a count for each length; what goes out is the plan, bounded by ``capacity`` as well.
    """
    salted = pieces.withColumn("salt", F.pmod(F.xxhash64(column(key), "piece"), F.lit(SALTS)).cast("int"))
    counted = checkpointed(salted.groupBy("length", "salt").count())
    histogram = {r["length"]: r["n"] for r in counted.groupBy("length").agg(F.sum("count").alias("n")).collect()}
    runs = json.dumps({str(k): v for k, v in _places(plan(histogram, capacity)).items()})
    shared = pieces.sparkSession.sparkContext.broadcast(runs)

    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    first = counted.select("length", "salt", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("first"))
    order = Window.partitionBy("length", "salt").orderBy(column(key), "piece")
    ranked = (
        salted.withColumn("rank", F.row_number().over(order) - 1)
        .join(F.broadcast(first), ["length", "salt"])  # at most capacity * SALTS rows
        .select(*[salted[c] for c in pieces.columns], (F.col("rank") + F.col("first")).alias("\x00rank"))
    )
    schema = StructType(
        [*pieces.schema.fields, StructField("sequence_id", LongType()), StructField("offset", LongType())]
    )
    arrow, at = to_arrow_schema(schema), pieces.columns.index("length")

    def run(batches):
        table = {int(k): [np.array(c, np.int64) for c in v] for k, v in json.loads(shared.value).items()}
        for batch in batches:
            lengths, rank = batch.column(at).to_numpy(), batch.columns[-1].to_numpy()
            sequence, offset = np.empty(len(rank), np.int64), np.empty(len(rank), np.int64)
            for length in np.unique(lengths):
                rows = np.flatnonzero(lengths == length)
                firsts, sequences, offsets = table[int(length)]
                of = np.searchsorted(firsts, rank[rows], side="right") - 1
                sequence[rows] = sequences[of] + rank[rows] - firsts[of]
                offset[rows] = offsets[of]
            columns = [c.cast(f.type) if c.type != f.type else c for c, f in zip(batch.columns[:-1], arrow)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(sequence), pa.array(offset)], schema=arrow)

    return ranked.mapInArrow(run, schema)


def pack(
    df: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    keep: list[str] | None = None,
    capacity: int = CAPACITY,
    vocabulary: str = VOCABULARY,
) -> DataFrame:
    """Whole documents in, pieces with their ids and places in sequences out."""
    kept = [key, *[c for c in (df.columns if keep is None else keep) if c not in (key, text)]]
    kept = [c for c in kept if c.lower() not in ("sequence_id", "offset")]
    return place(checkpointed(token_pieces(df, text, kept, capacity, vocabulary)), capacity, key)


def digests(df: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """As ``pack``, with a checksum of the ids in place of the ids."""
    pieces = token_pieces(df, text, [key], documents=DOCUMENTS).select(
        column(key), "piece", "start", "length", F.crc32("ids").alias("ids_crc32")
    )
    return place(checkpointed(pieces), key=key)

"""Main text of web pages: markup evidence, and a suffix array over each host's pages.

A page becomes a stream of blocks of text. What markup says about a block comes first: script,
style and comments are no text; menus, headers, footers, sidebars, notices, adverts, forms and
reader comments go by their element, role or class names; and where a page marks its article
(``article`` or ``main``), that is what is kept, whole, also if other pages carry the same passages.

Blocks that markup leaves undecided, on pages that mark no article, are decided by the host. The
token streams of the host's pages are concatenated, suffixes are sorted by doubled prefixes, and
neighbours in that order that share ``LONG`` tokens or more, on ``PAGES`` distinct pages or more,
are boilerplate. A block that lies mostly in such runs is removed, and the unique runs stay. Pages
with equal streams count as one, and a page never loses its whole text this way.

Pages are parsed once, where they are read; what is shuffled is their blocks, ``PIECE`` pages of a
host compressed together. The pieces of a host are dealt into shards of about ``SHARD`` pages, so no
host, however large, is one group. What repeats is decided for the whole host all the same. Every
shard of a large host first gives its runs of ``LONG`` tokens as short hashes, sorted and packed,
about a byte or two each; a stream that several shards hold is counted in one of them. Runs that
reach ``PAGES`` streams by this count are the only ones that can. Of these few each shard then gives
the long hashes, each with the digests of up to ``PAGES`` streams it stands in, and the distinct
streams of a run are counted. All this is dealt by run or by stream into slices, and each shard gets
back those of its runs that are repeated.

Null and empty html give the empty text. Unclosed and cut tags end with the page. Pages without a
host form hosts of their own name ``''``. Repeated rows get the same text each. Columns of the
input other than id, address and html are not carried along.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, BinaryType, LongType, StringType, StructField, StructType

from linksieve.llm.texts import column
from linksieve.session import checkpointed

#: Tokens and distinct pages from which a repeated substring is boilerplate, the share of a block
#: that it must cover, pages in a piece and in a shard, bytes of html whose runs and whose streams are
#: one slice, and the most large hosts that are broadcast.
LONG = 8
PAGES = 3
COVERED = 0.8
PIECE = 32
SHARD = 256
SLICE = 32 << 20
STREAM_SLICE = 2 << 30
BROADCAST_HOSTS = 50_000
LEVEL = 3  # of compression

# Names that markup uses.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure"
    " footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p"
    " pre search section select summary table tbody td tfoot th thead title tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
OUTSIDE = frozenset("nav footer aside form menu dialog head title button select fieldset search iframe object".split())
ARTICLE = frozenset(("article", "main"))
OUTSIDE_ROLES = frozenset(
    "navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split()
)
OUTSIDE_NAMES = frozenset(
    "ad ads adsbygoogle adslot advert adverts advertisement advertising alert banner breadcrumb breadcrumbs consent"
    " cookie cookies disclaimer footer gdpr header masthead menu menubar modal nav navbar navigation newsletter notice"
    " notification outbrain overlay pager pagination popup promo promotion recommended related share sharing sidebar"
    " sidenav signup skip social sponsor sponsored subscribe subscription taboola toolbar topbar widget widgets".split()
)
READER_NAMES = frozenset("comment comments commentlist discussion disqus replies reply respond".split())

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style|noscript|template|textarea|svg|iframe|object)(?=[\s/>])[^>]*+>.*?(?:</\1\s*+>|\Z)"
    r"|<(/?)([a-z][^\s/>]*+)((?:[^>\"']|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<[!?][^>]*+(?:>|\Z)"
    r"|</?[a-z][^<]*+\Z",
    re.IGNORECASE | re.DOTALL,
)
NAMED = re.compile(r"(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.IGNORECASE)
NAME_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")

#: What an open element does to the text in it.
PLAIN, MAIN, SOFT, HARD = range(4)


def element_kind(name: str, attributes: str) -> int:
    """PLAIN, MAIN (article), SOFT (outside, but an article inside counts) or HARD (outside)."""
    kind = MAIN if name in ARTICLE else PLAIN
    if name in OUTSIDE:
        kind = HARD if name == "aside" else SOFT
    if "=" in attributes:
        for key, *values in NAMED.findall(attributes):
            value = "".join(values)
            if key.lower() == "role":
                kind = MAIN if value.lower() == "main" else SOFT if value.lower() in OUTSIDE_ROLES else kind
                continue
            parts = {p.lower() for p in NAME_PARTS.findall(value)}
            if parts & READER_NAMES:
                return HARD
            if name not in ARTICLE and name not in ("body", "html") and parts & OUTSIDE_NAMES:
                kind = max(kind, SOFT)
    return kind


def page_blocks(page: str | None) -> list[tuple[str, int]]:
    """Blocks of text in page order, each with PLAIN, MAIN or SOFT (outside)."""
    blocks: list[tuple[str, int]] = []
    parts: list[str] = []
    stack: list[tuple[str, int]] = []  # open elements and the state before them
    state, at, page = PLAIN, 0, page or ""

    def close_block() -> None:
        if parts:
            text = " ".join("".join(parts).split())
            parts.clear()
            if text:
                blocks.append((text, state))

    for match in TOKEN.finditer(page):
        start, end = match.span()
        if start > at:
            text = page[at:start]
            parts.append(html.unescape(text) if "&" in text else text)
        at = end
        name = match[3]
        if name is None:
            continue
        name = name.lower()
        if name == "br":
            parts.append(" ")
            continue
        if name in BLOCKS:
            close_block()
        if name in VOID or match[4].endswith("/") and name not in BLOCKS:
            continue
        if match[2]:
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] == name:
                    if stack[depth][1] != state:
                        close_block()
                    state = stack[depth][1]
                    del stack[depth:]
                    break
            continue
        if name not in BLOCKS and "=" not in match[4] and name not in OUTSIDE:
            continue  # inline and without names: says nothing
        kind = element_kind(name, match[4])
        if name == "header" and state != MAIN:
            kind = max(kind, SOFT)
        if name == "p" and stack and stack[-1][0] == "p":
            state = stack.pop()[1]
        stack.append((name, state))
        after = state
        if state == HARD or kind == HARD:
            after = HARD
        elif kind == MAIN or kind == SOFT:
            after = kind
        if after != state:
            close_block()
            state = after
    if at < len(page):
        text = page[at:]
        parts.append(html.unescape(text) if "&" in text else text)
    close_block()
    return blocks


def repeated_tokens(tokens: np.ndarray, page_of: np.ndarray, pages: int = PAGES) -> np.ndarray:
    """Whether each token lies in a run of ``LONG`` tokens that stands on ``pages`` pages.

    ``tokens`` are the concatenated streams, as numbers from 0; a run does not cross pages.
    """
    inside = np.zeros(len(tokens), bool)
    rank, width = tokens.astype(np.int64), 1
    while width < LONG:  # ranks of suffixes by their first width tokens, doubled
        if len(rank) <= width:
            return inside
        pairs = rank[:-width] * (rank.max() + 1) + rank[width:]
        rank = np.unique(pairs, return_inverse=True)[1]
        width *= 2
    starts = np.flatnonzero(page_of[: len(rank)] == page_of[width - 1 : width - 1 + len(rank)])
    if not len(starts):
        return inside
    order = starts[np.lexsort((page_of[starts], rank[starts]))]  # the suffix array
    first = np.r_[True, rank[order[1:]] != rank[order[:-1]]]
    other_page = first | np.r_[True, page_of[order[1:]] != page_of[order[:-1]]]
    run = np.cumsum(first) - 1
    often = np.bincount(run, weights=other_page)[run] >= pages
    for shift in range(width):
        inside[order[often] + shift] = True
    return inside


def word_numbers(streams: list[bytes]) -> tuple[pa.LargeBinaryArray, np.ndarray]:
    """Distinct words of streams, none empty, that are divided by single blanks, and the index of each word."""
    words = pc.split_pattern(pa.array(streams, pa.large_binary()), b" ").flatten().dictionary_encode()
    return words.dictionary, words.indices.to_numpy()


def run_hashes(words: pa.LargeBinaryArray, tokens: np.ndarray, page_of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the runs of ``LONG`` tokens that cross no page, and the hashes of these runs.

    ``tokens`` are indices of ``words``.
    """
    count = len(tokens) - LONG + 1
    if count < 1:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    _, ends, values = words.buffers()
    ends = np.frombuffer(ends, np.int64)[words.offset : words.offset + len(words) + 1].tolist()
    values = values.to_pybytes()
    hashed = np.array([xxhash.xxh3_64_intdigest(values[i:j]) for i, j in zip(ends, ends[1:])], np.uint64)[tokens]
    rolled = hashed[:count].copy()
    for shift in range(1, LONG):
        rolled *= np.uint64(0x9E3779B97F4A7C15)
        rolled ^= rolled >> np.uint64(32)
        rolled += hashed[shift : count + shift]
    rolled *= np.uint64(0xC2B2AE3D27D4EB4F)
    rolled ^= rolled >> np.uint64(29)
    starts = np.flatnonzero(page_of[:count] == page_of[LONG - 1 :])
    return starts, rolled[starts]


def distinct_pairs(runs: np.ndarray, streams: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs by run, and the how manieth of its run each one is, from 0."""
    order = np.lexsort((streams, runs))
    runs, streams = runs[order], streams[order]
    new_run = np.r_[True, runs[1:] != runs[:-1]][: len(runs)]
    new = new_run | np.r_[True, streams[1:] != streams[:-1]][: len(runs)]
    runs, streams, new_run = runs[new], streams[new], new_run[new]
    firsts = np.flatnonzero(new_run)
    return runs, streams, np.arange(len(runs)) - np.repeat(firsts, np.diff(np.r_[firsts, len(runs)]))


def packed_blocks(pages: list[list[tuple[str, int]]]) -> tuple[int, bytes]:
    """Bytes of the blocks of pages, and these bytes compressed; no block has white space but blanks."""
    plain = "\x1d".join("\n".join(f"{kind}{text}" for text, kind in blocks) for blocks in pages)
    plain = plain.encode()
    return len(plain), pa.Codec("zstd", compression_level=LEVEL).compress(plain, asbytes=True)


def unpacked_blocks(pieces: pa.Table) -> list[list[tuple[str, int]]]:
    """The blocks of the pages of ``pieces``, from its columns ``size`` and ``blocks``."""
    pages = []
    for size, packed in zip(pieces.column("size").to_pylist(), pieces.column("blocks").to_pylist()):
        plain = pa.decompress(packed, size, "zstd", asbytes=True).decode()
        for page in plain.split("\x1d"):
            pages.append([(block[1:], int(block[0])) for block in page.split("\n")] if page else [])
    return pages


def packed_values(values: np.ndarray) -> bytes:
    """Sorted 32-bit values as differences, byte by byte, compressed."""
    steps = np.diff(values.astype("<u4"), prepend=np.uint32(0)).astype("<u4")
    planes = steps.view(np.uint8).reshape(-1, 4).T.tobytes()
    return pa.Codec("zstd", compression_level=LEVEL).compress(planes, asbytes=True)


def unpacked_values(packed: bytes, count: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(packed, 4 * count, "zstd", asbytes=True), np.uint8)
    return np.cumsum(np.ascontiguousarray(planes.reshape(4, -1).T).view("<u4").ravel(), dtype=np.uint32)


def run_slices(runs: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each run of a host with ``size`` bytes of html: its slice, and its short hash there.

    There are as many short hashes as bytes or more, several to a token.
    """
    slices = max(1, -(-size // SLICE))
    space = 1 << min(32, (size // slices).bit_length())
    return runs % np.uint64(slices), (runs // np.uint64(slices) % np.uint64(space)).astype(np.uint32)


def distinct_streams(pages: list[list[tuple[str, int]]]) -> dict[int, bytes]:
    """Streams of pages that have words, by their digest."""
    streams: dict[int, bytes] = {}
    for blocks in pages:
        whole = "\n".join([text for text, _ in blocks]).encode()
        if whole:
            streams.setdefault(xxhash.xxh3_64_intdigest(whole), whole.replace(b"\n", b" "))
    return streams


def shard_runs(pages: list[list[tuple[str, int]]]) -> tuple[np.ndarray, np.ndarray]:
    """Runs of a shard's distinct streams, as often as they stand there, each with the stream's digest."""
    streams = distinct_streams(pages)
    words, tokens = word_numbers(list(streams.values()))
    sizes = [stream.count(b" ") + 1 for stream in streams.values()]
    stream_of = np.repeat(np.array(list(streams), np.uint64), np.array(sizes, np.int64))
    starts, runs = run_hashes(words, tokens, stream_of)
    return runs, stream_of[starts]


def repeated_runs(pieces: DataFrame) -> DataFrame:
    """``host, shard, runs``: the runs of each shard that stand in ``PAGES`` streams of its host or more.

    ``pieces`` have ``host``, ``shard``, ``bytes``, ``size`` and ``blocks``; a host in one shard,
    whose ``bytes`` are null, is left out.
    """

    def rows(table: pa.Table, made: list[tuple], **columns: pa.DataType) -> pa.Table:
        host, shard = table.column("host")[0], table.column("shard")[0]
        values = list(zip(*made)) if made else [()] * len(columns)
        named = {"host": pa.array([host.as_py()] * len(made), pa.string())}
        named["shard"] = pa.array([shard.as_py()] * len(made), pa.int64())
        return pa.table(named | {n: pa.array(v, t) for (n, t), v in zip(columns.items(), values)})

    def give_streams(table: pa.Table) -> pa.Table:
        made = []
        size = table.column("bytes")[0].as_py()
        if size is not None:
            digests = np.array(list(distinct_streams(unpacked_blocks(table))), np.uint64)
            slice_of = digests % np.uint64(max(1, -(-size // STREAM_SLICE)))
            made = [(int(number), digests[slice_of == number].tobytes()) for number in np.unique(slice_of)]
        return rows(table, made, slice=pa.int64(), digests=pa.binary())

    def find_copies(table: pa.Table) -> pa.Table:
        """Of each shard the streams that another one counts."""
        given = [np.frombuffer(d, np.uint64) for d in table.column("digests").to_pylist()]
        digests = np.concatenate(given)
        shards = np.repeat(table.column("shard").to_numpy(), [len(d) for d in given])
        order = np.lexsort((shards, digests))
        copied = np.zeros(len(digests), bool)
        copied[order[1:]] = digests[order[1:]] == digests[order[:-1]]
        ends = np.cumsum([len(d) for d in given])
        found = [d[copied[end - len(d) : end]] for d, end in zip(given, ends)]
        values = pa.array([f.tobytes() for f in found], pa.binary())
        some = pa.array([len(f) > 0 for f in found], pa.bool_())
        return table.select(["host", "shard", "slice"]).append_column("digests", values).filter(some)

    def give_short(table: pa.Table, copies: pa.Table) -> pa.Table:
        made = []
        size = table.column("bytes")[0].as_py() if table.num_rows else None
        if size is not None:
            runs, streams = shard_runs(unpacked_blocks(table))
            copied = np.isin(streams, np.frombuffer(b"".join(copies.column("digests").to_pylist()), np.uint64))
            asked = runs[copied]
            runs, _, place = distinct_pairs(runs[~copied], streams[~copied])
            runs, asked = runs[place < PAGES], np.setdiff1d(asked, runs)
            (slice_of, short), (asked_slice, asked) = run_slices(runs, size), run_slices(asked, size)
            for number in np.union1d(slice_of, asked_slice):
                own, other = np.sort(short[slice_of == number]), np.unique(asked[asked_slice == number])
                made.append((int(number), len(own), packed_values(own), len(other), packed_values(other)))
        values = {"n": pa.int64(), "short": pa.binary(), "n_asked": pa.int64(), "asked": pa.binary()}
        return rows(table, made, slice=pa.int64(), **values)

    def count_short(table: pa.Table) -> pa.Table:
        given, asked = (
            [unpacked_values(*g) for g in zip(table.column(values).to_pylist(), table.column(n).to_pylist())]
            for values, n in (("short", "n"), ("asked", "n_asked"))
        )
        every = np.sort(np.concatenate(given))
        last = PAGES - 1
        often = np.unique(every[last:][every[last:] == every[: max(0, len(every) - last)]])  # equal ones stand together
        found = [f[np.isin(f, often)] for f in map(np.union1d, given, asked)]
        named = {"n": pa.array([len(f) for f in found], pa.int64())}
        named["short"] = pa.array([packed_values(f) for f in found], pa.binary())
        kept = pa.table({c: table.column(c) for c in ("host", "shard", "slice")} | named)
        return kept.filter(pa.array([len(f) > 0 for f in found], pa.bool_()))

    def give(table: pa.Table, often: pa.Table) -> pa.Table:
        made = []
        if often.num_rows:
            runs, streams = shard_runs(unpacked_blocks(table))
            slice_of, short = run_slices(runs, table.column("bytes")[0].as_py())
            for number, *packed in zip(*(often.column(c).to_pylist() for c in ("slice", "short", "n"))):
                own = np.flatnonzero(slice_of == number)
                own = own[np.isin(short[own], unpacked_values(*packed))]
                own_runs, own_streams, place = distinct_pairs(runs[own], streams[own])
                own_runs, own_streams = own_runs[place < PAGES], own_streams[place < PAGES]
                own_runs = own_runs[np.argsort(own_streams, kind="stable")]
                digests, counts = np.unique(own_streams, return_counts=True)
                made.append((number, digests.tobytes(), counts.astype("<u4").tobytes(), own_runs.tobytes()))
        return rows(table, made, slice=pa.int64(), digests=pa.binary(), counts=pa.binary(), runs=pa.binary())

    def count(table: pa.Table) -> pa.Table:
        runs_of = [np.frombuffer(r, np.uint64) for r in table.column("runs").to_pylist()]
        streams = [
            np.repeat(np.frombuffer(d, np.uint64), np.frombuffer(c, "<u4"))
            for d, c in zip(table.column("digests").to_pylist(), table.column("counts").to_pylist())
        ]
        runs, _, place = distinct_pairs(np.concatenate(runs_of), np.concatenate(streams))
        often = runs[place == PAGES - 1]  # in order, one each
        found = [own[np.isin(own, often)] for own in map(np.unique, runs_of)]
        some = pa.array([len(f) > 0 for f in found], pa.bool_())
        values = pa.array([f.tobytes() for f in found], pa.binary())
        return table.select(["host", "shard"]).append_column("runs", values).filter(some)

    shards = pieces.groupBy("host", "shard")
    streams = "host string, shard long, slice long, digests binary"
    copies = shards.applyInArrow(give_streams, streams).groupBy("host", "slice").applyInArrow(find_copies, streams)
    short = "host string, shard long, slice long, n long, short binary"
    given = shards.cogroup(copies.groupBy("host", "shard")).applyInArrow(
        give_short, f"{short}, n_asked long, asked binary"
    )
    often = given.groupBy("host", "slice").applyInArrow(count_short, short)
    given = shards.cogroup(often.groupBy("host", "shard")).applyInArrow(
        give, "host string, shard long, slice long, digests binary, counts binary, runs binary"
    )
    return given.groupBy("host", "slice").applyInArrow(count, "host string, shard long, runs binary")


def host_texts(pages: list[str | None], known: np.ndarray | None = None) -> tuple[list[str], list[int]]:
    """Main texts of pages of one host, and how many tokens of each lie in repeated runs."""
    return block_texts([page_blocks(p) for p in pages], known)


def block_texts(
    parsed: list[list[tuple[str, int]]], known: np.ndarray | None = None
) -> tuple[list[str], list[int]]:
    """``host_texts`` of pages whose blocks are given.

    ``known`` has hashes of further runs that are repeated, on pages of the host that are not here.
    """
    streams: dict[tuple, int] = {}  # distinct stream -> its page
    sizes, ends, total = {}, {}, 0  # of the blocks of such a page: token counts, and where they end
    same = []
    for i, blocks in enumerate(parsed):
        same.append(streams.setdefault(tuple([text for text, _ in blocks]), i))
        if same[-1] == i:
            sizes[i] = np.array([text.count(" ") + 1 for text, _ in blocks], np.int64)
            ends[i] = total + np.cumsum(sizes[i])
            total += int(sizes[i].sum())
    words, tokens = word_numbers([" ".join(texts).encode() for texts in streams if texts])
    page_of = np.repeat(list(sizes), [n.sum() for n in sizes.values()]).astype(np.int64)
    lies_in = repeated_tokens(tokens, page_of)
    if known is not None and len(known):
        starts, runs = run_hashes(words, tokens, page_of)
        starts = starts[np.isin(runs, known)]
        for shift in range(LONG):
            lies_in[starts + shift] = True
    inside = np.r_[0, np.cumsum(lies_in)]
    texts, repeated = [], []
    for i, blocks in enumerate(parsed):
        covered = inside[ends[same[i]]] - inside[ends[same[i]] - sizes[same[i]]]
        repeated.append(int(covered.sum()))
        chosen = [text for text, kind in blocks if kind == MAIN]
        if not chosen:  # nothing is marked: what the host does not repeat, or else all
            unique = covered < COVERED * sizes[same[i]]
            open_blocks = [(text, u) for (text, kind), u in zip(blocks, unique) if kind == PLAIN]
            chosen = [text for text, u in open_blocks if u] or [text for text, _ in open_blocks]
        texts.append("\n\n".join(chosen))
    return texts, repeated


def extract(df: DataFrame, page: str = "html", url: str = "url", key: str = "page_id") -> DataFrame:
    """``key``, ``url``, ``text``, ``n_chars`` (code points) and ``n_repeated`` (tokens) of every row."""
    host = F.coalesce(F.regexp_extract(F.lower(column(url)), r"^[a-z][a-z0-9+.-]*://([^/?#]*)", 1), F.lit(""))
    dealt = F.xxhash64(column(key), column(url))
    source = df.select(column(key), column(url), column(page).alias("html"), host.alias("host"), dealt.alias("dealt"))
    rows = source.schema.fields[:2]
    source = source.toDF("column0", "column1", *source.columns[2:])
    held = [StructField("host", StringType()), StructField("dealt", LongType())]
    held += [StructField("size", LongType()), StructField("blocks", BinaryType())]
    held += [StructField(f"column{i}", ArrayType(f.dataType)) for i, f in enumerate(rows)]
    held_arrow = to_arrow_schema(StructType(held))

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows_of: dict[str, list[int]] = {}
            for row, name in enumerate(batch.column(3).to_pylist()):
                rows_of.setdefault(name, []).append(row)
            found = [own[i : i + PIECE] for own in rows_of.values() for i in range(0, len(own), PIECE)]
            firsts = pa.array([own[0] for own in found], pa.int64())
            made = [packed_blocks([page_blocks(batch.column(2)[r].as_py()) for r in own]) for own in found]
            columns = [batch.column(3).take(firsts).cast(pa.string()), batch.column(4).take(firsts)]
            columns += [pa.array([n for n, _ in made], pa.int64()), pa.array([z for _, z in made], pa.binary())]
            order = pa.array([r for own in found for r in own], pa.int64())
            ends = pa.array(np.cumsum([0, *map(len, found)]), pa.int32())
            for i, kind in enumerate(held_arrow.types[4:]):
                values = batch.column(i).take(order).cast(kind.value_type)
                columns.append(pa.ListArray.from_arrays(ends, values, type=kind))
            yield pa.RecordBatch.from_arrays(columns, schema=held_arrow)

    size = F.sum(F.coalesce(F.octet_length("html"), F.lit(0))).alias("bytes")
    hosts = source.groupBy(F.col("host").alias("large")).agg(F.count(F.lit(1)).alias("n"), size)
    shards = F.ceil(F.col("n") / SHARD).alias("shards")
    large = checkpointed(hosts.filter(F.col("n") > SHARD).select("large", "bytes", shards))
    n_large = large.count()
    packed = source.mapInArrow(pieces, StructType(held))
    if n_large <= BROADCAST_HOSTS:
        dealt_pieces = packed.join(F.broadcast(large), F.col("host") == F.col("large"), "left")
    else:  # a large host's row is repeated, so that its pieces meet it in many places
        salts = 64
        salted = packed.withColumn("salt", F.pmod("dealt", F.lit(salts)).cast("int"))
        repeated = large.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        met = (F.col("host") == F.col("large")) & (F.col("salt") == F.col("part"))
        dealt_pieces = salted.join(repeated, met, "left")
    shard = F.pmod("dealt", F.coalesce("shards", F.lit(1))).alias("shard")
    held_pages = dealt_pieces.select("host", shard, "bytes", "size", "blocks", "column0", "column1")

    longs = [StructField("n_chars", LongType()), StructField("n_repeated", LongType())]
    schema = StructType([*rows, StructField("text", StringType()), *longs])
    arrow = to_arrow_schema(schema)

    def texts(table: pa.Table, runs: pa.Table | None = None) -> pa.Table:
        packed = runs.column("runs").to_pylist() if runs is not None else []
        made, repeated = block_texts(unpacked_blocks(table), np.frombuffer(b"".join(packed), np.uint64))
        values = made, [len(t) for t in made], repeated
        columns = [table.column(f"column{i}").combine_chunks().flatten().cast(arrow.field(i).type) for i in range(2)]
        return pa.Table.from_arrays([*columns, *map(pa.array, values, arrow.types[2:])], schema=arrow)

    pages = held_pages.groupBy("host", "shard")
    if not n_large:
        return pages.applyInArrow(lambda table: texts(table), schema)
    runs = repeated_runs(held_pages).groupBy("host", "shard")
    return pages.cogroup(runs).applyInArrow(lambda table, runs: texts(table, runs), schema)

"""Collocations of two and three words per language, by dynamic itemset counting.

Texts are dealt into shards, which are scanned one after the other in a circle. Words are counted
from the first scan on. A pair is counted from the scan after the one in which both of its words
have reached the threshold, a triple from the scan after its two pairs have, so lengths
interleave: while some pairs are half counted, others start and triples of the first ones are
counted too. Every phrase is counted for one full circle from its own start, so it has met every
shard once; rounds end when all circles are complete. A phrase that reaches the threshold has
parts that do, so none is missed.

Tasks learn what has reached the threshold, and when, from two tables of fixed size (words and
pairs), indexed by hash. Where two phrases share a place, one may be counted although its parts
are rare: it costs work and changes no count, as its start is the same for every task and its
circle is full. Counts come in partial sums per task, which are kept as tables; after each scan
those whose circles are running are added up once per phrase.

Null text is empty, a null language is ``und``. Words are bytes between separators, whatever they
are; texts of any length are read whole. Repeated rows count as often as they stand there. An
empty table, and a language in which nothing is frequent, gives no rows. Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linksieve.llm.texts import column
from linksieve.session import scratch_path

#: Least number of occurrences of a phrase, and of parts in a longer one (in percent) that drop it.
LEAST, COVERED = 10, 50
FIRST = 2000
#: Shards of the circle. With more of them phrases start earlier, and running sums are added up more often.
SHARDS = 2
#: Places of a table that says when phrases reached the threshold; one byte each.
PLACES = 1 << 23
#: Bytes of text whose phrases a task counts before it passes the sums on.
AT_ONCE = 16 << 20
#: Parts more common among the candidates than the first so many are looked up in a broadcast table.
COMMON = 1000

_UNKNOWN = "und"
_NEVER = 255
# one byte each: ASCII capitals to small letters, ends of pieces to line feeds, tabs to blanks
_CLEANED = bytes.maketrans(
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?\n\x0b\x0c\r\t", b"abcdefghijklmnopqrstuvwxyz" + b"\n" * 10 + b" "
)
# A key is language, line feed and phrase, as one string shuffles better than two; a phrase has no
# line feed. The start of a triple, which nothing waits for, is negative.
_COUNTS = "key string, start int, rows long"


def _hashes(lang: str, words: list[bytes]) -> np.ndarray:
    """Hashes of words, the same as Spark's ``xxhash64(lang, word)``."""
    seed = xxhash.xxh64_intdigest(lang.encode(), 42)
    return np.array([xxhash.xxh64_intdigest(w, seed) for w in words], np.uint64)


def _parted(counts: DataFrame) -> DataFrame:
    """``lang, size, phrase`` of a key, with its rows."""
    phrase = F.substring_index("key", "\n", -1)
    words = F.length("phrase") - F.length(F.translate("phrase", " ", "")) + 1
    return counts.select(
        F.expr("left(key, length(key) - length(substring_index(key, '\n', -1)) - 1)").alias("lang"),
        phrase.alias("phrase"), "start", "rows",
    ).select("lang", F.when(F.col("phrase") == "", 0).otherwise(words).alias("size"), "start", "phrase", "rows")


def _word_place(places: int) -> Column:
    return F.xxhash64("lang", "phrase").bitwiseAND(F.lit(places - 1))


def _pair_place(places: int) -> Column:
    first = F.xxhash64("lang", F.substring_index("phrase", " ", 1))
    second = F.xxhash64("lang", F.substring_index("phrase", " ", -1))
    return F.shiftrightunsigned(first, 20).bitwiseXOR(second).bitwiseAND(F.lit(places - 1))


def count_phrases(
    lang: str, texts: list[bytes], step: int, shards: int, words_at: np.ndarray, pairs_at: np.ndarray
) -> tuple[pa.Array, int, list[tuple[int, np.ndarray, list[np.ndarray], np.ndarray]]]:
    """What this scan counts in the texts of a language.

    Returns the words, the number of their occurrences, and for each length the starts, the
    numbers of the words (an array for every position) and the rows of its phrases.
    """
    whole = b"\n".join(texts).translate(_CLEANED).replace(b"\n", b" \n ")
    tokens = pc.split_pattern(pa.array([whole], pa.binary()), pattern=b" ").flatten().dictionary_encode()
    words, ids = tokens.dictionary, tokens.indices.to_numpy().astype(np.int64)
    blank, end = (pc.index(words, pa.scalar(sign, pa.binary())).as_py() for sign in (b"", b"\n"))
    ids = ids[ids != blank]
    count = len(words)
    rows = np.bincount(ids, minlength=count)
    if end >= 0:
        rows[end] = 0
    total, found = int(rows.sum()), []
    if step < shards:
        some = np.flatnonzero(rows)
        found.append((1, np.zeros(len(some), np.int32), [some], rows[some]))
    mask = np.uint64(len(words_at) - 1)
    hashes = _hashes(lang, words.to_pylist())
    reached = words_at[hashes & mask].astype(np.int32)
    if end >= 0:
        reached[end] = _NEVER
    if len(ids) < 2 or reached.min(initial=_NEVER) == _NEVER:
        return words, total, found

    def running(start: np.ndarray) -> np.ndarray:
        return np.flatnonzero((start <= step) & (step < start + shards))

    left, right = ids[:-1], ids[1:]
    start = np.maximum(reached[left], reached[right]) + 1
    some = running(start)
    if len(some):
        codes, first, rows = np.unique(left[some] * count + right[some], return_index=True, return_counts=True)
        found.append((2, start[some][first], [codes // count, codes % count], rows))
    both = np.flatnonzero(start <= step)
    # not before its own start, should another pair have taken its place earlier
    pair_reached = np.full(len(left), _NEVER, np.int32)
    places = ((hashes[left[both]] >> np.uint64(20)) ^ hashes[right[both]]) & mask
    pair_reached[both] = np.maximum(pairs_at[places], start[both])
    start = np.maximum(pair_reached[:-1], pair_reached[1:]) + 1
    some = running(start)
    if len(some):
        pairs, numbered = np.unique(left[some] * count + right[some], return_inverse=True)
        codes, first, rows = np.unique(numbered * count + right[some + 1], return_index=True, return_counts=True)
        pair = pairs[codes // count]
        found.append((3, start[some][first], [pair // count, pair % count, codes % count], rows))
    return words, total, found


def _scan(texts: DataFrame, step: int, shards: int, words_at: np.ndarray, pairs_at: np.ndarray) -> DataFrame:
    """Partial sums of one shard."""
    context = texts.sparkSession.sparkContext
    known = context.broadcast((words_at.tobytes(), pairs_at.tobytes()))

    def batch(lang, start, phrases, rows):
        keys = pc.binary_join_element_wise(pa.scalar(lang.encode()), phrases, pa.scalar(b"\n"))
        columns = [keys.cast(pa.string()), pa.array(start, pa.int32()), pa.array(rows, pa.int64())]
        return pa.RecordBatch.from_arrays(columns, names=["key", "start", "rows"])

    def batches_of(held: dict[str, list[bytes]], words_at, pairs_at):
        for lang, data in held.items():
            words, total, found = count_phrases(lang, data, step, shards, words_at, pairs_at)
            if step < shards:
                yield batch(lang, [0], pa.array([b""]), [total])
            for size, start, numbers, rows in found:
                taken = [words.take(pa.array(n)) for n in numbers]
                phrases = pc.binary_join_element_wise(*taken, pa.scalar(b" "))
                yield batch(lang, -start if size == 3 else start, phrases, rows)

    def run(batches):
        words_at, pairs_at = (np.frombuffer(b, np.uint8) for b in known.value)
        held, size = {}, 0
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                data = text.encode()
                held.setdefault(lang, []).append(data)
                size += len(data)
                if size >= AT_ONCE:
                    yield from batches_of(held, words_at, pairs_at)
                    held, size = {}, 0
        yield from batches_of(held, words_at, pairs_at)

    return texts.mapInArrow(run, _COUNTS)


def _note(at: np.ndarray, reached: DataFrame, place: Column, step: int) -> bool:
    """Enter the step into the free places of the phrases that have reached the threshold.

    Returns whether there are any. What the driver gets are bitmaps of 4 KB, at most one for
    every 32768 places.
    """
    placed = reached.select(place.alias("place"))
    maps = placed.groupBy(F.bitmap_bucket_number(F.col("place") + 1).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(F.col("place") + 1)).alias("bits")
    )
    some = False
    for bucket, bits in maps.collect():
        from_here = (bucket - 1) * 8 * len(bits)
        found = np.unpackbits(np.frombuffer(bits, np.uint8), bitorder="little").astype(bool)
        part = at[from_here : from_here + len(found)]
        part[found[: len(part)] & (part == _NEVER)] = step
        some = True
    return some


def frequent_phrases(
    df: DataFrame,
    text: str = "text",
    lang: str = "lang",
    least: int = LEAST,
    shards: int = SHARDS,
    places: int = PLACES,
) -> DataFrame:
    """``lang, size, phrase, rows`` of all phrases of one to three words with at least ``least`` rows.

    A row of size 0 holds a language's number of words. ``places`` is a power of two, 32768 or more.
    """
    spark = df.sparkSession
    folder = scratch_path(spark, "phrases")
    dealt = df.select(
        F.coalesce(column(lang).cast("string"), F.lit(_UNKNOWN)).alias("lang"),
        F.coalesce(column(text).cast("string"), F.lit("")).alias("text"),
        F.pmod(F.monotonically_increasing_id(), F.lit(shards)).cast("int").alias("shard"),
    )
    dealt.write.partitionBy("shard").parquet(f"{folder}/texts")
    texts = spark.read.schema("lang string, text string, shard int").parquet(f"{folder}/texts")
    words_at, pairs_at = np.full(places, _NEVER, np.uint8), np.full(places, _NEVER, np.uint8)
    step, last = 0, shards - 1
    decided = []
    while step <= last:
        shard = texts.filter(F.col("shard") == step % shards).select("lang", "text")
        _scan(shard, step, shards, words_at, pairs_at).write.parquet(f"{folder}/sums/{step}")
        running = range(max(step - shards + 1, 0), step + 1)
        sums = spark.read.schema(_COUNTS).parquet(*(f"{folder}/sums/{s}" for s in running))
        begun = step - shards + 1  # circles that began here are complete now
        sums = sums.filter((F.abs("start") == begun) | (F.col("start") > begun))
        added = sums.groupBy("key", "start").agg(F.sum("rows").alias("rows"))
        enough = added.filter((F.col("rows") >= least) | F.col("key").endswith("\n"))
        enough.write.parquet(f"{folder}/enough/{step}")
        enough = _parted(spark.read.schema(_COUNTS).parquet(f"{folder}/enough/{step}"))
        decided.append(enough.filter(F.abs("start") == begun))
        # a phrase of one word begins a circle for pairs at the next scan, and so do pairs for triples
        some_words = _note(words_at, enough.filter("size = 1"), _word_place(places), step)
        some_pairs = _note(pairs_at, enough.filter("size = 2"), _pair_place(places), step)
        if some_words or some_pairs:
            last = step + shards
        step += 1
    whole = decided[0]
    for part in decided[1:]:
        whole = whole.unionByName(part)
    return whole.select("lang", "size", "phrase", "rows")


def _with_rows_of(cuts: DataFrame, part: str, counted: DataFrame, name: str) -> DataFrame:
    """``cuts`` with the rows of their ``part``; the commonest parts are joined by broadcast.

    Without the ``COMMON`` commonest no part stands in more than that share of the cuts.
    """
    found = counted.select("lang", F.col("phrase").alias(part), F.col("rows").alias(name))
    common = (
        cuts.groupBy("lang", part).agg(F.count("*").alias("cuts")).orderBy(F.desc("cuts"), "lang", part).limit(COMMON)
    )
    hot = F.broadcast(found.join(F.broadcast(common.select("lang", part)), ["lang", part], "left_semi"))
    looked_up = cuts.join(hot, ["lang", part], "left")
    rest = looked_up.filter(F.col(name).isNull()).drop(name).join(found, ["lang", part])
    return looked_up.filter(F.col(name).isNotNull()).unionByName(rest)


def scored(counted: DataFrame) -> DataFrame:
    """Every candidate with its lowest-scoring cut: ``lang, size, phrase, a, l, r, score``."""
    candidates = counted.filter("size >= 2").withColumnRenamed("rows", "a")

    def cut(k: int) -> Column:
        return F.struct(
            F.lit(k).alias("k"),
            F.substring_index("phrase", " ", k).alias("first"),
            F.expr(f"substring_index(phrase, ' ', {k} - size)").alias("rest"),
        )

    two = F.when(F.col("size") == 3, F.array(cut(1), cut(2))).otherwise(F.array(cut(1)))
    cuts = candidates.select("lang", "size", "phrase", "a", F.inline(two))
    parts = counted.filter("size in (1, 2)")
    cuts = _with_rows_of(_with_rows_of(cuts, "first", parts, "l"), "rest", parts, "r")
    # decimals of 38 digits hold a million times a squared for a up to 10^15
    wide = {c: F.col(c).cast("decimal(19,0)") for c in "alr"}
    score = F.expr("(1000000 * wide_a * wide_a) div (wide_l * wide_r)")
    cuts = cuts.withColumns({f"wide_{c}": v for c, v in wide.items()})
    lowest = F.min(F.struct(score.cast("long").alias("score"), "k", "l", "r"))
    best = cuts.groupBy("lang", "size", "phrase", "a").agg(lowest.alias("cut"))
    return best.select("lang", "size", "phrase", "a", "cut.l", "cut.r", "cut.score")


def collocations(
    df: DataFrame,
    text: str = "text",
    lang: str = "lang",
    least: int = LEAST,
    covered: int = COVERED,
    first: int = FIRST,
    shards: int = SHARDS,
    places: int = PLACES,
) -> DataFrame:
    """The first phrases of every language: ``lang, rank, phrase, a, l, r, n, score``."""
    spark = df.sparkSession
    folder = scratch_path(spark, "collocations")
    frequent_phrases(df, text, lang, least, shards, places).write.parquet(f"{folder}/counted")
    counted = spark.read.parquet(f"{folder}/counted")
    scored(counted).write.parquet(f"{folder}/scored")
    candidates = spark.read.parquet(f"{folder}/scored")

    inside = [F.substring_index("phrase", " ", k) for k in (2, -2)]
    longer = (
        candidates.filter("size = 3")
        .select("lang", F.explode(F.array(*inside)).alias("phrase"), "a")
        .groupBy("lang", "phrase")
        .agg(F.max("a").alias("longer"))
    )
    alone = candidates.join(longer, ["lang", "phrase"], "left").filter(
        F.coalesce(100 * F.col("longer") < covered * F.col("a"), F.lit(True)) | (F.col("size") == 3)
    )
    # ranges of the ranking, each ranked by itself after the rows of those before it
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    ranged = alone.repartitionByRange("lang", *order).withColumn("range", F.spark_partition_id())
    ranged.write.parquet(f"{folder}/ranged")
    ranged = spark.read.parquet(f"{folder}/ranged")
    before = Window.partitionBy("lang").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = ranged.groupBy("lang", "range").agg(F.count("*").alias("rows"))  # a row per language and range
    offsets = sizes.select("lang", "range", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("offset"))
    place = F.row_number().over(Window.partitionBy("lang", "range").orderBy(*order))
    ranked = ranged.join(offsets.filter(F.col("offset") < first), ["lang", "range"]).withColumn(
        "rank", F.col("offset") + place
    )
    words = counted.filter("size = 0").select("lang", F.col("rows").alias("n"))  # a row per language
    return (
        ranked.filter(F.col("rank") <= first)
        .join(words, "lang")
        .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
    )


def oracle_sql(least: int = LEAST, covered: int = COVERED, first: int = FIRST) -> str:
    """The same rows as DuckDB SQL over ``documents``."""
    grams = "\nUNION ALL ".join(
        f"SELECT lang, {n} AS size, unnest(list_transform(range(1, len(w) - {n - 2}), "
        f"lambda i: array_to_string(w[i:i + {n - 1}], ' '))) AS phrase FROM pieces"
        for n in (1, 2, 3)
    )
    return rf"""
WITH cleaned AS (
  SELECT coalesce(lang, 'und') AS lang,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents),
pieces AS (
  SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]'), lambda x: x <> '') AS w
  FROM (SELECT lang, unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM cleaned)),
sizes AS (SELECT lang, sum(len(w)) AS n FROM pieces GROUP BY lang),
grams AS ({grams}),
counted AS (SELECT lang, size, phrase, count(*) AS a FROM grams GROUP BY ALL HAVING count(*) >= {least}),
cuts AS (
  SELECT lang, size, phrase, a, k, array_to_string(string_split(phrase, ' ')[1:k], ' ') AS head,
    array_to_string(string_split(phrase, ' ')[k + 1:], ' ') AS tail
  FROM (SELECT *, unnest(range(1, size)) AS k FROM counted WHERE size > 1)),
scores AS (
  SELECT c.lang, c.size, c.phrase, c.a, k, x.a AS l, y.a AS r,
    (1000000::HUGEINT * c.a * c.a) // (x.a::HUGEINT * y.a) AS score
  FROM cuts c JOIN counted x ON x.lang = c.lang AND x.phrase = head
    JOIN counted y ON y.lang = c.lang AND y.phrase = tail),
best AS (SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
longer AS (
  SELECT lang, phrase, max(a) AS most FROM (
    SELECT lang, unnest([array_to_string(string_split(phrase, ' ')[1:2], ' '),
                         array_to_string(string_split(phrase, ' ')[2:3], ' ')]) AS phrase, a
    FROM counted WHERE size = 3) GROUP BY lang, phrase),
alone AS (
  SELECT b.* FROM best b LEFT JOIN longer o ON o.lang = b.lang AND o.phrase = b.phrase
  WHERE b.size = 3 OR o.most IS NULL OR 100 * o.most < {covered} * b.a)
SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l,
  CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM alone)
  JOIN sizes USING (lang)
WHERE rank <= {first}
"""

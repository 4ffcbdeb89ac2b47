"""Line-first cleaning: rules on every line, then a verdict on the document.

A line with words fails, and is removed, if one of these holds:

* punctuation: it does not end as a sentence ends; symbols make up more than a tenth of its
  characters; or there is more than one exclamation mark to two words
* navigation: it holds two or more separators of menus and tables
* boilerplate: it holds a stock phrase of web pages

A document is rejected if its base rules fail (fewer than 50 words, or more than half of its
words in three-word windows that occur twice or more), or if the removed lines held more than
half of its characters in words.

Null and empty texts count as no words and fail the base rules. A document is judged alone,
so repeated rows get the same verdict; lines of any length are read whole.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StringType, StructField

from linksieve.llm.texts import column, text_columns

FEWEST_WORDS = 50
MOST_REPEATED_PERCENT = 50
MOST_REMOVED_PERCENT = 50
MOST_SYMBOLS_PERCENT = 10

# Characters and phrases the rules look for.
SPACE = b" \t\n\x0b\x0c\r"
SYMBOLS = b"#*$%&|<>"
SENTENCE_ENDS = ".!?:;…\"'”’»)]"
SEPARATORS = "|»›•"
STOCK_PHRASES = (
    "accept cookies",
    "all rights reserved",
    "back to top",
    "click here",
    "cookie policy",
    "enable javascript",
    "lorem ipsum",
    "newsletter",
    "privacy policy",
    "read more",
    "sign in",
    "sign up",
    "terms of service",
    "terms of use",
    "uses cookies",
)

BASE_FIELDS = [
    StructField("n_words", LongType()),
    StructField("word_chars", LongType()),
    StructField("n_symbols", LongType()),
    StructField("n_dup_lines", LongType()),
    StructField("n_repeat_words", LongType()),
    StructField("base_failed", BooleanType()),
]
LINE_FIELDS = [
    StructField("n_removed_lines", LongType()),
    StructField("removed_chars", LongType()),
    StructField("kept", BooleanType()),
]


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a three-word window found twice or more in ``words``."""
    if len(words) < 4:
        return 0
    numbers = {w: i for i, w in enumerate(dict.fromkeys(words))}
    ids = np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))
    pairs = ids[:-1] * len(numbers) + ids[1:]
    if len(numbers) > 1_000_000:  # three numbers would not fit into one
        pairs = np.unique(pairs, return_inverse=True)[1]
    windows = pairs[:-1] * len(numbers) + ids[2:]
    _, which, counts = np.unique(windows, return_inverse=True, return_counts=True)
    again = counts[which] > 1
    inside = np.zeros(len(words), bool)
    for shift in range(3):
        inside[shift : shift + len(again)] |= again
    return int(inside.sum())


class LineRules:
    def __init__(self):
        self.separators = re.compile(f"[{SEPARATORS}]")
        self.phrases = re.compile("|".join(map(re.escape, STOCK_PHRASES)))

    def fails(self, line: str, raw: bytes, n_words: int, word_chars: int) -> bool:
        """Verdict on one line that holds words."""
        if line.rstrip(" \t\n\x0b\x0c\r")[-1] not in SENTENCE_ENDS:
            return True
        symbols = len(raw) - len(raw.translate(None, SYMBOLS))
        if 100 * symbols > MOST_SYMBOLS_PERCENT * word_chars or 2 * raw.count(b"!") > n_words:
            return True
        if len(self.separators.findall(line)) >= 2:
            return True
        return self.phrases.search(line.lower()) is not None

    def judge(self, text: str | None) -> tuple:
        """The base and line columns, and the text without its failing lines."""
        text = text or ""
        raw = text.encode("utf-8", "surrogatepass")
        words = raw.split()
        word_chars = len(text) - (len(raw) - len(raw.translate(None, SPACE)))
        n_repeat = repeated_words(words)
        seen, n_dup, n_removed, removed = set(), 0, 0, 0
        lines = []
        for line in text.split("\n"):
            raw_line = line.encode("utf-8", "surrogatepass")
            n = len(raw_line.split())
            if n:
                n_dup += line in seen
                seen.add(line)
                chars = len(line) - (len(raw_line) - len(raw_line.translate(None, SPACE)))
                if self.fails(line, raw_line, n, chars):
                    n_removed += 1
                    removed += chars
                    continue
            lines.append(line)
        base_failed = len(words) < FEWEST_WORDS or 100 * n_repeat > MOST_REPEATED_PERCENT * len(words)
        kept = not base_failed and 100 * removed <= MOST_REMOVED_PERCENT * word_chars
        symbols = len(raw) - len(raw.translate(None, SYMBOLS))
        base = len(words), word_chars, symbols, n_dup, n_repeat, base_failed
        return (*base, n_removed, removed, kept, "\n".join(lines))


def judge_documents(df: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``df`` with the counts, ``base_failed``, ``kept`` and ``clean_text``."""

    def make():
        rules = LineRules()
        return lambda texts: list(zip(*map(rules.judge, texts))) or [[]] * 10

    fields = [*BASE_FIELDS, *LINE_FIELDS, StructField("clean_text", StringType())]
    return text_columns(df, make, fields, text, keep)


def verdicts(df: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Counts and verdict per document, without texts."""

    def make():
        rules = LineRules()
        return lambda texts: list(zip(*(rules.judge(t)[:-1] for t in texts))) or [[]] * 9

    return text_columns(df, make, [*BASE_FIELDS, *LINE_FIELDS], text, [key])


def clean_documents(df: DataFrame, text: str = "text") -> DataFrame:
    """The kept documents with all columns of ``df``, their failing lines removed."""

    def make():
        rules = LineRules()
        return lambda texts: list(zip(*(rules.judge(t)[-2:] for t in texts))) or [[]] * 2

    fields = [StructField("\x00kept", BooleanType()), StructField("\x00clean", StringType())]
    judged = text_columns(df, make, fields, text).filter(column("\x00kept"))
    return judged.select(
        *(column("\x00clean").alias(c) if c == text else column(c) for c in df.columns),
    )


def oracle_sql() -> str:
    """The same columns as ``verdicts`` in DuckDB SQL."""
    space, phrases = r"[\x20\x09-\x0D]", "|".join(STOCK_PHRASES)
    ends = SENTENCE_ENDS.replace("]", r"\]").replace("'", "''")
    return rf"""
WITH d AS (SELECT doc_id, row_number() OVER () AS row_no, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words FROM d),
windows AS (
  SELECT row_no, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS gram
  FROM (SELECT row_no, words, unnest(range(1, len(words) - 1)) AS i FROM w)),
again AS (
  SELECT row_no, i FROM (SELECT row_no, i, count(*) OVER (PARTITION BY row_no, gram) AS n FROM windows) WHERE n > 1),
inside AS (
  SELECT row_no, count(DISTINCT i + shift) AS n_repeat_words
  FROM again, (SELECT unnest([0, 1, 2]) AS shift) GROUP BY row_no),
l AS (
  SELECT row_no, line, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n,
    length(regexp_replace(line, '{space}', '', 'g')) AS chars
  FROM (SELECT row_no, unnest(string_split(text, chr(10))) AS line FROM d)),
lines AS (
  SELECT row_no, count(*) - count(DISTINCT line) AS n_dup_lines,
    count(*) FILTER (fails) AS n_removed_lines, coalesce(sum(chars) FILTER (fails), 0) AS removed_chars
  FROM (SELECT *, NOT regexp_matches(line, '[{ends}]{space}*$')
      OR 100 * length(regexp_replace(line, '[^#*$%&|<>]', '', 'g')) > {MOST_SYMBOLS_PERCENT} * chars
      OR 2 * length(regexp_replace(line, '[^!]', '', 'g')) > n
      OR length(regexp_replace(line, '[^{SEPARATORS}]', '', 'g')) >= 2
      OR regexp_matches(lower(line), '{phrases}') AS fails
    FROM l WHERE n > 0)
  GROUP BY row_no),
base AS (
  SELECT doc_id, row_no, len(words) AS n_words, length(regexp_replace(text, '{space}', '', 'g')) AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
    coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
    coalesce(n_removed_lines, 0) AS n_removed_lines, coalesce(removed_chars, 0) AS removed_chars
  FROM w LEFT JOIN inside USING (row_no) LEFT JOIN lines USING (row_no))
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
  n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words,
  n_words < {FEWEST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED_PERCENT} * n_words AS base_failed,
  n_removed_lines::BIGINT AS n_removed_lines, removed_chars::BIGINT AS removed_chars,
  NOT (n_words < {FEWEST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED_PERCENT} * n_words)
    AND 100 * removed_chars <= {MOST_REMOVED_PERCENT} * word_chars AS kept
FROM base
"""

"""Search for many words at once.

A byte search per word is fastest for a few dozen words, and its cost grows with their number. An
Aho-Corasick automaton holds all words of a list and reads every character of a text once, however
many words there are; it runs over Arrow batches and is built once in a worker process.

A list reaches the tasks as one string. As text of an expression every word would be a node of the
parsed query, and the driver's memory would not hold a million of them.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Lists of up to so many words stay built-in expressions.
FEW_WORDS = 64
#: Every task holds the automata, so the characters of a list are checked: about 100 bytes each.
MOST_CHARACTERS = 10_000_000


def many(words: Iterable[str]) -> bool:
    """Whether a list is long enough for the automaton."""
    return len(set(words)) > FEW_WORDS


def word_list(table: DataFrame, word: str, most: int = MOST_CHARACTERS) -> tuple[str, ...]:
    """The distinct words of a column, sorted; raises where they have more than ``most`` characters."""
    words = table.select(F.col(word).alias("word")).filter("word <> ''").distinct()
    size = words.agg(F.sum(F.length("word"))).first()[0] or 0
    if size > most:
        raise ValueError(f"a list of {size} characters; at most {most} reach every task")
    return tuple(sorted(words.toArrow().column("word").to_pylist()))


def words_in(text: str, counted: Iterable[str], wanted: Iterable[str], label: str = "''") -> Column:
    """A struct of ``counted``, how many distinct words of one list a text holds, ``wanted``,
    whether it holds any of the other, and ``listed``, whether ``label`` is one of the other. The
    column ``text`` and the SQL text ``label`` must not be null."""
    lists = [sorted(set(words)) for words in (counted, wanted)]
    for words in lists:
        if sum(map(len, words)) > MOST_CHARACTERS:
            raise ValueError(f"a word list of more than {MOST_CHARACTERS} characters")

    packed = [json.dumps(words) for words in lists]
    # the empty word is in every text
    always, some = ("" in words for words in lists)
    del lists, words

    @F.pandas_udf("counted int, wanted boolean, listed boolean")
    def found(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        import sys
        import types

        import ahocorasick

        # lives as long as the worker process, which Spark reuses from task to task
        store = sys.modules.setdefault("_linksieve_words", types.ModuleType("_linksieve_words"))
        if getattr(store, "packed", None) != packed:
            store.automata = []
            for words in map(json.loads, packed):
                automaton = ahocorasick.Automaton()
                for i, word in enumerate(words):
                    if word:
                        automaton.add_word(word, i)
                automaton.make_automaton()
                store.automata.append(automaton if len(automaton) else None)
            store.packed = packed
        first, second = store.automata

        def count(text: str) -> int:
            return always + (len({i for _, i in first.iter(text)}) if first else 0)

        def any_in(text: str) -> bool:
            return some or bool(second) and next(second.iter(text), None) is not None

        def is_word(label: str) -> bool:
            return label in second if second and label else some and label == ""

        for texts, labels in batches:
            yield pd.DataFrame(
                {
                    "counted": list(map(count, texts)),
                    "wanted": list(map(any_in, texts)),
                    "listed": list(map(is_word, labels)),
                }
            )

    return found(F.col(text), F.expr(label))

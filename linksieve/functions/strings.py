r"""String measures as SQL text.

The feature table has hundreds of small expressions. As text each column costs
one call to the JVM to build; as Column objects it would be one call per operator
and list entry, about a second per query before any work starts.

Patterns are raw literals, ``r'...'``, so a backslash is a backslash.
"""

from __future__ import annotations

from collections.abc import Iterable


def quoted(value: str) -> str:
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def column(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def in_list(text: str, values: Iterable[str]) -> str:
    """Membership; Spark keeps a long list as a hash set."""
    entries = [quoted(v) for v in values]
    return f"({text} IN ({', '.join(entries)}))" if entries else "false"


def count_text(text: str, piece: str) -> str:
    """Occurrences of one character."""
    return f"(length({text}) - length(replace({text}, {quoted(piece)}, '')))"


def count_chars(text: str, char_class: str) -> str:
    """Characters that belong to a regex class such as ``[0-9]``."""
    return f"(length({text}) - length(regexp_replace({text}, r'{char_class}+', '')))"


def longest(pieces: str) -> str:
    """Length of the longest string of an array, 0 for an empty array."""
    return f"coalesce(array_max(transform({pieces}, x -> length(x))), 0)"


def words_found(text: str, words: Iterable[str]) -> str:
    """Number of distinct words that occur. A byte search per word beats one big pattern."""
    return " + ".join(["0", *[f"int(contains({text}, {quoted(w)}))" for w in dict.fromkeys(words)]])


def any_word_found(text: str, words: Iterable[str]) -> str:
    return "(" + " OR ".join(["false", *[f"contains({text}, {quoted(w)})" for w in words]]) + ")"

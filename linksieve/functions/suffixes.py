"""Public suffix rules of any depth.

A rule is a dotted suffix (``co.uk``), one whose first label may be anything (``*.ck``), or an
exception to such a rule (``!www.ck``). An exception decides before all others, then the rule
with the most labels; a host that no rule matches ends in its last label.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linksieve.functions.strings import in_list

#: A rule table reaches every task as hash sets, so its size is checked.
MOST_RULES = 200_000

_RULE = re.compile(r"(\*\.|!)?([^\s.*!]+(?:\.[^\s.*!]+)*)")


def rules_by_depth(suffixes: Iterable[str]) -> dict[str, dict[int, list[str]]]:
    """Plain rules, parents of wildcard rules and exceptions, by the number of labels of the rule."""
    found: dict[str, dict[int, list[str]]] = {"plain": {}, "wildcard": {}, "exception": {}}
    for rule in suffixes:
        match = _RULE.fullmatch(rule)
        if not match:
            raise ValueError(f"not a suffix rule: {rule!r} (a * may only be the first label)")
        mark, name = match.groups()
        depth = name.count(".") + 1 + (mark == "*.")
        if mark == "!" and depth < 2:
            raise ValueError(f"an exception needs two labels: {rule!r}")
        kind = {"*.": "wildcard", "!": "exception", None: "plain"}[mark]
        found[kind].setdefault(depth, []).append(name)
    return found


def registered_domain(host: str, suffixes: Iterable[str]) -> str:
    """P11 for names, as SQL over the SQL text ``host``: its public suffix and one label more.

    A host that has no label more is its own domain. Every depth is one hash-set lookup of the
    host's last labels, however many rules there are.
    """
    rules = rules_by_depth(suffixes)

    def last(labels: int) -> str:
        return f"substring_index({host}, '.', -{labels})"

    cases = []
    for depth, names in sorted(rules["exception"].items(), reverse=True):
        cases.append((in_list(last(depth), names), depth - 1))
    for depth in sorted({*rules["plain"], *rules["wildcard"]} - {1}, reverse=True):
        tests = []
        if depth in rules["plain"]:
            tests.append(in_list(last(depth), rules["plain"][depth]))
        if depth in rules["wildcard"]:
            longer = f"{last(depth)} <> {last(depth - 1)}"  # the host has that many labels
            tests.append(f"({in_list(last(depth - 1), rules['wildcard'][depth])} AND {longer})")
        cases.append((" OR ".join(tests), depth))
    if not cases:
        return last(2)
    return "CASE " + " ".join(f"WHEN {test} THEN {last(labels + 1)}" for test, labels in cases) + f" ELSE {last(2)} END"


def suffix_rules(rules: DataFrame, rule: str = "rule", most: int = MOST_RULES) -> tuple[str, ...]:
    """The rules of a table with a rule per row, for ``Lexicons(suffixes=...)`` and the domain operators.

    Lines of a published list may stand as they are: what follows a blank is dropped, so are
    empty lines and ``//`` comments. Raises beyond ``most`` rules.
    """
    text = F.lower(F.regexp_extract(F.col(rule), r"^\s*(\S*)", 1))
    lines = rules.select(text.alias("rule")).filter("rule <> '' AND NOT startswith(rule, '//')").distinct()
    found = [r.rule for r in lines.limit(most + 1).collect()]
    if len(found) > most:
        raise ValueError(f"more than {most} suffix rules")
    return tuple(sorted(found))

"""Split URL strings into parts (P1-P13), one column per part.

The cuts depend on each other, so they are staged as consecutive projections:
each part is computed once and read by all later ones.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linksieve.functions.canonical import SCHEME_PATTERN
from linksieve.functions.lexicons import DEFAULT_LEXICONS
from linksieve.functions.strings import column
from linksieve.functions.suffixes import registered_domain

PART_NAMES = (
    "scheme", "fragment", "query", "path", "userinfo", "host", "port", "host_parts", "is_ip",
    "tld", "registered", "subdomain", "segments", "last_segment", "extension",
)
_HELPERS = (
    "text", "raw_scheme", "rest", "before_fragment", "before_query", "authority", "netloc", "name",
)

# A final line feed is tolerated in an address.
_HEX_ADDRESS = r"^0x[0-9a-f]+\n?\z"
_OCTET = "(?:[01]?[0-9]{1,2}|2[0-4][0-9]|25[0-5])"
_IPV4_ADDRESS = rf"^{_OCTET}(?:[.]{_OCTET}){{3}}\n?\z"


# Parts by stage. ``{part}`` stands for the column of a part of an earlier stage;
# patterns hold braces themselves, so they are filled in the same way.
_STEPS: tuple[dict[str, str], ...] = (
    {"raw_scheme": "regexp_extract({text}, r'{scheme_pattern}', 1)"},
    {
        "scheme": "lower({raw_scheme})",
        "rest": "if({raw_scheme} = '', {text}, substr({text}, length({raw_scheme}) + 4))",
    },
    # The fragment is cut before the query, the query before the path.
    {"before_fragment": "substring_index({rest}, '#', 1)"},
    {
        "fragment": "substr({rest}, length({before_fragment}) + 2)",
        "before_query": "substring_index({before_fragment}, '?', 1)",
    },
    {
        "query": "substr({before_fragment}, length({before_query}) + 2)",
        "authority": "substring_index({before_query}, '/', 1)",
    },
    {
        "path": "substr({before_query}, length({authority}) + 1)",
        "netloc": "substring_index({authority}, '@', -1)",
    },
    {
        "userinfo": "substr({authority}, 1, length({authority}) - length({netloc}) - 1)",
        "name": """
            CASE WHEN NOT startswith({netloc}, '[') THEN substring_index({netloc}, ':', 1)
                 WHEN contains({netloc}, ']') THEN substr({netloc}, 1, instr({netloc}, ']'))
                 ELSE {netloc} END
        """,
    },
    {
        "host": "lower({name})",
        "port": """
            if(startswith({netloc}, '['), trim(LEADING ':' FROM substr({netloc}, length({name}) + 1)),
               substr({netloc}, length({name}) + 2))
        """,
        "segments": "array_remove(split({path}, '/'), '')",
    },
    {
        "is_ip": """
            startswith({host}, '[') OR {host} RLIKE r'{hex_address}' OR {host} RLIKE r'{ipv4_address}'
        """,
        "host_parts": r"if({host} = '', cast(array() AS array<string>), split({host}, r'\.'))",
        "last_segment": "coalesce(try_element_at({segments}, -1), '')",
    },
    {
        "tld": "if(contains({host}, '.') AND NOT {is_ip}, substring_index({host}, '.', -1), '')",
        "registered": "if({is_ip}, '', {registered_name})",
        "extension": """
            if(contains({last_segment}, '.'),
               concat('.', lower(substring_index({last_segment}, '.', -1))), '')
        """,
    },
    {
        "subdomain": """
            if({registered} = '', '', substr({host}, 1, length({host}) - length({registered}) - 1))
        """,
    },
)


def with_url_parts(
    df: DataFrame,
    url: str = "url",
    prefix: str = "",
    suffixes: Iterable[str] = DEFAULT_LEXICONS.suffixes,
    keep_text: bool = False,
) -> DataFrame:
    """Add the parts of column ``url``, named ``prefix`` + part name.

    A null URL is read as an empty string; no part is ever null. ``suffixes`` are rules
    of any depth (see :mod:`linksieve.functions.suffixes`). ``keep_text``
    leaves that string in the result as ``text`` with the prefix.
    """
    # Helpers have a prefix in any case, not to replace a column of that name.
    named = {n: prefix + n for n in PART_NAMES} | {h: (prefix or "__") + h for h in _HELPERS}
    fill = {name: column(full) for name, full in named.items()} | {
        "scheme_pattern": SCHEME_PATTERN,
        "hex_address": _HEX_ADDRESS,
        "ipv4_address": _IPV4_ADDRESS,
        "registered_name": registered_domain(column(prefix + "host"), suffixes),
    }
    out = df.withColumn(named["text"], F.expr(f"coalesce({column(url)}, '')"))
    for step in _STEPS:
        out = out.withColumns({named[n]: F.expr(sql.format(**fill)) for n, sql in step.items()})
    return out.drop(*[named[h] for h in _HELPERS if not (keep_text and h == "text")])

"""The 47 numeric columns of a URL (FX, F1-F47)."""

from __future__ import annotations

from collections.abc import Iterable
from itertools import groupby

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linksieve.functions.lexicons import DEFAULT_LEXICONS, Lexicons
from linksieve.functions.measures import MEASURES, character_measures
from linksieve.functions.strings import (
    any_word_found,
    column,
    count_chars,
    count_text,
    in_list,
    longest,
    quoted,
    words_found,
)
from linksieve.functions.url_parts import with_url_parts
from linksieve.functions.words import many, words_in

# Feature names in the order of the feature table, by family.
FEATURE_FAMILIES: dict[str, tuple[str, ...]] = {
    "lexical": (
        "url_length", "hostname_length", "path_length", "query_length", "num_digits",
        "num_letters", "num_special_chars", "num_dots", "num_hyphens", "num_slashes",
        "num_subdomains", "num_dots_in_domain", "has_at_symbol", "has_hyphen_in_domain",
        "tld_length", "host_digit_count", "host_hyphen_count", "num_host_tokens",
        "longest_host_token", "subdomain_length",
    ),
    "structural": (
        "uses_https", "has_port", "has_ip_host", "num_path_segments", "longest_path_segment",
        "num_query_params", "has_fragment", "has_userinfo", "has_double_slash_redirect",
        "path_to_url_ratio", "has_file_extension", "has_executable_extension",
        "num_encoded_chars",
    ),
    "suspicion": (
        "is_shortener", "num_suspicious_keywords", "has_suspicious_tld",
        "brand_domain_mismatch", "digit_letter_ratio", "domain_entropy", "url_entropy",
        "longest_consecutive_run", "has_punycode", "vowel_ratio_domain", "is_free_hosting",
        "tld_rank", "has_hex_token", "longest_consonant_run",
    ),
}
FEATURE_NAMES: tuple[str, ...] = tuple(n for names in FEATURE_FAMILIES.values() for n in names)
FEATURE_VERSION = 1

# URL parts and helpers are columns with this prefix, dropped at the end.
_PREFIX = "__"

# A word boundary spelled out, so that it does not change with the Java version.
_HEX_TOKEN = r"(?<![\p{L}\p{N}_])[0-9a-f]{8,}(?![\p{L}\p{N}_])"


def _ends_in(host: str, domains: Iterable[str]) -> str:
    """True when ``host`` is a sub-host of a listed domain.

    Entries are grouped by their number of labels, so each group is one hash-set
    lookup of the host's last labels in place of a suffix test per entry.
    """
    by_labels = groupby(sorted(domains, key=lambda d: d.count(".")), key=lambda d: d.count("."))
    tests = ["false"]
    for dots, group in by_labels:
        last = f"substring_index({host}, '.', -{dots + 1})"
        tests.append(f"({in_list(last, group)} AND {last} <> {host})")
    return " OR ".join(tests)


def _counts() -> dict[str, str]:
    """Counts that other features divide by, and the lower-cased URL."""
    return {
        "digits": count_chars("__text", "[0-9]"),
        "letters": count_chars("__text", r"\p{L}"),
        "registered_letters": count_chars("__registered", r"\p{L}"),
        "lower_text": "lower(__text)",
    }


def _lexical() -> dict[str, str]:
    return {
        "url_length": "length(__text)",
        "hostname_length": "length(__host)",
        "path_length": "length(__path)",
        "query_length": "length(__query)",
        "num_digits": "__digits",
        "num_letters": "__letters",
        "num_special_chars": count_chars("__text", "[-_?=&%@]"),
        "num_dots": count_text("__text", "."),
        "num_hyphens": count_text("__text", "-"),
        "num_slashes": count_text("__text", "/"),
        "num_subdomains": "if(__is_ip, 0, greatest(size(__host_parts) - 2, 0))",
        "num_dots_in_domain": count_text("__host", "."),
        "has_at_symbol": "contains(__text, '@')",
        "has_hyphen_in_domain": "contains(__registered, '-')",
        "tld_length": "length(__tld)",
        "host_digit_count": count_chars("__host", "[0-9]"),
        "host_hyphen_count": count_text("__host", "-"),
        "num_host_tokens": "size(__host_parts)",
        "longest_host_token": longest("__host_parts"),
        "subdomain_length": "length(__subdomain)",
    }


def _structural(lex: Lexicons) -> dict[str, str]:
    return {
        "uses_https": "__scheme = 'https'",
        "has_port": "__port <> ''",
        "has_ip_host": "__is_ip",
        "num_path_segments": "size(__segments)",
        "longest_path_segment": longest("__segments"),
        "num_query_params": count_text("__query", "="),
        "has_fragment": "__fragment <> ''",
        "has_userinfo": "__userinfo <> ''",
        "has_double_slash_redirect": "contains(__path, '//')",
        "path_to_url_ratio": "if(__text <> '', length(__path) / length(__text), 0D)",
        "has_file_extension": "__extension <> ''",
        "has_executable_extension": in_list("__extension", lex.executable_extensions),
        "num_encoded_chars": count_text("__text", "%"),
    }


_FIRST_LABEL = "substring_index(__registered, '.', 1)"


def _suspicion(lex: Lexicons) -> dict[str, str]:
    ranked = ", ".join(quoted(tld) for tld in lex.ranked_tlds)
    rank = f"array_position(array({ranked}), __tld)"
    return {
        "is_shortener": (
            f"{in_list('__registered', lex.shorteners)} OR {in_list('__host', lex.shorteners)}"
        ),
        "num_suspicious_keywords": (
            "__found.counted" if many(lex.keywords) else words_found("__lower_text", lex.keywords)
        ),
        "has_suspicious_tld": in_list("__tld", lex.suspicious_tlds),
        "brand_domain_mismatch": (
            "NOT __found.listed AND __found.wanted"
            if many(lex.brands)
            else f"NOT {in_list(_FIRST_LABEL, lex.brands)} AND {any_word_found('__lower_text', lex.brands)}"
        ),
        "digit_letter_ratio": "if(__letters > 0, __digits / __letters, double(__digits > 0))",
        **{name: f"__measured.{name}" for name in MEASURES},
        "has_punycode": "contains(__host, 'xn--')",
        "vowel_ratio_domain": (
            f"if(__registered_letters > 0, {count_chars('__registered', '[aeiou]')} / __registered_letters, 0D)"
        ),
        "is_free_hosting": (
            f"{in_list('__registered', lex.free_hosting)} OR {_ends_in('__host', lex.free_hosting)}"
        ),
        "tld_rank": f"if({rank} > 0, {rank} - 1, {len(lex.ranked_tlds)})",
        "has_hex_token": f"__lower_text RLIKE r'{_HEX_TOKEN}'",
        "longest_consonant_run": longest(
            "regexp_extract_all(__registered, r'[bcdfghjklmnpqrstvwxz]+', 0)"
        ),
    }


def require_free(df: DataFrame, names: Iterable[str]) -> None:
    """Raise if ``df`` has a column that is about to be added, in whatever case."""
    have = {c.lower() for c in df.columns}
    taken = sorted(n for n in names if n.lower() in have)
    if taken:
        raise ValueError(f"the table already has columns {taken}; rename or drop them")


def with_features(
    df: DataFrame,
    url: str = "url",
    features: Iterable[str] = FEATURE_NAMES,
    lexicons: Lexicons = DEFAULT_LEXICONS,
) -> DataFrame:
    """FX. ``df`` plus one float column per feature, computed from column ``url``.

    Map only: no shuffle, and Python only for ``MEASURES`` and word lists of more than
    ``FEW_WORDS``, in Arrow batches. A null URL gives the row of an empty string
    and no value is ever null, NaN or infinite. Columns that are not asked for,
    and the URL parts only they need, are pruned by the optimizer.

    The parts run in whole-stage code. All feature columns as one whole-stage method
    would be too long for the JIT compiler; ``spark.sql.codegen.hugeMethodLimit`` at
    8000 (see ``session``) makes Spark split such a projection into small methods.
    """
    features = list(features)
    require_free(df, features)
    out = with_url_parts(df, url, _PREFIX, lexicons.suffixes, keep_text=True)
    out = out.withColumns({_PREFIX + name: F.expr(sql) for name, sql in _counts().items()})
    if set(MEASURES) & set(features):
        out = out.withColumn(_PREFIX + "measured", character_measures("__text", "__registered"))
    # long word lists are searched for together; a list that is short, or not asked for, is left out
    counted = lexicons.keywords if many(lexicons.keywords) and "num_suspicious_keywords" in features else ()
    wanted = lexicons.brands if many(lexicons.brands) and "brand_domain_mismatch" in features else ()
    if counted or wanted:
        out = out.withColumn(_PREFIX + "found", words_in("__lower_text", counted, wanted, _FIRST_LABEL))
    measures = {**_lexical(), **_structural(lexicons), **_suspicion(lexicons)}
    return out.selectExpr(
        *[column(name) for name in df.columns],
        *[f"float({measures[name]}) AS {name}" for name in features],
    )

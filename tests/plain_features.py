"""A second, deliberately naive computation of the feature row, for tests only."""

from __future__ import annotations

import itertools
import math
import re

from linksieve.functions.lexicons import DEFAULT_LEXICONS as LEX

WHOLE = re.compile(
    r"(?:(?P<scheme>[A-Za-z][A-Za-z0-9+.\-]*)://)?"
    r"(?P<authority>[^#?/]*)(?P<path>/[^#?]*)?(?:\?(?P<query>[^#]*))?(?:\#(?P<fragment>.*))?",
    re.S,
)


def split_url(url: str) -> dict[str, str]:
    got = {k: v or "" for k, v in WHOLE.fullmatch(url).groupdict().items()}
    before_at, at, server = got.pop("authority").rpartition("@")
    got["userinfo"] = before_at
    literal = re.match(r"\[[^\]]*\]", server)
    if literal:
        name, port = literal.group(), server[literal.end():].lstrip(":")
    elif server[:1] == "[":
        name, port = server, ""
    else:
        name, port = (server.split(":", 1) + [""])[:2]
    got["host"], got["port"], got["scheme"] = name.lower(), port, got["scheme"].lower()
    return got


def registrable(host: str) -> str:
    labels = host.split(".")
    keep = 3 if ".".join(labels[-2:]) in LEX.suffixes else 2
    return ".".join(labels[-keep:])


def is_address(host: str) -> bool:
    if host[:1] == "[" or re.fullmatch("0x[0-9a-f]+\n?", host):
        return True
    octets = host.removesuffix("\n").split(".")
    return len(octets) == 4 and all(re.fullmatch("[0-9]{1,3}", o) and int(o) < 256 for o in octets)


def bits(text: str) -> float:
    total = len(text)
    shares = [text.count(ch) / total for ch in set(text)]
    return math.fsum(-s * math.log2(s) for s in shares)


def letters(text: str) -> int:
    return len([ch for ch in text if ch.isalpha()])


def most(sizes) -> int:
    return max([0, *sizes])


def plain_features(url: str | None) -> dict[str, float]:
    url = url or ""
    part = split_url(url)
    host, path, low = part["host"], part["path"], url.lower()
    address = is_address(host)
    labels = host.split(".") if host else []
    tld = labels[-1] if len(labels) >= 2 and not address else ""
    domain = "" if address else registrable(host)
    steps = [s for s in path.split("/") if s]
    dot = steps[-1].rfind(".") if steps else -1
    extension = steps[-1][dot:].lower() if dot >= 0 else ""
    digits = len(re.findall("[0-9]", url))
    alpha, domain_alpha = letters(url), letters(domain)
    runs = [len(list(g)) for ch, g in itertools.groupby(url) if ch != "\n"]
    return {
        "url_length": len(url),
        "hostname_length": len(host),
        "path_length": len(path),
        "query_length": len(part["query"]),
        "num_digits": digits,
        "num_letters": alpha,
        "num_special_chars": len(re.findall("[-_?=&%@]", url)),
        "num_dots": url.count("."),
        "num_hyphens": url.count("-"),
        "num_slashes": url.count("/"),
        "num_subdomains": 0 if address else most([len(labels) - 2]),
        "num_dots_in_domain": host.count("."),
        "has_at_symbol": "@" in url,
        "has_hyphen_in_domain": "-" in domain,
        "tld_length": len(tld),
        "host_digit_count": len(re.findall("[0-9]", host)),
        "host_hyphen_count": host.count("-"),
        "num_host_tokens": len(labels),
        "longest_host_token": most(map(len, labels)),
        "subdomain_length": most([len(host) - len(domain) - 1]) if domain else 0,
        "uses_https": part["scheme"] == "https",
        "has_port": part["port"] != "",
        "has_ip_host": address,
        "num_path_segments": len(steps),
        "longest_path_segment": most(map(len, steps)),
        "num_query_params": part["query"].count("="),
        "has_fragment": part["fragment"] != "",
        "has_userinfo": part["userinfo"] != "",
        "has_double_slash_redirect": "//" in path,
        "path_to_url_ratio": len(path) / len(url) if url else 0,
        "has_file_extension": extension != "",
        "has_executable_extension": extension in LEX.executable_extensions,
        "num_encoded_chars": url.count("%"),
        "is_shortener": domain in LEX.shorteners or host in LEX.shorteners,
        "num_suspicious_keywords": len([w for w in LEX.keywords if w in low]),
        "has_suspicious_tld": tld in LEX.suspicious_tlds,
        "brand_domain_mismatch": any(b in low for b in LEX.brands)
        and domain.split(".")[0] not in LEX.brands,
        "digit_letter_ratio": digits / alpha if alpha else digits > 0,
        "domain_entropy": bits(domain) if domain else 0,
        "url_entropy": bits(url) if url else 0,
        "longest_consecutive_run": most(runs),
        "has_punycode": "xn--" in host,
        "vowel_ratio_domain": (
            len(re.findall("[aeiou]", domain)) / domain_alpha if domain_alpha else 0
        ),
        "is_free_hosting": domain in LEX.free_hosting
        or any(("." + host).endswith("." + f) and host != f for f in LEX.free_hosting),
        "tld_rank": LEX.ranked_tlds.index(tld) if tld in LEX.ranked_tlds else len(LEX.ranked_tlds),
        "has_hex_token": re.search(r"\b[0-9a-f]{8,}\b", low) is not None,
        "longest_consonant_run": most(map(len, re.findall("[bcdfghjklmnpqrstvwxz]+", domain))),
    }

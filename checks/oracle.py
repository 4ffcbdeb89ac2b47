"""DuckDB SQL for every registered query that SQL can express.

Written in DuckDB's own idioms (one big pattern for the URL parts, list functions
for the measures, full sorts for the splits) so that it shares no method with the
Spark side, only the fixed values.
"""

from __future__ import annotations

from linksieve.functions.canonical import WHITESPACE
from linksieve.functions.lexicons import DEFAULT_LEXICONS as LEX
from linksieve.operators.diagnostics import COLLECTION_RULES
from linksieve.operators.features import FEATURE_FAMILIES, FEATURE_NAMES
from linksieve.operators.metrics import SWEEP_THRESHOLDS
from linksieve.plans.queries import SUFFIX_RULES, WANTED_PRECISIONS
from linksieve.plans.sample_corpus import LINEITEM_SQL, ORDERS_SQL


def words(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


def with_ctes(body: str, *ctes: tuple[str, str]) -> str:
    return "WITH " + ",\n".join(f"{name} AS ({sql})" for name, sql in ctes) + "\n" + body


SPACES = " || ".join(f"chr({ord(ch)})" for ch in WHITESPACE)
SCHEME = r"^[A-Za-z][A-Za-z0-9+.\-]*://"

STEPS = rf"""
SELECT *, lower(split_part(unslashed, '/', 1)) || substr(unslashed, length(split_part(unslashed, '/', 1)) + 1)
  AS canonical
FROM (SELECT *, regexp_replace(bare, '/+$', '') AS unslashed
      FROM (SELECT *, regexp_replace(trimmed, '{SCHEME}', '') AS bare
            FROM (SELECT *, trim(url, {SPACES}) AS trimmed FROM raw)))
"""

RAW = ("raw", ORDERS_SQL)
RAW_MANY = ("raw", LINEITEM_SQL)
CANON = ("canon", STEPS)
PAIRS = ("pairs", "SELECT DISTINCT canonical AS url, label FROM canon WHERE length(canonical) > 0")
CORPUS = (
    "corpus",
    "SELECT url, label FROM pairs WHERE url NOT IN "
    "(SELECT url FROM pairs GROUP BY url HAVING count(*) > 1)",
)
CLEAN = (RAW, CANON, PAIRS, CORPUS)

AUTHORITY = r"^(?:([A-Za-z][A-Za-z0-9+.\-]*)://)?([^#?/]*)(/[^#?]*)?(\?[^#]*)?(#.*)?$"


def parts_cte(source: str, key: str, url: str = "url") -> tuple[tuple[str, str], ...]:
    """CTE ``parts``: key, u and all parts of ``source``'s URLs."""
    cut = ", ".join(
        f"regexp_extract(u, '{AUTHORITY}', {i}, 's') AS {name}"
        for i, name in enumerate(("sch", "authority", "path", "q", "frag"), start=1)
    )
    hosts = rf"""
    SELECT *, lower(name) AS host,
      CASE WHEN netloc LIKE '[%' THEN regexp_replace(substr(netloc, length(name) + 1), '^:+', '')
           ELSE substr(netloc, length(name) + 2) END AS port
    FROM (SELECT *, CASE WHEN netloc NOT LIKE '[%' THEN split_part(netloc, ':', 1)
                         WHEN contains(netloc, ']') THEN regexp_extract(netloc, '^[^\]]*\]')
                         ELSE netloc END AS name
          FROM (SELECT *, regexp_extract(authority, '[^@]*$') AS netloc,
                  regexp_extract(authority, '^(.*)@[^@]*$', 1, 's') AS userinfo,
                  lower(sch) AS scheme, substr(q, 2) AS query, substr(frag, 2) AS fragment
                FROM (SELECT {key}, u, {cut} FROM (SELECT {key}, coalesce({url}, '') AS u FROM {source}))))
    """
    labels = rf"""
    SELECT *, CASE WHEN host = '' THEN []::VARCHAR[] ELSE string_split(host, '.') END AS labels,
      host LIKE '[%' OR regexp_full_match(host, '0x[0-9a-f]+\n?') OR
        (regexp_full_match(host, '[0-9]{{1,3}}([.][0-9]{{1,3}}){{3}}\n?') AND
         len(list_filter(string_split(host, '.'), lambda x: coalesce(try_cast(x AS INTEGER), 999) > 255)) = 0)
        AS is_ip,
      list_filter(string_split(path, '/'), lambda x: x <> '') AS segments
    FROM hosts
    """
    parts = rf"""
    SELECT *, CASE WHEN registered = '' THEN ''
                   ELSE left(host, greatest(length(host) - length(registered) - 1, 0)) END AS subdomain,
      coalesce(lower(regexp_extract(last_segment, '[.][^.]*$')), '') AS extension
    FROM (SELECT *, CASE WHEN len(labels) > 1 AND NOT is_ip THEN labels[-1] ELSE '' END AS tld,
            CASE WHEN is_ip THEN ''
                 WHEN list_contains({words(LEX.suffixes)}, array_to_string(labels[-2:], '.'))
                 THEN array_to_string(labels[-3:], '.')
                 ELSE array_to_string(labels[-2:], '.') END AS registered,
            coalesce(segments[-1], '') AS last_segment
          FROM labelled)
    """
    return ("hosts", hosts), ("labelled", labels), ("parts", parts)


RUNS = (
    "runs",
    r"""
    SELECT u, max(n) AS longest FROM (
      SELECT u, island, ch, count(*) AS n FROM (
        SELECT u, ch, i - row_number() OVER (PARTITION BY u, ch ORDER BY i) AS island
        FROM (SELECT u, i, substr(u, i, 1) AS ch
              FROM (SELECT u, unnest(range(1, length(u) + 1)) AS i FROM (SELECT DISTINCT u FROM parts))))
      WHERE ch <> chr(10) GROUP BY u, island, ch)
    GROUP BY u
    """,
)


def kept(text: str, pattern: str) -> str:
    return f"length(regexp_replace({text}, '{pattern}', '', 'g'))"


def times(text: str, ch: str) -> str:
    return f"(len(string_split({text}, '{ch}')) - 1)"


def entropy(text: str) -> str:
    return f"CASE WHEN {text} = '' THEN 0 ELSE list_aggregate(string_split({text}, ''), 'entropy') END"


def longest(pieces: str) -> str:
    return f"coalesce(list_max(list_transform({pieces}, lambda x: length(x))), 0)"


DIGITS = kept("u", "[^0-9]")
LETTERS = kept("u", r"\P{L}")
DOMAIN_LETTERS = kept("registered", r"\P{L}")
FEATURES = {
    "url_length": "length(u)",
    "hostname_length": "length(host)",
    "path_length": "length(path)",
    "query_length": "length(query)",
    "num_digits": DIGITS,
    "num_letters": LETTERS,
    "num_special_chars": kept("u", "[^-_?=&%@]"),
    "num_dots": times("u", "."),
    "num_hyphens": times("u", "-"),
    "num_slashes": times("u", "/"),
    "num_subdomains": "CASE WHEN is_ip THEN 0 ELSE greatest(len(labels) - 2, 0) END",
    "num_dots_in_domain": "greatest(len(labels) - 1, 0)",
    "has_at_symbol": "contains(u, '@')",
    "has_hyphen_in_domain": "contains(registered, '-')",
    "tld_length": "length(tld)",
    "host_digit_count": kept("host", "[^0-9]"),
    "host_hyphen_count": times("host", "-"),
    "num_host_tokens": "len(labels)",
    "longest_host_token": longest("labels"),
    "subdomain_length": "length(subdomain)",
    "uses_https": "scheme = 'https'",
    "has_port": "port <> ''",
    "has_ip_host": "is_ip",
    "num_path_segments": "len(segments)",
    "longest_path_segment": longest("segments"),
    "num_query_params": times("query", "="),
    "has_fragment": "fragment <> ''",
    "has_userinfo": "userinfo <> ''",
    "has_double_slash_redirect": "contains(path, '//')",
    "path_to_url_ratio": "CASE WHEN u = '' THEN 0 ELSE length(path) / length(u) END",
    "has_file_extension": "extension <> ''",
    "has_executable_extension": f"list_contains({words(LEX.executable_extensions)}, extension)",
    "num_encoded_chars": times("u", "%"),
    "is_shortener": f"list_has_any({words(LEX.shorteners)}, [registered, host])",
    "num_suspicious_keywords": f"len(list_filter({words(LEX.keywords)}, lambda w: contains(lower(u), w)))",
    "has_suspicious_tld": f"list_contains({words(LEX.suspicious_tlds)}, tld)",
    "brand_domain_mismatch": (
        f"len(list_filter({words(LEX.brands)}, lambda b: contains(lower(u), b))) > 0 AND "
        f"len(list_filter({words(LEX.brands)}, lambda b: registered = b OR starts_with(registered, b || '.'))) = 0"
    ),
    "digit_letter_ratio": (
        f"CASE WHEN {LETTERS} > 0 THEN {DIGITS} / {LETTERS} WHEN {DIGITS} > 0 THEN 1 ELSE 0 END"
    ),
    "domain_entropy": entropy("registered"),
    "url_entropy": entropy("u"),
    "longest_consecutive_run": "coalesce(runs.longest, 0)",
    "has_punycode": "contains(host, 'xn--')",
    "vowel_ratio_domain": (
        f"CASE WHEN {DOMAIN_LETTERS} > 0 THEN {kept('registered', '[^aeiou]')} / {DOMAIN_LETTERS} ELSE 0 END"
    ),
    "is_free_hosting": (
        f"list_contains({words(LEX.free_hosting)}, registered) OR "
        f"len(list_filter({words(LEX.free_hosting)}, lambda f: ends_with(host, '.' || f))) > 0"
    ),
    "tld_rank": f"coalesce(list_position({words(LEX.ranked_tlds)}, tld), {len(LEX.ranked_tlds) + 1}) - 1",
    "has_hex_token": r"regexp_matches(lower(u), '(^|[^\p{L}\p{N}_])[0-9a-f]{8,}([^\p{L}\p{N}_]|$)')",
    "longest_consonant_run": longest("regexp_extract_all(registered, '[bcdfghjklmnpqrstvwxz]+')"),
}


def feature_columns(names=FEATURE_NAMES) -> str:
    return ", ".join(
        f"round(CAST(CAST({FEATURES[n]} AS FLOAT) AS DOUBLE), 6) AS {n}" for n in names
    )


def features_sql(keys: str, names=FEATURE_NAMES) -> str:
    join = " LEFT JOIN runs USING (u)" if "longest_consecutive_run" in names else ""
    return f"SELECT {keys}, {feature_columns(names)} FROM parts{join}"


def feats_cte(keys: str = "url, label") -> tuple[tuple[str, str], ...]:
    return RUNS, ("feats", features_sql(keys))


PART_COLUMNS = (
    "scheme, fragment, query, path, userinfo, host, port, array_to_string(labels, '|') AS host_parts, is_ip, "
    "tld, registered, subdomain, array_to_string(segments, '|') AS segments, last_segment, extension"
)
CORPUS_PARTS = (*CLEAN, *parts_cte("corpus", "url, label"))
DOMAINS = (*CORPUS_PARTS, ("domains", "SELECT url, label, registered AS domain FROM parts"))

SCORE = """
SELECT {keep}label, p_phish, CASE WHEN p_phish >= 0.125 THEN 1 ELSE 0 END AS prediction FROM (
  SELECT *, (num_suspicious_keywords * 24 + has_suspicious_tld * 32 + brand_domain_mismatch * 24
    + is_free_hosting * 40 + has_ip_host * 24 + url_length) / 512 AS p_phish FROM feats)
"""
SCORED = (*CORPUS_PARTS, *feats_cte(), ("scored", SCORE.format(keep="url, ")))
RATES = """
  round(CASE WHEN tn + fp + fn + tp > 0 THEN (tn + tp) / (tn + fp + fn + tp) ELSE 0 END, 6) AS accuracy,
  round(CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END, 6) AS precision,
  round(CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END, 6) AS recall,
  round(CASE WHEN tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0 END, 6) AS f1
"""


def outcomes(predicted: str) -> str:
    return ", ".join(
        f"CAST(count(*) FILTER (WHERE label = {y} AND {'' if hit else 'NOT '}({predicted})) AS BIGINT) AS {cell}"
        for cell, y, hit in (("tn", 0, False), ("fp", 0, True), ("fn", 1, False), ("tp", 1, True))
    )


# AUC by ranks: average rank of the positives, with ties sharing their rank.
AUC = """
  round((sum(CASE WHEN label = 1 THEN place END) - n1 * (n1 + 1) / 2) / (n1 * n0), 6)
"""


def ranked(by: str) -> str:
    part = f"PARTITION BY {by}" if by else ""
    ties = f"PARTITION BY {by + ', ' if by else ''}p_phish"
    return f"""
    SELECT *, rank() OVER ({part} ORDER BY p_phish) + (count(*) OVER ({ties}) - 1) / 2 AS place,
      count(*) FILTER (WHERE label = 1) OVER ({part}) AS n1,
      count(*) FILTER (WHERE label = 0) OVER ({part}) AS n0
    FROM scored
    """


CURVE = """
SELECT *, sum(neg) OVER (ORDER BY p_phish DESC) AS fps, sum(pos) OVER (ORDER BY p_phish DESC) AS tps,
  lead(pos) OVER (ORDER BY p_phish DESC) AS next_pos, lead(neg) OVER (ORDER BY p_phish DESC) AS next_neg,
  row_number() OVER (ORDER BY p_phish DESC) AS i, sum(pos) OVER () AS n1, sum(neg) OVER () AS n0
FROM (SELECT p_phish, count(*) FILTER (WHERE label = 1) AS pos, count(*) FILTER (WHERE label = 0) AS neg
      FROM scored GROUP BY p_phish)
"""

# Splits by a full sort of the hash order.
ORDERED = """
SELECT *, row_number() OVER (PARTITION BY label ORDER BY md5('{salt}-42|' || url), url) AS place FROM {source}
"""


def shares(sizes: str, total: str) -> str:
    """Rows per label of a proportional selection, largest remainder first."""
    return f"""
    SELECT label, quota + CASE WHEN row_number() OVER (ORDER BY rem DESC, label) <= want - sum(quota) OVER ()
                               THEN 1 ELSE 0 END AS quota
    FROM (SELECT label, want, CAST(n AS HUGEINT) * want // whole AS quota,
                 CAST(n AS HUGEINT) * want % whole AS rem
          FROM (SELECT *, {total} AS want FROM (SELECT *, sum(n) OVER () AS whole FROM ({sizes}))))
    """


LABEL_SIZES = "SELECT label, count(*) AS n FROM corpus GROUP BY label"
SPLIT = (
    *CLEAN,
    ("sizes", LABEL_SIZES),
    ("test_size", "SELECT least(50000, min(n // 2)) AS t FROM sizes"),
    ("train_size", shares("SELECT label, n - t AS n FROM sizes, test_size",
                          "CAST(whole - ceil(0.1::DOUBLE * whole) AS BIGINT)")),
    ("placed", ORDERED.format(salt="split", source="corpus")),
    ("split", """
     SELECT url, label, CASE WHEN place <= t THEN 'test' WHEN place <= n - quota THEN 'val' ELSE 'train' END AS split
     FROM placed JOIN sizes USING (label) JOIN train_size USING (label), test_size
     """),
)
DISJOINT = (
    *CLEAN,
    ("keyed", f"""
     SELECT url, label, CASE WHEN list_contains({words(LEX.suffixes)}, array_to_string(p[-2:], '.'))
       THEN array_to_string(p[-3:], '.') ELSE array_to_string(p[-2:], '.') END AS domain
     FROM (SELECT *, string_split(split_part(url, '/', 1), '.') AS p FROM corpus)
     """),
    ("held", """
     SELECT domain FROM (SELECT domain, row_number() OVER (ORDER BY md5('domain-42|' || domain), domain) AS place,
                           count(*) OVER () AS n FROM (SELECT DISTINCT domain FROM keyed))
     WHERE place <= CAST(floor(n * 0.15::DOUBLE) AS BIGINT)
     """),
    ("placed", ORDERED.format(salt="split", source="keyed WHERE domain IN (SELECT domain FROM held)")),
    ("per_class", """
     SELECT least(50000, count(*) FILTER (WHERE label = 0), count(*) FILTER (WHERE label = 1)) AS t FROM placed
     """),
)


def rule_sql(form: str, source: str) -> str:
    return " UNION ALL ".join(
        f"""
        SELECT '{form}' AS form, '{name}' AS rule,
          round(avg(CASE WHEN label = 1 THEN CAST(({test}) AS INTEGER) END) * 100, 6) AS phishing_pct,
          round(avg(CASE WHEN label = 0 THEN CAST(({test}) AS INTEGER) END) * 100, 6) AS legitimate_pct,
          round(avg(CAST(({test}) = (label = 1) AS INTEGER)) * 100, 6) AS accuracy_pct,
          round(greatest(avg(label), 1 - avg(label)) * 100, 6) AS baseline_pct
        FROM {source} WHERE url IS NOT NULL
        """
        for name, test in {
            "has_scheme": "url LIKE '%://%'", "ends_with_slash": "url LIKE '%/'"
        }.items()
    )


assert set(COLLECTION_RULES) == {"has_scheme", "ends_with_slash"}

RATES_BY_DOMAIN = """
SELECT domain, count(*) AS n, CAST(sum(label) AS BIGINT) AS phishing, round(avg(label), 6) AS phishing_share
FROM domains GROUP BY domain
"""


def per_feature(select: str, source: str = "feats") -> str:
    return " UNION ALL ".join(
        f"SELECT '{n}' AS feature, {select.format(n=n)} FROM {source}" for n in FEATURE_NAMES
    )


CURVE_QUOTAS = " UNION ALL ".join(
    f"SELECT {i} AS step, label, quota FROM "
    f"({shares(LABEL_SIZES, f'CAST(floor({fraction}::DOUBLE * whole) AS BIGINT)')})"
    for i, fraction in enumerate((0.1, 0.25, 0.5, 1.0))
)

CORPUS_SELECT = with_ctes("SELECT url, CAST(label AS TINYINT) AS label FROM corpus", *CLEAN)

SCORED_MANY = (
    RAW_MANY, CANON, PAIRS, CORPUS,
    ("scored", "SELECT label, (length(url) * 65536 + ('0x' || substr(md5(url), 1, 4))::INT) / 16777216 AS p_phish "
               "FROM corpus"),
)
ROC_POINTS = """
SELECT 0.0::DOUBLE AS fpr, 0.0::DOUBLE AS tpr, 'inf'::DOUBLE AS threshold
UNION ALL
SELECT round(fps / n0, 6), round(tps / n1, 6), round(p_phish, 6) FROM curve
WHERE i = 1 OR next_pos IS NULL OR next_pos <> pos OR next_neg <> neg
"""
MODELS = "(SELECT unnest(['random_forest', 'boosted_trees']) AS model)"
FAMILY_NAMES = " UNION ALL ".join(
    f"SELECT '{family}' AS family, unnest({words(names)}) AS feature" for family, names in FEATURE_FAMILIES.items()
)
# How often each feature fires, on the corpus and on the pages' addresses.
FIRES = "SELECT 'corpus' AS model, * FROM ({corpus}) UNION ALL SELECT 'pages', * FROM ({pages})"
CONFIGS = (
    ("all_features", 47), ("only_lexical", 20), ("only_structural", 13), ("only_suspicion", 14),
    ("without_lexical", 27), ("without_structural", 34), ("without_suspicion", 33),
)
N_TRAIN = "(SELECT count(*) FROM split WHERE split = 'train')"
FAMILY_STUDY = f"""
SELECT 'feature_group' AS study, config, model, n_features::INT AS n_features, {N_TRAIN} AS train_rows
FROM (VALUES {", ".join(map(str, CONFIGS))}) c(config, n_features), {MODELS}
"""
SIZE_STUDY = f"""
SELECT 'training_size' AS study, pct || 'pct' AS config, model, 47 AS n_features,
  CAST(floor((pct / 100.0)::DOUBLE * {N_TRAIN}) AS BIGINT) AS train_rows
FROM (SELECT unnest([10, 25, 50, 100]) AS pct), {MODELS}
"""
STRATEGY_STUDY = f"""
SELECT 'split_strategy' AS study, 'domain_disjoint' AS config, model, 47 AS n_features,
  (SELECT count(*) FROM keyed WHERE domain NOT IN (SELECT domain FROM held)) AS train_rows FROM {MODELS}
"""
KEPT = "true AS rates_ok, true AS timed"


def fires_ctes() -> tuple[tuple[str, str], ...]:
    """CTE ``fires``: model, feature, importance."""
    share = "avg(CASE WHEN {n} <> 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS importance"
    by_source = {}
    for source, keys in (("corpus", "url, label"), ("pages", "page_id")):
        relation = "corpus" if source == "corpus" else "(SELECT page_id, url FROM pages)"
        inner = with_ctes(
            per_feature(share), *parts_cte(relation, keys), RUNS, ("feats", features_sql(keys))
        )
        by_source[source] = inner
    return (*CLEAN, ("fires", FIRES.format(**by_source)))


MAILED = (
    "mailed", "SELECT CASE WHEN length(url) % 2 = 0 THEN 'mail.' || url ELSE url END AS url, label FROM corpus"
)


def suffix_ctes(rules) -> tuple[tuple[str, str], ...]:
    """CTE ``ruled``: parts of ``mailed`` with ``domain`` by every suffix of a host joined to a table of rules."""
    kinds = {"*": "wildcard", "!": "exception"}
    rows = ", ".join(f"('{kinds.get(r[0], 'plain')}', '{r.lstrip('*!').lstrip('.')}')" for r in rules)
    tails = """
    SELECT host, labels, d, array_to_string(labels[-d:], '.') AS tail
    FROM (SELECT host, labels, unnest(range(1, len(labels) + 1)) AS d FROM (SELECT DISTINCT host, labels FROM parts))
    """
    depths = f"""
    SELECT host, max(CASE WHEN kind = 'exception' THEN d - 1 END) AS excepted,
      max(CASE WHEN kind = 'plain' THEN d WHEN kind = 'wildcard' AND len(labels) > d THEN d + 1 END) AS matched
    FROM tails JOIN (VALUES {rows}) AS rules(kind, rule) ON rule = tail GROUP BY host
    """
    ruled = """
    SELECT url, label, host, CASE WHEN is_ip THEN '' ELSE
      array_to_string(labels[-(coalesce(excepted, matched, 1) + 1):], '.') END AS domain
    FROM parts LEFT JOIN depths USING (host)
    """
    return (*CLEAN, MAILED, *parts_cte("mailed", "url, label"), ("tails", tails), ("depths", depths), ("ruled", ruled))


KEYWORD_CTES = (
    RAW, *parts_cte("raw", "row_id"),
    ("short", "SELECT DISTINCT substr(md5(o_orderkey::VARCHAR), 1, 4) AS w FROM orders"),
    ("long", "SELECT DISTINCT substr(md5(o_orderkey::VARCHAR), 7, 5) AS w FROM orders"),
    *(
        (f"in_{name}", f"""
        SELECT row_id, count(*) AS n FROM (SELECT row_id, unnest(list_distinct(list_transform(
          range(1, length(u) - {size} + 2), lambda i: substr(lower(u), i, {size})))) AS w FROM parts)
        JOIN {name} USING (w) GROUP BY row_id
        """)
        for name, size in (("short", 4), ("long", 5))
    ),
)
RULE_COLUMNS = (*FEATURE_NAMES, *COLLECTION_RULES)
RULE_CTES = (
    RAW, ("known_rows", "SELECT row_id, url, label FROM raw WHERE url IS NOT NULL"), *parts_cte("known_rows", "row_id, label"), RUNS,
    ("feats", features_sql("row_id, label, contains(u, '://')::INT AS has_scheme, (u LIKE '%/')::INT AS ends_with_slash")),
    ("long", "SELECT label, unnest([" + ", ".join(f"{{'f': '{n}', 'v': {n}::DOUBLE}}" for n in RULE_COLUMNS) + "]) AS r FROM feats"),
    ("points", "SELECT r.f AS f, r.v AS v, count(*) FILTER (WHERE label = 1) AS pos, count(*) FILTER (WHERE label <> 1) AS neg "
               "FROM long GROUP BY ALL"),
    ("running", "SELECT f, v, sum(pos) OVER (PARTITION BY f ORDER BY v DESC) AS tp, sum(neg) OVER (PARTITION BY f ORDER BY v DESC) AS fp, "
                "sum(pos) OVER (PARTITION BY f) AS p, sum(neg) OVER (PARTITION BY f) AS n FROM points"),
    ("turns", "SELECT f, v, '>=' AS direction, 0 AS turn, tp, fp, p, n, tp + n - fp AS good FROM running UNION ALL "
             "SELECT f, v, '<', 1, p - tp, n - fp, p, n, p + fp - tp FROM running"),
)


ORACLES: dict[str, str] = {
    "shards": with_ctes("SELECT url, CAST(label AS TINYINT) AS label FROM raw", RAW),
    "canonical_steps": with_ctes(
        "SELECT row_id, url, trimmed, bare, unslashed, canonical FROM canon", RAW, CANON
    ),
    "nonempty_urls": with_ctes(
        "SELECT row_id, canonical AS url, label FROM canon WHERE canonical <> ''", RAW, CANON
    ),
    "distinct_pairs": with_ctes("SELECT url, label FROM pairs", RAW, CANON, PAIRS),
    "corpus_clean": CORPUS_SELECT,
    "corpus_clean_many": with_ctes(
        "SELECT url, CAST(label AS TINYINT) AS label FROM corpus", RAW_MANY, CANON, PAIRS, CORPUS
    ),
    "corpus_audit": with_ctes(
        """
        SELECT raw_rows, raw_rows - nonempty AS missing_rows, nonempty - n_pairs AS duplicate_rows,
          n_pairs - final_rows AS conflict_rows, final_rows, legitimate_rows, phishing_rows,
          round(legitimate_rows * 100 / final_rows, 6) AS legitimate_pct,
          round(phishing_rows * 100 / final_rows, 6) AS phishing_pct
        FROM (SELECT (SELECT count(*) FROM canon) AS raw_rows,
                (SELECT count(*) FROM canon WHERE canonical <> '') AS nonempty,
                (SELECT count(*) FROM pairs) AS n_pairs, (SELECT count(*) FROM corpus) AS final_rows,
                (SELECT count(*) FROM corpus WHERE label = 0) AS legitimate_rows,
                (SELECT count(*) FROM corpus WHERE label = 1) AS phishing_rows)
        """,
        *CLEAN,
    ),
    "corpus_store": CORPUS_SELECT,
    "corpus_csv": CORPUS_SELECT,
    "url_parts": with_ctes(f"SELECT row_id, {PART_COLUMNS} FROM parts", RAW, *parts_cte("raw", "row_id")),
    "page_parts": with_ctes(f"SELECT page_id, {PART_COLUMNS} FROM parts", *parts_cte("pages", "page_id")),
    **{
        f"features_{family}": with_ctes(
            features_sql("row_id", names), RAW, *parts_cte("raw", "row_id"), RUNS
        )
        for family, names in FEATURE_FAMILIES.items()
    },
    "feature_table": with_ctes(features_sql("row_id"), RAW_MANY, *parts_cte("raw", "row_id"), RUNS),
    "corpus_features": with_ctes(
        features_sql("url, CAST(label AS TINYINT) AS label"),
        RAW_MANY, CANON, PAIRS, CORPUS, *parts_cte("corpus", "url, label"), RUNS,
    ),
    "page_features": with_ctes(
        features_sql("page_id, u AS canonical_url"),
        ("raw", "SELECT page_id, url FROM pages"), CANON, *parts_cte("canon", "page_id", "canonical"), RUNS,
    ),
    "feature_store": with_ctes(
        features_sql("url, CAST(label AS TINYINT) AS label"), *CORPUS_PARTS, RUNS
    ),
    "feature_store_delta": with_ctes(
        features_sql("url, CAST(label AS TINYINT) AS label"),
        *CLEAN, ("newer", "SELECT url, label FROM corpus WHERE url NOT LIKE '%88%'"),
        *parts_cte("newer", "url, label"), RUNS,
    ),
    "corpus_merge": CORPUS_SELECT,
    "suffix_rules": with_ctes(
        "SELECT url, host, domain AS registered, CASE WHEN domain = '' THEN '' ELSE "
        "left(host, greatest(length(host) - length(domain) - 1, 0)) END AS subdomain FROM ruled",
        *suffix_ctes(SUFFIX_RULES),
    ),
    "suffix_rule_domains": with_ctes(RATES_BY_DOMAIN.replace("domains", "ruled"), *suffix_ctes(SUFFIX_RULES)),
    "keyword_scan": with_ctes(
        """
        SELECT row_id, coalesce(s.n, 0)::DOUBLE AS num_suspicious_keywords,
          (l.n IS NOT NULL AND split_part(registered, '.', 1) NOT IN (SELECT w FROM long))::INT::DOUBLE
            AS brand_domain_mismatch
        FROM parts LEFT JOIN in_short s USING (row_id) LEFT JOIN in_long l USING (row_id)
        """,
        *KEYWORD_CTES,
    ),
    "split_train_val_test": with_ctes(
        "SELECT url, CAST(label AS TINYINT) AS label, split FROM split", *SPLIT
    ),
    "stratified_sample": with_ctes(
        "SELECT url, CAST(label AS TINYINT) AS label FROM placed JOIN quotas USING (label) WHERE place <= quota",
        *CLEAN, ("quotas", shares(LABEL_SIZES, "least(500, whole)")),
        ("placed", ORDERED.format(salt="sample", source="corpus")),
    ),
    "curve_steps": with_ctes(
        """
        SELECT url, CAST(label AS TINYINT) AS label, CAST(count(*) FILTER (WHERE place > quota) AS INTEGER) AS step
        FROM placed JOIN quotas USING (label) GROUP BY url, label
        """,
        *CLEAN, ("quotas", CURVE_QUOTAS), ("placed", ORDERED.format(salt="sample", source="corpus")),
    ),
    "kfold": with_ctes(
        """
        SELECT url, CAST(label AS TINYINT) AS label,
          CAST(ntile(3) OVER (PARTITION BY label ORDER BY md5('fold-42|' || url), url) - 1 AS INTEGER) AS fold
        FROM corpus
        """,
        *CLEAN,
    ),
    "split_domain_disjoint": with_ctes(
        """
        SELECT k.url, CAST(k.label AS TINYINT) AS label, k.domain,
          CASE WHEN p.place IS NULL THEN 'train' WHEN p.place <= t THEN 'test' ELSE 'unused' END AS split
        FROM keyed k LEFT JOIN placed p ON k.url = p.url, per_class
        """,
        *DISJOINT,
    ),
    "metrics_binary": with_ctes(
        f"SELECT {RATES} FROM (SELECT {outcomes('prediction = 1')} FROM scored)", *SCORED
    ),
    "metrics_by_scheme": with_ctes(
        f"SELECT scheme, {RATES}, roc_auc FROM (SELECT scheme, {outcomes('prediction = 1')} FROM scored GROUP BY scheme) "
        f"JOIN (SELECT scheme, {AUC} AS roc_auc FROM ({ranked('scheme')}) GROUP BY scheme, n1, n0) USING (scheme)",
        RAW, *parts_cte("raw", "label"), RUNS, ("feats", features_sql("scheme, label")),
        ("scored", SCORE.format(keep="scheme, ")),
    ),
    "roc_auc": with_ctes(f"SELECT {AUC} AS roc_auc FROM ({ranked('')}) GROUP BY n1, n0", *SCORED),
    "confusion": with_ctes(
        """
        SELECT CAST(actual AS INTEGER) AS actual, CAST(predicted AS INTEGER) AS predicted, count(label) AS n,
          round(count(label) * 100 / (SELECT count(*) FROM scored), 6) AS pct
        FROM (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) c(actual, predicted)
        LEFT JOIN scored ON label = actual AND prediction = predicted GROUP BY actual, predicted
        """,
        *SCORED,
    ),
    "roc_curve": with_ctes(
        """
        SELECT 0.0::DOUBLE AS fpr, 0.0::DOUBLE AS tpr, 'inf'::DOUBLE AS threshold
        UNION ALL
        SELECT round(fps / n0, 6), round(tps / n1, 6), round(p_phish, 6) FROM curve
        WHERE i = 1 OR next_pos IS NULL OR next_pos <> pos OR next_neg <> neg
        """,
        *SCORED, ("curve", CURVE),
    ),
    "threshold_sweep": with_ctes(
        f"SELECT threshold, tn, fp, fn, tp, {RATES} FROM ("
        f"SELECT threshold, {outcomes('p_phish >= threshold')} FROM scored, "
        f"(SELECT unnest({list(SWEEP_THRESHOLDS)}::DOUBLE[]) AS threshold) GROUP BY threshold)",
        *SCORED,
    ),
    "threshold_choice": with_ctes(
        """
        SELECT wanted, round(threshold, 6) AS threshold, round(tp / (tp + fp), 6) AS precision,
          round(tp / n1, 6) AS recall, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp
        FROM wishes LEFT JOIN (
          SELECT wanted AS w, p_phish AS threshold, tp, fp, n1 FROM points, wishes WHERE tp >= wanted * (tp + fp)
          QUALIFY row_number() OVER (PARTITION BY wanted ORDER BY tp DESC, p_phish DESC) = 1) ON w = wanted
        """,
        *SCORED_MANY, ("wishes", f"SELECT unnest({list(WANTED_PRECISIONS)}::DOUBLE[]) AS wanted"),
        ("points", """
        SELECT p_phish, sum(pos) OVER (ORDER BY p_phish DESC) AS tp, sum(neg) OVER (ORDER BY p_phish DESC) AS fp,
          sum(pos) OVER () AS n1
        FROM (SELECT p_phish, count(*) FILTER (WHERE label = 1) AS pos, count(*) FILTER (WHERE label <> 1) AS neg
              FROM scored GROUP BY p_phish)
        """),
    ),
    "verdicts": with_ctes(
        "SELECT CASE WHEN prediction = 1 THEN 'PHISHING' ELSE 'legitimate' END AS verdict, "
        "round(p_phish, 4) AS p, url FROM scored",
        *SCORED,
    ),
    "rule_audit": with_ctes(rule_sql("raw", "raw") + " UNION ALL " + rule_sql("clean", "corpus"), *CLEAN),
    "rule_search": with_ctes(
        """
        SELECT f AS feature, direction, round(v, 6) AS threshold, round(tp * 100 / p, 6) AS phishing_pct,
          round(fp * 100 / n, 6) AS legitimate_pct, round(good * 100 / (p + n), 6) AS accuracy_pct,
          round(greatest(p, n) * 100 / (p + n), 6) AS baseline_pct,
          round(good * 100 / (p + n) - greatest(p, n) * 100 / (p + n), 6) AS gain_pct
        FROM turns QUALIFY row_number() OVER (PARTITION BY f ORDER BY good DESC, turn, v) = 1
        """,
        *RULE_CTES,
    ),
    "class_balance": with_ctes(
        """
        SELECT split, CAST(label AS TINYINT) AS label, n, round(n / sum(n) OVER w, 6) AS share,
          round(max(n) OVER w / sum(n) OVER w, 6) AS majority_share
        FROM (SELECT split, label, count(*) AS n FROM split GROUP BY split, label) WINDOW w AS (PARTITION BY split)
        """,
        *SPLIT,
    ),
    "domain_rates": with_ctes(RATES_BY_DOMAIN, *DOMAINS),
    "skewed_domains": with_ctes(
        f"SELECT * FROM ({RATES_BY_DOMAIN}) ORDER BY abs(phishing / n - 0.5) DESC, n DESC, domain LIMIT 20",
        *DOMAINS,
    ),
    "domain_ceiling": with_ctes(
        """
        SELECT count(*) AS domains, CAST(sum(n) AS BIGINT) AS n, round(sum(top) / sum(n), 6) AS ceiling
        FROM (SELECT domain, sum(c) AS n, max(c) AS top
              FROM (SELECT domain, label, count(*) AS c FROM domains GROUP BY domain, label) GROUP BY domain)
        """,
        *DOMAINS,
    ),
    "fire_rates": with_ctes(
        per_feature("round(avg(CASE WHEN {n} <> 0 THEN 1.0 ELSE 0.0 END), 6) AS fire_share, "
                    "count(DISTINCT {n}) = 1 AS is_constant"),
        *CORPUS_PARTS, *feats_cte(),
    ),
    "feature_contract": with_ctes(
        per_feature("count(*) FILTER (WHERE {n} IS NULL) AS nulls, count(*) FILTER (WHERE isnan({n})) AS nans, "
                    "count(*) FILTER (WHERE isinf({n})) AS infinities"),
        RAW, *parts_cte("raw", "row_id"), *feats_cte("row_id"),
    ),
    "domain_overlap": with_ctes(
        """
        SELECT count(*) AS tested_rows, count(*) FILTER (WHERE seen) AS shared_rows,
          round(count(*) FILTER (WHERE seen) / count(*), 6) AS overlap_share
        FROM (SELECT registered IN (SELECT registered FROM parts JOIN split USING (url) WHERE split = 'train') AS seen
              FROM parts JOIN split USING (url) WHERE split = 'test')
        """,
        *SPLIT, *parts_cte("corpus", "url"),
    ),
    "roc_auc_many": with_ctes(
        f"SELECT {AUC} AS roc_auc FROM ({ranked('')}) GROUP BY n1, n0", *SCORED_MANY
    ),
    "roc_curve_many": with_ctes(ROC_POINTS, *SCORED_MANY, ("curve", CURVE)),
    "importance_pivot": with_ctes(
        """
        SELECT feature, round(max(importance) FILTER (WHERE model = 'corpus'), 6) AS corpus,
          round(max(importance) FILTER (WHERE model = 'pages'), 6) AS pages
        FROM fires GROUP BY feature
        """,
        *fires_ctes(),
    ),
    "importance_top": with_ctes(
        """
        SELECT model, feature, round(importance, 6) AS importance, CAST(place AS INTEGER) AS place
        FROM (SELECT *, row_number() OVER (PARTITION BY model ORDER BY importance DESC, feature) AS place FROM fires)
        WHERE place <= 20
        """,
        *fires_ctes(),
    ),
    "family_fires": with_ctes(
        f"""
        SELECT model, family, round(sum(importance), 6) AS share,
          round(sum(CASE WHEN place <= 3 THEN importance ELSE 0 END), 6) AS top_share
        FROM (SELECT *, row_number() OVER (PARTITION BY model ORDER BY importance DESC, feature) AS place FROM fires)
        JOIN ({FAMILY_NAMES}) USING (feature) GROUP BY model, family
        """,
        *fires_ctes(),
    ),
    # What is known of a fit beforehand.
    "tuning": "SELECT CAST(range AS INTEGER) AS draw, true AS in_space, true AS f1_ok, true AS best_is_best FROM range(3)",
    "training_summary": with_ctes(
        f"""
        SELECT model, {", ".join(f"(SELECT count(*) FROM split WHERE split = '{s}') AS n_{s}" for s in ("train", "val", "test"))},
          47::BIGINT AS n_features, true AS reported_is_fitted, true AS rates_ok, true AS better_than_chance
        FROM {MODELS}
        """,
        *SPLIT,
    ),
    "scored_pages": with_ctes(
        "SELECT page_id, coalesce(canonical, '') AS canonical_url, true AS p_ok, true AS prediction_ok FROM canon",
        ("raw", "SELECT page_id, url FROM pages"), CANON,
    ),
    "scored_repeats": with_ctes(
        "SELECT row_id, coalesce(canonical, '') AS canonical_url, true AS same FROM canon",
        ("orders_raw", ORDERS_SQL),
        ("raw", "SELECT row_id, CASE WHEN row_id % 3 = 0 THEN 'https://github.com/' ELSE url END AS url FROM orders_raw"),
        CANON,
    ),
    "evaluation": with_ctes(
        f"""
        SELECT model, (SELECT count(*) FROM split WHERE split = 'test') AS tested,
          (SELECT count(*) FROM split WHERE split = 'test' AND label = 1) AS positives, true AS starts_at_0,
          true AS ends_at_1, true AS rates_ok, true AS better_than_chance FROM {MODELS}
        """,
        *SPLIT,
    ),
    "importances": f"SELECT feature, true AS weights_ok, true AS sums_ok FROM ({FAMILY_NAMES})",
    "strongest_features": f"SELECT model, CAST(range AS INTEGER) AS place, true AS falling FROM {MODELS}, range(1, 21)",
    "family_importance": (
        f"SELECT model, family, true AS sums_ok, true AS top_ok FROM {MODELS}, (SELECT DISTINCT family FROM ({FAMILY_NAMES}))"
    ),
    "family_ablation": with_ctes(f"SELECT *, {KEPT} FROM ({FAMILY_STUDY})", *SPLIT),
    "learning_curve": with_ctes(f"SELECT model, train_rows, true AS gains_ok FROM ({SIZE_STUDY})", *SPLIT),
    "split_strategy": f"SELECT model, true AS gap_ok, true AS f1_ok FROM {MODELS}",
    "ablation": with_ctes(
        f"SELECT *, {KEPT} FROM ({FAMILY_STUDY} UNION ALL {SIZE_STUDY} UNION ALL {STRATEGY_STUDY})",
        *SPLIT, *(c for c in DISJOINT if c not in CLEAN and c[0] in ("keyed", "held")),
    ),
}
ORACLES["corpus_merge_audit"] = ORACLES["corpus_audit"]

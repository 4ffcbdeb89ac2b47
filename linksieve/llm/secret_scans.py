"""Secret scans: fixed patterns, and a test of token efficiency for what has no pattern.

Fixed patterns find assignments of credentials, access key ids and long hex strings. The
token-efficiency test looks at every other unbroken run of letters, digits and ``+/_-``, with one
or two ``=`` that pad its end, wherever it stands, also after the ``=`` of an assignment: prose, code
and names were seen when a vocabulary was made and take few tokens, a random string takes
about one for every two characters. So the ratio decides: a run with few characters per token is
reported as ``random``, unless it is a known digest or identifier: no letters (dates, numbers), a hex
digest or UUID, or parts joined by ``_``, ``-``, ``+`` or ``/`` none of which is costly by itself.
A part of a span of a fixed pattern stays as it is.

Positions are in code points, end exclusive. Null and empty texts have no spans. Texts of any
length are scanned whole, each row for itself, so repeated rows get the same spans.
"""

from __future__ import annotations

import base64
import hashlib
import re

import public_tokenizers
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField

from linksieve.llm.texts import column, remembered, text_columns

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")

#: A run with fewer characters per token than this is a random string.
CHARS_PER_TOKEN = 2.4
#: The same for letters only, as rare and made-up words cost more than known ones.
LETTERS_PER_TOKEN = 1.9

#: The shortest run that is tested.
SHORTEST = 20

# The patterns of the base scan, and the order of kinds.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.ASCII | re.IGNORECASE,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "random")

RUN = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{%d,}+(?:={1,2}(?![A-Za-z0-9+/=_-]))?" % SHORTEST)
HAS_LETTER = re.compile("[A-Za-z]")
DIGEST = re.compile(
    "(?:0x)?(?:[0-9a-f]+|[0-9A-F]+)|[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}"  # and UUID
)
JOINTS = re.compile("[_/+-]+")
#: Parts of a joined run below this length say nothing; a number after a word is not part of it.
SHORTEST_PART = 6
NUMBERED = re.compile("[0-9]{0,4}$")

Span = tuple[str, int, int]


def base_spans(text: str) -> list[Span]:
    """Spans of the fixed patterns, by start and kind."""
    spans = []
    lower = text.lower()  # only to see quickly whether a scan is worth while
    if any(word in lower for word in ("passw", "secret", "token", "api")):
        spans += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        spans += [("access", *m.span()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    spans += [("hex", *m.span()) for m in HEX.finditer(text)]
    return ordered(spans)


def ordered(spans: list[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0])))


class Efficiency:
    """Characters per token under the vocabulary of a tiktoken rank file."""

    def __init__(self, path: str):
        with open(path, "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        self.encoding = tiktoken.Encoding(
            "secrets", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )

    def ratio(self, string: str) -> float:
        return len(string) / len(self.encoding.encode_ordinary(string))

    def costly(self, string: str) -> bool:
        """Whether a string takes as many tokens as a random one."""
        limit = LETTERS_PER_TOKEN if string.isalpha() else CHARS_PER_TOKEN
        return bool(string) and self.ratio(string) < limit

    def is_random(self, run: str) -> bool:
        """A costly run of no known form. A joined one needs a costly part, as names are joined from words."""
        if not HAS_LETTER.search(run) or not self.costly(run):
            return False
        body = run.rstrip("=")
        if DIGEST.fullmatch(body):
            return False
        parts = JOINTS.split(body)
        if len(parts) == 1:
            return True
        words = [NUMBERED.sub("", p, count=1) for p in parts]
        return any(len(w) >= SHORTEST_PART and HAS_LETTER.search(w) and self.costly(w) for w in words)

    def random_spans(self, text: str, base: list[Span]) -> list[Span]:
        """Runs that are costly in tokens, no known form, and in no span of ``base``."""
        found = []
        for match in RUN.finditer(text):
            start, end = match.span()
            if any(s < end and start < e for _, s, e in base):
                continue
            if self.is_random(match[0]):
                found.append(("random", start, end))
        return found


def loaded(path: str) -> Efficiency:
    return remembered(("efficiency", path), lambda: Efficiency(path))


def joined(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def scan(df: DataFrame, text: str = "text", keep: list[str] | None = None, ranks: str = RANKS) -> DataFrame:
    """``df`` and ``base_spans``, ``spans``: comma-joined ``kind:start:end`` by start."""

    def make():
        efficiency = loaded(ranks)

        def compute(texts):
            base = [base_spans(t or "") for t in texts]
            spans = [ordered(b + efficiency.random_spans(t or "", b)) for t, b in zip(texts, base)]
            return [list(map(joined, base)), list(map(joined, spans))]

        return compute

    fields = [StructField("base_spans", StringType()), StructField("spans", StringType())]
    return text_columns(df, make, fields, text, keep)


def counts(df: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Counts per kind, a digest of the base spans, and all spans."""
    found = scan(df, text, [key])

    def count(kind: str):
        own = F.filter(F.split("base_spans", ","), lambda s: s.startswith(f"{kind}:"))
        return F.size(own).cast("long").alias(f"n_{kind}")

    return found.select(
        column(key),
        *map(count, KINDS[:3]),
        F.sha2("base_spans", 256).alias("base_sha256"),
        "spans",
    )


def redacted(text: str, spans: list[Span]) -> str:
    """``text`` with every span, overlapping ones as one, replaced by its first kind in brackets."""
    parts, at = [], 0
    for kind, start, end in spans:
        if start >= at:
            parts += [text[at:start], f"[{kind}]"]
        at = max(at, end)
    return "".join([*parts, text[at:]])


def redact(df: DataFrame, text: str = "text", ranks: str = RANKS) -> DataFrame:
    """All rows and columns of ``df``; secrets in the text replaced. Null text stays null."""

    def make():
        efficiency = loaded(ranks)

        def compute(texts):
            made = []
            for t in texts:
                base = base_spans(t or "")
                made.append(t and redacted(t, ordered(base + efficiency.random_spans(t, base))))
            return [made]

        return compute

    made = text_columns(df, make, [StructField("\x00redacted", StringType())], text)
    return made.select(*(column("\x00redacted" if c == text else c).alias(c) for c in df.columns))

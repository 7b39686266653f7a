"""Secrets in texts: keyword prefilter, anchored expressions near hits, checksums."""

from __future__ import annotations

import re
import zlib

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "github", "npm")
SPAN = T.StructType().add("kind", T.StringType()).add("start", T.LongType()).add("end", T.LongType())

ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
# keyword, in lower case -> kind
KEYWORDS = (
    {word: "assign" for word in ASSIGN_WORDS}
    | {"akia": "access", "npm_": "npm"}
    | {f"gh{letter}_": "github" for letter in "pousr"}
)
ASSIGN = re.compile(
    r"(?:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
    re.IGNORECASE | re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
# a run of hex digits has no keyword; short runs fail anyway and end where they begin to differ
HEX = re.compile(r"[0-9a-f]{24,}")
CHECKED = {
    "github": re.compile(r"gh[pousr]_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])"),
    "npm": re.compile(r"npm_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])"),
}
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
ASCII_LOWER = {c: c + 32 for c in range(65, 91)}


def checksum_holds(body: str, check: str) -> bool:
    """The last six characters of such a token are the CRC32 of the others, in base 62."""
    value = 0
    for letter in check:
        value = value * 62 + BASE62.index(letter)
    return value == zlib.crc32(body.encode())


def automaton() -> ahocorasick.Automaton:
    made = ahocorasick.Automaton()
    for word, kind in KEYWORDS.items():
        made.add_word(word, (len(word), kind))
    made.make_automaton()
    return made


def find(text: str, words: ahocorasick.Automaton) -> list[tuple[str, int, int]]:
    """Confirmed (kind, start, end) of one text, by start, then kind."""
    lower = text.lower()
    if len(lower) != len(text):
        lower = text.translate(ASCII_LOWER)
    found, ended = [], dict.fromkeys(KINDS, 0)
    hits = [(end - size + 1, kind) for end, (size, kind) in words.iter(lower)]
    for start, kind in sorted(hits) if len(hits) > 1 else hits:
        if start < ended[kind]:
            continue
        pattern = ASSIGN if kind == "assign" else ACCESS if kind == "access" else CHECKED[kind]
        match = pattern.match(text, start)
        if not match:
            continue
        ended[kind] = match.end()
        if kind == "assign":
            real = match.end(1) - match.start(1) >= 6
        elif kind == "access":
            real = match.end() - start >= 20
        else:
            real = checksum_holds(*match.groups())
        if real:
            found.append((kind, start, match.end()))
    found += [("hex", *match.span()) for match in HEX.finditer(text)]
    found.sort(key=lambda span: (span[1], KINDS.index(span[0])))
    return found


@F.pandas_udf(T.ArrayType(SPAN))
def _spans(texts: pd.Series) -> pd.Series:
    words = automaton()
    return pd.Series(
        [
            [{"kind": k, "start": s, "end": e} for k, s, e in find(text, words)] if text else []
            for text in texts
        ]
    )


@F.pandas_udf(T.StringType())
def _masked(texts: pd.Series) -> pd.Series:
    words = automaton()

    def mask(text: str | None) -> str | None:
        if not text:
            return text
        parts, at = [], 0
        for kind, start, end in find(text, words):
            if start >= at:
                parts += [text[at:start], f"[{kind}]"]
            at = max(at, end)
        return "".join([*parts, text[at:]])

    return pd.Series([mask(text) for text in texts], dtype=object)


def with_secrets(df: DataFrame, text: str = "text", out: str = "secrets") -> DataFrame:
    """Add a column ``out``: array<struct<kind,start,end>>, by start, then kind.

    Offsets are code points, ends exclusive. Text is searched whole: the keyword automaton
    runs over all of it, expressions only start at its hits (runs of hex digits have no
    keyword and are searched for directly). NULL and empty texts have no spans. Rows are
    neither dropped nor moved; repeated rows, NULLs elsewhere and other columns do not
    matter, a column named like ``out`` is replaced.
    """
    return df.withColumn(out, _spans(F.col(text)))


def mask_secrets(df: DataFrame, text: str = "text") -> DataFrame:
    """Replace every secret by its kind in brackets; overlapping spans by the first one.

    A column ``n_chars``, if there is one, follows the text.
    """
    masked = df.withColumn(text, _masked(F.col(text)))
    if "n_chars" not in df.columns:
        return masked
    kind = df.schema["n_chars"].dataType
    changed = F.when(F.col(text).isNotNull(), F.char_length(text).cast(kind)).otherwise(F.col("n_chars"))
    return masked.withColumn("n_chars", changed)


def written(spans: Column, *kinds: str) -> Column:
    kept = F.filter(spans, lambda s: s["kind"].isin(*kinds)) if kinds else spans
    return F.array_join(
        F.transform(kept, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )


def report(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: counts by base kind, digest of base spans, all spans."""
    found = with_secrets(df.select(F.col(key).alias("doc_id"), F.col(text).alias("text")))

    def count(kind: str) -> Column:
        return F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *(count(kind) for kind in BASE_KINDS),
        F.sha2(written(F.col("secrets"), *BASE_KINDS), 256).alias("base_sha256"),
        written(F.col("secrets")).alias("spans"),
    )

"""Personal data in texts, found with SQL functions alone.

Regular expressions propose spans, checksums confirm cards (Luhn) and bank account
numbers (mod 97), and words before and after a span move its score.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "ssn")
CONTEXT_CHARS = 40
REPORTED_SCORE = 0.6
# What may stand between two members of a list.
SEPARATOR = r"^[^\p{L}\p{N}]*+(?:(?:and|or)[^\p{L}\p{N}]*+)?$"

# A match can only begin where its first run of characters does (or where the match
# before it ended), and runs never give characters back. Both leave the leftmost
# matches as they are and keep the search linear and free of recursion.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?:\x20[A-Z0-9]{4}){2,7}"
    r"(?:\x20[A-Z0-9]{1,3})?)(?![A-Za-z0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
}
# kind -> (score of a confirmed span, words that raise it, gain)
SCORES = {
    "email": (0.8, "mail|contact|write to", 0.15),
    "ip": (0.6, "address|server|host|ip", 0.3),
    "card": (0.7, "card|visa|credit|payment", 0.25),
    "phone": (0.6, "phone|call|tel|mobile|fax", 0.3),
    "iban": (0.9, "iban|account|bank", 0.1),
    "ssn": (0.3, "ssn|social security|tax id", 0.5),
}
# Words that say the digits mean something else lower a score.
AGAINST = ("version|order no|isbn|serial", 0.2)
LETTERS = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _parts_fit(match: Column) -> Column:
    def fits(part: Column) -> Column:
        digits = F.ltrim(part, F.lit("0"))
        return (F.length(digits) < 4) & (F.concat(F.lit("0"), F.substring(digits, 1, 3)).cast("int") < 256)

    return F.forall(F.split(match, r"\."), fits)


def _digits_between(match: Column, low: int, high: int) -> Column:
    return F.length(F.regexp_replace(match, "[^0-9]", "")).between(low, high)


def luhn(digits: Column) -> Column:
    """Does a string of digits pass the Luhn check?"""

    def step(total: Column, i: Column) -> Column:
        digit = F.substring(digits, -i, F.lit(1)).cast("int")
        twice = digit * 2
        return total + F.when(i % 2 == 1, digit).otherwise(twice - F.when(twice > 9, 9).otherwise(0))

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), step) % 10 == 0


def mod97(number: Column) -> Column:
    """Does a bank account number pass the mod 97 check?"""
    compact = F.regexp_replace(number, " ", "")
    moved = F.concat(F.substr(compact, F.lit(5)), F.substr(compact, F.lit(1), F.lit(4)))

    def step(rest: Column, i: Column) -> Column:
        value = F.position(F.substr(moved, i, F.lit(1)), F.lit(LETTERS)) - 1
        return (rest * F.when(value > 9, 100).otherwise(10) + value) % 97

    return F.aggregate(F.sequence(F.lit(1), F.length(moved)), F.lit(0), step) == 1


def _ssn_range(match: Column) -> Column:
    area = F.substr(match, F.lit(1), F.lit(3)).cast("int")
    return (
        ~area.isin(0, 666)
        & (area < 900)
        & (F.substr(match, F.lit(5), F.lit(2)) != "00")
        & (F.substr(match, F.lit(8), F.lit(4)) != "0000")
    )


def _card(match: Column) -> Column:
    digits = F.regexp_replace(match, "[^0-9]", "")
    return F.when(F.length(digits).between(13, 19), luhn(digits)).otherwise(F.lit(False))


CONFIRM: dict[str, Callable[[Column], Column]] = {
    "email": lambda m: F.lit(True),
    "ip": _parts_fit,
    "card": _card,
    "phone": lambda m: _digits_between(m, 9, 15),
    "iban": mod97,
    "ssn": _ssn_range,
}


def _fold(items: Column, start: Column, step: Callable[[Column, Column], tuple[Column, Column]], kind: str) -> Column:
    """Array of what ``step(state, item)`` gives beside the next state, item by item.

    Items are taken in blocks, so that thousands in one text do not cost their square.
    """
    block = 256

    def pair(state: Column, found: Column) -> Column:
        return F.struct(state.alias("state"), found.alias("found"))

    def one(so_far: Column, item: Column) -> Column:
        state, made = step(so_far["state"], item)
        return pair(state, F.concat(so_far["found"], F.array(made)))

    def one_block(so_far: Column, i: Column) -> Column:
        inner = F.aggregate(F.slice(items, i, block), pair(so_far["state"], F.array().cast(f"array<{kind}>")), one)
        # one evaluation of the block, which is used twice
        return F.transform(
            F.array(inner), lambda made: pair(made["state"], F.concat(so_far["found"], F.array(made["found"])))
        )[0]

    blocks = F.when(F.size(items) > 0, F.sequence(F.lit(1), F.size(items), F.lit(block))).otherwise(
        F.array().cast("array<int>")
    )
    begin = pair(start, F.array().cast(f"array<array<{kind}>>"))
    return F.aggregate(blocks, begin, one_block, lambda so_far: F.flatten(so_far["found"]))


def matches(text: Column, pattern: str) -> Column:
    """Leftmost matches that do not overlap: array of (start, end, match, context).

    Offsets are code points, ends exclusive. Matches with nothing but separators between
    them are a list; ``context`` is the CONTEXT_CHARS before and after the match in the
    text, and those before and after its list, in lines. Offsets are running sums over
    the gaps and matches, and contexts are put together from their ends, so a text of any
    length is read once.
    """

    def ends(gaps: Column) -> Column:
        # every gap and match, and the gap behind them
        pairs = F.zip_with(
            gaps,
            F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
            lambda gap, match: F.struct(gap.alias("gap"), match.alias("match")),
        )
        behind = F.slice(gaps, F.lit(2), F.size(gaps))
        both = F.zip_with(
            pairs,
            behind,
            lambda pair, gap: F.struct(
                pair["gap"].alias("gap"), pair["match"].alias("match"), F.left(gap, near).alias("behind")
            ),
        )
        return F.filter(both, lambda pair: pair["match"].isNotNull())

    near = F.lit(CONTEXT_CHARS)

    def forward(state: Column, pair: Column) -> tuple[Column, Column]:
        start = state["at"] + F.length(pair["gap"])
        end = start + F.length(pair["match"])
        before = F.right(F.concat(state["before"], F.right(pair["gap"], near)), near)
        goes_on = (state["at"] > 0) & (F.length(pair["gap"]) <= near) & F.rlike(pair["gap"], F.lit(SEPARATOR))
        listed = F.when(goes_on, state["listed"]).otherwise(before)
        found = F.struct(
            start.alias("start"),
            end.alias("end"),
            pair["match"].alias("match"),
            F.concat_ws("\n", before, F.when(goes_on, listed)).alias("context"),
            pair["behind"].alias("behind"),
            goes_on.alias("goes_on"),
        )
        after = F.right(F.concat(before, F.right(pair["match"], near)), near)
        return F.struct(end.alias("at"), after.alias("before"), listed.alias("listed")), found

    def backward(state: Column, found: Column) -> tuple[Column, Column]:
        after = F.left(F.concat(found["behind"], state["after"]), near)
        listed = F.when(state["goes_on"], state["listed"]).otherwise(after)
        context = F.concat_ws("\n", found["context"], after, F.when(state["goes_on"], listed))
        whole = F.struct(*(found[n].alias(n) for n in ("start", "end", "match")), context.alias("context"))
        before = F.left(F.concat(F.left(found["match"], near), after), near)
        return F.struct(
            before.alias("after"), listed.alias("listed"), found["goes_on"].alias("goes_on")
        ), whole

    kind = "struct<start:int,end:int,match:string,context:string"
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("before"), F.lit("").alias("listed"))
    end = F.struct(F.lit("").alias("after"), F.lit("").alias("listed"), F.lit(False).alias("goes_on"))
    # one evaluation of the gaps, of the pairs and of the first pass, however often they are used
    found = F.transform(F.array(F.split(text, pattern, -1)), ends)
    found = F.transform(found, lambda f: F.reverse(_fold(f, start, forward, f"{kind},behind:string,goes_on:boolean>")))
    found = F.transform(found, lambda f: F.reverse(_fold(f, end, backward, f"{kind}>")))
    return found[0]


def kind_spans(text: Column, kind: str) -> Column:
    """Confirmed spans of one kind: array of (kind, start, end, score).

    The context of a span is the CONTEXT_CHARS before and after it in the text, whatever
    else is found there, and those before and after the list that it is in.
    """
    base, words, gain = SCORES[kind]
    near = f"(?i)(?:{words})"
    far = f"(?i)(?:{AGAINST[0]})"

    def span(found: Column) -> Column:
        score = (
            F.lit(base)
            + F.when(F.rlike(found["context"], F.lit(near)), gain).otherwise(0.0)
            - F.when(F.rlike(found["context"], F.lit(far)), AGAINST[1]).otherwise(0.0)
        )
        return F.struct(
            F.lit(kind).alias("kind"),
            found["start"].cast("long").alias("start"),
            found["end"].cast("long").alias("end"),
            F.round(score, 2).alias("score"),
        )

    confirmed = F.filter(matches(text, PATTERNS[kind]), lambda m: CONFIRM[kind](m["match"]))
    spans = F.transform(confirmed, span)
    if kind in BASE_KINDS:
        return spans
    return F.filter(spans, lambda s: s["score"] >= REPORTED_SCORE)


def with_pii(df: DataFrame, text: str = "text", out: str = "pii") -> DataFrame:
    """Add a column ``out``: array<struct<kind,start,end,score>>, by kind, then start.

    Email, ip, card and phone spans are kept whatever their score; iban and ssn spans
    need REPORTED_SCORE. NULL and empty texts have no spans. Rows are neither dropped nor
    moved, so repeated rows, NULLs elsewhere and other columns do not matter. A column
    named like ``out`` is replaced.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    parts = [kind_spans(whole, kind) for kind in KINDS]
    return df.withColumn(out, F.concat(*parts))


def written(spans: Column, *kinds: str) -> Column:
    """kind:start:end, comma-joined."""
    kept = F.filter(spans, lambda s: s["kind"].isin(*kinds)) if kinds else spans
    return F.array_join(
        F.transform(kept, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )


def report(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: counts by base kind, digest of base spans, all spans."""
    # the spans are an array of their own before they are counted, or each use searches anew
    found = with_pii(df.select(F.col(key).alias("doc_id"), F.col(text).alias("text")))
    found = found.select("doc_id", F.explode(F.array("pii")).alias("pii"))

    def count(kind: str) -> Column:
        return F.size(F.filter("pii", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *(count(kind) for kind in BASE_KINDS),
        F.sha2(written(F.col("pii"), *BASE_KINDS), 256).alias("base_sha256"),
        written(F.col("pii")).alias("spans"),
        F.size(F.filter("pii", lambda s: s["score"] >= 0.8)).cast("long").alias("n_likely"),
    )

"""Personal data: proposed by regular expressions, confirmed by checksums, weighed by context words.

Every kind has a pattern that proposes spans, validators that confirm them and a score. The base
kinds are certain once they validate. Further proposals start from a prior of their kind, a passed
checksum raises it, and words near the span raise it again; those that reach ``ACCEPTED`` are added.
Only DataFrame functions are used: a pattern that starts at the end of the last match (``\\G``)
returns the gap before each match, and the gaps' lengths give the places.

Patterns are written so that a failing attempt never goes back over what it has read: quantifiers are
possessive where that changes nothing, and attempts begin only where a run of their characters begins.

Defined results: a NULL text has no spans and stays NULL when redacted. Spans are in code points, end
exclusive. Rows are judged one by one, so repeated rows, ties and other columns change nothing.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surveylake.llm.common import column, fresh, text_of

ACCEPTED = 0.7
CONTEXT_BONUS = 0.4
CHECKSUM_BONUS = 0.5
NEAR = 40  # characters read before and after a span

# Order of the kinds at one place.
KINDS = ("email", "ip", "card", "phone", "iban", "ssn")

SPAN = "array<struct<start:int,kind:int,end:int>>"


@dataclass(frozen=True)
class Proposal:
    kind: str
    pattern: str  # without capturing groups
    starts: str  # what may precede a match, as a lookbehind
    hint: str  # a text without this has no match
    prior: float = 1.0  # certain
    words: str = ""  # context words that raise the score


_LOCAL = "[A-Za-z0-9._%+-]"
_WORD = r"(?<![\p{L}\p{N}_])"

BASE = (
    Proposal("email", rf"{_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", rf"(?<!{_LOCAL})", "@"),
    Proposal("ip", r"[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", "(?<![0-9])", r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]"),
    Proposal(
        "card",
        r"[0-9](?:[ -]?[0-9]){13,18}+(?![ -]?[0-9])",
        "(?<![0-9])(?<![0-9][ -])",
        "(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){13}+",
    ),
    Proposal("phone", r"\+[0-9](?:[ ().-]*+[0-9]){9,14}+(?![ ().-]*+[0-9])", "", r"\+[0-9]"),
)

FURTHER = (
    # A number of one block or of blocks of four, also where other digits stand next to it.
    Proposal(
        "card",
        r"(?:[0-9]{13,19}+|[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{1,7}+)(?![0-9])".replace(r"([ -])", "[ -]").replace(r"\1", "[ -]"),
        "(?<![0-9])",
        "[0-9]{13}|[0-9]{4}[ -][0-9]{4}[ -][0-9]{4}[ -][0-9]",
        0.2,
        "card|visa|mastercard|amex|credit|carte|karte|tarjeta",
    ),
    # A number in the usual grouping, also where other digits follow.
    Proposal(
        "phone",
        r"\+[0-9]{1,3}+[ .-]?+(?:\([0-9]{2,4}\)|[0-9]{2,4}+)[ .-]?+[0-9]{3}[ .-]?[0-9]{4}(?![0-9])",
        "",
        r"\+[0-9]{1,3}+[ .-]?+[(0-9]",
        0.8,
    ),
    Proposal(
        "phone",
        r"(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9-])",
        r"(?<![0-9+.-])(?<![0-9] )",
        r"[0-9]{3}[ .-][0-9]{4}",
        0.4,
        r"phone|tel\.?|mobile|call|fax|whatsapp|t[eé]l[eé]phone|telefon|tel[eé]fono",
    ),
    Proposal(
        "iban",
        r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}+(?![A-Za-z0-9])",
        _WORD,
        "[A-Z]{2}[0-9]{2} ?[A-Z0-9]",
        0.3,
        "iban|account|konto|compte|cuenta",
    ),
    Proposal(
        "ssn",
        "[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
        "(?<![0-9-])",
        "[0-9]{3}-[0-9]{2}-[0-9]{4}",
        0.4,
        "ssn|social security",
    ),
)


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a text of digits passes the Luhn check."""
    places = F.transform(
        F.split(F.reverse(digits), ""),
        lambda d, i: F.when(i % 2 == 0, d.try_cast("int")).otherwise(
            d.try_cast("int") * 2 - F.when(d.try_cast("int") > 4, 9).otherwise(0)
        ),
    )
    return F.aggregate(places, F.lit(0), lambda total, d: total + F.coalesce(d, F.lit(0))) % 10 == 0


def mod97(account: Column) -> Column:
    """Whether an account number without spaces leaves 1 when divided by 97 (letters count from 10)."""
    turned = F.concat(F.substring(account, 5, 64), F.substring(account, 1, 4))

    def step(rest: Column, c: Column) -> Column:
        digit = c.try_cast("int")
        return F.when(digit.isNotNull(), (rest * 10 + digit) % 97).when(c == "", rest).otherwise((rest * 100 + F.ascii(c) - 55) % 97)

    return F.aggregate(F.split(turned, ""), F.lit(0), step) == 1


def _valid(kind: str, found: Column) -> Column:
    if kind == "ip":
        part = r"0*+(?:|[1-9][0-9]?|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
        return found.rlike(rf"^{part}(?:\.{part}){{3}}$")
    if kind == "card":
        return luhn(_digits(found))
    if kind == "iban":
        return mod97(F.replace(found, F.lit(" "), F.lit("")))
    if kind == "ssn":
        return ~found.rlike("^(?:000|666|9)|-00-|0000$")
    return F.lit(True)


def _proposed(text: Column, rule: Proposal) -> Column:
    """``start, kind, end`` of a rule's accepted spans in the order of the text."""
    gap = f"(|(?s:.*?){rule.starts})" if rule.starts else "((?s:.*?))"
    # A later match may begin where the former one ended, whatever precedes it, only for the e-mail class.
    if rule.kind != "email" and rule.starts:
        gap = f"((?s:.*?)){rule.starts}"
    pattern = F.lit(rf"\G{gap}({rule.pattern})")
    parts = [F.regexp_extract_all(text, pattern, F.lit(1)), F.regexp_extract_all(text, pattern, F.lit(2))]
    names = ["gap", "found"]
    if rule.words:
        after = F.lit(rf"\G{gap}({rule.pattern})(?=((?s:.{{0,{NEAR}}})))")
        parts.append(F.regexp_extract_all(text, after, F.lit(3)))
        names.append("after")
    zipped = F.arrays_zip(*[part.alias(name) for part, name in zip(parts, names)])
    zipped = zipped.cast("array<struct<" + ",".join(f"{name}:string" for name in names) + ">>")
    kind = KINDS.index(rule.kind)

    def accepted(m: Column) -> Column:
        valid = _valid(rule.kind, m["found"])
        if rule.prior >= 1:
            return valid
        score = F.lit(rule.prior)
        if rule.kind in ("card", "iban"):
            score = score + F.lit(CHECKSUM_BONUS)
        if rule.words:
            near = F.concat_ws(" ", F.right(m["gap"], F.lit(NEAR)), m["after"])
            score = score + F.when(near.rlike(rf"(?i)(?<!\p{{L}})(?:{rule.words})(?!\p{{L}})"), CONTEXT_BONUS).otherwise(0.0)
        return valid & (score >= ACCEPTED)

    def step(state: Column, m: Column) -> Column:
        start = state["at"] + F.length(m["gap"])
        end = start + F.length(m["found"])
        span = F.array(F.struct(start.alias("start"), F.lit(kind).alias("kind"), end.alias("end"))).cast(SPAN)
        spans = F.when(accepted(m), F.concat(state["spans"], span)).otherwise(state["spans"])
        return F.struct(end.alias("at"), spans.alias("spans"))

    empty = F.array().cast(SPAN)
    start = F.struct(F.lit(0).alias("at"), empty.alias("spans"))
    spans = F.aggregate(zipped, start, step, lambda state: state["spans"])
    may = F.contains(text, F.lit(rule.hint)) if rule.hint == "@" else text.rlike(rule.hint)
    return F.when(may, spans).otherwise(empty)


def base_spans(text: Column) -> Column:
    """Spans of the base kinds by start, then kind."""
    return F.array_sort(F.concat(*[_proposed(text, rule) for rule in BASE]))


def further_spans(text: Column) -> Column:
    """Accepted spans of the further proposals."""
    return F.concat(*[_proposed(text, rule) for rule in FURTHER])


def listed(spans: Column) -> Column:
    """``kind:start:end`` of all spans, joined by commas."""
    kinds = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def detect(docs: DataFrame, text: str = "text") -> DataFrame:
    """All rows with ``pii_base`` and ``pii_spans`` added (replaced, if there).

    ``pii_spans`` has the base spans and those further ones that no base span contains.
    """
    kept = [name for name in docs.columns if name.lower() not in ("pii_base", "pii_spans")]
    plain, more = fresh(docs, "plain"), fresh(docs, "more")
    found = docs.select(*map(column, kept), text_of(text).alias(plain))
    found = found.select(*map(column, kept), base_spans(column(plain)).alias("pii_base"), further_spans(column(plain)).alias(more))
    own = F.filter(
        column(more), lambda s: ~F.exists("pii_base", lambda b: (b["start"] <= s["start"]) & (s["end"] <= b["end"]))
    )
    both = F.array_sort(F.array_distinct(F.concat("pii_base", own)))
    return found.select(*map(column, kept), "pii_base", both.alias("pii_spans"))


def redacted(text: Column, spans: Column) -> Column:
    """The text with every span, or run of overlapping spans, replaced by its kind in brackets."""
    kinds = F.array(*[F.lit(f"[{kind.upper()}]") for kind in KINDS])
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))

    def step(state: Column, s: Column) -> Column:
        piece = text.substr(state["at"] + 1, s["start"] - state["at"])
        parts = F.when(s["start"] >= state["at"], F.concat(state["parts"], F.array(piece, F.get(kinds, s["kind"])))).otherwise(state["parts"])
        return F.struct(F.greatest(state["at"], s["end"]).alias("at"), parts.alias("parts"))

    def finish(state: Column) -> Column:
        return F.concat(F.array_join(state["parts"], ""), text.substr(state["at"] + 1, F.length(text)))

    return F.when(F.size(spans) > 0, F.aggregate(spans, start, step, finish)).otherwise(text)


def redact(docs: DataFrame, text: str = "text", n_chars: str | None = None) -> DataFrame:
    """The rows of ``docs`` with personal data replaced in ``text``; ``n_chars`` names a column with its length."""
    whole = fresh(docs, "whole")
    found = detect(docs.select(F.struct(*map(column, docs.columns)).alias(whole), column(text).alias("text")))
    # A select of its own: beside an alias "text", a lambda function would take that for the column.
    found = found.select(column(whole).alias("row"), redacted(F.col("text"), F.col("pii_spans")).alias("clean"))
    columns = []
    for name in docs.columns:
        if name == text:
            columns.append(F.col("clean").alias(name))
        elif name == n_chars:
            columns.append(F.length("clean").cast(docs.schema[name].dataType).alias(name))
        else:
            columns.append(F.col("row").getField(name).alias(name))
    return found.select(*columns)

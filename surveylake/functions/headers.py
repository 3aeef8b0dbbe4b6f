"""Header-level column expressions: a raw column header → one stable column name.

The exports write the same question as ``('P1_a ', 'Idade')`` in one edition and ``1.a_idade``
in the next; both become ``p1_a_idade``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from surveylake.functions import rules
from surveylake.functions.text import BLANKS, bound, fold

UNNAMED = "coluna_sem_nome"

# One element of a serialised tuple: quoted either way, or a bare number.
_SINGLE = r"'((?:[^'\\]|\\.)*)'"
_DOUBLE = r'"((?:[^"\\]|\\.)*)"'
_ELEMENT = rf"(?:{_SINGLE}|{_DOUBLE}|(-?\d+(?:\.\d+)?))"
_TUPLE = rf"(?s)^\(\s*{_ELEMENT}\s*,\s*{_ELEMENT}\s*(?:,.*)?\)$"
_BROKEN_TUPLE = r"(?s)^\((.*?)',(.*?)(?:',.*)?\)$"
_DOTTED = r"(?s)^(\d+(?:\.[A-Za-z0-9]+)*)[_\s](.+)$"


def slugify(text: Column) -> Column:
    """Lower-case identifier of letters, digits and single underscores."""
    spelled = F.replace(fold(text), F.lit("+"), F.lit(" mais "))
    return F.btrim(F.regexp_replace(spelled, r"[^a-z0-9]+", "_"), F.lit("_"))


def question_code(code: Column) -> Column:
    """``P1_a ``, ``1.a`` → ``p1_a``; ``4.d.1`` → ``p4_d_1``."""
    lowered = F.lower(F.btrim(code, F.lit(BLANKS)))
    joined = F.btrim(F.regexp_replace(lowered, r"[^a-z0-9_]+", "_"), F.lit("_"))
    return F.when(joined.rlike(r"^[0-9]"), F.concat(F.lit("p"), joined)).otherwise(joined)


# Marks put in front of a header that has a code: a tuple, a damaged tuple, a dotted code.
_OF_TUPLE, _OF_BROKEN, _OF_DOTTED, _CUT = "\u001c", "\u001d", "\u001e", "\u001f"


def mark_code(raw: Column) -> Column:
    """Header with a mark in front and a cut between code and statement, where it has a code.

    A marked text no longer begins like a header, so the three steps exclude one another.
    """
    text = F.btrim(raw, F.lit(BLANKS))
    text = F.regexp_replace(text, _TUPLE, f"{_OF_TUPLE}$1$2$3{_CUT}$4$5$6")
    text = F.regexp_replace(text, _BROKEN_TUPLE, f"{_OF_BROKEN}$1{_CUT}$2")
    return F.regexp_replace(text, _DOTTED, f"{_OF_DOTTED}$1{_CUT}$2")


def header_code(marked: Column) -> Column:
    """Question code of a marked header, NULL where it has none."""
    pattern = rf"(?s)^[{_OF_TUPLE}-{_OF_DOTTED}]['\"\s]*(.*?)['\"\s]*{_CUT}"
    return F.nullif(F.regexp_extract(marked, pattern, 1), F.lit(""))


def header_statement(marked: Column) -> Column:
    """Statement of a marked header: all of it where there is no code."""
    body = F.regexp_replace(marked, rf"(?s)^[{_OF_TUPLE}-{_OF_DOTTED}].*?{_CUT}", "")
    spaced = F.regexp_replace(body, r"\\[nrt]", " ")
    unescaped = F.btrim(F.regexp_replace(spaced, r"\\(.)", "$1"), F.lit(BLANKS))
    return (
        F.when(marked.startswith(_OF_TUPLE), unescaped)
        .when(marked.startswith(_OF_BROKEN), F.btrim(body, F.lit("'\"" + BLANKS)))
        .otherwise(body)
    )


def split_header(raw: Column) -> Column:
    """``struct(code, statement)`` of a header."""
    return bound(
        mark_code(raw),
        lambda marked: F.struct(
            header_code(marked).alias("code"), header_statement(marked).alias("statement")
        ),
    )


def compose_name(prefix: Column, body: Column) -> Column:
    """Column name from a question code and a slug, without repeating the code."""
    prefix, body = F.coalesce(prefix, F.lit("")), F.coalesce(body, F.lit(""))
    return (
        F.when((prefix == "") & (body == ""), F.lit(UNNAMED))
        .when((prefix == "") & body.rlike(r"^[0-9]"), F.concat(F.lit("c_"), body))
        .when(prefix == "", body)
        .when(body == "", prefix)
        .when((body == prefix) | body.startswith(F.concat(prefix, F.lit("_"))), body)
        .otherwise(F.concat_ws("_", prefix, body))
    )


def column_name(raw: Column) -> Column:
    """Raw header → column name, before names are made unique within an edition."""
    return bound(
        split_header(raw),
        lambda header: bound(
            F.struct(
                question_code(header["code"]).alias("prefix"),
                slugify(header["statement"]).alias("body"),
            ),
            lambda part: compose_name(part["prefix"], part["body"]),
        ),
    )


def is_junk(name: Column) -> Column:
    return name.rlike(rules.JUNK_COLUMN)


def option_item(name: Column) -> Column:
    """The item part of an option column: ``p4_d_1_sql`` → ``sql``."""
    return F.regexp_replace(name, r"^p\d+_[a-z0-9]+_\d+_", "")


def is_non_answer(name: Column) -> Column:
    """Whether an option names no technology ("none of these", "other", "don't know")."""
    return option_item(name).rlike(rules.NON_ANSWER_OPTION)


def option_label(name: Column) -> Column:
    """Display name of an option column: ``p4_h_1_amazon_web_services_aws`` → ``AWS``."""
    key = F.btrim(F.translate(option_item(name), "_", " "), F.lit(" "))
    known = F.create_map(
        *[F.lit(part) for pair in rules.DISPLAY_NAMES.items() for part in pair]
    )
    return F.when(key == "", name).otherwise(F.coalesce(known[key], F.initcap(key)))

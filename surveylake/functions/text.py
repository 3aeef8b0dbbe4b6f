"""Answer-level column expressions: cleaning, labels, salary bands, yes/no, regions.

All of them are built-in Spark expressions, so they stay in code generation and predicates on
their results can be pushed below joins.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from surveylake.functions import rules

# Blank characters trimmed from both ends, the non-breaking space included.
BLANKS = " \t\r\n\f\u00a0"


def _fold_tables() -> tuple[str, str, list[tuple[str, str]]]:
    """Compatibility folding of the basic plane: letters with one base letter, then the others.

    Combining marks are dropped. The first two texts belong to each other letter by letter, with the
    marks at the end of the first; the list has the letters that become several or none.
    """
    accented, plain, marks, several = [], [], [], []
    for code in range(0x00A0, 0x10000):
        letter = chr(code)
        if 0xD800 <= code < 0xE000 or 0xAC00 <= code < 0xD7A4:
            continue  # surrogates; Hangul syllables decompose into their own letters by rule
        if unicodedata.combining(letter):
            marks.append(letter)
            continue
        base = "".join(part for part in unicodedata.normalize("NFKD", letter) if not unicodedata.combining(part))
        if base == letter:
            continue
        if len(base) == 1:
            accented.append(letter)
            plain.append(base)
        else:
            several.append((letter, base))
    return "".join(accented) + "".join(marks), "".join(plain), several


_ACCENTED, _PLAIN, _SEVERAL = _fold_tables()
_ALL_SEVERAL = "".join(letter for letter, _ in _SEVERAL)
_SEVERAL_RANGES = "[" + "".join(letter for letter in _ALL_SEVERAL if letter < "\u0100") + "\u0100-\uffff]"
_SEVERAL_MAP = "\x02".join(f"{letter}\x01{base}" for letter, base in _SEVERAL)


def strip_accents(text: Column) -> Column:
    """Replace letters by their compatibility base letters and drop combining marks.

    Text of one byte per character has none, and skips the letter-by-letter pass. Letters that become
    several (ligatures, fractions) are spelled out one by one, where the text still has any after it:
    few texts pass the test on code ranges, and ``translate`` is one pass over a hash table.
    """
    plain = F.octet_length(text) == F.char_length(text)

    def has_none(part: Column) -> Column:
        return F.translate(part, _ALL_SEVERAL, "") == part

    def spelled(folded: Column) -> Column:
        table = F.str_to_map(F.lit(_SEVERAL_MAP), F.lit("\x02"), F.lit("\x01"))  # folded to a constant
        letters = F.transform(F.split(folded, ""), lambda c: F.when(has_none(c), c).otherwise(F.try_element_at(table, c)))
        return F.when(~folded.rlike(_SEVERAL_RANGES) | has_none(folded), folded).otherwise(F.array_join(letters, ""))

    return F.when(plain, text).otherwise(bound(F.translate(text, _ACCENTED, _PLAIN), spelled))


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often ``use`` mentions it."""
    return F.transform(F.array(value), use)[0]


def fold(text: Column) -> Column:
    """Lower case without accents: the form the label rules are written for."""
    return F.lower(strip_accents(text))


def clean_text(text: Column) -> Column:
    """Trim; the spellings of a missing answer become NULL."""
    trimmed = F.btrim(text, F.lit(BLANKS))
    return F.when(~F.lower(trimmed).isin(*rules.BLANK_SPELLINGS), trimmed)


def label_by_rules(
    cleaned: Column,
    rule_list: Sequence[tuple[str, str]],
    folded: Column | None = None,
    default: str | None = None,
) -> Column:
    """Label of the first rule that matches; an answer no rule knows passes through unchanged.

    ``cleaned`` comes from :func:`clean_text`. Pass ``folded`` (a column already holding
    ``fold(cleaned)``) on long text, so that it is folded once and not once per rule.
    """
    folded = fold(cleaned) if folded is None else folded
    label = F.when(cleaned.isNull(), F.lit(default))
    for pattern, name in rule_list:
        label = label.when(folded.rlike(pattern), F.lit(name))
    return label.otherwise(cleaned)


def known_by_rules(folded: Column, rule_list: Sequence[tuple[str, str]]) -> Column:
    """Whether any rule matches; what no rule knows would pass through as a label of its own."""
    known = F.lit(False)
    for pattern, _ in rule_list:
        known = known | folded.rlike(pattern)
    return known


def seniority_label(cleaned: Column, folded: Column | None = None) -> Column:
    return label_by_rules(cleaned, rules.SENIORITY_RULES, folded)


def work_model_label(cleaned: Column, folded: Column | None = None) -> Column:
    return label_by_rules(cleaned, rules.WORK_MODEL_RULES, folded)


def job_label(cleaned: Column, folded: Column | None = None) -> Column:
    return label_by_rules(cleaned, rules.JOB_RULES, folded)


def gender_label(cleaned: Column, folded: Column | None = None) -> Column:
    return label_by_rules(cleaned, rules.GENDER_RULES, folded)


def ai_usage_label(cleaned: Column, folded: Column | None = None) -> Column:
    return label_by_rules(cleaned, rules.AI_USAGE_RULES, folded)


def ai_priority_label(cleaned: Column, folded: Column | None = None) -> Column:
    return label_by_rules(cleaned, rules.AI_PRIORITY_RULES, folded)


def ai_result_label(cleaned: Column, folded: Column | None = None) -> Column:
    return label_by_rules(cleaned, rules.AI_RESULT_RULES, folded)


def salary_numbers(text: Column) -> Column:
    """The amounts in a band text, ``1.000,50`` style, without those below the smallest salary."""
    amounts = F.regexp_extract_all(
        text, F.lit(r"(\d{1,3}(?:\.\d{3})+(?:,\d+)?|\d+(?:,\d+)?)"), F.lit(1)
    )
    as_double = F.transform(
        amounts, lambda a: F.translate(a, ",.", ".").try_cast("double")
    )
    return F.filter(as_double, lambda a: a >= rules.SMALLEST_SALARY)


def salary_midpoint(cleaned: Column, folded: Column | None = None) -> Column:
    """Monthly midpoint of a salary band.

    Two amounts give their mean, "up to" half the amount, "above" 1.25 times the amount. People
    without pay are NULL: a zero would pull every median down.
    """
    folded = fold(cleaned) if folded is None else folded

    def midpoint(amounts: Column) -> Column:
        first, second = F.get(amounts, F.lit(0)), F.get(amounts, F.lit(1))
        return (
            F.when(first.isNull() | folded.rlike(rules.UNPAID_WORDS), F.lit(None).cast("double"))
            .when(second.isNotNull(), (first + second) / 2)
            .when(folded.rlike(rules.BELOW_WORDS), first * rules.BELOW_FACTOR)
            .when(folded.rlike(rules.ABOVE_WORDS), first * rules.ABOVE_FACTOR)
            .otherwise(first)
        )

    return bound(salary_numbers(folded), midpoint)


def yes_no(cleaned: Column) -> Column:
    """True / false / NULL (not asked, or an answer that is neither)."""
    folded = fold(cleaned)
    return (
        F.when(folded.isin(*rules.TRUE_SPELLINGS) | folded.startswith("sim"), F.lit(True))
        .when(
            folded.isin(*rules.FALSE_SPELLINGS)
            | (folded.startswith("n") & ~folded.startswith("nao sei")),
            F.lit(False),
        )
        .otherwise(F.lit(None).cast("boolean"))
    )


def uses_ai(cleaned: Column, folded: Column | None = None) -> Column:
    """Any described usage counts, except "I use none"; no answer stays NULL."""
    folded = fold(cleaned) if folded is None else folded
    return F.when(cleaned.isNotNull(), ~folded.rlike(r"nao\s+utilizo\s+nenhum"))


def company_prioritises_ai(cleaned: Column, folded: Column | None = None) -> Column:
    """True for a declared priority; "I cannot say" is NULL, not false."""
    folded = fold(cleaned) if folded is None else folded
    return F.when(
        cleaned.isNotNull() & ~folded.rlike(r"^nao\s*sei\s*opinar"), folded.startswith("sim")
    )


def region_of_state(state: Column, declared: Column | None = None) -> Column:
    """Macro-region of a state code, else the declared region, else NULL."""
    region = F.lit(None).cast("string")
    for name, states in rules.REGION_STATES.items():
        region = F.coalesce(region, F.when(state.isin(*states), F.lit(name)))
    return region if declared is None else F.coalesce(region, declared)


def state_code(cleaned: Column) -> Column:
    return F.upper(cleaned)


def age_in_years(text: Column) -> Column:
    """Whole years; ``25.0`` is 25, anything malformed is NULL."""
    return F.btrim(text, F.lit(BLANKS)).try_cast("double").try_cast("int")


def ordinal_of(category: Column, order: Iterable[str]) -> Column:
    """1-based position in a fixed order; a category outside it sorts last."""
    order = list(order)
    position = F.when(F.lit(False), F.lit(0))
    for index, name in enumerate(order, start=1):
        position = position.when(category == name, F.lit(index))
    return position.otherwise(F.lit(len(order) + 1))


def sector_group(sector: Column, words: Iterable[str], inside: str, outside: str) -> Column:
    """``inside`` where the lower-case sector holds any of the words, else ``outside``."""
    lowered = F.lower(sector)
    hit = F.lit(False)
    for word in words:
        hit = hit | lowered.contains(word)
    return F.when(hit, F.lit(inside)).otherwise(F.lit(outside))


def edition_label(year: Column) -> Column:
    """``2023`` → ``2023-24``."""
    return F.concat(
        year.cast("string"), F.lit("-"), F.substring((year + 1).cast("string"), -2, 2)
    )


def percentage(part: Column, whole: Column, digits: int = 2) -> Column:
    """``100 * part / whole`` in doubles; NULL where the whole is zero or NULL."""
    ratio = F.try_divide(part.cast("double") * 100.0, whole.cast("double"))
    return F.round(ratio, digits)


def enough(count: Column, minimum: int) -> Column:
    """Whether a segment has the respondents its statistics need."""
    return count >= F.lit(minimum)


def marked(condition: Column) -> Column:
    """0/1 of a predicate; NULL stays NULL and so leaves the denominator of an average."""
    return condition.cast("int")


def marked_or_zero(condition: Column) -> Column:
    """0/1 of a predicate with NULL counted as not true."""
    return F.when(condition, F.lit(1.0)).otherwise(F.lit(0.0))


def answered(options: Sequence[Column]) -> Column:
    """Whether any option of a multi-select block holds a value ("none of these" included)."""
    return F.coalesce(*options).isNotNull()


def chosen_labels(options: Sequence[tuple[Column, str]], asked: Sequence[Column]) -> Column:
    """One-hot options of a block → array of distinct labels; NULL where the block was skipped.

    The yes/no test is written once and applied to every option, so the plan stays small for
    blocks of dozens of options.
    """
    pairs = F.array(
        *[F.struct(value.alias("mark"), F.lit(label).alias("label")) for value, label in options]
    )

    def marked_option(option: Column) -> Column:
        mark = option["mark"]
        spelled_out = yes_no(clean_text(mark))
        return F.when(mark == "1", F.lit(True)).when(mark != "0", spelled_out)

    chosen = F.filter(pairs, marked_option)
    labels = F.array_distinct(F.transform(chosen, lambda option: option["label"]))
    return F.when(answered(asked), labels)

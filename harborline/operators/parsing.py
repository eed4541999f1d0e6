"""Reading typed values out of raw text, as SQL expression text.

The raw layer is all text. A parser returns null for text that is not a value of the
declared kind; it accepts plain decimal numbers, ISO dates (with or without a time) or those of
another given format, and the words true and false.

Rules and parsers over whole tables are written as SQL text: a table has dozens of
them, and one ``selectExpr`` hands all of them to Spark at once.
"""

from __future__ import annotations

from collections.abc import Sequence

from harborline.functions.text import CASED_RUNS, WHITESPACE

NUMBER_TEXT = "^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"
WHOLE_TEXT = "^-?[0-9]{1,15}$"
_TIME = "[0-9]{2}:[0-9]{2}(:[0-9]{2}([.][0-9]{1,9})?)?(Z|[+-][0-9]{2}:?[0-9]{2})?"
DATE_TEXT = f"^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}([ T]{_TIME})?$"

_RUNS = CASED_RUNS.replace("\\", "\\\\")
_BLANKS = "".join(f"\\u{ord(c):04x}" for c in WHITESPACE)


def strip_sql(text: str) -> str:
    """The text without blanks at its edges; a text that begins and ends in visible ASCII is taken as it is."""
    visible = " AND ".join(f"{edge} BETWEEN '!' AND '~'" for edge in (text, f"right({text}, 1)"))
    return f"CASE WHEN {visible} THEN {text} ELSE btrim({text}, '{_BLANKS}') END"


def once_sql(value: str, otherwise: str = "NULL") -> str:
    """The same value, computed where it stands.

    The optimizer moves a filter on a computed column below the projection and puts a copy of the whole expression in it for
    every reference, so a filter on what several steps derive would repeat all of them for every row. It does not move
    filters below a projection with an expression that it takes for not deterministic, which the guard is. ``otherwise`` is never taken.
    """
    return f"IF(spark_partition_id() < 0, {otherwise}, {value})"


def found_sql(marks: Sequence[tuple[str, str]], kind: str) -> str:
    """The values of the marks (condition, value) that hold, in their order, as an array of ``kind``; compiled, unlike ``array_compact``."""
    none = f"CAST(array() AS ARRAY<{kind}>)"
    return f"concat({', '.join(f'CASE WHEN {condition} THEN array({value}) ELSE {none} END' for condition, value in marks)})"


def title_sql(text: str) -> str:
    """The same as ``functions.title_case``."""
    head = "upper(left(w, 1))"
    titled = f"concat(left({head}, 1), lower(substr({head}, 2)), substr(w, 2))"
    return f"array_join(transform(regexp_extract_all(lower({text}), '{_RUNS}', 1), w -> {titled}), '')"


def number_sql(text: str) -> str:
    return f"CASE WHEN {text} RLIKE '{NUMBER_TEXT}' THEN try_cast({text} AS DOUBLE) END"


def integer_sql(text: str) -> str:
    """Texts of up to 15 digits, which a double would hold exactly, are not read as one first."""
    other = f"CASE WHEN {number_sql(text)} % 1 = 0 THEN try_cast(try_cast({text} AS DOUBLE) AS BIGINT) END"
    return f"CASE WHEN {text} RLIKE '{WHOLE_TEXT}' THEN try_cast({text} AS BIGINT) ELSE {other} END"


def boolean_sql(text: str) -> str:
    """The words as they are mostly written are not put in lower case first."""
    word = f"CASE lower({text}) WHEN 'true' THEN true WHEN 'false' THEN false END"
    return f"CASE {text} WHEN 'true' THEN true WHEN 'false' THEN false ELSE {word} END"


ISO = "iso"
# Text pattern and parser pattern of every format but ISO, in the order in which they are preferred.
_NUMBERS = "[0-9]{{1,2}}{0}[0-9]{{1,2}}{0}[0-9]{{4}}"
DATE_FORMATS: dict[str, tuple[str, str] | None] = {
    ISO: None,
    "month/day/year": (_NUMBERS.format("/"), "M/d/yyyy"),
    "day/month/year": (_NUMBERS.format("/"), "d/M/yyyy"),
    "day.month.year": (_NUMBERS.format("[.]"), "d.M.yyyy"),
    "month.day.year": (_NUMBERS.format("[.]"), "M.d.yyyy"),
    "month-day-year": (_NUMBERS.format("-"), "M-d-yyyy"),
    "day-month-year": (_NUMBERS.format("-"), "d-M-yyyy"),
    "year/month/day": ("[0-9]{4}/[0-9]{1,2}/[0-9]{1,2}", "yyyy/M/d"),
    "yearmonthday": ("[0-9]{8}", "yyyyMMdd"),
    "day month-name year": ("[0-9]{1,2} [A-Z][a-z]{2} [0-9]{4}", "d MMM yyyy"),
}


def date_sql(text: str, form: str = ISO) -> str:
    """The day that a text names in one of ``DATE_FORMATS``."""
    if form == ISO:
        return f"CASE WHEN {text} RLIKE '{DATE_TEXT}' THEN try_cast(left({text}, 10) AS DATE) END"
    shape, pattern = DATE_FORMATS[form]
    if "MMM" in pattern:
        return f"CASE WHEN {text} RLIKE '^{shape}$' THEN CAST(try_to_timestamp({text}, '{pattern}') AS DATE) END"
    # Numbers are put in ISO order, which casts without an error to catch.
    between = next((c for c in pattern if not c.isalpha()), None)
    if between:
        place = {part[0]: i for i, part in enumerate(pattern.split(between), start=1)}
        year, month, day = (f"split_part({text}, '{between}', {place[part]})" for part in "yMd")
        guard = f"contains({text}, '{between}')"
    else:
        year, month, day = f"left({text}, 4)", f"substr({text}, 5, 2)", f"right({text}, 2)"
        guard = f"length({text}) = {len(pattern)}"
    iso = f"concat({year}, '-', {month}, '-', {day})"
    return f"CASE WHEN {guard} AND {text} RLIKE '^{shape}$' THEN try_cast({iso} AS DATE) END"


def parsed_sql(text: str, kind: str, form: str = ISO) -> str:
    """Expression for the typed value of a trimmed text expression; ``form`` is the format of dates."""
    return {
        "string": lambda t: t,
        "integer": integer_sql,
        "number": number_sql,
        "boolean": boolean_sql,
        "date": lambda t: date_sql(t, form),
    }[kind](text)

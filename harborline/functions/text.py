"""Text expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(value) -> Column:
    return F.col(value) if isinstance(value, str) else value


# Every character that counts as whitespace in Python's ``str.strip``.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    + "".join(chr(c) for c in range(0x2000, 0x200B)) + "\u2028\u2029\u202f\u205f\u3000"
)


def strip(text) -> Column:
    """Remove Unicode whitespace on both sides (plain ``trim`` only removes blanks)."""
    return F.btrim(_col(text), F.lit(WHITESPACE))


# A run of cased letters, or the text between two of them.
CASED_RUNS = r"([\p{Lu}\p{Ll}\p{Lt}]+|[^\p{Lu}\p{Ll}\p{Lt}]+)"


def title_case(text) -> Column:
    """Upper-case the first letter of every run of letters, lower-case the others.

    A letter whose upper case has two letters keeps only the first of them upper.
    """
    def titled(run):
        head = F.upper(F.left(run, F.lit(1)))
        return F.concat(F.left(head, F.lit(1)), F.lower(F.substr(head, F.lit(2))), F.substr(run, F.lit(2)))

    runs = F.regexp_extract_all(F.lower(_col(text)), F.lit(CASED_RUNS), F.lit(1))
    return F.array_join(F.transform(runs, titled), "")


def percent_text(rate, digits: int) -> Column:
    """``0.125`` as ``12.5%``, ties to even."""
    return F.format_string(f"%.{digits}f%%", F.bround(_col(rate) * 100, digits))


def signed_text(value, digits: int) -> Column:
    """Number with the sign it had before rounding, ties to even."""
    value = _col(value)
    sign = F.when(value < 0, "-").when(value.isNotNull(), "+")
    return F.concat(sign, F.format_string(f"%.{digits}f", F.abs(F.bround(value, digits))))


# Fixed value: the numbers an audit must find, which has to agree with the audited product. A number
# is not glued to a preceding Latin letter: optional sign, plain or comma-grouped digits,
# optional decimals. Java spells the class of all decimal digits \p{Nd}.
NUMBER_PATTERN = r"((?<![A-Za-z])[-+]?(?:\p{Nd}{1,3}(?:,\p{Nd}{3})+|\p{Nd}+)(?:\.\p{Nd}+)?)"


def number_tokens(text) -> Column:
    """Distinct numbers written in a text, without grouping commas and leading plus."""
    found = F.regexp_extract_all(_col(text), F.lit(NUMBER_PATTERN), F.lit(1))
    return F.array_distinct(
        F.transform(found, lambda t: F.regexp_replace(F.replace(t, F.lit(","), F.lit("")), r"^\++", ""))
    )

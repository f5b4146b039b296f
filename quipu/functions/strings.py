"""Text expressions with Python's rules, built from Spark's own functions."""

from __future__ import annotations

import re
import sys
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F


def _chars(rule) -> list[str]:
    return [chr(i) for i in range(sys.maxunicode + 1) if not 0xD800 <= i <= 0xDFFF and rule(chr(i))]


def _as_class(chars: list[str]) -> str:
    """The inside of a regular-expression class, with neighbours joined to ranges."""
    runs: list[list[int]] = []
    for code in map(ord, chars):
        if runs and code == runs[-1][1] + 1:
            runs[-1][1] = code
        else:
            runs.append([code, code])
    return "".join(f"\\x{{{a:x}}}-\\x{{{b:x}}}" for a, b in runs)


_SPACES = "".join(_chars(str.isspace))
_SPACE_CLASS = f"[{_as_class(_chars(str.isspace))}]"
# Letters that have a case; a title-case word is a run of them.
_CASED = "\\p{Lu}\\p{Ll}\\p{Lt}"
# Digits such as superscripts, which are not decimal digits.
_OTHER_DIGITS = _as_class(_chars(lambda c: c.isdigit() and unicodedata.category(c) != "Nd"))
# Letters whose capital is longer than one letter, such as ß.
_LONG_CAPITALS = _as_class(_chars(lambda c: len(c.upper()) > 1))


def strip(s: Column) -> Column:
    return F.btrim(s, F.lit(_SPACES))


def lstrip(s: Column) -> Column:
    return F.ltrim(s, F.lit(_SPACES))


def rstrip(s: Column) -> Column:
    return F.rtrim(s, F.lit(_SPACES))


def words(s: Column) -> Column:
    """Split at any run of white space; blank text has no words."""
    text = strip(s)
    return F.when(text == "", F.array().cast("array<string>")).otherwise(F.split(text, _SPACE_CLASS + "+"))


def split_at(s: Column, separator: str) -> Column:
    """Split at a literal separator, keeping empty pieces."""
    return F.split(s, re.escape(separator))


def characters(s: Column) -> Column:
    """Letters of a text in order; empty text has none."""
    return F.filter(F.split(s, ""), lambda c: c != "")


def capitalize(s: Column) -> Column:
    """First letter upper, the rest lower; a letter such as ß becomes Ss."""
    first = F.upper(F.substring(s, 1, 1))
    head = F.concat(F.substring(first, 1, 1), F.lower(F.substr(first, F.lit(2))))
    return F.concat(head, F.lower(F.substr(s, F.lit(2))))


def title(s: Column) -> Column:
    """Every run of letters capitalised, also after an apostrophe or a digit."""
    pieces = F.split(s, f"(?<![{_CASED}])(?=[{_CASED}])")  # each starts with a letter run

    def plain(w: Column) -> Column:
        return F.concat(F.upper(F.left(w, F.lit(1))), F.lower(F.substr(w, F.lit(2))))

    return F.when(
        s.rlike(f"(?<![{_CASED}])[{_LONG_CAPITALS}]"), F.array_join(F.transform(pieces, capitalize), "")
    ).otherwise(F.array_join(F.transform(pieces, plain), ""))


def swapcase(s: Column) -> Column:
    """Upper and lower letters exchanged."""
    runs = F.regexp_extract_all(s, F.lit(r"(\p{Lu}+|[^\p{Lu}]+)"), F.lit(1))
    return F.array_join(
        F.transform(runs, lambda r: F.when(r.rlike(r"\A\p{Lu}"), F.lower(r)).otherwise(F.upper(r))), ""
    )


def find(s: Column, sub: str) -> Column:
    """0-based place of the first occurrence, -1 if there is none."""
    return F.instr(s, sub) - 1


def count(s: Column, sub: str) -> Column:
    """Occurrences that do not overlap."""
    without = F.length(F.replace(s, F.lit(sub), F.lit("")))
    return ((F.length(s) - without) / len(sub)).cast("int")


def count_any(s: Column, letters: str) -> Column:
    """How many characters of ``s`` are among ``letters``."""
    return F.length(s) - F.length(F.translate(s, letters, ""))


def is_alpha(s: Column) -> Column:
    return s.rlike(r"\A\p{L}+\z")


def is_digit(s: Column) -> Column:
    return s.rlike(rf"\A[\p{{Nd}}{_OTHER_DIGITS}]+\z")


def zfill(s: Column, width: int) -> Column:
    """Pad with zeros on the left, after a sign; longer text is kept."""
    sign = F.when(s.rlike("^[+-]"), F.substring(s, 1, 1)).otherwise(F.lit(""))
    digits = F.when(s.rlike("^[+-]"), F.substr(s, F.lit(2))).otherwise(s)
    missing = F.greatest(F.lit(width) - F.length(s), F.lit(0))
    return F.concat(sign, F.repeat(F.lit("0"), missing), digits)

"""Text to typed values; whatever cannot be parsed becomes null."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character that counts as white space in Unicode text.
WHITE_SPACE = (
    " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

DATE_PATTERNS = ("yyyy'M'MM", "yyyy'M'M", "yyyy/MM/dd", "MM/dd/yyyy", "MMM yyyy", "MMM-yyyy")


# A comma and the CSV cell behind it: quoted, with doubled quotes inside, or plain.
CSV_CELL = r',(?:"(?:[^"]|"")*+"[^,]*+|[^,]*+)'


def let(value: Column, f: Callable[[Column], Column]) -> Column:
    """f of a value that is computed once, however often f uses it inside lambdas."""
    return F.transform(F.array(value), f)[0]


def csv_cells(line: Column) -> Column:
    """The cells of a CSV line as text, without their quotes; empty ones are null."""
    def plain(cell: Column) -> Column:
        text = F.substr(cell, F.lit(2))
        inner = F.regexp_replace(F.regexp_extract(text, r'^"((?:[^"]|"")*+)"', 1), '""', '"')
        return F.nullif(F.when(text.startswith('"'), F.when(text.rlike(r'^"(?:[^"]|"")*+"'), inner).otherwise(text)).otherwise(text), F.lit(""))

    return F.transform(F.regexp_extract_all(F.concat(F.lit(","), line), F.lit(CSV_CELL), F.lit(0)), plain)


def nan_to_null(value: Column) -> Column:
    return F.when(~F.isnan(value), value)


def parse_number(text: Column) -> Column:
    """Decimal number. Java's parser also reads type suffixes ('5d'), hexadecimal and words
    such as 'inf'; none of them is a number in a feed."""
    plain = strip(text)
    ends_well = F.substring(plain, -1, 1).between("0", "9") | plain.endswith(".")
    hexadecimal = plain.contains("x") | plain.contains("X")
    return F.when(ends_well & ~hexadecimal, plain.try_cast("double"))


def parse_year(text: Column) -> Column:
    """Whole years only; '2015' and '2015.0' both give 2015."""
    number = parse_number(text)
    whole = F.when(number == F.floor(number), number.try_cast("int"))
    # a point is in no whole number; without the test each such text would cost an exception
    return F.coalesce(F.when(~text.contains("."), text.try_cast("int")), whole)


def parse_date(text: Column, patterns: Sequence[str] = DATE_PATTERNS) -> Column:
    """First reading that works: ISO forms ('2020', '2020-01', '2020-01-15'), then patterns."""
    readings = [F.try_to_timestamp(text)]
    readings += [F.try_to_timestamp(text, F.lit(p)) for p in patterns]
    return F.to_date(F.coalesce(*readings))


def strip(text: Column) -> Column:
    """All leading and trailing white space (``trim`` takes blanks only)."""
    return F.btrim(text, F.lit(WHITE_SPACE))


def strip_punctuation(text: Column, keep: str = "", unicode: bool = False) -> Column:
    """Keep word characters, white space and the characters in ``keep``."""
    flag = "(?U)" if unicode else ""
    return F.regexp_replace(text, rf"{flag}[^\w\s{keep}]", "")

"""Text rules for names, keys and graph terms, with Python's notion of blanks and case."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed value: the characters that Python counts as white space.
_BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
_CASED = r"[\p{IsLowercase}\p{IsUppercase}\p{Lt}]"
_UNCASED = r"[^\p{IsLowercase}\p{IsUppercase}\p{Lt}]"


def python_strip(c: Column) -> Column:
    """Remove white space of any script at both ends."""
    return F.btrim(c, F.lit(_BLANKS))


def normalize_name(c: Column) -> Column:
    """Lower case, punctuation ``. - _ ,`` as blanks, blanks collapsed and trimmed."""
    to_blank = _BLANKS + ".-_,"
    spaced = F.translate(F.lower(c), to_blank, " " * len(to_blank))
    return F.trim(F.regexp_replace(spaced, " {2,}", " "))


def squeeze(c: Column) -> Column:
    """Drop every blank."""
    return F.replace(c, F.lit(" "), F.lit(""))


def python_title(c: Column) -> Column:
    """Title case in which every uncased character starts a new word (``O'Neil``, ``D.G``)."""
    runs = F.regexp_extract_all(c, F.lit(f"{_CASED}+|{_UNCASED}+"), F.lit(0))
    by_run = F.array_join(
        F.transform(runs, lambda run: F.when(run.rlike(f"^{_CASED}"), F.initcap(run)).otherwise(run)), ""
    )
    # initcap() starts words after blanks only, which is the same unless the text leaves plain
    # ASCII or a letter follows another character (listed as such, as Java is slow on negated classes).
    beyond_ascii = F.octet_length(c) != F.length(c)
    letter_after_other = c.rlike(r"[\x00-\x1f!-@\[-`{-\x7f][A-Za-z]")
    return F.when(beyond_ascii | letter_after_other, by_run).otherwise(F.initcap(c))


def gazetteer_key(name: Column, country: Column) -> Column:
    """``lahore|pakistan``"""
    return F.concat(F.lower(python_strip(name)), F.lit("|"), F.lower(country))


def underscored(name: Column) -> Column:
    """Name as part of an IRI: blanks become underscores, nothing else is encoded."""
    return F.replace(name, F.lit(" "), F.lit("_"))


def mint_iri(namespace: str, kind: str, name: Column) -> Column:
    """IRI of an entity: namespace, kind, slash and name."""
    return F.concat(F.lit(f"{namespace}{kind}/"), underscored(name))


def local_name(c: Column) -> Column:
    """Text after the last slash."""
    return F.substring_index(c, "/", -1)


def exponent_text(power: Column) -> Column:
    """``e+07``, ``e-12``, ``e+300``"""
    digits = F.abs(power).cast("string")
    return F.concat(
        F.when(power < 0, F.lit("e-")).otherwise(F.lit("e+")),
        F.when(F.length(digits) < 2, F.lit("0")).otherwise(F.lit("")),
        digits,
    )


def float_text(c: Column) -> Column:
    """Shortest text of a double in positional form from 1e-4 up to 1e16, else ``1e+16``."""
    x = c.cast("double")
    raw = x.cast("string")
    exponent = F.regexp_extract(raw, r"E(-?\d+)$", 1).try_cast("int")
    mantissa = F.regexp_replace(F.substring_index(raw, "E", 1), r"\.0$", "")
    scientific = F.concat(
        mantissa,
        exponent_text(exponent),
    )
    positional = F.regexp_replace(x.try_cast("decimal(38,21)").cast("string"), r"(\.\d+?)0+$", "$1")
    return (
        F.when(F.isnan(x), F.lit("nan"))
        .when(raw == "Infinity", F.lit("inf"))
        .when(raw == "-Infinity", F.lit("-inf"))
        .when(~F.contains(raw, F.lit("E")), raw)
        .when((exponent >= -4) & (exponent < 16), positional)
        .otherwise(scientific)
    )

"""Text functions: folded names, house numbers, cuts on character boundaries."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Accented letters and their base letters; the length of a folded name.
ACCENTS = "äÄöÖüÜéèêëÉÈÊËàáâãåÀÁÂÃÅíìîïÍÌÎÏóòôõÓÒÔÕúùûÚÙÛçÇñÑ"
BASES = "AAOOUUEEEEEEEEAAAAAAAAAAIIIIIIIIOOOOOOOOUUUUUUCCNN"
FOLD_LENGTH = 24


def fold(name: Column) -> Column:
    """upper case A-Z 0-9 and single blanks, 24 characters at most (the cut may leave a blank at the end)."""
    s = F.upper(F.replace(F.translate(name, ACCENTS, BASES), F.lit("ß"), F.lit("SS")))
    s = F.translate(F.regexp_replace(s, "[^A-Z0-9 _/-]", ""), "-_/", "   ")
    return F.substring(F.trim(F.regexp_replace(s, " +", " ")), 1, FOLD_LENGTH)


def house_number(hn: Column) -> Column:
    """trimmed, without blanks, ASCII only, 7 characters at most."""
    return F.substring(F.regexp_replace(F.replace(F.regexp_replace(hn, r"^\s+|\s+$", ""), F.lit(" "), F.lit("")), r"[^\x00-\x7F]", ""), 1, 7)


def number_key(number: Column) -> Column:
    """the integer of the ASCII digits, 0 if there are none."""
    digits = F.regexp_replace(number, "[^0-9]", "")
    return F.when(digits == "", 0).otherwise(digits.cast("long")).cast("long")


def cut_bytes(s: Column, most: int) -> Column:
    """The longest prefix of ``most`` UTF-8 bytes at most, on a character boundary."""
    lengths = F.filter(F.sequence(F.lit(0), F.lit(most)), lambda n: F.octet_length(F.substring(s, F.lit(1), n)) <= most)
    return F.when(F.octet_length(s) <= most, s).otherwise(F.substring(s, F.lit(1), F.array_max(lengths)))

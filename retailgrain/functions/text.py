"""Text helpers: comparison form, addresses, barcodes, row digests."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from retailgrain.rules.fixed_values import SPECIAL_CHARACTERS

WHITESPACE = " \t\n\r\x0b\x0c"
BARCODE_LENGTH = 12


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITESPACE))


def str_normalize(text: Column) -> Column:
    """The form texts are compared in: no outer whitespace, lower case."""
    return F.lower(strip(text))


def str_contains(text: Column, pattern: str) -> Column:
    return F.contains(text, F.lit(pattern))


def join_nullable(first: Column, second: Column) -> Column:
    """``first + ' ' + second`` without outer whitespace; NULL only when ``first`` is."""
    return strip(F.concat(first, F.lit(" "), F.coalesce(second, F.lit(""))))


def fix_address_spacing(address: Column) -> Column:
    """Put a space after every dot of an address that has none yet."""
    glued = str_contains(address, ".") & ~str_contains(strip(address), ". ")
    return F.when(glued, F.replace(address, F.lit("."), F.lit(". "))).otherwise(address)


def normalize_barcode(code: Column) -> Column:
    """Twelve-character barcode from a number, or from text that holds one.

    Text that is no number keeps its own characters, without dots and outer
    whitespace, cut to twelve.
    """
    text = strip(code.cast("string"))
    digits = F.floor(text.try_cast("decimal(30,6)")).cast("string")
    as_text = F.substring(strip(F.replace(text, F.lit("."), F.lit(""))), 1, BARCODE_LENGTH)
    return F.coalesce(F.lpad(digits, BARCODE_LENGTH, "0"), F.nullif(as_text, F.lit("")))


def clean_text(text: Column, characters: str = SPECIAL_CHARACTERS) -> Column:
    return strip(F.translate(text, characters, ""))


def row_digest(columns: list[str]) -> Column:
    """Hash of a row's content as a non-negative 60-bit number; sums of it ignore row order."""
    text = F.concat_ws("\x1f", *[F.coalesce(F.col(c).cast("string"), F.lit("\x00")) for c in columns])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("decimal(38,0)")

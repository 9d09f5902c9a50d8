"""Text rules as column expressions, and the few that need Python."""

from __future__ import annotations

import re
import unicodedata
from itertools import groupby

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Legacy one-byte Vietnamese letters and their Unicode letters, place by place (fixed values).
LEGACY = "µ¸¶·¹¨»¾¼½Æ©ÇÊÈÉË®ÌÐÎÏÑªÒÕÓÔÖ×ÝØÜÞßãáâä«åèæçé¬êíëìîïóñòôõøö÷ùúýûüþ¡¢§£¤¥¦­"
LETTERS = "àáảãạăằắẳẵặâầấẩẫậđèéẻẽẹêềếểễệìíỉĩịòóỏõọôồốổỗộơờớởỡợùúủũụừứửữựỳýỷỹỵĂÂĐÊÔƠƯư"
#: Legacy letters that correct prose never has (fixed values).
STRONG = "µ¸¶·¹¨»¾¼½Æ©ÇÊÈÉË®ÌÐÎÏÑªÒÕÓÔÖ×ÝØÜÞß«åæ¬ëîïñö÷ûüþ¡¢§£¤¥¦"
GARBLED = "§©®µ¶¸¹º»¼½¾¿"


def compact(s: Column) -> Column:
    """H1: line feeds only, no NUL, single blanks, trimmed."""
    s = F.replace(F.regexp_replace(s, "\r\n?", "\n"), F.lit("\u0000"), F.lit(""))
    return F.regexp_replace(F.regexp_replace(s, "[ \t]+", " "), r"^[ \t\n\x0B\f]+|[ \t\n\x0B\f]+$", "")


@F.pandas_udf(T.StringType())
def nfc(s: pd.Series) -> pd.Series:
    """Canonical composition; no built-in does it."""
    return s.map(lambda x: x if x is None or x.isascii() else unicodedata.normalize("NFC", x))


def normalized(s: Column) -> Column:
    """H3: composed, line feeds only, no NUL, trimmed, one line feed at the end; empty stays empty."""
    body = F.replace(F.regexp_replace(nfc(s), "\r\n?", "\n"), F.lit("\u0000"), F.lit(""))
    body = F.regexp_replace(body, r"^[\s\x0B]+|[\s\x0B]+$", "")
    return F.when(body == "", "").otherwise(F.concat(body, F.lit("\n")))


def clean_value(s: Column, most: int = 4000) -> Column:
    """H4: white space collapsed, empty is null, over ``most`` characters is null (see value_error)."""
    v = F.regexp_replace(F.regexp_replace(s, r"(?U)\s+", " "), "^ | $", "")
    return F.when((v != "") & (F.char_length(v) <= most), v)


def value_error(s: Column, most: int = 4000) -> Column:
    v = F.regexp_replace(F.regexp_replace(s, r"(?U)\s+", " "), "^ | $", "")
    return F.when(F.char_length(v) > most, "value_too_long")


def iso_date(s: Column) -> Column:
    """H7: a date only of the form YYYY-MM-DD that exists."""
    return F.when(s.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.try_to_date(s, "yyyy-MM-dd"))


def local_date(s: Column) -> Column:
    """H8: day first, with hyphens or slashes, one or two digits."""
    return F.coalesce(F.try_to_date(s, "d-M-yyyy"), F.try_to_date(s, "d/M/yyyy"))


def legacy_to_unicode(s: Column) -> Column:
    """The legacy alphabet's letters replaced."""
    return F.translate(s, LEGACY, LETTERS)


def count_chars(s: Column, chars: str) -> Column:
    return F.char_length(s) - F.char_length(F.translate(s, chars, ""))


def recover_legacy(s: Column, font_evidence: Column | None = None) -> Column:
    """Lines of a document with at least three strong letters, or whose fonts say so (H14), are replaced, unless they hold letters that only Unicode has."""
    unicode_only = "[ĂăĐđĨĩŨũƠơƯưẠ-ỹ]"
    lines = F.transform(F.split(s, "\n"), lambda x: F.when(x.rlike(unicode_only), x).otherwise(legacy_to_unicode(x)))
    told = F.lit(False) if font_evidence is None else F.coalesce(font_evidence, F.lit(False))
    return F.when(told | (count_chars(s, STRONG) >= 3), F.array_join(lines, "\n")).otherwise(s)


#: Names of fonts that hold the legacy letters (fixed value).
LEGACY_FONT = r"(?:^|[.\s])(vn(?:time|arial|helvet|book|courier)|vntimeh)\b"


def legacy_fonts(head: Column) -> Column:
    """The distinct legacy fonts that an RTF font table declares, in order of names."""
    fonts = F.regexp_extract_all(head, F.lit(r"\\f\d+[^;{}]*? ([^;{}\\]+);"), F.lit(1))
    return F.array_sort(F.array_distinct(F.filter(F.transform(fonts, F.trim), lambda f: f.rlike(f"(?i){LEGACY_FONT}"))))


def redactions(s: Column) -> tuple[Column, Column]:
    """Text with e-mails, mobile numbers and 18-place ids replaced in this order, and the counts.

    An e-mail's name starts where its run of characters does, or where the match before it ended, and takes all that is
    left of the run, so no run is tried from each of its places.
    """
    email = r"(?:(?<![A-Za-z0-9_.+-])|\G)[A-Za-z0-9_.+-]++@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
    rules = [("TOKEN", "gAAAA[A-Za-z0-9_=-]+"), ("EMAIL", email), ("MOBILE", r"(?<![0-9])1[3-9][0-9]{9}(?![0-9])"), ("IDENTITY", r"(?<![0-9])[0-9]{17}[0-9Xx](?![0-9])")]
    counts = []
    for label, pattern in rules:
        counts.append(F.regexp_count(s, F.lit(pattern)).alias(label.lower()))
        s = F.regexp_replace(s, pattern, f"[REDACTED_{label}]")
    return s, F.struct(*counts)


def markdown_table(rows: Column) -> Column:
    """An array of rows of cells as a table: equal widths, header, rule, pipes escaped."""
    width = F.array_max(F.transform(rows, lambda r: F.size(r)))
    line = lambda r: F.concat(F.lit("| "), F.array_join(F.concat(F.transform(r, lambda c: F.replace(c, F.lit("|"), F.lit("\\|"))), F.array_repeat(F.lit(""), width - F.size(r))), " | "), F.lit(" |"))
    rule = F.concat(F.lit("|"), F.repeat(F.lit(" --- |"), width))
    lines = F.transform(rows, line)
    return F.array_join(F.concat(F.slice(lines, 1, 1), F.array(rule), F.slice(lines, 2, F.greatest(F.size(lines) - 1, F.lit(0)))), "\n")


def safe_name(title: Column, most: int = 150) -> Column:
    """H5: a file name of at most ``most`` UTF-8 bytes; ``document`` where nothing is left of the title."""
    cleaned = F.regexp_replace(nfc(title), r'[\x00-\x1F\x7F/\\:*?"<>|]+', "_")
    trimmed = F.btrim(F.regexp_replace(cleaned, r"(?U)\s+", " "), F.lit(" ._"))
    raw = F.encode(F.left(trimmed, F.lit(most)), "utf-8")
    # a character has at most four bytes, so one of these cuts is between two characters
    cut = F.coalesce(*[F.try_validate_utf8(F.substring(raw, 1, most - k).cast("string")) for k in range(4)])
    return F.when(title.isNotNull(), F.coalesce(F.nullif(F.rtrim(cut, F.lit(" ._")), F.lit("")), F.lit("document")))


# --- rules that need Python -------------------------------------------------------------------------------


_MARKS = str.maketrans({c: f"\\{c}" for c in "\\`*_[]<>|"})
#: A first character, or number, that would start a heading, a list or a rule.
_STARTS = re.compile(r"([#+\-=](?!\S)|\d+(?=[.)](?!\S)))")


def escape_markdown(value: str) -> str:
    """H2: plain text as Markdown: paragraphs of composed, trimmed lines, whose marks are escaped and whose breaks are kept."""

    def line(raw: str) -> str:
        told = re.sub("[ \t]+", " ", raw).strip().translate(_MARKS)
        if found := _STARTS.match(told):
            sign = found[1]
            told = f"{sign}\\{told[len(sign):]}" if sign.isdigit() else f"\\{told}"
        return told

    lines = [line(x) for x in re.split("\r\n|\r|\n", unicodedata.normalize("NFC", value.replace("\x00", "")))]
    paragraphs = ["  \n".join(some) for filled, some in groupby(lines, key=bool) if filled]
    return "\n\n".join(paragraphs) + "\n" if paragraphs else ""


def mapped(f, kind: str = "string"):
    """A pandas UDF of a row function; null stays null."""

    @F.pandas_udf(kind)
    def run(s: pd.Series) -> pd.Series:
        return s.map(lambda x: None if x is None else f(x))

    return run


def container_kind(body: Column) -> Column:
    """The container by its first bytes; zip names and text need detect() in operators.containers."""
    head = F.hex(F.substring(body, 1, 8))
    return (
        F.when(head.startswith("255044462D"), "pdf").when(head.startswith("504B0304"), "zip").when(head == "D0CF11E0A1B11AE1", "ole").when(head.startswith("7B5C727466"), "rtf")
        .when(F.lower(F.ltrim(F.decode(F.substring(body, 1, 2048), "iso-8859-1"))).rlike("^(?:<!doctype html|<html|<head|<body)"), "html")
        .when(F.ltrim(F.decode(F.substring(body, 1, 64), "iso-8859-1")).rlike(r"^[\[{]"), "json").otherwise("txt")
    )

"""Text rules as Spark column expressions.

The rules follow Python's text semantics (Unicode white space, ``splitlines``
boundaries, code-point lengths). Only functions with generated code are used, no
higher-order functions, so that they fuse with the scan or shuffle around them.
"""

from __future__ import annotations

import re

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, functions as F

from millrace.functions import fixed

ColumnOrName = Column | str


def _col(value: ColumnOrName) -> Column:
    return F.col(value) if isinstance(value, str) else value


def _holds_any(content: Column, markers: Iterable[str]) -> Column:
    """True when a text holds one of the markers. This is a search on bytes, which costs
    a small part of a regular expression over the same text."""
    return reduce(Column.__or__, [F.contains(content, F.lit(m)) for m in markers])


def _rewrite(content: Column, markers: Iterable[str], rewritten: Column) -> Column:
    """The rewritten text, computed only for texts that hold one of the markers."""
    return F.when(_holds_any(content, markers), rewritten).otherwise(content)


# --- bytes ---------------------------------------------------------------------
def is_binary(raw: ColumnOrName) -> Column:
    """True for bytes holding NUL or a control byte that text does not use.

    The decoded text is searched: these bytes stand for themselves in UTF-8 and in Latin-1.
    """
    return decode_text(raw).rlike(fixed.BINARY_BYTES)


def decode_text(raw: ColumnOrName) -> Column:
    """Bytes as UTF-8 when they are valid UTF-8, else as Latin-1."""
    as_utf8 = _col(raw).cast("string")
    return F.when(F.is_valid_utf8(as_utf8), as_utf8).otherwise(
        F.decode(_col(raw), "ISO-8859-1")
    )


def fingerprint(value: ColumnOrName) -> Column:
    """SHA-1 in hex. Strings are hashed as their UTF-8 bytes."""
    return F.sha1(_col(value).cast("binary"))


# --- normalisation ---------------------------------------------------------------
def normalize_whitespace(content: ColumnOrName) -> Column:
    """Each run of tab, VT, FF and CR becomes one space; spaces stay as they are."""
    text = _col(content)
    spaced = F.regexp_replace(text, fixed.HORIZONTAL_RUN, " ")
    return _rewrite(text, fixed.HORIZONTAL_CHARS, spaced)


def strip_text(content: ColumnOrName) -> Column:
    """Drop Unicode white space from both ends."""
    return F.btrim(_col(content), F.lit(fixed.WHITESPACE_CHARS))


def collapse_blank_lines(content: ColumnOrName) -> Column:
    """Three or more line feeds in a row become two."""
    text = _col(content)
    collapsed = F.regexp_replace(text, fixed.BLANK_LINES_RUN, "\n\n")
    return _rewrite(text, ["\n\n\n"], collapsed)


def _single_breaks(content: Column) -> Column:
    """CR LF as a line feed, so that every line boundary is one character of a class."""
    return F.replace(content, F.lit("\r\n"), F.lit("\n"))


def unix_lines(content: ColumnOrName, *, absent: str = "") -> Column:
    """Every line boundary as a line feed. ``absent`` names boundaries that the text is
    known not to hold."""
    text = _col(content)
    markers = [c for c in fixed.FOREIGN_LINE_BREAK_CHARS if c not in absent]
    rewritten = F.regexp_replace(_single_breaks(text), fixed.FOREIGN_LINE_BREAK, "\n")
    return _rewrite(text, markers, rewritten)


def _cut_lines(unix: Column, width: int) -> Column:
    """Cut lines at ``width`` code points; anchored at line starts, hence linear."""
    return F.regexp_replace(unix, rf"(?md)^([^\n]{{{int(width)}}})[^\n]+", "$1")


def truncate_lines(content: ColumnOrName, width: int) -> Column:
    """Cut every line at ``width`` code points.

    Every line boundary comes out as a line feed, and one boundary at the very end is
    dropped.
    """
    return _cut_lines(F.regexp_replace(unix_lines(content), r"\n\z", ""), width)


def normalise_content(
    content: ColumnOrName,
    *,
    whitespace: bool = True,
    strip_empty_lines: bool = True,
    max_line_length: int | None = 2000,
) -> Column:
    """White space, outer and inner blank lines, line length: in this order."""
    result = _col(content)
    if whitespace:
        result = normalize_whitespace(result)
    if strip_empty_lines:
        result = collapse_blank_lines(strip_text(result))
    if max_line_length and strip_empty_lines:
        # A stripped text has no boundary at its end.
        absent = fixed.HORIZONTAL_CHARS if whitespace else ""
        result = _cut_lines(unix_lines(result, absent=absent), max_line_length)
    elif max_line_length:
        result = truncate_lines(result, max_line_length)
    return result


# --- lines -----------------------------------------------------------------------
def line_pieces(content: ColumnOrName, *, unix_only: bool = False) -> Column:
    """Text split at line boundaries; keeps an empty piece behind a final boundary.

    ``unix_only`` says that line feeds are the only boundaries left in the text.
    """
    text = _col(content)
    pieces = F.split(text, "\n", -1)
    if unix_only:
        return pieces
    foreign = _holds_any(text, fixed.FOREIGN_LINE_BREAK_CHARS)
    return F.when(foreign, F.split(_single_breaks(text), fixed.LINE_BREAK, -1)).otherwise(pieces)


def piece_count(pieces: ColumnOrName) -> Column:
    """Number of lines in the result of :func:`line_pieces`; 0 for an empty text."""
    open_end = F.when(F.element_at(_col(pieces), -1) == "", 1).otherwise(0)
    return (F.size(_col(pieces)) - open_end).cast("bigint")


def split_lines(content: ColumnOrName) -> Column:
    """Lines of a text, without an extra empty one behind a final boundary."""
    pieces = line_pieces(content)
    return F.slice(pieces, F.lit(1), piece_count(pieces).cast("int"))


def line_count(content: ColumnOrName) -> Column:
    """0 for an empty text, else the number of line feeds plus one."""
    text = _col(content)
    feeds = F.octet_length(text) - F.octet_length(F.replace(text, F.lit("\n"), F.lit("")))
    return F.when(text == "", 0).otherwise(feeds + 1).cast("bigint")


# --- command lines -----------------------------------------------------------------
def is_comment_line(line: ColumnOrName) -> Column:
    """True for a line that starts like a comment, in any letter case."""
    starts = dict.fromkeys(re.escape(s.lower()) for s in fixed.COMMENT_STARTS)
    return F.lower(_col(line)).rlike(rf"\A(?:{'|'.join(starts)})")


def strip_prompt(line: ColumnOrName) -> Column:
    """Drop one shell prompt at the start and the white space behind it."""
    starts = "|".join(map(re.escape, fixed.PROMPT_STARTS))
    return F.regexp_replace(_col(line), rf"\A(?:{starts}){fixed.WHITESPACE_CLASS}*+", "")


def collapse_command(line: ColumnOrName) -> Column:
    """Words of a line joined by single spaces."""
    return F.regexp_replace(strip_text(line), f"{fixed.WHITESPACE_CLASS}+", " ")


def slugify(name: ColumnOrName, fallback: str = "commands") -> Column:
    """File-name form: letters, digits, ``-`` and ``_``; anything else becomes ``-``."""
    safe = F.regexp_replace(F.lower(strip_text(name)), r"[^\p{L}\p{N}_-]", "-")
    return F.coalesce(F.nullif(F.btrim(safe, F.lit("-")), F.lit("")), F.lit(fallback))

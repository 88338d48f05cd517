"""Path rules as Spark column expressions."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from itertools import chain

from pyspark.sql import Column, functions as F

from millrace.functions import fixed
from millrace.functions.text import ColumnOrName, _col


def file_name(path: ColumnOrName) -> Column:
    return F.substring_index(_col(path), "/", -1)


def extension(path: ColumnOrName) -> Column:
    """Lower-cased suffix with its dot; empty for names such as ``Makefile`` or ``.profile``."""
    return F.lower(F.regexp_extract(file_name(path), fixed.SUFFIX, 1))


def detect_language(path: ColumnOrName) -> Column:
    """Language of a file by its suffix."""
    table = F.create_map(*[F.lit(x) for x in chain(*fixed.LANGUAGE_BY_EXTENSION.items())])
    return F.coalesce(
        F.try_element_at(table, extension(path)), F.lit(fixed.UNKNOWN_LANGUAGE)
    )


def allowed_extension(path: ColumnOrName, allowed: Sequence[str]) -> Column:
    """Keep files without a suffix, and any file when the list is empty."""
    if not allowed:
        return F.lit(True)
    suffix = extension(path)
    return (suffix == "") | suffix.isin(*allowed)


def inside_directory(path: ColumnOrName, names: Iterable[str]) -> Column:
    """True when a directory of a relative path, at any depth, has one of these names."""
    quoted = [java_quote(name) for name in names]
    if not quoted:
        return F.lit(False)
    return _col(path).rlike(rf"(?:\A|/)(?:{'|'.join(quoted)})/")


def relative_path(path: ColumnOrName, root: ColumnOrName) -> Column:
    """Part of a path below its root; separators are ``/``."""
    prefix = F.rtrim(_col(root), F.lit("/"))
    return F.substr(_col(path), F.length(prefix) + 2)


def java_quote(text: str) -> str:
    """Literal text for a Java regular expression."""
    return re.sub(r"([^0-9A-Za-z_/ ])", lambda m: f"\\x{{{ord(m.group(1)):X}}}", text)


def glob_regex(pattern: str) -> str:
    """Java regular expression for one shell-style pattern; ``*`` crosses ``/``."""
    body, i = [], 0
    while i < len(pattern):
        ch, i = pattern[i], i + 1
        if ch == "*":
            body.append(".*")
        elif ch == "?":
            body.append(".")
        elif ch == "[" and (end := pattern.find("]", i + (pattern[i : i + 1] == "!") + 1)) != -1:
            body.append(_glob_set(pattern[i:end]))
            i = end + 1
        else:
            body.append(java_quote(ch))
    return r"(?s)\A" + "".join(body) + r"\z"


def _glob_set(inner: str) -> str:
    """Bracket set of a glob as a Java class; empty ranges match nothing."""
    negated = inner.startswith("!")
    rest, members = inner[negated:], []
    while rest:
        if len(rest) >= 3 and rest[1] == "-":
            low, high, rest = rest[0], rest[2], rest[3:]
            if low <= high:
                members.append(f"{java_quote(low)}-{java_quote(high)}")
        else:
            members.append(java_quote(rest[0]))
            rest = rest[1:]
    if not members:
        return "." if negated else "(?!)"
    return f"[{'^' if negated else ''}{''.join(members)}]"


def matches_globs(path: ColumnOrName, patterns: Sequence[str]) -> Column:
    """True when the whole path or the file name, lower-cased, matches any pattern."""
    if not patterns:
        return F.lit(False)
    regex = "|".join(f"(?:{glob_regex(p.lower())})" for p in patterns)
    lowered = F.lower(_col(path))
    return lowered.rlike(regex) | F.substring_index(lowered, "/", -1).rlike(regex)

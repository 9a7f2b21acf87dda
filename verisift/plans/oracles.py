"""Fragments of DuckDB SQL with Python's notion of white space and words."""

from __future__ import annotations

SPACE = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]"
INK = r"[^\s\x0b\x1c-\x1f\x{85}\p{Z}]"
WORD = r"[\p{L}\p{N}_]"


def strip(x: str) -> str:
    return f"regexp_replace(regexp_replace({x}, '^{SPACE}+', ''), '{SPACE}+$', '')"


def words(x: str) -> str:
    return f"list_filter(string_split_regex({x}, '{SPACE}+'), lambda w: w <> '')"


def blank(x: str) -> str:
    return f"(NOT regexp_matches({x}, '{INK}'))"


def count(x: str, pattern: str) -> str:
    return f"len(regexp_extract_all({x}, '{pattern}'))"


def normalize(x: str) -> str:
    return f"lower(array_to_string({words(f'coalesce({x}, {chr(39) * 2})')}, ' '))"


def paragraphs(p: str) -> str:
    return f"(CASE WHEN len(list_filter({p}, lambda s, i: i > 1 AND i < len({p}) AND {blank('s')})) > 0 THEN -1 ELSE len({p}) - {blank(f'{p}[1]')}::INT - (CASE WHEN len({p}) > 1 THEN {blank(f'{p}[len({p})]')}::INT ELSE 0 END) END)"


def bare(w: str) -> str:
    return f"lower(regexp_replace({w}, '[^\\p{{L}}\\p{{N}}_]', '', 'g'))"

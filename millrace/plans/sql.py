"""Pieces of DuckDB SQL that the oracles share."""

from __future__ import annotations

from collections.abc import Sequence

WS = "(' ' || chr(9) || chr(10) || chr(13) || chr(12) || chr(11))"


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def strip(x: str) -> str:
    return f"trim({x}, {WS})"


def words(x: str) -> str:
    return rf"regexp_extract_all({x}, '\S+')"


def wc(x: str) -> str:
    return f"len({words(x)})"


def sents(x: str) -> str:
    return rf"list_filter(list_transform(string_split(regexp_replace({x}, '([.!?])\s+', '\1' || chr(1), 'g'), chr(1)), lambda s: {strip('s')}), lambda s: s <> '')"


def hits(x: str, keys: Sequence[str]) -> str:
    return "(" + " + ".join(f"(contains({x}, {q(k)}))::INT" for k in keys) + ")"


def any_of(x: str, keys: Sequence[str]) -> str:
    return "(" + " OR ".join(f"contains({x}, {q(k)})" for k in keys) + ")"


def in_list(x: str, keys: Sequence[str]) -> str:
    return f"{x} IN ({', '.join(q(k) for k in dict.fromkeys(keys))})"


def array(keys: Sequence[str]) -> str:
    return "[" + ", ".join(q(k) for k in keys) + "]"


def mean(xs: str) -> str:
    return f"list_aggregate({xs}, 'avg')"


def deviation(xs: str) -> str:
    return f"list_aggregate({xs}, 'stddev_pop')"


def md5_int(x: str) -> str:
    """The first eight hex digits of an md5 as a number."""
    return f"('0x' || substr(md5({x}), 1, 8))::BIGINT"


#: documents as records: the first line is the instruction, the rest the output.
RECORDS = """records AS (
  SELECT doc_id, split_part(text, chr(10), 1) AS instruction,
         CASE WHEN contains(text, chr(10)) THEN substr(text, strpos(text, chr(10)) + 1) ELSE '' END AS output, source FROM documents)"""

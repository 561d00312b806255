"""DuckDB SQL fragments mirroring ``functions.text`` (oracle side only).

DuckDB uses RE2, whose ``\\s`` is ASCII; the class below spells out Python's
whitespace set (ASCII whitespace, U+001C..U+001F, U+0085, Unicode separators).
"""

from __future__ import annotations

WS = r"[\s\v\x{1c}-\x{1f}\x{85}\p{Z}]"
NL = "chr(10)"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}+|{WS}+\\z', '', 'g')"


def first_line(x: str) -> str:
    return f"split_part({x}, {NL}, 1)"


def after_first_line(x: str) -> str:
    return f"CASE WHEN strpos({x}, {NL}) > 0 THEN substr({x}, strpos({x}, {NL}) + 1) END"


def normalize(x: str) -> str:
    t = f"lower({x})"
    t = f"regexp_replace({t}, '\\\\[a-z]+\\{{([^}}]*)\\}}', '\\1', 'g')"
    t = f"regexp_replace({t}, 'https?://[^\\s\\v\\x{{1c}}-\\x{{1f}}\\x{{85}}\\p{{Z}}]+', 'URL', 'g')"
    t = f"replace({t}, {NL}, ' ')"
    t = f"regexp_replace({t}, '{WS}+', ' ', 'g')"
    return f"trim({t}, ' ')"


def title_key(x: str) -> str:
    return f"lower(regexp_replace({x}, '[^a-zA-Z0-9]', '', 'g'))"


URL_PREFIX = "https://papers.example.org/paper/"

PAPERS_CTE = f"""
papers AS (
  SELECT doc_id AS paper_id, lang, source AS venue,
         {strip(first_line('text'))} AS title,
         {strip(after_first_line('text'))} AS abstract,
         '{URL_PREFIX}' || CAST(doc_id AS VARCHAR) AS url
  FROM documents),
tagged AS (
  SELECT *, CASE WHEN title IS NULL OR {strip('title')} = '' THEN 'missing title'
                 WHEN abstract IS NULL OR {strip('abstract')} = '' THEN 'missing abstract' END AS reason
  FROM papers),
kept AS (SELECT * FROM tagged WHERE reason IS NULL)"""

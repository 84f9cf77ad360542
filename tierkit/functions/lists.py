"""Parse list-valued text such as ``['A', 'B']`` into ``array<string>``.

All patterns run in linear time and constant stack: their loops are possessive,
so the regex engine iterates instead of recursing, whatever the list's length.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Escapes that a list literal and JSON spell alike, and ``\xHH``.  Any other
# (octal, \a, \v, \N, \U, surrogates, an escaped letter) is refused.
_ESCAPE = r"\\(?:['\"\\nrtbf]|x[0-9a-fA-F]{2}|u(?![dD][89a-fA-F])[0-9a-fA-F]{4})"
_TEXT = rf"""(?:'(?:[^'\\\n]++|{_ESCAPE})*+'|"(?:[^"\\\n]++|{_ESCAPE})*+")"""
_ITEM = rf"(?:{_TEXT}|None)\s*+"
_LITERAL = rf"\A\s*+\[\s*+(?:{_ITEM}(?:,\s*+{_ITEM})*+(?:,\s*+)?+)?+\]\s*+\z"
# A ``None`` outside quotes: each match continues where the one before ended
# and steps over whole quoted texts, so text inside quotes is never rewritten.
_NONE_ITEM = r"""\G((?:[^'"N]++|N(?!one\b)|'(?:[^'\\]++|\\.)*+'|"(?:[^"\\]++|\\.)*+")*+)None\b"""
# ``\xHH`` after an even run of backslashes; JSON spells it ``\u00HH``.
_HEX_ESCAPE = r"(?<!\\)((?:\\\\)*+)\\x([0-9a-fA-F]{2})"
_LAST_COMMA = r",\s*+\]\s*+\z"

_PARSE_OPTIONS = {
    "mode": "FAILFAST",
    "allowSingleQuotes": "true",
    "allowBackslashEscapingAnyCharacter": "true",
    "allowUnquotedControlChars": "true",
}


def list_literal(c: Column | str) -> Column:
    """Text of a list of quoted texts and ``None`` → array.

    Null stays null, ``[]`` gives an empty array.  Anything else raises: no
    list, items of other kinds (numbers, nested lists, adjacent texts) and
    escapes that this parser does not decode.
    """
    src = F.col(c) if isinstance(c, str) else c
    as_json = F.regexp_replace(F.regexp_replace(src, _NONE_ITEM, "$1null"), _HEX_ESCAPE, "$1\\\\u00$2")
    parsed = F.from_json(F.regexp_replace(as_json, _LAST_COMMA, "]"), "array<string>", _PARSE_OPTIONS)
    refused = F.raise_error(F.concat(F.lit("not a list of texts: "), F.substring(src, 1, 80))).cast("array<string>")
    return F.when(src.isNull(), F.lit(None).cast("array<string>")).when(src.rlike(_LITERAL), parsed).otherwise(refused)

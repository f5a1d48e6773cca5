"""SQL expressions whose conversions give null where they would fail.

Spark has a function that tries for each conversion, but casts are written in several forms. All are brought to
``try_cast``; where an operand begins and ends is told from brackets and names, the rest of the text stays.
"""

from __future__ import annotations

import re

# Spark's functions named after types, which cast; functions that have a form that tries; the pattern
# that times are read by if none is given.
CASTS = ("boolean", "tinyint", "smallint", "int", "bigint", "float", "double", "decimal", "date", "timestamp", "binary")
TRIED = {"to_date": "try_to_date", "to_timestamp": "try_to_timestamp", "cast": "try_cast", "to_number": "try_to_number", "to_binary": "try_to_binary"}
SECONDS = ("unix_timestamp", "to_unix_timestamp")
SECONDS_PATTERN = "'yyyy-MM-dd HH:mm:ss'"

_TOKEN = re.compile(r"""'(?:[^'\\]|\\.|'')*'|"(?:[^"\\]|\\.)*"|`(?:[^`]|``)*`|::|\w+|\s+|.""", re.DOTALL)
_TYPE = re.compile(r"\s*(\w+)(\s*\([\d\s,]+\)|\s*<[^()]*>)?")
_OPEN, _CLOSE = "([", ")]"


def lenient(text: str) -> str:
    """``text`` with casts (``cast(x AS t)``, ``x::t``, ``int(x)``) and date functions that give null instead of failing."""
    out: list[str] = []
    tokens, i = _TOKEN.findall(text), 0
    while i < len(tokens):
        token = tokens[i]
        if token == "::":
            kind = _TYPE.match("".join(tokens[i + 1 :]))
            begin = _operand(out)
            out[begin:] = [f"try_cast({''.join(out[begin:]).strip()} AS {kind[0].strip()})"]
            i = _after(tokens, i + 1, len(kind[0]))
            continue
        name, at = token.lower(), _skip(tokens, i + 1)
        if at < len(tokens) and tokens[at] == "(" and (name in TRIED or name in CASTS or name in SECONDS) and "".join(out).rstrip()[-1:] != ".":
            end = _closing(tokens, at)
            inside = lenient("".join(tokens[at + 1 : end]))
            if name in TRIED:
                out.append(f"{TRIED[name]}({inside})")
            elif name in CASTS:
                out.append(f"try_cast(({inside}) AS {name})")
            elif not inside.strip():
                out.append(f"{token}()")
            else:
                pattern = "" if _has_comma(tokens[at + 1 : end]) else f", {SECONDS_PATTERN}"
                out.append(f"unix_timestamp(try_to_timestamp({inside}{pattern}))")
            i = end + 1
            continue
        out.append(token)
        i += 1
    return "".join(out)


def _skip(tokens: list[str], i: int) -> int:
    while i < len(tokens) and tokens[i].isspace():
        i += 1
    return i


def _after(tokens: list[str], i: int, length: int) -> int:
    while length > 0:
        length -= len(tokens[i])
        i += 1
    return i


def _closing(tokens: list[str], at: int) -> int:
    """Where the bracket that opens at ``at`` closes."""
    depth = 0
    for i in range(at, len(tokens)):
        depth += (tokens[i] in _OPEN) - (tokens[i] in _CLOSE)
        if not depth:
            return i
    raise ValueError(f"a bracket is not closed in {''.join(tokens)!r}")


def _has_comma(tokens: list[str]) -> bool:
    depth = 0
    for token in tokens:
        depth += (token in _OPEN) - (token in _CLOSE)
        if token == "," and not depth:
            return True
    return False


def _operand(tokens: list[str]) -> int:
    """Where the operand that ends the tokens begins: a name, a literal or brackets, with what they belong to."""
    i = len(tokens)
    while i and tokens[i - 1].isspace():
        i -= 1
    while i:
        token = tokens[i - 1]
        if token in _CLOSE and len(token) == 1:
            depth = 0
            while i:
                i -= 1
                depth += (tokens[i] in _CLOSE) - (tokens[i] in _OPEN)
                if not depth:
                    break
            opened = tokens[i]
            if i and opened == "(" and (re.fullmatch(r"\w+|`.*`", tokens[i - 1]) or tokens[i - 1].isspace()):
                name = i - 1
                while name and tokens[name].isspace():
                    name -= 1
                if re.fullmatch(r"[A-Za-z_]\w*", tokens[name]) and tokens[name].upper() not in WORDS:
                    i = name
            elif i and opened == "[":
                continue
        else:
            i -= 1
            typed = i and re.fullmatch(r"(?i)date|timestamp|x", tokens[i - 1]) and token.startswith("'")
            i -= bool(typed)
        if not (i and tokens[i - 1] == "."):
            return i
        i -= 1
    return i


# Words before a bracket that call nothing.
WORDS = ("AND", "OR", "NOT", "IN", "LIKE", "BETWEEN", "CASE", "WHEN", "THEN", "ELSE", "IS", "DISTINCT", "FROM", "AS", "DIV")

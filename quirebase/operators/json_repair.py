"""JSON out of generated text: fences off, first balanced value, truncated values closed."""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

_SIGN = re.compile(r'["\\{}\[\]]')
_CLOSE = {"{": "}", "[": "]"}


def strip_fence(text: str) -> str:
    text = text.strip()
    return text.removeprefix("```json").removesuffix("```").strip()


def _walk(text: str):
    """(position, sign, open brackets after it, inside a string) of every sign that matters from the first bracket on."""
    start = min((k for k in (text.find("{"), text.find("[")) if k >= 0), default=-1)
    if start < 0:
        return
    stack: list[str] = []
    quoted, at = False, start
    while m := _SIGN.search(text, at):
        sign, at = m.group(), m.end()
        if quoted:
            if sign == "\\":
                at += 1
            elif sign == '"':
                quoted = False
        elif sign == '"':
            quoted = True
        elif sign in _CLOSE:
            stack.append(sign)
        elif sign in "}]" and stack and _CLOSE[stack[-1]] == sign:
            stack.pop()
        yield m.start(), sign, stack, quoted


def balanced(text: str) -> str | None:
    """The first object or array that closes, counting its own kind of bracket only; None if none does."""
    start, kind, depth = None, "", 0
    before = False
    for at, sign, _, quoted in _walk(text):
        outside = not quoted and not before
        before = quoted
        if start is None:
            start, kind = at, sign
        if outside and sign == kind:
            depth += 1
        elif outside and sign == _CLOSE[kind]:
            depth -= 1
            if not depth:
                return text[start : at + 1]
    return None


def close(text: str) -> str | None:
    """From the first bracket on, with an open string and all open brackets closed; None without a bracket."""
    start, stack, quoted = None, [], False
    for at, _, stack, quoted in _walk(text):
        start = at if start is None else start
    if start is None:
        return None
    return text[start:] + ('"' if quoted else "") + "".join(_CLOSE[s] for s in reversed(stack))


def _load(text: str | None):
    try:
        return json.loads(text) if text is not None else None
    except ValueError:
        return None


def cascade(text: str | None) -> tuple[str, str | None]:
    """(how, JSON): 'direct', 'balanced' or 'repaired' and the value as JSON text; else 'raw' and the text."""
    if text is None:
        return "raw", None
    plain = strip_fence(text)
    for how, candidate in (("direct", plain), ("balanced", balanced(plain)), ("repaired", close(plain))):
        value = _load(candidate)
        if value is not None:
            return how, json.dumps(value, sort_keys=True)
    return "raw", text


def _parse(texts: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([cascade(t) for t in texts], columns=["how", "value"])


def parse(text: Column) -> Column:
    """The cascade as a column; the scan of brackets keeps state that built-in functions can't."""
    return F.pandas_udf(_parse, "how string, value string")(text)

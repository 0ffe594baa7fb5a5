"""JSON as models write it: fenced, with raw control characters and stray backslashes, or cut off."""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .tex import batched

_STRING = re.compile(r'"(?:[^"\\]|\\.)*"?', re.DOTALL)
_INSIDE = re.compile(r'\\(?:["\\/bfnrt]|u[0-9a-fA-F]{4})|\\|[\x00-\x1f]')
_THOUGHT, _FENCE = re.compile(r"<think>.*?</think>", re.DOTALL | re.IGNORECASE), re.compile(r"\A```(?:json)?\s*|\s*```\Z", re.IGNORECASE)
_OPEN = {"{": "}", "[": "]"}


def _mended(m: re.Match) -> str:
    body = m.group()
    close = '"' if len(body) > 1 and body.endswith('"') else ""
    inner = body[1 : len(body) - len(close)]
    fix = lambda x: json.dumps(x.group())[1:-1] if len(x.group()) == 1 else x.group()
    return '"' + _INSIDE.sub(fix, inner) + close


def repaired(text: str) -> str:
    """Control characters escaped and invalid backslashes doubled inside strings; nothing else is touched."""
    return _STRING.sub(_mended, text)


def unfenced(text: str) -> str:
    """Without thoughts and code fences, repaired."""
    text = _THOUGHT.sub("", text).strip()
    return repaired(_FENCE.sub("", text).strip() if text.startswith("```") else text)


def parsed(text: str):
    """The JSON value of a text, or of its outermost braces; None if there is none."""
    text = unfenced(text)
    for candidate in (text, text[text.find("{") : text.rfind("}") + 1]):
        try:
            return json.loads(candidate)
        except ValueError:
            continue
    return None


def cut_off(text: str) -> bool:
    """Whether a JSON text ends inside a string or before its brackets close."""
    stack: list[str] = []
    for m in re.finditer(r'"(?:[^"\\]|\\.)*"?|[\[\]{}]', text, re.DOTALL):
        mark = m.group()
        if mark in _OPEN:
            stack.append(_OPEN[mark])
        elif mark in ("}", "]"):
            if not stack or stack.pop() != mark:
                return False
        elif len(mark) < 2 or not mark.endswith('"') or (len(mark) - len(mark[:-1].rstrip("\\")) - 1) % 2:
            return True
    return bool(stack) or not text.strip()


json_repair, json_unfence = batched(repaired), batched(unfenced)


@F.pandas_udf(T.BooleanType())
def json_cut(texts: pd.Series) -> pd.Series:
    """``cut_off`` of JSON texts; null gives null."""
    return texts.map(cut_off, na_action="ignore").astype("boolean")

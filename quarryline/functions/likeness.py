"""Likeness of token sequences by matching blocks, Arrow-batched."""

from __future__ import annotations

import re
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

_FORMAT = frozenset(r"\left \right \quad \qquad \text \mathrm \displaystyle \, \; \!".split())
_LATEX = re.compile(r"\\[A-Za-z]+|\\.|[A-Za-z]+|\d+|[^\s{}$]")


def latex_tokens(text: str | None) -> list[str]:
    """LaTeX commands, words, numbers and signs, without formatting."""
    return [t for t in _LATEX.findall(text or "") if t not in _FORMAT]


def coverage(visual: list[str], written: list[str], protected: frozenset[str] = frozenset("+ - = < > \\le \\ge \\ne \\to \\in".split())) -> tuple[float, list[str]]:
    """Share of ``visual`` found in order in ``written``, and the protected tokens that were lost or replaced."""
    if not visual:
        return 1.0, []
    blocks = SequenceMatcher(None, visual, written, autojunk=False).get_matching_blocks()
    kept = {i for b in blocks for i in range(b.a, b.a + b.size)}
    return len(kept) / len(visual), [t for i, t in enumerate(visual) if i not in kept and t in protected]


@F.pandas_udf(T.DoubleType())
def text_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Matching-block ratio of two texts without white space in lower case; 0 if one is empty or null."""
    bare = lambda s: "".join(s.split()).lower() if isinstance(s, str) else ""
    return pd.Series([SequenceMatcher(None, x, y).ratio() if x and y else 0.0 for x, y in zip(a.map(bare), b.map(bare))], dtype="float64")


@F.pandas_udf(T.StructType([T.StructField("coverage", T.DoubleType()), T.StructField("lost", T.ArrayType(T.StringType()))]))
def formula_coverage(visual: pd.Series, written: pd.Series) -> pd.DataFrame:
    found = [coverage(latex_tokens(v), latex_tokens(w)) for v, w in zip(visual, written)]
    return pd.DataFrame({"coverage": [c for c, _ in found], "lost": [x for _, x in found]})


def echoes(text: str, hotwords: list[str], least: float = 0.88) -> bool:
    """Whether a recogniser repeated its prompt: three hotwords or more, 40 characters or more, and nearly the same text."""
    if len(hotwords) < 3 or len(text) < 40:
        return False
    bare = lambda s: re.sub(r"\W+", "", s).lower()
    return SequenceMatcher(None, bare(text), bare(" ".join(hotwords)), autojunk=False).ratio() >= least


def echo_of(hotwords: list[str]):
    """``echoes`` of a list of hotwords, as a function of a text column; null gives null."""

    @F.pandas_udf(T.BooleanType())
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: echoes(t, hotwords), na_action="ignore").astype("boolean")

    return run

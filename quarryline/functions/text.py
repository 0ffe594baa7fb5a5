"""Text expressions, all inside the JVM. Every function takes and gives Columns; null gives null unless said otherwise."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Patterns are written for Java and RE2 alike.
SPACE = r"\s+"
TOKEN = r"[\p{L}\p{N}_\\]+"
SYMBOL = r"\\[A-Za-z]+|[A-Za-z]"
#: Words of a spoken correction.
CORRECTION = r"(?iu)(это ошибка|должно быть|нет, это|оговорился|исправ|that was wrong|it should be|correction|das war falsch|richtig ist|c'était faux|il faut lire)"
#: Narration about the lecturer or the board.
NARRATION = r"(?iu)(на доске|лектор|on the board|the lecturer|an der tafel|au tableau|видно ли|can you all see)"
#: Phrases that point at the board, with reason and priority; the first that matches counts.
BOARD_RULES = (
    (r"(?iu)(как видно|на рисунк|на картинк|на слайд|на доске|on the board|picture)", "explicit_visual_reference", 5),
    (r"(?iu)(вот этот|вот эта|вот это|сюда|слева|справа|on the left|on the right)", "deictic_reference", 4),
    (r"(?iu)(обозначим|обозначается|запишем|перепишем|call it|i write)", "notation_may_be_visual", 3),
    (r"(?iu)(нарисуем|изобразим|график|диаграмм|схем|стрелк|graph|diagram)", "diagram_or_graph", 4),
)


def squeezed(c: Column) -> Column:
    """Without any white space, in lower case; null and blank give the empty text."""
    return F.lower(F.regexp_replace(F.coalesce(c, F.lit("")), SPACE, ""))


def collapsed(c: Column) -> Column:
    """White space runs as one space, trimmed, in lower case; null gives the empty text."""
    return F.lower(F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), SPACE, " ")))


def tokens(c: Column) -> Column:
    """Distinct lower-case tokens of letters, digits, underscores and backslashes; null gives none."""
    return F.array_distinct(F.regexp_extract_all(F.lower(F.coalesce(c, F.lit(""))), F.lit(TOKEN), F.lit(0)))


def jaccard(a: Column, b: Column) -> Column:
    """Shared over all distinct elements of two arrays; 0 if either is empty."""
    shared, union = F.size(F.array_intersect(a, b)), F.size(F.array_union(a, b))
    return F.when((F.size(a) == 0) | (F.size(b) == 0), 0.0).otherwise(shared / union)


def symbols(c: Column, stop: tuple[str, ...] = ("\\text", "\\left", "\\right", "\\quad", "\\begin", "\\end")) -> Column:
    """Distinct LaTeX commands and single Latin letters without the stop words."""
    return F.array_except(F.array_distinct(F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(SYMBOL), F.lit(0))), F.array(*map(F.lit, stop)))


def clock(seconds: Column) -> Column:
    """``[HH:]MM:SS.mmm`` of non-negative seconds, rounded half to even; hours only where there are any."""
    ms = F.bround(seconds * 1000).cast("bigint")
    h, m, s, r = F.floor(ms / 3_600_000), F.floor(ms / 60_000) % 60, F.floor(ms / 1000) % 60, ms % 1000
    short = F.format_string("%02d:%02d.%03d", m, s, r)
    return F.when(h > 0, F.concat(F.format_string("%02d:", h), short)).otherwise(F.when(ms.isNotNull(), short))


def shortened(c: Column, most: int) -> Column:
    """Texts longer than ``most`` keep their two ends around `` ... ``; for limits up to 7 only the front."""
    if most <= 7:
        return F.substring(c, 1, most)
    half = (most - 5) // 2
    return F.when(F.length(c) > most, F.concat(F.substring(c, 1, half), F.lit(" ... "), F.right(c, F.lit(half)))).otherwise(c)


def first_text(*columns: Column) -> Column:
    """The first that is neither null nor empty."""
    return F.coalesce(*[F.when(c != "", c) for c in columns])


def merged(*arrays: Column) -> Column:
    """Elements of the arrays in order, without repeats, nulls and blanks."""
    whole = F.concat(*[F.coalesce(a, F.array().cast("array<string>")) for a in arrays])
    return F.array_distinct(F.filter(whole, lambda x: F.trim(x) != ""))


def without_controls(c: Column) -> Column:
    """Without control characters other than tab and line feed."""
    return F.regexp_replace(c, r"[\x00-\x08\x0B-\x1F\x7F]", "")


def sentences(c: Column) -> Column:
    """Sentences: cut after ``. ! ?`` where white space and a capital letter follow."""
    return F.filter(F.split(c, r"(?<=[.!?])\s+(?=[A-ZА-ЯЁ])"), lambda x: F.trim(x) != "")


def safe_id(c: Column) -> Column:
    """An id of letters, digits, dots, dashes and underscores; ``request`` if nothing is left."""
    bare = F.regexp_replace(F.regexp_replace(c, "[^A-Za-z0-9_.-]+", "_"), r"^[._-]+|[._-]+$", "")
    return F.when(bare == "", "request").otherwise(bare)


def bounded(c: Column, most: int) -> Column:
    """``(truncated, text)``: the text, or its first ``most`` characters."""
    return F.struct((F.length(c) > most).alias("truncated"), F.substring(c, 1, most).alias("text"))


def balanced(c: Column) -> Column:
    """Whether dollar signs pair up and ``\\( \\)``, ``\\[ \\]`` occur equally often; escaped dollars do not count."""
    n = lambda p: F.regexp_count(c, F.lit(p))
    return (n(r"\$") - n(r"\\\$")) % 2 == 0, n(r"\\\(") == n(r"\\\)"), n(r"\\\[") == n(r"\\\]")


def signature(c: Column) -> Column:
    """``(symbols, numbers, equalities)`` of a prose text, as sorted sets."""
    plain = F.translate(F.coalesce(c, F.lit("")), "−", "-")
    pick = lambda p, g=0: F.array_sort(F.array_distinct(F.regexp_extract_all(plain, F.lit(p), F.lit(g))))
    equal = F.transform(pick(r"[A-Za-z][A-Za-z0-9_()]*\s*=\s*-?[A-Za-z][A-Za-z0-9_()]*"), lambda x: F.regexp_replace(x, SPACE, ""))
    return F.struct(pick(r"\b[A-Za-z]\b").alias("symbols"), pick(r"[0-9]+").alias("numbers"), F.array_sort(F.array_distinct(equal)).alias("equalities"))


def cleanup_verdict(source: Column, target: Column) -> Column:
    """Why a cleaned text may not replace its source, or ``ok``: it must not be empty or narrate, and keep numbers and symbols."""
    a, b = signature(source), signature(target)
    lost = lambda f: F.size(F.array_except(a[f], b[f])) > 0
    grown = lambda f: F.size(F.array_except(b[f], a[f])) > 0
    return (
        F.when(F.coalesce(F.trim(target), F.lit("")) == "", "empty")
        .when(target.rlike(NARRATION), "narration")
        .when(lost("numbers") | grown("numbers"), "numbers")
        .when(grown("symbols"), "new symbols")
        .when(grown("equalities"), "new equality")
        .when(F.length(target) > 2 * F.length(source), "too long")
        .otherwise("ok")
    )


def restored_commands(c: Column) -> Column:
    """TeX commands whose backslash and first letter JSON had read as a control character: ``\\b \\f \\v \\t \\r`` before a letter."""
    for control, letter in (("\x08", "b"), ("\x0c", "f"), ("\x0b", "v"), ("\t", "t"), ("\r", "r")):
        c = F.regexp_replace(c, f"{control}(?=[A-Za-z])", "\\\\" + letter)
    return c


def without(c: Column, pattern: str) -> Column:
    """A text without the sentences that match; null if none is left."""
    left = F.filter(sentences(c), lambda s: ~s.rlike(pattern))
    return F.when(F.size(left) > 0, F.array_join(left, " "))


def is_formula(c: Column) -> Column:
    """Whether a fragment is mathematics alone: not blank, no delimiters of its own, and nothing Cyrillic outside ``\\text{}``."""
    clean = F.trim(without_controls(c))
    return F.coalesce((clean != "") & ~clean.rlike(r"\$|\\\[|\\\]") & ~F.regexp_replace(clean, r"\\text\{[^{}]*\}", "").rlike("[А-Яа-яЁё]"), F.lit(False))

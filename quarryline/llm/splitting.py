"""Splitting oversized texts at natural boundaries, with a given overlap between consecutive pieces.

Per text: the ends of its parts (segments), of its sentences and of its words are sorted arrays of offsets; the ends of
the parts are prefix sums of their lengths. A binary search in each array finds the last boundary under the limit, the
next piece starts ``overlap`` characters before the cut, and where no boundary serves the text is cut hard.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
import regex
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_SENTENCE = regex.compile(r"[.!?…。]+[\"'»”’)\]]*\s+|\n+")
_WORD = regex.compile(r"\s+")
PART, SENTENCE, WORD, HARD, END = "part", "sentence", "word", "hard", "end"


def cut_points(text: str, limit: int, overlap: int, part_ends: list[int]) -> list[tuple[int, int, str]]:
    """Pieces ``(begin, end, kind of the cut at the end)`` of a text above the limit; one piece for any other.

    The cut is the last end of a part under the limit if it leaves the piece at least half full, else that of a sentence,
    else that of a word; if none does, the last of any of them that moves on; else the text is cut at the limit.
    """
    n = len(text)
    if n <= limit:
        return [(0, n, END)]
    if not 0 <= overlap < limit:
        raise ValueError("the overlap must be less than the limit")
    ends = [(PART, sorted(part_ends)), (SENTENCE, [m.end() for m in _SENTENCE.finditer(text)]), (WORD, [m.end() for m in _WORD.finditer(text)])]
    pieces, begin = [], 0
    while n - begin > limit:
        cut, kind = begin + limit, HARD
        for least in (begin + max(overlap, limit // 2), begin + overlap):
            for name, offsets in ends:
                i = bisect_right(offsets, begin + limit) - 1
                if i >= 0 and offsets[i] > least:
                    cut, kind = offsets[i], name
                    break
            if kind != HARD:
                break
        pieces.append((begin, cut, kind))
        begin = cut - overlap
    return [*pieces, (begin, n, END)]


def place_parts(text: str, parts: list[dict]) -> list[tuple[str, int, int]]:
    """``(id, begin, end)`` of the parts that the text holds, in order, joined by one newline; empty parts left out.

    Each part is known by its length and hash and is accepted only where the text has just that content. A part
    that is not there is placed, with no extent, where the part before it ends.
    """
    placed, at = [], 0
    for part in parts:
        if not part["size"]:
            continue
        end = at + part["size"]
        piece = text[at:end]
        if len(piece) == part["size"] and xxhash.xxh64_intdigest(piece.encode("utf-8", "surrogatepass"), seed=42) == part["hash"] & 0xFFFFFFFFFFFFFFFF:
            placed.append((part["id"], at, end))
            at = end + 1
        else:
            placed.append((part["id"], min(at, len(text)), min(at, len(text))))
    return placed


def _split(limit: int, overlap: int, key_types: list[pa.DataType]):
    names = ["piece_no", "begin_pos", "end_pos", "cut_kind", "text", "part_ids"]
    types = [pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.list_(pa.string())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = len(key_types)
        for batch in batches:
            keys = [[] for _ in range(width)]
            out = [[] for _ in names]
            heads = [batch.column(i).to_pylist() for i in range(width)]
            for row, (text, parts) in enumerate(zip(batch.column("text").to_pylist(), batch.column("parts").to_pylist())):
                placed = place_parts(text, parts or [])
                ends = [min(e + 1, len(text)) for _, b, e in placed if e > b]
                for number, (begin, end, kind) in enumerate(cut_points(text, limit, overlap, ends), 1):
                    # A part without extent goes with the piece that holds its place; at the very end, with the last.
                    inside = [i for i, b, e in placed if (b < end and e > begin) or (b == e and (begin <= b < end or b == end == len(text)))]
                    for column, head in zip(keys, heads):
                        column.append(head[row])
                    for column, value in zip(out, (number, begin, end, kind, text[begin:end], inside)):
                        column.append(value)
            arrays = [pa.array(c, type=t) for c, t in zip((*keys, *out), (*key_types, *types))]
            yield pa.RecordBatch.from_arrays(arrays, names=[*(batch.schema.field(i).name for i in range(width)), *names])

    return run


def split_oversized(texts: DataFrame, keys: list[str], limit: int, overlap: int) -> DataFrame:
    """Pieces in order of the texts with more than ``limit`` characters; other texts give no rows.

    ``texts`` has STRING ``keys``, ``text`` and ``parts ARRAY<STRUCT<id, size, hash>>`` (see ``part_of``; null for none).
    The result has the keys, ``piece_no`` from 1, ``begin_pos, end_pos`` in characters, ``cut_kind`` (part, sentence,
    word, hard, or end for the last piece), ``text`` and ``part_ids``. A null text gives no rows. Every piece has at most
    ``limit`` characters; all but the first repeat the last ``overlap`` ones of the piece before; without the repeats the
    pieces are the text. Repeated rows are split repeatedly.
    """
    large = texts.where(F.length("text") > limit).select(*keys, "text", "parts")
    typed = ", ".join(f"`{k}` string" for k in keys)
    schema = f"{typed}, piece_no int, begin_pos bigint, end_pos bigint, cut_kind string, text string, part_ids array<string>"
    return large.mapInArrow(_split(limit, overlap, [pa.string()] * len(keys)), schema)


def part_of(identity: Column, text: Column) -> Column:
    """A part's id, length and hash, as ``split_oversized`` takes them."""
    return F.struct(identity.alias("id"), F.coalesce(F.length(text), F.lit(0)).alias("size"), F.coalesce(F.xxhash64(text), F.lit(0)).cast("bigint").alias("hash"))

"""Evaluation items that occur, wholly or in part, in documents.

Size-partitioned MinHash containment search. A short item inside a long document has a tiny Jaccard similarity to it, so
both sides are cut until sizes compare: an item into blocks of at most ``SIZES[-1]`` words, a document into windows as wide
as the items of a *partition*. Blocks are partitioned by size; consecutive blocks and windows overlap by ``run - 1`` words,
so every passage of ``run`` words lies whole in one of each. A block that holds a passage of a window shares at least
``run - shingle + 1`` of its word shingles with it: that containment, with the sizes of the partition, gives the least Jaccard
similarity of the two, and from it follow the bands and rows of the MinHash signatures such that a passage is missed with a
chance below ``miss``. Candidates are blocks and windows with a band in common; they are verified by exact comparison of their passages.

Documents are read once and never shuffled. While the items have at most ``broadcast_rows`` bands, these go to the tasks and
candidates are verified where they arise. Beyond that a Bloom filter of bounded size goes to the tasks, and only
windows that pass it are shuffled to the items' bands.
"""

from __future__ import annotations

import math
import unicodedata
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.skew import split_hot_join
from ..plans.staging import staged

#: Upper bounds, in words, of the partitions for runs of 12 words; see ``partitions``.
SIZES = (14, 18, 24)
#: Line-end hyphens in a row that are read in every combination of joined and split.
MIXED = 4

_COMMAND = regex.compile(r"\\\\|\\\p{L}+")
_BREAK = regex.compile(r"(?<=\p{L}\p{M}*)[-­‐‑]\p{Cf}*[^\S\n]*\r?\n\s*(?=\p{Cf}*\p{L})")
_INVISIBLE = regex.compile(r"\p{Cf}+")
_MARKS = regex.compile(r"\p{M}+")
_WORDS = regex.compile(r"[\p{L}\p{N}]+")


def words(text: str, joined: int = -1) -> list[str]:
    """The words of a text: runs of letters and digits.

    Case, accents, Unicode form, punctuation, spacing, line breaks, invisible characters and TeX commands make no
    difference. A word hyphenated at a line end is one word if the bit of its break (by its number modulo ``MIXED``) is set in ``joined``, else two.
    """
    if "\\" in text:
        text = _COMMAND.sub(lambda m: "\n" if m.group() == "\\\\" else " ", text)
    if "\n" in text:
        number = iter(range(len(text)))
        text = _BREAK.sub(lambda m: "" if joined >> next(number) % MIXED & 1 else " ", text)
    if not text.isascii():
        text = _MARKS.sub("", unicodedata.normalize("NFKD", _INVISIBLE.sub("", text)))
    return _WORDS.findall(text.casefold())


def readings(text: str | None) -> list[list[str]]:
    """The ways to read a text as words: each hyphen at a line end joins or splits, ``MIXED`` in a row in all combinations."""
    if not text:
        return []
    breaks = sum(1 for _ in _BREAK.finditer(_COMMAND.sub(lambda m: "\n" if m.group() == "\\\\" else " ", text))) if "\n" in text or "\\" in text else 0
    return [words(text, joined) for joined in reversed(range(1 << min(breaks, MIXED)))]


def partitions(run: int, shingle: int, miss: float, most: int = 64) -> list[tuple[int, int, int]]:
    """``(upper bound in words, bands, rows)`` per partition by size.

    A block and a window of at most ``size`` words that share a passage have ``run - shingle + 1`` shingles in common, hence a
    Jaccard similarity of at least that over the shingles of both. Rows are as many as ``most`` hashes allow.
    """
    if not 0 < shingle <= run:
        raise ValueError("shingles must fit into a run")
    shared, out = run - shingle + 1, []
    for size in sorted({max(run, round(run * s / 12)) for s in SIZES}):
        least = shared / (2 * (size - shingle + 1) - shared)
        rows = 1
        bands = lambda r: math.ceil(math.log(miss) / math.log(1 - min(least**r, 1 - 1e-9)))
        while bands(rows + 1) * (rows + 1) <= most:
            rows += 1
        out.append((size, bands(rows), rows))
    return out


class Signatures:
    """Banded MinHash signatures of the windows of word sequences."""

    def __init__(self, run: int, shingle: int, miss: float):
        self.run, self.shingle, self.parts = run, shingle, partitions(run, shingle, miss)
        rng = np.random.default_rng(20240131)
        odd = lambda n: rng.integers(1, 2**63, size=n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.weights = odd(shingle)
        self.factors = [odd(bands * rows) for _, bands, rows in self.parts]
        self.known: dict[str, int] = {}

    def codes(self, sequence: list[str]) -> np.ndarray:
        known = self.known
        if len(known) > 500_000:
            known.clear()
        out = []
        for word in sequence:
            code = known.get(word)
            if code is None:
                code = known[word] = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"))
            out.append(code)
        return np.array(out, dtype=np.uint64)

    def part_of(self, size: int) -> int:
        """The partition of a block of so many words."""
        return next(i for i, (most, _, _) in enumerate(self.parts) if size <= most)

    def cuts(self, n: int, size: int) -> list[int]:
        """Where the windows of ``size`` words begin in ``n`` words; consecutive ones overlap by ``run - 1``."""
        if n < self.run:
            return []
        step = size - self.run + 1
        return [*range(0, max(1, n - size), step), *([n - size] if n > size else [])]

    def shingles(self, codes: np.ndarray) -> np.ndarray:
        """Hashes of the shingles of a sequence of word codes; the last ``shingle - 1`` places hold none."""
        out = np.zeros(len(codes), np.uint64)
        with np.errstate(over="ignore"):
            for j in range(self.shingle):
                out[: len(codes) - j] += codes[j:] * self.weights[j]
            return (out ^ (out >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)

    def bands(self, shingles: np.ndarray, begins: np.ndarray, ends: np.ndarray, part: int) -> np.ndarray:
        """The bands, bands by windows, of windows of shingles from ``begins`` to before ``ends``."""
        _, bands, rows = self.parts[part]
        wide = int((ends - begins).max())
        where = np.minimum(begins[None, :] + np.arange(wide)[:, None], ends[None, :] - 1)  # repeats change no minimum
        keys = np.zeros((bands, len(begins)), np.uint64)
        with np.errstate(over="ignore"):
            shingles = shingles ^ (shingles >> np.uint64(31))
            for i, factor in enumerate(self.factors[part]):
                mixed = ((shingles * factor) >> np.uint64(32)).astype(np.uint32)
                band = keys[i % bands]
                band *= np.uint64(0x9E3779B97F4A7C15)
                band += mixed[where].min(axis=0) + np.uint64(i % bands + 1 + (part << 16))
            keys ^= keys >> np.uint64(32)
            keys *= np.uint64(0x9E3779B97F4A7C15)
        return keys

    def windows(self, sequences: list[tuple[int, list[str]]], parts: list[int], step: int = 50_000) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Windows of (row, words) sequences, at most ``step`` at a time: which sequence, first word, and bands by windows."""
        long = [(i, s) for i, (_, s) in enumerate(sequences) if len(s) >= self.run]
        if not long:
            return
        sizes = np.array([len(s) for _, s in long])
        firsts = np.cumsum(sizes) - sizes
        shingles = self.shingles(np.concatenate([self.codes(s) for _, s in long]))
        for part in parts:
            size = self.parts[part][0]
            cuts = [self.cuts(int(n), size) for n in sizes]
            which = np.repeat(np.arange(len(long)), [len(c) for c in cuts])
            begins = np.concatenate([np.array(c) for c in cuts])
            for at in range(0, len(begins), step):
                of, begin = which[at : at + step], begins[at : at + step]
                low = int(firsts[of[0]])
                high = int(firsts[of[-1]] + sizes[of[-1]])
                start = firsts[of] + begin - low
                stop = start + np.minimum(sizes[of], size) - self.shingle + 1
                yield np.array([long[i][0] for i in of]), begin, self.bands(shingles[low:high], start, stop, part)


def _read(batch: pa.RecordBatch, words_held: int = 2_000_000) -> Iterator[list[tuple[int, list[str]]]]:
    """The readings of the texts of a batch with their rows, about ``words_held`` words at a time."""
    out, held = [], 0
    for row, text in enumerate(batch.column("text").to_pylist()):
        for sequence in readings(text):
            out.append((row, sequence))
            held += len(sequence)
        if held > words_held:
            yield out
            out, held = [], 0
    yield out


def _passages(sequence: list[str], run: int) -> set[tuple]:
    return {tuple(sequence[i : i + run]) for i in range(len(sequence) - run + 1)}


def _blocks(run: int, shingle: int, miss: float):
    """Items to rows of ``item, part, words, bands``, a row per block."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        signatures = Signatures(run, shingle, miss)
        largest = signatures.parts[-1][0]
        for batch in batches:
            out: list[list] = [[], [], [], []]
            for item, text in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist()):
                for sequence in readings(text):
                    for begin in signatures.cuts(len(sequence), largest):
                        block = sequence[begin : begin + largest]
                        part = signatures.part_of(len(block))
                        bands = signatures.bands(signatures.shingles(signatures.codes(block)), np.array([0]), np.array([len(block) - shingle + 1]), part)[:, 0]
                        for column, value in zip(out, (item, part, block, np.unique(bands).astype(np.int64))):
                            column.append(value)
            types = [pa.int64(), pa.int32(), pa.list_(pa.string()), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(out, types)], names=["item", "part", "words", "bands"])

    return cut


def _verified(shared, parts: list[int], run: int, shingle: int, miss: float):
    """Candidates by bands, verified on the spot; emits ``item, doc``."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        signatures = Signatures(run, shingle, miss)
        items, texts, keys, block_of = shared.value
        exact = [None] * len(texts)
        sieve = np.zeros(1 << max(16, (16 * len(keys)).bit_length()), bool)
        mask = np.uint64(len(sieve) - 1)
        sieve[(keys & mask).astype(np.int64)] = True
        for batch in batches:
            found: set[tuple[int, int | None]] = set()
            for sequences in _read(batch):
                for which, begins, bands in signatures.windows(sequences, parts):
                    near = np.argwhere(sieve[(bands & mask).astype(np.int64)])
                    values = bands[near[:, 0], near[:, 1]]
                    at = np.minimum(np.searchsorted(keys, values), len(keys) - 1)
                    candidates = {(int(w), block) for w, k in zip(near[keys[at] == values, 1], at[keys[at] == values]) for block in block_of[k]}
                    for window, block in candidates:
                        row, sequence = sequences[which[window]]
                        if (row, items[block]) not in found:
                            if exact[block] is None:
                                exact[block] = _passages(texts[block], run)
                            if exact[block] & _passages(sequence[begins[window] : begins[window] + signatures.parts[-1][0]], run):
                                found.add((row, items[block]))
            pairs = list(found)
            yield pa.RecordBatch.from_arrays([pa.array([i for _, i in pairs], pa.int64()), batch.column("doc").take(pa.array([r for r, _ in pairs], pa.int32()))], names=["item", "doc"])

    return scan


def _passing(shared, parts: list[int], run: int, shingle: int, miss: float):
    """Windows with a band that the filter lets pass: ``doc, words, band``."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        signatures = Signatures(run, shingle, miss)
        table = shared.value
        size = np.uint64(len(table) * 64)
        for batch in batches:
            out: list[list] = [[], [], []]
            for sequences in _read(batch):
                for which, begins, bands in signatures.windows(sequences, parts):
                    place = bands % size
                    for b, w in np.argwhere(table[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63)) & np.uint64(1)):
                        row, sequence = sequences[which[w]]
                        for column, value in zip(out, (row, sequence[begins[w] : begins[w] + signatures.parts[-1][0]], bands[b, w].astype(np.int64))):
                            column.append(value)
            yield pa.RecordBatch.from_arrays([batch.column("doc").take(pa.array(out[0], pa.int32())), pa.array(out[1], pa.list_(pa.string())), pa.array(out[2], pa.int64())], names=["doc", "words", "band"])

    return scan


def _filter(bands: DataFrame, bits: int) -> np.ndarray:
    """A Bloom filter with one hash: a bit per band; at most ``bits / 64`` numbers reach the driver."""
    place = F.expr(f"band & {bits - 1}L")  # modulo the number of bits, a power of two
    rows = bands.select(place.alias("p")).groupBy(F.shiftright("p", 6).alias("at")).agg(F.bit_or(F.expr("shiftleft(1L, cast(p & 63 AS int))")).alias("mask")).toArrow()
    table = np.zeros(bits // 64, np.int64)
    table[rows.column("at").to_numpy()] = rows.column("mask").to_numpy()
    return table.view(np.uint64)


def leaked_items(
    documents: DataFrame, items: DataFrame, doc_id: str, item_id: str, run: int = 12, shingle: int = 5, miss: float = 1e-6, broadcast_rows: int = 1_000_000, filter_bits: int = 1 << 27
) -> DataFrame:
    """``item_id, doc_id``, once each: the document has ``run`` or more consecutive words of the item.

    Both tables have a ``text``; null, empty and shorter texts match nothing. Ids are BIGINT; a null id is an id like any
    other. Repeated rows and items that share passages give each pair once. A passage of just ``run`` words is missed with
    a chance of at most ``miss``; what is found is exact. A passage with more than ``MIXED`` words broken at line ends, of which some
    are compounds and some are not, is read in part of the possible ways only.
    """
    spark = documents.sparkSession
    texts = documents.select(F.col(doc_id).cast("bigint").alias("doc"), "text")
    named = items.select(F.col(item_id).cast("bigint").alias("id"), "text").distinct()
    blocks = staged(named.mapInArrow(_blocks(run, shingle, miss), "item bigint, part int, words array<string>, bands array<bigint>"), "blocks")
    summary = blocks.agg(F.coalesce(F.sum(F.size("bands")), F.lit(0)), F.sort_array(F.collect_set("part"))).first()
    parts = list(summary[1])
    if summary[0] <= broadcast_rows:
        rows = blocks.toArrow()
        of_key: dict[int, list[int]] = defaultdict(list)
        for block, bands in enumerate(rows.column("bands").to_pylist()):
            for band in bands:
                of_key[band & 0xFFFFFFFFFFFFFFFF].append(block)
        keys = sorted(of_key)
        if not keys:
            return texts.select(F.lit(None).cast("bigint").alias(item_id), F.col("doc").alias(doc_id)).where("false")
        shared = spark.sparkContext.broadcast((rows.column("item").to_pylist(), rows.column("words").to_pylist(), np.array(keys, dtype=np.uint64), [of_key[k] for k in keys]))
        pairs = texts.mapInArrow(_verified(shared, parts, run, shingle, miss), "item bigint, doc bigint")
    else:
        bands = blocks.select("item", F.col("words").alias("block"), F.explode("bands").alias("band"))
        bits = 1 << min(max(6, (16 * summary[0]).bit_length()), filter_bits.bit_length() - 1)
        shared = spark.sparkContext.broadcast(_filter(bands, bits))
        passing = staged(texts.mapInArrow(_passing(shared, parts, run, shingle, miss), "doc bigint, words array<string>, band bigint"), "windows")
        grams = lambda c: F.transform(F.sequence(F.lit(1), F.size(c) - run + 1), lambda i: F.array_join(F.slice(c, i, run), " "))
        pairs = split_hot_join(passing, bands, ["band"], how="inner").where(F.arrays_overlap(grams(F.col("words")), grams(F.col("block"))))
    return pairs.select(F.col("item").alias(item_id), F.col("doc").alias(doc_id)).distinct()

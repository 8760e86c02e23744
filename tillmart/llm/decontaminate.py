"""Benchmark decontamination: every training passage asks an index of test items.

Test items are indexed by BM25, those of over ``PART`` words in overlapping parts (see
``parts_of``), so that an excerpt is found wherever it starts; impacts are divided by an item's score for itself, so one threshold serves all items. Items lie
in blocks with the largest impact of each term. A document is cut into overlapping
passages, each at least twice as long as an item, and for every passage

1. the sum of block maxima says which blocks can reach the threshold at all;
2. block-max WAND retrieves every item of them above the threshold;
3. the shared word trigrams of the item's question and answer are counted: both must
   overlap. The last sentence is the answer, or the last third of a single sentence.

The index is broadcast in shards of at most ``SHARD_BYTES`` of item text; more shards
mean more passes over the documents, each reported in full. Document frequencies, mean
length and passages are those of all items, so results do not depend on shards.

Defined results: null and empty texts hit nothing; items with fewer than ``LEAST``
words are reported where the same words stand in a row, with scores of 1; rows without an id are
reported with a null id; repeated items are reported each.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_whole, only, table

K1, B = 1.2, 0.75
THRESHOLD = 0.65
OVERLAP = 0.5
PART, LEAST = 128, 5
BLOCK = 8
SHARD_BYTES = 16 * 1024 * 1024
_WORDS = re.compile(r"\w+")
_SENTENCE = re.compile(r"[^.!?\n]+")


def words_of(text: str | None) -> list[str]:
    """Lower-cased words."""
    return _WORDS.findall((text or "").lower())


def trigrams(words: list[str]) -> set[tuple[str, ...]]:
    """Word trigrams, or the words as one gram if fewer."""
    if len(words) < 3:
        return {tuple(words)} if words else set()
    return set(zip(words, words[1:], words[2:], strict=False))


def question_answer(text: str, words: list[str]) -> tuple[list[str], list[str]]:
    """The item's words cut before its last sentence."""
    sentences = [w for s in _SENTENCE.findall(text.lower()) if (w := _WORDS.findall(s))]
    answer = len(sentences[-1]) if len(sentences) > 1 else 0
    if not 3 <= answer <= len(words) - 3:
        answer = max(1, len(words) // 3)
    return words[:-answer], words[-answer:]


@dataclass
class Entry:
    """One item, or one part of a long one."""

    item_id: int
    question: set
    answer: set
    words: list[str]


@dataclass
class Statistics:
    """What impacts take from all items: how many hold a term, how many there are, lengths."""

    df: dict[str, int]
    items: int
    mean: float
    longest: int


@dataclass
class Index:
    """Block-max impact lists over entries."""

    entries: list[Entry]
    terms: dict[str, int]
    postings: list[tuple[list[int], list[float]]]  # per term: entries, impacts
    block_at: np.ndarray  # start of each term's blocks
    block_of: np.ndarray
    block_max: np.ndarray
    cell: int
    short: dict[tuple[str, ...], list[int]] = field(default_factory=dict)  # words -> item ids

    @property
    def blocks(self) -> int:
        """How many blocks of entries there are."""
        return -(-len(self.entries) // BLOCK)


def parts_of(n: int) -> list[tuple[int, int]]:
    """Where the parts of an item of ``n`` words begin and end.

    Long items are cut side by side into parts of at most ``PART`` words, and again into
    parts of at most half as many that overlap by half: any ``3 * PART // 4`` words in a
    row hold one of these whole.
    """
    if n <= PART:
        return [(0, n)]
    wide = -(-n // PART)
    steps = -(-n // (PART // 4))
    side_by_side = [(n * i // wide, n * (i + 1) // wide) for i in range(wide)]
    return side_by_side + [(n * i // steps, n * (i + 2) // steps) for i in range(steps - 1)]


def entries_of(items: list[tuple[int, str]]) -> list[Entry]:
    """Entries of (item_id, text) pairs."""
    found = []
    for item_id, text in items:
        words = words_of(text)
        if len(words) < LEAST:
            continue
        if len(words) <= PART:
            question, answer = question_answer(text, words)
            found.append(Entry(item_id, trigrams(question), trigrams(answer), words))
        else:
            for start, end in parts_of(len(words)):
                part = words[start:end]
                cut = len(part) - max(1, len(part) // 3)
                found.append(Entry(item_id, trigrams(part[:cut]), trigrams(part[cut:]), part))
    return found


def short_items(items: list[tuple[int, str]]) -> dict[tuple[str, ...], list[int]]:
    """Items of fewer than ``LEAST`` words: ids by words."""
    found: dict[tuple[str, ...], list[int]] = {}
    for item_id, text in items:
        words = tuple(words_of(text))
        if 0 < len(words) < LEAST:
            found.setdefault(words, []).append(item_id)
    return found


def build_index(entries: list[Entry], over: Statistics | None = None) -> Index:
    """BM25 impacts relative to each entry's score for itself, by the statistics of all items.

    Without any, each of ``entries`` counts as an item and there are no others.
    """
    counts = [Counter(e.words) for e in entries]
    if over is None:
        total = sum(len(e.words) for e in entries)
        longest = max([0, *(len(e.words) for e in entries)])
        df = Counter(t for c in counts for t in c)
        over = Statistics(df, len(entries), total / max(1, len(entries)), longest)
    n, mean = over.items, over.mean
    df = {t: over.df[t] for t in {t for c in counts for t in c}}
    idf = {t: np.log(1 + (n - k + 0.5) / (k + 0.5)) for t, k in df.items()}
    terms = {t: i for i, t in enumerate(sorted(df))}
    lists: list[list[tuple[int, float]]] = [[] for _ in terms]
    for e, c in enumerate(counts):
        norm = K1 * (1 - B + B * len(entries[e].words) / mean)
        impact = {t: idf[t] * k * (K1 + 1) / (k + norm) for t, k in c.items()}
        own = sum(impact.values())
        for t, v in impact.items():
            lists[terms[t]].append((e, v / own))
    postings, at, block_of, block_max = [], [0], [], []
    for plist in lists:
        docs = np.array([d for d, _ in plist], dtype=np.int64)
        values = np.array([v for _, v in plist])
        postings.append(([d for d, _ in plist], [v for _, v in plist]))
        blocks = docs // BLOCK
        starts = np.flatnonzero(np.diff(blocks, prepend=-1))
        block_of.append(blocks[starts])
        block_max.append(np.maximum.reduceat(values, starts))
        at.append(at[-1] + len(starts))
    cell = max(LEAST, over.longest)
    return Index(entries, terms, postings, np.array(at), np.concatenate(block_of or [np.zeros(0, int)]),
                 np.concatenate(block_max or [np.zeros(0)]), cell)


def block_max_wand(
    index: Index, terms: list[int], blocks: list[int], threshold: float
) -> list[tuple[int, float]]:
    """Every entry of ``blocks`` that the distinct ``terms`` score at least ``threshold``.

    Blocks whose maxima cannot reach the threshold have been left out, so cursors jump
    over them. Inside a block, the pivot is the first entry whose lists' maxima add up
    to the threshold; all cursors before it move there at once.
    """
    found = []
    lists = [index.postings[t] for t in terms]
    for block in blocks:
        low, high = block * BLOCK, (block + 1) * BLOCK
        cursors = []  # [entry, place, end, entries, impacts, block maximum]
        for docs, values in lists:
            a = bisect_left(docs, low)
            if a < len(docs) and docs[a] < high:
                b = bisect_left(docs, high, a)
                cursors.append([docs[a], a, b, docs, values, max(values[a:b])])
        while cursors:
            cursors.sort(key=lambda c: c[0])
            total, pivot = 0.0, -1
            for i, c in enumerate(cursors):
                total += c[5]
                if total >= threshold:
                    pivot = i
                    break
            if pivot < 0:
                break
            at = cursors[pivot][0]
            target = at
            if cursors[0][0] == at:
                score = sum(c[4][c[1]] for c in cursors if c[0] == at)
                if score >= threshold:
                    found.append((at, score))
                target = at + 1
            for c in cursors:
                if c[0] < target:
                    c[1] = bisect_left(c[3], target, c[1], c[2])
                    c[0] = c[3][c[1]] if c[1] < c[2] else high
            cursors = [c for c in cursors if c[0] < high]
    return found


def promising_passages(index: Index, codes: np.ndarray, threshold: float) -> list[tuple[int, list, list]]:
    """(first cell, distinct terms, blocks that can reach the threshold) of passages with any.

    A passage is two neighbouring cells, each as long as the longest entry.
    """
    places = np.flatnonzero(codes >= 0)
    if not len(places):
        return []
    width = len(index.terms)
    pairs = np.unique(places // index.cell * width + codes[places])
    cells, terms = pairs // width, pairs % width
    last = (len(codes) - 1) // index.cell
    sizes = index.block_at[terms + 1] - index.block_at[terms]
    row = np.repeat(np.arange(len(terms)), sizes)
    inner = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    lists = index.block_at[terms][row] + inner
    keys = cells[row] * index.blocks + index.block_of[lists]
    bound = np.bincount(keys, index.block_max[lists], (last + 2) * index.blocks)
    bound = bound.reshape(-1, index.blocks)
    able = (bound[:-1] + bound[1:]) >= threshold
    found = []
    for c in np.flatnonzero(able.any(axis=1)).tolist():
        here = terms[np.searchsorted(cells, c) : np.searchsorted(cells, c + 2)]
        found.append((c, np.unique(here).tolist(), np.flatnonzero(able[c]).tolist()))
    return found


def find_leaks(index: Index, text: str | None) -> dict[int, tuple[float, float, float]]:
    """item_id -> (score, question overlap, answer overlap) of the items a text contains."""
    words = words_of(text)
    get = index.terms.get
    codes = np.array([get(w, -1) for w in words], dtype=np.int64)
    found: dict[int, tuple[float, float, float]] = {}
    for n in {len(short) for short in index.short}:
        for gram in zip(*(words[i:] for i in range(n)), strict=False):
            for item_id in index.short.get(gram, ()):
                found[item_id] = (1.0, 1.0, 1.0)
    for cell, terms, blocks in promising_passages(index, codes, THRESHOLD):
        grams = None
        for e, score in block_max_wand(index, terms, blocks, THRESHOLD):
            if grams is None:
                at = cell * index.cell
                # Grams across the cut before the answer count with either side.
                grams = trigrams(words[at : at + 2 * index.cell])
            entry = index.entries[e]
            question = len(entry.question & grams) / max(1, len(entry.question))
            answer = len(entry.answer & grams) / max(1, len(entry.answer))
            if question >= OVERLAP and answer >= OVERLAP:
                found[entry.item_id] = max(found.get(entry.item_id, (0.0,) * 3), (score, question, answer))
    return found


def statistics(benchmark: DataFrame) -> Statistics:
    """Counts and lengths over all items that are indexed; its vocabulary comes to the driver."""

    def run(batches):
        for batch in batches:
            items, parts, total, longest, df = 0, 0, 0, 0, Counter()
            for text in batch.column(0).to_pylist():
                words = words_of(text)
                if len(words) >= LEAST:
                    sizes = [end - start for start, end in parts_of(len(words))]
                    items, parts, total = items + 1, parts + len(sizes), total + sum(sizes)
                    longest = max(longest, *sizes)
                    df.update(set(words))
            rows = [(None, items, parts, total, longest), *((t, k, 0, 0, 0) for t, k in df.items())]
            names = ("term", "items", "parts", "total", "longest")
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64() if i else pa.string()) for i, c in enumerate(zip(*rows, strict=True))],
                names,
            )

    sums = [F.sum(c).alias(c) for c in ("items", "parts", "total")]
    rows = (
        only(benchmark, "text")
        .mapInArrow(run, "term string, items long, parts long, total long, longest long")
        .groupBy("term")
        .agg(*sums, F.max("longest").alias("longest"))
        .collect()
    )
    df = {r["term"]: r["items"] for r in rows if r["term"] is not None}
    whole = next((r for r in rows if r["term"] is None), None)
    if whole is None:
        return Statistics(df, 0, 0.0, 0)
    return Statistics(df, whole["items"], whole["total"] / max(1, whole["parts"]), whole["longest"])


def indexes(benchmark: DataFrame) -> Iterator[Index]:
    """Indexes of all items, each of a bounded number of bytes."""
    over = statistics(benchmark)

    def build(items: list[tuple[int, str]]) -> Index:
        index = build_index(entries_of(items), over)
        index.short = short_items(items)
        return index

    items: list[tuple[int, str]] = []
    held = 0
    for r in only(benchmark, "item_id", "text").orderBy("item_id").toLocalIterator():
        items.append((r["item_id"], r["text"] or ""))
        held += len(items[-1][1])
        if held >= SHARD_BYTES:
            yield build(items)
            items, held = [], 0
    yield build(items)


_FOUND = "doc_id long, item_id long, score double, question_overlap double, answer_overlap double"


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document of ``docs`` and test item that it contains."""
    spark = docs.sparkSession
    result = None
    for index in indexes(benchmark):
        shared = spark.sparkContext.broadcast(index)  # SHARD_BYTES of text at most

        def run(batches, shared=shared):
            schema = pa.schema(
                [("doc_id", pa.int64()), ("item_id", pa.int64())]
                + [(n, pa.float64()) for n in ("score", "question_overlap", "answer_overlap")]
            )
            for batch in batches:
                rows = [
                    (doc_id, item, *values)
                    for doc_id, text in zip(
                        batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True
                    )
                    for item, values in sorted(find_leaks(shared.value, text).items())
                ]
                columns = zip(*rows, strict=True) if rows else [[]] * len(schema)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
                )

        found = only(docs, "doc_id", "text").mapInArrow(run, _FOUND)
        result = found if result is None else result.union(found)
    return result


def keep_uncontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, that contain no test item."""
    spark = docs.sparkSession
    at = docs.columns.index("text")
    for index in indexes(benchmark):
        shared = spark.sparkContext.broadcast(index)

        def run(batches, shared=shared):
            for batch in batches:
                clean = [not find_leaks(shared.value, t) for t in batch.column(at).to_pylist()]
                yield batch.filter(pa.array(clean, pa.bool_()))

        docs = map_whole(docs, run)
    return docs


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every benchmark item in every document."""
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))

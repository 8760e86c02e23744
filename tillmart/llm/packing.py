"""Best-fit packing of documents into sequences, by patterns of lengths.

The histogram of lengths, at most ``size`` numbers, decides everything, so planning
costs the same for any corpus:

1. Patterns of at most three documents that fill a sequence exactly are enumerated.
2. Repeat counts are fitted to the histogram by non-negative least squares, greedily
   by coordinate: the worst covered length picks the pattern that lowers the error
   most; sweeps over the chosen patterns then correct them downwards too.
3. Counts are rounded down and cut to what is there.
4. What remains is packed best-fit decreasing, again by counts: equal lengths move
   together, so the steps are bounded by the number of lengths, not of documents.

Documents are numbered within their length, and the number finds the sequence.

Defined results: a null text is empty and packs as its end id alone; rows that repeat
an id are packed each; longer documents are cut into full pieces, of which the first
takes the rest and may be shorter.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Columns, map_rows, materialize, only, place_in_group, table
from .tokens import encode_all

SIZE = 2048
END_ID = 0
STEPS, SWEEPS = 30_000, 4
SALTS = 64

Runs = tuple[tuple[int, int], ...]  # (length, how many of it) in order of place


def cut_pieces(docs: DataFrame, path: str, size: int = SIZE, end_id: int = END_ID) -> DataFrame:
    """doc_id, piece, start, length, ids (little-endian 32-bit) of every piece."""

    def work(c: Columns) -> Columns:
        out: Columns = {"doc_id": [], "piece": [], "start": [], "length": [], "ids": []}
        for doc_id, ids in zip(c["doc_id"], encode_all(path, True, c["text"]), strict=True):
            ids = np.append(ids, np.array([end_id], dtype="<u4")).astype("<u4")
            cuts = list(range(len(ids) % size or size, len(ids) + 1, size))
            for i, end in enumerate(cuts):
                start = cuts[i - 1] if i else 0
                row = (doc_id, i, start, end - start, ids[start:end].tobytes())
                for name, value in zip(out, row, strict=True):
                    out[name].append(value)
        return out

    return map_rows(
        only(docs, "doc_id", "text"),
        "doc_id long, piece int, start long, length long, ids binary",
        work,
    )


def fit_patterns(histogram: np.ndarray, steps: int = STEPS) -> dict[tuple[int, ...], int]:
    """Repeats of exact patterns; ``histogram[l]`` documents have length ``l``."""
    size = len(histogram) - 1
    left = histogram.astype(float)
    fitted: dict[tuple[int, ...], float] = {}
    # Short documents fill gaps later, so leaving them counts for less.
    weight = np.minimum(1.0, 0.1 + np.arange(size + 1) / (size / 8))
    weight[size] = 0  # full pieces are patterns by themselves

    def move(pattern: tuple[int, ...], step: float) -> None:
        before = fitted.get(pattern, 0.0)
        step = max(step, -before)
        fitted[pattern] = before + step
        for length in pattern:
            left[length] -= step

    for _ in range(steps):
        a = int(np.argmax(weight * left))
        if left[a] * weight[a] < 0.5:
            break
        rest = size - a
        b = np.arange(0, rest // 2 + 1)  # 0: the pair of a and rest
        c = rest - b
        third = np.where(b > 0, left[b], 0.0)
        worth = left[a] + third + left[c]
        norm = np.where(b > 0, 3.0, 2.0)
        # A length that occurs twice in a pattern counts double in the norm.
        norm += 2.0 * ((b == a) | (b == c)) * (b > 0) + 2.0 * (c == a)
        gain = np.where(worth > 0, worth**2 / norm, 0)
        gain[(left[c] < 0.5) | ((b > 0) & (left[b] < 0.5))] = 0
        at = int(np.argmax(gain))
        if gain[at] <= 0:
            weight[a] = 0  # no pattern helps it: it is left to best fit
            continue
        pattern = tuple(sorted((v for v in (a, int(b[at]), int(c[at])) if v), reverse=True))
        move(pattern, worth[at] / norm[at])
    for _ in range(SWEEPS):
        for pattern in list(fitted):
            norm = sum(pattern.count(v) for v in pattern)
            move(pattern, sum(left[v] for v in pattern) / norm)
    there = histogram.astype(np.int64).copy()
    repeats = {}
    for pattern, times in sorted(fitted.items(), key=lambda x: (-x[1], x[0])):
        room = min(int(there[v]) // pattern.count(v) for v in pattern)
        times = min(int(times), room)
        if times > 0:
            repeats[pattern] = times
            for v in pattern:
                there[v] -= times
    return repeats


def best_fit(histogram: np.ndarray) -> list[tuple[Runs, int]]:
    """Patterns (as runs) and repeats of all documents, best-fit decreasing by counts."""
    size = len(histogram) - 1
    bins: dict[int, list[tuple[Runs, int]]] = {}
    spaces: list[int] = []

    def put(space: int, runs: Runs, times: int) -> None:
        if space not in bins:
            bins[space] = []
            insort(spaces, space)
        bins[space].append((runs, times))

    def taken(space: int) -> tuple[Runs, int]:
        group = bins[space].pop()
        if not bins[space]:
            del bins[space]
            spaces.remove(space)
        return group

    for length in range(size, 0, -1):
        count = int(histogram[length])
        while count:
            at = bisect_left(spaces, length)
            if at == len(spaces):
                fit = size // length
                if count >= fit:
                    put(size - fit * length, ((length, fit),), count // fit)
                if count % fit:
                    put(size - count % fit * length, ((length, count % fit),), 1)
                break
            space = spaces[at]
            runs, times = taken(space)
            fit = space // length
            whole = min(times, count // fit)
            if whole:
                put(space - fit * length, (*runs, (length, fit)), whole)
                count -= whole * fit
                times -= whole
            if times and count and count < fit:
                put(space - count * length, (*runs, (length, count)), 1)
                count, times = 0, times - 1
            if times:
                put(space, runs, times)
    return [group for groups in bins.values() for group in groups]


def plan(histogram: np.ndarray) -> list[tuple[Runs, int]]:
    """All patterns with their repeats, covering the histogram exactly."""
    repeats = fit_patterns(histogram)
    left = histogram.astype(np.int64).copy()
    groups: list[tuple[Runs, int]] = []
    for pattern, times in repeats.items():
        groups.append((tuple((v, 1) for v in pattern), times))
        for v in pattern:
            left[v] -= times
    return groups + best_fit(left)


def intervals(groups: list[tuple[Runs, int]]) -> np.ndarray:
    """Rows (length, first number, first sequence, run, offset), sorted: where numbers go."""
    used: dict[int, int] = {}
    rows, sequence = [], 0
    for runs, times in groups:
        offset = 0
        for length, run in runs:
            first = used.get(length, 0)
            rows.append((length, first, sequence, run, offset))
            used[length] = first + run * times
            offset += run * length
        sequence += times
    return np.array(sorted(rows), dtype=np.int64).reshape(-1, 5)


def pack(pieces: DataFrame, size: int = SIZE) -> DataFrame:
    """``pieces`` (stored; ``doc_id``, ``piece``, ``length``, more) with sequence_id and offset."""
    counted = pieces.groupBy("length").count().collect()  # at most ``size`` rows
    histogram = np.zeros(size + 1, dtype=np.int64)
    for r in counted:
        histogram[r["length"]] = r["count"]
    where = intervals(plan(histogram))
    numbered = place_in_group(pieces, ["length"], ["doc_id", "piece"], SALTS)
    lengths = numbered.columns.index("length")
    places = numbered.columns.index("place")

    def run(batches):
        # One sorted key per interval: lengths are far apart.
        span = max(1, int(histogram.max())) + 1
        keys = where[:, 0] * span + where[:, 1]
        for batch in batches:
            length, number = (
                batch.column(i).to_numpy(zero_copy_only=False) for i in (lengths, places)
            )
            at = np.searchsorted(keys, length * span + number, side="right") - 1
            _, first, sequence, repeat, offset = where[at].T
            within = number - first
            columns = [c for i, c in enumerate(batch.columns) if i != places]
            columns += [pa.array(sequence + within // repeat), pa.array(offset + within % repeat * length)]
            yield pa.RecordBatch.from_arrays(columns, names)

    kept = numbered.drop("place")
    names = [*kept.columns, "sequence_id", "offset"]
    schema = kept.schema.add("sequence_id", "long").add("offset", "long")
    return numbered.mapInArrow(run, schema)


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id, ids and documents of every sequence, from packed pieces with ``ids``."""
    parts = packed.groupBy("sequence_id").agg(
        F.sort_array(F.collect_list(F.struct("offset", "doc_id", "ids"))).alias("parts")
    )  # a sequence holds at most ``SIZE`` ids
    joined = F.aggregate("parts.ids", F.lit(b""), lambda all_, ids: F.concat(all_, ids))
    return parts.select("sequence_id", joined.alias("ids"), F.col("parts.doc_id").alias("doc_ids"))


def pack_documents(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece."""
    pieces, _ = materialize(
        cut_pieces(docs, path).withColumn("ids_crc32", F.crc32("ids")), "packing-pieces"
    )
    return pack(pieces.drop("ids"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 2048 ids."""
    import public_tokenizers

    docs = table(spark, sf_dir, "documents")
    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))

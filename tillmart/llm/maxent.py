"""Language-model scoring by a hashed maximum-entropy model with a class-factored softmax.

A token's probability given the tokens before it is P(class | history) x P(slot | class,
history) x P(word | class and slot). Classes are words with like endings: the most frequent
words, ordered by their spelling from the end, are cut into ``CLASSES`` blocks, each word a
slot of its block. Slot 0 of a class stands for all other words whose ending falls into the
block, known or not; inside it a word has its share of the counts, and one outcome is kept
for all unknown words of the class. So probabilities of all words and the end sum to one.

The first two factors are softmaxes over n-gram and skip features (``FEATURES``), hashed
into rows of fixed tables; count ratios are their offsets, so an untrained model is a
unigram model. Training is one pass over all training documents in ``ROUNDS``: every task
takes gradient steps from the same weights over its own documents, and the changes of each
row are averaged by how often tasks used it. Scoring runs over blocks of tokens in numpy.

Counts of all words of all training documents are one table, built by partial counts before
the shuffle. The most frequent words, at most ``HEAD`` and none longer than ``LONGEST``
bytes, are in every task; all others of a document meet their counts in a join. Both ways
are always taken, and a word that most documents hold is never shuffled. Vocabulary, counts
and gradient steps grow with the corpus; the size of the tables of weights is a parameter.

Defined results: a null text is empty, and an empty text is its end token. Documents without
an id are training documents. Documents that share an id are documents of their own. With no
training document every probability is 1 over the one outcome there is: scores are 0.
"""

from __future__ import annotations

from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, only, table

CLASSES, SLOTS = 24, 24
# Rows of the two tables of weights: classes, and slots within a class.
CLASS_ROWS, SLOT_ROWS = 1 << 14, 1 << 16
# Which of the tokens before (1 is the one just before) make up each feature.
FEATURES = ((1,), (2,), (1, 2))
ROUNDS = 2
TASK_TOKENS = 4_000_000
BATCH_TOKENS = 4096
RATE, SPENT = 0.15, 0.05
HEAD, LONGEST = 1 << 19, 64
# Text a counting task reads before it hands its counts on.
COUNTED_BYTES = 32 << 20
CHUNK = 1024
END = b"\n"  # no word holds white space
_BEFORE = 65_535  # the code before a document's first token
_LN10 = np.log(10.0)
# Of a score and of a sum of exponentials: what 32-bit floats hold.
_HIGHEST, _LEAST = 60.0, np.float32(1e-37)


def words(text: str | None) -> list[bytes]:
    """Words of a text: A-Z lower-cased, cut at space and the controls 9 to 13."""
    return (text or "").encode().lower().split()


def word_counts(texts: DataFrame) -> DataFrame:
    """word, n: how often each word, and the end, occurs in all ``texts`` (one column)."""
    schema = pa.schema([("word", pa.binary()), ("n", pa.int64())])

    def run(batches):
        counts, read = Counter(), 0

        def made() -> pa.RecordBatch:
            kinds = [pa.array(counts.keys(), pa.binary()), pa.array(counts.values(), pa.int64())]
            return pa.RecordBatch.from_arrays(kinds, schema=schema)

        for batch in batches:
            for text in batch.column(0).to_pylist():
                counts.update(words(text))
                counts[END] += 1
                read += len(text or "")
                if read >= COUNTED_BYTES:
                    yield made()
                    counts.clear()
                    read = 0
        if counts:
            yield made()

    return texts.mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


@dataclass
class Vocabulary:
    """The most frequent words, classes by ending, and what every word counts for."""

    known: bytes  # words joined by spaces
    counts: np.ndarray
    total: int
    distinct: int
    codes: np.ndarray  # class x slots + slot
    slots: int
    bounds: list[bytes]  # first ending, spelled backwards, of every class but the first
    least: int  # words with fewer occurrences are not listed
    masses: np.ndarray = field(default_factory=lambda: np.zeros(0))  # of slot 0, by class

    @classmethod
    def of(cls, found: list[bytes], counts: np.ndarray, least: int, total: int, distinct: int,
           classes: int = CLASSES, slots: int = SLOTS) -> Vocabulary:
        """Classes and slots from the listed words, in order, and their counts."""
        ranked = np.argsort(-counts, kind="stable")[: classes * (slots - 1)].tolist()
        listed = sorted(ranked, key=lambda i: found[i][::-1])
        blocks = [listed[at : at + slots - 1] for at in range(0, len(listed), slots - 1)]
        bounds = [found[block[0]][::-1] for block in blocks[1:]]
        codes = np.array([bisect_right(bounds, w[::-1]) * slots for w in found], dtype=np.uint16)
        for number, block in enumerate(blocks):
            codes[block] = number * slots + 1 + np.arange(len(block))
        return cls(b" ".join(found), counts, total, distinct, codes, slots, bounds, least)

    @cached_property
    def index(self) -> dict[bytes, int]:
        listed = self.known.split(b" ") if len(self.counts) else []
        return _Places((w, i) for i, w in enumerate(listed))

    def class_of(self, word: bytes) -> int:
        """The class a word's ending falls into."""
        return bisect_right(self.bounds, word[::-1])

    @property
    def classes(self) -> int:
        return len(self.bounds) + 1

    @property
    def floor(self) -> float:
        return self.total + 0.5 * (self.distinct + 1)

    def base(self, counts: np.ndarray) -> np.ndarray:
        """log10 of the unigram probability."""
        return np.log10((counts + 0.5) / self.floor)

    def inner(self, counts: np.ndarray, classes: np.ndarray) -> np.ndarray:
        """log10 of the share within slot 0."""
        return np.log10((counts + 0.5) / self.masses[classes])


class _Places(dict):
    def __missing__(self, word: bytes) -> int:
        return -1


def vocabulary(counts: DataFrame, classes: int = CLASSES, slots: int = SLOTS) -> Vocabulary:
    """The vocabulary of a table of all word counts."""
    spark = counts.sparkSession
    sizes = (
        counts.groupBy((F.length(F.bin("n")) - 1).alias("power"))
        .agg(F.count(F.lit(1)).alias("kinds"), F.sum("n").alias("n"))
        .collect()  # one row per power of two
    )
    least, held = 1, 0
    for row in sorted(sizes, key=lambda r: -r.power):
        held += row.kinds
        if held > HEAD:
            least = 2 << row.power
            break
    listed = counts.where((F.col("n") >= least) & (F.length("word") <= LONGEST))
    listed = listed.toArrow().sort_by("word")
    made = Vocabulary.of(
        listed.column("word").to_pylist(), listed.column("n").to_numpy().astype(np.int64), least,
        sum(r.n for r in sizes), sum(r.kinds for r in sizes), classes, slots,
    )
    shared = spark.sparkContext.broadcast(made)

    def run(batches):
        vocab = shared.value
        masses = np.zeros(vocab.classes)
        codes, index = vocab.codes, vocab.index
        for batch in batches:
            for word, n in zip(*(batch.column(i).to_pylist() for i in (0, 1)), strict=True):
                place = index[word]
                if place < 0:
                    masses[vocab.class_of(word)] += n + 0.5
                elif codes[place] % slots == 0:
                    masses[codes[place] // slots] += n + 0.5
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(masses)), pa.int32()), pa.array(masses)], names=["class", "mass"]
        )

    sums = counts.mapInArrow(run, "class int, mass double").groupBy("class").agg(F.sum("mass"))
    made.masses = np.full(made.classes, 0.5)  # all unknown words of a class are one outcome
    for number, mass in sums.collect():
        made.masses[number] += mass
    return made


def encode(docs: DataFrame, vocab: Vocabulary) -> DataFrame:
    """Stored codes and count scores of ``docs`` (doc_id, text, held_out).

    ``rest`` are the words of a document that are not listed, with times and classes.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vocab)
    schema = pa.schema(
        [("row", pa.int64()), ("doc_id", pa.int64()), ("held_out", pa.bool_()),
         ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base", pa.float64()),
         ("inner", pa.float64()), ("codes", pa.binary()), ("rest", pa.list_(pa.binary())),
         ("rest_times", pa.list_(pa.int64())), ("rest_classes", pa.list_(pa.int32()))]
    )

    def run(batches):
        vocab = shared.value
        index = vocab.index.__getitem__
        base = vocab.base(vocab.counts)
        slots = vocab.slots
        inside = vocab.codes % slots == 0
        inner = np.where(inside, vocab.inner(vocab.counts, vocab.codes // slots), 0.0)

        def document(text: str | None) -> tuple:
            tokens = words(text)
            tokens.append(END)
            places = np.fromiter(map(index, tokens), np.int64, len(tokens))
            missing = np.flatnonzero(places < 0)
            listed = places[places >= 0]
            codes = np.zeros(len(places), "<u2")
            codes[places >= 0] = vocab.codes[listed]
            rest = Counter(tokens[i] for i in missing.tolist())
            classes = {w: vocab.class_of(w) for w in rest}
            if rest:
                codes[missing] = [classes[tokens[i]] * slots for i in missing.tolist()]
            return (
                len(tokens), len(listed), base[listed].sum(), inner[listed].sum(), codes.tobytes(),
                list(rest), list(rest.values()), list(classes.values()),
            )

        for batch in batches:
            if batch.num_rows:
                columns = zip(*map(document, batch.column(3).to_pylist()), strict=True)
                made = [pa.array(c, t.type) for c, t in zip(columns, list(schema)[3:], strict=True)]
                yield pa.RecordBatch.from_arrays([*batch.columns[:3], *made], schema=schema)

    numbered = docs.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", "held_out", "text"
    )
    target = (
        "row long, doc_id long, held_out boolean, n_tokens long, n_known long, base double, "
        "inner double, codes binary, rest array<binary>, rest_times array<long>, rest_classes array<int>"
    )
    return materialize(numbered.mapInArrow(run, target), "encoded")[0]


@dataclass
class Weights:
    """Rows of weights, the squared gradients each has seen, and how often it was used."""

    rows: np.ndarray
    spent: np.ndarray
    used: np.ndarray

    @classmethod
    def empty(cls, rows: int, columns: int) -> Weights:
        return cls(np.zeros((rows, columns), np.float32), np.full(rows, SPENT, np.float32),
                   np.zeros(rows, np.float32))

    def scores(self, at: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Sums of the rows ``at`` (tokens x features) plus offsets."""
        total = self.rows[at[:, 0]]
        for i in range(1, at.shape[1]):
            total += self.rows[at[:, i]]
        total += offsets
        return total

    def step(self, at: np.ndarray, gradient: np.ndarray) -> None:
        """One gradient step; a row's step shrinks with what it has spent."""
        features = at.shape[1]
        flat = at.ravel()
        order = np.argsort(flat, kind="stable")
        ordered = flat[order]
        starts = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
        rows = ordered[starts]
        sums = np.add.reduceat(np.take(gradient, order // features, axis=0), starts, axis=0)
        self.spent[rows] += np.einsum("ij,ij->i", sums, sums) / sums.shape[1]
        self.used[rows] += np.diff(starts, append=len(flat))
        sums *= (RATE / np.sqrt(self.spent[rows]))[:, None]
        self.rows[rows] -= sums


def _mixed(keys: np.ndarray) -> np.ndarray:
    keys = keys * np.uint64(0x9E3779B97F4A7C15)
    keys ^= keys >> np.uint64(31)
    keys *= np.uint64(0xBF58476D1CE4E5B9)
    return keys ^ (keys >> np.uint64(33))


def _normalised(scores: np.ndarray, target: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Probabilities, and the natural logarithm of that of ``target``.

    Scores are log shares plus a few weights, far from what an exponential can't hold.
    """
    np.clip(scores, None, _HIGHEST, out=scores)
    chosen = scores[np.arange(len(target)), target].astype(np.float64)
    np.exp(scores, out=scores)
    total = np.maximum(scores @ np.ones(scores.shape[1], np.float32), _LEAST)
    scores *= (1 / total)[:, None]
    return scores, chosen - np.log(total.astype(np.float64))


@dataclass
class Model:
    """P(class | history) and P(slot | class, history)."""

    class_offsets: np.ndarray
    slot_offsets: np.ndarray
    by_class: Weights
    by_slot: Weights

    @classmethod
    def of(cls, vocab: Vocabulary) -> Model:
        """The untrained model: shares of the counts."""
        mass = np.zeros(vocab.classes * vocab.slots)
        np.add.at(mass, vocab.codes, np.where(vocab.codes % vocab.slots, vocab.counts + 0.5, 0.0))
        mass = mass.reshape(vocab.classes, vocab.slots)
        mass[:, 0] = vocab.masses
        with np.errstate(divide="ignore"):
            slots = np.log(mass / mass.sum(axis=1, keepdims=True)).astype(np.float32)
        classes = np.log(mass.sum(axis=1) / mass.sum()).astype(np.float32)
        return cls(classes, slots, Weights.empty(CLASS_ROWS, vocab.classes),
                   Weights.empty(SLOT_ROWS, vocab.slots))

    def blocks(self, codes: np.ndarray, starts: np.ndarray) -> Iterator[tuple]:
        """(class, slot, rows of the class table, rows of the slot table) by block of tokens."""
        deepest = max(map(max, FEATURES))
        before = []
        for back in range(1, deepest + 1):
            past = np.full(len(codes), _BEFORE, np.uint16)
            past[back:] = codes[:-back]
            for i in range(back):  # histories do not reach into the document before
                at = starts + i
                past[at[at < np.append(starts[1:], len(codes))]] = _BEFORE
            before.append(past)
        for at in range(0, len(codes), BATCH_TOKENS):
            block = slice(at, at + BATCH_TOKENS)
            numbers, slots = np.divmod(codes[block].astype(np.int64), self.slot_offsets.shape[1])
            keys = np.empty((len(numbers), len(FEATURES)), np.uint64)
            for i, parts in enumerate(FEATURES):
                key = np.full(len(numbers), i + 1, np.uint64)
                for back in parts:
                    key = (key << np.uint64(16)) | before[back - 1][block].astype(np.uint64)
                keys[:, i] = key
            inside = keys + (numbers[:, None].astype(np.uint64) + np.uint64(1) << np.uint64(48))
            yield (
                numbers,
                slots,
                (_mixed(keys) & np.uint64(CLASS_ROWS - 1)).astype(np.uint16),
                (_mixed(inside) & np.uint64(SLOT_ROWS - 1)).astype(np.uint16),
            )

    def run(self, codes: np.ndarray, starts: np.ndarray, learn: bool) -> np.ndarray:
        """log10 probabilities of all tokens; learns from them first if asked to."""
        out = np.empty(len(codes))
        at = 0
        for numbers, slots, class_rows, slot_rows in self.blocks(codes, starts):
            everyone = np.arange(len(numbers))
            total = 0.0
            for weights, rows, target, offsets in (
                (self.by_class, class_rows, numbers, self.class_offsets),
                (self.by_slot, slot_rows, slots, self.slot_offsets[numbers]),
            ):
                shares, logs = _normalised(weights.scores(rows, offsets), target)
                total = total + logs
                if learn:
                    shares[everyone, target] -= 1
                    weights.step(rows, shares)
            out[at : at + len(numbers)] = total / _LN10
            at += len(numbers)
        return out


def _stream(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all documents of a batch, and where each begins."""
    values = column.to_pylist()
    sizes = np.array([len(v) // 2 for v in values])
    return np.frombuffer(b"".join(values), "<u2"), np.cumsum(sizes) - sizes


def train(encoded: DataFrame, model: Model, tokens: int) -> Model:
    """``model`` after one pass over the training documents of ``encoded``."""
    context = encoded.sparkSession.sparkContext
    tables = (model.by_class, model.by_slot)
    schema = pa.schema([("chunk", pa.int32()), ("used", pa.binary()), ("change", pa.binary())])
    target = "chunk int, used binary, change binary"

    def merge(batches):
        sums: dict[int, tuple] = {}
        for batch in batches:
            for row in batch.to_pylist():
                used, change = (np.frombuffer(row[n], np.float32) for n in ("used", "change"))
                old = sums.get(row["chunk"])
                sums[row["chunk"]] = (old[0] + used, old[1] + change) if old else (used, change)
        for chunk, (used, change) in sums.items():
            mean = change.reshape(len(used), -1) / np.maximum(used, 1)[:, None]
            yield pa.RecordBatch.from_arrays(
                [pa.array([chunk], pa.int32()), pa.array([used.tobytes()], pa.binary()),
                 pa.array([mean.astype(np.float32).tobytes()], pa.binary())], schema=schema
            )

    for turn in range(ROUNDS):
        shared = context.broadcast(model)

        def learn(batches):
            first = shared.value
            own = Model(first.class_offsets, first.slot_offsets, *(
                Weights(w.rows.copy(), w.spent.copy(), np.zeros_like(w.used))
                for w in (first.by_class, first.by_slot)
            ))
            seen = False
            for batch in batches:
                if batch.num_rows:
                    own.run(*_stream(batch.column(0)), learn=True)
                    seen = True
            chunk = 0
            for old, new in ((first.by_class, own.by_class), (first.by_slot, own.by_slot)):
                for at in range(0, len(new.rows), CHUNK):
                    part = slice(at, at + CHUNK)
                    used = new.used[part]
                    change = np.column_stack([new.rows[part] - old.rows[part],
                                              new.spent[part] - old.spent[part]])
                    if seen:
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([chunk], pa.int32()), pa.array([used.tobytes()], pa.binary()),
                             pa.array([(change * used[:, None]).tobytes()], pa.binary())], schema=schema
                        )
                    chunk += 1

        mine = F.pmod(F.xxhash64("row"), F.lit(ROUNDS)) == turn
        changes = (
            encoded.where(~F.col("held_out") & mine)
            .select("codes")
            .coalesce(max(1, tokens // (ROUNDS * TASK_TOKENS)))
            .mapInArrow(learn, target)
            .repartition("chunk")
            .mapInArrow(merge, target)
        )
        found = {row.chunk: row.change for row in changes.select("chunk", "change").collect()}
        chunk = 0
        for weights in tables:
            for at in range(0, len(weights.rows), CHUNK):
                if chunk in found:
                    part = slice(at, at + CHUNK)
                    change = np.frombuffer(found[chunk], np.float32)
                    change = change.reshape(len(weights.rows[part]), -1)
                    weights.rows[part] += change[:, :-1]
                    weights.spent[part] += change[:, -1]
                chunk += 1
        shared.unpersist()
    return model


def score(encoded: DataFrame, counts: DataFrame, vocab: Vocabulary, model: Model) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, base_score and score of every document."""
    shared = encoded.sparkSession.sparkContext.broadcast(model)
    plain = ["row", "doc_id", "held_out", "n_tokens", "n_known", "base", "inner"]

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                codes, starts = _stream(batch.column(len(plain)))
                sums = np.add.reduceat(shared.value.run(codes, starts, learn=False), starts)
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[: len(plain)], pa.array(sums)], names=[*plain, "context"]
                )

    scored = encoded.select(*plain, "codes").mapInArrow(
        run,
        "row long, doc_id long, held_out boolean, n_tokens long, n_known long, base double, "
        "inner double, context double",
    )
    each = F.explode(F.arrays_zip("rest", "rest_times", "rest_classes"))
    masses = F.array(*[F.lit(float(m)) for m in vocab.masses])
    n = F.coalesce(F.col("n"), F.lit(0))
    others = (
        encoded.select("row", each.alias("r"))
        .select("row", F.col("r.rest").alias("word"), F.col("r.rest_times").alias("times"),
                F.col("r.rest_classes").alias("class"))
        .join(counts.where((F.col("n") < vocab.least) | (F.length("word") > LONGEST)), "word", "left")
        .groupBy("row")
        .agg(
            F.sum(F.when(n > 0, F.col("times")).otherwise(0)).alias("more_known"),
            F.sum(F.col("times") * F.log10((n + 0.5) / F.lit(vocab.floor))).alias("more_base"),
            F.sum(F.col("times") * F.log10((n + 0.5) / F.get(masses, F.col("class")))).alias("more_inner"),
        )
    )

    def more(name: str):
        return F.coalesce(F.col(name), F.lit(0))

    return scored.join(others, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + more("more_known")).alias("n_known"),
        F.lit(vocab.total).cast("long").alias("train_tokens"),
        (F.col("base") + more("more_base")).alias("base_score"),
        (F.col("context") + F.col("inner") + more("more_inner")).alias("score"),
    )


def train_and_score(docs: DataFrame) -> DataFrame:
    """Scores of all ``docs`` (doc_id, text, held_out) by a model of those not held out."""
    docs = only(docs, "doc_id", "text", "held_out")
    counts, _ = materialize(word_counts(docs.where(~F.col("held_out")).select("text")), "words")
    vocab = vocabulary(counts)
    encoded = encode(docs, vocab)
    model = train(encoded, Model.of(vocab), vocab.total)
    return score(encoded, counts, vocab, model)


def op13_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents; those whose checksum leaves 1 by 5 are held out."""
    docs = only(table(spark, sf_dir, "documents"), "doc_id", "text")
    checksum = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    held_out = F.coalesce(F.pmod(checksum, F.lit(5)) == 1, F.lit(False))
    return train_and_score(docs.withColumn("held_out", held_out))

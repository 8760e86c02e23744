"""Toxicity by weak supervision.

Voters are words and word stems of a lexicon learned from labelled rows, patterns of
style, and the human label itself, which may be wrong. A generative model (one hidden
truth, an accuracy per voter, correlations between voters within a class) is fitted by
expectation-maximisation; its posterior labels train a linear classifier, and that
scores every document.

The labelled sample is bounded by ``SAMPLE`` rows, taken by a hash of the id; only rows
whose crc32(doc_id as text) mod 5 is not 0 are learned from. Scoring reads every whole
text once and needs nothing but the model.

Defined results: a null or empty text gets the score of a text without any vote; rows
without an id are scored and count as not held out (no remainder); of rows that share
an id, or text and label, one is learned from. With labels of one class only, or none, all scores are the
share of that class among the labels, or 0.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Columns, map_rows, map_whole, materialize, only, table

SAMPLE = 20_000
FOLDS = 5
# Words and stems must occur in this many toxic documents to be looked at. All that tell
# are kept: the most telling vote each for itself, the others in so many groups.
SUPPORT = 5
VOTERS, GROUPS = 128, 16
STEMS = (4, 5, 6)
# Log-likelihood that a lexeme must tell for toxic in a full sample (less in a smaller
# one, down to the least), and its rate over the clean one.
EVIDENCE, LEAST_EVIDENCE, RATIO = 30.0, 15.0, 8
# Lexemes that a task counts at a time.
COUNTED = 500_000
# Correlations below this are not counted against a voter.
STRONG = 0.3
_WORDS = re.compile(r"[^\W\d_]+")


def lexemes(text: str) -> set[str]:
    """Lower-cased words, and stems marked by a star."""
    words = set(_WORDS.findall(text.lower()))
    return words | {w[:n] + "*" for n in STEMS for w in words if len(w) >= n}


PATTERNS = ("shouting", "exclaims", "addresses", "repeats", "digits")
_YOU = re.compile(r"\byou(?:'re| are)? (?:a |an |so |all )?\w+", re.I)
_REPEAT = re.compile(r"(\w)\1{3,}")


def style(text: str) -> list[float]:
    """The pattern voters, as shares between 0 and 1."""
    data = np.frombuffer(text.encode("utf-8", "replace"), dtype=np.uint8)
    n = max(1, len(data))
    upper = int(((data >= 65) & (data <= 90)).sum())
    lower = int(((data >= 97) & (data <= 122)).sum())
    marks = int((data == 33).sum())
    return [
        float(upper > 20 and upper > lower),
        min(1.0, 50 * marks / n),
        float("you" in text and bool(_YOU.search(text))),
        float(bool(_REPEAT.search(text))),
        float(int(((data >= 48) & (data <= 57)).sum()) > n / 5),
    ]


class Lexicon:
    """Finds words and stems in a text in one pass."""

    def __init__(self, entries: list[str]) -> None:
        self.entries = entries
        self.automaton = ahocorasick.Automaton()
        keys: dict[str, list[int]] = {}
        for i, entry in enumerate(entries):
            keys.setdefault(entry.rstrip("*"), []).append(i)
        for key, places in keys.items():
            self.automaton.add_word(key, (len(key), places))
        if entries:
            self.automaton.make_automaton()

    def find(self, text: str) -> dict[int, int]:
        """Place of each entry found -> how often."""
        found: dict[int, int] = {}
        if not self.entries or not text:
            return found
        low = text.lower()
        for end, (size, places) in self.automaton.iter(low):
            start = end - size + 1
            if start and _letter(low[start - 1]):
                continue
            whole = end + 1 == len(low) or not _letter(low[end + 1])
            for i in places:
                if whole or self.entries[i].endswith("*"):
                    found[i] = found.get(i, 0) + 1
        return found


def _letter(c: str) -> bool:
    return bool(_WORDS.match(c))


@dataclass
class LabelModel:
    """Chances of each voter's vote under either truth, and its weight."""

    prior: float
    rates: np.ndarray  # class x voter
    weight: np.ndarray

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        """Chance of the truth being 1."""
        logs = [
            votes @ (self.weight * np.log(r)) + (1 - votes) @ (self.weight * np.log(1 - r))
            for r in self.rates
        ]
        gap = np.clip(logs[1] - logs[0] + np.log(self.prior / (1 - self.prior)), -30, 30)
        return 1 / (1 + np.exp(-gap))


def fit_label_model(votes: np.ndarray, start: np.ndarray, rounds: int = 30) -> LabelModel:
    """Expectation-maximisation from the posterior ``start``.

    Voters that are strongly correlated within a class tell less together than apart:
    each counts by one over the sum of those correlations. The last voter is the human
    label, which was given without looking at the others.
    """
    p = start
    weight = np.ones(votes.shape[1])
    for _ in range(rounds):
        rates = np.stack([(w @ votes + 0.05) / (w.sum() + 1.0) for w in (1 - p, p)])
        rates = np.clip(rates, 1e-5, 1 - 1e-5)
        weight = 1 / np.abs(correlations(votes, p, rates)).sum(axis=1)
        weight[-1] = 1
        model = LabelModel(float(np.clip(p.mean(), 1e-3, 1 - 1e-3)), rates, weight)
        p = model.posterior(votes)
    return model


def correlations(votes: np.ndarray, p: np.ndarray, rates: np.ndarray) -> np.ndarray:
    """Correlations of voters that the truth doesn't explain."""
    total = np.zeros((votes.shape[1],) * 2)
    for w, r in zip((1 - p, p), rates, strict=True):
        rest = votes - r
        total += (rest * w[:, None]).T @ rest
    scale = np.sqrt(np.maximum(np.diag(total), 1e-9))
    found = total / np.outer(scale, scale)
    # Long documents hold more of everything, which correlates all voters a little.
    found[np.abs(found) < max(STRONG, 3 / np.sqrt(max(1, len(votes))))] = 0
    np.fill_diagonal(found, 1)
    return found


@dataclass
class ToxicityModel:
    """The final linear classifier."""

    entries: list[str]
    weights: np.ndarray
    constant: float | None = None
    columns: np.ndarray | None = None  # feature of each entry, if not its own place

    def __post_init__(self) -> None:
        if self.columns is None:
            self.columns = np.arange(len(self.entries))

    def features(self, found: dict[int, int], text: str) -> np.ndarray:
        """Presence of each entry or group, how many there are, and style."""
        n = int(self.columns.max(initial=-1)) + 1
        x = np.zeros(n + len(PATTERNS) + 2)
        for i in found:
            x[self.columns[i]] = 1
        x[n : n + len(PATTERNS)] = style(text)
        x[-2] = np.log1p(sum(found.values()))
        x[-1] = 1
        return x

    def scorer(self):
        """A function from text to score."""
        if self.constant is not None:
            return lambda text: self.constant
        lexicon = Lexicon(self.entries)

        def score(text: str | None) -> float:
            text = text or ""
            z = float(self.features(lexicon.find(text), text) @ self.weights)
            return float(1 / (1 + np.exp(-min(30.0, max(-30.0, z)))))

        return score


def fit_linear(x: np.ndarray, y: np.ndarray, ridge: float = 1e-4) -> np.ndarray:
    """Logistic regression on soft labels by Newton steps; the constant isn't shrunk."""
    w = np.zeros(x.shape[1])
    shrink = np.full(x.shape[1], ridge)
    shrink[-1] = 1e-9
    for _ in range(25):
        q = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (q - y) / len(y) + shrink * w
        hess = (x * (q * (1 - q) / len(y))[:, None]).T @ x + np.diag(shrink + 1e-9)
        w -= np.linalg.solve(hess, grad)
    return w


def training_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """text and toxic of the bounded sample, stored."""
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS
    known = (
        only(labels, "doc_id", "toxic")
        .where("toxic IN (0, 1) AND doc_id IS NOT NULL")
        .where(fold != 0)
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(SAMPLE)
    )
    rows = (
        only(docs, "doc_id", "text")
        .join(F.broadcast(known), "doc_id")  # SAMPLE rows at most
        .groupBy("doc_id")
        .agg(F.min("text").alias("text"), F.max("toxic").alias("toxic"))
        .select("doc_id", F.coalesce("text", F.lit("")).alias("text"), "toxic")
        .dropDuplicates(["text", "toxic"])  # copies are no further evidence
    )
    return materialize(rows, "toxicity-sample")[0]


def _counter(batches):
    """Documents per lexeme of each partition, in pieces of bounded size."""

    def counted(seen: dict[str, int]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict(
            {"lexeme": list(seen), "n": list(seen.values())},
            schema=pa.schema([("lexeme", pa.string()), ("n", pa.int64())]),
        )

    seen: dict[str, int] = {}
    for batch in batches:
        for text in batch.column("text").to_pylist():
            for x in lexemes(text):
                seen[x] = seen.get(x, 0) + 1
            if len(seen) >= COUNTED:
                yield counted(seen)
                seen = {}
    yield counted(seen)


def evidence(rows: int) -> float:
    """The log-likelihood that a lexeme must tell in a sample of so many rows."""
    return max(LEAST_EVIDENCE, EVIDENCE * min(1.0, rows / SAMPLE))


def candidate_lexemes(sample: DataFrame, toxic: int, clean: int) -> list[str]:
    """All words and stems that tell toxic from clean documents of the sample, best first."""

    def counts(label: int, name: str) -> DataFrame:
        texts = sample.where(F.col("toxic") == label).select("text")
        found = texts.mapInArrow(_counter, "lexeme string, n long")
        return found.groupBy("lexeme").agg(F.sum("n").alias(name))

    rate = (F.coalesce("misses", F.lit(0)) + 0.5) / (clean + 1)
    # Among so many lexemes some look telling by chance; those told less than this.
    telling = (
        counts(1, "hits")
        .where(F.col("hits") >= SUPPORT)
        .join(counts(0, "misses"), "lexeme", "left")
        .withColumn("ratio", F.col("hits") / toxic / rate)
        .withColumn("told", F.col("hits") * F.log("ratio"))
        .where((F.col("ratio") >= RATIO) & (F.col("told") >= evidence(toxic + clean)))
        .select("lexeme", "told")
        .collect()  # each is held by SUPPORT documents of the bounded sample
    )
    return [r["lexeme"] for r in sorted(telling, key=lambda r: (-r["told"], r["lexeme"]))]


def choose_voters(
    found: list[dict[int, int]], toxic: np.ndarray, candidates: list[str]
) -> tuple[list[int], list[int]]:
    """The best candidates and the others, without those that repeat a better one of the same stem."""
    holders: dict[int, set[int]] = {}
    for row in np.flatnonzero(toxic == 1):
        for i in found[row]:
            holders.setdefault(i, set()).add(int(row))
    chosen: dict[str, list[int]] = {}
    best, others = set(), []
    for i, entry in enumerate(candidates):
        rows, family = holders.get(i, set()), chosen.setdefault(entry[: STEMS[0]], [])
        if rows and all(len(rows & holders[j]) < 0.9 * len(rows) for j in family):
            family.append(i)
            if len(best) < VOTERS:
                best.add(i)
            else:
                others.append(i)
    return [i for family in chosen.values() for i in family if i in best], others


def train(docs: DataFrame, labels: DataFrame) -> ToxicityModel:
    """Fit everything on the bounded sample."""
    sample = training_rows(docs, labels)
    sizes = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    if not toxic or not clean:
        return ToxicityModel([], np.zeros(0), toxic / max(1, toxic + clean))
    candidates = candidate_lexemes(sample, toxic, clean)

    def look(columns: Columns) -> Columns:
        lexicon = Lexicon(candidates)
        found = [sorted(lexicon.find(t).items()) for t in columns["text"]]
        return {
            "toxic": columns["toxic"],
            "entries": [[i for i, _ in f] for f in found],
            "times": [[n for _, n in f] for f in found],
            "style": [style(t) for t in columns["text"]],
        }

    rows = map_rows(
        sample, "toxic int, entries array<int>, times array<int>, style array<double>", look
    ).collect()  # SAMPLE rows at most, without their texts
    label = np.array([r["toxic"] for r in rows], dtype=float)
    found = [dict(zip(r["entries"], r["times"], strict=True)) for r in rows]
    voters, others = choose_voters(found, label, candidates)
    # The others, best first, are dealt into groups of the like: any of a group is its vote.
    groups = min(GROUPS, len(others))
    columns = [*range(len(voters)), *(len(voters) + i * groups // len(others) for i in range(len(others)))]
    place = {v: j for j, v in enumerate(voters + others)}
    entries = [candidates[v] for v in voters + others]
    n = len(voters) + groups
    x = np.zeros((len(rows), n + len(PATTERNS) + 2))
    for r, (row, f) in enumerate(zip(rows, found, strict=True)):
        own = {place[i]: k for i, k in f.items() if i in place}
        x[r, [columns[j] for j in own]] = 1
        x[r, n : n + len(PATTERNS)] = row["style"]
        x[r, -2] = np.log1p(sum(own.values()))
    x[:, -1] = 1
    twice = x[:, -2] > np.log(2.5)
    votes = np.column_stack([x[:, :n], x[:, n : n + len(PATTERNS)] > 0.5, twice, label])
    start = 0.05 + 0.9 * label
    posterior = fit_label_model(votes.astype(float), start).posterior(votes.astype(float))
    return ToxicityModel(entries, fit_linear(x, posterior), columns=np.array(columns, dtype=int))


def score_documents(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """doc_id and score of every row."""

    def work(columns: Columns) -> Columns:
        score = model.scorer()
        return {"doc_id": columns["doc_id"], "score": [score(t) for t in columns["text"]]}

    return map_rows(only(docs, "doc_id", "text"), "doc_id long, score double", work)


def keep_clean(docs: DataFrame, model: ToxicityModel, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs``, all columns, whose score is below the threshold."""
    at = docs.columns.index("text")

    def run(batches):
        score = model.scorer()
        for batch in batches:
            texts = batch.column(at).to_pylist()
            yield batch.filter(pa.array([score(t) < threshold for t in texts], pa.bool_()))

    return map_whole(docs, run)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score of every document."""
    docs = table(spark, sf_dir, "documents")
    model = train(docs, table(spark, sf_dir, "labels"))
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS
    return score_documents(docs, model).select(
        "doc_id", F.coalesce(fold == 0, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )

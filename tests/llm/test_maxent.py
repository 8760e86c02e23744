import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillmart.llm import maxent


def held(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 1


def tokens(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", lowered), "\n"]


def base(rows):
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score) by plain counting."""
    counts = Counter(t for i, x in rows if not held(i) for t in tokens(x))
    total, kinds = sum(counts.values()), len(counts)
    for i, x in rows:
        ts = tokens(x)
        score = sum(math.log10((counts[t] + 0.5) / (total + 0.5 * (kinds + 1))) for t in ts)
        yield i, held(i), len(ts), sum(counts[t] > 0 for t in ts), total, round(score, 6)


def result(spark, tmp_path, rows):
    plain = spark.createDataFrame([(i, "en", t) for i, t in rows], "doc_id long, lang string, text string")
    plain.repartition(3).write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
    return maxent.op13_lm_scoring(spark, str(tmp_path)).collect()


def check(rows, found):
    plain = [
        (r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6))
        for r in found
    ]
    key = lambda r: (r[0] is not None, r[0] or 0, *r[1:])
    expected = sorted(base(rows), key=key)
    for mine, other in zip(sorted(plain, key=key), expected, strict=True):
        assert mine[:-1] == other[:-1] and abs(mine[-1] - other[-1]) < 1e-5 * (1 + abs(other[-1]))
    assert all(math.isfinite(r.score) and r.score <= 0 for r in found)


CYCLE = ["red", "cat", "sat", "on", "mat", "BLUE", "dog", "ran", "to", "Ünder", "wall", "ß."]


def cycles(n):
    """Texts in which a word tells the next one."""
    return [(i, " ".join(CYCLE[(i + j) % 12] for j in range(20 + i % 9))) for i in range(n)]


def test_base_scores_and_odd_rows(spark, tmp_path, odd_rows):
    rows = odd_rows + cycles(60) + [(100 + i, f"only{i} the  The\tTHE x{i % 7}\x1cy") for i in range(40)]
    check(rows, result(spark, tmp_path, rows))


def test_words_that_are_not_listed(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(maxent, "HEAD", 4)
    rows = cycles(80) + [(200 + i, "a " * i + "y" * (60 + i)) for i in range(12)]
    check(rows, result(spark, tmp_path, rows))
    monkeypatch.setattr(maxent, "HEAD", 0)
    check(rows, result(spark, tmp_path, rows))


def test_learns_what_follows(spark, tmp_path):
    rows = cycles(600)
    found = [r for r in result(spark, tmp_path, rows) if r.held_out]
    assert len(found) > 80
    gain = sum(r.score - r.base_score for r in found) / sum(r.n_tokens for r in found)
    assert gain > 0.6


def test_extra_columns_with_clashing_names(spark, documents):
    rows = cycles(30)
    found = maxent.train_and_score(documents(rows).withColumn("held_out", F.lit(False)))
    assert {r.doc_id: r.n_tokens for r in found.collect()} == {i: len(tokens(t)) for i, t in rows}


@pytest.mark.parametrize("rows", [[], [(1, "a b")], [(1, None)]])
def test_nearly_nothing(spark, tmp_path, rows):
    check(rows, result(spark, tmp_path, rows))


def test_nothing_to_learn_from(spark, tmp_path):
    rows = [(i, "a b c") for i in range(200) if held(i)]
    found = result(spark, tmp_path, rows)
    assert {(r.base_score, r.score, r.n_known, r.train_tokens) for r in found} == {(0, 0, 0, 0)}


def test_probabilities_sum_to_one(spark, documents):
    docs = maxent.only(documents(cycles(120)), "doc_id", "text").withColumn("held_out", F.lit(False))
    counts = maxent.word_counts(docs.select("text"))
    vocab = maxent.vocabulary(counts, classes=3, slots=5)
    model = maxent.train(maxent.encode(docs, vocab), maxent.Model.of(vocab), vocab.total)
    assert vocab.classes == 3 and np.abs(model.by_slot.rows).max() > 0.1
    for history in ([], [3], [1, 6], [6, 7, 11, 2]):
        outcomes = np.unique(np.concatenate([vocab.codes, np.arange(3) * 5]))
        total = 0.0
        for code in outcomes:
            stream = np.array([*history, code], np.uint16)
            total += 10 ** model.run(stream, np.array([0]), learn=False)[-1]
        assert abs(total - 1) < 1e-5
    # Inside slot 0: known words of the class and one unknown outcome.
    for number in range(3):
        inside = {row.word: row.n for row in counts.collect()}
        listed = dict(zip(vocab.known.split(b" "), vocab.codes, strict=True))
        rest = [n for w, n in inside.items() if listed[w] % 5 == 0 and vocab.class_of(w) == number]
        shares = [10 ** vocab.inner(np.array([n]), np.array([number]))[0] for n in (*rest, 0)]
        assert abs(sum(shares) - 1) < 1e-9


def test_batches_do_not_matter_for_scores(monkeypatch):
    rng = np.random.default_rng(1)
    vocab = maxent.Vocabulary.of([b"%d" % i for i in range(200)], np.arange(1, 201), 1, 20100, 200)
    vocab.masses = np.full(vocab.classes, 0.5)
    model = maxent.Model.of(vocab)
    model.by_slot.rows[:] = rng.normal(size=model.by_slot.rows.shape)
    model.by_class.rows[:] = rng.normal(size=model.by_class.rows.shape)
    texts = [rng.choice(vocab.codes, n).astype(np.uint16) for n in (1, 3, 2, 700, 5)]
    sizes = np.array([len(t) for t in texts])
    alone = np.concatenate([model.run(t, np.array([0]), learn=False) for t in texts])
    monkeypatch.setattr(maxent, "BATCH_TOKENS", 97)
    together = model.run(np.concatenate(texts), np.cumsum(sizes) - sizes, learn=False)
    np.testing.assert_allclose(alone, together, rtol=1e-4, atol=1e-4)

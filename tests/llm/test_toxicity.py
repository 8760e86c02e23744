import random
import zlib

import numpy as np
import pytest

from tillmart.llm import toxicity

BAD = ["idiot", "moron", "scum", "lowei"]


def corpus(n=900, seed=3):
    rng = random.Random(seed)
    words = ["".join(rng.choices("abcdefgh", k=rng.randint(2, 7))) for _ in range(400)]
    rows, labels = [], []
    for i in range(n):
        text = rng.choices(words, k=rng.randint(3, 60))
        toxic = i % 5 == 0
        if toxic:
            for _ in range(rng.randint(1, 4)):
                w = rng.choice(BAD)
                text.insert(rng.randrange(len(text)), w + rng.choice(["isch", "ung", "en"]) if w == "lowei" else w)
        rows.append((i, " ".join(text)))
        # One label in twenty is wrong.
        labels.append((i, 1, int(toxic) if rng.random() > 0.05 else 1 - int(toxic)))
    return rows, labels


def labels_table(spark, labels):
    return spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_held_out_rows_are_judged_right(spark, documents):
    rows, labels = corpus()
    docs = documents(rows)
    model = toxicity.train(docs, labels_table(spark, labels))
    scores = {r["doc_id"]: r["score"] for r in toxicity.score_documents(docs, model).collect()}
    held = [i for i, _ in rows if zlib.crc32(str(i).encode()) % 5 == 0]
    right = sum((scores[i] >= 0.5) == (i % 5 == 0) for i in held)
    assert right >= 0.97 * len(held)


@pytest.mark.parametrize("voters", [128, 8])
def test_wide_toxic_vocabulary(spark, documents, monkeypatch, voters):
    """Forty sure words, each in a few toxic documents only, and one per document."""
    monkeypatch.setattr(toxicity, "VOTERS", voters)
    rng = random.Random(5)
    words = ["".join(rng.choices("abcdefgh", k=rng.randint(2, 7))) for _ in range(400)]
    bad = ["".join(rng.choices("rstuvwxz", k=7)) for _ in range(40)]
    rows = []
    for i in range(1600):
        text = rng.choices(words, k=rng.randint(3, 60))
        if i % 4 == 0:
            text.insert(rng.randrange(len(text)), bad[i // 4 % 40])
        rows.append((i, " ".join(text)))
    docs = documents(rows)
    model = toxicity.train(docs, labels_table(spark, [(i, 1, int(i % 4 == 0)) for i, _ in rows]))
    scores = {r["doc_id"]: r["score"] for r in toxicity.score_documents(docs, model).collect()}
    held = [i for i, _ in rows if zlib.crc32(str(i).encode()) % 5 == 0]
    assert sum((scores[i] >= 0.5) == (i % 4 == 0) for i in held) >= 0.95 * len(held)


def test_labels_of_held_out_rows_do_not_matter(spark, documents):
    rows, labels = corpus(400)
    other = [(i, q, 1 - t if zlib.crc32(str(i).encode()) % 5 == 0 else t) for i, q, t in labels]
    models = [toxicity.train(documents(rows), labels_table(spark, x)) for x in (labels, other)]
    assert models[0].entries == models[1].entries
    assert np.allclose(models[0].weights, models[1].weights)


def test_odd_rows(spark, documents, odd_rows):
    rows, labels = corpus(400)
    model = toxicity.train(documents(rows), labels_table(spark, labels))
    got = toxicity.score_documents(documents(odd_rows), model).collect()
    assert len(got) == len(odd_rows) and all(0 <= r["score"] < 0.5 for r in got)
    kept = toxicity.keep_clean(documents(odd_rows + [(99, "idiot moron scum you idiot")]), model)
    assert kept.columns == documents([]).columns
    assert sorted(map(str, [r[0] for r in kept.collect()])) == sorted(str(i) for i, _ in odd_rows)


def test_one_class_and_no_labels(spark, documents, odd_rows):
    docs = documents(odd_rows)
    for labels, score in (([], 0.0), ([(1, 1, 0), (2, 1, 0), (4, 1, 0)], 0.0), ([(i, 1, 1) for i in range(9)], 1.0)):
        model = toxicity.train(docs, labels_table(spark, labels))
        assert {r["score"] for r in toxicity.score_documents(docs, model).collect()} == {score}


def test_lexicon_minds_borders():
    lexicon = toxicity.Lexicon(["scum", "lowe*"])
    assert lexicon.find("Scum, scummy xscum loweis flower LOWE") == {0: 1, 1: 2}
    assert toxicity.Lexicon([]).find("anything") == {}


def test_correlated_voters_count_less():
    rng = np.random.default_rng(1)
    truth = rng.random(4000) < 0.4
    noise = rng.random((4000, 4))
    votes = np.where(truth[:, None], noise < 0.7, noise < 0.2).astype(float)
    votes = np.column_stack([votes[:, [0, 0, 0]], votes[:, 1:], truth])
    model = toxicity.fit_label_model(votes, 0.05 + 0.9 * truth)
    assert model.weight[:3].max() < 0.5 < model.weight[3:].min()

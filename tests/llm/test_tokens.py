import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tillmart.llm import binary, packing, tokens

FILES = {True: "byte_bpe_50k.json", False: "word_bpe_49k.json"}
TEXT = st.text(alphabet=st.sampled_from(list("ab É.,!'s\n\t  <|>1ſßİΣ\x1c\u0301$é")), max_size=60)


@pytest.fixture(scope="module", params=[True, False])
def pair(request):
    path = public_tokenizers.path(FILES[request.param])
    return tokens.PieceEncoder(path, request.param), Tokenizer.from_file(path)


@settings(max_examples=300, deadline=None)
@given(text=TEXT)
def test_pieces_give_the_ids_of_the_whole(pair, text):
    encoder, tokenizer = pair
    want = tokenizer.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(encoder.encode(text), "<u4").tolist() == want


def test_forgetting_changes_nothing(pair, monkeypatch):
    encoder, tokenizer = pair
    monkeypatch.setattr(tokens, "REMEMBERED", 3)
    for text in ("the cat, the dog", "a<|endoftext|>b c", "the cat again. and the dog", "it's\nall 'll"):
        want = tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == want


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 3000), max_size=300))
def test_elias_fano_round_trip(gaps):
    values = np.cumsum(np.array(gaps, dtype=np.int64))
    coded = binary.EliasFano.encode(values, int(values[-1]) if len(values) else 0)
    assert coded.all().tolist() == values.tolist()
    assert [int(coded.select(i)) for i in range(len(values))] == values.tolist()


def test_elias_fano_is_small():
    values = np.cumsum(np.random.default_rng(1).integers(1, 2000, 10_000))
    coded = binary.EliasFano.encode(values, int(values[-1]))
    bits = 8 * (coded.low.nbytes + coded.high.nbytes + coded.directory.nbytes) / len(values)
    assert bits < 2 + np.log2(values[-1] / len(values)) + 1


def test_blocks(spark, documents, odd_rows, tmp_path, monkeypatch):
    monkeypatch.setattr(binary, "BLOCK_IDS", 50)
    path = public_tokenizers.path(FILES[False])
    tokenizer = Tokenizer.from_file(path)
    binary.write_blocks(documents(odd_rows), path, str(tmp_path / "b"), 2, 49_408)
    got = binary.read_blocks(spark, str(tmp_path / "b")).orderBy("start").collect()
    assert [r["doc_id"] for r in got] == sorted((i for i, _ in odd_rows), key=lambda i: (i is not None, i or 0))
    start = 0
    for r in got:
        assert (r["start"], r["n_tokens"]) == (start, len(r["ids"]) // 4)
        start += r["n_tokens"]
    texts = dict(odd_rows)
    for r in got:
        want = tokenizer.encode(texts[r["doc_id"]] or "", add_special_tokens=False).ids + [2]
        assert np.frombuffer(r["ids"], "<u4").tolist() == want
    block = spark.read.parquet(str(tmp_path / "b")).where("n_ids > 0").first()
    for i in range(len(block["doc_ids"])):
        assert binary.read_document(block["payload"], i)[-1] == 2


def test_blocks_of_nothing(spark, documents, tmp_path):
    path = public_tokenizers.path(FILES[False])
    binary.write_blocks(documents([]), path, str(tmp_path / "b"), 2, 49_408)
    assert binary.read_blocks(spark, str(tmp_path / "b")).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=400))
def test_plans_cover_the_histogram(lengths):
    histogram = np.bincount(lengths, minlength=65)[:65]
    groups = packing.plan(histogram)
    covered = np.zeros(65, dtype=np.int64)
    for runs, times in groups:
        assert times > 0 and sum(a * n for a, n in runs) <= 64
        for a, n in runs:
            covered[a] += n * times
    assert covered.tolist() == histogram.tolist()
    # Never more than the common bound of decreasing fits.
    assert sum(t for _, t in groups) <= 11 / 9 * (sum(lengths) / 64 + 1) + 2 or max(lengths) > 21


def test_packing_is_near_the_bound():
    rng = np.random.default_rng(4)
    lengths = np.clip(rng.lognormal(6.3, 0.9, 50_000).astype(int), 1, 2048)
    histogram = np.bincount(lengths, minlength=2049)
    used = sum(t for _, t in packing.plan(histogram))
    assert used <= 1.005 * np.ceil(lengths.sum() / 2048)


def test_pieces_and_places(spark, documents, odd_rows):
    path = public_tokenizers.path(FILES[True])
    tokenizer = Tokenizer.from_file(path)
    pieces = packing.cut_pieces(documents(odd_rows), path, size=64)
    stored, _ = packing.materialize(pieces, "test")
    rows = packing.pack(stored, size=64).collect()
    fill = {}
    for r in rows:
        fill.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in fill.values():
        parts.sort()
        assert [a for a, _ in parts] == [sum(n for _, n in parts[:i]) for i in range(len(parts))]
        assert sum(n for _, n in parts) <= 64
    texts = dict(odd_rows)
    for i, text in texts.items():
        if i == 4:
            continue  # occurs twice
        own = sorted((r for r in rows if r["doc_id"] == i), key=lambda r: r["piece"])
        ids = np.concatenate([np.frombuffer(r["ids"], "<u4") for r in own]).tolist()
        assert ids == tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        assert all(r["length"] == 64 for r in own[1:])
        assert [r["start"] for r in own] == [sum(r["length"] for r in own[:k]) for k in range(len(own))]
    whole = packing.sequences(packing.pack(stored, size=64)).collect()
    assert sum(len(r["ids"]) // 4 for r in whole) == sum(r["length"] for r in rows)


def test_packing_nothing(documents):
    path = public_tokenizers.path(FILES[True])
    assert packing.pack_documents(documents([]), path).collect() == []

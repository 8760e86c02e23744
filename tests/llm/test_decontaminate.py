import random

from tillmart.llm import decontaminate as dc


def made(seed=1, n=60, extra=()):
    rng = random.Random(seed)
    words = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 7))) for _ in range(500)]
    items = []
    for i in range(n):
        half = [" ".join(rng.choices(words, k=rng.randint(6, 25))).capitalize() for _ in "qa"]
        items.append((i, ". ".join(half) + "."))
    return rng, words, items + list(extra)


def exhaustive(index, terms):
    scores = [0.0] * len(index.entries)
    for t in terms:
        for e, v in zip(*index.postings[t]):
            scores[e] += v
    return scores


def test_wand_finds_all_above_the_threshold():
    rng, words, items = made()
    index = dc.build_index(dc.entries_of(items))
    for _ in range(200):
        entry = rng.choice(index.entries).words
        asked = rng.sample(entry, len(entry) // 2) + rng.choices(words, k=40)
        terms = sorted({index.terms[w] for w in asked if w in index.terms})
        scores = exhaustive(index, terms)
        for threshold in (0.3, 0.65):
            got = dc.block_max_wand(index, terms, list(range(index.blocks)), threshold)
            assert {e for e, _ in got} == {e for e, s in enumerate(scores) if s >= threshold}


def test_no_passage_that_could_hit_is_left_out():
    rng, words, items = made(2)
    index = dc.build_index(dc.entries_of(items))
    for _ in range(60):
        text = rng.choices(words, k=rng.randint(0, 400))
        if text:
            at = rng.randrange(len(text))
            text[at:at] = rng.choice(index.entries).words
        codes = dc.np.array([index.terms.get(w, -1) for w in text], dtype=int)
        found = {c: set(b) for c, _, b in dc.promising_passages(index, codes, 0.65)}
        for cell in range(len(text) // index.cell + 1):
            part = text[cell * index.cell : (cell + 2) * index.cell]
            terms = {index.terms[w] for w in part if w in index.terms}
            for e, s in enumerate(exhaustive(index, terms)):
                if s >= 0.65:
                    assert e // dc.BLOCK in found[cell]


def test_planted_items_are_found_and_clean_texts_are_not(spark, documents):
    long_item = (900, " ".join(f"part{i}" for i in range(300)) + ". The end is here.")
    rng, words, items = made(3, extra=[long_item, (901, None), (902, ""), (903, "too short")])
    rows, want = [], set()
    for i in range(200):
        text = rng.choices(words, k=rng.randint(0, 300))
        if i % 4 == 0:
            k = rng.randrange(60)
            at = rng.randint(0, len(text))
            text[at:at] = items[k][1].upper().replace(".", " ;").split()
            want.add((i, k))
        rows.append((i, " ".join(text)))
    rows.append((300, "x " + long_item[1]))
    want.add((300, 900))
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in dc.contamination(documents(rows), benchmark).collect()}
    assert got == want
    kept = dc.keep_uncontaminated(documents(rows), benchmark)
    assert kept.columns == documents([]).columns
    assert {r[0] for r in kept.collect()} == {i for i, _ in rows} - {i for i, _ in want}


def test_excerpts_of_a_long_item_are_found_at_every_offset():
    rng, words, items = made(6)
    for size in (129, 256, 300, 700):
        long_item = [f"w{i}" for i in range(size)]
        index = dc.build_index(dc.entries_of([*items, (900, " ".join(long_item))]))
        for n in (100, 124, 145):
            for at in range(size - n + 1):
                before = rng.choices(words, k=rng.randint(0, 200))
                text = " ".join(before + long_item[at : at + n] + rng.choices(words, k=50))
                assert 900 in dc.find_leaks(index, text), (size, n, at)


def test_parts_cover_long_items():
    for n in range(dc.PART + 1, 1000):
        parts = dc.parts_of(n)
        assert max(b - a for a, b in parts) <= dc.PART
        for at in range(n - 96 + 1):
            assert any(at <= a and b <= at + 96 for a, b in parts)


def test_shards_give_the_same(spark, documents, monkeypatch):
    _, _, items = made(4, n=30)
    rows = [(i, f"lorem ipsum {t} dolor") for i, t in items]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    monkeypatch.setattr(dc, "SHARD_BYTES", 800)
    got = {(r["doc_id"], r["item_id"]) for r in dc.contamination(documents(rows), benchmark).collect()}
    assert got >= {(i, i) for i, _ in items}


def test_results_do_not_depend_on_shards(spark, documents, monkeypatch):
    _, _, items = made(7, n=30)
    rows = [(i, " ".join(t.split()[: max(5, i)])) for i, t in items]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    whole = {tuple(r) for r in dc.contamination(documents(rows), benchmark).collect()}
    monkeypatch.setattr(dc, "SHARD_BYTES", 800)
    parts = {tuple(r) for r in dc.contamination(documents(rows), benchmark).collect()}
    assert whole and {r[:2] for r in parts} == {r[:2] for r in whole}
    assert dc.np.allclose(sorted(r[2] for r in parts), sorted(r[2] for r in whole))


def test_short_items_match_word_for_word(spark, documents):
    items = [(1, "Who wrote it?"), (2, "who wrote it"), (3, "Blue."), (4, "..."), (5, None)]
    rows = [(1, "x who WROTE, it y"), (2, "who it wrote"), (3, "a blue one"), (4, "bluer"), (5, "")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = {tuple(r) for r in dc.contamination(documents(rows), benchmark).collect()}
    assert got == {(d, i, 1.0, 1.0, 1.0) for d, i in [(1, 1), (1, 2), (3, 3)]}
    kept = dc.keep_uncontaminated(documents(rows), benchmark)
    assert {r[0] for r in kept.collect()} == {2, 4, 5}


def test_odd_rows_and_empty_tables(spark, documents, odd_rows):
    benchmark = spark.createDataFrame([], "item_id long, text string")
    assert dc.contamination(documents(odd_rows), benchmark).collect() == []
    assert dc.keep_uncontaminated(documents(odd_rows), benchmark).count() == len(odd_rows)
    _, _, items = made(5)
    benchmark = spark.createDataFrame(items + items, "item_id long, text string")
    assert dc.contamination(documents(odd_rows), benchmark).collect() == []
    assert dc.contamination(documents([]), benchmark).collect() == []

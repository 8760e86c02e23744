import hashlib
import random
from collections import Counter, defaultdict

import public_tokenizers
import pytest

from tillmart.llm import alignment

A = public_tokenizers.path("byte_bpe_50k.json")
B = public_tokenizers.path("piece_bpe_32k.model")


class Brute:
    """Whole-text tokenizers and a plain walk over byte offsets."""

    def __init__(self):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a, self.b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
        self.a.encode_special_tokens = True
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in plain]
        self.bytes = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}

    def tokens(self, text):
        a = self.a.encode(" " + text, add_special_tokens=False).ids
        b = self.b.encode(text)
        spelled_a = [bytes(self.bytes[c] for c in self.a.id_to_token(i)) for i in a]
        spelled_b = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
            for i, p in ((i, self.b.id_to_piece(i)) for i in b)
        ]
        whole = (" " + text).encode()
        if b"".join(spelled_a) != whole or b"".join(spelled_b) != whole:
            return None
        return (a, spelled_a), (b, spelled_b)

    def groups(self, text):
        found = self.tokens(text) if text else None
        if found is None:
            return None
        ends = []
        for _, spelled in found:
            at, places = 0, []
            for t in spelled:
                at += len(t)
                places.append(at)
            ends.append(places)
        shared = set(ends[0]) & set(ends[1])
        out = []
        for (ids, _), places in zip(found, ends, strict=True):
            parts, part = [], []
            for i, end in zip(ids, places, strict=True):
                part.append(i)
                if end in shared:
                    parts.append(part)
                    part = []
            out.append(parts)
        return list(zip(*out, strict=True))

    def rows(self, documents):
        per, counts = [], Counter()
        for i, text in documents:
            groups = self.groups(text)
            links = Counter((a, b) for g in groups or [] for a in g[0] for b in g[1])
            counts.update(links.keys())
            per.append((i, groups, links))
        best = defaultdict(int)
        for (a, _), n in counts.items():
            best[a] = max(best[a], n)
        for i, groups, links in per:
            said = ";".join(
                ",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups or []
            )
            yield (
                i,
                sum(len(a) for a, _ in groups or []),
                sum(len(b) for _, b in groups or []),
                len(groups or []),
                sum(links.values()),
                sum(n for p, n in links.items() if counts[p] == best[p[0]]),
                sum(n * counts[p] for p, n in links.items()),
                hashlib.sha256(said.encode()).hexdigest() if groups else "",
            )


NAMES = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.fixture(scope="module")
def brute():
    return Brute()


def compare(brute, documents, rows):
    found = alignment.align_and_score(documents(rows), A, B).select(*NAMES).collect()
    key = lambda r: (r[0] is not None, *[x or 0 for x in r[:1]], *r[1:])
    assert sorted((tuple(r) for r in found), key=key) == sorted(brute.rows(rows), key=key)


PIECES = ["the", "The", " ", "  ", "\n", "\n\n", "\t", " \n", "é", "ß", "日本", "123", "4567.89", "don't",
          "▁", "<s>", "<|endoftext|>", "<0x0A>", "ﬁ", "\x00", "　", "😀", "x" * 40, "-", "...",
          "'s", "(a)", "\r\n", "​", "é", "über", "naïve"]


def strange(seed, n):
    rng = random.Random(seed)
    return [(i, "".join(rng.choices(PIECES, k=rng.randint(0, 30)))) for i in range(n)]


def test_equals_brute_force(spark, documents, brute):
    compare(brute, documents, strange(1, 400))


def test_odd_rows(spark, documents, odd_rows, brute):
    compare(brute, documents, odd_rows)


def test_rare_pairs_meet_their_counts_in_a_join(spark, documents, brute, monkeypatch):
    monkeypatch.setattr(alignment, "HEAD", 20)
    monkeypatch.setattr(alignment, "COUNTED", 50)
    compare(brute, documents, strange(2, 200))
    monkeypatch.setattr(alignment, "HEAD", 0)
    compare(brute, documents, strange(3, 60))


def test_one_text_in_most_documents(spark, documents, brute):
    rows = [(i, "the same line again, copied") for i in range(300)] + strange(4, 50)
    compare(brute, documents, rows)


def test_empty(spark, documents):
    assert alignment.align_and_score(documents([]), A, B).collect() == []


def test_tokens_equal_whole_texts(brute):
    known = alignment.Aligner(A, B)
    rng = random.Random(5)
    letters = "ab é\n.▁'1"
    for _ in range(4000):
        text = "".join(rng.choices(letters, k=rng.randint(1, 14)))
        mine, whole = known.tokens(text), brute.tokens(text)
        assert (mine is None) == (whole is None), text
        if mine:
            for m, (ids, _) in zip(mine, whole, strict=True):
                assert alignment.np.frombuffer(m, "<u4").tolist() == ids, text


def test_merges_by_rank_equal_the_tokenizer(brute):
    known = alignment.PlainTokens(A)
    assert known.ranked
    rng = random.Random(6)
    pool = [chr(c) for c in range(0x250)] + ["'s", "'S", "  ", "\n", "the", "don't", "12", "<|endoftext|>", "日"] * 6
    texts = ["".join(rng.choices(pool, k=rng.randint(1, 12))) for _ in range(20_000)]
    for text in [*texts, "x" * 3000, " " * 600 + "a", "a " * 700, "a  " * 700]:
        assert known.encode(text) == brute.a.encode(text, add_special_tokens=False).ids, text
    assert alignment._endless("b " + "x" * 500) and alignment._endless("a" + " " * 500)
    assert not alignment._endless("a  " * 700)


def test_windows_end_where_both_words_end():
    known = alignment.Aligner(A, B)
    windows = known.windows(known.tokens("one two  three"))
    assert b"".join(a for a, _ in windows) == known.tokens("one two  three")[0]
    assert len(windows) >= 3
    again = known.windows(known.tokens("two one"))
    assert windows[0] in again


def test_known_words_are_not_tokenised_again(brute):
    known, seen = alignment.Aligner(A, B), []
    for side in (known.a, known.b):
        side.encode = lambda text, whole=side.encode: seen.append(text) or whole(text)
    first = known.document("one two,\n three  four")
    assert seen and known.document("two,\n three  four one one two,\n three  four")[:2] != first[:2]
    seen.clear()
    assert known.document("one two,\n three  four")[:5] == first[:5] and not seen
    known.document("one five")
    assert seen == [" five", "five"]


def test_cut_texts_equal_whole_texts(monkeypatch):
    cut, whole = alignment.Aligner(A, B), alignment.Aligner(A, B)
    assert cut.apart
    whole.apart = False
    monkeypatch.setattr(alignment, "PARTS", 50)
    rng = random.Random(7)
    pool = [*PIECES, "\x1c", "\x85", "\u180e", "\xa0", " ", " the"]
    for k in range(3000):
        text = "".join(rng.choices(pool, k=rng.randint(0, 20 if k % 100 else 300)))
        (*a, kinds, times), (*b, other, others) = cut.document(text), whole.document(text)
        assert (a, kinds.tolist(), times.tolist()) == (b, other.tolist(), others.tolist()), text
    assert "".join(alignment.parts(" a  b\n c\t  d ")) == " a  b\n c\t  d "
    cut.words.clear(), cut.words_before.clear()
    cut.document("ending here")
    assert cut.document("ending here ")[:5] == whole.document("ending here ")[:5]
    # A group of very many links, inside a word that is cut and one that is not.
    for text in ("go " + "ab" * 3000 + " on", "go\n" + "日本" * 3000 + " on"):
        assert [str(x) for x in cut.document(text)] == [str(x) for x in whole.document(text)]

"""Alignment of two tokenizers over the same texts, by windows between shared word starts.

1. Each text is cut where both tokenizers cut it whatever comes before and after: before a
   space that follows a character that is no white space. The parts are words, mostly. New
   ones of a document are tokenised together; the ids are those of the whole text. A pair
   of vocabularies that may join such parts gets its texts whole.
2. Byte offsets where tokens of both end, and where the next token of both begins with a
   space, are anchors: they cut the parts into windows of token ids. Anchors are shared
   ends, so no group of tokens crosses one. A window is aligned once per worker: the answer
   depends on its ids alone and is remembered by the tuple of both id strings; the answer
   for a part is remembered by its text. Words repeat, so most parts are known.
3. Distinct linked id pairs of each document are stored as packed integers. Tasks count
   them before the shuffle; one row per pair of ids reaches the counts table.
4. Counts come back to the documents in two ways, always both: the most frequent pairs, at
   most ``HEAD`` of them, are sorted arrays in every task, so a pair that most documents
   hold is never shuffled; all other pairs meet their counts in a join.

Memory: one batch of documents, the remembered words and windows of a worker, ``HEAD``
pairs. Parts beyond ``LONG`` characters are not remembered by text. The
distinct pairs of one document are held at once, as its definition needs.

Defined results: a text that is null or empty, or that the tokens of either tokenizer do not
spell exactly with one space before it, has no tokens: zeros and an empty string. Documents
without an id, or that share one, are documents of their own, each with its row and count.
An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import json
import re
from array import array
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialize, only, table
from .tokens import _LETTERS

# Most pairs that every task holds: 17 bytes each.
HEAD = 1 << 20
# Entries a counting task holds before it hands them on.
COUNTED = 1 << 21
# Windows in one generation of a worker's memory: a full one becomes the one before.
WINDOWS = 60_000
# Words in one generation of a worker's memory, and most characters of one.
PARTS = 300_000
LONG = 64
# Links of a group beyond which distinct ids and their numbers take the place of links.
LARGE = 1 << 12

_STORED = (
    "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, "
    "groups_sha256 string, pairs binary, times binary"
)
# Fixed value: how byte-level vocabularies of this kind cut a text into words.
WORDS = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
_OTHER = re.compile(r"[^\x00-\u024f]")
_LONG_GAP = re.compile(r"\s{500}")
# Where texts are cut, and whether white space before a space leaves some spaces uncut.
# A space at the end is no part of its own: it would be an empty text to the second side.
_CUT = re.compile(r"(?<=\S)(?= .)", re.DOTALL)
_UNCUT = re.compile(r"\s ")


def _endless(text: str) -> bool:
    """Whether a run of letters or of blanks has 500 or more."""
    parts = text.split()
    if parts and max(map(len, parts)) >= 500:
        return True
    blanks = len(text) - sum(map(len, parts))
    return blanks - len(parts) >= 498 and _LONG_GAP.search(text) is not None


class PlainTokens:
    """Byte-level ids of a whole text; special strings are plain text.

    Where ids follow the order of merges, as in vocabularies of this kind, the same merges
    can be run by rank, which is several times faster. Two libraries may differ in what they
    call a letter, so that is done for Latin texts only, and not for endless words.
    """

    def __init__(self, path: str) -> None:
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        values = {letter: b for b, letter in enumerate(_LETTERS)}
        tokens = map(self.tokenizer.id_to_token, range(self.tokenizer.get_vocab_size()))
        self.spelled = [
            bytes(values[c] for c in token) if set(token) <= values.keys() else b"" for token in tokens
        ]
        model = json.loads(self.tokenizer.to_str())
        merged = [model["model"]["vocab"]["".join(pair)] for pair in model["model"].get("merges", [])]
        added = {t["id"] for t in model["added_tokens"]}
        ranks = {t: i for i, t in enumerate(self.spelled) if i not in added}
        cut = model["pre_tokenizer"] or {}
        plain = cut.get("type") == "ByteLevel" and not cut.get("add_prefix_space")
        # Whether no token holds what comes before and after a cut.
        self.apart = plain and cut.get("use_regex", True) and model["normalizer"] is None
        self.ranked = None
        if plain and model["normalizer"] is None and merged == sorted(merged) == sorted(
            i for t, i in ranks.items() if len(t) > 1
        ):
            self.ranked = tiktoken.Encoding(
                "ranked", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={}
            )

    def encode(self, text: str) -> list[int]:
        """Ids of a whole text."""
        if self.ranked and (text.isascii() or not _OTHER.search(text)) and not _endless(text):
            return self.ranked.encode_ordinary(text)
        return self.tokenizer.encode(text, add_special_tokens=False).ids


class MarkedPieces:
    """Ids of a sentence-piece model, which puts a space before every text."""

    def __init__(self, path: str) -> None:
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(self.model.get_piece_size())
        self.spelled = [
            bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode()
            for i, p in zip(ids, map(self.model.id_to_piece, ids), strict=True)
        ]
        # Whether no token holds what comes before and after a cut. Merges on one side of
        # it then never touch the other; other kinds of models weigh whole texts.
        made = sentencepiece_model_pb2.ModelProto.FromString(self.model.serialized_model_proto())
        kept = made.normalizer_spec
        self.apart = (
            made.trainer_spec.model_type == sentencepiece_model_pb2.TrainerSpec.BPE
            and not kept.precompiled_charsmap
            and kept.add_dummy_prefix
            and not kept.remove_extra_whitespaces
            and kept.escape_whitespaces
            and not made.trainer_spec.treat_whitespace_as_suffix
            and not any(" " in p.lstrip(" ") for p in (q.piece.replace("▁", " ") for q in made.pieces))
        )

    def encode(self, text: str) -> list[int]:
        """Ids of a whole text."""
        return self.model.encode(text)


def parts(text: str) -> list[str]:
    """A text that begins with a space, cut before each space that no white space precedes."""
    if _UNCUT.search(text) or text[-1] == " ":
        return _CUT.split(text)
    return [" " + word for word in text[1:].split(" ")]


def _outlines(spelled: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Length of each token, and whether it begins with a space."""
    lengths = np.array([len(t) for t in spelled], dtype=np.int64)
    return lengths, np.array([t[:1] == b" " for t in spelled])


class Aligner:
    """Alignments of windows, each found once.

    An alignment is (groups, text, links, times): links are ``a * width + b``, packed, each
    with its number of occurrences, or once per occurrence where there are no times.
    """

    def __init__(self, path_a: str, path_b: str) -> None:
        self.a, self.b = PlainTokens(path_a), MarkedPieces(path_b)
        self.outlines = _outlines(self.a.spelled), _outlines(self.b.spelled)
        self.width = len(self.b.spelled)
        # Both ids of a group's text, followed by what comes next in it.
        self.said = [
            [f"{i}{after}" for i in range(len(side)) for after in afters]
            for side, afters in ((self.a.spelled, ",|"), (self.b.spelled, ",;"))
        ]
        self.known: dict[tuple[bytes, bytes], tuple] = {}
        self.before: dict[tuple[bytes, bytes], tuple] = {}
        self.apart = self.a.apart and self.b.apart
        self.words: dict[str, tuple] = {}
        self.words_before: dict[str, tuple] = {}

    def ends(self, side: int, ids: np.ndarray) -> np.ndarray:
        """Byte offsets where tokens end."""
        return np.cumsum(self.outlines[side][0][ids])

    def _align(self, windows: list[tuple[bytes, bytes]]) -> list[tuple]:
        """Alignments of windows, side by side in one pass."""
        sides = [np.frombuffer(b"".join(w), "<u4").astype(np.int64) for w in zip(*windows, strict=True)]
        ends = [self.ends(side, ids) for side, ids in enumerate(sides)]
        shared = np.intersect1d(*ends, assume_unique=True)
        groups = [np.searchsorted(shared, e) for e in ends]
        many, more = (np.bincount(g, minlength=len(shared)) for g in groups)
        parts = np.cumsum([len(a) // 4 for a, _ in windows])
        last = groups[0][parts - 1]  # the last group of each window
        large = np.unique(np.searchsorted(last, np.flatnonzero(many * more > LARGE))).tolist()
        if large:
            found = iter(self._align(rest) if (rest := [w for i, w in enumerate(windows) if i not in large]) else [])
            return [self._large(w) if i in large else next(found) for i, w in enumerate(windows)]

        # Each token of the first side meets the tokens of the second in its group.
        links = more[groups[0]]
        upto = np.cumsum(links)
        first = np.cumsum(more)[groups[0]] - links
        at = np.arange(upto[-1]) + np.repeat(first - (upto - links), links)
        pairs = (np.repeat(sides[0] * self.width, links) + sides[1][at]).tobytes()

        # Tokens of a group in order, the first side's before the second's.
        places = [np.arange(len(sides[0])) + (np.cumsum(more) - more)[groups[0]],
                  np.arange(len(sides[1])) + np.cumsum(many)[groups[1]]]
        texts = np.empty(len(sides[0]) + len(sides[1]), object)
        for side in (0, 1):
            closes = np.append(groups[side][1:] != groups[side][:-1], True)
            texts[places[side]] = list(map(self.said[side].__getitem__, (2 * sides[side] + closes).tolist()))
        texts = texts.tolist()
        token_ends = (np.cumsum(many + more)[last]).tolist()
        link_ends = (8 * upto[parts - 1]).tolist()
        group_ends = (last + 1).tolist()
        return [
            (g - f, "".join(texts[i:j])[:-1], pairs[k:m], None)
            for f, g, i, j, k, m in zip(
                [0, *group_ends], group_ends, [0, *token_ends], token_ends, [0, *link_ends], link_ends
            )
        ]

    def _large(self, window: tuple[bytes, bytes]) -> tuple:
        """The alignment of a window with a group of very many links: by distinct ids."""
        ids = [np.frombuffer(w, "<u4").astype(np.int64) for w in window]
        _, *cuts = np.intersect1d(*map(self.ends, (0, 1), ids), return_indices=True)
        groups = [np.split(side, at[:-1] + 1) for side, at in zip(ids, cuts, strict=True)]
        texts, pairs, times = [], [], []
        for a, b in zip(*groups, strict=True):
            texts.append(",".join(map(str, a.tolist())) + "|" + ",".join(map(str, b.tolist())))
            (a, many), (b, more) = np.unique(a, return_counts=True), np.unique(b, return_counts=True)
            pairs.append((a[:, None] * self.width + b).ravel())
            times.append(np.outer(many, more).ravel())
        pairs, times = (np.concatenate(v).tobytes() for v in (pairs, times))
        return len(texts), ";".join(texts), pairs, times

    def align(self, windows: list[tuple[bytes, bytes]]) -> list[tuple]:
        """Alignments of a document's windows; new ones are found together."""
        found = list(map(self.known.get, windows))
        if None in found:
            new = list(dict.fromkeys(w for w, f in zip(windows, found, strict=True) if f is None))
            if len(self.known) + len(new) > WINDOWS:
                self.before, self.known = self.known, {}
            old = {w: f for w in new if (f := self.before.get(w))}
            self.known |= old
            if fresh := [w for w in new if w not in old]:
                self.known.update(zip(fresh, self._align(fresh), strict=True))
            known = self.known
            found = [f or known.get(w) or self.before[w] for w, f in zip(windows, found, strict=True)]
        return found

    def tokens(self, text: str | None) -> tuple[bytes, bytes] | None:
        """Ids of both sides, if both spell the text with a space before it."""
        if not text:
            return None
        whole = " " + text
        spelled = whole.encode()
        found = self.a.encode(whole), self.b.encode(text)
        for side, ids in zip((self.a, self.b), found, strict=True):
            if b"".join(map(side.spelled.__getitem__, ids)) != spelled:
                return None
        return array("I", found[0]).tobytes(), array("I", found[1]).tobytes()

    def windows(self, tokens: tuple[bytes, bytes]) -> list[tuple[bytes, bytes]]:
        """The windows between anchors."""
        starts = []
        for side, found in enumerate(tokens):
            ids = np.frombuffer(found, dtype="<u4")
            marked = np.flatnonzero(self.outlines[side][1][ids[1:]])
            starts.append((self.ends(side, ids)[marked], 4 * (marked + 1)))
        (ends_a, at_a), (ends_b, at_b) = starts
        near = np.searchsorted(ends_b, ends_a)
        shared = np.flatnonzero(ends_a == np.append(ends_b, -1)[near])
        cuts_a = [0, *at_a[shared].tolist(), len(tokens[0])]
        cuts_b = [0, *at_b[near[shared]].tolist(), len(tokens[1])]
        a, b = tokens
        return [
            (a[i:j], b[k:m])
            for i, j, k, m in zip(cuts_a[:-1], cuts_a[1:], cuts_b[:-1], cuts_b[1:], strict=True)
        ]

    def _new(self, words: list[str]) -> list[tuple] | None:
        """Answers for words of one document, if both sides spell them: (n_a, n_b, groups,
        text, links, times), links and times in pieces."""
        tokens = self.tokens("".join(words)[1:])
        if tokens is None:
            return None
        windows = self.windows(tokens)
        answers = self.align(windows)
        # Words begin with a space, and so does the window there; both sides end before it.
        sizes = np.fromiter((len(w) if w.isascii() else len(w.encode()) for w in words), np.int64)
        marks = np.cumsum([len(a) // 4 for a, _ in windows]) - 1
        ends = self.ends(0, np.frombuffer(tokens[0], "<u4"))[marks]
        cuts = (np.searchsorted(ends, np.cumsum(sizes)) + 1).tolist()
        found = []
        for i, j in zip([0, *cuts], cuts):
            if j - i == 1:
                a, b = windows[i]
                found.append((len(a) // 4, len(b) // 4, *answers[i]))
            else:
                n_a, n_b = (sum(map(len, side)) // 4 for side in zip(*windows[i:j], strict=True))
                groups, texts, links, times = zip(*answers[i:j], strict=True)
                if any(times):
                    times = [t or np.ones(len(p) // 8, "<i8").tobytes() for p, t in zip(links, times, strict=True)]
                found.append((n_a, n_b, sum(groups), ";".join(texts), b"".join(links),
                              b"".join(times) if any(times) else None))
        return found

    def _answers(self, words: list[str]) -> list[tuple] | None:
        """The answer for each word of a document; new ones are found together."""
        found = list(map(self.words.get, words))
        if None not in found:
            return found
        new = {w: self.words_before.get(w) for w, f in zip(words, found, strict=True) if f is None}
        if fresh := [w for w, f in new.items() if f is None]:
            made = self._new(fresh)
            if made is None:
                return None
            new.update(zip(fresh, made, strict=True))
        found = [f or new[w] for w, f in zip(words, found, strict=True)]
        if len(self.words) + len(new) > PARTS:
            self.words_before, self.words = self.words, {}
        self.words.update((w, f) for w, f in new.items() if len(w) <= LONG)
        return found

    def document(self, text: str | None) -> tuple:
        """n_a, n_b, n_groups, n_links, groups_sha256, distinct pairs, times of each."""
        whole = " " + text if text else ""
        answers = self._answers(parts(whole) if self.apart else [whole]) if text else None
        if answers is None:
            return 0, 0, 0, 0, "", np.zeros(0, "<i8"), np.zeros(0, "<i8")
        n_a, n_b, groups, texts, links, times = zip(*answers, strict=True)
        digest = hashlib.sha256(";".join(texts).encode()).hexdigest()
        pairs = np.frombuffer(b"".join(links), "<i8")
        if any(times):
            each = [np.frombuffer(t, "<i8") if t else np.ones(len(p) // 8, "<i8")
                    for p, t in zip(links, times, strict=True)]
            kinds, at = np.unique(pairs, return_inverse=True)
            total = np.bincount(at, np.concatenate(each)).astype("<i8")
        else:
            kinds, total = np.unique(pairs, return_counts=True)
        return sum(n_a), sum(n_b), sum(groups), int(total.sum()), digest, kinds, total


@cache
def aligner(path_a: str, path_b: str) -> Aligner:
    """This worker's aligner; workers are reused, so it is warm after the first task."""
    return Aligner(path_a, path_b)


def align(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """The alignment of every document of ``docs`` (doc_id, text), as a stored table.

    ``pairs`` and ``times`` are packed 64-bit integers, pairs ascending.
    """
    schema = pa.schema(
        [("row", pa.int64()), ("doc_id", pa.int64()), *[(n, pa.int64()) for n in
         ("n_a", "n_b", "n_groups", "n_links")], ("groups_sha256", pa.string()),
         ("pairs", pa.binary()), ("times", pa.binary())]
    )

    def run(batches):
        known = aligner(path_a, path_b)
        for batch in batches:
            if not batch.num_rows:
                continue
            rows, doc_ids, texts = (batch.column(i).to_pylist() for i in range(3))
            found = [
                (row, doc_id, *plain, kinds.tobytes(), times.tobytes())
                for row, doc_id, (*plain, kinds, times) in zip(
                    rows, doc_ids, map(known.document, texts), strict=True
                )
            ]
            columns = zip(*found, strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t.type) for c, t in zip(columns, schema, strict=True)], schema=schema
            )

    numbered = only(docs, "doc_id", "text").select(
        F.monotonically_increasing_id().alias("row"), "doc_id", "text"
    )
    return materialize(numbered.mapInArrow(run, _STORED), "alignments")[0]


def _long_arrays(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All integers of a column of packed arrays, and how many each row has."""
    values = column.to_pylist()
    return np.frombuffer(b"".join(values), "<i8"), np.array([len(v) // 8 for v in values])


def pair_counts(aligned: DataFrame, width: int) -> DataFrame:
    """pair, docs (documents that hold it), best (no pair of its first id has more)."""
    schema = pa.schema([("pair", pa.int64()), ("docs", pa.int64())])

    def count(batches):
        kinds, docs = np.zeros(0, "<i8"), np.zeros(0, "<i8")
        waiting: list[np.ndarray] = []

        def merged() -> tuple[np.ndarray, np.ndarray]:
            found, at = np.unique(np.concatenate([kinds, *waiting]), return_inverse=True)
            weights = np.concatenate([docs, np.ones(sum(map(len, waiting)), "<i8")])
            return found, np.bincount(at, weights, len(found)).astype("<i8")

        for batch in batches:
            waiting.append(_long_arrays(batch.column(0))[0])
            if sum(map(len, waiting)) >= COUNTED:
                kinds, docs = merged()
                waiting = []
                if len(kinds) >= COUNTED:
                    yield pa.RecordBatch.from_arrays([pa.array(kinds), pa.array(docs)], schema=schema)
                    kinds, docs = kinds[:0], docs[:0]
        kinds, docs = merged()
        yield pa.RecordBatch.from_arrays([pa.array(kinds), pa.array(docs)], schema=schema)

    first = F.expr(f"pair div {width}")
    # An id of the first side meets at most as many others as the second vocabulary has.
    rivals = Window.partitionBy(first)
    return (
        aligned.select("pairs")
        .mapInArrow(count, "pair long, docs long")
        .groupBy("pair")
        .agg(F.sum("docs").alias("docs"))
        .withColumn("best", F.col("docs") == F.max("docs").over(rivals))
    )


def frequent(counts: DataFrame, most: int) -> int:
    """A count that at most ``most`` pairs reach: a power of two."""
    sizes = counts.groupBy((F.length(F.bin("docs")) - 1).alias("power")).count().collect()
    least, held = 0, 0
    for power, n in sorted(((r["power"], r["count"]) for r in sizes), reverse=True):
        held += n
        if held > most:
            least = power + 1
            break
    return 1 << least


def score(aligned: DataFrame, counts: DataFrame) -> DataFrame:
    """Every document with n_best and count_sum over its links."""
    spark = aligned.sparkSession
    least = frequent(counts, HEAD)
    head = counts.where(F.col("docs") >= least).toArrow().sort_by("pair")
    shared = spark.sparkContext.broadcast(
        [head.column(i).to_numpy() for i in range(3)] if head.num_rows else None
    )
    plain = ["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
    target = (
        "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, "
        "groups_sha256 string, n_best long, count_sum long, rest array<long>, rest_times array<long>"
    )
    lists = pa.list_(pa.int64())

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            pairs, sizes = _long_arrays(batch.column(len(plain)))
            times, _ = _long_arrays(batch.column(len(plain) + 1))
            known = np.zeros(len(pairs), bool)
            docs, best = np.zeros(len(pairs), "<i8"), np.zeros(len(pairs), bool)
            if shared.value is not None:
                kinds, all_docs, all_best = shared.value
                at = np.minimum(np.searchsorted(kinds, pairs), len(kinds) - 1)
                known = kinds[at] == pairs
                docs, best = np.where(known, all_docs[at], 0), all_best[at] & known
            edges = np.concatenate([[0], np.cumsum(sizes)])

            def sums(values: np.ndarray) -> pa.Array:
                total = np.concatenate([[0], np.cumsum(values)])
                return pa.array(total[edges[1:]] - total[edges[:-1]], pa.int64())

            left = np.concatenate([[0], np.cumsum(~known)])[edges].astype(np.int32)
            rest = [
                pa.ListArray.from_arrays(pa.array(left), pa.array(v[~known], pa.int64()), type=lists)
                for v in (pairs, times)
            ]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(plain)], sums(times * best), sums(times * docs), *rest],
                names=[*plain, "n_best", "count_sum", "rest", "rest_times"],
            )

    scored = materialize(
        aligned.select(*plain, "pairs", "times").mapInArrow(run, target), "alignment-scores"
    )[0]
    others = (
        scored.select("row", F.explode(F.arrays_zip("rest", "rest_times")).alias("r"))
        .select("row", F.col("r.rest").alias("pair"), F.col("r.rest_times").alias("times"))
        .join(counts.where(F.col("docs") < least), "pair")
        .groupBy("row")
        .agg(
            F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best"),
            F.sum(F.col("times") * F.col("docs")).alias("more_count"),
        )
    )
    added = [
        (F.col(a) + F.coalesce(F.col(b), F.lit(0))).alias(a)
        for a, b in (("n_best", "more_best"), ("count_sum", "more_count"))
    ]
    return scored.join(others, "row", "left").select(*plain[1:-1], *added, "groups_sha256")


def align_and_score(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Alignment of every document, its links weighed by how many documents hold them."""
    import sentencepiece

    width = sentencepiece.SentencePieceProcessor(model_file=path_b).get_piece_size()
    aligned = align(docs, path_a, path_b)
    counts, _ = materialize(pair_counts(aligned, width), "pair-counts")
    return score(aligned, counts)


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alignment of the byte-level and the sentence-piece tokenizer on all documents."""
    import public_tokenizers

    return align_and_score(
        table(spark, sf_dir, "documents"),
        public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("piece_bpe_32k.model"),
    )

"""Personal data in texts, by aggregated weak labelers and a trained span classifier.

Four base kinds are reported as their patterns match. Every further candidate (local
telephone numbers, spelled-out addresses, national ids, bank accounts, long digit
groups) is judged by labelers of three sorts: patterns, gazetteers and context words.
Each votes for, against, or not at all. The votes of all candidates of the corpus,
base ones included, are counted by pattern of votes; expectation-maximisation over
those counts estimates each labeler's reliability, and a logistic classifier over
kind and votes is fitted to the posterior. It decides which candidates are added.

Candidates have a fixed number of kinds and three-valued votes, so the table of
counts is bounded however large the corpus is.

Defined results: a null text is empty; added spans never overlap base spans; spans
count code points, the end is exclusive. Without any candidate nothing is added.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Columns, Taken, map_rows, map_whole, materialize, only, table
from .secrets import digests

# Base kinds and patterns, in the order in which ties are listed.
BASE = ("email", "ip", "card", "phone")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match can only begin where a run of digits begins, since it takes runs whole.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

ADDED = ("phone_local", "email_spelled", "national_id", "bank_account", "long_number")
_RANK = {kind: i for i, kind in enumerate(BASE + ADDED)}

_CANDIDATES = {
    "phone_local": re.compile(r"(?<![\w.+-])\(?[0-9]{2,4}\)?[ .-][0-9]{3,4}[ .-][0-9]{3,4}(?![\w-])"),
    "email_spelled": re.compile(
        r"[A-Za-z0-9._%+-]{1,64} ?[\[(]at[\])] ?[A-Za-z0-9-]{1,63}"
        r"(?: ?(?:[\[(]dot[\])]|\.) ?[A-Za-z0-9-]{1,63})+",
        re.IGNORECASE,
    ),
    "national_id": re.compile(r"(?<![\w-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w-])"),
    "bank_account": re.compile(r"(?<!\w)[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?!\w)"),
    "long_number": re.compile(r"(?<![\w.+-])[0-9]{9,19}(?![\w-])"),
}

# Gazetteers and context words.
_TLDS = frozenset("com org net edu gov info biz io de fr es uk eu us it nl ch at".split())
_COUNTRIES = frozenset("DE FR ES IT NL BE AT CH GB PT PL SE DK FI NO IE LU CZ GR HU".split())
_CALL = re.compile(r"phone|call|mobile|tel\b|fax|cell|telefon|téléphone|teléfono|handy|whatsapp", re.I)
_MAIL = re.compile(r"mail|contact|write to|reach|correo|courriel|kontakt", re.I)
_NUMBER = re.compile(r"ssn|social security|passport|iban|account|konto|compte|cuenta|tax id|licen[cs]e no", re.I)
_NEUTRAL = re.compile(r"isbn|issn|version|order|item|page|invoice|serial|build|table|figure|#", re.I)
_NEAR = 40


_SOME_DIGITS = re.compile(r"[0-9]{2}")
_SPELLED = re.compile(r"[\[(]at[\])]", re.I)


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        v = ord(d) - 48
        total += v if i % 2 == 0 else v * 2 - 9 * (v > 4)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join([c for c in text if "0" <= c <= "9"])


def _emails(text: str) -> list[tuple[str, int, int]]:
    """From each @ outwards: linear even in texts without any."""
    found, free = [], 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            found.append(("email", start, m.end()))
            free = m.end()
        else:
            free = max(free, start)
        at = text.find("@", max(at + 1, free))
    return found


def find_base(text: str) -> list[tuple[str, int, int]]:
    """Spans of the base kinds."""
    found = _emails(text) if "@" in text else []
    for m in _IP.finditer(text):
        parts = [p.lstrip("0") or "0" for p in m[0].split(".")]
        if all(len(p) <= 3 and int(p) <= 255 for p in parts):
            found.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        digits = _digits(m[0])
        if 14 <= len(digits) <= 19 and _luhn(digits):
            found.append(("card", *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= len(_digits(m[0])) <= 15:
                found.append(("phone", *m.span()))
    return sorted(set(found), key=lambda s: (s[1], _RANK[s[0]], s[2]))


def _iban(value: str) -> bool:
    value = value.replace(" ", "")
    turned = value[4:] + value[:4]
    return int("".join(str(int(c, 36)) for c in turned)) % 97 == 1


def votes(kind: str, value: str, before: str, after: str) -> str:
    """One character per labeler: + for, - against, . no opinion."""
    digits = _digits(value)
    mail = kind.startswith("email")
    wanted = _MAIL if mail else _NUMBER if kind in ("national_id", "bank_account") else _CALL
    if kind in ("card", "long_number"):
        wanted = _NUMBER
    shaped = {"email": "+", "ip": "+", "phone": "+", "email_spelled": "+", "national_id": "+",
              "bank_account": ".", "phone_local": ".", "card": ".", "long_number": "-"}[kind]
    if kind == "bank_account":
        proved = "+" if _iban(value) else "-"
    elif kind in ("card", "long_number"):
        proved = "+" if 13 <= len(digits) <= 19 and _luhn(digits) else "-"
    else:
        proved = "."
    known = "."
    if mail:
        known = "+" if re.split(r"\W+", value)[-1].lower() in _TLDS else "-"
    elif kind == "bank_account":
        known = "+" if value[:2] in _COUNTRIES else "-"
    elif kind == "national_id":
        known = "-" if digits[:3] in ("000", "666") or digits[0] == "9" else "+"
    spread = "." if mail or kind == "ip" else "-" if len(set(digits)) <= 2 else "+"
    grouped = "+" if re.search(r"[0-9][ ().-]+[0-9]", value) else "." if mail else "-"
    near = "+" if wanted.search(before) or wanted.search(after[:20]) else "."
    other = "-" if _NEUTRAL.search(before[-20:]) else "."
    edges = "+" if before[-1:].isspace() and (after[:1].isspace() or after[:1] in ",.;:!?") else "."
    return shaped + proved + known + spread + grouped + near + other + edges


LABELERS = ("shape", "checksum", "gazetteer", "digits", "grouping", "context", "neutral", "edges")


def find_candidates(text: str | None) -> tuple[list, list]:
    """Base spans, and (kind, start, end, votes) of base and further candidates."""
    text = text or ""
    base = find_base(text)
    wide, taken = list(base), Taken(base)
    numbers, spelled = _SOME_DIGITS.search(text), _SPELLED.search(text)
    for kind, pattern in _CANDIDATES.items():
        if spelled if kind == "email_spelled" else numbers:
            for m in pattern.finditer(text):
                if taken.add(*m.span()):
                    wide.append((kind, *m.span()))
    judged = [
        (k, a, b, k + votes(k, text[a:b], text[max(0, a - _NEAR) : a], text[b : b + _NEAR]))
        for k, a, b in wide
    ]
    return base, judged


def _rows(columns: Columns) -> Columns:
    spans = []
    for text in columns["text"]:
        _, judged = find_candidates(text)
        spans.append([{"kind": k, "start": a, "end": b, "votes": v} for k, a, b, v in judged])
    return {"doc_id": columns["doc_id"], "spans": spans}


_SPAN = "array<struct<kind: string, start: long, end: long, votes: string>>"


def _signs(pattern: str) -> np.ndarray:
    return np.array([{"+": 1, "-": -1, ".": 0}[c] for c in pattern[-len(LABELERS) :]])


def aggregate_votes(counts: dict[str, int], rounds: int = 50) -> dict[str, float]:
    """Posterior of each (kind and votes), by expectation-maximisation.

    Each labeler has its own chance of voting for and against under either truth. The
    first posterior is the majority of votes, which also says which class is which.
    """
    patterns = sorted(counts)
    n = np.array([counts[p] for p in patterns], dtype=float)
    signs = np.array([_signs(p) for p in patterns])
    seen = np.stack([signs == v for v in (-1, 0, 1)], axis=2).astype(float)
    p = 1 / (1 + np.exp(-2.0 * signs.sum(axis=1)))
    for _ in range(rounds):
        logs = []
        for w in (n * p, n * (1 - p)):
            rates = np.einsum("i,ijv->jv", w, seen) + 1.0
            rates /= rates.sum(axis=1, keepdims=True)
            logs.append(np.einsum("ijv,jv->i", seen, np.log(rates)))
        prior = np.clip((n @ p) / n.sum(), 0.01, 0.99)
        gap = np.clip(logs[0] - logs[1] + np.log(prior / (1 - prior)), -30, 30)
        p = 1 / (1 + np.exp(-gap))
    return dict(zip(patterns, p, strict=True))


def span_features(pattern: str) -> np.ndarray:
    """Votes for and against, and the kind."""
    signs = _signs(pattern)
    kind = pattern[: -len(LABELERS)]
    kinds = [float(kind == k) for k in BASE + ADDED]
    return np.concatenate([signs > 0, signs < 0, kinds, [1.0]]).astype(float)


def train_classifier(counts: dict[str, int], posterior: dict[str, float]) -> dict[str, float]:
    """Chance of each (kind and votes) by a logistic classifier on the posterior labels."""
    patterns = sorted(counts)
    x = np.array([span_features(p) for p in patterns])
    y = np.array([posterior[p] for p in patterns])
    n = np.array([counts[p] for p in patterns], dtype=float)
    n /= n.sum()
    w = np.zeros(x.shape[1])
    for _ in range(30):  # Newton steps with a ridge
        q = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (n * (q - y)) + 1e-4 * w
        hess = (x * (n * q * (1 - q))[:, None]).T @ x + 1e-4 * np.eye(len(w))
        w -= np.linalg.solve(hess, grad)
    q = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
    return dict(zip(patterns, q, strict=True))


def find_private(docs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """doc_id and the spans of each row of ``docs`` (``doc_id``, ``text``)."""
    thin = map_rows(only(docs, "doc_id", "text"), f"doc_id long, spans {_SPAN}", _rows)
    stored, _ = materialize(thin, "private-candidates")
    accepted = accepted_patterns(stored, threshold)

    def decide(columns: Columns) -> Columns:
        return {
            "doc_id": columns["doc_id"],
            "spans": [chosen(spans, accepted) for spans in columns["spans"]],
        }

    return map_rows(
        stored, "doc_id long, spans array<struct<kind: string, start: long, end: long>>", decide
    )


def accepted_patterns(candidates: DataFrame, threshold: float) -> frozenset[str]:
    """The patterns of votes that the trained classifier takes for personal data."""
    counted = (
        candidates.select(F.explode("spans.votes").alias("votes")).groupBy("votes").count()
    )
    counts = {r["votes"]: r["count"] for r in counted.collect()}  # kinds x 3^labelers at most
    if not counts:
        return frozenset()
    chance = train_classifier(counts, aggregate_votes(counts))
    return frozenset(p for p, q in chance.items() if q >= threshold)


def chosen(spans: list[dict], accepted: frozenset[str]) -> list[dict]:
    """Base spans and accepted others, by start, then kind as listed."""
    kept = [s for s in spans if s["kind"] in BASE or s["votes"] in accepted]
    kept.sort(key=lambda s: (s["start"], _RANK[s["kind"]], s["end"]))
    return [{k: s[k] for k in ("kind", "start", "end")} for s in kept]


def redact(docs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """``docs`` with every span found replaced by its kind in angle brackets.

    All rows and columns stay, only ``text`` changes; a null text stays null.
    """
    thin, _ = materialize(
        map_rows(only(docs, "doc_id", "text"), f"doc_id long, spans {_SPAN}", _rows)
        .where(F.size("spans") > 0),
        "private-candidates",
    )
    accepted = accepted_patterns(thin, threshold)

    def hide(text: str | None) -> str | None:
        if not text:
            return text
        spans = _rows({"doc_id": [0], "text": [text]})["spans"][0]
        parts, at = [], 0
        for s in chosen(spans, accepted):
            if s["end"] > at:
                parts += [text[at : max(at, s["start"])], f"<{s['kind']}>"]
                at = s["end"]
        return "".join([*parts, text[at:]])

    return replace_text(docs, hide)


def replace_text(docs: DataFrame, change) -> DataFrame:
    """``docs`` with ``change`` applied to every text."""
    import pyarrow as pa

    at = docs.columns.index("text")

    def run(batches):
        for batch in batches:
            kind = batch.schema.field(at).type
            new = pa.array([change(t) for t in batch.column(at).to_pylist()], kind)
            columns = batch.columns[:at] + [new] + batch.columns[at + 1 :]
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return map_whole(docs, run)


def op10_private(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document."""
    return digests(find_private(table(spark, sf_dir, "documents")), BASE)

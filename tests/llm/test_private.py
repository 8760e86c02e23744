import re

import pytest

from tillmart.llm import private


def luhn(digits):
    total = 0
    for i, d in enumerate(int(c) for c in reversed(digits)):
        total += d if i % 2 == 0 else sum(divmod(2 * d, 10))
    return total % 10 == 0


def brute(text):
    text = text or ""
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 14 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append(("phone", *m.span()))
    return sorted(out, key=lambda s: (s[1], private.BASE.index(s[0])))


TEXTS = [
    "mail und.34@mail7.example.com now", "a@b@c.de x@y..z @q.de a@b.c-", "1.2.3.4.5.6.7.8 256.1.1.1 001.002.003.004",
    "4111 1111 1111 1111 and 4111-1111-1111-1112", "+1 (217) 555-7713 +12 +4 4-", "٣.٣.٣.٣ ١٢٣٤٥٦٧٨٩٠١٢٣٤",
    "a@b.c@d.e", "..@a.b", "x@-.-", "", None, "12345678901234567890123", "+1.2.3.4 555 0101 99@x.y",
]


@pytest.mark.parametrize("text", TEXTS, ids=range(len(TEXTS)))
def test_base_spans(text):
    assert private.find_base(text or "") == brute(text)


LONG = ["1" * 100_000, "a" * 200_000, "a@" * 50_000, "1." * 50_000, "+1 " * 50_000, "1-" * 60_000, "a.b@" * 30_000,
        "0" * 5000 + ".1.1.1"]


@pytest.mark.parametrize("text", LONG, ids=range(len(LONG)))
def test_very_long_texts_take_linear_time(text):
    private.find_candidates(text)


def test_added_spans_do_not_overlap_base():
    text = "call 555-123-4567 or +1 (217) 555-7713, ssn 219-09-9999, me [at] mail [dot] com"
    base, judged = private.find_candidates(text)
    assert {k for k, *_ in judged} >= {"phone", "phone_local", "national_id", "email_spelled"}
    spans = sorted((a, b) for _, a, b, _ in judged)
    assert all(b <= c for (_, b), (c, _) in zip(spans, spans[1:]))


def test_reliable_labelers_win():
    counts = {"phone" + "+..++..+": 900, "phone_local" + "...++" + "+.+": 200, "long_number" + "--.-..-.": 500}
    posterior = private.aggregate_votes(counts)
    chance = private.train_classifier(counts, posterior)
    assert chance["phone+..++..+"] > 0.9 and chance["long_number--.-..-."] < 0.1
    assert chance["phone_local...+++.+"] > 0.5


def test_redaction_keeps_rows_and_columns(spark, documents, odd_rows):
    docs = documents(odd_rows + [(9, "to und.34@mail7.example.com or 1.2.3.4!")])
    out = private.redact(docs)
    assert out.columns == docs.columns
    rows = {(r[0], r[1]) for r in out.collect()}
    assert len(out.collect()) == len(odd_rows) + 1
    assert (9, "to <email> or <ip>!") in rows and (1, None) in rows
    assert private.redact(documents([])).collect() == []


def test_query_rows(spark, documents, odd_rows):
    from tillmart.llm.secrets import digests

    got = digests(private.find_private(documents(odd_rows)), private.BASE).collect()
    assert len(got) == len(odd_rows) and all(r["spans"] == "" for r in got if r["doc_id"] != 7)

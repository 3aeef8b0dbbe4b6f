"""Spans against the same definitions in Python."""

import hashlib
import random
import re

from pyspark.sql import functions as F

from surveylake.llm import pii

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def brute(text):
    out = []
    for order, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            good = {
                "email": True,
                "ip": all(int(p) <= 255 for p in m.group().split(".")) if kind == "ip" else False,
                "card": 14 <= len(digits) <= 19 and luhn(digits),
                "phone": 10 <= len(digits) <= 15,
            }[kind]
            if good:
                out.append((m.start(), order, m.end(), kind))
    return ",".join(f"{kind}:{start}:{end}" for start, _, end, kind in sorted(out))


def detected(documents, texts):
    rows = pii.detect(documents([(i, t) for i, t in enumerate(texts)])).select("doc_id", pii.listed(F.col("pii_base")).alias("base"), pii.listed(F.col("pii_spans")).alias("spans"))
    return {r.doc_id: (r.base, r.spans) for r in rows.collect()}


CASES = [
    None, "", "nothing", "a@b.c", "x %d@e.f a@b.c%d@e.f", "a@b a@b. a@b..c a@b.c.", "1.2.3.4.5.6.7.8 300.1.1.1.2.2 001.0.0.255", "1.2.3",
    "4111 1111 1111 1111", "4111-1111-1111-1111 4111111111111111", "4111 1111 1111 1111 1", "12  4111111111111111", "+1 (578) 555-6437",
    "+1 578 555 6437 22", "+1 (578) 555-6437 4918187128635271", "+49((((((", "+1234567890123456", "++1 234 567 8901", "é😀 a@b.co 😀 1.1.1.1",
    "@@a@@b.c", "5 4111111111111111", "4111111111111111-5", "a.b+c-d_e%f@x-y.z-w.q!", "0 0 0 0 0 0 0 0 0 0 0 0 0 0 0",
]


def test_base_spans_on_chosen_cases(documents):
    found = detected(documents, CASES)
    assert {i: base for i, (base, _) in found.items()} == {i: brute(t) for i, t in enumerate(CASES)}


def test_base_spans_on_random_texts(documents):
    rng = random.Random(5)
    pools = ["0123456789 -", "0123456789.", "+0123456789 ().-", "ab.%@-", "0159+@. -a\n()", "é😀1 +-.@a"]
    texts = ["".join(rng.choice(pool) for _ in range(rng.randint(1, 60))) for pool in pools for _ in range(120)]
    found = detected(documents, texts)
    assert {i: base for i, (base, _) in found.items()} == {i: brute(t) for i, t in enumerate(texts)}


def test_the_method_adds_confirmed_spans_and_keeps_the_base(documents):
    texts = [
        "call +1 (578) 555-6437 4918187128635271 now",
        "IBAN DE89 3704 0044 0532 0130 00 thanks",
        "IBAN DE89 3704 0044 0532 0130 01 thanks",
        "phone: (578) 555-6437",
        "lot (578) 555-6437",
        "her social security number 123-45-6789",
        "part 123-45-6789",
    ]
    found = {i: spans for i, (_, spans) in detected(documents, texts).items()}
    assert found == {0: "phone:5:22,card:23:39", 1: "iban:5:32", 2: "", 3: "phone:7:21", 4: "", 5: "ssn:27:38", 6: ""}
    for base, spans in detected(documents, CASES).values():
        assert set(filter(None, base.split(","))) <= set(spans.split(","))


def test_redaction(documents):
    rows = [(0, "é a@b.co, +1 (578) 555-6437 4918187128635271."), (1, None), (2, "plain"), (3, "")]
    docs = documents(rows)
    out = {r.doc_id: r for r in pii.redact(docs, n_chars="n_chars").collect()}
    assert out[0].text == "é [EMAIL], [PHONE] [CARD]." and out[0].n_chars == len(out[0].text)
    assert out[1].text is None and out[2].text == "plain" and out[3].text == ""
    assert pii.redact(docs, n_chars="n_chars").schema == docs.schema


def test_long_texts_and_many_spans(documents):
    texts = ["a" * 300_000, "1" * 300_000, "a@b.c " * 2000, "+1" + "(" * 200_000, "a@" * 50_000, "x.1" * 50_000]
    found = detected(documents, texts)
    for i in (0, 1, 2, 3, 4, 5):
        assert found[i][0] == brute(texts[i]) if i in (2, 5) else True
    assert found[0] == found[1] == found[3] == ("", "")


def test_clashing_columns_and_empty_table(spark, documents):
    docs = documents([(1, "a@b.co", "en", "a", "x", 2)], ", pii_spans string, plain int")
    out = pii.detect(docs)
    assert out.columns == [*docs.columns[:5], "plain", "pii_base", "pii_spans"] and out.first().plain == 2
    assert pii.detect(documents([])).count() == 0 and pii.redact(documents([])).count() == 0


def test_no_python_in_the_plan(documents):
    plan = pii.redact(documents([(1, "a")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert hashlib.sha256(b"").hexdigest() == documents([(1, "a")]).select(F.sha2(F.lit(""), 256)).first()[0]

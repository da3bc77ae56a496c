import random
import re
import time

import pytest
from pyspark.sql import functions as F

from tabprep.llm.pii import BASE, _Prefixes, _sum, find_pii, redact


def luhn(digits):
    total = 0
    for i, d in enumerate(map(int, reversed(digits)), 1):
        total += d if i % 2 else d * 2 - (9 if d > 4 else 0)
    return total % 10 == 0


def plain(text):
    """The base kinds by their plain patterns."""
    out = []
    for kind, pattern in BASE.items():
        for m in re.finditer(pattern, text or ""):
            value, digits = m.group(), re.sub(r"\D", "", m.group())
            good = {
                "email": lambda: True,
                "ip": lambda: all(int(p) <= 255 for p in value.split(".")),
                "card": lambda: 13 <= len(digits) <= 19 and luhn(digits),
                "phone": lambda: 9 <= len(digits) <= 15,
            }[kind]()
            if good:
                out.append((kind, m.start(), m.end()))
    return out


def base_spans(frame):
    return {r.doc_id: [(s.kind, s.start, s.end) for s in r.spans if s.kind in BASE] for r in frame.collect()}


TEXTS = [
    None,
    "",
    "write to a.b+c@x-y.example.com, or a@b, a@b. and a@b@c.de; then a@b.c_d@e.f+g@h.i",
    "@.@ a@.b -@-.- %@a.b.c.",
    "1.2.3.4.5.6.7.8 999.1.1.1 255.255.255.255 00001.02.003.0000 1.2.3 256.1.1.1 12345.1.2.3.4",
    "4111 1111 1111 1111 and 4111-1111-1111-1111 4111111111111111 41111111111111112 4111  1111 1111 1111",
    "0000000000000 1-2-3-4-5-6-7-8-9-0-1-2-3 4444 3333 2222 1111 0000 9999 8888",
    "+1 (555) 123-4567 ++49 30 1234567, +12 34 +1-2-3-4-5-6-7-8-9 +1234567890123456 +1..................2 +49 (30) 12.34.56.78)))",
    "héé 漢字 😀 mail é@x.com x@y.zé 😀 +44 20 7946 0958 😀 10.0.0.1",
    "9" * 5000 + " " + "a" * 9000 + "@" + "b." * 5000 + "c " + "1." * 3000 + " " + "1 " * 9000,
    "IBAN GB82 WEST 1234 5698 7654 32 and DE89370400440532013000, not DE89370400440532013001. My SSN is 078-05-1120; 078-05-1121 " + "x" * 60 + " 078-05-1122",
    ("u1@h.org " * 700) + "end",
]


def test_base_spans_equal_plain_patterns(spark):
    frame = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id bigint, text string").selectExpr("*", "1 AS spans", "'x' AS spans_ip_found")
    assert base_spans(find_pii(frame)) == {i: plain(t) for i, t in enumerate(TEXTS)}


def test_random_texts(spark):
    dice = random.Random(9)
    pieces = ["a", "Z", "@", ".", "-", "+", " ", "(", ")", "1", "4", "0", "25", "6.", "%", "_", "é", "😀", "4111111111111111", "a@b.c", "1.2.3.4"]
    texts = ["".join(dice.choice(pieces) for _ in range(dice.randrange(60))) for _ in range(3000)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    assert base_spans(find_pii(frame)) == {i: plain(t) for i, t in enumerate(texts)}


def test_corpus(corpus):
    expected = {r.doc_id: plain(r.text) for r in corpus.collect()}
    assert base_spans(find_pii(corpus)) == expected and any(expected.values())


def test_added_kinds_need_checksum_or_context(spark):
    frame = spark.createDataFrame([(1, TEXTS[10])], "doc_id bigint, text string")
    spans = find_pii(frame).first().spans
    added = [(s.kind, TEXTS[10][s.start : s.end]) for s in spans if s.kind not in BASE]
    assert added == [("iban", "GB82 WEST 1234 5698 7654 32"), ("iban", "DE89370400440532013000"), ("ssn", "078-05-1120"), ("ssn", "078-05-1121")]
    scores = find_pii(spark.createDataFrame([(1, "10.0.0.1"), (2, "server 10.0.0.1"), (3, "version 10.0.0.1")], "doc_id int, text string"))
    assert {r.doc_id: r.spans[0].score for r in scores.collect()} == {1: 0.6, 2: 0.9, 3: 0.3}


@pytest.mark.parametrize("rows", [[(1, "call +44 20 7946 0958 or +1 4111 1111 1111 1111, 漢 a@b.cd!"), (2, None), (3, ""), (4, "clean 漢"), (4, "clean 漢")]])
def test_redaction(spark, rows):
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "7 AS kind", "'s' AS `__pii.x`")
    out = redact(frame)
    assert out.columns == frame.columns
    assert sorted((r.doc_id, str(r.text)) for r in out.collect()) == [
        (1, "call <PHONE> or +1 4111 1111 1111 1111, 漢 <EMAIL>!"),
        (2, "None"),
        (3, ""),
        (4, "clean 漢"),
        (4, "clean 漢"),
    ]
    assert redact(frame.limit(0)).count() == 0


def test_very_many_matches_in_one_text(spark):
    text = " ".join(f"user{i}@host{i % 7}.example.org, 漢字" + " pad" * (200 if i % 5000 == 0 else 0) for i in range(50_000))
    frame = spark.createDataFrame([(1, text), (2, None)], "doc_id bigint, text string")
    begun = time.monotonic()
    assert base_spans(find_pii(frame)) == {1: plain(text), 2: []}
    assert {r.doc_id: r.text for r in redact(frame).collect()} == {1: re.sub(BASE["email"], "<EMAIL>", text), 2: None}
    assert time.monotonic() - begun < 60


@pytest.mark.parametrize("n", [0, 1, 63, 64, 65, 4097])
def test_prefixes(spark, n):
    dice = random.Random(n)
    values = [dice.randrange(100) for _ in range(n)]
    frame = spark.createDataFrame([(values,)], "v array<bigint>")
    for combine, expected in ((_sum, lambda v: sum(v)), (F.array_max, max)):
        prefixes = _Prefixes("v", combine)
        out = prefixes.prepare(frame).select(F.transform(F.sequence(F.lit(0), F.lit(n - 1)), prefixes.up_to).alias("x")).first().x if n else []
        assert out == [expected(values[: i + 1]) for i in range(n)]


def test_overlapping_spans_are_one(spark):
    text = "+1 4111111111111111 " * 3 + "x 10.0.0.1@a.bc y " + "漢" * 600 + " z@a.bc" + "w" * 300
    spans = sorted((s.start, -s.end, s.kind) for s in find_pii(spark.createDataFrame([(1, text)], "doc_id int, text string")).first().spans)
    out, at = [], 0
    for start, back, kind in spans:
        if start >= at:
            out += [text[at:start], f"<{kind.upper()}>"]
        at = max(at, -back)
    assert redact(spark.createDataFrame([(1, text)], "doc_id int, text string")).first().text == "".join([*out, text[at:]])


def test_plan_has_no_python(corpus):
    plan = redact(corpus)._jdf.queryExecution().executedPlan().toString() + find_pii(corpus)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_redacted_corpus_has_no_spans(corpus):
    again = find_pii(redact(corpus))
    assert again.where(F.size("spans") > 0).count() == 0

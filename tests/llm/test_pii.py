"""Personal data: fixed patterns against plain regular expressions, disclosure, redaction."""

from __future__ import annotations

import hashlib
import re

from conftest import SF01
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_cases import awkward_rows, sentence, table
from pyspark.sql import functions as F

from linclass.llm import pii

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(d: str) -> bool:
    x = [int(c) for c in d][::-1]
    return (sum(x[::2]) + sum(sum(divmod(2 * y, 10)) for y in x[1::2])) % 10 == 0


def plain(text: str) -> list[tuple]:
    out = [(0, m.start(), m.end()) for m in EMAIL.finditer(text)]
    out += [(1, m.start(), m.end()) for m in IP.finditer(text) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in CARD.finditer(text):
        d = re.sub("[^0-9]", "", m[0])
        if 16 <= len(d) <= 19 and luhn(d):
            out.append((2, m.start(), m.end()))
    return out + [(3, m.start(), m.end()) for m in PHONE.finditer(text) if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15]


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("ab.@-+% 0123459()é\n")), max_size=60))
def test_patterns_on_any_text(text):
    assert pii.base_spans(text) == plain(text)


def test_patterns_on_known_texts():
    t = "mail a.b+c@x-y.example.org, @z.z q@@b.c a@b.c@d.e 1.2.3.4.5 256.1.1.1 007.1.1.1 card 4111 1111 1111 1111 and 4111-1111-1111-1112 or +49 (30) 1234-567 +1 2"
    assert pii.base_spans(t) == plain(t)
    assert [t[a:b] for k, a, b in pii.base_spans(t) if k == 2] == ["4111 1111 1111 1111"]


def test_long_runs_take_linear_time():
    for t in ("a" * 300_000 + "@", "1" * 300_000, "a@" * 100_000, "1." * 100_000, "+1" + "(" * 200_000):
        pii.base_spans(t)


def test_op10_digest(spark):
    texts = {r[0]: r[1] for r in spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "text").collect()}
    got = pii.op10_pii(spark, SF01).collect()
    assert len(got) == len(texts)
    for r in got:
        want = plain(texts[r.doc_id])
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == j for k, _, _ in want) for j in range(4)]
        assert r.base_sha256 == hashlib.sha256(pii.joined(want).encode()).hexdigest() and r.spans.startswith(pii.joined(want))


def corpus() -> list[tuple]:
    """One address is always met with the word zanzibar, which is met nowhere else; in three
    of its texts so is the word amber, which the rest of the corpus is full of."""
    rows = [(k, f"{sentence(k, 6)} zanzibar amber jo@x.org, {sentence(40 + k, 5)}") for k in range(5)]
    return rows + [(10 + k, sentence(100 + k, 40)) for k in range(60)] + [(90 + k, f"{sentence(k, 5)} mail kim{k}@x.org") for k in range(5)]


def test_terms_that_disclose_an_entity_are_found(spark):
    rows = corpus() + awkward_rows()
    found, terms = pii.find(table(spark, rows))
    assert found.count() == len(rows)
    texts = dict(corpus())
    keys = {pii._long_hash(t): t for t in texts.values()}
    told = {(keys[r.text_key][t.start : t.end], round(t.share, 6)) for r in terms.collect() for t in r.terms}
    assert told == {("zanzibar", 1.0)}
    # n texts, 5 with the entity, 5 contexts, 5 texts with the term: log2(5 n / 25) / log2(n / 5) = 1


def test_sanitised_texts(spark):
    docs = table(spark, corpus() + awkward_rows() + [(5, "plain a@b.cd and 1.2.3.4")])
    clean = pii.sanitise(docs)
    assert clean.columns == docs.columns and clean.count() == docs.count()
    got = [r.text for r in clean.collect()]
    assert "plain [EMAIL] and [IP]" in got
    assert not any(t and ("@x.org" in t or "zanzibar" in t) for t in got)
    untouched = [t for _, t in awkward_rows()]
    assert all(t in got for t in untouched)


def test_overlapping_spans_and_empty_tables(spark):
    assert pii.redact("abcdef", [(1, 4, "X"), (2, 3, "Y"), (3, 5, "Z")]) == "aXf"
    assert pii.redact("abc", []) == "abc" and pii.redact("abc", [(0, 3, "")]) == ""
    found, terms = pii.find(table(spark, []))
    assert found.count() == 0 and terms.count() == 0 and pii.sanitise(table(spark, [])).count() == 0


def revealed(spark, rows) -> dict:
    _, terms = pii.find(table(spark, rows).repartition(3))
    texts = {pii._long_hash(t or ""): t for _, t in rows}
    return {texts[r.text_key]: {(texts[r.text_key][t.start : t.end], round(t.share, 9)) for t in r.terms} for r in terms.collect()}


def test_exact_copies_leave_the_terms_as_they_are(spark):
    rows = corpus() + awkward_rows()
    want = revealed(spark, rows)
    assert len(want) == 5
    copies = [(1000 + k, rows[0][1]) for k in range(300)] + [(None, rows[70 - 1][1])] * 40 + [(7, rows[20][1])] * 30
    assert revealed(spark, rows + copies) == want


def wide(*texts: str) -> list[tuple]:
    """Some texts among 3,000 others that hold common words and a word of their own."""
    return list(enumerate([*texts, *[f"{sentence(k, 12)} own{k}" for k in range(3000)]]))


def test_entities_of_one_and_two_texts_have_terms(spark):
    one = f"{sentence(1, 4)} zanzibar 10.1.2.3 {sentence(2, 6)} amber"
    two = [f"{sentence(k, 4)} quetzal li@x.org {sentence(k + 9, 6)}" for k in (3, 4)]
    # obelisk: near one mention, and in enough other texts to be no sign of it
    none = [f"{sentence(5, 4)} obelisk wu@x.org"] + [f"{sentence(k, 9)} obelisk" for k in range(20)]
    got = revealed(spark, wide(one, *two, *none))
    assert got == {one: {("zanzibar", 1.0)}, two[0]: {("quetzal", 1.0)}, two[1]: {("quetzal", 1.0)}}


def test_confidence_bound(spark):
    got = spark.range(1).select(*[pii.least_ratio(F.lit(a), F.lit(b)) for a, b in ((1, 1), (1, 2), (5, 5), (90, 100))]).first()
    z = 1.645
    for low, (a, b) in zip(got, ((1, 1), (1, 2), (5, 5), (90, 100)), strict=True):
        assert 0 < low < a / b and abs((a / b - low) ** 2 - z * z * low * (1 - low) / b) < 1e-12  # what Wilson's bound solves


def test_terms_go_wherever_they_stand(spark):
    url = "https://x.example/" + "a" * 90
    near = [f"Zanzibar first.\n\n{sentence(k, 30)}\né {url} zanzibar {url} {url} {url} {url} jo@x.org" for k in range(5)]
    plain_text = f"日本 {sentence(50, 9)} (zanzibar), zanzibars zan zibar"
    inside = f"{sentence(51, 9)} zanzibar@x.org"
    docs = wide(*near, plain_text, inside)
    got = revealed(spark, docs)
    assert [{t for t, _ in got[x]} for x in near] == [{"Zanzibar", "zanzibar", url}] * 5
    assert {t for t, _ in got[plain_text]} == {"zanzibar"}
    clean = {r.text for r in pii.sanitise(table(spark, [*docs, *docs[:6]])).collect()}
    assert not any(re.search(r"\bzanzibar\b", t, re.IGNORECASE) for t in clean)
    assert any("zanzibars zan zibar" in t for t in clean) and f"{sentence(51, 9)} [EMAIL]" in clean


def test_many_mentions_take_linear_time():
    text = "a@b.cd 1.2.3.4 " * 40_000
    assert pii.contexts(text, pii.base_spans(text), 8) == []

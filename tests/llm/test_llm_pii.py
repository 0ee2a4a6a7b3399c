import hashlib
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tallywell.llm import pii


def plain(text):
    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append((m.start(), 0, m.end(), "email"))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m[0].split(".")):
            out.append((m.start(), 1, m.end(), "ip"))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m[0])
        if 14 <= len(d) <= 19 and pii.luhn(d):
            out.append((m.start(), 2, m.end(), "card"))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append((m.start(), 3, m.end(), "phone"))
    return [(a, b, k) for a, _, b, k in sorted(out)]


@settings(max_examples=500, deadline=None)
@given(st.text(st.sampled_from("a.@-+ 0124é(\n"), max_size=60))
def test_spans_of_any_text(text):
    assert pii.base_spans(text) == plain(text)


def test_known_spans():
    text = "é mail: a.b@c.de.org, 10.0.0.255; 256.1.1.1; 4111 1111-1111 1111; +44 (20) 7946 0958; 001.02.3.4"
    assert pii.base_spans(text) == plain(text) and {k for _, _, k in pii.base_spans(text)} == set(pii.KINDS)
    assert pii.base_spans("a" * 200_000 + "@" + "1" * 200_000) == []


def test_rows_against_patterns(docs, rows, nothing):
    got = sorted(((r.doc_id, r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256, r.spans) for r in pii.report(docs).collect()), key=repr)
    for (i, text), r in zip(sorted(((i, t) for i, t in rows), key=lambda x: repr(x[0])), sorted(got, key=lambda x: repr(x[0]))):
        assert i == r[0]
    by = {}
    for i, text in rows:
        spans = plain(text or "")
        by.setdefault(i, set()).add((*(sum(s[2] == k for s in spans) for k in pii.KINDS), hashlib.sha256(pii.written(spans).encode()).hexdigest()))
    assert all(r[1:6] in by[r[0]] for r in got) and len(got) == len(rows)
    assert pii.report(nothing).count() == 0 and pii.sanitise(nothing).count() == 0


@pytest.fixture(scope="module")
def letters(spark):
    fill = "this and that some other plain text goes in here with more words to read about nature music".split()
    rows = []
    for i in range(200):
        own = [fill[(i * 7 + j * (3 + i % 5)) % len(fill)] for j in range(14)]
        if i < 12:
            own[4:4] = ["Zorblatt", "bob@corp.example"]
        if i in (12, 13):
            own[4:4] = ["Quuxley", "amy@corp.example"]
        rows.append((i, " ".join(own)))
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_a_telling_name_goes_with_its_address(letters):
    text = {r.doc_id: r.text for r in letters.collect()}
    for r in pii.report(letters).collect():
        added = [x.split(":") for x in r.spans.split(",") if x.startswith(pii.ADDED)]
        assert [text[r.doc_id][int(a): int(b)] for _, a, b in added] == (["Zorblatt"] if r.doc_id < 12 else [])
    got = {r.doc_id: r.text for r in pii.sanitise(letters).collect()}
    assert all(("[TERM] [EMAIL]" in got[i]) == (i < 12) and got[i] == text[i] or i < 14 for i in got) and len(got) == 200
    assert "Quuxley [EMAIL]" in got[12] and "@" not in got[13]


def test_copies_are_one_context(spark):
    rows = [(i, "call Zorblatt now bob@corp.example or never again") for i in range(50)] + [(i, f"plain text {i}") for i in range(50, 90)]
    got = pii.report(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert all(r.spans == ("email:18:34" if r.doc_id < 50 else "") for r in got)


def test_rare_entities_share_evidence(spark):
    fill = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(600)]
    rows = [(i, " ".join([*fill[i * 3: i * 3 + 5], *(["Zorblatt", f"name{chr(97 + i)}@corp.example"] if i < 8 else []), *fill[i * 2: i * 2 + 4]]))
            for i in range(150)]
    got = {r.doc_id: r.text for r in pii.sanitise(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(("[TERM] [EMAIL]" in got[i]) == (i < 8) and (i < 8 or got[i] == t) for i, t in rows)


def test_a_telling_term_goes_everywhere(spark):
    fill = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(600)]
    own = {i: [fill[(i * 37 + j * 91) % len(fill)] for j in range(24)] for i in range(195)}
    rows = [(i, " ".join([*(["Zorblatt"] if i < 13 else []), *own[i][:15], *(["bob@corp.example"] if i < 12 else []), *own[i][15:]])) for i in own]
    got = {r.doc_id: r.text for r in pii.sanitise(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(got[i].startswith("[TERM] ") == (i < 13) and (i < 13 or got[i] == t) for i, t in rows) and "@" not in got[0]


def test_all_marks_are_taken_off():
    text = b"*****Name***** name ((((((((n-a.me)))))))) ********** \"'"
    term, start, end, _ = pii._terms(np.frombuffer(text, np.uint8), np.array([0, len(text)]), 3)
    assert [text[a:b] for a, b in zip(start, end)] == [b"Name", b"name", b"n-a.me", b"", b""]
    assert term[0] == term[1] != 0 and not term[3:].any()


def test_columns_stay(docs, rows):
    got = pii.sanitise(docs)
    assert got.columns == docs.columns and got.count() == len(rows)
    assert all("@" not in (r.text or "") for r in got.where("text LIKE '%x@y.org%'").collect())

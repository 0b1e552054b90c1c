import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tradeflow.llm import pii_crf

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def brute(text):
    digits = lambda s: re.sub("[^0-9]", "", s)
    out = [(m.start(), 0, m.end()) for m in EMAIL.finditer(text)]
    out += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [(m.start(), 2, m.end()) for m in CARD.finditer(text) if 14 <= len(digits(m[0])) <= 19 and pii_crf.luhn(digits(m[0]))]
    out += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 10 <= len(digits(m[0])) <= 15]
    return sorted(out)


@pytest.fixture(scope="module")
def field():
    return pii_crf.train()


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(["a.b", "@", "x@y.z", ".", "-", " ", "+1", "12", "255", "4539578763621486", "(", ")", "1.2.3.4", "300", "é", "\n", "555-1234", "0"]), max_size=25).map("".join))
def test_base_spans_equal_the_plain_patterns(text):
    assert pii_crf.base_spans(text) == brute(text)


def test_long_runs_are_linear():
    for text in ("a" * 200_000, "1" * 200_000, "a@" * 50_000, "1." * 50_000, "+1 (" * 50_000):
        pii_crf.base_spans(text)


def test_field_on_unseen_sentences(field):
    table = pii_crf.labelled_table(2, seed=77)
    found = field.decode([w for w, _ in table])
    assert sum(list(d) == g for d, (_, g) in zip(found, table, strict=True)) / len(table) > 0.95


def test_viterbi_equals_enumeration(field):
    import itertools

    import numpy as np

    words = "call 555-123-4567 now".split()
    scores = field.emissions(words)
    value = lambda p: field.move[-1, p[0]] + sum(scores[t, k] for t, k in enumerate(p)) + sum(field.move[a, b] for a, b in itertools.pairwise(p))
    best = max(itertools.product(range(len(pii_crf.LABELS)), repeat=3), key=value)
    assert np.array_equal(field.decode([words])[0], best)


def test_method_adds_spans_beside_base_ones(field):
    text = "call 555-123-4567 or +1 (743) 555-3824, mail lea [at] mail [dot] org or a.b@c.example.com"
    base = pii_crf.base_spans(text)
    added = pii_crf.added_spans(field, [text], [base])[0]
    assert [text[a:b] for a, _, b in base] == ["+1 (743) 555-3824", "a.b@c.example.com"]
    assert {text[a:b] for a, _, b in added} == {"555-123-4567", "lea [at] mail [dot] org"}


def test_plain_prose_stays_clean(field):
    texts = ["In 1999 the house had 12 rooms and 3.5 baths.", "Version 1.2.3 costs $12.50 on 2024-05-06 at 10:30.", "No numbers here"]
    assert pii_crf.added_spans(field, texts, [pii_crf.base_spans(t) for t in texts]) == [[], [], []]


def test_windows_cover_every_trigger_and_do_not_overlap():
    text = "a b c d e f g 1 h i 2 j k l m n o p q r s 3"
    spans = [s for w in pii_crf.windows(text) for s in w]
    assert spans == sorted(set(spans)) and {text[a:b] for a, b in spans} >= {"1", "2", "3", "d", "g", "h"} and "a" not in {text[a:b] for a, b in spans}


def test_awkward_rows(field, docs_of, awkward):
    rows = pii_crf.find(docs_of(awkward), field).collect()
    assert len(rows) == len(awkward) and all(not r.base and not r.added for r in rows)
    assert pii_crf.find(docs_of([]), field).count() == 0


def test_redaction_keeps_other_columns_and_nulls(field, docs_of):
    docs = docs_of([None, "", "mail a@b.org today", "x"]).withColumnRenamed("source", "base")
    rows = {r.doc_id: r for r in pii_crf.redact(docs, field).collect()}
    assert [rows[k].text for k in range(4)] == [None, "", "mail [EMAIL] today", "x"] and rows[2].base == "src"


@pytest.mark.parametrize("before", ["", "x" * 70 + ",", "\u6f22" * 70, "\u6f22" * 5_000, '{"a":"' + "b" * 80 + '","tel":"'])
def test_numbers_far_inside_a_long_word_are_found(field, before):
    text = f"call {before}555-123-4567 now"
    at = text.index("555")
    assert pii_crf.added_spans(field, [text], [pii_crf.base_spans(text)]) == [[(at, 3, at + 12)]]


def test_pieces_cover_the_word(field):
    for word in ("a1" * 100, "+(" * 5_000, "1" * 500, "\u6f22(555) 1", "x" * 59 + "12" + "y" * 61):
        found = pii_crf.pieces(word, 0, len(word))
        assert "".join(word[a:b] for a, b in found) == word and max(b - a for a, b in found) <= pii_crf.LONG


# Sentences written by hand, apart from the training generator's frames and formats.
HELD_OUT = [
    ("Our office (reception) answers at (415) 555-2671 until six", "(415) 555-2671", "phone"),
    ("You can reach Paula on 415.555.9034 after lunch", "415.555.9034", "phone"),
    ("Rufen Sie uns an: 0711 234 56 78, danke", "0711 234 56 78", "phone"),
    ("She wrote down john.smith [at] company [dot] org and left", "john.smith [at] company [dot] org", "email"),
    ("In 1987 the town had 12,450 people and 3 schools", None, None),
    ("Chapter 12 begins on page 204 of volume 3", None, None),
    ("The parcel weighed 2.75 kg and cost 19.90", None, None),
]


def test_held_out_sentences(field):
    """Of the sentences written by hand, most spans are found and few are made up."""
    hits = made_up = wanted = 0
    for text, span, kind in HELD_OUT:
        found = pii_crf.added_spans(field, [text], [pii_crf.base_spans(text)])[0]
        wanted += span is not None
        at = text.index(span) if span else -1
        hits += any(k == pii_crf.KINDS.index(kind) and a < at + len(span) and at < b for a, k, b in found) if span else 0
        made_up += sum(span is None or not (a < at + len(span) and at < b) for a, _, b in found)
    assert hits >= 3 and wanted == 4 and made_up <= 1

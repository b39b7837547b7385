"""Values beside others in pseudonymised texts, and labelled texts longer than any window."""

import random
import re

import pytest

from kalends.llm import pseudonyms, quality
from tests.llm.cases import documents

CARD, IBAN = "4111 1111 1111 1111", "ES91 2100 0418 4502 0005 1332"


@pytest.mark.parametrize(("text", "value", "kind"), [
    (f"{CARD} 12/27", CARD, "card"), (f"{CARD} 123", CARD, "card"), (f"no 12 {CARD}", CARD, "card"), ("4111-1111-1111-1111-12", "4111-1111-1111-1111", "card"),
    ("4111-1111-1111-1111-2025-1234", "4111-1111-1111-1111", "card"), (f"{IBAN} EUR", IBAN, "iban"), ("ES9121000418450200051332 EUR", "ES9121000418450200051332", "iban"),
    (f"AB12 {IBAN} 1", IBAN, "iban"), (f"DE87 {CARD}", CARD, "card"), ("PL61 1090 1014 0000 0712 1981 2874 AB1", "PL61 1090 1014 0000 0712 1981 2874", "iban"),
    ("tel +15551234567.", "+15551234567", "phone"), ("+19885552485", "+19885552485", "phone"), ("at 1985-03-12T10:15", "1985-03-12", "date"),
])
def test_values_beside_others(text, value, kind):
    names = pseudonyms.Pseudonyms(b"k")
    new, kinds = names.replace(text)
    alone, _ = names.replace(value)
    assert kinds == {kind: 1} and alone != value
    assert new == text.replace(value, alone)
    assert names.replace(re.sub(r"(?<=\d) (?=\d)", "", value))[0] == re.sub(r"(?<=\d) (?=\d)", "", alone)


def test_plus_one_numbers_are_linked_and_go_back():
    there, back = pseudonyms.Pseudonyms(b"k"), pseudonyms.Pseudonyms(b"k", inverse=True)
    for text in ("+1 (988) 555-2485 +19885552485", "+1 555 123 4567 +15551234567", f"{IBAN} EUR at 1985-03-12T10:15"):
        new, _ = there.replace(text)
        assert back.replace(new)[0] == text
    a, b = there.replace("+1 (988) 555-2485")[0], there.replace("+19885552485")[0]
    assert re.sub(r"\D", "", a) == re.sub(r"\D", "", b)


def test_whole_labelled_texts_are_learnt(spark):
    rng = random.Random(2)
    filler, rows = ["house", "river", "green", "walked", "stone", "cloud"], []
    for k in range(120):
        # longer than 4,000 characters and parted by line feeds only, or with the marks of quality in one place in the middle of a tenth
        mark = ["fine"] * 300 if k % 2 else ["spam"] * 300
        words = [rng.choice(filler) for _ in range(1500)]
        rows.append((k, "\n".join(mark + words) if k < 60 else " ".join(words[:230] + mark + words[230:])))
    docs = documents(spark, [(d, t, "en", "s") for d, t in rows])
    labels = spark.createDataFrame([(d, d % 2) for d, _ in rows], "doc_id long, quality int")
    got = quality.score(docs, quality.fit(docs, labels), threshold=0.5).where("held_out").collect()
    assert len(got) > 10 and all(r.predicted == r.doc_id % 2 for r in got)

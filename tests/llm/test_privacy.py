from __future__ import annotations

import re
import time

import pytest
from odd import docs, none

from scoreloom.llm.privacy import EMAIL, OTHER, Permutation, Surrogates, check_distinct, like, lowered, luhn, with_surrogates

S = Surrogates()

TEXTS = [
    "Call +1 (743) 555-3824 or (743) 555-3824, Mr. John Smith and Mrs Svetlana Kuznetsova; then Mr Smith.",
    "john.smith55@mail9.example.com and JOHN.smith55@mail9.example.com but élève.1@exämple is none, élève.1@mail.fr is.",
    "4111 1111 1111 1111, 4111111111111111, 9807915762804490; 97.51.17.173, 10.1.2.3, 192.168.3.4",
    "DE89 3704 0044 0532 0130 00 123-45-6789 Maria Gonzalez met Елена Петрова.",
]


@pytest.mark.parametrize("n", [1, 2, 3, 10, 26, 1000])
def test_permutations_move_everything(n):
    order = Permutation(b"k", b"t", n)
    values = [order(i) for i in range(n)]
    assert sorted(values) == list(range(n))
    assert n == 1 or all(v != i for i, v in enumerate(values))


def test_nothing_of_an_entity_is_left_and_forms_stay():
    for text in TEXTS:
        made, found = S.replaced(text)
        assert found
        for kind, entity, surrogate in found:
            assert entity != surrogate
            assert entity not in made.lower() or kind == "person"
        again = S.replaced(made)[1]
        assert [k for k, _, _ in again] == [k for k, _, _ in found]


def test_formats():
    made, found = S.replaced(TEXTS[0])
    phones = re.findall(r"\(\d{3}\) \d{3}-\d{4}", made)
    assert len(phones) == 2 and phones[0] == phones[1] and made.startswith("Call +1 (")
    names = re.findall(r"Mr\. (\w+) (\w+) and Mrs (\w+) (\w+); then Mr (\w+)\.", made)[0]
    assert names[1] == names[4] and names[2].endswith("a") and names[3].endswith("a")
    assert names[0].lower() in dict.fromkeys(n.lower() for n in OTHER.pattern.split("|"))
    cards = S.replaced(TEXTS[2])[0].split("; ")[0].split(", ")
    assert cards[0].replace(" ", "") == cards[1] and luhn(cards[1]) and not luhn(cards[2]) and cards[0][4] == " "
    assert re.search(r", 10\.\d+\.\d+\.\d+, 192\.168\.\d+\.\d+$", S.replaced(TEXTS[2])[0])
    mails = EMAIL.findall(S.replaced(TEXTS[1])[0])
    assert mails[0] == mails[1].lower() and mails[1][:4].isupper() and mails[0].endswith(".com")
    assert re.search(r"[А-Яа-я]+ [А-Яа-я]+\.$", S.replaced(TEXTS[3])[0])


def test_different_entities_stay_different():
    kinds = {
        "phone": [f"{i:010d}" for i in range(0, 3000)],
        "card": [f"41111111111{i:05d}" for i in range(3000)],
        "ip": [f"{a}.{b}.7.1" for a in range(1, 60) for b in range(50)],
        "email": [f"{a}{b}@m{c}.org" for a in "abcdefgh" for b in "xyz01" for c in range(30)],
        "person": ["john", "juan", "boan", "koan", "loan", "mary", "nary", "anna", "enna", "john loan", "smith", "smyth"],
        "ssn": [f"{i:09d}" for i in range(2000)],
        "iban": [f"DE{c:02d}3704004405320130{i:02d}" for c in (89, 88, 12) for i in range(60)],
    }
    for kind, entities in kinds.items():
        made = [S.surrogate(kind, e) for e in entities]
        assert len(set(made)) == len(entities), kind


NAMES = "王明 李小龙 さくら 田中 김민준 محمد משה अमर Արամ Łś Żółć Ğül ŁŚ Čapek Øø Ⴀნა İı 々ー ªº ΐΰ ЁЬ ђё ŉŉ ſſ ǅǅ ⅷⅷ Łaş-Éķ"


@pytest.mark.parametrize("name", NAMES.split())
def test_names_and_mails_outside_the_alphabets(name):
    """Nothing comes out unchanged; the length stays, and the script and case of each letter that has others of its sort."""
    for text in (f"Then Dr. {name} came.", f"Write to {name}@mail9.example.org now."):
        made, found = S.replaced(text)
        assert len(found) == 1 and found[0][1] != found[0][2] and name not in made and len(made) == len(text)
        again = S.replaced(made)[1]
        assert [(k, e) for k, e, _ in again] == [(k, s) for k, _, s in found]
        for a, b in zip(text, made):
            assert (a.isalnum(), a.isupper()) == (b.isalnum(), b.isupper())


def test_letters_stand_for_one_another():
    """So the surrogates of different names differ: a letter's likes have the same likes. No letter or number stands for itself alone."""
    for c in map(chr, [*range(128, 0x3200), 0x4E00, 0x9FFF, 0xAC00, 0xFB01, 0x1D7D8, 0x20000]):
        if c.isalnum() and lowered(c) == c:
            options = like(c)
            assert c in options and 1 < len(options) == len(set(options)) and all(like(x) == options for x in options), c
    made = [S.surrogate("person", a + b) for a in "łśżźćńęąşğ王李明田中" for b in "łśżźćńęąşğ王李明田中"]
    assert len(set(made)) == len(made)


def test_keys_differ():
    assert Surrogates("other").replaced(TEXTS[0])[0] != S.replaced(TEXTS[0])[0]


def test_clean_text_is_left_alone():
    text = 'token = "1eb9c654e721b4f812088970e66a6345cee33dd6" 2024-01-02 12:30 1.2.3 v1.2.3.4.5 12 345 678 901 234 x@y A-1'
    assert S.replaced(text) == (text, [])


def test_odd_rows_and_table(spark, data):
    table = docs(spark)
    got = {str(r["doc_id"]): r["text"] for r in with_surrogates(table.where("doc_id is not null")).collect()}
    assert got == {str(r["doc_id"]): r["text"] for r in table.where("doc_id is not null").collect()}
    assert with_surrogates(none(spark)).count() == 0
    rows = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    made = {r["doc_id"]: r["text"] for r in with_surrogates(rows.repartition(3)).collect()}
    assert made == {i: S.replaced(t)[0] for i, t in enumerate(TEXTS)}
    before = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{data}/documents.parquet").collect()}
    for r in with_surrogates(spark.read.parquet(f"{data}/documents.parquet")).collect():
        for mention in re.findall(r"\S+@\S+\.com|\+1 \(\d{3}\) \d{3}-\d{4}|\b\d{16}\b", before[r["doc_id"]]):
            assert mention not in r["text"]


def test_a_collision_stops_the_job(spark):
    rows = [("ip", "1.2.3.4", "9.9.9.9"), ("ip", "1.2.3.4", "9.9.9.9"), ("ssn", "1", "9.9.9.9"), ("ip", "1.2.3.5", "9.9.9.8")]
    check_distinct(spark.createDataFrame(rows, "kind string, entity string, surrogate string"))
    rows.append(("ip", "1.2.3.6", "9.9.9.8"))
    with pytest.raises(ValueError, match="share a surrogate"):
        check_distinct(spark.createDataFrame(rows, "kind string, entity string, surrogate string"))


def test_an_entity_that_stays_stops_the_job(spark):
    rows = [("email", "+@-.com", "+@-.com"), ("person", "a", "b")]
    check_distinct(spark.createDataFrame(rows, "kind string, entity string, surrogate string"))
    for row in (("person", "王明", "王明"), ("email", "王@-.com", "王@-.com")):
        with pytest.raises(ValueError, match="stay as it is"):
            check_distinct(spark.createDataFrame([*rows, row], "kind string, entity string, surrogate string"))


@pytest.mark.parametrize(
    "text", ["call (555) 123-４５６７ now", "+1 ٢٣٤ ٥٦٧ ٨٩٠١", "123-٤٥-6789", "4１２３ 4567 8901 2345", "१२३-४५-६७८९", "10.٢.3.4", "DE٨٩ 3704 0044 0532 0130 00"]
)
def test_digits_of_all_scripts(text):
    """They are found, replaced, and written in the script they were in; the entity is that of the same ASCII digits."""
    made, found = S.replaced(text)
    assert len(found) == 1 and made != text and len(made) == len(text) or found[0][0] == "ip"
    ascii_text = "".join(str(int(c)) if c.isdecimal() else c for c in text)
    assert S.replaced(ascii_text)[1] == found
    scripts = lambda s: [ord(c) - int(c) for c in s if c.isdecimal()]
    assert scripts(made) == scripts(text) or found[0][0] == "ip"


def test_long_entities():
    """Linear in their length, each letter replaced, and distinct also where only the last letter differs."""
    started = time.perf_counter()
    long = ["ab" * 50_000 + c for c in "cd"]
    made = [S.replaced(f"x {name}@mail.example.com y")[1][0][2] for name in long]
    assert made[0] != made[1] and all(len(m) == len(name) + 17 for m, name in zip(made, long))
    name = S.replaced("Mr " + "Q" + "w" * 20_000)[1][0]
    assert name[0] == "person" and name[1] != name[2] and len(name[1]) == len(name[2])
    assert time.perf_counter() - started < 4

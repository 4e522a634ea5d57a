import itertools

import pytest

from cases import TEXTS, documents, plain
from martbrook.llm import surrogates as su


@pytest.fixture(scope="module")
def subject():
    return su.Surrogates(b"key")


@pytest.mark.parametrize("bases", [[7], [10, 10], [10, 26, 10], [3, 2, 5, 7], [2, 2]])
def test_mappings_are_one_to_one_without_fixed_points(subject, bases):
    values = list(itertools.product(*map(range, bases)))
    images = [tuple(subject.keyed.following("form", list(v), bases)) for v in values]
    assert len(set(images)) == len(values) and all(a != b for a, b in zip(values, images))


def test_form_and_check_digits_stay(subject):
    card = subject.replacement("card", "4693 5308 1479 7916")
    digits = card.replace(" ", "")
    assert [len(p) for p in card.split(" ")] == [4, 4, 4, 4] and int(digits[-1]) == su.luhn(digits[:-1])
    iban = subject.replacement("iban", "DE89 3704 0044 0532 0130 00").replace(" ", "")
    assert iban[:2] == "DE" and su.iban_check("DE", iban[4:]) == iban[2:4]
    phone = subject.replacement("phone", "+1 (318) 555-2368")
    assert phone.startswith("+1 (318) ") and len(phone) == 17 and phone[12] == "-"
    email = subject.replacement("email", "Jo.Doe42@firm.co.uk")
    assert email[2] == "." and email[0].isupper() and email.endswith(".uk.example")
    assert subject.replacement("email", "a.b@mail1.example.com").endswith("@mail1.example.com")


def test_names_keep_gender_script_and_coreference(subject):
    for (gender, script), names in su.GIVEN.items():
        images = {subject.replacement("given", n) for n in names}
        assert images == set(names)
    text = "Mr. John Smith and Мария Павлова met. Later Smith left; John stayed. Leon was a word, and so was Young."
    new, found = subject.rewrite(text)
    assert [text[e.start:e.end] for e in found if e.kind == "family"] == ["Smith", "Smith"]
    assert len({e.surrogate for e in found if text[e.start:e.end] == "John"}) == 1
    assert "Leon was a word, and so was Young." in new


@pytest.mark.parametrize("text", [
    "(Maria Schmidt)", '"John Smith" said', "Contact:Anna Weber", "[Mr. Young]", "«Иван Павлов»", "/Νίκος Παππάς/", "-Herr\tBauer,"])
def test_names_after_signs(subject, text):
    new, found = subject.rewrite(text)
    assert found and found[-1].kind == "family"
    assert all(text[e.start:e.end] not in new for e in found)


@pytest.mark.parametrize("text, values", [
    ("No. 12 4111 1111 1111 1111", ["card 4111 1111 1111 1111"]),
    ("4111 1111 1111 1111 12 26", ["card 4111 1111 1111 1111"]),
    ("AB12 4111-1111-1111-1111-7", ["card 4111-1111-1111-1111"]),
    ("call 555-123-4567 555-765-4321", ["phone 555-123-4567", "phone 555-765-4321"]),
    ("555 123 4567 555 765 4321 +1 (318) 555-2368", ["phone 555 123 4567", "phone 555 765 4321", "phone +1 (318) 555-2368"]),
    ("555-123-4567 123-45-6789", ["phone 555-123-4567", "ssn 123-45-6789"]),
    ("BE68 5390 0754 7034 EUR", ["iban BE68 5390 0754 7034"]),
    ("BE68 5390 0754 7034 DE89 3704 0044 0532 0130 00", ["iban BE68 5390 0754 7034", "iban DE89 3704 0044 0532 0130 00"]),
    ("555-123-4567 55 10.0.0.1", ["phone 555-123-4567 55", "ipv4 10.0.0.1"]),
    ("555-123-4567 12 123.foo@x.com", ["phone 555-123-4567 12", "email 123.foo@x.com"]),
    ("12.50 13.75 14.25 15.00", []),
])
def test_values_next_to_digits_or_capitals(subject, text, values):
    assert [f"{e.kind} {text[e.start:e.end]}" for e in subject.rewrite(text)[1]] == values


def test_long_runs_of_numbers(subject):
    text = "7 " * 50_000 + "call 555-123-4567 555-765-4321"
    assert [text[e.start:e.end] for e in subject.entities(text)][-2:] == ["555-123-4567", "555-765-4321"]


def test_distinct_entities_stay_distinct(subject):
    numbers = [f"+1 (555) 555-{n:04d}" for n in range(2000)]
    new, found = subject.rewrite("; ".join(numbers))
    assert len(found) == 2000 and len({e.surrogate for e in found}) == 2000
    again = subject.rewrite("; ".join(reversed(numbers)))[1]
    assert {n: e.surrogate for n, e in zip(numbers, found)} == {n: e.surrogate for n, e in zip(reversed(numbers), again)}
    assert su.Surrogates(b"other").rewrite(numbers[0])[0] != subject.rewrite(numbers[0])[0]


def test_domains_never_collide(subject):
    """A domain that is another's surrogate has one of its own, in the same text and elsewhere."""
    domains = ["acme.com", "acme.example", "acme.example.com", "a-b.co.uk"]
    for _ in range(3):
        domains += [subject.replacement("email", f"x@{d}").partition("@")[2] for d in domains]
    domains = list(dict.fromkeys(domains))
    text = " ".join(f"x@{d}" for d in domains)
    found = subject.rewrite(text)[1]
    assert len(found) == len(domains) == len({e.surrogate for e in found})


@pytest.mark.parametrize("kind, ways", [
    ("card", ["4111 1111 1111 1111", "4111111111111111", "4111-1111-1111-1111"]),
    ("iban", ["DE89 3704 0044 0532 0130 00", "DE89370400440532013000"]),
    ("phone", ["+1 (318) 555-2368", "+1 318 555 2368", "1318-555-2368", "tel 13185552368"]),
    ("email", ["John.Doe@firm.com", "john.doe@firm.com", "JOHN.DOE@FIRM.COM"]),
    ("ipv6", ["2001:db8::1", "2001:DB8:0:0::1", "2001:0db8:0000:0000:0000:0000:0000:0001"]),
])
def test_one_surrogate_however_it_is_written(subject, kind, ways):
    text = "; ".join(ways) + "."
    new, found = subject.rewrite(text)
    assert [e.kind for e in found] == [kind] * len(ways) and "".join(new.split(";")) != text
    assert len({su.entity(kind, e.surrogate) for e in found}) == 1
    values = [text[e.start:e.end] for e in found]
    if kind != "ipv6":  # these are written shortest
        signs = [["" if c.isalnum() else c for c in v.partition("@")[0]] for v in values]
        assert signs == [["" if c.isalnum() else c for c in e.surrogate.partition("@")[0]] for e in found]


@pytest.mark.parametrize("text, kinds", [
    ("MARIA SCHMIDT", "given family"), ("Dr. Priya Patel; later Patel spoke", "given family family"), ("Mr. O'Neil and O'NEIL", "family family"),
    ("Frau Kowalska-Nowak", "family"), ("Mrs Жукова", "family"), ("call 5551234567 now", "phone"), ("+15551234567", "phone"),
    ("from 2001:db8::1 to fe80::1234", "ipv6 ipv6"), ("::ffff:10.0.0.1", "ipv4"),
    ("at 12:30:45, a::b and std::move", ""), ("5551234567", ""), ("Mr. and Mrs.", ""), ("Dr. 5", ""), ("MS Word", ""),
])
def test_found_by_context(subject, text, kinds):
    new, found = subject.rewrite(text)
    assert [e.kind for e in found] == kinds.split()
    assert all(text[e.start:e.end] not in new for e in found)


def test_names_of_no_list_do_not_meet_those_of_the_lists(subject):
    """Names of two letters: few enough to meet short names of a list, were they not passed over."""
    short = su.Surrogates(b"key")
    short.family = {"ab": "latin", "cd": "latin", "ef": "latin"}
    values = [a + b for a in "abcdefghijklmnopqrstuvwxyz" for b in "abcdefghijklmnopqrstuvwxyz" if a + b not in short.family]
    images = {short._unlisted("family", v, short.family) for v in values}
    assert images == set(values) and subject._unlisted("family", "Żyła", {})[0] == "Ż"


def test_whole_table_keeps_entities_apart_and_together(spark):
    """Over all documents: one entity has one surrogate, and no two have the same; all else stays."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    rows = su.pseudonymised(docs, b"key").withColumnRenamed("text", "new").join(docs.select("doc_id", "text"), "doc_id").collect()
    forth, back, n = {}, {}, 0
    for row in rows:
        text, at, new_at = row.text or "", 0, 0
        for e in row.entities:
            assert text[at:e.start] == row.new[new_at:e.new_start]
            at, new_at, n = e.end, e.new_end, n + 1
            old, new = su.entity(e.kind, text[e.start:e.end]), su.entity(e.kind, row.new[e.new_start:e.new_end])
            assert forth.setdefault((e.kind, old), new) == new and back.setdefault((e.kind, new), old) == old and old != new
        assert text[at:] == row.new[new_at:]
    assert len(rows) == docs.count() and n > 500


def test_what_is_no_personal_data(subject):
    for text in ("version 1.2.3.4.5", "12345678901234567", "x@y", "2024-01-01", "4693530814797917"):
        assert subject.rewrite(text) == (text, [])


def test_awkward_texts(spark, tmp_path, subject):
    texts = [*TEXTS, "é write to a.b@c.org or 14.49.253.103!"]
    found = su.pseudonymised(documents(spark, texts, folder=tmp_path), b"key")
    rows = plain(found)
    assert [(i, t) for i, t, _ in rows] == [(i, subject.rewrite(t or "")[0]) for i, t in enumerate(texts)]
    last = rows[-1]
    assert [(e.kind, texts[-1][e.start:e.end]) for e in last[2]] == [("email", "a.b@c.org"), ("ipv4", "14.49.253.103")]
    assert [last[1][e.new_start:e.new_end] for e in last[2]] == [subject.replacement(e.kind, texts[-1][e.start:e.end]) for e in last[2]]
    assert su.pseudonymised(documents(spark, [], folder=tmp_path), b"key").count() == 0

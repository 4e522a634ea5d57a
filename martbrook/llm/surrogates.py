"""Personal data replaced by keyed surrogates of the same type, form, gender and script.

An entity is a value without its ways of writing (case, spaces, separators). Every replacement is a keyed one-to-one
mapping of all entities of one form, without fixed points, written the way the value was: the
mapping of a value x is the one that follows x in an order that only the key knows. So different
entities always get different surrogates, an entity gets the same one wherever it occurs, in
every document and task, and nothing must be remembered or looked up. What follows in the order is found
by a small Feistel network over the value's positions, forth and back.
"""

from __future__ import annotations

import hashlib
import hmac
import ipaddress
import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from .texts import map_texts

ROUNDS = 8
RESULT = ("text string, entities array<struct<kind: string, start: bigint, end: bigint, "
          "new_start: bigint, new_end: bigint>>")

_DIGITS, _SMALL, _LARGE = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

# Given names by gender and script, and family names by script.
GIVEN = {
    ("f", "latin"): "Alice Anna Carol Clara Diana Elena Emma Eva Grace Hannah Helen Irene Julia Laura Linda Lucy "
                    "Maria Martha Nina Olivia Paula Rosa Ruth Sarah Sofia Susan Teresa Vera".split(),
    ("m", "latin"): "Adam Albert Arthur Carlos Daniel David Edward Eric Frank George Henry Hugo Ivan James John "
                    "Kevin Leon Louis Mark Martin Oscar Pablo Paul Peter Robert Simon Thomas Victor".split(),
    ("f", "cyrillic"): "Анна Вера Галина Дарья Елена Ирина Лариса Мария Наталья Ольга Полина Светлана".split(),
    ("m", "cyrillic"): "Алексей Борис Виктор Дмитрий Иван Кирилл Максим Михаил Николай Олег Павел Сергей".split(),
    ("f", "greek"): "Άννα Ελένη Ιωάννα Κατερίνα Μαρία Σοφία Χριστίνα".split(),
    ("m", "greek"): "Γιώργος Δημήτρης Κώστας Νίκος Παύλος Πέτρος Σπύρος".split(),
}
FAMILY = {
    "latin": "Anderson Bauer Becker Brown Clark Costa Davies Dubois Evans Fischer Garcia Harris Hoffmann Jackson "
             "Johnson Keller Lambert Lopez Martinez Meyer Miller Moreau Moreno Nelson Parker Petit Ramirez Roberts "
             "Schmidt Schneider Smith Taylor Thompson Torres Wagner Walker Weber Williams Wilson Young".split(),
    "cyrillic": "Андреев Волков Громов Егоров Зайцев Иванов Козлов Лебедев Морозов Новиков Орлов Павлов Соколов".split(),
    "greek": "Αγγέλου Βλάχος Γεωργίου Δημητρίου Ιωάννου Κώστα Νικολάου Παππάς Σταύρου".split(),
}
TITLES = {"Mr": "m", "Mrs": "f", "Ms": "f", "Herr": "m", "Frau": "f", "Señor": "m", "Señora": "f", "Monsieur": "m", "Madame": "f",
          "Dr": "", "Prof": ""}
#: Letters that are replaced, by script: those of names that are in no list become others of their script.
ALPHABETS = (_DIGITS, _SMALL, _LARGE, "абвгдежзийклмнопрстуфхцчшщъыьэюя", "αβγδεζηθικλμνξοπρστυφχψω")

EMAIL = r"(?<![\w.+-])[A-Za-z0-9](?:[A-Za-z0-9._+-]*[A-Za-z0-9_+-])?@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}(?![\w-])"
IPV4 = r"(?<![\w.])(?:(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)\.){3}(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)(?![\w]|\.\d)"
SSN = r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])"
IBAN = r"(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?!\w)"
CARD = r"(?<![\w.-])\d(?:[ -]?\d){12,18}(?![\w-]|\.\d)"
IPV6 = r"(?<![\w:.])[0-9A-Fa-f]{0,4}(?::[0-9A-Fa-f]{0,4}){2,7}(?![\w:]|\.\d)"
PHONE = r"(?<![\w.])(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)[ .-]?)?\d{2,4}(?:[ .-]\d{2,5}){1,4}(?!\w|\.\d)"
#: In the order in which they win where they overlap.
PATTERNS = (("email", EMAIL), ("ipv4", IPV4), ("ipv6", IPV6), ("iban", IBAN), ("card", CARD), ("ssn", SSN), ("phone", PHONE))
PHONE_DIGITS = (9, 15)
#: Numbers without separators are phones with a plus or after one of these words.
PHONE_WORDS = ("tel", "telephone", "phone", "mobile", "cell", "call", "fax", "whatsapp", "telefon", "téléphone", "teléfono")
#: A capitalised word that may be a name, and how many may follow a title.
NAME = r"[^\W\d_](?:[^\W\d_]|['’-](?=[^\W\d_]))*"
#: Numbers of digits, with what may be between and before them in cards, social security and phone numbers.
RUN = r"\+?\(?\d+(?:\)?[ .-]?[+(]{0,2}\d+)*"
#: Kinds that part of a run can be, with their patterns and least and most digits.
PARTS = (("card", r"\d(?:[ -]?\d){12,18}", 13, 19), ("ssn", r"(?<!-)\d{3}-\d{2}-\d{4}", 9, 9),
         ("phone", r"(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)[ .-]?)?\d{2,4}(?:[ .-]\d{2,5}){1,4}", *PHONE_DIGITS))
#: How cards are printed.
USUAL_CARD = r"\d{13,19}|\d{4}([ -])\d{4}\1\d{4}\1\d{4}(?:\1\d{1,3})?|\d{4}([ -])\d{6}\2\d{4,5}"


@dataclass(frozen=True)
class Entity:
    kind: str
    start: int
    end: int
    surrogate: str


# --- one-to-one mappings ------------------------------------------------------------
class Keyed:
    """Keyed one-to-one mappings without fixed points."""

    def __init__(self, key: bytes):
        self.key = key

    def _number(self, *parts) -> int:
        return int.from_bytes(hmac.new(self.key, repr(parts).encode(), hashlib.sha256).digest(), "big")

    def following(self, form: str, digits: list[int], bases: list[int]) -> list[int]:
        """The value after this one in the key's order of all values with these bases. ``form`` tells
        mappings apart. One position alone is ordered by its numbers' hashes."""
        if len(bases) == 1:
            order = sorted(range(bases[0]), key=lambda n: self._number(form, bases[0], n))
            return [order[(order.index(digits[0]) + 1) % bases[0]]]
        half = len(bases) // 2
        sizes = _product(bases[:half]), _product(bases[half:])
        left, right = _value(digits[:half], bases[:half]), _value(digits[half:], bases[half:])
        place = form, tuple(bases)
        for turn in range(ROUNDS - 1, -1, -1):  # back to the place in the order
            if turn % 2:
                right = (right - self._number(place, turn, left)) % sizes[1]
            else:
                left = (left - self._number(place, turn, right)) % sizes[0]
        at = (left * sizes[1] + right + 1) % (sizes[0] * sizes[1])
        left, right = divmod(at, sizes[1])
        for turn in range(ROUNDS):
            if turn % 2:
                right = (right + self._number(place, turn, left)) % sizes[1]
            else:
                left = (left + self._number(place, turn, right)) % sizes[0]
        return _digits(left, bases[:half]) + _digits(right, bases[half:])

    def text(self, form: str, value: str) -> str:
        """Digits become digits and letters of the alphabets letters of the same one; other signs stay."""
        kinds = [next((k for k in ALPHABETS if c in k), "") for c in value]
        places = [at for at, kind in enumerate(kinds) if kind]
        if not places:
            return value
        shape = form + ":" + "".join("#" if kind else c for kind, c in zip(kinds, value))
        found = self.following(shape, [kinds[at].index(value[at]) for at in places], [len(kinds[at]) for at in places])
        out = list(value)
        for at, n in zip(places, found):
            out[at] = kinds[at][n]
        return "".join(out)

    def name(self, group: str, names: list[str], value: str) -> str:
        """Another name of the list, in the case that the value is written in."""
        order = sorted(names, key=lambda n: self._number(group, n))
        plain = next(n for n in names if fold(n) == fold(value))
        new = order[(order.index(plain) + 1) % len(order)]
        return new.upper() if value.isupper() else new.lower() if value.islower() else new


def fold(value: str) -> str:
    """In small letters, sign by sign; those that would become several signs stay."""
    return "".join(c.lower() if len(c.lower()) == 1 else c for c in value).replace("ς", "σ")


def in_case_of(value: str, folded: str) -> str:
    """A text as long as ``value`` with capitals where that has them."""
    return "".join(n.upper() if c.isupper() and len(n.upper()) == 1 else n for c, n in zip(value, folded))


def digits_of(value: str) -> str:
    return "".join(c for c in value if c in _DIGITS)


def with_digits(value: str, digits: str) -> str:
    """``value`` with other digits, its separators where they were."""
    new = iter(digits)
    return "".join(next(new) if c in _DIGITS else c for c in value)


def entity(kind: str, value: str) -> str:
    """What is the same however it is written."""
    if kind in ("card", "ssn", "phone"):
        return digits_of(value)
    if kind == "iban":
        return value.replace(" ", "")
    if kind == "ipv6":
        return ipaddress.IPv6Address(value).exploded
    return fold(value)


def _product(bases: list[int]) -> int:
    out = 1
    for base in bases:
        out *= base
    return out


def _value(digits: list[int], bases: list[int]) -> int:
    out = 0
    for digit, base in zip(digits, bases):
        out = out * base + digit
    return out


def _digits(value: int, bases: list[int]) -> list[int]:
    out = []
    for base in reversed(bases):
        value, digit = divmod(value, base)
        out.append(digit)
    return out[::-1]


# --- types ---------------------------------------------------------------------------
def luhn(digits: str) -> int:
    """The check digit of these digits."""
    total = 0
    for at, digit in enumerate(reversed(digits)):
        n = int(digit) * (2 if at % 2 == 0 else 1)
        total += n - 9 if n > 9 else n
    return -total % 10


def iban_check(country: str, rest: str) -> str:
    number = "".join(str(int(c, 36)) for c in rest + country + "00")
    return f"{98 - int(number) % 97:02d}"


def _valid(kind: str, value: str) -> bool:
    digits = [c for c in value if c.isdigit()]
    if kind == "card":
        return int(digits[-1]) == luhn("".join(digits[:-1])) and len(set(digits)) > 1
    if kind == "phone":
        return PHONE_DIGITS[0] <= len(digits) <= PHONE_DIGITS[1]
    if kind == "iban":
        plain = value.replace(" ", "")
        return 15 <= len(plain) <= 34 and iban_check(plain[:2], plain[4:]) == plain[2:4]
    if kind == "ipv6":
        try:
            ipaddress.IPv6Address(value)
        except ValueError:
            return False
        return len(value.replace(":", "")) > 4 and any(c in _DIGITS for c in value)  # a::b may be code
    return True


class Surrogates:
    """Finds personal data in a text and names its replacements."""

    def __init__(self, key: bytes):
        self.keyed = Keyed(key)
        self.known: dict[tuple[str, str], str] = {}
        self.pattern = re.compile("|".join(f"(?P<{kind}>{p})" for kind, p in PATTERNS), re.ASCII)
        self.parts = [(kind, re.compile(p, re.ASCII), least, most) for kind, p, least, most in PARTS]
        self.run, self.number = re.compile(RUN, re.ASCII), re.compile(r"\d+", re.ASCII)
        self.usual_card = re.compile(USUAL_CARD, re.ASCII)
        self.goes_on = re.compile(r"\w|\.\d", re.ASCII)  # after a number that can't end a value
        #: What a run of numbers may run into.
        self.apart = re.compile(f"{EMAIL}|{IPV4}", re.ASCII)
        self.marks = re.compile(r"[0-9@]")  # without any there is nothing for the pattern
        self.person = {fold(n): (gender, script) for (gender, script), names in GIVEN.items() for n in names}
        self.family = {fold(n): script for script, names in FAMILY.items() for n in names}
        #: A text in which names are looked for has one of these as a word, whatever signs are around it.
        firsts = [n for names in GIVEN.values() for n in names]
        titles = [*TITLES, *(t.upper() for t in TITLES if t != "Ms")]  # MS stands for more than that
        self.openers = {*firsts, *(n.upper() for n in firsts), *titles}
        self.words = re.compile(r"\w+")
        given = "|".join([*firsts, *(n.upper() for n in firsts)])
        families = [n for names in FAMILY.values() for n in names]
        family = "|".join([*families, *(n.upper() for n in families)])
        title = "|".join(titles)
        # A family name after a given name or a title shows that they are names, and then each counts
        # alone as well.
        self.names = re.compile(
            rf"(?<!\w)(?:(?P<title>{title})\.?\s+)?(?:(?P<given>{given})\s+)?(?P<family>{family})(?!\w)|"
            rf"(?<!\w)(?P<alone>{given})(?!\w)")
        self.titled = re.compile(rf"(?<!\w)(?:{title})(?:\.[ \t]*|[ \t]+)(?P<first>{NAME})(?:[ \t]+(?P<second>{NAME}))?")
        self.name = re.compile(NAME)
        # Numbers with a plus or a word before them.
        self.plain_phone = re.compile(
            rf"(?:(?<![\w+.-])\+|(?<!\w)(?:{'|'.join(PHONE_WORDS)})\b[.:]?[ \t]{{0,2}})"
            rf"(?P<number>[0-9]{{{PHONE_DIGITS[0]},{PHONE_DIGITS[1]}}})(?!\w|\.[0-9]|-[0-9])", re.IGNORECASE)

    def replacement(self, kind: str, value: str) -> str:
        found = self.known.get((kind, value))
        if found is None:
            found = getattr(self, "_" + kind)(value)
            if len(self.known) >= 100_000:
                self.known.clear()
            self.known[kind, value] = found
        return found

    def _email(self, value: str) -> str:
        """Dots and signs of the part before @ stay. Domains become names under ``.example``, those under it
        as well, so that no real address comes out and no two domains become one; example.com, .org and .net, to which
        no other becomes, stay."""
        local, _, domain = value.partition("@")
        labels = fold(domain).split(".")
        if labels[-2:] in (["example", "com"], ["example", "org"], ["example", "net"]):
            changed = domain
        else:
            new = ".".join([*(self.keyed.text("label", label) for label in labels[:-1]), labels[-1]])
            changed = in_case_of(domain, new) + ".example"
        return in_case_of(local, self.keyed.text("email", fold(local))) + "@" + changed

    def _ipv4(self, value: str) -> str:
        return str(ipaddress.IPv4Address(bytes(self.keyed.following("ipv4", list(ipaddress.IPv4Address(value).packed), [256] * 4))))

    def _ipv6(self, value: str) -> str:
        return str(ipaddress.IPv6Address(bytes(self.keyed.following("ipv6", list(ipaddress.IPv6Address(value).packed), [256] * 16))))

    def _card(self, value: str) -> str:
        first = self.keyed.text("card", digits_of(value)[:-1])
        return with_digits(value, first + str(luhn(first)))

    def _iban(self, value: str) -> str:
        plain = entity("iban", value)
        body = self.keyed.text("iban", plain[4:])
        new = iter(plain[:2] + iban_check(plain[:2], body) + body)
        return "".join(" " if c == " " else next(new) for c in value)

    def _ssn(self, value: str) -> str:
        return with_digits(value, self.keyed.text("ssn", digits_of(value)))

    def _phone(self, value: str) -> str:
        """Country and area codes stay: what stands before the last seven digits. These become the same with and
        without the codes."""
        digits = digits_of(value)
        return with_digits(value, digits[:-7] + self.keyed.text("phone", digits[-7:]))

    def _given(self, value: str) -> str:
        if fold(value) not in self.person:
            return self._unlisted("given", value, self.person)
        gender, script = self.person[fold(value)]
        return self.keyed.name(f"given {gender} {script}", GIVEN[gender, script], value)

    def _family(self, value: str) -> str:
        if fold(value) not in self.family:
            return self._unlisted("family", value, self.family)
        script = self.family[fold(value)]
        return self.keyed.name(f"family {script}", FAMILY[script], value)

    def _unlisted(self, kind: str, value: str, listed: dict) -> str:
        """The next in the key's order that is in no list either, so that it is no listed name's surrogate."""
        new = self.keyed.text(kind, fold(value))
        while new in listed:
            new = self.keyed.text(kind, new)
        return in_case_of(value, new)

    def _run_end(self, text: str, start: int) -> int:
        """Where the numbers from ``start`` on end, or an address among them begins."""
        end = self.run.match(text, start).end()
        for n in self.number.finditer(text, start, end):
            if self.apart.match(text, n.start()):
                return n.start()
        return end

    def _in_run(self, text: str, start: int, end: int) -> list[tuple[str, int, int]]:
        """The cards, social security and phone numbers in a run of numbers: those parts between separators
        that have the most digits of usual cards, then the most digits, then are fewest."""
        numbers = [n.span() for n in self.number.finditer(text, start, end)]
        signs, counts = [], [0]  # where each number begins with its signs, and the digits before it
        for a, b in numbers:
            counts.append(counts[-1] + b - a)
            while a > start and text[a - 1] in "(+":
                a -= 1
            signs.append(a)
        # Sums for check digits, with the digits at even or at odd places counted twice.
        sums = [0], [0]
        for at, n in enumerate(int(c) for a, b in numbers for c in text[a:b]):
            twice = 2 * n - 9 if n > 4 else 2 * n
            for odd in (0, 1):
                sums[odd].append(sums[odd][-1] + (twice if at % 2 == odd else n))
        best: list[tuple[tuple[int, int, int], tuple[str, int] | None]] = [((0, 0, 0), None)] * (len(numbers) + 1)
        for k in range(len(numbers) - 1, -1, -1):
            best[k] = (best[k + 1][0], None)
            if signs[k] > start and text[signs[k] - 1] == ".":  # decimals
                continue
            for last in range(k, len(numbers)):
                until = counts[last + 1]
                digits = until - counts[k]
                if digits > 19:
                    break
                if digits < PHONE_DIGITS[0] or self.goes_on.match(text, numbers[last][1]):
                    continue
                checks = (sums[until % 2][until] - sums[until % 2][counts[k]]) % 10 == 0
                found = next((kind for kind, p, least, most in self.parts if least <= digits <= most and (checks or kind != "card")
                              and p.fullmatch(text, signs[k], numbers[last][1]) and _valid(kind, text[signs[k]:numbers[last][1]])), None)
                if found:
                    usual = found == "card" and self.usual_card.fullmatch(text, signs[k], numbers[last][1])
                    of = best[last + 1][0]
                    score = (of[0] + (digits if usual else 0), of[1] + digits, of[2] - 1)
                    if score > best[k][0]:
                        best[k] = (score, (found, last))
        spans, k = [], 0
        while k < len(numbers):
            if best[k][1] is None:
                k += 1
            else:
                kind, last = best[k][1]
                spans.append((kind, signs[k], numbers[last][1]))
                k = last + 1
        return spans

    def entities(self, text: str) -> list[Entity]:
        """Entities from left to right, none overlapping."""
        spans, at = [], 0
        while (m := self.pattern.search(text, at)) if self.marks.search(text, at) else None:
            kind, at = m.lastgroup, m.end()
            if kind == "iban" and not _valid(kind, m[0]):
                # It may have taken words after it; else the next group may begin something.
                ends = [n for n in range(m.end() - 1, m.start(), -1) if text[n] == " "]
                end = next((n for n in ends if _valid(kind, text[m.start():n])), None)
                at = end or min([m.end(), *ends])
                spans += [(kind, m.start(), end)] if end else []
            elif kind == "ipv6" and not _valid(kind, m[0]):
                at = next((n for n in range(m.start() + 1, m.end()) if text[n] == ":"), m.end())
            elif kind in ("card", "ssn", "phone"):
                end = self._run_end(text, m.start())
                if end == m.end() and _valid(kind, m[0]):
                    spans.append((kind, *m.span()))
                else:
                    spans += self._in_run(text, m.start(), end)
                    at = max(end, m.start() + 1)
            else:
                spans.append((kind, *m.span()))
        if self.marks.search(text):
            spans += [("phone", *m.span("number")) for m in self.plain_phone.finditer(text)]
        if not self.openers.isdisjoint(self.words.findall(text)):
            matches = list(self.names.finditer(text))
            sure = {fold(m[g]) for m in matches if m["family"] and (m["title"] or m["given"]) for g in ("given", "family") if m[g]}
            spans += [("family" if g == "family" else "given", *m.span(g))
                      for m in matches for g in ("given", "family", "alone") if m[g] and fold(m[g]) in sure]
            spans += self._titled(text)
        out: list[Entity] = []
        for kind, start, end in sorted(spans, key=lambda s: (s[1], -s[2])):
            if not out or start >= out[-1].end:
                out.append(Entity(kind, start, end, self.replacement(kind, text[start:end])))
        return out

    def _titled(self, text: str) -> list[tuple[str, int, int]]:
        """Names after titles, in any list or none: one capitalised word is a family name, of two the second is, unless the
        first is known to be one. Where these words stand without a title they are names as well."""
        kinds: dict[str, str] = {}
        for m in self.titled.finditer(text):
            first, second = m["first"], m["second"] or ""
            if not first[0].isupper() or not any(c in k for c in fold(first) for k in ALPHABETS):
                continue
            if second[:1].isupper() and any(c in k for c in fold(second) for k in ALPHABETS) and (
                    fold(first) not in self.family or fold(first) in self.person):
                kinds.setdefault(fold(first), "given")
                kinds.setdefault(fold(second), "family")
            else:
                kinds.setdefault(fold(first), "family")
        if not kinds:
            return []
        return [(kinds[fold(m[0])], *m.span()) for m in self.name.finditer(text) if m[0][0].isupper() and fold(m[0]) in kinds]

    def rewrite(self, text: str) -> tuple[str, list[Entity]]:
        found = self.entities(text)
        parts, at = [], 0
        for e in found:
            parts += [text[at:e.start], e.surrogate]
            at = e.end
        self._check(text, found)
        return "".join([*parts, text[at:]]), found

    @staticmethod
    def _check(text: str, found: list[Entity]) -> None:
        """No two entities of a text share a surrogate, none keeps its own, and each has one."""
        pairs = {(e.kind, entity(e.kind, text[e.start:e.end]), entity(e.kind, e.surrogate)) for e in found}
        if len({p[:2] for p in pairs}) != len(pairs) or len({(p[0], p[2]) for p in pairs}) != len(pairs) or any(p[1] == p[2] for p in pairs):
            raise ValueError("surrogates collide")


def pseudonymised(docs: DataFrame, key: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every whole text with surrogates: ``doc_id``, ``text`` and ``entities``, the spans of each entity
    in the old and in the new text (characters, end exclusive).

    Kinds: email, ipv4, ipv6, iban, card (with their check digits right again), ssn, phone (country and area
    codes stay), given and family names of the lists (gender and script stay) and after titles (script stays). A value
    written in several ways has one surrogate, written in these ways. One key gives the same
    surrogates in all runs; keep it secret, it undoes them. Null and empty texts become empty; every
    row is rewritten, repeated ones alike; other columns are not looked at.
    """

    def make():
        surrogates = Surrogates(key)

        def step(text):
            new, found = surrogates.rewrite(text)
            shift, rows = 0, []
            for e in found:
                start = e.start + shift
                rows.append({"kind": e.kind, "start": e.start, "end": e.end, "new_start": start, "new_end": start + len(e.surrogate)})
                shift += len(e.surrogate) - (e.end - e.start)
            return new, rows
        return step

    return map_texts(docs, make, RESULT, id_col, text_col)

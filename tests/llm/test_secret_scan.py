import hashlib
import math
import random
from collections import Counter

import regex

from cases import TEXTS, documents, plain
from martbrook.llm import secret_scan as ss
from martbrook.llm.queries import QUERIES


def entropy(text):
    return -sum(n / len(text) * math.log2(n / len(text)) for n in Counter(text).values())


def test_windows_as_counted_anew():
    pick = random.Random(4)
    for _ in range(300):
        text = "".join(pick.choice("abcdefgh01234567"[:pick.choice([2, 8, 16])]) for _ in range(pick.randint(0, 60)))
        window, least = pick.choice([4, 8, 20]), pick.choice([1.0, 2.0, 2.9, 3.5])
        covered = {p for k in range(len(text) - window + 1) if entropy(text[k:k + window]) >= least - 1e-9 for p in range(k, k + window)}
        found = list(ss.random_windows(text, window, least))
        assert {p for a, b in found for p in range(a, b)} == covered
        assert all(b < c for (_, b), (c, _) in zip(found, found[1:]))


def test_base_kinds():
    scan = ss.scanner()
    base = lambda text: [s for s in scan(text) if s[0] != "entropy"]
    assert base('API_KEY = "abc/12" x') == [("assign", 0, 17)]
    assert base("Password:short secret=sixsix") == [("assign", 15, 28)]
    assert base("secret=token: abcdefgh") == []  # the match with five characters takes the second word
    assert base("\u017fecret=abcdefgh to\u212aen=abcdefgh") == []  # only ASCII letters are folded
    assert base("xAKIA" + "A" * 15) == [] and base("xAKIA" + "A" * 16) == [("access", 1, 21)]
    assert base("é" + "0" * 23) == [] and base("é" + "ab" * 12 + "g") == [("hex", 1, 25)]
    hexes = "token=" + "0123456789abcdef" * 2
    assert base(hexes) == [("assign", 0, 38), ("hex", 6, 38)]


def test_entropy_spans_and_what_is_allowed():
    scan = ss.scanner()
    kinds = lambda text: [s[0] for s in scan(text) if s[0] != "hex"]
    assert "entropy" in kinds("key 9fK2xQ7LmZ4vT1bW8sRd0PyH3n end")
    assert kinds("notwithstandingthattheword") == [] and kinds("1" * 40) == [] and kinds("-" * 40) == []
    assert kinds("123E4567-E89B-12D3-A456-426614174000") == []
    assert kinds("some/path/to/a/file_name-2024-01") == []
    assert kinds("EXAMPLE9fK2xQ7LmZ4vT1bW8sRd0PyH3n") == []
    assert ss.scanner(ss.EntropyRule(allowed=(), known=()))("EXAMPLE9fK2xQ7LmZ4vT1bW8sRd0PyH3n")


def test_glued_hex_as_bare_hex():
    scan, pick, flagged = ss.scanner(), random.Random(6), 0
    random_spans = lambda text: [s[1:] for s in scan(text) if s[0] == "entropy"]
    for signs in ("0123456789ABCDEF", "0123456789abcdef"):
        for size in [20] * 100 + [32, 40, 64] * 30:
            value = "".join(pick.choice(signs) for _ in range(size))
            bare = random_spans(value)
            flagged += bool(bare)
            for text, at in ((f"DIGEST={value}", 7), (f"sig_{value}", 4), (f"{value}/x-y", 0), (f"a=b&K9-{value}==", 7)):
                glued = random_spans(text)
                assert all(any(c <= a + at and b + at <= d for c, d in glued) for a, b in bare), text
    assert flagged > 360


def test_classes_of_windows():
    scan = ss.scanner()
    random_spans = lambda text: [s[1:] for s in scan(text) if s[0] == "entropy"]
    assert random_spans("order_id9=31415926535897932384626433") == []  # a number, and it is one alone too
    assert random_spans("order31415926535897932384626433") == []
    assert random_spans("a31415926535897932384626433") == [(0, 24)]  # the rest is below 3 bits
    assert random_spans("zz3F2A3F9C71D0713F2A9C") == [(2, 22)]
    assert random_spans("v1/aInternationalisationAndSoOn/x2") == []


def test_awkward_texts(spark, tmp_path):
    texts = [*TEXTS, "é token='s3cr3tvalue' " * 3]
    docs = documents(spark, texts, folder=tmp_path)
    scan = ss.scanner()
    found = plain(ss.secret_spans(docs))
    assert [(i, [tuple(s) for s in spans]) for i, spans in found] == [(i, scan(t or "")) for i, t in enumerate(texts)]
    assert len(found[-1][1]) == 3
    assert ss.secret_spans(documents(spark, [], folder=tmp_path)).count() == 0
    assert ss.secret_spans(documents(spark, ["token=abcdefg"] * 2, [None, None], tmp_path)).count() == 2


def runs(text, signs, least, head=""):
    """Maximal runs of ``signs`` of at least so many, by going from sign to sign; from the first ``head`` of each run on."""
    out, at = [], 0
    while at < len(text):
        end = at
        while end < len(text) and text[end] in signs:
            end += 1
        start = text.find(head, at, end) if head else at
        if end > at and start >= 0 and end - start >= least:
            out.append((start, end))
        at = max(end, at + 1)
    return out


def base_spans(text):
    small, large, digits = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
    words = "|".join("".join(f"[{c}{c.upper()}]" if c in small else c for c in w) for w in ("password", "passwd", "secret", "token", "api_key", "apikey"))
    assign = regex.compile(f"(?:{words})[\"']? *[:=] *[\"']?(?<value>[{small}{large}{digits}+/_.=-]+)")
    found = [("assign", *m.span()) for m in assign.finditer(text) if len(m["value"]) >= 6]
    found += [("access", a, b) for a, b in runs(text, large + digits, 20, "AKIA")]
    found += [("hex", a, b) for a, b in runs(text, digits + "abcdef", 24)]
    return sorted(found, key=lambda s: (s[1], ("assign", "access", "hex").index(s[0])))


def test_registered_columns_of_the_whole_table(spark, tmp_path):
    """The given documents, and some that have each kind, next to other signs and to each other."""
    folder, hexes, access = str(tmp_path), "0123456789abcdef" * 2, "AKIA" + "Z9" * 9
    planted = [f"token={hexes} {access}", f"é{hexes}G{access}x", f"ApiKey: '{access}'", f"xx{hexes}AKIA{access}", hexes[:23], access[:19], "Secret=short", None]
    rows = spark.createDataFrame([(10**9 + k, t) for k, t in enumerate(planted)], "doc_id bigint, text string")
    given = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text")
    given.unionByName(rows).write.parquet(f"{folder}/documents.parquet")
    rows = {r.doc_id: r for r in QUERIES["op5_secret_scan"](spark, folder).collect()}
    docs, met = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect(), Counter()
    assert len(docs) == len(rows)
    for doc in docs:
        row, base = rows[doc.doc_id], base_spans(doc.text or "")
        told = [":".join(map(str, s)) for s in base]
        assert row.base_sha256 == hashlib.sha256(",".join(told).encode()).hexdigest()
        assert [row.n_assign, row.n_access, row.n_hex] == [sum(s[0] == k for s in base) for k in ("assign", "access", "hex")]
        spans = row.spans.split(",") if row.spans else []
        assert [s for s in spans if not s.startswith("entropy")] == told
        assert [int(s.split(":")[1]) for s in spans] == sorted(int(s.split(":")[1]) for s in spans)
        met.update(s[0] for s in base)
    assert all(met[k] for k in ("assign", "access", "hex"))

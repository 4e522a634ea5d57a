"""Secret scans: fixed patterns, and windows of high entropy in candidate strings."""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from .texts import map_texts

# The base kinds in their order, their patterns and least lengths.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
ASSIGN_LEAST = 6
KINDS = ("assign", "access", "hex", "entropy")

CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
_ALLOWED = (
    r"[A-Za-z]+|[0-9]+|[_=+/-]+",                                        # words, numbers, rulers
    r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}",               # record numbers (UUID)
    r"([A-Za-z]+|[0-9]{1,4})([_/+=-]+([A-Za-z]+|[0-9]{1,4}))*[_/+=-]*",  # paths and compound names
)
RESULT = "spans array<struct<kind: string, start: bigint, end: bigint>>"


@dataclass(frozen=True)
class EntropyRule:
    """What counts as random: least bits a sign in a window, by the signs that window consists of.

    ``hex``: only 0-9 and one case of a-f. ``alnum``: letters and digits. ``base64``: also
    ``+ / _ = -``. A candidate shorter than the window is not looked at; one that an entry of
    ``allowed`` matches as a whole, or that contains an entry of ``known``, is let through. Between
    the signs ``+ / _ = -`` of a candidate, what an entry of ``allowed`` matches is judged as part of
    the whole candidate, and digits alone are hex only next to nothing else but hex.
    """

    window: int = 20
    least: dict[str, float] = field(default_factory=lambda: {"hex": 3.0, "alnum": 3.6, "base64": 3.8})
    allowed: tuple[str, ...] = _ALLOWED
    known: tuple[str, ...] = ("EXAMPLE", "example")


def sign_class(candidate: str) -> str:
    if re.fullmatch(r"[0-9a-f]+|[0-9A-F]+", candidate):
        return "hex"
    return "alnum" if candidate.isalnum() else "base64"


_RUN = re.compile(r"[A-Za-z0-9]+")
_DIGITS, _HEXES = re.compile(r"[0-9]+"), (re.compile(r"[0-9a-f]+"), re.compile(r"[0-9A-F]+"))
CLASSES = ("base64", "alnum", "hex")


def window_classes(candidate: str, window: int, allowed: list[re.Pattern]) -> bytes:
    """For each place of a candidate the class, as its place in ``CLASSES``, of the window that begins there."""
    out = bytearray([CLASSES.index(sign_class(candidate))]) * len(candidate)

    def mark(start: int, end: int, kind: int) -> None:
        if end - start >= window:
            out[start:end - window + 1] = bytes([kind]) * (end - start - window + 1)

    for run in _RUN.finditer(candidate):
        if run.end() - run.start() < window or any(p.fullmatch(run[0]) for p in allowed):
            continue
        mark(*run.span(), 1)
        for pattern in _HEXES:
            for m in pattern.finditer(candidate, *run.span()):
                mark(*m.span(), 2)
        if sign_class(run[0]) != "hex":
            for m in _DIGITS.finditer(candidate, *run.span()):
                mark(*m.span(), 1)
    return bytes(out)


def random_windows(
    text: str, window: int, least: float | tuple[float, ...], classes: bytes | None = None,
) -> Iterable[tuple[int, int]]:
    """Unions of the windows with at least so many bits of Shannon entropy a sign; with ``classes``,
    ``least`` has the bits for each class, and the class of each window stands at its first sign.

    The counts move with the window: a step changes two of them, so a string of any length takes
    time in proportion to it.
    """
    weight = [0.0] + [n * math.log2(n) for n in range(1, window + 1)]
    counts: dict[str, int] = {}
    total = 0.0  # sum of n log n over the counts
    bounds = [window * (math.log2(window) - bits) + 1e-9 for bits in (least if classes else (least,))]
    classes = classes or bytes(len(text))
    start = end = -1
    for at, sign in enumerate(text):
        if at >= window:
            gone = text[at - window]
            n = counts[gone]
            counts[gone] = n - 1
            total += weight[n - 1] - weight[n]
        n = counts.get(sign, 0)
        counts[sign] = n + 1
        total += weight[n + 1] - weight[n]
        if at >= window - 1 and total <= bounds[classes[at + 1 - window]]:
            first = at + 1 - window
            if first > end:
                if end >= 0:
                    yield start, end
                start = first
            end = at + 1
    if end >= 0:
        yield start, end


def scanner(rule: EntropyRule = EntropyRule()) -> Callable[[str], list[tuple[str, int, int]]]:
    """A function from a text to its spans (kind, start, end), in characters, end exclusive."""
    allowed = [re.compile(p) for p in rule.allowed]
    order = {kind: n for n, kind in enumerate(KINDS)}
    least = tuple(rule.least[name] for name in CLASSES)

    def scan(text: str) -> list[tuple[str, int, int]]:
        found = [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
        found += [("access", *m.span()) for m in ACCESS.finditer(text)]
        found += [("hex", *m.span()) for m in HEX.finditer(text)]
        for m in CANDIDATE.finditer(text):
            candidate = m[0]
            if any(p.fullmatch(candidate) for p in allowed) or any(k in candidate for k in rule.known):
                continue
            classes = window_classes(candidate, rule.window, allowed)
            for start, end in random_windows(candidate, rule.window, least, classes):
                found.append(("entropy", m.start() + start, m.start() + end))
        return sorted(found, key=lambda s: (s[1], order[s[0]]))

    return scan


def secret_spans(
    docs: DataFrame, rule: EntropyRule = EntropyRule(), id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Secrets of every whole text: ``doc_id``, ``spans`` (kind, start, end by start, then kind).

    ``assign``, ``access`` and ``hex`` are the leftmost matches of the fixed patterns, found apart
    from each other, so they may overlap. ``entropy`` adds what looks random inside longer
    strings. Null and empty texts have no spans; every row is scanned, repeated ones too; other
    columns are not looked at.
    """

    def make():
        scan = scanner(rule)
        return lambda text: ([{"kind": k, "start": a, "end": b} for k, a, b in scan(text)],)

    return map_texts(docs, make, RESULT, id_col, text_col)

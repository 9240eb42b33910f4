"""Personal data: format rules, and boosted trees over spans that generous generators propose.

The rules find e-mail addresses, IPv4 addresses, card numbers and telephone numbers; what they
find always stays. Generators propose further, overlapping spans around digits and ``@``: the bare
chunk, all values behind ``=`` or ``:``, and neighbouring digit chunks taken together. Trees score each by
its format and by the text before it, a threshold per kind chosen on held-out examples selects,
and of selected spans that overlap the best one stays.

The trees learn from at most about ``SAMPLE_TEXTS`` texts that hold a digit or ``@``, chosen by
hash, and from examples written by rule. In the sampled texts, proposals on a rule's span are positive;
short ones with a letter elsewhere are negative, unless a credential's or contact's name stands before them. Everything else covers all rows.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayer.llm.boosting import BoostedTrees

SAMPLE_TEXTS = 4000
SPANS_A_TEXT = 20  # of the sampled texts' spans, so many for each text on average are learnt from
LONGEST_TAIL = 512
PRECISION = 0.995
BASE_KINDS = ("email", "ip", "card", "phone")
ADDED_KINDS = ("secret", "contact", "number")
KINDS = BASE_KINDS + ADDED_KINDS

_DIGITS = re.compile(r"[0-9]+")
_IP = re.compile(r"[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_SIGN = re.compile(r"[0-9@]")
_SPACE = re.compile(r"\s")
_KEY = re.compile(r"[A-Za-z_-]{2,20}[\"']?[=:][\"']?")
_VALUE = re.compile(r"[^\s\"'=]{6,}")
_NUMBER_START = re.compile(r"(?<![0-9])\(?[0-9]{2,5}")
_CREDENTIAL = re.compile(
    r"(?:pass(?:word|wd|phrase)?|pwd|token|secret|api[_-]?key|credentials?)[\"']?\s{0,2}[=:]\s{0,2}[\"']?([^\s\"'=]{6,})", re.I
)
_NUMBER_PARTS = re.compile(r"\(?[0-9]{2,5}\)?(?:[ ./-]\(?[0-9]{2,9}(?![0-9])\)?){1,5}")
_NAMES = re.compile(
    r"(pass(word|wd|phrase)?|pwd|token|secret|api|key|auth\w*|credential\w*|bearer|login)\W{0,4}$", re.I
)
_REACH = re.compile(r"(tel|phone|fon|mobile|call|fax|mail|contact|card|iban|account|ssn)\W{0,4}$", re.I)


def luhn(number: str) -> bool:
    digits = [int(c) for c in reversed(number)]
    return sum(digits[::2] + [d * 2 - 9 * (d > 4) for d in digits[1::2]]) % 10 == 0


def digits_of(text: str) -> str:
    return "".join(_DIGITS.findall(text))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """``(kind, start, end)`` of the four rules, leftmost first and apart within a kind."""
    found, done = [], 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            done = domain.end()
            found.append(("email", start, done))
        at = text.find("@", max(at + 1, done))
    ip_end = card_end = 0
    for run in _DIGITS.finditer(text):
        start = run.start()
        if start >= ip_end and (m := _IP.match(text, start)):
            ip_end = m.end()
            if all(len(p) <= 3 and int(p) <= 255 for p in (q.lstrip("0") or "0" for q in m[0].split("."))):
                found.append(("ip", start, ip_end))
        if start >= card_end and (m := _CARD.match(text, start)):
            card_end = m.end()
            number = digits_of(m[0])
            if 14 <= len(number) <= 19 and luhn(number):
                found.append(("card", start, card_end))
    at = text.find("+")
    while at >= 0:
        m = _PHONE.match(text, at)
        if m and 10 <= len(digits_of(m[0])) <= 15:
            found.append(("phone", at, m.end()))
        at = text.find("+", m.end() if m else at + 1)
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def proposals(text: str) -> list[tuple[str, int, int]]:
    """Overlapping spans around every chunk that has a digit or ``@``, and values of any kind behind credential names.

    Every key's value up to the next key is proposed; what runs on over the next key only behind a chunk's first key
    or if it has at most ``LONGEST_TAIL`` characters, as such spans lie in one another.
    """
    out, at = [], 0

    def add_value(left: int, right: int) -> None:
        while right > left and text[right - 1] in ".,;:!?)}]&":
            right -= 1
        if right - left >= 6 and ("secret", left, right) not in out[-4:]:
            out.append(("secret", left, right))

    while m := _SIGN.search(text, at):
        start = m.start()
        while start > at and not text[start - 1].isspace():
            start -= 1
        space = _SPACE.search(text, m.start())
        end = space.start() if space else len(text)
        left, right = start, end
        while left < right and not (text[left].isalnum() or text[left] in "+@"):
            left += 1
        while right > left and not text[right - 1].isalnum():
            right -= 1
        if right - left >= 6:
            out.append(("contact" if "@" in text[left:right] else "secret", left, right))
        keys = list(_KEY.finditer(text, start, end))
        for i, key in enumerate(keys):
            value = _VALUE.match(text, key.end(), end)
            if value:
                following = keys[i + 1].start() if i + 1 < len(keys) else end
                add_value(value.start(), min(value.end(), following))
                if following < value.end() and (i == 0 or value.end() - value.start() <= LONGEST_TAIL):
                    add_value(value.start(), value.end())
        done = start
        for first in _NUMBER_START.finditer(text, start, end):
            number = _NUMBER_PARTS.match(text, first.start()) if first.start() >= done else None
            if number:
                done = number.end()
                if 7 <= len(digits_of(number[0])) <= 19:
                    out.append(("number", number.start(), done))
        at = max(end, m.start() + 1)
    for named in _CREDENTIAL.finditer(text):
        if not _SIGN.search(named[1]):
            add_value(*named.span(1))
    return out


def describe(text: str, kind: str, start: int, end: int) -> list[float]:
    """Format and context of a span as numbers; long spans are described by counts alone."""
    span, before = text[start:end], text[max(0, start - 24) : start]
    n = end - start
    digit = sum(c in "0123456789" for c in span)
    upper = sum(c.isupper() for c in span)
    lower = sum(c.islower() for c in span)
    hexa = sum(c in "0123456789abcdefABCDEF" for c in span)
    kinds = "".join("d" if c in "0123456789" else "l" if c.isalpha() else "o" for c in span)
    turns = sum(a != b for a, b in zip(kinds, kinds[1:]))
    counts = np.unique(list(span), return_counts=True)[1]
    entropy = float(-(counts / n * np.log2(counts / n)).sum())
    return [
        min(n, 200), digit, digit / n, upper / n, lower / n, (n - digit - upper - lower) / n, hexa / n, turns,
        turns / n, entropy, len(counts) / n, span.count("@"), span.count("."), span.count("-"),
        float(bool(_NAMES.search(before))), float(bool(_REACH.search(before))), float(before[-1:] in ('"', "'")),
        float("=" in before[-4:] or ":" in before[-4:]), float(kind == "number"), float(kind == "contact"),
        float(14 <= digit <= 19 and luhn(digits_of(span))),
    ]


def written_examples(count: int, seed: int) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """Spans written by rule: credentials and contacts (1), versions, dates, sums and labels (0)."""
    rng = np.random.default_rng(seed)
    pick = lambda letters, n: "".join(rng.choice(list(letters), n))
    low, up, dig = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
    size = lambda a, b: int(rng.integers(a, b))
    word = lambda: pick(low, size(2, 9))
    number = lambda a, b: str(size(a, b))
    positive = [
        ("secret", lambda: ("", pick("0123456789abcdef", size(16, 65)))),
        ("secret", lambda: ("", pick(up, 4) + pick(up + dig, size(12, 30)))),
        ("secret", lambda: ("", word()[:3] + "_" + pick(low + up + dig, size(16, 45)))),
        ("secret", lambda: (str(rng.choice(["password=", "token: ", 'secret = "', "api_key=", "pwd:"])), pick(low + up + dig, size(8, 40)))),
        ("secret", lambda: (str(rng.choice(["password: ", "passphrase=", "pwd: "])), "-".join([word() + "ab", word(), word()]))),
        ("secret", lambda: (str(rng.choice(["token: ", '"api_key":"', "secret="])), pick(low + up, size(12, 40)))),
        ("contact", lambda: ("", f"{word()}.{word()}@{word()}")),
        ("contact", lambda: ("mail: ", f"{word()}@{word()}.{word()[:2]}")),
        ("number", lambda: ("", f"({number(200, 999)}) {number(200, 999)}-{number(1000, 9999)}")),
        ("number", lambda: ("tel. ", f"{number(100, 9999)} {number(100, 999)} {number(1000, 9999)}")),
    ]
    negative = [
        ("secret", lambda: ("version ", f"{number(0, 20)}.{number(0, 30)}.{number(0, 999)}")),
        ("secret", lambda: ("", f"{number(1900, 2100)}-{number(10, 13)}-{number(10, 29)}")),
        ("secret", lambda: ("", f"{word()}{word()}{number(1, 99)}")),
        ("secret", lambda: ("", f"{number(1, 999)},{number(100, 999)}.{number(10, 99)}")),
        ("secret", lambda: ("", f"{word()}-{word()}-{number(1, 30)}")),
        ("secret", lambda: ("", f"http://{word()}.{word()}/{word()}/{number(1, 9999)}")),
        ("secret", lambda: ("", number(100_000, 99_999_999))),
        ("secret", lambda: (str(rng.choice(["password: ", "token: "])), pick(low, size(6, 9)))),
        ("contact", lambda: ("", f"{word()} @{word()}"[-6:])),
        ("number", lambda: ("", f"{number(1900, 2100)}-{number(10, 13)}-{number(10, 32)}")),
        ("number", lambda: ("", f"{number(1900, 2100)} {number(1900, 2100)} {number(10, 99)}")),
    ]
    rows, labels, kinds = [], [], []
    for label, makers in ((1, positive), (0, negative)):
        for i in range(count):
            kind, make = makers[i % len(makers)]
            lead, span = make()
            text = f"{word()} {word()} {lead}{span} {word()}"
            start = len(text) - len(text.rsplit(" ", 1)[1]) - 1 - len(span)
            rows.append(describe(text, kind, start, start + len(span)))
            labels.append(label)
            kinds.append(kind)
    return np.array(rows), np.array(labels), kinds


@dataclass
class SpanModel:
    trees: BoostedTrees
    thresholds: dict[str, float]


def learn(documents: DataFrame, text_column: str = "text", sample: int = SAMPLE_TEXTS, seed: int = 7) -> SpanModel:
    """Fit the trees and choose, per kind, the least threshold with held-out precision ``PRECISION``.

    Some ``sample`` texts are learnt from, and of their spans the ``SPANS_A_TEXT * sample`` with the least hashes. With no texts the written examples alone are learnt.
    """
    texts = documents.select(F.col(text_column).alias("text")).where(F.col("text").rlike("[0-9@]"))
    total = max(1, texts.count())
    chosen = texts.where(F.xxhash64("text").cast("double") / 2.0**64 + 0.5 < sample / total)

    def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for text in batch["text"]:
                base = base_spans(text)
                inside = Spans([(s, e) for _, s, e in base])
                for kind, s, e in proposals(text):
                    cover = list(inside.touching(s, e))
                    whole = any(a - 3 <= s and e <= b + 3 for a, b in cover)
                    short = e - s < 14 and any(c.isalpha() for c in text[s:e])
                    before = text[max(0, s - 24) : s]
                    if whole or not cover and short and not (_NAMES.search(before) or _REACH.search(before)):
                        rows.append((kind, float(whole), describe(text, kind, s, e)))
            yield pd.DataFrame(rows, columns=["kind", "label", "x"])

    schema = "kind string, label double, x array<double>"
    spans = chosen.mapInPandas(features, schema)
    seen = spans.orderBy(F.xxhash64("kind", "label", "x"), "kind", "label", "x").limit(SPANS_A_TEXT * sample).toPandas()
    x, y, kinds = written_examples(4000, seed)
    if len(seen):
        x = np.vstack([x, np.stack(seen["x"])])
        y, kinds = np.r_[y, seen["label"]], kinds + seen["kind"].tolist()
    held = np.random.default_rng(seed).random(len(y)) < 0.3
    trees = BoostedTrees().fit(x[~held], y[~held], np.ones((~held).sum()))
    scores, kinds = trees.predict(x[held]), np.array(kinds)[held]
    thresholds = {}
    for kind in ADDED_KINDS:
        own = kinds == kind
        order = np.argsort(-scores[own], kind="stable")
        right = y[held][own][order].cumsum()
        enough = np.flatnonzero(right >= PRECISION * np.arange(1, len(order) + 1))
        thresholds[kind] = max(0.5, float(scores[own][order][enough[-1]])) if len(enough) else 2.0
    return SpanModel(trees, thresholds)


class Spans:
    """Spans sorted by start, with the greatest end so far, to find those that overlap another one."""

    def __init__(self, spans: list[tuple[int, int]]):
        self.spans = sorted(spans)
        self.starts = [s for s, _ in self.spans]
        self.reach = list(accumulate((e for _, e in self.spans), max))

    def touching(self, start: int, end: int) -> Iterator[tuple[int, int]]:
        i = bisect_left(self.starts, end)
        while i and self.reach[i - 1] > start:
            i -= 1
            if self.spans[i][1] > start:
                yield self.spans[i]


def added_spans(texts: list[str], bases: list[list], model: SpanModel) -> list[list[tuple[str, int, int, float]]]:
    """Selected proposals of each text that touch no rule's span and none with a higher score; a whole number goes before parts of it."""
    place, rows = [], []
    for i, (text, base) in enumerate(zip(texts, bases)):
        known = Spans([(a, b) for _, a, b in base])
        for kind, s, e in proposals(text):
            if not any(known.touching(s, e)):
                place.append((i, kind, s, e))
                rows.append(describe(text, kind, s, e))
    out: list[list] = [[] for _ in texts]
    if not rows:
        return out
    scores = model.trees.predict(np.array(rows))
    numbers: list[list] = [[] for _ in texts]
    for k, (i, kind, s, e) in enumerate(place):
        if kind == "number" and scores[k] >= model.thresholds[kind]:
            numbers[i].append((s, e))
    whole, taken = [Spans(n) for n in numbers], [[] for _ in texts]
    for k in sorted(range(len(rows)), key=lambda k: (-scores[k], place[k])):
        i, kind, s, e = place[k]
        part = any(
            (a, b) != (s, e) and (a <= s and e <= b or kind != "number" and (s < a < e < b or a < s < b < e))
            for a, b in whole[i].touching(s, e)
        )
        if scores[k] >= model.thresholds[kind] and not part:
            at = bisect_left(taken[i], (e,))
            if not at or taken[i][at - 1][1] <= s:
                taken[i].insert(at, (s, e))
                out[i].append((kind, s, e, float(scores[k])))
    return [sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]))) for spans in out]


def scan(texts: list[str], model: SpanModel) -> tuple[list[list], list[list]]:
    bases = [base_spans(t) for t in texts]
    return bases, added_spans(texts, bases, model)


def find_spans(
    documents: DataFrame, model: SpanModel, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``doc_id, base, added`` per row: arrays of ``(kind, start, end[, score])``, in code points.

    A null text has no spans. Rows are neither joined nor shuffled; other columns are ignored.
    """
    source = documents.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    span = [("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]
    base_type = pa.list_(pa.struct(span))
    added_type = pa.list_(pa.struct([*span, ("score", pa.float64())]))
    names = ("kind", "start", "end", "score")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bases, added = scan([t or "" for t in batch.column(1).to_pylist()], model)
            as_rows = lambda lists: [[dict(zip(names, s)) for s in spans] for spans in lists]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(as_rows(bases), base_type), pa.array(as_rows(added), added_type)],
                ["doc_id", "base", "added"],
            )

    kind = source.schema["doc_id"].dataType.simpleString()
    fields = "kind: string, start: bigint, end: bigint"
    schema = f"doc_id {kind}, base array<struct<{fields}>>, added array<struct<{fields}, score: double>>"
    return source.mapInArrow(run, schema)


def redact(documents: DataFrame, model: SpanModel, text_column: str = "text") -> DataFrame:
    """The same rows with each found span replaced by its kind in brackets; null texts stay null."""
    schema, at = documents.schema, documents.columns.index(text_column)

    def cover(text: str, spans: list[tuple]) -> str:
        parts, done = [], 0
        for kind, start, end, *_ in sorted(spans, key=lambda s: (s[1], -s[2])):
            if start >= done:
                parts += [text[done:start], f"[{kind}]"]
            done = max(done, end)
        return "".join([*parts, text[done:]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(at).to_pylist()
            bases, added = scan([t or "" for t in texts], model)
            clean = [t if t is None else cover(t, b + a) for t, b, a in zip(texts, bases, added)]
            yield batch.set_column(at, text_column, pa.array(clean, batch.schema.field(at).type))

    return documents.mapInArrow(run, schema)

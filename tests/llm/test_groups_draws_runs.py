"""SimHash groups, importance resampling and periodic runs against brute force."""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter
from fractions import Fraction
from hashlib import sha256

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from assayer.llm import importance, periodic_runs, simhash_groups
from assayer.llm.components import connected
from assayer.llm.entries import op13_periodic_runs
from tests.llm.conftest import SCHEMA, document

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
LOW = lambda t: re.sub(rb"[A-Z]", lambda m: m[0].lower(), (t or "").encode())


# SimHash groups


def brute_fingerprint(text):
    words = WORD.findall(LOW(text))
    runs = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(r, 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_least(marks):
    """Least index reachable over links of at most three bits."""
    least = list(range(len(marks)))
    changed = True
    while changed:
        changed = False
        for i, x in enumerate(marks):
            low = min(least[j] for j, y in enumerate(marks) if (x ^ y).bit_count() <= 3)
            if low < least[i]:
                least[i], changed = low, True
    return least


def test_halves_are_covered():
    rng = np.random.default_rng(5)
    halves = rng.integers(0, 1 << 32, 400, np.uint64).astype(np.uint32)
    halves = np.concatenate([halves, [0, 0xFFFFFFFF, 0x80000000]]).astype(np.uint32)
    for half in halves:
        around = np.array([half] + [half ^ np.uint32(1 << i) for i in range(32)], np.uint32)
        owner, anchor, resident = simhash_groups.anchors(around)
        assert np.bitwise_count(around[owner] ^ anchor).max() <= 2
        assert np.bitwise_count(around[owner[resident]] ^ anchor[resident]).max() <= 1
        assert np.bincount(owner).max() <= 17
        assert set(anchor[resident].tolist()) <= set(anchor[owner == 0].tolist())


def test_simhash_groups(documents, nothing):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    marks = [brute_fingerprint(t) for _, t in rows]
    least = brute_least(marks)
    ids = [[i for (i, _), c in zip(rows, least) if c == group and i is not None] for group in least]
    expected = Counter((i, f"{m:016x}", min(g, default=None)) for (i, _), m, g in zip(rows, marks, ids))
    got = simhash_groups.near_groups(documents).collect()
    assert Counter((r.doc_id, r.fingerprint, r.component_id) for r in got) == expected
    assert simhash_groups.near_groups(nothing).collect() == []


@pytest.mark.parametrize("crowd", [4, 40, 4096])
def test_links_of_crowded_anchors(spark, crowd):
    """Chains, dense groups and lone fingerprints that share their anchors; blocks of any size connect the same."""
    rng = random.Random(11)
    marks = set()
    for _ in range(6):
        centre = rng.getrandbits(64)
        for _ in range(40):
            marks.add(centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 3))))
        # one half stays, the other differs in many bits: crowded anchors without links
        for _ in range(40):
            marks.add(centre & 0xFFFFFFFF | rng.getrandbits(32) << 32)
        at = centre
        for _ in range(20):
            at ^= sum(1 << b for b in rng.sample(range(64), 3))
            marks.add(at)
    marks = sorted(marks)
    least = brute_least(marks)
    signed = [int(np.uint64(m).astype(np.int64)) for m in marks]
    classes = spark.createDataFrame([(s,) for s in signed], "mark long")
    links = simhash_groups.near_links(classes, crowd=crowd)
    named = {r.node: r.label for r in connected(links).collect()}
    groups = {}
    for s, group in zip(signed, least):
        groups.setdefault(group, []).append(s)
    for group in groups.values():
        assert {named.get(s, s) for s in group} == {min(group)}


def test_threshold_is_bounded(spark):
    with pytest.raises(ValueError):
        simhash_groups.near_links(spark.createDataFrame([(1,)], "mark long"), threshold=4)


def test_long_texts_count_all_runs():
    text = " ".join(random.Random(4).choices("abcdefgh", k=3000))
    assert int(simhash_groups.fingerprints([text.encode()])[0]) == brute_fingerprint(text)


# importance resampling

TOKEN = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute_features(text):
    words = TOKEN.findall(LOW(text))
    runs = [b" ".join(words[i : i + k]) for k in (1, 2, 3) for i in range(len(words) - k + 1)]
    return len(words), [zlib.crc32(r) % 10_000 for r in runs]


def brute_resample(rows, target, share, least_words):
    raw, wanted = Counter(), Counter()
    for _, text in rows:
        raw.update(brute_features(text)[1])
    for text in target:
        wanted.update(brute_features(text)[1])
    s_all, t_all = raw.total(), wanted.total()
    gain = lambda b: math.floor(
        1000 * math.log((wanted[b] + 1.0) * (s_all + 10_000.0) / ((raw[b] + 1.0) * (t_all + 10_000.0)))
    )
    out = []
    for doc_id, text in rows:
        n, buckets = brute_features(text)
        h = int(sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        weight = sum(map(gain, buckets))
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([doc_id, n, len(buckets), weight, score, None])
    able = [r for r in out if r[1] >= least_words]
    able.sort(key=lambda r: (-r[4], r[0] is None, r[0], r[2], r[3]))
    for rank, row in enumerate(able[: math.floor(share * len(able))], 1):
        row[5] = rank
    return Counter(map(tuple, out))


def test_features_of_odd_words():
    texts = [None, "", "A", "a_b C`d {e} 0:1", "é à\x7fñ x", "x" * 1000 + " y " + "z" * 70 + " " + "w" * 64 + " v"]
    sizes, owner, bucket = importance.features([t if t is None else t.encode() for t in texts])
    for i, text in enumerate(texts):
        n, buckets = brute_features(text)
        assert sizes[i] == n and sorted(bucket[owner == i].tolist()) == sorted(buckets)


@pytest.mark.parametrize("share, least_words", [(Fraction(1, 3), 1), (Fraction(1, 2), 20), (Fraction(1), 0), (Fraction(0), 5)])
def test_resample(spark, documents, share, least_words, monkeypatch):
    monkeypatch.setattr(importance, "ROWS_PER_TASK", 4)
    target = spark.createDataFrame([("two words é",), (None,), ("x y again",)], "text string")
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    got = importance.resample(documents, target, share=share, least_words=least_words).collect()
    expected = brute_resample(rows, [r.text for r in target.collect()], share, least_words)
    assert Counter(map(tuple, got)) == expected


def test_empty_tables(nothing, documents):
    assert importance.resample(nothing, documents).collect() == []
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    got = importance.resample(documents, nothing).collect()
    assert Counter(map(tuple, got)) == brute_resample(rows, [], Fraction(5, 100), 20)


@pytest.mark.parametrize("error", [0.001, 0.2, 0.6])
def test_bracket_and_ranks_with_ties(spark, error, monkeypatch):
    """Many equal scores around the cutoff, equal ids with equal scores, ids that are null."""
    monkeypatch.setattr(importance, "ROWS_PER_TASK", 100)
    rng = random.Random(2)
    rows = [(rng.choice([None, *range(300)]), 25, 5, 7, rng.choice([1, 2, 2, 2, 3, -4])) for _ in range(1000)]
    scored = spark.createDataFrame(rows, "doc_id long, n_words long, n_features long, weight long, score long")
    scored = scored.repartition(5).cache()
    for wanted in (1, 150, 170, 500, 999, 1000):
        got = importance.draw(scored, Fraction(wanted, 1000), error=error).collect()
        drawn = sorted((r for r in got if r.rank), key=lambda r: r["rank"])
        best = sorted(rows, key=lambda r: (-r[4], r[0] is None, r[0]))[:wanted]
        assert [r["rank"] for r in drawn] == list(range(1, wanted + 1))
        assert [(r.doc_id, r.score) for r in drawn] == [(r[0], r[4]) for r in best]
        assert Counter(tuple(r)[:5] for r in got) == Counter(rows)


def test_a_refuted_bracket_is_widened(spark, monkeypatch):
    scores = spark.range(1000).select(F.col("id").alias("score")).cache()
    real, calls = type(scores).approxQuantile, []

    def wrong_first(self, column, at, error):
        calls.append(error)
        return [0.0, 1.0] if len(calls) == 1 else real(self, column, at, error)

    monkeypatch.setattr(type(scores), "approxQuantile", wrong_first)
    low, high, above = importance.bracket(scores, 1000, 50)
    assert low <= 950 <= high and above == 999 - high and calls == [0.001, 0.002]


# periodic runs


def brute_runs(words, least, periods):
    n, out = len(words), []
    for p in range(1, n // periods + 1):
        i = 0
        while i < n - p:
            start = i
            while i < n - p and words[i] == words[i + p]:
                i += 1
            length = i - start + p
            if i > start and length >= max(least, periods * p):
                part = words[start : start + length]
                if not any(part[q:] == part[:-q] for q in range(1, p)):
                    out.append((start, length, p))
            i = max(i, start + 1) if i > start else i + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


@pytest.mark.parametrize("least, periods", [(2, 2), (6, 3), (24, 3)])
def test_runs_of_short_sequences(least, periods):
    rng = random.Random(least)
    for _ in range(400):
        words = [rng.randint(1, rng.randint(1, 4)) for _ in range(rng.randint(0, 60))]
        assert periodic_runs.runs_of(words, least, periods) == brute_runs(words, least, periods)


def periodic_texts():
    rng = random.Random(8)
    texts = [None, "", " \n", "a " * 23, "a " * 24, "a b " * 12, "a b " * 12 + "a", "A a " * 30, "é\x1c b\x0bc " * 20]
    for _ in range(60):
        words = [f"w{rng.randint(0, 40)}" for _ in range(rng.randint(1, 300))]
        for _ in range(rng.randint(0, 4)):  # runs that meet, overlap and lie within one another
            at, period = rng.randrange(len(words)), rng.randint(1, 25)
            for i in range(at + period, min(len(words), at + rng.randint(20, 150))):
                words[i] = words[i - period]
        texts.append("  ".join(words))
    return texts


def brute_tail(doc_id, words):
    h = zlib.crc32(("" if doc_id is None else str(doc_id)).encode())
    if h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def brute_row(doc_id, text, edit):
    words = [w.decode() for w in WORD.findall((text or "").encode())]
    words = edit(doc_id, words)
    runs = brute_runs(words, 24, 3)
    dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = sorted(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]))[:1]
    start, length, period = best[0] if best else (None, None, None)
    digest = lambda t: sha256(t.encode()).hexdigest()
    return (
        doc_id, len(runs), start, length, period, 1000 * length // period if best else None,
        digest("".join(f"{s},{n},{q}\n" for s, n, q in runs)),
        digest(" ".join(w for i, w in enumerate(words) if i not in dropped)),
    )


def test_periodic_runs_query(spark, tmp_path, documents, nothing):
    rows = [document(i, t) for i, t in enumerate(periodic_texts())]
    table = documents.unionByName(spark.createDataFrame(rows, SCHEMA))
    table.write.parquet(str(tmp_path / "documents.parquet"))
    got = op13_periodic_runs(spark, str(tmp_path)).collect()
    expected = Counter(brute_row(r.doc_id, r.text, brute_tail) for r in table.select("doc_id", "text").collect())
    assert Counter(map(tuple, got)) == expected
    assert sum(r.n_runs > 1 for r in got) > 5
    assert periodic_runs.find_runs(nothing).collect() == []


def test_a_run_shrinks_to_its_first_period(spark):
    text = "start " + "one two three " * 10 + "end"
    row = periodic_runs.find_runs(spark.createDataFrame([document(1, text)], SCHEMA)).first()
    assert row.n_words == 32 and [tuple(r) for r in row.runs] == [(1, 30, 3)]
    assert row.strongest == row.runs[0] and row.collapsed == "start one two three end"


def test_tails_keep_words_outside_them():
    words = [f"w{i}".encode() for i in range(57)]
    for doc_id in range(200):
        assert periodic_runs.with_repeated_tail(doc_id, words) == brute_tail(doc_id, words)

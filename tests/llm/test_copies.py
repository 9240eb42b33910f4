"""Exact groups, near groups and repeated passages against brute force."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from assayer.llm import exact_dedup, ngram_join, substring_dedup
from assayer.llm.components import connected
from tests.llm.conftest import SCHEMA, document

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.mark.parametrize("block", [7, 8192])
def test_exact_groups(documents, block):
    rows = [(r.doc_id, r.text or "") for r in documents.collect()]
    groups: dict[str, list] = {}
    for doc_id, text in rows:
        groups.setdefault(text, []).append(doc_id)
    got = exact_dedup.exact_groups(documents, block_bytes=block).collect()
    assert len(got) == len(rows)
    kept = Counter()
    for r in got:
        text = next(t for i, t in rows if i == r.doc_id and hashlib.sha256(t.encode()).hexdigest() == r.text_sha256)
        ids = groups[text]
        assert r.group_size == len(ids)
        assert r.keep_id == max((i for i in ids if i is not None), default=None)
        kept[text] += r.kept
        assert not r.kept or r.doc_id == r.keep_id
    assert set(kept.values()) == {1}


def test_exact_groups_with_hot_blocks(spark):
    rows = [document(i, "the same text" if i % 2 else f"own {i}") for i in range(400)]
    got = exact_dedup.exact_groups(spark.createDataFrame(rows, SCHEMA), block_bytes=4).collect()
    assert {r.doc_id: r.group_size for r in got} == {i: 200 if i % 2 else 1 for i in range(400)}
    assert sum(r.kept for r in got) == 201


def brute_components(rows, width, percent):
    sets = []
    for doc_id, text in rows:
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        w = WORD.findall(low)
        grams = {tuple(w[i : i + width]) for i in range(len(w) - width + 1)} or ({tuple(w)} if w else set())
        sets.append((doc_id, grams))
    near = lambda a, b: a and b and 100 * len(a & b) >= percent * len(a | b)
    out, left = {}, list(range(len(sets)))
    while left:
        group, front = [], [left.pop(0)]
        while front:
            x = front.pop()
            group.append(x)
            linked = [y for y in left if near(sets[x][1], sets[y][1])]
            front += linked
            left = [y for y in left if y not in linked]
        ids = [sets[x][0] for x in group if sets[x][0] is not None]
        for x in group:
            out[x] = (sets[x][0], len(sets[x][1]), min(ids, default=None))
    return sorted(out.values(), key=str)


@pytest.mark.parametrize(("width", "percent"), [(4, 85), (5, 80), (1, 50)])
def test_near_groups(documents, width, percent):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    got = ngram_join.near_groups(documents, width=width, percent=percent).collect()
    assert sorted(map(tuple, got), key=str) == brute_components(rows, width, percent)


def test_near_groups_of_many_variants(spark, words):
    base, rows = words(100, 11), []
    for i in range(60):
        text = list(base)
        for place in range(i % 7):
            text[(i * 13 + place * 17) % 100] = f"w{i}x{place}"
        rows.append(document(i, " ".join(text)))
    rows += [document(100 + i, " ".join(words(50, 200 + i) + base[:20])) for i in range(40)]
    got = ngram_join.near_groups(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(map(tuple, got), key=str) == brute_components([(r[0], r[1]) for r in rows], 4, 85)


def test_near_groups_of_lengthened_texts(spark, words):
    rows = []
    for i in range(80):
        base = words(60 + i * 90 // 79, 500 + i)
        own = [f"own{i}x{k}" for k in range(len(base) * (4 + i % 9) // 60)]
        rows += [document(2 * i, " ".join(base)), document(2 * i + 1, " ".join(base + own))]
    got = ngram_join.near_groups(spark.createDataFrame(rows, SCHEMA)).collect()
    want = brute_components([(r[0], r[1]) for r in rows], 4, 85)
    assert sum(r[0] != r[2] for r in want) > 50
    assert sorted(map(tuple, got), key=str) == want


def test_connected(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(0, 40) if i != 20] + [(50, 50)], "a long, b long")
    got = {r.node: r.label for r in connected(edges).collect()}
    assert got == {i: 0 if i <= 20 else 21 for i in range(41)}


def brute_removal(texts, length):
    cut = [WORD.findall(t or "") for t in texts]
    seen = Counter(tuple(w[i : i + length]) for w in cut for i in range(len(w) - length + 1))
    out = []
    for w in cut:
        gone = set()
        for i in range(len(w) - length + 1):
            if seen[tuple(w[i : i + length])] > 1:
                gone.update(range(i, i + length))
        out.append((len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


@pytest.mark.parametrize(("length", "shard"), [(35, 3000), (35, 1), (10, 2)])
def test_remove_repeats(documents, length, shard):
    rows = documents.select("doc_id", "text").collect()
    want = [(r.doc_id, *x) for r, x in zip(rows, brute_removal([r.text for r in rows], length))]
    got = substring_dedup.remove_repeats(documents, length=length, shard_runs=shard).collect()
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_counting_automaton():
    runs = [[1, 2, 3, 4], [2, 3, 4, 5], [9, 2, 3, 9]]
    automaton = substring_dedup.CountingAutomaton(runs, [1, 1, 1])
    assert automaton.repeated(runs[0], 2) == [1, 2]
    assert automaton.repeated(runs[2], 2) == [1]
    assert automaton.repeated(runs[0], 3) == [1]


def test_empty_tables(nothing):
    assert exact_dedup.exact_groups(nothing).count() == 0
    assert ngram_join.near_groups(nothing).count() == 0
    assert substring_dedup.remove_repeats(nothing).count() == 0
    assert ngram_join.near_groups(nothing.withColumn("text", F.lit(None).cast("string"))).count() == 0

"""Packing, pieces, neighbours and pages."""

from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
import pytest

from assayer.llm import html_extraction, packing, prefix_forest, sentence_pieces
from assayer.llm.page_parts import parts
from assayer.llm.word_ids import WordIds

WORD_FILE = public_tokenizers.path("word_bpe_49k.json")
PIECE_FILE = public_tokenizers.path("piece_bpe_32k.model")
ODD = [
    "", " ", "  a", "a  b", "\n", "a\n\nb ", " \n x", "日本語 テスト", "\ta b", "€ x", "İstanbul ﬁ ½", "<s> hi </s>", "<0x0A>", "é é",
    "don't we'll I'd", "x<|endoftext|>y <|ENDOFTEXT|>", "ÀÉ ÖSTERREICH", "word, more. end...", "a b\x1cc", "ǅ ΣΑΣ", "12 3.5 a1b2",
]


def test_word_ids_equal_the_library():
    encoder = WordIds(WORD_FILE)
    for text in ODD:
        want = encoder.tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(encoder.encode(text.encode()), "<u4").tolist() == want, text


def test_pieces_equal_the_library(texts):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=PIECE_FILE)
    pieces, cases = sentence_pieces.Pieces(PIECE_FILE), ODD + [t or "" for t in texts]
    for text, ids in zip(cases, pieces.encode(cases)):
        assert np.frombuffer(ids, "<u4").tolist() == model.encode(text), text
        assert pieces.decode(ids) == text


def test_pieces_round_trip(documents, nothing):
    back = sentence_pieces.decode(sentence_pieces.encode(documents, PIECE_FILE), PIECE_FILE)
    want = sorted(((r.doc_id, r.text or "") for r in documents.collect()), key=str)
    assert sorted(map(tuple, back.collect()), key=str) == want
    assert sentence_pieces.decode(sentence_pieces.encode(nothing, PIECE_FILE), PIECE_FILE).count() == 0


@pytest.mark.parametrize(("capacity", "open_sequences"), [(64, 4), (2048, 512)])
def test_packing(documents, nothing, capacity, open_sequences):
    pieces = packing.token_pieces(documents, WORD_FILE, capacity=capacity)
    got = packing.pack(pieces, capacity, open_sequences, rows_per_task=5).collect()
    encoder, want = WordIds(WORD_FILE), []
    for r in documents.collect():
        ids = encoder.tokenizer.encode(r.text or "", add_special_tokens=False).ids + [0]
        for k in range(0, len(ids), capacity):
            part = np.array(ids[k : k + capacity], "<u4")
            want.append((r.doc_id, k // capacity, k, len(part), zlib.crc32(part.tobytes())))
    assert sorted(((r.doc_id, r.piece, r.start, r.length, zlib.crc32(r.ids)) for r in got), key=str) == sorted(want, key=str)
    held: dict = {}
    for r in sorted(got, key=lambda r: r.offset):
        assert r.offset == held.get(r.sequence_id, 0)
        held[r.sequence_id] = r.offset + r.length
    assert max(held.values()) <= capacity
    assert packing.pack(packing.token_pieces(nothing, WORD_FILE)).count() == 0


def test_open_sequences_choose_best_fit():
    bins = packing.OpenSequences(10, 2)
    assert [bins.place(n) for n in (6, 7, 3, 4)] == [(0, 0), (1, 0), (1, 7), (0, 6)]
    full = packing.OpenSequences(10, 1)
    assert [full.place(n) for n in (6, 7, 4)] == [(0, 0), (1, 0), (2, 0)]


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, score string, rank int")


def test_forest_defined_results(spark):
    rng = np.random.default_rng(4)
    rows = [(i, rng.standard_normal(8).tolist(), "s", 1) for i in range(60)]
    rows[7] = (7, rows[20][1], "s", 1)
    bad = [(100, None, "s", 1), (120, [0.0] * 8, "s", 1), (140, [None] + [1.0] * 7, "s", 1), (160, [float("nan")] * 8, "s", 1)]
    bad += [(180, [1.0, 2.0], "s", 1), (None, [1.0] * 8, "s", 1)]
    got = prefix_forest.nearest(vectors(spark, rows + bad), lambda i: i % 20 == 0, k=5).collect()
    x = np.array([r[1] for r in rows], np.float32).astype(float)
    for q in (0, 20, 40):
        scores = x @ x[q]
        order = [i for i in np.lexsort((np.arange(60), -scores)) if i != q][:5]
        own = sorted((r.rank, r.vec_id, r.score) for r in got if r.query_id == q)
        assert [o[1] for o in own] == order and np.allclose([o[2] for o in own], scores[order])
    assert {r.query_id for r in got} == {0, 20, 40}
    assert prefix_forest.nearest(vectors(spark, bad[:2]), lambda i: i % 20 == 0).count() == 0


def test_forest_takes_one_length(spark):
    rows = [(i, [1.0, float(i + 1)], "s", 1) for i in range(2)] + [(20 + i, [1.0, 2.0, float(i)], "s", 1) for i in range(2)]
    got = prefix_forest.nearest(vectors(spark, rows), lambda i: i >= 0).collect()
    assert {(r.query_id, r.vec_id) for r in got} == {(0, 1), (1, 0)}


def test_forest_recall(spark):
    rng = np.random.default_rng(5)
    centres = rng.standard_normal((20, 32))
    x = centres[np.arange(3000) % 20] + 0.7 * rng.standard_normal((3000, 32))
    table = vectors(spark, [(i, v.tolist(), "", 0) for i, v in enumerate(x)])
    got = prefix_forest.nearest(table, lambda i: i % 100 == 0, least_candidates=600).collect()
    hits = 0
    for q in range(0, 3000, 100):
        scores = x @ x[q]
        scores[q] = -np.inf
        hits += len(set(np.argsort(-scores)[:20].tolist()) & {r.vec_id for r in got if r.query_id == q})
    assert hits >= 0.9 * 20 * 30


def page(i, paragraphs, extra=""):
    body = "".join(f"<p>{p}</p>" for p in paragraphs)
    return (
        f"<!DOCTYPE html><html><head><title>T{i}</title><script>var a='</p>';</script></head><body><nav><ul><li><a href=x>Menu {i}</a>"
        f"</ul></nav><div class='cookie-notice'>We use cookies</div><div id=main-column><h1>Head {i}</h1><form>Search {i}</form>{body}"
        f"<div class=\"share\">Share</div>{extra}</div><aside>Side {i}</aside><div class=comments><p>Reader {i} says a lot of things here, "
        f"again and again and again and again, more than the article itself says.</p></div><footer>&copy; {i}</footer></body></html>"
    )


def test_extraction(spark):
    rows, want = [], {}
    for i in range(12):
        paragraphs = [f"First&nbsp;words  of\n {i} &amp; <b>bold</b><br>more" for _ in range(1 + i % 3)]
        rows.append((i, f"http://h{i % 2}.example.com/{i}", page(i, paragraphs, "<div>Read more</div>"), "x", 1))
        want[i] = "\n".join([f"Head {i}", *[f"First words of {i} & bold more"] * (1 + i % 3)])
    odd = [None, "", "<", "<p>a < b & c", "<div><p>only text <i>here", "<!-- open", "<a href='x>broken", "<p>" * 300 + "deep"]
    rows += [(100 + i, None if i % 2 else "no url", h, "x", 1) for i, h in enumerate(odd)] + [(3, *rows[3][1:])]
    table = spark.createDataFrame(rows, "page_id long, url string, html string, host string, token int")
    got = html_extraction.extract(table).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.page_id in want:
            assert r.text == want[r.page_id]
    found = {r.page_id: r.text for r in got}
    assert found[100] == found[101] == found[105] == "" and found[103] == "a < b & c" and found[104] == "only text here"
    assert html_extraction.extract(table.where("false")).count() == 0


def test_extraction_of_copies(spark):
    body = lambda k: f"<html><body><article><h2>Introduction</h2><p>{k} one</p><p>{k} two</p><p>{k} three</p></article></body></html>"
    text = lambda k: f"Introduction\n{k} one\n{k} two\n{k} three"
    cases = {"a": ["same"] * 5, "b": ["same"] * 3 + ["p", "q", "r"], "c": ["same"] * 9 + ["p"]}
    rows = [(i, f"http://{h}.org/{i}", body(k), text(k)) for h, ks in cases.items() for i, k in enumerate(ks)]
    table = spark.createDataFrame(rows, "page_id long, url string, html string, want string")
    got = {(r.url): r.text for r in html_extraction.extract(table.drop("want")).collect()}
    assert got == {r[1]: r[3] for r in rows}


@pytest.mark.parametrize(
    "outer",
    ['<body class="no-sidebar">', '<body class="header-image single">', '<body><main class="with-sidebar">',
     '<body><article class="post widget">', '<body><div id="page" class="search-page">'],
)
def test_outer_elements_are_no_asides(outer):
    page = f"<html>{outer}<p>The text</p><div class='site-footer'>Foot</div><div class='share'>Share</div>"
    blocks = [body for _, body, _ in html_extraction.blocks_of(page) if body]
    assert blocks == ["The text"]
    assert html_extraction.article_text(page, [], set()) == "The text"


def test_slot_with_most_text_of_the_page():
    page = "<html><body><div class=lead><p>Short</p></div><div class=story><p>The long text of this page</p></div>"
    slots = ["html>body>div.lead", "html>body>div.story"]
    assert html_extraction.article_text(page, slots, set()) == "The long text of this page"


def test_article_outside_its_hosts_slots(spark):
    """Five kinds of pages fill the host's slots; the article of a sixth kind is in none and yet the page's text."""
    line = "<div class=line><p>Site wide line of text</p></div>"
    kinds = [(k, 9) for k in "abcde"] + [("f", 1)]
    rows, want = [], {}
    for kind, times in kinds:
        for i in range(times):
            body = " ".join(f"{kind}{i} word" for _ in range(70 if kind != "f" else 60))
            rows.append((len(rows), "http://h.org/x", f"<html><body>{line}<div class=kind{kind}><p>{body}</p></div></body></html>"))
            want[len(rows) - 1] = body
    table = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {r.page_id: r.text for r in html_extraction.extract(table).collect()} == want


def test_asides_at_any_depth():
    for depth in (5, 59, 60, 61, 70, 500):
        body = "<nav><p>Menu</p></nav><div class=comments><div><p>Reader</p></div></div><p>The text</p><footer><p>Foot"
        page = "<html><body>" + "<div>" * depth + body + "</div>" * 3 + "<p>More text</p>"
        blocks = [b for _, b, _ in html_extraction.blocks_of(page) if b]
        assert [b for b in blocks if b != "Foot"] == ["The text", "More text"] and "Foot" not in blocks, depth


def test_parts_are_lenient():
    text = lambda h: " ".join("".join(t for k, _, t, _ in parts(h) if k == "text").split())
    assert text("<p>a<p>b<style>x{}</style>c") == "abc"
    assert text("<p title='>'>a</p></div>b") == "ab"

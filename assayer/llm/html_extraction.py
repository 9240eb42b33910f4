"""Main text of web pages by templates deduced from equivalence classes.

A token is an element with its path, or the whole text of a block at its path. Its occurrence vector says
how often each page of a host has it. Tokens of one host with equal vectors form an equivalence
class; a class that is large and frequent enough stems from the host's template. Vectors are not kept:
a sum over pages of a hash of (page, count) is equal for equal vectors, and sums are aggregated before
and after the shuffle, so a host of any size has no group of its pages anywhere.

The elements of these classes, nested by their paths, are the template. A block belongs to
the slot of the deepest template element around it. Slots are ranked by how much text outside links they
hold over all pages of the host; parts that are asides by their names do not count. The best slot, widened to the
``article`` or ``main`` around it or else to the container of its paragraphs, is the article. From each page all blocks
of the article are taken, without asides and without blocks of the template (``Share this``). Equal pages of a
host count once.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayer.llm.page_parts import TEXT, is_aside, parts
from assayer.session import settle

CLASS_TOKENS = 3  # a class of the template has at least so many tokens
CLASS_SHARE = 0.5  # and is on at least this share of the host's pages
REPEATED_CONTENTS = 1_000_000  # numbers of repeated pages that are broadcast
HEADS = {"h1", "h2", "h3", "h4", "h5", "h6", "dt", "th", "caption"}
SLOTS = 5  # slots kept a host; a page's text outside them competes with them
BROADCAST_BYTES = 64 * 1024 * 1024
_HOST = re.compile(r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)")
SEPARATOR = ">"


def _number(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass"))


def blocks_of(page: str) -> Iterator[tuple[str, str, int]]:
    """``(path, text, linked)`` of each block outside asides, and ``(path, "", 0)`` for each element."""
    known: dict[tuple, tuple[str, bool]] = {}
    pieces: list[str] = []
    linked, current = 0, ""
    for kind, path, text, in_link in chain(parts(page), [("break", (), "", False)]):
        if path not in known:
            known[path] = SEPARATOR.join(path), any(map(is_aside, path))
        name, aside = known[path]
        if kind == "break":
            if pieces:
                body = " ".join("".join(pieces).split())
                pieces.clear()
                if body:
                    yield current, body, min(linked, len(body))
                linked = 0
        elif kind == "open":
            yield name, "", 0
        elif not aside:
            current = name
            pieces.append(text)
            linked += in_link and len(" ".join(text.split()))


def repeat_mark(path: str, body: str) -> str:
    return f"{_number(path + SEPARATOR + body):016x}"


def page_tokens(page: str) -> tuple[Counter, dict[str, list[int]]]:
    """Counts of the page's tokens; characters of text and of text in links by path, in no aside."""
    counts: Counter = Counter()
    sizes: dict[str, list[int]] = defaultdict(lambda: [0, 0])
    for path, body, linked in blocks_of(page):
        if body:
            counts["t" + repeat_mark(path, body)] += 1
            sizes[path][0] += len(body)
            sizes[path][1] += linked
        else:
            counts["e" + path] += 1
    return counts, sizes


def distinct_pages(source: DataFrame) -> DataFrame:
    """``mark, host, html``, one row for all equal pages of a host."""
    marked = source.select(F.xxhash64("host", "html").alias("mark"), "host", "html")
    counts = marked.groupBy("mark").agg(F.count("*").alias("rows"))
    repeated = settle(counts.where("rows > 1").select("mark"), "repeated-pages")
    if repeated.count() > REPEATED_CONTENTS:
        return marked.dropDuplicates(["mark"])
    repeated = F.broadcast(repeated)
    several = marked.join(repeated, "mark", "left_semi").dropDuplicates(["mark"])
    return marked.join(repeated, "mark", "left_anti").unionByName(several)


def token_table(pages: DataFrame) -> DataFrame:
    """``host, token, pages, total, vector, chars, linked`` over ``distinct_pages``; ``p`` counts the pages."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: dict[tuple[str, str], list[int]] = defaultdict(lambda: [0, 0, 0, 0, 0])
            for key, host, page in zip(*(c.to_pylist() for c in batch.columns)):
                counts, sizes = page_tokens(page or "")
                rows[host, "p"][0] += 1
                for token, count in counts.items():
                    row = rows[host, token]
                    row[0] += 1
                    row[1] += count
                    row[2] += _number(f"{key}:{count}")
                for path, (chars, linked) in sizes.items():
                    row = rows[host, "s" + path]
                    row[0] += 1
                    row[3] += chars
                    row[4] += linked
            if rows:
                host, token = zip(*rows)
                values = list(zip(*rows.values()))
                values[2] = [v & (1 << 64) - 1 for v in values[2]]
                columns = [pa.array(np.array(v, np.uint64).view(np.int64)) for v in values]
                yield pa.RecordBatch.from_arrays([pa.array(host), pa.array(token), *columns], names)

    names = ["host", "token", "pages", "total", "vector", "chars", "linked"]
    schema = "host string, token string, " + ", ".join(f"{n} bigint" for n in names[2:])
    rows = pages.mapInArrow(run, schema)
    sums = [F.sum(n).alias(n) for n in ("pages", "total", "chars", "linked")]
    # a sum that wraps around: high and low halves apart, put together again modulo 2^64
    low = F.sum(F.col("vector").bitwiseAND(0xFFFFFFFF)).alias("low")
    high = F.sum(F.shiftrightunsigned("vector", 32)).alias("high")
    summed = rows.groupBy("host", "token").agg(*sums, low, high)
    carried = (F.col("high") + F.shiftrightunsigned("low", 32)).bitwiseAND(0xFFFFFFFF)
    vector = F.shiftleft(carried, 32).bitwiseXOR(F.col("low").bitwiseAND(0xFFFFFFFF))
    return summed.withColumn("vector", vector).drop("low", "high")


def by_host(table: DataFrame, name: str) -> DataFrame:
    """``table``, one row a host, stored and broadcast if it is small, so that no host's tokens meet in one task."""
    table = settle(table, name)
    size = table.agg(F.sum(F.length(F.to_json(F.struct("*"))) * 2)).first()[0] or 0
    return F.broadcast(table) if size <= BROADCAST_BYTES else table


def templates(tokens: DataFrame) -> DataFrame:
    """``host, articles, repeated``: paths of the best slots, best first, and the template's own blocks."""
    pages = by_host(tokens.where("token = 'p'").select("host", F.col("pages").alias("of")), "page-counts")
    held = tokens.where("token <> 'p'").join(pages, "host")
    marked = held.where(F.col("token").rlike("^[et]") & (F.col("pages") >= CLASS_SHARE * F.col("of")))
    classes = marked.groupBy("host", "vector", "pages", "total").agg(
        F.count("*").alias("size"), F.collect_list("token").alias("members")
    )
    valid = classes.where(F.col("size") >= CLASS_TOKENS).select("host", "pages", F.explode("members").alias("token"))
    elements = F.collect_set(F.when(F.col("token").startswith("e"), F.expr("substring(token, 2)")))
    frame = by_host(valid.groupBy("host").agg(elements.alias("elements")), "frames")
    texts = (
        valid.where(F.col("token").startswith("t") & (F.col("pages") > 1))
        .groupBy("host")
        .agg(F.collect_set(F.expr("substring(token, 2)")).alias("repeated"))
    )
    slots = held.where(F.col("token").startswith("s")).select(
        "host", F.expr("substring(token, 2)").alias("path"), (F.col("chars") - F.col("linked")).alias("weight")
    )
    inside = "filter(elements, e -> path = e OR startswith(path, concat(e, '>')))"
    deepest = f"aggregate({inside}, '', (a, e) -> if(length(e) > length(a), e, a))"
    ranked = (
        slots.join(frame, "host", "left")
        .withColumn("elements", F.coalesce("elements", F.array().cast("array<string>")))
        .withColumn("slot", widened(F.expr(deepest), F.col("path")))
        .groupBy("host", "slot")
        .agg(F.sum("weight").alias("weight"))
    )
    order = F.struct((-F.col("weight")).alias("w"), F.col("slot").alias("slot"))
    best = ranked.groupBy("host").agg(F.slice(F.array_sort(F.collect_list(order)), 1, SLOTS).alias("best"))
    return best.join(texts, "host", "left").select("host", F.col("best.slot").alias("articles"), "repeated")


def widen(slot: str) -> str:
    """The ``article`` or ``main`` around a slot, else its nearest container that is no text element."""
    names = slot.split(SEPARATOR)
    for kind in ("article", "main"):
        for i, name in enumerate(names):
            if name.split(".", 1)[0] == kind or kind in re.split("[.-]", name)[1:]:
                return SEPARATOR.join(names[: i + 1])
    while len(names) > 1 and names[-1].split(".", 1)[0] in TEXT:
        names.pop()
    return SEPARATOR.join(names)


def widened(slot, path):
    """``widen`` as a column; a slot outside every template element is widened from its own path."""
    base = F.when(slot == "", path).otherwise(slot)
    named = "(^|>)({k}([.][^>]*)?|[^>]*[.-]{k}([.-][^>]*)?)(?=>|$)"
    text = "(>(" + "|".join(sorted(TEXT)) + ")([.][^>]*)?)+$"
    out = F.regexp_replace(base, text, "")
    for kind in ("main", "article"):
        upto = F.regexp_extract(base, "^(.*?" + named.replace("{k}", kind) + ")", 1)
        out = F.when(upto != "", upto).otherwise(out)
    return out


def within(path: str, slot: str) -> bool:
    return not slot or path == slot or path.startswith(slot + SEPARATOR)


def article_text(page: str, articles: list[str], repeated: set[str]) -> str:
    """Blocks of the slot that holds most of this page's own text, joined by line breaks.

    A block counts for the deepest slot of ``articles`` around it; outside all of them, for its own container, which
    is then a slot of this page alone. Template text inside the slot goes if it is the lesser part of the
    slot's text; where it is more, the host's pages are much alike and it is the article. Headings stay.
    """
    blocks = [(path, body, linked) for path, body, linked in blocks_of(page) if body]
    fixed = lambda path, body: (
        path.rsplit(SEPARATOR, 1)[-1].split(".", 1)[0] not in HEADS and repeat_mark(path, body) in repeated
    )
    marked = [(path, body, len(body) - linked, bool(repeated) and fixed(path, body)) for path, body, linked in blocks]
    weights: Counter = Counter()
    own: Counter = Counter()
    for path, _, weight, template in marked:
        around = [a for a in articles if within(path, a)]
        if around:
            weights[max(around, key=len)] += weight * (not template)
        else:
            own[widen(path)] += weight * (not template)
    best = max(articles, key=lambda a: weights.get(a, -1), default=None)
    other = max(own, key=lambda w: (own[w], w), default="")
    if best not in weights or own[other] > weights[best]:
        best = other
    inside = [m for m in marked if within(m[0], best)]
    gone = sum(len(body) for _, body, _, template in inside if template)
    few = 2 * gone < sum(len(body) for _, body, _, _ in inside)
    return "\n".join(body for _, body, _, template in inside if not (template and few))


def extract(
    pages: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html"
) -> DataFrame:
    """``page_id, url, text`` per row: the main text, blocks joined by one line break; empty if there is none.

    Null html counts as empty; a null url and one without host belong to the host ``''``. A page whose own text lies
    mostly outside its host's slots is judged by its own containers. Repeated rows give the same text each. Other columns are ignored.
    """
    source = pages.select(
        F.col(id_column).alias("page_id"), F.col(url_column).alias("url"), F.col(html_column).alias("html")
    )
    host = F.lower(F.coalesce(F.regexp_extract("url", _HOST.pattern, 1), F.lit("")))
    distinct = distinct_pages(source.withColumn("host", host))
    plans = settle(templates(settle(token_table(distinct), "tokens")), "templates")
    size = plans.agg(F.sum(F.length(F.to_json(F.struct("*"))) * 2)).first()[0] or 0
    held = plans.withColumnRenamed("host", "of_host")
    joined = source.withColumn("host", host).join(
        F.broadcast(held) if size <= BROADCAST_BYTES else held, F.col("host") == F.col("of_host"), "left"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(n).to_pylist() for n in ("html", "articles", "repeated")]
            texts = [article_text(h or "", a or [], set(r or ())) for h, a, r in zip(*columns)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())],
                ["page_id", "url", "text"],
            )

    kind = source.schema["page_id"].dataType.simpleString()
    chosen = joined.select("page_id", "url", "html", "articles", "repeated")
    return chosen.mapInArrow(run, f"page_id {kind}, url string, text string")

"""Main text of pages by deduction of their hosts' templates.

Tokens of a page are its elements by their path and its blocks of text in their place.
Tokens of a host that occur equally often on each of its pages form an equivalence class.
Classes on enough pages are valid; each is nested in the class of the element around it,
and together they are the host's template. Where tokens of a class do not follow each other
in one order on all pages, those out of order are classes of their own.

Tokens of one path may have several roles. They are told apart by their position: the
class tokens before them, of the classes they lie in. Then classes are found anew, until
those of the host no longer change. What lies between the template's tokens are its slots;
the slots of the article are extracted.

An occurrence vector has an entry for each page of a host. It is never put together: each
page adds a hash of its number and the count of a token, and sums of those (by exclusive
or) are equal for equal vectors, so classes are found by partial aggregation whatever the
size of a host.
"""

from __future__ import annotations

import struct
from collections import Counter
from collections.abc import Iterator
from itertools import islice
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluicework.llm.html_blocks import Page, read_page, text_token
from sluicework.llm.tasks import map_arrow
from sluicework.llm.url_filter import host_and_path
from sluicework.sources.scratch import scratch_dir, written_out

#: A class is valid on this many pages and this share of its host's pages (one in so many).
LEAST_PAGES = 2
ONE_IN = 2

#: Pages from which text that all of them have once is part of the template, if it is
#: less than this share (one in so many) of the article.
TEXT_PAGES = 10
TEXT_ONE_IN = 2

#: Entries of all templates that are broadcast; more are joined by host, pages of hosts
#: with over 1 / HOT_ONE_IN of all pages spread over SALTS tasks.
BROADCAST_ENTRIES = 1_000_000
HOT_ONE_IN = 1_000
SALTS = 64

BATCH_BYTES = 8 << 20

#: Entries of templates that a task remembers; tokens and pages that it gives on at once.
KNOWN_ENTRIES = 1_000_000
BATCH_TOKENS = 100_000
BATCH_PAGES = 1_000

#: The token of the page itself; its class is the root of the template.
ROOT = 0
ELEMENT, TEXT = 0, 1

#: Elements in which blocks lie side by side.
_CONTAINERS = frozenset("article main section div body td blockquote html center".split())


def _container(page: Page, element: int) -> int:
    while element >= 0 and page.tags[element] not in _CONTAINERS:
        element = page.parents[element]
    return element


class Outline(NamedTuple):
    """What tells tokens: of elements the path, the number of the one around and the rank as an
    article; of blocks the token, the element around, the elements that start before, the
    characters, and the container with those of them that are in no link."""

    paths: list[int]
    parents: list[int]
    ranks: list[int]
    texts: list[int]
    elements: list[int]
    starts: list[int]
    chars: list[int]
    holders: list[int]
    plain: list[int]

    def in_order(self) -> Iterator[tuple[int, int]]:
        """Elements and blocks as they come on the page: kind and number."""
        at = 0
        for i in range(len(self.paths) + 1):
            while at < len(self.starts) and self.starts[at] == i:
                yield TEXT, at
                at += 1
            if i < len(self.paths):
                yield ELEMENT, i


def outline_of(page: Page) -> Outline:
    """Blocks in excluded elements are tokens without characters."""
    excluded = page.excluded()
    ranks = [0 if gone else rank for rank, gone in zip(page.ranks, excluded, strict=True)]
    found = Outline(page.paths, page.parents, ranks, [], [], page.starts, [], [], [])
    for element, text, link_chars in page.blocks:
        kept = element < 0 or not excluded[element]
        found.texts.append(text_token(page.paths[element] if element >= 0 else ROOT, text))
        found.elements.append(element)
        found.chars.append(len(text) if kept else 0)
        found.holders.append(_container(page, element) if kept else element)
        found.plain.append(len(text) - link_chars if kept else 0)
    return found


def _told_apart(outline: Outline, tokens: list[int], texts: list[int], classes: dict[int, int]) -> tuple[list[int], list[int]]:
    """Elements and blocks by their token, the element around them and, of each class they lie in, its last token before them."""
    last = {classes[ROOT]: ROOT}
    around, inside = {-1: ROOT}, {-1: (classes[ROOT],)}
    roles, text_roles = [], []
    for kind, i in outline.in_order():
        token, outer = (tokens[i], outline.parents[i]) if kind == ELEMENT else (texts[i], outline.elements[i])
        held = inside[outer]
        packed = struct.pack(f"{2 + len(held)}q", token, around[outer], *(last[c] for c in held))
        role = xxhash.xxh3_64_intdigest(packed) - (1 << 63)
        own = classes.get(token)
        if own is not None:
            last[own] = token
        if kind == ELEMENT:
            roles.append(role)
            around[i], inside[i] = role, held if own is None or own in held else (*held, own)
        else:
            text_roles.append(role)
    return roles, text_roles


def roles_of(outline: Outline, classes: dict[int, int], rounds: int) -> tuple[list[int], list[int]]:
    """Tokens of elements and blocks after so many rounds. ``classes`` are those of tokens of
    every round; they do not mix, as each round has tokens of its own."""
    tokens, texts = outline.paths, outline.texts
    for _ in range(rounds):
        tokens, texts = _told_apart(outline, tokens, texts, classes)
    return tokens, texts


def _counted(outline: Outline, tokens: list[int], texts: list[int]) -> dict[tuple[int, int], list[int]]:
    """Of each token and kind: its count, the token around it, characters and rank. Characters
    are those of text in no link: a block's own, a container's blocks'."""
    found: dict[tuple[int, int], list[int]] = {(ROOT, ELEMENT): [1, ROOT, 0, 0]}
    for token, parent, rank in zip(tokens, outline.parents, outline.ranks, strict=True):
        own = found.setdefault((token, ELEMENT), [0, tokens[parent] if parent >= 0 else ROOT, 0, 0])
        own[0] += 1
        own[3] = max(own[3], rank)
    for token, element, chars, holder, plain in zip(texts, outline.elements, outline.chars, outline.holders, outline.plain, strict=True):
        own = found.setdefault((token, TEXT), [0, tokens[element] if element >= 0 else ROOT, chars, 0])
        own[0] += 1
        found[tokens[holder] if holder >= 0 else ROOT, ELEMENT][2] += plain
    return found


def _page_tokens(page: Page) -> dict[tuple[int, int], list[int]]:
    outline = outline_of(page)
    return _counted(outline, outline.paths, outline.texts)


def _before(outline: Outline, tokens: list[int], texts: list[int], classes: dict[int, int]) -> dict[int, set[int | None]]:
    """Of each token with a class the tokens of that class that stood before it, None where it
    was the first. Before an element stand elements: texts that move do not part those."""
    found: dict[int, set[int | None]] = {ROOT: {None}}
    last = {classes[ROOT]: ROOT}
    elements = dict(last)
    for kind, i in outline.in_order():
        token = tokens[i] if kind == ELEMENT else texts[i]
        own = classes.get(token)
        if own is None:
            continue
        found.setdefault(token, set()).add((elements if kind == ELEMENT else last).get(own))
        last[own] = token
        if kind == ELEMENT:
            elements[own] = token
    return found


class _Known:
    """Values by host, read from a row and remembered for the next rows of that host."""

    def __init__(self, read) -> None:
        self._read, self._held, self._entries = read, {}, 0

    def of(self, batch: pa.RecordBatch, at: int, host: int) -> tuple:
        found = self._held.get(host)
        if found is None:
            if self._entries > KNOWN_ENTRIES:
                self._held, self._entries = {}, 0
            found = self._held[host] = self._read(batch, at)
            self._entries += sum(len(x) for x in found if hasattr(x, "__len__")) + 1
        return found


def _classes_at(batch: pa.RecordBatch, at: int) -> tuple[dict[int, int], int]:
    if "rounds" not in batch.schema.names:
        return {}, 0
    tokens, classes, rounds = (batch.column(c)[at].as_py() for c in ("tokens", "classes", "rounds"))
    return dict(zip(tokens or (), classes or (), strict=True)), rounds or 0


_KEYS = ["host_key", "row_no"]
_OUTLINE = ", ".join([f"{k} long" for k in _KEYS] + [f"{name} array<{'long' if name in ('paths', 'texts') else 'int'}>" for name in Outline._fields])


def _outlines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = [pa.list_(pa.int64() if name in ("paths", "texts") else pa.int32()) for name in Outline._fields]
    for batch in (b.slice(i, BATCH_PAGES) for b in batches for i in range(0, b.num_rows, BATCH_PAGES)):
        found = [outline_of(read_page(cell.as_py() or "")) for cell in batch.column("html")]
        lists = [pa.array([outline[i] for outline in found], kind) for i, kind in enumerate(kinds)]
        yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in _KEYS), *lists], [*_KEYS, *Outline._fields])


def _lists(column: pa.ListArray) -> Iterator[list[int]]:
    values = column.flatten().to_numpy().tolist()
    ends = np.cumsum(np.diff(column.offsets.to_numpy())).tolist()
    return (values[start:end] for start, end in zip([0, *ends], ends, strict=False))


def _read(batch: pa.RecordBatch, known: _Known) -> Iterator[tuple[int, int, Outline, tuple[dict[int, int], int]]]:
    keys = zip(*(batch.column(k).to_pylist() for k in _KEYS), strict=True)
    parts = zip(*(_lists(batch.column(name)) for name in Outline._fields), strict=True)
    for at, ((host, row), part) in enumerate(zip(keys, parts, strict=True)):
        yield host, row, Outline(*part), known.of(batch, at, host)


def _numbers(rows: Iterator[tuple], names: list[str]) -> Iterator[pa.RecordBatch]:
    while held := list(islice(rows, BATCH_TOKENS)):
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*held, strict=True)], names)


_TOKENS = ["host_key", "token", "kind", "around", "entry", "count", "chars", "rank"]


def _tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows() -> Iterator[tuple]:
        known = _Known(_classes_at)
        for batch in batches:
            for host, row, outline, (classes, rounds) in _read(batch, known):
                for (token, kind), (count, around, chars, rank) in _counted(outline, *roles_of(outline, classes, rounds)).items():
                    entry = xxhash.xxh3_64_intdigest(f"{row}:{count}") - (1 << 63)
                    yield host, token, kind, around, entry, count, chars, rank

    return _numbers(rows(), _TOKENS)


_ORDERS = ["host_key", "token", "first", "low", "high"]


def _orders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows() -> Iterator[tuple]:
        known = _Known(_classes_at)
        for batch in batches:
            for host, _, outline, (classes, rounds) in _read(batch, known):
                for token, before in _before(outline, *roles_of(outline, classes, rounds), classes).items():
                    others = [t for t in before if t is not None]
                    yield host, token, int(None in before), min(others, default=None), max(others, default=None)

    return _numbers(rows(), _ORDERS)


def outlines(pages: DataFrame) -> DataFrame:
    """Of each page with ``host_key``, ``row_no`` and ``html`` what tells its tokens."""
    return map_arrow(pages.select(*_KEYS, "html"), _outlines, _OUTLINE)


def equivalence_classes(pages: DataFrame) -> DataFrame:
    """Tokens of valid classes, from ``host_key``, ``row_no`` and ``html``, or from outlines.

    This is one round. Outlines with ``rounds``, ``tokens`` and their ``classes`` have the
    tokens that those tell apart; ``differentiated`` goes on to the last round.

    Returns per host and token: ``kind``, ``around`` (the token of the element around
    it), ``class`` (pages, occurrences and the sum of entries: equal for equal occurrence
    vectors), ``chars``, ``rank``, ``host_pages`` and ``of_root`` (in the class of the page itself: once on every page).
    """
    outlined = outlines(pages) if "html" in pages.columns else pages
    tokens = map_arrow(outlined, _tokens, ", ".join(f"{name} long" for name in _TOKENS))
    counted = tokens.groupBy("host_key", "token", "kind").agg(
        F.min("around").alias("around"),
        F.struct(F.count(F.lit(1)).alias("pages"), F.sum("count").alias("occurrences"), F.bit_xor("entry").alias("entries")).alias("class"),
        F.sum("chars").alias("chars"),
        F.max("rank").alias("rank"),
    )
    counted = written_out(counted.filter((F.col("class.pages") >= LEAST_PAGES)))
    roots = counted.filter((F.col("token") == ROOT) & (F.col("kind") == ELEMENT)).select("host_key", F.col("class").alias("root"))
    return counted.join(roots, "host_key").filter(F.col("class.pages") * ONE_IN >= F.col("root.pages")).select(
        *counted.columns, F.col("root.pages").alias("host_pages"), (F.col("class") == F.col("root")).alias("of_root")
    )


def ordered_classes(outlined: DataFrame, tokens: DataFrame, known: DataFrame) -> DataFrame:
    """``known`` (per host ``rounds``, ``tokens`` and their ``classes``) with one more round: that of the classes of ``tokens``.

    A class is ordered if on every page its tokens come in turns of one order: each token
    after the same other, one of them first. Tokens that do not are classes of their own.
    """
    named = tokens.select("host_key", "token", "kind", F.xxhash64("class").alias("class"))

    def with_round(classes: DataFrame, rounds: int) -> DataFrame:
        own = classes.groupBy("host_key").agg(F.collect_list(F.struct("token", "class")).alias("own"))
        return known.join(own, "host_key").select(
            "host_key",
            (F.col("rounds") + rounds).alias("rounds"),
            F.concat("tokens", "own.token").alias("tokens"),
            F.concat("classes", "own.class").alias("classes"),
        )

    beside = _beside(outlined, written_out(with_round(named, 0)), ["row_no"], "inner")
    orders = map_arrow(beside, _orders, ", ".join(f"{name} long" for name in _ORDERS))
    orders = orders.groupBy("host_key", "token").agg(F.max("first").alias("first"), F.min("low").alias("low"), F.max("high").alias("high"))
    placed = written_out(named.join(orders, ["host_key", "token"]))
    firsts = placed.groupBy("host_key", "class", "kind").agg(F.sum("first").alias("firsts"))
    is_ordered = F.col("low").eqNullSafe(F.col("high")) & ((F.col("first") == 0) | (F.col("firsts") == 1))
    parted = placed.join(firsts, ["host_key", "class", "kind"]).select(
        "host_key", "token", F.when(is_ordered, F.col("class")).otherwise(F.xxhash64("class", "token")).alias("class")
    )
    return with_round(parted, 1)


def differentiated(outlined: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Tokens of valid classes once those of a path are told apart, and per host what tells them: ``rounds``, ``tokens``, ``classes``.

    Each round parts tokens by their position in the classes of the round before. It is a
    host's last if none of its tokens has been parted: then their number and occurrences
    are the same (parts are more, or some are on too few pages). The others go on, whatever
    the number of rounds.
    """
    none = F.array().cast("array<bigint>")
    tokens = written_out(equivalence_classes(outlined))
    known = tokens.select("host_key").distinct().select("host_key", F.lit(0).alias("rounds"), none.alias("tokens"), none.alias("classes"))
    spark, settled = outlined.sparkSession, {name: scratch_dir(outlined.sparkSession) for name in ("tokens", "known")}
    schemas = {"tokens": tokens.schema}
    while True:
        known = written_out(ordered_classes(outlined, tokens, known))
        schemas["known"] = known.schema
        parted = written_out(equivalence_classes(_beside(outlined, known, ["row_no"], "inner")))
        sizes = [t.groupBy("host_key").agg(F.count(F.lit(1)).alias("n"), F.sum("class.occurrences").alias("m")) for t in (tokens, parted)]
        same = written_out(sizes[0].join(sizes[1], ["host_key", "n", "m"]).select("host_key"))
        for name, rows in (("tokens", parted), ("known", known)):
            rows.join(same, "host_key", "left_semi").write.mode("append").parquet(settled[name])
        tokens, known = (written_out(rows.join(same, "host_key", "left_anti")) for rows in (parted, known))
        if known.isEmpty():
            return tuple(spark.read.schema(schemas[name]).parquet(settled[name]) for name in ("tokens", "known"))


def nested_classes(tokens: DataFrame) -> DataFrame:
    """The template: per host, class and ``nested_in`` (the class of the element around) the
    ``tokens`` there. Tokens around which lies their own class are nested in that.

    An element is on every page that what it holds is on, so what holds a valid class is
    valid, and every token but the page's own has a place.
    """
    around = tokens.filter(F.col("kind") == ELEMENT).select("host_key", F.col("token").alias("around"), F.col("class").alias("nested_in"))
    placed = tokens.filter(F.col("token") != ROOT).join(around, ["host_key", "around"])
    return placed.groupBy("host_key", "class", "nested_in").agg(F.sort_array(F.collect_list("token")).alias("tokens"))


def templates(tokens: DataFrame) -> DataFrame:
    """One row per host with a template: ``host_key``, ``nodes`` (elements with the
    characters of their slots and their rank) and ``texts`` (tokens of its own text)."""
    is_text = (F.col("kind") == TEXT) & F.col("of_root") & (F.col("host_pages") >= TEXT_PAGES)
    # Where most of the text is the same on all pages, the pages are copies, and no text is the template's.
    filled = F.sum(F.when(F.col("kind") == ELEMENT, F.col("chars")))
    repeated = F.sum(F.when(is_text, F.col("chars")))
    node = F.struct("token", "chars", "rank")
    return tokens.groupBy("host_key").agg(
        F.collect_list(F.when(F.col("kind") == ELEMENT, node)).alias("nodes"),
        F.collect_list(F.when(is_text, F.col("token"))).alias("texts"),
        (F.coalesce(repeated, F.lit(0)) * TEXT_ONE_IN < filled).alias("varies"),
    ).select("host_key", "nodes", F.when(F.col("varies"), F.col("texts")).otherwise(F.array().cast("array<bigint>")).alias("texts"))


def article_blocks(
    page: Page, nodes: dict[int, tuple[int, int]], texts: frozenset[int], roles: tuple[list[int], list[int]] | None = None
) -> list[str]:
    """Blocks of the article's slots. ``roles`` are the tokens of elements and blocks, by path if not given.

    Where elements are marked as an article, it is those of one path, by rank, a node of the
    template and the characters on this page. Else it is the elements of one token: a node
    of the template, by the characters of its slots on all pages; without a template, or a
    node of it on this page, the page's own characters count. Its heading and what lies
    beside that are added.
    """
    excluded = page.excluded()
    paths = page.paths
    tokens, text_tokens = roles or (paths, [text_token(paths[e] if e >= 0 else ROOT, t) for e, t, _ in page.blocks])
    marked = {paths[i]: page.ranks[i] for i in range(len(paths)) if page.ranks[i] and not excluded[i]}
    if marked:
        inside: Counter[int] = Counter()
        for element, text, link_chars in page.blocks:
            if element >= 0 and not excluded[element]:
                while element >= 0:
                    inside[paths[element]] += len(text) - link_chars
                    element = page.parents[element]
        in_nodes = {path for path, token in zip(paths, tokens, strict=True) if token in nodes}
        best = max(marked, key=lambda p: (marked[p], p in in_nodes, inside[p], p))
        chosen = [i for i, path in enumerate(paths) if path == best]
        whole = False
    else:
        own: Counter[int] = Counter()
        for element, text, link_chars in page.blocks:
            if element < 0 or not excluded[element]:
                holder = _container(page, element)
                own[tokens[holder] if holder >= 0 else ROOT] += len(text) - link_chars
        best = max(own, key=lambda t: (t in nodes, nodes.get(t, (0, 0))[0], own[t], t), default=None)
        if best is None:
            return []
        chosen = [i for i, token in enumerate(tokens) if token == best]
        if chosen:
            chosen = _with_heading(page, excluded, chosen)
        whole = best == ROOT
    inner = [False] * len(paths)
    is_chosen = set(chosen)
    for i in range(len(paths)):
        inner[i] = i in is_chosen or page.parents[i] >= 0 and inner[page.parents[i]]
    found = []
    for (element, text, _), token in zip(page.blocks, text_tokens, strict=True):
        if (whole if element < 0 else inner[element] and not excluded[element]) and token not in texts:
            found.append(text)
    return found


def _with_heading(page: Page, excluded: list[bool], chosen: list[int]) -> list[int]:
    """The elements, and the page's first heading with all that lies in the element around both, unless that is the whole page."""
    heading = next((i for i, tag in enumerate(page.tags) if tag == "h1" and not excluded[i]), None)
    if heading is None:
        return chosen

    def above(i: int) -> list[int]:
        way = [i]
        while page.parents[way[-1]] >= 0:
            way.append(page.parents[way[-1]])
        return way

    around = set(above(heading))
    common = next((i for i in above(chosen[0]) if i in around), None)
    if common is None or page.tags[common] in ("html", "body"):
        return [*chosen, heading]
    return [*chosen, common]


def _template_at(batch: pa.RecordBatch, at: int) -> tuple:
    nodes, texts = batch.column("nodes")[at].as_py() or [], batch.column("own_texts")[at].as_py() or []
    return {n["token"]: (n["chars"], n["rank"]) for n in nodes}, frozenset(texts), *_classes_at(batch, at)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["page_id", "url", "text"]
    types = [pa.int64(), pa.string(), pa.string()]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)

    held, size, known = [], 0, _Known(_template_at)
    for batch in batches:
        keys = batch.column("host_key").to_pylist()
        for at in range(batch.num_rows):
            nodes, texts, classes, rounds = known.of(batch, at, keys[at])
            page = read_page(batch.column("html")[at].as_py() or "")
            roles = roles_of(outline_of(page), classes, rounds) if rounds else None
            text = "\n\n".join(article_blocks(page, nodes, texts, roles))
            held.append((batch.column("page_id")[at].as_py(), batch.column("url")[at].as_py(), text))
            size += len(text)
            if size >= BATCH_BYTES:
                yield batch_of(held)
                held, size = [], 0
    if held:
        yield batch_of(held)


def main_text(pages: DataFrame) -> DataFrame:
    """The main text of every page: the article without what surrounds it.

    Needs ``page_id``, ``url`` and ``html``; other columns are ignored. Returns one row
    per input row: ``page_id``, ``url``, ``text`` (blocks with one space for white space,
    joined by two line breaks; empty if none) and ``n_chars`` (its code points).

    Pages are of one host if their URLs' hosts are equal, A-Z in lower case; pages with a
    null URL, or one without ``://``, are together a host without a name. A null page is
    an empty one. Very long pages are read whole. A host with one page has no template, its
    page is judged alone; copies of a page are pages of their own. Repeated rows give
    equal rows, an empty table none.
    """
    host, _ = host_and_path(F.col("url"))
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.col("html").cast("string").alias("html"),
        F.xxhash64(F.coalesce(host, F.lit(""))).alias("host_key"),
    )
    numbered = rows.select("host_key", F.monotonically_increasing_id().alias("row_no"), "html")
    tokens, positions = differentiated(written_out(outlines(numbered)))
    known = written_out(templates(tokens).withColumnRenamed("texts", "own_texts").join(positions, "host_key"))
    found = map_arrow(_beside(rows, known, ["page_id", "url"], "left"), _extract, "page_id long, url string, text string")
    return found.withColumn("n_chars", F.length("text").cast("long"))


def _beside(rows: DataFrame, known: DataFrame, salt: list[str], how: str) -> DataFrame:
    """Rows with what is known of their host: broadcast, or by a join in which the pages of hot
    hosts are spread over tasks by the columns ``salt``."""
    lists = [F.coalesce(F.size(c), F.lit(0)) for c, kind in known.dtypes if kind.startswith("array")]
    entries = known.agg(F.sum(sum(lists, F.lit(0))).alias("n")).first()["n"] or 0
    if entries <= BROADCAST_ENTRIES:
        return rows.join(F.broadcast(known), "host_key", how)
    counts = written_out(rows.groupBy("host_key").count())
    total = counts.agg(F.sum("count")).first()[0] or 0
    # Fewer than HOT_ONE_IN hosts, whatever the table.
    hot = F.broadcast(counts.filter(F.col("count") * HOT_ONE_IN > total).select("host_key", F.lit(SALTS).alias("salts")))
    salts = F.coalesce("salts", F.lit(1))
    spread = rows.join(hot, "host_key", "left").withColumn("salt", F.pmod(F.xxhash64(*salt), salts)).drop("salts")
    copies = known.join(hot, "host_key", "left").withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), salts.cast("long") - 1))).drop("salts")
    return spread.join(copies, ["host_key", "salt"], how)

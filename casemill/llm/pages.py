"""Main text of web pages by removing what a site repeats.

A page is parsed into blocks of text. A block knows the hashes of the structural elements around it, taken over
their whole subtrees (tags, classes, words), inside a marked article too; there a paragraph, heading, list, table or quotation
that is not made of links has to be on nearly every page of its host, as the prose of an article may recur. Spark counts, per host, beside how many
different rests of pages a subtree occurs, and deletes from each page the subtrees that recur. Of what is left, blocks of
elements that say what they are (menus, footers, forms, adverts, comments, by tag, role or class) go as well, and if the page
marks its article, the blocks outside it.

A class says what an element is only as a whole (``sidebar``, ``cookie-banner``, not ``no-sidebar``). An element that holds
more than half of the page's text outside links is its content whatever its class, and so is a form around it; of
comments it takes nine tenths.

The rest of a page is its longest block outside the subtree that is neither boilerplate nor mostly links, nor outside a
marked article. Copies of an article have the same rest whatever their dates, menus and related links are, so its
paragraphs are no template. A subtree with more than half of a page's such text is that page's content and does not
count there. Two templates that are both longer than every block of a page's own hide each other there and stay.

Null and empty pages have the empty text. Repeated rows each get their text. Pages without a host in their address share the
empty host. Broken markup is read as browsers do: unknown signs are text, open elements end with their parent. An
empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import html
import re
from collections import defaultdict
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from casemill.llm.shipping import ship
from casemill.llm.words import slices
from casemill.sources.scratch import written

#: A subtree is a template if it is on so many pages of its host, and on this share of them.
LEAST_PAGES, LEAST_SHARE = 3, 0.01
#: Prose of a marked article is one only on so many pages and on this share of them.
PROSE_PAGES, PROSE_SHARE = 8, 0.9
#: Recurring subtrees that are sent to every executor at most, 8 bytes each.
SENT_TEMPLATES = 500_000
#: On so many pages it is one whatever their share.
MANY_PAGES = 100
#: Elements nested deeper open no level of their own, as in browsers; their text counts to the last level.
DEPTH = 512

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>""", re.S)
_MARK = re.compile(r"""\b(class|id|role|hidden|aria-hidden|style)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
_PART = re.compile(r"[a-z0-9]+")
_NO_CLAIM, _CLAIM, _COMMENTS = 0, 1, 2
#: Elements by the part they play in HTML.
RAW = set("script style textarea title noscript template iframe svg math xmp select object canvas audio video button".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split()
)
CONTENT = set("p h1 h2 h3 h4 h5 h6 blockquote pre ul ol dl table figure".split())
HASHED = set("nav header footer aside div section form menu dialog details center address fieldset".split()) | CONTENT
BOILER_TAGS = set("nav footer aside menu dialog".split())
FIELD_TAGS = set("form fieldset".split())
COMMENT_WORDS = set("comment comments disqus replies respond".split())
BOILER_ROLES = set("navigation banner contentinfo complementary search form dialog alert menu menubar toolbar".split())
BOILER_WORDS = set(
    "nav navbar navigation menu header footer sidebar aside ad ads adv advert adverts advertisement banner sponsor sponsored promo promotion cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe signup login search share sharing social related recommended breadcrumb breadcrumbs pagination pager comment comments disqus replies respond widget toolbar".split()
)
#: An element that begins one of these ends an open one of the same row.
_SAME = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}


def _chain(digest: bytes, more: bytes) -> bytes:
    return blake2b(digest + more, digest_size=8).digest()


class _Element:
    __slots__ = ("tag", "boiler", "main", "digest", "hashed", "blocks", "claim")

    def __init__(self, tag, boiler, main, hashed, digest, claim):
        self.tag, self.boiler, self.main, self.hashed, self.digest, self.blocks, self.claim = tag, boiler, main, hashed, digest, [], claim


def _claim(name: str, marks: dict[str, str]) -> int:
    """What an element says of itself by its class, its id, or as a form."""
    if name in ("html", "body", "main", "article"):
        return _NO_CLAIM
    said = [set(_PART.findall(token)) for token in f"{marks.get('class', '')} {marks.get('id', '')}".split()]
    said = [words for words in said if words and words <= BOILER_WORDS]
    if said and all(words & COMMENT_WORDS for words in said):
        return _COMMENTS
    return _CLAIM if said or name in FIELD_TAGS else _NO_CLAIM


def _mark(text: str) -> int:
    return int.from_bytes(_chain(b"", text.encode("utf-8", "replace")), "little", signed=True)


def blocks_of(page: str | None) -> tuple[list[tuple[str, list[int], bool, bool, bool]], list[int]]:
    """(text, hashes of the elements around it, boilerplate, in the article, mostly links) of each block, and all hashes of the page."""
    page = page or ""
    found: list[list] = []
    hashes: dict[int, None] = {}
    claims: list[tuple[int, list[int]]] = []
    stack: list[_Element] = []
    buffer: list[str] = []
    linked, in_link = 0, False

    def flush() -> None:
        nonlocal linked
        links = 2 * linked > sum(map(len, buffer))
        linked = 0
        text = " ".join(html.unescape("".join(buffer)).split()) if buffer else ""
        buffer.clear()
        if text:
            top = stack[-1] if stack else None
            found.append([text, [], bool(top and top.boiler), bool(top and top.main), links])
            if top:
                top.digest = _chain(top.digest, text.encode("utf-8", "replace"))
                top.blocks.append(len(found) - 1)

    def close() -> None:
        gone = stack.pop()
        if gone.claim and gone.blocks:
            claims.append((gone.claim, gone.blocks.copy()))
        prose = gone.main and gone.tag in CONTENT and not all(found[at][4] for at in gone.blocks)
        if gone.hashed and gone.blocks:
            mark = int.from_bytes(gone.digest, "little", signed=True) & -2 | prose  # the lowest bit tells prose
            hashes[mark] = None
            for at in gone.blocks:
                found[at][1].append(mark)
        if stack:
            stack[-1].digest = _chain(stack[-1].digest, gone.digest)
            stack[-1].blocks.extend(gone.blocks)

    at, size = 0, len(page)
    while at < size:
        tag = _TAG.search(page, at)
        if tag is None:
            buffer.append(page[at:])
            linked += in_link * (size - at)
            break
        if tag.start() > at:
            buffer.append(page[at : tag.start()])
            linked += in_link * (tag.start() - at)
        at = tag.end()
        name = tag[2] or tag[5]
        if name is None:
            continue
        name = name.lower()
        if name == "a":
            in_link = not (tag[1] or tag[4])
        if tag[1] or tag[4]:
            if name in BLOCK:
                flush()
                if name == "p" and not any(x.tag == "p" for x in stack):
                    continue
                if any(x.tag == name for x in stack):
                    while stack[-1].tag != name:
                        close()
                    close()
            elif name in RAW:
                continue
            continue
        if name in RAW:
            end = re.compile(f"</{re.escape(name)}[^>]*>", re.I).search(page, at)
            at = end.end() if end else size
            buffer.append(" ")
            continue
        if name not in BLOCK:
            if name == "br":
                buffer.append(" ")
            continue
        flush()
        if name in VOID or len(stack) >= DEPTH:
            continue
        while stack and stack[-1].tag == "p":  # a block ends an open paragraph
            close()
        same = _SAME.get(name)
        while same and stack and stack[-1].tag in same:
            close()
        marks = {k.lower(): v.strip("\"'").lower() for k, v in _MARK.findall(tag[3] or tag[6] or "")}
        parent = stack[-1] if stack else None
        main = bool(parent and parent.main) or name in ("article", "main") or marks.get("role") == "main"
        frame = name in ("html", "body", "main", "article")
        boiler = bool(parent and parent.boiler) or not frame and (
            name in BOILER_TAGS
            or name == "header" and not main
            or marks.get("role") in BOILER_ROLES
            or "hidden" in marks
            or marks.get("aria-hidden") == "true"
            or "display:none" in marks.get("style", "").replace(" ", "")
        )
        hashed = name in HASHED
        stack.append(_Element(name, boiler, main, hashed, _chain(b"", f"{name} {marks.get('class', '')}".encode("utf-8", "replace")), _claim(name, marks)))
    flush()
    while stack:
        close()
    plain = [0 if boiler or links else len(text) for text, _, boiler, _, links in found]
    whole = sum(plain)
    for claim, inside in claims:
        if (20 if claim == _CLAIM else 11) * sum(plain[at] for at in inside) <= 10 * whole:
            for at in inside:
                found[at][2] = True
    return [tuple(b) for b in found], list(hashes)


def rests(blocks: list[tuple], hashes: list[int]) -> tuple[int | None, list[tuple[int, int | None]]]:
    """Hash of the page's longest block of its own; for each subtree its hash, the hash of the longest such block outside
    it (none: it is the page's content)."""
    marked = any(m for _, _, _, m, _ in blocks)
    kept = [b for b in blocks if not b[2] and (b[3] or not marked)]
    own = sorted((b for b in kept if not b[4]), key=lambda b: (-len(b[0]), b[0]))
    total = sum(len(b[0]) for b in own)
    inside: dict[int, int] = defaultdict(int)
    for b in own:
        for mark in set(b[1]):
            inside[mark] += len(b[0])
    content = {mark for mark, size in inside.items() if 2 * size > total}
    if not own:
        return None, [(mark, None) for mark in hashes]
    longest = _mark(own[0][0])
    rest = dict.fromkeys(hashes, longest)
    around = set(own[0][1])
    for b in own[1:]:
        if not around:
            break
        if out := around.difference(b[1]):
            rest.update(dict.fromkeys(out, _mark(b[0])))
            around -= out
    rest.update(dict.fromkeys(around | content))
    return longest, [(mark, rest[mark]) for mark in hashes]


def _addressed(pages: DataFrame, key: str, url: str, page: str) -> DataFrame:
    """``key``, ``url``, ``host`` (its hash), ``html``."""
    host = F.coalesce(F.lower(F.regexp_extract(F.col("url"), r"^[a-zA-Z][\w+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)), F.lit(""))
    rows = pages.select(pages[key].alias("key"), pages[url].alias("url"), F.coalesce(pages[page], F.lit("")).alias("html"))
    return rows.select("key", "url", F.xxhash64(host).alias("host"), "html")


def _placed(host: int, mark: int) -> int:
    """One number for a subtree of a host."""
    return (host * 0x9E3779B97F4A7C15 + mark) & (2**64 - 1)


def subtrees(rows: DataFrame) -> DataFrame:
    """(``host``, ``hash``, ``rest``) of every subtree of every page, and for each page a row without ``hash`` whose ``rest`` is the page's longest block of its own."""

    def found(batches):
        for some in slices(batches, "html"):
            hosts, hashes, rests_ = [], [], []
            for host, page in zip(some["host"].to_pylist(), some["html"].to_pylist()):
                main, told = rests(*blocks_of(page))
                told = [(mark, rest) for mark, rest in told if rest is not None]
                hosts += [host] * (1 + len(told))
                hashes += [None, *[mark for mark, _ in told]]
                rests_ += [main, *[rest for _, rest in told]]
            yield pa.record_batch({"host": pa.array(hosts, pa.int64()), "hash": pa.array(hashes, pa.int64()), "rest": pa.array(rests_, pa.int64())})

    return rows.select("host", "html").mapInArrow(found, "host long, hash long, rest long")


def templates(rows: DataFrame, least_pages: int = LEAST_PAGES, least_share: float = LEAST_SHARE) -> DataFrame:
    """(``host``, ``hash``) of the subtrees that recur. Pages with the same rest beside a subtree are one page here."""
    counted = subtrees(rows).groupBy("host", "hash", "rest").agg(F.count("*").alias("_")).groupBy("host", "hash").agg(F.count("*").alias("n"))
    counted = written(counted.where(F.col("hash").isNull() | (F.col("n") >= least_pages)), "subtrees")
    pages = counted.where("hash IS NULL").select("host", F.col("n").alias("pages"))
    recurring = counted.where("hash IS NOT NULL").join(pages, "host")
    prose = F.col("hash").bitwiseAND(F.lit(1)) == 1
    enough = F.when(prose, F.greatest(F.lit(PROSE_PAGES), PROSE_SHARE * F.col("pages"))).otherwise(F.least(least_share * F.col("pages"), F.lit(MANY_PAGES)))
    return recurring.where(F.col("n") >= enough).select("host", "hash")


def _joined(blocks: list[tuple], deleted) -> str:
    """The text of the blocks that stay; ``deleted`` tells whether a subtree goes."""
    marked = any(block[3] for block in blocks)
    return "\n".join(text for text, around, boiler, main, _ in blocks if not boiler and (main or not marked) and not any(map(deleted, around)))


def main_text(pages: DataFrame, key: str = "page_id", url: str = "url", page: str = "html", least_pages: int = LEAST_PAGES, least_share: float = LEAST_SHARE) -> DataFrame:
    """One row per page: key, url, ``text``, ``n_chars``.

    Up to ``SENT_TEMPLATES`` recurring subtrees are sent to every executor, and pages are parsed and cut in one go. More are
    joined to the pages that have them, by the hashes of a page's subtrees."""
    ship(pages.sparkSession)
    rows = _addressed(pages, key, url, page)
    found = written(templates(rows, least_pages, least_share), "templates")
    kind = pages.schema[key].dataType.simpleString()
    if found.count() <= SENT_TEMPLATES:
        keys = found.toPandas()
        sent = pages.sparkSession.sparkContext.broadcast(np.array([_placed(h, m) for h, m in zip(keys["host"].tolist(), keys["hash"].tolist())], np.uint64))

        def cut(batches):
            gone = set(sent.value.tolist())
            for some in slices(batches, "html"):
                texts = [_joined(blocks_of(x)[0], lambda mark, host=host: _placed(host, mark) in gone) for host, x in zip(some["host"].to_pylist(), some["html"].to_pylist())]
                yield pa.record_batch({"key": some["key"], "url": some["url"], "text": pa.array(texts, pa.string())})

        rows = rows.mapInArrow(cut, f"key {kind}, url string, text string")
    else:
        rows = rows.withColumn("content", F.xxhash64("html", "host"))
        own = rows.select("content", "host", "html").mapInArrow(_marks, "content long, host long, hash long").distinct()
        deleted = own.join(found, ["host", "hash"]).groupBy("content").agg(F.collect_set("hash").alias("deleted"))  # a page's subtrees at most

        def cut(batches):
            for some in slices(batches, "html"):
                gone = [set(x or ()) for x in some["deleted"].to_pylist()]
                texts = [_joined(blocks_of(x)[0], own.__contains__) for own, x in zip(gone, some["html"].to_pylist())]
                yield pa.record_batch({"key": some["key"], "url": some["url"], "text": pa.array(texts, pa.string())})

        rows = rows.join(deleted, "content", "left").select("key", "url", "html", "deleted").mapInArrow(cut, f"key {kind}, url string, text string")
    return rows.select(F.col("key").alias(key), F.col("url").alias(url), "text").withColumn("n_chars", F.char_length("text").cast("long"))


def _marks(batches):
    for some in slices(batches, "html"):
        marks = [blocks_of(x)[1] for x in some["html"].to_pylist()]
        sizes = [len(m) for m in marks]
        flat = [m for own in marks for m in own]
        yield pa.record_batch({"content": pa.array(np.repeat(some["content"].to_numpy(), sizes)), "host": pa.array(np.repeat(some["host"].to_numpy(), sizes)), "hash": pa.array(flat, pa.int64())})

"""Main text of web pages, by the template that the pages of one host share.

First pass: every page is read into tokens, a tag with its path of open elements or a block of
text with its path. Pages whose own text is the same count once. A token's occurrence vector (how
often it stands on each page of the host) is kept as one hash, combined over pages without order, so
Spark aggregates it before the shuffle and a host with a third of all pages is no hot group. Tokens
with the same vector form an equivalence class; a class is valid when it has several tokens and
stands on at least half of the host's pages. The valid classes, nested by path, are the host's
template, whose size is at most twice the average number of tokens of a page.

Second pass: the text between template tokens is what the slots hold. Slots inside menus, headers,
footers, sidebars, notices, adverts, forms, scripts, styles and reader comments are left out by
their element or name. Of the rest the element that holds nearly all of the host's text is the
content, an article or main before others; its text is kept without that of the template. Pages
without the template fall back on the article or main they mark.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from hashlib import blake2b
from html import unescape

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import pin
from .arrow import arrow_schema, batch_of, small, spark_schema
from .url_templates import host_of

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>",
    re.S,
)
_ATTRIBUTE = re.compile(
    r"([^\s\"'<>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?"
)
_HIDDEN = re.compile(r"(?:^|;)\s*display\s*:\s*none", re.I)
_SPACE = re.compile(r"\s+")
_NAME = re.compile(r"[a-z]+")

# Elements of HTML by their role.
RAW = frozenset("script style textarea title noscript template iframe svg annotation object".split())
# Of these a missing end tag makes the rest of the page theirs, as in a browser.
RAW_TO_THE_END = frozenset("script style textarea title iframe".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q "
    "s samp small span strike strong sub sup time tt u var wbr "
    "math semantics mi mn mo ms mtext mspace mrow mfrac msqrt mroot mstyle merror mpadded mphantom "
    "menclose mfenced msub msup msubsup munder mover munderover mmultiscripts mprescripts none "
    "mtable mtr mlabeledtr mtd maction".split()
)
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
    "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"},
}
SCOPES = frozenset("ul ol dl table select article section div main body".split())
MAIN = frozenset("article main".split())
ASIDE = frozenset(
    "nav footer aside form button select menu dialog fieldset input head".split()
)
# Words of class, id and role names that mark what is not the article.
ASIDE_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner "
    "cookie cookies consent gdpr notice notices notification alert popup modal overlay "
    "newsletter subscribe signup sidebar menu nav navbar navigation breadcrumb breadcrumbs "
    "pagination pager footer masthead comment comments commentlist disqus respond reply replies "
    "share sharing social related recommended widget login search complementary contentinfo".split()
)
# Words that may stand beside these in one name, as in "comment-list".
BESIDE_ASIDE = frozenset("area bar block bottom box form item items links list section site top".split())


@dataclass
class _Open:
    tag: str
    path: str
    aside: bool
    main: bool
    named: bool = False  # inside an element that only its name marks as an aside


@dataclass
class Block:
    path: str
    text: str
    aside: bool
    main: bool
    link_chars: int
    above: tuple[str, ...]
    doubtful: bool = False


@dataclass
class Page:
    blocks: list[Block] = field(default_factory=list)
    tags: Counter = field(default_factory=Counter)


def _is_aside_name(name: str) -> bool:
    """Whether a whole class, id or role name is an aside's: "cookie-banner", not "has-sidebar"."""
    words = set(_NAME.findall(name))
    return not ASIDE_NAMES.isdisjoint(words) and words <= ASIDE_NAMES | BESIDE_ASIDE


def _names(attributes: str) -> tuple[str, bool, bool, str]:
    """Sorted class and id words of a tag, whether its names are an aside's, whether it is hidden,
    and its role."""
    found: dict[str, str] = {}
    for name, *values in _ATTRIBUTE.findall(attributes):
        found.setdefault(name.lower(), next(filter(None, values), ""))
    role = found.get("role", "").lower()
    label = f"{found.get('class', '')} {found.get('id', '')}".lower()
    aside = any(map(_is_aside_name, f"{label} {role}".split()))
    hidden = "hidden" in found or bool(_HIDDEN.search(found.get("style", "")))
    return ".".join(sorted(set(_NAME.findall(label)))), aside, hidden, role


def read_page(html: str) -> Page:
    """Blocks of text and tag paths of a page, in order; broken markup is read as far as it goes.

    Unclosed elements end with the element around them, end tags without a start are skipped, a
    ``<`` that starts no tag is text. An article or main inside an element that only its name marks
    as an aside is the page's article if no other one holds text.
    """
    page, stack = Page(), [_Open("", "", False, False)]
    parts: list[str] = []
    links = 0

    def flush() -> None:
        nonlocal links
        text = _SPACE.sub(" ", unescape("".join(parts))).strip()
        parts.clear()
        if text:
            top = stack[-1]
            above = tuple(o.path for o in stack[1:])
            page.blocks.append(
                Block(
                    top.path, text, top.aside or (top.named and not top.main), top.main, links,
                    above, top.main and top.named,
                )
            )
        links = 0

    def in_link() -> bool:
        return any(o.tag == "a" for o in stack)

    def add(text: str) -> None:
        nonlocal links
        if text:
            parts.append(text)
            if len(stack) > 1 and in_link():
                links += len(text)

    def close(tags: set[str], scopes: frozenset) -> None:
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in tags:
                if any(o.tag not in INLINE for o in stack[i:]):
                    flush()
                del stack[i:]
                return
            if stack[i].tag in scopes:
                return

    at = 0
    while found := _MARKUP.search(html, at):
        add(html[at : found.start()])
        at = found.end()
        ending, tag, attributes = found[1], found[2], found[3]
        if tag is None:
            continue
        tag = tag.lower()
        if ending:
            if tag not in VOID:
                close({tag}, frozenset())
            continue
        if tag in RAW:
            if tag == "svg" and attributes.endswith("/"):
                continue
            end = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(html, at)
            if end or tag in RAW_TO_THE_END:
                at = end.end() if end else len(html)
            continue
        if tag not in INLINE:
            flush()
            close({"p"}, SCOPES)
            if tag in CLOSES:
                close(CLOSES[tag], SCOPES)
        if tag in VOID:
            if tag == "br":
                add(" ")
            continue
        names, named_aside, hidden, role = (
            _names(attributes) if attributes.strip(" /") else ("", False, False, "")
        )
        top = stack[-1]
        is_main = tag in MAIN or role == "main"
        aside = top.aside or tag in ASIDE or hidden
        named = top.named
        if is_main:
            if tag == "article":
                aside = aside or not {"comment", "comments", "ad"}.isdisjoint(names.split("."))
        elif tag not in ("html", "body"):
            aside = aside or (tag == "header" and not top.main)
            if top.main:
                aside = aside or named_aside
            else:
                named = named or named_aside
        path = f"{top.path}/{tag}" + (f".{names}" if names else "")
        if tag not in INLINE:
            page.tags[path] += 1
        if not attributes.endswith("/"):
            stack.append(_Open(tag, path, aside, (top.main or is_main) and not aside, named))
    add(html[at:])
    flush()
    sure = any(b.main and not b.doubtful for b in page.blocks)
    for block in page.blocks:
        if block.doubtful and sure:
            block.aside, block.main = True, False
    return page


def _token(path: str, text: str | None = None) -> bytes:
    """A short name of a token: 8 bytes of a hash."""
    body = path if text is None else f"{path}\0{text}"
    return blake2b(body.encode("utf-8", "surrogatepass"), digest_size=8).digest()


_TOKENS = arrow_schema(
    host="string", page="int64", body="int64", size="int64",
    tokens=pa.list_(
        pa.struct(
            {"token": pa.binary(), "path": pa.string(), "tag": pa.bool_(), "n": pa.int64(), "chars": pa.int64()}
        )
    ),
)


def _is_text(block: Block) -> bool:
    """Whether a block counts as a page's own text: no aside and not mostly links."""
    return not block.aside and 2 * block.link_chars <= len(block.text)


def _tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per page: its tags with the text below them and its blocks of text, and a hash
    (``body``) and the length (``size``) of the page's own text."""
    row = TaskContext.get().partitionId() << 33
    for batch in small(batches):
        rows = []
        for host, html in zip(batch["host"].to_pylist(), batch["html"].to_pylist(), strict=True):
            page = read_page(html)
            below, texts, chars = Counter(), {}, Counter()
            body, size = blake2b(digest_size=8), 0
            for block in page.blocks:
                token = _token(block.path, block.text)
                texts[token] = (block.path, texts.get(token, ("", 0))[1] + 1)
                if _is_text(block):
                    own = len(block.text) - block.link_chars
                    for path in set(block.above):
                        below[path] += own
                    chars[token] += own
                    size += own
                    body.update(_token("", block.text))
            found = [(_token(path), path, True, n, below[path]) for path, n in page.tags.items()]
            found += [(token, path, False, n, chars[token]) for token, (path, n) in texts.items()]
            names = ("token", "path", "tag", "n", "chars")
            named = [dict(zip(names, t, strict=True)) for t in found]
            rows.append((host, row, int.from_bytes(body.digest(), "big", signed=True), size, named))
            row += 1
        yield batch_of(rows, _TOKENS)


def host_templates(pages: DataFrame) -> DataFrame:
    """One row per host with a template: its content ``slot`` and its constant ``texts``.

    ``pages`` has host and html without nulls. Pages of a host whose own text is the same have one
    vote, so an article that stands on many pages is no template. A token is in the template when
    its class is valid: two tokens or more with one occurrence vector, on at least half of the
    host's votes and on three or more. The texts of a class are template only where the pages
    holding them have as much other text: copies of an article that differ in a line are none.
    """
    read = pin(pages.mapInArrow(_tokens, spark_schema(_TOKENS)), "page-tokens")
    bodies = pin(
        read.groupBy("host", "body").agg(
            F.min("page").alias("first"), F.count(F.lit(1)).alias("copies")
        ),
        "page-bodies",
    )
    sizes = bodies.groupBy("host").agg(F.count(F.lit(1)).alias("host_pages"))
    # Only the groups of copies are joined: a short list, or none.
    repeated = bodies.where(F.col("copies") > 1).select("host", "body", "first")
    votes = read.join(repeated, ["host", "body"], "left").where(
        F.col("first").isNull() | (F.col("page") == F.col("first"))
    )
    vectors = (
        votes.select("host", "page", "size", F.explode("tokens").alias("t"))
        .select("host", "page", "size", "t.*")
        .groupBy("host", "token")
        .agg(
            F.count(F.lit(1)).alias("pages"),
            F.bit_xor(F.xxhash64("page", "n")).alias("vector"),
            F.sum("n").alias("n"),
            F.sum("chars").alias("chars"),
            F.sum("size").alias("size"),
            F.first("path").alias("path"),
            F.first("tag").alias("tag"),
        )
        .join(sizes, "host")
        .where((F.col("pages") >= 3) & (2 * F.col("pages") >= F.col("host_pages")))
    )
    # Half of the host's pages hold each of these tokens, so a host has at most twice as many as
    # its pages have on average: one row per host is bounded by its largest pages.
    tag = F.struct("path", (F.col("n") == F.col("pages")).alias("once"), "chars")
    text = F.struct("path", "token", "chars")
    in_class = vectors.groupBy("host", "vector", "pages").agg(
        F.count(F.lit(1)).alias("tokens"),
        F.coalesce(F.sum(F.when(~F.col("tag"), F.col("chars"))), F.lit(0)).alias("chars"),
        F.max("size").alias("size"),
        F.collect_list(F.when(F.col("tag"), tag)).alias("tags"),
        F.collect_list(F.when(~F.col("tag"), text)).alias("texts"),
    )
    constant = F.filter("texts", lambda _: 2 * F.col("chars") <= F.col("size"))
    return (
        in_class.where(F.col("tokens") >= 2)
        .select("host", "tags", constant.alias("texts"))
        .groupBy("host")
        .agg(
            F.flatten(F.collect_list("tags")).alias("tags"),
            F.flatten(F.collect_list("texts")).alias("texts"),
        )
        .mapInArrow(_slots, spark_schema(_TEMPLATES))
    )


_TEMPLATES = arrow_schema(host="string", slot="string", texts=pa.list_(pa.binary()))


def _slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in small(batches):
        rows = zip(*(batch[n].to_pylist() for n in ("host", "tags", "texts")), strict=True)
        yield batch_of(
            [
                (host, content_slot(tags, texts), [t["token"] for t in texts])
                for host, tags, texts in rows
            ],
            _TEMPLATES,
        )


def _is_labelled(path: str) -> bool:
    """Whether an element of the path is an article or main."""
    return any(part.partition(".")[0] in MAIN for part in path.split("/"))


def content_slot(tags: list[dict], texts: list[dict]) -> str | None:
    """The template element whose slots hold the article.

    Elements of the valid classes nest by their paths, and what their slots hold is the text below
    them without the template's. An article or main with at least half of it is the content, the
    outermost if several are; else the deepest element, once on a page, with nearly all of it.
    """
    constant = Counter()
    for text in texts:
        parts = text["path"].split("/")
        for i in range(2, len(parts) + 1):
            constant["/".join(parts[:i])] += text["chars"]
    held = {t["path"]: t["chars"] - constant[t["path"]] for t in tags}
    once = [t["path"] for t in tags if t["once"]]
    most = max((held[p] for p in once), default=0)
    if most <= 0:
        return None
    labelled = [p for p in held if _is_labelled(p) and 2 * held[p] >= most]
    if labelled:
        return min(labelled, key=lambda p: (p.count("/"), p))
    return max((p for p in once if 10 * held[p] >= 8 * most), key=lambda p: (p.count("/"), p))


def main_text(html: str, slot: str | None = None, texts: list[bytes] | None = None) -> str:
    """The main text of a page, given its host's content slot and template texts; blocks are joined by two line ends.

    On a page that has the template's content slot that slot is read, without the template's texts.
    Inside a slot that is no article or main itself, and on other pages, an article or main with at
    least half of the text is.
    """
    blocks = [b for b in read_page(html).blocks if not b.aside]
    known = set(texts or [])
    kept = [b for b in blocks if slot and (b.path == slot or slot in b.above)] or blocks
    kept = [b for b in kept if _token(b.path, b.text) not in known]
    main = [b for b in kept if b.main]
    if 2 * sum(len(b.text) for b in main) >= sum(len(b.text) for b in kept if _is_text(b)):
        kept = main or kept
    return "\n\n".join(b.text for b in kept)


_TEXTS = arrow_schema(page_id="int64", url="string", text="string")


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in small(batches):
        columns = [batch[n].to_pylist() for n in ("page_id", "url", "html", "slot", "texts")]
        yield batch_of(
            [(p, u, main_text(h, slot, texts)) for p, u, h, slot, texts in zip(*columns, strict=True)],
            _TEXTS,
        )


def extract_text(pages: DataFrame) -> DataFrame:
    """``page_id``, ``url`` and main ``text`` of every page.

    A null html is empty, and a page without main text has the empty text. A null or host-less
    url is a host of its own kind (empty), so such pages share one template. Null ids stay null,
    repeated rows stay repeated, other columns are not read; no rows give no rows.
    """
    narrow = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        "url",
        F.coalesce("html", F.lit("")).alias("html"),
        host_of(F.col("url")).alias("host"),
    )
    # Written first, so that the join stands between two tables: a short list of hosts is sent to
    # the pages, and the pages of a hot host can be split among tasks.
    templates = pin(host_templates(narrow.select("host", "html")), "templates")
    return (
        narrow.join(templates, "host", "left")
        .select("page_id", "url", "html", "slot", "texts")
        .mapInArrow(_extract, spark_schema(_TEXTS))
    )

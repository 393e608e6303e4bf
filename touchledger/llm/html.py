"""Main text of web pages by equivalence-class template deduction.

Tokens of a page are its elements, told apart by their path, and its texts, told apart by path, as a whole and, up to
twelve words, word by word. Over the pages of a host every token has an occurrence vector: how often it occurs on
each page. Tokens that share a vector form an equivalence class; a class of several tokens that occurs on at least half
of the host's pages belongs to the template, if the elements around its tokens do too, so that classes nest. What a page
has between the tokens of the template are the slots, and their values are its data.

A vector is held as the sum modulo 2^64 of a mix of page and count, with the number of pages and occurrences; it is summed
up in the tasks and shuffled once per task, host and token, so a host with a third of all pages is no hot group, and
no page moves. Hosts with few pages take the template of all hosts together.

Slots are told apart by the elements around them. Those of navigation, headers, footers, sidebars, notices, adverts,
forms and comments are left out; a class or id says so only as a whole name, never on a heading, and a name that an
article's part may have as well counts within one only for texts that repeat or consist of links. A main element, or the
only article, below an element with such a name is taken. Where the page has slots in an article or main element, only
these are taken, else all but those that consist of links, for half or more of their characters, on half or more of the
host's pages and on the page itself. Texts that are template tokens throughout are left out, in an article
too; its headings stay, and an article that is the template's throughout (pages that are copies) stays whole.

Defined results: null and empty pages give the empty text; a page without a host belongs to the host ``''``; a page that
is cut off, or whose elements are not closed, is read as far as it goes; repeated rows count as pages of their own and
each get their text; columns of the input with a result's name give way.
"""

from __future__ import annotations

import functools
import html as entities
import re
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchledger.plans.workspace import Workspace

# Kinds of elements in HTML, and words in class and id names that say what an element is for.
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark math q rp "
                   "rt ruby s samp small span strike strong sub sup svg time tt u var wbr "
                   # elements of formulas
                   "annotation annotation-xml maction merror mfenced mfrac mi mmultiscripts mn mo mover mpadded mphantom "
                   "mprescripts mroot mrow ms mspace msqrt mstyle msub msubsup msup mtable mtd mtext mtr munder munderover "
                   "semantics".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp template noembed noframes svg".split())
BOILERPLATE = frozenset("nav footer aside form script style noscript template iframe button select option textarea "
                        "input label menu dialog head object canvas audio video map fieldset legend annotation "
                        "annotation-xml".split())
HEADER = frozenset({"header"})
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
MAIN = frozenset("article main".split())
HINTS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense adbox sponsor sponsored promo promotion banner cookie "
    "cookies consent gdpr notice notification alert popup modal overlay newsletter subscribe subscription signup "
    "sidebar aside widget menu nav navbar navigation breadcrumb breadcrumbs masthead footer comment comments "
    "commentlist disqus reply replies respond discussion related recommended recommendations share sharing social "
    "toolbar pagination pager copyright login search skip".split())
#: Hints that may as well name a part of an article; there they count only with evidence beside them.
UNSURE = frozenset(
    "notice notification alert banner popup modal overlay menu aside widget footer comment reply replies respond "
    "discussion related recommended recommendations promotion copyright login search skip".split())
#: Pieces that leave a class or id name a hint: before one, after one.
BEFORE = frozenset("site page post entry article top bottom left right main primary secondary global".split())
AFTER = frozenset("box bar list link links icon icons button buttons left right top bottom".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar "
                  "toolbar".split())
#: Elements whose start ends an open one of these kinds.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
          "th": {"td", "th"}, "option": {"option"}, "tbody": {"thead", "tbody", "tr", "td", "th"}, "body": {"head"}}

LONG = 12
#: A host with fewer pages takes the common template; the least tokens of a class; the least share of pages.
FEW_PAGES, CLASS_SIZE, SUPPORT = 8, 3, 0.5
#: Bytes of templates up to which they are broadcast.
BROADCAST = 64 << 20

_TAG = re.compile(r"""<(?:!--.*?(?:-->|\Z)|(/?)([A-Za-z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+|[^>]*+)>|[!?/][^>]*>)""",
                  re.DOTALL)
_ATTRIBUTE = re.compile(r"""([A-Za-z_:][\w:.-]*)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_PIECE = re.compile(r"[A-Za-z][a-z]*|[0-9]+")
_HOST = re.compile(r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", re.IGNORECASE)
_END = {name: re.compile(rf"</{name}(?=[\s/>])[^>]*>", re.IGNORECASE) for name in RAW}
_names: dict[tuple[int, str], int] = {}


def _hash(parent: int, name: str) -> int:
    known = _names.get((parent, name))
    if known is None:
        known = xxhash.xxh64_intdigest(name.encode("utf-8", "replace"), parent & 0xFFFFFFFF)
        known = xxhash.xxh64_intdigest(known.to_bytes(8, "little"), parent >> 32)
        if len(_names) >= 200_000:
            _names.clear()
        _names[parent, name] = known
    return known


class Element:
    """An open element: its path's hash, whether it is boilerplate, in an article, in a link or in a header.

    ``hinted`` says that it is boilerplate by a name alone, ``below`` that it is in an article under such an element,
    ``unsure`` that it is in an article, in an element with a name that may mean boilerplate.
    """

    __slots__ = ("tag", "path", "dropped", "main", "link", "header", "up", "hinted", "below", "unsure", "anchor")

    def __init__(self, tag, path, dropped, main, link, header, up, hinted=False, below=False, unsure=False):
        self.tag, self.path, self.dropped, self.main, self.link = tag, path, dropped, main, link
        self.header, self.up, self.hinted, self.below, self.unsure = header, up, hinted, below, unsure
        self.anchor = 0  # place of the link that holds it, if nothing but inline elements is between


def _hint(name: str, hints: frozenset) -> bool:
    """Whether a class or id name as a whole is a hint: one, or several with only words around them that say where."""
    pieces = [p.lower() for p in _PIECE.findall(name)]
    if name.lower() in hints or "".join(pieces) in hints:
        return True
    while pieces and (pieces[-1] in AFTER or pieces[-1].isdigit()):
        pieces.pop()
    at = next((i for i, p in enumerate(pieces) if p not in BEFORE), len(pieces))
    return at < len(pieces) and all(p in HINTS or p in hints for p in pieces[at:]) and any(p in hints for p in pieces[at:])


@functools.lru_cache(maxsize=50_000)
def _kinds(marks: str) -> tuple[bool, bool, bool, bool]:
    """Of class and id: whether one of their names is a sure hint, an unsure one, a header, an article's body."""
    names = marks.split()
    return (any(_hint(n, HINTS - UNSURE) for n in names), any(_hint(n, UNSURE) for n in names),
            any(_hint(n, HEADER) for n in names), {"article", "body"} <= {p.lower() for p in _PIECE.findall(marks)})


def _attributes(raw: str) -> tuple[str, tuple[bool, bool, bool, bool], bool]:
    """Name in the path, kinds of its class and id, whether the element is hidden or has a role that is boilerplate."""
    if not raw or "=" not in raw and "hidden" not in raw:
        return "", (False,) * 4, False
    found: dict[str, str] = {}
    for m in _ATTRIBUTE.finditer(raw):
        found.setdefault(m.group(1).lower(), (m.group(2) or "").strip("\"'"))
    marks = f"{found.get('class', '')} {found.get('id', '')}"
    style = found.get("style", "").replace(" ", "").lower()
    out = ("hidden" in found or found.get("aria-hidden") == "true" or "display:none" in style
           or found.get("role", "").lower() in ROLES)
    return "." + ".".join(marks.split()) if marks.strip() else "", _kinds(marks) if marks.strip() else (False,) * 4, out


def texts(page: str):
    """(text, element) for every text, (None, element) at the start of every element but inline ones, (None, None) at
    their ends."""
    root = Element("", 0, False, False, False, False, None)
    stack, at = [root], 0
    # Tags end by the last > of the page; how many elements of a name are open. So no text is searched twice in vain.
    last, opened = page.rfind(">") + 1, Counter()

    def close(place: int) -> None:
        opened.subtract(e.tag for e in stack[place:])
        del stack[place:]

    for m in iter(lambda: _TAG.search(page, at, last), None):
        if m.start() > at:
            yield page[at:m.start()], stack[-1]
        at = m.end()
        tag = m.group(2)
        if not tag:
            if m.group().startswith("<!--") and not m.group().endswith("-->"):
                at = len(page)  # a comment without an end
            continue
        tag = tag.lower()
        if m.group(1):
            if tag in INLINE:
                if tag != "br" and stack[-1].tag == tag:
                    close(len(stack) - 1)
                elif tag == "a" and stack[-1].anchor:
                    close(stack[-1].anchor)  # a link ends here, even if what is open in it has not
                continue
            if opened[tag] > 0:
                place = len(stack) - 1
                while stack[place].tag != tag:
                    place -= 1
                close(place)
            yield None, None
            continue
        if tag not in INLINE:
            # What cannot hold a block ends at one.
            while stack[-1].tag in INLINE or stack[-1].tag == "p" or stack[-1].tag in HEADINGS and (
                    tag == "p" or tag in HEADINGS):
                close(len(stack) - 1)
            closes = CLOSES.get(tag, ())
            while stack[-1].tag in closes:
                close(len(stack) - 1)
        top = stack[-1]
        name, (sure, unsure, named_header, article_body), hidden = _attributes(m.group(3) or "")
        named = tag not in HEADINGS and tag not in MAIN and tag not in ("html", "body")
        starts = tag in MAIN or tag in ("div", "section") and article_body
        inside = top.main or starts
        header = top.header or tag == "header" or named and named_header
        # An article or main element starts anew below a name, but not below what is boilerplate by more than that.
        held = top.dropped and not top.hinted or hidden or tag in BOILERPLATE
        hinted = not held and (named and (sure or unsure and not top.main) or top.hinted and (
            not starts or tag == "article" and (sure or unsure)))
        dropped = held or hinted
        below = inside and tag != "main" and (top.below or starts and top.hinted)
        doubt = top.unsure or named and unsure and top.main
        if tag in INLINE:
            element = Element(tag, top.path, dropped, top.main, top.link or tag == "a", top.header, top, hinted, top.below,
                              doubt)
            if tag in ("br", "img", "wbr"):
                if tag == "br":
                    yield " ", top
                continue
        else:
            element = Element(tag, _hash(top.path, tag + name) & ~1, dropped, inside, top.link, header, top, hinted, below,
                              doubt)
            yield None, element
        if tag in RAW:
            end = _END[tag].search(page, at, max(at, last))
            if tag == "xmp":  # text as it stands, without references
                yield page[at:end.start() if end else len(page)].replace("&", "&amp;"), element
                yield None, None
            at = end.end() if end else len(page)
            continue
        if tag not in VOID and not (m.group(3) or "").endswith("/"):
            if tag in INLINE:
                element.anchor = len(stack) if tag == "a" else top.anchor
            stack.append(element)
            opened[tag] += 1
    rest = page[at:]
    rest = rest[:rest.index("<!--")] if "<!--" in rest else rest
    if rest:
        yield rest, stack[-1]


def blocks(page: str, starts: list | None = None):
    """(text, element, length of its links) of every block with text; character references decoded, spaces single.

    ``starts`` gets the path of every element that is no inline one, where it starts.
    """
    def flushed():
        """The block's text, or, if it has nothing but boilerplate, that."""
        for parts, owner, linked in (kept, out):
            joined = " ".join("".join(parts).split())
            if joined:
                yield joined, owner, linked
                return

    kept, out = [[], None, 0], [[], None, 0]
    for text, element in texts(page):
        if text is None:
            if starts is not None and element is not None:
                starts.append(element.path)
            yield from flushed()
            kept, out = [[], None, 0], [[], None, 0]
            continue
        # boilerplate within a line is no part of it, wherever it stands
        line = out if element.dropped else kept
        if line[1] is None and not text.isspace():
            line[1] = element
        line[0].append(entities.unescape(text) if "&" in text else text)
        if element.link:
            line[2] += len(text)
    yield from flushed()


def _block(element: Element) -> Element:
    """The block that an inline element is in."""
    while element.tag in INLINE and element.up is not None:
        element = element.up
    return element


def _tokens(text: str, path: int) -> list[int]:
    """The token of the whole text, odd if it is long and even otherwise, as all others are; then those of its words."""
    words, whole = text.split(" "), _hash(path, "\1" + text)
    return [whole & ~1, *(_hash(path, "\0" + w) & ~1 for w in words)] if len(words) <= LONG else [whole | 1]


def _repeated(text: str, element: Element, template: frozenset) -> bool:
    """Whether a text is the template's, and the elements around it are.

    A text that occurs as a whole needs only the element around its own to be in the template: of an element that comes
    as often as a page has paragraphs, one may hold the same text on all pages.
    """
    whole, *words = _tokens(text, element.path)
    if whole in template:
        block = _block(element)
        return block.path in template or block.up is None or block.up.up is None or block.up.path in template
    return bool(words) and element.path in template and all(t in template for t in words)


def host_of(url: str | None) -> str:
    m = _HOST.match(url or "")
    return m.group(1).lower() if m else ""


def _tokens_of(page: str, found: list | None = None) -> list[int]:
    """All tokens of a page, each as often as it occurs; 0 stands for the page. ``found`` gets the page's blocks."""
    out = [0]
    for block in blocks(page, out):
        out += _tokens(block[0], block[1].path)
        if found is not None:
            found.append(block)
    return out


def _linked(found: list) -> set[int]:
    """Paths of the slots of a page that are links for half or more of their characters."""
    sums: dict[int, float] = {}
    for text, element, linked in found:
        sums[element.path] = sums.get(element.path, 0.0) + linked - 0.5 * len(text)
    return {path for path, more in sums.items() if more >= 0}


_SIGN = 1 << 63


def _signed(n: int) -> int:
    return n - (1 << 64) if n >= _SIGN else n


def _occurrences(batches, most: int = 200_000):
    """(host, token, vector, pages, occurrences, pages that have links there), summed up over as many pages as the bound on entries lets."""
    sums: dict[tuple[int, int], list[int]] = {}

    def out():
        keys, values = list(sums), list(sums.values())
        sums.clear()
        return pa.RecordBatch.from_arrays(
            [pa.array([_signed(x) for x in column], pa.int64()) for column in
             ([k[0] for k in keys], [k[1] for k in keys], *([v[i] for v in values] for i in range(4)))],
            names=["host", "token", "vector", "pages", "total", "linked"])

    for batch in batches:
        for number, url, page in zip(*(batch.column(c).to_pylist() for c in ("number", "url", "html"))):
            host, mixes, found = xxhash.xxh64_intdigest(host_of(url).encode()), {}, []
            tokens = Counter(_tokens_of(page or "", found))
            linked = _linked(found)
            for token, n in tokens.items():
                mix = mixes.get(n)
                if mix is None:
                    mix = mixes[n] = xxhash.xxh64_intdigest(n.to_bytes(8, "little"), number & (1 << 64) - 1)
                s = sums.get((host, token))
                if s is None:
                    sums[host, token] = [mix, 1, n, int(token in linked)]
                else:
                    s[0] = (s[0] + mix) & (1 << 64) - 1
                    s[1] += 1
                    s[2] += n
                    s[3] += token in linked
            if len(sums) >= most:
                yield out()
    if sums:
        yield out()


def templates(pages: DataFrame, workspace: Workspace) -> DataFrame:
    """(host, tokens, links): hash of the host, 0 for all hosts together; the tokens of its template, null if it has none
    of its own; and the paths of its slots that consist of links."""
    numbered = pages.select(F.xxhash64("page_id", "url", F.length("html")).alias("number"), "url", "html")
    # Halves of 32 bits, so that no sum overflows.
    half = F.lit((1 << 32) - 1)
    low, high = F.sum(F.col("vector").bitwiseAND(half)), F.sum(F.shiftrightunsigned("vector", 32))
    high = (high + F.shiftrightunsigned(low, 32)).bitwiseAND(half)
    added = [F.shiftleft(high, 32).bitwiseOR(low.bitwiseAND(half)).alias("vector"), F.sum("pages").alias("pages"), F.sum("total").alias("total")]
    schema = "host bigint, token bigint, vector bigint, pages bigint, total bigint, linked bigint"
    counted = (numbered.mapInArrow(_occurrences, schema)
               .groupBy("host", "token").agg(*added, F.sum("linked").alias("linked")))
    counted = workspace.settle(counted, "tokens")
    common = counted.groupBy("token").agg(*added).select(F.lit(0).cast("bigint").alias("host"), "*")
    own = counted.where("token = 0").select(F.col("host").alias("_host"), F.col("pages").alias("of"))
    # Of these, too, a host has at most 1 / SUPPORT times those of a page; any number of pages will do.
    links = (counted.where("linked > 0").join(own.hint("merge"), F.col("host") == F.col("_host"))
             .where(F.col("linked") >= SUPPORT * F.col("of")).groupBy("host").agg(F.collect_list("token").alias("links")))
    counted = counted.drop("linked").unionByName(common)
    whole = counted.where("token = 0").select(F.col("host").alias("_host"), F.col("pages").alias("of"))
    # Tokens on fewer pages than half the smallest host that counts are in no template.
    frequent = (counted.where(F.col("pages") >= FEW_PAGES * SUPPORT)
                .join(whole.where(F.col("of") >= FEW_PAGES).hint("merge"), F.col("host") == F.col("_host"))
                .where((F.col("pages") >= SUPPORT * F.col("of")) & (F.col("token") != 0)))
    # At most 1 / SUPPORT times the tokens of a page stand on as many pages, so these lists are short.
    tokens = (frequent.groupBy("host", "vector", "pages", "total").agg(F.collect_list("token").alias("class"))
            # A long text that repeats is as many tokens by itself.
            .where((F.size("class") >= CLASS_SIZE) | F.exists("class", lambda t: t.bitwiseAND(F.lit(1)) == 1))
            .groupBy("host").agg(F.flatten(F.collect_list("class")).alias("tokens")))
    return (tokens.unionByName(links, allowMissingColumns=True).groupBy("host")
            .agg(F.first("tokens", True).alias("tokens"), F.first("links", True).alias("links")))


def extract(page: str | None, template: frozenset, links: frozenset | None = None) -> str:
    """The main text of a page, given the tokens of its host's template and its host's slots of links.

    Without the latter the page is the only one of its host.
    """
    found = list(blocks(page or ""))
    chosen, linked = [], _linked(found)
    if links is not None:
        linked &= links
    for text, element, _ in found:
        if element.dropped or element.header and _block(element).tag not in HEADINGS:
            continue
        if element.unsure and element.path in linked:
            continue  # a name that may mean boilerplate, and links
        chosen.append((text, element, _repeated(text, element, template)))
    if any(element.main for _, element, _ in chosen):
        # An article below an element named as boilerplate is a comment or a teaser if there is another.
        chosen = [c for c in chosen if c[1].main and not c[1].below] or [c for c in chosen if c[1].main]
        # Without a slot of its own the page is a copy of others, and nothing tells its text from the template.
        if not all(c[2] for c in chosen):
            chosen = [c for c in chosen if not c[2] or _block(c[1]).tag in HEADINGS]
    else:
        chosen = [c for c in chosen if c[1].path not in linked and not c[1].header and not c[2]]
    return "\n\n".join(c[0] for c in chosen)


def _set(tokens) -> frozenset | None:
    return None if tokens is None else frozenset(int(t) & (1 << 64) - 1 for t in tokens)


def main_texts(pages: DataFrame, workspace: Workspace | None = None, broadcast: int = BROADCAST) -> DataFrame:
    """The pages with text and n_chars.

    Templates are broadcast if they are small; else pages are dealt to them by host, split where a host is large.
    """
    spark = pages.sparkSession
    workspace = workspace or Workspace(spark)
    learnt = workspace.settle(templates(pages, workspace), "templates")
    none = F.array().cast("array<bigint>")
    sizes = [F.size(F.coalesce(c, none)) for c in ("tokens", "links")]
    size = learnt.agg(F.sum((sizes[0] + sizes[1]) * 8 + 16)).first()[0] or 0
    pages = pages.drop("text", "n_chars", "_template")
    if size <= broadcast:
        held = spark.sparkContext.broadcast({r["host"] & (1 << 64) - 1: (_set(r["tokens"]), _set(r["links"] or []))
                                             for r in learnt.collect()})

        @F.pandas_udf("string")
        def read(urls: pd.Series, bodies: pd.Series) -> pd.Series:
            known = held.value
            common, out = known.get(0, (None, None))[0], []
            for url, body in zip(urls, bodies):
                own, links = known.get(xxhash.xxh64_intdigest(host_of(url).encode()), (None, frozenset()))
                out.append(extract(body, (common or frozenset()) if own is None else own, links))
            return pd.Series(out, dtype=object)
        done = pages.withColumn("text", read.asNondeterministic()(F.col("url"), F.col("html")))
    else:
        @F.pandas_udf("bigint")
        def number(urls: pd.Series) -> pd.Series:
            return pd.Series([_signed(xxhash.xxh64_intdigest(host_of(u).encode())) for u in urls], dtype=np.int64)

        @F.pandas_udf("string")
        def read(bodies: pd.Series, tokens: pd.Series, links: pd.Series) -> pd.Series:
            return pd.Series([extract(b, _set(k), _set(n)) for b, k, n in zip(bodies, tokens, links)], dtype=object)
        common = learnt.where("host = 0").select(F.col("tokens").alias("_common"))
        named = (pages.withColumn("_host", number(F.col("url")))
                 .join(learnt.where("host <> 0").hint("merge"), F.col("_host") == F.col("host"), "left"))
        row = common.first()
        common = F.lit(row["_common"]) if row else none
        done = (named.withColumn("text", read.asNondeterministic()(F.col("html"), F.coalesce("tokens", common, none),
                                                                    F.coalesce("links", none)))
                .select(*pages.columns, "text"))
    return done.withColumn("n_chars", F.length("text").cast("bigint"))

"""Main text of web pages by removal of site templates.

Every element subtree of a page is hashed: its name and, in order, the hashes of its subtrees and the words of its texts. Spark
counts for each host on how many different pages a subtree occurs; pages with the same main text, such as copies under several
addresses, count as one. Subtrees on at least `LEAST` pages and `SHARE` of the host's pages are the site's template and are
deleted, except for the article itself, what holds it, and the paragraphs, headings, items and cells of a marked article: a
passage that many articles quote is part of each.

What HTML itself declares not to be the article goes as well (navigation, footers, asides, forms, scripts, articles within
articles), and so do elements whose role, class or id says so in one of the words `APART`. The article is the outermost
`article` element, or else `main`, or else an element whose class or id says so, or else the whole page. The page's text is
what is left in the article: references decoded, white space turned into one space in each block, blocks joined by one space in
page order.

The template of a host has at most 1 / SHARE times the subtrees of a mean page of that host, so it travels as one list to the
host's pages: by a broadcast where its landed table is small, else by a join that adaptive execution can split, both inputs
being bare shuffles. Pages themselves are never grouped.

Defined results: null or empty html gives an empty text; a null address, or one without a host, has no template; repeated rows
give a text each and count once; very long and deeply nested pages cost time in proportion to their length; an empty table gives no
rows. `extract` keeps all columns; the text takes a name that is free or replaces the column of the name asked for.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from xxhash import xxh3_64_intdigest

from assetweave.llm.markup import INLINE, Page, attributes, read
from assetweave.llm.scratch import free_name, land
from assetweave.llm.streams import arrow_stream, arrow_streams

LEAST = 3
SHARE = 0.3

# What is not the article, by element, by role, and by words of class and id.
DECLARED = frozenset(
    "head script style nav footer aside form noscript template iframe svg button select textarea menu dialog canvas object"
    " audio video search".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
APART = frozenset(
    "ad ads adsense advert adverts advertisement advertising sponsor sponsored promo promos promotion"
    " nav navbar navigation menu menubar breadcrumb breadcrumbs pager pagination toc"
    " header masthead topbar footer colophon copyright sidebar sidebars widget widgets"
    " cookie cookies consent gdpr notice notices alert alerts popup modal overlay banner banners"
    " newsletter subscribe subscription signup login search form"
    " comment comments commentlist disqus respond reply replies"
    " share sharing social related recommended recommendations skip toolbar"
    " topnav sidenav subnav mainnav adbox adslot cookiebar commentbox".split()
)
IN_ARTICLE = frozenset({"header", "banner", "banners", "toc"})  # words that say nothing within an article
ARTICLE = frozenset("article articlebody post postbody entry story".split())
LEAVES = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd td th tr tbody thead blockquote pre figcaption caption".split())
WHOLE = frozenset({"", "html", "body"})
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


def host_of(url: Column) -> Column:
    """The lower-cased host of an address, without user and port; null where there is none."""
    authority = F.regexp_extract(url, r"^\s*(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:\s]+)", 1)
    return F.when(authority != "", F.lower(authority))


def _words(names: dict[str, str]) -> set[str]:
    """The words of class and id, also joined ones such as `entryContent`."""
    both = f"{names.get('class', '')} {names.get('id', '')}"
    return {w.lower() for w in _WORD.findall(both)} | set(both.lower().split())


class Reading:
    """A page with the role of each element: `apart` (declared, by itself or by an element around it), `inside` the article,
    `holds` an article below it."""

    def __init__(self, html: str):
        self.page: Page = read(html)
        elements = self.page.elements
        size = len(elements)
        names = [attributes(e.attributes) if e.attributes.strip("/ \t\n\r") else {} for e in elements]
        words = [_words(n) if "class" in n or "id" in n else set() for n in names]
        declared = [False] * size
        for i, e in enumerate(elements):
            role = names[i].get("role", "").lower()
            declared[i] = e.tag in DECLARED or role in ROLES or "hidden" in names[i] or names[i].get("aria-hidden") == "true"
        by_name = [e.tag not in WHOLE and not words[i].isdisjoint(APART) for i, e in enumerate(elements)]
        strictly = [by_name[i] and not words[i].isdisjoint(APART - IN_ARTICLE) for i in range(size)]
        kinds = (
            [e.tag == "article" for e in elements],
            [e.tag == "main" or names[i].get("role", "").lower() == "main" for i, e in enumerate(elements)],
            [e.tag not in INLINE and e.tag not in WHOLE and (
                not words[i].isdisjoint(ARTICLE) or names[i].get("itemprop", "").lower() == "articlebody"
            ) for i, e in enumerate(elements)],
        )
        for kind in (*kinds, [e.tag == "" for e in elements]):
            roots = self._roots(kind, declared, by_name)
            if any(roots):
                break
        self.explicit = not roots[0]
        self.holds = [False] * size
        for i in range(size - 1, 0, -1):
            if roots[i] or self.holds[i]:
                self.holds[elements[i].parent] = True
        self.inside, self.apart = roots[:], [False] * size
        for i in range(1, size):
            e, up = elements[i], elements[i].parent
            self.inside[i] = roots[i] or self.inside[up]
            free = roots[i] or self.holds[i]
            within = self.inside[up] and self.explicit
            named = strictly[i] if within else by_name[i]
            self.apart[i] = self.apart[up] or not free and (declared[i] or named or not within and e.tag == "header" or within and e.tag == "article")

    def _roots(self, kind: list[bool], declared: list[bool], by_name: list[bool]) -> list[bool]:
        """The outermost elements of a kind with a text, unless they are declared to be something else. Names of the elements
        around them count only if an element is left: a class may say `sidebar` of what holds the article."""
        elements = self.page.elements
        filled = [0, *accumulate(t is not None and not t.isspace() for t in self.page.texts)]
        for names in (by_name, [False] * len(kind)):
            blocked, below, out = [False] * len(kind), [False] * len(kind), [False] * len(kind)
            for i, e in enumerate(elements):
                up = e.parent
                blocked[i] = declared[i] or names[i] or i > 0 and blocked[up]
                below[i] = i > 0 and (below[up] or out[up])
                if kind[i] and not blocked[i] and not below[i] and not by_name[i]:
                    out[i] = filled[e.last] > filled[e.first]
            if any(out):
                break
        return out

    def text(self, deleted: list[bool] | None = None) -> str:
        """The article's text without the elements that are apart or deleted."""
        gone = self.apart[:]
        elements = self.page.elements
        for i in range(1, len(elements)):
            gone[i] = gone[i] or gone[elements[i].parent] or bool(deleted and deleted[i])
        blocks, now = [], []
        for piece, owner in zip(self.page.texts, self.page.owners, strict=True):
            if piece is None:
                blocks.append("".join(now))
                now = []
            elif self.inside[owner] and not gone[owner]:
                now.append(piece)
        blocks.append("".join(now))
        return " ".join(w for b in blocks for w in b.split())

    def hashes(self) -> list[int | None]:
        """The hash of each element's subtree, None without a text."""
        elements, texts, owners = self.page.elements, self.page.texts, self.page.owners
        inner: list[list[tuple[int, bytes]]] = [[] for _ in elements]
        for place, (piece, owner) in enumerate(zip(texts, owners, strict=True)):
            words = " ".join(piece.split()) if piece else ""
            if words:
                inner[owner].append((place, b"t" + xxh3_64_intdigest(words.encode("utf-8", "replace")).to_bytes(8)))
        out: list[int | None] = [None] * len(elements)
        for i in range(len(elements) - 1, 0, -1):  # children come after their parent
            if inner[i]:
                value = xxh3_64_intdigest(elements[i].tag.encode("utf-8", "replace") + b"\0" + b"".join(h for _, h in sorted(inner[i])))
                out[i] = value - 2**63
                inner[elements[i].parent].append((elements[i].first, b"e" + value.to_bytes(8)))
            inner[i] = []
        return out

    def candidates(self) -> Iterator[tuple[int, bool, int]]:
        """(element, whether it may go, hash) of every subtree that may be seen as a template."""
        for i, value in enumerate(self.hashes()):
            e = self.page.elements[i]
            if value is None or e.tag in INLINE or e.tag in WHOLE or self.holds[i] or self.apart[e.parent]:
                continue
            root = self.explicit and self.inside[i] and not self.inside[e.parent]
            yield i, not (root or self.explicit and self.inside[i] and e.tag in LEAVES), value


_NODES_TYPE = pa.struct([("page", pa.int64()), ("nodes", pa.list_(pa.int64()))])
_NODES = "struct<page:bigint,nodes:array<bigint>>"


def _nodes(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in batches:
        rows = []
        for html in batch:
            reading = Reading(html.as_py() or "")
            page = xxh3_64_intdigest(reading.text().encode("utf-8", "replace")) - 2**63
            rows.append({"page": page, "nodes": sorted({value for _, _, value in reading.candidates()})})
        yield pa.array(rows, _NODES_TYPE)


def site_templates(pages: DataFrame, html: str = "html", url: str = "url") -> DataFrame:
    """(host, nodes): the hashes of the recurring subtrees of each host that has any."""
    rows = pages.select(host_of(pages[url]).alias("host"), pages[html].alias("html")).where("host IS NOT NULL")
    found = land(rows.select("host", arrow_stream(_nodes, _NODES)("html").alias("n")).select("host", "n.*"), "nodes")
    total = found.select("host", "page").distinct().groupBy("host").agg(F.count("*").alias("pages"))
    each = found.select("host", "page", F.explode("nodes").alias("node")).distinct()
    seen = each.groupBy("host", "node").agg(F.count("*").alias("n")).where(F.col("n") >= LEAST)
    often = land(seen, "subtrees").join(land(total, "hosts"), "host").where(F.col("n") >= SHARE * F.col("pages"))
    return land(often.groupBy("host").agg(F.sort_array(F.collect_list("node")).alias("nodes")), "templates")


def _texts(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    for pages, templates in batches:
        out = []
        for html, nodes in zip(pages, templates, strict=True):
            reading, template = Reading(html.as_py() or ""), frozenset(nodes.as_py() or ())
            deleted = [False] * len(reading.page.elements)
            for i, may_go, value in reading.candidates() if template else ():
                deleted[i] = may_go and value in template
            out.append(reading.text(deleted))
        yield pa.array(out, pa.string())


def extract(pages: DataFrame, html: str = "html", url: str = "url", name: str = "text") -> DataFrame:
    """All columns of `pages` and the main text."""
    templates = site_templates(pages, html, url)
    host, nodes = (free_name(pages.columns, n) for n in ("_host", "_nodes"))
    keyed = pages.withColumn(host, host_of(pages[url]))
    lists = templates.select(F.col("host").alias(host), F.col("nodes").alias(nodes))
    # Pages without a host have no template; in a join they would all meet in one task.
    hosted = keyed.where(F.col(host).isNotNull()).join(lists, host, "left")
    others = keyed.where(F.col(host).isNull()).withColumn(nodes, F.lit(None).cast("array<bigint>"))
    read_ = hosted.unionByName(others).withColumn(name, arrow_streams(_texts, "string")(html, nodes))
    return read_.select(*[c for c in pages.columns if c != name], name)

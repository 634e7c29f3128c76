"""Main text of web pages by deducing each host's template.

1. A narrow pass turns every page into tokens: its elements, named by their path, and its blocks of text. The occurrence vector of a token holds its count on every page of the host. Vectors are not built: two
   sums of page hashes name them, which Spark combines before it shuffles, so a host may hold any number of pages.
2. Tokens of one host with equal vectors form an equivalence class. A class is valid if it has several
   tokens and stands on half of the host's pages, two at least; equal contents are one page. Valid classes nest by the paths of their tokens; together they are the
   template: fixed elements and fixed text.
   Inside an article, where headings and phrases may repeat by chance, text is fixed only if its class is that of the
   skeleton: it stands as often as elements of the page's frame do, on every content of the host, `WHOLE` at least.
3. What a page has between tokens of its template are slots. Slots in menus, headers, footers, sidebars, notices, adverts,
   forms, scripts, styles and comments are left out by the names of the elements around them, and so is fixed text. If
   slots lie in an article, only those are the main text; else all that remain are. Articles in boxes of teasers, adverts or
   comments give way to a longer text outside.

A page without siblings has no template; the names around its slots then decide alone.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh_names, stored

SHARE = 0.5   # part of a host's pages on which a valid class stands
PAGES = 2     # pages that a valid class needs at least
TOKENS = 2    # tokens that a valid class needs at least
WHOLE = 5     # contents that a host needs before text inside its articles can be fixed
DEPTH = 64    # elements of a path; deeper ones share their ancestor's path

# Names of elements, roles and classes whose content is not the main text.
ASIDE = set("nav footer aside form script style noscript template iframe object select button textarea svg head title dialog menu".split())
ROLES = set("navigation banner contentinfo complementary search dialog alert menu menubar form".split())
NAMES = set("ad ads advert adverts advertisement advertising sponsor sponsored promo banner cookie cookies consent gdpr notice notices "
            "newsletter subscribe signup sidebar side menu nav navbar navigation breadcrumb breadcrumbs footer header masthead comment "
            "comments disqus respond replies share sharing social related recommended popup modal".split())
# Parts of names of boxes that may hold articles of others: teasers, adverts, readers' comments.
BOXES = set("teaser teasers ad ads advert adverts advertisement advertising sponsor sponsored promo newsletter comment comments disqus respond replies "
            "related recommended popup modal".split())
# Elements whose class or id may name them inside an article; paragraphs, headings and words are text whatever they are called.
CONTAINERS = set("div section ul ol dl table figure fieldset details span a".split())
MAIN = {"article", "main"}
ROOTS = {"html", "body", *MAIN}
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = set("p h1 h2 h3 h4 h5 h6 li ul ol dl dt dd div section article main header footer nav aside blockquote pre table tr td th "
             "thead tbody tfoot caption figure figcaption form fieldset address hr br body html details summary".split())
# Start tags that end an open paragraph, and items that end one of their kind.
ENDS_P = BLOCKS - {"br", "body", "html", "td", "th", "tr", "thead", "tbody", "tfoot", "caption", "summary"}
SAME = {"li": {"ul", "ol"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}, "option": {"select"}}
SPACE = re.compile(r"\s+")


class Page(HTMLParser):
    """Elements as paths and blocks of text as (path, is it aside, is it in an article, text).

    An article or main element is aside only by tags, roles or whole names around it. A form, or a name of which only a
    part is known (`sidebar-right`, `no-sidebar`), may be a wrapper of the page and does not reach into it. In an article: 1,
    and 2 if a part of a name around it is in `BOXES`.
    """

    def __init__(self):
        super().__init__(convert_charrefs=True)
        # tag, path, aside, main, aside for sure, in a box, in an article element
        self.open: list[tuple[str, str, bool, int, bool, bool, bool]] = []
        self.paths: Counter[str] = Counter()
        self.blocks: list[tuple[str, bool, int, str]] = []
        # Text of the open block by what it is: aside or not, in which kind of article. An inline aside does not end a block.
        self.text: dict[tuple[bool, int], tuple[str, list[str]]] = {}

    def handle_starttag(self, tag, attrs):
        if tag in BLOCKS:
            self._flush()
        if tag in ENDS_P:
            self._close("p", stop={"table", "button", "object"})
        if tag in SAME:
            self._close(tag, stop=SAME[tag])
        values = {k: v or "" for k, v in attrs}
        _, above, aside, main, sure, box, inner = self.open[-1] if self.open else ("", "", False, 0, False, False, False)
        names = f"{values.get('class', '')} {values.get('id', '')}".lower()
        path = above if len(self.open) >= DEPTH else f"{above}/{tag}" + (f".{'.'.join(sorted(values['class'].split()))}" if values.get("class") else "")
        self.paths[path] += 1
        role = values.get("role", "").lower()
        # Around an article any part of a name counts, inside it only whole names of containers.
        named = tag not in ROOTS and (not inner or tag in CONTAINERS)
        whole, parts = (set(names.split()), set(re.split(r"[^a-z0-9]+", names))) if named else (set(), set())
        sure = (sure or (tag in ASIDE and tag != "form") or (tag == "header" and not main) or (role in ROLES and role != "form")
                or not NAMES.isdisjoint(whole) or "hidden" in values)
        box = box or not BOXES.isdisjoint(parts)
        if tag in MAIN:
            aside, main = sure or role == "form", 2 if box else 1
        else:
            aside = aside or sure or tag == "form" or role == "form" or not (inner or NAMES.isdisjoint(parts))
        if tag not in VOID:
            self.open.append((tag, path, aside, main, sure, box, inner or tag == "article"))

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if tag in BLOCKS:
            self._flush()
        self._close(tag, stop=set() if tag in ROOTS | {"div", "section", "table"} else {"article", "main", "body"})

    def _close(self, tag: str, stop: set[str]):
        for k in range(len(self.open) - 1, -1, -1):
            if self.open[k][0] == tag:
                if tag in BLOCKS:
                    self._flush()
                del self.open[k:]
                return
            if self.open[k][0] in stop:
                return

    def handle_data(self, data):
        path, aside, main = self.open[-1][1:4] if self.open else ("", False, 0)
        self.text.setdefault((aside, main), (path, []))[1].append(data)

    def _flush(self):
        for (aside, main), (path, parts) in self.text.items():
            text = SPACE.sub(" ", "".join(parts)).strip()
            if text:
                self.blocks.append((path, aside, main, text))
        self.text = {}

    def finish(self):
        self.close()
        self._flush()
        return self


def parse(html: str) -> Page:
    page = Page()
    page.feed(html)
    return page.finish()


def fixed(path: str, text: str, main: int = 0) -> str:
    """The token of a block of text; inside an article it starts with @."""
    if main:
        return f"@{xxhash.xxh3_128_hexdigest(f'{path}#{text}'.encode())}"
    return f"{path}#{xxhash.xxh3_128_hexdigest(text.encode())}"


def tokens(page: Page) -> Counter[str]:
    return page.paths + Counter(fixed(path, text, main) for path, aside, main, text in page.blocks if not (main and aside))


def main_text(page: Page, template: set[str]) -> str:
    """Blocks of the slots that remain, in page order, one to a line. Articles in boxes count only if no longer text is left."""
    slots = [(main, text) for path, aside, main, text in page.blocks if not aside and fixed(path, text, main) not in template]
    inside, boxed, outside = ("\n".join(text for main, text in slots if main == kind) for kind in (1, 2, 0))
    return inside or max(boxed, outside, key=len)


def _host(url):
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#]*)", 1), F.lit("")))


def templates(pages: DataFrame, html: str = "html", url: str = "url") -> DataFrame:
    """Tokens of valid classes: host, token, class, parent (class of the element around it), pages, size (tokens of the class)."""
    source = pages.select(_host(F.col(url)).alias("host"), F.coalesce(F.col(html), F.lit("")).alias("html"))
    source = source.select("host", F.xxhash64("html").alias("page"), "html")
    # Copies of a page say nothing about its host: each content counts once.
    contents = source.groupBy("host", "page").agg(F.first("html").alias("html"))

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for host, page, value in zip(*part.columns, strict=True):
                found = tokens(parse(value.as_py()))
                if found:
                    n = len(found)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([host.as_py()] * n), pa.array([page.as_py()] * n, pa.int64()), pa.array(list(found)), pa.array(list(found.values()), pa.int32())],
                        names=["host", "page", "token", "n"])

    seen = contents.mapInArrow(batches, "host string, page long, token string, n int")
    vectors = seen.groupBy("host", "token").agg(
        F.count("*").alias("pages"),
        # Sums modulo 2 ** 64 of hashes of (page, count): equal for equal vectors, in any order.
        F.sum(F.xxhash64("page", "n").cast("decimal(20,0)")).alias("a"), F.sum(F.xxhash64("n", "page", F.lit(1)).cast("decimal(20,0)")).alias("b"))
    named = vectors.select("host", "token", "pages", F.xxhash64("a", "b").alias("class"))
    named = stored(named.where(F.col("pages") >= PAGES))
    size = source.select("host", "page").distinct().groupBy("host").agg(F.count("*").alias("all"))
    element = ~F.contains("token", F.lit("#")) & ~F.startswith("token", F.lit("@"))
    classes = named.groupBy("host", "class", "pages").agg(F.count("*").alias("size"), F.max(element).alias("frame")).join(size, "host").where(
        (F.col("pages") >= SHARE * F.col("all")) & (F.col("size") >= TOKENS))
    skeleton = F.col("frame") & (F.col("pages") == F.col("all")) & (F.col("all") >= WHOLE)
    classes = classes.select("host", "class", "size", skeleton.alias("skeleton"))
    valid = named.join(classes, ["host", "class"]).where(~F.startswith("token", F.lit("@")) | F.col("skeleton"))
    around = valid.select("host", F.col("token").alias("above"), F.col("class").alias("parent"))
    above = F.when(F.contains("token", F.lit("#")), F.substring_index("token", "#", 1)).otherwise(F.regexp_replace("token", "/[^/]*$", ""))
    return valid.withColumn("above", above).join(around, ["host", "above"], "left").select("host", "token", "class", "parent", "pages", "size")


def extract(pages: DataFrame, html: str = "html", url: str = "url") -> DataFrame:
    """All of `pages` plus `text` and `n_chars`; columns of those names are replaced.

    Null or empty html has the empty text; pages without a url share the empty host. Rows of equal html count as one page
    of their host and get equal texts; a host of a single content has no template.
    """
    rules = templates(pages, html, url).where(F.contains("token", F.lit("#")) | F.startswith("token", F.lit("@")))
    # Stored, so that the join has a plain exchange on either side and Spark can split the pages of a large host.
    host, found = fresh_names(pages, "host", "template")
    template = stored(rules.groupBy(F.col("host").alias(host)).agg(F.collect_set("token").alias(found)))
    source = pages.drop("text", "n_chars").withColumn(host, _host(F.col(url))).join(template, host, "left").drop(host)
    names = [c for c in source.columns if c != found]
    out = source.drop(found).withColumns({"text": F.lit(""), "n_chars": F.lit(0).cast("long")}).schema
    place = names.index(html)

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            rules = part.column(len(names))
            texts = [main_text(parse(value.as_py() or ""), set(rule.as_py() or ()))
                     for value, rule in zip(part.column(place), rules, strict=True)]
            yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                                             names=[*names, "text", "n_chars"])

    return source.select(*names, found).mapInArrow(batches, out)

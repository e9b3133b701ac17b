"""Main text of web pages: what a site repeats is cut out, then the article's blocks are read.

1. ``subtrees`` reads each page once into a tree and gives a row per element: host, hash of the element's subtree (name, texts and
   children), hash of its parent's subtree.
2. ``site_templates`` counts, per host and subtree, the different parents it stands in. A subtree in ``MIN_PAGES`` surroundings or more, on at
   least ``SHARE`` of the host's different pages, is part of the site's template. Copies of a page repeat the parent as well and count once.
   Inside an article only containers (lists, divisions, tables) can be template: a paragraph that many articles quote is text.
3. ``main_text`` reads the pages again, beside the hashes of their host, and drops template subtrees as they close, and elements that
   are navigation, header, footer, sidebar, notice, advert, form, script, style or reader comment by their name, role, class or id.

A host's hashes number at most (elements of a page on average) / ``SHARE``. Hosts with more than a ``HOT`` part of all pages, fewer
than 1 / ``HOT`` of them, are dealt over several keys, so that no join key holds more than that part of the rows.

Defined results: null html is an empty page (text "", 0 code points); a null or relative url belongs to no host, so nothing is template there;
repeated rows give repeated results; markup that is never closed ends with the page; a quote that is never closed ends with its tag.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import blake2b
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from merchlens.llm.words import chunks
from merchlens.session import scratch_path

MIN_PAGES = 5
SHARE = 0.2
HOT = 1 / 1024

VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = frozenset("script style textarea title iframe noembed noframes".split())
BLOCK = frozenset(
    "html body address article aside blockquote center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head "
    "header hr legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead tr ul".split())
CONTAINERS = frozenset("aside center details dialog div dl fieldset figure footer form header menu nav ol section table ul".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements that a start tag closes, and those that the search for them doesn't leave.
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr"}, {"table"}),
          "td": ({"td", "th"}, {"table", "tr"}), "th": ({"td", "th"}, {"table", "tr"}), "option": ({"option"}, {"select"}), "body": ({"head"}, set())}
SCOPE = frozenset("html body article table td th caption button object template".split())
NOT_IN_P = BLOCK - frozenset("dd dt li td th tr tbody thead tfoot option optgroup legend html body head".split())

#: Elements, roles and words of class or id that are not the article.
DROP_TAGS = frozenset("nav footer aside form script style noscript template iframe object svg math button select textarea head title menu search dialog "
                      "noembed noframes".split())
DROP_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar".split())
DROP_WORDS = frozenset(
    "ad ads advert adverts advertisement advertisements sponsor sponsored promo cookie cookies consent gdpr notice notices sidebar sidebars comments comment "
    "commentlist disqus replies breadcrumb breadcrumbs menu nav navbar navigation footer newsletter subscribe signup popup modal share sharing social".split())
COMMENT_WORDS = frozenset("comment comments reply replies".split())

_TAG = re.compile(r"<(?:!--(?P<note>)|(?P<other>[!?]|/(?![A-Za-z]))|(?P<end>/?)(?P<name>[A-Za-z][^\s/>]*)(?P<rest>[^>\"']*))")
_NAMED = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_PLAIN = re.compile("[^>\"']*")
_WORD = re.compile(r"[a-z]+")
_ENDS = {name: re.compile(f"</{name}(?=[\\s/>])", re.I) for name in RAW}


def _unwanted(name: str, rest: str, in_article: bool, in_main: bool) -> bool:
    if name in DROP_TAGS:
        return True
    if name == "header":
        return not (in_article or in_main)
    if name == "article" and in_article:  # by the standard of HTML, comments on the outer one
        return True
    if "=" not in rest or name in ("html", "body"):
        return False
    for key, *values in _NAMED.findall(rest):
        value = "".join(values).lower()
        if key.lower() == "role":
            if value.strip() in DROP_ROLES:
                return True
            continue
        words = set(_WORD.findall(value))
        if words & (COMMENT_WORDS if name in ("article", "main") else DROP_WORDS) or ("header" in words and not (in_article or in_main) and name not in ("article", "main")):
            return True
    return False


def _digest(name: str, children: list[bytes]) -> bytes:
    return blake2b(name.encode() + b"\0" + b"\0".join(children), digest_size=8).digest()


def as_long(digest: bytes) -> int:
    return int.from_bytes(digest, "little", signed=True) or 1


class _Element:
    __slots__ = ("name", "children", "inner", "mark", "held", "skipped", "article", "main", "of_header")

    def __init__(self, name: str, mark: int, over: _Element | None, rest: str):
        self.name, self.mark, self.held, self.children, self.inner = name, mark, "", [], []
        in_article = over is not None and over.article
        self.of_header = over is not None and over.of_header and name not in HEADINGS or name == "header"
        self.skipped = over is not None and over.skipped or _unwanted(name, rest, in_article, over is not None and over.main)
        self.article = in_article or (name == "article" and not self.skipped)
        self.main = over is not None and over.main or (not self.skipped and (name == "main" or 'role="main"' in rest))


class Page:
    """A page read once: ``blocks`` of the article, ``elements`` as (subtree, parent's subtree), ``root``, and ``n_cut``, the number of subtrees
    of ``template`` that were cut out."""

    def __init__(self, html: str, template: frozenset[int] | set[int] = frozenset()):
        self.template, self.elements, self.n_cut = template, [], 0
        self._found: list[tuple[int, str]] = []
        self._text: list[str] = []
        self._open: dict[str, int] = {}
        self._saw = 0
        self._stack = [_Element("", 0, None, "")]
        self._read(html)
        while len(self._stack) > 1:
            self._pop()
        self._flush()
        base = self._stack[0]
        root = _digest("", base.children)
        self.elements += [(as_long(x), as_long(root)) for x in base.inner]
        self.root = as_long(root)
        self.blocks = [text for level, text in self._found if level >= self._saw]

    def _flush(self) -> None:
        if self._text:
            at = self._stack[-1]
            whole = " ".join(unescape("".join(self._text)).split())
            self._text.clear()
            if whole:
                at.children.append(whole.encode("utf-8", "surrogatepass"))
                if not at.skipped and not (at.of_header and at.name not in HEADINGS):
                    self._found.append((2 if at.article else 1 if at.main else 0, whole))

    def _push(self, name: str, rest: str) -> None:
        new = _Element(name, len(self._found), self._stack[-1], rest)
        if new.article:
            self._saw = 2
        elif new.main:
            self._saw = max(self._saw, 1)
        if name not in BLOCK:  # an unwanted element within a line: the text before it stays part of that line's block
            new.held = "".join(self._text)
            self._text.clear()
        self._stack.append(new)
        self._open[name] = self._open.get(name, 0) + 1

    def _pop(self) -> None:
        self._flush()
        old = self._stack.pop()
        self._open[old.name] -= 1
        over = self._stack[-1]
        digest = _digest(old.name, old.children)
        over.children.append(digest)
        known = as_long(digest)
        self.elements += [(as_long(x), known) for x in old.inner]
        if old.name in CONTAINERS if over.article else old.name not in ("html", "body", "head", "article", "main"):
            over.inner.append(digest)
            if known in self.template:
                self.n_cut += 1
                del self._found[old.mark:]
        if old.held:
            self._text.append(old.held)

    def _close(self, names: set[str], stop: frozenset[str] | set[str]) -> None:
        """Closes the innermost open element of ``names`` and all inside, unless one of ``stop`` lies between."""
        if any(self._open.get(n) for n in names):
            for at in range(len(self._stack) - 1, 0, -1):
                if self._stack[at].name in names:
                    while len(self._stack) > at:
                        self._pop()
                    return
                if self._stack[at].name in stop:
                    return

    def _start(self, name: str, rest: str) -> None:
        if name in ("html", "body") and self._open.get(name):
            return
        if name in NOT_IN_P:
            self._close({"p"}, SCOPE)
        if name in CLOSES:
            self._close(*CLOSES[name])
        if name in BLOCK:
            self._flush()
        if name in VOID:
            self._text.append(" ")
        elif name in BLOCK or name in DROP_TAGS or "=" in rest and _unwanted(name, rest, self._stack[-1].article, self._stack[-1].main):
            if not (name in ("svg", "math") and rest.endswith("/")):
                self._push(name, rest)

    def _end(self, name: str) -> None:
        if self._open.get(name):
            self._close({name}, frozenset() if name in SCOPE else SCOPE)
        elif name in BLOCK:
            self._flush()

    def _read(self, html: str) -> None:
        at, size, no_quote = 0, len(html), {}
        while at < size:
            tag = _TAG.search(html, at)
            if not tag:
                self._text.append(html[at:])
                return
            self._text.append(html[at:tag.start()])
            at = tag.end()
            if tag["note"] is not None:
                end = html.find("-->", at)
                at = size if end < 0 else end + 3
                continue
            if tag["other"] is not None:
                end = html.find(">", at)
                at = size if end < 0 else end + 1
                continue
            rest = tag["rest"]
            while at < size and html[at] != ">":  # a quoted value
                quote = html[at]
                end = -1 if at >= no_quote.get(quote, size) else html.find(quote, at + 1)
                if end < 0:
                    no_quote[quote] = min(at, no_quote.get(quote, size))
                    end = html.find(">", at)
                    end = size if end < 0 else end
                    rest += html[at:end]
                    at = end
                    break
                more = _PLAIN.match(html, end + 1).end()
                rest += html[at:more]
                at = more
            at += 1
            name = tag["name"].lower()
            if tag["end"]:
                self._end(name)
                continue
            self._start(name, rest)
            if name in RAW:  # its text belongs to the subtree, as it stands
                end = _ENDS[name].search(html, at)
                stop = end.start() if end else size
                self._stack[-1].children.append(html[at:stop].encode("utf-8", "surrogatepass"))
                at = stop


HOST = r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]+)"


def with_host(pages: DataFrame) -> DataFrame:
    """page_id, url, html and ``host`` ('' without one)."""
    return pages.select("page_id", "url", "html", F.coalesce(F.lower(F.regexp_extract("url", HOST, 1)), F.lit("")).alias("host"))


def _subtree_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in chunks(batches, "html"):
        rows = set()
        for host, html in zip(part.column("host").to_pylist(), part.column("html").to_pylist(), strict=True):
            page = Page(html or "")
            rows.add((host, 0, page.root))
            rows.update((host, x, over) for x, over in page.elements)
        hosts, nodes, parents = zip(*rows, strict=True)
        yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(nodes, pa.int64()), pa.array(parents, pa.int64())], ["host", "node", "parent"])


def subtrees(pages: DataFrame) -> DataFrame:
    """host, node, parent: different rows of a few MB of pages; node 0 stands for a page, its parent for the page's content."""
    return with_host(pages).filter("host != ''").select("host", "html").mapInArrow(_subtree_batch, "host string, node long, parent long")


def site_templates(pages: DataFrame, min_pages: int = MIN_PAGES, share: float = SHARE) -> DataFrame:
    """host, node, n_pages: the subtrees that a host repeats, with the number of different surroundings."""
    counts = subtrees(pages).distinct().groupBy("host", "node").agg(F.count(F.lit(1)).alias("n_pages")).filter(F.col("n_pages") >= min_pages)
    at = scratch_path(pages.sparkSession, "subtrees")
    counts.write.parquet(at)
    stored = pages.sparkSession.read.parquet(at)
    whole = stored.filter("node = 0").select("host", F.col("n_pages").alias("of_pages"))
    return stored.filter("node != 0").join(whole, "host").filter(F.col("n_pages") >= F.col("of_pages") * share).drop("of_pages")


def _text_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in chunks(batches, "html"):
        texts, cuts = [], []
        for html, nodes in zip(part.column("html").to_pylist(), part.column("nodes").to_pylist(), strict=True):
            page = Page(html or "", frozenset(nodes or ()))
            texts.append("\n\n".join(page.blocks).encode("utf-8", "replace").decode())
            cuts.append(page.n_cut)
        yield pa.RecordBatch.from_arrays(
            [part.column("page_id").cast(pa.int64()), part.column("url").cast(pa.string()), pa.array(texts, pa.string()),
             pa.array(map(len, texts), pa.int64()), pa.array(cuts, pa.int64())], ["page_id", "url", "text", "n_chars", "n_cut"])


def main_text(pages: DataFrame, min_pages: int = MIN_PAGES, share: float = SHARE) -> DataFrame:
    """page_id, url, text, n_chars (code points) and n_cut (template subtrees cut out) of every page."""
    spark = pages.sparkSession
    at = scratch_path(spark, "templates")
    site_templates(pages, min_pages, share).groupBy("host").agg(F.collect_list("node").alias("nodes")).write.parquet(at)
    nodes = spark.read.parquet(at)
    named = with_host(pages)
    sizes = named.groupBy("host").agg(F.count(F.lit(1)).alias("n"))
    total = sizes.agg(F.sum("n").alias("all_n"))
    # fewer than 1 / HOT hosts by their definition, and one row: both small whatever the input
    hot = sizes.join(F.broadcast(total), F.col("n") > F.col("all_n") * HOT).select("host", F.ceil(F.col("n") / (F.col("all_n") * HOT)).cast("int").alias("keys"))
    hot_at = scratch_path(spark, "hot-hosts")
    hot.write.parquet(hot_at)
    hot = F.broadcast(spark.read.parquet(hot_at))
    spread_at = scratch_path(spark, "site-templates")
    nodes.join(hot, "host", "left").withColumn("key", F.explode(F.sequence(F.lit(0), F.coalesce("keys", F.lit(1)) - 1))).drop("keys").write.parquet(spread_at)
    spread = spark.read.parquet(spread_at)  # stored, so that Spark knows its size and ships it whole only where that is small
    dealt = named.join(hot, "host", "left").withColumn("key", F.pmod(F.hash("page_id", "url", F.length("html")), F.coalesce("keys", F.lit(1)))).drop("keys")
    beside = dealt.join(spread, ["host", "key"], "left").select("page_id", "url", "html", "nodes")
    return beside.mapInArrow(_text_batch, "page_id long, url string, text string, n_chars long, n_cut long")


def op12_site_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(spark.read.parquet(f"{sf_dir}/pages.parquet"))

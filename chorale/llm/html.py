"""Main text of web pages: blocks by structure, and a host suffix array against boilerplate.

A page is read as blocks of text. Blocks inside scripts, forms, menus, headers, footers, sidebars, notices, adverts,
shares and comments are marked by element, role, class or id. What lies in an ``article`` or ``main`` element and is
not marked is the text, unless the pages of the host show that it is boilerplate; pages whose parsed blocks give no such
text need that evidence for all their blocks. Tags inside comments, scripts or marked elements make no article.

The evidence is the suffix arrays of a host: of the tokens of everything outside articles, of all its pages, and of the
tokens of its articles. They are built by prefix doubling (``longest_repeats``): suffixes are named by their first ``DEPTH``
tokens, those whose name too few pages hold are put aside, and the names of the others double their depth, until nothing
repeated is left; the way back halves the steps and finds how long each repeat is. Equal names are met by grouping, so
a host's share of the corpus does not matter. Every token begins a suffix. Blocks that lie wholly under repeats are
boilerplate, and so are runs of ``LONG`` tokens in others.

- Without an article, a share of the host's pages makes a repeat.
- In an article, only what nearly every article of the host holds (``PLACES``) is one: a notice of the site. What several
  or even most articles share stays. An article of nothing else keeps its text.

Few names are on nearly every article, and a part of the articles shows which may be: one that ``p`` of ``n`` articles
hold is missing on ``n - p`` at most, so at least ``m - (n - p)`` of any ``m`` of them hold it. Names that fewer hold are
left alone; the others are counted on all articles. A host whose part is too small to tell is counted as a whole.

A repeat needs a share of the host's distinct pages. Near copies say the same once: they are folded into classes by
``near_duplicates``, and a repeat needs several of these as well. So copies of a page do not erase each other.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chorale.llm.common import materialize, small_batches, unclashed
from chorale.llm.minhash import near_duplicates
from chorale.llm.urls import host_and_path

#: Tokens that a repeated substring has at the least, and to be cut out of a block.
DEPTH, LONG = 6, 10
#: Outside articles and in them: classes of near copies, and per cent of a host's distinct pages, that hold a repeat.
OUTSIDE, ARTICLE = 0, 1
PLACES = {OUTSIDE: (3, 10), ARTICLE: (8, 90)}
#: Rows of a table that is sent to all executors, and the part of a host's articles that is looked at first: one in so many.
SENT, CHOSEN = 50_000, 4

# Elements and names of the HTML vocabulary and of common page layouts.
RAW = {"script", "style", "textarea", "title", "iframe", "noscript", "noembed", "noframes", "xmp", "template"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
MAIN = {"article", "main"}
#: Left out with all they hold; those of the second set may wrap a page by mistake and end where an article begins.
DROPPED = {"aside", "button", "select", "option", "svg", "math", "canvas", "object", "audio", "video", "dialog", "menu", "head", "label", "fieldset"}
FRAMES = {"nav", "header", "footer", "form"}
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "br", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins", "kbd",
    "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr",
}
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "alert", "alertdialog", "dialog", "menu", "menubar", "form"}
NAMES = {
    "ad", "ads", "adv", "advert", "adverts", "advertisement", "advertising", "adsense", "sponsor", "sponsored", "promo", "promotion", "banner",
    "cookie", "cookies", "consent", "gdpr", "notice", "notices", "notification", "popup", "modal", "overlay", "newsletter", "subscribe",
    "subscription", "signup", "login", "share", "sharing", "social", "sidebar", "aside", "related", "recommended", "recommendations",
    "breadcrumb", "breadcrumbs", "menu", "navbar", "nav", "navigation", "comment", "comments", "respond", "disqus", "footer", "masthead",
    "pagination", "pager", "widget", "widgets", "toolbar", "topbar", "disclaimer", "paywall", "hidden", "reactions", "replies", "discussion",
}
#: Parts that may follow a name of the layout, and such before one that say the element only goes with it.
TAILS = {
    "area", "bar", "block", "body", "bottom", "box", "button", "buttons", "container", "content", "form", "frame", "group", "header", "icons", "inner", "item", "items", "label",
    "left", "link", "links", "list", "message", "outer", "panel", "right", "section", "slot", "text", "title", "top", "unit", "wrap", "wrapper",
}
WITH = {"has", "no", "non", "not", "with", "without"}

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^<>\"']|\"[^\"]*\"|'[^']*')*|[^>]*)>|[^<]+|<",
    re.S,
)
ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""")
VALUE = re.compile(r"""=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""")
PARTS = re.compile(r"[a-z]+")

#: A page without such a tag has no article; one with it is parsed to see.
DECLARED = r"(?i)<(article|main)[\s/>]"

Block = tuple[str, bool, bool]  # text, inside an article, marked


def _layout(word: str) -> bool:
    """Whether a class or id names a part of the layout: "ad", "ad-slot", "post-comments", but not "has-sidebar"."""
    parts = PARTS.findall(word)
    if not parts or parts[0] in WITH:
        return False
    return parts[-1] in NAMES or parts[0] in NAMES and all(p in NAMES or p in TAILS for p in parts[1:])


def _marked(name: str, rest: str, inside: bool, named: bool = True) -> bool:
    """Whether an element is marked; without ``named``, class and id do not count on articles."""
    if name in DROPPED:
        return True
    if name in FRAMES:
        return name != "header" or not inside
    if not rest.strip() or name in MAIN and not any(key in rest.lower() for key in ("class", "role", "id", "style")):
        return False
    for key, value in ATTRIBUTE.findall(rest):
        key, value = key.lower(), value.strip("\"'").lower()
        if key == "role" and value in ROLES or key == "aria-hidden" and value == "true":
            return True
        if key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return True
        if key in ("class", "id") and name not in ("html", "body") and (named or name not in MAIN):
            if any(_layout(word) for word in value.split()):
                return True
    return "hidden" in VALUE.sub(" ", rest).replace("/", " ").lower().split()


def blocks(page: str | None) -> list[Block]:
    """The text blocks of a page in order, white space folded, character references decoded, none empty.

    Where class names alone leave no text of any article, they do not count on articles.
    """
    found = _blocks(page or "", True)
    if any(inside for _, inside, _ in found) and not article(found):
        return _blocks(page or "", False)
    return found


def _blocks(page: str, named: bool) -> list[Block]:
    out: list[Block] = []
    held: list[str] = []
    stack: list[tuple[str, bool, bool]] = []  # element, article it opens, mark it sets
    inside = marks = 0
    at = 0

    def flush() -> None:
        text = " ".join("".join(held).split())
        if text:
            out.append((text, inside > 0, marks > 0))
        held.clear()

    def close() -> str:
        nonlocal inside, marks
        name, is_main, is_mark = stack.pop()
        if is_main or is_mark:
            flush()
        inside, marks = inside - is_main, marks - is_mark
        return name

    while at < len(page):
        m = TOKEN.match(page, at)
        at = m.end()
        name = m["name"]
        if name is None:
            text = m[0]
            if not text.startswith(("<!", "<?")):
                held.append(entities.unescape(text) if "&" in text else text)
            continue
        name = name.lower()
        if name not in INLINE:
            flush()
        elif name == "br":
            held.append(" ")
        if m["end"]:
            if name in VOID or not any(s[0] == name for s in stack):
                continue
            while close() != name:
                pass
            continue
        if name in RAW:
            last = re.compile(rf"</{re.escape(name)}\b[^>]*(?:>|\Z)", re.I).search(page, at)
            at = last.end() if last else len(page)
            continue
        rest = m["rest"] or ""
        if name in VOID or rest.endswith("/") and name not in INLINE | MAIN | FRAMES | {"div", "p", "section", "li", "ul", "ol", "td", "tr", "table", "body", "html"}:
            continue
        if name in ("p", "li") and stack and stack[-1][0] == name:
            close()  # the end tag may be left out
        if name in MAIN and any(s[0] in FRAMES and s[2] for s in stack) and not any(s[2] and s[0] not in FRAMES for s in stack):
            stack[:] = [(n, a, False) for n, a, _ in stack]
            marks = 0
        is_main, is_mark = name in MAIN, _marked(name, rest, inside > 0, named)
        if is_main or is_mark:
            flush()
        stack.append((name, is_main, is_mark))
        inside, marks = inside + is_main, marks + is_mark
    flush()
    return out


def article(found: list[Block]) -> list[str]:
    """The unmarked blocks inside articles."""
    return [text for text, inside, marked in found if inside and not marked]


def outside(found: list[Block]) -> list[str]:
    """The unmarked blocks outside articles."""
    return [text for text, inside, marked in found if not inside and not marked]


def stream(found: list[Block]) -> list[tuple[str, int]]:
    """Tokens outside articles with the number of their block."""
    return [(token, i) for i, (text, inside, _) in enumerate(found) if not inside for token in text.split()]


def buckets(host: str, tokens: list[tuple[str, int]]) -> list[int]:
    """A key for the suffix at each position that has ``DEPTH`` tokens: the host and these tokens."""
    words = [t for t, _ in tokens]
    return [_signed(xxhash.xxh64_intdigest(host + "\n" + "\n".join(words[i : i + DEPTH]))) for i in range(len(words) - DEPTH + 1)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def unique_runs(found: list[Block], repeats: list[tuple[int, int]]) -> list[str]:
    """Unmarked blocks without what lies under repeats: begin in the stream and number of tokens."""
    tokens = stream(found)
    covered, cut = bytearray(len(tokens)), bytearray(len(tokens))
    for at, length in repeats:
        covered[at : at + length] = b"\x01" * length
        if length >= LONG:
            cut[at : at + length] = b"\x01" * length
    open_blocks = {block for (_, block), hit in zip(tokens, covered, strict=True) if not hit}
    kept: dict[int, list[str]] = {}
    for (token, block), hit in zip(tokens, cut, strict=True):
        if block in open_blocks and not hit and not found[block][2]:
            kept.setdefault(block, []).append(token)
    return [" ".join(kept[i]) for i in sorted(kept)]


def article_runs(texts: list[str], repeats: list[tuple[int, int]]) -> list[str]:
    """The blocks of an article without what lies under repeats; all, if nothing else is there."""
    return unique_runs([(text, False, False) for text in texts], repeats) or texts if repeats else texts


_NAMES = ["site", "content", "place", "at", "name", "first", "asked"]
_SUFFIX = "site long, content long, place byte, at int, name long, first boolean, asked boolean"


def _listed(out: list[tuple]) -> pd.DataFrame:
    columns = dict(zip(_NAMES, zip(*out, strict=True), strict=True)) if out else {n: [] for n in _NAMES}
    types = ["int64", "int64", "int8", "int32", "Int64", "bool", "bool"]
    return pd.DataFrame({n: pd.Series(columns[n], dtype=t) for n, t in zip(_NAMES, types, strict=True)})


def _of_article(host: str, texts: list[str]) -> list[int]:
    """The names of an article's suffixes, which are none of those outside articles."""
    return buckets(host + "\n", [(token, 0) for text in texts for token in text.split()])


def _suffixes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The suffixes of each page, those of articles on the chosen pages only, and one of no tokens for each place with text.

    ``first`` marks the first of a name on the page, ``asked`` those that may decide: articles, and everything on pages
    without an article.
    """
    for pdf in batches:
        out: list[tuple] = []
        for site, host, content, page in zip(pdf["site"], pdf["host"], pdf["content"], pdf["html"], strict=True):
            found = blocks(page)
            texts = article(found)
            keys = [(OUTSIDE, i, key, not texts) for i, key in enumerate(buckets(host, stream(found)))]
            if content % CHOSEN == 0:
                keys += [(ARTICLE, i, key, True) for i, key in enumerate(_of_article(host, texts))]
            out += [(site, content, place, -1, None, False, False) for place in [OUTSIDE, *[ARTICLE] * bool(texts)]]
            seen: set[int] = set()
            for place, i, key, asked in keys:
                out.append((site, content, place, i, key, key not in seen, asked))
                seen.add(key)
        yield _listed(out)


def _articles(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The suffixes of all articles."""
    for pdf in batches:
        out: list[tuple] = []
        for site, host, content, page in zip(pdf["site"], pdf["host"], pdf["content"], pdf["html"], strict=True):
            seen: set[int] = set()
            for i, key in enumerate(_of_article(host, article(blocks(page)))):
                out.append((site, content, ARTICLE, i, key, key not in seen, True))
                seen.add(key)
        yield _listed(out)


def _texts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The unmarked text of each page: of its article or, without one, outside."""
    for pdf in batches:
        found = [blocks(page) for page in pdf["html"]]
        yield pd.DataFrame({"content": pdf["content"], "text": ["\n".join(article(f) or outside(f)) for f in found]})


def _held(rows: DataFrame, name: list[str]) -> DataFrame:
    """The rows whose name enough classes and enough distinct pages hold."""
    groups = rows.groupBy(*name).agg(
        F.countDistinct("class").alias("classes"), F.countDistinct("content").alias("pages"), F.max("classes").alias("c"), F.max("pages").alias("p")
    )
    return rows.join(groups.where("classes >= c AND pages >= p").select(*name), name, "left_semi")


def longest_repeats(windows: DataFrame) -> DataFrame:
    """``content``, ``at``, ``length`` of the longest repeat from each position, by prefix doubling.

    ``windows`` has a ``name`` for the ``DEPTH`` tokens from position ``at`` of a page (``content``), the ``class`` of
    the page, and the ``classes`` and ``pages`` a repeat needs. Names of equal tokens of one host are equal. Positions
    without a repeat of ``DEPTH`` tokens give no row. Repeated rows count once. An empty table gives an empty result.

    A level holds names of twice the tokens of the one before, for the positions that are repeated so far. A substring
    of any length is named by the two windows of the deepest level that fit into it, its first and its last.
    """
    columns = ["k", "content", "at", "name", "class", "classes", "pages"]
    level = _held(windows.dropDuplicates(["content", "at"]).withColumn("k", F.lit(0)), ["name"])
    level = levels = materialize(level.select(*columns), "repeats")
    k = 0
    while not level.isEmpty():
        k += 1
        after = level.select("content", (F.col("at") - (DEPTH << (k - 1))).alias("at"), F.col("name").alias("next"))
        longer = level.join(after, ["content", "at"]).withColumns({"name": F.xxhash64("name", "next"), "k": F.lit(k)})
        level = materialize(_held(longer, ["name"]).select(*columns), "repeats")
        levels = levels.unionByName(level)
    depth = F.expr(f"shiftleft({DEPTH}, k)")
    best = levels.groupBy("content", "at").agg(F.max(F.struct("k", "name")).alias("b")).select("content", "at", "b.*")
    best = materialize(best.withColumn("length", depth), "longest-repeats")
    for step in [DEPTH << j for j in range(k - 2, -1, -1)] + [3, 2, 1] if k else []:
        # positions with a longer repeat take part in the count, so the question is put to all of the name's
        asked = best.where(depth > step).select("k", "name", (F.col("length") + step).alias("tried")).distinct()
        last = levels.select("k", "content", F.col("at").alias("end"), F.col("name").alias("last"))
        found = levels.join(asked, ["k", "name"]).withColumn("end", F.col("at") + F.col("tried") - depth)
        found = _held(found.join(last, ["k", "content", "end"]), ["k", "tried", "name", "last"])
        found = found.select("k", "content", "at", "tried").withColumn("length", F.col("tried") - step)
        best = best.join(found, ["k", "content", "at", "length"], "left").withColumn("length", F.coalesce("tried", "length")).drop("tried")
        best = materialize(best, "longest-repeats")
    return best.select("content", "at", "length")


def _sent(table: DataFrame) -> DataFrame:
    return F.broadcast(table) if table.limit(SENT + 1).count() <= SENT else table


def _shared(pages: DataFrame, suffixes: DataFrame, sites: DataFrame) -> DataFrame:
    """The suffixes of articles whose names enough articles may hold."""
    # every article but so many holds a repeat, so of the chosen ones all but so many too
    sites = sites.where(f"place = {ARTICLE} AND n >= pages").select("site", F.expr("chosen - (n - pages)").alias("least"))
    names = suffixes.where(f"place = {ARTICLE} AND at >= 0").groupBy("name").agg(F.min("site").alias("site"), F.count_if("first").alias("rows"))
    names = materialize(names.join(_sent(sites), "site").where("least > 0 AND rows >= least").select("name", "site"), "article-names")
    whole = materialize(sites.where("least <= 0").select("site"), "whole-hosts")
    found = pages.join(_sent(whole), "site", "left_semi").mapInPandas(_articles, _SUFFIX)
    again = pages.join(_sent(names.select("site").distinct()), "site", "left_semi").mapInPandas(_articles, _SUFFIX)
    again = again.join(_sent(names.select("name")), "name", "left_semi")
    return materialize(found.unionByName(again), "article-suffixes")


def _evidence(pages: DataFrame) -> DataFrame:
    """What is repeated and may decide: ``site``, ``place``, ``content``, ``at``, ``name``, ``class`` and what a repeat needs.

    ``pages`` has ``site``, ``host``, ``content`` and ``html``.
    """
    suffixes = materialize(pages.mapInPandas(_suffixes, _SUFFIX), "page-suffixes")
    chosen = F.count_distinct(F.when(F.expr(f"pmod(content, {CHOSEN}) = 0"), F.col("content"))).alias("chosen")
    sites = suffixes.where("at < 0").groupBy("site", "place").agg(F.countDistinct("content").alias("n"), chosen)
    needs = F.create_map(*[F.lit(x) for place, need in PLACES.items() for x in (place, F.struct(*map(F.lit, need)))])
    need = needs[F.col("place").cast("int")]
    sites = sites.select("site", "place", "n", "chosen", need["col1"].alias("classes"), F.ceil(F.col("n") * need["col2"] / 100).alias("pages"))
    sites = materialize(sites.withColumn("pages", F.greatest("classes", "pages").cast("long")), "hosts")

    shared = _shared(pages, suffixes, sites)
    sites = sites.drop("n", "chosen")
    suffixes = suffixes.where(f"place = {OUTSIDE} AND at >= 0").unionByName(shared)
    # rows are counted first, which are no fewer than distinct pages, so that each suffix is moved once, with few bytes
    names = suffixes.groupBy("name").agg(
        F.min("site").alias("site"), F.min("place").alias("place"), F.count_if("first").alias("rows"), F.bool_or("asked").alias("asked")
    )
    names = names.where("asked").join(_sent(sites), ["site", "place"])
    names = materialize(names.where("rows >= pages").select("name", "classes", "pages"), "repeated-names")
    repeated = materialize(suffixes.drop("asked", "first").join(names, "name"), "repeated-suffixes")
    if repeated.isEmpty():
        return repeated.withColumn("class", F.col("content"))
    texts = pages.join(repeated.select("content").distinct(), "content", "left_semi").mapInPandas(_texts, "content long, text string")
    classes = near_duplicates(texts, doc_id="content").select(F.col("doc_id").alias("content"), F.col("component_id").alias("class"))
    small_batches(pages.sparkSession, 500)
    return materialize(repeated.join(classes.dropDuplicates(["content"]), "content"), "repeated-classes")


def extract_text(pages: DataFrame, *, url: str = "url", html: str = "html") -> DataFrame:
    """``pages`` with ``text`` (blocks joined by a line break) and ``n_chars``; columns of these names are replaced.

    A null or empty page has the empty text. Pages with a null url, or one without a host, are judged singly.
    Repeated rows have equal results. An empty table gives an empty result.
    """
    spark = pages.sparkSession
    small_batches(spark, 500)
    host, _ = host_and_path(F.col(url))
    site, content = F.xxhash64("host"), F.xxhash64("host", "html")
    keyed = pages.select(host.alias("host"), F.coalesce(html, F.lit("")).alias("html"))
    # pages without a host have no neighbours
    evidence = _evidence(keyed.where(F.coalesce("host", F.lit("")) != "").withColumns({"site": site, "content": content}))

    def repeats_of(place: int) -> DataFrame:
        """One list per page, no longer than the page."""
        repeats = longest_repeats(evidence.where(F.col("place") == place).drop("site", "place"))
        repeats = repeats.groupBy("content").agg(F.collect_list(F.struct("at", "length")).alias("repeats"))
        return materialize(repeats, "page-boilerplate")

    notices, repeats = repeats_of(ARTICLE), repeats_of(OUTSIDE)

    @F.pandas_udf("string")
    def from_article(column: pd.Series, starts: pd.Series, lengths: pd.Series) -> pd.Series:
        rows = zip(column, starts, lengths, strict=True)
        texts = ["\n".join(article_runs(article(blocks(page)), [] if a is None else [*zip(a, n, strict=True)])) for page, a, n in rows]
        return pd.Series([t or None for t in texts], dtype="object")

    @F.pandas_udf("string")
    def from_runs(column: pd.Series, starts: pd.Series, lengths: pd.Series) -> pd.Series:
        rows = zip(column, starts, lengths, strict=True)
        return pd.Series(["\n".join(unique_runs(blocks(page), [] if a is None else [*zip(a, n, strict=True)])) for page, a, n in rows])

    source = unclashed(pages, ["text", "n_chars"])
    kept = F.struct(*[F.col(f"`{c}`") for c in source.columns]).alias("kept")
    rows = source.select(kept, F.coalesce(F.col(f"`{html}`"), F.lit("")).alias("html"), host.alias("host"))
    # asked before the second join, so that only pages without an article are moved by it
    declared = rows.where(F.col("html").rlike(DECLARED)).withColumn("content", content).join(_sent(notices), "content", "left")
    declared = declared.withColumn("text", from_article.asNondeterministic()("html", "repeats.at", "repeats.length"))
    direct = declared.where("text IS NOT NULL").select("kept.*", "text")
    others = rows.where(~F.col("html").rlike(DECLARED)).unionByName(declared.where("text IS NULL").select(*rows.columns))
    others = others.withColumn("content", content).join(repeats, "content", "left")
    others = others.select("kept.*", from_runs("html", "repeats.at", "repeats.length").alias("text"))
    return direct.unionByName(others).withColumn("n_chars", F.length("text").cast("long"))

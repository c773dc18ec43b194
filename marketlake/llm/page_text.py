"""Main text of web pages by template deduction over the pages of a host.

A page's tokens are its elements, told apart by the path of (tag, class, id)
they stand in. Per host, Spark aggregates each token's *occurrence vector*
(how often it occurs in every page) to a signature; tokens with one signature
form an *equivalence class*. Classes that are large (three tokens) and
frequent (half the host's pages, three at least) are valid, and nest by their
paths into the host's template. Elements with text that is not navigation,
advert, form, notice or comment, and not the same on the host's pages, are
slots. Among the template's elements that occur once a page, the deepest one
that contains all slots is the article; it is extracted from each page. A host with too few pages to deduce a template uses
the classes of all hosts together.

The vectors never leave the aggregation: a signature is a XOR of hashes of
(page, count), so a host with a third of all pages is pre-aggregated like any other.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from marketlake.llm.common import ddl, discard, extended, stored

TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)>|[^<]+|<""", re.S)
ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")

# Element names by their part in a page (HTML standard).
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style title textarea noscript iframe xmp".split())
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub "
             "sup time tt u var wbr img ruby rt rp rb".split())
LEFT_OUT = set("head script style title noscript template nav footer aside form button select textarea input iframe object embed svg "
               "canvas menu dialog audio video map datalist fieldset".split())
LEFT_OUT_ROLES = set("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
LEFT_OUT_NAMES = set("ad ads adv advert adverts advertisement advertising adsense adslot banner promo promotion sponsor sponsored sidebar nav "
                     "navbar navigation menu breadcrumb breadcrumbs footer header masthead cookie cookies consent notice notices gdpr "
                     "popup modal newsletter subscribe subscription signup share sharing social related recommended comment comments "
                     "commentlist disqus reply replies respond discussion widget toolbar pagination pager copyright legal disclaimer login "
                     "search skip".split())
#: An opening element of the first kind ends open elements of the second.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
KEEPS_P = INLINE | VOID
MIN_PAGES, MIN_TOKENS = 3, 3


def _element(tag: str, attributes: str, inside_article: bool) -> tuple[str, bool]:
    """(name of the element in a path, whether its content is left out)."""
    a = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(attributes)}
    names = sorted(a.get("class", "").split())
    own = a.get("id", "")
    key = tag + "".join("." + re.sub(r"\d+", "0", n) for n in names) + ("#" + re.sub(r"\d+", "0", own) if own else "")
    words = set(re.split(r"[^a-z]+", " ".join([*names, own]).lower()))
    out = (tag in LEFT_OUT or a.get("role", "").lower() in LEFT_OUT_ROLES or "hidden" in a or a.get("aria-hidden") == "true"
           or re.search(r"display\s*:\s*none", a.get("style", "")) is not None or (tag == "header" and not inside_article)
           or (tag not in ("body", "html", "article", "main") and bool(words & LEFT_OUT_NAMES)))
    return key, out


def walk(page: str) -> Iterator[tuple]:
    """("open", path, left_out) / ("close", path, None) / ("break", path, None) / ("text", path, decoded text that is not left out)."""
    stack: list[tuple[str, str, bool]] = []   # tag, path, left out
    inside = 0

    def close(n: int):
        nonlocal inside
        while len(stack) > n:
            tag, path, _ = stack.pop()
            inside -= tag in ("article", "main")
            if tag not in INLINE:
                yield "close", path, None

    at = 0
    while (m := TOKEN.match(page, at)) is not None:
        at = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            if not m[0].startswith(("<!", "<?")) and not (stack and stack[-1][2]):
                yield "text", stack[-1][1] if stack else "", html.unescape(m[0])
            continue
        if m[1]:
            depth = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == tag), None)
            if depth is not None:
                yield from close(depth)
            continue
        if tag not in KEEPS_P or tag == "hr":
            ended = {"p"} | ENDS.get(tag, set()) if tag not in ("html", "body") else set()
            depth = len(stack)
            while depth and stack[depth - 1][0] in ended | INLINE:
                depth -= 1
                if stack[depth][0] in ended:
                    yield from close(depth)
        if tag in VOID:
            if not (stack and stack[-1][2]):
                yield ("text", stack[-1][1] if stack else "", " ") if tag == "br" else ("break", "", None) if tag == "hr" else ("none", "", None)
            continue
        key, out = _element(tag, m[3], inside > 0)
        above = stack[-1][1] if stack else ""
        hidden = bool(stack and stack[-1][2])
        path = above if tag in INLINE and not out else f"{above}/{key}"
        stack.append((tag, path, out or hidden))
        inside += tag in ("article", "main")
        if tag not in INLINE and not hidden:
            yield "open", path, out
        if tag in RAW:
            end = re.compile(rf"</{tag}\b", re.I).search(page, at)
            if tag in LEFT_OUT:
                at = end.start() if end else len(page)
    yield from close(0)


def _tokens(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One row per page and template token: occurrences and a hash of the text directly inside (null if none)."""
    for b in batches:
        rows = []
        for host, page, text in zip(b["host"], b["page"], b["html"]):
            n: dict[str, int] = {}
            inside: dict[str, list[str]] = {}
            out: dict[str, bool] = {}
            for kind, path, value in walk(text):
                if kind == "open":
                    n[path] = n.get(path, 0) + 1
                    out[path] = value
                elif kind == "text" and not value.isspace():
                    inside.setdefault(path, []).append(" ".join(value.split()))
            rows += [(host, page, p, k, xxhash.xxh32_intdigest("\n".join(inside[p])) if p in inside else None, p.count("/"), out[p]) for p, k in n.items()]
        yield pd.DataFrame(rows, columns=["host", "page", "path", "n", "words", "depth", "out"]).astype({"host": object, "path": object, "words": "Int64"})


def extract_blocks(page: str, article: str | None) -> list[str]:
    """Text blocks inside the article element (the ``article`` or ``main`` element or the body, where the page has none such), in page order."""
    events = list(walk(page))
    opened = {path for kind, path, _ in events if kind == "open"}
    if article not in opened:
        marked = [p for p in opened if re.match(r"(article|main)\b", p.rpartition("/")[2])]
        article = min(marked, key=lambda p: (p.count("/"), p)) if marked else ""
    blocks, piece = [], []
    for kind, path, value in events:
        if kind == "text":
            if path == article or path.startswith(article + "/"):
                piece.append(value)
        elif kind != "none":
            blocks.append("".join(piece))
            piece = []
    blocks.append("".join(piece))
    return [x for x in (" ".join(b.split()) for b in blocks) if x]


def _articles(tokens: DataFrame) -> DataFrame:
    """(host, article) from tokens with support, most, signature, depth, out, pages with text, least and largest text hash per host."""
    many = F.greatest(F.lit(MIN_PAGES), F.col("pages") / 2)
    tokens = tokens.withColumn("pages", F.max("support").over(W.partitionBy("host")))
    classes = tokens.groupBy("host", "sig", "support").agg(F.count(F.lit(1)).alias("size"))
    valid = tokens.join(classes, ["host", "sig", "support"]).filter((F.col("size") >= MIN_TOKENS) & (F.col("support") >= many))
    # all slots lie below an element when the first and the last of their paths do
    path, varies = F.concat("path", F.lit("/")), (F.col("low") != F.col("high")) | (F.col("texts") < many)
    slots = tokens.filter("texts > 0").groupBy("host").agg(*[F.coalesce(f(F.when(varies, path)), f(path)).alias(name) for f, name in ((F.min, "from"), (F.max, "to"))])
    return (valid.filter("most = 1 AND NOT out").join(slots, "host").filter(F.col("from").startswith(path) & F.col("to").startswith(path))
            .groupBy("host").agg(F.max_by("path", F.struct("depth", "path")).alias("article")))


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", keep: tuple = ()) -> DataFrame:
    """``keep`` columns, id, url, host, article, text per page; ``text`` is the blocks joined by line feeds.

    Null pages and pages without text give the empty text. Pages with a null
    or odd URL share the host ``''``; repeated rows stay. Nothing inside the
    article's slots is dropped, also not text that many pages repeat.
    """
    host = F.lower(F.coalesce(F.regexp_extract(F.col(url_col), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]+)", 1), F.lit("")))
    rows = pages.select(*keep, F.col(id_col).alias("id"), F.col(url_col).alias("url"), host.alias("host"), F.coalesce(F.col(html_col), F.lit("")).alias("html"))
    seen = rows.select("host", F.xxhash64("id", "url").alias("page"), "html")
    counts = seen.mapInPandas(_tokens, "host string, page long, path string, n long, words long, depth long, out boolean")
    tokens = stored(counts.groupBy("host", "path").agg(
        F.count(F.lit(1)).alias("support"), F.max("n").alias("most"), F.bit_xor(F.xxhash64("page", "n")).alias("sig"),
        F.count("words").alias("texts"), F.min("words").alias("low"), F.max("words").alias("high"), F.max("depth").alias("depth"), F.max("out").alias("out")), "tokens")
    everywhere = tokens.groupBy(F.lit("").alias("any"), "path").agg(
        F.sum("support").alias("support"), F.max("most").alias("most"), F.bit_xor("sig").alias("sig"),
        F.sum("texts").alias("texts"), F.min("low").alias("low"), F.max("high").alias("high"), F.max("depth").alias("depth"), F.max("out").alias("out")).withColumnRenamed("any", "host")
    own = stored(_articles(tokens).select(F.col("host").alias("h"), "article"), "articles")
    shared = _articles(everywhere).first()
    discard(tokens)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            text = ["\n".join(extract_blocks(p.as_py(), a.as_py())) for p, a in zip(b.column("html"), b.column("article"))]
            yield extended(b, ("html",), text=pa.array(text, pa.string()))

    found = rows.join(own, F.col("host") == F.col("h"), "left").drop("h").withColumn("article", F.coalesce("article", F.lit(shared["article"] if shared else None)))
    return found.mapInArrow(run, f"{ddl(found, ('html',))}text string")

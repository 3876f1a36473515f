"""Main text of web pages by consensus of a host's container paths.

1. Each page is parsed once and its containers are scored by the text in their
   blocks that is not link text; the best container casts one vote for its
   generalised path, tags with classes whose digits are masked
   (``body/div.post-#/article``).
2. Spark counts the votes by host and path. Paths with at least ``MIN_SHARE`` of
   a host's votes win: at most ``1 / MIN_SHARE`` of them, whatever the host's size.
3. Each page meets its host's paths (large hosts by broadcast, the others in a
   shuffle) and is extracted anew from the containers on its host's best winning
   path that it has; a page with none of them uses its own best container.

Boilerplate (menus, headers, footers, sidebars, notices, adverts, forms,
scripts, styles, reader comments) is left out by tag, role and class words.
"""

from __future__ import annotations

import re
from functools import cache
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txwatch.session import materialize

MIN_SHARE, HOT_SHARE = 0.1, 0.001
#: Share of a page's text in an element that cannot be left out; words of a paragraph in an article's header that are a lead.
NEARLY, LEAD = 0.95, 12

RAW = {"script", "style", "textarea", "title", "iframe", "noembed", "noframes", "xmp"}
#: Elements inside a line whose text goes; they end no block, and a parent's end tag closes them.
INLINE_BAD = {"noscript", "template", "svg", "math", "object", "canvas", "select", "button", "audio", "video", "foreignobject"}
#: An open element of these keeps its blocks from closing blocks around it; a block ends an open svg or math.
SCOPES, FOREIGN = {"template", "object", "select", "button", "foreignobject"}, {"svg", "math"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BLOCKS = {"address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "div", "dl",
          "dt", "fieldset", "figcaption", "figure", "footer", "form", "frameset", "h1", "h2", "h3", "h4", "h5", "h6",
          "head", "header", "hgroup", "html", "li", "main", "menu", "nav", "ol", "p", "pre", "search", "section",
          "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
CONTAINERS = {"article", "main", "section", "div", "td", "body", "center"}
#: A start tag that ends an open element of these kinds, as far up as the nearest of the others.
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
          "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
          "tbody": ({"tbody", "thead", "tfoot"}, {"table"}), "tfoot": ({"tbody", "thead", "tfoot"}, {"table"}),
          "body": ({"head"}, {"html"})}
BAD_TAGS = {"nav", "footer", "aside", "menu", "dialog", "head", "header", "search"}
#: These are bad as a whole class or id is: unless they are around the page's content.
MOSTLY_BAD = {"form", "fieldset"}
BAD_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "alertdialog",
             "menu", "menubar", "toolbar"}
BAD_WORDS = {"ad", "ads", "advert", "advertisement", "adverts", "banner", "breadcrumb", "breadcrumbs", "colophon",
             "comment", "comments", "commentlist", "consent", "cookie", "cookies", "disqus", "footer", "form", "gdpr",
             "header", "login", "masthead", "menu", "modal", "nav", "navbar", "navigation", "newsletter", "notice",
             "notices", "pager", "pagination", "popup", "promo", "promotion", "promoted", "recommended", "related",
             "replies", "reply", "respond", "responses", "search", "share", "sharing", "sidebar", "signup", "social", "sponsor", "sponsored",
             "subscribe", "subscription", "toolbar", "widget", "widgets"}
#: These hold the article; they go only if a whole class or id is such a word.
STURDY = {"html", "body", "main", "article"}


@cache
def _patterns():
    raw = "|".join(sorted(RAW))
    tag = (r"<!--(?:>|->|.*?(?:--!?>|\Z))"
           rf"|<({raw})(?=[\s/>])(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>.*?(?:</\1\s*[^>]*>|\Z)"
           r"|<(/?)([a-z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+(?:\"|\Z)|'[^']*+(?:'|\Z))*+)(?:>|\Z)"
           r"|<[!?/](?:[^>]*)(?:>|\Z)")
    attribute = r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?"""
    return re.compile(tag, re.I | re.S), re.compile(attribute, re.S), re.compile(r"[a-z]+")


def _attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): unescape(m[2] or m[3] or m[4] or "") for m in _patterns()[1].finditer(text)}


class Node:
    """An element of the page: its place in the tree and what was said of it."""

    __slots__ = ("bad", "firm", "hint", "label", "name", "parent", "path", "score")

    def __init__(self, name: str, label: str, parent: Node | None, bad: bool, hint: int, ids: dict[tuple[int, str], int]):
        self.name, self.label, self.parent, self.hint = name, label, parent, hint
        #: a number for the page's path of labels, so that a deep page holds no long texts
        self.path = ids.setdefault((parent.path if parent else 0, label), len(ids) + 1)
        self.bad = self.firm = bad or (parent is not None and parent.bad)
        self.score = 0.0

    def path_text(self) -> str:
        return "/".join(reversed([n.label for n in _up(self)]))


def _is_bad(name: str, attrs: dict[str, str]) -> bool:
    """By tag, role or style, whatever the element holds."""
    if name in BAD_TAGS or attrs.get("role", "").lower() in BAD_ROLES or "hidden" in attrs:
        return True
    if name in STURDY and any(n in BAD_WORDS for n in _names(attrs)):
        return True
    return bool(re.search(r"display\s*:\s*none", attrs.get("style", ""), re.I))


def _names(attrs: dict[str, str]) -> list[str]:
    return f"{attrs.get('class', '')} {attrs.get('id', '')}".lower().split()


def _is_hint(name: str, attrs: dict[str, str]) -> int:
    """By a whole class or id or as a form (2), or by a part of a class or id (1); ``settle`` decides."""
    if name in MOSTLY_BAD or (name not in STURDY and any(n in BAD_WORDS for n in _names(attrs))):
        return 2
    return int(name not in STURDY and any(w in BAD_WORDS for n in _names(attrs) for w in _patterns()[2].findall(n)))


def settle(nodes: list[Node], found: list[tuple[Node, str, int]]) -> None:
    """Make elements with a hint bad, but not those around the page's content:
    a main or h1, articles if no article or main stands outside all hints, or,
    on a page with neither, most of the text that is not link text. A strong hint
    is spared around a main or such an article, or if nearly all text is inside."""
    hinted = [n for n in nodes if n.hint and not n.bad]
    if not hinted:
        return
    under = {}  # the nearest element with a hint, from the element itself up
    for n in nodes:  # parents first
        under[n] = n if n.hint else under[n.parent] if n.parent else None
    marks = [n for n in nodes if not n.bad and n.name in ("article", "main", "h1")]
    if any(n.name != "h1" and under[n] is None for n in marks):
        firm = [n for n in marks if n.name != "article"]
    else:
        firm = marks
    spared: set[Node] = set()
    around: set[Node] = set()  # a main or an article that counts
    for known, inside in ((spared, firm), (around, [n for n in firm if n.name != "h1"])):
        for n in inside:
            for above in _up(n):
                if above in known:
                    break
                known.add(above)
    weight = dict.fromkeys(nodes, 0)
    for n, text, links in found:
        if not n.bad:
            weight[n] += len(text) - links
    for n in reversed(nodes):
        if n.parent:
            weight[n.parent] += weight[n]
    if all(n.name == "h1" for n in marks):
        spared |= {n for n in hinted if 2 * weight[n] > weight[nodes[0]]}
    whole = {n for n in hinted if n.hint == 2 and n not in around and weight[n] < NEARLY * weight[nodes[0]]}
    for n in nodes:
        n.bad = n.bad or (n.parent is not None and n.parent.bad) or (n.hint > 0 and (n not in spared or n in whole) and
                                                                      not (n.hint == 2 and n not in whole and weight[n]))


def blocks(html: str) -> list[tuple[Node, str, int]]:
    """``(element, text, link characters)`` of each run of text between block boundaries."""
    ids: dict[tuple[int, str], int] = {}
    root = Node("html", "html", None, False, 0, ids)
    stack, nodes, out = [root], [root], []
    run: list[str] = []
    skipped: list[tuple[str, int]] = []  # open INLINE_BAD elements and the stack's height at their start
    links = in_link = at = 0

    def flush():
        nonlocal links
        if run:
            text = " ".join(unescape("".join(run)).split())
            if text:
                out.append((stack[-1], text, min(links, len(text))))
            run.clear()
        links = 0

    def close(to: int):
        flush()
        del stack[max(1, to):]
        while skipped and skipped[-1][1] > len(stack):
            skipped.pop()

    def add(text: str):
        nonlocal links
        if text and not skipped:
            run.append(text)
            if in_link:
                links += len(text)

    for m in _patterns()[0].finditer(html):
        add(html[at:m.start()])
        at = m.end()
        name = (m[3] or "").lower()
        if name == "br":
            run.append(" ")
        elif name == "a":
            in_link = 0 if m[2] or skipped else 1
        elif name == "hr":
            if not skipped:
                flush()
        elif name in INLINE_BAD:
            if not m[2]:
                if not (m[4].rstrip().endswith("/") and name in FOREIGN):
                    skipped.append((name, len(stack)))
            elif any(n == name for n, _ in skipped):
                while skipped[-1][0] != name:
                    skipped.pop()
                del stack[skipped.pop()[1]:]
        elif name in BLOCKS and m[2]:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].name == name:
                    close(k)
                    break
            else:
                flush()
            in_link = 0
        elif name in BLOCKS and name != "html":
            flush()
            while skipped and skipped[-1][0] in FOREIGN:
                skipped.pop()
            low = max((n for tag, n in skipped if tag in SCOPES), default=1) - 1
            for k in range(len(stack) - 1, max(0, low), -1):
                if stack[k].name == "p":  # any block ends an open paragraph
                    close(k)
                    break
                if stack[k].name in BLOCKS - {"p"}:
                    break
            ends, stops = CLOSES.get(name, ((), ()))
            if ends:
                for k in range(len(stack) - 1, max(0, low), -1):
                    if stack[k].name in ends:
                        close(k)
                        if name != "tr" or stack[-1].name not in ends:
                            break
                    elif stack[k].name in stops:
                        break
            attrs = _attributes(m[4]) if m[4] else {}
            label = ".".join([name, *sorted({re.sub(r"\d+", "#", c) for c in attrs.get("class", "").lower().split()})]).replace("/", "|")
            stack.append(Node(name, label, stack[-1], _is_bad(name, attrs), _is_hint(name, attrs), ids))
            nodes.append(stack[-1])
            in_link = 0
    add(html[at:])
    flush()
    settle(nodes, out)
    return out


def _kept(found: list[tuple[Node, str, int]]) -> list[tuple[Node, str, int]]:
    """Without boilerplate; a heading or lead inside an article's header stays. If
    nothing else is left, what only classes or forms speak against stays."""
    def good(node: Node, text: str) -> bool:
        if not node.bad:
            return True
        above = node.parent
        return ((node.name in HEADINGS or (node.name == "p" and len(text.split()) >= LEAD)) and above is not None
                and above.name == "header" and above.parent is not None and not above.parent.bad
                and any(n.name in ("article", "main") for n in _up(above)))
    return [b for b in found if good(b[0], b[1])] or [b for b in found if not b[0].firm]


def _up(node: Node | None):
    while node is not None:
        yield node
        node = node.parent


def best_container(kept: list[tuple[Node, str, int]]) -> Node | None:
    """The container with the most text of its own, half as much for its children's."""
    seen: dict[int, Node] = {}
    for node, text, links in kept:
        worth, share = float(len(text) - links), 1.0
        for n in _up(node):
            if n.name in CONTAINERS:
                n.score += worth * share * (1.25 if n.name in ("article", "main") else 1.0)
                seen.setdefault(id(n), n)
                share /= 2
                if share < 0.5:
                    break
    return max(seen.values(), key=lambda n: n.score, default=None)


def climb(node: Node, kept: list[tuple[Node, str, int]]) -> Node:
    """The highest element around ``node`` whose further text belongs to it: that
    text is mostly no link text and stands in no container of its own, except
    inside the article or main around ``node``. Nothing above a main, or above an
    article without a main, is tried."""
    chain = list(_up(node))
    tops = [i for i, n in enumerate(chain) if n.name == "main"] or [i for i, n in enumerate(chain) if n.name == "article"]
    chain = chain[:tops[-1] + 1] if tops else chain
    # where each element meets the chain, and whether in a section beside one, a rival container or an article
    met: dict[Node, tuple[int, bool, bool, bool]] = {n: (i, False, False, False) for i, n in enumerate(chain)}

    def meet(n: Node) -> tuple[int, bool, bool, bool] | None:
        way = []
        for above in _up(n):
            if above in met:
                break
            way.append(above)
        else:
            return None  # above the chain
        for x in reversed(way):
            i, part, rival, article = met[x.parent]
            beside = x.parent is chain[i] and x.parent.name != "body" and x.name == "section" and i > 0 and chain[i - 1].name == "section"
            part = part or beside
            met[x] = (i, part, rival or (x.name in CONTAINERS and not part), article or x.name == "article")
        return met[n]

    further = [[0, 0, False, False] for _ in chain]
    for n, text, links in kept:
        if found := meet(n):
            i, _, rival, article = found
            f = further[i]
            f[0], f[1], f[2], f[3] = f[0] + len(text), f[1] + links, f[2] or rival, f[3] or article
    best, size, linked, rivals, articles, inside = node, 0, 0, False, False, node.name == "article"
    for n, (more, links, rival, article) in list(zip(chain, further, strict=True))[1:]:
        size, linked, rivals, articles = size + more, linked + links, rivals or rival, articles or article
        whole = n.name in ("article", "main") and not articles and not inside
        if (more or (whole and size)) and 2 * linked <= size and (whole or not rivals):
            best = n
        inside = inside or n.name == "article"
    return best


def vote(html: str) -> str | None:
    """The generalised path of a page's best container with the text around it."""
    kept = _kept(blocks(html))
    node = best_container(kept)
    return climb(node, kept).path_text() if node else None


def extract(html: str, paths: list[str]) -> str:
    """The text in the containers on the first of ``paths`` that the page has."""
    kept = _kept(blocks(html))
    there: dict[int, set[Node]] = {}
    seen: set[Node] = set()
    for node, _, _ in kept:
        for n in _up(node):
            if n in seen:
                break
            seen.add(n)
            there.setdefault(n.path, set()).add(n)
    tree = {(n.parent.path if n.parent else 0, n.label): n.path for n in seen} if paths else {}

    def number(path: str) -> int:
        at = 0
        for label in path.split("/"):
            at = tree.get((at, label), -1)
            if at < 0:
                break
        return at

    path = next((n for n in map(number, paths) if n in there), None)
    best = best_container(kept) if path is None else None
    if path is None and best is None:
        return "\n\n".join(text for _, text, _ in kept)
    if path is None:
        chosen = there[climb(best, kept).path]
    else:
        chosen = there[path]
        if len(chosen) == 1:  # the page may have more around it than its host's others
            chosen = {climb(next(iter(chosen)), kept)}
    under: dict[Node | None, bool] = {None: False}

    def within(node: Node) -> bool:
        way = []
        n = node
        while n not in under and n not in chosen:
            way.append(n)
            n = n.parent
        found = n in chosen or under[n]
        under.update(dict.fromkeys(way, found))
        return found

    inside = [text for node, text, _ in kept if within(node)]
    return "\n\n".join(inside)


def host_of(url):
    """The lower-case host of a URL column; null where there is none."""
    host = F.lower(F.regexp_extract(F.coalesce(url.cast("string"), F.lit("")),
                                    r"^\s*[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:\s]+)", 1))
    return F.when(host != "", host)


def host_paths(pages: DataFrame, url_col: str = "url", html_col: str = "html", min_share: float = MIN_SHARE) -> DataFrame:
    """``host, paths, votes``: the winning paths of each host, most votes first,
    and its number of votes."""
    narrow = pages.select(host_of(F.col(url_col)).alias("host"), F.col(html_col).cast("string").alias("html")).where(
        "host is not null and html is not null")

    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column("host"), pa.array(map(vote, b.column("html").to_pylist()), pa.string())],
                                             names=["host", "path"])

    votes = narrow.mapInArrow(run, "host string, path string").where("path is not null")
    counts = votes.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n"))
    counts = counts.withColumn("votes", F.sum("n").over(Window.partitionBy("host")))
    won = counts.where(F.col("n") >= min_share * F.col("votes"))
    ranked = F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("n"), "path")))
    return won.groupBy("host").agg(ranked.alias("r"), F.first("votes").alias("votes")).select(
        "host", F.transform("r", lambda x: x.path).alias("paths"), "votes")


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
              min_share: float = MIN_SHARE) -> DataFrame:
    """One row per input row: ``page_id, url, text, n_chars`` (code points).

    Blocks are joined by an empty line. A null or empty html has an empty text.
    A url without host takes part in no vote and its page uses its own best
    container. Repeated rows vote each. An empty table gives no rows. Other
    columns are not read."""
    paths = materialize(host_paths(pages, url_col, html_col, min_share).withColumnRenamed("host", "voted"), "host-paths")
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                        F.coalesce(F.col(html_col).cast("string"), F.lit("")).alias("html"), host_of(F.col(url_col)).alias("host"))
    # hosts with a large share of the votes, at most 1 / HOT_SHARE of them, are broadcast: their pages do not move
    hot = paths.where(F.col("votes") >= HOT_SHARE * paths.agg(F.sum("votes").cast("double")).scalar())
    same = F.col("host") == F.col("voted")
    settled = rows.join(F.broadcast(hot), same)
    others = rows.join(F.broadcast(hot.select("voted")), same, "left_anti").join(paths, same, "left")
    rows = settled.unionByName(others).select("page_id", "url", "html", "paths")

    def run(batches):
        for b in batches:
            texts = [extract(h, p or []) for h, p in
                     zip(b.column("html").to_pylist(), b.column("paths").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [b.column("page_id"), b.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                names=["page_id", "url", "text", "n_chars"])

    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")

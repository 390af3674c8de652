"""HTML extraction by equivalence classes of tokens across the pages of a host.

A page is a sequence of tokens: tags, each with the path of open elements around it, and text
blocks. A token's occurrence vector has its count on every page of the host. Tokens with equal
vectors form an equivalence class; a class is valid if it has at least ``MIN_SIZE`` tokens, occurs
on at least ``MIN_SHARE`` of the host's distinct pages (``MIN_PAGES`` at least), and its tokens keep
one order on all of them. The valid classes, nested by the elements around them, are the template.
Its text blocks (menus, notices, the same on page after page) are no content, except that in
``article`` or ``main`` only those go that are mostly links: near copies of an article share its
paragraphs. The gaps between its tags are the slots, and what they hold on a page is its content.

The host's main slot is the innermost element path that holds ``MAIN_SHARE`` of the slots' text
outside links over all pages of the host. A page's text is what the elements of that path hold,
whatever their size, but those that are mostly links (teasers), widened to the ``article`` or
``main`` around it or, without these, to parents whose heading comes before it, and the other
``article`` and ``main`` elements of the page that are not mostly links. A host without a
template, or a page without its main slot, falls back on the page alone: ``article`` or ``main``,
else the element with several blocks that holds most text outside links, and from there up while
what a parent adds is not mostly links. Containers that are never article text (navigation, page
header and footer, aside, forms, adverts, comments and the like, by tag, role, class or id) are left
out everywhere.

Vectors are compared by a sum of hashes of (page, count), so that a host of any size needs one
partial aggregation; orders by the least and greatest order hash. Tokens travel as hashes, in one
array a page, and pages are never shuffled unless there are more than ``BROADCAST_ROWS`` templates.
A host's template has at most 1 / MIN_SHARE times the tokens of a page. Exact copies of a page
count once.

Defined results: a null or empty html gives an empty text; a null url belongs to the host ``""``;
a host of fewer than MIN_PAGES distinct pages has no template and relies on the containers alone;
unclosed and wrongly closed tags are repaired; repeated rows each give their row; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import cut

MIN_PAGES, MIN_SHARE, MIN_SIZE = 3, 0.6, 2
MAIN_SHARE = 0.6
BROADCAST_ROWS, BROADCAST_HASHES = 200_000, 4_000_000  # hosts, and hashes of 8 bytes in all their templates

# Fixed values of HTML: elements by their role in layout.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())
HIDDEN = set("head script style noscript template title svg math iframe object embed canvas audio video map select option textarea button input".split())
FRAME = set("nav header footer aside form menu dialog".split())
MAIN = set("article main".split())
CLOSES = {"p": set("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split()), "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "option": {"option"}}
SCOPE = {"p": set("table td th li div article section main body button object caption".split()), "li": {"ul", "ol", "menu"}, "tr": {"table"}, "td": {"table", "tr"}, "th": {"table", "tr"}, "dt": {"dl"}, "dd": {"dl"}, "option": {"select"}}
HEADINGS = {f"h{i}" for i in range(1, 7)}
SIDE = r"(?:ads?|advert\w*|banner|breadcrumbs?|comments?|consent|cookies?|copyright|disqus|footer|gdpr|header|masthead|menu|modal|nav\w*|newsletter|notices?|pager|pagination|popup|promo\w*|related|replies|reply|share|sharing|side-?bar|skip-?link|social|sponsor\w*|subscribe|toolbar|topbar|widget\w*)"
PLAIN = r"(?:area|articles?|bar|block|bottom|box|buttons?|column|container|form|global|group|inner|items?|left|links?|list|main|outer|page|panel|posts?|primary|right|row|secondary|section|site|slot|thread|top|unit|wrap(?:per)?|\d+)"
# a class or id of such words alone: "related-posts", but not "related-work"
SIDE_WORDS = re.compile(rf"(?:^|\s)(?:{PLAIN}[_-])*{SIDE}(?:[_-](?:{PLAIN}|{SIDE}))*(?:$|\s)", re.I)
SIDE_ROLES = set("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?"
    r"|<(script|style|noscript|template|textarea|iframe|svg|title)\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>",
    re.S | re.I,
)
ATTRIBUTE = re.compile(r"""(class|id|role|hidden|aria-hidden|itemprop)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
BLANK = re.compile(r"\s+")


class Block:
    """A text block: its text and token, the elements around it, how much of it is in links.

    An element is (name, label, side, main, serial, hash of its label path).
    """

    __slots__ = ("text", "token", "path", "linked")

    def __init__(self, text: str, token: str, path: tuple, linked: int):
        self.text, self.token, self.path, self.linked = text, token, path, linked


def _at(path: tuple | list) -> str:
    return "/".join(s[1] for s in path if s[0] not in INLINE)


def _element(name: str, attributes: str) -> tuple[str, bool, bool]:
    """Label, whether it can't hold article text, whether it marks the article."""
    values = {k.lower(): (v or "").strip("\"'") for k, v in ATTRIBUTE.findall(attributes)} if attributes.strip() else {}
    marks = " ".join(values.get(k, "") for k in ("class", "id")).strip()
    role = values.get("role", "").lower()
    main = name in MAIN or role in ("main", "article") or values.get("itemprop", "") == "articleBody"
    side = name in FRAME or name in HIDDEN or role in SIDE_ROLES or "hidden" in values or values.get("aria-hidden") == "true" or bool(marks and not main and SIDE_WORDS.search(marks))
    return f"{name}.{marks}" if marks else name, side, main


def parse(page: str) -> tuple[list[str], list[Block]]:
    """Tokens in page order, ``path<label`` for a tag and ``path"text`` for a text block; blocks."""
    tokens, blocks, stack = [], [], []  # stack: elements as Block has them
    text, linked, links, serial = [], 0, 0, 0

    def flush() -> None:
        nonlocal text, linked
        whole = BLANK.sub(" ", entities.unescape("".join(text))).strip() if text else ""
        if whole:
            path = tuple(s for s in stack if s[0] not in INLINE)
            blocks.append(Block(whole, _at(path) + '"' + whole, path, linked))
            tokens.append(blocks[-1].token)
        text, linked = [], 0

    def close(index: int) -> None:
        nonlocal links
        for s in stack[index:]:
            links -= s[0] == "a"
        del stack[index:]

    at = 0
    for m in TOKEN.finditer(page):
        if m.start() > at:
            piece = page[at : m.start()]
            text.append(piece)
            if links:
                linked += len(piece)
        at = m.end()
        name = (m[3] or "").lower()
        if m[1] or not name:
            continue
        if m[2]:
            own = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == name), None)
            if name not in INLINE:
                flush()
                if own is None and name == "p":
                    continue
            if own is not None:
                if name in INLINE and any(s[0] not in INLINE for s in stack[own:]):
                    continue
                close(own)
            continue
        if name == "br":
            text.append("\n")
            continue
        if name not in INLINE:
            flush()
            for i in range(len(stack) - 1, -1, -1):
                open_name = stack[i][0]
                if name in CLOSES.get(open_name, ()):
                    close(i)
                    break
                if open_name in SCOPE.get(name, SCOPE["p"]):
                    break
            label, side, main = _element(name, m[4])
            if name == "header" and any(s[0] == "article" for s in stack):
                side = False  # an article's own header has its title
            tokens.append(_at(stack) + "<" + label)
        else:
            label, side, main = _element(name, m[4]) if m[4].strip() else (name, False, False)
            side = side and name not in INLINE or "hidden" in m[4] and side
        if name in VOID or m[4].endswith("/") and name not in INLINE and name not in ("div", "p", "li"):
            continue
        serial += 1
        place = _hash(tokens[-1]) if name not in INLINE else 0
        stack.append((name, label, side, main, serial, place))
        links += name == "a"
    if at < len(page):
        text.append(page[at:])
    flush()
    return tokens, blocks


def _kept(owned: list[tuple[int, Block]]) -> list[int]:
    """Serials of the elements, of (serial, block) pairs, whose text is not mostly links."""
    size, linked = Counter(), Counter()
    for serial, b in owned:
        size[serial] += len(b.text)
        linked[serial] += b.linked
    return [k for k, n in size.items() if n and linked[k] * 2 <= n]


def _main(slots: list[Block], main: int) -> list[Block]:
    """The slots' blocks in the elements of a host's main path, widened; none if the page has no such."""
    wide = set()
    for serial in _kept([(s[4], b) for b in slots for s in b.path if s[5] == main]):
        first = next(i for i, b in enumerate(slots) if any(s[4] == serial for s in b.path))
        path = slots[first].path
        at = next(i for i, s in enumerate(path) if s[4] == serial)
        marked = next((i for i in range(at, -1, -1) if path[i][3]), None)
        if marked is not None:
            at = marked
        while marked is None and at:
            # a parent is the article's if a heading of it comes before
            up = path[at - 1][4]
            if not any(any(s[4] == up for s in b.path) and any(s[0] in HEADINGS for s in b.path) for b in slots[:first]):
                break
            at -= 1
            first = next(i for i, b in enumerate(slots) if any(s[4] == up for s in b.path))
        wide.add(path[at][4])
    return [b for b in slots if any(s[4] in wide for s in b.path)]


def _alone(slots: list[Block]) -> list[Block]:
    """The main blocks of a page of which no template tells."""
    mains = [b for b in slots if any(s[3] for s in b.path)]
    if mains:
        of = lambda b: next(s[4] for s in b.path if s[3])
        kept = _kept([(of(b), b) for b in mains])
        return [b for b in mains if not kept or of(b) in kept]
    weight, several, size, linked = Counter(), Counter(), Counter(), Counter()
    for b in slots:
        free = len(b.text) - b.linked
        for depth, s in enumerate(s for s in reversed(b.path) if s[0] != "html"):
            weight[s[4]] += free / (1 + depth / 2)
            several[s[4]] += 1
            size[s[4]] += len(b.text)
            linked[s[4]] += b.linked
    # a container has several blocks; one block is the page's text only if it is all there is
    best = max((k for k in weight if several[k] > 1), key=lambda k: (weight[k], k), default=None)
    if best is None:
        return slots
    path = next([s[4] for s in b.path if s[0] != "html"] for b in slots if any(s[4] == best for s in b.path))
    # climb while what the parent adds is no list of links
    for up in reversed(path[: path.index(best)]):
        if (linked[up] - linked[best]) * 2 > size[up] - size[best]:
            break
        best = up
    return [b for b in slots if any(s[4] == best for s in b.path)]


def slots_of(blocks: list[Block], template: set[int]) -> list[Block]:
    """Blocks outside side containers that are not the template's text."""
    own = [b for b in blocks if not any(s[2] for s in b.path)]
    if not template:
        return own
    return [b for b in own if token_hash(b.token) not in template or any(s[3] for s in b.path) and b.linked * 2 <= len(b.text)]


def extract(page: str, template: set[int], main: int | None = None) -> str:
    """The main text of a page, given the hashes of its host's template texts and of its main path."""
    slots = slots_of(parse(page)[1], template)
    chosen = _main(slots, main) if main is not None else []
    if chosen:  # articles beside the main slot are content too
        outer = lambda b: next((s[4] for s in b.path if s[3]), None)
        near = {outer(b) for b in chosen} | {None}
        beside = _kept([(outer(b), b) for b in slots if outer(b) not in near])
        own = set(map(id, chosen))
        chosen = [b for b in slots if id(b) in own or outer(b) in beside]
    chosen = chosen or _alone(slots)
    return "\n\n".join(b.text for b in chosen)


def host(url: Column) -> Column:
    return F.lower(F.coalesce(F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)", 1), F.lit("")))


def _hash(text: str) -> int:
    h = xxhash.xxh3_64_intdigest(text)
    return h - (h >> 63 << 64)


def token_hash(token: str) -> int:
    """64 bits of a token, as a signed number; odd for text blocks."""
    return _hash(token) & ~1 | (token.find('"') > -1 and "<" not in token.split('"', 1)[0])


SLOTS = "array<struct<token:long,article:boolean,free:int,path:array<long>>>"


def tokens(pages: DataFrame) -> DataFrame:
    """host, page, tokens, counts, blocks: a row per distinct page; its distinct tokens by first place, as
    hashes, and its text blocks outside side containers, with the label paths around them (SLOTS)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for i in range(0, len(batch), 200):
                part, found, blocks = batch.iloc[i : i + 200], [], []
                for source in part["html"]:
                    own, text = parse(source)
                    found.append(Counter(own))
                    blocks.append([{"token": token_hash(b.token), "article": any(s[3] for s in b.path) and b.linked * 2 <= len(b.text), "free": len(b.text) - b.linked, "path": [s[5] for s in b.path]} for b in text if not any(s[2] for s in b.path)])
                yield pd.DataFrame({"host": part["host"], "page": part["page"], "tokens": [[token_hash(t) for t in c] for c in found], "counts": [list(c.values()) for c in found], "blocks": blocks})

    own = pages.filter("html is not null").select(F.xxhash64(host(F.col("url"))).alias("host"), F.xxhash64("html").alias("page"), "html")
    return own.mapInPandas(run, f"host long, page long, tokens array<long>, counts array<int>, blocks {SLOTS}").dropDuplicates(["host", "page"])


def small(df: DataFrame, rows: int, hashes: str | None = None) -> DataFrame:
    """A broadcast hint if df has at most so many rows, and BROADCAST_HASHES members in an array column; else
    Spark joins by shuffle."""
    held = F.coalesce(F.sum(F.size(hashes)), F.lit(0)) if hashes else F.lit(0)
    n, members = df.limit(rows + 1).agg(F.count(F.lit(1)), held).first()
    return F.broadcast(df) if n <= rows and members <= BROADCAST_HASHES else df


def templates(pages: DataFrame, min_share: float = MIN_SHARE) -> DataFrame:
    """host, texts, main: hashes of the text tokens of each host's template and of its main slot's path
    (hosts without a template are absent)."""
    found = cut(tokens(pages))
    each = found.select("host", "page", F.posexplode(F.arrays_zip("tokens", "counts")).alias("place", "t")).select("host", "page", "place", F.col("t.tokens").alias("token"), F.col("t.counts").alias("n"))
    size = found.groupBy("host").agg(F.count(F.lit(1)).alias("all_pages")).filter(F.col("all_pages") >= MIN_PAGES)
    vectors = each.groupBy("host", "token").agg(F.sum(F.shiftright(F.xxhash64("page", "n"), 20)).alias("vector"), F.count(F.lit(1)).alias("pages")).filter(F.col("pages") >= MIN_PAGES)
    frequent = cut(vectors.join(size, "host").filter(F.col("pages") >= F.col("all_pages") * min_share).select("host", "token", "vector"))
    # a class is in order if its tokens' first places have one order on all pages
    on_page = each.join(small(frequent, BROADCAST_ROWS), ["host", "token"]).groupBy("host", "vector", "page").agg(F.array_sort(F.collect_list(F.struct("place", "token"))).alias("row"))
    orders = on_page.select("host", "vector", F.size("row").alias("members"), F.xxhash64(F.transform("row", lambda r: r["token"])).alias("order"))
    valid = orders.groupBy("host", "vector").agg(F.min("order").alias("least"), F.max("order").alias("most"), F.max("members").alias("members")).filter(f"least = most and members >= {MIN_SIZE}")
    members = cut(frequent.join(valid, ["host", "vector"], "left_semi"))
    of_host = members.groupBy("host").agg(F.collect_set(F.when(F.col("token").bitwiseAND(F.lit(1).cast("long")) == 1, F.col("token"))).alias("texts"))
    # the slots of all pages, by every element path around them
    page = found.select("host", "blocks").join(small(of_host, BROADCAST_ROWS, "texts"), "host")
    slot = page.select("host", F.explode(F.filter("blocks", lambda b: b["article"] | ~F.array_contains("texts", b["token"]))).alias("b"))
    around = slot.select("host", F.col("b.free").alias("free"), F.posexplode(F.array_distinct("b.path")).alias("depth", "path"))
    paths = around.groupBy("host", "path").agg(F.sum("free").alias("free"), F.max("depth").alias("depth"))
    most = paths.groupBy("host").agg(F.max("free").alias("most"))
    inner = paths.join(most, "host").filter(F.col("free") >= F.col("most") * MAIN_SHARE)
    main = inner.groupBy("host").agg(F.max_by("path", F.struct("depth", "free", "path")).alias("main"))
    return of_host.join(main, "host", "left")


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page."""

    @F.pandas_udf("string")
    def run(page: pd.Series, template: pd.Series, main: pd.Series) -> pd.Series:
        rows = zip(page.fillna(""), template, main.astype("Int64"))
        return pd.Series([extract(p, set(t) if t is not None else set(), None if pd.isna(m) else int(m)) for p, t, m in rows], dtype=object)

    own = pages.select("page_id", "url", "html", F.xxhash64(host(F.col("url"))).alias("host"))
    text = run("html", "texts", "main")
    return own.join(small(cut(templates(pages)), BROADCAST_ROWS, "texts"), "host", "left").select("page_id", "url", text.alias("text")).withColumn("n_chars", F.length("text").cast("long"))


def query(pages: DataFrame) -> DataFrame:
    return main_text(pages)

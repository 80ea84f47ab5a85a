"""Main text of web pages: templates deduced per host from equivalence classes of tokens, then slots."""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import join_small, small_batches, stored

NAME = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*)")
STOP = re.compile(r"[\"'<>]")
ATTRIBUTE = re.compile(r"([a-zA-Z_:-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
SPACE = re.compile(r"\s+")
# fixed values: HTML's own element classes, and names that pages give to what is not their article
RAW = {"script", "style", "noscript", "template", "textarea", "title", "iframe", "noembed", "noframes", "xmp", "svg", "math", "object", "canvas"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {"a", "abbr", "b", "bdi", "bdo", "br", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins", "kbd", "mark", "q", "s", "samp", "small", "span", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr"}
CLOSED_BY_NEXT = {"p", "li", "dt", "dd", "tr", "td", "th", "option", "h1", "h2", "h3", "h4", "h5", "h6"}
ASIDE = {"nav", "header", "footer", "aside", "form", "menu", "dialog", "button", "select", "fieldset", "head"}
NAMES = re.compile(r"(?:^|[\s_-])(?:ads?|advert\w*|banner|sponsor\w*|promo\w*|nav\w*|menu\w*|breadcrumbs?|header|footer|side-?bar|aside|widget|cookies?|consent|notice|alert|popup|modal|newsletter|subscribe|share|social|comments?|replies|disqus|respond|related|recommend\w*|login|search|pagination|pager|toolbar|copyright|legal)(?=$|[\s_-])", re.I)
# an article element with such a name is a reader's comment or a teaser; a page's state (comments-open) doesn't count
TEASER = re.compile(r"(?:^|\s)(?:comments?|repl(?:y|ies)|respond|disqus|related|recommend\w*)(?:[-_](?!open|closed?|on|off|enabled|disabled|allowed)\w+)*(?=$|\s)", re.I)


class Tags:
    """The tags of a page in order, found in time proportional to its length, whatever is left open in it."""

    def __init__(self, page: str):
        self.page = page
        self.failed: set[int] = set()  # places outside quotes from which no tag ends
        self.unclosed: set[str] = set()  # quotes that don't occur any more

    def end(self, at: int) -> int:
        """The place of the > that ends a tag whose attributes begin at `at`; -1 if a < or the page's end comes first.

        A quote that is never closed is a character like others."""
        page, seen = self.page, []
        while at not in self.failed:
            seen.append(at)
            m = STOP.search(page, at)
            if m and m[0] == ">":
                return m.start()
            if not m or m[0] == "<":
                break
            at = m.end()
            if m[0] not in self.unclosed:
                close = page.find(m[0], at)
                if close < 0:
                    self.unclosed.add(m[0])
                else:
                    at = close + 1
        self.failed.update(seen)
        return -1

    def __iter__(self) -> Iterator[tuple[int, int, bool, str, str]]:
        """(start, end, closing, name, attributes); comments and declarations have no name. Elements of raw text have
        no tags inside: the next tag after one begins at its closing tag's end."""
        page, at, last = self.page, 0, self.page.rfind(">")
        while (start := page.find("<", at)) >= 0:
            if page.startswith("<!--", start):
                end = page.find("-->", start + 4)
                at = end + 3 if end >= 0 else len(page)
                yield start, at, False, "", ""
                continue
            if start > last:
                at = start + 1
                continue
            if page.startswith(("<!", "<?"), start):
                at = page.find(">", start) + 1
                yield start, at, False, "", ""
                continue
            m = NAME.match(page, start)
            end = self.end(m.end()) if m else -1
            if end < 0:
                at = start + 1
                continue
            closing, name = bool(m[1]), m[2].lower()
            at = end + 1
            if name in RAW and not closing:
                close = re.compile(rf"</{name}\b", re.I).search(page, at)
                end = page.find(">", close.end()) if close else -1
                at = end + 1 if end >= 0 else len(page)
                name = ""
            yield start, at, closing, name, page[m.end() : end] if name else ""


def read_blocks(page: str) -> list[tuple[str, bool, bool, str]]:
    """Blocks of a page in order: (digest of the path of open elements, inside an article or main, inside an aside, text).

    Inline elements don't end a block; unclosed elements end with the element around them. Whatever stands in an
    element with an aside's name or role is inside an aside. An element that only has a word for one in its class or
    id is one too, unless all articles and mains of the page stand in it: then the word tells the page's layout."""
    out: list[tuple[str, bool, bool, int, str]] = []
    # name, and of the element with all around it: path, article or main, aside by element or role, nearest by word
    stack: list[tuple[str, str, bool, bool, int]] = []
    opened: dict[str, int] = {}
    parts: list[str] = []
    around, depth = [-1], [0]  # of each aside by word: the one around it, how many are
    above: dict[int, int] = {}
    layout = -1  # the nearest that all articles stand in; 0 is none
    at = 0

    def flush() -> None:
        text = SPACE.sub(" ", entities.unescape("".join(parts))).strip()
        parts.clear()
        if text:
            out.append((*(stack[-1][1:] if stack else ("", False, False, 0)), text))

    for start, end, closing, name, attributes in Tags(page):
        parts.append(page[at:start])
        at = end
        if not name:
            continue
        if name in INLINE:
            if name == "br":
                parts.append(" ")
            continue
        flush()
        if name in VOID or attributes.endswith("/"):
            continue
        if closing:
            if opened.get(name):
                while stack:
                    opened[stack[-1][0]] -= 1
                    if stack.pop()[0] == name:
                        break
            continue
        if stack and (stack[-1][0] == "p" or stack[-1][0] == name and name in CLOSED_BY_NEXT):
            opened[stack.pop()[0]] -= 1
        given = {k.lower(): a or b or c for k, a, b, c in ATTRIBUTE.findall(attributes)}
        role, words = given.get("role", ""), f"{given.get('class', '')} {given.get('id', '')}".strip()
        label = f"{words} {role}".strip()
        main = name in ("article", "main") or role in ("main", "article")
        _, path, inside, away, aside = stack[-1] if stack else ("", "", False, False, 0)
        by_word = False
        if main:
            by_word = bool(words) and (name == "article" or role == "article") and bool(TEASER.search(words))
            main = not by_word
            if main and not inside and not away:
                x, y, climbed = aside, aside if layout < 0 else layout, []
                while x != y:
                    if depth[x] >= depth[y]:
                        climbed.append(x)
                        x = above.get(x, around[x])
                    else:
                        y = around[y]
                layout = x
                above.update(dict.fromkeys(climbed, x))  # layout only goes outwards, so these needn't be climbed again
        elif name != "body" and name != "html":
            away = away or name in ASIDE or bool(role and NAMES.search(role))
            by_word = bool(words) and not away and bool(NAMES.search(words))
        if by_word:
            around.append(aside)
            depth.append(depth[aside] + 1)
            aside = len(around) - 1
        opened[name] = opened.get(name, 0) + 1
        step = f"{path}/{name}" + ("." + SPACE.sub(".", label) if label else "")
        stack.append((name, blake2b(step.encode(errors="surrogatepass"), digest_size=8).hexdigest(), inside or main, away, aside))
    parts.append(page[at:])
    flush()
    common = {0}
    while layout > 0:
        common.add(layout)
        layout = around[layout]
    return [(path, inside, away or aside not in common, text) for path, inside, away, aside, text in out]


def token_of(path: str, words: str) -> int:
    """A block's token: 64 bits of its path and text."""
    return int.from_bytes(blake2b(f"{path}\0{words}".encode(errors="surrogatepass"), digest_size=8).digest(), "little", signed=True)


def host_of(url_col: str) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(F.col(url_col), F.lit("")), "://([^/?#]*)", 1))


def page_tokens(pages: DataFrame, id_col: str, url_col: str, html_col: str) -> DataFrame:
    """(host, row, token, pos): every block of every different page in page order, article blocks included.

    Pages of a host with the same blocks count once, so copies don't make a template. `row` numbers the rows of pages:
    repeated and null ids are pages of their own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            tokens = [[token_of(path, words) for path, _, _, words in read_blocks(source or "")] for source in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(tokens, pa.list_(pa.int64()))], ["row", "host", "tokens"])

    rows = small_batches(pages).select(F.monotonically_increasing_id().alias("row"), host_of(url_col).alias("host"), F.col(html_col).alias("html"))
    seen = stored(rows.mapInArrow(run, "row long, host string, tokens array<long>"), "tokens")
    first = seen.groupBy("host", F.xxhash64("tokens").alias("copy")).agg(F.min_by("tokens", "row").alias("tokens"), F.min("row").alias("row"))
    return first.select("host", "row", F.posexplode("tokens").alias("pos", "token"))


def nest_page(seen: list[dict], crossed: set[int], parents: dict[int, set[tuple[int, int]]]) -> None:
    """Walk the template tokens of a page with a stack of open classes. Of two classes that cross, the one on fewer
    pages (then of fewer tokens) goes to `crossed`; `parents` gets the slots, (class, place before), that classes
    stand in. The class of tokens that are once on every page holds the page's begin and end and is always open."""
    stack: list[list] = [[0, 0, -1, (1 << 62, 0, 0)]]  # class, its last place, place now, rank
    for t in seen:
        if t["root"]:
            crossed.update(x[0] for x in stack[1:])
            del stack[1:]
            stack[0][2] = t["place"]
            continue
        if t["class"] in crossed:
            continue
        at = next((k for k in range(len(stack) - 1, 0, -1) if stack[k][0] == t["class"]), 0)
        if not at:
            parents.setdefault(t["class"], set()).add((stack[-1][0], stack[-1][2]))
            if t["place"] < t["last"]:
                stack.append([t["class"], t["last"], t["place"], (t["pages"], t["last"], t["class"])])
            continue
        while at < len(stack) - 1 and stack[-1][3] < stack[at][3]:
            crossed.add(stack.pop()[0])
        if at < len(stack) - 1:
            crossed.add(stack.pop(at)[0])
            continue
        stack[at][2] = t["place"]
        if t["place"] == t["last"]:
            stack.pop()


def deduce_templates(tokens: DataFrame, min_pages: int = 4, min_share: float = 0.5) -> DataFrame:
    """Template tokens of each host: (host, token, class, pages, place, last, root).

    Tokens with the same occurrence vector over the host's pages form an equivalence class; the vector is kept as an
    order-free digest of (page, count), so no list of pages is gathered. A class is valid if
    - it occurs on at least min_pages pages and min_share of the host's and has two tokens or more, where the class of
      tokens that are once on every page counts the page's begin and end too (`root`);
    - its tokens come in one order on all pages, round by round if they repeat: `place` is the place in that order, a
      token without a fixed one leaves the class;
    - classes nest: none crosses another, and a class stands in the same slot of the same class on all pages. What
      doesn't is dropped, and the rest is looked at again until nothing changes.
    All steps are keyed by page or by (host, token); no task holds a host."""
    tokens = stored(tokens, "occurrences")
    counts = tokens.groupBy("host", "row", "token").agg(F.count("*").alias("n"))
    vectors = counts.groupBy("host", "token").agg(F.count("*").alias("pages"), F.max("n").alias("most"), F.bit_xor(F.xxhash64("row", "n")).alias("class")).where(F.col("pages") >= min_pages)
    size = tokens.groupBy("host", "row").agg(F.lit(1).alias("one")).groupBy("host").agg(F.count("*").alias("of"))
    often = vectors.join(size, "host").where(F.col("pages") >= min_share * F.col("of")).withColumn("root", (F.col("pages") == F.col("of")) & (F.col("most") == 1))
    often = stored(often.drop("of", "most"), "vectors")
    sizes = often.groupBy("host", "class").agg(F.count("*").alias("size"))
    often = stored(often.join(sizes, ["host", "class"]).where("size >= 2 or root"), "classes")
    met = stored(join_small(tokens, often, ["host", "token"], "inner", 4 * often.count()), "met")
    rank = F.row_number().over(Window.partitionBy("host", "row", "class").orderBy("pos")) - 1
    fixed = met.withColumn("place", rank % F.col("size")).groupBy("host", "token", "class", "pages", "root").agg(F.min("place").alias("place"), F.max("place").alias("other")).where("place = other").drop("other")
    ends = fixed.groupBy("host", "class").agg(F.count("*").alias("size"), F.max("place").alias("last"))
    template = stored(fixed.join(ends, ["host", "class"]).where("size >= 2 or root").drop("size"), "template")
    places = met.select("host", "row", "pos", "token")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for host, seen in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                crossed: set[int] = set()
                parents: dict[int, set[tuple[int, int]]] = {}
                nest_page(seen, crossed, parents)
                out += [(host, c, True, 0, 0) for c in crossed] + [(host, c, False, p, at) for c, slots in parents.items() for p, at in slots]
            cols = list(zip(*out, strict=True)) or [[]] * 5
            kinds = [pa.string(), pa.int64(), pa.bool_(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(cols, kinds, strict=True)], ["host", "class", "crossed", "parent", "at"])

    while not template.where("not root").isEmpty():
        walk = join_small(places, template, ["host", "token"], "inner", 4 * template.count())
        pages = walk.groupBy("host", "row").agg(F.sort_array(F.collect_list(F.struct("pos", "class", "pages", "place", "last", "root"))).alias("seen"))
        verdict = pages.select("host", "seen").mapInArrow(run, "host string, class long, crossed boolean, parent long, at long")
        slots = F.array_size(F.collect_set(F.when(~F.col("crossed"), F.struct("parent", "at"))))
        verdict = stored(verdict.groupBy("host", "class").agg(F.max("crossed").alias("crossed"), slots.alias("slots")), "nesting")
        # crossing ones first: without them the others may stand in one slot
        gone = verdict.where("crossed")
        gone = verdict.where("slots > 1") if gone.isEmpty() else gone
        if gone.isEmpty():
            break
        template = stored(template.join(gone.select("host", "class"), ["host", "class"], "left_anti"), "template")
    return template


def extract_main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) for every row of pages.

    A host's template is deduced first, from all blocks; on each page the blocks that are template tokens are fixed
    text, inside an article too, and what stands between them are slots. Element and name rules then check the slots:
    what stands in a menu, header, footer, sidebar, notice, advert, form or comment goes, and on a page with an
    article or main element what stands outside it. An article of which the template leaves nothing is a text that
    half of the host's pages share, and is kept. Blocks are joined by line feeds in page order.

    Null html: empty text. Null urls are pages of the host ''. Repeated ids keep their rows. A host's template holds
    few tokens (each is on half of its pages); templates are joined by host, which Spark splits when a host is hot.
    Pages of any length are read in time proportional to it: tags, quotes and elements that are never closed, and
    elements nested to any depth, cost nothing more; an unclosed tag is text. An empty table gives no rows."""
    template = stored(deduce_templates(page_tokens(pages, id_col, url_col, html_col)).groupBy("host").agg(F.collect_set("token").alias("template")), "templates")
    rows = small_batches(pages).select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"), host_of(url_col).alias("host"))
    block = pa.struct([("token", pa.int64()), ("words", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            article, found = [], []
            for source in b.column(2).to_pylist():
                blocks = read_blocks(source or "")
                inside = any(x[1] and not x[2] for x in blocks)
                article.append(inside)
                found.append([{"token": token_of(path, words), "words": words} for path, main, away, words in blocks if not away and main == inside])
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(3), pa.array(article, pa.bool_()), pa.array(found, pa.list_(block))], ["page_id", "url", "host", "article", "blocks"])

    found = rows.mapInArrow(run, "page_id long, url string, host string, article boolean, blocks array<struct<token long, words string>>")
    size = template.agg(F.sum(F.size("template") * 8 + 64)).first()[0] or 0
    joined = join_small(found, template, "host", "left", size, 1)
    slots = F.when(F.col("template").isNull(), F.col("blocks")).otherwise(F.filter("blocks", lambda s: ~F.array_contains("template", s["token"])))
    slots = F.when(F.col("article") & (F.size(slots) == 0), F.col("blocks")).otherwise(slots)
    text = F.array_join(F.transform(slots, lambda s: s["words"]), "\n")
    return joined.select("page_id", "url", text.alias("text")).withColumn("n_chars", F.char_length("text").cast("long"))

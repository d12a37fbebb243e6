"""Main text of web pages by a site style tree.

Every page is cut into text blocks with their place in the DOM (the chain of
block elements with their classes). What by its element, role or name is
never article (menus, forms, scripts, comments, ...) is left out at once. The
pages of a host are then merged into one tree whose nodes are those places.
A leaf's content importance comes from the entropy of its features over the
pages: content that recurs evenly on the pages of a host tells nothing about
any of them (0), content that one page alone has tells most (1). An inner
node has the average of what lies below it, and besides a presentation
importance, the entropy of the ways in which its children are laid out. A
branch that is low in both is part of the template and is removed from every
page of the host.

Fixed rules come first and the tree sees what they leave: menus and adverts
that vary by page recur no more than an article does, so entropy doesn't
find them (counts in the README).

The tree is built from counts: pages of one content on a host count once,
features are pre-aggregated, and the sums of a branch add up over its leaves,
so a host with a third of all pages is no larger group than its template.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.sources.storage import materialize

MIN_PAGES = 8       # distinct pages of a node from which its entropy is trusted
DEPTH = 48          # levels that a place tells apart; what lies deeper counts to the node above
IMPORTANCE = 0.1    # branches below this in content and presentation go

# Elements by their role in HTML.
_INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s "
                    "samp small span strike strong sub sup time tt u var wbr".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title xmp noembed noframes iframe".split())
_NEVER = frozenset("head nav footer aside form script style textarea title select button fieldset dialog menu iframe noscript "
                   "template object applet audio video canvas svg math map datalist option xmp noembed noframes".split())
_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar toolbar".split())
_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion cookie cookies consent "
    "gdpr notice notices popup modal overlay sidebar aside widget widgets menu menus nav navbar navigation breadcrumb breadcrumbs "
    "masthead footer comment comments reply replies respond disqus discussion share sharing social related recommended "
    "recommendations newsletter subscribe subscription login signup search pagination pager toolbar copyright topbar".split())
#: often outweigh the article, so that they have to be nearly all of the page to count
_REPLIES = frozenset("comment comments reply replies respond disqus discussion".split())
#: say what the page around has or hasn't: no-sidebar, has-menu, ad-free, share-enabled
_BEFORE, _BEHIND = frozenset("no non not without has have with".split()), frozenset("free less enabled disabled".split())
_KEEP = frozenset("html body main article".split())
_UNSEEN = frozenset("head script style title template datalist".split())  # no text of the page, whatever else is missing
_IN_HEAD = frozenset("title base link meta script style noscript template object".split())  # anything else ends an open head
_MARKS = frozenset("article main".split())
#: opening one of these closes an open one of the others
_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
           "option": {"option"}, "tbody": {"thead", "tbody", "tr", "td", "th"}, "tfoot": {"thead", "tbody", "tr", "td", "th"}}
_SCOPES = frozenset("table ul ol dl body article section div main".split())

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<(?P<end>/?)(?P<name>[A-Za-z][^\s/>]*)(?P<rest>(?:[^<>\"']|\"[^\"]*\"|'[^']*')*+)>|<[!?][^<>]*>",
                  re.S)
_ATTRIBUTE = re.compile(r"([A-Za-z_:][-\w:.]*)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")

Block = tuple[str, str]


def _signature(name: str, given: dict[str, str]) -> str:
    classes = sorted({re.sub(r"\d+", "0", c).replace(">", "_") for c in given.get("class", "").split()})
    return name + "".join(f".{c}" for c in classes)


def _listed(name: str, given: dict[str, str]) -> set[str]:
    """The words of class and id by which an element is listed as no article."""
    if name in _KEEP and "comment" not in given.get("class", "").lower():
        return set()
    found: set[str] = set()
    for c in f"{given.get('class', '')} {given.get('id', '')}".lower().split():
        words = re.findall(r"[a-z]+", c)
        if len(words) > 1 and words[-1] in _BEHIND:
            continue
        found.update(words[:next((i for i, w in enumerate(words[:-1]) if w in _BEFORE), len(words))])
    return found & _NAMES


def _never_article(name: str, given: dict[str, str], inside: bool, by_element: bool) -> bool:
    if not by_element:
        return name in _UNSEEN
    if name in _NEVER or name == "header" and not inside:
        return True
    if "hidden" in given or given.get("aria-hidden") == "true" or given.get("role", "").lower() in _ROLES:
        return True
    return bool(re.search(r"display\s*:\s*none", given.get("style", "")))


def _judged(blocks: list[tuple[str, str, bool, bool, int]], doubts: list[tuple[int, bool, bool]]) -> list[tuple[str, str, bool, bool]]:
    """The blocks without the branches that go by their names.

    A branch stays if it has most of the page's text that is no reply,
    branches of replies if all else is less than a tenth of the page.
    ``doubts`` are the named branches: that above (-1: none), in an article,
    of replies; a branch comes behind the one above it.
    """
    if not doubts:
        return [b[:4] for b in blocks]
    replies: list[bool] = []
    for above, _, own in doubts:
        replies.append(own or above >= 0 and replies[above])
    sizes, texts = [0] * len(doubts), [0] * len(doubts)  # of all, of what is no reply
    total = rest = 0
    for _, words, _, never, doubt in blocks:
        n = 0 if never else len(words)
        total += n
        if doubt >= 0:
            sizes[doubt] += n
        if doubt < 0 or not replies[doubt]:
            rest += n
            if doubt >= 0:
                texts[doubt] += n
    for i in range(len(doubts) - 1, -1, -1):
        if (above := doubts[i][0]) >= 0:
            sizes[above] += sizes[i]
            texts[above] += texts[i]
    gone: list[bool] = []
    gone_inside: list[bool] = []  # by a name in the article
    for i, (above, inside, own) in enumerate(doubts):
        goes = 10 * (total - sizes[i]) >= total if own else 2 * texts[i] <= rest and not replies[i]
        gone.append(goes or above >= 0 and gone[above])
        gone_inside.append(inside and (goes or above >= 0 and gone_inside[above]))
    return [(path, words, inside, never or doubt >= 0 and gone[doubt]) for path, words, inside, never, doubt in blocks
            if doubt < 0 or not (gone_inside if inside else gone)[doubt]]


def _parse(page: str, by_name: bool, by_element: bool = True) -> tuple[list[tuple[str, str, bool, bool]], list[tuple[str, str]]]:
    """``([(path, text, inside an article, article below what is never one)], [(path, layout of its children)])`` in page order."""
    blocks: list[tuple[str, str, bool, bool, int]] = []
    # element, path, never article, inside article, children, never article even if its outermost article counts, named branch
    stack: list[list] = [["", "", False, False, [], False, -1]]
    doubts: list[tuple[int, bool, bool]] = []
    layouts: list[tuple[str, str]] = []
    text: list[str] = []
    open_now: Counter[str] = Counter()
    unclosed: set[str] = set()  # inline elements with no end tag from here on

    def flush() -> None:
        if text:
            top = stack[-1]
            if not top[5]:
                words = " ".join(entities.unescape("".join(text)).split())
                if words:
                    blocks.append((top[1], words, top[3], top[2], top[6]))
            text.clear()

    def close() -> None:
        name, path, _, _, children, never, _ = stack.pop()
        open_now[name] -= 1
        if children and not never:
            layouts.append((path, " ".join(c for i, c in enumerate(children) if not i or c != children[i - 1])))

    at = 0
    while at < len(page):
        m = _TAG.search(page, at)
        if m is None:
            text.append(page[at:])
            break
        if m.start() > at:
            text.append(page[at:m.start()])
        at = m.end()
        name = m["name"]
        if name is None:  # comment, doctype, instruction
            continue
        name = name.lower()
        if name == "br" or name == "img":
            text.append(" ")
            continue
        if m["end"]:
            if name in _INLINE:
                continue
            depth = next((i for i in range(len(stack) - 1, 0, -1) if stack[i][0] == name), 0) if open_now[name] else 0
            flush()
            while depth and len(stack) > depth:
                close()
            continue
        given = ({k.lower(): a or b or c for k, a, b, c in _ATTRIBUTE.findall(m["rest"])} if m["rest"].strip() else {})
        if name in _RAW:
            end = re.compile(rf"</{name}\b[^>]*>", re.I).search(page, at)
            if name not in _INLINE:
                flush()
            at = end.end() if end else len(page)
            continue
        inside = stack[-1][3] or name in _MARKS
        if name in _INLINE:
            # an inline element that is noise by its own attributes hides its text only, by its name alone not half a page
            never = bool(given) and name not in unclosed and _never_article(name, given, inside, by_element)
            if never or given and by_name and name not in unclosed and _listed(name, given):
                end = re.compile(rf"</{name}\s*>", re.I).search(page, at)
                if not end:
                    unclosed.add(name)
                elif never or 2 * (end.start() - at) <= len(page):
                    at = end.end()
            continue
        flush()
        if name in _VOID:
            continue
        if stack[-1][0] == "p" or stack[-1][0] == "head" and name not in _IN_HEAD:
            close()
        for i in range(len(stack) - 1, 0, -1) if name in _CLOSES else ():
            if stack[i][0] in _CLOSES[name]:
                while len(stack) > i:
                    close()
                if name not in ("tr", "tbody", "tfoot"):
                    break
            elif stack[i][0] in _SCOPES:
                break
        parent = stack[-1]
        sign = _signature(name, given)
        parent[4].append(sign)
        open_now[name] += 1
        never = _never_article(name, given, parent[3], by_element)
        outermost = name in _MARKS and not parent[3]
        doubt = parent[6]
        if by_name and given and (names := _listed(name, given)):
            doubts.append((doubt, inside, not _REPLIES.isdisjoint(names)))
            doubt = len(doubts) - 1
        stack.append([name, parent[1] if len(stack) > DEPTH else f"{parent[1]}>{sign}" if parent[1] else sign,
                      parent[2] or never, inside, [],
                      False if outermost and by_element else parent[5] or never, doubt])
    flush()
    while len(stack) > 1:
        close()
    return _judged(blocks, doubts), layouts


def page_blocks(page: str | None) -> tuple[list[Block], list[tuple[str, str]]]:
    """Blocks of a page that may be article, with their places, and the layouts of the nodes.

    If the page marks its article, only that counts. An article below what is
    never one (a form around the page, a menu that is not closed, a wrapper
    hidden until scripts run) counts if it has more text than the articles
    elsewhere, and alone if it has more than all else. Branches with listed
    names go unless they have most of the text. If the names of elements
    would leave nothing, they are disregarded; if the rest of the rules
    would, all that is text.
    """
    blocks: list[tuple[str, str, bool, bool]] = []
    layouts: list[tuple[str, str]] = []
    for rules in ((True, True), (False, True), (False, False)):
        blocks, layouts = _parse(page or "", *rules)
        if blocks:
            break
    size = lambda some: sum(len(b[1]) for b in some)
    marked, below = [b for b in blocks if b[2] and not b[3]], [b for b in blocks if b[3]]
    if below and size(below) <= size(marked):
        blocks, below = [b for b in blocks if not b[3]], []
    alone = marked or size(below) > size(blocks) - size(below)
    return [b[:2] for b in blocks if b[2] or not (below or marked) or not alone], layouts


_BLOCKS = pa.list_(pa.struct([("path", pa.string()), ("text", pa.string()), ("feature", pa.int64())]))
_LAYOUTS = pa.list_(pa.struct([("path", pa.string()), ("feature", pa.int64())]))
_DDL = ("page_id long, url string, host string, content long, blocks array<struct<path:string,text:string,feature:long>>, "
        "layouts array<struct<path:string,feature:long>>")


def _feature(s: str) -> int:
    return xxhash.xxh64_intdigest(s.encode("utf-8", "surrogatepass")) - (1 << 63)


def _parsed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for at in range(0, whole.num_rows, 256):
            batch = whole.slice(at, 256)
            blocks, layouts, content = [], [], []
            for page in batch.column(3).to_pylist():
                own, shapes = page_blocks(page)
                above: set[str] = set()
                for place in {p for p, _ in own}:
                    steps = place.split(">")
                    above.update(">".join(steps[:k]) for k in range(1, len(steps) + 1))
                blocks.append([{"path": p, "text": t, "feature": _feature(t)} for p, t in own])
                layouts.append([{"path": p, "feature": _feature(s)} for p, s in dict(shapes).items() if p in above])
                content.append(_feature("\n".join(t for _, t in own)))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(content, pa.int64()), pa.array(blocks, _BLOCKS),
                                              pa.array(layouts, _LAYOUTS)],
                                             names=["page_id", "url", "host", "content", "blocks", "layouts"])


def style_tree(parsed: DataFrame, min_pages: int = MIN_PAGES) -> DataFrame:
    """``(host, path, pages, content, presentation)``: the importance of every node of every host's tree.

    Both importances are 1 where fewer than ``min_pages`` distinct pages of
    the host have the node.
    """
    # places and features only: the scan leaves the texts out, and no text is shuffled
    pages = (parsed.select("host", "content", F.col("blocks.path").alias("paths"), F.col("blocks.feature").alias("features"),
                           F.col("layouts.path").alias("nodes"), F.col("layouts.feature").alias("shapes"))
             .dropDuplicates(["host", "content"]))
    pairs = lambda a, b, kind: F.zip_with(a, b, lambda x, y: F.struct(
        x.alias("path"), y.alias("feature"), F.lit(kind).alias("kind")))
    features = F.array_distinct(F.concat(pairs("paths", "features", 0), pairs("nodes", "shapes", 1)))
    seen = (pages.select("host", F.explode(features).alias("f"))
            .select("host", "f.*").groupBy("host", "path", "kind", "feature").agg(F.count(F.lit(1)).alias("k")))
    # pages that have the leaf at all
    having = (pages.select("host", F.explode(F.array_distinct("paths")).alias("path"))
              .groupBy("host", "path").agg(F.count(F.lit(1)).alias("m")))
    k = F.col("k").cast("double")
    nodes = seen.groupBy("host", "path", "kind").agg(F.sum(k * F.log(k)).alias("klogk"), F.sum(k).alias("k"))
    leaf = (nodes.filter("kind = 0").join(having, ["host", "path"])
            .select("host", "path", "m", "klogk", (F.col("k") * F.log(F.col("m").cast("double"))).alias("most")))
    leaf = materialize(leaf, "tree-leaves")
    steps = F.split("path", ">")
    branch = (leaf.withColumn("step", F.explode(F.sequence(F.lit(1), F.size(steps))))
              .withColumn("path", F.array_join(F.slice(steps, F.lit(1), F.col("step")), ">"))
              .groupBy("host", "path").agg(F.max("m").alias("m"), F.sum("klogk").alias("klogk"), F.sum("most").alias("most")))
    # the entropy of k / n over the layouts, against its greatest value log n
    n = F.col("k")
    layout = nodes.filter("kind = 1").select(
        F.col("host").alias("l_host"), F.col("path").alias("l_path"),
        F.when(n > 1, (F.log(n) - F.col("klogk") / n) / F.log(n)).otherwise(F.lit(1.0)).alias("entropy"))
    known = F.col("m") >= min_pages
    return (branch.join(layout, F.col("host").eqNullSafe(F.col("l_host")) & (F.col("path") == F.col("l_path")), "left")
            .select("host", "path", F.col("m").alias("pages"),
                    F.when(known & (F.col("most") > 0), 1 - F.col("klogk") / F.col("most")).otherwise(F.lit(1.0)).alias("content"),
                    F.when(known, F.coalesce("entropy", F.lit(0.0))).otherwise(F.lit(1.0)).alias("presentation")))


def extract_main_text(pages: DataFrame, key: str = "page_id", url: str = "url", page: str = "html",
                      importance: float = IMPORTANCE, min_pages: int = MIN_PAGES) -> DataFrame:
    """``(key, url, text)``: blocks of the article in page order, joined by line feeds, one row per page.

    Character references are decoded and white space inside a block is one
    blank. Null and empty pages, and pages without text, give an empty text.
    Pages without a host form a host of their own. Repeated pages and keys
    are rows of their own. If the tree would take everything from a page,
    the page keeps its blocks. An empty table gives no rows; further columns
    are not read.
    """
    host = F.lower(F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)", 1))
    parsed = materialize(pages.select(F.col(key).cast("long").alias("page_id"), F.col(url).alias("url"), host.alias("host"),
                                      F.col(page).alias("html")).mapInArrow(_parsed, _DDL), "page-blocks")
    low = (style_tree(parsed, min_pages)
           .filter((F.col("content") < importance) & (F.col("presentation") < importance)))
    # a low node is on min_pages pages at least; a host has no more of them than its template has nodes
    noise = materialize(low.groupBy("host").agg(F.collect_set("path").alias("noise")), "tree-noise").withColumnRenamed("host", "n_host")
    kept = F.filter("blocks", lambda b: ~F.exists(
        F.coalesce("noise", F.array().cast("array<string>")),
        lambda p: (b["path"] == p) | F.startswith(b["path"], F.concat(p, F.lit(">")))))
    return (parsed.select("page_id", "url", "host", "blocks").join(noise, F.col("host") == F.col("n_host"), "left")
            .withColumn("kept", kept)
            .select(F.col("page_id").alias(key), F.col("url").alias(url),
                    F.array_join(F.transform(F.when(F.size("kept") > 0, F.col("kept")).otherwise(F.col("blocks")),
                                             lambda b: b["text"]), "\n").alias("text")))


def op4(pages: DataFrame) -> DataFrame:
    return extract_main_text(pages).withColumn("n_chars", F.length("text").cast("long"))

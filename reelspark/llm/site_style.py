"""HTML main text by site style trees.

The DOMs of all pages of a host are merged by style: a node of the tree is the path of tags and first classes from the
root. For each node the tree knows how many pages have it, how its child sequences (presentation) vary over the pages,
and on how many pages each of its text blocks (content) stands. The importance of a node that holds text is

    (1 - GAMMA) * entropy of its parent's presentation + GAMMA * (1 - mean entropy of its contents over pages),

a content on n of m pages having the entropy log n / log m, and the mean being over pages. What stands on every page has
importance 0, what is written for one page 1. The importance of a branch of a page is the mean of its blocks'. Pages with
the same blocks count once, so copies don't vote for their own removal.

Markup is the prior. Elements that are no content by themselves (script, nav, form, aside, ...) go. An article or main
element is kept whole but for containers in it that are clearly named (ads, comments, ...); with any other telling name
it takes the tree, or links, to remove a branch of it. Where a page marks no article, what is clearly named goes, and all
else stays or goes by its importance. The tree is an aggregation over keys (host, node, content), so no host is gathered
in one task; what is joined back is one row for each host, with the nodes that a fixed share of its pages has."""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import materialize

GAMMA = 0.9
LEAST_IMPORTANCE = 0.8
#: A node says something about its pages if it has so many, and this share of those of its host.
LEAST_PAGES, LEAST_SHARE = 8, 0.01
#: A text that stands on this share of a node's pages is removed by itself, if the node has enough pages to tell.
COMMON_SHARE, COMMON_PAGES = 0.5, 20

_NAME = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
_STOP = re.compile(r"[>\"']")
_NAMED = re.compile(r"""\b(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
_HIDDEN = re.compile(r"""(?:^|\s)hidden(?:\s|=|/|$)|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.I)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes template svg math".split())
_NOISE = frozenset(
    "head script style noscript template nav footer aside form button select option input textarea iframe object embed canvas svg math dialog menu "
    "noembed noframes title datalist map audio video".split()
)
_BLOCK = frozenset(
    "address article aside blockquote body br center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head "
    "header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead title tr ul".split()
)
_CLOSES_P = _BLOCK - {"br", "body", "html", "head", "option", "optgroup", "title", "legend", "summary"}
_ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_SCOPE = frozenset("html body article section main div td th table ul ol dl blockquote aside nav footer header form button figure".split())
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+")
#: Parts of such names that tell enough on their own.
_STEMS = re.compile(r"sidebar|advert|comments?$|comments?[_-]|footer|navbar|breadcrumb|newsletter|subscribe|sponsor|cookie|disqus|popup", re.I)
_TITLED = frozenset("post entry article content story title".split())
#: Words of class, id or role names that declare a container to be no content, and those that only suggest it.
_STRONG = frozenset(
    "ad ads adv advert adverts advertisement advertisements advertising adsense banner banners sponsor sponsored sponsors promo promos promoted "
    "nav navbar navigation navi menu menus breadcrumb breadcrumbs sidebar sidebars footer footers footnav masthead topbar cookie cookies consent gdpr "
    "newsletter subscribe subscription signup login share sharing social comment comments commentlist disqus popup modal widget widgets pagination pager "
    "contentinfo taboola outbrain".split()
)
_WEAK = frozenset(
    "promotion aside toolbar notice notices alert reply replies respond discussion related recommended recommendations overlay dialog copyright legal "
    "search searchbox form complementary skip".split()
)
_NOISE_PARTS = {("side", "bar"), ("site", "header"), ("page", "header"), ("top", "bar"), ("nav", "bar"), ("sign", "up"), ("read", "more"), ("site", "footer")}
#: Elements whose names say little about them: they hold text, not parts of a page.
_TEXTUAL = frozenset("p h1 h2 h3 h4 h5 h6 span b i em strong a li dt dd td th tr tbody thead table blockquote pre code figure figcaption caption small mark q cite abbr time sup sub u s br img".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: What is known of a block: it lies in an article; is a heading; is mostly links; lies in a branch with a telling name
#: (numbered by ``branch``); in one with a clear name.
MAIN, HEADING, LINKS, WEAK, STRONG = 1, 2, 4, 8, 16


@dataclass
class Page:
    """The text blocks of a page in order: their texts with white space settled, hashes of their nodes and the parents of
    these, flags and branches; and for each node the child sequences that it has on this page."""

    texts: list[str] = field(default_factory=list)
    nodes: list[int] = field(default_factory=list)
    parents: list[int] = field(default_factory=list)
    flags: list[int] = field(default_factory=list)
    branches: list[int] = field(default_factory=list)
    styles: dict[int, Counter] = field(default_factory=dict)


def _hash(x: str) -> int:
    return xxhash.xxh64_intdigest(x) - (1 << 63)


def _declared(tag: str, attributes: str, inside_main: bool) -> int:
    """STRONG (not read at all), WEAK or 0 by an element's tag and names; STRONG | WEAK: removed, but only by its name."""
    if tag in _NOISE or (tag == "header" and not inside_main):
        return STRONG
    if not attributes:
        return 0
    if _HIDDEN.search(attributes):
        return STRONG
    if tag in ("html", "body", "main"):
        return 0
    for _, value in _NAMED.findall(attributes):
        words = [w.lower() for w in _WORD.findall(value)]
        if not inside_main and tag != "article" and not {"header", "masthead"}.isdisjoint(words) and _TITLED.isdisjoint(words):
            return STRONG
        if tag == "article" and "comment" not in words and "comments" not in words:
            continue
        if _STEMS.search(value.strip("\"' ")) or not _STRONG.isdisjoint(words) or any(p in _NOISE_PARTS for p in zip(words, words[1:])):
            return WEAK if tag in _TEXTUAL and inside_main else STRONG
        if not _WEAK.isdisjoint(words):
            return WEAK
    return 0


class _Ends:
    """Where tags end: at the first > that isn't quoted. What was passed once isn't passed again, so that a page of
    unclosed quotes is read in linear time."""

    def __init__(self, page: str):
        self.page, self.known, self.none = page, {}, len(page) + 1  # no > from ``none`` on

    def plain(self, at: int) -> int:
        if at >= self.none:
            return -1
        end = self.page.find(">", at)
        if end < 0:
            self.none = at
        return end

    def of(self, at: int) -> int:
        page, end = self.page, self.plain(at)
        if end < 0 or (page.find('"', at, end) < 0 and page.find("'", at, end) < 0):
            return end
        passed = []
        while True:
            m = _STOP.search(page, at)
            if m is None:
                end = -1
                break
            if m.group() == ">":
                end = m.start()
                break
            if (found := self.known.get(m.start())) is not None:
                end = found
                break
            passed.append(m.start())
            closing = page.find(m.group(), m.end())
            if closing < 0:
                end = -1
                break
            at = closing + 1
        self.known.update(dict.fromkeys(passed, end))
        return end


def read_page(page: str | None) -> Page:
    """Reads a page. Elements are followed to any depth, each step at a cost that doesn't grow with it."""
    page = page or ""
    out = Page()
    # an open element: tag, place of the block element that holds its text, not read, flags, hash of its parent's hash and
    # its name, tags of its children, branch
    stack: list[tuple[str, int, bool, int, int, list[str], int]] = [("", 0, False, 0, 0, [], 0)]
    places: dict[str, list[int]] = {}  # of the open elements by tag
    scopes = [0]  # places of those that bound what an end tag can reach
    text: list[str] = []
    linked = branches = at = 0
    size, ends = len(page), _Ends(page)

    def flush() -> None:
        nonlocal linked
        if text:
            joined = " ".join("".join(text).split())
            if joined:
                up = stack[-1][1]
                top = stack[up]
                out.texts.append(joined)
                out.nodes.append(top[4])
                out.parents.append(stack[max(up - 1, 0)][4])
                out.flags.append(stack[-1][3] | (HEADING if top[0] in _HEADINGS else 0) | (LINKS if linked * 2 >= len(joined) else 0))
                out.branches.append(stack[-1][6])
            text.clear()
        linked = 0

    def leave() -> None:
        top = stack.pop()
        places[top[0]].pop()
        if top[0] in _SCOPE:
            scopes.pop()
        if top[5]:
            out.styles.setdefault(top[4], Counter())[",".join(top[5])] += 1

    def close(tags, least: int) -> None:
        """Leaves the innermost open element of these tags, if its place isn't below ``least``."""
        k = max((places[t][-1] for t in tags if places.get(t)), default=0)
        if k and k >= least:
            while len(stack) > k:
                leave()

    def tell(piece: str) -> None:
        nonlocal linked
        if not stack[-1][2]:
            piece = entities.unescape(piece) if "&" in piece else piece
            text.append(piece)
            if any(x[0] == "a" for x in stack[-3:]):
                linked += len(piece)

    while at < size:
        if page[at] != "<":
            end = page.find("<", at)
            end = size if end < 0 else end
            tell(page[at:end])
            at = end
            continue
        following = page[at + 1 : at + 2]
        if following in ("!", "?") and following:
            if page.startswith("<!--", at):
                end = page.find("-->", at + 4)
                at = size if end < 0 else end + 3
                continue
            end = ends.plain(at)
            if end >= 0:
                at = end + 1
                continue
        m = _NAME.match(page, at)
        end = ends.of(m.end()) if m else -1
        if end < 0:
            tell("<")
            at += 1
            continue
        attributes = page[m.end() : end]
        at = end + 1
        tag = m.group(2).lower()
        if tag in _BLOCK:
            flush()
        if m.group(1):
            close((tag,), 0 if tag in _SCOPE else scopes[-1])
            continue
        if tag in _CLOSES_P:
            close(("p",), scopes[-1])
        if tag in _ENDS:
            close(_ENDS[tag], scopes[-1])
        stack[-1][5].append(tag)
        if tag in _VOID or attributes.endswith("/") and tag in ("svg", "path"):
            continue
        top = stack[-1]
        name = tag
        if attributes:
            for kind, value in _NAMED.findall(attributes):
                if kind.lower() == "class" and (first := value.strip("\"' ").split()[:1]):
                    name = f"{tag}.{first[0]}"
        told = 0 if top[2] else _declared(tag, attributes, bool(top[3] & MAIN))
        noise, flags, branch = top[2] or told == STRONG, top[3], top[6]
        if told == WEAK and not flags & WEAK:
            branches += 1
            flags, branch = flags | WEAK, branches
        if not noise and (tag in ("article", "main") or 'role="main"' in attributes):
            flags |= MAIN
        if tag in _RAW:
            end = _find_end(page, tag, at)
            at = size if end < 0 else end
            if tag in ("title", "noscript", "textarea", "iframe", "script", "style") or noise:
                end = ends.plain(at)
                at = size if end < 0 else end + 1
                continue
        places.setdefault(tag, []).append(len(stack))
        if tag in _SCOPE:
            scopes.append(len(stack))
        stack.append((tag, len(stack) if tag in _BLOCK else top[1], noise, flags, _hash(f"{top[4]}/{name}"), [], branch))
    flush()
    while len(stack) > 1:
        leave()
    return out


def _find_end(page: str, tag: str, at: int) -> int:
    m = re.compile(f"</{tag}", re.I).search(page, at)
    return m.start() if m else -1


def host_of(url):
    rest = F.when(url.contains("://"), F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1))
    return F.coalesce(F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def page_features(page: Page) -> bytes:
    """What a page tells the tree, as rows of node, parent, kind (0: it has the node, 1: a text, 2: a child sequence), hash
    and times. Node 0 stands for the page."""
    found = Counter({(0, 0, 0, 0): 1})
    for node, parent, text in zip(page.nodes, page.parents, page.texts):
        found[node, parent, 0, 0] = found[node, parent, 1, _hash(text)] = 1
    for parent in set(page.parents):
        for kind, times in page.styles.get(parent, {}).items():
            found[parent, 0, 2, _hash(kind)] = times
    return np.array(sorted((*k, n) for k, n in found.items()), dtype=np.int64).tobytes()


def read_pages(pages: DataFrame) -> DataFrame:
    """page_id, url, host, texts, blocks (rows of node, flags and branch) and told (page_features): every page is parsed
    once, and its blocks are carried from then on."""

    def run(batches):
        for batch in batches:
            read = [read_page(x) for x in batch.column("_html").to_pylist()]
            blocks = [np.array([p.nodes, p.flags, p.branches], dtype=np.int64).tobytes() for p in read]
            told = [page_features(p) for p in read]
            arrays = [*(batch.column(c) for c in ("page_id", "url", "host")), pa.array([p.texts for p in read], pa.list_(pa.string())), pa.array(blocks, pa.binary()), pa.array(told, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, ["page_id", "url", "host", "texts", "blocks", "told"])

    made = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), host_of(F.col("url")).alias("host"), F.col("html").alias("_html"))
    return made.mapInArrow(run, "page_id long, url string, host string, texts array<string>, blocks binary, told binary")


def style_tree(read: DataFrame) -> tuple[DataFrame, DataFrame]:
    """host, node, pages, presentation and content (entropies) of each node that holds text, host_pages; and host, node,
    pages, feature of the texts that stand on most of a node's pages.

    Pages of a host that tell the same are one page. They are counted within a batch before they are shuffled, by (host,
    node, kind, feature), so that a hot host is spread over its contents, and then once more by (host, node)."""

    def run(batches):
        for batch in batches:
            seen: Counter = Counter()
            for host, told in zip(batch.column("host").to_pylist(), batch.column("told").to_pylist()):
                for node, parent, kind, feature, n in np.frombuffer(told, dtype=np.int64).reshape(-1, 5).tolist():
                    seen[host, node, parent, kind, feature] += n
            keys = list(zip(*seen)) or [(), (), (), (), ()]
            arrays = [pa.array(keys[0], pa.string()), *(pa.array(k, pa.int64()) for k in keys[1:]), pa.array(seen.values(), pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, ["host", "node", "parent", "kind", "feature", "n"])

    counted = read.select("host", "told").distinct().mapInArrow(run, "host string, node long, parent long, kind long, feature long, n long")
    features = materialize(counted.groupBy("host", "node", "parent", "kind", "feature").agg(F.sum("n").alias("n")), "style-features")
    n_log_n = F.col("n") * F.log("n")
    of = lambda kind, what: F.sum(F.when(F.col("kind") == kind, what))
    nodes = features.groupBy("host", "node", "parent").agg(
        of(0, F.col("n")).alias("pages"), of(1, n_log_n).alias("content_log"), of(1, F.col("n")).alias("contents"), of(2, F.col("n")).alias("styled"), of(2, n_log_n).alias("style_log")
    )
    nodes = materialize(nodes, "style-nodes")
    m = F.col("styled")
    # entropy of shares n/m to the base m, that is (ln m - sum(n ln n) / m) / ln m
    shown = nodes.where("styled is not null").groupBy("host", F.col("node").alias("parent")).agg(F.max(F.when(m > 1, (F.log(m) - F.col("style_log") / m) / F.log(m)).otherwise(1.0)).alias("presentation"))
    hosts = nodes.where("node = 0 and parent = 0 and pages is not null").groupBy("host").agg(F.max("pages").alias("host_pages"))
    leaf = nodes.where("pages is not null and contents is not null").withColumn("content", F.when(F.col("pages") > 1, F.col("content_log") / F.col("contents") / F.log("pages")).otherwise(0.0))
    joined = leaf.join(shown, ["host", "parent"], "left").join(hosts, "host")
    sizes = leaf.where(F.col("pages") >= min(LEAST_PAGES, COMMON_PAGES)).select("host", "node", "parent", "pages")
    often = features.where((F.col("kind") == 1) & (F.col("n") >= COMMON_SHARE * min(LEAST_PAGES, COMMON_PAGES))).join(sizes, ["host", "node", "parent"])
    common = often.where(F.col("n") >= COMMON_SHARE * F.col("pages")).select("host", "node", "pages", "feature")
    # a node has one parent but for chance collisions of hashes
    tree = joined.groupBy("host", "node").agg(F.sum("pages").alias("pages"), F.max("host_pages").alias("host_pages"), F.avg(F.coalesce("presentation", F.lit(1.0))).alias("presentation"), F.max("content").alias("content"))
    return tree, common


def judged(tree: DataFrame, common: DataFrame, least: float = LEAST_IMPORTANCE, least_pages: int = LEAST_PAGES, gamma: float = GAMMA) -> DataFrame:
    """host and what is known of it: nodes with their importance, those of enough pages; and hashes of common texts with
    their nodes. Of a node with few pages only those common texts are known by themselves that stand in an unimportant
    node."""
    importance = (1 - gamma) * F.col("presentation") + gamma * (1 - F.col("content"))
    known = tree.where((F.col("pages") >= least_pages) & (F.col("pages") >= LEAST_SHARE * F.col("host_pages"))).select("host", "node", importance.alias("importance"))
    text = F.col("node").bitwiseXOR(F.col("feature")).alias("text")
    low = known.where(F.col("importance") < least).select("host", "node")
    many = common.where(F.col("pages") >= COMMON_PAGES).select("host", text)
    few = common.where(F.col("pages") < COMMON_PAGES).join(low, ["host", "node"], "left_semi").select("host", text)
    weighed = known.select("host", F.struct("node", "importance").alias("known"), F.lit(None).cast("long").alias("text"))
    texts = many.union(few).select("host", F.lit(None).cast(weighed.schema["known"].dataType).alias("known"), "text")
    return weighed.union(texts).groupBy("host").agg(F.collect_list("known").alias("known"), F.collect_set("text").alias("texts"))


def kept_blocks(texts: list[str], nodes: list[int], flags: list[int], branches: list[int], importance: dict | None = None, common=frozenset(), least: float = LEAST_IMPORTANCE) -> list[int]:
    """Places of the blocks of a page that are kept."""
    importance = importance or {}
    marked = [i for i, f in enumerate(flags) if f & MAIN]
    low = set()  # branches with a telling name that the tree, or links, agree to
    for branch in {b for b in branches if b}:
        own = [i for i, b in enumerate(branches) if b == branch]
        known = [importance[nodes[i]] for i in own if nodes[i] in importance]
        links = sum(len(texts[i]) for i in own if flags[i] & LINKS) * 2 >= sum(len(texts[i]) for i in own)
        if links or (sum(known) < least * len(known) if known else not marked):
            low.add(branch)
    left = [i for i in marked or range(len(texts)) if branches[i] not in low]
    if marked:
        return left
    left = [i for i in left if not flags[i] & LINKS or flags[i] & HEADING] or left
    rest = [i for i in left if nodes[i] ^ _hash(texts[i]) not in common] if common else left
    return [i for i in rest if importance.get(nodes[i], 1.0) >= least] or rest


def main_text(page: str | None, importance: dict | None = None, common=frozenset()) -> str:
    """The blocks of a page that are kept, in order, joined by one space."""
    p = read_page(page)
    return " ".join(p.texts[i] for i in kept_blocks(p.texts, p.nodes, p.flags, p.branches, importance, common))


def extract(pages: DataFrame, least: float = LEAST_IMPORTANCE, least_pages: int = LEAST_PAGES) -> DataFrame:
    """One row per page: page_id, url, text (empty if none), n_chars.

    A null html is an empty page. Pages without a host share the host ''. Repeated rows get a row each (and count once
    in the tree); a null page_id stays null; other columns are ignored; an empty table gives an empty result. Unclosed
    quotes and tags are text; elements are read to any depth."""
    read = materialize(read_pages(pages), "pages-read")
    known = materialize(judged(*style_tree(read), least, least_pages), "hosts-judged")

    def run(batches):
        for batch in batches:
            out, seen = [], {}
            known, common = batch.column("known"), batch.column("common")
            for i, (host, texts, blocks) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("host", "texts", "blocks")))):
                if host not in seen:
                    seen[host] = {x["node"]: x["importance"] for x in known[i].as_py() or ()}, frozenset(common[i].as_py() or ())
                block = np.frombuffer(blocks, dtype=np.int64).reshape(3, -1).tolist()
                out.append(" ".join(texts[i] for i in kept_blocks(texts, *block, *seen[host], least)))
            arrays = [batch.column("page_id"), batch.column("url"), pa.array(out, pa.string()), pa.array([len(t) for t in out], pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, ["page_id", "url", "text", "n_chars"])

    joined = read.join(known, "host", "left").select("page_id", "url", "host", read["texts"], "blocks", "known", known["texts"].alias("common"))
    return joined.mapInArrow(run, "page_id long, url string, text string, n_chars long")

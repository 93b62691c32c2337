"""Main text of web pages by container paths that the pages of a host agree on."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberlog.llm.common import map_arrow, slices, staged

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"?|'([^']*)'?|([^\s>]+)))?")

# Fixed element classes of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp noframes".split())
BLOCKS = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead tr ul".split())
CLOSES_P = BLOCKS - frozenset("body html td th tr caption tbody thead tfoot li dt dd".split())
SKIPPED = frozenset("script style noscript template iframe object svg canvas audio video nav header footer aside form button select textarea input label menu dialog head title datalist option".split())
CONTAINERS = frozenset("article main section div td body blockquote center p".split())
NOISE_WORDS = frozenset("ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion nav navbar navigation menu breadcrumb breadcrumbs sidebar side rail aside footer foot header masthead topbar toolbar cookie cookies consent gdpr notice notification alert popup modal overlay newsletter subscribe subscription signup login share sharing social comment comments reply replies respond disqus discussion related recommended recommendations more trending popular widget widgets pagination pager skip hidden copyright legal disclaimer".split())
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
#: li and dd close an open one of their own kind, and so do dt, tr, td, th, option.
SELF_CLOSING = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
BARRIER = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("table", "tr"), "th": ("table", "tr"), "option": ("select",), "p": ("article", "section", "div", "td", "th", "li", "body", "blockquote", "main")}
SALTS = 32


def attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(text)}


#: First words of class names that tell what a page has or lacks, not what the element is.
MODIFIERS = frozenset("has have no not with without is are hide show".split())


def is_noise(tag: str, its: dict[str, str]) -> str | None:
    """Whether an element is furniture: "sure" by its tag, role or style, "likely" by a word of its class or id, or as a form."""
    if (tag in SKIPPED and tag != "form") or "hidden" in its or its.get("aria-hidden") == "true" or its.get("role", "").lower() in NOISE_ROLES:
        return "sure"
    if "display:none" in its.get("style", "").replace(" ", "").lower():
        return "sure"
    if tag == "form":
        return "likely"
    if tag in ("article", "main", "body", "html"):
        return None
    for name in f"{its.get('class', '')} {its.get('id', '')}".split():
        words = re.split("[^a-z]+", re.sub("([a-z])([A-Z])", r"\1-\2", name).lower())
        if words[0] not in MODIFIERS and any(w in NOISE_WORDS for w in words):
            return "likely"
    return None


def path_of(above: str, tag: str, its: dict[str, str], most: int = 12) -> str:
    """A generalised path: tags with their first class, numbers as #. Steps before the last `most` become a digest, so deep pages stay small."""
    first = (its.get("class") or "").split()
    path = above + ">" + tag + ("." + re.sub("[0-9]+", "#", first[0].replace(">", "")) if first else "")
    if path.count(">") <= most:
        return path
    digest, step, rest = path.split(">", 2)
    return f"~{zlib.crc32(f'{digest}>{step}'.encode()):08x}>{rest}"


class Node:
    __slots__ = ("tag", "path", "parent", "noise", "likely", "parts")

    def __init__(self, tag: str, path: str, parent, noise: str | None):
        self.tag, self.path, self.parent, self.noise, self.likely = tag, path, parent, noise is not None, noise == "likely"
        self.parts: list = []  # texts and elements in order


def parse(html: str) -> Node:
    """The tree of a page, errors mended: unclosed elements end with their parent, stray end tags are left out."""
    root = now = Node("", "", None, None)
    at, open_tags = 0, Counter()

    def close(holder: Node) -> Node:
        node = now
        while node is not holder.parent:
            open_tags[node.tag] -= 1
            node = node.parent
        return node

    while at < len(html):
        m = TOKEN.search(html, at)
        if m is None:
            now.parts.append(html[at:])
            break
        if m.start() > at:
            now.parts.append(html[at : m.start()])
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            if open_tags[tag] > 0:
                holder = now
                while holder.tag != tag:
                    holder = holder.parent
                now = close(holder)
            continue
        ends = SELF_CLOSING.get(tag, ("p",) if tag in CLOSES_P else ())
        if any(open_tags[e] > 0 for e in ends):
            barrier = BARRIER.get(tag, BARRIER["p"])
            holder = now
            while holder is not root and holder.tag not in ends and holder.tag not in barrier:
                holder = holder.parent
            if holder.tag in ends:
                now = close(holder)
        its = attributes(m[3]) if m[3].strip() else {}
        node = Node(tag, path_of(now.path, tag, its) if tag in BLOCKS else now.path, now, is_noise(tag, its))
        now.parts.append(node)
        if tag in VOID or m[3].endswith("/") and tag not in BLOCKS:
            continue
        if tag in RAW:
            end = re.compile(f"</{re.escape(tag)}\\b[^>]*>", re.I).search(html, at)
            node.parts.append(html[at : end.start() if end else len(html)])
            at = end.end() if end else len(html)
            continue
        open_tags[tag] += 1
        now = node
    settle(root)
    return root


def settle(root: Node) -> None:
    """Takes back what is only likely furniture where it holds the page's main part.

    That is an element around `main`; one with half of the text and the only articles; and one with half of the text
    on a page that has next to none elsewhere.
    """
    nodes, todo, some = [], [root], False
    while todo:
        node = todo.pop()
        if not node.noise or node.likely:
            nodes.append(node)
            some = some or node.likely
            todo += [p for p in node.parts if isinstance(p, Node)]
    if not some:
        return
    text: dict[int, int] = {}
    tags: dict[int, tuple[int, int]] = {}
    rest, articles = 0, 0
    inside: dict[int, bool] = {}
    for node in nodes:  # parents first
        inside[id(node)] = node.likely or (node.parent is not None and inside.get(id(node.parent), False))
        articles += node.tag == "article" and not inside[id(node)]
    for node in reversed(nodes):
        own = sum(len(p.strip()) for p in node.parts if isinstance(p, str))
        rest += 0 if inside[id(node)] else own
        below = [p for p in node.parts if isinstance(p, Node) and id(p) in text]
        text[id(node)] = own + sum(text[id(p)] for p in below)
        tags[id(node)] = ((node.tag == "main") + sum(tags[id(p)][0] for p in below), (node.tag == "article") + sum(tags[id(p)][1] for p in below))
    whole = text[id(root)]
    for node in nodes:
        if node.likely:
            half = 2 * text[id(node)] >= whole > 0
            mains, own_articles = tags[id(node)]
            node.noise = not (mains or half and (own_articles and not articles or 20 * rest < whole))




def blocks(node: Node) -> list[str]:
    """Texts of the blocks below a node, furniture left out, references decoded, white space as one blank."""
    out: list[str] = []
    line: list[str] = []

    def flush() -> None:
        text = " ".join(unescape("".join(line)).split())
        if text:
            out.append(text)
        line.clear()

    todo: list = [*reversed(node.parts)]
    while todo:  # a stack of its own, as pages nest deeply
        part = todo.pop()
        if part is None:
            flush()
        elif isinstance(part, str):
            line.append(part)
        elif part.tag == "br":
            line.append(" ")
        elif not part.noise:
            if part.tag in BLOCKS:
                flush()
                todo.append(None)
            todo += reversed(part.parts)
        elif part.tag in BLOCKS:
            flush()
    flush()
    return out


def walk(root: Node) -> Iterator[Node]:
    todo = [root]
    while todo:
        node = todo.pop()
        yield node
        todo += [p for p in reversed(node.parts) if isinstance(p, Node) and not p.noise]


def scores(root: Node) -> dict[str, float]:
    """Score of every container path of a page: its own text, half of what its child blocks hold, links taken off."""
    own: dict[int, float] = {}
    nodes = [n for n in walk(root)]
    for node in reversed(nodes):
        total = 0.0
        for part in node.parts:
            if isinstance(part, str):
                total += len(part.strip())
            elif not part.noise:
                total += own.get(id(part), 0.0) * (-0.5 if part.tag == "a" else 1.0)
        own[id(node)] = total
    found: dict[str, float] = {}
    for node in nodes:
        if node.tag in CONTAINERS and node.tag != "p" and own[id(node)] > 0:
            direct = sum(own[id(p)] for p in node.parts if isinstance(p, Node) and not p.noise and p.tag in ("p", "h1", "h2", "h3", "h4", "h5", "h6", "ul", "ol", "table", "pre", "blockquote", "figure") and own[id(p)] > 0)
            text = sum(len(p.strip()) for p in node.parts if isinstance(p, str))
            weight = 1.5 if node.tag in ("article", "main") else 1.0
            found[node.path] = found.get(node.path, 0.0) + weight * (direct + text + 0.1 * max(0.0, own[id(node)] - direct - text))
    return found


def extract(root: Node, path: str | None) -> str:
    """The blocks below the outermost elements on `path`; of the best path of the page itself if it has none there."""
    for wanted in (path, None):
        if wanted is None:
            own = scores(root)
            wanted = max(own, key=lambda p: (own[p], p), default=None)
        if wanted is None:
            return "\n\n".join(blocks(root))
        text = [b for n in outermost(root, wanted) for b in blocks(n)]
        if text:
            return "\n\n".join(text)
    return ""


def outermost(root: Node, path: str) -> Iterator[Node]:
    todo = [root]
    while todo:
        node = todo.pop()
        if node.path == path and node.tag in BLOCKS:
            yield node
        else:
            todo += [p for p in reversed(node.parts) if isinstance(p, Node) and not p.noise]


def path_scores(pages: DataFrame) -> DataFrame:
    """(host, path, score, pages): tasks add up on their own first."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total: dict[tuple[str, str], list[float]] = {}
            for rows in slices(batch, "html"):
                for host, html in zip(rows["host"], rows["html"]):
                    found = scores(parse(html or ""))
                    best = max(found.values(), default=0.0)
                    for path, value in found.items():
                        entry = total.setdefault((host, path), [0.0, 0])
                        entry[0] += value / best if best else 0.0
                        entry[1] += 1
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in total], pa.string()), pa.array([k[1] for k in total], pa.string()), pa.array([v[0] for v in total.values()], pa.float64()), pa.array([v[1] for v in total.values()], pa.int64())], ["host", "path", "score", "pages"])

    return map_arrow(pages.select("host", "html"), score, "host string, path string, score double, pages long").groupBy("host", "path").agg(F.sum("score").alias("score"), F.sum("pages").alias("pages"))


def winning_paths(pages: DataFrame) -> DataFrame:
    """(host, path): the path with the most votes of a host's pages; each page splits its vote by score, its best path gets 1."""
    best = F.max(F.struct(F.round("score", 6).alias("score"), "path"))
    return path_scores(pages).groupBy("host").agg(best.alias("best")).select("host", F.col("best.path").alias("path"))


def main_text(pages: DataFrame, id: str = "page_id", url: str = "url", html: str = "html", salts: int = SALTS) -> DataFrame:
    """One row per page: id, url, text, n_chars.

    Containers of every page are scored, hosts vote on generalised paths (tags with their first class,
    numbers as #) by adding the scores up, and pages are extracted again by their host's path; a page
    without that path takes its own best one, one without containers the whole body. The winners, a row
    per host, are repeated per salt and a page takes one, so a host with a third of all pages is spread.
    A null or empty html gives an empty text; pages without a host vote together; repeated rows get a
    result each; null ids stay; an empty table gives no rows; other columns are ignored; nothing is cut.
    """
    host = F.lower(F.regexp_replace(F.regexp_extract(F.coalesce(F.col("url"), F.lit("")), "^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//([^/?#]*)", 1), "^.*@|:[0-9]*$", ""))
    base = pages.select(pages[id].alias("id"), pages[url].alias("url"), pages[html].alias("html")).withColumn("host", host)
    winners = staged(winning_paths(base), "paths").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    joined = base.withColumn("salt", F.pmod(F.xxhash64("id", "url"), F.lit(salts)).cast("int")).join(winners, ["host", "salt"], "left").select("id", "url", "html", "path")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch, "html"):
                texts = [extract(parse(h), p) if h else "" for h, p in zip(rows["html"], rows["path"])]
                yield pa.RecordBatch.from_arrays([pa.array(rows["id"], batch.schema.field("id").type), pa.array(rows["url"], pa.string()), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())], [id, url, "text", "n_chars"])

    kind = pages.schema[id].dataType.simpleString()
    return map_arrow(joined, read, f"`{id}` {kind}, `{url}` string, text string, n_chars long")

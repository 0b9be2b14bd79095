"""Main text of web pages by wrapper induction.

Pages of one host come from one template. Every page is reduced to its skeleton: the
tree of block elements, runs of like siblings folded to one node, each with a digest of
its text. The most frequent skeleton of a host is the reference; all distinct pages of the
host are aligned with it by simple tree matching, one vote each, so copies do not turn
content into template. A node with the same text on nearly all of them is template, one
whose text varies is a slot. The article elements are the content, else the smallest node
with all the varying text of all pages; each page's text is read from what is aligned with
it and from its own other article elements, without menus, headers, footers, sidebars,
notices, adverts, forms, comments and the template's own widgets. A widget goes only from
pages that have the template's text in it, and only if most of the content varies.

Skeletons and votes are small rows: votes are summed in the task, then by host and node,
and what a host's pages are read with is one row, joined to the pages by host.

Defined cases: null html has an empty text; a null URL, or one without host, belongs to
the host ``''``; a page that cannot be aligned, and a host of one page or of equal pages,
is read by its elements alone; articles below an article, and those named as comments, are
readers' comments; repeated rows stay; a page of any length is read whole; an empty table
gives an empty result; extra columns are ignored unless kept.
"""

from __future__ import annotations

import html as entities
import json
import re
import zlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcella.llm.url_rules import host_of
from parcella.sources.staging import staged

#: Share of a host's pages on which a template node has the same text, and fewest pages.
CONSTANT, FEWEST_PAGES = 0.9, 3
#: Elements nested deeper than this become children of the element at this depth.
DEEPEST = 150

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<[!?][^>]*>", re.S
)
NAMES = re.compile(r"\b(?:class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)

# Elements by their part in HTML.
RAW = frozenset({"script", "style", "noscript", "template", "iframe", "svg", "title"})
VOID = frozenset(
    {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
)
INLINE = frozenset(
    {
        "a", "abbr", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i",
        "ins", "kbd", "label", "mark", "q", "s", "samp", "small", "span", "strike", "strong", "sub",
        "sup", "time", "tt", "u", "var", "wbr", "img",
    }
)
PROSE = frozenset(
    {"p", "h1", "h2", "h3", "h4", "h5", "h6", "blockquote", "pre", "figure", "figcaption", "table", "dl"}
)
ASIDES = frozenset(
    {"nav", "footer", "aside", "form", "button", "select", "input", "textarea", "dialog", "menu", "head"}
)
CLOSED_BY = {
    "li": frozenset({"li"}),
    "dt": frozenset({"dt", "dd"}),
    "dd": frozenset({"dt", "dd"}),
    "tr": frozenset({"tr", "td", "th"}),
    "td": frozenset({"td", "th"}),
    "th": frozenset({"td", "th"}),
    "option": frozenset({"option"}),
}
LISTS = frozenset({"ul", "ol", "dl", "table", "select", "tbody", "thead"})
# Words in class, id or role that tell page furniture.
FURNITURE = frozenset(
    {
        "ad", "ads", "advert", "adverts", "advertisement", "banner", "breadcrumb", "breadcrumbs",
        "comment", "comments", "contentinfo", "complementary", "consent", "cookie", "cookies",
        "disqus", "footer", "gdpr", "masthead", "menu", "modal", "nav", "navbar", "navigation",
        "newsletter", "notice", "notification", "pagination", "popup", "promo", "promotion",
        "related", "replies", "respond", "search", "share", "sharing", "sidebar", "signup", "social",
        "sponsor", "sponsored", "subscribe", "toolbar", "widget",
    }
)
#: Names of an article element that is a reader's comment.
COMMENTS = frozenset({"comment", "comments", "reply", "replies", "respond", "disqus"})
MAIN_NAMES = frozenset({"articlebody", "main"})


class Node:
    __slots__ = ("tag", "names", "kids", "depth")

    def __init__(self, tag: str, names: tuple[str, ...], depth: int):
        self.tag, self.names, self.kids, self.depth = tag, names, [], depth


def parse(page: str) -> Node:
    """Element tree of a page: kids are nodes and decoded text; comments and raw elements go."""
    root = Node("#page", (), 0)
    stack, at = [root], 0
    while True:
        token = TOKEN.search(page, at)
        end = token.start() if token else len(page)
        if end > at:
            text = page[at:end]
            stack[-1].kids.append(entities.unescape(text) if "&" in text else text)
        if token is None:
            return root
        at = token.end()
        close, tag, attributes = token.groups()
        if not tag:
            continue
        tag = tag.lower()
        if close:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == tag:
                    del stack[k:]
                    break
            continue
        if tag in RAW:
            skip = re.compile(rf"</{re.escape(tag)}\b[^>]*>|\Z", re.I)
            if not attributes.endswith("/"):
                at = skip.search(page, at).end()
            continue
        if tag in CLOSED_BY:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag in CLOSED_BY[tag]:
                    del stack[k:]
                if k < len(stack) and stack[k].tag in LISTS:
                    break
        elif tag not in INLINE and tag != "br":  # a block ends an open paragraph
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == "p":
                    del stack[k:]
                    break
                if stack[k].tag not in INLINE:
                    break
        names = ()
        if "=" in attributes:
            names = tuple(
                w for m in NAMES.finditer(attributes) for w in re.split(r"[^a-z0-9]+", (m[1] or m[2] or m[3] or "").lower()) if w
            )
        node = Node(tag, names, len(stack))
        stack[-1].kids.append(node)
        if tag not in VOID and not attributes.endswith("/") and len(stack) < DEEPEST:
            stack.append(node)


def furniture(node: Node, inside: bool) -> bool:
    """Menus, adverts and the like by element and names; a header only outside the article."""
    if node.tag in ASIDES or (node.tag == "header" and not inside):
        return True
    if node.tag == "article":
        return any(w in COMMENTS for w in node.names)
    if node.tag in ("main", "body", "html"):
        return False
    return any(w in FURNITURE for w in node.names) or (
        not inside and "header" in node.names and node.tag not in PROSE
    )


def blocks_of(
    node: Node, out: list[list[str]], inside: bool = True, drop=frozenset(),
    within: bool = False, wrapped: bool = False,
) -> None:
    """Append the text of a subtree to ``out``: one list of pieces for each block.

    An article ``within`` an article is a reader's comment, unless articles come ``wrapped``.
    """
    within = within or node.tag == "article"
    for kid in node.kids:
        if isinstance(kid, str):
            out[-1].append(kid)
        elif kid.tag in INLINE:
            if not furniture(kid, inside):
                blocks_of(kid, out, inside, drop, within, wrapped)
        elif id(kid) in drop or furniture(kid, inside) or (within and kid.tag == "article" and not wrapped):
            out.append([])
        else:
            out.append([])
            blocks_of(kid, out, inside, drop, within, wrapped)
            out.append([])


def text_of(nodes: list[Node], inside: bool = True, drop=frozenset()) -> str:
    """Blocks in page order, white space folded, joined by one space.

    Articles that hold nothing but articles are wrappers of these.
    """
    text = ""
    for wrapped in (False, True):
        out: list[list[str]] = [[]]
        for node in nodes:
            blocks_of(node, out, inside, drop, wrapped=wrapped)
            out.append([])
        text = text or " ".join(w for block in out for w in "".join(block).split())
        if text:
            break
    return text


def own_text(node: Node, links: bool = False) -> str:
    """Text of a subtree as it stands, or just that of its links."""
    parts = []

    def visit(n: Node, inside: bool):
        inside = inside or not links or n.tag == "a"
        for kid in n.kids:
            if isinstance(kid, str):
                if inside:
                    parts.append(kid)
            else:
                visit(kid, inside)

    visit(node, False)
    return " ".join("".join(parts).split())


class Skeleton:
    """Folded block tree: parallel lists over nodes in page order; node 0 is the page."""

    def __init__(self):
        self.labels, self.digests, self.kids, self.members, self.chars = [], [], [], [], []

    @staticmethod
    def of(root: Node) -> Skeleton:
        out = Skeleton()
        out.add([root])
        return out

    def add(self, nodes: list[Node]) -> int:
        """Fold ``nodes`` (like siblings) into one node."""
        first, at = nodes[0], len(self.labels)
        label = " ".join([first.tag, *(w for w in first.names if not w.isdigit())])
        self.labels.append(label)
        self.members.append(nodes)
        self.kids.append([])
        self.digests.append(0)
        self.chars.append(0)
        runs: list[list[Node]] = []
        crc, chars = 0, 0
        for node in nodes:
            for kid in node.kids:
                if isinstance(kid, str):
                    words = " ".join(kid.split())
                    crc, chars = zlib.crc32(words.encode("utf-8", "surrogatepass"), crc), chars + len(words)
                elif kid.tag in INLINE:
                    words = own_text(kid)
                    crc, chars = zlib.crc32(words.encode("utf-8", "surrogatepass"), crc), chars + len(words)
                elif kid.tag in VOID:
                    continue
                elif runs and (runs[-1][0].tag, runs[-1][0].names) == (kid.tag, kid.names):
                    runs[-1].append(kid)
                else:
                    runs.append([kid])
        for run in runs:
            k = self.add(run)
            self.kids[at].append(k)
            crc, chars = zlib.crc32(b"%d" % self.digests[k], crc), chars + self.chars[k]
        self.digests[at], self.chars[at] = crc, chars
        return at

    def packed(self) -> str:
        return json.dumps([self.labels, self.digests, self.kids, self.chars], separators=(",", ":"))

    def form(self) -> int:
        """Digest of the tree alone, without its texts."""
        return zlib.crc32(json.dumps([self.labels, self.kids]).encode("utf-8", "surrogatepass"))

    @staticmethod
    def unpacked(text: str) -> Skeleton:
        out = Skeleton()
        out.labels, out.digests, out.kids, out.chars = json.loads(text)
        return out


def align(a: Skeleton, b: Skeleton, i: int = 0, j: int = 0) -> tuple[int, list[tuple[int, int]]]:
    """Simple tree matching: most nodes matched, order and parents kept."""
    if a.labels[i] != b.labels[j]:
        return 0, []
    left, right = a.kids[i], b.kids[j]
    if [a.labels[k] for k in left] == [b.labels[k] for k in right]:  # like children pair off
        total, pairs = 1, [(i, j)]
        for x, y in zip(left, right):
            n, more = align(a, b, x, y)
            total, pairs = total + n, pairs + more
        return total, pairs
    best = [[0] * (len(right) + 1)]
    found: dict = {}
    for p, x in enumerate(left, 1):
        row = [0]
        for q, y in enumerate(right, 1):
            w = found[p, q] = align(a, b, x, y)
            row.append(max(best[p - 1][q], row[q - 1], best[p - 1][q - 1] + w[0]))
        best.append(row)
    pairs, p, q = [], len(left), len(right)
    while p and q:
        if best[p][q] == best[p - 1][q]:
            p -= 1
        elif best[p][q] == best[p][q - 1]:
            q -= 1
        else:
            pairs += found[p, q][1]
            p, q = p - 1, q - 1
    return best[-1][-1] + 1, [(i, j), *pairs]


class Wrapper:
    """What a host's pages are read with: the reference and the parts its votes give the nodes."""

    def __init__(self, reference: Skeleton, votes: dict[int, tuple[int, int, int]]):
        self.reference = reference
        pages = votes[0][0] if 0 in votes else 0
        self.constant = {
            k for k, (_, same, _) in votes.items() if pages >= FEWEST_PAGES and same >= CONSTANT * pages
        }
        self.chars = {k: chars for k, (_, _, chars) in votes.items()}
        self.content: set[int] = set()
        self.choose(0)
        self.named = bool(self.content)
        if not self.named:
            k = self.deepest(0)
            if k:
                self.content = {k}
        dropped = {k for c in self.content for k in self.below(c) if self.droppable(k)}
        inside = {x for k in dropped for x in self.below(k)}
        held = {x for c in self.content for x in self.below(c)}
        chars = [sum(self.chars.get(x, 0) for x in part) for part in (inside, held)]
        self.dropped = dropped if 2 * chars[0] < chars[1] else set()

    def is_furniture(self, k: int) -> bool:
        tag, *names = self.reference.labels[k].split(" ")
        return furniture(Node(tag, tuple(names), 0), False)

    def choose(self, k: int) -> None:
        """Article elements first; the main element where it holds none."""
        for kid in self.reference.kids[k]:
            if self.is_furniture(kid):
                continue
            self.choose(kid)
            tag, *names = self.reference.labels[kid].split(" ")
            if tag == "article" or (
                (tag == "main" or MAIN_NAMES & set(names)) and not self.holds(kid)
            ):
                self.content -= self.below(kid)
                self.content.add(kid)

    def below(self, k: int) -> set[int]:
        return {k, *(x for kid in self.reference.kids[k] for x in self.below(kid))}

    def holds(self, k: int) -> bool:
        return bool(self.content & self.below(k))

    def slot_chars(self, k: int) -> int:
        """Characters of a subtree, over all pages, that are neither template nor furniture."""
        if k in self.constant or (k and self.is_furniture(k)):
            return 0
        return self.chars.get(k, 0) + sum(self.slot_chars(x) for x in self.reference.kids[k])

    def deepest(self, k: int) -> int:
        """The smallest node that holds all the varying text."""
        whole = self.slot_chars(k)
        for kid in self.reference.kids[k]:
            if whole and self.slot_chars(kid) == whole and self.reference.labels[kid].split(" ")[0] not in PROSE:
                return self.deepest(kid)
        return k

    def read(self, page: str) -> str:
        root = parse(page)
        own = Skeleton.of(root)
        pairs = align(self.reference, own)[1]
        nodes = [n for i, j in pairs if i in self.content for n in own.members[j]]
        if not nodes or (not self.named and articles_of(root)):
            return read_alone(root)
        if self.named:
            nodes = outermost(root, {id(n) for n in [*nodes, *articles_of(root)]})
        drop = frozenset(
            id(n)
            for i, j in pairs
            if i in self.dropped and own.digests[j] == self.reference.digests[i]
            for n in own.members[j]
        )
        return text_of(nodes, self.named, drop)

    def droppable(self, k: int) -> bool:
        return k in self.constant and k not in self.content and self.widget(k)

    def widget(self, k: int) -> bool:
        """Only named containers count as template inside the content; prose stays."""
        tag, *names = self.reference.labels[k].split(" ")
        return bool(names) and tag not in PROSE and tag not in ("article", "main", "body", "html")


def outermost(root: Node, wanted: set[int]) -> list[Node]:
    """Nodes by identity, in page order, without those inside of others."""
    found, stack = [], [root]
    while stack:
        node = stack.pop()
        if id(node) in wanted:
            found.append(node)
        else:
            stack += [k for k in reversed(node.kids) if isinstance(k, Node)]
    return found


def tally(reference: Skeleton, own: Skeleton):
    """(node, same, chars) of every reference node that a page has: whether its text is the
    same, and the characters that lie in it but not in an aligned node or furniture below."""
    pairs = align(reference, own)[1]
    aligned = {j for _, j in pairs}
    for i, j in pairs:
        chars = own.chars[j]
        for kid in own.kids[j]:
            tag, *names = own.labels[kid].split(" ")
            if kid in aligned or furniture(Node(tag, tuple(names), 0), False):
                chars -= own.chars[kid]
        yield i, reference.digests[i] == own.digests[j], chars


def articles_of(root: Node) -> list[Node]:
    """Article elements of a page, else its main element, outside of furniture."""
    for wanted in (
        lambda n: n.tag == "article",
        lambda n: n.tag == "main" or bool(MAIN_NAMES & set(n.names)),
    ):
        found: list[Node] = []
        stack = [root]
        while stack:
            node = stack.pop()
            if node is not root and wanted(node):
                found.append(node)
            else:
                stack += [
                    k for k in reversed(node.kids) if isinstance(k, Node) and not furniture(k, False)
                ]
        if found:
            return found
    return []


def read_alone(root: Node) -> str:
    """A page read by its elements: its articles, else its main part, else all of it."""
    found = articles_of(root)
    return text_of(found) if found else text_of([root], False)


def extract(
    pages: DataFrame,
    id_col: str = "page_id",
    url: str = "url",
    html: str = "html",
    keep: tuple[str, ...] = ("page_id", "url"),
) -> DataFrame:
    """The ``keep`` columns and ``text`` of every page."""

    def reduced(batches):
        import pyarrow as pa

        for batch in batches:
            shapes = []
            for value in batch.column(2):
                page = value.as_py()
                shapes.append(None if page is None else Skeleton.of(parse(page)))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), batch.column(1),
                    pa.array([x and x.form() for x in shapes], pa.int64()),
                    pa.array([x and x.packed() for x in shapes], pa.string()),
                ],
                names=["host", "page", "form", "shape"],
            )

    def voted(batches):
        import pyarrow as pa

        sums: dict = {}
        last = None
        for batch in batches:
            for host, shape, first in zip(*(c.to_pylist() for c in batch.columns)):
                if last is None or last[0] != first:
                    last = first, Skeleton.unpacked(first)
                for i, equal, chars in tally(last[1], Skeleton.unpacked(shape)):
                    n, same, held = sums.get((host, i), (0, 0, 0))
                    sums[host, i] = n + 1, same + equal, held + chars
        keys = list(sums)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.int32()),
                pa.array([sums[k][0] for k in keys], pa.int64()), pa.array([sums[k][1] for k in keys], pa.int64()),
                pa.array([sums[k][2] for k in keys], pa.int64()),
            ],
            names=["host", "node", "n", "same", "chars"],
        )

    def taken(batches):
        import pyarrow as pa

        made: dict = {}
        for batch in batches:
            texts = []
            for k in range(batch.num_rows):
                page, first = batch.column(1)[k].as_py(), batch.column(2)[k].as_py()
                if page is None:
                    texts.append("")
                    continue
                if first is None:
                    texts.append(read_alone(parse(page)))
                    continue
                key = (first, str(batch.column(3)[k]))
                if key not in made:
                    if len(made) > 256:
                        made.clear()
                    votes = {v["node"]: (v["n"], v["same"], v["chars"]) for v in batch.column(3)[k].as_py() or ()}
                    made[key] = Wrapper(Skeleton.unpacked(first), votes)
                texts.append(made[key].read(page))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(texts, pa.string())], names=["kept", "text"]
            )

    host = F.coalesce(host_of(F.col(f"`{url}`")), F.lit(""))
    shapes = staged(
        pages.select(host.alias("host"), F.col(f"`{id_col}`").cast("string").alias("page"), F.col(f"`{html}`"))
        .mapInArrow(reduced, "host string, page string, form long, shape string")
        .where("shape is not null")
        .groupBy("host", "form", "shape")
        .agg(F.min("page").alias("page")),
        "shapes",
    )
    firsts = (
        shapes.groupBy("host", "form")
        .agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("page", "shape")).alias("first"))
        .groupBy("host")
        .agg(F.min_by("first.shape", F.struct(-F.col("n"), "first")).alias("first"))
    )
    votes = (
        shapes.join(firsts, "host")
        .select("host", "shape", "first")
        .mapInArrow(voted, "host string, node int, n long, same long, chars long")
        .groupBy("host", "node")
        .agg(*(F.sum(c).alias(c) for c in ("n", "same", "chars")))
        .groupBy("host")
        .agg(F.sort_array(F.collect_list(F.struct("node", "n", "same", "chars"))).alias("votes"))
    )
    wrappers = staged(firsts.join(votes, "host"), "wrappers")
    kept = pages.select(
        F.struct(*(F.col(f"`{c}`") for c in keep)).alias("kept"),
        F.col(f"`{html}`").alias("html"),
        host.alias("_host"),
    )
    joined = kept.join(wrappers, F.col("_host") == F.col("host"), "left").select(
        "kept", "html", "first", "votes"
    )
    kind = joined.schema["kept"].dataType.simpleString()
    return joined.mapInArrow(taken, f"kept {kind}, text string").select(
        *(F.col("kept")[c].alias(c) for c in keep), "text"
    )

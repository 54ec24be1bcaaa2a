"""Main text of web pages: gradient-boosted trees over DOM-node features, decoded so that no kept node lies in a
dropped one."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Elements of HTML.
BLOCKS = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 "
                   "h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre search section summary table tbody td tfoot th "
                   "thead tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT = frozenset("iframe script select style svg template textarea title".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
#: What ends the search for an element that a new one closes.
SCOPES = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}, "option": set()}
TAGS = ({"article"}, {"main"}, {"nav", "menu"}, {"footer"}, {"header", "hgroup"}, {"aside"}, {"form", "fieldset", "legend"}, {"section"}, {"div"},
        {"p"}, {"h1", "h2", "h3", "h4", "h5", "h6"}, {"li", "ul", "ol", "dl", "dt", "dd"}, {"table", "tbody", "thead", "tfoot", "tr", "td", "th"},
        {"body", "html"}, {"blockquote", "pre", "figure", "figcaption"}, {"dialog", "details", "summary", "address"})
TAG_GROUP = {tag: i for i, group in enumerate(TAGS) for tag in group}
TOKENS = ({"article", "content", "contents", "entry", "post", "story", "main", "body", "text", "prose"}, {"nav", "navbar", "navigation", "menu", "breadcrumb", "breadcrumbs", "pagination", "pager", "toc", "tabs"},
          {"ad", "ads", "adv", "advert", "advertisement", "adsense", "banner", "promo", "promotion", "sponsor", "sponsored"},
          {"comment", "comments", "reply", "replies", "respond", "disqus", "discussion"}, {"sidebar", "side", "aside", "rail", "widget", "widgets", "complementary"},
          {"footer", "foot", "copyright", "legal", "contentinfo", "colophon", "bottom"}, {"header", "head", "masthead", "top", "topbar", "logo", "branding", "site"},
          {"cookie", "cookies", "notice", "consent", "gdpr", "popup", "modal", "overlay", "alert", "warning", "message"},
          {"form", "login", "signup", "subscribe", "newsletter", "search", "input", "contact"}, {"share", "social", "related", "recommended", "more", "tags", "meta", "author", "byline"})
TOKEN_GROUP = {token: i for i, group in enumerate(TOKENS) for token in group}
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
BASE = 18
WIDTH = BASE + 2 * len(TAGS) + 2 * len(TOKENS)


class Page(HTMLParser):
    """Block elements and runs of text in page order. A run is the text between two block borders."""

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.tags, self.parents, self.groups, self.marks, self.texts, self.linked = ["#root"], [-1], [()], [None], [None], [0]
        self.stack, self.silent, self.inside, self.run, self.link = [0], [], [], -1, False
        self.feed(html.replace("<![", "<!x["))  # a section is a comment in HTML
        self.close()

    def add(self, tag: str, groups: tuple = (), mark: str | None = None, text: list | None = None) -> int:
        self.tags.append(tag), self.parents.append(self.stack[-1]), self.groups.append(groups)
        self.marks.append(mark), self.texts.append(text), self.linked.append(0)
        return len(self.tags) - 1

    def handle_starttag(self, tag, attrs):
        if self.silent:
            if tag == self.silent[-1]:
                self.silent.append(tag)
            elif tag in BLOCKS and self.silent[-1] != "svg":
                self.inside.append(tag)
            if tag not in BLOCKS or self.silent[-1] != "svg":
                return
            self.silent, self.inside = [], []  # blocks end drawings
        if tag in SILENT:
            self.silent.append(tag)
        elif tag == "br":
            self.handle_data(" ")
        elif tag == "a":
            self.link = True
        elif tag in BLOCKS:
            self.run, self.link = -1, False
            if self.tags[self.stack[-1]] == "p":
                self.stack.pop()
            for at in range(len(self.stack) - 1, 0, -1):
                own = self.tags[self.stack[at]]
                if own in SCOPES.get(tag, {own}):
                    break
                if own in CLOSES[tag]:
                    del self.stack[at:]
                    break
            if tag not in VOID:
                groups, mark = set(), None
                for name, value in attrs:
                    if value and name in ("class", "id", "role", "itemprop", "aria-label"):
                        groups.update(g for w in _WORD.findall(value) if (g := TOKEN_GROUP.get(w.lower())) is not None)
                    elif name == "data-label":
                        mark = value
                self.stack.append(self.add(tag, tuple(groups), mark))

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID and (tag in SILENT or tag == "a"):
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if self.silent:
            if tag == self.silent[-1]:
                self.silent.pop()
                self.inside = self.inside if self.silent else []
                return
            if tag in self.inside:
                del self.inside[len(self.inside) - 1 - self.inside[::-1].index(tag):]
                return
            if tag not in BLOCKS or all(self.tags[at] != tag for at in self.stack[1:]):
                return
            self.silent, self.inside = [], []  # an element that was never closed ends with its parent
        if tag == "a":
            self.link = False
        elif tag in BLOCKS:
            for at in range(len(self.stack) - 1, 0, -1):
                if self.tags[self.stack[at]] == tag:
                    del self.stack[at:]
                    self.run, self.link = -1, False
                    break

    def handle_data(self, data):
        if self.silent:
            return
        if self.run < 0:
            if not data.strip():
                return
            self.run = self.add("#text", text=[])
        self.texts[self.run].append(data)
        self.linked[self.run] += len(data) * self.link


@dataclass(frozen=True)
class Nodes:
    """The nodes of a page with their features; text is None for elements."""
    parents: list[int]
    texts: list[str | None]
    features: np.ndarray
    marks: list[str | None]


def bits(masks: list[int], width: int) -> np.ndarray:
    """Rows of 0 and 1 from numbers whose bit k is column k."""
    return (np.array(masks, np.int64)[:, None] >> np.arange(width)) & 1


def nodes_of(html: str) -> Nodes:
    return nodes_of_all([html])[0]


def nodes_of_all(htmls: list[str]) -> list[Nodes]:
    """The nodes of some pages; their features are computed together, level by level."""
    pages = [Page(h) for h in htmls]
    sizes = [len(p.tags) for p in pages]
    begin = np.concatenate([[0], np.cumsum(sizes)])
    n = int(begin[-1])
    local = np.concatenate([np.array(p.parents) for p in pages])
    root = local < 0
    parent = np.where(root, np.arange(n), local + np.repeat(begin[:-1], sizes))
    texts = [[None if t is None else " ".join("".join(t).split()) for t in p.texts] for p in pages]
    every = [t for own in texts for t in own]
    run = np.array([t is not None for t in every])
    length = np.array([0 if t is None else len(t) for t in every], float)
    linked = np.array([x for p in pages for x in p.linked], float)
    sums = np.stack([length, np.minimum(linked, length), run.astype(float), (~run).astype(float),
                     np.array([0 if t is None else sum(map(t.count, ".,;:!?")) for t in every], float),
                     np.array([0 if t is None else t[-1:] in ".!?" for t in every], float),
                     np.array([0 if t is None else sum(map(t.count, "0123456789")) for t in every], float)], 1)
    # what lies above a node, and its place among its siblings, in page order
    depth, order, tag_own, tag_above, token_own, token_above = [], [], [], [], [], []
    for page in pages:
        depths, children, tags, tags_up, tokens, tokens_up = [0], [0] * len(page.tags), [0], [0], [0], [0]
        order.append(0)
        for tag, p, groups in zip(page.tags[1:], page.parents[1:], page.groups[1:]):
            depths.append(depths[p] + 1)
            order.append(children[p])
            children[p] += 1
            tags_up.append(tags_up[p] | tags[p])
            tokens_up.append(tokens_up[p] | tokens[p])
            if tag == "#text":
                tags.append(tags[p]), tokens.append(tokens[p])
            else:
                tags.append(1 << TAG_GROUP[tag] if tag in TAG_GROUP else 0)
                tokens.append(sum(1 << g for g in groups))
        depth += depths
        tag_own += tags
        tag_above += tags_up
        token_own += tokens
        token_above += tokens_up
    depth = np.array(depth)
    longest = length.copy()
    levels = np.argsort(depth, kind="stable")
    for level in reversed(np.split(levels, np.cumsum(np.bincount(depth))[:-1])[1:]):
        np.add.at(sums, parent[level], sums[level])
        np.maximum.at(longest, parent[level], longest[level])
    kinds = {tag: i for i, tag in enumerate(sorted({t for p in pages for t in p.tags}))}
    _, kind, count = np.unique(parent * len(kinds) + np.array([kinds[t] for p in pages for t in p.tags]), return_inverse=True, return_counts=True)
    same = count[kind]
    children = np.bincount(parent[~root], minlength=n)[parent]
    before = np.cumsum(length) - length
    start = before - np.repeat(before[begin[:-1]], sizes)
    total, text, runs = np.repeat(np.maximum(sums[begin[:-1], 0], 1.0), sizes), np.maximum(sums[:, 0], 1.0), np.maximum(sums[:, 2], 1)
    base = np.stack([run, np.log1p(sums[:, 0]), sums[:, 1] / text, np.log1p(sums[:, 2]), np.log1p(sums[:, 0] / (sums[:, 3] + 1)), depth,
                     np.log1p(np.array(order)), np.log1p(children), sums[:, 0] / total, start / total, np.log1p(sums[:, 0] / runs),
                     sums[:, 4] / text, sums[:, 5] / runs, sums[:, 6] / text, sums[:, 0] / text[parent],
                     same / np.maximum(children, 1), np.log1p(longest), np.log1p(sums[parent, 0])], 1)
    features = np.hstack([base, bits(tag_own, len(TAGS)), bits(tag_above, len(TAGS)), bits(token_own, len(TOKENS)), bits(token_above, len(TOKENS))]).astype(np.float32)
    return [Nodes(p.parents, own, features[a:b], p.marks) for p, own, a, b in zip(pages, texts, begin[:-1], begin[1:])]


@dataclass(frozen=True)
class Trees:
    """Boosted trees of one depth, each level by level: feature, threshold; and leaf values."""
    features: np.ndarray
    thresholds: np.ndarray
    leaves: np.ndarray
    start: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        out, rows = np.full(len(x), self.start), np.arange(len(x))
        depth = self.leaves.shape[1].bit_length() - 1
        for f, t, leaf in zip(self.features, self.thresholds, self.leaves):
            at = np.zeros(len(x), np.int64)
            for _ in range(depth):
                at = 2 * at + 1 + (x[rows, f[at]] > t[at])
            out += leaf[at - len(f)]
        return out


def boost(x: np.ndarray, y: np.ndarray, weight: np.ndarray, rounds: int = 100, depth: int = 4, rate: float = 0.25, bins: int = 32, ridge: float = 1.0,
          columns: float = 0.3) -> Trees:
    """Logistic boosting with second-order gains over binned features; each tree sees a share of the columns, so that no
    single cue decides alone."""
    rng = np.random.default_rng(17)
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(x.shape[1])]
    binned = np.stack([np.searchsorted(e, x[:, j], "left") for j, e in enumerate(edges)], 1)
    share = float(np.clip(np.average(y, weights=weight), 1e-3, 1 - 1e-3))
    start = float(np.log(share / (1 - share)))
    margin = np.full(len(x), start)
    inner = (1 << depth) - 1
    all_f, all_t, all_l = [], [], []
    usable = [j for j, e in enumerate(edges) if len(e)]
    for _ in range(rounds):
        chosen = rng.permutation(usable)[:max(1, round(columns * len(usable)))]
        p = 1 / (1 + np.exp(-margin))
        g, h = weight * (y - p), weight * p * (1 - p)
        feature, threshold, at = np.zeros(inner, np.int64), np.full(inner, np.inf, np.float32), np.zeros(len(x), np.int64)
        for level in range(depth):
            first, count = (1 << level) - 1, 1 << level
            place = at - first
            gain, pick = np.zeros(count), [(0, np.inf)] * count
            sum_g, sum_h = (np.bincount(place, v, count) for v in (g, h))
            before = sum_g**2 / (sum_h + ridge)
            for j in chosen:
                cuts = edges[j]
                width = len(cuts) + 1
                key = place * width + binned[:, j]
                left_g = np.bincount(key, g, count * width).reshape(count, width).cumsum(1)[:, :-1]
                left_h = np.bincount(key, h, count * width).reshape(count, width).cumsum(1)[:, :-1]
                right_g, right_h = sum_g[:, None] - left_g, sum_h[:, None] - left_h
                gains = left_g**2 / (left_h + ridge) + right_g**2 / (right_h + ridge) - before[:, None]
                gains[(left_h < 1) | (right_h < 1)] = 0
                best = gains.argmax(1)
                for k in range(count):
                    if gains[k, best[k]] > gain[k] + 1e-9:
                        gain[k], pick[k] = gains[k, best[k]], (j, cuts[best[k]])
            for k, (j, cut) in enumerate(pick):
                feature[first + k], threshold[first + k] = j, cut
            at = 2 * at + 1 + (x[np.arange(len(x)), feature[at]] > threshold[at])
        leaf = at - inner
        value = rate * np.bincount(leaf, g, inner + 1) / (np.bincount(leaf, h, inner + 1) + ridge)
        margin += value[leaf]
        all_f.append(feature), all_t.append(threshold), all_l.append(value)
    return Trees(np.array(all_f), np.array(all_t, np.float32), np.array(all_l), start)


def labels_of(nodes: Nodes) -> np.ndarray:
    """1 for text whose nearest marked ancestor is marked "keep", and for elements around such text."""
    inside = [False] * len(nodes.parents)
    for i in range(1, len(inside)):
        inside[i] = inside[nodes.parents[i]] if nodes.marks[i] is None else nodes.marks[i] == "keep"
    y = np.zeros(len(inside))
    for i in range(len(inside) - 1, 0, -1):
        if nodes.texts[i] is not None and inside[i]:
            y[i] = 1
        if y[i]:
            y[nodes.parents[i]] = 1
    return y


def decode(parents: list[int], logit: np.ndarray) -> np.ndarray:
    """The likeliest labelling in which a node is kept only if its parent is: best of both labels, from the leaves up.

    Dropping a node drops its whole subtree; keeping it leaves each child its better choice.
    """
    drop = -np.logaddexp(0, logit)  # log of the probability to be dropped, alone
    keep = drop + logit
    drop, keep = drop.tolist(), keep.tolist()
    for i in range(len(parents) - 1, 0, -1):
        keep[parents[i]] += max(keep[i], drop[i])
        drop[parents[i]] += drop[i]
    kept = np.zeros(len(parents), bool)
    kept[0] = True  # the root holds nothing itself
    for i in range(1, len(parents)):
        kept[i] = kept[parents[i]] and keep[i] > drop[i]
    return kept


_MAIN = re.compile(r"<(article|main)\b[^>]*>(.*)</\1\s*>", re.S | re.I)
_PARTS = re.compile(r"<(nav|footer|aside|header|form)\b[^>]*>(.*?)</\1\s*>", re.S | re.I)
_PARAGRAPH = re.compile(r"<p>([^<]{20,600})</p>")
_RIGHT = ('article', 'main', 'div class="content"', 'div class="post-body"', 'div id="main-text"', 'div role="main"', 'section class="story"', 'div', 'section')
_WRONG = {"nav": ("nav", 'div class="menu"', 'div id="navigation"', 'ul class="nav"', "div", "ul"), "footer": ("footer", 'div id="footer"', 'div class="copyright"', "div"),
          "aside": ("aside", 'div class="sidebar"', 'div id="side-rail"', 'div class="widget"'), "header": ("header", 'div class="masthead"', 'div id="header"'),
          "ad": ('div class="ad"', 'div class="ads"', 'div class="promo"', 'div id="banner"', "aside"), "notice": ('div class="cookie-notice"', 'div class="consent"', 'div role="alert"', 'div class="notice"'),
          "form": ("form", 'form class="newsletter"', 'div class="login-form"', 'form id="search"'),
          "comment": ('section class="comments"', 'div id="comments"', 'div class="comment-list"', 'ol class="replies"', 'div class="discussion"')}


def wrapped(tag: str, inner: str, label: str) -> str:
    return f'<{tag} data-label="{label}">{inner}</{tag.split()[0]}>'


def variant(html: str, pool: list[str], rng: np.random.Generator) -> str | None:
    """A training page: the page's own main element under another name, its other parts renamed, and parts of kinds
    that it lacks added around and inside, filled with text of other pages. None if the page marks no main element."""
    found = _MAIN.search(html)
    if not found:
        return None
    pick = lambda options: options[rng.integers(len(options))]
    some = lambda: pool[rng.integers(len(pool))] if pool else "text"
    few = lambda: " ".join(some().split()[:rng.integers(2, 7)])

    def part(kind: str) -> str:
        body = {
            "nav": lambda: "".join(f'<li><a href="#">{few()}</a></li>' for _ in range(rng.integers(3, 9))),
            "footer": lambda: f"&copy; {few()} <p>{some()}</p>",
            "aside": lambda: "".join(f"<h3>{few()}</h3><p>{some()}</p>" for _ in range(rng.integers(1, 4))),
            "header": lambda: f"<div>{few()}</div><p>{few()}</p>",
            "ad": lambda: f"<p>{some()}</p>" if rng.random() < 0.5 else some(),
            "notice": lambda: f"<p>{some()}</p><button>{few()}</button>",
            "form": lambda: f"<label>{few()}</label><input><p>{some()}</p><button>{few()}</button>",
            "comment": lambda: f"<h2>{few()}</h2>" + "".join(
                pick((f'<div class="comment"><p>{few()}</p><p>{some()}</p></div>', f'<li class="comment">{some()}</li>', f'<article class="comment"><p>{some()}</p></article>')) for _ in range(rng.integers(1, 6))),
        }[kind]()
        return wrapped(pick(_WRONG[kind]), body, "drop")

    def renamed(rest: str) -> str:
        return _PARTS.sub(lambda m: wrapped(pick(_WRONG[m[1].lower()]) if rng.random() < 0.5 else m[1].lower(), m[2], "drop"), rest)

    inner = found[2]
    if rng.random() < 0.2:  # the page as it is
        return _PARTS.sub(lambda m: wrapped(m[1].lower(), m[2], "drop"), html[:found.start()]) + wrapped(found[1].lower(), inner, "keep") + _PARTS.sub(
            lambda m: wrapped(m[1].lower(), m[2], "drop"), html[found.end():])
    if rng.random() < 0.4:  # something foreign between two blocks
        ends = [m.end() for m in re.finditer(r"</p>", inner)]
        if ends:
            at = ends[rng.integers(len(ends))]
            inner = inner[:at] + part(pick(("ad", "aside", "form", "notice"))) + inner[at:]
    if rng.random() < 0.3:
        inner += part("comment")
    before, after = renamed(html[:found.start()]), renamed(html[found.end():])
    for kind in ("header", "notice", "nav", "ad", "form", "aside"):
        if rng.random() < 0.25:
            before += part(kind)
    for kind in ("comment", "aside", "form", "nav", "ad", "notice"):
        if rng.random() < 0.25:
            after = part(kind) + after
    name = pick(("article", "main")) if rng.random() < 0.4 else pick(_RIGHT)
    return before + wrapped(name, inner, "keep") + after


def fit(pages: DataFrame, *, html_col: str = "html", sample: int = 300, sample_chars: int = 20_000_000, variants: int = 5) -> Trees | None:
    """Trees from variants of at most sample pages that mark their main element (article or main), picked by a hash.

    Pages of any length take part: in the order of the hash, as long as all together have at most sample_chars characters,
    and the first in any case.

    The pages' own marks are the labels; renaming and adding parts keeps the trees from relying on any one mark.
    Without such a page there are no trees (None).
    """
    html = F.col(html_col)
    marked = pages.where(html.isNotNull() & html.rlike("(?is)<(article|main)\\b.*</(article|main)")).select(html.alias("html"))
    n = marked.select(F.xxhash64("html")).distinct().count()
    if not n:
        return None
    share = F.pmod(F.xxhash64("html"), F.lit(1 << 30)) < F.lit(int((1 << 30) * min(1.0, 2.0 * sample / n)))
    sizes = (marked.where(share).groupBy(F.xxhash64("html").alias("h")).agg(F.max(F.length("html")).alias("n")).orderBy("h").limit(sample).collect())
    total = np.cumsum([r["n"] for r in sizes])
    chosen = [r["h"] for r, t in zip(sizes, total) if t <= sample_chars] or [r["h"] for r in sizes[:1]]
    rows = (marked.withColumn("h", F.xxhash64("html")).where(F.col("h").isin(chosen)).groupBy("h").agg(F.first("html").alias("html")).orderBy("h").collect())
    texts = [r["html"] for r in rows]
    pool = [p for t in texts for p in _PARAGRAPH.findall(t)][:5000]
    rng = np.random.default_rng(11)
    made = [v for t in texts for _ in range(variants) if (v := variant(t, pool, rng))]
    if not made:
        return None
    nodes = nodes_of_all(made)
    x, y = np.concatenate([p.features for p in nodes]), np.concatenate([labels_of(p) for p in nodes])
    weight = np.concatenate([np.full(len(p.parents), 1 / np.sqrt(len(p.parents))) for p in nodes])
    return boost(x, y, weight / weight.mean())


def extract(pages: DataFrame, trees: Trees | None, *, html_col: str = "html") -> DataFrame:
    """The pages with text and n_chars (input columns of these names are replaced, the html column goes).

    Kept runs of text are in page order, joined by a line break; white space inside a run is one space. Null and empty pages
    have an empty text, long pages are read whole, and nodes of equal score are decided alike. Without trees all visible text is kept. Repeated rows get the same text; an empty table
    gives no rows; nulls in other columns do not matter. Each page is read whole.
    """
    sent = {"trees": trees}

    @F.arrow_udf("string")
    def run(column: pa.Array) -> pa.Array:
        trees, out = sent["trees"], []
        for first in range(0, len(column), 64):
            found = nodes_of_all([h or "" for h in column.slice(first, 64).to_pylist()])
            logits = trees.margin(np.concatenate([p.features for p in found])) if trees else np.full(sum(len(p.parents) for p in found), 30.0)
            at = 0
            for p in found:
                kept = decode(p.parents, logits[at:at + len(p.parents)])
                at += len(p.parents)
                out.append("\n".join(t for t, k in zip(p.texts, kept) if k and t))
        return pa.array(out, pa.string())

    rest = [c for c in pages.columns if c not in ("text", "n_chars", html_col)]
    return pages.withColumn("__text", run(F.col(html_col))).select(*rest, F.col("__text").alias("text"), F.length("__text").cast("long").alias("n_chars"))

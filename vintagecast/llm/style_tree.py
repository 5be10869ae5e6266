"""Main text of web pages by site style trees.

The pages of a host are merged into one tree: an element node stands for all
elements with the same chain of tags and classes.  Of every node the tree
counts in how many pages it occurs (pages with the same texts are one), which sequences of children it has there
(its presentation styles) and which texts stand in it (its content).  A node
is important when pages differ in it:

* content: 1 - mean over its texts of H(text), H(text) = log c / log m for a
  text in c of the node's m pages;
* presentation: the entropy, to the base m, of its child sequences;
* together: (1 - g^l) * presentation + g^l * mean of its children's, l = number of
  child sequences, g = 0.9; a leaf has its content's importance.

A host with few pages leans on the tree over all hosts.  Branches below
NOISE are taken out of each page.  The article or main part itself, if the page
names one, is the root of what is left and never taken out; the outermost one
counts.  Within it a class or role of the list below only raises the bar to
NAMED_NOISE (readers' comments and landmark roles are out by name); outside, or
on a page that names no root, a class or id of the list says noise.

Defined cases: null or empty html gives empty text; a null or broken url
counts as one host of its own name; rows that repeat a ``page_id`` are
extracted each; tags left open or never opened are put up with; an empty table
gives an empty result; other columns don't matter.
"""

from __future__ import annotations

import functools
import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, small, small_batches, staged
from .dom import INLINE, Page, blocks, read_page

NOISE, DAMP, HOST_PAGES = 0.3, 0.9, 10
#: Within a content root: what a branch whose class or role is of NO_CONTENT_WORDS has to reach.
NAMED_NOISE = 0.6
#: Pages of a node that its importance needs to be believed at all.
LEAST_PAGES = 5
#: Elements below so many nodes belong to the last of them (a tree takes one step a level).
MOST_DEPTH = 64
ALL_HOSTS = "*"

#: Elements that hold no running text of an article.
NO_CONTENT = frozenset("script style noscript template iframe svg math canvas object audio video nav aside form button select textarea input dialog menu head title footer map datalist noembed noframes xmp".split())
#: What class, id or role call a part that isn't the article's text.
NO_CONTENT_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising advertorial adbox adsense banner banners breadcrumb breadcrumbs cookie cookies consent gdpr"
    " comment comments commentlist disqus complementary contentinfo dialog disclaimer footer form login masthead menu menubar menus modal nav navbar navigation navigational newsletter notice notices"
    " notification overlay pager pagination paywall popup popups promo promos promoted promotion recommended related replies respond search share sharing sidebar sidebars signup skip"
    " social sponsor sponsored sponsors subscribe subscription tags teaser toolbar topbar widget widgets alert alertdialog".split()
)
#: readers' texts and landmark roles; no part of an article wherever they stand.
APART = frozenset("comment comments commentlist disqus replies respond @banner @complementary @contentinfo @navigation @search @form @menu @menubar @toolbar @dialog @alertdialog".split())
#: Words of a class or id that only say where a part stands.
PLACE_WORDS = frozenset(
    "area article bar block bottom box button buttons col column container content entry fixed float footer global group head header icon icons inner item items left link links list main"
    " mobile outer page post primary right row secondary section side site sticky text title top unit wrap wrapper".split()
)
#: Names like site-header, but not an article's header.
SITE_HEADER = frozenset("site global top bar header masthead".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Tags of NO_CONTENT that are text where they stand in an article.
SHOWN_WITHIN = frozenset("math map object".split())
ROOT_WORDS = frozenset(["main", "articlebody", "article-body", "post-content", "entry-content", "article-content"])
#: Elements that may hold an article whatever they are called.
HOLDERS = frozenset("div section main article form center table tbody tr td".split())
_NONE: frozenset = frozenset()
_WORDS = re.compile(r"[A-Za-z][a-z]*|[A-Z]+")


def named(words: str) -> set[str]:
    """Lower-case words of a class name or id: ``siteHeader ad-box_2`` has site, header, ad, box."""
    return {w.lower() for w in _WORDS.findall(words)}


def _chain(page: Page) -> list[int]:
    """A 63-bit number of every element's chain of tags, classes and roles; inline
    elements and those below MOST_DEPTH have that of the block they stand in."""
    out, depth = [0], [0]
    for i in range(1, len(page.tag)):
        above, tag = page.parent[i], page.tag[i]
        up = out[above]
        if tag in INLINE and not page.words[i] or depth[above] >= MOST_DEPTH:
            out.append(up)
            depth.append(depth[above])
            continue
        key = f"{up}/{tag}.{re.sub('[0-9]+', '', page.words[i])}".encode()
        out.append(int.from_bytes(hashlib.blake2b(key, digest_size=8).digest(), "little") >> 1)
        depth.append(depth[above] + 1)
    return out


@functools.lru_cache(1 << 16)
def says_noise(token: str) -> bool:
    """Whether a class, role or id names a part that is no content: it has a word
    of the list and besides only words for places.  ``post-comments`` and
    ``adBox`` do, ``related-work``, ``ad-hoc`` and ``no-sidebar`` don't."""
    words = named(token)
    return bool(words & NO_CONTENT_WORDS) and words <= NO_CONTENT_WORDS | PLACE_WORDS or "header" in words and 1 < len(words) and words <= SITE_HEADER


def amounts(page: Page) -> list[int]:
    """Characters of shown text in every element and below it; a form's count,
    other parts without content don't."""
    found = [0] * len(page.tag)
    for element, raw in page.text:
        found[element] += len("".join(raw.split()))
    for i in range(len(found) - 1, 0, -1):
        if page.hidden[i] or page.tag[i] in NO_CONTENT and page.tag[i] != "form" and page.tag[i] not in SHOWN_WITHIN:
            found[i] = 0
        found[page.parent[i]] += found[i]
    return found


def said_noise(page: Page) -> tuple[list[bool], list[bool], list[int]]:
    """Which elements are no content by name (theirs or one above), which within a
    root may be, and the content roots: the outermost articles and mains; empty
    if the page names none.  Outside a root, a form or a part called like noise
    that holds at least half of the page's text is a container, not noise (but
    for readers' texts); so is the source line of a quotation no footer."""
    n, amount = len(page.tag), amounts(page)
    tokens = [w.split() for w in page.words]
    said = [any(map(says_noise, t)) or bool(d) and says_noise(d) for t, d in zip(tokens, page.ids)]
    named_root = [t == "article" or t == "main" or any(w.lower().lstrip("@") in ROOT_WORDS for w in (*own, *d.split())) for t, own, d in zip(page.tag, tokens, page.ids)]
    holds = [False] * n  # a root below: names like "sidebar-left" on it say nothing
    for i in range(n - 1, 0, -1):
        if holds[i] or named_root[i] and not said[i]:
            holds[page.parent[i]] = True
    dead, doubtful, within = [False] * n, [False] * n, [False] * n
    roots = []
    for i in range(1, n):
        up, tag = page.parent[i], page.tag[i]
        bad = tag in NO_CONTENT or page.hidden[i]
        if tag == "footer" and page.tag[up] in ("blockquote", "figure"):
            bad = page.hidden[i]
        if within[up]:
            bad = bad and not (tag in SHOWN_WITHIN and not page.hidden[i])
            if tag not in HEADINGS:
                lower = [w.lower() for w in tokens[i]]
                bad = bad or not APART.isdisjoint(lower) or page.ids[i].lower() in APART
                doubtful[i] = any(w.lstrip("@") in NO_CONTENT_WORDS for w in lower)
        else:
            bad = bad or tag == "header" or said[i] and tag not in HEADINGS
            apart = any(w.lower() in APART for w in (*tokens[i], page.ids[i]))
            most = 2 * amount[i] >= amount[0] > 0 and not apart and (tag == "form" or tag not in NO_CONTENT and tag != "header")
            if tag in ("html", "body") or (most or holds[i] and tag in HOLDERS) and not page.hidden[i]:
                bad = False
        dead[i] = dead[up] or bad
        within[i] = within[up] or named_root[i] and not dead[i]
        if within[i] and not within[up]:
            roots.append(i)
    return dead, doubtful, roots


def _ups(page: Page, i: int) -> Iterator[int]:
    i = page.parent[i]
    while i > 0:
        yield i
        i = page.parent[i]


FEATURES = "host string, key long, digest long, nodes array<long>, parents array<long>, kinds array<int>, values array<long>"


def text_digest(page: Page) -> int:
    """Number of the page's shown texts: equal for copies that differ in markup,
    scripts or addresses only."""
    shown = [True] * len(page.tag)
    for i in range(1, len(page.tag)):
        shown[i] = shown[page.parent[i]] and not page.hidden[i] and (page.tag[i] not in NO_CONTENT or page.tag[i] in SHOWN_WITHIN)
    return _number(" ".join(w for element, raw in page.text if shown[element] for w in raw.split()))


def page_features(page: Page) -> Iterator[tuple[int, int, int, int]]:
    """(node, parent node, kind, value) of a page: kind 0 = the node occurs (at
    the depth of its value), 1 = a child sequence, 2 = a text."""
    chain = _chain(page)
    children: dict[int, list[int]] = {}
    nodes, parents, depth = {}, {}, {0: 0}
    for i in range(1, len(chain)):
        c, up = chain[i], chain[page.parent[i]]
        if c == up:
            continue
        nodes[i] = c
        parents[c] = up
        depth[c] = depth[up] + 1
        children.setdefault(page.parent[i], []).append(c)
    texts: dict[int, list[str]] = {}
    home = [0]  # the node that an element's text belongs to
    for i in range(1, len(chain)):
        home.append(i if i in nodes else home[page.parent[i]])
    for element, raw in page.text:
        raw = " ".join(raw.split())
        if raw:
            texts.setdefault(home[element], []).append(raw)
    seen = set()
    for i, c in nodes.items():
        up = parents[c]
        seen.add((c, up, 0, depth[c]))
        if i in children:
            row = children[i]
            distinct = [x for k, x in enumerate(row) if not k or row[k - 1] != x]  # a list of any length is one style
            seen.add((c, up, 1, _number(",".join(map(str, distinct)) + f"#{len(row)}")))
        if i in texts:
            seen.add((c, up, 2, _number(" ".join(texts[i]))))
    yield from seen


def _number(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little") >> 1


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        digests, ends, rows = [], [0], []
        for source in b.column("html"):
            page = read_page(source.as_py() or "")
            digests.append(text_digest(page))
            rows += page_features(page)
            ends.append(len(rows))
        ends = pa.array(ends, pa.int32())
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64()]
        lists = [pa.ListArray.from_arrays(ends, pa.array(c, t)) for c, t in zip(list(zip(*rows)) or [[]] * 4, kinds)]
        yield pa.RecordBatch.from_arrays([b.column("host"), b.column("key"), pa.array(digests, pa.int64()), *lists], names=[x.split()[0] for x in FEATURES.split(", ")])


def feature_counts(features: DataFrame) -> DataFrame:
    """Per (host, node, parent, kind, value): in how many distinct contents of the
    host's pages it occurs, and in how many of all pages.  Of c pages with the
    same texts each counts 1/c: copies are no layout and no repeated passage."""
    own = staged(features.groupBy("host", "digest").agg(F.count(F.lit(1)).alias("own")), "contents")
    copied = staged(own.groupBy("digest").agg(F.sum("own").alias("all")).where("all > 1"), "copied")
    copies = staged(own.join(small(copied), "digest"), "copies")
    each = features.join(small(copies), ["host", "digest"], "left").select(
        "host", F.coalesce(1 / F.col("own"), F.lit(1.0)).alias("pages"), F.coalesce(1 / F.col("all"), F.lit(1.0)).alias("all_pages"),
        F.explode(F.arrays_zip(F.col("nodes").alias("node"), F.col("parents").alias("parent"), F.col("kinds").alias("kind"), F.col("values").alias("value"))).alias("f"),
    )
    total = lambda name: F.round(F.sum(name), 6).alias(name)
    return each.select("host", "f.*", "pages", "all_pages").groupBy("host", "node", "parent", "kind", "value").agg(total("pages"), total("all_pages"))


def node_sums(counts: DataFrame) -> DataFrame:
    """Per (host, node): parent, depth, m (pages), styles, style_sum, texts, text_log: all
    that the importances need, by partial aggregation."""
    c, value = F.col("pages"), lambda kind: F.col("kind") == kind
    log = F.log(F.greatest(c, F.lit(1.0)))  # under 1: in some copies of one content only
    return counts.groupBy("host", "node").agg(
        F.min("parent").alias("parent"),
        F.max(F.when(value(0), F.col("value"))).alias("depth"),
        F.sum(F.when(value(0), c)).alias("m"),
        F.count_if(value(1)).alias("styles"),
        F.sum(F.when(value(1), c)).alias("style_pages"),
        F.sum(F.when(value(1), c * log)).alias("style_log"),
        F.count_if(value(2)).alias("texts"),
        F.sum(F.when(value(2), log)).alias("text_log"),
    )


def importance(tree: pd.DataFrame) -> pd.DataFrame:
    """Importance of every node of one host's tree (a row for each node): what
    ``importances`` finds, in memory."""
    own: dict[int, float] = {}
    below: dict[int, list[int]] = {}
    rows = {r.node: r for r in tree.itertuples(index=False)}
    for r in rows.values():
        if r.parent in rows and r.parent != r.node:
            below.setdefault(r.parent, []).append(r.node)
    order, todo = [], [n for n, r in rows.items() if r.parent not in rows]
    while todo:
        node = todo.pop()
        order.append(node)
        todo += below.get(node, [])
    for node in reversed(order):  # children first
        r = rows[node]
        base = math.log(r.m) if r.m > 1 else 0.0
        content = None
        if r.texts:
            content = 1.0 if not base else 1.0 - min(1.0, r.text_log / r.texts / base)
        parts = [own[x] for x in below.get(node, [])]
        if content is not None:
            parts.append(content)
        inner = sum(parts) / len(parts) if parts else 0.0
        if below.get(node) and r.styles:
            p = r.style_pages
            style = 1.0 if not base else min(1.0, (math.log(p) - r.style_log / p) / base)
            w = DAMP**r.styles
            own[node] = max((1 - w) * style + w * inner, inner)
        else:
            own[node] = inner
    keep = list(own)
    return pd.DataFrame({"host": tree["host"].iloc[0], "node": keep, "m": [rows[n].m for n in keep], "imp": [own[n] for n in keep]})


def importances(sums: DataFrame) -> DataFrame:
    """(host, node, m, imp) of the nodes of all trees, level by level from the
    leaves up: each step sums the next level's importances by parent."""
    deepest = sums.agg(F.max("depth")).first()[0]
    own = [F.max(c).alias(c) for c in ("parent", "m", "styles", "style_pages", "style_log", "texts", "text_log")]
    m, texts, styles, pages = (F.col(c) for c in ("m", "texts", "styles", "style_pages"))
    base = F.log(F.greatest(m, F.lit(1.0)))
    content = F.when(base == 0, 1.0).otherwise(1 - F.least(F.lit(1.0), F.col("text_log") / texts / base))
    parts = F.col("below") + F.when(texts > 0, 1).otherwise(0)
    inner = F.when(parts > 0, (F.coalesce(F.col("of_below"), F.lit(0.0)) + F.when(texts > 0, content).otherwise(0.0)) / parts).otherwise(0.0)
    style = F.when(base == 0, 1.0).otherwise(F.least(F.lit(1.0), (F.log(pages) - F.col("style_log") / pages) / base))
    weight = F.pow(F.lit(DAMP), styles)
    imp = F.when((F.col("below") > 0) & (styles > 0), F.greatest((1 - weight) * style + weight * F.col("inner"), F.col("inner"))).otherwise(F.col("inner"))
    levels = []
    for depth in range(int(deepest or 0), 0, -1):
        rows = sums.where(F.col("depth") == depth).drop("depth").withColumns({"of_below": F.lit(None).cast("double"), "below": F.lit(0)})
        if levels:
            children = levels[-1].select("host", F.col("parent").alias("node"), F.col("imp").alias("of_below"), F.lit(1).alias("below"))
            rows = rows.unionByName(children, allowMissingColumns=True)
        rows = rows.groupBy("host", "node").agg(*own, F.sum("of_below").alias("of_below"), F.sum("below").alias("below"))
        levels.append(staged(rows.withColumn("inner", inner).select("host", "node", "parent", "m", imp.alias("imp")), "level"))
    scored = [x.select("host", "node", "m", "imp") for x in levels]
    return functools.reduce(DataFrame.unionAll, scored) if scored else sums.select("host", "node", "m", F.lit(0.0).alias("imp")).limit(0)


def noisy_nodes(counts: DataFrame) -> DataFrame:
    """(host, node, weak): the nodes of each host below NAMED_NOISE, weak if not
    below NOISE."""
    everywhere = counts.groupBy("node", "parent", "kind", "value").agg(F.round(F.sum("all_pages"), 6).alias("pages")).withColumn("host", F.lit(ALL_HOSTS))
    sums = node_sums(counts).unionByName(node_sums(everywhere)).fillna(0.0)
    scored = importances(staged(sums.sortWithinPartitions("depth"), "nodes"))  # a level's step skips the others' row groups
    base = scored.where(F.col("host") == ALL_HOSTS).select("node", F.col("imp").alias("all_imp"), F.col("m").alias("all_m"))
    own = scored.where(F.col("host") != ALL_HOSTS).join(small(base), "node")
    mixed = (F.col("m") * F.col("imp") + HOST_PAGES * F.col("all_imp")) / (F.col("m") + HOST_PAGES)
    return own.where((mixed < NAMED_NOISE) & (F.col("all_m") >= LEAST_PAGES)).select("host", "node", (mixed >= NOISE).alias("weak"))


def noise_of_pages(features: DataFrame, noisy: DataFrame) -> DataFrame:
    """(host, key, nodes, weak) of the pages that have noisy nodes: their own ones."""
    rows = features.select("host", "key", F.explode(F.array_distinct("nodes")).alias("node")).join(small(noisy), ["host", "node"])
    some = lambda weak: F.collect_set(F.when(F.col("weak") == weak, F.col("node")))
    return rows.groupBy("host", "key").agg(some(False).alias("nodes"), some(True).alias("weak"))


def main_text(page: Page, noisy: frozenset[int], weak: frozenset[int] = _NONE, chain: list[int] | None = None) -> str:
    """The page's text without its noise, blocks joined by an empty line.

    Inside a root that the page names, only elements with a name of their own and
    articles nested in it can be noise of the site: its plain paragraphs stay,
    however many pages repeat them.  ``weak`` are nodes that are noise only if
    their name says so too.  A page of which the site's tree would leave nothing
    keeps what isn't noise by name."""
    dead, doubtful, roots = said_noise(page)
    n, root = len(page.tag), set(roots)
    spine = {j for r in roots for j in _ups(page, r)} | root

    def kept(chain: list[int] | None) -> list[bool]:
        inside, gone, keep = [False] * n, [False] * n, [not roots] * n
        for i in range(1, n):
            up, tag = page.parent[i], page.tag[i]
            inside[i] = i in root or inside[up]
            site = False
            if chain is not None and i not in spine and chain[i] != chain[up] and tag not in ("html", "body"):
                site = (chain[i] in noisy or doubtful[i] and chain[i] in weak) and bool(page.words[i] or tag == "article" or not inside[i])
            gone[i] = gone[up] or dead[i] or site
            keep[i] = not gone[i] and (inside[i] or not roots)
        return keep

    text = blocks(page, kept(chain or _chain(page))) if noisy or weak else []
    return "\n\n".join(text or blocks(page, kept(None)))


def _among(nodes: np.ndarray, host_key: int, known: np.ndarray) -> frozenset[int]:
    """Those of ``nodes`` whose number with the host's is in the sorted ``known``."""
    if not len(known):
        return _NONE
    keys = nodes ^ np.int64(host_key)
    at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
    return frozenset(nodes[known[at] == keys].tolist())


def _extract(known):
    """Texts of pages; noisy nodes are in ``known`` (of all hosts) or with each page."""

    def extract_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = []
            of_page = (b.column("nodes").to_pylist(), b.column("weak").to_pylist()) if known is None else (b.column("host_key").to_pylist(),) * 2
            for source, one, two in zip(b.column("html"), *of_page):
                page = read_page(source.as_py() or "")
                chain = _chain(page)
                if known is None:
                    noisy, weak = frozenset(one or ()), frozenset(two or ())
                else:
                    nodes = np.unique(np.array(chain, np.int64))
                    noisy, weak = (_among(nodes, one, k) for k in known.value)
                texts.append(main_text(page, noisy, weak, chain))
            yield pa.RecordBatch.from_arrays([b.column("page_id"), b.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return extract_all


def host_of(url: Column) -> Column:
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


def extract(pages: DataFrame, most_noisy: int = BROADCAST_ROWS) -> DataFrame:
    """Per row of ``pages``: page_id, url, text, n_chars.  Pages are read twice;
    what is shuffled are counts by (host, node, value).  Up to ``most_noisy``
    noisy nodes of all hosts go to the tasks as plain numbers; beyond that each
    page is joined to its own ones by host and hash (pages of one host and hash
    share theirs: more nodes of the same host change nothing)."""
    pages = small_batches(pages).select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    keyed = pages.withColumns({"host": host_of(F.col("url")), "key": F.xxhash64("html")})
    features = staged(keyed.select("host", "key", "html").mapInArrow(_features, FEATURES), "features")
    noisy = staged(noisy_nodes(staged(feature_counts(features), "counts")), "noisy")
    schema = "page_id long, url string, text string, n_chars long"
    if noisy.count() > most_noisy:
        found = staged(noise_of_pages(features, noisy), "page_noise")
        return keyed.join(found, ["host", "key"], "left").select("page_id", "url", "html", "nodes", "weak").mapInArrow(_extract(None), schema)
    number = F.col("node").bitwiseXOR(F.xxhash64("host")).alias("number")
    known = tuple(np.sort(noisy.where(F.col("weak") == w).select(number).toArrow().column(0).to_numpy()) for w in (False, True))
    known = pages.sparkSession.sparkContext.broadcast(known)  # 8 bytes for each of at most most_noisy nodes
    return keyed.select("page_id", "url", "html", F.xxhash64("host").alias("host_key")).mapInArrow(_extract(known), schema)

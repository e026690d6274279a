"""HTML extraction by wrapper induction.

A page becomes a tree of its block elements; runs of like siblings are one
repeated node. The trees of a host are aligned by simple tree matching: roots
must agree, and the children of two matched nodes are paired in order so that
the number of matched nodes is largest. The merged tree is the host's wrapper.
For every node it keeps how much text stands there. On how many different
pages of the host (copies of a page count once) a text stands at a node is
counted for all texts, nodes and pages.

Labels name the tag, classes and id of an element without the numbers in them.

* ``article``, else ``main``, is the text of a page that has it; of other pages
  every block counts that varies.
* The content node is found by going down from the body, as long as one child
  holds most of the text; it only helps to tell template.
* A text that stands at one node on nearly all different pages, two at least,
  is template and goes there. This holds inside the content node only if such texts are a small part
  of it, so hosts that repeat whole articles lose none of them.
* Menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles
  and reader comments go by their element, role or class names; a ``header``
  goes wherever it stands, in an article too.

Map tasks merge the trees of their own pages first, then the wrappers of a
host meet one by one in a salted and a final step, so no group of pages is
ever in memory. All pages take part.

The text of a page: its content blocks in page order, character references
decoded, white space inside a block turned into one space, trimmed, joined by
one line feed; no block is cut or dropped otherwise.

Defined results: null or empty html gives an empty text; text outside any
element counts as a block of the body; unclosed and stray tags are closed as a
browser would; a null url is a host of its own; repeated rows repeat; a null
page_id is kept; an empty table gives an empty result.
"""

from __future__ import annotations

import html as entities
import json
import re

import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelens.llm._shared import Scratch

# Element kinds of the HTML standard.
BLOCKS = frozenset("""address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure
footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre search section summary table tbody td tfoot th
thead tr ul caption head title option select""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe xmp noembed noframes".split())
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
          "option": ("option",), "tbody": ("tbody", "thead", "tr", "td", "th"), "thead": ("tbody",), "body": ("head",)}
FENCES = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("table",), "th": ("table",),
          "option": ("select",), "tbody": ("table",), "thead": ("table",), "body": ()}
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre li dd dt td th figcaption caption article main section body".split())

# Elements, roles and class or id words that are never main text.
OUT_TAGS = frozenset("""head title nav header footer aside form script style noscript template iframe button select option
textarea menu dialog object embed svg canvas map search fieldset xmp noembed noframes audio video""".split())
OUT_ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog menu menubar toolbar form".split())
OUT_WORDS = frozenset("""ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie cookies
consent gdpr notice notices alert popup modal overlay comment comments disqus respond replies sidebar sidebars rail menu menus nav
navbar navigation breadcrumb breadcrumbs header masthead footer share sharing social newsletter subscribe subscription signup login
related recommended pagination pager toolbar widget widgets skip""".split())
# A name is such a word, or ends with one that no word before denies, or begins
# with one and only says its part or place.
DENIES = frozenset("no not non without with has have is hide show toggle".split())
PARTS = frozenset("""left right top bottom main primary secondary bar box block button buttons container inner item items link links list
outer panel row section wrap wrapper""".split())
# These hold articles of others, so they go even if a page has no other article.
OTHERS = frozenset("""ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion comment comments disqus respond
replies related recommended""".split())

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<[!?][^>]*>?|</[^a-zA-Z][^>]*>?", re.S)
ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
WORDS = re.compile(r"[a-z]+|[0-9]+")
NUMBERS = re.compile(r"[-_]*[0-9]+")

MOST = 0.8  # of the different pages: a text on so many is template
DEEPEST = 100  # levels of a wrapper
SALTS = 16
BROADCAST_BYTES = 8 << 20


def _attributes(raw: str) -> dict[str, str]:
    return {m[1].lower(): entities.unescape(m[2] or m[3] or m[4] or "") for m in ATTRIBUTE.finditer(raw)}


def _out_word(name: str) -> str | None:
    """The word of a class or id that tells it is never main text."""
    words = [w for w in WORDS.findall(name.lower()) if not w.isdigit()]
    if not words or words[0] in DENIES:
        return None
    if words[-1] in OUT_WORDS and not DENIES & set(words):
        return words[-1]
    return words[0] if words[0] in OUT_WORDS and all(w in PARTS or w in OUT_WORDS for w in words[1:]) else None


def _element(tag: str, raw: str) -> tuple[str, bool, bool]:
    """(label, out, always): the label names tag, id and classes; ``out`` says
    that it is never main text, ``always`` that this is not by a name alone
    that a wrapper of the main text may have too."""
    if not raw.strip():
        return tag, tag in OUT_TAGS, tag in OUT_TAGS
    attr = _attributes(raw)
    # numbers vary from page to page (post-17, post-18): they are no part of a label
    names = sorted({NUMBERS.sub("", n) for n in attr.get("class", "").split()} - {""})
    label = tag + "".join("." + n for n in names)
    if NUMBERS.sub("", attr.get("id", "")):
        label += "#" + NUMBERS.sub("", attr["id"])
    always = tag in OUT_TAGS or attr.get("role", "").lower() in OUT_ROLES
    if tag in ("html", "body", "article", "main"):
        return label, always, always
    told = {_out_word(n) for n in [*attr.get("class", "").split(), *attr.get("id", "").split()]} - {None}
    return label, always or bool(told), always or bool(told & OTHERS)


def blocks(page: str | None) -> list[tuple[tuple[str, ...], bool, str]]:
    """(labels from the root, out, text) of every block with text, in page
    order. A name doesn't take out the element that holds the only article or
    main of a page, nor all text of a page."""
    found, named = _blocks(page, ())
    if not named:
        return found
    left = [labels for labels, out, _ in found if not out]
    if not any(x.split(".")[0].split("#")[0] in ("article", "main") for labels in left for x in labels):
        again, _ = _blocks(page, ("article", "main"))
        if sum(not out for _, out, _ in again) > len(left):
            return again
    return found if left else _blocks(page, None)[0]


def _blocks(page: str | None, held: tuple[str, ...] | None) -> tuple[list[tuple[tuple[str, ...], bool, str]], bool]:
    """The blocks, and whether a name alone took something out; names don't
    count for elements of the tags ``held`` below them, or (None) at all."""
    page = page or ""
    found, text, named = [], [], False
    stack: list[tuple[str, str, bool, bool]] = []  # tag, label, out, always (of it or above it)
    at, lower = 0, None

    def flush():
        if text:
            joined = " ".join(entities.unescape("".join(text)).split())
            text.clear()
            if joined:
                labels = tuple(s[1] for s in stack if s[0] in BLOCKS)
                found.append((labels if labels[:1] == ("html",) else ("html", *labels), bool(stack and stack[-1][2]), joined))

    def close(tag, fences=()):
        for k in range(len(stack) - 1, -1, -1):
            if stack[k][0] == tag:
                if any(s[0] in BLOCKS for s in stack[k:]) or stack[-1][2]:
                    flush()
                del stack[k:]
                return
            if stack[k][0] in fences:
                return
    for m in iter(lambda: TOKEN.search(page, at), None):
        if m.start() > at:
            text.append(page[at:m.start()])
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            if tag in BLOCKS or any(s[0] == tag for s in stack):
                if tag in BLOCKS:
                    flush()
                close(tag)
            continue
        if tag in VOID:
            text.append(" ")
            if tag == "hr":
                flush()
                close("p")
            continue
        if tag in ("html", "body") and any(s[0] == tag for s in stack):
            continue
        label, out, always = _element(tag, m[3])
        always = always or bool(stack and stack[-1][3])
        out = always if held is None else out or bool(stack and stack[-1][2])
        if out and not always:
            named = True
            if tag in held:
                out = False
        if tag in BLOCKS or tag in OUT_TAGS or (out and not (stack and stack[-1][2])):
            flush()
        if tag in BLOCKS:
            if tag not in ("option", "title", "head"):
                close("p", ("td", "th", "button", "caption", "body"))
            for other in CLOSES.get(tag, ()):
                close(other, FENCES[tag])
            if tag[0] == "h" and tag[1:].isdigit() and stack and re.fullmatch("h[1-6]", stack[-1][0]):
                close(stack[-1][0])
        if tag in RAW:
            lower = page.lower() if lower is None else lower
            end = lower.find("</" + tag, at)
            inner = page[at:] if end < 0 else page[at:end]
            at = len(page) if end < 0 else end
            if tag in ("title", "textarea") and not out:
                text.append(inner)
            stack.append((tag, label, out, always))
            continue
        if m[3].endswith("/") and tag not in BLOCKS:
            continue
        stack.append((tag, label, out, always))
    text.append(page[at:])
    flush()
    return found, named


# The tree of a host: {label, mass, kids}


def _node(label: str) -> dict:
    return {"l": label, "m": 0, "k": []}


def _hash(text: str) -> int:
    return (xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass")) ^ 1 << 63) - (1 << 63)


def _place(labels) -> int:
    """The hash of a node, which its labels from the root name."""
    return _hash("\n".join(labels[:DEEPEST]))


def page_tree(page: str | None) -> dict:
    """The block tree of one page, like siblings merged into one node."""
    root = _node("html")
    for labels, out, text in blocks(page):
        if out:
            continue
        node = root
        for label in labels[1:DEEPEST]:  # deeper blocks count for the node there
            # a sibling like the last or any earlier one is the same repeated node
            nxt = next((k for k in node["k"] if k["l"] == label), None)
            if nxt is None:
                nxt = _node(label)
                node["k"].append(nxt)
            node = nxt
        node["m"] += len(text)
    return root


def _slots(batches):
    """For each page the hash of its text, and its different pairs of node and
    text with the length."""
    for b in batches:
        rows = []
        for host, page in zip(b["host"], b["html"]):
            found = [(labels, t) for labels, out, t in blocks(page) if not out]
            slots = sorted({(_place(labels), _hash(t), len(t)) for labels, t in found})
            rows.append((host, _hash("\n".join(t for _, t in found)), *([x[k] for x in slots] for k in range(3))))
        yield pd.DataFrame(rows, columns=["host", "mark", "node", "text", "size"])


def _pair(x: dict, y: dict, known: dict) -> tuple[int, list[tuple[int, int]]]:
    """Simple tree matching of two nodes: how many nodes match (0 unless the
    labels agree, else 1 and the best matching of the children) and the pairs
    of children, in order, that it takes. ``known`` holds each pair of nodes
    once, so the work is at most that of all pairs of nodes of a level."""
    key = (id(x), id(y))
    if key not in known:
        if x["l"] != y["l"]:
            return 0, []
        a, b = x["k"], y["k"]
        w = [[_pair(p, q, known)[0] for q in b] for p in a]
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i in range(len(a) - 1, -1, -1):
            for j in range(len(b) - 1, -1, -1):
                best[i][j] = max(best[i + 1][j], best[i][j + 1], best[i + 1][j + 1] + w[i][j])
        out, i, j = [], 0, 0
        while i < len(a) and j < len(b):
            if w[i][j] and best[i][j] == best[i + 1][j + 1] + w[i][j]:
                out.append((i, j))
                i, j = i + 1, j + 1
            elif best[i][j] == best[i + 1][j]:
                i += 1
            else:
                j += 1
        known[key] = 1 + best[0][0], out
    return known[key]


def _size(x: dict, y: dict) -> int:
    """How many nodes of two trees match."""
    return _pair(x, y, {})[0]


def merge(a: dict, b: dict, known: dict | None = None) -> dict:
    """The wrapper of both trees; children of ``b`` without a partner are put
    in at their place."""
    known = {} if known is None else known
    _, matched = _pair(a, b, known)
    a["m"] += b["m"]
    if b["k"]:
        kids, at, pairs = [], 0, dict((j, i) for i, j in matched)
        for j, kid in enumerate(b["k"]):
            if j in pairs:
                kids += a["k"][at:pairs[j]] + [merge(a["k"][pairs[j]], kid, known)]
                at = pairs[j] + 1
            else:
                kids.append(kid)
        a["k"] = kids + a["k"][at:]
    return a


def rule(tree: dict, slots: list[tuple[int, int, int, int]]) -> list[tuple[int, int]]:
    """The (text, node) that are template, of a wrapper and its ``slots`` that
    nearly all different pages have: (node, text, length, rows with it)."""
    def mass(node):
        return node["m"] + sum(mass(k) for k in node["k"])

    path, node = ["html"], tree
    while True:
        named = [k for k in node["k"] if k["l"].split(".")[0].split("#")[0] in ("article", "main")]
        kids = named or node["k"]
        total = mass(node)
        top = max(kids, key=lambda k: (mass(k), k["l"]), default=None)
        if top is None or path[-1].split(".")[0].split("#")[0] == "article":
            break
        tag = top["l"].split(".")[0].split("#")[0]
        if not named and (mass(top) < 0.6 * total or tag in PROSE - {"article", "main", "section", "body"}):
            break
        path.append(top["l"])
        node = top
    inside = set()

    def within(n, labels):
        inside.add(_place(labels))
        for k in n["k"]:
            within(k, [*labels, k["l"]])
    within(node, path)
    if sum(size * rows for at, _, size, rows in slots if at in inside) > 0.3 * max(1, mass(node)):
        slots = [x for x in slots if x[0] not in inside]
    return sorted((text, at) for at, text, _, _ in slots)


def extract(page: str | None, gone: dict[int, set[int]] | None) -> str:
    """The text of a page; ``gone``: the nodes where a text is template."""
    found = [(labels, t) for labels, out, t in blocks(page) if not out]
    base = lambda x: x.split(".")[0].split("#")[0]
    marked = [(labels, t) for labels, t in found if any(base(x) == "article" for x in labels)] or \
        [(labels, t) for labels, t in found if any(base(x) == "main" for x in labels)]
    found = marked or found
    if gone:
        found = [(labels, t) for labels, t in found if (h := _hash(t)) not in gone or _place(labels) not in gone[h]]
    return "\n".join(t for _, t in found)


def _trees(batches):
    """One wrapper for each host of the task."""
    hosts: dict = {}
    for b in batches:
        for host, page in zip(b["host"], b["html"]):
            tree = page_tree(page)
            hosts[host] = merge(hosts[host], tree) if host in hosts else tree
            if len(hosts) >= 20_000:
                yield _rows(hosts)
                hosts = {}
    if hosts:
        yield _rows(hosts)


def _rows(hosts: dict) -> pd.DataFrame:
    return pd.DataFrame({"host": list(hosts), "tree": [json.dumps(t) for t in hosts.values()]})


def _merged(batches):
    """Wrappers of a host, which come one after the other, into one."""
    host, tree = None, None
    for b in batches:
        for h, t in zip(b["host"], b["tree"]):
            if tree is not None and h == host:
                tree = merge(tree, json.loads(t))
            else:
                if tree is not None:
                    yield _rows({host: tree})
                host, tree = h, json.loads(t)
    if tree is not None:
        yield _rows({host: tree})


def _as_rules(batches):
    for b in batches:
        lists = [[() if x is None else x.tolist() for x in b[c]] for c in ("node", "text", "size", "rows")]
        yield pd.DataFrame({"host": b["host"], "rule": [json.dumps(rule(json.loads(t), list(zip(*x))))
                                                        for t, *x in zip(b["tree"], *lists)]})


def _texts(page: pd.Series, known: pd.Series) -> pd.Series:
    parsed: dict = {}
    out = []
    for p, k in zip(page, known):
        if k is not None and k not in parsed:
            parsed[k] = {}
            for t, at in json.loads(k):
                parsed[k].setdefault(t, set()).add(at)
        out.append(extract(p, parsed.get(k)))
    return pd.Series(out, dtype=object)


def host_of(url):
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)), F.lit(""))


def wrappers(pages: DataFrame, scratch: Scratch, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(host, rule) of every host."""
    n = int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = pages.select(host_of(F.col(url_col)).alias("host"), F.col(html_col).alias("html"))
    different = scratch.save(
        rows.mapInPandas(_slots, "host string, mark long, node array<long>, text array<long>, size array<long>")
        .groupBy("host", "mark").agg(F.min(F.struct("node", "text", "size")).alias("x"), F.count("*").alias("copies")), "different")
    count = different.groupBy("host").agg(F.count("*").alias("pages"))
    slots = (different.select("host", "copies", F.explode(F.arrays_zip("x.node", "x.text", "x.size")).alias("x"))
             .groupBy("host", "x.node", "x.text").agg(F.count("*").alias("n"), F.sum("copies").alias("rows"), F.min("x.size").alias("size"))
             .where("n > 1").join(count, "host").where(F.col("n") >= F.lit(MOST) * F.col("pages")))
    slots = slots.groupBy(F.col("host").alias("h")).agg(F.sort_array(F.collect_list(F.struct("node", "text", "size", "rows"))).alias("x"))
    trees = scratch.save(rows.mapInPandas(_trees, "host string, tree string"), "trees")
    salted = trees.withColumn("salt", F.pmod(F.xxhash64("tree"), F.lit(SALTS)))
    for keys in (["host", "salt"], ["host"]):
        salted = (salted.repartition(n, *keys).sortWithinPartitions(*keys, F.xxhash64("tree")).select("host", "tree")
                  .mapInPandas(_merged, "host string, tree string"))
    both = salted.join(slots, F.col("host") == F.col("h"), "left").select(
        "host", "tree", *[F.col(f"x.{c}").alias(c) for c in ("node", "text", "size", "rows")])
    out = scratch.save(both.mapInPandas(_as_rules, "host string, rule string"), "rules")
    scratch.drop("different")
    scratch.drop("trees")
    return out


def extract_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) for every row."""
    scratch = Scratch(pages.sparkSession, "html-extraction")
    rules = wrappers(pages, scratch, url_col, html_col).withColumnRenamed("host", "named")
    size = rules.agg(F.sum(F.length("rule") + F.length("named"))).first()[0] or 0
    if size <= BROADCAST_BYTES:  # beyond it, the join shuffles
        rules = F.broadcast(rules)
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    text = F.pandas_udf(_texts, "string")
    return (rows.join(rules, host_of(F.col("url")) == F.col("named"), "left")
            .select("page_id", "url", text("html", "rule").alias("text"))
            .withColumn("n_chars", F.length("text").cast("long")))

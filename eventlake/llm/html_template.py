"""Main text of web pages by template deduction over the pages of a host.

Pages of a host come from one template. A token is an element with its path of
tags, classes and ids (so equal tags in different places are different tokens).
Tokens that occur equally often in every page of the host, that is, whose
occurrence vectors are equal, form an equivalence class; a class is valid if its
tokens hang in one place of one other class, and valid classes nest into the
template. What the template leaves open are its slots, the text of blocks. The main
slots are those under one container of the template: its ``article`` or ``main``
element, else the innermost element that holds most of the host's running text.
Menus, headers, footers, side bars, notices, adverts, forms and comments are told
by their element, or by a whole token of role, class or id ("site-footer", but not
"no-sidebar"); only such elements below the container count, so the container and
what it lies in are never boilerplate by name, nor are body, main and an outer
article. What an ``article`` or ``main`` container holds besides is main text, also if it stands on
every page. In a container that only the classes tell, a block text that all pages with
the container have belongs to the template itself.

In Spark: each task folds its pages into one row per (host, token) - support,
occurrences, a commutative 64-bit fingerprint of the occurrence vector, text
size - and these rows are summed, so a host with a third of all pages is a few
rows per task. A template is one row per host, joined to the pages: broadcast while
``broadcast_hosts`` bounds it, else a shuffle that splits large hosts.

Defined results: a null or empty page, or one without main text, gives an empty
text; a page that lacks the host's container is read by its own; a null or odd url
is a host of its own name; repeated rows count as pages of their own; very long
pages are read whole; other columns are not read."""

from __future__ import annotations

import html as htmllib
import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlake.functions.shipping import ship_by_value
from eventlake.llm import hashing
from eventlake.llm.common import reliable

BROADCAST_HOSTS = 20_000
HIDDEN_SHARE = 9  # an element named as boilerplate is the container if it has over nine tenths of the text

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)
_ATTR = re.compile(r"""\b(class|id|role|hidden|aria-hidden|style)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title xmp iframe noembed noframes".split())
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark meter q rp rt ruby s samp "
             "small span strike strong sub sup time tt u var wbr br math mfrac mi mn mo mover mroot mrow ms mspace msqrt mstyle msub "
             "msubsup msup mtext munder munderover semantics".split())
#: an opening tag closes these open ones, up to the nearest of the second set
CLOSES = {**{t: ({"p"}, {"body", "div", "td", "li", "article", "section"}) for t in
             "address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul figure details".split()},
          "li": ({"li", "p"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd", "p"}, {"dl"}), "dd": ({"dt", "dd", "p"}, {"dl"}),
          "tr": ({"tr", "td", "th", "p"}, {"table"}), "td": ({"td", "th", "p"}, {"tr", "table"}),
          "th": ({"td", "th", "p"}, {"tr", "table"}), "option": ({"option"}, {"select"}), "body": ({"head"}, {"html"})}
#: elements and words of classes, ids and roles that never hold main text
BOILER_TAGS = set("nav footer aside form script style noscript template button select textarea iframe svg canvas object "
                  "dialog menu head title input label datalist audio video map".split())
BOILER_WORDS = set("ad ads adv advert adverts advertisement advertising adslot banner promo promoted promotion sponsor sponsored "
                   "sidebar aside menu nav navbar navigation breadcrumb breadcrumbs cookie cookies consent gdpr notice notices alert "
                   "notification popup modal overlay newsletter subscribe subscription signup login share sharing social related "
                   "recommended recommendations comment comments reply replies disqus footer masthead topbar toolbar search "
                   "pagination pager widget copyright legal skip toc complementary contentinfo hidden outbrain taboola".split())
#: words that may stand beside those in a name without changing what it names
PLACE_WORDS = set("area bar block bottom box container global inner left links list main mobile outer page primary region right "
                  "secondary section site slot top unit wrap wrapper".split())


def _names(mark: str, words: set[str]) -> bool:
    """Whether a class, id or role names one of ``words``: all of its parts do, or say where it stands."""
    parts = [w for w in re.split(r"[^a-z0-9]+", mark) if w and not w.isdigit()]
    return any(w in words for w in parts) and all(w in words or w in BOILER_WORDS or w in PLACE_WORDS for w in parts)


class Path:
    """A chain of elements: its key, whether it lies in an article or main element, the depth of the innermost boilerplate
    element on it (``cut``; 0 is none), and whether one of these is so by its tag (``hard``)."""

    __slots__ = ("key", "parent", "tag", "cut", "hard", "inside", "kids", "depth")

    def __init__(self, parent: Path | None, tag: str, marks: tuple[str, ...]):
        self.parent, self.tag, self.kids = parent, tag, {}
        self.key = (parent.key + "/" if parent else "") + ".".join((tag, *marks))
        self.depth = parent.depth + 1 if parent else 0
        inside = parent is not None and parent.inside
        self.inside = inside or tag in ("article", "main") or "main" in marks
        hard = tag in BOILER_TAGS or (tag == "header" and not inside)
        named = tag not in ("html", "body", "main") and not (tag == "article" and not inside) and any(
            _names(m, BOILER_WORDS) or not inside and _names(m, {"header"}) for m in marks)
        self.hard = hard or bool(parent and parent.hard)
        self.cut = self.depth if hard or named else parent.cut if parent else 0

    def child(self, tag: str, marks: tuple[str, ...]) -> Path:
        kid = self.kids.get((tag, marks))
        if kid is None:
            kid = self.kids[tag, marks] = Path(self, tag, marks)
        return kid


def _marks(attributes: str) -> tuple[str, ...]:
    if len(attributes) < 4 or "=" not in attributes and "hidden" not in attributes:
        return ()
    out = []
    for name, value in _ATTR.findall(attributes):
        name, value = name.lower(), value.strip("\"'").lower()
        if name == "style":
            if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
                out.append("hidden")
        elif name == "hidden" or name == "aria-hidden" and value == "true":
            out.append("hidden")
        elif name != "aria-hidden":
            out += value.split()
    return tuple(out)


def parse(page: str, root: Path) -> tuple[list[tuple[Path, str, bool]], Counter]:
    """Blocks (path, raw text, all of it links) in page order, and the occurrences of
    every element path. Elements left open end with their parent."""
    blocks: list[tuple[Path, str, bool]] = []
    seen: Counter = Counter()
    here, stack, text, plain, at = root, [], [], False, 0

    def flush(path: Path) -> None:
        nonlocal text, plain
        if text:
            while path.tag in INLINE and path.parent is not None:
                path = path.parent
            blocks.append((path, "".join(text), not plain))
            text, plain = [], False

    def push(s: str) -> None:
        nonlocal plain
        if s:
            text.append(s)
            if not plain and not s.isspace() and not any(p.tag == "a" for p in stack[-3:]):
                plain = True

    m = _TAG.search(page)
    while m:
        push(page[at:m.start()])
        at = m.end()
        tag = m.group(2)
        if tag:
            tag = tag.lower()
            if m.group(1):
                if any(p.tag == tag for p in stack):
                    if tag not in INLINE:
                        flush(here)
                    while stack.pop().tag != tag:
                        pass
                    here = stack[-1] if stack else root
            else:
                closes = CLOSES.get(tag)
                if tag not in INLINE:
                    flush(here)
                if closes:
                    k, found = len(stack) - 1, -1
                    while k >= 0 and stack[k].tag not in closes[1]:
                        if stack[k].tag in closes[0]:
                            found = k
                        k -= 1
                    if found >= 0:
                        del stack[found:]
                        here = stack[-1] if stack else root
                if tag == "br":
                    text.append(" ")
                path = here.child(tag, _marks(m.group(3)))
                seen[path] += 1
                if tag in RAW:
                    end = re.compile(f"</{re.escape(tag)}\\b[^>]*>", re.I).search(page, at)
                    at = end.end() if end else len(page)
                elif tag not in VOID and not m.group(3).endswith("/"):
                    stack.append(path)
                    here = path
        m = _TAG.search(page, at)
    push(page[at:])
    flush(here)
    return blocks, seen


def clean(raw: str) -> str:
    """Character references decoded, white space turned into single spaces, trimmed."""
    return " ".join(htmllib.unescape(raw).split())


def text_hash(text: str) -> int:
    return int(np.frombuffer(hashing.splitmix(np.array([hash_bytes(text.encode())], np.uint64)).tobytes(), np.int64)[0])


def hash_bytes(b: bytes) -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest(b)


def _weights(blocks) -> Counter:
    """Running text (not all links) under every path, ancestors included, without that in boilerplate below the path."""
    out: Counter = Counter()
    for path, raw, links in blocks:
        if not path.hard and not links:
            n, p = len(raw), path
            while p is not None and p.depth >= path.cut:
                out[p] += n
                p = p.parent
    return out


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(host, page key, html) -> one row per host and token of the task's batch."""
    for b in batches:
        root = Path(None, "", ())
        sums: dict = defaultdict(lambda: [0, 0, 0, 0])
        pages: Counter = Counter()
        common: dict[str, set] = {}
        hosts, keys = b.column(0).to_pylist(), b.column(1).to_pylist()
        for i, host in enumerate(hosts):
            blocks, seen = parse(b.column(2)[i].as_py() or "", root)
            weights, key = _weights(blocks), keys[i] & (2**64 - 1)
            seen[root] = 1
            for path, n in seen.items():
                s = sums[host, path]
                s[0] += 1
                s[1] += n
                s[2] += _mix(key, n)
                s[3] += weights.get(path, 0)
            texts = {text_hash(clean(raw)) for path, raw, _ in blocks if not path.hard}
            if texts:  # empty pages say nothing about fixed texts
                common[host] = common[host] & texts if host in common else texts
                pages[host] += 1
        rows = [(h, p.key, p.parent.key if p.parent else "", p.depth, p.cut > 0, p.hard, s[0], s[1], _signed(s[2]), s[3], None)
                for (h, p), s in sums.items()]
        # texts that all pages with text in this batch have; only such can be in all of the host
        rows += [(h, None, None, 0, False, False, pages[h], 0, 0, 0, t) for h, ts in common.items() for t in ts]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _FOLD_TYPES)], names=_FOLD_NAMES)


_FOLD_NAMES = ["host", "path", "parent", "depth", "boiler", "hard", "support", "occurrences", "vector", "weight", "fixed"]
_FOLD_TYPES = [pa.string(), pa.string(), pa.string(), pa.int32(), pa.bool_(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
_FOLD_SCHEMA = ("host string, path string, parent string, depth int, boiler boolean, hard boolean, support long, occurrences long, "
                "vector long, weight long, fixed long")


def _mix(key: int, n: int) -> int:
    """A page's share of the fingerprint of an occurrence vector: depends on page and count."""
    x = (key ^ (n * 0x9E3779B97F4A7C15)) & (2**64 - 1)
    x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & (2**64 - 1)
    x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & (2**64 - 1)
    return x ^ (x >> 31)


def _signed(x: int) -> int:
    x &= 2**64 - 1
    return x - 2**64 if x >= 2**63 else x


def host_of(url: Column) -> Column:
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]*)", 1)), F.lit(""))


def deduce_templates(pages: DataFrame) -> DataFrame:
    """One row per host: ``container`` (path of the main slots; null if none) and ``fixed``
    (hashes of block texts that belong to the template). ``pages``: host, key, html."""
    ship_by_value(__name__)
    ship_by_value(hashing.__name__)
    # tokens with equal vectors have equal sums; decimals, as a 64-bit sum would overflow
    folded = reliable(pages.select("host", "key", "html").mapInArrow(_fold, _FOLD_SCHEMA))
    tokens = (folded.where("path is not null").groupBy("host", "path")
              .agg(F.first("parent").alias("parent"), F.first("depth").alias("depth"),
                   F.first("boiler").alias("boiler"), F.first("hard").alias("hard"), F.sum("support").alias("support"),
                   F.sum("occurrences").alias("occurrences"), F.sum(F.col("vector").cast("decimal(20,0)")).alias("vector"),
                   F.sum("weight").alias("weight")))
    n_pages = tokens.where("path = ''").select("host", F.col("support").alias("pages"), F.col("weight").alias("all_weight"))
    tokens = reliable(tokens.join(n_pages, "host"))
    # equivalence classes, and the class in which each token's parent is
    classed = tokens.withColumn("class", F.struct("support", "occurrences", "vector"))
    up = classed.select("host", F.col("path").alias("parent"), F.col("class").alias("parent_class"))
    placed = classed.join(up, ["host", "parent"], "left")
    outside = F.when(F.col("parent_class") != F.col("class"), F.col("parent"))
    valid = placed.groupBy("host", "class").agg((F.count_distinct(outside) <= 1).alias("valid"))
    template = placed.join(valid, ["host", "class"])
    # the container: once or more in most pages, in a valid class or main by name; article, then main, then
    # the innermost element with most of the running text. Inside what a name calls boilerplate it has to be
    # single and outweigh all text outside (see ``_hidden``)
    ok = ((F.col("support") * 2 >= F.col("pages")) & ~F.col("hard") & (F.col("path") != "") & (F.col("weight") > 0))
    last = F.regexp_extract("path", r"([^/.]*)[^/]*$", 1)
    named = F.when(last == "article", 3).when((last == "main") | F.col("path").rlike(r"\.main[^/]*$"), 2).otherwise(0)
    most = (F.col("weight") * 10 >= F.col("all_weight") * 7) & F.col("valid")
    single = F.col("occurrences") == F.col("support")
    tagged = last.isin("article", "main")
    hidden = (F.when(tagged & single & (F.col("weight") > F.col("all_weight")), F.when(last == "article", 5).otherwise(4))
              .when(single & F.col("valid") & (F.col("weight") > F.col("all_weight") * HIDDEN_SHARE), 1))
    rank = F.when(F.col("boiler"), hidden).when((named > 0) | most, named)
    best = (template.where(ok).withColumn("rank", rank).where("rank is not null")
            .groupBy("host").agg(F.max(F.struct(
                "rank", F.when(F.col("rank") > 0, F.col("weight")).otherwise(F.col("depth")).alias("worth"),
                "depth", F.col("path"), "support", tagged.alias("tagged"))).alias("best"))
            .select("host", F.col("best.path").alias("container"), "best.support", "best.tagged"))
    untold = best.where(~F.col("tagged") & (F.col("support") > 1)).select("host", F.col("support").alias("with_it"))
    best = best.select("host", "container")
    fixed = (folded.where("fixed is not null").groupBy("host", "fixed").agg(F.sum("support").alias("n"))
             .join(untold, "host").where(F.col("n") >= F.col("with_it"))
             .groupBy("host").agg(F.collect_list("fixed").alias("fixed")))
    return reliable(n_pages.select("host").join(best, "host", "left").join(fixed, "host", "left"))


def main_text(page: str, container: str | None, fixed: frozenset, root: Path) -> str:
    """The text of the page's main slots, blocks joined by an empty line. Fixed texts
    stay on a page that has nothing else there (all pages of the host are copies)."""
    blocks, seen = parse(page, root)
    top = next((p for p in seen if p.key == container), None) if container is not None else None
    top = top or _own_container(blocks, seen) or root
    texts = [clean(raw) for path, raw, _ in blocks if path.cut <= top.depth and _under(path, top)]
    texts = [t for t in texts if t]
    own = [t for t in texts if text_hash(t) not in fixed] if fixed else texts
    return "\n\n".join(own or texts)


def _under(path: Path | None, top: Path) -> bool:
    while path is not None and path.depth > top.depth:
        path = path.parent
    return path is top


def _own_container(blocks, seen) -> Path | None:
    """As for a host, from one page alone; none is the whole page."""
    weights = _weights(blocks)
    if hidden := _hidden(weights, seen, ("article", "main"), 1):
        return hidden
    for tag in ("article", "main"):
        named = [p for p in seen if p.tag == tag and not p.cut]
        if named:
            return max(named, key=lambda p: (weights.get(p, 0), p.key))
    if hidden := _hidden(weights, seen, None, HIDDEN_SHARE):
        return hidden
    clear = {p: n for p, n in weights.items() if not p.cut}
    total = max(clear.values(), default=0)
    most = [p for p, n in clear.items() if n * 10 >= total * 7 and p.depth]
    return max(most, key=lambda p: (p.depth, p.key)) if most else None


def _hidden(weights, seen, tags: tuple[str, ...] | None, share: int) -> Path | None:
    """The container inside an element that a name calls boilerplate, where the page has little else: it stands once
    (comments and teasers are several) and has more than ``share`` times the text outside of such elements."""
    clear = max((n for p, n in weights.items() if not p.cut), default=0)
    found = [p for p, n in weights.items() if p.cut and not p.hard and seen[p] == 1 and n > clear * share and (tags is None or p.tag in tags)]
    return max(found, key=lambda p: (p.tag == "article" if tags else 0, weights[p], p.depth, p.key)) if found else None


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        root, out, sets = Path(None, "", ()), [], {}
        container, fixed = b.column(3).to_pylist(), b.column(4)
        for i in range(b.num_rows):
            marks = fixed[i].as_py()
            known = frozenset(marks) if marks else frozenset()
            known = sets.setdefault(known, known)
            out.append(main_text(b.column(2)[i].as_py() or "", container[i], known, root))
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(out, pa.string())], names=["page_id", "url", "text"])


def extract_main_text(pages: DataFrame, broadcast_hosts: int = BROADCAST_HOSTS) -> DataFrame:
    """page_id, url and text of every row of ``pages`` (page_id, url, html)."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.col("html").cast("string").alias("html"), host_of(F.col("url")).alias("host"))
    templates = deduce_templates(rows.withColumn("key", F.xxhash64("page_id", "url", F.length("html"))))
    if templates.limit(broadcast_hosts + 1).count() <= broadcast_hosts:
        templates = F.broadcast(templates)
    return (rows.join(templates, "host", "left").select("page_id", "url", "html", "container", "fixed")
            .mapInArrow(_extract, "page_id long, url string, text string"))

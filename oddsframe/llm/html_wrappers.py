"""Main text of web pages by wrapper inference: union-free expressions aligned over the pages of a host.

A page's token stream (start tags with their classes, end tags, text) is read as nested groups; formatting tags
belong to the text around them. A wrapper is such a stream in which

* equal neighbouring groups, or equal neighbouring runs of two or three, are folded to a repeated group;
* aligning it with the next page's stream (longest common subsequence at every level) makes tokens that one of
  them lacks optional, folds what then repeats, and turns texts that differ into slots.

Every task aligns its pages of a host one after the other and emits one wrapper per host; these are aligned
per host. So a host with a third of all pages sends one row per task. The host's wrapper decides where
the main text is: all article, main or post groups, else all groups with text that differs between pages, links
not counted. Pages are then read through their host's wrapper (broadcast behind a check of
the number of hosts, joined beyond it): the text of those groups without menus, page headers, footers, sidebars,
notices, adverts, forms, scripts, styles and reader comments. Names mean this as whole names, and never for html, body,
main, article or a group with the main group inside. A page with little of its text there is its own wrapper.

Null html is an empty text; pages with a null or odd url share the host ''; null page_ids and repeated rows give a
row each; extra columns are dropped; broken, cut off or very long html is read as far as it goes; an empty
table gives an empty result.
"""

from __future__ import annotations

import bisect
import html as html_lib
import json
import re
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oddsframe.llm.common import materialise

SMALL = 0.25  # a host's path with less than this share of a page's text does not fit the page
BROADCAST_HOSTS = 200_000  # hosts (a short path each) whose wrappers may be broadcast

# The elements and names of HTML that the rules speak of.
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp "
                   "small span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe xmp".split())
DROPPED = frozenset("head script style noscript template iframe svg canvas object nav footer aside form button select "
                    "textarea dialog menu title".split())
KEPT = frozenset("html body main article".split())  # never dropped for a name
DROPPED_WORDS = frozenset(  # whole names, not parts of compounds: class 'with-sidebar' is no sidebar
    "ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion sidebar nav navbar "
    "navigation menu breadcrumb breadcrumbs footer comment comments reply replies disqus respond notice notices cookie "
    "cookies consent gdpr popup modal newsletter subscribe signup login share sharing social related recommended "
    "recommendations widget toolbar pagination pager alert disclaimer complementary contentinfo search share-buttons sharing-buttons "
    "social-links social-share nav-menu main-navigation post-navigation site-footer site-navigation cookie-banner "
    "cookie-notice cookie-consent comment-list comments-area comments-section comment-form related-posts "
    "related-articles ad-banner ad-container newsletter-signup widget-area search-form".split())
OUTER_WORDS = frozenset("header masthead topbar site-header page-header".split())  # dropped unless inside the main group
MAIN_WORDS = frozenset("article articlebody post entry story".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
          "th": {"td", "th"}, "option": {"option"}, "tbody": {"thead", "tbody", "tr", "td", "th"}}
DEEP = 200       # levels of groups that are kept; deeper ones become blocks of the group at that level
CELLS = 250_000  # comparisons of two levels above which they are aligned in time near their length
LOOK = 64        # items that an alignment of long levels skips at once
SCOPES = frozenset("ul ol dl table select article section div main body html".split())

_TAG = re.compile(r"<!--(?:.*?-->|.*\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>", re.S)
_ATTR = re.compile(r"(class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_CUT_OFF = re.compile(r"<[/!a-zA-Z][^>]*\Z")
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


class Group:
    """A start tag up to its end: ``sig`` names it, ``names`` are its whole names and ``words`` their parts, ``kids``
    are groups and texts ``(text, in a link)``; ``deep``: 1 if below ``DEEP`` levels, 2 if in a dropped group there."""

    __slots__ = ("tag", "sig", "names", "words", "kids", "deep")

    def __init__(self, tag: str, attrs: str) -> None:
        named = [(k.lower(), a or b or c) for k, a, b, c in _ATTR.findall(attrs)] if attrs else []
        self.names = frozenset(n.lower() for _, v in named for n in v.split())
        self.words = frozenset(w.lower() for _, v in named for w in _WORDS.findall(v))
        self.tag, self.kids, self.deep = tag, [], 0
        self.sig = tag + "".join("." + w for w in sorted(self.words))


def _nest(stack: list[Group], new: Group) -> None:
    """Open a group. Below ``DEEP`` levels its contents become blocks of the group at that level, so that no page nests
    without end; one that is dropped stays a group of its own there, and what it holds is dropped with it."""
    if len(stack) > DEEP and (stack[-1].deep == 2 or not dropped(new)):
        stack[-1].kids.append(("\n", False))
        new.kids, new.deep = stack[-1].kids, max(stack[-1].deep, 1)
    else:
        new.deep = 2 if len(stack) > DEEP else 0
        stack[-1].kids.append(new)
    stack.append(new)


def parse(page: str) -> Group:
    """The groups of a page."""
    root = Group("", "")
    stack, at, links = [root], 0, 0
    while True:
        m = _TAG.search(page, at)
        text = page[at:m.start()] if m else _CUT_OFF.sub("", page[at:])
        if text:
            stack[-1].kids.append((html_lib.unescape(text) if "&" in text else text, links > 0))
        if not m:
            return root
        at, name = m.end(), m[2]
        if name is None:
            continue
        name = name.lower()
        if name in INLINE:
            links = max(0, links + (-1 if m[1] else 1)) if name == "a" else links
        elif m[1]:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == name:
                    if stack[i].deep:
                        stack[i - 1].kids.append(("\n", False))
                    del stack[i:]
                    links = 0
                    break
            else:
                stack[-1].kids.append(("\n", False))
        elif name in VOID:
            stack[-1].kids.append(("\n", False))
        else:
            _close_implied(stack, name)
            new = Group(name, m[3])
            if name in RAW:
                stack[-1].kids.append(new)
                end = re.compile(f"</{re.escape(name)}[^>]*>", re.I).search(page, at)
                at = end.end() if end else len(page)
            elif not m[3].endswith("/") or name in ("div", "p"):
                _nest(stack, new)
            else:
                stack[-1].kids.append(new)


def _close_implied(stack: list[Group], name: str) -> None:
    if stack[-1].tag == "p":
        stack.pop()
    if name == "body":
        while len(stack) > 1 and stack[-1].tag != "html":
            stack.pop()
    ends = CLOSES.get(name)
    if ends:
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in ends:
                del stack[i:]
            elif stack[i].tag in SCOPES:
                break


def dropped(g: Group) -> int:
    """2: dropped for its tag; 1: for its name, unless the main group is inside; 0: stays."""
    return 2 if g.tag in DROPPED else 0 if g.tag in KEPT or g.names.isdisjoint(DROPPED_WORDS) else 1


# A wrapper item is a dict. Group: s (signature), d (dropped), h (dropped outside main groups), k (items). Repeated run of groups: g (items). Text: t (its
# checksum, or None for a slot), n (characters outside links), p (texts seen). All: o (optional), r (repeated).

def fold(g: Group) -> list[dict]:
    """A page's own wrapper: the items of a group, with neighbouring repeats folded."""
    items: list[dict] = []
    for kid in g.kids:
        if isinstance(kid, Group):
            items.append({"s": kid.sig, "d": dropped(kid), "h": int(_outer(kid)), "k": [] if kid.tag in RAW else fold(kid), "o": 0, "r": 0})
        elif text := " ".join(kid[0].split()):
            n = 0 if kid[1] else len(text)
            if items and "t" in items[-1]:
                items[-1]["t"] = zlib.crc32(text.encode("utf-8", "replace"), items[-1]["t"])
                items[-1]["n"] += n
            else:
                items.append({"t": zlib.crc32(text.encode("utf-8", "replace")), "n": n, "p": 1, "o": 0, "r": 0})
    return _repeats(items)


def _key(item: dict) -> str:
    return "#" if "t" in item else item["s"] if "s" in item else "(" + " ".join(map(_key, item["g"])) + ")"


def _merge(a: dict, b: dict) -> dict:
    """One item that covers both, which have the same key."""
    out = {"o": a["o"] | b["o"], "r": a["r"] | b["r"]}
    if "t" in a:
        return out | {"t": a["t"] if a["t"] == b["t"] else None, "n": a["n"] + b["n"], "p": a["p"] + b["p"]}
    if "g" in a:
        return out | {"g": [_merge(x, y) for x, y in zip(a["g"], b["g"])]}
    return out | {"s": a["s"], "d": a["d"], "h": a["h"], "k": align(a["k"], b["k"])}


def _repeats(items: list[dict]) -> list[dict]:
    for size in (1, 2, 3):
        out: list[dict] = []
        for item in items:
            out.append(item)
            while len(out) >= 2 * size and [_key(x) for x in out[-size:]] == [_key(x) for x in out[-2 * size:-size]]:
                one = [_merge(x, y) for x, y in zip(out[-2 * size:-size], out[-size:])]
                del out[-2 * size:]
                out.extend([one[0] | {"r": 1}] if size == 1 else [{"g": one, "o": 0, "r": 1}])
            if size > 1 and len(out) > size and "g" in out[-size - 1] and len(out[-size - 1]["g"]) == size and (
                    [_key(x) for x in out[-size:]] == [_key(x) for x in out[-size - 1]["g"]]):
                run = out[-size - 1]
                run = run | {"g": [_merge(x, y) for x, y in zip(run["g"], out[-size:])]}
                del out[-size - 1:]
                out.append(run)
        items = out
    return items


def align(a: list[dict], b: list[dict]) -> list[dict]:
    """One stream that covers both: common items merged, others optional, repeats folded."""
    ka, kb = [_key(x) for x in a], [_key(x) for x in b]
    if ka == kb:
        return [_merge(x, y) for x, y in zip(a, b)]
    if len(a) * len(b) > CELLS:
        return _repeats(_align_long(a, b, ka, kb))
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a) - 1, -1, -1):
        for j in range(len(b) - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if ka[i] == kb[j] else max(best[i + 1][j], best[i][j + 1])
    i, j, out = 0, 0, []
    while i < len(a) or j < len(b):
        if i < len(a) and j < len(b) and ka[i] == kb[j]:
            out.append(_merge(a[i], b[j]))
            i, j = i + 1, j + 1
        elif j == len(b) or i < len(a) and best[i + 1][j] >= best[i][j + 1]:
            out.append(a[i] | {"o": 1})
            i += 1
        else:
            out.append(b[j] | {"o": 1})
            j += 1
    return _repeats(out)


def _align_long(a: list[dict], b: list[dict], ka: list[str], kb: list[str]) -> list[dict]:
    """``align`` of long streams in time near their length: equal ends are merged; between them each item of ``b`` takes the first
    item of its key in ``a`` that is not yet passed, unless that skips more items than are left beside it."""
    n, m = len(a), len(b)
    head = next((i for i in range(min(n, m)) if ka[i] != kb[i]), min(n, m))
    tail = next((i for i in range(min(n, m) - head) if ka[n - 1 - i] != kb[m - 1 - i]), min(n, m) - head)
    places: dict[str, list[int]] = {}
    for i in range(head, n - tail):
        places.setdefault(ka[i], []).append(i)
    out, at = [_merge(x, y) for x, y in zip(a[:head], b[:head])], head
    for j in range(head, m - tail):
        here = places.get(kb[j], ())
        k = bisect.bisect_left(here, at)
        if k < len(here) and here[k] - at <= LOOK:
            out += [x | {"o": 1} for x in a[at:here[k]]]
            out.append(_merge(a[here[k]], b[j]))
            at = here[k] + 1
        else:
            out.append(b[j] | {"o": 1})
    out += [x | {"o": 1} for x in a[at:n - tail]]
    return out + [_merge(x, y) for x, y in zip(a[n - tail:], b[m - tail:])]


def expression(items: list[dict]) -> str:
    """The wrapper as a regular expression over tokens: #text slots, ( )? optional, ( )+ repeated."""
    out = []
    for x in items:
        body = ("#text" if x.get("t") is None else "text") if "t" in x else (
            f"<{x['s']}>{expression(x['k'])}</>" if "s" in x else expression(x["g"]))
        mark = {(0, 0): "", (1, 0): "?", (0, 1): "+", (1, 1): "*"}[(x["o"], x["r"])]
        out.append(f"({body}){mark}" if mark else body)
    return "".join(out)


def _mass(item: dict) -> int:
    """Characters of text that may be main text: outside links and dropped groups; texts that never
    differ over several pages count a tenth."""
    if "t" in item:
        return item["n"] if not _constant(item) else item["n"] // 10
    if "g" in item:
        return sum(map(_mass, item["g"]))
    return 0 if item["d"] else sum(map(_mass, item["k"]))


def _constant(item: dict) -> bool:
    return item["t"] is not None and item["p"] >= 3


def _own(item: dict) -> int:
    """Characters of text that no rule of the wrapper calls boilerplate: not dropped, no link, not constant."""
    if "t" in item:
        return 0 if _constant(item) else item["n"]
    return sum(map(_own, item["g"])) if "g" in item else 0 if item["d"] else sum(map(_own, item["k"]))


def _flat(items: list[dict]) -> Iterator[dict]:
    for x in items:
        if "g" in x:
            yield from _flat(x["g"])
        elif "s" in x:
            yield x


def _loose(items: list[dict]) -> int:
    """Characters of own text that stand in no group."""
    return sum(_loose(x["g"]) if "g" in x else _own(x) if "t" in x else 0 for x in items)


def main_paths(items: list[dict]) -> list[list[str]]:
    """Signatures from the root to each main group, in one list per group; empty: the whole page. A group inside one that is
    dropped for its name is main only if it holds more than all the rest of the page."""
    marked: list[tuple[int, int, list[str], bool]] = []

    def look(items: list[dict], path: list[str], hidden: bool) -> None:
        for x in _flat(items):
            if x["d"] == 2:
                continue
            here, below = path + [x["s"]], hidden or x["d"] == 1
            tag, *words = x["s"].split(".")
            rank = 2 if tag == "article" else 1 if tag == "main" or not MAIN_WORDS.isdisjoint(words) else 0
            if rank and (n := _mass(x)):
                marked.append((rank, n, here, below))
            look(x["k"], here, below)

    look(items, [], False)
    total = sum(map(_mass, items))
    clear = [x for x in marked if not x[3]] or [x for x in marked if x[1] > total]
    top = max((x[0] for x in clear), default=0)
    if clear and sum(n for r, n, _, _ in clear if r == top) >= SMALL * total:
        found: list[list[str]] = []
        for path in sorted((p for r, _, p, _ in clear if r == top), key=len):
            if not any(path[:len(p)] == p for p in found):
                found.append(path)
        return found
    path: list[str] = []
    while True:
        blocks = {}
        for x in _flat(items):
            if not x["d"] and not x["h"] and _own(x):
                blocks[x["s"]] = x
        loose = _loose(items)
        if not blocks:
            return [path] if path else []
        if len(blocks) == 1 and not loose:
            (sig, group), = blocks.items()
            if sum(x["s"] == sig for x in _flat(items)) == 1 and sig.split(".")[0] not in ("p", "li", "td"):
                path, items = path + [sig], group["k"]
                continue
        whole = sum(map(_mass, items)) == loose + sum(_own(x) for x in _flat(items) if not x["h"])
        return ([path] if path else []) if loose or whole else [path + [sig] for sig in blocks]


def main_path(items: list[dict]) -> list[str]:
    """The first of the main groups' paths; empty: the whole page."""
    return next(iter(main_paths(items)), [])


def _text(g: Group, out: list[str]) -> None:
    for kid in g.kids:
        if isinstance(kid, Group):
            if not dropped(kid):
                out.append("\n")
                _text(kid, out)
                out.append("\n")
        else:
            out.append(kid[0])


def _outer(g: Group) -> bool:
    return bool(dropped(g)) or g.tag == "header" or g.tag not in KEPT and not g.names.isdisjoint(OUTER_WORDS)


def _found(g: Group, paths: list[list[str]]) -> list[Group]:
    """The groups at the paths, in the order of the page."""
    out: list[Group] = []

    def walk(g: Group, left: list[list[str]]) -> None:
        for k in g.kids:
            if isinstance(k, Group) and (on := [p[1:] for p in left if p[0] == k.sig]):
                if [] in on:
                    out.append(k)
                else:
                    walk(k, on)

    walk(g, [p for p in paths if p])
    return out


def _chars(groups: list[Group]) -> int:
    """Characters of the groups' text outside links and groups that may be dropped."""
    n = 0
    for g in groups:
        n += sum(len(k[0].strip()) for k in g.kids if not isinstance(k, Group) and not k[1])
        n += _chars([k for k in g.kids if isinstance(k, Group) and not _outer(k)])
    return n


def extract(page: str, paths: list[list[str]] | None) -> str:
    """The main text of a page, its main groups at ``paths``. Where none is there, or the page has most of its text
    elsewhere, it is found by the page's own wrapper."""
    root = parse(page)
    groups = _found(root, paths) if paths else []
    if not groups or _chars(groups) < SMALL * _chars([root]):
        groups = _found(root, main_paths(fold(root))) or [root]
    out: list[str] = []
    for g in groups:
        if g.tag in ("", "html", "body"):
            g = _without(g, _outer)
        _text(g, out)
        out.append("\n")
    return " ".join("".join(out).split())


def _without(g: Group, drop) -> Group:
    new = Group(g.tag, "")
    new.kids = [_without(k, drop) if isinstance(k, Group) else k for k in g.kids if not (isinstance(k, Group) and drop(k))]
    return new


def host_of(url: F.Column) -> F.Column:
    found = F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return F.coalesce(found, F.lit(""))


def _per_task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    held: dict[str, list[dict]] = {}
    for b in batches:
        for host, page in zip(b["host"], b["html"]):
            if page:
                own = fold(parse(page))
                held[host] = align(held[host], own) if host in held else own
        if len(held) > 5000:
            yield _wrapper_rows(held)
            held = {}
    yield _wrapper_rows(held)


def _wrapper_rows(held: dict[str, list[dict]]) -> pd.DataFrame:
    return pd.DataFrame({"host": list(held), "wrapper": [json.dumps(w, separators=(",", ":")) for w in held.values()]}, dtype=object)


def _per_host(rows: pd.DataFrame) -> pd.DataFrame:
    whole: list[dict] | None = None
    for w in sorted(rows["wrapper"]):
        own = json.loads(w)
        whole = own if whole is None else align(whole, own)
    return pd.DataFrame({"host": [rows["host"].iloc[0]], "path": [json.dumps(main_paths(whole or []))],
                         "expression": [expression(whole or [])]}, dtype=object)


def wrappers(pages: DataFrame) -> DataFrame:
    """``(host, path, expression)``: the paths of a host's main groups, and its wrapper."""
    p = pages.select(host_of(F.col("url").cast("string")).alias("host"), F.col("html").cast("string").alias("html"))
    return (p.mapInPandas(_per_task, "host string, wrapper string").groupBy("host")
            .applyInPandas(_per_host, "host string, path string, expression string"))


def main_text(pages: DataFrame) -> DataFrame:
    """``(page_id, url, text, n_chars)`` per row."""
    places = materialise(wrappers(pages), "wrappers").select("host", "path")
    if places.count() <= BROADCAST_HOSTS:
        places = F.broadcast(places)

    @F.pandas_udf("string")
    def read(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for html, path in parts:
            yield pd.Series([extract(h, json.loads(p) if p else None) if h else "" for h, p in zip(html, path)], dtype=object)

    return (pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                         F.col("html").cast("string").alias("html"))
            .withColumn("host", host_of(F.col("url"))).join(places, "host", "left")
            .select("page_id", "url", read("html", "path").alias("text"))
            .withColumn("n_chars", F.char_length("text").cast("long")))

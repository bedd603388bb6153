"""HTML extraction by union-free wrappers inferred per host.

A page is read as a stream of tokens: block tags (with their first class or id)
and text slots; scripts, styles, comments and inline markup are no tokens.
Within a stream, neighbouring equal runs fold into repeated groups.  The
distinct folded streams of a host are then aligned one after the other into a
wrapper: a union-free regular expression in which a mismatch becomes an optional
group, a run that one side repeats becomes a repeated group, and texts become
slots.  Slots in menus, headers, footers, sidebars, notices, adverts, forms and
reader comments are boilerplate, but a form or a marked block that frames the
whole page is not (``frames``).  Each page is then matched against the wrapper,
so that each of its texts has a wrapper position; a text that stands at the same
position on most pages of the host is boilerplate too (outside of regions), and
other texts of that position are not.  A page with content slots in an article
(or main) region has its text there; a page without has it in its other slots,
whatever the other pages of its host look like.

Pages are read once, where they lie, and their texts outside of boilerplate are
written with the folded stream.  Distinct streams are few however many pages a
host has, so a host with a third of all pages costs the wrapper as much as a
small one.  The wrapper of a host is joined back to its pages under a salt.

``html`` null counts as empty: text empty, length 0.  A null or unparsable url
puts a page under the host ''.  Nothing is cut: broken or unclosed markup is read
as browsers do it for blocks; blocks nested below ``DEPTH`` keep their texts.  Every page's stream takes part in the inference,
and an alignment keeps what it aligns, so the wrapper covers every page.
Repeated rows give the same row each; extra columns are not read.
"""

from __future__ import annotations

import functools
import hashlib
import html as entities
import json
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emporia.llm.common import written

BLOCKS = frozenset(("address article aside blockquote body button canvas caption center col colgroup dd details dialog dir div dl dt fieldset "
                    "figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html iframe legend li main menu nav "
                    "noscript object ol option p pre search section select summary table tbody td template textarea tfoot th thead "
                    "title tr ul").split())
RAW = ("script", "style", "template", "svg", "math", "noscript", "iframe", "textarea", "select", "button", "title", "object", "canvas")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: An opening tag of the first kind closes an open one of the second.
CLOSES_P = BLOCKS - {"html", "head", "body", "title"}
BOILER_TAGS = frozenset("nav header footer aside menu form fieldset dialog search head figcaption".split())
BOILER_NAMES = re.compile(r"(^|[-_ ])(ads?|advert\w*|banner|promo\w*|sponsor\w*|comments?|replies|disqus|cookie\w*|notice\w*|consent|popup|modal|"
                          r"newsletter|subscribe|signup|login|search|share|social|sidebar|side|widget|related|recommend\w*|breadcrumbs?|menu|"
                          r"nav\w*|footer|header|masthead|toolbar|pagination|pager|alert|skip)([-_ ]|$)", re.I)
#: A class that says what its block has or lacks does not say what the block is.
SAYS_OF = re.compile(r"(has|with|without|no|not|hide|show)[-_]", re.I)
#: Marks of lists within a page; a block with one of them is never the frame of a page.
LISTS = re.compile(r"(^|[-_ ])(comments?|replies|disqus|related|recommend\w*|widget)([-_ ]|$)", re.I)
REGIONS = ("article", "main")
#: Blocks below this depth share the group of the block that holds them there; their names and texts all count.
DEPTH = 128
TOKEN = re.compile(r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*>?|<(/?)([A-Za-z][A-Za-z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<(/?)([A-Za-z][A-Za-z0-9:-]*)[^<>]*$", re.S)
ATTRIBUTE = re.compile(r"([A-Za-z_:-]+)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)")
SPACE = re.compile(r"\s+")
SALTS = 64
#: A text that stands in one slot on this share of a host's pages (and on at least so many) is boilerplate.
SAME_SHARE, SAME_PAGES = 0.6, 8


def _name(tag: str, attributes: str) -> str:
    """The token of an opening tag: its name, role, first class and id where they matter."""
    if not attributes:
        return tag
    found = {k.lower(): v.strip("\"'") for k, v in ATTRIBUTE.findall(attributes)}
    marks = [v for k in ("class", "id", "role") for v in found.get(k, "").split()]
    boiler = next((m for m in marks if BOILER_NAMES.search(m) and not SAYS_OF.match(m)), None)
    if boiler and tag not in REGIONS and tag not in ("html", "body"):
        return f"{tag}.{boiler.lower()}"
    if found.get("role", "").lower() == "main":
        return "main"
    return tag


def tokens(page: str) -> Iterator[tuple[str, str, str]]:
    """(kind, token, text) of a page: ``open``/``close`` of a block, or ``text``; unclosed blocks are closed as needed."""
    stack: list[tuple[str, str]] = []
    text: list[str] = []
    at, n = 0, len(page)

    def flush() -> Iterator[tuple[str, str, str]]:
        if text:
            t = SPACE.sub(" ", entities.unescape("".join(text))).strip()
            text.clear()
            if t:
                yield "text", "#", t

    while at < n:
        m = TOKEN.search(page, at)
        if not m:
            text.append(page[at:])
            break
        text.append(page[at : m.start()])
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            continue
        if m[1] or m[4]:
            if tag in BLOCKS and any(t == tag for t, _ in stack):
                yield from flush()
                while stack:
                    t, name = stack.pop()
                    yield "close", name, ""
                    if t == tag:
                        break
            elif tag == "p":  # a stray end tag still ends the block
                yield from flush()
            continue
        if tag == "br":
            text.append("\n")
            continue
        if tag in RAW and not (m[3] or "").endswith("/"):
            end = re.compile(rf"</{tag}\b[^>]*>?", re.I).search(page, at)
            if tag in BLOCKS:
                yield from flush()
            at = end.end() if end else n
            continue
        if tag not in BLOCKS:
            continue
        yield from flush()
        for inner, outer in (("p", CLOSES_P), ("li", {"li"}), ("dt", {"dt", "dd"}), ("dd", {"dt", "dd"}), ("tr", {"tr"}), ("td", {"td", "th", "tr"}),
                             ("th", {"td", "th", "tr"}), ("option", {"option"})):
            if stack and stack[-1][0] == inner and tag in outer:
                yield "close", stack.pop()[1], ""
        name = _name(tag, m[3] or "")
        yield "open", name, ""
        if tag in VOID or (m[3] or "").endswith("/") and tag in ("hr", "col"):
            yield "close", name, ""
        else:
            stack.append((tag, name))
    yield from flush()
    while stack:
        yield "close", stack.pop()[1], ""


def frames(events: list[tuple[str, str, str]]) -> set[int]:
    """The opening events of blocks that look like boilerplate by name but frame the page.

    A form or a block with such a class or id is a frame if it holds half of the page's text or more and
    every article and main region of the page, or, on a page without regions, a footer and a header or menu.
    """
    total = {"text": 0, "region": 0, "top": 0, "footer": 0}
    opened: list[tuple[int, dict]] = []
    marked: list[tuple[int, dict]] = []
    for at, (kind, name, text) in enumerate(events):
        if kind == "open":
            opened.append((at, dict(total)))
            sort = "region" if name in REGIONS else "top" if name in ("header", "nav") else name
            if sort in total:
                total[sort] += 1
        elif kind == "text":
            total["text"] += len(text)
        else:
            at, before = opened.pop()
            name = events[at][1]
            if name in ("form", "fieldset") or "." in name and name.split(".")[0] not in BOILER_TAGS - {"form", "fieldset"} and not LISTS.search(name.split(".", 1)[1]):
                marked.append((at, {k: total[k] - n for k, n in before.items()}))
    return {at for at, held in marked if 2 * held["text"] >= total["text"] > 0 and (
        held["region"] == total["region"] if total["region"] else held["top"] and held["footer"])}


# ---- union-free expressions: nested lists [name, children, optional, repeated, texts]; text slots are named '#' and hold the numbers of their texts ----
def tree(page: str) -> tuple[list, list[tuple[tuple[str, ...], str]]]:
    """The folded stream of a page and its texts with their paths of names."""
    events = list(tokens(page))
    frame = frames(events)
    root: list = ["", [], False, False, []]
    stack, names, texts = [root], [], []
    for at, (kind, name, text) in enumerate(events):
        if kind == "open":
            names.append("div" if at in frame else name)
            if len(names) <= DEPTH:
                node = [names[-1], [], False, False, []]
                stack[-1][1].append(node)
                stack.append(node)
        elif kind == "close":
            if len(names) <= DEPTH:
                node = stack.pop()
                node[1] = fold(node[1])
            names.pop()
        else:
            stack[-1][1].append(["#", [], False, False, [len(texts)]])
            texts.append((tuple(names), text))
    root[1] = fold(root[1])
    return root, texts


def bare(node: list) -> list:
    """A folded stream without its texts: what pages of one template share."""
    return [node[0], [bare(c) for c in node[1]], node[2], node[3], []]


def joined(a: list, b: list) -> list:
    return [a[0], align(a[1], b[1]), a[2] or b[2], a[3] or b[3], a[4] + b[4]]


def fold(children: list) -> list:
    """Neighbours with one name become one repeated group whose content is their alignment."""
    out: list = []
    for c in children:
        if out and out[-1][0] == c[0]:
            out[-1] = joined(out[-1], c)
            out[-1][2:4] = False, True
        else:
            out.append(c)
    return out


def align(a: list, b: list) -> list:
    """Align two sequences of groups: common names stay, mismatches become optional, repetitions join."""
    names_a, names_b = [x[0] for x in a], [x[0] for x in b]
    if names_a == names_b:
        return [joined(x, y) for x, y in zip(a, b, strict=True)]
    # Longest common subsequence of names.
    n, m = len(a), len(b)
    best = [[0] * (m + 1) for _ in range(n + 1)]
    for i in range(n - 1, -1, -1):
        for j in range(m - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if names_a[i] == names_b[j] else max(best[i + 1][j], best[i][j + 1])
    out, i, j = [], 0, 0
    while i < n or j < m:
        if i < n and j < m and names_a[i] == names_b[j]:
            out.append(joined(a[i], b[j]))
            i, j = i + 1, j + 1
        elif j >= m or (i < n and best[i + 1][j] >= best[i][j + 1]):
            out.append([*a[i][:2], True, *a[i][3:]])
            i += 1
        else:
            out.append([*b[j][:2], True, *b[j][3:]])
            j += 1
    # A group that now stands twice in a row is one repeated group.
    return fold(out)


def numbered(children: list, start: int = 0) -> list[tuple]:
    """(name, children, first slot, slots) of the groups that have slots, numbered from left to right."""
    out, at = [], start
    for c in children:
        inner = [] if c[0] == "#" else numbered(c[1], at)
        n = 1 if c[0] == "#" else sum(x[3] for x in inner)
        if n:
            out.append((c[0], inner, at, n))
        at += n
    return out


def match(page: list[tuple], wrapper: list[tuple]) -> list[tuple[int, int]]:
    """(slot of the page's stream, slot of the wrapper) in the order-keeping match that covers most slots, leftmost first."""
    n, m = len(page), len(wrapper)
    pairs: dict[tuple[int, int], list] = {}

    def pair(i: int, j: int) -> list:
        got = pairs.get((i, j))
        if got is None:
            x, y = page[i], wrapper[j]
            got = pairs[i, j] = [] if x[0] != y[0] else [(x[2], y[2])] if x[0] == "#" else match(x[1], y[1])
        return got

    if [x[0] for x in page] == [y[0] for y in wrapper]:
        straight = [pair(i, i) for i in range(n)]
        if all(len(p) == x[3] for p, x in zip(straight, page, strict=True)):
            return [q for p in straight for q in p]
    best = [[0] * (m + 1) for _ in range(n + 1)]
    for i in range(n - 1, -1, -1):
        for j in range(m - 1, -1, -1):
            best[i][j] = max(best[i + 1][j], best[i][j + 1], len(pair(i, j)) + best[i + 1][j + 1])
    out, i, j = [], 0, 0
    while i < n and j < m:
        if pair(i, j) and best[i][j] == len(pair(i, j)) + best[i + 1][j + 1]:
            out += pair(i, j)
            i, j = i + 1, j + 1
        elif best[i][j] == best[i][j + 1]:
            j += 1
        else:
            i += 1
    return out


def boilerplate(path: tuple[str, ...]) -> bool:
    return any(p.split(".")[0] in BOILER_TAGS or "." in p for p in path)


def _inside(path: tuple[str, ...]) -> tuple[str, ...]:
    """A header within the article is the article's own; boilerplate counts below the innermost region or above it."""
    at = max((i for i, p in enumerate(path) if p in REGIONS), default=-1)
    return tuple(p for i, p in enumerate(path) if not (i > at >= 0 and p in ("header", "figcaption")))


@functools.lru_cache(1 << 16)
def place(path: tuple[str, ...]) -> int:
    """0: boilerplate, 1: content outside of a region, 2: content in a region."""
    return 0 if boilerplate(_inside(path)) else 2 if any(r in path for r in REGIONS) else 1


def digest(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def _host():
    return F.coalesce(F.lower(F.regexp_extract("url", r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]*)", 1)), F.lit(""))


PARSED = "page_id long, url string, host string, salt int, stream string, slots array<int>, places array<int>, texts array<string>"


def parse(pages: DataFrame) -> DataFrame:
    """Each page's folded stream and its texts outside of boilerplate, with their slots in that stream."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for page_id, url, host, salt, page in zip(b["page_id"], b["url"], b["host"], b["salt"], b["html"], strict=True):
                root, texts = tree(page)
                slot, at, todo = [0] * len(texts), 0, root[1][::-1]
                while todo:
                    node = todo.pop()
                    if node[0] == "#":
                        for i in node[4]:
                            slot[i] = at
                        at += 1
                    todo += node[1][::-1]
                kept = [(k, p, t) for k, (path, t) in zip(slot, texts, strict=True) if (p := place(path))]
                out.append((page_id, url, host, salt, json.dumps(bare(root)), *([x[c] for x in kept] for c in range(3))))
            yield pd.DataFrame(out, columns=["page_id", "url", "host", "salt", "stream", "slots", "places", "texts"])

    rows = pages.select("page_id", "url", _host().alias("host"), F.pmod(F.xxhash64("page_id", "html"), F.lit(SALTS)).cast("int").alias("salt"),
                        F.coalesce("html", F.lit("")).alias("html"))
    return written(pages.sparkSession, rows.mapInPandas(run, PARSED), "html-pages")


def infer(parsed: DataFrame) -> DataFrame:
    """(host, wrapper) of parsed pages."""

    def merge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Align the streams of a host (sorted together) into one wrapper, one stream at a time."""
        host, wrapper = None, None
        for b in batches:
            out = []
            for h, stream in zip(b["host"], b["stream"], strict=True):
                t = json.loads(stream)
                if h == host and wrapper is not None:
                    wrapper = joined(wrapper, t)
                else:
                    if wrapper is not None:
                        out.append((host, json.dumps(wrapper)))
                    host, wrapper = h, t
            yield pd.DataFrame(out, columns=["host", "wrapper"])
        if wrapper is not None:
            yield pd.DataFrame([(host, json.dumps(wrapper))], columns=["host", "wrapper"])

    streams = parsed.select("host", "stream").distinct()
    # Two levels: partial wrappers by salt, then one per host; both stream through sorted partitions.
    partial = streams.withColumn("salt", F.pmod(F.xxhash64("stream"), F.lit(SALTS))).withColumn("host", F.concat_ws("\x01", "salt", "host"))
    partial = partial.repartition("host").sortWithinPartitions("host", "stream").select("host", "stream").mapInPandas(merge, "host string, wrapper string")
    whole = (partial.select(F.expr("substr(host, instr(host, '\x01') + 1)").alias("host"), F.col("wrapper").alias("stream"))
             .repartition("host").sortWithinPartitions("host", "stream").mapInPandas(merge, "host string, wrapper string"))
    return written(parsed.sparkSession, whole, "html-wrappers")


class Matcher:
    """Wrapper slots of the texts of pages; the last wrapper and its streams are remembered."""

    def __init__(self):
        self.wrapper, self.groups, self.known = None, [], {}

    def slots(self, wrapper: str, stream: str, own: list[int]) -> list[int]:
        if wrapper != self.wrapper:
            self.wrapper, self.groups, self.known = wrapper, numbered(json.loads(wrapper)[1]), {}
        got = self.known.get(stream)
        if got is None:
            got = dict(match(numbered(json.loads(stream)[1]), self.groups))
            if len(self.known) < 10_000:
                self.known[stream] = got
        return [got[k] for k in own]


def _salted(df: DataFrame) -> DataFrame:
    return df.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))


def constants(parsed: DataFrame, wrappers: DataFrame) -> DataFrame:
    """(host, constant): the wrapper slots of each host with the digests of the texts that most of its pages have there."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        matcher = Matcher()
        for b in batches:
            out = []
            for host, wrapper, stream, own, places, texts in zip(b["host"], b["wrapper"], b["stream"], b["slots"], b["places"], b["texts"], strict=True):
                # Texts outside of the regions are candidates for constant boilerplate; a page counts once.
                at = matcher.slots(wrapper, stream, own)
                out += [(host, k, h) for k, h in {(k, digest(t)) for k, p, t in zip(at, places, texts, strict=True) if p == 1}]
            yield pd.DataFrame(out, columns=["host", "slot", "text"])

    pages_of = parsed.groupBy("host").agg(F.count("*").alias("pages"))
    counted = (parsed.where(F.array_contains("places", 1)).join(_salted(wrappers), ["host", "salt"])
               .select("host", "wrapper", "stream", "slots", "places", "texts")
               .mapInPandas(run, "host string, slot int, text long").groupBy("host", "slot", "text").agg(F.count("*").alias("n")))
    return (counted.join(pages_of, "host").where((F.col("n") >= SAME_PAGES) & (F.col("n") >= SAME_SHARE * F.col("pages")))
            .groupBy("host").agg(F.collect_list(F.struct("slot", "text")).alias("constant"))
            .select("host", F.col("constant.slot").alias("constant_slots"), F.col("constant.text").alias("constant_texts")))


def extract(pages: DataFrame) -> DataFrame:
    """One row per page: page_id, url, text, n_chars."""
    parsed = parse(pages)
    wrappers = infer(parsed)
    wrappers = written(pages.sparkSession, wrappers.join(constants(parsed, wrappers), "host", "left"), "html-constants")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        matcher = Matcher()
        for b in batches:
            out = []
            for page_id, url, wrapper, slots, digests, stream, own, places, texts in zip(
                    b["page_id"], b["url"], b["wrapper"], b["constant_slots"], b["constant_texts"], b["stream"], b["slots"], b["places"], b["texts"], strict=True):
                if 2 in places:
                    good = [t for p, t in zip(places, texts, strict=True) if p == 2]
                elif slots is None:
                    good = texts
                else:
                    constant = set(zip(slots, digests, strict=True))
                    good = [t for k, t in zip(matcher.slots(wrapper, stream, own), texts, strict=True) if (k, digest(t)) not in constant]
                text = "\n".join(good)
                out.append((page_id, url, text, len(text)))
            yield pd.DataFrame(out, columns=["page_id", "url", "text", "n_chars"])

    return (parsed.join(_salted(wrappers), ["host", "salt"])
            .select("page_id", "url", "wrapper", "constant_slots", "constant_texts", "stream", "slots", "places", "texts")
            .mapInPandas(run, "page_id long, url string, text string, n_chars long"))

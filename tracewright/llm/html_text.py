"""Main text of web pages by wrappers inferred per host: token streams of pages aligned into a regular expression.

A page is a stream of tags and texts. The wrapper of a host is a sequence of items: a tag or text
that every page has there, a slot whose text differs, an optional group (on some pages only) or a repeated group
(square: the same items one or more times). It starts as one page's stream and is aligned with
one page after another; texts that mismatch become slots, tags that mismatch become repeated
groups where the block before the mismatch is a square, else optional ones. There is no union of
alternatives. Only the frame of a page is aligned - the stream with each content element folded to
one item - because that is what pages of a host share.

The wrapper then tells template from content: text that all pages of the host share is
template. Elements whose role is no content (menus, headers, footers, sidebars, notices, adverts, forms,
scripts, styles, comments) are left out on every page, also where a host has one page only. One that holds
more than half of the text of article and main, or of a page without them, is layout and never left out.

All pages of a host take part, in a tree: its different frames are dealt by hash into groups of about `PAGES_PER_WRAPPER`, each
group gives one wrapper, and the wrappers of a host are merged in groups again until one is left. What is optional or
repeated in either of two wrappers is so in both. Every page is extracted, whole, by its host's wrapper.

Defined cases: null or empty html has no text; a null url makes a host of its own; markup that is cut
off, or never closed, ends with the page; a reference that is not known stays as it is written; repeated
rows give the same text each; other columns are not looked at.
"""

from __future__ import annotations

import html
import json
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewright.session import materialize

# Fixed value: so many frames or wrappers are merged by one task.
PAGES_PER_WRAPPER = 24
MIN_PAGES = 3
# Alignments of more cells than this are cut in two at the middle of the wrapper, so their memory is bounded.
CELLS = 1 << 26

VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title noscript template iframe svg math xmp noembed noframes".split())
DROPPED = RAW | set("head nav header footer aside form button select option fieldset dialog menu object canvas audio video".split())
BLOCKS = set(
    "address article blockquote body br caption center dd details div dl dt figcaption figure h1 h2 h3 h4 h5 h6 hr html li "
    "main ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
# Words in class, id or role that name a part which is no content.
NOT_CONTENT = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|adsense|adslot|banner|sponsor\w*|promo\w*|nav\w*|menu\w*|breadcrumbs?|header|masthead|footer|"
    r"sidebar\w*|aside|widgets?|notices?|cookies?|consent|gdpr|popup|modal|overlay|newsletter|subscribe|signup|login|share|sharing|"
    r"social|related|recommend\w*|comments?|commentlist|disqus|respond|replies|reply|pagination|pager|toolbar|search|alert|complementary|"
    r"contentinfo|navigation)(?:$|[\s_-])",
    re.I,
)
# Words that tell a state of the page, such as `with-sidebar` or `comments-open`, name no part.
STATE = re.compile(r"(?<!\S)(?:(?:with|without|no|has)[-_]\S+|\S+[-_](?:open|closed|enabled|disabled))(?!\S)", re.I)
CONTENT = set("article main".split())
# Elements that are never content for the share of the page's text they hold.
NEVER_MOST = RAW | set("head nav header footer aside menu dialog".split())

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<![^>]*(?:>|\Z)|<\?[^>]*(?:>|\Z)|<(/?)([A-Za-z][A-Za-z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|aria-hidden|style)\s*(?:=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?", re.I)
_SPACE = re.compile(r"\s+")


def tokens(page: str) -> Iterator[tuple[str, str, str]]:
    """(kind, name or text, attributes): kinds are open, close and text; raw elements give no text."""
    at, n = 0, len(page)
    while at < n:
        lt = page.find("<", at)
        m = _TOKEN.match(page, lt) if lt >= 0 else None
        while lt >= 0 and m is None:  # a bare `<` is text
            lt = page.find("<", lt + 1)
            m = _TOKEN.match(page, lt) if lt >= 0 else None
        if lt < 0:
            yield "text", page[at:], ""
            return
        if lt > at:
            yield "text", page[at:lt], ""
        at = m.end()
        name = (m.group(2) or "").lower()
        if not name:
            continue
        if m.group(1):
            yield "close", name, ""
            continue
        yield "open", name, m.group(3) or ""
        if name in RAW and not (m.group(3) or "").rstrip().endswith("/"):
            end = re.compile(rf"</{re.escape(name)}\b[^>]*(?:>|\Z)", re.I).search(page, at)
            at = end.end() if end else n
            yield "close", name, ""


def hidden(attributes: str) -> bool:
    for key, value in _ATTRIBUTE.findall(attributes):
        key, value = key.lower(), value.strip("\"'")
        if key == "hidden" or key == "aria-hidden" and value.lower() == "true":
            return True
        if key == "style" and re.search(r"display\s*:\s*none", value, re.I):
            return True
    return False


def no_content(name: str, attributes: str) -> bool:
    if name in DROPPED:
        return True
    if not attributes or name in ("html", "body"):
        return False
    for key, value in _ATTRIBUTE.findall(attributes):
        key, value = key.lower(), value.strip("\"'")
        if key in ("class", "id", "role") and name not in CONTENT and NOT_CONTENT.search(STATE.sub(" ", value)):
            return True
    return hidden(attributes)


def text_of(raw: str) -> str:
    return _SPACE.sub(" ", html.unescape(raw))


def closing(stack: list[str], name: str) -> int:
    """The place in the stack of open elements that an end tag closes; those behind it end as well."""
    return len(stack) - 1 - stack[::-1].index(name)


def around_content(stream: list[tuple[str, str, str]]) -> set[int]:
    """Places of start tags whose role is no content but that hold more than half of the text of all article and main
    elements or, on a page without them, of the page: they are layout around the content."""
    stack: list[str] = []
    opened: list[tuple[int, int, int]] = []  # per open element its place, and text in content and in all before it
    held: list[tuple[int, str, int, int]] = []
    inside = within = total = 0

    def end(last: int) -> None:
        nonlocal inside
        while len(stack) > last:
            name, (at, one, two) = stack.pop(), opened.pop()
            inside -= name in CONTENT
            held.append((at, name, within - one, total - two))

    for at, (kind, name, attributes) in enumerate(stream):
        if kind == "text":
            n = len(_SPACE.sub("", name))
            total += n
            within += n if inside else 0
        elif kind == "open":
            if name not in VOID and not attributes.rstrip().endswith("/"):
                stack.append(name)
                opened.append((at, within, total))
                inside += name in CONTENT
        elif name in stack:
            end(closing(stack, name))
    end(0)
    if within:
        return {at for at, name, one, _ in held if name not in RAW and 2 * one > within and not hidden(stream[at][2])}
    return {at for at, name, _, two in held if name not in NEVER_MOST and 2 * two > total and not hidden(stream[at][2])}


class Page:
    """The blocks of a page outside of elements that are no content, and the frame around them."""

    def __init__(self, page: str):
        self.blocks: list[tuple[str, bool, tuple[str, ...]]] = []  # text, inside article or main, path
        self.frame: list[str] = []
        stack: list[str] = []
        skip = 0  # depth of the outermost element that is no content, 0 if there is none
        inside = 0
        run: list[str] = []

        def close_block() -> None:
            text = text_of("".join(run)).strip()
            run.clear()
            if text:
                path = tuple(stack[-3:])
                self.blocks.append((text, inside > 0, path))
                if not inside:
                    self.frame.append("#" + text)
                elif self.frame[-1:] != ["#"]:  # content is one item of the frame
                    self.frame.append("#")

        stream = list(tokens(page))
        layout = around_content(stream)
        for at, (kind, name, attributes) in enumerate(stream):
            if kind == "text":
                if not skip:
                    run.append(name)
                continue
            if kind == "open":
                if not skip and (name in BLOCKS or name in DROPPED or no_content(name, attributes)):
                    close_block()
                if name in VOID or attributes.rstrip().endswith("/"):
                    continue
                stack.append(name)
                if not skip:
                    if no_content(name, attributes) and at not in layout:
                        skip = len(stack)
                    elif name in CONTENT:
                        inside += 1
                    if not inside:
                        self.frame.append("<" + name)
                continue
            if name not in stack:
                if not skip and name in BLOCKS:
                    close_block()
                continue
            if not skip and name in BLOCKS | DROPPED:
                close_block()
            # Closing an element closes those inside of it that are still open, but a stray end
            # tag inside of a part that is no content does not end that part.
            last = closing(stack, name)
            if skip and last + 1 > skip or not skip or last + 1 <= skip:
                for gone in stack[last:][::-1]:
                    depth = len(stack)
                    if skip and depth == skip:
                        skip = 0
                    elif not skip:
                        if gone in CONTENT and inside:
                            inside -= 1
                        if not inside:
                            self.frame.append(">" + gone)
                    stack.pop()
        if not skip:
            close_block()


# ---- wrappers: items are ("tag", x), ("text", x), ("slot",), ("opt", items), ("rep", items)


def start(frame: list[str]) -> list[tuple]:
    return [("text", x) if x.startswith("#") and len(x) > 1 else ("slot",) if x == "#" else ("tag", x) for x in frame]


def _flat(items: list[tuple]) -> list[tuple]:
    return [x for item in items for x in (_flat(item[1]) if item[0] in ("opt", "rep") else [item])]


def _leaves(items: list[tuple]) -> tuple[list[tuple], list[tuple | None]]:
    """The leaves of a wrapper, and for each the group it stands in."""
    leaves, spans = [], []
    for item in items:
        own = _flat([item])
        leaves += own
        spans += [item if item[0] in ("opt", "rep") else None] * len(own)
    return leaves, spans


def _scores(one: np.ndarray, two: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Best scores of one[i:] with all two[j:], for i from the end of one, and what the items at i and each j score.

    Items are pairs of a number that fitting ones share and one that equal ones share: 2 for items that fit, 3 for equal ones.
    """
    below = np.zeros(len(two) + 1, np.int32)
    yield below, below[1:]
    for kind, item in one[::-1]:
        score = 2 * (two[:, 0] == kind) + (two[:, 1] == item)
        row = below.copy()
        np.maximum(row[:-1], np.where(score > 0, below[1:] + score, 0), out=row[:-1])
        below = np.maximum.accumulate(row[::-1])[::-1]
        yield below, score


def _matches(one: np.ndarray, two: np.ndarray) -> list[tuple[int, int]]:
    """Places of the common subsequence of the best score, as early as can be."""
    n, m = len(one), len(two)
    other = np.flatnonzero((one[: min(n, m)] != two[: min(n, m)]).any(axis=1))
    same = int(other[0]) if len(other) else min(n, m)
    if same:
        return [(k, k) for k in range(same)] + [(i + same, j + same) for i, j in _matches(one[same:], two[same:])]
    if not n or not m:
        return []
    if n > 1 and n * m > CELLS:
        half = n // 2
        for front, _ in _scores(one[:half][::-1], two[::-1]):
            pass
        for back, _ in _scores(one[half:], two):
            pass
        cut = int(np.argmax(front[::-1] + back))
        return _matches(one[:half], two[:cut]) + [(i + half, j + cut) for i, j in _matches(one[half:], two[cut:])]
    take, down = np.zeros((2, n, (m + 7) // 8), np.uint8)  # whether to take both items, or else to go on in one
    rows = _scores(one, two)
    below, _ = next(rows)
    for i, (row, score) in zip(range(n - 1, -1, -1), rows, strict=True):
        take[i] = np.packbits((score > 0) & (row[:-1] == below[1:] + score))
        down[i] = np.packbits(below[:-1] >= row[1:])
        below = row
    found, i, j = [], 0, 0
    while i < n and j < m:
        if take[i, j >> 3] >> (7 - (j & 7)) & 1:
            found.append((i, j))
            i, j = i + 1, j + 1
        elif down[i, j >> 3] >> (7 - (j & 7)) & 1:
            i += 1
        else:
            j += 1
    return found


def align(wrapper: list[tuple], page: list[tuple]) -> list[tuple]:
    """The wrapper made more general so that it also reads what a page, or another wrapper, reads.

    The longest common subsequence of fitting items is kept in place, of equally long ones the one with the most equal
    texts; between two of its items, a rest that repeats what stands before it becomes a repeated group, and any
    other rest an optional one. Equal tags fit, and so do any two texts.
    """
    left, spans = _leaves(wrapper)
    right, groups_of = _leaves(page)
    numbers: dict[tuple, int] = {}

    def number(x: tuple) -> int:
        return numbers.setdefault(x, len(numbers))

    one, two = (
        np.array([(number(x if x[0] == "tag" else ("slot",)), number(x)) for x in side], np.int32).reshape(-1, 2) for side in (left, right)
    )
    out: list[tuple] = []
    placed: set[int] = set()

    def place(group: tuple) -> None:
        if id(group) not in placed:
            placed.add(id(group))
            _add(out, *group)

    def settle(leaves: list[tuple], groups: list[tuple | None]) -> None:
        rest: list[tuple] = []
        for x, group in zip(leaves, groups, strict=True):
            if group is None:
                rest.append(x)
                continue
            if rest:
                _add(out, "opt", rest)
                rest = []
            place(group)
        if rest:
            _add(out, "opt", rest)

    i = j = 0
    for a, b in [*_matches(one, two), (len(left), len(right))]:
        settle(left[i:a], spans[i:a])
        settle(right[j:b], groups_of[j:b])
        i, j = a + 1, b + 1
        if a == len(left):
            break
        group = spans[a] if spans[a] is not None else groups_of[b]
        if group is not None:  # what is a group in one of them stays a group
            place(group)
        else:
            out.append(left[a] if left[a] == right[b] else ("slot",))
    return out


def _add(out: list[tuple], kind: str, items: list[tuple]) -> None:
    """Appends a group; one that repeats the items just before it is a repeated group, and these stay as they are."""
    size = len(items)
    shape = [x if x[0] == "tag" else ("slot",) for x in items]
    if out and out[-1][0] == "rep" and [x if x[0] == "tag" else ("slot",) for x in out[-1][1]] == shape:
        return
    before = out[-size:]
    if kind == "opt" and len(before) == size and [x if x[0] == "tag" else ("slot",) for x in before] == shape:
        out.append(("rep", shape))
        return
    if out and out[-1] == (kind, items):
        return
    out.append((kind, items))


def infer(frames: list[list[str]]) -> list[tuple]:
    return merged([start(frame) for frame in frames])


def merged(wrappers_of: list[list[tuple]]) -> list[tuple]:
    """One wrapper that reads what any of them reads."""
    out = wrappers_of[0] if wrappers_of else []
    for other in wrappers_of[1:]:
        out = align(out, other)
    return out


def _read(text: str) -> list[tuple]:
    """A wrapper that was written as JSON."""

    def items(x: list) -> list[tuple]:
        return [(kind, items(rest[0])) if kind in ("opt", "rep") else (kind, *rest) for kind, *rest in x]

    return items(json.loads(text))


def template_texts(wrapper: list[tuple]) -> list[str]:
    """Texts that stand on every page of the host, outside of its content elements."""
    return sorted({item[1][1:] for item in wrapper if item[0] == "text"})


def extract(page: str | None, template: set[str]) -> str:
    """The main text: the blocks inside of article or main if there are any, else all that is no template."""
    if not page:
        return ""
    blocks = Page(page).blocks
    if any(inside for _, inside, _ in blocks):
        blocks = [b for b in blocks if b[1]]
    else:
        blocks = [b for b in blocks if b[0] not in template]
    return "\n".join(text for text, _, _ in blocks)


def host_of(url: Column) -> Column:
    return F.coalesce(F.lower(F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))


def frames(pages: DataFrame, url: str = "url", page: str = "html") -> DataFrame:
    """(host, wrapper): the different frames of the hosts with at least `MIN_PAGES` different pages, each as a wrapper in JSON.

    Pages are parsed where they are; of the pages that have a frame as many are named as the count needs.
    """
    rows = pages.select(host_of(F.col(url)).alias("host"), F.xxhash64(url, page).alias("k"), F.col(page).alias("h")).filter("h <> ''")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found: dict[tuple[str, str], set[int]] = {}
            for host, k, h in zip(batch["host"], batch["k"], batch["h"], strict=True):
                some = found.setdefault((host, json.dumps(start(Page(h).frame))), set())
                if len(some) < MIN_PAGES:
                    some.add(k)
            yield pd.DataFrame([(a, b, sorted(some)) for (a, b), some in found.items()], columns=["host", "wrapper", "some"])

    parts = rows.mapInPandas(run, "host string, wrapper string, some array<bigint>")
    some = F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_set("some")))), 1, MIN_PAGES)
    each = materialize(parts.groupBy("host", "wrapper").agg(some.alias("some")))
    known = each.select("host", F.explode("some").alias("k")).distinct().groupBy("host").agg(F.count("*").alias("n"))
    return each.drop("some").join(known.filter(F.col("n") >= MIN_PAGES).select("host"), "host")


def host_wrappers(pages: DataFrame, url: str = "url", page: str = "html") -> DataFrame:
    """(host, wrapper): one wrapper per host, from all of its pages, in rounds that each merge about `PAGES_PER_WRAPPER` into one."""

    def fit(group: pd.DataFrame) -> pd.DataFrame:
        wrapper = merged([_read(text) for text in sorted(group["wrapper"])])
        return pd.DataFrame({"host": [group["host"].iloc[0]], "wrapper": [json.dumps(wrapper)]})

    left = materialize(frames(pages, url, page))
    while True:
        counts = left.groupBy("host").agg(F.count("*").alias("n"))
        if (counts.agg(F.max("n")).first()[0] or 0) < 2:
            return left
        groups = left.join(counts, "host").withColumn("part", F.pmod(F.xxhash64("wrapper"), F.ceil(F.col("n") / PAGES_PER_WRAPPER)))
        single = groups.filter("n = 1").select("host", "wrapper")
        folded = groups.filter("n > 1").groupBy("host", "part").applyInPandas(fit, "host string, wrapper string")
        left = materialize(single.unionByName(folded))


def wrappers(pages: DataFrame, url: str = "url", page: str = "html") -> DataFrame:
    """(host, template array<string>): the texts that all pages of a host have at one place of its wrapper."""

    def texts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch[["host"]].assign(template=[template_texts(_read(text)) for text in batch["wrapper"]])

    return host_wrappers(pages, url, page).mapInPandas(texts, "host string, template array<string>")


def main_text(pages: DataFrame, page_id: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """(page_id, url, text) of every page."""
    fitted = materialize(wrappers(pages, url, page).filter(F.size("template") > 0))
    rows = pages.select(
        F.col(page_id).alias("page_id"), F.col(url).alias("url"), host_of(F.col(url)).alias("host"), F.col(page).alias("html")
    )
    rows = rows.join(fitted.withColumnRenamed("host", "host2"), F.col("host") == F.col("host2"), "left")
    rows = rows.select("page_id", "url", "html", "template")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for a in range(0, len(batch), 256):
                part = batch.iloc[a : a + 256]
                texts = [
                    extract(h, set(t) if t is not None else set())
                    for h, t in zip(part["html"], part["template"], strict=True)
                ]
                yield part[["page_id", "url"]].assign(text=texts)

    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    return rows.mapInPandas(run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string")

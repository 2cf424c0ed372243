"""Main text of web pages: block extraction and differencing against the page of the nearest URL."""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinestream.llm.common import written

_MARK = re.compile(r"""<!--.*?(?:-->|\Z)|<![^>]*>|<\?[^>]*>|<(?P<close>/?)(?P<name>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attrs>(?:[^>"']|"[^"]*"|'[^']*')*+)(?:>|\Z)|<(?P<name2>/?[a-zA-Z][a-zA-Z0-9:-]*)[^>]*(?:>|\Z)""", re.S)
_CLASS = re.compile(r"""(?:^|\s)(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_SPACE = re.compile(r"\s+")
_PART = re.compile(r"[a-z0-9]+")
#: Elements whose content is no text of the page.
_RAW = frozenset("script style noscript template textarea title svg math iframe object canvas".split())
#: Elements that hold no main text whatever they say.
_CHROME = frozenset("nav footer aside menu dialog button select option label legend head".split())
#: What a name of a class, id or role is, or begins with, that marks what is no main text.
_CHROME_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising sponsored promo nav navbar navigation menu breadcrumb breadcrumbs sidebar cookie cookies consent banner popup modal newsletter "
    "comment comments discussion reply replies disqus contentinfo complementary".split()
)
#: Words in such a name that only suggest it: differencing decides.
_CHROME_WORDS = _CHROME_NAMES | frozenset("header footer side widget notice notices sponsor subscribe signup login share social related search".split())
#: Of these, the ones that mark what is written about the article, so that an article inside is none either.
_ABOUT_WORDS = frozenset("comment comments discussion reply replies disqus related".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements that hold the article.
_MAIN = frozenset("article main".split())
#: Elements without content, and elements inside a line.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset("a abbr b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr img".split())


#: Elements whose lines are running text, also outside an article.
_PROSE = frozenset("p blockquote pre section dd h1 h2 h3 h4 h5 h6".split())


@dataclass
class Block:
    """One line of text: main is 1 in an article or main element, 2 if a class around that element speaks of comments and the
    like, else 0. chrome: 0 for nothing around it that speaks against it, 1 for a hint (a word in a class, a form), 2 for a class or 3 for an element that
    holds no main text. prose: it is in an element of running text."""

    text: str
    main: int
    chrome: int
    prose: bool


def blocks(page: str | None) -> list[Block]:
    """The text lines of a page, in order. White space inside a line is one space; empty lines are left out.

    What is around an article or main element, a form or a layout's class, doesn't speak against it: it begins anew, but among comments.
    """
    page = page or ""
    found: list[Block] = []
    stack: list[tuple[str, int, int, bool]] = []
    line: list[str] = []
    main = chrome = 0
    about = False

    def flush() -> None:
        text = _SPACE.sub(" ", entities.unescape("".join(line))).strip()
        line.clear()
        if text:
            found.append(Block(text, main, chrome, any(x[0] in _PROSE for x in stack)))

    at = 0
    while m := _MARK.search(page, at):
        line.append(page[at : m.start()])
        at = m.end()
        name = (m["name"] or m["name2"] or "").lower()
        if not name:
            continue
        closing = bool(m["close"]) or name.startswith("/")
        name = name.lstrip("/")
        if closing:
            if name not in _INLINE:
                flush()
            depth = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == name), None)
            if depth is not None:
                if name in _INLINE and any(x[0] not in _INLINE for x in stack[depth:]):
                    continue
                del stack[depth:]
                main, chrome, about = stack[-1][1:] if stack else (0, 0, False)
            continue
        if name not in _INLINE:
            flush()
        if name in _VOID:
            continue
        if name in _RAW:
            end = re.compile(rf"</{name}\s*>", re.I).search(page, at)
            at = end.end() if end else len(page)
            continue
        if name in ("p", "li", "tr", "td", "th", "dt", "dd", "option") and stack:
            # These end where the next of the kind begins; a p ends at any block.
            own = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == name), None)
            stop = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] in _HOLDERS), -1)
            if own is not None and own > stop:
                del stack[own:]
                main, chrome, about = stack[-1][1:] if stack else (0, 0, False)
        attrs = m["attrs"] or ""
        names = {w for found_ in _CLASS.findall(attrs) for w in "".join(found_).lower().split()} if "=" in attrs else set()
        words = {w for n in names for w in _PART.findall(n)}
        if name in _CHROME or (name == "header" and not main):
            chrome = 3
        elif name in _MAIN and not main:
            main, chrome = (2, chrome) if about else (1, 0)
        elif name not in _MAIN and name != "body":
            if any(parts[0] in _CHROME_NAMES or (len(parts) > 1 and _CHROME_WORDS.issuperset(parts)) for n in names if (parts := _PART.findall(n))):
                chrome = max(chrome, 2)
            elif name == "form" or (name not in _HEADINGS and words & _CHROME_WORDS):
                chrome = max(chrome, 1)
            about = about or bool(words & _ABOUT_WORDS)
        stack.append((name, main, chrome, about))
    line.append(page[at:])
    flush()
    return found


#: Elements inside which a p or li is another's child, not its end.
_HOLDERS = frozenset("div section article main body ul ol table nav footer header aside form blockquote dl".split())


def shared_lines(own: list[str], other: list[str]) -> set[int]:
    """The places of ``own`` that a longest common subsequence aligns with lines of ``other``.

    Lines that the other page lacks can't be aligned and are left out first. Memory is linear: large cases
    are halved, with two rows of lengths for each half.
    """
    both = set(own) & set(other)
    if not both:
        return set()
    number = {x: i for i, x in enumerate(both)}
    a = [(i, number[x]) for i, x in enumerate(own) if x in number]
    b = np.array([number[x] for x in other if x in number])
    found: set[int] = set()
    todo = [(a, b)]
    while todo:
        a, b = todo.pop()
        while a and len(b) and a[0][1] == b[0]:
            found.add(a[0][0])
            a, b = a[1:], b[1:]
        while a and len(b) and a[-1][1] == b[-1]:
            found.add(a[-1][0])
            a, b = a[:-1], b[:-1]
        if not a or not len(b):
            continue
        if len(a) == 1:
            if (b == a[0][1]).any():
                found.add(a[0][0])
            continue
        half = len(a) // 2
        left = _lengths([x for _, x in a[:half]], b)
        right = _lengths([x for _, x in reversed(a[half:])], b[::-1])[::-1]
        at = int((left + right).argmax())
        todo += [(a[:half], b[:at]), (a[half:], b[at:])]
    return found


def _lengths(a: list[int], b: np.ndarray) -> np.ndarray:
    """The length of the longest common subsequence of ``a`` and each prefix of ``b``."""
    row = np.zeros(len(b) + 1, dtype=np.int64)
    for x in a:
        new = row.copy()
        new[1:] = np.maximum(row[1:], np.where(b == x, row[:-1] + 1, 0))
        row = np.maximum.accumulate(new)
    return row


#: Shared lines of an article go if all of their run have so few words and end no sentence: they are its buttons, not its text.
SHORT = 3
_ENDS = (".", "!", "?", ":", ";", "…", "。", "”", '"')


def decided(own: list[Block], shared: set[int] | None) -> list[bool]:
    """Which lines of a page stay, given those that it shares in order with the page of the nearest URL (None: it has no neighbour).

    Differencing comes first: a shared line goes, unless it is in the article and its run of shared lines there holds more than SHORT words in a line, or ends a sentence: then
    both pages carry the text. So menus and notices go whatever their markup. What only this page has goes if an element or a whole class name
    says that it is no main text; a hint (a word within a name, a form) alone doesn't delete it. Outside an article that the page has, it must also be running text. Without a neighbour hints decide.
    """
    mains = {b.main for b in own if b.chrome < 2}
    article = 1 if 1 in mains else 2 if 2 in mains else 0
    long = [False] * len(own)
    at = 0
    while at < len(own):
        end = at
        while end < len(own) and shared and end in shared and own[end].main == article and article:
            end += 1
        run = own[at:end]
        if any(len(b.text.split()) > SHORT or b.text.endswith(_ENDS) for b in run):
            long[at:end] = [True] * len(run)
        at = max(end, at + 1)
    out = []
    for i, b in enumerate(own):
        inside = article and b.main == article
        if b.chrome >= 2 or (b.main == 2 and article == 1):
            out.append(False)
        elif shared is not None and i in shared:
            out.append(bool(inside and long[i] and not b.chrome))
        elif shared is None:
            out.append(bool(inside and b.chrome < 2) if article else not b.chrome)
        else:
            out.append(bool(inside or not article or b.prose))
    return out


def main_text(own: list[Block], shared: set[int] | None) -> str:
    """The lines of a page that stay, joined. If none does, as on a copy of the other page, those that no element or whole class name speaks against."""
    stays = decided(own, shared)
    for keep in (stays, decided(own, None), [b.chrome < 2 for b in own]):
        if found := [b.text for b, k in zip(own, keep, strict=True) if k]:
            return " ".join(found)
    return ""


def _near(a: str, b: str) -> int:
    """How far two paths go together."""
    n = min(len(a), len(b))
    return next((i for i in range(n) if a[i] != b[i]), n)


def line_hashes(page: str | None) -> list[int]:
    """A hash of each line, which is what alignment compares."""
    return [xxhash.xxh64_intdigest(b.text.encode("utf-8", "surrogatepass")) - (1 << 63) for b in blocks(page)]


def _hashed(html: Column) -> Column:
    @F.pandas_udf("array<long>")
    def of(pages: pd.Series) -> pd.Series:
        return pd.Series([line_hashes(p) for p in pages])

    return of(html)


def _texts(html: Column, shared: Column) -> Column:
    @F.pandas_udf("string")
    def of(pages: pd.Series, lines: pd.Series) -> pd.Series:
        return pd.Series([main_text(blocks(p), None if s is None else set(s)) for p, s in zip(pages, lines, strict=True)])

    return of(html, shared)


#: A page among its neighbours: mark, host, path and hashes of its lines.
_Page = tuple[int, str, str, list[int]]


def _shared(this: _Page, left: _Page | None, right: _Page | None) -> list[int] | None:
    """The lines shared with the nearer of the pages before and after it: the one of the longest common path counts, the one before on a tie. None without such a page."""
    near = [x for x in (left, right) if x is not None and x[1] == this[1]]
    if not near:
        return None
    other = max(near, key=lambda x: _near(x[2], this[2]))
    return sorted(shared_lines(this[3], other[3]))


_EDGES = "mark long, shared array<int>, host string, path string, lines array<long>, task int, place int, edge boolean, side int"


def _differenced(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Pages in the order of host and path: what each shares with its neighbour.

    The first and the last page of the task have a neighbour in another task. They are handed on as they are with
    the pages next to them: place is their order, edge tells them from these, side is 1 for the first, 2 for the last, 3 for both.
    """
    task = TaskContext.get().partitionId()
    before = here = None
    n = 0

    def raw(this: _Page, place: int, side: int) -> tuple:
        return this[0], None, *this[1:], task, place, side > 0, side

    for frame in frames:
        out = []
        for after in zip(frame["mark"].tolist(), frame["host"], frame["path"], frame["lines"], strict=True):
            if n == 1:
                out += [raw(here, 0, 1), raw(after, 1, 0)]
            elif n > 1:
                out.append((here[0], _shared(here, before, after), None, None, None, None, None, None, None))
            before, here, n = here, after, n + 1
        yield _frame(out)
    if n == 1:
        yield _frame([raw(here, 0, 3)])
    elif n > 1:
        yield _frame([raw(before, 2, 0), raw(here, 3, 2)])


def _joined(rows: pd.DataFrame) -> pd.DataFrame:
    """What one task's first and last page share, given its edge pages and those of the tasks beside it."""
    rows = rows.sort_values("place", kind="stable")
    pages = [*zip(rows["mark"].tolist(), rows["host"], rows["path"], rows["lines"], strict=True)]
    place, edge = rows["place"].tolist(), rows["edge"].tolist()
    # Between places 1 and 2 pages may be missing; neither is an edge.
    found = [(x[0], _shared(x, pages[i - 1] if i else None, pages[i + 1] if i + 1 < len(pages) else None)) for i, x in enumerate(pages) if edge[i] and 0 <= place[i] < 4]
    return pd.DataFrame(found, columns=["mark", "shared"])


def _frame(rows: list[tuple]) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=["mark", "shared", "host", "path", "lines", "task", "place", "edge", "side"])
    return out.astype({"task": "Int32", "place": "Int32", "edge": "boolean", "side": "Int32"})


def shared_with_nearest(rows: DataFrame) -> DataFrame:
    """(mark, shared): for each distinct mark the places of the lines that the page of the nearest URL has, too.

    ``rows``: mark, host, path, html. Only hashes of lines are sorted by host and path over the whole cluster, so a host of any size
    is split over many tasks. The first and the last page of a task meet the pages of the tasks beside it in a
    second step, so that the number of tasks changes nothing; between them the small results are a table in the shared folder.
    """
    keys = ["host", "path", "mark"]
    lines = written(rows.select(*keys, _hashed(F.col("html")).alias("lines")), "page-lines")
    once = lines.groupBy(*keys).agg(F.first("lines").alias("lines"))
    placed = once.repartitionByRange(*keys).sortWithinPartitions(*keys)
    seen = written(placed.mapInPandas(_differenced, _EDGES), "pages")
    edges, done = seen.where("task is not null"), seen.where("task is null").select("mark", "shared")
    tasks = [r.task for r in edges.select("task").distinct().sort("task").collect()]
    if not tasks:
        return done
    turn = edges.withColumn("task", F.array_position(F.lit(tasks), F.col("task")).cast("int"))
    last = turn.where("side in (2, 3)").withColumns({"task": F.col("task") + 1, "place": F.lit(-1), "edge": F.lit(False)})
    first = turn.where("side in (1, 3)").withColumns({"task": F.col("task") - 1, "place": F.lit(4), "edge": F.lit(False)})
    return done.unionByName(turn.unionByName(last).unionByName(first).groupBy("task").applyInPandas(_joined, "mark long, shared array<int>"))


def host_and_path(url: Column) -> tuple[Column, Column]:
    """The host in lower case without user, port and www., and the path without its last slash; empty where the URL has none."""
    host = F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?(?:www\.)?([^/?#:]*)", 1)
    path = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*?)/*(?:[?#].*)?$", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def extracted(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row for each row of ``pages``: page_id, url, text, n_chars, n_shared.

    Each page is paired with the nearer of its two neighbours in the order of host and path, if that is of the same host, and aligned with
    it line by line; n_shared counts the lines that they share. Null and empty html gives an empty text; a null or broken
    URL has the empty host. Ids may be null and may repeat; equal rows are one page, which is no neighbour of itself, and get
    equal results. Other columns are not read.
    """
    page = [F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html")]
    rows = pages.select(*page)
    mark = F.xxhash64(*[x for c in rows.columns for x in (F.col(c), F.col(c).isNull())])
    host, path = host_and_path(F.col("url"))
    marked = rows.withColumns({"mark": mark, "host": host, "path": path})
    done = marked.select("mark", "page_id", "url", "html").join(shared_with_nearest(marked), "mark", "left")
    text = done.select("page_id", "url", _texts(F.col("html"), F.col("shared")).alias("text"), F.size(F.coalesce("shared", F.array().cast("array<int>"))).cast("long").alias("n_shared"))
    return text.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"), "n_shared")

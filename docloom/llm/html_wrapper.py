"""Main text of pages by union-free wrapper inference: same-host token streams, aligned again and again.

A page is a stream of tags and text slots. Its normal form folds repeated groups (``<p>#</p><p>#</p>`` becomes one
group), for every period. A host's wrapper starts as the normal form of one page and is aligned with all others:
equal tokens stay, tokens missing on one side become optional, and a slot keeps the texts that all pages have in
it. Those are template text; every other text, of a slot that is fixed, optional or repeated, is content. Every page
of the host is then aligned with the wrapper and its content slots are read. Element and class names are a check
on what is left: navigation, forms and other furniture go, so a page that no wrapper fits still gives its text.

Wrappers take every page of a host and its whole html; parts are merged in a tree, and copies of one page count once.
"""

from __future__ import annotations

import hashlib
import html as entities
import json
import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.llm.registry import query
from docloom.llm.url_filter import host_of
from docloom.staging import stage

SALTS, LEAST_PAGES, HELD_CHARS = 32, 3, 16_000_000

# Element names and class words of what is not the article.
_RAW = {"script", "style", "noscript", "template", "textarea", "title", "svg", "iframe", "select", "button", "object", "canvas"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
_INLINE = {"a", "abbr", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "mark", "q", "s",
           "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr"}
_FURNITURE = {"nav", "footer", "aside", "form", "head", "menu", "dialog", "header"}
_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "alert", "dialog", "menu", "menubar"}
_WORDS = re.compile(r"(?:^|[\s_-])(?:ad|ads|adbox|advert\w*|adverts|sponsor\w*|promo\w*|banner|sidebar|side|nav|navbar|navigation|menu|breadcrumbs?|"
                    r"cookies?|consent|notice|notices|alert|popup|modal|newsletter|subscribe|signup|login|share|sharing|social|related|recommended|"
                    r"comments?|commentlist|replies|reply|disqus|respond|footer|header|masthead|toolbar|widget|pagination|pager|skip|hidden|legal|copyright)(?:$|[\s_-])", re.I)

_TOKEN = re.compile(r"<!--.*?(?:-->|$)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*)>|<[!?][^>]*>", re.S)
# Attributes in order, values and all, so that a word inside a value or a longer name is never taken for a name.
_ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_RAW_END = {name: re.compile(rf"</{name}\s*>", re.I) for name in _RAW}
_CLOSES_P = {"p", "div", "article", "section", "h1", "h2", "h3", "h4", "h5", "h6", "ul", "ol", "li", "table", "blockquote", "pre", "footer", "header", "nav", "aside", "form", "main", "figure"}


class _Marks:
    """Remembers what tags mean. Pickles empty: a cache made by ``functools`` is pickled by name and needs the package in workers."""

    def __init__(self):
        self.known: dict[tuple[str, str], tuple[str, bool]] = {}

    def __reduce__(self):
        return type(self), ()

    def __call__(self, name: str, attributes: str) -> tuple[str, bool]:
        """(token of the tag, whether the element is furniture)."""
        key = (name, attributes)
        if key not in self.known:
            if len(self.known) >= 4096:
                self.known.clear()
            self.known[key] = _read_tag(name, attributes)
        return self.known[key]


_mark = _Marks()


def _read_tag(name: str, attributes: str) -> tuple[str, bool]:
    found: dict[str, str] = {}
    for k, a, b, c in _ATTRIBUTE.findall(attributes):
        found.setdefault(k.lower(), a or b or c)
    label = " ".join(sorted(re.sub(r"\d+", "0", found.get("class", "")).split()))
    bad = name in _FURNITURE or found.get("role", "").lower() in _ROLES or "hidden" in found or found.get("aria-hidden") == "true"
    bad = bad or name not in ("html", "body", "article", "main") and bool(_WORDS.search(found.get("class", "")) or _WORDS.search(found.get("id", "")))
    return f"{name}.{label}" if label else name, bad


def tokens_of(page: str) -> tuple[list[str], list[str], list[bool], list[bool]]:
    """Tokens (tags and '#'), and for each text slot: its text, whether it is in furniture, whether in an article.

    Block tags part the text, inline tags do not. An open <p> ends where a block begins; other missing end
    tags are closed by the end tag of what holds them.
    """
    out, texts, furniture, article = [], [], [], []
    open_tags: list[tuple[str, bool, bool]] = []  # (name, furniture here, in article here)
    parts: list[str] = []
    at = 0

    def flush() -> None:
        if parts:
            text = " ".join(entities.unescape("".join(parts)).split())
            parts.clear()
            if text:
                out.append("#")
                texts.append(text)
                furniture.append(bool(open_tags) and open_tags[-1][1])
                article.append(bool(open_tags) and open_tags[-1][2])

    while True:
        found = _TOKEN.search(page, at)
        if found is None:
            parts.append(page[at:])
            break
        parts.append(page[at:found.start()])
        at = found.end()
        name = (found[2] or "").lower()
        if not name:
            continue
        if name in _INLINE:
            continue
        if found[1]:
            names = [t[0] for t in open_tags]
            if name in names:
                flush()
                del open_tags[len(names) - 1 - names[::-1].index(name):]
                out.append("/" + name)
            continue
        flush()
        token, bad = _mark(name, found[3])
        if name in _RAW:
            end = _RAW_END[name].search(page, at)
            at = end.end() if end else len(page)
            continue
        if name in _VOID:
            if name not in ("br", "wbr"):
                out.append(token)
            continue
        if name in _CLOSES_P and open_tags and open_tags[-1][0] == "p":
            open_tags.pop()
            out.append("/p")
        if name == "li" and open_tags and open_tags[-1][0] == "li":
            open_tags.pop()
            out.append("/li")
        held, inside = (open_tags[-1][1], open_tags[-1][2]) if open_tags else (False, False)
        if inside and name == "header":
            bad = False
        open_tags.append((name, held or bad, inside or name in ("article", "main")))
        out.append(token)
    flush()
    return out, texts, furniture, article


def fold(tokens: list[str]) -> tuple[list[str], list[int]]:
    """Normal form: runs of a repeated group appear once. Also the place in it of every text slot, in order.

    Shorter periods fold first, so groups of groups fold too; any period up to half of the page is tried.
    """
    form, homes = list(tokens), [[i] for i in range(len(tokens))]
    codes: dict[str, int] = {}
    ids = np.array([codes.setdefault(t, len(codes)) for t in form], dtype=np.int32)
    period = 1
    while 2 * period <= len(form):
        # A group repeats only where as many neighbours in a row equal those one period later.
        equal = ids[:-period] == ids[period:]
        gaps = np.flatnonzero(~equal) if np.count_nonzero(equal) >= period else None
        if gaps is not None and np.diff(gaps, prepend=-1, append=len(equal)).max() > period:
            out, kept, i = [], [], 0
            while i < len(form):
                if len(out) >= period and form[i:i + period] == out[-period:] and (period > 1 or form[i] != "#"):
                    for k in range(period):
                        kept[len(kept) - period + k].extend(homes[i + k])
                    i += period
                else:
                    out.append(form[i])
                    kept.append(homes[i])
                    i += 1
            form, homes = out, kept
            ids = np.array([codes[t] for t in form], dtype=np.int32)
        period += 1
    place = {token: k for k, members in enumerate(homes) for token in members}
    return form, [place[i] for i, token in enumerate(tokens) if token == "#"]


def _common_lengths(x: list[str], y: list[str]) -> np.ndarray:
    """Length of the longest common subsequence of ``x`` and every beginning of ``y``; a row of the table is the bits of one number."""
    masks: dict[str, int] = {}
    for j, token in enumerate(y):
        masks[token] = masks.get(token, 0) | 1 << j
    full = (1 << len(y)) - 1
    row = full
    for token in x:
        hit = row & masks.get(token, 0)
        row = (row + hit | row - hit) & full
    bits = np.unpackbits(np.frombuffer(row.to_bytes(len(y) // 8 + 1, "little"), np.uint8), bitorder="little")[:len(y)]
    return np.concatenate([[0], np.cumsum(bits == 0)])


def align(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Pairs of equal tokens of a longest common subsequence, in linear memory: common ends first, then one side is
    halved and the other cut where both halves have most in common."""
    pairs, todo = [], [(0, len(a), 0, len(b))]
    while todo:
        i, k, j, m = todo.pop()
        while i < k and j < m and a[i] == b[j]:
            pairs.append((i, j))
            i, j = i + 1, j + 1
        while i < k and j < m and a[k - 1] == b[m - 1]:
            k, m = k - 1, m - 1
            pairs.append((k, m))
        if k - i == 1 and a[i] in b[j:m]:
            pairs.append((i, b.index(a[i], j, m)))
        elif k - i > 1 and j < m:
            half = (i + k) // 2
            both = _common_lengths(a[i:half], b[j:m]) + _common_lengths(a[half:k][::-1], b[j:m][::-1])[::-1]
            cut = j + int(both.argmax())
            todo += [(i, half, j, cut), (half, k, cut, m)]
    return sorted(pairs)


def wrapper_of(page: str) -> dict:
    """The wrapper of one page: its normal form, and the texts of every slot. ``pages``: up to three page hashes."""
    tokens, texts, _, _ = tokens_of(page)
    form, places = fold(tokens)
    common: list[list[str]] = [[] for _ in form]
    for place, text in zip(places, texts, strict=True):
        common[place].append(text)
    return {"tokens": form, "optional": [False] * len(form), "common": [sorted(set(c)) for c in common], "pages": [hashlib.sha256(page.encode()).hexdigest()[:16]]}


def merge(one: dict, two: dict) -> dict:
    """The wrapper of the pages of both. Tokens of one side only become optional, and a slot keeps the texts that all pages have in it."""
    a, b = one["tokens"], two["tokens"]
    pairs = [(i, i) for i in range(len(a))] if a == b else align(a, b)
    tokens, optional, common, i, j = [], [], [], 0, 0
    for x, y in [*pairs, (len(a), len(b))]:
        for side, at, end in ((a, i, x), (b, j, y)):
            tokens += side[at:end]
            optional += [True] * (end - at)
            common += [[] for _ in range(end - at)]
        if x < len(a):
            tokens.append(a[x])
            optional.append(one["optional"][x] or two["optional"][y])
            common.append([] if optional[-1] else [t for t in one["common"][x] if t in set(two["common"][y])])
        i, j = x + 1, y + 1
    return {"tokens": tokens, "optional": optional, "common": common, "pages": sorted({*one["pages"], *two["pages"]})[:LEAST_PAGES]}


def finished(wrapper: dict) -> dict:
    """``fixed``: slots with template text, which are on every page and have a text that is there on every page."""
    enough = len(wrapper["pages"]) >= LEAST_PAGES
    return wrapper | {"fixed": [enough and not o and bool(c) for o, c in zip(wrapper["optional"], wrapper["common"], strict=True)]}


def infer(pages: list[str]) -> dict:
    """Wrapper of pages: tokens, which are optional, which slots have template text (``fixed``) and which (``common``)."""
    return finished(reduce(merge, map(wrapper_of, pages)))


def extract(page: str, wrapper: dict | None, memory: dict | None = None) -> str:
    """Content text of a page: the slots that the wrapper does not know as template text, inside an article and outside.
    Names are a check on what is left: furniture is left out, and with content in an article only that counts."""
    tokens, texts, furniture, article = tokens_of(page)
    if not texts:
        return ""
    form, places = fold(tokens)
    template: dict[int, set[str]] = {}
    if wrapper:
        key = tuple(form)
        if memory is None or key not in memory:
            template = {b: set(wrapper["common"][a]) for a, b in align(wrapper["tokens"], form) if wrapper["fixed"][a]}
            if memory is not None:
                if len(memory) > 5000:
                    memory.clear()
                memory[key] = template
        else:
            template = memory[key]
    usable = [not f and text not in template.get(place, ()) for f, text, place in zip(furniture, texts, places, strict=True)]
    inside = any(u and a for u, a in zip(usable, article, strict=True))
    return " ".join(text for text, use, within in zip(texts, usable, article, strict=True) if use and (within or not inside))


def _wrap_tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One wrapper per host of a task, or several when they grow over ``HELD_CHARS`` together."""
    found: dict[str, dict] = {}
    held = 0

    def flush() -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays([pa.array(found, pa.string()), pa.array(map(json.dumps, found.values()), pa.string())], ["host", "wrapper"])
        found.clear()
        return out

    for batch in batches:
        for host, page in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            page = page.as_py()
            one = wrapper_of(page)
            if host in found:
                found[host] = merge(found[host], one)
            else:
                found[host] = one
                held += len(page)
            if held > HELD_CHARS:
                yield flush()
                held = 0
    yield flush()


def _merge_host(table: pa.Table) -> pa.Table:
    wrapper = reduce(merge, map(json.loads, sorted(table["wrapper"].to_pylist())))
    return pa.table({"host": table["host"][:1], "wrapper": pa.array([json.dumps(wrapper)])})


def _finish_host(table: pa.Table) -> pa.Table:
    merged = _merge_host(table)
    return pa.table({"host": merged["host"], "wrapper": pa.array([json.dumps(finished(json.loads(merged["wrapper"][0].as_py())))])})


def infer_wrappers(pages: DataFrame) -> DataFrame:
    """(host, wrapper) from all pages of every host. ``pages``: host, html.

    Pages are merged where they are read; what tasks found meets in salted groups of a host first, so that a hot
    host never meets in one task. NULL and empty html take no part.
    """
    schema = "host string, wrapper string"
    parts = stage(pages.filter(F.length("html") > 0).select("host", "html").mapInArrow(_wrap_tasks, schema), "html-parts")
    salted = parts.groupBy("host", F.pmod(F.xxhash64("wrapper"), F.lit(SALTS))).applyInArrow(_merge_host, schema)
    return stage(salted.groupBy("host").applyInArrow(_finish_host, schema), "html-wrappers")


def _extract_tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known: dict[str, tuple[dict, dict]] = {}
    for batch in batches:
        texts = []
        for page, wrapper in zip(batch.column(2), batch.column(3), strict=True):
            page, wrapper = page.as_py() or "", wrapper.as_py()
            if wrapper and wrapper not in known:
                if len(known) > 200:
                    known.clear()
                known[wrapper] = (json.loads(wrapper), {})
            texts.append(extract(page, *known[wrapper]) if wrapper else extract(page, None))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], ["page_id", "url", "text"])


def extract_pages(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars for every row of ``pages`` (page_id, url, html).

    NULL and empty html give an empty text. A NULL url, or one without a host, belongs to the host ''. Repeated
    rows and NULL ids are kept; other columns are ignored; broken markup is read as far as it goes. An empty
    table gives an empty one.
    """
    keyed = pages.select("page_id", "url", "html", host_of(F.col("url")).alias("host"))
    wrappers = infer_wrappers(keyed.select("host", "html")).withColumnRenamed("host", "_h")
    joined = keyed.join(wrappers, F.col("host") == F.col("_h"), "left").select("page_id", "url", "html", "wrapper")
    text = joined.mapInArrow(_extract_tasks, "page_id long, url string, text string")
    return text.withColumn("n_chars", F.length("text").cast("long"))


@query()
def op10_html_wrapper(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(spark.read.parquet(f"{sf_dir}/pages.parquet"))

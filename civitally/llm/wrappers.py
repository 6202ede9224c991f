"""Main text of web pages by wrappers inferred per host.

Pages of one host come from one template. Each page is a stream of structural tags and
text slots; a wrapper is a union-free regular expression over such tokens: plain tokens,
optional groups ``?`` and repeated groups ``+``. Inference folds streams into a wrapper:
neighbouring repeats become a repeated group, and where wrapper and stream disagree the
parts that only one side has become optional groups. A text is a token by its hash: where
texts differ, it becomes a slot, and a text that stays outside of optional groups stands on
every page and belongs to the template. Both are addressed by the chain of elements open
around them. A host may have several templates: pages whose text
lies in the same marked elements (``article``, ``main``, names such as ``content``), and
for the most part in the same ones, are one variant. From how much text and link text each slot holds over the pages of a variant,
slots are declared main text or surroundings; pages are then read through the declarations
of their variant, without the texts of its template. Pages without a host have no template in common and are read alone.

Folding is associative enough to be done as a tree: equal streams are merged first by a
map-side combined count (they differ where texts do), then at most ``FAN_IN`` of a variant meet in a task, level by level,
so a host that holds a third of all pages never meets in one task.
"""

from __future__ import annotations

import html
import json
import re
from collections.abc import Iterator
from difflib import SequenceMatcher
from functools import lru_cache

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..workspace import Workspace

FAN_IN = 64
MAX_PERIOD = 12

#: Fixed value: elements open at once; a further one takes the place of the innermost, as in
#: browsers. Only the tree gets no deeper, no text is lost.
MAX_DEPTH = 512
LINKS = 0.6
SHARE = 0.5
#: Different pages a variant must have before equal texts count as its template.
TEMPLATE_PAGES = 3

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<svg(?=[\s/>])[^>]*/>"
    r"|<(?P<raw>script|style|template|noscript|textarea|title|svg|iframe|select)(?=[\s/>])[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<[!?][^>]*>"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attrs>(?:\"[^\"]*\"|'[^']*'|[^'\">])*)>"
    r"|(?P<text>[^<]+|<)",
    re.DOTALL | re.IGNORECASE,
)
ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden)\b(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.IGNORECASE)
PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

# Elements of HTML by what they mean for text.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var".split()
)
NOT_IN_P = set(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 "
    "h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split()
)
SURROUNDINGS = set(
    "head nav header footer aside form button dialog menu object canvas audio video map datalist fieldset".split()
)
ROLES_AROUND = set("navigation banner contentinfo complementary search form alert dialog menu menubar".split())
NAMES_AROUND = set(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu "
    "breadcrumb breadcrumbs sidebar footer header masthead cookie cookies consent notice notices notification alert popup "
    "modal overlay newsletter subscribe signup login comment comments commentlist disqus reply replies respond share sharing "
    "social related recommended widget pagination pager skip toolbar hidden".split()
)
NAMES_MAIN = set("article content main post entry story".split())


# ---- tokens and slots ----------------------------------------------------------------


def element(name: str, attrs: str) -> str:
    """A tag with what tells one template place from another; digits are not part of it."""
    kept = []
    for key, value in ATTRIBUTE.findall(attrs):
        key = key.lower()
        value = "hidden" if key == "hidden" else re.sub(r"[0-9]+", "0", value.strip("\"'"))
        kept += [("~" if key == "role" else ".") + v.replace("/", "|") for v in value.split()]
    return name + "".join(sorted(set(kept)))


def tokens(page: str) -> Iterator[tuple[str, str]]:
    """(kind, value): ``open``/``close`` of structural elements, ``break``, ``link``, ``text``."""
    stack: list[str] = []
    links = 0
    for m in TOKEN.finditer(page):
        if (text := m["text"]) is not None:
            yield ("link" if links else "text"), text
            continue
        name = (m["name"] or "").lower()
        if not name:
            continue
        if name in INLINE:
            if name == "a":
                links = 0 if m["end"] else 1
            continue
        if name in VOID:
            yield ("space" if name in ("br", "wbr", "img", "input") else "break"), name
            continue
        links = 0
        if m["end"]:
            if name in stack:
                while True:
                    top = stack.pop()
                    yield "close", top
                    if top == name:
                        break
            else:
                yield "break", name
            continue
        if name in NOT_IN_P and stack and stack[-1] == "p" or stack and name == stack[-1] and name in ("li", "tr", "td", "th", "dt", "dd", "option"):
            yield "close", stack.pop()
        if len(stack) == MAX_DEPTH:
            yield "close", stack.pop()
        stack.append(name)
        yield "open", element(name, m["attrs"])
    while stack:
        yield "close", stack.pop()


def text_token(run: list[str]) -> str:
    """The token of a text between two structural tags, empty for a blank one."""
    text = " ".join("".join(run).split())
    return "#" + xxhash.xxh3_64_hexdigest(text.encode("utf-8", "surrogatepass")) if text else ""


def stream(page: str) -> tuple[list, dict[str, list[int]]]:
    """Wrapper tokens of a page, and text and link characters per slot."""
    out: list = []
    path: list[str] = []
    run: list[str] = []
    slots: dict[str, list[int]] = {}

    def end_run() -> None:
        if token := text_token(run):
            out.append(token)
        run.clear()

    for kind, value in tokens(page):
        if kind == "open":
            end_run()
            path.append(value)
            out.append("<" + value)
        elif kind == "close":
            end_run()
            out.append("</" + path.pop())
        elif kind in ("text", "link"):
            run.append(value)
            if value.strip():
                held = slots.setdefault("/".join(path), [0, 0])
                held[kind == "link"] += len(value.strip())
    end_run()
    return collapse(out), slots


# ---- union-free regular expressions ----------------------------------------------------


def _shape(item) -> str:
    """An item without its texts."""
    if isinstance(item, str):
        return "#" if item[:1] == "#" else item
    return "".join((item[0], "[", *(_shape(x) + "\n" for x in item[1]), "]"))


def _shapes(items: list) -> list[str]:
    return [_shape(x) for x in items]


def _united(one: list, two: list) -> list:
    """Items of one shape as one: where their texts differ, a slot."""
    if one == two:
        return one
    return [
        x if x == y else "#" if isinstance(x, str) else [x[0], _united(x[1], y[1])] for x, y in zip(one, two)
    ]


def collapse(items: list) -> list:
    """Neighbouring repeats of up to ``MAX_PERIOD`` items become repeated groups."""
    while True:
        keys = _shapes(items)
        out: list = []
        at = 0
        while at < len(items):
            for period in range(1, MAX_PERIOD + 1):
                group = keys[at : at + period]
                end = at + period
                while keys[end : end + period] == group:
                    end += period
                if end > at + period and len(group) == period:
                    body = items[at : at + period]
                    for copy in range(at + period, end, period):
                        body = _united(body, items[copy : copy + period])
                    body = collapse(body) if period > 1 else body
                    whole = body[0] if period == 1 and isinstance(body[0], list) else ["+", body]
                    out.append(whole)
                    at = end
                    break
            else:
                if (  # a repeated group takes in the next copy of its body
                    out and isinstance(out[-1], list) and out[-1][0] == "+"
                    and keys[at : at + len(out[-1][1])] == _shapes(out[-1][1])
                ):
                    size = len(out[-1][1])
                    out[-1] = ["+", _united(out[-1][1], items[at : at + size])]
                    at += size
                else:
                    out.append(items[at])
                    at += 1
        if len(out) == len(items):
            return out
        items = out


def _key(item) -> str:
    """Items that may be aligned have equal keys; groups are told apart by how they begin."""
    if isinstance(item, str):
        return "#" if item[:1] == "#" else item
    first = item[1][0] if item[1] else ""
    return item[0] + _key(first)


def _body(part: list) -> list:
    """What a part consists of, once."""
    while len(part) == 1 and isinstance(part[0], list):
        part = part[0][1]
    return part


def align(one: list, two: list) -> list:
    """The least wrapper of this form that covers both."""
    keys_one, keys_two = [_key(x) for x in one], [_key(x) for x in two]
    if keys_one == keys_two and one == two:
        return one
    out: list = []
    for op, a, b, c, d in SequenceMatcher(None, keys_one, keys_two, autojunk=False).get_opcodes():
        if op == "equal":
            for x, y in zip(one[a:b], two[c:d]):
                out.append(x if x == y else "#" if isinstance(x, str) else [x[0], align(x[1], y[1])])
            continue
        parts = [p for p in (one[a:b], two[c:d]) if p]
        bodies = [_body(p) for p in parts]
        if len(parts) == 2 and _shapes(bodies[0]) == _shapes(bodies[1]):  # once here, several times there
            whole = ["+", _united(*bodies)]
            out.append(["?", [whole]] if any(p[0][0] == "?" for p in parts) else whole)
            continue
        for part in parts:
            if len(part) == 1 and isinstance(part[0], list) and part[0][0] == "?":
                out.append(part[0])
            else:  # groups that are optional already stay as they are
                run: list = []
                for x in [*part, None]:
                    if x is not None and not (isinstance(x, list) and x[0] == "?"):
                        run.append(x)
                        continue
                    if run:
                        out.append(["?", run])
                        run = []
                    if x is not None:
                        out.append(x)
    return out


def infer(streams: list[list]) -> list:
    """Fold streams into one wrapper."""
    wrapper = streams[0]
    for other in streams[1:]:
        wrapper = align(wrapper, other)
    return wrapper


def template_texts(wrapper: list) -> set[tuple[str, str]]:
    """(path, token) of the texts that every page of a wrapper has."""
    found: set[tuple[str, str]] = set()
    path: list[str] = []

    def walk(items: list, always: bool) -> None:
        for x in items:
            if isinstance(x, list):
                before = list(path)
                walk(x[1], always and x[0] != "?")
                path[:] = before if x[0] == "?" and len(path) < len(before) else path
            elif x[:1] == "#":
                if always and x != "#":
                    found.add(("/".join(path), x))
            elif x.startswith("</"):
                if x[2:] in path:
                    while path.pop() != x[2:]:
                        pass
            else:
                path.append(x[1:])

    walk(wrapper, True)
    return found


# ---- declarations ------------------------------------------------------------------------


def _parts(step: str) -> tuple[str, set[str], set[str]]:
    name, *names = re.split(r"(?=[.~])", step)
    words = {p.lower() for n in names if n[0] == "." for p in PART.findall(n[1:])}
    return name, words, {n[1:].lower() for n in names if n[0] == "~"}


@lru_cache(100_000)
def surrounds(step: str) -> bool:
    name, words, roles = _parts(step)
    if name in ("html", "body", "article", "main"):
        return "hidden" in words
    return name in SURROUNDINGS or bool(words & NAMES_AROUND) or bool(roles & ROLES_AROUND)


@lru_cache(100_000)
def holds_main(step: str) -> int:
    """Which mark of the main part an element bears: article 3, main 2, a name 1, none 0."""
    name, words, roles = _parts(step)
    if name == "article":
        return 3
    if name == "main" or "main" in roles:
        return 2
    return int(name in ("div", "section", "td") and bool(words & NAMES_MAIN))


def _narrowed(slots: dict) -> tuple[list[int], set[str]]:
    """The marks that the main part narrows to, and its slots.

    It narrows to marked elements only where these hold ``SHARE`` of its text, so that
    teasers in an ``article`` do not push out the text beside them.
    """
    main = {p for p in slots if not any(map(surrounds, p.split("/")))}
    used: list[int] = []
    for mark in (2, 3, 1):  # a main may hold articles; a name tells less than an element
        if mark == 1 and used:
            break
        marked = {p for p in main if any(holds_main(step) == mark for step in p.split("/"))}
        if marked and sum(slots[p][0] for p in marked) >= SHARE * sum(slots[p][0] for p in main):
            main = marked
            used.append(mark)
    return used, main


def variant(slots: dict) -> str:
    """What tells the templates of a host apart: the marked elements that hold a page's text, and
    which of them hold most of it."""
    used, _ = _narrowed(slots)
    found = set()
    for p in slots:
        steps = p.split("/")
        if not any(map(surrounds, steps)):
            found.update("/".join(steps[: i + 1]) for i, step in enumerate(steps) if holds_main(step))
    return json.dumps([used, sorted(found)])


def declare(slots: dict[str, tuple[int, int]]) -> dict[str, bool]:
    """Which slots (text and link characters by path) of a variant are main text."""
    used, main = _narrowed(slots)
    if not used:  # lists of links outside of marked parts are menus
        main = {p for p in main if any(map(holds_main, p.split("/"))) or slots[p][1] <= LINKS * sum(slots[p])}
    return {p: p in main for p in slots}


def main_text(page: str, main: dict[str, set[str]]) -> str:
    """Blocks of the main slots, one a line, without the template's texts (tokens by slot).

    A page that has nothing else keeps them.
    """
    blocks: list[str] = []
    own: list[str] = []
    here: list[str] = []
    held: list[str] = []
    run: list[str] = []
    path: list[str] = []
    for kind, value in [*tokens(page), ("end", "")]:
        if kind in ("text", "link"):
            run.append(value)
            if "/".join(path) in main:
                held.append(html.unescape(value))
        elif kind == "space":
            held.append(" ")
        else:
            here.append(" ".join("".join(held).split()))
            held = []
            if kind == "break":
                continue
            known = main.get("/".join(path))
            blocks += here
            own += [""] * len(here) if known and text_token(run) in known else here
            here, run = [], []
            if kind == "open":
                path.append(value)
            elif kind == "close":
                path.pop()
    return "\n".join(filter(None, own)) or "\n".join(filter(None, blocks))


# ---- Spark --------------------------------------------------------------------------------


def host(url: str = "url") -> Column:
    """The host of an address, empty where there is none."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


_SEEN = pa.schema([("host", pa.string()), ("variant", pa.string()), ("slot", pa.bool_()), ("key", pa.string()), ("text", pa.int64()), ("link", pa.int64())])


def _seen(pages: DataFrame) -> DataFrame:
    """Distinct streams and the slot sums of every variant."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            sums: dict[tuple, list[int]] = {}
            for name, page in zip(part["host"].to_pylist(), part["html"]):
                found, slots = stream(page.as_py())
                kind = variant(slots)
                sums.setdefault((name, kind, False, json.dumps(found)), [0, 0])
                for path, (text, link) in slots.items():
                    held = sums.setdefault((name, kind, True, path), [0, 0])
                    held[0] += text
                    held[1] += link
            rows = [(*k, *v) for k, v in sums.items()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], f.type) for i, f in enumerate(_SEEN)], schema=_SEEN
            )

    rows = pages.mapInArrow(run, "host string, variant string, slot boolean, key string, text long, link long")
    return rows.groupBy("host", "variant", "slot", "key").agg(F.sum("text").alias("text"), F.sum("link").alias("link"))


def _merge(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
    streams = [json.loads(k) for k in sorted(frame["key"])]
    return pd.DataFrame(
        {"host": [key[0]], "variant": [key[1]], "key": [json.dumps(infer(streams))], "streams": [frame["streams"].sum()]}
    )


def wrappers(seen: DataFrame, ws: Workspace) -> DataFrame:
    """``host, variant, key, streams``: one wrapper per variant, as JSON, and of how many streams."""
    left, level = seen.where("not slot").select("host", "variant", "key", F.lit(1).cast("long").alias("streams")), 0
    while True:
        sizes = left.groupBy("host", "variant").agg(F.count("*").alias("n"))
        most = sizes.agg(F.max("n")).first()[0] or 0
        groups = F.ceil(F.col("n") / FAN_IN).cast("int")
        dealt = left.join(sizes, ["host", "variant"]).withColumn("group", F.pmod(F.xxhash64("key", F.lit(level)), groups))
        # dealt by group too: a broadcast join would keep the rows of a variant together
        dealt = dealt.repartition("host", "variant", "group")
        merged = dealt.groupBy("host", "variant", "group").applyInPandas(
            _merge, "host string, variant string, key string, streams long"
        )
        left, level = ws.stage(merged, f"wrappers-{level}"), level + 1
        if most <= FAN_IN:
            return left


def _declared(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
    slots = {r.key: (int(r.text), int(r.link)) for r in frame[frame["slot"]].itertuples()}
    main: dict[str, list[str]] = {p: [] for p, is_main in sorted(declare(slots).items()) if is_main}
    for r in frame[~frame["slot"]].itertuples():
        if r.text >= TEMPLATE_PAGES:
            for path, token in sorted(template_texts(json.loads(r.key))):
                if path in main:
                    main[path].append(token)
    return pd.DataFrame({"host": [key[0]], "variant": [key[1]], "main": [json.dumps(main)]})


def declarations(pages: DataFrame, ws: Workspace) -> DataFrame:
    """``host, variant, main``: the main slots of each variant and its template's texts in them, from all its pages."""
    seen = ws.stage(_seen(pages), "seen")
    found = wrappers(seen, ws).select(
        "host", "variant", F.lit(False).alias("slot"), "key", F.col("streams").alias("text"), F.lit(0).cast("long").alias("link")
    )
    both = seen.where("slot").unionByName(found)
    main = both.groupBy("host", "variant").applyInPandas(_declared, "host string, variant string, main string")
    return ws.stage(main, "declared")


_TAGGED_DDL = "page_id long, url string, html string, host string, variant string"


def _tagged(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pages with their variant; none without a host."""
    for part in parts:
        kinds = [variant(stream(p.as_py())[1]) if h else None for h, p in zip(part["host"].to_pylist(), part["html"])]
        yield pa.RecordBatch.from_arrays([*part.columns, pa.array(kinds, pa.string())], [*part.schema.names, "variant"])


_TEXT = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])


def extract(pages: DataFrame, ws: Workspace) -> DataFrame:
    """``page_id, url, text, n_chars`` per row of ``pages``.

    Null and empty pages have no text. Pages without an address are read one by one.
    Broken markup is read leniently: what is left open ends with its parent. Repeated
    rows are read each, an empty table gives no rows, further columns are ignored.
    """
    rows = pages.select("page_id", "url", host().alias("host"), F.coalesce("html", F.lit("")).alias("html"))
    known = declarations(rows.where("host <> ''").select("host", "html"), ws)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict[str, dict[str, set[str]]] = {}
        for part in parts:
            texts = []
            for declared, page in zip(part["main"].to_pylist(), part["html"]):
                if declared is None:
                    alone = declare(stream(page.as_py())[1])
                    texts.append(main_text(page.as_py(), {p: set() for p, is_main in alone.items() if is_main}))
                    continue
                if declared not in cache:
                    if len(cache) > 1000:
                        cache.clear()
                    cache[declared] = {p: set(t) for p, t in json.loads(declared).items()}
                texts.append(main_text(page.as_py(), cache[declared]))
            yield pa.RecordBatch.from_arrays(
                [part["page_id"], part["url"], pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                schema=_TEXT,
            )

    tagged = rows.select("page_id", "url", "html", "host").mapInArrow(_tagged, _TAGGED_DDL)
    read = tagged.join(known, ["host", "variant"], "left").select("page_id", "url", "html", "main")
    return read.mapInArrow(run, "page_id long, url string, text string, n_chars long")

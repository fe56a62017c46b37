"""Main text of web pages by wrappers: union-free regular expressions inferred from pages of the same host.

A page becomes a stream of block tags and text slots; scripts, styles, comments and inline markup are gone, missing
end tags are filled in. A block without blocks inside is one token, a run of equal neighbours a repeated group, and
so is any balanced stretch that follows itself. The streams of all pages of a host are aligned: what both have
stays, what one lacks becomes an optional group. Then all pages of the host are aligned with that wrapper, and the texts
of every slot (a group and the path of elements down to the text) are compared over all of them: a slot that says the
same on all of its pages, at least LEAST_SEEN, though these pages differ, belongs to the template, wherever it stands.
Stretches the wrapper doesn't know make slots by their path alone. Of what is not template, a page keeps the slots whose
marks speak for them most clearly: those in a main element; else those in a main element around which a class, id or role
has a word of side matter; else those without marks; else those that stand only below such a word, if they are known to
vary on the host. Elements that are side matter by their tag, and hidden ones, never count. Words on html and body say nothing.

Pages are parsed once. A wrapper has the groups that stand on LEAST_SEEN pages of its host and on one of RARE, counted over all
of them; a slot of fewer than LEAST_SEEN pages is never judged anyhow. The distinct streams of a host, thus reduced, are
aligned about FORMS at a time, then what came of them, until there is one wrapper; after each step it loses the places at
which no stream has its leftmost fit, so that it grows with the variety of the streams and not with their number. A page has the
leftmost fit too. Slots are judged by all pages, in one
aggregation of counts and extremes, and the judgement holds for every page. Defined results: a missing or empty html has
no text. Pages whose url is missing or names no host share one wrapper. Rows are taken one
by one, whatever their ids.
"""

from __future__ import annotations

import html as entities
import math
import re
from bisect import bisect_left, bisect_right
from collections.abc import Sequence

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.llm.frames import BROADCAST_BYTES, columns_of, settled, total
from tallyline.llm.words import pieces

#: Streams or wrappers aligned in one task, about.
FORMS = 16
LEAST_SEEN = 3
RARE = 256
LONGEST_GROUP = 40
TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<raw>script|style|noscript|template|svg|iframe|textarea|select|button)\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<[!?][^>]*>|<(?P<end>/?)(?P<name>[a-z][^\s/>]*)(?P<rest>(?:[^>=]|=\s*+(?:\"[^\"]*+\"|'[^']*+')|=)*+)>", re.I | re.S)
ATTRIBUTE = re.compile(r"([^\s=/>]++)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s>]++)))?+")
UNSEEN = re.compile(r"display\s*:\s*none", re.I)
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
SPACE = {"br", "img", "input", "hr", "meta", "link", "base", "source", "embed", "area", "col", "track", "param"}
CLOSES = {  # a start tag on the left ends an open element on the right
    "li": {"li", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"}, "tr": {"tr", "td", "th", "p"}, "td": {"td", "th", "p"}, "th": {"td", "th", "p"},
    "option": {"option"}, "tbody": {"thead", "tbody", "tr", "td", "th"}, "body": {"head"}}
NEVER = {"nav", "footer", "aside", "form", "head", "menu", "dialog", "fieldset", "title", "object", "canvas", "audio", "video", "map"}
MAIN_TAGS = {"article", "main"}
MAIN_WORDS = set("article content main post entry story body text".split())
BAD_WORDS = set(
    "ad ads adv advert adverts advertisement advertising adslot sponsor sponsored promo promotion banner nav navbar navigation menu breadcrumb breadcrumbs "
    "sidebar side rail aside widget widgets footer foot masthead topbar toolbar notice notices notification cookie cookies consent gdpr alert popup modal overlay "
    "newsletter subscribe subscription signup signin login register share sharing social related recommended recommendations comment comments commentlist reply replies respond "
    "discussion disqus feedback pagination pager skip copyright legal search contentinfo complementary dialog form".split())


class Block:
    """A text of a page: what it says, the hash of the path of elements down to it, and what their marks say.

    never: in an element that is side matter by its tag, or hidden. bad: below a word of side matter, inside the main
    element if there is one. main: in a main element or below a word of main matter. unsure: a word of side matter
    stands on the main element or around it.
    """

    __slots__ = ("bad", "main", "never", "path", "text", "unsure")

    def __init__(self, text: str, never: bool, bad: bool, main: bool, unsure: bool, path: int):
        self.text, self.never, self.bad, self.main, self.unsure, self.path = text, never, bad, main, unsure, path

    def rank(self) -> int:
        """How clearly the marks speak for the text: MAIN, UNSURE, PLAIN, SIDE or NEVER_KEPT."""
        if self.never:
            return NEVER_KEPT
        if self.bad:
            return SIDE
        return (UNSURE if self.unsure else MAIN) if self.main else PLAIN


NEVER_KEPT, SIDE, PLAIN, UNSURE, MAIN = range(5)


def marked(rest: str) -> tuple[str, set[str], bool]:
    """The class, id and role of a tag without digits, the words in them, and whether the element is hidden."""
    found: dict[str, str] = {}
    for name, *values in ATTRIBUTE.findall(rest):
        found.setdefault(name.lower(), "".join(values))
    marks = " ".join(found[name] for name in ("class", "id", "role") if name in found)
    hidden = "hidden" in found or found.get("aria-hidden", "").strip().lower() == "true" or bool(UNSEEN.search(found.get("style", "")))
    words = set(re.findall(r"[a-z]+", marks.lower()))
    return "".join("." + re.sub(r"\d+", "", w) for w in sorted(marks.split())) + "!" * hidden, words, hidden


def streamed(page: str) -> tuple[list[str], list[Block | None]]:
    """The token stream of a page: `<tag.mark>`, `</tag.mark>` and `#` for a text, with the texts beside it."""
    keys: list[str] = []
    blocks: list[Block | None] = []
    stack: list[tuple] = []  # tag, key, never, bad, main, unsure, path; inside: is there a main element
    top = (False, False, False, False, 0, False)
    said: list[str] = []
    at = 0

    def flush() -> None:
        text = " ".join(entities.unescape("".join(said)).split())
        said.clear()
        if text:
            keys.append("#")
            blocks.append(Block(text, *(stack[-1][2:7] if stack else top[:5])))

    def close(depth: int) -> None:
        while len(stack) > depth:
            keys.append("</" + stack.pop()[1] + ">")
            blocks.append(None)

    # No tag ends after the last ">", so none is looked for there, only a comment that the page's end closes.
    last = page.rfind(">") + 1
    rest = page.find("<!--", last) if "<!--" in page[last:] else len(page)
    for m in TAG.finditer(page[:last] + page[last:rest].replace("<", " ") + page[rest:]):
        said.append(page[at : m.start()])
        at = m.end()
        name = (m["name"] or "").lower()
        if not name or name in INLINE:
            continue
        if name in SPACE:
            said.append(" ")
            continue
        flush()
        if m["end"]:
            depth = next((d for d in range(len(stack) - 1, -1, -1) if stack[d][0] == name), None)
            if depth is not None:
                close(depth)
            continue
        ends = CLOSES.get(name, {"p"})
        while stack and stack[-1][0] in ends:
            close(len(stack) - 1)
        mark, words, hidden = marked(m["rest"])
        never, bad, main, unsure, path, inside = stack[-1][2:] if stack else top
        if name not in ("body", "html"):
            side, element = bool(words & BAD_WORDS), name in MAIN_TAGS
            if element and not inside:
                # Words around a main element, or on it, don't overrule it, but leave it unsure.
                bad, main, unsure, inside = False, True, bad or side, True
            else:
                bad, main = bad or side or (not inside and (name == "header" or "header" in words)), main or bool(words & MAIN_WORDS)
            never = never or name in NEVER
        never = never or hidden
        stack.append((name, name + mark, never, bad, main, unsure, xxhash.xxh3_64_intdigest(f"{path}<{name}{mark}"), inside))
        keys.append(f"<{name}{mark}>")
        blocks.append(None)
    said.append(page[at:])
    flush()
    close(0)
    return keys, blocks


def grouped(keys: list[str]) -> list[tuple[str, int, int]]:
    """(key, first, last) of the groups of a stream: blocks without blocks inside, and runs of equal neighbours."""
    items: list[tuple[str, int, int]] = []
    for at, key in enumerate(keys):
        if key.startswith("</") and items:
            # A text or nothing since the start tag: one token, the same with or without text.
            back = 2 if items[-1][0] == "#" and len(items) > 1 else 1
            if items[-back][0] == "<" + key[2:]:
                leaf = (f"{items[-back][0]}#?", items[-back][1], at + 1)
                del items[-back:]
                if items and items[-1][0] == leaf[0]:
                    leaf = (leaf[0], items[-1][1], at + 1)
                    items.pop()
                items.append(leaf)
                continue
        items.append((key, at, at + 1))
    size = 1
    while size <= min(LONGEST_GROUP, len(items) // 2):
        out, at, folded = [], 0, False
        names = [i[0] for i in items]
        while at < len(items):
            here = names[at : at + size]
            last = at + size
            if here[0].startswith("<") and balanced(here):
                while names[last : last + size] == here:
                    last += size
            if last > at + size:
                out.append((f"({' '.join(here)})+", items[at][1], items[last - 1][2]))
                at, folded = last, True
            else:
                out.append(items[at])
                at += 1
        items = out
        size = 1 if folded else size + 1
    return items


def balanced(keys: list[str]) -> bool:
    depth = 0
    for key in keys:
        if key.endswith(">"):
            depth += -1 if key.startswith("</") else 1
        if depth < 0:
            return False
    return depth == 0


def aligned(a: Sequence[int], b: Sequence[int]) -> list[tuple[int, int]]:
    """The places of a longest common subsequence of two lists, in pairs."""
    most = min(len(a), len(b))
    first = next((k for k in range(most) if a[k] != b[k]), most)
    last = next((k for k in range(most - first) if a[-1 - k] != b[-1 - k]), most - first)
    where: dict[int, list[int]] = {}
    for j in range(len(b) - last - 1, first - 1, -1):
        where.setdefault(b[j], []).append(j)
    # The least end in b of a chain of each length, and the chain; places in b come from the last to the first.
    ends: list[int] = []
    chains: list[tuple] = []
    for i in range(first, len(a) - last):
        for j in where.get(a[i], ()):
            k = bisect_left(ends, j)
            if k == len(ends):
                ends.append(j)
                chains.append((i, j, chains[k - 1] if k else None))
            elif ends[k] > j:
                ends[k], chains[k] = j, (i, j, chains[k - 1] if k else None)
    inner = []
    chain = chains[-1] if chains else None
    while chain:
        inner.append(chain[:2])
        chain = chain[2]
    return [(k, k) for k in range(first)] + inner[::-1] + [(len(a) - k, len(b) - k) for k in range(last, 0, -1)]


def fit(places: dict[int, list[int]], form: Sequence[int]) -> list[int]:
    """The leftmost places in a wrapper of a form's groups, one after another; -1 for a group that has none left."""
    out, last = [], -1
    for key in form:
        own = places.get(key, ())
        k = bisect_right(own, last)
        if k < len(own):
            last = own[k]
            out.append(last)
        else:
            out.append(-1)
    return out


def inferred(forms: list[list[int]]) -> list[int]:
    """The wrapper of streams or wrappers of one host: its groups, in order; what one of them lacks is optional."""
    wrapper: list[int] = []
    for form in forms:
        merged, i, j = [], 0, 0
        for x, y in aligned(wrapper, form):
            # Between matches: what the wrapper has and the form lacks is optional, and the other way round.
            merged += wrapper[i:x] + form[j : y + 1]
            i, j = x + 1, y + 1
        wrapper = merged + wrapper[i:] + form[j:]
    places: dict[int, list[int]] = {}
    for at, key in enumerate(wrapper):
        places.setdefault(key, []).append(at)
    used = {at for form in forms for at in fit(places, form)}
    return [key for at, key in enumerate(wrapper) if at in used]


def used_places(batches):
    """The places of wrappers that are the leftmost fit of a group of a form (host, bunch, wrapper, form)."""
    for batch in batches:
        known: dict[str, dict[int, list[int]]] = {}
        found: dict[tuple[str, int], dict[int, int]] = {}
        for host, bunch, wrapper, form in zip(*(batch.column(c).to_pylist() for c in ("host", "bunch", "wrapper", "form")), strict=True):
            groups = of_form(form)
            found.setdefault((host, bunch), {}).update(zip(fit(places_of(known, wrapper), groups), groups, strict=True))
        rows = list(zip(*((*k, at, key) for k, marks in found.items() for at, key in marks.items() if at >= 0), strict=True)) or [()] * 4
        yield pa.RecordBatch.from_arrays([pa.array(rows[0], pa.string()), *(pa.array(c, pa.int64()) for c in rows[1:])], names=["host", "bunch", "at", "key"])


def parsed(batches):
    """The streams of pages, one row for each: its groups (shape), and for every text its group, what its marks and path say, and its rank."""
    for batch in (piece for batch in batches for piece in pieces(batch, "html", AT_ONCE)):
        hashes: dict[str, int] = {}
        rows = []
        for page in batch.column("html").to_pylist():
            keys, blocks = streamed(page or "")
            items = grouped(keys)
            texts = [(at, block) for at, (_, first, last) in enumerate(items) for block in blocks[first:last] if block]
            for key, _, _ in items:
                if key not in hashes:
                    hashes[key] = signed(key)
            rows.append((
                [hashes[key] for key, _, _ in items], [block.text for _, block in texts], [at for at, _ in texts],
                [signed(f"{block.path} {block.rank()}") for _, block in texts], [block.rank() for _, block in texts]))
        columns = [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), STREAM, strict=True)]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("page_id", "url", "host")), *columns], names=["page_id", "url", "host", *STREAM.names])


#: Bytes of html parsed at once.
AT_ONCE = 3 << 20
STREAM = pa.schema([("shape", pa.list_(pa.int64())), ("texts", pa.list_(pa.string())), ("items", pa.list_(pa.int32())), ("places", pa.list_(pa.int64())), ("ranks", pa.list_(pa.int32()))])
STREAM_SQL = "page_id bigint, url string, host string, shape array<bigint>, texts array<string>, items array<int>, places array<bigint>, ranks array<int>"


def placed(columns: dict[str, list]):
    """For every page of the columns its texts in order, each with its slot in the wrapper of the page's host and its rank."""
    known: dict[str, dict[int, list[int]]] = {}
    for form, shape, *texts in zip(*(columns[c] for c in PLACED), strict=True):
        groups = fit(places_of(known, form), shape)
        yield [(text, signed(f"{groups[item]} {place}"), rank) for text, item, place, rank in zip(*texts, strict=True)]


def read_columns(columns: Sequence[pa.Array]) -> dict[str, list]:
    return {c: values.to_pylist() for c, values in zip(PLACED, columns, strict=True)}


PLACED = ("wrapper", "shape", "texts", "items", "places", "ranks")


def signed(text: str) -> int:
    """A hash that fits a bigint."""
    return xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass")) - (1 << 63)


def evidence(batches):
    """For the pages of a batch: on how many of them each slot of a host has text, and the extremes of the hashes of that text and of the page's."""
    for batch in batches:
        sums: dict[tuple[str, int], list[int]] = {}
        pages = placed(read_columns([batch.column(c) for c in PLACED]))
        for host, found in zip(batch.column("host").to_pylist(), pages, strict=True):
            said: dict[int, list[str]] = {}
            ranks: dict[int, int] = {}
            for text, slot, rank in found:
                ranks[slot] = rank
                said.setdefault(slot, []).append(text)
            whole = signed("\n".join("\n".join(texts) for texts in said.values()))
            for slot, texts in said.items():
                own = signed("\n".join(texts))
                _, n, low, high, first, last = sums.get((host, slot), (0, 0, own, own, whole, whole))
                sums[host, slot] = [ranks[slot], n + 1, min(low, own), max(high, own), min(first, whole), max(last, whole)]
        rows = list(zip(*((*k, *v) for k, v in sums.items()), strict=True)) or [()] * len(EVIDENCE)
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(rows, EVIDENCE, strict=True)], schema=EVIDENCE)


EVIDENCE = pa.schema([("host", pa.string()), *((c, pa.int64()) for c in ("slot", "rank", "seen", "low", "high", "page_low", "page_high"))])
EVIDENCE_SQL = "host string, slot bigint, rank bigint, seen bigint, low bigint, high bigint, page_low bigint, page_high bigint"


def of_form(form: str | None) -> list[int]:
    """The groups written as `form`."""
    return [int(x) for x in (form or "").split(",") if x]


def places_of(known: dict[str | None, dict[int, list[int]]], form: str | None) -> dict[int, list[int]]:
    """Where each group stands in the wrapper written as `form`, read once."""
    if form not in known:
        if len(known) >= 200:
            known.clear()
        places = known[form] = {}
        for at, key in enumerate(of_form(form)):
            places.setdefault(key, []).append(at)
    return known[form]


def extracted(found: list[tuple[str, int, int]], template: set[int], varied: set[int] = frozenset()) -> str:
    """The main text of a page: of its texts, with slot and rank, those to be kept in order, one to a line."""
    left = [(text, rank) for text, slot, rank in found if slot not in template and (rank > SIDE or rank == SIDE and slot in varied)]
    best = max((rank for _, rank in left), default=PLAIN)
    return "\n".join(text for text, rank in left if rank == best)


def host_of(url: Column) -> Column:
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))


def reduced(shape: Column, common: Column) -> Column:
    """The groups of a stream that are common on its host, in order and in one string."""

    @F.arrow_udf("string")
    def read(shape: pa.Array, common: pa.Array) -> pa.Array:
        known: dict[str | None, set[int]] = {}
        out = []
        for groups, form in zip(shape.to_pylist(), common.to_pylist(), strict=True):
            if form not in known:
                if len(known) >= 200:
                    known.clear()
                known[form] = set(of_form(form))
            out.append(",".join(str(g) for g in groups if g in known[form]))
        return pa.array(out, pa.string())

    return read(shape, common)


def wrappers(streams: DataFrame, most: int = FORMS) -> DataFrame:
    """(host, wrapper) of the hosts of all streams (host, shape), about `most` streams aligned at a time."""
    shapes = settled(streams.groupBy("host", "shape").agg(F.count("*").alias("n")), "shapes")
    sizes = shapes.groupBy(F.col("host").alias("h")).agg(F.sum("n").alias("pages"))
    groups = shapes.select("host", "n", F.explode(F.array_distinct("shape")).alias("key")).groupBy("host", "key").agg(F.sum("n").alias("seen"))
    often = groups.join(sizes, F.col("host") == F.col("h")).filter((F.col("seen") >= LEAST_SEEN) & (F.col("seen") * RARE >= F.col("pages")))
    common = settled(often.groupBy("host").agg(F.concat_ws(",", F.collect_list(F.col("key").cast("string"))).alias("common")), "groups")
    known = of_host(shapes.select("host", "shape"), common, "common").filter(F.col("common").isNotNull())
    forms = settled(known.select("host", reduced(F.col("shape"), F.col("common")).alias("form")).filter(F.col("form") != "").distinct(), "forms")
    most = max(2, most)
    # A host's forms are dealt by hash into most ** depth bunches, each step puts `most` of them together.
    depth = F.greatest(F.lit(0), F.floor(F.log(F.col("n") / most) / math.log(most) + 0.5)).cast("int")
    depths = settled(forms.groupBy(F.col("host").alias("h")).agg(F.count("*").alias("n")).select("h", depth.alias("depth")), "depths")
    forms = forms.join(depths, F.col("host") == F.col("h")).select("host", "form", "depth", F.xxhash64("form").alias("spot"))
    deepest, = total(depths, F.max("depth"))

    def align(rows: pa.Table) -> pa.Table:
        ordered = sorted(map(of_form, rows.column("wrapper").to_pylist()), key=lambda f: (len(f), f))
        return pa.table({
            "host": rows.column("host")[:1].combine_chunks(), "bunch": rows.column("bunch")[:1].combine_chunks(),
            "wrapper": pa.array([",".join(map(str, inferred(ordered)))], pa.string())})

    found = None
    for step in range(deepest, -1, -1):
        parts = F.lit(most**step)
        own = forms.withColumn("bunch", F.pmod("spot", parts))
        rows = own.filter(F.col("depth") == step).select("host", "bunch", F.col("form").alias("wrapper"))
        if found is None:
            found = settled(rows.groupBy("host", "bunch").applyInArrow(align, BUNCH_SQL), "wrappers")
            continue
        fresh = rows.groupBy("host", "bunch").applyInArrow(align, BUNCH_SQL)
        merged = found.withColumn("bunch", F.pmod("bunch", parts)).groupBy("host", "bunch").applyInArrow(align, BUNCH_SQL)
        wide = settled(merged.select(F.col("host").alias("h"), F.col("bunch").alias("b"), "wrapper"), "merged")
        weight, = total(wide, F.sum(F.length("wrapper") + F.length("h")))
        wide = F.broadcast(wide) if weight <= BROADCAST_BYTES else wide
        fits = own.filter(F.col("depth") > step).join(wide, (F.col("host") == F.col("h")) & (F.col("bunch") == F.col("b"))).select("host", "bunch", "wrapper", "form")
        places = fits.mapInArrow(used_places, "host string, bunch bigint, at bigint, key bigint").groupBy("host", "bunch").agg(F.sort_array(F.collect_set(F.struct("at", "key"))).alias("p"))
        short = places.select("host", "bunch", F.array_join(F.transform("p", lambda x: x["key"].cast("string")), ",").alias("wrapper"))
        found = settled(short.unionByName(fresh), "wrappers")
    return found.select("host", "wrapper")


BUNCH_SQL = "host string, bunch bigint, wrapper string"


def templates(pages: DataFrame) -> DataFrame:
    """(host, template): from all streams of pages with their hosts' wrappers, the slots of each host that say the same on all of their pages, and after a bar those of side matter that vary."""
    found = pages.select("host", *PLACED).mapInArrow(evidence, EVIDENCE_SQL).groupBy("host", "slot", "rank").agg(
        F.sum("seen").alias("seen"), *[F.min(c).alias(c) for c in ("low", "page_low")], *[F.max(c).alias(c) for c in ("high", "page_high")])
    same = (F.col("low") == F.col("high")) & (F.col("page_low") != F.col("page_high"))
    varies = (F.col("rank") == SIDE) & (F.col("low") != F.col("high"))
    judged = found.filter((F.col("seen") >= LEAST_SEEN) & (same | varies)).select("host", F.col("slot").cast("string").alias("slot"), same.alias("same"))
    lists = [F.concat_ws(",", F.sort_array(F.collect_list(F.when(c, F.col("slot"))))) for c in (F.col("same"), ~F.col("same"))]
    return settled(judged.groupBy("host").agg(F.concat_ws("|", *lists).alias("template")), "templates")


def main_text(template: Column, *stream: Column) -> Column:
    """The text of a page by its host's template and the columns PLACED; without a template, by the place of its blocks alone."""

    @F.arrow_udf("string")
    def read(template: pa.Array, *stream: pa.Array) -> pa.Array:
        slots: dict[str | None, list[set[int]]] = {}
        out = []
        for judged, found in zip(template.to_pylist(), placed(read_columns(stream)), strict=True):
            if judged not in slots:
                if len(slots) >= 200:
                    slots.clear()
                slots[judged] = [{int(x) for x in part.split(",") if x} for part in (judged or "|").split("|")]
            out.append(extracted(found, *slots[judged]))
        return pa.array(out, pa.string())

    return read(template, *stream)


def of_host(rows: DataFrame, forms: DataFrame, column: str) -> DataFrame:
    """The rows with the column that forms (host, column) gives their host, or null."""
    forms = forms.withColumnRenamed("host", "of_host")
    weight, = total(forms, F.sum(F.length(column) + F.length("of_host")))
    forms = F.broadcast(forms) if weight <= BROADCAST_BYTES else forms
    return rows.join(forms, F.col("host") == F.col("of_host"), "left").drop("of_host")


def extract(pages: DataFrame, most: int = FORMS) -> DataFrame:
    """page_id, url, text and n_chars of every row of pages."""
    rows = columns_of(pages, page_id="bigint", url="string", html="string").withColumn("host", host_of(F.col("url")))
    streams = settled(rows.mapInArrow(parsed, STREAM_SQL), "streams")
    known = of_host(streams, wrappers(streams, most), "wrapper")
    found = of_host(known, templates(known), "template").withColumn("text", main_text(F.col("template"), *map(F.col, PLACED)))
    return found.select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))

"""Main text of web pages from their structure and from repeats across a host.

Each page becomes a stream of blocks. Elements that name themselves as menus, headers,
notices and the like are chrome; an article or main element settles what the text is,
where a page has none it is all other blocks. These are judged by the host's suffix
array: token streams of a host's pages are put together, their suffixes ordered by their
first ``SPAN`` tokens, and neighbours that agree in all of them and come from distinct
pages are repeats. A block too short for that is compared whole, from border to border.
Blocks that repeats cover are boilerplate; unique runs stay.

How many pages make a repeat depends on where it stands. What is outside of settled text
is a repeat on ``MIN_PAGES`` pages, for pages without settled text. What stands on most of
the host's pages, wherever on them, is the host's template and a repeat for all pages, as
true sentences also stand in several articles, but not in most. Blocks that would be most
of a page's text are no template: versions of one article are not told from it otherwise.

The suffix array is a table, grouped by host and leading tokens, so one host may hold
any share of the pages. Pages with all the same blocks count once: copies of a page are
no evidence against its text. To find templates, all suffixes are counted by host in each
slice of the table first, and those that can't be on most pages go no further.
"""

import html
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import functions as F, types as T

from gradeloom.llm.catalog import query
from gradeloom.llm.filters import filter_of, held
from gradeloom.llm.tables import read
from gradeloom.sources.staging import stage

SPAN = 8
MIN_PAGES = 2
#: A template stands on more than a half of a host's distinct pages, and on so many.
TEMPLATE_PAGES = 4
#: Suffixes that a slice holds at most before its frequent ones are told.
SLICE = 1 << 22
#: A host's rows in a part of 4096 rows, on average, from which its pages stay where they are.
NEAR_ROWS = 16
PART_BITS = 12
#: Rows of a host that are put together else, about.
GATHERED_ROWS = 256
FILTER_BITS = 1 << 24
#: Characters of pages whose tokens are hashed together.
TOGETHER = 1 << 19

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style|textarea|title|iframe)(?=[\s/>])[^>]*>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?/][^>]*>",
    re.DOTALL | re.IGNORECASE,
)
#: Elements whose content is no text of the page, up to their end tag if there is one.
_SKIPPED = {
    tag: re.compile(rf"</{tag}\s*>", re.IGNORECASE) for tag in ("svg", "select", "template", "noscript")
}
_ATTRIBUTE = re.compile(r"""([^\s=/"']+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"']+))?""")
_WORDS = re.compile(r"[^\W_]+")
_HUMP = re.compile(r"(?<=[a-z])(?=[A-Z])")
_BLANK = re.compile(r"\s+")

INLINE = frozenset(
    "a abbr b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var wbr".split()
)
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
#: Elements that a next one of their kind, or the end of what holds them, ends.
UNCLOSED = frozenset("p li dt dd tr td th option h1 h2 h3 h4 h5 h6".split())
CHROME = frozenset("nav footer aside form button dialog menu head object fieldset option".split())
CHROME_NAMES = frozenset(
    "nav navbar navigation menu menubar sidebar side footer header masthead comment comments respond disqus "
    "replies notice notices alert banner cookie cookies consent gdpr ad ads advert adverts advertisement "
    "advertising sponsor sponsored promo promotion popup modal overlay newsletter subscribe subscription "
    "signup login search social share sharing related recommended breadcrumb breadcrumbs pagination pager "
    "widget toolbar topbar tags form copyright skip".split()
)
#: A class name with one of these says how an element is laid out, not what it is.
LAYOUT_NAMES = frozenset("with without has no not by in on and of group layout theme enabled".split())
CHROME_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert menu menubar form".split())
COMMENT_NAMES = frozenset("comment comments respond replies reply".split())
MAIN_NAMES = frozenset("article post entry story content main".split())


def _attributes(text):
    found = {}
    for name, value in _ATTRIBUTE.findall(text):
        found.setdefault(name.lower(), html.unescape(value.strip("\"'")))
    return found


def _kind(tag, text):
    """"chrome", "soft" (by its name only), "article", "main", "named" (a main-like name) or
    an empty string."""
    given = _attributes(text) if text.strip() else {}
    names = set()
    for name in " ".join(given.get(k, "") for k in ("class", "id")).split():
        words = {n.lower() for n in _WORDS.findall(_HUMP.sub(" ", name))}
        names |= words - CHROME_NAMES if words & LAYOUT_NAMES else words
    role = given.get("role", "").lower()
    hidden = "hidden" in given or given.get("aria-hidden") == "true" or re.search(
        r"display\s*:\s*none|visibility\s*:\s*hidden", given.get("style", "")
    )
    if hidden or tag in CHROME or role in CHROME_ROLES:
        return "chrome"
    if tag == "article" or role == "article":
        return "chrome" if names & COMMENT_NAMES else "article"
    if tag == "main" or role == "main":
        return "main"
    if tag == "body" or tag == "html":
        return ""
    if tag == "header":
        return "header"
    if names & CHROME_NAMES:
        return "chrome" if names & COMMENT_NAMES else "soft"
    return "named" if names & MAIN_NAMES else ""


class _Blocks:
    """Blocks of one page: [text, chrome (1 if by a name only, else 2), rank of what holds it]."""

    RANK = {"article": 3, "main": 2, "named": 1}

    def __init__(self):
        self.found, self._text = [], []
        #: (tag, kind, chrome, rank) of each open element, the latter two with what holds it.
        self._stack, self._open = [], Counter()

    def _state(self):
        return self._stack[-1][2:] if self._stack else (0, 0)

    def _push(self, tag, kind):
        chrome, rank = self._state()
        rank = max(rank, self.RANK.get(kind, 0))
        if kind == "chrome" or kind == "header" and rank < 2:
            chrome = 2
        elif kind == "soft":
            chrome = max(chrome, 1)
        self._stack.append((tag, kind, chrome, rank))
        self._open[tag] += 1

    def _pop(self):
        self._open[self._stack.pop()[0]] -= 1

    def flush(self):
        text = _BLANK.sub(" ", "".join(self._text)).strip()
        self._text.clear()
        if text:
            self.found.append((text, *self._state()))

    def text(self, text):
        self._text.append(text)

    def _close(self, tag):
        if self._open[tag]:
            while self._stack[-1][0] != tag:
                self._pop()
            self._pop()

    def start(self, tag, attributes):
        if tag in INLINE:
            if tag == "br":
                self._text.append(" ")
            kind = _kind(tag, attributes) if tag in ("span", "a", "label") and attributes.strip() else ""
            if kind in ("chrome", "soft"):
                self.flush()
                self._push(tag, kind)
            return
        self.flush()
        if tag in VOID:
            return
        if self._stack and self._stack[-1][0] in UNCLOSED and (
            tag == self._stack[-1][0] or self._stack[-1][0] in ("p", "option") or self._stack[-1][0][0] == "h"
        ):
            self._pop()
        if not attributes.endswith("/"):
            self._push(tag, _kind(tag, attributes))

    def end(self, tag):
        if tag in INLINE:
            if self._open[tag]:  # only such of them as are chrome are held
                self.flush()
                self._close(tag)
            return
        self.flush()
        self._close(tag)


def blocks(page):
    """[(text, chrome, rank)] of a page in order; None counts as empty."""
    page, found, at, endless = page or "", _Blocks(), 0, set()
    while (token := _TOKEN.search(page, at)) is not None:
        if token.start() > at:
            found.text(html.unescape(page[at : token.start()]))
        at, tag = token.end(), (token[3] or "").lower()
        if not tag:
            continue
        if token[2]:
            found.end(tag)
        elif tag not in _SKIPPED:
            found.start(tag, token[4])
        elif tag not in endless and not (tag == "svg" and token[4].endswith("/")):
            end = _SKIPPED[tag].search(page, at)
            if end is None:  # without an end it holds nothing
                endless.add(tag)
            else:
                at = end.end()
    found.text(html.unescape(page[at:]))
    found.flush()
    return found.found


def split_page(page):
    """(settled text or None, unsettled blocks, blocks of the host's stream).

    A page with an article, main or so named element is settled. The stream holds all
    blocks of the page. If names alone make all of a page chrome, they are not believed.
    """
    found = blocks(page)
    settled, own = _split(found)
    stream = [t for t, _, _ in found]
    text = [t for t, kept in zip(stream, own) if kept]
    return ("\n".join(text), [], stream) if settled else (None, text, stream)


def _split(found):
    """Whether structure settles the text, and for each block whether it is of the text."""
    if found and all(chrome for _, chrome, _ in found):
        # All of the page's text can't be notices: what is such by name only stays.
        found = [(text, chrome == 2, rank) for text, chrome, rank in found]
    best = max((rank for _, chrome, rank in found if not chrome), default=0)
    return best > 0, [rank >= best and not chrome for _, chrome, rank in found]


class _Hashes(dict):
    def __missing__(self, word):
        value = self[word] = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))
        return value


def suffix_keys(streams, span=SPAN):
    """Keys of the suffixes of each stream: the hash of the first ``span`` tokens of each
    that has as many, then the names of the short blocks."""
    words, ends = [], []
    for stream in streams:
        for block in stream:
            words += block.split()
        ends.append(len(words))
    hashes = np.fromiter(map(_Hashes().__getitem__, words), np.uint64, len(words))
    lead = np.zeros(max(len(words) - span + 1, 0), np.uint64)
    with np.errstate(over="ignore"):
        for i in range(span):
            lead = lead * np.uint64(0x9E3779B97F4A7C15) + hashes[i : i + len(lead)]
            lead ^= lead >> np.uint64(29)
    lead, keys = lead.view(np.int64), []
    for stream, start, end in zip(streams, [0, *ends], ends):
        short = np.array([_name(stream[n], 1) for n in short_blocks(stream, span)], np.int64)
        keys.append(np.concatenate([lead[start : max(end - span + 1, start)], short]))
    return keys


def _name(text, seed):
    return xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass"), seed) - (1 << 63)


def short_blocks(stream, span=SPAN):
    """Places in the stream of the blocks below ``span`` tokens."""
    return [n for n, block in enumerate(stream) if len(block.split()) < span]


def _covered_blocks(stream, repeated, span=SPAN):
    """For each block of the stream whether repeats cover it wholly.

    A repeat is given by its place among the suffixes of ``span`` tokens, followed by the
    short blocks.
    """
    starts = np.cumsum([0, *(len(b.split()) for b in stream)])
    suffixes = max(starts[-1] - span + 1, 0)
    short = short_blocks(stream, span)
    covered = np.zeros(starts[-1] + 1, np.int32)
    for place in repeated:
        start, end = place, place + span
        if place >= suffixes:
            start, end = starts[short[place - suffixes]], starts[short[place - suffixes] + 1]
        covered[start] += 1
        covered[min(end, len(covered) - 1)] -= 1
    covered = np.cumsum(covered) > 0
    return [bool(covered[start:end].all()) for start, end in zip(starts, starts[1:])]


def unique_runs(stream, own, repeated, templates, span=SPAN):
    """Blocks of a page's text, as ``own`` tells for each of its stream, that are not wholly
    covered by repeats, nor by templates, unless these would be most of the text."""
    if templates:
        gone = _covered_blocks(stream, templates, span)
        sizes = [len(block.split()) if kept else 0 for block, kept in zip(stream, own)]
        if 2 * sum(n for n, out in zip(sizes, gone) if out) <= sum(sizes):
            repeated = [*repeated, *templates]
    gone = _covered_blocks(stream, repeated, span)
    return [block for block, kept, out in zip(stream, own, gone) if kept and not out]


SPLIT = (
    T.StructType()
    .add("_settled", "boolean")
    .add("_stream", T.ArrayType(T.StringType()))
    .add("_own", T.ArrayType(T.BooleanType()))
    .add("_leads", T.ArrayType(T.LongType()))
    .add("_page", "long")
)


def _split_pages(df, page):
    """Pages as streams. ``_leads`` are the suffixes of what is outside of settled text."""
    schema = T.StructType(df.schema.fields + SPLIT.fields)

    def split_batches(batches):
        for batch in batches:
            rows = []
            for value in batch.column(page):
                found = blocks(value.as_py())
                settled, own = _split(found)
                stream = [t for t, _, _ in found]
                outside = [t for t, kept in zip(stream, own) if not kept] if settled else stream
                rows.append((settled, stream, own, suffix_keys([outside])[0], _name("\n".join(stream), 0)))
            columns = list(zip(*rows)) if rows else [()] * 5
            types = [pa.bool_(), pa.list_(pa.string()), pa.list_(pa.bool_()), pa.list_(pa.int64()), pa.int64()]
            added = [pa.array(c, t) for c, t in zip(columns, types)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], schema.names)

    return df.mapInArrow(split_batches, schema).drop(page)


def _keys_of(batch):
    """(first row, keys of it and the next ones) for some rows of a batch after others."""
    streams, size = [], 0
    for n, stream in enumerate(batch.column("_stream"), 1):
        streams.append(stream.as_py())
        size += sum(map(len, streams[-1]))
        if size >= TOGETHER or n == batch.num_rows:
            yield n - len(streams), suffix_keys(streams)
            streams, size = [], 0


def _suffixes(pages, among):
    """The suffixes of the pages' streams that are in the table ``among``, by host and key,
    each with its place. A filter leaves most others where they are."""
    found = filter_of(among, "_lead", FILTER_BITS)
    others = [c for c in pages.columns if c != "_stream"]
    schema = T.StructType([pages.schema[c] for c in others]).add("_place", "integer").add("_lead", "long")

    def suffix_batches(batches):
        for batch in batches:
            for first, keys in _keys_of(batch):
                counts = [len(k) for k in keys]
                rows = np.repeat(np.arange(first, first + len(keys)), counts)
                places = np.concatenate([np.arange(n, dtype=np.int32) for n in counts])
                leads = np.concatenate(keys)
                may = held(found, leads.view(np.uint64), FILTER_BITS)
                columns = [batch.column(c).take(pa.array(rows[may])) for c in others]
                columns += [pa.array(places[may]), pa.array(leads[may])]
                yield pa.RecordBatch.from_arrays(columns, schema.names)

    return pages.mapInArrow(suffix_batches, schema).join(among, ["_host", "_lead"], "left_semi")


def _frequent(pages):
    """Host and key of the suffixes that may be on more than a half of a host's ``_pages``
    distinct pages, which are ``_rows`` rows.

    A slice with m pages of a host tells those on more than m * _pages / (2 * _rows) of
    them. A suffix on no more than that in any slice is on _pages / 2 pages at most.
    """
    schema = T.StructType().add("_host", "long").add("_lead", "long")

    def told(hosts):
        for host, (pages, rows, found) in hosts.items():
            keys, counts = np.unique(np.concatenate(list(found.values())), return_counts=True)
            keys = keys[2 * rows * counts > pages * len(found)]
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), host)), pa.array(keys)], schema.names)

    def frequent_batches(batches):
        hosts, size = {}, 0
        for batch in batches:
            named = list(zip(*(batch.column(c).to_pylist() for c in ("_host", "_pages", "_rows", "_page"))))
            for first, keys in _keys_of(batch):
                for (host, pages, rows, page), of_page in zip(named[first:], keys):
                    found = hosts.setdefault(host, (pages, rows, {}))[2]
                    if page not in found:
                        found[page] = np.unique(of_page)
                        size += len(found[page])
                if size >= SLICE:
                    yield from told(hosts)
                    hosts, size = {}, 0
        yield from told(hosts)

    return pages.mapInArrow(frequent_batches, schema)


def _hosts(split):
    """Hosts with their number of distinct pages, of rows and of the table's parts."""
    placed = split.where("size(_stream) > 0").withColumn("_part", F.shiftright("_row", PART_BITS))
    placed = placed.groupBy("_host", "_page", "_part").agg(F.count("*").alias("_rows"))
    return placed.groupBy("_host").agg(
        F.count_distinct("_page").alias("_pages"),
        F.sum("_rows").alias("_rows"),
        F.count_distinct("_part").alias("_parts"),
    )


def _templates(split):
    """Host and key of the suffixes that stand on most of the host's distinct pages."""
    hosts = stage(_hosts(split).where(F.col("_pages") >= TEMPLATE_PAGES), "hosts")
    pages = split.select("_host", "_page", "_stream")
    # Hosts with a few rows in each of many parts are put together for larger slices.
    scattered = (F.col("_parts") > 1) & (F.col("_rows") < NEAR_ROWS * F.col("_parts"))
    piece = F.pmod(F.xxhash64("_row"), F.ceil(F.col("_rows") / GATHERED_ROWS))
    near = pages.join(hosts.where(~scattered), "_host")
    gathered = split.select("_row", "_host", "_page", "_stream").join(hosts.where(scattered), "_host")
    gathered = gathered.repartition("_host", piece).sortWithinPartitions("_host")
    frequent = stage(_frequent(near).union(_frequent(gathered)).distinct(), "frequent-suffixes")
    return (
        _suffixes(pages, frequent)
        .select("_host", "_lead", "_page")
        .distinct()
        .groupBy("_host", "_lead")
        .agg(F.count("*").alias("_on"))
        .where(F.col("_on") >= TEMPLATE_PAGES)
        .join(hosts, "_host")
        .where("2 * _on > _pages")
        .select("_host", "_lead")
    )


def host_of(url):
    host = F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)", 1))
    return F.regexp_replace(host, r"^www\.", "")


def extract_main_text(df, page="html", url="url", min_pages=MIN_PAGES):
    """Replace the column ``page`` by ``text`` and its length ``n_chars``.

    A null, empty or textless page gives an empty text. Pages without a url form one
    host. Repeated rows are kept; a column named ``text`` or ``n_chars`` is replaced.
    """
    df = df.drop("text", "n_chars")
    others = [c for c in df.columns if c != page]
    named = df.withColumn("_host", F.xxhash64(host_of(F.col(url))))
    split = _split_pages(named, page).withColumn("_row", F.monotonically_increasing_id())
    split = stage(split, "split-pages")
    outside = split.select(
        "_row", "_host", "_page", (~F.col("_settled")).alias("_open"),
        F.posexplode_outer("_leads").alias("_place", "_lead"),
    ).where("_lead is not null")
    repeats = (
        outside.groupBy("_host", "_lead", "_page")
        .agg(F.max("_open").alias("_open"))
        .groupBy("_host", "_lead")
        .agg(F.count("*").alias("_pages"), F.max("_open").alias("_open"))
        .where((F.col("_pages") >= min_pages) & F.col("_open"))
    )
    repeated = outside.where("_open").join(repeats.select("_host", "_lead"), ["_host", "_lead"], "left_semi")
    templates = stage(_templates(split), "templates")
    of_templates = _suffixes(split.select("_row", "_host", "_stream"), templates)
    covered = (
        repeated.select("_row", "_place", F.lit(False).alias("_template"))
        .unionByName(of_templates.select("_row", "_place", F.lit(True).alias("_template")))
        .groupBy("_row")
        .agg(
            F.collect_list(F.when(~F.col("_template"), F.col("_place"))).alias("_places"),
            F.collect_list(F.when(F.col("_template"), F.col("_place"))).alias("_templates"),
        )
    )
    covered = stage(covered, "covered")
    schema = T.StructType([df.schema[c] for c in others]).add("text", "string").add("n_chars", "long")

    def join_batches(batches):
        for batch in batches:
            given = (batch.column(c).to_pylist() for c in ("_stream", "_own", "_places", "_templates"))
            texts = ["\n".join(unique_runs(*of_page)) for of_page in zip(*given)]
            columns = [batch.column(c) for c in others]
            lengths = pa.array(map(len, texts), pa.int64())
            yield pa.RecordBatch.from_arrays([*columns, pa.array(texts, pa.string()), lengths], schema.names)

    own = F.filter(F.arrays_zip("_stream", "_own"), lambda block: block["_own"])
    text = F.array_join(F.transform(own, lambda block: block["_stream"]), "\n")
    whole = split.join(covered.select("_row"), "_row", "left_anti").select(*others, text.alias("text"))
    whole = whole.withColumn("n_chars", F.length("text").cast("long"))
    judged = split.drop("_leads", "_page").join(covered, "_row")
    return whole.unionByName(judged.mapInArrow(join_batches, schema))


@query("op1_host_suffix_array")
def op1_host_suffix_array(spark, sf_dir):
    return extract_main_text(read(spark, sf_dir, "pages").select("page_id", "url", "html"))

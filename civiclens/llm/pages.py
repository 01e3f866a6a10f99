"""Main text of web pages: page structure, and runs that a host repeats across its pages.

A page is a stream of blocks. What stands in an article is its text, what stands in elements made for
menus, notices and the like is not. Blocks outside both are open: of these, runs of words that
other pages of the host repeat are template text and are removed, and the unique runs are kept. The runs come
from suffix arrays over the host's streams outside articles (see ``repeats``); marked template blocks
take part as evidence, since one page's menu is often another's unmarked block. Words of an article are
never removed for being repeated: pages may quote each other.
"""

from __future__ import annotations

import itertools
import re
from collections import Counter
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civiclens.llm.common import Batches, Scratch, map_batches, table
from civiclens.llm.repeats import merged, repeats

col = F.col

RUN_BYTES = 40
"""Least length of a repeated run, about seven words."""
GRAM = 12
LEAST_WORDS = 4
"""A run that reaches less far into a block, without filling it, belongs to the block beside it."""
MAIN, OPEN, TEMPLATE = 0, 1, 2
WRAPPER = 3
"""Set by what may also enclose the whole page or be left unclosed: template text, unless an article opens in it."""

# Elements of HTML and words that page templates use.
TEMPLATE_ELEMENTS = frozenset(
    "nav aside footer form script style template noscript iframe object svg canvas button select textarea menu dialog head title".split()
)
WRAPPERS = frozenset("nav aside footer form header".split())
IN_HEAD = frozenset("head title base basefont bgsound link meta noframes noscript script style template".split())
UNSEEN = frozenset("script style template noscript iframe object svg canvas head title".split())
OUTER_ELEMENTS = frozenset(["header"])
VOID_ELEMENTS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE_ELEMENTS = frozenset(
    "a abbr b bdi bdo cite code data dfn em font i img kbd mark q s samp small span strike strong sub sup time tt u var wbr".split()
)
CLOSES_PARAGRAPH = frozenset(
    "address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split()
)
ITEMS = frozenset("li dt dd tr td th option".split())
TEMPLATE_WORDS = frozenset(
    "ad ads advert advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies "
    "disclaimer menu modal nav navbar navigation newsletter notice popup promo related share sharing sidebar social "
    "sponsor sponsored subscribe toolbar widget".split()
)
OUTER_WORDS = frozenset("footer header masthead".split())
TEMPLATE_ROLES = frozenset("alert banner complementary contentinfo dialog menu menubar navigation search".split())

WORDS = re.compile(r"[^a-z0-9]+|(?<=[a-z])(?=[0-9])")
UNFINISHED = re.compile(r"<[a-zA-Z/!?]")
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden")


class Blocks(HTMLParser):
    """Blocks (kind, text) of a page in order; white space within one is a single space."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, int | None]] = []  # name, and the kind it sets
        self.names: Counter[str] = Counter()  # of the open elements
        self.kinds: list[int] = []  # that they set, and how many of each
        self.set: Counter[int] = Counter()
        self.unseen = 0
        self.blocks: list[tuple[int, str]] = []
        self.pieces: list[str] = []

    def kind(self) -> int:
        if self.set[TEMPLATE]:
            return TEMPLATE
        return OPEN if not self.kinds else MAIN if self.kinds[-1] == MAIN else TEMPLATE

    def _push(self, tag: str, sets: int | None) -> None:
        self.open.append((tag, sets))
        self.names[tag] += 1
        self.unseen += tag in UNSEEN
        if sets is not None:
            self.kinds.append(sets)
            self.set[sets] += 1

    def _pop_to(self, size: int) -> None:
        """Close elements until so many are open; each is closed once, so a page takes time in proportion to its length."""
        while len(self.open) > size:
            tag, sets = self.open.pop()
            self.names[tag] -= 1
            self.unseen -= tag in UNSEEN
            if sets is not None:
                self.set[self.kinds.pop()] -= 1

    def flush(self) -> None:
        text = " ".join("".join(self.pieces).split())
        if text:
            self.blocks.append((self.kind(), text))
        self.pieces = []

    def _sets(self, tag: str, attributes: list[tuple[str, str | None]]) -> int | None:
        if tag in ("html", "body"):
            return None
        values = {name: (value or "").lower() for name, value in attributes}
        words = set(WORDS.split(f"{values.get('class', '')} {values.get('id', '')}".lower()))
        inside = self.kind() == MAIN
        hidden = "hidden" in values or values.get("aria-hidden") == "true" or HIDDEN.search(values.get("style", ""))
        if tag in TEMPLATE_ELEMENTS - WRAPPERS or hidden:
            return TEMPLATE
        marked = self._marked(tag, words, values, inside)
        if tag in ("article", "main") or values.get("role") in ("main", "article"):
            # An article inside another's comments or related links is no text of its own.
            within = self.set[MAIN] > 0 and not inside
            return WRAPPER if within or (marked and inside) else MAIN
        return WRAPPER if marked else None

    @staticmethod
    def _marked(tag: str, words: set[str], values: dict[str, str], inside: bool) -> bool:
        if tag in TEMPLATE_ELEMENTS or words & TEMPLATE_WORDS or values.get("role") in TEMPLATE_ROLES:
            return True
        return not inside and (tag in OUTER_ELEMENTS or bool(words & OUTER_WORDS))

    def handle_starttag(self, tag: str, attributes: list[tuple[str, str | None]]) -> None:
        if tag not in INLINE_ELEMENTS:
            self.flush()
        # </head> may be left out: what cannot stand in a head ends it.
        if tag not in IN_HEAD and self.open and self.open[-1][0] == "head":
            self._close("head", frozenset())
        if tag in VOID_ELEMENTS:
            return
        if tag in CLOSES_PARAGRAPH:
            self._close("p", CLOSES_PARAGRAPH - {"p"})
        elif tag in ITEMS:
            self._close(tag, frozenset(["ul", "ol", "dl", "table", "tr"] if tag != "tr" else ["table"]))
        sets = self._sets(tag, attributes)
        if sets is not None:
            self.flush()
        self._push(tag, sets)

    def handle_startendtag(self, tag: str, attributes: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attributes)
        if tag not in VOID_ELEMENTS and tag not in ("script", "style"):
            self.handle_endtag(tag)

    def _close(self, tag: str, bounds: frozenset[str]) -> None:
        """Close an element left open, unless it lies outside of the innermost bound."""
        if not self.names[tag]:
            return
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] == tag:
                self._pop_to(i)
                return
            if self.open[i][0] in bounds:
                return

    def handle_endtag(self, tag: str) -> None:
        for i in range(len(self.open) - 1, -1, -1) if self.names[tag] else ():
            if self.open[i][0] == tag:
                if tag not in INLINE_ELEMENTS or any(sets is not None for _, sets in self.open[i:]):
                    self.flush()
                self._pop_to(i)
                return
        if tag not in INLINE_ELEMENTS:
            self.flush()

    def handle_data(self, data: str) -> None:
        if self.open and self.open[-1][0] == "head" and data.strip():
            self._close("head", frozenset())
        if not self.unseen:
            self.pieces.append(data)


def blocks(html: str) -> list[tuple[int, str]]:
    parser = Blocks()
    parser.feed(html)
    if UNFINISHED.match(parser.rawdata):  # a tag or comment cut off by the end of the page is no text
        parser.rawdata = ""
    parser.close()
    parser.flush()
    return parser.blocks


def stream(found: list[tuple[int, str]]) -> bytes:
    """Blocks outside articles, each ended by a line feed."""
    return "".join(f"{text}\n" for kind, text in found if kind != MAIN).encode("utf-8", "replace")


def main_text(found: list[tuple[int, str]], repeated: list[tuple[int, int]]) -> str:
    """Articles and the unique runs of open blocks; ``repeated`` are merged spans of the stream."""
    kept, place, runs = [], 0, iter(repeated)
    run = next(runs, None)
    for kind, text in found:
        if kind == MAIN:
            kept.append(text)
            continue
        words, covered = text.split(" "), []
        for word in words:
            end = place + len(word.encode("utf-8", "replace"))
            while run is not None and run[1] < end:
                run = next(runs, None)
            covered.append(run is not None and run[0] <= place and end <= run[1])
            place = end + 1
        unique = []
        for repeats_host, part in itertools.groupby(zip(covered, words), key=lambda pair: pair[0]):
            part = [word for _, word in part]
            if not repeats_host or len(part) < min(LEAST_WORDS, len(words)):
                unique += part
        if kind == OPEN and unique:
            kept.append(" ".join(unique))
    return " ".join(kept)


def _streams(pages: DataFrame) -> DataFrame:
    """Per page its stream outside articles; all blocks where one of them is open."""

    def run(batches: Batches) -> Batches:
        for batch in batches:
            streams, kinds, texts = [], [], []
            for html in batch.column(1):
                found = blocks(html.as_py() or "")
                streams.append(stream(found))
                if all(kind != OPEN for kind, _ in found):
                    found = []
                kinds.append([kind for kind, _ in found])
                texts.append([text for _, text in found])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(streams, pa.binary()),
                    pa.array(kinds, pa.list_(pa.int32())),
                    pa.array(texts, pa.list_(pa.string())),
                    batch.column(2),
                ],
                ["page_id", "body", "kinds", "texts", "url"],
            )

    schema = "page_id long, body binary, kinds array<int>, texts array<string>, url string"
    return map_batches(pages.select("page_id", "html", "url"), run, schema)


def _structured(pages: DataFrame) -> DataFrame:
    """Text of the pages without open blocks."""

    def run(batches: Batches) -> Batches:
        for batch in batches:
            found = [blocks(html.as_py() or "") for html in batch.column(1)]
            whole = pa.array([all(kind != OPEN for kind, _ in page) for page in found], pa.bool_())
            texts = pa.array([main_text(page, []) for page in found], pa.string())
            columns = [batch.column(0), batch.column(2), texts]
            yield pa.RecordBatch.from_arrays(columns, ["page_id", "url", "text"]).filter(whole)

    return map_batches(pages.select("page_id", "html", "url"), run, "page_id long, url string, text string")


def _unstructured(pages: DataFrame, spans: DataFrame) -> DataFrame:
    """Text of the pages with open blocks, by the host's repeated runs."""
    by_page = spans.groupBy(col("doc").alias("page_id"), "tag").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    joined = pages.join(by_page, ["page_id", "tag"], "left")

    def run(batches: Batches) -> Batches:
        for batch in batches:
            texts = [
                main_text(list(zip(kinds.as_py(), texts.as_py())), merged([(s["start"], s["end"]) for s in spans.as_py() or ()]))
                for kinds, texts, spans in zip(batch.column(2), batch.column(3), batch.column(4))
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(texts, pa.string())], ["page_id", "url", "text"])

    return map_batches(
        joined.select("page_id", "url", "kinds", "texts", "spans"), run, "page_id long, url string, text string"
    )


def main_texts(
    frame: DataFrame, id_column: str = "page_id", url: str = "url", html: str = "html", run_bytes: int = RUN_BYTES
) -> DataFrame:
    """page_id, url and text of every row.

    A NULL page is empty, a page without text has the text ''. A URL without a host shares one group
    with the others like it. A page without an id takes no part in the comparison and keeps its open blocks
    whole; rows repeated whole are one page, different pages under one id are several. Other columns are ignored.
    """
    scratch = Scratch(frame.sparkSession, "pages")
    pages = frame.select(col(id_column).cast("long").alias("page_id"), col(html).alias("html"), col(url).alias("url"))
    streams = scratch.stage(_streams(pages), "streams")
    host = F.xxhash64(F.lower(F.coalesce(F.regexp_extract("url", r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1), F.lit(""))))
    streams = streams.withColumn("tag", F.xxhash64("body", host))
    bodies = streams.where("page_id IS NOT NULL").select(col("page_id").alias("doc"), "tag", host.alias("salt"), "body")
    spans = scratch.stage(repeats(bodies, run_bytes, GRAM, True, scratch), "spans")
    return _structured(pages).union(_unstructured(streams.where(F.size("kinds") > 0), spans))


def op3_host_suffix_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Main text of every page."""
    texts = main_texts(table(spark, folder, "pages"))
    return texts.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))

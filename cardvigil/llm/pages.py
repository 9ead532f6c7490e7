"""Main text of web pages: flat text blocks, classified by a decision tree.

A page is read once from left to right and cut into blocks of text wherever a tag that
isn't inline begins or ends. A block is described by its words and link density, those
of the blocks before and after it, and by what the elements around it say of themselves. A
decision tree, trained on the blocks of a small table of labelled pages, tells which blocks are
main text; they are joined in page order. In the table many pages name nothing, or name it
wrongly, so that words and links decide wherever names don't.

What elements say: an element or a role made for boilerplate, or a class or id that ends in a
word for it, counts for all it holds. A class that merely contains such a word ("share-enabled",
"with-sidebar") counts less, and not at all where it is on an element made for content or around one.

Defined results: null or empty html has an empty text. Character references are
decoded, white space inside a block becomes one space. Broken markup is read like text
or closed at the page's end; of an element that isn't text, like a button, what is left open
ends where the next block begins or the element around it ends; an unclosed script or style
takes the rest of the page. Every row gives one row, repeated rows and null ids or urls
included; other input columns are not read.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, SparkSession

from cardvigil.llm.words import pieces

# Names of elements and the words that classes and ids use for page parts.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q s samp small span strike strong sub sup time tt u var wbr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style".split())
SKIPPED = frozenset("head noscript template svg math iframe object audio video canvas select textarea button title".split())
BOILERPLATE_TAGS = frozenset("nav footer aside form menu dialog fieldset".split())
CONTENT_TAGS = frozenset("article main".split())
BOILERPLATE_WORDS = frozenset(
    "ad ads advert adverts advertisement banner breadcrumb breadcrumbs comment comments consent cookie cookies disclaimer disqus "
    "footer form login masthead menu modal nav navbar navigation newsletter notice notices pager pagination popup promo promoted "
    "related reply search share sharing sidebar signup social sponsor sponsored subscribe toolbar widget".split()
)
BOILERPLATE_ROLES = frozenset("alert banner complementary contentinfo dialog form menu menubar navigation search".split())
CONTENT_WORDS = frozenset("article content entry main post story".split())
#: A class that begins with one of these tells of something elsewhere.
MODIFIERS = frozenset("has hide is no not show with without".split())
CLOSED_BY_BLOCK = frozenset(["p"])
SELF_CLOSING = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
BLOCKS_IN_TEXT = frozenset(
    "address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split()
)

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^<>\"']++|\"[^\"]*\"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"(class|id|role|data-main)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))|\b(data-main)\b", re.I)
_PART = re.compile(r"[a-z0-9]+")


@dataclass
class Block:
    text: str
    words: int
    linked: int
    article: bool
    content: bool
    boilerplate: bool
    hinted: bool
    heading: bool
    main: bool

    @property
    def named(self) -> int:
        """What the elements around say, from -2, boilerplate, to 2, an article; 0 is nothing."""
        if self.boilerplate:
            return -2
        return 2 if self.article else 1 if self.content else -1 if self.hinted else 0

    @property
    def density(self) -> float:
        return self.linked / self.words if self.words else 0.0


@dataclass
class _Open:
    tag: str
    article: bool = False
    content: bool = False
    boilerplate: bool = False
    hint: bool = False
    main: bool = False
    skipped: bool = False
    heading: bool = False
    closed: bool = False
    #: Hints that count no more inside this element.
    silenced: int = 0


_COUNTED = ("article", "content", "boilerplate", "hint", "main", "skipped", "heading")
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())


def _told(tag: str, attributes: str) -> _Open:
    """What an element says of itself."""
    found = _Open(tag, article=tag == "article", content=tag in CONTENT_TAGS, boilerplate=tag in BOILERPLATE_TAGS, skipped=tag in SKIPPED, heading=tag in _HEADINGS)
    if "=" not in attributes and "data-main" not in attributes:
        return found
    named = False
    for attribute in _ATTRIBUTE.finditer(attributes):
        name = (attribute[1] or attribute[5]).lower()
        value = (attribute[2] or attribute[3] or attribute[4] or "").lower()
        if name == "data-main":
            found.main = True
        elif name == "role":
            found.boilerplate |= value in BOILERPLATE_ROLES
            found.content |= value in CONTENT_TAGS
        elif tag not in ("body", "html"):
            for token in value.split():
                parts = _PART.findall(token)
                if parts and parts[-1] in BOILERPLATE_WORDS and parts[0] not in MODIFIERS:
                    found.boilerplate = True
                elif any(p in BOILERPLATE_WORDS for p in parts):
                    found.hint = True
                elif parts and parts[-1] in CONTENT_WORDS:
                    named = True
    if found.boilerplate:
        found.article = found.content = False
    else:
        found.content |= named
    if found.content:
        found.hint = False
    return found


class _Page:
    """The state of reading one page."""

    def __init__(self) -> None:
        self.stack: list[_Open] = []
        #: Of each tag its elements that are open, innermost last.
        self.of_tag: dict[str, list[_Open]] = {}
        self.inside = dict.fromkeys(_COUNTED, 0)
        self.blocks: list[Block] = []
        self.texts: list[str] = []
        self.links: list[str] = []

    def add(self, text: str) -> None:
        if self.inside["skipped"]:
            return
        if "&" in text:
            text = entities.unescape(text)
        self.texts.append(text)
        if self.of_tag.get("a"):
            self.links.append(text)

    def flush(self) -> None:
        found = "".join(self.texts).split()
        if found:
            linked = len(" ".join(self.links).split())
            inside = self.inside
            self.blocks.append(
                Block(
                    " ".join(found), len(found), min(linked, len(found)), inside["article"] > 0, inside["content"] > 0,
                    inside["boilerplate"] > 0, inside["hint"] > 0, inside["heading"] > 0, inside["main"] > 0,
                )
            )
        self.texts, self.links = [], []

    def _count(self, element: _Open, by: int) -> None:
        for name in _COUNTED:
            self.inside[name] += by * getattr(element, name)
        self.inside["hint"] -= by * element.silenced

    def _leave(self) -> None:
        """Closes the innermost element."""
        top = self.stack.pop()
        if not top.closed:
            self.of_tag[top.tag].pop()
            self._count(top, -1)

    def open(self, tag: str, attributes: str) -> None:
        if tag in BLOCKS_IN_TEXT or tag == "body":
            # What isn't text, and is left open, ends where a block begins.
            while self.stack and (self.stack[-1].skipped or self.stack[-1].closed):
                self._leave()
        if tag in BLOCKS_IN_TEXT and self.stack and self.stack[-1].tag in CLOSED_BY_BLOCK:
            self._leave()
        while self.stack and (self.stack[-1].closed or self.stack[-1].tag in SELF_CLOSING.get(tag, ())):
            self._leave()
        if tag == "a":
            self.close("a")
        told = _told(tag, attributes)
        if tag == "header" and not self.inside["content"]:
            told.boilerplate = True
        if told.content:
            told.silenced = self.inside["hint"]
        self.stack.append(told)
        self.of_tag.setdefault(tag, []).append(told)
        self._count(told, 1)

    def close(self, tag: str) -> None:
        opened = self.of_tag.get(tag)
        if not opened:
            return
        if tag in INLINE:
            # Blocks that were opened inside stay open.
            element = opened.pop()
            element.closed = True
            self._count(element, -1)
            while self.stack and self.stack[-1].closed:
                self.stack.pop()
            return
        element = opened[-1]
        while not element.closed and self.stack:
            last = self.stack[-1]
            self._leave()
            if last is element:
                return


def blocks(page: str) -> list[Block]:
    """The page's blocks of text, in order."""
    state, at = _Page(), 0
    while found := _TAG.search(page, at):
        if found.start() > at:
            state.add(page[at : found.start()])
        at = found.end()
        tag = (found[2] or found[5] or "").lower()
        if not tag:
            continue
        if tag not in INLINE:
            state.flush()
        if found[1] or found[4]:
            state.close(tag)
            continue
        attributes = found[3] or found[6] or ""
        if attributes.endswith("/") and tag not in INLINE or tag in VOID:
            continue
        if tag in RAW:
            end = re.compile(rf"</{tag}\s*>", re.I).search(page, at)
            at = len(page) if end is None else end.end()
            continue
        state.open(tag, attributes)
    state.add(page[at:])
    state.flush()
    return state.blocks


#: What elements say, which many pages leave out.
NAMED = ("named", "heading")
#: What a block is told by.
FEATURES = ("words", "density", "words_before", "density_before", "words_after", "density_after", *NAMED)


def features(found: list[Block]) -> list[list[float]]:
    """One row for each block, with its neighbours; past either end stands an empty block."""
    none = Block("", 0, 0, *[False] * 6)
    rows = []
    for before, block, after in zip([none, *found], found, [*found[1:], none], strict=False):
        rows.append(
            [
                block.words, block.density, before.words, before.density, after.words, after.density,
                *(float(getattr(block, name)) for name in NAMED),
            ]
        )
    return rows


@dataclass(frozen=True)
class Leaf:
    main: bool


@dataclass(frozen=True)
class Split:
    feature: int
    most: float
    below: Split | Leaf
    above: Split | Leaf


def _tree(lines: list[str]) -> Split | Leaf:
    """The tree of a model's ``toDebugString``."""
    line = lines.pop(0).strip()
    if found := re.fullmatch(r"Predict: ([\d.]+)", line):
        return Leaf(float(found[1]) > 0.5)
    found = re.fullmatch(r"If \(feature (\d+) <= (\S+)\)", line)
    below = _tree(lines)
    lines.pop(0)
    return Split(int(found[1]), float(found[2]), below, _tree(lines))


def labelled(pages: Iterable[str], without: Iterable[str] = ()) -> list[tuple[list[float], bool]]:
    """Blocks of pages in which ``data-main`` marks the elements that are main text; features ``without`` are 0."""
    gone = [FEATURES.index(name) for name in without]
    rows = []
    for page in pages:
        found = blocks(page)
        for row, block in zip(features(found), found, strict=True):
            rows.append(([0.0 if i in gone else x for i, x in enumerate(row)], block.main))
    return rows


def train(spark: SparkSession, pages: Iterable[str] | None = None, depth: int = 10, without: Iterable[str] = ()) -> Split | Leaf:
    """A decision tree from labelled pages, own ones if none are given."""
    from cardvigil.llm.labelled_pages import PAGES

    rows = [(Vectors.dense(x), float(main)) for x, main in labelled(pages or PAGES, without)]
    table = spark.createDataFrame(rows, ["features", "label"]).coalesce(1)
    model = DecisionTreeClassifier(maxDepth=depth, maxBins=64, minInstancesPerNode=4, seed=1).fit(table)
    return _tree(model.toDebugString.splitlines()[1:])


def is_main(tree: Split | Leaf, row: list[float]) -> bool:
    while isinstance(tree, Split):
        tree = tree.below if row[tree.feature] <= tree.most else tree.above
    return tree.main


def main_text(page: str, tree: Split | Leaf) -> str:
    found = blocks(page)
    return " ".join(b.text for b, row in zip(found, features(found), strict=True) if is_main(tree, row))


def extract(pages: DataFrame, tree: Split | Leaf | None = None) -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""
    tree = tree or train(pages.sparkSession)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "html"):
            found = [main_text(page or "", tree) for page in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(found, pa.string()), pa.array(map(len, found), pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    kind = pages.schema["page_id"].dataType.simpleString()
    return pages.select("page_id", "url", "html").mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long")

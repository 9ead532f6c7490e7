import time
from html.parser import HTMLParser

import pytest

from cardvigil.llm import pages as P
from cardvigil.llm import queries
from cardvigil.llm.labelled_pages import COUNT, PAGES, page

LONG = "Here stands a paragraph that is long enough to look like the text of an article, with commas and all."


@pytest.fixture(scope="module")
def tree(spark):
    return P.train(spark)


HELD_OUT = [page(seed) for seed in range(COUNT, COUNT + 200)]


def accuracy(tree, rows):
    return sum(P.is_main(tree, x) == main for x, main in rows) / len(rows)


def used(tree):
    """The features that the tree's splits look at, how often."""
    if isinstance(tree, P.Leaf):
        return []
    return [P.FEATURES[tree.feature], *used(tree.below), *used(tree.above)]


def test_held_out_pages(tree):
    """Other pages of the same rules: those that name their parts, name nothing, or name them wrongly."""
    assert accuracy(tree, P.labelled(HELD_OUT)) >= 0.97
    for naming in range(4):
        assert accuracy(tree, P.labelled(HELD_OUT[naming::4])) >= 0.95


def test_words_and_links_do_without_names(spark):
    """With all names taken away, from the table and from the pages asked."""
    bare = P.train(spark, without=P.NAMED)
    assert accuracy(bare, P.labelled(HELD_OUT, P.NAMED)) >= 0.9


def test_the_tree_looks_at_words_and_links_of_all_three_blocks(tree):
    assert {"words", "density", "words_before", "density_before", "words_after", "density_after"} <= set(used(tree))
    by_names = sum(name in P.NAMED for name in used(tree))
    assert by_names < len(used(tree)) / 2


class Article(HTMLParser):
    """The text inside the article element by the standard library's reader, blocks apart."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.inside, self.found = 0, []

    def handle_starttag(self, tag, attrs):
        self.inside += tag == "article"
        if tag not in P.INLINE:
            self.found.append(" ")

    def handle_endtag(self, tag):
        self.inside -= tag == "article"
        if tag not in P.INLINE:
            self.found.append(" ")

    def handle_data(self, data):
        if self.inside:
            self.found.append(data)


def test_registered_query_against_another_reader(spark, sf_dir):
    given = {r.page_id: r for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    got = queries.op7_html_extraction(spark, sf_dir).collect()
    assert len(got) == len(given)
    for row in got:
        reader = Article()
        reader.feed(given[row.page_id].html or "")
        want = " ".join("".join(reader.found).split())
        assert (row.url, row.text, row.n_chars) == (given[row.page_id].url, want, len(want))


LONGER = "Two paragraphs of twenty words each stand here in an element that has no name at all, one after the other."


@pytest.mark.parametrize(
    "page,text",
    [
        (f"<article class='post share-enabled'><p>{LONG}</p><p>Short one.</p></article>", f"{LONG} Short one."),
        (f"<div><p>{LONG}</p><p>{LONGER}</p></div>", f"{LONG} {LONGER}"),
        (f"<article><p>{LONG}</p><button>Buy <p>{LONGER}</p></article>", f"{LONG} {LONGER}"),
        (f"<article><p>{LONG}</p><video src=x>No video <p>{LONGER}</p></article>", f"{LONG} {LONGER}"),
        (f"<div class='left-sidebar'><p>{LONGER}</p></div><article><p>{LONG}</p></article>", LONG),
        (f"<div class='page with-sidebar'><article><p>{LONG}</p><p>Yes.</p></article></div>", f"{LONG} Yes."),
        (f"<article><p>{LONG}</p><section class='article-comments'><p>{LONGER}</p></section></article>", LONG),
        (f"<main><p><b>{LONG}<p>{LONGER}</b></main>", f"{LONG} {LONGER}"),
        (f"<head><title>No</title><meta x><p>{LONG}</p><p>{LONGER}</p>", f"{LONG} {LONGER}"),
    ],
)
def test_articles_are_not_lost(tree, page, text):
    assert P.main_text(page, tree) == text


@pytest.mark.parametrize("unit", ["<b>", "</i>", "<b></i>", "<div>w", "<a href=x>w ", "<button>w", "<li><a>w</div>", "<p class='ad'>w ", "<svg><p>", "<a 'x", "<"])
def test_long_broken_pages_are_read_in_linear_time(unit):
    """A page of 1 MB; searching all open elements for each end tag would take minutes."""
    begun = time.perf_counter()
    P.blocks(unit * ((1 << 20) // len(unit)))
    assert time.perf_counter() - begun < 8


@pytest.mark.parametrize(
    "page,text",
    [
        (f"<article><p>{LONG}</p><p>Short.</p></article>", f"{LONG} Short."),
        (f"<nav><a href=/>Home</a></nav><main><h1>A &amp; B</h1><p>{LONG}<br>x &lt;p&gt; y</main><footer>{LONG}</footer>", f"A & B {LONG} x <p> y"),
        (f"<article><p>a<b>b</b>\n\t c&nbsp;d</p><script>if (1 < 2) '</p>'</script><style>p{{}}</style><!-- {LONG} --><p>{LONG}</article>", f"ab c d {LONG}"),
        (f"<article><p>{LONG}</p><form><input><label>Your mail</label></form><div class='comments'><p>{LONG}</p></div></article>", LONG),
        (f"<title>No</title><body><div class='ad'>{LONG}</div><article><p>{LONG}<p>unclosed <b>bold</article><aside>{LONG}</aside>", f"{LONG} unclosed bold"),
        (f"<article><P CLASS=x>{LONG}</P><script>var t = '", LONG),
    ],
)
def test_main_text(tree, page, text):
    assert P.main_text(page, tree) == text


def test_odd_markup_does_not_crash(tree):
    for page in ("", "<", "<<<>>>", "</p></div>", "<p", "a < b > c", "<a title='x>y", "<!--", "<article>" * 3000, "&#0; &#xD800; &nosuch; &#99999999;", "\x00"):
        assert isinstance(P.main_text(page, tree), str)


def test_every_row_gives_a_row(spark, tree, rows):
    given = [(1, "u", None), (2, None, ""), (None, "v", f"<article><p>{LONG}</p></article>"), (1, "u", None), (3, "w", f"<main>{LONG * 3000}</main>")]
    frame = spark.createDataFrame([(*r, "x", 1) for r in given], "page_id long, url string, html string, text string, n_chars int")
    got = rows(P.extract(frame, tree), "page_id", "url", "text", "n_chars")
    texts = ["", "", LONG, "", LONG * 3000]
    assert got == sorted(((i, u, t, len(t)) for (i, u, _), t in zip(given, texts)), key=repr)
    assert P.extract(frame.limit(0), tree).count() == 0

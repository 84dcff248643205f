"""Pages on which the minimum cut decides against what tags and class names say."""

from tests.llm.test_llm_parts import PAGE
from turnloom.llm import html

LONG = "The harbour was built in the summer of that year, and it was the first of its kind on the coast, so that many of the ships came to it."


def test_cut_outvotes_a_class_name():
    page = f'<article><p>{LONG}</p><p class="{{}}">Here {LONG}</p><p>{LONG}</p></article><div class="social"><a href=/>Share</a></div>'
    kept = html.main_text(page.format("social"))
    assert kept.count("harbour") == 3 and "Share" not in kept
    # By its own costs the marked block is boilerplate: its neighbours decide.
    nodes, blocks = html.blocks_of(page.format("social"))
    assert blocks[1].state == -1 and html.label(nodes, blocks[1:2], html.DEFAULT) == [False]
    assert html.main_text(page.format('x" hidden="')).count("harbour") == 2


def test_text_outside_the_article_is_kept():
    page = f"<article><h1>Harbours</h1><p>{LONG}</p></article><div><p>{LONG}</p><p>{LONG}</p></div><div><a href=/>Home</a> <a href=/a>About</a></div>"
    kept = html.main_text(page)
    assert kept.count("harbour was") == 3 and "Home" not in kept



def test_hidden_text_stays_out():
    assert html.main_text(PAGE.replace('<div class="ad">', "<div hidden>")) == html.main_text(PAGE)


def test_sample_counts_a_repeated_page_once(spark):
    """However often a page is repeated and wherever its copies lie, the classifier is the same."""
    pages = [(i, PAGE.replace("harbour", "pier").replace("</article>", f"<p>{LONG} {'word ' * i}</p></article>")) for i in range(12)]
    frame = spark.createDataFrame(pages, "page_id long, html string")
    weights = html.fit(frame)
    copies = spark.createDataFrame(pages + pages[:1] * 300 + [(None, None)], "page_id long, html string").repartition(4)
    assert html.fit(copies) == weights != html.DEFAULT
    assert html.fit(frame, sample=3) == html.fit(copies, sample=3) != weights
    assert html.fit(frame.limit(0)) == html.DEFAULT

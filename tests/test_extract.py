from pyspark.sql import functions as F

from vigilframe.functions import html as H
from vigilframe.operators import extract as X


def pages(spark, *bodies):
    return spark.createDataFrame(list(enumerate(bodies)), "id int, body string")


def test_first_column(spark, rows):
    body = (
        "<!-- <table class='ecl-table'><tr><td>comment</td></tr></table> --><script>'<table class=\"ecl-table\">'</script>"
        "<TABLE id=a CLASS=\"wide ecl-table\"><tr><th>Head</th></tr><tr><td> C&ocirc;te <b>d&rsquo;Ivoire</b>&nbsp;</td><td>2</td>"
        "<tr><td>Fran&#231;a &#x2019;</td></table><table class='ecl-table'><tr><td>second</td></tr></table>"
    )
    out = X.first_column(pages(spark, body, "<table class='ecl-tables'><tr><td>x</td></tr></table>"), ["id"], table_class="ecl-table")
    assert rows(out) == [(0, 0, "Côte d’Ivoire"), (0, 1, "França ’")]


def test_first_column_after_header(spark, rows):
    body = (
        "<table><tbody><tr><td>no</td></tr></tbody></table><table><thead><tr><th><strong>La LISTE source</strong></th></tr>"
        "</thead><tbody><tr><td>Fidji</td><td>1</td></tr></tbody></table>"
    )
    assert rows(X.first_column(pages(spark, body, "<p>"), ["id"], after_header="Liste source")) == [(0, 0, "Fidji")]


def test_definitions(spark):
    body = "<dl><dt>Score</dt><dd> <b>43</b>/100 </dd><dt> Rank</dt><dd>9</dd></dl>"
    cut = "<dl><dt>Score</dt></dl>"
    out = X.definitions(pages(spark, body, cut), ["id"], {"s": "Score", "r": "Rank"}).orderBy("id").collect()
    assert tuple(out[0]["s"]) == (True, "43/100") and tuple(out[0]["r"]) == (False, None)
    assert tuple(out[1]["s"]) == (True, None)


def test_headings_and_paragraphs(spark, rows):
    body = (
        "<h3>a <b>Iran</b></h3><h3>no bold</h3><h6 class='cmp-title__text'>Countries</h6><p>x</p>"
        "<h6 class='cmp-title__text' id='c'>Country</h6><div><p>Laos, <i>Mali</i></p></div><p>y</p>"
    )
    assert rows(X.bold_headings(pages(spark, body), ["id"])) == [(0, 0, "Iran")]
    assert rows(X.paragraph_after(pages(spark, body, ""), ["id"], "h6", "Country", cls="cmp-title__text")) == [(0, "Laos, Mali")]


def test_bold_items_until(spark, rows):
    item = "<p class='oj-ti-grseq-1'><span class='oj-bold'>{}</span></p>"
    body = item.format("early") + "<p id='d1e39-2-1'>I</p>" + "<p class='oj-ti-grseq-1'>plain</p>"
    body += "".join(item.format(t) for t in ("A", "B, C", "2. State of play", "D"))
    out = X.bold_items(pages(spark, body), ["id"], "oj-ti-grseq-1", "oj-bold", anchor_id="d1e39-2-1", stop="State of play")
    assert rows(out) == [(0, 0, "A"), (0, 1, "B, C")]


def test_links_and_lists(spark, rows):
    body = (
        "<p><a href='no'>x</a></p><h2>1. Vous voulez</h2><p><a class=l href=\"/a?x=1&amp;y=2\">a</a> <a name=n>b</a> <a href='/c'>c</a></p>"
        "<section class='page-section'><h2>Autres</h2><ul><li>no</li></ul><header>Mesures restrictives</header>"
        "<h3>Les Mesures restrictives</h3><p>:</p><ul><li>gel<li>voyage</ul><ul><li>later</li></ul></section>"
        "<section class='other'><h3>Mesures restrictives</h3><ul><li>no</li></ul></section>"
    )
    out = X.links(pages(spark, body), ["id"], after=("h2", "Vous voulez"))
    assert rows(out) == [(0, 0, "/a?x=1&y=2"), (0, 1, "/c")]
    items = X.list_items_after(pages(spark, body), ["id"], "page-section", "Mesures restrictives")
    assert rows(items) == [(0, 0, 0, "gel"), (0, 0, 1, "voyage")]


def test_link_titles(spark, rows):
    block = "<div class='gem-c-document-list__item-title'><a href='x'>{}</a></div>"
    body = block.format("Financial sanctions, Iran") + block.format("Notice")
    out = X.link_titles(pages(spark, body), ["id"], "gem-c-document-list__item-title", "Financial sanctions")
    assert rows(out) == [(0, 0, "Financial sanctions, Iran")]


def test_entities(spark):
    df = spark.createDataFrame([("&amp;lt; &unknown; &#0; &#xD800; &apos; a&b & &eacute",)], "x string")
    assert df.select(H.decode_entities(F.col("x"))).first()[0] == "&lt; &unknown; &#0; &#xD800; ' a&b & &eacute"


def test_nested_tables(spark, rows):
    body = (
        "<table class=x><tr><td>no</td></tr></table><TABLE class='ecl-table'><tr><th>h</th></tr>"
        "<tr><td>Outer <table><tr><td>Inner</td><td>2</td></tr></table></td><td>3</td></tr>"
        "<tr><td>Last</td></tr></TABLE><table class='ecl-table'><tr><td>other</td></tr></table>"
    )
    out = X.first_column(pages(spark, body), ["id"], table_class="ecl-table")
    assert rows(out) == [(0, 0, "Outer Inner2"), (0, 1, "Inner"), (0, 2, "Last")]
    header = "<table><tr><th>Pays</th><th><b>Liste</b> source</th></tr><tbody><tr><td>A<table><tbody><tr><td>B</td></tr></tbody></table></td></tr><tr><td>C</td></tr></tbody></table>"
    assert rows(X.first_column(pages(spark, header), ["id"], after_header="liste source")) == [(0, 0, "AB"), (0, 1, "B"), (0, 2, "C")]


def test_nested_blocks_lists_and_sections(spark, rows):
    block = "<div class='t'><div class='icon'><div/>x</div><a href='#'>Financial sanctions, {}</a></div>"
    out = X.link_titles(pages(spark, "<div>" + block.format("Iran") + block.format("Mali") + "</div></div>"), ["id"], "t", "Financial")
    assert rows(out) == [(0, 0, "Financial sanctions, Iran"), (0, 1, "Financial sanctions, Mali")]
    section = "<section class='s'><section><h2>x</h2></section><h3>Mesures</h3><ul><li>a<ul><li>b</li></ul></li><li>c</li></ul></section>"
    out = X.list_items_after(pages(spark, section), ["id"], "s", "Mesures")
    assert rows(out) == [(0, 0, 0, "ab"), (0, 0, 1, "b"), (0, 0, 2, "c")]


def test_unclosed_and_stray_tags(spark):
    df = pages(spark, "</div><div class='a'>1<div class='b'>2</div>3", "<div class='a'>x<div class='a'>y</div>z</div>w", None, "")
    found = df.select("id", H.elements(F.col("body"), "div", cls="a").alias("x")).orderBy("id").collect()
    assert [r.x for r in found] == [["1<div class='b'>2</div>3"], ["x<div class='a'>y</div>z", "y"], None, []]


def test_anchors_are_compared_as_read(spark, rows):
    bodies = [f"<h2>Autres</h2><p><a href='/no'>x</a></p><h2 class=t>1. Les {x} en vigueur</h2><p><a href='/a'>x</a></p>" for x in ("r&eacute;gimes", "r<b>é</b>gimes", "R&#201;GIMES", "regimes")]
    out = X.links(pages(spark, *bodies), ["id"], after=("h2", "les régimes"))
    assert rows(out) == [(0, 0, "/a"), (1, 0, "/a"), (2, 0, "/a")]
    text = pages(spark, "<h6 class='c'>Pays&nbsp;</h6><p>no</p><h6 class='c d'>Pa<i>ys</i></h6 ><p>Laos</p>")
    assert rows(X.paragraph_after(text, ["id"], "h6", "Pays", cls="c")) == [(0, "Laos")]

from __future__ import annotations

import html
import re

import pyarrow.parquet as pq
import pytest

from stoptide.llm import extract

PAGES = "/root/testdata/sf0.01/pages.parquet"
PARAGRAPH = ("This is the first paragraph of the article and it has more than enough of the "
             "small words that make it a text for readers.")


def test_articles_of_the_pages(spark):
    df = spark.read.parquet(PAGES)
    found = {r["page_id"]: r["main_text"] for r in extract.extract(df).collect()}
    for page, text in zip(*pq.read_table(PAGES, columns=["page_id", "html"]).to_pydict().values(),
                          strict=True):
        article = re.search(r"<article>(.*?)</article>", text, re.S)[1]
        parts = [" ".join(html.unescape(re.sub("<[^>]+>", "", re.sub("<br>", " ", p))).split())
                 for p in re.split(r"</?(?:p|h1)>", article)]
        assert found[page] == "\n".join(p for p in parts if p)


@pytest.mark.parametrize("around", [
    "<nav>{}</nav>", "<header>{}</header>", "<footer>{}</footer>", "<aside>{}</aside>",
    "<div class='sidebar left'>{}</div>", '<div id="cookie-notice">{}</div>',
    "<div role=banner>{}</div>", "<form>{}</form>", "<script>{}</script>", "<style>{}</style>",
    "<section class=comments><article>{}</article></section>", "<!-- {} -->",
    "<div style='display: none'>{}</div>", "<p hidden>{}</p>", "<noscript>{}</noscript>",
    "<ul class='menu'><li><a href=x>{}</a></ul>"])
def test_what_is_not_the_article(around):
    other = "You may read of the many other things that are on this site and in the news of today."
    page = f"<body>{around.format(other)}<article><p>{PARAGRAPH}</p></article>"
    assert extract.main_text(page) == PARAGRAPH
    page = f"<body><article><p>{PARAGRAPH}</p>{around.format(other)}</article></body>"
    if not around.startswith("<header"):
        assert extract.main_text(page) == PARAGRAPH


def test_without_article_element():
    linked = "".join(f"<li><a href=/{i}>topic number {i}</a></li>" for i in range(9))
    page = (f"<body><ul>{linked}</ul><h1>A heading</h1><p>{PARAGRAPH}</p><p>Short.</p>"
            f"<div>{PARAGRAPH}</div><ul>{linked}</ul></body>")
    assert extract.main_text(page) == f"A heading\n{PARAGRAPH}\nShort.\n{PARAGRAPH}"


def test_characters_and_broken_markup():
    page = ("<article><p>a &lt; b &amp; c&nbsp;&#233;\n\n  d<br>e <b>f</p>g < h"
            "<p title='x>y'>i<p>j</article")
    assert extract.main_text(page) == "a < b & c é d e f\ng < h\ni\nj"
    for page in ("", "<", "<p", "<!--", "<script>", "</p></div>", "<article>", "&amp", "<a<b<c"):
        extract.main_text(page)
    assert extract.main_text("<article><p>No.</p></article>") == "No."


LONG = "x > y; " * 10_000            # 70,000 characters


@pytest.mark.parametrize("quote", ["'", '"'])
def test_long_attribute_values(quote):
    value = f"{quote}data:{LONG}{quote}"
    for around in (f"<script src={value}>code()</script>", f"<div class=ad data-x={value}>ad</div>",
                   f"<img src={value}>", f"<span hidden title = {value}>gone</span>"):
        page = f"<article><div>{around}<p>{PARAGRAPH}</p></div><p>{PARAGRAPH}</p></article>"
        assert extract.main_text(page) == f"{PARAGRAPH}\n{PARAGRAPH}"


def test_quotes_that_open_no_value_or_never_close():
    page = f"<article><p don't>{PARAGRAPH}</p><p class=a'b>It's {PARAGRAPH}</p></article>"
    assert extract.main_text(page) == f"{PARAGRAPH}\nIt's {PARAGRAPH}"
    page = f"<article><p>{PARAGRAPH}</p><div title='x' class=\"ad>advert</div><p>{PARAGRAPH}</p>"
    assert extract.main_text(page) == f"{PARAGRAPH}\n{PARAGRAPH}"
    extract.main_text("<a b=\">=\" " * 200_000 + "c='>")      # linear, else this takes hours


def test_ambiguous_blocks_take_the_nearest_label():
    def block(text, good=None, area=0):
        return extract.Block(text, 0, area, good)

    long_good = PARAGRAPH
    long_bad = "xqz vbn " * 20
    found = [block(long_bad), block("near bad"), block("tie"), block("near good"),
             block(long_good)]
    extract.label(found)
    assert [b.good for b in found] == [False, False, False, True, True]


def test_rows(spark):
    df = spark.createDataFrame([(1, None, "c"), (2, "", "c"), (3, f"<article>{PARAGRAPH}", "c"),
                                (3, f"<article>{PARAGRAPH}", "c"),
                                (None, "<article>" + "<p>no end " * 20000, "c")],
                               "page_id LONG, html STRING, main_text STRING")
    found = extract.extract(df).collect()
    assert [r["main_text"] for r in found[:4]] == ["", "", PARAGRAPH, PARAGRAPH]
    assert found[4]["main_text"].count("\n") == 19999
    assert extract.extract(df.limit(0)).count() == 0


WRAPPERS = ['<div class="page with-sidebar">{}</div>', '<div class="layout no-sidebar">{}</div>',
            '<div class="post has-comments">{}</div>', '<div class="content widget-area">{}</div>',
            '<div class="hentry share-enabled">{}</div>']
COMMENT = "<div class=comments><p>I have read all of this, and it is what they say in the news.</p></div>"


@pytest.mark.parametrize("wrapper", WRAPPERS)
@pytest.mark.parametrize("article", ["<article>{}</article>", "<main>{}</main>", "{}"])
def test_names_of_wrappers_do_not_empty_a_page(wrapper, article):
    for text in (PARAGRAPH, f"{PARAGRAPH}</p><p>{PARAGRAPH}"):
        inner = article.format(f"<p>{text}</p>")
        want = text.replace("</p><p>", "\n")
        for page in (wrapper.format(inner), wrapper.format(inner) + COMMENT,
                     wrapper.format(inner + COMMENT), f"<div class=ad>Buy it.</div>"
                     + wrapper.format(wrapper.format(inner))):
            assert extract.main_text(f"<body><nav>menu</nav>{page}</body>") == want


@pytest.mark.parametrize("wrapper", WRAPPERS)
def test_names_on_the_article_itself(wrapper):
    page = wrapper.replace("div", "article").format(f"<p>{PARAGRAPH}</p>{COMMENT}")
    assert extract.main_text(f"<body>{page}</body>") == PARAGRAPH


FOREIGN = [
    "Сегодня мы расскажем о том, как в этом году изменилась погода на юге страны и что об этом "
    "думают люди, которые там живут.",
    "Hoje vamos falar do que mudou no tempo este ano no sul do país e do que as pessoas que lá "
    "vivem pensam de tudo isso, e não só.",
    "今天我们来谈谈今年南方的天气变化，以及生活在那里的人们的看法。他们说，雨水比往年多了很多，而且冬天也更加寒冷，"
    "大家都很担心今年的收成会不会受到影响，同时也希望来年能够好起来。"]


@pytest.mark.parametrize("text", FOREIGN)
def test_other_languages(text):
    linked = "".join(f"<li><a href=/{i}>{text[i:i + 9]}</a></li>" for i in range(9))
    page = f"<body><ul>{linked}</ul><h1>T</h1><p>{text}</p><p>{text}</p><footer>{text}</footer>"
    assert extract.main_text(page) == f"T\n{text}\n{text}"


def test_labels_decide_without_an_article(monkeypatch):
    menu = "Home Products Services Company Contact Imprint Careers Partners Downloads Support"
    page = f"<body><div>{menu}</div><div><p>{PARAGRAPH}</p></div><div>{menu}</div></body>"
    assert extract.main_text(page) == PARAGRAPH
    monkeypatch.setattr(extract, "label", lambda found: [setattr(b, "good", True) for b in found])
    assert extract.main_text(page) == f"{menu}\n{PARAGRAPH}\n{menu}"


def test_lists_between_paragraphs_and_pages_without_sentences():
    names = "Alpha | Bravo | Charlie | Delta | Echo | Foxtrot | Golf | Hotel | India | Juliett"
    page = f"<body><div><h1>Names</h1><p>{PARAGRAPH}</p><p>{names}</p></div><div>{names}</div>"
    assert extract.main_text(page) == f"Names\n{PARAGRAPH}\n{names}"
    page = f"<body><ul><li><a href=x>menu</a></ul><div><h1>Names</h1><p>{names}</p></div>"
    assert extract.main_text(page) == f"Names\n{names}"


def test_pages_without_their_article_element():
    pages = pq.read_table(PAGES, columns=["html"]).to_pydict()["html"]
    renamed = [re.sub(r"<(/?)article", r"<\1div", p) for p in pages]
    alike = [extract.main_text(a) == extract.main_text(b) for a, b in zip(pages, renamed,
                                                                          strict=True)]
    assert sum(alike) >= 0.95 * len(alike)


def test_deep_pages_take_linear_time():
    for given in ("", " class=ad"):
        extract.main_text(f"<div{given}>" * 60_000 + "<i>x</i>" * 60_000)   # else minutes

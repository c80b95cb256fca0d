"""Byte-level BPE against the public library, and HTML extraction on made-up sites."""

import random
import tracemalloc
from array import array

import public_tokenizers
import pytest
import regex
import tiktoken
from llm_data import docs, empty

from keyloop.llm.byte_bpe import Vocabulary, _Ids, _split, decode, encode, load_ranks, merge, stitch
from keyloop.llm.html_extract import extract, extract_pages, main_slot

RANKS = load_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
VOCABULARY = Vocabulary(RANKS)
LIBRARY = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})


@pytest.mark.parametrize("chunk, overlap", [(1 << 15, 512), (50, 12)])
def test_encode_is_the_librarys_and_decode_gives_the_bytes_back(spark, chunk, overlap):
    df = docs(spark)
    got = decode(encode(df, RANKS, public_tokenizers.PATTERN, chunk=chunk, overlap=overlap), RANKS)
    rows = got.collect()
    assert len(rows) == df.count()
    for r in rows:
        assert r.ids == LIBRARY.encode_ordinary(r.text or "")
        assert bytes(r.decoded) == (r.text or "").encode()


def test_stitching_at_any_cut():
    rng, split, known = random.Random(3), regex.compile(public_tokenizers.PATTERN), _Ids(VOCABULARY)
    for _ in range(300):
        text = "".join(rng.choice("ab'rest vé漢1 \n\t .,!　") * rng.choice([1, 1, 5, 40])
                       for _ in range(rng.randint(0, 50)))
        size, more = rng.choice([1, 3, 7, 20]), rng.choice([5, 6, 12])
        n = max(1, -(-(len(text) - more) // size))
        parts = [_split(i * size, text[i * size:i * size + size + more], split, known) for i in range(n)]
        assert list(stitch(parts, split, known)) == LIBRARY.encode_ordinary(text)


def test_merges():
    rng = random.Random(4)
    pieces = [bytes(rng.choice(b"abcdthe\xc3\xa9 ") for _ in range(rng.choice([1, 2, 5, 9, 16, 40, 64, 65, 300])))
              for _ in range(400)]
    for piece, ids in zip(pieces, merge(pieces, VOCABULARY)):
        assert list(array("i", ids)) == LIBRARY._core_bpe.encode_single_piece(piece)


def test_many_pieces_side_by_side_stay_small():
    """The arrays of a merge are bounded by places, not by pieces."""
    rng = random.Random(5)
    pieces = [bytes(rng.choice(b"abcdthe ") for _ in range(60)) for _ in range(1 << 14)]
    tracemalloc.start()
    got = merge(pieces, VOCABULARY)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 40 << 20
    for piece, ids in list(zip(pieces, got))[::500]:
        assert list(array("i", ids)) == LIBRARY._core_bpe.encode_single_piece(piece)


def test_empty_and_bad_settings(spark):
    assert encode(empty(spark), RANKS, public_tokenizers.PATTERN).count() == 0
    with pytest.raises(ValueError):
        encode(docs(spark), RANKS, public_tokenizers.PATTERN, overlap=2)


def _page(title, paragraphs, n):
    body = "".join(f"<p>{p}" for p in paragraphs)
    return (f"<!DOCTYPE html><html><head><title>{title}</title><script>var x='<p>no</p>';</script></head>"
            f"<body><div id=top class='site-header'><a href=/>Home</a></div><nav><ul><li>Menu {n}</ul></nav>"
            f"<div class='cookie-notice'>We use cookies</div><article><h1>{title}</h1>{body}"
            f"<div class=comments><p>first!</p></div></article><aside>Side</aside>"
            f"<form><p>Mail</p></form><footer>&copy; site</footer></body></html>")


def test_article(spark):
    assert extract(_page("A &amp; B", ["x  &lt;y&gt;\n z", "<b>bold</b> é&nbsp;!", ""], 1)) == (
        "A & B\n\nx <y> z\n\nbold é !")
    assert extract("") == "" and extract("plain  text") == "plain text"
    assert extract("<p>a<br>b<li>c") == "a b\n\nc"


def test_cut_and_broken_markup():
    assert extract("<article><p>one<p>two</article><p>out") == "one\n\ntwo"
    assert extract("<article><p class=\"x>y\">one</p><!-- cut") == "one"
    assert extract("<article>text <b cla") == "text"
    assert extract("<article>a < b</article>") == "a < b"
    assert extract("<nav>menu<nav>more</nav></nav><article>body</article>") == "body"


def test_template_of_unmarked_pages(spark):
    """Without any telling tag or class the slot that holds the text is found by the template."""
    def page(i):
        return (f"<html><body><div><span>Site name</span></div><div><p>Story {i} tells much about {i * 7}</p>"
                f"<p>and goes on for a while, {i}</p></div><div><p>All rights reserved</p></div></body></html>")

    rows = [(i, f"http://host.example/{i}", page(i)) for i in range(12)]
    rows += [(100, None, None), (101, "http://host.example/1", ""), (102, "nonsense", "<p>x</p>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in extract_pages(df).collect()}
    for i in range(12):
        assert got[i] == f"Story {i} tells much about {i * 7}\n\nand goes on for a while, {i}"
    assert got[100] == got[101] == "" and got[102] == "x"


def test_repeated_paragraphs_of_articles_stay(spark):
    rows = [(i, "https://h.example/a", _page("Same", ["equal text", "more"], i)) for i in range(8)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {r.text for r in extract_pages(df).collect()} == {"Same\n\nequal text\n\nmore"}
    assert extract_pages(df.limit(0)).count() == 0


def test_main_slot():
    element = lambda path, chars, article=False: {"path": path, "chars": chars, "article": article}
    assert main_slot([]) is None
    assert main_slot([element("/html", 100), element("/html/body/div", 90), element("/html/body/p", 10)]) == "/html/body/div"
    assert main_slot([element("/html", 100), element("/html/article", 20, True)]) == "/html/article"


def test_marks_on_wrappers_keep_the_article():
    """A class name about the layout, or a form around the page, does not take the text out."""
    body = "<p>The story of the day is long enough to hold most of the text.</p>"
    side = "<div class='sidebar'>Side</div><div class='site-footer'>Foot</div>"
    for page in (f"<body class='single no-sidebar'>{body}{side}</body>",
                 f"<body><div id='content' class='with-sidebar'>{body}</div>{side}</body>",
                 f"<body><article class='post comments-open'>{body}</article>{side}</body>",
                 f"<body class='sidebar'><form action='/'>{body}{side}</form></body>",
                 f"<body><div class='widget'>{body}</div>{side}</body>"):
        assert extract(page) == "The story of the day is long enough to hold most of the text."


def test_template_decides_without_and_against_marks(spark):
    """The slot follows from the classes: a unique element that a page alone has, and words for an article
    around a menu, do not move it."""
    def page(i):
        teaser = "<section class='post'><p>teaser</p></section>" * (i % 3)
        return (f"<html><body><div class='content'><b>Sections of the site</b></div><div id='t'>"
                f"<p>Story {i} tells of {i * 7}</p><p>and of much more, {i}</p></div>{teaser}</body></html>")

    rows = [(i, f"http://host.example/{i}", page(i)) for i in range(12)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in extract_pages(df).collect()}
    assert got == {i: f"Story {i} tells of {i * 7}\n\nand of much more, {i}" for i in range(12)}


def test_each_layout_has_its_template(spark):
    """Three page types at a third each: menus and footers of every one go."""
    def page(i):
        kind = i % 3
        tag, inner = (("table", "td"), ("dl", "dd"), ("ul", "li"))[kind]
        return (f"<html><body><p>Menu of kind {kind}</p><{tag}><{inner}>Story {i} tells much about {i * 7} and a lot "
                f"of other things</{inner}></{tag}><p>Footer of kind {kind}</p></body></html>")

    rows = [(i, f"http://host.example/{i}", page(i)) for i in range(12)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in extract_pages(df).collect()}
    assert got == {i: f"Story {i} tells much about {i * 7} and a lot of other things" for i in range(12)}


def test_layouts_that_differ_by_texts_only(spark):
    def page(i):
        kind = "abc"[i % 3]
        return (f"<html><body><p>Menu {kind}</p><p>Story {i} tells much about {i * 7} and a lot of other things</p>"
                f"<p>Footer {kind}</p></body></html>")

    rows = [(i, f"http://host.example/{i}", page(i)) for i in range(12)]
    rows += [(100 + i, f"http://host.example/copy{i}", "<html><body><p>One text<p>copied whole</body></html>") for i in range(4)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in extract_pages(df).collect()}
    assert all(got[i] == f"Story {i} tells much about {i * 7} and a lot of other things" for i in range(12))
    assert all(got[100 + i] == "One text\n\ncopied whole" for i in range(4))


def _story(i, n):
    return " ".join(f"word{i}x{j}" for j in range(n))


@pytest.mark.parametrize("page, want", [
    # heading and quotation beside a long paragraph
    (lambda i: (f"<div id=wrap><h1>Title {i}</h1><p>{_story(i, 14)}</p><blockquote>{_story(-i - 1, 5)}</blockquote></div>"),
     lambda i: f"Title {i}\n\n{_story(i, 14)}\n\n{_story(-i - 1, 5)}"),
    # two parts of one post
    (lambda i: (f"<div class=post><h1>Title {i}</h1><div class=body>{_story(i, 14)}</div>"
                f"<div class=part>{_story(-i - 1, 6)}</div></div>"),
     lambda i: f"Title {i}\n\n{_story(i, 14)}\n\n{_story(-i - 1, 6)}"),
    # paragraphs that three stories share
    (lambda i: (f"<div class=post><p>{_story(i, 14)}</p><p>{_story(i + 50, 9)}</p>"
                + ("<p>A shared passage</p><p>and its second half</p>" if i < 3 else "") + "</div>"),
     lambda i: f"{_story(i, 14)}\n\n{_story(i + 50, 9)}" + (
         "\n\nA shared passage\n\nand its second half" if i < 3 else "")),
    # no element around the article at all
    (lambda i: f"<h1>Title {i}</h1><p>{_story(i, 14)}</p><pre>{_story(-i - 1, 5)}</pre>",
     lambda i: f"Title {i}\n\n{_story(i, 14)}\n\n{_story(-i - 1, 5)}"),
    # a notice of some pages, with its own element, within the slot goes
    (lambda i: (f"<div id=wrap><p>{_story(i, 14)}</p>" + ("<section><b>Read our letter</b></section>" if i % 2 else "")
                + f"<p>{_story(i + 50, 9)}</p></div>"),
     lambda i: f"{_story(i, 14)}\n\n{_story(i + 50, 9)}"),
])
def test_the_article_is_whole(spark, page, want):
    """Menu and footer of the host go, every block of the article stays."""
    rows = [(i, f"http://host.example/{i}", f"<html><body><div id=top>Home and news</div>{page(i)}"
             "<div id=end>All rights reserved</div></body></html>") for i in range(12)]
    got = {r.page_id: r.text for r in extract_pages(
        spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {i: want(i) for i in range(12)}


def test_the_slot_stays_within_an_article_and_ignores_links(spark):
    rows = [(i, f"http://host.example/{i}", f"<html><body><div id=w><div class=content><p>{_story(i, 20)}</p></div>"
             f"<div id=x>Other {i}</div></div></body></html>") for i in range(6)]
    rows += [(10 + i, f"http://other.example/{i}", f"<html><body><div id=w><div id=c><p>{_story(i, 20)}</p><p>x{i}</p></div>"
              f"<div id=x><a href=/>Next {i}</a></div></div></body></html>") for i in range(6)]
    got = {r.page_id: r.text for r in extract_pages(
        spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {i: _story(i, 20) for i in range(6)} | {10 + i: f"{_story(i, 20)}\n\nx{i}" for i in range(6)}

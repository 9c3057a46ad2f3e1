"""Main text of pages: inline boilerplate, comments, languages without a stop-word list, many open blocks."""

import time

import pytest

from pktsieve.llm.html_text import classify, extract, main_text

LONG_PL = "Wczoraj rano mieszkańcy miasteczka zobaczyli nad rzeką ogromne stado żurawi, które odpoczywało przed dalszą podróżą na południe. " * 2
LONG_ZH = "昨天早上，镇上的居民在河边看到了一大群鹤，它们正在休息，准备继续向南飞行。许多人带着孩子来到岸边，安静地观看这些美丽的鸟儿。"


@pytest.mark.parametrize("page, want", [
    ('<p>A <span class="ad">x</span> rest of the sentence.</p>', "A rest of the sentence."),
    ('<h2><span aria-hidden="true">#</span>Title</h2>', "Title"),
    ("<p>a <button>Copy</button> rest</p>", "a rest"),
    ('<p>a <span class="ad">x<div>y</div>z</span> rest</p>', "a\n\nrest"),
    ('<p>a <b><i><u><s><em><small><sub><sup><span class="ad">x</b></i></u></s></em></small></sub></sup></span> rest</p>', "a rest"),
    ('<article><p>Body.</p><article class="comment"><p>I disagree.</p></article><p>End.</p></article>', "Body.\n\nEnd."),
    ('<article class="post has-comments"><p>Body.</p></article>', "Body."),
    ('<article><p>Body.</p></article><section id="responses"><article class="comment-item"><p>First!</p></article></section>', "Body."),
    ('<article><p>Body.</p><div class="discussion"><p>First!</p></div></article>', "Body."),
])
def test_inline_boilerplate_and_comments(page, want):
    assert main_text(page) == want


@pytest.mark.parametrize("text", [LONG_PL.strip(), LONG_ZH])
def test_unmarked_pages_of_other_languages(text):
    page = f'<div class="menu"><a href="/">x</a></div><div><p>{text}</p><p>{text}</p></div><ul><li><a href="/a">{text[:30]}</a></li></ul><div class="footer">{text}</div>'
    assert main_text(page) == f"{text}\n\n{text}"


def test_short_paragraph_with_a_link_stays_on_unmarked_pages():
    body = "The committee said that the work on the bridge will be done before the end of the year, as it was planned with the city."
    page = f'<p>{body}</p><p>See <a href="/x">the plan</a> for the details of it.</p><p>{body}</p>'
    assert main_text(page) == f"{body}\n\nSee the plan for the details of it.\n\n{body}"


def slow_labels(blocks):
    """The second pass by looking at every decided block."""
    first = []
    for i in range(len(blocks)):
        alone = classify([blocks[i]])
        first.append(None if len(blocks[i][0]) < 80 and blocks[i][1] <= 0.33 and not blocks[i][2] else alone[0])
    out = []
    for i, x in enumerate(first):
        if x is None:
            near = sorted((abs(d - i), not y) for d, y in enumerate(first) if y is not None)
            x = not near[0][1] if near else True
        out.append(x)
    return out


def test_second_pass_equals_looking_at_every_block():
    import random

    rnd = random.Random(3)
    stop = "the work on the bridge will be done before the end of the year as it was planned with the city and all " * 2
    for _ in range(200):
        kinds = [("short", 0.0, False, False), (stop, 0.0, False, False), (stop, 0.9, False, False)]
        blocks = [rnd.choice(kinds) for _ in range(rnd.randint(1, 25))]
        if any(b[0] == stop and b[1] == 0 for b in blocks):
            assert classify(blocks) == slow_labels(blocks)


def test_time_grows_with_the_blocks():
    page = "".join(f"<p>short {i}</p><p><a href='/'>a link that is here {i}</a></p>" for i in range(20_000))
    begin = time.perf_counter()
    main_text(page)
    assert time.perf_counter() - begin < 8


def test_clashing_columns_are_replaced(spark):
    pages = spark.createDataFrame([(1, "<p>x</p>", "old", "y"), (2, None, None, None)], "page_id int, html string, text string, n_chars string")
    rows = {r["page_id"]: (r["text"], r["n_chars"]) for r in extract(pages).collect()}
    assert rows == {1: ("x", 1), 2: ("", 0)}

import pytest

from viewloom.llm.html import extract, main_text, regions

SHELL = (
    '<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var t="</p><article>no</article>";</script></head><body><header>Site name</header>'
    '<nav><ul><li><a href="/a">Home</a></li></ul></nav><div class="ad">Buy now and save a lot of money on everything you never needed at all.</div>{}'
    '<aside><p>Side story with quite some words in it</p></aside><form><label>Mail</label><input name="m"></form><footer>&copy; 2020</footer></body></html>'
)
LONG = "A paragraph of the text that says something, and goes on long enough to be told from a menu by its length alone."


@pytest.mark.parametrize(
    "html, text",
    [
        (None, ""),
        ("", ""),
        ("<p></p><nav>menu</nav>", ""),
        (SHELL.format("<article><h1>Title &amp; more</h1><p>One\n  two&nbsp;three</p><p>Short.</p></article>"), "Title & more\nOne two three\nShort."),
        (SHELL.format(f"<div id=content><h2>Heading</h2><p>{LONG}</p><p>Tail.</p></div>"), f"Heading\n{LONG}\nTail."),
        (SHELL.format(f"<main><p>{LONG}<div class='advert'>x</div><p>After the advert</p></main><section id='comments'><p>{LONG}</p></section>"), f"{LONG}\nAfter the advert"),
        (SHELL.format(f"<article><p>{LONG}</p></article><article class='comment'><p>I disagree</p></article>"), LONG),
        (SHELL.format(f'<div class="has-sidebar"><p>{LONG}</p></div><div class="cookie-notice"><p>{LONG}</p></div>'), LONG),
        (SHELL.format(f"<article><p>{LONG}<br>second <b>line</b><!-- <p>hidden</p> --></article>"), f"{LONG}\nsecond line"),
        (f"<article><p>1 < 2 and 3 > 2 {LONG}", f"1 < 2 and 3 > 2 {LONG}"),
        (f'<article><p title="a > b">{LONG}<p>cut &lt;b', f"{LONG}\ncut <b"),
        (f"<article><p>{LONG}</p><script>never closed {LONG}", LONG),
        (f"<article><p>{LONG}</p><!-- never closed {LONG}", LONG),
        (f'<article><p>{LONG}</p><a href="x', LONG),
        ("<p>only short", "only short"),
        (f"<ul>{'<li><a href=x>a long link text in a list of links</a></li>' * 9}</ul><p>{LONG}</p>", LONG),
    ],
)
def test_main_text(html, text):
    assert main_text(html) == text


@pytest.mark.parametrize(
    "html, text",
    [
        (SHELL.format(f"<main></main><article></article><div><p>{LONG}</p></div>"), LONG),
        (SHELL.format(f"<article><p>Teaser</p></article><div><p>{LONG}</p><p>{LONG}</p></div>"), f"{LONG}\n{LONG}"),
        (SHELL.format(f"<div><p>{LONG}</p></div><ul>{'<li><a href=x>a long link text in a list of links</a></li>' * 9}</ul>"), LONG),
        (SHELL.format(f"<main><h1>Few</h1><p>words</p></main><nav>m</nav><div><p>{LONG}</p><p>{LONG}</p></div><main><p>{LONG}</p></main>"), f"{LONG}\n{LONG}\n{LONG}"),
    ],
)
def test_windows_decide_with_main_elements_too(html, text):
    assert main_text(html).removeprefix("Teaser\n") == text


@pytest.mark.parametrize("name", ["content-with-sidebar", "page-no-sidebar", "post comments-open", "long-form", "side-by-side", "search-result-article"])
def test_a_name_does_not_cost_the_article(name):
    text = "\n".join([LONG] * 6)
    body = "".join(f"<p>{LONG}</p>" for _ in range(6))
    assert main_text(SHELL.format(f'<div class="{name}"><article>{body}</article></div>')) == text
    assert main_text(SHELL.format(f'<article id="{name}">{body}</article>')) == text
    assert main_text(SHELL.format(f'<div class="{name}">{body}</div>')) == text
    assert main_text("".join(f'<div class="{name}"><p>{LONG}</p></div>' for _ in range(3))) == "\n".join([LONG] * 3)
    assert main_text(SHELL.format(f'<article>{body}</article><div class="comments">{body}{body}</div>')) == text


WORDS = " ".join(f"word{i}" for i in range(40))
LINKS = "<ul><li><a href=x>One</a></li><li><a href=x>Two</a></li><li><a href=x>Three</a></li></ul>"


@pytest.mark.parametrize(
    "body, text",
    [
        (f"<p>{WORDS}</p>{LINKS}<p>Short closing remark by the author.</p>", f"{WORDS}\nOne\nTwo\nThree\nShort closing remark by the author."),
        (f"<p>{WORDS}</p><p><a>one linked sentence</a></p>", f"{WORDS}\none linked sentence"),
        (f"<h1><a href=x>Title</a></h1><nav>menu</nav><p>By me</p><div class=share>Share</div><p>{WORDS}</p><div class=ad>Buy</div><p>End.</p>", f"Title\nBy me\n{WORDS}\nEnd."),
    ],
)
def test_an_article_loses_no_line(body, text):
    for page in (f"<article>{body}</article>", SHELL.format(f"<article>{body}</article>"), SHELL.format(f"<main><div>{body}</div></main>")):
        assert main_text(page) == text


def test_a_page_without_main_element_keeps_links_between_its_lines():
    page = SHELL.format(f"<div><p>{WORDS}</p><div><a href=x>see there</a></div><p>{WORDS}</p><p><a href=x>one linked sentence</a></p></div>")
    assert main_text(page) == f"{WORDS}\nsee there\n{WORDS}\none linked sentence"


def slow_regions(lengths):
    """Every window and every line looked at one by one."""
    n = len(lengths)
    total = lambda i: sum(lengths[i : i + 3])
    if not any(lengths):
        return []
    level = min(86, max(total(i) for i in range(n)) / 2)
    found, i = [], 0
    while i < n:
        if not total(i):
            i += 1
            continue
        j = i
        while j < n and total(j):
            j += 1
        if max(total(k) for k in range(i, j)) >= level:
            full = [k for k in range(i, j) if lengths[k]]
            found.append((full[0], full[-1] + 1))
        i = j
    return found


def test_regions_by_brute_force():
    import random

    import numpy as np

    rng = random.Random(9)
    for _ in range(500):
        lengths = [rng.choice([0, 0, 0, 1, 20, 90, 200]) for _ in range(rng.randint(1, 40))]
        assert regions(np.array(lengths)) == slow_regions(lengths)


@pytest.mark.parametrize("piece", ['<div class="ad">x', "</i>", "<p>x</i>", "<b>", "<a href='", '<a x="', "<", "<!--", "<script>", "<li class=menu><p>", "</p><article>", "<nav>"])
def test_malformed_pages_take_linear_time_and_memory(piece):
    import time
    import tracemalloc

    page = f"<article><p>{LONG}</p></article>" + piece * ((1 << 21) // len(piece))
    started = time.perf_counter()
    main_text(page)
    took = time.perf_counter() - started
    half = page[: len(page) // 2]
    started = time.perf_counter()
    main_text(half)
    assert took < 3 * (time.perf_counter() - started) + 2
    tracemalloc.start()
    main_text(half)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 500 << 20


def test_very_long_page():
    body = "".join(f"<p>{LONG} {i}</p>" for i in range(20_000))
    assert main_text(SHELL.format(f"<article>{body}</article>")).count("\n") == 19_999


def test_rows_pass_through(spark):
    pages = spark.createDataFrame([(1, "u", "<article>a&amp;b 😀</article>", "old", 3), (None, None, None, "", 0), (1, "u", "<article>a&amp;b 😀</article>", "old", 3)], "page_id long, url string, html string, text string, n_chars int")
    got = sorted(((r.page_id, r.url, r.text, r.n_chars) for r in extract(pages).collect()), key=str)
    assert got == [(1, "u", "a&b 😀", 5), (1, "u", "a&b 😀", 5), (None, None, "", 0)]
    assert extract(pages.limit(0)).count() == 0

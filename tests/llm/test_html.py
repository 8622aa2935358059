"""Article blocks of made-up layouts, boilerplate of a host without articles, odd pages."""

import random

from chorale.llm.html import DEPTH, article, blocks, buckets, extract_text, longest_repeats, stream

LAYOUTS = [
    ("<form><article><p>A &amp; b<br>c</p><div class='post-comments'><p>no</p></div></article></form>", "A & b c"),
    ("<article><header><h1>Title</h1></header><p>One<p>Two &lt;b&gt; <i>in</i>line<footer>f</footer></article><p>tail", "Title\nOne\nTwo <b> inline"),
    ("<div class=cookie-notice>x</div><main>y <!-- z --> w<aside>a</aside></main>", "y w"),
    ("<article><p>a&nbsp; \n b</p><script>if (a<b) '</p>'</script><style>p{}</style><p hidden>h</p><ul><li>i<li>j</ul></article>", "a b\ni\nj"),
    ("<article></article>", ""),
    ("", ""),
    (None, ""),
]


def test_layouts(spark):
    rows = [(i, f"http://h{i}.org/", page, "clash") for i, (page, _) in enumerate(LAYOUTS)]
    frame = spark.createDataFrame(rows + rows[:1] + [(9, None, "<article>" + "<p>long text</p>" * 30_000 + "</article>", None)], "page_id long, url string, html string, text string")
    for row in extract_text(frame).collect():
        expected = "\n".join(["long text"] * 30_000) if row.page_id == 9 else LAYOUTS[row.page_id][1]
        assert (row.text, row.n_chars) == (expected, len(expected))
    assert extract_text(frame).count() == len(LAYOUTS) + 2
    assert extract_text(frame.limit(0)).collect() == []


def test_repeated_runs_of_a_host_go_and_unique_runs_stay(spark):
    rng = random.Random(4)
    common = "read more of our stories about life and times here"
    bodies = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(30)) for _ in range(8)]
    pages = [f"<div>{common}</div><div>{body}</div><div class='x'>{common} {i}</div>" for i, body in enumerate(bodies)]
    rows = [(i, f"http://{'one' if i < 6 else 'two' + str(i)}.org/", page) for i, page in enumerate(pages)]
    rows += [(100, "http://one.org/copy", pages[0])]  # a copy of a page is no evidence against it
    texts = {r.page_id: r.text for r in extract_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for i, body in enumerate(bodies):
        alone = i >= 6
        expected = f"{common}\n{body}\n{common} {i}" if alone else f"{body}\n{i}"
        assert texts[i] == expected
    assert texts[100] == texts[0]


def test_suffix_buckets_equal_a_sorted_suffix_array():
    rng = random.Random(8)
    pages = [f"<p>{' '.join(rng.choice('abc') for _ in range(40))}</p>" for _ in range(6)]
    streams = [[t for t, _ in stream(blocks(p))] for p in pages]
    array = sorted((s[i : i + DEPTH], n) for n, s in enumerate(streams) for i in range(len(s) - DEPTH + 1))
    repeated = {tuple(a) for (a, n), (b, m) in zip(array, array[1:], strict=False) if a == b and n != m}
    keys: dict[int, set[int]] = {}
    for n, page in enumerate(pages):
        for key in buckets("h", stream(blocks(page))):
            keys.setdefault(key, set()).add(n)
    by_key = {k for k, n in keys.items() if len(n) > 1}
    found = {tuple(s[i : i + DEPTH]) for s in streams for i, k in enumerate(buckets("h", [(t, 0) for t in s])) if k in by_key}
    assert found == repeated


def test_tags_that_are_not_closed():
    assert article(blocks("<nav><a href='x'>m</a><article><p><b>one<p>two")) == ["one", "two"]
    assert [b[0] for b in blocks('<a href="x>y</a> text')] == ["y text"]
    assert [b[0] for b in blocks("plain < 3 & 4")] == ["plain < 3 & 4"]
    assert blocks("<!-- never closed <p>x") == []


def test_a_mark_ends_where_an_end_tag_is_left_out():
    assert article(blocks('<article><p class="ad">x<p>text<p>more</article>')) == ["text", "more"]
    assert article(blocks('<article><ul><li class="share">x<li>one</ul><p>two</article>')) == ["one", "two"]


def test_marks_need_a_name_of_the_layout():
    page = '<article><div style="overflow:hidden">a</div><p title="a hidden gem">b</p><p><a href="/hidden/place">c</a><a href=/hidden>d</a></p><p HIDDEN>no</p></article>'
    assert article(blocks(page)) == ["a", "b", "cd"]
    assert article(blocks('<main class="site-main has-sidebar"><p>a</p></main>')) == ["a"]
    assert article(blocks('<article class="comment"><p>a</p></article>')) == ["a"]
    assert article(blocks('<article><p>a</p></article><article class="related"><p>no</p></article>')) == ["a"]
    page = '<article><p class="social-policy">a</p><p class="ad-slot">no</p><p class="post-comments">no</p><p class="no-comments">b</p></article>'
    assert article(blocks(page)) == ["a", "b"]


def test_pages_without_a_host_do_not_erase_each_other(spark):
    text = "the same eight words stand in both pages"
    rows = [(1, None, f"<div>{text} one</div>"), (2, None, f"<div>{text} two</div>"), (3, "no host", f"<div>{text} three</div>")]
    texts = {r.page_id: r.text for r in extract_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert texts == {1: f"{text} one", 2: f"{text} two", 3: f"{text} three"}


def test_a_tag_that_is_no_article_hides_no_text(spark):
    story = "a story in a plain element of some length"
    pages = [
        f"<!-- <main> --><div>{story}</div>",
        f"<script>var t='<article>'</script><div>{story}</div>",
        f"<aside><article><p>a teaser</p></article></aside><div>{story}</div>",
        f"<article><p>{story}</p></article><div>not this</div>",
        "<article></article>",
    ]
    rows = [(i, f"http://host{i}.org/", page) for i, page in enumerate(pages)]
    shared = "the same notice of nine words stands on pages"
    rows += [(10 + i, "http://one.org/", f"<!-- <main> --><div>{shared}</div><p>own{i} text{i}</p>") for i in range(3)]
    texts = {r.page_id: r.text for r in extract_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert [texts[i] for i in range(5)] == [story, story, story, story, ""]
    assert [texts[10 + i] for i in range(3)] == [f"own{i} text{i}" for i in range(3)]


def words(rng, n):
    return " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))


def texts_of(spark, rows):
    return {r.page_id: r.text for r in extract_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}


def test_longest_repeats_equal_brute_force(spark):
    rng = random.Random(11)
    passages = [[rng.choice("abcd") for _ in range(n)] for n in (7, 23, 31, 94)]
    streams = []
    for _ in range(9):
        parts = [[rng.choice("abcdefgh") for _ in range(rng.randrange(9))] + rng.choice(passages)[rng.randrange(3) :] for _ in range(4)]
        streams.append([t for part in parts for t in part])
    klass = [0, 0, 1, 2, 3, 3, 4, 5, 6]  # pages 0 and 1, 4 and 5 are near copies
    rows = [(key, n, i, klass[n], 3, 4) for n, s in enumerate(streams) for i, key in enumerate(buckets("h", [(t, 0) for t in s]))]
    columns = "name long, content long, at int, class long, classes long, pages long"
    found = longest_repeats(spark.createDataFrame(rows + rows[:20], columns))
    holders: dict[tuple, set[int]] = {}
    for n, s in enumerate(streams):
        for i in range(len(s)):
            for j in range(i + DEPTH, len(s) + 1):
                holders.setdefault(tuple(s[i:j]), set()).add(n)
    expected = {}
    for n, s in enumerate(streams):
        for i in range(len(s)):
            fits = [j - i for j in range(i + DEPTH, len(s) + 1) if len(h := holders[tuple(s[i:j])]) >= 4 and len({klass[x] for x in h}) >= 3]
            if fits:
                expected[n, i] = max(fits)
    assert {*expected.values()} - {6, 7, 12, 24, 48}  # lengths between the levels too
    assert {(r.content, r.at): r.length for r in found.collect()} == expected
    assert longest_repeats(spark.createDataFrame([], columns)).collect() == []


def test_near_copies_and_quotations_stay_without_an_article(spark):
    rng = random.Random(12)
    body, quote, menu = words(rng, 60), words(rng, 12), words(rng, 8)
    rows = [(i, "http://near.org/", f"<div>{body} last{i}</div>") for i in range(6)]
    own = [words(rng, 20) for _ in range(12)]
    pages = [f"<div>{menu}</div><p>{o}{' ' + quote if i < 2 else ''}</p><p>x{i} {menu.rsplit(' ', 1)[0]} y{i}</p>" for i, o in enumerate(own)]
    rows += [(100 + i, "http://many.org/", page) for i, page in enumerate(pages)]
    texts = texts_of(spark, rows)
    assert [texts[i] for i in range(6)] == [f"{body} last{i}" for i in range(6)]
    for i, o in enumerate(own):
        # the menu goes as a block of its own; seven of its words inside a text are too few to cut that
        assert texts[100 + i] == f"{o}{' ' + quote if i < 2 else ''}\nx{i} {menu.rsplit(' ', 1)[0]} y{i}"


def test_the_array_decides_on_articles_too(spark):
    rng = random.Random(13)
    notice, shared, copied = words(rng, 9), words(rng, 9), words(rng, 60)
    own = [words(rng, 20) for _ in range(10)]
    page = lambda *texts: "<article>" + "".join(f"<p>{t}</p>" for t in texts) + "</article><footer>f</footer>"
    # a notice on every page but one goes, what half of the pages share stays
    rows = [(i, "http://a.org/", page(own[i], *[shared] * (i < 5), *[notice] * (i < 9))) for i in range(10)]
    # the same notice elsewhere, on too few pages
    rows += [(100 + i, "http://b.org/", page(own[i], notice)) for i in range(7)]
    # near copies and copies are one page
    rows += [(200 + i, "http://c.org/", page(copied, f"last{i % 9}", notice)) for i in range(12)]
    # an article of nothing else keeps its text
    rows += [(300 + i, "http://d.org/", page(*[own[i]] * (i < 9), notice)) for i in range(10)]
    texts = texts_of(spark, rows)
    for i in range(10):
        assert texts[i] == "\n".join([own[i]] + [shared] * (i < 5))
        assert texts[300 + i] == (own[i] if i < 9 else notice)
    assert [texts[100 + i] for i in range(7)] == [f"{own[i]}\n{notice}" for i in range(7)]
    assert [texts[200 + i] for i in range(12)] == [f"{copied}\nlast{i % 9}\n{notice}" for i in range(12)]


def test_articles_lose_repeats_inside_and_across_blocks(spark):
    rng = random.Random(14)
    inside, tail = words(rng, 12), [words(rng, 3), words(rng, 4)]
    for n in (12, 60):
        own = [words(rng, 20) for _ in range(n)]
        page = lambda i: f"<article><p>{own[i]} {inside} end{i}</p><p>{tail[0]}</p><p>{tail[1]}</p></article>"
        texts = texts_of(spark, [(i, "http://a.org/", page(i)) for i in range(n)])
        # the run in a block is cut out, the two short blocks make one repeat
        assert texts == {i: f"{own[i]} end{i}" for i in range(n)}

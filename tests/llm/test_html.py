import pytest

from feedkit.llm.html import MARK, WORD, Page, best_run, counted, extract, weights_of

PAGE = """<!DOCTYPE html><html lang=en><head><title>T &amp; t</title><style>p{}</style><script>var t="</p><article>";</script></head>
<body class="no-sidebar"><header>Site name</header><nav><ul><li><a href="/a">Home</a></li><li><a href="/b">News</a></li></ul></nav><!-- ad <p>x</p> -->
<div class="ad">Buy this now</div><article><h1>Title &lt;here&gt;</h1><p><b>First line<br><p>Second  one
with <i>soft</i> break&nbsp;&eacute;.</p><aside>see also</aside><form>Search <input name=q> <button>go</button></form>
<div class="comment-list"><p>nice post</p></div><ul><li>one</li><li>two</ul></article><section id=comments><article class=comment>me too</article></section>
<div class="cookie notice">We use cookies</div><footer>&copy; all rights</footer></body></html>"""
TEXT = "Title <here>\nFirst line\nSecond one with soft break é.\none\ntwo"


def learned(pages):
    return weights_of(counted(pages))


def test_article_is_extracted():
    plain = PAGE.replace("<section id=comments><article class=comment>me too</article></section>", "")
    for weights in ({}, learned([plain]), learned([plain] * 20)):
        assert Page(PAGE).text(weights) == TEXT


def test_words_score_positive_and_tags_negative():
    weights = learned([PAGE.replace("<article class=comment>me too</article>", "")] * 5)
    assert all((w > 0) == k.startswith("w:") for k, w in weights.items())
    assert weights["w:p"] > weights["w:footer"] and weights["p"] > weights["nav"]


def test_pages_without_article_are_found_by_their_words():
    body = " ".join(f"<p>{'word ' * 30}{i}</p>" for i in range(4))
    page = f"<body><ul class=x>{'<li><a href=x>menu</a></li>' * 20}</ul><div>{body}</div><div class=related><a>more</a></div><table>{'<tr><td>x</td></tr>' * 9}</table></body>"
    assert Page(page).text({}) == "\n".join(f"{'word ' * 30}{i}" for i in range(4))


def brute(scores):
    best, found = 0.0, (0, 0)
    for i in range(len(scores)):
        for j in range(i + 1, len(scores) + 1):
            if sum(scores[i:j]) > best + 1e-9:
                best, found = sum(scores[i:j]), (i, j)
    return best, found


@pytest.mark.parametrize("seed", range(40))
def test_best_run_against_brute_force(seed):
    import random

    rng = random.Random(seed)
    scores = [rng.choice([-3, -1, 0, 1, 2, 4]) for _ in range(rng.randint(0, 25))]
    i, j = best_run(scores)
    assert sum(scores[i:j]) == brute(scores)[0]


def test_odd_markup():
    assert Page("").text({}) == Page("<p></p>").text({}) == Page("<!-- open").text({}) == Page("<script>x").text({}) == ""
    assert Page("a < b and c > d &unknown; &#233;").text({}) == "a < b and c > d &unknown; é"
    assert Page('<p title="a > b">quoted</p>').text({}) in ("quoted", "")
    long = '<p class="' * 20_000 + "x"  # quotes that never end
    assert isinstance(Page(long).text({}), str)
    assert Page("<article>" + "<div>" * 3000 + "deep" + "</div>" * 3000 + "</article>").text({}) in ("deep", "")
    assert (WORD, MARK) == (1.0, -3.25)


def test_rows(spark, saved, clashing):
    rows = [(1, "u", PAGE), (2, None, None), (None, "v", ""), (3, "w", PAGE), (3, "w", PAGE), (4, "x", "<article>" + "<p>w x</p>" * 50_000)]
    frame = saved(clashing(spark.createDataFrame(rows, "page_id long, url string, html string")))
    got = extract(frame).collect()
    assert sorted((r["page_id"] or 0, r["text"][:40], r["n_chars"]) for r in got) == sorted(
        [(0, "", 0), (1, TEXT[:40], len(TEXT)), (2, "", 0), (3, TEXT[:40], len(TEXT)), (3, TEXT[:40], len(TEXT)), (4, ("w x\n" * 10), 4 * 50_000 - 1)]
    )
    assert extract(frame.where("page_id > 90")).count() == 0


TITLE = "A title of as many words as a heading seldom has but here"
BODY = f"<h1>{TITLE}</h1>" + "".join(f"<p>{'word ' * 20}{i}</p>" for i in range(3))
BODY_TEXT = f"{TITLE}\n" + "\n".join(f"{'word ' * 20}{i}" for i in range(3))
WRAPPERS = ["<form id=aspnetForm>{}</form>", "<div class='site-content right-sidebar'>{}</div>", "<div id=page class=layout-sidebar>{}</div>", "<div class='content ad-free'>{}</div>"]


@pytest.mark.parametrize("wrapper", [*WRAPPERS, "<form><div class=layout-sidebar>{}</div></form>", "<head>{}"])
def test_wrappers_do_not_take_out_what_they_hold(wrapper):
    beside = "<nav>Home News</nav><div class=sidebar><p>Beside it</p></div><footer>rights</footer>"
    for inner in ("<article>{}</article>", "<main>{}</main>", "<div>{}</div>"):
        page = "<html><body>" + wrapper.format(beside + inner.format(BODY) + beside) + "</body></html>"
        for weights in ({}, learned([page]), learned([PAGE])):
            assert Page(page).text(weights) == BODY_TEXT, page
    assert Page("<body><article>" + wrapper.format(BODY) + "</article>").text({}) == BODY_TEXT


def test_an_article_with_few_of_the_words_is_not_taken_out():
    page = f"<aside><p>{'menu ' * 200}</p><article>{BODY}</article></aside>"
    assert Page(page).text({}) == BODY_TEXT
    assert Page(f"<main><p>Few words</p>{page}</main>").text({}).endswith(BODY_TEXT)
    equal = "<div class=widget><article><p>First of two</p></article></div><div class=widget><article><p>Second of two</p></article></div>"
    assert not any(o for o, n in zip(Page(equal).out, Page(equal).counts, strict=True) if n)


def test_articles_and_talk_beside_the_article_stay_out():
    page = f"<article>{BODY}</article>"
    for beside in ("<div class=related><article><p>other</p></article></div>", f"<div class=consent><p>{'law ' * 300}</p></div>", f"<div hidden><article><p>{'x ' * 300}</p></article></div>"):
        assert Page(page + beside).text({}) == BODY_TEXT
    assert Page(f"<div>{BODY}</div><div id=comments><p>{'talk ' * 300}</p></div>").text({}) == BODY_TEXT
    assert Page(f"<div class=menu>{'<a href=x>many links</a>' * 200}</div><div>{BODY}</div>").text({}) == BODY_TEXT


@pytest.mark.parametrize("icon", ["<svg/>", "<svg class='icon' />", '<SVG data-x="a > b" width=1 />', "<svg><path d=''/></svg>"])
def test_text_after_an_empty_svg_is_kept(icon):
    for end in ("", "<p>end <svg><title>out</title><text>of it</text></svg></p>"):
        page = f"<article>{icon}<p>First words {icon} here</p><p>more of them</p>{end}</article>"
        assert Page(page).text({}) == "First words here\nmore of them" + ("\nend" if end else "")

"""Pages whose article is in several blocks, in part outside the inner landmark, or in a wrapper named like furniture."""

from pelagia.llm import html_text

INTRO = "An introduction of a good length that says at once what all of the rest is going to be about, and why it should be read to its end by all who have anything to do with these things at work."
BODY = [f"Paragraph {k} of the body goes on for quite some words, so that it is taken for prose by any measure there is." for k in range(4)]
PROSE = "".join(f"<p>{t}</p>" for t in BODY)
ALL = " ".join(BODY)


def test_intro_beside_the_body_stays():
    page = f'<body><div id="content"><div class="intro"><p>{INTRO}</p></div><div class="body">{PROSE}</div></div></body>'
    assert html_text.main_text(page) == f"{INTRO} {ALL}"


def test_text_of_the_outer_landmark_stays():
    assert html_text.main_text(f"<body><main><p>{INTRO}</p><article>{PROSE}<p>End.</p></article></main></body>") == f"{INTRO} {ALL} End."


def test_wrapper_named_like_furniture():
    for inner in (PROSE, f"<p>{ALL}</p>"):
        page = f'<body><div class="header-layout">{inner}<div class="share">Share this</div></div><p>(c) 2020</p></body>'
        got = html_text.main_text(page)
        assert got.startswith(ALL) and "Share" not in got
    nested = f'<div class="widget page"><div class="sidebar-right layout">{PROSE}</div></div><p>(c) 2020</p>'
    assert html_text.main_text(nested).startswith(ALL)
    notice = "We use cookies on this page, and on all others too, as everybody does."
    assert html_text.main_text(f'<div class="cookie-notice"><p>{notice}</p></div><p>A short page.</p>') == "A short page."

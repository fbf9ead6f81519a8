"""Main text where no name, role or landmark helps, and of deeply nested pages."""

import re
import time

import pyarrow.parquet as pq

from pelagia.llm import html_text


def bare(html: str) -> str:
    """The page with its landmarks as plain blocks and without class, id and role."""
    html = re.sub(r"(?i)<(/?)(article|main|header|footer|nav|aside|section)\b", r"<\1div", html)
    return re.sub(r"(?i)\s(class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", "", html)


def test_text_of_bare_pages():
    pages = [h or "" for h in pq.read_table("/root/testdata/sf0.01/pages.parquet")["html"].to_pylist()]
    want = list(map(html_text.main_text, pages))
    got = [html_text.main_text(bare(h)) for h in pages]
    assert sum(a == b for a, b in zip(want, got)) >= 0.98 * len(pages)


def test_the_threshold_decides_on_every_page(monkeypatch):
    pages = [h or "" for h in pq.read_table("/root/testdata/sf0.01/pages.parquet")["html"].to_pylist()]
    for form in (str, bare):
        want = [html_text.main_text(form(h)) for h in pages]
        with monkeypatch.context() as m:
            m.setattr(html_text, "cluster", lambda values: values >= values.min())
            assert sum(html_text.main_text(form(h)) == w for h, w in zip(pages, want)) <= 0.1 * len(pages)


def test_names_are_evidence_that_a_text_within_the_article_does_not_outweigh():
    prose = "".join(f"<p>Paragraph {k} tells at some length what happened on that day and what came of it.</p>" for k in range(5))
    notice = f"<div class='cookie-notice'>{'We keep small files on your machine for many good reasons. ' * 40}</div>"
    want = html_text.main_text(f"<article><h1>News</h1>{prose}</article>")
    assert want.startswith("News Paragraph 0") and want.endswith("came of it.")
    for page in (f"<article><h1>News</h1>{notice}{prose}</article>", f"{notice}<main><h1>News</h1>{prose}</main>", f"<div><h1>News</h1>{prose}</div><div>{notice}</div>"):
        assert html_text.main_text(page) == want
    assert html_text.main_text("<article>Ok.</article>" + "<p>" + "Some other long text that stands elsewhere. " * 50) == "Ok."
    assert html_text.main_text("<article>foo<span class='ad'>x</span>bar</article>") == "foobar"
    assert html_text.main_text("<footer>Only a footer</footer><script>x</script>") == ""


def test_the_threshold_parts_a_long_menu_from_the_text(monkeypatch):
    menu = "<div><ul>" + "".join(f'<li><a href="/{k}">Topic number {k} of this site</a></li>' for k in range(120)) + "</ul></div>"
    prose = [f"Paragraph {k} tells at some length what happened on that day, to whom, and what came of it in the end." * 3 for k in range(6)]
    page = f"<html><body>{menu}<div><h1>What happened</h1>{''.join(f'<p>{p}</p>' for p in prose)}</div></body></html>"
    want = "What happened " + " ".join(prose)
    assert html_text.main_text(page) == want
    monkeypatch.setattr(html_text, "cluster", lambda values: values >= values.min())
    assert html_text.main_text(page) != want


def test_unclosed_tags_take_linear_time():
    began = time.time()
    assert html_text.main_text("<div><p>x" * 30_000).count("x") > 10_000
    assert html_text.main_text("<b><i>" * 30_000 + "some text" + "</u>" * 30_000) == "some text"
    assert time.time() - began < 15

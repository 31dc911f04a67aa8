"""Pages whose marked-up layout or missing end tags hide the article."""

import pytest

from lakewash.llm.html_extract import main_text

TEXT = " ".join(["The river rose over night and the town woke to water in its streets."] * 4)


@pytest.mark.parametrize("html, want", [
    (f"<body><form><p>{TEXT}</p></form></body>", TEXT),
    (f'<article class="post comments-open"><p>{TEXT}</p></article>', TEXT),
    (f'<div class="layout with-sidebar"><nav>Menu</nav><p>{TEXT}</p></div>', TEXT),
    (f'<div class="no-sidebar"><p>{TEXT}</p><footer>Imprint</footer></div>', TEXT),
    (f"<div><p class=ad>Buy<p>{TEXT}</div>", TEXT),
    (f"<ul><li class=ad>Buy<li>{TEXT}</ul>", TEXT),
    (f"<table><tr><td class=ad>Buy<td>{TEXT}<tr><td>{TEXT}</table>", f"{TEXT}\n\n{TEXT}"),
    (f"<ul><li>{TEXT}<ul><li class=ad>Buy</ul><li>{TEXT}</ul>", f"{TEXT}\n\n{TEXT}"),
    ('<div class="ad">Buy</div>', ""), ('<div class="cookie-notice">We use cookies.</div>', ""), ("", ""), (None, "")])
def test_layout_and_unclosed_tags(html, want):
    assert main_text(html) == want

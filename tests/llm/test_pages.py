"""Hand-made pages: what their article says, and what stands around and inside it."""

import pytest

from storyloom.llm import htmltext

BODY = "The valley was quiet when the first train of the morning came slowly around the long bend and stopped at the small station. "
MORE = "Nobody stepped out of it, and the guard looked twice at his watch before he raised the green flag and let it go. "
LAST = "In the evening the same train came back, this time full of people who had spent the whole day in the town. "
B, M, L = BODY.strip(), MORE.strip(), LAST.strip()
MENU = '<div class="top-menu"><ul><li><a href="/">Home</a></li><li><a href="/n">News of today</a></li><li><a href="/a">About us</a></li></ul></div>'
FOOT = '<div id="footer">All rights reserved by the owners of these pages</div>'
TALK = '<div class="comments"><h3>Comments</h3>' + "".join(f"<div class='comment'><b>user{i}</b><p>I like this text a lot, thank you so much for it, number {i}!</p></div>" for i in range(6)) + "</div>"

PAGES = {
    "a section's header": (f'<article><h1>Trains</h1><p>{B}</p><div class="section-header"><h2>Results</h2></div><p>{M}</p></article>', f"Trains {B} Results {M}"),
    "related work": (f'<article><p>{B}</p><div class="related-work"><p>{M}</p></div><p>{L}</p></article>', f"{B} {M} {L}"),
    "related work at the end": (f'<article><p>{B}</p><div class="related-work"><h2>Others</h2><p>{M}</p></div></article>', f"{B} Others {M}"),
    "a card's header first": (f'<article><div class="card-header"><h1>Trains</h1></div><p>{B}</p><p>{M}</p></article>', f"Trains {B} {M}"),
    "an alert box in the text": (f'<article><p>{B}</p><div class="alert-box"><p>Mind the gap.</p></div><p>{M}</p></article>', f"{B} Mind the gap. {M}"),
    "a tag line": (f'<article><h1>Trains</h1><p class="tag-line">A short day</p><p>{B}</p></article>', f"Trains A short day {B}"),
    "a quoted notice": (f'<article><p>{B}</p><blockquote class="notice-board">No bathing</blockquote><p>{M}</p></article>', f"{B} No bathing {M}"),
    "a banner heading": (f'<main><div class="banner-title"><h1>Trains</h1></div><p>{B}</p><p>{M}</p></main>', f"Trains {B} {M}"),
    "no content element": (f'{MENU}<div class="wrap"><h1>Trains</h1><p>{B}</p><div class="section-header"><h2>Results</h2></div><p>{M}</p><p>{L}</p></div>{FOOT}', f"Trains {B} Results {M} {L}"),
    "a related section without content element": (f'{MENU}<div class="wrap"><p>{B}</p><div class="related-work"><h2>Others</h2><p>{M}</p></div><p>{L}</p><p>{B}</p><p>{M}</p></div>{FOOT}', f"{B} Others {M} {L} {B} {M}"),
    "menus and footers": (f"{MENU}<article><p>{B}</p></article>{FOOT}", B),
    "comments behind": (f"<article><p>{B}</p><p>{M}</p></article>{TALK}{FOOT}", f"{B} {M}"),
    "comments inside": (f"<article><p>{B}</p><p>{M}</p>{TALK}</article>", f"{B} {M}"),
    "comments longer than the text": (f"<div class='text'><p>{B}</p><p>{M}</p></div>{TALK * 3}{FOOT}", f"{B} {M}"),
    "adverts inside": (f'<article><p>{B}</p><div class="advert"><p>Buy two, pay for one, today only!</p></div><p>{M}</p><div class="sponsored">Try our new soap</div><p>{L}</p></article>', f"{B} {M} {L}"),
    "a newsletter inside": (f'<article><p>{B}</p><div class="newsletter-box"><h3>Our letter</h3><p>Get it every week</p></div><p>{M}</p></article>', f"{B} {M}"),
    "share buttons and tags": (f'<article><p>{B}</p><ul class="share"><li><a href="#">Send</a></li><li><a href="#">Post</a></li></ul><p>{M}</p><div class="tags"><a href="/t">train</a> <a href="/v">valley</a></div></article>', f"{B} {M}"),
    "cookies and sidebars": (f'<div class="cookie-consent">We use cookies for a better visit of our pages</div><div id="sidebar"><p>Weather: rain</p></div><div class="story"><p>{B}</p><p>{M}</p></div>', f"{B} {M}"),
    "a site's notice": (f'<div class="site-notice">The shop is closed this week, sorry</div><article><p>{B}</p></article>', B),
    "forms and scripts inside": (f'<article><p>{B}</p><form><label>Mail</label><input></form><script>var a = "<p>x</p>";</script><style>p {{}}</style><p>{M}</p></article>', f"{B} {M}"),
    "related links": (f'<article><p>{B}</p><div class="related"><h3>More</h3><ul><li><a href="/1">A walk in the hills of the north</a></li><li><a href="/2">Ten good soups</a></li></ul></div></article>', B),
    "a table and a list": (f'<article><p>{B}</p><table class="widget-table"><tr><td>Time</td><td>Place</td></tr></table><ul><li>one</li><li>two</li></ul><p>{M}</p></article>', f"{B} Time Place one two {M}"),
}


@pytest.fixture(scope="module")
def fitted(spark):
    return htmltext.fit_weights([r.html for r in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect()])


@pytest.mark.parametrize("name", sorted(PAGES))
def test_page(name, fitted):
    page, text = PAGES[name]
    whole = f"<!DOCTYPE html><html><head><title>T</title></head><body>{page}</body></html>"
    assert htmltext.extract(whole, {}) == text
    assert htmltext.extract(whole, fitted) == text

"""HTML extraction on pages that were written and labelled by hand, none by the generator that the field is trained on.

In a page, what stands between [[ and ]] is main text; the marks are taken off before the page is read.
"""

import html
import re
from collections import Counter

import pytest

from scholium.llm import extraction

PAGES = {
    "news": """<!DOCTYPE html><html lang="en"><head><title>Harbour bridge reopens - The Daily Post</title><meta charset="utf-8"><style>p{color:red}</style></head><body>
<header><h1>The Daily Post</h1><p>Welcome to the site of news.</p><nav><ul><li><a href="/">Home</a></li><li><a href="/world">World</a></li><li><a href="/sport">Sport</a></li></ul></nav></header>
<div class="cookie-banner"><p>We use cookies to improve your experience. By using this site you agree to our policy.</p><button>Accept</button></div>
<article><h1>[[Harbour bridge reopens after two years]]</h1>
<p>[[The harbour bridge was opened to traffic again on Monday, two years after a crane had damaged its deck.]]</p>
<p>[[&ldquo;We are glad that it is over&rdquo;, said the mayor, who walked across with some two hundred guests.]]</p>
<div class="ad-slot"><p>Advertisement: buy two lamps and pay for one, only this week.</p></div>
<h2>[[What it cost]]</h2><p>[[The repair cost nineteen million, a little more than the council had planned for in its first budget.]]</p></article>
<aside class="related"><h3>Related stories</h3><ul><li><a href="/a">Ferry strikes again</a></li><li><a href="/b">Old tunnel closes</a></li></ul></aside>
<section id="comments"><h2>3 comments</h2><div class="comment"><p>I always said that this bridge would take its time.</p></div><div class="comment"><p>Thank you to all who worked on it, a good job well done.</p></div></section>
<footer><p>&copy; 2024 The Daily Post. All rights reserved.</p><a href="/privacy">Privacy</a></footer></body></html>""",
    "blog": """<html><body class="home"><div id="page"><div id="masthead" class="site-header"><h1 class="site-title"><a href="/">Notes of a gardener</a></h1><p>Thoughts on soil and weather</p></div>
<div id="primary" class="content-area"><div class="post"><h2 class="entry-title">[[How to prune an apple tree]]</h2><div class="entry-meta">Posted on May 3 by Ann | <a href="#c">2 comments</a></div>
<div class="entry-content"><p>[[Prune in late winter, before the buds swell, and take out no more than a fifth of the wood.]]</p><ul><li>[[Dead and sick branches go first.]]</li><li>[[Then those that cross each other.]]</li></ul>
<p>[[Use a sharp saw, and cut just outside of the collar of the branch so that the wound can close.]]</p></div>
<div class="sharing"><span>Share this:</span><a href="#">Mail</a><a href="#">Print</a></div></div>
<div id="respond" class="comment-respond"><h3>Leave a reply</h3><form><label>Name</label><input name="n"><button>Send</button></form></div></div>
<div id="secondary" class="sidebar widget-area"><h3>Recent posts</h3><ul><li><a href="1">Sowing beans</a></li><li><a href="2">Snails</a></li></ul></div>
<div class="site-footer">Proudly made by hand</div></div></body></html>""",
    "manual": """<html><body><nav class="toc"><a href="#1">Install</a> <a href="#2">Configure</a></nav><main><h1>[[Configuration]]</h1><p>[[The file has one option a line; blank lines and lines that start with a hash are skipped.]]</p>
<pre>[[timeout = 30 retries = 4]]</pre><table><tr><th>[[Option]]</th><th>[[Meaning]]</th></tr><tr><td>[[timeout]]</td><td>[[Seconds before a request is given up.]]</td></tr></table>
<blockquote>[[Note that a change takes effect only after the service was restarted.]]</blockquote></main><footer>Version 2.1 <a href="/license">License</a></footer></body></html>""",
    "bare": """<html><body><h1>[[On walking]]</h1><p>[[I have walked the same road for thirty years, and it has not been the same road twice.]]<p>[[In spring the ditch is full of frogs.]]<p>[[In autumn the wind takes the leaves of the poplars and lays them down at the gate.]]</body></html>""",
    "wrapper": """<html><body><div class="wrapper"><div class="topbar"><span>Call us: 555 0100</span><a href="/login">Log in</a></div><div class="menu"><a href="/">Start</a><a href="/shop">Shop</a></div>
<div class="row"><div class="main-content"><h1>[[Our workshop]]</h1><p>[[Since 1952 we have been repairing clocks, watches and barometers of every make in the old town.]]</p><p>[[Bring us your piece, and we will tell you within a week what can be done and what it costs.]]</p>
<figure><img src="x.jpg"><figcaption>[[The workshop in the year 1960]]</figcaption></figure></div><div class="sidebar"><p>Opening hours: Monday to Friday from nine to five, on Saturday until noon.</p></div></div>
<div class="newsletter"><p>Subscribe to our newsletter and receive an offer each month.</p><form><input><button>Subscribe</button></form></div><div class="footer"><p>Imprint and terms of use</p></div></div></body></html>""",
    "german": """<html><body><header class="kopf"><a href="/">Zeitung am Morgen</a></header><main><article><header><h1>[[Der Wald wird w&auml;rmer]]</h1></header><p>[[Forscher haben in drei W&auml;ldern gemessen, wie sich der Boden im Sommer erw&auml;rmt.]]</p>
<p>[[Das Ergebnis &uuml;berrascht: unter alten B&auml;umen bleibt es um bis zu vier Grad k&uuml;hler als im jungen Forst.]]</p><aside><p>Lesen Sie auch: Die Buche und der Regen</p></aside><p>[[Die Studie l&auml;uft noch bis 2027.]]</p></article></main><footer>Impressum Datenschutz</footer></body></html>""",
    "tables": """<html><body bgcolor=white><table width=100%><tr><td><a href="/">Home</a> | <a href="/map">Map</a> | <a href="/mail">Mail</a></td></tr></table><div id="content"><h1>[[Tide tables explained]]</h1>
<p>[[A tide table lists the hours of high and low water for each day of the year at one harbour.]]<br>[[Add an hour in summer.]]</p><dl><dt>[[Spring tide]]</dt><dd>[[The largest range, soon after new and full moon.]]</dd><dt>[[Neap tide]]</dt><dd>[[The smallest range, a week later.]]</dd></dl></div>
<div class="copyright">Copyright 2019 Harbour Office. All rights reserved.</div></body></html>""",
    "nested comments": """<html><body><div role="banner"><a href="/">Open Lab</a></div><div role="main"><article class="post hentry"><h1>[[A cheap spectrometer]]</h1><p>[[All you need is a slit, a piece of an old disc and the camera of your phone.]]</p><p>[[Calibrate it with the two lines of a fluorescent lamp.]]</p>
<div style="display:none"><p>You should never see this text, it is for machines.</p></div><ol class="commentlist"><li class="comment"><article><p>Great idea, I built one with my daughter and it works.</p></article></li><li class="comment"><p>Where did you get the slit?</p></li></ol></article></div>
<div role="complementary"><h3>Popular</h3><p>A better spectrometer for the price of two coffees, and how we made it.</p></div><div role="contentinfo"><p>Open Lab is run by volunteers.</p></div></body></html>""",
    "spanish": """<html><body><ul class="nav navbar-nav"><li><a href=/>Inicio</a></li><li><a href=/blog>Blog</a></li></ul><section class="post-body"><h2>[[La cocina de mi abuela]]</h2><p>[[Mi abuela cocinaba con le&ntilde;a, y la casa entera ol&iacute;a a humo y a pan reci&eacute;n hecho.]]</p>
<div class="promo"><p>Compra ahora nuestro libro de recetas con un descuento del veinte por ciento.</p></div><p>[[No med&iacute;a nada; todo lo hac&iacute;a a ojo, y siempre le sal&iacute;a bien.]]</p></section><div class="popup"><p>Suscr&iacute;bete a nuestro bolet&iacute;n</p></div><footer><div>&copy; Casa Abuela</div></footer></body></html>""",
    "japanese": """<html><body><nav><a href="/">ホーム</a><a href="/news">ニュース</a></nav><article><h1>[[山の秋]]</h1><p>[[十月になると、山の木々は赤や黄色に染まり、多くの人が登ってくる。]]</p><p>[[朝は寒いので、上着を持って行くとよい。]]</p></article><div class="sidebar"><p>人気の記事：川の釣り、海の夏、里の冬</p></div><footer>著作権</footer></body></html>""",
    "plain header": """<header><h1>Site</h1></header><article><h1>[[A walk by the sea]]</h1><p>[[The tide was out, and the sand was firm enough to walk on for miles.]]</p><p>[[We turned back when the rain came.]]</p></article>""",
    "header with text": """<header><p>Welcome to the site of news.</p></header><article><p>[[The tide was out, and the sand was firm enough to walk on for miles.]]</p></article>""",
    "entry header": """<html><body><header class="site-header"><p class="site-title"><a href="/">Field notes</a></p><nav class="main-navigation"><a href="/">Home</a><a href="/about">About</a></nav></header>
<article class="post"><header class="entry-header"><h1 class="entry-title">[[The ferry to the outer islands]]</h1><div class="entry-meta">May 3 by Ann</div></header><div class="entry-content"><p>[[It leaves at six in the morning, and in winter only when the sea is calm enough to land.]]</p>
<p>[[Take bread with you, since there is no shop on the second island.]]</p></div><footer class="entry-footer">Filed under travel</footer></article><footer class="site-footer">Made by hand</footer></body></html>""",
    "article header": """<body><div class="page"><header class="header"><a href="/">The Morning Paper</a></header><main><article class="article"><header class="article-header"><h1>[[A quiet winter for the port]]</h1><p>[[Fewer ships came in than in any year since the war, and most of them were half empty.]]</p></header>
<p>[[The harbour master blames the ice, which came early and stayed until the end of March.]]</p></article></main><footer>All rights reserved</footer></div></body>""",
    "block header": """<body><div class="topbar"><a href="/login">Log in</a></div><article><header class="article__header"><h1>[[Old maps of the delta]]</h1></header><div class="article__body"><p>[[The oldest of them shows eleven arms of the river, of which four can still be found.]]</p></div></article>
<aside class="sidebar"><h3>More maps</h3><ul><li><a href="/1">The coast</a></li></ul></aside></body>""",
    "deep comments": "<article><p>[[The tide was out, and the sand was firm enough to walk on for miles.]]</p></article>" + '<div>' * 1500 + '<section class="comments"><p>I was there too, and it was a fine day for a walk along the water.</p></section>' + "</div>" * 1500,
}
MARKED = re.compile(r"\[\[(.*?)\]\]", re.S)


@pytest.fixture(scope="module")
def field():
    return extraction.train()


def words(name, field):
    page = PAGES[name]
    want = " ".join(html.unescape(x) for x in MARKED.findall(page))
    return want.split(), extraction.main_text(MARKED.sub(r"\1", page), field).split()


@pytest.mark.parametrize("name", PAGES)
def test_page(name, field):
    want, got = words(name, field)
    common = sum((Counter(want) & Counter(got)).values())
    assert common >= 0.97 * len(want), f"lost of {name}: {got}"
    assert common >= 0.95 * len(got), f"too much of {name}: {got}"


def test_all_pages_together(field):
    """What the README states."""
    found = [words(name, field) for name in PAGES]
    common = sum(sum((Counter(a) & Counter(b)).values()) for a, b in found)
    wanted, got = sum(len(a) for a, _ in found), sum(len(b) for _, b in found)
    print(f"{len(found)} pages, recall {common / wanted:.3f}, precision {common / got:.3f}")
    assert common >= 0.98 * wanted and common >= 0.98 * got

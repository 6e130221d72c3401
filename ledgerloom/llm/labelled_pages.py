"""Labelled pages that train the HTML extraction: data-main marks content, data-off what is none within it.

``PAGES`` are written by hand. ``varied`` makes others from parts that pages have, in
random order, each with a telling tag or name or, as often, with none, so that length,
links and neighbours must tell. Other seeds give pages to measure on.
"""

from __future__ import annotations

import random
import re
from collections.abc import Callable

SUBJECTS = "the council, a small team, our reporter, the museum, every farmer, the old mill, her sister, one engineer, the river, a new law".split(", ")
VERBS = "opened, measured, described, lost, repaired, crossed, remembered, planted, sold, counted".split(", ")
OBJECTS = "the bridge, three maps, a field of rye, the northern road, ten boats, the first machine, an answer, the harbour, its own garden, a letter".split(", ")
ENDS = "in spring, after the storm, without any help, for the second time, near the coast, before noon, as planned, with great care, last year, by hand".split(", ")
LINKS = "Home, World, Sport, Arts, Science, Shop, Help, Contact, Jobs, About us, Archive, Maps, Weather, Log in".split(", ")
NOTES = ("We use cookies, accept or change your settings.", "Sale: two for the price of one until Sunday.", "All rights reserved.", "Sign up for our letter.",
         "Open every day from nine to five.", "Buy a garden chair now and save a third.", "Read also: ten walks along the coast")
# Tags and attributes that a part may have: telling ones, then none.
MAIN = ("article", "main", "div class=entry-content", "div id=content", "section class=post-body", "div class=story", "td class=text")
MENU = ("nav", "div class=menu", "ul class=navbar", "div id=toolbar")
SIDE = ("aside", "div class=sidebar", "div class=related", "section class=widget")
EDGE = ("footer", "header", "div class=footer", "div id=masthead")
NOTICE = ("div class=ad", "div class='promo banner'", "div id=cookie-notice", "div class=newsletter", "section class=sponsored")
COMMENTS = ("div class=comments", "section id=respond", "div class=reader-feedback", "ol class=comment-list")
NAMELESS = ("div", "div class=c7", "section", "div class=x-row", "div class=col")

PAGES = [
    """<html><head><title>Bridge reopens</title></head><body><header class="site-header"><div class="logo">The Daily</div></header>
<nav><ul><li><a href="/a">Home</a></li><li><a href="/b">World</a></li><li><a href="/c">Sport</a></li></ul></nav><div class="ad">Buy two shirts and get one for free today.</div>
<article data-main><h1>Bridge reopens after two years</h1><p>The old bridge over the river was opened to traffic again on Monday morning.</p>
<p>Short words.</p><p>Engineers had to replace every cable, and the work took longer than planned.</p>
<div class="ad" data-off>Sponsored: cheap flights to the coast, book now.</div><ul><li>Cost: 12 million</li><li>Length: 300 metres</li></ul>
<section class="comments" data-off><h3>Comments</h3><div class="comment"><p>I have waited for this for such a long time, thank you all.</p></div></section></article>
<aside class="sidebar"><h3>Most read</h3><ul><li><a href="/x">Ten tips for your garden</a></li></ul></aside>
<footer>&copy; The Daily. All rights reserved. Contact us.</footer></body></html>""",
    """<html><body><div id="cookie-banner" class="notice">We use cookies to make this site better. Accept or change your settings.</div>
<div id="top-menu"><a href="/">Start</a> <a href="/shop">Shop</a> <a href="/help">Help</a></div>
<div id="content" class="post" data-main><h2>How to bake rye bread</h2><p>Mix flour, water and salt, then let the dough rest over night in a cool place.</p>
<blockquote>Patience is the most important ingredient of all.</blockquote><table><tr><td>Flour</td><td>500 g</td></tr><tr><td>Water</td><td>400 g</td></tr></table>
<p>Bake it for <b>fifty</b> minutes. <a href="/more">More about ovens</a> can be read elsewhere.</p>
<form class="newsletter" data-off><label>Your address</label><button>Subscribe</button></form><div class="share" data-off><a href="#">Share</a> <a href="#">Tweet</a></div></div>
<div id="comments"><p>Great recipe, I made it twice this week and my family loved it.</p><p>Mine did not rise at all.</p></div>
<div class="footer"><p>Imprint and privacy. Made with love in the kitchen.</p></div></body></html>""",
    """<html><body><main data-main><h1>Notes on rivers</h1><p>Yes.</p><p>A river carries sand and stones from the hills to the sea, and lays them down where it slows.</p><pre>depth = flow / width</pre>
<dl><dt>Delta</dt><dd>The land that a river builds at its mouth.</dd></dl><p>Where the slope is steep, the water cuts into its bed.</p>
<aside class="related" data-off><p>Read also: our long series on lakes and the people who live there.</p></aside></main>
<nav class="breadcrumb"><a href="/">Home</a> / <a href="/r">Rivers</a></nav><aside><p>Advertisement: kayaks for the whole family, now at half the price.</p></aside><footer><p>Terms of use.</p></footer></body></html>""",
    """<html><body><div class="wrapper"><div class="banner promo">Summer sale ends on Sunday, do not miss it.</div><div class="menu"><ul><li><a>News</a></li><li><a>Arts</a></li></ul></div>
<div class="entry-content" data-main><p>The committee met on Thursday to discuss the plan for the new school.</p><p>It will be built next to the park, members said after the meeting.</p><h3>What comes next</h3>
<p>Parents can hand in their views until May.</p><ol><li>Read the plan.</li><li>Write to the office.</li></ol><figure><figcaption>The site of the school in spring.</figcaption></figure></div>
<div class="sidebar widget"><p>Weather: sunny with a light wind from the west today.</p></div><div class="respond reader-comments"><p>They should have asked us earlier about the traffic in our street.</p></div></div></body></html>""",
    """<html><body><div><p data-main>Plain pages have no names for their parts, only paragraphs with whole sentences in them.</p><p data-main>A reader still knows at once what the text is, because it is long and has few links.</p>
<p><a href="/1">One</a> <a href="/2">Two</a> <a href="/3">Three</a></p></div><div><a href="/about">About</a> <a href="/jobs">Jobs</a></div><form><p>Search this site for words</p><select><option>All</option></select></form></body></html>""",
    """<html><body><header><h1>City Library</h1><p>Open every day from nine to five, also on holidays.</p></header><section class="story" data-main><h1>A gift of ten thousand books</h1>
<p>A collector has left all of his books to the library, among them rare maps.</p><p>They will be shown from June.</p></section><div class="advert"><p>Reading glasses at fair prices, only in our shop in the main street.</p></div>
<div class="alert" role="alert"><p>Please note that the lift is out of order until further notice.</p></div><div style="display:none"><p>This paragraph is hidden from all readers of the page.</p></div>
<footer class="page-footer"><ul><li><a href="/p">Privacy</a></li></ul><p>City Library, Main Street 1.</p></footer></body></html>""",
    """<html><body><nav><a>Top</a></nav><article data-main><h1>Short note</h1><p>Done.</p></article><div class="ad">Cars.</div><footer>All content is owned by its authors and may not be copied without leave.</footer></body></html>""",
    """<html><body><div class="ad">En passant.</div><article class="article-body" data-main><h1>Travel</h1><p>We left at dawn.<br>It was cold.</p><p>Prices: bread &amp; milk, $2 | tea, $1 *** all fresh ###</p>
<p>OLD!! AND!! LOUD!! WORDS!! STILL!! BELONG!! HERE!!</p><div class="cookie-consent" data-off><p>This site uses cookies for statistics and for advertising.</p></div></article><footer>&copy; travel.example</footer></body></html>""",
]


def _sentence(rng: random.Random) -> str:
    parts = [rng.choice(x) for x in (SUBJECTS, VERBS, OBJECTS, ENDS)[:rng.choice((3, 4, 4))]]
    return " ".join(parts).capitalize() + "."


def _paragraph(rng: random.Random) -> str:
    inline = rng.choice(("{}", "{}", "{}", "<b>Note.</b> {}", "{} <a href=/n>More.</a>", "<em>{}</em>"))
    return "<p>" + inline.format(" ".join(_sentence(rng) for _ in range(rng.choice((1, 2, 2, 3, 5))))) + "</p>"


def _content(rng: random.Random) -> str:
    items = lambda: "".join(f"<li>{_sentence(rng)}</li>" for _ in range(rng.randint(2, 4)))
    extra = (lambda: f"<h2>{rng.choice(OBJECTS).capitalize()}</h2>", lambda: f"<ul>{items()}</ul>", lambda: f"<blockquote>{_sentence(rng)}</blockquote>",
             lambda: "<p>Yes.</p>", lambda: f"<figure><figcaption>{rng.choice(OBJECTS).capitalize()} {rng.choice(ENDS)}</figcaption></figure>")
    blocks = [rng.choice(extra)() if rng.random() < 0.3 else _paragraph(rng) for _ in range(rng.randint(2, 7))]
    return "".join([f"<h1>{rng.choice(SUBJECTS).capitalize()} and {rng.choice(OBJECTS)}</h1>"] * (rng.random() < 0.7) + [_paragraph(rng), *blocks])


def _menu(rng: random.Random) -> str:
    links = [f"<a href=/{k}>{x}</a>" for k, x in enumerate(rng.sample(LINKS, rng.randint(3, 7)))]
    return rng.choice(("<ul>" + "".join(f"<li>{x}</li>" for x in links) + "</ul>", " ".join(links), "<p>" + " | ".join(links) + "</p>"))


def _comments(rng: random.Random) -> str:
    return "".join(f"<div class=comment><p>{_sentence(rng)}</p></div>" for _ in range(rng.randint(1, 4)))


def _part(rng: random.Random, names: tuple[str, ...], inner: str, telling: bool, mark: str = "") -> str:
    name = rng.choice(names if telling else NAMELESS)
    return f"<{name}{mark}>{inner}</{name.split()[0]}>"


def varied(count: int, seed: int) -> list[str]:
    """So many labelled pages; the same for the same seed."""
    rng, out = random.Random(seed), []
    note = lambda: f"<p>{rng.choice(NOTES)}</p>"
    around: list[Callable[[bool], str]] = [
        lambda t: _part(rng, MENU, _menu(rng), t), lambda t: _part(rng, EDGE, note() if rng.random() < 0.5 else _menu(rng), t),
        lambda t: _part(rng, SIDE, "<h3>Most read</h3>" + _menu(rng), t), lambda t: _part(rng, NOTICE, note(), True),
        lambda t: _part(rng, COMMENTS, _comments(rng), True), lambda t: "<form><p>Search this site</p></form>"]
    for _ in range(count):
        telling = rng.random() < 0.5
        inner = _content(rng)
        for part in rng.sample((_part(rng, NOTICE, note(), True, " data-off"), _part(rng, COMMENTS, _comments(rng), True, " data-off"),
                                _part(rng, SIDE[:3], note(), True, " data-off")), rng.choice((0, 0, 1, 2))):
            inner += part
        parts = [rng.choice(around)(rng.random() < 0.6) for _ in range(rng.randint(2, 6))]
        if rng.random() < 0.25:  # no element of its own
            main = re.sub("<(h1|h2|p|ul|blockquote|figure)>", r"<\1 data-main>", _content(rng))
        else:
            main = _part(rng, MAIN, inner, telling, " data-main")
        parts.insert(rng.randint(0, len(parts)), main)
        body = "".join(parts)
        out.append(f"<html><head><title>x</title></head><body>{f'<div>{body}</div>' if rng.random() < 0.4 else body}</body></html>")
    return out

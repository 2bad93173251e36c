"""Main text of hand-written pages in layouts that no practice page has; the wanted texts are written by hand as well."""

import duckdb
import pytest

from chartmill.llm import html_blocks, html_text

PAGES = {
    "names that say nothing": (
        '<html><head><title>T</title></head><body><div class="q1"><div class="z9"><a href="/">Home</a> <a href="/n">News</a> <a href="/s">Sport</a></div><div class="k2"><h1>The old mill by the river</h1>'
        '<div>The river runs past the old mill and on to the sea, where boats wait for the tide.</div><div>Nobody in the village could say when the clock had last shown the right time.</div>'
        '<div>In the evening the lights go on, and the ferry makes its last trip.</div></div><div class="r5"><div>2 Comments</div><div><b>Ann</b> Great piece, thanks!</div>'
        '<div><b>Bob</b> I used to live there.</div></div><div class="f7">(c) 2024 Example Ltd</div></div></body></html>',
        "The old mill by the river\nThe river runs past the old mill and on to the sea, where boats wait for the tide.\nNobody in the village could say when the clock had last shown the right time.\n"
        "In the evening the lights go on, and the ferry makes its last trip."),
    "comments by another name": (
        '<html><body><ul class="menu"><li><a href="/">Start</a></li><li><a href="/a">Alle Artikel</a></li></ul><article><h1>Die Brücke am Fluss</h1><p>Der alte Mann ging jeden Morgen über die Brücke und kaufte sich eine Zeitung.</p>'
        '<p>Am Abend kam er wieder zurück, und der Hund lief voraus.</p></article><div class="kommentare"><p>Toller Text, danke!</p><p>Das sehe ich anders.</p></div><footer>Impressum</footer></body></html>',
        "Die Brücke am Fluss\nDer alte Mann ging jeden Morgen über die Brücke und kaufte sich eine Zeitung.\nAm Abend kam er wieder zurück, und der Hund lief voraus."),
    "misleading names inside": (
        '<html><body><header><a href="/">Site</a></header><article><h1>On bread</h1><p>Bread is made of flour, water, salt and time, and of these time matters most.</p><div class="more"><p>The dough should rest overnight, so that the flavour can develop.</p></div>'
        '<p class="notice-text">Note that rye needs more water than wheat does.</p></article><div class="cookie-banner"><p>We use cookies.</p><button>OK</button></div></body></html>',
        "On bread\nBread is made of flour, water, salt and time, and of these time matters most.\nThe dough should rest overnight, so that the flavour can develop.\nNote that rye needs more water than wheat does."),
    "ids only": (
        '<html><body><div id="x1"><a href="/1">One</a> | <a href="/2">Two</a> | <a href="/3">Three</a></div><div id="x2"><h2>A walk in the hills</h2><p>We left early, while the fog still lay in the valley.</p><p>By noon the sun had come through, and the path was dry.</p>'
        '<p>It was dark when we came back.</p></div><div id="x3"><h4>Related</h4><a href="/r1">Ten walks near the city</a><a href="/r2">What to pack</a></div><div id="x4"><form><label>E-mail</label><input><button>Subscribe</button></form></div>'
        '<div id="x5">Copyright 2023 Hill Press. All rights reserved.</div></body></html>',
        "A walk in the hills\nWe left early, while the fog still lay in the valley.\nBy noon the sun had come through, and the path was dry.\nIt was dark when we came back."),
    "a table as layout": (
        '<html><body><table><tr><td width=150><a href="/a">About</a><br><a href="/b">Archive</a><br><a href="/c">Contact</a></td><td><h1>Salt</h1><p>Salt was once worth its weight in gold, and roads were built to carry it.</p>'
        '<p>Towns on these roads grew rich, and some still bear its name.</p></td></tr><tr><td colspan=2><small>&copy; 1999 A. Writer</small></td></tr></table></body></html>',
        "Salt\nSalt was once worth its weight in gold, and roads were built to carry it.\nTowns on these roads grew rich, and some still bear its name."),
    "lists and quotes inside": (
        '<body><nav><a href="/">Accueil</a><a href="/b">Blog</a></nav><main><h1>Le pain du matin</h1><p>Il faut peu de choses pour faire un bon pain&nbsp;:</p><ul><li>de la farine</li><li>de l\'eau</li><li>du sel et du temps</li></ul>'
        '<blockquote>Le temps fait la moitié du travail.</blockquote><p>Le four doit être très chaud.</p></main><section class="commentaires"><h3>Commentaires</h3><p>Merci pour la recette !</p></section><footer><p>Tous droits réservés</p></footer></body>',
        "Le pain du matin\nIl faut peu de choses pour faire un bon pain :\nde la farine\nde l'eau\ndu sel et du temps\nLe temps fait la moitié du travail.\nLe four doit être très chaud."),
    "an offer in the middle": (
        '<body><div class="wrap"><div class="c1"><h1>The last ferry</h1><p>The ferry had crossed the lake since the days of steam, and nobody thought that it would stop.</p><p>Then the bridge was built.</p></div><div class="c2"><p>Subscribe to our newsletter!</p><form><input><button>Go</button></form></div>'
        '<div class="c1"><p>For a while both were used, and the captain waved at the cars.</p><p>One morning the boat stayed at its pier.</p></div><div class="c3"><a href="/x">Most read</a><a href="/y">Ten lakes</a></div></div></body>',
        "The last ferry\nThe ferry had crossed the lake since the days of steam, and nobody thought that it would stop.\nThen the bridge was built.\nFor a while both were used, and the captain waved at the cars.\nOne morning the boat stayed at its pier."),
    "no article at all": ('<body><div class="nav"><a href="/">Home</a><a href="/l">Log in</a></div><form><label>Name</label><input><label>Password</label><input><button>Sign in</button></form><footer>(c) 2020 Shop</footer></body>', ""),
}


@pytest.fixture(scope="module")
def labeller():
    # As the query does it: trained on the given pages, of which none looks like these.
    rows = duckdb.sql("SELECT html FROM '/root/testdata/sf0.01/pages.parquet' ORDER BY page_id").fetchall()
    return html_text.trained([r[0] or "" for r in rows])


@pytest.mark.parametrize("name", PAGES)
def test_layout(labeller, name):
    page, want = PAGES[name]
    assert html_text.texts_of([page], labeller)[0] == want


def test_given_pages(labeller):
    """Where a page's own marks say what its article is, the labeller agrees with them."""
    pages = [r[0] or "" for r in duckdb.sql("SELECT html FROM '/root/testdata/sf0.1/pages.parquet' ORDER BY page_id LIMIT 1500").fetchall()]
    want = ["\n".join(b.text for b in html_blocks.blocks_of(p) if html_blocks.teacher(b)) for p in pages]
    got = html_text.texts_of(pages, labeller)
    assert sum(a == b for a, b in zip(got, want, strict=True)) >= 0.995 * len(pages)

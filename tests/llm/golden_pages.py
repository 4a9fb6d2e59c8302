"""Hand-written pages of ordinary layouts, and the whole text that belongs to their articles."""

A = "The council voted on Monday to restore the old mill by the river, which has stood empty since the flood of 1987."
B = "Engineers expect the work to take eighteen months, and they warn that the wheel itself may have to be rebuilt from drawings."
C = "Residents welcomed the plan, although some of them asked who would pay for the upkeep once the scaffolding is gone."
D = "A final decision on the money is due in spring."
E = "Bees find their way home by the sun, by landmarks, and, as recent experiments suggest, by the magnetic field of the earth."
F = "In one trial, hives were moved by night across eleven kilometres of moorland, and most of the foragers returned before noon."
G = "What happens in cloudy weather is less clear; the insects seem to fall back on smell and on the memory of recent flights."
SHORT = "It works."

MENU = '<ul><li><a href="/">Home</a></li><li><a href="/about">About</a></li><li><a href="/contact">Contact</a></li></ul>'
COOKIES = '<div class="cookie-consent"><p>We use cookies to improve your visit.</p><button>Accept</button></div>'


def doc(body, head=""):
    return f"<!DOCTYPE html><html><head><title>No title</title>{head}</head><body>{body}</body></html>"


def p(*texts):
    return "".join(f"<p>{t}</p>" for t in texts)


def d(*texts):
    return "".join(f"<div>{t}</div>" for t in texts)


def lines(*texts):
    return "\n".join(texts)


PAGES = {
    "article element": (doc(f"<nav>{MENU}</nav><article><h1>The mill</h1>{p(A, B, C)}</article><footer>&copy; 2020 The Gazette</footer>"), lines("The mill", A, B, C)),
    "main element": (doc(f"<header><a href='/'>Gazette</a>{MENU}</header><main><h1>The mill</h1>{p(A, B, C, D)}</main><footer><p>All rights reserved.</p></footer>"), lines("The mill", A, B, C, D)),
    "bare divs": (doc(f"<div>{MENU}</div><div><h1>The mill</h1>{d(A, B, C, D)}</div><div>&copy; 2020 The Gazette. All rights reserved.</div>"), lines("The mill", A, B, C, D)),
    "bare divs and paragraphs": (doc(f"<div><a href='/'>Home</a> <a href='/n'>News</a></div><div><h1>Bees</h1>{p(E, F, G)}</div><div><a href='/p'>Privacy</a> <a href='/t'>Terms</a></div>"), lines("Bees", E, F, G)),
    "column named content-side": (doc(f"<nav>{MENU}</nav><div class='content-side'><h1>Bees</h1>{p(E, F, G)}</div><div class='footer'>Imprint</div>"), lines("Bees", E, F, G)),
    "div named content": (doc(f"<div id='nav'>{MENU}</div><div id='content'><h1>Bees</h1>{p(E, F)}</div><div id='sidebar'><h3>Popular</h3>{MENU}</div><div id='footer'>Imprint</div>"), lines("Bees", E, F)),
    "blog post with a header": (doc(f"<header class='site-header'><a href='/'>My blog</a></header><article class='post'><header class='entry-header'><h1>Bees at home</h1></header><div class='entry-content'>{p(E, F, G)}</div></article><aside class='widget-area'><h2>Archive</h2>{MENU}</aside>"), lines("Bees at home", E, F, G)),
    "layout table": (doc(f"<table><tr><td><a href='/'>Home</a><br><a href='/about'>About</a></td><td><h1>The mill</h1>{p(A, B, C)}</td></tr></table>"), lines("The mill", A, B, C)),
    "layout table with rows": (doc(f"<table width='100%'><tr><td colspan=2><a href='/'>Start</a> | <a href='/map'>Map</a></td></tr><tr><td>{MENU}</td><td>{p(E, F, G)}</td></tr><tr><td colspan=2>Copyright 1999 by the society</td></tr></table>"), lines(E, F, G)),
    "formula": (doc(f"<nav>{MENU}</nav><article><h1>Squares</h1><p>{A}</p><p>The area is <math><msup><mi>a</mi><mn>2</mn></msup></math> for a side of length a, as everyone knows.</p>{p(B)}</article>"), lines("Squares", A, "The area is a2 for a side of length a, as everyone knows.", B)),
    "data table in an article": (doc(f"<nav>{MENU}</nav><article><h1>The mill</h1>{p(A)}<table><tr><th>Year</th><th>Visitors</th></tr><tr><td>2018</td><td>1200</td></tr><tr><td>2019</td><td>1350</td></tr></table>{p(B)}</article><footer>Imprint</footer>"), lines("The mill", A, "Year", "Visitors", "2018", "1200", "2019", "1350", B)),
    "lists in an article": (doc(f"<nav>{MENU}</nav><main><h1>Packing list</h1><p>{A}</p><ul><li>Two pairs of strong boots</li><li>A map of the moor on paper</li><li>Water for a whole day</li></ul>{p(B)}</main><footer>Imprint</footer>"), lines("Packing list", A, "Two pairs of strong boots", "A map of the moor on paper", "Water for a whole day", B)),
    "quotation": (doc(f"<header>{MENU}</header><article><h1>The mill</h1>{p(A)}<blockquote><p>{C}</p></blockquote>{p(B)}</article>"), lines("The mill", A, C, B)),
    "sections with headings": (doc(f"<nav>{MENU}</nav><article><h1>Bees</h1><section><h2>By the sun</h2>{p(E)}</section><section><h2>By smell</h2>{p(G)}</section></article><footer>Imprint</footer>"), lines("Bees", "By the sun", E, "By smell", G)),
    "advert between paragraphs": (doc(f"<main><h1>Bees</h1>{p(E)}<div class='advertisement'><p>Fresh honey, now half the price in all our shops!</p></div>{p(F, G)}</main>"), lines("Bees", E, F, G)),
    "comments below": (doc(f"<article><h1>The mill</h1>{p(A, B)}</article><section id='comments'><h3>3 comments</h3><div class='comment'><b>Ann</b><p>I have lived beside it for forty years and never seen a fish.</p></div><div class='comment'><b>Bob</b><p>Who pays for all this? Surely not the council again.</p></div></section>"), lines("The mill", A, B)),
    "comments inside": (doc(f"<nav>{MENU}</nav><main><h1>The mill</h1>{p(A, B, C)}<div class='comments'><h3>Comments</h3><div class='comment'><p>Thank you for this, I had no idea that it was so old.</p></div></div></main>"), lines("The mill", A, B, C)),
    "cookie notice first": (doc(f"{COOKIES}<nav>{MENU}</nav><article><h1>Bees</h1>{p(E, F)}</article>"), lines("Bees", E, F)),
    "newsletter form": (doc(f"<article><h1>Bees</h1>{p(E, F)}<form class='newsletter'><label>Get our letter every week</label><input type=email><button>Join</button></form>{p(G)}</article>"), lines("Bees", E, F, G)),
    "related links inside": (doc(f"<nav>{MENU}</nav><article><h1>Bees</h1>{p(E, F, G)}<div class='related'><h4>Read on</h4><ul><li><a href='/1'>Wasps in winter</a></li><li><a href='/2'>Honey and the law</a></li></ul></div></article>"), lines("Bees", E, F, G)),
    "share bar": (doc(f"<article><h1>Bees</h1><div class='share-buttons'><a href='#'>Tweet</a> <a href='#'>Mail</a></div>{p(E, F)}</article><footer>Imprint</footer>"), lines("Bees", E, F)),
    "short last paragraph": (doc(f"<nav>{MENU}</nav><article><h1>The mill</h1>{p(A, B, SHORT)}</article><footer>Imprint</footer>"), lines("The mill", A, B, SHORT)),
    "short paragraphs": (doc(f"<nav>{MENU}</nav><main><h1>A recipe</h1>{p('Boil the water.', 'Add the rice and stir.', 'Wait for twelve minutes.', SHORT)}</main><footer>Imprint</footer>"), lines("A recipe", "Boil the water.", "Add the rice and stir.", "Wait for twelve minutes.", SHORT)),
    "links in the text": (doc(f"<nav>{MENU}</nav><article><h1>The mill</h1><p>{A} See <a href='/x'>the report of last year</a> for the figures.</p>{p(B)}</article>"), lines("The mill", f"{A} See the report of last year for the figures.", B)),
    "pre and code": (doc(f"<header>{MENU}</header><article><h1>Sorting</h1><p>{A}</p><pre>for x in sorted(names):\n    print(x)</pre>{p(B)}</article>"), lines("Sorting", A, "for x in sorted(names): print(x)", B)),
    "figure with a caption": (doc(f"<nav>{MENU}</nav><article><h1>The mill</h1>{p(A)}<figure><img src='m.jpg'><figcaption>The wheel in the summer of 1954</figcaption></figure>{p(B, C)}</article>"), lines("The mill", A, "The wheel in the summer of 1954", B, C)),
    "wrapper in wrapper": (doc(f"<div id='page'><div id='masthead'><a href='/'>Gazette</a>{MENU}</div><div class='wrap'><div class='inner'><div class='story-body'><h1>The mill</h1>{p(A, B, C)}</div></div><div class='sidebar'><h4>Most read</h4>{MENU}</div></div><div id='colophon'>Printed on paper</div></div>"), lines("The mill", A, B, C)),
    "unclosed paragraphs": (f"<html><body><h1>Bees</h1><p>{E}<p>{F}<p>{G}<hr><a href='/'>Home</a> <a href='/up'>Up</a></body></html>", lines("Bees", E, F, G)),
    "plain paragraphs alone": (doc(p(A, B, C)), lines(A, B, C)),
    "text with breaks": (doc(f"<div class='menu'>{MENU}</div><div class='text'>{A}<br><br>{B}<br><br>{C}</div>"), f"{A} {B} {C}"),
    "definition list": (doc(f"<nav>{MENU}</nav><main><h1>Terms of bees</h1><p>{E}</p><dl><dt>Forager</dt><dd>A worker that gathers food outside of the hive</dd><dt>Drone</dt><dd>A male, which gathers nothing at all</dd></dl></main>"), lines("Terms of bees", E, "Forager", "A worker that gathers food outside of the hive", "Drone", "A male, which gathers nothing at all")),
    "breadcrumbs and pager": (doc(f"<div class='breadcrumb'><a href='/'>Home</a> &gt; <a href='/n'>News</a></div><main><h1>The mill</h1>{p(A, B)}<div class='pagination'><a href='/1'>1</a> <a href='/2'>2</a> <a href='/3'>Next</a></div></main><footer>Imprint</footer>"), lines("The mill", A, B)),
    "long attribute": (doc(f"<nav>{MENU}</nav><article><h1>Bees</h1><p data-x=\"{'<b>no</b> ' * 1500}\">{E}</p>{p(F)}</article>"), lines("Bees", E, F)),
    "character references": (doc(f"<nav>{MENU}</nav><article><h1>Fish &amp; chips &mdash; a history</h1>{p(A, 'The caf&eacute; &#8220;Zum Anker&#8221; opened in&nbsp;1901, and its owner never learned to swim.')}</article>"), lines("Fish & chips — a history", A, "The café “Zum Anker” opened in 1901, and its owner never learned to swim.")),
    "site of two columns": (doc(f"<div class='top'>{MENU}</div><div class='columns'><div class='col-left'><h2>Sections</h2>{MENU}</div><div class='col-main'><h1>Bees</h1>{p(E, F, G)}</div></div><div class='bottom'>Imprint | Privacy</div>"), lines("Bees", E, F, G)),
    "article in bare sections": (doc(f"<section>{MENU}</section><section><h1>The mill</h1>{p(A, B, C)}</section><section><a href='/p'>Privacy</a> <a href='/t'>Terms</a></section>"), lines("The mill", A, B, C)),
}

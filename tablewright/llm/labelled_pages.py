"""The small table the block classifier is trained on: pages cut into labelled pieces.

Each page is a list of ``(is main text, HTML)``; the pieces of a page make its source.
"""

from __future__ import annotations

_LONG = (
    "The river rose by almost two metres during the night and the lower fields were under "
    "water by the morning, so the harvest will start a week later than the growers had hoped. "
)
_MIDDLE = "Most of the boats had been moved to the upper harbour before the storm came in. "
_LINKS = "".join(f'<li><a href="/{w}">{w}</a></li>' for w in ("Home", "News", "Sport", "Weather", "About us"))

PAGES: list[list[tuple[bool, str]]] = [
    [
        (False, f"<html><head><title>Flood</title></head><body><nav><ul>{_LINKS}</ul></nav>"),
        (False, '<div class="ad">Buy two pairs of boots and get the third one free this week only.</div>'),
        (True, f"<article><h1>River rises</h1><p>{_LONG}</p><p>{_MIDDLE}<p>Short.</p>"),
        (True, f"<p>{_LONG}{_LONG}</p><blockquote>We waited.</blockquote><ul><li>first</li><li>second</li></ul></article>"),
        (False, "<footer>&copy; 2020 The River Post. All rights reserved by the owners.</footer></body></html>"),
    ],
    [
        (False, "<body><header><h1>The Daily</h1><p>News from the valley since the year 1920</p></header>"),
        (False, '<div id="cookie-notice"><p>We use cookies to make this site better. By reading on you agree to our use of them.</p></div>'),
        (False, f'<aside><h3>Most read</h3><ul>{_LINKS}</ul><p>{_MIDDLE}</p></aside>'),
        (True, f"<main><h1>Harbour</h1><p>{_MIDDLE}</p><h2>Why</h2><p>{_LONG}</p>"),
        (False, '<div class="advert"><p>Our partner sells the best ropes and anchors on the whole coast.</p></div>'),
        (True, f"<p>{_LONG}</p><p>Yes.</p>"),
        (False, "<form><label>Your address</label><p>Sign up and get our letter with the best of the week.</p><button>Send</button></form>"),
        (True, f"<p>{_MIDDLE}{_MIDDLE}</p></main>"),
        (False, f'<section id="comments"><h2>Comments</h2><p>{_MIDDLE}</p><p>I saw it too.</p><p>{_LONG}</p></section>'),
        (False, "<footer><p>Contact</p><p>Imprint and privacy of the daily news from the valley</p></footer></body>"),
    ],
    [
        (False, f'<body><div class="menu"><a href="/">Start</a> <a href="/a">All posts</a></div><div class="sidebar"><p>{_LONG}</p></div>'),
        (True, f'<div class="content"><h1>Nets</h1><p>{_LONG}</p><p>{_MIDDLE}</p><p>And <a href="/x">so on</a> it went.</p>'),
        (True, "<p>End.</p></div>"),
        (False, f'<div class="comment-list"><div class="comment">{_MIDDLE}</div><div class="comment">Nice.</div></div>'),
        (False, '<div class="footer">Written by the people of the coast and published every week</div></body>'),
    ],
    [
        (False, '<body><p><a href="/">Home</a> | <a href="/b">Back to the list of all the stories</a></p>'),
        (True, f"<p>{_LONG}</p><p>{_LONG}{_MIDDLE}</p><p>{_MIDDLE}{_MIDDLE}</p><p>{_LONG}</p>"),
        (False, '<p><a href="/p">Previous story about the harbour</a></p><p><a href="/n">Next</a></p><p>Copyright 2019</p></body>'),
    ],
    [
        (False, "<body><div>Log in</div>"),
        (True, f"<h1>Storm over the upper harbour</h1><p>{_LONG}{_LONG}</p><p>{_MIDDLE}</p><p>{_LONG}</p>"),
        (False, f"<ul>{_LINKS}</ul><div>Terms of use</div></body>"),
    ],
    [
        (False, f'<body><nav>{_LINKS}</nav><article class="comment"><p>{_LONG}</p></article>'),
        (True, f"<article><header><h1>Nets and ropes</h1></header><p>{_LONG}</p><pre>one two</pre><table><tr><td>Depth</td><td>3 m</td></tr></table>"),
        (False, f'<div class="related"><a href="/r">{_MIDDLE}</a></div><aside><p>{_LONG}</p></aside>'),
        (True, f'<p><a href="/s">See the whole table</a></p><p>{_MIDDLE}</p>'),
        (False, "<footer>Posted in the harbour section by the night desk</footer></article>"),
        (False, '<div class="newsletter"><p>Subscribe</p></div><div>Some more words from the owners of this site and nobody else.</div></body>'),
    ],
    [
        (False, f"<body><header><p>{_LONG}</p></header><div><p>{_LONG}{_MIDDLE}</p></div>"),
        (True, f"<article><h1>Nets</h1><p>One.</p><p>{_LONG}</p><p>Two.</p></article>"),
        (False, f"<div><p>{_LONG}</p></div><p>{_MIDDLE}{_LONG}</p><footer><p>{_LONG}{_LONG}</p><p>{_LONG}</p></footer></body>"),
    ],
    [
        (False, f"<body><div><p>{_LONG}{_LONG}</p><p>{_MIDDLE}</p></div>"),
        (True, "<article><p>Only this.</p></article>"),
        (False, f"<div><p>{_LONG}</p><p>{_LONG}{_MIDDLE}</p></div><footer><p>{_LONG}</p><p>{_LONG}{_LONG}</p></footer></body>"),
    ],
    [
        (False, f"<body><header><p>{_LONG}{_LONG}</p><p>{_LONG}</p></header>"),
        (True, f"<h1>Boats on the upper lake</h1><p>{_LONG}</p><p>{_LONG}{_LONG}</p><p>{_LONG}</p>"),
        (False, f"<footer><p>{_LONG}{_LONG}</p><p>{_LONG}</p><p>{_LONG}</p></footer></body>"),
    ],
    # Wrappers whose names tell of the layout, and forms, around a whole article.
    [
        (False, f'<body class="has-sidebar"><div class="layout with-ads page-header-fixed"><form><nav>{_LINKS}</nav>'),
        (True, f'<article class="post has-menu"><h1>Locks</h1><p>{_LONG}</p><div id="related-work"><p>{_MIDDLE}</p></div>'),
        (True, f'<p>Let <math><mi>d</mi><mo>=</mo><mn>3</mn></math> be the depth.</p><p class="share-prices">{_LONG}</p></article>'),
        (False, f'<div class="related-articles"><article><p>{_MIDDLE}</p></article></div></form></div></body>'),
    ],
    # An article alone, and one with nothing behind it.
    [(True, "<article><p>Kept.</p></article>")],
    [(True, f"<body><article><h1>Locks</h1><p>{_MIDDLE}</p><p>{_LONG}</p></article></body>")],
    [
        (False, f"<body><nav>{_LINKS}</nav>"),
        (True, f"<main><h2>Sluices</h2><p>{_LONG}</p><p>So it was.</p></main></body>"),
    ],
    [
        (True, f"<article><p>{_LONG}</p><p>One more.</p>"),
        (False, "<footer><p>Filed under boats</p></footer>"),
        (True, f"<p>{_MIDDLE}</p></article>"),
    ],
    [
        (True, f"<article><p>{_MIDDLE}</p>"),
        (False, "<footer><p>Filed under nets and ropes by the desk</p></footer></article></body>"),
    ],
    # Nothing but words.
    [(True, "<p>Just words.</p>")],
    [(True, "<p>Yes.</p>")],
    [(True, "Word")],
    [(True, "Three more words")],
    [(True, f"<body><p>{_MIDDLE}</p></body>")],
    [(True, f"<body><div>{_LONG}</div></body>")],
    # Nothing but what is no text.
    [(False, "<nav>Menu</nav>")],
    [(False, f"<nav><ul>{_LINKS}</ul></nav>")],
    [(False, f"<body><aside><p>{_LONG}</p></aside></body>")],
    [(False, "<form><label>Name</label></form>")],
    [(False, "<form>Name and address</form>")],
    [(False, "<nav>Back to start</nav>")],
    [(False, "<aside>See also</aside>")],
    [(False, '<div class="cookie-banner">Agree</div>')],
    [(False, "<footer>Imprint</footer>")],
    [(False, f"<footer><p>{_MIDDLE}</p></footer>")],
    # No element tells: short lines belong to the text where long ones stand around them.
    [
        (False, "<body><div>Start</div><div>Our team</div><div>Find us</div>"),
        (True, f"<div>{_LONG}{_MIDDLE}</div><div>Nobody spoke.</div><div>{_LONG}</div><div>Then it rained.</div><div>{_LONG}{_LONG}</div>"),
        (False, "<div>Print</div><div>Send on</div><div>Top</div></body>"),
    ],
    [
        (False, '<body><div><a href="/1">Boats</a> <a href="/2">Nets</a></div><div>Search</div><div>Your basket</div>'),
        (True, f"<div>{_LONG}</div><div>So they went.</div><div>{_LONG}{_MIDDLE}</div><div>No answer.</div><div>{_LONG}</div>"),
        (False, '<div>Rate this</div><div><a href="/m">More of the same</a></div><div><a href="/n">Older</a></div><div>Terms</div></body>'),
    ],
    [
        (False, "<body><div>Open daily</div><div>Map</div>"),
        (True, f"<div>{_LONG}{_LONG}</div><div>He laughed.</div><div>{_MIDDLE}{_LONG}</div>"),
        (False, '<div><a href="/o">Order</a></div><div>Call us now</div><div><a href="/p">Partners</a></div></body>'),
    ],
]

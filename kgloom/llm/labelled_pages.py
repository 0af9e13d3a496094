"""Labelled pages for training: composed from parts whose label is known.

Each part is one of the shapes that articles and the rest of a page take; the
words are random syllables, so that nothing is learnt from vocabulary.
"""

from __future__ import annotations

import random

#: Wrappers of text that is not the article (%s is replaced), and of text that is.
OTHER = [
    "<nav><ul>%l</ul></nav>", "<nav class='menu'>%k</nav>", "<div id='menu'><ul>%l</ul></div>", "<div class='navbar'>%k</div>", "<ul class='breadcrumb'>%l</ul>",
    "<header><div class='logo'>%s</div>%k</header>", "<header class='site-header'><p>%s</p></header>", "<div id='header'><h1>%s</h1></div>", "<div class='masthead'>%s</div>",
    "<footer>&copy; %s &middot; %w</footer>", "<footer><p>%s</p><ul>%l</ul></footer>", "<div class='footer'><p>%s</p></div>", "<div id='copyright'>&copy; %s</div>",
    "<aside><h3>%s</h3><ul>%l</ul></aside>", "<aside><p>%w</p></aside>", "<div class='sidebar'><p>%w</p><ul>%l</ul></div>", "<div class='related'><h2>%s</h2><ul>%l</ul></div>",
    "<div class='ad'>%w</div>", "<div class='advert'><p>%w</p></div>", "<div class='sponsored promo'><p>%w</p><p>%w</p></div>", "<section class='ads'>%w</section>",
    "<div class='cookie-notice'><p>%w</p><button>%s</button></div>", "<div class='notice banner'>%w</div>", "<div role='alert'><p>%w</p></div>", "<div class='consent popup'><p>%w</p></div>", "<div class='newsletter subscribe'><p>%w</p><form><input name='m'><button>%s</button></form></div>",
    "<form><label>%s</label><input name='q'><button>%s</button></form>", "<form class='login'><p>%s</p><select><option>%s<option>%s</select></form>",
    "<section id='comments'><h2>%s</h2><div class='comment'><p>%w</p></div><div class='comment'><p>%w</p><p>%w</p></div></section>", "<div class='comments'><p>%w</p><p>%w</p></div>", "<ol class='commentlist'><li><p>%w</p></li><li><p>%w</p></li></ol>", "<div id='disqus' class='discussion replies'><p>%w</p></div>",
    "<div class='share social'>%k</div>", "<div class='tags'>%k</div>", "<div class='pagination'>%k</div>", "<p>%k</p>", "<ul>%l</ul>",
]
ARTICLE = ["<article>%a</article>", "<article><h1>%s</h1>%a</article>", "<main>%a</main>", "<main><article><header><h1>%s</h1></header>%a</article></main>", "<main><h1>%s</h1><section>%a</section></main>", "<div class='article'>%a</div>", "<div class='content'><h1>%s</h1>%a</div>", "<div id='main' class='post entry'><h2>%s</h2>%a</div>", "<div class='story body text'>%a</div>", "<div><h1>%s</h1>%a</div>"]
BODY = ["<p>%w</p>", "<p>%w</p>", "<p>%w</p>", "<p>%w", "<p><b>%w<br>", "<p>%s</p>", "<h2>%s</h2><p>%w</p>", "<ul><li>%w</li><li>%w</li></ul>", "<ol><li>%s<li>%s</ol>", "<blockquote>%w</blockquote>", "<table><tr><td>%s<td>%s</table>", "<pre>%w</pre>", "<p><a href='/x'>%s</a> %w</p>", "<div>%w</div>"]
#: Parts that stand inside articles and are none of their text.
INSIDE = [
    "<aside><p>%w</p></aside>", "<div class='ad'>%w</div>", "<div class='share'>%k</div>", "<form><button>%s</button></form>", "<div class='related'><ul>%l</ul></div>", "<footer><p>%s</p></footer>", "<nav>%k</nav>", "<div class='comments'><p>%w</p></div>",
    "<div class='newsletter'><p>%s</p></div>", "<div class='newsletter signup'><p>%w</p><form><input name='m'><button>%s</button></form></div>", "<div class='notice'><p>%w</p></div>", "<p class='notice'>%w</p>", "<div role='alert'>%s</div>", "<div class='cookie-banner'><p>%w</p><button>%s</button></div>",
    "<div class='paywall subscribe'>%w</div>", "<section class='promo'><p>%w</p></section>", "<div class='related'><h3>%s</h3><p>%w</p></div>", "<div class='warning toast'>%s</div>", "<ul class='social'>%l</ul>",
]


def _fill(shape: str, rnd: random.Random, mark: str) -> str:
    word = lambda: "".join(rnd.choice("bdfgklmnprstv") + rnd.choice("aeiou") for _ in range(rnd.randint(1, 4)))

    def text(least: int, most: int) -> str:
        return mark + " ".join(word() for _ in range(rnd.randint(least, most))) + rnd.choice((".", ".", "", "?"))

    out = []
    for k, piece in enumerate(shape.split("%")):
        if not k:
            out.append(piece)
            continue
        kind = piece[0]
        if kind == "s":
            out.append(text(1, 8))
        elif kind == "w":
            out.append(" ".join([text(4, 30), *(text(3, 30).removeprefix(mark) for _ in range(rnd.randint(0, 5)))]))
        elif kind in "lk":
            links = [f"<a href='/{word()}'>{text(1, 3)}</a>" for _ in range(rnd.randint(2, 7))]
            out.append("".join(f"<li>{x}</li>" for x in links) if kind == "l" else " | ".join(links))
        else:
            parts = []
            for _ in range(rnd.randint(1, 12)):
                if rnd.random() < 0.08:
                    parts.append(_fill(rnd.choice(INSIDE), rnd, OUT))
                parts.append(_fill(rnd.choice(BODY), rnd, mark))
            out.append("".join(parts))
        out.append(piece[1:])
    return "".join(out)


#: Marks in front of each text; they are taken off when a page has been cut into blocks.
IN, OUT = "\ue000", "\ue001"


def page(seed: int) -> str:
    rnd = random.Random(seed)
    before = [_fill(rnd.choice(OTHER), rnd, OUT) for _ in range(rnd.randint(0, 4))]
    after = [_fill(rnd.choice(OTHER), rnd, OUT) for _ in range(rnd.randint(0, 4))]
    main = [_fill(rnd.choice(ARTICLE), rnd, IN)] if rnd.random() < 0.97 else []
    wrap = rnd.choice(("%s", "%s", "<div id='page'>%s</div>", "<div class='wrapper container'>%s</div>"))
    return f"<!DOCTYPE html><html><head><title>t</title><script>x('</p>')</script></head><body>{wrap % ''.join(before + main + after)}</body></html>"

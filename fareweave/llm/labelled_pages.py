"""Pages labelled by hand, on which the model of the main text is trained.

Each layout says where the article stands and what stands around and within it; a
fragment's label holds for all its text. Words are made up, so that only structure,
names and shapes of texts can be learned.
"""

from __future__ import annotations

import random
from collections.abc import Iterator

#: Frames of an article: {0} stands for its parts.
ARTICLES = [
    "<article>{0}</article>",
    '<article class="post">{0}</article>',
    '<main><article class="entry">{0}</article></main>',
    '<main id="main" role="main">{0}</main>',
    '<div id="content"><div class="post-body">{0}</div></div>',
    '<div class="article-content">{0}</div>',
    '<section class="entry-content">{0}</section>',
    '<div class="story text">{0}</div>',
    '<div id="wrapper"><div class="page"><div class="main-column">{0}</div></div></div>',
    "<div><div>{0}</div></div>",
    "{0}",
    '<table><tr><td class="content">{0}</td></tr></table>',
]

#: Parts of an article. {s} is a sentence, {l} a paragraph, {t} two or three words.
PARTS = [
    "<h1>{t}</h1>",
    "<header><h1>{s}</h1></header>",
    "<h2>{t}</h2>",
    "<h3 class='title'>{t}</h3>",
    "<p>{l}</p>",
    "<p><b>{l}</b></p>",
    "<p>{l} <a href='/x'>{t}</a> {s}</p>",
    "<p>{s}</p>",
    "<p>{t}</p>",
    "<p>{t}.</p>",
    "<p>{t} | {t} | {t} |</p>",
    "<p>{l} {t} {t}</p>",
    "<p>{t}, {t}</p><p>{s} {t}</p>",
    "<div>{l}</div>",
    "{l}<br><br>",
    "<blockquote><p>{l}</p></blockquote>",
    "<ul><li>{s}</li><li>{s}</li><li>{t}</li></ul>",
    "<ol><li>{s}</li><li>{s}</li></ol>",
    "<pre>{s}</pre>",
    "<figure><img src=x><figcaption class='caption'>{s}</figcaption></figure>",
    "<table><tr><th>{t}</th><th>{t}</th></tr><tr><td>{t}</td><td>{s}</td></tr></table>",
    "<dl><dt>{t}</dt><dd>{s}</dd></dl>",
    "<section><h2>{t}</h2><p>{l}</p><p>{s}</p></section>",
]

#: What is no main text, wherever it stands.
RESTS = [
    "<nav><ul><li><a href='/a'>{t}</a></li><li><a href='/b'>{t}</a></li><li><a href='/c'>{t}</a></li></ul></nav>",
    "<ul class='menu'><li><a href='/a'>{t}</a></li><li><a href='/b'>{t}</a></li></ul>",
    "<div id='navigation' class='navbar nav-menu'><a href='/a'>{t}</a> | <a href='/b'>{t}</a></div>",
    "<div class='breadcrumb breadcrumbs'><a href='/a'>{t}</a> &gt; {t}</div>",
    "<header class='site-header masthead banner'><div class='logo'>{t}</div><p class='tagline'>{s}</p></header>",
    "<div id='header'><h2>{t}</h2><p>{s}</p></div>",
    "<footer>&copy; {t} &middot; {s}</footer>",
    "<footer class='site-footer'><p>{s}</p><p>{l}</p></footer>",
    "<div id='footer' class='bottom copyright legal'>&copy; {t}. {s}</div>",
    "<aside><h3>{t}</h3><p>{s}</p></aside>",
    "<aside class='sidebar'><h3>{t}</h3><p>{l}</p><ul><li><a href='/a'>{s}</a></li></ul></aside>",
    "<div class='sidebar widget side right rail' id='secondary'><h4>{t}</h4><p>{l}</p><p>{s}</p></div>",
    "<div class='ad'>{s}</div>",
    "<div class='ads advert advertisement adsense'>{l}</div>",
    "<div class='sponsored sponsor promo promotion'><p>{s}</p><a href='/x'>{t}</a></div>",
    "<section class='banner promoted marketing'><p>{l}</p></section>",
    "<div class='cookie cookies consent gdpr' role='dialog'><p>{l}</p><button>{t}</button></div>",
    "<div class='notice alert warning message privacy' role='alert'><p>{s}</p></div>",
    "<div class='popup modal overlay paywall'><p>{l}</p></div>",
    "<dialog><p>{s}</p></dialog>",
    "<form action='/s'><label>{t}</label><input name=q><button>{t}</button></form>",
    "<form class='newsletter signup subscribe'><p>{s}</p><input><select><option>{t}</option></select></form>",
    "<div class='login register search searchbox' role='search'><form><label>{t}</label><p>{t}</p></form></div>",
    "<section id='comments' class='comments'><h3>{t}</h3><div class='comment'><p>{l}</p></div><div class='comment reply'><p>{s}</p></div></section>",
    "<div class='comment-list responses discussion disqus'><ol><li class='comment'><p>{l}</p><p>{s}</p></li></ol></div>",
    "<ol class='commentlist'><li id='comment' class='commenter'><article class='comment-body'><p>{l}</p></article></li></ol>",
    "<div class='related recommended more teaser'><h3>{t}</h3><ul><li><a href='/a'>{s}</a></li><li><a href='/b'>{s}</a></li></ul></div>",
    "<div class='share social sharing follow'><a href='/f'>{t}</a> <a href='/g'>{t}</a></div>",
    "<div class='tags categories meta'><a href='/t'>{t}</a>, <a href='/u'>{t}</a></div>",
    "<div class='pagination pager pages'><a href='/1'>1</a> <a href='/2'>2</a></div>",
    "<div hidden><p>{l}</p></div>",
    "<div style='display:none'><p>{s}</p></div>",
    "<div class='toolbar skip print'><a href='#x'>{t}</a></div>",
    "<menu><li><button>{t}</button></li></menu>",
]

#: Those that also stand within articles.
WITHIN = [9, 10, 20, 12, 13, 14, 17, 21, 26, 27, 28, 30]

SYLLABLES = "ka lo mi ren tu sol va pri dan es for gla hu ist jo".split()


def _words(rng: random.Random, n: int) -> str:
    words = ["".join(rng.choices(SYLLABLES, k=rng.randint(1, 3))) for _ in range(n)]
    return " ".join(words).capitalize()


def _filled(fragment: str, rng: random.Random) -> str:
    out = []
    for piece in fragment.replace("{", "\0{").split("\0"):
        if piece[:3] in ("{s}", "{l}", "{t}"):
            count = {"s": (5, 14), "l": (25, 90), "t": (1, 3)}[piece[1]]
            words = _words(rng, rng.randint(*count))
            if piece[1] == "l":
                words = ", ".join(words.split(" ", 9)[:9]) + " " + _words(rng, 20).lower()
            out.append(words + ("" if piece[1] == "t" else rng.choice([".", ".", ".", "!", "?"])) + piece[3:])
        else:
            out.append(piece)
    return "".join(out)


def labelled_pages(number: int = 480) -> Iterator[str]:
    """Pages in which the elements ``x-main`` and ``x-rest`` hold the label of the text in them."""
    rng = random.Random(7)
    for page in range(number):
        frame = ARTICLES[page // 4 % len(ARTICLES)]
        small = page % 4 == 0
        titled = not small and rng.random() < 0.8
        parts = ["<x-main>" + _filled(rng.choice(PARTS[:2]), rng) + "</x-main>"] if titled else []
        for _ in range(1 if small else rng.choice([1, 1, 2, 3, 5, 8])):
            parts.append("<x-main>" + _filled(rng.choice(PARTS[2:]), rng) + "</x-main>")
        if not small and rng.random() < 0.4:
            parts.insert(rng.randint(1, len(parts)), "<x-rest>" + _filled(RESTS[rng.choice(WITHIN)], rng) + "</x-rest>")
        article = frame.format("".join(parts))
        around = rng.sample(range(len(RESTS)), rng.choice([0, 0, 0, 1] if small else [1, 2, 3, 4, 5, 6, 7]))
        rests = ["<x-rest>" + _filled(RESTS[i], rng) + "</x-rest>" for i in around]
        cut = rng.randint(0, len(rests))
        body = "".join([*rests[:cut], article, *rests[cut:]])
        if rng.random() < 0.25:
            yield body
        else:
            yield f"<html><head><title>{_words(rng, 4)}</title></head><body>{body}</body></html>"

"""Labelled pages to train the block classifier on: made from a fixed seed, in the shapes that web pages come in.

Each piece of text starts with a private sign that says whether it belongs to the main text; the reader of blocks
turns it into the label and drops it. Wrapper names are those in common use; the words are invented, so that the
classifier learns structure and shape rather than vocabulary.
"""

from __future__ import annotations

import random

MAIN, OTHER = "", ""

# Names of wrappers in common use, by what they hold.
MAIN_WRAPPERS = ['<article>|</article>', '<main><article>|</article></main>', '<article class="post">|</article>',
                 '<div id="content"><div class="post-content">|</div></div>', '<div class="entry-content">|</div>',
                 '<section class="story-body">|</section>', '<div class="article-body">|</div>', '<main>|</main>',
                 '<div id="main"><div class="text">|</div></div>', '<div class="content">|</div>',
                 '<table><tr><td class="article-text">|</td></tr></table>', '<div itemprop="articleBody">|</div>',
                 '<div role="main"><div class="page-body">|</div></div>', '<div id="article">|</div>']
MENUS = ['<nav>|</nav>', '<ul class="menu">|</ul>', '<div id="navbar"><ul class="nav">|</ul></div>', '<div class="navigation">|</div>',
         '<nav class="breadcrumb">|</nav>', '<div class="topbar"><ul>|</ul></div>', '<div role="navigation">|</div>',
         '<div class="pagination">|</div>', '<div class="tags">|</div>', '<ol class="breadcrumbs">|</ol>', '<div id="menu">|</div>']
HEADERS = ['<header>|</header>', '<div class="header">|</div>', '<div id="masthead">|</div>', '<div class="site-header">|</div>',
           '<div role="banner">|</div>', '<div id="header"><div class="logo">|</div></div>']
FOOTERS = ['<footer>|</footer>', '<div id="footer">|</div>', '<div class="site-footer">|</div>', '<div class="copyright">|</div>',
           '<div role="contentinfo">|</div>', '<div class="footer-links">|</div>', '<footer class="post-footer">|</footer>']
SIDES = ['<aside>|</aside>', '<div class="sidebar">|</div>', '<div id="sidebar"><div class="widget">|</div></div>',
         '<div class="related">|</div>', '<section class="related-posts">|</section>', '<div class="teaser">|</div>',
         '<aside class="recommended">|</aside>', '<div class="more-stories">|</div>', '<div role="complementary">|</div>']
ADS = ['<div class="ad">|</div>', '<div class="advert">|</div>', '<div class="ads">|</div>', '<div id="ad-top">|</div>',
       '<div class="banner">|</div>', '<div class="sponsored">|</div>', '<div class="promo">|</div>', '<aside class="advertisement">|</aside>']
NOTICES = ['<div class="cookie-notice">|</div>', '<div id="cookies">|</div>', '<div class="notice">|</div>', '<div class="alert">|</div>',
           '<div class="consent">|</div>', '<div class="popup"><div class="modal">|</div></div>', '<div class="gdpr">|</div>',
           '<div class="paywall">|</div>', '<div class="disclaimer">|</div>', '<div role="alert">|</div>', '<dialog>|</dialog>']
FORMS = ['<form>|</form>', '<form class="search">|</form>', '<div class="newsletter"><form>|</form></div>', '<div class="signup">|</div>',
         '<form id="login">|</form>', '<div class="subscribe">|</div>', '<div class="share">|</div>', '<div class="social">|</div>']
COMMENTS = ['<section class="comments">|</section>', '<div id="comments">|</div>', '<div class="comment">|</div>',
            '<ol class="commentlist">|</ol>', '<div id="disqus_thread">|</div>', '<section id="comments"><div class="comment-body">|</div></section>',
            '<div class="replies">|</div>', '<div class="user-comments">|</div>', '<div id="respond">|</div>', '<ul class="comment-list">|</ul>']
OUTSIDE = [MENUS, HEADERS, SIDES, ADS, NOTICES, FORMS]
AFTER = [COMMENTS, SIDES, ADS, FOOTERS, NOTICES, FORMS, MENUS]
INSIDE = [ADS, FORMS, SIDES, NOTICES]

_SYLLABLES = "an be co de er fi ga he in jo ka le mi no or pa qu re sa te un va wo xi ya zé ä ö ß éa ñ ch th ing tion ent".split()


def _words(rng: random.Random, n: int) -> str:
    out = ["".join(rng.choice(_SYLLABLES) for _ in range(rng.randint(1, 4))) for _ in range(n)]
    for i in range(n):
        if rng.random() < 0.12:
            out[i] += rng.choice([",", ".", ".", "&amp;", "!", "###", ";"])
    if rng.random() < 0.1:
        out = [w.upper() for w in out]
    return " ".join(out).capitalize() + (rng.choice([".", ".", "?", ""]))


def _inline(rng: random.Random, text: str, links: float) -> str:
    words = text.split(" ")
    for i in range(len(words)):
        if rng.random() < links:
            words[i] = f'<a href="/{i}">{words[i]}</a>'
        elif rng.random() < 0.02:
            words[i] = rng.choice(["<b>{}</b>", "<em>{}</em>", "<span>{}</span>", "<b>{}<br>"]).format(words[i])
    return " ".join(words)


def _block(rng: random.Random, mark: str, linked: bool = False) -> str:
    n = rng.choice([1, 3, 8, 15, 30, 60, 120])
    text = mark + _words(rng, n)
    if linked:
        text = f'<a href="/x">{text}</a>'
    else:
        text = _inline(rng, text, rng.choice([0, 0, 0.03]))
    shape = rng.choice(["<p>{}</p>"] * 5 + ["<p>{}", "<p><b>{}<br>", "<div>{}</div>", "<p class=\"text\">{}</p>"])
    if mark == MAIN:
        shape = rng.choice([shape] * 8 + ["<h2>{}</h2>", "<h3>{}</h3>", "<blockquote>{}</blockquote>", "<ul><li>{}</li></ul>", "<pre>{}</pre>",
                                          "<table><tr><td>{}</td></tr></table>", "<blockquote><p>{}</p></blockquote>"])
    else:
        shape = rng.choice([shape] * 4 + ["<h2>{}</h2>", "<h3>{}</h3>", "<ul><li>{}</li></ul>", "<li>{}</li>", "<span>{}</span>", "{}", "{}"])
    return shape.format(text)


def _piece(rng: random.Random, kinds: list[list[str]]) -> str:
    kind = rng.choice(kinds)
    open_, close = rng.choice(kind).split("|")
    linked = kind is MENUS or rng.random() < 0.2
    if kind is FOOTERS and rng.random() < 0.5:
        return f"{open_}{OTHER}&copy; {_words(rng, rng.randint(2, 20))}{close}"
    blocks = "".join(_block(rng, OTHER, linked) for _ in range(rng.randint(1, 6 if kind in (MENUS, COMMENTS) else 3)))
    return open_ + blocks + close


def page(rng: random.Random) -> str:
    out = ["<!DOCTYPE html><html><head><title>", OTHER, _words(rng, 5), "</title><style>p{}</style></head><body>"]
    outer = rng.choice(["|", "|", "|", '<div class="container">|</div>', '<div id="page"><div class="wrapper">|</div></div>', '<div id="root">|</div>'])
    out.append(outer.split("|")[0])
    out.extend(_piece(rng, OUTSIDE) for _ in range(rng.randint(0, 4)))
    open_, close = rng.choice(MAIN_WRAPPERS).split("|")
    out.append(open_)
    if rng.random() < 0.8:
        out.append(f"<h1>{MAIN}{_words(rng, rng.randint(2, 12))}</h1>")
    for _ in range(rng.randint(1, 14)):
        out.append(_block(rng, MAIN))
        if rng.random() < 0.06:
            out.append(_piece(rng, INSIDE))
    if rng.random() < 0.15:
        out.append(_piece(rng, [COMMENTS, FORMS, MENUS]))
    out.append(close)
    out.extend(_piece(rng, AFTER) for _ in range(rng.randint(0, 4)))
    if rng.random() < 0.7:
        out.append(_piece(rng, [FOOTERS]))
    out.append(outer.split("|")[1] + rng.choice(["</body></html>", ""]))
    return "".join(out)


def pages(n: int, seed: int = 1) -> list[str]:
    rng = random.Random(seed)
    return [page(rng) for _ in range(n)]

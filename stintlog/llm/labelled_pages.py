"""Labelled pages to train the extraction on: layouts of many kinds, filled with invented words.

Which blocks are main text is known because the page is put together here. Words mean nothing, so
only the structure and the shape of the text can be learned from them.
"""

from __future__ import annotations

import numpy as np

from stintlog.llm.dom_blocks import leaf_blocks

_SYLLABLES = "an ber cu den el for gi ha in jo ka lu men no or pre qui ra so ti un ver wa xi yo zen".split()

_HOLDERS = [
    ("article", ""), ("article", 'class="post"'), ("main", ""), ("div", 'class="content"'), ("div", 'id="main-content"'),
    ("div", 'class="entry-content"'), ("section", 'class="article-body"'), ("div", 'class="story text"'), ("td", 'class="body"'),
    ("div", 'class="post-content"'), ("div", ""), ("div", 'itemprop="articleBody" class="article"'),
]
_ASIDES = [
    ("aside", ""), ("div", 'class="sidebar"'), ("div", 'id="related"'), ("section", 'class="related links"'),
    ("div", 'class="widget"'), ("aside", 'class="promo"'),
]
_ADVERTS = [("div", 'class="ad"'), ("div", 'class="advert banner"'), ("div", 'id="sponsored"'), ("aside", 'class="ads"'), ("p", 'class="promo"')]
_NOTICES = [("div", 'class="cookie-notice"'), ("div", 'id="consent"'), ("div", 'class="notice"'), ("div", 'role="alert"'), ("p", 'class="disclaimer"')]
_COMMENTS = [("section", 'id="comments"'), ("div", 'class="comments"'), ("ol", 'class="comment-list"'), ("div", 'class="user-comments replies"')]


def labelled_page(rng: np.random.Generator) -> tuple[str, list[int]]:
    """A page and, for each of its leaf blocks, whether it is main text."""

    def pick(options):
        return options[int(rng.integers(len(options)))]

    def words(low: int, high: int) -> str:
        n = int(rng.integers(low, high + 1))
        text = " ".join("".join(pick(_SYLLABLES) for _ in range(int(rng.integers(1, 4)))) for _ in range(n))
        return text[:1].upper() + text[1:]

    # Every block's text ends with a mark that says what it is; marks go before training.
    def main(low: int, high: int) -> str:
        return words(low, high) + pick([".", ".", ".", "!", "?", ":", ""]) + "\x01"

    def rest(low: int, high: int, end: tuple[str, ...] = ("", "", ".")) -> str:
        return words(low, high) + pick(end) + "\x02"

    def wrap(kind: tuple[str, str], inner: str) -> str:
        return f"<{kind[0]}{' ' + kind[1] if kind[1] else ''}>{inner}</{kind[0]}>"

    def link_list(low: int, high: int) -> str:
        links = [f'<a href="/{i}">{rest(1, 4, ("",))}</a>' for i in range(int(rng.integers(low, high + 1)))]
        return "<ul>" + "".join(f"<li>{a}</li>" for a in links) + "</ul>" if rng.random() < 0.7 else "".join(f"<div>{a}</div>" for a in links)

    def paragraph() -> str:
        text = main(1, 4) if rng.random() < 0.2 else main(8, 90)
        if rng.random() < 0.15:
            text = f"<a href='#'>{words(1, 3)}</a> " + text
        if rng.random() < 0.15:
            text = f"<b>{words(1, 2)}</b> {text}"
        style = rng.random()
        return f"<p>{text}</p>" if style < 0.6 else f"<p>{text}" if style < 0.75 else f"<p><b>{text}<br>" if style < 0.85 else f"<div>{text}</div>" if style < 0.92 else f"{text}<p>"

    def advert() -> str:
        return wrap(pick(_ADVERTS), rest(3, 25, (".", "!", "")))

    def body() -> str:
        out = [f"<h1>{main(2, 12)}</h1>"] if rng.random() < 0.85 else []
        if rng.random() < 0.2:
            out.append(f'<div class="{pick(["byline", "meta", "date"])}">{main(2, 6)}</div>')
        for _ in range(int(rng.integers(1, 14))):
            kind = rng.random()
            if kind < 0.8:
                out.append(paragraph())
            elif kind < 0.86:
                out.append(f"<h2>{main(1, 8)}</h2>")
            elif kind < 0.9:
                out.append("<ul>" + "".join(f"<li>{main(1, 20)}</li>" for _ in range(int(rng.integers(2, 6)))) + "</ul>")
            elif kind < 0.93:
                out.append(f"<blockquote><p>{main(5, 30)}</p></blockquote>")
            elif kind < 0.95:
                out.append(f"<table><tr><td>{main(1, 5)}</td><td>{main(1, 5)}</td></tr></table>")
            elif kind < 0.97:
                out.append(f"<pre>{main(3, 20)}</pre>")
            else:
                out.append(advert())
        return "".join(out)

    parts = []
    bare = rng.random() < 0.2  # nothing before the text
    if not bare and rng.random() < 0.5:
        parts.append(f"<header><h1>{rest(1, 4)}</h1><p>{rest(2, 8)}</p></header>" if rng.random() < 0.5 else f'<div id="header">{rest(1, 6)}</div>')
    if not bare and rng.random() < 0.8:
        parts.append(wrap(pick([("nav", ""), ("div", 'class="menu"'), ("div", 'id="navigation"')]), link_list(3, 9)))
    if not bare and rng.random() < 0.3:
        parts.append(wrap(pick(_NOTICES), rest(4, 30, (".",))))
    if not bare and rng.random() < 0.4:
        parts.append(advert())
    if not bare and rng.random() < 0.3:
        parts.append(wrap(pick(_ASIDES), f"<h3>{rest(1, 3)}</h3>" + link_list(2, 6)))
    holder = pick(_HOLDERS)
    text = wrap(holder, body())
    parts.append(f"<table><tr>{text}</tr></table>" if holder[0] == "td" else text)
    if rng.random() < 0.3:
        said = "".join(f'<li class="comment"><p>{rest(3, 40, (".", "!"))}</p></li>' for _ in range(int(rng.integers(1, 5))))
        parts.append(wrap(pick(_COMMENTS), f"<h3>{rest(1, 2)}</h3>{said}"))
    if rng.random() < 0.3:
        parts.append(wrap(pick(_ASIDES), f"<h3>{rest(1, 3)}</h3><p>{rest(4, 25)}</p>" + link_list(0, 4)))
    if rng.random() < 0.25:
        parts.append(f'<form action="/s"><label>{rest(1, 4)}</label><p>{rest(2, 12)}</p><button>{rest(1, 1)}</button></form>')
    if rng.random() < 0.85:
        sign = pick(["&copy; ", "© ", "", "Copyright "])
        parts.append(wrap(pick([("footer", ""), ("div", 'id="footer"'), ("div", 'class="bottom legal"')]), sign + rest(2, 14) + (link_list(0, 4) if rng.random() < 0.3 else "")))
    page = f"<!DOCTYPE html><html><head><title>{words(2, 6)}</title><style>p{{margin:0}}</style></head><body>{''.join(parts)}</body></html>"
    labels = [int("\x01" in b.text) for b in leaf_blocks(page)]
    return page.replace("\x01", "").replace("\x02", ""), labels

"""Labelled pages to train the HTML model on, made by rule.

Each layout is a page skeleton as sites commonly have them; ``data-main="1"`` marks the element whose blocks are main
text, ``data-main="0"`` one inside it that is not. Filling texts vary in length by a seeded generator. A user with hand-labelled
pages passes those instead: the marks are the whole label format.
"""

from __future__ import annotations

import random

WORDS = (
    "the town of river market new council people said after work year water school report small old house first road "
    "long day time plan more light field public open north city train paper hand family summer winter price week"
).split()

MENU = ("Home", "News", "Contact", "About us", "Sports", "Archive", "Log in", "Weather", "Shop", "Help")

# {p} a paragraph, {s} a short sentence, {h} a heading, {m} a list of links, {l} one link, {n} a number.
LAYOUTS = (
    '<nav><ul>{m}</ul></nav><div class="ad">{s}</div><article data-main="1"><h1>{h}</h1><p>{p}</p><p>{p}</p>{p}<p>{p}'
    "</article><footer>&copy; {s}</footer>",
    '<header><a href="/">{h}</a><nav>{m}</nav></header><main data-main="1"><h1>{h}</h1><p>{p}</p><h2>{h}</h2><p>{p}</p>'
    "<blockquote>{s}</blockquote><ul><li>{s}</li><li>{s}</li></ul><pre>{s}</pre></main><aside><h3>{h}</h3><ul>{m}</ul>"
    "</aside><footer><p>{s}</p>{m}</footer>",
    '<div id="header"><h1>{h}</h1></div><div id="menu">{m}</div><div id="content" data-main="1"><h2>{h}</h2><p>{p}</p>'
    '<div class="advert" data-main="0"><p>{s}</p></div><p>{p}</p><table><tr><td>{s}</td><td>{n}</td></tr></table>'
    '</div><div id="comments"><h3>{n} comments</h3><div class="comment"><p>{p}</p></div><div class="comment"><p>{s}</p>'
    '</div></div><div id="footer">{s}</div>',
    '<div class="cookie-notice"><p>{s}</p><button>OK</button></div><div class="wrapper"><div class="post" data-main="1">'
    "<h1>{h}</h1><div>{p}</div><div>{p}</div><div>{s}</div></div>"
    '<div class="sidebar"><h4>{h}</h4><p>{s}</p>{m}</div></div><form><label>{s}</label><input><button>{h}</button></form>',
    '<div class="banner">{s}</div><section class="entry-content" data-main="1"><h2>{h}</h2><p>{p}</p><figure>'
    '<figcaption>{s}</figcaption></figure><p>{p}</p><div class="share" data-main="0">{m}</div></section><section '
    'class="related"><h3>{h}</h3><ul>{m}</ul></section><div class="copyright">&copy; {n} {s}</div>',
    '<div class="top">{m}</div><div class="body"><article data-main="1"><header><h1>{h}</h1></header><p>{p}</p><p>{s}</p>'
    '<section class="comments" data-main="0"><h2>{h}</h2><p>{p}</p><p>{s}</p></section></article></div><footer>{m}'
    "</footer>",
    '<div><div><ul>{m}</ul></div><div data-main="1"><h1>{h}</h1><p>{p}</p><p>{p}</p><p>{p}</p><p>{s}</p></div><div>{m}'
    "</div><div>{l} {l} {s}</div></div>",
    '<article data-main="1"><p>{s}</p></article><footer>{s}</footer>',
    '<div class="notice"><p>{p}</p></div><div role="main" data-main="1"><p>{p}</p><ol><li>{p}</li><li>{s}</li></ol></div>'
    '<div class="newsletter"><p>{s}</p><form><p>{s}</p></form></div>',
)


def pages(count: int, seed: int = 1) -> list[str]:
    """``count`` labelled pages, layouts in turn."""
    rng = random.Random(seed)

    def text(low: int, high: int) -> str:
        return " ".join(rng.choice(WORDS) for _ in range(rng.randint(low, high))).capitalize()

    def link() -> str:
        return f'<a href="/{rng.choice(WORDS)}">{rng.choice(MENU)}</a>'

    fills = {
        "{p}": lambda: ", ".join(text(4, 14).lower() for _ in range(rng.randint(2, 8))).capitalize() + ".",
        "{s}": lambda: text(1, 9) + ".",
        "{h}": lambda: text(1, 8),
        "{m}": lambda: "".join(f"<li>{link()}</li>" for _ in range(rng.randint(3, 8))),
        "{l}": link,
        "{n}": lambda: str(rng.randint(1, 3000)),
    }
    made = []
    for i in range(count):
        layout = LAYOUTS[i % len(LAYOUTS)]
        for mark, fill in fills.items():
            while mark in layout:
                layout = layout.replace(mark, fill(), 1)
        head = f"<head><title>{fills['{h}']()}</title><style>p{{margin:0}}</style><script>var a = '</p>';</script></head>"
        made.append(f"<!DOCTYPE html><html>{head}<body>{layout}</body></html>")
    return made

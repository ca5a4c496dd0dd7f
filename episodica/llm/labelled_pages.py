"""Labelled pages: layouts written out by rule, with the main text marked by data-label.

The layouts join a container for the main text with furniture around and inside it. Fillers are
drawn from a seeded generator; only lengths and marks matter, never the words.
"""

from __future__ import annotations

import random

# Usual names of containers of main text and of page furniture.
CONTAINERS = (
    ("article", ""), ("main", ""), ("div", 'id="content"'), ("div", 'class="post-content"'), ("div", 'class="entry-content"'), ("section", 'class="article-body"'),
    ("div", 'class="story text"'), ("div", 'id="main"'), ("div", 'role="main"'), ("div", ""), ("article", 'class="post"'), ("td", ""),
)
MENUS = (("nav", ""), ("div", 'class="menu"'), ("ul", 'class="navbar"'), ("div", 'id="navigation"'), ("div", 'class="breadcrumb"'), ("nav", 'class="breadcrumbs"'), ("div", 'role="navigation"'))
HEADERS = (("header", ""), ("div", 'id="header"'), ("div", 'class="masthead"'), ("div", 'class="site-header top"'), ("header", 'role="banner"'))
FOOTERS = (("footer", ""), ("div", 'id="footer"'), ("div", 'class="site-footer copyright"'), ("footer", 'class="bottom"'))
SIDES = (("aside", ""), ("div", 'class="sidebar"'), ("div", 'id="sidebar"'), ("div", 'class="widget related"'), ("section", 'class="related-posts"'), ("div", 'class="recommended"'), ("aside", 'class="sidebar"'))
NOTICES = (("div", 'class="cookie-notice"'), ("div", 'class="cookie-banner consent"'), ("div", 'class="alert notice"'), ("div", 'id="gdpr"'), ("div", 'class="notice"'), ("div", 'role="alert"'), ("section", 'class="disclaimer"'), ("p", 'class="notice"'))
ADS = (("div", 'class="ad"'), ("div", 'class="ads sponsored"'), ("div", 'class="advert"'), ("section", 'class="promo"'), ("aside", 'class="advertisement"'), ("div", 'id="banner"'), ("p", 'class="ad"'), ("div", 'class="sponsor"'))
FORMS = (("form", ""), ("form", 'class="newsletter subscribe"'), ("div", 'class="login signup"'), ("form", 'id="search"'), ("div", 'class="newsletter"'), ("div", 'class="share social"'))
COMMENTS = (("div", 'class="comments"'), ("section", 'id="comments"'), ("div", 'class="comment"'), ("ol", 'class="comment-list"'), ("div", 'class="reader-comments replies"'), ("section", 'class="comments"'), ("div", 'id="disqus thread discussion"'))
WIDGETS = ("<button>{}</button>", "<select><option>{0}<option>{0}</select>", "<noscript>{}</noscript>", "<svg><text>{}</text></svg>", "<iframe>{}</iframe>", "<object>{}</object>", "<canvas>{}</canvas>", "<template><p>{}</p></template>")
SHORT, LONG = (2, 8), (12, 90)


def labelled_pages(count: int = 240, seed: int = 7) -> list[str]:
    draw = random.Random(seed)

    def words(low: int, high: int, stop: str = ".") -> str:
        out = ["".join(draw.choice("aeioustrnlm") for _ in range(draw.randint(2, 9))) for _ in range(draw.randint(low, high))]
        return " ".join(out).capitalize() + stop

    def block(kind, inner: str) -> str:
        tag, attributes = kind
        return f"<{tag} {attributes}>{inner}</{tag}>" if attributes else f"<{tag}>{inner}</{tag}>"

    def links() -> str:
        return "<ul>" + "".join(f'<li><a href="/">{words(1, 3, "")}</a></li>' for _ in range(draw.randint(3, 8))) + "</ul>"

    def furniture(kinds, size=SHORT) -> str:
        kind, inner = draw.choice(kinds), words(*size)
        if kind[0] != "p" and draw.random() < 0.5:
            inner = "".join(f"<p>{words(*size)}</p>" for _ in range(draw.randint(1, 3)))
        if kind[0] in ("ol", "ul"):
            inner = "".join(f"<li>{words(*size)}</li>" for _ in range(draw.randint(1, 3)))
        return block(kind, inner)

    def replies() -> str:
        # Comments are as long as paragraphs and look like them.
        kind, part = draw.choice(COMMENTS), draw.choice(('<div class="comment"><p>{}</p></div>', "<p>{}</p>", "<li><p>{}</p></li>", '<div class="reply"><b>{}</b></div>'))
        return block(kind, "<h3>" + words(1, 2, "") + "</h3>" + "".join(part.format(words(*draw.choice((SHORT, LONG)))) for _ in range(draw.randint(1, 5))))

    pages = []
    for _ in range(count):
        body = [f'<{h} data-label="1">{words(2, 12, "")}</{h}>' for h in ("h1",) if draw.random() < 0.8]
        for _ in range(draw.randint(1, 9)):
            shape = draw.random()
            size = LONG if draw.random() < 0.7 else (1, 8)
            if shape < 0.78:
                body.append(f'<p data-label="1">{words(*size)}</p>')
            elif shape < 0.84:
                body.append(f'<h2 data-label="1">{words(2, 7, "")}</h2>')
            elif shape < 0.89:
                body.append("<ul>" + "".join(f'<li data-label="1">{words(3, 20)}</li>' for _ in range(draw.randint(2, 5))) + "</ul>")
            elif shape < 0.92:
                body.append(f'<blockquote data-label="1"><p>{words(*size)}</p></blockquote>')
            elif shape < 0.95:
                body.append("<table>" + "".join(f'<tr><td data-label="1">{words(1, 4, "")}</td><td data-label="1">{words(1, 6, "")}</td></tr>' for _ in range(draw.randint(2, 4))) + "</table>")
            elif shape < 0.97:
                body.append(f'<div data-label="1">{words(*LONG)}</div>')
            else:
                body.append(f'<pre data-label="1">{words(*LONG)}</pre>')
        for kinds, share in ((ADS, 0.25), (SIDES, 0.12), (FORMS, 0.12), (NOTICES, 0.1), (MENUS, 0.06)):
            if draw.random() < share:
                body.insert(draw.randint(0, len(body)), furniture(kinds, draw.choice((SHORT, (8, 30)))))
        inside = draw.random() < 0.4
        if inside and draw.random() < 0.7:
            body.append(replies())
        main = block(draw.choice(CONTAINERS), "".join(body))
        if draw.random() < 0.3:
            main = block(("div", draw.choice(('class="wrapper"', 'id="page"', 'class="container"', ""))), main)
        before = [block(draw.choice(MENUS), links())]
        if draw.random() < 0.6:
            before.insert(draw.randint(0, 1), block(draw.choice(HEADERS), words(1, 6, "") + (links() if draw.random() < 0.4 else "")))
        before += [furniture(k, draw.choice((SHORT, (8, 30)))) for k, s in ((NOTICES, 0.4), (ADS, 0.5), (FORMS, 0.2)) if draw.random() < s]
        after = [] if inside or draw.random() < 0.5 else [replies()]
        after += [furniture(k, draw.choice((SHORT, (8, 30)))) for k, s in ((SIDES, 0.5), (ADS, 0.3), (FORMS, 0.3)) if draw.random() < s]
        after.append(block(draw.choice(FOOTERS), draw.choice(("&copy; " + words(2, 20), "<p>" + words(2, 20) + "</p>" + links()))))
        pages.append("<html><head><title>t</title></head><body>" + "".join([*before, main, *after]) + "</body></html>")
    # Parts of forms, pictures and frames, in the main text and around it.
    for _ in range(count // 4):
        body = [f'<p data-label="1">{words(*LONG)}</p>' for _ in range(draw.randint(2, 6))]
        for _ in range(draw.randint(1, 3)):
            body.insert(draw.randint(0, len(body)), draw.choice(WIDGETS).format(words(*SHORT)))
        around = [draw.choice(WIDGETS).format(words(*SHORT)) for _ in range(draw.randint(0, 2))]
        pages.append("<html><body>" + "".join([*around, block(draw.choice(CONTAINERS), "".join(body))]) + "</body></html>")
    return pages

"""Labelled training pages: invented layouts with marked article text."""

import random

#: Stands at the start of every run of article text; taken out before features.
MARK = "\ue000"

_MAIN = (
    ("article", ""), ("article", ' class="post"'), ("main", ""), ("div", ' class="post-content"'),
    ("div", ' id="content"'), ("div", ' class="entry"'), ("section", ' class="story"'),
    ("div", ' role="main"'), ("div", ' class="article-body"'), ("div", ' id="main"'),
    ("article", ' id="a17"'), ("div", ' class="text"'), ("div", ""), ("section", ""),
)
_OUTER = (("", ""), ("div", ' id="wrapper"'), ("div", ' class="container"'), ("main", ""), ("div", ""))
_SIDES = {
    "nav": (("nav", ""), ("div", ' class="menu"'), ("ul", ' id="nav"'), ("div", ' id="navigation"'),
            ("nav", ' class="breadcrumbs"'), ("div", ' class="topbar"')),
    "header": (("header", ""), ("div", ' id="header"'), ("div", ' class="masthead"'),
               ("header", ' class="site-header"'), ("div", ' class="banner"')),
    "footer": (("footer", ""), ("div", ' id="footer"'), ("div", ' class="copyright"'),
               ("div", ' class="site-footer"')),
    "aside": (("aside", ""), ("div", ' class="sidebar"'), ("div", ' id="sidebar"'),
              ("div", ' class="widget"'), ("div", ' class="related"'), ("aside", ' class="promo"'),
              ("section", ' class="related-posts"'), ("div", ' class="newsletter"')),
    "notice": (("div", ' class="cookie-notice"'), ("div", ' id="cookie-banner"'),
               ("div", ' class="notice"'), ("p", ' class="notice"'), ("div", ' role="alert"'),
               ("div", ' class="consent"'), ("section", ' class="notification"')),
    "ad": (("div", ' class="ad"'), ("div", ' id="advert"'), ("div", ' class="sponsored"'),
           ("aside", ' class="ad-slot"'), ("p", ' class="advertisement"'), ("ins", ' class="adsbygoogle"'),
           ("div", ' class="banner-ad"'), ("section", ' class="promoted"')),
    "form": (("form", ""), ("form", ' action="/search"'), ("div", ' class="search"'),
             ("form", ' class="subscribe"'), ("form", ' id="respond"')),
    "comments": (("section", ' id="comments"'), ("div", ' class="comments"'),
                 ("ol", ' class="commentlist"'), ("div", ' id="disqus"'), ("section", ' class="comment-list"'),
                 ("div", ' class="reader-comments"')),
    "share": (("div", ' class="share"'), ("ul", ' class="social"'), ("div", ' class="sharing-buttons"')),
}


class _Writer:
    def __init__(self, rng):
        self.rng = rng
        self.loose = rng.random() < 0.4  # paragraphs without end tags

    def words(self, low, high):
        rng = self.rng
        out = []
        for _ in range(rng.randint(low, high)):
            word = "".join(rng.choice("etaoinshrdlucmfé") for _ in range(rng.randint(1, 9)))
            out.append(word + rng.choice(("", "", "", "", ",", ".")))
        return " ".join(out) + rng.choice((".", ".", "", "!"))

    def main(self, low, high):
        return MARK + self.words(low, high)

    def paragraphs(self, say, count, long=70):
        rng, out = self.rng, []
        for _ in range(count):
            high = rng.choice((2, 12, 40, long))
            style = rng.random()
            body = say(1, high)
            if style < 0.12:
                body = f"<b>{body}<br>"  # an open bold element
                out.append(f"<p>{body}" + ("" if self.loose else "</p>"))
            elif style < 0.2:
                link = say(1, 4)
                out.append(f'<p>{body} <a href="/x">{link}</a></p>')
            elif style < 0.26:
                out.append(f"<h{rng.randint(2, 3)}>{say(1, 8)}</h2>".replace("</h2>", "</h2>"))
            elif style < 0.31:
                items = "".join(f"<li>{say(1, 12)}</li>" for _ in range(rng.randint(1, 4)))
                out.append(f"<ul>{items}</ul>")
            elif style < 0.35:
                out.append(f"<blockquote><p>{body}</p></blockquote>")
            elif style < 0.38:
                out.append(f"<table><tr><td>{say(1, 6)}</td><td>{say(1, 6)}</td></tr></table>")
            elif style < 0.41:
                out.append(f"<pre>{body}</pre>")
            else:
                out.append(f"<p>{body}" + ("" if self.loose and rng.random() < 0.5 else "</p>"))
        return out

    def side(self, kind):
        rng = self.rng
        tag, attributes = rng.choice(_SIDES[kind])
        links = "".join(
            f'<li><a href="/{k}">{self.words(1, 2)}</a></li>' for k in range(rng.randint(1, 8))
        )
        if kind in ("nav", "share"):
            body = links if tag == "ul" else f"<ul>{links}</ul>"
        elif kind == "header":
            body = rng.choice((f"<h1>{self.words(1, 4)}</h1>", f"<p>{self.words(1, 12)}</p>", f"<ul>{links}</ul>",
                               f'<div class="logo">{self.words(1, 3)}</div><nav><ul>{links}</ul></nav>'))
        elif kind == "form":
            body = f"<label>{self.words(1, 3)}</label><input name=q><button>{self.words(1, 2)}</button>"
            if rng.random() < 0.4:
                body = f"<p>{self.words(1, 20)}</p>{body}"
        elif kind == "comments":
            each, name = ("li", "") if tag == "ol" else ("div", rng.choice((' class="comment"', ' class="reply"', "")))
            body = f"<h3>{self.words(1, 3)}</h3>" * (rng.random() < 0.5 and tag != "ol") + "".join(
                f"<{each}{name}>" + "".join(self.paragraphs(self.words, rng.randint(1, 3), 60)) + f"</{each}>"
                for _ in range(rng.randint(1, 5))
            )
        elif kind == "footer":
            body = rng.choice((f"&copy; {self.words(1, 14)}", f"<p>{self.words(1, 30)}</p>", f"<ul>{links}</ul>"))
        elif kind == "aside":
            body = f"<h3>{self.words(1, 3)}</h3>" + rng.choice(
                (f"<ul>{links}</ul>", "".join(self.paragraphs(self.words, rng.randint(1, 3), 50)))
            )
        else:
            body = self.words(1, 30) if tag == "p" or rng.random() < 0.6 else f"<p>{self.words(1, 40)}</p>"
        return f"<{tag}{attributes}>{body}</{tag}>"

    def page(self):
        rng = self.rng
        some = lambda kinds, p: [self.side(k) for k in kinds if rng.random() < p]
        body = self.paragraphs(self.main, rng.randint(0, 9))
        for kind in ("ad", "share", "aside", "notice", "form"):
            if rng.random() < 0.15:
                body.insert(rng.randint(0, len(body)), self.side(kind))
        title = f"<h1>{self.main(1, 10)}</h1>"
        where = rng.random()
        if where < 0.55:
            body.insert(0, title)
        elif where < 0.7:
            body.insert(0, f"<header>{title}</header>")
        if rng.random() < 0.15:
            body.append(self.side("comments"))
        tag, attributes = rng.choice(_MAIN)
        if rng.random() < 0.2:
            body = [f'<div class="{rng.choice(("body", "entry-content", "inner", "prose"))}">', *body, "</div>"]
        main = f"<{tag}{attributes}>{''.join(body)}</{tag}>"
        if where >= 0.9:
            main = title + main
        outer, names = rng.choice(_OUTER)
        parts = [
            *some(("notice", "header", "nav", "ad", "form"), 0.45), main,
            *some(("share", "comments", "aside", "ad"), 0.4), *some(("footer",), 0.8), *some(("notice",), 0.1),
        ]
        if rng.random() < 0.25:  # the sidebar first
            parts.insert(0, self.side("aside"))
        inner = "".join(parts)
        if outer:
            inner = f"<{outer}{names}>{inner}</{outer}>"
        end = "</body></html>" if rng.random() < 0.8 else ""
        return (
            f"<!DOCTYPE html><html><head><title>{self.words(1, 6)}</title><style>p{{margin:0}}</style>"
            f"</head><body><!-- x -->{inner}{end}"
        )


def training_pages(count, seed=0):
    rng = random.Random(seed)
    return [_Writer(rng).page() for _ in range(count)]

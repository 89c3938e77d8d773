"""Labelled pages to train the block labeller on.

``labelled_pages(n, seed)`` builds pages from a grammar of common layouts; every
element that holds article text carries the attribute ``data-main``, every element
that holds reader comments or other chrome inside it carries ``data-other``. The
parser reads these two attributes as labels and never as features. Wording is
drawn from invented syllables in several alphabets, so the labeller learns from
tags, class names, link density, length, punctuation and neighbours rather than
from words.
"""

from __future__ import annotations

import random

# Names that sites give to the parts of a page.
CONTENT_NAMES = ["content", "main", "main-content", "article", "article-body", "post",
                 "post-content", "entry-content", "entry", "story", "story-body", "text", "body-text"]
CHROME_NAMES = {
    "menu": ["nav", "navbar", "menu", "main-menu", "navigation", "breadcrumb", "breadcrumbs",
             "topbar", "toc", "pagination", "pager", "tabs"],
    "header": ["header", "masthead", "site-header", "banner", "branding", "logo", "top"],
    "footer": ["footer", "site-footer", "copyright", "legal", "bottom", "credits"],
    "side": ["sidebar", "side", "aside", "widget", "related", "related-posts", "recommended",
             "trending", "popular", "tags", "share", "social", "author-box", "newsletter"],
    "notice": ["cookie", "cookie-notice", "consent", "gdpr", "notice", "alert", "banner",
               "popup", "modal", "subscribe", "paywall", "message"],
    "ad": ["ad", "ads", "advert", "advertisement", "sponsored", "promo", "banner-ad", "adbox",
           "sponsor"],
    "comments": ["comments", "comment", "comment-list", "discussion", "responses", "replies",
                 "disqus", "reader-comments", "user-comments"],
    "form": ["search", "search-form", "login", "signup", "subscribe-form", "contact", "form"],
}
_SYLLABLES = ["the", "an", "er", "ou", "la", "men", "tion", "de", "ung", "sch", "ció", "éa", "ent",
              "ra", "lo", "мо", "ка", "ти", "в", "при", "ing", "st", "re", "ha"]


class _Writer:
    def __init__(self, rng: random.Random):
        self.r = rng

    def word(self) -> str:
        return "".join(self.r.choice(_SYLLABLES) for _ in range(self.r.randint(1, 4)))

    def words(self, lo: int, hi: int) -> str:
        return " ".join(self.word() for _ in range(self.r.randint(lo, hi)))

    def sentence(self, lo: int = 3, hi: int = 18) -> str:
        noise = self.r.choice(["", "", "", "", "%%%", "&amp;&amp;", "***", "!!", " |"])
        return self.words(lo, hi).replace(" ", f"{noise} ").capitalize() + "."

    def prose(self) -> str:
        n = self.r.choice([1, 1, 2, 3, 5, 8, 12])
        text = " ".join(self.sentence() for _ in range(n))
        if self.r.random() < 0.25:
            w = self.word()
            text += f' <a href="/{w}">{w}</a> {self.sentence(1, 5)}'
        return self.r.choice([text, text, text, f"<b>{text}</b>", f"<em>{self.word()}</em> {text}"])

    def short(self) -> str:
        """Article text as short as a menu entry."""
        return self.r.choice([self.words(1, 3), self.sentence(1, 2), self.sentence(1, 4)])

    def links(self) -> str:
        return "".join(f'<li><a href="/{self.word()}">{self.words(1, 3)}</a></li>'
                       for _ in range(self.r.randint(3, 9)))

    def named(self, kind: str) -> str:
        name = self.r.choice(CHROME_NAMES[kind])
        return self.r.choice([f'class="{name}"', f'id="{name}"', f'class="{self.word()} {name}"'])

    def chrome(self, kind: str) -> str:
        r = self.r
        tag = {"menu": ["nav", "nav", "div", "ul"], "header": ["header", "header", "div"],
               "footer": ["footer", "footer", "div"], "side": ["aside", "aside", "div", "section"],
               "notice": ["div", "div", "aside", "section", "p"], "ad": ["div", "div", "aside", "ins"],
               "comments": ["section", "div", "div", "ol"], "form": ["form", "form", "div"]}[kind]
        tag = r.choice(tag)
        plain = tag in ("nav", "header", "footer", "aside", "form", "ins")
        attr = self.named(kind) if not plain or r.random() < 0.6 else ""
        if kind == "menu":
            inner = self.links() if tag == "ul" else f"<ul>{self.links()}</ul>"
        elif kind == "header":
            inner = r.choice([f'<a href="/">{self.words(1, 3)}</a><p>{self.sentence(2, 6)}</p>',
                              f"<h2>{self.words(1, 4)}</h2><ul>{self.links()}</ul>"])
        elif kind == "footer":
            inner = r.choice([
                f"&copy; {self.word()}.example.com &middot; {self.sentence()}",
                f"<p>&copy; 2024 {self.words(1, 3)}. {self.sentence(2, 6)}</p><ul>{self.links()}</ul>"])
        elif kind == "side":
            inner = f"<h3>{self.words(1, 3)}</h3>" + r.choice(
                [f"<ul>{self.links()}</ul>", f"<p>{self.prose()}</p>",
                 f"<p>{self.sentence()}</p><p>{self.sentence()}</p>"])
        elif kind == "notice":
            inner = r.choice([self.sentence(), f"<p>{self.sentence()}</p><button>{self.word()}</button>",
                              f"{self.sentence()} {self.sentence()}"])
        elif kind == "ad":
            inner = r.choice([self.sentence(), self.prose(), f'<a href="/x">{self.sentence()}</a>',
                              f"<p>{self.sentence()}</p>"])
        elif kind == "comments":
            one = [f'<div class="comment"><b>{self.word()}</b><p>{self.prose()}</p></div>'
                   for _ in range(r.randint(1, 5))]
            if tag == "ol":
                one = [f"<li><p>{self.prose()}</p></li>" for _ in one]
            inner = r.choice(["", f"<h3>{self.words(1, 2)}</h3>"]) * (tag != "ol") + "".join(one)
        else:
            inner = f'<label>{self.words(1, 2)}</label><input name="q"><button>{self.word()}</button>'
            inner += r.choice(["", f"<select><option>{self.word()}</option></select>",
                               f"<textarea>{self.sentence()}</textarea>"])
        return f"<{tag} {attr} data-other>{inner}</{tag}>"

    def part(self) -> str:
        r = self.r
        return r.choice([
            lambda: f"<p>{self.prose()}</p>", lambda: f"<p>{self.prose()}</p>",
            lambda: f"<p>{self.prose()}</p>", lambda: f"<p>{self.prose()}</p>",
            lambda: f"<p>{self.short()}</p>", lambda: f"<p>{self.prose()}",
            lambda: f"<p><b>{self.sentence()}<br><p>{self.prose()}</p>",
            lambda: f"<h2>{self.words(1, 6)}</h2>", lambda: f"<h3>{self.sentence(1, 5)}</h3>",
            lambda: "<ul>" + "".join(f"<li>{self.sentence(1, 8)}</li>" for _ in range(3)) + "</ul>",
            lambda: f"<blockquote><p>{self.prose()}</p></blockquote>",
            lambda: f"<pre>{self.words(3, 9)}</pre>",
            lambda: f"<div>{self.prose()}</div>",
            lambda: f"<table><tr><td>{self.words(1, 3)}</td><td>{self.sentence(1, 4)}</td></tr></table>",
            lambda: f"<figure><img src='x'><figcaption>{self.sentence()}</figcaption></figure>",
        ])()

    def article(self) -> str:
        r = self.r
        head = r.choice(["", f"<h1>{self.sentence(2, 9)}</h1>", f"<h1>{self.words(2, 9)}</h1>"])
        parts = [self.part() for _ in range(r.choice([1, 2, 3, 5, 8, 12]))]
        if r.random() < 0.2:
            parts.insert(r.randint(0, len(parts)), self.chrome(r.choice(["ad", "side", "notice"])))
        if r.random() < 0.08:
            parts.append(self.chrome("comments"))
        body = head + "".join(parts)
        tag = r.choice(["article", "article", "article", "main", "div", "div", "section"])
        attr = (f'class="{r.choice(CONTENT_NAMES)}"' if tag in ("div", "section")
                or r.random() < 0.3 else "")
        if r.random() < 0.15:
            body = f"<div>{body}</div>"
        return f"<{tag} {attr} data-main>{body}</{tag}>"

    def page(self) -> str:
        r = self.r
        some = lambda *kinds: "".join(self.chrome(k) for k in kinds if r.random() < 0.5)
        before = some("notice", "header", "menu", "ad", "form")
        after = some("ad", "side", "comments", "form", "footer", "notice")
        body = before + self.article() + after
        if r.random() < 0.2:
            body = f'<div id="{r.choice(["page", "wrapper", "container", "root"])}">{body}</div>'
        return (f"<!DOCTYPE html><html><head><title>{self.words(2, 6)}</title>"
                f"<style>p{{margin:0}}</style></head><body>{body}</body></html>")


def labelled_pages(n: int = 400, seed: int = 1) -> list[str]:
    w = _Writer(random.Random(seed))
    return [w.page() for _ in range(n)]

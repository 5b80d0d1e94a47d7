"""Labelled pages to train text extraction on: invented words in layouts as they are common on the web.

Every text that belongs to the article carries MARK, which the trainer takes off again. The words are invented and the
extractor has no features on words, so the pages teach layout, names of classes and shapes of texts only.
"""

from __future__ import annotations

import random

MARK = ""

# Names that pages commonly use for their parts.
CONTENT = "content main main-content article article-body post post-content entry entry-content story story-body text body page-content single".split()
HEADER = "header site-header masthead top-bar banner-top branding page-header topbar logo".split()
MENU = "nav navbar menu main-menu navigation breadcrumbs breadcrumb tabs pagination toc-links skip-link subnav".split()
SIDE = "sidebar side widget widget-area right-col left-col rail related related-posts recommended popular more-stories trending tags see-also".split()
ADVERT = "ad ads advert advertisement ad-slot adsbygoogle banner sponsor sponsored promo promoted promotion ad-container".split()
NOTICE = "notice cookie cookie-notice cookie-banner consent gdpr alert popup modal overlay paywall disclaimer message warning privacy-notice".split()
FORM = "form newsletter newsletter-signup subscribe search login signup contact-form".split()
COMMENTS = "comments comment-list commentlist reader-comments responses discussion respond disqus comment-section replies".split()
SHARE = "share social social-links share-buttons follow-us".split()
FOOTER = "footer site-footer colophon copyright legal page-footer bottom footer-links".split()
PARTS = {
    "content": CONTENT, "header": HEADER, "menu": MENU, "side": SIDE, "advert": ADVERT, "notice": NOTICE, "form": FORM,
    "comments": COMMENTS, "share": SHARE, "footer": FOOTER,
}
_SYLLABLES = "ba de ki lo mu ra se ti no pa ge fu li ma or en st th ing er ou é ñ ß ö да ре но".split()
_SIGNS = "! # * ~ + = % &amp; &lt; &gt; &quot;".split()
_OPEN = "b i em font strong u".split()
_TAGS = "p b a div span li td h2".split()


class Maker:
    def __init__(self, seed: int) -> None:
        self.rng = random.Random(seed)

    def word(self) -> str:
        return "".join(self.rng.choices(_SYLLABLES, k=self.rng.randint(1, 4)))

    def phrase(self, low: int, high: int) -> str:
        return " ".join(self.word() for _ in range(self.rng.randint(low, high))).capitalize()

    def prose(self, low: int, high: int) -> str:
        text = " ".join(self.phrase(1, 18) + self.rng.choice("....?!,") for _ in range(self.rng.randint(low, high)))
        if self.rng.random() < 0.15:
            text = text.replace(" ", self.noise() + " ")
        return text.upper() if self.rng.random() < 0.05 else text

    def noise(self) -> str:
        """Signs that are no words, as character references where they have to be."""
        return "".join(self.rng.choices(_SIGNS, k=self.rng.randint(1, 4)))

    def unseen(self) -> str:
        """Style and script, which may hold markup as text."""
        rules = "".join(f"{self.rng.choice(_TAGS)}{{{self.word()}:{self.rng.randrange(99)}px}}" for _ in range(self.rng.randrange(4)))
        tag = self.rng.choice(_TAGS)
        calls = "".join(f'{self.word()}("<{tag}>{self.word()}</{tag}>");' for _ in range(self.rng.randrange(4)))
        return self.maybe(0.6, lambda: f"<style>{rules}</style>") + self.maybe(0.7, lambda: f"<script>{calls}</script>")

    def maybe(self, chance: float, make, *args) -> str:
        return make(*args) if self.rng.random() < chance else ""

    def named(self, names: list[str], inner: str, tags: str = "div div div section ul table") -> str:
        """An element whose class or id is one of the names."""
        tag = self.rng.choice([t for t in tags.split() if t not in ("ul", "table")])
        key = self.rng.choice(["class", "class", "id"])
        name = self.rng.choice(names)
        if self.rng.random() < 0.2:
            name += self.rng.choice([" wrap", " clearfix", " col-4", " block", "-1"])
        return f'<{tag} {key}="{name}">{inner}</{tag}>'

    def links(self, low: int, high: int) -> str:
        items = [f'<a href="/{self.word()}">{self.phrase(1, 4)}</a>' for _ in range(self.rng.randint(low, high))]
        kind = self.rng.randrange(4)
        if kind == 0:
            return " ".join(items)
        if kind == 1:
            return " | ".join(items)
        return "<ul>" + "".join(f"<li>{x}</li>" if kind == 2 else f"<li>{x}" for x in items) + "</ul>"

    def inline(self, text: str) -> str:
        if self.rng.random() < 0.3 and len(words := text.split()) > 3:
            k = self.rng.randrange(len(words))
            tag = self.rng.choice(["b", "i", "em", "strong", "span", "a", "code"])
            words[k] = f'<a href="/{self.word()}">{words[k]}</a>' if tag == "a" else f"<{tag}>{words[k]}</{tag}>"
            text = " ".join(words)
        return text

    def paragraph(self) -> str:
        text = self.inline(self.prose(1, 7)) + MARK
        kind = self.rng.random()
        if kind < 0.55:
            return f"<p>{text}</p>"
        if kind < 0.7:
            return f"<p>{text}"
        if kind < 0.8:
            # Elements that nobody closes.
            return f"<p>{self.maybe(0.5, lambda: f'<{self.rng.choice(_OPEN)}>')}{text}{self.maybe(0.5, lambda: '<br>')}"
        return f"<div>{text}</div>" if kind < 0.9 else f"<p>{self.phrase(1, 3)}.{MARK}</p>"

    def block(self) -> str:
        kind = self.rng.random()
        if kind < 0.74:
            return self.paragraph()
        if kind < 0.82:
            return f"<h{(n := self.rng.randint(2, 4))}>{self.phrase(1, 8)}{MARK}</h{n}>"
        if kind < 0.88:
            tag = self.rng.choice(["ul", "ol"])
            items = "".join(f"<li>{self.inline(self.prose(1, 2))}{MARK}</li>" for _ in range(self.rng.randint(2, 5)))
            return f"<{tag}>{items}</{tag}>"
        if kind < 0.92:
            return f"<blockquote><p>{self.prose(1, 3)}{MARK}</p></blockquote>"
        if kind < 0.95:
            rows = "".join(f"<tr><td>{self.phrase(1, 3)}{MARK}</td><td>{self.phrase(1, 3)}{MARK}</td></tr>" for _ in "abc")
            return f"<table>{rows}</table>"
        if kind < 0.98:
            return f'<figure><img src="x.png"><figcaption>{self.phrase(3, 12)}{MARK}</figcaption></figure>'
        return f"<pre>{self.phrase(3, 12)}{MARK}</pre>"

    def advert(self) -> str:
        inner = self.rng.choice([self.prose(1, 3), f"<p>{self.prose(1, 3)}</p>", f"<a href='/x'>{self.phrase(2, 8)}</a>"])
        return self.named(ADVERT, inner, "div div aside section ins")

    def notice(self) -> str:
        return self.named(NOTICE, f"<p>{self.prose(1, 3)}</p>" + self.maybe(0.5, lambda: f"<button>{self.word()}</button> <a href='/c'>{self.word()}</a>"), "div div section aside")

    def form(self) -> str:
        inner = f"<h3>{self.phrase(1, 5)}</h3><p>{self.prose(1, 2)}</p><label>{self.phrase(1, 3)}</label><input type='text'><button>{self.word()}</button>"
        plain = f"<form action='/s'>{inner}</form>"
        return plain if self.rng.random() < 0.5 else self.named(FORM, plain if self.rng.random() < 0.6 else inner)

    def share(self) -> str:
        return self.named(SHARE, self.links(2, 4))

    def aside(self) -> str:
        inner = f"<h3>{self.phrase(1, 4)}</h3>" + self.rng.choice([self.links(3, 7), f"<p>{self.prose(1, 4)}</p>"])
        return f"<aside>{inner}</aside>" if self.rng.random() < 0.4 else self.named(SIDE, inner, "div div aside section")

    def comments(self) -> str:
        one = lambda: f"<p>{self.prose(1, 4)}</p>"
        forms = [
            lambda: f'<div class="comment"><span class="author">{self.phrase(1, 2)}</span>{one()}</div>',
            lambda: f'<li class="comment"><b>{self.phrase(1, 2)}</b>{one()}</li>',
            lambda: f'<article class="comment"><h4>{self.phrase(1, 2)}</h4>{one()}{one()}</article>',
            lambda: one(),
        ]
        form = self.rng.choice(forms)
        inner = self.maybe(0.7, lambda: f"<h3>{self.phrase(1, 4)}</h3>") + "".join(form() for _ in range(self.rng.randint(1, 5)))
        return self.named(COMMENTS, inner + self.maybe(0.3, self.form), "div section section aside")

    def header(self) -> str:
        inner = self.rng.choice(
            [f"<h1>{self.phrase(1, 4)}</h1>", f"<div>{self.phrase(1, 4)}</div>", f"<a href='/'>{self.phrase(1, 3)}</a><p>{self.prose(1, 1)}</p>"]
        )
        inner += self.maybe(0.5, self.menu)
        return f"<header>{inner}</header>" if self.rng.random() < 0.5 else self.named(HEADER, inner)

    def menu(self) -> str:
        inner = self.links(2, 9)
        return f"<nav>{inner}</nav>" if self.rng.random() < 0.5 else self.named(MENU, inner, "div div nav section")

    def footer(self) -> str:
        inner = self.rng.choice(
            [
                f"&copy; {self.word()} &middot; {self.prose(1, 2)}",
                f"<p>&copy; 2020 {self.phrase(1, 4)}</p>" + self.links(2, 5),
                f"<p>{self.prose(1, 3)}</p>" + self.links(1, 5),
                self.links(2, 9),
            ]
        )
        return f"<footer>{inner}</footer>" if self.rng.random() < 0.6 else self.named(FOOTER, inner)

    def article(self) -> str:
        title = f"<h1>{self.phrase(2, 10)}{self.rng.choice(['', '.', '&amp;'])}{MARK}</h1>"
        if self.rng.random() < 0.25:
            title = f"<header>{title}</header>"
        blocks = [self.block() for _ in range(self.rng.choice([1, 2, 4, 8, 14]))]
        for make, chance in ((self.advert, 0.2), (self.share, 0.2), (self.aside, 0.15), (self.form, 0.1), (self.notice, 0.08)):
            if self.rng.random() < chance:
                blocks.insert(self.rng.randint(1, len(blocks)), make())
        inner = self.maybe(0.85, lambda: title) + "".join(blocks) + self.maybe(0.2, self.comments)
        kind = self.rng.random()
        if kind < 0.4:
            return f"<article>{inner}</article>"
        if kind < 0.55:
            return f"<main>{self.rng.choice([inner, f'<article>{inner}</article>'])}</main>"
        return self.named(CONTENT, inner) if kind < 0.9 else inner

    def page(self) -> str:
        parts = [
            self.maybe(0.2, self.notice),
            self.maybe(0.5, self.header),
            self.maybe(0.7, self.menu),
            self.maybe(0.4, self.advert),
            self.maybe(0.2, self.aside),
            self.article(),
            self.maybe(0.3, self.comments),
            self.maybe(0.3, self.aside),
            self.maybe(0.15, self.form),
            self.maybe(0.2, self.advert),
            self.maybe(0.85, self.footer),
            self.maybe(0.15, self.notice),
        ]
        head = f"<head><title>{self.phrase(1, 8)}</title>{self.unseen()}</head>"
        body = "\n".join(parts) if self.rng.random() < 0.3 else "".join(parts)
        return f"<!DOCTYPE html><html>{head}<body>{body}</body></html>"

"""A table of labelled pages, built by rule: ``data-main`` marks the elements that are main text.

Pages have some of the same parts, in words of no meaning: a masthead, a menu, an article of
headings, paragraphs long and short, lists and quotes, sometimes with a list of links inside,
and after it shares, teasers, a footer. What differs is what the markup says. Half of the pages name their parts with the elements made for
them or with usual classes; only these have parts that read like an article and are none, such
as comments and notices. A quarter names nothing. A quarter says something else: wrappers named
after one of the things inside them, articles in elements whose class mentions sharing, menus
inside the content.
"""

from __future__ import annotations

from random import Random

COUNT = 640
_SYLLABLES = "ka lo mi ren tu sa vel dor in eth ba quo lim est ar".split()


class _Writer:
    def __init__(self, seed: int) -> None:
        self.random = Random(seed)
        #: How the markup names parts: rightly, not at all, or wrongly.
        self.naming = ("named", "nameless", "named", "misnamed")[seed % 4]
        #: Whether there is anything but the article, and how long its paragraphs are.
        self.bare = self.random.random() < 0.3
        lengths = ((6, 24), (14, 40), (14, 110), (14, 110), *(((1, 4),) if self.naming != "nameless" else ()))
        self.length = self.random.choice(lengths)

    def words(self, least: int, most: int) -> str:
        n = self.random.randint(least, most)
        return " ".join("".join(self.random.choices(_SYLLABLES, k=self.random.randint(1, 3))) for _ in range(n))

    def often(self, share: float) -> bool:
        return self.random.random() < share

    def link(self, least: int, most: int) -> str:
        return f"<a href='/{self.random.randint(1, 99)}'>{self.words(least, most)}</a>"

    def links(self) -> str:
        items = [self.link(1, 4) for _ in range(self.random.randint(3, 8))]
        if self.often(0.6):
            return "<ul>" + "".join(f"<li>{x}</li>" for x in items) + "</ul>"
        return "<div>" + self.random.choice((" ", " | ", "</div><div>")).join(items) + "</div>"

    def part(self, names: tuple[str, ...], body: str) -> str:
        """Something that is not main text, under one of its names."""
        if self.naming != "named":
            return f"<div{self.random.choice(('', ' class=c4', ' class=row', ' id=x7'))}>{body}</div>"
        name = self.random.choice(names)
        if name.startswith("<"):
            return f"{name}>{body}</{name[1:]}>"
        return f"<div class='{name}'>{body}</div>"

    def paragraph(self) -> str:
        if self.often(0.2):
            return f"<p data-main>{self.words(1, 7)}</p>"
        if self.often(0.1):
            return f"<blockquote data-main>{self.words(10, 50)}</blockquote>"
        if self.often(0.1):
            return "<ul data-main>" + "".join(f"<li>{self.words(4, 16)}</li>" for _ in range(self.random.randint(2, 4))) + "</ul>"
        text = self.words(*self.length)
        if self.often(0.3):
            text = f"{text} {self.link(1, 4)} {self.words(4, 20)}"
        return f"<p data-main>{text}</p>"

    def article(self) -> str:
        """The main text, where a list of links or, if it is named, something else may follow inside."""
        paragraphs = [self.paragraph() for _ in range(self.random.choice((0, 1, 2, 3, 5, 8)))]
        paragraphs.insert(0, f"<p data-main>{self.words(*self.length)}</p>")
        if len(paragraphs) > 4 and self.often(0.5):
            paragraphs.insert(3, f"<h2 data-main>{self.words(1, 7)}</h2>")
        if self.often(0.15):
            paragraphs.append(self.links())
        if self.often(0.9):
            paragraphs.insert(0, f"<h1 data-main>{self.link(2, 12) if self.often(0.1) else self.words(1, 12)}</h1>")
        opened = {
            "named": (*["<article"] * 5, "<main", "<div class='post'", "<section id='content'", "<div class='entry-content'"),
            "nameless": ("<div", "<td", "<section"),
            "misnamed": ("<article class='post share-enabled'", "<article class='related-posts-on'", "<div class='ad-free wide'", "<div class='story with-sidebar'", "<td"),
        }
        # Articles of short lines only are told by their name.
        tag = "<article" if self.length[1] < 6 else self.random.choice(opened[self.naming])
        if self.naming == "named" and self.often(0.3):
            paragraphs.append(self.like_text())
        return f"{tag}>{''.join(paragraphs)}</{tag[1:].split()[0]}>"

    def like_text(self) -> str:
        """Parts that only their names tell from an article."""
        found = [
            self.part(("comments", "comment", "disqus"), f"<p>{self.words(8, 50)}</p>"),
            self.part(("cookie-notice", "notice", "<dialog"), f"{self.words(15, 40)} <button>{self.words(1, 2)}</button>"),
            self.part(("sidebar", "<aside", "related"), f"<h3>{self.words(1, 4)}</h3><p>{self.words(12, 40)}</p>"),
            self.part(("ad", "advert", "sponsored promo"), self.words(6, 30)),
            self.part(("<form", "newsletter", "subscribe"), f"<label>{self.words(4, 20)}</label><input><button>{self.words(1, 2)}</button>"),
        ]
        return "".join(self.random.sample(found, self.random.choice((0, 0, 1, 1, 2))))

    def page(self) -> str:
        before, after = [], []
        if self.often(0.75):
            before.append(self.part(("<header", "masthead"), self.words(1, 4) if self.often(0.5) else self.link(1, 4)))
        if self.often(0.75):
            before.append(self.part(("<nav", "menu", "navbar"), self.links()))
        if self.often(0.3):
            before.append(f"<div>{self.words(1, 3)}</div>")
        if self.often(0.4):
            after.append(self.part(("share", "social"), self.words(1, 2)))
        if self.often(0.6):
            after.append(self.part(("related", "<aside", "more-links widget"), f"<div>{self.words(1, 3)}</div>{self.links()}"))
        if self.often(0.3):
            after += [f"<div>{self.link(3, 10)}</div>" for _ in range(self.random.randint(1, 3))]
        if self.often(0.7):
            after.append(self.part(("<footer", "footer"), f"&copy; {self.words(2, 12)}" + (f" {self.link(1, 2)}" if self.often(0.5) else "")))
        if self.naming == "named":
            before.append(self.like_text())
            after.insert(0, self.like_text())
        body = self.article() if self.bare else f"{''.join(before)}{self.article()}{''.join(after)}"
        if self.naming == "misnamed" and self.often(0.4):
            around = self.random.choice(("<div class='content'>", "<div class='has-sidebar page'>", "<main>", "<div id='page' class='no-comments'>"))
            body = f"{around}{body}</{around[1:].split()[0].rstrip('>')}>"
        return f"<html><head><title>{self.words(2, 6)}</title></head><body>{body}</body></html>"


def page(seed: int) -> str:
    return _Writer(seed).page()


PAGES: tuple[str, ...] = tuple(page(seed) for seed in range(COUNT))

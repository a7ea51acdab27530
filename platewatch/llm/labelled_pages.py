"""Labelled pages to train the extractor on: layouts of many kinds, each block marked as article or not.

The layouts are written by hand below; names, nesting, order and the invented words vary by a seed, so
the model has to learn from structure and shape of text rather than from words.
"""

import numpy as np

KEEP, DROP = 1, 0

_MENU = ["nav", "nav class=main-nav", "div class=menu", "div id=navbar", "div class=navigation", "ul class=nav-list", "div class=breadcrumbs",
         "div class=tabs role=navigation", "header><nav", "div class=topbar", "div class=toc", "menu"]
_HEADER = ["header", "header class=site-header", "div id=header", "div class=masthead", "div class=page-header", "div class=logo", "header role=banner"]
_FOOTER = ["footer", "footer class=site-footer", "div id=footer", "div class=bottom", "div class=copyright", "footer role=contentinfo", "div class=legal"]
_SIDE = ["aside", "aside class=sidebar", "div id=sidebar", "div class=side-column", "div class=related", "div class=widget", "div class=rail",
         "section class=recommended", "div class=popular", "div class=tags", "div class=share", "div class=social"]
_NOTICE = ["div class=notice", "div class=cookie-notice", "div id=cookies", "div class=alert role=alert", "div class=consent", "div class=gdpr-banner",
           "p class=notice", "div class=warning", "div class=paywall", "div class=popup", "dialog", "div class=modal", "div class=message", "div class=hidden hidden"]
_ADVERT = ["div class=ad", "div class=ads", "div class=advert", "div class=advertisement", "div><ins class=adsbygoogle", "div id=ad-top", "aside class=ad",
           "div class=sponsored", "div class=promo", "p class=ad", "div class=banner", "section class=sponsor", "div class=teaser-ad"]
_FORM = ["form", "form class=search", "form class=newsletter", "form id=login", "div class=subscribe", "div class=signup", "form class=comment-form"]
_COMMENTS = ["section id=comments", "div class=comments", "div id=disqus", "ol class=comment-list", "div class=responses", "section class=discussion",
             "div class=comment", "ul class=replies", "div class=user-comments", "div class=reviews"]
_ARTICLE = ["article", "main", "main><article", "div class=content", "div id=content", "div class=post", "div class=entry-content", "div class=article-body",
            "div class=story", "section class=article", "td class=main", "div id=main", "div class=text", "article class=post", "div", ""]


def _invented(count=4000):
    random = np.random.default_rng(40)
    letters = np.array(list("aeiourstnlmdcphgbé"))
    return ["".join(random.choice(letters, size)) for size in random.integers(1, 9, count)]


_WORDS = _invented()


class _Writer:
    def __init__(self, random):
        self.random, self.parts = random, []
        self.labels: list[int] = []

    def pick(self, values):
        return values[int(self.random.integers(len(values)))]

    def chance(self, share):
        return self.random.random() < share

    def words(self, low, high, sentences=False):
        made = [_WORDS[i] for i in self.random.integers(len(_WORDS), size=int(self.random.integers(low, high + 1)))]
        if not sentences:
            return " ".join(w.title() if self.chance(0.5) else w for w in made)
        ended = [w + self.pick(["", "", "", "", ",", ". "]) for w in made]
        return (" ".join(ended)).capitalize() + "."

    def text(self, tag, label, text, inner=""):
        self.parts.append(f"<{tag}>{inner}{text}</{tag.split()[0]}>")
        self.labels.append(label)

    def open(self, names):
        tags = []
        for part in filter(None, names.split("><")):
            tag, *attributes = part.split()
            shown = [a if "=" not in a else '{}="{}"'.format(*a.split("=")) for a in attributes]
            self.parts.append("<" + " ".join([tag, *shown]) + ">")
            tags.append(tag)
        return tags

    def close(self, tags):
        self.parts.extend(f"</{t}>" for t in reversed(tags))

    def links(self, names, low=2, high=8):
        tags = self.open(self.pick(names))
        if self.chance(0.3) and "ul" not in tags:
            self.text(self.pick(["h2", "h3", "h4", "strong"]), DROP, self.words(1, 3))
        listed = self.chance(0.7) and "ul" not in tags
        self.parts.append("<ul>" if listed else "")
        for _ in range(int(self.random.integers(low, high))):
            self.text("li" if listed or tags[-1:] == ["ul"] else "div", DROP, f'<a href="/x">{self.words(1, 3)}</a>')
        self.parts.append("</ul>" if listed else "")
        self.close(tags)

    def boiler(self, names, low=1, high=3, longest=20):
        tags = self.open(self.pick(names))
        if self.chance(0.5) and tags[-1:] != ["p"]:
            for _ in range(int(self.random.integers(low, high + 1))):
                self.text(self.pick(["p", "div", "h3", "li"]), DROP, self.words(2, longest, True))
        else:
            self.parts.append(self.pick(["", "&copy; "]) + self.words(2, longest, True))
            self.labels.append(DROP)
        self.close(tags)

    def form(self):
        tags = self.open(self.pick(_FORM))
        self.text("p", DROP, self.words(2, 10))
        if self.chance(0.6):
            self.text("button", DROP, self.words(1, 2))
        if self.chance(0.3):
            self.parts.append("<select>")
            for _ in range(3):
                self.text("option", DROP, self.words(1, 2))
            self.parts.append("</select>")
        self.close(tags)

    def comments(self):
        tags = self.open(self.pick(_COMMENTS))
        self.text("h3", DROP, self.words(1, 3))
        for _ in range(int(self.random.integers(1, 5))):
            if self.chance(0.5):
                self.parts.append('<div class="comment">')
                self.text("p", DROP, self.words(3, 50, True))
                self.parts.append("</div>")
            else:
                self.text(self.pick(["li", "p", "div"]), DROP, self.words(3, 50, True))
        self.close(tags)

    def article(self):
        tags = self.open(self.pick(_ARTICLE))
        if self.chance(0.85):
            if self.chance(0.15):
                self.parts.append("<header>")
                self.text("h1", KEEP, self.words(2, 12, True))
                self.parts.append("</header>")
            else:
                self.text(self.pick(["h1", "h1", "h2"]), KEEP, self.words(2, 12, True))
        if self.chance(0.2):
            self.text("p", KEEP, self.words(2, 5))
        for _ in range(int(self.random.integers(1, 12))):
            kind = self.random.random()
            if kind < 0.6:
                link = f' <a href="/y">{self.words(1, 3)}</a> {self.words(2, 8, True)}' if self.chance(0.2) else ""
                self.text("p", KEEP, self.words(1, 90, True) + link)
            elif kind < 0.68:
                self.parts.append(f"<p><b>{self.words(2, 14, True)}<br>")
                self.labels.append(KEEP)
            elif kind < 0.74:
                self.text(self.pick(["h2", "h3", "h4"]), KEEP, self.words(1, 6))
            elif kind < 0.8:
                self.parts.append(self.pick(["<ul>", "<ol>"]))
                for _ in range(int(self.random.integers(2, 5))):
                    shown = self.words(1, 12, True)
                    self.text("li", KEEP, f'<a href="/z">{shown}</a>' if self.chance(0.2) else shown)
                self.parts.append("</ul></ol>")
            elif kind < 0.84:
                self.text(self.pick(["blockquote", "pre", "figcaption"]), KEEP, self.words(2, 30, True))
            elif kind < 0.87:
                self.parts.append("<table><tr>")
                for _ in range(4):
                    self.text("td", KEEP, self.words(1, 4))
                self.parts.append("</tr></table>")
            elif kind < 0.92:
                self.boiler(_ADVERT)
            elif kind < 0.95:
                self.boiler(_NOTICE)
            elif kind < 0.97:
                self.links(_SIDE)
            else:
                self.form()
        if self.chance(0.12):
            self.comments()
        self.close(tags)


def labelled_page(seed: int) -> tuple[str, list[int]]:
    """A page and the label of each of its blocks in order."""
    random = np.random.default_rng([41, seed])
    w = _Writer(random)
    w.parts.append('<!DOCTYPE html><html><head><meta charset="utf-8">')
    w.text("title", DROP, w.words(2, 12))
    w.parts.append("<style>p{margin:0}</style><script>var a='</p>';</script></head><body>")
    table = w.chance(0.08)
    w.parts.append("<table><tr><td>" if table else "")
    before = [(0.5, lambda: w.boiler(_HEADER)), (0.8, lambda: w.links(_MENU)), (0.3, lambda: w.boiler(_NOTICE)), (0.5, lambda: w.boiler(_ADVERT)),
              (0.3, w.form), (0.3, lambda: w.links(_SIDE)), (0.2, lambda: w.boiler(_SIDE))]
    after = [(0.4, w.comments), (0.3, lambda: w.links(_SIDE)), (0.3, lambda: w.boiler(_SIDE)), (0.3, w.form), (0.3, lambda: w.boiler(_ADVERT)),
             (0.25, lambda: w.boiler(_NOTICE)), (0.8, lambda: w.boiler(_FOOTER)), (0.3, lambda: w.links(_FOOTER))]
    for share, part in before:
        if w.chance(share):
            part()
    w.parts.append("</td><td>" if table else "")
    w.article()
    w.parts.append("</td><td>" if table else "")
    for share, part in after:
        if w.chance(share):
            part()
    w.parts.append("</td></tr></table></body></html>" if table else "</body></html>")
    return "".join(w.parts), w.labels

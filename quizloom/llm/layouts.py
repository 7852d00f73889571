"""Labelled pages: texts set in many layouts, with the label of each block known from how it was set.

A page that marks its article with the element of that name is labelled by it. Such pages are
alike where they come from one site, so their paragraphs are also set anew: in containers with and
without telling names, between menus, notices, adverts, teasers, forms and readers' comments, some
of them prose taken from other pages.
"""

from __future__ import annotations

import html
import random

#: Starts each text of the article in a page that is set here; taken off before it is read.
MARK = "\ue000"

#: What boilerplate says, by use.
SAYS = {
    "note": ["We use cookies to improve your experience. Accept all", "Wir verwenden Cookies auf dieser Website.", "Nous utilisons des cookies pour améliorer votre visite.", "Utilizamos cookies propias y de terceros.", "This site uses cookies. By continuing you agree to our privacy policy.", "Please enable JavaScript to view this page.", "Subscribe to our newsletter and never miss a story."],
    "foot": ["© 2024 Example Media. All rights reserved.", "Impressum und Datenschutz", "Mentions légales", "Aviso legal y política de privacidad", "Terms of use · Privacy · Contact", "Copyright 2023 The Daily. Reproduction without permission is prohibited."],
    "ad": ["Advertisement", "Anzeige", "Publicité", "Publicidad", "Sponsored content", "Buy one, get one free! Limited offer, click here.", "Save 50% today only."],
    "talk": ["Great article, thank you for sharing!", "I don't agree with the second point at all.", "Sehr guter Beitrag, danke!", "Merci pour cet article.", "Muy interesante, gracias.", "First!", "Can somebody explain what the author means?"],
    "who": ["anna42 says:", "Posted by J. Miller on 3 May", "Reply", "guest wrote 2 hours ago", "12 May 2021 at 10:14", "Antworten", "Répondre", "Responder"],
    "share": ["Share on Facebook", "Tweet", "Share this", "Teilen", "Partager", "Compartir", "Print", "Email"],
    "form": ["Search", "Your name", "Your email address", "Send", "Leave a comment", "Log in", "Password", "Sign up now"],
    "head": ["Example News", "The Daily", "Skip to content", "Today's weather: 14 °C", "Edition: Europe"],
    "side": ["Related articles", "Most read", "You may also like", "Trending now", "Das könnte Sie auch interessieren", "À lire aussi", "Te puede interesar", "Latest posts", "About the author", "Tags"],
    "menu": ["Home", "News", "Politics", "Sport", "Kontakt", "Über uns", "Accueil", "Inicio", "Contacto", "About", "Archive", "Next", "Previous"],
    "meta": ["By Jane Roe", "Published 4 March 2022", "Von Max Muster", "5 min read", "Updated: 12.03.2021"],
}
#: Sentences of articles for where a table marks none.
PROSE = [
    "The council met on Tuesday evening to discuss the plan for the old harbour, which has stood empty since the ferry line closed.",
    "Several residents said that they had not been told about the change, and asked for more time before a final vote is taken.",
    "Die Ergebnisse der Studie zeigen, dass sich die Lage in den vergangenen Jahren deutlich verbessert hat, sagte die Leiterin.",
    "Selon les auteurs, cette méthode permet de réduire les coûts sans perdre en qualité, même sur de grands volumes.",
    "El equipo trabajó durante tres años en el proyecto, y los primeros resultados se publicaron la semana pasada.",
    "It was raining.", "She smiled.", "In 1912 the bridge was rebuilt in stone.",
]
#: Telling names for each use, as class or id.
CALLED = {
    "note": ["cookie-banner", "cookieNotice", "gdpr-consent", "notice", "alert alert-info", "newsletter-signup", "modal popup"],
    "foot": ["footer", "site-footer", "page-foot", "copyright", "legal"],
    "ad": ["ad", "ads", "ad-slot", "advert", "advertisement", "sponsored", "promo-box"],
    "talk": ["comments", "comment-list", "discussion", "replies", "disqus_thread", "reader-comments"],
    "share": ["share", "social-links", "sharing-buttons"],
    "form": ["search", "login-form", "contact-form", "comment-form"],
    "head": ["header", "site-header", "masthead", "top-bar"],
    "side": ["sidebar", "widget", "related-posts", "recommended", "most-popular", "teaser-list"],
    "menu": ["nav", "menu", "main-navigation", "breadcrumb", "pagination"],
    "meta": ["byline", "post-meta", "date", "author"],
    "body": ["article-body", "post-content", "entry-content", "story", "content", "main-text", "post"],
}
_OWN_TAG = {"note": ["div", "div", "aside", "dialog"], "foot": ["footer", "footer", "div"], "ad": ["div", "div", "aside", "section"], "talk": ["section", "div", "div", "ol"], "share": ["div", "ul"], "form": ["form", "form", "div"], "head": ["header", "header", "div"], "side": ["aside", "aside", "div", "section", "td"], "menu": ["nav", "nav", "div", "ul"], "meta": ["div", "p", "address"]}


class Setter:
    """Sets one page; draws come from the generator given."""

    def __init__(self, rng: random.Random, others: list[str]):
        self.rng, self.others = rng, others or PROSE

    def some(self, items: list[str], low: int, high: int) -> list[str]:
        return [self.rng.choice(items) for _ in range(self.rng.randint(low, high))]

    def named(self, tag: str, use: str, inner: str, told: float = 0.8) -> str:
        name = self.rng.choice(CALLED[use])
        attr = f' {self.rng.choice(["class", "class", "id"])}="{name}"' if self.rng.random() < told else ""
        return f"<{tag}{attr}>{inner}</{tag}>"

    def text(self, t: str, mark: bool = False) -> str:
        return (MARK if mark else "") + html.escape(t, quote=False)

    def links(self, items: list[str]) -> str:
        a = [f'<a href="/x">{self.text(t)}</a>' for t in items]
        return self.rng.choice(["<ul>" + "".join(f"<li>{x}</li>" for x in a) + "</ul>", "".join(f"<div>{x}</div>" for x in a), " | ".join(a)])

    def short(self) -> str:
        return " ".join(self.rng.choice(self.others).split()[: self.rng.randint(1, 6)])

    def part(self, use: str) -> str:
        rng, says = self.rng, SAYS[use]
        tag = rng.choice(_OWN_TAG[use])
        told = 0.85 if tag in ("div", "p", "section", "td", "ul", "ol") else 0.5
        p = rng.choice(["p", "div", "span"])
        if use == "menu":
            inner = self.links(self.some(says, 1, 8) + [self.short() for _ in range(rng.randint(0, 6))])
        elif use == "talk":
            each = lambda: f"<{p}>{self.text(rng.choice(SAYS['who']))}</{p}><p>{self.text(rng.choice(says + self.others + self.others))}</p>"
            wrap = rng.choice(['<div class="comment">{}</div>', "<li>{}</li>", '<article class="comment">{}</article>', "{}"])
            inner = f"<h3>{rng.choice(['Comments', 'Kommentare', 'Commentaires', 'Comentarios', '3 replies'])}</h3>" + "".join(wrap.format(each()) for _ in range(rng.randint(1, 6)))
        elif use == "side":
            teaser = "".join(f'<h4><a href="/y">{self.text(self.short())}</a></h4><p>{self.text(rng.choice(self.others))}</p>' for _ in range(rng.randint(0, 3)))
            inner = f"<h3>{self.text(rng.choice(says))}</h3>" + rng.choice([self.links([self.short() for _ in range(rng.randint(1, 8))]), teaser])
        elif use == "form":
            inner = "".join(rng.choice([f"<label>{self.text(t)}</label><input>", f"<p>{self.text(t)}</p>", f"<button>{self.text(t)}</button>"]) for t in self.some(says, 1, 5))
        elif use in ("share", "meta"):
            inner = self.links(self.some(says, 1, 4)) if use == "share" else " ".join(f"<span>{self.text(t)}</span>" for t in self.some(says, 1, 3))
        else:
            inner = "".join(f"<{p}>{self.text(t)}</{p}>" for t in self.some(says + ([self.short()] if use != "note" else []) + (self.others[:3] if use in ("ad", "foot") else []), 1, 3))
            if use in ("head", "foot") and rng.random() < 0.6:
                inner += self.links(self.some(SAYS["menu"], 2, 6))
        return self.named(tag if tag != "td" else "div", use, inner, told)

    def article(self, title: str, paragraphs: list[str]) -> str:
        rng, out = self.rng, []
        if title:
            out.append(f"<h1>{self.text(title, True)}</h1>")
            if rng.random() < 0.4:
                out.append(self.part("meta"))
            if rng.random() < 0.2:
                out.append(self.part("share"))
            if rng.random() < 0.35:  # an article's own header holds its title
                out = [rng.choice(['<header class="entry-header">{}</header>', "<header>{}</header>", '<div class="post-header">{}</div>']).format("".join(out))]
        broken = rng.random() < 0.3
        at = 0
        while at < len(paragraphs):
            t, draw = paragraphs[at], rng.random()
            at += 1
            if draw < 0.06:
                few = rng.choice([40, 6, 3])
                out.append(rng.choice(["<ul>{}</ul>", "<ol>{}</ol>"]).format("".join(f"<li>{self.text(' '.join(x.split()[:few]), True)}" for x in paragraphs[at - 1 : at + 2])))
                at += 2
            elif draw < 0.1:
                out.append(f"<blockquote>{self.text(t, True)}</blockquote>")
            elif draw < 0.13:
                out.append(f"<h2>{self.text(' '.join(t.split()[:6]), True)}</h2><p>{self.text(t, True)}</p>")
            elif draw < 0.16:
                out.append(f"<table><tr><td>{self.text(t, True)}</td><td>{self.text(' '.join(t.split()[:3]), True)}</td></tr></table>")
            elif draw < 0.2:
                words = t.split()
                k = len(words) // 2
                out.append(f'<p>{self.text(" ".join(words[:k]), True)} <a href="/z">{self.text(" ".join(words[k : k + 3]))}</a> {self.text(" ".join(words[k + 3 :]))}</p>')
            elif draw < 0.24:
                out.append(f"<div>{self.text(t, True)}</div>")
            else:
                out.append(f"<p>{self.text(t, True)}" + ("" if broken else "</p>"))
            if rng.random() < 0.06:
                out.append(self.part(rng.choice(["ad", "side", "share", "form"])))
        return "\n".join(out)

    def page(self, title: str, paragraphs: list[str]) -> str:
        rng = self.rng
        maybe = lambda p, use: [self.part(use)] if rng.random() < p else []
        inner = self.article(title, paragraphs)
        kind = rng.choice(["article", "article", "main", "both", "named", "named", "plain", "table"])
        after = maybe(0.3, "share") + maybe(0.3, "side") + maybe(0.4, "talk")
        if kind in ("article", "both"):
            within = after if rng.random() < 0.3 else []
            body = f"<article>{inner}{''.join(within)}</article>" + ("" if within else "".join(after))
            body = f"<main>{body}</main>" if kind == "both" else body
        elif kind == "main":
            body = f"<main>{inner}</main>" + "".join(after)
        else:
            body = (f"<div>{inner}</div>" if kind == "plain" else self.named("div", "body", inner, 1.0)) + "".join(after)
        if kind == "table":
            body = f"<table><tr><td>{self.part('side')}</td><td>{body}</td></tr></table>"
        before = maybe(0.3, "note") + maybe(0.7, "head") + maybe(0.7, "menu") + maybe(0.4, "ad") + maybe(0.2, "form") + maybe(0.25, "side")
        rear = maybe(0.35, "side") + maybe(0.25, "ad") + maybe(0.25, "form") + maybe(0.2, "note") + maybe(0.8, "foot")
        if rng.random() < 0.06:  # little or nothing else
            before, rear = [], rear[:1]
        if rng.random() < 0.4:
            body = f'<div class="{rng.choice(["wrapper", "container", "page", "layout", "row"])}">{body}{"".join(rear[:1])}</div>'
            rear = rear[1:]
        return f"<html><head><title>{self.text(title)}</title><style>p{{}}</style></head><body>{''.join(before)}{body}{''.join(rear)}<script>x('</p>')</script></body></html>"

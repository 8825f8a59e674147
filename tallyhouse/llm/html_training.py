"""Labelled pages to train the block labeller: layouts, names and phrases of the open web put together at random.

Blocks below `data-label="main"` are the article. Texts are invented words with function words of four languages, so that the labeller
learns from tags, names, links, lengths and what stands around a block, and from words only where pages say the same things.
"""

from __future__ import annotations

import random

# Names that sites give to the parts of a page.
CONTENT = "content main article post entry story post-body entry-content article-body main-content page-content text body-text single".split()
MENU = "nav menu navbar main-menu navigation breadcrumb breadcrumbs topnav sitenav nav-links tabs toolbar pager pagination toc submenu".split()
HEADER = "header masthead site-header top topbar banner page-header branding logo header-inner".split()
FOOTER = "footer site-footer bottom page-footer copyright colophon foot legal footer-links credits".split()
SIDEBAR = "sidebar aside side rail widget widget-area right-column secondary related recommended most-read popular trending tagcloud about-author".split()
NOTICE = "notice cookie cookie-banner consent gdpr alert message announcement paywall modal popup overlay newsletter subscribe-box warning".split()
ADVERT = "ad ads advert advertisement sponsor sponsored promo promotion ad-slot banner-ad adsbox dfp google-ad partner-offer affiliate".split()
COMMENTS = "comments comment-list commentlist discussion responses respond replies reader-comments disqus reviews feedback thread".split()
SHARE = "share social share-buttons social-links tags post-tags toolbar-share follow actions".split()

# Phrases around articles, in four languages.
MENU_WORDS = (
    "Home|News|Sport|Politics|About us|Contact|Archive|Login|Sign up|Products|Services|Blog|Startseite|Nachrichten|Kontakt|Über uns|Accueil|"
    "Actualités|À propos|Contact|Inicio|Noticias|Contacto|Sobre nosotros|Next|Previous|More|Weiter|Zurück|Suivant|Siguiente|Menu|Shop"
).split("|")
FOOTER_WORDS = (
    "All rights reserved|Privacy policy|Terms of use|Imprint|Alle Rechte vorbehalten|Datenschutz|Impressum|Tous droits réservés|Mentions légales|"
    "Todos los derechos reservados|Aviso legal|Powered by|Sitemap|Accessibility|Cookie settings"
).split("|")
NOTICE_WORDS = (
    "We use cookies to improve your experience.|By continuing you accept our use of cookies.|Subscribe to our newsletter.|Wir verwenden Cookies.|"
    "Nous utilisons des cookies.|Usamos cookies para mejorar su experiencia.|You have 2 free articles left this month.|Please enable notifications.|"
    "This site requires consent.|Get the latest stories in your inbox.|Newsletter abonnieren.|Inscrivez-vous à la newsletter.|Suscríbase al boletín."
).split("|")
ADVERT_WORDS = "Advertisement|Sponsored|Anzeige|Publicité|Publicidad|Buy now|Save 50% today|Jetzt kaufen|Special offer|Promoted content".split("|")
COMMENT_WORDS = "Comments|3 Comments|Leave a reply|Kommentare|Commentaires|Comentarios|Reader reviews|Join the discussion|Responses|Antworten".split("|")
SIDE_WORDS = "Related articles|Most read|Trending|Recent posts|Tags|Categories|Mehr zum Thema|À lire aussi|Más leídas|You may also like|About the author".split("|")
SHARE_WORDS = "Share|Tweet|Email|Print|Save|Facebook|WhatsApp|Teilen|Partager|Compartir|Copy link|Follow us".split("|")
FORM_WORDS = "Search|Email address|Name|Password|Send|Submit|Suchen|Rechercher|Buscar|Your message|Choose a country|Remember me".split("|")
FUNCTION_WORDS = (
    "the of and to in is that it for was on with as by at from are this be an der die das und ist nicht von mit für auf ein eine zu den le la les des et "
    "est que qui dans pour une sur pas par el los las y en por con una para del se su lo como más"
).split()
SYLLABLES = "ba ce di fo gu ha je ki lo mu na pe ri so tu va we xi yo za th st er an en on ti re al or ne ra é ü ñ ß ça".split()

#: An element that only carries a label; training does not see it.
MARK = "x-mark"


class Writer:
    """One page: its own vocabulary and its own habits of naming."""

    def __init__(self, seed: int):
        self.rng = random.Random(seed)
        self.vocabulary = ["".join(self.rng.choices(SYLLABLES, k=self.rng.randint(1, 4))) for _ in range(120)]
        self.named = self.rng.random() < 0.8  # else class names say nothing
        self.tags = self.rng.random() < 0.75  # else divs stand in for elements with a meaning

    def maybe(self, share: float) -> bool:
        return self.rng.random() < share

    def words(self, low: int, high: int) -> str:
        pick = lambda: self.rng.choice(FUNCTION_WORDS if self.maybe(0.35) else self.vocabulary)
        return " ".join(pick() for _ in range(self.rng.randint(low, high)))

    def oddity(self) -> str:
        """Text that is no sentence: tables of signs, marked words, one word over and over, figures, a single word, capitals."""
        words = self.words(3, 30).split()
        return self.rng.choice(
            [
                " | ".join(words),
                " ".join(word + self.rng.choice(["###", "$$$", "&amp;&amp;", "***", "%%", ""]) for word in words),
                " ".join([words[0]] * self.rng.randint(3, 40)),
                " ".join(str(self.rng.randrange(10 ** self.rng.randint(1, 9))) for _ in words),
                words[0].capitalize() + self.rng.choice([".", "", ","]),
                " ".join(words).upper(),
                f"{words[0]}@{words[1]}.org https://{words[1]}.net/{words[2]} +1 555 {self.rng.randrange(10**6)}",
                "".join(self.rng.choices("abcdef0123456789", k=self.rng.randint(20, 200))),
            ]
        )

    def sentences(self, low: int, high: int) -> str:
        if self.maybe(0.1):
            return self.oddity()
        if self.maybe(0.08):
            high *= 5
        return " ".join(self.words(4, 14).capitalize() + self.rng.choice(".....!?") for _ in range(self.rng.randint(low, high)))

    def link(self, text: str) -> str:
        return f'<a href="/{self.rng.randrange(9999)}">{text}</a>'

    def attributes(self, names: list[str], always: bool = False) -> str:
        if not always and self.maybe(0.15):
            return ""
        name = self.rng.choice(names) if always or self.named else "c" + self.rng.choice("bdfgkpqwxz") + str(self.rng.randrange(99))
        if self.maybe(0.3):
            name += " " + self.rng.choice(["clearfix", "wide", "row", "inner", "box", "block", "js-x"])
        return f' {"id" if self.maybe(0.25) else "class"}="{name}"'

    def wrap(self, tag: str, names: list[str], inside: str, label: str = "other", always: bool = False) -> str:
        """An element of a part; without a telling tag it carries a telling name more often."""
        if not self.tags or tag == "div":
            tag = "div" if self.maybe(0.85) else "section"
        return f'<{tag}{self.attributes(names, always or (tag in ("div", "section") and self.named))} data-label="{label}">{inside}</{tag}>'

    def links(self, texts: list[str], low: int, high: int, own: float) -> str:
        items = [self.words(1, 3) + (self.rng.choice(".,") if self.maybe(0.15) else "") if self.maybe(own) else self.rng.choice(texts) for _ in range(self.rng.randint(low, high))]
        if self.maybe(0.7):
            return "<ul>" + "".join(f"<li>{self.link(item)}</li>" for item in items) + "</ul>"
        if self.maybe(0.5):
            return " | ".join(map(self.link, items))
        return "".join(f"<div>{self.link(item)}</div>" for item in items)

    def menu(self) -> str:
        return self.wrap("nav", MENU, self.links(MENU_WORDS, 2, 10, 0.6))

    def header(self) -> str:
        inside = self.rng.choice(["<div>{}</div>", "<a href='/'>{}</a>", "<p>{}</p>", "<h1>{}</h1>"]).format(self.words(1, 4))
        if self.maybe(0.4):
            inside += f"<p>{self.words(3, 8)}</p>"
        if self.maybe(0.4):
            inside += self.menu()
        if self.maybe(0.3):
            inside += self.form()
        return self.wrap("header", HEADER, inside)

    def footer(self) -> str:
        inside = f"<p>&copy; {self.words(1, 3)} {self.rng.choice(FOOTER_WORDS)}</p>" if self.maybe(0.5) else f"&copy; {self.words(1, 4)}. {self.sentences(0, 2)}"
        if self.maybe(0.5):
            inside += self.links(FOOTER_WORDS + MENU_WORDS, 2, 8, 0.4)
        return self.wrap("footer", FOOTER, inside)

    def advert(self) -> str:
        inside = self.sentences(1, 2) if self.maybe(0.6) else self.rng.choice(ADVERT_WORDS) + " " + self.words(2, 8)
        if self.maybe(0.3):
            inside = f"<p>{inside}</p>"
        if self.maybe(0.3):
            inside = self.link(inside)
        return self.wrap("aside" if self.maybe(0.15) else "div", ADVERT, inside, always=True)

    def notice(self) -> str:
        inside = self.rng.choice(NOTICE_WORDS) + (" " + self.sentences(1, 2) if self.maybe(0.4) else "") if self.maybe(0.7) else self.sentences(1, 2)
        if self.maybe(0.5):
            inside = f"<p>{inside}</p>"
        if self.maybe(0.4):
            inside += f"<button>{self.rng.choice(['OK', 'Accept', 'Close', 'Akzeptieren', 'Accepter', 'Aceptar'])}</button>"
        return self.wrap("aside" if self.maybe(0.2) else "div", NOTICE, inside, always=True)

    def form(self) -> str:
        fields = "".join(
            self.rng.choice(["<label>{}</label><input>", "<button>{}</button>", "<select><option>{}<option>x</select>", "<p>{}</p><textarea></textarea>", "<legend>{}</legend>"]).format(
                self.rng.choice(FORM_WORDS) if self.maybe(0.6) else self.words(1, 3)
            )
            for _ in range(self.rng.randint(1, 4))
        )
        return f'<form{self.attributes(["search", "login", "contact-form", "signup"])} data-label="other">{fields}</form>'

    def sidebar(self) -> str:
        inside = ""
        for _ in range(self.rng.randint(1, 3)):
            inside += f"<h3>{self.rng.choice(SIDE_WORDS) if self.maybe(0.6) else self.words(1, 3)}</h3>"
            inside += self.links(MENU_WORDS, 2, 7, 0.9) if self.maybe(0.6) else f"<p>{self.sentences(1, 3)}</p>"
        return self.wrap("aside", SIDEBAR, inside)

    def share(self) -> str:
        return self.wrap("div", SHARE, self.links(SHARE_WORDS, 2, 5, 0.2), always=True)

    def comments(self) -> str:
        inside = f"<{(h := self.rng.choice(['h2', 'h3', 'h4', 'p']))}>{self.rng.choice(COMMENT_WORDS)}</{h}>" if self.maybe(0.8) else ""
        for _ in range(self.rng.randint(1, 5)):
            one = f"<b>{self.words(1, 2)}</b> " if self.maybe(0.5) else f"<div>{self.link(self.words(1, 2))}</div>"
            one += f"<p>{self.sentences(1, 4)}</p>" if self.maybe(0.8) else self.sentences(1, 3)
            if self.maybe(0.3):
                one += self.link("Reply")
            inside += self.rng.choice(['<li class="comment">{}</li>', '<div class="comment">{}</div>', "<article>{}</article>", "<div>{}</div>"]).format(one)
        if self.maybe(0.4):
            inside += self.form()
        return self.wrap("section", COMMENTS, inside, always=True)

    def paragraph(self) -> str:
        text = self.sentences(1, 5)
        roll = self.rng.random()
        if roll < 0.1:
            text = f"{text} {self.link(self.words(1, 4))} {self.sentences(1, 2)}"
        elif roll < 0.2:
            text = f"<b>{self.words(2, 8)}</b>" + ("<br>" if self.maybe(0.5) else " ") + text
        elif roll < 0.25:
            text = self.words(1, 5).capitalize() + "."
        return self.rng.choice(["<p>{}</p>"] * 6 + ["<p>{}", "<div>{}</div>", "{}<br><br>"]).format(text)

    def piece(self) -> str:
        roll = self.rng.random()
        if roll < 0.62:
            return self.paragraph()
        if roll < 0.74:
            return f"<h{(n := self.rng.randint(2, 4))}>{self.words(1, 8).capitalize()}</h{n}>"
        if roll < 0.82:
            tag = self.rng.choice(["ul", "ol"])
            items = "".join(f"<li>{self.words(1, 6) if self.maybe(0.5) else self.sentences(1, 2)}" for _ in range(self.rng.randint(2, 5)))
            return f"<{tag}>{items}</{tag}>"
        if roll < 0.87:
            return f"<blockquote><p>{self.sentences(1, 3)}</p></blockquote>"
        if roll < 0.92:
            return f"<figure><img src='x.png'><figcaption>{self.words(2, 12)}</figcaption></figure>"
        if roll < 0.96:
            cells = "".join("<tr>" + "".join(f"<td>{self.words(1, 4)}</td>" for _ in range(3)) + "</tr>" for _ in range(self.rng.randint(2, 4)))
            return f"<table>{cells}</table>"
        return f"<pre>{self.words(3, 12)}</pre>" if self.maybe(0.5) else f"<dl><dt>{self.words(1, 3)}<dd>{self.sentences(1, 2)}</dl>"

    def article(self) -> str:
        title = f"<h1>{self.words(2, 10).capitalize()}</h1>" if self.maybe(0.85) else ""
        if title and self.maybe(0.2):
            title = f"<header>{title}</header>"
        if self.maybe(0.25):
            title += self.rng.choice(["<p class='byline'>{}</p>", "<div class='meta'>{}</div>", "<time>{}</time>"]).format(self.words(2, 5))
        pieces = [self.piece() for _ in range(self.rng.randint(1, 14))]
        if not title and not any("." in piece for piece in pieces):
            pieces.append(self.paragraph())
        for part in (self.advert, self.notice, self.share, self.sidebar, self.form):
            if self.maybe(0.12):
                pieces.insert(self.rng.randint(0, len(pieces)), part())
        inside = title + "".join(pieces)
        if self.maybe(0.12):
            inside += self.comments()
        if self.tags and self.maybe(0.8):
            return f'<article{self.attributes(CONTENT) if self.maybe(0.5) else ""} data-label="main">{inside}</article>'
        return self.wrap("main", CONTENT, inside, "main", always=self.named and self.maybe(0.85))

    def plain_page(self) -> str:
        """A fragment without a layout, or a layout of table cells."""
        pieces = "".join(self.piece() for _ in range(self.rng.randint(1, 6)))
        if self.maybe(0.6):
            inside = self.rng.choice([self.words(1, 12), self.sentences(1, 3), pieces, pieces, f"<h1>{self.words(1, 6)}</h1>{pieces}"])
            inside = f"<{MARK} data-label='main'>{inside}</{MARK}>"
            return self.rng.choice(["<html><body>{}</body></html>", "<body>{}", "<div>{}</div>", "{}", "{}"]).format(inside)
        menu = f"<td data-label='other'>{self.links(MENU_WORDS, 2, 8, 0.3)}</td>"
        cell = f"<td data-label='main'><h1>{self.words(1, 6)}</h1>{pieces}</td>"
        foot = f"<p data-label='other'><small>&copy; {self.words(1, 3)} {self.rng.choice(FOOTER_WORDS)}</small></p>"
        return f"<html><body><table><tr>{menu}{cell}</tr></table>{foot if self.maybe(0.7) else ''}</body></html>"

    def page(self) -> str:
        if self.maybe(0.12):
            return self.plain_page()
        before = [part() for part, share in ((self.notice, 0.25), (self.header, 0.55), (self.menu, 0.6), (self.advert, 0.4), (self.form, 0.1)) if self.maybe(share)]
        after = [part() for part, share in ((self.share, 0.2), (self.comments, 0.3), (self.sidebar, 0.35), (self.advert, 0.2), (self.notice, 0.15), (self.footer, 0.8)) if self.maybe(share)]
        if self.maybe(0.3):
            self.rng.shuffle(before)
        if self.maybe(0.2) and len(after) > 1:
            last = after.pop()
            self.rng.shuffle(after)
            after.append(last)
        if self.maybe(0.15):
            before.append(self.sidebar())
        middle = self.article()
        for _ in range(self.rng.randint(0, 2)):
            names = ["wrapper", "page", "container", "layout", "site", "row", "col", "outer"]
            middle = f'<div class="{self.rng.choice(names)}">{middle}</div>'
        if self.maybe(0.2):
            middle = f"<main>{middle}{after.pop(0) if after and self.maybe(0.5) else ''}</main>"
        title = f"<title>{self.words(2, 6)}</title>"
        return f"<!DOCTYPE html><html><head>{title}</head><body>{''.join(before)}{middle}{''.join(after)}</body></html>"


def labelled_pages(many: int, seed: int) -> list[str]:
    """Pages with `data-label` marks, the same for the same seed."""
    return [Writer(seed * 1_000_003 + k).page() for k in range(many)]

"""Leaf blocks of an HTML page, and generated pages with known main text to learn from."""

from __future__ import annotations

import html
import random
import re
from collections import Counter
from dataclasses import dataclass
from zlib import crc32

import numpy as np

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)"
    r"|[^<]+|<", re.S)
ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>\"']+))?")
XMP_END = re.compile(r"</xmp(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I)
NAME_PARTS = re.compile(r"[a-z]+")
#: Their content is not text of the page, up to the end tag.
RAW = {"script", "style", "title", "textarea", "noscript", "iframe", "noembed", "noframes"}
#: Up to their end tag, or the end of the block around them.
HIDDEN = {"template", "select", "object", "canvas", "audio", "video", "datalist", "annotation", "annotation-xml", "desc", "metadata"}
#: A paragraph that starts in one of these does not end the paragraph around it.
CLOSED_OFF = {"template", "object"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
BLOCK = {"address", "article", "aside", "blockquote", "body", "button", "caption", "center", "dd", "details", "dialog",
         "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6",
         "header", "hgroup", "html", "ins", "label", "legend", "li", "main", "menu", "nav", "ol", "option", "p", "pre",
         "search", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul"}
#: A start tag of the key ends an open element of these, unless a boundary lies between.
ENDS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dd": ({"dd", "dt"}, {"dl"}), "dt": ({"dd", "dt"}, {"dl"}),
        "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
        "option": ({"option"}, {"select"})}

PATH_SLOTS, WORD_SLOTS, NUMBERS = 1024, 2048, 9
#: Elements nested deeper than this count as children of the last one, as in browsers.
DEPTH = 512


@dataclass
class Block:
    path: tuple[str, ...]     # tags and class or id words of the enclosing elements
    text: str
    linked: int               # characters inside links


def path_words(tag: str, attributes: str) -> tuple[str, ...]:
    out = [tag]
    for m in ATTRIBUTE.finditer(attributes):
        name = m[1].lower()
        if name in ("class", "id", "role") and m[2]:
            out += [f"{'.'}{w}" for w in NAME_PARTS.findall(html.unescape(m[2].strip("\"'")).lower())]
        elif name == "hidden" or name == "aria-hidden" and "true" in (m[2] or "") or name == "style" and "display:none" in (m[2] or "").replace(" ", ""):
            out.append("@hidden")
    return tuple(out)


def blocks_of(page: str | None) -> list[Block]:
    """Text runs between the bounds of block elements, in page order.

    Comments, scripts, styles and the like are left out; character references
    are decoded; white space runs become one space; empty runs are dropped.
    Formulas and the text of drawings stay (a drawing outside of any block is
    an ornament of the page and has none), and so does ``xmp`` as it stands.
    Unclosed and stray tags are borne as browsers do in the common cases.
    """
    page = page or ""
    out: list[Block] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    pieces: list[str] = []
    linked, in_link = 0, False
    hidden: list[tuple[str, int]] = []       # open hidden elements, and how many blocks are around them
    deeper: list[str] = []                   # open elements beyond the depth, which no path shows
    beyond: Counter[str] = Counter()         # their tags
    path: tuple[str, ...] | None = None

    def flush() -> None:
        nonlocal linked
        if pieces:
            text = " ".join("".join(pieces).split())
            if text:
                out.append(Block(path if path is not None else tuple(w for _, ws in stack for w in ws), text, linked))
            pieces.clear()
        linked = 0

    def current() -> tuple[str, ...]:
        return tuple(w for _, words in stack for w in words)

    def close(index: int) -> None:
        nonlocal path
        del stack[index:]
        deeper.clear()
        beyond.clear()
        while hidden and hidden[-1][1] > index:
            hidden.pop()
        path = None

    at, end = 0, len(page)
    while at < end:
        m = TOKEN.match(page, at)
        at = m.end()
        tag = m[2] or m[5]
        if tag is None:
            text = m[0]
            if text[0] == "<" and len(text) > 1 or hidden:
                continue                                   # a comment or declaration, or text that is not shown
            if path is None:
                path = current()
            text = html.unescape(text) if "&" in text else text
            pieces.append(text)
            if in_link:
                linked += len(text)
            continue
        tag, closing, attributes = tag.lower(), bool(m[1] or m[4]), m[3] or m[6] or ""
        if tag in RAW and not closing:
            stop = re.compile(rf"</{re.escape(tag)}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I).search(page, at)
            at = stop.end() if stop else end
            if tag not in ("script", "style", "noscript", "title"):
                flush()
        elif tag == "xmp" and not closing:
            stop = XMP_END.search(page, at)
            flush()
            if stack and stack[-1][0] == "p":
                close(len(stack) - 1)
            if not hidden:
                path = (*current(), *path_words(tag, attributes))
                pieces.append(page[at: stop.start() if stop else end])
                linked = len(pieces[0]) if in_link else 0
                flush()
                path = None
            at = stop.end() if stop else end
        elif tag in HIDDEN or tag == "svg" and (closing or not stack):
            if not closing:
                if not attributes.endswith("/"):
                    hidden.append((tag, len(stack)))
            else:
                for i in range(len(hidden) - 1, -1, -1):
                    if hidden[i][0] == tag:
                        around = hidden[i][1]
                        if len(stack) > around:
                            flush()
                            close(around)
                        del hidden[i:]
                        break
        elif tag in ("text", "mtr", "mtd"):
            pieces.append(" ")
        elif tag == "a":
            in_link = not closing
        elif tag in ("br", "hr"):
            pieces.append(" ")
            if tag == "hr":
                flush()
        elif tag in BLOCK:
            if closing and beyond[tag]:                    # closes the last of these, and what is open within
                flush()
                while True:
                    beyond[deeper[-1]] -= 1
                    if deeper.pop() == tag:
                        break
            elif closing:
                found = -1
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] == tag:
                        found = i
                        break
                    if tag == "p" or tag in ENDS and stack[i][0] in ENDS[tag][1]:
                        break
                if found >= 0 or tag == "p":               # other stray end tags are passed over
                    flush()
                    in_link = in_link and tag not in ("li", "div", "nav", "p")
                if found >= 0:
                    close(found)
            else:
                flush()
                if hidden and hidden[-1][0] == "svg":      # blocks break out of a drawing
                    hidden.pop()
                if (stack and stack[-1][0] == "p" and tag not in ("ins", "label", "button")
                        and not (hidden and hidden[-1][0] in CLOSED_OFF and hidden[-1][1] == len(stack))):
                    close(len(stack) - 1)
                if tag in ENDS:
                    for i in range(len(stack) - 1, -1, -1):
                        if stack[i][0] in ENDS[tag][0]:
                            close(i)
                            break
                        if stack[i][0] in ENDS[tag][1]:
                            break
                if len(stack) < DEPTH:
                    stack.append((tag, path_words(tag, attributes)))
                    path = None
                else:
                    deeper.append(tag)
                    beyond[tag] += 1
    flush()
    return out


class Slots(dict):
    """Hash slot of a word, remembered."""

    def __init__(self, size: int):
        super().__init__()
        self.size = size

    def __missing__(self, word: str) -> int:
        if len(self) > 1 << 16:
            self.clear()
        slot = self[word] = crc32(word.encode("utf-8", "surrogatepass")) % self.size
        return slot


def inputs(blocks: list[Block], path_slots: Slots, word_slots: Slots) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray]:
    """Hashed path words, hashed words and plain numbers of each block."""
    paths, words, numbers = [], [], np.empty((len(blocks), NUMBERS), np.float32)
    known: dict[tuple[str, ...], np.ndarray] = {}
    for i, b in enumerate(blocks):
        if b.path not in known:
            known[b.path] = np.fromiter((path_slots[w] for w in b.path or ("",)), np.int64)
        paths.append(known[b.path])
        split = b.text.lower().split(" ")
        words.append(np.fromiter(map(word_slots.__getitem__, split), np.int64, len(split)))
        n = len(b.text)
        numbers[i] = (np.log1p(n) / 8, np.log1p(len(split)) / 6, b.linked / n, b.text[-1] in ".!?:…\"'", b.text.count(",") / len(split),
                      b.text.count(".") / len(split), b.text[0].isupper(), i / len(blocks), (len(blocks) - i) / len(blocks))
    return paths, words, numbers


# ------------------------------------------------------------ generated pages
#: Class and id words, tags and wordings of what surrounds a main text.
ROLES = {
    "menu": (["nav", "menu"], ["nav", "navbar", "menu", "navigation", "breadcrumb", "topnav", "pagination", "toc"],
             ["Home", "About", "Contact", "Products", "Blog", "Login", "Search", "Archive", "Next", "Previous", "Help"]),
    "header": (["header"], ["header", "masthead", "site header", "top", "logo", "branding", "tagline"],
               ["Welcome", "Official site", "Your daily source", "Skip to content", "Sign in"]),
    "footer": (["footer"], ["footer", "site footer", "copyright", "bottom", "legal", "colophon"],
               ["© 2024", "All rights reserved", "Privacy policy", "Terms of use", "Imprint", "Powered by"]),
    "sidebar": (["aside"], ["sidebar", "side", "widget", "related", "popular", "recent posts", "tags", "rail", "secondary"],
                ["Related", "Popular posts", "You may also like", "Read more", "Tags", "Categories", "Follow us"]),
    "notice": (["div", "dialog"], ["cookie", "notice", "alert", "banner notice", "gdpr consent", "popup", "modal", "message", "subscribe"],
               ["We use cookies", "Accept", "Subscribe to our newsletter", "This site uses cookies", "Close", "Please enable scripts"]),
    "advert": (["div", "ins", "aside"], ["ad", "ads", "advert", "advertisement", "sponsor", "promo", "sponsored", "adsense"],
               ["Advertisement", "Sponsored", "Buy now", "Special offer", "Learn more", "Shop today"]),
    "form": (["form"], ["form", "search form", "login form", "contact form", "newsletter form"],
             ["Name", "Email", "Send", "Submit", "Search", "Password", "Your message", "Subscribe"]),
    "comments": (["section", "div", "ol"], ["comments", "comment list", "responses", "discussion", "reviews", "comment thread", "replies"],
                 ["Reply", "says:", "Leave a comment", "3 comments", "Posted by", "Report"]),
    "share": (["div"], ["share", "social", "sharing", "follow"], ["Share", "Tweet", "Like", "Print", "Email this"]),
}
MAIN = ["content", "post", "entry content", "article body", "story", "main", "post content", "text", "page content", "article"]
WORDS = 6000         # different words of a generator's texts
SYLLABLES = ["an", "er", "th", "ion", "en", "es", "re", "ou", "ti", "la", "de", "que", "sch", "un", "ei", "ra", "mo", "ka", "li", "so"]


class Generator:
    """Pages of varied layout: ``page()`` gives the HTML, and the texts of its main blocks and of the others."""

    def __init__(self, seed: int):
        self.rng = np.random.default_rng(seed)
        self.plain = random.Random(seed)
        self.words = ["".join(self.plain.choices(SYLLABLES, k=self.plain.randrange(1, 5))) for _ in range(WORDS)]

    def pick(self, items):
        return self.plain.choice(items)

    def chance(self, p: float) -> bool:
        return self.plain.random() < p

    def word(self) -> str:
        return self.plain.choice(self.words)

    def sentence(self, n: int) -> str:
        words = self.plain.choices(self.words, k=n)
        if n > 6 and self.chance(0.5):
            words[n // 2] += ","
        return " ".join(words).capitalize() + ("." if self.chance(0.85) else "")

    def prose(self) -> str:
        return " ".join(self.sentence(int(self.rng.integers(1, 20))) for _ in range(int(self.rng.geometric(0.35))))

    def element(self, tag: str, words: str, inner: str) -> str:
        how = self.rng.random()
        name = words.replace(" ", self.pick(["-", "_", " "]))
        attribute = f' class="{name}"' if how < 0.6 else f' id="{name}"' if how < 0.8 else ""
        return f"<{tag}{attribute}>{inner}</{tag}>"

    def around(self, role: str) -> str:
        """A part that is not main text; at least its tag or its class names tell."""
        tags, names, texts = ROLES[role]
        tag, name = self.pick(tags), self.pick(names)
        if tag in ("div", "section", "ol", "ins") or self.chance(0.4):
            tag = "div" if self.chance(0.4) else tag
            telling = f'{self.pick(["class", "id"])}="{name.replace(" ", self.pick(["-", " "]))}"'
        else:
            telling = ""
        parts = []
        for _ in range(int(self.rng.geometric(0.4))):
            own = self.pick(texts) if self.chance(0.5) else self.prose() if self.chance(0.5) else self.word().capitalize()
            self.others.append(own)
            if role == "form":
                parts.append(self.pick([f"<label>{own}</label><input name=q>", f"<button>{own}</button>", f"<p>{own}</p>"]))
            elif role == "menu" or self.chance(0.25):
                parts.append(f'<li><a href="/{self.word()}">{own}</a></li>')
            else:
                parts.append(self.pick([f"<p>{own}</p>", f"<div>{own}</div>", f'<div><a href="#">{own}</a></div>', f"<h3>{own}</h3>", f"<h2>{own}</h2>",
                                        f"<h4>{own}</h4>"]))
        inner = "".join(parts)
        if "<li>" in inner:
            inner = f"<ul>{inner}</ul>"
        if role == "advert" and self.chance(0.4):
            own = self.prose()
            self.others.append(own)
            inner = own
        return f"<{tag} {telling}>{inner}</{tag}>"

    def own(self, text: str, tag: str, link: float = 0.0) -> str:
        """An element of the main text, now and then as a link."""
        self.mains.append(text)
        inner = f'<a href="/{self.word()}">{text}</a>' if self.chance(link) else text
        return f"<{tag}>{inner}</{tag}>"

    def short(self) -> str:
        return self.sentence(int(self.rng.integers(1, 7)))

    def part(self) -> str:
        """A list, table or the like of the main text."""
        kind, n = self.pick(["list", "list", "list", "details", "dl", "table", "figure", "pre"]), int(self.rng.integers(1, 6))
        if kind == "list":
            tag, link = self.pick(["ul", "ul", "ol"]), self.pick([0.0, 0.3, 1.0])
            return f"<{tag}>{''.join(self.own(self.short() if self.chance(0.6) else self.prose(), 'li', link) for _ in range(n))}</{tag}>"
        if kind == "details":
            return f"<details>{self.own(self.short(), 'summary')}{''.join(self.own(self.prose(), 'p') for _ in range(n))}</details>"
        if kind == "dl":
            return f"<dl>{''.join(self.own(self.short(), 'dt') + self.own(self.prose(), 'dd') for _ in range(n))}</dl>"
        if kind == "table":
            wide, head = int(self.rng.integers(1, 4)), self.chance(0.6)
            rows = [[self.own(self.short() if self.chance(0.7) else str(int(self.rng.integers(1, 9999))), "th" if head and not i else "td", 0.05)
                     for _ in range(wide)] for i in range(n + 1)]
            caption = self.own(self.short(), "caption") if self.chance(0.3) else ""
            return f"<table>{caption}{''.join('<tr>' + ''.join(r) + '</tr>' for r in rows)}</table>"
        if kind == "figure":
            return f"<figure><img src=x>{self.own(self.short(), 'figcaption')}</figure>"
        return self.own(self.prose(), "pre")

    def opening(self) -> str:
        """Title of the main text, plain or in a header of its own with a line on author and date."""
        title = self.own(self.sentence(int(self.rng.integers(2, 12))), self.pick(["h1", "h1", "h1", "h2"]))
        if self.chance(0.65):
            return title
        by = self.own(self.pick(["By ", "Written by ", "From ", "Published ", ""]) + " ".join(self.word().capitalize() for _ in range(2)),
                      self.pick(["p", "p", "div", "address"]))
        return f"<header>{title}{by if self.chance(0.8) else ''}</header>"

    def main(self) -> str:
        out = []
        if self.chance(0.8):
            out.append(self.opening())
        for _ in range(1 + int(self.rng.geometric(0.12))):
            kind = self.rng.random()
            if kind < 0.62:
                out.append(self.own(self.prose(), "p", 0.03))
            elif kind < 0.67:
                text = self.prose()
                self.mains.append(text)
                out.append(f"<p><b>{text}<br>")
            elif kind < 0.73:
                out.append(self.own(self.prose() if self.chance(0.3) else self.short(), self.pick(["h2", "h2", "h3", "h4"])))
            elif kind < 0.90:
                out.append(self.part())
            elif kind < 0.95:
                text = self.own(self.prose(), "p") if self.chance(0.4) else self.prose()
                if not text.startswith("<"):
                    self.mains.append(text)
                out.append(f"<blockquote>{text}</blockquote>")
            else:
                out.append(self.own(self.prose(), "div"))
            if self.chance(0.07):
                out.append(self.around(self.pick(["advert", "share", "form", "sidebar", "notice"])))
        inner = "".join(out)
        tag = self.pick(["article", "article", "main", "section", "div", "div", "td"])
        if tag in ("article", "main"):
            name = f' class="{self.pick(MAIN)}"' if self.chance(0.4) else ""
        else:
            name = f' {self.pick(["class", "id"])}="{self.pick(MAIN).replace(" ", self.pick(["-", " "]))}"'
        body = f"<{tag}{name}>{inner}</{tag}>"
        return f"<table><tr>{body}</tr></table>" if tag == "td" else f"<main>{body}</main>" if self.chance(0.2) else body

    def page(self) -> tuple[str, set[str], set[str]]:
        self.mains, self.others = [], []
        before = [self.around(r) for r in ("header", "menu", "notice", "advert", "form", "sidebar") if self.chance(0.4)]
        main = self.main()
        after = [self.around(r) for r in ("share", "comments", "sidebar", "advert", "form", "menu", "notice") if self.chance(0.35)]
        after += [self.around("footer")] if self.chance(0.8) else []
        inner = "".join(before) + main + "".join(after)
        for _ in range(int(self.rng.integers(0, 3))):
            inner = self.element("div", self.pick(["wrapper", "container", "page", "row", "layout"]), inner)
        return (f"<!DOCTYPE html><html><head><title>{self.word()}</title></head><body>{inner}</body></html>",
                {" ".join(t.split()) for t in self.mains}, {" ".join(t.split()) for t in self.others})

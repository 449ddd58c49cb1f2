"""Trains the block labeller on generated pages.

``python -m shoplens.llm.html_training`` writes ``html_blocks.npz``.  The
generator mixes page layouts, container names, languages of invented words
and broken markup; every text it writes is known to be main text or not.
Names and short phrases below are ordinary web vocabulary.
"""

from __future__ import annotations

import random

import numpy as np

from shoplens.llm import html_blocks as H

MENU = "menu nav navbar navigation topnav main-menu site-nav breadcrumb breadcrumbs tabs toolbar pagination pager links".split()
HEAD = "header site-header masthead top topbar banner-top logo branding page-header".split()
FOOT = "footer site-footer bottom colophon copyright legal credits page-footer foot".split()
SIDE = "sidebar side aside widget widgets rail related related-posts recommended popular trending more-stories left-col right-col secondary newsletter tags tagcloud author-box share social".split()
NOTE = "notice cookie cookies cookie-notice cookie-banner consent gdpr alert warning message modal popup overlay paywall announcement disclaimer".split()
ADS = "ad ads advert advertisement adverts ad-slot banner sponsor sponsored promo promotion promoted adsense dfp".split()
FORM = "form login signup subscribe search searchbox contact-form poll survey newsletter-form".split()
TALK = "comment comments comment-list commentlist reader-comments user-comments responses replies reply discussion disqus thread reviews".split()
MAIN = "content article post entry story main article-body post-content entry-content text body-text page-content single blog-post main-content".split()
PLAIN = "wrapper container row col inner box section block group page layout wrap holder cell".split()

PHRASES = {
    "menu": "home about contact news sport login register help products services blog archive faq shop careers sitemap",
    "foot": "copyright all rights reserved privacy policy terms of use imprint contact sitemap powered by",
    "note": "we use cookies to improve your experience accept all settings this site uses cookies please agree subscribe to continue reading",
    "ad": "advertisement buy now sponsored limited offer discount sale shop today free shipping order click here",
    "form": "search email name password submit send subscribe sign up your message required field phone address",
    "talk": "reply says wrote great post thanks for sharing i agree posted by anonymous likes report permalink hours ago",
    "side": "related articles read more popular posts share this follow us tags categories recent archives you may also like",
}
SYLLABLES = ("the of and ing tion er re on at en ed an ti or st ar nd to nt le de la que et les ment "
             "der die und ein sch ich ge ver lich heit ung ber el los con por ado cion ra mo na vi ka po lu").split()
ACCENTS = "é è ü ö ä ß ñ ó ê ç".split()


class Page:
    """One generated page: markup and the main texts in it."""

    def __init__(self, rng: random.Random):
        self.rng = rng
        self.truth: list[str] = []
        self.sloppy = rng.random() < 0.3
        pool = SYLLABLES + ACCENTS * rng.randrange(3)
        self.vocabulary = ["".join(rng.choice(pool) for _ in range(rng.choice((1, 1, 2, 2, 3, 4))))
                           for _ in range(rng.randrange(40, 300))]

    def words(self, low: int, high: int) -> str:
        r = self.rng
        out = []
        for k in range(r.randrange(low, high + 1)):
            w = r.choice(self.vocabulary)
            if k == 0 or (out and out[-1].endswith(".")):
                w = w.capitalize()
            out.append(w + (r.random() < 0.08) * "," + (r.random() < 0.06) * ".")
        if out and r.random() < 0.8:
            out[-1] = out[-1].rstrip(",.") + "."
        if r.random() < 0.05:
            mark = r.choice(("***", "###", "%%%", "&amp;&amp;", "!!"))
            out = [w + mark for w in out]
        return " ".join(out)

    def phrase(self, kind: str, low: int, high: int) -> str:
        r = self.rng
        known = PHRASES[kind].split()
        if r.random() < 0.55:
            return self.words(low, high)
        n = r.randrange(low, high + 1)
        out = [r.choice(known) if r.random() < 0.7 else r.choice(self.vocabulary) for _ in range(n)]
        return " ".join(out).capitalize()

    def attrs(self, names: list[str], always: float = 0.85) -> str:
        r = self.rng
        if r.random() > always:
            return ""
        name = r.choice(names)
        if r.random() < 0.2:
            name += f"-{r.randrange(9)}"
        if r.random() < 0.15:
            name += " " + r.choice(PLAIN)
        return f' {r.choice(("class", "class", "id"))}="{name}"'

    def wrap(self, names: list[str], body: str, tags: str = "div div div div section td") -> str:
        tag = self.rng.choice(tags.split())
        if tag == "td":
            return f"<table><tr><td{self.attrs(names, 1)}>{body}</td></tr></table>"
        return f"<{tag}{self.attrs(names, 1)}>{body}</{tag}>"

    def plainly(self, body: str) -> str:
        while self.rng.random() < 0.3:
            body = f"<div{self.attrs(PLAIN, 0.7)}>{body}</div>"
        return body

    # boilerplate ---------------------------------------------------------

    def menu(self) -> str:
        r = self.rng
        items = [self.phrase("menu", 1, 2) for _ in range(r.randrange(3, 10))]
        links = [f'<a href="/{k}">{x}</a>' for k, x in enumerate(items)]
        kind = r.randrange(4)
        if kind == 0:
            body = " | ".join(links)
        elif kind == 1:
            body = "".join(f"<div>{x}</div>" for x in links)
        else:
            end = "" if self.sloppy and r.random() < 0.5 else "</li>"
            body = "<ul>" + "".join(f"<li>{x}{end}" for x in links) + "</ul>"
        return f"<nav{self.attrs(MENU, 0.4)}>{body}</nav>" if r.random() < 0.6 else self.wrap(MENU, body)

    def some(self, kind: str, low: int = 1, high: int = 3) -> str:
        r = self.rng
        tags = r.choice(("p", "p", "div", "li", "span", "h3", "h4", "small"))
        parts = []
        for _ in range(r.randrange(low, high + 1)):
            text = self.phrase(kind, 1, r.choice((3, 8, 30, 60)))
            if r.random() < 0.3:
                text = f'<a href="#">{text}</a>'
            parts.append(text if tags == "span" else f"<{tags}>{text}</{tags}>")
        if tags == "li":
            return "<ul>" + "".join(parts) + "</ul>"
        return " ".join(parts) if tags == "span" else "".join(parts)

    def header(self) -> str:
        r = self.rng
        body = r.choice(("<h1>{}</h1>", "<h2>{}</h2>", "<div>{}</div>", "<a href='/'>{}</a>")).format(self.phrase("menu", 1, 5))
        if r.random() < 0.4:
            body += f"<p>{self.phrase('menu', 2, 12)}</p>"
        if r.random() < 0.4:
            body += self.menu()
        return f"<header{self.attrs(HEAD, 0.4)}>{body}</header>" if r.random() < 0.6 else self.wrap(HEAD, body)

    def footer(self) -> str:
        r = self.rng
        body = self.some("foot") if r.random() < 0.5 else "&copy; " + self.phrase("foot", 2, 25)
        if r.random() < 0.2:
            body += self.menu()
        return f"<footer{self.attrs(FOOT, 0.4)}>{body}</footer>" if r.random() < 0.65 else self.wrap(FOOT, body)

    def side(self) -> str:
        body = self.some("side", 1, 5)
        return (f"<aside{self.attrs(SIDE, 0.5)}>{body}</aside>" if self.rng.random() < 0.5
                else self.wrap(SIDE, body))

    def note(self) -> str:
        return self.wrap(NOTE, self.some("note", 1, 2) if self.rng.random() < 0.5 else self.phrase("note", 3, 40))

    def ad(self) -> str:
        r = self.rng
        body = self.some("ad", 1, 2) if r.random() < 0.4 else self.phrase("ad", 2, 40)
        return (r.random() < 0.3) * "<!-- ad -->" + self.wrap(ADS, body, "div div div div section aside")

    def form(self) -> str:
        r = self.rng
        fields = "".join(r.choice(("<label>{}</label><input name=a>", "<input type=text><button>{}</button>",
                                   "<p>{}</p><textarea></textarea>", "<select><option>{}</option></select>",
                                   "<div>{} <input></div>")).format(self.phrase("form", 1, 8))
                         for _ in range(r.randrange(1, 5)))
        return f"<form{self.attrs(FORM, 0.5)} action='/go'>{fields}<button>{self.phrase('form', 1, 2)}</button></form>"

    def talk(self) -> str:
        r = self.rng
        one = r.choice(("li", "div", "article", "p"))
        parts = []
        for _ in range(r.randrange(1, 8)):
            who = r.choice(("<b>{}</b> ", "<h4>{}</h4>", "<span>{}</span> ", "<div>{}</div>", "")).format(self.phrase("talk", 1, 4))
            body = self.phrase("talk", 3, 50) if r.random() < 0.5 else self.words(4, 80)
            parts.append(f"<{one}{self.attrs(TALK, 0.6)}>{who if one != 'p' else ''}"
                         + (f"<p>{body}</p>" if one in ("li", "div", "article") and r.random() < 0.6 else body) + f"</{one}>")
        body = (f"<h3>{self.phrase('talk', 1, 3)}</h3>" if r.random() < 0.6 else "") + "".join(parts)
        if one == "li":
            body = f"<ol>{body}</ol>"
        if r.random() < 0.3:
            body += self.form()
        return self.wrap(TALK, body, "div div section div aside")

    # main text -----------------------------------------------------------

    def say(self, low: int, high: int) -> str:
        """Markup of one main block; the plain text is noted as truth."""
        r = self.rng
        text = self.words(low, high)
        mark = text
        if r.random() < 0.3 and " " in text:
            a, b = text.split(" ", 1)
            mark = r.choice(("<b>{}</b> {}", "<em>{}</em> {}", '<a href="/x">{}</a> {}', "<strong>{}</strong> {}")).format(a, b)
        if self.sloppy and r.random() < 0.3:
            mark = "<b>" + mark + "<br>"
        self.truth.append(" ".join(H.html.unescape(text).split()))
        return mark

    def article(self, inner) -> str:
        r = self.rng
        title = self.say(1, 14) if r.random() < 0.85 else None
        out = []
        if title:
            tag = r.choice(("h1", "h1", "h2"))
            out.append(f"<header><{tag}>{title}</{tag}></header>" if r.random() < 0.15 else f"<{tag}>{title}</{tag}>")
        n = r.choice((0, 1, 2, 3, 5, 8, 13, 25))
        for k in range(max(n, not title)):
            size = r.choice(((1, 3), (3, 15), (10, 60), (30, 120)))
            kind = r.random()
            if kind < 0.72:
                end = "" if self.sloppy and r.random() < 0.4 else "</p>"
                out.append(f"<p>{self.say(*size)}{end}")
            elif kind < 0.80:
                t = r.choice(("h2", "h3"))
                out.append(f"<{t}>{self.say(1, 8)}</{t}>")
            elif kind < 0.87:
                t = r.choice(("ul", "ol"))
                out.append(f"<{t}>" + "".join(f"<li>{self.say(1, 20)}</li>" for _ in range(r.randrange(1, 6))) + f"</{t}>")
            elif kind < 0.91:
                out.append(f"<blockquote>{self.say(5, 40)}</blockquote>")
            elif kind < 0.94:
                out.append(f"<div>{self.say(*size)}</div>")
            elif kind < 0.96:
                out.append(f"<pre>{self.say(3, 30)}</pre>")
            else:
                out.append("<table>" + "".join("<tr>" + "".join(f"<td>{self.say(1, 6)}</td>" for _ in range(2)) + "</tr>"
                                               for _ in range(r.randrange(1, 4))) + "</table>")
            if r.random() < 0.07:
                out.append(inner())
        body = "".join(out)
        kind = r.random()
        if kind < 0.45:
            return f"<article{self.attrs(MAIN, 0.4)}>{body}</article>"
        if kind < 0.6:
            return f"<main{self.attrs(MAIN, 0.4)}>{body}</main>"
        if kind < 0.92:
            return self.wrap(MAIN, body, "div div div section td")
        return body

    def build(self) -> str:
        r = self.rng
        junk = [self.side, self.note, self.ad, self.form, self.menu]
        before = [f for f in (self.header, self.menu, self.note, self.ad, self.form, self.side) if r.random() < 0.4]
        after = [f for f in (self.talk, self.side, self.ad, self.note, self.form, self.menu, self.talk) if r.random() < 0.35]
        r.shuffle(before)
        r.shuffle(after)
        if r.random() < 0.85:
            after.append(self.footer)
        parts = [self.plainly(f()) for f in before]
        center = self.article(lambda: r.choice(junk)()) if r.random() < 0.97 else ""
        if r.random() < 0.2:
            center = f"<main>{center}{self.talk() if r.random() < 0.4 else ''}</main>"
        parts += [self.plainly(center), *(self.plainly(f()) for f in after)]
        gap = r.choice(("", "", "\n"))
        body = gap.join(parts)
        script = '<script>var t="</p>";go(1);</script>' * (r.random() < 0.5)
        page = f"<!DOCTYPE html><html><head><title>x</title>{script}</head><body>{body}</body></html>"
        if r.random() < 0.1:
            page = page[:r.randrange(len(page) // 2, len(page))]
        return page


def example(seed: int) -> tuple[list[H.Block], np.ndarray]:
    """The blocks of one generated page and which are main text."""
    page = Page(random.Random(seed))
    cut = H.blocks(page.build())
    left: dict[str, int] = {}
    for t in page.truth:
        left[t] = left.get(t, 0) + 1
    label = np.zeros(len(cut))
    for k, b in enumerate(cut):
        hit = left.get(b.text, 0) > 0
        if not hit and k == len(cut) - 1:           # a text cut off by the page's end
            hit = len(b.text) > 3 and any(t.startswith(b.text.split(" <")[0]) for t in left)
        if hit:
            left[b.text] = left.get(b.text, 1) - 1
            label[k] = 1.0
    return cut, label


# -- training -------------------------------------------------------------

def _backward(gates: np.ndarray, state: np.ndarray, lengths: np.ndarray, reverse: bool,
              grad_hidden: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(gradient of gates, gradient of state) of one direction."""
    n, hid = len(gates), H.HIDDEN
    ends = np.cumsum(lengths)
    order = np.argsort(-lengths, kind="stable")
    size = lengths[order]
    begin = (ends - 1)[order] if reverse else (ends - lengths)[order]
    sign = -1 if reverse else 1
    alive = np.searchsorted(-size, -np.arange(size[0]), side="left")
    h = np.zeros((len(lengths), hid))
    c = np.zeros_like(h)
    tape = []
    for t in range(int(size[0])):
        k = alive[t]
        at = begin[:k] + sign * t
        z = gates[at] + h[:k] @ state
        s = H._sigmoid(z[:, :3 * hid])
        g = np.tanh(z[:, 3 * hid:])
        c_new = s[:, hid:2 * hid] * c[:k] + s[:, :hid] * g
        tc = np.tanh(c_new)
        tape.append((at, h[:k], c[:k], s, g, tc))
        h, c = s[:, 2 * hid:] * tc, c_new
    d_gates, d_state = np.zeros((n, 4 * hid)), np.zeros_like(state, dtype="float64")
    dh, dc = np.zeros((0, hid)), np.zeros((0, hid))
    for at, h_old, c_old, s, g, tc in reversed(tape):
        k = len(at)
        dh = np.vstack([dh, np.zeros((k - len(dh), hid))]) + grad_hidden[at]
        dc = np.vstack([dc, np.zeros((k - len(dc), hid))])
        i, f, o = s[:, :hid], s[:, hid:2 * hid], s[:, 2 * hid:]
        dc = dc + dh * o * (1 - tc * tc)
        dz = np.hstack([dc * g * i * (1 - i), dc * c_old * f * (1 - f),
                        dh * tc * o * (1 - o), dc * i * (1 - g * g)])
        d_gates[at] = dz
        d_state += h_old.T @ dz
        dh, dc = dz @ state.T, dc * f
    return d_gates, d_state


def train(pages: int = 20000, epochs: int = 8, batch: int = 48, seed: int = 7) -> H.Weights:
    rng = np.random.default_rng(seed)
    hid = H.HIDDEN
    shapes = {"path": (2, H.PATH_SIZE, 4 * hid), "word": (2, H.WORD_SIZE + H.COUNTS, 4 * hid),
              "state": (2, hid, 4 * hid), "bias": (2, 4 * hid), "out": (2 * hid + 1,)}
    w = {k: rng.normal(0, 0.08, s) for k, s in shapes.items()}
    w["bias"][:, hid:2 * hid] = 1.0
    m = {k: np.zeros(s) for k, s in shapes.items()}
    v = {k: np.zeros(s) for k, s in shapes.items()}
    data = []
    for k in range(pages):
        cut, label = example(k)
        if cut:
            x = np.stack([H.path_vector(b.path) for b in cut])
            y = np.stack([H.word_vector(b, i / len(cut)) for i, b in enumerate(cut)])
            data.append((x, y, label))
    step = 0
    total = epochs * (len(data) // batch)
    for epoch in range(epochs):
        order = rng.permutation(len(data))
        wrong = seen = 0
        for b in range(0, len(order) - batch + 1, batch):
            part = [data[i] for i in order[b:b + batch]]
            lengths = np.array([len(p[2]) for p in part])
            x, y = (np.vstack([p[i] for p in part]).astype("float64") for i in (0, 1))
            label = np.concatenate([p[2] for p in part])
            x = x * (rng.random(x.shape) > 0.1)         # names are not all known
            y[:, :H.WORD_SIZE] *= rng.random((len(y), 1)) > 0.2
            gates = [x @ w["path"][d] + y @ w["word"][d] + w["bias"][d] for d in range(2)]
            sides = [H.run_lstm(gates[d], w["state"][d], lengths, bool(d)) for d in range(2)]
            hidden = np.hstack(sides)
            p = H._sigmoid(hidden @ w["out"][:-1] + w["out"][-1])
            wrong += int(((p >= 0.5) != (label > 0)).sum())
            seen += len(label)
            dp = (p - label) / len(label)
            grad = {k: np.zeros(s) for k, s in shapes.items()}
            grad["out"][:-1], grad["out"][-1] = hidden.T @ dp, dp.sum()
            dh = dp[:, None] * w["out"][None, :-1]
            for d in range(2):
                dg, grad["state"][d] = _backward(gates[d], w["state"][d], lengths, bool(d),
                                                 dh[:, d * hid:(d + 1) * hid])
                grad["path"][d], grad["word"][d], grad["bias"][d] = x.T @ dg, y.T @ dg, dg.sum(0)
            step += 1
            norm = np.sqrt(sum((g * g).sum() for g in grad.values()))
            rate = 0.01 * (1 - step / total) + 0.0003
            for k, g in grad.items():
                g = g * min(1.0, 1.0 / norm)
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.99 * v[k] + 0.01 * g * g
                w[k] -= rate * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.99 ** step)) + 1e-8)
        print(f"epoch {epoch}: {wrong} of {seen} blocks wrong", flush=True)
    return H.Weights(**{k: x.astype("float16") for k, x in w.items()})


def evaluate(w: H.Weights, first: int, count: int) -> tuple[int, int, int]:
    """(wrong blocks, blocks, pages with an error) on other generated pages."""
    model = H.Labeller(H.Weights(*(x.astype("float32") for x in w)))
    wrong = total = pages = 0
    for k in range(first, first + count):
        cut, label = example(k)
        if cut:
            bad = int(((model.scores([cut]) >= 0.5) != (label > 0)).sum())
            wrong, total, pages = wrong + bad, total + len(cut), pages + (bad > 0)
    return wrong, total, pages


if __name__ == "__main__":
    trained = train()
    print("held-out pages:", evaluate(trained, 10**6, 800))
    np.savez_compressed(H.WEIGHTS, **trained._asdict())

"""Personal data: fixed base patterns, and a linear-chain conditional random field for what they miss.

Base kinds (email, ip, card, phone) are found by linear scans that give the leftmost
non-overlapping matches of the patterns below; long runs cost no more than their length.

The field adds spans: phone numbers in national form, spelled-out e-mail addresses, and identity numbers.
It reads tokens (letter runs, digit runs, single signs) in segments around digits, at-signs (also "(at)" in words) and the words "at" and "dot", with
word-shape features of a token and its neighbours hashed into WEIGHTS rows; it is trained by gradient descent on the
likelihood (forward-backward in numpy) from a small labelled table, and decoded by Viterbi over padded batches
of segments. Tokens without any of these within REACH tokens are outside by definition. A
span of the field that touches a base span of any kind, or whose digits don't fit its kind, is dropped: base ones stay.

Defined cases: null text counts as empty and has no spans. Offsets are code points, ends exclusive. Repeated
rows each get their own result. An empty table gives no rows. Extra columns may have any name.
"""

from __future__ import annotations

import hashlib
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C
from .pii_rows import labelled

KINDS = ("email", "ip", "card", "phone", "id")
REACH = 6
LONGEST = 96  # tokens in a segment; longer stretches are cut with an overlap of twice REACH
WEIGHTS = 1 << 13
HANDMADE = 6  # weight of a row labelled by hand
FIELD_KINDS = ("email", "phone", "id")
TAGS = ["O"] + [f"{p}-{k}" for k in FIELD_KINDS for p in "BI"]

# ------------------------------------------------------------------ base patterns

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
DIGITS = re.compile(r"[0-9]+")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if k % 2:
            d = 2 * d - 9 * (d > 4)
        total += d
    return total % 10 == 0


def emails(text: str):
    """An at-sign takes the whole run of local characters before it; the scan never looks at a character twice."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        if start < at and (m := DOMAIN.match(text, at + 1)):
            yield start, m.end()
            done = m.end()
            at = text.find("@", done)
        else:
            done = at + 1
            at = text.find("@", done)


def ips(text: str):
    """Four digit runs joined by single full stops."""
    runs = [m.span() for m in DIGITS.finditer(text)]
    k = 0
    while k + 3 < len(runs):
        four = runs[k : k + 4]
        if all(four[j][1] + 1 == four[j + 1][0] and text[four[j][1]] == "." for j in range(3)):
            parts = [text[a:b].lstrip("0") for a, b in four]
            if all(len(p) <= 3 and int(p or "0") <= 255 for p in parts):
                yield four[0][0], four[3][1]
            k += 4
        else:
            k += 1


def cards(text: str):
    for m in CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and luhn(digits):
            yield m.span()


def phones(text: str):
    for m in PHONE.finditer(text):
        if 8 <= sum(c.isdigit() for c in m[0]) <= 15:
            yield m.span()


BASE = {"email": emails, "ip": ips, "card": cards, "phone": phones}

# ------------------------------------------------------------------ tokens and features

TOKEN = re.compile(r"[A-Za-z]+|[0-9]+|[^\sA-Za-z0-9]")
SPELLED = re.compile(r"[(\[]\s*at\s*[)\]]", re.I)  # an at-sign in words
SAID = re.compile(r"(?<![A-Za-z])(?:at|dot)(?![A-Za-z])", re.I)  # signs of an address as words
CUES = frozenset(
    "phone tel telephone call mobile cell fax ring dial email mail contact write reach ssn passport id number no licence license social security at dot com org net edu gov io info co uk "
    "sms text whatsapp mobil handy telefon telefono movil portable nummer numero hotline voicemail office home work insurance taxpayer passeport ausweis dni nummer order invoice room page total "
    "the a an this that is are was to from me us my your his her or and by with for of in on he she they we you it not if".split()
)


def shape(token: str) -> str:
    if token[0] in "0123456789":  # national numbers start with 0 in most countries
        return f"{'z' if token[0] == '0' and len(token) > 1 else 'd'}{min(len(token), 11)}"
    if token[0].isascii() and token[0].isalpha():
        return ("X" if token[0].isupper() else "x") + ("X" if len(token) > 1 and token.isupper() else "x") * (len(token) > 1)
    return token


def features(tokens: list[str], spaced: list[bool]) -> list[list[int]]:
    """Hashed indicators: shape, cue word and spacing of a token and its neighbours up to three away."""
    plain = [(shape(t), t.lower() if t.lower() in CUES else "", s) for t, s in zip(tokens, spaced, strict=True)]
    edge = ("<>", "", True)
    at = lambda i: plain[i] if 0 <= i < len(plain) else edge
    out = []
    for i in range(len(tokens)):
        names = [f"{k}{at(i + k)[0]}" for k in range(-3, 4)] + [f"{k}c{at(i + k)[1]}" for k in range(-3, 4)] + [f"{k}s{at(i + k)[2]}" for k in (-1, 0, 1, 2)]
        names += [f"{k}p{at(i + k)[0]}{at(i + k + 1)[0]}" for k in (-2, -1, 0, 1)] + [f"t{at(i - 1)[0]}{at(i)[0]}{at(i + 1)[0]}{at(i)[2]}{at(i + 1)[2]}", f"q{at(i)[0]}{at(i + 1)[0]}{at(i + 2)[0]}{at(i + 3)[0]}"]
        out.append([zlib.crc32(n.encode()) % WEIGHTS for n in names])
    return out


N_FEATURES = 24


def segments(text: str):
    """(tokens, spaced, spans) around triggers, at most LONGEST tokens each."""
    spans = [m.span() for m in TOKEN.finditer(text)]
    spelled = {m.start() for signs in (SPELLED, SAID) for m in signs.finditer(text)}
    near = [k for k, (a, _) in enumerate(spans) if text[a] in "@0123456789" or a in spelled]
    out, k = [], 0
    while k < len(near):
        lo, hi = max(0, near[k] - REACH), near[k] + REACH + 1
        while k + 1 < len(near) and near[k + 1] - REACH <= hi:
            k += 1
            hi = near[k] + REACH + 1
        hi = min(hi, len(spans))
        for a in range(lo, max(lo + 1, hi - 2 * REACH), LONGEST - 2 * REACH):
            mine = spans[a : min(a + LONGEST, hi)]
            out.append(([text[x:y] for x, y in mine], [x == 0 or text[x - 1].isspace() for x, _ in mine], mine))
        k += 1
    return out


# ------------------------------------------------------------------ the field


def _scores(w: np.ndarray, feats: np.ndarray, mask: np.ndarray) -> np.ndarray:
    return w[feats].sum(2) * mask[..., None]


def _padded(items: list[list[list[int]]]) -> tuple[np.ndarray, np.ndarray]:
    n = max(len(f) for f in items)
    feats, mask = np.zeros((len(items), n, N_FEATURES), np.int32), np.zeros((len(items), n), bool)
    for k, f in enumerate(items):
        feats[k, : len(f)] = f
        mask[k, : len(f)] = True
    return feats, mask


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis, keepdims=True))).squeeze(axis)


def train(table: list[tuple[str, list[tuple[int, int, str]]]], epochs: int = 60) -> dict:
    """(text, spans) rows -> weights. Full-batch gradient steps on the likelihood, with adaptive rates. Equal segments count as one with a weight."""
    seen_as: dict[tuple, int] = {}
    for text, spans in table:
        for tokens, spaced, where in segments(text):
            tag = ["O"] * len(where)
            for a, b, kind in spans:
                inside = [k for k, (x, y) in enumerate(where) if x >= a and y <= b]
                for j, k in enumerate(inside):
                    tag[k] = f"{'I' if j else 'B'}-{kind}"
            one = (tuple(map(tuple, features(tokens, spaced))), tuple(TAGS.index(t) for t in tag))
            seen_as[one] = seen_as.get(one, 0) + 1
    items, tags = [list(f) for f, _ in seen_as], [t for _, t in seen_as]
    weight = np.array(list(seen_as.values()), float)[:, None, None]
    feats, mask = _padded(items)
    n, m, s = feats.shape[0], feats.shape[1], len(TAGS)
    gold = np.zeros((n, m), np.int64)
    for k, t in enumerate(tags):
        gold[k, : len(t)] = t
    w, move = np.zeros((WEIGHTS, s)), np.zeros((s, s))
    gw, gm = np.full_like(w, 1e-6), np.full_like(move, 1e-6)
    onehot = np.eye(s)[gold] * mask[..., None]
    pairs = mask[:, 1:] & mask[:, :-1]
    flat = feats[mask]
    for _ in range(epochs):
        e = np.zeros((n, m, s))
        e[mask] = w[flat].sum(1)
        alpha, beta = np.zeros((n, m, s)), np.zeros((n, m, s))
        alpha[:, 0] = e[:, 0]
        for t in range(1, m):
            nxt = e[:, t] + _logsum(alpha[:, t - 1, :, None] + move, 1)
            alpha[:, t] = np.where(mask[:, t, None], nxt, alpha[:, t - 1])
        for t in range(m - 2, -1, -1):
            back = _logsum(move[None] + (e[:, t + 1] + beta[:, t + 1])[:, None, :], 2)
            beta[:, t] = np.where(mask[:, t + 1, None], back, 0)
        z = _logsum(alpha[:, -1], 1)
        p = np.exp(np.minimum(alpha + beta - z[:, None, None], 0)) * mask[..., None]
        d = ((p - onehot) * weight)[mask]
        grad = np.stack([np.bincount(flat.ravel(), np.repeat(d[:, k], N_FEATURES), WEIGHTS) for k in range(s)], 1)
        grad += 0.02 * w
        joint = np.exp(np.minimum(alpha[:, :-1, :, None] + move + (e[:, 1:] + beta[:, 1:])[:, :, None, :] - z[:, None, None, None], 0)) * pairs[..., None, None]
        seen = onehot[:, :-1, :, None] * onehot[:, 1:, None, :] * pairs[..., None, None]
        gmove = ((joint - seen) * weight[..., None]).sum((0, 1)) + 0.02 * move
        gw += grad**2
        gm += gmove**2
        w -= 0.3 * grad / np.sqrt(gw)
        move -= 0.3 * gmove / np.sqrt(gm)
    for k, tag in enumerate(TAGS):  # an inside tag follows its own kind only
        if tag[0] == "I":
            for j, before in enumerate(TAGS):
                if before[1:] != tag[1:]:
                    move[j, k] = -1e4
    start = np.array([-1e4 if t[0] == "I" else 0.0 for t in TAGS])
    return {"w": w.astype(np.float32), "move": move.astype(np.float32), "start": start.astype(np.float32)}


def viterbi(model: dict, items: list[list[list[int]]]) -> list[list[int]]:
    """The best tags of each segment, all segments of a batch at once."""
    feats, mask = _padded(items)
    e = _scores(model["w"], feats, mask)
    n, m, s = e.shape
    best, back = e[:, 0] + model["start"], np.zeros((n, m, s), np.int8)
    for t in range(1, m):
        step = best[:, :, None] + model["move"]
        back[:, t] = step.argmax(1)
        best = np.where(mask[:, t, None], step.max(1) + e[:, t], best)
    out = []
    last = best.argmax(1)
    lens = mask.sum(1)
    for k in range(n):
        tags = [int(last[k])]
        for t in range(lens[k] - 1, 0, -1):
            tags.append(int(back[k, t, tags[-1]]))
        out.append(tags[::-1])
    return out


def fits(kind: str, text: str) -> bool:
    digits = sum(c.isdigit() for c in text)
    return {"phone": 7 <= digits <= 15, "id": 7 <= digits <= 15, "email": "dot" in text.lower() or "." in text}[kind]


def can_hold(text: str) -> bool:
    """Whether any part of the text can fit a kind of the field."""
    return "." in text or "dot" in text.lower() or any(map(str.isdigit, text))


#: Kinds of the slots that hold personal data; a run of ten digits is a phone only where the sentence says so.
FILLED = {"p": "phone", "s": "phone", "g": "phone", "u": "phone", "h": "phone", "e": "email", "d": "email", "E": "email", "i": "id", "j": "id"}
UNNAMED = re.compile(r"order|invoice|item|file|^\{h\}")


def labelled_table(seed: int = 3) -> list[tuple[str, list[tuple[int, int, str]]]]:
    """The small labelled table's filled part: sentences with slots, filled from a seeded generator. {p} phone, {s} a short or long one, {g} a long one in one run, {u} one in the national form of one of thirteen
    countries, {h} ten digits in a run, {e} e-mail, {d} one in words without digits, {i} identity number, {j} one with spaces; {w} and {W} are words, {n} and the rest numbers that are none."""
    #: The sentences.
    sentences = [
        "Call {p} today.", "phone: {p}", "Tel. {p}, ask for Ann.", "You can reach me at {p} after noon", "my number is {p}", "Fax {p}", "mobile {p} or {p}", "for help dial {p} now",
        "write to {e} please", "email: {e}", "contact {e} for details", "mail {e} or call {p}.", "my address is {e}, thanks",
        "SSN {i}", "social security number {i} on file", "passport no {i}", "ID number: {i}", "id {i}, issued here", "her ssn is {i}.",
        "the total was {n} in all", "in {y} there were {n} of them", "version {v} was released", "Licensed under CC BY-NC {v}.", "License, Version {v}.", "see page {n} and section {v}",
        "{l} and {l} were there", "chapter {n} of {y}", "at {t} on {y}-{m}-{m}", "about {n} dot matrix lines", "score {n} - {n} at half", "({n}) the item", "room {n}-{n} at the dot",
        "{b} is a mail", "{w} {b} {w}", "+{y} ({a}) {a}-{f} {w}", "{o} {w} {w}", "{w} {w} {o} {w}", "{n} | {n} | {n}", "hash {x} {w}", "{w} {x}", "order {n}-{y}-{n} sent", "ratio {v} to {v}", "{w} {l}.", "isbn {l}", "{w} {w} {l} {w}",
        "Call {s} today.", "call {s}", "phone: {s}", "my number is {s}, ask for Ann", "for help dial {s} now", "Tel. {s}", "she said: ring {s} or {s} after six", "mobile {s} or {s}", "dial {p} or {s}", "call {g}", "phone: {g}",
        "write to {d}", "Please contact {d} for details.", "email: {d}", "my address is {d}, thanks", "{w} or mail {d} and call {p}.", "reach us through {d} today", "{d}", "{d} is my mail", "{d}, {w}", "{W} {w} {d} {w} {w}",
        "pages {a}-{f} of it", "from {y}-{y} in {w}", "lines {a}-{f}", "the {w} {y}-{m}-{m} {w}", "{w} {f}-{f} {w} {w}", "{w} {a}-{f} {w}", "{f} {f} {f} {f} {w}", "{w} {f} {f} units",
        "look at the dot on the {w}", "{w} at a dot of {w} in the {w}", "{W} was at {w}. {W} {w}", "{w} {w} at {w} {w} {w}.", "{w} at {w}.{W} {w}", "the dot {w} at {w} {w}", "{w} at the {w}. {W} {w} at {w}, {w}", "{W} at {w}. {w}", "at {w} the dot and the {w} dot {w}",
        "ring {u}", "Tel: {u}, {W}", "Mobil {u}", "{W}: {u}", "call {u} after six", "phone {u}", "Fax {u}", "her cell is {u}", "Telefon {u} ({W})", "{u} or {u}", "You can get us at {u}.", "{W} {W}, {u}", "Please text {u} instead.", "Handy: {u}", "numero {u}", "{w} {w} {u} {w}.", "home {u}, work {u}", "office: {u}; mobile: {u}",
        "sms {h}", "call {h} now", "phone: {h}", "Text me on {h}.", "whatsapp {h}", "my number is {h}", "Tel {h}", "SSN {j}", "ssn: {j}", "social security number {j}", "insurance number {j}, {W}", "her SSN was {j}.", "taxpayer id {j}",
        "Send a message to {h} to confirm.", "{h} is my cell, {W}", "Text {h} when {w} {w}", "the SSN ({i}) of {W}", "his ssn ({j}) {w}", "ssn {j} {w} {w} {w}", "the insurance number, {j}, {w} {w}", "{W} {W}: {u}, {w}", "{w} {w} ({u})", "({d})", "{W} {W} ({d}) {w} {w}", "({E})", "{w} ({e}) {w}",
        "{m} {m} {m} {m} {m} and {n}", "draw {m} {m} {m} {m} {m} {m}", "sizes {m} {m} {m}", "{W} {m} {m} {m} {w}", "LOOK AT THE DOT OF {W}", "THE {W} AT {W} WAS {W}", "{W} AT {W}. {W}", "weight {a} {a} {w}", "{a} {a} {a} {w}", "number {a} {w} {f} {w}",
        "WRITE TO {E}", "Mail {E} please", "{W}, {E}", "{E} for details", "contact {E}.", "my mail is {E}",
        "on {m} {m} {y} in {w}", "{m} {m} {m} {m} {w}", "row {m} {m} {m} {m} {m}", "order {h} was sent", "invoice {h}", "item {h} {w}", "total {f} {f}", "codes {f} {f} {f}", "{w} 0.{m} and 0.{a}", "{w} {a} {m} {f} {w}", "lot {a} {m} {f} sold", "from {m} to {m} {w}", "the file has {h} bytes", "{h} {w} {w}", "{m}-{m}-{y} {w}", "on page {a} {m} lines", "{W} LOOKED AT {W}", "THE DOT {W} AT {W}",
    ]
    r = np.random.default_rng(seed)
    num = lambda k: "".join(str(int(d)) for d in r.integers(0, 10, k))
    name = lambda: "".join(r.choice(list("abcdefghilmnorstu"), int(r.integers(3, 9))))
    end = lambda: r.choice(["com", "org", "net", "edu", "info", "fr", "se"])
    one = lambda *digits: str(r.choice(digits))
    make = {
        "u": lambda: r.choice([
            f"07{num(3)} {num(6)}", f"020 {num(4)} {num(4)}", f"01{num(2)} {num(3)} {num(4)}",  # United Kingdom
            f"0{one(1, 2, 3, 4, 5, 6, 9)} {num(2)} {num(2)} {num(2)} {num(2)}", f"0{one(1, 4, 6)}.{num(2)}.{num(2)}.{num(2)}.{num(2)}",  # France
            f"01{num(2)} {num(7)}", f"0{num(2)}/{num(7)}", f"0{num(2)} {num(8)}", f"01{num(2)}-{num(7)}",  # Germany
            f"(0{one(2, 3, 7, 8)}) {num(4)} {num(4)}", f"04{num(2)} {num(3)} {num(3)}",  # Australia
            f"{one(6, 9)}{num(2)} {num(2)} {num(2)} {num(2)}", f"6{num(2)} {num(3)} {num(3)}",  # Spain
            f"06 {num(4)} {num(4)}", f"02 {num(7)}", f"3{num(2)} {num(7)}",  # Italy
            f"08-{num(3)} {num(3)} {num(2)}", f"07{one(0, 2, 3, 6)}-{num(3)} {num(2)} {num(2)}",  # Sweden
            f"03-{num(4)}-{num(4)}", f"090-{num(4)}-{num(4)}",  # Japan
            f"9{num(4)} {num(5)}", f"0{num(2)}-{num(8)}",  # India
            f"0{num(2)}-{num(7)}", f"06-{num(8)}",  # Netherlands
            f"{one(1, 2, 3, 4, 5, 6)}{num(1)} {num(3)} {num(2)} {num(2)}", f"5{num(2)} {num(3)} {num(3)}",  # Poland
            f"{one(1, 2, 3)}{num(1)} {num(4)} {num(4)}", f"({num(2)}) 9{num(4)}-{num(4)}",  # Brazil
            f"0{one(2, 3, 9)} {num(3)} {num(2)} {num(2)}", f"04{num(2)} {num(2)} {num(2)} {num(2)}",  # Belgium
        ]),
        "h": lambda: one(2, 3, 4, 5, 6, 7, 8, 9) + num(9), "j": lambda: r.choice([f"{num(3)} {num(2)} {num(4)}", f"{num(3)} {num(3)} {num(3)}"]),
        "E": lambda: r.choice([f"{name()} AT {name()} DOT {end()}", f"{name()}.{name()} AT {name()} DOT {end()}", f"{name()} AT {name()} DOT {end()}".upper(), f"{name()}.{name()} AT {name()} DOT {end()}".upper(), f"{name()}_{name()} AT {name()} DOT {end()}", f"{name()}{num(2)} AT {name()} DOT {end()}"]),
        "p": lambda: r.choice([f"({num(3)}) {num(3)}-{num(4)}", f"{num(3)}-{num(3)}-{num(4)}", f"({num(3)}) {num(3)} {num(4)}", f"{num(3)}.{num(3)}.{num(4)}"]),
        "e": lambda: r.choice([f"{name()} (at) {name()} (dot) com", f"{name()} [at] {name()}.org", f"{name()}{num(2)} at {name()} dot net", f"{name()} (at) {name()}.com"]),
        "s": lambda: r.choice([f"{num(3)}-{num(4)}", f"{num(3)} {num(4)}", f"{num(4)}-{num(4)}", f"{num(4)} {num(4)}", f"00{num(2)} {num(2)} {num(4)} {num(4)}", f"00{num(2)}-{num(3)}-{num(4)}-{num(4)}", f"00{num(2)} {num(3)} {num(3)} {num(3)}"]),
        "d": lambda: r.choice([f"{name()} at {name()} dot {end()}", f"{name()} at {name()} dot {end()}", f"{name()} dot {name()} at {name()} dot {end()}", f"{name()} at {name()} dot {name()} dot {end()}", f"{name()} at {name()}.{end()}"]),
        "g": lambda: f"00{num(int(r.integers(11, 14)))}", "w": name, "W": lambda: name().capitalize(),
        "i": lambda: r.choice([f"{num(3)}-{num(2)}-{num(4)}", num(9), f"{num(3)}-{num(2)}-{num(4)}"]),
        "n": lambda: num(int(r.integers(1, 6))), "y": lambda: f"20{num(2)}", "v": lambda: f"{num(1)}.{num(1)}", "x": lambda: "".join(r.choice(list("0123456789abcdef"), 40)),
        "l": lambda: num(int(r.integers(10, 20))), "t": lambda: f"{num(2)}:{num(2)}", "m": lambda: num(2), "b": lambda: f"{name()}.{num(2)}@mail{num(1)}.example.com", "a": lambda: num(3), "f": lambda: num(4),
        "o": lambda: f"{num(3)}.{num(2)}.{num(3)}.{num(2)}",
    }
    rows = []
    for _ in range(12):
        for sentence in sentences:
            text, spans = "", []
            for part in re.split(r"(\{\w\})", sentence):
                if re.fullmatch(r"\{\w\}", part):
                    got = str(make[part[1]]())
                    if kind := FILLED.get(part[1]) if not (part[1] == "h" and UNNAMED.search(sentence)) else None:
                        spans.append((len(text), len(text) + len(got), kind))
                    text += got
                else:
                    text += part
            rows.append((text, spans))
    return rows


def training_table() -> list[tuple[str, list[tuple[int, int, str]]]]:
    """What the field learns from: filled sentences, and rows labelled by hand, each HANDMADE times."""
    return labelled_table() + HANDMADE * labelled()


# ------------------------------------------------------------------ jobs


def base_spans(text: str) -> list[tuple[str, int, int]]:
    return [(kind, a, b) for kind, find in BASE.items() for a, b in find(text)]


def added_spans(model: dict, texts: list[str], known: list[list[tuple]]) -> list[list[tuple[str, int, int]]]:
    """The field's spans of each text, without those that touch base spans."""
    parts, owner = [], []
    for k, t in enumerate(texts):
        for seg in segments(t):
            if can_hold(t[seg[2][0][0] : seg[2][-1][1]]):
                parts.append(seg)
                owner.append(k)
    out: list[set] = [set() for _ in texts]
    order = sorted(range(len(parts)), key=lambda i: len(parts[i][0]))  # like lengths together: little padding
    for at in range(0, len(order), 512):
        mine = order[at : at + 512]
        for i, tags in zip(mine, viterbi(model, [features(*parts[i][:2]) for i in mine]), strict=True):
            where, k = parts[i][2], owner[i]
            j = 0
            while j < len(tags):
                if TAGS[tags[j]][0] != "B":
                    j += 1
                    continue
                kind, first = TAGS[tags[j]][2:], j
                j += 1
                while j < len(tags) and TAGS[tags[j]] == f"I-{kind}":
                    j += 1
                last = j - 1
                while last > first and not texts[k][where[last][0]].isalnum():  # no kind ends in a sign
                    last -= 1
                a, b = where[first][0], where[last][1]
                if fits(kind, texts[k][a:b]) and not any(a < y and x < b for _, x, y in known[k]):
                    out[k].add((kind, a, b))
    done = []
    for spans in out:  # overlaps can come from segments that share tokens: the longer stays
        kept: list[tuple] = []
        for s in sorted(spans, key=lambda s: (s[1] - s[2], s[1], s[0])):
            if not any(s[1] < y and x < s[2] for _, x, y in kept):
                kept.append(s)
        done.append(kept)
    return done


def joined(spans) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1])))


SPELLED_BYTES = re.compile(SPELLED.pattern.encode().replace(rb"\s", rb"[^!-~]"), re.I)  # lets a few more texts through: other white space is several bytes
TRIGGER_BYTES = np.zeros(256, bool)
TRIGGER_BYTES[[*range(48, 58), 64]] = True


def said(raw: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Where a word "at" or "dot" of one of the texts starts."""
    low = np.concatenate([C.LOWER[raw], np.zeros(3, np.uint8)])
    cut = np.ones(len(raw) + 4, bool)  # no letter just before this byte, or a text's start
    cut[1:] = (low < 97) | (low > 122)
    cut[off] = True
    n = len(raw)
    is_ = lambda word: np.all([low[k : n + k] == ord(c) for k, c in enumerate(word)], axis=0) & cut[:n]
    ends = np.concatenate([cut[1:], [True]])  # no letter at this byte, or a text's start
    ends[off] = True
    return np.flatnonzero((is_("at") & ends[2 : n + 2]) | (is_("dot") & ends[3 : n + 3]))


RESULT = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"


def find(docs: DataFrame) -> DataFrame:
    """doc_id, text -> counts by base kind, digest of the base spans, all spans."""
    shared = docs.sparkSession.sparkContext.broadcast(train(training_table()))
    empty = hashlib.sha256(b"").hexdigest()
    names = ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"]

    def run(batches):
        model = shared.value
        for b in C.chunks(batches, "text"):
            raw, off = C.utf8(b.column("text"))
            marks = np.concatenate([[0], np.cumsum(TRIGGER_BYTES[raw])])
            marks[1:] += np.cumsum(np.bincount([m.start() for m in SPELLED_BYTES.finditer(raw.tobytes())], minlength=len(raw))[: len(raw)])
            marks[1:] += np.cumsum(np.bincount(said(raw, off), minlength=len(raw))[: len(raw)])
            live = np.flatnonzero(np.diff(marks[off]))
            counts, digest, spans = np.zeros((4, b.num_rows), np.int64), [empty] * b.num_rows, [""] * b.num_rows
            texts = [b.column("text")[int(i)].as_py() for i in live]
            base = [base_spans(t) for t in texts]
            for i, known, more in zip(live.tolist(), base, added_spans(model, texts, base), strict=True):
                for kind, _, _ in known:
                    counts[KINDS.index(kind), i] += 1
                digest[i] = hashlib.sha256(joined(known).encode()).hexdigest()
                spans[i] = joined(known + more)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *map(pa.array, counts), pa.array(digest, pa.string()), pa.array(spans, pa.string())], names=names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, RESULT)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find(spark.read.parquet(f"{sf_dir}/documents.parquet"))

"""Personal data: exact patterns, and a character BiLSTM-CRF for other spellings.

The patterns give the base spans, which always stay. The tagger (a bidirectional LSTM over
characters, a CRF over its scores; trained here in numpy from labelled spans) adds what the
patterns miss: values in other spellings, and those that a failed match swallowed. It learns
from a bounded sample of the documents, in whose texts the base spans are the labels and
half of them are respelled. Every spelling has a digit (of any script), an @ or the word
"dot", so the surroundings of those are tagged. Windows overlap; each is decoded by Viterbi,
tags of neighbouring windows are also put end to end, so that a span may be of any length,
and a document's spans are then reconciled: the set of spans that don't overlap with the
highest total confidence is kept.
"""

from __future__ import annotations

import hashlib
import random
import re
import unicodedata
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlstone.llm.common import ids_and_texts, map_arrow, slices

KINDS = ("email", "ip", "card", "phone")
DIGIT_OR_AT = re.compile(r"[0-9@]")
TRIGGER = re.compile(r"\d|[@＠]|\bdot\b", re.IGNORECASE)
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

Span = tuple[int, int, int]  # kind's place in KINDS, start, end


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        total += n if i % 2 == 0 else (2 * n if n < 5 else 2 * n - 9)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """As the pattern finds them, but in linear time: from each @ to the left."""
    end = at = 0
    while (at := text.find("@", max(at, end))) >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(text, at) if start < at else None
        if m:
            yield start, m.end()
            end = m.end()
        at += 1


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[Span]:
    """Ordered by kind, then start."""
    if not DIGIT_OR_AT.search(text):
        return []
    found = [(0, a, b) for a, b in _emails(text)]
    found += [(1, *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split(".") if len(p.lstrip("0")) <= 3) and all(len(p.lstrip("0")) <= 3 for p in m[0].split("."))]
    found += [(2, *m.span()) for m in CARD.finditer(text) if 16 <= len(d := _digits(m[0])) <= 19 and luhn(d)]
    found += [(3, *m.span()) for m in PHONE.finditer(text) if 8 <= len(_digits(m[0])) <= 15]
    return found


# ---- the tagger

TAGS = 1 + 2 * len(KINDS)  # O, then B and I of each kind
_CLASSES = {c: i + 2 for i, c in enumerate("abcdefghijklmnopqrstuvwxyz")} | {c: i + 28 for i, c in enumerate(".-+@()_% \n:/,\"'=[]")} | {str(d): 46 for d in range(10)}
PAD, OTHER, N_CLASSES = 0, 1, 47
WINDOW, STRIDE, REACH = 96, 48, 32


def _class(c: str) -> int:
    """Of a character: that of its plain form; digits are one class."""
    if c in _CLASSES:
        return _CLASSES[c]
    plain = unicodedata.normalize("NFKC", c).lower()
    return _CLASSES["0"] if c.isdecimal() else _CLASSES.get(plain, _CLASSES.get(c.lower(), OTHER))


class _Codes(dict):
    def __missing__(self, c: str) -> int:
        code = self[c] = _class(c)
        return code


_codes = _Codes()


def encode(text: str) -> list[int]:
    return list(map(_codes.__getitem__, text))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _lse(x: np.ndarray, axis: int) -> np.ndarray:
    m = x.max(axis=axis, keepdims=True)
    return np.squeeze(m, axis) + np.log(np.exp(x - m).sum(axis=axis))


@dataclass
class Tagger:
    """Parameters by name: per direction (f, b) table E, recurrence U; output W, bias; the
    CRF's transitions A."""

    p: dict[str, np.ndarray]

    @classmethod
    def new(cls, hidden: int = 16, seed: int = 7) -> Tagger:
        r = np.random.default_rng(seed)
        p = {}
        for d in "fb":
            p["E" + d] = r.normal(0, 0.3, (N_CLASSES, 4 * hidden))
            p["E" + d][:, hidden : 2 * hidden] += 1.0
            p["U" + d] = r.normal(0, 0.3 / hidden**0.5, (hidden, 4 * hidden))
        p["W"], p["bias"], p["A"] = r.normal(0, 0.3, (2 * hidden, TAGS)), np.zeros(TAGS), np.zeros((TAGS, TAGS))
        for to in range(2, TAGS, 2):  # I of a kind follows only its B or I
            p["A"][[t for t in range(TAGS) if t not in (to - 1, to)], to] = -8.0
        return cls(p)

    def _lstm(self, x: np.ndarray, d: str, keep: list | None = None) -> np.ndarray:
        e, u = self.p["E" + d], self.p["U" + d]
        n, steps = x.shape
        hid = u.shape[0]
        h, c = np.zeros((n, hid)), np.zeros((n, hid))
        out = np.empty((steps, n, hid))
        for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
            z = e[x[:, t]] + h @ u
            i, f, o = np.split(_sigmoid(z[:, : 3 * hid]), 3, axis=1)
            g = np.tanh(z[:, 3 * hid :])
            before, c = c, f * c + i * g
            tc = np.tanh(c)
            if keep is not None:
                keep.append((t, h, before, i, f, o, g, tc))
            h = o * tc
            out[t] = h
        return out

    def emissions(self, x: np.ndarray, keep: dict | None = None) -> np.ndarray:
        """(steps, windows, TAGS)"""
        hs = [self._lstm(x, d, None if keep is None else keep.setdefault(d, [])) for d in "fb"]
        both = np.concatenate(hs, axis=2)
        if keep is not None:
            keep["h"] = both
        return both @ self.p["W"] + self.p["bias"]

    def gradients(self, x: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean negative log-likelihood of the tag paths y and its gradients."""
        keep: dict = {}
        s, a = self.emissions(x, keep), self.p["A"]
        steps, n, _ = s.shape
        alpha, beta = np.empty_like(s), np.zeros_like(s)
        alpha[0] = s[0]
        for t in range(1, steps):
            alpha[t] = s[t] + _lse(alpha[t - 1][:, :, None] + a, 1)
        for t in range(steps - 2, -1, -1):
            beta[t] = _lse(a[None] + (s[t + 1] + beta[t + 1])[:, None, :], 2)
        z = _lse(alpha[-1], 1)
        ds = np.exp(alpha + beta - z[None, :, None])
        da = np.zeros_like(a)
        for t in range(1, steps):
            da += np.exp(alpha[t - 1][:, :, None] + a + (s[t] + beta[t])[:, None, :] - z[:, None, None]).sum(0)
        rows = np.arange(n)
        gold = sum(s[t, rows, y[:, t]] for t in range(steps)) + sum(a[y[:, t - 1], y[:, t]] for t in range(1, steps))
        for t in range(steps):
            ds[t, rows, y[:, t]] -= 1
            if t:
                np.subtract.at(da, (y[:, t - 1], y[:, t]), 1)
        ds, grads = ds / n, {"A": da / n}
        grads["W"], grads["bias"] = np.einsum("tnh,tnk->hk", keep["h"], ds), ds.sum((0, 1))
        dh_all = ds @ self.p["W"].T
        hid = dh_all.shape[2] // 2
        for d, part in (("f", dh_all[:, :, :hid]), ("b", dh_all[:, :, hid:])):
            u = self.p["U" + d]
            de, du = np.zeros_like(self.p["E" + d]), np.zeros_like(u)
            dh, dc = np.zeros((n, hid)), np.zeros((n, hid))
            for t, h, before, i, f, o, g, tc in reversed(keep[d]):
                dh = dh + part[t]
                dc = dc + dh * o * (1 - tc * tc)
                dz = np.concatenate([dc * g * i * (1 - i), dc * before * f * (1 - f), dh * tc * o * (1 - o), dc * i * (1 - g * g)], axis=1)
                np.add.at(de, x[:, t], dz)
                du += h.T @ dz
                dh, dc = dz @ u.T, dc * f
            grads["E" + d], grads["U" + d] = de, du
        return float((z - gold).mean()), grads

    def decode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Best tag paths (windows, steps) and every character's marginal of its tag."""
        s, a = self.emissions(x), self.p["A"]
        steps, n, k = s.shape
        best, back = s[0].copy(), np.empty((steps, n, k), np.int8)
        alpha, beta = np.empty_like(s), np.zeros_like(s)
        alpha[0] = s[0]
        for t in range(1, steps):
            moved = best[:, :, None] + a
            back[t] = moved.argmax(1)
            best = s[t] + moved.max(1)
            alpha[t] = s[t] + _lse(alpha[t - 1][:, :, None] + a, 1)
        for t in range(steps - 2, -1, -1):
            beta[t] = _lse(a[None] + (s[t + 1] + beta[t + 1])[:, None, :], 2)
        path, rows = np.empty((n, steps), np.int8), np.arange(n)
        path[:, -1] = best.argmax(1)
        for t in range(steps - 1, 0, -1):
            path[:, t - 1] = back[t][rows, path[:, t]]
        marginal = np.exp(alpha + beta - _lse(alpha[-1], 1)[None, :, None])
        return path, np.take_along_axis(marginal.transpose(1, 0, 2), path[:, :, None].astype(int), 2)[:, :, 0]


Example = tuple[str, list[Span]]


def train(examples: list[Example], steps: int = 360, batch: int = 48, rate: float = 0.02, seed: int = 7) -> Tagger:
    """Adam on labelled spans; texts are cut or padded to one window each."""
    tagger, r = Tagger.new(seed=seed), np.random.default_rng(seed)
    x, y = np.zeros((len(examples), WINDOW), int), np.zeros((len(examples), WINDOW), int)
    for row, (text, spans) in enumerate(examples):
        codes = encode(text)[:WINDOW]
        x[row, : len(codes)] = codes
        for kind, start, end in spans:
            y[row, start:end] = 2 + 2 * kind
            if start < WINDOW:
                y[row, start] = 1 + 2 * kind
    m = {k: np.zeros_like(v) for k, v in tagger.p.items()}
    v = {k: np.zeros_like(w) for k, w in tagger.p.items()}
    for step in range(1, steps + 1):
        at = r.integers(0, len(examples), batch)
        _, grads = tagger.gradients(x[at], y[at])
        norm = max(1.0, sum(float((g * g).sum()) for g in grads.values()) ** 0.5 / 5)
        for k, g in grads.items():
            g = g / norm
            m[k], v[k] = 0.9 * m[k] + 0.1 * g, 0.99 * v[k] + 0.01 * g * g
            tagger.p[k] -= rate * (1 - step / (steps + 1)) * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-8)
    return tagger


def labelled_examples(n: int = 2400, seed: int = 11) -> list[Example]:
    """Made-up sentences with labelled spans in usual and unusual spellings, and numbers and
    keys that are no personal data."""
    r = random.Random(seed)
    digits = lambda k: "".join(r.choice("0123456789") for _ in range(k))
    word = lambda: "".join(r.choice(("th", "er", "an", "on", "de", "la", "que", "sch", "ei", "o", "a", "men", "t")) for _ in range(r.randint(1, 4)))
    name = lambda: "".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(r.randint(2, 8)))

    def card() -> str:
        body = r.choice("3456") + digits(r.choice((14, 14, 14, 13)))
        body += next(d for d in "0123456789" if luhn(body + d))
        sep = r.choice(("", "", " ", "-", "."))
        return sep.join(body[i : i + 4] for i in range(0, len(body), 4))

    def phone() -> str:
        a, b, c = digits(3), digits(3), digits(4)
        return r.choice((f"+{digits(1)} ({a}) {b}-{c}", f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"+{digits(2)} {digits(2)} {c} {digits(4)}", f"00{digits(2)} {digits(3)} {digits(3)} {digits(3)}"))

    def email() -> str:
        user = name() + r.choice(("", ".", "_", "")) + r.choice((name(), digits(2), ""))
        return user.strip("._") + r.choice(("@", "@", "@", " @ ", "[@]")) + name() + r.choice((".com", ".org", ".example.net", ".de"))

    def nothing() -> str:
        return r.choice((digits(r.randint(1, 5)), f"{digits(1)}.{digits(1)}.", f"{digits(2)}%", f"v{digits(1)}.{digits(2)}", "".join(r.choice("0123456789abcdef") for _ in range(r.randint(16, 40))), "AKIA" + "".join(r.choice("ABCDEFGHJKLMNPQRSTUVWXYZ0123456789") for _ in range(16)), f"token={name()}{digits(4)}{name()}", f"20{digits(2)}-{digits(2)}-{digits(2)}", f"{digits(2)}:{digits(2)}", f"@{name()}", f"{digits(1)},{digits(3)},{digits(3)}", f"${digits(3)}.{digits(2)}"))

    made = (email, lambda: ".".join(str(r.randint(0, 255)) for _ in range(4)), card, phone)
    out = []
    for _ in range(n):
        text, spans = "", []
        while len(text) < r.randint(30, WINDOW):
            draw = r.random()
            if draw < 0.18 and len(text) < WINDOW - 30:
                kind = r.randrange(len(KINDS))
                value = made[kind]()
                spans.append((kind, len(text), len(text) + len(value)))
                text += value
            elif draw < 0.34:
                text += nothing()
            else:
                text += word()
            text += r.choice((" ", " ", " ", ", ", ". ", ".\n", "### ", "$$$ ", '" '))
        out.append((text, [s for s in spans if s[1] < WINDOW]))
    return out


def respelled(kind: int, value: str, r: random.Random) -> str:
    """The same value in a spelling that the patterns don't match."""
    if kind == 0:
        user, _, domain = value.partition("@")
        at, dot = r.choice(((" at ", " dot "), (" (at) ", " (dot) "), ("[at]", "[dot]"), (" @ ", "."), ("[@]", "."), ("＠", "."), (" AT ", " DOT ")))
        return user.replace(".", dot if "dot" in dot.lower() else ".") + at + domain.replace(".", dot)
    digits = _digits(value)
    if kind == 1:
        spelling = r.choice(("[.]", " . ", "(.)", "[dot]", " dot "))
        return spelling.join(value.split("."))
    if kind == 2:
        cut = r.choice(((4, "."), (4, "  "), (4, " - "), (4, "_"), (8, "/"), (4, "wide")))
        wide = "".join(chr(ord(d) + 0xFEE0) for d in digits)
        return wide if cut[1] == "wide" else cut[1].join(digits[i : i + cut[0]] for i in range(0, len(digits), cut[0]))
    own, last = digits[:-10], (digits[-10:-7], digits[-7:-4], digits[-4:])
    if len(last[0]) < 3:
        return "(" + digits[:2] + ") " + digits[2:5] + "-" + digits[5:]
    return r.choice(("({}) {}-{}", "{}-{}-{}", "{}.{}.{}", "00" + own + " {} {} {}", own + "-{}-{}-{}", "({}){}.{}")).format(*last)


def corpus_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", most_rows: int = 2_000, most_chars: int = 20_000) -> list[str]:
    """Texts to learn from: of documents of up to ``most_chars`` characters with a digit or
    an @ those of ``most_rows`` ids at most, by smallest hash."""
    rows = ids_and_texts(docs, id_col, text_col).where(f"doc_id IS NOT NULL AND text RLIKE '[0-9@]' AND length(text) <= {most_chars}")
    ids = rows.select("doc_id", F.xxhash64("doc_id", F.lit("personal data")).alias("h")).orderBy("h", "doc_id").limit(most_rows).distinct()
    return [r.text for r in rows.join(F.broadcast(ids), "doc_id").groupBy("h", "doc_id").agg(F.min("text").alias("text")).orderBy("h", "doc_id").collect()]


def corpus_examples(texts: list[str], share: float = 0.6, seed: int = 13) -> list[Example]:
    """A window around each base span of the texts, with its base spans as labels; a
    ``share`` of them respelled."""
    r, out = random.Random(seed), []
    for text in texts:
        spans = sorted({(a, b, k) for k, a, b in base_spans(text)})
        spans = [s for i, s in enumerate(spans) if i == 0 or s[0] >= spans[i - 1][1]]
        for i, (start, end, _) in enumerate(spans):
            first = max(0, start - r.randint(5, 45))
            if any(a < first < b for a, b, _ in spans):
                first = start
            made, labels, at = "", [], first
            for a, b, kind in spans[i:] if first >= (spans[i - 1][1] if i else 0) else []:
                if len(made) + a - at > WINDOW - 8:
                    break
                value = respelled(kind, text[a:b], r) if r.random() < share else text[a:b]
                made += text[at:a]
                labels.append((kind, len(made), len(made) + len(value)))
                made, at = made + value, b
            made += text[at : at + 60]
            labels = [s for s in labels if s[1] < WINDOW]
            if labels:
                out.append((made, labels))
    return out


def windows_of(text: str) -> list[list[tuple[int, int]]]:
    """Regions around every trigger (and what no blank parts from it), each cut into
    overlapping windows."""
    regions: list[list[int]] = []
    for m in TRIGGER.finditer(text):
        low = regions[-1][1] if regions else 0
        if regions and m.end() + REACH <= low:
            continue
        a, b = max(0, m.start() - REACH), min(len(text), m.end() + REACH)
        while a > low and not text[a - 1].isspace():
            a -= 1
        while b < len(text) and not text[b].isspace():
            b += 1
        a, b = max(low, a - 1), min(len(text), b + 1)  # the blank shows that a span isn't cut
        if regions and a <= low:
            regions[-1][1] = b
        else:
            regions.append([a, b])
    return [[(s, min(s + WINDOW, b)) for s in range(a, max(a + 1, b - WINDOW + STRIDE), STRIDE)] for a, b in regions]


_AT = re.compile(r"\s*[\[({<]?\s*(?:@|\bat\b)\s*[\])}>]?\s*", re.IGNORECASE)
_DOT = re.compile(r"\s*[\[({<]?\s*(?:\.|\bdot\b)\s*[\])}>]?\s*", re.IGNORECASE)
_EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")


def plausible(kind: int, value: str) -> bool:
    """What a span of the tagger has to hold, in plain spelling, to be one of its kind."""
    value = unicodedata.normalize("NFKC", value)
    value = "".join(str(unicodedata.decimal(c)) if c.isdecimal() else c for c in value)
    n = len(_digits(value))
    if kind == 0:
        return bool(_EMAIL.fullmatch(_DOT.sub(".", _AT.sub("@", value))))
    if kind == 1:
        return bool(re.fullmatch(r"[0-9]{1,3}(\.[0-9]{1,3}){3}", plain := _DOT.sub(".", value))) and all(int(p) <= 255 for p in plain.split("."))
    if kind == 2:
        return 16 <= n <= 19 and bool(re.fullmatch(r"[0-9][0-9 ._/-]*[0-9]", value)) and luhn(_digits(value))
    return 9 <= n <= 15 and bool(re.fullmatch(r"[+0-9(][0-9 ().-]+[0-9]", value)) and len(re.findall(r"[0-9]+", value)) >= 3


def reconcile(spans: list[tuple[int, int, int, float]], taken: list[Span]) -> list[Span]:
    """Of (kind, start, end, confidence) of all windows of a text, the set without overlaps
    (also with ``taken``) of the highest total confidence."""
    held = sorted((a, b) for _, a, b in taken)
    starts, reach = [a for a, _ in held], [-1, *accumulate((b for _, b in held), max)]
    best: dict[Span, float] = {}
    for kind, start, end, sure in spans:
        if reach[bisect_left(starts, end)] <= start:
            best[kind, start, end] = max(sure, best.get((kind, start, end), 0.0))
    order = sorted(best, key=lambda s: (s[2], s[1], s[0]))
    ends, total, last = [], [0.0], [-1]  # last: the span that the best set of the first i ends with
    for i, span in enumerate(order):
        with_it = total[bisect_right(ends, span[1])] + best[span]
        better = with_it > total[-1]
        total.append(with_it if better else total[-1])
        last.append(i if better else last[-1])
        ends.append(span[2])
    chosen, i = [], last[-1]
    while i >= 0:
        chosen.append(order[i])
        i = last[bisect_right(ends, order[i][1])]
    return chosen[::-1]


def _tagged(tags: np.ndarray, sure: np.ndarray, at: int) -> Iterator[tuple[int, int, int, float]]:
    """(kind, start, end, confidence) of the spans in a row of tags that begins at ``at``."""
    for s in np.flatnonzero(tags % 2 == 1).tolist():
        e = s + 1
        while e < len(tags) and tags[e] == tags[s] + 1:
            e += 1
        yield int(tags[s]) // 2, at + s, at + e, float(sure[s:e].mean())


def added_spans(tagger: Tagger, texts: list[str], base: list[list[Span]], least: float = 0.6, lot: int = 512) -> list[list[Span]]:
    """Spans beyond ``base`` for each text. A window names the spans that lie inside it;
    those that its edges cut come from the tags of a whole region, each character's from the
    window that has it nearest to its middle."""
    regions = [(k, windows) for k, t in enumerate(texts) for windows in windows_of(t)]
    at = [(r, a, b) for r, (_, windows) in enumerate(regions) for a, b in windows]
    found: list[list] = [[] for _ in texts]
    edge = (WINDOW - STRIDE) // 2
    parts: list[tuple[np.ndarray, np.ndarray]] = []  # of the region that is being read

    def take(k: int, spans: Iterator[tuple[int, int, int, float]], first: int, last: int) -> None:
        for kind, s, e, sure in spans:
            cut = (s == first and first > 0) or (e == last and last < len(texts[k]))
            if not cut and sure >= least and plausible(kind, texts[k][s:e]):
                found[k].append((kind, s, e, sure))

    for first in range(0, len(at), lot):
        some = at[first : first + lot]
        x = np.zeros((len(some), WINDOW), int)
        for row, (r, a, b) in enumerate(some):
            x[row, : b - a] = encode(texts[regions[r][0]][a:b])
        path, sure = tagger.decode(x)
        for row, (r, a, b) in enumerate(some):
            k, windows = regions[r]
            tags, own = path[row, : b - a], sure[row, : b - a]
            take(k, _tagged(tags, own, a), a, b)
            if len(windows) > 1:
                low, high = 0 if a == windows[0][0] else edge, b - a if (a, b) == windows[-1] else edge + STRIDE
                parts.append((tags[low:high], own[low:high]))
                if (a, b) == windows[-1]:
                    start = windows[0][0]
                    take(k, _tagged(np.concatenate([t for t, _ in parts]), np.concatenate([c for _, c in parts]), start), start, b)
                    parts = []
    return [reconcile(f, b) if f else [] for f, b in zip(found, base, strict=True)]


def joined(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans))


def find(docs: DataFrame, tagger: Tagger, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, n_email, n_ip, n_card, n_phone (base spans),
    base_sha256, spans (base and added; code points, end exclusive).

    Null and empty texts have no spans: zeros, the digest of nothing and ''. Repeated rows
    are searched each, a null doc_id stays null, an empty table gives no rows, further
    columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            texts = [t or "" for t in batch.column(1).to_pylist()]
            base = [base_spans(t) for t in texts]
            more = added_spans(tagger, texts, base)
            counts = [[sum(s[0] == k for s in b) for b in base] for k in range(len(KINDS))]
            shas = [hashlib.sha256(joined(b).encode()).hexdigest() for b in base]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), *[pa.array(c, pa.int64()) for c in counts], pa.array(shas, pa.string()), pa.array([joined(b + m) for b, m in zip(base, more, strict=True)], pa.string())],
                names=["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans"],
            )

    return map_arrow(ids_and_texts(docs, id_col, text_col), run, "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string")

"""Personal data: exact base patterns, and a character-level bidirectional LSTM
with CRF transitions that adds spans the patterns miss.

Base spans follow four fixed patterns with their checks and always stay. The
network is trained in numpy, on the driver and from a fixed seed, on labelled
spans: texts made by `labelled_texts`, in which written-out or oddly spaced
emails, addresses, card and phone numbers are marked, beside look-alikes
(dates, versions, keys, prices) that are not. Its few thousand weights are
broadcast.

Texts are read whole. Windows of WINDOW characters overlap by half; a window
without a digit and without an at-sign (or its bracketed form) can hold no span of
the four kinds and needs no network. The emissions of the others are blended by
closeness to each window's middle, and one Viterbi pass over each stretch of
touching windows reconciles them into a single labelling. An added span must
pass its kind's check and touch no base span.

Null and empty texts have no spans; repeated rows give repeated results; an empty
table gives an empty result. A stretch is decoded PART characters at a time, so a very
long text costs time in proportion to its length, and ten bytes a character beside it.
Extra columns pass through where asked for; one with the name of a result's column
gives way to it.
"""

from __future__ import annotations

import bisect
import hashlib
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import carried

KINDS = ("email", "ip", "card", "phone")
# The base patterns. A run of digits is entered at its start only,
# which changes no match and keeps long runs linear.
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else 2 * d - 9 * (d > 4)
    return total % 10 == 0


def _emails(text: str) -> list[tuple[str, int, int]]:
    out, at, done = [], text.find("@"), 0
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            out.append(("email", start, m.end()))
            done = m.end()
        else:
            done = at + 1  # no match can reach back over this sign
        at = text.find("@", max(at + 1, done))
    return out


def base_spans(text: str | None) -> list[tuple[str, int, int]]:
    """(kind, start, end) by kind as listed, then start; code points."""
    if not text:
        return []
    out = _emails(text) if "@" in text else []
    if not _DIGIT.search(text):
        return out
    out += [("ip", *m.span()) for m in _IP.finditer(text) if all(len(p := x.lstrip("0")) <= 3 and int(p or 0) <= 255 for x in m[0].split("."))]
    for m in _CARD.finditer(text):
        digits = _NOT_DIGIT.sub("", m[0])
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    if "+" in text:
        out += [("phone", *m.span()) for m in _PHONE.finditer(text) if 9 <= len(_NOT_DIGIT.sub("", m[0])) <= 15]
    return out


def spans_text(spans) -> str:
    order = {k: i for i, k in enumerate(KINDS)}
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (order[s[0]], s[1], s[2])))


# --- the network ---------------------------------------------------------

WINDOW = 64
PART = 256 * WINDOW
HIDDEN = 16
EMBED = 10
TAGS = 1 + 2 * len(KINDS)  # outside, then begin and inside of each kind
_CHARS = "0123456789@.+-()[]{}<>/:;,'\"=_#%&*|!?\\ \n\t"
_MARKS = re.compile(r"[0-9@]|(?i:[\[(]\s?at\s?[\])])")


def _char_table() -> np.ndarray:
    """Letters of either case are kept apart, other characters fall into classes."""
    table = np.full(1 << 16, 1, np.int64)
    for c in range(128):
        if chr(c).isalpha():
            table[c] = 2 + (ord(chr(c).lower()) - 97)
    for c in range(128, 1 << 16):
        if not 0xD800 <= c < 0xE000 and chr(c).isalpha():
            table[c] = 28
    for i, ch in enumerate(_CHARS):
        table[ord(ch)] = 29 + (0 if ch.isdigit() else i - 9)
    return table


_TABLE = _char_table()
_VOCAB = 29 + len(_CHARS) - 9


def char_codes(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "replace"), "<u4")
    return _TABLE[np.minimum(points, (1 << 16) - 1)]


def _sigmoid(x):
    return 1 / (1 + np.exp(-x))


def _logsum(x, axis):
    top = x.max(axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis))


@dataclass
class CharTagger:
    """Weights: embedding, two LSTM directions (input, recurrent, bias), output, CRF."""

    w: dict[str, np.ndarray]

    @classmethod
    def fresh(cls, seed: int) -> CharTagger:
        r = np.random.default_rng(seed)
        w = {"embed": r.normal(0, 0.5, (_VOCAB, EMBED)), "out": r.normal(0, 0.2, (2 * HIDDEN, TAGS)), "out_b": np.zeros(TAGS), "crf": np.zeros((TAGS, TAGS)), "first": np.zeros(TAGS)}
        for d in "fb":
            w |= {f"in_{d}": r.normal(0, 0.3, (EMBED, 4 * HIDDEN)), f"rec_{d}": r.normal(0, 0.2, (HIDDEN, 4 * HIDDEN)), f"bias_{d}": np.zeros(4 * HIDDEN)}
            w[f"bias_{d}"][HIDDEN : 2 * HIDDEN] = 1.0
        w["out_b"][0] = 2.0
        return cls(w)

    def _lstm(self, x: np.ndarray, d: str, keep: bool):
        n, steps, _ = x.shape
        h, c = np.zeros((n, HIDDEN), x.dtype), np.zeros((n, HIDDEN), x.dtype)
        given, hs, kept = x @ self.w[f"in_{d}"] + self.w[f"bias_{d}"], np.empty((n, steps, HIDDEN), x.dtype), []
        for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
            z = given[:, t] + h @ self.w[f"rec_{d}"]
            gates, cand = _sigmoid(z[:, : 3 * HIDDEN]), np.tanh(z[:, 3 * HIDDEN :])
            i, f, o = gates[:, :HIDDEN], gates[:, HIDDEN : 2 * HIDDEN], gates[:, 2 * HIDDEN :]
            before, last_h = c, h
            c = f * c + i * cand
            tanh_c = np.tanh(c)
            h = o * tanh_c
            hs[:, t] = h
            if keep:
                kept.append((t, i, f, o, cand, before, tanh_c, last_h))
        return hs, kept

    def emissions(self, codes: np.ndarray) -> np.ndarray:
        x = self.w["embed"][codes]
        both = np.concatenate([self._lstm(x, "f", False)[0], self._lstm(x, "b", False)[0]], 2)
        return both @ self.w["out"] + self.w["out_b"]

    def viterbi(self, scores: np.ndarray) -> np.ndarray:
        return self.decode([scores])

    def decode(self, parts) -> np.ndarray:
        """The best labelling of scores that come in parts; a byte for each label and place is kept."""
        best, kept = None, []
        for scores in parts:
            back = np.zeros(scores.shape, np.int8)
            for t in range(len(scores)):
                if best is None:
                    best = scores[t] + self.w["first"]
                    continue
                paths = best[:, None] + self.w["crf"]
                back[t] = paths.argmax(0)
                best = paths.max(0) + scores[t]
            kept.append(back)
        back = np.concatenate(kept)
        tags = np.empty(len(back), np.int8)
        tags[-1] = best.argmax()
        for t in range(len(back) - 1, 0, -1):
            tags[t - 1] = back[t, tags[t]]
        return tags

    # training: exact gradients of the CRF's log-likelihood through both LSTMs

    def _crf_gradient(self, e: np.ndarray, tags: np.ndarray):
        n, steps, _ = e.shape
        crf, rows = self.w["crf"], np.arange(n)
        fwd, bwd = np.empty_like(e), np.zeros_like(e)
        fwd[:, 0] = e[:, 0] + self.w["first"]
        for t in range(1, steps):
            fwd[:, t] = _logsum(fwd[:, t - 1, :, None] + crf, 1) + e[:, t]
        for t in range(steps - 2, -1, -1):
            bwd[:, t] = _logsum(crf[None] + (e[:, t + 1] + bwd[:, t + 1])[:, None, :], 2)
        z = _logsum(fwd[:, -1], 1)
        grad_e = np.exp(fwd + bwd - z[:, None, None])
        grad_crf = np.zeros_like(crf)
        for t in range(1, steps):
            grad_crf += np.exp(fwd[:, t - 1, :, None] + crf + (e[:, t] + bwd[:, t])[:, None, :] - z[:, None, None]).sum(0)
        gold = fwd[rows, 0, tags[:, 0]].copy()
        for t in range(1, steps):
            gold += crf[tags[:, t - 1], tags[:, t]] + e[rows, t, tags[:, t]]
            np.add.at(grad_crf, (tags[:, t - 1], tags[:, t]), -1)
        grad_first = grad_e[:, 0].sum(0)
        np.add.at(grad_first, tags[:, 0], -1)
        grad_e[rows[:, None], np.arange(steps)[None], tags] -= 1
        return (z - gold).mean(), grad_e / n, grad_crf / n, grad_first / n

    def _lstm_gradient(self, x: np.ndarray, kept: list, grad_h: np.ndarray, d: str, out: dict):
        n = len(x)
        dh, dc = np.zeros((n, HIDDEN), x.dtype), np.zeros((n, HIDDEN), x.dtype)
        grad_z = np.empty((n, x.shape[1], 4 * HIDDEN), x.dtype)
        out[f"rec_{d}"] = np.zeros_like(self.w[f"rec_{d}"])
        for t, i, f, o, cand, before, tanh_c, last_h in reversed(kept):
            dh = dh + grad_h[:, t]
            dc = dc + dh * o * (1 - tanh_c**2)
            z = np.concatenate([dc * cand * i * (1 - i), dc * before * f * (1 - f), dh * tanh_c * o * (1 - o), dc * i * (1 - cand**2)], 1)
            grad_z[:, t] = z
            out[f"rec_{d}"] += last_h.T @ z
            dh, dc = z @ self.w[f"rec_{d}"].T, dc * f
        out[f"bias_{d}"] = grad_z.sum((0, 1))
        out[f"in_{d}"] = np.einsum("nte,ntz->ez", x, grad_z)
        return grad_z @ self.w[f"in_{d}"].T

    def gradient(self, codes: np.ndarray, tags: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        x, out = self.w["embed"][codes], {}
        (hf, kf), (hb, kb) = self._lstm(x, "f", True), self._lstm(x, "b", True)
        both = np.concatenate([hf, hb], 2)
        loss, grad_e, out["crf"], out["first"] = self._crf_gradient(both @ self.w["out"] + self.w["out_b"], tags)
        out["out"], out["out_b"] = np.einsum("nth,ntk->hk", both, grad_e), grad_e.sum((0, 1))
        grad_both = grad_e @ self.w["out"].T
        grad_x = self._lstm_gradient(x, kf, grad_both[..., :HIDDEN], "f", out) + self._lstm_gradient(x, kb, grad_both[..., HIDDEN:], "b", out)
        out["embed"] = np.zeros_like(self.w["embed"])
        np.add.at(out["embed"], codes, grad_x)
        return float(loss), out


def labelled_texts(n: int, seed: int) -> list[tuple[str, list[tuple[str, int, int]]]]:
    """Texts of filler words with marked spans and unmarked look-alikes."""
    r = random.Random(seed)
    word = lambda a=1, b=9: "".join(r.choice("aeioustrnlhdmcpé") for _ in range(r.randint(a, b)))
    digits = lambda k: "".join(r.choice("0123456789") for _ in range(k))

    def card(sep: str) -> str:
        d = digits(15)
        d += next(c for c in "0123456789" if luhn(d + c))
        return sep.join(d[i : i + 4] for i in range(0, 16, 4))

    def email() -> str:
        left, right = word(3) + r.choice(["", "." + word(2), digits(2), "." + digits(2)]), word(3)
        at, dot = r.choice([("@", "."), ("(at)", "(dot)"), ("[at]", "[dot]"), (" [at] ", " dot "), (" (at) ", " (dot) "), (" @ ", ".")])
        return f"{left}{at}{right}{dot}{r.choice(['com', 'org', 'net', 'example.com'])}"

    def ip() -> str:
        return r.choice([".", ".", "[.]", " . "]).join(str(r.randint(0, 255)) for _ in range(4))

    def phone() -> str:
        a, b, c = digits(3), digits(3), digits(4)
        return r.choice([f"({a}) {b}-{c}", f"+{digits(1)} ({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"00{digits(2)} {a} {b} {c}", f"+{digits(2)} {a} {b}{digits(3)}"])

    made = {"email": email, "ip": ip, "card": lambda: card(r.choice(["", " ", "-", ".", "  "])), "phone": phone}
    decoys = [
        lambda: f"{digits(4)}-{digits(2)}-{digits(2)}", lambda: f"{digits(1)}.{digits(1)}.{digits(1)}", lambda: f"version {digits(1)}", lambda: digits(r.randint(1, 8)),
        lambda: "".join(r.choice("0123456789abcdef") for _ in range(r.choice([16, 32, 40]))), lambda: "AKIA" + "".join(r.choice("ABCDEFGHJKLMNPQRSTUVWXYZ0123456789") for _ in range(16)),
        lambda: f"password={digits(3)}{word()}{digits(4)}", lambda: f"${digits(3)}.{digits(2)}", lambda: f"{digits(2)}:{digits(2)}", lambda: f"at {word()}", lambda: f"@{word()}", lambda: f"p. {digits(3)}, {digits(3)}",
        lambda: f"{digits(9)}{word(2)}{digits(5)}",
    ]
    out = []
    for _ in range(n):
        text, spans = "", []
        while len(text) < WINDOW:
            text += r.choice([word().title(), word(), word()]) + r.choice([" ", " ", " ", ", ", ". ", "\n"])
            pick = r.random()
            if pick < 0.22:
                kind = r.choice(KINDS)
                piece = made[kind]()
                spans.append((kind, len(text), len(text) + len(piece)))
                text += piece + r.choice([" ", ", ", ". ", "\n"])
            elif pick < 0.38:
                text += r.choice(decoys)() + r.choice([" ", ", ", ". ", "\n"])
        out.append((text, spans))
    return out


def _windows(samples, r: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    codes, tags = [], []
    for text, spans in samples:
        c, t = char_codes(text), np.zeros(len(text), np.int64)
        for kind, a, b in spans:
            t[a:b] = 2 + 2 * KINDS.index(kind)
            t[a] -= 1
        at = int(r.integers(0, len(text) - WINDOW + 1))
        codes.append(c[at : at + WINDOW])
        tags.append(t[at : at + WINDOW])
    return np.array(codes), np.array(tags)


@lru_cache(maxsize=2)
def train(samples: int = 5000, epochs: int = 5, seed: int = 7, batch: int = 100, rate: float = 0.03) -> CharTagger:
    """Adam on `samples` labelled texts, `epochs` times; the same weights for the same arguments."""
    model, r = CharTagger.fresh(seed), np.random.default_rng(seed)
    codes, tags = _windows(labelled_texts(samples, seed), r)
    model.w = {k: v.astype(np.float32) for k, v in model.w.items()}
    first, second, step = {}, {}, 0
    total = epochs * (len(codes) // batch)
    for _ in range(epochs):
        for rows in np.array_split(r.permutation(len(codes)), len(codes) // batch):
            _, grads = model.gradient(codes[rows], tags[rows])
            norm = np.sqrt(sum(float((g**2).sum()) for g in grads.values()))
            step += 1
            pace = rate * (1 - 0.9 * step / total) * min(1.0, 5.0 / max(norm, 1e-9))
            for k, g in grads.items():
                first[k] = 0.9 * first.get(k, 0) + 0.1 * g
                second[k] = 0.99 * second.get(k, 0) + 0.01 * g * g
                model.w[k] -= pace * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)
    return CharTagger({k: v.astype(np.float32) for k, v in model.w.items()})


# --- decoding whole texts -------------------------------------------------


def _valid(kind: str, piece: str, before: str, after: str) -> bool:
    if before.isalnum() or after.isalnum():
        return False
    digits = _NOT_DIGIT.sub("", piece)
    if kind == "email":
        return bool(re.fullmatch(r"(?i)[\w.%+-]+\s*(?:@|[\[(]\s?at\s?[\])])\s*[a-z0-9-]+(?:\s*(?:\.|[\[(]\s?dot\s?[\])]|\sdot\s)\s*[a-z0-9-]+)+", piece))
    if kind == "ip":
        parts = re.split(r"\s*\[?\.\]?\s*", piece)
        return len(parts) == 4 and all(p.isascii() and p.isdigit() and len(p) <= 3 and int(p) <= 255 for p in parts)
    if kind == "card":
        return 13 <= len(digits) <= 19 and luhn(digits) and bool(re.fullmatch(r"[0-9](?:[ .-]{0,2}[0-9])+", piece))
    return 9 <= len(digits) <= 15 and bool(re.fullmatch(r"[+(]?[0-9][0-9 ().-]*[0-9]", piece)) and bool(re.search(r"[ ().-]", piece))


def stretches(text: str) -> list[tuple[int, int]]:
    """Ranges [a, b) of touching active windows, in half-window steps."""
    half, out = WINDOW // 2, []
    active = sorted({k for m in _MARKS.finditer(text) for k in range(m.start() // half - 1, m.start() // half + 1) if k >= 0})
    for k in active:
        a, b = k * half, min(len(text), k * half + WINDOW)
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], b)
        else:
            out.append((a, b))
    return out


def _blend(model: CharTagger, texts: list[str], areas: list[tuple[int, int, int]]) -> list[np.ndarray]:
    """Emissions of each area (text number, a, b), from all its windows together."""
    half, jobs = WINDOW // 2, []
    for n, (_, a, b) in enumerate(areas):
        jobs += [(n, at) for at in range(a, max(a + 1, b - half), half)]
    out = [np.zeros((b - a, TAGS), np.float32) for _, a, b in areas]
    weight = [np.full((b - a, 1), 1e-6, np.float32) for _, a, b in areas]
    near = (1.0 - np.abs(np.arange(WINDOW) - (WINDOW - 1) / 2) / (WINDOW / 2 + 1)).astype(np.float32)[:, None]
    for at in range(0, len(jobs), 256):
        some = jobs[at : at + 256]
        codes = np.zeros((len(some), WINDOW), np.int64)
        for i, (n, start) in enumerate(some):
            own = char_codes(texts[areas[n][0]][start : start + WINDOW])
            codes[i, : len(own)] = own
        for (n, start), e in zip(some, model.emissions(codes)):
            a, b = areas[n][1], areas[n][2]
            m = min(WINDOW, b - start)
            out[n][start - a : start - a + m] += e[:m] * near[:m]
            weight[n][start - a : start - a + m] += near[:m]
    return [o / w for o, w in zip(out, weight)]


def _parts(model: CharTagger, text: str, a: int, b: int) -> Iterator[np.ndarray]:
    """The emissions of a long stretch, PART characters at a time; each part is blended
    from all windows that touch it, so they are those of the whole stretch."""
    half = WINDOW // 2
    for at in range(a, b, PART):
        low, high = max(a, at - half), min(b, at + PART + half)
        yield _blend(model, [text], [(0, low, high)])[0][at - low : min(b, at + PART) - low]


def _labels(model: CharTagger, texts: list[str], areas: list[tuple[int, int, int]]) -> Iterator[tuple[int, int, np.ndarray]]:
    """(text number, start, labels) of each area, short ones 512 at a time."""
    held: list[tuple[int, int, int]] = []
    for n, a, b in areas:
        if b - a > PART:
            yield n, a, model.decode(_parts(model, texts[n], a, b))
            continue
        held.append((n, a, b))
        if len(held) >= 512:
            yield from ((m, x, model.viterbi(e)) for (m, x, _), e in zip(held, _blend(model, texts, held)))
            held = []
    if held:
        yield from ((m, x, model.viterbi(e)) for (m, x, _), e in zip(held, _blend(model, texts, held)))


def find_spans(texts: list[str], model: CharTagger) -> list[tuple[list, list]]:
    """(base spans, added spans) of each text."""
    base = [base_spans(t) for t in texts]
    starts = [[x for _, x, _ in sorted(b, key=lambda s: s[1])] for b in base]
    longest = [max((y - x for _, x, y in b), default=0) for b in base]
    taken: list[dict[int, int]] = [{} for _ in base]  # start of a base span -> its end
    for own, b in zip(taken, base):
        for _, x, y in b:
            own[x] = max(own.get(x, y), y)

    def touches(n: int, start: int, end: int) -> bool:
        at = bisect.bisect_left(starts[n], start - longest[n])
        while at < len(starts[n]) and starts[n][at] < end:
            if taken[n][starts[n][at]] > start:
                return True
            at += 1
        return False

    areas = [(n, a, b) for n, t in enumerate(texts) for a, b in stretches(t)]
    added: list[list] = [[] for _ in texts]
    for n, a, tags in _labels(model, texts, areas):
        text, some, last = texts[n], np.flatnonzero(tags), -1
        for i in some.tolist():
            if i <= last:
                continue
            which, j = (int(tags[i]) - 1) // 2, i + 1
            while j < len(tags) and tags[j] == 2 + 2 * which:
                j += 1
            last = j - 1
            kind, start, end = KINDS[which], a + i, a + j
            while end > start and text[end - 1] in " \n.,-":
                end -= 1
            if end > start and _valid(kind, text[start:end], text[start - 1 : start], text[end : end + 1]) and not touches(n, start, end):
                added[n].append((kind, start, end))
    return list(zip(base, added))


def _found(docs: DataFrame, make, schema: str, fields: list[pa.DataType], extra: tuple[str, ...] = ()) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(train())
    extra = carried(extra, "doc_id", *(x.split(" ")[0] for x in schema.split(", ")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                texts = [t.as_py() or "" for t in batch.column(1)]
                rows = [make(t, b, a) for t, (b, a) in zip(texts, find_spans(texts, shared.value))]
                columns = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(fields)]
                yield pa.RecordBatch.from_arrays([batch.column(0), *columns, *(batch.column(2 + i) for i in range(len(extra)))], names)

    id_kind = docs.schema["doc_id"].dataType.simpleString()
    full = ", ".join([f"doc_id {id_kind}", schema, *(f"{c} {docs.schema[c].dataType.simpleString()}" for c in extra)])
    names = [x.split(" ")[0] for x in full.split(", ")]
    return docs.select("doc_id", "text", *extra).mapInArrow(run, full)


def span_digests(docs: DataFrame) -> DataFrame:
    """doc_id, n_<kind> (base spans), base_sha256, spans (base and added), n_added."""

    def make(text, base, added):
        counts = [sum(s[0] == k for s in base) for k in KINDS]
        return (*counts, hashlib.sha256(spans_text(base).encode()).hexdigest(), spans_text(base + added), len(added))

    i, s = pa.int64(), pa.string()
    schema = "n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long"
    return _found(docs, make, schema, [i, i, i, i, s, s, i])


def redact_text(text: str, spans) -> str:
    """Each span replaced by its kind in brackets; overlapping spans go as one, named by the first."""
    out, at = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= at:
            out += [text[at:a], f"[{kind.upper()}]"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, text with every span replaced, and the extra columns as they are;
    null texts become empty."""
    return _found(docs, lambda text, base, added: (redact_text(text, base + added),), "text string", [pa.string()], extra)

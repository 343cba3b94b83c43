"""Personal data: fixed patterns, and a linear-chain CRF over word shapes for what they miss.

The patterns (email, ip, card, phone) are matched leftmost and without overlap
per kind. The CRF labels the words that hold a digit or an at sign; all other words
are outside by definition, so runs of such words are its chains. It is trained by
gradient ascent on a small labelled table that is written by rule below, and decoded by
Viterbi over all chains of a batch at once. It adds spans that touch no pattern's
span and takes none away.

Null text is empty. Positions are code points, end exclusive. New columns whose names are taken get
underscores before them.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from certwatch.llm.batches import free_name, per_process, slices, word_bounds

KINDS = ("email", "ip", "card", "phone")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9][0-9.]*")
_GROUPS = re.compile(r"[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DOUBLED = (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)  # digit sum of twice a digit


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            done = domain.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


def _addresses(text: str) -> Iterator[tuple[int, int]]:
    for run in _DOTTED.finditer(text):
        groups = [(run.start() + g.start(), run.start() + g.end()) for g in _GROUPS.finditer(run.group())]
        i = 0
        while i + 3 < len(groups):
            four = groups[i:i + 4]
            broken = [k for k in range(3) if four[k][1] + 1 != four[k + 1][0]]
            if broken:
                i += broken[-1] + 1
                continue
            if all(len(p := text[a:b].lstrip("0")) < 4 and int(p or 0) <= 255 for a, b in four):
                yield four[0][0], four[3][1]
            i += 4


def _luhn(digits: str) -> bool:
    return sum(_DOUBLED[int(d)] if i % 2 else int(d) for i, d in enumerate(reversed(digits))) % 10 == 0


def _digits(text: str) -> str:
    return re.sub(r"[^0-9]", "", text)


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by kind, then start."""
    out = [("email", a, b) for a, b in _emails(text)]
    out += [("ip", a, b) for a, b in _addresses(text)]
    for m in _CARD.finditer(text):
        if 13 <= m.end() - m.start() <= 37 and 13 <= len(d := _digits(m.group())) <= 19 and _luhn(d):
            out.append(("card", m.start(), m.end()))
    if "+" in text:
        out += [("phone", m.start(), m.end()) for m in _PHONE.finditer(text) if 9 <= len(_digits(m.group())) <= 15]
    return out


# --- the CRF -----------------------------------------------------------------

LABELS = ("outside", *KINDS)
_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
_FEATURES = ("always", "digits 1-2", "digits 3", "digits 4-6", "digits 7-8", "digits 9-12", "digits 13+", "luhn", "letters", "accents", "at", "dots",
             "three dots", "dash", "two dashes", "plus", "bracket", "other sign", "first letter", "nnn-nnnn", "nnn-nnn-nnnn",
             "a@b", "a@b.c", "before: digit", "after: digit", "before: phone word", "before: bracket digits")
_PHONE_WORDS = ("call", "phone", "tel", "fax", "mobile", "cell", "dial")
_SHAPES = {"nnn-nnnn": re.compile(rb"\(?[0-9]{3}[-.][0-9]{4}[.,;)]*"),
           "nnn-nnn-nnnn": re.compile(rb"\(?[0-9]{3}[).-]+[0-9]{3}[.-][0-9]{4}[.,;)]*"),
           "a@b": re.compile(rb"[A-Za-z0-9._%+-]+@[A-Za-z][A-Za-z0-9-]*[.,;)]*"),
           "a@b.c": re.compile(rb"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+\.[A-Za-z0-9.-]+")}
_BRACKETED = re.compile(rb"\(?[0-9]{3}\)")


def word_features(words: list[bytes], before: list[bytes], after: list[bytes]) -> np.ndarray:
    """One row of _FEATURES per word."""
    x = np.zeros((len(words), len(_FEATURES)))
    place = {name: i for i, name in enumerate(_FEATURES)}
    for row, word, left, right in zip(x, words, before, after):
        digits = sum(48 <= b <= 57 for b in word)
        size = "1-2" if digits < 3 else "3" if digits == 3 else "4-6" if digits < 7 else "7-8" if digits < 9 else "9-12" if digits < 13 else "13+"
        low = left.lower().strip(b".:,")
        on = {"always": True, f"digits {size}": digits > 0, "luhn": 13 <= digits <= 19 and _luhn(_digits(word.decode("latin-1"))),
              "letters": any(b | 32 in range(97, 123) for b in word),
              "accents": any(b > 127 for b in word), "at": b"@" in word, "dots": b"." in word.rstrip(b"."),
              "three dots": word.rstrip(b".").count(b".") == 3, "dash": b"-" in word, "two dashes": word.count(b"-") == 2,
              "plus": b"+" in word, "bracket": b"(" in word or b")" in word,
              "other sign": bool(set(word) & set(b"#$%&*/:=_!?'\"")), "first letter": word[:1].isalpha(),
              **{name: bool(shape.fullmatch(word)) for name, shape in _SHAPES.items()},
              "before: digit": any(48 <= b <= 57 for b in left), "after: digit": any(48 <= b <= 57 for b in right),
              "before: phone word": low.decode("latin-1") in _PHONE_WORDS, "before: bracket digits": bool(_BRACKETED.fullmatch(left))}
        for name, value in on.items():
            row[place[name]] = value
    return x


def labelled_table() -> list[tuple[list[str], list[str]]]:
    """(words, labels) of short texts, written by rule: forms of personal data and of what only looks like it."""
    rng = np.random.default_rng(7)
    fillers = "the of and invoice on page room write to call in der von und la de que est see".split()
    n = lambda k: "".join(map(str, rng.integers(0, 10, k)))
    name = lambda k: "".join(chr(97 + c) for c in rng.integers(0, 26, k))
    sums = lambda k: next(d for c in "0123456789" if _luhn(d := base + c)) if (base := n(k - 1)) else ""
    fails = lambda k: next(d for c in "0123456789" if not _luhn(d := base + c)) if (base := n(k - 1)) else ""
    forms = {
        "card": [lambda: [sums(16)], lambda: [sums(16), sums(16)], lambda: [sums(15)], lambda: [fails(16), sums(16)]],
        "phone": [lambda: [f"({n(3)})", f"{n(3)}-{n(4)}"], lambda: [f"{n(3)}-{n(3)}-{n(4)}"], lambda: [f"({n(3)}){n(3)}-{n(4)}"],
                  lambda: ["+1", f"({n(3)})", f"{n(3)}-{n(4)}"], lambda: [f"{n(3)}.{n(3)}.{n(4)}"], lambda: [f"+{n(11)}"]],
        "email": [lambda: [f"{name(5)}.{n(2)}@mail{n(1)}.example.com"], lambda: [f"{name(6)}@{name(7)}"], lambda: [f"{name(4)}@{name(5)}.org"]],
        "ip": [lambda: [".".join(str(k) for k in rng.integers(1, 255, 4))]],
        "outside": [lambda: [n(int(rng.integers(1, 9)))], lambda: [f"{n(1)}.{n(1)}"], lambda: [f"{n(4)}-{n(2)}-{n(2)}"], lambda: [fails(16)], lambda: [fails(16), fails(16)],
                    lambda: [f"{name(4)}{n(3)}"], lambda: [n(11)], lambda: [f"#{n(4)}"], lambda: [f"{name(3)}-{n(4)}"],
                    lambda: [f"@{name(6)}"], lambda: [f"{n(2)}:{n(2)}"], lambda: [n(3), n(4)], lambda: [f"AKIA{name(6).upper()}{n(6)}"],
                    lambda: ["-".join(re.findall("....", fails(16)))], lambda: [f"{n(3)}-{n(2)}-{n(4)}"], lambda: [f"{n(1)},{n(3)}.{n(2)}"],
                    lambda: [f"({n(3)})"], lambda: [f"({n(4)})", n(3)], lambda: ["@"], lambda: [f"{n(3)}@{n(2)}"]]}
    table = []
    for kind, makers in forms.items():
        for make in makers:
            for _ in range(8):
                words, labels = [], []
                for _ in range(int(rng.integers(0, 3))):
                    words.append(str(rng.choice(fillers)))
                labels += ["outside"] * len(words)
                form = make()
                words += form
                labels += [kind if kind != "card" or _luhn(w) else "outside" for w in form]
                words.append(str(rng.choice(fillers)))
                table.append((words, labels + ["outside"]))
    return table


def _chained(words: list[bytes]) -> list[list[int]]:
    """Runs of neighbouring words with a digit or an at sign."""
    out: list[list[int]] = []
    for i, w in enumerate(words):
        if b"@" in w or any(48 <= b <= 57 for b in w):
            if out and out[-1][-1] == i - 1:
                out[-1].append(i)
            else:
                out.append([i])
    return out


class Crf:
    """Label scores by word features, and by pairs of neighbouring labels."""

    def __init__(self):
        k = len(LABELS)
        self.emit, self.move = np.zeros((len(_FEATURES), k)), np.zeros((k, k))

    def fit(self, table: list[tuple[list[str], list[str]]], steps: int = 400, rate: float = 0.5, decay: float = 1e-3) -> Crf:
        chains = []
        for words, labels in table:
            raw = [w.encode() for w in words]
            for run in _chained(raw):
                own = word_features([raw[i] for i in run], [raw[i - 1] if i else b"" for i in run],
                                    [raw[i + 1] if i + 1 < len(raw) else b"" for i in run])
                chains.append((own, np.array([LABELS.index(labels[i]) for i in run])))
        for _ in range(steps):
            emit, move = -decay * self.emit, -decay * self.move
            for x, y in chains:
                one, two = self._expected(x)
                target = np.zeros_like(one)
                target[np.arange(len(y)), y] = 1
                emit += x.T @ (target - one) / len(chains)
                for a, b in zip(y, y[1:]):
                    move[a, b] += 1 / len(chains)
                move -= two / len(chains)
            self.emit += rate * emit
            self.move += rate * move
        return self

    def _expected(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Marginals of labels and of neighbouring pairs, forward-backward."""
        e = np.exp(x @ self.emit - (x @ self.emit).max(axis=1, keepdims=True))
        m = np.exp(self.move)
        n = len(e)
        f, b = np.zeros_like(e), np.ones_like(e)
        f[0] = e[0] / e[0].sum()
        for t in range(1, n):
            f[t] = (f[t - 1] @ m) * e[t]
            f[t] /= f[t].sum()
        two = np.zeros_like(m)
        for t in range(n - 2, -1, -1):
            b[t] = m @ (e[t + 1] * b[t + 1])
            pair = f[t][:, None] * m * (e[t + 1] * b[t + 1])
            two += pair / pair.sum()
            b[t] /= b[t].sum()
        one = f * b
        return one / one.sum(axis=1, keepdims=True), two

    def decode(self, x: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """The best labels of chains that lie one after the other, all chains step by step."""
        scores, k = x @ self.emit, len(LABELS)
        first = np.cumsum(sizes) - sizes
        best, back = scores.copy(), np.zeros((len(x), k), np.int64)
        order = np.argsort(-sizes, kind="stable")
        longest_first, by_size = first[order], -sizes[order]
        for t in range(1, int(sizes.max(initial=0))):
            at = longest_first[:int(np.searchsorted(by_size, -t, side="left"))] + t
            reach = best[at - 1][:, :, None] + self.move[None]
            back[at] = reach.argmax(axis=1)
            best[at] += reach.max(axis=1)
        labels = np.zeros(len(x), np.int64)
        ends = first + sizes - 1
        if len(ends):
            labels[ends] = best[ends].argmax(axis=1)
        for t in range(int(sizes.max(initial=0)) - 1, 0, -1):
            at = first[sizes > t] + t
            labels[at - 1] = back[at, labels[at]]
        return labels


def trained() -> Crf:
    return Crf().fit(labelled_table())


_TRIMMED = b".,;:!?()[]{}<>\"'"


def _crf_spans(crf: Crf, data: np.ndarray, offsets: np.ndarray) -> dict[int, list[tuple[str, int, int]]]:
    """Per text the (kind, start, end) in bytes that the CRF sees."""
    starts, ends, per_text = word_bounds(~_SPACE[data], offsets)
    marks = np.concatenate([[0], np.cumsum((data == 64) | ((data >= 48) & (data <= 57)))])
    chosen = np.flatnonzero(marks[ends] > marks[starts])
    if not len(chosen):
        return {}
    last_word = np.cumsum(per_text)
    doc = np.searchsorted(last_word, chosen, side="right")
    raw = data.tobytes()
    word = lambda i: raw[starts[i]:ends[i]]
    first_word = last_word - per_text
    before = [word(i - 1) if i > first_word[d] else b"" for i, d in zip(chosen, doc)]
    after = [word(i + 1) if i + 1 < last_word[d] else b"" for i, d in zip(chosen, doc)]
    x = word_features([word(i) for i in chosen], before, after)
    new = np.concatenate([[True], (np.diff(chosen) > 1) | (np.diff(doc) > 0)])
    labels = crf.decode(x, np.diff(np.append(np.flatnonzero(new), len(chosen))))
    out: dict[int, list[tuple[str, int, int]]] = {}
    # only telephone numbers run over several words
    begins = new | np.concatenate([[True], np.diff(labels) != 0]) | (labels != LABELS.index("phone"))
    bounds = np.append(np.flatnonzero(begins), len(chosen))
    for a, b in zip(bounds, bounds[1:]):
        if labels[a]:
            start, end = int(starts[chosen[a]]), int(ends[chosen[b - 1]])
            text = raw[start:end]
            start += len(text) - len(text.lstrip(_TRIMMED.replace(b"(", b"") if b")" in text else _TRIMMED))
            end -= len(text) - len(text.rstrip(_TRIMMED))
            if start < end:
                base = int(offsets[doc[a]])
                out.setdefault(int(doc[a]), []).append((LABELS[labels[a]], start - base, end - base))
    return out


def text_spans(crf: Crf, data: np.ndarray, offsets: np.ndarray) -> list[tuple[list, list]]:
    """Per text (pattern spans, all spans), by kind, then start."""
    seen = _crf_spans(crf, data, offsets)
    raw, out = data.tobytes(), []
    for i in range(len(offsets) - 1):
        part = raw[offsets[i]:offsets[i + 1]]
        text = part.decode()
        base = base_spans(text)
        extra = []
        for kind, a, b in seen.get(i, ()):
            a = len(part[:a].decode())
            b = a + len(part[:b].decode()) - a
            if all(b <= start or end <= a for _, start, end in base):
                extra.append((kind, a, b))
        out.append((base, sorted(base + extra, key=lambda s: (KINDS.index(s[0]), s[1], s[2]))))
    return out


_SPAN = "array<struct<kind:string,start:bigint,end:bigint>>"
_SPAN_TYPE = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def _find(crf: Crf, text: str, names: tuple[str, str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in slices(batches, text):
            found = text_spans(crf, data, offsets)
            spans = [pa.array([[dict(zip(("kind", "start", "end"), s)) for s in row[k]] for row in found], _SPAN_TYPE)
                     for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([*rows.columns, *spans], names=[*rows.schema.names, *names])

    return run


def find_spans(docs: DataFrame, text: str = "text", names: tuple[str, str] = ("base_spans", "spans"),
               crf: Crf | None = None) -> DataFrame:
    """``docs`` with the patterns' spans and all spans."""
    names = tuple(free_name(docs, n) for n in names)
    fields = ", ".join(f"`{c}` {t}" for c, t in docs.dtypes)
    return docs.mapInArrow(_find(crf or per_process(("crf",), trained), text, names),
                           f"{fields}, `{names[0]}` {_SPAN}, `{names[1]}` {_SPAN}")


def redacted(text: Column, spans: Column) -> Column:
    """The text with every span replaced by ``[kind]``; overlapping spans become one of the first's kind."""
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"], s["end"], s["kind"])))
    empty = F.struct(F.lit("").alias("done"), F.lit(0).cast("long").alias("at"))

    def step(acc: Column, s: Column) -> Column:
        fresh = F.concat(acc["done"], F.substring(text, acc["at"].cast("int") + 1, (s["start"] - acc["at"]).cast("int")),
                         F.lit("["), s["kind"], F.lit("]"))
        return F.struct(F.when(s["start"] >= acc["at"], fresh).otherwise(acc["done"]).alias("done"),
                        F.greatest(acc["at"], s["end"]).alias("at"))

    return F.when(F.size(spans) == 0, text).otherwise(F.aggregate(
        ordered, empty, step, lambda acc: F.concat(acc["done"], F.substring(text, acc["at"].cast("int") + 1, F.length(text)))))


def span_text(spans: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

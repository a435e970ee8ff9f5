"""Sentence units of text cells, whatever the language or script.

Cells are cut into blocks first (paragraph, heading, list item; their marks are
left out). Inside a block every end mark with its closing quotes and brackets,
and every blank between Thai letters, is a candidate; a maximum-entropy model
decides from the neighbouring tokens, their case, length, digits and script, the
kind of mark, and open quotes and brackets.

The model is trained here, on boundaries nobody has to label:

* surely a boundary: the last mark of a block, seen with the first token of the
  following block;
* surely none: a small letter, comma or dash follows; a quote or bracket is
  still open; the token before the mark hardly ever ends a block, or the token
  behind hardly ever begins one, though both occur often (abbreviations,
  ordinals, reporting words after a quotation).

How often tokens stand before and behind marks, and at either end of blocks, is
counted over the text cells of all documents. The weights are fitted on a sample:
the about ``SAMPLE_DOCS`` documents of the smallest hashes, in that order, and of
them at most ``SAMPLE_CELLS`` cells, so the same documents give the same model.
Every document is then segmented where it lies, without a shuffle.

Defined results: NULL or blank texts and cells have no units; units carry no
outer white space; a block without any mark is one unit; cells that reach over
the end of the text stop there.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bounds of the training sample: documents (a mean, by share of hashes), cells.
SAMPLE_DOCS, SAMPLE_CELLS = 6_000, 120_000
#: A token counts as never ending (beginning) a block if it was seen so often
#: elsewhere, and at the end (beginning) in at most this share.
OFTEN, SELDOM = 12, 0.02

# Marks, quotes and brackets.
ENDS = ".!?…。！？．｡‼⁇⁈⁉۔؟।॥።፧;;։។៕။།༎᠃᠉"
FREE_ENDS = "。！？．｡‼⁇⁈⁉۔؟।॥።፧։។៕။།༎᠃᠉"
PAIRS = {"(": ")", "[": "]", "{": "}", "（": "）", "［": "］", "【": "】", "「": "」", "『": "』", "《": "》", "〈": "〉",
         "«": "»", "‹": "›", "„": "“", "‚": "‘", "“": "”", "‘": "’", "»": "«"}
CLOSERS = set(PAIRS.values()) - {"«", "“", "‘"}
QUOTES = set("«»‹›„“”‚‘’\"「」『』")
_MARK = re.compile(f"[{re.escape(ENDS)}]+")
_HEAD = re.compile(r"[ \t]{0,3}#{1,6}[ \t]+")
_BULLET = re.compile(r"[ \t]*[-*+•][ \t]+")
_NUMBER = re.compile(r"[ \t]*(\d{1,3})[.)][ \t]+")
_LINE = re.compile(r"[^\n]*(?:\n|$)")
_NEXT = re.compile(r"[\w'’-]+")
_THAI_GAP = re.compile(r"(?<=[฀-๿])[ \t\n]+(?=[฀-๿])")


def blocks(text: str) -> list[tuple[int, int]]:
    """Start and end of every paragraph, heading and list item, marks left out."""
    out: list[tuple[int, int]] = []
    start = end = -1
    kind, number = "", 0

    def close() -> None:
        nonlocal start
        if start >= 0:
            out.append((start, end))
        start = -1

    for m in _LINE.finditer(text):
        line, at = m[0], m.start()
        if not line.strip():
            close()
            kind = ""
            continue
        head, bullet, count = _HEAD.match(line), _BULLET.match(line), _NUMBER.match(line)
        stop = at + len(line.rstrip())
        if head:
            close()
            out.append((at + head.end(), stop))
            kind = ""
        elif bullet:
            close()
            start, end, kind = at + bullet.end(), stop, "bullet"
        elif count and (start < 0 or (kind == "number" and int(count[1]) == number + 1)):
            close()
            start, end, kind, number = at + count.end(), stop, "number", int(count[1])
        elif start < 0:
            start, end, kind = at + len(line) - len(line.lstrip()), stop, "text"
        else:
            end = stop
    close()
    return [(a, b) for a, b in out if b > a]


def pairs(s: str) -> dict[int, int]:
    """Close -> open of the quotes and brackets that match inside a block."""
    out: dict[int, int] = {}
    stack: list[tuple[str, int]] = []
    for i, ch in enumerate(s):
        if ch == '"':
            opened = next((k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == '"'), None)
            if opened is not None:
                out[i] = stack[opened][1]
                del stack[opened:]
            elif i == 0 or s[i - 1].isspace() or s[i - 1] in PAIRS:
                stack.append(('"', i))
            continue
        if ch not in PAIRS and ch not in CLOSERS:
            continue
        opened = next((k for k in range(len(stack) - 1, max(-1, len(stack) - 6), -1) if PAIRS.get(stack[k][0]) == ch), None)
        if opened is not None:
            out[i] = stack[opened][1]
            del stack[opened:]
        elif ch in PAIRS and not (ch in "‘’" and i and s[i - 1].isalnum()):
            stack.append((ch, i))
    return out


def script(ch: str) -> str:
    o = ord(ch)
    if o < 0x250:
        return "latin"
    for name, lo, hi in _SCRIPTS:
        if lo <= o <= hi:
            return name
    return "other"


# Unicode blocks the features tell apart.
_SCRIPTS = (
    ("greek", 0x370, 0x3FF), ("cyrillic", 0x400, 0x52F), ("hebrew", 0x590, 0x5FF), ("arabic", 0x600, 0x77F), ("indic", 0x900, 0xDFF),
    ("armenian", 0x530, 0x58F), ("thai", 0xE00, 0xE7F), ("tibetan", 0xF00, 0xFFF), ("burmese", 0x1000, 0x109F), ("khmer", 0x1780, 0x17FF), ("mongolian", 0x1800, 0x18AF), ("ethiopic", 0x1200, 0x139F), ("kana", 0x3040, 0x30FF), ("han", 0x3400, 0x9FFF), ("hangul", 0xAC00, 0xD7AF),
)
_JOINED = {"han", "kana", "thai", "tibetan", "burmese", "khmer"}


def token_before(s: str, i: int) -> str:
    """The token that ends at ``i``: numbers by kind, joined scripts by letters."""
    if i <= 0:
        return "<start>"
    if script(s[i - 1]) in _JOINED:
        return s[max(0, i - 2) : i]
    a = i
    while a > 0 and i - a < 24 and not s[a - 1].isspace() and s[a - 1] not in PAIRS and s[a - 1] != '"':
        a -= 1
    t = s[a:i]
    if t.isdigit():
        return "<num>"
    if any(ch.isdigit() for ch in t):
        return "<mix>"
    return t.lower() if len(t) > 1 or not t.isupper() else "<A>"


def token_after(s: str, i: int) -> tuple[str, str]:
    """(token, shape) that begins at ``i``, openers and blanks skipped."""
    opener = ""
    while i < len(s) and (s[i].isspace() or s[i] in PAIRS or s[i] in '"`$*_'):
        if not s[i].isspace():
            opener = "o"
        i += 1
    if i >= len(s):
        return "<end>", "end"
    ch = s[i]
    if script(ch) in _JOINED:
        return s[i : i + 2], script(ch) + opener
    m = _NEXT.match(s, i)
    if not m:
        return ch, "sign" + opener
    t = m[0]
    if t[0].isdigit():
        return "<num>", "digit" + opener
    shape = "lower" if t[0].islower() else "upper" if t[0].isupper() else script(ch)
    return t.lower(), shape + opener


class Candidate:
    __slots__ = ("end", "resume", "mark", "prev", "next", "shape", "closed", "open", "lead", "script", "follow", "long")

    def features(self) -> list[str]:
        n, t, q = self.shape, self.mark, self.closed
        p = "num" if self.prev in ("<num>", "<mix>") else "A" if self.prev == "<A>" else "dot" if "." in self.prev else str(min(len(self.prev), 5))
        return [
            "bias", f"t={t}", f"p={self.prev}|{t}", f"n={self.next}", f"P={p}", f"N={n}", f"q={q}", f"in={self.open}", f"s={self.script}",
            f"P|N={p}|{n}", f"t|N|q={t}|{n}|{q}", f"t|s={t}|{self.script}", f"q|l|N={q}|{self.lead}|{n}", f"q|n={q}|{self.next}", f"f={self.follow}", f"P|n={p}|{self.next}",
        ]

    def key(self) -> tuple:
        return self.mark, self.prev, self.next, self.shape, self.closed, self.open, self.lead, self.script, self.follow


def candidates(s: str, after: str = "") -> list[Candidate]:
    """Candidates of one block; ``after`` is the text of the following block,
    which the last mark sees as its right neighbour."""
    matched = pairs(s) if any(ch in QUOTES or ch in "([{（「『【《" for ch in s) else {}
    spans = sorted((o, c) for c, o in matched.items())
    out: list[Candidate] = []

    def inside(i: int) -> bool:
        return any(o < i <= c for o, c in spans[: bisect_right(spans, (i, 0))])

    def greek(i: int) -> bool:
        """The last letter before ``i`` is Greek: its question mark is ``;``."""
        return last_script(i) == "greek"

    def last_script(i: int) -> str:
        return next((script(ch) for ch in reversed(s[max(0, i - 40) : i]) if ch.isalpha()), "none")

    def add(first: int, end: int, resume: int, mark: str, closed: str, lead: str) -> None:
        c = Candidate()
        c.end, c.resume, c.mark, c.closed, c.lead = end, resume, mark, closed, lead
        c.prev = token_before(s, first)
        last = resume >= len(s)
        c.next, c.shape = token_after(after, 0) if last else token_after(s, resume)
        c.open = inside(end)
        c.script = last_script(first)
        f = "" if last else s[resume]
        c.follow = "stop" if f in ",;:—–-،、，；：·)]" and f else "go"
        c.long = len(s)
        out.append(c)

    for m in _MARK.finditer(s):
        a, b = m.span()
        run = m[0]
        if run[0] in ";;" and not greek(a):
            continue
        j, closed, lead = b, "", ""
        while j < len(s):
            k = j + 1 if s[j].isspace() and j + 1 < len(s) and s[j + 1] in "»›" else j
            ch = s[k]
            if k in matched or (k == j and ch in CLOSERS and ch not in "»›"):
                closed = "quote" if ch in QUOTES else closed or "bracket"
                if ch in QUOTES and k in matched:
                    opened = matched[k]
                    lead = "lead" if not s[:opened].strip() or s[:opened].rstrip()[-1] in ENDS + "”»)" else "colon" if s[:opened].rstrip()[-1] in ":：" else "mid"
                j = k + 1
            else:
                break
        free = run[-1] in FREE_ENDS or (run[-1] in "….!?" and j < len(s) and (script(s[j]) in ("han", "kana") or (a and script(s[a - 1]) in ("han", "kana") and s[j] in PAIRS)))
        if j < len(s) and not s[j].isspace() and not free:
            continue
        resume = j
        while resume < len(s) and s[resume].isspace():
            resume += 1
        add(a, j, resume, run[0] if len(run) == 1 else run[0] * 2 if len(set(run)) == 1 else run[:2], closed, lead)
    thai = False
    for m in _THAI_GAP.finditer(s):
        add(m.start(), m.start(), m.end(), "gap", "", "")
        thai = True
    if s and script(s[-1]) == "thai":
        add(len(s), len(s), len(s), "gap", "", "")
        thai = True
    if thai:
        out.sort(key=lambda c: c.end)
    return out


class MaxEnt:
    """Two-class maximum-entropy model over named features, fitted by L-BFGS."""

    def __init__(self, weights: dict[str, float]):
        self.weights = weights
        self.memo: dict[tuple, bool] = {}

    @classmethod
    def fit(cls, rows: list[list[str]], labels: np.ndarray, ridge: float = 0.3, steps: int = 80) -> MaxEnt:
        seen = Counter(f for r in rows for f in r)
        names = {f: k for k, f in enumerate(sorted(f for f, n in seen.items() if n > 1))}
        if not names or len(set(labels.tolist())) < 2:
            return cls({"bias": 1.0})
        at = [[names[f] for f in r if f in names] for r in rows]
        col = np.fromiter((k for r in at for k in r), dtype=np.int64)
        row = np.repeat(np.arange(len(at)), [len(r) for r in at])
        sign = np.where(labels > 0, 1.0, -1.0)

        def loss(w: np.ndarray) -> tuple[float, np.ndarray]:
            z = sign * np.bincount(row, w[col], len(at))
            p = 1 / (1 + np.exp(np.clip(z, -30, 30)))
            return np.logaddexp(0, -z).sum() + ridge / 2 * (w @ w), np.bincount(col, (-sign * p)[row], len(names)) + ridge * w

        w = np.zeros(len(names))
        value, g = loss(w)
        past: list[tuple[np.ndarray, np.ndarray]] = []
        for _ in range(steps):
            d, alphas = -g.copy(), []
            for s, y in reversed(past):
                a = (s @ d) / (s @ y)
                alphas.append(a)
                d -= a * y
            if past:
                d *= (past[-1][0] @ past[-1][1]) / (past[-1][1] @ past[-1][1])
            else:
                d /= max(1.0, np.abs(g).max())
            for (s, y), a in zip(past, reversed(alphas)):
                d += s * (a - (y @ d) / (s @ y))
            slope, step = g @ d, 1.0
            while step > 1e-6:
                new, ng = loss(w + step * d)
                if new <= value + 1e-4 * step * slope:
                    break
                step /= 2
            else:
                break
            if (ng - g) @ d > 1e-12:
                past = [*past[-9:], (step * d, ng - g)]
            done = value - new < 1e-6 * value
            w, value, g = w + step * d, new, ng
            if done:
                break
        return cls({f: float(w[k]) for f, k in names.items()})

    def boundary(self, c: Candidate) -> bool:
        key = c.key()
        got = self.memo.get(key)
        if got is None:
            if len(self.memo) > 200_000:
                self.memo.clear()
            get = self.weights.get
            got = self.memo[key] = sum(get(f, 0.0) for f in c.features()) > 0
        return got


class Tally:
    """Counts of tokens at marks: (token, mark) at the end of blocks and inside,
    tokens that begin blocks and that follow marks inside. ``asked`` limits them
    to the tokens a sample needs. Short blocks that return are counted once."""

    KINDS = ("ends", "mids", "begins", "follows")

    def __init__(self, asked: set[tuple[str, str, str]] | None = None, memo: int = 50_000):
        self.asked, self.memo, self.known = asked, memo, {}
        self.n: Counter[tuple[str, str, str]] = Counter()

    def keys(self, s: str) -> list[tuple[str, str, str]]:
        out = [("begins", token_after(s, 0)[0], "")]
        for c in candidates(s):
            if c.resume >= len(s):
                out.append(("ends", c.prev, c.mark))
            else:
                out += [("mids", c.prev, c.mark), ("follows", c.next, "")]
        return out if self.asked is None else [k for k in out if k in self.asked]

    def add(self, text: str) -> None:
        for a, b in blocks(text):
            s = text[a:b]
            got = self.known.get(s)
            if got is None:
                got = self.keys(s)
                if b - a < 300:
                    if len(self.known) >= self.memo:
                        self.known.clear()
                    self.known[s] = got
            self.n.update(got)


def examples(cells: list[str]) -> tuple[list[Candidate], list[Candidate]]:
    """The last candidates of blocks, and those inside."""
    final: list[Candidate] = []
    inner: list[Candidate] = []
    for text in cells:
        spans = blocks(text)
        for k, (a, b) in enumerate(spans):
            s = text[a:b]
            after = text[spans[k + 1][0] : spans[k + 1][1]] if k + 1 < len(spans) else ""
            for c in candidates(s, after):
                (final if c.resume >= len(s) else inner).append(c)
    return final, inner


def asked_keys(inner: list[Candidate]) -> set[tuple[str, str, str]]:
    """The counts that decide about these candidates."""
    return {k for c in inner for k in (("ends", c.prev, c.mark), ("mids", c.prev, c.mark), ("begins", c.next, ""), ("follows", c.next, ""))}


def train(cells: list[str], counts: Counter[tuple[str, str, str]] | None = None) -> MaxEnt:
    """The model from raw text cells; ``counts`` of a whole corpus, or those of
    the cells."""
    final, inner = examples(cells)
    if counts is None:
        tally = Tally()
        for text in cells:
            tally.add(text)
        counts = tally.n
    rows, labels = [], []
    for c in final:
        if c.next != "<end>":
            rows.append(c.features())
            labels.append(1)
    for c in inner:
        mids, ends = counts["mids", c.prev, c.mark], counts["ends", c.prev, c.mark]
        follows, begins = counts["follows", c.next, ""], counts["begins", c.next, ""]
        odd = mids >= OFTEN and ends <= SELDOM * mids and c.prev not in ("<num>", "<mix>")
        # a capital behind a plain word is no reporting word; after a number it may be a month
        telling = not c.shape.startswith("upper") or c.prev == "<num>" or c.closed == "quote"
        odd_next = telling and follows >= OFTEN and begins <= SELDOM * follows
        if c.open or c.follow == "stop" or c.shape.startswith("lower") or odd or odd_next:
            rows.append(c.features())
            labels.append(0)
    return MaxEnt.fit(rows, np.array(labels))


class Segmenter:
    """Units of cells; short blocks that return (headings, stock sentences) are
    looked up in a bounded memo."""

    def __init__(self, model: MaxEnt, memo: int = 100_000):
        self.model, self.memo, self.known = model, memo, {}

    def block(self, s: str) -> list[tuple[int, int]]:
        out, start = [], 0
        for c in candidates(s):
            if c.resume < len(s) and c.end > start and self.model.boundary(c):
                out.append((start, c.end))
                start = c.resume
        if start < len(s):
            out.append((start, len(s)))
        return out

    def units(self, text: str) -> list[tuple[int, int]]:
        """Start and end of every sentence unit of a cell."""
        out = []
        for a, b in blocks(text):
            s = text[a:b]
            got = self.known.get(s)
            if got is None:
                got = self.block(s)
                if b - a < 300:
                    if len(self.known) >= self.memo:
                        self.known.clear()
                    self.known[s] = got
            out += [(a + x, a + y) for x, y in got]
        return out


def _cells(text: str | None, cells) -> Iterator[tuple[int, str]]:
    if text and cells is not None:
        for c in cells:
            if c is not None and c["kind"] == "text" and c["start_char"] is not None and c["end_char"] is not None:
                yield int(c["start_char"]), text[c["start_char"] : c["end_char"]]


def corpus_counts(documents: DataFrame, asked: set[tuple[str, str, str]]) -> Counter[tuple[str, str, str]]:
    """The asked counts over all documents; each task adds up its own first."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tally = Tally(asked)
        for pdf in batches:
            for text, cells in zip(pdf["text"], pdf["cells"]):
                for _, cell in _cells(text, cells):
                    tally.add(cell)
        yield pd.DataFrame([(*k, n) for k, n in tally.n.items()], columns=["kind", "token", "mark", "n"])

    parts = documents.select("text", "cells").mapInPandas(run, "kind string, token string, mark string, n long")
    return Counter({(r.kind, r.token, r.mark): r.n for r in parts.groupBy("kind", "token", "mark").agg(F.sum("n").alias("n")).collect()})  # as many as asked


def fitted(documents: DataFrame, sample: int = SAMPLE_DOCS) -> MaxEnt:
    n = documents.count()
    rank = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
    some = documents.select("doc_id", "text", "cells")
    if n > sample:
        some = some.where(rank < F.lit(int(sample / n * (1 << 30))))
    kept = F.filter("cells", lambda c: (c["kind"] == "text") & c["start_char"].isNotNull() & c["end_char"].isNotNull())
    texts = F.transform(kept, lambda c: F.struct(c["start_char"].alias("at"), F.substring(F.col("text"), c["start_char"].cast("int") + 1, (c["end_char"] - c["start_char"]).cast("int")).alias("t")))
    got = some.where("text is not null").select(rank.alias("rank"), "doc_id", F.inline(texts)).where("t <> ''")
    cells = [r.t for r in got.orderBy("rank", "doc_id", "at", "t").limit(SAMPLE_CELLS).collect()]
    return train(cells, corpus_counts(documents, asked_keys(examples(cells)[1])))


def sentence_units(documents: DataFrame, sample: int = SAMPLE_DOCS) -> DataFrame:
    """p9_found: doc_id, start_char and end_char of every unit."""
    weights = fitted(documents, sample).weights

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        segmenter = Segmenter(MaxEnt(weights))
        for pdf in batches:
            doc, start, end = [], [], []
            for d, text, cells in zip(pdf["doc_id"], pdf["text"], pdf["cells"]):
                for at, cell in _cells(text, cells):
                    for a, b in segmenter.units(cell):
                        doc.append(d)
                        start.append(at + a)
                        end.append(at + b)
            yield pd.DataFrame({"doc_id": np.array(doc, dtype=np.int64), "start_char": np.array(start, dtype=np.int64), "end_char": np.array(end, dtype=np.int64)})

    return documents.select("doc_id", "text", "cells").mapInPandas(run, "doc_id long, start_char long, end_char long")

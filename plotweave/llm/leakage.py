"""Held-out items whose passages turn up in corpus documents.

Texts are folded to plain words, so case, accents, look-alike letters, invisible
characters, markup, escapes and layout don't matter. A Wu-Manber search runs over
the words of each cell: the patterns are short windows of the items' words, the
shift table of two-word blocks skips positions where none can end, the bucket of
a block's hash names the windows to compare, and a direct comparison confirms.
Confirmed windows vote for an alignment of item and cell; an alignment with
enough votes is checked word by word: some run of at least half the item's words
in which at most one word in eight differs.

No vote is lost: a run of L words with L // 8 exchanged keeps at least
``least_votes(L)`` windows of three words, two apart, untouched. That number
falls where one more word may be exchanged, so an item asks for the least of all
run lengths it could leak with. Items of which three words or fewer make half are
searched by windows of that many words, one apart (no word of theirs may be
exchanged).

The folded items are written as a table of shards to the shared folder, and the
tasks read it there: items never pass through the driver, documents are never
moved and are read and folded once. A task keeps ``KEPT_SHARDS`` searchers; with
more shards it goes through them for every ``GROUP_CHARS`` of text.

Defined results: NULL or empty texts and cells leak nothing; items without words
after the shared opening leak nowhere; of an item of one or two words one word
is half; repeated items are reported each; an empty items table gives an empty
result.
"""

from __future__ import annotations

import html
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyarrow import fs as pafs
from pyarrow.dataset import dataset
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plotweave.session import drop_at_exit, shared_path

#: Words of a window, distance of windows, words of a block.
WINDOW, STRIDE, BLOCK = 3, 2, 2
#: One word in so many may differ; items of a shard (a mean; hashing spreads them).
EXCHANGE, SHARD_ITEMS = 8, 20_000
#: Searchers a task keeps, and the text it folds before it changes them.
KEPT_SHARDS, GROUP_CHARS = 2, 32_000_000

# Letters of other scripts, and of their own, that look like Latin ones.
_LOOKALIKE = str.maketrans({
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ј": "j", "ѕ": "s", "ԁ": "d", "һ": "h",
    "ӏ": "l", "ԛ": "q", "ԝ": "w", "ь": "b", "в": "b", "к": "k", "м": "m", "н": "h", "т": "t",
    "ο": "o", "α": "a", "ε": "e", "ρ": "p", "ι": "i", "κ": "k", "ν": "v", "υ": "u", "τ": "t", "χ": "x",
    "ı": "i", "ł": "l", "ø": "o", "đ": "d", "ɑ": "a", "ɡ": "g",
})
_TAG = re.compile(r"</?[A-Za-z][^<>]{0,80}>")
_ESCAPE = re.compile(r"\\(u[0-9a-fA-F]{4}|[nrt\"'\\/])")
_UNSEEN = re.compile("[\u00ad\u200b-\u200f\u2060-\u2064\ufeff\u034f\u061c\u180e]")
_WORD = re.compile(r"[\u3040-\u30ff\u3400-\u9fff]|[^\W_\u3040-\u30ff\u3400-\u9fff]+")  # unspaced scripts: letter by letter
_ASCII_WORD = re.compile(r"[a-z0-9]+")


def _escape(m: re.Match) -> str:
    x = m[1]
    return chr(int(x[1:], 16)) if x[0] == "u" else " "


def fold(text: str) -> list[str]:
    """The plain words of a text."""
    if "\\" in text:
        text = _ESCAPE.sub(_escape, text)
    if "&" in text:
        text = html.unescape(text)
    if "<" in text:
        text = _TAG.sub(" ", text)
    if text.isascii():
        return _ASCII_WORD.findall(text.lower())
    text = _UNSEEN.sub("", text).casefold()
    flat = unicodedata.normalize("NFKD", text)
    flat = "".join(ch for ch in flat if not unicodedata.combining(ch)) if flat != text else flat
    return _WORD.findall(flat.translate(_LOOKALIKE))


def least_votes(run: int) -> int:
    return max(1, (run - WINDOW + 1) // STRIDE - 2 * (run // EXCHANGE))


class WuManber:
    """Windows of words of many items; ``scan`` yields confirmed occurrences."""

    def __init__(self, items: list[tuple[int, list[str]]]):
        self.words: dict[str, int] = {}
        self.items = [(item, [self.words.setdefault(w, len(self.words) + 1) for w in ws]) for item, ws in items]
        self.need = [(len(ws) + 1) // 2 for _, ws in self.items]
        self.votes = [min(map(least_votes, range(n, len(ws) + 1)), default=1) for n, (_, ws) in zip(self.need, self.items)]
        self.skip = WINDOW - BLOCK + 1
        self.shift: dict[tuple[int, int], int] = {}
        self.bucket: dict[tuple[int, int], dict[int, list[tuple[int, int]]]] = {}
        self.short: dict[int, dict[tuple[int, ...], list[tuple[int, int]]]] = {}
        for k, (_, ws) in enumerate(self.items):
            if self.need[k] <= WINDOW:
                size = self.need[k]
                for at in range(len(ws) - size + 1 if size else 0):
                    self.short.setdefault(size, {}).setdefault(tuple(ws[at : at + size]), []).append((k, at))
                continue
            for at in range(0, len(ws) - WINDOW + 1, STRIDE):
                for end in range(BLOCK, WINDOW + 1):
                    block = tuple(ws[at + end - BLOCK : at + end])
                    self.shift[block] = min(self.shift.get(block, self.skip), WINDOW - end)
                block = tuple(ws[at + WINDOW - BLOCK : at + WINDOW])
                self.bucket.setdefault(block, {}).setdefault(ws[at], []).append((k, at))

    def scan(self, ids: list[int]) -> Iterator[tuple[int, list[tuple[int, int]]]]:
        shift, bucket, skip, n = self.shift, self.bucket, self.skip, len(ids)
        at = WINDOW - 1
        while at < n:
            b = ids[at]
            if not b:  # no item knows this word: no window can hold it
                at += WINDOW
                continue
            a = ids[at - 1]
            if not a:
                at += skip
                continue
            move = shift.get((a, b), skip)
            if move:
                at += move
                continue
            found = bucket[a, b].get(ids[at - WINDOW + 1])
            if found:
                yield at - WINDOW + 1, found
            at += 1

    def leaked(self, words: list[str]) -> set[int]:
        """Positions (in the shard) of the items that leaked into a cell."""
        get = self.words.get
        ids = [get(w, 0) for w in words]
        ballot: Counter[tuple[int, int]] = Counter()
        for at, found in self.scan(ids):
            for k, p in found:
                ballot[k, at - p] += 1
        out = {k for size, known in self.short.items() for at in range(len(ids) - size + 1) for k, _ in known.get(tuple(ids[at : at + size]), ())}
        for (k, offset), n in ballot.items():
            if n >= self.votes[k] and k not in out and self.run(k, offset, ids):
                out.add(k)
        return out

    def run(self, k: int, offset: int, ids: list[int]) -> bool:
        """Some run of the needed length with few enough exchanged words: a word
        that agrees counts 1, an exchanged one 1 - EXCHANGE; the sum over the run
        must not be negative."""
        ws, need = self.items[k][1], self.need[k]
        lo, hi = max(0, -offset), min(len(ws), len(ids) - offset)
        if hi - lo < need:
            return False
        total, sums, low = 0, [0], 0
        for j in range(lo, hi):
            total += 1 if ws[j] == ids[offset + j] else 1 - EXCHANGE
            sums.append(total)
            start = len(sums) - 1 - need
            if start >= 0:
                low = sums[0] if start == 0 else min(low, sums[start])
                if total >= low:
                    return True
        return False


def without_opening(items: DataFrame, shared_by: int = 3) -> DataFrame:
    """item_id and text without an opening line or sentence that at least
    ``shared_by`` items have in common."""
    opening = F.when(F.instr("text", "\n") > 0, F.regexp_extract("text", r"^\s*([^\n]*\S)\s*\n", 1)).otherwise(
        F.regexp_extract("text", r"^\s*(.*?[.!?:。！？।])\s+\S", 1))
    rows = items.where("text is not null").select("item_id", "text", opening.alias("opening"))
    rows = rows.withColumn("known", F.lower(F.regexp_replace("opening", r"\W+", " ")))
    common = rows.where("opening <> ''").groupBy("known").agg(F.count_distinct("item_id").alias("n")).where(F.col("n") >= shared_by)
    rest = F.expr("substring(text, instr(text, opening) + length(opening))")
    return rows.join(common, "known", "left").select("item_id", F.when(F.col("n").isNotNull(), rest).otherwise(F.col("text")).alias("text"))


def write_items(items: DataFrame) -> tuple[str, int]:
    """Folds the items and writes item_id and words, split by shard, to the
    shared folder; returns its path and the number of shards."""
    items = without_opening(items)
    shards = max(1, -(-items.count() // SHARD_ITEMS))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"item_id": pdf["item_id"], "words": [fold(t) for t in pdf["text"]]})

    folded = items.mapInPandas(run, "item_id long, words array<string>").where("size(words) > 0")
    folded = folded.withColumn("shard", F.pmod(F.xxhash64("item_id"), F.lit(shards)).cast("int"))
    path = shared_path(items.sparkSession, "items")
    folded.repartition(shards, "shard").write.partitionBy("shard").parquet(path)
    drop_at_exit(items.sparkSession, path)
    return path, shards


@lru_cache(maxsize=KEPT_SHARDS)
def searcher(path: str, shard: int) -> WuManber:
    """The searcher of one shard, read where the task runs."""
    system, where = pafs.FileSystem.from_uri(path)
    where = f"{where}/shard={shard}"
    if system.get_file_info(where).type == pafs.FileType.NotFound:  # no item fell into it
        return WuManber([])
    rows = dataset(where, filesystem=system, format="parquet").to_table(columns=["item_id", "words"]).to_pylist()
    return WuManber(sorted((r["item_id"], r["words"]) for r in rows))


def leaks(documents: DataFrame, items: DataFrame) -> DataFrame:
    """p8_found: doc_id and item_id of every leak."""
    path, shards = write_items(items)

    limit = 0 if shards <= KEPT_SHARDS else GROUP_CHARS

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        waiting: list[tuple[int, list[list[str]]]] = []
        rows: list[tuple[int, int]] = []

        def look() -> None:
            for shard in range(shards):
                wm = searcher(path, shard)
                for doc, cells in waiting:
                    rows.extend((doc, wm.items[k][0]) for k in set().union(*map(wm.leaked, cells)))
            waiting.clear()

        size = 0
        for pdf in batches:
            for doc, text, cells in zip(pdf["doc_id"], pdf["text"], pdf["cells"]):
                if not text or cells is None:
                    continue
                spans = ((c["start_char"], c["end_char"]) for c in cells if c is not None)
                waiting.append((doc, [fold(text[a:b]) for a, b in spans if a is not None and b is not None]))
                size += len(text)
                if size > limit:
                    size = 0
                    look()
            yield pd.DataFrame(rows, columns=["doc_id", "item_id"])
            rows.clear()
        look()
        yield pd.DataFrame(rows, columns=["doc_id", "item_id"])

    spans = F.transform("cells", lambda c: F.struct(c["start_char"].alias("start_char"), c["end_char"].alias("end_char")))
    return documents.select("doc_id", "text", spans.alias("cells")).mapInPandas(search, "doc_id long, item_id long")


def leak_report(documents: DataFrame, items: DataFrame) -> DataFrame:
    """p8_report: per item the number of documents it leaked into."""
    return leaks(documents, items).groupBy("item_id").agg(F.count_distinct("doc_id").alias("n_documents"))

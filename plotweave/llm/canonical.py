"""Free-typed values mapped to a canonical list.

Every entry of the list (squeezed to letters and digits) hangs in a BK-tree under
the Levenshtein distance, a true metric, so the triangle inequality may prune: a
search returns *every* entry within its radius. A swap of neighbours counts as
one edit for the threshold (unrestricted Damerau-Levenshtein); since that
distance is at least half the Levenshtein one, searching twice the threshold and
checking the hits loses nothing. A batch of values walks the tree together, one
bit-parallel step for all of them at a time.

What an entry may be called is learned from the data at hand, not written down:

* the reference list itself: labels, the synonyms its notes give after a
  semicolon, occupancy classes;
* repeated deliveries: a raw form becomes another name of an entry if structures
  it was delivered for were also delivered under that entry's own name, often
  enough (``LEAST_ROWS`` rows and ``LEAST_SHARE`` of the entry's rows) and hardly
  under another one (``PRECISION``, smoothed; ``ACCIDENT``, the chance that so many
  rows of a frequent entry agree by accident);
* words around a name that don't belong to it (``old``, ``brick``): those that
  stand before, or behind, names of at least ``LEAST_CODES`` different entries.

All three are counted over all rows, combined before the shuffle. Entries and
values meet by a co-grouping: entries are cut into shards of about
``SHARD_ENTRIES``, values into batches of about ``BATCH_VALUES``, each shard is
searched for each batch, and the shards' winners are merged by (distance, words
taken off, entry). The learned words around names go with every shard and batch.
Nothing of all this passes through the driver.

Values are searched once per distinct spelling (aggregated before the shuffle)
and the verdicts are joined back to the rows, those of very frequent values by
broadcast.

Defined results: NULL and blank values aren't cases; a value that is letter for
letter a label maps to it by the same search (distance 0); values farther than
the threshold from every entry are reported as ``none``; ties between entries
at equal distance go to the smallest type code; an empty list maps everything
to ``none``; without repeated deliveries only the list itself is known.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plotweave.functions.text import entity_key, not_blank
from plotweave.operators.skew import hot_keys, join_spread
from plotweave.session import cut

#: Entries of a shard and values of a batch (means; hashing spreads them).
SHARD_ENTRIES, BATCH_VALUES = 20_000, 2_000
#: What makes a raw form another name of an entry.
LEAST_ROWS, LEAST_SHARE, PRECISION, ACCIDENT = 2, 0.002, 0.75, 1e-3
#: Rounds of learning: names learned in the first vouch in the second.
ROUNDS = 2
#: Different entries a word must stand beside, words of a run.
LEAST_CODES, MOST_RUN = 3, 3
_CLASS = re.compile(r"^([a-z]{3}[0-9]{1,2})(?: ?[a-z]| [0-9][a-z]{2,4})?$")


def words(value: str) -> str:
    """Lower case, without accents, punctuation as blanks."""
    flat = unicodedata.normalize("NFKD", value.casefold())
    flat = "".join(ch for ch in flat if not unicodedata.combining(ch))
    return " ".join(re.findall(r"[^\W_]+", flat))


def squeezed(w: str) -> str:
    return w.replace(" ", "")


def generic(run: list[str]) -> str:
    """A run of words with short numbers as ``#``."""
    return " ".join("#" if t.isdigit() and len(t) <= 3 else t for t in run)


class Surround:
    """Words that may stand before or behind a name."""

    def __init__(self, before: set[str], behind: set[str]):
        self.before, self.behind = before, behind
        self.glued = [[squeezed(x) for x in side if "#" not in x and len(x) > 1] for side in (before, behind)]
        self.near = [BKTree(sorted(x for x in side if " " not in x and len(x) > 3)) for side in (before, behind)]

    def cuts(self, ts: list[str], known: Callable[[list[str], int], bool]) -> Iterator[list[str]]:
        """The words without one run at either end that ``known`` accepts."""
        for n in range(min(MOST_RUN, len(ts) - 1), 0, -1):
            if known(ts[:n], 0):
                yield ts[n:]
                break
        for n in range(min(MOST_RUN, len(ts) - 1), 0, -1):
            if known(ts[-n:], 1):
                yield ts[:-n]
                break

    def readings(self, value: str) -> list[str]:
        """Squeezed forms of a value: as typed, then with surrounding words taken
        off, then with surrounding words written together with the name."""
        forms = [words(value).split()]
        for ts in forms:  # grows while it is read
            if len(forms) < 12:
                forms += [f for f in self.cuts(ts, lambda run, side: generic(run) in (self.before, self.behind)[side]) if f not in forms]
        out = ["".join(f) for f in forms]
        for form in list(out):
            out += [form[len(w) :] for w in self.glued[0] if form.startswith(w)]
            out += [form[: -len(w)] for w in self.glued[1] if form.endswith(w)]
        return [y for y in dict.fromkeys(out) if y]

    def mistyped(self, value: str) -> list[str]:
        """Squeezed forms without an end word that is nearly a surrounding word."""
        ts = words(value).split()

        def known(run: list[str], side: int) -> bool:
            return len(run) == 1 and len(run[0]) > 3 and any(distance(run[0], k) <= 1 for k in self.near[side].within(run, [2])[0])

        return ["".join(f) for f in self.cuts(ts, known)] if len(ts) > 1 else []


def distance(a: str, b: str) -> int:
    """Unrestricted Damerau-Levenshtein distance (insert, delete, replace, swap
    of neighbours); a metric, unlike the restricted form."""
    if a == b:
        return 0
    n, m = len(a), len(b)
    far = n + m
    last: dict[str, int] = {}
    d = [[far] * (m + 2), [far, *range(m + 1)]]
    for i in range(1, n + 1):
        ch, row, above, seen = a[i - 1], [far, i], d[i], 0
        for j in range(1, m + 1):
            k, before = last.get(b[j - 1], 0), seen
            if ch == b[j - 1]:
                cost, seen = above[j], j
            else:
                cost = min(above[j], row[j], above[j + 1]) + 1
            if k and before:
                swap = d[k][before] + (i - k - 1) + 1 + (j - before - 1)
                if swap < cost:
                    cost = swap
            row.append(cost)
        last[ch] = i
        d.append(row)
    return d[-1][-1]


class BKTree:
    """Metric tree over strings; a batch of queries goes down it together."""

    def __init__(self, keys: list[str]):
        self.letters = {ch: k for k, ch in enumerate(sorted({ch for key in keys for ch in key}))}
        self.longest = max(map(len, keys), default=0)
        keys = sorted(set(keys), key=lambda k: (-len(k), k))
        codes, lens = self.coded(keys)
        self.root: list | None = [keys[len(keys) // 2], {}] if keys else None
        todo = [(self.root, np.arange(len(keys)))] if keys else []
        while todo:  # all keys below a node get their edges at once
            node, at = todo.pop()
            d = self.to_node(node[0], codes[at], lens[at])
            for edge in np.unique(d[d > 0]).tolist():
                part = at[d == edge]
                child = node[1][edge] = [keys[part[len(part) // 2]], {}]
                todo.append((child, part))

    def coded(self, queries: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Letter codes, padded, and lengths; queries come longest first."""
        lens = np.array([len(q) for q in queries])
        codes = np.full((len(queries), max(lens.max(initial=0), 1)), len(self.letters), dtype=np.int16)
        for i, q in enumerate(queries):
            codes[i, : len(q)] = [self.letters.get(ch, len(self.letters)) for ch in q]
        return codes, lens

    def to_node(self, key: str, codes: np.ndarray, lens: np.ndarray) -> np.ndarray:
        """Levenshtein distance of ``key`` to every query (Myers' bit vectors,
        one machine word for each query)."""
        m, n = len(key), len(lens)
        if m == 0:
            return lens.copy()
        if m > 63:
            back = {v: k for k, v in self.letters.items()}
            return np.array([_plain_distance(key, "".join(back.get(c, "\0") for c in row[:k])) for row, k in zip(codes, lens)])
        masks = np.zeros(len(self.letters) + 1, dtype=np.uint64)
        for i, ch in enumerate(key):
            masks[self.letters[ch]] |= np.uint64(1 << i)
        one, top = np.uint64(1), np.uint64(m - 1)
        pv, nv = np.full(n, (1 << m) - 1, dtype=np.uint64), np.zeros(n, dtype=np.uint64)
        score = np.full(n, m, dtype=np.int64)
        for j in range(int(lens.max(initial=0))):
            k = int(np.searchsorted(-lens, -j, side="left"))  # queries longer than j
            eq, p, q = masks[codes[:k, j]], pv[:k], nv[:k]
            x = eq | q
            d0 = ((p + (x & p)) ^ p) | x
            hn, hp = p & d0, q | ~(p | d0)
            score[:k] += ((hp >> top) & one).astype(np.int64) - ((hn >> top) & one).astype(np.int64)
            x = (hp << one) | one
            nv[:k] = x & d0
            pv[:k] = (hn << one) | ~(x | d0)
        return score

    def within(self, queries: list[str], radii: list[int]) -> list[list[str]]:
        """For each query every key at most its radius away."""
        out: list[list[str]] = [[] for _ in queries]
        order = sorted((i for i, q in enumerate(queries) if len(q) <= self.longest + radii[i]), key=lambda i: -len(queries[i]))
        if not order or self.root is None:
            return out
        codes, lens = self.coded([queries[i] for i in order])
        wide = np.array([radii[i] for i in order])
        todo = [(self.root, np.arange(len(order)))]
        while todo:
            (key, below), at = todo.pop()
            d = self.to_node(key, codes[at], lens[at])
            for i in at[d <= wide[at]]:
                out[order[i]].append(key)
            for edge, child in below.items():
                near = at[np.abs(d - edge) <= wide[at]]
                if len(near):
                    todo.append((child, near))
        return out


def _plain_distance(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        left, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            left, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, left + (x != y))
    return row[-1]


def radius_for(key: str, per: int = 4, most: int = 2) -> int:
    """Edits allowed: none up to three letters, one up to seven, two beyond."""
    return 0 if len(key) < 4 else min(most, max(1, len(key) // per))


class Mapper:
    """One shard's search: value to (distance, words taken off, code) or None."""

    def __init__(self, entries: dict[str, str], classes: dict[str, str], surround: Surround):
        self.entries, self.classes, self.surround = entries, classes, surround
        self.tree = BKTree(list(entries))

    def best(self, values: list[str]) -> list[tuple[int, int, str] | None]:
        """The nearest entry of each value. Readings that are an entry are asked
        for with radius 0, as no other can be nearer."""
        found: list[tuple[int, int, str] | None] = [None] * len(values)
        asked: list[tuple[int, int, str, int]] = []
        for i, value in enumerate(values):
            code = _CLASS.match(words(value))
            if code and code[1] in self.classes:
                found[i] = 0, 0, self.classes[code[1]]
                continue
            forms = self.surround.readings(value)
            exact = next((k for k, f in enumerate(forms) if f in self.entries), None)
            if exact is not None:
                asked.append((i, exact, forms[exact], 0))
            else:
                asked += [(i, k, f, radius_for(f)) for k, f in enumerate(forms + self.surround.mistyped(value)) if len(f) > 3]
        forms = list(dict.fromkeys((f, r) for *_, f, r in asked))
        near = {}
        for (form, r), keys in zip(forms, self.tree.within([f for f, _ in forms], [2 * r for _, r in forms])):
            near[form, r] = min(((d, self.entries[k]) for k in keys if (d := distance(form, k)) <= r), default=None)
        for i, k, form, r in asked:
            hit = near[form, r]
            if hit is not None and (found[i] is None or (hit[0], k, hit[1]) < found[i]):
                found[i] = hit[0], k, hit[1]
        return found


#: kinds of entries, the stronger first; words before and behind names
_LABEL, _CLASS_OF, _NOTE, _LEARNED, _BEFORE, _BEHIND = 0, 1, 2, 3, 4, 5


def synonyms(note: str | None) -> list[str]:
    """Names in a note: the list behind a semicolon, or a bare list of words."""
    if not isinstance(note, str):
        return []
    meaning, mark, names = note.partition(";")
    got = [n.strip() for n in re.split(r",|\bor\b", names if mark else meaning)]
    return got if mark or (len(got) > 1 and all(re.fullmatch(r"\w+", n) for n in got)) else []


def reference_entries(types: DataFrame) -> DataFrame:
    """key, kind, code of every label, synonym in a note and occupancy class."""
    note = F.col("note").cast("string") if "note" in types.columns else F.lit(None).cast("string")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for code, label, note, occ in zip(pdf["type_code"], pdf["type_label"], pdf["note"], pdf["occ_prefix"]):
                out.append((squeezed(words(label)), _LABEL, code))
                out += [(squeezed(words(name)), _NOTE, code) for name in synonyms(note)]
                if isinstance(occ, str):
                    out.append((squeezed(words(occ)), _CLASS_OF, code))
            yield pd.DataFrame([r for r in out if r[0]], columns=["key", "kind", "code"])

    rows = types.where("type_code is not null and type_label is not null").select("type_code", "type_label", note.alias("note"), "occ_prefix")
    return rows.mapInPandas(run, "key string, kind int, code string")


def forms_of(structures: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(form, words, generic, key, is_class, n) of every raw value, and (entity,
    form, n): in how many rows a structure has it. Structures and values travel
    as 64-bit keys; a rare clash is one wrong voice among many."""
    raw = F.col("StructureTypeRaw")
    rows = structures.where(not_blank(raw))
    counts = rows.groupBy(raw.alias("value")).agg(F.count(F.lit(1)).alias("n"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            ws = [words(v) for v in pdf["value"]]
            yield pd.DataFrame({"value": pdf["value"], "words": ws, "generic": [generic(w.split()) for w in ws], "n": pdf["n"]})

    values = counts.mapInPandas(run, "value string, words string, generic string, n long").where("words <> ''")
    of_class = F.regexp_extract("words", _CLASS.pattern, 1)
    values = values.select(F.xxhash64("value").alias("form"), "words", "generic", F.when(of_class != "", of_class).otherwise(F.translate("words", " ", "")).alias("key"), (of_class != "").alias("is_class"), "n")
    owner = entity_key(F.col("StructureID"))
    pairs = rows.where(owner.isNotNull()).groupBy(F.xxhash64(owner).alias("entity"), F.xxhash64(raw).alias("form")).agg(F.count(F.lit(1)).alias("n"))
    return cut(values), cut(pairs)


def vouched_forms(values: DataFrame, pairs: DataFrame, entries: DataFrame) -> DataFrame:
    """words, generic, code, n: in how many rows a raw form stands in a structure
    of which another row is written like an entry. Structures whose rows name
    different entries vouch for nothing."""
    right_kind = F.col("is_class") == (F.col("kind") == _CLASS_OF)
    coded = values.join(entries, "key", "left").select("form", "words", "generic", "n", F.when(right_kind, F.col("code")).alias("code"))
    coded = cut(coded)
    told = join_spread(pairs, coded.select("form", "code"), "form", hot_keys(coded, "form"))
    told = cut(told)
    known = told.where("code is not null").groupBy("entity").agg(F.sum("n").alias("voices"), F.min("code").alias("told"), F.max("code").alias("other")).where("told = other")
    hot = hot_keys(told.groupBy("entity").agg(F.sum("n").alias("n")), "entity")
    joined = join_spread(told, known.select("entity", "told", "voices"), "entity", hot)
    vouched = joined.where("code is null or voices > 1").groupBy("form", F.col("told").alias("code")).agg(F.sum("n").alias("n"))
    return vouched.join(coded.select("form", "words", "generic"), "form").groupBy("words", "generic", "code").agg(F.sum("n").alias("n"))


def learned_names(forms: DataFrame) -> DataFrame:
    """key, kind, code of the raw forms that mean one entry. Forms with numbers
    must mean it whatever the number is."""
    def means(df: DataFrame, key: str) -> DataFrame:
        per_key = df.groupBy(key, "code").agg(F.sum("n").alias("n"))
        best = per_key.groupBy(key).agg(F.sum("n").alias("all"), F.max(F.struct("n", "code")).alias("m")).select(key, "all", "m.n", "m.code")
        return best.where((F.col("n") + 1) / (F.col("all") + 2) >= PRECISION)

    size = forms.groupBy("code").agg(F.sum("n").alias("rows"))
    total = size.agg(F.sum("rows")).first()[0] or 1
    size = size.withColumn("chance", F.col("rows") / F.lit(float(total)))
    by_key = means(forms.withColumn("key", F.translate("words", " ", "")), "key").join(size, "code")
    # so many rows of one entry must not be an accident of its frequency
    sure = (F.col("n") >= LEAST_ROWS) & (F.col("n") >= LEAST_SHARE * F.col("rows")) & (F.pow("chance", F.col("n")) <= ACCIDENT)
    numbers = forms.where("generic <> words")
    whatever = means(numbers, "generic").select("generic", "code").join(numbers.select("generic", F.translate("words", " ", "").alias("key")).distinct(), "generic").select("key", "code", F.lit(True).alias("whatever"))
    odd = numbers.select(F.translate("words", " ", "").alias("key"), F.lit(True).alias("numbered")).distinct()
    kept = by_key.where(sure).join(odd, "key", "left").join(whatever.distinct(), ["key", "code"], "left").where("numbered is null or whatever")
    return kept.select("key", F.lit(_LEARNED).alias("kind"), "code")


def learned_surround(forms: DataFrame, entries: DataFrame) -> DataFrame:
    """key, kind: the runs of words beside names of several entries."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for w, code in zip(pdf["words"], pdf["code"]):
                ts = w.split()
                for k in range(1, min(MOST_RUN, len(ts) - 1) + 1):
                    out.append((_BEFORE, generic(ts[:k]), "".join(ts[k:]), code))
                    out.append((_BEHIND, generic(ts[-k:]), "".join(ts[:-k]), code))
            yield pd.DataFrame(out, columns=["side", "run", "key", "code"])

    split = forms.mapInPandas(run, "side int, run string, key string, code string")
    # one row for a run and code first, so a frequent run isn't counted in one task
    beside = split.join(entries.where(F.col("kind") != _CLASS_OF).select("key", "code"), ["key", "code"]).select("side", "run", "code").distinct()
    kept = beside.groupBy("side", "run").agg(F.count(F.lit(1)).alias("codes")).where(F.col("codes") >= LEAST_CODES)
    return cut(kept.select(F.col("run").alias("key"), F.col("side").alias("kind")))


def lexicon(structures: DataFrame, types: DataFrame) -> tuple[DataFrame, DataFrame]:
    """key, kind, code of all entries, and the words around names. Of equal keys
    labels come first, then notes, then learned names, then the smaller code."""
    reference = reference_entries(types)
    values, pairs = forms_of(structures)

    def settled(every: DataFrame) -> DataFrame:
        return cut(every.groupBy("key").agg(F.min(F.struct("kind", "code")).alias("m")).select("key", "m.kind", "m.code"))

    entries = settled(reference)
    for _ in range(ROUNDS):
        forms = cut(vouched_forms(values, pairs, entries))
        entries = settled(reference.unionByName(learned_names(forms)))
    return entries, learned_surround(forms, entries)


def map_values(values: DataFrame, entries: DataFrame, surround: DataFrame | Surround, shard_entries: int = SHARD_ENTRIES) -> DataFrame:
    """``values(value string)`` to ``value, type_code, distance``. ``surround``:
    the table of ``learned_surround``, or given words."""
    values = cut(values.select("value"))
    shards = max(1, -(-entries.count() // shard_entries))
    batches = max(1, -(-values.count() // BATCH_VALUES))
    tasks = shards * batches
    numbers = F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))
    asked = values.select("value", numbers.alias("shard"), F.pmod(F.xxhash64("value"), F.lit(batches)).cast("int").alias("batch"))
    known = entries.select("key", "kind", "code", F.pmod(F.xxhash64("key"), F.lit(shards)).cast("int").alias("shard"))
    given = surround if isinstance(surround, Surround) else None
    if given is None:
        known = known.unionByName(surround.select("key", "kind", F.lit(None).cast("string").alias("code"), numbers.alias("shard")))
    known = known.select("*", F.explode(F.sequence(F.lit(0), F.lit(batches - 1))).alias("batch"))

    def search(asked: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        around = given or Surround(*(set(known["key"][known["kind"] == side]) for side in (_BEFORE, _BEHIND)))
        of_class = known["kind"] == _CLASS_OF
        names = known[~of_class & (known["kind"] < _BEFORE)]
        mapper = Mapper(dict(zip(names["key"], names["code"])), dict(zip(known["key"][of_class], known["code"][of_class])), around)
        got = mapper.best(list(asked["value"]))
        return pd.DataFrame({
            "value": asked["value"], "distance": pd.array([g[0] if g else None for g in got], dtype="Int32"),
            "form": pd.array([g[1] if g else None for g in got], dtype="Int32"), "type_code": [g[2] if g else None for g in got],
        })

    def spread(df: DataFrame):
        return df.repartition(2 * tasks, "shard", "batch").groupBy("shard", "batch")  # a number adaptive execution leaves alone

    found = spread(asked).cogroup(spread(known)).applyInPandas(search, "value string, distance int, form int, type_code string")
    hit = F.when(F.col("type_code").isNotNull(), F.struct("distance", "form", "type_code"))
    merged = found.groupBy("value").agg(F.min(hit).alias("m"))
    return merged.select("value", F.coalesce("m.type_code", F.lit("none")).alias("type_code"), F.col("m.distance").alias("distance"))


def typed_rows(structures: DataFrame, types: DataFrame) -> DataFrame:
    """p6_found: record_id and type_code of every row whose raw type isn't blank
    and isn't letter for letter a label."""
    entries, surround = lexicon(structures, types)
    labels = types.select(F.col("type_label").alias("StructureTypeRaw")).where("StructureTypeRaw is not null").distinct()
    rows = structures.select("record_id", "StructureTypeRaw").where(not_blank(F.col("StructureTypeRaw")))
    rows = rows.join(F.broadcast(labels) if labels.count() <= SHARD_ENTRIES else labels, "StructureTypeRaw", "left_anti").withColumnRenamed("StructureTypeRaw", "value")
    values = cut(rows.groupBy("value").agg(F.count(F.lit(1)).alias("n")))
    verdicts = map_values(values, entries, surround)
    return join_spread(rows, verdicts, "value", hot_keys(values, "value")).select("record_id", "type_code")


def type_report(structures: DataFrame, types: DataFrame) -> DataFrame:
    """p6_report: every distinct raw value with its canonical label, rows and
    distance; ``none`` marks the unmatched ones."""
    entries, surround = lexicon(structures, types)
    values = cut(
        structures.where(not_blank(F.col("StructureTypeRaw"))).groupBy(F.col("StructureTypeRaw").alias("value")).agg(F.count(F.lit(1)).alias("n_rows"))
    )
    verdicts = map_values(values, entries, surround)
    labels = types.select("type_code", F.col("type_label").alias("StructureType"))
    return values.join(verdicts, "value").join(labels, "type_code", "left").select("value", "type_code", "StructureType", "n_rows", "distance")

"""Canonical values: the tree against brute force, and readings of values."""

import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from plotweave.llm import canonical as ca
from plotweave.operators import skew

words = st.text("abcd", max_size=9)


def slow(a, b):
    """Damerau-Levenshtein by its definition over a table of all prefixes."""
    d = {}
    for i in range(len(a) + 1):
        for j in range(len(b) + 1):
            best = i + j if not i or not j else min(d[i - 1, j] + 1, d[i, j - 1] + 1, d[i - 1, j - 1] + (a[i - 1] != b[j - 1]))
            for k in range(1, i):
                for m in range(1, j):
                    if a[k - 1] == b[j - 1] and a[i - 1] == b[m - 1]:
                        best = min(best, d[k - 1, m - 1] + (i - k - 1) + 1 + (j - m - 1))
            d[i, j] = best
    return d[len(a), len(b)]


@settings(max_examples=150, deadline=None)
@given(words, words, words)
def test_distance_is_a_metric(a, b, c):
    assert ca.distance(a, b) == slow(a, b) == ca.distance(b, a)
    assert ca.distance(a, c) <= ca.distance(a, b) + ca.distance(b, c)
    assert ca._plain_distance(a, b) <= 2 * ca.distance(a, b)


@settings(max_examples=40, deadline=None)
@given(st.lists(words.filter(len), max_size=40), st.lists(words, max_size=20), st.integers(0, 4))
def test_tree_finds_everything(keys, queries, radius):
    got = ca.BKTree(keys).within(queries, [radius] * len(queries))
    assert [sorted(g) for g in got] == [sorted({k for k in keys if ca._plain_distance(k, q) <= radius}) for q in queries]


def test_long_keys():
    key = "ab" * 50
    assert ca.BKTree([key, "x"]).within([key[:-1], "", "y" * 20_000], [1, 1, 1]) == [[key], ["x"], []]


TYPES = [("T1", "detached house", "RES1"), ("T2", "private garage", None), ("T3", "parking garage", "COM10"), ("T4", "retail store", "COM1"), ("T5", "warehouse", "COM2")]


SCHEMA = "type_code string, type_label string, occ_prefix string"
#: other names, told only by structures that were delivered under both
TOLD = {"carport": "private garage", "det. garage": "private garage", "Einfamilienhaus": "detached house", "whse": "warehouse"}
BEFORE, BEHIND = ("the", "main", "former"), ("brick", "yes", "(north wing)", "no. 4")


def deliveries(times=6):
    """record_id, raw, StructureID: structures delivered under two names."""
    pairs = list(TOLD.items())
    pairs += [(f"{q} {label}", label) for q in BEFORE for _, label, _ in TYPES] + [(f"{label} {q}", label) for q in BEHIND for _, label, _ in TYPES]
    noise = [(("misc", "lot 7 rear")[k % 2], TYPES[k % 5][1]) for k in range(10)]
    every = [x for x in pairs for _ in range(times)] + noise
    return [(1000 + 2 * k + j, raw, f"s{k}") for k, x in enumerate(every) for j, raw in enumerate(x)]


def test_rows(spark):
    types = spark.createDataFrame(TYPES, SCHEMA)
    raw = {"detached house": None, "Detached House": "T1", "the detahced  house (north wing)": "T1", "RES1-2SWB": "T1", "COM10": "T3", "com1a": "T4", "COM2-1SNB": "T5",
           "prviategarage": "T2", "maincarport, brick": "T2", "Einfamilienhaus / yes": "T1", "lot 153 rear": "none", "???": "none", "misc": "none", "x" * 5000: "none",
           "permit 59-533": "none", " ": None, None: None, "former DET. GARAGE no. 2": "T2", "formre carport": "T2"}
    rows = [(i, r, None, "clash") for i, r in enumerate(raw)] + [(99, "misc", " ", "clash")] + [(*r, "clash") for r in deliveries()]
    df = spark.createDataFrame(rows, "record_id long, StructureTypeRaw string, StructureID string, value string")
    got = {r.record_id: r.type_code for r in ca.typed_rows(df, types).collect()}
    assert {i: c for i, c in got.items() if i < 1000} == {i: c for i, c in enumerate(raw.values()) if c} | {99: "none"}
    assert ca.typed_rows(df, types.limit(0)).where("type_code <> 'none'").count() == 0
    assert ca.typed_rows(df.limit(0), types).count() == 0
    report = {r.value: (r.StructureType, r.n_rows) for r in ca.type_report(df, types).collect()}
    assert report["misc"] == (None, 7) and report["detached house"][0] == "detached house"


def test_unseen_spellings(spark):
    """Recall on spellings no delivery has: one edit in a name longer than three
    letters, two in one longer than seven."""
    rng = random.Random(3)
    types = spark.createDataFrame(TYPES, SCHEMA)
    names = {label: code for code, label, _ in TYPES} | {k: {x[1]: x[0] for x in TYPES}[v] for k, v in TOLD.items()}

    def typed(name):
        t = list(name)
        for _ in range(2 if len(ca.squeezed(ca.words(name))) > 9 else 1):
            k = rng.randrange(1, len(t) - 1)
            t[k : k + 1] = rng.choice(([], [t[k]] * 2, [rng.choice("aeinrst")]))
        return "".join(t)

    asked = [(i, typed(name), None, code) for i, (name, code) in enumerate(list(names.items()) * 30)]
    df = spark.createDataFrame([a[:3] for a in asked] + deliveries(), "record_id long, StructureTypeRaw string, StructureID string")
    got = {r.record_id: r.type_code for r in ca.typed_rows(df, types).collect()}
    hits = [got.get(i) == code for i, raw, _, code in asked if i in got]
    assert len(hits) > 200 and sum(hits) / len(hits) > 0.95


def test_notes():
    assert ca.synonyms("two dwellings; a twin or pair") == ["a twin", "pair"] and ca.synonyms("church, mosque or temple") == ["church", "mosque", "temple"]
    assert ca.synonyms("plays, films or concerts before an audience") == ca.synonyms(None) == []


def test_shards_agree(spark):
    types = spark.createDataFrame(TYPES, SCHEMA)
    values = spark.createDataFrame([("privat garage",), ("ware house",), ("lot 1",), ("RES1",)], "value string")
    entries, none = ca.reference_entries(types).groupBy("key").agg(F.min("kind").alias("kind"), F.min("code").alias("code")), ca.Surround(set(), set())
    one, many = (sorted(map(tuple, ca.map_values(values, entries, none, n).collect())) for n in (100, 2))
    assert one == many and [r[1] for r in one] == ["T1", "none", "T2", "T5"]


def test_shard_overflow(spark):
    """A code with more labels than a shard holds keeps them all."""
    types = spark.createDataFrame([("T1", f"name number{chr(97 + i % 26)}{chr(97 + i // 26)} {'zyxw'[i % 4] * 6}", None) for i in range(50)], SCHEMA)
    values = types.select(F.col("type_label").alias("value"))
    entries = ca.reference_entries(types)
    assert ca.map_values(values, entries, ca.Surround(set(), set()), 20).where("type_code = 'T1' and distance = 0").count() == 50


def test_all_surrounding_words(spark):
    """More words around names than one would list by hand: all of them are known."""
    types = spark.createDataFrame(TYPES, SCHEMA)
    entries = ca.reference_entries(types).groupBy("key").agg(F.min("kind").alias("kind"), F.min("code").alias("code"))
    runs = ["".join(2 * chr(97 + k // 26**j % 26) for j in range(3)) for k in range(2100)]
    told = [(f"{r} {label}", code, 1) for r in runs for code, label, _ in TYPES[:3]]
    surround = ca.learned_surround(spark.createDataFrame(told, "words string, code string, n long"), entries)
    values = spark.createDataFrame([(f"{r} warehouse",) for r in runs], "value string")
    assert ca.map_values(values, entries, surround).where("type_code = 'T5' and distance = 0").count() == 2100


def test_hot_value(spark, monkeypatch):
    types = spark.createDataFrame(TYPES, SCHEMA)
    df = spark.range(900).selectExpr("id AS record_id", "if(id % 3 = 0, 'Warehouse', concat('retail stor ', id % 7)) AS StructureTypeRaw", "cast(null AS string) AS StructureID")
    plain = sorted(map(tuple, ca.typed_rows(df, types).collect()))
    monkeypatch.setattr(skew, "HOT_ROWS", 50)
    assert sorted(map(tuple, ca.typed_rows(df, types).collect())) == plain and len(plain) == 900

"""Leakage search against brute force over all alignments."""

import random

from plotweave.llm import leakage as lk

OPEN = "Read the passage below and answer the question."
CELLS = "cells array<struct<cell_no:int,kind:string,exec_count:int,start_char:bigint,end_char:bigint>>"


def brute(words, items):
    out = set()
    for k, (_, ws) in enumerate(items):
        need = (len(ws) + 1) // 2
        for off in range(-len(ws), len(words)):
            flags = [ws[j] == words[off + j] for j in range(len(ws)) if 0 <= off + j < len(words)]
            for a in range(len(flags)):
                for b in range(a + need, len(flags) + 1):
                    if (flags[a:b].count(False)) * lk.EXCHANGE <= b - a:
                        out.add(k)
    return out


def test_against_brute_force():
    rng = random.Random(4)
    pool = [f"w{i}" for i in range(30)]
    items = [(i, [rng.choice(pool) for _ in range(rng.randint(8, 30))]) for i in range(12)]
    wm = lk.WuManber(items)
    found = 0
    for _ in range(150):
        words = [rng.choice(pool) for _ in range(rng.randint(0, 40))]
        if rng.random() < 0.7:
            ws = list(rng.choice(items)[1])
            a = rng.randint(0, len(ws) // 2)
            part = ws[a : a + rng.randint(len(ws) // 3, len(ws))]
            for j in range(len(part)):
                if rng.random() < 0.1:
                    part[j] = "zz"
            at = rng.randint(0, len(words))
            words[at:at] = part
        want = brute(words, items)
        assert wm.leaked(words) == want
        found += len(want)
    assert found > 40


def test_least_votes_is_safe():
    """Whatever L // 8 words are exchanged, so many windows of the grid survive."""
    rng = random.Random(2)
    for run in range(4, 60):
        for start in (0, 1):
            for _ in range(60):
                lost = set(rng.sample(range(run), run // lk.EXCHANGE))
                alive = sum(not lost & set(range(a, a + lk.WINDOW)) for a in range(start, run - lk.WINDOW + 1, lk.STRIDE))
                assert alive >= lk.least_votes(run) or alive == lk.least_votes(run) == 1 or run < 8


def test_longer_run_with_fewer_votes():
    """32 words with 4 exchanged keep 7 windows, 30 words with 3 keep 8."""
    item = [f"w{i}" for i in range(60)]
    words = item[1:33]
    for j in (5, 11, 17, 23):
        words[j] = "zz"
    wm = lk.WuManber([(0, item)])
    assert wm.leaked(words) == brute(words, [(0, item)]) == {0}
    rng, lost = random.Random(8), 0
    for n, run in ((60, 32), (60, 33), (75, 40), (91, 48), (44, 24)):
        item = [f"w{i}" for i in range(n)]
        wm = lk.WuManber([(0, item)])
        for _ in range(1500):
            a = rng.randint(0, n - run)
            words = item[a : a + run]
            for j in rng.sample(range(run), run // lk.EXCHANGE):
                words[j] = "zz"
            lost += not wm.leaked(words)
    assert lost == 0


def test_fold():
    want = "when 42 ulbreth pasan aun la cordeleria".split()
    for t in ("When 42 Ulbreth pasan aún la cordelería", "When​ 42 Ulbre​th pаsаn aún la cordelería", "<p>When&nbsp;42 Ulbreth</p>\n# pasan aún la // cordelería",
              '"When 42\\nUlbreth pasan a\\u00fan la cordeler\\u00eda"', "ＷＨＥＮ  42  ulbreth  pasan\naun la CORDELERIA"):
        assert lk.fold(t) == want


def test_documents(spark):
    items = [(i, f"{OPEN} Item {i} " + " ".join(f"x{i}y{j}" for j in range(20)), "en") for i in range(4)] + [(9, None, "en"), (8, "", "en"), (7, "....", "en")]
    items = spark.createDataFrame(items, "item_id long, text string, lang string").withColumnRenamed("lang", "known")
    whole = " ".join(f"X1y{j}," for j in range(12))

    def doc(i, text, *spans):
        return i, text, [(k, "output", None, a, b) for k, (a, b) in enumerate(spans)] if spans != (None,) else None, "clash"

    long = "lorem ipsum " * 30_000
    docs = [doc(1, whole, (0, len(whole))), doc(2, whole, (0, 40), (40, len(whole))), doc(3, None, (0, 5)), doc(4, "", (0, 0)), doc(5, whole, None), doc(6, whole),
            doc(7, f"{OPEN} {OPEN}", (0, 90)), doc(8, long + whole, (0, len(long + whole))), doc(9, whole, (0, 10_000)), doc(1, whole, (0, len(whole)))]
    df = spark.createDataFrame(docs, f"doc_id long, text string, {CELLS}, item_id string")
    assert sorted((r.doc_id, r.item_id) for r in lk.leaks(df, items).collect()) == [(1, 1), (1, 1), (8, 1), (9, 1)]
    assert {(r.item_id, r.n_documents) for r in lk.leak_report(df, items).collect()} == {(1, 3)}
    assert lk.leaks(df, items.limit(0)).count() == 0 and lk.leaks(df.limit(0), items).count() == 0


def test_shards(spark, monkeypatch):
    items = spark.createDataFrame([(i, " ".join(f"x{i}y{j}" for j in range(10))) for i in range(9)], "item_id long, text string")
    text = " ".join(f"x{i}y{j}" for i in range(9) for j in range(10))
    df = spark.createDataFrame([(1, text, [(0, "text", None, 0, len(text))])], f"doc_id long, text string, {CELLS}")
    monkeypatch.setattr(lk, "SHARD_ITEMS", 2)
    assert sorted(r.item_id for r in lk.leaks(df, items).collect()) == list(range(9))


def test_short_items_against_brute_force():
    rng = random.Random(5)
    pool = [f"w{i}" for i in range(12)]
    items = [(i, [rng.choice(pool) for _ in range(rng.randint(1, 9))]) for i in range(14)]
    wm, found = lk.WuManber(items), 0
    for _ in range(200):
        words = [rng.choice(pool) for _ in range(rng.randint(0, 14))]
        want = brute(words, items)
        assert wm.leaked(words) == want
        found += len(want)
    assert found > 100


def test_short_item_in_a_document(spark):
    items = spark.createDataFrame([(1, "seven plain words make up this item"), (2, "uno dos tres"), (3, "alone")], "item_id long, text string")
    texts = ["say: Seven plain words make up this item!", "uno, dos", "uno tres", "not ALONE here"]
    df = spark.createDataFrame([(i, t, [(0, "text", None, 0, len(t))]) for i, t in enumerate(texts)], f"doc_id long, text string, {CELLS}")
    assert sorted(map(tuple, lk.leaks(df, items).collect())) == [(0, 1), (1, 2), (3, 3)]


def test_changing_searchers(spark, monkeypatch):
    """More shards than a task keeps: documents wait in groups."""
    items = spark.createDataFrame([(i, " ".join(f"x{i}y{j}" for j in range(10))) for i in range(9)], "item_id long, text string")
    texts = [" ".join(f"x{i}y{j}" for j in range(10)) for i in range(9)] * 3
    df = spark.createDataFrame([(n, t, [(0, "text", None, 0, len(t))]) for n, t in enumerate(texts)], f"doc_id long, text string, {CELLS}")
    monkeypatch.setattr(lk, "SHARD_ITEMS", 1)
    monkeypatch.setattr(lk, "GROUP_CHARS", 100)
    assert sorted(map(tuple, lk.leaks(df, items).collect())) == [(n, n % 9) for n in range(27)]

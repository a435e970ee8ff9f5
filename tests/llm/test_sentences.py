"""Sentence units: blocks, quotes, and held-out accuracy on made-up prose."""

import random

import pytest
from pyspark.sql import functions as F

from plotweave.llm import sentences as se

CELLS = "cells array<struct<cell_no:int,kind:string,exec_count:int,start_char:bigint,end_char:bigint>>"
# sentences with their traps, by language
STOCK = [
    ["Dr. Amato compared the roofs.", "It stops at 9 a.m.", "See Fig. 3 for the plan.", "Roofs, walls, etc. were counted.", "She said, “Run it twice.”",
     "“Does it hold?” asked Brown.", "(The rest is kept for later.)", "The value is 3.14 or less.", "Wait...", "Load tile.parquet before noon.", "We saw No. 7 and no. 8.",
     "Brown answered: “It holds. Check it.”", "Is it raw, or only noisy?!", "We tried it... and it failed."],
    ["Am 3. Mai wurden Dächer gezählt.", "Das ist z. B. ein Dach.", "„Stimmt das?“, fragte Braun.", "Im 19. Jahrhundert stand hier nichts.", "Warum fehlt Nr. 3?"],
    ["他说：“先检查这一列。”", "“结果对吗？”助教问道。", "模型没有收敛……", "数据分为训练集、验证集等。", "平均值是8.5，方差很小；先不要改。"],
    ["Είναι σωστό αυτό;", "Βλ. σχ. 3 στο τέλος.", "Τρέξε ξανά το κελί!", "Λείπει η γραμμή 7;"],
    ["« Est-ce juste ? » demanda Brun.", "Voir fig. 4, p. 48.", "M. Brun a mesuré 3,5 mètres.", "Relancez le noyau !"],
    ["ค่าเฉลี่ยคือ9.29เมตร", "แถวที่ว่างเปล่า", "หลังคากว้างมาก"],
    ["यह ठीक है।", "“क्या यह ठीक है?” सहायक ने पूछा।", "डॉ. ने घर गिने।"],
]


def prose(rng):
    """(text, units) of a cell."""
    stock = rng.choice(STOCK)
    glue = "" if stock is STOCK[2] else " "
    text, units = "", []
    for k in range(rng.randint(1, 4)):
        if text:
            text += "\n\n"
        mark = rng.choice(["", "", "", "- ", "# ", "1. "])
        text += mark
        for n in range(1 if mark == "# " else rng.randint(1, 4)):
            s = rng.choice(stock)
            text += glue if n else ""
            units.append((len(text), len(text) + len(s)))
            text += s
            if glue and rng.random() < 0.1 and mark == "" and stock is not STOCK[5]:
                text += ""
    return text, units


def test_held_out():
    rng = random.Random(5)
    model = se.train([prose(rng)[0] for _ in range(3500)])
    segmenter = se.Segmenter(model)
    hits = total = found = 0
    for _ in range(400):
        text, units = prose(rng)
        got = segmenter.units(text)
        hits += len(set(got) & set(units))
        total += len(units)
        found += len(got)
    assert hits / total > 0.97 and hits / found > 0.97


# seen in training besides the stock: abbreviations and patterns in yet other sentences
MORE = [["Prof. Lind sang a song.", "Ask Prof. Holt about it.", "Dr. Amato nodded.", "The door was open."], ["Der 4. Juni war kalt.", "Bis zum 30. Juni ist Zeit.", "Es regnet."],
        ["他喊：“谁来了？”", "老师答：“是我。”", "他说：“走吧！”", "“谁？”他问。"], ["क्या हुआ?", "वह कहाँ गया?", "बारिश हुई।"]]
# other words, the same traps; no sentence of these is in the training prose
UNSEEN = [
    ["Prof. Weaver painted two doors.", "The ferry left at 7 p.m.", "Compare Fig. 9 with the map.", "Nails, glue, etc. were bought.", "He wrote, “Close the gate.”",
     "“Where is the ladder?” asked Miller.", "(Nobody read the letter.)", "Its weight was 2.75 or more.", "Hmm...", "Rename old.csv after lunch.", "They repaired No. 4 and no. 6."],
    ["Am 9. Juni wurden Fenster geputzt.", "Hier liegt z. B. ein Brett.", "„Kommt er?“, fragte Weber.", "Im 17. Jahrhundert brannte alles.", "Wo bleibt Nr. 5?"],
    ["她问：“门关了吗？”", "桥很旧；明天再修。", "宽度是2.5，高度不明。"],
    ["Πού πήγε ο Νίκος;", "Άνοιξε το παράθυρο!", "Βλ. σχ. 8 στην αρχή."],
    ["« Où est la clé ? » demanda Petit.", "Voir fig. 7, p. 12.", "M. Petit a vendu 2,5 tonnes."],
    ["यह घर पुराना है।", "कौन आया?"],
]


def test_unseen_sentences():
    """Trained on the stock, scored on other sentences."""
    rng = random.Random(6)
    more = [("" if stock is MORE[2] else " ").join(rng.choice(stock) for _ in range(rng.randint(1, 4))) for stock in MORE * 150]
    pieces = ["\n\n".join(rng.sample(more, 2)) for _ in range(600)]
    segmenter = se.Segmenter(se.train([prose(rng)[0] for _ in range(3500)] + pieces))
    hits = total = found = 0
    for _ in range(300):
        stock = rng.choice(UNSEEN)
        text, units = "", []
        for n in range(rng.randint(1, 5)):
            s = rng.choice(stock)
            text += ("" if stock is UNSEEN[2] else " ") if n else ""
            units.append((len(text), len(text) + len(s)))
            text += s
        got = segmenter.units(text)
        hits, total, found = hits + len(set(got) & set(units)), total + len(units), found + len(got)
    assert hits / total > 0.9 and hits / found > 0.9


def test_more_scripts():
    """Marks that need no blank: Armenian, Khmer, Burmese, Tibetan, Mongolian."""
    units = [("Տունը հին է։", " "), ("ផ្ទះនេះចាស់។", ""), ("အိမ်ဟောင်းသည်။", ""), ("ཁང་པ་རྙིང་པ།", " "), ("ᠭᠡᠷ᠃", " ")]
    cells = [glue.join([s] * k) + "\n\n" + s for s, glue in units for k in (1, 2, 3) for _ in range(20)]
    segmenter = se.Segmenter(se.train(cells + [prose(random.Random(i))[0] for i in range(500)]))
    for s, glue in units:
        text = glue.join([s, s])
        assert segmenter.units(text) == [(0, len(s)), (len(text) - len(s), len(text))]


def test_counts_cover_all_documents(spark):
    """A token too rare in the sample is known from the other documents."""
    rare = "Cf. Roof."
    docs = [(i, t, [(0, "text", None, 0, len(t))]) for i, t in enumerate([f"{rare} The end." if i % 3 else "All is well. Good." for i in range(200)])]
    df = spark.createDataFrame(docs, f"doc_id long, text string, {CELLS}")
    cells = [rare]
    counts = se.corpus_counts(df, se.asked_keys(se.examples(cells)[1]))
    assert counts["mids", "cf", "."] == 133 and counts["ends", "cf", "."] == 0 and counts["follows", "roof", ""] == 133
    a, b = (sorted(se.fitted(df, sample=50).weights.items()) for _ in range(2))
    assert a == b == sorted(se.fitted(df.orderBy(F.desc("doc_id")).repartition(3), sample=50).weights.items())


def test_blocks():
    text = "# Head\nline one\nline two\n\n- a\n- b\n  more\n\n1. x\n2. y\n3 z\n\nAm\n3. Mai\n"
    assert [text[a:b] for a, b in se.blocks(text)] == ["Head", "line one\nline two", "a", "b\n  more", "x", "y\n3 z", "Am\n3. Mai"]
    assert se.blocks("") == se.blocks(" \n\t\n") == []


def test_pairs():
    assert se.pairs('a "b" (c) „d“ “e” « f »') == {4: 2, 8: 6, 12: 10, 16: 14, 22: 18}
    assert se.pairs('5" wide) and ”') == {}


def test_untrained():
    assert se.Segmenter(se.train([])).units("One. Two.") in ([(0, 4), (5, 9)], [(0, 9)])


def test_documents(spark):
    rng = random.Random(1)
    cells = [prose(rng) for _ in range(300)]
    docs = [(i, t, [(0, "text", None, 0, len(t)), (1, "code", None, 0, len(t))], "clash") for i, (t, _) in enumerate(cells)]
    docs += [(1000, None, [(0, "text", None, 0, 3)], ""), (1001, "", [], ""), (1002, " \n ", [(0, "text", None, 0, 3)], ""), (1003, "No cells.", None, ""),
             (1004, "Long " * 20_000 + "end.", [(0, "text", None, 0, 500_000)], ""), (1005, "🙂 Smile.", [(0, "text", None, 0, 8)], "")]
    df = spark.createDataFrame(docs, f"doc_id long, text string, {CELLS}, start_char string")
    got = {}
    for r in se.sentence_units(df).collect():
        got.setdefault(r.doc_id, set()).add((r.start_char, r.end_char))
    want = {i: set(u) for i, (_, u) in enumerate(cells)}
    assert sum(len(got[i] & want[i]) for i in want) / sum(map(len, want.values())) > 0.95
    assert not {1000, 1001, 1002, 1003} & set(got) and got[1004] == {(0, 100_004)} and got[1005] == {(0, 8)}
    assert se.sentence_units(df.limit(0)).count() == 0
    few = se.sentence_units(df, sample=50)
    assert few.count() > 0 and {f.name for f in few.schema} == {"doc_id", "start_char", "end_char"}


@pytest.mark.parametrize("name", ["p1_found", "p5_found", "p6_found", "p7_ids", "p8_found", "p9_found"])
def test_registered(spark, tiny, name):
    from plotweave.llm.registry import QUERIES

    assert QUERIES[name](spark, tiny).columns

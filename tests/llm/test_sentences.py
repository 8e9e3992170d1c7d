import random

import pytest

from tessera.llm.sentences import _depths, learn, parsed, script, sentences, statistics
from tests.llm.plain_sentences import Model, model_of, split

ENDS = ["The wash was long.", "Cells were kept apart.", "We saw the edge.", "All blocks came early.", "Nuclei were stained twice.", "After that, nothing moved.", "Each tile holds rows.", "Was it gone?", "Counts are integers.", "This deposit is new."]
ABBR = ["See Fig. 3 and Supp. Table 2 for more.", "Probes, e.g. MUV5 and KLX9, were used.", "Slide no. 8 failed at ca. 30 cells, i.e. before the wash.", "Work was shared by a U.S. team.", "Authors J. K. Sample et al. reported 12 cells.", "The counts follow Sample et al.", "The tables hold cells, genes, etc.", "The pitch was 3.5 mm vs. 4.1 mm.", "The run ended at 7 p.m. on Tuesday.", "Dr. Demo of the desk checked it."]
GERMAN = ["Am 10. Mai wurde der 3. Block geschnitten.", "Siehe Abb. 4 bzw. Tab. 7 im Anhang.", "Proben, z. B. aus der Haut, fehlen.", "Der Rand blieb ohne Signal.", "Wir haben alles gelagert.", "Fehlt die Einheit?", "Die Nr. 8 ging verloren!", "Nach der Wahl blieb er."]


def corpus(rng, n=400):
    rows = []
    for i in range(n):
        pool, lang = (GERMAN, "de") if i % 3 == 0 else (ENDS + ABBR, "en")
        rows.append((i, [rng.choice(pool) for _ in range(rng.randrange(2, 9))], lang))
    return rows


@pytest.fixture(scope="module")
def model(spark):
    rows = [(i, " ".join(x), g) for i, x, g in corpus(random.Random(1))]
    return model_of(tuple(r) for r in learn(statistics(parsed(spark.createDataFrame(rows, "doc_id bigint, text string, lang string")))).collect())


def cut(text, model, lang="en"):
    return [text[a:b] for a, b in split(text, lang, model)]


def test_held_out_accuracy(model):
    right = total = 0
    for _, parts, lang in corpus(random.Random(2), 200):
        got = cut(" ".join(parts), model, lang)
        total += len(parts)
        right += len([x for x in got if x in parts])
    assert right >= 0.98 * total


@pytest.mark.parametrize(
    "text,parts",
    [
        ('The form says: "Keep it. Do not merge." We saw the edge.', ['The form says: "Keep it. Do not merge."', "We saw the edge."]),
        ("“Which one? The upper!” is all that it says. Was it gone?", ["“Which one? The upper!” is all that it says.", "Was it gone?"]),
        ("(All blocks came early.) The wash was long.", ["(All blocks came early.)", "The wash was long."]),
        ("(All blocks came early.) p20-positive cells were rare. (比。)好。", ["(All blocks came early.)", "p20-positive cells were rare.", "(比。)", "好。"]),
        ('The warning ("Stop! Ever.") was ignored.', ['The warning ("Stop! Ever.") was ignored.']),
        ("Summary\n\nThe wash\nwas long.\n- see the edge", ["Summary", "The wash\nwas long.", "- see the edge"]),
        ("- Wash. Twice\n- Cut at 3.5 mm\n\n1. One\n2. Two. More", ["- Wash. Twice", "- Cut at 3.5 mm", "1. One", "2. Two. More"]),
        ("It was left out.The wash was long. Node.js writes a.b.csv by default.", ["It was left out.", "The wash was long.", "Node.js writes a.b.csv by default."]),
        ("It was left in the zone.Dr. Demo left. Dr. Demo came.", ["It was left in the zone.", "Dr. Demo left.", "Dr. Demo came."]),
        ("We waited… and it moved. The label was ... not there.", ["We waited… and it moved.", "The label was ... not there."]),
        ("Gone?! After that, nothing moved.  p28-positive cells were rare. mRNA was found.", ["Gone?!", "After that, nothing moved.", "p28-positive cells were rare.", "mRNA was found."]),
        ("结果……并不一致。“请保留。不要合并。”记录中这样写道。千万不要！好。", ["结果……并不一致。", "“请保留。不要合并。”记录中这样写道。", "千万不要！", "好。"]),
        ("「残すこと。しない。」と記録にある。どれか？", ["「残すこと。しない。」と記録にある。", "どれか？"]),
        ('"보관하세요. 합치지 마세요."라고 적혀 있다. 평균은 7.5이다.', ['"보관하세요. 합치지 마세요."라고 적혀 있다.', "평균은 7.5이다."]),
        ('"फ़ाइलें रखें। न मिलाएँ।" ऐसा लिखा है। कौन?', ['"फ़ाइलें रखें। न मिलाएँ।" ऐसा लिखा है।', "कौन?"]),
        ("เราได้จุด 19 จุดจากตับ ยีนนี้ไม่พบ ไฟล์ a.csv เก็บอยู่", ["เราได้จุด 19 จุดจากตับ", "ยีนนี้ไม่พบ", "ไฟล์ a.csv เก็บอยู่"]),
        ("Ποια μονάδα; Βλέπε πίνακα.", ["Ποια μονάδα;", "Βλέπε πίνακα."]),
        ("ما الوحدة؟ لا تخلطوا! «احفظوا. لا تدمجوها»، هكذا.", ["ما الوحدة؟", "لا تخلطوا!", "«احفظوا. لا تدمجوها»، هكذا."]),
        ("Voir ici ! « Gardez. Rien », dit-on. ¿Qué? ¡No!", ["Voir ici !", "« Gardez. Rien », dit-on.", "¿Qué?", "¡No!"]),
        ("a\r\n \t\r\nb c", ["a", "b", "c"]),
        ("cut off passage", ["cut off passage"]), ("", []), (None, []), (" \n　\t", []), ("...", ["..."]),
    ],
)
def test_layouts_and_scripts(model, text, parts):
    assert cut(text, model) == parts if text is not None else split(None, None, model) == []


def test_all_but_white_space_is_covered(model):
    rng = random.Random(3)
    for _ in range(500):
        text = "".join(rng.choice(["a", "B", ".", " ", "\n", "\n\n", '"', "(", ")", "。", "!", "1", "- ", "«", "»", "'", "ก", "…", "\r\n", ";"]) for _ in range(rng.randrange(60)))
        spans = split(text, rng.choice(["en", None, "und", "DE"]), model)
        assert all(0 <= a < b <= len(text) and not text[a].isspace() and not text[b - 1].isspace() for a, b in spans)
        assert all(x[1] <= y[0] for x, y in zip(spans, spans[1:]))
        held = {i for a, b in spans for i in range(a, b)}
        assert {i for i, c in enumerate(text) if not c.isspace()} <= held


def test_outermost_spans():
    text = 'a (b "c" d) e "f (g) h" i'
    assert list(zip(*_depths(text))) == [(2, 11), (14, 23)]
    assert _depths('it\'s 5" wide (open') == ([], [])


def test_very_long_text(model):
    text = "The wash was long. " * 20_000
    assert len(split(text, "en", model)) == 20_000
    assert len(split("x" * 500_000, None, model)) == 1
    assert len(split("坐标以像素给出。" * 50_000, "zh", model)) == 50_000
    assert len(split("(" * 100_000 + "'" * 100_000, None, model)) == 1


def test_rows(spark):
    rows = [(1, "A was here. B left.", "en"), (2, None, None), (3, "", "en"), (4, " \n", "und"), (1, "A was here. B left.", "en"), (None, "x", "zz")]
    df = spark.createDataFrame([(*r, 7) for r in rows], "doc_id bigint, text string, lang string, start_pos int")
    got = sorted(map(tuple, sentences(df).collect()), key=str)
    assert len(got) in (3, 5) and (None, 0, 1) in got
    assert sentences(df.limit(0)).count() == 0
    assert split("A. B", None, Model()) != []


def test_script_of_a_paragraph_with_a_long_latin_head():
    head = "GSE12345 Visium HD spatial transcriptomics of lung. " * 9
    assert len(head) > 400 and script(head + "Ткань была заморожена сразу после операции. " * 20) == "Cyrl"
    assert script("Ткань. " * 70 + head * 20) == "Latn" and script(head * 20 + "Ткань.") == "Latn" and script(head) == "Latn"


def test_joins_against_the_plain_version(spark):
    rng = random.Random(11)
    rows = [(i, " ".join(x), g) for i, x, g in corpus(rng, 200)]
    bits = ["a", "B", "Fig.", "et al.", "U.S.", "x.", "The", "12", ".", " ", "\n\n", '"', "(", ")", "。", "!", "- ", "ก ", "…", "cells.We", "A. ", "• "]
    rows += [(1000 + i, "".join(rng.choice(bits) for _ in range(rng.randrange(40))), rng.choice(["en", None, "DE"])) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    model = model_of(tuple(r) for r in learn(statistics(parsed(df))).collect())
    want = sorted((i, a, b) for i, t, g in rows for a, b in split(t, g, model))
    assert sorted(map(tuple, sentences(df).collect())) == want


def test_a_rare_abbreviation_of_a_large_language_is_learned(spark):
    # 5 of 600,000 stops, fewer than one in a hundred thousand
    rows = [(0, " ".join(["The wash was long. We saw the edge."] * 300_000), "en"), (1, "Take qvx. twice. Use qvx. here. See qvx. there. Cut qvx. so. Mark qvx. as usual.", "en")]
    got = sentences(spark.createDataFrame(rows, "doc_id bigint, text string, lang string")).where("doc_id = 1").count()
    assert got == 5


def test_brackets_and_words_of_any_length(spark):
    assert list(zip(*_depths("(" + "[" * 300 + ")"))) == [(0, 302)]
    assert list(zip(*_depths("“" + "(" * 300 + "”"))) == [(0, 302)]

import random

from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.llm.leaks import ItemIndex, leaks, letters, myers, weights


def brute_distance(p, t):
    row = [0] * (len(t) + 1)
    for i, x in enumerate(p, 1):
        new = [i]
        for j, y in enumerate(t, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return min(row)


@settings(max_examples=300, deadline=None)
@given(st.text("abc", max_size=12), st.text("abc", max_size=20))
def test_myers(p, t):
    assert myers(p, t) == brute_distance(p, t)


def brute_share(item, text, run, errors=0):
    a, b = letters(item), letters(text)
    held = set()
    for i in range(len(a) - run + 1):
        w = a[i : i + run]
        if w in b if not errors else brute_distance(w, b) <= errors:
            held.update(range(i, i + run))
    return len(held) / len(a) if a else 0


def test_shares_against_brute_force():
    rng = random.Random(4)
    for errors in (0, 1):
        for _ in range(60):
            item = "".join(rng.choice("abcd1 ,") for _ in range(rng.randrange(10, 90)))
            cut = [item[i : i + rng.randrange(5, 60)] for i in (rng.randrange(len(item)) for _ in range(3))]
            text = " zz ".join(x.upper() if rng.random() < 0.5 else x[:7] + "-\n" + x[7:] for x in cut)
            got = dict(ItemIndex([(1, item)], 20, errors).shares(text)).get(1, 0)
            want = brute_share(item, text, 20, errors)
            assert got == want or abs(got - want) < 1e-9, (item, text, errors)


def test_letters():
    assert letters("<b>Ｆｕ­ＬＬ</b> ﬁ-\nne &amp; é ① _x_ [a](http://q.example/z) 1 < 2") == "fullfine" + "é" + "1xa12"
    for t in ("Straße ﬁ éx", "abc 1", "ſ İ"):
        assert len(weights(t)) == len(letters(t)) or "İ" in t
    assert sum(weights("Straße ﬁ")) == 7


ITEM = "When probes reach 393.6 units, the nested capsule seals a vault beneath the garland."


def found(spark, docs, items, **kw):
    d = spark.createDataFrame([(i, t, "c") for i, t in docs], "doc_id bigint, text string, share string")
    i = spark.createDataFrame([(i, t, "c") for i, t in items], "item_id bigint, text string, doc_id string")
    return sorted((r.item_id, r.doc_id) for r in leaks(d, i, **kw).collect())


def test_rows(spark):
    half = ITEM[: len(ITEM) // 2 + 5]
    docs = [(1, "x" * 100_000 + ITEM.upper() + "y"), (2, half), (3, ITEM[:30]), (4, None), (5, ""), (6, " \n"), (7, ITEM.replace("e", "e​")), (7, ITEM), (8, f"{ITEM[45:]} and then {ITEM[:45]}"), (9, "<i>" + ITEM.replace(" ", "</i>\r\n<i>") + "</i>")]
    want = [(1, 1), (1, 2), (1, 7), (1, 7), (1, 8), (1, 9)]
    assert found(spark, docs, [(1, ITEM)]) == want
    assert found(spark, docs, [(1, ITEM), (2, "short"), (3, None), (4, ""), (5, "nothing of the kind is found there")]) == want
    assert found(spark, docs, [(1, ITEM), (11, ITEM)], block_letters=1) == sorted(want + [(11, d) for _, d in want])
    assert found(spark, docs, []) == [] and found(spark, [], [(1, ITEM)]) == []
    assert found(spark, [(1, ITEM.replace("units", "unins").replace("vault", "vaut"))], [(1, ITEM)], errors=1, share=0.99) == [(1, 1)]


def test_markup_of_any_length():
    for tag in ('<a href="%s">' % ("u" * 400), "<!-- %s -->" % ("c " * 400), '<span title="%s" class=x>' % ("long words " * 60)):
        assert dict(ItemIndex([(1, ITEM)], 20, 0).shares(f"{ITEM[:40]}{tag}{ITEM[40:60]}{tag}{ITEM[60:]}")) == {1: 1.0}
    assert letters(f"[a](http://x.example/{'y' * 900}) b") == "ab"
    assert len(letters("<!-- " * 200_000)) == 0 and len(letters("<a " * 200_000)) == 200_000  # linear time, nothing closed


def test_items_that_share_an_opening():
    rng = random.Random(9)
    word = lambda n: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n))
    opening = word(60)
    items = [(i, opening + word(rng.randrange(50, 160))) for i in range(300)]
    index = ItemIndex(items, 20, 0, share=0.5)
    assert len(index.contexts) < 300 * 16  # the opening is one class a piece, not one an item
    for text in (opening, opening + items[7][1][60:100], items[8][1], "xx" + items[9][1][70:]):
        want = {(i, brute_share(t, text, 20)) for i, t in items}
        got = {(i, x) for i, x in index.shares(text) if x >= 0.5}
        assert got == {(i, x) for i, x in want if x >= 0.5}
    assert len(index.shares(opening)) < 300


@settings(max_examples=100, deadline=None)
@given(st.text("ab", max_size=10), st.text("ab", max_size=16), st.integers(0, 3))
def test_myers_with_a_bound(p, t, k):
    assert (myers(p, t, k) <= k) == (brute_distance(p, t) <= k)


def test_planted_passages_with_edits_are_found():
    rng = random.Random(3)
    word = lambda n: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n))
    items = [(i, word(200)) for i in range(40)]
    index, hits = ItemIndex(items, 20, 1, share=0.5), 0
    for i, t in items:
        out, at = [], rng.randrange(20)
        for k, x in enumerate(t):  # one edit in twenty-one letters
            out.append(x if k % 21 != at % 21 else rng.choice(("", "é", x + "é")))
        hits += (i, 1.0) in [(j, round(x, 1)) for j, x in index.shares(word(300) + "".join(out) + word(50))]
    assert hits == 40

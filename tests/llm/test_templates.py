import random
import re

from accountweave.llm import templates as T

ITEM = "Anna has 12 kg of apples and gives 3 kg to Bert before she walks 5 km home to Anna and rests."


def benchmark(spark, rows):
    return spark.createDataFrame([(i, t, "x") for i, t in rows], "item_id long, text string, h string")


def words(r, n):
    return " ".join("".join(r.choices("abcdefghij", k=r.randint(2, 6))) for _ in range(n))


def found(spark, documents, texts, items):
    out = T.flag(documents(texts, extra=True), benchmark(spark, items)).collect()
    return {r["__aw_row"].doc_id: list(r["items"]) for r in out}


def test_template_words():
    assert T.template("Anna met Bert. He paid 1,200.50 $ for USA")[0] == "anna met <name> he paid <num> <unit> for usa".split()
    assert T.template("in 5 m of m")[0] == "in <num> <unit> of m".split()


def test_copies_and_new_parameters(spark, documents):
    r = random.Random(1)
    changed = ITEM.replace("Anna", "Cora").replace("12", "77").replace("Bert", "Dan").replace("3 kg", "9 kg")
    mixed = ITEM.replace("to Bert before", "to Cora before").replace("home to Anna", "home to Bert")
    other = ITEM.replace("apples", "pears").replace("gives", "sells").replace("walks", "rides").replace("home", "back")
    around = lambda t: f"{words(r, 30)}. {t} {words(r, 30)}"
    texts = [around(ITEM), around(changed), around(changed.upper()), words(r, 400), around(other), ITEM[:20], None, "", around("x " + ITEM + " y " + ITEM)]
    got = found(spark, documents, texts, [(7, ITEM), (8, words(r, 20)), (9, "too short to tell"), (10, None)])
    assert [i for i in got if got[i]] == [0, 1, 2, 8]
    assert all(got[i] == ["7"] for i in (0, 1, 2, 8))
    # Two names of four are others, so slots clash; windows that hold none of these stand as they are and are half of the item.
    assert found(spark, documents, [around(mixed)], [(1, ITEM)])[0] == ["1"]


def test_inconsistent_slots_are_no_match(spark, documents):
    item = "give Anna 5 coins and then Anna counts all of the coins that Anna has got from Bert in May"
    fits = item.replace("Anna", "Cora")
    breaks = "give Cora 5 coins and then Dora counts all of the coins that Emil has got from Bert in May"
    got = found(spark, documents, [fits, breaks], [(1, item)])
    assert got == {0: ["1"], 1: []}


def brute(texts, items):
    """Items of each text by exact comparison of words, for texts and items without any slot."""
    out = {}
    grams = lambda w: [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    for i, t in enumerate(texts):
        at = grams(t.split())
        out[i] = []
        for k, item in items:
            own = grams(item.split())
            shifts = {d - p for p, g in enumerate(own) for d, h in enumerate(at) if g == h}
            best = max((sum(0 <= s + p < len(at) and at[s + p] == g for p, g in enumerate(own)) for s in shifts), default=0)
            if own and best >= 0.5 * len(own):
                out[i].append(str(k))
    return out


def test_same_as_brute_force(spark, documents):
    r = random.Random(5)
    items = [(i, words(r, r.randint(3, 25))) for i in range(12)]
    texts = []
    for _ in range(60):
        item = r.choice(items)[1].split()
        part = item[: r.randint(0, len(item))]
        texts.append(" ".join([words(r, r.randint(0, 20)), *part, words(r, r.randint(0, 20))]).strip())
    texts += [items[5][1] + " " + items[6][1]] * 3
    got = found(spark, documents, texts, items)
    assert {i: sorted(v) for i, v in got.items()} == {i: sorted(v) for i, v in brute(texts, items).items()}


def test_filter_keeps_rows_and_columns(spark, documents, odd):
    docs = documents([*odd, ITEM], extra=True)
    out = T.without_leaks(docs, benchmark(spark, [(1, ITEM)]))
    assert out.schema == docs.schema and out.count() == len(odd)


def test_empty_tables(spark, documents):
    assert T.without_leaks(documents([]), benchmark(spark, [(1, ITEM)])).count() == 0
    assert T.without_leaks(documents([ITEM]), benchmark(spark, [])).count() == 1


def test_copies_with_inserted_and_dropped_words(spark, documents):
    r = random.Random(8)
    item = words(r, 24).split()
    two = " ".join([*item[:8], "new", *item[8:16], "more", *item[16:]])
    gone = " ".join([*item[:7], *item[8:16], *item[17:]])
    apart = " ".join([*item[:8], words(r, 200), *item[8:16], words(r, 200), *item[16:]])
    longer = ITEM.replace("Bert", "Mary Ann").replace("12", "twelve 9").replace("5 km", "5")
    got = found(spark, documents, [f"{words(r, 40)} {two} {words(r, 40)}", gone, apart, f"so {longer}"], [(1, " ".join(item)), (2, ITEM)])
    assert got == {0: ["1"], 1: ["1"], 2: [], 3: ["2"]}


def test_copies_in_another_case_and_with_other_line_breaks(spark, documents):
    r = random.Random(9)
    item = "we saw Anna give Bert two of Carl books while Dora read to Emil and Fred about Gina and Hans in May"
    broken = item.replace(" ", ".\n")
    texts = [f"{words(r, 20)} {t} {words(r, 20)}" for t in (item, item.lower(), item.upper(), item.title(), broken)]
    assert found(spark, documents, texts, [(1, item)]) == {i: ["1"] for i in range(5)}
    assert T.template("he met Mary Ann Lee today")[0] == "he met <name> today".split()


def test_words_and_slots_by_the_plain_rule():
    """Every word by the rules alone, without a shorter way for lower-case words."""

    def plain(text):
        out, opens, number = [], True, False
        for w in re.findall(r"\d+(?:[.,]\d+)*|[^\W\d_]+|[%$\u20ac\u00a3\u00b0]|[.!?\n]", text):
            if w in ".!?\n":
                opens, number = True, False
                continue
            if w[0].isdigit():
                out.append(("<num>", w))
            elif number and w.lower() in T.UNITS:
                out.append(("<unit>", w.lower()))
            elif not opens and w[0].isupper() and not (len(w) > 1 and w.isupper()):
                out.append(("<name>", w.lower()))
            else:
                out.append((w.lower(), ""))
            opens, number = False, w[0].isdigit()
        return out

    odd = ["5 km 5 KM 5 Km km 1,000.5 % \u00b0 A I NASA Bob bob. Bob", "\u00b2 \u00b2ab km \u2177 \u2177x", "\u01c5a \u4e00 \u0130x \u00df \u00aa 3 min. 3 Min", "x1y 7z k", ""]
    for text in odd:
        assert list(zip(*T._slots(text), strict=True)) == plain(text)

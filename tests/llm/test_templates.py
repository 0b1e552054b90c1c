import random
import re

import pytest

from tradeflow.llm import templates as tp


def items(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "item_id long, text string")


QUESTION = "A train leaves London at 10 with 240 passengers and travels for 3 hours at 80 km per hour until 240 people leave"
OTHER = QUESTION.replace("London", "Madrid").replace("240", "511").replace("10", "7").replace("80 km", "65 miles")
BROKEN = QUESTION.replace("240 passengers", "511 passengers")


def pairs(df):
    return {(r.doc_id, r.item_id): r for r in df.collect()}


def test_copies_and_reparameterised_questions(spark, docs_of):
    docs = docs_of([f"Intro text here. {QUESTION}. The end.", f"x {OTHER.upper().lower()} y".replace("madrid", "Madrid"), BROKEN, "clean text about a train that leaves", " ".join(QUESTION.split()[:9])])
    got = pairs(tp.contaminated(docs, items(spark, [QUESTION])))
    assert set(got) == {(0, 0), (1, 0)}
    assert got[0, 0].exact and not got[1, 0].exact and got[0, 0].coverage == 1.0


def words(text):
    """The canonical words, written once more by hand for texts in ASCII."""
    text = re.sub(r"(?<=[a-z] )(?=[A-Z][a-z])", "\x01a", (text or "").replace("\x01", " "))
    text = re.sub(r"(?<!\S)(?=[!-/:-@\[-`{-~]*[A-Z][a-z])", "\x01c", text)
    text = re.sub(r"[!-/:-@\[-`{-~]+", "", text.lower())
    units = "|".join(sorted(tp.UNITS, key=len, reverse=True))
    text = re.sub(rf"(?<!\S)([0-9]+)({units})(?!\S)", r"\1 \2", text)
    out = []
    for w in text.split():
        after, plain = bool(out) and out[-1].startswith("\x01n"), w.removeprefix("\x01c")
        out.append("\x01n" + w if w.isdigit() else "\x01u" + plain if after and plain in tp.UNITS else w)
    return out


def forms(window):
    """Level, shape and slots: no placeholders; names after a lower-case word, numbers and units; all names too."""
    for level, kinds in enumerate(("", "anu", "acnu")):
        marked = [w[0] == "\x01" and w[1] in kinds for w in window]
        new = [w for w, m in zip(window, marked, strict=True) if m and (level == 1 or w[1] == "c")]
        if kinds and (not new or len(window) - sum(marked) < 2):
            continue
        shape = tuple("\x01" + w[1].replace("c", "a") if m else w[2:] if w[0] == "\x01" else w for w, m in zip(window, marked, strict=True))
        yield level, shape, tuple(w.replace("\x01c", "\x01a") for w, m in zip(window, marked, strict=True) if m)


def brute(docs, bench, width=5, coverage=0.8):
    out = {}
    for i, text in enumerate(docs):
        d = words(text)
        for j, item in enumerate(bench):
            b = words(item)
            n = min(width, len(b))
            if not n:
                continue
            lines = {}
            for p in range(len(b) - n + 1):
                for q in range(len(d) - n + 1):
                    for level, shape, old in forms(b[p : p + n]):
                        for other, theirs, new in forms(d[q : q + n]):
                            if shape == theirs:
                                lines.setdefault((q - p, max(level, other)), []).append((p, set(zip(old, new, strict=True))))
            good = []
            for (shift, _), hits in lines.items():
                slots = set().union(*(s for _, s in hits))
                if len({x for x, _ in slots}) == len(slots):
                    good.append((shift, {p for p, _ in hits}))
            best = max((len(set().union(*(ps for s, ps in good if abs(s - c) <= 2))) for c in {s + k for s, _ in good for k in range(-2, 3)}), default=0)
            if best >= coverage * (len(b) - n + 1):
                out[i, j] = best
    return out


def test_equals_brute_force(spark, docs_of):
    bench = [QUESTION, "two words", "x", "the sum of 3 and 4 is 7 but the sum of 4 and 3 is 7 too", None, "", "...", "one two three four five six seven eight nine ten eleven twelve"]
    docs = [
        None, "", OTHER, BROKEN, "some two words inside", "x", "X!", "the sum of 5 and 6 is 9 but the sum of 6 and 5 is 9 too", "the sum of 5 and 6 is 9 but the sum of 1 and 5 is 9 too",
        "one two three four five six seven eight nine ten eleven zwelve", "one two three four five six SEVEN. eight nine ten eleven twelve!", "one two three four five six extra seven eight nine ten eleven twelve",
        QUESTION + " " + OTHER, "5km 5 km 7kg", "word " * 3_000, OTHER, QUESTION.replace("with 240", "with some 240"),
    ]
    got = pairs(tp.contaminated(docs_of(docs), items(spark, bench)))
    assert {k: r.n_found for k, r in got.items()} == brute(docs, bench)


@pytest.mark.parametrize("limit", [0, 10**6])
def test_broadcast_and_shuffle_give_the_same(spark, docs_of, limit):
    got = pairs(tp.contaminated(docs_of([OTHER, "a b", QUESTION]), items(spark, [QUESTION, QUESTION]), max_broadcast=limit))
    assert set(got) == {(0, 0), (0, 1), (2, 0), (2, 1)}


def test_native_plan_and_empty_tables(spark, docs_of):
    df = tp.contaminated(docs_of([QUESTION]).withColumnRenamed("lang", "words"), items(spark, [QUESTION]))
    assert not re.search("Python|Pandas|Arrow", df._jdf.queryExecution().toString()) and df.count() == 1
    assert tp.contaminated(docs_of([]), items(spark, [QUESTION])).count() == 0
    assert tp.contaminated(docs_of([QUESTION]), items(spark, [])).count() == 0


def test_names_wherever_they_stand_and_copies_in_other_case(spark, docs_of):
    short = "Anna has 12 apples. Anna gives 5 to Ben"
    long = "The boy (Tom) said that 3 Berlin trains\nLeave at noon,  Paris trains later. The boy waits for Anna and asks a guard who knows all the trains of both towns well"
    docs = docs_of([
        "Mia has 7 apples. Mia gives 3 to Tom", short.lower(), "so " + short.upper(), "Mia has 7 apples. Eva gives 3 to Tom",
        long.lower(), " ".join(long.split()), long.replace("Tom", "Max").replace("Berlin", "London").replace("Paris", "Rome"),
        long.replace("The boy waits for Anna", "This boy waits for Eva"), "One has 5 Km left of it", "mia has 7 apples. mia gives 3 to tom",
    ])
    got = pairs(tp.contaminated(docs, items(spark, [short, long, "Two has 7 km left of it"])))
    assert set(got) == {(0, 0), (1, 0), (2, 0), (4, 1), (5, 1), (6, 1), (7, 1), (8, 2)}
    assert [got[k].exact for k in ((0, 0), (1, 0), (2, 0), (4, 1), (5, 1), (6, 1))] == [False, True, True, True, True, False]


def test_random_questions_equal_brute_force(spark, docs_of):
    rng = random.Random(11)
    vocabulary = ["the", "of", "Anna", "Tom", "has", "apples", "gives", "12", "7", "km", "and", "Then", "then", "Rome", "5", "red"]

    def some(n):
        return [rng.choice(vocabulary) for _ in range(n)]

    bench, docs = [], []
    for _ in range(25):
        own = some(rng.randint(2, 25))
        bench.append(" ".join(own))
        swap = {w: rng.choice(new) for w, new in {"Anna": ["Anna", "Eva"], "Tom": ["Max"], "12": ["3", "5"], "7": ["7", "900"]}.items()}
        copy = [swap.get(w, w) for w in own]
        for _ in range(rng.choice([0, 0, 0, 1])):
            copy.insert(rng.randrange(len(copy) + 1), rng.choice(vocabulary))
        docs.append(" ".join(some(rng.randint(0, 9)) + copy + some(rng.randint(0, 9))))
    got = pairs(tp.contaminated(docs_of(docs), items(spark, bench)))
    expected = brute(docs, bench)
    assert {k: r.n_found for k, r in got.items()} == expected and len(expected) >= 10


def test_unrelated_titles_and_number_lists_are_left_alone(spark, docs_of):
    rng = random.Random(7)

    def title(n):
        return " ".join("".join(rng.choice("abcdefgh") for _ in range(6)).capitalize() for _ in range(n))

    def numbers(n):
        return " ".join(str(rng.randrange(10_000)) for _ in range(n))

    docs, bench = [title(20) for _ in range(10)] + [numbers(50) for _ in range(10)], [title(12) for _ in range(10)] + [numbers(50) for _ in range(10)]
    assert tp.contaminated(docs_of(docs), items(spark, bench)).count() == 0
    got = pairs(tp.contaminated(docs_of([f"see {bench[0]} now", f"1 2 {bench[15]} 3"]), items(spark, bench)))
    assert set(got) == {(0, 0), (1, 15)}


def test_a_small_insertion_and_pieces_far_apart(spark, docs_of):
    own = QUESTION.split()
    inserted = " ".join([*own[:2], "slowly", *own[2:]])
    torn = " ".join([*own[:11], *["some"] * 9, *own[11:]])
    got = pairs(tp.contaminated(docs_of([inserted, torn]), items(spark, [QUESTION])))
    assert set(got) == {(0, 0)} and got[0, 0].n_found == got[0, 0].n_windows - 2


def test_rows_are_judged_one_by_one(spark, docs_of):
    half = len(QUESTION) // 2
    parts = [QUESTION[:half], QUESTION[half:]]
    assert tp.contaminated(docs_of(parts, [None, None]), items(spark, [QUESTION])).count() == 0
    assert tp.contaminated(docs_of(parts, [4, 4]), items(spark, [QUESTION])).count() == 0
    whole = tp.contaminated(docs_of([*parts, QUESTION, QUESTION], [None, 4, 4, None]), items(spark, [QUESTION]))
    assert sorted((r.doc_id is None, r.coverage) for r in whole.collect()) == [(False, 1.0), (True, 1.0)]

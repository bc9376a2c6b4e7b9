"""Decontamination on hand cases and against a plain matcher."""

import random
import re

import pytest

from groundshift.llm import decontaminate
from groundshift.llm.decontaminate import LEAST, LOOSE, UNITS, WINDOW


def tokens(text):
    return re.findall(r"(?:[.!?\n]\s*)?[^\W_]+(?:[.,][0-9]+)*|[%$€£°]", text or "")


def template(words, i, begin):
    raw = words[i]
    x = raw.lstrip(".!?\n\r\t ")
    starts = i == 0 or raw[0] in ".!?\n"
    after_number = i > 0 and words[i - 1].lstrip(".!?\n\r\t ")[:1].isdigit()
    if x[0] in "0123456789":
        return "<num>"
    if starts and (raw[0] in ".!?\n" or x.lower() != x):
        return "<name>" if begin and x.lower() != x else x.lower()
    if x.lower() in UNITS and (x.lower() not in LOOSE or after_number):
        return "<unit>"
    return "<name>" if x.lower() != x else x.lower()


def plain(docs, items):
    """(doc_id, item_id) by comparing every window with every window."""
    out = set()
    reading = lambda t: [[template(t, i, b) for i in range(len(t))] for b in (False, True)]
    value = lambda w: w.lstrip(".!?\n\r\t ").lower()
    for item, text in items:
        t = tokens(text)
        n = len(t)
        if item is None or not n:
            continue
        ours, size = reading(t), min(n, WINDOW)
        slots = lambda a, z: sum(x.startswith("<") for x in ours[0][a:z])
        usable = [p for p in range(n - WINDOW + 1) if slots(p, p + WINDOW) * 2 <= WINDOW]
        most = min(n - WINDOW + 1, LEAST)
        whole = n < WINDOW or len(usable) < most
        looked = range(n - size + 1) if whole else usable
        needed = n - size + 1 if whole else most
        exact = whole and (n < WINDOW or (n - slots(0, n)) * 2 < WINDOW)
        for doc, theirs in docs:
            if doc is None or not theirs:
                continue
            w = tokens(theirs)
            read = reading(w)
            for shift in range(-n, len(w)):
                met = [p for p in looked if 0 <= p + shift <= len(w) - size and any(o[p : p + size] == r[p + shift : p + shift + size] for o in ours for r in read)]
                if len(met) < needed:
                    continue
                places = {q for p in met for q in range(p, p + size)}
                pairs = {(value(t[q]), value(w[q + shift])) for q in places}
                stands = {(value(t[q]), value(w[q + shift])) for q in places if ours[1][q].startswith("<")}
                if all(a == b for a, b in pairs) if exact else len({a for a, _ in stands}) == len(stands):
                    out.add((doc, item))
    return out


def found(spark, docs, items):
    d = spark.createDataFrame([(*r, "k") for r in docs], "doc_id bigint, text string, h string")
    b = spark.createDataFrame([(*r, 1) for r in items], "item_id bigint, text string, size int")
    return {(r.doc_id, r.item_id) for r in decontaminate.leaks(d, b).collect()}


@pytest.mark.parametrize("broadcast", [decontaminate.BROADCAST_WINDOWS, 0])
def test_random_items_as_the_plain_matcher_finds_them(spark, monkeypatch, broadcast):
    monkeypatch.setattr(decontaminate, "BROADCAST_WINDOWS", broadcast)
    rng = random.Random(9)
    names, words = "Anna Bob Carl Dora Émile".split(), "has gives apples to and of them every in the week how many So If what is old tree km hours".split()
    phrase = lambda n: " ".join(rng.choice([rng.choice(names), str(rng.randint(1, 9)), *rng.choices(words, k=6)]) + rng.choice(["", "", "", "", ".", "?", "\n"]) for _ in range(n))
    items = [(i, phrase(rng.choice([2, 5, 7, 8, 9, 10, 12, 16, 24, 36]))) for i in range(40)] + [(3, phrase(14)), (None, phrase(9)), (50, None), (51, "")]

    def altered(text):
        swap = {x: rng.choice(names) for x in names} | {str(k): str(rng.randint(10, 60)) for k in range(1, 10)}
        text = re.sub(r"[^\W_]+", lambda m: swap.get(m[0], m[0]), text)
        if rng.random() < 0.4:
            w = text.split(" ")
            w[rng.randrange(len(w))] = rng.choice(["many", "7", "Eve", "tree"])
            text = " ".join(w)
        return text

    docs = [(k, phrase(rng.randint(0, 12)) + rng.choice([" ", ". ", "\n"]) + rng.choice([altered, str])(rng.choice(items[:41])[1]) + " " + phrase(rng.randint(0, 6))) for k in range(120)]
    docs += [(900, None), (901, ""), (None, items[0][1]), (902, items[5][1]), (902, items[5][1])]
    want = plain(docs, items)
    assert found(spark, docs, items) == want and len(want) > 60


def test_places_that_did_not_meet_play_no_part(spark):
    item = "Every one of the 40 boats that left the old port in the north came back with 40 boxes of fish for all the people who had been waiting on the shore"
    assert found(spark, [(1, item.replace("40 boxes", "many boxes"))], [(0, item)]) == {(1, 0)}


def test_a_name_that_begins_a_sentence(spark):
    item = "Anna has 3 apples and gives 2 to a friend"
    docs = [(1, "Carl has 7 apples and gives 5 to a friend"), (2, "so Carl has 7 apples and gives 5 to a friend"), (3, "He said. Carl has 7 apples and gives 5 to a friend"), (4, "anna has 7 apples and gives 5 to a friend")]
    assert found(spark, docs, [(0, item)]) == {(1, 0), (2, 0), (3, 0), (4, 0)}
    assert found(spark, docs, [(0, "so " + item)]) >= {(1, 0), (2, 0), (3, 0)}


def test_an_item_id_with_several_texts(spark):
    a, b = "one two three four five six seven eight nine ten", "ten nine eight seven six five four three two one zero"
    assert found(spark, [(1, a), (2, b), (3, "x " + b)], [(0, a), (0, b)]) == {(1, 0), (2, 0), (3, 0)}


ITEM = "If Anna has 3 apples and gives 2 of them to Bob every day in the long week now"


def test_decontamination_finds_other_parameters(spark):
    docs = [
        (1, "x y z. " + ITEM + " and so on"),
        (2, "So Carl has 7 apples and gives 5 of them to Dora every day in the long week now"),
        (3, None), (4, ""), (5, "apples and gives of them every day in the long week now for all who ask"), (6, ITEM), (6, ITEM), (8, "w " * 30_000 + ITEM),
        (7, "If anna had apples she would give some of them to bob"), (None, ITEM),
    ]
    d = spark.createDataFrame([(*r, "k") for r in docs], "doc_id bigint, text string, h string")
    b = spark.createDataFrame([(0, ITEM), (1, None), (2, ""), (3, "too short")], "item_id bigint, text string")
    assert {(r.doc_id, r.item_id) for r in decontaminate.leaks(d, b).collect()} == {(1, 0), (2, 0), (6, 0), (8, 0)}
    assert sorted((r.doc_id or -1) for r in decontaminate.clean(d, b).collect()) == [-1, 3, 4, 5, 7]
    assert decontaminate.leaks(d.limit(0), b).count() == 0 and decontaminate.leaks(d, b.limit(0)).count() == 0
    twice = spark.createDataFrame([(0, ITEM.replace("2", "3"))], "item_id bigint, text string")  # one value cannot stand for two
    assert decontaminate.leaks(d.where("doc_id = 2"), twice).count() == 0


def test_decontamination_finds_items_with_few_usable_windows(spark):
    train, legs = "A train travels 60 km in 2 hours and 90 km in 3 hours.", "How many legs do six spiders and two ants have?"
    b = spark.createDataFrame([(0, train), (1, legs), (2, "5 birds sit on the old tree by the river"), (3, "What is 3 plus 5?"), (4, "1 2 3 4 5 6 7 8 9")], "item_id bigint, text string")
    docs = [
        (1, "He said. " + train), (2, "Note: A train travels 70 km in 4 hours and 80 km in 5 hours."), (3, "A train travels 70 km in 4 hours and 80 km in 4 hours and"),
        (4, "Question: " + legs), (5, legs.lower()), (6, "So. 5 birds sit on the old tree by the river"), (7, "he asked: what is 3 plus 5? and"), (8, "What is 4 plus 5?"),
        (9, "0 1 2 3 4 5 6 7 8 9 1"), (10, "11 12 13 14 15 16 17 18 19 20"), (11, "A train travels 60 km in 2 hours and 90 miles in 3 days"),
    ]
    d = spark.createDataFrame(docs, "doc_id bigint, text string")
    assert {(r.doc_id, r.item_id) for r in decontaminate.leaks(d, b).collect()} == {(1, 0), (2, 0), (3, 0), (4, 1), (5, 1), (6, 2), (7, 3), (9, 4)}
